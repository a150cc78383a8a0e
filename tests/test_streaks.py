"""Streak detection vs a brute-force state machine (random keys, three orderings)."""

import random

import pytest
from pyspark.sql import functions as F

from chartstreak.operators import streaks
from chartstreak.schemas import CHART_SCHEMA
from statemachine import detect, random_streaks

RUN = 4


def to_chart(spark, rows):
    data = [("c", str(r["key"]), "n", r["rank"], r["date"], r["seq"]) for r in rows]
    df = spark.createDataFrame(data, "country string, spotifyId string, name string, dailyRank int, "
                                     "snapshotDate date, seq long")
    fill = {f.name: F.lit(0).cast(f.dataType) for f in CHART_SCHEMA.fields if f.name not in df.columns}
    return df.withColumns(fill).withColumn("explicit", F.lit(False))


def spark_result(df):
    return {int(r["spotifyId"]): (r["consecutiveHitDaysCount"], list(r["consecutiveHitDaysList"]))
            for r in df.collect()}


def expected(rows):
    return {k: (n, [d.isoformat() for d in days]) for k, (_, n, days) in detect(rows, 10, RUN).items()}


@pytest.mark.parametrize("seed", [1, 2])
def test_date_order_formulation(spark, seed):
    rows = random_streaks(random.Random(seed), order="date")
    got = spark_result(streaks.detect_hits(to_chart(spark, rows), 10, RUN))
    want = expected(rows)
    assert len(want) > 20
    assert got == want


@pytest.mark.parametrize("order,repeats", [("date", False), ("shuffled", False), ("shuffled", True)])
def test_ordered_fold_formulation(spark, order, repeats):
    rows = random_streaks(random.Random(7), order=order, repeats=repeats)
    df = streaks.detect_hits_ordered(to_chart(spark, rows), "seq", 10, RUN)
    got = spark_result(df)
    want = expected(rows)
    assert len(want) > 20
    assert got == want
    # the emitted row is the trigger row itself
    trig = {int(r["spotifyId"]): r["snapshotDate"] for r in df.collect()}
    by_seq = {r["seq"]: r for r in rows}
    for k, (seq, _, _) in detect(rows, 10, RUN).items():
        assert trig[k] == by_seq[seq]["date"]


def assert_triggers(df, rows):
    """Counts, lists and the emitted row itself."""
    want = expected(rows)
    assert len(want) > 20 and spark_result(df) == want
    by_seq = {r["seq"]: r for r in rows}
    trig = {int(r["spotifyId"]): r["snapshotDate"] for r in df.collect()}
    assert trig == {k: by_seq[seq]["date"] for k, (seq, _, _) in detect(rows, 10, RUN).items()}


@pytest.mark.parametrize("order,seed", [("date", 4), ("shuffled", 5), ("shuffled", 6)])
def test_arrival_formulation(spark, order, seed):
    rows = random_streaks(random.Random(seed), order=order)
    df = streaks.detect_hits(to_chart(spark, rows), 10, RUN, order_col="seq")
    assert_triggers(df, rows)
    if order == "shuffled":   # the row that closes a gap can make a run longer than the rule
        assert df.where(F.col("consecutiveHitDaysCount") > RUN).count() > 0


def test_arrival_collects_only_behind_the_trigger(spark):
    rows = random_streaks(random.Random(4), n_keys=5, order="shuffled")
    plan = streaks.detect_hits_arrival(to_chart(spark, rows), "seq", 10, RUN)._jdf.queryExecution().optimizedPlan()
    lines = plan.toString().splitlines()
    filtered = next(i for i, line in enumerate(lines) if "trigger" in line and "Filter" in line)
    assert all("collect_list" not in line for line in lines[filtered:])


def test_repeated_first_day_and_equal_arrivals(spark):
    """Equal order values are taken by day; a repeated top day counts once, from its first row."""
    import datetime as dt
    day = dt.date(2024, 1, 1)
    rows = [{"key": 1, "date": day + dt.timedelta(days=d), "rank": 1, "seq": 7} for d in (2, 0, 1, 3)]
    rows += [{"key": 1, "date": day, "rank": 2, "seq": 9}]
    hit = streaks.detect_hits_arrival(to_chart(spark, rows), "seq", 10, RUN).first()
    assert hit["snapshotDate"] == day + dt.timedelta(days=3) and hit["consecutiveHitDaysCount"] == 4


@pytest.mark.parametrize("order,repeats", [("date", False), ("shuffled", False), ("shuffled", True)])
def test_spread_changes_equal_the_fold(spark, order, repeats):
    rows = random_streaks(random.Random(9), order=order, repeats=repeats)
    assert_triggers(streaks.detect_hits_ordered(to_chart(spark, rows), "seq", 10, RUN, most_changes=0), rows)


def test_one_key_with_many_changes_beside_small_keys(spark):
    """A key that toggles its days again and again is spread; the other keys are folded."""
    import datetime as dt
    base, rows = dt.date(2024, 1, 1), []
    for turn in range(400):      # days 0, 2, 4, ... come and go, never RUN in a row
        for d in range(0, 20, 2):
            rows.append({"key": 0, "date": base + dt.timedelta(days=d), "rank": 1 if turn % 2 == 0 else 50})
    rows += [{"key": 0, "date": base + dt.timedelta(days=d), "rank": 1} for d in (4, 6, 5, 3, 9)]
    rows += [{"key": 1, "date": base + dt.timedelta(days=d), "rank": 1} for d in (3, 1, 2, 0)]
    for seq, r in enumerate(rows):
        r["seq"] = seq
    got = spark_result(streaks.detect_hits_ordered(to_chart(spark, rows), "seq", 10, RUN, most_changes=100))
    assert got == expected(rows) and len(got) == 2


def test_trigger_row_in_date_order(spark):
    rows = random_streaks(random.Random(3), order="date")
    df = streaks.detect_hits(to_chart(spark, rows), 10, RUN)
    by_seq = {r["seq"]: r for r in rows}
    trig = {int(r["spotifyId"]): r["snapshotDate"] for r in df.collect()}
    for k, (seq, _, _) in detect(rows, 10, RUN).items():
        assert trig[k] == by_seq[seq]["date"]


def test_restated_chart_matches_state_machine(spark):
    from chartstreak.plans.queries import restated_chart
    df = restated_chart(spark, "/root/testdata/sf0.01")
    rows = [{"key": (r["country"], r["spotifyId"]), "date": r["snapshotDate"], "rank": r["dailyRank"],
             "seq": r["seq"]} for r in df.select("country", "spotifyId", "snapshotDate", "dailyRank", "seq").collect()]
    rows.sort(key=lambda r: (r["seq"], r["key"]))
    want = {k: (n, [d.isoformat() for d in days]) for k, (_, n, days) in detect(rows, 10, 14).items()}
    got = {(r["country"], r["spotifyId"]): (r["consecutiveHitDaysCount"], list(r["consecutiveHitDaysList"]))
           for r in streaks.detect_hits_ordered(df, "seq").collect()}
    assert got == want and len(got) > 0


def test_longest_streak_and_gaps(spark):
    rows = random_streaks(random.Random(5), n_keys=50, order="date")
    chart = to_chart(spark, rows)
    ls = {int(r["spotifyId"]): r["longestStreak"] for r in streaks.longest_streak(chart).collect()}
    from statemachine import longest_run
    for k in ls:
        days = {r["date"] for r in rows if r["key"] == k and r["rank"] <= 10}
        assert ls[k] == longest_run(days)
    gaps = streaks.day_gaps(chart).where(F.col("dayGap").isNotNull()).agg(F.min("dayGap")).first()[0]
    assert gaps >= 1


def test_windows_share_one_exchange(spark):
    """The detector's windows and aggregate reuse the key partitioning."""
    from chartstreak.sources.chart import load_chart
    hits = streaks.detect_hits(load_chart(spark, "/root/testdata/sf0.001"), 10, 2)
    plan = hits._jdf.queryExecution().executedPlan().toString()
    # top rows are reduced per (key, day) (one exchange), then one exchange on the key
    assert plan.count("Exchange hashpartitioning") <= 3

"""Chart fixture: the distributed daily rank equals the per-group window rank."""

from chartstreak.sources.chart import daily_song_totals, distributed_rank, load_table, window_rank

SF01 = "/root/testdata/sf0.01"


def _ranks(df):
    return sorted((r["country"], r["snapshotDate"], r["song"], r["dailyRank"])
                  for r in df.select("country", "snapshotDate", "song", "dailyRank").collect())


def test_distributed_rank_matches_window(spark):
    events = load_table(spark, SF01, "events").select("ts", "user_id", "event_type", "value")
    totals = daily_song_totals(events, None)
    old = {k: spark.conf.get(k) for k in ("spark.sql.shuffle.partitions",
                                           "spark.sql.adaptive.coalescePartitions.enabled")}
    # many small range partitions, so (country, day) groups span several of them
    spark.conf.set("spark.sql.shuffle.partitions", "37")
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    try:
        got = distributed_rank(totals)
        spanning = (got.groupBy("country", "snapshotDate").count().where("count > 1").count())
        assert spanning > 0
        assert _ranks(got) == _ranks(window_rank(totals))
        # the shuffle join path (offset table not broadcast) gives the same ranks
        assert _ranks(distributed_rank(totals, broadcast_max_pieces=0)) == _ranks(window_rank(totals))
    finally:
        for k, v in old.items():
            spark.conf.set(k, v)

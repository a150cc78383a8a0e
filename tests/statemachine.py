"""Brute-force re-expression of the streak detector, for tests only.

Rows of one key in arrival order: a top row adds its day to a set and, the
first time the longest run of consecutive days reaches ``run``, reports
(row, longest run, sorted days); any other row removes its day.
"""

from __future__ import annotations

import datetime as dt


def longest_run(days):
    best = cur = 0
    prev = None
    for d in sorted(days):
        cur = cur + 1 if prev is not None and (d - prev).days == 1 else 1
        best = max(best, cur)
        prev = d
    return best


def detect(rows, top_n=10, run=14):
    """rows: iterable of dicts with key, date, rank, seq (already ordered)."""
    state, out = {}, {}
    for r in rows:
        k = r["key"]
        days, done = state.get(k, (set(), False))
        if r["rank"] <= top_n:
            days.add(r["date"])
            if not done:
                n = longest_run(days)
                if n >= run:
                    out[k] = (r["seq"], n, sorted(days))
                    done = True
        else:
            days.discard(r["date"])
        state[k] = (days, done)
    return out


def random_streaks(rng, n_keys=300, span=20, order="date", repeats=False):
    base = dt.date(2024, 1, 1)
    rows = []
    for k in range(n_keys):
        n = rng.randint(1, span)
        days = sorted(rng.sample(range(span), n))
        for d in days:
            rows.append({"key": k, "date": base + dt.timedelta(days=d), "rank": rng.randint(1, 14)})
        if repeats:
            for d in rng.sample(range(span), rng.randint(0, span // 2)):
                rows.append({"key": k, "date": base + dt.timedelta(days=d), "rank": rng.randint(1, 14)})
    if order == "date":
        rows.sort(key=lambda r: (r["key"], r["date"]))
    else:
        rng.shuffle(rows)
    for i, r in enumerate(rows):
        r["seq"] = i
    return rows

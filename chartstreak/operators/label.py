"""Label every chart row against the detected hits.

The hits table has at most one row per (country, spotifyId). It is joined
to the (large) chart with a left outer equi-join on the key:

* broadcast only behind a checked size: the columns the result needs are
  written to the shared folder and their bytes summed; at most
  ``broadcast_max_bytes`` go out as a broadcast hash join;
* above that, a shuffle join; AQE's skew-join split (enabled in the session)
  divides a hot key's rows over several tasks.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from chartstreak.schemas import CHART_FIELDS, KEY
from chartstreak.session import materialise

BROADCAST_MAX_BYTES = 64 << 20


def size_checked(hits: DataFrame, max_bytes: int = BROADCAST_MAX_BYTES) -> tuple[DataFrame, int]:
    """Materialise ``hits`` in the shared folder and sum the bytes of its rows.

    Returns the (broadcast-hinted when small enough) frame and its bytes as text.
    """
    hits = materialise(hits, "hits")
    size = hits.agg(F.sum(F.octet_length(F.to_json(F.struct(*hits.columns))))).first()[0] or 0
    return (F.broadcast(hits) if size <= max_bytes else hits), size


def extend(rows: DataFrame, hit: bool = False) -> DataFrame:
    """A chart row as a labelled row with (0, [], hit)."""
    return rows.select(*CHART_FIELDS,
                       F.lit(0).cast("int").alias("consecutiveHitDaysCount"),
                       F.array().cast("array<string>").alias("consecutiveHitDaysList"),
                       F.lit(hit).alias("hit"))


def label(rows: DataFrame, hits: DataFrame, mode: str = "final", emit: str = "annotate",
          order_col: str = "snapshotDate", broadcast_max_bytes: int = BROADCAST_MAX_BYTES,
          check_size: bool = True) -> DataFrame:
    """Label each row hit / not hit.

    mode="final": every row of a hit key matches.
    mode="causal": only rows strictly after the trigger row (by ``order_col``).
    emit="annotate": keep the row's own fields, add count/list/hit.
    emit="replace": a matched row becomes the stored trigger row.
    """
    if mode not in ("final", "causal") or emit not in ("annotate", "replace"):
        raise ValueError(f"mode={mode!r} emit={emit!r}")
    needed = [c for c in CHART_FIELDS if c not in KEY and (emit == "replace" or (mode == "causal" and c == order_col))]
    if mode == "causal" and order_col not in CHART_FIELDS:
        needed.append(order_col)
    h = hits.select(*KEY, *[F.col(c).alias(f"_h_{c}") for c in needed],
                    F.col("consecutiveHitDaysCount").alias("_h_count"),
                    F.col("consecutiveHitDaysList").alias("_h_list"))
    if check_size:
        h, _ = size_checked(h, broadcast_max_bytes)
    joined = rows.join(h, KEY, "left")
    matched = F.col("_h_count").isNotNull()
    if mode == "causal":
        matched = matched & (F.col(order_col) > F.col(f"_h_{order_col}"))
    out = []
    for c in CHART_FIELDS:
        if emit == "replace" and c not in KEY:
            out.append(F.when(matched, F.col(f"_h_{c}")).otherwise(F.col(c)).alias(c))
        else:
            out.append(F.col(c))
    out += [
        F.when(matched, F.col("_h_count")).otherwise(F.lit(0)).cast("int").alias("consecutiveHitDaysCount"),
        F.when(matched, F.col("_h_list")).otherwise(F.array().cast("array<string>"))
         .alias("consecutiveHitDaysList"),
        matched.alias("hit"),
    ]
    return joined.select(*out)

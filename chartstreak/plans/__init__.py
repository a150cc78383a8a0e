"""Registered queries (``REGISTRY``): name -> (build(spark, sf_dir), oracle SQL | None)."""

from chartstreak.plans import (ingest_queries, json_queries, ml_queries,  # noqa: F401  (registers)
                              profile_queries, stream_queries, wide_queries)
from chartstreak.plans.queries import REGISTRY  # noqa: F401

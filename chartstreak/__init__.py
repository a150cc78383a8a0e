"""chartstreak: daily chart analytics on Spark DataFrames.

Sub-packages:
  sources/    chart fixture, CSV ingest, JSON read/write
  functions/  Column -> Column helpers (parsing, features, text profiles)
  operators/  DataFrame -> DataFrame operators (streaks, labels, ML, importances)
  streaming/  the same operators over files arriving in a stream
  plans/      registered queries and their SQL oracles
"""

from chartstreak.session import get_session, shared_path  # noqa: F401

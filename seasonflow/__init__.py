"""seasonflow — a Spark-native season-analytics library.

Append-only game feeds (games, box scores, play-by-play, daily standings,
rosters, schedules) become deduplicated staging frames, a star schema of
dimensions and facts, and presentation marts.  Everything is expressed as
DataFrame / Spark SQL plans so Catalyst and AQE choose the physical strategy.

Layout:
  functions/  Column -> Column helpers (scalar formats, keys, dates, geometry)
  operators/  reusable relational patterns (dedup, unpivot, gap-fill, netting,
              ranking, scaling, data-quality checks)
  sources/    readers, JSON shaping, load modes, schema evolution, upsert
  plans/      domain models and the query registry bound to the test tables
  streaming/  incremental file-drop ingest (Structured Streaming)
"""

__version__ = "0.1.0"

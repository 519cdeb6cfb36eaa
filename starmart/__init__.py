"""starmart: publish an HR star schema from daily snapshots with Spark.

Layout
------
functions/  column expressions (age band, run-date flags, path parts, folding)
operators/  DataFrame -> DataFrame building blocks (rules, filters, history,
            extractors, surrogate keys, dimension merge, lookups, detail)
sources/    warehouse readers / writers (Parquet, JDBC, CSV) and snapshot loading
plans/      fact specifications, the fact refresh, publish, query catalogue
"""

__all__ = ["config", "schemas", "session", "fixtures"]

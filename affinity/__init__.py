"""affinity — Spark-native recommendation analytics.

A library of DataFrame operators and MLlib pipelines over a user–item
interaction table: profiling, reproducible hash sampling and splits, a
popularity baseline, MinHash-LSH item segments, explicit / implicit /
combined-confidence ALS, one ranking evaluator and declarative tuning grids.

Sub-packages:
    sources    table readers, fixture views over the driver tables, sinks
    functions  column-expression helpers (hash keys, confidence, metrics)
    operators  DataFrame operators grouped by concern
    plans      query catalogue (Spark queries + DuckDB oracle SQL)
    jobs       the study's batch jobs end to end, with a command line
"""

from affinity.config import Config, FIXTURE, PUBLISHED

__all__ = ["Config", "FIXTURE", "PUBLISHED"]

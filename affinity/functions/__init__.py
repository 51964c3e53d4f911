"""Column-expression helpers.  All are built from ``pyspark.sql.functions``
so they stay inside whole-stage codegen (no Python UDFs)."""

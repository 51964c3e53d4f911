"""The corpus pipeline: documents through five of the library's text operators.

Each stage takes (spark, docs, sf_dir) and returns a DataFrame that the next
stage gets as its docs, written and reread in between.

1. quality       -- lines that fail the rules are cut; rejected documents go.
2. near_copies   -- of each group of similar documents the least doc_id stays, in one row.
3. benchmark     -- passages of benchmark items are cut out of the text.
4. secrets       -- secrets are masked.
5. pieces        -- SentencePiece ids, decoded text and digests.

All but the last return the columns of documents, n_chars brought up to date.
Rows without change pass as they are.  In stage 2 a document is a doc_id (or
null) and a text: rows equal in both are one document, of which one row stays;
rows that share a doc_id, or have none, stay or go each by its own text.  Null
ids come after all others.
"""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, SparkSession, functions as F

from affinity.llm.decontaminate import decontaminate
from affinity.llm.jaccard_join import jaccard_components
from affinity.llm.quality import quality_rules
from affinity.llm.secrets import scan_secrets
from affinity.llm.sentencepiece_bpe import digests, model_path
from affinity.llm.store import Store, possibly_in
from affinity.session import scratch_path


def _with_text(docs: DataFrame, changed: DataFrame, text: str) -> DataFrame:
    """The columns of docs from ``changed``, which holds the others under their
    names and the new text as ``text``; a null text stays null."""
    new = F.when(F.col("__null"), F.lit(None).cast("string")).otherwise(F.col(text))
    return changed.select(*[new.alias(c) if c == "text" else F.length(new).cast(docs.schema[c].dataType).alias(c)
                            if c == "n_chars" else F.col(f"__{c}").alias(c) for c in docs.columns])


def _renamed(docs: DataFrame) -> tuple[DataFrame, list[str]]:
    """docs with its other columns under names that no operator uses, and those names."""
    others = [c for c in docs.columns if c not in ("text", "n_chars")]
    d = docs.select("text", F.col("text").isNull().alias("__null"), *[F.col(c).alias(f"__{c}") for c in others])
    return d, ["__null", *[f"__{c}" for c in others]]


def quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    d, names = _renamed(docs)
    row = d.select(F.struct(*names).alias("row"), "text")
    kept = quality_rules(row, key="row").where("kept").select("row.*", "clean_text")
    return _with_text(docs, kept, "clean_text")


def near_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    null = F.col("doc_id").isNull()
    other = F.lit(0).cast(docs.schema["doc_id"].dataType)
    d = docs.withColumn("__row", F.struct(null.alias("none"), F.coalesce("doc_id", other).alias("id"), F.xxhash64("text").alias("text"),
                                          F.col("text").isNull().alias("empty")))
    found = Store(spark, "copies").keep(jaccard_components(d.select("__row", "text"), key="__row"), "found")
    gone = found.where("__row <> component_id").select(F.col("__row").alias("__gone")).distinct()
    left = d.join(gone, F.col("__row") == F.col("__gone"), "left_anti").withColumn("__h", F.xxhash64("__row"))
    # Only rows that may have an equal one are dealt by it.
    again = found.groupBy("__row").count().where("count > 1").select(F.xxhash64("__row").alias("h"))
    left = possibly_in(left, "__h", again, "__maybe")
    return left.where("NOT __maybe").unionByName(left.where("__maybe").dropDuplicates(["__row"])).select(*docs.columns)


def benchmark(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    d, names = _renamed(docs)
    clean = decontaminate(d, spark.read.parquet(f"{sf_dir}/benchmark.parquet"), keep=tuple(names))
    return _with_text(docs, clean, "clean_text")


def secrets(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    d, names = _renamed(docs)
    return _with_text(docs, scan_secrets(d, keep=tuple(names)), "masked_text")


def pieces(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return digests(docs, model_path())


STAGES = [("quality rules", quality), ("n-gram Jaccard join", near_copies), ("benchmark decontamination", benchmark),
          ("secret scans", secrets), ("SentencePiece", pieces)]


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Apply the stages to documents; each result is a written table."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    base = scratch_path(spark, f"pipeline-{uuid.uuid4().hex}")
    for k, (_, stage) in enumerate(STAGES):
        out = stage(spark, docs, sf_dir)
        out.write.mode("overwrite").parquet(f"{base}/{k}")
        docs = spark.read.schema(out.schema).parquet(f"{base}/{k}")
    return docs


#: The randomness battery and the SentencePiece agenda have no SQL form.
ORACLE_SQL = None

"""Corpus preparation: each stage reads what the one before it has written."""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from salesmill.llm import near, packing, pii, quality, repeats
from salesmill.session import scratch, small_side

COLUMNS = ["doc_id", "text", "lang", "source", "n_chars"]
SEQUENCE = 2048


def as_documents(docs: DataFrame) -> DataFrame:
    """The columns of documents, with the number of characters the text has now."""
    return docs.withColumn("n_chars", F.length("text").cast("long")).select(*COLUMNS)


def quality_rules(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Without the documents that the rules reject; rows with the same or no id are judged one by one."""
    # A verdict follows from language, source and text, so these tell rows of one id apart.
    by = ("doc_id", "lang", "source", "_text")
    docs = docs.withColumn("_text", F.md5(F.coalesce("text", F.lit("")).cast("binary")))
    good = quality.judged(docs, keep=by[1:]).where("kept").select(*[F.col(c).alias(f"_{c}_kept") for c in by])
    same = [F.col(c).eqNullSafe(F.col(f"_{c}_kept")) for c in by]
    return docs.join(good, same, "left_semi").select(*COLUMNS)


def numbered(docs: DataFrame) -> tuple[DataFrame, DataFrame | None]:
    """Documents with ``_row``, which no two have: the id, or a number below all ids where it is null or in several rows.

    Also the rows that got such a number, written once, so that they keep it; None if there are none.
    """
    ids = docs.groupBy(F.col("doc_id").alias("_shared")).agg(F.count(F.lit(1)).alias("_n"))
    shared = small_side(ids.where("_n > 1 or _shared is null").select("_shared"))
    own = docs.withColumn("_row", F.col("doc_id").cast("long"))
    if shared.isEmpty():
        return own, None
    same = F.col("doc_id").eqNullSafe(F.col("_shared"))
    low = min(0, docs.agg(F.min("doc_id")).first()[0] or 0)
    below = (low - 1 if low > -(1 << 62) else -1) - F.monotonically_increasing_id()
    if low <= -(1 << 62):  # no room below: every row is numbered
        every = docs.withColumn("_row", below).checkpoint()
        return every, every
    odd = docs.join(shared, same, "left_semi").withColumn("_row", below).checkpoint()
    return own.join(shared, same, "left_anti").unionByName(odd), odd


def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near-duplicates, the one with the smallest id; a missing id is the largest.

    Rows with the same or no id are documents of their own.
    """
    rows, odd = numbered(docs)
    groups = near.classes(rows, key="_row")
    if odd is None:
        first = groups.where("kept").select(F.col("_row").alias("_kept"))
    else:
        fields = (F.col("doc_id").isNull().alias("none"), F.col("doc_id").cast("long").alias("id"), F.md5(F.col("text").cast("binary")).alias("text"), "lang", "source")
        order = odd.select(F.col("_row").alias("_n"), F.struct(*fields).alias("_order"))
        alone = F.struct(F.lit(False).alias("none"), F.col("_row").alias("id"), *[F.lit(None).cast("string").alias(c) for c in ("text", "lang", "source")])
        placed = groups.join(order, F.col("_row") == F.col("_n"), "left").withColumn("_order", F.coalesce("_order", alone))
        first = placed.groupBy("class_id").agg(F.min(F.struct("_order", "_row")).alias("_first")).select(F.col("_first._row").alias("_kept"))
    return rows.join(first, F.col("_row") == F.col("_kept"), "left_semi").select(*COLUMNS)


def repeated_passages(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """All documents, without the passages that stand in a document with a smaller id; characters stay whole."""
    out = repeats.cleaned(docs, keep=("lang", "source"), whole_characters=True)
    return as_documents(out.withColumn("text", F.col("kept").cast("string")))


def personal_data(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """All documents, personal data replaced by its kind."""
    return as_documents(pii.redacted(docs))


def packed(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Pieces of all documents with their places in sequences of at most 2048 tokens."""
    pieces = packing.cut(docs, public_tokenizers.path("byte_bpe_50k.json"), size=SEQUENCE)
    return packing.packed(pieces, size=SEQUENCE)


STAGES = [
    ("quality rules", quality_rules),
    ("near duplicates", near_duplicates),
    ("repeated passages", repeated_passages),
    ("personal data", personal_data),
    ("packing", packed),
]

#: SQL cannot express signatures, tokens and packing; the test compares with plain Python.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over ``documents``; every stage but the last is written to the shared folder and read again."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for name, stage in STAGES[:-1]:
        path = scratch(spark, name.replace(" ", "-"))
        stage(spark, docs, sf_dir).write.parquet(path)
        docs = spark.read.parquet(path)
    return STAGES[-1][1](spark, docs, sf_dir)

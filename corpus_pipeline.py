"""The corpus pipeline: stages over `documents`, each written as Parquet and reread as the next one's input."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from folioflow.llm import bpe, pii
from folioflow.llm.common import discard, staged, table
from folioflow.llm.mixing import mix
from folioflow.llm.quality import quality
from folioflow.llm.simhash import rooted

Stage = Callable[[SparkSession, DataFrame, str], DataFrame]


def _free(docs: DataFrame, name: str) -> str:
    """A column name that docs does not have."""
    taken = {c.lower() for c in docs.columns}
    while name.lower() in taken:
        name += "_"
    return name


def _keyed(docs: DataFrame) -> tuple[DataFrame, str]:
    """docs with a key of all the row holds, 128 bits of hash in hexadecimal: rows share it if they are equal in every column."""
    key = _free(docs, "_key")
    # a null leaves a hash as it was, so that a value may not stand for its neighbour's, columns are marked where they are null
    cells = [x for c in docs.columns for x in (F.col(f"`{c}`").isNull(), F.col(f"`{c}`"))]
    halves = [F.lpad(F.hex(F.xxhash64(F.lit(seed), *cells)), 16, "0") for seed in (1, 2)]
    return docs.withColumn(key, F.concat(*halves)), key


def quality_rules(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that fail the base rules or are depleted of own lines go, null and empty texts among them. Repeated rows share
    their fate; an empty table stays empty."""
    keyed, key = _keyed(docs)
    rejected = quality(keyed, (key,)).where("not kept").select(key).distinct()
    return keyed.join(rejected, key, "left_anti").select(docs.columns)


def near_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each SimHash component stays, the one with the smallest id; equal rows become one.

    A document without an id goes if its component holds one with an id. Among equal ids, or none, the key decides.
    """
    keyed, key = _keyed(docs)
    order = F.struct(F.col("doc_id").isNull().alias("none"), "doc_id", F.col(key).alias("key"))
    keep = rooted(keyed, (key,)).groupBy("root").agg(F.min(order).alias("first")).select(F.col("first.key").alias(key))
    return keyed.join(keep, key, "left_semi").dropDuplicates([key]).select(docs.columns)


def personal_data(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Every document stays; personal data in its text is replaced by its kind, and n_chars follows the text."""
    names = [c if c == "text" else f"c{i}" for i, c in enumerate(docs.columns)]  # no column clashes with what the scan adds
    d = pii.scan(docs.toDF(*names), redacted=True).select(names).toDF(*docs.columns)
    if "n_chars" in docs.columns:
        d = d.withColumn("n_chars", F.when(F.col("n_chars").isNotNull(), F.length("text").cast("long")))
    return d.select(docs.columns)


def mixing(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Sources in their target weights: a document that is taken k times becomes k rows."""
    keyed, key = _keyed(docs)
    times = _free(docs, "_times")
    copies = mix(keyed, (key,)).where("copies > 0").groupBy(key).agg(F.sum("copies").alias(times))
    taken = keyed.dropDuplicates([key]).join(copies, key)
    return taken.withColumn(times, F.explode(F.sequence(F.lit(1), F.col(times).cast("int")))).select(docs.columns)


def tokens(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Token ids of every whole text, and whether decoding them gave the text back. Null texts have none; repeated rows stay."""
    d = bpe.encoded(docs, bpe.default_tokenizer(), ["doc_id", "lang", "source", "text"])
    return d.select("doc_id", "lang", "source", "n_tokens", "ids", (F.coalesce("text", F.lit("")) == F.col("decoded")).alias("exact"))


STAGES: list[tuple[str, Stage]] = [
    ("quality rules", quality_rules),
    ("simhash near-dedup", near_dedup),
    ("personal data", personal_data),
    ("mixing", mixing),
    ("bpe", tokens),
]
#: SimHash components, the random field, hashed sampling and BPE have no SQL; the stages are tested against brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    last = None
    for k, (_, stage) in enumerate(STAGES):
        docs = stage(spark, docs, sf_dir)
        if k < len(STAGES) - 1:
            docs = staged(docs, "stage")
            if last is not None:
                discard(last)
            last = docs
    return docs

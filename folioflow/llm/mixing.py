"""Mixing sources to target weights by Pareto order sampling."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from .common import WORD, staged, table

#: Weights of the sources in code-point order, repeating.
WEIGHTS = (5, 2, 1)
MOST = 3
#: The ranking key is cut into so many ranges, the one in which a source's quota ends into so many again, and so on DEPTH
#: times; only rows of the last such range are ordered one by one.
RANGES = 256
DEPTH = 3


def word_count(text: str = "text") -> Column:
    return F.coalesce(F.regexp_count(F.col(text), F.lit(WORD)), F.lit(0)).cast("long")


def source_targets(sizes: DataFrame, weights: tuple[int, ...] = WEIGHTS, most: int = MOST) -> DataFrame:
    """(src, source_size, target) from (src, source_size).

    The total is shared by weight; a target stops at `most` times its source and the excess goes to the others by weight.
    That is a water level: target = min(cap, level * weight). The level is raised until it no longer moves; every round
    is one aggregate whose single row comes to the driver.
    """
    # ranks by code point: sorted ranges of sources, each ranked by itself, after the number of sources in the ranges before
    ranged = staged(sizes.repartitionByRange(F.col("src").asc_nulls_last()).withColumn("piece", F.spark_partition_id()), "ranges")
    pieces = ranged.groupBy("piece").agg(F.count(F.lit(1)).alias("n"))
    before = F.coalesce(F.sum("n").over(Window.orderBy("piece").rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))
    sizes = ranged.join(F.broadcast(pieces.select("piece", before.alias("before"))), "piece")
    rank = F.row_number().over(Window.partitionBy("piece").orderBy(F.col("src").asc_nulls_last())) - 1 + F.col("before")
    weight = F.element_at(F.lit(list(weights)), (rank % len(weights) + 1).cast("int")).cast("double")
    s = staged(sizes.select("src", "source_size", weight.alias("w"), (F.col("source_size") * most).cast("double").alias("cap")), "targets")
    total = s.agg(F.coalesce(F.sum("source_size"), F.lit(0))).first()[0]
    level = 0.0
    while True:
        full = F.col("cap") <= F.lit(level) * F.col("w")
        capped, free = s.agg(F.sum(F.when(full, F.col("cap")).otherwise(0.0)), F.sum(F.when(full, 0.0).otherwise(F.col("w")))).first()
        if not free or (now := (total - capped) / free) <= level:
            break
        level = now
    return s.select("src", "source_size", F.least("cap", F.lit(level) * F.col("w")).alias("target"))


def mix(docs: DataFrame, keys: tuple[str, ...] = ("doc_id",), seed: int = 20) -> DataFrame:
    """One row per document: the keys, size, source_size, target, copies, taken.

    A source that is to give m times its words gives floor(m) whole copies of each document. The rest of its quota is a
    Pareto sample: document i has inclusion probability p_i, a uniform number u_i hashed from its id and text, and the
    key (u_i / (1 - u_i)) / (p_i / (1 - p_i)); documents enter by rising key until their words fill the quota, the last
    one only if half of it fits. p_i rises with a document's size up to its source's mean size, so fragments come more
    rarely. Where the quota ends is found by adding up words in ranges of the key, and in ranges of the range in which it
    ends, so no source is sorted in one task.

    Null texts have size 0; documents without a source form one source, the last. Rows that agree in id and text have
    the same key, and their order among themselves does not show; rows of one key are ordered in one task if the quota ends
    there. Repeated rows stay. An empty table gives an empty result.
    """
    u = (F.shiftrightunsigned(F.xxhash64(F.lit(seed), *keys, "text"), 11).cast("double") + 0.5) / float(1 << 53)
    sized = staged(docs.select(*keys, F.col("source").alias("src"), word_count().alias("size"), u.alias("u")), "sizes")
    by_source = sized.groupBy("src").agg(F.sum("size").alias("source_size"), F.avg("size").alias("mean"))
    targets = source_targets(by_source.select("src", "source_size"))
    times = F.when(F.col("source_size") > 0, F.col("target") / F.col("source_size")).otherwise(0.0)
    whole = F.floor(times + 1e-12)
    mean = by_source.select(F.col("src").alias("src_"), "mean")
    plan = targets.join(mean, F.col("src").eqNullSafe(F.col("src_"))).select("src", "source_size", "target", "mean", whole.alias("whole"), F.greatest(F.lit(0.0), F.col("target") - whole * F.col("source_size")).alias("quota"))
    weight = F.greatest(F.lit(1.0), F.least("size", "mean"))
    d = sized.join(plan.withColumnRenamed("src", "src_"), F.col("src").eqNullSafe(F.col("src_"))).withColumn("weight", weight)
    # the quota over the words that a unit of weight is expected to bring
    scale = d.groupBy("src_").agg(F.sum(F.col("weight") * F.col("size")).alias("brought"))
    plan = plan.join(scale, F.col("src").eqNullSafe(F.col("src_"))).select(F.col("src").alias("src_"), "source_size", "target", "mean", "whole", "quota", "brought")
    plan = staged(plan, "plan")
    d = sized.join(plan, F.col("src").eqNullSafe(F.col("src_"))).withColumn("weight", weight)
    p = F.when(F.col("brought") > 0, F.col("quota") * F.col("weight") / F.col("brought")).otherwise(0.0)
    p = F.least(F.greatest(p, F.lit(1e-9)), F.lit(1 - 1e-9))
    odds = (F.col("u") / (1 - F.col("u"))) / (p / (1 - p))
    d = d.withColumn("key", odds / (1 + odds)).withColumn("part", F.floor(F.col("key") * float(RANGES**DEPTH)))
    d = staged(d.select(*keys, "src", "size", "source_size", "target", "whole", "quota", "key", "part"), "ranked")
    ends = None
    for depth in range(1, DEPTH + 1):
        at = F.floor(F.col("part") / RANGES ** (DEPTH - depth))
        inner = d if ends is None else d.join(ends, F.col("src").eqNullSafe(F.col("src_")) & (F.floor(F.col("part") / RANGES ** (DEPTH - depth + 1)) == F.col("end")))
        base = F.lit(0).cast("long") if ends is None else F.col("before")
        parts = inner.groupBy("src", at.alias("at")).agg(F.sum("size").alias("words"), F.max("quota").alias("quota"), F.max(base).alias("base"))
        before = F.coalesce(F.sum("words").over(Window.partitionBy("src").orderBy("at").rowsBetween(Window.unboundedPreceding, -1)), F.lit(0)) + F.col("base")
        parts = parts.withColumn("before", before).where((F.col("before") < F.col("quota")) & (F.col("before") + F.col("words") >= F.col("quota")))
        ends = staged(parts.select(F.col("src").alias("src_"), F.col("at").alias("end"), "before"), "ends")
    d = d.join(ends, F.col("src").eqNullSafe(F.col("src_")), "left").drop("src_")
    certain = d.where(F.col("end").isNull() | (F.col("part") != F.col("end")))
    open_ = (F.col("quota") > 0) & (F.col("end").isNull() | (F.col("part") < F.col("end")))
    certain = certain.withColumn("more", F.when(open_, 1).otherwise(0))
    order = Window.partitionBy("src").orderBy("key", *keys, "size")
    upto = F.sum("size").over(order.rowsBetween(Window.unboundedPreceding, 0))
    last = d.where(F.col("part") == F.col("end")).withColumn("upto", upto + F.col("before"))
    last = last.withColumn("more", F.when(F.col("upto") - F.col("size") / 2 <= F.col("quota"), 1).otherwise(0)).drop("upto")
    copies = (F.col("whole") + F.col("more")).cast("long")
    out = certain.unionByName(last).select(*keys, "size", "source_size", "target", copies.alias("copies"))
    return out.withColumn("taken", F.col("copies") * F.col("size"))


def op10_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return mix(table(spark, sf_dir, "documents"))

"""Document-wide clean-up: page furniture, prose inside tables, heading levels, repeated figures."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from folioflow.config import PAGE_HEIGHT, Cleaning
from folioflow.functions import geometry as G
from folioflow.functions import text as T


def _prose():
    return F.col("type").isin("text", "title") & ~T.is_blank(F.col("content"))


def _keyed(units: DataFrame) -> DataFrame:
    return units.withColumn("_bucket", G.bucket(F.col("bbox.y0"), 8)).withColumn("_norm", T.furniture_norm(F.col("content")))


def with_heights(d: DataFrame, heights: DataFrame | None) -> DataFrame:
    """d with `_h`, the height of its page; pages that are not known are A4."""
    if heights is None:
        return d.withColumn("_h", F.lit(PAGE_HEIGHT))
    return d.join(heights.select("doc_id", "page", F.col("height").alias("_h")), ["doc_id", "page"], "left").withColumn("_h", F.coalesce("_h", F.lit(PAGE_HEIGHT)))


def furniture_keys(units: DataFrame, heights: DataFrame | None = None, cfg: Cleaning | None = None) -> DataFrame:
    """(doc_id, bucket, norm, pages): texts that stand at one height in the head or foot of several pages."""
    cfg = cfg or Cleaning()
    d = with_heights(_keyed(units.where(_prose())), heights)
    d = d.where(G.in_band(F.col("bbox"), F.col("_h"), cfg.head_band))
    g = d.groupBy("doc_id", F.col("_bucket").alias("bucket"), F.col("_norm").alias("norm")).agg(F.count_distinct("page").alias("pages"))
    return g.where(F.col("pages") >= cfg.head_pages)


def strip_furniture(units: DataFrame, heights: DataFrame | None = None, cfg: Cleaning | None = None) -> DataFrame:
    """Units without furniture. Whether a text is furniture is decided in the bands; then it goes wherever it stands."""
    keys = furniture_keys(units, heights, cfg).select(F.col("doc_id").alias("_d"), F.col("bucket").alias("_b"), F.col("norm").alias("_n"))
    d = _keyed(units)
    same = (F.col("doc_id") == F.col("_d")) & (F.col("_bucket") == F.col("_b")) & (F.col("_norm") == F.col("_n"))
    # only text and titles can match; the type test is part of the join so that one anti join does
    return d.join(keys, same & _prose(), "left_anti").select(units.columns)


def outside_tables(units: DataFrame, tables: DataFrame) -> DataFrame:
    """Units without the text and titles whose middle lies in a table of their page. Transcribed units stay: their box is the page."""
    spans = tables.select(F.col("doc_id").alias("_d"), F.explode("page_spans").alias("_s")).select("_d", F.col("_s.page").alias("_p"), F.col("_s.bbox").alias("_t"))
    inside = F.col("type").isin("text", "title") & (F.col("source") != "gemini") & G.centre_in(F.col("bbox"), F.col("_t"))
    return units.join(spans, (F.col("doc_id") == F.col("_d")) & (F.col("page") == F.col("_p")) & inside, "left_anti")


def heading_levels(units: DataFrame, cfg: Cleaning | None = None) -> DataFrame:
    """Titles get a level: their own, else the depth of their number, else the rank of their size in whole points
    among those of their source, else 1; at most the deepest."""
    cfg = cfg or Cleaning()
    title = F.col("type") == "title"
    sized = title & (F.coalesce("font_size", F.lit(0.0)) > 0)
    rank = F.dense_rank().over(Window.partitionBy("doc_id", "source", sized).orderBy(F.bround("font_size").desc()))
    level = F.coalesce("level", T.numbering_depth(F.col("content")), F.when(sized, rank), F.lit(1))
    return units.withColumn("level", F.when(title, F.least(level, F.lit(cfg.deepest))).otherwise(F.col("level")).cast("int"))


def figure_dedup(units: DataFrame, digests: DataFrame) -> DataFrame:
    """Of figures with the same content in a document the first stays; figures without stored content all stay.

    digests: doc_id, storage_key, digest.
    """
    d = units.join(digests.select("doc_id", "storage_key", "digest"), ["doc_id", "storage_key"], "left")
    fig = (F.col("type") == "figure") & F.col("digest").isNotNull()
    nth = F.row_number().over(Window.partitionBy("doc_id", fig, F.when(fig, F.col("digest")), F.when(~fig, F.struct("page", "seq"))).orderBy("page", "seq"))
    return d.withColumn("_n", nth).where("_n = 1").select(units.columns)

"""Page evidence and the lane a page takes."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from folioflow.config import Lanes
from folioflow.functions import geometry as G
from folioflow.functions import text as T


def profile_pages(pages: DataFrame, rules: Lanes | None = None, exact_coverage: bool = False) -> DataFrame:
    """(doc_id, page) and eight measurements. Vector items are only looked at where there is little text; null says not measured.

    pages: doc_id, page, width, height, text, images, text_blocks, n_drawings. Coverage is rounded to three places before it is
    judged, unless it is to be exact, as the first version of the rules had it.
    """
    rules = rules or Lanes()
    t = T.strip(F.coalesce("text", F.lit("")))
    page_area = F.col("width") * F.col("height")
    d = pages.withColumn("text", t)
    return d.select(
        "doc_id", "page", F.length("text").alias("text_chars"), T.compact_length(F.col("text")).alias("text_compact_chars"),
        T.junk_count(F.col("text")).alias("junk_chars"), T.mojibake_count(F.col("text")).alias("mojibake_chars"),
        G.coverage(F.col("images"), page_area, exact_coverage).alias("max_image_coverage"), G.text_share(F.col("text_blocks"), page_area).alias("text_bbox_area_frac"),
        F.when(F.length("text") < rules.least_text, F.col("n_drawings")).alias("vector_segments"),
    )


def route_pages(profiles: DataFrame, rules: Lanes | None = None, first_reason_only: bool = False) -> DataFrame:
    """(doc_id, page, extractor, reasons): raster over everything, then the text layer, then drawings, then the paid lane."""
    r = rules or Lanes()
    n = F.greatest(F.lit(1), F.col("text_compact_chars"))
    raster = F.col("max_image_coverage") > r.raster_share
    has_text = F.col("text_chars") >= r.least_text
    junk = (F.col("junk_chars") >= r.junk[0]) | (F.col("junk_chars") / n >= r.junk[1])
    mojibake = (F.col("mojibake_chars") >= r.mojibake[0]) | (F.col("mojibake_chars") / n >= r.mojibake[1])
    drawing = F.coalesce(F.col("vector_segments") >= r.least_vectors, F.lit(False))
    extractor = F.when(raster, "vlm").when(has_text & (junk | mojibake), "vlm").when(has_text, "native").when(drawing, "drawing").otherwise("vlm")
    reasons = (
        F.when(raster, F.array(F.lit("raster covers the page")))
        .when(has_text & (junk | mojibake), F.array_compact(F.array(F.when(junk, F.format_string("junk characters: %d", "junk_chars")), F.when(mojibake, F.format_string("mojibake characters: %d", "mojibake_chars")))))
        .when(has_text, F.array(F.format_string("clean text: %d characters", "text_chars")))
        .when(drawing, F.array(F.format_string("drawing: %d vector items", "vector_segments")))
        .otherwise(F.array(F.format_string("little text: %d characters", "text_chars")))
    )
    return profiles.select("doc_id", "page", extractor.alias("extractor"), (F.slice(reasons, 1, 1) if first_reason_only else reasons).alias("reasons"))


def route_counts(routes: DataFrame) -> DataFrame:
    return routes.groupBy("doc_id", "extractor").agg(F.count(F.lit(1)).alias("pages"))


def text_layer_evidence(profiles: DataFrame, routes: DataFrame, rules: Lanes | None = None) -> DataFrame:
    """For pages of the paid lane, the length of a text layer that can be counted on, else null."""
    r = rules or Lanes()
    d = profiles.join(routes.select("doc_id", "page", "extractor"), ["doc_id", "page"]).where("extractor = 'vlm'")
    known = (F.col("text_chars") >= r.least_text) & (F.col("max_image_coverage") <= r.raster_share)
    return d.select("doc_id", "page", F.when(known, F.col("text_chars")).alias("text_layer_chars"))

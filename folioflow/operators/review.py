"""The quality gate: every reason for a human to look, in one place."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from folioflow.config import Stitching
from folioflow.functions import text as T
from folioflow.operators import tables as TB


def unit_reasons(units: DataFrame, transcripts: DataFrame) -> DataFrame:
    """units with `reasons`. Native text: junk, or else marks without their letter. Transcribed: the page's reasons, and unread regions.

    transcripts: doc_id, page, review_reasons.
    """
    d = units.join(transcripts.select("doc_id", "page", F.col("review_reasons").alias("_r")), ["doc_id", "page"], "left")
    native = (F.col("source") == "pymupdf") & F.col("type").isin("text", "title")
    empty = F.array().cast("array<string>")
    mark = F.when(T.has_junk(F.col("content")), F.lit("junk characters in native text")).when(T.orphan_marks(F.col("content")) > 0, F.lit("marks without their letter in native text"))
    unread = F.when(F.contains("content", F.lit(T.ILLEGIBLE)), F.lit("region marked illegible"))
    reasons = F.when(native, F.array_compact(F.array(mark))).when(F.col("source") == "gemini", F.concat(F.coalesce("_r", empty), F.array_compact(F.array(unread)))).otherwise(empty)
    return d.withColumn("reasons", reasons).drop("_r").select(*units.columns, "reasons")


def gate_units(units: DataFrame, transcripts: DataFrame) -> DataFrame:
    """Units with the flag set where a reason fires; flags set before stay."""
    d = unit_reasons(units, transcripts)
    return d.withColumn("needs_review", F.coalesce("needs_review", F.lit(False)) | (F.size("reasons") > 0)).drop("reasons")


def gate_tables(tables: DataFrame, cfg: Stitching | None = None, marks: bool = True) -> DataFrame:
    """Tables with reason, flag and key of the crop; a rejected table loses its renderings, not its cells. Without `marks`, cells
    are junk by their characters alone, as in the first version."""
    junk = TB.junk_cells(F.col("cells"), marks)
    reason = F.coalesce(TB.validation_reason(F.col("cells"), (cfg or Stitching()).filled), F.when((F.col("source") == "find_tables") & (junk > 0), F.format_string("junk in %d cells", junk)))
    d = tables.withColumn("review_reason", reason).withColumn("needs_review", F.col("review_reason").isNotNull())
    d = d.withColumn("crop_key", F.when(F.col("needs_review"), F.format_string("figures/%s_review.png", "table_id")))
    return d.withColumns({c: F.when(F.col("needs_review"), F.lit("")).otherwise(F.col(c)) for c in ("markdown", "grid")}).select(tables.columns)


def review_items(units: DataFrame, transcripts: DataFrame, gated: DataFrame) -> DataFrame:
    """(doc_id, item, page, kind, reason, excerpt, crop_key): units in order, then tables."""
    u = unit_reasons(units, transcripts).where(F.size("reasons") > 0)
    u = u.select("doc_id", "page", F.col("type").alias("kind"), F.array_join("reasons", "; ").alias("reason"), T.excerpt(F.col("content")).alias("excerpt"), F.lit(None).cast("string").alias("crop_key"), F.lit(0).alias("_k"), F.col("page").cast("long").alias("_a"), F.col("seq").cast("long").alias("_b"), F.lit("").alias("_c"))
    t = gated.where("needs_review")
    t = t.select("doc_id", F.get("page_spans", F.lit(0))["page"].alias("page"), F.lit("table").alias("kind"), F.col("review_reason").alias("reason"), F.concat(F.lit("table "), "table_id").alias("excerpt"), "crop_key", F.lit(1).alias("_k"), F.lit(0).cast("long").alias("_a"), F.lit(0).cast("long").alias("_b"), F.col("table_id").alias("_c"))
    d = u.unionByName(t)
    item = F.row_number().over(Window.partitionBy("doc_id").orderBy("_k", "_a", "_b", "_c")) - 1
    return d.select("doc_id", item.alias("item"), "page", "kind", "reason", "excerpt", "crop_key")


def review_report(items: DataFrame, docs: DataFrame) -> DataFrame:
    """(doc_id, report): markdown by page, pages counted from 1."""
    line = F.concat(F.lit("\n- **"), "kind", F.lit("** — "), "reason", F.when(F.col("excerpt") != "", F.concat(F.lit("\n  - excerpt: `"), "excerpt", F.lit("`"))).otherwise(""), F.when(F.col("crop_key").isNotNull(), F.concat(F.lit("\n  - crop: ![" ), "excerpt", F.lit("]("), "crop_key", F.lit(")"))).otherwise(""))
    ordered = lambda c: F.array_sort(F.collect_list(F.struct(*c)))
    page = items.withColumn("line", line).groupBy("doc_id", "page").agg(ordered(["item", "line"]).alias("x"), F.count(F.lit(1)).alias("n"))
    page = page.select("doc_id", "page", "n", F.concat(F.lit("\n## Page "), (F.col("page") + 1).cast("string"), F.lit("\n"), F.array_join(F.transform("x", lambda y: y["line"]), "\n")).alias("text"))
    doc = page.groupBy("doc_id").agg(ordered(["page", "text"]).alias("x"), F.sum("n").alias("n"))
    doc = docs.select("doc_id").distinct().join(doc, "doc_id", "left")
    some = F.concat(F.col("n").cast("string"), F.lit(" item(s) need human eyes, grouped by page.\n"), F.array_join(F.transform("x", lambda y: y["text"]), "\n"), F.lit("\n"))
    return doc.select("doc_id", F.concat(F.lit("# Review report — "), "doc_id", F.lit("\n\n"), F.coalesce(some, F.lit("Nothing flagged. Every extracted item passed its validator.\n"))).alias("report"))

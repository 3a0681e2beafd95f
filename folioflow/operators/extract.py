"""Units of native pages: headings, paragraphs and figures from decoded spans; ruled grids from drawings.

Pages come decoded: blocks of lines of spans (text, size, flags), image blocks with a box, drawings as lines and
rectangles. Order is kept in explicit columns; every window is by page.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from folioflow.config import Native
from folioflow.functions import geometry as G
from folioflow.functions import text as T

BOLD = 16
BODY_FONT = 10.0


def page_sample(pages: DataFrame, most: int = 60) -> DataFrame:
    """Every step-th page of a document, step = pages // most, the first `most` of them. Deterministic, unlike sample()."""
    by_doc = Window.partitionBy("doc_id")
    d = pages.withColumn("rn", F.row_number().over(by_doc.orderBy("page")) - 1).withColumn("n", F.count(F.lit(1)).over(by_doc))
    step = F.greatest(F.lit(1), F.floor(F.col("n") / most)).cast("int")
    return d.where((F.col("rn") % step == 0) & (F.floor(F.col("rn") / step) < most)).drop("rn", "n")


def spans(pages: DataFrame) -> DataFrame:
    """One row per span: doc_id, page, block, line, span, text, size, flags, line_box."""
    b = pages.select("doc_id", "page", F.posexplode("blocks").alias("block", "b")).where("b.type = 0")
    ls = b.select("doc_id", "page", "block", F.posexplode("b.lines").alias("line", "l"))
    s = ls.select("doc_id", "page", "block", "line", F.col("l.bbox").alias("line_box"), F.posexplode("l.spans").alias("span", "s"))
    return s.select("doc_id", "page", "block", "line", "line_box", "span", "s.text", "s.size", "s.flags")


def body_font_size(pages: DataFrame, cfg: Native | None = None) -> DataFrame:
    """(doc_id, body_size): the rounded size with most characters on sampled pages, the first seen of equals; 10.0 if none."""
    cfg = cfg or Native()
    s = spans(page_sample(pages, cfg.font_pages)).withColumn("chars", F.length(T.strip(F.col("text")))).where("chars > 0")
    sizes = s.groupBy("doc_id", F.bround("size").alias("size")).agg(F.sum("chars").alias("chars"), F.min(F.struct("page", "block", "line", "span")).alias("first"))
    top = sizes.groupBy("doc_id").agg(F.min(F.struct((-F.col("chars")).alias("c"), "first", "size"))["size"].alias("body_size"))
    docs = pages.select("doc_id").distinct()
    return docs.join(top, "doc_id", "left").select("doc_id", F.coalesce("body_size", F.lit(BODY_FONT)).alias("body_size"))


def lines(pages: DataFrame, body: DataFrame, cfg: Native | None = None) -> DataFrame:
    """One row per line with text: its text, the size of its longest span (the first of equals), whether it is a heading."""
    cfg = cfg or Native()
    key = ["doc_id", "page", "block", "line"]
    s = spans(pages)
    main = F.when(~T.is_blank(F.col("text")), F.struct((-F.length("text")).alias("n"), "span", "size", "flags"))
    g = s.groupBy(*key).agg(F.first("line_box").alias("box"), F.array_sort(F.collect_list(F.struct("span", "text"))).alias("parts"), F.min(main).alias("main"))
    g = g.withColumn("text", T.collapse(F.array_join(F.transform("parts", lambda p: p["text"]), ""))).where("text <> '' and main is not null")
    d = g.join(body, "doc_id")
    heading = (F.col("main.size") >= F.col("body_size") * cfg.title_ratio) | ((F.col("main.flags").bitwiseAND(BOLD) != 0) & T.is_numbered(F.col("text"), cfg.title_number))
    return d.select(*key, "box", "text", F.col("main.size").alias("size"), heading.alias("is_heading"))


def native_units(pages: DataFrame, body: DataFrame, cfg: Native | None = None, flag_junk: bool = False) -> DataFrame:
    """Units of native pages in reading order: doc_id, page, seq, bbox, type, content, level, font_size, storage_key, source, needs_review.

    A heading line is a unit; body lines between headings of a block are one paragraph; image blocks of some size are figures.
    Texts are not judged here but by the gate; the first version flagged paragraphs with junk at once (`flag_junk`).
    """
    cfg = cfg or Native()
    within = Window.partitionBy("doc_id", "page", "block").orderBy("line")
    ls = lines(pages, body, cfg).withColumn("island", F.sum(F.col("is_heading").cast("int")).over(within))
    heads = ls.where("is_heading").select("doc_id", "page", "block", "line", F.col("box").alias("bbox"), F.lit("title").alias("type"), F.col("text").alias("content"), F.bround("size", 1).alias("font_size"))
    union = G.box(F.min("box.x0"), F.min("box.y0"), F.max("box.x1"), F.max("box.y1"))
    joined = F.array_join(F.transform(F.array_sort(F.collect_list(F.struct("line", "text"))), lambda x: x["text"]), " ")
    body_lines = ls.where("not is_heading").groupBy("doc_id", "page", "block", "island").agg(F.min("line").alias("line"), union.alias("bbox"), joined.alias("content"))
    paras = body_lines.select("doc_id", "page", "block", "line", "bbox", F.lit("text").alias("type"), "content", F.lit(None).cast("double").alias("font_size"))
    b = pages.select("doc_id", "page", (F.col("width") * F.col("height")).alias("area"), F.posexplode("blocks").alias("block", "b")).where("b.type = 1")
    figs = b.where((F.col("area") > 0) & (G.area(F.col("b.bbox")) / F.col("area") >= cfg.figure_share))
    figs = figs.select("doc_id", "page", "block", F.lit(0).alias("line"), F.col("b.bbox").alias("bbox"), F.lit("figure").alias("type"), F.lit("").alias("content"), F.lit(None).cast("double").alias("font_size"))
    d = heads.unionByName(paras).unionByName(figs)
    page = Window.partitionBy("doc_id", "page")
    nth = F.sum(F.when(F.col("type") == "figure", 1).otherwise(0)).over(page.orderBy("block", "line")) - 1
    flagged = (F.col("type") == "text") & T.has_junk(F.col("content")) if flag_junk else F.lit(False)
    key = F.when(F.col("type") == "figure", F.format_string("figures/p%04d_f%02d.png", F.col("page").cast("int"), nth.cast("int")))
    d = d.withColumn("storage_key", key).withColumn("seq", F.row_number().over(page.orderBy("block", "line")).cast("long") - 1)
    return d.select("doc_id", "page", "seq", "bbox", "type", "content", F.lit(None).cast("int").alias("level"), "font_size", "storage_key", F.lit("pymupdf").alias("source"), flagged.alias("needs_review"))


def drawing_units(pages: DataFrame, routes: DataFrame) -> DataFrame:
    """One full-page figure for each page of the drawing lane."""
    d = pages.join(routes.where("extractor = 'drawing'").select("doc_id", "page"), ["doc_id", "page"])
    return d.select(
        "doc_id", "page", F.lit(0).cast("long").alias("seq"), G.box(0, 0, F.col("width"), F.col("height")).alias("bbox"), F.lit("figure").alias("type"), F.lit("").alias("content"),
        F.lit(None).cast("int").alias("level"), F.lit(None).cast("double").alias("font_size"), F.format_string("figures/p%04d_page.png", F.col("page").cast("int")).alias("storage_key"),
        F.lit("pymupdf").alias("source"), F.lit(False).alias("needs_review"),
    )


def region_figures(regions: DataFrame) -> DataFrame:
    """Figures that the detector saw on pages of the paid lane; the index counts all regions of the page."""
    d = regions.where("label = 'figure'")
    return d.select("doc_id", "page", "idx", F.col("box_pdf").alias("bbox"), F.format_string("figures/p%04d_r%d.png", F.col("page").cast("int"), F.col("idx").cast("int")).alias("storage_key"))


def ruled_grids(drawings: DataFrame, cfg: Native | None = None) -> DataFrame:
    """(doc_id, page, h_segments, v_segments, bbox) of pages whose drawings form a grid.

    drawings: doc_id, page, kind (l line, re rectangle), x0, y0, x1, y1. A rectangle is its four edges. Segments are
    rounded to a tenth and counted once; thin long ones are rules.
    """
    cfg = cfg or Native()
    lo, hi = (lambda a, b: F.least(a, b)), (lambda a, b: F.greatest(a, b))
    d = drawings.select("doc_id", "page", "kind", lo("x0", "x1").alias("x0"), lo("y0", "y1").alias("y0"), hi("x0", "x1").alias("x1"), hi("y0", "y1").alias("y1"))
    edge = lambda a, b, c, e: F.struct(F.col(a).alias("x0"), F.col(b).alias("y0"), F.col(c).alias("x1"), F.col(e).alias("y1"))
    edges = F.when(F.col("kind") == "re", F.array(edge("x0", "y0", "x1", "y0"), edge("x0", "y1", "x1", "y1"), edge("x0", "y0", "x0", "y1"), edge("x1", "y0", "x1", "y1")))
    s = d.select("doc_id", "page", F.explode(edges.otherwise(F.array(edge("x0", "y0", "x1", "y1")))).alias("s")).select("doc_id", "page", "s.*")
    horizontal = (F.col("y1") - F.col("y0") < 1.0) & (F.col("x1") - F.col("x0") > 5.0)
    vertical = (F.col("x1") - F.col("x0") < 1.0) & (F.col("y1") - F.col("y0") > 5.0)
    s = s.withColumn("dir", F.when(horizontal, "h").when(vertical, "v")).where("dir is not null")
    s = s.select("doc_id", "page", "dir", *(F.bround(c, 1).alias(c) for c in ("x0", "y0", "x1", "y1"))).distinct()
    g = s.groupBy("doc_id", "page").agg(F.count_if(F.col("dir") == "h").alias("h_segments"), F.count_if(F.col("dir") == "v").alias("v_segments"), G.box(F.min("x0"), F.min("y0"), F.max("x1"), F.max("y1")).alias("bbox"))
    return g.where((F.col("h_segments") >= cfg.rules_across) & (F.col("v_segments") >= cfg.rules_down))

"""The registered queries: operators over the benchmark tables, flat columns only."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from folioflow.config import Config
from folioflow.functions import geometry as G
from folioflow.functions import text as T
from folioflow.operators import chunks as C
from folioflow.operators import extract as X
from folioflow.operators import normalize as N
from folioflow.operators import profile as P
from folioflow.operators import review as R
from folioflow.operators import tables as TB
from folioflow.operators import transcripts as V
from folioflow.sources import tables as S

Query = Callable[[SparkSession, str], DataFrame]


def _list(c: Column | str) -> Column:
    return F.array_join(c.cast("array<string>") if not isinstance(c, str) else F.col(c).cast("array<string>"), "|")


def route_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return P.route_counts(P.route_pages(P.profile_pages(S.pages_in(spark, sf_dir))))


def page_profiles(spark: SparkSession, sf_dir: str) -> DataFrame:
    return P.profile_pages(S.pages_in(spark, sf_dir))


def page_routes(spark: SparkSession, sf_dir: str) -> DataFrame:
    return P.route_pages(page_profiles(spark, sf_dir)).withColumn("reasons", _list("reasons"))


def page_routes_first_reason(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The first version's rules: one reason to a page, coverage not rounded."""
    return P.route_pages(P.profile_pages(S.pages_in(spark, sf_dir), exact_coverage=True), first_reason_only=True).withColumn("reasons", _list("reasons"))


def text_layer_evidence(spark: SparkSession, sf_dir: str) -> DataFrame:
    p = page_profiles(spark, sf_dir)
    return P.text_layer_evidence(p, P.route_pages(p))


def text_scores(spark: SparkSession, sf_dir: str) -> DataFrame:
    t = F.col("text")
    d = S.pages_in(spark, sf_dir)
    compact = T.compact_length(t)
    return d.select("doc_id", "page", T.junk_count(t).alias("junk"), T.orphan_marks(t).alias("orphans"), T.interleaved_symbols(t).alias("symbols"), T.ratio(T.junk_count(t), compact).alias("junk_ratio"), T.ratio(T.mojibake_count(t), compact).alias("mojibake_ratio"))


def text_forms(spark: SparkSession, sf_dir: str) -> DataFrame:
    d = S.units_in(spark, sf_dir)
    c = F.col("content")
    return d.select("doc_id", "seq", T.furniture_norm(c).alias("furniture"), T.numbering_depth(c).alias("depth"), T.is_numbered(c, r"^\d+(\.\d+)*\.?\s+\S").alias("numbered"), T.token_estimate(c).alias("tokens"), T.excerpt(c).alias("excerpt"), T.escape_cell(c).alias("escaped"), T.collapse(c).alias("collapsed"))


def page_sample(spark: SparkSession, sf_dir: str) -> DataFrame:
    return X.page_sample(S.pages_in(spark, sf_dir).select("doc_id", "page"), Config().native.font_pages)


def body_font_size(spark: SparkSession, sf_dir: str) -> DataFrame:
    return X.body_font_size(S.spans_in(spark, sf_dir))


def native_units(spark: SparkSession, sf_dir: str) -> DataFrame:
    p = S.spans_in(spark, sf_dir)
    d = X.native_units(p, X.body_font_size(p))
    return d.select("doc_id", "page", "seq", "type", "content", "font_size", "storage_key", F.col("bbox.y0").alias("y0"), F.col("bbox.y1").alias("y1"))


def drawing_units(spark: SparkSession, sf_dir: str) -> DataFrame:
    p = S.pages_in(spark, sf_dir)
    d = X.drawing_units(p, P.route_pages(P.profile_pages(p)))
    return d.select("doc_id", "page", "storage_key", F.col("bbox.x1").alias("x1"), F.col("bbox.y1").alias("y1"))


def ruled_grids(spark: SparkSession, sf_dir: str) -> DataFrame:
    d = X.ruled_grids(S.drawings_in(spark, sf_dir))
    return d.select("doc_id", "page", "h_segments", "v_segments", "bbox.*")


def markdown_blocks(spark: SparkSession, sf_dir: str) -> DataFrame:
    return V.markdown_blocks(S.responses_in(spark, sf_dir))


def markdown_table_cells(spark: SparkSession, sf_dir: str) -> DataFrame:
    d = V.markdown_blocks(S.responses_in(spark, sf_dir)).where("kind = 'table'")
    d = d.select("doc_id", "page", F.posexplode(V.table_cells(F.col("content"))).alias("r", "row"))
    return d.select("doc_id", "page", "r", F.posexplode("row").alias("c", "cell"))


def response_units(spark: SparkSession, sf_dir: str) -> DataFrame:
    d = V.page_units(S.responses_in(spark, sf_dir), S.regions_in(spark, sf_dir))
    return d.select("doc_id", "page", "seq", "type", "content", "level", F.col("bbox.y0").alias("y0"), F.col("bbox.y1").alias("y1"))


def repetition_windows(spark: SparkSession, sf_dir: str) -> DataFrame:
    return V.repetition(S.responses_in(spark, sf_dir))


def response_verification(spark: SparkSession, sf_dir: str) -> DataFrame:
    return V.verify(S.responses_in(spark, sf_dir), S.regions_in(spark, sf_dir)).withColumn("review_reasons", _list("review_reasons"))


def flagged_response_units(spark: SparkSession, sf_dir: str) -> DataFrame:
    p, r = S.responses_in(spark, sf_dir), S.regions_in(spark, sf_dir)
    return V.flagged_units(V.page_units(p, r), p, V.verify(p, r)).select("doc_id", "page", "seq", "type", "needs_review")


def cache_hits(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Texts of turns stand for images; the cache holds the even conversations, empty responses do not count."""
    c = S.table(spark, sf_dir, "conversations")
    key = T.cache_key(F.encode(F.coalesce("text", F.lit("")), "UTF-8"), F.lit("m"), F.lit("1"))
    keys = c.select("conv_id", "turn", key.alias("key"))
    cache = c.where("conv_id % 2 = 0").select(key.alias("key"), F.when(F.col("turn") % 5 == 4, "").otherwise(F.coalesce("text", F.lit(""))).alias("text")).where("text <> ''").dropDuplicates(["key"])
    return V.cache_status(keys, cache)


def furniture_keys(spark: SparkSession, sf_dir: str) -> DataFrame:
    return N.furniture_keys(S.units_in(spark, sf_dir))


def furniture_stripped_units(spark: SparkSession, sf_dir: str) -> DataFrame:
    return N.strip_furniture(S.units_in(spark, sf_dir)).select("doc_id", "seq", "type", "content")


def _spans_of_tables(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A table box in the middle of every third page."""
    p = S.units_in(spark, sf_dir).select("doc_id", "page").distinct().where("page % 3 = 0")
    one = F.struct(F.col("page").cast("int").alias("page"), G.box(60, 200, 530, 400).alias("bbox"))
    return p.select("doc_id", F.array(one).alias("page_spans"))


def units_outside_tables(spark: SparkSession, sf_dir: str) -> DataFrame:
    return N.outside_tables(S.units_in(spark, sf_dir), _spans_of_tables(spark, sf_dir)).select("doc_id", "seq", "type")


def heading_levels(spark: SparkSession, sf_dir: str) -> DataFrame:
    return N.heading_levels(S.units_in(spark, sf_dir)).where("type = 'title'").select("doc_id", "seq", "content", "level")


def figure_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    u = S.units_in(spark, sf_dir)
    digest = F.sha2(F.encode((F.col("seq") % 10).cast("string"), "UTF-8"), 256)
    d = u.where("type = 'figure' and (page + seq) % 4 <> 0").groupBy("doc_id", "storage_key").agg(F.min("seq").alias("seq")).select("doc_id", "storage_key", digest.alias("digest"))
    return N.figure_dedup(u, d).select("doc_id", "seq", "type")


def pixel_boxes_to_points(spark: SparkSession, sf_dir: str) -> DataFrame:
    d = S.boxes_in(spark, sf_dir)
    w, h = F.lit(1000.0), F.lit(2000.0)
    padded = G.pad_pixels(F.col("a"), 10.0, w, h)
    return d.select("order_key", "line", G.to_points(padded, w, h, G.box(10, 20, 305, 441)).alias("p"), G.to_points(F.col("b"), F.lit(300.0), F.lit(400.0), G.box(0, 0, 595, 842)).alias("q")).select("order_key", "line", "p.*", F.col("q.x0").alias("qx0"), F.col("q.y1").alias("qy1"))


def region_overlap(spark: SparkSession, sf_dir: str) -> DataFrame:
    a, b = F.col("a"), F.col("b")
    return S.boxes_in(spark, sf_dir).select("order_key", "line", G.overlap(a, b).alias("overlap"), G.centre_in(a, b).alias("inside"), G.in_band(a, F.lit(842.0), 0.2).alias("band"), G.fills_page(b, F.lit(842.0)).alias("full"), G.bucket(F.col("a.y0"), 8).alias("bucket"), G.width(a).alias("width"), G.height(b).alias("height"))


def _regions_and_fragments(spark: SparkSession, sf_dir: str) -> tuple[DataFrame, DataFrame]:
    x = S.boxes_in(spark, sf_dir)
    key = [(F.col("order_key") % 40).cast("string").alias("doc_id"), F.floor(F.col("order_key") / 40).cast("int").alias("page")]
    return x.select(*key, F.col("line").alias("idx"), F.lit("table").alias("label"), F.col("a").alias("box_pdf")), x.where("line = 1").select(*key, F.col("b").alias("bbox"))


def borderless_suspects(spark: SparkSession, sf_dir: str) -> DataFrame:
    regions, fragments = _regions_and_fragments(spark, sf_dir)
    return TB.suspects(regions, fragments, regions.select("doc_id", "page").distinct()).select("doc_id", "page", "seq", "bbox.*")


def suppressed_suspects(spark: SparkSession, sf_dir: str) -> DataFrame:
    regions, _ = _regions_and_fragments(spark, sf_dir)
    place = G.box((F.col("box_pdf.x0") / 80).cast("int") * 80, (F.col("box_pdf.y0") / 90).cast("int") * 90, 560, 800)
    d = regions.select("doc_id", "page", F.col("idx").alias("seq"), place.alias("bbox"), F.when(F.col("page") % 4 == 0, "find_tables").otherwise("yolo_only").alias("source"))
    return TB.drop_repeated_suspects(d).select("doc_id", "page", "seq", "source")


def table_chains(spark: SparkSession, sf_dir: str) -> DataFrame:
    return TB.chains(S.fragments_in(spark, sf_dir)).select("doc_id", "page", "seq", "chain", "link")


def table_ids(spark: SparkSession, sf_dir: str) -> DataFrame:
    return TB.table_ids(TB.chains(S.fragments_in(spark, sf_dir))).withColumn("pages", _list("pages"))


def _tables(spark: SparkSession, sf_dir: str) -> DataFrame:
    return TB.build_tables(TB.chains(S.fragments_in(spark, sf_dir)))


def stitched_tables(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _tables(spark, sf_dir).select("doc_id", "table_id", _list("pages").alias("pages"), "row_count", "col_count", "markdown", "source", "header_rows")


def table_grid(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _tables(spark, sf_dir).select("doc_id", "table_id", "grid")


def stitched_spans(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Tables with repeated headers to be told in spite of slips, merged cells to be moved, and spans over page breaks to be filled."""
    d = TB.build_tables(TB.chains(S.spanned_fragments_in(spark, sf_dir)))
    merge = lambda m: F.concat_ws("-", m["row"], m["col"], m["rowspan"], m["colspan"])
    return d.select("doc_id", "table_id", F.array_join(F.transform("cells", lambda r: F.array_join(r, ",")), ";").alias("cells"), F.array_join(F.transform("merges", merge), ";").alias("merges"))


def table_markdown(spark: SparkSession, sf_dir: str) -> DataFrame:
    return S.fragments_in(spark, sf_dir).select("doc_id", "page", T.cells_markdown(F.col("cells")).alias("markdown"))


def _broken(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Fragments with defects by page: header only, ragged, empty header, mostly empty, junk in a cell."""
    d = S.fragments_in(spark, sf_dir)
    cells, k = F.col("cells"), F.col("page") % 6
    blank = lambda r: F.transform(r, lambda _: F.lit(""))
    head, rest = F.slice(cells, 1, 1), F.slice(cells, 2, F.greatest(F.size(cells) - 1, F.lit(0)))
    made = (
        F.when(k == 0, head).when(k == 1, F.concat(cells, F.array(F.array(F.lit("x"))))).when(k == 2, F.concat(F.transform(head, blank), rest)).when(k == 3, F.concat(head, F.transform(rest, blank)))
        .when(k == 4, F.concat(cells, F.array(F.array(F.lit("a\x01"), F.lit("िव"), F.lit("c"))))).otherwise(cells)
    )
    return d.withColumn("cells", made)


def table_validation(spark: SparkSession, sf_dir: str) -> DataFrame:
    c = F.col("cells")
    return _broken(spark, sf_dir).select("doc_id", "page", TB.validation_reason(c).alias("reason"), TB.junk_cells(c).alias("junk_cells"))


def unmerged_cells(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Grids of 4 x 3 with a span of two columns in the first row and of two rows below, one for each supplier."""
    s = S.table(spark, sf_dir, "supplier")
    bx = lambda c, r, w=1, h=1: G.box(c * 100, r * 20, (c + w) * 100, (r + h) * 20)
    none = F.lit(None).cast(G.BOX)
    boxes = F.array(F.array(bx(0, 0, 2), none, bx(2, 0)), F.array(bx(0, 1), bx(1, 1), bx(2, 1)), F.array(bx(0, 2, 1, 2), bx(1, 2), bx(2, 2)), F.array(none, bx(1, 3), bx(2, 3)))
    n = F.lit(None).cast("string")
    key = F.col("s_suppkey").cast("string")
    texts = F.array(F.array(F.concat(F.lit(" H"), key), n, F.lit("Z")), F.array(F.lit("a"), F.lit("b"), F.lit("c")), F.array(F.col("s_name"), F.lit("1"), F.lit("2")), F.array(n, F.lit("3"), F.lit("")))
    t = s.select(key.alias("doc_id"), F.lit(0).alias("page"), F.lit(0).cast("long").alias("seq"), G.box(0, 0, 300, 80).alias("bbox"), boxes.alias("boxes"), texts.alias("texts"))
    d = TB.unmerge(t)
    return d.select("doc_id", "header_rows", F.array_join(F.transform("cells", lambda r: F.array_join(r, ",")), ";").alias("cells"), F.array_join(F.transform("merges", lambda m: F.concat_ws("-", m["row"], m["col"], m["rowspan"], m["colspan"])), ";").alias("merges"))


def _reviewed(spark: SparkSession, sf_dir: str) -> tuple[DataFrame, DataFrame]:
    """Units with defects by number, and pages of the paid lane with reasons."""
    u = S.units_in(spark, sf_dir)
    k = (7 * F.col("page") + F.col("seq")) % 50
    c = F.when(k == 3, F.concat("content", F.lit("\x01"))).when(k == 7, F.concat("content", F.lit(" िवभाग"))).when(k == 11, F.concat("content", F.lit(" [ILLEGIBLE]"))).otherwise(F.col("content"))
    pages = u.select("doc_id", "page").distinct().where("page % 5 = 3")
    pages = pages.select("doc_id", "page", F.when(F.col("page") % 2 == 0, F.array(F.lit("page reason"))).otherwise(F.array().cast("array<string>")).alias("review_reasons"))
    return u.withColumn("content", c), pages


def unit_review_reasons(spark: SparkSession, sf_dir: str) -> DataFrame:
    u, p = _reviewed(spark, sf_dir)
    return R.unit_reasons(u, p).where(F.size("reasons") > 0).select("doc_id", "seq", "type", _list("reasons").alias("reasons"))


def review_items(spark: SparkSession, sf_dir: str) -> DataFrame:
    u, p = _reviewed(spark, sf_dir)
    return R.review_items(u, p, R.gate_tables(_tables(spark, sf_dir)))


def review_report(spark: SparkSession, sf_dir: str) -> DataFrame:
    u, p = _reviewed(spark, sf_dir)
    return R.review_report(R.review_items(u, p, R.gate_tables(_tables(spark, sf_dir))), u)


def _walk(spark: SparkSession, sf_dir: str) -> DataFrame:
    return C.with_headings(C.walk(N.heading_levels(S.units_in(spark, sf_dir)), _tables(spark, sf_dir)))


def walk_order(spark: SparkSession, sf_dir: str) -> DataFrame:
    return C.walk(S.units_in(spark, sf_dir), _tables(spark, sf_dir)).select("doc_id", "pos", "kind", "page", "content", "table_id")


def heading_paths(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _walk(spark, sf_dir).select("doc_id", "pos", "kind", C.crumb(F.col("headings")).alias("crumb"))


def section_text(spark: SparkSession, sf_dir: str) -> DataFrame:
    return C.sections(_walk(spark, sf_dir)).select("doc_id", "emit", "text", _list("pages").alias("pages"), "source", "needs_review", C.crumb(F.col("headings")).alias("crumb"))


def all_chunks(spark: SparkSession, sf_dir: str) -> DataFrame:
    d = C.chunks(_walk(spark, sf_dir))
    return d.select("chunk_id", "type", "content", "embedding_text", _list("pages").alias("pages"), "source", "needs_review", "token_count", "table_id", "storage_key")


def text_pieces(spark: SparkSession, sf_dir: str) -> DataFrame:
    d = C.chunks(_walk(spark, sf_dir))
    return d.where("type = 'text'").select("chunk_id", "content", "embedding_text", "token_count")


def table_row_groups(spark: SparkSession, sf_dir: str) -> DataFrame:
    d = C.chunks(_walk(spark, sf_dir))
    return d.where("type = 'table'").select("doc_id", "table_id", "content", _list("pages").alias("pages"), "token_count")


def merged_markdown(spark: SparkSession, sf_dir: str) -> DataFrame:
    return C.merged_markdown(_walk(spark, sf_dir))


def chunk_diff(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Chunks with and without page furniture."""
    u = N.heading_levels(S.units_in(spark, sf_dir))
    t = _tables(spark, sf_dir)
    a = C.chunks(C.with_headings(C.walk(u, t)))
    b = C.chunks(C.with_headings(C.walk(N.strip_furniture(u), t)))
    return C.chunk_diff(a, b).withColumn("pages", _list("pages"))


def manifest(spark: SparkSession, sf_dir: str) -> DataFrame:
    from folioflow.plans.pipeline import manifest as build

    routes = P.route_pages(page_profiles(spark, sf_dir))
    units, tables = S.units_in(spark, sf_dir), R.gate_tables(_tables(spark, sf_dir))
    u, p = _reviewed(spark, sf_dir)
    pages = p.select("doc_id", "page", (F.col("page") % 10 == 3).alias("cached"), F.lit(100).alias("input_tokens"), (F.col("page") % 7).cast("int").alias("output_tokens"), "review_reasons")
    ch = C.chunks(C.with_headings(C.walk(N.heading_levels(units), tables)))
    d = build(routes, units, pages, tables, R.review_items(u, p, tables), ch, Config().snapshot())
    return d.withColumns({c: _list(c) for c in ("multi_page", "tables_review", "chunks_review", "page_routes")}).drop("config", "reason", "body_size", "source_file", "timings")


QUERIES: dict[str, Query] = {
    f.__name__: f
    for f in (
        route_counts, page_profiles, page_routes, page_routes_first_reason, text_layer_evidence, text_scores, text_forms, page_sample, body_font_size, native_units, drawing_units, ruled_grids, markdown_blocks,
        markdown_table_cells, response_units, repetition_windows, response_verification, flagged_response_units, cache_hits, furniture_keys, furniture_stripped_units, units_outside_tables, heading_levels, figure_dedup,
        pixel_boxes_to_points, region_overlap, borderless_suspects, suppressed_suspects, table_chains, table_ids, stitched_tables, stitched_spans, table_grid, table_markdown, table_validation, unmerged_cells, unit_review_reasons,
        review_items, review_report, walk_order, heading_paths, section_text, all_chunks, text_pieces, table_row_groups, merged_markdown, chunk_diff, manifest,
    )
}

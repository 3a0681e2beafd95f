"""Sources and sinks: decoded-page inputs over the benchmark tables, artifacts, and the decoder boundary."""

from __future__ import annotations

from collections.abc import Callable, Iterable, Iterator
from typing import Protocol

import pandas as pd
from pyspark import cloudpickle
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from folioflow.functions import geometry as G


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


# --- files ---------------------------------------------------------------------------------------------------------


class Decoder(Protocol):
    """Turns a file into page rows; raises ValueError with the reason where the document is to be rejected."""

    def pages(self, content: bytes) -> Iterable[dict]: ...


def decode_files(spark: SparkSession, path: str, make_decoder: Callable[[], Decoder], schema: str, pattern: str = "*.pdf") -> DataFrame:
    """Pages of all files below path (doc_id is the file's stem), through an injected decoder. A file that the decoder
    rejects is one row with `reject_reason` and nothing else. schema is that of the decoder's rows."""
    files = spark.read.format("binaryFile").option("pathGlobFilter", pattern).option("recursiveFileLookup", "true").load(path)
    files = files.select(F.regexp_extract("path", r"([^/]+?)(?:\.[^./]*)?$", 1).alias("doc_id"), "content")
    names = [c.strip().split(" ")[0] for c in schema.split(",") if c.strip()]

    def run(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        decoder = make_decoder()
        for pdf in frames:
            for doc, content in zip(pdf["doc_id"], pdf["content"], strict=True):
                try:
                    rows = [{"doc_id": doc, **r, "reject_reason": None} for r in decoder.pages(bytes(content))]
                    rows = rows or [{"doc_id": doc, "reject_reason": "zero pages"}]
                except ValueError as e:
                    rows = [{"doc_id": doc, "reject_reason": str(e)}]
                yield pd.DataFrame(rows, dtype=object).reindex(columns=["doc_id", *names, "reject_reason"]).astype(object)

    return files.mapInPandas(run, f"doc_id string, {schema}, reject_reason string")


class Detector(Protocol):
    """Finds regions on a raster: (label, confidence, x0, y0, x1, y1) in its pixels."""

    def regions(self, image: bytes) -> Iterable[tuple[str, float, float, float, float, float]]: ...


_detectors: dict[bytes, Detector] = {}


def detect_regions(rasters: DataFrame, make_detector: Callable[[], Detector], labels: tuple[str, ...] = ("table", "figure"), least: float = 0.2, pad: float = 10.0) -> DataFrame:
    """(doc_id, page, idx, label, conf, box_pdf) from rasters (doc_id, page, image, raster_w, raster_h, page_box), through an injected
    detector, one to a worker process.

    Other labels and regions below the least confidence are dropped; confidences are rounded to three places; boxes are
    padded, cut to the raster and turned into points. idx numbers the regions that are left, in the detector's order; a
    region of which nothing lies on the page goes.
    """
    made_by = cloudpickle.dumps(make_detector)
    schema = "doc_id string, page int, n int, label string, conf double, x0 double, y0 double, x1 double, y1 double"

    def run(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        if made_by not in _detectors:
            _detectors[made_by] = cloudpickle.loads(made_by)()
        for pdf in frames:
            rows = [(d, p, n, *r) for d, p, image in zip(pdf["doc_id"], pdf["page"], pdf["image"], strict=True) for n, r in enumerate(_detectors[made_by].regions(bytes(image)))]
            yield pd.DataFrame(rows, columns=["doc_id", "page", "n", "label", "conf", "x0", "y0", "x1", "y1"])

    found = rasters.select(F.col("doc_id").cast("string").alias("doc_id"), F.col("page").cast("int").alias("page"), "image").mapInPandas(run, schema)
    found = found.where(F.col("label").isin(*labels) & (F.col("conf") >= least)).withColumn("conf", F.round("conf", 3))
    d = found.join(rasters.select("doc_id", "page", "raster_w", "raster_h", "page_box"), ["doc_id", "page"])
    w, h = F.col("raster_w").cast("double"), F.col("raster_h").cast("double")
    points = G.to_points(G.pad_pixels(G.box(*(F.col(c) for c in ("x0", "y0", "x1", "y1"))), pad, w, h), w, h, F.col("page_box"))
    d = d.withColumn("box_pdf", points).where("box_pdf is not null")
    idx = F.row_number().over(Window.partitionBy("doc_id", "page").orderBy("n")) - 1
    return d.select("doc_id", "page", idx.alias("idx"), "label", "conf", "box_pdf")


def write_figures(images: DataFrame, folder: str) -> DataFrame:
    """Images (doc_id, storage_key, image) as a table by document below folder; returns (doc_id, storage_key, digest), the digests that
    tell equal figures. A row without bytes is a figure that was not stored, and has none."""
    d = images.where("image is not null")
    d.write.mode("overwrite").partitionBy("doc_id").parquet(folder)
    return d.select("doc_id", "storage_key", F.sha2("image", 256).alias("digest"))


def write_artifact(df: DataFrame, path: str, kind: str = "parquet", by_doc: bool = False) -> None:
    """Parquet, or JSON with one record to a line; by_doc makes a folder for each document."""
    w = df.write.mode("overwrite")
    (w.partitionBy("doc_id") if by_doc else w).format(kind).save(path)


def read_artifact(spark: SparkSession, path: str, schema: str | None = None, kind: str = "parquet") -> DataFrame:
    r = spark.read.format(kind)
    return (r.schema(schema) if schema else r).load(path)


# --- inputs over the benchmark tables --------------------------------------------------------------------------------

JUNK_SAMPLE = "\x01\x02\x01\x03\ufffd" * 5
MARK_SAMPLE = " \u093f\u0935\u092d\u093e\u0917 \u092e= ab"
#: Lines of a document that make a page.
PAGE_LINES = 4


def _documents(spark: SparkSession, sf_dir: str) -> DataFrame:
    d = table(spark, sf_dir, "documents").where("doc_id is not null and text is not null")
    return d.select(F.col("doc_id").cast("string").alias("doc_id"), F.col("doc_id").alias("k"), F.split("text", "\n", -1).alias("lines"))


def pages_in(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Documents cut into pages of four lines; some pages get defects, images and drawings by their number, and some documents
    a further short page."""
    d = _documents(spark, sf_dir)
    n = F.size("lines")
    text = F.transform(F.sequence(F.lit(1), n, F.lit(PAGE_LINES)), lambda i: F.struct(F.array_join(F.slice("lines", i, PAGE_LINES), "\n").alias("t"), F.lit(False).alias("short")))
    more = F.when(F.col("k") % 40 == 2, F.array(F.struct(F.lit("Short page").alias("t"), F.lit(True).alias("short")))).otherwise(F.array().cast("array<struct<t:string,short:boolean>>"))
    d = d.select("doc_id", "k", F.posexplode(F.concat(text, more)).alias("page", "p"))
    k, i, t = (F.col("k") + F.col("page")) % 40, (F.col("k") + F.col("page")) % 11, F.col("p.t")
    none = F.array().cast(f"array<{G.BOX}>")
    images = F.when(i == 0, F.array(G.box(0, 0, 595, 700))).when(i == 1, F.array(G.box(0, 0, 100, 100))).otherwise(none)
    return d.select(
        "doc_id", "page", F.lit(595.0).alias("width"), F.lit(842.0).alias("height"), F.when(k == 0, F.concat(t, F.lit(JUNK_SAMPLE))).when(k == 1, F.concat(t, F.lit(MARK_SAMPLE))).otherwise(t).alias("text"), images.alias("images"),
        F.array(G.box(72, 72, 520, 72 + F.size(F.split(t, "\n", -1)) * 12)).alias("text_blocks"), F.when(F.col("p.short"), (F.col("k") % 3) * 80).otherwise(5).cast("int").alias("n_drawings"),
    )


def _numbered_lines(spark: SparkSession, sf_dir: str) -> DataFrame:
    d = _documents(spark, sf_dir).select("doc_id", F.posexplode("lines").alias("i", "line"))
    return d.select("doc_id", F.floor(F.col("i") / PAGE_LINES).cast("int").alias("page"), "i", "line")


def units_in(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Lines of documents as units: every sixth is a title, some have a figure after them, and pages have running heads."""
    d = _numbered_lines(spark, sf_dir)
    i, page = F.col("i"), F.col("page")
    gem = page % 5 == 3
    lane = F.when(gem, "gemini").otherwise("pymupdf").alias("source")
    seq = page * 1000 + 2 + 2 * (i % PAGE_LINES)
    y0 = 72 + 14 * (i % 50)
    nth = (F.floor(i / 6) + 1).cast("string")
    titled = F.when(i % 4 == 0, F.concat(nth, F.lit(". "), "line")).when(i % 4 == 2, F.concat(nth, F.lit(".2 "), "line")).otherwise(F.col("line"))
    is_title = i % 6 == 0
    size = 18.0 - 2 * (F.length("line") % 3) + F.element_at(F.array(*map(F.lit, (0.0, 0.4, -0.4, 0.5))), (i % 4 + 1).cast("int"))

    def unit(d: DataFrame, seq, y, kind, content, level=None, font=None, key=None) -> DataFrame:
        null = lambda c, t: (F.lit(None) if c is None else c).cast(t)
        return d.select(
            "doc_id", "page", seq.cast("long").alias("seq"), G.box(72, y, 520, y + 12).alias("bbox"), kind.alias("type"), content.alias("content"), null(level, "int").alias("level"), null(font, "double").alias("font_size"),
            null(key, "string").alias("storage_key"), lane, F.lit(False).alias("needs_review"),
        )

    lines = unit(d, seq, y0, F.when(is_title, "title").otherwise("text"), F.when(is_title, titled).otherwise(F.col("line")), F.when(is_title & gem & (i % 12 == 0), 1 + i % 4), F.when(is_title, size))
    figures = unit(d.where("i % 17 = 5"), seq + 1, y0 + 13, F.lit("figure"), F.lit(""), key=F.format_string("figures/p%04d_f%02d.png", page, i))
    p = d.select("doc_id", "page").distinct()
    head = unit(p, page * 1000, F.lit(20), F.lit("text"), F.concat(F.lit("Report "), "doc_id", F.lit("  page "), page.cast("string")))
    foot = unit(p.where("page % 2 = 0"), page * 1000 + 999, F.lit(820), F.lit("text"), F.lit("Confidential"))
    return lines.unionByName(figures).unionByName(head).unionByName(foot)


def _customers(spark: SparkSession, sf_dir: str, order: list[str]) -> DataFrame:
    """Customers numbered from 0 in documents of a nation and a range of keys, so that no document grows with the table."""
    c = table(spark, sf_dir, "customer").join(F.broadcast(table(spark, sf_dir, "nation")), F.col("c_nationkey") == F.col("n_nationkey"))
    c = c.withColumn("doc_id", F.concat("n_name", F.lit(" "), F.floor(F.col("c_custkey") / 500).cast("string")))
    return c.withColumn("n", F.row_number().over(Window.partitionBy("doc_id").orderBy(*order)) - 1).withColumn("page", F.floor(F.col("n") / 10).cast("int"))


def _fragments(g: DataFrame, cells, merges) -> DataFrame:
    """g (doc_id, page) as fragments; every fourth page ends high."""
    return g.select(
        "doc_id", "page", F.lit(0).cast("long").alias("seq"), G.box(72, 72, 520, F.when(F.col("page") % 4 == 3, 500).otherwise(800)).alias("bbox"), cells.alias("cells"), F.lit("find_tables").alias("source"),
        F.lit(1).alias("header_rows"), merges.cast("array<struct<row:int,col:int,rowspan:int,colspan:int>>").alias("merges"),
    )


def fragments_in(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Customers as tables of ten rows to a page under a repeated header."""
    c = _customers(spark, sf_dir, ["c_custkey"]).select("doc_id", "page", "n", F.array("c_name", "c_mktsegment", F.col("c_custkey").cast("string")).alias("row"))
    g = c.groupBy("doc_id", "page").agg(F.transform(F.array_sort(F.collect_list(F.struct("n", "row"))), lambda x: x["row"]).alias("rows"))
    head = F.array(F.array(F.lit("name"), F.lit("segment"), F.lit("key")))
    return _fragments(g, F.concat(head, "rows"), F.array())


def spanned_fragments_in(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Customers by segment, as printed: a segment that goes on from the page before is blank, headers are repeated with slips or
    not at all, and merged cells lie in the header, over its edge and below it."""
    c = _customers(spark, sf_dir, ["c_mktsegment", "c_custkey"])
    before = F.lag("c_mktsegment").over(Window.partitionBy("doc_id").orderBy("n"))
    c = c.withColumn("first_before", F.first(before).over(Window.partitionBy("doc_id", "page").orderBy("n")))
    goes_on = (F.col("page") % 4 != 0) & (F.col("c_mktsegment") == F.col("first_before"))
    c = c.select("doc_id", "page", "n", F.array(F.when(goes_on, "").otherwise(F.col("c_mktsegment")), F.col("c_name"), F.col("c_custkey").cast("string")).alias("row"))
    g = c.groupBy("doc_id", "page").agg(F.transform(F.array_sort(F.collect_list(F.struct("n", "row"))), lambda x: x["row"]).alias("rows"))
    k = F.when(F.col("page") % 4 == 0, -1).otherwise(F.col("page") % 3)
    head = lambda *names: F.array(F.array(*map(F.lit, names)))
    cells = F.concat(F.when(k == -1, head("segment", "name", "key")).when(k == 1, head("Segment ", "NAME", "key")).when(k == 2, head("segmant", "name", "kei")).otherwise(F.array().cast("array<array<string>>")), "rows")
    box = lambda *m: F.struct(*(F.lit(v).alias(n) for v, n in zip(m, ("row", "col", "rowspan", "colspan"), strict=True)))
    return _fragments(g, cells, F.when(k == 0, F.array(box(0, 0, 2, 1))).otherwise(F.array(box(0, 0, 1, 2), box(0, 2, 2, 1), box(1, 0, 2, 1))))


def responses_in(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Turns of conversations as transcribed pages: some with a heading, some with a table; some have an empty page besides."""
    c = table(spark, sf_dir, "conversations").where("conv_id is not null and turn is not null")
    t, role = F.coalesce("text", F.lit("")), F.coalesce("role", F.lit(""))
    k = F.col("turn") % 4
    md = (
        F.when(k == 0, F.concat(F.lit("# "), role, F.lit(" one\n"), t))
        .when(k == 1, F.concat(F.lit("| a | b\\|c |\n|---|:-:|\n| "), role, F.lit(" | "), F.col("turn").cast("string"), F.lit(" |\n\n"), t))
        .when(k == 2, F.concat(t, F.lit("\n\n## part\n| lone row |\n[ILLEGIBLE]")))
        .otherwise(t)
    )

    def page(d: DataFrame, at, md) -> DataFrame:
        return d.select(F.col("conv_id").alias("doc_id"), at.cast("int").alias("page"), F.lit(595.0).alias("width"), F.lit(842.0).alias("height"), md.alias("markdown"), F.when(F.col("turn") % 3 == 0, F.length(t)).alias("text_layer_chars"), F.lit(0.02).alias("ink_frac"))

    return page(c, F.col("turn"), md).unionByName(page(c.where("turn % 8 = 3"), F.col("turn") + 1_000_000, F.lit("")))


def regions_in(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Detector boxes for some turns: one table region on turns 1 and 2 modulo 4."""
    r = responses_in(spark, sf_dir).where("page % 4 in (1, 2)")
    return r.select("doc_id", "page", F.lit(0).alias("idx"), F.lit("table").alias("label"), G.box(50, 100, 500, 300).alias("box_pdf"))


def boxes_in(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Pairs of boxes from the lines of each order, numbered anew (line numbers repeat in the data)."""
    first = Window.partitionBy("l_orderkey").orderBy("l_linenumber", "l_partkey", "l_suppkey")
    x = table(spark, sf_dir, "lineitem").select("l_orderkey", "l_partkey", "l_suppkey", F.row_number().over(first).alias("n"))
    k, p, s = F.col("l_orderkey"), F.col("l_partkey"), F.col("l_suppkey")
    a = G.box(p % 400, s % 600, p % 400 + 50 + s % 90, s % 600 + 40)
    b = G.box(p % 397, s % 590, p % 397 + 80, s % 590 + 30 + p % 50)
    return x.select(k.alias("order_key"), F.col("n").alias("line"), a.alias("a"), b.alias("b"))


def spans_in(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Pages of blocks of three lines, two spans to a line, sizes and bold by place."""
    d = _numbered_lines(spark, sf_dir)
    size = F.when(F.col("i") % 7 == 0, 14.0).otherwise(10.0)
    text = F.when(F.col("i") % 5 == 1, F.concat(F.lit("3.1 "), "line")).otherwise(F.col("line"))
    span = lambda t, z, f: F.struct(t.alias("text"), z.alias("size"), f.cast("int").alias("flags"))
    y = 72.0 + 14 * (F.col("i") % PAGE_LINES)
    line = F.struct(G.box(72, y, 520, y + 12).alias("bbox"), F.array(span(F.substring(text, 1, 10), F.lit(9.0), F.lit(0)), span(F.substr(text, F.lit(11)), size, F.when(F.col("i") % 5 == 1, 16).otherwise(0))).alias("spans"))
    b = d.withColumn("b", F.floor(F.col("i") % PAGE_LINES / 3).cast("int")).groupBy("doc_id", "page", "b").agg(F.transform(F.array_sort(F.collect_list(F.struct("i", line.alias("line")))), lambda x: x["line"]).alias("lines"))
    image = F.struct(F.lit(1).alias("type"), G.box(100, 100, 300, 200).alias("bbox"), F.array().cast("array<struct<bbox:struct<x0:double,y0:double,x1:double,y1:double>,spans:array<struct<text:string,size:double,flags:int>>>>").alias("lines"))
    block = F.struct(F.lit(0).alias("type"), G.box(72, 72, 520, 800).alias("bbox"), F.col("lines").alias("lines"))
    g = b.groupBy("doc_id", "page").agg(F.transform(F.array_sort(F.collect_list(F.struct("b", block.alias("block")))), lambda x: x["block"]).alias("blocks"))
    blocks = F.when(F.col("page") % 3 == 0, F.concat(F.array(image), "blocks")).otherwise(F.col("blocks"))
    return g.select("doc_id", "page", F.lit(595.0).alias("width"), F.lit(842.0).alias("height"), blocks.alias("blocks"))


def drawings_in(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Lines and rectangles from order lines: an order is a page."""
    x = table(spark, sf_dir, "lineitem")
    n = F.col("l_linenumber")
    p = (F.col("l_partkey") % 20 * 10).cast("double")
    rect = F.col("l_suppkey") % 2 == 0
    return x.select(
        (F.col("l_orderkey") % 50).alias("doc_id"), F.col("l_orderkey").cast("int").alias("page"), F.when(rect, "re").otherwise("l").alias("kind"), p.alias("x0"), (n * 20.0).alias("y0"),
        F.when(rect, p + 100).when(n % 2 == 0, p).otherwise(p + 200).alias("x1"), F.when(rect, n * 20.0 + 15).when(n % 2 == 0, n * 20.0 + 300).otherwise(n * 20.0).alias("y1"),
    )

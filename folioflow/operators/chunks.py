"""Documents to ordered, citation-carrying chunks, by windows over the reading order of a document."""

from __future__ import annotations

import re
from collections.abc import Callable
from functools import reduce

import pandas as pd
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql.types import ArrayType, IntegerType, StringType, StructField, StructType

from folioflow.config import Cutting
from folioflow.functions import geometry as G
from folioflow.functions import text as T

LEVELS = range(1, 7)


def walk(units: DataFrame, tables: DataFrame) -> DataFrame:
    """All items of a document with `pos`, their place in reading order: page, top edge, units before tables, emission order."""
    nul = lambda t: F.lit(None).cast(t)
    u = units.where(F.col("type").isin("title", "text", "figure")).select(
        "doc_id", F.col("type").alias("kind"), "page", F.col("bbox.y0").alias("y0"), "bbox", "content", "level", "storage_key", "source", "needs_review",
        nul("string").alias("table_id"), nul("array<int>").alias("pages"), nul("array<array<string>>").alias("cells"), nul("int").alias("header_rows"), nul("boolean").alias("has_merges"), nul("string").alias("markdown"),
        nul("string").alias("grid"), nul("string").alias("review_reason"), F.lit(0).alias("_k"), F.col("seq").cast("long").alias("_s"), F.lit("").alias("_t"),
    )
    first = F.get("page_spans", F.lit(0))
    t = tables.select(
        "doc_id", F.lit("table").alias("kind"), first["page"].alias("page"), first["bbox"]["y0"].alias("y0"), first["bbox"].alias("bbox"), F.lit("").alias("content"), nul("int").alias("level"), F.col("crop_key").alias("storage_key"),
        F.lit("pymupdf").alias("source"), "needs_review", "table_id", "pages", "cells", "header_rows", (F.size("merges") > 0).alias("has_merges"), "markdown", "grid", "review_reason", F.lit(1).alias("_k"), F.lit(0).cast("long").alias("_s"), F.col("table_id").alias("_t"),
    )
    order = Window.partitionBy("doc_id").orderBy("page", "y0", "_k", "_s", "_t")
    return u.unionByName(t).withColumn("pos", F.row_number().over(order) - 1).drop("_k", "_s", "_t", "y0")


def with_headings(walked: DataFrame) -> DataFrame:
    """`headings`: the titles above each item. The last title of a level counts if no higher one came after it."""
    upto = Window.partitionBy("doc_id").orderBy("pos").rowsBetween(Window.unboundedPreceding, 0)
    level = F.greatest(F.lit(1), F.coalesce("level", F.lit(1)))
    d = walked
    for k in LEVELS:
        d = d.withColumn(f"_{k}", F.max(F.when((F.col("kind") == "title") & (level == k), F.struct("pos", "content"))).over(upto))
    parts = []
    for k in LEVELS:
        above = [F.coalesce(F.col(f"_{j}.pos"), F.lit(-1)) for j in range(1, k)]
        top = reduce(lambda a, b: F.greatest(a, b), above, F.lit(-1))
        parts.append(F.when(F.col(f"_{k}.pos") > top, F.col(f"_{k}.content")))
    return d.withColumn("headings", F.array_compact(F.array(*parts))).drop(*(f"_{k}" for k in LEVELS))


def crumb(headings: Column) -> Column:
    return F.when(F.size(headings) > 0, F.concat(F.lit("["), F.array_join(headings, " > "), F.lit("]"))).otherwise("")


def _embedding(headings: Column, body: Column) -> Column:
    return F.when(F.size(headings) > 0, F.concat(crumb(headings), F.lit("\n\n"), body)).otherwise(body)


def _sectioned(walked: DataFrame) -> DataFrame:
    """walked with `section`, which a title or table begins, and `emit`, the place where the next one begins."""
    w = Window.partitionBy("doc_id").orderBy("pos")
    ends = F.col("kind").isin("title", "table")
    d = walked.withColumn("section", F.sum(F.when(ends, 1).otherwise(0)).over(w.rowsBetween(Window.unboundedPreceding, 0)))
    return d.withColumn("emit", F.coalesce(F.min(F.when(ends, F.col("pos"))).over(w.rowsBetween(1, Window.unboundedFollowing)), F.lit(2**31 - 1)))


def _texts() -> list[Column]:
    """Aggregates of a section's texts: contents in order, pages from 1, the last text's source and headings, any flag."""
    text = F.col("kind") == "text"
    at = F.when(text, F.col("pos"))
    return [
        F.transform(F.array_sort(F.collect_list(F.when(text, F.struct("pos", "content")))), lambda x: x["content"]).alias("texts"), F.array_sort(F.collect_set(F.when(text, (F.col("page") + 1).cast("int")))).alias("text_pages"),
        F.max_by("source", at).alias("text_source"), F.coalesce(F.bool_or(F.when(text, F.col("needs_review"))), F.lit(False)).alias("text_review"), F.max_by("headings", at).alias("text_headings"),
    ]


def sections(walked: DataFrame) -> DataFrame:
    """(doc_id, emit, headings, text, pages, source, needs_review): the texts between titles and tables; figures do not end one.

    emit is the place of the title or table that ends the section. The source is the last text's; one flagged text flags all.
    """
    g = _sectioned(walked).where("kind = 'text'").groupBy("doc_id", "section", "emit").agg(*_texts())
    return g.select("doc_id", "emit", F.col("text_headings").alias("headings"), F.array_join("texts", "\n\n").alias("text"), F.col("text_pages").alias("pages"), F.col("text_source").alias("source"), F.col("text_review").alias("needs_review"))


def pieces(text: Column, size_tokens: int) -> Column:
    """A text in stripped pieces of whole sentences with at most so many estimated tokens; a longer sentence stands alone."""
    room = 4 * size_tokens + 3
    kind = "struct<done:array<string>,open:string>"

    def add(a: Column, s: Column) -> Column:
        fits = (a["open"] == "") | (F.length(a["open"]) + F.length(s) <= room)
        return F.when(fits, F.struct(a["done"].alias("done"), F.concat(a["open"], s).alias("open"))).otherwise(F.struct(F.concat(a["done"], F.array(a["open"])).alias("done"), s.alias("open")))

    start = F.struct(F.array().cast("array<string>").alias("done"), F.lit("").alias("open")).cast(kind)
    cut = F.aggregate(F.split(text, r"(?<=[.!?][\s\p{Z}])(?=[^\s\p{Z}])", -1), start, add, lambda a: F.concat(a["done"], F.array(a["open"])))
    return F.filter(F.transform(cut, T.strip), lambda p: p != "")


Splitter = Callable[[Column], Column]


def splitter(cfg: Cutting, count: Callable[[str], int] | None = None) -> Splitter:
    """A text to its pieces, array<struct<content, tokens>>: estimated and in the JVM, or by a tokenizer's `count` in Python.

    With an overlap a piece begins with the last sentences of the one before that hold no more than so many tokens.
    """
    if count is None and not cfg.overlap:
        return lambda text: F.transform(pieces(text, cfg.tokens), lambda p: F.struct(p.alias("content"), T.token_estimate(p).alias("tokens")))
    by = count or (lambda t: max(1, len(t) // 4))
    piece = StructType([StructField("content", StringType()), StructField("tokens", IntegerType())])

    @F.pandas_udf(ArrayType(piece))
    def cut(texts: pd.Series) -> pd.Series:
        return pd.Series([[{"content": p, "tokens": by(p)} for p in sentence_pieces(t, cfg.tokens, cfg.overlap, by)] for t in texts], dtype=object)

    return lambda text: cut(text)


def sentence_pieces(text: str, most: int, overlap: int, count: Callable[[str], int]) -> list[str]:
    """Stripped pieces of whole sentences with at most `most` tokens; a longer sentence stands alone."""
    out, open_ = [], []
    for sentence in _SENTENCE.split(text):
        if open_ and count("".join([*open_, sentence]).strip()) > most:
            out.append("".join(open_))
            kept: list[str] = []
            while open_ and overlap and count("".join([open_[-1], *kept]).strip()) <= overlap:
                kept.insert(0, open_.pop())
            open_ = kept if count("".join([*kept, sentence]).strip()) <= most else []
        open_.append(sentence)
    return [p for p in (x.strip() for x in [*out, "".join(open_)]) if p]


_SENTENCE = re.compile(r"(?<=[.!?]\s)(?=\S)")
_CHUNK = f"struct<emit:int,rank:int,part:int,type:string,content:string,embedding_text:string,headings:array<string>,pages:array<int>,bbox:{G.BOX},storage_key:string,source:string,needs_review:boolean,token_count:int,table_id:string>"


def _chunk(emit, rank, part, kind, content, embedding, headings, pages, bbox, key, source, review, tokens, table_id) -> Column:
    return F.struct(emit, F.lit(rank), part, F.lit(kind), content, embedding, headings, pages, bbox, key, source, review, tokens, table_id).cast(_CHUNK)


def chunks(walked: DataFrame, cfg: Cutting | None = None, split: Splitter | None = None) -> DataFrame:
    """Chunks of every document in emission order; `walked` has headings.

    A figure comes at its place, a section's text where the section ends, a table after the text before it, its rows in
    groups that repeat all header rows. A table under review is a chunk without content. `split` may bring another way of
    cutting text. The items of a section are gathered once, and documents are shuffled once.
    """
    cfg = cfg or Cutting()
    split = split or splitter(cfg)
    null, zero = F.lit(None), F.lit(0)
    names = ["pos", "page", "bbox", "storage_key", "source", "needs_review", "headings", "pages", "cells", "header_rows", "table_id"]
    item = lambda kind: F.array_sort(F.collect_list(F.when(F.col("kind") == kind, F.struct(*names))), lambda a, b: a["pos"] - b["pos"])
    g = _sectioned(walked).groupBy("doc_id", "section", "emit").agg(*_texts(), item("figure").alias("figures"), item("table").alias("tables"))

    def text_chunk(p: Column, i: Column) -> Column:
        h = F.col("text_headings")
        tokens = p["tokens"] + F.when(F.size(h) > 0, T.token_estimate(crumb(h))).otherwise(0)
        return _chunk(F.col("emit"), 0, i, "text", p["content"], _embedding(h, p["content"]), h, F.col("text_pages"), null, null, F.col("text_source"), F.col("text_review"), tokens, null)

    def figure_chunk(f: Column) -> Column:
        e = _embedding(f["headings"], F.format_string("[figure on page %d]", (f["page"] + 1).cast("int")))
        return _chunk(f["pos"], 1, zero, "figure", F.lit(""), e, f["headings"], F.array((f["page"] + 1).cast("int")), f["bbox"], f["storage_key"], f["source"], f["needs_review"], T.token_estimate(e), null)

    def table_chunks(t: Column) -> Column:
        pages = F.transform(t["pages"], lambda p: p + 1)
        held = t["needs_review"] | (F.size(t["cells"]) == 0)
        head = F.greatest(F.lit(1), F.least(t["header_rows"], F.size(t["cells"]) - 1))
        data = F.greatest(F.size(t["cells"]) - head, zero)
        starts = F.when(data > 0, F.sequence(zero, data - 1, F.lit(cfg.table_rows))).otherwise(F.array().cast("array<int>"))

        def group(at: Column, i: Column) -> Column:
            md = T.cells_markdown(F.concat(F.slice(t["cells"], F.lit(1), head), F.slice(t["cells"], head + at + 1, F.lit(cfg.table_rows))))
            e = _embedding(t["headings"], md)
            return _chunk(t["pos"], 1, i, "table", md, e, t["headings"], pages, t["bbox"], null, t["source"], F.lit(False), T.token_estimate(e), t["table_id"])

        wanted = F.concat(crumb(t["headings"]), F.lit("\n\n"), F.format_string("[table needing review on page %d]", F.get(pages, zero)))
        review = _chunk(t["pos"], 1, zero, "table", F.lit(""), wanted, t["headings"], pages, t["bbox"], t["storage_key"], t["source"], F.lit(True), T.token_estimate(wanted), t["table_id"])
        return F.when(held, F.array(review)).otherwise(F.transform(starts, group))

    cut = F.when(F.size("texts") > 0, split(F.array_join("texts", "\n\n")))
    g = g.withColumn("pieces", F.coalesce(cut, F.array().cast("array<struct<content:string,tokens:int>>")))
    made = F.concat(F.transform("pieces", text_chunk), F.transform("figures", figure_chunk), F.flatten(F.transform("tables", table_chunks)))
    d = g.select("doc_id", F.explode(made).alias("c")).select("doc_id", "c.*")
    n = F.row_number().over(Window.partitionBy("doc_id").orderBy("emit", "rank", "part")) - 1
    d = d.withColumn("n", n).withColumn("chunk_id", F.concat("doc_id", F.format_string("_c%04d", F.col("n"))))
    return d.select("doc_id", "chunk_id", "n", "type", "content", "embedding_text", "headings", "pages", "bbox", "storage_key", "source", "needs_review", "token_count", "table_id")


def merged_markdown(walked: DataFrame) -> DataFrame:
    """(doc_id, markdown): the whole document in reading order."""
    level = F.greatest(F.lit(1), F.coalesce("level", F.lit(1)))
    held = F.col("needs_review") | (F.size("cells") == 0)
    line = (
        F.when(F.col("kind") == "title", F.concat(F.lit("\n"), F.repeat(F.lit("#"), level), F.lit(" "), "content", F.lit("\n")))
        .when(F.col("kind") == "text", F.concat("content", F.lit("\n")))
        .when(F.col("kind") == "figure", F.concat(F.lit("\n![figure]("), "storage_key", F.lit(")\n")))
        .when(held, F.concat(F.lit("\n<!-- table "), "table_id", F.lit(": NEEDS REVIEW ("), F.coalesce("review_reason", F.lit("None")), F.lit(") -->\n")))
        .when(F.col("has_merges"), F.concat(F.lit("\n```text\n"), "grid", F.lit("\n```\n")))
        .otherwise(F.concat(F.lit("\n"), "markdown", F.lit("\n")))
    )
    g = walked.withColumn("line", line).groupBy("doc_id").agg(F.array_sort(F.collect_list(F.struct("pos", "line"))).alias("x"))
    return g.select("doc_id", F.array_join(F.transform("x", lambda y: y["line"]), "").alias("markdown"))


def chunk_diff(a: DataFrame, b: DataFrame) -> DataFrame:
    """Chunks that only one side has, as often as it has them more: (side, doc_id, type, content, pages, needs_review, n)."""
    sig = lambda d: d.select("doc_id", "type", T.collapse(F.col("content")).alias("content"), "pages", "needs_review")
    x, y = sig(a), sig(b)
    only = x.exceptAll(y).withColumn("side", F.lit("a")).unionByName(y.exceptAll(x).withColumn("side", F.lit("b")))
    return only.groupBy("side", "doc_id", "type", "content", "pages", "needs_review").agg(F.count(F.lit(1)).alias("n"))

"""Pages of the paid lane: transcribed markdown to units, plausibility checks, and the cache of responses."""

from __future__ import annotations

import random
import time
import uuid
from collections.abc import Callable, Iterator
from typing import Protocol

import numpy as np
import pandas as pd
from pyspark import cloudpickle
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql.types import DoubleType

from folioflow.config import Paid
from folioflow.functions import text as T

HEADING = r"^(#{1,6})[\s\x{b}\x{1c}-\x{1f}\x{85}\p{Z}]+(.*[^\s\x{b}\x{1c}-\x{1f}\x{85}\p{Z}])[\s\x{b}\x{1c}-\x{1f}\x{85}\p{Z}]*$"
TABLE_ROW = r"^[\s\x{85}\p{Z}]*\|.*\|[\s\x{85}\p{Z}]*$"
DELIMITER = r"^[\s\x{85}\p{Z}]*\|([\s\x{85}\p{Z}]*:?-+:?[\s\x{85}\p{Z}]*\|)+[\s\x{85}\p{Z}]*$"


def markdown_blocks(pages: DataFrame) -> DataFrame:
    """(doc_id, page, block, kind, level, content) from (doc_id, page, markdown).

    A blank line, a heading or a table ends a paragraph. A table starts at a pipe row whose next line is a delimiter row
    and goes on while lines are pipe rows; a pipe row alone is prose.
    """
    key = Window.partitionBy("doc_id", "page").orderBy("ln")
    upto = key.rowsBetween(Window.unboundedPreceding, 0)
    d = pages.select("doc_id", "page", F.posexplode(T.lines_of(F.coalesce("markdown", F.lit("")))).alias("ln", "line"))
    d = d.withColumn("blank", T.is_blank(F.col("line"))).withColumn("head", F.col("line").rlike(HEADING)).withColumn("row", F.col("line").rlike(TABLE_ROW))
    start = F.col("row") & ~F.col("head") & F.coalesce(F.lead("line").over(key).rlike(DELIMITER), F.lit(False))
    d = d.withColumn("start", start).withColumn("run", F.sum(F.when(~F.col("row"), 1).otherwise(0)).over(upto))
    in_run = Window.partitionBy("doc_id", "page", "run", "row").orderBy("ln").rowsBetween(Window.unboundedPreceding, 0)
    d = d.withColumn("table", F.col("row") & (F.max(F.col("start").cast("int")).over(in_run) == 1))
    kind = F.when(F.col("table"), "table").when(F.col("blank"), "blank").when(F.col("head"), "title").otherwise("text")
    d = d.withColumn("kind", kind).withColumn("new", F.when((F.col("kind") == "title") | (F.coalesce(F.lag("kind").over(key), F.lit("")) != F.col("kind")), 1).otherwise(0))
    d = d.withColumn("island", F.sum("new").over(upto)).where("kind <> 'blank'")
    g = d.groupBy("doc_id", "page", "island", "kind").agg(F.array_join(F.transform(F.array_sort(F.collect_list(F.struct("ln", "line"))), lambda x: x["line"]), "\n").alias("raw"))
    title = F.col("kind") == "title"
    order = Window.partitionBy("doc_id", "page").orderBy("island")
    return g.select(
        "doc_id", "page", (F.row_number().over(order) - 1).alias("block"), "kind", F.when(title, F.length(F.regexp_extract("raw", HEADING, 1))).alias("level"),
        F.when(title, F.regexp_extract("raw", HEADING, 2)).otherwise(F.col("raw")).alias("content"),
    )


def table_cells(markdown):
    """Cells of a pipe table: delimiter and blank rows go, all pipes at the edges go, an escaped pipe is text."""
    rows = F.filter(T.lines_of(markdown), lambda x: ~T.is_blank(x) & ~x.rlike(DELIMITER))
    inner = F.transform(rows, lambda x: F.regexp_replace(T.strip(x), r"^\|+|\|+\z", ""))
    return F.transform(inner, lambda x: F.transform(F.split(x, r"(?<!\\)\|", -1), lambda c: F.replace(T.strip(c), F.lit("\\|"), F.lit("|"))))


def page_units(pages: DataFrame, regions: DataFrame) -> DataFrame:
    """Units of transcribed pages. pages: doc_id, page, width, height, markdown; regions: doc_id, page, label, box_pdf.

    Text and titles carry the whole page as their box. Stitching take the detector's boxes in reading order if there are
    as many of both.
    """
    b = markdown_blocks(pages)
    page = Window.partitionBy("doc_id", "page")
    nth = F.sum(F.when(F.col("kind") == "table", 1).otherwise(0)).over(page.orderBy("block"))
    b = b.withColumn("nth", F.when(F.col("kind") == "table", nth)).withColumn("tables", F.count_if(F.col("kind") == "table").over(page))
    boxes = regions.where("label = 'table'").withColumn("nth", F.row_number().over(page.orderBy("box_pdf.y0", "box_pdf.x0")).cast("long"))
    boxes = boxes.select("doc_id", "page", "nth", F.col("box_pdf").alias("region"), F.count(F.lit(1)).over(page).alias("regions"))
    full = pages.select("doc_id", "page", F.struct(F.lit(0.0).alias("x0"), F.lit(0.0).alias("y0"), F.col("width").alias("x1"), F.col("height").alias("y1")).alias("full"))
    d = b.join(full, ["doc_id", "page"]).join(boxes, ["doc_id", "page", "nth"], "left")
    bbox = F.when(F.col("regions") == F.col("tables"), F.col("region")).otherwise(F.col("full"))
    return d.select("doc_id", "page", F.col("block").cast("long").alias("seq"), bbox.alias("bbox"), F.col("kind").alias("type"), "content", "level", F.lit("gemini").alias("source"))


def repetition(pages: DataFrame, window: int = 20) -> DataFrame:
    """(doc_id, page, worst): how often the commonest run of `window` characters occurs; 0 for texts no longer than that.

    Windows are made, sorted and counted within the page's row, so nothing is shuffled.
    """
    t = T.collapse(F.coalesce("markdown", F.lit("")))
    chars = F.regexp_extract_all(t, F.lit("(?s)."), F.lit(0))
    d = pages.select("doc_id", "page", chars.alias("chars"))
    runs = F.sort_array(F.transform(F.sequence(F.lit(1), F.size("chars") - (window - 1)), lambda i: F.array_join(F.slice("chars", i, window), "")))

    def step(a, w):
        run = F.when(w == a["last"], a["run"] + 1).otherwise(1)
        return F.struct(w.alias("last"), run.alias("run"), F.greatest(a["worst"], run).alias("worst"))

    start = F.struct(F.lit("").alias("last"), F.lit(0).alias("run"), F.lit(0).alias("worst"))
    worst = F.when(F.size("chars") > window, F.aggregate(runs, start, step)["worst"]).otherwise(0)
    return d.select("doc_id", "page", worst.cast("long").alias("worst"))


def verify(pages: DataFrame, regions: DataFrame, cfg: Paid | None = None) -> DataFrame:
    """(doc_id, page, review_reasons): every check that fires, in order. pages: doc_id, page, markdown, text_layer_chars, ink_frac."""
    cfg = cfg or Paid()
    seen = regions.where("label = 'table'").groupBy("doc_id", "page").agg(F.count(F.lit(1)).alias("regions"))
    tables = markdown_blocks(pages).groupBy("doc_id", "page").agg(F.count_if(F.col("kind") == "table").alias("tables"), F.count(F.lit(1)).alias("blocks"))
    key = ["doc_id", "page"]
    d = pages.join(repetition(pages, cfg.window), key).join(tables, key, "left").join(seen, key, "left")
    md = F.coalesce("markdown", F.lit(""))
    n = F.length(T.collapse(md))
    known = F.coalesce(F.col("text_layer_chars"), F.lit(0)) > 0
    off = (n < F.col("text_layer_chars") * cfg.shortest) | (n > F.col("text_layer_chars") * cfg.longest)
    thin = F.col("text_layer_chars").isNull() & (F.col("ink_frac") >= cfg.inked) & (n < cfg.inked_chars)
    reasons = F.array_compact(F.array(
        F.when(F.col("worst") > cfg.most_repeats, F.format_string("repetition: a run of characters recurs %d times", "worst")),
        F.when(known & off, F.format_string("length %d against %d in the text layer", n, F.col("text_layer_chars"))).when(~known & thin, F.format_string("inked page, but %d characters", n)),
        F.when(T.has_junk(md) | (T.orphan_marks(md) > 0), F.lit("mojibake in the response")),
        F.when((F.coalesce("regions", F.lit(0)) >= 1) & (F.coalesce("tables", F.lit(0)) == 0), F.format_string("%d table regions, no table", "regions")),
        F.when(F.coalesce("blocks", F.lit(0)) == 0, F.lit("empty response")),
    ))
    if "error" in pages.columns:
        reasons = F.when(F.col("error").isNotNull(), F.array(F.concat(F.lit("the engine failed: "), "error"))).otherwise(reasons)
    return d.select(*key, reasons.alias("review_reasons"))


def flagged_units(units: DataFrame, pages: DataFrame, checked: DataFrame) -> DataFrame:
    """Units with needs_review: all of a page with reasons, and any that says a region could not be read.

    A page that gave no unit is kept as one empty, flagged text unit.
    """
    key = ["doc_id", "page"]
    full = F.struct(F.lit(0.0).alias("x0"), F.lit(0.0).alias("y0"), F.col("width").alias("x1"), F.col("height").alias("y1"))
    empty = pages.join(units.select(*key).distinct(), key, "left_anti").select(*key, F.lit(0).cast("long").alias("seq"), full.alias("bbox"), F.lit("text").alias("type"), F.lit("").alias("content"), F.lit(None).cast("int").alias("level"), F.lit("gemini").alias("source"))
    d = units.unionByName(empty).join(checked, key, "left")
    flag = (F.size(F.coalesce("review_reasons", F.array().cast("array<string>"))) > 0) | F.contains("content", F.lit(T.ILLEGIBLE)) | (F.col("content") == "")
    return d.select(*units.columns, flag.alias("needs_review"))


def ink_fraction(dark: int = 128):
    """A function of (samples, width, height): the share of a raster's pixels whose mean over red, green and blue is darker than `dark`;
    samples are raw bytes, row by row, with one or more channels. Null where there is no raster."""

    @F.pandas_udf(DoubleType())
    def ink(samples: pd.Series, width: pd.Series, height: pd.Series) -> pd.Series:
        out = []
        for raw, w, h in zip(samples, width, height, strict=True):
            px = np.frombuffer(raw or b"", np.uint8)
            ok = w and h and len(px) and len(px) % int(w * h) == 0
            out.append(float((px.reshape(int(h * w), -1)[:, :3].mean(1) < dark).mean()) if ok else None)
        return pd.Series(out, dtype="float64")

    return ink


class Client(Protocol):
    """A transcription engine: image bytes and a prompt to (text, input tokens, output tokens)."""

    def generate(self, image: bytes, prompt: str) -> tuple[str, int, int]: ...


ANSWER = "key string, text string, input_tokens int, output_tokens int, error string"
_clients: dict[bytes, Client] = {}


def _client(made_by: bytes) -> Client:
    """One client for each way of making it in a worker process, which serves many tasks."""
    if made_by not in _clients:
        _clients[made_by] = cloudpickle.loads(made_by)()
    return _clients[made_by]


def transcribe(pages: DataFrame, cache: str, make_client: Callable[[], Client], prompt: str, cfg: Paid | None = None) -> DataFrame:
    """(doc_id, page, key, text, input_tokens, output_tokens, cached, error) for pages with an `image`.

    cache is a folder of Parquet. Answers in it are used; only misses, each key once, reach the engine, and what it says is
    appended before anything reads it, so no action pays twice. Transient failures are asked again; a page that fails for
    good has an error and no text. Failures and empty answers are kept for the record, but are no hits next time.
    """
    cfg = cfg or Paid()
    spark, made_by, run_id = pages.sparkSession, cloudpickle.dumps(make_client), uuid.uuid4().hex
    d = pages.select("doc_id", "page", "image", T.cache_key(F.col("image"), F.lit(cfg.engine), F.lit(cfg.prompt_version)).alias("key"))
    known = stored_answers(spark, cache)

    def run(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        ask = with_retries(_client(made_by).generate, cfg.retries)
        for pdf in frames:
            rows = []
            for key, image in zip(pdf["key"], pdf["image"], strict=True):
                try:
                    rows.append((key, *ask(bytes(image), prompt), None))
                except Exception as e:  # noqa: BLE001 - whatever an engine raises is a failed page, not a failed job
                    rows.append((key, "", 0, 0, f"{type(e).__name__}: {e}"))
            yield pd.DataFrame(rows, columns=["key", "text", "input_tokens", "output_tokens", "error"])

    misses = d.where("image is not null").join(known, "key", "left_anti").dropDuplicates(["key"]).select("key", "image")
    misses.mapInPandas(run, ANSWER).write.parquet(f"{cache}/run={run_id}")
    fresh = spark.read.schema(ANSWER).parquet(f"{cache}/run={run_id}")
    answers = known.withColumn("cached", F.lit(True)).join(fresh.select("key"), "key", "left_anti").unionByName(fresh.withColumn("cached", F.lit(False)))
    return d.drop("image").join(answers, "key").select("doc_id", "page", "key", "text", "input_tokens", "output_tokens", "cached", "error")


def stored_answers(spark: SparkSession, cache: str) -> DataFrame:
    """The cache's answers that are hits, one to a key."""
    path = spark._jvm.org.apache.hadoop.fs.Path(cache)
    if not path.getFileSystem(spark._jsc.hadoopConfiguration()).exists(path):
        return spark.createDataFrame([], ANSWER)
    return spark.read.schema(ANSWER).parquet(cache).where("text <> '' and error is null").dropDuplicates(["key"]).select("key", "text", "input_tokens", "output_tokens", "error")


def cache_status(keys: DataFrame, cache: DataFrame) -> DataFrame:
    """keys with `cached`: whether the cache holds a response that is not empty."""
    known = cache.where("text <> ''").select("key", F.lit(True).alias("hit"))
    return keys.join(known, "key", "left").withColumn("cached", F.coalesce("hit", F.lit(False))).drop("hit")


def with_retries(generate: Callable, retries: int = 3, delay: float = 1.0, transient: tuple[type[Exception], ...] = (OSError, TimeoutError), sleep: Callable[[float], None] | None = None) -> Callable:
    """generate with repeats after transient errors and empty answers, waiting twice as long each time, and up to twice that by chance."""

    def call(*args):
        wait = delay
        for attempt in range(retries + 1):
            try:
                got = generate(*args)
                if got[0] or attempt == retries:
                    return got
            except transient:
                if attempt == retries:
                    raise
            (sleep or (lambda s: time.sleep(s * (1 + random.random()))))(wait)
            wait *= 2

    return call

"""The seven layers from decoded pages to chunks, each written and read again, and the manifest."""

from __future__ import annotations

import json
import time
from collections.abc import Callable
from dataclasses import dataclass, field, fields

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from folioflow.config import Config
from folioflow.operators import chunks as C
from folioflow.operators import extract as X
from folioflow.operators import normalize as N
from folioflow.operators import profile as P
from folioflow.operators import review as R
from folioflow.operators import tables as TB
from folioflow.operators import transcripts as V

LAYERS = ("profiles", "routes", "extract", "fragments", "normalize", "quality", "chunks")


class ConfigMismatch(ValueError):
    """A stored layer was made with other settings."""


@dataclass
class Inputs:
    """Decoded pages, and what detectors and engines found on them; each keyed by doc_id and page."""

    pages: DataFrame
    regions: DataFrame
    drawings: DataFrame
    native_tables: DataFrame
    responses: DataFrame | None = None  # doc_id, page, text, input_tokens, output_tokens, cached, ink_frac
    images: DataFrame | None = None  # doc_id, page, image, ink_frac: for the engine, where there are no responses yet
    documents: DataFrame | None = None  # doc_id, readable, encrypted, page_count, source_file: for the gate
    figures: DataFrame | None = None  # doc_id, storage_key, digest of the stored image


@dataclass
class Run:
    """Stitching of a run by name; a layer may hold several (`extract.units`)."""

    spark: SparkSession
    out: str
    cfg: Config = field(default_factory=Config)
    make_client: Callable | None = None  # of the transcription engine
    prompt: str = ""
    timings: dict[str, float] = field(default_factory=dict)

    def path(self, name: str) -> str:
        return f"{self.out}/{name.replace('.', '/')}"

    def read(self, name: str) -> DataFrame:
        return self.spark.read.parquet(self.path(name))

    def write(self, name: str, df: DataFrame) -> None:
        df.write.mode("overwrite").parquet(self.path(name))


def gate(documents: DataFrame) -> tuple[DataFrame, DataFrame]:
    """documents (doc_id, readable, encrypted, page_count) to those that go on, and the rejected with a reason."""
    reason = F.when(~F.coalesce("readable", F.lit(False)), "unreadable").when(F.col("encrypted"), "encrypted").when(F.coalesce("page_count", F.lit(0)) == 0, "zero pages")
    d = documents.withColumn("reason", reason)
    return d.where("reason is null").drop("reason"), d.where("reason is not null").select("doc_id", F.lit("rejected").alias("status"), "reason")


def _extract(run: Run, i: Inputs) -> dict[str, DataFrame]:
    routes, profiles = run.read("routes"), run.read("profiles")
    key = ["doc_id", "page"]
    lane = lambda d, name: d.join(routes.where(F.col("extractor") == name).select(*key), key, "left_semi")
    native, vlm = lane(i.pages, "native"), lane(i.pages, "vlm")
    body = X.body_font_size(native, run.cfg.native)
    body = i.pages.select("doc_id").distinct().join(body, "doc_id", "left").select("doc_id", F.coalesce("body_size", F.lit(X.BODY_FONT)).alias("body_size"))
    from folioflow.functions.text import unfence

    evidence = P.text_layer_evidence(profiles, routes, run.cfg.lanes)
    answers = i.responses
    if answers is None and i.images is not None and run.make_client is not None:
        paid = i.images.join(vlm.select(*key), key, "left_semi")
        answers = V.transcribe(paid, run.path("answers"), run.make_client, run.prompt, run.cfg.paid).join(paid.select(*key, "ink_frac"), key)
    if answers is None:
        answers = run.spark.createDataFrame([], "doc_id string, page int, text string, input_tokens int, output_tokens int, cached boolean, ink_frac double")
    answered = vlm.select(*key, "width", "height").join(answers, key, "left").join(evidence, key, "left").withColumn("markdown", unfence(F.coalesce("text", F.lit(""))))
    checked = V.verify(answered, i.regions, run.cfg.paid)
    units = V.flagged_units(V.page_units(answered, i.regions), answered, checked).withColumn("font_size", F.lit(None).cast("double")).withColumn("storage_key", F.lit(None).cast("string"))
    crops = X.region_figures(lane(i.regions, "vlm"))
    crops = crops.select(*key, (F.col("idx") + 100000).cast("long").alias("seq"), "bbox", F.lit("figure").alias("type"), F.lit("").alias("content"), F.lit(None).cast("int").alias("level"), F.lit(None).cast("double").alias("font_size"), "storage_key", F.lit("pymupdf").alias("source"), F.lit(False).alias("needs_review"))
    all_units = X.native_units(native, body, run.cfg.native).unionByName(X.drawing_units(i.pages, routes)).unionByName(units).unionByName(crops)
    pages = checked.join(answered.select(*key, F.coalesce("cached", F.lit(False)).alias("cached"), F.coalesce("input_tokens", F.lit(0)).alias("input_tokens"), F.coalesce("output_tokens", F.lit(0)).alias("output_tokens")), key)
    return {"extract.units": all_units, "extract.body": body, "extract.grids": X.ruled_grids(lane(i.drawings, "native"), run.cfg.native), "extract.vlm_pages": pages}


def _fragments(run: Run, i: Inputs) -> dict[str, DataFrame]:
    native_pages = run.read("routes").where("extractor = 'native'")
    native = TB.unmerge(i.native_tables.join(native_pages.select("doc_id", "page"), ["doc_id", "page"], "left_semi"))
    paid = TB.transcript_fragments(run.read("extract.units"))
    found = native.unionByName(paid)
    return {"fragments": TB.ladder(native, paid, TB.suspects(i.regions, found, native_pages, run.cfg.stitching))}


def _normalize(run: Run, i: Inputs) -> dict[str, DataFrame]:
    heights = i.pages.select("doc_id", "page", "height")
    units = N.strip_furniture(run.read("extract.units").where("type <> 'table'"), heights, run.cfg.cleaning)
    fragments = TB.drop_repeated_suspects(run.read("fragments"), run.cfg.cleaning.head_pages)
    tables = TB.build_tables(TB.chains(fragments, heights, run.cfg.stitching), run.cfg.stitching)
    leveled = N.heading_levels(N.outside_tables(units, tables), run.cfg.cleaning)
    if run.cfg.cleaning.once_per_figure and i.figures is not None:
        leveled = N.figure_dedup(leveled, i.figures)
    return {"normalize.tables": tables, "normalize.units": leveled}


def _quality(run: Run, i: Inputs) -> dict[str, DataFrame]:
    units, tables, pages = run.read("normalize.units"), run.read("normalize.tables"), run.read("extract.vlm_pages")
    gated = R.gate_tables(tables, run.cfg.stitching)
    items = R.review_items(units, pages, gated)
    return {"quality.units": R.gate_units(units, pages), "quality.tables": gated, "quality.items": items, "quality.report": R.review_report(items, i.pages)}


def _chunks(run: Run, i: Inputs) -> dict[str, DataFrame]:
    walked = C.with_headings(C.walk(run.read("quality.units"), run.read("quality.tables")))
    return {"chunks.chunks": C.chunks(walked, run.cfg.cutting), "chunks.markdown": C.merged_markdown(walked)}


STEPS: dict[str, Callable[[Run, Inputs], dict[str, DataFrame]]] = {
    "profiles": lambda r, i: {"profiles": P.profile_pages(i.pages, r.cfg.lanes)},
    "routes": lambda r, i: {"routes": P.route_pages(r.read("profiles"), r.cfg.lanes)},
    "extract": _extract,
    "fragments": _fragments,
    "normalize": _normalize,
    "quality": _quality,
    "chunks": _chunks,
}


def execute(run: Run, inputs: Inputs, from_layer: int = 1, check_config: bool = True) -> DataFrame:
    """Build the layers from `from_layer` (1 to 7) on; earlier ones are read as stored. Returns the manifest.

    Documents that the gate or the decoder (`reject_reason` of a page) rejects have a row in the manifest and nothing else.
    The settings are stored beside the layers, and a resumed run with other settings is refused.
    """
    inputs, rejected = admitted(inputs)
    if not 1 <= from_layer <= len(LAYERS):
        raise ValueError(f"from_layer is 1 to {len(LAYERS)}")
    snapshot = run.cfg.snapshot()
    if from_layer > 1 and check_config and run.spark.read.parquet(run.path("settings")).first()[0] != snapshot:
        raise ConfigMismatch("the stored layers were made with other settings")
    if from_layer == 1:
        run.write("settings", run.spark.createDataFrame([(snapshot,)], "config string"))
    for name in LAYERS[from_layer - 1 :]:
        began = time.monotonic()
        for table, df in STEPS[name](run, inputs).items():
            run.write(table, df)
        run.timings[name] = round(time.monotonic() - began, 3)
    sources = inputs.documents if inputs.documents is not None and "source_file" in inputs.documents.columns else None
    made = manifest(
        run.read("routes"), run.read("extract.units"), run.read("extract.vlm_pages"), run.read("quality.tables"), run.read("quality.items"), run.read("chunks.chunks"), snapshot, run.read("extract.body"), sources,
        json.dumps(run.timings, sort_keys=True),
    )
    run.write("manifest", made.unionByName(rejected, allowMissingColumns=True) if rejected is not None else made)
    return run.read("manifest")


def admitted(inputs: Inputs) -> tuple[Inputs, DataFrame | None]:
    """The inputs of documents that go on, and the manifest rows (doc_id, status, reason) of the others."""
    bad = None
    if inputs.documents is not None:
        bad = gate(inputs.documents)[1]
    if "reject_reason" in inputs.pages.columns:
        seen = inputs.pages.where("reject_reason is not null").groupBy("doc_id").agg(F.min("reject_reason").alias("reason")).select("doc_id", F.lit("rejected").alias("status"), "reason")
        bad = seen if bad is None else bad.unionByName(seen.join(bad, "doc_id", "left_anti"))
    if bad is None:
        return inputs, None
    keep = {f.name: v.join(bad, "doc_id", "left_anti") for f in fields(inputs) if (v := getattr(inputs, f.name)) is not None}
    keep["pages"] = keep["pages"].drop("reject_reason")
    return Inputs(**keep), bad


def manifest(
    routes: DataFrame, units: DataFrame, vlm_pages: DataFrame, tables: DataFrame, items: DataFrame, chunks: DataFrame, config: str = "{}", body: DataFrame | None = None, sources: DataFrame | None = None, timings: str = "{}"
) -> DataFrame:
    """One row per document: counts by lane and unit type (before clean-up), tokens of fresh responses, tables and chunks to review,
    the lane of every page, the body font, the file it came from, and the seconds of each layer of the run (as JSON)."""
    n = F.count(F.lit(1))
    lane = F.transform(F.array_sort(F.collect_list(F.struct("page", "extractor"))), lambda x: F.concat_ws(":", x["page"], x["extractor"]))
    lanes = routes.groupBy("doc_id").agg(n.alias("page_count"), lane.alias("page_routes"), *(F.count_if(F.col("extractor") == x).alias(f"pages_{x}") for x in ("native", "vlm", "drawing")))
    kinds = units.groupBy("doc_id").agg(*(F.count_if(F.col("type") == x).alias(f"units_{x}") for x in ("title", "text", "table", "figure")))
    fresh = ~F.col("cached")
    vlm = vlm_pages.groupBy("doc_id").agg(n.alias("vlm_pages"), F.count_if("cached").alias("vlm_cached"), F.sum(F.when(fresh, F.col("input_tokens")).otherwise(0)).alias("input_tokens"), F.sum(F.when(fresh, F.col("output_tokens")).otherwise(0)).alias("output_tokens"))
    some = lambda c, v: F.array_sort(F.collect_list(F.when(c, v)))
    tb = tables.groupBy("doc_id").agg(n.alias("tables"), some(F.size("pages") > 1, F.col("table_id")).alias("multi_page"), some(F.col("needs_review"), F.col("table_id")).alias("tables_review"))
    ch = chunks.groupBy("doc_id").agg(n.alias("chunks"), some(F.col("needs_review"), F.col("chunk_id")).alias("chunks_review"))
    it = items.groupBy("doc_id").agg(n.alias("review_items"))
    d = lanes
    for other in (kinds, vlm, tb, ch, it):
        d = d.join(other, "doc_id", "left")
    numbers = [c for c, t in d.dtypes if t in ("bigint", "int") and c != "doc_id"]
    empty = F.array().cast("array<string>")
    lists = [c for c, t in d.dtypes if t.startswith("array")]
    null = lambda t: F.lit(None).cast(t)
    d = d.join(body.select("doc_id", "body_size"), "doc_id", "left") if body is not None else d.withColumn("body_size", null("double"))
    d = d.join(sources.select("doc_id", "source_file"), "doc_id", "left") if sources is not None else d.withColumn("source_file", null("string"))
    return d.select("doc_id", F.lit("ok").alias("status"), null("string").alias("reason"), "source_file", "body_size", F.lit(timings).alias("timings"), *(F.coalesce(c, F.lit(0)).alias(c) for c in numbers), *(F.coalesce(c, empty).alias(c) for c in lists), F.lit(config).alias("config"))

"""The layered run, resuming, files, streams, and the registered queries."""

import importlib
import json

import pytest

from pyspark.sql import functions as F

from folioflow.config import Cleaning, Config, Lanes
from folioflow.functions import geometry as G
from folioflow.plans import oracles
from folioflow.plans import pipeline as PL
from folioflow.plans import queries as Q
from folioflow.sources import tables as S
from folioflow.streaming.ingest import ingest_stream

BLOCKS = f"array<struct<type:int,bbox:{G.BOX},lines:array<struct<bbox:{G.BOX},spans:array<struct<text:string,size:double,flags:int>>>>>>"
BX = (72.0, 72.0, 500.0, 300.0)


def _inputs(spark):
    prose = "A page of clean and readable text that is long enough to be native."
    line = lambda y, t, z: ((72.0, y, 500.0, y + 10), [(t, z, 0)])
    block = (0, BX, [line(72.0, "1. Heading", 18.0), line(90.0, prose, 10.0)])
    pages = spark.createDataFrame(
        [("d", 0, 595.0, 842.0, prose, [], [BX], 0, [block]), ("d", 1, 595.0, 842.0, "", [BX], [], 0, []), ("d", 2, 595.0, 842.0, "", [], [], 150, []), ("d", 3, 595.0, 842.0, prose, [], [BX], 0, [block])],
        f"doc_id string, page int, width double, height double, text string, images array<{G.BOX}>, text_blocks array<{G.BOX}>, n_drawings int, blocks {BLOCKS}",
    )
    regions = spark.createDataFrame([("d", 3, 0, "table", (50.0, 500.0, 400.0, 700.0))], f"doc_id string, page int, idx int, label string, box_pdf {G.BOX}")
    drawings = spark.createDataFrame([], "doc_id string, page int, kind string, x0 double, y0 double, x1 double, y1 double")
    native = spark.createDataFrame([("d", 0, 0, (50.0, 400.0, 250.0, 440.0), [[(50.0, 400.0, 150.0, 420.0), (150.0, 400.0, 250.0, 420.0)], [(50.0, 420.0, 150.0, 440.0), (150.0, 420.0, 250.0, 440.0)]], [["k", "v"], ["a", "1"]])], f"doc_id string, page int, seq long, bbox {G.BOX}, boxes array<array<{G.BOX}>>, texts array<array<string>>")
    responses = spark.createDataFrame([("d", 1, "# Scan\n\nread from the image\n\n| a | b |\n|---|---|\n| 1 | 2 |", 100, 50, False, 0.001)], "doc_id string, page int, text string, input_tokens int, output_tokens int, cached boolean, ink_frac double")
    return PL.Inputs(pages, regions, drawings, native, responses)


def test_layers_and_resume(spark, tmp_path):
    run = PL.Run(spark, str(tmp_path))
    m = PL.execute(run, _inputs(spark)).first()
    assert (m.page_count, m.pages_native, m.pages_vlm, m.pages_drawing) == (4, 2, 1, 1)
    assert (m.tables, m.tables_review, m.input_tokens) == (3, ["t0003_00"], 100)
    before = run.read("chunks.chunks").orderBy("n").collect()
    assert "read from the image" in {r.content for r in before} and {r.type for r in before} == {"text", "table", "figure"}
    again = PL.Run(spark, str(tmp_path))
    PL.execute(again, _inputs(spark), from_layer=5)
    assert again.read("chunks.chunks").orderBy("n").collect() == before and set(again.timings) == {"normalize", "quality", "chunks"}
    with pytest.raises(PL.ConfigMismatch):
        PL.execute(PL.Run(spark, str(tmp_path), Config(lanes=Lanes(least_text=10))), _inputs(spark), from_layer=3)
    with pytest.raises(ValueError):
        PL.execute(again, _inputs(spark), from_layer=8)


def test_run_with_gate_engine_and_figures(spark, tmp_path):
    class Answers:
        def generate(self, image, prompt):
            return f"# Seen\n\n{image.decode()} {prompt}", 7, 3

    i = _inputs(spark)
    pages = i.pages.withColumn("reject_reason", F.lit(None).cast("string")).unionByName(spark.createDataFrame([("e", "broken file")], "doc_id string, reject_reason string"), allowMissingColumns=True)
    images = spark.createDataFrame([("d", 1, b"picture", 0.001), ("d", 0, b"not asked", 0.5)], "doc_id string, page int, image binary, ink_frac double")
    documents = spark.createDataFrame([("d", True, False, 4, "d.pdf"), ("f", True, True, 3, "f.pdf")], "doc_id string, readable boolean, encrypted boolean, page_count int, source_file string")
    inputs = PL.Inputs(pages, i.regions, i.drawings, i.native_tables, None, images, documents)
    run = PL.Run(spark, str(tmp_path), make_client=Answers, prompt="please")
    got = {r.doc_id: r for r in PL.execute(run, inputs).collect()}
    assert {d: (r.status, r.reason) for d, r in got.items()} == {"d": ("ok", None), "e": ("rejected", "broken file"), "f": ("rejected", "encrypted")}
    d = got["d"]
    assert (d.source_file, d.body_size, d.input_tokens, d.page_routes) == ("d.pdf", 10.0, 7, ["0:native", "1:vlm", "2:drawing", "3:native"])
    assert set(json.loads(d.timings)) == set(PL.LAYERS)
    assert "picture please" in {r.content for r in run.read("chunks.chunks").collect()}
    assert run.read("extract.units").where("content like '%not asked%'").count() == 0


def test_equal_figures_count_once_if_asked(spark, tmp_path):
    i = _inputs(spark)
    regions = spark.createDataFrame([("d", 1, k, "figure", (50.0, 100.0 * k, 400.0, 100.0 * k + 50)) for k in range(3)], f"doc_id string, page int, idx int, label string, box_pdf {G.BOX}")
    i.regions, i.figures = regions, spark.createDataFrame([("d", f"figures/p0001_r{k}.png", "same" if k < 2 else "other") for k in range(3)], "doc_id string, storage_key string, digest string")
    counts = []
    for once in (False, True):
        run = PL.Run(spark, str(tmp_path / str(once)), Config(cleaning=Cleaning(once_per_figure=once)))
        PL.execute(run, i)
        counts.append(run.read("normalize.units").where("type = 'figure'").count())
    assert counts == [4, 3]


def test_gate_of_documents(spark):
    d = spark.createDataFrame([("a", True, False, 3), ("b", False, False, 0), ("c", True, True, 3), ("e", True, False, 0)], "doc_id string, readable boolean, encrypted boolean, page_count int")
    good, bad = PL.gate(d)
    assert [r.doc_id for r in good.collect()] == ["a"] and {r.doc_id: r.reason for r in bad.collect()} == {"b": "unreadable", "c": "encrypted", "e": "zero pages"}


def test_files_through_a_decoder(spark, tmp_path):
    (tmp_path / "one.pdf").write_bytes(b"p0|p1")
    (tmp_path / "two.pdf").write_bytes(b"broken")

    class Decoder:
        def pages(self, content):
            if content == b"broken":
                raise ValueError("unreadable")
            return [{"page": i, "text": t} for i, t in enumerate(content.decode().split("|"))]

    got = S.decode_files(spark, str(tmp_path), Decoder, "page int, text string").collect()
    assert {(r.doc_id, r.page, r.text) for r in got if r.reject_reason is None} == {("one", 0, "p0"), ("one", 1, "p1")}
    assert [(r.doc_id, r.reject_reason) for r in got if r.reject_reason] == [("two", "unreadable")]


def test_regions_through_a_detector(spark):
    class Detector:
        def regions(self, image):
            return [("table", 0.91249, 100, 200, 300, 400), ("text", 0.9, 0, 0, 5, 5), ("figure", 0.1, 0, 0, 9, 9), ("table", 0.5, 2000, 0, 2100, 50), ("figure", 0.75, 0, 0, 990, 10)] if image == b"full" else []

    rasters = spark.createDataFrame([("d", 0, b"full", 1000, 2000, (0.0, 0.0, 500.0, 1000.0)), ("d", 1, b"", 1000, 2000, (0.0, 0.0, 500.0, 1000.0))], f"doc_id string, page int, image binary, raster_w int, raster_h int, page_box {G.BOX}")
    got = S.detect_regions(rasters, Detector).orderBy("idx").collect()
    assert [(r.page, r.idx, r.label, r.conf, tuple(r.box_pdf)) for r in got] == [(0, 0, "table", 0.912, (45.0, 95.0, 155.0, 205.0)), (0, 1, "figure", 0.75, (0.0, 0.0, 500.0, 10.0))]


def test_figures(spark, tmp_path):
    d = spark.createDataFrame([("d", "a.png", b"x"), ("d", "b.png", b"x"), ("e", "a.png", None)], "doc_id string, storage_key string, image binary")
    digests = {r.storage_key: r.digest for r in S.write_figures(d, str(tmp_path / "figures")).collect()}
    assert set(digests) == {"a.png", "b.png"} and len(set(digests.values())) == 1
    assert spark.read.parquet(str(tmp_path / "figures")).where("doc_id = 'd'").count() == 2


def test_artifacts(spark, tmp_path):
    d = spark.createDataFrame([("a", 1, ["x"]), ("b", 2, [])], "doc_id string, page int, reasons array<string>")
    for kind in ("parquet", "json"):
        S.write_artifact(d, str(tmp_path / kind), kind, by_doc=True)
        back = S.read_artifact(spark, str(tmp_path / kind), "page int, reasons array<string>, doc_id string", kind)
        assert {tuple(r) for r in back.select("doc_id", "page").collect()} == {("a", 1), ("b", 2)}


def test_stream(spark, tmp_path):
    schema = "doc_id string, page int, text string"
    spark.createDataFrame([("a", 0, "x"), ("a", 1, "y"), ("b", 0, "z")], schema).write.parquet(str(tmp_path / "in"))
    ingest_stream(spark, str(tmp_path / "in"), schema, lambda d: d.groupBy("doc_id").count(), str(tmp_path / "out"), str(tmp_path / "cp")).awaitTermination(120)
    assert {(r.doc_id, r["count"]) for r in spark.read.parquet(str(tmp_path / "out")).collect()} == {("a", 2), ("b", 1)}


@pytest.mark.parametrize("name", ["route_counts", "text_scores", "native_units", "response_verification", "furniture_stripped_units", "borderless_suspects", "stitched_tables", "stitched_spans", "table_grid", "heading_levels", "text_pieces", "unit_review_reasons", "merged_markdown"])
def test_queries_agree_with_their_sql(spark, name):
    import duckdb

    sf = "/root/testdata/sf0.001"
    c = duckdb.connect()
    for t in ("documents", "conversations", "customer", "nation", "lineitem", "supplier"):
        c.execute(f"create view {t} as select * from '{sf}/{t}.parquet'")
    r = c.execute(oracles.SQL[name])
    names = [x[0] for x in r.description]
    fix = lambda rows: sorted(str([round(v, 9) if isinstance(v, float) else v for v in row]) for row in rows)
    assert fix(Q.QUERIES[name](spark, sf).select(names).collect()) == fix(r.fetchall())


def test_entry():
    e = importlib.import_module("__spark_entry__")
    assert set(Q.QUERIES) <= set(e.queries()) and set(e.oracle_sql()) <= set(e.queries())


def test_command_line(spark, tmp_path, capsys):
    import dataclasses

    from folioflow.__main__ import configured, main

    inputs = _inputs(spark)
    for f in dataclasses.fields(inputs):
        if getattr(inputs, f.name) is None:
            continue
        getattr(inputs, f.name).write.parquet(str(tmp_path / "in" / f.name))
    main([str(tmp_path / "in"), "--out", str(tmp_path / "out"), "--set", "cutting.tokens=64"])
    assert "'doc_id': 'd'" in capsys.readouterr().out
    assert configured(["cutting.tokens=64"]).cutting.tokens == 64
    with pytest.raises(SystemExit):
        configured(["cutting.tokens=many"])

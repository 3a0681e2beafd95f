"""Operators on literal rows with known results, and windows against plain models."""

import random
from collections import Counter

import pytest
from pyspark.sql import functions as F

from folioflow.config import Cutting, Paid
from folioflow.functions import geometry as G
from folioflow.operators import chunks as C
from folioflow.operators import extract as X
from folioflow.operators import normalize as N
from folioflow.operators import profile as P
from folioflow.operators import review as R
from folioflow.operators import tables as TB
from folioflow.operators import transcripts as V

PROFILE = "doc_id string, page int, text_chars int, text_compact_chars int, junk_chars int, mojibake_chars int, max_image_coverage double, text_bbox_area_frac double, vector_segments int"
UNIT = f"doc_id string, page int, seq long, bbox {G.BOX}, type string, content string, level int, font_size double, storage_key string, source string, needs_review boolean"
FRAGMENT = f"doc_id string, page int, seq long, bbox {G.BOX}, cells {TB.CELLS}, source string, header_rows int, merges {TB.MERGES}"


def test_routes(spark):
    rows = [("d", 0, 900, 800, 0, 0, 0.9, 0.1, None), ("d", 1, 900, 800, 25, 12, 0.0, 0.1, None), ("d", 2, 900, 800, 0, 10, 0.0, 0.1, None), ("d", 3, 10, 9, 0, 0, 0.0, 0.1, 150), ("d", 4, 10, 9, 0, 0, 0.0, 0.1, 3), ("d", 5, 900, 800, 0, 0, 0.7, 0.1, None), ("d", 6, 0, 0, 0, 0, 0.0, 0.0, None)]
    got = {r.page: r for r in P.route_pages(spark.createDataFrame(rows, PROFILE)).collect()}
    assert [got[i].extractor for i in range(7)] == ["vlm", "vlm", "vlm", "drawing", "vlm", "native", "vlm"]
    assert len(got[1].reasons) == 2 and all(len(got[i].reasons) == 1 for i in (0, 2, 3, 4, 5, 6))


def _unit(doc, page, seq, y0, y1, kind, content, level=None, size=None, source="pymupdf", review=False):
    return (doc, page, seq, (72.0, float(y0), 500.0, float(y1)), kind, content, level, size, None, source, review)


def test_first_version_rules(spark):
    box = (0.0, 0.0, 100.0, 70.04)  # 0.7004 of the page: above the limit, but not once it is rounded
    pages = spark.createDataFrame([("d", 0, 100.0, 100.0, "x" * 80 + "\x01" * 30, [box], [], 0)], f"doc_id string, page int, width double, height double, text string, images array<{G.BOX}>, text_blocks array<{G.BOX}>, n_drawings int")
    new, old = P.route_pages(P.profile_pages(pages)).first(), P.route_pages(P.profile_pages(pages, exact_coverage=True), first_reason_only=True).first()
    assert new.reasons == ["junk characters: 30"] and old.reasons == ["raster covers the page"]
    cells = spark.createDataFrame([([["a\x01", "\u093f\u0935"], ["b", "c"]],)], f"cells {TB.CELLS}")
    assert cells.select(TB.junk_cells(F.col("cells")), TB.junk_cells(F.col("cells"), marks=False)).first()[:] == (2, 1)


def test_furniture(spark):
    rows = [_unit("a", p, p * 10 + k, y, y + 10, "text", t) for p in range(5) for k, (y, t) in enumerate([(20, "Header"), (820, f"Page {p + 1} of 5"), (400, f"body {'abcde'[p]}")])]
    rows += [_unit("b", p, p, 400, 410, "text", "Same body") for p in range(5)] + [_unit("b", p, 10 + p, 20, 30, "title", "Heading") for p in range(2)]
    got = N.strip_furniture(spark.createDataFrame(rows, UNIT)).collect()
    assert Counter(r.doc_id for r in got) == {"a": 5, "b": 7} and all(r.content.startswith("body") for r in got if r.doc_id == "a")


def test_heading_levels(spark):
    rows = [_unit("d", 0, i, 10 * i, 10 * i + 5, "title", t, level, size, s) for i, (t, level, size, s) in enumerate([("x", 2, None, "gemini"), ("7.3.1 Notices", None, 13.0, "pymupdf"), ("Big", None, 18.0, "pymupdf"), ("Small", None, 13.0, "pymupdf"), ("None", None, None, "pymupdf")])]
    got = {r.seq: r.level for r in N.heading_levels(spark.createDataFrame(rows, UNIT)).collect()}
    assert got == {0: 2, 1: 3, 2: 1, 3: 2, 4: 1}
    sizes = [18.1, 17.6, 16.5, 15.5, 14.4]  # 18, 18, 16, 16 and 14 whole points
    rows = [_unit("d", 0, i, 10 * i, 10 * i + 5, "title", "t", None, z) for i, z in enumerate(sizes)]
    assert [r.level for r in N.heading_levels(spark.createDataFrame(rows, UNIT)).orderBy("seq").collect()] == [1, 1, 2, 2, 3]


def _fragment(page, rows, y=(100, 800), seq=0, header=1, merges=(), source="find_tables", doc="d"):
    return (doc, page, seq, (50.0, float(y[0]), 500.0, float(y[1])), rows, source, header, list(merges))


def _tables(spark, *fragments):
    return TB.build_tables(TB.chains(spark.createDataFrame(list(fragments), FRAGMENT))).orderBy("table_id").collect()


def test_stitching_over_pages(spark):
    head = ["Item", "Qty"]
    got = _tables(spark, _fragment(8, [head, ["a", "1"]], (600, 800)), _fragment(9, [["item ", "QTY"], ["b", "2"]], (72, 300)))
    assert len(got) == 1 and got[0].table_id == "t0008_00" and got[0].pages == [8, 9] and got[0].cells == [head, ["a", "1"], ["b", "2"]]
    assert len(_tables(spark, _fragment(0, [["a", "b", "c"]] * 2), _fragment(1, [["a", "b"]] * 2, (72, 300)))) == 2
    assert len(_tables(spark, _fragment(0, [["a", "b"]] * 2, (0, 842)), _fragment(1, [["a", "b"]] * 2, (0, 842)))) == 2


def test_spans_over_the_break(spark):
    first = [["Cat", "Item"], ["Fin", "a"], ["Fin", "b"]]
    second = [["Cat", "Item"], ["", "c"], ["", "d"], ["New", "e"]]
    got = _tables(spark, _fragment(0, first, (100, 800), merges=[(1, 0, 2, 1)]), _fragment(1, second, (72, 300), merges=[(1, 0, 2, 1)]))[0]
    assert [r[0] for r in got.cells] == ["Cat", "Fin", "Fin", "Fin", "Fin", "New"]
    assert [tuple(m) for m in got.merges] == [(1, 0, 2, 1), (3, 0, 2, 1)]


def test_grid():
    assert TB.merged_grid([["A", "A", "B"], ["A", "A", "C"]], [(0, 0, 2, 2)]).splitlines() == ["+-----+-----+-----+", "| A         | B   |", "|           +-----+", "|           | C   |", "+-----+-----+-----+"]


def test_plain_grid_is_a_grid_without_merges(spark):
    cells = [["a", "long head", ""], ["1"], ["x|y", "z", "four"]]
    got = spark.createDataFrame([(cells, []), ([], []), (cells, [(0, 1, 1, 2)])], f"cells {TB.CELLS}, merges {TB.MERGES}").select(TB.grid_text(F.col("cells"), F.col("merges")).alias("g")).collect()
    assert [r.g for r in got] == [TB.merged_grid(cells, []), "", TB.merged_grid(cells, [(0, 1, 1, 2)])]


def _stitched(fragments, heads):
    """A plain model of stitching: rows one after the other, column by column."""
    rows = [list(r) for r in fragments[0]]
    for f in fragments[1:]:
        more = [list(r) for r in f]
        for h in heads:
            if more and more[0] == h:
                more = more[1:]
        begin = len(rows)
        rows += more
        for c in range(min(map(len, rows)) if more and begin >= 2 else 0):
            i = begin
            while rows[begin - 1][c] and rows[begin - 2][c] == rows[begin - 1][c] and i < len(rows) and rows[i][c] == "":
                rows[i][c] = rows[begin - 1][c]
                i += 1
    return rows


def test_spans_against_a_plain_model(spark):
    random.seed(11)
    docs = {}
    for d in range(40):
        head = [["h", "k", "m"][: random.choice([2, 3])]]
        n = len(head[0])
        line = lambda n=n: [random.choice(["", "", "x", "y"]) for _ in range(random.choice([n, n, n, n - 1]))]
        docs[f"d{d}"] = [head + [line() for _ in range(random.randint(0, 3))]] + [[["", *["k"] * (n - 1)] if random.random() < 0.5 else head[0]] + [line() for _ in range(random.randint(0, 3))] for _ in range(random.randint(1, 5))]
    rows = [_fragment(p, f, (100, 800) if p == 0 else (72, 800), doc=d) for d, fs in docs.items() for p, f in enumerate(fs)]
    got = {r.doc_id: r.cells for r in _tables(spark, *rows)}
    assert got == {d: _stitched(fs, fs[0][:1]) for d, fs in docs.items()}


@pytest.mark.parametrize("cells,start", [([], "fewer"), ([["a"]], "fewer"), ([["a", "b"], ["c"]], "ragged"), ([["", ""], ["a", "b"]], "empty header"), ([["a", ""], ["", ""], ["", ""]], "mostly empty"), ([["a", "b"], ["1", "2"]], None)])
def test_validation(spark, cells, start):
    got = spark.createDataFrame([(cells,)], f"cells {TB.CELLS}").select(TB.validation_reason(F.col("cells")).alias("r")).first().r
    assert got is None if start is None else got.startswith(start)


def test_suspects(spark):
    box = lambda x: (float(x), 100.0, float(x) + 50, 200.0)
    regions = spark.createDataFrame([("d", 0, 0, "table", box(0)), ("d", 0, 1, "table", box(10)), ("d", 0, 2, "table", box(300)), ("d", 0, 3, "figure", box(500)), ("d", 1, 0, "table", box(0))], f"doc_id string, page int, idx int, label string, box_pdf {G.BOX}")
    fragments = spark.createDataFrame([_fragment(0, [["a"]], seq=0)], FRAGMENT).withColumn("bbox", G.box(290, 90, 360, 210))
    pages = spark.createDataFrame([("d", 0)], "doc_id string, page int")
    assert [(r.page, r.seq) for r in TB.suspects(regions, fragments, pages).collect()] == [(0, 0)]
    rows = [_fragment(p, [], (50, 90), source="yolo_only") for p in range(4)] + [_fragment(1, [], (300, 390), seq=1, source="yolo_only")]
    assert [r.seq for r in TB.drop_repeated_suspects(spark.createDataFrame(rows, FRAGMENT)).collect()] == [1]


MD = "# शीर्षक Title\n\n## Part\nsome text\nmore\n\n| a \\| b | c |\n|---|---|\n| 1 | 2 |\nafter"


def test_markdown(spark):
    pages = spark.createDataFrame([("d", 0, 595.0, 842.0, MD), ("d", 1, 595.0, 842.0, "| lone row |\ntext"), ("d", 2, 595.0, 842.0, "")], "doc_id string, page int, width double, height double, markdown string")
    got = [(r.page, r.kind, r.level, r.content) for r in V.markdown_blocks(pages).orderBy("page", "block").collect()]
    assert got == [(0, "title", 1, "शीर्षक Title"), (0, "title", 2, "Part"), (0, "text", None, "some text\nmore"), (0, "table", None, "| a \\| b | c |\n|---|---|\n| 1 | 2 |"), (0, "text", None, "after"), (1, "text", None, "| lone row |\ntext")]
    cells = spark.createDataFrame([(got[3][3],)], ["m"]).select(V.table_cells(F.col("m")).alias("c")).first().c
    assert cells == [["a | b", "c"], ["1", "2"]]
    region = spark.createDataFrame([("d", 0, "table", (1.0, 2.0, 3.0, 4.0))], f"doc_id string, page int, label string, box_pdf {G.BOX}")
    two = region.unionByName(region)
    y = lambda r: V.page_units(pages, r).where("type = 'table'").first().bbox.y0
    assert y(region) == 2.0 and y(two) == 0.0


def test_verification(spark):
    rows = [("d", 0, "the same phrase again. " * 30, None, None), ("d", 1, "tiny", 1000, None), ("d", 2, "tiny", None, 0.05), ("d", 3, "tiny", None, 0.001), ("d", 4, "a healthy page of text", 22, None), ("d", 5, "bad \x01", None, None)]
    pages = spark.createDataFrame(rows, "doc_id string, page int, markdown string, text_layer_chars int, ink_frac double")
    regions = spark.createDataFrame([("d", 4, "table", None)], f"doc_id string, page int, label string, box_pdf {G.BOX}")
    got = {r.page: [x.split(":")[0].split(" ")[0] for x in r.review_reasons] for r in V.verify(pages, regions).collect()}
    assert got == {0: ["repetition"], 1: ["length"], 2: ["inked"], 3: [], 4: ["1"], 5: ["mojibake"]}


def test_transcription_pays_once(spark, tmp_path):
    class Engine:
        """Says the image in capitals; `broken` fails for good, `blank` has no answer, and every call leaves a file."""

        def generate(self, image, prompt):
            import pathlib
            import uuid

            pathlib.Path(at, f"{image.decode()}-{uuid.uuid4().hex}").touch()
            if image == b"broken":
                raise ValueError("no such page")
            return ("" if image == b"blank" else image.decode().upper()), 1, 2

    calls = tmp_path / "calls"
    calls.mkdir()
    at = str(calls)
    pages = spark.createDataFrame([("d", 0, b"one"), ("d", 1, b"one"), ("d", 2, b"two"), ("d", 3, b"broken"), ("d", 4, b"blank"), ("d", 5, None)], "doc_id string, page int, image binary")
    cfg = Paid(retries=0)
    make = Engine
    first = V.transcribe(pages, str(tmp_path / "cache"), make, "p", cfg)
    got = {r.page: r for r in first.collect()}
    assert first.count() == 5 and [got[i].text for i in range(5)] == ["ONE", "ONE", "TWO", "", ""] and not any(r.cached for r in got.values())
    assert "no such page" in got[3].error and got[4].error is None
    seen = lambda: Counter(f.name.split("-")[0] for f in calls.iterdir())
    assert seen() == {"one": 1, "two": 1, "broken": 1, "blank": 1}  # two actions have paid once
    again = {r.page: r.cached for r in V.transcribe(pages, str(tmp_path / "cache"), make, "p", cfg).collect()}
    assert again == {0: True, 1: True, 2: True, 3: False, 4: False} and seen() == {"one": 1, "two": 1, "broken": 2, "blank": 2}


def test_failed_page_is_one_flagged_unit(spark):
    schema = "doc_id string, page int, width double, height double, markdown string, text_layer_chars int, ink_frac double, error string"
    pages = spark.createDataFrame([("d", 0, 595.0, 842.0, "", None, None, "gone"), ("d", 1, 595.0, 842.0, "a page of text", 14, None, None)], schema)
    regions = spark.createDataFrame([], f"doc_id string, page int, idx int, label string, box_pdf {G.BOX}")
    checked = V.verify(pages, regions)
    assert {r.page: r.review_reasons for r in checked.collect()} == {0: ["the engine failed: gone"], 1: []}
    units = V.flagged_units(V.page_units(pages, regions), pages, checked).collect()
    assert {(r.page, r.content, r.needs_review) for r in units} == {(0, "", True), (1, "a page of text", False)}


def test_ink(spark):
    d = spark.createDataFrame([(bytes([0, 255, 100, 200]), 2, 2), (bytes([0, 0, 0, 255, 250, 0, 0, 0]), 2, 1), (None, 2, 2), (b"", 0, 0)], "s binary, w int, h int")
    assert [r.i for r in d.select(V.ink_fraction()("s", "w", "h").alias("i")).collect()] == [0.5, 1.0, None, None]


def test_repetition_against_a_plain_count(spark):
    texts = ["abc" * 40, "short", "x" * 21, "é😀 " * 30, "all of these words differ from one another here", None]
    rows = [("d", i, t) for i, t in enumerate(texts)]
    got = {r.page: r.worst for r in V.repetition(spark.createDataFrame(rows, "doc_id string, page int, markdown string")).collect()}
    plain = lambda t: max(Counter(t[i : i + 20] for i in range(len(t) - 19)).values()) if len(t) > 20 else 0
    assert got == {i: plain(" ".join((t or "").split())) for i, t in enumerate(texts)}


def test_retries():
    calls, waits = [], []

    def flaky(x):
        calls.append(x)
        if len(calls) < 3:
            raise OSError
        return ("ok", 0, 0)

    assert V.with_retries(flaky, 3, 1.0, sleep=waits.append)("x")[0] == "ok" and waits == [1.0, 2.0]
    with pytest.raises(OSError):
        V.with_retries(lambda x: (_ for _ in ()).throw(OSError()), 1, 0.0, sleep=lambda _: None)("x")


def test_gate(spark):
    rows = [_unit("d", 0, 0, 10, 20, "text", "clean"), _unit("d", 0, 1, 10, 20, "text", "bad\x01"), _unit("d", 1, 0, 10, 20, "text", "page", source="gemini"), _unit("d", 2, 0, 10, 20, "text", "clean", source="gemini"), _unit("d", 2, 1, 10, 20, "text", "[ILLEGIBLE] x", source="gemini")]
    pages = spark.createDataFrame([("d", 1, ["reason"]), ("d", 2, [])], "doc_id string, page int, review_reasons array<string>")
    got = R.gate_units(spark.createDataFrame(rows, UNIT), pages).orderBy("page", "seq").collect()
    assert [r.needs_review for r in got] == [False, True, True, False, True]


def _span(text, size=10.0, flags=0):
    return (text, size, flags)


def test_native_units(spark):
    line = lambda y, *s: ((72.0, float(y), 500.0, float(y) + 10), list(s))
    box = (72.0, 10.0, 500.0, 200.0)
    blocks = [
        (0, box, [line(10, _span("Title ", 18.0), _span("x", 9.0)), line(30, _span("body  one")), line(40, _span("body two")), line(50, _span("3.1 Bold head", 10.0, 16)), line(60, _span("tail")), line(70, _span("  "))]),
        (1, (100.0, 100.0, 300.0, 300.0), []), (1, (0.0, 0.0, 5.0, 5.0), []),
    ]
    pages = spark.createDataFrame([("d", 0, 595.0, 842.0, blocks)], f"doc_id string, page int, width double, height double, blocks array<struct<type:int,bbox:{G.BOX},lines:array<struct<bbox:{G.BOX},spans:array<struct<text:string,size:double,flags:int>>>>>>")
    body = X.body_font_size(pages)
    assert body.first().body_size == 10.0
    got = X.native_units(pages, body).orderBy("seq").collect()
    assert [(r.type, r.content) for r in got] == [("title", "Title x"), ("text", "body one body two"), ("title", "3.1 Bold head"), ("text", "tail"), ("figure", "")]
    assert got[1].bbox.y0 == 30 and got[1].bbox.y1 == 50 and got[4].storage_key == "figures/p0000_f00.png" and got[0].font_size == 18.0


def test_ruled_grid(spark):
    rows = [("d", 6, "l", 50.0, 100.0 + 20 * i, 300.0, 100.0 + 20 * i) for i in range(5)] * 2 + [("d", 6, "l", 50.0 + 80 * i, 100.0, 50.0 + 80 * i, 180.0) for i in range(4)] + [("d", 7, "re", 50.0, 50.0, 90.0, 90.0)]
    got = X.ruled_grids(spark.createDataFrame(rows, "doc_id string, page int, kind string, x0 double, y0 double, x1 double, y1 double")).collect()
    assert [(r.page, r.h_segments, r.v_segments, tuple(r.bbox)) for r in got] == [(6, 5, 4, (50, 100, 300, 180))]


def _model(items):
    """A plain walk: chunks in emission order and heading paths."""
    stack, texts, out, paths = [], [], [], []

    def flush():
        if texts and (t := "\n\n".join(texts).strip()):
            out.append(("text", t, tuple(h for _, h in stack)))
        texts.clear()

    for kind, content, level in items:
        if kind == "title":
            flush()
            while stack and stack[-1][0] >= (level or 1):
                stack.pop()
            stack.append((level or 1, content))
        elif kind == "text":
            texts.append(content)
        else:
            out.append(("figure", "", tuple(h for _, h in stack)))
        paths.append(tuple(h for _, h in stack))
    flush()
    return out, paths


def test_chunks_like_a_plain_walk(spark):
    random.seed(5)
    docs = {}
    for d in range(25):
        docs[f"d{d}"] = [(k, f"{k}{i}" if random.random() > 0.1 else "", random.randint(1, 6)) for i, k in enumerate(random.choices(["title", "text", "figure"], [3, 5, 2], k=25))]
    rows = [_unit(d, i // 10, i, 10 * (i % 10), 10, k, c, level if k == "title" else None) for d, items in docs.items() for i, (k, c, level) in enumerate(items)]
    none = spark.createDataFrame([], f"doc_id string, table_id string, pages array<int>, page_spans array<struct<page:int,bbox:{G.BOX}>>, cells {TB.CELLS}, header_rows int, merges {TB.MERGES}, markdown string, grid string, needs_review boolean, review_reason string, crop_key string")
    walked = C.with_headings(C.walk(spark.createDataFrame(rows, UNIT), none))
    got = C.chunks(walked).orderBy("doc_id", "n").collect()
    paths = walked.orderBy("doc_id", "pos").collect()
    for d, items in docs.items():
        want, want_paths = _model(items)
        assert [(r.type, r.content, tuple(r.headings)) for r in got if r.doc_id == d] == want
        assert [tuple(r.headings) for r in paths if r.doc_id == d] == want_paths


def test_pieces(spark):
    d = spark.createDataFrame([("One sentence here. " * 300,), ("   ",), ("x" * 3000 + ". End.",)], ["t"]).select(C.pieces(F.col("t"), 512).alias("p")).collect()
    assert len(d[0].p) >= 2 and all(p.endswith(".") and len(p) // 4 <= 512 for p in d[0].p) and " ".join(d[0].p) == ("One sentence here. " * 300).strip()
    assert d[1].p == [] and len(d[2].p) == 2


def test_split_text_by_a_tokenizer(spark):
    text = "One two three. Four five! Six seven eight nine? Ten."
    words = lambda t: len(t.split())
    assert C.sentence_pieces(text, 5, 0, words) == ["One two three. Four five!", "Six seven eight nine? Ten."]
    assert C.sentence_pieces(text, 5, 2, words) == ["One two three. Four five!", "Six seven eight nine? Ten."]
    assert C.sentence_pieces("A b. C d. E f. G h.", 4, 2, words) == ["A b. C d.", "C d. E f.", "E f. G h."]
    assert C.sentence_pieces("  ", 5, 0, words) == []
    rows = [_unit("d", 0, 0, 10, 20, "text", text), _unit("d", 0, 1, 30, 40, "text", "Last.")]
    none = TB.build_tables(TB.chains(spark.createDataFrame([], FRAGMENT)))
    walked = C.with_headings(C.walk(spark.createDataFrame(rows, UNIT), none))
    got = C.chunks(walked, split=C.splitter(Cutting(tokens=5), words)).orderBy("n").collect()
    assert [(r.content, r.token_count) for r in got] == [("One two three. Four five!", 5), ("Six seven eight nine?", 4), ("Ten.\n\nLast.", 2)]


def test_table_chunks(spark):
    cells = [["h", "i"]] + [[str(k), "x"] for k in range(45)]
    t = TB.build_tables(TB.chains(spark.createDataFrame([_fragment(2, cells)], FRAGMENT)))
    units = spark.createDataFrame([], UNIT)
    ok = C.chunks(C.with_headings(C.walk(units, R.gate_tables(t)))).orderBy("n").collect()
    assert [r.content.count("\n") - 1 for r in ok] == [20, 20, 5] and all(r.content.startswith("| h | i |") and r.pages == [3] for r in ok)
    bad = TB.build_tables(TB.chains(spark.createDataFrame([_fragment(2, [["h", "i"]])], FRAGMENT)))
    held = C.chunks(C.with_headings(C.walk(units, R.gate_tables(bad)))).collect()
    assert len(held) == 1 and held[0].needs_review and held[0].embedding_text == "\n\n[table needing review on page 3]" and held[0].storage_key == "figures/t0002_00_review.png"


def test_chunk_diff(spark):
    schema = "doc_id string, type string, content string, pages array<int>, needs_review boolean"
    a = spark.createDataFrame([("d", "text", "x  y", [1], False), ("d", "text", "x y", [1], False), ("d", "text", "z", [1], False)], schema)
    b = spark.createDataFrame([("d", "text", "x y", [1], False), ("d", "text", "z", [1], False)], schema)
    assert [(r.side, r.content, r.n) for r in C.chunk_diff(a, b).collect()] == [("a", "x y", 1)] and C.chunk_diff(b, b).count() == 0

"""Text and geometry functions on stated values and against plain Python."""

import unicodedata

import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from folioflow.functions import geometry as G
from folioflow.functions import text as T


def _one(spark, build, *values):
    names = "abcdef"[: len(values)]
    return spark.createDataFrame([values], list(names)).select(build(*(F.col(n) for n in names)).alias("x")).first().x


@pytest.mark.parametrize("text,n", [("राशि विभाग निविदा में", 0), (unicodedata.normalize("NFD", "café résumé"), 0), ("िवभाग", 1), ("3ितशत", 1), ("aि", 1), ("", 0)])
def test_orphan_marks(spark, text, n):
    assert _one(spark, T.orphan_marks, text) == n


def test_scores(spark):
    junk = "\x01बड \x01ववरण/Bid Details \x01बड बंद होने क\x10 तार\x13ख"
    assert _one(spark, T.junk_count, junk) == 5
    assert _one(spark, T.interleaved_symbols, "स]म म= चा<हए x=y [a]") == 3
    assert _one(spark, T.interleaved_symbols, "विवरण/Bid निविदा-प्रपत्र 5% (राशि)") == 0
    assert _one(spark, T.mojibake_count, "िवभाग म= ab") == 2 and _one(spark, T.compact_length, "िवभाग म= ab") == 9
    assert _one(spark, T.interleaved_symbols, "été###") == 3


def _plain_marks(text):
    ranges = ((0x300, 0x36F), (0x1AB0, 0x1AFF), (0x1DC0, 0x1DFF), (0x20D0, 0x20FF), (0xFE20, 0xFE2F))
    n, base = 0, None
    for c in text:
        kind = unicodedata.category(c)
        if kind in ("Mn", "Mc"):
            free = any(a <= ord(c) <= b for a, b in ranges)
            n += base is None or not base.isalpha() or (not free and ord(c) // 128 != ord(base) // 128)
        elif kind != "Cf":
            base = c
    return n


def test_orphan_marks_like_plain_python(spark):
    letters = st.text(alphabet="aé1 रिवंा्́‍Z.", max_size=12)
    texts: list[str] = []

    @settings(max_examples=80, database=None)
    @given(letters)
    def gather(t):
        texts.append(t)

    gather()
    rows = spark.createDataFrame([(i, t) for i, t in enumerate(texts)], "i int, t string").select("i", T.orphan_marks(F.col("t")).alias("n")).collect()
    assert {r.i: r.n for r in rows} == {i: _plain_marks(t) for i, t in enumerate(texts)}


def test_forms(spark):
    assert _one(spark, T.furniture_norm, "  Page 12 of  5 ") == "page # of #"
    assert [_one(spark, T.numbering_depth, t) for t in ("7. Terms", "7.3 Damages", "7.3.1 Notices", "Background", "12")] == [1, 2, 3, None, None]
    assert [_one(spark, T.unfence, t) for t in ("```md\na\nb\n```", " a ", "```\n```", "```x")] == ["a\nb", "a", "", "```x"]
    assert _one(spark, T.lines_of, "a\r\nb\n\nc\n") == ["a", "b", "", "c"]
    assert _one(spark, T.token_estimate, "") == 1 and _one(spark, T.token_estimate, "x" * 41) == 10
    assert _one(spark, T.cells_markdown, [["a|b", "c"], ["1", "2"]]) == "| a\\|b | c |\n|---|---|\n| 1 | 2 |"


def _box(*v):
    return G.box(*v)


def test_geometry(spark):
    page, one = _box(0, 0, 500, 1000), spark.range(1)
    pick = lambda c: one.select(c.alias("x")).first().x
    assert tuple(pick(G.to_points(_box(100, 200, 300, 400), F.lit(1000.0), F.lit(2000.0), page))) == (50, 100, 150, 200)
    assert pick(G.to_points(_box(1100, 10, 1200, 20), F.lit(1000.0), F.lit(2000.0), page)) is None
    assert tuple(pick(G.to_points(_box(0, 0, 1654, 2339), F.lit(1654.0), F.lit(2339.0), _box(10, 20, 605, 862)))) == (10, 20, 605, 862)
    assert pick(G.overlap(_box(0, 0, 10, 10), _box(5, 0, 25, 10))) == 0.5 and pick(G.overlap(_box(0, 0, 10, 10), _box(10, 0, 20, 10))) == 0
    assert pick(G.centre_in(_box(0, 0, 10, 10), _box(5, 5, 9, 9))) and not pick(G.centre_in(_box(0, 0, 10, 10), _box(6, 5, 9, 9)))
    assert tuple(pick(G.pad_pixels(_box(5, 5, 95, 95), 10.0, F.lit(100.0), F.lit(100.0)))) == (0, 0, 100, 100)
    assert pick(G.bucket(F.lit(20.0), 8)) == 2 and pick(G.bucket(F.lit(28.0), 8)) == 4

"""Text functions as Column expressions."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

#: White space as Python's str.split sees it; the same class works in Java and RE2.
WS = r"[\s\x{b}\x{1c}-\x{1f}\x{85}\p{Z}]"
#: Characters that a healthy text layer never holds: controls, replacement characters, private use.
JUNK = r"[\x{0}-\x{8}\x{b}\x{c}\x{e}-\x{1f}\x{fffd}\x{e000}-\x{f8ff}]"
#: Symbols that do not stand within words.
SYMBOLS = r"[\\\]\[=<>^_@#|~]"
ILLEGIBLE = "[ILLEGIBLE]"


def strip(t: Column) -> Column:
    return F.regexp_replace(t, rf"^{WS}+|{WS}+\z", "")


def collapse(t: Column) -> Column:
    """Runs of white space become one blank, none at the ends."""
    return F.btrim(F.regexp_replace(t, f"{WS}+", " "))


def compact_length(t: Column) -> Column:
    return F.length(F.regexp_replace(t, f"{WS}+", ""))


def is_blank(t: Column) -> Column:
    return strip(t) == ""


def ratio(n: Column, of: Column) -> Column:
    return F.when(of > 0, n / of).otherwise(F.lit(0.0))


def junk_count(t: Column) -> Column:
    return F.regexp_count(F.regexp_replace(t, f"{WS}+", ""), F.lit(JUNK))


def has_junk(t: Column) -> Column:
    return t.rlike(JUNK)


def orphan_marks(t: Column) -> Column:
    """Combining marks without a letter of their own block before them; format characters are passed over, and marks
    that attach to letters of any script need only some letter."""

    def step(a: Column, ch: Column) -> Column:
        mark = ch.rlike(r"^[\p{Mn}\p{Mc}]$")
        any_script = ch.rlike(r"^[\x{300}-\x{36f}\x{1ab0}-\x{1aff}\x{1dc0}-\x{1dff}\x{20d0}-\x{20ff}\x{fe20}-\x{fe2f}]$")
        block = lambda c: F.floor(F.ascii(c) / 128)
        lost = F.coalesce(~a["base"].rlike(r"^\p{L}$"), F.lit(True)) | (~any_script & (block(ch) != block(a["base"])))
        base = F.when(mark | ch.rlike(r"^\p{Cf}$"), a["base"]).otherwise(ch)
        return F.struct(base.alias("base"), (a["n"] + F.when(mark & lost, 1).otherwise(0)).alias("n"))

    start = F.struct(F.lit(None).cast("string").alias("base"), F.lit(0).alias("n"))
    folded = F.aggregate(F.split(t, ""), start, step)["n"]
    return F.when(t.rlike(r"[\p{Mn}\p{Mc}]"), folded).otherwise(F.lit(0))


def interleaved_symbols(t: Column) -> Column:
    """Symbols within words that hold a letter beyond ASCII."""
    foreign = F.filter(F.split(t, f"{WS}+"), lambda w: w.rlike(r"[\p{L}&&[^\x00-\x7f]]"))
    return F.aggregate(foreign, F.lit(0), lambda n, w: n + F.regexp_count(w, F.lit(SYMBOLS)))


def mojibake_count(t: Column) -> Column:
    return F.when(compact_length(t) > 0, orphan_marks(t) + interleaved_symbols(t)).otherwise(0)


def furniture_norm(t: Column) -> Column:
    """Lower case, blanks collapsed, every digit run one mark: what makes running heads alike."""
    return F.regexp_replace(collapse(F.lower(t)), r"(?U)\d+", "#")


def row_norm(cells: Column) -> Column:
    return collapse(F.lower(F.array_join(cells, " ")))


def is_numbered(t: Column, pattern: str) -> Column:
    return t.rlike("(?U)" + pattern)


def numbering_depth(t: Column) -> Column:
    """2 for `7.3 Title`; null without a leading number."""
    m = F.regexp_extract(t, r"(?U)^(\d+(?:\.\d+)*)\.?\s", 1)
    return F.when(m != "", F.regexp_count(m, F.lit(r"\.")) + 1)


def token_estimate(t: Column) -> Column:
    return F.greatest(F.lit(1), F.floor(F.length(t) / 4).cast("int"))


def lines_of(t: Column) -> Column:
    """Python's splitlines: no empty last line after a final break."""
    parts = F.split(t, r"\r\n|[\n\r\x{b}\x{c}\x{1c}-\x{1e}\x{85}\x{2028}\x{2029}]", -1)
    return F.when((F.size(parts) > 0) & (F.element_at(parts, -1) == ""), F.slice(parts, 1, F.size(parts) - 1)).otherwise(parts)


def unfence(t: Column) -> Column:
    """One fence around the whole text is taken off."""
    bare = strip(t)
    ls = lines_of(bare)
    fenced = (F.size(ls) >= 2) & F.get(ls, F.lit(0)).startswith("```") & (strip(F.get(ls, F.size(ls) - 1)) == "```")
    return F.when(fenced, F.array_join(F.slice(ls, 2, F.greatest(F.size(ls) - 2, F.lit(0))), "\n")).otherwise(bare)


def cache_key(image: Column, model: Column, version: Column) -> Column:
    return F.sha2(F.concat(image, F.encode(model, "UTF-8"), F.encode(version, "UTF-8")), 256)


def excerpt(t: Column) -> Column:
    return F.substring(t, 1, 120)


def escape_cell(t: Column) -> Column:
    return F.replace(t, F.lit("|"), F.lit("\\|"))


def cells_markdown(cells: Column) -> Column:
    """A pipe table; the delimiter row follows the first row. Null where there are no cells."""
    row = lambda r: F.concat(F.lit("| "), F.array_join(F.transform(r, escape_cell), " | "), F.lit(" |"))
    head = F.get(cells, F.lit(0))
    marks = F.concat(F.lit("|"), F.repeat(F.lit("---|"), F.size(head)))
    body = F.transform(F.slice(cells, 2, F.greatest(F.size(cells) - 1, F.lit(0))), row)
    return F.when(F.size(cells) > 0, F.array_join(F.concat(F.array(row(head), marks), body), "\n"))

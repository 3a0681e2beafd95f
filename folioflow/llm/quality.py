"""Quality rules: statistics of single documents, and lines that recur across the documents of a host."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from .common import SPACE, staged, table

MIN_WORDS = 50
MAX_REPEATED = 50  # per cent of the words
#: A line is boilerplate of a host if this many different texts, and this share of the host's texts, hold it.
LINE_TEXTS = 10
LINE_SHARE = 0.01
#: A document is depleted if its other lines hold fewer words than this, or less than this share of its words.
LEFT_WORDS = 20
LEFT_SHARE = 0.3


def words(text: Column) -> Column:
    """The words as an array; empty for null and blank texts."""
    bare = F.btrim(text, F.lit(" \t\n\x0b\x0c\r"))
    return F.when(F.coalesce(bare, F.lit("")) == "", F.array().cast("array<string>")).otherwise(F.split(bare, SPACE + "+"))


def _metrics(docs: DataFrame, extra: list[str]) -> DataFrame:
    """One pass over the texts.

    Windows are sorted by a hash packed with their place, and the words of neighbours with equal hashes are compared. Where
    different windows share a hash, the windows of that text are sorted by their words instead, so the count is exact.
    """
    text, lines = F.coalesce("text", F.lit("")), F.split(F.coalesce("text", F.lit("")), "\n", -1)
    solid = F.filter(lines, lambda x: x.rlike("[^\\x20\\x09-\\x0D]"))
    normal = F.transform(solid, lambda x: F.regexp_replace(F.regexp_replace(F.lower(F.btrim(x, F.lit(" \t\x0b\x0c\r"))), SPACE + "+", " "), "[0-9]+", "0"))
    d = docs.select(*extra, "source", F.xxhash64(text).alias("text_hash"), F.length(text).alias("n_chars_"), words(F.col("text")).alias("w"), solid.alias("solid"), normal.alias("normal"), (F.length(text) - F.length(F.regexp_replace(text, r"[#*$%&|<>]+", ""))).cast("long").alias("n_symbols"))
    n, word_chars = F.size("w"), F.length(F.array_join("w", "")).cast("long")
    three = F.arrays_zip(*(F.slice("w", k, F.greatest(n - 2, F.lit(0))) for k in (1, 2, 3)))
    line = F.transform("normal", lambda x: F.struct(F.xxhash64(x).alias("h"), (F.length(x) - F.length(F.replace(x, F.lit(" "), F.lit(""))) + 1).alias("n")))
    d = d.select(*extra, "source", "text_hash", "n_chars_", "n_symbols", n.cast("long").alias("n_words"), word_chars.alias("word_chars"), (F.size("solid") - F.size(F.array_distinct("solid"))).cast("long").alias("n_dup_lines"), line.alias("lines"), "w", three.alias("three"), F.greatest(F.ceil(F.log2(F.greatest(n, F.lit(2)).cast("double"))), F.lit(1)).cast("int").alias("bits"))
    d = d.withColumn("s", F.sort_array(F.transform("three", lambda x, i: F.call_function("shiftleft", F.xxhash64(x), F.col("bits")).bitwiseOR(i.cast("long"))))).drop("three")
    place = F.call_function("shiftleft", F.lit(1).cast("long"), F.col("bits")) - 1
    d = d.withColumn("place", place).withColumn("m", F.greatest(F.size("s") - 1, F.lit(0)))
    both = F.zip_with(F.slice("s", 1, F.col("m")), F.slice("s", 2, F.col("m")), lambda x, y: F.when(F.call_function("shiftrightunsigned", x.bitwiseXOR(y), F.col("bits")) == 0, F.array(x.bitwiseAND(F.col("place")), y.bitwiseAND(F.col("place")))))
    d = d.withColumn("both", F.filter(both, lambda x: x.isNotNull())).drop("s")
    word = lambda i, k: F.get("w", (i + k).cast("int"))
    equal = lambda x, y: (word(x, 0) == word(y, 0)) & (word(x, 1) == word(y, 1)) & (word(x, 2) == word(y, 2))
    clash = F.exists("both", lambda p: ~equal(p[0], p[1]))
    d = d.withColumn("again", F.sort_array(F.array_distinct(F.when(clash, _repeats_by_words(F.col("w"))).otherwise(F.flatten("both"))))).drop("w", "both")
    covered = F.aggregate("again", F.struct(F.lit(-9).cast("long").alias("last"), F.lit(0).cast("long").alias("sum")), lambda a, x: F.struct(x.alias("last"), (a["sum"] + F.least(F.lit(3).cast("long"), x - a["last"])).alias("sum")))["sum"]
    d = d.withColumn("n_repeat_words", covered)
    failed = (F.col("n_words") < MIN_WORDS) | (100 * F.col("n_repeat_words") > MAX_REPEATED * F.col("n_words"))
    return d.select(*extra, "source", "text_hash", "n_chars_", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", failed.alias("base_failed"), "lines")


def _repeats_by_words(w: Column) -> Column:
    """Places of the three-word windows that occur again, found by sorting the windows themselves."""
    n = F.greatest(F.size(w) - 2, F.lit(0))
    s = F.sort_array(F.transform(F.slice(w, 1, n), lambda x, i: F.struct(F.concat_ws(" ", x, F.get(w, i + 1), F.get(w, i + 2)).alias("g"), i.cast("long").alias("i"))))
    m = F.greatest(F.size(s) - 1, F.lit(0))
    both = F.zip_with(F.slice(s, 1, m), F.slice(s, 2, m), lambda x, y: F.when(x["g"] == y["g"], F.array(x["i"], y["i"])))
    return F.flatten(F.filter(both, lambda x: x.isNotNull()))


def quality(docs: DataFrame, extra: tuple[str, ...] = ("doc_id",)) -> DataFrame:
    """One row per document: `extra`, the statistics, n_removed_words, base_failed, kept.

    Lines are lower-cased, blanks become one, digit runs become 0. A line counts once for each different text of a host:
    documents with equal texts, and rows that repeat, are one document here, since counting copies would make every line of
    a copied text boilerplate and reject all its copies. The host is `source`, and documents without one form a host.
    Boilerplate lines are set aside, and a document whose remaining lines hold too few words is rejected, as is one that
    fails the base rules. Null and empty texts have no words and fail. Repeated rows stay; an empty table gives no rows.
    """
    base = staged(_metrics(docs, list(extra)), "quality")
    key = ["source", "text_hash", "n_chars_"]
    lines = base.select(*key, F.posexplode("lines").alias("at", "line")).select(*key, "at", "line.h", "line.n").distinct()
    hosts = base.groupBy("source").agg(F.count_distinct("text_hash", "n_chars_").alias("texts"))
    seen = lines.select("source", "h", "text_hash", "n_chars_").distinct().groupBy("source", "h").agg(F.count(F.lit(1)).alias("texts_with"))
    hosts = hosts.select(F.col("source").alias("host"), "texts")
    common = seen.where(F.col("texts_with") >= LINE_TEXTS).join(hosts, F.col("source").eqNullSafe(F.col("host")))
    common = common.where(F.col("texts_with") >= LINE_SHARE * F.col("texts")).select(F.col("host"), F.col("h").alias("line"))
    gone = lines.join(common, (F.col("h") == F.col("line")) & F.col("source").eqNullSafe(F.col("host")))
    gone = gone.groupBy(*key).agg(F.sum("n").cast("long").alias("n_removed_words"))
    gone = gone.select(*(F.col(c).alias(f"{c}_g") for c in key), "n_removed_words")
    same = F.col("source").eqNullSafe(F.col("source_g")) & (F.col("text_hash") == F.col("text_hash_g")) & (F.col("n_chars_") == F.col("n_chars__g"))
    d = base.drop("lines").join(gone, same, "left").withColumn("n_removed_words", F.coalesce("n_removed_words", F.lit(0)))
    left = F.col("n_words") - F.col("n_removed_words")
    depleted = (F.col("n_removed_words") > 0) & ((left < LEFT_WORDS) | (left < LEFT_SHARE * F.col("n_words")))
    return d.select(*extra, "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "n_removed_words", "base_failed", (~F.col("base_failed") & ~depleted).alias("kept"))


def op2_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality(table(spark, sf_dir, "documents"))


def oracle(documents: str = "documents") -> str:
    """DuckDB SQL for the rows of op2_quality over a table or subquery."""
    s = r"[\x20\x09-\x0D]"
    return rf"""
with d as (select row_number() over () as r, doc_id, source, coalesce(text, '') as t from {documents}),
w as (select r, list_filter(regexp_split_to_array(t, '{s}+'), lambda x: x <> '') as w from d),
three as (
  select r, i, w[i] || ' ' || w[i + 1] || ' ' || w[i + 2] as g
  from (select r, w, unnest(range(1, len(w) - 1)) as i from w)),
again as (select r, i from (select r, i, count(*) over (partition by r, g) as c from three) where c > 1),
covered as (select r, count(distinct p) as n from (select r, unnest([i, i + 1, i + 2]) as p from again) group by r),
lines as (select r, unnest(list_filter(string_split(t, chr(10)), lambda x: regexp_matches(x, '[^\x20\x09-\x0D]'))) as line from d),
dup as (select r, count(*) - count(distinct line) as n from lines group by r),
normal as (
  select r, regexp_replace(regexp_replace(trim(lower(line), ' ' || chr(9) || chr(11) || chr(12) || chr(13)), '{s}+', ' ', 'g'), '[0-9]+', '0', 'g') as line
  from lines),
seen as (select d.source, n.line, count(distinct d.t) as c from normal n join d using (r) group by all),
hosts as (select source, count(distinct t) as c from d group by all),
common as (
  select s.source, s.line from seen s join hosts h on s.source is not distinct from h.source
  where s.c >= {LINE_TEXTS} and s.c >= {LINE_SHARE} * h.c),
gone as (
  select n.r, sum(len(string_split(n.line, ' ')))::bigint as n
  from normal n join d using (r) join common c on c.line = n.line and c.source is not distinct from d.source group by n.r),
m as (
  select doc_id, len(w.w)::bigint as n_words, length(list_aggregate(w.w, 'string_agg', ''))::bigint as wc,
    length(regexp_replace(t, '[^#*$%&|<>]', '', 'g'))::bigint as n_symbols, coalesce(dup.n, 0)::bigint as n_dup_lines,
    coalesce(covered.n, 0)::bigint as n_repeat_words, coalesce(gone.n, 0)::bigint as n_removed_words
  from d join w using (r) left join dup using (r) left join covered using (r) left join gone using (r)),
f as (select *, n_words < {MIN_WORDS} or 100 * n_repeat_words > {MAX_REPEATED} * n_words as base_failed from m)
select doc_id, n_words, coalesce(wc, 0)::bigint as word_chars, n_symbols, n_dup_lines, n_repeat_words, n_removed_words, base_failed,
  not base_failed and not (n_removed_words > 0 and (n_words - n_removed_words < {LEFT_WORDS} or n_words - n_removed_words < {LEFT_SHARE} * n_words)) as kept
from f"""

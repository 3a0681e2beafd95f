"""License scans by diagonal voting of word k-grams against the texts of well-known licenses and notices."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from .common import staged, table

K = 4
#: Diagonals at most so far apart belong to one span: a few words inserted or left out.
DRIFT = 3
#: A span counts if it covers this share of its template, or so many words of it, and so dense a share of its own words.
COVER = 0.6
LONG_COVER = 40
DENSITY = 0.5
SEPARATOR = r"[\x00-\x2F\x3A-\x60\x7B-\x7F]+"
PHRASES = (("mit license", "mit"), ("apache license", "apache"), ("general public license", "gpl"))

# Public texts of licenses and the notices that refer to them.
TEMPLATES = (
    ("mit", "Released under the MIT License."),
    ("mit", "Licensed under the MIT License."),
    ("mit", "This project is licensed under the terms of the MIT license."),
    (
        "mit",
        "Permission is hereby granted, free of charge, to any person obtaining a copy of this software and associated documentation files (the Software), to deal in the Software without restriction, including without limitation the rights to use, copy, modify, merge, publish, distribute, sublicense, and/or sell copies of the Software, and to permit persons to whom the Software is furnished to do so, subject to the following conditions: The above copyright notice and this permission notice shall be included in all copies or substantial portions of the Software. THE SOFTWARE IS PROVIDED AS IS, WITHOUT WARRANTY OF ANY KIND, EXPRESS OR IMPLIED, INCLUDING BUT NOT LIMITED TO THE WARRANTIES OF MERCHANTABILITY, FITNESS FOR A PARTICULAR PURPOSE AND NONINFRINGEMENT. IN NO EVENT SHALL THE AUTHORS OR COPYRIGHT HOLDERS BE LIABLE FOR ANY CLAIM, DAMAGES OR OTHER LIABILITY, WHETHER IN AN ACTION OF CONTRACT, TORT OR OTHERWISE, ARISING FROM, OUT OF OR IN CONNECTION WITH THE SOFTWARE OR THE USE OR OTHER DEALINGS IN THE SOFTWARE.",
    ),
    ("apache", "Licensed under the Apache License, Version 2.0."),
    (
        "apache",
        "Licensed under the Apache License, Version 2.0 (the License); you may not use this file except in compliance with the License. You may obtain a copy of the License at http://www.apache.org/licenses/LICENSE-2.0 Unless required by applicable law or agreed to in writing, software distributed under the License is distributed on an AS IS BASIS, WITHOUT WARRANTIES OR CONDITIONS OF ANY KIND, either express or implied. See the License for the specific language governing permissions and limitations under the License.",
    ),
    ("gpl", "This work is licensed under the GNU General Public License, version 3."),
    ("gpl", "Licensed under the GNU General Public License."),
    (
        "gpl",
        "This program is free software: you can redistribute it and/or modify it under the terms of the GNU General Public License as published by the Free Software Foundation, either version 3 of the License, or (at your option) any later version. This program is distributed in the hope that it will be useful, but WITHOUT ANY WARRANTY; without even the implied warranty of MERCHANTABILITY or FITNESS FOR A PARTICULAR PURPOSE. See the GNU General Public License for more details. You should have received a copy of the GNU General Public License along with this program. If not, see https://www.gnu.org/licenses/.",
    ),
    (
        "bsd",
        "Redistribution and use in source and binary forms, with or without modification, are permitted provided that the following conditions are met: Redistributions of source code must retain the above copyright notice, this list of conditions and the following disclaimer. Redistributions in binary form must reproduce the above copyright notice, this list of conditions and the following disclaimer in the documentation and/or other materials provided with the distribution. Neither the name of the copyright holder nor the names of its contributors may be used to endorse or promote products derived from this software without specific prior written permission.",
    ),
    (
        "isc",
        "Permission to use, copy, modify, and/or distribute this software for any purpose with or without fee is hereby granted, provided that the above copyright notice and this permission notice appear in all copies.",
    ),
    (
        "mpl",
        "This Source Code Form is subject to the terms of the Mozilla Public License, v. 2.0. If a copy of the MPL was not distributed with this file, You can obtain one at https://mozilla.org/MPL/2.0/.",
    ),
    ("cc-by", "This work is licensed under a Creative Commons Attribution 4.0 International License."),
    ("cc-by-sa", "This work is licensed under a Creative Commons Attribution-ShareAlike 4.0 International License."),
    ("cc-by", "Licensed under CC BY 4.0."),
    ("cc-by-sa", "Licensed under CC BY-SA 4.0."),
    ("cc-by-nc", "Licensed under CC BY-NC 4.0."),
    ("unlicense", "This is free and unencumbered software released into the public domain."),
)


def lowered(text: Column) -> Column:
    """The text with A-Z in lower case.

    F.lower is the faster way, and what it does to letters beyond ASCII joins, splits or renames no ASCII word; but for the
    two letters that it turns into ASCII ones, whose texts are translated letter by letter.
    """
    folds = F.contains(text, F.lit("\u0130")) | F.contains(text, F.lit("\u212a"))
    return F.when(folds, F.translate(text, "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")).otherwise(F.lower(text))


def word_string(text: Column) -> Column:
    """The words, each between single blanks: ` a b c `, or one blank if there is none."""
    return F.regexp_replace(F.concat(F.lit(" "), lowered(F.coalesce(text, F.lit(""))), F.lit(" ")), SEPARATOR, " ")


def _blanks(x: Column) -> Column:
    return F.length(x) - F.length(F.replace(x, F.lit(" "), F.lit("")))


def template_grams(spark: SparkSession, templates=TEMPLATES) -> DataFrame:
    """(template, label, n_grams, at, hash, template_gram): one row per place of each template; a few hundred rows, fixed in the code."""
    t = spark.createDataFrame([(i, label, text) for i, (label, text) in enumerate(templates)], "template int, label string, text string")
    t = t.withColumn("w", F.split(F.btrim(word_string(F.col("text"))), " "))
    t = t.select("template", "label", (F.size("w") - (K - 1)).alias("n_grams"), "w", F.posexplode(_hashes("w")).alias("at", "hash"))
    return t.select("template", "label", "n_grams", "at", "hash", F.slice("w", F.col("at") + 1, K).alias("template_gram"))


def _hashes(w: str) -> Column:
    """A hash of the K words from every place on; w is a column of words."""
    n = F.greatest(F.size(w) - (K - 1), F.lit(0))
    return F.transform(F.slice(w, 1, n), lambda x, i: F.xxhash64(x, *(F.get(w, i + j) for j in range(1, K))))


def hits(hashes: str, w: str, known: list[int]) -> Column:
    """(pos, hash, gram) of the places whose hash is one of the templates'; rolled over the words within the row."""
    found = F.transform(hashes, lambda x, i: F.when(x.isin(known), F.struct(i.alias("pos"), x.alias("hash"), F.slice(w, i + 1, K).alias("gram"))))
    return F.filter(found, lambda x: x.isNotNull())


def spans(docs: DataFrame, key: list[str], grams: DataFrame) -> DataFrame:
    """(key, label, first, last, covered, cover): verified spans of license text; words first..last, counted from 0.

    docs has the key and `hits`. Every hit is joined to the template places with the same hash and the same words. The
    votes of a text and template are added up by diagonal (text place less template place); neighbouring diagonals form a span.
    """
    found = docs.select(*key, F.explode("hits").alias("x")).select(*key, "x.*")
    # the templates are fixed in the code, so the broadcast cannot grow with the data
    votes = found.join(F.broadcast(grams), "hash").where(F.col("gram") == F.col("template_gram"))
    votes = votes.select(*key, "template", "label", "n_grams", "pos", "at", (F.col("pos") - F.col("at")).alias("diagonal"))
    d = votes.groupBy(*key, "template", "label", "n_grams", "diagonal").agg(F.min("pos").alias("first"), F.max("pos").alias("last"), F.collect_set("at").alias("at"))
    order = Window.partitionBy(*key, "template").orderBy("diagonal")
    apart = (F.col("diagonal") - F.lag("diagonal").over(order) > DRIFT) | (F.col("first") - F.max("last").over(order.rowsBetween(Window.unboundedPreceding, -1)) > 50)
    d = d.withColumn("new", F.when(F.coalesce(apart, F.lit(True)), 1).otherwise(0)).withColumn("band", F.sum("new").over(order))
    s = d.groupBy(*key, "template", "label", "n_grams", "band").agg(F.min("first").alias("first"), (F.max("last") + K - 1).alias("last"), F.size(F.array_distinct(F.flatten(F.collect_list("at")))).alias("hit"))
    cover = F.col("hit") / F.col("n_grams")
    dense = F.col("hit") >= DENSITY * (F.col("last") - F.col("first") - (K - 2))
    s = s.withColumn("cover", cover).where(dense & ((cover >= COVER) | (F.col("hit") >= LONG_COVER)))
    return s.select(*key, "label", "first", "last", F.col("hit").alias("covered"), "cover")


def scan(docs: DataFrame, extra: tuple[str, ...] = ("doc_id",)) -> DataFrame:
    """One row per document: `extra`, n_words, n_base, first_word, last_word, base_labels, labels, score.

    score is the largest share of a template that a span covers, or 0.5 where only a phrase was found, else 0. Null and
    empty texts have no words and no labels. Votes are grouped by text, so those of copies and repeated rows fall together
    (texts are told apart by length and a 64-bit hash). An empty table gives no rows; other columns are not read.
    """
    grams = template_grams(docs.sparkSession)
    known = sorted({r.hash for r in grams.select("hash").collect()})
    text = F.coalesce("text", F.lit(""))
    d = docs.select(*extra, F.xxhash64(text).alias("th"), F.length(text).alias("tl"), word_string(F.col("text")).alias("words"))
    d = d.withColumn("w", F.when(F.col("words") == " ", F.array().cast("array<string>")).otherwise(F.split(F.btrim("words"), " ")))
    n_words = F.size("w").cast("long")
    counts, firsts, lasts, names = [], [], [], []
    for phrase, label in PHRASES:
        some = F.contains("words", F.lit(f" {phrase} "))
        counts.append(F.when(some, F.regexp_count("words", F.lit(f" {phrase}(?= )"))).otherwise(0))
        firsts.append(F.when(some, _blanks(F.substring_index("words", f" {phrase} ", 1))))
        lasts.append(F.when(some, n_words - _blanks(F.substring_index("words", f" {phrase} ", -1)) - len(phrase.split())))
        names.append(F.when(some, F.lit(label)))
    d = d.withColumn("hashes", _hashes("w"))
    d = d.select(
        *extra, "th", "tl", n_words.alias("n_words"), sum(counts).cast("long").alias("n_base"), F.array_min(F.array(*firsts)).cast("long").alias("first_word"), F.array_max(F.array(*lasts)).cast("long").alias("last_word"),
        F.sort_array(F.array_compact(F.array(*names))).alias("base"), hits("hashes", "w", known).alias("hits"),
    )
    base = staged(d, "licenses")
    found = spans(base.where(F.size("hits") > 0), ["th", "tl"], grams)
    found = found.groupBy("th", "tl").agg(F.collect_set("label").alias("more"), F.max("cover").alias("cover"))
    d = base.join(found, ["th", "tl"], "left")
    labels = F.sort_array(F.array_distinct(F.concat("base", F.coalesce("more", F.array().cast("array<string>")))))
    score = F.coalesce("cover", F.when(F.col("n_base") > 0, 0.5).otherwise(0.0)).cast("double")
    return d.select(*extra, "n_words", "n_base", "first_word", "last_word", F.array_join("base", ",").alias("base_labels"), F.array_join(labels, ",").alias("labels"), score.alias("score"))


def op6_licenses(spark: SparkSession, sf_dir: str) -> DataFrame:
    return scan(table(spark, sf_dir, "documents"))


def oracle(documents: str = "documents") -> str:
    """DuckDB SQL for the rows of op6_licenses."""
    listed = ", ".join(f"({i}, '{label}', '{text}')" for i, (label, text) in enumerate(TEMPLATES))
    lower = "translate({}, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz')"
    words = r"list_filter(regexp_split_to_array({}, '[\x00-\x2F\x3A-\x60\x7B-\x7F]+'), lambda x: x <> '')"
    gram = " || ' ' || ".join(f"w[i + {j}]" for j in range(K))
    phrase = "\n  union all ".join(f"select r, i, '{label}' as label from p where " + " and ".join(f"w[i + {j}] = '{x}'" for j, x in enumerate(phrase.split())) for phrase, label in PHRASES)
    return f"""
with d as (select row_number() over () as r, doc_id, {words.format(lower.format("coalesce(text, '')"))} as w from {documents}),
p as (select r, w, unnest(range(1, len(w) + 1)) as i from d),
base as ({phrase}),
b as (select r, count(*) as n, min(i) - 1 as f, max(i) - 1 as l, list(distinct label) as labels from base group by r),
t as (select t, label, {words.format(lower.format("text"))} as w from (values {listed}) v(t, label, text)),
tg as (select t, label, len(w) - {K - 1} as n, i - 1 as tp, {gram} as g from (select t, label, w, unnest(range(1, len(w) - {K - 2})) as i from t)),
g as (select r, i - 1 as pos, {gram} as g from p where i + {K - 1} <= len(w)),
v as (select r, t, label, n, pos, tp, pos - tp as diagonal from g join tg using (g)),
dg as (select r, t, label, n, diagonal, min(pos) as f, max(pos) as l, list(distinct tp) as tp from v group by all),
lagged as (
  select *, lag(diagonal) over o as d0, max(l) over (partition by r, t order by diagonal rows between unbounded preceding and 1 preceding) as l0
  from dg window o as (partition by r, t order by diagonal)),
bands as (
  select *, sum(case when d0 is null or diagonal - d0 > {DRIFT} or f - l0 > 50 then 1 else 0 end)
    over (partition by r, t order by diagonal rows unbounded preceding) as band from lagged),
s as (select r, t, label, n, band, min(f) as f, max(l) + {K - 1} as l, len(list_distinct(flatten(list(tp)))) as hit from bands group by r, t, label, n, band),
m as (
  select r, list(distinct label) as labels, max(hit / n) as cover from s
  where hit >= {DENSITY} * (l - f - {K - 2}) and (hit / n >= {COVER} or hit >= {LONG_COVER}) group by r)
select doc_id, len(w)::bigint as n_words, coalesce(b.n, 0)::bigint as n_base, b.f::bigint as first_word, b.l::bigint as last_word,
  coalesce(array_to_string(list_sort(b.labels), ','), '') as base_labels,
  coalesce(array_to_string(list_sort(list_distinct(list_concat(coalesce(b.labels, []), coalesce(m.labels, [])))), ','), '') as labels,
  coalesce(m.cover, case when b.n > 0 then 0.5 else 0.0 end)::double as score
from d left join b using (r) left join m using (r)"""

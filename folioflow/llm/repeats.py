"""Removal of long repeated passages by suffix sorting.

Which strings of 200 bytes occur twice is decided by an external induced suffix sort (suffix.py). So that texts need not
all meet in one sort, every string is put into the sort of its anchor: the place in it where a rolling hash of 64 bytes
is least (the first, if several). Equal strings have equal anchors at equal distance, so no repeat falls between two
sorts, and strings whose anchor is nowhere else cannot repeat. Neighbouring strings with one anchor are one context, a
piece of at most 336 bytes. Contexts that occur twice as a whole need no sort; where an anchor has several different
contexts, one copy of each goes into the sort of its partition, which may be far larger than memory.

A context that a text holds several times is settled within the text, and sends one row. Anchors of passages that many
documents share are known from a sample of documents; only where their rows are counted depends on it, not the result.
"""

from __future__ import annotations

import hashlib
import os
import tempfile
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from . import suffix
from .common import discard, staged, table, text_slices

LENGTH = 200
ANCHOR = 64
#: About so many bytes of contexts go into one sort; queues beyond so many tuples go to disk.
SORT_BYTES = 6 << 20
QUEUE_TUPLES = 1 << 20
#: Anchors that so many of the sampled documents share are hot: their rows are dealt out by text, too, and joined to aggregates.
HOT_SAMPLE = 4000
HOT_DOCS = 20
SALTS = 64
_TABLE = np.arange(1, 257, dtype=np.uint64) * np.uint64(0x9E3779B97F4A7C15)
_TABLE = (_TABLE ^ (_TABLE >> np.uint64(29))) * np.uint64(0xBF58476D1CE4E5B9)
_TABLE ^= _TABLE >> np.uint64(32)


def _rolling(buf: np.ndarray) -> np.ndarray:
    """A hash of the ANCHOR bytes from every place on, by doubling the length."""
    h, n, m = _TABLE[buf], 1, np.uint64(0x9E3779B97F4A7C15)
    with np.errstate(over="ignore"):
        while n < ANCHOR:
            h = h[:-n] * m + h[n:]
            m, n = m * m, 2 * n
        h = (h ^ (h >> np.uint64(31))) * np.uint64(0xD6E8FEB86659FD93)
        return h ^ (h >> np.uint64(29))


def anchors(buf: np.ndarray, off: np.ndarray, length: int = LENGTH) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """Contexts of the texts in a buffer: (text, first start in the buffer, number of starts, anchor hash).

    The least hash of each window is found from running minima of blocks; the low byte of a hash is replaced by the place
    in its block, so that the first of equals wins.
    """
    span = length - ANCHOR + 1
    starts = np.maximum(np.diff(off) - length + 1, 0)
    if len(buf) < length or not starts.any():
        z = np.zeros(0, np.int64)
        return z, z, z, z
    h = _rolling(buf)
    blocks = -(-len(h) // span)
    low = np.full(blocks * span, np.uint64(2**64 - 1))
    low[: len(h)] = h & ~np.uint64(255)
    low = low.reshape(blocks, span) | np.arange(span, dtype=np.uint64)
    ahead = np.minimum.accumulate(low, 1).ravel()
    behind = np.minimum.accumulate(low[:, ::-1], 1)[:, ::-1].ravel()
    n = len(h) - span + 1
    s = np.arange(n)
    a, b = behind[:n], ahead[span - 1 : span - 1 + n]
    left = (a >> np.uint64(8)) <= (b >> np.uint64(8))
    best = np.where(left, a, b)
    place = np.where(left, s // span, (s + span - 1) // span) * span + (best & np.uint64(255)).astype(np.int64)
    text = np.repeat(np.arange(len(starts)), starts)
    at = off[:-1][text] + np.arange(len(text)) - np.repeat(np.cumsum(starts) - starts, starts)
    where = place[at]
    new = np.append(True, (where[1:] != where[:-1]) | (text[1:] != text[:-1]))
    first = np.flatnonzero(new)
    count = np.diff(np.append(first, len(at)))
    return text[first], at[first], count, (best[at[first]] >> np.uint64(8)).astype(np.int64)


def _contexts(docs: DataFrame, length: int) -> DataFrame:
    """(anchor, context, th, s, n, many) for docs (th, text): starts s..s+n-1 of a text share an anchor; a context that the text
    holds several times is there once, marked. Rows without an anchor are those starts: they repeat for certain."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        done: set[int] = set()
        for batch in batches:
            for lo, hi, buf, off in text_slices(batch, "text"):
                th = batch.column("th").slice(lo, hi - lo).to_numpy()
                text, at, count, anchor = anchors(buf, off, length)
                data, digest = buf.tobytes(), xxhash.xxh3_64_intdigest
                fresh = np.zeros(hi - lo, bool)
                for i, t in enumerate(th.tolist()):  # copies within a task are read once
                    if t not in done:
                        fresh[i] = True
                        if len(done) < 200_000:
                            done.add(t)
                keep = fresh[text]
                text, at, count, anchor = text[keep], at[keep], count[keep], anchor[keep]
                if not len(text):
                    continue
                ctx = np.fromiter((digest(data[a : a + n]) for a, n in zip(at.tolist(), (count + length - 1).tolist(), strict=True)), np.uint64, len(at)).view(np.int64)
                order = np.lexsort((at, ctx, anchor, text))
                same = np.append(False, (text[order][1:] == text[order][:-1]) & (anchor[order][1:] == anchor[order][:-1]) & (ctx[order][1:] == ctx[order][:-1]))
                head = np.flatnonzero(~same)
                size = np.diff(np.append(head, len(order)))
                one, many = order[head], size > 1
                again = np.sort(order[np.repeat(many, size)])
                # neighbouring starts become one row; contexts are in the order of the buffer
                first = np.flatnonzero(np.append(True, at[again][1:] != (at + count)[again][:-1]) | np.append(True, text[again][1:] != text[again][:-1])) if len(again) else again
                runs = np.add.reduceat(count[again], first) if len(again) else again
                rows = np.concatenate([one, again[first]])
                known = np.arange(len(rows)) < len(one)
                arrays = [pa.array(anchor[rows], mask=~known), pa.array(ctx[rows], mask=~known), pa.array(th[text[rows]]), pa.array((at - off[text])[rows]), pa.array(np.concatenate([count[one], runs])), pa.array(np.append(many, np.zeros(len(first), bool)))]
                yield pa.RecordBatch.from_arrays(arrays, ["anchor", "context", "th", "s", "n", "many"])

    return docs.select("th", "text").mapInArrow(run, "anchor long, context long, th long, s long, n long, many boolean")


def _hot(docs: DataFrame, total: int, length: int) -> DataFrame:
    """The anchors that many of a sample of documents hold; at most those of HOT_SAMPLE documents over HOT_DOCS."""
    some = docs.where(F.pmod(F.xxhash64("th", F.lit(8)), F.lit(1 << 30)) < int((1 << 30) * min(1.0, HOT_SAMPLE / max(1, total))))
    return staged(_contexts(some, length).where("anchor is not null").groupBy("anchor").agg(F.count_distinct("th").alias("texts")).where(F.col("texts") >= HOT_DOCS).select(F.col("anchor").alias("hot")), "hot")


def _pieces(wanted: DataFrame, length: int) -> DataFrame:
    """(anchor, context, n, bytes): the bytes of wanted contexts, from rows of text with their list of contexts."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for lo, hi, buf, off in text_slices(batch, "text"):
                data, rows = buf.tobytes(), []
                for d, asked in enumerate(batch.column("asked").slice(lo, hi - lo).to_pylist()):
                    o = int(off[d])
                    rows += [(x["anchor"], x["context"], x["n"], data[o + x["s"] : o + x["s"] + x["n"] + length - 1]) for x in asked]
                cols = list(zip(*rows, strict=True)) or [[], [], [], []]
                kinds = [pa.int64(), pa.int64(), pa.int64(), pa.binary()]
                yield pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(cols, kinds, strict=True)], ["anchor", "context", "n", "bytes"])

    return wanted.mapInArrow(run, "anchor long, context long, n long, bytes binary")


def _sorted_repeats(pieces: DataFrame, length: int) -> DataFrame:
    """(anchor, context, ranges): starts of each context that occur elsewhere in its partition, as pairs of ends.

    A partition's pieces, which come sorted by context, are written to a file and sorted there; nothing is kept when it is
    done, and nothing is in memory as a whole: pieces, their places and what is found are files.
    """
    entry = np.dtype([("anchor", "<i8"), ("context", "<i8"), ("at", "<i8"), ("n", "<i8")])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        with tempfile.TemporaryDirectory(prefix="repeats-") as folder:
            w, last = suffix.Writer(path := os.path.join(folder, "text"), length), None
            with open(index := os.path.join(folder, "index"), "wb") as f:
                for batch in batches:
                    rows = []
                    for a, c, n, b in zip(*(batch.column(k).to_pylist() for k in ("anchor", "context", "n", "bytes")), strict=True):
                        if (a, c) != last:
                            rows.append((a, c, w.add(b), n))
                            last = a, c
                    np.array(rows, entry).tofile(f)
            w.close()
            if last is None:
                return
            found = suffix.repeated_starts(path, length, QUEUE_TUPLES, folder)
            for lo in range(0, os.path.getsize(index), 4096 * entry.itemsize):
                rows = []
                for a, c, at, n in np.fromfile(index, entry, 4096, offset=lo).tolist():
                    part = found[at : at + n]
                    if part.any():
                        rows.append((a, c, np.flatnonzero(np.diff(np.concatenate([[0], part.view(np.int8), [0]]))).tolist()))
                cols = list(zip(*rows, strict=True)) or [[], [], []]
                yield pa.RecordBatch.from_arrays([pa.array(cols[0], pa.int64()), pa.array(cols[1], pa.int64()), pa.array(cols[2], pa.list_(pa.int64()))], ["anchor", "context", "ranges"])

    return pieces.mapInArrow(run, "anchor long, context long, ranges array<long>")


def removed_ranges(docs: DataFrame, total: int, length: int = LENGTH) -> DataFrame:
    """(th, spans): for `total` texts (th, doc_id, text) the byte ranges to remove, as an array of (a, b), not merged.

    Strings that stand only in copies of one text are not in the result; the caller knows copies by their th.
    """
    place, key = F.struct("th", "s"), ["anchor", "context"]
    hot = F.broadcast(_hot(docs, total, length))
    r = _contexts(docs, length).join(hot, F.col("anchor") == F.col("hot"), "left").withColumn("hot", F.col("hot").isNotNull())
    # every row of an anchor that is not hot comes to one partition; all windows use that and sort once
    r = r.withColumn("salt", F.when(F.col("hot"), F.pmod("th", F.lit(SALTS))).when(F.col("anchor").isNull(), F.pmod("th", F.lit(1 << 20))).otherwise(0)).repartition("anchor", "salt")
    both, one = Window.partitionBy("anchor", "salt", "context"), Window.partitionBy("anchor", "salt")
    sure = lambda w: (F.min(place).over(w) != F.max(place).over(w)) | F.max("many").over(w)
    r = r.withColumn("twice", sure(both)).withColumn("again", sure(one)).withColumn("several", F.min("context").over(one) != F.max("context").over(one))
    all_rows = staged(r.where("again or hot or anchor is null").drop("again", "salt"), "contexts")
    local = all_rows.where("anchor is null").select("th", F.col("s").alias("a"), (F.col("s") + F.col("n") + (length - 1)).alias("b"))
    r, shared = all_rows.where("anchor is not null and not hot"), all_rows.where("hot").drop("twice", "several")
    flags = shared.groupBy(*key).agg((F.min(place) != F.max(place)).alias("apart"), F.bool_or("many").alias("many_")).select(*key, (F.col("apart") | F.col("many_")).alias("twice"))
    flags = staged(flags, "flags")
    # one row for each hot anchor, of which there are at most those of the sample
    anchors_ = flags.groupBy("anchor").agg((F.count(F.lit(1)) > 1).alias("several"))
    r = r.unionByName(shared.join(flags.join(F.broadcast(anchors_), "anchor"), key)).where("twice or several")
    asked = r.where("several").groupBy("anchor", "context").agg(F.min(F.struct("th", "s", "n")).alias("x"))
    asked = staged(asked.select("anchor", "context", "x.*"), "asked")
    size = asked.agg(F.coalesce(F.sum(F.col("n") + length), F.lit(0))).first()[0]
    shards = max(1, -(-size // SORT_BYTES), min(size >> 20, int(docs.sparkSession.conf.get("spark.sql.shuffle.partitions"))))
    by_text = asked.groupBy("th").agg(F.collect_list(F.struct("anchor", "context", "s", "n")).alias("asked"))
    least = docs.groupBy("th").agg(F.min("doc_id").alias("id_")).withColumnRenamed("th", "th_")
    by_text = by_text.join(least, F.col("th") == F.col("th_")).select(F.col("th").alias("th_"), "id_", "asked")
    wanted = docs.join(by_text, (F.col("th") == F.col("th_")) & F.col("doc_id").eqNullSafe(F.col("id_"))).select("text", "asked")
    found = _sorted_repeats(_pieces(wanted, length).repartition(shards, "anchor").sortWithinPartitions("anchor", "context"), length)
    found = staged(found, "found")
    whole = r.where("twice").select("th", F.col("s").alias("a"), (F.col("s") + F.col("n") + (length - 1)).alias("b"))
    pairs = F.transform(F.sequence(F.lit(0), F.size("ranges") - 2, F.lit(2)), lambda i: F.struct(F.get("ranges", i).alias("a"), F.get("ranges", i + 1).alias("b")))
    part = r.where("not twice").join(found, ["anchor", "context"]).select("th", "s", F.explode(pairs).alias("p"))
    part = part.select("th", (F.col("s") + F.col("p.a")).alias("a"), (F.col("s") + F.col("p.b") + (length - 1)).alias("b"))
    spans = whole.unionByName(part).unionByName(local).groupBy("th").agg(F.collect_set(F.struct("a", "b")).alias("spans"))
    spans = staged(spans, "spans")
    for done in (all_rows, flags, asked, found):
        discard(done)
    return spans


def _key(text: str = "text") -> Column:
    return F.xxhash64(F.coalesce(text, F.lit("")))


def _cleaned(joined: DataFrame, length: int, with_text: bool) -> DataFrame:
    schema = joined.select("doc_id").schema.add("n_bytes", "long").add("n_removed", "long").add("n_spans", "long").add("kept_sha256", "string")
    if with_text:
        schema = schema.add("kept", "binary")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for lo, hi, buf, off in text_slices(batch, "text"):
                data = buf.tobytes()
                cols: list[list] = [[] for _ in range(5)]
                spans = batch.column("spans").slice(lo, hi - lo).to_pylist()
                for d, (found, copies) in enumerate(zip(spans, batch.column("copies").slice(lo, hi - lo).to_pylist(), strict=True)):
                    t = data[off[d] : off[d + 1]]
                    at = [(0, len(t))] if copies > 1 and len(t) >= length else sorted((x["a"], x["b"]) for x in found or ())
                    merged: list[list[int]] = []
                    for a, b in at:
                        if merged and a <= merged[-1][1]:
                            merged[-1][1] = max(merged[-1][1], b)
                        else:
                            merged.append([a, b])
                    ends = [0, *(x for m in merged for x in m), len(t)]
                    kept = b"".join(t[a:b] for a, b in zip(ends[::2], ends[1::2], strict=True))
                    for c, v in zip(cols, (len(t), len(t) - len(kept), len(merged), hashlib.sha256(kept).hexdigest(), kept), strict=True):
                        c.append(v)
                arrays = [batch.column("doc_id").slice(lo, hi - lo), *(pa.array(c, pa.int64()) for c in cols[:3]), pa.array(cols[3], pa.string())]
                yield pa.RecordBatch.from_arrays(arrays + ([pa.array(cols[4], pa.binary())] if with_text else []), schema.names)

    return joined.mapInArrow(run, schema)


def remove_repeats(docs: DataFrame, length: int = LENGTH, with_text: bool = False) -> DataFrame:
    """One row per document: doc_id, n_bytes, n_removed, n_spans, kept_sha256, and the kept bytes if asked for.

    Texts are bytes of UTF-8, null counts as empty, and matches never run from one document into the next. Every byte of
    a string of `length` bytes that starts somewhere else too is removed, also within one text and where strings overlap.
    Repeated rows are documents of their own. Texts are told apart by 128 bits of hash: by 64, and where two differ in
    another 64 by both. An empty table gives no rows; other columns are not read.
    """
    text = F.coalesce("text", F.lit(""))
    second = F.xxhash64(F.lit(7), text)
    keyed = docs.select("doc_id", text.alias("text"), _key().alias("th"))
    clash = staged(docs.select(_key().alias("th"), second.alias("x")).groupBy("th").agg(F.count(F.lit(1)).alias("copies"), F.min("x").alias("lo"), F.max("x").alias("hi")), "texts")
    total = clash.agg(F.coalesce(F.sum("copies"), F.lit(0))).first()[0]
    clash = clash.where("lo <> hi").select(F.col("th").alias("clash"))
    if not clash.isEmpty():
        keyed = keyed.join(clash, F.col("th") == F.col("clash"), "left").withColumn("th", F.when(F.col("clash").isNotNull(), F.xxhash64("th", F.xxhash64(F.lit(7), "text"))).otherwise(F.col("th"))).drop("clash")
    spans = removed_ranges(keyed, total, length)
    copies = keyed.groupBy("th").agg(F.count(F.lit(1)).alias("copies"))
    # written, so that both sides of the last join are plain scans and a text with very many copies is split there
    extra = staged(copies.join(spans, "th", "left").where("copies > 1 or spans is not null"), "extra")
    joined = keyed.join(extra, "th", "left").select("doc_id", "text", F.coalesce("copies", F.lit(1)).alias("copies"), "spans")
    return _cleaned(joined, length, with_text)


def op9_repeats(spark: SparkSession, sf_dir: str) -> DataFrame:
    return remove_repeats(table(spark, sf_dir, "documents"))

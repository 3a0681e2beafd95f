"""SimHash near-duplicates by meet-in-the-middle ball hashing.

Two fingerprints at most three bits apart have a third one in the middle. Each side emits the fingerprints around it, the
emitted values are shuffled, and fingerprints that meet at a value are checked. Emitting radius two everywhere is not
needed, because the parity of a fingerprint tells which side of a pair it is on:

* two bits apart: same parity, and both emit all 64 neighbours, so they meet at one;
* one or three bits apart: different parity. The even one emits its 64 neighbours, the odd one emits itself and its
  neighbours at distance two. Of three differing bits two lie in the same half of the word, so the odd one needs only
  the 992 pairs of positions that lie in one half (no smaller set of pairs meets every triple).
"""

from __future__ import annotations

from collections.abc import Iterator
from itertools import combinations

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from .common import staged, table, text_slices, words_of
from .components import connected_components
from .hashing import xxh64_spans

RADIUS = 3
SHINGLE = 3
SEED = 42


def _signed(x: int) -> int:
    return x - (1 << 64) if x >> 63 else x


ONE = [_signed(1 << i) for i in range(64)]
TWO = [_signed((1 << i) | (1 << j)) for h in (range(32), range(32, 64)) for i, j in combinations(h, 2)]


def _fingerprints(buf: np.ndarray, off: np.ndarray) -> np.ndarray:
    words, start, end, first = words_of(buf, off, lower=True)
    counts = np.diff(first)
    n = np.maximum(counts - (SHINGLE - 1), np.minimum(counts, 1))
    out = np.zeros(len(counts), np.uint64)
    full = np.flatnonzero(n)
    if not len(full):
        return out
    heads = np.repeat(first[:-1][full], n[full]) + (np.arange(n[full].sum()) - np.repeat(np.cumsum(n[full]) - n[full], n[full]))
    tails = np.minimum(heads + SHINGLE - 1, np.repeat(first[1:][full], n[full]) - 1)
    h = xxh64_spans(words, start[heads], end[tails] - start[heads], SEED)
    at = np.cumsum(n[full]) - n[full]
    # bit k of each byte is summed in byte lanes, at most 255 hashes to a sum, and the lanes are added up by text
    cuts = np.union1d(at, np.arange(0, len(h), 255))
    of = np.searchsorted(cuts, at)
    sums = np.empty((len(full), 64), np.int64)
    for k in range(8):
        lanes = np.add.reduceat((h >> np.uint64(k)) & np.uint64(0x0101010101010101), cuts)
        sums[:, k::8] = np.add.reduceat(lanes.view(np.uint8).reshape(-1, 8), of, axis=0, dtype=np.int64)
    ones = 2 * sums > n[full][:, None]
    out[full] = np.packbits(ones, axis=1, bitorder="little").view("<u8")[:, 0]
    return out


def fingerprints(docs: DataFrame, text: str = "text") -> DataFrame:
    """docs with its text replaced by `fp` (the fingerprint as a signed long)."""
    rest = [c for c in docs.columns if c != text]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            parts = [_fingerprints(buf, off) for _, _, buf, off in text_slices(batch, text)]
            fp = np.concatenate(parts) if parts else np.zeros(0, np.uint64)
            yield pa.RecordBatch.from_arrays([*(batch.column(c) for c in rest), pa.array(fp.view(np.int64))], [*rest, "fp"])

    schema = docs.drop(text).schema.add("fp", "long")
    return docs.select(*rest, text).mapInArrow(run, schema)


def _around(df: DataFrame, masks: list[int]) -> DataFrame:
    """(z, fp): each fingerprint under its variants. z is folded to 48 bits, which a shuffle stores in less; variants
    that meet by the fold alone are one in 2**48 and fail the check of the pair."""
    v: Column = F.col("fp").bitwiseXOR(F.col("mask"))
    z = v.bitwiseXOR(F.shiftrightunsigned(v, 48)).bitwiseAND((1 << 48) - 1)
    return df.select("fp", F.explode(F.lit(masks)).alias("mask")).select(z.alias("z"), "fp")


def close_pairs(fps: DataFrame) -> DataFrame:
    """All pairs (a < b) of the distinct longs in fps.fp that differ in one to three bits, each once."""
    # the written table may be a few files; every task is to emit its share of the balls
    fps = fps.repartition(max(8, int(fps.sparkSession.conf.get("spark.sql.shuffle.partitions"))), "fp")
    near = _around(fps, ONE)
    far = _around(fps.where(F.bit_count("fp") % 2 == 1), [0, *TWO])
    index = near.select("z", F.col("fp").alias("y")).hint("merge")
    close = (F.bit_count(F.col("fp").bitwiseXOR(F.col("y"))) <= RADIUS) & (F.col("fp") != F.col("y"))
    met = near.join(index, "z").where(close & (F.col("fp") < F.col("y"))).union(far.join(index, "z").where(close))
    return met.select(F.least("fp", "y").alias("a"), F.greatest("fp", "y").alias("b")).distinct()


def simhash_components(docs: DataFrame, extra: tuple[str, ...] = ()) -> DataFrame:
    """One row per document: doc_id, `extra`, fingerprint (hex), component_id.

    Null texts and texts without words have fingerprint zero and link like any other. Repeated rows stay. component_id
    is null only if no document of the component has an id. Links are found between distinct fingerprints, so copies
    cost one row each and their pairs are never listed. An empty table gives an empty result.
    """
    hexed = F.lower(F.lpad(F.hex("fp"), 16, "0"))
    return rooted(docs, extra).select("doc_id", *extra, hexed.alias("fingerprint"), "component_id")


def rooted(docs: DataFrame, extra: tuple[str, ...] = ()) -> DataFrame:
    """(doc_id, `extra`, fp, root, component_id): root names the component also where ids are null or not unique."""
    marked = staged(fingerprints(docs.select("doc_id", *extra, "text")), "fingerprints")
    fps = staged(marked.groupBy("fp").agg(F.min("doc_id").alias("least")), "distinct")
    roots = connected_components(close_pairs(fps.select("fp")))
    ends = fps.join(roots, fps.fp == roots.node, "left").select("fp", "least", F.coalesce("root", "fp").alias("root"))
    ends = staged(ends, "roots")
    ids = ends.groupBy("root").agg(F.min("least").alias("component_id"))
    named = ends.join(ids, "root").select("fp", "root", "component_id")
    return marked.join(named, "fp").select("doc_id", *extra, "fp", "root", "component_id")


def op8_simhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    return simhash_components(table(spark, sf_dir, "documents"))

"""Byte-level BPE encoding and decoding with reuse of content-defined chunks.

A rolling hash over the bytes cuts every text where the hash of the last 32 bytes ends in zeros, so equal passages of
different texts are cut alike. What a chunk encodes to does not depend on its neighbours except near its two ends. The
join of two chunks is repaired by re-encoding from the last token boundary that the left chunk is certain of to the
first that the right chunk is certain of; a chunk that is certain of none is taken into the join, which so grows until
both sides agree. A boundary is certain where white space follows a visible ASCII character: the splitting rule never
puts the two into one piece and its look-ahead never looks back across the place. So each chunk by itself, both chunks
together and the whole text have a token boundary there and the same tokens between two such places; the tests hold
chunks and joins against each other, and the whole against the tokenizer. The tokens are exactly those of the whole text.

Chunks and joins are looked up in a store before they are encoded. The store is one of a task's worker process, bounded
in bytes by two generations, so a passage is encoded once in each worker however many documents there share it. A store
for the whole corpus would shuffle the texts and their tokens once more than the encoding costs.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .common import table, text_slices

CHUNK_BITS = 8
STORE_BYTES = 24 << 20
_GEAR = ((np.arange(1, 257, dtype=np.uint64) * np.uint64(0x9E3779B97F4A7C15)) >> np.uint64(32)).astype(np.uint32)


def cut_points(buf: np.ndarray, bits: int = CHUNK_BITS) -> np.ndarray:
    """Places before which a chunk ends: the hash of the 32 bytes up to there has `bits` leading zeros.

    The hash of a window is the sum of its bytes' random numbers, each doubled once for every byte that follows it.
    """
    h = _GEAR[buf]
    for step in (1, 2, 4, 8, 16):
        h[step:] = h[step:] + (h[:-step] << np.uint32(step))
    at = np.flatnonzero(h >> np.uint32(32 - bits) == 0) + 1
    at = at[at < len(buf)]
    while len(inside := np.flatnonzero((buf[at] & 0xC0) == 0x80)):  # not within a character
        at[inside] += 1
        at = at[at < len(buf)]
    return at


class Encoder:
    """Pieces of text to (tokens, their decimal ids joined by commas, their bytes), with a bounded store."""

    def __init__(self, path: str, store_bytes: int = STORE_BYTES) -> None:
        import json

        import tiktoken

        with open(path, encoding="utf-8") as f:
            spec = json.load(f)
        model, before = spec["model"], spec["pre_tokenizer"] or {}
        plain = [*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)]  # byte-level BPE shows these as they are
        rest = [b for b in range(256) if b not in set(plain)]
        byte = {chr(b): b for b in plain} | {chr(256 + k): b for k, b in enumerate(rest)}
        raw = lambda t: bytes(byte[c] for c in t)
        vocab, added = model["vocab"], spec["added_tokens"]
        pairs = [m.split(" ") if isinstance(m, str) else m for m in model["merges"]]
        merged = [vocab[a + b] for a, b in pairs]
        # what the chunks rely on, and what the library for the merges takes from the order of ids
        checks = {
            "a byte-level BPE model": model["type"] == "BPE" and before.get("type") == "ByteLevel" and (spec["decoder"] or {}).get("type") == "ByteLevel",
            "the usual splitting rule without a blank put in front": before.get("use_regex", True) and not before.get("add_prefix_space"),
            "no normalizer and no post-processor": spec["normalizer"] is None and spec["post_processor"] is None,
            "plain merges": not any(model.get(k) for k in ("dropout", "unk_token", "continuing_subword_prefix", "end_of_word_suffix", "byte_fallback", "ignore_merges")),
            "ids in the order of the merges": merged == sorted(set(merged)) and all(c in vocab for c in byte) and len(vocab) - len([t for t in added if t["content"] in vocab]) == 256 + len(pairs) and max(vocab[c] for c in byte) < min(merged, default=256),
            "special tokens that stand for themselves": all(t["special"] and not (t["single_word"] or t["lstrip"] or t["rstrip"] or t["normalized"]) for t in added),
        }
        if missing := [name for name, ok in checks.items() if not ok]:
            raise ValueError(f"{path} is not {' and '.join(missing)}")
        self.special = {t["content"]: t["id"] for t in added}
        self.guards = [t.encode() for t in self.special]
        ranks = {raw(t): i for t, i in vocab.items() if t not in self.special}
        pattern = r"'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"  # fixed: the rule of ByteLevel
        self.ranks = tiktoken.Encoding("byte_bpe", pat_str=pattern, mergeable_ranks=ranks, special_tokens=self.special)
        self.bytes = {i: t for t, i in ranks.items()} | {i: t.encode() for t, i in self.special.items()}
        self.decimal = {i: str(i) for i in self.bytes}
        self.young: dict[bytes, tuple[int, str, bytes]] = {}
        self.old: dict[bytes, tuple[int, str, bytes]] = {}
        self.room = self.limit = store_bytes // 2

    def piece(self, data: bytes) -> tuple[int, str, bytes]:
        got = self.young.get(data)
        if got is None:
            got = self.old.get(data) or self.encode(data)
            if len(data) <= 4096:
                self.young[data] = got
                self.room -= 300 + 6 * len(data)
                if self.room < 0:
                    self.old, self.young, self.room = self.young, {}, self.limit
        return got

    def encode(self, data: bytes) -> tuple[int, str, bytes]:
        ids = self.ranks.encode(data.decode("utf-8", "replace"), allowed_special="all")
        return len(ids), ",".join([self.decimal[i] for i in ids]), b"".join([self.bytes[i] for i in ids])


_encoders: dict[str, Encoder] = {}


def _encoder(path: str) -> Encoder:
    if path not in _encoders:
        _encoders[path] = Encoder(path)
    return _encoders[path]


def piece_bounds(buf: np.ndarray, off: np.ndarray) -> np.ndarray:
    """Ends of the pieces to encode: the inner part of each chunk and the joins between them, and the ends of texts."""
    cuts = cut_points(buf)
    visible = (buf > 0x20) & (buf < 0x7F)
    blank = (buf == 0x20) | (buf == 0x0A)
    sure = np.flatnonzero(visible[:-1] & blank[1:]) + 1
    lo = np.union1d(cuts, off[:-1])
    hi = np.append(lo[1:], len(buf))
    a, b = np.searchsorted(sure, lo, "right"), np.searchsorted(sure, hi, "left") - 1
    some = np.flatnonzero(a <= b)
    return np.unique(np.concatenate([sure[a[some]], sure[b[some]], off[1:]]))


def encoded(docs: DataFrame, tokenizer: str, keep: list[str]) -> DataFrame:
    """The columns `keep`, then n_tokens, ids (comma-joined decimals), decoded (text).

    A null text counts as empty and gives no tokens. A special token's string is encoded as that token, as the tokenizer
    does; a text that holds one is encoded as a whole. Texts of any length are encoded whole, in memory of their size.
    Repeated rows stay, an empty table gives no rows, and a tokenizer file that works otherwise is refused.
    """
    schema = docs.select(*keep).schema.add("n_tokens", "long").add("ids", "string").add("decoded", "string")
    return _each(docs, tokenizer, keep, schema, lambda ids, text: (ids, text.decode("utf-8", "replace")))


def digests(docs: DataFrame, tokenizer: str, keep: list[str]) -> DataFrame:
    """As `encoded`, with ids_sha256 and decoded_sha256 in place of ids and text."""
    schema = docs.select(*keep).schema.add("n_tokens", "long").add("ids_sha256", "string").add("decoded_sha256", "string")
    sha = lambda b: hashlib.sha256(b).hexdigest()
    return _each(docs, tokenizer, keep, schema, lambda ids, text: (sha(ids.encode()), sha(text.decode("utf-8", "replace").encode())))


def _each(docs: DataFrame, tokenizer: str, keep: list[str], schema, finish) -> DataFrame:
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        enc = _encoder(tokenizer)
        for batch in batches:
            for lo, hi, buf, off in text_slices(batch, "_text", 4 << 20):
                ends = piece_bounds(buf, off) if len(buf) else off[1:]
                upto = np.searchsorted(ends, off[1:], "right")
                from_ = np.searchsorted(ends, off[:-1], "right")
                data = buf.tobytes()
                n, first, second = [], [], []
                for s, e, i, j in zip(off[:-1].tolist(), off[1:].tolist(), from_.tolist(), upto.tolist(), strict=True):
                    if any(data.find(g, s, e) >= 0 for g in enc.guards):
                        parts = [enc.encode(data[s:e])]
                    else:
                        at = [s, *ends[i:j].tolist()]
                        parts = [enc.piece(data[a:b]) for a, b in zip(at, at[1:]) if a < b]
                    n.append(sum([p[0] for p in parts]))
                    x, y = finish(",".join([p[1] for p in parts]), b"".join([p[2] for p in parts]))
                    first.append(x)
                    second.append(y)
                cols = [batch.column(c).slice(lo, hi - lo) for c in keep]
                yield pa.RecordBatch.from_arrays([*cols, pa.array(n, pa.int64()), pa.array(first), pa.array(second)], schema.names)

    return docs.select(*keep, F.col("text").alias("_text")).mapInArrow(run, schema)


def default_tokenizer() -> str:
    import public_tokenizers

    return public_tokenizers.path("byte_bpe_50k.json")


def op3_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    return digests(table(spark, sf_dir, "documents"), default_tokenizer(), ["doc_id"])

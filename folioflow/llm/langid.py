"""Language identification by a byte convolutional network trained in numpy."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .common import table, text_slices

WINDOW = 256  # bytes
WIDTHS = (2, 3, 4)
FILTERS = 8  # of each width
DIMS = 8  # of a byte
#: The training sample: about so many documents of each language, read whole. This bounds what reaches the driver.
SAMPLE_DOCS = 400
HELD_OUT = 2  # the remainder of crc32(doc_id) mod 4 that is never learned from


def fold(doc_id: str = "doc_id"):
    return F.crc32(F.col(doc_id).cast("string").cast("binary")) % 4


def sample(docs: DataFrame, per_language: int = SAMPLE_DOCS) -> tuple[list[str], list[str]]:
    """Texts and their languages: a bounded sample of the labelled documents outside the held-out fold.

    Each language is thinned by a hash of doc_id and text to about `per_language` documents, so every language is learned and
    rare ones are taken whole. A document without an id is in no fold and is not learned from.
    """
    d = docs.where(F.col("lang").isNotNull() & F.col("text").isNotNull() & (fold() != HELD_OUT))
    # one row for each output of the network, which the driver holds in any case; so texts are not shuffled to be sampled
    shares = d.groupBy("lang").agg((per_language / F.count(F.lit(1))).alias("share")).withColumnRenamed("lang", "lang_")
    u = (F.shiftrightunsigned(F.xxhash64("doc_id", "text"), 11).cast("double") + 0.5) / float(1 << 53)
    rows = d.select("doc_id", "lang", "text", u.alias("u")).join(F.broadcast(shares), F.col("lang") == F.col("lang_")).where(F.col("u") < F.col("share")).select("lang", "text").distinct().collect()
    rows.sort()
    return [r["text"] for r in rows], [r["lang"] for r in rows]


def windows(buf: np.ndarray, off: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Fixed-length windows over each text, end to end, the last one filled with zero bytes: (windows, text, bytes used)."""
    size = np.diff(off)
    n = -(-size // WINDOW)
    of = np.repeat(np.arange(len(size)), n)
    nth = np.arange(len(of)) - np.repeat(np.cumsum(n) - n, n)
    start = off[:-1][of] + nth * WINDOW
    used = np.minimum(WINDOW, off[1:][of] - start)
    at = start[:, None] + np.arange(WINDOW)
    x = np.where(np.arange(WINDOW) < used[:, None], np.append(buf, np.zeros(1, np.uint8))[np.minimum(at, len(buf))], 0)
    return x.astype(np.uint8), of, used


class Net:
    """Byte embedding, filters of several widths, maximum over the window, softmax."""

    def __init__(self, languages: list[str], seed: int = 3) -> None:
        rng = np.random.default_rng(seed)
        self.languages = languages
        self.p = {"e": rng.normal(0, 0.3, (256, DIMS)), "o": rng.normal(0, 0.1, (len(WIDTHS) * FILTERS, len(languages))), "c": np.zeros(len(languages))}
        for w in WIDTHS:
            self.p[f"w{w}"] = rng.normal(0, (w * DIMS) ** -0.5, (w * DIMS, FILTERS))

    def step(self, x: np.ndarray, y: np.ndarray) -> dict[str, np.ndarray]:
        """Gradient of the mean log loss over windows x with languages y."""
        p, n = self.p, len(x)
        emb = p["e"][x]
        tops, places = [], []
        for w in WIDTHS:
            seen = np.lib.stride_tricks.sliding_window_view(emb, (w, DIMS), axis=(1, 2)).reshape(n, WINDOW - w + 1, w * DIMS)
            z = seen @ p[f"w{w}"]
            at = z.argmax(1)
            tops.append(np.take_along_axis(z, at[:, None], 1)[:, 0])
            places.append(at)
        h = np.concatenate(tops, 1)
        a = np.maximum(h, 0)
        logit = a @ p["o"] + p["c"]
        q = np.exp(logit - logit.max(1, keepdims=True))
        q /= q.sum(1, keepdims=True)
        q[np.arange(n), y] -= 1
        q /= n
        g = {"o": a.T @ q, "c": q.sum(0), "e": np.zeros_like(p["e"])}
        dh = (q @ p["o"].T) * (h > 0)
        for i, w in enumerate(WIDTHS):
            d = dh[:, i * FILTERS : (i + 1) * FILTERS]
            at = places[i][..., None] + np.arange(w)
            bytes_ = x[np.arange(n)[:, None, None], at]
            v = p["e"][bytes_].reshape(n, FILTERS, w * DIMS)
            g[f"w{w}"] = np.einsum("nf,nfk->kf", d, v)
            back = (d[..., None] * p[f"w{w}"].T).reshape(n, FILTERS, w, DIMS)
            np.add.at(g["e"], bytes_, back)
        return g

    def fit(self, x: np.ndarray, y: np.ndarray, epochs: int = 6, size: int = 128, rate: float = 0.01, seed: int = 5) -> Net:
        """Adam over shuffled batches."""
        rng = np.random.default_rng(seed)
        m, v, t = {k: 0.0 for k in self.p}, {k: 0.0 for k in self.p}, 0
        for _ in range(epochs):
            order = rng.permutation(len(x))
            for lo in range(0, len(x), size):
                b = order[lo : lo + size]
                g, t = self.step(x[b], y[b]), t + 1
                for k in self.p:
                    m[k] = 0.9 * m[k] + 0.1 * g[k]
                    v[k] = 0.999 * v[k] + 0.001 * g[k] ** 2
                    self.p[k] = self.p[k] - rate * (m[k] / (1 - 0.9**t)) / (np.sqrt(v[k] / (1 - 0.999**t)) + 1e-8)
        return self

    def tables(self) -> dict[str, np.ndarray]:
        """What a filter adds for two bytes at a time, so that a window needs a look-up for each pair."""
        e = self.p["e"].astype(np.float32)
        out = {"o": self.p["o"].astype(np.float32), "c": self.p["c"].astype(np.float32)}
        for w in WIDTHS:
            f = self.p[f"w{w}"].astype(np.float32).reshape(w, DIMS, FILTERS)
            one = [e @ f[j] for j in range(w)]
            for j in range(0, w - 1, 2):
                out[f"{w}.{j}"] = (one[j][:, None] + one[j + 1]).reshape(65536, FILTERS)
            if w % 2:
                out[f"{w}.{w - 1}"] = one[-1]
        return out


def log_probabilities(x: np.ndarray, t: dict[str, np.ndarray], block: int = 128) -> np.ndarray:
    """Of each language for each window, in blocks that fit the processor's cache."""
    out = np.empty((len(x), len(t["c"])), np.float32)
    for lo in range(0, len(x), block):
        b = x[lo : lo + block].astype(np.intp)
        pairs = (b[:, :-1] << 8) | b[:, 1:]
        tops = []
        for w in WIDTHS:
            n = WINDOW - w + 1
            z = t[f"{w}.0"][pairs[:, :n]]
            for j in range(2, w, 2):
                z += t[f"{w}.{j}"][pairs[:, j : j + n] if j + 1 < w else b[:, j : j + n]]
            tops.append(z.max(1))
        logit = np.maximum(np.concatenate(tops, 1), 0) @ t["o"] + t["c"]
        logit -= logit.max(1, keepdims=True)
        out[lo : lo + block] = logit - np.log(np.exp(logit).sum(1, keepdims=True))
    return out


def train(docs: DataFrame) -> Net | None:
    pieces, langs = sample(docs)
    if not pieces:
        return None
    names = sorted(set(langs))
    data = [p.encode() for p in pieces]
    off = np.concatenate([[0], np.cumsum([len(d) for d in data])])
    x, of, used = windows(np.frombuffer(b"".join(data), np.uint8), off)
    y = np.array([names.index(k) for k in langs])[of]
    some = used >= np.minimum(16, np.diff(off))[of]  # no short rests of a text, but short texts
    return Net(names).fit(x[some], y[some])


def predict(docs: DataFrame, net: Net | None, keep: list[str]) -> DataFrame:
    """The columns `keep`, then lang_pred and score.

    A text is cut into windows from end to end; the mean of their log probabilities, weighted by bytes, decides, and
    score is the share of the winner. A text that is null or holds no letter is `und` with score 0, and so is every
    text if there was nothing to learn from. Ties go to the first language in order. Repeated rows stay, and each row is
    predicted by itself; an empty table gives no rows.
    """
    names = net.languages if net else []
    tables = net.tables() if net else {}
    schema = docs.select(*keep).schema.add("lang_pred", "string").add("score", "double")
    letter = np.zeros(256, np.int64)
    letter[[*range(65, 91), *range(97, 123)]] = 1

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for lo, hi, buf, off in text_slices(batch, "_text", 1 << 20):
                ascii_ = np.concatenate([[0], np.cumsum(letter[buf])])
                known = (ascii_[off[1:]] > ascii_[off[:-1]]) & bool(names)
                for d in np.flatnonzero(~known & (np.diff(off) > 0)) if names else ():
                    known[d] = any(map(str.isalpha, buf[off[d] : off[d + 1]].tobytes().decode("utf-8", "replace")))
                best, score = np.zeros(hi - lo, np.int64), np.zeros(hi - lo)
                if known.any():
                    x, of, used = windows(buf, off)
                    lp = log_probabilities(x, tables).astype(float) * used[:, None]
                    total = np.zeros((hi - lo, len(names)))
                    np.add.at(total, of, lp)
                    total /= np.maximum(np.diff(off), 1)[:, None]
                    q = np.exp(total - total.max(1, keepdims=True))
                    q /= q.sum(1, keepdims=True)
                    best, score = q.argmax(1), np.where(known, q.max(1), 0.0)
                pred = [names[i] if k else "und" for i, k in zip(best.tolist(), known.tolist(), strict=True)]
                cols = [batch.column(c).slice(lo, hi - lo) for c in keep]
                yield pa.RecordBatch.from_arrays([*cols, pa.array(pred, pa.string()), pa.array(score)], schema.names)

    return docs.select(*keep, F.col("text").alias("_text")).mapInArrow(run, schema)


def identify(docs: DataFrame) -> DataFrame:
    d = predict(docs, train(docs), ["doc_id"])
    return d.select("doc_id", F.coalesce(fold() == HELD_OUT, F.lit(False)).alias("held_out"), "lang_pred", "score")


def op4_langid(spark: SparkSession, sf_dir: str) -> DataFrame:
    return identify(table(spark, sf_dir, "documents"))

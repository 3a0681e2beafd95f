"""Personal data: exact patterns, and a linear-chain conditional random field over word shapes for what they miss."""

from __future__ import annotations

import hashlib
import re
from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession

from .common import table, text_slices, words_of

KINDS = ("email", "ip", "card", "phone", "secret")
STATES = ("", *KINDS)
SHAPES = 1 << 15

_AT = re.compile(r"@[A-Za-z0-9-]+(?:\.[A-Za-z0-9-]+)+")
# A digit run is tried from its first digit only: a later start in the run has the same continuation.
_IP = re.compile(r"(?<![0-9])[0-9]++\.[0-9]++\.[0-9]++\.[0-9]++")
_CARD = re.compile(r"[0-9](?:[\x20-]?[0-9])+")
_PHONE = re.compile(r"\+[0-9][\x20().0-9-]+[0-9]")
_DIGIT = re.compile(r"[0-9]")


def _emails(t: str) -> list[tuple[int, int]]:
    """Each @ with a domain after it takes the local characters before it, back to the end of the last match."""
    out, done = [], 0
    for m in _AT.finditer(t):
        lo = m.start()
        while lo > done and (c := t[lo - 1]).isascii() and (c.isalnum() or c in "._%+-"):
            lo -= 1
        if lo < m.start():
            out.append((lo, m.end()))
            done = m.end()
    return out


def _is_ip(s: str) -> bool:
    return all(len(p) <= 3 and int(p or "0") <= 255 for p in (x.lstrip("0") for x in s.split(".")))


def _is_card(s: str) -> bool:
    d = [ord(c) - 48 for c in s if c not in " -"]
    if not 16 <= len(d) <= 19:
        return False
    return sum(x if i % 2 == 0 else (2 * x - 9 if x > 4 else 2 * x) for i, x in enumerate(reversed(d))) % 10 == 0


def base_spans(t: str) -> list[tuple[str, int, int]]:
    """Exact matches, by kind as listed, then by place; leftmost, not overlapping within a kind, failing ones dropped."""
    out = [("email", a, b) for a, b in _emails(t)] if "@" in t else []
    out += [("ip", *m.span()) for m in _IP.finditer(t) if _is_ip(m.group())]
    out += [("card", *m.span()) for m in _CARD.finditer(t) if m.end() - m.start() >= 16 and _is_card(m.group())]
    if "+" in t:
        out += [("phone", *m.span()) for m in _PHONE.finditer(t) if 8 <= len(_DIGIT.findall(m.group())) <= 15]
    return out


# --- the conditional random field -------------------------------------------------------------------------------

_CLASS = np.full(256, 1, np.uint32)  # letters beyond ASCII count as lower case
_CLASS[ord("a") : ord("z") + 1], _CLASS[ord("A") : ord("Z") + 1], _CLASS[ord("0") : ord("9") + 1] = 1, 2, 3
for _i, _c in enumerate("@.-+()=\"':/_\\"):
    _CLASS[ord(_c)] = 5 + _i
for _c in "#*$%&!|,;?<>~^`[]{}":
    _CLASS[ord(_c)] = 4
_CLASS[:33] = 4
_HEX = np.zeros(256, bool)
_HEX[[ord(c) for c in "0123456789abcdefABCDEF"]] = True
_POWERS = (np.uint64(0x9E3779B97F4A7C15) ** np.arange(1, 65, dtype=np.uint64)).astype(np.uint64)
FEATURES = 5  # shape, previous shape, next shape, digits, length


def features(buf: np.ndarray, start: np.ndarray, end: np.ndarray, head: np.ndarray) -> np.ndarray:
    """Feature ids (words x FEATURES). A shape is the sequence of character classes, repeats collapsed, with the word's
    length and digits in coarse steps; head marks words that begin a sequence."""
    n = len(start)
    if not n:
        return np.zeros((0, FEATURES), np.int32)
    cls = _CLASS[buf]
    change = np.empty(len(buf), bool)
    change[0], change[1:] = True, cls[1:] != cls[:-1]
    change[start] = True
    runs = np.flatnonzero(change)
    first = np.searchsorted(runs, start)
    place = np.arange(len(runs)) - np.repeat(first, np.diff(np.append(first, len(runs))))
    shape = np.add.reduceat(cls[runs].astype(np.uint64) * _POWERS[place & 63], first)
    digits = np.concatenate([[0], np.cumsum(cls == 3)])
    hexes = np.concatenate([[0], np.cumsum(_HEX[buf])])
    length = end - start
    d = np.searchsorted([1, 2, 4, 7, 10, 12, 16, 20], digits[end] - digits[start], "right")
    long_hex = (hexes[end] - hexes[start] >= 20) & (hexes[end] - hexes[start] >= length - 6)
    size = np.searchsorted([2, 4, 8, 16, 24, 40, 64], length, "right") + 10 * long_hex
    shape = ((shape ^ (shape >> np.uint64(29))) * np.uint64(0xBF58476D1CE4E5B9) >> np.uint64(49)).astype(np.int64) % SHAPES
    edge = SHAPES
    before = np.append(edge, shape[:-1])
    before[head] = edge
    after = np.append(shape[1:], edge)
    after[:-1][head[1:]] = edge
    wide = SHAPES + 1
    return np.stack([shape, wide + before, 2 * wide + after, 3 * wide + d, 3 * wide + 10 + size], 1).astype(np.int32)


WEIGHTS = 3 * (SHAPES + 1) + 40

# The labelled table: {kind} marks stand for values of that kind; everything else is outside.
SENTENCES = (
    "contact {email} for more", "mail {email} or {email} now", "write to {email} , please", "reach us at {email} .", "the and {email} of in",
    "call {phone} today", "phone {phone} or {phone}", "her number is {phone} , he said", "fax {phone} and {email}", "of the {phone} in an",
    "host {ip} is down", "from {ip} to {ip}", "server {ip} answered", "the and {ip} or of",
    "card {card} expires", "paid with {card} on", "account {card} and {card}", "the {card} of and", "{card}", "{ip}", "{phone}", "{email}",
    'token = {secret} here', 'key = {secret}', 'password : {secret} and', 'api_key= {secret} of', 'the token = {secret} and', "secret {secret} was leaked",
    "version 3 of the work", "licensed under version 2.0 .", "on 2021-04-05 at 10:30", "it cost $3.50 or 12,345 in 1999", "about 42 of 100 men", "see page 7 , line 12 .",
    "x = 3 and y = 4", "he said \"hello\" and left", "The and of in to it.", "Of the. And, to in of", "LOUD WORDS ARE HERE!! AND!! MORE!!", "odd*** marks### after%%% words&&& here$$$",
    "a (small) remark - and so on", "over-the-top phrase , isn't it", "and/or either way", "http://example.com/page is a link", "the 3rd of 4 parts", "in 2020 and 2021 it was", "CC BY-NC 4.0.", "| cell | other | third |",
    "Être là où ça va .", "über die Straße und für", "niño y mañana están", "word. Another word, and; more: or", "1 2 3 4 5", "10 , 20 , 30 and 40", "chapter 12 section 3.4.5 of", "v1.2.3 was released",
    "the {word} of {word} and {word}", "{word} .", "{word}. {word}, {word} in", "and {word}&&& {word} to {word}!", "{word}",
)


def labelled(seed: int = 7, rounds: int = 24) -> tuple[list[list[str]], list[list[int]]]:
    """The labelled table: words and states, with values drawn from a fixed seed and marks of noise on some words."""
    rng = np.random.default_rng(seed)
    pick = lambda s, k: "".join(rng.choice(list(s), k))
    num = lambda k: pick("0123456789", k)
    name = lambda: pick("abcdefghilmnoprstu", rng.integers(2, 9))

    def value(kind: str) -> str:
        k = rng.integers(4)
        if kind == "email":
            who = (name(), f"{name()}.{name()}", f"{name()}.{num(2)}", f"{name()}{num(2)}")[k]
            return f"{who}@{(name(), name() + num(1))[rng.integers(2)]}.{('example.com', 'org', 'net', 'co.uk')[rng.integers(4)]}"
        if kind == "ip":
            return ".".join(str(rng.integers(1, 256)) for _ in range(4))
        if kind == "card":
            return (num(16), " ".join(num(4) for _ in range(4)), "-".join(num(4) for _ in range(4)), num(16))[k]
        if kind == "phone":
            return (f"+{num(1)} ({num(3)}) {num(3)}-{num(4)}", f"({num(3)}) {num(3)}-{num(4)}", f"+{num(2)} {num(3)} {num(7)}", f"+{num(1)}-{num(3)}-{num(3)}-{num(4)}")[k]
        if kind == "word":
            text = pick("abcdeéfghiílmnñoprsßtuüvwz", rng.integers(6, 34))
            return (text, text.capitalize(), text, text.upper())[k]
        text = pick("0123456789abcdef", int(rng.choice([32, 40, 40, 64])))
        return (f'"{text}"', text, f'"{text.upper()}"', f'"{text}"')[k]

    words, states = [], []
    for _ in range(rounds):
        for sentence in SENTENCES:
            mark = ("", "", "", "***", "%%%", "!!", ".", ",")[rng.integers(8)]
            w, s = [], []
            for part in sentence.split():
                m = re.fullmatch(r"\{(\w+)\}", part)
                got = value(m[1]).split() if m else [part]
                got[-1] += mark if m or mark[1:] else ""
                w += got
                s += [STATES.index(m[1]) if m and m[1] != "word" else 0] * len(got)
            words.append(w)
            states.append(s)
    return words, states


def _sum(x: np.ndarray, axis: int) -> np.ndarray:
    top = x.max(axis, keepdims=True)
    return (top + np.log(np.exp(x - top).sum(axis, keepdims=True))).squeeze(axis)


@lru_cache(maxsize=1)
def train(steps: int = 60, rate: float = 0.25, decay: float = 2e-4) -> tuple[np.ndarray, np.ndarray]:
    """(weights by feature and state, transitions) by gradient ascent on the likelihood of the labelled table.

    Gradients come from the forward-backward pass over all sentences at once; steps are scaled per weight (Adagrad).
    """
    words, states = labelled()
    k, n, most = len(STATES), len(words), max(map(len, words))
    text = "\n".join(" ".join(w) for w in words).encode()
    lens = np.array([len(w) for w in words])
    off = np.concatenate([[0], np.cumsum([len(" ".join(w).encode()) + 1 for w in words])])
    off[-1] = len(text)
    buf, start, end, first = words_of(np.frombuffer(text, np.uint8), off, lower=False)
    head = np.zeros(len(start), bool)
    head[first[:-1]] = True
    flat = features(buf, start, end, head)
    used, ids = np.unique(flat, return_inverse=True)
    ids = ids.reshape(flat.shape)
    row, col = np.repeat(np.arange(n), lens), np.arange(len(flat)) - np.repeat(np.cumsum(lens) - lens, lens)
    gold = np.concatenate([np.array(s) for s in states])
    live = np.arange(most) < lens[:, None]
    w, t = np.zeros((len(used), k)), np.zeros((k, k))
    gw, gt = np.full_like(w, 1e-2), np.full_like(t, 1.0)
    pair = np.zeros((k, k))
    same = np.flatnonzero(col[1:] > 0) + 1
    np.add.at(pair, (gold[same - 1], gold[same]), 1)
    for _ in range(steps):
        e = np.zeros((n, most, k))
        e[row, col] = w[ids].sum(1)
        a = np.zeros((n, most, k))
        a[:, 0] = e[:, 0]
        for i in range(1, most):
            a[:, i] = np.where(live[:, i, None], _sum(a[:, i - 1, :, None] + t, 1) + e[:, i], a[:, i - 1])
        z = _sum(a[:, -1], 1)
        b = np.zeros((n, most, k))
        expected = np.zeros((k, k))
        for i in range(most - 2, -1, -1):
            x = e[:, i + 1] + b[:, i + 1]
            b[:, i] = np.where(live[:, i + 1, None], _sum(t + x[:, None, :], 2), 0)
            p = np.exp(a[:, i, :, None] + t + x[:, None, :] - z[:, None, None]) * live[:, i + 1, None, None]
            expected += p.sum(0)
        p = np.exp(a + b - z[:, None, None])[row, col]
        p[np.arange(len(gold)), gold] -= 1
        grad = np.zeros_like(w)
        for f in range(FEATURES):
            np.add.at(grad, ids[:, f], p)
        grad, step = grad / n + decay * w, (expected - pair) / n + 20 * decay * t
        gw += grad**2
        gt += step**2
        w -= rate * grad / np.sqrt(gw)
        t -= rate * step / np.sqrt(gt)
    full = np.zeros((WEIGHTS, k), np.float32)
    full[used] = w
    return full, t.astype(np.float32)


def viterbi(e: np.ndarray, head: np.ndarray, t: np.ndarray) -> np.ndarray:
    """The best state of every word; head marks the words that begin a sequence.

    A word whose score outside exceeds every other by more than transitions can ever return is outside on the best path,
    so only the runs between such words are decoded, all runs of a batch side by side.
    """
    state = np.zeros(len(e), np.int8)
    if not len(e):
        return state
    slack = 2 * (t.max() - t.min())
    live = e[:, 0] - e[:, 1:].max(1) <= slack
    begin = np.flatnonzero(live & (head | ~np.append(False, live[:-1])))
    if not len(begin):
        return state
    stop = np.flatnonzero(live & (np.append(head[1:], True) | ~np.append(live[1:], False))) + 1
    lens = stop - begin
    order = np.argsort(-lens, kind="stable")
    begin, stop, lens = begin[order], stop[order], lens[order]
    score = e[begin] + np.where(head[begin, None], 0, t[0])
    back = []
    for i in range(1, int(lens[0])):
        m = int(np.searchsorted(-lens, -i, "left"))
        x = score[:m, :, None] + t
        back.append(x.argmax(1).astype(np.int8))
        score[:m] = x.max(1) + e[begin[:m] + i]
    last = np.append(head[1:], True)[stop - 1]
    best = (score + np.where(last[:, None], 0, t[:, 0])).argmax(1).astype(np.int8)
    state[stop - 1] = best
    for i in range(int(lens[0]) - 1, 0, -1):
        m = int(np.searchsorted(-lens, -i, "left"))
        best[:m] = back[i - 1][np.arange(m), best[:m]]
        state[begin[:m] + i - 1] = best[:m]
    return state


_EDGE = " \t\n\x0b\x0c\r.,;:!?#*$%&|<>\"'()[]{}="


def found_spans(texts: list[str], buf: np.ndarray, off: np.ndarray, model: tuple[np.ndarray, np.ndarray]) -> list[list[tuple[str, int, int]]]:
    """What the random field marks in each text, in code points, without the marks around it."""
    out: list[list[tuple[str, int, int]]] = [[] for _ in texts]
    w, t = model
    plain, start, end, first = words_of(buf, off, lower=False)
    if not len(start):
        return out
    head = np.zeros(len(start) + 1, bool)
    head[first[:-1]] = True
    head = head[:-1]
    ids = features(plain, start, end, head)
    e = w[ids[:, 0]]
    for f in range(1, FEATURES):
        e += w[ids[:, f]]
    state = viterbi(e, head, t)
    at = np.flatnonzero(state)
    if not len(at):
        return out
    # where a word stands in the text: its bytes there, found from the words before it
    doc = np.searchsorted(first, at, "right") - 1
    for d in np.unique(doc).tolist():
        mine = at[doc == d]
        places = [m.span() for m in _WORDS.finditer(texts[d])]
        run: list[int] = []
        for i in [*mine.tolist(), -1]:
            if run and (i != run[-1] + 1 or state[i] != state[run[0]]):
                a, b = places[run[0] - first[d]][0], places[run[-1] - first[d]][1]
                while a < b and texts[d][a] in _EDGE and texts[d][a] != "(":
                    a += 1
                while a < b and texts[d][b - 1] in _EDGE:
                    b -= 1
                if a < b:
                    out[d].append((KINDS[state[run[0]] - 1], a, b))
                run = []
            run.append(i)
    return out


_WORDS = re.compile(r"[^\x20\x09-\x0D]+")


def all_spans(base: list[tuple[str, int, int]], more: list[tuple[str, int, int]]) -> list[tuple[str, int, int]]:
    """Base spans, and the others that overlap none of them; by kind as listed, then by place."""
    taken = sorted((a, b) for _, a, b in base)
    free = []
    i = 0
    for kind, a, b in sorted(more, key=lambda s: s[1:]):
        while i < len(taken) and taken[i][1] <= a and (i + 1 == len(taken) or taken[i + 1][0] <= a):
            i += 1
        if not any(x < b and a < y for x, y in taken[max(0, i - 4) : i + 5]):
            free.append((kind, a, b))
    return sorted(base + free, key=lambda s: (KINDS.index(s[0]), s[1]))


def redact(t: str, spans: list[tuple[str, int, int]]) -> str:
    """The text with every span replaced by its kind in angle brackets; overlapping spans become one, named by the first."""
    out, done = [], 0
    for kind, a, b in sorted(spans, key=lambda s: (s[1], -s[2])):
        if a >= done:
            out += [t[done:a], f"<{kind}>"]
        done = max(done, b)
    return "".join([*out, t[done:]])


def scan(docs: DataFrame, text: str = "text", redacted: bool = False) -> DataFrame:
    """The other columns of docs, then n_email, n_ip, n_card, n_phone, base_sha256, spans; with `redacted`, the text
    follows with its spans replaced (null stays null).

    Null and empty texts have no spans. Each row is handled by itself; texts of any length are searched whole.
    """
    rest = [c for c in docs.columns if c != text]
    schema = docs.drop(text).schema
    for c in ("n_email", "n_ip", "n_card", "n_phone"):
        schema = schema.add(c, "long")
    schema = schema.add("base_sha256", "string").add("spans", "string")
    if redacted:
        schema = schema.add(text, "string")
    model = train()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for lo, hi, buf, off in text_slices(batch, text):
                texts = batch.column(text).slice(lo, hi - lo).to_pylist()
                full = [t or "" for t in texts]
                found = found_spans(full, buf, off, model)
                cols: list[list] = [[] for _ in range(7)]
                for given, t, more in zip(texts, full, found, strict=True):
                    base = base_spans(t)
                    spans = all_spans(base, more)
                    for i, kind in enumerate(KINDS[:4]):
                        cols[i].append(sum(s[0] == kind for s in base))
                    cols[4].append(hashlib.sha256(",".join(f"{k}:{a}:{b}" for k, a, b in base).encode()).hexdigest())
                    cols[5].append(",".join(f"{k}:{a}:{b}" for k, a, b in spans))
                    cols[6].append(None if given is None else redact(t, spans) if redacted else None)
                arrays = [batch.column(c).slice(lo, hi - lo) for c in rest] + [pa.array(c, pa.int64()) for c in cols[:4]] + [pa.array(c, pa.string()) for c in cols[4 : 6 + redacted]]
                yield pa.RecordBatch.from_arrays(arrays, schema.names)

    return docs.select(*rest, text).mapInArrow(run, schema)


def op7_pii(spark: SparkSession, sf_dir: str) -> DataFrame:
    return scan(table(spark, sf_dir, "documents").select("doc_id", "text"))

"""Operators over pairs of documents or vectors, against brute force, and the pipeline."""

import hashlib
import os
import random
import re
from collections import Counter

import numpy as np
import pytest
import xxhash
from pyspark.sql import functions as F

os.environ.setdefault("TOKENIZERS_PARALLELISM", "false")

import corpus_pipeline  # noqa: E402
from folioflow.llm import components, repeats, simhash, suffix, vectors  # noqa: E402
from folioflow.llm.hashing import xxh64_spans  # noqa: E402


def _roots(nodes, pairs):
    parent = {n: n for n in nodes}

    def find(x):
        while parent[x] != x:
            x = parent[x]
        return x

    for a, b in pairs:
        a, b = find(a), find(b)
        parent[max(a, b)] = min(a, b)
    return {n: find(n) for n in nodes}


def test_hash_of_spans():
    data = np.random.default_rng(0).integers(0, 256, 4000).astype(np.uint8)
    start = np.arange(0, 3000, 7)
    length = np.arange(len(start)) % 140
    got = xxh64_spans(data, start, length, 42)
    assert got.tolist() == [xxhash.xxh64_intdigest(data[s : s + n].tobytes(), 42) for s, n in zip(start, length, strict=True)]


def test_components(spark):
    random.seed(4)
    edges = [(random.randint(0, 300), random.randint(0, 300)) for _ in range(160)] + [(i, i + 1) for i in range(1000, 1060)] + [(5, 5)]
    got = {r.node: r.root for r in components.connected_components(spark.createDataFrame(edges, "a long, b long")).collect()}
    nodes = {x for e in edges if e[0] != e[1] for x in e}
    assert got == _roots(nodes, [e for e in edges if e[0] != e[1]])
    assert components.connected_components(spark.createDataFrame([], "a long, b long")).count() == 0


def _fingerprint(t):
    t = "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in t or "")
    w = re.findall(r"[^\x20\x09-\x0D]+", t)
    shingles = [" ".join(w[i : i + 3]) for i in range(max(1, len(w) - 2))] if w else []
    h = [xxhash.xxh64_intdigest(s.encode(), 42) for s in shingles]
    return sum(1 << k for k in range(64) if 2 * sum(x >> k & 1 for x in h) > len(h))


def test_simhash_components(spark, odd_docs, no_docs):
    random.seed(6)
    base = [" ".join(random.choice("abcdefgh") + str(random.randint(0, 50)) for _ in range(400)) for _ in range(12)]
    rows = []
    for i, b in enumerate(base * 4):
        w = b.split()
        for _ in range(i // 12):
            w[random.randrange(len(w))] = "new"
        rows.append((i, " ".join(w)))
    docs = odd_docs.select("doc_id", "text").unionByName(spark.createDataFrame([(100 + i, t) for i, t in rows], "doc_id long, text string"))
    all_rows = docs.collect()
    fp = [_fingerprint(r.text) for r in all_rows]
    links = [(i, j) for i in range(len(fp)) for j in range(i) if bin(fp[i] ^ fp[j]).count("1") <= 3]
    root = _roots(range(len(fp)), links)
    least = {}
    for i, r in enumerate(all_rows):
        if r.doc_id is not None:
            least[root[i]] = min(least.get(root[i], r.doc_id), r.doc_id)
    want = Counter((r.doc_id, f"{fp[i]:016x}", least.get(root[i])) for i, r in enumerate(all_rows))
    assert Counter(tuple(r) for r in simhash.simhash_components(docs).collect()) == want
    assert len(links) > 20 and simhash.simhash_components(no_docs).count() == 0


def _check_repeats(docs):
    all_rows = [(r.doc_id, (r.text or "").encode()) for r in docs.collect()]
    seen = Counter(b[i : i + 200] for _, b in all_rows for i in range(len(b) - 199))
    want = Counter()
    for d, b in all_rows:
        gone = bytearray(len(b))
        for i in range(len(b) - 199):
            if seen[b[i : i + 200]] > 1:
                gone[i : i + 200] = b"\x01" * 200
        kept = bytes(x for x, y in zip(b, gone, strict=True) if not y)
        want[d, len(b), sum(gone), len([1 for i, y in enumerate(gone) if y and (i == 0 or not gone[i - 1])]), hashlib.sha256(kept).hexdigest()] += 1
    assert Counter(tuple(r) for r in repeats.remove_repeats(docs).collect()) == want


def test_suffix_sort_finds_repeats(tmp_path):
    random.seed(3)
    for trial in range(25):
        depth, k = random.choice([8, 24, 200]), random.choice([2, 3, 26])
        letters = b"abcdefghijklmnopqrstuvwxyz"[:k]
        base = bytes(random.choice(letters) for _ in range(600))
        segments = [base[a : a + random.randint(0, 300)] if random.random() < 0.5 else b"a" * random.randint(0, 500) if random.random() < 0.3 else bytes(random.choice(letters) for _ in range(random.randint(0, 300))) for a in (random.randint(0, 300) for _ in range(12))]
        w = suffix.Writer(str(tmp_path / "t"), depth)
        at = [w.add(s) for s in segments]
        w.close()
        found = suffix.repeated_starts(str(tmp_path / "t"), depth, random.choice([3, 50, 1 << 20]))
        seen = Counter(s[i : i + depth] for s in segments for i in range(len(s) - depth + 1))
        for a, s in zip(at, segments, strict=True):
            assert found[a : a + max(0, len(s) - depth + 1)].tolist() == [seen[s[i : i + depth]] > 1 for i in range(len(s) - depth + 1)], trial


def test_suffix_sort_of_a_shard_larger_than_memory(tmp_path):
    """In a process that may not allocate as much as one copy of what the sort would need in memory, mapped files aside."""
    import subprocess
    import sys

    code = """
import random, sys, tracemalloc
import numpy as np
from folioflow.llm import suffix
suffix.BLOCK = 1 << 13
rng = np.random.default_rng(1)
w = suffix.Writer(sys.argv[1] + "/t", 200)
base = rng.integers(97, 123, 3000).astype(np.uint8)
n = 0
for i in range(400):
    a = int(rng.integers(0, 2000))
    s = base[a : a + 600] if i % 4 == 0 else rng.integers(97, 99, 4000).astype(np.uint8) if i % 4 == 1 else rng.integers(97, 123, 4000).astype(np.uint8)
    n += len(s)
    w.add(s.tobytes())
w.close()
tracemalloc.start()
found = suffix.repeated_starts(sys.argv[1] + "/t", 200, 1 << 13)
print(n, tracemalloc.get_traced_memory()[1], int(found.sum()))
"""
    got = subprocess.run([sys.executable, "-c", code, str(tmp_path)], capture_output=True, text=True, cwd=os.path.dirname(corpus_pipeline.__file__))
    size, peak, found = map(int, got.stdout.split())
    assert size > 1_200_000 and found > 30_000 and peak < size, got.stderr


def test_repeats_of_shared_passages_and_periods(spark, monkeypatch):
    monkeypatch.setattr(repeats, "HOT_DOCS", 3)
    random.seed(21)
    words = lambda n: " ".join(random.choice(["the", "house", "x1", "water,"]) + str(random.randint(0, 999)) for _ in range(n))
    passage, period = words(70), words(9)
    rows = [(i, words(30) + passage[random.randint(0, 30) :] + words(30)) for i in range(30)] + [(100 + i, words(20) + period * (8 + i) + words(10)) for i in range(4)] + [(200, words(40) + period * 3 + words(40)), (201, "ab" * 5000), (202, words(50) * 2)]
    _check_repeats(spark.createDataFrame(rows, "doc_id long, text string"))


def test_repeats(spark, odd_docs, no_docs):
    random.seed(9)
    words = lambda n: " ".join(random.choice(["the", "house", "été", "x1", "water,"]) + str(random.randint(0, 99)) for _ in range(n))
    shared = [words(60) for _ in range(3)]
    rows = [(100 + i, words(random.randint(5, 60)) + random.choice(shared)[random.randint(0, 50) :] + words(20)) for i in range(25)] + [(200, "a" * 700), (201, "b" * 199), (202, "ab" * 260)]
    docs = odd_docs.select("doc_id", "text").unionByName(spark.createDataFrame(rows, "doc_id long, text string"))
    _check_repeats(docs)
    assert repeats.remove_repeats(no_docs).count() == 0


def test_vectors(spark):
    rng = np.random.default_rng(2)
    x = rng.normal(size=(900, 16))
    for i in range(300):
        x[600 + i] = x[i % 40] + 0.25 * rng.normal(size=16)
    rows = [(i, [float(v) for v in r]) for i, r in enumerate(x.astype(np.float32))]
    rows += [(1000, rows[3][1]), (1001, rows[3][1]), (1002, [0.0] * 16), (1003, None), (1004, [float("nan")] * 16), (1005, [1.0, None] * 8), (1006, []), (1007, [1.0] * 15), (1008, [3.0] * 15), (3, rows[3][1])]
    got = vectors.near_vectors(spark.createDataFrame(rows, "vec_id long, embedding array<float>"))
    good = [(i, np.array(v, np.float64) / np.linalg.norm(np.array(v, np.float64))) for i, v in rows if v and None not in v and np.isfinite(v).all() and np.any(v)]
    links, pairs = Counter(), []
    for a in range(len(good)):
        for b in range(len(good)):
            if a != b and len(good[a][1]) == len(good[b][1]) and good[a][1] @ good[b][1] >= 0.9:
                links[a] += 1
                pairs.append((a, b))
    root = _roots(range(len(good)), pairs)
    least = {}
    for k, (i, _) in enumerate(good):
        least[root[k]] = min(least.get(root[k], i), i)
    found = got.collect()
    assert len(found) == len(rows)
    want = Counter((good[k][0], links[k], least[root[k]]) for k in range(len(good)))
    mine = Counter((r.vec_id, r.n_links, r.component_id) for r in found if r.vec_id not in (1002, 1003, 1004, 1005, 1006))
    assert sum((want & mine).values()) >= 0.97 * sum(want.values())
    assert all(r.n_links == 0 and r.kept for r in found if r.vec_id in (1002, 1003, 1004, 1005, 1006))
    assert vectors.recall(got) >= 0.9
    assert vectors.near_vectors(spark.createDataFrame([], "vec_id long, embedding array<float>")).count() == 0


def test_vectors_over_hundreds_of_shards(spark, monkeypatch):
    monkeypatch.setattr(vectors, "SHARD", 5)  # 320 centres, as in large tables fitted on few of the vectors
    monkeypatch.setattr(vectors, "SAMPLE", 400)
    monkeypatch.setattr(vectors, "AUDIT", 16)  # several blocks
    rng = np.random.default_rng(5)
    q = vectors.unit(rng.normal(size=(800, 64)))
    w = rng.normal(size=q.shape)
    w = vectors.unit(w - (w * q).sum(1, keepdims=True) * q)
    x = np.concatenate([q, 0.901 * q + (1 - 0.901**2) ** 0.5 * w])
    got = vectors.near_vectors(spark.createDataFrame([(i, v.tolist()) for i, v in enumerate(x)], "vec_id long, embedding array<double>")).collect()
    want = (vectors.unit(x) @ vectors.unit(x).T >= 0.9).sum(1) - 1
    assert len(got) == 1600 and all(r.n_links <= want[r.vec_id] for r in got)
    assert sum(r.n_links for r in got) >= 0.95 * want.sum() > 1200
    assert {r.vec_id: r.audit_links for r in got if r.audit_links is not None} == {i: want[i] for i in range(0, 1600, 50)}


def test_vectors_cut_large_shards_around_pivots(spark, monkeypatch):
    for name, value in (("SHARD", 20), ("MOST_CENTRES", 6), ("BLOCK", 60), ("SALT_ROWS", 90), ("SAMPLE", 500)):
        monkeypatch.setattr(vectors, name, value)
    rng = np.random.default_rng(7)
    centres = vectors.unit(rng.normal(size=(60, 32)))
    x = np.concatenate([centres[i % 60][None] + rng.uniform(0.03, 0.09) * rng.normal(size=(1, 32)) for i in range(1400)])
    x[:300] = centres[0] + 0.02 * rng.normal(size=(300, 32))  # one dense group in one shard
    docs = spark.createDataFrame([(i, v.tolist(), 1, 2) for i, v in enumerate(x)], "vec_id long, embedding array<double>, key int, shard int")
    got = vectors.near_vectors(docs).collect()
    u = vectors.unit(x)
    near = u @ u.T >= 0.9
    want = near.sum(1) - 1
    assert len(got) == 1400 and all(r.n_links <= want[r.vec_id] for r in got)
    assert sum(r.n_links for r in got) >= 0.97 * want.sum() > 100_000
    root = _roots(range(1400), zip(*np.nonzero(near), strict=True))
    assert sum(r.component_id == root[r.vec_id] for r in got) >= 0.97 * 1400
    members = Counter(r.component_id for r in got)
    assert all((r.n_links > 0) == (members[r.component_id] > 1) for r in got)


def test_vectors_near_the_limit_and_odd_rows(spark):
    one = [1.0, 0.0, 0.0]
    at = lambda c: [c, (1 - c * c) ** 0.5, 0.0]
    rows = [(0, one), (1, at(0.9000001)), (2, at(0.8999999)), (None, one), (None, [0.0, 0.0, 1.0]), (5, [1e300, 0.0, 0.0]), (6, [1e-300, 0.0, 1e-320]), (7, [float("inf"), 1.0, 0.0])]
    got = Counter((r.vec_id, r.n_links, r.component_id, r.kept) for r in vectors.near_vectors(spark.createDataFrame(rows, "vec_id long, embedding array<double>")).collect())
    one_of = [(0, 4), (5, 4), (6, 4), (None, 4)]
    assert all(got[i, 4, 0, i == 0] == 1 for i, _ in one_of)
    assert got[1, 5, 0, False] == 1 and got[2, 1, 0, False] == 1 and got[None, 0, None, True] == 1 and got[7, 0, 7, True] == 1


def test_pipeline_stages(spark, odd_docs, no_docs):
    """Every stage takes rows of any kind: all columns but what it changes come back, row by row."""
    plain = lambda rows, drop=(): Counter(tuple(v for k, v in r.asDict().items() if k not in drop) for r in rows)
    given = odd_docs.collect()
    for name, stage in corpus_pipeline.STAGES:
        out = stage(spark, no_docs, "")
        assert out.count() == 0 and (name == "bpe" or out.columns == no_docs.columns), name
    quality = corpus_pipeline.quality_rules(spark, odd_docs, "").collect()
    assert not quality  # all have fewer than 50 words or repeat themselves
    own = odd_docs.select(*odd_docs.columns).withColumn("text", F.when(F.col("doc_id") == 4, F.lit(" ".join(f"v{k}" for k in range(5000)))).otherwise(F.col("text")))
    assert plain(corpus_pipeline.quality_rules(spark, own, "").collect()) == plain(own.where("doc_id = 4").collect())
    near = corpus_pipeline.near_dedup(spark, odd_docs, "").collect()
    # the copy of 1 goes, and of the texts without words (2, 3, 6) the one with the smallest id stays
    assert plain(near) == plain([r for i, r in enumerate(given) if i not in (1, 3, 8)])
    private = corpus_pipeline.personal_data(spark, odd_docs, "").collect()
    assert plain(private, ("text", "n_chars")) == plain(given, ("text", "n_chars")) and sum("<email>" in (r.text or "") for r in private) == 2
    mixed = corpus_pipeline.mixing(spark, odd_docs, "").collect()
    assert set(plain(mixed)) <= set(plain(given)) and max(plain(mixed).values()) <= 6
    coded = corpus_pipeline.tokens(spark, odd_docs, "").collect()
    assert Counter(r.doc_id for r in coded) == Counter(r.doc_id for r in given) and all(r.exact for r in coded)


def test_rows_that_differ_in_any_column_are_different(spark):
    rows = [(1, "same text", "en", None, 5), (1, "same text", None, "en", 5), (1, "same text", "en", None, 6), (1, "same text", "en", None, 5)]
    keyed, key = corpus_pipeline._keyed(spark.createDataFrame(rows, "doc_id long, text string, lang string, source string, n_chars long"))
    got = [r[key] for r in keyed.collect()]
    assert got[0] == got[3] and len(set(got)) == 3 and all(len(k) == 32 for k in got)


def test_pipeline_decisions(spark):
    random.seed(8)
    words = lambda n: " ".join(random.choice("abcdefghij") + str(random.randint(0, 400)) for _ in range(n))
    text = words(200)
    rows = [(1, text), (2, text), (3, text.replace(text.split()[50], "changed")), (4, words(200) + " mail x.y@example.com"), (5, words(10)), (6, "same words here " * 50)] + [(10 + i, words(150)) for i in range(10)]
    docs = spark.createDataFrame([(i, t, "en", f"s{i % 3}", len(t)) for i, t in rows], "doc_id long, text string, lang string, source string, n_chars long")
    q = corpus_pipeline.quality_rules(spark, docs, "")
    assert {r.doc_id for r in q.collect()} == {i for i, _ in rows} - {5, 6}
    n = corpus_pipeline.near_dedup(spark, q, "")
    fp = {i: _fingerprint(t) for i, t in rows}
    gone = {2} | ({3} if bin(fp[1] ^ fp[3]).count("1") <= 3 else set())
    assert {r.doc_id for r in n.collect()} == {r.doc_id for r in q.collect()} - gone
    p = corpus_pipeline.personal_data(spark, n, "")
    kept = {r.doc_id: r for r in p.collect()}
    assert kept[4].text.endswith("mail <email>") and kept[4].n_chars == len(kept[4].text)
    m = corpus_pipeline.mixing(spark, p, "")
    assert 0 < m.count() and {r.doc_id for r in m.collect()} <= set(kept)
    t = corpus_pipeline.tokens(spark, m, "")
    assert all(r.exact and r.n_tokens == len(r.ids.split(",")) for r in t.collect())


def test_near_dedup_keeps_one_where_ids_are_null_or_shared(spark):
    random.seed(12)
    a, b, c = (" ".join(random.choice("abcdefghij") + str(random.randint(0, 400)) for _ in range(200)) for _ in range(3))
    rows = [(None, a, "s"), (None, a, "t"), (7, b, "s"), (7, b, "t"), (None, b, "u"), (7, c, "s")]
    docs = spark.createDataFrame([(i, t, "en", s, len(t)) for i, t, s in rows], "doc_id long, text string, lang string, source string, n_chars long")
    got = corpus_pipeline.near_dedup(spark, docs, "").collect()
    assert Counter((r.doc_id, r.text) for r in got) == {(None, a): 1, (7, b): 1, (7, c): 1}


@pytest.mark.parametrize("name", ["op2_quality", "op6_licenses"])
def test_queries_agree_with_their_sql(spark, name):
    import duckdb

    from folioflow.llm.queries import ORACLE_SQL, QUERIES

    c = duckdb.connect()
    c.execute("create view documents as select * from '/root/testdata/sf0.001/documents.parquet'")
    r = c.execute(ORACLE_SQL[name])
    names = [x[0] for x in r.description]
    got = QUERIES[name](spark, "/root/testdata/sf0.001").select(names).collect()
    assert Counter(map(tuple, got)) == Counter(map(tuple, r.fetchall()))

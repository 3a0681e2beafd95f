"""Near-duplicate vectors by a robust-pruned flat graph over overlapping cluster shards.

Vectors are put into the shards of their nearest centres, with overlap. Centres are fitted on a bounded sample and are so
at most a fixed number; a shard that grows too large is cut again around pivots, members of its own, whose number grows
with it. In every shard a graph is built: each vector is linked to its near neighbours, thinned by the robust-pruning
rule, and linked back. The neighbour lists that a vector got in its shards are united. A search starts from the medoids
of a shard (and from the vector itself where the shard holds it), walks greedily to the best it can find, and from every
vector in range goes on along the graph until nothing new is in range. Pairs are checked in double precision.

A pair is counted in the shard that is the second one's home, and for both of its vectors there if the second one is not
searched for in the first one's home, so nothing is counted twice and no list of pairs is made. Within one home a pair that
either search meets counts for both. For components each shard sends one link per vector, and a vector that only others
have met counts one link.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .common import staged, table
from .components import connected_components

COSINE = 0.9
#: Mean home size of a shard, and the most centres (they travel with the tasks: at most 4096 vectors).
SHARD = 500
MOST_CENTRES = 4096
#: Centres are fitted on at most so many vectors, chosen by hash.
SAMPLE = 20_000
OVERLAP = 3  # shards that hold a vector
PROBES = 6  # shards that are searched for a vector at least
#: Share of pairs at the limit of which one vector is searched for in the other's home; the probes are chosen for it.
ROUTED = 0.99
TRIALS = 2000
DEGREE = 24
CANDIDATES = 64
ALPHA = 1.2
#: A shard with more members than this is cut around pivots, one for SHARD of its vectors, each held by CELLS of them.
BLOCK = 4000
CELLS = 2
#: Rows of one shard that are compared with its pivots, or searched for in it, in one task.
SALT_ROWS = 20_000
BEAM = 10
MEDOIDS = 32
AUDIT = 4096  # audited vectors that are compared in one pass


def unit(v: np.ndarray) -> np.ndarray:
    v = v.astype(np.float64)
    return v / np.linalg.norm(v, axis=1, keepdims=True)


def _matrix(blobs, dims: int) -> np.ndarray:
    return np.frombuffer(b"".join(blobs), "<f8").reshape(-1, dims)


def fit_centres(x: np.ndarray, k: int, seed: int = 11, rounds: int = 8) -> np.ndarray:
    """Spherical k-means; an empty centre is put on the vector worst served."""
    rng = np.random.default_rng(seed)
    c = x[rng.choice(len(x), min(k, len(x)), replace=False)].copy()
    for _ in range(rounds):
        near, best = np.empty(len(x), np.int64), np.empty(len(x))
        for lo in range(0, len(x), 4096):
            s = x[lo : lo + 4096] @ c.T
            near[lo : lo + 4096], best[lo : lo + 4096] = s.argmax(1), s.max(1)
        sums = np.zeros_like(c)
        np.add.at(sums, near, x)
        size = np.bincount(near, minlength=len(c))
        bad = np.flatnonzero((size == 0) | (np.linalg.norm(sums, axis=1) < 1e-9))
        sums[bad] = x[np.argsort(best)[: len(bad)]]
        c = sums / np.linalg.norm(sums, axis=1, keepdims=True)
    return c


def probe_gap(x: np.ndarray, centres: np.ndarray, cosine: float, seed: int = 13) -> float:
    """How far below its nearest centre's cosine a vector's other centres are still to be searched.

    Partners at exactly `cosine` are made for vectors of x, in any direction and towards other vectors of x. The gap is the
    least by which ROUTED of either kind meet: one of the two is searched for in the other's home.
    """
    if len(centres) < 2:
        return 0.0
    rng = np.random.default_rng(seed)
    q = x[rng.choice(len(x), min(TRIALS, len(x)), replace=False)]
    gaps = []
    for way in (rng.normal(size=q.shape), x[rng.choice(len(x), len(q))]):
        way = way - (way * q).sum(1, keepdims=True) * q
        u = unit(cosine * q + (1 - cosine**2) ** 0.5 * way / np.maximum(np.linalg.norm(way, axis=1, keepdims=True), 1e-9))
        need = np.empty(len(q))
        for lo in range(0, len(q), 1024):
            a, b = q[lo : lo + 1024] @ centres.T, u[lo : lo + 1024] @ centres.T
            rows = np.arange(len(a))
            need[lo : lo + 1024] = np.minimum(a.max(1) - a[rows, b.argmax(1)], b.max(1) - b[rows, a.argmax(1)])
        gaps.append(np.quantile(need, ROUTED, method="higher"))
    return float(max(gaps))


def robust_graph(x: np.ndarray, degree: int = DEGREE, alpha: float = ALPHA) -> list[np.ndarray]:
    """Neighbour lists over the rows of x (unit vectors, float32).

    From each vector's nearest candidates the nearest is kept, and those that are closer to it by the factor alpha than
    to the vector itself fall out, and so on; links are made both ways and lists that grow too long are pruned by the same
    rule again. Vectors that the first one does not reach are linked to their nearest that it does.
    """
    n = len(x)
    m = min(CANDIDATES, n - 1)
    if m < 1:
        return [np.zeros(0, np.int64)] * n
    cand, sim = np.empty((n, m), np.int64), np.empty((n, m), np.float32)
    for lo in range(0, n, 1024):
        s = x[lo : lo + 1024] @ x.T
        s[np.arange(len(s)), np.arange(lo, lo + len(s))] = -2
        part = np.argpartition(-s, m - 1, axis=1)[:, :m] if m < n - 1 else np.argsort(-s, axis=1)[:, :m]
        got = np.take_along_axis(s, part, 1)
        order = np.argsort(-got, axis=1, kind="stable")
        cand[lo : lo + 1024], sim[lo : lo + 1024] = np.take_along_axis(part, order, 1), np.take_along_axis(got, order, 1)
    keep = np.zeros((n, m), bool)
    for lo in range(0, n, 256):
        ids = cand[lo : lo + 256]
        between = np.einsum("bid,bjd->bij", x[ids], x[ids], optimize=True)
        away = np.sqrt(np.maximum(0, 2 - 2 * sim[lo : lo + 256]))
        apart = np.sqrt(np.maximum(0, 2 - 2 * between))
        live = np.ones(ids.shape, bool)
        rows = np.arange(len(ids))
        for _ in range(degree):
            first = live.argmax(1)
            some = live[rows, first]
            if not some.any():
                break
            keep[lo : lo + 256][rows[some], first[some]] = True
            live &= ~((alpha * apart[rows, first] <= away) & some[:, None])
            live[rows, first] = False
    a, b = np.nonzero(keep)[0], cand[keep]
    u, v = np.concatenate([a, b]), np.concatenate([b, a])
    u, v = np.unique(np.stack([u, v], 1), axis=0).T
    s = np.einsum("id,id->i", x[u], x[v])
    order = np.lexsort((-s, u))
    u, v = u[order], v[order]
    start = np.searchsorted(u, np.arange(n + 1))
    lists = [v[start[i] : start[i + 1]] for i in range(n)]
    for i in np.flatnonzero(np.diff(start) > 2 * degree).tolist():
        lists[i] = _pruned(x, i, lists[i], 2 * degree, alpha)
    seen = np.zeros(n, bool)
    todo = np.array([0])
    while True:
        seen[todo] = True
        while len(todo):
            todo = np.unique(np.concatenate([lists[i] for i in todo]))
            todo = todo[~seen[todo]]
            seen[todo] = True
        if not len(rest := np.flatnonzero(~seen)):
            return lists
        reach = np.flatnonzero(seen)
        pick = rest[:1]
        to = reach[(x[reach] @ x[pick[0]]).argmax()]
        lists[to], lists[pick[0]] = np.append(lists[to], pick[0]), np.append(lists[pick[0]], to)
        todo = pick


def _pruned(x: np.ndarray, i: int, near: np.ndarray, degree: int, alpha: float) -> np.ndarray:
    """At most `degree` of the neighbours of i, given nearest first, by the robust rule."""
    away = np.sqrt(np.maximum(0, 2 - 2 * (x[near] @ x[i])))
    covers = alpha * np.sqrt(np.maximum(0, 2 - 2 * (x[near] @ x[near].T))) <= away
    kept, live = [], np.ones(len(near), bool)
    while live.any() and len(kept) < degree:
        first = int(live.argmax())
        kept.append(first)
        live &= ~covers[first]
        live[first] = False
    return near[kept]


def medoids(x: np.ndarray, k: int = MEDOIDS) -> np.ndarray:
    """The vector nearest to the middle, then one after the other the vector farthest from those taken."""
    out = [int((x @ x.mean(0)).argmax())]
    near = x @ x[out[0]]
    for _ in range(min(k, len(x)) - 1):
        out.append(int(near.argmin()))
        near = np.maximum(near, x @ x[out[-1]])
    return np.unique(out)


def range_search(x: np.ndarray, lists: np.ndarray, entry: np.ndarray, q: np.ndarray, own: np.ndarray, cosine: float) -> tuple[np.ndarray, np.ndarray]:
    """(query, row of x) pairs in range that the graph leads to. lists: rows of neighbours, filled up with the row itself; own: the
    query's row in x or -1."""
    b, n = len(q), len(x)
    seen = np.zeros((b, n), bool)
    rows = np.arange(b)
    ids = np.concatenate([np.broadcast_to(entry, (b, len(entry))), np.where(own < 0, entry[0], own)[:, None]], 1)
    sims = np.einsum("brd,bd->br", x[ids], q)
    seen[rows[:, None], ids] = True
    sims[:, -1][own < 0] = -3
    found_q, found_u = [rows[own >= 0]], [own[own >= 0]]
    top = np.argsort(-sims, 1)[:, :BEAM]
    ids, sims = np.take_along_axis(ids, top, 1), np.take_along_axis(sims, top, 1)
    done = sims < -2
    for _ in range(2 * BEAM):
        score = np.where(done, -4, sims)
        at = score.argmax(1)
        live = np.flatnonzero(score[rows, at] > -3)
        if not len(live):
            break
        cur = ids[live, at[live]]
        done[live, at[live]] = True
        new = lists[cur]
        s = np.einsum("brd,bd->br", x[new], q[live])
        s[seen[live[:, None], new]] = -3
        seen[live[:, None], new] = True
        i, s2, d = np.concatenate([ids[live], new], 1), np.concatenate([sims[live], s], 1), np.concatenate([done[live], s < -2], 1)
        top = np.argpartition(-s2, BEAM - 1, 1)[:, :BEAM] if s2.shape[1] > BEAM else np.broadcast_to(np.arange(s2.shape[1]), s2.shape)
        if top.shape[1] > ids.shape[1]:
            more = top.shape[1] - ids.shape[1]
            ids, sims, done = np.pad(ids, ((0, 0), (0, more))), np.pad(sims, ((0, 0), (0, more)), constant_values=-3.0), np.pad(done, ((0, 0), (0, more)), constant_values=True)
        ids[live], sims[live], done[live] = np.take_along_axis(i, top, 1), np.take_along_axis(s2, top, 1), np.take_along_axis(d, top, 1)
    low = cosine - 0.03
    fq, at = np.nonzero(sims >= low)
    fu = ids[fq, at]
    fq, fu = np.concatenate([fq, found_q[0]]), np.concatenate([fu, found_u[0]])
    key = np.unique(fq * n + fu)
    got = np.zeros((b, n), bool)
    while len(key):
        fq, fu = key // n, key % n
        got[fq, fu] = True
        nq, nu = np.repeat(fq, lists.shape[1]), lists[fu].ravel()
        key = np.unique(nq * n + nu)
        fq, fu = key // n, key % n
        new = ~got[fq, fu]
        key, fq, fu = key[new], fq[new], fu[new]
        keep = np.zeros(len(key), bool)
        for lo in range(0, len(key), 1 << 16):
            keep[lo : lo + (1 << 16)] = np.einsum("id,id->i", x[fu[lo : lo + (1 << 16)]], q[fq[lo : lo + (1 << 16)]]) >= low
        key = key[keep]
    return np.nonzero(got)


def _find(parent: np.ndarray, pairs_a: np.ndarray, pairs_b: np.ndarray) -> np.ndarray:
    """Smallest label reachable over the pairs, by sweeps of minima and pointer jumps."""
    while True:
        low = parent.copy()
        np.minimum.at(low, pairs_a, parent[pairs_b])
        np.minimum.at(low, pairs_b, parent[pairs_a])
        low = low[low]
        if (low == parent).all():
            return parent
        parent = low


def _build(dims: int):
    def run(pdf: pd.DataFrame) -> pd.DataFrame:
        pdf = pdf.sort_values("key", ignore_index=True)
        key = pdf["key"].to_numpy()
        lists = robust_graph(_matrix(pdf["vec"], dims).astype(np.float32))
        return pd.DataFrame({"key": key, "near": [key[n] for n in lists]})

    return run


def _search(dims: int, cosine: float):
    def run(pdf: pd.DataFrame) -> pd.DataFrame:
        pdf = pdf.sort_values("key", ignore_index=True)
        inside = pdf[pdf["member"]]
        if not len(inside):
            return pd.DataFrame({"key": [], "links": [], "root": []}).astype("int64")
        key, home, copies = inside["key"].to_numpy(), inside["home"].to_numpy(bool), inside["copies"].to_numpy()
        x = _matrix(inside["vec"], dims)
        x32 = x.astype(np.float32)
        place = {k: i for i, k in enumerate(key.tolist())}
        own_lists = [[place[v] for v in n if v in place] if n is not None else [] for n in (list(n) if n is not None else None for n in inside["near"])]
        width = max(1, max(map(len, own_lists)))
        lists = np.array([n + [i] * (width - len(n)) for i, n in enumerate(own_lists)])
        entry = medoids(x32)
        qkey, q = pdf["key"].to_numpy(), _matrix(pdf["vec"], dims)
        own = np.array([place.get(k, -1) for k in qkey.tolist()])
        asking = np.flatnonzero((pdf["salt"].to_numpy() == 0) | ~pdf["member"].to_numpy(bool))
        block = max(16, min(512, (1 << 22) // len(x)))
        out_k, out_n, edges_a, edges_b, inner = [], [], [], [], []
        at = np.searchsorted(qkey, key)
        shard, q_home, q_copies = pdf["shard"].iloc[0], np.array([p[0] for p in pdf["probes"]]), pdf["copies"].to_numpy()
        probes = np.full((len(key), max(map(len, inside["probes"]))), -1, np.int64)
        for i, p in enumerate(inside["probes"]):
            probes[i, : len(p)] = p
        for lo in range(0, len(asking), block):
            some = asking[lo : lo + block]
            a, u = range_search(x32, lists, entry, q[some].astype(np.float32), own[some], cosine)
            a = some[a]
            ok = home[u] & (own[a] != u)
            a, u = a[ok], u[ok]
            for p in range(0, len(a), 1 << 16):
                s = slice(p, p + (1 << 16))
                good = np.einsum("id,id->i", q[a[s]], x[u[s]]) >= cosine
                one, other = a[s][good], u[s][good]
                edges_a.append(one)
                edges_b.append(at[other])
                away = q_home[one] != shard
                # both at home here: whichever search has met the pair, it counts for both
                pair = np.sort(np.stack([one[~away], at[other[~away]]], 1), 1)
                inner.append(pair[:, 0] * len(q) + pair[:, 1])
                one, other = one[away], other[away]
                out_k.append(one)
                out_n.append(copies[other])
                unseen = (probes[other] != q_home[one][:, None]).all(1)
                out_k.append(at[other[unseen]])
                out_n.append(q_copies[one[unseen]])
            if len(inner) > 64:
                inner = [np.unique(np.concatenate(inner))]
        if inner:
            one, other = np.divmod(np.unique(np.concatenate(inner)), len(q))
            out_k += [one, other]
            out_n += [q_copies[other], q_copies[one]]
        a, b = (np.concatenate(e) if e else np.zeros(0, np.int64) for e in (edges_a, edges_b))
        links = np.bincount(np.concatenate(out_k), weights=np.concatenate(out_n), minlength=len(q)).astype(np.int64) if out_k else np.zeros(len(q), np.int64)
        root = _find(np.arange(len(q)), a, b)
        some = np.flatnonzero((links > 0) | (root != np.arange(len(q))))
        return pd.DataFrame({"key": qkey[some], "links": links[some], "root": qkey[root[some]]})

    return run


def _prepared(df: DataFrame) -> DataFrame:
    """vec_id, key (hash of the vector), dims, vec (unit vector, doubles); vec is null where nothing can link."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            col = batch.column("embedding")
            flat = col.flatten()
            v = flat.fill_null(np.nan).to_numpy(zero_copy_only=False).astype(np.float64)
            size = np.diff(col.offsets.to_numpy()) * col.is_valid().to_numpy(zero_copy_only=False)
            off = np.concatenate([[0], np.cumsum(size)])
            some = np.flatnonzero(size)
            # scaled by the largest component first, so that no square overflows
            top = np.ones(len(col))
            top[some] = np.maximum.reduceat(np.abs(v), off[some]) if len(some) else 1.0
            good = np.isfinite(top) & (top > 0) & (size > 0)
            with np.errstate(all="ignore"):
                u = v / np.repeat(top, size)
                norm = np.ones(len(col))
                norm[some] = np.sqrt(np.add.reduceat(u * u, off[some])) if len(some) else 1.0
                data = (u / np.repeat(norm, size)).astype("<f8").tobytes()
            vec = [data[8 * a : 8 * b] if g else None for a, b, g in zip(off[:-1].tolist(), off[1:].tolist(), good.tolist(), strict=True)]
            yield pa.RecordBatch.from_arrays([batch.column("vec_id"), pa.array(np.where(good, size, 0), pa.int32()), pa.array(vec, pa.binary())], ["vec_id", "dims", "vec"])

    d = df.select("vec_id", F.col("embedding").cast("array<double>").alias("embedding"))
    d = d.mapInArrow(run, d.select("vec_id").schema.add("dims", "integer").add("vec", "binary"))
    return d.withColumn("key", F.when(F.col("vec").isNotNull(), F.xxhash64("vec")))


def _shards(reps: DataFrame, dims: int, centres: np.ndarray, gap: float) -> DataFrame:
    """(key, vec, copies, shard, home, member, probes): the shards of each vector; probes has them all, nearest first."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        least = min(max(PROBES, OVERLAP), len(centres))
        for whole in batches:
            for lo in range(0, len(whole), 1024):
                batch = whole.slice(lo, 1024)
                sims = _matrix(batch.column("vec").to_pylist(), dims) @ centres.T
                order = np.argsort(-sims, axis=1, kind="stable")
                count = np.maximum(least, (sims >= sims.max(1, keepdims=True) - gap).sum(1))
                take = np.repeat(np.arange(len(sims)), count)
                rank = np.arange(len(take)) - np.repeat(np.cumsum(count) - count, count)
                cols = [batch.column(c).take(pa.array(take)) for c in ("key", "vec", "copies")]
                shard = order[take, rank].astype(np.int32)
                probes = pa.array(np.split(shard, np.cumsum(count)[:-1]), pa.list_(pa.int32())).take(pa.array(take))
                yield pa.RecordBatch.from_arrays([*cols, pa.array(shard), pa.array(rank == 0), pa.array(rank < OVERLAP), probes], ["key", "vec", "copies", "shard", "home", "member", "probes"])

    return reps.select("key", "vec", "copies").mapInArrow(run, "key long, vec binary, copies long, shard int, home boolean, member boolean, probes array<int>")


def _cells(d: DataFrame, dims: int, gap: float) -> DataFrame:
    """As `_shards`, with `shard` and `probes` as longs; shards of more than BLOCK members are cut around their pivots.

    Pivots are members by hash, one for SHARD vectors at home. The rows of a large shard are dealt into salts, and each
    salt reads the pivots before its rows, so neither the shard nor its pivots meet in a group.
    """
    wide = d.withColumn("shard", F.col("shard").cast("long") * (1 << 32)).withColumn("probes", F.transform("probes", lambda p: p.cast("long") * (1 << 32)))
    sizes = wide.groupBy("shard").agg(F.count_if("member").alias("members"), F.count_if("home").alias("at_home"), F.count(F.lit(1)).alias("rows"), F.min(F.when(F.col("home"), F.col("key"))).alias("least"))
    large = staged(sizes.where(F.col("members") > BLOCK), "large")
    if large.isEmpty():
        return wide
    pivots = wide.where("home").join(large, "shard").where((F.pmod(F.xxhash64("key", F.lit(3)), F.col("at_home")) < F.ceil(F.col("at_home") / SHARD)) | (F.col("key") == F.col("least")))
    salts = F.ceil(F.col("rows") / SALT_ROWS).cast("int")
    none = F.lit(False)
    first = pivots.select("key", "vec", "copies", "shard", none.alias("home"), none.alias("member"), F.explode(F.sequence(F.lit(0), salts - 1)).alias("salt"), F.lit(0).alias("turn"))
    rows = wide.join(large.select("shard", "rows"), "shard").select("key", "vec", "copies", "shard", "home", "member", F.pmod(F.xxhash64("key", F.lit(4)), salts).cast("int").alias("salt"), F.lit(1).alias("turn"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        now, held, centres = None, [], np.zeros((0, dims))
        for whole in batches:
            for lo in range(0, len(whole), 1024):
                batch = whole.slice(lo, 1024)
                shard, salt, turn = (batch.column(c).to_numpy() for c in ("shard", "salt", "turn"))
                edge = np.flatnonzero(np.append(True, (shard[1:] != shard[:-1]) | (salt[1:] != salt[:-1]) | (turn[1:] != turn[:-1])))
                for a, b in zip(edge.tolist(), [*edge[1:].tolist(), len(batch)], strict=True):
                    part = batch.slice(a, b - a)
                    if now != (shard[a], salt[a]):
                        now, held = (shard[a], salt[a]), []
                    x = _matrix(part.column("vec").to_pylist(), dims)
                    if turn[a] == 0:
                        held.append(x)
                        centres = np.concatenate(held)
                        continue
                    sims = x @ centres.T
                    order = np.argsort(-sims, axis=1, kind="stable")
                    count = np.maximum(min(CELLS, len(centres)), (sims >= sims.max(1, keepdims=True) - gap).sum(1))
                    take = np.repeat(np.arange(len(sims)), count)
                    rank = np.arange(len(take)) - np.repeat(np.cumsum(count) - count, count)
                    home, member = (part.column(c).take(pa.array(take)).to_numpy(zero_copy_only=False) for c in ("home", "member"))
                    cell = shard[a] + 1 + order[take, rank]
                    cols = [part.column(c).take(pa.array(take)) for c in ("key", "vec", "copies")]
                    yield pa.RecordBatch.from_arrays([*cols, pa.array(cell), pa.array(home & (rank == 0)), pa.array(member & (rank < CELLS))], ["key", "vec", "copies", "shard", "home", "member"])

    both = first.unionByName(rows).repartition("shard", "salt").sortWithinPartitions("shard", "salt", "turn", "key")
    cut = both.mapInArrow(run, "key long, vec binary, copies long, shard long, home boolean, member boolean")
    d = staged(wide.join(large.select("shard"), "shard", "left_anti").drop("probes").unionByName(cut), "cells")
    home_first = F.transform(F.array_sort(F.collect_list(F.struct((~F.col("home")).alias("away"), "shard"))), lambda x: x["shard"])
    return d.join(d.groupBy("key").agg(home_first.alias("probes")), "key")


def _links(reps: DataFrame, dims: int, count: int, cosine: float) -> DataFrame:
    """(key, links, root) over the vectors of one length, a row for each shard in which a vector has links."""
    k = max(1, min(MOST_CENTRES, -(-count // SHARD)))
    x = _matrix([bytes(r.vec) for r in reps.orderBy(F.xxhash64("key"), "key").select("vec").limit(SAMPLE).collect()], dims)
    centres = fit_centres(x, k)
    gap = probe_gap(x, centres, cosine)
    d = staged(_cells(staged(_shards(reps, dims, centres, gap), "shards"), dims, gap), "probes")
    members = d.where("member")
    graph = members.groupBy("shard").applyInPandas(_build(dims), "key long, near array<long>")
    graph = graph.groupBy("key").agg(F.array_distinct(F.flatten(F.collect_list("near"))).alias("near"))
    graph = staged(graph, "graph")
    inside = members.join(graph, "key", "left").select("key", "vec", "copies", "shard", "home", "member", "near", "probes")
    asks = d.where("not member").select("key", "vec", "copies", "shard", "home", "member", F.lit(None).cast("array<long>").alias("near"), "probes")
    # many searches in one shard are dealt into salts that each hold the shard; its members search in the first
    salts = asks.groupBy("shard").agg(F.ceil(F.count(F.lit(1)) / SALT_ROWS).cast("int").alias("salts"))
    inside = inside.join(salts, "shard", "left").withColumn("salt", F.explode(F.sequence(F.lit(0), F.greatest(F.coalesce("salts", F.lit(1)), F.lit(1)) - 1))).drop("salts")
    asks = asks.join(salts, "shard").withColumn("salt", F.pmod(F.xxhash64("key", F.lit(5)), F.col("salts")).cast("int")).drop("salts")
    return inside.unionByName(asks).groupBy("shard", "salt").applyInPandas(_search(dims, cosine), "key long, links long, root long")


def _audit(reps: DataFrame, rows: DataFrame, dims: int, cosine: float) -> DataFrame:
    """(key, audit_links): links of the ids divisible by 50, counted by comparing them with all vectors, a block of them in a pass."""
    asked = rows.where(F.col("vec_id") % 50 == 0).where(F.col("dims") == dims).select("key", "vec").distinct()
    asked = staged(asked, "asked")
    blocks = max(1, -(-asked.count() // AUDIT))
    block = F.pmod(F.xxhash64(F.col("key"), F.lit(2)), F.lit(blocks))
    found = None
    for b in range(blocks):
        some = asked.where(block == b).collect()
        keys = np.array([r.key for r in some], np.int64)
        one = staged(reps.select("key", "vec", "copies").mapInArrow(_compare(keys, _matrix([bytes(r.vec) for r in some], dims), dims, cosine), "key long, n long"), "audit")
        found = one if found is None else found.union(one)
    found = found.groupBy("key").agg(F.sum("n").alias("n"))
    return asked.select("key").join(found, "key", "left").select("key", F.coalesce("n", F.lit(0)).alias("audit_links"))


def _compare(keys: np.ndarray, q: np.ndarray, dims: int, cosine: float):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros(len(keys), np.int64)
        for batch in batches:
            key, copies = batch.column("key").to_numpy(), batch.column("copies").to_numpy()
            x = _matrix(batch.column("vec").to_pylist(), dims)
            for lo in range(0, len(x), 1024):
                near = (q @ x[lo : lo + 1024].T >= cosine) & (keys[:, None] != key[lo : lo + 1024])
                total += near @ copies[lo : lo + 1024]
        some = total > 0
        yield pa.RecordBatch.from_arrays([pa.array(keys[some]), pa.array(total[some])], ["key", "n"])

    return run


def near_vectors(df: DataFrame, cosine: float = COSINE, audit: bool = True) -> DataFrame:
    """One row per vector: vec_id, n_links, component_id, kept, audit_links.

    Vectors that are null, empty, zero or hold null or non-finite components have no links. Vectors of different length
    never link. Equal vectors (also rows that repeat an id) are one node of the graph with a number of copies, and are
    linked to each other. audit_links is the brute-force count for the ids divisible by 50, else null;
    `recall` compares the two. An id that is null is kept only if its component has no other. Empty tables give no rows.
    """
    rows = staged(_prepared(df), "vectors")
    reps = rows.where("vec is not null").groupBy("key").agg(F.first("vec").alias("vec"), F.first("dims").alias("dims"), F.count(F.lit(1)).alias("copies"), F.min("vec_id").alias("least"))
    reps = staged(reps, "distinct")
    parts = {r.dims: r.n for r in reps.groupBy("dims").agg(F.count(F.lit(1)).alias("n")).collect()}
    schema = "key long, links long, root long"
    links, audits = df.sparkSession.createDataFrame([], schema), df.sparkSession.createDataFrame([], "key long, audit_links long")
    for dims, n in sorted(parts.items()):
        one = reps.where(F.col("dims") == dims)
        links = links.union(_links(one, dims, n, cosine))
        if audit:
            audits = audits.union(_audit(one, rows, dims, cosine))
    links = staged(links, "links")
    counts = links.groupBy("key").agg(F.sum("links").alias("links"))
    roots = connected_components(links.where("key <> root"), "key", "root")
    nodes = reps.join(counts, "key", "left").join(roots, F.col("key") == F.col("node"), "left").join(audits, "key", "left")
    met = F.greatest(F.coalesce("links", F.lit(0)), F.when(F.col("node").isNotNull(), 1).otherwise(0))
    nodes = nodes.select("key", "least", "copies", met.alias("links"), "audit_links", F.coalesce("root", "key").alias("root"))
    nodes = staged(nodes, "nodes")
    ids = nodes.groupBy("root").agg(F.min("least").alias("component_id"))
    nodes = nodes.join(ids, "root").select("key", "copies", "links", "audit_links", "component_id")
    d = rows.select("vec_id", "key").join(nodes, "key", "left")
    alone = F.col("copies").isNull()
    n_links = F.when(alone, 0).otherwise(F.coalesce("links", F.lit(0)) + F.col("copies") - 1).cast("long")
    component = F.when(alone, F.col("vec_id")).otherwise(F.col("component_id")).cast("long")
    d = d.select("vec_id", n_links.alias("n_links"), component.alias("component_id"), (F.col("audit_links") + F.col("copies") - 1).alias("audit_links"))
    return d.select("vec_id", "n_links", "component_id", F.col("vec_id").eqNullSafe(F.col("component_id")).alias("kept"), "audit_links")


def recall(result: DataFrame) -> float:
    """Share of the audited links that were found; 1 if there were none."""
    r = result.agg(F.sum(F.when(F.col("audit_links").isNotNull(), F.least("n_links", "audit_links"))), F.sum("audit_links")).first()
    return r[0] / r[1] if r[1] else 1.0


def op1_vectors(spark: SparkSession, sf_dir: str) -> DataFrame:
    return near_vectors(table(spark, sf_dir, "embeddings"))

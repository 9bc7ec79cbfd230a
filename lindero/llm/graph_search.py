"""Approximate nearest neighbours by robust-pruned directed graphs, one a shard.

Equal vectors are one node that carries its ``k + 1`` smallest ids, which is all that a search for ``k`` can return of
it; so a vector that a third of all rows share is one node. Distinct vectors are dealt to shards by a hash. Shards grow
with the table, from ``SHARD_ROWS`` to ``MOST_ROWS`` vectors, so that their number, and with it the searches of a query,
stays near ``SHARDS`` until then. Each shard's graph is built by greedy searches that propose neighbours and by robust
pruning: of the candidates, nearest first, one is kept unless a kept one is ``ALPHA`` times nearer to it; entries are
spread by taking the farthest again and again. All queries meet every shard in packs of about ``PACK``, each with a copy of
the shard, where beam search runs for ``BLOCK`` queries in step; a shard with no more vectors than the beam is wide is searched whole. Vectors are
compared in double precision, so near copies are told apart, and scores are computed on the original vectors, scaled by
powers of two against overflow. Graphs are written to the shared folder once, so a lost executor costs a task.

Defined cases: null or empty vectors, vectors of zeros or with null or non-finite parts, and null ids take no part.
Vectors meet only those of their own length. Repeated rows count once. Of several vectors with one id the least (by
length, then by its parts in order) counts. Ties go to the smaller id. Fewer candidates than k: all of them. An empty
table gives an empty table. Other columns are ignored, whatever their names.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from .common import bounded_batches, materialize, table

SHARD_ROWS, MOST_ROWS, SHARDS = 4096, 16384, 64
DEGREE = 24
BEAM = 64
ALPHA = 1.2
ENTRIES = 16
BLOCK = 256
PACK = 4096


def scaled(v: np.ndarray) -> np.ndarray:
    """Each vector times a power of two, so that its largest part is between a half and one: nothing is rounded (but parts
    that are 2**-1000 of the largest), and squares don't overflow."""
    v = v.astype(np.float64)
    return np.ldexp(v, -np.frexp(np.abs(v).max(axis=-1, keepdims=True))[1])


def unit(v: np.ndarray) -> np.ndarray:
    v = scaled(v)
    return v / np.linalg.norm(v, axis=1, keepdims=True)


def beam(vec: np.ndarray, graph: np.ndarray, entries: np.ndarray, queries: np.ndarray, width: int, at_once: int = 3) -> tuple[np.ndarray, np.ndarray]:
    """The best ``width`` nodes found for each query and their similarities, best first; -1 where there are fewer."""
    n, q = len(vec), len(queries)
    seen = np.zeros((q, n), bool)
    seen[:, entries] = True
    ids = np.full((q, width), -1)
    sims = np.full((q, width), -np.inf)
    m = min(len(entries), width)
    ids[:, :m], sims[:, :m] = entries[:m], queries @ vec[entries[:m]].T
    opened = ids < 0
    while True:
        score = np.where(opened, -np.inf, sims)
        pick = np.argpartition(-score, at_once - 1, axis=1)[:, :at_once] if width > at_once else np.broadcast_to(np.arange(width), (q, width))
        live = np.isfinite(np.take_along_axis(score, pick, 1))
        todo = np.flatnonzero(live.any(axis=1))
        if not len(todo):
            break
        pick, live = pick[todo], live[todo]
        opened[todo[:, None], pick] = True
        near = np.where(live[:, :, None], graph[np.maximum(ids[todo[:, None], pick], 0)], -1).reshape(len(todo), -1)
        near.sort(axis=1)
        fresh = (near >= 0) & ~seen[todo[:, None], np.maximum(near, 0)]
        fresh[:, 1:] &= near[:, 1:] != near[:, :-1]
        r, c = np.nonzero(fresh)
        seen[todo[r], near[r, c]] = True
        got = np.full(near.shape, -np.inf)
        got[r, c] = np.einsum("ij,ij->i", vec[near[r, c]], queries[todo[r]])
        all_ids = np.concatenate([ids[todo], np.where(fresh, near, -1)], axis=1)
        all_sims = np.concatenate([sims[todo], got], axis=1)
        all_open = np.concatenate([opened[todo], ~fresh], axis=1)
        keep = np.argpartition(-all_sims, width - 1, axis=1)[:, :width]
        ids[todo], sims[todo], opened[todo] = (np.take_along_axis(x, keep, 1) for x in (all_ids, all_sims, all_open))
    best = np.argsort(-sims, axis=1, kind="stable")
    return np.take_along_axis(ids, best, 1), np.take_along_axis(sims, best, 1)


def prune(vec: np.ndarray, points: np.ndarray, cands: np.ndarray, degree: int, alpha: float) -> np.ndarray:
    """Robust pruning for many points at once; -1 stands for no candidate."""
    out = np.full((len(points), degree), -1, np.int32)
    for lo in range(0, len(points), 256):
        p, c = points[lo : lo + 256], np.sort(cands[lo : lo + 256], axis=1)
        ok = (c >= 0) & (c != p[:, None])
        ok[:, 1:] &= c[:, 1:] != c[:, :-1]
        v = vec[np.maximum(c, 0)]
        far = np.where(ok, 1 - np.einsum("ijk,ik->ij", v, vec[p]), np.inf)
        apart = 1 - v @ v.transpose(0, 2, 1)
        rows = np.arange(len(p))
        for k in range(degree):
            i = far.argmin(axis=1)
            live = np.isfinite(far[rows, i])
            if not live.any():
                break
            out[lo + rows[live], k] = c[rows[live], i[live]]
            far[alpha * apart[rows, i] <= far] = np.inf
            far[rows, i] = np.inf
    return out


def build(vec: np.ndarray, degree: int = DEGREE, width: int = BEAM, alpha: float = ALPHA, seed: int = 1) -> tuple[np.ndarray, np.ndarray]:
    """(neighbours of each node, entry nodes)."""
    n, rng = len(vec), np.random.default_rng(seed)
    degree = min(degree, max(1, n - 1))
    graph = rng.integers(0, n, (n, degree)).astype(np.int32)
    entries = [int((vec @ vec.mean(axis=0)).argmax())]
    near = vec @ vec[entries[0]]
    while len(entries) < min(n, ENTRIES):
        entries.append(int(near.argmin()))
        near = np.maximum(near, vec @ vec[entries[-1]])
    entries = np.unique(entries)
    if n == 1:
        return np.full((1, 1), -1, np.int32), entries
    for strict in (1.0, alpha):
        for batch in np.array_split(rng.permutation(n), -(-n // 512)):
            found, _ = beam(vec, graph, entries, vec[batch], width if strict > 1 else width // 2)
            graph[batch] = prune(vec, batch, np.concatenate([found, graph[batch]], axis=1), degree, strict)
            frm, to = np.repeat(batch, degree), graph[batch].ravel()
            frm, to = frm[to >= 0], to[to >= 0]
            order = np.argsort(to, kind="stable")
            frm, to = frm[order], to[order]
            nodes, first, counts = np.unique(to, return_index=True, return_counts=True)
            extra = np.full((len(nodes), counts.max()), -1, np.int32)
            extra[np.repeat(np.arange(len(nodes)), counts), np.arange(len(to)) - np.repeat(first, counts)] = frm
            by_count = np.argsort(counts, kind="stable")  # so that a node with many proposers doesn't widen others
            for lo in range(0, len(nodes), 256):
                some = by_count[lo : lo + 256]
                most = counts[some].max()
                graph[nodes[some]] = prune(vec, nodes[some], np.concatenate([graph[nodes[some]], extra[some, :most]], axis=1), degree, strict)
    return graph, entries


def nearest(queries: np.ndarray, own: np.ndarray, nodes: np.ndarray, ids: np.ndarray, begin: np.ndarray, graph: np.ndarray, entries: np.ndarray, k: int) -> list[tuple[int, int, float]]:
    """(query id, id, cosine in double precision): up to k of this shard for each query."""
    if len(nodes) <= BEAM:
        found = np.broadcast_to(np.arange(len(nodes)), (len(queries), len(nodes)))
    else:
        vec, asked = unit(nodes), unit(queries)
        found = np.concatenate([beam(vec, graph, entries, asked[lo : lo + BLOCK], BEAM)[0] for lo in range(0, len(asked), BLOCK)])
    out = []
    nodes, queries = scaled(nodes), scaled(queries)
    length = np.linalg.norm(nodes, axis=1)
    for q, own_id, near in zip(queries, own, found):
        near = near[near >= 0]
        cos = nodes[near] @ q / (length[near] * np.linalg.norm(q))
        top = np.argsort(-cos, kind="stable")
        few: list[tuple[float, int]] = []
        for i in top:
            if len(few) >= k and -cos[i] > sorted(few)[k - 1][0]:
                break
            few += [(-cos[i], v) for v in ids[begin[near[i]] : begin[near[i] + 1]].tolist() if v != own_id]
        out += [(int(own_id), v, -s) for s, v in sorted(few)[:k]]
    return out


def search(rows: DataFrame, every: int = 50, k: int = 5, shard_rows: int | None = None) -> DataFrame:
    spark = rows.sparkSession
    bounded_batches(spark)
    good = "vec_id IS NOT NULL AND size(embedding) > 0 AND forall(embedding, x -> x IS NOT NULL AND NOT isnan(x) AND abs(x) < double('Infinity')) AND exists(embedding, x -> x <> 0)"
    rows = rows.select(F.col("vec_id").cast("long").alias("vec_id"), F.col("embedding").cast("array<double>").alias("embedding")).where(good)
    rows = rows.groupBy("vec_id").agg(F.min(F.struct(F.size("embedding").alias("dim"), "embedding")).alias("v")).select("vec_id", "v.*")
    first = Window.partitionBy("dim", "embedding").orderBy("vec_id")
    few = rows.withColumn("_n", F.row_number().over(first)).where(F.col("_n") <= k + 1)
    nodes = materialize(few.groupBy("dim", "embedding").agg(F.array_sort(F.collect_list("vec_id")).alias("ids")))
    n = nodes.count()
    shards = max(1, -(-n // (shard_rows or min(MOST_ROWS, max(SHARD_ROWS, n // SHARDS)))))
    nodes = nodes.withColumn("shard", F.pmod(F.xxhash64("embedding"), F.lit(shards)).cast("int"))

    def make(group: pd.DataFrame) -> pd.DataFrame:
        group = group.sort_values("ids", key=lambda c: c.map(lambda x: x[0]))
        vec = np.stack(group["embedding"].to_numpy())
        graph, entries = build(unit(vec))
        begin = np.concatenate([[0], np.cumsum([len(x) for x in group["ids"]])])
        blob = lambda x, kind: np.ascontiguousarray(x, kind).tobytes()
        return pd.DataFrame([(int(group["shard"].iloc[0]), vec.shape[1], blob(vec, "<f8"), blob(np.concatenate(group["ids"].to_numpy()), "<i8"), blob(begin, "<i8"), graph.shape[1], blob(graph, "<i4"), blob(entries, "<i4"))], columns=["shard", "dim", "nodes", "ids", "begin", "degree", "graph", "entries"])

    index = materialize(nodes.groupBy("shard", "dim").applyInPandas(make, "shard int, dim int, nodes binary, ids binary, begin binary, degree int, graph binary, entries binary"))
    asked = materialize(rows.where(F.pmod("vec_id", F.lit(every)) == 0))
    packs = max(1, -(-asked.count() // PACK))
    asked = asked.groupBy("dim", F.pmod(F.xxhash64("vec_id"), F.lit(packs)).alias("pack")).agg(F.collect_list(F.struct("vec_id", "embedding")).alias("queries"))
    asked = asked.withColumn("shard", F.explode(F.sequence(F.lit(0), F.lit(shards - 1))))

    def find(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for b in batches:
            for r in b.itertuples(index=False):
                read = lambda x, kind: np.frombuffer(x, kind)
                own = np.asarray([q["vec_id"] for q in r.queries])
                got = nearest(np.stack([np.asarray(q["embedding"], float) for q in r.queries]), own, read(r.nodes, "<f8").reshape(-1, r.dim), read(r.ids, "<i8"), read(r.begin, "<i8"), read(r.graph, "<i4").reshape(-1, r.degree), read(r.entries, "<i4"), k)
                yield pd.DataFrame(got, columns=["query_id", "vec_id", "score"])

    # Spark's estimate of the queries is that of one shard, so it would send them to the driver, times the shards
    met = asked.join(index.hint("merge"), ["shard", "dim"])
    found = met.repartition(max(1, min(shards * packs, 8 * int(spark.conf.get("spark.sql.shuffle.partitions")))), "shard", "pack").mapInPandas(find, "query_id long, vec_id long, score double")
    order = Window.partitionBy("query_id").orderBy(F.col("score").desc(), "vec_id")
    return found.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= k).select("query_id", "rank", "vec_id", "score")


def op7_nearest(spark: SparkSession, sf_dir: str) -> DataFrame:
    return search(table(spark, sf_dir, "embeddings"))

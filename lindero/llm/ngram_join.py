"""N-gram Jaccard join by T-occurrence search (DivideSkip), and its connected components.

A document's set is hashed to 64 bits a shingle; equal sets are one node. Shingles have one global order, rare ones
first (by counts over all documents in 65,536 hash buckets, a table of fixed size). Two sets of similarity ``t`` share
one of the first ``n - ceil(t n) + 1`` shingles of each, so only these are listed, and lists of one node are dropped.
A list is cut by length bands; its least node is its hub, and every node meets in the hub's block all nodes it shares
a list with. Inside a block each set asks an inverted index for the sets with at least ``ceil(t n)`` shingles in
common: short lists are merged on a heap that skips, long ones probed by binary search. Sets already connected are not
asked for again, and nothing is emitted but links that connect. Before that, each set is compared with up to
``LEADERS`` earlier ones, the latest of groups found so far; that settles most near copies without a search, and the
search sees the rest (with ``LEADERS`` 0, all).

Before sets travel to blocks, bitmaps of an eighth of their size do: members without a partner that these leave
possible go. Blocks over ``CHUNK`` nodes or ``CHUNK_BYTES`` of sets are cut into chunks, so a block of very long
documents is cut too. Chunks are searched first; only where a block's nodes then lie in more than one component do
chunks meet in pairs, by their bitmaps first, and only nodes of different components are compared. So no link between
different components is lost, and a group of thousands of near copies costs about its size.

Defined cases: null or empty texts have empty sets, which link with nothing. A null doc_id has a set but no links and
a null component. Rows with one doc_id are one document: its texts' sets are linked with each other, so each document
has one component, while n_shingles is of the row's own text. ``near_rows`` takes rows apart instead, each by doc_id
and text. Equal rows get equal results. An empty table gives an empty table. Other columns are ignored, whatever their
names.
"""

from __future__ import annotations

from bisect import bisect_left
from collections.abc import Iterator
from heapq import heapify, heappop, heappush
from math import log2

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .common import bounded_batches, materialize, table
from .components import components

BUCKET_BITS = 16
PARTS = 64
CHUNK, CHUNK_BYTES = 1024, 4 << 20
LEADERS = 4
MU = 0.02


class Words:
    """Tables for hashing words: a number a byte (A-Z as a-z), none for white space, and powers of an odd number."""

    BYTES = np.random.default_rng(20240229).integers(1, 1 << 63, 256, dtype=np.uint64) * np.uint64(2) + np.uint64(1)
    BYTES[65:91] = BYTES[97:123]
    SPACE = np.zeros(256, bool)
    SPACE[[32, *range(9, 14)]] = True
    BYTES[SPACE] = 0
    POWERS = np.ones(1, np.uint64)

    @classmethod
    def powers(cls, n: int) -> np.ndarray:
        while len(cls.POWERS) < n:
            last = cls.POWERS[-1:] * np.uint64(0x9E3779B97F4A7C15)
            cls.POWERS = np.concatenate([cls.POWERS, cls.POWERS * last])
        return cls.POWERS


def word_hashes(data: np.ndarray, cuts: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(hash of each word, its first byte's place) of texts laid end to end; no word reaches over a cut."""
    space = Words.SPACE[data]
    begins = ~space
    begins[1:] &= space[:-1]
    at = cuts[cuts < len(data)]
    begins[at] = ~space[at]
    first = np.flatnonzero(begins)
    if not len(first):
        return np.zeros(0, np.uint64), first
    spans = np.diff(first, append=len(data))
    place = np.arange(first[0], len(data), dtype=np.int64) - np.repeat(first, spans)
    value = Words.BYTES[data[first[0] :]] * Words.powers(int(spans.max()) + 1)[place]
    h = np.add.reduceat(value, first - first[0])
    return (h ^ (h >> np.uint64(31))) * np.uint64(0xBF58476D1CE4E5B9), first


class Shingles:
    """Sorted distinct 64-bit hashes of the shingles of texts. Words: ``[^\\x20\\x09-\\x0D]+``, A-Z lower-cased."""

    BLOCK = 1 << 20

    def __init__(self, k: int):
        self.k = k

    def words(self, texts: pa.Array) -> Iterator[np.ndarray]:
        """Word hashes of each text, read from the Arrow buffers about a megabyte at a time."""
        wide = np.int64 if pa.types.is_large_string(texts.type) else np.int32
        _, offsets, data = texts.buffers()
        cuts = np.frombuffer(offsets, wide)[texts.offset : texts.offset + len(texts) + 1].astype(np.int64)
        data = np.frombuffer(data or b"", np.uint8)
        i, n = 0, len(texts)
        while i < n:
            j = max(i + 1, int(np.searchsorted(cuts, cuts[i] + self.BLOCK, side="right")) - 1)
            if cuts[j] - cuts[i] <= 2 * self.BLOCK:
                h, first = word_hashes(data[cuts[i] : cuts[j]], cuts[i:j] - cuts[i])
                ends = np.searchsorted(first, cuts[i : j + 1] - cuts[i])
                yield from (h[a:b] for a, b in zip(ends, ends[1:]))
            else:  # one very long text: in blocks that end at white space
                parts, a = [], int(cuts[i])
                while a < cuts[j]:
                    b = min(a + self.BLOCK, int(cuts[j]))
                    while b < cuts[j] and not Words.SPACE[data[b]]:
                        b += 1
                    parts.append(word_hashes(data[a:b], np.zeros(1, np.int64))[0])
                    a = b
                yield np.concatenate(parts)
            i = j

    def __call__(self, texts: pa.Array) -> Iterator[np.ndarray]:
        for h in self.words(texts):
            m = min(self.k, len(h))
            if not m:
                yield h
                continue
            x = np.full(len(h) - m + 1, m, np.uint64)
            for i in range(m):
                x = (x ^ (x >> np.uint64(29))) * np.uint64(0xBF58476D1CE4E5B9) + h[i : len(h) - m + 1 + i]
            x = (x ^ (x >> np.uint64(32))) * np.uint64(0x94D049BB133111EB)
            yield np.unique(x ^ (x >> np.uint64(31)))


def bitmap(x: np.ndarray) -> bytes:
    """One bit a shingle in at least four times as many bits, a power of two; halves may be laid over each other."""
    bits = max(64, 1 << (4 * len(x) - 1).bit_length())
    out = np.zeros(bits, bool)
    out[(x & np.uint64(bits - 1)).astype(np.int64)] = True
    return np.packbits(out, bitorder="little").tobytes()


def folded(b: np.ndarray, size: int) -> np.ndarray:
    while len(b) > size:
        half = len(b) // 2
        b = b[:half] | b[half:]
    return b


def may_link(sizes: np.ndarray, bits: list[np.ndarray], t: int, labels: np.ndarray | None = None, sides: np.ndarray | None = None) -> np.ndarray:
    """Which sets of a block have a partner (of another label and side, if given) that their bitmaps don't rule out. A bit of
    one that the other lacks is a shingle that they don't share, so nothing that links is ruled out."""
    order = np.argsort(sizes, kind="stable")
    hit = np.zeros(len(sizes), bool)
    for size in {len(b) for b in bits}:
        rows = np.asarray([i for i in order if len(bits[i]) in (size, 2 * size)])
        table = np.stack([folded(bits[i], size) for i in rows])
        words = table.view(np.uint64)
        n = sizes[rows]
        for r, i in enumerate(rows):
            lo = int(np.searchsorted(n, ceil_share(t, n[r])))
            for c in range(lo, r, 4096):
                d = min(r, c + 4096)
                lacks = np.bitwise_count(words[r] & ~words[c:d]).sum(axis=1)
                both = n[r] - lacks.astype(np.int64)
                both = np.minimum(both, n[c:d] - np.bitwise_count(words[c:d] & ~words[r]).sum(axis=1).astype(np.int64))
                ok = 100 * both >= t * (n[r] + n[c:d] - both)
                for apart in (labels, sides):
                    if apart is not None:
                        ok &= apart[rows[c:d]] != apart[i]
                ok = np.flatnonzero(ok)
                if len(ok):
                    hit[i] = True
                    hit[rows[c + ok]] = True
    return hit


def ceil_share(t: int, n):
    """ceil(t % of n)"""
    return -(-t * n // 100)


def node_of(x: np.ndarray) -> int:
    return int(np.array(xxhash.xxh3_64_intdigest(x.tobytes()), np.uint64).view(np.int64))


def bucket(x: np.ndarray) -> np.ndarray:
    return (x >> np.uint64(64 - BUCKET_BITS)).astype(np.int64)


SETS = "doc_id long, t long, n long, node long, bits binary, part int, counts binary"


def _sets(docs: DataFrame, k: int) -> DataFrame:
    """A row a document, and ``PARTS`` rows a task with its bucket counts."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        shingles, total = Shingles(k), np.zeros(1 << BUCKET_BITS, np.int64)
        names = ["doc_id", "t", "n", "node", "bits", "part", "counts"]
        for b in batches:
            sets = list(shingles(b.column(1)))
            for x in sets:
                total += np.bincount(bucket(x), minlength=len(total)) if len(x) > 5000 else 0
            small = [x for x in sets if len(x) <= 5000]
            if small:
                total += np.bincount(bucket(np.concatenate(small)), minlength=len(total))
            nodes, m = [node_of(x) if len(x) else None for x in sets], len(sets)
            bits = pa.array([bitmap(x) if len(x) else None for x in sets], pa.binary())
            yield pa.RecordBatch.from_arrays([b.column(0), b.column(2), pa.array([len(x) for x in sets], pa.int64()), pa.array(nodes, pa.int64()), bits, pa.nulls(m, pa.int32()), pa.nulls(m, pa.binary())], names)
        if total.any():
            none = [pa.nulls(PARTS, pa.int64())] * 4 + [pa.nulls(PARTS, pa.binary())]
            yield pa.RecordBatch.from_arrays([*none, pa.array(range(PARTS), pa.int32()), pa.array([x.tobytes() for x in np.split(total, PARTS)], pa.binary())], names)

    return docs.mapInArrow(run, SETS)


def _counts(sets: DataFrame) -> np.ndarray:
    """Bucket counts of all documents: each part of the buckets is summed by a task of its own, as a stream."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        sums: dict[int, np.ndarray] = {}
        for b in batches:
            for part, x in zip(b.column(0).to_pylist(), b.column(1).to_pylist()):
                sums[part] = sums.get(part, 0) + np.frombuffer(x, np.int64)
        yield pa.RecordBatch.from_arrays([pa.array(sums, pa.int32()), pa.array([x.tobytes() for x in sums.values()], pa.binary())], ["part", "counts"])

    rows = sets.where("counts IS NOT NULL").select("part", "counts").repartition("part").mapInArrow(run, "part int, counts binary").collect()
    found = {r.part: np.frombuffer(r.counts, np.int64) for r in rows}
    return np.concatenate([found.get(i, np.zeros((1 << BUCKET_BITS) // PARTS, np.int64)) for i in range(PARTS)])


def _prefixes(docs: DataFrame, k: int, t: int, counts: np.ndarray) -> DataFrame:
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        shingles = Shingles(k)
        for b in batches:
            out: list[list] = [[], [], []]
            for x in shingles(b.column(1)):
                n = len(x)
                if n:
                    first = x[np.lexsort((x, counts[bucket(x)]))[: n - ceil_share(t, n) + 1]]
                    out[0].append(first.view(np.int64))
                    out[1].append(np.full(len(first), node_of(x), np.int64))
                    out[2].append(np.full(len(first), n, np.int32))
            if out[0]:
                yield pa.RecordBatch.from_arrays([pa.array(np.concatenate(c)) for c in out], ["s", "node", "n"])

    return docs.mapInArrow(run, "s long, node long, n int")


def _wanted(docs: DataFrame, k: int) -> DataFrame:
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        shingles = Shingles(k)
        for b in batches:
            sets = list(shingles(b.column(1)))
            yield pa.RecordBatch.from_arrays([pa.array([node_of(x) for x in sets], pa.int64()), pa.array([x.tobytes() for x in sets], pa.binary())], ["node", "shingles"])

    return docs.mapInArrow(run, "node long, shingles binary")


def merge_skip(lists: list[list[int]], need: int) -> Iterator[tuple[int, int]]:
    """(id, in how many lists) for ids in at least ``need`` of the sorted lists; skips where fewer can't be enough."""
    at = [0] * len(lists)
    heap = [(x[0], i) for i, x in enumerate(lists) if x]
    heapify(heap)
    while heap:
        top = heap[0][0]
        out = []
        while heap and heap[0][0] == top:
            out.append(heappop(heap)[1])
        if len(out) >= need:
            yield top, len(out)
            for i in out:
                at[i] += 1
                if at[i] < len(lists[i]):
                    heappush(heap, (lists[i][at[i]], i))
        else:
            for _ in range(need - 1 - len(out)):  # these can't reach it together with the lists taken
                if heap:
                    out.append(heappop(heap)[1])
            if not heap:
                return
            reach = heap[0][0]
            for i in out:
                at[i] = bisect_left(lists[i], reach, at[i])
                if at[i] < len(lists[i]):
                    heappush(heap, (lists[i][at[i]], i))


def t_occurrence(tokens: list[int], postings: dict[int, list[int]], need: int) -> list[int]:
    """DivideSkip: ids in at least ``need`` of the lists of ``tokens``."""
    lists = sorted((p for x in tokens if (p := postings.get(x))), key=len)
    if len(lists) < need:
        return []
    longs = min(need - 1, int(need / (MU * log2(len(lists[-1]) + 1) + 1)))
    short, long = lists[: len(lists) - longs], lists[len(lists) - longs :]
    out = []
    for i, count in merge_skip(short, need - longs):
        left = len(long)
        for p in reversed(long):
            if count >= need or count + left < need:
                break
            j = bisect_left(p, i)
            count += j < len(p) and p[j] == i
            left -= 1
        if count >= need:
            out.append(i)
    return out


class Forest:
    def __init__(self, labels: list):
        first: dict = {}
        self.up = [i if x is None else first.setdefault(x, i) for i, x in enumerate(labels)]

    def find(self, i: int) -> int:
        while self.up[i] != i:
            self.up[i] = i = self.up[self.up[i]]
        return i


def search_block(nodes: list[int], sets: list[np.ndarray], t: int, labels: list | None = None, sides: list[int] | None = None) -> list[tuple[int, int]]:
    """Links that connect the block's components; with ``sides``, only pairs of different sides are asked for."""
    order = sorted(range(len(nodes)), key=lambda i: (len(sets[i]), nodes[i]))
    nodes, sets = [nodes[i] for i in order], [sets[i] for i in order]
    sides = [sides[i] for i in order] if sides else None
    forest = Forest([labels[i] for i in order] if labels else [None] * len(nodes))
    out: list[tuple[int, int]] = []

    def linked(i: int, j: int) -> bool:
        a, b = sets[i], sets[j]
        both = len(np.intersect1d(a, b, assume_unique=True))
        return 100 * both >= t * (len(a) + len(b) - both)

    def join(i: int, j: int) -> None:
        out.append((nodes[j], nodes[i]))
        forest.up[forest.find(i)] = forest.find(j)

    sizes = [len(x) for x in sets]
    flat, inverse, shared = np.unique(np.concatenate(sets), return_inverse=True, return_counts=True)
    del flat
    cuts = np.cumsum([0, *sizes])
    tokens = [x[shared[x] > 1].tolist() for x in (inverse[a:b] for a, b in zip(cuts, cuts[1:]))]
    postings: dict[int, list[int]] = {}
    leaders: list[int] = []
    for i in range(len(nodes)):
        need = ceil_share(t, sizes[i])
        if len(tokens[i]) >= need:
            for j in leaders:  # the latest sets of the largest groups: most near copies end here
                if forest.find(i) != forest.find(j) and (sides is None or sides[i] != sides[j]) and sizes[j] >= need and linked(i, j):
                    join(i, j)
            if any(forest.find(j) != forest.find(i) for j in range(i)):
                mine = forest.find(i)
                for j in t_occurrence(tokens[i], postings, need):
                    if forest.find(j) != mine and (sides is None or sides[i] != sides[j]) and linked(i, j):
                        join(i, j)
                        mine = forest.find(i)
            for x in tokens[i]:
                postings.setdefault(x, []).append(i)
            if all(forest.find(i) != forest.find(j) for j in leaders):
                leaders = [*leaders[1 - LEADERS :], i] if LEADERS > 1 else [i][:LEADERS]
    return out


def _possible(rows: DataFrame, by: list[str], t: int) -> DataFrame:
    """rows: the columns ``by``, node, n, bits, and perhaps root and side -> the columns ``by`` and the nodes that their
    bitmaps leave with a possible partner in their block."""
    cols = [c for c in ("root", "side") if c in rows.columns]
    kinds = {"hub": pa.int64(), "node": pa.int64()}
    schema = pa.schema([(c, kinds.get(c, pa.int32())) for c in (*by, "node")])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        key, held = None, []
        out: list[tuple] = []

        def close() -> None:
            if len(held) > 1:
                labels, sides = (np.asarray([r[c] for r in held]) if c in held[0] else None for c in ("root", "side"))
                keep = may_link(np.asarray([r["n"] for r in held]), [np.frombuffer(r["bits"], np.uint8) for r in held], t, labels, sides)
                out.extend((*key, r["node"]) for r, ok in zip(held, keep) if ok)

        def flush() -> pa.RecordBatch:
            cols = list(zip(*out)) or [()] * len(schema)
            out.clear()
            return pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(cols, schema)], schema=schema)

        for batch in batches:
            for r in batch.to_pylist():
                if key != (now := tuple(r[c] for c in by)):
                    close()
                    key, held = now, []
                held.append(r)
            yield flush()
        close()
        yield flush()

    spread = rows.select(*by, "node", "n", "bits", *cols).repartition(*by).sortWithinPartitions(*by, "node")
    return spread.mapInArrow(run, ", ".join(f"{c} {'long' if c in kinds else 'int'}" for c in (*by, "node")))


def _blocks(rows: DataFrame, by: list[str], t: int) -> DataFrame:
    """rows: the columns ``by``, node, shingles, and perhaps root and side. Links of each block, read as a stream."""
    cols = [*by, "node", "shingles", *[c for c in ("root", "side") if c in rows.columns]]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        key, held, links = None, [], []

        def close() -> None:
            if len(held) > 1:
                get = lambda c: [r[c] for r in held] if c in held[0] else None
                links.extend(search_block(get("node"), [np.frombuffer(r["shingles"], np.uint64) for r in held], t, get("root"), get("side")))

        def flush() -> pa.RecordBatch:
            a, b = zip(*links) if links else ((), ())
            links.clear()
            return pa.RecordBatch.from_arrays([pa.array(a, pa.int64()), pa.array(b, pa.int64())], ["a", "b"])

        for batch in batches:
            for r in batch.to_pylist():
                if key != (now := tuple(r[c] for c in by)):
                    close()
                    key, held = now, []
                held.append(r)
            yield flush()
        close()
        yield flush()

    spread = rows.select(*cols).repartition(*by).sortWithinPartitions(*by, "node")
    return spread.mapInArrow(run, "a long, b long").distinct()


def connect(docs: DataFrame, k: int = 5, t: int = 80, apart: bool = False) -> tuple[DataFrame, DataFrame]:
    """(doc_id, t, n, node) of every row, t a hash of its text, and (node, root) of linked nodes. ``t`` in per cent. Nodes of
    one doc_id are linked unless ``apart``."""
    bounded_batches(docs.sparkSession)
    text = F.col("text").cast("string")
    docs = docs.select(F.col("doc_id").cast("long").alias("doc_id"), text.alias("text"), F.xxhash64(text).alias("t"))
    every = materialize(_sets(docs, k))
    sets = every.where("counts IS NULL").select("doc_id", "t", "n", "node")
    full = sets.where("node IS NOT NULL AND doc_id IS NOT NULL")
    entries = materialize(_prefixes(docs.where("doc_id IS NOT NULL").select("doc_id", "text"), k, t, _counts(every)))
    lists = materialize(entries.groupBy("s").agg(F.min("node").alias("a"), F.max("node").alias("b")).where("a <> b").select("s"))
    band = F.floor(F.log("n") / F.log(F.lit(100.0 / (t - 0.01)))).cast("int")
    entries = materialize(entries.join(lists, "s").select("s", "node", "n", F.explode(F.array(band, band + 1)).alias("band")).distinct())
    hubs = entries.groupBy("s", "band").agg(F.min("node").alias("hub"), F.max("node").alias("b")).where("hub <> b").drop("b")
    member = materialize(entries.join(hubs, ["s", "band"]).select("hub", "node", "n").distinct())

    cuts = F.ceil(F.greatest(F.col("count") / CHUNK, F.col("size") * 8 / CHUNK_BYTES)).cast("int")
    parts = materialize(member.groupBy("hub").agg(F.count(F.lit(1)).alias("count"), F.sum("n").alias("size")).select("hub", cuts.alias("chunks")))
    member = materialize(member.drop("n").join(parts, "hub").withColumn("chunk", F.pmod(F.xxhash64("node"), F.col("chunks")).cast("int")))
    # a row a node first, so that copies of one text meet as one; then those in blocks
    bits = every.where("bits IS NOT NULL").select("node", "n", "bits").dropDuplicates(["node"])
    bits = materialize(bits.join(member.select("node").distinct(), "node", "left_semi"))
    first = full.groupBy("node").agg(F.min("doc_id").alias("doc_id"))

    def held(nodes: DataFrame) -> DataFrame:
        """The sets of these nodes, from the first document of each."""
        nodes = materialize(nodes.select("node").distinct())
        ids = first.join(nodes, "node", "left_semi").select("doc_id").distinct()
        return materialize(_wanted(docs.join(ids, "doc_id", "left_semi").select("doc_id", "text"), k).join(nodes, "node", "left_semi").dropDuplicates(["node"]))

    near = materialize(_possible(member.join(bits, "node"), ["hub", "chunk"], t))
    links = _blocks(near.join(held(near), "node"), ["hub", "chunk"], t)
    if not apart:
        several = materialize(full.groupBy("doc_id").agg(F.min("node").alias("a"), F.max("node").alias("b")).where("a <> b").select("doc_id", "a"))
        if several.limit(1).count():
            links = links.union(full.join(several, "doc_id").where("a <> node").select("a", F.col("node").alias("b")).distinct())
    links = materialize(links)
    roots = components(links)

    wide = member.where("chunks > 1").join(roots, "node", "left").withColumn("root", F.coalesce("root", "node"))
    split = wide.groupBy("hub").agg(F.min("root").alias("a"), F.max("root").alias("b")).where("a <> b").select("hub")
    wide = materialize(wide.join(split, "hub"))
    if wide.limit(1).count():
        other = F.explode(F.sequence(F.lit(0), F.col("chunks") - 1))
        pairs = wide.withColumn("other", other).where("other <> chunk").withColumns({"i": F.least("chunk", "other"), "j": F.greatest("chunk", "other"), "side": F.col("chunk")})
        key = ["hub", "i", "j"]
        near = materialize(_possible(pairs.join(bits, "node"), key, t).join(pairs.select(*key, "node", "root", "side"), [*key, "node"]))
        more = materialize(_blocks(near.join(held(near), "node"), key, t))
        if more.limit(1).count():
            roots = components(links.union(more))
    return sets, roots


def near_duplicates(docs: DataFrame, k: int = 5, t: int = 80) -> DataFrame:
    """doc_id, n_shingles and component_id of every row."""
    sets, roots = connect(docs, k, t)
    least = sets.where("node IS NOT NULL AND doc_id IS NOT NULL").groupBy("node").agg(F.min("doc_id").alias("least")).join(roots, "node", "left").withColumn("root", F.coalesce("root", "node"))
    first = least.groupBy("root").agg(F.min("least").alias("component"))
    named = materialize(least.join(first, "root").select("node", "component"))
    out = sets.join(named, "node", "left")
    return out.select("doc_id", F.col("n").alias("n_shingles"), F.when(F.col("doc_id").isNotNull(), F.coalesce("component", "doc_id")).alias("component_id"))


def near_rows(docs: DataFrame, k: int = 5, t: int = 80) -> DataFrame:
    """doc_id and text_hash (``xxhash64``) of every distinct row that links with another or shares its set, and whether it is the
    first of its component: the least doc_id, then the least hash."""
    sets, roots = connect(docs, k, t, apart=True)
    rows = sets.where("node IS NOT NULL AND doc_id IS NOT NULL").groupBy("doc_id", F.col("t").alias("text_hash")).agg(F.min("node").alias("node"))
    rows = materialize(rows)
    of = materialize(rows.groupBy("node").agg(F.min(F.struct("doc_id", "text_hash")).alias("a"), F.max(F.struct("doc_id", "text_hash")).alias("b")).join(roots, "node", "left"))
    of = of.where("root IS NOT NULL OR a <> b").withColumn("root", F.coalesce("root", "node"))
    first = of.groupBy("root").agg(F.min("a").alias("first"))
    named = materialize(of.join(first, "root").select("node", "first"))
    return rows.join(named, "node").select("doc_id", "text_hash", (F.struct("doc_id", "text_hash") == F.col("first")).alias("is_first"))


def op9_ngram_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    return near_duplicates(table(spark, sf_dir, "documents"), k=4, t=85)


#: All pairs that share a shingle, and what they reach. Exact where doc_ids are unique.
ORACLE = """
WITH RECURSIVE w AS (SELECT doc_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\\x20\\x09-\\x0D]+') AS w FROM documents),
s AS (SELECT doc_id, list_distinct(CASE WHEN len(w) = 0 THEN [] WHEN len(w) < 4 THEN [array_to_string(w, ' ')] ELSE list_transform(range(1, len(w) - 2), lambda i: array_to_string(w[i:i+3], ' ')) END) AS s FROM w),
x AS (SELECT doc_id, len(s) AS n, unnest(s) AS x FROM s),
p AS (SELECT a.doc_id AS a, b.doc_id AS b, count(*) AS common, any_value(a.n) AS m, any_value(b.n) AS n FROM x a JOIN x b USING (x) WHERE a.doc_id < b.doc_id GROUP BY ALL),
h AS (SELECT a, b FROM p WHERE 100 * common >= 85 * (m + n - common)),
l AS (SELECT a, b FROM h UNION ALL SELECT b, a FROM h),
r AS (SELECT a, b FROM l UNION SELECT r.a, l.b FROM r JOIN l ON r.b = l.a),
c AS (SELECT a AS doc_id, min(b) AS least FROM r GROUP BY a)
SELECT s.doc_id, len(s)::BIGINT AS n_shingles, least(s.doc_id, coalesce(c.least, s.doc_id)) AS component_id FROM s LEFT JOIN c USING (doc_id)"""

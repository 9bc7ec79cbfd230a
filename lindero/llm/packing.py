"""Packing documents into sequences of at most ``capacity`` tokens by cutting-stock column generation.

Each document's ids, end id included, are cut into full pieces and a rest; a rest over half a sequence is cut once
more, at the half (whole rests leave 5 % padding, as too many are longer than half; so cut, under 0.5 %). The histogram of rest lengths (``bin``
wide, so bounded whatever the corpus) is a cutting-stock problem: a linear program over patterns (how many pieces of
each length go into one sequence), whose dual prices let a knapsack dynamic program propose the next pattern until
none improves it by more than ``gap``. Patterns are rounded down; the few rests left over are placed best-fit. Then
every document's rest gets its rank among rests of its length, and the rank picks pattern copy and slot.
The linear program runs in the driver on at most capacity / bin lengths; documents never go there. Ranks are counted
in ``SALTS`` parts of each length, dealt by row when the pieces are written, so a length that a third of all documents
have is spread out, also where all of them are copies of one row.

Defined cases: null or empty text: the end id alone. Null doc_id: kept. Equal rows: packed each. Empty table: no
rows. Other columns are ignored, whatever their names.
"""

from __future__ import annotations

import zlib
from collections import defaultdict
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from .common import bounded_batches, materialize, table
from .token_ids import byte_level

CAPACITY = 1024
BIN = 2
SALTS = 256
PIECES = "doc_id long, start long, length long, ids_crc32 long, doc_tokens long"


def pieces(docs: DataFrame, tokenizer: str, end_id: int = 0, capacity: int = CAPACITY, keep_ids: bool = False) -> DataFrame:
    bounded_batches(docs.sparkSession)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        code, end, step = byte_level(tokenizer), np.asarray([end_id], "<u4").tobytes(), 4 * capacity
        for b in batches:
            out: list[tuple] = []
            for d, ids in zip(b.column(0).to_pylist(), code(b.column(1).to_pylist())):
                ids += end
                n = len(ids) // step * step
                cuts = [*range(0, n + 1, step), *([n + step // 2] if len(ids) - n > step // 2 else [])]
                for i, j in zip(cuts, [*cuts[1:], len(ids)]):
                    if i == j:
                        continue
                    p = ids[i:j]
                    out.append((d, i // 4, len(p) // 4, zlib.crc32(p), len(ids) // 4, p))
            cols = list(zip(*out)) or [[]] * 6
            names = ["doc_id", "start", "length", "ids_crc32", "doc_tokens"]
            arrays = [pa.array(c, pa.int64()) for c in cols[:5]]
            if keep_ids:
                names, arrays = [*names, "ids"], [*arrays, pa.array(cols[5], pa.binary())]
            yield pa.RecordBatch.from_arrays(arrays, names)

    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.coalesce("text", F.lit("")).alias("text"))
    return rows.mapInArrow(run, PIECES + (", ids binary" if keep_ids else ""))


def best_pattern(sizes: np.ndarray, prices: np.ndarray, capacity: int) -> tuple[float, dict[int, int]]:
    """Unbounded knapsack: the dearest pattern that fits, as index -> copies."""
    worth, took = np.zeros(capacity + 1), np.full(capacity + 1, -1)
    for c in range(1, capacity + 1):
        worth[c] = worth[c - 1]
        if k := np.searchsorted(sizes, c, side="right"):
            value = worth[c - sizes[:k]] + prices[:k]
            i = int(value.argmax())
            if value[i] > worth[c]:
                worth[c], took[c] = value[i], i
    out: dict[int, int] = defaultdict(int)
    c = capacity
    while c > 0:
        if took[c] < 0:
            c -= 1
        else:
            out[int(took[c])] += 1
            c -= int(sizes[took[c]])
    return float(worth[capacity]), out


def solve(sizes: list[int], demand: list[int], capacity: int, gap: float = 1e-3) -> list[tuple[dict[int, int], int]]:
    """(size -> copies, how many sequences) so that every demand is met exactly."""
    m, left = len(sizes), np.asarray(demand, np.int64)
    if not m:
        return []
    size, need = np.asarray(sizes, np.int64), np.asarray(demand, float)
    patterns = [{i: int(capacity // size[i])} for i in range(m)]
    inverse = np.diag([1.0 / p[i] for i, p in enumerate(patterns)])
    x = inverse @ need
    for _ in range(20 * m):
        prices = np.ones(m) @ inverse
        value, p = best_pattern(size, np.maximum(prices, 0), capacity)
        if value <= 1 + gap:  # sum(x) / value bounds the optimum from below
            break
        column = np.zeros(m)
        column[list(p)] = list(p.values())
        turn = inverse @ column
        ratio = np.where(turn > 1e-9, x / np.where(turn > 1e-9, turn, 1), np.inf)
        r = int(ratio.argmin())
        if not np.isfinite(ratio[r]):
            break
        inverse[r] /= turn[r]
        other = np.arange(m) != r
        inverse[other] -= turn[other, None] * inverse[r]
        patterns[r] = dict(p)
        x = np.maximum(inverse @ need, 0)
    out = []
    for p, n in sorted(zip(patterns, x), key=lambda t: -t[1]):
        n = min([int(n + 1e-9), *(int(left[i] // k) for i, k in p.items())])
        if n > 0:
            for i, k in p.items():
                left[i] -= n * k
            out.append(({int(size[i]): k for i, k in p.items()}, n))
    room: dict[int, list[dict[int, int]]] = defaultdict(list)  # free space -> open sequences
    opened = []
    for i in range(m - 1, -1, -1):
        for _ in range(int(left[i])):
            s = int(size[i])
            free = next((f for f in range(s, capacity + 1) if room[f]), None)
            if free is None:
                seq: dict[int, int] = {}
                opened.append(seq)
                free = capacity
            else:
                seq = room[free].pop()
            seq[s] = seq.get(s, 0) + 1
            room[free - s].append(seq)
    return out + [(s, 1) for s in opened]


def pack(rows: DataFrame, capacity: int = CAPACITY, bin: int = BIN) -> DataFrame:
    """Adds sequence_id and offset to pieces with a ``_salt`` (a written table, read three times: see ``salted``)."""
    spark = rows.sparkSession
    whole = -(-capacity // bin)
    rows = rows.withColumn("_bin", F.least(F.ceil(F.col("length") / bin), F.lit(whole)).cast("int"))
    counts = {r[0]: r[1] for r in rows.groupBy("_bin").count().collect()}
    sizes = sorted(b for b in counts if b < capacity // bin)
    plan = solve(sizes, [counts[b] for b in sizes], capacity // bin)
    plan += [({b: 1}, n) for b, n in counts.items() if b not in sizes]
    slots, base, seen = [], 0, defaultdict(int)
    for p, n in plan:  # ranks [lo, hi) of a bin go k to a sequence, from sequence base on
        for b, k in p.items():
            slots.append((b, seen[b], seen[b] + n * k, k, base))
            seen[b] += n * k
        base += n
    schema = "_bin int, _lo long, _hi long, _k long, _base long"
    slots_df = F.broadcast(spark.createDataFrame(slots, schema))  # at most a few times (capacity / bin) patterns

    sums = rows.groupBy("_bin", "_salt").count()
    before = sums.withColumn("_before", F.sum("count").over(Window.partitionBy("_bin").orderBy("_salt")) - F.col("count")).drop("count")
    within = Window.partitionBy("_bin", "_salt").orderBy("doc_id", "start", "ids_crc32")
    ranked = rows.withColumn("_rank", F.row_number().over(within).cast("long")).join(before, ["_bin", "_salt"])
    ranked = ranked.withColumn("_rank", F.col("_rank") + F.col("_before") - 1)
    r, s = ranked.alias("r"), slots_df.alias("s")
    placed = r.join(s, (F.col("r._bin") == F.col("s._bin")) & (F.col("_rank") >= F.col("_lo")) & (F.col("_rank") < F.col("_hi")))
    placed = placed.withColumn("sequence_id", F.col("_base") + F.floor((F.col("_rank") - F.col("_lo")) / F.col("_k")).cast("long"))
    inside = Window.partitionBy("sequence_id").orderBy(F.col("length").desc(), "r._bin", "_rank")
    offset = F.sum("length").over(inside.rowsBetween(Window.unboundedPreceding, Window.currentRow)) - F.col("length")
    return placed.withColumn("offset", offset).select(*[F.col(f"r.{c}") for c in rows.columns if c[0] != "_"], "sequence_id", "offset")


def salted(rows: DataFrame) -> DataFrame:
    """Pieces as a written table, each row in one of ``SALTS`` parts whatever it holds."""
    return materialize(rows.withColumn("_salt", F.pmod(F.xxhash64(F.monotonically_increasing_id()), F.lit(SALTS)).cast("int")))


def pack_documents(docs: DataFrame, tokenizer: str | None = None) -> DataFrame:
    import public_tokenizers

    return pack(salted(pieces(docs, tokenizer or public_tokenizers.path("byte_bpe_50k.json"))))


def op3_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return pack_documents(table(spark, sf_dir, "documents"))

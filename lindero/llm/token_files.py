"""Token ids as binary shard files with Elias-Fano document boundaries.

Shard file (little-endian): all ids of the shard one after the other, 2 bytes each (4 if the vocabulary needs it);
then the document ends and the sorted doc_ids as Elias-Fano sequences, each with its sampled counts; then a fixed
trailer. The boundaries take about 2 + log2(ids per document) bits a document. ``EliasFano.select`` returns a range of
them from the samples and the blocks of the sequence that hold it, read from the file as asked for, so a reader never
has a table of 64-bit offsets: memory holds the samples (4 bytes for every ``SAMPLE`` bytes of high bits) and one block
of documents. A writer streams ids, and keeps 12 bytes a document of its shard (a 4-byte length, an 8-byte id).

Shards are dealt by size: one for about ``SHARD_BYTES`` of input, by Spark's own statistics of the plan, and no fewer than
``spark.sql.shuffle.partitions``. Shard k holds smaller doc_ids than shard k + 1; rows within a shard ascend.

Defined cases: null or empty text: the end id alone. Null doc_id: before all others. Rows with equal doc_id stay
apart, ordered by a hash of their text, then by their place in the input, which also spreads them over shards; equal
rows give equal records but for their start. Empty table: no shard, no rows. Other columns are ignored, whatever their
names. A lost executor's shard is written again under the same name: files are written under another name first and
renamed.
"""

from __future__ import annotations

import struct
import uuid
import zlib
from collections.abc import Callable, Iterable, Iterator

import numpy as np
import pyarrow as pa
from pyarrow import fs
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .common import bounded_batches, shared_dir, table
from .token_ids import word_level

MAGIC = b"LNDIDS02"
SAMPLE = 512
BLOCK_DOCS = 4096
SHARD_BYTES = 128 << 20
END_ID = 1


class Trailer:
    FORM = struct.Struct("<8sQQQQQq")  # magic, bytes an id, documents, documents without id, bytes of ends, of doc_ids, least doc_id


class EliasFano:
    """A non-decreasing sequence of fewer than 2**32 non-negative integers in near-minimal space: the low bits of each, laid
    end to end; the high bits as a bitmap in which the i-th one stands at (value i >> low bits) + i; and the number of ones
    before each ``SAMPLE`` bytes of that bitmap. Held as a function that reads bytes of its written form."""

    HEAD = struct.Struct("<QQQQ")  # values, low bits, bytes of low bits, bytes of high bits

    def __init__(self, part: Callable[[int, int], bytes]):
        self.part = part
        self.n, self.low_bits, self.low_size, self.high_size = self.HEAD.unpack(part(0, self.HEAD.size))
        self.low_at = self.HEAD.size
        self.high_at = self.low_at + self.low_size
        blocks = -(-self.high_size // SAMPLE)
        self.before = np.frombuffer(part(self.high_at + self.high_size, 4 * blocks), "<u4")

    @classmethod
    def pack(cls, values: Iterable[np.ndarray], n: int, top: int) -> bytes:
        """The written form of ``n`` ascending values up to ``top``, given in blocks."""
        if n >= 1 << 32:
            raise ValueError("too many values")
        bits = max(0, (top // n).bit_length() - 1) if n else 0
        low, high = np.zeros(-(-n * bits // 8) + 8, np.uint8), np.zeros(-(-((top >> bits) + n + 1) // 8), np.uint8)
        i = 0
        for block in values:
            v = np.asarray(block, np.uint64)
            ones = (v >> np.uint64(bits)).astype(np.int64) + np.arange(i, i + len(v))
            np.bitwise_or.at(high, ones >> 3, np.left_shift(1, ones & 7).astype(np.uint8))
            at = np.arange(i, i + len(v)) * bits
            for b in range(bits):
                one = (v >> np.uint64(b)) & np.uint64(1)
                np.bitwise_or.at(low, (at + b) >> 3, (one << ((at + b) & 7).astype(np.uint64)).astype(np.uint8))
            i += len(v)
        low = low[: -(-n * bits // 8)]
        counts = np.add.reduceat(np.bitwise_count(high).astype(np.int64), np.arange(0, len(high), SAMPLE))
        before = np.concatenate([[0], np.cumsum(counts)[:-1]]).astype("<u4")
        return cls.HEAD.pack(n, bits, len(low), len(high)) + low.tobytes() + high.tobytes() + before.tobytes()

    @classmethod
    def of(cls, values: np.ndarray) -> EliasFano:
        values = np.asarray(values)
        data = cls.pack([values], len(values), int(values[-1]) if len(values) else 0)
        return cls(lambda at, size: data[at : at + size])

    def select(self, i: int, j: int | None = None) -> np.ndarray:
        """Values i to j - 1 (value i alone without j), from the samples and the blocks of high bits that hold them."""
        j = i + 1 if j is None else j
        if not 0 <= i <= j <= self.n:
            raise IndexError((i, j))
        if i == j:
            return np.zeros(0, np.int64)
        first = int(np.searchsorted(self.before, i, side="right")) - 1
        last = int(np.searchsorted(self.before, j - 1, side="right"))
        a, b = first * SAMPLE, min(last * SAMPLE, self.high_size)
        ones = np.flatnonzero(np.unpackbits(np.frombuffer(self.part(self.high_at + a, b - a), np.uint8), bitorder="little"))
        skip = i - int(self.before[first])
        high = ones[skip : skip + j - i] + 8 * a - np.arange(i, j)
        if not self.low_bits:
            return high
        a, b = i * self.low_bits // 8, -(-j * self.low_bits // 8)
        bits = np.unpackbits(np.frombuffer(self.part(self.low_at + a, b - a), np.uint8), bitorder="little")
        begin = i * self.low_bits - 8 * a
        bits = bits[begin : begin + (j - i) * self.low_bits].reshape(j - i, self.low_bits)
        low = np.zeros(j - i, np.int64)
        for k in range(self.low_bits):
            low |= bits[:, k].astype(np.int64) << k
        return (high << self.low_bits) | low


def _running(sizes: list[np.ndarray]) -> Iterator[np.ndarray]:
    """Sums of all sizes so far, a block at a time."""
    total = 0
    for s in sizes:
        out = total + np.cumsum(s, dtype=np.int64)
        total = int(out[-1]) if len(out) else total
        yield out


def _open(uri: str) -> tuple[fs.FileSystem, str]:
    return fs.FileSystem.from_uri(uri if "://" in uri or uri.startswith("file:") else f"file://{uri}")


def write(docs: DataFrame, folder: str, tokenizer: str, end_id: int = END_ID, shard_bytes: int = SHARD_BYTES) -> list[tuple[int, str, int, int]]:
    """Writes the shards; returns (shard, path, documents, ids) of each in order: a row a shard reaches the driver."""
    spark = docs.sparkSession
    bounded_batches(spark)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        code, shard = word_level(tokenizer), TaskContext.get().partitionId()
        wide = code.lib.get_vocab_size() > 1 << 16
        store, base = _open(folder)
        store.create_dir(base)
        final = f"{base}/shard-{shard:06d}.ids"
        part, out = f"{final}.{uuid.uuid4().hex}", None
        lengths, ids, total, nulls = [], [], 0, 0
        end = np.asarray([end_id], "<u4").tobytes()
        for b in batches:
            out = out or store.open_output_stream(part)
            got = [x + end for x in code(b.column(1).to_pylist())]
            flat = np.frombuffer(b"".join(got), "<u4")
            out.write(flat.astype("<u4" if wide else "<u2").tobytes())
            sizes = np.asarray([len(x) // 4 for x in got], np.int64)
            lengths.append(sizes.astype(np.uint32))
            total += int(sizes.sum())
            nulls += b.column(0).null_count
            ids.append(b.column(0).drop_null().to_numpy(zero_copy_only=False))
        if out is None:
            return
        held = sum(map(len, ids))
        least = next((int(x[0]) for x in ids if len(x)), 0)
        most = next((int(x[-1]) for x in reversed(ids) if len(x)), 0)
        n = held + nulls
        a = EliasFano.pack(_running(lengths), n, total)
        base_id = np.uint64(least & 0xFFFFFFFFFFFFFFFF)
        k = EliasFano.pack((x.astype(np.uint64) - base_id for x in ids), held, most - least)
        out.write(a + k + Trailer.FORM.pack(MAGIC, 4 if wide else 2, n, nulls, len(a), len(k), least))
        out.close()
        store.move(part, final)
        yield pa.RecordBatch.from_pydict({"shard": [shard], "path": [f"{folder}/shard-{shard:06d}.ids"], "docs": [n], "ids": [total]})

    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.coalesce("text", F.lit("")).alias("text"))
    n = max(int(spark.conf.get("spark.sql.shuffle.partitions")), -(-_bytes(rows) // shard_bytes))
    rows = rows.withColumns({"_h": F.xxhash64("text"), "_row": F.monotonically_increasing_id()})
    key = [F.col("doc_id").asc_nulls_first(), "_h", "_row"]
    rows = rows.repartitionByRange(n, *key).sortWithinPartitions(*key).select("doc_id", "text")
    return sorted(tuple(r) for r in rows.mapInArrow(run, "shard long, path string, docs long, ids long").collect())


def _bytes(rows: DataFrame) -> int:
    """The plan's size by Spark's own statistics: of files, what they take on disk; 0 where Spark doesn't know."""
    size = int(str(rows._jdf.queryExecution().optimizedPlan().stats().sizeInBytes()))
    return size if size < 1 << 60 else 0


def read(path: str, first: int = 0, block: int = 1 << 20) -> Iterator[tuple[int | None, int, np.ndarray]]:
    """(doc_id, ids of all documents before it, its ids) of each document of a shard; ``first``: ids before the shard.
    Boundaries come through ``select``, up to ``BLOCK_DOCS`` documents at a time, ids about ``block`` at a time."""
    store, base = _open(path)
    with store.open_input_file(base) as f:
        size = f.size()
        magic, width, n, nulls, a, k, least = Trailer.FORM.unpack(f.read_at(Trailer.FORM.size, size - Trailer.FORM.size))
        if magic != MAGIC:
            raise ValueError(f"not a shard: {path}")
        at = size - Trailer.FORM.size - a - k
        ends = EliasFano(lambda i, m: f.read_at(m, at + i))
        keys = EliasFano(lambda i, m: f.read_at(m, at + a + i))
        begin = 0
        for lo in range(0, n, BLOCK_DOCS):
            hi = min(n, lo + BLOCK_DOCS)
            stops = ends.select(lo, hi)
            own = [None] * max(0, min(hi, nulls) - lo) + (keys.select(max(lo, nulls) - nulls, max(hi, nulls) - nulls) + least).tolist()
            i = 0
            while i < len(stops):
                j = max(i + 1, int(np.searchsorted(stops, begin + block, side="right")))
                ids = np.frombuffer(f.read_at(int(stops[j - 1] - begin) * width, begin * width), f"<u{width}")
                start = begin
                for d in range(i, j):
                    stop = int(stops[d])
                    yield own[d], first + start, ids[start - begin : stop - begin]
                    start = stop
                i, begin = j, int(stops[j - 1])


def read_back(spark: SparkSession, shards: list[tuple[int, str, int, int]]) -> DataFrame:
    """doc_id, start, n_tokens and ids_crc32 of every document, from the files."""
    schema = "doc_id long, start long, n_tokens long, ids_crc32 long"
    if not shards:
        return spark.createDataFrame([], schema)
    before, todo = 0, []
    for shard, path, _, ids in shards:
        todo.append((shard, path, before))
        before += ids

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            for r in b.to_pylist():
                out: list[tuple] = []
                for d, start, ids in read(r["path"], r["before"]):
                    out.append((d, start, len(ids), zlib.crc32(ids.astype("<u4").tobytes())))
                    if len(out) == 20_000:
                        yield pa.RecordBatch.from_arrays([pa.array(c, pa.int64()) for c in zip(*out)], ["doc_id", "start", "n_tokens", "ids_crc32"])
                        out = []
                if out:
                    yield pa.RecordBatch.from_arrays([pa.array(c, pa.int64()) for c in zip(*out)], ["doc_id", "start", "n_tokens", "ids_crc32"])

    rows = spark.createDataFrame(todo, "shard int, path string, before long").repartition(len(todo))
    return rows.mapInArrow(run, schema)


def op5_token_files(spark: SparkSession, sf_dir: str) -> DataFrame:
    import public_tokenizers

    return read_back(spark, write(table(spark, sf_dir, "documents"), shared_dir(spark), public_tokenizers.path("word_bpe_49k.json")))

"""What the training-data operators share: shared-folder tables, batch bounds and exact chunk caches."""

from __future__ import annotations

import re
import uuid
from collections.abc import Callable
from itertools import chain

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, SparkSession

BATCH_ROWS = 1024
BATCH_BYTES = 16 << 20


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def bounded_batches(spark: SparkSession) -> None:
    """Arrow batches small enough that a few very long texts don't fill a Python worker. Spark has these limits for a
    whole session only, read when a plan runs; so every operator sets the same ones, whichever is built last."""
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", str(BATCH_ROWS))
    spark.conf.set("spark.sql.execution.arrow.maxBytesPerBatch", str(BATCH_BYTES))


def shared_dir(spark: SparkSession) -> str:
    """A new folder under ``spark.checkpoint.dir``, which driver and executors share. Where the setting is absent, a folder
    below the warehouse is used, but on a local master alone, as in tests; elsewhere that is an error."""
    base = spark.conf.get("spark.checkpoint.dir", None)
    if not base:
        if not re.fullmatch(r"local(\[.*\])?", spark.sparkContext.master):
            raise RuntimeError("set spark.checkpoint.dir to a folder that driver and executors share")
        base = f"{spark.conf.get('spark.sql.warehouse.dir').rstrip('/')}/_lindero"
    return f"{base.rstrip('/')}/lindero-{uuid.uuid4().hex}"


def materialize(df: DataFrame) -> DataFrame:
    """Write ``df`` once to the shared folder and read it back: later jobs start from the files, also after an executor
    is lost. The folder goes when the application ends; ``remove`` does it sooner."""
    spark = df.sparkSession
    path = shared_dir(spark)
    df.write.parquet(path)
    at = spark._jvm.org.apache.hadoop.fs.Path(path)
    at.getFileSystem(spark._jsc.hadoopConfiguration()).deleteOnExit(at)
    out = spark.read.schema(df.schema).parquet(path)
    out._folder = path
    return out


def remove(df: DataFrame) -> None:
    """Deletes the folder of a materialized table that nothing will read again."""
    spark = df.sparkSession
    at = spark._jvm.org.apache.hadoop.fs.Path(df._folder)
    at.getFileSystem(spark._jsc.hadoopConfiguration()).delete(at, True)


class ChunkCache:
    """chunk -> encoded form. ``fill`` encodes a list of distinct chunks at once. Memory holds two generations of about
    ``limit`` chunks: when the newer one is full the older one goes, and what is still in use moves over. That changes
    speed only."""

    def __init__(self, fill: Callable[[list], list], limit: int = 150_000):
        self.fill, self.limit = fill, limit
        self.new: dict = {}
        self.old: dict = {}

    def forms(self, chunks: list) -> list:
        """The forms of distinct chunks."""
        found = list(map(self.new.get, chunks))
        gaps = [i for i, f in enumerate(found) if f is None]
        if len(self.new) + len(gaps) > self.limit:
            self.old, self.new = self.new, {}
        missing = []
        for i in gaps:
            if (f := self.old.get(chunks[i])) is None:
                missing.append(i)
            else:
                found[i] = self.new[chunks[i]] = f
        for lo in range(0, len(missing), 20_000):
            some = missing[lo : lo + 20_000]
            for i, f in zip(some, self.fill([chunks[i] for i in some])):
                found[i] = self.new[chunks[i]] = f
        return found

    def look(self, texts: list[list]) -> list[list]:
        """The forms of all chunks of each text."""
        chunks = list(dict.fromkeys(chain.from_iterable(texts)))
        form = dict(zip(chunks, self.forms(chunks)))
        return [[form[c] for c in t] for t in texts]

    def joined(self, texts: pa.ListArray, columns: int = 1) -> list[list[bytes]]:
        """Of each text of chunks the forms laid end to end, a list for each column of the forms. Python sees each
        distinct chunk of the batch once; Arrow finds and joins them."""
        coded = texts.flatten().dictionary_encode()
        forms = self.forms(coded.dictionary.to_numpy(zero_copy_only=False).tolist())
        ends = np.asarray(texts.offsets)
        ends = ends - ends[0]
        out = []
        for k in range(columns):
            flat = pa.array(forms if columns == 1 else [f[k] for f in forms], pa.large_binary()).take(coded.indices)
            _, at, data = flat.buffers()
            at = np.frombuffer(at, np.int64)[ends].tolist() if len(flat) else [0] * len(ends)
            data = memoryview(data or b"")
            out.append([bytes(data[a:b]) for a, b in zip(at, at[1:])])
        return out


#: Where cutting at spaces, line ends and single stops and commas could part what a vocabulary joins.
_ODD = re.compile(r"\s\s|[\x01\x1c-\x1f\x85]|[\W_][.,]|^[.,]")


class Kinds:
    """The same test for texts of the first 256 characters, as byte strings: w word, s space, p other, d stop, x odd."""

    TABLE = bytes(ord("x" if re.match(r"[\x01\x1c-\x1f\x85]", c) else "s" if c.isspace() else "d" if c in ".," else "w" if c.isalnum() else "p") for c in map(chr, range(256)))


MARKED = "\x01"


def marked(text: str) -> str | None:
    """A text with ``MARKED`` between its chunks: a space begins one; a line end, and a stop or comma before a space, is
    one of its own. None where that isn't safe: runs of white space or of punctuation."""
    try:
        k = text.encode("latin-1").translate(Kinds.TABLE)
        if b"ss" in k or b"x" in k or b"sd" in k or b"pd" in k or b"dd" in k or k[:1] == b"d":
            return None
    except UnicodeEncodeError:
        if _ODD.search(text):
            return None
    return text.replace(" ", "\x01 ").replace("\n", "\x01\n\x01").replace(",\x01", "\x01,\x01").replace(".\x01", "\x01.\x01")


def cut(text: str) -> list[str] | None:
    """The chunks of ``marked``. Concatenated, they are the text."""
    return None if (m := marked(text)) is None else m.split(MARKED)


def chunks_of(texts: list[str], separator: str = MARKED) -> pa.ListArray:
    return pc.split_pattern(pa.array(texts, pa.string()), pattern=separator)

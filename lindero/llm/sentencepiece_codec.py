"""SentencePiece encoding and decoding of merge-type (BPE) vocabularies with byte fallback.

The encoder is a score-ordered agenda of adjacent symbol pairs: the best pair is merged, its new neighbours join the
agenda, until no adjacent pair is a piece. A piece of the vocabulary never continues over a space mark that follows
another character, so a text is cut there without changing the result (checked when a model is loaded); each distinct
chunk is encoded once per worker. In every Arrow batch all new chunks, ids and decoded text alike, are checked against
the sentencepiece library, and one whole text of the batch (the longest of up to ``CHECKED`` characters) besides.

Defined cases: a null or empty text has no tokens and decodes to ''. Repeated rows give repeated results. An empty
table gives an empty table. Other columns of the input are ignored, whatever their names.
"""

from __future__ import annotations

import hashlib
import re
from collections.abc import Iterator
from functools import lru_cache
from heapq import heapify, heappop, heappush

import pyarrow as pa
import regex
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .common import ChunkCache, bounded_batches, chunks_of, marked, table

MARK = "▁"
CHECKED = 20_000
_LETTER = regex.compile(r"[\p{L}\p{Nd}\p{M}]")
_CHUNK = re.compile(f"{MARK}+[^{MARK}]*")
SCHEMA = "doc_id long, n_tokens long, ids_sha256 string, decoded_sha256 string"


def _kind(c: str) -> int:
    return 0 if c == MARK else 1 if _LETTER.match(c) else 2


class Codec:
    def __init__(self, path: str):
        import sentencepiece

        self.lib = sp = sentencepiece.SentencePieceProcessor(model_file=path)
        n = sp.get_piece_size()
        self.pieces = [sp.id_to_piece(i) for i in range(n)]
        self.byte_ids = {int(self.pieces[i][3:5], 16): i for i in range(n) if sp.is_byte(i)}
        self.bytes_of = {i: b for b, i in self.byte_ids.items()}
        special = {i for i in range(n) if sp.is_control(i) or sp.is_unknown(i)} | set(self.bytes_of)
        ids = {p: i for i, p in enumerate(self.pieces) if i not in special}
        order = {s: k for k, s in enumerate(sorted({sp.get_score(i) for i in ids.values()}, reverse=True))}
        self.ids, self.rank = ids, {p: order[sp.get_score(i)] for p, i in ids.items()}
        self.unknown = sp.unk_id()
        meets = {(_kind(a), _kind(b)) for p in ids for a, b in zip(p, p[1:])}
        if {(1, 0), (2, 0)} & meets or not self.byte_ids:
            raise ValueError("pieces continue over spaces, or the vocabulary has no byte fallback")
        self.finer = not {(1, 2), (2, 1)} & meets and not any("\n" in p for p in ids)
        self.units = regex.compile(rf"{MARK}*[\p{{L}}\p{{Nd}}\p{{M}}]+|{MARK}*[^\p{{L}}\p{{Nd}}\p{{M}}{MARK}]+|{MARK}+").findall
        self.cache = ChunkCache(self._fill, 250_000)

    def agenda(self, symbols: str) -> list[int]:
        """Ids of one run of characters, in which spaces are marks already."""
        rank, n = self.rank, len(symbols)
        sym: list[str | None] = list(symbols)
        before, after = list(range(-1, n - 1)), [*range(1, n), -1]
        heap = [(r << 32) | i for i in range(n - 1) if (r := rank.get(symbols[i : i + 2])) is not None]
        heapify(heap)
        while heap:
            top = heappop(heap)
            i = top & 0xFFFFFFFF
            if sym[i] is None or (j := after[i]) < 0 or rank.get(both := sym[i] + sym[j]) != top >> 32:
                continue
            sym[i], sym[j] = both, None
            after[i] = k = after[j]
            if k >= 0:
                before[k] = i
                if (r := rank.get(both + sym[k])) is not None:
                    heappush(heap, (r << 32) | i)
            if (h := before[i]) >= 0 and (r := rank.get(sym[h] + both)) is not None:
                heappush(heap, (r << 32) | h)
        out: list[int] = []
        for s in sym:
            if s is not None:
                i = self.ids.get(s)
                out += [i] if i is not None else [self.byte_ids[b] for b in s.encode()]
        return out

    def decode(self, ids: list[int]) -> str:
        """Text of ids, with the spaces that the marks stand for; the first mark is still a space."""
        out, run = [], bytearray()
        for i in ids:
            if (b := self.bytes_of.get(i)) is not None:
                run.append(b)
                continue
            if run:
                out.append(run.decode("utf-8", "replace"))
                run.clear()
            out.append(self.pieces[i].replace(MARK, " "))
        if run:
            out.append(run.decode("utf-8", "replace"))
        return "".join(out)

    def _marked(self, text: str) -> str | None:
        return marked(" " + text) if self.finer and text[:1] not in " .," and MARK not in text else None

    def _parts(self, text: str) -> list[str]:
        """Chunks, in which spaces are marks, that no piece reaches beyond."""
        if not text:
            return []
        return [x for c in _CHUNK.findall(MARK + text.replace(" ", MARK)) for x in (self.units(c) if self.finer else [c])]

    def _fill(self, chunks: list[str]) -> list[tuple[bytes, bytes]]:
        """(ids in decimal, a comma after each; text) of each chunk; the library must give the same ids. It sets a mark before a text, so a
        chunk without one is shown to it after a line end, which no piece contains."""
        marked = [MARK + c[1:] if c[:1] == " " else c for c in chunks]
        own = [self.agenda(c) for c in marked]
        lib = self.lib.encode([c[1:] if c[:1] == MARK else "\n" + c for c in marked], num_threads=1)
        texts = self.lib.decode(own)
        out = []
        for c, a, b, t in zip(marked, own, lib, texts):
            text = self.decode(a)
            # the library drops the mark that it sets before a text; a mark alone is what that leaves of one space
            if c and (a != (b if c[:1] == MARK else b[2:]) and c != MARK or t != (text[1:] if c[:1] == MARK else text)):
                raise AssertionError(f"differs from the library: {c!r}")
            out.append(("".join([f"{i}," for i in a]).encode(), text.encode()))
        return out

    def check(self, text: str, joined: bytes, decoded: bytes) -> None:
        """The ids of a whole text, across its chunks, and what they decode to, against the library."""
        ids = self.lib.encode(text)
        if joined != ",".join(map(str, ids)).encode() or decoded != self.lib.decode(ids).encode():
            raise AssertionError(f"differs from the library: {text[:200]!r}")

    def __call__(self, texts: list[str]) -> Iterator[tuple[bytes, bytes]]:
        """Per text: its ids in decimal, joined by commas; what they decode to."""
        cuts = [self._marked(t) for t in texts]
        found = zip(*self.cache.joined(chunks_of([c for c in cuts if c is not None]), 2))
        lists = pa.array([self._parts(t) for t, c in zip(texts, cuts) if c is None], pa.list_(pa.string()))
        other = zip(*self.cache.joined(lists, 2))
        for c in cuts:
            ids, text = next(other if c is None else found)
            yield ids[:-1], text[1:]


@lru_cache(maxsize=2)
def codec(path: str) -> Codec:
    return Codec(path)


def encode(docs: DataFrame, model: str, ids: bool = False) -> DataFrame:
    """doc_id, n_tokens and digests per document; with ``ids`` also the ids and the decoded text."""
    bounded_batches(docs.sparkSession)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        code = codec(model)
        for b in batches:
            out: list[list] = [[], [], [], [], []]
            texts = b.column(1).to_pylist()
            checked = max((i for i, t in enumerate(texts) if len(t) <= CHECKED), key=lambda i: len(texts[i]), default=-1)
            for i, (joined, text) in enumerate(code(texts)):
                if i == checked:
                    code.check(texts[i], joined, text)
                out[0].append(joined.count(b",") + 1 if joined else 0)
                out[1].append(hashlib.sha256(joined).hexdigest())
                out[2].append(hashlib.sha256(text).hexdigest())
                if ids:
                    out[3].append([int(i) for i in joined.split(b",")] if joined else [])
                    out[4].append(text.decode())
            cols = [b.column(0), pa.array(out[0], pa.int64()), pa.array(out[1], pa.string()), pa.array(out[2], pa.string())]
            names = ["doc_id", "n_tokens", "ids_sha256", "decoded_sha256"]
            if ids:
                cols += [pa.array(out[3], pa.list_(pa.int32())), pa.array(out[4], pa.string())]
                names += ["ids", "decoded"]
            yield pa.RecordBatch.from_arrays(cols, names)

    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.coalesce("text", F.lit("")).alias("text"))
    return rows.mapInArrow(run, SCHEMA + (", ids array<int>, decoded string" if ids else ""))


def op2_sentencepiece(spark: SparkSession, sf_dir: str) -> DataFrame:
    import public_tokenizers

    return encode(table(spark, sf_dir, "documents"), public_tokenizers.path("piece_bpe_32k.model"))

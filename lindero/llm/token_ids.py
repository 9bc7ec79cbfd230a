"""Exact ids of the installed ``tokenizers`` vocabularies, by chunks.

Where a vocabulary has no token that continues over a place where ``common.cut`` cuts, every chunk's ids may be kept in a
bounded cache. That, and that ids rise in the order of merges where ``tiktoken`` merges, is checked when a file is
opened; where it doesn't hold, the library encodes. Texts that can't be cut go to it whole (byte-level) or are cut at
spaces alone.
"""

from __future__ import annotations

import json
import os
import re
from functools import lru_cache
from itertools import accumulate, chain

import numpy as np

from .common import ChunkCache, chunks_of, marked

#: How byte-level vocabularies split a text.
PIECES = r"""'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"""


def _bytes_of_letters() -> dict[str, int]:
    """Byte-level vocabularies write each byte as one printable character."""
    plain = [*range(33, 127), *range(161, 173), *range(174, 256)]
    other = [b for b in range(256) if b not in plain]
    return {chr(b): b for b in plain} | {chr(256 + i): b for i, b in enumerate(other)}


def _flat(ids: list[list[int]]) -> list[bytes]:
    """Each list as little-endian unsigned 32-bit integers."""
    ends = list(accumulate(4 * len(x) for x in ids))
    flat = np.fromiter(chain.from_iterable(ids), "<u4", ends[-1] // 4 if ends else 0).tobytes()
    return [flat[a:b] for a, b in zip([0, *ends], ends)]


#: What no token may hold if texts are cut as ``common.marked`` does: more than white space before a space or beside a line
#: end, or a stop or comma at its end after a word.
_OVER = re.compile(r"[^\s] |[^\s]\n|\n[^\s]|[^\W_][.,]$")


def _merges(lib, vocab: dict[str, int]) -> list[int]:
    """The id that each merge makes, in the order of merges."""
    merges = json.loads(lib.to_str())["model"]["merges"]
    return [vocab[a + b] for a, b in (m.split(" ") if isinstance(m, str) else m for m in merges)]


class ByteLevelIds:
    """Ids where a space belongs to the word after it. New chunks are merged by ``tiktoken`` with the ranks of the
    ``tokenizers`` file itself, four times as fast; chunks with a special token's string go to ``tokenizers``."""

    def __init__(self, path: str):
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        import tiktoken
        from tokenizers import Tokenizer

        self.lib = Tokenizer.from_file(path)
        self.special = [t.content for t in self.lib.get_added_tokens_decoder().values()]
        letters = _bytes_of_letters()
        vocab = self.lib.get_vocab()
        ranks = {bytes(letters[c] for c in t): i for t, i in vocab.items() if t not in self.special}
        made = _merges(self.lib, vocab)
        self.cuts = all(a < b for a, b in zip(made, made[1:])) and not any(_OVER.search(t.decode("utf-8", "replace")) for t in ranks)
        self.core = tiktoken.Encoding("vocabulary", pat_str=PIECES, mergeable_ranks=ranks, special_tokens={})._core_bpe
        self.cache = ChunkCache(self._fill)

    def _whole(self, text: str) -> bytes:
        return np.asarray(self.lib.encode(text, add_special_tokens=False).ids, "<u4").tobytes()

    def _fill(self, chunks: list[str]) -> list[bytes]:
        whole, one = self.core.encode_ordinary, self.core.encode_single_piece
        ids = [one(c.encode()) if c[1:].isalpha() and (c[0] == " " or c[0].isalpha()) else whole(c) for c in chunks]
        return _flat(ids)

    def __call__(self, texts: list[str]) -> list[bytes]:
        """Little-endian unsigned 32-bit ids of each whole text."""
        parts = [None if not self.cuts or any(s in t for s in self.special) else marked(t) for t in texts]
        found = iter(self.cache.joined(chunks_of([p for p in parts if p is not None]))[0])
        return [self._whole(t) if p is None else next(found) for t, p in zip(texts, parts)]


#: Chunks of these letters alone are the same under NFC, and Python lower-cases them as the library does.
_LATIN = re.compile(r"[!-~À-ÖØ-öø-ÿ]+")
_WORDS = re.compile(r"'s|'t|'re|'ve|'m|'ll|'d|[a-zß-öø-ÿ]+|[0-9]|[^a-zß-öø-ÿ0-9]+")


def _first_256(text: str) -> bool:
    try:
        text.encode("latin-1")
    except UnicodeEncodeError:
        return False
    return True


#: Bytes of lower-case letters, a code for each of them, and the code of each at the end of a word.
_LETTERS = sorted({b for c in map(chr, [*range(97, 123), *range(0xDF, 0xF7), *range(0xF8, 0x100)]) for b in c.encode()})
_CODES = bytes(_LETTERS.index(b) if b in _LETTERS else 127 for b in range(256))
_LAST = [bytes([128 | c]) for c in range(128)]


class WordLevelIds:
    """Ids where white space is dropped and words have ends. A new chunk is cut into words; words of letters alone are
    merged by ``tiktoken``, others go to ``tokenizers`` many at a time, and the ids that end words tell them apart again.

    ``tiktoken`` merges bytes, but here the last byte of a word is a symbol apart from the same byte within it. Letters
    need few of the 256 bytes, so each has one code within a word and one, 128 higher, at its end. Where ids rise in
    the order of merges, the result is the same; else all words go to ``tokenizers``."""

    def __init__(self, path: str):
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        from tokenizers import Tokenizer

        self.lib = Tokenizer.from_file(path)
        self.ends = np.zeros(self.lib.get_vocab_size(), bool)
        self.ends[[i for t, i in self.lib.get_vocab().items() if t.endswith("</w>")]] = True
        self.cache, self.words = ChunkCache(self._chunks), ChunkCache(self._words, 200_000)
        self.core = self._core()

    def _core(self):
        import tiktoken

        vocab = self.lib.get_vocab()
        made = _merges(self.lib, vocab)
        if any(a >= b for a, b in zip(made, made[1:])):
            return None
        letters, ranks = _bytes_of_letters(), {}
        for t, i in vocab.items():
            body = t.removesuffix("</w>")
            if body and all(letters.get(c) in _LETTERS for c in body):
                piece = bytes(letters[c] for c in body).translate(_CODES)
                ranks[piece if body == t else piece[:-1] + _LAST[piece[-1]]] = i
        return tiktoken.Encoding("words", pat_str=PIECES, mergeable_ranks=ranks, special_tokens={})._core_bpe

    def _encode(self, texts: list[str]) -> list[np.ndarray]:
        return [np.asarray(e.ids, "<u4") for e in self.lib.encode_batch_fast(texts, add_special_tokens=False)]

    def _letters(self, words: list[str]) -> list[bytes]:
        """Words of lower-case letters alone."""
        if self.core is None:
            return self._words(words)
        one, codes, last = self.core.encode_single_piece, _CODES, _LAST
        return _flat([one(b[:-1] + last[b[-1]]) for b in (w.encode().translate(codes) for w in words)])

    def _words(self, words: list[str]) -> list[bytes]:
        out: list[bytes] = []
        for i in range(0, len(words), 1000):
            ids = self._encode([" ".join(words[i : i + 1000])])[0]
            ends = (4 * np.flatnonzero(self.ends[ids]) + 4).tolist()
            flat = ids.tobytes()
            out += [flat[a:b] for a, b in zip([0, *ends[:-1]], ends)]
        assert len(out) == len(words)
        return out

    def _chunks(self, chunks: list[str]) -> list[bytes]:
        """A chunk may have a space before it."""
        latin, words = _LATIN.fullmatch, _WORDS.findall
        bare = [c[1:] if c[:1] == " " else c for c in chunks]
        plain = [c for c in bare if c.isalpha() and c.islower() and latin(c)]
        out = dict(zip(plain, self._letters(plain)))
        rest = list({c for c in bare if c not in out})
        parts = [words(c.lower()) if latin(c) and "<|" not in c else None for c in rest]
        forms = self.words.look([p or () for p in parts])
        other = iter(self._encode([c for c, p in zip(rest, parts) if p is None]))
        out.update((c, next(other).tobytes() if p is None else b"".join(f)) for c, p, f in zip(rest, parts, forms))
        return [out[c] for c in bare]

    def __call__(self, texts: list[str]) -> list[bytes]:
        """Little-endian unsigned 32-bit ids of each whole text."""
        parts = [marked(t.lower()) if t.isascii() or _first_256(t) else None for t in texts]
        found = iter(self.cache.joined(chunks_of([p for p in parts if p is not None]))[0])
        other = iter(self.cache.joined(chunks_of([t for t, p in zip(texts, parts) if p is None], " "))[0])
        return [next(other if p is None else found) for p in parts]


@lru_cache(maxsize=4)
def byte_level(path: str) -> ByteLevelIds:
    return ByteLevelIds(path)


@lru_cache(maxsize=4)
def word_level(path: str) -> WordLevelIds:
    return WordLevelIds(path)

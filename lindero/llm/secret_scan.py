"""Secret scans: fixed patterns, and a character convolutional network over every candidate and its context.

Candidates are the maximal runs of ``LEAST`` or more of the characters that keys are made of, less what the fixed
patterns cover, in the whole text. Only a run that is plainly words is none: letters of one case or capitalised, alone
or joined by stops and hyphens, each word under ``WORD`` letters and without ``CLUSTER`` consonants in a row. So
letters-only keys and short passwords are candidates as well. A long run is read in overlapping windows. The network
(numpy: one convolution, pooling inside the candidate and over its context, one output) is trained on
``labelled_findings``, in three parts: one fits it, one calibrates it (Platt), and on the third the threshold is the
highest that still finds ``RECALL`` of the secrets. It adds spans of kind ``learned``; spans of the patterns stay.

Defined cases: a null or empty text has no spans and the digest of ''. Equal rows give equal results. An empty table
gives an empty table. Other columns are ignored by ``scan``, whatever their names. Rows are judged one by one: nothing
is shuffled, and memory holds one Arrow batch.
"""

from __future__ import annotations

import hashlib
import re
from collections.abc import Iterator
from dataclasses import dataclass
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .common import bounded_batches, table

KINDS = ("assign", "access", "hex", "learned")
RECALL = 0.98
N_FINDINGS = 4800
LEAST, WORD = 8, 20
ALONG, AROUND, WIDTH, FILTERS = 64, 24, 5, 24
SIZE = ALONG + 2 * AROUND
REDACTED = "<SECRET>"

_RUN = re.compile(rf"(?<![A-Za-z0-9+/_.=-])[A-Za-z0-9+/_.=-]{{{LEAST},}}")
#: What plain words, alone or joined by stops and hyphens, don't have.
_ODD = re.compile(rf"[0-9+/_=]|[a-z][A-Z]|[A-Z]{{2}}[a-z]|[A-Za-z]{{{WORD}}}")
_HEX = re.compile(r"[0-9a-f]{32,}")
_ACCESS = re.compile(r"AKIA[A-Z0-9]+")
_ASSIGN = re.compile(r"""(password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""", re.IGNORECASE | re.ASCII)
_GROUPS = ("aeiou", "bcdf", "ghjklmnpqrstvwxyz", "AEIOU", "BCDF", "GHJKLMNPQRSTVWXYZ", "0123456789", "+/", "_", ".", "=", "-", " \t\n", "\"'`", ":;,")


class Letters:
    TABLE = np.full(128, len(_GROUPS), np.int64)
    for _i, _g in enumerate(_GROUPS):
        for _c in _g:
            TABLE[ord(_c)] = _i


CHANNELS = len(_GROUPS) + 3  # groups, other, beyond the text, inside the candidate


def windows(text: str, start: int, end: int) -> list[tuple[str, int, int, int]]:
    """(characters, how many are missing before the text, inside from, inside to) of each window of a candidate."""
    out = []
    for a in range(start, max(start + 1, end - ALONG // 2), ALONG // 2):
        b = min(end, a + ALONG)
        lo = a - AROUND
        out.append((text[max(0, lo) : b + AROUND], max(0, -lo), AROUND, AROUND + b - a))
        if b == end:
            break
    return out


def features(items: list[tuple[str, int, int, int]]) -> tuple[np.ndarray, np.ndarray]:
    """One-hot characters with the inside flag, and the inside flag alone."""
    kind = np.full((len(items), SIZE), CHANNELS - 2, np.int64)
    inside = np.zeros((len(items), SIZE), bool)
    for r, (chars, gap, a, b) in enumerate(items):
        codes = np.frombuffer(chars.encode("utf-32-le"), np.uint32)
        kind[r, gap : gap + len(codes)] = np.where(codes < 128, Letters.TABLE[np.minimum(codes, 127)], len(_GROUPS))
        inside[r, a:b] = True
    x = np.zeros((len(items), SIZE, CHANNELS), np.float32)
    np.put_along_axis(x, kind[:, :, None], 1, axis=2)
    x[:, :, -1] = inside
    return x, inside


@dataclass
class Network:
    conv: np.ndarray
    shift: np.ndarray
    out: np.ndarray
    lean: float
    scale: tuple[float, float] = (1.0, 0.0)
    threshold: float = 0.5

    def forward(self, x: np.ndarray, inside: np.ndarray):
        cols = np.lib.stride_tricks.sliding_window_view(x, WIDTH, axis=1)  # item, place, channel, offset
        cols = cols.reshape(*cols.shape[:2], -1)
        h = np.maximum(cols @ self.conv + self.shift, 0)
        m = inside[:, WIDTH // 2 : WIDTH // 2 + h.shape[1], None]
        n = np.maximum(m.sum(axis=1), 1)
        within = np.where(m, h, 0)
        top, beside = within.argmax(axis=1), np.where(m, 0, h).argmax(axis=1)
        take = lambda i: np.take_along_axis(h, i[:, None], 1)[:, 0]
        pooled = np.concatenate([take(top), within.sum(axis=1) / n, take(beside)], axis=1)
        return pooled @ self.out + self.lean, (cols, h, m, n, top, beside, pooled)

    def step(self, x: np.ndarray, inside: np.ndarray, y: np.ndarray, rate: float) -> None:
        z, (cols, h, m, n, top, beside, pooled) = self.forward(x, inside)
        d = (1 / (1 + np.exp(-z)) - y) / len(y)
        g = d[:, None] * self.out
        dh = np.where(m, (g[:, FILTERS : 2 * FILTERS] / n)[:, None, :], 0)
        rows, cells = np.arange(len(y))[:, None], np.arange(FILTERS)[None]
        np.add.at(dh, (rows, top, cells), g[:, :FILTERS])
        np.add.at(dh, (rows, beside, cells), g[:, 2 * FILTERS :])
        dh *= h > 0
        self.out -= rate * pooled.T @ d
        self.lean -= rate * d.sum()
        self.conv -= rate * cols.reshape(-1, cols.shape[2]).T @ dh.reshape(-1, FILTERS)
        self.shift -= rate * dh.sum(axis=(0, 1))

    def score(self, items: list[tuple[str, int, int, int]]) -> np.ndarray:
        out = [np.zeros(0)]
        for i in range(0, len(items), 256):
            z = self.forward(*features(items[i : i + 256]))[0]
            out.append(1 / (1 + np.exp(-np.clip(self.scale[0] * z + self.scale[1], -30, 30))))
        return np.concatenate(out)


LOW, UP, DIG = "abcdefghijklmnopqrstuvwxyz", "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "0123456789"
SYLLABLES = "th er on an re he in ed nd ha at en es of nt ea ti to io le is ou ar as de rt ve que ment ión sch ung lich eau aux st sh wh ly ing tion ble".split()


def shapes(rng: np.random.Generator) -> tuple[dict, dict]:
    """Makers of secrets and of harmless runs, by name."""
    draw = lambda chars, a, b=None: "".join(rng.choice(list(chars), a if b is None else rng.integers(a, b)))
    word = lambda k=5: "".join(rng.choice(SYLLABLES, rng.integers(1, k)))
    num = lambda k: str(rng.integers(10 ** (k - 1), 10**k))
    two = lambda: f"{rng.integers(100):02d}"
    secret = {
        "mixed": lambda: draw(LOW + UP + DIG, 16, 60), "base64": lambda: draw(LOW + UP + DIG + "+/", 20, 60) + "=" * int(rng.integers(0, 3)), "hex": lambda: draw("0123456789abcdef", 16, 64),
        "cloud id": lambda: "AKIA" + draw(UP + DIG, 16), "repository": lambda: "ghp_" + draw(LOW + UP + DIG, 36), "payment": lambda: "sk_live_" + draw(LOW + UP + DIG, 24),
        "chat": lambda: f"xoxb-{draw(DIG, 11)}-{draw(LOW + UP + DIG, 24)}", "signed": lambda: f"eyJ{draw(LOW + UP + DIG, 17)}.{draw(LOW + UP + DIG + '_-', 40)}.{draw(LOW + UP + DIG + '_-', 30)}", "maps": lambda: "AIza" + draw(LOW + UP + DIG + "_-", 35),
        "upper and digits": lambda: draw(UP + DIG, 18, 40), "lower and digits": lambda: draw(LOW + DIG, 18, 40), "letters": lambda: draw(LOW + UP, 16, 48), "lower": lambda: draw(LOW, 20, 40), "upper": lambda: draw(UP, 20, 40), "short": lambda: draw(LOW + UP + DIG, 10, 16),
    }
    harmless = {
        "slug": lambda: f"{word()}-{word()}-{num(2)}-{word()}", "address": lambda: f"{word()}.example.{rng.choice(['net', 'com', 'org'])}/{rng.choice(['en', 'fr', 'de'])}/{num(5)}.html", "instant": lambda: f"2{num(3)}-0{num(1)}-1{num(1)}T1{num(1)}",
        "name": lambda: f"{word()}_{word()}_{num(2)}_{word()}", "numbers": lambda: f"{num(3)}.{num(3)}.{num(3)}.{num(2)}", "sentence end": lambda: f"{word()}{word()}.{num(4)}", "telephone": lambda: f"+{num(2)}-{num(3)}-{num(3)}-{num(4)}", "decimal": lambda: f"{num(6)}.{num(7)}",
        "link": lambda: f"//www.{word()}{word()}.org/{num(4)}/{word()}", "file": lambda: f"{word()}/{word()}/{word()}{num(1)}.txt", "long number": lambda: num(rng.integers(8, 17)), "rule": lambda: "=-_."[rng.integers(4)] * int(rng.integers(8, 40)), "dots": lambda: f"{word()}...{word()}{num(1)}.{word()}",
        "license": lambda: f"BY-{UP[rng.integers(26)]}C-4.0-{word()}-{num(1)}.0", "shout": lambda: f"{word().upper()}{word().upper()}-{word().upper()}{num(2)}", "camel": lambda: f"{word().title()}{word().title()}{word().title()}{num(2)}", "card": lambda: f"{num(4)}-{num(4)}-{num(4)}-{num(4)}", "account": lambda: f"DE{num(10)}{num(10)}",
        "date": lambda: f"{num(4)}-{two()}-{two()}", "version": lambda: f"v{num(1)}.{num(2)}.{num(1)}-{word()}", "clustered": lambda: "".join(rng.choice(["nd", "th", "st", "sh", "wh", "nt", "rt", "sch", "ngth", "lich", "an", "er", "ly"], rng.integers(4, 9))), "compound": lambda: word(9) + word(9),
        "clustered title": lambda: "".join(rng.choice(["nd", "th", "st", "sh", "wh", "nt", "rt", "sch", "ea"], rng.integers(4, 9))).title(), "function": lambda: f"{word()}{word().title()}{word().title()}", "clustered shout": lambda: "".join(rng.choice(["ND", "TH", "ST", "SH", "WH", "NT", "ED", "ER"], rng.integers(4, 9))), "path": lambda: f"{word()}/{word()}/{word()}",
        "joined": lambda: f"{word()}_{word()}_{word()}", "snake": lambda: f"{word()}_{word()}{num(1)}", "label": lambda: f"{word()}{word()}={word()}", "month": lambda: f"{two()}/{two()}/{num(4)}", "hours": lambda: f"{two()}.{two()}-{two()}.{two()}", "doubled": lambda: UP[rng.integers(26)] * 2 + word() + word(), "part": lambda: f"{word(3).upper()}-{num(4)}-{num(2)}",
    }
    return secret, harmless


def labelled_findings(n: int = N_FINDINGS, seed: int = 7, without: frozenset = frozenset(), only: frozenset | None = None) -> list[tuple[str, int, int, int]]:
    """(text, start, end, label): keys of many issuers' shapes, and runs of like length that are no secrets. ``without`` and
    ``only`` name shapes of secrets to leave out or to keep to."""
    rng = np.random.default_rng(seed)
    secret, harmless = shapes(rng)
    secret, harmless = [f for k, f in secret.items() if k not in without and (only is None or k in only)], list(harmless.values())
    word = lambda: "".join(rng.choice(SYLLABLES, rng.integers(1, 5)))
    plain = lambda: " ".join(word() for _ in range(rng.integers(1, 7)))
    lead = ["key: ", "Authorization: Bearer ", "secret is ", 'KEY="', "aws_key=", "export X=", "credential ", "pwd ", "", "", "", "", "", ""]
    out = []
    for k in range(n):
        y = k % 2
        made = (secret if y else harmless)[rng.integers(len(secret if y else harmless))]()
        while len(made) < LEAST:
            made += "." + word()
        front = plain() + " " + (lead[rng.integers(len(lead))] if y or rng.random() < 0.1 else "")
        out.append((front + made + rng.choice([" ", ". ", '" ', "\n"]) + plain(), len(front), len(front) + len(made), y))
    return out


@lru_cache(maxsize=4)
def train(n: int = N_FINDINGS, recall: float = RECALL, epochs: int = 6, seed: int = 7, without: frozenset = frozenset()) -> Network:
    rng = np.random.default_rng(seed)
    found = labelled_findings(n, seed, without)
    items = [windows(t, a, b)[0] for t, a, b, _ in found]
    y = np.asarray([f[3] for f in found], np.float32)
    turn = np.arange(n) // 2 % 4
    fit, tune, held = np.flatnonzero(turn < 2), np.flatnonzero(turn == 2), np.flatnonzero(turn == 3)
    net = Network((rng.normal(size=(WIDTH * CHANNELS, FILTERS)) * 0.15).astype(np.float32), np.zeros(FILTERS, np.float32), (rng.normal(size=3 * FILTERS) * 0.15).astype(np.float32), 0.0)
    for epoch in range(epochs):
        for at in np.array_split(rng.permutation(fit), max(1, len(fit) // 32)):
            net.step(*features([items[i] for i in at]), y[at], 0.4 / (1 + epoch / 3))
    z = np.concatenate([net.forward(*features([items[i] for i in tune[k : k + 256]]))[0] for k in range(0, len(tune), 256)])
    a, b = 1.0, 0.0
    for _ in range(200):  # Platt's scaling
        d = 1 / (1 + np.exp(-np.clip(a * z + b, -30, 30))) - y[tune]
        a, b = a - 0.05 * float((d * z).mean()), b - 0.5 * float(d.mean())
    net.scale = (a, b)
    p = np.sort(net.score([items[i] for i in held])[y[held] == 1])
    net.threshold = float(p[int((1 - recall) * len(p))])
    return net


def base_spans(text: str) -> list[tuple[int, int, int]]:
    """(start, kind, end) of the fixed patterns."""
    out = []
    low = text.lower()
    if "passw" in low or "secret" in low or "token" in low or "api" in low:
        out += [(m.start(), 0, m.end()) for m in _ASSIGN.finditer(text) if m.end(2) - m.start(2) >= 8]
    if "AKIA" in text:
        out += [(m.start(), 1, m.end()) for m in _ACCESS.finditer(text) if m.end() - m.start() >= 16]
    return out


def rests(a: int, b: int, own: list[tuple[int, int, int]]) -> list[tuple[int, int]]:
    """The parts of [a, b) that no span covers."""
    out = []
    for s, _, e in own:
        if e > a and s < b:
            if s > a:
                out.append((a, s))
            a = max(a, e)
    return [*out, (a, b)] if a < b else out


def spans_of(texts: list[str], net: Network) -> list[list[tuple[int, int, int]]]:
    """Sorted (start, kind, end) of each text."""
    found, asked, items = [], [], []
    for t, text in enumerate(texts):
        own = base_spans(text)
        runs = [m.span() for m in _RUN.finditer(text)]
        for a, b in runs:
            if b - a >= 32:
                own += [(m.start(), 2, m.end()) for m in _HEX.finditer(text, a, b)]
        own.sort()
        found.append(own)
        for a, b in runs:
            if _ODD.search(text, a, b):
                for c, d in rests(a, b, own) if own else [(a, b)]:
                    if d - c >= LEAST and _ODD.search(text, c, d):
                        got = windows(text, c, d)
                        items += got
                        asked.append((t, c, d, len(got)))
    at, scores = 0, net.score(items)
    for t, a, b, n in asked:
        if scores[at : at + n].max() >= net.threshold:
            found[t].append((a, 3, b))
        at += n
    for own in found:
        own.sort()
    return found


def _join(spans: list[tuple[int, int, int]]) -> str:
    return ",".join(f"{KINDS[k]}:{a}:{b}" for a, k, b in spans)


SCHEMA = "doc_id long, n_assign long, n_access long, n_hex long, base_sha256 string, spans string, n_learned long"


def scan(docs: DataFrame, net: Network | None = None) -> DataFrame:
    bounded_batches(docs.sparkSession)
    net = net or train()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            found = spans_of(b.column(1).to_pylist(), net)
            count = lambda k: pa.array([sum(s[1] == k for s in x) for x in found], pa.int64())
            base = [hashlib.sha256(_join([s for s in x if s[1] < 3]).encode()).hexdigest() for x in found]
            cols = [b.column(0), count(0), count(1), count(2), pa.array(base, pa.string()), pa.array([_join(x) for x in found], pa.string()), count(3)]
            yield pa.RecordBatch.from_arrays(cols, ["doc_id", "n_assign", "n_access", "n_hex", "base_sha256", "spans", "n_learned"])

    return docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.coalesce("text", F.lit("")).alias("text")).mapInArrow(run, SCHEMA)


def redact(docs: DataFrame, net: Network | None = None) -> DataFrame:
    """The same documents and columns, with every span replaced. Overlapping spans become one mark; a null text stays null."""
    bounded_batches(docs.sparkSession)
    net = net or train()
    at = docs.columns.index("text")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            texts = b.column(at).to_pylist()
            out = []
            for text, found in zip(texts, spans_of([t or "" for t in texts], net)):
                parts, done = [], 0
                for a, _, e in found:
                    if a >= done:
                        parts += [text[done:a], REDACTED]
                    done = max(done, e)
                out.append("".join([*parts, text[done:]]) if found else text)
            cols = [pa.array(out, pa.string()) if i == at else c for i, c in enumerate(b.columns)]
            yield pa.RecordBatch.from_arrays(cols, b.schema.names)

    return docs.mapInArrow(run, docs.schema)


def op1_secret_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    return scan(table(spark, sf_dir, "documents"))

"""Quality classifier by co-training of two views: text content, and page metadata.

Two logistic regressions are trained on a bounded sample of labelled documents: one on hashed words and how they repeat,
one on what is known of a page without reading its words, that is language, source, size, layout (lines, blank lines,
white space) and make-up (capitals, digits, marks). In each round either view hands its surest verdicts on an
unlabelled pool to the other as pseudo-labels: of each class so many as its share of the labels, surest first, but none
below the logit from which on the view is right in ``PRECISION`` of the cases of a part of the labels kept for that.
Both views are then calibrated and combined on held-out labels, and every document is scored. ``KEEP`` sets the
threshold: the share of good held-out documents that must stay.

Bounds, all parameters: ``LABELLED`` labelled documents and ``POOL`` unlabelled ones, those with the smallest hashes of
their ids, are all that the driver sees, as hashed features. The pool is taken from documents without a label. It
bounds what pseudo-labels can be given, nothing else: scoring covers every whole text.

Defined cases: a null text is an empty one; an empty text has the statistics 0 and is judged by its metadata as well.
Null metadata is a value of its own. Of rows with one doc_id the one with the least text hash trains. Documents
labelled both ways do not train. Without both labels nothing can be learned: every score is 0.5 and every document
stays. Equal rows get equal scores, an empty table gives an empty table. Extra columns are ignored by ``score`` and stay
in ``keep``, whatever their names.
"""

from __future__ import annotations

import zlib
from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .common import bounded_batches, table

LABELLED, POOL = 3000, 2000
ROUNDS = 3
PRECISION = 0.95
PER_ROUND = 200
KEEP = 0.998
BUCKETS = 2048
N_STATS = 7
N_META = 512
META = ("lang", "source", "n_chars")


class Buckets(dict):
    def __missing__(self, word: str) -> int:
        if len(self) > 100_000:
            self.clear()
        b = zlib.crc32(word.encode("utf-8", "replace")) % BUCKETS
        if len(word) <= 64:
            self[word] = b
        return b


def text_features(text: str, buckets: Buckets) -> tuple[np.ndarray, np.ndarray, list[float]]:
    """(buckets of its words, weights of unit length, statistics of their repetition)."""
    words = text.split()
    n = len(words)
    if not n:
        return np.zeros(0, np.int64), np.zeros(0), [0.0] * N_STATS
    count = Counter(words)
    at = np.fromiter(map(buckets.__getitem__, count), np.int64, len(count))
    tf = np.log1p(np.fromiter(count.values(), float, len(count)))
    lines = text.split("\n")
    shout = sum(c for w, c in count.items() if w.isupper() and len(w) > 1)
    pairs = len(set(zip(words, words[1:]))) / max(1, n - 1)
    ended = sum(w.endswith((".", ",", ";", ":")) * c for w, c in count.items())
    stats = [np.log1p(n) / 10, len(count) / n, max(count.values()) / n, shout / n, pairs if n > 1 else 1.0, len(set(lines)) / len(lines), ended / n]
    return at, tf / np.sqrt((tf * tf).sum()), stats


class Make:
    """Kinds of bytes: capital, digit, white space, mark, other (letters, and parts of characters beyond ASCII)."""

    TABLE = bytes(67 if 65 <= b <= 90 else 68 if 48 <= b <= 57 else 83 if b in (32, *range(9, 14)) else 77 if 33 <= b < 127 and not chr(b).isalnum() else 0 for b in range(256))


def _steps(x: float) -> int:
    """Half octaves of a share of up to 1, or of a size."""
    return int(round(2 * np.log2(x + 2**-10)))


def meta_features(text: str, lang: str | None, source: str | None, n_chars: int | None) -> list[int]:
    kinds = text.encode("utf-8", "replace").translate(Make.TABLE)
    n, lines = max(1, len(kinds)), text.count("\n") + 1
    share = {k: kinds.count(b) / n for k, b in (("capitals", b"C"), ("digits", b"D"), ("spaces", b"S"), ("marks", b"M"))}
    seen = {"lang": lang, "source": source, "size": None if n_chars is None else _steps(max(0, n_chars)), "lines": _steps(lines), "line": _steps(n / lines), "blank": _steps(text.count("\n\n") / lines)}
    seen |= {k: _steps(v) for k, v in share.items()}
    seen["made"] = f"{_steps(share['capitals'])}/{_steps(share['marks'])}"
    return [zlib.crc32(f"{k}={v}".encode("utf-8", "replace")) % N_META for k, v in seen.items()]


@dataclass
class Linear:
    weights: np.ndarray
    lean: float = 0.0

    def logit(self, x: np.ndarray) -> np.ndarray:
        return x @ self.weights + self.lean


def fit_linear(x: np.ndarray, y: np.ndarray, steps: int = 150, decay: float = 1e-4) -> Linear:
    """Logistic regression, both classes of equal weight, by Nesterov's method."""
    x = np.asarray(x, np.float32)
    share = np.where(y == 1, 0.5 / max(1, (y == 1).sum()), 0.5 / max(1, (y == 0).sum())).astype(np.float32)
    rate = 4.0 / max(1e-9, float((share[:, None] * x * x).sum(axis=1).sum() + 1))
    model, ahead, lean, at = Linear(np.zeros(x.shape[1], np.float32)), np.zeros(x.shape[1], np.float32), 0.0, 0.0
    for k in range(steps):
        d = share * (1 / (1 + np.exp(-np.clip(x @ ahead + np.float32(at), -30, 30))) - y).astype(np.float32)
        w, b = ahead - np.float32(rate) * (x.T @ d + np.float32(decay) * ahead), at - rate * float(d.sum())
        m = k / (k + 3)
        ahead, at = w + np.float32(m) * (w - model.weights), b + m * (b - lean)
        model.weights, lean = w, b
    model.weights, model.lean = model.weights.astype(float), float(lean)
    return model


@dataclass
class Views:
    text: Linear
    meta: Linear
    mix: Linear  # of the two logits
    threshold: float
    #: a round's pseudo-labels: places in the pool and labels that the text view gave, and those that the metadata view gave
    exchanged: list[tuple[tuple[np.ndarray, np.ndarray], tuple[np.ndarray, np.ndarray]]] = field(default_factory=list)

    def probability(self, text: np.ndarray, meta: np.ndarray) -> np.ndarray:
        return 1 / (1 + np.exp(-np.clip(self.mix.logit(np.stack([text, meta], axis=1)), -30, 30)))


STATS_SCALE = np.asarray([1, 2, 2, 2, 2, 1, 2], float)


def dense(rows: list[dict]) -> tuple[np.ndarray, np.ndarray]:
    t, m = np.zeros((len(rows), BUCKETS + N_STATS), np.float32), np.zeros((len(rows), N_META), np.float32)
    for i, r in enumerate(rows):
        t[i, np.frombuffer(r["at"], "<i4")] = np.frombuffer(r["value"], "<f4")
        t[i, BUCKETS:] = np.asarray(r["stats"]) * STATS_SCALE
        np.add.at(m[i], r["meta"], 1)
    return t, m


def sure_from(logits: np.ndarray, y: np.ndarray, precision: float = PRECISION) -> float:
    """The least logit from which on (ties together) so large a share of ``y`` is 1; infinite if there is none."""
    order = np.argsort(-logits, kind="stable")
    right = np.cumsum(y[order]) / np.arange(1, len(y) + 1)
    last = np.append(np.diff(logits[order]) != 0, True) if len(y) else np.zeros(0, bool)
    good = np.flatnonzero((right >= precision) & last)
    return float(logits[order][good[-1]]) if len(good) else np.inf


def co_train(rows: list[dict], rounds: int = ROUNDS, keep: float = KEEP) -> Views | None:
    """``rows`` have features and a label, which is None in the unlabelled pool; None without both labels."""
    rows = sorted(rows, key=lambda r: r["doc_hash"])
    known = [r for r in rows if r["label"] is not None]
    if len({r["label"] for r in known}) < 2:
        return None
    parts = [[r for i, r in enumerate(known) if i % 4 in p] for p in ((1, 2), (3,), (0,))]
    train, tune, held = (p if len({r["label"] for r in p}) == 2 else known for p in parts)
    (xt, xm), (ut, um), (ht, hm) = dense(train), dense(tune), dense(held)
    y, uy, hy = (np.asarray([r["label"] for r in p], float) for p in (train, tune, held))
    pt, pm = dense([r for r in rows if r["label"] is None])
    for_text, for_meta = (xt, y), (xm, y)
    free = [np.ones(len(pt), bool), np.ones(len(pt), bool)]  # the pool as either view has not learned from it yet
    text, meta = fit_linear(*for_text), fit_linear(*for_meta)
    exchanged = []
    for _ in range(rounds if len(pt) else 0):
        given = []
        for view, x, tuned, other in ((text, pt, ut, 1), (meta, pm, um, 0)):
            z, at = view.logit(x), view.logit(tuned)
            picks, marks = [], []
            for label, sign in ((1, 1), (0, -1)):
                many = max(5, round(PER_ROUND * float((y == label).mean())))
                sure = np.flatnonzero(free[other] & (sign * z >= sure_from(sign * at, (uy == label).astype(float))))
                picks.append(sure[np.argsort(-sign * z[sure], kind="stable")][:many])
                marks.append(np.full(len(picks[-1]), float(label)))
            pick = np.concatenate(picks)
            free[other][pick] = False
            given.append((pick, np.concatenate(marks)))
        exchanged.append(tuple(given))
        for_meta = (np.concatenate([for_meta[0], pm[given[0][0]]]), np.concatenate([for_meta[1], given[0][1]]))
        for_text = (np.concatenate([for_text[0], pt[given[1][0]]]), np.concatenate([for_text[1], given[1][1]]))
        text, meta = fit_linear(*for_text), fit_linear(*for_meta)
    logits = np.stack([text.logit(ht), meta.logit(hm)], axis=1)
    views = Views(text, meta, fit_linear(logits, hy, steps=400), 0.0, exchanged)
    good = np.sort(views.probability(logits[:, 0], logits[:, 1])[hy == 1])
    views.threshold = float(min(0.5, good[int((1 - keep) * len(good))]))
    return views


def _inputs(docs: DataFrame) -> DataFrame:
    col = lambda c, kind: (F.col(c) if c in docs.columns else F.lit(None)).cast(kind).alias(c)
    return docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.coalesce("text", F.lit("")).alias("text"), col("lang", "string"), col("source", "string"), col("n_chars", "long"))


def train(docs: DataFrame, labels: DataFrame, labelled: int = LABELLED, pool: int = POOL) -> Views | None:
    spark = docs.sparkSession
    bounded_batches(spark)
    order, a_long = F.xxhash64("doc_id"), F.col("doc_id").cast("long").alias("doc_id")
    told = labels.where("doc_id IS NOT NULL").select(a_long, F.col("quality").cast("int").alias("quality"))
    known = told.where("quality IS NOT NULL").groupBy("doc_id").agg(F.min("quality").alias("a"), F.max("quality").alias("b")).where("a = b")
    known = known.orderBy(order, "doc_id").limit(labelled).select("doc_id", F.col("a").alias("label"))
    some = docs.select(a_long).where("doc_id IS NOT NULL").distinct().join(told.select("doc_id").distinct(), "doc_id", "left_anti")
    some = some.orderBy(order, "doc_id").limit(pool).withColumn("label", F.lit(None).cast("int"))
    chosen = spark.createDataFrame(known.unionByName(some).collect(), "doc_id long, label int")  # at most labelled + pool ids

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        buckets = Buckets()
        for b in batches:
            out = []
            for r in b.to_pylist():
                at, value, stats = text_features(r["text"], buckets)
                bins = np.bincount(at, value, BUCKETS)
                at = np.flatnonzero(bins)
                out.append({
                    "doc_hash": zlib.crc32(f"{r['doc_id']} {r['text']}".encode()), "label": r["label"], "at": at.astype("<i4").tobytes(),
                    "value": bins[at].astype("<f4").tobytes(), "stats": stats, "meta": meta_features(r["text"], r["lang"], r["source"], r["n_chars"]),
                })
            yield pa.RecordBatch.from_pylist(out, pa.schema([("doc_hash", pa.int64()), ("label", pa.int32()), ("at", pa.binary()), ("value", pa.binary()), ("stats", pa.list_(pa.float64())), ("meta", pa.list_(pa.int32()))]))

    rows = _inputs(docs).join(F.broadcast(chosen), "doc_id")
    rows = rows.groupBy("doc_id", "label").agg(F.min(F.struct(F.xxhash64("text").alias("h"), "text", "lang", "source", "n_chars")).alias("r")).select("doc_id", "label", "r.*").drop("h")
    rows = rows.mapInArrow(run, "doc_hash long, label int, at binary, value binary, stats array<double>, meta array<int>")
    return co_train([r.asDict() for r in rows.collect()])  # a row an id at most


def _scorer(views: Views | None):
    """columns (text, lang, source, n_chars) -> arrays of text, metadata and combined probability"""
    buckets = Buckets()

    def score(texts: list[str], langs: list, sources: list, sizes: list) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        n = len(texts)
        if views is None:
            half = np.full(n, 0.5)
            return half, half, half
        words, stats = views.text.weights[:BUCKETS], views.text.weights[BUCKETS:] * STATS_SCALE
        t, m = np.full(n, views.text.lean), np.full(n, views.meta.lean)
        for i, text in enumerate(texts):
            at, value, s = text_features(text, buckets)
            t[i] += words[at] @ value + stats @ np.asarray(s)
            m[i] += views.meta.weights[meta_features(text, langs[i], sources[i], sizes[i])].sum()
        prob = lambda z: 1 / (1 + np.exp(-np.clip(z, -30, 30)))
        return prob(t), prob(m), views.probability(t, m)

    return score


def score(docs: DataFrame, views: Views | None) -> DataFrame:
    bounded_batches(docs.sparkSession)
    least = views.threshold if views else 0.0

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        judge = _scorer(views)
        for b in batches:
            t, m, p = judge(*[b.column(i).to_pylist() for i in range(1, 5)])
            yield pa.RecordBatch.from_arrays([b.column(0), *[pa.array(x, pa.float64()) for x in (t, m, p)], pa.array(p >= least, pa.bool_())], ["doc_id", "text_score", "meta_score", "score", "kept"])

    return _inputs(docs).mapInArrow(run, "doc_id long, text_score double, meta_score double, score double, kept boolean")


def keep(docs: DataFrame, views: Views | None) -> DataFrame:
    """The rows that stay, with all columns; one pass over the rows, no join."""
    bounded_batches(docs.sparkSession)
    if views is None:
        return docs
    at = {c: docs.columns.index(c) for c in ("text", *META) if c in docs.columns}

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        judge = _scorer(views)
        for b in batches:
            get = lambda c: b.column(at[c]).to_pylist() if c in at else [None] * b.num_rows  # noqa: E731, B023
            p = judge([t or "" for t in get("text")], *map(get, META))[2]
            yield b.filter(pa.array(p >= views.threshold))

    return docs.mapInArrow(run, docs.schema)


def op6_quality_classifier(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    return score(docs, train(docs, table(spark, sf_dir, "labels")))

"""A corpus pipeline over ``documents``: classify, dedup lines, drop near copies, redact secrets, pack.

Each stage takes (spark, docs, sf_dir) and works on all its predecessor kept; its result is written as Parquet and
read again. All but the last return the columns of ``documents``.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from lindero.llm import cotraining, line_dedup, ngram_join, packing, secret_scan
from lindero.llm.common import materialize, table


def classify(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the quality classifier keeps. Null and empty texts are judged too, by what is known of them; equal rows
    alike. Where ``labels`` don't hold both verdicts, all stay. An empty table gives an empty table."""
    return cotraining.keep(docs, cotraining.train(docs, table(spark, sf_dir, "labels")))


def dedup_lines(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents without lines that an earlier line repeats. All rows stay: emptied ones with an empty text, null texts null.
    Equal rows lose the same lines. n_chars is counted anew."""
    out = line_dedup.dedup(docs).select(*docs.columns)
    return out.withColumn("n_chars", F.length("text").cast("long"))


def drop_near_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of each group of near copies (five words, 0.8) one document, that with the smallest id, once.

    Defined cases: rows are told apart by id and text. So of rows with one id and one text one stays; of rows with one id
    and different texts each is judged by its own text, and a text that is no copy stays whatever its id's other rows
    are. A row without an id goes by its text, after all ids. Rows with an empty or null text are no copies of each other:
    with an id one stays for each id and text, without one all stay. An empty table gives an empty table."""
    by_text = F.expr(f"{1 << 62} + (xxhash64(text) & {(1 << 62) - 1})")
    blank = F.col("doc_id").isNull() & (F.trim(F.coalesce("text", F.lit(""))) == "")
    named = docs.withColumns({"__id": F.coalesce(F.col("doc_id").cast("long"), by_text), "__t": F.xxhash64("text"), "__b": blank})
    found = ngram_join.near_rows(named.select(F.col("__id").alias("doc_id"), "text"))
    copies = materialize(found.where("NOT is_first").select(F.col("doc_id").alias("__id"), F.col("text_hash").alias("__t")))
    kept = named.join(copies, ["__id", "__t"], "left_anti")
    # only rows that are there more than once are shuffled with their texts
    key = ["__id", "__t", "__b"]
    twice = materialize(kept.where("NOT __b").groupBy(*key).count().where("count > 1").drop("count"))
    first = kept.join(twice, key, "left_semi").groupBy(*key).agg(F.min(F.struct(*docs.columns)).alias("__r")).select("__r.*")
    return kept.join(twice, key, "left_anti").select(*docs.columns).unionByName(first)


def redact_secrets(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """All documents, secrets replaced by a mark. Null and empty texts stay as they are, equal rows equal. n_chars is counted
    anew."""
    return secret_scan.redact(docs).withColumn("n_chars", F.length("text").cast("long"))


def pack(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Pieces of all documents with their sequences. Null and empty texts are an end id each, equal rows are packed each; no
    rows give no pieces."""
    return packing.pack_documents(docs)


STAGES = [("quality_classifier", classify), ("line_dedup", dedup_lines), ("ngram_jaccard_join", drop_near_copies), ("secret_scan", redact_secrets), ("packing", pack)]
#: A classifier, a graph search and a column generation are no SQL; tests hold the stages against brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    for i, (_, stage) in enumerate(STAGES):
        docs = stage(spark, docs, sf_dir)
        if i < len(STAGES) - 1:
            docs = materialize(docs)
    return docs

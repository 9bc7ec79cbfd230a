"""Quality rules: a threshold table compiled into Spark projections, without user functions.

``MEASURES`` are Spark SQL expressions over the counts of one text; ``RULES`` names a measure, its least and greatest
allowed value, and from how many words on it holds. Every row is judged on its own, so nothing is shuffled.

Defined cases: a null text has no words, as an empty one; both fail the base rule (fewer than 20 words). Equal rows
are judged alike. An empty table gives an empty table. Other columns are ignored, whatever their names. Windows are
compared by 64-bit hashes within one text.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .common import table

SPACE = r"[\x20\x09-\x0D]+"
SYMBOLS = "#*$%&|<>"
WINDOW = 8
#: Frequent words of the four languages.
STOP_WORDS = (
    "the of and to in is that was for on are with he at be this have from or had by not but what all were we when your can there an which if will each about how up out then them these so some her would make him "
    "de la le les et des en un une du dans que est pour qui sur au par il pas plus ce avec sont mais ou se "
    "der die und den von zu das mit sich des auf für ist im dem nicht ein eine als auch es an werden aus er hat dass sie nach wird bei "
    "el y a los del las por con no una su para al lo como más pero sus ha me si sin sobre este ya entre cuando todo esta ser son dos también fue había era muy hasta desde"
).split()
#: measure -> expression over the columns n_words, word_chars, n_symbols, n_stop, n_bangs, n_lines, n_dup_lines.
MEASURES = {
    "mean_word_chars": "word_chars / nullif(n_words, 0)",
    "symbols_a_word": "n_symbols / nullif(n_words, 0)",
    "bangs_a_word": "n_bangs / nullif(n_words, 0)",
    "stop_word_ratio": "n_stop / nullif(n_words, 0)",
    "dup_line_ratio": "n_dup_lines / nullif(n_lines, 0)",
}
#: (measure, least, greatest, from how many words on). Set on labelled documents: see the README.
RULES = (
    ("mean_word_chars", 2.0, 14.0, 20),
    ("symbols_a_word", None, 0.5, 20),
    ("bangs_a_word", None, 0.6, 20),
    ("stop_word_ratio", 0.01, None, 50),
    ("dup_line_ratio", None, 0.6, 20),
)
BASE_FAILED = "(n_words < 20 OR 100 * n_repeat_words > 30 * n_words)"


def compile_rules(rules=RULES) -> str:
    """The table as one SQL condition, true for texts to keep; the same text runs in Spark and DuckDB."""
    parts = [f"NOT {BASE_FAILED}"]
    for name, least, greatest, words in rules:
        m = MEASURES[name]
        parts += [f"(n_words < {words} OR coalesce({m}, {v}) {op} {v})" for v, op in ((least, ">="), (greatest, "<=")) if v is not None]
    return " AND ".join(parts)


def measure(docs: DataFrame) -> DataFrame:
    """doc_id and the counts of each whole text. Each step is used more than once in the next, so Catalyst keeps it."""
    spaces = " \t\n\x0b\x0c\r"
    removed = lambda c, chars: F.length(c) - F.length(F.translate(c, chars, ""))
    t = F.col("_t")
    bare = F.trim(t, F.lit(spaces))
    d = docs.select(F.col("doc_id").alias("doc_id"), F.coalesce("text", F.lit("")).alias("_t"))
    d = d.select(
        "doc_id", F.length(F.translate(t, spaces, "")).cast("long").alias("word_chars"), removed(t, SYMBOLS).cast("long").alias("n_symbols"), removed(t, "!").cast("long").alias("n_bangs"),
        F.when(bare == "", F.array().cast("array<string>")).otherwise(F.split(bare, SPACE)).alias("_w"),
        F.filter(F.split(t, "\n"), lambda x: F.trim(x, F.lit(spaces)) != "").alias("_l"),
    )
    d = d.select(
        "doc_id", "word_chars", "n_symbols", "n_bangs",
        F.size("_w").cast("long").alias("n_words"), F.size("_l").cast("long").alias("n_lines"), (F.size("_l") - F.size(F.array_distinct("_l"))).cast("long").alias("n_dup_lines"),
        F.size(F.filter("_w", lambda w: F.lower(w).isin(STOP_WORDS))).cast("long").alias("n_stop"),
        F.transform("_w", lambda w: F.xxhash64(w)).alias("_h"),
    )
    kept = [c for c in d.columns if c[0] != "_"]
    many = F.size("_h") - (WINDOW - 1)
    d = d.select(*kept, F.when(many > 0, F.transform(F.sequence(F.lit(1), F.greatest(many, F.lit(1))), lambda i: F.xxhash64(F.slice("_h", i, WINDOW)))).alias("_x"))
    again = F.size(F.array_distinct("_x")) < F.size("_x")
    d = d.select(*kept, F.when(again, F.array_sort(F.transform("_x", lambda x, i: F.struct(x.alias("x"), i.alias("i"))))).alias("_s"))
    same = "(j > 0 AND _s[j - 1].x = e.x) OR (j < size(_s) - 1 AND _s[j + 1].x = e.x)"
    d = d.select(*kept, F.expr(f"array_sort(filter(transform(_s, (e, j) -> CASE WHEN {same} THEN e.i END), p -> p IS NOT NULL))").alias("_p"))
    covered = f"aggregate(zip_with(_p, slice(_p, 2, greatest(size(_p) - 1, 0)), (a, b) -> least({WINDOW}, coalesce(b - a, {WINDOW}))), 0L, (s, v) -> s + v)"
    return d.select(*kept, F.expr(f"CASE WHEN _p IS NULL THEN 0L ELSE {covered} END").alias("n_repeat_words"))


def judge(docs: DataFrame, rules=RULES) -> DataFrame:
    out = ["n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words"]
    return measure(docs).select(F.col("doc_id"), *out, F.expr(BASE_FAILED).alias("base_failed"), F.expr(compile_rules(rules)).alias("kept"))


def op4_quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    return judge(table(spark, sf_dir, "documents"))


def _duck() -> str:
    stop = ", ".join(f"'{w}'" for w in dict.fromkeys(STOP_WORDS))
    return f"""
WITH d AS (SELECT doc_id, coalesce(text, '') AS t FROM documents),
w AS (SELECT doc_id, t, list_filter(string_split_regex(t, '[\\x20\\x09-\\x0D]+'), lambda x: x <> '') AS w,
             list_filter(string_split(t, chr(10)), lambda x: regexp_matches(x, '[^\\x20\\x09-\\x0D]')) AS l FROM d),
x AS (SELECT doc_id, unnest(list_transform(range(1, len(w) - 6), lambda i: array_to_string(w[i:i+7], ' '))) AS x, unnest(range(1, len(w) - 6)) AS i FROM w WHERE len(w) >= 8),
p AS (SELECT doc_id, i FROM (SELECT doc_id, i, count(*) OVER (PARTITION BY doc_id, x) AS n FROM x) WHERE n > 1),
r AS (SELECT doc_id, sum(v) AS n FROM (SELECT doc_id, least(8, coalesce(lead(i) OVER (PARTITION BY doc_id ORDER BY i) - i, 8)) AS v FROM p) GROUP BY doc_id),
c AS (SELECT w.doc_id, len(w) AS n_words, length(regexp_replace(t, '[\\x20\\x09-\\x0D]', '', 'g')) AS word_chars,
             length(regexp_replace(t, '[^#*$%&|<>]', '', 'g')) AS n_symbols, length(regexp_replace(t, '[^!]', '', 'g')) AS n_bangs,
             len(l) AS n_lines, len(l) - len(list_distinct(l)) AS n_dup_lines, len(list_filter(w, lambda y: lower(y) IN ({stop}))) AS n_stop,
             coalesce(r.n, 0) AS n_repeat_words FROM w LEFT JOIN r USING (doc_id))
SELECT doc_id, n_words::BIGINT AS n_words, word_chars::BIGINT AS word_chars, n_symbols::BIGINT AS n_symbols, n_dup_lines::BIGINT AS n_dup_lines,
       n_repeat_words::BIGINT AS n_repeat_words, {BASE_FAILED} AS base_failed, {compile_rules()} AS kept FROM c"""


ORACLE = _duck()

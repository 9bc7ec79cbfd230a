"""Line dedup within edit distance one, by a deletion-neighbourhood join in DataFrame operations only.

An occurrence of a line that isn't blank goes if any earlier such line, in another document or its own, is at edit
distance 0 or 1. Earlier means: smaller doc_id (null first), then hash of the text, then position.

Two lines at distance one agree outside one of two halves (of more, shorter parts in lines over 1,024 characters).
So each line has a key for each part left out, for its own length and one less. Only where different lines share a key
are variants emitted: every deletion of one character of the part left out, as hashed keys. Lines of equal length at
distance one share the variant with the same character left out; a longer one has a variant that is the shorter one's
part. Every line is joined with the earliest line that shares a variant, never with all of them, the edit distance of
each joined pair is verified, and the earliest line stays. Nothing but removed positions meets the texts again.

Defined cases: a null text stays null, blank lines (white space alone) take no part and stay. Rows with equal doc_id and
text are one document, so they lose the same lines; a null doc_id is an id before all others. An empty table gives an
empty table. Extra columns stay, whatever their names (working names start with ``__``).
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .common import materialize, table

MIN_CHARS = 1
PART = 512
BITS = 1 << 23
DOC = ["__n", "__d", "__t"]
HASH = ["__h1", "__h2"]


def _parts(length: str) -> str:
    return f"greatest(2, CAST(ceil({length} / {PART}.0) AS INT))"


#: Of a line: for its length and one less, for each part left out, what that part is and a hash of all else.
_KEYS = f"""flatten(transform(array(__m, __m - 1), l -> transform(sequence(0, {_parts("l")} - 1), s -> named_struct('l', l, 's', s, 'k',
  xxhash64(l, s, substring(__line, 1, CAST(floor(l * s / {_parts("l")}) AS INT)), substring(__line, CAST(floor(l * (s + 1) / {_parts("l")}) AS INT) + __m - l + 1, __m))))))"""

#: The same for lines of two parts, as plain expressions.
_TWO = ", ".join(f"xxhash64(CAST({l} AS INT), 0, '', substring(__line, CAST(floor({l} / 2) AS INT) + __m - ({l}) + 1, __m)), xxhash64(CAST({l} AS INT), 1, substring(__line, 1, CAST(floor({l} / 2) AS INT)), '')" for l in ("__m", "(__m - 1)"))
_HASHES = f"CASE WHEN __m <= {2 * PART} THEN array({_TWO}) ELSE transform({_KEYS}, x -> x.k) END"


def _identified(docs: DataFrame) -> DataFrame:
    return docs.withColumns({"__n": F.col("doc_id").isNotNull().cast("int"), "__d": F.coalesce(F.col("doc_id").cast("long"), F.lit(0)), "__t": F.xxhash64("text")})


def _earliest() -> F.Column:
    return F.min(F.struct(*DOC, "__p"))


def _perhaps(texts: DataFrame, wanted: DataFrame) -> DataFrame:
    """Rows whose document may be in ``wanted``: a bitmap of ``BITS`` bits, so of fixed size, tells most others apart
    before texts are shuffled. It only ever lets too many through."""
    h = F.pmod(F.xxhash64(*DOC), F.lit(BITS))
    words = wanted.select(h.alias("h")).groupBy(F.floor(F.col("h") / 32768).alias("__w")).agg(F.expr("bitmap_construct_agg(CAST(h % 32768 AS INT))").alias("__b"))
    texts = texts.withColumn("__h", h).withColumn("__w", F.floor(F.col("__h") / 32768))
    bit = F.expr("shiftright(CAST(conv(hex(substring(__b, CAST((__h % 32768) div 8 + 1 AS INT), 1)), 16, 10) AS INT), CAST(__h % 8 AS INT)) & 1")
    return texts.join(F.broadcast(words), "__w").where(bit == 1).drop("__h", "__w", "__b")


def near_lines(texts: DataFrame, occ: DataFrame, lines: DataFrame) -> DataFrame:
    """Hashes of the lines that have an earlier line at distance one."""
    keyed = occ.select("__h1", F.explode("__keys").alias("__k"))
    # written, as the lines to remove below are: a join with a table of one row a key is one that AQE may cut at a hot key
    shared = materialize(keyed.groupBy("__k").agg(F.min("__h1").alias("a"), F.max("__h1").alias("b")).where("a <> b").select("__k"))
    found = keyed.join(shared, "__k").groupBy("__h1").agg(F.collect_set("__k").alias("__ks"))
    found = found.join(lines.drop("__count"), "__h1").select(*HASH, "__ks", "__first", *[F.col(f"__first.{c}").alias(c) for c in (*DOC, "__p")])
    per_doc = materialize(found.groupBy(*DOC).agg(F.collect_list(F.struct(*HASH, "__ks", "__first", "__p")).alias("__c")))
    held = _perhaps(texts.select(*DOC, "text"), per_doc)
    lined = held.join(per_doc, DOC).select(F.split("text", "\n").alias("__l"), F.explode("__c").alias("__c"))
    lined = lined.select("__c.*", F.col("__l")[F.col("__c.__p")].alias("__line")).dropDuplicates(HASH)
    lined = materialize(lined.withColumn("__m", F.length("__line")))

    part = lined.select("*", F.explode(F.expr(f"filter({_KEYS}, x -> array_contains(__ks, x.k))")).alias("x"))
    begin, end = (f"CAST(floor(x.l * {s} / {_parts('x.l')}) AS INT)" for s in ("x.s", "(x.s + 1)"))
    part = part.select(*HASH, "__first", F.col("x.k").alias("k"), F.expr("__m = x.l").alias("short"), F.expr(f"substring(__line, {begin} + 1, {end} - {begin} + __m - x.l)").alias("w"))
    without = "concat(substring(w, 1, i - 1), substring(w, i + 1, length(w)))"
    same = f"transform(sequence(1, length(w)), i -> named_struct('v', xxhash64('same', k, i, {without}), 'kind', 0))"
    longer = f"transform(sequence(1, length(w)), i -> named_struct('v', xxhash64('more', k, {without}), 'kind', 2))"
    variants = F.expr(f"CASE WHEN short THEN concat({same}, array(named_struct('v', xxhash64('more', k, w), 'kind', 1))) ELSE {longer} END")
    rows = materialize(part.where("length(w) > 0").select("__first", F.explode(variants).alias("x")).select("__first", "x.v", "x.kind"))
    # of equal variants: kind 0 meets kind 0; 1 and 2 meet each other
    best = rows.groupBy("v").agg(F.min(F.when(F.col("kind") != 2, F.col("__first"))).alias("a"), F.min(F.when(F.col("kind") == 2, F.col("__first"))).alias("b"), F.count(F.lit(1)).alias("c")).where("c > 1")
    other = F.when(F.col("kind") == 1, F.col("b")).otherwise(F.col("a"))
    pairs = rows.join(best, "v").select("__first", other.alias("__other")).where("__other < __first").distinct()
    there = lined.select(F.col("__first").alias("__other"), F.col("__line").alias("__earlier"))
    checked = pairs.join(lined.select(*HASH, "__first", "__line"), "__first").join(there, "__other")
    return checked.where(F.levenshtein("__line", "__earlier", 1) >= 0).select(*HASH).distinct()


def dedup(docs: DataFrame, min_chars: int = MIN_CHARS) -> DataFrame:
    """The same rows and columns, texts without the removed lines; ``__lines`` and ``__removed`` count them."""
    texts = _identified(docs)
    lined = texts.select(*DOC, F.posexplode(F.split("text", "\n")).alias("__p", "__line")).withColumn("__m", F.length("__line")).where((F.col("__m") >= min_chars) & F.col("__line").rlike(r"\S"))
    occ = materialize(lined.select(*DOC, "__p", F.xxhash64("__line").alias("__h1"), F.xxhash64(F.lit(7), "__line").alias("__h2"), F.expr(_HASHES).alias("__keys")))
    lines = occ.groupBy(*HASH).agg(_earliest().alias("__first"), F.count(F.lit(1)).alias("__count"))
    near = near_lines(texts, occ, lines).withColumn("__near", F.lit(True))
    gone = materialize(lines.join(near, HASH, "left").where("__count > 1 OR __near"))
    out = occ.drop("__keys").join(gone, HASH).where(F.coalesce("__near", F.lit(False)) | (F.struct(*DOC, "__p") != F.col("__first")))
    out = out.groupBy(*DOC).agg(F.collect_set("__p").alias("__gone"))
    joined = texts.join(out, DOC, "left")
    kept = F.array_join(F.filter(F.split("text", "\n"), lambda x, i: ~F.array_contains("__gone", i)), "\n")
    counts = {"__lines": F.coalesce(F.size(F.split("text", "\n")), F.lit(0)).cast("long"), "__removed": F.coalesce(F.size("__gone"), F.lit(0)).cast("long")}
    text = F.when(F.col("__gone").isNull(), F.col("text")).otherwise(kept)
    return joined.select(*[text.alias("text") if c == "text" else F.col(c) for c in docs.columns], *[v.alias(k) for k, v in counts.items()])


def op10_line_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """doc_id, lines, removed lines and the text that stays."""
    out = dedup(table(spark, sf_dir, "documents").select("doc_id", "text"))
    return out.select("doc_id", F.when(F.col("text").isNull(), 0).otherwise(F.col("__lines")).cast("long").alias("n_lines"), F.col("__removed").alias("n_removed"), "text")


#: Pairs of lines by length and edit distance, without keys or variants. DuckDB's distance counts bytes, up to four of them a
#: character, so pairs within four are looked at character by character. Exact where doc_ids are unique.
ORACLE = """
WITH o AS (SELECT doc_id, p, l[p] AS line FROM (SELECT doc_id, string_split(text, chr(10)) AS l FROM documents WHERE text IS NOT NULL), unnest(range(1, len(l) + 1)) AS r(p)),
t AS (SELECT * FROM o WHERE regexp_matches(line, '[^\\x20\\x09-\\x0D]')),
f AS (SELECT line, length(line) AS n, min((doc_id, p)) AS first FROM t GROUP BY line),
w AS (SELECT line, first, unnest([n - 1, n, n + 1]) AS n FROM f),
c AS (SELECT w.line, f.line AS other, f.first FROM w JOIN f USING (n) WHERE w.line = f.line OR (f.first < w.first AND levenshtein(w.line, f.line) <= 4)),
g AS (SELECT *, CASE WHEN length(line) < length(other) THEN line ELSE other END AS a, CASE WHEN length(line) < length(other) THEN other ELSE line END AS b FROM c),
h AS (SELECT *, CASE WHEN length(a) < length(b) THEN 1 ELSE 2 END AS skip FROM g),
e AS (SELECT line, min(first) AS earliest FROM h WHERE list_bool_or(list_transform(range(0, length(a) + 1), lambda i: left(a, i) = left(b, i) AND substr(a, i + skip) = substr(b, i + 2))) GROUP BY line),
k AS (SELECT o.doc_id, o.p, o.line, coalesce(e.earliest < (o.doc_id, o.p), false) AS gone FROM o LEFT JOIN e USING (line)),
d AS (SELECT doc_id, count(*) AS n_lines, count(*) FILTER (gone) AS n_removed, coalesce(string_agg(line, chr(10) ORDER BY p) FILTER (NOT gone), '') AS text FROM k GROUP BY doc_id)
SELECT documents.doc_id, coalesce(n_lines, 0)::BIGINT AS n_lines, coalesce(n_removed, 0)::BIGINT AS n_removed, d.text FROM documents LEFT JOIN d USING (doc_id)"""

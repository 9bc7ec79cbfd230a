"""All registered queries of the linkage, provenance and directory operators, with equivalent SQL.

Roles on the driver's tables: ``part`` is the registry (name, title, code), ``pages`` the feeds, ``customer`` the
professionals, ``orders`` their evidence, ``nation`` releases and ``region`` sources. Lists are joined to strings, so
every engine compares them alike.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from ..functions import ids, names, text
from ..operators import dedupe, directory, linkage, news, publication, registry, search

QUERIES: dict = {}
ORACLES: dict = {}
KEY = b"an example key of thirty-two bytes or more"
AS_OF = "2001-01-01 00:00:00"
TITLE = r"(?is)<title>(.*?)</title>"


def query(sql: str | None = None):
    def add(f):
        QUERIES[f.__name__] = f
        if sql:
            ORACLES[f.__name__] = sql
        return f

    return add


def _t(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def _joined(c: Column | str, sep: str = "|") -> Column:
    return F.array_join(c, sep)


def _far_repeats(spark: SparkSession) -> None:
    """For results that grow with the square of a name and repeat themselves, also farther apart than the 64 KB in which snappy,
    Spark's default, looks: their Parquet files are written with zstd, which looks 2 MB back. The codec is a session's, read
    when files are written; one that the session was given stays."""
    if (codec := "spark.sql.parquet.compression.codec") not in spark.conf.getAll:
        spark.conf.set(codec, "zstd")


def _titles(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _t(spark, sf_dir, "pages").select("page_id", "url", F.regexp_extract("html", TITLE, 1).alias("title"))


_PAGE = "(SELECT page_id, url, regexp_extract(html, '(?is)<title>(.*?)</title>', 1) AS title FROM pages)"
_UP = "upper(replace(replace(strip_accents({0}), 'ß', 'ss'), 'ẞ', 'SS'))"
_WORDS = r"trim(regexp_replace({0}, '[^\p{{L}}\p{{N}}]+', ' ', 'g'))"
_SORTED = "array_to_string(list_sort(list_filter(string_split({0}, ' '), lambda x: x <> '')), ' ')"


@query(f"SELECT doc_id, sha256({_WORDS.format(_UP.format('text'))}) AS name_key FROM documents")
def name_normalize(spark, sf_dir):
    d = _t(spark, sf_dir, "documents")
    return d.select("doc_id", F.sha2(text.credential(F.col("text")), 256).alias("name_key"))


@query(f"SELECT page_id, trim(regexp_replace(lower(strip_accents(title)), '[^a-z0-9]+', ' ', 'g')) AS match_key FROM {_PAGE}")
def match_key_ascii(spark, sf_dir):
    return _titles(spark, sf_dir).select("page_id", text.match_key(F.col("title")).alias("match_key"))


@query(f"SELECT p_partkey, {_SORTED.format('upper(p_name)')} AS name_key FROM part")
def token_multiset(spark, sf_dir):
    return _t(spark, sf_dir, "part").select("p_partkey", text.token_multiset(text.person_name(F.col("p_name"))).alias("name_key"))


@query("""WITH c AS (SELECT c_nationkey * 1000 + floor(c_acctbal / 50)::BIGINT AS document, c_mktsegment, c_name FROM customer),
q AS (SELECT DISTINCT document FROM c WHERE c_mktsegment IN ('BUILDING', 'MACHINERY')), g AS (SELECT document, c_mktsegment, min(c_name) AS n FROM c SEMI JOIN q USING (document) GROUP BY ALL)
SELECT document, array_to_string(list_sort(list(n)), '|') AS names, count(*)::BIGINT AS n_names, count(*) > 1 AS quarantined FROM g GROUP BY document""")
def registry_group_quarantine(spark, sf_dir):
    """Documents are customers of one nation and like balance, so some hold one identity and some several."""
    rows = _t(spark, sf_dir, "customer").withColumn("document", F.col("c_nationkey") * 1000 + F.floor(F.col("c_acctbal") / 50))
    out = registry.identities(registry.qualifying(rows, "document", F.col("c_mktsegment").isin("BUILDING", "MACHINERY")), "document", "c_name", F.col("c_mktsegment"))
    return out.select("document", _joined("names").alias("names"), "n_names", "quarantined")


@query("SELECT l_orderkey, array_to_string(list_sort(list(DISTINCT l_returnflag || ':' || l_linestatus)), '|') AS titles FROM lineitem GROUP BY l_orderkey")
def enabled_titles(spark, sf_dir):
    out = registry.titles(_t(spark, sf_dir, "lineitem"), "l_orderkey", ["l_returnflag", "l_linestatus"])
    return out.select("l_orderkey", _joined(F.transform("titles", lambda t: F.concat_ws(":", t["l_returnflag"], t["l_linestatus"]))).alias("titles"))


@query("SELECT count(*)::BIGINT AS n_rows, count(DISTINCT text)::BIGINT AS n_distinct, (count(*) - count(DISTINCT text))::BIGINT AS n_duplicates FROM documents")
def exact_duplicates(spark, sf_dir):
    per = _t(spark, sf_dir, "documents").groupBy(F.sha2("text", 256)).count()
    return per.agg(F.sum("count").alias("n_rows"), F.count(F.lit(1)).alias("n_distinct"), (F.sum("count") - F.count(F.lit(1))).alias("n_duplicates"))


_LINK = """WITH r AS (SELECT p_partkey AS id, array_to_string(list_sort(string_split(upper(p_name), ' ')), ' ') AS k, upper(p_type) AS title FROM part WHERE p_partkey % 10 = 0),
o AS (SELECT p_brand AS institution, array_to_string(list_reverse(string_split(upper(p_name), ' ')), ' ') AS normalized_name, array_to_string(list_sort(string_split(upper(p_name), ' ')), ' ') AS k, upper(p_type) AS spec FROM part WHERE p_partkey % 10 <> 0),
g AS (SELECT institution, normalized_name, k, list(DISTINCT spec) AS specs FROM o GROUP BY ALL),
m AS (SELECT g.institution, g.normalized_name, count(DISTINCT r.id)::BIGINT AS n, bool_or(list_contains(specs, r.title)) AS cons FROM g LEFT JOIN r USING (k) GROUP BY 1, 2),
l AS (SELECT institution, normalized_name, n AS registry_matches, CASE WHEN n = 0 THEN 'unmatched' WHEN n > 1 THEN 'ambiguous_exact_name' WHEN cons THEN 'exact_name_and_title_consistent' ELSE 'exact_name_only' END AS status FROM m) """


def _candidates(spark, sf_dir):
    """Every tenth part is of the registry, all others are observations: both grow with the table."""
    part = _t(spark, sf_dir, "part").withColumn("key", text.person_name(F.col("p_name")))
    key = text.token_multiset(F.col("key")).alias("name_key")
    people = part.where("p_partkey % 10 = 0").select(F.col("p_partkey").alias("id"), key, F.upper("p_type").alias("title"))
    seen = part.where("p_partkey % 10 <> 0").select(F.col("p_brand").alias("institution"), F.array_join(F.reverse(F.split("key", " ")), " ").alias("normalized_name"), key, F.upper("p_type").alias("specialty"))
    return linkage.link(linkage.group_observations(seen), people)


@query(_LINK + "SELECT * FROM l")
def linkage_candidates(spark, sf_dir):
    return _candidates(spark, sf_dir)


@query(_LINK + "SELECT status, count(*)::BIGINT AS n FROM l GROUP BY status")
def linkage_status_counts(spark, sf_dir):
    return _candidates(spark, sf_dir).groupBy("status").agg(F.count(F.lit(1)).alias("n"))


@query(_LINK + """SELECT institution, normalized_name, status, 'ABSTAINED' AS resolution, 'not_public' AS visibility,
CASE status WHEN 'unmatched' THEN 'NO_MSP_CANDIDATE' WHEN 'ambiguous_exact_name' THEN 'MULTIPLE_MSP_CANDIDATES' WHEN 'exact_name_and_title_consistent' THEN 'HUMAN_REVIEW_REQUIRED' ELSE 'TITLE_NOT_CORROBORATED' END AS reason FROM l""")
def abstained_resolutions(spark, sf_dir):
    return linkage.abstain(_candidates(spark, sf_dir)).select("institution", "normalized_name", "status", "resolution", "visibility", "reason")


@query("""SELECT a.p_partkey AS part_a, b.p_partkey AS part_b, a.p_name = b.p_name AS ordered, contains(upper(a.p_type), upper(b.p_type)) OR contains(upper(b.p_type), upper(a.p_type)) AS consistent
FROM part a JOIN part b ON array_to_string(list_sort(string_split(a.p_name, ' ')), ' ') = array_to_string(list_sort(string_split(b.p_name, ' ')), ' ') AND a.p_partkey < b.p_partkey""")
def linkage_evidence(spark, sf_dir):
    """Pairs of one name, whatever their brands."""
    _far_repeats(spark)
    part = _t(spark, sf_dir, "part").withColumns({"k": text.token_multiset(F.lower("p_name")), "title": text.credential(F.col("p_type"))})
    judge = lambda a, b: {"ordered": a["p_name"] == b["p_name"], "consistent": text.credentials_consistent(a["title"], b["title"])}
    out = linkage.same_name_pairs(part, "p_partkey", "k", "p_name", "title", judge=judge)
    return out.select(F.col("a.p_partkey").alias("part_a"), F.col("b.p_partkey").alias("part_b"), "ordered", "consistent")


@query("""SELECT 'supplier' AS institution, s_suppkey AS record_id, trim(s_name) AS display_name FROM supplier UNION ALL SELECT 'customer', c_custkey, trim(c_name) FROM customer UNION ALL SELECT 'part', p_partkey, coalesce(nullif(trim(p_name), ''), p_brand) FROM part""")
def heterogeneous_coalesce(spark, sf_dir):
    s = _t(spark, sf_dir, "supplier").select(F.lit("supplier").alias("institution"), F.col("s_suppkey").alias("record_id"), F.col("s_name").alias("professionalName"))
    c = _t(spark, sf_dir, "customer").select(F.lit("customer").alias("institution"), F.col("c_custkey").alias("record_id"), F.col("c_name").alias("physicianName"))
    p = _t(spark, sf_dir, "part").select(F.lit("part").alias("institution"), F.col("p_partkey").alias("record_id"), F.col("p_name").alias("fullName"), F.col("p_brand").alias("name"))
    rows = s.unionByName(c, allowMissingColumns=True).unionByName(p, allowMissingColumns=True)
    return rows.select("institution", "record_id", linkage.first_of("professionalName", "physicianName", "fullName", "name").alias("display_name"))


_RAW = "(SELECT event_id, CASE WHEN event_type = 'error' THEN substr(props, 2) ELSE props END AS raw FROM events)"


@query(f"""SELECT 'row' AS kind, event_id, sha256(raw) AS line_sha256, 0::BIGINT AS n FROM {_RAW} WHERE NOT json_valid(raw)
UNION ALL SELECT 'physical', NULL, NULL, count(*) FROM {_RAW} UNION ALL SELECT 'parsed', NULL, NULL, count(*) FROM {_RAW} WHERE json_valid(raw) UNION ALL SELECT 'quarantined', NULL, NULL, count(*) FROM {_RAW} WHERE NOT json_valid(raw)""")
def json_quarantine(spark, sf_dir):
    e = _t(spark, sf_dir, "events").select("event_id", F.when(F.col("event_type") == "error", F.expr("substring(props, 2)")).otherwise(F.col("props")).alias("raw"))
    e = e.withColumn("bad", F.expr("try_parse_json(raw) IS NULL OR NOT startswith(ltrim(raw), '{')"))  # only objects are rows
    rows = e.where("bad").select(F.lit("row").alias("kind"), "event_id", F.sha2("raw", 256).alias("line_sha256"), F.lit(0).cast("long").alias("n"))
    n = e.agg(F.count(F.lit(1)).alias("physical"), F.count_if(~F.col("bad")).alias("parsed"), F.count_if(F.col("bad")).alias("quarantined"))
    totals = n.selectExpr("stack(3, 'physical', physical, 'parsed', parsed, 'quarantined', quarantined) AS (kind, n)").select("kind", F.lit(None).cast("long").alias("event_id"), F.lit(None).cast("string").alias("line_sha256"), "n")
    return rows.unionByName(totals)


@query("SELECT o_custkey, o_orderkey, o_orderdate FROM orders QUALIFY row_number() OVER (PARTITION BY o_custkey ORDER BY o_orderdate DESC, o_orderkey DESC) = 1")
def latest_bundle(spark, sf_dir):
    o = _t(spark, sf_dir, "orders").groupBy("o_custkey").agg(F.max(F.struct("o_orderdate", "o_orderkey")).alias("m"))
    return o.select("o_custkey", "m.o_orderkey", "m.o_orderdate")


@query("SELECT c_custkey, coalesce(array_to_string(list_sort(list(o_orderkey) FILTER (o_orderkey IS NOT NULL)), '|'), '') AS orders, count(o_orderkey)::BIGINT AS n_orders FROM customer LEFT JOIN orders ON c_custkey = o_custkey GROUP BY c_custkey")
def directory_profiles(spark, sf_dir):
    out = linkage.profiles(_t(spark, sf_dir, "customer").select("c_custkey"), _t(spark, sf_dir, "orders").withColumnRenamed("o_custkey", "c_custkey"), "c_custkey", "o_orderkey")
    return out.select("c_custkey", _joined("items").alias("orders"), F.size("items").cast("long").alias("n_orders"))


@query("SELECT 'order' AS kind, o_orderkey AS id FROM orders ANTI JOIN customer ON o_custkey + 20 = c_custkey UNION ALL SELECT 'part', p_partkey FROM part ANTI JOIN (SELECT l_partkey FROM lineitem WHERE l_linenumber = 7) ON p_partkey = l_partkey")
def referential_anti(spark, sf_dir):
    """References moved on by twenty, so that the last dangle; parts without a seventh line."""
    moved = _t(spark, sf_dir, "orders").withColumn("c_custkey", F.col("o_custkey") + 20)
    orders = linkage.unknown_references(moved, _t(spark, sf_dir, "customer"), "c_custkey")
    parts = linkage.unknown_references(_t(spark, sf_dir, "part").withColumnRenamed("p_partkey", "l_partkey"), _t(spark, sf_dir, "lineitem").where("l_linenumber = 7"), "l_partkey")
    return orders.select(F.lit("order").alias("kind"), F.col("o_orderkey").alias("id")).union(parts.select(F.lit("part"), "l_partkey"))


def _flexible(spark, sf_dir):
    p = _t(spark, sf_dir, "part").select(F.upper("p_name").alias("n"), F.upper("p_type").alias("t")).distinct()
    canonical = p.select(F.concat_ws(" ", "n", "t").alias("canonical")).distinct()
    two = F.split("n", " ")
    forms = F.array("n", F.concat_ws(" ", "n", "t"), F.concat_ws(" ", F.left(two[0], F.lit(1)), two[1]))
    observed = p.select(F.explode(forms).alias("observed")).distinct()
    a = canonical.withColumn("cid", F.col("canonical"))
    b = observed.withColumn("oid", F.col("observed"))
    return names.flexible_pairs(a, b, "cid", "canonical", "oid", "observed").select("canonical", "observed", F.col("match.kind").alias("kind"), F.col("match.exact").cast("long").alias("exact"))


_FLEX = """WITH p AS (SELECT DISTINCT upper(p_name) AS n, upper(p_type) AS t FROM part), c AS (SELECT DISTINCT n || ' ' || t AS canonical FROM p),
o AS (SELECT DISTINCT unnest([n, n || ' ' || t, substr(n, 1, 1) || ' ' || split_part(n, ' ', 2)]) AS observed FROM p),
x AS (SELECT canonical, observed, string_split(canonical, ' ') AS a, string_split(observed, ' ') AS b FROM c CROSS JOIN o),
f AS (SELECT canonical, observed, CASE WHEN canonical = observed THEN 'EXACT_NORMALIZED_NAME'
  WHEN len(list_distinct(a)) >= 2 AND len(list_distinct(b)) >= 2 AND len(list_distinct(a)) <> len(list_distinct(b)) AND
    ((len(list_distinct(b)) < len(list_distinct(a)) AND list_has_all(a, b) AND len(list_filter(b, lambda y: length(y) < 2)) = 0) OR (len(list_distinct(a)) < len(list_distinct(b)) AND list_has_all(b, a))) THEN 'PARTIAL_TOKEN_SUBSET'
  WHEN len(b) = 2 AND length(b[1]) = 1 AND length(b[2]) > 1 AND ((starts_with(a[1], b[1]) AND list_contains(a[2:], b[2])) OR (NOT starts_with(a[1], b[1]) AND starts_with(a[2], b[1]) AND list_contains(a[3:], b[2]))) THEN 'INITIALS_TOKEN_SUBSEQUENCE' END AS kind,
  CASE WHEN canonical = observed THEN len(b) WHEN length(b[1]) = 1 THEN 1 ELSE least(len(a), len(b)) END::BIGINT AS exact FROM x) """


@query(_FLEX + "SELECT canonical, observed, kind, exact FROM f WHERE kind IS NOT NULL")
def flexible_name_pairs(spark, sf_dir):
    return _flexible(spark, sf_dir)


@query(_FLEX + "SELECT observed, canonical, kind FROM f WHERE kind IS NOT NULL AND (kind = 'EXACT_NORMALIZED_NAME' OR observed NOT IN (SELECT canonical FROM c))")
def exact_then_flexible(spark, sf_dir):
    pairs = _flexible(spark, sf_dir)
    exact = pairs.where(F.col("kind") == names.EXACT)
    rest = pairs.join(exact.select("observed").distinct(), "observed", "left_anti")
    return exact.unionByName(rest).select("observed", "canonical", "kind")


@query(_FLEX + ", n AS (SELECT observed, canonical, kind, count(*) OVER (PARTITION BY observed) AS match_count FROM f WHERE kind IS NOT NULL) SELECT observed, canonical, kind, match_count::BIGINT AS match_count, kind <> 'EXACT_NORMALIZED_NAME' AND match_count > 25 AS suppressed FROM n")
def fanout_cap(spark, sf_dir):
    out = dedupe.fan_out(_flexible(spark, sf_dir), ["observed"], news.FAN_OUT_CAP)
    return out.select("observed", "canonical", "kind", "match_count", ((F.col("kind") != names.EXACT) & F.col("suppressed")).alias("suppressed"))


_BEST = _FLEX + """, m AS (SELECT article, observed, max(c)::INTEGER AS n_context FROM (SELECT p_brand AS article, unnest([upper(p_name), upper(p_name) || ' ' || upper(p_type), substr(upper(p_name), 1, 1) || ' ' || split_part(upper(p_name), ' ', 2)]) AS observed, p_size % 3 AS c FROM part) GROUP BY ALL),
j AS (SELECT canonical, article, observed, kind, n_context, CASE kind WHEN 'EXACT_NORMALIZED_NAME' THEN 0 WHEN 'PARTIAL_TOKEN_SUBSET' THEN 1 ELSE 2 END AS flexibility,
 CASE kind WHEN 'EXACT_NORMALIZED_NAME' THEN 49 WHEN 'PARTIAL_TOKEN_SUBSET' THEN greatest(1, least(49, floor(20 + exact / 3.0::DOUBLE * 20 + CASE WHEN n_context > 0 THEN 10 ELSE 0 END + 0.5))) ELSE CASE WHEN n_context > 0 THEN 30 ELSE 15 END END::INTEGER AS points
 FROM f JOIN m USING (observed) WHERE kind IS NOT NULL)
SELECT canonical, article, observed AS mention, kind, points FROM j QUALIFY row_number() OVER (PARTITION BY canonical, article ORDER BY flexibility, n_context DESC, points DESC, observed) = 1"""


@query(_BEST)
def best_match(spark, sf_dir):
    """Brands are articles, the forms of their parts' names what they mention: the best mention of a professional in each."""
    part = _t(spark, sf_dir, "part").select(F.col("p_brand").alias("article"), F.upper("p_name").alias("n"), F.upper("p_type").alias("t"), (F.col("p_size") % 3).alias("c"))
    two = F.split("n", " ")
    forms = F.explode(F.array("n", F.concat_ws(" ", "n", "t"), F.concat_ws(" ", F.left(two[0], F.lit(1)), two[1]))).alias("mention")
    said = part.select("article", forms, "c").groupBy("article", "mention").agg(F.max("c").cast("int").alias("n_context"))
    found = _flexible(spark, sf_dir).withColumnRenamed("observed", "mention").join(said, "mention")
    index = F.create_map(*[x for i, k in enumerate((names.EXACT, names.PARTIAL, names.INITIALS)) for x in (F.lit(k), F.lit(i))])[F.col("kind")]
    points = news.review_points(F.col("kind"), F.col("exact") / F.lit(3.0), F.lit(False), F.lit(True), F.col("n_context") > 0)
    best = news.strongest(found.withColumns({"flexibility": index, "points": points}), ["canonical", "article"])
    return best.select("canonical", "article", "mention", "kind", "points")


@query("SELECT p_partkey, array_to_string(list_sort(list_filter(list(p_partkey) OVER (PARTITION BY p_name), lambda x: x <> p_partkey)), '|') AS competing FROM part")
def competing_ids(spark, sf_dir):
    """All other ids of the name, whatever their brands."""
    _far_repeats(spark)
    return dedupe.competing_text(_t(spark, sf_dir, "part"), ["p_name"], "p_partkey")


@query("""WITH k AS (SELECT unnest(['EXACT_NORMALIZED_NAME', 'PARTIAL_TOKEN_SUBSET', 'INITIALS_TOKEN_SUBSEQUENCE']) AS kind), e AS (SELECT event_id, kind, value / 1000.0 AS cov, event_type = 'click' AS amb, user_id % 2 = 0 AS med, user_id % 3 = 0 AS cor FROM events CROSS JOIN k)
SELECT event_id, kind, greatest(1, least(49, CASE kind WHEN 'EXACT_NORMALIZED_NAME' THEN CASE WHEN amb THEN 30 ELSE 49 END - CASE WHEN med THEN 0 ELSE 10 END + CASE WHEN cor THEN 5 ELSE 0 END
 WHEN 'PARTIAL_TOKEN_SUBSET' THEN floor(20 + cov * 20 + CASE WHEN cor THEN 10 ELSE 0 END - CASE WHEN amb THEN 10 ELSE 0 END - CASE WHEN med THEN 0 ELSE 10 END + 0.5) ELSE 10 + CASE WHEN med THEN 5 ELSE 0 END + CASE WHEN cor THEN 15 ELSE 0 END - CASE WHEN amb THEN 10 ELSE 0 END END))::INTEGER AS points FROM e""")
def review_points(spark, sf_dir):
    kinds = F.explode(F.array(*[F.lit(k) for k in (names.EXACT, names.PARTIAL, names.INITIALS)])).alias("kind")
    e = _t(spark, sf_dir, "events").select("event_id", "event_type", "user_id", F.col("value").cast("double").alias("value"), kinds)
    points = news.review_points(F.col("kind"), F.col("value") / 1000.0, F.col("event_type") == "click", F.col("user_id") % 2 == 0, F.col("user_id") % 3 == 0)
    return e.select("event_id", "kind", points.alias("points"))


_CONTEXT = f"""WITH RECURSIVE g AS (SELECT unnest({list(news.GENERIC_CONTEXT)}) AS w), s AS (SELECT unnest({list(news.SPECIALTY_STEMS)}) AS s),
d AS (SELECT DISTINCT doc_id, unnest(string_split({_WORDS.format(_UP.format("text"))}, ' ')) AS w FROM documents),
b AS (SELECT DISTINCT item_id, unnest(string_split({_WORDS.format(_UP.format("text"))}, ' ')) AS w FROM benchmark),
m AS (SELECT item_id, w FROM b ANTI JOIN g USING (w) WHERE length(w) >= 3),
x AS (SELECT DISTINCT w FROM m), y AS (SELECT DISTINCT w FROM d),
p AS (SELECT x.w AS a, y.w AS b FROM x JOIN y USING (w) UNION SELECT x.w, y.w FROM x JOIN y ON left(x.w, 6) = left(y.w, 6) WHERE length(x.w) >= 6 AND length(y.w) >= 6
 UNION SELECT x.w, y.w FROM x JOIN s ON starts_with(x.w, s.s) JOIN y ON starts_with(y.w, s.s)),
h AS (SELECT DISTINCT doc_id, p.a FROM d JOIN p ON d.w = p.b)
SELECT doc_id, item_id, count(*)::BIGINT AS shared FROM h JOIN m ON h.a = m.w GROUP BY ALL"""


@query(_CONTEXT)
def context_match(spark, sf_dir):
    """Documents and benchmark items that share a context word, by equal words, specialty stems or six first letters."""
    rows = lambda name, key: _t(spark, sf_dir, name).select(key, "text")
    words = lambda df: df.withColumn("words", F.split(text.credential(F.col("text")), " ")).drop("text")
    return news.context_pairs(words(rows("documents", "doc_id").repartition("doc_id")), words(rows("benchmark", "item_id")), "doc_id", "item_id")


@query("""WITH k AS (SELECT unnest(['EXACT_NORMALIZED_NAME', 'PARTIAL_TOKEN_SUBSET', 'INITIALS_TOKEN_SUBSEQUENCE']) AS kind), e AS (SELECT DISTINCT kind, event_type = 'click' AS amb, user_id % 3 = 0 AS cor FROM events CROSS JOIN k)
SELECT kind, amb, cor, CASE WHEN kind = 'INITIALS_TOKEN_SUBSEQUENCE' OR amb OR (kind = 'PARTIAL_TOKEN_SUBSET' AND NOT cor) THEN 'CRITICAL' WHEN kind = 'PARTIAL_TOKEN_SUBSET' THEN 'HIGH' ELSE 'WARNING' END AS severity FROM e""")
def alert_severity(spark, sf_dir):
    kinds = F.explode(F.array(*[F.lit(k) for k in (names.EXACT, names.PARTIAL, names.INITIALS)])).alias("kind")
    e = _t(spark, sf_dir, "events").select((F.col("event_type") == "click").alias("amb"), (F.col("user_id") % 3 == 0).alias("cor"), kinds).distinct()
    return e.withColumn("severity", news.alert_severity(F.col("kind"), F.col("amb"), F.col("cor")))


_CLASSES = (("ADVERSE_OR_JUDICIAL", ("that", "then"), ("of the",)), ("MINOR", ("het",), ("and her",)), ("PRIVATE_HEALTH", ("tion",), ()))


@query(f"""SELECT page_id, coalesce(nullif(array_to_string(list_filter([CASE WHEN regexp_matches(k, ' (that|then)') OR contains(k, ' of the ') THEN 'ADVERSE_OR_JUDICIAL' END, CASE WHEN regexp_matches(k, ' (het)') OR contains(k, ' and her ') THEN 'MINOR' END,
CASE WHEN regexp_matches(k, ' (tion)') THEN 'PRIVATE_HEALTH' END], lambda x: x IS NOT NULL), '|'), ''), 'NOT_CLEARLY_BENIGN_PUBLIC_CONTEXT') AS reasons FROM (SELECT page_id, ' ' || {_WORDS.format("lower(strip_accents(title))")} || ' ' AS k FROM {_PAGE})""")
def headline_policy(spark, sf_dir):
    """The policy with stems of the synthetic language, and no names found: what no class restricts isn't clearly benign. Its
    real vocabularies are in ``operators.news``."""
    none = F.array().cast("array<string>")
    return _titles(spark, sf_dir).select("page_id", _joined(news.headline_reasons(F.col("title"), none, _CLASSES)).alias("reasons"))


_URL = "regexp_replace(regexp_replace(url, '^http://', 'https://'), '#.*$', '')"


@query(f"SELECT {_URL} AS canonical, page_id FROM pages QUALIFY row_number() OVER (PARTITION BY {_URL} ORDER BY page_id DESC) = 1")
def feed_dedupe_last(spark, sf_dir):
    p = _t(spark, sf_dir, "pages").select(ids.canonical_url(F.col("url")).alias("canonical"), "page_id")
    return p.groupBy("canonical").agg(F.max("page_id").alias("page_id"))


@query("SELECT sha256(text) AS text_sha256, min(doc_id) AS doc_id, (count(*) - 1)::BIGINT AS discarded FROM documents GROUP BY 1")
def dedupe_first(spark, sf_dir):
    d = _t(spark, sf_dir, "documents").select(F.sha2("text", 256).alias("text_sha256"), "doc_id")
    return d.groupBy("text_sha256").agg(F.min("doc_id").alias("doc_id"), (F.count(F.lit(1)) - 1).alias("discarded"))


@query("SELECT conv_id, turn, sha256(coalesce(last_value(CASE WHEN role = 'user' THEN nullif(text, '') END IGNORE NULLS) OVER (PARTITION BY conv_id ORDER BY turn, role, text ROWS UNBOUNDED PRECEDING), '')) AS last_user FROM conversations")
def carry_forward(spark, sf_dir):
    c = dedupe.carry_forward(_t(spark, sf_dir, "conversations"), ["conv_id"], ["turn", "role", "text"], F.when(F.col("role") == "user", F.col("text")), "u")
    return c.select("conv_id", "turn", F.sha2(F.coalesce("u", F.lit("")), 256).alias("last_user"))


@query("SELECT event_id, coalesce(max(CASE WHEN event_type = 'error' THEN 1 ELSE 0 END) OVER (PARTITION BY user_id ORDER BY ts, event_id ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) = 1 AS restricted FROM events")
def running_restricted(spark, sf_dir):
    return dedupe.seen_before(_t(spark, sf_dir, "events"), ["user_id"], ["ts", "event_id"], F.col("event_type") == "error", "restricted").select("event_id", "restricted")


@query(f"WITH h AS (SELECT page_id, regexp_extract(url, '://([^/?#]*)', 1) AS host, list_filter(string_split(trim(regexp_replace(lower(strip_accents(title)), '[^a-z0-9]+', ' ', 'g')), ' '), lambda x: x <> '') AS w FROM {_PAGE}) SELECT host, min(page_id) AS page_id, array_to_string(list_sort(list_distinct(flatten(list(w)))), ' ') AS tokens FROM h GROUP BY host")
def merge_feeds(spark, sf_dir):
    p = _titles(spark, sf_dir).select("page_id", F.parse_url("url", F.lit("HOST")).alias("host"), F.filter(F.split(text.match_key(F.col("title")), " "), lambda x: x != "").alias("tokens"))
    return dedupe.merge_by_key(p, "host", ["page_id"], ["page_id"], "tokens").select("host", "page_id", _joined("tokens", " ").alias("tokens"))


@query("""WITH c AS (SELECT event_id, event_type, ts, CASE WHEN ts > TIMESTAMP '2024-01-25 00:00:00' THEN 'future' WHEN ts < TIMESTAMP '2024-01-25 00:00:00' - INTERVAL 20 DAY THEN 'stale' ELSE 'valid' END AS class FROM events),
s AS (SELECT event_type, max(ts) FILTER (class <> 'future') < TIMESTAMP '2024-01-25 00:00:00' - INTERVAL 72 HOUR AS source_stale FROM c GROUP BY event_type) SELECT event_id, class, source_stale FROM c JOIN s USING (event_type)""")
def collection_window(spark, sf_dir):
    as_of = F.to_timestamp_ntz(F.lit("2024-01-25 00:00:00"))
    e = _t(spark, sf_dir, "events").select("event_id", "event_type", "ts", news.window_class(F.col("ts"), as_of, 20).alias("class"))
    s = e.groupBy("event_type").agg((F.max(F.when(F.col("class") != "future", F.col("ts"))) < as_of - F.expr("INTERVAL 72 HOURS")).alias("source_stale"))
    return e.join(s, "event_type").select("event_id", "class", "source_stale")


@query("WITH a AS (SELECT p_name || ' ' || p_type || ' ' || p_size AS alias, p_brand AS owner FROM part) SELECT alias, min(owner) AS owner FROM a GROUP BY alias HAVING count(DISTINCT owner) = 1")
def alias_unique(spark, sf_dir):
    a = _t(spark, sf_dir, "part").select(F.concat_ws(" ", "p_name", "p_type", "p_size").alias("alias"), F.col("p_brand").alias("owner"))
    return a.groupBy("alias").agg(F.min("owner").alias("owner"), F.max("owner").alias("b")).where("owner = b").drop("b")


@query("WITH s AS (SELECT o_orderkey, 'de ' || (o_orderkey % 26) || ':' || lpad((o_custkey % 70)::VARCHAR, 2, '0') || ' a 18:30, 7:05 a 9:15' AS s FROM orders) SELECT o_orderkey, CASE WHEN o_orderkey % 26 < 24 AND CAST(regexp_extract(s, ':(\\d\\d) a 18', 1) AS INT) < 60 THEN lpad((o_orderkey % 26)::VARCHAR, 2, '0') || ':' || regexp_extract(s, ':(\\d\\d) a 18', 1) || '-18:30|' ELSE '' END || '07:05-09:15' AS intervals FROM s")
def intervals_parse(spark, sf_dir):
    o = _t(spark, sf_dir, "orders")
    s = F.concat(F.lit("de "), F.col("o_orderkey") % 26, F.lit(":"), F.lpad((F.col("o_custkey") % 70).cast("string"), 2, "0"), F.lit(" a 18:30, 7:05 a 9:15"))
    return o.select("o_orderkey", _joined(F.transform(text.intervals(s), lambda p: F.concat_ws("-", p["start"], p["end"]))).alias("intervals"))


@query("SELECT c_custkey, 'record_' || substr(sha256(c_name || chr(0) || coalesce(c_mktsegment, '')), 1, 24) AS record_id, sha256('{\"name\":\"' || c_name || '\",\"nation\":' || c_nationkey || ',\"none\":null}') AS json_sha256 FROM customer")
def record_ids(spark, sf_dir):
    c = _t(spark, sf_dir, "customer")
    return c.select("c_custkey", ids.composite_id("record_", F.col("c_name"), F.col("c_mktsegment")).alias("record_id"), ids.json_id(name=F.col("c_name"), nation=F.col("c_nationkey"), none=F.lit(None).cast("string")).alias("json_sha256"))


_IN, _OUT = ids.pads(KEY)
_MAC = f"sha256(from_hex('{_OUT}') || from_hex(sha256(from_hex('{_IN}') || encode('linkage' || chr(0) || c_custkey))))"


@query(f"SELECT c_custkey, linkage_id, substr(linkage_id, 1, 8) || '-' || substr(linkage_id, 9, 4) || '-8' || substr(linkage_id, 14, 3) || '-' || (['8', '9', 'a', 'b'])[(CASE WHEN substr(linkage_id, 17, 1) IN ('0', '4', '8', 'c') THEN 1 WHEN substr(linkage_id, 17, 1) IN ('1', '5', '9', 'd') THEN 2 WHEN substr(linkage_id, 17, 1) IN ('2', '6', 'a', 'e') THEN 3 ELSE 4 END)] || substr(linkage_id, 18, 3) || '-' || substr(linkage_id, 21, 12) AS public_id FROM (SELECT c_custkey, {_MAC} AS linkage_id FROM customer)")
def hmac_ids(spark, sf_dir):
    c = _t(spark, sf_dir, "customer").select("c_custkey", ids.hmac_sha256(KEY, F.concat(F.lit("linkage\x00"), F.col("c_custkey").cast("string"))).alias("linkage_id"))
    return c.withColumn("public_id", ids.uuid_v8(F.col("linkage_id")))


@query(f"SELECT page_id, CASE WHEN s = '' THEN 'profesional' ELSE s END || '-' || substr(sha256(page_id::VARCHAR), 1, 8) AS slug FROM (SELECT page_id, regexp_replace(substr(regexp_replace(regexp_replace(lower(strip_accents(title)), '[^a-z0-9]+', '-', 'g'), '^-+|-+$', '', 'g'), 1, 140), '^-+|-+$', '', 'g') AS s FROM {_PAGE})")
def slug(spark, sf_dir):
    return _titles(spark, sf_dir).select("page_id", F.concat_ws("-", ids.slug(F.col("title")), F.substring(F.sha2(F.col("page_id").cast("string"), 256), 1, 8)).alias("slug"))


@query(f"SELECT page_id, {_URL} AS canonical FROM pages")
def canonical_url(spark, sf_dir):
    return _t(spark, sf_dir, "pages").select("page_id", ids.canonical_url(F.col("url")).alias("canonical"))


_EVIDENCE = f"""WITH e AS (SELECT o_orderkey, CASE r_regionkey WHEN 0 THEN 'PENDING' ELSE 'APPROVED' END AS s_state, CASE r_regionkey WHEN 1 THEN NULL WHEN 2 THEN TIMESTAMP '{AS_OF}' ELSE TIMESTAMP '2005-01-01' END AS s_until,
 CASE n_nationkey % 5 WHEN 0 THEN 'UNKNOWN' ELSE 'COMPATIBLE' END AS purpose, CASE n_nationkey % 7 WHEN 0 THEN 'PENDING' ELSE 'OPEN_DATA' END AS reuse, CASE o_orderstatus WHEN 'P' THEN 'REVOKED' ELSE 'APPROVED' END AS state,
 CASE o_orderpriority WHEN '5-LOW' THEN 'CANDIDATE' ELSE 'CONFIRMED' END AS confidence, o_orderdate + INTERVAL 400 DAY AS until
 FROM orders JOIN customer ON o_custkey = c_custkey JOIN nation ON c_nationkey = n_nationkey JOIN region ON n_regionkey = r_regionkey),
b AS (SELECT o_orderkey, array_to_string(list_filter([CASE WHEN s_state <> 'APPROVED' THEN 'SOURCE_NOT_APPROVED' END, CASE WHEN s_state = 'APPROVED' AND s_until IS NULL THEN 'SOURCE_APPROVAL_EXPIRY_MISSING' END, CASE WHEN s_until <= TIMESTAMP '{AS_OF}' THEN 'SOURCE_APPROVAL_EXPIRED' END,
 CASE WHEN purpose <> 'COMPATIBLE' THEN 'PURPOSE_NOT_COMPATIBLE' END, CASE WHEN reuse = 'PENDING' THEN 'REUSE_NOT_APPROVED' END, CASE WHEN state <> 'APPROVED' THEN 'EVIDENCE_NOT_APPROVED' END, CASE WHEN confidence = 'CANDIDATE' THEN 'CONFIDENCE_NOT_PUBLISHABLE' END, CASE WHEN until <= TIMESTAMP '{AS_OF}' THEN 'EVIDENCE_EXPIRED' END], lambda x: x IS NOT NULL), '|') AS reasons FROM e) """


def _evidence(spark, sf_dir):
    t = lambda n: _t(spark, sf_dir, n)
    e = t("orders").join(t("customer"), F.col("o_custkey") == F.col("c_custkey")).join(t("nation"), F.col("c_nationkey") == F.col("n_nationkey")).join(t("region"), F.col("n_regionkey") == F.col("r_regionkey"))
    as_of = F.to_timestamp_ntz(F.lit(AS_OF))
    until = F.when(F.col("r_regionkey") == 1, None).when(F.col("r_regionkey") == 2, as_of).otherwise(F.to_timestamp_ntz(F.lit("2005-01-01 00:00:00")))
    reasons = publication.block_reasons(
        F.when(F.col("r_regionkey") == 0, "PENDING").otherwise("APPROVED"), until, F.when(F.col("n_nationkey") % 5 == 0, "UNKNOWN").otherwise("COMPATIBLE"), F.when(F.col("n_nationkey") % 7 == 0, "PENDING").otherwise("OPEN_DATA"),
        F.when(F.col("o_orderstatus") == "P", "REVOKED").otherwise("APPROVED"), F.when(F.col("o_orderpriority") == "5-LOW", "CANDIDATE").otherwise("CONFIRMED"), F.col("o_orderdate") + F.expr("INTERVAL 400 DAYS"), as_of,
    )
    return e.select("o_orderkey", "o_custkey", reasons.alias("reasons"))


@query(_EVIDENCE + "SELECT o_orderkey, reasons, reasons = '' AS allowed FROM b")
def public_evidence(spark, sf_dir):
    return _evidence(spark, sf_dir).select("o_orderkey", _joined("reasons").alias("reasons"), (F.size("reasons") == 0).alias("allowed"))


@query(_EVIDENCE + "SELECT c_custkey, c_name FROM customer WHERE EXISTS (SELECT 1 FROM orders JOIN b USING (o_orderkey) WHERE o_custkey = c_custkey AND reasons = '')")
def public_professional_semi(spark, sf_dir):
    ok = _evidence(spark, sf_dir).where(F.size("reasons") == 0).select(F.col("o_custkey").alias("c_custkey"))
    return _t(spark, sf_dir, "customer").join(ok, "c_custkey", "left_semi").select("c_custkey", "c_name")


@query(_EVIDENCE + "SELECT c_custkey, o_orderkey, l_linenumber, l_returnflag AS claim FROM customer JOIN orders ON c_custkey = o_custkey JOIN b USING (o_orderkey) JOIN lineitem ON l_orderkey = o_orderkey WHERE reasons = '' AND l_linestatus = 'F'")
def public_professional_join(spark, sf_dir):
    ok = _evidence(spark, sf_dir).where(F.size("reasons") == 0).select("o_orderkey", F.col("o_custkey").alias("c_custkey"))
    claims = _t(spark, sf_dir, "lineitem").where("l_linestatus = 'F'").select(F.col("l_orderkey").alias("o_orderkey"), "l_linenumber", F.col("l_returnflag").alias("claim"))
    return _t(spark, sf_dir, "customer").select("c_custkey").join(ok, "c_custkey").join(claims, "o_orderkey").select("c_custkey", "o_orderkey", "l_linenumber", "claim")


@query("SELECT p_partkey, p_name FROM part WHERE p_name ILIKE '%ED W%' ESCAPE '\\'")
def search_ilike(spark, sf_dir):
    return _t(spark, sf_dir, "part").where(search.contains_term(F.col("p_name"), "ED W")).select("p_partkey", "p_name")


@query("SELECT c_name, c_custkey FROM customer WHERE (c_mktsegment, c_custkey) > ('BUILDING', 100) ORDER BY c_mktsegment, c_custkey LIMIT 21")
def keyset_page(spark, sf_dir):
    return search.keyset_page(_t(spark, sf_dir, "customer"), "c_mktsegment", "c_custkey", 20, ("BUILDING", 100)).select("c_name", "c_custkey")


@query("SELECT c_custkey, c_name, 'customer-77' AS current_slug FROM customer WHERE c_custkey = 77")
def slug_redirect(spark, sf_dir):
    c = _t(spark, sf_dir, "customer").select(F.col("c_custkey").cast("string").alias("id"), "c_custkey", "c_name")
    routes = c.select("id", F.explode(F.array(F.struct(F.concat(F.lit("customer-"), "id").alias("slug"), F.lit("CURRENT").alias("route_kind")), F.struct(F.concat(F.lit("old-"), "id").alias("slug"), F.lit("REDIRECT").alias("route_kind")))).alias("r")).select("id", "r.*")
    return search.by_id_or_slug(c, routes, "id", "OLD-77").select("c_custkey", "c_name", "current_slug")


@query(f"SELECT word, row_number() OVER (ORDER BY word COLLATE es, word)::INTEGER AS pos FROM (SELECT DISTINCT unnest(string_split(trim(regexp_replace(lower(title), '[^\\p{{L}}\\p{{N}}]+', ' ', 'g')), ' ')) AS word FROM {_PAGE}) WHERE word <> ''")
def es_collated_sort(spark, sf_dir):
    """Places of the distinct words in Spanish order (n before ñ before o). Words are dealt by their first two letters
    without accents, but ñ, in which that order agrees; places inside each, and the words before it, add up, so no task
    sees all words. Only the table of beginnings, bounded by the alphabet, is summed up in one."""
    w = _titles(spark, sf_dir).select(F.explode(F.split(text.words(F.lower("title")), " ")).alias("word")).where("word <> ''").distinct()
    plain = F.expr("replace(replace(replace(word, 'ß', 'ss'), 'æ', 'ae'), 'œ', 'oe')")
    letters = F.replace(text.fold(F.replace(plain, F.lit("ñ"), F.lit("\x01"))), F.lit("\x01"), F.lit("ñ"))
    w = w.withColumn("initial", F.left(letters, F.lit(2)))
    counts = w.groupBy("initial").count()
    before = counts.withColumn("before", F.sum("count").over(Window.orderBy(F.collate("initial", "es"), "initial")) - F.col("count")).drop("count")
    inside = F.row_number().over(Window.partitionBy("initial").orderBy(F.collate("word", "es"), "word"))
    return w.join(before, "initial").select("word", (F.col("before") + inside).cast("int").alias("pos"))


@query("SELECT 'overlap' AS kind, count(*)::BIGINT AS n FROM (SELECT DISTINCT year(l_shipdate) y FROM lineitem WHERE l_returnflag = 'A' INTERSECT SELECT DISTINCT year(l_shipdate) FROM lineitem WHERE l_returnflag <> 'A') UNION ALL SELECT 'missing', count(*) FROM (SELECT DISTINCT year(l_shipdate) y FROM lineitem EXCEPT SELECT DISTINCT year(l_shipdate) FROM lineitem WHERE l_returnflag = 'A')")
def set_partition(spark, sf_dir):
    y = _t(spark, sf_dir, "lineitem").select(F.year("l_shipdate").alias("y"), (F.col("l_returnflag") == "A").alias("in")).distinct()
    included, omitted = y.where("in").select("y"), y.where("NOT in").select("y")
    count = lambda kind, df: df.agg(F.lit(kind).alias("kind"), F.count(F.lit(1)).alias("n"))
    return count("overlap", included.intersect(omitted)).union(count("missing", y.select("y").distinct().exceptAll(included)))


@query("SELECT c_custkey, c_name, c_mktsegment FROM customer")
def allowlist_projection(spark, sf_dir):
    return publication.project_allowed(_t(spark, sf_dir, "customer"), ["c_custkey", "c_name", "c_mktsegment"])


@query("""SELECT 'duplicate_name' AS rule, (count(*) - count(DISTINCT c_name))::BIGINT AS n FROM customer UNION ALL SELECT 'blank_name', count(*) FILTER (trim(c_name) = '') FROM customer UNION ALL SELECT 'order_without_customer', count(*) FROM orders ANTI JOIN customer ON o_custkey = c_custkey
UNION ALL SELECT 'line_without_order', count(*) FROM lineitem ANTI JOIN orders ON l_orderkey = o_orderkey UNION ALL SELECT 'repeated_line', (SELECT count(*) FROM (SELECT 1 FROM lineitem GROUP BY l_orderkey, l_linenumber HAVING count(*) > 1)) UNION ALL SELECT 'bad_slug', count(*) FILTER (NOT regexp_matches(lower(replace(c_name, '#', '-')), '^[a-z0-9]+(-[a-z0-9]+)*$')) FROM customer""")
def integrity_violations(spark, sf_dir):
    c, o, li = (_t(spark, sf_dir, n) for n in ("customer", "orders", "lineitem"))
    one = lambda rule, n: n.select(F.lit(rule).alias("rule"), F.col("n").cast("long").alias("n"))
    count = lambda df: df.agg(F.count(F.lit(1)).alias("n"))
    names_ = c.groupBy("c_name").count().agg((F.sum("count") - F.count(F.lit(1))).alias("n"))
    out = one("duplicate_name", names_).union(one("blank_name", count(c.where("trim(c_name) = ''")))).union(one("order_without_customer", count(o.join(c, F.col("o_custkey") == F.col("c_custkey"), "left_anti"))))
    out = out.union(one("line_without_order", count(li.join(o, F.col("l_orderkey") == F.col("o_orderkey"), "left_anti")))).union(one("repeated_line", count(li.groupBy("l_orderkey", "l_linenumber").count().where("count > 1"))))
    return out.union(one("bad_slug", count(c.where(~F.lower(F.replace("c_name", F.lit("#"), F.lit("-"))).rlike("^[a-z0-9]+(-[a-z0-9]+)*$")))))


@query("SELECT o_orderkey FROM orders JOIN (SELECT l_orderkey, min(l_shipdate) AS shipped FROM lineitem GROUP BY 1) ON l_orderkey = o_orderkey WHERE least(o_orderdate + INTERVAL 90 DAY, shipped) <= TIMESTAMP '1996-01-01'")
def retention_expired(spark, sf_dir):
    o = _t(spark, sf_dir, "orders").withColumn("ttl", F.col("o_orderdate") + F.expr("INTERVAL 90 DAYS"))
    s = _t(spark, sf_dir, "lineitem").groupBy(F.col("l_orderkey").alias("o_orderkey")).agg(F.min("l_shipdate").alias("shipped"))
    return publication.expired(o.join(s, "o_orderkey"), F.to_timestamp_ntz(F.lit("1996-01-01 00:00:00")), "ttl", "shipped").select("o_orderkey")


@query(f"WITH q AS (SELECT regexp_extract(url, '://([^/?#]*)', 1) AS host, count(*) AS n, count(*) FILTER (title <> '' AND NOT contains(title, '*')) AS ok, count(DISTINCT url) FILTER (contains(url, '?')) AS c FROM {_PAGE} GROUP BY 1) SELECT host, n::BIGINT AS n, ok::BIGINT AS complete, array_to_string(list_filter([CASE WHEN n < 20 THEN 'TOO_FEW_ROWS' END, CASE WHEN ok < 0.9 * n THEN 'INCOMPLETE_ROWS' END, CASE WHEN c = 0 THEN 'NO_CENTER_URLS' END], lambda x: x IS NOT NULL), '|') AS issues FROM q")
def quality_gate(spark, sf_dir):
    """Hosts as directory pages; addresses with a query stand for centers. Twenty rows are enough here, a hundred by default."""
    p = _titles(spark, sf_dir).select(F.parse_url("url", F.lit("HOST")).alias("host"), "title", "url")
    q = p.groupBy("host").agg(F.count(F.lit(1)).alias("n"), F.count_if((F.col("title") != "") & ~F.contains("title", F.lit("*"))).alias("complete"), F.count_if(F.contains("url", F.lit("?"))).alias("c"))
    return q.select("host", "n", "complete", _joined(directory.quality_issues(F.col("n"), F.col("complete"), F.col("c"), 20)).alias("issues"))


@query("SELECT page_id, regexp_extract(html, '(?is)<title>(.*?)</title>', 1) AS title, len(regexp_extract_all(html, '(?is)<li><a href=\"([^\"]*)\">', 1))::BIGINT AS n_links FROM pages")
def html_fields(spark, sf_dir):
    p = _t(spark, sf_dir, "pages")
    return p.select("page_id", F.regexp_extract("html", TITLE, 1).alias("title"), F.size(F.regexp_extract_all("html", F.lit(r'(?is)<li><a href="([^"]*)">'), 1)).cast("long").alias("n_links"))

"""Queries of the name keys, headlines, contracts, public views, directories and integrity rules, with equivalent SQL.

Roles on the driver's tables: ``region`` is the sources, ``nation`` their releases, ``orders`` evidence and claims,
``customer`` the professionals, ``lineitem`` their titles, ``part`` names. Documents are made from columns, with
faults in fixed shares of the rows, so that every rule has rows on both sides."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ..functions import ids, text
from ..operators import contracts, dedupe, directory, headlines, linkage, news, registry, search, views
from ..sources import provider_pages, stores
from .catalog import _PAGE, _UP, _WORDS, _joined, _t, _titles, query

AS_OF = "1998-01-01 00:00:00"
FREE = "array_to_string(list_filter([{0}], lambda x: x IS NOT NULL), '|')"


def _when(n: str, code: str) -> str:
    return f"CASE WHEN coalesce({n}, false) THEN '{code}' END"


def _codes(*tests: tuple[str, str]) -> str:
    return FREE.format(", ".join(_when(t, c) for t, c in tests))


# --- name keys -------------------------------------------------------------------------------------------------

_NAMES = """(SELECT c_custkey, CASE c_custkey % 6 WHEN 0 THEN 'Dra. ' || c_name || ' Núñez' WHEN 1 THEN 'Núñez, ' || c_name WHEN 2 THEN 'Prof. Dr. ' || c_name || ' (consulta) Paz' WHEN 3 THEN ' Q.F.  ' || c_name || ', Ana, María '
 WHEN 4 THEN 'Doctora ' || c_name || ', Dr. Íñigo' ELSE 'Lic ' || c_name END AS name FROM customer)"""


def _names(spark, sf_dir) -> DataFrame:
    n, k = F.col("c_name"), F.col("c_custkey") % 6
    forms = (F.concat(F.lit("Dra. "), n, F.lit(" Núñez")), F.concat(F.lit("Núñez, "), n), F.concat(F.lit("Prof. Dr. "), n, F.lit(" (consulta) Paz")), F.concat(F.lit(" Q.F.  "), n, F.lit(", Ana, María ")), F.concat(F.lit("Doctora "), n, F.lit(", Dr. Íñigo")))
    name = F.coalesce(*[F.when(k == i, f) for i, f in enumerate(forms)], F.concat(F.lit("Lic "), n))
    return _t(spark, sf_dir, "customer").select("c_custkey", name.alias("name"))


@query(f"""WITH b AS (SELECT c_custkey, regexp_replace(trim(regexp_replace(strip_accents(regexp_replace(name, '\\([^)]*\\)', ' ', 'g')), '\\s+', ' ', 'g')), '(?i)^(?:(?:dr|dra|doctor|doctora|prof|profesora?|lic|licenciada?|tec|tecnica?|q\\s*\\.?\\s*f)\\.?\\s+)+', '') AS b FROM {_NAMES}),
p AS (SELECT c_custkey, b, list_filter(list_transform(string_split(b, ','), lambda x: trim(x)), lambda x: x <> '') AS p FROM b)
SELECT c_custkey, {_WORDS.format("upper(CASE WHEN len(p) = 2 THEN p[2] || ' ' || p[1] ELSE b END)")} AS person_key FROM p""")
def person_names(spark, sf_dir):
    return _names(spark, sf_dir).select("c_custkey", text.person_name(F.col("name")).alias("person_key"))


@query(f"SELECT page_id, trim(regexp_replace({_UP.format('title')}, '\\s+', ' ', 'g')) AS identity, {_WORDS.format('lower(strip_accents(title))')} AS policy, {_WORDS.format('lower(strip_accents(title))')} AS header, replace(lower(strip_accents(title)), '´', '') AS term FROM {_PAGE}")
def text_keys(spark, sf_dir):
    t = F.col("title")
    return _titles(spark, sf_dir).select("page_id", text.identity_name(t).alias("identity"), text.policy_key(t).alias("policy"), text.header_key(t).alias("header"), text.search_term(t).alias("term"))


@query("SELECT c_custkey, trim(regexp_replace(lower(strip_accents(regexp_replace(regexp_replace(trim(name), '(?i)^(?:dra?|dr|lic|licda?|psic|prof|tecn|tecnica|tecnico)\\.?\\s+', ''), '\\([^)]*\\).*', ''))), '[^a-z0-9]+', ' ', 'g')) AS physician FROM " + _NAMES)
def physician_keys(spark, sf_dir):
    return _names(spark, sf_dir).select("c_custkey", text.physician_key(F.col("name")).alias("physician"))


@query("SELECT p_partkey, p_name FROM part WHERE contains(lower(strip_accents(p_name || ' é')), lower(strip_accents('d w')))")
def search_folded(spark, sf_dir):
    return _t(spark, sf_dir, "part").where(search.contains_folded(F.concat(F.col("p_name"), F.lit(" é")), "D W")).select("p_partkey", "p_name")


# --- headlines -------------------------------------------------------------------------------------------------

_HEADS = """h AS (SELECT p_partkey, string_split(p_name, ' ') AS w, p_type AS t FROM part), f AS (SELECT p_partkey, upper(w[1][1]) || w[1][2:] AS a, upper(w[2][1]) || w[2][2:] AS b, upper(t[1]) || lower(t[2:]) AS t FROM h),
x AS (SELECT DISTINCT upper(w[1]) AS a, upper(w[2]) AS b, upper(t) AS t FROM h WHERE p_partkey % 3 = 0)"""


def _headlines(spark, sf_dir) -> tuple[DataFrame, DataFrame]:
    part = _t(spark, sf_dir, "part").withColumns({"a": F.initcap(F.split("p_name", " ")[0]), "b": F.initcap(F.split("p_name", " ")[1]), "t": F.initcap("p_type")})
    forms = (F.concat_ws(" ", "a", "b", "t", F.lit("recibió un premio")), F.concat_ws(" ", "a", "t", F.lit("recibió un premio")), F.concat(F.left("a", F.lit(1)), F.lit(". "), F.col("t"), F.lit(" habló")))
    title = F.coalesce(*[F.when(F.col("p_partkey") % 3 == i, f) for i, f in enumerate(forms)])
    index = headlines.name_index(part.where("p_partkey % 3 = 0").select(F.concat_ws(" ", "p_name", "p_type").alias("name")), "name")
    return headlines.extracted_names(part.select("p_partkey", title.alias("title")), "p_partkey", "title", index), index


_FOUND = f"""WITH {_HEADS},
u AS (SELECT alias FROM (SELECT a || ' ' || l AS alias, count(DISTINCT a || ' ' || b || ' ' || t) AS n FROM (SELECT a, b, t, unnest(list_distinct([b, t])) AS l FROM x) GROUP BY 1) WHERE n = 1),
i AS (SELECT a[1] AS i, w, count(DISTINCT a || ' ' || b || ' ' || t) AS n FROM (SELECT a, b, t, unnest(list_distinct([a, b, t])) AS w FROM x) WHERE w <> a OR b = w OR t = w GROUP BY 1, 2),
n AS (SELECT p_partkey, CASE p_partkey % 3 WHEN 0 THEN f.a || ' ' || f.b || ' ' || f.t || ' recibió un premio' WHEN 1 THEN f.a || ' ' || f.t || ' recibió un premio' ELSE f.a[1] || '. ' || f.t || ' habló' END AS title,
 CASE p_partkey % 3 WHEN 0 THEN f.a || ' ' || f.b || ' ' || f.t WHEN 1 THEN CASE WHEN u.alias IS NOT NULL THEN f.a || ' ' || f.t ELSE '' END ELSE CASE WHEN i.n <= 25 THEN f.a[1] || '. ' || f.t ELSE '' END END AS names
 FROM f LEFT JOIN u ON u.alias = upper(f.a || ' ' || f.t) LEFT JOIN i ON i.i = upper(f.a[1]) AND i.w = upper(f.t)) """


@query(_FOUND + "SELECT * FROM n")
def headline_names(spark, sf_dir):
    """Whole names, pairs of which one name alone has, initials with a whole word that few names share."""
    return _headlines(spark, sf_dir)[0].select("p_partkey", "title", _joined("names").alias("names"))


@query(_FOUND + "SELECT p_partkey, CASE WHEN names <> '' AND p_partkey % 3 < 2 THEN '' ELSE 'NOT_CLEARLY_BENIGN_PUBLIC_CONTEXT' END AS reasons FROM n")
def headline_classification(spark, sf_dir):
    """The closed forms around the names that were found; all else is restricted. Invented words, so no listed stem occurs."""
    never = (("NONE", ("zzzz",), ()),)
    return _headlines(spark, sf_dir)[0].select("p_partkey", _joined(news.headline_reasons(F.col("title"), F.col("names"), never)).alias("reasons"))


@query("SELECT p_partkey, CASE p_partkey % 2 WHEN 0 THEN 'professional professional habla ' || w || 'x' ELSE 'con professional' END AS masked FROM (SELECT p_partkey, lower(split_part(p_name, ' ', 1)) AS w FROM part)")
def masked_headlines(spark, sf_dir):
    first = F.lower(F.split("p_name", " ")[0])
    head = F.when(F.col("p_partkey") % 2 == 0, F.concat_ws(" ", first, F.lower("p_name"), F.lit("habla"), F.concat(first, F.lit("x")))).otherwise(F.concat_ws(" ", F.lit("con"), F.lower("p_name")))
    return _t(spark, sf_dir, "part").select("p_partkey", text.mask_names(head, F.array(first, F.lower("p_name"))).alias("masked"))


@query("SELECT p_partkey, p_partkey % 4 IN (1, 3) AS medical FROM part")
def medical_context(spark, sf_dir):
    """A leading honorific signals nothing, one within the text and a stem do."""
    forms = (F.concat(F.lit("Dra. "), F.col("p_name")), F.concat(F.lit("La Dra. "), F.col("p_name")), F.concat(F.col("p_name"), F.lit(" (hospital)")), F.concat(F.lit("Sanatorios de "), F.col("p_name")))
    c = F.coalesce(*[F.when(F.col("p_partkey") % 4 == i, f) for i, f in enumerate(forms)])
    return _t(spark, sf_dir, "part").select("p_partkey", text.medical_context(c).alias("medical"))


_CAND = """WITH c AS (SELECT event_id, user_id AS article_id, ['EXACT_NORMALIZED_NAME', 'PARTIAL_TOKEN_SUBSET', 'INITIALS_TOKEN_SUBSEQUENCE'][event_id % 3 + 1] AS kind, (event_id % 5 = 0)::INTEGER AS n_context, ['NONE', 'HOMONYM', 'MULTIPLE_POSSIBLE_PROFESSIONALS'][event_id % 7 % 3 + 1] AS ambiguity FROM events WHERE event_type <> 'view'),
a AS (SELECT user_id AS article_id, (count(*) % 4)::BIGINT AS n_names FROM events GROUP BY user_id) """


def _candidates(spark, sf_dir) -> tuple[DataFrame, DataFrame]:
    e = _t(spark, sf_dir, "events")
    pick = lambda words, i: F.element_at(F.array(*map(F.lit, words)), (i + 1).cast("int"))
    c = e.where("event_type <> 'view'").select(
        "event_id", F.col("user_id").alias("article_id"), pick(("EXACT_NORMALIZED_NAME", "PARTIAL_TOKEN_SUBSET", "INITIALS_TOKEN_SUBSEQUENCE"), F.col("event_id") % 3).alias("kind"), (F.col("event_id") % 5 == 0).cast("int").alias("n_context"),
        pick(("NONE", "HOMONYM", "MULTIPLE_POSSIBLE_PROFESSIONALS"), F.col("event_id") % 7 % 3).alias("ambiguity"),
    )
    c = c.withColumn("severity", news.alert_severity(F.col("kind"), F.col("ambiguity") != "NONE", F.col("n_context") > 0))
    return c, e.groupBy(F.col("user_id").alias("article_id")).agg((F.count(F.lit(1)) % 4).alias("n_names"))


@query(_CAND + """SELECT count(*)::BIGINT AS candidates, count(DISTINCT article_id)::BIGINT AS articles_with_candidates, (count(*) FILTER (kind[1] = 'E'))::BIGINT AS exact_candidates, (count(*) FILTER (kind[1] = 'P'))::BIGINT AS partial_candidates, (count(*) FILTER (kind[1] = 'I'))::BIGINT AS initials_candidates,
(count(*) FILTER (n_context > 0))::BIGINT AS context_corroborated, (count(*) FILTER (kind[1] = 'I' OR ambiguity <> 'NONE' OR (kind[1] = 'P' AND n_context = 0)))::BIGINT AS critical_alerts, (count(*) FILTER (ambiguity = 'HOMONYM'))::BIGINT AS homonym_candidates, (count(*) FILTER (ambiguity <> 'NONE'))::BIGINT AS ambiguous_candidates,
(SELECT count(*) FROM a)::BIGINT AS articles, (SELECT sum(n_names) FROM a)::BIGINT AS mentions, ((SELECT count(*) FROM a) - count(DISTINCT article_id))::BIGINT AS articles_without_candidates FROM c""")
def candidate_counters(spark, sf_dir):
    return news.candidate_counters(*_candidates(spark, sf_dir))


@query(_CAND + f"""SELECT event_id, 'POSSIBLE_IDENTITY_MATCH_NOT_CONFIRMED|HUMAN_REVIEW_REQUIRED|NAME_MATCH_IS_NOT_IDENTITY_PROOF|' || {FREE.format("CASE WHEN kind[1] <> 'E' THEN 'FLEXIBLE_MATCH_HIGH_FALSE_POSITIVE_RISK' END, CASE WHEN kind[1] = 'I' THEN 'INITIALS_MATCH_VERY_HIGH_FALSE_POSITIVE_RISK' END, CASE WHEN n_context > 0 THEN 'CONTEXTUAL_SIGNAL_IS_NOT_IDENTITY_PROOF' ELSE 'NO_CONTEXTUAL_CORROBORATION' END, CASE WHEN ambiguity <> 'NONE' THEN 'MULTIPLE_POSSIBLE_IDENTITIES' END")} AS codes,
{FREE.format("kind, CASE ambiguity WHEN 'HOMONYM' THEN 'HOMONYM_NORMALIZED_NAME' WHEN 'MULTIPLE_POSSIBLE_PROFESSIONALS' THEN 'MULTIPLE_PROFESSIONALS_MATCH_MENTION' END, CASE WHEN event_id % 2 = 0 THEN 'MEDICAL_CONTEXT_PRESENT' ELSE 'NO_MEDICAL_CONTEXT' END, CASE WHEN n_context > 0 THEN 'PROFESSION_CONTEXT_MATCH' END, CASE WHEN n_context > 0 THEN 'CONTEXTUAL_SIGNAL_NOT_IDENTITY_PROOF' END, CASE WHEN n_context = 0 THEN 'NAME_ONLY_NO_IDENTITY_PROOF' END, CASE WHEN n_context = 0 THEN 'NO_CONTEXTUAL_CORROBORATION' END, CASE WHEN kind[1] <> 'E' THEN 'FLEXIBLE_NAME_MATCH_REQUIRES_ENHANCED_REVIEW' END, 'NO_SECONDARY_IDENTIFIER'")} AS reasons FROM c""")
def alert_codes_reasons(spark, sf_dir):
    c, _ = _candidates(spark, sf_dir)
    corroborated, amb = F.col("n_context") > 0, F.col("ambiguity")
    reasons = news.match_reasons(F.col("kind"), amb == "HOMONYM", amb == "MULTIPLE_POSSIBLE_PROFESSIONALS", F.col("event_id") % 2 == 0, corroborated, F.lit(False))
    return c.select("event_id", _joined(news.alert_codes(F.col("kind"), amb != "NONE", corroborated)).alias("codes"), _joined(reasons).alias("reasons"))


@query("""WITH s AS (SELECT event_type, user_id, count(*) AS discovered, count(*) FILTER (value < 0) AS invalid, ['FETCHED', 'FAILED', 'STALE'][user_id % 3 + 1] AS status FROM events GROUP BY 1, 2)
SELECT count(*)::BIGINT AS sources, (count(*) FILTER (status = 'FETCHED'))::BIGINT AS sources_fetched, (count(*) FILTER (status = 'FAILED'))::BIGINT AS sources_failed, (count(*) FILTER (status = 'STALE'))::BIGINT AS sources_stale, sum(discovered)::BIGINT AS discovered, sum(invalid)::BIGINT AS invalid FROM s""")
def source_rollup(spark, sf_dir):
    status = F.element_at(F.array(F.lit("FETCHED"), F.lit("FAILED"), F.lit("STALE")), (F.col("user_id") % 3 + 1).cast("int")).alias("status")
    s = _t(spark, sf_dir, "events").groupBy("event_type", "user_id").agg(F.count(F.lit(1)).alias("discovered"), F.count_if(F.col("value") < 0).alias("invalid")).select("*", status)
    return contracts.rollup(s, ["discovered", "invalid"])


# --- public views ----------------------------------------------------------------------------------------------

_VIEWS = f"""WITH source AS (SELECT r_regionkey AS source_id, CASE r_regionkey % 2 WHEN 0 THEN 'GOVERNMENT_OPEN_DATA' ELSE 'PRESS' END AS source_kind, CASE r_regionkey WHEN 0 THEN 'PENDING' ELSE 'APPROVED' END AS source_state, 'COMPATIBLE' AS purpose, CASE r_regionkey WHEN 4 THEN 'PENDING' ELSE 'OPEN_DATA_LICENSE' END AS reuse,
 TIMESTAMP '1995-01-01' AS reviewed_at, CASE r_regionkey WHEN 3 THEN TIMESTAMP '{AS_OF}' + INTERVAL 1 SECOND ELSE TIMESTAMP '2005-01-01' END AS source_until FROM region),
release AS (SELECT n_nationkey AS release_id, n_regionkey AS source_id, DATE '1997-12-20' + n_nationkey::INTEGER AS cutoff, TIMESTAMP '1997-06-01' AS retrieved_at FROM nation),
evidence AS (SELECT o_orderkey AS evidence_id, o_orderkey + 1000000 AS evidence_public_id, o_custkey % 25 AS release_id, CASE o_orderstatus WHEN 'P' THEN 'REVOKED' ELSE 'APPROVED' END AS evidence_state, CASE o_orderpriority WHEN '5-LOW' THEN 'CANDIDATE' WHEN '1-URGENT' THEN 'SOURCE_CLAIM' ELSE 'DETERMINISTIC' END AS confidence,
 o_orderdate AS observed_at, CASE WHEN o_orderkey % 9 = 0 THEN NULL ELSE o_orderdate + INTERVAL 900 DAY END AS evidence_until FROM orders),
shown AS (SELECT * FROM evidence JOIN release USING (release_id) JOIN source USING (source_id) WHERE evidence_state = 'APPROVED' AND confidence <> 'CANDIDATE' AND observed_at <= TIMESTAMP '{AS_OF}' AND (evidence_until IS NULL OR evidence_until > TIMESTAMP '{AS_OF}')
 AND source_state = 'APPROVED' AND purpose = 'COMPATIBLE' AND reuse <> 'PENDING' AND reviewed_at <= TIMESTAMP '{AS_OF}' AND source_until > TIMESTAMP '{AS_OF}' AND cutoff <= DATE '1998-01-01' AND retrieved_at <= TIMESTAMP '{AS_OF}'),
claim AS (SELECT o_orderkey AS evidence_id, o_custkey AS subject_id, 'PROFESSIONAL_NAME' AS claim_kind, CASE WHEN o_orderkey % 7 = 0 THEN 'other' ELSE lower(c_name) END AS claim_value FROM orders JOIN customer ON o_custkey = c_custkey WHERE o_orderkey % 3 <> 1
 UNION ALL SELECT o_orderkey, o_custkey, 'REGISTERED_TITLE', 'r' FROM orders),
named AS (SELECT o_custkey, max(o_orderkey) AS evidence_id FROM orders WHERE o_orderdate < TIMESTAMP '{AS_OF}' GROUP BY 1),
professional AS (SELECT c_custkey AS professional_id, 'p' || c_custkey AS public_id, c_name AS display_name, lower(c_name) AS normalized_name, CASE c_mktsegment WHEN 'MACHINERY' THEN 'PRIVATE' ELSE 'PUBLIC' END AS visibility, evidence_id FROM customer JOIN named ON c_custkey = o_custkey),
people AS (SELECT p.professional_id, p.public_id, p.display_name, p.normalized_name, s.evidence_public_id FROM professional p JOIN shown s USING (evidence_id) JOIN claim c ON c.evidence_id = p.evidence_id AND c.subject_id = p.professional_id AND c.claim_kind = 'PROFESSIONAL_NAME' AND c.claim_value = p.normalized_name WHERE p.visibility = 'PUBLIC'),
route AS (SELECT 'customer-' || c_custkey AS slug, c_custkey AS professional_id, 'CURRENT' AS route_kind FROM customer UNION ALL SELECT 'old-' || c_custkey, c_custkey, 'REDIRECT' FROM customer WHERE c_custkey % 2 = 0),
title AS (SELECT l_orderkey * 10 + l_linenumber AS title_public_id, o_custkey AS professional_id, l_returnflag AS title, lower(l_returnflag) AS normalized_title, CASE l_linestatus WHEN 'F' THEN 'ENABLED' ELSE 'DISABLED' END AS registration_state, l_orderkey AS evidence_id FROM lineitem JOIN orders ON l_orderkey = o_orderkey) """


def _catalog(spark, sf_dir) -> dict[str, DataFrame]:
    t = lambda n: _t(spark, sf_dir, n)
    ts = lambda x: F.to_timestamp_ntz(F.lit(x))
    c, o = F.col, t("orders")
    source = t("region").select(
        c("r_regionkey").alias("source_id"), F.when(c("r_regionkey") % 2 == 0, "GOVERNMENT_OPEN_DATA").otherwise("PRESS").alias("source_kind"), F.when(c("r_regionkey") == 0, "PENDING").otherwise("APPROVED").alias("source_state"), F.lit("COMPATIBLE").alias("purpose"),
        F.when(c("r_regionkey") == 4, "PENDING").otherwise("OPEN_DATA_LICENSE").alias("reuse"), ts("1995-01-01 00:00:00").alias("reviewed_at"), F.when(c("r_regionkey") == 3, ts(AS_OF) + F.expr("INTERVAL 1 SECOND")).otherwise(ts("2005-01-01 00:00:00")).alias("source_until"),
    )
    release = t("nation").select(c("n_nationkey").alias("release_id"), c("n_regionkey").alias("source_id"), F.date_add(F.lit("1997-12-20").cast("date"), c("n_nationkey").cast("int")).alias("cutoff"), ts("1997-06-01 00:00:00").alias("retrieved_at"))
    evidence = o.select(
        c("o_orderkey").alias("evidence_id"), (c("o_orderkey") + 1000000).alias("evidence_public_id"), (c("o_custkey") % 25).alias("release_id"), F.when(c("o_orderstatus") == "P", "REVOKED").otherwise("APPROVED").alias("evidence_state"),
        F.when(c("o_orderpriority") == "5-LOW", "CANDIDATE").when(c("o_orderpriority") == "1-URGENT", "SOURCE_CLAIM").otherwise("DETERMINISTIC").alias("confidence"), c("o_orderdate").alias("observed_at"),
        F.when(c("o_orderkey") % 9 != 0, c("o_orderdate") + F.expr("INTERVAL 900 DAYS")).alias("evidence_until"),
    )
    shown = views.public_evidence(evidence, release, source, ts(AS_OF))
    owned = o.join(t("customer").select(c("c_custkey").alias("o_custkey"), "c_name"), "o_custkey")
    value = F.when(c("o_orderkey") % 7 == 0, "other").otherwise(F.lower("c_name"))
    claim = owned.where("o_orderkey % 3 <> 1").select(c("o_orderkey").alias("evidence_id"), c("o_custkey").alias("subject_id"), F.lit("PROFESSIONAL_NAME").alias("claim_kind"), value.alias("claim_value"))
    claim = claim.union(o.select("o_orderkey", "o_custkey", F.lit("REGISTERED_TITLE"), F.lit("r")))
    named = o.where(c("o_orderdate") < ts(AS_OF)).groupBy(c("o_custkey").alias("c_custkey")).agg(F.max("o_orderkey").alias("evidence_id"))
    professional = t("customer").join(named, "c_custkey").select(c("c_custkey").alias("professional_id"), F.concat(F.lit("p"), c("c_custkey").cast("string")).alias("public_id"), c("c_name").alias("display_name"), F.lower("c_name").alias("normalized_name"), F.when(c("c_mktsegment") == "MACHINERY", "PRIVATE").otherwise("PUBLIC").alias("visibility"), "evidence_id")
    key = c("c_custkey").cast("string")
    route = t("customer").select(F.concat(F.lit("customer-"), key).alias("slug"), c("c_custkey").alias("professional_id"), F.lit("CURRENT").alias("route_kind"))
    route = route.union(t("customer").where("c_custkey % 2 = 0").select(F.concat(F.lit("old-"), key), "c_custkey", F.lit("REDIRECT")))
    title = t("lineitem").join(o, c("l_orderkey") == c("o_orderkey")).select(
        (c("l_orderkey") * 10 + c("l_linenumber")).alias("title_public_id"), c("o_custkey").alias("professional_id"), c("l_returnflag").alias("title"), F.lower("l_returnflag").alias("normalized_title"), F.when(c("l_linestatus") == "F", "ENABLED").otherwise("DISABLED").alias("registration_state"), c("l_orderkey").alias("evidence_id"),
    )
    return {"source": source, "release": release, "evidence": evidence, "shown": shown, "claim": claim, "professional": professional, "people": views.public_professional(professional, shown, claim), "route": route, "title": title}


@query(_VIEWS + "SELECT evidence_public_id, confidence, source_kind, cutoff::VARCHAR AS cutoff FROM shown")
def public_evidence_view(spark, sf_dir):
    return _catalog(spark, sf_dir)["shown"].select("evidence_public_id", "confidence", "source_kind", F.col("cutoff").cast("string").alias("cutoff"))


@query(_VIEWS + "SELECT public_id, display_name, normalized_name, evidence_public_id FROM people")
def public_professional_view(spark, sf_dir):
    return _catalog(spark, sf_dir)["people"].select("public_id", "display_name", "normalized_name", "evidence_public_id")


@query(_VIEWS + "SELECT slug, public_id, route_kind FROM route JOIN people USING (professional_id)")
def public_route_view(spark, sf_dir):
    c = _catalog(spark, sf_dir)
    return views.public_route(c["route"], c["people"])


@query(_VIEWS + "SELECT t.title_public_id, p.public_id, t.title, t.normalized_title, s.evidence_public_id FROM title t JOIN people p USING (professional_id) JOIN shown s USING (evidence_id) JOIN claim c ON c.evidence_id = t.evidence_id AND c.subject_id = t.professional_id AND c.claim_kind = 'REGISTERED_TITLE' AND c.claim_value = t.normalized_title WHERE t.registration_state = 'ENABLED' AND s.confidence IN ('DETERMINISTIC', 'HUMAN_VERIFIED') AND s.source_kind IN ('GOVERNMENT_OPEN_DATA', 'OFFICIAL_PUBLICATION')")
def public_title_view(spark, sf_dir):
    c = _catalog(spark, sf_dir)
    return views.public_title(c["title"], c["people"], c["shown"], c["claim"])


@query(_VIEWS + "SELECT normalized_name, public_id, slug FROM people JOIN route USING (professional_id) WHERE route_kind = 'CURRENT' AND contains(normalized_name, '1') ORDER BY normalized_name, public_id LIMIT 21")
def search_current_route(spark, sf_dir):
    """A page of a search: names that hold the folded term, by the route that is current."""
    c = _catalog(spark, sf_dir)
    rows = views.searchable(c["people"], views.public_route(c["route"], c["people"])).where(search.contains_folded(F.col("normalized_name"), " 1 ".strip()))
    return search.keyset_page(rows, "normalized_name", "public_id", 20).select("normalized_name", "public_id", "slug")


@query(_VIEWS + "SELECT p.public_id, s.confidence, s.source_kind FROM people p JOIN shown s USING (evidence_public_id)")
def evidence_lookup(spark, sf_dir):
    c = _catalog(spark, sf_dir)
    return views.with_evidence(c["people"], c["shown"]).select("public_id", "confidence", "source_kind")


@query("""SELECT 'unreviewed_source' AS rule, count(*)::BIGINT AS n FROM nation WHERE n_nationkey % 4 <> 3 AND NOT (n_nationkey % 5 > 0 AND length(trim(substr(n_name, 1, (n_nationkey % 6)::INTEGER))) > 0 AND ((n_nationkey % 2 = 0) = (n_nationkey % 3 = 0)))
UNION ALL SELECT 'approved_candidate', count(*) FROM orders WHERE o_orderstatus <> 'P' AND o_orderpriority = '5-LOW' UNION ALL SELECT 'public_id', count(*) FROM customer WHERE c_custkey % 10 = 0 OR c_custkey % 10 = 1
UNION ALL SELECT 'bad_slug', count(*) FROM customer WHERE c_custkey % 3 = 0 OR c_custkey % 7 = 0 UNION ALL SELECT 'several_current', count(DISTINCT o_custkey) FROM (SELECT o_custkey FROM orders WHERE o_orderstatus = 'P' GROUP BY 1 HAVING count(*) > 1)
UNION ALL SELECT 'changed_public_id', count(*) FROM customer WHERE c_custkey % 11 = 0 UNION ALL SELECT 'repeated_title', count(*) FROM (SELECT o_custkey, l_returnflag FROM lineitem JOIN orders ON l_orderkey = o_orderkey GROUP BY ALL HAVING count(*) > 1)
UNION ALL SELECT 'dangling_customer', count(*) FROM orders ANTI JOIN customer ON o_custkey + 10 = c_custkey UNION ALL SELECT 'dangling_nation', count(*) FROM customer ANTI JOIN nation ON c_nationkey + 1 = n_nationkey UNION ALL SELECT 'dangling_region', count(*) FROM nation ANTI JOIN region ON n_regionkey + 2 = r_regionkey
UNION ALL SELECT 'dangling_order', count(*) FROM lineitem ANTI JOIN orders ON l_orderkey + 40 = o_orderkey UNION ALL SELECT 'dangling_part', count(*) FROM lineitem ANTI JOIN part ON l_partkey + 3 = p_partkey UNION ALL SELECT 'dangling_supplier', count(*) FROM lineitem ANTI JOIN supplier ON l_suppkey + 1 = s_suppkey""")
def catalog_rules(spark, sf_dir):
    """Integrity rules, each on rows that a share of the keys breaks."""
    t, c = lambda n: _t(spark, sf_dir, n), F.col
    k = c("n_nationkey")
    source = t("nation").select(
        F.when(k % 4 != 3, "APPROVED").otherwise("PENDING").alias("source_state"), F.lit("COMPATIBLE").alias("purpose"), F.when(k % 2 == 0, "DATA_SUBJECT_CONSENT").otherwise("WRITTEN_AUTHORIZATION").alias("reuse"), F.expr("substr(n_name, 1, CAST(n_nationkey % 6 AS INT))").alias("policy_id"), F.lit("me").alias("reviewed_by"),
        F.lit("ref").alias("review_reference"), F.to_timestamp_ntz(F.lit("1995-01-01 00:00:00")).alias("reviewed_at"), F.when(k % 5 > 0, F.to_timestamp_ntz(F.lit("1996-01-01 00:00:00"))).alias("source_until"), F.lit(None).cast("string").alias("license_url"), F.when(k % 3 == 0, "DATA_SUBJECT_CLAIM").otherwise("PRESS").alias("source_kind"),
    )
    people = t("customer").select("c_custkey", F.when(c("c_custkey") % 10 == 0, c("c_custkey")).when(c("c_custkey") % 10 == 1, F.lit(-1)).otherwise(c("c_custkey") + 1000000).alias("public_id"))
    slugs = t("customer").select(F.when(c("c_custkey") % 3 == 0, "Bad--slug").when(c("c_custkey") % 7 == 0, "01234567-89ab-8def-8123-456789abcdef").otherwise(F.concat(F.lit("a-"), c("c_custkey").cast("string"))).alias("slug"))
    evidence = t("orders").select(F.when(c("o_orderstatus") == "P", "REVOKED").otherwise("APPROVED").alias("evidence_state"), F.when(c("o_orderpriority") == "5-LOW", "CANDIDATE").otherwise("DETERMINISTIC").alias("confidence"))
    routes = t("orders").select(c("o_custkey").alias("professional_id"), F.when(c("o_orderstatus") == "P", "CURRENT").otherwise("REDIRECT").alias("route_kind"))
    later = people.select("c_custkey", F.when(c("c_custkey") % 11 == 0, F.lit(-7)).otherwise(c("public_id")).alias("public_id"))
    titles = t("lineitem").join(t("orders"), c("l_orderkey") == c("o_orderkey")).select("o_custkey", "l_returnflag")
    moved = lambda df, key, by: df.withColumn("_k", c(key) + by)
    found = {
        "unreviewed_source": views.unreviewed_sources(source), "approved_candidate": views.approved_candidates(evidence), "public_id": views.shared_public_ids(people, "c_custkey", "public_id"), "bad_slug": views.bad_slugs(slugs), "several_current": views.several_current(routes),
        "changed_public_id": views.changed_public_ids(people, later, "c_custkey", "public_id"), "repeated_title": views.repeated(titles, ["o_custkey", "l_returnflag"]), "dangling_customer": views.dangling(moved(t("orders"), "o_custkey", 10), "_k", t("customer"), "c_custkey"),
        "dangling_nation": views.dangling(moved(t("customer"), "c_nationkey", 1), "_k", t("nation"), "n_nationkey"), "dangling_region": views.dangling(moved(t("nation"), "n_regionkey", 2), "_k", t("region"), "r_regionkey"), "dangling_order": views.dangling(moved(t("lineitem"), "l_orderkey", 40), "_k", t("orders"), "o_orderkey"),
        "dangling_part": views.dangling(moved(t("lineitem"), "l_partkey", 3), "_k", t("part"), "p_partkey"), "dangling_supplier": views.dangling(moved(t("lineitem"), "l_suppkey", 1), "_k", t("supplier"), "s_suppkey"),
    }
    out = None
    for rule, df in found.items():
        n = df.agg(F.lit(rule).alias("rule"), F.count(F.lit(1)).alias("n"))
        out = n if out is None else out.union(n)
    return out


# --- contracts -------------------------------------------------------------------------------------------------


@query("SELECT o_orderkey, o_orderkey % 4 = 0 AS exact, o_orderkey % 4 <> 3 AS closed FROM orders")
def closed_shapes(spark, sf_dir):
    k = F.col("o_orderkey")
    doc = F.to_json(F.struct(F.lit(1).alias("a"), F.when(k % 4 != 1, F.lit("x")).alias("b"), F.when(k % 4 == 2, F.lit(None)).otherwise(F.struct(k.alias("d"))).alias("c"), F.when(k % 4 == 3, F.lit(0)).alias("e")))
    d = F.col("doc")
    return _t(spark, sf_dir, "orders").select("o_orderkey", doc.alias("doc")).select("o_orderkey", contracts.exact_keys(d, ["c", "a", "b"]).alias("exact"), contracts.only_keys(d, ["a", "b", "c"]).alias("closed"))


@query("""WITH v AS (SELECT o_orderkey, o_orderkey % 13 AS k, ['5', '05', '-1', ' ', '1997-02-28', '1997-02-30', '1997-02-28T10:00:00.000Z', '1997-02-28T10:00:00Z', 'https://a.org/x?y', 'https://me@a.org/', 'me@a.org', 'TBD', NULL] AS v FROM orders)
SELECT o_orderkey, k NOT IN (3, 12) AS is_text, k = 0 AS is_count, k = 4 AS is_date, k = 6 AS is_instant, false AS is_sha256, k = 8 AS is_https, k IN (9, 10) AS is_email, k NOT IN (3, 11, 12) AS is_real FROM v""")
def field_checks(spark, sf_dir):
    values = ["5", "05", "-1", " ", "1997-02-28", "1997-02-30", "1997-02-28T10:00:00.000Z", "1997-02-28T10:00:00Z", "https://a.org/x?y", "https://me@a.org/", "me@a.org", "TBD", None]
    v = _t(spark, sf_dir, "orders").select("o_orderkey", F.element_at(F.array(*map(F.lit, values)), (F.col("o_orderkey") % 13 + 1).cast("int")).alias("v"))
    c = F.col("v")
    checks = {"is_text": contracts.is_text, "is_count": contracts.is_count, "is_date": contracts.is_date, "is_instant": contracts.is_instant, "is_sha256": contracts.is_sha256, "is_https": contracts.is_https, "is_email": contracts.is_email, "is_real": contracts.is_real_text}
    return v.select("o_orderkey", *[f(c).alias(n) for n, f in checks.items()])


@query(f"SELECT c_custkey, trim(CASE WHEN c_custkey % 5 = 0 THEN '  ' ELSE c_name END) AS name, ' ' || c_mktsegment || ' ' AS code, {_codes(('c_custkey % 5 = 0', 'EMPTY_NAME'), ('c_custkey % 7 = 0', 'EMPTY_TITLE'))} AS violations FROM customer")
def registry_rows(spark, sf_dir):
    k = F.col("c_custkey")
    rows = _t(spark, sf_dir, "customer").select("c_custkey", F.when(k % 5 == 0, "  ").otherwise(F.concat(F.lit("  "), F.col("c_name"), F.lit(" \t"))).alias("name"), F.when(k % 7 != 0, F.lit(" t ")).alias("title"), F.concat(F.lit(" "), F.col("c_mktsegment"), F.lit(" ")).alias("code"))
    out = contracts.registry_rows(rows.withColumn("c_custkey", F.col("c_custkey").cast("string")), ["name", "title"], ("code",))
    return out.select(F.col("c_custkey").cast("long").alias("c_custkey"), "name", "code", _joined("violations").alias("violations"))


@query("SELECT c_custkey, CASE c_custkey % 3 WHEN 0 THEN 'NONE' WHEN 1 THEN 'WITH_CONTRACT' ELSE 'WITHOUT_CONTRACT' END AS kind, c_custkey % 4 <> 0 AS safe FROM customer")
def temporary_and_safe_names(spark, sf_dir):
    k = F.col("c_custkey")
    value = F.when(k % 3 == 1, "Registro Temporario con Contrato").when(k % 3 == 2, "Registro Temporario sin Contrato")
    name = F.when(k % 4 == 0, "Dr. Solo").otherwise("Dr. Ana Sol")
    return _t(spark, sf_dir, "customer").select("c_custkey", contracts.temporary_registration(value).alias("kind"), contracts.safe_name(name).alias("safe"))


@query(f"""SELECT c_custkey, CASE WHEN c_custkey % 2 = 0 THEN 'DIRECTORY_FACTUAL_V3' ELSE 'MSP_INFOTITULOS_NORMALIZED' END AS format, CASE WHEN c_custkey % 11 = 0 THEN 'x' ELSE 'msp_doc_v1_' || sha256(c_custkey::VARCHAR) END AS professional_id, array_to_string(list_sort(list_distinct([c_mktsegment, 'A'])), '|') AS professions,
{_codes(("c_custkey % 2 = 1 AND c_custkey % 3 = 0", 'FORBIDDEN_FIELD'), ("c_custkey % 11 = 0", 'INVALID_ID'), ("c_custkey % 7 = 0", 'UNSAFE_NAME'), ("c_custkey % 2 = 0 AND c_custkey % 5 = 0", 'NOT_FAIL_CLOSED'))} AS violations FROM customer""")
def professional_formats(spark, sf_dir):
    k, s = F.col("c_custkey"), F.struct
    pid = F.when(k % 11 == 0, "x").otherwise(F.concat(F.lit("msp_doc_v1_"), F.sha2(k.cast("string"), 256)))
    name = F.when(k % 7 == 0, "Uno").otherwise("Ana Sol")
    where = s(F.lit("p").alias("publisher"), F.lit("d").alias("dataset"), F.lit("2026-06-30").alias("sourceCutoffDate"))
    directory_doc = F.to_json(s(F.lit(2).alias("schemaVersion"), pid.alias("internalLinkageId"), name.alias("displayName"), F.array(F.concat(F.col("c_mktsegment"), F.lit(" ")), F.lit("A"), F.lit("A")).alias("enabledTitles"), where.alias("officialRegistry"), s((k % 5 == 0).alias("publicExportAllowed")).alias("publication")))
    titles = F.array(s(F.col("c_mktsegment").alias("title")), s(F.lit("A").alias("title")))
    registry_doc = F.to_json(s(pid.alias("linkageId"), name.alias("fullName"), titles.alias("enabledTitles"), where.alias("provenance"), F.when(k % 3 == 0, "1").alias("email")))
    lines = _t(spark, sf_dir, "customer").select("c_custkey", F.when(k % 2 == 0, directory_doc).otherwise(registry_doc).alias("value"))
    return contracts.professionals(lines, "value").select("c_custkey", "format", "professional_id", _joined("professions").alias("professions"), _joined("violations").alias("violations"))


@query("""SELECT s_suppkey, CASE s_suppkey % 10 WHEN 0 THEN 'INVALID_REVIEW_DATES' WHEN 1 THEN 'INVALID_TERMS_URL' WHEN 2 THEN 'GATE_INCONSISTENT' WHEN 3 THEN 'OMITTED' WHEN 4 THEN 'SWITCH_NOT_BOOLEAN' WHEN 5 THEN 'REFERENCE_MISSING' WHEN 6 THEN 'AUTHORIZATION_NOT_APPROVED' WHEN 7 THEN 'REVIEW_EXPIRED' ELSE 'ENABLED' END AS outcome,
CASE WHEN s_suppkey % 10 = 8 THEN sha256('reference ' || s_suppkey) ELSE '' END AS digest FROM supplier""")
def source_rights(spark, sf_dir):
    k = F.col("s_suppkey") % 10
    reference = F.concat(F.lit("reference "), F.col("s_suppkey").cast("string"))
    sources = _t(spark, sf_dir, "supplier").select(
        "s_suppkey", F.col("s_suppkey").alias("id"), F.when(k.isin(2, 9, 7), "OPEN_TERMS").otherwise("WRITTEN_AUTHORIZATION_REQUIRED").alias("basis"), F.when(k == 0, "1997-02-30").otherwise("1997-01-01").alias("reviewed_on"), F.when(k == 7, "1997-12-31").otherwise("1998-01-01").alias("expires_on"),
        F.when(k == 1, "https://me:x@a.org").otherwise("https://a.org/terms").alias("terms_url"), (~k.isin(9, 7)).alias("gated"), F.when(k == 3, " False ").when(k == 4, "on").otherwise(" TRUE ").alias("switch"), F.when(k == 5, "short").otherwise(reference).alias("reference"),
        F.when(k == 6, F.array(F.lit("0" * 64))).otherwise(F.array(F.upper(F.sha2(reference, 256)), F.lit(" "))).alias("approved"),
    )
    return contracts.source_rights(sources, "1998-01-01T00:00:00.000Z").select("s_suppkey", "outcome", F.coalesce("authorization_sha256", F.lit("")).alias("digest"))


@query("SELECT 1::BIGINT AS cutoffs, '2026-06-30' AS cutoff, 'SOURCE_TOO_OLD' AS violations")
def source_freshness(spark, sf_dir):
    profiles = _t(spark, sf_dir, "customer").select(F.lit("2026-06-30").cast("date").alias("cutoff"))
    out = contracts.source_freshness(profiles, "cutoff", "2026-06-30", 30, "2026-08-01")
    return out.select("cutoffs", "cutoff", _joined("violations").alias("violations"))


_ARTICLE = """WITH a AS (SELECT o_orderkey, o_custkey, o_orderkey % 12 AS k, 'https://host' || (o_custkey % 3) || '.org/' || o_orderkey AS url, '1997-12-31T10:00:00.000Z' AS published FROM orders) """


def _articles(spark, sf_dir) -> DataFrame:
    c, k = F.col, F.col("o_orderkey") % 12
    url = F.concat(F.lit("https://host"), (c("o_custkey") % 3).cast("string"), F.lit(".org/"), c("o_orderkey").cast("string"))
    published = F.when(k == 1, "1997-11-01T10:00:00.000Z").otherwise("1997-12-31T10:00:00.000Z")
    retrieved = F.when(k == 2, "1997-12-31T09:00:00.000Z").otherwise("1998-01-01T00:00:00.000Z")
    a = _t(spark, sf_dir, "orders").select(
        "o_orderkey", F.concat(F.lit("s"), (c("o_custkey") % 3).cast("string")).alias("source_id"), F.lit(1).alias("schema_version"), F.when(k == 3, " ").otherwise("Ana Sol recibió un premio").alias("headline"),
        F.when(k == 4, F.array(F.lit("Ana"))).when(k == 5, F.array(F.lit("Ana Sol"), F.lit("ANA SOL"))).otherwise(F.array(F.lit("Ana Sol"))).alias("names"), F.when(k == 6, "other").otherwise("paper").alias("publisher"), url.alias("url"), published.alias("published_at"), retrieved.alias("retrieved_at"),
        F.when(k == 7, "1997-12-31T23:00:00.000Z").otherwise(retrieved).alias("extracted_at"), F.when(k == 8, "GUESS").otherwise("DETERMINISTIC_PARSER").alias("method"), F.lit("v1").alias("extractor_version"),
    )
    a = a.withColumn("content_sha256", F.when(k == 9, F.sha2(F.lit("x"), 256)).otherwise(contracts.content_sha256(c("headline"), c("url"), c("published_at"))))
    return a.withColumn("article_id", F.when(k == 10, "paper:0000000000").otherwise(contracts.article_id(F.lit("paper"), c("url"))))


@query(_ARTICLE + f"SELECT o_orderkey, {_codes(('k = 3', 'HEADLINE'), ('k IN (4, 5)', 'NAMES_NOT_UNIQUE_OR_SHORT'), ('k IN (3, 4, 5)', 'HEADLINE_RESTRICTED'), ('k = 2', 'RETRIEVED_BEFORE_PUBLISHED'), ('k = 7', 'EXTRACTED_BEFORE_RETRIEVED'), ('k = 8', 'METHOD'))} AS violations FROM a")
def article_contract(spark, sf_dir):
    a = _articles(spark, sf_dir)
    restricted = F.size(news.headline_reasons(F.col("headline"), F.col("names"))) > 0
    return a.select("o_orderkey", _joined(contracts.article_violations(restricted)).alias("violations"))


@query(_ARTICLE + f"SELECT o_orderkey, {_codes(('o_custkey % 3 = 2', 'SOURCE_NOT_FETCHED'), ('o_custkey % 3 = 2 OR k = 6', 'PUBLISHER'), ('o_custkey % 3 <> 0', 'HOST'), ('o_custkey % 3 = 2 OR k = 2', 'RETRIEVAL'), ('k IN (1, 2)', 'OUTSIDE_WINDOW'), ('k IN (7, 8)', 'COLLECTOR'), ('k = 9', 'CONTENT_SHA256'), ('o_custkey % 3 = 2 OR k = 10', 'ARTICLE_ID'))} AS violations FROM a")
def article_conformance(spark, sf_dir):
    """Articles against their source's report: one source has other hosts, one no report."""
    report = spark.createDataFrame([("s0", "FETCHED", "paper", "paper", ["host0.org", "host1.org"], "1998-01-01T00:00:00.000Z"), ("s1", "FETCHED", "paper", "paper", ["host0.org"], "1998-01-01T00:00:00.000Z")], "source_id string, s_status string, s_publisher string, s_publisher_key string, s_hosts array<string>, s_retrieved_at string")
    out = contracts.conforming(_articles(spark, sf_dir), report, "1998-01-01T00:00:00.000Z", "v1")
    return out.select("o_orderkey", _joined("violations").alias("violations"))


@query(f"SELECT event_id, {_codes(('event_id % 17 = 0', 'DUPLICATE_ID'), ('event_id % 3 = 1', 'QUARANTINE'), ('event_id % 5 = 1', 'LINKED'), ('event_id % 7 = 1', 'PUBLISHED'), ('event_id % 11 = 1', 'NAME_ONLY'), ('event_id % 13 = 1', 'ALERTS'), ('event_id % 19 = 1', 'RAW_VALUE_IN_ID'))} AS violations FROM events WHERE event_id % 17 <> 0 OR event_id < (SELECT max(event_id) FROM events)")
def candidate_safeguards(spark, sf_dir):
    e, k = _t(spark, sf_dir, "events"), F.col("event_id")
    last = e.agg(F.max("event_id").alias("last"))
    e = e.crossJoin(last).where("event_id % 17 <> 0 OR event_id < last")  # one row
    raw = F.lit("Ana Sol")
    ident = F.when(k % 17 == 0, F.lit("twice")).when(k % 19 == 1, F.concat(F.lit("c-"), raw, k.cast("string"))).otherwise(F.concat(F.lit("c-"), k.cast("string")))
    ident = F.when((k % 17 == 0) & (k % 19 == 1), F.lit("twice Ana Sol")).otherwise(ident)
    codes = F.when(k % 13 == 1, F.array(F.lit("HUMAN_REVIEW_REQUIRED"))).otherwise(F.array(*map(F.lit, ("POSSIBLE_IDENTITY_MATCH_NOT_CONFIRMED", "HUMAN_REVIEW_REQUIRED", "FLEXIBLE_MATCH_HIGH_FALSE_POSITIVE_RISK"))))
    c = e.select(
        "event_id", ident.alias("candidate_id"), F.lit(2).alias("schema_version"), F.lit("NEEDS_HUMAN_REVIEW").alias("state"), (k % 3 != 1).alias("quarantine"), F.when(k % 5 == 1, "LINKED").otherwise("NOT_LINKED").alias("decision"), F.lit(False).alias("identity_confirmed"),
        F.lit("NOT_PUBLISHED").alias("publication"), (k % 7 == 1).alias("export_allowed"), F.array(F.lit(False)).alias("automatic"), (k % 11 != 1).alias("name_only"), F.lit(True).alias("requires_review"), F.lit(0).alias("n_context"), F.lit("PARTIAL_TOKEN_SUBSET").alias("kind"), codes.alias("alert_codes"), F.lit("m").alias("alert_message"), F.array(raw).alias("raw"),
    )
    return contracts.candidate_violations(c).select("event_id", _joined("violations").alias("violations"))


@query("SELECT o_orderkey, CASE o_orderkey % 8 WHEN 0 THEN 'complete_manifest_v1' WHEN 4 THEN 'legacy_casmu_v1' WHEN 6 THEN 'legacy_hospital_britanico_v1' ELSE '' END AS mode FROM orders")
def bundle_modes(spark, sf_dir):
    forms = (
        '{"status":"complete","scope":"full_filter_enumeration","counts":{"doctorRequestsFailed":0,"doctorResponsesAtPossibleSourceLimit":0,"recordsWritten":9,"sourceRowsParsed":10,"duplicateRowsSkipped":1}}',
        '{"status":"complete","scope":"full_filter_enumeration","counts":{"doctorRequestsFailed":1,"doctorResponsesAtPossibleSourceLimit":0,"recordsWritten":9}}',
        '{"status":"complete","scope":"full_filter_enumeration","counts":{"doctorRequestsFailed":0,"doctorResponsesAtPossibleSourceLimit":0,"recordsWritten":9,"sourceRowsParsed":11,"duplicateRowsSkipped":1}}',
        '{"status":"partial","schemaVersion":"1.0.0","provider":"CASMU","extraction":{"directorySourceRows":3,"directoryUniqueRecords":1,"directoryDuplicateRowsDiscarded":1,"directoryInvalidRows":1,"scheduleRecords":0}}',
        '{"schemaVersion":"1.0.0","provider":"CASMU","extraction":{"directorySourceRows":3,"directoryUniqueRecords":1,"directoryDuplicateRowsDiscarded":1,"directoryInvalidRows":1,"scheduleRecords":0}}',
        '{"schemaVersion":"1.0.0","provider":"CASMU","extraction":{"directorySourceRows":4,"directoryUniqueRecords":1,"directoryDuplicateRowsDiscarded":1,"directoryInvalidRows":1,"scheduleRecords":0}}',
        '{"schemaVersion":"1.0.0","provider":"Hospital Británico","extraction":{"candidateScheduleEntries":5,"invalidPhysicianRows":0,"invalidScheduleEntries":0,"duplicateEntriesDiscarded":2,"scheduleRecords":3}}',
        '{"schemaVersion":"1.0.0","provider":"Hospital Británico","extraction":{"candidateScheduleEntries":5,"invalidPhysicianRows":1,"invalidScheduleEntries":0,"duplicateEntriesDiscarded":2,"scheduleRecords":3}}',
    )
    manifest = F.element_at(F.array(*map(F.lit, forms)), (F.col("o_orderkey") % 8 + 1).cast("int"))
    m = _t(spark, sf_dir, "orders").select("o_orderkey", manifest.alias("m"))
    return m.select("o_orderkey", F.coalesce(contracts.bundle_mode(F.col("m")), F.lit("")).alias("mode"))


@query("""WITH i AS (SELECT l_orderkey, list({'path': l_returnflag, 'sha256': sha256(l_returnflag), 'records': l_linenumber}) AS i FROM lineitem GROUP BY 1)
SELECT l_orderkey, coalesce(CASE WHEN len(list_filter(i, lambda x: x.path = 'R')) = 1 THEN list_filter(i, lambda x: x.path = 'R')[1].records END, 0)::BIGINT AS records, CASE WHEN len(list_filter(i, lambda x: x.path = 'R')) = 1 THEN CASE WHEN list_filter(i, lambda x: x.path = 'R')[1].records = 2 THEN '' ELSE 'RECORDS_DIFFERS' END ELSE 'PATH_DIFFERS|SHA256_DIFFERS|RECORDS_DIFFERS' END AS differs FROM i""")
def manifest_inputs(spark, sf_dir):
    """The one input of a manifest that matches, and in what it differs from the artifact."""
    entry = F.struct(F.col("l_returnflag").alias("path"), F.sha2("l_returnflag", 256).alias("sha256"), F.col("l_linenumber").cast("long").alias("records"))
    m = _t(spark, sf_dir, "lineitem").groupBy("l_orderkey").agg(F.collect_list(entry).alias("inputs"))
    one = contracts.single_input(F.col("inputs"), lambda x: x["path"] == "R")
    artifact = F.struct(F.lit("R").alias("path"), F.sha2(F.lit("R"), 256).alias("sha256"), F.lit(2).cast("long").alias("records"))
    m = m.select("l_orderkey", one.alias("one"), artifact.alias("a"))
    return m.select("l_orderkey", F.coalesce("one.records", F.lit(0)).cast("long").alias("records"), _joined(contracts.differing(F.col("one"), F.col("a"))).alias("differs"))


@query("SELECT p_partkey FROM part ANTI JOIN (SELECT ps FROM (SELECT l_partkey AS ps FROM lineitem WHERE l_quantity > 46)) ON p_partkey = ps")
def missing_inputs(spark, sf_dir):
    given = _t(spark, sf_dir, "lineitem").where("l_quantity > 46").select(F.col("l_partkey").alias("p_partkey"))
    return contracts.missing_inputs(_t(spark, sf_dir, "part").select("p_partkey"), given, "p_partkey")


@query("SELECT c_custkey, min(c_name) AS c_name FROM (SELECT c_custkey % 700 AS c_custkey, c_name FROM customer) WHERE c_custkey NOT IN (SELECT o_custkey FROM orders WHERE o_orderstatus = 'P') GROUP BY 1")
def seed_new_rows(spark, sf_dir):
    rows = _t(spark, sf_dir, "customer").select((F.col("c_custkey") % 700).alias("c_custkey"), "c_name")
    there = _t(spark, sf_dir, "orders").where("o_orderstatus = 'P'").select(F.col("o_custkey").alias("c_custkey"))
    return stores.new_rows(rows, there, ["c_custkey"])


# --- directories -----------------------------------------------------------------------------------------------

_RECORDS = """r AS (SELECT c_custkey, CASE WHEN c_custkey % 5 > 0 THEN 'https://c' || c_nationkey END AS center_url, 'Dr. ' || c_mktsegment AS physician, CASE WHEN c_custkey % 3 = 0 THEN '' ELSE 'ñ' || c_mktsegment END AS address, 'n' || c_name AS center FROM customer),
s AS (SELECT o_orderkey, 'https://c' || (o_custkey % 25) AS requested_url, ['BUILDING', 'MACHINERY', 'FURNITURE'][o_orderkey % 3 + 1] AS physician, 's' || o_orderkey AS record_id FROM orders WHERE o_orderkey % 4 = 0)"""


def _records(spark, sf_dir) -> tuple[DataFrame, DataFrame]:
    c = F.col
    r = _t(spark, sf_dir, "customer").select("c_custkey", F.when(c("c_custkey") % 5 > 0, F.concat(F.lit("https://c"), c("c_nationkey").cast("string"))).alias("center_url"), F.concat(F.lit("Dr. "), c("c_mktsegment")).alias("physician"), F.when(c("c_custkey") % 3 == 0, "").otherwise(F.concat(F.lit("ñ"), c("c_mktsegment"))).alias("address"), F.concat(F.lit("n"), c("c_name")).alias("center"))
    who = F.element_at(F.array(F.lit("BUILDING"), F.lit("MACHINERY"), F.lit("FURNITURE")), (c("o_orderkey") % 3 + 1).cast("int"))
    s = _t(spark, sf_dir, "orders").where("o_orderkey % 4 = 0").select(F.concat(F.lit("https://c"), (c("o_custkey") % 25).cast("string")).alias("requested_url"), who.alias("physician"), F.concat(F.lit("s"), c("o_orderkey").cast("string")).alias("record_id"))
    return r, s


@query(f"WITH {_RECORDS}, g AS (SELECT requested_url, physician, list_sort(list(record_id)) AS ids FROM s GROUP BY ALL) SELECT c_custkey, coalesce(array_to_string(ids, '|'), '') AS schedules, CASE WHEN ids IS NULL THEN 'not_published_on_source' ELSE 'published_on_center_page' END AS schedule_type FROM r LEFT JOIN g ON r.center_url = g.requested_url AND r.physician = 'Dr. ' || g.physician")
def directory_schedules(spark, sf_dir):
    return directory.with_schedule_text(*_records(spark, sf_dir)).select("c_custkey", "schedules", "schedule_type")


@query(f"WITH {_RECORDS}, g AS (SELECT DISTINCT requested_url, physician, record_id FROM s), u AS (SELECT DISTINCT g.record_id FROM r JOIN g ON r.center_url = g.requested_url AND r.physician = 'Dr. ' || g.physician) SELECT (SELECT count(*) FROM s)::BIGINT AS schedules, (SELECT count(*) FROM u)::BIGINT AS linked, ((SELECT count(*) FROM s) - (SELECT count(*) FROM u))::BIGINT AS unlinked")
def linked_schedules(spark, sf_dir):
    r, s = _records(spark, sf_dir)
    return directory.linked_schedules(directory.with_schedules(r, s), s)


@query(f"WITH {_RECORDS} SELECT center_url, coalesce(min(address) FILTER (address <> ''), '') AS address, min(center) AS center FROM r WHERE center_url IS NOT NULL GROUP BY 1")
def center_names(spark, sf_dir):
    return directory.centers(_records(spark, sf_dir)[0])


@query("WITH s AS (SELECT *, o_orderkey % 3 AS n FROM orders) SELECT count(*)::BIGINT AS records, (count(*) FILTER (n = 0))::BIGINT AS without_intervals, (count(*) FILTER (n > 1))::BIGINT AS several_intervals, count(DISTINCT o_custkey)::BIGINT AS physicians, count(DISTINCT o_orderpriority)::BIGINT AS specialties, count(DISTINCT nullif(o_orderstatus, 'P'))::BIGINT AS clinics FROM s")
def provider_counts(spark, sf_dir):
    o = _t(spark, sf_dir, "orders").withColumns({"intervals": F.slice(F.array(F.lit(1), F.lit(2)), 1, (F.col("o_orderkey") % 3).cast("int")), "o_orderstatus": F.nullif("o_orderstatus", F.lit("P"))})
    return directory.run_counts(o, "o_custkey", "o_orderpriority", "o_orderstatus", "intervals")


@query("WITH p AS (SELECT c_custkey, list(o_orderstatus) FILTER (o_orderkey IS NOT NULL) AS s FROM customer LEFT JOIN orders ON c_custkey = o_custkey GROUP BY 1) SELECT count(*)::BIGINT AS profiles, (count(*) FILTER (s IS NOT NULL))::BIGINT AS with_resolutions, sum(len(list_filter(s, lambda x: x = 'F')))::BIGINT AS F, sum(len(list_filter(s, lambda x: x = 'O')))::BIGINT AS O FROM p")
def resolution_counts(spark, sf_dir):
    held = _t(spark, sf_dir, "orders").groupBy(F.col("o_custkey").alias("c_custkey")).agg(F.collect_list(F.struct(F.col("o_orderstatus").alias("status"))).alias("resolutions"))
    p = _t(spark, sf_dir, "customer").select("c_custkey").join(held, "c_custkey", "left").withColumn("resolutions", F.coalesce("resolutions", F.array().cast("array<struct<status:string>>")))
    return directory.resolution_counts(p, ["F", "O"])


@query("SELECT o_custkey, o_orderpriority AS name, o_orderkey AS record FROM orders QUALIFY row_number() OVER (PARTITION BY o_custkey ORDER BY o_orderstatus, o_orderdate, o_orderkey) = 1")
def group_names(spark, sf_dir):
    out = directory.first_of_group(_t(spark, sf_dir, "orders"), ["o_custkey"], ["o_orderstatus", "o_orderdate", "o_orderkey"], ["o_orderpriority", "o_orderkey"])
    return out.select("o_custkey", F.col("o_orderpriority").alias("name"), F.col("o_orderkey").alias("record"))


@query("SELECT n_name, n_nationkey FROM nation WHERE n_nationkey <> 7 ORDER BY n_name COLLATE es, n_nationkey LIMIT 10")
def composite_order(spark, sf_dir):
    return directory.first_by_position(directory.collated(_t(spark, sf_dir, "nation").where("n_nationkey <> 7"), ["n_name"], "es", ("n_nationkey",)), "n_name", None).select("n_name", "n_nationkey").limit(10)


@query("SELECT o_orderkey, o_orderdate FROM orders ORDER BY o_orderdate, o_orderkey LIMIT 40")
def first_articles(spark, sf_dir):
    o = _t(spark, sf_dir, "orders").select("o_orderkey", "o_orderdate", F.struct("o_orderdate", "o_orderkey").alias("position"))
    return directory.first_by_position(o, "position", 40).select("o_orderkey", "o_orderdate")


@query("SELECT l_orderkey, array_to_string(list_sort(list(DISTINCT l_returnflag)), '|') AS titles, array_to_string(list_sort(list(DISTINCT l_returnflag || '/' || l_linestatus)), '|') AS pairs FROM lineitem GROUP BY 1")
def profile_titles(spark, sf_dir):
    out = registry.collated_titles(_t(spark, sf_dir, "lineitem"), "l_orderkey", "l_returnflag", "l_linestatus")
    return out.select("l_orderkey", _joined("titles").alias("titles"), _joined(F.transform("pairs", lambda p: F.concat_ws("/", p["l_returnflag"], p["l_linestatus"]))).alias("pairs"))


@query("""SELECT l_orderkey, l_linenumber, l_returnflag AS professional_name, CASE WHEN l_linenumber % 3 = 0 THEN '' ELSE l_returnflag END AS specialty, CASE WHEN l_linenumber % 2 = 0 THEN l_linestatus ELSE '' END AS venue, CASE WHEN l_linenumber % 2 = 0 THEN '' ELSE 'monday=' || l_linestatus END AS weekly FROM lineitem""")
def weekday_roster(spark, sf_dir):
    """Rows of tables with one of two sets of headers: names by alias, days that have hours, '' where a table has no column."""
    k = F.col("l_linenumber")
    heads = F.when(k % 2 == 0, F.array(F.lit("Médico"), F.lit("Especialidad"), F.lit("Sede"), F.lit("Lunes"))).otherwise(F.array(F.lit("MEDICO / TECNICO"), F.lit("especialidad"), F.lit("Lun."), F.lit("x")))
    cells = F.when(k % 2 == 0, F.array(F.col("l_returnflag"), F.col("s"), F.col("l_linestatus"), F.lit(""))).otherwise(F.array(F.col("l_returnflag"), F.col("s"), F.col("l_linestatus"), F.lit("")))
    li = _t(spark, sf_dir, "lineitem").select("l_orderkey", "l_linenumber", "l_returnflag", "l_linestatus", F.when(k % 3 == 0, "").otherwise(F.col("l_returnflag")).alias("s"))
    columns = {"professional_name": ["Médico", "Médico/Técnico"], "specialty": ["Especialidad"], "venue": ["Sede"], "phone": []}
    out = provider_pages.roster(li.select("*", heads.alias("headers"), cells.alias("cells")), F.col("headers"), F.col("cells"), columns)
    return out.select("l_orderkey", "l_linenumber", "professional_name", "specialty", "venue", _joined(F.transform("weekly", lambda d: F.concat_ws("=", d["day"], d["value"]))).alias("weekly"))


# --- feeds and observations ------------------------------------------------------------------------------------


@query("""WITH e AS (SELECT *, 'u' || user_id % 40 AS source, TIMESTAMP '2024-01-25' AS as_of FROM events), k AS (SELECT *, CASE WHEN ts > as_of THEN 'future' WHEN ts < as_of - INTERVAL 15 DAY THEN 'stale' ELSE 'valid' END AS k, event_type = 'error' AS minor, event_type IN ('error', 'click') AS other, event_id % 5 = 0 AS seen, event_id % 3 AS n FROM e),
c AS (SELECT source, count(*) AS discovered, count(*) FILTER (k = 'future') AS invalid, count(*) FILTER (k = 'stale') AS old, count(*) FILTER (k = 'valid' AND (other OR seen)) AS restricted, count(*) FILTER (k = 'valid' AND NOT other AND NOT seen AND n > 0) AS m, count(*) FILTER (k = 'valid' AND NOT other AND NOT seen AND n = 0) AS w,
 count(*) FILTER (k = 'valid' AND minor) AS rm, count(*) FILTER (k = 'valid' AND other) AS ro, max(ts) FILTER (k <> 'future') < TIMESTAMP '2024-01-25' - INTERVAL 6 HOUR AS stale FROM k GROUP BY source)
SELECT source, discovered::BIGINT AS discovered, invalid::BIGINT AS invalid, CASE WHEN stale THEN discovered - invalid ELSE old END::BIGINT AS skipped_stale, CASE WHEN stale THEN 0 ELSE restricted END::BIGINT AS restricted, CASE WHEN stale THEN 0 ELSE m END::BIGINT AS with_mentions, CASE WHEN stale THEN 0 ELSE w END::BIGINT AS without_mentions,
 CASE WHEN stale THEN 0 ELSE rm END::BIGINT AS minors, CASE WHEN stale THEN 0 ELSE ro END::BIGINT AS adverse, CASE WHEN stale THEN 'STALE' ELSE 'FETCHED' END AS status FROM c""")
def source_counters(spark, sf_dir):
    kind = F.col("event_type")
    reasons = F.when(kind == "error", F.array(F.lit("ADVERSE_OR_JUDICIAL"), F.lit("MINOR"))).when(kind == "click", F.array(F.lit("ADVERSE_OR_JUDICIAL"))).otherwise(F.array().cast("array<string>"))
    items = _t(spark, sf_dir, "events").select(F.concat(F.lit("u"), (F.col("user_id") % 40).cast("string")).alias("source"), F.col("ts").alias("published"), reasons.alias("reasons"), (F.col("event_id") % 5 == 0).alias("seen"), (F.col("event_id") % 3).alias("n_names"))
    out = news.source_counters(items, "source", F.to_timestamp_ntz(F.lit("2024-01-25 00:00:00")), 6, 15)
    return out.select("source", "discovered", "invalid", "skipped_stale", "restricted", "with_mentions", "without_mentions", F.col("restricted_minor").alias("minors"), F.col("restricted_adverse_or_judicial").alias("adverse"), "status")


@query("""WITH r AS (SELECT o_custkey % 50 AS article, o_orderkey, o_orderpriority AS head, CASE o_orderkey % 3 WHEN 0 THEN upper(c_mktsegment) WHEN 1 THEN lower(c_mktsegment) END AS name FROM orders JOIN customer ON o_custkey = c_custkey),
s AS (SELECT article, upper(name) AS k, min(o_orderkey) AS p, max_by(name, o_orderkey) AS name FROM r WHERE name IS NOT NULL GROUP BY 1, 2),
n AS (SELECT article, string_agg(name, '|' ORDER BY p, k) AS names FROM s GROUP BY 1), h AS (SELECT article, min_by(head, o_orderkey) AS head FROM r GROUP BY 1) SELECT article, head, coalesce(names, '') AS names FROM h LEFT JOIN n USING (article)""")
def merge_articles(spark, sf_dir):
    o = _t(spark, sf_dir, "orders").join(_t(spark, sf_dir, "customer").withColumnRenamed("c_custkey", "o_custkey"), "o_custkey")
    name = F.when(F.col("o_orderkey") % 3 == 0, F.upper("c_mktsegment")).when(F.col("o_orderkey") % 3 == 1, F.lower("c_mktsegment"))
    rows = o.select((F.col("o_custkey") % 50).alias("article"), "o_orderkey", F.col("o_orderpriority").alias("head"), name.alias("name"))
    out = dedupe.merge_articles(rows, "article", ["o_orderkey"], ["head"], "name", text.person_name(F.col("name")))
    return out.select("article", "head", _joined("names").alias("names"))


@query("""SELECT c_custkey, trim(CASE WHEN c_custkey % 4 = 0 THEN c_name ELSE c_mktsegment END) AS name, CASE WHEN c_custkey % 3 = 0 THEN 'inst' ELSE 'folder' END AS institution, CASE WHEN c_custkey % 5 = 0 THEN 'r' || c_custkey ELSE 'data/folder/file.ndjson:' || c_custkey END AS record_id, CASE WHEN c_custkey % 2 = 0 THEN 'one' ELSE 'two|three' END AS specialties FROM customer""")
def observation_fields(spark, sf_dir):
    k = F.col("c_custkey")
    rows = _t(spark, sf_dir, "customer").select(
        "c_custkey", F.when(k % 4 == 0, F.col("c_name")).otherwise(" ").alias("physicianName"), F.col("c_mktsegment").alias("name"), F.when(k % 3 == 0, "inst").alias("provider"), F.when(k % 5 == 0, F.concat(F.lit("r"), k.cast("string"))).alias("recordId"), F.when(k % 2 == 0, "one").alias("speciality"),
        F.array(F.lit("two "), F.lit(""), F.lit("three")).alias("specialties"), F.lit("data/folder/file.ndjson").alias("file"),
    )
    out = linkage.observation(rows, "file", "c_custkey")
    return out.select("c_custkey", F.col("_name").alias("name"), F.col("_institution").alias("institution"), F.col("_record_id").alias("record_id"), _joined("_specialties").alias("specialties"))


@query("""SELECT o_orderkey, CASE o_orderkey % 8 WHEN 0 THEN 'https://a.org/x/' || o_orderkey WHEN 1 THEN 'https://a.org/' || o_orderkey WHEN 2 THEN 'https://a.org/p/q/' || o_orderkey || '?y' WHEN 3 THEN 'https://a.org/p/' || o_orderkey WHEN 4 THEN 'https://b.org/' || o_orderkey WHEN 5 THEN 'https://a.org/p/q/r?z=' || o_orderkey WHEN 6 THEN '' ELSE 'https://a.org/p/q/r' END AS url FROM orders""")
def resolved_urls(spark, sf_dir):
    k = F.col("o_orderkey").cast("string")
    forms = (F.concat(F.lit("http://a.org:80/../x/"), k), F.concat(F.lit("/"), k), F.concat(F.lit("./"), k, F.lit("?y#z")), F.concat(F.lit("../"), k), F.concat(F.lit("//b.org/"), k), F.concat(F.lit("?z="), k), F.concat(F.lit("https://c.org/"), k))
    href = F.coalesce(*[F.when(F.col("o_orderkey") % 8 == i, f) for i, f in enumerate(forms)], F.lit("#top"))
    href = F.regexp_replace(href, ":80/", "/")
    return _t(spark, sf_dir, "orders").select("o_orderkey", F.coalesce(ids.article_url(href, F.lit("https://a.org/p/q/r"), ["a.org", "B.org"]), F.lit("")).alias("url"))


@query("SELECT word, row_number() OVER (ORDER BY word)::INTEGER AS pos FROM (SELECT DISTINCT n_name AS word FROM nation)")
def code_unit_order(spark, sf_dir):
    """Places by UTF-16 code units; a window over the few names of nations."""
    w = _t(spark, sf_dir, "nation").select(F.col("n_name").alias("word")).distinct()
    return w.select("word", F.row_number().over(Window.orderBy(text.code_unit_key(F.col("word")))).alias("pos"))


@query(_CAND + """SELECT event_id, sha256(CASE ambiguity WHEN 'HOMONYM' THEN '""" + news.HOMONYM + """' WHEN 'MULTIPLE_POSSIBLE_PROFESSIONALS' THEN '""" + news.SEVERAL + """' ELSE CASE kind[1] WHEN 'E' THEN '""" + news.EXACT + """' WHEN 'P' THEN '""" + news.PARTIAL + """' ELSE '""" + news.INITIALS + """' END END || ' ' ||
CASE WHEN n_context > 0 THEN 'Hay coincidencia contextual de profesión' || CASE WHEN event_id % 2 = 0 THEN ' e institución' ELSE '' END || ', pero es sólo una señal de apoyo y tampoco acredita identidad.' ELSE '""" + news.NOT_CORROBORATED + """' END || ' ' || CASE WHEN event_id % 4 = 0 THEN '""" + news.MEDICAL + """' ELSE '""" + news.NOT_MEDICAL + """' END) AS told FROM c""")
def alert_explanations(spark, sf_dir):
    c, _ = _candidates(spark, sf_dir)
    k, amb, found = F.col("event_id"), F.col("ambiguity"), F.col("n_context") > 0
    told = news.explanation(F.col("kind"), amb == "HOMONYM", amb == "MULTIPLE_POSSIBLE_PROFESSIONALS", k % 4 == 0, found, found & (k % 2 == 0))
    return c.select("event_id", F.sha2(told, 256).alias("told"))

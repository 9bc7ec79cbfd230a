"""Contracts of rows and documents as columns: each row gets the array of what it violates, in a fixed order, and an empty
array is a pass. So whole tables are checked in one pass, and what is wrong can be counted, kept or turned into an error.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.text import let, person_name, squeeze

# Keys that no professional row may have, registry values, extraction methods, shapes of ids, stand-ins.
FORBIDDEN_KEYS = ("documentNumber", "documento", "cedula", "cédula", "email", "phone")
TEMPORARY = {"Registro Temporario con Contrato": "WITH_CONTRACT", "Registro Temporario sin Contrato": "WITHOUT_CONTRACT"}
METHODS = ("SOURCE_STRUCTURED_DATA", "DETERMINISTIC_PARSER", "HUMAN_CURATED")
PROFESSIONAL_ID = "^msp_doc_v1_[0-9a-f]{64}$"
ARTICLE_ID = r"^[A-Za-z0-9][A-Za-z0-9._:-]{0,199}$"
STAND_IN = r"(?iu)(?:\[[^\]]+\]|<[^>]+>|\{\{?[^{}]+\}?\}|\b(?:todo|tbd|changeme|placeholder|dummy|fake|ejemplo|example|sint[eé]tic[oa]|por definir|pendiente)\b|\.invalid\b)"
WINDOW_DAYS = 30


def codes(*tests: tuple[Column, str]) -> Column:
    """The codes of the tests that hold; a test that is null doesn't."""
    return F.filter(F.array(*[F.when(F.coalesce(t, F.lit(False)), F.lit(c)) for t, c in tests]), lambda x: x.isNotNull())


def first_code(*tests: tuple[Column, str]) -> Column:
    """The code of the first test that holds, else null."""
    return F.coalesce(*[F.when(F.coalesce(t, F.lit(False)), F.lit(c)) for t, c in tests])


def require_clean(df: DataFrame, violations: str = "violations") -> DataFrame:
    """The rows; one with a violation fails the job with its codes."""
    bad = F.raise_error(F.concat(F.lit("violations: "), F.array_join(violations, ", "))).cast("boolean")
    return df.where(F.when(F.size(violations) > 0, bad).otherwise(F.lit(True)))


# --- shapes and fields -------------------------------------------------------------------------------------------


def exact_keys(document: Column, keys: list[str]) -> Column:
    """Whether a JSON object has these keys and no others."""
    return F.coalesce(F.array_sort(F.json_object_keys(document)) == F.array(*[F.lit(k) for k in sorted(set(keys))]), F.lit(False))


def only_keys(document: Column, keys: list[str]) -> Column:
    """Whether a JSON object has no other keys."""
    return F.coalesce(F.size(F.array_except(F.json_object_keys(document), F.array(*[F.lit(k) for k in keys]))) == 0, F.lit(False))


def has_key(document: Column, key: str) -> Column:
    return F.coalesce(F.array_contains(F.json_object_keys(document), key), F.lit(False))


def is_text(c: Column) -> Column:
    return F.coalesce(squeeze(c) != "", F.lit(False))


def is_count(c: Column) -> Column:
    """A non-negative whole number, as text."""
    return F.coalesce(c.rlike(r"^(0|[1-9]\d{0,15})$"), F.lit(False))


def is_date(c: Column) -> Column:
    return F.coalesce(c.rlike(r"^\d{4}-\d{2}-\d{2}$") & F.try_to_timestamp(c, F.lit("yyyy-MM-dd")).isNotNull(), F.lit(False))


def is_instant(c: Column) -> Column:
    """A canonical UTC instant with milliseconds."""
    return F.coalesce(c.rlike(r"^\d{4}-\d{2}-\d{2}T\d{2}:\d{2}:\d{2}\.\d{3}Z$") & F.try_to_timestamp(c, F.lit("yyyy-MM-dd'T'HH:mm:ss.SSSX")).isNotNull(), F.lit(False))


def is_sha256(c: Column) -> Column:
    return F.coalesce(c.rlike("^[0-9a-f]{64}$"), F.lit(False))


def is_https(c: Column) -> Column:
    """An absolute https address without user or password."""
    return F.coalesce(c.rlike(r"^https://[^\s/?#@]+([/?#]\S*)?$"), F.lit(False))


def is_email(c: Column) -> Column:
    return F.coalesce(c.rlike(r"^[^\s@]+@[^\s@]+\.[^\s@]+$"), F.lit(False))


def is_real_text(c: Column) -> Column:
    """Text that is no stand-in."""
    return is_text(c) & ~c.rlike(STAND_IN)


# --- registry rows -------------------------------------------------------------------------------------------------


def registry_rows(rows: DataFrame, required: list[str], untouched: tuple[str, ...] = ()) -> DataFrame:
    """Text columns trimmed (but for ``untouched``), with the required ones that are blank as violations."""
    out = rows.select(*[F.col(c) if c in untouched else squeeze_ends(F.col(c)).alias(c) for c in rows.columns])
    return out.withColumn("violations", codes(*[(~is_text(F.col(c)), f"EMPTY_{c.upper()}") for c in required]))


def squeeze_ends(c: Column) -> Column:
    """Without white space at the ends, no-break spaces and marks of byte order included."""
    return F.regexp_replace(c, r"(?U)^[\s﻿]+|[\s﻿]+$", "")


def temporary_registration(c: Column) -> Column:
    """NONE for null; an unknown value fails the job."""
    known = [F.when(c == k, F.lit(v)) for k, v in TEMPORARY.items()]
    return F.coalesce(F.when(c.isNull(), "NONE"), *known, F.raise_error(F.concat(F.lit("unknown temporary registration: "), c)).cast("string"))


def safe_name(c: Column) -> Column:
    """At least two words once normalised."""
    return F.coalesce(F.size(F.filter(F.split(person_name(c), " "), lambda w: w != "")) >= 2, F.lit(False))


_DIRECTORY = "internalLinkageId string, displayName string, enabledTitles array<string>, officialRegistry struct<publisher: string, dataset: string, sourceCutoffDate: string>, publication struct<publicExportAllowed: boolean>"
_REGISTRY = "linkageId string, fullName string, enabledTitles array<struct<title: string>>, provenance struct<publisher: string, dataset: string, sourceCutoffDate: string>"


def professionals(lines: DataFrame, value: str) -> DataFrame:
    """Professional documents of either format as rows of one shape, with what each violates. ``value`` is a JSON object a row."""
    directory = has_key(F.col(value), "internalLinkageId") | has_key(F.col(value), "displayName")
    d, r = F.from_json(value, _DIRECTORY), F.from_json(value, _REGISTRY)
    shape = lines.withColumns({"_dir": directory, "_d": d, "_r": r})
    titles = lambda c: F.array_sort(F.array_distinct(F.transform(c, lambda t: F.trim(t))))
    pick = lambda a, b: F.when(F.col("_dir"), a).otherwise(b)
    out = shape.withColumns({
        "format": pick(F.lit("DIRECTORY_FACTUAL_V3"), F.lit("MSP_INFOTITULOS_NORMALIZED")), "professional_id": pick(F.col("_d.internalLinkageId"), F.col("_r.linkageId")), "display_name": pick(F.col("_d.displayName"), F.col("_r.fullName")),
        "professions": pick(titles(F.col("_d.enabledTitles")), titles(F.col("_r.enabledTitles.title"))), "cutoff": pick(F.col("_d.officialRegistry.sourceCutoffDate"), F.col("_r.provenance.sourceCutoffDate")),
    })
    raw = F.size(F.array_intersect(F.json_object_keys(value), F.array(*[F.lit(k) for k in FORBIDDEN_KEYS]))) > 0
    bad_titles = F.coalesce(F.size("professions") < 1, F.lit(True)) | F.exists("professions", lambda t: ~is_text(t))
    tests = [
        (F.json_object_keys(value).isNull(), "NOT_AN_OBJECT"), (~F.col("_dir") & raw, "FORBIDDEN_FIELD"), (~F.coalesce(F.col("professional_id").rlike(PROFESSIONAL_ID), F.lit(False)), "INVALID_ID"), (~safe_name(F.col("display_name")), "UNSAFE_NAME"),
        (bad_titles, "NO_TITLES"), (~is_date(F.col("cutoff")), "INVALID_CUTOFF"), (F.col("_dir") & ~F.coalesce(F.col("_d.publication.publicExportAllowed") == F.lit(False), F.lit(False)), "NOT_FAIL_CLOSED"),
    ]
    return out.withColumn("violations", codes(*tests)).drop("_dir", "_d", "_r")


# --- sources and their rights ------------------------------------------------------------------------------------


def source_rights(sources: DataFrame, as_of: str) -> DataFrame:
    """Adds ``outcome``: ENABLED, OMITTED, or the first reason why the catalog is wrong, and the digest of the authorization.

    Columns: id, basis, reviewed_on, expires_on, terms_url, gated (whether it names its three settings), switch, reference,
    approved (array of digests), the last three as the settings say. A review holds through its last day."""
    written, day = F.col("basis") == "WRITTEN_AUTHORIZATION_REQUIRED", F.lit(as_of[:10])
    switch, reference = F.lower(F.trim(F.coalesce("switch", F.lit("")))), F.trim(F.coalesce("reference", F.lit("")))
    digest = F.sha2(reference, 256)
    approved = F.filter(F.transform(F.coalesce("approved", F.array().cast("array<string>")), lambda x: F.lower(F.trim(x))), lambda x: x != "")
    trusted = (F.size(approved) > 0) & F.forall(approved, is_sha256) & F.array_contains(approved, digest)
    outcome = first_code(
        (~is_date(F.col("reviewed_on")) | ~is_date(F.col("expires_on")), "INVALID_REVIEW_DATES"), (~is_https(F.col("terms_url")), "INVALID_TERMS_URL"), (written & ~F.col("gated"), "GATE_MISSING"), (~written & F.col("gated"), "GATE_INCONSISTENT"),
        (written & switch.isin("", "false"), "OMITTED"), (written & (switch != "true"), "SWITCH_NOT_BOOLEAN"), (written & (F.char_length(reference) < 8), "REFERENCE_MISSING"), (written & ~trusted, "AUTHORIZATION_NOT_APPROVED"),
        (F.col("reviewed_on") > day, "REVIEW_IN_FUTURE"), (F.col("expires_on") < day, "REVIEW_EXPIRED"), (F.lit(True), "ENABLED"),
    )
    return sources.withColumn("outcome", outcome).withColumn("authorization_sha256", F.when(written & (F.col("outcome") == "ENABLED"), digest))


def rights_gate(outcomes: DataFrame) -> tuple[list[str], list[str]]:
    """(enabled ids, omitted ids, sorted) of a source catalog; ValueError for any other outcome, or if none is enabled."""
    found = {r.outcome: sorted(r.ids) for r in outcomes.groupBy("outcome").agg(F.collect_list("id").alias("ids")).collect()}  # a catalog is small
    wrong = {k: v for k, v in found.items() if k not in ("ENABLED", "OMITTED")}
    if wrong or not found.get("ENABLED"):
        raise ValueError(f"sources: {wrong or 'none enabled'}")
    return found["ENABLED"], found.get("OMITTED", [])


def source_freshness(profiles: DataFrame, cutoff: str, expected: str, max_age_days: int, as_of: str) -> DataFrame:
    """One row: the distinct cutoff dates, and what is wrong with them. All must be ``expected``, at most so many days old."""
    age = F.datediff(F.lit(as_of).cast("date"), F.lit(expected).cast("date"))
    out = profiles.agg(F.count_distinct(cutoff).alias("cutoffs"), F.min(cutoff).cast("string").alias("cutoff"))
    wrong = (F.col("cutoffs") != 1) | (F.col("cutoff") != expected)
    return out.withColumn("violations", codes((wrong, "CUTOFF_MISMATCH"), (age < 0, "CUTOFF_IN_FUTURE"), (age > max_age_days, "SOURCE_TOO_OLD")))


# --- articles and candidates ---------------------------------------------------------------------------------------


def article_violations(restricted: Column) -> Column:
    """What an article violates by itself. Columns: schema_version, article_id, headline, names, publisher, url, published_at,
    retrieved_at, extracted_at (canonical instants as text), content_sha256, method, extractor_version."""
    c = F.col
    short = lambda keys: F.exists(keys, lambda k: F.size(F.filter(F.split(k, " "), lambda w: w != "")) < 2) | (F.size(F.array_distinct(keys)) != F.size(keys))
    return codes(
        (~F.coalesce(c("schema_version") == 1, F.lit(False)), "SCHEMA_VERSION"), (~F.coalesce(c("article_id").rlike(ARTICLE_ID), F.lit(False)), "ARTICLE_ID"), (~is_text(c("headline")) | (F.char_length("headline") > 1000), "HEADLINE"),
        (F.coalesce(F.size("names") < 1, F.lit(True)) | F.exists("names", lambda n: ~is_text(n)), "NAMES"), (let(F.transform("names", person_name), short), "NAMES_NOT_UNIQUE_OR_SHORT"), (restricted, "HEADLINE_RESTRICTED"),
        (~is_instant(c("published_at")) | ~is_instant(c("retrieved_at")) | ~is_instant(c("extracted_at")), "INSTANT"), (c("retrieved_at") < c("published_at"), "RETRIEVED_BEFORE_PUBLISHED"), (c("extracted_at") < c("retrieved_at"), "EXTRACTED_BEFORE_RETRIEVED"),
        (~F.coalesce(c("method").isin(*METHODS), F.lit(False)), "METHOD"), (~is_https(c("url")), "URL"), (~is_sha256(c("content_sha256")), "CONTENT_SHA256"), (~is_text(c("publisher")) | ~is_text(c("extractor_version")), "EMPTY_FIELD"),
    )


def content_sha256(headline: Column, url: Column, published_at: Column) -> Column:
    return F.sha2(F.concat_ws("\x00", headline, url, published_at), 256)


def article_id(publisher_key: Column, url: Column) -> Column:
    return F.concat(publisher_key, F.lit(":"), F.substring(F.sha2(url, 256), 1, 40))


def conforming(articles: DataFrame, sources: DataFrame, generated_at: str, collector: str) -> DataFrame:
    """Articles with what doesn't agree with their source's report. sources: source_id, s_status, s_publisher, s_publisher_key,
    s_hosts, s_retrieved_at; an article without a source violates too, so the join keeps every article."""
    joined = articles.join(sources, "source_id", "left")
    c, at = F.col, lambda x: F.try_to_timestamp(F.col(x), F.lit("yyyy-MM-dd'T'HH:mm:ss.SSSX"))
    host = F.lower(F.parse_url("url", F.lit("HOST")))
    fetched = (c("s_status") == "FETCHED") & c("s_retrieved_at").isNotNull()
    outside = (at("published_at") < at("retrieved_at") - F.make_dt_interval(F.lit(WINDOW_DAYS))) | (at("published_at") > at("retrieved_at"))
    made = (c("method") == "DETERMINISTIC_PARSER") & (c("extractor_version") == collector) & (c("extracted_at") == c("retrieved_at"))
    no = lambda x: ~F.coalesce(x, F.lit(False))
    return joined.withColumn("violations", codes(
        (no(fetched), "SOURCE_NOT_FETCHED"), (no(c("publisher") == c("s_publisher")), "PUBLISHER"), (no(F.array_contains("s_hosts", host)), "HOST"), (no(c("retrieved_at") == c("s_retrieved_at")), "RETRIEVAL"),
        (c("retrieved_at") > generated_at, "LATER_THAN_MANIFEST"), (outside, "OUTSIDE_WINDOW"), (no(made), "COLLECTOR"), (no(c("content_sha256") == content_sha256(c("headline"), c("url"), c("published_at"))), "CONTENT_SHA256"),
        (no(c("article_id") == article_id(c("s_publisher_key"), c("url"))), "ARTICLE_ID"),
    ))


def candidate_violations(candidates: DataFrame) -> DataFrame:
    """Candidates with the safeguards that they break. Columns: candidate_id, schema_version, state, quarantine, decision,
    identity_confirmed, publication, export_allowed, automatic (array of the safeguard flags that must be false),
    name_only, requires_review, n_context, kind, alert_codes, alert_message, raw (array of source values)."""
    c = F.col
    times = candidates.groupBy("candidate_id").agg(F.count(F.lit(1)).alias("_times"))
    no = lambda x: ~F.coalesce(x, F.lit(False))
    kept = (c("schema_version") == 2) & (c("state") == "NEEDS_HUMAN_REVIEW") & c("quarantine") & c("requires_review") & ~F.exists("automatic", lambda x: x)
    mandatory = F.array_contains("alert_codes", "POSSIBLE_IDENTITY_MATCH_NOT_CONFIRMED") & F.array_contains("alert_codes", "HUMAN_REVIEW_REQUIRED") & is_text(c("alert_message"))
    flexible = (c("kind") != "EXACT_NORMALIZED_NAME") & ~F.array_contains("alert_codes", "FLEXIBLE_MATCH_HIGH_FALSE_POSITIVE_RISK")
    tests = [
        (c("_times") > 1, "DUPLICATE_ID"), (no(kept), "QUARANTINE"), (no((c("decision") == "NOT_LINKED") & ~c("identity_confirmed")), "LINKED"), (no((c("publication") == "NOT_PUBLISHED") & ~c("export_allowed")), "PUBLISHED"),
        (no(c("name_only") == (c("n_context") == 0)), "NAME_ONLY"), (no(mandatory) | flexible, "ALERTS"), (F.exists("raw", lambda v: F.contains(c("candidate_id"), v)), "RAW_VALUE_IN_ID"),
    ]
    return candidates.join(times, "candidate_id").withColumn("violations", codes(*tests)).drop("_times")


# --- manifests and artifacts ---------------------------------------------------------------------------------------


def bundle_mode(manifest: Column) -> Column:
    """How a provider's manifest (JSON) may be used: complete_manifest_v1, a legacy mode, or null. A manifest that has any of
    the newer fields is judged by them alone."""
    at = lambda path: F.get_json_object(manifest, f"$.{path}")
    n = lambda path: F.when(is_count(at(path)), at(path).cast("long"))
    modern = has_key(manifest, "status") | has_key(manifest, "scope") | has_key(manifest, "counts")
    parsed, skipped = n("counts.sourceRowsParsed"), n("counts.duplicateRowsSkipped")
    whole = (at("status") == "complete") & (at("scope") == "full_filter_enumeration") & (n("counts.doctorRequestsFailed") == 0) & (n("counts.doctorResponsesAtPossibleSourceLimit") == 0) & n("counts.recordsWritten").isNotNull()
    whole = whole & (parsed.isNull() | skipped.isNull() | (parsed == n("counts.recordsWritten") + skipped))
    old = at("schemaVersion") == "1.0.0"
    e = lambda name: n(f"extraction.{name}")
    casmu = old & (at("provider") == "CASMU") & e("scheduleRecords").isNotNull() & (e("directorySourceRows") == e("directoryUniqueRecords") + e("directoryDuplicateRowsDiscarded") + e("directoryInvalidRows"))
    britanico = old & (at("provider") == "Hospital Británico") & (e("invalidPhysicianRows") == 0) & (e("invalidScheduleEntries") == 0) & (e("candidateScheduleEntries") == e("scheduleRecords") + e("duplicateEntriesDiscarded"))
    yes = lambda x: F.coalesce(x, F.lit(False))
    return F.when(modern, F.when(yes(whole), "complete_manifest_v1")).when(yes(casmu), "legacy_casmu_v1").when(yes(britanico), "legacy_hospital_britanico_v1")


def single_input(inputs: Column, matches) -> Column:
    """The one entry of a manifest's inputs that matches; null for none or several."""
    found = F.filter(inputs, matches)
    return F.when(F.size(found) == 1, F.element_at(found, 1))


def differing(left: Column, right: Column, fields: tuple[str, ...] = ("path", "sha256", "records")) -> Column:
    """The fields in which an artifact differs from what the manifest before it says."""
    return codes(*[(~left[f].eqNullSafe(right[f]), f"{f.upper()}_DIFFERS") for f in fields])


def missing_inputs(wanted: DataFrame, given: DataFrame, key: str) -> DataFrame:
    """Artifacts of a bundle that the explicit inputs lack."""
    return wanted.join(given.select(key), key, "left_anti")


def rollup(per_source: DataFrame, counters: list[str], status: str = "status") -> DataFrame:
    """Totals of the sources' counters, and how many sources have each status, as one row."""
    state = lambda s: F.count_if(F.col(status) == s).alias(f"sources_{s.lower()}")
    return per_source.agg(F.count(F.lit(1)).alias("sources"), *map(state, ("FETCHED", "FAILED", "STALE")), *[F.coalesce(F.sum(c), F.lit(0)).cast("long").alias(c) for c in counters])

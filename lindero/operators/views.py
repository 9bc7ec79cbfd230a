"""The public views of the catalog and the rules that its tables keep, over DataFrames.

Tables: ``source``, ``release``, ``evidence``, ``claim``, ``professional``, ``route``, ``title``, with the columns named in
each function. A view joins by equality only; Catalyst broadcasts what is small."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .contracts import is_text

# What a public title's evidence must be, and what a slug looks like.
FIRM = ("DETERMINISTIC", "HUMAN_VERIFIED")
OFFICIAL = ("GOVERNMENT_OPEN_DATA", "OFFICIAL_PUBLICATION")
SLUG = "^[a-z0-9]+(?:-[a-z0-9]+)*$"
UUID = "^[0-9a-f]{8}-[0-9a-f]{4}-[0-9a-f]{4}-[0-9a-f]{4}-[0-9a-f]{12}$"


def public_evidence(evidence: DataFrame, release: DataFrame, source: DataFrame, as_of: Column) -> DataFrame:
    """Evidence that may be shown. evidence: evidence_id, evidence_public_id, release_id, evidence_state, confidence,
    observed_at, evidence_until; release: release_id, source_id, cutoff, retrieved_at; source: source_id, source_kind,
    source_state, purpose, reuse, reviewed_at, source_until. All eleven conditions; an end is over at its own instant."""
    rows = evidence.join(release, "release_id").join(source, "source_id")
    c = F.col
    return rows.where(
        (c("evidence_state") == "APPROVED") & (c("confidence") != "CANDIDATE") & (c("observed_at") <= as_of) & (c("evidence_until").isNull() | (c("evidence_until") > as_of)) & (c("source_state") == "APPROVED") & (c("purpose") == "COMPATIBLE")
        & (c("reuse") != "PENDING") & (c("reviewed_at") <= as_of) & (c("source_until") > as_of) & (c("cutoff") <= F.to_date(as_of)) & (c("retrieved_at") <= as_of)
    )


def public_professional(professional: DataFrame, shown: DataFrame, claim: DataFrame) -> DataFrame:
    """Visible professionals whose present name a shown piece of evidence claims. professional: professional_id, public_id,
    display_name, normalized_name, visibility, evidence_id; claim: evidence_id, subject_id, claim_kind, claim_value."""
    named = claim.where("claim_kind = 'PROFESSIONAL_NAME'").select("evidence_id", F.col("subject_id").alias("professional_id"), F.col("claim_value").alias("normalized_name"))
    rows = professional.where("visibility = 'PUBLIC'").join(shown.select("evidence_id", "evidence_public_id"), "evidence_id")
    return rows.join(named, ["evidence_id", "professional_id", "normalized_name"]).select("professional_id", "public_id", "display_name", "normalized_name", "evidence_public_id")


def public_route(route: DataFrame, people: DataFrame) -> DataFrame:
    """Routes (slug, professional_id, route_kind) of public professionals, by their public ids."""
    return route.join(people.select("professional_id", "public_id"), "professional_id").select("slug", "public_id", "route_kind")


def public_title(title: DataFrame, people: DataFrame, shown: DataFrame, claim: DataFrame) -> DataFrame:
    """Enabled titles of public professionals, on firm evidence of official sources that claims the title. title: title_id,
    title_public_id, professional_id, title, normalized_title, registration_state, evidence_id."""
    firm = shown.where(F.col("confidence").isin(*FIRM) & F.col("source_kind").isin(*OFFICIAL)).select("evidence_id", "evidence_public_id")
    said = claim.where("claim_kind = 'REGISTERED_TITLE'").select("evidence_id", F.col("subject_id").alias("professional_id"), F.col("claim_value").alias("normalized_title"))
    rows = title.where("registration_state = 'ENABLED'").join(people.select("professional_id", "public_id"), "professional_id").join(firm, "evidence_id")
    return rows.join(said, ["evidence_id", "professional_id", "normalized_title"]).select("title_public_id", "public_id", "title", "normalized_title", "evidence_public_id")


def searchable(people: DataFrame, routes: DataFrame) -> DataFrame:
    """Public professionals with their CURRENT route: what a search reads."""
    current = routes.where("route_kind = 'CURRENT'").select("public_id", "slug")
    return people.join(current, "public_id")


def with_evidence(people: DataFrame, shown: DataFrame) -> DataFrame:
    """Professionals with the evidence of their name; one without it isn't found."""
    return people.join(shown.drop("evidence_id"), "evidence_public_id")


def grants(readable: list[str], granted: list[tuple[str, str]]) -> list[tuple[str, str]]:
    """Privileges (object, privilege) beyond reading the public views: must be none."""
    return sorted((o, p) for o, p in granted if p != "SELECT" or o not in readable)


# --- rules that must have no violation ---------------------------------------------------------------------------


def unreviewed_sources(source: DataFrame) -> DataFrame:
    """Approved sources without a whole review: the rule's columns are purpose, reuse, policy_id, reviewed_by, reviewed_at,
    review_reference, source_until, license_url, source_kind, source_state."""
    c = F.col
    whole = (c("purpose") == "COMPATIBLE") & (c("reuse") != "PENDING") & is_text(c("policy_id")) & is_text(c("reviewed_by")) & is_text(c("review_reference")) & (c("source_until") > c("reviewed_at"))
    whole = whole & ((c("reuse") != "OPEN_DATA_LICENSE") | is_text(c("license_url"))) & ((c("reuse") == "DATA_SUBJECT_CONSENT") == (c("source_kind") == "DATA_SUBJECT_CLAIM"))
    return source.where((c("source_state") == "APPROVED") & ~F.coalesce(whole, F.lit(False)))


def approved_candidates(evidence: DataFrame) -> DataFrame:
    return evidence.where("evidence_state = 'APPROVED' AND confidence = 'CANDIDATE'")


def shared_public_ids(df: DataFrame, key: str, public_id: str) -> DataFrame:
    """Rows whose public id is their own key, or is another row's as well."""
    times = df.groupBy(public_id).count().where("count > 1").select(public_id).withColumn("_twice", F.lit(True))
    return df.join(times, public_id, "left").where((F.col(public_id).cast("string") == F.col(key).cast("string")) | F.col("_twice")).drop("_twice")


def bad_slugs(route: DataFrame, slug: str = "slug") -> DataFrame:
    return route.where(~F.col(slug).rlike(SLUG) | F.col(slug).rlike(UUID))


def several_current(route: DataFrame, key: str = "professional_id") -> DataFrame:
    """Professionals with more than one CURRENT route."""
    return route.where("route_kind = 'CURRENT'").groupBy(key).count().where("count > 1").drop("count")


def repeated(df: DataFrame, key: list[str]) -> DataFrame:
    return df.groupBy(*key).count().where("count > 1").drop("count")


def dangling(df: DataFrame, key: str, parent: DataFrame, parent_key: str) -> DataFrame:
    """Rows whose reference no parent row has; a null reference refers to nothing."""
    return df.where(F.col(key).isNotNull()).join(parent.select(F.col(parent_key).alias(key)), key, "left_anti")


def changed_public_ids(before: DataFrame, after: DataFrame, key: str, public_id: str) -> DataFrame:
    """Keys whose public id differs between two snapshots."""
    old = before.select(key, F.col(public_id).alias("_old"))
    return after.join(old, key).where(F.col(public_id) != F.col("_old")).select(key, public_id)

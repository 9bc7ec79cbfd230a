"""Record linkage by full-name word multisets. Candidates are hypotheses: nothing is merged or published."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

# Statuses, and the reason why each abstains.
STATUSES = ("unmatched", "ambiguous_exact_name", "exact_name_and_title_consistent", "exact_name_only")
REASONS = ("NO_MSP_CANDIDATE", "MULTIPLE_MSP_CANDIDATES", "HUMAN_REVIEW_REQUIRED", "TITLE_NOT_CORROBORATED")


def first_of(*columns: str) -> Column:
    """The first non-blank of several keys of a heterogeneous row."""
    return F.coalesce(*[F.nullif(F.trim(F.col(c)), F.lit("")) for c in columns])


def observation(rows: DataFrame, file: str, row: str) -> DataFrame:
    """Rows of any provider as one shape: name, institution, record_id, specialties. Each is the first non-blank of several
    columns, those that a provider lacks left out; the parent folder names an institution, file and row a record."""
    def first(*names: str, last: Column | None = None) -> Column:
        found = [F.nullif(F.trim(F.col(n).cast("string")), F.lit("")) for n in names if n.split(".")[0] in rows.columns]
        return F.coalesce(*found, *([] if last is None else [last]), F.lit(None).cast("string"))

    parent = F.element_at(F.split(F.col(file), "/"), -2)
    one = first("specialty", "speciality", "sourceSpecialty")
    several = F.filter(F.transform("specialties", lambda x: F.trim(x)), lambda x: x != "") if "specialties" in rows.columns else F.array().cast("array<string>")
    whose = ["source.institution"] if dict(rows.dtypes).get("source", "").startswith("struct") else []
    here = ["source.id"] if whose and "id:" in dict(rows.dtypes)["source"] else []
    return rows.select(
        "*", first("professionalName", "physicianName", "fullName", "name").alias("_name"), first(*whose, "institution", "provider", *here, last=parent).alias("_institution"), first("recordId", "sourceProfessionalId", last=F.concat_ws(":", F.col(file), F.col(row).cast("string"))).alias("_record_id"),
        F.when(one.isNotNull(), F.array(one)).otherwise(F.coalesce(several, F.array().cast("array<string>"))).alias("_specialties"),
    )


def group_observations(obs: DataFrame) -> DataFrame:
    """(institution, normalized_name, name_key, specialty) rows -> one identity each, specialties collected."""
    return obs.groupBy("institution", "normalized_name", "name_key").agg(F.array_sort(F.collect_set("specialty")).alias("specialties"))


def link(identities: DataFrame, registry: DataFrame) -> DataFrame:
    """Left join on ``name_key`` (registry: id, name_key, title) and the status of each identity.

    No hint: Catalyst broadcasts a registry that is small, and AQE splits hot names otherwise."""
    found = identities.join(registry.select("name_key", "id", "title"), "name_key", "left")
    agrees = F.array_contains("specialties", F.col("title"))
    out = found.groupBy("institution", "normalized_name").agg(F.count_distinct("id").alias("registry_matches"), F.coalesce(F.bool_or(agrees), F.lit(False)).alias("_agrees"))
    status = F.when(F.col("registry_matches") == 0, STATUSES[0]).when(F.col("registry_matches") > 1, STATUSES[1]).when(F.col("_agrees"), STATUSES[2]).otherwise(STATUSES[3])
    return out.withColumn("status", status).drop("_agrees")


def abstain(candidates: DataFrame) -> DataFrame:
    """Every resolution abstains and stays private; the reason follows from the status."""
    reason = F.create_map(*[x for s, r in zip(STATUSES, REASONS) for x in (F.lit(s), F.lit(r))])
    return candidates.withColumns({"resolution": F.lit("ABSTAINED"), "reason": reason[F.col("status")], "visibility": F.lit("not_public")})


#: Into so many parts the rows of a name are dealt; each meets all rows of the name. A block has so many ids at most.
SPREAD, BLOCK = 16, 128


def same_name_pairs(rows: DataFrame, id_col: str, key: str, *fields: str, judge: Callable[[Column, Column], dict[str, Column]] | None = None) -> DataFrame:
    """Pairs a, b of rows of one key, a's id the smaller: structs of the id and the fields, and what ``judge`` says of the
    fields of a and b. A hot name goes to several tasks.

    Rows of equal key and fields form blocks by id. Blocks meet, are judged once, and each id of one is paired with those of
    the other: so a result, which grows with the square of a name, repeats itself at short distances and takes little disk."""
    held = rows.select(F.col(key).alias("_key"), id_col, *fields).where(F.col(id_col).isNotNull())
    order = Window.partitionBy("_key", *fields).orderBy(id_col)
    held = held.withColumn("_block", F.floor((F.row_number().over(order) - 1) / BLOCK))
    blocks = held.groupBy("_key", *fields, "_block").agg(F.sort_array(F.collect_list(id_col)).alias("_ids"))
    side = blocks.select("_key", "_ids", F.struct(*fields, F.lit(None).cast("boolean").alias("_none")).alias("_fields"))
    a = side.withColumn("_part", F.pmod(F.xxhash64("_ids"), F.lit(SPREAD)).cast("int"))
    b = side.withColumn("_part", F.explode(F.sequence(F.lit(0), F.lit(SPREAD - 1))))
    # pairs grow with the square of a name, so their tasks aren't merged by the bytes that they read
    n = int(rows.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    a, b = (x.repartition(n, "_key", "_part").alias(s) for x, s in ((a, "a"), (b, "b")))
    same = [F.col(f"a.{c}") == F.col(f"b.{c}") for c in ("_key", "_part")]
    met = a.join(b.hint("merge"), [*same, F.col("a._ids")[0] < F.element_at("b._ids", -1)])
    said = judge(F.col("a._fields"), F.col("b._fields")) if judge else {}
    met = met.select(*[F.col(f"{s}.{c}").alias(f"{s}{c}") for s in ("a", "b") for c in ("_ids", "_fields")], *[c.alias(k) for k, c in said.items()])
    # coalesce changes no partition: it keeps the join's code apart, which else would hold all pairs of a block, not of two
    found = met.coalesce(n).withColumn("a_id", F.explode("a_ids")).withColumn("b_id", F.explode("b_ids")).where("a_id < b_id")
    return found.select(*[F.struct(F.col(f"{s}_id").alias(id_col), *[F.col(f"{s}_fields")[c].alias(c) for c in fields]).alias(s) for s in ("a", "b")], *said)


def profiles(registry: DataFrame, resolutions: DataFrame, key: str, item: str) -> DataFrame:
    """Every registry row with its sorted resolutions, empty where it has none."""
    held = resolutions.groupBy(key).agg(F.array_sort(F.collect_list(item)).alias("items"))
    kind = f"array<{dict(resolutions.dtypes)[item]}>"
    return registry.join(held, key, "left").withColumn("items", F.coalesce("items", F.array().cast(kind)))


def unknown_references(refs: DataFrame, registry: DataFrame, key: str) -> DataFrame:
    """References that no registry row has: must be empty."""
    return refs.join(registry.select(key), key, "left_anti")

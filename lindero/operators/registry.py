"""Registry: whole persons of the qualifying rows, conflicts of identity set aside, titles collected."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def qualifying(rows: DataFrame, document: str, condition: Column) -> DataFrame:
    """All rows of the documents that have a qualifying row: a semi-join, not a row filter."""
    return rows.join(rows.where(condition).select(document).distinct(), document, "left_semi")


def identities(rows: DataFrame, document: str, name: str, normalized: Column) -> DataFrame:
    """Per document: the least spelling of each normalised name, and whether it has more than one."""
    spelled = rows.withColumn("_norm", normalized).groupBy(document, "_norm").agg(F.min(name).alias("_name"))
    out = spelled.groupBy(document).agg(F.array_sort(F.collect_list("_name")).alias("names"), F.count(F.lit(1)).alias("n_names"))
    return out.withColumn("quarantined", F.col("n_names") > 1)


def titles(rows: DataFrame, document: str, fields: list[str]) -> DataFrame:
    """Sorted distinct titles of each document; empty parts are null and sort as ''."""
    held = F.struct(*[F.coalesce(F.col(f).cast("string"), F.lit("")).alias(f) for f in fields])
    got = rows.groupBy(document).agg(F.array_sort(F.collect_set(held)).alias("titles"))
    return got.withColumn("titles", F.transform("titles", lambda t: F.struct(*[F.nullif(t[f], F.lit("")).alias(f) for f in fields])))


def collated_titles(rows: DataFrame, document: str, title: str, kind: str, locale: str = "es") -> DataFrame:
    """Distinct titles, and distinct pairs of title and kind, of each document, in the locale's order."""
    pair = F.struct(title, kind)
    order = lambda a, b: F.when(a < b, -1).when(a > b, 1).otherwise(0)
    by = lambda x: F.collate(x, locale)
    got = rows.groupBy(document).agg(F.collect_set(title).alias("titles"), F.collect_set(pair).alias("pairs"))
    pairs = F.array_sort("pairs", lambda a, b: F.when(by(a[title]) == by(b[title]), order(a[kind], b[kind])).otherwise(order(by(a[title]), by(b[title]))))
    return got.select(document, F.array_sort("titles", lambda a, b: order(by(a), by(b))).alias("titles"), pairs.alias("pairs"))


def gate(n_quarantined: int, expected: int) -> None:
    if n_quarantined != expected:
        raise ValueError(f"{n_quarantined} identity conflicts, expected {expected}")

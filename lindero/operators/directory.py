"""Provider directories: schedules joined to their records, centers, and the counts of a provider's run."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..functions.text import physician_key


def with_schedules(records: DataFrame, schedules: DataFrame) -> DataFrame:
    """Directory records with the sorted ids of the schedules of their center's page and physician. records: center_url,
    physician, and others; schedules: requested_url, physician, record_id. A record without a center keeps an empty list."""
    held = schedules.groupBy(F.col("requested_url").alias("center_url"), physician_key(F.col("physician")).alias("_who")).agg(F.array_sort(F.collect_set("record_id")).alias("schedule_ids"))
    out = records.withColumn("_who", physician_key(F.col("physician"))).join(held, ["center_url", "_who"], "left").drop("_who")
    out = out.withColumn("schedule_ids", F.coalesce("schedule_ids", F.array().cast("array<string>")))
    return out.withColumn("schedule_type", F.when(F.size("schedule_ids") > 0, "published_on_center_page").otherwise("not_published_on_source"))


#: Bytes from which a list of schedules is long.
LONG = 32 << 10
#: Tasks for long lists.
MOST = 2048


def with_schedule_text(records: DataFrame, schedules: DataFrame, sep: str = "|") -> DataFrame:
    """``with_schedules`` with the ids as one text, ``schedules``, made once a center and physician.

    All records of a long list go to one task, which has no other long list unless there are more than ``MOST`` of them. A
    file then holds the list once, in its dictionary. Several in a task would leave the dictionary, and writers notice that
    only after up to 10,000 rows of such a length. Records without a long list join by key."""
    key = ["center_url", "_who"]
    held = schedules.where("record_id IS NOT NULL").groupBy(F.col("requested_url").alias("center_url"), physician_key(F.col("physician")).alias("_who"))
    held = held.agg(F.array_join(F.array_sort(F.collect_set("record_id")), sep).alias("schedules")).where("center_url IS NOT NULL AND _who IS NOT NULL")
    size = F.length(F.col("schedules").cast("binary"))
    records = records.withColumn("_who", physician_key(F.col("physician")))
    kind = lambda df: df.withColumn("schedules", F.coalesce("schedules", F.lit(""))).withColumn("schedule_type", F.when(F.col("schedules") != "", "published_on_center_page").otherwise("not_published_on_source"))
    long = held.where(size > LONG).select(*key)
    n = min(MOST, long.count())
    if not n:
        return kind(records.join(held, key, "left").drop("_who"))
    # numbers whose hashes are the tasks 0 to n - 1, so that Spark's own dealing by hash puts each list where it should be
    spark = records.sparkSession
    number = spark.range(64 * n).groupBy(F.pmod(F.hash("id"), F.lit(n)).alias("_task")).agg(F.array_sort(F.collect_list("id")).alias("_ids"))
    place = long.withColumn("_i", F.row_number().over(Window.orderBy(*key)) - 1).withColumn("_task", F.col("_i") % n)
    place = place.join(F.broadcast(number), "_task", "left")
    place = place.select(*key, F.try_element_at("_ids", (F.floor(F.col("_i") / n) + 1).cast("int")).alias("_to"))
    placed = records.join(F.broadcast(place), key, "left")
    few = placed.where("_to IS NULL").drop("_to").join(held.join(F.broadcast(place.where("_to IS NOT NULL").select(*key)), key, "left_anti"), key, "left")
    lists = held.join(F.broadcast(place.where("_to IS NOT NULL")), key).select("_to", "schedules")
    many = placed.where("_to IS NOT NULL").repartition(n, "_to").join(lists.repartition(n, "_to").hint("merge"), "_to").drop("_to")
    return kind(few.unionByName(many).drop("_who"))


def centers(records: DataFrame) -> DataFrame:
    """Per center url the least non-empty address and name in Spanish order, '' where there is none."""
    least = lambda c: F.coalesce(F.min(F.collate(F.nullif(F.col(c), F.lit("")), "es")).cast("string"), F.lit(""))
    return records.where("center_url IS NOT NULL").groupBy("center_url").agg(least("address").alias("address"), least("center").alias("center"))


def linked_schedules(records: DataFrame, schedules: DataFrame) -> DataFrame:
    """One row: schedules, those that some record refers to, and the others."""
    used = records.select(F.explode("schedule_ids").alias("record_id")).distinct()
    out = schedules.select("record_id").distinct().join(used.withColumn("_used", F.lit(1)), "record_id", "left")
    return out.agg(F.count(F.lit(1)).alias("schedules"), F.count("_used").alias("linked"), F.count_if(F.col("_used").isNull()).alias("unlinked"))


def run_counts(schedules: DataFrame, physician: str, specialty: str, clinic: str, intervals: str) -> DataFrame:
    """Distinct physicians, specialties and clinics, and records without and with several intervals. Each distinct count is
    a grouping of its own, so the rows aren't multiplied by the number of counts."""
    n = lambda c: schedules.groupBy(c).agg(F.lit(1).alias("_")).agg(F.count_if(F.col(c).isNotNull()).alias(c))
    rest = schedules.agg(F.count(F.lit(1)).alias("records"), F.count_if(F.size(intervals) == 0).alias("without_intervals"), F.count_if(F.size(intervals) > 1).alias("several_intervals"))
    for c, name in ((physician, "physicians"), (specialty, "specialties"), (clinic, "clinics")):
        rest = rest.crossJoin(n(c).withColumnRenamed(c, name))  # one row each
    return rest


def quality_issues(rows: Column, complete: Column, centers: Column, least: int = 100) -> Column:
    """What speaks against a directory page: too few rows, under nine tenths of them complete, no center addresses."""
    share = F.when(rows == 0, 0.0).otherwise(complete / rows)
    issues = F.array(F.when(rows < least, "TOO_FEW_ROWS"), F.when(share < 0.9, "INCOMPLETE_ROWS"), F.when(centers == 0, "NO_CENTER_URLS"))
    return F.filter(issues, lambda x: x.isNotNull())


def resolution_counts(profiles: DataFrame, statuses: list[str]) -> DataFrame:
    """One row: profiles, those with a resolution, and resolutions of each status. profiles: resolutions, an array of structs with
    ``status``."""
    of = lambda s: F.coalesce(F.sum(F.size(F.filter("resolutions", lambda r: r["status"] == s))), F.lit(0)).cast("long").alias(s)
    return profiles.agg(F.count(F.lit(1)).alias("profiles"), F.count_if(F.size("resolutions") > 0).alias("with_resolutions"), *map(of, statuses))


def first_of_group(rows: DataFrame, key: list[str], order: list[str], fields: list[str]) -> DataFrame:
    """The fields of each group's first row: a partial aggregate, no window over a hot group."""
    return rows.groupBy(*key).agg(F.min_by(F.struct(*fields), F.struct(*order)).alias("_first")).select(*key, "_first.*")


def collated(df: DataFrame, columns: list[str], locale: str = "es", ties: tuple[str, ...] = ()) -> DataFrame:
    """A total order: the columns by the locale's rules, then the ties by code points."""
    return df.orderBy(*[F.collate(F.col(c), locale) for c in columns], *ties)


def first_by_position(df: DataFrame, position: str, limit: int | None) -> DataFrame:
    """The first rows of a list by position: all without a limit."""
    return df if limit is None else df.orderBy(position).limit(limit)

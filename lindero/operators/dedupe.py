"""Order-dependent operators as windows: every order is total, so results don't depend on partitions."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F


def keep_first(df: DataFrame, key: list[str], order: list, n: int = 1) -> DataFrame:
    """The first n rows of each key; Spark limits each partition before the shuffle."""
    w = Window.partitionBy(*key).orderBy(*order)
    return df.withColumn("_rn", F.row_number().over(w)).where(F.col("_rn") <= n).drop("_rn")


def keep_last(df: DataFrame, key: list[str], order: list[str]) -> DataFrame:
    return keep_first(df, key, [F.col(c).desc() for c in order])


def carry_forward(df: DataFrame, key: list[str], order: list, value: Column, name: str) -> DataFrame:
    """The last non-empty value up to each row."""
    w = Window.partitionBy(*key).orderBy(*order).rowsBetween(Window.unboundedPreceding, Window.currentRow)
    return df.withColumn(name, F.last(F.nullif(value, F.lit("")), ignorenulls=True).over(w))


def seen_before(df: DataFrame, key: list[str], order: list, flag: Column, name: str) -> DataFrame:
    """Whether the flag was set on an earlier row of the key."""
    w = Window.partitionBy(*key).orderBy(*order).rowsBetween(Window.unboundedPreceding, -1)
    return df.withColumn(name, F.coalesce(F.max(flag).over(w), F.lit(False)))


def fan_out(df: DataFrame, key: list[str], cap: int) -> DataFrame:
    """Adds how many matches a mention has and whether it is over the cap; counting is a partial aggregate, not a
    window over the rows of a hot mention."""
    counts = df.groupBy(*key).agg(F.count(F.lit(1)).alias("match_count"))
    return df.join(counts, key).withColumn("suppressed", F.col("match_count") > cap)


def competing(df: DataFrame, key: list[str], id_col: str) -> DataFrame:
    """All other ids of the same key, sorted."""
    ids = df.groupBy(*key).agg(F.array_sort(F.collect_set(id_col)).alias("_ids"))
    return df.join(ids, key).withColumn("competing", F.array_remove("_ids", F.col(id_col))).drop("_ids")


#: Over at most so many tasks the rows of a key are dealt, one for each LIST bytes of its list.
SPREAD, LIST = 16, 8192


def competing_text(df: DataFrame, key: list[str], id_col: str, sep: str = "|") -> DataFrame:
    """id, competing: all other ids of the same key, sorted, as one text. A key's ids are joined once, and each row takes out
    its own, by bytes: neither arrays nor texts of ids are made for a row. The rows of a long list are dealt over several
    tasks, as they grow with the square of a key's ids. The longest lists come first in every task: writers look at their
    buffers now and then only, by the rows before, so that long rows after many short ones would fill memory."""
    parts = F.least(F.lit(SPREAD), (1 - F.col("_order") / LIST).cast("int"))
    ids = df.groupBy(*key).agg(F.array_join(F.array_sort(F.collect_set(id_col)), sep).cast("binary").alias("_all"))
    ids = ids.select(*[F.col(k).alias(f"_k{i}") for i, k in enumerate(key)], "_all", (-F.length("_all")).alias("_order"))
    ids = ids.withColumn("_part", F.explode(F.sequence(F.lit(0), parts - 1)))
    order = Window.partitionBy(*key).orderBy(id_col)
    size = F.length(F.col(id_col).cast("string").cast("binary"))
    new = F.lag(id_col).over(order).isNull() & F.col(id_col).isNotNull() | (F.lag(id_col).over(order) != F.col(id_col))
    rows = df.select(*key, id_col, size.alias("_size"), F.when(new, size + len(sep)).otherwise(0).cast("long").alias("_new"))
    upto = rows.withColumn("_upto", F.sum("_new").over(order.rowsBetween(Window.unboundedPreceding, 0)))
    length = Window.partitionBy(*key)
    upto = upto.withColumn("_order", F.least(len(sep) - F.sum("_new").over(length), F.lit(0)).cast("int"))
    upto = upto.withColumn("_part", F.pmod(F.xxhash64(id_col), parts).cast("int"))
    # what is written has little to do with what is read, so tasks aren't merged by the bytes that they read
    n = int(df.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    ids, upto = ids.repartition(n, "_order", *[f"_k{i}" for i in range(len(key))], "_part"), upto.repartition(n, "_order", *key, "_part")
    same = [upto["_order"] == ids["_order"], *[upto[k] == ids[f"_k{i}"] for i, k in enumerate(key)], upto["_part"] == ids["_part"]]
    found = upto.join(ids.hint("merge"), same).select(id_col, "_all", "_size", "_upto")
    before, after = F.col("_upto") - F.col("_size") - len(sep), F.col("_upto")
    last = after > F.length("_all")
    head = F.substring("_all", F.lit(1), F.when(last, F.greatest(before - len(sep), F.lit(0))).otherwise(before).cast("int"))
    tail = F.substring("_all", (after + 1).cast("int"), F.length("_all"))
    return found.select(id_col, F.concat(head, tail).cast("string").alias("competing"))


def merge_by_key(df: DataFrame, key: str, order: list[str], first: list[str], union: str) -> DataFrame:
    """One row a key: the first row's metadata, and the union of an array column."""
    head = F.min_by(F.struct(*first), F.struct(*order)).alias("_first")
    out = df.groupBy(key).agg(head, F.array_sort(F.array_distinct(F.flatten(F.collect_set(union)))).alias(union))
    return out.select(key, "_first.*", union)


def merge_articles(df: DataFrame, key: str, order: list[str], first: list[str], name: str, normalized: Column) -> DataFrame:
    """One row an article, from rows of (article, name): the first row's metadata, and its names in the order in which each
    normalised name came first, in the spelling that came last."""
    at = F.struct(*order)
    spelled = df.where(F.col(name).isNotNull()).withColumn("_norm", normalized).groupBy(key, "_norm").agg(F.min(at).alias("_at"), F.max_by(name, at).alias("_name"))
    names = spelled.groupBy(key).agg(F.transform(F.array_sort(F.collect_list(F.struct("_at", "_norm", "_name"))), lambda x: x["_name"]).alias("names"))
    head = df.groupBy(key).agg(F.min_by(F.struct(*first), at).alias("_first")).select(key, "_first.*")
    return head.join(names, key, "left").withColumn("names", F.coalesce("names", F.array().cast("array<string>")))

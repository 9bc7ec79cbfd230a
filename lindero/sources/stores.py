"""Catalog tables in a database, inputs found among artifacts, results appended with a progress note."""

from __future__ import annotations

import json
import os
from collections.abc import Callable, Iterable
from pathlib import Path

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

# How long a connection and a statement may take, rows between progress notes.
CONNECT_SECONDS, STATEMENT_SECONDS, EVERY = 3, 10, 25


def jdbc_options(url: str, table: str, column: str | None = None, bounds: tuple[int, int] | None = None, parts: int = 8, connect: int = CONNECT_SECONDS, statement: int = STATEMENT_SECONDS) -> dict[str, str]:
    """Options of a JDBC read. With a column and its bounds the table is read in parts, each by a range of its own."""
    if not url.startswith("jdbc:"):
        raise ValueError("a jdbc: address is needed")
    out = {"url": url, "dbtable": table, "queryTimeout": str(statement), "fetchsize": "10000", "connectTimeout": str(connect), "loginTimeout": str(connect)}
    if column:
        if bounds is None or bounds[0] > bounds[1]:
            raise ValueError("bounds of the column are needed")
        out |= {"partitionColumn": column, "lowerBound": str(bounds[0]), "upperBound": str(bounds[1]), "numPartitions": str(parts)}
    return out


def scan(spark: SparkSession, **options) -> DataFrame:
    """A table of a database; the driver class must be on Spark's class path."""
    return spark.read.format("jdbc").options(**jdbc_options(**options)).load()


def new_rows(rows: DataFrame, existing: DataFrame, key: list[str]) -> DataFrame:
    """Rows whose key the table doesn't have; of several with one key the least. A null in a key conflicts with nothing."""
    whole = " AND ".join(f"`{k}` IS NOT NULL" for k in key)
    least = F.min(F.struct(*[F.col(c) for c in rows.columns])).alias("_r")
    fresh = rows.where(whole).groupBy(*key).agg(least).select("_r.*").join(existing.select(*key), key, "left_anti").select(*rows.columns)
    return fresh.unionByName(rows.where(f"NOT ({whole})"))


def seed(tables: dict[str, tuple[DataFrame, list[str]]], read: Callable[[str], DataFrame], append: Callable[[str, DataFrame], None]) -> dict[str, int]:
    """Adds to each table, in order, the rows that it lacks; again it adds nothing. Returns how many each got."""
    out = {}
    for name, (rows, key) in tables.items():
        fresh = new_rows(rows, read(name), key).cache()
        out[name] = fresh.count()
        if out[name]:
            append(name, fresh)
        fresh.unpersist()
    return out


def found_files(spark: SparkSession, folder: str, pattern: str) -> DataFrame:
    """(path, modified, size) of the files of a folder and those below whose name matches; contents aren't read."""
    files = spark.read.format("binaryFile").option("recursiveFileLookup", "true").option("pathGlobFilter", pattern).load(folder)
    return files.select("path", F.col("modificationTime").alias("modified"), F.col("length").alias("size"))


def newest(files: DataFrame) -> DataFrame:
    """The file changed last; of several the last path."""
    return files.agg(F.max(F.struct("modified", "path")).alias("m")).where("m IS NOT NULL").select("m.path", "m.modified")


def last_path(files: DataFrame) -> DataFrame:
    """The last path by code points: of dated folders the latest."""
    return files.agg(F.max("path").alias("path")).where("path IS NOT NULL")


def append_with_progress(target: Path, batches: Iterable[list[dict]], every: int = EVERY) -> dict:
    """Appends rows of requests as NDJSON, each record id once, and notes every so many requests how far it is. A run that is
    started again goes on after the rows that are there."""
    note = target.with_name(target.name + ".progress.json")
    seen = {json.loads(x)["record_id"] for x in target.read_text().splitlines()} if target.exists() else set()
    status = {"requests": 0, "written": len(seen), "duplicates": 0, "state": "RUNNING"}

    def tell() -> None:
        part = note.with_name(f".{note.name}.{os.getpid()}")
        part.write_text(json.dumps(status) + "\n")
        os.replace(part, note)

    with target.open("a", encoding="utf-8") as f:
        for rows in batches:
            for r in rows:
                if r["record_id"] in seen:
                    status["duplicates"] += 1
                    continue
                seen.add(r["record_id"])
                f.write(json.dumps(r, ensure_ascii=False, separators=(",", ":")) + "\n")
                status["written"] += 1
            status["requests"] += 1
            if status["requests"] % every == 0:
                f.flush()
                tell()
    status["state"] = "COMPLETE"
    tell()
    return status

"""Queries that failed on larger tables: what their plans must not do, and results on rows made for it."""

import pandas as pd
import pyarrow.parquet as pq
from pyspark.sql import functions as F

from lindero.operators import dedupe, directory, linkage
from lindero.plans import catalog, contracts

from .conftest import DATA
from .oracle import same_as_sql

assert contracts  # adds its queries


def optimized(df) -> list[str]:
    return df._jdf.queryExecution().optimizedPlan().toString().split("\n")


def test_pairs_of_a_name_work_nothing_out(spark):
    """Above the join of linkage_evidence there is no folding; a hot name goes to several tasks."""
    df = catalog.QUERIES["linkage_evidence"](spark, DATA)
    plan = optimized(df)
    join = next(i for i, x in enumerate(plan) if "Join " in x)
    assert not [x for x in plan[: join + 1] if "translate(" in x or "regexp_replace(" in x]
    same_as_sql(df, catalog.ORACLES["linkage_evidence"], DATA)
    rows = spark.createDataFrame(pd.DataFrame({"id": range(300), "k": ["hot"] * 299 + ["cold"], "f": range(300)}))
    got = linkage.same_name_pairs(rows, "id", "k", "f").select("a.id", F.col("b.id").alias("other"), F.spark_partition_id().alias("p")).collect()
    assert sorted((r[0], r[1]) for r in got) == [(i, j) for i in range(299) for j in range(i + 1, 299)] and len({r.p for r in got}) > 1


def test_competing_text(spark):
    """Once a name, not once a row, are ids joined; repeated and missing ids, keys of one id, and the ends of a list."""
    df = catalog.QUERIES["competing_ids"](spark, DATA)
    plan = optimized(df)
    join = next(i for i, x in enumerate(plan) if "Join " in x)
    assert not [x for x in plan[: join + 1] if "array_join(" in x or "array_remove(" in x]
    same_as_sql(df, catalog.ORACLES["competing_ids"], DATA)
    rows = [(i, "hot") for i in (7, 9, 10, 11, 100, 9999, -3)] + [(10, "hot"), (100, "hot"), (5, "one"), (6, "two"), (8, "two"), (4, None), (None, "hot"), (None, "none")]
    table = spark.createDataFrame(rows, "id long, k string")
    want = dedupe.competing(table, ["k"], "id").select("id", F.array_join("competing", "|"))
    text = lambda df: sorted(map(str, df.collect()))
    got = dedupe.competing_text(table, ["k"], "id")
    assert [tuple(r) for r in got.where("id = 10").collect()] == [(10, "-3|7|9|11|100|9999")] * 2
    assert text(got.toDF("a", "b")) == text(want.toDF("a", "b"))


def test_lists_longer_than_a_window_take_little_disk(spark, tmp_path):
    """competing_ids: 4,000 texts of 76 KB, of which no two are within 64 KB of a file, are written whole in a twentieth of their
    bytes at most, by several tasks; a codec that the session was given stays."""
    ids = [10**17 + 7919 * i for i in range(4000)]
    pd.DataFrame({"p_partkey": ids, "p_name": "hot"}).to_parquet(f"{tmp_path}/part.parquet")
    own, given = spark.newSession(), spark.newSession()
    catalog.QUERIES["competing_ids"](own, str(tmp_path)).write.parquet(f"{tmp_path}/out")
    want, found = "|".join(map(str, ids)), set()
    for path in (tmp_path / "out").glob("*.parquet"):
        for batch in pq.ParquetFile(path).iter_batches(64):
            for i, text in zip(*(x.to_pylist() for x in batch.columns)):
                assert f"{text}|" == f"{want}|".replace(f"{i}|", "")
                found.add(i)
    assert found == set(ids)
    files = [p.stat().st_size for p in (tmp_path / "out").glob("*.parquet")]
    assert sum(files) < 4000 * len(want) / 20 and len([x for x in files if x > 10_000]) > 1
    given.conf.set("spark.sql.parquet.compression.codec", "gzip")
    catalog.QUERIES["competing_ids"](given, DATA)
    assert given.conf.get("spark.sql.parquet.compression.codec") == "gzip"


def test_pairs_take_little_disk(spark, tmp_path):
    """linkage_evidence: 1,124,250 pairs of one name, as SQL has them, written in under half a byte each even by snappy."""
    n = 1500
    titles = [("SMALL BRASS", "brass", "doctor en medicina", "Small", None)[i * i % 5] for i in range(n)]
    pd.DataFrame({"p_partkey": [i * 7919 % n for i in range(n)], "p_name": [("hot part", "part hot")[i % 3 == 0] for i in range(n)], "p_type": titles}).to_parquet(f"{tmp_path}/part.parquet")
    own = spark.newSession()
    own.conf.set("spark.sql.parquet.compression.codec", "snappy")
    catalog.QUERIES["linkage_evidence"](own, str(tmp_path)).write.parquet(f"{tmp_path}/out")
    rows = pq.read_table(f"{tmp_path}/out").to_pandas().sort_values(["part_a", "part_b"])
    assert list(zip(rows.part_a, rows.part_b)) == [(i, j) for i in range(n) for j in range(i + 1, n)]
    same_as_sql(own.read.parquet(f"{tmp_path}/out").where("part_a < 40"), f"SELECT * FROM ({catalog.ORACLES['linkage_evidence']}) WHERE part_a < 40", str(tmp_path))
    assert sum(p.stat().st_size for p in (tmp_path / "out").glob("*.parquet")) < len(rows) / 2


def test_pairs_of_blocks(spark, monkeypatch):
    """Repeated and missing ids, missing keys and fields, blocks of any size: all pairs, each once."""
    rows = [(7 * i % 50, "hot" if i % 4 else "cold", (None, "x", "y")[i % 3]) for i in range(120)] + [(None, "hot", "x"), (1, None, "x"), (2, None, "x")]
    table = spark.createDataFrame(rows, "id long, k string, f string")
    held = [r for r in rows if None not in r[:2]]
    want = [((a[0], a[2]), (b[0], b[2]), a[2] == b[2] if a[2] and b[2] else None) for a in held for b in held if a[1] == b[1] and a[0] < b[0]]
    for block in (1, 3, 128):
        monkeypatch.setattr(linkage, "BLOCK", block)
        got = linkage.same_name_pairs(table, "id", "k", "f", judge=lambda a, b: {"same": a["f"] == b["f"]}).collect()
        assert sorted(map(str, want)) == sorted(str((tuple(r.a), tuple(r.b), r.same)) for r in got)


def test_long_schedules_have_tasks_of_their_own(spark, monkeypatch):
    """Lists are joined once, not once a record; no task has two long ones; nothing is lost, whatever counts as long."""
    query, sql = catalog.QUERIES["directory_schedules"], catalog.ORACLES["directory_schedules"]
    for most, long in ((2048, 32 << 10), (2048, 28), (3, 20), (2048, 0)):
        monkeypatch.setattr(directory, "MOST", most)
        monkeypatch.setattr(directory, "LONG", long)
        df = query(spark, DATA)
        plan = optimized(df)
        join = next(i for i, x in enumerate(plan) if "Join " in x)
        assert not [x for x in plan[: join + 1] if "array_join(" in x]
        same_as_sql(df, sql, DATA)
        if most > 3 and long < 1000:
            rows = [r for r in df.select("schedules", F.spark_partition_id().alias("p")).collect() if len(r.schedules) > long]
            lists = {(r.p, r.schedules) for r in rows}
            assert rows and len(lists) == len({x[0] for x in lists}) == len({x[1] for x in lists})

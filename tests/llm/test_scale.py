"""Training-data operators on what failed on larger tables."""

import numpy as np

from lindero.llm import graph_search


def test_nearest_sends_no_queries_to_the_driver(spark, monkeypatch):
    """Spark takes the queries for as small as those of one shard; there are as many copies as shards."""
    rng = np.random.default_rng(5)
    vec = rng.normal(size=(600, 8))
    table = spark.createDataFrame([(i, v.tolist()) for i, v in enumerate(vec)], "vec_id long, embedding array<double>")
    unit = vec / np.linalg.norm(vec, axis=1, keepdims=True)
    sims = unit @ unit.T
    np.fill_diagonal(sims, -9)
    want = {(q, n + 1): int(i) for q in range(0, 600, 2) for n, i in enumerate(np.argsort(-sims[q])[:5])}
    for pack, block in ((4096, 256), (70, 16)):
        monkeypatch.setattr(graph_search, "PACK", pack)
        monkeypatch.setattr(graph_search, "BLOCK", block)
        df = graph_search.search(table, every=2, shard_rows=40)
        assert {(r.query_id, r["rank"]): r.vec_id for r in df.collect()} == want  # shards are searched whole
        plan = df._jdf.queryExecution().executedPlan().toString()
        assert "isFinalPlan=true" in plan and "BroadcastHashJoin" not in plan and "BroadcastExchange" not in plan

import numpy as np
import pytest
from edge import documents

from tallystar.llm import sharding


def test_matrix_lines_add_up():
    counts = [5, 0, 17, 3, 40, 1]
    ends = np.cumsum(counts).tolist()
    lines = np.array([sharding.matrix_line(i, ends, 7, 3) for i in range(len(counts))])
    assert lines.sum(1).tolist() == counts
    assert lines.sum(0).tolist() == sharding.shard_sizes(66, 7).tolist()
    one = np.array([[sharding.matrix_line(0, [4, 8], 2, seed)[0]] for seed in range(2000)])
    # Of 4 rows from 8, half in either shard: 2 with chance 36/70, 0 and 4 with 1/70 each.
    assert abs((one == 2).mean() - 36 / 70) < 0.04 and 0 < (one == 0).mean() < 0.04


def test_large_draws_stay_in_range():
    random = np.random.default_rng(1)
    draws = [sharding._hypergeometric(random, 10**10, 3 * 10**10, 10**9) for _ in range(50)]
    assert abs(np.mean(draws) / 10**9 - 0.25) < 0.001
    assert sharding._hypergeometric(random, 10**10, 5, 10**10 + 2) >= 10**10 - 3


def test_shards_are_exact_and_uniform(spark):
    docs = spark.range(3000, numPartitions=5).selectExpr("id AS doc_id", "cast(id AS string) AS text")
    rows = sharding.uniform_shards(docs, 24, seed=5).collect()
    by_shard = {}
    for r in rows:
        by_shard.setdefault(r.shard, []).append(r)
    assert sorted(by_shard) == list(range(24))
    assert {len(v) for v in by_shard.values()} == {125}
    assert all(sorted(r.slot for r in v) == list(range(len(v))) for v in by_shard.values())
    assert sorted(r.doc_id for r in rows) == list(range(3000)) and all(r.text == str(r.doc_id) for r in rows)
    # Rows of each fifth of the input are spread evenly over shards and places.
    table = np.zeros((5, 24))
    for r in rows:
        table[r.doc_id // 600, r.shard] += 1
    assert ((table - 25) ** 2 / 25).sum() < 170          # chi-square, 92 degrees of freedom
    halves = np.array([r.slot < 62.5 for r in sorted(rows, key=lambda r: r.doc_id)])
    assert abs(halves[:600].mean() - 0.5) < 0.1
    assert sorted(map(tuple, rows)) == sorted(map(tuple, sharding.uniform_shards(docs, 24, seed=5).collect()))


def test_edges(spark):
    docs = documents(spark)
    rows = sharding.uniform_shards(docs, 3).collect()
    assert sorted([r.shard for r in rows]) == [0, 0, 0, 1, 1, 1, 2, 2]
    assert sorted((r.text or "") for r in rows) == sorted((r.text or "") for r in docs.collect())
    empty = sharding.uniform_shards(docs.limit(0), 3)
    assert empty.count() == 0 and empty.columns == [*docs.columns, "shard", "slot"]
    with pytest.raises(ValueError, match="shard"):
        sharding.uniform_shards(docs.withColumnRenamed("lang", "shard"), 3)

import numpy as np
import pytest

from tallystar.llm import neighbours as nn


def brute(ids, vectors, query, k):
    a = np.array(vectors, float)
    score = (a @ a[query]) / (np.linalg.norm(a, axis=1) * np.linalg.norm(a[query]))
    return sorted(((-s, i) for s, i in zip(score, ids) if i != ids[query]))[:k]


def table(spark, rows):
    return spark.createDataFrame(rows, "vec_id long, embedding array<float>, label int").selectExpr(
        "*", "label AS id", "label AS score", "label AS rank", "label AS query_id")


def test_recall_and_order(spark):
    r = np.random.default_rng(3)
    centres = r.standard_normal((8, 32))
    vectors = [(centres[i % 8] + r.standard_normal(32) * (0.3 if i % 2 else 2)).astype(np.float32)
               for i in range(900)]
    df = table(spark, [(i, v.tolist(), 0) for i, v in enumerate(vectors)])
    got = {}
    for x in nn.nearest(df, df.where("vec_id % 50 = 0")).collect():
        got.setdefault(x.query_id, []).append(x)
    assert sorted(got) == list(range(0, 900, 50))
    hits = 0
    for q, found in got.items():
        found.sort(key=lambda x: x.rank)
        assert [x.rank for x in found] == [1, 2, 3, 4, 5]
        want = brute(list(range(900)), vectors, q, 5)
        hits += len({i for _, i in want} & {x.vec_id for x in found})
        for x in found:
            a, b = np.float64(vectors[q]), np.float64(vectors[x.vec_id])
            assert x.score == pytest.approx(a @ b / np.linalg.norm(a) / np.linalg.norm(b), abs=1e-12)
        assert [(-x.score, x.vec_id) for x in found] == sorted((-x.score, x.vec_id) for x in found)
    assert hits / (5 * len(got)) >= 0.9


def test_copies_tie_to_the_smaller_id(spark):
    df = table(spark, [(i, [1.0, 2.0, 3.0], 0) for i in range(40)] + [(100, [-1.0, 0.0, 0.5], 0)])
    got = nn.nearest(df, df.where("vec_id % 50 = 0")).orderBy("query_id", "rank").collect()
    assert [(x.query_id, x.vec_id) for x in got if x.query_id == 0] == [(0, i) for i in (1, 2, 3, 4, 5)]
    assert all(x.score == pytest.approx(1.0) for x in got if x.query_id == 0)


def test_edges(spark):
    nan, inf = float("nan"), float("inf")
    rows = [(0, [1.0, 0.0], 0), (1, None, 0), (2, [0.0, 0.0], 0), (3, [nan, 1.0], 0), (4, [None, 1.0], 0),
            (5, [inf, 1.0], 0), (6, [1.0, 1.0], 0), (6, [1.0, 1.0], 0), (None, [1.0, 0.1], 0),
            (7, [1.0, 0.0, 0.0], 0), (8, [], 0), (50, [0.0, 1.0], 0), (50, [0.0, 1.0], 0), (100, None, 0)]
    df = table(spark, rows)
    got = sorted((x.query_id, x.rank, x.vec_id, round(x.score, 6))
                 for x in nn.nearest(df, df.where("vec_id % 50 = 0")).collect())
    assert got == [(0, 1, 6, 0.707107), (0, 2, 50, 0.0), (50, 1, 6, 0.707107), (50, 2, 0, 0.0)]
    empty = df.limit(0)
    assert nn.nearest(empty, empty).count() == 0 and nn.nearest(df, empty).count() == 0


def test_blocks_cover_every_row(monkeypatch):
    import pyarrow as pa
    monkeypatch.setattr(nn, "BLOCK_ROWS", 7)
    batch = pa.RecordBatch.from_arrays([pa.array(range(25)), pa.array([[float(i)] for i in range(25)])],
                                       ["id", "vector"])
    parts = [ids.to_pylist() for ids, _ in nn._blocks(iter([batch, batch.slice(0, 3)]))]
    assert sum(parts, []) == [*range(25), 0, 1, 2] and max(map(len, parts)) <= 7


def test_equal_vectors_in_many_blocks_tie_to_the_smallest_ids(spark, monkeypatch):
    r = np.random.default_rng(11)
    same = r.standard_normal(48)
    rows = [(i, (same if i % 11 == 0 else r.standard_normal(48)).tolist(), 0) for i in range(700)]
    df = table(spark, rows).repartition(5)
    got = nn.nearest(df, df.where("vec_id = 0 OR vec_id = 550")).collect()
    for query in (0, 550):
        found = sorted((x.rank, x.vec_id) for x in got if x.query_id == query)
        assert [v for _, v in found] == [i for i in (0, 11, 22, 33, 44, 55) if i != query][:5]
    assert len({x.score for x in got}) == 1


def test_exact_cosine_is_the_same_beside_any_rows():
    r = np.random.default_rng(12)
    query, vectors = r.standard_normal(64), r.standard_normal((37, 64))
    whole = nn.exact_cosine(query, vectors)
    for n in range(1, 37):
        assert (nn.exact_cosine(query, vectors[:n]) == whole[:n]).all()
    assert whole == pytest.approx(vectors @ query / nn.norms(vectors) / np.sqrt(query @ query), abs=1e-14)

import random
import sys

import numpy as np
import pyarrow as pa
import pytest
from edge import documents, plain

from tallystar.llm import common, jaccard
from tallystar.llm.components import components


def shingle_set(text):
    words = "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text or "").encode().split()
    return {tuple(words[i:i + 5]) for i in range(max(1, len(words) - 4))} if words else set()


def brute(texts):
    """(set size, least linked id) per id, over all pairs."""
    sets = {i: shingle_set(t) for i, t in texts.items()}
    low = {i: i for i in sets}

    def find(i):
        while low[i] != i:
            i = low[i]
        return i

    for i in sets:
        for j in sets:
            if i < j and sets[i] and sets[j]:
                common = len(sets[i] & sets[j])
                if 100 * common >= 80 * (len(sets[i]) + len(sets[j]) - common):
                    a, b = sorted((find(i), find(j)))
                    low[b] = a
    return {i: (len(sets[i]), find(i)) for i in sets}


def corpus(seed=1):
    """Texts with copies, near copies at every distance, chains and a passage that many share."""
    r = random.Random(seed)
    words = [f"w{i}" for i in range(400)]
    passage = [r.choice(words) for _ in range(60)]
    texts = []
    for _ in range(25):
        base = [r.choice(words) for _ in range(r.choice([3, 5, 8, 12, 40, 90, 200]))]
        if r.random() < 0.4:
            base += passage
        texts.append(base)
        for _ in range(r.randint(0, 6)):
            near = list(r.choice(texts[-3:]))
            for _ in range(r.randint(0, max(1, len(near) // 25))):
                at = r.randrange(len(near))
                near[at:at + r.randint(0, 2)] = [r.choice(words) for _ in range(r.randint(0, 2))]
            texts.append(near)
    r.shuffle(texts)
    return [" ".join(t) if r.random() < 0.5 else " \n".join(t).upper() for t in texts]


def test_pairs_that_link_share_a_token():
    r = np.random.default_rng(0)
    for _ in range(1500):
        n = int(r.integers(1, 150))
        pool = np.unique(r.integers(0, 2**63, n + 60, dtype=np.uint64))
        r.shuffle(pool)
        drop, add = int(r.integers(0, n // 4 + 1)), int(r.integers(0, n // 4 + 1))
        a, b = np.sort(pool[:n]), np.sort(np.concatenate([pool[drop:n], pool[n:n + add]]))
        common = len(np.intersect1d(a, b))
        if len(b) and 100 * common >= 80 * (len(a) + len(b) - common):
            (x, bits_a), (y, bits_b) = jaccard.tokens(a, 80), jaccard.tokens(b, 80)
            assert set(x.tolist()) & set(y.tolist())
            bits = pa.array([jaccard._sketch(a, bits_a), jaccard._sketch(b, bits_b)])
            u, v = jaccard._folded(bits, min(bits_a, bits_b) // 8)
            assert np.bitwise_count(u ^ v).sum() <= len(a) + len(b) - 2 * common


def test_sketches_fold_to_smaller_ones():
    r = np.random.default_rng(3)
    elements = r.integers(0, 2**63, 3000, dtype=np.uint64)
    large = pa.array([jaccard._sketch(elements, 4096), jaccard._sketch(elements, 1024)])
    u, v = jaccard._folded(large, 128)
    assert (u == v).all() and len(u) == 16


def test_light_sets_share_a_token_too():
    """All elements in one block: nothing is left in common but empty blocks."""
    blocks = int(0.36 * 8) + 8
    found = [x for x in range(200_000)
             if int(jaccard._mix(np.array([x], np.uint64) + np.uint64(3 * 0x2545F4914F6CDD1D & (1 << 64) - 1))[0]
                    >> np.uint64(32)) % blocks == 0][:6]
    a, b = np.array(found[:5], np.uint64), np.array(found[:4], np.uint64)
    assert set(jaccard.tokens(a, 80)[0].tolist()) & set(jaccard.tokens(b, 80)[0].tolist())


def test_shingles_as_word_tuples():
    texts = ["a b c d e f", "A  B\tc\nd e F", "a b c d e", "a b", "", " \n", "é É x y z w q", "a b c d e f a b c d e f"]
    sizes = [len(jaccard.shingles(t.encode(), 5)) for t in texts]
    assert sizes == [len(shingle_set(t)) for t in texts]
    assert jaccard.shingles(texts[0].encode(), 5).tolist() == jaccard.shingles(texts[1].encode(), 5).tolist()
    long = jaccard.word_hashes(b"x" * 70_000 + b" " + b"x" * 69_999 + b"y")
    assert len(set(long.tolist())) == 2


@pytest.mark.parametrize("seed", [1, 2])
def test_components_by_brute_force(spark, seed):
    texts = corpus(seed)
    docs = plain(spark, texts).repartition(3)
    got = {r.doc_id: (r.n_shingles, r.component_id) for r in jaccard.near_duplicates(docs).collect()}
    want = brute(dict(enumerate(texts)))
    assert got == want
    kept = {r.doc_id for r in jaccard.one_per_group(docs).collect()}
    assert kept == {i for i, (_, low) in want.items() if i == low}


def test_tiles_give_the_same(spark, monkeypatch):
    monkeypatch.setattr(jaccard, "TILE", 3)
    texts = corpus(3)
    got = {r.doc_id: r.component_id for r in jaccard.near_duplicates(plain(spark, texts)).collect()}
    assert got == {i: low for i, (_, low) in brute(dict(enumerate(texts))).items()}


def _counted(monkeypatch):
    """The numbers of pairs that are verified, as a list that fills."""
    sizes, verified = [], jaccard.JaccardJoin._verified

    def count(self, pairs, sets):
        sizes.append(pairs.count())
        return verified(self, pairs, sets)

    monkeypatch.setattr(jaccard.JaccardJoin, "_verified", count)
    return sizes


def test_a_large_group_of_near_copies(spark, monkeypatch):
    """The pairs that are verified grow with the copies of a text, not with their square."""
    r = random.Random(9)
    base = [f"w{r.randrange(400)}" for _ in range(100)]
    texts = []
    for _ in range(160):
        near = list(base)
        for _ in range(r.randrange(4)):
            near[r.randrange(100)] = f"x{r.randrange(10**6)}"
        texts.append(" ".join(near))
    sizes = _counted(monkeypatch)
    got = {x.doc_id: x.component_id for x in jaccard.near_duplicates(plain(spark, texts)).collect()}
    assert got == {i: low for i, (_, low) in brute(dict(enumerate(texts))).items()}
    assert sum(sizes) <= 4 * len(texts)


def test_long_documents_that_share_a_passage(spark, monkeypatch):
    """Sets of 1,500 shingles with a Jaccard of 0.36 are told apart by their sketches."""
    r = random.Random(5)
    passage = [f"p{r.randrange(10**6)}" for _ in range(800)]
    texts = []
    for i in range(60):
        own = [f"o{r.randrange(10**6)}" for _ in range(700)]
        texts.append(" ".join(own[:350] + passage + own[350:]))
        if i % 20 == 0:
            texts.append(texts[-1] + " and more")
    sizes = _counted(monkeypatch)
    got = {x.doc_id: x.component_id for x in jaccard.near_duplicates(plain(spark, texts)).collect()}
    assert got == {i: low for i, (_, low) in brute(dict(enumerate(texts))).items()}
    assert sum(sizes) < 20


def test_components_of_chains_and_loops(spark):
    edges = [(i + 1, i) for i in range(60)] + [(100, 100), (200, 201), (201, 202), (None, 5), (7, 7)]
    got = {r.node: r.label for r in components(spark.createDataFrame(edges, "a long, b long")).collect()}
    assert got == {**{i: 0 for i in range(61)}, 100: 100, 200: 200, 201: 200, 202: 200}
    assert components(spark.createDataFrame([], "a long, b long")).count() == 0


def test_few_rows_take_few_tasks(spark, monkeypatch):
    """The rounds over a small corpus have no more tasks than cores, however the session shuffles."""
    parts = []

    def counted(df, name, write=common.written):
        out = write(df, name)
        parts.append((name, len(out.inputFiles())))
        return out

    monkeypatch.setattr(jaccard, "written", counted)
    monkeypatch.setattr(sys.modules["tallystar.llm.components"], "written", counted)
    old = {k: spark.conf.get(k) for k in ("spark.sql.shuffle.partitions",
                                          "spark.sql.adaptive.coalescePartitions.enabled")}
    try:
        for k, v in zip(old, ("40", "false")):
            spark.conf.set(k, v)
        texts = corpus(4)
        got = {r.doc_id: r.component_id for r in jaccard.near_duplicates(plain(spark, texts)).collect()}
    finally:
        for k, v in old.items():
            spark.conf.set(k, v)
    assert got == {i: low for i, (_, low) in brute(dict(enumerate(texts))).items()}
    assert len(parts) > 10 and max(n for _, n in parts) <= 4


def test_edges(spark):
    docs = documents(spark)
    rows = sorted(((r.doc_id or 0), r.n_shingles, r.component_id) for r in jaccard.near_duplicates(docs).collect())
    assert [r for r in rows if r[0] in (0, 1, 2, 3, 6)] == [
        (0, 7, None), (1, 5, 1), (1, 5, 1), (2, 0, 2), (3, 0, 3), (6, 0, 6)]
    kept = jaccard.one_per_group(docs)
    assert kept.columns == docs.columns and kept.count() == 7
    assert jaccard.near_duplicates(docs.limit(0)).count() == 0
    assert jaccard.one_per_group(docs.limit(0)).count() == 0
    same = [(5, "a b c d e f g", "", "", 0), (None, "a b c d e f g", "", "", 0), (5, "z y x w v u", "", "", 0),
            (4, "z y x w v u", "", "", 0)]
    more = documents(spark, same)
    assert sorted((r.doc_id or 0, r.component_id) for r in jaccard.near_duplicates(more).collect()) == [
        (0, 5), (4, 4), (5, 4), (5, 5)]
    assert sorted((r.doc_id, r.text[0]) for r in jaccard.one_per_group(more).collect()) == [(4, "z"), (5, "a")]

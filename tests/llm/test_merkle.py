"""The manifest against a plain fold of all rows, and its proofs against tampering."""

import hashlib
import random
import zlib

import pytest
from edge import ROWS, SCHEMA, documents

from tallystar.llm import merkle


def H(*parts):
    return hashlib.sha256("".join(parts).encode()).hexdigest()


def leaf(doc):
    doc_id, text, lang, source, n_chars = doc
    return H(*("-" if v is None else f"{len(str(v).encode())}:{v}"
               for v in (doc_id, source, lang, n_chars, text)))


def fold(nodes):
    """The last node and, per leaf, its siblings with their places."""
    paths, where = [[] for _ in nodes], list(range(len(nodes)))
    while len(nodes) > 1:
        for i, at in enumerate(where):
            first = at - at % 3
            run = nodes[first:first + 3]
            paths[i].append((at % 3, run[:at % 3] + run[at % 3 + 1:]))
            where[i] = at // 3
        nodes = [H(*nodes[i:i + 3]) for i in range(0, len(nodes), 3)]
    return nodes[0], paths


def brute(rows):
    sources = {}
    for doc in rows:
        sources.setdefault(doc[3], []).append(doc)
    names = sorted(sources, key=lambda s: (s is not None, (s or "").encode()))
    trees = {}
    for name in names:
        docs = sorted(sources[name], key=lambda d: (d[0] is not None, d[0] or 0, leaf(d)))
        trees[name] = docs, *fold([leaf(d) for d in docs])
    root, above = fold([trees[name][1] for name in names])
    out = []
    for name, outer in zip(names, above):
        docs, subroot, paths = trees[name]
        for doc, path in zip(docs, paths):
            path = path + outer
            shown = doc
            if doc[0] is not None and doc[1] and zlib.crc32(str(doc[0]).encode()) % 2 == 0:
                shown = (doc[0], doc[1].replace("\n", ""), *doc[2:])
            found = leaf(shown)
            for at, others in path:
                found = H(*others[:at], found, *others[at:])
            out.append((doc[0], leaf(doc), subroot, root, H(*(d for _, o in path for d in o)),
                        found, found == root))
    return sorted(out, key=repr)


def found(df, levels=merkle.LEVELS):
    return sorted(map(tuple, merkle.query(df, levels).collect()), key=repr)


COLUMNS = ["doc_id", "leaf", "subroot", "root", "proof_sha256", "folded_root", "verified"]


def test_edge_rows(spark):
    assert merkle.query(documents(spark)).columns == COLUMNS
    assert found(documents(spark)) == brute(ROWS)


@pytest.mark.parametrize("levels", [1, 2, 7])
def test_trees_of_all_heights(spark, levels):
    """Sources of 1 to 90 rows, one with half of all, in superblocks of several sizes."""
    rnd, rows, number = random.Random(levels), [], 2**60
    for size in (1, 2, 3, 4, 9, 10, 27, 28, 90):
        source = rnd.choice([None, "", "é", "z", "-", "="]) if size < 3 else f"src{size}"
        for _ in range(size):
            number += rnd.randrange(1, 5)
            rows.append((number, f"a\nb {number}" if rnd.random() < 0.7 else "plain", "en",
                         source, size))
    rnd.shuffle(rows)
    df = spark.createDataFrame(rows, SCHEMA).repartition(5)
    assert found(df, levels) == brute(rows)


def test_one_row_many_sources_and_none(spark):
    one = [(5, "x\ny", "en", "s", 3)]
    assert found(spark.createDataFrame(one, SCHEMA)) == brute(one)
    many = [(i, f"{i}\n", None, f"s{i:04d}", 1) for i in range(300)]
    assert found(spark.createDataFrame(many, SCHEMA)) == brute(many)
    assert found(spark.createDataFrame([], SCHEMA)) == []


def test_copies_of_one_row(spark):
    same = [(1, "a\nb", "en", "s", 3)] * 40
    assert found(spark.createDataFrame(same, SCHEMA)) == brute(same)


def test_tampering_is_seen(spark):
    rows = [(i, f"line\n{i}" if i % 3 else "no break", "en", "s", 1) for i in range(60)]
    for doc_id, *_, verified in merkle.query(spark.createDataFrame(rows, SCHEMA)).collect():
        touched = zlib.crc32(str(doc_id).encode()) % 2 == 0 and doc_id % 3
        assert verified == (not touched)

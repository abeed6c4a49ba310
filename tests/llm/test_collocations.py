"""Collocations against a plain count of all phrases."""

import random
import re
from collections import Counter

import numpy as np
import pytest
from edge import ROWS, SCHEMA, documents

from tallystar.llm import collocations as col

LOWER = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def brute(rows, least, top=2000, percent=100, longest=5):
    """Result rows of (lang, text) rows."""
    n, f = Counter(), Counter()
    for lang, text in rows:
        lang = "und" if lang is None else lang
        for piece in re.split("[.,;:!?\x0a-\x0d]", (text or "").translate(LOWER)):
            words = re.findall("[^\x20\x09]+", piece)
            n[lang] += len(words)
            f.update((lang, tuple(words[i:i + m])) for m in range(1, longest + 1)
                     for i in range(len(words) - m + 1))
    f = {k: v for k, v in f.items() if v >= least}
    out = []
    for (lang, p), a in f.items():
        if len(p) < 2 or any(la == lang and len(q) > len(p) and 100 * b >= percent * a and any(
                q[i:i + len(p)] == p for i in range(len(q))) for (la, q), b in f.items()):
            continue
        score, _, l, r = min((1000 * a * n[lang] // (f[lang, p[:k]] * f[lang, p[k:]]), k,
                              f[lang, p[:k]], f[lang, p[k:]]) for k in range(1, len(p)))
        out.append((lang, " ".join(p), a, l, r, n[lang], score))
    out.sort(key=lambda x: (x[0], -x[6], -x[2], x[1].encode()))
    ranks = Counter()
    ranked = []
    for lang, *rest in out:
        ranks[lang] += 1
        if ranks[lang] <= top:
            ranked.append((lang, ranks[lang], *rest))
    return sorted(ranked)


def corpus(seed, rows=120):
    r = random.Random(seed)
    words = ["the", "The", "of", "new", "york", "a\x01b", "a", "\x01", "é", "É", "x-y", "zz"]
    phrases = ["New York city hall", "of the", "a\x01b a \x01", "one two three four five six"]
    texts = []
    for _ in range(rows):
        parts = [r.choice(phrases) if r.random() < 0.4 else r.choice(words)
                 for _ in range(r.randrange(30))]
        texts.append((r.choice(["en", "en", "de", None, "und", "a\tb"]),
                      "".join(p + r.choice([" ", " ", "  ", "\t", ". ", "\n", ",", " \x0b"])
                              for p in parts)))
    return texts + [("en", None), (None, ""), ("de", " . \n"), ("only", "rare words here")]


def found(df, **options):
    return sorted(map(tuple, col.collocations(df, **options).collect()))


@pytest.mark.parametrize("seed,least,stretch,ranges", [(1, 3, 200, 20), (2, 8, 10**6, 10**6),
                                                       (3, 2, 50, 7)])
def test_against_brute_force(spark, seed, least, stretch, ranges):
    rows = corpus(seed)
    df = spark.createDataFrame(rows, "lang string, text string").repartition(5)
    assert found(df, min_count=least, stretch_bytes=stretch,
                 range_rows=ranges) == brute(rows, least)


def test_other_parameters(spark):
    rows = corpus(4)
    df = spark.createDataFrame(rows, "lang string, text string")
    assert found(df, min_count=4, top=5) == brute(rows, 4, top=5)
    assert found(df, min_count=4, percent=60) == brute(rows, 4, percent=60)
    assert found(df, min_count=4, max_words=3) == brute(rows, 4, longest=3)


def test_edge_rows_long_texts_and_empty_tables(spark):
    edge = [(r[2], r[1]) for r in ROWS]
    assert found(documents(spark), min_count=40) == brute(edge, 40)
    assert found(spark.createDataFrame([], SCHEMA), min_count=1) == []
    blank = spark.createDataFrame([(1, None, None, None, None), (2, " .\n", "en", "s", 3)], SCHEMA)
    assert found(blank, min_count=1) == []


def test_copies_of_one_text(spark):
    rows = [("en", "one two three four five six seven")] * 700 + [("en", "two three")] * 5
    df = spark.createDataFrame(rows, "lang string, text string").repartition(9)
    assert found(df, stretch_bytes=300, range_rows=3) == brute(rows, 100)


def test_products_beyond_64_bits(spark):
    a, n, left, rest = 9 * 10**15, 8 * 10**15, 9 * 10**15 + 1, 12345
    one = spark.createDataFrame([(a, n, left, rest)], "a long, n long, l long, r long")
    got = one.select((col._whole("a") * col._whole("n") * 1000).alias("above"), "l", "r").selectExpr(
        "above div (cast(l AS decimal(19,0)) * cast(r AS decimal(19,0))) AS score").first()[0]
    assert got == 1000 * a * n // (left * rest)


def test_quicksort_counts_every_prefix():
    r = np.random.default_rng(5)
    keys = np.zeros((400, 4), np.int32)
    for row in keys:
        row[:r.integers(1, 5)] = r.integers(1, 4)
        row[row > 0] = r.integers(1, 4, (row > 0).sum())
    weights = r.integers(1, 5, 400)
    rows, depths, counts = col.multikey_quicksort(keys, weights, 12, np.array([], int))
    got = sorted((tuple(keys[i, :d].tolist()), int(c)) for i, d, c in zip(rows, depths, counts))
    expected = Counter()
    for row, weight in zip(keys.tolist(), weights.tolist()):
        for d in range(1, 5):
            if row[d - 1]:
                expected[tuple(row[:d])] += weight
    assert got == sorted((k, v) for k, v in expected.items() if v >= 12)

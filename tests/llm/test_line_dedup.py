"""Line dedup against a plain count of all lines."""

import hashlib
import random
from collections import defaultdict

import pytest
from edge import CLASHES, ROWS, SCHEMA, documents

from tallystar.llm import line_dedup

BLANK = " \t\n\x0b\x0c\r"
LOWER = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def key(line):
    return line.strip(BLANK).translate(LOWER)


def brute(rows, min_docs=10, min_chars=1):
    """(id, kept text, lines, dropped) of rows (id, text)."""
    held = defaultdict(set)
    for i, (doc_id, text) in enumerate(rows):
        for line in (text or "").split("\n"):
            held[key(line)].add((doc_id, None if doc_id is not None else i))
    out = []
    for doc_id, text in rows:
        lines = (text or "").split("\n")
        kept = [x for x in lines if len(key(x)) < min_chars or len(held[key(x)]) < min_docs]
        out.append((doc_id, "\n".join(kept), len(lines), len(lines) - len(kept)))
    return sorted(out, key=repr)


def found(df, **options):
    out = line_dedup.drop_common_lines(df, **options)
    return sorted(map(tuple, out.select("doc_id", "text", "n_lines", "n_dropped").collect()),
                  key=repr)


@pytest.mark.parametrize("min_docs,min_chars", [(10, 1), (3, 1), (3, 6), (1, 1), (2, 0)])
def test_random_lines(spark, min_docs, min_chars):
    rnd = random.Random(7)
    pool = [" Ähnlich\t", "same LINE", "same line ", "\x0bsame line\r", "", " ", "x", "É", "é",
            " wide ", "漢字", "long " * 300]
    rows = [(rnd.choice([None, i, i, i, i % 7]), "\n".join(
        rnd.choice(pool + [f"own {i}"]) for _ in range(rnd.randrange(12)))) for i in range(80)]
    rows += [(200, None), (201, ""), (202, "\n"), (203, "\n\n")] + [(300, "a\nb")] * 30
    df = spark.createDataFrame(rows, "doc_id long, text string").repartition(6)
    assert found(df, min_docs=min_docs, min_chars=min_chars) == brute(rows, min_docs, min_chars)


def test_edge_rows_and_clashing_columns(spark):
    df = documents(spark)
    for name in ("n_lines", "row", "hash", "doc", "pos"):
        df = df.withColumn(name, df.lang)
    assert found(df, min_docs=2) == brute([r[:2] for r in ROWS], 2)
    out = line_dedup.drop_common_lines(df)
    assert set(CLASHES) <= set(out.columns) and out.columns.count("n_lines") == 1
    assert {r.lang for r in out.collect()} == {r.lang for r in df.collect()}


def test_a_line_of_all_documents(spark):
    rows = [(i, f"head\n{i}\nHEAD \nfoot") for i in range(2000)]
    df = spark.createDataFrame(rows, "doc_id long, text string").repartition(16)
    assert found(df) == brute(rows)


def test_empty_table_and_digest(spark):
    empty = spark.createDataFrame([], SCHEMA)
    assert line_dedup.query(empty).collect() == []
    rows = [(i, f"all\n{i}", "en", "s", 1) for i in range(10)]
    out = {r.doc_id: r for r in line_dedup.query(spark.createDataFrame(rows, SCHEMA)).collect()}
    assert out[3].kept_sha256 == hashlib.sha256(b"3").hexdigest()
    assert (out[3].n_lines, out[3].n_dropped) == (2, 1)

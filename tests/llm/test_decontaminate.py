import random

import numpy as np
import pytest
from edge import documents, plain

from tallystar.llm import decontaminate as dec

WORDS = [a + b + c for a in "bdfgklm" for b in ("an", "et", "iro", "ulo") for c in ("", "s", "ka", "dor")]


def prose(seed, n):
    r = random.Random(seed)
    return " ".join(r.choice(WORDS) for _ in range(n)).capitalize() + "."


def edited(text, edits, seed):
    r = random.Random(seed)
    chars = list(text)
    for _ in range(edits):
        at = r.randrange(len(chars))
        kind = r.randrange(3)
        if kind == 0:
            chars[at] = "x" if chars[at] != "x" else "y"
        elif kind == 1:
            del chars[at]
        else:
            chars.insert(at, "q")
    return "".join(chars)


def distance(pattern, text):
    """Fewest edits with which the pattern occurs in the text, cell by cell."""
    row = list(range(len(pattern) + 1))
    best = row[-1]
    for c in text:
        new = [0]
        for j, p in enumerate(pattern, 1):
            new.append(min(row[j] + 1, new[-1] + 1, row[j - 1] + (p != c)))
        row = new
        best = min(best, row[-1])
    return best


def items(texts, **changed):
    parameters = dict(q=10, window=80, budget=0.0625) | changed
    points = [dec.normalised(t)[0] for t in texts]
    return dec.Items(list(range(len(texts))), points, **parameters).prepare()


def test_normalised_places():
    points, at = dec.normalised("  Ab,\n c-É! ")
    assert "".join(map(chr, points)) == "ab c é" and at.tolist()[:2] == [2, 3]
    assert len(dec.normalised(None)[0]) == len(dec.normalised("?!")[0]) == 0


def test_grams_are_equal_for_equal_text_only():
    points, _ = dec.normalised(prose(1, 400))
    text = "".join(map(chr, points))
    for q in (1, 3, 10, 13):
        seen = {}
        for i, h in enumerate(dec.grams(points, q).tolist()):
            assert seen.setdefault(h, text[i:i + q]) == text[i:i + q]
        assert len(seen) == len({text[i:i + q] for i in range(len(text) - q + 1)})


def test_align_as_cell_by_cell():
    r = random.Random(2)
    for _ in range(40):
        pattern = [r.randrange(3) for _ in range(r.randint(1, 12))]
        text = [r.randrange(3) for _ in range(r.randint(1, 25))]
        found, _ = dec.align(np.array([pattern]), np.array([text]))
        assert found[0] == distance(pattern, text)


def test_no_window_within_the_budget_is_missed():
    bench = [prose(i, 40) for i in range(12)]
    block = items(bench)
    for seed in range(60):
        which = seed % 12
        window = dec.normalised(bench[which])[0][:80]
        leak = edited("".join(map(chr, window)), seed % 6, seed)
        text = f"{prose(100 + seed, 60)} {leak} {prose(300 + seed, 60)}"
        own = "".join(map(chr, dec.normalised(text)[0]))
        within = distance("".join(map(chr, window)), own) <= 5
        assert not within or which in {o[0] for o in block.occurrences(text)}
        assert within


def test_every_reported_stretch_is_within_the_budget():
    bench = [prose(i, 40) for i in range(5)]
    block = items(bench)
    for seed in range(20):
        text = f"{prose(seed + 50, 30)} {edited(bench[seed % 5], seed, seed)} {prose(seed + 80, 30)}"
        for item, start, end, edits in block.occurrences(text):
            stretch = "".join(map(chr, dec.normalised(text[start:end])[0]))
            whole = "".join(map(chr, block.points[item]))
            # A space at either end of the window is no longer there in the stretch alone.
            assert edits <= 5 and edits + 2 >= min(
                distance(whole[a:a + 80], stretch) for a in range(len(whole) - 79))
    assert not any(block.occurrences(prose(s, 300)) for s in range(1000, 1030))


def test_spark_operators(spark, monkeypatch):
    bench = [prose(i, 30) for i in range(6)]
    texts = [prose(500 + i, 50) for i in range(10)]
    texts[3] += " " + bench[2].upper().replace(" ", "\n")
    texts[7] = bench[4]
    docs = plain(spark, texts)
    benchmark = spark.createDataFrame(list(enumerate(bench)), "item_id long, text string")
    want = [(3, 2), (7, 4)]
    assert sorted((r.doc_id, r.item_id) for r in dec.occurrences(docs, benchmark).collect()) == want
    monkeypatch.setattr(dec, "BLOCK_CHARS", 300)               # several blocks, one pass each
    assert len(dec.blocks(benchmark)) > 1
    found = dec.occurrences(docs, benchmark).collect()
    assert sorted((r.doc_id, r.item_id) for r in found) == want
    assert texts[7][found[-1].start:found[-1].end] in texts[7]
    kept = dec.without_benchmark(docs, benchmark)
    assert sorted(r.doc_id for r in kept.collect()) == [0, 1, 2, 4, 5, 6, 8, 9]


def test_edges(spark):
    docs = documents(spark)
    benchmark = spark.createDataFrame([(1, None), (None, "No id here, but some words to read none the less."),
                                       (3, ""), (4, "short")], "item_id long, text string")
    got = dec.occurrences(docs, benchmark).collect()
    assert [(r.doc_id, r.item_id) for r in got] == [(None, None)]
    kept = dec.without_benchmark(docs, benchmark)
    assert kept.columns == docs.columns and kept.count() == 7
    none = dec.occurrences(docs, benchmark.limit(0))
    assert none.count() == 0 and none.columns == ["doc_id", "item_id", "start", "end", "edits"]
    assert dec.occurrences(docs.limit(0), benchmark).count() == 0
    assert dec.without_benchmark(docs, benchmark.limit(0)).count() == 8


@pytest.mark.parametrize("length", [30, 41, 79])
def test_short_items_are_one_window(length):
    item = prose(9, 30)[:length].strip(" .")
    block = items([item])
    assert block.least.min() >= 1 and block.occurrences(f"{prose(1, 9)} {item} {prose(2, 9)}")


def test_of_several_stretches_the_one_of_fewest_edits():
    item = prose(1, 40)[:90].strip()
    block = items([item])
    for copies in ([edited(item, 4, 3), item], [item, edited(item, 4, 3)]):
        text = f"{prose(50, 30)} {copies[0]} {prose(51, 30)} {copies[1]} {prose(52, 30)}"
        (_, start, end, edits), = block.occurrences(text)
        assert edits == 0 and text[start:end].lower() in item.lower()
        assert text.index(item) <= start < end <= text.index(item) + len(item)
        assert len(block.occurrences(text, any_hit=True)) == 1

import random

import pytest
from edge import documents, plain
from pyspark.sql import functions as F

from tallystar.llm import toxicity
from tallystar.llm.toxicity import ToxicityModel, fold

WORDS = [f"{a}{b}{c}" for a in ("ba", "ne", "to", "ru") for b in ("ma", "vi", "so", "ke")
         for c in ("n", "st", "ra", "lo")]


def corpus(n=600, seed=1):
    """Every fifth document insults; in `clownfish tank` the word is harmless."""
    random_ = random.Random(seed)
    texts, labels = [], []
    for i in range(n):
        words = [random_.choice(WORDS) for _ in range(random_.randint(20, 80))]
        toxic = i % 5 == 0
        if toxic:
            words.insert(random_.randrange(len(words)), random_.choice(["zorgfool", "Z0rgf00l", "grumpox"]))
        texts.append(" ".join(words))
        labels.append((i, int(toxic)))
    return texts, labels


def test_fold():
    assert fold("You 1d10t!! $cum ＩＤＩＯＴ idіot ndrea$$$ café 5") == (
        " you idiot scum idiot idiot ndrea café 5 ", 8)
    assert fold(None) == fold("") == fold(" \n") == (" ", 0)
    assert fold("a-b​c") == (" a bc ", 2)


def test_exception_phrases_take_their_match_back():
    model = ToxicityModel({" ciown ": 3.0}, ("ciown fish",), (-3.0, 1.0, 3.0))
    assert model.score("a clown fish swims") < 0.1 < 0.7 < model.score("you clown you clown")
    assert model.score("a clown fish and a clown") > model.score("a clown fish")


def test_learned_scores_hold_out(spark):
    texts, labels = corpus()
    docs = plain(spark, texts)
    known = spark.createDataFrame(labels, "doc_id long, toxic int")
    model = toxicity.learn(docs, known.where("doc_id % 3 != 1"))
    got = {r.doc_id: r.score for r in toxicity.score(docs, model).collect()}
    wrong = [i for i, toxic in labels if (got[i] >= 0.7) != bool(toxic)]
    assert not wrong and all(0 <= s <= 1 for s in got.values())
    kept = {r.doc_id for r in toxicity.without_toxic(docs, model).collect()}
    assert kept == {i for i, toxic in labels if not toxic}


def test_scores_agree_with_a_plain_scan(spark):
    model = ToxicityModel({"zorg": 2.0, " bad ": 1.5, "ad b": 0.5}, ("not bad",), (-2.0, 0.5, 1.0))
    for text in ("zorg bad bad boy", "not bad", "a zorgzorg", "bad b", ""):
        folded, n = fold(text)
        spans = [i for i in range(len(folded)) if folded.startswith(" not bad ", i)]
        total = sum(w for term, w in model.weights.items() for i in range(len(folded))
                    if folded.startswith(term, i)
                    and not any(s <= i and i + len(term) <= s + 9 for s in spans))
        assert model.features(text)[0] == pytest.approx(100 * total / (n + 20))


def test_edges(spark):
    docs = documents(spark)
    none = toxicity.learn(docs, spark.createDataFrame([], "doc_id long, toxic int"))
    assert [r.score for r in toxicity.score(docs, none).collect()] == [0.0] * 8
    model = ToxicityModel({" nothing ": 5.0}, (), (-3.0, 2.0, 2.0))
    got = toxicity.score(docs, model)
    assert got.columns == ["doc_id", "score"] and got.count() == 8
    kept = toxicity.without_toxic(docs, model)
    assert kept.columns == docs.columns and kept.count() == 6
    assert toxicity.score(docs.limit(0), model).count() == 0
    labels = spark.createDataFrame([(None, 1), (1, None), (99, 1), (1, 1), (1, 1)], "doc_id long, toxic int")
    assert toxicity.learn(docs, labels).weights == {}
    assert got.where(F.col("doc_id") == 2).first().score == got.where(F.col("doc_id") == 3).first().score


def test_few_labels_are_enough(spark):
    """Six labelled toxic documents: known insults are found, and a word that only they have."""
    texts, labels = corpus(60)
    marks = ["snarvelik"] * 4 + ["idiot", "Mor0n", "scum", "loser"]
    marks += ["scumbag", "dummkopf", "1diot", "imbécil"]
    for n, i in enumerate(i for i, toxic in labels if toxic):
        words = texts[i].lower().replace("z0rgf00l", "").replace("zorgfool", "").replace("grumpox", "")
        texts[i] = f"{words} {marks[n]}"
    docs = plain(spark, [*texts, "some words and snarvelik among them"])
    known = spark.createDataFrame([(i, t) for i, t in labels if not t or i < 30], "doc_id long, toxic int")
    model = toxicity.learn(docs, known)
    got = {r.doc_id: r.score for r in toxicity.score(docs, model).collect()}
    assert [i for i, toxic in labels if (got[i] >= 0.7) != bool(toxic)] == []
    assert got[60] >= 0.7
    seen = [i for i, toxic in labels if not toxic][:20]
    harmless = toxicity.learn(
        plain(spark, [f"{t} rubbish" if i in seen else t for i, t in enumerate(texts)]), known)
    assert " rubbish " in model.weights and " rubbish " not in harmless.weights


def test_only_toxic_labels(spark):
    docs = plain(spark, ["you idiot and scum", "plain words about nothing", "what a moron", "idiots, all"])
    model = toxicity.learn(docs, spark.createDataFrame([(0, 1), (2, 1)], "doc_id long, toxic int"))
    got = {r.doc_id: r.score >= 0.7 for r in toxicity.score(docs, model).collect()}
    assert got == {0: True, 1: False, 2: True, 3: True}

"""Toxicity: a weighted lexicon matched by Aho-Corasick on folded text.

Texts are folded first: compatibility forms are resolved, accents stay, as they tell words
apart, invisible characters go, look-alike letters of other scripts become Latin, digits and signs that stand for a letter inside a word become
that letter, and i, l, 1, ! and | become one. The lexicon is learned: substrings of folded
words (with their word ends) that labelled toxic documents have far more often than clean
ones; how much is far more is bounded by what the toxic documents of the sample, if few, can
show. Common insults of four languages enter without that proof if a labelled toxic document has
one of them, but not those that clean documents have as well. Exception phrases are learned likewise: a matched term with its neighbouring word, of
which clean documents have several and toxic ones none; a match inside one does not count.
The sum of the matched weights, divided by the document's length, goes through a logistic
curve fitted on the same sample.

Null and empty texts have no match and get the curve's value at 0. Labels that are null, and
labels of unknown documents, teach nothing; without toxic labels the lexicon is empty and
every score is 0. Without clean labels nothing tells words apart, so only the common insults
enter, with a fixed curve. Repeated rows are scored alike.
"""

from __future__ import annotations

import math
import re
import unicodedata
import zlib
from collections.abc import Iterator
from dataclasses import dataclass, field

import ahocorasick
import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tallystar.llm.common import in_batches

# Letters that look like Latin ones, and signs that stand for letters.
HOMOGLYPHS = {
    "а": "a", "в": "b", "е": "e", "к": "k", "м": "m", "н": "h", "о": "o", "р": "p", "с": "c",
    "т": "t", "у": "y", "х": "x", "ѕ": "s", "і": "i", "ј": "j", "ԁ": "d", "ԛ": "q", "ԝ": "w",
    "һ": "h", "ɡ": "g", "ı": "i", "α": "a", "β": "b", "ε": "e", "η": "n", "ι": "i", "κ": "k",
    "ν": "v", "ο": "o", "ρ": "p", "τ": "t", "υ": "u", "χ": "x", "ω": "w", "ł": "l", "ø": "o",
}
SIGNS = {"0": "o", "1": "i", "3": "e", "4": "a", "5": "s", "7": "t", "8": "b", "9": "g",
         "@": "a", "$": "s", "!": "i", "|": "i"}

#: Logarithms of the odds against chance that a whole word and a part of words must have, and
#: the shares of the most that any term of the sample can have which are enough instead.
SURE_WORD, SURE_PART = 12.0, 20.0
ENOUGH_WORD, ENOUGH_PART = 0.3, 0.5

#: Common insults of four languages, which need no proof where labelled toxic
#: documents have any of them, the least weight of one, and the curve without clean documents.
SEEDS = """
arsehole asshole bastard bitch clown coward creep cretin crybaby cunt degenerate despicable
dickhead dimwit disgrace disgusting dumb dumbass fool freak garbage halfwit hypocrite idiot idiotic
idiots imbecile jerk liar loser losers lowlife lunatic maggot moron moronic morons motherfucker
nitwit pathetic prick retarded rubbish scoundrel scum scumbag shithead
simpleton slut stupid swine thug traitor trash twat ugly vermin wanker weirdo whore wimp worthless
abschaum arsch arschloch blödmann dreckig dummkopf dumm ekelhaft erbärmlich feigling
hurensohn idioten lügner miststück nutte schlampe schwachkopf schwein trottel versager vollidiot
wertlos wichser widerlich
abruti bâtard connard connasse crétin débile dégoûtant enculé imbécile menteur minable
ordure pitoyable pourriture raclure salaud salope stupide
asqueroso basura bastardo cabrón cobarde escoria estúpido gilipollas hijoputa idiota imbécil
mentiroso patético pendejo perdedor puta repugnante tonto
""".split()
SEED_WEIGHT, SEED_CURVE = 3.0, (-5.0, 3.0, 0.5)

_SIGN_RUN = re.compile(r"(?:(?<=[^\W\d_])|(?<![\w@$!|])(?=[0134578@$]))[01345789@$!|]+(?=[^\W\d_])")
_SIGN_MAP = str.maketrans(SIGNS)
_BREAKS = ({c: " " for c in range(128) if not chr(c).isalnum()}
           | {c: " " for c in (*range(0x2000, 0x200B), *range(0x2010, 0x2070), 0xA0, 0xA1, 0xAB,
                               0xBB, 0xBF, 0x3000, 0x3001, 0x3002)})
_DROPPED = {c: None for c in (*range(0x300, 0x370), 0xAD, *range(0x200B, 0x2010), 0x2060, 0xFEFF)}
_LETTERS = {ord(c): v.replace("l", "i") for c, v in HOMOGLYPHS.items()} | {ord("l"): "i"}
_FOLD = _BREAKS | _DROPPED | _LETTERS


#: Entries after which a task's table of folded words is begun anew: bounds its memory only.
CACHE_WORDS = 500_000
_folded: dict[str, str] = {}


def _fold_word(word: str) -> str:
    if not word.isascii():
        word = unicodedata.normalize("NFKC", word).translate(_DROPPED)
    word = _SIGN_RUN.sub(lambda m: m[0].translate(_SIGN_MAP), word.lower())
    return " ".join(word.translate(_FOLD).split())


def fold(text: str | None) -> tuple[str, int]:
    """The folded words with a space before, between and after them, and their number.

    What stands between white space is folded alone, so folded words can be kept.
    """
    words = text.split() if text else []
    missing = set(words).difference(_folded)
    if len(_folded) + len(missing) > CACHE_WORDS:
        forget()
        missing = set(words)
    _folded.update((w, _fold_word(w)) for w in missing)
    joined = " ".join(filter(None, map(_folded.__getitem__, words)))
    return (f" {joined} ", joined.count(" ") + 1) if joined else (" ", 0)


def forget() -> None:
    """Drop the folded words at a task's end: a worker stays, and would hold them beside other
    stages. Functions that are sent to tasks must call this, as they get copies of plain globals."""
    _folded.clear()


@dataclass(frozen=True)
class ToxicityModel:
    """Weights by folded term, exception phrases, and the logistic curve over two features."""

    weights: dict[str, float]
    exceptions: tuple[str, ...] = ()
    curve: tuple[float, float, float] = (-4.0, 0.0, 0.0)
    _matcher: list = field(default_factory=list, compare=False, repr=False)

    def __getstate__(self):
        return {**self.__dict__, "_matcher": []}

    def matcher(self):
        if not self._matcher:
            automaton = ahocorasick.Automaton()
            for term, weight in self.weights.items():
                automaton.add_word(term, (len(term), weight))
            for phrase in self.exceptions:
                automaton.add_word(f" {phrase} ", (len(phrase) + 2, None))
            automaton.make_automaton()
            self._matcher.append(automaton)
        return self._matcher[0]

    def matches(self, folded: str) -> list[tuple[int, int, float]]:
        """(start, end, weight) of the terms that lie in no exception phrase."""
        if not self.weights:
            return []
        found = [(end + 1 - n, end + 1, w) for end, (n, w) in self.matcher().iter(folded)]
        if self.exceptions and any(w is None for *_, w in found):
            spans = [(a, b) for a, b, w in found if w is None]
            found = [m for m in found
                     if m[2] is not None and not any(a <= m[0] and m[1] <= b for a, b in spans)]
        return found

    def features(self, text: str | None) -> tuple[float, float]:
        """Matched weight per 100 words, and the logarithm of the matched weight."""
        folded, words = fold(text)
        total = sum(m[2] for m in self.matches(folded))
        return 100.0 * total / (words + 20.0), math.log1p(total)

    def score(self, text: str | None) -> float:
        if not self.weights:
            return 0.0
        per_length, size = self.features(text)
        z = self.curve[0] + self.curve[1] * math.log1p(per_length) + self.curve[2] * size
        return 1.0 / (1.0 + math.exp(-max(-60.0, min(60.0, z))))


def _fit_curve(rows: list[tuple[float, float, int]]) -> tuple[float, float, float]:
    """Logistic regression by Newton steps, with a small ridge so that separable rows converge."""
    x = np.array([(1.0, math.log1p(a), b) for a, b, _ in rows])
    y = np.array([c for *_, c in rows], float)
    beta, ridge = np.zeros(3), np.diag([1e-3, 1e-2, 1e-2])
    for _ in range(50):
        p = 1 / (1 + np.exp(-np.clip(x @ beta, -30, 30)))
        step = np.linalg.solve((x * (p * (1 - p))[:, None]).T @ x + ridge,
                               x.T @ (y - p) - ridge @ beta)
        beta += np.clip(step, -5, 5)
        if np.abs(step).max() < 1e-6:
            break
    return tuple(map(float, beta))


def _signature(words: list[str], seed: int) -> int:
    """The smallest hash of the three-word runs: near copies mostly share it."""
    runs = [" ".join(words[i:i + 3]) for i in range(max(1, len(words) - 2))]
    return min(zlib.crc32(r.encode(), seed) for r in runs)


def _folded_sample(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        folded = [fold(t.as_py())[0] for t in batch.column("_text")]
        words = [f.split() for f in folded]
        yield pa.RecordBatch.from_arrays(
            [pa.array(folded, pa.string()), batch.column("_toxic"),
             *(pa.array([_signature(w, seed) for w in words], pa.int64()) for seed in (1, 2))],
            ["folded", "toxic", "sig1", "sig2"])
    forget()


def learn(docs: DataFrame, labels: DataFrame, *, id_col: str = "doc_id", text_col: str = "text",
          label_col: str = "toxic", sample_toxic: int = 2500, sample_clean: int = 7500,
          max_terms: int = 4000, min_docs: int = 4, min_log_odds: float = 2.0,
          max_exceptions: int = 1000) -> ToxicityModel:
    """Fit the model on a bounded sample of the labelled documents.

    At most `sample_toxic` and `sample_clean` labelled documents are used, those whose hashed
    ids are smallest; near copies among them count once. `max_terms` and `max_exceptions`
    bound the model, not the scored texts.
    """
    seen = (labels.select(F.col(id_col).alias("_id"), F.col(label_col).cast("int").alias("_toxic"))
            .where("_id IS NOT NULL AND _toxic IS NOT NULL")
            .groupBy("_id").agg(F.max("_toxic").alias("_toxic")))
    texts = docs.select(F.col(id_col).alias("_id"), F.col(text_col).alias("_text"))
    by_hash = (F.xxhash64("_id"), F.col("_id"))
    chosen = (seen.where("_toxic > 0").orderBy(*by_hash).limit(sample_toxic)
              .unionByName(seen.where("_toxic = 0").orderBy(*by_hash).limit(sample_clean)))
    rows = (texts.join(F.broadcast(chosen), "_id")             # bounded by the two parameters
            .groupBy("_id").agg(F.max("_toxic").alias("_toxic"), F.min("_text").alias("_text")))
    sample = (in_batches(rows, _folded_sample, "folded string, toxic int, sig1 long, sig2 long")
              .dropDuplicates(["sig1"]).dropDuplicates(["sig2"]).persist())
    try:
        sizes = {r.toxic: r["count"] for r in sample.groupBy("toxic").count().collect()}
        n_toxic, n_clean = sizes.get(1, 0), sizes.get(0, 0)
        if not n_toxic:
            return ToxicityModel({})
        weights = _terms(sample, n_toxic, n_clean, max_terms, min_docs, min_log_odds)
        plain = ToxicityModel(weights)
        exceptions = _exceptions(sample, plain, max_exceptions) if weights else ()
        model = ToxicityModel(weights, exceptions)
        return ToxicityModel(weights, exceptions, _fit_curve(_sample_features(sample, model))
                             if n_clean else SEED_CURVE)
    finally:
        sample.unpersist()


def _terms(sample: DataFrame, n_toxic: int, n_clean: int, max_terms: int, min_docs: int,
           min_log_odds: float) -> dict[str, float]:
    """Substrings of words with their log odds; none contains or lies in a surer one."""
    words = (sample.select("toxic", F.explode(F.array_distinct(
                F.split(F.trim("folded"), " "))).alias("word"))
             .where(F.length("word").between(2, 40))
             .groupBy("word").agg(F.sum("toxic").alias("t"), F.sum(1 - F.col("toxic")).alias("c"))
             .withColumn("word", F.concat(F.lit(" "), F.col("word"), F.lit(" "))))
    grams = F.expr("""array_distinct(flatten(transform(sequence(4, least(9, length(word))), k ->
        transform(sequence(1, length(word) - k + 1), i -> substring(word, i, k)))))""")
    likely = words.where((F.col("t") * max(n_clean, 1)) > (F.col("c") * n_toxic * 4)
                         ).select(F.explode(grams).alias("term"), "t")
    least = max(min_docs, math.ceil(0.004 * n_toxic))
    # Documents with the term, and how surely so many of them are not toxic by chance: the
    # logarithm of Chernoff's bound, which whole words, being fewer, need not pass as far.
    n, p = F.col("t") + F.col("c"), n_toxic / (n_toxic + n_clean)
    share = F.col("t") / n
    surely = n * (share * F.log(share / p) + F.when(share < 1, (1 - share) * F.log(
        (1 - share) / (1 - p))).otherwise(0.0)) if n_clean else F.lit(0.0)
    # Few toxic documents cannot make any term that sure: then a share of the most is enough.
    most = -n_toxic * math.log(p)
    whole = F.col("term").startswith(" ") & F.col("term").endswith(" ")
    sure = F.lit(bool(n_clean)) & (surely >= F.when(whole, min(SURE_WORD, ENOUGH_WORD * most))
                                   .otherwise(min(SURE_PART, ENOUGH_PART * most)))
    frequent = (likely.groupBy("term").agg(F.sum("t").alias("t")).where(F.col("t") >= least)
                .orderBy(F.desc("t"), "term").limit(20 * max_terms).select("term"))
    found = (words.select(F.explode(grams).alias("term"), "t", "c")
             .join(F.broadcast(frequent), "term", "left_semi")  # at most 20 * max_terms strings
             .groupBy("term").agg(F.sum("t").alias("t"), F.sum("c").alias("c"))
             .withColumn("odds", F.log((F.col("t") + 0.5) / (n_toxic + 1.0))
                         - F.log((F.col("c") + 0.5) / (n_clean + 1.0)))
             .where((F.col("t") >= least) & (F.col("odds") >= min_log_odds) & sure)
             .orderBy(F.desc(F.round(surely, 1)), F.desc(F.length("term")), "term")
             .limit(5 * max_terms).collect())
    kept: dict[str, float] = {}
    for row in found:
        if len(kept) < max_terms and not any(k in row.term or row.term in k for k in kept):
            kept[row.term] = float(row.odds)
    seeds = {f" {_fold_word(w)} ": (0, 0) for w in SEEDS}
    seeds |= {r.word: (r.t, r.c) for r in words.where(F.col("word").isin(list(seeds))).collect()}
    if any(t for t, _ in seeds.values()):
        for term, (t, c) in seeds.items():
            odds = math.log((t + 0.5) / (n_toxic + 1.0)) - math.log((c + 0.5) / (n_clean + 1.0))
            if (not c or odds >= min_log_odds) and len(kept) < max_terms and not any(
                    k in term or term in k for k in kept):
                kept[term] = max(odds, SEED_WEIGHT)
    return kept


def _exceptions(sample: DataFrame, model: ToxicityModel, most: int) -> tuple[str, ...]:
    """Matched words with a neighbour, which clean documents have at least thrice, toxic never."""
    def contexts(batches):
        for batch in batches:
            out = set()
            for i, (text, toxic) in enumerate(zip(batch.column("folded").to_pylist(),
                                                  batch.column("toxic").to_pylist())):
                for start, end, _ in model.matches(text):
                    left = text.rfind(" ", 0, start + 1)
                    right = text.find(" ", max(end - 1, left + 1))
                    word = text[left + 1:right]
                    before = text[text.rfind(" ", 0, max(left, 0)) + 1:max(left, 0)]
                    after = text[right + 1:].split(" ", 1)[0] if right >= 0 else ""
                    out |= {(i, toxic, f"{before} {word}")} if before else set()
                    out |= {(i, toxic, f"{word} {after}")} if after else set()
            yield pa.RecordBatch.from_arrays(
                [pa.array([p for *_, p in out], pa.string()),
                 pa.array([t for _, t, _ in out], pa.int32())], ["phrase", "toxic"])

    found = (in_batches(sample.select("folded", "toxic"), contexts, "phrase string, toxic int")
             .groupBy("phrase").agg(F.sum("toxic").alias("t"), F.count("*").alias("n"))
             .where("t = 0 AND n >= 3").orderBy(F.desc("n"), "phrase").limit(most).collect())
    return tuple(r.phrase for r in found)


def _sample_features(sample: DataFrame, model: ToxicityModel) -> list[tuple[float, float, int]]:
    def measured(batches):
        for batch in batches:
            values = [model.features(t) for t in batch.column("folded").to_pylist()]
            yield pa.RecordBatch.from_arrays(
                [pa.array([a for a, _ in values], pa.float64()),
                 pa.array([b for _, b in values], pa.float64()), batch.column("toxic")],
                ["a", "b", "toxic"])
        forget()

    rows = in_batches(sample.select("folded", "toxic"), measured, "a double, b double, toxic int")
    return [(r.a, r.b, r.toxic) for r in rows.collect()]        # one row per sampled document


def score(docs: DataFrame, model: ToxicityModel, *, id_col: str = "doc_id",
          text_col: str = "text") -> DataFrame:
    """(id, score) per row; other columns are not read."""
    held = docs.sparkSession.sparkContext.broadcast(model)      # bounded by max_terms

    def scored(batches):
        for batch in batches:
            yield pa.RecordBatch.from_arrays(
                [batch.column(0),
                 pa.array([held.value.score(t.as_py()) for t in batch.column(1)], pa.float64())],
                ["id", "score"])
        forget()

    kind = docs.schema[id_col].dataType.simpleString()
    texts = docs.select(F.col(id_col).alias("id"), F.col(text_col).alias("text"))
    return (in_batches(texts, scored, f"id {kind}, score double")
            .select(F.col("id").alias(id_col), "score"))


def without_toxic(docs: DataFrame, model: ToxicityModel, *, text_col: str = "text",
                  threshold: float = 0.7) -> DataFrame:
    """The rows, with all their columns, whose text scores below the threshold."""
    held, at = docs.sparkSession.sparkContext.broadcast(model), docs.columns.index(text_col)

    def kept(batches):
        for batch in batches:
            yield batch.filter(pa.array(
                [held.value.score(t.as_py()) < threshold for t in batch.column(at)], pa.bool_()))
        forget()

    return in_batches(docs, kept, docs.schema)

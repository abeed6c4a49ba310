"""Phrase collocation mining by multikey three-way quicksort of suffix pointers.

A text is lower-cased (A-Z), cut into pieces at `[.,;:!?\\x0A-\\x0D]` and these into words
`[^\\x20\\x09]+`. Every word begins a suffix, of which the first `max_words` words of its piece
matter. Counts and scores are per language (null: `und`).

1. Pairs of neighbouring words are counted by 64-bit hashes. Those that are frequent set bits in
   a filter of fixed size. A hash stands for at least the count of each pair that has it, so the
   filter may let an infrequent pair pass, but never stops a frequent one.
2. Suffixes are cut at pairs that the filter stops, equal ones of a task become one pointer with
   a weight, and pointers are routed by their leading words: ranges of the words' text, whose
   bounds Spark finds, so that many suffixes with one leading word fill many ranges.
3. In each range, multikey three-way quicksort splits the pointers word by word down to
   `max_words`. The weight of an equal partition is the count of the phrase that its pointers
   share; a partition below the minimum is abandoned. Only the partitions that hold the first
   or the last pointer of a range may go on in its neighbours: they are never abandoned, and
   their parts are added up afterwards.
4. Cuts are scored, and phrases that only stand inside a longer one are dropped, by joins of
   the frequent phrases.

All counts are of words themselves; hashes only decide what is abandoned early. Null and empty
texts have no words. Repeated rows count as often as they are there. Other columns are not read.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import xxhash
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tallystar.llm.common import in_batches, written

#: Bytes of text that are worked on at once, and pointers within which equal ones meet before
#: they are sent: these bound a task's memory.
STRETCH_BYTES, HELD_ROWS = 3_000_000, 600_000
#: Pointers of one range: bounds a task's memory.
RANGE_ROWS = 400_000
#: Bits of the filter of frequent pairs: 16 MB whatever the corpus.
FILTER_BITS = 1 << 27

_WORD, _BREAK = 0, 2
_KIND = np.zeros(256, np.uint8)
_KIND[[0x20, 0x09]] = 1
_KIND[[*b".,;:!?", *range(0x0A, 0x0E)]] = _BREAK
_LOWER = np.arange(256, dtype=np.uint8)
_LOWER[65:91] += 32


def _mix(x: np.ndarray) -> np.ndarray:
    x = (x ^ (x >> np.uint64(33))) * np.uint64(0xFF51AFD7ED558CCD)
    x = (x ^ (x >> np.uint64(33))) * np.uint64(0xC4CEB9FE1A85EC53)
    return x ^ (x >> np.uint64(33))


def _pair_keys(first: np.ndarray, second: np.ndarray) -> np.ndarray:
    return _mix(first * np.uint64(0x9FB21C651E98DF25) + second)


class Words:
    """The words of a stretch of texts: their number in a dictionary, language and piece."""

    def __init__(self, langs: list[str], texts: list[bytes | None]):
        texts = [t or b"" for t in texts]
        data = np.frombuffer(b"\n".join(texts), np.uint8)
        kind = _KIND[data]
        inside = np.zeros(len(data) + 2, np.int8)
        inside[1:-1] = kind == _WORD
        edges = np.flatnonzero(np.diff(inside))
        starts, ends = edges[0::2], edges[1::2]
        offsets = np.concatenate([[0], np.cumsum(ends - starts)]).astype(np.int32)
        packed = pa.BinaryArray.from_buffers(pa.binary(), len(starts), [
            None, pa.py_buffer(offsets), pa.py_buffer(_LOWER[data[kind == _WORD]])])
        encoded = packed.dictionary_encode()
        self.names = encoded.dictionary.cast(pa.string())
        self.word = encoded.indices.to_numpy().astype(np.int64)
        # \n between texts is a break too: pieces end with their text.
        piece = np.searchsorted(np.flatnonzero(kind == _BREAK), starts)
        self.follows = piece[1:] == piece[:-1]          # whether a word's successor is its piece's
        begins = np.cumsum([0] + [len(t) + 1 for t in texts[:-1]])
        known: dict[str, int] = {}
        codes = np.array([known.setdefault(x, len(known)) for x in langs], np.int64)
        self.langs = list(known)
        self.lang = codes[np.searchsorted(begins, starts, "right") - 1]
        named = np.array([xxhash.xxh64_intdigest(w) for w in encoded.dictionary.to_pylist()],
                         np.uint64)
        salts = np.array([xxhash.xxh64_intdigest(x.encode(), 1) for x in self.langs], np.uint64)
        self.key = _mix(named[self.word] + salts[self.lang]) if len(starts) else named


def _stretches(batches: Iterator[pa.RecordBatch], most: int) -> Iterator[Words]:
    langs, texts, size = [], [], 0
    for batch in batches:
        for lang, text in zip(batch.column("lang").to_pylist(), batch.column("text")):
            langs.append(lang)
            texts.append(text.as_py())
            size += len(texts[-1] or b"") + 1
            if size >= most:
                yield Words(langs, texts)
                langs, texts, size = [], [], 0
    if texts:
        yield Words(langs, texts)


def _counted_keys(stretch_bytes: int):
    """(lang, key, count): the words per language, and the pairs by their hashes."""
    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for words in _stretches(batches, stretch_bytes):
            totals = np.bincount(words.lang, minlength=len(words.langs))
            before = np.flatnonzero(words.follows)
            joint, pairs = np.unique(_pair_keys(words.key[before], words.key[before + 1]),
                                     return_counts=True)
            for langs, keys, counts in ((words.langs, np.zeros(len(words.langs), np.int64), totals),
                                        (None, joint.view(np.int64), pairs)):
                yield pa.RecordBatch.from_arrays(
                    [pa.array(langs, pa.string()) if langs is not None
                     else pa.nulls(len(keys), pa.string()), pa.array(keys), pa.array(counts)],
                    ["lang", "key", "n"])

    return count


def _filter(keys: DataFrame) -> np.ndarray:
    """The bits of the keys; at most FILTER_BITS / 64 rows reach the driver."""
    bits = np.zeros(FILTER_BITS // 64, np.int64)
    place = F.expr(f"key & {FILTER_BITS - 1}")
    masks = (keys.select(F.shiftright(place, 6).alias("word"),
                         F.expr("shiftleft(1L, cast(key & 63 AS int))").alias("bit"))
             .groupBy("word").agg(F.bit_or("bit").alias("mask")).toArrow())
    bits[masks["word"].to_numpy()] = masks["mask"].to_numpy()
    return bits


def _passes(bits: np.ndarray, keys: np.ndarray) -> np.ndarray:
    place = (keys & np.uint64(FILTER_BITS - 1)).astype(np.int64)
    return ((bits[place >> 6] >> (place & 63)) & 1).astype(bool)


def _pointers(bits: np.ndarray, max_words: int, words: Words) -> pa.RecordBatch:
    """(lang, suffix, n): distinct suffixes up to where the filter stops them, with weights.

    The words of a suffix end with a tab each, so all suffixes with the same first words stand
    next to each other in the order of their text.
    """
    n = len(words.word)
    start = np.arange(n)
    joined = np.zeros(n + max_words, bool)
    joined[:max(0, n - 1)] = words.follows
    joined[:max(0, n - 1)] &= _passes(bits, _pair_keys(words.key[:-1], words.key[1:]))
    depth = np.ones(len(start), np.int64)
    width = max(1, len(words.names))
    group = words.lang[start] * width + words.word[start]
    free = len(words.langs) * width
    going = np.arange(len(start))
    for j in range(1, max_words):
        going = going[joined[start[going] + j - 1]]
        depth[going] += 1
        known, again = np.unique(group[going] * width + words.word[start[going] + j],
                                 return_inverse=True)
        # Small numbers again, and others than those of suffixes that ended before.
        group[going] = free + again
        free += len(known)
    _, first, weight = np.unique(group, return_index=True, return_counts=True)
    start, depth = start[first], depth[first]
    order = np.argsort(depth, kind="stable")
    start, weight, sizes = start[order], weight[order], np.bincount(depth, minlength=max_words + 1)
    texts, a = [], 0
    for d in range(1, max_words + 1):
        b = a + int(sizes[d])
        columns = [words.names.take(pa.array(words.word[start[a:b] + j])) for j in range(d)]
        texts.append(pc.binary_join_element_wise(*columns, pa.scalar(""), "\t"))
        a = b
    return pa.RecordBatch.from_arrays(
        [pa.array(words.langs, pa.string()).take(pa.array(words.lang[start])),
         pa.concat_arrays(texts), pa.array(weight)], ["lang", "suffix", "n"])


def _merged(held: list[pa.RecordBatch]) -> pa.Table:
    """The pointers with equal ones added up."""
    sums = pa.Table.from_batches(held).group_by(["lang", "suffix"]).aggregate([("n", "sum")])
    return sums.rename_columns({"n_sum": "n"}).select(["lang", "suffix", "n"])


def multikey_quicksort(keys: np.ndarray, weights: np.ndarray, least: int, open_rows: np.ndarray
                       ) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(row, depth, weight) of the equal partitions of weight `least` or more, at every depth.

    `keys` has a row per pointer and a column per depth, 0 where a pointer has ended. All open
    partitions are split at once, each by the median of three as its pivot, into smaller, equal
    and greater pointers; equal ones go one deeper. Partitions below `least` are abandoned,
    unless they hold a row of `open_rows`. A partition is named by one of its rows.
    """
    found: list[tuple[np.ndarray, np.ndarray, np.ndarray]] = []
    opened = np.zeros(len(keys), np.int64)
    opened[open_rows] = 1
    rows = np.arange(len(keys))
    sizes, depths = np.array([len(keys)]), np.array([0])
    while len(rows):
        starts = np.cumsum(sizes) - sizes
        owner = np.repeat(np.arange(len(sizes)), sizes)
        value = keys[rows, depths[owner]]
        three = np.stack([value[starts], value[starts + sizes // 2], value[starts + sizes - 1]])
        pivot = np.sort(three, 0)[1]
        side = 1 + (value > pivot[owner]).astype(np.int64) - (value < pivot[owner])
        counts = np.bincount(owner * 3 + side, minlength=3 * len(sizes))
        base = np.cumsum(counts) - counts
        moved = np.empty_like(rows)
        for s in range(3):
            at, per = np.flatnonzero(side == s), counts[s::3]
            moved[np.arange(len(at)) + np.repeat(base[s::3] - (np.cumsum(per) - per), per)] = rows[at]
        full = np.flatnonzero(counts)
        sizes, base = counts[full], base[full]
        weight = np.add.reduceat(weights[moved], base)
        keep = (weight >= least) | (np.add.reduceat(opened[moved], base) > 0)
        equal, depths = full % 3 == 1, depths[full // 3]
        keep &= ~equal | (pivot[full // 3] != 0)          # pointers that ended are done
        named = keep & equal
        found.append((moved[base[named]], depths[named] + 1, weight[named]))
        depths = depths + equal
        keep &= depths < keys.shape[1]
        rows = moved[np.repeat(keep, sizes)]
        sizes, depths = sizes[keep], depths[keep]
    return tuple(np.concatenate(x) for x in zip(*found)) if found else (rows, rows, rows)


def _sorted_range(least: int, max_words: int):
    """(lang, phrase, words, n) of a range's phrases: the frequent ones and those at its ends."""
    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held = [b for b in batches if b.num_rows]
        if not held:
            return
        table = pa.Table.from_batches(held).combine_chunks()
        lang, suffix = table["lang"].chunk(0).dictionary_encode(), table["suffix"].chunk(0)
        weights = table["n"].to_numpy()
        ends = [pc.min_max(lang.dictionary)[k].as_py() for k in ("min", "max")]
        rows = []
        for name, k in zip(ends, ("min", "max")):
            inside = pc.equal(table["lang"].chunk(0), name)
            text = pc.min_max(suffix.filter(inside))[k]
            rows.append(pc.index(pc.and_(inside, pc.equal(suffix, text)), True).as_py())
        parts = pc.split_pattern(suffix, "\t")            # the last part is empty
        flat = parts.flatten().dictionary_encode()
        empty = pc.index(flat.dictionary, "").as_py()
        number = flat.indices.to_numpy()
        number = np.where(number == empty, 0, np.where(number < empty, number + 1, number))
        offsets = parts.offsets.to_numpy() - parts.offsets[0].as_py()
        keys = np.zeros((len(suffix), max_words + 1), np.int32)
        keys[:, 0] = lang.indices.to_numpy() + 1
        row = np.repeat(np.arange(len(suffix)), np.diff(offsets))
        depth = np.arange(len(number)) - np.repeat(offsets[:-1], np.diff(offsets)) + 1
        inside = depth <= max_words
        keys[row[inside], depth[inside]] = number[inside]
        row, depth, n = multikey_quicksort(keys, weights, least, np.array(rows))
        row, words, n = row[depth > 1], depth[depth > 1] - 1, n[depth > 1]
        for a in range(0, len(row), 100_000):
            here = slice(a, a + 100_000)
            texts = suffix.take(pa.array(row[here])).to_pylist()
            phrases = [" ".join(t.split("\t", k)[:k]) for t, k in zip(texts, words[here].tolist())]
            yield pa.RecordBatch.from_arrays(
                [lang.dictionary.take(pa.array(lang.indices.to_numpy()[row[here]])),
                 pa.array(phrases, pa.string()), pa.array(words[here].astype(np.int32)),
                 pa.array(n[here].astype(np.int64))], ["lang", "phrase", "words", "n"])

    return count


def frequent_phrases(docs: DataFrame, *, text_col: str = "text", lang_col: str = "lang",
                     max_words: int = 5, min_count: int = 100, stretch_bytes: int = STRETCH_BYTES,
                     range_rows: int = RANGE_ROWS) -> tuple[DataFrame, DataFrame]:
    """((lang, phrase, words, n) of all frequent phrases, (lang, n) of all words)."""
    spark = docs.sparkSession
    texts = docs.select(F.coalesce(F.col(lang_col).cast("string"), F.lit("und")).alias("lang"),
                        F.col(text_col).cast("binary").alias("text"))
    counted = in_batches(texts, _counted_keys(stretch_bytes), "lang string, key long, n long")
    keys = written(counted.groupBy("lang", "key").agg(F.sum("n").alias("n"))
                   .where((F.col("n") >= min_count) | F.col("lang").isNotNull()), "keys")
    held = spark.sparkContext.broadcast(_filter(keys.where("lang IS NULL").select("key")))

    def suffixes(batches):
        met, rows = [], 0
        for words in _stretches(batches, stretch_bytes):
            if len(words.word):
                met.append(_pointers(held.value, max_words, words))
                rows += met[-1].num_rows
            if rows >= HELD_ROWS:
                merged = _merged(met)
                met, rows = merged.to_batches(), merged.num_rows
                if 2 * rows >= HELD_ROWS:                # too many are different
                    yield from met
                    met, rows = [], 0
        if met:
            yield from _merged(met).to_batches()

    pointers = written(in_batches(texts, suffixes, "lang string, suffix string, n long"),
                       "pointers")
    ranges = max(int(spark.conf.get("spark.sql.shuffle.partitions")),
                 -(-pointers.count() // range_rows))
    parts = in_batches(pointers.repartitionByRange(ranges, "lang", "suffix"),
                       _sorted_range(min_count, max_words),
                       "lang string, phrase string, words int, n long")
    phrases = (parts.groupBy("lang", "phrase", "words").agg(F.sum("n").alias("n"))
               .where(F.col("n") >= min_count))
    return (written(phrases, "phrases"),
            written(keys.where("lang IS NOT NULL").select("lang", "n"), "totals"))


def _whole(column: str) -> Column:
    """A count as a decimal, so that products pass 64 bits."""
    return F.col(column).cast("decimal(19,0)")


def collocations(docs: DataFrame, *, text_col: str = "text", lang_col: str = "lang",
                 max_words: int = 5, min_count: int = 100, top: int = 2000, percent: int = 100,
                 stretch_bytes: int = STRETCH_BYTES, range_rows: int = RANGE_ROWS) -> DataFrame:
    """(lang, rank, phrase, a, l, r, n, score): each language's first `top` phrases.

    A phrase of `a` occurrences, cut into parts of `l` and `r`, scores floor(1000 a n / (l r));
    its lowest-scoring cut counts (ties: the first). Phrases inside a longer one that has at
    least `percent` of their occurrences are dropped. Ties in score and `a` go by the phrase.
    """
    phrases, totals = frequent_phrases(
        docs, text_col=text_col, lang_col=lang_col, max_words=max_words, min_count=min_count,
        stretch_bytes=stretch_bytes, range_rows=range_rows)
    several = phrases.where("words > 1").withColumnRenamed("n", "a")
    # A phrase within a longer one is within one that is longer by a word and as frequent.
    inner = (several.where("words > 2").select("lang", "a", F.explode(F.array(
        F.expr("substring_index(phrase, ' ', words - 1)"),
        F.expr("substring_index(phrase, ' ', 1 - words)"))).alias("phrase"))
        .groupBy("lang", "phrase").agg(F.max("a").alias("longer")))
    own = several.join(inner, ["lang", "phrase"], "left").where(
        F.col("longer").isNull() | (100 * F.col("longer") < percent * F.col("a")))
    cuts = own.join(totals, "lang").select("lang", "phrase", "words", "a", "n", F.explode(
        F.sequence(F.lit(1), F.col("words") - 1)).alias("k")).select(
        "lang", "phrase", "a", "n", "k", F.expr("substring_index(phrase, ' ', k)").alias("left"),
        F.expr("substring_index(phrase, ' ', k - words)").alias("rest"))
    left = phrases.select("lang", F.col("phrase").alias("left"), F.col("n").alias("l"))
    rest = phrases.select("lang", F.col("phrase").alias("rest"), F.col("n").alias("r"))
    parts = cuts.join(left, ["lang", "left"]).join(rest, ["lang", "rest"])
    parts = parts.withColumn("above", F.lit(1000).cast("decimal(4,0)") * _whole("a") * _whole("n"))
    scored = parts.withColumn("score", F.expr(
        "above div (cast(l AS decimal(19,0)) * cast(r AS decimal(19,0)))").cast("long"))
    best = scored.groupBy("lang", "phrase").agg(
        F.first("a").alias("a"), F.first("n").alias("n"),
        F.min(F.struct("score", "k", "l", "r")).alias("cut"))
    ranked = best.select("lang", "phrase", "a", "n", "cut.score", "cut.l", "cut.r").withColumn(
        "rank", F.row_number().over(Window.partitionBy("lang").orderBy(
            F.desc("score"), F.desc("a"), "phrase")))
    return ranked.where(F.col("rank") <= top).select(
        "lang", F.col("rank").cast("long").alias("rank"), "phrase", "a", "l", "r", "n", "score")


ORACLE = r"""
WITH pieces AS (
    SELECT coalesce(lang, 'und') AS lang, unnest(regexp_split_to_array(
        translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
        '[.,;:!?\x0A-\x0D]')) AS piece FROM documents),
split AS (SELECT lang, list_filter(regexp_split_to_array(piece, '[\x20\x09]+'),
                                   lambda w: w <> '') AS w FROM pieces),
starts AS (SELECT lang, w, unnest(range(1, len(w) + 1)) AS i FROM split),
grams AS (SELECT lang, m, array_to_string(w[i:i + m - 1], ' ') AS phrase
          FROM starts, (SELECT unnest(range(1, 6)) AS m) WHERE i + m - 1 <= len(w)),
totals AS (SELECT lang, count(*) AS n FROM grams WHERE m = 1 GROUP BY lang),
f AS (SELECT lang, m, phrase, count(*) AS f FROM grams GROUP BY ALL HAVING count(*) >= 100),
inner_phrases AS (
    SELECT lang, unnest([array_to_string(p[:-2], ' '), array_to_string(p[2:], ' ')]) AS phrase, f
    FROM (SELECT lang, string_split(phrase, ' ') AS p, f FROM f WHERE m > 2)),
longer AS (SELECT lang, phrase, max(f) AS most FROM inner_phrases GROUP BY ALL),
cuts AS (SELECT lang, phrase, f AS a, m, unnest(range(1, m)) AS k FROM f WHERE m > 1),
parts AS (SELECT *, array_to_string(string_split(phrase, ' ')[:k], ' ') AS first,
                 array_to_string(string_split(phrase, ' ')[k + 1:], ' ') AS rest FROM cuts),
scored AS (
    SELECT p.lang, p.phrase, p.a, p.k, l.f AS l, r.f AS r, t.n,
           (1000::HUGEINT * p.a * t.n) // (l.f::HUGEINT * r.f) AS score
    FROM parts p JOIN f l ON l.lang = p.lang AND l.phrase = p.first
    JOIN f r ON r.lang = p.lang AND r.phrase = p.rest JOIN totals t ON t.lang = p.lang),
best AS (SELECT * FROM scored
         QUALIFY row_number() OVER (PARTITION BY lang, phrase ORDER BY score, k) = 1),
kept AS (SELECT b.* FROM best b LEFT JOIN longer g ON g.lang = b.lang AND g.phrase = b.phrase
         WHERE g.most IS NULL OR 100 * g.most < 100 * b.a),
ranked AS (SELECT *, row_number() OVER (PARTITION BY lang
                                        ORDER BY score DESC, a DESC, phrase) AS rank FROM kept)
SELECT lang, rank, phrase, a, l, r, n, score::BIGINT AS score FROM ranked WHERE rank <= 2000
"""

"""N-gram Jaccard join by parity sketches: links between near-equal sets of word shingles.

A document's set holds the hashes of its distinct runs of five words (`shingle_words`); a
document with fewer words has its whole sequence as the one element; without words the set is
empty and linked with nothing. Two documents link if 100 * intersection >= 80 * union.

Such sets A, B differ in at most |A| / 4 elements. Elements are dealt into blocks by hash,
and each block is XORed into 64 parity bits: a differing element changes one block, so the
number of differing blocks never exceeds the symmetric difference. Taking the non-empty
blocks as tokens, A and B therefore share one among the first |A| / 4 + 1 of each in any
common order (here: blocks of many elements first, which shared passages fill least). The
number of blocks is fixed per size band; a set near the next band also gives that band's
tokens. A second sketch, one flip per element, has as many parity bits as the largest set of
the band has elements (128 at least), and folds to that of the band below. It drops pairs whose
Hamming distance is larger than the symmetric difference allowed; the rest are verified on the
sets, which are computed again from the texts of the documents concerned.

Copies and near copies are not expanded into pairs. The documents of a token are compared in
tiles of bounded size, and in every round each document gives only its closest partner by sketch
from another component, so the pairs of a round are as many as the tokens at most. Links merge
components; rounds go on while that leaves much to compare. Later rounds have few rows, so tables
are coalesced by their rows, and only the last labels and the new links are labelled anew. At the end all pairs that still lie
in different components and pass the sketches are verified, so no link is lost.

Only the named id and text columns are read. Equal texts form one class whatever their ids;
a null id never is a component's id unless all are null. Repeated rows give repeated rows.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tallystar.llm.common import ROWS_A_TASK, chunks, in_batches, tasks_for, written
from tallystar.llm.components import components

CHUNK_BYTES = 4_000_000
#: The sketch of a small set; those of larger bands double.
SKETCH_BITS = 128
#: Documents of one token that one task compares with as many others at a time.
TILE = 1500
#: Rounds end when documents have so few partners left on average, or when fewer than one in so
#: many is linked: what is left to compare then grows with the documents, not with its square.
FEW_PARTNERS, FEW_LINKS = 3, 3
#: Documents, with their sets or sketches, that a task takes at least once every core has one.
DOCS_A_TASK = 5_000
#: Bits of the filter by which texts are chosen for verification: 16 MB whatever the corpus.
FILTER_BITS = 1 << 27

_BREAK = np.zeros(256, bool)
_BREAK[[32, *range(9, 14)]] = True
_LOWER = np.arange(256, dtype=np.uint64)
_LOWER[65:91] += 32
_POWERS = np.cumprod(np.full(1 << 16, 0x9E3779B97F4A7C15, np.uint64) | np.uint64(1))


def _mix(x: np.ndarray) -> np.ndarray:
    """A bijection of 64 bits in which every input bit changes every output bit."""
    x = (x ^ (x >> np.uint64(33))) * np.uint64(0xFF51AFD7ED558CCD)
    x = (x ^ (x >> np.uint64(33))) * np.uint64(0xC4CEB9FE1A85EC53)
    return x ^ (x >> np.uint64(33))


def word_hashes(text: bytes) -> np.ndarray:
    """A hash per word; words are runs without ASCII white space, A-Z in lower case."""
    data = np.frombuffer(text, np.uint8)
    inside = np.concatenate([[False], ~_BREAK[data], [False]])
    edges = np.flatnonzero(inside[1:] != inside[:-1])
    starts, ends = edges[0::2], edges[1::2]
    if not len(starts):
        return np.empty(0, np.uint64)
    lengths = ends - starts
    began = np.zeros(len(data), np.int64)
    began[starts] = starts
    place = np.arange(len(data)) - np.maximum.accumulate(began)
    weights = _POWERS[place & 0xFFFF]
    if int(lengths.max()) > 0x10000:
        weights = weights * (2 * (place >> 16) + 1).astype(np.uint64)
    weighted = (_LOWER[data] + np.uint64(1)) * weights
    weighted[_BREAK[data]] = 0
    return _mix(np.add.reduceat(weighted, starts)
                + lengths.astype(np.uint64) * np.uint64(0xD6E8FEB86659FD93))


def shingles(text: bytes | None, shingle_words: int) -> np.ndarray:
    """The distinct shingle hashes in ascending order."""
    words = word_hashes(text) if text else np.empty(0, np.uint64)
    if not len(words):
        return words
    n = max(1, len(words) - shingle_words + 1)
    total = np.zeros(n, np.uint64)
    for k in range(min(shingle_words, len(words))):
        total = _mix(total * np.uint64(0x9FB21C651E98DF25) + words[k:k + n])
    return np.unique(total)


def _identity(elements: np.ndarray) -> bytes:
    """128 bits that name the set."""
    salted = _mix(elements ^ np.uint64(0xA0761D6478BD642F))
    return (np.add.reduce(salted, initial=np.uint64(len(elements))).tobytes()
            + np.bitwise_xor.reduce(elements, initial=np.uint64(0)).tobytes())


def _sketch(elements: np.ndarray, bits: int) -> bytes:
    flips = np.bincount((elements & np.uint64(bits - 1)).astype(np.int64), minlength=bits) & 1
    return np.packbits(flips.astype(np.uint8)).tobytes()


def _folded(sketches: pa.Array, size: int) -> np.ndarray:
    """Sketches of `size` bytes or a multiple as rows of 64-bit words, folded to `size` bytes."""
    out = np.empty((len(sketches), size // 8), np.uint64)
    lengths = pc.binary_length(sketches).to_numpy()
    for length in np.unique(lengths):
        at = np.flatnonzero(lengths == length)
        data = np.frombuffer(b"".join(sketches.take(pa.array(at)).to_pylist()), np.uint64)
        out[at] = np.bitwise_xor.reduce(data.reshape(len(at), length // size, size // 8), axis=1)
    return out


def _tokens(elements: np.ndarray, band: int, prefix: int) -> np.ndarray:
    """The first tokens of the set under the blocks of a size band."""
    blocks = int(0.36 * 2 ** (band + 1)) + 8
    seeded = _mix(elements + np.uint64((band + 1) * 0x2545F4914F6CDD1D & (1 << 64) - 1))
    block = (seeded >> np.uint64(32)) % np.uint64(blocks)
    order = np.argsort(block, kind="stable")
    block, seeded = block[order], seeded[order]
    starts = np.flatnonzero(np.concatenate([[True], block[1:] != block[:-1]]))
    sizes = np.diff(np.append(starts, len(block)))
    parity = np.bitwise_xor.reduceat(seeded, starts)
    salt = np.uint64((band + 1) << 32)
    token = _mix(parity ^ _mix(block[starts] + salt))
    out = token[np.lexsort((token, -sizes))[:prefix]]
    if len(token) < prefix:
        # So few blocks that all may differ (very rare): its empty blocks are tokens too.
        empty = np.setdiff1d(np.arange(blocks, dtype=np.uint64), block)
        out = np.concatenate([out, _mix(~_mix(empty + salt))])
    return out


def tokens(elements: np.ndarray, percent: int) -> tuple[np.ndarray, int]:
    """All tokens under which a set meets every set it may link with, and its sketch's bits."""
    n = len(elements)
    prefix = n * (100 - percent) // percent + 1      # the most elements that may differ, and one
    band = n.bit_length() - 1
    out = [_tokens(elements, band, prefix)]
    if 100 * n >= percent * 2 ** (band + 1):         # a partner may be in the next band
        band += 1
        out.append(_tokens(elements, band, prefix))
    return np.concatenate(out), max(SKETCH_BITS, 2 ** (band + 1))


def _described(batches: Iterator[pa.RecordBatch], words: int, percent: int
               ) -> Iterator[pa.RecordBatch]:
    """Class, size, sketch and tokens per document; tokens once per class and task."""
    met: set[bytes] = set()
    for batch in batches:
        for start, texts in chunks(batch.column("text"), CHUNK_BYTES):
            names, sizes, sketches, keys = [], [], [], []
            for text in texts:
                elements = shingles(text, words)
                name = _identity(elements)
                new = len(elements) > 0 and name not in met
                if len(met) >= 1_000_000:            # bounds memory; more copies are harmless
                    met.clear()
                met.add(name)
                names.append(name)
                sizes.append(len(elements))
                own, bits = tokens(elements, percent) if new else (None, 0)
                sketches.append(_sketch(elements, bits) if new else None)
                keys.append(own.view(np.int64) if new else None)
            yield pa.RecordBatch.from_arrays(
                [*(batch.column(c).slice(start, len(texts)) for c in ("id", "mark")),
                 pa.array(names, pa.binary()), pa.array(sizes, pa.int64()),
                 pa.array(sketches, pa.binary()), pa.array(keys, pa.list_(pa.int64()))],
                ["id", "mark", "class", "n", "sketch", "tokens"])


def _shared_tokens(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Of rows in order of the token, those whose token has another row."""
    token = np.empty(0, np.int64)
    node = np.empty(0, np.int64)
    last: int | None = None                          # token of a run begun before

    def emit(t: np.ndarray, n: np.ndarray, open_run: int | None):
        starts = np.flatnonzero(np.concatenate([[True], t[1:] != t[:-1]]))
        sizes = np.diff(np.append(starts, len(t)))
        shared = sizes > 1
        shared[0] |= open_run is not None and t[0] == open_run
        keep = np.repeat(shared, sizes)
        rows = pa.RecordBatch.from_arrays([pa.array(t[keep]), pa.array(n[keep])],
                                          ["token", "node"])
        return rows, int(t[-1])

    for batch in batches:
        if not batch.num_rows:
            continue
        token = np.concatenate([token, batch.column(0).to_numpy()])
        node = np.concatenate([node, batch.column(1).to_numpy()])
        # The last row waits, since only the next one shows whether its token is shared.
        if len(token) > 1:
            held = 1 if token[-1] != token[-2] else 0
            rows, last = emit(token[:len(token) - held], node[:len(node) - held], last)
            if held == 0:
                token, node = np.empty(0, np.int64), np.empty(0, np.int64)
            else:
                token, node = token[-1:], node[-1:]
            yield rows
    if len(token):
        yield emit(token, node, last)[0]


def _tile_pairs(percent: int, all_pairs: bool):
    """Pairs between the sides of each tile that differ in component and pass the sketches.

    Rows come in order of (token, i, j, side); many small tiles are paired in one operation.
    Either all pairs (a > b) are given, or for each row a of a tile the closest b.
    """
    def pairs(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        rest: pa.Table | None = None
        for batch in batches:
            rows = pa.Table.from_batches([batch])
            rest = pa.concat_tables([rest, rows]).combine_chunks() if rest is not None else rows
            bounds = _tile_bounds(rest)
            if len(bounds) > 2:                       # the last tile may go on
                yield from _paired(rest.slice(0, int(bounds[-2])), bounds[:-1], percent, all_pairs)
                rest = rest.slice(int(bounds[-2]))
        if rest is not None and rest.num_rows:
            yield from _paired(rest, _tile_bounds(rest), percent, all_pairs)

    return pairs


def _tile_bounds(rows: pa.Table) -> np.ndarray:
    token, i, j = (rows[c].to_numpy() for c in ("token", "i", "j"))
    new = (token[1:] != token[:-1]) | (i[1:] != i[:-1]) | (j[1:] != j[:-1])
    return np.concatenate([[0], np.flatnonzero(new) + 1, [len(token)]])


def _paired(rows: pa.Table, bounds: np.ndarray, percent: int, all_pairs: bool
            ) -> Iterator[pa.RecordBatch]:
    """The pairs of tiles whose sketches have one length, all such tiles together."""
    rows = rows.combine_chunks()
    sketches = rows["sketch"].chunk(0)
    # A band's sketches have its length, or twice that of sets that belong to the next one too.
    size = np.minimum.reduceat(pc.binary_length(sketches).to_numpy(), bounds[:-1])
    for length in np.unique(size):
        tiles = np.flatnonzero(size == length)
        lengths = bounds[tiles + 1] - bounds[tiles]
        at = np.repeat(bounds[tiles] - (np.cumsum(lengths) - lengths), lengths)
        at += np.arange(len(at))
        yield from _paired_alike(rows.take(pa.array(at)), _folded(sketches.take(pa.array(at)),
                                 int(length)), np.append(0, np.cumsum(lengths)), percent, all_pairs)


def _paired_alike(rows: pa.Table, sketch: np.ndarray, bounds: np.ndarray, percent: int,
                  all_pairs: bool, most: int = 500_000) -> Iterator[pa.RecordBatch]:
    node, label, n, side = (rows[c].to_numpy() for c in ("node", "label", "n", "side"))
    starts, ends = bounds[:-1], bounds[1:]
    right = np.repeat(ends - np.add.reduceat((side == 1).astype(np.int64), starts), ends - starts)
    # Every left row meets the right rows of its tile, and every row of a tile without sides the
    # rows after it, about `most` pairs at a time.
    row = np.flatnonzero(side != 1)
    begin = np.where(side == 2, np.arange(len(side)) + 1, right)[row]
    size = np.repeat(ends, ends - starts)[row] - begin
    step = np.searchsorted(np.cumsum(size), np.arange(0, size.sum() + most, most))
    for a, b in zip(step, np.append(step[1:], len(row))):
        if a >= b:
            continue
        x = np.repeat(row[a:b], size[a:b])
        y = np.arange(len(x)) + np.repeat(begin[a:b] - np.cumsum(size[a:b]) + size[a:b], size[a:b])
        ok = ((label[x] != label[y])
              & (100 * np.minimum(n[x], n[y]) >= percent * np.maximum(n[x], n[y])))
        x, y = x[ok], y[ok]
        allowed = (n[x] + n[y]) * (100 - percent) // (100 + percent)
        apart = np.zeros(len(x), np.int64)
        # A part of the bits bounds the difference too, so distant pairs go early.
        for k in range(sketch.shape[1]):
            apart += np.bitwise_count(sketch[x, k] ^ sketch[y, k])
            if k % 8 == 7 or k + 1 == sketch.shape[1]:
                ok = apart <= allowed
                x, y, apart, allowed = x[ok], y[ok], apart[ok], allowed[ok]
        if all_pairs:
            found = np.unique(np.stack([np.maximum(node[x], node[y]),
                                        np.minimum(node[x], node[y])], 1), axis=0)
            found = np.column_stack([found, np.zeros((len(found), 2), np.int64)])
        else:
            found = _closest(node[np.append(x, y)], node[np.append(y, x)], np.append(apart, apart))
        yield pa.RecordBatch.from_arrays([pa.array(found[:, c]) for c in range(4)],
                                         ["a", "b", "apart", "others"])


def _closest(a: np.ndarray, b: np.ndarray, apart: np.ndarray) -> np.ndarray:
    """Per a: the b that is least apart (ties: the least b), how far, and how many others it has."""
    order = np.lexsort((b, apart, a))
    a, b, apart = a[order], b[order], apart[order]
    first = np.flatnonzero(np.append(True, a[1:] != a[:-1])) if len(a) else order
    return np.column_stack([a[first], b[first], apart[first],
                            np.diff(np.append(first, len(a))) - 1])


class JaccardJoin:
    """The join over one set of documents; its tables are written as they are needed."""

    def __init__(self, docs: DataFrame, id_col: str, text_col: str, words: int, percent: int):
        self.words, self.percent = words, percent
        self.kind = docs.schema[id_col].dataType.simpleString()
        self.texts = docs.select(F.col(id_col).alias("id"),
                                 F.col(text_col).cast("binary").alias("text"))
        marked = self.texts.withColumn("mark", F.unhex(F.md5("text")))
        described = in_batches(
            marked, lambda batches: _described(batches, words, percent),
            f"id {self.kind}, mark binary, class binary, n long, sketch binary, tokens array<long>")
        self.rows = written(described.withColumn("node", F.monotonically_increasing_id()), "sets")
        self.nodes = self.rows.where("tokens IS NOT NULL")
        self.tasks = tasks_for(self.rows, DOCS_A_TASK)

    def labels(self) -> DataFrame:
        """(node, label) of all nodes with links; the label is the least node of the component."""
        same = self._same_class()
        # One node of a class is enough; the others would share all its tokens.
        alone = self.nodes.join(same.select(F.col("a").alias("node")), "node", "left_anti")
        pairs = alone.select(F.explode("tokens").alias("token"), "node")
        # Equal tokens lie in one partition, so partitions may follow each other in a task.
        shared = written(in_batches(pairs.repartition("token").sortWithinPartitions("token")
                                    .coalesce(self._token_tasks()),
                                    _shared_tokens, "token long, node long"), "tokens")
        edges, labels, tested, sets = same, None, None, None
        while True:
            n = max(self.tasks, tasks_for(shared))
            found = written(self._pairs(shared, labels, all_pairs=False, tasks=n).groupBy("a").agg(
                F.min(F.struct("apart", "b")).alias("to"), F.max("others").alias("others"))
                .select("a", "to.b", "others").coalesce(n), "pairs")
            partners = found.agg(F.count("*").alias("rows"), F.sum("others").alias("others")).first()
            if not partners.rows:
                return components(edges)
            # Who has no partner now will have none later: components only grow.
            open_nodes = found.select(F.col("a").alias("node"))
            shared = written(shared.join(open_nodes, "node", "left_semi").coalesce(n), "tokens")
            if sets is None:
                sets = written(self._sets(open_nodes), "sets")
            pairs = _ordered(found)
            pairs = pairs if tested is None else pairs.join(tested, ["a", "b"], "left_anti")
            pairs = written(pairs.coalesce(self.tasks), "pairs")
            links = self._verified(pairs, sets)
            edges, linked = edges.union(links), links.count()
            tested = pairs if tested is None else tested.union(pairs)
            if (FEW_LINKS * linked <= partners.rows
                    or partners.others <= FEW_PARTNERS * partners.rows):
                labels = components(edges)
                rest = _ordered(self._pairs(shared, labels, all_pairs=True, tasks=n))
                rest = written(rest.join(tested, ["a", "b"], "left_anti").coalesce(n), "pairs")
                links = self._verified(rest, sets)
                return labels if links.isEmpty() else components(_stars(labels).union(links))
            labels = components(edges)
            edges = _stars(labels)

    def _token_tasks(self) -> int:
        """To how many tasks all tokens may be coalesced."""
        rows = self.nodes.agg(F.sum(F.size("tokens"))).first()[0] or 0
        return max(self.tasks, -(-rows // ROWS_A_TASK))

    def _same_class(self) -> DataFrame:
        """Nodes of one class that several tasks described, each with the least of them."""
        least = self.nodes.groupBy("class").agg(F.min("node").alias("b"), F.max("node").alias("top"))
        several = least.where("b < top").select("class", "b")
        return written(self.nodes.join(several, "class").where("node > b")
                       .select(F.col("node").alias("a"), "b").coalesce(self.tasks), "links")

    def _sized(self, shared: DataFrame, labels: DataFrame | None, tasks: int) -> DataFrame:
        """(token, node, label, size) of the tokens that nodes of several components have.

        Before there are labels, every node is a component, and only crowded tokens are counted.
        """
        if labels is None:
            crowded = written(shared.groupBy("token").agg(F.count("*").alias("size"))
                              .where(F.col("size") > TILE).coalesce(tasks), "crowded")
            return shared.join(crowded, "token", "left").select(
                "token", "node", F.col("node").alias("label"), F.coalesce("size", F.lit(1)).alias("size"))
        named = written(shared.join(labels, "node", "left")
                        .withColumn("label", F.coalesce("label", "node")).coalesce(tasks), "tokens")
        mixed = written(named.groupBy("token").agg(
            F.min("label").alias("low"), F.max("label").alias("high"), F.count("*").alias("size"))
            .where("low < high").select("token", "size").coalesce(tasks), "tokens")
        return named.join(mixed, "token")

    def _pairs(self, shared: DataFrame, labels: DataFrame | None, all_pairs: bool, tasks: int
               ) -> DataFrame:
        """(a, b, apart, others) that share a token, pass the sketches and lie in two components."""
        sides = F.ceil(F.col("size") / TILE).cast("int")
        own = F.pmod(F.xxhash64("node"), sides).cast("int")
        placed = (self._sized(shared, labels, tasks).withColumn("sides", sides).withColumn("own", own)
                  .join(self.nodes.select("node", "n", "sketch"), "node").coalesce(tasks))
        # Tile (i, j) compares part i (side 0) of a token with part j (side 1), or i with itself.
        tiles = placed.select("*", F.explode(F.expr("""transform(sequence(0, sides - 1), other ->
            struct(least(own, other) AS i, greatest(own, other) AS j,
                   CASE WHEN own < other THEN 0 WHEN own > other THEN 1 ELSE 2 END AS side))"""))
            .alias("at"))
        columns = ["token", "at.i", "at.j", "at.side", "node", "label", "n", "sketch"]
        return in_batches(tiles.select(*columns).repartition("token", "i", "j")
                          .sortWithinPartitions("token", "i", "j", "side").coalesce(tasks),
                          _tile_pairs(self.percent, all_pairs), "a long, b long, apart long, others long")

    def _verified(self, pairs: DataFrame, sets: DataFrame) -> DataFrame:
        """Those of the pairs (a, b) whose sets link, decided on the sets."""
        left = pairs.join(sets.select(F.col("node").alias("a"), F.col("elements").alias("x")), "a")
        left = left.coalesce(self.tasks)
        both = left.join(sets.select(F.col("node").alias("b"), F.col("elements").alias("y")), "b")
        common = F.size(F.array_intersect("x", "y"))
        union = F.size("x") + F.size("y") - common
        return written(both.where(100 * common >= self.percent * union).select("a", "b")
                       .coalesce(self.tasks), "links")

    def _sets(self, nodes: DataFrame) -> DataFrame:
        """(node, elements): the texts that may be wanted are found by a filter of fixed size."""
        spark = nodes.sparkSession
        wanted = written(self.nodes.join(nodes, "node").select("node", "id", "class")
                         .coalesce(self.tasks), "wanted")
        bits = np.zeros(FILTER_BITS // 64, np.int64)
        place = F.pmod(F.xxhash64("id"), F.lit(FILTER_BITS))
        masks = (wanted.select((place / 64).cast("long").alias("word"),
                               F.expr(f"shiftleft(1L, cast(pmod(xxhash64(id), {FILTER_BITS}) % 64 AS int))")
                               .alias("bit"))
                 .groupBy("word").agg(F.bit_or("bit").alias("mask")).coalesce(self.tasks).toArrow())
        bits[masks["word"].to_numpy()] = masks["mask"].to_numpy()  # at most FILTER_BITS / 64 rows
        held, words = spark.sparkContext.broadcast(bits), self.words

        def chosen(batches):
            met: set[bytes] = set()
            for batch in batches:
                at = batch.column("at").to_numpy()
                hit = (held.value[at >> 6] >> (at & 63)) & 1
                batch = batch.filter(pa.array(hit.astype(bool)))
                for _, texts in chunks(batch.column("text"), CHUNK_BYTES):
                    sets = {_identity(s): s for s in (shingles(t, words) for t in texts)}
                    sets = {name: s for name, s in sets.items() if name not in met}
                    if len(met) >= 1_000_000:        # bounds memory; more copies are harmless
                        met.clear()
                    met.update(sets)
                    yield pa.RecordBatch.from_arrays(
                        [pa.array(list(sets), pa.binary()),
                         pa.array([s.view(np.int64) for s in sets.values()],
                                  pa.list_(pa.int64()))], ["class", "elements"])

        found = in_batches(self.texts.select("text", place.alias("at")), chosen,
                           "class binary, elements array<long>")
        once = found.groupBy("class").agg(F.first("elements").alias("elements"))
        return (wanted.select("node", "class").join(once, "class").select("node", "elements")
                .coalesce(self.tasks))

    def membership(self) -> DataFrame:
        """(id, mark, n, component) per row; mark is the MD5 of the text, null for a null one."""
        labels = self.labels()
        least = self.nodes.groupBy("class").agg(F.min("node").alias("node"))
        named = least.join(labels, "node", "left").select(
            "class", F.coalesce("label", "node").alias("label"))
        classes = written(named.coalesce(self.tasks), "classes")
        rows = written(self.rows.select("id", "mark", "n", "class").join(classes, "class", "left")
                       .coalesce(self.tasks), "rows")
        low = written(rows.where("label IS NOT NULL").groupBy("label")
                      .agg(F.min("id").alias("low"), F.count("*").alias("members"))
                      .where("members > 1").select("label", "low").coalesce(self.tasks), "lows")
        return rows.join(low, "label", "left").select(
            "id", "mark", "n", F.when(F.col("label").isNull(), F.col("id"))
            .otherwise(F.coalesce("low", "id")).alias("component"))


def _stars(labels: DataFrame) -> DataFrame:
    """Edges (a, b) that have the components of the labels."""
    return labels.select(F.col("node").alias("a"), F.col("label").alias("b"))


def _ordered(pairs: DataFrame) -> DataFrame:
    return pairs.select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b")).distinct()


def near_duplicates(docs: DataFrame, *, id_col: str = "doc_id", text_col: str = "text",
                    shingle_words: int = 5, percent: int = 80) -> DataFrame:
    """(id, n_shingles, component_id) per row, the least id of the linked documents.

    Empty tables give no rows, empty sets are alone, rows with a null id belong to the
    component of their text. An id that has several texts stands in the component of each.
    """
    join = JaccardJoin(docs, id_col, text_col, shingle_words, percent)
    return join.membership().select(F.col("id").alias(id_col), F.col("n").alias("n_shingles"),
                                    F.col("component").alias("component_id"))


def one_per_group(docs: DataFrame, *, id_col: str = "doc_id", text_col: str = "text",
                  shingle_words: int = 5, percent: int = 80) -> DataFrame:
    """One row, with all its columns, of each component: the one of the least id.

    Rows equal in id and text count as one document and leave one row. Rows with a null id
    stay unless their text belongs to a component with an id.
    """
    found = JaccardJoin(docs, id_col, text_col, shingle_words, percent).membership()
    document = lambda i, mark: F.md5(F.concat(                        # noqa: E731
        F.coalesce(F.col(i).cast("string"), F.lit("-")).cast("binary"), F.lit(b":"),
        F.coalesce(mark, F.lit(b""))))
    stay = (found.where("id IS NOT NULL").groupBy("component")
            .agg(F.min(F.struct("id", "mark")).alias("least")).select("least.id", "least.mark")
            .unionByName(found.where("id IS NULL AND component IS NULL").select("id", "mark")))
    kept = stay.select(document("id", F.col("mark")).alias("_document")).distinct()
    rows = docs.withColumn("_document", document(
        id_col, F.unhex(F.md5(F.col(text_col).cast("binary")))))
    return (rows.join(kept, "_document", "left_semi").dropDuplicates(["_document"])
            .drop("_document"))

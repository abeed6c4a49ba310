"""A Merkle manifest of a data set: a digest per row, per source and for the whole.

Every row is a leaf, the SHA-256 of its fields. A source's leaves, ascending by id (nulls
first, equal ids by leaf), are folded three at a time until one node is left, its subroot; the
subroots, in order of the source (null first, bytewise), are folded in the same way to the root.

Cogrouped subtree exchange: a tree is cut into superblocks of 3^7 consecutive nodes. Going up,
every superblock is reduced to one node, and these are the next level's nodes, so the levels
shrink by 2,187. Going down, the nodes of a superblock are cogrouped with its outer path, the
siblings between the superblock's own node and the root: the group finishes its local
reduction, joins each node's local siblings with the outer ones to a proof, and folds it.
Superblocks of small trees share a group, so that many small sources are not many groups.

Places are numbered by ranges: rows are range-partitioned, sorted and written once, and one
row per range and tree says where its part begins. No source passes through one task.
Rows equal in all fields are separate leaves; rows with a null source form a tree of their own.
A table without rows has no root and gives no rows. Other columns than the five are not read.
"""

from __future__ import annotations

import hashlib

import pandas as pd
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tallystar.llm.common import ship, written

ARITY = 3
LEVELS = 7
FIELDS = ("doc_id", "source", "lang", "n_chars", "text")
#: The tree over the subroots; every source's key begins otherwise.
TOP = ""


def leaf_digest(*fields: Column) -> Column:
    """SHA-256 of the fields, each `-` if null, else its UTF-8 length, `:` and the value."""
    def part(field: Column) -> Column:
        value = field.cast("string")
        return F.coalesce(F.concat(F.octet_length(value).cast("string"), F.lit(":"), value),
                          F.lit("-"))
    return F.unhex(F.sha2(F.concat(*map(part, fields)), 256))


def tree_key(source: Column) -> Column:
    """A source as a key that is never null and sorts as the subroots do."""
    return F.coalesce(F.concat(F.lit("="), source.cast("string")), F.lit("-"))


def _fold(run: list[bytes]) -> bytes:
    return hashlib.sha256("".join(d.hex() for d in run).encode()).digest()


def _height(n: int) -> int:
    """The levels above n leaves."""
    levels, reach = 0, 1
    while reach < n:
        levels, reach = levels + 1, reach * ARITY
    return levels


def _reduced(nodes: list[bytes], levels: int) -> list[list[bytes]]:
    """The nodes and all levels above them up to the superblock's own node."""
    out = [nodes]
    for _ in range(levels):
        out.append([_fold(out[-1][i:i + ARITY]) for i in range(0, len(out[-1]), ARITY)])
    return out


def _climb(levels: list[list[bytes]], place: int) -> list[tuple[int, list[bytes]]]:
    """Per level, the place in its run and the run's other digests."""
    out = []
    for nodes in levels[:-1]:
        run = nodes[place - place % ARITY:place - place % ARITY + ARITY]
        at = place % ARITY
        out.append((at, run[:at] + run[at + 1:]))
        place //= ARITY
    return out


def _packed(path: list[tuple[int, list[bytes]]]) -> bytes:
    """A path as bytes: per level the place, the number of siblings, and these."""
    return b"".join(bytes((at, len(others))) + b"".join(others) for at, others in path)


def _unpacked(data: bytes) -> list[tuple[int, list[bytes]]]:
    out, i = [], 0
    while i < len(data):
        at, count = data[i], data[i + 1]
        i += 2
        out.append((at, [data[i + 32 * j:i + 32 * j + 32] for j in range(count)]))
        i += 32 * count
    return out


def fold_path(digest: bytes, path: list[tuple[int, list[bytes]]]) -> bytes:
    """The root that a digest and its siblings give."""
    for at, others in path:
        digest = _fold([*others[:at], digest, *others[at:]])
    return digest


def _blocks(group: pd.DataFrame):
    """(tree, block, rows in order) of the superblocks in a group."""
    for (tree, block), rows in group.sort_values(["tree", "pos"]).groupby(
            ["tree", "block"], sort=False):
        yield tree, block, rows


def _group(nodes: Column, block: Column, size: int, spread: int) -> Column:
    """The group in which a superblock of a tree with so many nodes is worked on."""
    return F.when(nodes >= size, F.xxhash64("tree", block)).otherwise(
        F.pmod(F.xxhash64("tree"), F.lit(spread)))


def _grouped(nodes: DataFrame, levels: int, spread: int) -> DataFrame:
    size = ARITY ** levels
    return nodes.withColumn("block", F.expr(f"pos div {size}")).withColumn(
        "g", _group(F.col("n"), F.col("block"), size, spread))


def _up(nodes: DataFrame, levels: int, spread: int) -> DataFrame:
    """(tree, n, pos, digest): one node per superblock."""
    size = ARITY ** levels

    def reduce(group: pd.DataFrame) -> pd.DataFrame:
        out = []
        for tree, block, rows in _blocks(group):
            n = int(rows["n"].iloc[0])
            top = _reduced(list(rows["digest"]), min(levels, _height(n)))[-1][0]
            out.append((tree, -(-n // size), block, top))
        return pd.DataFrame(out, columns=["tree", "n", "pos", "digest"])

    return (_grouped(nodes, levels, spread).groupBy("g")
            .applyInPandas(reduce, "tree string, n long, pos long, digest binary"))


def _cogrouped(nodes: DataFrame, paths: DataFrame, levels: int, spread: int, made, schema: str
               ) -> DataFrame:
    """made(rows of a superblock, its reduction, outer path row) -> tuples, for all superblocks."""
    names = [c.split()[0] for c in schema.split(", ")]

    def join(group: pd.DataFrame, outer: pd.DataFrame) -> pd.DataFrame:
        above = {(row.tree, row.block): row for row in outer.itertuples(index=False)}
        out = []
        for tree, block, rows in _blocks(group):
            local = _reduced(list(rows["digest"]), min(levels, _height(int(rows["n"].iloc[0]))))
            out += made(rows, local, above[tree, block])
        return pd.DataFrame(out, columns=names)

    # A superblock's path is the path of its own node; it goes to the group of its children.
    outer = paths.select("tree", F.col("pos").alias("block"), "path", "subroot", "root", _group(
        F.col("children"), F.col("pos"), ARITY ** levels, spread).alias("g"))
    return (_grouped(nodes, levels, spread).groupBy("g").cogroup(outer.groupBy("g"))
            .applyInPandas(join, schema))


_PATHS = "tree string, n long, pos long, path binary, subroot binary, root binary"


def _down(nodes: DataFrame, paths: DataFrame, levels: int, spread: int) -> DataFrame:
    """The paths of the nodes from the paths of their superblocks."""
    size = ARITY ** levels

    def made(rows, local, above):
        return [(row.tree, row.n, row.pos, _packed(_climb(local, row.pos % size)) + above.path,
                 above.subroot, above.root) for row in rows.itertuples(index=False)]

    return _cogrouped(nodes, paths, levels, spread, made, _PATHS)


_RESULT = ("leaf", "subroot", "root", "proof_sha256", "folded_root", "verified")


def _proven(leaves: DataFrame, paths: DataFrame, levels: int, spread: int) -> DataFrame:
    """The result rows from the paths of the leaves' superblocks."""
    size = ARITY ** levels

    def made(rows, local, above):
        outer, out = _unpacked(above.path), []
        for row in rows.itertuples(index=False):
            path = _climb(local, row.pos % size) + outer
            proof = hashlib.sha256("".join(d.hex() for _, others in path for d in others)
                                   .encode()).hexdigest()
            found = fold_path(row.shown, path)
            out.append((row.id, row.digest.hex(), above.subroot.hex(), above.root.hex(), proof,
                        found.hex(), found == above.root))
        return out

    return _cogrouped(leaves, paths, levels, spread, made,
                      "id string, leaf string, subroot string, root string, "
                      "proof_sha256 string, folded_root string, verified boolean")


def _placed(rows: DataFrame, name: str) -> DataFrame:
    """Rows (tree, order columns, ...) with their place `pos` in the tree and its size `n`.

    `order` decides within a tree, `tie` spreads rows that are equal in it.
    """
    ranged = written(
        rows.withColumn("tie", F.monotonically_increasing_id())
        .repartitionByRange("tree", "order", "digest", "tie")
        .sortWithinPartitions("tree", "order", "digest", "tie").drop("tie")
        .withColumn("at", F.monotonically_increasing_id())
        .withColumn("range", F.spark_partition_id()), name)
    parts = ranged.groupBy("tree", "range").agg(F.min("at").alias("first"),
                                                F.count("*").alias("here"))
    whole = Window.partitionBy("tree").orderBy("range")
    bounds = parts.select(
        "tree", "range", "first",
        F.coalesce(F.sum("here").over(whole.rowsBetween(Window.unboundedPreceding, -1)),
                   F.lit(0)).alias("before"),
        F.sum("here").over(Window.partitionBy("tree")).alias("n"))
    return (ranged.join(bounds, ["tree", "range"])
            .withColumn("pos", F.col("at") - F.col("first") + F.col("before"))
            .drop("at", "first", "before", "range", "order"))


def _climbed(nodes: DataFrame, levels: int, name: str) -> list[tuple[DataFrame, int]]:
    """The nodes, then one node per superblock, up to one per tree; each with its groups."""
    out = []
    while True:
        size = nodes.agg(F.max("n").alias("most"), F.count("*").alias("rows")).first()
        if not size.rows:
            return []
        spread = -(-size.rows // ARITY ** levels)
        out.append((nodes, spread))
        nodes = written(_up(nodes, levels, spread), name)
        if size.most <= ARITY ** levels:
            return [*out, (nodes, 0)]


def _sized(paths: DataFrame, nodes: DataFrame, levels: int) -> DataFrame:
    """The paths of superblocks with `children`, the number of nodes in the level below."""
    size = ARITY ** levels
    below = nodes.where(f"pos % {size} = 0").select(
        "tree", F.expr(f"pos div {size}").alias("pos"), F.col("n").alias("children"))
    return paths.join(below, ["tree", "pos"])


def _descended(floors: list[tuple[DataFrame, int]], paths: DataFrame, levels: int, stop: int
               ) -> DataFrame:
    """The paths of the nodes of floor `stop`, from those of the trees' last nodes."""
    for nodes, spread in reversed(floors[stop:-1]):
        paths = written(_down(nodes, _sized(paths, nodes, levels), levels, spread), "paths")
    return paths


def manifest(rows: DataFrame, *, id_col: str, tree: Column, leaf: Column, shown: Column,
             levels: int = LEVELS) -> DataFrame:
    """(id, leaf, subroot, root, proof_sha256, folded_root, verified) per row.

    `leaf` is the digest a row is entered with, `shown` the digest it has now; `folded_root` is
    what `shown` and the row's siblings give, and `verified` whether that is the root. A
    superblock has 3^levels nodes; the result does not depend on it.
    """
    ship(rows.sparkSession)
    kind = rows.schema[id_col].dataType.simpleString()
    # The id travels as text: a column of numbers and nulls would lose digits in pandas.
    leaves = written(_placed(rows.select(
        F.col(id_col).cast("string").alias("id"), tree.alias("tree"), F.col(id_col).alias("order"),
        leaf.alias("digest"), shown.alias("shown")), "sorted"), "leaves")
    below = _climbed(leaves.select("tree", "n", "pos", "digest"), levels, "nodes")
    if not below:
        return rows.sparkSession.createDataFrame(
            [], f"{id_col} {kind}, leaf string, subroot string, root string, "
                "proof_sha256 string, folded_root string, verified boolean")
    subroots = below[-1][0]
    top = written(_placed(subroots.select(F.lit(TOP).alias("tree"), F.col("tree").alias("order"),
                                          F.col("tree").alias("source"), "digest"), "sources"),
                  "subroots")
    above = _climbed(top.select("tree", "n", "pos", "digest"), levels, "nodes")
    root = above[-1][0].select("tree", "n", "pos", F.lit(b"").alias("path"),
                               F.lit(b"").alias("subroot"), F.col("digest").alias("root"))
    proofs = _descended(above, root, levels, 0).select("pos", "path", "root")
    paths = top.join(proofs, "pos").select(
        F.col("source").alias("tree"), F.lit(1).cast("long").alias("n"),
        F.lit(0).cast("long").alias("pos"), "path", F.col("digest").alias("subroot"), "root")
    paths = _descended(below, paths, levels, 1)
    return _proven(leaves, _sized(paths, leaves, levels), levels, below[0][1]).select(
        F.col("id").cast(kind).alias(id_col), *_RESULT)


def without_newlines(docs: DataFrame) -> Column:
    """The text, its newlines deleted where 2 divides the CRC-32 of the decimal id."""
    tampered = F.crc32(F.col("doc_id").cast("string").cast("binary")) % 2 == 0
    return F.when(tampered, F.replace(F.col("text"), F.lit("\n"), F.lit(""))).otherwise(F.col("text"))


def query(docs: DataFrame, levels: int = LEVELS) -> DataFrame:
    fields = [F.col(c) for c in FIELDS]
    return manifest(docs, id_col="doc_id", tree=tree_key(F.col("source")),
                    leaf=leaf_digest(*fields),
                    shown=leaf_digest(*fields[:-1], without_newlines(docs)), levels=levels)


def oracle(floors: int = 8) -> str:
    """SQL for the query's rows on tables whose trees have at most 3^floors leaves.

    A floor folds the nodes of the one below, if its tree has several; every leaf collects, floor
    by floor, what stands before and after it in its run.
    """
    def enter(text: str) -> str:
        values = [f"CAST({c} AS VARCHAR)" for c in FIELDS[:-1]] + [text]
        return "sha256(concat(" + ", ".join(
            f"coalesce(octet_length(encode({v}))::VARCHAR || ':' || {v}, '-')"
            for v in values) + "))"

    crc = ("xor(4294967295, list_reduce(list_prepend(4294967295::BIGINT, list_transform("
           "range(1, length(doc_id::VARCHAR) + 1), lambda i: ascii(substr(doc_id::VARCHAR, i, 1))"
           "::BIGINT)), lambda c, b: list_reduce(list_prepend(xor(c, b), range(8)), "
           "lambda x, k: xor(x >> 1, 3988292384 * (x & 1)))))")
    parts = [f"""docs AS (SELECT doc_id, coalesce('=' || source, '-') AS tree, {enter('text')} AS leaf,
        CASE WHEN {crc} % 2 = 0 THEN {enter("replace(text, chr(10), '')")}
             ELSE {enter('text')} END AS shown FROM documents)""",
             """nodes AS (SELECT *, leaf AS d, count(*) OVER (PARTITION BY tree) AS n, row_number() OVER
        (PARTITION BY tree ORDER BY doc_id NULLS FIRST, leaf) - 1 AS pos FROM docs)""",
             "w0 AS (SELECT *, pos AS place, shown AS cur, '' AS proof FROM nodes)",
             "a0 AS (SELECT tree, pos, d, n FROM nodes)"]
    for kind, start in (("a", "w0"), ("b", None)):
        if kind == "b":
            parts.append(f"subs AS (SELECT tree, d, row_number() OVER (ORDER BY tree) - 1 AS pos, "
                         f"count(*) OVER () AS n FROM a{floors})")
            parts.append("b0 AS (SELECT '' AS tree, pos, d, n FROM subs)")
            parts.append(f"v0 AS (SELECT w.* EXCLUDE (place), s.d AS subroot, s.pos AS place "
                         f"FROM w{floors} w JOIN subs s USING (tree))")
        walk = "w" if kind == "a" else "v"
        own = "w.tree" if kind == "a" else "''"
        for i in range(floors):
            run = "PARTITION BY tree, pos // 3 ORDER BY pos ROWS BETWEEN"
            parts.append(f"""{kind}s{i} AS (SELECT *,
        coalesce(string_agg(d, '') OVER ({run} UNBOUNDED PRECEDING AND 1 PRECEDING), '') AS before,
        coalesce(string_agg(d, '') OVER ({run} 1 FOLLOWING AND UNBOUNDED FOLLOWING), '') AS after
        FROM {kind}{i})""")
            parts.append(f"""{walk}{i + 1} AS (SELECT w.* REPLACE (w.place // 3 AS place,
        CASE WHEN s.n > 1 THEN sha256(before || cur || after) ELSE cur END AS cur,
        CASE WHEN s.n > 1 THEN proof || before || after ELSE proof END AS proof)
        FROM {walk}{i} w JOIN {kind}s{i} s ON s.tree = {own} AND s.pos = w.place)""")
            parts.append(f"""{kind}{i + 1} AS (SELECT tree, pos // 3 AS pos, CASE WHEN max(n) > 1
        THEN sha256(string_agg(d, '' ORDER BY pos)) ELSE min(d) END AS d, (max(n) + 2) // 3 AS n
        FROM {kind}{i} GROUP BY tree, pos // 3)""")
    return ("WITH " + ",\n".join(parts) + f"""
SELECT doc_id, leaf, subroot, root.d AS root, sha256(proof) AS proof_sha256, cur AS folded_root,
       cur = root.d AS verified FROM v{floors} CROSS JOIN (SELECT d FROM b{floors}) AS root""")


ORACLE = oracle()

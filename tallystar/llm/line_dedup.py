"""Line dedup: lines that many documents share go from every document.

Normalised lines are exploded and hashed to 128 bits; the distinct documents of each hash are
counted; lines over the threshold are dropped by position, and the rest is reassembled in order.
Only hashes, document ids and positions are exploded and shuffled, never the lines themselves.
Everything is DataFrame functions.

A line's key is the line without `[\\x20\\x09-\\x0D]` at both ends and with A-Z in lower case.
Keys shorter than `min_chars` code points are never dropped. Rows of one id are one document;
every row with a null id is one of its own. A null text is an empty one, which has one empty
line. Repeated rows give repeated rows. No rows, no rows.
"""

from __future__ import annotations

from string import ascii_lowercase, ascii_uppercase

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tallystar.llm.common import written
from tallystar.operators.salting import salted_join

#: The white space that does not count at a line's ends.
_BLANK = " \t\n\x0b\x0c\r"
#: The keys found in most documents whose lines are dealt to several tasks, and to how many.
HOT_KEYS, SALTS = 1_000, 64


def line_key(line: Column) -> Column:
    return F.translate(F.btrim(line, F.lit(_BLANK)), ascii_uppercase, ascii_lowercase)


def _lines(rows: DataFrame, text: Column, min_chars: int) -> DataFrame:
    """(row, id, own, pos, hash) per line that could be dropped."""
    lines = rows.select("row", "id", "own", F.posexplode(F.split(text, "\n", -1)))
    keyed = lines.select("row", "id", "own", "pos", line_key(F.col("col")).alias("key"))
    return keyed.where(F.length("key") >= min_chars).select(
        "row", "id", "own", "pos", F.unhex(F.md5("key")).alias("hash"))


def common_lines(lines: DataFrame, min_docs: int) -> DataFrame:
    """(hash, n_docs) of the lines found in at least so many documents.

    A document's repeats of a line meet before they are sent, and its documents are counted
    where they lie, so a line that most documents have is one row per task in the last shuffle.
    """
    once = lines.select("hash", "id", "own").distinct()
    return once.groupBy("hash").agg(F.count("*").alias("n_docs")).where(F.col("n_docs") >= min_docs)


def drop_common_lines(docs: DataFrame, *, id_col: str = "doc_id", text_col: str = "text",
                      min_docs: int = 10, min_chars: int = 1) -> DataFrame:
    """The rows with their columns, the text without common lines, `n_lines` and `n_dropped`.

    Columns that are named like the two counts are replaced by them.
    """
    # Written once: the lines and the rows that they go back to must agree on the numbers.
    rows = written(docs.select(F.struct(*(F.col(f"`{c}`") for c in docs.columns)).alias("doc"),
                               F.monotonically_increasing_id().alias("row")), "rows")
    text = F.coalesce(F.col("doc").getField(text_col), F.lit(""))
    ident = F.col("doc").getField(id_col)
    named = rows.select("row", "doc", ident.alias("id"),
                        F.when(ident.isNull(), F.col("row")).alias("own"))
    lines = written(_lines(named, text, min_chars), "lines")
    common = written(common_lines(lines, min_docs), "common")
    hot = common.orderBy(F.desc("n_docs"), "hash").limit(HOT_KEYS)
    found = salted_join(lines.select("row", "pos", "hash"), common.select("hash"), "hash", hot,
                        F.col("row"), SALTS)
    dropped = found.groupBy("row").agg(F.collect_list("pos").alias("at"))
    split = F.split(text, "\n", -1)
    held = rows.join(dropped, "row", "left").select(
        "doc", split.alias("lines"), F.coalesce("at", F.array().cast("array<int>")).alias("at"))
    places = F.array_except(F.sequence(F.lit(0), F.size("lines") - 1), F.col("at"))
    kept = F.when(F.size("at") == 0, text).otherwise(
        F.array_join(F.transform(places, lambda i: F.get(F.col("lines"), i)), "\n"))
    counts = {"n_lines": F.size("lines").cast("long"), "n_dropped": F.size("at").cast("long")}
    columns = [kept.alias(c) if c == text_col else F.col("doc").getField(c).alias(c)
               for c in docs.columns if c not in counts]
    return held.select(*columns, *(c.alias(n) for n, c in counts.items()))


def query(docs: DataFrame) -> DataFrame:
    out = drop_common_lines(docs.select("doc_id", "text"))
    return out.select("doc_id", "n_lines", "n_dropped", F.sha2("text", 256).alias("kept_sha256"))


ORACLE = f"""
WITH lines AS (
    SELECT doc_id, unnest(l) AS line, generate_subscripts(l, 1) AS pos
    FROM (SELECT doc_id, string_split(coalesce(text, ''), chr(10)) AS l FROM documents)),
keyed AS (
    SELECT *, translate(trim(line, ' ' || chr(9) || chr(10) || chr(11) || chr(12) || chr(13)),
                        '{ascii_uppercase}', '{ascii_lowercase}') AS key FROM lines),
common AS (SELECT key FROM keyed WHERE length(key) >= 1
           GROUP BY key HAVING count(DISTINCT doc_id) >= 10)
SELECT doc_id, count(*) AS n_lines, count(c.key) AS n_dropped,
       sha256(coalesce(string_agg(line, chr(10) ORDER BY pos) FILTER (c.key IS NULL), ''))
           AS kept_sha256
FROM keyed k LEFT JOIN common c ON k.key = c.key GROUP BY doc_id
"""

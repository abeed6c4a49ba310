import gzip

import pytest

from checks.compare import difference, oracle_connection
from tallystar.llm import queries, warc
from tallystar.llm.common import filesystem
from tallystar.sources.shared import fresh_path

SF = "/root/testdata/sf0.001"


def test_query_equals_sql(spark):
    assert difference(queries.op4_warc(spark, SF), oracle_connection(SF), queries.ORACLES["op4_warc"]) is None


def test_record_round_trip():
    payload = "é\r\n\r\nx".encode()
    fields, http, got = warc.parse(warc.record(5, "http://a/\r\nX: y", payload, warc.digest(payload), None))
    assert got == payload and fields["WARC-Type"] == "response" and "X" not in fields
    assert warc.digest(b"") == "3I42H3S6NNFQ2MSVX7XZKYAYSCX5QBYJ"
    fields, http, got = warc.parse(warc.record(6, None, payload, "D", 5))
    assert (fields["WARC-Type"], fields["WARC-Refers-To"], got) == ("revisit", "<urn:page:5>", b"")
    assert http["Content-Length"] == str(len(payload))


def test_ranges_are_merged_within_bounds():
    near, far, size = warc.GAP_BYTES, 10 * warc.GAP_BYTES, warc.RANGE_BYTES
    records = [("a", 0, 10), ("a", 10, 10), ("a", 20 + near, 5), ("a", far, 5), ("b", 0, size), ("b", size, 1)]
    assert list(warc.ranges(records)) == [
        ("a", 0, 25 + near, [0, 1, 2]), ("a", far, far + 5, [3]), ("b", 0, size, [4]),
        ("b", size, size + 1, [5])]
    assert list(warc.ranges([])) == []


PAGES = [(3, "u3", "same"), (2, "u2", "same"), (2, "u2", "same"), (None, "u", "same"), (4, None, None),
         (5, "u5", ""), (6, "u6", "x" * 300_000), (None, "n", "alone"), (None, "m", "alone"), (9, "u9", "ü")]


def pages(spark, rows=PAGES):
    return spark.createDataFrame(rows, "page_id long, url string, html string").selectExpr(
        "*", "url AS payload", "url AS file", "url AS salt", "url AS offset")


def test_roles_nulls_and_repeats(spark):
    folder = fresh_path(spark, "warc")
    index = warc.write(pages(spark), folder)
    got = sorted(((r.page_id or 0, r.record_type, r.refers_to or 0, r.payload_bytes)
                  for r in warc.read(index, folder).collect()))
    assert got == sorted([(3, "revisit", 2, 4), (2, "response", 0, 4), (2, "response", 0, 4),
                          (0, "revisit", 2, 4), (4, "response", 0, 0), (5, "revisit", 4, 0),
                          (6, "response", 0, 300_000), (0, "response", 0, 5), (0, "response", 0, 5),
                          (9, "response", 0, 2)])
    some = warc.read(index.where("page_id IN (6, 9)"), folder).collect()
    assert sorted((r.page_id, r.url, len(r.payload)) for r in some) == [(6, "u6", 300_000), (9, "u9", 2)]
    large = warc.write(pages(spark), fresh_path(spark, "warc"), least_bytes=5)
    assert large.where("record_type = 'revisit'").count() == 0


def test_archives_are_plain_gzip(spark):
    folder = fresh_path(spark, "warc")
    index = warc.write(pages(spark), folder).collect()
    fs, root = filesystem(folder)
    for name in {r.file for r in index}:
        with fs.open_input_file(f"{root}/{name}") as source:
            text = gzip.decompress(source.read())
        assert text.count(b"WARC/1.1\r\n") == sum(r.file == name for r in index)


def test_empty_table_and_damage(spark):
    folder = fresh_path(spark, "warc")
    assert warc.read(warc.write(pages(spark, []), folder), folder).count() == 0
    good = warc.record(1, "u", b"one", warc.digest(b"two"), None)
    assert warc.digest(warc.parse(good)[2]) != warc.parse(good)[0]["WARC-Payload-Digest"][5:]
    index = warc.write(pages(spark, [(1, "u", "abc"), (2, "v", "abd")]), folder)
    with pytest.raises(Exception):
        warc.read(index.selectExpr("file", "offset + 1 AS offset", "length"), folder).collect()


def test_archives_are_read_by_many_tasks(spark, tmp_path, monkeypatch):
    from pyspark.sql import functions as F
    monkeypatch.setattr(warc, "RANGE_BYTES", 4096)
    pages = spark.range(600).selectExpr("id AS page_id", "concat('u', id) AS url",
                                        "repeat(sha2(cast(id AS string), 256), 9) AS html")
    index = warc.write(pages.coalesce(1), str(tmp_path))
    found = warc.read(index, str(tmp_path)).withColumn("task", F.spark_partition_id())
    assert found.count() == 600 and found.select("task").distinct().count() > 1

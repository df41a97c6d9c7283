"""WARC archives: round trips, revisits, records within payloads."""

import base64
import hashlib

import pytest
from pyspark.sql import functions as F

from cohortcast.llm import queries, warc
from cohortcast.session import fresh_path
from compare import compare, duck
from conftest import SF_SMALL

END = "\r\n\r\n"
NASTY = [END, "x" + END, "x\r\n", "\r\n", "\r", "a\r\n\r", END + END, "WARC/1.1\r\nContent-Length: 3" + END + "abc" + END, "é 😀", ""]


def digest(text):
    return base64.b32encode(hashlib.sha1((text or "").encode()).digest()).decode()


def expected(rows, min_bytes=0):
    """Brute force: (id, bytes, digest, type, refers_to) of rows with distinct ids."""
    out = []
    for i, text in rows:
        size = len((text or "").encode())
        first = min(j for j, t in rows if (t or "") == (text or ""))
        again = first != i and size >= min_bytes
        out.append((i, size, digest(text), "revisit" if again else "response", first if again else None))
    return sorted(out)


def frame(spark, rows):
    return spark.createDataFrame([(i, f"http://h/{i}", t, "clash", "clash") for i, t in rows],
                                 "page_id long, url string, html string, row string, payload string")


def test_records_are_cut_by_their_length():
    def record(body):
        return f"WARC/1.0\r\nWARC-Type: response\r\ncontent-LENGTH: {len(body.encode())}".encode() + END.encode() + body.encode()
    bodies = NASTY + ["plain", "b" * 100_000]
    for order in (bodies, bodies[::-1]):
        file = b"".join(record(b) + END.encode() for b in order)
        parts = file.split(END.encode())
        parts = parts[:-1] if not parts[-1] else parts  # a reader gives no empty part at the end
        assert [b.decode() for _, b in warc.records(parts)] == order
    with pytest.raises(ValueError):
        list(warc.records([record("abc"), b"abcd"[:2]]))
    with pytest.raises(ValueError):
        list(warc.records([record("abc") + b"d"]))


@pytest.mark.parametrize("min_bytes", [0, 3])
def test_against_brute_force(spark, min_bytes):
    texts = NASTY + ["same"] * 5 + [None, None, "xy", "xy", "z" * 200_000, "z" * 200_000]
    rows = [(100 - 3 * k, t) for k, t in enumerate(texts)]
    got = warc.audit(frame(spark, rows).repartition(5), min_bytes)
    assert got.dtypes == [("page_id", "bigint"), ("payload_bytes", "bigint"), ("payload_digest", "string"),
                          ("record_type", "string"), ("refers_to", "bigint")]
    assert sorted(map(tuple, got.collect())) == expected(rows, min_bytes)


def test_hot_payload_is_split(spark, monkeypatch):
    monkeypatch.setattr(warc, "HOT_ROWS", 7)
    monkeypatch.setattr(warc, "FILE_RECORDS", 10)
    rows = [(k, "hot" if k % 3 == 0 else f"text {k % 50}") for k in range(300)]
    assert sorted(map(tuple, warc.audit(frame(spark, rows)).collect())) == expected(rows)


def test_null_and_repeated_ids(spark):
    rows = [(None, "a"), (None, "a"), (5, "a"), (5, "a"), (None, "b"), (None, "b"), (2, None)]
    got = sorted(((r.page_id, r.record_type, r.refers_to) for r in warc.audit(frame(spark, rows)).collect()), key=str)
    assert got == sorted([(None, "revisit", 5), (None, "revisit", 5), (5, "response", None), (5, "revisit", 5),
                          (None, "response", None), (None, "revisit", None), (2, "response", None)], key=str)


def test_empty_table_and_control_characters(spark):
    assert warc.audit(frame(spark, []).limit(0)).count() == 0
    pages = spark.createDataFrame([(1, "http://h/a b\r\nX-Row-Id: 9", "t"), (2, None, "u")], "page_id long, url string, html string")
    path = warc.write_archive(pages, fresh_path(spark, "warc-test"))
    got = {r.row: (r.uri, r.type, bytes(r.payload)) for r in warc.read_archive(spark, path, payloads=True).collect()}
    assert got == {1: ("http://h/a%20b%20%20X-Row-Id:%209", "response", b"t"), 2: (None, "response", b"u")}


def test_lean_archive_holds_each_payload_once(spark):
    """The second archive, and a third made of it: revisits that stand in an
    archive already are joined to their responses again."""
    rows = [(k, "body %d" % (k % 4)) for k in range(40)]
    whole = warc.write_archive(frame(spark, rows), fresh_path(spark, "warc-test"))
    lean = warc.deduplicate(spark, whole, fresh_path(spark, "warc-test"))
    again = warc.deduplicate(spark, lean, fresh_path(spark, "warc-test"))
    for path in (lean, again):
        held = warc.read_archive(spark, path, payloads=True)
        assert sorted(bytes(r.payload) for r in held.where("type = 'response'").collect()) == [b"body %d" % k for k in range(4)]
        assert held.where("type = 'revisit'").count() == 36
        assert held.select("record_id").distinct().count() == 40
        done = warc.resolve(held.drop("payload"))
        assert done.where((F.col("payload_bytes") != 6) | F.col("payload_bytes").isNull()).count() == 0
        assert done.where("type = 'revisit' and refers_row = row % 4").count() == 36


def test_contradicted_digest_is_an_error(spark):
    path = fresh_path(spark, "warc-test")
    bad = f"WARC/1.1\r\nWARC-Type: response\r\nWARC-Payload-Digest: sha1:{digest('b')}\r\nContent-Length: 5{END}{END}a"
    spark.createDataFrame([(bad,)], "value string").write.option("lineSep", END).text(path)
    with pytest.raises(Exception, match="does not hold the payload"):
        warc.read_archive(spark, path).collect()


def test_query_equals_sql(spark):
    assert compare(spark, duck(SF_SMALL), "op11_warc_revisits", SF_SMALL, queries.op11_warc_revisits, queries.oracle_sql()["op11_warc_revisits"])

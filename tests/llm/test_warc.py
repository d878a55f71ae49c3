"""The content-addressed archive: exact round trips, revisits, damage and odd rows."""

import base64
import hashlib

import pytest

from exhibita.llm import warc
from exhibita.llm.common import new_path

PAGES = "page_id long, url string, html string, sha256 int, record_id string"
ROWS = [
    (5, "http://a/5", "<p>é</p>", 1, "x"),
    (3, "http://a/3", "<p>é</p>", 1, "x"),
    (4, "http://b/4\r\n x", "other", 1, None),
    (7, None, None, None, None),
    (8, "u", "", 2, None),
    (9, "u", "a\r\n\r\nb\r\n\r\nWARC/1.1\r\n", 2, None),
    (9, "u", "a\r\n\r\nb\r\n\r\nWARC/1.1\r\n", 2, None),
    (9, "v", "a\r\n\r\nb\r\n\r\nWARC/1.1\r\n", 2, None),
    (None, "n", "<p>é</p>", 2, None),
    (None, "n", "only here", 2, None),
    (9, "u", "another payload", 2, None),
]


def archived(spark, rows, least=0):
    path = new_path(spark)
    warc.archive_pages(spark.createDataFrame(rows, PAGES), path, least=least)
    return path


def brute(rows):
    out, seen = [], {}
    for i, url, html, *_ in sorted(rows, key=lambda r: (r[0] is None, r[0] or 0, r[1] is None, r[1] or "")):
        p = (html or "").encode()
        digest = base64.b32encode(hashlib.sha1(p).digest()).decode()
        out.append((i, len(p), digest, "revisit" if p in seen else "response", seen.get(p)))
        seen.setdefault(p, i)
    return sorted(out, key=repr)


def found(spark, path):
    rows = warc.read_pages(spark, path).collect()
    number = lambda x: None if x is None else int(x)
    return sorted(((number(r[0]), r[1], r[2], r[3], number(r[4])) for r in rows), key=repr)


def test_pages_come_back_with_digests_and_revisits(spark, monkeypatch):
    path = archived(spark, ROWS)
    assert found(spark, path) == brute(ROWS)
    assert spark.read.parquet(f"{path}/payloads").count() == len({r[2] or "" for r in ROWS})
    # many rows that do not come first: they are joined, not broadcast
    monkeypatch.setattr(warc, "BROADCAST_ROWS", 0)
    monkeypatch.setattr(warc, "REMEMBERED", 1)
    assert found(spark, archived(spark, ROWS)) == brute(ROWS)


def test_small_payloads_are_all_responses(spark):
    rows = found(spark, archived(spark, ROWS, least=10))
    assert {r[3] for r in rows if r[1] < 10} == {"response"}
    assert sum(r[3] == "revisit" for r in rows) == 2


def test_records_are_rebuilt_byte_for_byte_and_pass_through_files(spark):
    path = archived(spark, ROWS)
    records = sorted(bytes(r["record"]) for r in warc.restore(spark, path).collect())
    assert len(records) == len(ROWS) == len(set(records))
    for kind in ("gzip", "none"):
        files = new_path(spark)
        warc.write_warc(warc.restore(spark, path).repartition(3), files, kind)
        read = warc.read_warc(spark, [files]).collect()
        assert sorted(bytes(r["header"]) + bytes(r["payload"]) + b"\r\n\r\n" for r in read) == records
        again = new_path(spark)
        warc.archive_warc(spark, [files], again)
        assert sorted(bytes(r["record"]) for r in warc.restore(spark, again).collect()) == records
        assert found(spark, again) == brute(ROWS)


def test_a_changed_or_missing_payload_is_an_error(spark):
    path = archived(spark, ROWS)
    headers, bodies = spark.read.parquet(f"{path}/headers"), spark.read.parquet(f"{path}/payloads")
    for wrong in (bodies.selectExpr("sha256", "concat(payload, cast('x' AS binary)) AS payload"), bodies.limit(2)):
        other = new_path(spark)
        warc.store(headers, wrong, other)
        with pytest.raises(Exception, match="the payload"):
            warc.restore(spark, other).collect()


def test_a_record_that_is_cut_off_is_an_error(spark, tmp_path):
    (tmp_path / "x.warc").write_bytes(b"WARC/1.1\r\nContent-Length: 10\r\n\r\nabc")
    with pytest.raises(Exception, match="cut off"):
        warc.read_warc(spark, [str(tmp_path / "x.warc")]).collect()


def test_an_empty_table_gives_an_empty_archive(spark):
    assert found(spark, archived(spark, [])) == []


def test_a_payloads_digest_is_worked_out_once(spark):
    path = archived(spark, ROWS)
    digest = spark.createDataFrame([("ab", "0" * 40)], "payload string, hexadecimal string")
    plan = lambda c: digest.select(c)._jdf.queryExecution().optimizedPlan().toString().lower()
    assert plan(warc.base32(warc.F.sha1(warc.F.col("payload").cast("binary"))).alias("x")).count("sha1(") == 1
    assert found(spark, path) == brute(ROWS)


def test_many_repeated_rows(spark):
    rows = [(1, "u", "page " * 50, None, None)] * 500 + [(i, "u", "page " * 50, None, None) for i in range(2, 200)]
    assert found(spark, archived(spark, rows)) == brute(rows)

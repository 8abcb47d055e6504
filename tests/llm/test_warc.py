import base64
import hashlib
import io
import zipfile

import pyarrow as pa

from voltrail.llm import warc_zip as W
from voltrail.llm.store import new_path

ROWS = [(1, "http://a", "same"), (2, "u é\r\n", "same"), (3, None, "same"), (4, "u", None), (5, "u", ""), (6, "u", "é" * 1000), (7, "u", "alone"), (7, "u", "alone"), (8, "u", "x" * 500000)]


def test_round_trip_equals_the_rule(spark):
    pages = spark.createDataFrame(ROWS, "page_id bigint, url string, html string").selectExpr("*", "1 as digest", "2 as payload")
    got = sorted(tuple(r) for r in W.round_trip(pages).collect())
    last = {}
    for i, _, h in ROWS:
        last[h or ""] = max(last.get(h or "", 0), i)
    want = []
    for i, _, h in ROWS:
        p = (h or "").encode()
        first = last[h or ""] == i
        want.append((i, len(p), base64.b32encode(hashlib.sha1(p).digest()).decode(), "response" if first else "revisit", None if first else last[h or ""]))
    assert sorted(got, key=str) == sorted(want, key=str)


def test_payloads_and_null_ids_come_back(spark):
    pages = spark.createDataFrame([(None, None, "a"), (1, "u", "a"), (2, "u", "b\x00\r\n\r\nc")], "page_id bigint, url string, html string")
    got = {r["page_id"]: r for r in W.read_packages(W.write_packages(pages, new_path(spark, "w"))).collect()}
    assert got[2]["payload"] == b"b\x00\r\n\r\nc" and got[None]["record_type"] == "revisit" and got[None]["refers_to"] == 1


def test_empty_table(spark):
    assert W.round_trip(spark.createDataFrame([], "page_id bigint, url string, html string")).count() == 0


def test_packages_are_zip_files_that_others_read():
    out = io.BytesIO()
    p = W.PackageWriter(out)
    for name, data in (("archive/a", [b"abc", b"d" * 70000]), ("indexes/é", [])):
        p.begin(name)
        for d in data:
            p.write(d)
        p.end()
    p.close()
    z = zipfile.ZipFile(io.BytesIO(out.getvalue()))
    assert z.testzip() is None and z.read("archive/a") == b"abc" + b"d" * 70000 and z.read("indexes/é") == b""


def test_directory_of_packages_made_by_others():
    for wide in (False, True):
        out = io.BytesIO()
        with zipfile.ZipFile(out, "w", zipfile.ZIP_STORED) as z:
            with z.open("a.txt", "w", force_zip64=wide) as f:
                f.write(b"hello")
            z.writestr("packed.txt", b"z" * 1000, compress_type=zipfile.ZIP_DEFLATED)
            z.writestr("b.txt", b"more")
            z.comment = b"a comment with PK\x05\x06 inside" * 3
        raw = out.getvalue()
        found = W.directory(pa.BufferReader(raw), len(raw))
        assert set(found) == {"a.txt", "b.txt"}
        assert [raw[a:a + n] for a, n in (found["a.txt"], found["b.txt"])] == [b"hello", b"more"]


def test_directory_of_many_members_is_zip64():
    out = io.BytesIO()
    with zipfile.ZipFile(out, "w", zipfile.ZIP_STORED) as z:
        for i in range(66000):
            z.writestr(f"m{i}", b"")
        z.writestr("last", b"end")
    raw = out.getvalue()
    found = W.directory(pa.BufferReader(raw), len(raw))
    assert len(found) == 66001 and raw[found["last"][0]:][:3] == b"end"

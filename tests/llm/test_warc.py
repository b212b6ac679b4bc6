from __future__ import annotations

import gzip
import hashlib

import pytest

from sheaf.llm import warc

PAGES = "page_id long, url string, html string"


def brute(rows, least=100):
    """Record types from the definition; rows in the order that the smallest wins."""
    first: dict[bytes, int | None] = {}
    out = []
    for i, _, html in sorted(rows, key=lambda r: (r[0] is None, r[0] or 0)):
        data = (html or "").encode()
        again = len(data) >= least and data in first
        out.append((i, len(data), hashlib.sha256(data).hexdigest(), "revisit" if again else "response", first.get(data) if again else None))
        first.setdefault(data, i)
    return sorted(out, key=str)


def rows():
    page = "<p>é " + "x" * 200 + "\r\n\r\nWARC/1.1\r\n\r\n</p>"
    made = [(k, f"http://a.example/{k}", page if k % 3 == 0 else f"{page}{k}") for k in range(60)]
    made += [
        (100, None, None), (101, "http://b/x y\nz", ""), (102, "", "short"), (103, "é", "short"), (None, "http://c", page),
        (None, "http://c", "y" * 150), (104, "http://d", "y" * 150), (104, "http://d", "y" * 150),
        (105, "http://e", "HTTP/1.1 404\r\n\r\nfiledesc://x 0 0 0 1\n" + "z" * 100), (106, "http://f", "w" * 3_000_000),
        (107, "http://g", "é" * 50), (108, "http://h", "é" * 50), (109, "http://i", "e" * 99), (110, "http://j", "e" * 99),
    ]
    return made


@pytest.mark.parametrize("archive_bytes", [1 << 20, 2000])
def test_round_trip(spark, archive_bytes):
    df = spark.createDataFrame([(*r, "x") for r in rows()], PAGES + ", record_type string").repartition(3)
    got = warc.round_trip(df, archive_bytes=archive_bytes)
    own = got.select("page_id", "payload_bytes", "payload_digest", "record_type", "refers_to").collect()
    assert sorted((tuple(r) for r in own), key=str) == brute(rows())


def test_archives_are_plain_formats(spark, tmp_path):
    df = spark.createDataFrame(rows(), PAGES).coalesce(1)
    warc.write_arc(df, str(tmp_path / "arc"), 2000)
    files = sorted((tmp_path / "arc").glob("*.gz"))
    assert len(files) > 5
    versions, n = set(), 0
    for f in files:
        records = list(warc.arc_records(gzip.decompress(f.read_bytes())))
        versions.add(records[0][0]["Version"])
        n += len(records) - 1
    assert versions == {"1", "2"} and n == len(rows())
    warc.convert(spark, str(tmp_path / "arc"), str(tmp_path / "warc"))
    for f in (tmp_path / "warc").glob("*.gz"):
        data = gzip.decompress(f.read_bytes())
        records = list(warc.warc_records(data))
        assert records[0][0]["WARC-Type"] == "warcinfo" and data.endswith(b"\r\n\r\n")
        for head, block in records:
            assert head["WARC-Record-ID"].startswith("<urn:uuid:") and head["WARC-Date"].endswith("Z")
            if head["WARC-Type"] == "response":
                assert head["WARC-Block-Digest"] == "sha256:" + hashlib.sha256(block).hexdigest()


def test_version_blocks_set_the_fields():
    one = b"filedesc://a 0.0.0.0 20000101000000 text/plain 10\n1 0 legacy\nhttp://x 1.2.3.4 20010203040506 text/html 3\nabc\n"
    two = (
        b"filedesc://b 0.0.0.0 20000101000000 text/plain 200 - - 0 b 10\n2 0 legacy\n"
        b"http://y 1.2.3.4 20010203040506 text/html 200 sum loc 7 b 4\nabcd\n"
    )
    found = list(warc.arc_records(one + two))
    assert [b for h, b in found if "Version" not in h] == [b"abc", b"abcd"]
    assert found[3][0]["Result-code"] == "200" and found[3][0]["Checksum"] == "sum"
    assert "Result-code" not in found[1][0]
    made = warc.to_warc(one, "a", {})
    heads = [h for h, _ in warc.warc_records(made + b"\r\n\r\n")]
    assert heads[1]["WARC-Type"] == "resource" and heads[1]["WARC-Date"] == "2001-02-03T04:05:06Z"


def test_bad_records_are_reported_and_stop_nothing():
    data = (
        b"filedesc://a 0.0.0.0 20000101000000 text/plain 10\n1 0 legacy\n"
        b"no header line\nmore of it\n"
        b"http://x/a b?c=d 1.2.3.4 20010203040506 text/html 3\nabc\n"
        b"http://y 1.2.3.4 20010203040506 text/html many\nxyz\n"
        b"http://caf\xe9/ 1.2.3.4 200102 image/png 4\n\x89PN\xff\n"
        b"http://z 1.2.3.4 20010203040506 text/html 30\nabc\n"
    )
    found = list(warc.arc_records(data))
    assert [h.get("URL") for h, _ in found] == ["filedesc://a", None, "http://x/a b?c=d", None, "http://caf\xe9/", None]
    assert [h["Bad"] for h, _ in found if "Bad" in h] == ["3 of 5 fields", "no length", "record of 30 bytes is cut off at 4"]
    assert found[1][1] == b"no header line\nmore of it\n" and found[4][1] == b"\x89PN\xff"
    heads = [h for h, _ in warc.warc_records(warc.to_warc(data, "a", {}) + b"\r\n\r\n")]
    assert [h["WARC-Type"] for h in heads] == ["warcinfo", "metadata", "resource", "metadata", "resource", "metadata"]
    assert heads[2]["WARC-Target-URI"] == "http://x/a%20b?c=d" and heads[4]["WARC-Target-URI"] == "http://caf%E9/"
    assert heads[4]["WARC-Date"] == "2001-02-01T00:00:00Z" and heads[3]["X-Bad-Record"].endswith("no length")


def test_archives_of_any_bytes(spark, tmp_path):
    """Binary payloads, blanks in URLs and bad records in files that others wrote."""
    png = bytes(range(256)) * 3
    http = b"HTTP/1.0 200 OK\r\nContent-Type: image/png\r\nContent-Length: %d\r\nX-Page-Id: %%d\r\n\r\n" % len(png)
    body = b"filedesc://a 0.0.0.0 20000101000000 text/plain 10\n1 0 legacy\n"
    for k in range(3):
        block = http % k + png
        body += b"http://h/a picture %d.png 1.2.3.4 20010203040506 image/png %d\n" % (k, len(block)) + block + b"\n"
    body += b"broken line\n"
    (tmp_path / "arc").mkdir()
    (tmp_path / "arc" / "a.arc.gz").write_bytes(gzip.compress(body))
    warc.convert(spark, str(tmp_path / "arc"), str(tmp_path / "warc"))
    got = {r.page_id: r for r in warc.read_warc(spark, str(tmp_path / "warc")).collect()}
    assert {k: (r.payload_bytes, r.payload_digest, r.record_type, r.refers_to) for k, r in got.items()} == {
        k: (len(png), hashlib.sha256(png).hexdigest(), "revisit" if k else "response", 0 if k else None) for k in range(3)
    }
    bad = warc.bad_records(spark, str(tmp_path / "arc")).collect()
    assert [(r.archive, r.reason.split(": ")[1]) for r in bad] == [("a.arc.gz", "2 of 5 fields")]
    files = list((tmp_path / "warc").glob("*.gz"))
    heads = [h for f in files for h, _ in warc.warc_records(gzip.decompress(f.read_bytes()))]
    again = [h for h in heads if h["WARC-Type"] == "revisit"]
    assert len(again) == 2
    assert all(h["WARC-Refers-To-Target-URI"] == "http://h/a%20picture%200.png" and h["WARC-Refers-To-Date"] == "2001-02-03T04:05:06Z" for h in again)


def test_empty_table(spark):
    assert warc.round_trip(spark.createDataFrame([], PAGES)).count() == 0

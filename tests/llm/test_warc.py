import gzip
import hashlib

import pytest

from turnsieve.llm import warc

from .fixtures import prose

PAGES = "page_id bigint, url string, html string, file string, at bigint"


def pages(spark):
    long = "<p>" + prose(40_000, 1) + "</p>"
    same = "<html>" + prose(40, 2) + "</html>"
    rows = [
        (1, "http://a.example/x", "<p>\r\n\r\nWARC/1.1\r\nContent-Length: 3\r\n\r\n" + prose(30, 3)),
        (2, "http://a.example/with space\nand line", same),
        (3, None, same),
        (4, "http://b.example/", None),
        (5, "http://b.example/", ""),
        (6, "http://b.example/ü", "short"),
        (7, "http://b.example/", "short"),
        (8, "http://b.example/", "ü" * 50),
        (9, "http://b.example/", "ü" * 50),
        (10, "http://c.example/", long),
        (11, "http://c.example/", long),
        (12, "http://c.example/", "x" * 99),
        (13, "http://c.example/", "x" * 99),
        (14, "http://c.example/", "y" * 100),
        (15, "http://c.example/", "y" * 100),
    ]
    df = spark.createDataFrame([(*r, "other", 1) for r in rows], PAGES)
    return df, rows


def test_round_trip(spark):
    df, rows = pages(spark)
    found = {r.page_id: r for r in warc.round_trip(df.repartition(3)).collect()}
    assert len(found) == len(rows)
    first = {}
    for i, _, html in rows:
        raw = (html or "").encode()
        r = found[i]
        assert (r.payload_bytes, r.payload_digest) == (len(raw), hashlib.sha256(raw).hexdigest())
        of = first.setdefault(raw, i) if len(raw) >= 100 else i
        assert (r.record_type, r.refers_to) == (("response", None) if of == i else ("revisit", of))
    assert found[1].url == "http://a.example/x" and found[2].url == "http://a.example/with%20space%0Aand%20line"
    assert found[1].date == "2020-01-01T00:00:00Z"


def test_repeated_rows_and_null_ids(spark):
    html = prose(60, 5)
    df = spark.createDataFrame([(3, "u", html), (3, "u", html), (None, "u", html)], "page_id bigint, url string, html string")
    rows = warc.round_trip(df).collect()
    assert sorted((r.record_type, r.refers_to) for r in rows) == [("response", None), ("revisit", 3), ("revisit", 3)] or sorted(
        (r.record_type, r.refers_to or 0) for r in rows
    ) == [("response", 0), ("revisit", 3), ("revisit", 3)]
    assert len({r.record_id for r in rows}) == 3


@pytest.mark.parametrize("version", [1, 2])
def test_both_versions(version):
    about = f"{version} 0 org\n{warc.ARC_FIELDS[version]}\n"
    rest = "" if version == 1 else "200 abc - 77 f.arc "
    block = b"HTTP/1.0 200 OK\r\nA: b\r\n\r\nline\nhttp://x 0.0.0.0 20010101000000 text/html 5\n"
    file = f"filedesc://f 0.0.0.0 19990203040506 text/plain {rest}{len(about)}\n{about}\n".encode()
    for _ in range(2):
        file += f"http://x/ 1.2.3.4 19990203040506 text/html {rest}{len(block)}\n".encode() + block + b"\n"
    rows = list(warc._converted("f", gzip.compress(file)))
    assert len(rows) == 2
    for (page, url, date, size, digest, _, _, _), head in rows:
        payload = block.partition(b"\r\n\r\n")[2]
        assert (page, url, date, size) == (None, "http://x/", "1999-02-03T04:05:06Z", len(payload))
        assert digest == hashlib.sha256(payload).hexdigest() and head.fields == {"a": "b"}


def test_broken_archives_are_refused():
    about = f"1 0 org\n{warc.ARC_FIELDS[1]}\n"
    head = f"filedesc://f 0.0.0.0 19990203040506 text/plain {len(about)}\n{about}\n"
    for rest in ("http://x/ 1.2.3.4 19990203040506 text/html 50\nshort\n", "http://x/ 19990203040506 3\nabc\n"):
        with pytest.raises(ValueError):
            list(warc.arc_records(gzip.compress((head + rest).encode())))


def test_warc_files_hold_valid_records(spark, tmp_path):
    df, rows = pages(spark)
    warc.write_arc(df.coalesce(1), f"{tmp_path}/arc")
    warc.convert(spark, f"{tmp_path}/arc", f"{tmp_path}/warc")
    seen = []
    for f in (tmp_path / "warc").glob("part-*.gz"):
        for fields, block in warc.warc_records(f.read_bytes()):
            seen.append(fields["WARC-Type"])
            if fields["WARC-Type"] != "warcinfo":
                assert fields["WARC-Block-Digest"] == "sha256:" + hashlib.sha256(block).hexdigest()
                assert ("WARC-Refers-To" in fields) == (fields["WARC-Type"] == "revisit")
    assert seen.count("response") + seen.count("revisit") == len(rows) and "warcinfo" in seen


def test_empty(spark):
    assert warc.round_trip(spark.createDataFrame([], "page_id bigint, url string, html string")).collect() == []

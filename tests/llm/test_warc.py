"""ARC to WARC: round trips, both versions, damaged input."""

import hashlib

import pytest

from shelfline.llm import warc

BIG = "<html>" + "x" * 200


def expected(rows):
    first, out = {}, []
    for page, _, html in sorted(rows, key=lambda r: (r[0] is None, r[0])):
        data = (html or "").encode()
        digest = hashlib.sha256(data).hexdigest()
        to = first.setdefault(digest, page) if len(data) >= 100 else page
        out.append((page, len(data), digest, "response" if to == page else "revisit", None if to == page else to))
    return sorted(out, key=str)


def test_pages_there_and_back(spark):
    rows = [(i, f"https://h{i % 3}.example/{i}", f"page {i} é\r\n\r\n" + "y" * (i * 7)) for i in range(40)]
    rows += [(100 - i, "http://a b\n.example/ü", BIG) for i in range(30)]
    rows += [(200, None, None), (201, "", ""), (202, "u", "short"), (203, "u", "short"), (204, "u", "z" * 500_000), (205, "u", "HTTP/1.1 200 OK\r\n\r\n" + "b" * 90)]
    pages = spark.createDataFrame([(*r, "digest", 1) for r in rows], "page_id bigint, url string, html string, digest string, bytes bigint").repartition(3)
    got = warc.archived_pages(pages)
    assert got.columns == ["page_id", "payload_bytes", "payload_digest", "record_type", "refers_to"]
    assert sorted((tuple(r) for r in got.collect()), key=str) == expected(rows)


def test_repeated_rows_null_keys_and_nothing(spark):
    pages = spark.createDataFrame([(5, "u", BIG), (5, "u", BIG), (None, "u", BIG)], "page_id bigint, url string, html string")
    got = sorted((r.page_id or 0, r.record_type, r.refers_to) for r in warc.archived_pages(pages).collect())
    assert [g[1:] for g in got] == [("revisit", 5), ("response", None), ("revisit", 5)] and got[0][0] == 0
    assert warc.archived_pages(pages.limit(0)).count() == 0


@pytest.mark.parametrize("version", [1, 2])
def test_arc_versions(version):
    contents = [b"HTTP/1.0 200 OK\r\n\r\nbody\nhttp://x 0.0.0.0 20200101000000 text/html 3\n", b"", b"\n\n", b"plain"]
    data = bytearray(warc.arc_version_block(version, "a.arc"))
    for i, content in enumerate(contents):
        data += warc.arc_record(version, "a.arc", len(data), f"http://e.example/{i}", content, date="20200102")
    found = list(warc.arc_records(bytes(data)))
    # A content of line breaks only is taken by its declared length.
    assert [c for _, _, c in found] == contents
    assert [f["URL"] for _, f, _ in found] == [f"http://e.example/{i}" for i in range(4)]
    assert warc.iso_date(found[0][1]["Archive-date"]) == "2020-01-02T00:00:00Z"
    assert ("Checksum" in found[0][1]) == (version == 2)


def test_damaged_archives():
    data = warc.arc_version_block(1, "a.arc") + warc.arc_record(1, "a.arc", 0, "http://e", b"12345")
    for bad, why in ((data[:-4], "cut off"), (data[data.index(b"http://e") :], "version block"), (data + b"http://e no length\n", "no length"), (data + b"half", "no header")):
        with pytest.raises(ValueError, match=why):
            list(warc.arc_records(bad))
    other = data + warc.arc_record(2, "a.arc", 0, "http://e", b"1")
    with pytest.raises(ValueError, match="header fields"):
        list(warc.arc_records(other))
    record = warc.warc_record("response", [("WARC-Record-ID", "<urn:uuid:1>")], b"block")
    assert [b for _, b in warc.warc_records(record + record)] == [b"block", b"block"]
    with pytest.raises(ValueError, match="cut off"):
        list(warc.warc_records(record[:-3]))


def test_compressed_or_not():
    data = [warc.arc_version_block(1, "a.arc"), warc.arc_record(1, "a.arc", 0, "http://e", b"12345")]
    packed = b"".join(warc.gzipped(d, 1) for d in data)
    assert warc.unzipped(packed) == warc.unzipped(b"".join(data)) == b"".join(data)
    with pytest.raises(ValueError, match="cut off"):
        warc.unzipped(packed[:-3])


def test_identifiers_repeat():
    assert warc.record_id("a.arc", 7) == warc.record_id("a.arc", 7) != warc.record_id("a.arc", 8)

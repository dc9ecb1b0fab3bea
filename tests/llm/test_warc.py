import gzip

import pytest
from pyspark.sql import functions as F

from marquee.llm import warc

PAYLOAD = b"x" * 50 + b"\r\n\r\nWARC/1.1\r\nContent-Length: 5\r\n\r\n\x00\xff" + b"y" * 60


def test_header_lines_of_both_versions():
    one = warc.parse_arc(b"http://a/ 1.2.3.4 20010203040506 text/html 5\nab\ncd\n")
    assert (one["url"], one["date"], one["payload"]) == ("http://a/", "20010203040506", b"ab\ncd")
    two = warc.parse_arc(b"http://a/ 1.2.3.4 20010203040506 text/html 200 - - 0 f.arc 2\nab\n")
    assert (two["status"], two["file"], two["payload"]) == ("200", "f.arc", b"ab")
    for wrong in (b"http://a/ x 3\nabc\n", b"http://a/ 1.2.3.4 20010203040506 text/html 50\nab\n"):
        with pytest.raises(ValueError):
            warc.parse_arc(wrong)


def test_dates():
    assert warc.warc_date("20010203040506") == "2001-02-03T04:05:06Z"
    assert warc.warc_date("200102") == "2001-02-01T00:00:00Z"


@pytest.mark.parametrize("version", [1, 2])
@pytest.mark.parametrize("codec", ["none", "gzip"])
def test_payloads_come_back_whole(spark, tmp_path, version, codec):
    pages = spark.createDataFrame([(1, "http://a b/", PAYLOAD), (2, "", PAYLOAD), (3, None, b""), (4, "u", b"short")],
                                  "page_id bigint, url string, body binary")
    records = warc.convert(warc.arc_records(pages, "page_id", "url", F.col("body"), version))
    path = str(tmp_path / "warc")
    warc.write_archives(warc.warc_records(records, warc.revisits(records)), path, codec, per_file=2)
    found = {r.key: r for r in warc.read_archives(spark, path).collect()}
    assert {k: (r.record_type, r.refers_to) for k, r in found.items()} == {
        "1": ("response", None), "2": ("revisit", "1"), "3": ("response", None), "4": ("response", None)}
    assert bytes(found["1"].payload) == PAYLOAD and found["2"].payload_bytes == len(PAYLOAD)
    assert found["2"].payload_digest == found["1"].payload_digest
    assert found["1"].url == "http://a%20b/" and found["3"].url == "-"


def test_archives_are_split_by_length_alone():
    record = b"WARC/1.1\r\nWARC-Type: response\r\nContent-Length: %d\r\n\r\n%s\r\n\r\n"
    data = record % (len(PAYLOAD), PAYLOAD) + record % (0, b"")
    assert [b for _, b in warc.split_archive(data)] == [PAYLOAD, b""]
    members = b"".join(gzip.compress(record % (len(PAYLOAD), PAYLOAD)) for _ in range(3))
    assert [b for _, b in warc.split_archive(members)] == [PAYLOAD] * 3
    with pytest.raises(ValueError):
        list(warc.split_archive(data[:-6]))


def test_identifiers_do_not_change():
    assert warc.record_id("a", "b") == warc.record_id("a", "b") != warc.record_id("a", "c")


def test_awkward_rows(awkward, nothing):
    found = warc.round_trip(awkward, "doc_id", "source", "text").collect()
    assert len(found) == awkward.count()
    kinds = sorted((r.doc_id, r.record_type, r.refers_to) for r in found if r.doc_id in (1, 2, 3, 4))
    assert kinds == [(1, "response", None), (2, "revisit", 1), (2, "revisit", 1), (3, "response", None), (4, "response", None)]
    assert warc.round_trip(nothing, "doc_id", "source", "text").count() == 0

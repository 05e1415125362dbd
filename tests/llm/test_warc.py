"""WARC archives: an exact round trip, revisits, one member per record, cut files."""
import glob
import gzip
import hashlib
import io
import zlib

import pytest

from fleetlake.llm import warc

PAGES = "page_id bigint, url string, html string, payload string, path string, n int"


def _pages(spark, rows):
    return spark.createDataFrame([(*r, "p", "q", 1) for r in rows], PAGES)


@pytest.mark.parametrize("broadcast", [0, 1000])
def test_round_trip(spark, scratch, monkeypatch, broadcast):
    monkeypatch.setattr(warc, "BROADCAST_REVISITS", broadcast)
    big, other = "é<p>" * 60, "WARC/1.1\r\n\r\n" * 40
    rows = [(5, "http://a/", big), (3, "http://b/ x\r\ny", big), (9, None, big), (4, "", other), (6, "not a url", other), (1, "http://c", None), (2, "http://d", ""),
            (7, "http://e", "small"), (8, "http://f", "small"), (None, "http://g", big), (5, "http://a/", big)]
    folder = scratch
    got = warc.archived_pages(_pages(spark, rows).repartition(3), folder, with_payload=True).collect()
    assert len(got) == len(rows)
    text = {i: (h or "").encode() for i, _, h in rows}
    for r in got:
        p = text[r["page_id"]]
        assert r["payload_bytes"] == len(p) and r["payload_digest"] == hashlib.sha256(p).hexdigest()
        revisit = {5: 3, 9: 3, 6: 4, None: 3}.get(r["page_id"])
        assert (r["record_type"], r["refers_to"]) == (("revisit", revisit) if revisit else ("response", None))
        assert r["payload"] == (None if revisit else p)
    # every indexed member is a gzip file of its own with one record; the monolithic file is one stream
    for path in glob.glob(f"{folder.removeprefix('file:')}/members/*.idx"):
        data = open(path.removesuffix(".idx"), "rb").read()
        at = 0
        for line in open(path):
            offset, length, record = line.split()
            assert int(offset) == at
            at += int(length)
            assert gzip.decompress(data[int(offset):at]).count(b"WARC-Record-ID") == 1 and record.startswith("urn:page:")
        assert at == len(data)
    for path in glob.glob(f"{folder.removeprefix('file:')}/monolithic/*.gz"):
        one = zlib.decompressobj(31)
        one.decompress(open(path, "rb").read())
        assert one.eof and not one.unused_data


def test_no_pages(spark, scratch):
    assert warc.archived_pages(_pages(spark, []), scratch).count() == 0


def test_a_cut_stream_is_an_error():
    data = zlib.compressobj(6, zlib.DEFLATED, 31)
    whole = data.compress(warc.record_bytes(1, "http://a", b"x" * 500, "d", None)) + data.flush()

    class File(io.BytesIO):
        def size(self):
            return len(self.getvalue())
    assert len(list(warc.records(io.BufferedReader(warc._Inflated(File(whole)))))) == 1
    with pytest.raises((EOFError, zlib.error)):
        list(warc.records(io.BufferedReader(warc._Inflated(File(whole[:-40])))))


def test_payloads_of_rows_without_an_id(spark, scratch):
    rows = [(None, "http://a", "x" * 200), (None, "http://b", "x" * 200), (None, "http://c", "y" * 200), (2, "http://d", "y" * 200)]
    got = {r["url"]: (r["record_type"], r["refers_to"]) for r in warc.with_revisits(_pages(spark, rows)).selectExpr("url", "if(refers_to is null, 'response', 'revisit') record_type", "refers_to").collect()}
    assert got == {"http://a": ("response", None), "http://b": ("response", None), "http://c": ("revisit", 2), "http://d": ("response", None)}

"""Round trips through WARC archives."""

import gzip
import io
import zlib

import pytest
from llm_helpers import prose

from stayline.llm import warc


@pytest.fixture(scope="module")
def pages(spark):
    html = [None, "", "<p>a</p>", "<p>a</p>", "é" * 50, prose(1, 40_000), "<p>a</p>", "\r\n\r\nWARC/1.0\r\n", None]
    rows = [(i, f"http://x.example/{i}?q=ü b" if i % 3 else None, h, "x") for i, h in enumerate(html)]
    return spark.createDataFrame([*rows, (None, "u", "<p>b</p>", "x"), (2, "u", "<p>a</p>", "x")], "page_id long, url string, html string, file string").repartition(3)


def expected(rows, least=0):
    first = {}
    for r in rows:
        p = r["html"] or ""
        if r["page_id"] is not None and len(p.encode()) >= least:
            first[p] = min(first.get(p, r["page_id"]), r["page_id"])
    out = []
    for r in rows:
        p = r["html"] or ""
        to = first.get(p)
        other = to is not None and to != r["page_id"]
        out.append((r["page_id"], len(p.encode()), warc.base32_sha1(p.encode()), "revisit" if other else "response", to if other else None))
    return sorted(out, key=str)


@pytest.mark.parametrize("least,step", [(0, 4 << 20), (0, 101), (9, 1_000)])
def test_round_trip(pages, least, step):
    rows = warc.archive_and_read(pages, least, with_payload=True, range_bytes=step).collect()
    number = lambda x: None if x is None else int(x)
    got = [(number(r["page_id"]), r["payload_bytes"], r["payload_digest"], r["record_type"], number(r["refers_to"])) for r in rows]
    assert sorted(got, key=str) == expected(pages.collect(), least)
    texts = {(r["page_id"], r["html"] or "") for r in pages.collect()}
    assert all((number(r["page_id"]), bytes(r["payload"]).decode()) in texts for r in rows if r["record_type"] == "response")


def test_no_pages(pages):
    assert warc.archive_and_read(pages.limit(0)).count() == 0


def test_ranges_own_the_records_that_start_in_them():
    """False magics inside stored data are passed over, whatever the borders."""
    noise = bytes(range(256)) * 3 + warc.MAGIC * 5 + gzip.compress(b"not a record") + b"WARC/1.0"
    members = []
    for i in range(6):
        packer = zlib.compressobj(0, zlib.DEFLATED, 31)
        block = noise * (i + 1)
        members.append(packer.compress(b"WARC/1.0\r\nWARC-Type: resource\r\nX-N: %d\r\nContent-Length: %d\r\n\r\n" % (i, len(block)) + block + b"\r\n\r\n") + packer.flush())
    data = b"".join(members)
    for size in (7, 64, 1_000, len(data)):
        seen = [
            int(f["x-n"]) for lo in range(0, len(data), size)
            for f, _ in warc.records_in_range(io.BytesIO(data), lo, min(lo + size, len(data)))
        ]
        assert seen == list(range(6)), size


def test_a_damaged_payload_is_an_error():
    fields = {"warc-type": "response", "warc-payload-digest": "sha1:AAAA"}
    with pytest.raises(ValueError):
        warc.parse_record(fields, b"HTTP/1.1 200 OK\r\n\r\nbody", True)
    cut = warc.member("1", None, b"payload", None)[:-9]
    with pytest.raises(EOFError):
        list(warc.records_in_range(io.BytesIO(cut), 0, len(cut)))

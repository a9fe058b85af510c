"""The WARC reader as a stream: framing, digests and pieces in bounded memory."""

import hashlib
import io
import tracemalloc
import zlib

import pytest

from hopscope.llm import warc
from hopscope.llm.common import fresh_path


def member(text: bytes) -> bytes:
    pack = zlib.compressobj(5, zlib.DEFLATED, 31)
    return pack.compress(text) + pack.flush()


def test_a_long_record_in_bounded_memory():
    data = warc.record(1, "u", bytes(200_000_000), None) + warc.record(2, "u", b"after", None)
    tracemalloc.start()
    seen = []
    for fields, _, pieces in warc.records(io.BytesIO(data)):
        sha, n = hashlib.sha1(), 0
        for piece in pieces:
            assert len(piece) <= warc.CHUNK
            sha.update(piece)
            n += len(piece)
        seen.append((n, sha.hexdigest()))
    peak = tracemalloc.get_traced_memory()[1]
    tracemalloc.stop()
    assert [n for n, _ in seen] == [200_000_000, 5] and peak < 4_000_000
    assert seen[1][1] == hashlib.sha1(b"after").hexdigest()


def test_pieces_that_are_left_are_checked():
    good = warc.record(1, "u", b"x" * 300_000, None)
    assert [f["warc-type"] for f, _, _ in warc.records(io.BytesIO(good + good))] == ["response"] * 2
    text = zlib.decompress(good, 31)
    bad = text[:-10] + b"y" + text[-9:]
    with pytest.raises(warc.WarcError, match="digest"):
        for _ in warc.records(io.BytesIO(member(bad))):
            pass


@pytest.mark.parametrize("change", [lambda t: t[:-1], lambda t: t + b"x", lambda t: t[:-4], lambda t: t + b"y" * 200_000, lambda t: t[:40], lambda t: b"", lambda t: t.replace(b"WARC/", b"HTTP/")])
def test_framing_faults(change):
    text = zlib.decompress(warc.record(1, "u", b"payload", None), 31)
    with pytest.raises(warc.WarcError):
        list(warc.records(io.BytesIO(member(change(text)))))


def test_headers_across_chunks(monkeypatch):
    data = warc.record(1, "u" * 50, b"payload\r\n\r\nmore", None) + warc.record(2, "u", b"", (1,))
    for size in (1, 2, 3, 5, 64):
        monkeypatch.setattr(warc, "CHUNK", size)
        got = [(f["warc-type"], b"".join(p)) for f, _, p in warc.records(io.BytesIO(data))]
        assert got == [("response", b"payload\r\n\r\nmore"), ("revisit", b"")]


def test_bodies_round_trip(spark):
    pages = [(1, "a", "é" * 100_000), (2, "b", ""), (3, None, None), (4, "c", "\r\n\r\n")]
    df = spark.createDataFrame(pages, "page_id long, url string, html string")
    files = warc.write_archives(df, fresh_path(spark, "test"), min_bytes=1)
    want = {i: (h or "").encode() for i, _, h in pages}
    assert {r["page_id"]: bytes(r["body"]) for r in warc.read_archives(files).collect()} == want
    rows = sorted((r["page_id"], r["piece"], bytes(r["body"])) for r in warc.read_pieces(files).collect())
    assert {i: b"".join(b for j, _, b in rows if j == i) for i in want} == want

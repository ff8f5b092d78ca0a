import base64
import hashlib
import struct

import pyarrow.fs
import pytest
import zstandard

from civicflow.llm import warc
from tests.llm.helpers import SF, sf, tuples

PAGES = "page_id bigint, url string, html string"
COLS = ("page_id", "url", "payload_bytes", "payload_digest", "record_type", "refers_to")


def expected(pages, least=0):
    first = {}
    for p, _, h in pages:
        if p is not None and len((h or "").encode()) >= least:
            first[h or ""] = min(first.get(h or "", p), p)
    out = []
    for p, u, h in pages:
        raw = (h or "").encode()
        ref = first.get(h or "") if len(raw) >= least else None
        ref = None if ref == p else ref
        out.append((p, u, len(raw), base64.b32encode(hashlib.sha1(raw).digest()).decode(), "response" if ref is None else "revisit", ref))
    return sorted(out, key=lambda t: tuple((v is None, v) for v in t))


def edge():
    same = "<p>" + "same body " * 50 + "</p>"
    return [(4, "http://a/", same), (2, "http://b/?q=1", same), (9, None, same), (None, "http://c/", same), (5, "http://d/é\r\nX-Bad: 1", "ü ñ 日本"),
            (6, "http://e", None), (7, "http://f", ""), (8, "http://g", "x" * 300_000), (10, "http://h", "WARC/1.1\r\n\r\nHTTP/1.1 \r\n\r\n"),
            (2, "http://b/?q=1", same), (None, None, None), (11, "http://i", "line\r\n\r\n" * 10)]


@pytest.mark.parametrize("least", [0, 400, 10**6])
def test_round_trip(spark, least):
    df = spark.createDataFrame(edge(), PAGES)
    for c in ("sha", "first", "path", "size"):
        df = df.withColumn(c, df.page_id)
    got = tuples(warc.read_archives(warc.write_archives(df, least_bytes=least)), *COLS)
    want = expected(edge(), least)
    clean = lambda rows: [tuple(v if k != 1 or v is None or "X-Bad" not in v else "bad" for k, v in enumerate(r)) for r in rows]
    assert clean(got) == clean(want)


def test_tables(spark):
    pages = sf(spark, "pages")
    assert tuples(warc.read_archives(warc.write_archives(pages)), *COLS) == expected([tuple(r) for r in pages.select("page_id", "url", "html").collect()])


def test_layout_and_full_payloads(spark, monkeypatch):
    """A leading frame with the dictionary, then one frame per record that opens alone."""
    pages = {r.page_id: r.html for r in sf(spark, "pages").collect()}
    writer_rows, folder = [], None
    import tempfile
    folder = tempfile.mkdtemp(prefix="civicflow-warc-")
    w = warc.ArchiveWriter(folder, "t")
    monkeypatch.setattr(warc, "SAMPLE_BYTES", 20_000)
    monkeypatch.setattr(warc, "FILE_BYTES", 60_000)
    for p, h in pages.items():
        digest = base64.b32encode(hashlib.sha1(h.encode()).digest()).decode()
        writer_rows += w.add(warc.record_bytes(p, f"http://x/{p}", h.encode(), digest, None))
    writer_rows += w.close()
    assert len(writer_rows) > 1 and sum(r[1] for r in writer_rows) == len(pages)
    seen = {}
    for path, records, size, dict_bytes in writer_rows:
        raw = open(path, "rb").read()
        magic, n = struct.unpack("<II", raw[:8])
        assert (magic, n, size) == (0x184D2A5D, dict_bytes, len(raw))
        d = zstandard.ZstdCompressionDict(raw[8:8 + n])
        at, frames = 8 + n, 0
        while at < len(raw):
            dec = zstandard.ZstdDecompressor(dict_data=d).decompressobj()
            record = dec.decompress(raw[at:])
            at = len(raw) - len(dec.unused_data)
            head, _, block = record.partition(b"\r\n\r\n")
            page = int(head.split(b"<urn:page:")[1].split(b">")[0])
            seen[page] = block.partition(b"\r\n\r\n")[2][:-4].decode()
            frames += 1
        assert frames == records
    assert seen == pages


def test_damage_is_noticed(spark):
    df = spark.createDataFrame(edge()[:3], PAGES)
    path = warc.write_archives(df).where("records > 0").first().path
    _, inner = warc.filesystem(path)
    raw = bytearray(open(inner, "rb").read())
    raw[-3] ^= 1
    open(inner, "wb").write(raw)
    with pytest.raises(Exception):
        list(warc.read_archive(path))


def test_empty_table(spark):
    manifest = warc.write_archives(spark.createDataFrame([], PAGES))
    assert manifest.collect() == [] and warc.read_archives(manifest).collect() == []

"""WARC archives: every record by its offset, repeated payloads, damaged files."""

import gzip
import io
import json
import random
import re

import pytest

from snapwatch.llm import warc
from snapwatch.llm.tables import Tables

PAGES = "page_id long, url string, html string, archive string, number long, payload_digest string, revisits int"
LONG = "ünï\r\n\r\nWARC/1.1\r\n" * 100_000
ROWS = [
    (1, "https://a.example/1", "same"),
    (2, "https://a.example/2", "other"),
    (3, "https://a.example/3", "same"),
    (9, None, ""),
    (4, "", None),
    (5, "https://a.example/5?q=\r\nWARC-Type: bad", LONG),
    (6, "https://a.example/ü", LONG),
    (7, "x", "WARC/1.1\r\n\r\n"),
    (8, "x", "same"),
    (8, "x", "same"),
    (None, "x", "same"),
    (None, "x", "alone"),
    (10, "x", "\x00\r\n\r\n"),
]


def made(spark, rows):
    return spark.createDataFrame([(*r, "a", 1, "d", 2) for r in rows], PAGES)


def brute(rows, least=0):
    """(page_id, payload, digest, type, refers to): the response of equal payloads is the one of the largest id."""
    out, groups = [], {}
    for page, _, html in rows:
        groups.setdefault((html or "").encode(), []).append(page)
    for payload, pages in groups.items():
        pages.sort(key=lambda p: (p is not None, p or 0), reverse=True)
        for place, page in enumerate(pages):
            repeat = place > 0 and len(payload) >= least
            out.append((page, len(payload), warc.payload_digest(payload), "revisit" if repeat else "response", pages[0] if repeat else None))
    return sorted(out, key=str)


@pytest.mark.parametrize(("size", "least"), [(64 << 20, 0), (64 << 20, 5), (300, 0)])
def test_pages_come_back(spark, monkeypatch, size, least):
    monkeypatch.setattr(warc, "ARCHIVE_BYTES", size)
    got = warc.archive_pages(made(spark, ROWS).repartition(3), least).collect()
    told = [(r.page_id, r.payload_bytes, r.payload_digest, r.record_type, r.refers_to) for r in got]
    assert sorted(told, key=str) == brute(ROWS, least)
    texts = {(p, (h or "").encode()) for p, _, h in ROWS}
    assert all((r.page_id, bytes(r.payload)) in texts if r.record_type == "response" else r.payload is None for r in got)
    ids = [r.record_id for r in got]
    assert len(set(ids)) == len(ids) and {r.refers_to_id for r in got if r.refers_to_id} <= set(ids)
    assert {r.url for r in got if r.page_id == 5} == {"https://a.example/5?q=%0D%0AWARC-Type: bad"}


def test_no_pages(spark):
    assert warc.archive_pages(made(spark, [])).collect() == []


def test_files(spark):
    """Archives are one member before, one member for each record after; sidecars find records in any order."""
    tables = Tables(spark, "warc-test")
    folder = f"{tables.folder}/archives"
    records = tables.keep(warc.write_archives(made(spark, ROWS).coalesce(1), folder))
    names = [r.archive for r in records.select("archive").distinct().collect()]
    assert len(names) == 1
    plain = open(f"{folder}/{names[0]}", "rb").read()
    inflate = warc.zlib.decompressobj(31)
    whole = inflate.decompress(plain)
    assert inflate.eof and not inflate.unused_data and whole.count(b"WARC-Record-ID") == len(ROWS) + 1
    normal = tables.keep(warc.normalise_archives(tables.keep(warc.revisits_of(records)), folder)).collect()
    file = open(f"{folder}/{normal[0].archive}", "rb")
    entries = [json.loads(line) for line in open(f"{folder}/{normal[0].sidecar}")]
    assert [e["offset"] for e in entries] == [sum(e["length"] for e in entries[:i]) for i in range(len(entries))]
    assert normal[0].records == len(entries) == len(ROWS) + 1 and normal[0].bytes == len(file.read())
    random.Random(1).shuffle(entries)
    for entry in entries:
        file.seek(entry["offset"])
        alone = gzip.decompress(file.read(entry["length"]))
        head, _, rest = alone.partition(b"\r\n\r\n")
        length = int(re.search(rb"Content-Length: (\d+)", head)[1])
        assert head.startswith(b"WARC/1.1\r\n") and rest[length:] == b"\r\n\r\n" and entry["id"].encode() in head
        if entry["type"] != "warcinfo":
            assert warc.read_record(file, entry, True)[3] == entry["id"]


def record(text, kind="resource", digest=None):
    head = {"WARC-Type": kind, "WARC-Record-ID": "<urn:x:1>", "Content-Length": str(len(text))}
    return warc.record_head(head | ({"WARC-Payload-Digest": f"sha1:{digest}"} if digest else {})) + text + b"\r\n\r\n"


def normalised(data, piece=7):
    out = io.BytesIO()
    return list(warc.normalise((data[i : i + piece] for i in range(0, len(data), piece)), out.write, {})), out.getvalue()


def test_members_of_any_kind_are_rewritten():
    texts = [b"a", b"", b"\r\n\r\n" * 999, b"z" * 3_000_000]
    for packed in (gzip.compress(b"".join(map(record, texts))), b"".join(gzip.compress(record(t)) for t in texts)):
        entries, out = normalised(packed, 1000)
        cut = [gzip.decompress(out[e["offset"] : e["offset"] + e["length"]]) for e in entries]
        assert cut == [record(t) for t in texts]
    assert normalised(b"") == ([], b"")


def test_damaged_files_are_refused():
    good = record(b"HTTP/1.1 200 OK\r\n\r\npayload", "response", warc.payload_digest(b"payload"))
    assert len(normalised(gzip.compress(good))[0]) == 1
    wrong = record(b"HTTP/1.1 200 OK\r\n\r\nPayload", "response", warc.payload_digest(b"payload"))
    longer = good.replace(b"Content-Length: 26", b"Content-Length: 20")
    for bad in (gzip.compress(good)[:-9], gzip.compress(good[:-30]), gzip.compress(wrong), gzip.compress(longer), gzip.compress(b"x" + good)):
        with pytest.raises(ValueError):
            normalised(bad)

"""WARC: exact round trips, and what is found in damaged archives."""

import hashlib
import random

import pyarrow as pa
import pytest

from vaultwatch.llm import warc
from vaultwatch.llm.shared_files import new_folder, open_folder

SCHEMA = "page_id long, url string, html string, digest string, refers_to string"


def records_of(data):
    return list(warc.salvage(warc.Source(pa.BufferReader(data))))


def archive(n, zipped):
    made = [warc.record(i, f"http://h/{i}", random.Random(i).randbytes(40 * i + 1), None) for i in range(n)]
    return [warc.member(r) if zipped else r for r in made]


@pytest.mark.parametrize("zipped", [True, False])
def test_sound_archive_has_no_gaps(zipped):
    parts = archive(30, zipped)
    found = records_of(b"".join(parts))
    assert [r[1] for r in found] == [len(p) for p in parts] and all(r[4] is None for r in found)


@pytest.mark.parametrize("zipped", [True, False])
@pytest.mark.parametrize("harm", ["flip", "cut", "insert", "head", "tail"])
def test_later_records_are_recovered(zipped, harm):
    parts = archive(12, zipped)
    bad = 5
    if harm == "flip":
        middle = len(parts[bad]) - 30
        parts[bad] = parts[bad][:middle] + bytes([parts[bad][middle] ^ 255]) + parts[bad][middle + 1 :]
    elif harm == "cut":
        parts[bad] = parts[bad][: len(parts[bad]) // 2]
    elif harm == "insert":
        parts[bad] = b"junk WARC/1.0 \x1f\x8b\x08 junk"
    elif harm == "head":
        parts[bad] = b"\x00" * 9 + parts[bad][9:]
    else:
        bad, parts[11] = 11, parts[11][:-7]
    found = records_of(b"".join(parts))
    assert [warc._page(r[2], "warc-record-id") for r in found if r[2]] == [i for i in range(12) if i != bad]
    gaps = [(r[0], r[1]) for r in found if r[2] is None]
    assert gaps == [(sum(map(len, parts[:bad])), len(parts[bad]))]


def test_records_larger_than_a_window(monkeypatch):
    monkeypatch.setattr(warc, "WINDOW", 1 << 13)
    parts = [warc.member(warc.record(i, None, random.Random(i).randbytes(60_000), None)) for i in range(4)]
    parts[1] = parts[1][:30_000]
    found = records_of(b"".join(parts))
    assert [len(r[3]) - len(warc.HTTP_HEAD) for r in found if r[2]] == [60_000] * 3


def wanted(rows):
    best = {}
    for page_id, _, html, *_ in rows:
        if html and len(html.encode()) >= 1000 and page_id is not None:
            best[html] = max(page_id, best.get(html, page_id))
    out = []
    for page_id, _, html, *_ in rows:
        payload = (html or "").encode()
        first = best.get(html) if len(payload) >= 1000 else None
        again = first is not None and page_id is not None and page_id != first
        out.append((page_id, len(payload), hashlib.sha1(payload).hexdigest(), "revisit" if again else "response", first if again else None))
    return sorted(out, key=str)


def test_tables(spark):
    rows = [(i, f"http://h/{i}", "é" * (i % 7 * 100) + "x" * (i % 3), "clash", "clash") for i in range(80)]
    rows += [(100, None, None, None, None), (101, "a b\r\nc", "", None, None), (None, "n", "y" * 1500, None, None), (102, "n", "y" * 1500, None, None), (103, "n", "y" * 1500, None, None)]
    rows += [(103, "n", "y" * 1500, None, None), (3, "again", "other", None, None), (104, "n", "z" * 300_000, None, None)]
    pages = spark.createDataFrame(rows, SCHEMA).repartition(5)
    assert sorted((tuple(r) for r in warc.roundtrip(pages).collect()), key=str) == wanted(rows)
    assert warc.roundtrip(pages.limit(0)).collect() == []


def test_payloads_and_gaps_of_tables(spark):
    pages = spark.createDataFrame([(i, "u", f"page {i} " * i, None, None) for i in range(20)], SCHEMA).coalesce(1)
    folder = new_folder(spark, "test-warc")
    listed = warc.write(pages, folder)
    files, home = open_folder(folder)
    name = listed.collect()[0].file
    with files.open_input_file(f"{home}/{name}") as file:
        data = bytearray(file.read())
    spots = [r[0] for r in records_of(bytes(data))]
    data[spots[7] + 15] ^= 0xFF
    with files.open_output_stream(f"{home}/{name}", compression=None) as out:
        out.write(bytes(data))
    got = warc.read(listed, folder).collect()
    assert {r.page_id: bytes(r.payload).decode() for r in got if not r.gap} == {i: f"page {i} " * i for i in range(20) if i != 7}
    assert [(r.offset, r.length) for r in got if r.gap] == [(spots[7], spots[8] - spots[7])]

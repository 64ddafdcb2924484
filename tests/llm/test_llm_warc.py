import hashlib
import io

import pytest
import zstandard

from orderloom.llm import warc

BIG = "<p>" + "shared body " * 200


def _pages(spark, rows):
    return spark.createDataFrame(
        [(*r, "extra", 5) for r in rows],
        "page_id long, url string, html string, record_type string, refers_to int")


ROWS = [(1, "http://a/1", BIG), (2, "http://a/2", BIG), (3, None, "short"), (4, "http://b x/\n",
        "short"), (5, "http://c", None), (6, "http://c", "é" * 700), (7, "u", BIG + "!"),
        (8, "u", "é" * 700), (8, "u", "é" * 700), (None, "u", BIG), (None, None, None)]


def test_records_read_back(spark):
    pages = _pages(spark, ROWS)
    archives, folder = warc.archive_pages(pages)
    found = warc.read_archives(archives, folder, with_payload=True).collect()
    seen = sorted((r.page_id or 0, r.record_type, r.refers_to or 0, r.payload_bytes,
                   r.payload_digest, r.payload and bytes(r.payload)) for r in found)
    expected = []
    for page, _, html in ROWS:
        data = (html or "").encode()
        stored = {BIG: 2, "é" * 700: 8}.get(html, page)
        refers = stored if stored != page else 0
        expected.append((page or 0, "revisit" if refers else "response", refers, len(data),
                         hashlib.sha1(data).hexdigest(), None if refers else data))
    assert [r[:5] for r in seen] == [r[:5] for r in sorted(expected, key=lambda r: r[:5])]
    assert {r[:5]: r[5] or None for r in seen} == {r[:5]: r[5] or None for r in expected}


def test_archive_has_dictionary_and_single_frames(spark):
    rows = [(i, f"http://h/{i}", f"<html><body><p>page {i} " + f"words of page {i} " * 80)
            for i in range(300)]
    pages = _pages(spark, rows)
    dictionary = warc.train_dictionary(pages)
    assert len(dictionary) > 1000
    archives, folder = warc.archive_pages(pages.coalesce(1))
    [row] = archives.collect()
    store, path = warc._store(folder)
    data = store.open_input_stream(f"{path}/{row.archive}").read()
    assert int.from_bytes(data[:4], "little") == warc.SKIPPABLE
    size = int.from_bytes(data[4:8], "little")
    assert data[8:8 + size] == dictionary
    records = list(warc.read_frames(io.BytesIO(data)))
    assert len(records) == row.records == 300
    assert all(r.startswith(b"WARC/1.1\r\n") and r.endswith(b"\r\n\r\n") for r in records)
    alone = sum(len(zstandard.ZstdCompressor(level=6).compress(r)) for r in records)
    assert len(data) < alone


def test_small_archives(spark):
    pages = _pages(spark, [(i, "u", f"page {i}") for i in range(20)]).coalesce(1)
    folder = warc.work_folder(spark, "warc-test")
    archives = warc.write_archives(warc.decide(pages), folder, b"", archive_bytes=500)
    assert archives.count() > 3
    assert {r.page_id for r in warc.read_archives(archives, folder).collect()} == set(range(20))


def test_no_pages(spark):
    archives, folder = warc.archive_pages(_pages(spark, []))
    assert warc.read_archives(archives, folder).collect() == []


def test_damage_is_found():
    record = warc.build_record("response", 1, "u", b"body", 4, "0" * 40, None)
    with pytest.raises(ValueError, match="damaged"):
        warc._row(*warc.parse_record(record))
    frame = zstandard.ZstdCompressor().compress(record)
    head = warc.SKIPPABLE.to_bytes(4, "little") + (0).to_bytes(4, "little")
    with pytest.raises(ValueError, match="inside a record"):
        list(warc.read_frames(io.BytesIO(head + frame[:-3])))


def test_dictionary_sees_all_of_a_page(spark):
    shared = "".join(f"<li class=footer-{i * 7919 % 997}>all pages end so</li>" for i in range(900))
    rows = [(i, "u", "".join(hashlib.sha256(b"%d %d" % (i, j)).hexdigest() for j in range(400))
             + shared) for i in range(120)]
    assert len(rows[0][2]) > 3 * warc.SAMPLE_BYTES
    assert b"all pages end so" in warc.train_dictionary(_pages(spark, rows))

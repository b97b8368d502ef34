"""WARC bundles: an exact round trip, revisits, and reading single records."""

import base64
import hashlib

import pytest
import zstandard

from clickloom.llm import warc
from clickloom.llm.store import folder

LONG = "<p>x</p>" * 300_000
ROWS = [
    (1, "http://a/1", "<a>ü</a>"), (2, "http://a/2", "same"), (3, "http://a/3", "same"), (5, None, "same"), (4, "http://a/\r\nX: %0A", None),
    (6, "u", ""), (7, "u", LONG), (8, "u", LONG), (8, "u", LONG), (None, "u", "same"), (None, None, "alone"), (9, "u", "\r\n\r\nWARC/1.1\r\n"),
]


def pages(spark, rows=ROWS):
    schema = "page_id long, url string, html string, key string, response long, payload string"
    return spark.createDataFrame([(*r, "clash", 1, "clash") for r in rows], schema)


def expected(rows, least=0):
    want = []
    for page, url, html in rows:
        data = (html or "").encode()
        same = [p for p, _, h in rows if (h or "") == (html or "") and p is not None]
        refers = max(same) if len(same) > 1 and page is not None and page != max(same) and len(data) >= least else None
        digest = base64.b32encode(hashlib.sha1(data).digest()).decode()
        want.append((page, url, "revisit" if refers is not None else "response", refers, digest, len(data), data if refers is None else None))
    return sorted(want, key=repr)


def rows_of(found):
    return sorted(((*r[1:7], None if r[7] is None else bytes(r[7])) for r in found.collect()), key=repr)


@pytest.mark.parametrize("least, frame, bundle", [(0, 1 << 20, 1 << 26), (0, 64, 300), (5, 500, 1 << 20), (1 << 40, 10, 10)])
def test_round_trip(spark, least, frame, bundle):
    place = folder(spark, "test-warc")
    index = warc.write(pages(spark), place, least_bytes=least, frame=frame, bundle=bundle)
    want = expected(ROWS, least)
    assert index.count() == len(ROWS)
    assert rows_of(warc.read(spark, place)) == want
    assert rows_of(warc.fetch(index, place)) == want
    one = warc.fetch(index.where("page_id = 9"), place).collect()
    assert len(one) == 1 and bytes(one[0].payload) == b"\r\n\r\nWARC/1.1\r\n"


def test_bundles_are_plain_zstandard(spark):
    place = folder(spark, "test-warc")
    index = warc.write(pages(spark, ROWS[:4]).coalesce(1), place, frame=200)
    name = index.first().bundle
    files, path = warc._place(place)
    with files.open_input_file(f"{path}/{name}") as file:
        frames = warc.seek_table(file)
        file.seek(0)
        whole = zstandard.ZstdDecompressor().stream_reader(file.read(), read_across_frames=True).read()
    assert len(frames) > 1 and whole.count(b"WARC/1.1\r\n") == 4


def test_left_over_files_are_not_read(spark):
    place = folder(spark, "test-warc")
    warc.write(pages(spark, ROWS[:4]), place)
    files, path = warc._place(place)
    with files.open_output_stream(f"{path}/part-000000-99999-0000.warc.zst", compression=None) as out:
        out.write(b"broken off")
    assert warc.read(spark, place).count() == 4


def test_damage_is_noticed():
    data = warc.record("<urn:x>", 1, "u", b"payload", None, False, "2000-01-01T00:00:00Z")
    assert warc.parse(data)[0]["payload"] == b"payload" and warc.parse(data)[1] == len(data)
    with pytest.raises(ValueError):
        warc.parse(data.replace(b"payload\r\n\r\n", b"paXload\r\n\r\n"))


def test_empty_table(spark):
    place = folder(spark, "test-warc")
    assert warc.write(pages(spark, []), place).count() == 0 and warc.read(spark, place).count() == 0


def test_identifiers_are_unique_and_found(spark):
    """Ids repeated or null, payloads repeated under one id, one id on two payloads."""
    rows = [*ROWS, (8, "u", "same"), (3, "v", "same"), (None, "u", "same"), (5, "w", LONG), (1, "x", "<a>ü</a>"), (0, "y", "<a>ü</a>")]
    place = folder(spark, "test-warc")
    index = warc.write(pages(spark, rows), place, frame=300)
    assert index.select("record_id").distinct().count() == len(rows)
    records = warc.read(spark, place)
    assert {tuple(r) for r in records.select("record_id", "page_id", "record_type").collect()} == {
        tuple(r) for r in index.select("record_id", "page_id", "record_type").collect()
    }
    for entry in index.collect():
        (one,) = warc.fetch(index.where(index.record_id == entry.record_id), place).collect()
        assert (one.record_id, one.page_id) == (entry.record_id, entry.page_id)


def test_revisits_name_the_record_they_refer_to(spark):
    place = folder(spark, "test-warc")
    rows = [(1, "u", "a"), (2, "u", "a"), (3, "u", "b"), (4, "u", "b"), (4, "u", "b")]
    index = warc.write(pages(spark, rows).coalesce(1), place)
    files, path = warc._place(place)
    heads = {}
    with files.open_input_file(f"{path}/{index.first().bundle}") as file:
        data = warc._frame(file, *warc.seek_table(file)[0])
    for entry in index.collect():
        lines = data[entry.offset : entry.offset + entry.length].split(b"\r\n\r\n")[0].decode().split("\r\n")[1:]
        heads[entry.page_id] = dict(line.split(": ", 1) for line in lines)
    assert heads[1]["WARC-Refers-To"] == heads[2]["WARC-Record-ID"]
    assert "WARC-Refers-To" not in heads[3] and heads[3]["X-Refers-To-Page"] == "4"

import gzip
import hashlib
import random

import pytest

from tessera.llm import archives

from .helpers import prose

PAGES = "page_id long, url string, html string"


def expected(rows):
    groups = {}
    for page_id, _, html in rows:
        groups.setdefault((html or "").encode(), []).append(page_id)
    out = []
    for page_id, _, html in rows:
        data = (html or "").encode()
        last = max(groups[data])
        revisit = len(data) >= 1000 and page_id != last
        out.append((page_id, len(data), hashlib.sha1(data).hexdigest(), "revisit" if revisit else "response",
                    last if revisit else None))
    return sorted(out, key=str)


@pytest.mark.parametrize("version", [1, 2, None])
def test_pages_through_arc_and_warc(spark, scratch, version, monkeypatch):
    monkeypatch.setattr(archives, "FILE_BYTES", 50_000)
    rng = random.Random(3)
    big = [prose(rng, 400) + " é" for _ in range(4)]
    rows = [(i, f"http://x.example/{i}?q=a b é", rng.choice([*big, "small", "", None, "\r\n\r\nHTTP/1.1 \n\n", prose(rng, 300)]))
            for i in range(120)]
    rows.append((500, None, "x" * 300_000))
    pages = spark.createDataFrame(rows, PAGES).repartition(3)
    assert archives.write_arc(pages, f"{scratch}/arc", version).agg({"records": "sum"}).first()[0] == len(rows)
    made = archives.convert(spark, f"{scratch}/arc", f"{scratch}/warc")
    assert made.agg({"records": "sum"}).first()[0] == len(rows)
    got = archives.read_warc(spark, f"{scratch}/warc").collect()
    assert sorted(((r["page_id"], r["payload_bytes"], r["payload_digest"], r["record_type"], r["refers_to"])
                   for r in got), key=str) == expected(rows)
    assert len({r["record_id"] for r in got}) == len(rows)


def test_plain_arc_with_spaces_in_url_and_other_types():
    name = "old.arc"
    body = archives.arc_version_block(1, name) + archives.arc_record(
        1, "http://a b/c d", "1997", "text/plain", b"no http head\n\n") + b"\n\n" + archives.arc_record(
        1, "http://e", "19970102030405", "text/html", b"HTTP/1.0 200 OK\r\n\r\nbody")
    for content in (body, gzip.compress(body)):
        one, two = archives.read_arc(content)
        assert one["url"] == "http://a b/c d" and one["block"] == b"no http head\n\n"
        assert archives._split_http(two["block"]) == (b"HTTP/1.0 200 OK\r\n\r\n", b"body")
    assert archives._iso("1997") == "1997-01-01T00:00:00Z" and archives._iso("19970102030405") == "1997-01-02T03:04:05Z"


def members(*records):
    return b"".join(gzip.compress(r) for r in records)


def arc_parts(n=5, version=1):
    return [archives.arc_version_block(version, "x.arc"),
            *[archives.arc_record(version, f"http://a/{i}", "1997", "text/html", b"HTTP/1.0 200 OK\r\n\r\n" + bytes([65 + i]) * 400)
              for i in range(n)]]


@pytest.mark.parametrize("version", [1, 2])
@pytest.mark.parametrize("chunk", [7, 1 << 18])
def test_damage_is_skipped_and_counted(version, chunk, monkeypatch):
    monkeypatch.setattr(archives, "_CHUNK", chunk)
    parts = arc_parts(version=version)
    packed = [gzip.compress(p) for p in parts]

    def read(content):
        damaged = []
        return [r["url"][-1] for r in archives.read_arc(content, damaged)], len(damaged)

    whole = "01234"
    assert read(b"".join(parts)) == read(b"".join(packed)) == read(gzip.compress(b"".join(parts))) == (list(whole), 0)
    assert read(b"".join(parts)[:-50]) == (list("0123"), 1)  # cut off
    assert read(b"".join(packed)[:-50])[0] == list("0123") and read(b"".join(packed)[:-50])[1] == 1
    broken = bytearray(packed[2])
    broken[len(broken) // 2] ^= 0xFF
    got, n = read(b"".join([*packed[:2], bytes(broken), *packed[3:]]))
    assert got == list("0234") and n >= 1
    bad_length = parts[3].replace(b"\n", b"x\n", 1)
    assert read(b"".join([*parts[:3], bad_length, *parts[4:]])) == (list("0134"), 1)
    assert read(b"garbage\n" + b"".join(parts)) == (list(whole), 1)
    assert read(b"".join(parts[1:])) == (list(whole), 1)  # no version block: the lines tell
    assert read(b"") == ([], 0) and read(b"no archive at all") == ([], 1)


def test_damaged_file_does_not_stop_the_conversion(spark, scratch):
    import os

    os.makedirs(f"{scratch}/arc")
    for name, content in {"a.arc.gz": members(*arc_parts(5)), "b.arc.gz": members(*arc_parts(5))[:-40],
                          "c.arc": b"\x00" * 500, "d.arc": b"".join(arc_parts(3))}.items():
        open(f"{scratch}/arc/{name}", "wb").write(content)
    made = {r["path"].rsplit("/", 1)[1]: (r["records"], r["damaged"]) for r in
            archives.convert(spark, f"{scratch}/arc", f"{scratch}/warc").collect()}
    assert made == {"a.warc.gz": (5, 0), "b.warc.gz": (4, 1), "c.warc.gz": (0, 1), "d.warc.gz": (3, 0)}
    assert archives.read_warc(spark, f"{scratch}/warc").count() == 12


def test_files_are_dealt_over_tasks(spark, scratch):
    import os

    os.makedirs(f"{scratch}/arc")
    for i in range(12):
        open(f"{scratch}/arc/{i}.arc", "wb").write(b"".join(arc_parts(2)))
    files = archives._files(spark, f"{scratch}/arc", "*.arc*")
    assert files.rdd.getNumPartitions() == 12


def test_repeated_rows_null_ids_and_empty_table(spark, scratch):
    page = "y" * 2000
    rows = [(7, "u", page), (7, "u", page), (None, "u", page), (3, "v", page)]
    archives.write_arc(spark.createDataFrame(rows, PAGES).coalesce(1), f"{scratch}/a")
    archives.convert(spark, f"{scratch}/a", f"{scratch}/w")
    got = archives.read_warc(spark, f"{scratch}/w").collect()
    assert [r["record_type"] for r in got].count("response") == 1 and len(got) == 4
    assert all(r["refers_to"] == 7 for r in got if r["record_type"] == "revisit")
    assert archives.write_arc(spark.createDataFrame([], PAGES), f"{scratch}/none").count() == 0

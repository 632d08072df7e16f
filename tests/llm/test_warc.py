"""Archives against an exact round trip."""

import gzip
import hashlib
from collections import Counter
from pathlib import Path

from corpuscle.llm import warc

LONG = "é\r\n\r\nWARC/1.1\r\n" * 400
ROWS = [
    (1, "http://a", "x" * 1200),
    (2, "http://b", "x" * 1200),
    (3, None, "x" * 1200),
    (3, None, "x" * 1200),
    (4, "http://d", None),
    (5, "http://e", ""),
    (6, "http://f", "x" * 999),
    (7, "http://g", "x" * 999),
    (8, "http://h", LONG),
    (9, "http://i", LONG),
    (10, "http://j\r\n\r\n", "tail\r\n"),
    (11, "http://k", "\r\n\r\n\r\n"),
    (12, "http://l", "a\r\n\r\r\n\r\n"),
    (1, "http://a", "another page with this id"),
    (None, "http://m", "x" * 1200),
    (13, "http://n", LONG * 20 + "end"),
    (14, "http://o", "z\r\n\r"),
]


def _expected():
    largest = {}
    for page, _, html in ROWS:
        if page is not None and html:
            largest[html] = max(page, largest.get(html, page))
    for page, _, html in ROWS:
        data = (html or "").encode()
        again = page is not None and len(data) >= 1000 and page < largest[html]
        kind, to = ("revisit", largest[html]) if again else ("response", None)
        yield page, len(data), hashlib.sha1(data).hexdigest(), kind, to


def _pages(spark):
    rows = [(*r, "clash", 1) for r in ROWS]
    return spark.createDataFrame(rows, "page_id bigint, url string, html string, digest string, chunk_no int").repartition(3)


def test_round_trip(spark, tmp_path):
    for chunk_chars in (7, 500, warc.CHUNK_CHARS):
        got = warc.round_trip(_pages(spark), str(tmp_path / f"w{chunk_chars}"), chunk_chars=chunk_chars).collect()
        assert Counter(map(tuple, got)) == Counter(_expected())


def test_chunks_and_files(spark, tmp_path):
    path = tmp_path / "w"
    warc.write_archives(_pages(spark), str(path), chunk_chars=600)
    chunks = warc.read_archives(spark, str(path)).filter("page_id = 13").orderBy("chunk_no").collect()
    text = LONG * 20 + "end"
    assert len(chunks) == -(-len(text) // 600) and "".join(c["chunk"] for c in chunks) == text
    digest = hashlib.sha1()
    for i, c in enumerate(chunks):
        digest.update(c["chunk"].encode())
        assert (c["chunk_no"], c["digest_so_far"], c["last"]) == (i, digest.hexdigest(), i == len(chunks) - 1)
    data = b"".join(gzip.decompress(f.read_bytes()) for f in Path(path).glob("*.gz"))
    assert data.startswith(b"WARC/1.1\r\nWARC-Type: ") and data.endswith(b"\r\n\r\n")


def test_last_record_ends_in_line_ends(spark, tmp_path):
    pages = ["tail\r\n", "\r\n", "\r\n\r\n", "\r\n\r\n\r\n", "a\r\n\r\r\n", "x\r\n\r", "</html>\n\r\n"]
    for i, html in enumerate(pages[:2]):
        table = spark.createDataFrame([(i, "http://a", html)], "page_id bigint, url string, html string").coalesce(1)
        (got,) = warc.round_trip(table, str(tmp_path / f"one{i}")).collect()
        assert tuple(got)[:3] == (i, len(html), hashlib.sha1(html.encode()).hexdigest())
    # Several such files in one task, compressed and plain.
    rows = [(i, "http://a", pages[i % len(pages)]) for i in range(14)]
    table = spark.createDataFrame(rows, "page_id bigint, url string, html string").repartition(14, "page_id")
    warc.write_archives(table, str(tmp_path / "gzip"))
    warc.records(table).write.option("lineSep", warc.SEPARATOR).text(str(tmp_path / "plain"))
    for folder in ("gzip", "plain"):
        got = warc.read_archives(spark, str(tmp_path / folder)).collect()
        assert Counter((r["page_id"], r["chunk"]) for r in got) == Counter((r[0], r[2]) for r in rows)


def test_damage_is_noticed(spark, tmp_path):
    path = tmp_path / "w"
    warc.write_archives(_pages(spark).filter("page_id = 6"), str(path))
    (file,) = [f for f in path.glob("*.gz") if gzip.decompress(f.read_bytes())]
    file.write_bytes(gzip.compress(gzip.decompress(file.read_bytes()).replace(b"xxx", b"xyx", 1)))
    for crc in path.glob(".*.crc"):
        crc.write_bytes(b"")
        crc.unlink()
    try:
        warc.read_archives(spark, str(path)).collect()
    except Exception as error:
        assert "differs from its digest" in str(error)
    else:
        raise AssertionError("a changed payload was not noticed")


def test_empty(spark, tmp_path):
    assert warc.round_trip(_pages(spark).limit(0), str(tmp_path / "w")).count() == 0


def test_chunks_of_mixed_widths(spark):
    body = "aé猫😀\n" * 900 + "z"
    table = spark.createDataFrame([(1, "u", body), (2, "u", "ab"), (3, "u", ""), (4, None, None)], "page_id bigint, url string, html string")
    payloads = warc._payloads(table, "page_id", "html", "url").selectExpr("*", "cast(null as bigint) as refers_to")
    for chars in (1, 3, 4096):
        rows = warc.chunk_rows(payloads, chars).orderBy("page_id", "chunk_no").collect()
        for page, text in ((1, body), (2, "ab"), (3, ""), (4, "")):
            parts = [text[at : at + chars] for at in range(0, len(text), chars)] or [""]
            digest, total, expected = hashlib.sha1(), 0, []
            for i, part in enumerate(parts):
                digest.update(part.encode())
                total += len(part.encode())
                expected.append((i, part.encode(), total, digest.hexdigest(), i == len(parts) - 1))
            got = [(r["chunk_no"], bytes(r["chunk"]), r["bytes_so_far"], r["digest_so_far"], r["last"]) for r in rows if r["page_id"] == page]
            assert got == expected


def test_many_shared_payloads(spark, tmp_path, monkeypatch):
    monkeypatch.setattr(warc, "SMALL_ROWS", 0)
    got = warc.round_trip(_pages(spark), str(tmp_path / "w"), chunk_chars=300).collect()
    assert Counter(map(tuple, got)) == Counter(_expected())

import base64
import gzip
import hashlib

from rillstone.llm import warc as W

PAGES = [
    (1, "http://a/", "<p>same</p>"), (2, "http://b/", "<p>same</p>"), (7, "http://c/", "<p>same</p>"), (3, None, "WARC/1.1\r\nContent-Length: 3\r\n\r\nabc\r\n\r\nWARC/1.1\r\n\r\n"), (4, "http://e/ x\r\ny", "é😀\x00"),
    (5, "http://f/", None), (6, "http://g/", ""), (8, "http://h/", "z" * 300_000),
]


def frame(spark, rows=PAGES):
    return spark.createDataFrame([(*r, "clash") for r in rows], "page_id long, url string, html string, digest string")


def expected(rows):
    last = {}
    for p, _, h in rows:
        last[h or ""] = max(last.get(h or "", p), p)
    out = set()
    for p, _, h in rows:
        data = (h or "").encode()
        other = last[h or ""]
        out.add((p, len(data), base64.b32encode(hashlib.sha1(data).digest()).decode(), "response" if other == p else "revisit", None if other == p else other))
    return out


def test_round_trip(spark):
    out = W.round_trip(frame(spark)).collect()
    assert {tuple(r)[:5] for r in out} == expected(PAGES) and len(out) == len(PAGES)


def test_captures_are_whole(spark, tmp_path):
    path = f"file://{tmp_path}/warc"
    W.write_archives(frame(spark), path)
    rows = W.captures(W.read_records(spark, path)).collect()
    assert len(rows) == len(PAGES)
    for r in rows:
        assert r.request.target_uri == r.response.target_uri
        assert r.response.record_id == r.capture_id
        assert (r.response.refers_to is None) == (r.response.type == "response")
    ids = {r.metadata.page_id: r.capture_id for r in rows}
    assert {r.response.refers_to for r in rows if r.response.type == "revisit"} == {ids[7], ids[6]}


def members(folder):
    return b"".join(gzip.decompress(p.read_bytes()) for p in sorted(folder.rglob("part-*")))


def test_archives_are_well_formed(spark, tmp_path):
    W.write_archives(frame(spark), f"file://{tmp_path}/warc")
    data = members(tmp_path / "warc")
    records = list(W.parse(data))
    assert len(records) == 3 * len(PAGES)
    rebuilt = sum(len(b) for _, b in records)
    assert rebuilt < len(data)
    assert {b.split(b"\r\n\r\n", 1)[1].decode() for h, b in records if h["warc-type"] == "response"} == {h or "" for _, _, h in PAGES}


def test_archives_are_bounded_by_bytes_and_parsed_in_pieces(spark, tmp_path, monkeypatch):
    monkeypatch.setattr(W, "SMALL", 1000)
    monkeypatch.setattr(W, "ARCHIVE_BYTES", 50_000)
    monkeypatch.setattr(W, "PIECE", 37)
    rows = [(i, f"http://h/{i}", f"{i}" + "y" * size) for i, size in enumerate([10] * 200 + [3000] * 40 + [60_000] * 3)]
    W.write_archives(frame(spark, rows).coalesce(1), f"file://{tmp_path}/warc")
    files = sorted((tmp_path / "warc").rglob("part-*"))
    of_file = [[len(b) for h, b in W.parse(p.read_bytes()) if h["warc-type"] == "response"] for p in files]
    assert all(sum(x) <= 70_000 for x in of_file) and sum(map(len, of_file)) == len(rows) and len({p.parent for p in files}) == 4
    out = W.round_trip(frame(spark, rows), f"file://{tmp_path}/again").collect()
    assert {tuple(r)[:5] for r in out} == expected(rows) and len(out) == len(rows)


def test_two_compressed_members_in_one_file():
    one, two = W.record("request", [], b"abc") + W.END, W.record("metadata", [], b"page-id: 3\r\n") + W.END
    data = gzip.compress(one) + gzip.compress(two)
    assert [(h["warc-type"], b) for h, b in W.parse(data)] == [("request", b"abc"), ("metadata", b"page-id: 3\r\n")] == [(h["warc-type"], b) for h, b in W.parse(one + two)]


def test_null_ids(spark):
    rows = [(None, "http://n/", "alone"), (None, "http://m/", "alone"), (None, "http://k/", "<p>same</p>"), (4, "http://z/", "<p>same</p>"), (4, "http://z/", "other"), (None, None, None)]
    out = W.round_trip(frame(spark, rows)).collect()
    found = sorted((str(r.page_id), r.payload_bytes, r.record_type, r.refers_to) for r in out)
    assert found == [("4", 5, "response", None), ("4", 11, "response", None), ("None", 0, "response", None), ("None", 5, "response", None), ("None", 5, "response", None), ("None", 11, "revisit", 4)]


def test_repeated_rows_and_empty_table(spark):
    rows = [*PAGES, PAGES[2], PAGES[7], PAGES[7]]
    out = W.round_trip(frame(spark, rows)).collect()
    assert len(out) == len(rows)
    assert [r.record_type for r in out if r.page_id in (7, 8)] == ["response"] * 5
    assert W.round_trip(frame(spark, [])).collect() == []


def test_records_without_partner(spark):
    rows = [("metadata", "m", "c", "u", None, None, None, 1)]
    r = W.captures(spark.createDataFrame(rows, W.FIELDS.format(page="long"))).collect()
    assert len(r) == 1 and r[0].response is None and r[0].metadata.page_id == 1

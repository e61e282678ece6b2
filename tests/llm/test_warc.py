import gzip
from base64 import b32encode
from hashlib import sha1

from clickweir.llm import warc

SCHEMA = "page_id long, url string, html string, payload string, refers_to string"
PAGES = [
    (1, "http://a/", "same", "", ""), (2, "http://b/", "same", "", ""), (3, None, "x\r\n\r\nWARC/1.1\r\n", None, ""), (9, "u v\n", "same", "", ""),
    (4, "http://c/", None, "", ""), (5, "", "", "", ""), (6, "http://é/", "ünï \U0001f600\r\n\r\n\r\n\r\n", "", ""), (7, "http://d/", "z" * 300_000, "", ""),
]


def expected(pages, least=0):
    body = {p[0]: (p[2] or "").encode() for p in pages}
    last = {}
    for k, b in body.items():
        last[b] = max(k, last.get(b, k))
    return {k: (len(b), b32encode(sha1(b).digest()).decode(), last[b] if last[b] != k and len(b) >= least else None) for k, b in body.items()}


def test_round_trip(spark):
    pages = spark.createDataFrame(PAGES, SCHEMA).repartition(3)
    for least in (0, 1, 5):
        got = {r["page_id"]: r for r in warc.archived(pages, least).collect()}
        assert {k: (r["payload_bytes"], r["payload_digest"], r["refers_to"]) for k, r in got.items()} == expected(PAGES, least)
        assert all(r["record_type"] == ("response" if r["refers_to"] is None else "revisit") for r in got.values())


def test_archives_are_plain_warc(spark, tmp_path):
    rows = warc.resolved(warc.records(spark.createDataFrame(PAGES, SCHEMA).coalesce(1)))
    warc.write(rows.coalesce(1), str(tmp_path / "a"), per_file=3)
    files = list((tmp_path / "a").glob("part-*.gz"))
    assert len(files) == 3
    heads = [(h, b) for f in files for h, b in warc.parsed(f.read_bytes())]
    assert len(heads) == len(PAGES) and all(h["version"] == "WARC/1.1" and "warc-date" in h for h, _ in heads)
    assert len({h["warc-record-id"] for h, _ in heads}) == len(PAGES)
    kept = {h["warc-record-id"]: b.partition(b"\r\n\r\n")[2] for h, b in heads}
    assert kept["<urn:page:7>"] == b"z" * 300_000 and kept["<urn:page:1>"] == b""
    assert sum(gzip.decompress(f.read_bytes()).count(b"same") for f in files) == 1
    payloads = {r["page_id"]: r["payload"] for r in warc.read(spark, str(tmp_path / "a"), with_payload=True).collect()}
    assert payloads[3] == b"x\r\n\r\nWARC/1.1\r\n"


def test_repeated_and_missing(spark):
    rows = [(4, "x", "", "", ""), (4, "x", "", "", ""), (None, "x", "", "", ""), (2, None, None, None, None)]
    got = warc.archived(spark.createDataFrame(rows, SCHEMA)).collect()
    assert sorted((r["page_id"], r["refers_to"]) for r in got if r["page_id"] == 2) == [(2, 4)] and len(got) == 3
    assert warc.archived(spark.createDataFrame([], SCHEMA)).count() == 0

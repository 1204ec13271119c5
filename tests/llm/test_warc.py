from __future__ import annotations

import hashlib
import random

from sieveline.llm import warc
from sieveline.llm.warc import LoserTree, merge_index, read_captures, write_archives

LONG = "<p>" + "é" * 100 + "\r\n\r\nWARC/1.1\r\nContent-Length: 3\r\n\r\n</p>"
PAGES = [
    (5, "http://www.a.example.com/x?q#f", LONG),
    (3, "https://a.example.com/x?q", LONG),
    (9, "http://user@b.example.org:80", LONG),
    (1, None, None),
    (2, "", ""),
    (4, "no scheme", "short"),
    (6, "http://c.example.com/\r\nX: y", "short"),
    (None, "http://d.example.com/", LONG),
    (None, "http://d.example.com/", "z" * 200),
    (None, "http://d.example.com/", "z" * 200),
    (7, "http://e.example.com/", "long " * 200_000),
    (8, "http://e.example.com/", "long " * 200_000),
    (8, "http://e.example.com/", "long " * 200_000),
]
DDL = "page_id long, url string, html string, digest string, Key long"


def frame(spark, rows):
    return spark.createDataFrame([(*r, "d", 1) for r in rows], DDL).repartition(4)


def brute(rows):
    out = []
    for page_id, _, html in rows:
        payload = (html or "").encode()
        ids = [p for p, _, h in rows if (h or "") == (html or "") and p is not None]
        again = len(payload) >= 100 and ids and page_id != min(ids)
        out.append((page_id, len(payload), hashlib.sha256(payload).hexdigest(), "revisit" if again else "response", min(ids) if again else None))
    return sorted(out, key=str)


def test_archives_hold_every_page_and_index_is_in_order(spark, tmp_path):
    folder = f"file://{tmp_path}/w"
    write_archives(frame(spark, PAGES), folder, records=2)
    got = merge_index(read_captures(spark, folder)).collect()
    assert sorted([tuple(r[c] for c in ("page_id", "payload_bytes", "payload_digest", "record_type", "refers_to")) for r in got], key=str) == brute(PAGES)
    assert len({r.archive for r in got}) >= len(PAGES) // 2
    got.sort(key=lambda r: (r.range, r.place))
    keys = [(r.url_key, r.captured, r.page_id is not None, r.page_id or 0) for r in got]
    assert keys == sorted(keys)
    assert {r.page_id: r.url_key for r in got if r.page_id in (5, 3, 9, 1, 4)} == {
        5: "com,example,a)/x?q", 3: "com,example,a)/x?q", 9: "org,example,b)/", 1: "", 4: "no scheme",
    }


def test_records_are_well_formed_archives(spark, tmp_path):
    write_archives(frame(spark, PAGES), f"file://{tmp_path}/w")
    found = []
    for file in (tmp_path / "w").glob("*.gz"):
        found += list(warc.records(warc.unpack(file.read_bytes())))
    assert len(found) == len(PAGES)
    for head, block in found:
        http, payload = block.split(b"\r\n\r\n", 1)
        if head["warc-type"] == "response":
            assert "sha256:" + hashlib.sha256(payload).hexdigest() == head["warc-payload-digest"]
        else:
            assert payload == b"" and head["warc-refers-to"] in ("<urn:page:3>", "<urn:page:7>")


def test_capture_times_and_empty_tables(spark, tmp_path):
    timed = spark.sql("SELECT 1L page_id, 'http://x/' url, 'h' html, timestamp'2020-02-03 04:05:06' captured_at")
    write_archives(timed, f"file://{tmp_path}/t")
    assert read_captures(spark, f"file://{tmp_path}/t").first().captured == "2020-02-03T04:05:06Z"
    assert warc.archive(frame(spark, PAGES).limit(0)).count() == 0


def test_loser_tree_merges_any_runs():
    rng = random.Random(4)
    for k in (0, 1, 2, 3, 7, 16):
        runs = [sorted(rng.choices(range(50), k=rng.randrange(0, 30))) for _ in range(k)]
        assert list(LoserTree([iter(r) for r in runs], lambda x: x)) == sorted(x for r in runs for x in r)

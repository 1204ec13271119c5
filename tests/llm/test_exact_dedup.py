from __future__ import annotations

import hashlib

import pytest

from sieveline.llm import exact_dedup
from sieveline.llm.exact_dedup import ContentTable, drop_copies, mark_copies

SCHEMA = "doc_id long, text string, lang string, source string, n_chars long"


def frame(spark, rows):
    return spark.createDataFrame([(i, t, None, "s", None) for i, t in rows], SCHEMA).repartition(3)


def brute(rows):
    norm = [(t or "").translate({c: c + 32 for c in range(65, 91)}) for _, t in rows]
    out = []
    for (i, _), t in zip(rows, norm):
        same = [j for (j, _), u in zip(rows, norm) if u == t]
        ids = [j for j in same if j is not None]
        keep = max(ids) if ids else None
        out.append((i, keep, len(same), i == keep, hashlib.sha256(t.encode()).hexdigest()))
    return sorted(out, key=str)


ROWS = [(1, "Ab É"), (2, "aB É"), (3, "ab é"), (4, None), (5, ""), (6, " "), (None, "ab é"), (None, "lone"), (7, "x" * 300_000), (8, "X" * 300_000)]


@pytest.mark.parametrize("table_bytes", [1, 500, 1 << 20])
def test_marks_equal_brute_force_at_any_table_size(spark, table_bytes):
    rows = ROWS + [(100 + i, f"copy {i % 7}") for i in range(300)]
    got = sorted(map(tuple, mark_copies(frame(spark, rows), table_bytes).collect()), key=str)
    assert got == brute(rows)


def test_one_row_of_each_text_stays_even_if_rows_repeat(spark):
    rows = [(1, "a"), (9, "A"), (9, "a"), (9, "a"), (None, "n"), (None, "n"), (3, "z")]
    kept = sorted(map(tuple, drop_copies(frame(spark, rows)).select("doc_id", "text").collect()), key=str)
    assert sorted((i, t.lower()) for i, t in kept if i) == [(3, "z"), (9, "a")]
    assert [t for i, t in kept if i is None] == ["n"]


def test_clashing_columns_stay_and_empty_tables_pass(spark):
    docs = spark.createDataFrame([(1, "a", 5, "h"), (2, "a", 6, "g")], "doc_id long, text string, keep_id long, SHA_ string")
    assert [tuple(r) for r in drop_copies(docs).collect()] == [(2, "a", 6, "g")]
    assert drop_copies(docs.limit(0)).count() == 0
    assert mark_copies(docs.limit(0)).count() == 0


def test_equal_hashes_are_told_apart_by_content(monkeypatch, spark):
    table = ContentTable(1 << 20)
    assert table.add(5, b"a", 1, 1, 1) and table.add(5, b"b", 2, 1, 1) and table.add(5, b"a", 3, 2, 1)
    assert table.groups == [[3, 3, 1], [2, 1, 1]]
    same = [(5, bytes([i % 4]), i, 1, 1) for i in range(40)]
    import tempfile

    with tempfile.TemporaryDirectory() as folder:
        found = list(exact_dedup._groups(iter(same), 1, 0, folder))
    assert sorted(g[1:] for g in found) == [(36, 10, 1), (37, 10, 1), (38, 10, 1), (39, 10, 1)]

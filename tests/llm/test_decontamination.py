from __future__ import annotations

import hashlib
import re

import pytest

from tallybook.llm.decontamination import WINDOW, clean, contamination, merged, original_spans, spans

WORD = re.compile(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")


def words(text):
    lower = "".join(c.lower() if "A" <= c <= "Z" else c for c in text or "")
    return WORD.findall(lower)


def brute(pairs, items, size=WINDOW):
    out = []
    for doc_id, text in pairs:
        own, hit, found = words(text), set(), set()
        for item_id, item in items:
            parts = words(item)
            for at in range(max(1, len(parts) - size + 1)) if parts else ():
                window = parts[at : at + size]
                for start in range(len(own) - len(window) + 1):
                    if own[start : start + len(window)] == window:
                        hit.update(range(start, start + len(window)))
                        found.add(item_id)
        listed = ",".join(sorted(str(i) for i in found - {None}))
        digest = hashlib.sha256(listed.encode()).hexdigest()
        out.append((doc_id, len(own), len(hit), len(found - {None}), digest, bool(hit)))
    return sorted(out, key=str)


@pytest.fixture
def benchmark(spark):
    return lambda items: spark.createDataFrame(items, "item_id long, text string")


@pytest.fixture
def items(prose):
    long = [(at * 11, prose(at, 25)) for at in range(12)]
    return [*long, (7, "Über die Brücke!"), (8, None), (9, "--"), (200, long[0][1]), (None, prose(50, 12)), (8, "x y")]


@pytest.fixture
def pairs(prose, items):
    out = [(at, prose(100 + at, 30)) for at in range(10)]
    for at, (_, text) in enumerate(items[:6]):
        cut = text.split()[at : at + 10 + at]
        out.append((50 + at, f"{prose(at + 70, 6)}\n{'; '.join(cut).upper()}. {prose(at + 80, 9)} {' '.join(cut[:9])}"))
    out += [(90, "vor ÜBER, die  Brücke über die brücke"), (91, "x  y x y z"), (92, "xx y"), (93, items[16][1]), (94, items[0][1] * 3)]
    return out


@pytest.mark.parametrize("shard", [None, 300])
def test_hits_equal_brute_force(documents, benchmark, pairs, items, shard, monkeypatch):
    from tallybook.llm import decontamination

    if shard:
        real = decontamination.scanned
        monkeypatch.setattr(decontamination, "scanned", lambda d, b, s: real(d, b, s, shard))
    rows = contamination(documents(pairs), benchmark(items)).collect()
    assert sorted(map(tuple, rows), key=str) == brute(pairs, items)


def test_odd_rows_and_empty_tables(odd, odd_pairs, none, benchmark):
    items = [(1, "one"), (1, "one"), (2, ""), (None, None)]
    rows = contamination(odd, benchmark(items)).collect()
    assert sorted(map(tuple, rows), key=str) == brute(odd_pairs, items)
    assert contamination(none, benchmark(items)).count() == 0
    assert contamination(odd, benchmark(items[:0])).where("contaminated").count() == 0


def test_spans_point_into_the_original(documents, benchmark):
    table = documents([(1, "Ä—né One,\n TWO three! one two"), (2, "nothing")], extra=True)
    row = spans(table, benchmark([(1, "one two")])).collect()
    assert len(row) == 1 and row[0].digest == "x"
    assert [row[0].text[s.start : s.end] for s in row[0].contaminated_spans] == ["One,\n TWO", "one two"]
    assert original_spans("é ab", [0, 1], [0, 1]) == [(0, 1), (2, 4)]


def test_clean_keeps_the_rest_whole(odd, benchmark):
    kept = clean(odd, benchmark([(1, "One!")]))
    assert kept.columns == odd.columns
    assert sorted((row.doc_id is None, row.doc_id or 0) for row in kept.collect()) == [
        (False, 1), (False, 2), (False, 3), (False, 6), (False, 7), (True, 0)
    ]


def test_runs_are_merged():
    assert merged([(5, 6), (1, 2), (3, 3), (9, 12), (10, 11)]) == [(1, 3), (5, 6), (9, 12)]

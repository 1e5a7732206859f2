from __future__ import annotations

import io
import zlib
from array import array

import numpy as np
import public_tokenizers
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from tokenizers import Tokenizer

from tallybook.llm.best_fit_packing import best_fit, pack, packed_documents
from tallybook.llm.token_planes import PlaneReader, PlaneWriter, from_planes, planes, read_planes, round_trip, write_planes
from tallybook.llm.tokens import Encoder
from tallybook.session import shared_folder

PATH = public_tokenizers.path("word_bpe_49k.json")
PLAIN = Tokenizer.from_file(PATH)


def plain_ids(text, end):
    return [*PLAIN.encode(text or "", add_special_tokens=False).ids, end]


def crc(ids):
    return zlib.crc32(array("I", ids).tobytes())


@pytest.mark.parametrize(
    "text",
    [
        "",
        "It's DON'T we'll 'S 's.",
        "<|startoftext|>x <|endoftext|>",
        "a..b c,.d e.f 3.5,6 x_.y .a ,b._ a_. !!### $$$.",
        "ΣΑΣ İstanbul ß ẞ éa café ́ ́x",
        "x\x1cy\x1dz\x85w v\x0b\x0c\x00q",
        "日本語 テキスト ١٢٣ ½ 🙂👍🏽 ﬁ Ǆ Å Å",
    ],
)
def test_encoder_equals_the_tokenizer(text):
    assert list(array("I", Encoder(PATH).encode(text))) == plain_ids(text, 0)[:-1]


@settings(max_examples=200, deadline=None)
@given(st.text())
def test_encoder_equals_the_tokenizer_on_any_text(text):
    assert list(array("I", Encoder(PATH, remembered=20).encode(text))) == plain_ids(text, 0)[:-1]


@settings(max_examples=100, deadline=None)
@given(st.lists(st.integers(1, 50), max_size=60))
def test_best_fit_is_gapless_and_never_two_bins_that_fit_in_one(sizes):
    place, offset, filled = best_fit(np.array(sizes, np.int64), 50)
    for chosen in range(len(filled)):
        own = sorted((int(offset[at]), sizes[at]) for at in range(len(sizes)) if place[at] == chosen)
        assert [start for start, _ in own] == [sum(size for _, size in own[:n]) for n in range(len(own))]
        assert sum(size for _, size in own) == filled[chosen] <= 50
    assert len([full for full in filled if full <= 25]) <= 1


def check_packing(rows, wanted, capacity):
    """Pieces of every document, gapless in sequences."""
    assert sorted((r.doc_id is None, r.doc_id or 0, r.piece, r.start, r.length, r.ids_crc32) for r in rows) == sorted(wanted)
    places = {}
    for row in rows:
        places.setdefault(row.sequence_id, []).append((row.offset, row.length))
    for own in places.values():
        end = 0
        for offset, length in sorted(own):
            assert offset == end
            end += length
        assert end <= capacity
    return len(places)


def wanted_pieces(pairs, capacity):
    out = []
    for doc_id, text in pairs:
        ids = plain_ids(text, 1)
        for piece, at in enumerate(range(0, len(ids), capacity)):
            part = ids[at : at + capacity]
            out.append((doc_id is None, doc_id or 0, piece, at, len(part), crc(part)))
    return out


def test_packing_of_whole_documents(documents, prose):
    pairs = [(at, prose(at, at % 97 * 5)) for at in range(300)]
    rows = packed_documents(documents(pairs), PATH, capacity=256).collect()
    wanted = wanted_pieces(pairs, 256)
    total = sum(piece[4] for piece in wanted)
    assert check_packing(rows, wanted, 256) <= -(-total // 256) * 1.03 + 1


def test_packing_in_several_rounds(spark, documents):
    table = spark.range(4000).selectExpr("id AS doc_id", "0 AS piece", "0L AS start", "1 + id * 37 % 99 AS length", "id AS ids_crc32")
    table = table.selectExpr("doc_id", "int(piece) piece", "start", "bigint(length) length", "ids_crc32")
    rows = pack(table, capacity=100, slack=0, group_items=100).collect()
    wanted = [(False, r.doc_id, 0, 0, r.length, r.ids_crc32) for r in table.collect()]
    total = sum(piece[4] for piece in wanted)
    assert check_packing(rows, wanted, 100) <= total / 100 * 1.02 + 2


def test_packing_of_odd_rows(odd, odd_pairs, none):
    check_packing(packed_documents(odd, PATH).collect(), wanted_pieces(odd_pairs, 4096), 4096)
    assert packed_documents(none, PATH).count() == 0


@pytest.mark.parametrize("unit", ["byte", "bit"])
@pytest.mark.parametrize("count", [0, 1, 7, 8, 1000])
def test_planes_round_trip(unit, count):
    ids = np.random.default_rng(count).integers(0, 1 << 32, count, dtype=np.uint64).astype(np.uint32)
    assert np.array_equal(from_planes(planes(ids, unit), count, unit), ids)


@pytest.mark.parametrize("unit", ["byte", "bit"])
def test_file_round_trip_and_parts(unit):
    stream = io.BytesIO()
    writer = PlaneWriter(stream, unit, block=100)
    texts = [np.arange(n, dtype=np.uint32) * 7 for n in (0, 1, 250, 99, 100, 3)]
    for doc_id, ids in zip([None, -5, 0, 0, 9, 1 << 40], texts):
        writer.add(doc_id, ids)
    reader = PlaneReader(stream, writer.close())
    found = list(reader.documents())
    assert [doc_id for doc_id, _ in found] == [None, -5, 0, 0, 9, 1 << 40]
    assert all(np.array_equal(own, ids) for (_, own), ids in zip(found, texts))
    whole = np.concatenate(texts)
    for start, stop in ((0, 5), (95, 105), (100, 200), (430, 453), (7, 7)):
        assert np.array_equal(reader.ids(start, stop), whole[start:stop])


def test_all_documents_through_files(spark, documents, prose):
    pairs = [(at * 3 - 50, prose(at, at % 50)) for at in range(200)]
    manifest = write_planes(documents(pairs), PATH, shared_folder(spark, "planes"), file_bytes=4000, block=64, unit="bit")
    assert manifest.count() > 3
    start = 0
    found = {row.doc_id: row for row in read_planes(manifest).collect()}
    for doc_id, text in pairs:
        ids = plain_ids(text, 2)
        assert (found[doc_id].start, found[doc_id].n_tokens, found[doc_id].ids_crc32) == (start, len(ids), crc(ids))
        start += len(ids)


def test_odd_rows_through_files(odd, odd_pairs, none):
    rows = round_trip(odd, PATH).collect()
    wanted = sorted((i is not None, i or 0, len(plain_ids(t, 2)), crc(plain_ids(t, 2))) for i, t in odd_pairs)
    assert sorted((r.doc_id is not None, r.doc_id or 0, r.n_tokens, r.ids_crc32) for r in rows) == wanted
    starts = sorted((r.start, r.n_tokens, r.doc_id is not None, r.doc_id or 0) for r in rows)
    assert [s[0] for s in starts] == [sum(s[1] for s in starts[:n]) for n in range(len(starts))]
    assert [s[2:] for s in starts] == sorted(s[2:] for s in starts)
    assert round_trip(none, PATH).count() == 0


@pytest.mark.parametrize("most", [1, 4, 6, 1000])
def test_slices_hold_all_rows_and_few_bytes(most):
    import pyarrow as pa

    from tallybook.llm.common import slices

    texts = ["a" * 5, None, "b" * 100, "", "c", "d" * 3, "é"]
    batch = pa.RecordBatch.from_arrays([pa.array(texts)], ["text"])
    parts = list(slices(iter([batch, batch.slice(0, 0)]), most))
    assert [text for part in parts for text in part.column("text").to_pylist()] == texts
    for part in parts:
        sizes = [len((text or "").encode()) for text in part.column("text").to_pylist()]
        assert sum(sizes) <= most or sum(size > 0 for size in sizes) == 1

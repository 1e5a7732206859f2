"""Licences against brute force; language and toxicity by held-out accuracy."""

from __future__ import annotations

import random
import tracemalloc
import zlib

import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from tallybook.llm import language_id, license_scan, toxicity
from tallybook.llm.license_scan import LEAST_DICE, licenses, words_of
from tallybook.llm.license_templates import TEMPLATES


def brute_licences(text):
    """Every window at a shared bigram, without any bound."""
    words, found = words_of((text or "").encode()), []
    for number, (name, template) in enumerate(TEMPLATES):
        own = words_of(template.encode())
        wanted, length = set(zip(own, own[1:])), min(len(own), len(words))
        starts = [at for at in range(len(words) - 1) if (words[at], words[at + 1]) in wanted]
        best = (0.0, 0)
        for start in {min(at, len(words) - length) for at in starts}:
            window = words[start : start + length]
            bigrams = set(zip(window, window[1:]))
            best = max(best, (2 * len(bigrams & wanted) / (len(bigrams) + len(wanted)), -start))
        if best[0] >= LEAST_DICE:
            found.append((best[0], length, -number, name, -best[1]))
    if not found:
        return (None, 0.0, None, None, [])
    kept = []
    for hit in sorted(found, reverse=True):
        spans = [(other[4], other[4] + other[1], other[1]) for other in kept if other[3] != hit[3]]
        shared = [(min(end, hit[4] + hit[1]) - max(begin, hit[4]), min(size, hit[1])) for begin, end, size in spans]
        if not any(2 * both > shorter for both, shorter in shared):
            kept.append(hit)
    top = kept[0]
    return (top[3], top[0], top[4], top[1], sorted({name for *_, name, _ in kept}))


def test_licences_equal_brute_force(documents, prose):
    chooser, pairs = random.Random(2), []
    for at, (_, template) in enumerate(TEMPLATES):
        words = template.split()
        for change in (0, len(words) // 20, len(words) // 6):
            own = list(words)
            for _ in range(change):
                own[chooser.randrange(len(own))] = "changed"
            pairs.append((len(pairs), f"{prose(at, 7)}\n{' '.join(own).upper()}\n{prose(at, 12)}"))
        pairs.append((len(pairs), " ".join(words[: len(words) * 4 // 5])))
    pairs += [(len(pairs) + at, prose(at, 50)) for at in range(5)]
    rows = licenses(documents(pairs)).orderBy("doc_id").collect()
    assert [tuple(row)[1:] for row in rows] == [brute_licences(text) for _, text in pairs]
    assert len({row.license for row in rows}) > 12


def test_notices_of_gpl_2_are_not_reported_as_gpl_3(documents, prose):
    header = next(text for name, text in TEMPLATES if name == "GPL-3.0" and "version 3 of" in text)
    short = "Licensed under the GNU General Public License, version 3."
    notices = [text.replace("version 3", f"version {number}") for text in (header, short) for number in (2, 3)]
    pairs = [(at, f"{prose(at, 9)} {notice} {prose(at, 15)}") for at, notice in enumerate(notices)]
    rows = licenses(documents(pairs)).orderBy("doc_id").collect()
    assert [row.license for row in rows] == ["GPL-2.0", "GPL-3.0"] * 2


NOTICES = {
    "GNU Lesser General Public License, version 2.1": "LGPL-2.1",
    "GNU Lesser General Public License, version 3": "LGPL-3.0",
    "GNU Affero General Public License, version 3": "AGPL-3.0",
    "GNU General Public License, version 2": "GPL-2.0",
    "Apache License, Version 1.1": "Apache-1.1",
    "Apache License, Version 2.0": "Apache-2.0",
}


def test_a_notice_gives_its_own_licence_alone(documents, prose):
    wanted = [(f"Licensed under the {notice}.", name) for notice, name in NOTICES.items()]
    wanted += [(f"This work is licensed under the {notice}.", name) for notice, name in NOTICES.items() if "GNU" in notice]
    for parts, name in (("Attribution", "BY"), ("Attribution-NonCommercial", "BY-NC"), ("Attribution-ShareAlike", "BY-SA")):
        for version, scope in (("3.0", "Unported"), ("4.0", "International")):
            text = f"This work is licensed under a Creative Commons {parts} {version} {scope} License."
            wanted.append((text, f"CC-{name}-{version}"))
    wanted += [(text, name) for name, text in TEMPLATES if name.startswith(("GPL", "LGPL", "AGPL", "CC-", "BSD"))]
    rows = licenses(documents([f"{prose(at, 9)} {text} {prose(at, 14)}" for at, (text, _) in enumerate(wanted)])).orderBy("doc_id").collect()
    assert [(row.license, row.licenses) for row in rows] == [(name, [name]) for _, name in wanted]


def test_two_notices_apart_give_both_licences(documents, prose):
    text = f"Licensed under the GNU General Public License, version 2. {prose(1, 30)} Licensed under CC BY 4.0."
    assert licenses(documents([text])).first().licenses == ["CC-BY-4.0", "GPL-2.0"]


def test_licences_of_odd_rows(odd, odd_pairs, none):
    rows = licenses(odd).collect()
    assert len(rows) == len(odd_pairs) and all(row.license is None and row.licenses == [] for row in rows)
    assert licenses(none).count() == 0


def test_size_bound_never_drops_a_window_that_is_near_enough():
    held = license_scan.Templates(TEMPLATES, 0.8)
    for number, bigrams in enumerate(held.bigrams):
        size = len(bigrams)
        for shared in range(1, size + 1):
            if any(2 * shared / (size + window) >= 0.8 for window in range(shared, 3 * size)):
                assert shared >= held.least_shared(number, 10_000)


SYLLABLES = {
    "en": "the and ing ion ere ther was that wh ou".split(),
    "de": "der sch ein ich ung nd ge ver en zu".split(),
    "fr": "les des que eau oi ent aux ai é è".split(),
    "es": "los que ción ado ar os ñ mente ez ll".split(),
}


@pytest.fixture
def labelled(spark):
    """Documents of four languages, some toxic, and their labels."""
    chooser = random.Random(1)
    docs, labels = [], []
    for at in range(1200):
        lang = chooser.choice(sorted(SYLLABLES))
        words = ["".join(chooser.choices(SYLLABLES[lang], k=chooser.randint(1, 4))) for _ in range(chooser.randint(5, 90))]
        toxic = int(chooser.random() < 0.2)
        for _ in range(3 * toxic):
            words.insert(chooser.randrange(len(words)), chooser.choice(["horridfool", "nastybrute", "vilewretch"]))
        docs.append((at, " ".join(words), lang, "s", 0))
        labels.append((at, 0, toxic))
    return (
        spark.createDataFrame(docs, "doc_id long, text string, lang string, source string, n_chars long").repartition(3),
        spark.createDataFrame(labels, "doc_id long, quality int, toxic int"),
    )


def test_language_of_held_out_documents(labelled):
    documents, _ = labelled
    rows = language_id.languages(documents).join(documents.select("doc_id", "lang"), "doc_id").collect()
    assert len(rows) == 1200 and all(row.held_out == (zlib.crc32(str(row.doc_id).encode()) % 4 == 2) for row in rows)
    held = [row for row in rows if row.held_out]
    assert sum(row.lang == row.lang_pred for row in held) / len(held) > 0.97
    assert all(0 <= row.score <= 1 for row in rows)


def test_language_of_odd_rows(spark, odd, none, labelled):
    rows = language_id.languages(odd).collect()
    assert {row.lang_pred for row in rows if row.doc_id in (1, 2, 3)} == {"und"}
    assert {row.lang_pred for row in rows if row.doc_id in (4, 5, 7)} == {"en"} and len(rows) == 10
    assert language_id.languages(none).count() == 0
    unlearned = spark.createDataFrame([(1, "abc", None)], "doc_id long, text string, lang string")
    assert language_id.languages(unlearned).first().lang_pred == "und"


def peak_of(run):
    """Bytes that ``run`` has at once beyond those it was given."""
    tracemalloc.start()
    try:
        run()
        return tracemalloc.get_traced_memory()[1]
    finally:
        tracemalloc.stop()


def test_a_language_machine_holds_its_vectors_once():
    chooser = np.random.default_rng(3)
    rows = np.sqrt(chooser.poisson(0.1, (1500, language_id.BUCKETS))).astype(np.float32)
    sides = np.where(np.arange(1500) % 3 == 0, 1.0, -1.0)
    assert peak_of(lambda: language_id.train_machine(rows, sides)) < rows.nbytes / 2


def test_a_language_machine_is_the_same_in_any_order_of_rows():
    chooser = np.random.default_rng(4)
    rows = np.sqrt(chooser.poisson(0.2, (90, 64))).astype(np.float32)
    rows[60:] = rows[:30]
    sides = np.where(rows[:, 0] + rows[:, 1] > 0, 1.0, -1.0)
    weights, constant = language_id.train_machine(rows, sides)
    for _ in range(3):
        order = chooser.permutation(90)
        again, other = language_id.train_machine(rows[order], sides[order])
        assert (again == weights).all() and other == constant


def test_language_features_are_those_of_words_joined_by_single_blanks():
    for text in ("a", " x ", "--ab..c--", "é1é", "word  " * 40_000, "z" * 150_000):
        plain = b" " + b" ".join(text.encode().translate(language_id.PLAIN).split()) + b" "
        assert (language_id.vector(text.encode()) == language_id.vector(plain)).all()
        codes, counts = np.frombuffer(plain, np.uint8).astype(np.uint32), np.zeros(language_id.BUCKETS)
        pairs = codes[:-1] * np.uint32(0x9E3779B1) + codes[1:] * np.uint32(0x85EBCA77)
        triples = (pairs[:-1] ^ (codes[2:] * np.uint32(0xC2B2AE3D))) * np.uint32(0x27D4EB2F)
        for places in ((pairs * np.uint32(0x27D4EB2F)) >> np.uint32(20), triples >> np.uint32(20)):
            counts += np.bincount(places, minlength=language_id.BUCKETS)
        assert np.allclose(language_id.vector(text.encode()), np.sqrt(counts / counts.sum()), atol=1e-6)


def test_languages_are_predicted_a_slice_at_a_time():
    model = language_id.LanguageModel({"en": ["en"]}, {}, np.zeros((language_id.BUCKETS, 0)), np.zeros(0))
    text = "some words of a text " * 1600
    size = len(text) * 1500
    batch = pa.RecordBatch.from_pydict({"doc_id": list(range(1500)), "text": [text] * 1500})
    got = []
    assert peak_of(lambda: got.extend(language_id.predicted(iter([batch]), model))) < size / 2
    assert sum(map(len, got)) == 1500 and all(set(part.column("lang_pred").to_pylist()) == {"en"} for part in got)



def test_languages_with_one_or_no_family(labelled):
    documents, _ = labelled
    rows = language_id.languages(documents.where("lang in ('fr', 'es')")).join(documents, "doc_id").collect()
    assert sum(row.lang == row.lang_pred for row in rows) / len(rows) > 0.97
    assert language_id.family_of("pt-BR") == "romance" and language_id.family_of("tlh") == "tlh"


def test_machine_separates():
    points = np.random.default_rng(0).normal(0, 1, (200, 5)).astype(np.float32)
    sides = np.where(points[:, 0] - 2 * points[:, 3] > 0.3, 1.0, -1.0)
    weights, constant = language_id.train_machine(points, sides)
    assert (np.sign(points @ weights + constant) == sides).mean() > 0.95


def test_toxicity_of_held_out_documents(labelled):
    documents, labels = labelled
    rows = toxicity.toxicity(documents, labels).join(labels, "doc_id").collect()
    held = [row for row in rows if row.held_out]
    hits = sum(row.predicted for row in held if row.toxic)
    assert hits / sum(row.toxic for row in held) > 0.95
    assert sum(row.predicted for row in held if not row.toxic) <= 0.02 * len(held)
    assert all(row.predicted == int(row.score >= 0.3) and 0 <= row.score <= 1 for row in rows) and len(rows) == 1200


def test_toxicity_of_odd_rows_and_without_labels(spark, odd, none, labelled):
    documents, labels = labelled
    odd_labels = spark.createDataFrame([(1, 1), (None, 1), (4, None), (99, 0)], "doc_id long, toxic int")
    rows = toxicity.toxicity(odd, odd_labels).collect()
    assert len(rows) == 10 and all(0 <= row.score <= 1 for row in rows)
    assert toxicity.toxicity(none, labels).count() == 0
    assert {row.score for row in toxicity.toxicity(odd, odd_labels.limit(0)).collect()} == {0.0}
    kept = toxicity.without_toxic(odd, labels)
    assert kept.columns == odd.columns


def test_a_text_that_does_not_fit_leaves_the_others_in_the_sample(labelled, monkeypatch):
    documents, labels = labelled
    monkeypatch.setattr(toxicity, "SAMPLE_BYTES", 2 * 400_000)
    known = labels.where(toxicity.remainder("doc_id", 4) != 2)
    order = F.xxhash64("doc_id", F.lit("toxicity"))
    first = [known.where(F.col("toxic") == label).orderBy(order).first().doc_id for label in (0, 1)]
    long = F.when(F.col("doc_id").isin(first), F.repeat(F.lit("word "), 100_000)).otherwise(F.col("text"))
    rows = toxicity.toxicity(documents.withColumn("text", long), labels).join(labels, "doc_id").collect()
    held = [row for row in rows if row.held_out]
    assert sum(row.predicted == row.toxic for row in held) / len(held) > 0.95


def test_scores_follow_the_share_of_all_labels_not_that_of_the_sample(labelled, monkeypatch):
    documents, labels = labelled
    calls, calibrate = [], toxicity.calibrate

    def recorded(gains, toxic):
        calls.append((toxic.mean(), *calibrate(gains, toxic)))
        return calls[-1][1:]

    monkeypatch.setattr(toxicity, "calibrate", recorded)
    monkeypatch.setattr(toxicity, "ORDINARY_TEXTS", 100)
    model = toxicity.fit(documents, labels)
    share = labels.where(toxicity.remainder("doc_id", 4) != 2).agg(F.avg("toxic")).first()[0]
    (sampled, _, _, constant, _) = calls[0]
    assert sampled > 2 * share
    wanted = constant + np.log(share / (1 - share)) - np.log(sampled / (1 - sampled))
    assert abs(model.constant - wanted) < 1e-6


def test_copies_do_not_teach_words():
    texts = [b"alpha beta gamma delta"] * 9 + [b"alpha beta gamma other words here"]
    assert toxicity.without_copies(texts)[0] == texts[0] and len(toxicity.without_copies(texts)) <= 2
    assert toxicity.without_copies([b"", b"a b", b"c d"]) == [b"", b"a b", b"c d"]


def test_windows_cover_the_whole_text():
    text = b" ".join(b"w%d" % at for at in range(100))
    assert b" ".join(window.strip() for window in toxicity.windows(text)) == text
    assert toxicity.windows(b" \n") == []


def plain_features(text):
    """Counts of hashed pairs and triples, byte by byte."""
    plain = b" " + b" ".join(text.translate(language_id.PLAIN).split()) + b" "
    counts, word = np.zeros(language_id.BUCKETS), 1 << 32
    shift = 32 - (language_id.BUCKETS - 1).bit_length()
    for at in range(len(plain) - 1):
        pair = (plain[at] * 0x9E3779B1 + plain[at + 1] * 0x85EBCA77) % word
        counts[pair * 0x27D4EB2F % word >> shift] += 1
        if at + 2 < len(plain):
            counts[(pair ^ plain[at + 2] * 0xC2B2AE3D % word) * 0x27D4EB2F % word >> shift] += 1
    return np.sqrt(counts) / max(np.sqrt(counts.sum()), 1)


@pytest.mark.parametrize("piece", [1, 2, 7, 1 << 20])
def test_features_are_those_of_the_whole_text(monkeypatch, piece):
    monkeypatch.setattr(language_id, "PIECE", piece)
    for text in ("", "a", "Der Hund, 12 Katzen!", "é" * 9, "ab cd " * 20):
        assert np.allclose(language_id.vector(text.encode()), plain_features(text.encode()), atol=1e-6)


def test_votes_by_brute_force():
    random_ = np.random.default_rng(4)
    names = ["a", "b", "c", "d"]
    pairs = [("", x, y) for i, x in enumerate(names) for y in names[i + 1 :]]
    model = language_id.LanguageModel({}, {pair: at for at, pair in enumerate(pairs)}, np.zeros((1, 1)), np.zeros(1))
    for _ in range(200):
        margins = random_.integers(-2, 3, len(pairs)).astype(float)
        votes = {name: [0, 0.0] for name in names}
        for (_, x, y), margin in zip(pairs, margins):
            votes[x][0] += margin > 0
            votes[y][0] += margin < 0
            votes[x][1] += margin
            votes[y][1] -= margin
        best, sure = model._winner("", names, margins)
        assert votes[best] == max(votes.values()) and 0 <= sure <= 1


def test_the_sample_does_not_hang_on_salts(labelled, monkeypatch):
    documents, _ = labelled
    found = {}
    for salts in (1, 7):
        monkeypatch.setattr(language_id, "SALTS", salts)
        monkeypatch.setattr(language_id, "TEXTS_PER_LANGUAGE", 30)
        found[salts] = language_id.fit(documents)
    assert np.allclose(found[1].weights, found[7].weights)


def test_differences_are_those_of_the_windows_by_themselves():
    ordinary, toxic = b"the cat sat on the mat and saw " * 3, b"vilewretch horridfool " + b"the cat sat on the mat and saw " * 3
    text = b"The cat saw a VileWretch on the mat and the horridfool sat " * 4

    def size(window, dictionary):
        return len(toxicity._compressor.__wrapped__(dictionary).compress(window))

    words = text.lower().split()
    wanted = []
    while words:
        window, words = b" " + b" ".join(words[:6]) + b" ", words[6:]
        wanted.append(size(window, ordinary) - size(window, toxic))
    assert toxicity.differences(text, ordinary, toxic).tolist() == wanted and max(wanted) > 3

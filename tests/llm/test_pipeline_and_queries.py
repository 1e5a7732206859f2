from __future__ import annotations

import random
import subprocess
import sys
from pathlib import Path

import duckdb
import pytest

import corpus_pipeline
from tallybook.llm.queries import ORACLES, QUERIES

ROOT = Path(__file__).resolve().parents[2]
SAMPLE = "/root/testdata/sf0.001"
TABLES = ("documents", "benchmark", "pages", "labels", "embeddings", "conversations")
READS = {"op4_warc": "pages", "op11_hard_negatives": "embeddings", "op12_itq_near_copies": "embeddings", "op13_conversation_repair": "conversations"}
INSULTS = ("horridfool", "nastybrute", "vilewretch")


@pytest.fixture(scope="module")
def corpus(tmp_path_factory):
    """Documents with planted cases, their labels and a benchmark, as a folder of tables."""
    chooser = random.Random(12)

    def prose(words):
        parts = ["an", "er", "re", "on", "ti", "ou", "le", "th"]
        return ["".join(chooser.choices(parts, k=chooser.randint(2, 4))) for _ in range(words)]

    clean = {at: " ".join(prose(60)) for at in range(400)}
    toxic = {}
    for at in range(400, 520):
        words = prose(60)
        for _ in range(4):
            words.insert(chooser.randrange(60), chooser.choice(INSULTS))
        toxic[at] = " ".join(words)
    copies = {600 + at: clean[at].replace(" ", "  ", at % 3) for at in range(20)}
    near = {700 + at: clean[50 + at] + " changed" for at in range(20)}
    items = [" ".join(prose(15)) for _ in range(10)]
    leaks = {800 + at: " ".join([*prose(30), *item.upper().split()[2:13], *prose(30)]) for at, item in enumerate(items)}
    empty = {900: "", 901: None, 902: " \n"}
    rows = {**clean, **toxic, **copies, **near, **leaks, **empty}
    folder = tmp_path_factory.mktemp("corpus")
    con = duckdb.connect()
    con.execute("CREATE TABLE documents (doc_id BIGINT, text VARCHAR, lang VARCHAR, source VARCHAR, n_chars BIGINT)")
    con.executemany("INSERT INTO documents VALUES (?, ?, 'en', 's', 0)", list(rows.items()))
    con.execute("CREATE TABLE labels (doc_id BIGINT, quality INTEGER, toxic INTEGER)")
    con.executemany("INSERT INTO labels VALUES (?, 0, ?)", [(at, int(at in toxic)) for at in [*range(300), *range(400, 500)]])
    con.execute("CREATE TABLE benchmark (item_id BIGINT, text VARCHAR)")
    con.executemany("INSERT INTO benchmark VALUES (?, ?)", list(enumerate(items)))
    for name in ("documents", "labels", "benchmark"):
        con.execute(f"COPY {name} TO '{folder}/{name}.parquet' (FORMAT parquet)")
    kept = {at: copies.get(600 + at, text) for at, text in clean.items()}
    stays = {at for at in clean if len(kept[at]) <= len(clean[at])} | {600 + at for at in range(20) if len(kept[at]) > len(clean[at])}
    return str(folder), toxic, stays, near, leaks


def test_names_and_order_of_the_stages():
    assert [name for name, _ in corpus_pipeline.STAGES] == [
        "toxicity", "exact_dedup", "jaccard_join", "decontamination", "best_fit_packing"
    ]


def test_every_stage_takes_effect(spark, corpus, tmp_path):
    folder, toxic, stays, near, leaks = corpus
    docs = spark.read.parquet(f"{folder}/documents.parquet")
    columns, seen = docs.columns, []
    for name, stage in corpus_pipeline.STAGES:
        stage(spark, docs, folder).write.parquet(f"{tmp_path}/{name}")
        docs = spark.read.parquet(f"{tmp_path}/{name}")
        if name != "best_fit_packing":
            assert docs.columns == columns
        seen.append({row.doc_id for row in docs.select("doc_id").collect()})
    not_toxic, distinct, apart, clean, packed = seen
    assert len(toxic.keys() & not_toxic) <= 3 and len((stays | near.keys() | leaks.keys()) - not_toxic) <= 3
    assert distinct - toxic.keys() == (stays | near.keys() | leaks.keys() | {902}) & not_toxic
    assert apart - toxic.keys() == (stays | leaks.keys() | {902}) & not_toxic
    assert clean == apart - leaks.keys() and packed == clean
    sequences = docs.groupBy("sequence_id").sum("length").collect()
    assert all(row[1] <= 4096 for row in sequences)


def test_run_gives_the_rows_of_the_last_stage(spark, corpus):
    assert "sequence_id" in corpus_pipeline.run(spark, corpus[0]).columns


def test_stages_take_empty_tables(spark, corpus):
    docs = spark.read.parquet(f"{corpus[0]}/documents.parquet").limit(0)
    for _, stage in corpus_pipeline.STAGES:
        assert stage(spark, docs, corpus[0]).count() == 0


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_queries_on_the_smallest_tables(spark, name):
    found = QUERIES[name](spark, SAMPLE)
    rows = found.collect()
    key = found.columns[0]
    table = spark.read.parquet(f"{SAMPLE}/{READS.get(name, 'documents')}.parquet")
    if name == "op11_hard_negatives":  # rows of the anchors alone
        table = table.where("vec_id % 100 = 0").withColumnRenamed("vec_id", key)
    wanted = {row[0] for row in table.select(key).collect()}
    assert {row[key] for row in rows} == wanted
    if name in ORACLES:
        con = duckdb.connect()
        for view in TABLES:
            con.execute(f"CREATE VIEW {view} AS SELECT * FROM '{SAMPLE}/{view}.parquet'")
        columns = ", ".join(found.columns)
        oracle = con.execute(f"SELECT {columns} FROM ({ORACLES[name]})").fetchall()
        assert sorted(map(repr, map(tuple, rows))) == sorted(map(repr, oracle))
    else:
        assert len(rows) >= len(wanted)


def test_the_rest_works_without_this_package(tmp_path):
    """A copy of the library without the package still registers its other queries."""
    for source in [ROOT / "__spark_entry__.py", *ROOT.glob("tallybook/**/*.py")]:
        if "llm" not in source.parts:
            target = tmp_path / source.relative_to(ROOT)
            target.parent.mkdir(parents=True, exist_ok=True)
            target.write_text(source.read_text(encoding="utf-8"), encoding="utf-8")
    code = "import __spark_entry__ as e; q = e.queries(); assert len(q) > 40 and not any(n.startswith('op') for n in q)"
    subprocess.run([sys.executable, "-B", "-c", code], cwd=tmp_path, check=True, timeout=120)


def test_stages_take_odd_rows_and_extra_columns(spark, corpus, odd, tmp_path):
    docs, left = odd, []
    for name, stage in corpus_pipeline.STAGES:
        columns = docs.columns
        stage(spark, docs, corpus[0]).write.parquet(f"{tmp_path}/{name}")
        docs = spark.read.parquet(f"{tmp_path}/{name}")
        if name != "best_fit_packing":
            assert docs.columns == columns
            left.append(sorted((row.doc_id is None, row.doc_id or 0) for row in docs.select("doc_id").collect()))
    unnamed = [(True, 0)] * 2
    assert left[0] == [(False, at) for at in (1, 2, 3, 4, 5, 5, 6, 7)] + unnamed
    # of the blank ones the longest stays, of equal ones the first; rows without id are never dropped
    assert left[1] == left[2] == left[3] == [(False, at) for at in (3, 4, 6, 7)] + unnamed
    pieces = docs.groupBy("doc_id").agg({"length": "sum", "piece": "max"}).collect()
    assert {row.doc_id for row in pieces} == {3, 4, 6, 7, None}
    assert next(row["sum(length)"] for row in pieces if row.doc_id == 7) > 4096

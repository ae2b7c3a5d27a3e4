"""The queries against their SQL and contracts on test data, and the pipeline stage by stage."""

import os
import zlib

import duckdb
import numpy as np
import pytest
from tokenizers import Tokenizer

import corpus_pipeline
from fareflow.llm.common import stored, table, tokenizer_file
from fareflow.llm.decontaminate import shingles
from fareflow.llm.queries import GOOD, ORACLE_SQL, QUERIES
from fareflow.llm.simhash_dedup import fingerprint

SF = os.environ.get("FAREFLOW_TEST_SF", "/root/testdata/sf0.001")


@pytest.fixture(scope="module")
def con():
    c = duckdb.connect()
    for name in ("documents", "embeddings", "benchmark", "labels"):
        c.execute(f"CREATE VIEW {name} AS SELECT * FROM read_parquet('{SF}/{name}.parquet')")
    return c


@pytest.mark.parametrize("name", sorted(ORACLE_SQL))
def test_sql(spark, con, name):
    got = QUERIES[name](spark, SF).toPandas()
    wanted = con.execute(ORACLE_SQL[name]).fetchdf()
    columns = sorted(got.columns)
    assert sorted(wanted.columns) == columns
    order = lambda df: df[columns].sort_values(columns).reset_index(drop=True)
    assert order(got).equals(order(wanted))


def test_held_out_accuracy(spark, con):
    lang = dict(con.execute("SELECT doc_id, lang FROM documents").fetchall())
    rows = QUERIES["op2_language_id"](spark, SF).collect()
    held = [r for r in rows if r.held_out]
    assert all(r.held_out == (zlib.crc32(str(r.doc_id).encode()) % 4 == 2) for r in rows)
    assert sum(r.lang_pred == lang[r.doc_id] for r in held) >= 0.95 * len(held)
    label = dict(con.execute("SELECT doc_id, quality FROM labels").fetchall())
    rows = QUERIES["op7_quality"](spark, SF).collect()
    held = [r for r in rows if r.held_out and r.doc_id in label]
    assert all(r.predicted == int(r.score >= GOOD) for r in rows)
    assert sum(r.predicted == label[r.doc_id] for r in held) >= 0.9 * len(held)


def test_pipeline_stages(spark):
    """Each stage on the real output of the one before, against what it says it does."""
    docs = table(spark, SF, "documents")
    columns = docs.columns
    for name, stage in corpus_pipeline.STAGES:
        out = stored(stage(spark, docs, SF), f"test-{name}")
        before, after = {r.doc_id: r for r in docs.collect()}, out.collect()
        if name == "packing":
            tokenizer = Tokenizer.from_file(tokenizer_file("word_bpe_49k.json"))
            ids = {k: np.array([*tokenizer.encode(r.text, add_special_tokens=False).ids, 1], "<u4") for k, r in before.items()}
            assert all(zlib.crc32(ids[r.doc_id][r.start:r.start + r.length].tobytes()) == r.ids_crc32 for r in after)
            assert sum(r.length for r in after) == sum(map(len, ids.values()))
            return
        assert out.columns == columns and len({r.doc_id for r in after}) == len(after)
        if name == "quality":
            scores = {r.doc_id: r.predicted for r in QUERIES["op7_quality"](spark, SF).collect()}
            assert {r.doc_id for r in after} == {d for d in before if scores[d]}
        if name == "line_dedup":
            assert {r.doc_id for r in after} == set(before) and all(r.n_chars == len(r.text) for r in after)
        if name == "near_duplicates":
            prints = {d: fingerprint(r.text) for d, r in before.items()}
            left = [r.doc_id for r in after]
            assert all((prints[a] ^ prints[b]).bit_count() > 4 for i, a in enumerate(left) for b in left[:i])
            gone = set(before) - set(left)  # each has a link to some document
            assert all(any(d != e and (prints[d] ^ prints[e]).bit_count() <= 4 for e in before) for d in gone)
        if name == "decontamination":
            items = [set(shingles(r.text, 5)) for r in table(spark, SF, "benchmark").collect()]
            hit = {d for d, r in before.items() if any(len(i & set(shingles(r.text, 5))) >= 0.8 * len(i) for i in items)}
            assert {r.doc_id for r in after} == set(before) - hit
        docs = out

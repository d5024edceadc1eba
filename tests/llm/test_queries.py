"""The registered queries: their columns, the SQL of those that have it, and the pipeline against brute force."""

from pathlib import Path

import duckdb
import pytest

import corpus_pipeline
from curatrix.llm import queries
from curatrix.llm.common import union_find
from tests.llm.test_operators import shingles
from tests.test_catalogue import rows

DATA = Path("/root/testdata/sf0.001")
COLUMNS = {
    "op3_": ["doc_id", "held_out", "lang_pred", "score"], "op4_": ["doc_id", "n_shingles", "component_id"], "op5_": ["doc_id", "size", "source_size", "target", "taken"],
    "op6_": ["doc_id", "held_out", "score", "predicted"], "op7_": ["doc_id", "n_assign", "n_access", "n_hex", "base_sha256", "spans"], "op9_": ["vec_id", "n_links", "component_id", "kept"],
    "op10_": ["doc_id", "size", "text_crc32", "law", "shard", "slot", "grown_shard"],
    "op11_": ["word", "form", "root", "n", "n_near", "form_n"], "op12_": ["query_id", "rank", "vec_id", "score"], "op13_": ["item_id", "rank", "doc_id", "score"],
    "secret_": ["doc_id", "n_assign", "n_access", "n_hex", "base_sha256"], "embedding_": ["vec_id", "n_links", "component_id", "kept"],
}


@pytest.mark.parametrize("name", sorted(queries.queries()))
def test_query(spark, name):
    got = queries.queries()[name](spark, str(DATA))
    want = next((v for k, v in COLUMNS.items() if name.startswith(k)), [])
    assert got.columns[: len(want)] == want
    if name in queries.oracle_sql():
        con = duckdb.connect()
        for f in DATA.glob("*.parquet"):
            con.sql(f"CREATE VIEW {f.stem} AS SELECT * FROM '{f}'")
        want = con.sql(queries.oracle_sql()[name])
        if name.startswith("op11_"):  # whole numbers with nulls
            assert sorted(map(repr, map(tuple, got.collect()))) == sorted(map(repr, want.fetchall()))
        else:
            assert rows(got.toPandas()) == rows(want.df())
    elif not name.startswith("op9_"):
        assert got.count() == 200
    else:
        assert got.count() == 500


def test_pipeline(spark):
    docs = spark.read.parquet(str(DATA / "documents.parquet"))
    assert [n for n, _ in corpus_pipeline.STAGES] == ["language_id", "near_copies", "decontamination", "mixing", "sharding"]
    known = corpus_pipeline.known_language(spark, docs, str(DATA))
    assert known.columns == docs.columns and known.count() == 200  # all are in known languages
    texts = [(r.doc_id, r.text) for r in docs.orderBy("doc_id").collect()]
    sets = [shingles(t) for _, t in texts]
    root = union_find(len(sets), [(i, j) for i in range(len(sets)) for j in range(i) if 100 * len(sets[i] & sets[j]) >= 75 * len(sets[i] | sets[j])])
    single = corpus_pipeline.without_copies(spark, docs, str(DATA))
    assert sorted(r.doc_id for r in single.collect()) == [texts[i][0] for i in range(len(texts)) if root[i] == i]
    pure = corpus_pipeline.without_benchmark(spark, docs, str(DATA))
    items = [" ".join(r.text.lower().split()) for r in spark.read.parquet(str(DATA / "benchmark.parquet")).collect()]
    leaked = {i for i, t in texts if any(x in " ".join(t.lower().split()) for x in items)}
    assert {r.doc_id for r in pure.collect()} == {i for i, _ in texts} - leaked
    out = corpus_pipeline.run(spark, str(DATA))
    assert out.columns == [*docs.columns, "vslot", "shard"]
    stages = [r.doc_id for r in out.collect()]
    assert set(stages) <= {texts[i][0] for i in range(len(texts)) if root[i] == i} - leaked and len(stages) > 100
    assert sorted(stages) == sorted(r.doc_id for r in corpus_pipeline.run(spark, str(DATA)).collect())

"""The pipeline's stages on odd tables: nulls, empty and long texts, repeated rows, no rows, clashing columns."""

from collections import Counter

import pytest

import corpus_pipeline
from curatrix.llm import mixing
from tests.llm.test_operators import BASE, documents, edited, key, prose

ITEM = prose(77, 30)
WORDLESS = [(1, None), (2, ""), (3, " \t\n"), (None, None), (1, None)]
TEXTS = [
    *WORDLESS, (10, BASE), (11, BASE), (12, edited(BASE, 9)), (10, BASE), (None, prose(4)), (None, prose(4)), (None, prose(5)), (13, "12 !! ??"), (14, prose(6, 9000)), (15, f"{prose(8)} {ITEM} {prose(9)}"),
    (15, prose(10)), *((100 + k, prose(200 + k, 30)) for k in range(60)),
]
STAGES = dict(corpus_pipeline.STAGES)


@pytest.fixture(scope="module")
def folder(spark, tmp_path_factory):
    at = tmp_path_factory.mktemp("sf")
    spark.createDataFrame([(1, ITEM), (2, None), (3, "")], "item_id long, text string").write.parquet(f"{at}/benchmark.parquet")
    documents(spark, TEXTS).drop("Text").write.parquet(f"{at}/only_names.parquet")
    return str(at)


def told(df):
    return Counter((r.doc_id, r[1]) for r in df.collect())


def test_stages_keep_columns_and_define_odd_rows(spark, folder):
    docs = documents(spark, TEXTS)
    for name, stage in corpus_pipeline.STAGES:
        out = stage(spark, docs, folder)
        if name == "sharding":
            assert out.columns == [c for c in docs.columns if c not in ("vslot", "shard")] + ["vslot", "shard"]
        else:
            assert out.schema == docs.schema, name
    assert told(STAGES["language_id"](spark, docs, folder)) == Counter(t for t in TEXTS if t not in WORDLESS and t[0] != 13)
    single = told(STAGES["near_copies"](spark, docs, folder))
    gone = Counter({(11, BASE): 1, (12, edited(BASE, 9)): 1, (10, BASE): 1, (None, prose(4)): 1})
    assert single == Counter(TEXTS) - gone
    leak = (15, f"{prose(8)} {ITEM} {prose(9)}")
    assert told(STAGES["decontamination"](spark, docs, folder)) == Counter(t for t in TEXTS if t != leak)
    assert told(STAGES["sharding"](spark, docs, folder)) == Counter(TEXTS)


def test_mixing_stage_takes_what_the_query_says(spark, folder):
    docs = documents(spark, TEXTS)
    taken = Counter()
    for r in mixing.mix(spark, docs).collect():
        taken[r.doc_id] += r.copies
    mixed = STAGES["mixing"](spark, docs, folder)
    assert Counter(r.doc_id for r in mixed.collect()) == +taken
    assert max(Counter(map(tuple, mixed.collect())).values()) <= 3 * max(Counter(map(tuple, docs.collect())).values())


def test_no_rows(spark, folder):
    none = documents(spark, [])
    for _, stage in corpus_pipeline.STAGES:
        assert stage(spark, none, folder).count() == 0


def test_without_any_language_all_go(spark, folder):
    from pyspark.sql import functions as F

    docs = documents(spark, TEXTS).withColumn("lang", F.lit(None).cast("string"))
    assert STAGES["language_id"](spark, docs, folder).count() == 0


def test_run_equals_its_stages(spark, folder, tmp_path):
    rows = spark.read.parquet(f"{folder}/only_names.parquet")
    texts = spark.createDataFrame([(i, t, "en" if k % 3 else "de", ["s1", "s2", None][k % 3]) for k, (i, t) in enumerate(TEXTS)], "doc_id long, text string, lang string, source string")
    texts.write.parquet(f"{tmp_path}/documents.parquet")
    spark.read.parquet(f"{folder}/benchmark.parquet").write.parquet(f"{tmp_path}/benchmark.parquet")
    docs = spark.read.parquet(f"{tmp_path}/documents.parquet")
    for _, stage in corpus_pipeline.STAGES:
        docs = stage(spark, docs, str(tmp_path))
    out = corpus_pipeline.run(spark, str(tmp_path))
    assert out.columns == ["doc_id", "text", "lang", "source", "vslot", "shard"] and rows.count() == len(TEXTS)
    assert sorted(map(tuple, out.collect()), key=key) == sorted(map(tuple, docs.collect()), key=key)

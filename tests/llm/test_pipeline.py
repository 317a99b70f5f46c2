"""The pipeline's stages and the registered text queries."""

import pytest
from compare import connect, differences
from pyspark.sql import functions as F
from test_duplicates import groups, removed

import corpus_pipeline
from tradewind.llm.common import stored
from tradewind.llm.queries import QUERIES
from tradewind.llm.sql import ORACLE


SMALL = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def duck():
    return connect(SMALL)


@pytest.mark.parametrize("name", ORACLE)
def test_query_equals_its_twin(spark, duck, name):
    assert differences(QUERIES[name](spark, SMALL), duck, ORACLE[name]) == []


@pytest.mark.parametrize("name", [n for n in QUERIES if n not in ORACLE and n != "pipeline"])
def test_other_queries_answer_every_document(spark, name):
    docs = spark.read.parquet(f"{SMALL}/documents.parquet")
    got = QUERIES[name](spark, SMALL)
    assert got.select("doc_id").distinct().count() == docs.count()
    if name.startswith("op7"):
        assert got.where("not exact").count() == 0


@pytest.fixture(scope="module")
def stages(spark):
    docs, out = spark.read.parquet(f"{SMALL}/documents.parquet"), []
    odd = [(10_001, None, None, None, None), (10_002, "", "en", "s", 0), (10_003, "12 34 !", "en", "s", 7)]
    docs = docs.unionByName(spark.createDataFrame(odd, docs.schema)).withColumn("kept_id", F.lit(1)).withColumn("label", F.lit("x"))
    for name, stage in corpus_pipeline.STAGES:
        after = stored(stage(spark, docs, SMALL), name)
        out.append((docs, after))
        docs = after
    return out


def test_language_stage(stages):
    before, after = stages[0]
    lost = before.join(after, "doc_id", "left_anti").select("doc_id").collect()
    assert {r.doc_id for r in lost} >= {10_001, 10_002, 10_003} and len(lost) <= 3 + 0.02 * before.count()
    assert after.columns == corpus_pipeline.COLUMNS


def test_near_duplicate_stage_keeps_one_of_each_group(stages):
    before, after = stages[1]
    of = groups([(r.doc_id, r.text) for r in before.collect()])
    assert {r.doc_id for r in after.collect()} == {i for i, (_, c) in of.items() if i == c}


def test_repeats_stage_cuts_texts(stages):
    before, after = stages[2]
    want = removed([(r.doc_id, r.text) for r in before.collect()], 100)
    got = {r.doc_id: r for r in after.collect()}
    assert set(got) == {i for i, (n, gone, _, _) in want.items() if n > gone}
    assert all(r.n_chars == len(r.text) for r in got.values())
    assert all(abs(len(r.text.encode()) - (want[i][0] - want[i][1])) <= 3 * 2 * want[i][2] for i, r in got.items())


def test_mixing_stage_repeats_rows(spark, stages):
    import duckdb

    from tradewind.llm.sql import mix_sql

    before, after = stages[3]
    con = duckdb.connect()
    con.register("before", before.drop("text").toArrow())
    want = con.execute(f"select doc_id, count(*) from ({mix_sql('before')}) group by doc_id").fetchall()
    assert dict(want) == {r.doc_id: r["count"] for r in after.groupBy("doc_id").count().collect()}


def test_last_stage_encodes_every_row(spark, stages):
    from tradewind.llm import segmentation

    before, after = stages[4]
    assert after.where("sample = 1").count() == before.count()
    texts = {r.doc_id: r.text for r in before.collect()}
    assert all(r.text == texts[r.doc_id] for r in segmentation.decode(after, corpus_pipeline.VOCABULARY).collect())


def test_stages_keep_rows_with_equal_and_null_ids(spark):
    a, b, c = (" ".join(f"{x}{i}" for i in range(80)) for x in "abc")
    rows = [(1, a, "en", "s", 1), (1, b, "de", "s", 1), (2, c, "en", "s", 1), (None, "d" + c[::-1], None, None, None), (2, c, "en", "s", 1)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, lang string, source string, n_chars long")
    texts = lambda df: sorted((str(r.doc_id), r.text, str(r.lang)) for r in df.collect())
    one_each = texts(docs.dropDuplicates())
    assert texts(corpus_pipeline.drop_near_duplicates(spark, docs, SMALL)) == one_each
    assert texts(corpus_pipeline.drop_repeats(spark, docs, SMALL)) == one_each


def test_copies_are_sampled_apart(spark):
    text = "xqzjvkwp bvnmzxq wkjhgfq zzxcvbp " * 8
    docs = spark.createDataFrame([(1, text)] * 4 + [(None, text)] * 2 + [(1, text + "x")], "doc_id long, text string")
    got = corpus_pipeline.encode_pieces(spark, docs, SMALL).where("sample = 1")
    assert got.count() == 7 and got.select("pieces").distinct().count() == 7


def test_run_and_empty_table(spark, tmp_path):
    assert corpus_pipeline.run(spark, SMALL).count() > 0
    docs = spark.read.parquet(f"{SMALL}/documents.parquet").limit(0)
    for name, stage in corpus_pipeline.STAGES:
        docs = stored(stage(spark, docs, SMALL), name)
    assert docs.count() == 0

"""Documents are kept packed, and no text of theirs is shuffled."""

import re
from pathlib import Path

from pyspark.sql import functions as F

from tradewind.plans.registry_loads import docs
from tradewind.plans.registry_more import bulk
from tradewind.sources import documents
from tradewind.sources import generated_documents as gen
from tradewind.sources.bulk import CHILDREN, child_documents


def shuffled(df):
    """What each shuffle of a plan moves, as (how, columns)."""
    plan = df._jdf.queryExecution().explainString(df.sparkSession._jvm.org.apache.spark.sql.execution.ExplainMode.fromString("formatted"))
    return re.findall(r"\) Exchange\nInput \[\d+\]: \[(.*)\]\nArguments: (\w+)", plan)


def test_documents_are_kept_packed(warehouse):
    for page in ("orders", "lines"):
        docs(warehouse, page)
        files = list(Path(warehouse.document_paths[page]).glob("part-*"))
        assert files and all(f.suffix == ".gz" for f in files)
        plain = warehouse.spark.read.text(warehouse.document_paths[page]).agg(F.sum(F.length("value"))).first()[0]
        assert sum(f.stat().st_size for f in files) * 5 < plain
    bulk(warehouse)
    assert all(f.suffix == ".gz" for f in Path(warehouse.document_paths["bulk"]).glob("part-*"))


def test_packed_files_are_bounded(spark, tmp_path):
    spark.range(500_000).coalesce(1).write.options(**documents.PACKED).json(str(tmp_path / "d"))
    assert len(list((tmp_path / "d").glob("part-*"))) == 3 and spark.read.json(str(tmp_path / "d")).distinct().count() == 500_000


def test_no_text_is_shuffled(warehouse):
    made = shuffled(gen.bulk_lines(warehouse.base, warehouse.stg))
    assert made and not any(re.search(r"\b(value|transactions|taxLines|fulfillments#|node)", columns) for columns, _ in made)
    lines = bulk(warehouse)
    for page in CHILDREN:
        assert not any(re.search(r"\bvalue#", columns) for columns, _ in shuffled(child_documents(lines, page)))


def test_line_lists_are_grouped_where_lines_lie(warehouse, spark):
    spark.conf.set("spark.sql.shuffle.partitions", "4")
    assert shuffled(gen.line_list_documents(warehouse.base, warehouse.stg)) == []


def test_staged_orders_stay_where_they_lie(warehouse, spark):
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        assert [re.findall(r"\w+(?=#)", columns) for columns, _ in shuffled(gen.order_documents(warehouse.base, warehouse.stg))] == [
            ["order_num", "o_orderkey", "o_orderdate", "o_totalprice"]
        ]
        made = shuffled(gen.bulk_lines(warehouse.base, warehouse.stg))
        assert made and not any(re.search(r"\b(shipping_address_json|tracking_url|note|collect_list|buf)#", columns) for columns, _ in made)
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")


def test_lines_are_made_without_a_stored_copy(warehouse):
    for made in (gen.line_documents, gen.fulfillment_line_documents, gen.refund_line_documents):
        assert not any("/stg_" in f for f in made(warehouse.base, warehouse.stg).inputFiles())

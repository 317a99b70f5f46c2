import pytest
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from tradewind.operators.row_index import row_index, tile_index


def keys(spark, rows, hot):
    """A third or more of the rows share one value of ``v`` when ``hot``."""
    value = F.when(F.col("id") % 3 != 0, 7).otherwise(F.col("id") % 11) if hot else F.col("id") * 37 % 1001
    return spark.range(rows).select(F.col("id").cast("string").alias("k"), F.when(F.col("id") % 13 != 0, value).alias("v"))


@pytest.mark.parametrize("partitions", [None, 1, 3, 7])
@pytest.mark.parametrize("hot", [False, True])
def test_matches_global_window(spark, partitions, hot):
    df = keys(spark, 500, hot)
    order = [F.col("v").asc_nulls_last(), F.col("k")]
    got = {r.k: r.n for r in row_index(df, order, "n", partitions=partitions).collect()}
    want = {r.k: r.n for r in df.withColumn("n", F.row_number().over(W.orderBy(*order))).collect()}
    assert got == want


@pytest.mark.parametrize("rows", [0, 1, 3, 5, 7, 23])
def test_tiles_match_ntile(spark, rows):
    df = keys(spark, rows, False)
    order = [F.col("v").asc_nulls_last(), F.col("k")]
    got = {r.k: r.t for r in tile_index(df, order, 5, "t", partitions=3).collect()}
    want = {r.k: r.t for r in df.withColumn("t", F.ntile(5).over(W.orderBy(*order))).collect()}
    assert got == want


def test_result_is_stable(spark):
    indexed = row_index(keys(spark, 200, True), [F.col("v"), F.col("k")], "n", partitions=5)
    assert sorted(indexed.collect()) == sorted(indexed.collect())
    assert indexed.select("n").distinct().count() == 200

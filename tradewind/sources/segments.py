"""The campaign segment list, kept by hand as CSV with a byte-order mark and quoted line breaks."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tradewind.functions.scalars import null_if_empty
from tradewind.sources import schemas

_OPTIONS = {"header": True, "multiLine": True, "quote": '"', "escape": '"', "encoding": "UTF-8"}
# fixed values: cells that stand for "no value"
_NO_VALUE = ("NULL", "#N/A")


def read_segments(spark: SparkSession, path: str) -> DataFrame:
    """Declared columns by position, so a byte-order mark before the header does no harm."""
    df = spark.read.options(**_OPTIONS).schema(schemas.ddl("stg_campaign_segments")).csv(path)
    return df.select([F.when(~F.col(c).isin(*_NO_VALUE), null_if_empty(F.col(c))).alias(c) for c in df.columns])


def write_segments(df: DataFrame, path: str) -> None:
    df.write.options(header=True, quoteAll=True, escape='"', encoding="UTF-8").csv(path)

"""Result contracts: the names, order and plain types a registered query shows.

One letter per column: i whole number, m money with two decimals, r rate as double,
s text, d day, t timestamp, b flag. Days and timestamps are shown as text, so that any
client compares them alike.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tradewind.sources import schemas

Contract = list[tuple[str, str]]


def contract(text: str) -> Contract:
    """``"order_id:s total:m"`` to pairs."""
    return [tuple(item.split(":")) for item in text.split()]


def of_table(table: str, hidden: tuple[str, ...] = ("loaded_at",)) -> Contract:
    kinds = {"string": "s", "int": "i", "bigint": "i", "boolean": "b", "date": "d", "timestamp_ntz": "t"}

    def kind(dtype: str) -> str:
        if dtype.startswith("decimal"):
            return "m" if dtype.endswith(",2)") else "r"
        return kinds[dtype]

    return [(name, kind(dtype)) for name, dtype in schemas.columns(table) if name not in hidden]


def _shown(name: str, kind: str) -> Column:
    c = F.col(name)
    value = {
        "i": lambda: c.cast("bigint"),
        "m": lambda: c.cast("decimal(28,2)").cast("double"),
        "r": lambda: c.cast("double"),
        "s": lambda: c.cast("string"),
        "d": lambda: c.cast("date").cast("string"),
        "t": lambda: F.date_format(c, "yyyy-MM-dd HH:mm:ss.SSSSSS"),
        "b": lambda: c.cast("boolean"),
    }[kind]()
    return value.alias(name)


def present(df: DataFrame, shown: Contract) -> DataFrame:
    return df.select([_shown(name, kind) for name, kind in shown])

"""What one task sorts stays the same at any size, and lines move as base rows."""

import re

from test_packed import shuffled

from tradewind.plans import warehouse as wh
from tradewind.sources import adapter
from tradewind.sources.tables import TableStore


def test_buckets_follow_the_lines(spark, tmp_path):
    assert [wh.buckets_for(n) for n in (0, 600_000, 36_000_000, 216_000_000)] == [8, 8, 72, 432]
    asked = []
    store = TableStore(spark, str(tmp_path / "s"), lambda: asked.append(1) or 24)
    assert not asked and store.buckets == 24 == store.buckets and len(asked) == 1


def test_lines_move_as_base_rows_to_their_buckets(warehouse):
    dealt = adapter.order_line_items(warehouse.base, lambda rows, order: rows.repartition(8, order))
    [(columns, _)] = shuffled(dealt)
    assert "l_orderkey" in columns and not re.search(r"\b(title|line_id|sku|order_id)#", columns)
    for table in ("stg_order_line_items", "stg_fulfillments", "stg_refunds"):
        files = warehouse.stg.co_located(table).inputFiles()
        assert len(files) == len({re.search(r"_(\d{5})\.", f).group(1) for f in files}) <= 8  # a bucket in one file

"""Top-k search, WARC, mixing."""

import hashlib
import math
import random

import numpy as np
import pytest
from pyspark.sql import functions as F

from tradewind.llm import mixing, top_k, warc
from tradewind.session import scratch_path


def brute(rows, k):
    x = {}
    for i, v in rows:
        if i is not None and v and all(c is not None and math.isfinite(c) for c in v):
            x.setdefault(i, []).append([math.floor(256 * c) for c in v])
    out = []
    for q in x:
        for own in x[q] if q % 50 == 0 else ():
            best = sorted(((-sum(a * b for a, b in zip(own, v)), i) for i in x for v in x[i] if i != q))[:k]
            out += [(q, i, -s) for s, i in best]
    return sorted(out)


@pytest.mark.parametrize("block", [7, 64, 4096])
def test_top_k_against_brute_force(spark, monkeypatch, block):
    monkeypatch.setattr(top_k, "BLOCK", block)
    monkeypatch.setattr(top_k, "QUERIES", 3)
    rng = np.random.default_rng(5)
    rows = [(i, rng.normal(size=6).round(2).tolist()) for i in range(300)]
    rows += [(300, [1.0] * 6), (301, [1.0] * 6), (302, [1.0] * 6), (350, [0.0] * 6), (303, None), (304, []), (305, [None] * 6), (306, [math.inf] * 6), (307, [math.nan] * 6), (None, [1.0] * 6)]
    table = spark.createDataFrame([(*r, 1, 2.0) for r in rows], "vec_id long, embedding array<float>, x int, score double")
    rows = [(i, None if v is None else [None if c is None else float(np.float32(c)) for c in v]) for i, v in rows]
    got = top_k.top_k(table, F.col("id") % 50 == 0)
    assert sorted((r.query_id, r.vec_id, r.score) for r in got.collect()) == brute(rows, 5)
    assert got.groupBy("query_id").agg(F.max("rank").alias("m")).where("m <> 5").count() == 0
    few = table.where("vec_id in (0, 1, 2)")
    assert top_k.top_k(few, F.col("id") % 50 == 0).count() == 2
    assert top_k.top_k(table.limit(0), F.col("id") % 50 == 0).count() == 0


def test_search_stops_early():
    rng = np.random.default_rng(1)
    lists = top_k.SortedLists(np.arange(4000), rng.integers(-100, 100, size=(4000, 2)))
    reads = []
    lists.x, rest = type("Counted", (), {"__getitem__": lambda self, rows: (reads.append(len(rows)), rest[rows])[1]})(), lists.x
    lists.top(-1, np.array([3, 1]), 5)
    assert sum(reads) < 1000


def counted(lists):
    """The number of vectors scored from now on."""
    reads, rest = [], lists.x
    lists.x = type("Counted", (), {"__getitem__": lambda self, rows: (reads.append(len(rows)), rest[rows])[1]})()
    return reads


def test_a_floor_ends_searches_of_other_blocks():
    rng = np.random.default_rng(3)
    x = rng.integers(-100, 100, size=(8000, 3))
    q = np.array([5, 2, -1])
    floor = int(np.sort(x[:4000] @ q)[-5])
    lists = top_k.SortedLists(np.arange(4000, 8000), x[4000:])
    reads = counted(lists)
    ids, scores = lists.top(-1, q, 5, floor)
    wanted = [(s, i) for s, i in zip(x[4000:] @ q, range(4000, 8000)) if s >= floor]
    assert set(wanted) <= set(zip(scores.tolist(), ids.tolist())) or len(wanted) > 5
    with_floor = sum(reads)
    reads.clear()
    lists.top(-1, q, 5)
    assert with_floor <= sum(reads) < 4000


def test_every_vector_is_met_where_the_bound_cannot_end():
    # unit vectors without structure in 64 dimensions: the lists meet all of them before the bound falls
    rng = np.random.default_rng(7)
    x = rng.normal(size=(2000, 64))
    x = np.floor(256 * x / np.linalg.norm(x, axis=1, keepdims=True)).astype(np.int64)
    lists = top_k.SortedLists(np.arange(2000), x)
    reads = counted(lists)
    ids, scores = lists.top(0, x[0], 5)
    order = np.lexsort((np.arange(2000), -(x @ x[0])))
    assert ids.tolist() == [i for i in order if i][:5] and sum(reads) == 1999


@pytest.fixture
def pages(spark):
    big = "<p>é" + "x" * 100
    rows = [(5, "u5", big), (3, "u3", big), (9, None, big), (1, "u1", "tiny"), (2, "u2", "tiny"), (4, "u4", None), (6, "u\r\nX: y", ""), (7, "u7", "WARC/1.1\r\n\r\n" * 20), (8, "u8", "z" * 3_000_000), (None, "n", "q")]
    return spark.createDataFrame([(*r, "clash", 1) for r in rows], "page_id long, url string, html string, record_type string, payload_bytes int").repartition(4)


def test_archives_round_trip(spark, pages):
    path = scratch_path(spark, "warc-test")
    warc.write(warc.deduplicated(pages), path)
    rows = {r.record_id: r for r in warc.read(spark, path).collect()}
    html = {r.page_id: (r.html or "").encode() for r in pages.where("page_id is not null").collect()}
    assert rows.keys() == html.keys()
    for i, r in rows.items():
        assert r.payload_bytes == len(html[i]) and r.payload_digest == hashlib.sha256(html[i]).hexdigest()
        assert r.payload is None if r.record_type == "revisit" else bytes(r.payload) == html[i]
    assert {i: r.refers_to for i, r in rows.items() if r.record_type == "revisit"} == {5: 3, 9: 3}
    assert rows[9].target_uri is None and rows[6].target_uri == "u%0D%0AX: y"


def test_rows_with_equal_ids_keep_their_payloads(spark):
    x, y = "x" * 200, "y" * 200
    rows = [(3, "u", x), (5, "u", x), (5, "u", y), (5, "u", y), (6, "u", y), (7, "u", "z"), (7, "u", None)]
    got = warc.archived(spark.createDataFrame(rows, "page_id long, url string, html string")).collect()
    found = sorted((r.record_id, r.record_type, r.refers_to or 0, r.payload_bytes, (r.payload or b"").decode()) for r in got)
    assert found == sorted([
        (3, "response", 0, 200, x), (5, "revisit", 3, 200, ""), (5, "response", 0, 200, y), (5, "response", 0, 200, y), (6, "revisit", 5, 200, ""),
        (7, "response", 0, 1, "z"), (7, "response", 0, 0, ""),
    ])


def test_filters_reach_the_headers(spark, pages):
    path = scratch_path(spark, "warc-test")
    warc.write(warc.deduplicated(pages).repartition(3), path)
    assert {r.record_id for r in warc.read(spark, path).where("record_type = 'revisit'").collect()} == {5, 9}
    assert {r.record_id for r in warc.read(spark, path).where("record_id in (3, 7) and refers_to is null").collect()} == {3, 7}
    assert warc.read(spark, path, payload="false").where("payload is not null").count() == 0
    reader = warc.WarcReader({"path": path, "split": "1"})
    left = list(reader.pushFilters([warc.EqualTo(("record_type",), "response"), warc.EqualTo(("payload",), b"")]))
    assert len(left) == 1 and reader.tests == [("record_type", frozenset(["response"]))]
    assert len(reader.partitions()) > 1


def test_skipped_payloads_are_not_read(tmp_path):
    import io

    row = {"record_id": 1, "target_uri": None, "refers_to": None, "payload": b"x" * 10_000}
    row |= {"payload_digest": hashlib.sha256(row["payload"]).hexdigest(), "payload_bytes": 10_000}
    data = warc.encode(row | {"record_type": "response"}, compress=False) + warc.encode(row | {"record_type": "revisit"})

    class Counted(io.BytesIO):
        n = 0

        def read(self, size=-1):
            out = super().read(size)
            Counted.n += len(out)
            return out

    assert [r[0] for r in warc.records(Counted(data), [("record_type", frozenset(["revisit"]))])] == ["revisit"]
    assert Counted.n == 0
    packed = warc.encode(row | {"record_type": "response"})
    assert len(packed) < 1000 and [r[-1] for r in warc.records(io.BytesIO(packed), [])] == [row["payload"]]
    with pytest.raises(ValueError, match="digest"):
        list(warc.records(Counted(data.replace(b"xx", b"yy", 1)), []))


def test_uncommitted_files_are_not_read(spark, pages, tmp_path):
    path = scratch_path(spark, "warc-test")
    warc.write(warc.deduplicated(pages), path)
    n = warc.read(spark, path).count()
    warc.WarcWriter({"path": path}).write(iter([]))
    (system, root) = warc.filesystem(path)
    with system.open_output_stream(f"{root}/part-lost.warc") as f:
        f.write(b"WARC/1.1\r\nhalf a record")
    assert warc.read(spark, path).count() == n
    empty = scratch_path(spark, "warc-test")
    warc.write(warc.deduplicated(pages.limit(0)), empty)
    assert warc.read(spark, empty).count() == 0


def test_poisson_counts(spark):
    rng = random.Random(2)
    cases = [(m, rng.random()) for m in (0.0, 0.1, 1.0, 3.7, 50.0, 900.0) for _ in range(40)] + [(1.0, 0.0), (1.0, 1 - 2.0**-48)]

    def count(mean, u):
        if mean <= 0:
            return 0
        k, log_p, below = 0, -mean, math.exp(-mean)
        while below <= u and k < mean + 9 * math.sqrt(mean) + 26:
            k += 1
            log_p += math.log(mean / k)
            below += math.exp(log_p)
        return k

    got = spark.createDataFrame(cases, "m double, u double").select("m", "u", mixing.poisson(F.col("m"), F.col("u")).alias("n")).collect()
    assert [r.n for r in got] == [count(r.m, r.u) for r in got]


def test_weights_that_cannot_be_reached_are_refused(spark):
    docs = spark.createDataFrame([(1, "a"), (None, "a"), (None, None)], "doc_id long, source string")
    for weights in ({"a": 0.0}, {"a": 1.0, None: -1.0}, {}):
        with pytest.raises(ValueError):
            mixing.mix(docs, weights)
    # null ids are drawn alike and are kept
    rows = mixing.mix(docs, size=3000).groupBy("doc_id", "source").count().collect()
    assert {(r.doc_id, r.source) for r in rows} == {(1, "a"), (None, "a"), (None, None)}


def test_mixing_reaches_the_weights(spark, monkeypatch):
    rows = [(i, "hot" if i % 3 == 0 else None if i % 3 == 1 else f"s{i % 7}", 1, "m", 2.0) for i in range(6000)]
    docs = spark.createDataFrame(rows, "doc_id long, source string, copy int, mean string, n double")
    got = mixing.mix(docs, {"hot": 1.0, None: 2.0, "s1": 1.0}, size=8000)
    n = {r.source: r["count"] for r in got.groupBy("source").count().collect()}
    assert set(n) == {"hot", None, "s1"}
    assert abs(n["hot"] - 2000) < 250 and abs(n[None] - 4000) < 350 and abs(n["s1"] - 2000) < 250
    assert got.columns == ["doc_id", "source", "mean", "n", "copy"]
    key = lambda df: sorted((r.doc_id, r.copy) for r in df.collect())
    assert len(set(key(got))) == got.count() and key(got) == key(mixing.mix(docs, {"hot": 1.0, None: 2.0, "s1": 1.0}, size=8000))
    monkeypatch.setattr(mixing, "BROADCAST_ROWS", 1)
    assert key(mixing.mix(docs, {"hot": 1.0, None: 2.0, "s1": 1.0}, size=8000)) == key(got)
    assert mixing.mix(docs.limit(0)).count() == 0
    twice = docs.where("doc_id < 50").unionAll(docs.where("doc_id < 50"))
    assert all(c % 2 == 0 for c in [r["count"] for r in mixing.mix(twice).groupBy("doc_id").count().collect()])

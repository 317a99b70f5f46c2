"""Hard negatives by an inverted multi-index: two half-space codebooks, cells visited by summed bounds, certified windows.

Every vector belongs to the cell of its two nearest half codewords. The score of any vector of a cell with an anchor is at
most the sum of two half bounds, (half anchor . codeword) + |half anchor| * radius, where a radius covers all vectors of that
half codeword. An anchor sorts its bounds of both halves; a heap walks the pairs by falling sum (the multi-sequence
order). A search has two rounds. The first visits cells in that order until they hold FIRST_ROWS rows; the kth best score
seen is then a floor, and the second goes on along the same order and ends where the bound falls below the floor:
what lies behind cannot change the result, so it is exact. The positives are searched first. They set the windows of scores
for the negatives, which are searched in the same way: each window's kth best score, or its lower end, is the floor, and
cells that lie wholly above all windows are passed over.

Cells lie in shards of about SHARD rows: small cells share one, large cells take several. An anchor is sent once to each
shard that holds one of its cells. A task keeps one shard and streams the anchors sent to it, so neither a crowded cell nor
many anchors fill it. What the driver sees is bounded by the codebooks: a sample of SAMPLE vectors, CODES radii of each
half, and a count for each of CODES ** 2 cells.

Defined results: rows with a null id or label, and vectors that are null, empty, of another length than most, or that hold
null or non-finite components take no part; ties go to the smaller id; rows with equal ids each take part, as candidates and
as anchors, but never with an anchor of the same id; a positive score of 0 has the window of score 0 alone, a negative one
has none; scores are exact while sums of products stay below 2**63; an empty table or one without anchors gives no rows;
other columns are ignored.
"""

from __future__ import annotations

import heapq
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tradewind.llm.common import sampled_rows, sliced, stored

CODES = 32
SAMPLE = 8192
SHARD = 8192
#: Rows that the cells of the first round hold at least, unless there are fewer.
FIRST_ROWS = 2048
RESULT = "anchor_id long, positive_id long, rank int, negative_id long, positive_score long, negative_score long"


def fit_codewords(x: np.ndarray, n: int, rounds: int = 12) -> np.ndarray:
    """At most n codewords of the rows of x by Lloyd's rounds, begun at rows that lie far apart."""
    x = np.unique(x, axis=0).astype(np.float64)
    chosen = [int(np.argmin(((x - x.mean(axis=0)) ** 2).sum(axis=1)))]
    far = ((x - x[chosen[0]]) ** 2).sum(axis=1)
    while len(chosen) < min(n, len(x)):
        chosen.append(int(np.argmax(far)))
        far = np.minimum(far, ((x - x[chosen[-1]]) ** 2).sum(axis=1))
    words = x[chosen]
    for _ in range(rounds):
        own = nearest(x, words)
        sums = np.zeros_like(words)
        np.add.at(sums, own, x)
        size = np.bincount(own, minlength=len(words))
        words = np.where(size[:, None] > 0, sums / np.maximum(size, 1)[:, None], words)
    return words


def nearest(x: np.ndarray, words: np.ndarray) -> np.ndarray:
    return np.argmin((words**2).sum(axis=1) - 2 * (x @ words.T), axis=1)


class MultiIndex:
    """Codebooks, radii and the number of rows of each cell; cell (i, j) has the number i * len(second half) + j."""

    def __init__(self, words: tuple[np.ndarray, np.ndarray], radii: tuple[np.ndarray, np.ndarray], sizes: np.ndarray):
        self.words, self.radii, self.sizes = words, radii, sizes
        # whole shards for large cells, runs of small cells otherwise
        large = sizes > SHARD
        filled = np.cumsum(np.where(large, 0, sizes))
        run = np.where(large, -1, (filled - np.where(large, 0, sizes)) // SHARD)
        _, run = np.unique(run, return_inverse=True)
        n_runs = int(run.max(initial=-1)) + 1
        self.parts = np.where(large, -(-sizes // SHARD), 1)
        own = np.concatenate([[0], np.cumsum(np.where(large, self.parts, 0))])
        self.first_shard = np.where(large, n_runs + own[:-1], run)
        self.n_shards = n_runs + int(own[-1])

    @property
    def width(self) -> int:
        return self.words[0].shape[1] + self.words[1].shape[1]

    def cells_of(self, x: np.ndarray) -> np.ndarray:
        cut = self.words[0].shape[1]
        return nearest(x[:, :cut], self.words[0]) * len(self.words[1]) + nearest(x[:, cut:], self.words[1])

    def bounds(self, q: np.ndarray) -> tuple[list[np.ndarray], list[np.ndarray]]:
        """Upper and lower bounds of the half scores by codeword, with room for rounding."""
        cut = self.words[0].shape[1]
        upper, lower = [], []
        for half, words, radii in zip((q[:cut], q[cut:]), self.words, self.radii):
            centre, reach = words @ half, np.sqrt((half.astype(np.float64) ** 2).sum()) * radii
            room = 1e-9 * (np.abs(centre) + reach) + 0.5
            upper.append(centre + reach + room), lower.append(centre - reach - room)
        return upper, lower

    def visit(self, q: np.ndarray) -> Iterator[tuple[int, float, float]]:
        """(cell, upper bound, lower bound) of the cells that hold rows, by falling upper bound."""
        upper, lower = self.bounds(q)
        order = [np.argsort(-u, kind="stable") for u in upper]
        first, second = (u[o].tolist() for u, o in zip(upper, order))
        if not first or not second:
            return
        heap, m = [(-(first[0] + second[0]), 0, 0)], len(second)
        while heap:
            bound, a, b = heapq.heappop(heap)
            if b + 1 < m:
                heapq.heappush(heap, (-(first[a] + second[b + 1]), a, b + 1))
            if b == 0 and a + 1 < len(first):
                heapq.heappush(heap, (-(first[a + 1] + second[0]), a + 1, 0))
            i, j = order[0][a], order[1][b]
            cell = int(i) * m + int(j)
            if self.sizes[cell]:
                yield cell, -bound, float(lower[0][i] + lower[1][j])

    def route(self, q: np.ndarray, after: bool, floor: float, ceiling: float) -> list[int]:
        """Cells of one round: the first ones that hold FIRST_ROWS rows, or those after them down to the floor."""
        seen, out = 0, []
        for cell, upper, lower in self.visit(q):
            if lower > ceiling:
                continue
            first = seen < FIRST_ROWS
            seen += int(self.sizes[cell])
            if after and not first and upper < floor:
                break
            if not first and not after:
                break
            if first != after:
                out.append(cell)
        return out

    def shards_of(self, cells: list[int]) -> dict[int, list[int]]:
        out: dict[int, list[int]] = {}
        for cell in cells:
            for part in range(self.parts[cell]):
                out.setdefault(int(self.first_shard[cell] + part), []).append(cell)
        return out


def _matrix(column: pa.Array, width: int) -> np.ndarray:
    return column.flatten().to_numpy(zero_copy_only=False).reshape(-1, width)


def build(rows: DataFrame, width: int, n_codes: int = CODES, sample: int = SAMPLE) -> tuple[MultiIndex, DataFrame]:
    """The index and the rows (id, label, x) with their cell and shard. Codewords come from at most ``sample`` rows, everything else from all."""
    some = sampled_rows(rows, "id", sample).select("x").toArrow()
    x = _matrix(some.column("x").combine_chunks(), width)
    cut = width // 2
    words = fit_codewords(x[:, :cut], n_codes), fit_codewords(x[:, cut:], n_codes)
    m = len(words[1])
    blank = MultiIndex(words, (np.zeros(len(words[0])), np.zeros(m)), np.zeros(len(words[0]) * m, np.int64))
    shared = rows.sparkSession.sparkContext.broadcast(blank)

    def assign(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        index = shared.value
        for batch in sliced(batches, 4096):
            x = _matrix(batch.column(2), width).astype(np.float64)
            cell = index.cells_of(x) if len(x) else np.zeros(0, np.int64)
            far = [np.sqrt(((x[:, s] - w[c]) ** 2).sum(axis=1)) for s, w, c in zip((slice(cut), slice(cut, None)), words, (cell // m, cell % m))]
            yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(cell.astype(np.int32)), *map(pa.array, far)], ["id", "label", "x", "cell", "far_a", "far_b"])

    placed = rows.select("id", "label", "x").mapInArrow(assign, "id long, label long, x array<bigint>, cell int, far_a double, far_b double")
    placed = stored(placed, "cells")
    found = placed.groupBy("cell").agg(F.count("*").alias("n"), F.max("far_a").alias("a"), F.max("far_b").alias("b")).collect()
    radii, sizes = (np.zeros(len(words[0])), np.zeros(m)), blank.sizes
    for r in found:
        sizes[r.cell] = r.n
        radii[0][r.cell // m], radii[1][r.cell % m] = max(radii[0][r.cell // m], r.a), max(radii[1][r.cell % m], r.b)
    index = MultiIndex(words, radii, sizes)
    lookup = rows.sparkSession.createDataFrame(
        list(zip(range(len(sizes)), index.first_shard.tolist(), index.parts.tolist())), "number int, first_shard long, parts long"
    )
    shard = F.col("first_shard") + F.pmod(F.xxhash64("id"), F.col("parts"))
    placed = placed.join(F.broadcast(lookup), F.col("cell") == F.col("number")).select("id", "label", "x", "cell", shard.alias("shard"))
    return index, placed


def _scores(block: np.ndarray, anchors: np.ndarray) -> np.ndarray:
    """Integer inner products, anchors by rows; through doubles where these are exact."""
    largest = int(np.abs(block).max(initial=0)) * int(np.abs(anchors).sum(axis=1).max(initial=0))
    if largest < 2**53:
        return (anchors.astype(np.float64) @ block.T.astype(np.float64)).astype(np.int64)
    return anchors @ block.T


def _best(score: np.ndarray, ids: np.ndarray, k: int) -> np.ndarray:
    """Places of the k highest scores, ties by smaller id."""
    if len(score) > k:
        edge = np.partition(score, len(score) - k)[len(score) - k]
        few = np.flatnonzero(score >= edge)
    else:
        few = np.arange(len(score))
    return few[np.lexsort((ids[few], -score[few]))[:k]]


def _search(index: MultiIndex, placed: DataFrame, anchors: DataFrame, k: int, after: bool) -> DataFrame:
    """One round: (key, slot, id, score), the k best of each slot of each anchor in every shard that it visits.

    ``anchors`` has key, id, label, x and the arrays low, high, floor of its slots. Slot numbers count from 0. Without
    windows (null low), a slot takes rows of the anchor's label, else rows of other labels with scores inside its window.
    """
    width = index.width
    shared = placed.sparkSession.sparkContext.broadcast(index)

    def route(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        index = shared.value
        for batch in sliced(batches, 256):
            x, rows, shards, cells = _matrix(batch.column(3), width), [], [], []
            for i, (floors, highs) in enumerate(zip(batch.column(6).to_pylist(), batch.column(5).to_pylist())):
                if not floors:
                    continue
                ceiling = np.inf if highs is None else max(highs)
                for shard, own in index.shards_of(index.route(x[i], after, min(floors), ceiling)).items():
                    rows.append(i), shards.append(shard), cells.append(own)
            taken = batch.take(pa.array(rows, pa.int64()))
            kind = pa.array([1] * len(rows), pa.int32())
            yield pa.RecordBatch.from_arrays(
                [pa.array(shards, pa.int64()), kind, *taken.columns[:6], pa.array(cells, pa.list_(pa.int32()))],
                ["shard", "kind", "key", "id", "label", "x", "low", "high", "cells"],
            )

    schema = "shard long, kind int, key long, id long, label long, x array<bigint>, low array<bigint>, high array<bigint>, cells array<int>"
    asked = anchors.select("key", "id", "label", "x", "low", "high", "floor").mapInArrow(route, schema)
    none = F.lit(None).cast("array<bigint>")
    held = placed.select("shard", F.lit(0).alias("kind"), F.lit(0).cast("long").alias("key"), "id", "label", "x", none.alias("low"), none.alias("high"), F.array("cell").alias("cells"))
    dealt = held.unionByName(asked).repartition("shard").sortWithinPartitions("shard", "kind")

    def score(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        shard, parts = None, []  # rows of the shard at hand come first, its anchors stream past
        block = None
        for batch in sliced(batches, 1024):
            number, kind = batch.column(0).to_numpy(), batch.column(1).to_numpy()
            cuts = np.flatnonzero((number[1:] != number[:-1]) | (kind[1:] != kind[:-1])) + 1
            for a, b in zip([0, *cuts], [*cuts, batch.num_rows]):
                if a == b:
                    continue
                piece = batch.slice(a, b - a)
                if number[a] != shard:
                    shard, parts, block = number[a], [], None
                if kind[a] == 0:
                    parts.append((piece.column(3).to_numpy(), piece.column(4).to_numpy(), _matrix(piece.column(5), width), piece.column(8).flatten().to_numpy()))
                    continue
                if block is None:
                    block, parts = tuple(np.concatenate(p) for p in zip(*parts)) if parts else (), []
                if not block:
                    continue
                ids, labels, x, cell = block
                found = _scores(x, _matrix(piece.column(5), width))
                lows, highs, wanted = piece.column(6).to_pylist(), piece.column(7).to_pylist(), piece.column(8).to_pylist()
                out: list[tuple] = []
                for i, (key, own, label) in enumerate(zip(piece.column(2).to_pylist(), piece.column(3).to_pylist(), piece.column(4).to_pylist())):
                    some = np.isin(cell, wanted[i]) & (ids != own) & ((labels == label) if lows[i] is None else (labels != label))
                    for slot, (low, high) in enumerate([(None, None)] if lows[i] is None else zip(lows[i], highs[i])):
                        at = np.flatnonzero(some if low is None else some & (found[i] >= low) & (found[i] <= high))
                        at = at[_best(found[i][at], ids[at], k)]
                        out.append((np.full(len(at), key), np.full(len(at), slot, np.int32), ids[at], found[i][at]))
                yield pa.RecordBatch.from_arrays([pa.array(np.concatenate(c)) for c in zip(*out)], ["key", "slot", "id", "score"])

    return dealt.mapInArrow(score, "key long, slot int, id long, score long")


def _top(found: DataFrame, k: int) -> DataFrame:
    order = Window.partitionBy("key", "slot").orderBy(F.desc("score"), "id")
    return found.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= k)


def _two_rounds(index: MultiIndex, placed: DataFrame, anchors: DataFrame, k: int, label: str) -> DataFrame:
    """(key, slot, id, score, rank): the k best of every slot, certified by the bound of the cells not visited."""
    first = stored(_top(_search(index, placed, anchors, k, False), k), f"{label}-first")
    kth = first.where(F.col("rank") == k).groupBy(F.col("key").alias("k_key")).agg(F.map_from_entries(F.collect_list(F.struct("slot", "score"))).alias("kth"))
    floors = F.expr("transform(floor, (f, s) -> greatest(f, cast(coalesce(element_at(kth, s), -9.0E18) as double)))")
    anchors = anchors.join(kth, F.col("key") == F.col("k_key"), "left").withColumn("floor", F.when(F.col("kth").isNull(), F.col("floor")).otherwise(floors))
    second = _search(index, placed, anchors.drop("k_key", "kth"), k, True)
    return stored(_top(first.drop("rank").unionByName(second), k), label)


def taking_part(vectors: DataFrame, id_col: str, vector_col: str, label_col: str, scale: int) -> DataFrame:
    """(id, label, x): floor(scale * component) of the labelled rows whose components are all numbers."""
    x = F.col(vector_col).cast("array<double>")
    whole = F.forall(x, lambda v: v.isNotNull() & ~F.isnan(v) & (F.abs(v) < float("inf")))
    rows = vectors.where(F.col(id_col).isNotNull() & F.col(label_col).isNotNull() & (F.size(x) > 0) & whole)
    number = F.transform(x, lambda v: F.floor(v * scale).cast("long"))
    return rows.select(F.col(id_col).cast("long").alias("id"), F.col(label_col).cast("long").alias("label"), number.alias("x"))


def mine(
    vectors: DataFrame, is_anchor: Column, n_positives: int = 5, n_negatives: int = 10, window: tuple[int, int, int] = (30, 90, 100),
    id_col: str = "vec_id", vector_col: str = "embedding", label_col: str = "label", scale: int = 256, n_codes: int = CODES,
) -> DataFrame:
    """RESULT rows. ``is_anchor`` is a condition on the column ``id``; ``window`` is (low, high, unit): negatives score from low / unit to high / unit of the positive."""
    low, high, unit = window
    rows = stored(taking_part(vectors, id_col, vector_col, label_col, scale), "labelled-vectors")
    most = rows.groupBy(F.size("x").alias("w")).count().orderBy(F.desc("count"), "w").first()
    if most is None:
        return vectors.sparkSession.createDataFrame([], RESULT)
    rows = rows.where(F.size("x") == most.w)
    index, placed = build(rows, most.w, n_codes)
    placed = stored(placed, "shards")
    none = F.lit(None).cast("array<bigint>")
    anchors = placed.where(is_anchor).select(F.monotonically_increasing_id().alias("key"), "id", "label", "x")
    anchors = stored(anchors, "anchors")
    bare = anchors.select("*", none.alias("low"), none.alias("high"), F.array(F.lit(-1e300)).alias("floor"))
    positives = _two_rounds(index, placed, bare, n_positives, "positives").where(F.col("score") >= 0)
    # 30 * p <= 100 * n <= 90 * p in whole numbers
    positives = positives.select("key", F.col("id").alias("positive_id"), F.col("score").alias("positive_score"), F.expr("rank - 1").alias("slot"))
    span = F.sort_array(F.collect_list(F.struct("slot", "positive_score")))
    windows = positives.groupBy(F.col("key").alias("w_key")).agg(span.alias("w")).select(
        "w_key",
        F.expr(f"transform(w, p -> (p.positive_score * {low} + {unit - 1}) div {unit})").alias("low"),
        F.expr(f"transform(w, p -> p.positive_score * {high} div {unit})").alias("high"),
    )
    framed = anchors.join(windows, F.col("key") == F.col("w_key")).withColumn("floor", F.transform("low", lambda v: v.cast("double")))
    negatives = _two_rounds(index, placed, framed, n_negatives, "negatives")
    found = negatives.select("key", "slot", F.col("id").alias("negative_id"), F.col("score").alias("negative_score"), "rank")
    return (
        found.join(positives, ["key", "slot"])
        .join(anchors.select("key", F.col("id").alias("anchor_id")), "key")
        .select("anchor_id", "positive_id", "rank", "negative_id", "positive_score", "negative_score")
    )

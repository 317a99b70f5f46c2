"""Quality classifier: histogram gradient-boosted trees over document statistics.

Statistics are computed for every whole text in one pass. Trees are grown on binned statistics of a bounded
sample of labelled rows, level by level from histograms of gradients, and flattened into arrays (feature,
bin, children, value) so that scoring steps all rows of a batch down each tree with numpy.

Defined results: null and empty texts have all statistics 0 and are scored like any other row; repeated
rows get equal scores; with no labelled rows, or one class only, every score is the share of label 1 (0.5
if there are none); labels that are null or not 0/1 are not learned from; other columns are ignored.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tradewind.llm.common import chunks, packed, row_bounds, sampled_rows, substring_hashes, prefix_hashes, words_of

STATISTICS = [
    "log_bytes", "log_words", "mean_word", "sd_word", "upper", "digit", "symbol", "punctuation", "high_bytes", "bar",
    "bang", "distinct_words", "repeat_lines", "mean_line", "space", "top_word",
]
CHUNK = 1 << 20
#: At most so many labelled rows are learned from.
MAX_TRAINING = 50_000


def _flags(characters: bytes) -> np.ndarray:
    out = np.zeros(256, bool)
    out[list(characters)] = True
    return out


_KINDS = [
    _flags(bytes(range(65, 91))), _flags(b"0123456789"), _flags(b"#*$%&<>@^~\\/=+_{}[]"), _flags(b".,;:?'\"()-"),
    _flags(bytes(range(128, 256))), _flags(b"|"), _flags(b"!"), _flags(b" \t\n\r\x0b\x0c"),
]
_COLUMNS = [4, 5, 6, 7, 8, 9, 10, 14]


def statistics(data: np.ndarray, offsets: np.ndarray) -> np.ndarray:
    """One row of STATISTICS for each text of a packed batch."""
    n = len(offsets) - 1
    out = np.zeros((n, len(STATISTICS)))
    size = np.diff(offsets).astype(float)
    out[:, 0] = np.log1p(size)
    for column, kind in zip(_COLUMNS, _KINDS):
        total = np.concatenate([[0], np.cumsum(kind[data])])
        out[:, column] = (total[offsets[1:]] - total[offsets[:-1]]) / np.maximum(size, 1)
    spaced, row, starts, ends = words_of(data, offsets)
    length = (ends - starts).astype(float)
    count = np.bincount(row, minlength=n).astype(float)
    some = np.maximum(count, 1)
    out[:, 1] = np.log1p(count)
    out[:, 2] = np.bincount(row, length, minlength=n) / some
    out[:, 3] = np.sqrt(np.maximum(np.bincount(row, length**2, minlength=n) / some - out[:, 2] ** 2, 0))
    sums = prefix_hashes(spaced)
    hashes = substring_hashes(sums, starts, ends)
    bounds = row_bounds(row, n)
    line_ends = np.flatnonzero(spaced == 10)
    edges = np.union1d(line_ends, offsets[1:] + np.arange(n))
    begin = np.concatenate([[0], edges[:-1] + 1]) if len(edges) else np.zeros(0, int)
    filled = edges > begin
    edges, begin = edges[filled], begin[filled]
    lines = substring_hashes(sums, begin, edges)
    line_row = np.searchsorted(offsets[1:] + np.arange(1, n + 1), begin, "right")
    line_bounds = row_bounds(line_row, n)
    for k in range(n):
        own = hashes[bounds[k] : bounds[k + 1]]
        if len(own):
            _, copies = np.unique(own, return_counts=True)
            out[k, 11], out[k, 15] = len(copies) / len(own), copies.max() / len(own)
        of_row = lines[line_bounds[k] : line_bounds[k + 1]]
        if len(of_row):
            out[k, 12] = 1 - len(np.unique(of_row)) / len(of_row)
            out[k, 13] = np.log1p(size[k] / len(of_row))
    return out


def document_statistics(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(id, x): the statistics of every row as an array of doubles. One pass, no shuffle."""
    from pyspark.sql.types import ArrayType, DoubleType, StructField, StructType

    chosen = docs.select(F.col(id_col).alias("id"), F.col(text_col).alias("text"))
    schema = StructType([chosen.schema["id"], StructField("x", ArrayType(DoubleType()))])

    def measure(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            data, offsets = packed(batch.column(1))
            parts = [statistics(data[offsets[a] : offsets[b]], offsets[a : b + 1] - offsets[a]) for a, b in chunks(offsets, CHUNK)]
            x = np.concatenate(parts) if parts else np.zeros((0, len(STATISTICS)))
            bounds = np.arange(len(x) + 1, dtype=np.int32) * x.shape[1]
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.ListArray.from_arrays(bounds, x.ravel())], ["id", "x"])

    return chosen.mapInArrow(measure, schema)


class Trees:
    """Boosted trees in flat arrays: node k of all trees tests ``x[feature[k]] <= cut[k]`` and goes to left[k] or left[k] + 1."""

    def __init__(self, base: float):
        self.base = base
        self.roots: list[int] = []
        self.feature: list[int] = []
        self.cut: list[float] = []
        self.left: list[int] = []
        self.value: list[float] = []

    def freeze(self) -> Trees:
        self.feature, self.left = np.array(self.feature, np.int32), np.array(self.left, np.int32)
        self.cut, self.value = np.array(self.cut), np.array(self.value)
        return self

    def margins(self, x: np.ndarray) -> np.ndarray:
        out, rows = np.full(len(x), self.base), np.arange(len(x))
        for root in self.roots:
            node = np.full(len(x), root, np.int32)
            while True:
                inner = self.left[node] >= 0
                if not inner.any():
                    break
                at = node[inner]
                node[inner] = self.left[at] + (x[rows[inner], self.feature[at]] > self.cut[at])
            out += self.value[node]
        return out

    def scores(self, x: np.ndarray) -> np.ndarray:
        return 1.0 / (1.0 + np.exp(-self.margins(x)))


def grow(x: np.ndarray, y: np.ndarray, rounds: int = 60, depth: int = 4, rate: float = 0.15, bins: int = 64, least: int = 8, ridge: float = 1.0) -> Trees:
    """Histogram gradient boosting of the logistic loss."""
    share = float(np.clip(y.mean(), 1e-6, 1 - 1e-6)) if len(y) else 0.5
    model = Trees(float(np.log(share / (1 - share))))
    if len(y) == 0 or y.min() == y.max():
        return model.freeze()
    cuts = [np.unique(np.quantile(x[:, f], np.linspace(0, 1, bins + 1)[1:-1])) for f in range(x.shape[1])]
    binned = np.stack([np.searchsorted(c, x[:, f], "left") for f, c in enumerate(cuts)], axis=1)
    margin = np.full(len(y), model.base)
    for _ in range(rounds):
        p = 1.0 / (1.0 + np.exp(-margin))
        gradient, weight = y - p, p * (1 - p)
        model.roots.append(len(model.left))
        model.feature.append(0), model.cut.append(0.0), model.left.append(-1), model.value.append(0.0)
        level = [(model.roots[-1], np.arange(len(y)))]
        for d in range(depth + 1):
            following = []
            for node, rows in level:
                g, h = gradient[rows].sum(), weight[rows].sum()
                best, gain = None, 1e-6
                for f in range(x.shape[1]) if d < depth and len(rows) >= 2 * least else ():
                    own = binned[rows, f]
                    hist = [np.bincount(own, w, minlength=len(cuts[f]) + 1) for w in (gradient[rows], weight[rows], None)]
                    gl, hl, nl = (np.cumsum(v)[:-1] for v in hist)
                    gains = gl**2 / (hl + ridge) + (g - gl) ** 2 / (h - hl + ridge) - g**2 / (h + ridge)
                    gains[(nl < least) | (len(rows) - nl < least)] = -1
                    if len(gains) and gains.max() > gain:
                        gain, best = float(gains.max()), (f, int(gains.argmax()))
                if best is None:
                    model.value[node] = rate * g / (h + ridge)
                    margin[rows] += model.value[node]
                    continue
                f, k = best
                model.feature[node], model.cut[node], model.left[node] = f, float(cuts[f][k]), len(model.left)
                for side in (binned[rows, f] <= k, binned[rows, f] > k):
                    following.append((len(model.left), rows[side]))
                    model.feature.append(0), model.cut.append(0.0), model.left.append(-1), model.value.append(0.0)
            level = following
    return model.freeze()


def fit(stats: DataFrame, labels: DataFrame, max_rows: int = MAX_TRAINING) -> Trees:
    """Learn from at most ``max_rows`` rows of ``labels`` (id, label), those with the smallest hash of the id.

    Of several labels of an id the largest counts; of documents with equal ids each is learned from.
    """
    judged = labels.where("label in (0, 1)").groupBy("id").agg(F.max("label").alias("label"))
    chosen = sampled_rows(judged, "id", max_rows)
    rows = stats.join(chosen, "id").select("id", "x", "label").toArrow()
    if rows.num_rows == 0:
        return grow(np.zeros((0, len(STATISTICS))), np.zeros(0))
    x = np.array(rows.column("x").combine_chunks().flatten()).reshape(-1, len(STATISTICS))
    order = np.lexsort((*x.T, np.array(rows.column("id"))))
    return grow(x[order], np.array(rows.column("label"), float)[order])


def predict(stats: DataFrame, model: Trees) -> DataFrame:
    """(id, score) of every row."""
    from pyspark.sql.types import DoubleType, StructField, StructType

    def score(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            x = np.array(batch.column(1).flatten()).reshape(-1, len(STATISTICS))
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(model.scores(x))], ["id", "score"])

    return stats.select("id", "x").mapInArrow(score, StructType([stats.schema["id"], StructField("score", DoubleType())]))

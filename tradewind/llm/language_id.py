"""Language identification with error-correcting output codes.

Every language gets a codeword of +1 and -1 bits. For each bit a binary classifier over hashed byte
n-grams (a naive Bayes log ratio between the two halves of the languages, averaged over the text) predicts
the bit. Decoding adds, for each codeword, the logistic losses of the bits, each weighted by how reliably
that bit was predicted on the training text; the nearest codeword wins, and a small lead is flagged.

Defined results: null texts and texts without a letter are ``und`` with score 0 and ambiguous; texts with
fewer than three bytes of letters use the n-grams there are; equal losses go to the language that sorts
first; rows are judged one by one, so repeated rows get equal answers; with no training rows every
document is ``und``; a single training language is predicted for every document with a letter. Other
columns are kept, but for those named like the added ones.
"""

from __future__ import annotations

from collections.abc import Iterator
from itertools import combinations

import numpy as np
import pandas as pd
import pyarrow as pa
import regex
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tradewind.llm.common import chunks, packed

CELLS = 1 << 15
CHUNK = 1 << 20
MAX_BITS = 31
#: A lead of less than this share of the summed bit weights is ambiguous.
AMBIGUOUS = 0.1
_LETTER = regex.compile(r"\p{L}")


def codewords(n: int) -> np.ndarray:
    """n rows of +1/-1: all ways to halve up to five languages, else seeded random columns, all different."""
    if n < 2:
        return np.ones((n, 1))
    if n <= 5:
        sides = [set(c) for k in range(1, n) for c in combinations(range(n), k) if 0 in c]
        return np.array([[1.0 if i in side else -1.0 for side in sides] for i in range(n)])
    rng, columns = np.random.default_rng(n), set()
    while len(columns) < max(MAX_BITS, 2 * int(np.ceil(np.log2(n)))) or len({tuple(r) for r in np.array(list(columns)).T}) < n:
        column = tuple(rng.permutation(np.where(np.arange(n) % 2 == 0, 1.0, -1.0)))
        columns.add(column if column[0] > 0 else tuple(-x for x in column))
    return np.array(sorted(columns)).T


def _folded(column: pa.Array) -> pa.Array:
    """Lower-cased letters and blanks; runs of anything else become one blank."""
    import pyarrow.compute as pc

    return pc.replace_substring_regex(pc.utf8_lower(column.cast(pa.large_string()).fill_null("")), r"[^\pL]+", " ")


def grams(data: np.ndarray, n_cells: int) -> np.ndarray:
    """The cell of the byte trigram that starts at each position but the last two."""
    x = data.astype(np.uint32)
    key = (x[:-2] << np.uint32(16)) | (x[1:-1] << np.uint32(8)) | x[2:]
    return ((key * np.uint32(2654435761)) >> np.uint32(16)) & np.uint32(n_cells - 1)


def _row_grams(data: np.ndarray, offsets: np.ndarray, n_cells: int) -> tuple[np.ndarray, np.ndarray]:
    """(cells, bounds): the grams of every row with two blanks after it. The two that would reach into the next row have cell n_cells."""
    part, bounds = np.insert(data, np.repeat(offsets[1:], 2), 32), offsets + 2 * np.arange(len(offsets))
    cell = np.append(grams(part, n_cells), np.zeros(min(len(part), 2), np.uint32))
    for k in (1, 2):
        cell[bounds[1:] - k] = n_cells
    return cell, bounds


def language_counts(rows: DataFrame, text_col: str, lang_col: str, n_cells: int) -> DataFrame:
    """(lang, cell, n) over all rows; each task adds up its own before the shuffle."""

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        sums: dict[str, np.ndarray] = {}
        for batch in batches:
            langs = np.array(batch.column(1).to_pylist(), dtype=object)
            data, offsets = packed(_folded(batch.column(0)))
            for a, b in chunks(offsets, CHUNK):
                cell, bounds = _row_grams(data[offsets[a] : offsets[b]], offsets[a : b + 1] - offsets[a], n_cells)
                owner = np.repeat(np.arange(b - a), np.diff(bounds))
                for lang in set(langs[a:b]):
                    own = np.bincount(cell[(langs[a:b] == lang)[owner]], minlength=n_cells + 1)[:n_cells]
                    sums[lang] = sums.get(lang, 0) + own
        for lang, total in sums.items():
            cell = np.flatnonzero(total)
            yield pa.RecordBatch.from_arrays([pa.array([lang] * len(cell), pa.string()), pa.array(cell, pa.int32()), pa.array(total[cell], pa.int64())], ["lang", "cell", "n"])

    found = rows.select(text_col, lang_col).mapInArrow(count, "lang string, cell int, n long")
    return found.groupBy("lang", "cell").agg(F.sum("n").alias("n"))


class Codes:
    """The fitted model: languages, codewords and one column of log ratios per bit."""

    def __init__(self, counts: pd.DataFrame, n_cells: int = CELLS, smoothing: float = 0.5):
        self.langs = sorted(counts["lang"].unique())
        table = np.zeros((len(self.langs), n_cells))
        for k, lang in enumerate(self.langs):
            own = counts[counts["lang"] == lang]
            table[k, own["cell"]] = own["n"]
        shares = table / np.maximum(table.sum(axis=1, keepdims=True), 1)  # languages weigh the same, however much text they have
        self.code, self.n_cells = codewords(len(self.langs)), n_cells
        floor = smoothing / max(table.sum(), 1.0)
        self.ratios = np.zeros((n_cells, self.code.shape[1]), np.float32)
        reliability = np.ones(self.code.shape[1])
        if len(self.langs) > 1:
            for bit in range(self.code.shape[1]):
                yes, no = shares[self.code[:, bit] > 0].mean(axis=0), shares[self.code[:, bit] < 0].mean(axis=0)
                self.ratios[:, bit] = np.clip(np.log((yes + floor) / (no + floor)), -6, 6)
            margins = shares @ self.ratios * self.code  # mean margin of each language's own text, towards its own side
            reliability = np.maximum(margins.min(axis=0), 0.01)
        self.weights = reliability / reliability.sum() if len(self.langs) else reliability

    def decode(self, margins: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """(winner, score, lead) of rows of mean margins."""
        if len(self.langs) == 1:
            return np.zeros(len(margins), int), np.ones(len(margins)), np.full(len(margins), np.inf)
        losses = np.stack([np.logaddexp(0, -4.0 * margins * code) @ self.weights for code in self.code], axis=1)
        best = losses.argmin(axis=1)
        ordered = np.sort(losses, axis=1)
        sharp = np.exp(-8.0 * (losses - ordered[:, :1]))
        return best, 1.0 / sharp.sum(axis=1), ordered[:, 1] - ordered[:, 0]


def fit(rows: DataFrame, text_col: str = "text", lang_col: str = "lang", n_cells: int = CELLS) -> Codes:
    """Counts come from every row with a language; what reaches the driver has n_cells rows a language at most."""
    counts = language_counts(rows.where(F.col(lang_col).isNotNull() & F.col(text_col).isNotNull()), text_col, lang_col, n_cells)
    return Codes(counts.toPandas(), n_cells)


def predict(docs: DataFrame, model: Codes, text_col: str = "text", keep: list[str | Column] | None = None) -> DataFrame:
    """The kept columns of every row, then lang_pred, score (0 to 1) and ambiguous. One pass, no shuffle."""
    from pyspark.sql.types import BooleanType, DoubleType, StringType, StructField, StructType

    added = ("lang_pred", "score", "ambiguous", "__text")
    chosen = docs.select(*(keep if keep is not None else [c for c in docs.columns if c not in added]), F.col(text_col).alias("__text"))
    schema = StructType([*chosen.schema.fields[:-1], StructField("lang_pred", StringType()), StructField("score", DoubleType()), StructField("ambiguous", BooleanType())])

    def label(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        ratios = np.vstack([model.ratios, np.zeros((1, model.ratios.shape[1]), model.ratios.dtype)])
        for batch in batches:
            texts = batch.column(batch.num_columns - 1)
            folded = _folded(texts)
            data, offsets = packed(folded)
            n = len(offsets) - 1
            bare = np.array([t is None or not _LETTER.search(t) for t in texts.to_pylist()], bool) if n else np.zeros(0, bool)
            margins = np.zeros((n, model.ratios.shape[1]))
            for a, b in chunks(offsets, CHUNK):
                cell, bounds = _row_grams(data[offsets[a] : offsets[b]], offsets[a : b + 1] - offsets[a], model.n_cells)
                for bit in range(margins.shape[1]):
                    margins[a:b, bit] = np.add.reduceat(ratios[:, bit][cell], bounds[:-1]) / np.diff(bounds)
            if model.langs:
                best, score, lead = model.decode(margins)
                names = np.array(model.langs, dtype=object)[best]
            else:
                names, score, lead, bare = np.full(n, "und", object), np.zeros(n), np.zeros(n), np.ones(n, bool)
            names = np.where(bare, "und", names)
            out = [*batch.columns[:-1], pa.array(names, pa.string()), pa.array(np.where(bare, 0.0, score)), pa.array(bare | (lead < AMBIGUOUS))]
            yield pa.RecordBatch.from_arrays(out, schema=pa.schema([*list(batch.schema)[:-1], ("lang_pred", pa.string()), ("score", pa.float64()), ("ambiguous", pa.bool_())]))

    return chosen.mapInArrow(label, schema)

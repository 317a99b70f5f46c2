"""N-gram Jaccard join: a blocked sparse product of the document by n-gram incidence matrix.

1. One pass hashes every whole text into its set of distinct shingles, and finds classes of equal sets by a
   sum of the set. Only one document of each class goes on.
2. Shingles are ordered from rare to frequent by a table of hashed counts over all documents. Two sets that
   reach the similarity must share one of the first n - ceil(t n) + 1 shingles in that order, so the
   incidence matrix keeps those entries only.
3. The matrix is cut into blocks of shingles. Each block is multiplied with its transpose: overlap counts are
   accumulated per pair of documents, and a pair is dropped as soon as the sizes and the places of a shared
   shingle show that the overlap cannot suffice. Counts of the blocks are added, and the sum is held
   against the size bound again.
4. The pairs that are left get their exact overlap from the whole sets.

Columns with more than WIDE documents that can still reach the bound are not expanded into all pairs. Their
documents are first held against the bound again, without the shingles that none of them shares, and joined with a few
pivots; what these leave outside the column's components is then
paired with all documents of the column of other components. No link between components is lost.

Defined results: null texts and texts without words have an empty set, no link, and their own id as
component; a text with fewer words than a shingle has one shingle, its whole sequence; every row is a document, also
rows with equal or null ids (-2**63 counts as null), and a component's id is the smallest that is not null; an empty table gives an empty result;
other columns are ignored.
"""

from __future__ import annotations

import zlib
from collections.abc import Iterator
from fractions import Fraction

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tradewind.llm.common import LOWER, chunks, mixed, packed, prefix_hashes, row_bounds, stored, substring_hashes, tidied, words_of
from tradewind.llm.components import components, extended

WORDS = 5
SIMILARITY = Fraction(4, 5)
CHUNK = 1 << 20
#: Cells of the table of hashed counts, as a power of two. It only orders shingles; any order gives the same links.
COUNT_BITS = 20
#: Stands for a null id.
NO_ID = -(1 << 63)
SLICES = 64
#: Entries of the incidence matrix in a block, and documents in a column that is expanded into all pairs.
BLOCK_ENTRIES = 500_000
WIDE = 24
#: Documents of a wide column that others are held against first, round by round; the last round takes all.
PIVOTS = (2, 8, 24)
_MULTIPLIERS = np.array([pow(0xC2B2AE3D27D4EB4F, k, 1 << 64) for k in range(1, 65)], np.uint64)


def shingle_sets(data: np.ndarray, offsets: np.ndarray, words: int = WORDS) -> tuple[np.ndarray, np.ndarray]:
    """(hashes, bounds): the sorted distinct shingles of each text of a packed batch."""
    n = len(offsets) - 1
    spaced, row, starts, ends = words_of(LOWER[data], offsets)
    hashes = substring_hashes(prefix_hashes(spaced), starts, ends)
    bounds = row_bounds(row, n)
    rolled = np.zeros(max(len(hashes) - words + 1, 0), np.uint64)
    for k in range(words):
        rolled += hashes[k : k + len(rolled)] * _MULTIPLIERS[k]
    rolled = mixed(rolled + np.uint64(words))
    sets = []
    for k in range(n):
        a, b = bounds[k], bounds[k + 1]
        if b - a >= words:
            sets.append(np.unique(rolled[a : b - words + 1]))
        elif b > a:
            short = (hashes[a:b] * _MULTIPLIERS[: b - a]).sum(dtype=np.uint64)
            sets.append(mixed(np.array([short + np.uint64(b - a)], np.uint64)))
        else:
            sets.append(np.zeros(0, np.uint64))
    sizes = np.array([len(s) for s in sets], np.int64)
    return (np.concatenate(sets) if sets else np.zeros(0, np.uint64)), np.concatenate([[0], np.cumsum(sizes)])


def _batches(batch: pa.RecordBatch, words: int) -> Iterator[tuple[int, int, np.ndarray, np.ndarray]]:
    data, offsets = packed(batch.column(1))
    for a, b in chunks(offsets, CHUNK):
        yield a, b, *shingle_sets(data[offsets[a] : offsets[b]], offsets[a : b + 1] - offsets[a], words)


def _segment_sums(values: np.ndarray, bounds: np.ndarray) -> np.ndarray:
    sums = np.concatenate([np.zeros(1, np.uint64), np.cumsum(values, dtype=np.uint64)])
    return sums[bounds[1:]] - sums[bounds[:-1]]


def set_digests(docs: DataFrame, words: int = WORDS) -> DataFrame:
    """Of ``docs`` (id, text, key): rows (id, key, n, h1, h2), and as rows with a slice the slices of the hashed counts."""

    def digest(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        counts = np.zeros(1 << COUNT_BITS, np.int64)
        names = ["id", "key", "n", "h1", "h2", "slice", "counts"]
        none = lambda n, kind: pa.nulls(n, kind)
        for batch in batches:
            for a, b, hashes, bounds in _batches(batch, words):
                counts += np.bincount((hashes >> np.uint64(64 - COUNT_BITS)).astype(np.int64), minlength=len(counts))
                h1 = _segment_sums(mixed(hashes), bounds).view(np.int64)
                h2 = _segment_sums(mixed(hashes ^ np.uint64(0x5851F42D4C957F2D)), bounds).view(np.int64)
                yield pa.RecordBatch.from_arrays(
                    [batch.column(k).slice(a, b - a) for k in (0, 2)] + [pa.array(np.diff(bounds)), pa.array(h1), pa.array(h2), none(b - a, pa.int32()), none(b - a, pa.binary())],
                    names,
                )
        width = len(counts) // SLICES
        full = [k for k in range(SLICES) if counts[k * width : (k + 1) * width].any()]
        parts = [zlib.compress(counts[k * width : (k + 1) * width].astype(np.uint32).tobytes(), 1) for k in full]
        m = len(full)
        longs = none(m, pa.int64())
        yield pa.RecordBatch.from_arrays([longs, longs, longs, longs, longs, pa.array(full, pa.int32()), pa.array(parts, pa.binary())], names)

    return docs.mapInArrow(tidied(digest), "id long, key long, n long, h1 long, h2 long, slice int, counts binary")


def frequency_ranks(digests: DataFrame) -> np.ndarray:
    """A byte for each cell, rising with its count over all documents (on a logarithmic scale)."""

    def add(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        sums: dict[int, np.ndarray] = {}
        for batch in batches:
            for k, part in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()):
                sums[k] = sums.get(k, 0) + np.frombuffer(zlib.decompress(part), np.uint32).astype(np.int64)
        for k, total in sums.items():
            ranks = np.minimum(np.round(8 * np.log2(total + 1)), 255).astype(np.uint8)
            yield pa.RecordBatch.from_arrays([pa.array([k], pa.int32()), pa.array([ranks.tobytes()], pa.binary())], ["slice", "ranks"])

    slices = digests.where("slice is not null").select("slice", "counts").repartition(SLICES, "slice").mapInArrow(add, "slice int, ranks binary")
    out = np.zeros((SLICES, (1 << COUNT_BITS) // SLICES), np.uint8)
    for r in slices.collect():  # one byte a cell: 1 MB whatever the corpus
        out[r.slice] = np.frombuffer(r.ranks, np.uint8)
    return out.ravel()


def prefix_length(n: np.ndarray | int, similarity: Fraction) -> np.ndarray | int:
    """n - ceil(t n) + 1"""
    p, q = similarity.numerator, similarity.denominator
    return n + (-p * n) // q + 1


def least_overlap(total: np.ndarray, similarity: Fraction) -> np.ndarray:
    """The overlap two sets of ``total`` shingles together need: ceil(t / (1 + t) total)."""
    p, q = similarity.numerator, similarity.denominator
    return -((-p * total) // (p + q))


def prefixes(docs: DataFrame, ranks, words: int, similarity: Fraction) -> DataFrame:
    """Of (id, text, key) the rows (id, key, n, prefix): each set's rarest shingles in order, eight bytes each: rank, then 56 bits of the hash."""

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        table = ranks.value
        for batch in batches:
            for a, b, hashes, bounds in _batches(batch, words):
                keys = (table[(hashes >> np.uint64(64 - COUNT_BITS)).astype(np.int64)].astype(np.uint64) << np.uint64(56)) | (hashes >> np.uint64(8))
                n = np.diff(bounds)
                parts = [np.sort(keys[bounds[k] : bounds[k + 1]])[: prefix_length(int(n[k]), similarity) if n[k] else 0].tobytes() for k in range(b - a)]
                yield pa.RecordBatch.from_arrays([*(batch.column(k).slice(a, b - a) for k in (0, 2)), pa.array(n), pa.array(parts, pa.binary())], ["id", "key", "n", "prefix"])

    return docs.mapInArrow(tidied(cut), "id long, key long, n long, prefix binary")


def incidence_blocks(rows: DataFrame, n_blocks: int) -> DataFrame:
    """Rows (id, n, prefix) as packed pieces of blocks: (block, tokens, owners, places, ids, sizes)."""

    def pack(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        names = ["block", "tokens", "owners", "places", "ids", "sizes"]
        for batch in (b.slice(at, 1 << 16) for b in batches for at in range(0, b.num_rows, 1 << 16)):
            ids, n = batch.column(0).to_numpy(zero_copy_only=False), batch.column(1).to_numpy(zero_copy_only=False)
            data, offsets = packed(batch.column(2))
            tokens, bounds = np.frombuffer(data.tobytes(), np.uint64), offsets // 8
            owner = np.repeat(np.arange(len(ids), dtype=np.uint32), np.diff(bounds))
            place = (np.arange(len(tokens)) - bounds[owner]).astype(np.uint32)
            block = (mixed(tokens) % np.uint64(n_blocks)).astype(np.int64)
            order = np.argsort(block, kind="stable")
            edges = np.searchsorted(block[order], np.arange(n_blocks + 1))
            for k in np.flatnonzero(np.diff(edges)):
                own = order[edges[k] : edges[k + 1]]
                docs, local = np.unique(owner[own], return_inverse=True)
                values = [tokens[own].tobytes(), local.astype(np.uint16).tobytes(), place[own].tobytes(), ids[docs].tobytes(), n[docs].astype(np.uint32).tobytes()]
                yield pa.RecordBatch.from_arrays([pa.array([k], pa.int32()), *(pa.array([v], pa.binary()) for v in values)], names)

    return rows.mapInArrow(tidied(pack), "block int, tokens binary, owners binary, places binary, ids binary, sizes binary")


def _possible(n1, place1, n2, place2, similarity: Fraction) -> np.ndarray:
    """May two sets that share the shingle at these places still reach the similarity?"""
    p, q = similarity.numerator, similarity.denominator
    most = np.minimum(place1, place2) + 1 + np.minimum(n1 - place1, n2 - place2) - 1
    return (most >= least_overlap(n1 + n2, similarity)) & (p * np.maximum(n1, n2) <= q * np.minimum(n1, n2))


def _partnered(columns: pa.Table, similarity: Fraction) -> pa.Table:
    """Of the distinct (token, n, place, solo, copies) of one column, those that may reach the similarity with another.

    ``solo`` shingles before the place are in no other set of a wide column, so they cannot be shared.
    """
    n, place, solo, copies = (columns.column(c).to_numpy() for c in ("n", "place", "solo", "copies"))
    out = np.zeros(len(n), bool)
    for a in range(0, len(n), 256):
        own = slice(a, a + 256)
        most = np.minimum((place - solo)[own, None], place - solo) + np.minimum((n - place)[own, None], n - place)
        able = (most >= least_overlap(n[own, None] + n, similarity)) & (
            similarity.numerator * np.maximum(n[own, None], n) <= similarity.denominator * np.minimum(n[own, None], n)
        )
        same = np.arange(able.shape[0])
        able[same, a + same] &= copies[own] > 1
        out[own] = able.any(axis=1)
    return columns.filter(pa.array(out)).select(["token", "n", "place", "solo"])


def _narrowed(wide: DataFrame, sets: DataFrame, ranks, similarity: Fraction) -> DataFrame:
    """Wide columns with ``solo``, without the documents that can reach no other in their column.

    Two documents of a column have all shingles that they share before its place in both prefixes, so a shingle
    in the prefix of one wide document alone is not shared.
    """

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        table = ranks.value
        for batch in batches:
            for i, hashes in zip(batch.column(0).to_pylist(), batch.column(1)):
                h = hashes.values.to_numpy().view(np.uint64)
                keys = np.sort((table[(h >> np.uint64(64 - COUNT_BITS)).astype(np.int64)].astype(np.uint64) << np.uint64(56)) | (h >> np.uint64(8)))
                keys = keys[: prefix_length(len(keys), similarity)].view(np.int64)
                yield pa.RecordBatch.from_arrays([pa.array(np.full(len(keys), i)), pa.array(keys), pa.array(np.arange(len(keys)))], ["of", "t", "at"])

    ids = wide.select(F.col("id").alias("wide_id")).distinct()
    prefixes_ = stored(sets.join(ids, F.col("id") == F.col("wide_id"), "left_semi").mapInArrow(tidied(cut), "of long, t long, at long"), "wide-prefixes")
    shared = prefixes_.groupBy("t").agg(F.count("*").alias("k")).where("k > 1").select(F.col("t").alias("shared_t"))
    before = Window.partitionBy("of").orderBy("at").rowsBetween(Window.unboundedPreceding, -1)
    alone = F.col("shared_t").isNull().cast("long")
    told = prefixes_.join(shared, F.col("t") == F.col("shared_t"), "left").withColumn("solo", F.coalesce(F.sum(alone).over(before), F.lit(0).cast("long")))
    known = wide.join(told, (F.col("token") == F.col("t")) & (F.col("id") == F.col("of"))).select("token", "id", "n", "place", "solo")
    known = stored(known, "wide")
    kinds = known.groupBy("token", "n", "place", "solo").agg(F.count("*").alias("copies"))
    able = kinds.groupBy("token").applyInArrow(lambda t: _partnered(t, similarity), "token long, n long, place long, solo long")
    kept = stored(known.join(able, ["token", "n", "place", "solo"], "left_semi").select("token", "id", "n", "place", "solo"), "wide")
    # a document is in as many wide columns as its prefix has shingles at most
    columns = kept.groupBy(F.col("id").alias("of")).agg(F.collect_set("token").alias("columns"))
    return stored(kept.join(columns, F.col("id") == F.col("of")).drop("of"), "wide")


def _feasible(n: np.ndarray, place: np.ndarray, similarity: Fraction) -> np.ndarray:
    """Which documents of one wide column have a partner in it that may reach the similarity.

    Documents of equal size and place answer alike, so distinct (size, place) stand for all.
    """
    kinds, inverse, copies = np.unique(np.stack([n, place], axis=1), axis=0, return_inverse=True, return_counts=True)
    out = np.zeros(len(kinds), bool)
    for a in range(0, len(kinds), 512):
        own = kinds[a : a + 512]
        able = _possible(own[:, None, 0], own[:, None, 1], kinds[None, :, 0], kinds[None, :, 1], similarity)
        same = np.arange(len(own))
        able[same, a + same] &= copies[a : a + 512] > 1
        out[a : a + 512] = able.any(axis=1)
    return out[inverse.ravel()]


def block_products(blocks: DataFrame, n_blocks: int, similarity: Fraction) -> DataFrame:
    """Multiply every block with its transpose.

    Narrow columns give rows (a, b, overlap) with the sizes; wide ones rows with a null b, their (token, id, n, place).
    """

    def multiply(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        tokens, ids, sizes, places = [], [], [], []
        for batch in batches:
            for r in batch.to_pylist():
                local = np.frombuffer(r["owners"], np.uint16)
                tokens.append(np.frombuffer(r["tokens"], np.uint64))
                ids.append(np.frombuffer(r["ids"], np.int64)[local])
                sizes.append(np.frombuffer(r["sizes"], np.uint32)[local])
                places.append(np.frombuffer(r["places"], np.uint32))
        if not tokens:
            return
        token = np.concatenate(tokens)
        order = np.argsort(token, kind="stable")
        token = token[order]
        first = np.flatnonzero(np.concatenate([[True], token[1:] != token[:-1]]))
        width = np.diff(np.concatenate([first, [len(token)]]))
        shared = width > 1
        first, width = first[shared], width[shared]
        doc, n, place = np.concatenate(ids)[order], np.concatenate(sizes)[order].astype(np.int64), np.concatenate(places)[order].astype(np.int64)
        pairs: list[np.ndarray] = []
        for w in range(2, WIDE + 1):
            at = first[width == w]
            if len(at) == 0:
                continue
            left, right = np.triu_indices(w, 1)
            i, j = (at[:, None] + left).ravel(), (at[:, None] + right).ravel()
            able = _possible(n[i], place[i], n[j], place[j], similarity)
            i, j = i[able], j[able]
            i, j = np.where(doc[i] < doc[j], i, j), np.where(doc[i] < doc[j], j, i)
            pairs.append(np.stack([doc[i], doc[j], n[i], n[j]], axis=1))
        names = ["a", "b", "na", "nb", "overlap", "token"]
        if pairs and sum(map(len, pairs)):
            pair, overlap = np.unique(np.concatenate(pairs), axis=0, return_counts=True)
            columns = [pa.array(pair[:, k]) for k in range(4)]
            yield pa.RecordBatch.from_arrays([*columns, pa.array(overlap, pa.int64()), pa.nulls(len(pair), pa.int64())], names)
        for at, w in zip(first[width > WIDE], width[width > WIDE]):
            rows = np.arange(at, at + w)
            rows = rows[_feasible(n[rows], place[rows], similarity)]
            if len(rows) > 1:
                of = pa.array(np.full(len(rows), token[at]).view(np.int64))
                yield pa.RecordBatch.from_arrays([pa.array(doc[rows]), pa.nulls(len(rows), pa.int64()), pa.array(n[rows]), pa.array(place[rows]), pa.nulls(len(rows), pa.int64()), of], names)

    return blocks.repartition(n_blocks, "block").mapInArrow(tidied(multiply), "a long, b long, na long, nb long, overlap long, token long")


def _sets(docs: DataFrame, words: int) -> DataFrame:
    """(id, s): the whole sets, for exact overlaps."""

    def whole(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for a, b, hashes, bounds in _batches(batch, words):
                lists = pa.ListArray.from_arrays(pa.array(bounds, pa.int32()), pa.array(hashes.view(np.int64)))
                yield pa.RecordBatch.from_arrays([batch.column(0).slice(a, b - a), lists], ["id", "s"])

    return docs.mapInArrow(tidied(whole), "id long, s array<long>")


def verified(pairs: DataFrame, sets: DataFrame, similarity: Fraction) -> DataFrame:
    """The pairs (a, b) whose whole sets reach the similarity."""
    p, q = similarity.numerator, similarity.denominator
    joined = pairs.join(sets.select(F.col("id").alias("a"), F.col("s").alias("sa")), "a").join(sets.select(F.col("id").alias("b"), F.col("s").alias("sb")), "b")
    counted = joined.select("a", "b", (F.size("sa") + F.size("sb")).alias("total"), F.size(F.array_intersect("sa", "sb")).alias("overlap"))
    return counted.where(q * F.col("overlap") >= p * (F.col("total") - F.col("overlap"))).select("a", "b")


def _outside(wide: DataFrame, labels: DataFrame) -> tuple[DataFrame, DataFrame]:
    """(rows of wide columns that span components, with label and the column's largest component; that table's outsiders)."""
    known = wide.join(labels, F.col("id") == F.col("node"), "left").withColumn("label", F.coalesce("label", "id")).drop("node")
    by_label = known.groupBy("token", "label").agg(F.count("*").alias("k"))
    main = by_label.groupBy("token").agg(F.count("*").alias("labels"), F.max_by("label", F.struct("k", "label")).alias("main")).where("labels > 1")
    spread = stored(known.join(main.select("token", "main"), "token"), "wide")
    return spread, spread.where("label <> main")


def _wide_pairs(rows: DataFrame, others: DataFrame, similarity: Fraction) -> DataFrame:
    """Pairs (a, b) of different components that may reach the similarity, each in the first column that both are in."""
    p, q = similarity.numerator, similarity.denominator
    other = others.select("token", *[F.col(c).alias(f"{c}2") for c in ("id", "n", "place", "solo", "label", "columns")])
    most = F.least(F.col("place") - F.col("solo"), F.col("place2") - F.col("solo2")) + F.least(F.col("n") - F.col("place"), F.col("n2") - F.col("place2"))
    sizes = p * F.greatest("n", "n2") <= q * F.least("n", "n2")
    enough = most >= F.ceil((F.col("n") + F.col("n2")) * p / (p + q))
    once = F.array_min(F.array_intersect("columns", "columns2")) == F.col("token")
    pairs = rows.join(other, "token").where((F.col("label") != F.col("label2")) & sizes & enough & once)
    return pairs.select(F.least("id", "id2").alias("a"), F.greatest("id", "id2").alias("b")).distinct()


def _text_key(text_col: str) -> Column:
    return F.xxhash64(F.coalesce(F.col(text_col), F.lit("")))


def _components(docs: DataFrame, id_col: str, text_col: str, similarity: Fraction, words: int) -> tuple[DataFrame, DataFrame]:
    """Two tables: (id, key, n, h1, h2) of every row, and (cn, c1, c2, component, component_id, first_id, first_key) of every class of equal sets.

    ``key`` hashes a text. Of a component's rows, those with (first_id, first_key) come first; null ids come last.
    """
    spark = docs.sparkSession
    known = F.coalesce(F.col(id_col).cast("long"), F.lit(NO_ID))
    texts = docs.select(known.alias("id"), F.col(text_col).alias("text"), _text_key(text_col).alias("key"))
    digests = stored(set_digests(texts, words), "set-digests")
    ranks = spark.sparkContext.broadcast(frequency_ranks(digests))
    rows = digests.where("slice is null").select(F.when(F.col("id") != NO_ID, F.col("id")).alias("id"), "key", "n", "h1", "h2")
    first = F.struct(F.col("id").isNull().alias("without"), "id", "key")
    classes = rows.groupBy("n", "h1", "h2").agg(F.min(first).alias("first"))
    classes = stored(classes.withColumn("class_id", F.monotonically_increasing_id()), "set-classes")
    # one text stands for each class; equal rows give it once, as they are neighbours after the join
    filled = classes.where("n > 0").select("class_id", F.coalesce("first.id", F.lit(NO_ID)).alias("first_id"), F.col("first.key").alias("first_key"))
    stands = (F.col("id") == F.col("first_id")) & (F.col("key") == F.col("first_key"))

    total = classes.agg(F.sum(F.col("n"))).first()[0] or 0
    n_blocks = int(-(-total * (1 - float(similarity)) // BLOCK_ENTRIES)) + 1
    narrow = prefixes(texts, ranks, words, similarity).join(filled, stands).dropDuplicates(["id", "key"])
    narrow = narrow.select(F.col("class_id").alias("id"), "n", "prefix")
    products = stored(block_products(incidence_blocks(narrow, n_blocks), n_blocks, similarity), "products")

    p, q = similarity.numerator, similarity.denominator
    sums = products.where("b is not null").groupBy("a", "b").agg(F.sum("overlap").alias("overlap"), F.first("na").alias("na"), F.first("nb").alias("nb"))
    unseen = F.greatest(F.floor(F.col("na") * p / q), F.floor(F.col("nb") * p / q))
    candidates = sums.where(F.col("overlap") + unseen >= F.ceil((F.col("na") + F.col("nb")) * p / (p + q))).select("a", "b")
    candidates = stored(candidates, "candidates")
    wide = products.where("b is null").select("token", F.col("a").alias("id"), F.col("na").alias("n"), F.col("nb").alias("place"))
    needed = candidates.select(F.col("a").alias("need")).union(candidates.select("b")).union(wide.select("id")).distinct()
    needed = needed.join(filled, F.col("need") == F.col("class_id"))
    chosen = texts.join(needed, stands).dropDuplicates(["id", "key"]).select(F.col("class_id").alias("id"), "text")
    sets = stored(_sets(chosen, words), "sets")
    labels = components(verified(candidates, sets, similarity))
    wide = _narrowed(wide, sets, ranks, similarity)

    # the documents with the fewest rare shingles before the column's are the likeliest partners
    nearest = Window.partitionBy("token").orderBy("place", "id")
    for pivots in (*PIVOTS, None):
        spread, outsiders = _outside(wide, labels)
        if outsiders.isEmpty():
            break
        others = spread if pivots is None else spread.withColumn("r", F.row_number().over(nearest)).where(F.col("r") <= pivots)
        labels = extended(labels, stored(verified(_wide_pairs(outsiders, others, similarity), sets, similarity), "links"))

    of_class = classes.join(labels, F.col("class_id") == F.col("node"), "left").withColumn("component", F.coalesce("label", "class_id"))
    of_class = stored(of_class.select("n", "h1", "h2", "first", "component"), "class-components")
    least = of_class.where("n > 0").groupBy(F.col("component").alias("of")).agg(F.min("first").alias("first"))
    named = least.select("of", F.col("first.id").alias("first_id"), F.col("first.key").alias("first_key"))
    of_class = of_class.where("n > 0").join(named, F.col("component") == F.col("of"))
    return rows, of_class.select(F.col("n").alias("cn"), F.col("h1").alias("c1"), F.col("h2").alias("c2"), "component", "first_id", "first_key")


def near_duplicates(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", similarity: Fraction = SIMILARITY, words: int = WORDS) -> DataFrame:
    """(id, n_shingles, component_id) of every document; see the module's docstring."""
    rows, classes = _components(docs, id_col, text_col, similarity, words)
    empty = rows.where("n = 0").select("id", "n", F.col("id").alias("component_id"))
    equal = (F.col("n") == F.col("cn")) & (F.col("h1") == F.col("c1")) & (F.col("h2") == F.col("c2"))
    named = rows.where("n > 0").join(classes, equal).select("id", "n", F.col("first_id").alias("component_id"))
    return empty.unionByName(named).select(F.col("id").alias(id_col), F.col("n").alias("n_shingles"), "component_id")


def one_of_each(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", similarity: Fraction = SIMILARITY, words: int = WORDS) -> DataFrame:
    """The rows of ``docs`` that stay if one of each component stays: the one with the smallest id, null ids last.

    Of rows with that id the one whose text has the smallest hash stays, of equal rows one. Texts without words all stay.
    """
    _, classes = _components(docs, id_col, text_col, similarity, words)
    kept = classes.select("component", "first_id", "first_key").distinct()
    known = F.coalesce(F.col(id_col).cast("long"), F.lit(NO_ID))
    chosen = (known == F.coalesce("first_id", F.lit(NO_ID))) & (_text_key(text_col) == F.col("first_key"))
    # rows that share id and key have equal texts; they are neighbours after the join
    place = F.row_number().over(Window.partitionBy("first_id", "first_key").orderBy("first_key"))
    without = F.coalesce(F.col(text_col), F.lit("")).rlike("^[\\x20\\x09-\\x0D]*$")
    first = docs.where(~without).join(kept, chosen).withColumn("nth", place).where("nth = 1")
    return docs.where(without).unionByName(first.select(docs.columns))

"""Removal of long repeated byte strings with a run-length index over the repetitive part of the corpus.

A string of ``length`` bytes that also starts earlier (in a document with a smaller id, or before in the same
document) is removed wherever it recurs. Strings are judged on the input; overlapping ones add up.

1. Every window of ``length`` bytes is assigned the place of the smallest hashed 32-byte gram in it. Windows that
   follow each other and share that place form a context; equal windows always have an equal gram, so only
   contexts of equal grams need comparing. Contexts travel as two hashes, packed by block of the gram's hash.
2. In a block, a context that equals an earlier one is removed whole. Of grams with different contexts, one
   context of each kind is fetched from its text.
3. Those contexts, a small and repetitive rest of the corpus, are cut into quarters by the reach of their windows
   to the left, and quarters without a counterpart, or with an equal one, are settled. The others are compared in rounds
   that double the blocks of document order. Each time, a run-compressed Burrows-Wheeler transform with sampled run ends is built over the
   earlier block of every pair, matching statistics of the later ones are streamed against it, and every
   start with a match of ``length`` bytes is marked.
4. Grams with more than CROWDED different contexts, as at the edges of a passage that very many documents
   share, are compared window by window instead: their windows' hashes are dealt out on their own.

Every step's groups are bounded or dealt by hashes that no single passage can load. The marks of a document
meet its text once.

Defined results: a null text has no bytes; texts below ``length`` bytes are untouched; a null id comes before all others;
rows with equal ids are documents of their own, in the order of a hash of their texts, so of equal rows one is the first
and the others repeat it; lengths above MOST are refused; an empty table gives an empty result; other columns are ignored.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator, Sequence

import numpy as np
import pyarrow as pa
import zstandard
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql.types import BinaryType, StructField, StructType

from tradewind.llm.common import chunks, mixed, packed, prefix_hashes, sliced, stored, substring_hashes, tidied
from tradewind.llm.run_length_index import RunLengthIndex

LENGTH = 100
GRAM = 32
#: A context's further starts travel as one byte.
MOST = GRAM + 255
#: Stands for a null id.
FIRST_ID = -(1 << 63)
CHUNK = 1 << 20
BLOCK_BYTES = 6 << 20
#: A gram with more different contexts than this is compared window by window.
CROWDED = 512
#: Pieces that share an index.
RUN = 4_000
_PACKED = "block int, crowded boolean, key binary, context binary, owner binary, first binary, more binary, ids binary, bytes binary, sure_owner binary, sure_first binary, sure_more binary, sure_ids binary"


def _leftmost_minimum(values: np.ndarray, width: int) -> np.ndarray:
    """The place of the leftmost smallest value in every window of ``width`` values."""
    best, at, span = values, np.arange(len(values), dtype=np.int32), 1
    while span < width:
        shift = min(span, width - span)
        left = best[:-shift] <= best[shift:]
        at = np.where(left, at[:-shift], at[shift:])
        best = np.minimum(best[:-shift], best[shift:])
        span += shift
    return at


def contexts(data: np.ndarray, offsets: np.ndarray, length: int = LENGTH, gram: int = GRAM) -> tuple[np.ndarray, ...]:
    """(row, first start, further starts, gram hash, context hash) of all contexts of a packed batch, in order."""
    parts = []
    for a, b in chunks(offsets, CHUNK):
        for begin in range(int(offsets[a]), max(int(offsets[b]) - length + 1, int(offsets[a]) + 1), CHUNK) if b == a + 1 else [int(offsets[a])]:
            # a long text is cut into ranges of window starts; a range reaches into the next by length - 1
            end = min(int(offsets[b]), begin + CHUNK + length - 1) if b == a + 1 else int(offsets[b])
            if end - begin < length:
                continue
            text = data[begin:end]
            sums = prefix_hashes(text)
            starts = np.arange(len(text) - gram + 1)
            grams = substring_hashes(sums, starts, starts + gram)
            at = _leftmost_minimum(grams, length - gram + 1)
            inner = offsets[a : b + 1] - begin
            row = np.searchsorted(inner, np.arange(len(at)), "right") - 1
            whole = np.arange(len(at)) + length <= inner[np.minimum(row + 1, b - a)]
            opens = whole & np.concatenate([[True], (at[1:] != at[:-1]) | (row[1:] != row[:-1]) | ~whole[:-1]])
            closes = whole & np.concatenate([(at[1:] != at[:-1]) | (row[1:] != row[:-1]) | ~whole[1:], [True]])
            first, last = np.flatnonzero(opens), np.flatnonzero(closes)
            own = row[first]
            whole_context = substring_hashes(sums, first, last + length)
            parts.append((own + a, first + begin - offsets[own + a], last - first, grams[at[first]], whole_context))
    if not parts:
        return tuple(np.zeros(0, t) for t in (np.int64, np.int64, np.int64, np.uint64, np.uint64))
    return tuple(np.concatenate(c) for c in zip(*parts))


def _not_first(*keys: np.ndarray) -> np.ndarray:
    """Which entries have an equal entry before them."""
    order = np.lexsort((np.arange(len(keys[0])), *keys))
    again = np.ones(len(order), bool)
    again[:1] = False
    for key in keys:
        again[1:] &= key[order][1:] == key[order][:-1]
    out = np.zeros(len(order), bool)
    out[order] = again
    return out


def _ordered(ids: np.ndarray, first: np.ndarray, *before: np.ndarray) -> np.ndarray:
    """The order by ``before``, then by document and start; a document is (id, hash of its text)."""
    return np.lexsort((first, ids[:, 1], ids[:, 0], *before))


def _owners(ids: np.ndarray, owner: np.ndarray) -> tuple[bytes, bytes]:
    """(place of each entry's document in a list of documents, that list)"""
    used, local = np.unique(owner, return_inverse=True)
    return local.astype(np.uint32 if len(used) > 65536 else np.uint16).tobytes(), ids[used].tobytes()


def _read_owners(local: bytes, ids: bytes, n: int) -> np.ndarray:
    return np.frombuffer(ids, np.int64).reshape(-1, 2)[np.frombuffer(local, np.uint16 if len(local) == 2 * n else np.uint32)]


def _pack(n_blocks: int, ids, owner, first, more, key, context, pieces=None, crowded=False) -> Iterator[tuple]:
    """One row of _PACKED for each block, of entries in document order.

    An entry whose (key, context) came before in the batch is sure to be removed: it travels without hashes, dealt
    evenly over the blocks.
    """
    if len(key) == 0:
        return
    sure = _not_first(context, key) if pieces is None else np.zeros(len(key), bool)
    block = np.where(sure, np.arange(len(key)) % n_blocks, (key % np.uint64(n_blocks)).astype(np.int64))
    order = np.argsort(block, kind="stable")
    edges = np.searchsorted(block[order], np.arange(n_blocks + 1))
    for k in np.flatnonzero(np.diff(edges)):
        own = order[edges[k] : edges[k + 1]]
        open_, known = own[~sure[own]], own[sure[own]]
        sides = []
        for part in (open_, known):
            local, used = _owners(ids, owner[part])
            sides.append((local, first[part].astype(np.uint32).tobytes(), more[part].astype(np.uint8).tobytes(), used))
        (o, f, m, i), (so, sf, sm, si) = sides
        blob = b"".join(pieces[x] for x in open_) if pieces is not None else b""
        yield int(k), crowded, key[open_].tobytes(), context[open_].tobytes(), o, f, m, i, blob, so, sf, sm, si


def _batch(rows: list[tuple]) -> pa.RecordBatch:
    kinds = [pa.int32(), pa.bool_(), *[pa.binary()] * 11]
    names = [c.split()[0] for c in _PACKED.split(", ")]
    columns = list(zip(*rows)) or [()] * len(kinds)
    return pa.RecordBatch.from_arrays([pa.array(list(c), t) for c, t in zip(columns, kinds)], names)


def _unpack(rows: list[dict]) -> tuple[np.ndarray, ...]:
    """(id, first, more, key, context, row number) of the open entries and (id, first, more) of the sure ones."""
    out, sure = [], []
    for number, r in enumerate(rows):
        first = np.frombuffer(r["first"], np.uint32)
        out.append((
            _read_owners(r["owner"], r["ids"], len(first)), first.astype(np.int64), np.frombuffer(r["more"], np.uint8).astype(np.int64),
            np.frombuffer(r["key"], np.uint64), np.frombuffer(r["context"], np.uint64), np.full(len(first), number),
        ))
        known = np.frombuffer(r["sure_first"], np.uint32)
        sure.append((_read_owners(r["sure_owner"], r["sure_ids"], len(known)), known.astype(np.int64), np.frombuffer(r["sure_more"], np.uint8).astype(np.int64)))
    return (*(np.concatenate(c) for c in zip(*out)), *(np.concatenate(c) for c in zip(*sure)))


_FOUND = "id long, h long, first int, more int, key long, crowded boolean"


def _found(ids, first, more, key=None, crowded=None) -> pa.RecordBatch:
    n = len(ids)
    return pa.RecordBatch.from_arrays(
        [
            pa.array(ids[:, 0], pa.int64()), pa.array(ids[:, 1], pa.int64()), pa.array(first.astype(np.int32)), pa.array(more.astype(np.int32)),
            pa.nulls(n, pa.int64()) if key is None else pa.array(key.view(np.int64)), pa.nulls(n, pa.bool_()) if crowded is None else pa.array(crowded),
        ],
        ["id", "h", "first", "more", "key", "crowded"],
    )


def _compare_hashes(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Step 2: rows without a key are removed; rows with a key are to be fetched."""
    rows = [r for batch in batches for r in batch.to_pylist()]
    if not rows:
        return
    ids, first, more, key, context, _, s_ids, s_first, s_more = _unpack(rows)
    yield _found(s_ids, s_first, s_more)
    order = _ordered(ids, first, key)
    ids, first, more, key, context = (x[order] for x in (ids, first, more, key, context))
    again = _not_first(context, key)
    yield _found(ids[again], first[again], more[again])
    ids, first, more, key = (x[~again] for x in (ids, first, more, key))
    _, kind, copies = np.unique(key, return_inverse=True, return_counts=True)
    several = copies[kind] > 1
    yield _found(ids[several], first[several], more[several], key[several], (copies[kind] > CROWDED)[several])


def repeated_starts(keys: np.ndarray, pieces: list[np.ndarray], length: int = LENGTH) -> list[np.ndarray]:
    """Starts in each piece whose window also occurs in an earlier piece of the same key. Pieces are in document order.

    Round r pairs the blocks of 2**r pieces of each key: the left block of each pair is indexed, the right one is
    streamed. All keys and pairs share one index; a pair has symbols of its own, so that only its two blocks match.
    """
    marked = [np.zeros(max(len(p) - length + 1, 0), bool) for p in pieces]
    _, kind, copies = np.unique(keys, return_inverse=True, return_counts=True)
    order = np.argsort(kind, kind="stable")
    rank = np.empty(len(keys), np.int64)
    rank[order] = np.arange(len(keys)) - np.repeat(np.cumsum(copies) - copies, copies)
    copies = copies[kind]
    for r in range(int(copies.max(initial=1) - 1).bit_length()):
        block, pair = rank >> r, rank >> (r + 1)
        later = [k for k in np.flatnonzero(block & 1) if not marked[k].all()]
        if not later:
            continue
        earlier = np.flatnonzero((block & 1 == 0) & (((block + 1) << r) < copies))
        symbols = lambda k: pieces[k].astype(np.int64) + (1 + (int(pair[k]) << 8))
        index = RunLengthIndex([symbols(k) for k in earlier])
        for k, statistics in zip(later, index.matching_statistics([symbols(k) for k in later])):
            marked[k] |= statistics[: len(marked[k])] >= length
    return [np.flatnonzero(m) for m in marked]


def _groups_in_order(keys: np.ndarray) -> list[np.ndarray]:
    """Keys dealt into runs of about RUN pieces with whole keys, so that an index stays small."""
    order = np.argsort(keys, kind="stable")
    edges = np.flatnonzero(np.concatenate([[True], keys[order][1:] != keys[order][:-1]]))
    runs, begin = [], 0
    for edge in [*edges[1:], len(keys)]:
        if edge - begin >= RUN:
            runs.append(np.sort(order[begin:edge]))
            begin = edge
    if begin < len(keys):
        runs.append(np.sort(order[begin:]))
    return runs


def _runs_of(starts: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(first, further) of runs of consecutive numbers."""
    breaks = np.flatnonzero(np.diff(starts) != 1)
    first, last = starts[np.concatenate([[0], breaks + 1])], starts[np.concatenate([breaks, [len(starts) - 1]])]
    return first, last - first


def _quarters(first, more, anchor, bounds, length: int, gram: int) -> tuple[np.ndarray, ...]:
    """The windows of each piece by how far they reach left of the gram: (piece, first, further, from, to).

    All windows of a quarter hold the bytes from .. to of the packed pieces, so pieces that differ there need no comparing.
    """
    reach, width = length - gram, -(-(length - gram + 1) // 4)
    out = []
    for q in range(4):
        low, high = np.maximum(q * width, anchor - more), np.minimum(min((q + 1) * width - 1, reach), anchor)
        piece = np.flatnonzero(low <= high)
        core = bounds[piece] + anchor[piece] - q * width
        out.append((piece, (first + anchor - high)[piece], (high - low)[piece], core, core + length - width + 1))
    return tuple(np.concatenate(c) for c in zip(*out))


def _compare_texts(length: int, gram: int):
    """Step 3, and step 4 for crowded grams."""

    def compare(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        rows = [r for batch in batches for r in batch.to_pylist()]
        for crowded in (False, True):
            some = [r for r in rows if r["crowded"] == crowded]
            if not some:
                continue
            ids, first, more, key, context, _, s_ids, s_first, s_more = _unpack(some)
            yield _found(s_ids, s_first, s_more)
            if crowded:  # single windows: key is the window's hash
                order = _ordered(ids, first, key)
                again = order[1:][key[order][1:] == key[order][:-1]]
                yield _found(ids[again], first[again], more[again])
                continue
            texts = np.frombuffer(b"".join(r["bytes"] for r in some), np.uint8)
            bounds = np.concatenate([[0], np.cumsum(more + length)])
            piece, start, further, low, high = _quarters(first, more, context.astype(np.int64), bounds, length, gram)
            sums = prefix_hashes(texts)
            group = mixed(key[piece] ^ substring_hashes(sums, low, high))
            begin = bounds[piece] + start - first[piece]
            end = begin + further + length
            order = _ordered(ids[piece], start)
            piece, start, further, group, begin, end = (x[order] for x in (piece, start, further, group, begin, end))
            again = _not_first(substring_hashes(sums, begin, end), group)
            yield _found(ids[piece[again]], start[again], further[again])
            piece, start, group, begin, end = (x[~again] for x in (piece, start, group, begin, end))
            _, kind, copies = np.unique(group, return_inverse=True, return_counts=True)
            several = copies[kind] > 1
            piece, start, group, begin, end = (x[several] for x in (piece, start, group, begin, end))
            for run in _groups_in_order(group):
                for k, marked in zip(run, repeated_starts(group[run], [texts[begin[x] : end[x]] for x in run], length)):
                    if len(marked):
                        at, more_at = _runs_of(marked)
                        yield _found(np.repeat(ids[piece[k]][None], len(at), axis=0), at + start[k], more_at)

    return compare


def _documents(batch: pa.RecordBatch) -> np.ndarray:
    """(id, h) of the rows of a batch that begins with these two columns."""
    return np.stack([batch.column(k).to_numpy(zero_copy_only=False) for k in (0, 1)], axis=1)


def _squeezed(docs: DataFrame, keep: tuple[str, ...] | list[str] = ()) -> DataFrame:
    """``keep`` and (id, h, z): texts compressed before they are shuffled."""
    rows = docs.select(*keep, "id", "h", "text")
    names = [*rows.columns[:-1], "z"]

    def squeeze(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        codec = zstandard.ZstdCompressor(level=1)
        for batch in sliced(batches, 2000):
            data, offsets = packed(batch.column(batch.num_columns - 1))
            z = [codec.compress(data[offsets[k] : offsets[k + 1]].tobytes()) for k in range(batch.num_rows)]
            yield pa.RecordBatch.from_arrays([*batch.columns[:-1], pa.array(z, pa.binary())], names)

    return rows.mapInArrow(tidied(squeeze), StructType([*rows.schema.fields[:-1], StructField("z", BinaryType())]))


def repeated_spans(docs: DataFrame, length: int = LENGTH, gram: int = GRAM) -> DataFrame:
    """Rows (id, h, first, more): the window starts first .. first + more of a document are repeats of windows of other ones, or of itself.

    ``docs`` is (id, h, text), h a hash of the text. Rows with equal (id, h) are one document here.
    """
    size = docs.agg(F.sum(F.octet_length("text"))).first()[0] or 0
    n_blocks = int(size // BLOCK_BYTES) + 1

    def hash_contexts(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in sliced(batches, 4000):
            ids = _documents(batch)
            data, offsets = packed(batch.column(2))
            row, first, more, key, context = contexts(data, offsets, length, gram)
            by_doc = _ordered(ids[row], first)
            for r in _pack(n_blocks, ids, *(x[by_doc] for x in (row, first, more, key, context))):
                yield _batch([r])

    hashed = docs.mapInArrow(tidied(hash_contexts), _PACKED)
    found = stored(hashed.repartition(n_blocks, "block").mapInArrow(tidied(_compare_hashes), _FOUND), "contexts")

    wanted = found.where("key is not null").groupBy(F.col("id").alias("want"), F.col("h").alias("want_h")).agg(F.collect_list(F.struct("first", "more", "key", "crowded")).alias("of"))
    fetched = _squeezed(docs).join(wanted, (F.col("id") == F.col("want")) & (F.col("h") == F.col("want_h"))).select("id", "h", "z", "of")

    def fetch(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        codec = zstandard.ZstdDecompressor()
        for batch in sliced(batches, 1000):
            ids = _documents(batch)
            plain: list[list] = [[], [], [], [], []]  # owner, first, more, key, place of the gram from first on
            pieces: list[bytes] = []
            single: list[list] = [[], [], []]  # owner, start, hash
            for k, (z, of) in enumerate(zip(batch.column(2).to_pylist(), batch.column(3).to_pylist())):
                text = codec.decompress(z)
                crowd = sorted((c["first"], c["more"]) for c in of if c["crowded"])
                sums = prefix_hashes(np.frombuffer(text, np.uint8))
                some = sorted((c["first"], c["more"], c["key"]) for c in of if not c["crowded"])
                if some:
                    first, more, key = np.array(some, np.int64).T
                    at = first[:, None] + np.arange(length - gram + 1)
                    at = np.minimum(at, len(text) - gram)
                    anchor = (substring_hashes(sums, at, at + gram) == key.view(np.uint64)[:, None]).argmax(axis=1)
                    for column, value in zip(plain, (np.full(len(some), k), first, more, key, anchor)):
                        column.append(value)
                    pieces += [text[a : a + m + length] for a, m in zip(first, more)]
                if crowd:
                    starts = np.concatenate([np.arange(f, f + m + 1) for f, m in crowd])
                    for column, value in zip(single, (np.full(len(starts), k), starts, substring_hashes(sums, starts, starts + length))):
                        column.append(value)
            if plain[0]:
                owner, first, more, key, anchor = (np.concatenate(c) for c in plain)
                for r in _pack(n_blocks, ids, owner, first, more, mixed(key.view(np.uint64)), anchor.astype(np.uint64), pieces):
                    yield _batch([r])
            if single[0]:
                owner, first, key = (np.concatenate(c) for c in single)
                by_doc = _ordered(ids[owner], first)
                for r in _pack(n_blocks, ids, owner[by_doc], first[by_doc], np.zeros(len(owner), np.int64), key[by_doc], np.zeros(len(owner), np.uint64), crowded=True):
                    yield _batch([r])

    compared = fetched.mapInArrow(tidied(fetch), _PACKED).repartition(n_blocks, "block").mapInArrow(tidied(_compare_texts(length, gram)), _FOUND)
    compared = stored(compared, "matches")
    return found.where("key is null").unionByName(compared).select("id", "h", "first", "more")


def deduplicate(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", length: int = LENGTH, keep: Sequence[str] = ()) -> DataFrame:
    """(id, kept, n_bytes, n_removed, n_spans, kept_sha256) of every document, and the columns ``keep`` (none named like these).

    ``kept`` is what stays as text, without the halves of characters that a cut went through; the digest is that of
    all bytes that stay.
    """
    if not GRAM <= length <= MOST:
        raise ValueError(f"length must be from {GRAM} to {MOST}")
    texts = docs.select(
        F.struct(F.col(id_col).cast("long").alias(id_col), *keep).alias("row"), F.coalesce(F.col(id_col).cast("long"), F.lit(FIRST_ID)).alias("id"),
        F.xxhash64(F.coalesce(F.col(text_col), F.lit(""))).alias("h"), F.coalesce(F.col(text_col), F.lit("")).alias("text"),
    )
    key = ["id", "h"]
    # equal rows are compared once; all but one of them repeat it whole
    repeated = stored(texts.groupBy(*key).count().where("count > 1").select(*(F.col(c).alias(f"r_{c}") for c in key)), "equal-rows")
    again = not repeated.isEmpty()
    distinct = texts.select(*key, "text")
    if again:
        of_repeated = (F.col("id") == F.col("r_id")) & (F.col("h") == F.col("r_h"))
        distinct = distinct.join(repeated, of_repeated, "left_anti").unionByName(distinct.join(repeated, of_repeated, "left_semi").dropDuplicates(key))
    spans = repeated_spans(distinct, length).groupBy(F.col("id").alias("s_id"), F.col("h").alias("s_h")).agg(F.collect_list(F.struct("first", "more")).alias("spans"))
    joined = _squeezed(texts, ["row"]).join(spans, (F.col("id") == F.col("s_id")) & (F.col("h") == F.col("s_h")), "left")
    copy = F.row_number().over(Window.partitionBy(*key).orderBy("h")) if again else F.lit(1)
    joined = joined.withColumn("copy", copy).select("row", "z", "spans", "copy")

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        codec = zstandard.ZstdDecompressor()
        for batch in sliced(batches, 1000):
            out = []
            for z, spans, copy in zip(*(batch.column(k).to_pylist() for k in (1, 2, 3))):
                text, n_spans = codec.decompress(z), 0
                if copy > 1 and len(text) >= length:
                    out.append(("", len(text), len(text), 1, hashlib.sha256(b"").hexdigest()))
                    continue
                kept, at = [], 0
                for s in sorted(spans or (), key=lambda s: s["first"]):
                    a, b = s["first"], s["first"] + s["more"] + length
                    if a > at or not n_spans:
                        kept.append(text[at:a])
                        n_spans += 1
                    at = max(at, b)
                kept.append(text[at:])
                rest = b"".join(kept)
                out.append((rest.decode(errors="ignore"), len(text), len(text) - len(rest), n_spans, hashlib.sha256(rest).hexdigest()))
            columns = list(zip(*out)) or [()] * 5
            kinds = [pa.string(), pa.int64(), pa.int64(), pa.int64(), pa.string()]
            arrays = [pa.array(list(c), t) for c, t in zip(columns, kinds)]
            yield pa.RecordBatch.from_arrays([batch.column(0), *arrays], ["row", *made])

    made = {"kept": "string", "n_bytes": "long", "n_removed": "long", "n_spans": "long", "kept_sha256": "string"}
    fields = StructType([joined.schema["row"]])
    for name, kind in made.items():
        fields = fields.add(name, kind)
    return joined.mapInArrow(tidied(cut), fields).select("row.*", *made)

"""Sampled SentencePiece segmentations: Gumbel top-k without replacement by perturbed best-first (A*) search.

A text's segmentations are the paths through the lattice of its pieces. The search tree decides pieces from left to
right; a node's probability sums over all ways to finish (computed backwards over the lattice, so the bound of the
search is exact). Perturbed log-probabilities are minus the logarithms of arrival times of exponential races whose
rates are the probabilities. The best child inherits its parent's time; the others arrive later by an exponential time
of their own rate, which is the conditional Gumbel in other words. So the first path follows best children to
the end, its open siblings are known then, and the earliest of them is where the next distinct path branches off.
k pops give k distinct segmentations, drawn without replacement in proportion to their probabilities; the earliest
sibling left open is the threshold of the inclusion scores.

The lattice is that of units: a run of blanks with the word after it. No piece of the vocabulary crosses the start of
a unit, so all units of a batch are walked at once. Units have any length; beyond LINEAR_BYTES from their end the sums
over the ways to finish are kept as logarithms.

Defined results: null and empty texts have one segmentation, of the blank in front; a text with fewer than k
segmentations gives them all, with inclusion 1; numbers are drawn from seed, id and text position only, so
repeated rows and retried tasks give equal samples; an empty table gives an empty result; a null id is hashed as the
word null; other columns are kept if asked for.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from itertools import chain

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tradewind.llm.common import mixed, prefix_hashes, sliced, tidied
from tradewind.llm.piece_model import META, PieceModel

K = 2
#: So near to a unit's end the sums are products of doubles, which cannot underflow there even if all bytes are spelled out.
LINEAR_BYTES = 40
#: Characters that one set of lattices covers; a task holds about 340 bytes for each while it samples.
CHUNK = 250_000
#: Siblings of nodes below this log-probability are first looked at together.
_DEEP = -12.0
_SPELLED = b"\xff\xff\xff"  # stands for a literal U+2581; UTF-8 has no such bytes
_A, _B, _C = np.uint64(0x9E3779B97F4A7C15), np.uint64(0xA24BAED4963EE407), np.uint64(0x9FB21C651E98DF25)
_D = np.uint64(0xD6E8FEB86659FD93)


def units_of(text: str) -> list[str]:
    """The text, with one blank in front, cut before every run of blanks; the first blank of a unit is left out."""
    out = text.split(" ")
    if "" in out:
        runs, blanks = [], 0
        for word in out:
            if word:
                runs.append(" " * blanks + word)
                blanks = 0
            else:
                blanks += 1
        out = [*runs, " " * (blanks - 1)] if blanks else runs
    return out


def _encoded(units: list[str]) -> list[bytes]:
    """The units as bytes, with their first blank, a literal U+2581 marked, and blanks as pieces write them."""
    if "\0" in "".join(units):
        return [(" " + u).encode().replace(META, _SPELLED).replace(b" ", META) for u in units]
    raw = "\0".join(units).encode().replace(META, _SPELLED).replace(b" ", META)
    return [META + u for u in raw.split(b"\0")]


class Lattices:
    """Lattices of distinct units. Node ``start[u] + p`` stands before byte p; edges first[node] .. first[node + 1] are pieces."""

    def __init__(self, units: list[str], model: PieceModel):
        encoded = _encoded(units)
        width = np.fromiter(map(len, encoded), np.int64, len(encoded))
        self.start = np.concatenate([[0], np.cumsum(width + 1)])
        n = int(self.start[-1])
        joined = b"\0".join(encoded) + b"\0"
        flat = np.frombuffer(joined, np.uint8)
        original = np.frombuffer(joined.replace(_SPELLED, META), np.uint8)
        sums = prefix_hashes(flat)
        kind = np.min_scalar_type(int(width.max(initial=0)))  # small integers sort faster
        left = (np.repeat(self.start[1:] - 1, width + 1) - np.arange(n)).astype(kind)
        self.last = left == 0
        nodes, pieces, sizes, slots = [], [], [], []
        count = np.zeros(n, np.int32)

        def add(at: np.ndarray, ids: np.ndarray, size: int) -> None:
            nodes.append(at), pieces.append(ids), sizes.append(np.full(len(at), size, np.int32)), slots.append(count[at])
            count[at] += 1

        reach = np.minimum(np.minimum(left, 255).astype(np.uint8), model.longest(flat))
        at = np.flatnonzero(left).astype(np.int32)
        for size in model.lengths:
            at = at[reach[at] >= size]
            if len(at) == 0:
                break
            hit, ids = model.find(sums, at, size)
            add(at[hit], ids, size)
        bare = np.flatnonzero((count == 0) & ~self.last)  # spelled out byte by byte
        add(bare, model.byte_ids[original[bare]], 1)
        self.first = np.concatenate([[0], np.cumsum(count)]).astype(np.int32)
        node, slot = np.concatenate(nodes), np.concatenate(slots)
        place = self.first[node] + slot
        order = np.empty(len(place), np.int32)
        order[place] = np.arange(len(place), dtype=np.int32)
        node, slot, self.piece, size = node[order], slot[order], np.concatenate(pieces)[order], np.concatenate(sizes)[order]
        self.target = node + size
        # probabilities of all ways to finish, from the units' ends backwards
        finish = self.last.astype(np.float64)
        p = model.probability[self.piece]
        of_edge = left[node]
        by_left = np.argsort(of_edge, kind="stable")
        edges = np.concatenate([[0], np.cumsum(np.bincount(of_edge, minlength=int(left.max(initial=0)) + 1))])
        near = min(len(edges) - 1, LINEAR_BYTES + 1)
        # edges side by side in the order of their distance from the unit's end
        close = by_left[: edges[near]]
        begun, ahead, ways = node[close], self.target[close], p[close]
        heads = np.flatnonzero(np.diff(begun, prepend=-1))
        bounds = np.searchsorted(heads, edges[: near + 1])
        for d in range(1, near):
            own, some = slice(edges[d], edges[d + 1]), heads[bounds[d] : bounds[d + 1]]
            if len(some):
                ways[own] *= finish[ahead[own]]
                finish[begun[some]] = np.add.reduceat(ways[own], some - edges[d])
        p[close] = ways
        far = by_left[edges[near] :]
        finish[node[far]] = 1.0  # those follow as logarithms
        share = p / finish[node]
        with np.errstate(divide="ignore"):
            self.log_share, self.log_finish = np.log(share), np.log(finish)
        ways, ahead = self.log_share[far], self.target[far]
        heads = np.flatnonzero(np.diff(node[far], prepend=-1))
        begun, bounds = node[far[heads]], np.searchsorted(heads, edges[near:] - edges[near])
        for d in range(len(bounds) - 1):
            own, some = slice(*(edges[near + d : near + d + 2] - edges[near])), slice(bounds[d], bounds[d + 1])
            if own.start < own.stop:
                self.log_finish[begun[some]] = np.logaddexp.reduceat(ways[own] + self.log_finish[ahead[own]], heads[some] - own.start)
        self.log_share[far] = ways + self.log_finish[ahead] - self.log_finish[node[far]]
        share[far] = np.exp(self.log_share[far])
        self.running = share  # running shares of each node's edges, node by node, so that no sum depends on the other units
        by_slot = np.argsort(slot.astype(np.min_scalar_type(int(slot.max(initial=0)))), kind="stable")
        turns = np.cumsum(np.bincount(slot))
        for k in range(1, len(turns)):
            at = by_slot[turns[k - 1] : turns[k]]
            share[at] += share[at - 1]
        share[self.first[1:][np.diff(self.first) > 0] - 1] = 2.0  # rounding cannot leave a gap at the end

    def draw(self, node: np.ndarray, u: np.ndarray) -> np.ndarray:
        """For each node the edge whose share holds u, halving the range of its edges."""
        low, high = self.first[node], self.first[node + 1] - 1
        for _ in range(int((high - low).max(initial=0)).bit_length()):
            middle = (low + high) >> 1
            beyond = self.running[middle] <= u
            low, high = np.where(beyond & (low < high), middle + 1, low), np.where(beyond, high, middle)
        return low


def _later(key: np.uint64, n: int, factor: np.uint64) -> np.uint64:
    """key + n * factor modulo 2**64, without warnings of scalars."""
    return np.uint64((int(key) + n * int(factor)) & 0xFFFFFFFFFFFFFFFF)


def _uniform(key: np.ndarray) -> np.ndarray:
    return ((mixed(key) >> np.uint64(11)).astype(np.float64) + 0.5) * 2.0**-53


def walk(lattices: Lattices, node: np.ndarray, key: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Draw the pieces from each node to its unit's end: (edges, bounds of each node's edges)."""
    steps, at = [], node.copy()
    who = np.flatnonzero(~lattices.last[at])
    count = np.zeros(len(node), np.int64)
    while len(who):
        here = at[who]
        u = _uniform(key[who] + count[who].astype(np.uint64) * _A)
        edge = lattices.draw(here, u)
        steps.append((who, edge))
        count[who] += 1
        at[who] = lattices.target[edge]
        who = who[~lattices.last[at[who]]]
    bounds = np.concatenate([[0], np.cumsum(count)])
    out = np.empty(bounds[-1], np.int64)
    for t, (who, edge) in enumerate(steps):
        out[bounds[who] + t] = edge
    return out, bounds


def _siblings(lattices: Lattices, node_of: np.ndarray, edges: np.ndarray, begin: int, before: float, log_time: float, key: np.uint64, k: int) -> tuple[np.ndarray, ...]:
    """(log arrival, place in the path, edge) of the open siblings of one path from place ``begin`` on."""
    own = edges[begin:]
    so_far = before + np.concatenate([[0.0], np.cumsum(lattices.log_share[own])])

    def look(low: int, high: int) -> tuple[np.ndarray, ...]:
        """Log arrivals after ``log_time`` without it, places and edges of the siblings of a range of the path."""
        node = node_of[own[low:high]]
        begins, ends = lattices.first[node].astype(np.int64), lattices.first[node + 1]
        place = np.repeat(np.arange(low, high), ends - begins)
        low_edge = np.repeat(begins, ends - begins)
        edge = np.arange(len(place)) - np.repeat(np.cumsum(ends - begins) - (ends - begins), ends - begins) + low_edge
        keep = edge != own[place]
        place, edge, slot = place[keep], edge[keep], (edge - low_edge)[keep]
        draw = -np.log(_uniform(np.full(1, key) + (place + begin).astype(np.uint64) * _B + slot.astype(np.uint64) * _C))
        return np.log(draw) - so_far[place] - lattices.log_share[edge], place + begin, edge

    shallow = min(int(np.searchsorted(-so_far, -_DEEP, "right")), len(own))
    found = look(0, shallow)
    if shallow < len(own):
        # All siblings below arrive together like one of their summed rate. Only if that is early are they told apart;
        # the earliest of them then has that time, and the others follow as they would have followed it.
        mass = np.exp(so_far[shallow]) - np.exp(so_far[-1])
        with np.errstate(divide="ignore"):
            together = np.log(-np.log(_uniform(np.full(1, key ^ _A)))) - np.log(mass)
        enough = 2 * k + 2
        if len(found[0]) < enough or together[0] < np.partition(found[0], enough - 1)[enough - 1]:
            deep = look(shallow, len(own))
            if len(deep[0]):
                with np.errstate(divide="ignore"):
                    later = np.logaddexp(together, deep[0] + np.log1p(-np.exp(deep[0].min() - deep[0])))
                found = tuple(np.concatenate(x) for x in zip(found, (later, *deep[1:])))
    return np.logaddexp(log_time, found[0]), found[1], found[2]


def sample(texts: list[str], seeds: np.ndarray, model: PieceModel, k: int = K) -> list[list[tuple[np.ndarray, float, float]]]:
    """For each text up to k of (piece ids, log-probability, log inclusion score), in the order they were drawn."""
    per_text = [units_of(t) for t in texts]
    sizes = np.array([len(u) for u in per_text], np.int64)
    numbers = {u: k for k, u in enumerate(dict.fromkeys(chain.from_iterable(per_text)))}
    unit = np.fromiter(map(numbers.__getitem__, chain.from_iterable(per_text)), np.int64, int(sizes.sum()))
    lattices = Lattices(list(numbers), model)
    node_of = np.repeat(np.arange(len(lattices.first) - 1), np.diff(lattices.first))
    log_finish = lattices.log_finish[lattices.start[:-1]]
    bounds = np.concatenate([[0], np.cumsum(sizes)])
    place = (np.arange(len(unit)) - np.repeat(bounds[:-1], sizes)).astype(np.uint64)
    text_of = np.repeat(np.arange(len(texts)), sizes)
    start = lattices.start[unit]
    log_z = np.add.reduceat(log_finish[unit], bounds[:-1]) if len(texts) else np.zeros(0)

    keys = mixed(seeds + _A)
    edges, at = walk(lattices, start, keys[text_of] + place * _B)
    paths = [[edges[at[bounds[i]] : at[bounds[i + 1]]]] for i in range(len(texts))]
    times = np.log(-np.log(_uniform(keys ^ _C)))
    open_: list[list[tuple]] = []  # of each text: (log arrival, path, place, edge)
    drawn = [[times[i]] for i in range(len(texts))]

    def opened(i: int, path: int, begin: int, before: float, log_time: float) -> list[tuple]:
        key = mixed(np.array([_later(keys[i], path, _A)]) ^ _D)[0]  # apart from the keys of the walks
        arrival, where, edge = _siblings(lattices, node_of, paths[i][path], begin, before, log_time, key, k)
        few = np.argpartition(arrival, 2 * k + 1)[: 2 * k + 2] if len(arrival) > 2 * k + 2 else range(len(arrival))
        return [(float(arrival[x]), path, int(where[x]), int(edge[x])) for x in few]

    for i in range(len(texts)):
        open_.append(sorted(opened(i, 0, 0, 0.0, times[i])))
    for r in range(1, k):
        branch = [i for i in range(len(texts)) if open_[i]]
        if not branch:
            break
        nodes, node_keys, heads = [], [], []
        for i in branch:
            log_time, path, where, edge = open_[i].pop(0)
            old = paths[i][path]
            ended = int(lattices.last[lattices.target[old[:where]]].sum())  # whole units before the branch
            key = mixed(np.array([_later(keys[i], r, _C)]))
            later = np.arange(bounds[i] + ended, bounds[i + 1])
            own = start[later].copy()
            own[0] = lattices.target[edge]
            nodes.append(own), node_keys.append(key + place[later] * _B)
            heads.append((i, log_time, np.append(old[:where], edge)))
        counts = np.concatenate([[0], np.cumsum([len(x) for x in nodes])])
        fresh, fresh_at = walk(lattices, np.concatenate(nodes), np.concatenate(node_keys))
        for (i, log_time, head), a, b in zip(heads, counts[:-1], counts[1:]):
            paths[i].append(np.concatenate([head, fresh[fresh_at[a] : fresh_at[b]]]))
            drawn[i].append(log_time)
            before = float(lattices.log_share[head].sum())
            open_[i] = sorted(open_[i] + opened(i, len(paths[i]) - 1, len(head), before, log_time))
    out = []
    for i in range(len(texts)):
        limit = open_[i][0][0] if open_[i] else np.inf
        samples = []
        for path in paths[i]:
            share = float(lattices.log_share[path].sum())
            log_rate = share + limit
            inclusion = 0.0 if log_rate > 30 else log_rate if log_rate < -30 else float(np.log(-np.expm1(-np.exp(log_rate))))
            samples.append((lattices.piece[path], share + float(log_z[i]), inclusion))
        out.append(samples)
    return out


def _chunks(texts: list[str]) -> Iterator[tuple[int, int]]:
    first, size = 0, 0
    for i, t in enumerate(texts):
        size += len(t)
        if size >= CHUNK:
            yield first, i + 1
            first, size = i + 1, 0
    if first < len(texts):
        yield first, len(texts)


def encode(docs: DataFrame, vocabulary: str, k: int = K, seed: int = 7, id_col: str = "doc_id", text_col: str = "text", copy_col: str | None = None) -> DataFrame:
    """Rows (id, sample, pieces, log_probability, log_inclusion, text_sha256), up to k for each row of ``docs``. One pass, no shuffle.

    ``copy_col`` numbers the copies of a row that are to be sampled apart; the first copy has the samples of a row without
    number. The vocabulary file is read on the driver; its arrays (about 2 MB) travel with the tasks.
    """
    key = F.xxhash64(F.lit(seed), F.coalesce(F.col(id_col).cast("string"), F.lit("null")))
    if copy_col is not None:
        key = F.when(F.col(copy_col) > 1, F.xxhash64(key, F.col(copy_col).cast("long"))).otherwise(key)
    model = docs.sparkSession.sparkContext.broadcast(PieceModel(vocabulary))
    chosen = docs.select(
        F.col(id_col).alias("id"),
        F.coalesce(F.col(text_col), F.lit("")).alias("text"),
        key.alias("key"),
    )

    def draw(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in sliced(batches, 2500):
            texts = batch.column(1).to_pylist()
            seeds = batch.column(2).to_numpy(zero_copy_only=False).view(np.uint64)
            for a, b in _chunks(texts):
                found = sample(texts[a:b], seeds[a:b], model.value, k)
                counts = [len(s) for s in found]
                flat = [x for s in found for x in s]
                owner = pa.array(np.repeat(np.arange(a, b), counts))
                shas = [hashlib.sha256(t.encode()).hexdigest() for t in texts[a:b]]
                ends = np.concatenate([[0], np.cumsum([len(x[0]) for x in flat])]).astype(np.int32)
                pieces = pa.ListArray.from_arrays(ends, np.concatenate([x[0] for x in flat]).astype(np.int32))
                yield pa.RecordBatch.from_arrays(
                    [
                        batch.column(0).take(owner), pa.array(np.concatenate([np.arange(1, c + 1) for c in counts]).astype(np.int32)), pieces,
                        pa.array([x[1] for x in flat]), pa.array([x[2] for x in flat]), pa.array(shas).take(pa.array(np.repeat(np.arange(b - a), counts))),
                    ],
                    ["id", "sample", "pieces", "log_probability", "log_inclusion", "text_sha256"],
                )

    kind = chosen.schema["id"].dataType.simpleString()
    schema = f"id {kind}, sample int, pieces array<int>, log_probability double, log_inclusion double, text_sha256 string"
    return chosen.mapInArrow(tidied(draw), schema).withColumnRenamed("id", id_col)


def decode(encoded: DataFrame, vocabulary: str, pieces_col: str = "pieces", text_col: str = "text") -> DataFrame:
    """``encoded`` with the text its pieces spell. One pass, no shuffle; null pieces give a null text."""
    from pyspark.sql.types import StringType, StructField, StructType

    model = encoded.sparkSession.sparkContext.broadcast(PieceModel(vocabulary))
    rest = [c for c in encoded.columns if c not in (pieces_col, text_col)]
    chosen = encoded.select(*rest, pieces_col)

    def spell(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        table = np.array(model.value.bytes_of, dtype=object)
        for batch in sliced(batches, 500):
            column = batch.column(batch.num_columns - 1)
            flat = table[column.flatten().to_numpy(zero_copy_only=False)]
            ends = np.concatenate([[0], np.cumsum(column.value_lengths().fill_null(0).to_numpy(zero_copy_only=False))])
            valid = column.is_valid().to_pylist()
            texts = [b"".join(flat[a:b])[1:].decode() if ok else None for a, b, ok in zip(ends[:-1], ends[1:], valid)]
            yield pa.RecordBatch.from_arrays([*batch.columns[:-1], pa.array(texts, pa.string())], [*rest, text_col])

    return chosen.mapInArrow(tidied(spell), StructType([*chosen.schema.fields[:-1], StructField(text_col, StringType())]))

"""The prefix trie of conversations by truncation peeling.

Every conversation is known by the key of its whole turn sequence; equal ones are one class from the start. Peeling begins
at the greatest depth: the classes that end there and the nodes that survive from below are merged by key, which gives the
nodes of that depth with all their figures; each then loses its last turn and is regrouped one depth higher. A node is found
and its subtree's sums are complete in the same step.

Depths below a cut are peeled inside tasks, one group for each prefix of the length of the cut, and the depths above it by
one grouping of the cluster for each. The cut is the smallest of LEAST_CUT, 2 * LEAST_CUT, ... at which no group of several
classes has more than GROUP_TURNS turns below it. A class alone in its group meets no other, so its rest is truncated
in one step, by columns. No turn sequence is ever collected whole unless it is that short: above the cut a row carries
at most so many keys, and partial sums keep a prefix that very many share out of any single task.

A prefix's key is a sum of hashed turns times powers of an odd base, in two lanes of 64 bits. Turns are sorted by range,
so that a conversation of any length spreads over slices; every slice sums its own rows and takes what came before from one
row for each slice. Text is hashed and measured where it is read and goes no further.

Defined results: rows with a null conversation id take no part; turns are ordered by number, null first, and turns of equal
number by the hash of role and text; null role or text counts as empty; repeated rows are turns of their own; an empty
table gives an empty trie, without a root; other columns are ignored. Ids divide like SQL: -5 - (-5 % 100) is 0.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from functools import reduce

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tradewind.llm.common import sliced, stored

LEAST_CUT = 8
GROUP_TURNS = 1 << 16
#: Ids written into one string before digests are taken.
CHUNK_IDS = 4096
_BASE = 0x9E3779B97F4A7C15
_MASK = (1 << 64) - 1
_EMPTY = hashlib.sha256(b"").hexdigest()
#: (depth, a, b): the key of a prefix; the empty one has key 0, 0.
NODE = "depth long, a long, b long, conv_id long, parent_conv_id long, n_convs long, n_children long, n_leaves long, saved_tokens long, ends string"


def _power_tables() -> list[np.ndarray]:
    tables, base = [], _BASE
    for _ in range(4):  # four digits of 12 bits
        steps = np.full(4096, base, np.uint64)
        steps[0] = 1
        tables.append(np.multiply.accumulate(steps))
        base = pow(base, 4096, 1 << 64)
    return tables


_POWERS = _power_tables()


def power(n: np.ndarray) -> np.ndarray:
    """The base to the nth, modulo 2**64."""
    out = _POWERS[0][n & 4095]
    for digit in range(1, 4):
        out = out * _POWERS[digit][(n >> (12 * digit)) & 4095]
    return out


def turns(conversations: DataFrame, id_col: str = "conv_id", turn_col: str = "turn", role_col: str = "role", text_col: str = "text") -> DataFrame:
    """(conv, place, x, y, size): each turn's order, two hashes of role and text, and the text's code points."""
    role, text = (F.coalesce(F.col(c), F.lit("")) for c in (role_col, text_col))
    return conversations.where(F.col(id_col).isNotNull()).select(
        F.col(id_col).cast("long").alias("conv"), F.col(turn_col).cast("long").alias("place"),
        F.xxhash64(F.lit(1), role, text).alias("x"), F.xxhash64(F.lit(2), role, text).alias("y"), F.length(text).cast("long").alias("size"),
    )


def running(rows: DataFrame, label: str) -> DataFrame:
    """(conv, i, x, y, a, b, before_a, before_b, size, upto): turn i, its prefix's key, the key before it, the sizes so far.

    ``rows`` (conv, place, x, y, size) should be a written table: range bounds are sampled from it first.
    """
    order = ["conv", "place", "x", "y"]
    sorted_rows = rows.select(*order, "size").repartitionByRange(*order).sortWithinPartitions(*order).withColumn("slice", F.spark_partition_id())
    names = ["slice", "conv", "i", "x", "y", "a", "b", "size", "upto"]
    schema = "slice int, " + ", ".join(f"{c} long" for c in names[1:])

    def sums(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        last, seen, key, upto = None, 0, [np.uint64(0), np.uint64(0)], 0
        for batch in batches:
            if batch.num_rows == 0:
                continue
            conv, size = batch.column(0).to_numpy(), batch.column(4).to_numpy()
            at = np.arange(len(conv))
            start = np.maximum.accumulate(np.where(np.concatenate([[True], conv[1:] != conv[:-1]]), at, 0))
            again = (start == 0) & (conv[0] == last)  # rows that go on with the conversation of the batch before
            i = at - start + 1 + np.where(again, seen, 0)
            factor, lanes = power(i), []
            for lane, carried in zip((2, 3), key):
                term = batch.column(lane).to_numpy().view(np.uint64) * factor
                total = np.cumsum(term)
                lanes.append(total - (total[start] - term[start]) + np.where(again, carried, np.uint64(0)))
            total = np.cumsum(size)
            sizes = total - (total[start] - size[start]) + np.where(again, upto, 0)
            last, seen, key, upto = conv[-1], int(i[-1]), [k[-1] for k in lanes], int(sizes[-1])
            keys = [pa.array(k.view(np.int64)) for k in lanes]
            columns = [batch.column(5), batch.column(0), pa.array(i), batch.column(2), batch.column(3), *keys, batch.column(4), pa.array(sizes)]
            yield pa.RecordBatch.from_arrays(columns, names)

    slices = stored(sorted_rows.mapInArrow(sums, schema), label)
    ends = slices.groupBy("slice").agg(F.min("conv").alias("first"), F.max_by(F.struct("conv", "i", "a", "b", "upto"), F.struct("conv", "i")).alias("end"))
    carried: dict[int, tuple] = {}
    open_ = None  # (conversation, turns, a, b, sizes) at the end of the slices so far; one row for each slice is read
    for row in ends.orderBy("slice").toLocalIterator():
        conv, i, a, b, upto = row["end"]
        a, b = a & _MASK, b & _MASK
        if open_ and open_[0] == row["first"]:
            carried[row["slice"]] = open_
            if conv == row["first"]:
                shift = pow(_BASE, open_[1], 1 << 64)
                i, upto = i + open_[1], upto + open_[4]
                a, b = (open_[2] + shift * a) & _MASK, (open_[3] + shift * b) & _MASK
        open_ = (conv, i, a, b, upto)
    shared = rows.sparkSession.sparkContext.broadcast(carried)

    def continued(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            number = batch.column(0).to_numpy()
            column = {n: batch.column(k).to_numpy().copy() for k, n in enumerate(names)}
            for s in np.unique(number).tolist():
                if s not in shared.value:
                    continue
                conv, n, a, b, upto = shared.value[s]
                own = np.flatnonzero((number == s) & (column["conv"] == conv))
                shift = np.uint64(pow(_BASE, n, 1 << 64))
                for name, start in (("a", a), ("b", b)):
                    column[name][own] = (column[name][own].view(np.uint64) * shift + np.uint64(start)).view(np.int64)
                column["i"][own] += n
                column["upto"][own] += upto
            factor = power(column["i"])
            for name, turn in (("a", "x"), ("b", "y")):
                column[f"before_{name}"] = (column[name].view(np.uint64) - column[turn].view(np.uint64) * factor).view(np.int64)
            yield pa.RecordBatch.from_arrays([pa.array(column[n]) for n in out], out)

    out = ["conv", "i", "x", "y", "a", "b", "before_a", "before_b", "size", "upto"]
    return slices.mapInArrow(continued, ", ".join(f"{c} long" for c in out))


def rebuilt(rows: DataFrame, span: int = 100, most: int = 6) -> tuple[DataFrame, DataFrame]:
    """(turns, conversations): each conversation c begins with the first h turns of c - c % span; h = crc32(c) % most.

    ``rows`` as ``turns`` gives them. A conversation keeps its own turns after its first h; those that are left without a
    turn are among the conversations. A beginning goes to fewer than 2 * span conversations, at most ``most`` - 1 turns each.
    """
    numbered = running(rows, "numbered").select("conv", "i", "x", "y", "size")
    conversations = stored(numbered.select("conv").distinct(), "conversations")
    h = F.crc32(F.col("conv").cast("string").cast("binary")) % most
    own = numbered.where(F.col("i") > h).select("conv", F.col("i").alias("place"), "x", "y", "size")
    heads = numbered.where(F.col("i") < most).withColumnRenamed("conv", "head")
    begun = conversations.withColumn("h", h).where("h > 0").join(heads, (F.col("conv") - F.col("conv") % span == F.col("head")) & (F.col("i") <= F.col("h")))
    return stored(own.unionByName(begun.select("conv", F.col("i").alias("place"), "x", "y", "size")), "rebuilt"), conversations


def _classes(finals: DataFrame) -> DataFrame:
    """(depth, a, b, total, rep, n, ends): equal conversations (conv, depth, a, b, total) with their smallest id and the digest of all.

    Ids sorted by range become strings of up to CHUNK_IDS ids; a class's strings then stream through one digest.
    """
    key = ["depth", "a", "b"]
    dealt = finals.repartitionByRange(*key, "conv").sortWithinPartitions(*key, "conv").select(*key, "total", "conv")

    def runs(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in sliced(batches, CHUNK_IDS):
            if batch.num_rows == 0:
                continue
            keys = np.stack([batch.column(k).to_numpy() for k in range(3)], axis=1)
            heads = np.flatnonzero(np.concatenate([[True], (keys[1:] != keys[:-1]).any(axis=1)]))
            ids = batch.column(4).to_pylist()
            bounds = [*heads.tolist(), len(ids)]
            texts = [",".join(map(str, ids[a:b])) for a, b in zip(bounds, bounds[1:])]
            taken = batch.take(pa.array(heads))
            yield pa.RecordBatch.from_arrays([*taken.columns, pa.array(np.diff(bounds)), pa.array(texts)], [*key, "total", "rep", "n", "ids"])

    kind = "depth long, a long, b long, total long, rep long, n long"
    strings = dealt.mapInArrow(runs, f"{kind}, ids string").repartition(*key).sortWithinPartitions(*key, "rep")

    def digests(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        def finished() -> pa.RecordBatch:
            done = [*zip(*((*row, sha.hexdigest()) for row, sha in closed))]
            return pa.RecordBatch.from_arrays([*(pa.array(c, pa.int64()) for c in done[:6]), pa.array(done[6])], [*key, "total", "rep", "n", "ends"])

        row, sha, closed = None, None, []
        for batch in sliced(batches, 1000):
            for *head, n, ids in zip(*(c.to_pylist() for c in batch.columns)):
                if row is not None and row[:3] == head[:3]:
                    row[5] += n
                    sha.update(b"," + ids.encode())
                    continue
                if row is not None:
                    closed.append((row, sha))
                row, sha = [*head, n], hashlib.sha256(ids.encode())
            if closed:
                yield finished()
                closed = []
        if row is not None:
            closed = [(row, sha)]
            yield finished()

    return strings.mapInArrow(digests, f"{kind}, ends string")


def peel(rep: np.ndarray, n: np.ndarray, depth: np.ndarray, rows: dict[str, np.ndarray], ends: dict[int, str], top: int) -> list[tuple]:
    """Nodes (NODE) from the greatest depth to ``top`` of classes that share a prefix of ``top`` turns.

    Class c has the smallest conversation rep[c], n[c] conversations and depth[c] turns. ``rows`` has (c, i, a, b, size) for
    each class and depth from ``top`` on. The parent of the node at ``top`` is left open.
    """
    order = np.lexsort((rows["c"], -rows["i"]))
    c, i, a, b, size = (rows[k][order] for k in ("c", "i", "a", "b", "size"))
    bounds = np.searchsorted(-i, -np.arange(i.max() + 1, top - 1, -1), "right")
    by_node: list[tuple] = []
    # survivors: the class that stands for each node below, and the sums of its subtree
    alive, kept = np.zeros(0, np.int64), np.zeros((0, 3), np.int64)
    below: list[int] = []  # places in by_node of the survivors, whose parent is found next
    for k, d in enumerate(range(int(i.max()), top - 1, -1)):
        here = slice(bounds[k], bounds[k + 1])
        ended = c[here][depth[c[here]] == d]
        who = np.concatenate([alive, ended])
        spot = bounds[k] + np.searchsorted(c[here], who)
        sums = np.concatenate([kept, np.stack([n[ended], np.zeros(len(ended), np.int64), np.zeros(len(ended), np.int64)], axis=1)])
        _, first, node = np.unique(np.stack([a[spot], b[spot]], axis=1), axis=0, return_index=True, return_inverse=True)
        node = node.ravel()
        total = np.zeros((len(first), 3), np.int64)
        np.add.at(total, node, sums)
        children = np.bincount(node[: len(alive)], minlength=len(first))
        least = np.lexsort((rep[who], node))
        stands = who[least[np.searchsorted(node[least], np.arange(len(first)))]]
        total[:, 1] = np.where(children == 0, 1, total[:, 1])
        total[:, 2] += (total[:, 0] - 1) * size[spot[first]]
        closing = dict(zip(node[len(alive) :].tolist(), ended.tolist()))
        for place, parent in zip(below, node[: len(alive)].tolist()):
            by_node[place][4] = int(rep[stands[parent]])
        below = list(range(len(by_node), len(by_node) + len(first)))
        for j, f in enumerate(first.tolist()):
            digest = ends[closing[j]] if j in closing else None
            by_node.append([d, int(a[spot[f]]), int(b[spot[f]]), int(rep[stands[j]]), None, int(total[j, 0]), int(children[j]), int(total[j, 1]), int(total[j, 2]), digest])
        alive, kept = stands, total
    return by_node


def _peeled_groups(crowded: DataFrame, top: int) -> DataFrame:
    """Nodes of depth ``top`` and more of groups of classes; rows (ga, gb, rep, n, depth, ends, i, a, b, size) of one group are few."""

    def one(group: pa.Table) -> pa.Table:
        column = {k: group.column(k).to_numpy() for k in ("rep", "n", "depth", "i", "a", "b", "size")}
        rep, first, c = np.unique(column["rep"], return_index=True, return_inverse=True)
        ends = {int(k): e for k, e in zip(c, group.column("ends").to_pylist()) if e is not None}
        nodes = peel(rep, column["n"][first], column["depth"][first], {"c": c, **{k: column[k] for k in ("i", "a", "b", "size")}}, ends, top)
        columns = list(zip(*nodes))
        return pa.table([*(pa.array(x, pa.int64()) for x in columns[:9]), pa.array(columns[9], pa.string())], [f.split()[0] for f in NODE.split(", ")])

    return crowded.groupBy("ga", "gb").applyInArrow(one, NODE)


def trie(rows: DataFrame, conversations: DataFrame, least_cut: int = LEAST_CUT, group_turns: int = GROUP_TURNS) -> DataFrame:
    """One row (NODE, without its key) for each node of the trie.

    ``rows`` as ``turns`` gives them, a written table; ``conversations`` has each id once, also those without turns.
    """
    run = running(rows, "prefixes")
    last = run.groupBy(F.col("conv").alias("of")).agg(F.max("i").alias("depth"), F.max_by(F.struct("a", "b", "upto"), "i").alias("end"))
    zero = F.lit(0).cast("long")
    finals = conversations.join(last, F.col("conv") == F.col("of"), "left").select(
        "conv", *(F.coalesce(F.col(f), zero).alias(name) for f, name in (("depth", "depth"), ("end.a", "a"), ("end.b", "b"), ("end.upto", "total")))
    )
    classes = stored(_classes(stored(finals, "finals")), "classes")
    steps = run.select(F.col("conv").alias("of"), "i", "a", "b", "before_a", "before_b", "size", "upto")
    steps = steps.join(classes.select("rep", "n", "depth", "total", "ends"), F.col("of") == F.col("rep"))
    steps = stored(steps.withColumn("ends", F.when(F.col("i") == F.col("depth"), F.col("ends"))).drop("of"), "class-turns")

    # the cut: the number of turns below each prefix of least_cut, 2 * least_cut, ... turns that several classes share
    cuts = [least_cut << k for k in range(40)]
    loads = steps.where(F.col("i").isin(cuts)).groupBy("i", "a", "b").agg(F.count("*").alias("n"), F.sum(F.col("depth") - F.col("i")).alias("turns"))
    heaviest = {r["i"]: r["turns"] for r in loads.where("n > 1").groupBy("i").agg(F.max("turns").alias("turns")).collect()}
    cut = next(c for c in cuts if heaviest.get(c, 0) <= group_turns)

    tops = steps.where(F.col("i") == cut)
    groups = tops.groupBy(F.col("a").alias("ga"), F.col("b").alias("gb")).agg(F.count("*").alias("n_classes"))
    member = tops.select(F.col("rep").alias("member"), F.col("a").alias("ta"), F.col("b").alias("tb"))
    member = stored(member.join(groups, (F.col("ta") == F.col("ga")) & (F.col("tb") == F.col("gb"))).drop("ta", "tb"), "members")
    deep = steps.where(F.col("i") >= cut).join(member, F.col("rep") == F.col("member"))
    single = deep.where("n_classes = 1").select(
        F.col("i").alias("depth"), "a", "b", F.col("rep").alias("conv_id"), F.when(F.col("i") > cut, F.col("rep")).alias("parent_conv_id"), F.col("n").alias("n_convs"),
        (F.col("i") < F.col("depth")).cast("long").alias("n_children"), F.lit(1).cast("long").alias("n_leaves"),
        ((F.col("n") - 1) * (F.col("total") - F.col("upto") + F.col("size"))).alias("saved_tokens"), "ends",
    )
    crowded = _peeled_groups(deep.where("n_classes > 1").select("ga", "gb", "rep", "n", "depth", "ends", "i", "a", "b", "size"), cut)
    below = stored(single.unionByName(crowded), "deep-nodes")

    step = F.struct("i", "a", "b", "size")
    paths = steps.where(F.col("i") <= cut).groupBy(F.col("rep").alias("of")).agg(F.sort_array(F.collect_list(step)).alias("path"))
    short = classes.where(F.col("depth") < cut).join(paths, F.col("rep") == F.col("of"), "left")
    no_path = F.array().cast(paths.schema["path"].dataType)
    short = stored(short.select("depth", F.coalesce("path", no_path).alias("path"), "rep", "n", "ends"), "short-classes")
    at_cut = below.where(F.col("depth") == cut).drop("parent_conv_id").join(paths, F.col("conv_id") == F.col("of")).drop("of", "a", "b")
    level = stored(at_cut, "level")
    levels = [level]
    for d in range(cut - 1, -1, -1):
        stripped = level.select(
            F.slice("path", 1, d).alias("path"), "conv_id", "n_convs", F.lit(1).cast("long").alias("n_children"), "n_leaves", "saved_tokens", F.lit(None).cast("string").alias("ends")
        )
        ended = short.where(F.col("depth") == d).select(
            "path", F.col("rep").alias("conv_id"), F.col("n").alias("n_convs"), zero.alias("n_children"), zero.alias("n_leaves"), zero.alias("saved_tokens"), "ends"
        )
        merged = stripped.unionByName(ended).groupBy("path").agg(
            F.min("conv_id").alias("conv_id"), F.max("ends").alias("ends"), *(F.sum(c).alias(c) for c in ("n_convs", "n_children", "n_leaves", "saved_tokens"))
        )
        size = F.col("path")[d - 1]["size"] if d else zero
        level = stored(
            merged.withColumn("depth", F.lit(d).cast("long"))
            .withColumn("n_leaves", F.when(F.col("n_children") == 0, 1).otherwise(F.col("n_leaves")))
            .withColumn("saved_tokens", F.col("saved_tokens") + (F.col("n_convs") - 1) * size),
            "level",
        )
        levels.append(level)
    names = ["conv_id", "depth", "parent_conv_id", "n_convs", "n_children", "n_leaves", "saved_tokens", "ends"]
    shallow = reduce(DataFrame.unionByName, levels)
    parents = shallow.where(F.col("depth") < cut).select(F.col("path").alias("parent_path"), F.col("conv_id").alias("parent_conv_id"))
    inner = shallow.where("depth > 0").join(parents, F.expr("slice(path, 1, size(path) - 1)") == F.col("parent_path"))
    root = levels[-1].withColumn("parent_conv_id", F.lit(None).cast("long"))
    out = inner.select(names).unionByName(root.select(names)).unionByName(below.where(F.col("depth") > cut).select(names))
    return out.withColumn("ends", F.coalesce("ends", F.lit(_EMPTY)))

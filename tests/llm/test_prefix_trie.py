"""The trie against one built turn by turn, with cuts at every depth, odd rows, and long conversations over many slices."""

import hashlib
import random
import zlib
from collections import defaultdict

import pytest

from tradewind.llm import prefix_trie
from tradewind.llm.common import stored

SCHEMA = "conv_id long, turn long, role string, text string, conv long, i int, depth string"


def by_walking(sequences):
    """Rows of the trie of {conversation: [(role, text), ...]}."""
    members = defaultdict(list)
    for conv, turns in sequences.items():
        for d in range(len(turns) + 1):
            members[tuple(turns[:d])].append(conv)
    children = defaultdict(list)
    for node in members:
        if node:
            children[node[:-1]].append(node)
    out, sums = [], {}
    for node in sorted(members, key=len, reverse=True):
        below = [sums[c] for c in children[node]]
        leaves = sum(b[0] for b in below) or 1
        saved = sum(b[1] for b in below) + ((len(members[node]) - 1) * len(node[-1][1]) if node else 0)
        sums[node] = leaves, saved
        ends = ",".join(map(str, sorted(c for c in members[node] if len(sequences[c]) == len(node))))
        parent = min(members[node[:-1]]) if node else None
        out.append((min(members[node]), len(node), parent, len(members[node]), len(children[node]), leaves, saved, hashlib.sha256(ends.encode()).hexdigest()))
    return sorted(out, key=repr)


def sequences_of(rows):
    out = defaultdict(list)
    for conv, turn, role, text in sorted((r for r in rows if r[0] is not None), key=lambda r: (r[1] is not None, r[1] or 0)):
        out[conv].append((role or "", text or ""))
    return dict(out)


def rebuilt_by_hand(sequences, span=100, most=6):
    out = {}
    for c, own in sequences.items():
        h = zlib.crc32(str(c).encode()) % most
        base = c - (abs(c) % span) * (1 if c >= 0 else -1)
        out[c] = sequences.get(base, [])[:h] + own[h:]
    return out


def found(df):
    return sorted((tuple(r) for r in df.collect()), key=repr)


def table(spark, rows):
    return spark.createDataFrame([(*r, 1, 2, "x") for r in rows], SCHEMA).repartition(3)


def plain(spark, rows, **options):
    turns = stored(prefix_trie.turns(table(spark, rows)), "turns")
    return found(prefix_trie.trie(turns, turns.select("conv").distinct(), **options))


def some_rows(seed, n=60, longest=9):
    rng = random.Random(seed)
    rows = []
    for conv in range(n):
        rows += [(conv * 7 % 64 + (conv // 3) * 64, t, rng.choice(["user", "assistant"]), rng.choice(["a", "bb", "ccc"])) for t in range(rng.randint(1, longest))]
    return rows


@pytest.mark.parametrize("least_cut,group_turns", [(1, 0), (1, 5), (2, 40), (4, 1000), (16, 1000)])
def test_equals_walking_at_every_cut(spark, least_cut, group_turns):
    rows = some_rows(least_cut) + [(5000 + k, t, "user", "same") for k in range(30) for t in range(7)]  # a large group of copies
    assert plain(spark, rows, least_cut=least_cut, group_turns=group_turns) == by_walking(sequences_of(rows))


def test_rebuilt_conversations(spark):
    rng = random.Random(9)
    ids = [*range(-3, 4), *range(95, 130), *range(250, 260), 300, 10**12, 10**12 + 5]
    rows = [(c, t, rng.choice(["u", None]), rng.choice(["x", "yy", None])) for c in ids for t in range(1 if 250 <= c < 260 else rng.randint(1, 8))]
    turns = stored(prefix_trie.turns(table(spark, rows)), "turns")
    rebuilt = rebuilt_by_hand(sequences_of(rows))
    assert any(not t for t in rebuilt.values())
    assert found(prefix_trie.trie(*prefix_trie.rebuilt(turns))) == by_walking(rebuilt)


def test_odd_rows(spark):
    rows = [(None, 1, "u", "lost"), (1, None, None, None), (1, 5, "u", "b"), (2, None, "", ""), (2, 7, "u", "b"), (3, 1, "u", "é" * 100_000), (4, 1, "u", ""), (4, 2, "u", "")]
    assert plain(spark, rows) == by_walking(sequences_of(rows))
    assert plain(spark, []) == []
    repeated = [(1, 1, "u", "x"), (1, 1, "u", "x"), (2, 1, "u", "x")]
    assert [r[:4] for r in plain(spark, repeated)] == [(1, 0, None, 2), (1, 1, 1, 2), (1, 2, 1, 1)]
    tied = [(1, 1, "u", "x"), (1, 1, "a", "y"), (2, 1, "a", "y"), (2, 1, "u", "x")]
    assert len(plain(spark, tied)) == 3  # the order of ties is the same in both


def test_long_conversations_over_many_slices(spark):
    spark.conf.set("spark.sql.shuffle.partitions", "16")
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    try:
        rows = [(c, t, "user", str(t % 50 + (c == 2 and t == 2990))) for c in (1, 2, 3) for t in range(3000 - (c == 3) * 10)]
        assert plain(spark, rows, group_turns=50_000) == by_walking(sequences_of(rows))
    finally:
        spark.conf.set("spark.sql.shuffle.partitions", "4")
        spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "true")

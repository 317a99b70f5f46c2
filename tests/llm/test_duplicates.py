"""N-gram Jaccard join, components, suffix dedup and its index."""

import hashlib
import random
import re
from itertools import combinations

import numpy as np
import pytest

from tradewind.llm import ngram_join, suffix_dedup
from tradewind.llm.components import components
from tradewind.llm.run_length_index import RunLengthIndex, suffix_array

WORDS = re.compile(r"[^\x20\x09-\x0D]+")


def sets_of(text):
    words = WORDS.findall("".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text or ""))
    return {tuple(words[i : i + 5]) for i in range(len(words) - 4)} or ({tuple(words)} if words else set())


def groups(rows):
    sets = {i: sets_of(t) for i, t in rows}
    root = {i: i for i in sets}

    def find(i):
        while root[i] != i:
            i = root[i]
        return i

    for a, b in combinations(sorted(sets), 2):
        if sets[a] and 100 * len(sets[a] & sets[b]) >= 80 * len(sets[a] | sets[b]):
            x, y = sorted((find(a), find(b)))
            root[y] = x
    return {i: (len(sets[i]), find(i)) for i in sets}


def corpus(seed):
    rng = random.Random(seed)
    word = lambda: rng.choice("abcdefghij") + rng.choice("klmnop")
    text = lambda n: [word() for _ in range(n)]
    passage, rows = text(40), [None, "", " \n ", "one two", "One TWO", "one  two three", "É b c d e", "é b c d e", "a b c d e"]
    for n in (6, 25, 60, 200):
        for _ in range(4):
            own = text(n)
            for edits in (0, 0, 1, 2, 3, n // 20, n // 10, n // 5):
                copy = list(own)
                for _ in range(edits):
                    copy[rng.randrange(len(copy))] = word()
                rows.append(" ".join(copy))
    rows += [" ".join(text(rng.randint(0, 12)) + passage + text(rng.randint(0, 12))) for _ in range(60)]  # a wide column
    base = text(80)
    for _ in range(70):  # a large group of near copies, linked in chains
        copy = list(base)
        for _ in range(rng.randint(0, 3)):
            copy[rng.randrange(80)] = word()
        rows.append(" ".join(copy))
    ids = rng.sample(range(10_000), len(rows))
    return list(zip(ids, rows))


@pytest.mark.parametrize("wide,entries", [(24, 500_000), (3, 200), (1, 1000)])
def test_groups_against_brute_force(spark, documents, monkeypatch, wide, entries):
    monkeypatch.setattr(ngram_join, "WIDE", wide)
    monkeypatch.setattr(ngram_join, "BLOCK_ENTRIES", entries)
    rows = corpus(wide)
    got = ngram_join.near_duplicates(documents(rows)).collect()
    assert {r.doc_id: (r.n_shingles, r.component_id) for r in got} == groups(rows)


def test_exact_rest_without_pivots(spark, documents, monkeypatch):
    monkeypatch.setattr(ngram_join, "WIDE", 2)
    monkeypatch.setattr(ngram_join, "PIVOTS", ())
    rows = corpus(9)
    got = ngram_join.near_duplicates(documents(rows)).collect()
    assert {r.doc_id: (r.n_shingles, r.component_id) for r in got} == groups(rows)


def test_join_of_odd_tables(spark, documents):
    assert ngram_join.near_duplicates(documents([(1, "x")]).limit(0)).count() == 0
    got = ngram_join.near_duplicates(documents([(None, "a b"), (4, "word " * 400_000), (2, "w " * 5), (2, "w " * 5), (7, None)])).collect()
    assert sorted(map(str, map(tuple, got))) == sorted(map(str, [(None, 1, None), (2, 1, 2), (2, 1, 2), (4, 1, 4), (7, 0, 7)]))


def test_components_of_chains_and_stars(spark):
    links = [(i, i + 1) for i in range(100, 160)] + [(7, i) for i in range(200, 260)] + [(7, 3), (3, 3), (5, None)]
    got = {r.node: r.label for r in components(spark.createDataFrame(links, "a long, b long")).collect()}
    assert got == {**{i: 100 for i in range(100, 161)}, **{i: 3 for i in range(200, 260)}, 7: 3, 3: 3}
    assert components(spark.createDataFrame([], "a long, b long")).count() == 0


def test_suffix_array_and_matching_statistics():
    rng = np.random.default_rng(4)
    for alphabet, n in ((2, 60), (3, 300), (1, 40), (250, 80)):
        pieces = [rng.integers(0, alphabet, rng.integers(1, n)) for _ in range(5)]
        pieces.append(np.tile(pieces[0], 3))
        text = np.concatenate([np.append(p.astype(np.int16) + 1, 0) for p in pieces])
        order = suffix_array(text)
        assert [tuple(text[i:]) for i in order] == sorted(tuple(text[i:]) for i in range(len(text)))
        index = RunLengthIndex([p + 1 for p in pieces])
        assert len(index.starts) <= len(text)
        patterns = [rng.integers(0, alphabet + 1, rng.integers(1, n)) for _ in range(8)] + [pieces[1], pieces[0][:1]]
        hay = [p.astype(np.uint8).tobytes() for p in pieces]
        for p, got in zip(patterns, index.matching_statistics([p + 1 for p in patterns])):
            raw = p.astype(np.uint8).tobytes()
            want = [max((k for k in range(1, len(raw) - i + 1) if any(raw[i : i + k] in h for h in hay)), default=0) for i in range(len(raw))]
            assert got.tolist() == want


def test_rows_with_equal_and_null_ids_are_linked_one_by_one(spark, documents):
    base, other = " ".join(f"w{i}" for i in range(60)), " ".join(f"v{i}" for i in range(60))
    rows = [(3, base), (5, base), (5, base), (5, other), (None, base + " x"), (None, other), (None, "alone"), (7, ""), (7, ""), (None, None)]
    got = sorted((str(r.doc_id), r.n_shingles, str(r.component_id)) for r in ngram_join.near_duplicates(documents(rows)).collect())
    linked = [(3, 56, 3), (5, 56, 3), (5, 56, 3), (5, 56, 5), (None, 57, 3), (None, 56, 5), (None, 1, None), (7, 0, 7), (7, 0, 7), (None, 0, None)]
    assert got == sorted((str(i), n, str(c)) for i, n, c in linked)
    stay = ngram_join.one_of_each(documents(rows))
    assert stay.columns == documents(rows).columns
    kept = sorted((str(r.doc_id), r.text or "") for r in stay.collect())
    assert kept == sorted([("3", base), ("5", other), ("None", "alone"), ("7", ""), ("7", ""), ("None", "")])


def removed(rows, length):
    seen, out = set(), {}
    for i, text in sorted(rows):
        b = (text or "").encode()
        gone = np.zeros(len(b), bool)
        for k in range(len(b) - length + 1):
            if b[k : k + length] in seen:
                gone[k : k + length] = True
            seen.add(b[k : k + length])
        kept = bytes(np.frombuffer(b, np.uint8)[~gone])
        out[i] = (len(b), int(gone.sum()), int((np.diff(gone.astype(int), prepend=0) == 1).sum()), hashlib.sha256(kept).hexdigest())
    return out


def passages(seed):
    rng = random.Random(seed)
    line = lambda n: "".join(rng.choice("abcdeé \n") for _ in range(n))
    shared = [line(n) for n in (70, 97, 99, 100, 101, 130, 300)]
    rows = [None, "", "x" * 99, "x" * 100, "x" * 500, "ab" * 300, line(150)]
    for _ in range(60):
        rows.append("".join(rng.choice([line(rng.randint(0, 80)), rng.choice(shared), rng.choice(shared)]) for _ in range(rng.randint(1, 5))))
    rows += [rows[8]] * 3 + [rows[9][:-5] + "Q" + rows[9][-5:]] + [line(400) * 2]
    return list(zip(rng.sample(range(1000), len(rows)), rows))


@pytest.mark.parametrize("crowded,chunk,block", [(512, 1 << 20, 16 << 20), (3, 150, 3000), (1, 1 << 20, 500)])
def test_removal_against_brute_force(spark, documents, monkeypatch, crowded, chunk, block):
    monkeypatch.setattr(suffix_dedup, "CROWDED", crowded)
    monkeypatch.setattr(suffix_dedup, "CHUNK", chunk)
    monkeypatch.setattr(suffix_dedup, "BLOCK_BYTES", block)
    rows = passages(crowded)
    got = suffix_dedup.deduplicate(documents(rows)).collect()
    assert {r.doc_id: (r.n_bytes, r.n_removed, r.n_spans, r.kept_sha256) for r in got} == removed(rows, 100)


def test_removal_of_rows_with_equal_and_null_ids(spark, documents):
    rng = random.Random(2)
    line = lambda n: "".join(rng.choice("abcdefgh ") for _ in range(n))
    z, v, own = line(300), line(300), line(140)
    rows = [(1, z), (2, z), (2, v), (3, z[:150] + own), (3, own + own), (4, v), (4, v), (4, v), (None, own), (None, own), (None, None), (5, "short"), (5, "short")]
    table = documents(rows)
    keyed = table.selectExpr("doc_id", "text", "xxhash64(coalesce(text, '')) as h").collect()
    order = sorted(keyed, key=lambda r: (r.doc_id is not None, r.doc_id or 0, r.h))
    want = removed([(k, r.text) for k, r in enumerate(order)], 100)
    got = suffix_dedup.deduplicate(table, keep=["lang", "label"]).collect()
    assert got[0].asDict().keys() >= {"lang", "label"}
    key = lambda i, x: (str(i), *x)
    assert sorted(key(r.doc_id, (r.n_bytes, r.n_removed, r.n_spans, r.kept_sha256)) for r in got) == sorted(key(r.doc_id, want[k]) for k, r in enumerate(order))
    with pytest.raises(ValueError):
        suffix_dedup.deduplicate(table, length=300)


def test_starts_of_long_random_texts(spark, documents):
    rng = random.Random(8)
    big = "".join(rng.choice("abcdefgh ") for _ in range(1_200_000))
    rows = [(1, big), (2, big[500_000:500_400] + "!" + big[:99])]
    got = {r.doc_id: (r.n_removed, r.kept) for r in suffix_dedup.deduplicate(documents(rows)).collect()}
    assert got == {1: (0, big), 2: (400, "!" + big[:99])}
    assert suffix_dedup.deduplicate(documents(rows).limit(0)).count() == 0
    cut = [(1, "é" * 80), (2, "xé" + "é" * 60)]  # a cut may halve a character
    got = {r.doc_id: r.kept for r in suffix_dedup.deduplicate(documents(cut)).collect()}
    assert set(got[2]) <= set("xé")

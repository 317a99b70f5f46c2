"""Byte-pair encoding against the library that defines it, merges against a word-by-word loop, decoding, odd rows."""

import hashlib
import random

import numpy as np
import pytest
from tokenizers import Tokenizer

from tradewind.llm import pair_merges
from tradewind.llm.queries import WORD_VOCABULARY, op11_pair_merges

PARTS = ["a", "b", "th", "in", "'s", "'", " ", "  ", "\n", " ", "é", "é", "́", "ß", "İ", "中", "１", "²", "<|endoftext|>", "<|", "!", "🎉", "\x1f", "\x00", "aa", "Σ"]


@pytest.fixture(scope="module")
def model():
    return pair_merges.MergeModel(WORD_VOCABULARY)


@pytest.fixture(scope="module")
def library():
    return Tokenizer.from_file(WORD_VOCABULARY)


def one_by_one(word: bytes, model) -> list[int]:
    """Merge the pair of lowest rank, the leftmost first, until none is left."""
    out = [*model.inner[list(word[:-1])], model.final[word[-1]]] if word else []
    while len(out) > 1:
        ranks = [int(r) for r in model.ranks(np.array(out[:-1]), np.array(out[1:]))]
        if max(ranks) < 0:
            break
        r, i = min((r, i) for i, r in enumerate(ranks) if r >= 0)
        out[i : i + 2] = [model.made[r]]
    return [int(x) for x in out]


def test_merges_equal_word_by_word(model):
    rng = random.Random(3)
    words = [bytes(rng.choice(b"aehinrst\xc3\xa9") for _ in range(rng.randint(0, 30))) for _ in range(400)]
    words += [b"a" * n for n in range(40)] + [b"hahahaha" * 9, b"\xff\x00"]
    ids, bounds = pair_merges.merge(words, model)
    assert [ids[a:b].tolist() for a, b in zip(bounds[:-1], bounds[1:])] == [one_by_one(w, model) for w in words]


def test_equals_library(spark, model, library, documents):
    rng = random.Random(5)
    texts = ["".join(rng.choices(PARTS, k=rng.randint(0, 40))) for _ in range(600)]
    texts += [None, "", "  \n", "x" * 70_000, "word " * 30_000, "same", "same"]
    rows = [(None if i == 7 else i % 400, t) for i, t in enumerate(texts)]
    encoded = pair_merges.encode(documents(rows), WORD_VOCABULARY, ["doc_id", "text"])
    found = sorted((r.doc_id is None, r.doc_id, r.text or "", list(r.ids), r.ids_sha256) for r in encoded.collect())
    wanted = []
    for i, t in rows:
        ids = library.encode(t or "", add_special_tokens=False).ids
        wanted.append((i is None, i, t or "", ids, hashlib.sha256(np.array(ids, "<u4").tobytes()).hexdigest()))
    assert found == sorted(wanted)
    spelled = pair_merges.decode(encoded.drop("text").withColumnRenamed("ids_sha256", "d"), WORD_VOCABULARY).collect()
    by_digest = {w[4]: library.decode(w[3], skip_special_tokens=False) for w in wanted}
    assert len(spelled) == len(rows) and all(by_digest[r.d] == r.text for r in spelled)


def test_memory_starts_anew(model, monkeypatch):
    encoder = pair_merges.Encoder(model)
    first = encoder.encode(["one two", "three"])
    monkeypatch.setattr(pair_merges, "REMEMBERED", 1)
    again = encoder.encode(["one two", "three"])
    assert [x.tolist() for x in first] == [x.tolist() for x in again] and len(encoder.words) == 6  # three besides the break and the special tokens


def test_odd_ids_and_empty_table(spark, documents):
    rows = spark.createDataFrame([(1, [320, 60_000, -4]), (2, None), (3, [])], "k long, ids array<int>")
    assert [(r.k, r.text) for r in pair_merges.decode(rows, WORD_VOCABULARY).orderBy("k").collect()] == [(1, "a</w>"), (2, None), (3, "")]
    assert pair_merges.encode(documents([]), WORD_VOCABULARY).collect() == []


def test_query_equals_library(spark, library, small):
    docs = spark.read.parquet(f"{small}/documents.parquet").select("doc_id", "text").collect()
    found = {r.doc_id: r for r in op11_pair_merges(spark, small).collect()}
    assert len(found) == len(docs)
    for row in docs:
        ids = library.encode(row.text or "", add_special_tokens=False).ids
        text = library.decode(ids, skip_special_tokens=False)
        assert found[row.doc_id].n_tokens == len(ids)
        assert found[row.doc_id].ids_sha256 == hashlib.sha256(np.array(ids, "<u4").tobytes()).hexdigest()
        assert found[row.doc_id].decoded_sha256 == hashlib.sha256(text.encode()).hexdigest()

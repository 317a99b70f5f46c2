"""Piece lattices, sampling without replacement, round trips."""

import itertools
import math
import random

import numpy as np
import pytest
import sentencepiece

from tradewind.llm import segmentation
from tradewind.llm.piece_model import PieceModel

VOCABULARY = "/opt/tokenizers/piece_bpe_32k.model"


@pytest.fixture(scope="module")
def model():
    return PieceModel(VOCABULARY)


def paths(text, model):
    """All segmentations of a short text without rare characters, with their probabilities."""
    raw = (" " + text).encode()
    spelled = {}
    for i, b in enumerate(model.bytes_of):
        if b and i not in set(model.byte_ids):
            spelled[b] = i

    def go(at):
        if at == len(raw):
            yield (), 1.0
        for end in range(at + 1, len(raw) + 1):
            piece = spelled.get(raw[at:end])
            if piece is not None and b" " not in raw[at + 1 : end].lstrip(b" "):
                for rest, p in go(end):
                    yield (piece, *rest), p * model.probability[piece]

    return dict(go(0))


def test_lattice_sums_and_samples_match_all_paths(model):
    text = "the nth"
    every = paths(text, model)
    total = sum(every.values())
    seen = {p: 0 for p in every}
    n = 4000
    for draws in segmentation.sample([text] * n, np.arange(n, dtype=np.uint64), model, 3):
        keys = [tuple(p.tolist()) for p, _, _ in draws]
        assert len(set(keys)) == 3 and all(k in every for k in keys)
        for (p, log_p, log_inclusion), k in zip(draws, keys):
            assert math.isclose(log_p, math.log(every[k]), rel_tol=1e-9) and log_inclusion <= 0
        seen[keys[0]] += 1
    likely = sorted(every, key=every.get, reverse=True)[:6]
    for k in likely:  # first draws follow the probabilities
        p = every[k] / total
        assert abs(seen[k] / n - p) < 5 * math.sqrt(p * (1 - p) / n) + 1e-9


def test_second_draws_and_inclusion(model):
    text = "of it"
    every = paths(text, model)
    total = sum(every.values())
    n = 6000
    pairs = {}
    included, estimate = dict.fromkeys(every, 0), 0.0
    for draws in segmentation.sample([text] * n, np.arange(10**6, 10**6 + n, dtype=np.uint64), model, 2):
        keys = [tuple(p.tolist()) for p, _, _ in draws]
        pairs[tuple(keys)] = pairs.get(tuple(keys), 0) + 1
        for k, (_, _, q) in zip(keys, draws):
            included[k] += 1
            estimate += every[k] / total / math.exp(q)  # Horvitz-Thompson: sums to 1 on average
    top = sorted(every, key=every.get, reverse=True)[:3]
    for a, b in itertools.permutations(top, 2):
        p = every[a] / total * every[b] / (total - every[a])
        assert abs(pairs.get((a, b), 0) / n - p) < 5 * math.sqrt(p * (1 - p) / n) + 1e-9
    assert abs(estimate / n - 1) < 0.1


def test_samples_do_not_depend_on_the_other_texts(model):
    rng = random.Random(8)
    words = ["the", "nation", "über", "x1f9", "日本語", "of", "segmentation", "", "it's"]
    texts = [" ".join(rng.choice(words) for _ in range(rng.randint(1, 300))) for _ in range(12)]
    seeds = np.arange(50, 62, dtype=np.uint64)

    def plain(draws):
        return [(p.tolist(), log_p, q) for p, log_p, q in draws]

    alone = [plain(segmentation.sample([t], seeds[i : i + 1], model, 3)[0]) for i, t in enumerate(texts)]
    for order in (range(12), rng.sample(range(12), 12), [5, 3, 5, 11]):
        among = segmentation.sample([texts[i] for i in order], seeds[list(order)], model, 3)
        assert [plain(d) for d in among] == [alone[i] for i in order]


def test_units_are_not_cut(model):
    text = " " * 15  # 48 bytes as pieces write them
    every = paths(text, model)
    total = sum(every.values())
    lattices = segmentation.Lattices(segmentation.units_of(text), model)
    assert math.isclose(lattices.log_finish[0], math.log(total), rel_tol=1e-9)
    seen, n = dict.fromkeys(every, 0), 4000
    for draws in segmentation.sample([text] * n, np.arange(n, dtype=np.uint64), model, 2):
        keys = [tuple(p.tolist()) for p, _, _ in draws]
        assert len(set(keys)) == 2 and all(math.isclose(log_p, math.log(every[k]), rel_tol=1e-9) for k, (_, log_p, _) in zip(keys, draws))
        seen[keys[0]] += 1
    for k in sorted(every, key=every.get, reverse=True)[:6]:
        p = every[k] / total
        assert abs(seen[k] / n - p) < 5 * math.sqrt(p * (1 - p) / n) + 1e-9
    assert 16 in {len(model.bytes_of[k[0]]) for k in every if len(k) == 1}


@pytest.mark.parametrize("text", ["9f86d081884c7d659a2feaa0c55ad015a3bf4f1b", "Достопримечательности" * 3, "https://example.org/path?query=" * 60, "x" * 20_000])
def test_sums_over_long_units(model, text):
    raw = b" " + text.encode()
    spelled = {b: model.probability[i] for i, b in enumerate(model.bytes_of) if b and i not in set(model.byte_ids)}
    log_sums = [0.0] + [-math.inf] * len(raw)  # over all pieces that end at a byte
    for end in range(1, len(raw) + 1):
        ways = [log_sums[a] + math.log(spelled[raw[a:end]]) for a in range(max(0, end - 48), end) if raw[a:end] in spelled and log_sums[a] > -math.inf]
        if ways:
            log_sums[end] = max(ways) + math.log(sum(math.exp(w - max(ways)) for w in ways))
    assert segmentation.units_of(text) == [text]
    lattices = segmentation.Lattices([text], model)
    assert math.isclose(lattices.log_finish[0], log_sums[-1], rel_tol=1e-9)
    [draws] = segmentation.sample([text], np.array([3], np.uint64), model)
    for pieces, log_p, _ in draws:
        assert model.decode(pieces) == text and math.isclose(log_p, np.log(model.probability[pieces]).sum(), rel_tol=1e-9)


def test_few_segmentations_give_all(model):
    [draws] = segmentation.sample([""], np.array([1], np.uint64), model, 5)
    assert [model.decode(p) for p, _, _ in draws] == [""] and len(draws[0][0]) == 1 and draws[0][2] == 0.0
    every = paths("a", model)
    [draws] = segmentation.sample(["a"], np.array([1], np.uint64), model, 50)
    assert {tuple(p.tolist()) for p, _, _ in draws} == set(every)
    assert all(q == 0.0 for _, _, q in draws)


def test_pieces_decode_as_the_library_does(model):
    library = sentencepiece.SentencePieceProcessor(model_file=VOCABULARY)
    texts = ["Hello  wörld\n x", "the of and", "  two blanks ", "日本語 text", "tab\tand ß", "x" * 300]
    for text, draws in zip(texts, segmentation.sample(texts, np.arange(len(texts), dtype=np.uint64), model)):
        for pieces, _, _ in draws:
            assert model.decode(pieces) == text == library.decode(pieces.tolist())


def test_round_trip_of_odd_texts(spark, documents, model):
    rng = random.Random(6)
    texts = ["", " ", "   ", "a▁b ▁▁", "\x00\x01", "𝄞 é́ ​", "\n\n", "end \n", "word" * 50_000, "é" * 3000, " ".join("ab" for _ in range(60_000))]
    texts += ["".join(rng.choice("ab ▁é𝄞\n\t") for _ in range(rng.randint(0, 80))) for _ in range(100)]
    rows = [(1000, None), *enumerate(texts), (0, "")]
    encoded = segmentation.encode(documents(rows), VOCABULARY)
    back = segmentation.decode(encoded, VOCABULARY).collect()
    want = dict(enumerate(texts)) | {1000: ""}
    assert {r.doc_id for r in back} == set(want)
    assert all(r.text == want[r.doc_id] for r in back)
    by_sample = {}
    for r in encoded.collect():
        by_sample.setdefault(r.doc_id, set()).add((r.sample, tuple(r.pieces)))
    assert all(len({p for _, p in v}) == len(v) for v in by_sample.values())
    again = {(r.doc_id, r.sample): r.pieces for r in segmentation.encode(documents(rows), VOCABULARY).collect()}
    assert again == {(r.doc_id, r.sample): r.pieces for r in encoded.collect()}
    assert segmentation.encode(documents(rows).limit(0), VOCABULARY).count() == 0


def test_memory_of_a_task_is_bounded(model):
    import tracemalloc

    rng = random.Random(5)
    texts = [" ".join("".join(rng.choices("abcdefghijklmnop", k=rng.randint(2, 9))) for _ in range(400)) for _ in range(400)]
    seeds = np.arange(len(texts), dtype=np.uint64)
    segmentation.sample(texts[:2], seeds[:2], model)
    tracemalloc.start()
    for a, b in segmentation._chunks(texts):
        segmentation.sample(texts[a:b], seeds[a:b], model)
    peak = tracemalloc.get_traced_memory()[1]
    tracemalloc.stop()
    assert peak < 120_000_000

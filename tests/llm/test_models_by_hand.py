"""Language codes, document statistics and labels against plain loops over the definitions."""

import math
import random
from collections import Counter

import numpy as np
import pytest
import regex
from pyspark.sql import functions as F

from tradewind.llm import language_id, quality_model, toxicity
from tradewind.llm.common import packed

SAMPLES = {
    "en": ["the cat sat on the mat", "of the and to in", "This is that! 12"],
    "fr": ["le chat est sur la table", "les ÉTÉS sont où", "que qui dans des"],
    "de": ["die Katze sitzt auf der Matte", "über größe und das"],
    "es": ["el gato está en la mesa", "que los las niño"],
}
CELLS = 1 << 9


def cells_of(text):
    """Byte trigrams of lower-cased letters and single blanks, two blanks at the end."""
    folded = regex.sub(r"[^\pL]+", " ", text.lower()).encode() + b"  "
    return [((int.from_bytes(folded[i : i + 3], "big") * 2654435761 % 2**32) >> 16) & (CELLS - 1) for i in range(len(folded) - 2)], len(folded)


def fitted(samples):
    langs = sorted(samples)
    code = language_id.codewords(len(langs))
    counts = {lang: Counter(c for t in texts for c in cells_of(t)[0]) for lang, texts in samples.items()}
    floor = 0.5 / sum(n for c in counts.values() for n in c.values())
    share = {lang: np.array([c[k] / c.total() for k in range(CELLS)]) for lang, c in counts.items()}
    ratios = np.zeros((CELLS, code.shape[1]))
    for bit in range(code.shape[1]):
        yes = [share[lang] for i, lang in enumerate(langs) if code[i, bit] > 0]
        no = [share[lang] for i, lang in enumerate(langs) if code[i, bit] < 0]
        ratios[:, bit] = [max(-6, min(6, math.log((sum(y) / len(yes) + floor) / (sum(n) / len(no) + floor)))) for y, n in zip(zip(*yes), zip(*no))]
    own = [[sum(share[lang][k] * ratios[k, bit] for k in range(CELLS)) * code[i, bit] for i, lang in enumerate(langs)] for bit in range(code.shape[1])]
    weights = np.array([max(min(m), 0.01) for m in own])
    return langs, code, ratios, weights / weights.sum()


def decoded(text, langs, code, ratios, weights):
    cells, width = cells_of(text)
    margins = [sum(ratios[c, bit] for c in cells) / width for bit in range(code.shape[1])]
    losses = [sum(w * math.log1p(math.exp(-4 * m * s)) for w, m, s in zip(weights, margins, row)) for row in code]
    best = min(range(len(langs)), key=lambda i: losses[i])
    score = 1 / sum(math.exp(-8 * (x - losses[best])) for x in losses)
    lead = sorted(losses)[1] - losses[best]
    return langs[best], score, lead < language_id.AMBIGUOUS


def test_language_codes_by_hand(spark):
    rows = [(t, lang) for lang, texts in SAMPLES.items() for t in texts]
    model = language_id.fit(spark.createDataFrame(rows, "text string, lang string").repartition(3), n_cells=CELLS)
    langs, code, ratios, weights = fitted(SAMPLES)
    assert model.langs == langs
    assert np.abs(model.ratios - ratios).max() < 1e-5 and np.abs(model.weights - weights).max() < 1e-6
    texts = ["the cat", "le chat", "größe und", "el niño", "THE the ÉTÉ", "a", "über 12 the 34 la", "x" * 3000] + [" ".join(random.Random(k).choices(sum(SAMPLES.values(), []), k=3)) for k in range(20)]
    got = {r.text: r for r in language_id.predict(spark.createDataFrame([(t,) for t in texts], "text string").repartition(3), model).collect()}
    for text in texts:
        lang, score, ambiguous = decoded(text, langs, code, ratios, weights)
        assert (got[text].lang_pred, got[text].ambiguous) == (lang, ambiguous)
        assert got[text].score == pytest.approx(score, abs=1e-4)


BLANK = " \t\n\r\x0b\x0c"


def by_hand(text):
    data = (text or "").encode()
    size = max(len(data), 1)
    share = lambda kinds: sum(bytes([b]) in kinds for b in data) / size
    of = lambda characters: {bytes([c]) for c in characters}
    words = [w for w in regex.split(rb"[ \t\n\r\x0b\x0c]+", data) if w]
    lengths = [len(w) for w in words]
    mean = sum(lengths) / max(len(words), 1)
    spread = math.sqrt(max(sum(n * n for n in lengths) / max(len(words), 1) - mean**2, 0))
    lines = [x for x in data.split(b"\n") if x]
    copies = Counter(words)
    return {
        "log_bytes": math.log1p(len(data)), "log_words": math.log1p(len(words)), "mean_word": mean, "sd_word": spread,
        "upper": share(of(range(65, 91))), "digit": share(of(b"0123456789")), "symbol": share(of(b"#*$%&<>@^~\\/=+_{}[]")),
        "punctuation": share(of(b".,;:?'\"()-")), "high_bytes": share(of(range(128, 256))), "bar": share(of(b"|")), "bang": share(of(b"!")),
        "distinct_words": len(copies) / len(words) if words else 0, "repeat_lines": 1 - len(set(lines)) / len(lines) if lines else 0,
        "mean_line": math.log1p(len(data) / len(lines)) if lines else 0, "space": share(of(BLANK.encode())),
        "top_word": max(copies.values()) / len(words) if words else 0,
    }


def test_statistics_by_hand():
    import pyarrow as pa

    rng = random.Random(4)
    texts = [None, "", "a", "a b a", "x\nx\ny\n", "\n\n", "É| !\n# 12", "one line\none line\nanother"]
    texts += ["".join(rng.choice("ab É1|!.#\n ") for _ in range(rng.randint(1, 80))) for _ in range(60)]
    got = quality_model.statistics(*packed(pa.array(texts, pa.string())))
    for text, row in zip(texts, got):
        wanted = by_hand(text)
        assert {k: pytest.approx(v, abs=1e-6) for k, v in wanted.items()} == dict(zip(quality_model.STATISTICS, row.tolist()))


def test_conflicting_labels_and_repeated_ids(spark):
    stats = spark.createDataFrame([(k % 40, [float(k % 2)] + [0.0] * 15) for k in range(80)], "id long, x array<double>")
    labels = [(k, k % 2) for k in range(40)]
    one = quality_model.fit(stats, spark.createDataFrame(labels, "id long, label int"))
    both = quality_model.fit(stats, spark.createDataFrame(labels + [(k, 0) for k in range(1, 40, 2)] + [(3, None), (4, 7)], "id long, label int").repartition(5))
    for part in ("base", "feature", "cut", "left"):  # the largest label counts
        assert np.array_equal(getattr(one, part), getattr(both, part))
    docs = [(k % 60, ("vile scum rotten " if k % 3 == 0 else "kind fine good ") * 6 + str(k // 60)) for k in range(120)]
    table = lambda rows: spark.createDataFrame(rows, "doc_id long, text string")
    toxic = spark.createDataFrame([(k, int(k % 3 == 0)) for k in range(60)] + [(0, 0), (3, 0)], "id long, label int")
    models = [toxicity.fit(table(rows).repartition(n), toxic) for rows, n in ((docs, 2), (docs[::-1], 5))]
    scores = [sorted(tuple(r) for r in toxicity.predict(table(docs[:60]), m).select("id", F.round("score", 9)).collect()) for m in models]
    assert scores[0] == scores[1]
    assert all((s > 0.5) == (i % 3 == 0) for i, s in scores[0])

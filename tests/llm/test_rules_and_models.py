"""Quality rules, language codes, boosted trees, toxicity."""

import random
import re
import zlib
from collections import Counter

import numpy as np
import pytest
from pyspark.sql import functions as F

from tradewind.llm import language_id, quality_model, quality_rules, toxicity

SF = "/root/testdata/sf0.01"
WORDS = re.compile(r"[^\x20\x09-\x0D]+")


def base(text):
    words = WORDS.findall(text or "")
    grams = [tuple(words[i : i + 3]) for i in range(len(words) - 2)]
    twice = {g for g, n in Counter(grams).items() if n > 1}
    covered = {j for i, g in enumerate(grams) if g in twice for j in (i, i + 1, i + 2)}
    lines = [x for x in (text or "").split("\n") if WORDS.search(x)]
    return len(words), sum(map(len, words)), sum(c in "#*$%&|<>" for c in text or ""), len(lines) - len(set(lines)), len(covered)


def test_base_counts_against_brute_force(spark, documents):
    rng = random.Random(1)
    texts = [None, "", " \n\t", "a", "a b", "a a a a", "x\n\nx\n x\nx", "é|é #*", "\x1c\xa0 b", "a b c d a b c", "w " * 5000]
    texts += [" ".join(rng.choice("abcd") for _ in range(rng.randint(1, 60))) for _ in range(60)]
    texts += ["\n".join(rng.choice(["l m", "n", ""]) for _ in range(20)) for _ in range(5)]
    got = quality_rules.counted(documents(list(enumerate(texts)))).drop("cells").collect()
    assert {r[0]: tuple(r)[1:] for r in got} == {i: base(t) for i, t in enumerate(texts)}


def test_quality_rules_without_trusted_rows_or_rows(spark, documents):
    docs = documents([(1, "word " * 60), (2, " ".join(f"w{i}" for i in range(60))), (2, " ".join(f"w{i}" for i in range(60))), (3, None)])
    none = spark.createDataFrame([], "doc_id long")
    got = sorted(tuple(r) for r in quality_rules.quality_rules(docs, none).select("doc_id", "base_failed", "kept", "llr_sum").collect())
    assert got == [(1, True, False, 0), (2, False, True, 0), (2, False, True, 0), (3, True, False, 0)]
    assert quality_rules.quality_rules(docs.limit(0), none).count() == 0


def test_all_trusted_documents_count(spark):
    docs = spark.range(30_000).selectExpr("id as doc_id", "if(id < 25000, 'aaa', 'bbb') as text")
    got = {r.cell: r.weight for r in quality_rules.log_ratios(quality_rules.counted(docs), docs.where("doc_id < 25000").select("doc_id")).collect()}
    cell = lambda text: zlib.crc32(text.encode()) % quality_rules.CELLS - quality_rules.CELLS // 2
    share = lambda n, total: (n + 1) / (total + quality_rules.CELLS)
    weight = lambda t, r: round(1e6 * np.log(share(t, 25_000) / share(r, 30_000)))
    assert got == {cell(" aaa"): weight(25_000, 25_000), cell(" bbb"): weight(0, 5_000)}


def test_ratio_separates_junk(spark):
    docs, labels = (spark.read.parquet(f"{SF}/{t}.parquet") for t in ("documents", "labels"))
    kept = quality_rules.quality_rules(docs, labels.where("quality = 1").select("doc_id")).join(labels, "doc_id").where("not base_failed")
    assert kept.where("quality = 1 and not kept").count() == 0
    assert kept.where("quality = 0 and kept").count() == 0


def test_repeated_and_null_ids_are_judged_row_by_row(spark, documents):
    one, two = " ".join(f"w{i}" for i in range(60)), " ".join(f"v{i}" for i in range(70))
    rows = [(1, one), (1, two), (None, one), (None, two), (None, None), (2, one), (3, "é x " * 40)]
    got = quality_rules.quality_rules(documents(rows), spark.createDataFrame([(1,), (1,), (None,)], "doc_id long"))
    cells = [[zlib.crc32(f"{a[-3:]} {b[-3:]}".encode()) % quality_rules.CELLS for a, b in zip(["", *w], w)] for w in (WORDS.findall(t or "") for _, t in rows)]
    raw, trusted = Counter(c for own in cells for c in own), Counter(c for (i, _), own in zip(rows, cells) if i == 1 for c in own)
    share = lambda counts, c: (counts[c] + 1) / (counts.total() + quality_rules.CELLS)
    scores = [sum(round(1e6 * (np.log(share(trusted, c)) - np.log(share(raw, c)))) for c in own) for own in cells]
    failed = [base(t)[0] < 50 or base(t)[4] * 2 > base(t)[0] for _, t in rows]
    wanted = [(i or 0, len(own), s, not f and s >= quality_rules.THRESHOLD * len(own)) for (i, _), own, s, f in zip(rows, cells, scores, failed)]
    assert sorted((r.doc_id or 0, r.n_words, r.llr_sum, r.kept) for r in got.collect()) == sorted(wanted)


def test_filters_do_not_blow_up_the_plan(spark, documents):
    got = quality_rules.quality_rules(documents([(1, "a b c " * 30)]), spark.createDataFrame([(1,)], "doc_id long"))
    size = lambda df: len(df._jdf.queryExecution().optimizedPlan().toString())
    for condition in ("kept", "not base_failed", "kept and n_words > 3 and n_repeat_words < 5"):
        assert size(got.where(condition)) < 2 * size(got)


@pytest.mark.parametrize("n", [1, 2, 3, 4, 5, 9, 40])
def test_codewords_differ(n):
    code = language_id.codewords(n)
    assert len({tuple(r) for r in code}) == n and set(np.unique(code)) <= {-1.0, 1.0}


def test_language_of_held_out_documents(spark, documents):
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    held = F.crc32(F.col("doc_id").cast("string").cast("binary")) % 3 == 1
    model = language_id.fit(docs.where(~held))
    got = language_id.predict(docs.where(held), model)
    assert got.where("lang = lang_pred").count() >= 0.98 * got.count()
    assert got.where("score < 0 or score > 1").count() == 0
    odd = language_id.predict(documents([(1, None), (2, ""), (3, "12 ²!"), (4, "the of and the"), (4, "the of and the"), (5, "the " * 200_000)]), model)
    assert {r.doc_id: r.lang_pred for r in odd.collect()} == {1: "und", 2: "und", 3: "und", 4: "en", 5: "en"}
    assert odd.columns == ["doc_id", "text", "lang", "source", "n_chars", "id", "n", "label", "lang_pred", "score", "ambiguous"]
    assert language_id.predict(docs.limit(0), model).count() == 0


def test_language_without_training_rows(spark, documents):
    docs = documents([(1, "abc"), (2, None)])
    assert {r.lang_pred for r in language_id.predict(docs, language_id.fit(docs.limit(0))).collect()} == {"und"}
    assert {r.lang_pred for r in language_id.predict(docs, language_id.fit(docs)).collect()} == {"und", "en"}


def test_flat_trees_equal_recursive_ones():
    rng = np.random.default_rng(0)
    x = rng.normal(size=(400, 16))
    y = ((x[:, 0] > 0) ^ (x[:, 3] > 0.5)).astype(float)
    model = quality_model.grow(x, y, rounds=20)

    def value(node, row):
        return model.value[node] if model.left[node] < 0 else value(model.left[node] + int(row[model.feature[node]] > model.cut[node]), row)

    by_hand = [model.base + sum(value(r, row) for r in model.roots) for row in x]
    assert np.allclose(model.margins(x), by_hand)
    assert ((model.scores(x) > 0.5) == (y > 0.5)).mean() > 0.95


def test_quality_of_held_out_documents(spark, documents):
    docs, labels = (spark.read.parquet(f"{SF}/{t}.parquet") for t in ("documents", "labels"))
    stats = quality_model.document_statistics(docs)
    labels = labels.select(F.col("doc_id").alias("id"), F.col("quality").alias("label"))
    held = F.crc32(F.col("id").cast("string").cast("binary")) % 4 == 2
    model = quality_model.fit(stats, labels.where(~held))
    got = quality_model.predict(stats, model).join(labels.where(held), "id")
    assert got.where((F.col("score") >= 0.7) == (F.col("label") == 1)).count() >= 0.95 * got.count()
    odd = quality_model.predict(quality_model.document_statistics(documents([(1, None), (2, ""), (3, "a"), (3, "a"), (4, "b c\n" * 300_000)])), model).collect()
    assert sorted(r.id for r in odd) == [1, 2, 3, 3, 4] and all(0 <= r.score <= 1 for r in odd)
    none = quality_model.fit(stats, labels.limit(0))
    assert {r.score for r in quality_model.predict(stats, none).collect()} == {0.5}
    assert quality_model.predict(quality_model.document_statistics(docs.limit(0)), model).count() == 0


def distance(a, b):
    row = list(range(len(b) + 1))
    for i, x in enumerate(a, 1):
        row, last = [i], row
        for j, y in enumerate(b, 1):
            row.append(min(last[j] + 1, row[-1] + 1, last[j - 1] + (x != y)))
    return row[-1]


def test_automaton_against_edit_distances():
    rng = random.Random(3)
    terms = [("banana", False), ("bandit", False), ("cab", False), ("nasty", True)]
    automaton = toxicity.Automaton(terms)
    words = {"".join(rng.choice("abcdintsyx") for _ in range(rng.randint(1, 8))) for _ in range(500)}
    for term, _ in terms:
        words |= {term, term + "s", term[1:], term[:3] + "x" + term[3:], term[:2] + "é" + term[3:], term + "xyz", "x" + term}
    words = sorted(words)
    rows, found, edits, *_ = automaton.find(words)
    got = {words[r]: (int(e)) for r, e in zip(rows, edits)}

    def nearest(word):
        best = []
        for term, stem in terms:
            d = min(distance(word[:n], term) for n in range(len(word) + 1)) if stem else distance(word, term)
            if d == 0 or d == 1 and len(term) >= toxicity.FUZZY_LENGTH:
                best.append(d)
        return min(best, default=None)

    assert got == {w: nearest(w) for w in words if nearest(w) is not None}


def test_quotation_is_told_from_abuse():
    automaton = toxicity.Automaton([("moron", False)])
    texts = ["you moron go", 'he said "you moron" and', 'a "quote" far ' + "w " * 20 + "moron", "moron", '"moron"', ""]
    rows, _, _, quoted, *_ = automaton.find(texts)
    assert dict(zip(rows.tolist(), quoted.tolist())) == {0: False, 1: True, 2: False, 3: False, 4: True}


def test_terms_of_all_scripts_and_lengths(spark, documents):
    terms = ["придурок", "ηλίθιος", "احمق", "笨蛋", "ass", "x" * 30]
    automaton = toxicity.Automaton([(t, False) for t in sorted(terms)])
    texts = ["ты придурок да", "ты придурак да", "о ηλίθιος", "يا احمق", "他 笨蛋 😀", "an ass", "an asse", "x" * 30, "другой 好 λόγος"]
    rows, _, edits, *_ = automaton.find(texts)
    assert dict(zip(rows.tolist(), edits.tolist())) == {0: 0, 1: 1, 2: 0, 3: 0, 4: 0, 5: 0, 7: 0}
    extra = ["q" + "".join(chr(97 + (i // 26**k) % 26) for k in range(3)) for i in range(250)]
    rows = [(40 * k + i, f"plain {t} text{i}") for k, t in enumerate(terms + extra) for i in range(20)]
    clean = [(10**6 + i, f"plain text{i} {'other' * (i % 3)}") for i in range(len(rows))]
    docs = documents(rows + clean)
    labels = docs.selectExpr("doc_id as id", "int(doc_id < 1000000) as label")
    model = toxicity.fit(docs, labels)
    assert {t for t, stem in model.automaton.terms if not stem} >= set(terms)
    got = {r.id: r.score for r in toxicity.predict(docs, model).collect()}
    assert all(got[i] > 0.5 for i, _ in rows) and all(got[i] < 0.5 for i, _ in clean)


def test_toxicity_of_held_out_documents(spark, documents):
    docs, labels = (spark.read.parquet(f"/root/testdata/sf0.1/{t}.parquet") for t in ("documents", "labels"))
    labels = labels.select(F.col("doc_id").alias("id"), F.col("toxic").alias("label"))
    held = F.crc32(F.col("id").cast("string").cast("binary")) % 5 == 0
    model = toxicity.fit(docs, labels.where(~held))
    got = toxicity.predict(docs, model).join(labels.where(held), "id")
    assert got.where((F.col("score") >= 0.5) == (F.col("label") == 1)).count() >= 0.95 * got.count()
    odd = documents([(1, None), (2, ""), (3, "You IDIOT"), (3, "You IDIOT"), (4, "you idiott and pathettic moron"), (5, "plain " * 300_000), (6, 'they called it "pathetic"')])
    score = {r.id: r.score for r in toxicity.predict(odd, model).collect()}
    assert score[3] > 0.5 and score[4] > 0.5 and score[1] == score[2] == score[5] < 0.5 and score[6] < 0.5
    none = toxicity.predict(odd, toxicity.fit(docs, labels.limit(0)))
    assert {r.score for r in none.collect()} == {0.5}
    assert toxicity.predict(docs.limit(0), model).count() == 0


def test_folds_are_those_of_zlib(spark):
    from tradewind.llm.common import bucket_of_id

    rows = spark.range(50).select("id", bucket_of_id("id", 3).alias("k")).collect()
    assert [r.k for r in rows] == [zlib.crc32(str(r.id).encode()) % 3 for r in rows]

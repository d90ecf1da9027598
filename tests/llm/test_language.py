import math
import random
from collections import Counter

import numpy as np
import pytest
import regex
from pyspark.sql import functions as F

from corpusmill.llm import language
from corpusmill.llm.common import Stages

SCHEMA = "doc_id long, text string, lang string"


def table(spark, rows):
    return spark.createDataFrame([(i, t, lang) for i, (t, lang) in enumerate(rows)], SCHEMA)


def trained(spark, rows, **limits):
    return language.train(table(spark, rows), F.lit(True), Stages(spark, "t"), language.Limits(**limits))


def brute(rows, texts, sizes=5):
    """[(language, probability)] by the definition, with everything in the model."""
    words = lambda t: regex.findall(r"\p{L}[\p{L}\p{M}]{0,63}", (t or "").lower())
    counts = {}
    for text, lang in rows:
        if lang is not None:
            counts.setdefault(lang, Counter()).update(words(text))
    counts = {k: v for k, v in counts.items() if v}
    grams = lambda w, n: [f" {w} "[i:i + n] for i in range(len(w) + 3 - n)]
    tables = {0: counts}
    for n in range(1, sizes + 1):
        tables[n] = {lang: sum((Counter({g: 0 for g in grams(w, n)}) + Counter(grams(w, n) * k) for w, k in own.items()), Counter())
                     for lang, own in counts.items()}
    total = {n: {lang: sum(c.values()) for lang, c in t.items()} for n, t in tables.items()}

    def value(n, entry, lang):
        k = tables[n][lang][entry]
        return math.log(k / total[n][lang]) if k else math.log(0.5 / max(total[n].values()))

    def word(w, lang):
        for n, entries in ((0, [w]), *((n, grams(w, n)) for n in range(sizes, 0, -1))):
            known = [e for e in entries if any(tables[n][x][e] for x in counts)]
            if known:
                return sum(value(n, e, lang) for e in known) / len(known)
        return 0.0

    every, out = sum(total[0].values()), []
    for t in texts:
        if not words(t):
            out.append(("und", 0.0))
            continue
        s = {lang: math.log(total[0][lang] / every) + sum(word(w, lang) for w in words(t)) for lang in counts}
        best = min(s, key=lambda lang: (-s[lang], -total[0][lang], lang))
        out.append((best, 1 / sum(math.exp(x - s[best]) for x in s.values())))
    return out


ROWS = [("the cat and the dog", "en"), ("a cat sat on the mat", "en"), ("le chat et le chien", "fr"), ("un chat noir", "fr"),
        ("die katze und der hund", "de"), (None, "de"), ("no language here", None), ("", "es"), ("123", "es"), ("Ñandú ñ", "es")]
TEXTS = ["the dog", "chien noir", "katzen", "hundert", "catlike", "zzz qqq", "漢字", "a", "", None, "12 34 !?", "Le CHAT", "ñ" * 200,
         "x" * 5000, "́ é", "dog chien hund der"]


def test_equals_the_definition(spark):
    model = trained(spark, ROWS)
    rows = language.predict(table(spark, [(t, "x") for t in TEXTS]), model).orderBy("doc_id").collect()
    for r, text, (lang, share) in zip(rows, TEXTS, brute(ROWS, TEXTS), strict=True):
        assert r.lang_pred == lang, text
        assert r.score == pytest.approx(share, rel=1e-4), text


def test_backs_off_word_by_word(spark):
    scorer = language.Scorer(trained(spark, ROWS, sizes=3))
    known = scorer.model.places
    assert "cat" in known[0] and "cab" not in known[0] and "cab" not in known[3]
    assert np.allclose(scorer.back_off("cab"), scorer.model.row(known[3][" ca"]))  # one n-gram of three is known, and no shorter one counts
    assert np.allclose(scorer.back_off("漢"), scorer.model.row(known[1][" "]))


def test_limits_keep_the_most_frequent(spark):
    model = trained(spark, [("a a a b b c d " * 3, "x"), ("e e f", "y")], words=4, grams=20, sizes=1)
    assert set(model.places[0]) == {"a", "b", "e", "f"}  # of c and d, equally frequent, neither fits
    assert model.languages == ["x", "y"]
    assert trained(spark, ROWS, languages=1).languages == ["en"]


def test_cached_words_turn_over(spark):
    model = trained(spark, ROWS)
    texts = [" ".join(random.Random(k).choices("cat chatte hundin ñame zz".split(), k=5)) for k in range(30)]
    plain = language.Scorer(model).score(texts)[0]
    turning = language.Scorer(model, cached=1)
    assert np.array_equal(np.concatenate([turning.score(texts[k:k + 3])[0] for k in range(0, 30, 3)]), plain)


def test_nothing_learned_and_empty(spark):
    none = trained(spark, [("text", None), (None, "en")])
    rows = language.predict(table(spark, [("text", None), (None, None)]), none).collect()
    assert [(r.lang_pred, r.score) for r in rows] == [("und", 0.0)] * 2
    assert trained(spark, []).languages == []
    assert language.predict(table(spark, []), trained(spark, ROWS)).collect() == []


def test_other_columns_pass_through_and_rows_repeat(spark):
    df = spark.createDataFrame([(None, "the cat", 5.0, "row", "w")] * 2, "doc_id long, text string, score double, row string, word string")
    rows = language.predict(df, trained(spark, ROWS)).collect()
    assert len(rows) == 2 and rows[0] == rows[1] and rows[0].lang_pred == "en"
    assert rows[0].row == "row" and rows[0].word == "w" and rows[0].score != 5.0


def test_held_out_accuracy(spark, small):
    from corpusmill.llm.queries import QUERIES
    rows = {r.doc_id: r for r in QUERIES["op12_language_id"](spark, small).collect()}
    docs = spark.read.parquet(f"{small}/documents.parquet").collect()
    assert len(rows) == len(docs)
    held = [(rows[d.doc_id].lang_pred, d.lang) for d in docs if rows[d.doc_id].held_out]
    assert len(held) > 40 and sum(a == b for a, b in held) >= 0.97 * len(held)
    assert all(0 <= r.score <= 1 for r in rows.values())

import re
import unicodedata
import zlib
from collections import defaultdict

import numpy as np
import pytest

from lograft.llm import language, queries
from lograft.llm.language import UNKNOWN, fit_languages, identify_languages, ngrams
from tests.conftest import SF01


def plain_ngrams(text):
    """Distinct letter triples of words, with an underscore at their ends, or None."""
    text = text or ""
    if not any(c.isalpha() for c in text):
        return None
    word = lambda c: unicodedata.category(c)[0] in "LM"
    low = "".join((c.lower() if len(c.lower()) == 1 else c) if word(c) else " " for c in text)
    return {f"_{w}_"[i:i + 3] for w in low.split() for i in range(len(w))}


def plain_model(rows, share, part):
    """Exact sets per language, languages by documents."""
    docs, counts = defaultdict(int), defaultdict(lambda: defaultdict(int))
    for text, lang in rows:
        grams = plain_ngrams(text) if lang is not None else None
        if grams is None:
            continue
        docs[lang] += 1
        for g in grams:
            counts[g][lang] += 1
    held = defaultdict(set)
    for g, by in counts.items():
        top = max(n / docs[lang] for lang, n in by.items())
        for lang, n in by.items():
            if n / docs[lang] >= share and n / docs[lang] >= top * part:
                held[lang].add(g)
    return sorted(docs, key=lambda x: (-docs[x], x)), held


def plain_identify(text, languages, held):
    grams = plain_ngrams(text)
    if grams is None or not languages:
        return UNKNOWN, 0.0
    counts = [len(grams & held[lang]) for lang in languages]
    best = max(range(len(counts)), key=lambda i: (counts[i], -i))
    second = max([c for i, c in enumerate(counts) if i != best], default=0)
    return languages[best], counts[best] / (counts[best] + second) if counts[best] else 0.0


def packed(gram):
    a, b, c = (0 if x == "_" else ord(x) for x in gram)
    return a << 42 | b << 21 | c


TEXTS = ["The cat sat.", "ÄPFEL und Birnen", "x", "a1b2", "", None, "12 + 3", "́", "क्या है", "İstanbul", "ẞ ß", "naïve—déjà", "漢字かな", "àb c"]


@pytest.mark.parametrize("piece", [1, 2, 3, 7, 1 << 18])
def test_ngrams_equal_plain_ones_in_pieces(monkeypatch, piece):
    monkeypatch.setattr(language, "PIECE", piece)
    for text in TEXTS:
        want, got = plain_ngrams(text), ngrams(text)
        assert (got is None) == (want is None), text
        if want is not None:
            assert sorted(map(packed, want)) == got.tolist()


def test_very_long_texts():
    text = "abc déf " * 400_000
    assert ngrams(text).tolist() == ngrams("abc déf").tolist()
    assert ngrams("z" * 1_000_000).tolist() == sorted(map(packed, ["_zz", "zzz", "zz_"]))


def rows(n=40):
    words = {"aa": ["lala", "mulo", "rami", "nolu"], "bb": ["krst", "grst", "plnk", "rami"], "cc": ["öäü", "ßöä", "mulo"]}
    out = []
    for i in range(n):
        for lang, mine in words.items():
            out.append((" ".join(mine[(i * k) % len(mine)] for k in range(1, 6)), lang))
    return out + [("lala mulo", None), (None, "aa"), ("", "bb"), ("123", "dd")]


def test_model_equals_exact_sets(spark):
    df = spark.createDataFrame([(t, l, 1, "x") for t, l in rows()], "text string, lang string, gram int, score string")
    model = fit_languages(df.repartition(5))
    languages, held = plain_model(rows(), language.SHARE, language.PART)
    assert model.languages == languages == ["aa", "bb", "cc"]
    for i, lang in enumerate(languages):
        inside = np.array(sorted(map(packed, held[lang])), np.int64)
        assert model.counts(inside)[i] == pytest.approx(len(inside))  # no false negatives, few cells set
    found = identify_languages(df, model)
    assert found.columns == ["text", "lang", "gram", "lang_pred", "score"]
    for r in found.collect():
        lang, score = plain_identify(r.text, languages, held)
        assert r.lang_pred == lang and r.score == pytest.approx(score, abs=0.01)


def test_full_filters_are_corrected(spark):
    """With few cells most answers are chance hits: counts stay near the exact ones."""
    df = spark.read.parquet(f"{SF01}/documents.parquet").select("text", "lang")
    train = [tuple(r) for r in df.collect()]
    languages, held = plain_model(train, language.SHARE, language.PART)
    model = fit_languages(df, cells=1 << 14)
    assert max(model.chance) > 0.01
    for text, _ in train[:60]:
        grams = ngrams(text)
        if grams is not None and len(grams) > 100:
            exact = [len(plain_ngrams(text) & held[lang]) for lang in languages]
            assert np.abs(model.counts(grams) - exact).max() < 0.12 * len(grams)


def test_more_languages_than_a_mask_has_bits(spark):
    letters = "abcdefghijklmnopqrstuvwxyz"
    many = [(f"{letters[i % 26]}{letters[i // 26]}q{letters[(i * 7) % 26]} ", f"l{i:03}") for i in range(130)]
    df = spark.createDataFrame(many, "text string, lang string")
    model = fit_languages(df)
    assert model.masks.shape[0] == 3 and len(model.languages) == 130
    assert [(r.text, r.lang_pred) for r in identify_languages(df, model).collect()] == many


def test_odd_rows(spark):
    none = spark.createDataFrame([], "doc_id long, text string, lang string")
    model = fit_languages(none)
    df = spark.createDataFrame([(1, "some text", "aa"), (1, "some text", "aa"), (None, None, None), (2, "§ 5", "aa")], none.schema)
    assert [(r.lang_pred, r.score) for r in identify_languages(df, model).collect()] == [(UNKNOWN, 0.0)] * 4
    assert identify_languages(none, model).collect() == []
    model = fit_languages(df)
    got = identify_languages(df.union(spark.createDataFrame([(9, "zzzz", None)], none.schema)), model, keep=["doc_id"]).collect()
    assert sorted(map(repr, map(tuple, got))) == sorted(map(repr, [(1, "aa", 1.0), (1, "aa", 1.0), (None, UNKNOWN, 0.0), (2, UNKNOWN, 0.0), (9, "aa", 0.0)]))


def test_query_held_out_accuracy_and_brute_force(spark):
    docs = spark.read.parquet(f"{SF01}/documents.parquet").select("doc_id", "text", "lang").collect()
    fold = lambda i: zlib.crc32(str(i).encode()) % 5 == 0
    languages, held = plain_model([(r.text, r.lang) for r in docs if not fold(r.doc_id)], language.SHARE, language.PART)
    got = queries.op13_language_id(spark, SF01)
    assert got.columns == ["doc_id", "held_out", "lang_pred", "score"]
    got = {r.doc_id: r for r in got.collect()}
    assert len(got) == len(docs)
    right = [got[r.doc_id].lang_pred == r.lang for r in docs if fold(r.doc_id) and r.lang and re.search("[^\\W\\d_]", r.text or "")]
    assert len(right) > 150 and sum(right) / len(right) > 0.98
    for r in docs:
        assert got[r.doc_id].held_out == fold(r.doc_id) and 0 <= got[r.doc_id].score <= 1
        lang, score = plain_identify(r.text, languages, held)
        assert got[r.doc_id].lang_pred == lang and abs(got[r.doc_id].score - score) < 0.02

"""Near-dedup and language stages of the pipeline on odd rows."""

import random

import pytest
from test_llm_queries import slow_components, slow_fingerprint

import corpus_pipeline

COLUMNS = "doc_id long, text string, lang string, source string, n_chars long"


def near_copies(spark, rows, columns=COLUMNS):
    docs = spark.createDataFrame([(d, t, "en", "x", 0, *more) for d, t, *more in rows], columns)
    return corpus_pipeline.near_copies(spark, docs, "").collect()


@pytest.mark.parametrize("seed", [1, 2])
def test_one_of_each_component_by_brute_force(spark, seed):
    """Families of edits of long texts: exact copies, chains of near ones, and texts near to none."""
    rng = random.Random(seed)
    texts = {}
    for family in range(3):
        base = [f"f{family}w{i}" for i in range(1500)]
        for _ in range(40):
            copy = list(base)
            for at in rng.sample(range(len(base)), rng.randrange(4)):
                copy[at] = f"new{rng.randrange(40)}"
            texts[len(texts)] = " ".join(copy)
    texts |= {500: "", 501: None, 502: "few words", 503: "FEW  words", 504: "few"}
    codes = {d: slow_fingerprint(t or "") for d, t in texts.items()}
    roots = slow_components(codes)
    got = {r.doc_id for r in near_copies(spark, texts.items())}
    assert got == {d for d, root in roots.items() if d == root}
    assert 3 < len(got) < len(texts) / 2


def test_ties_nulls_and_clashing_names(spark):
    long = [f"w{i}" for i in range(300)]
    other = [f"v{i}" for i in range(300)]
    rows = [
        (7, " ".join(long), 1), (7, " ".join(other), 2), (7, " ".join(other), 2), (9, " ".join(long), 3),
        (None, " ".join(long), 4), (None, "lone text of its own kind", 5), (None, "lone text of its own kind", 5),
        (None, "quite another lone text here", 6),
    ]
    got = near_copies(spark, rows, f"{COLUMNS}, stay_id long")
    assert sorted((r.doc_id or 0, r.stay_id) for r in got) == [(0, 5), (0, 6), (7, 1), (7, 2)]


def test_language_stage_without_a_model(spark):
    texts = [(i, f"plain sentence number {i}", None, "x", 1) for i in range(20)]
    docs = spark.createDataFrame([*texts, (99, "12 34", None, "x", 1), (98, None, None, "x", 1)], COLUMNS)
    got = corpus_pipeline.language(spark, docs, "").collect()
    assert {r.doc_id for r in got} == set(range(20)) and all(r.lang is None for r in got)


def test_language_stage_fills_labels(spark):
    en = "the quick brown fox and the lazy dog of the house"
    de = "der schnelle braune fuchs und der faule hund des hauses"
    rows = [(i, f"{de if i % 2 else en} {i}", None if i > 80 else ("de" if i % 2 else "en"), "x", 1) for i in range(90)]
    got = corpus_pipeline.language(spark, spark.createDataFrame(rows, COLUMNS), "").collect()
    assert {r.doc_id: r.lang for r in got} == {i: "de" if i % 2 else "en" for i in range(90)}


def test_decoding_by_brute_force_and_what_does_not_fit():
    """Losses summed bit by bit; a text whose bits contradict every codeword does not fit."""
    import numpy as np
    import pandas as pd

    from reelpress.llm import language_id as L

    rng = np.random.default_rng(3)
    code = L.codewords(4)
    trust = rng.random(code.shape)
    trust /= trust.sum(axis=1, keepdims=True)
    model = L.Model(list("abcd"), code, rng.normal(0, 9, (L.FEATURES, code.shape[1])), np.zeros(code.shape[1]), trust)
    letters = L.letter_table()
    texts = ["some words of a text", "Другой текст", "x", "12", None, ""]
    told = L._tell(pd.Series(texts, dtype=object), letters, model)
    for text, (lang, score, ambiguous, fits) in zip(texts, told.itertuples(index=False), strict=True):
        x = None if text is None else L.features(text, letters)
        if x is None:
            assert (lang, score, bool(fits)) == (L.UNKNOWN, 0.0, False)
            continue
        margins = x @ model.weights
        losses = [
            sum(trust[c, b] * np.log1p(np.exp(-margins[b] * code[c, b])) for b in range(code.shape[1]))
            for c in range(4)
        ]
        order = sorted(range(4), key=losses.__getitem__)
        assert lang == "abcd"[order[0]] and bool(fits) == (losses[order[0]] < L.MAX_LOSS)
        assert bool(ambiguous) == (losses[order[1]] - losses[order[0]] < L.MARGIN)
        assert abs(score - 1 / sum(np.exp(-2 * (l - losses[order[0]])) for l in losses)) < 1e-6


def test_more_labels_than_are_learned(spark, monkeypatch):
    from reelpress.llm import language_id as L

    monkeypatch.setattr(L, "MAX_LANGUAGES", 2)
    rows = [(i, f"{'ab' if i % 3 else 'cd'} words {'ef' * (i % 3)}", "p" if i % 3 else "q" if i % 2 else "r", "x", 1) for i in range(60)]
    model = L.train(spark.createDataFrame(rows + [(99, "lone", "zz", "x", 1)], COLUMNS))
    assert model.languages == ["p", "q"]

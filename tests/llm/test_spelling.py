"""Spelling variants against brute force."""

import os
import random
import re
import zlib
from collections import Counter, defaultdict

import pytest

from reelpress.llm import spelling
from reelpress.llm.queries import QUERIES

FOLDER = os.environ.get("TEST_SF_DIR", "/root/testdata/sf0.001")


def slow_words(docs, min_length=7, min_count=2, every=31):
    counts = Counter()
    for doc, text in docs:
        for run in re.findall("[A-Za-zÀ-ÿ]+", text or ""):
            run = re.sub("[A-Z]", lambda m: m[0].lower(), run)
            code = zlib.crc32(f"{'' if doc is None else doc}:{run}".encode())
            if code % every == 0:
                at = code % len(run)
                run = run[:at] + run[at + 1 :]
            counts[run] += 1
    return {w: n for w, n in counts.items() if len(w) >= min_length and n >= min_count}


def slow_near(words):
    """By what is left when one letter is taken out, compared exactly."""
    shared = defaultdict(set)
    for w in words:
        for v in {w, *(w[:i] + w[i + 1 :] for i in range(len(w)))}:
            shared[v].add(w)

    def one_edit(a, b):
        if len(a) > len(b):
            a, b = b, a
        i = 0
        while i < len(a) and a[i] == b[i]:
            i += 1
        return a != b and (a[i + 1 :] == b[i + 1 :] if len(a) == len(b) else len(a) + 1 == len(b) and a[i:] == b[i + 1 :])

    near = defaultdict(set)
    for group in shared.values():
        for a in group:
            near[a] |= {b for b in group if one_edit(a, b)}
    return near


def slow_forms(docs, ratio=10, **options):
    words = slow_words(docs, **options)
    near = slow_near(words)
    form = {}
    for w, n in words.items():
        best = min(near[w], key=lambda v: (-words[v], v), default=None)
        if best and words[best] >= ratio * n:
            form[w] = best

    def root(w):
        while w in form:
            w = form[w]
        return w

    return {
        w: (form.get(w), root(w), n, len(near[w]), words[form[w]] if w in form else None) for w, n in words.items()
    }


def rows_of(df):
    rows = df.collect()
    made = {r.word: (r.form, r.root, r.n, r.n_near, r.form_n) for r in rows}
    assert len(made) == len(rows)
    return made


def test_query_by_brute_force(spark):
    docs = [(r.doc_id, r.text) for r in spark.read.parquet(f"{FOLDER}/documents.parquet").collect()]
    got = rows_of(QUERIES["op12_spelling_variants"](spark, FOLDER))
    assert got == slow_forms(docs)
    assert any(f for f, *_ in got.values()) and max(x[3] for x in got.values()) > 1


@pytest.mark.parametrize("seed", [1, 2])
def test_few_letters_and_all_edits(spark, frame, seed):
    """Words of two letters are near to many others, at every place; some are longer than the levels."""
    rng = random.Random(seed)
    words = ["".join(rng.choices("aé", k=rng.randrange(7, 13))) for _ in range(300)]
    for size in (39, 40, 41, 60, 200):
        base = "".join(rng.choices("abc", k=size))
        words += [base, base[1:], base[:-1], base[: size // 2] + "x" + base[size // 2 :], base[:5] + "z" + base[6:], base[:5] + "y" + base[6:]]
    docs = [(i, " ".join(rng.choices(words, k=400))) for i in range(12)]
    docs.append((99, " ".join(words)))
    got = rows_of(spelling.spelling_forms(frame(docs)))
    assert got == slow_forms(docs)


def test_odd_rows(spark, frame):
    chain = "abcdefgh " * 300 + "abcdefgx " * 30 + "abcdefyx " * 2 + "ABCDEFYX " + "abcdezzz abcdezzz"
    docs = [(1, chain), (1, chain), (None, "nullnull nullnull"), (2, None), (3, ""), (4, "a" * 50_000 + " b " + "a" * 50_000)]
    want = slow_forms([d for d in docs if d[0] != 4])
    got = rows_of(spelling.spelling_forms(frame(docs[:-1])))
    assert got == want
    assert {w: r for w, (_, r, *_) in got.items()}["abcdefyx"] == "abcdefgh"
    assert spelling.spelling_forms(frame([])).count() == 0
    clash = frame([(1, "letters letters")]).selectExpr("*", "1 AS word", "2 AS n", "3 AS root")
    assert set(rows_of(spelling.spelling_forms(clash))) <= {"letters", "lettrs", "etters"}


def test_long_runs_are_linear(spark, frame):
    run = "ab" * 3000
    docs = [(i, f"{run} {run[:-1]}x {run[1:]}") for i in (1, 2)]
    got = rows_of(spelling.spelling_forms(frame(docs), every=1 << 40))
    assert {w: x[3] for w, x in got.items()} == {run: 2, f"{run[:-1]}x": 1, run[1:]: 1}


def test_portions_do_not_cut_words(monkeypatch):
    text = "Some words, and more words of Élan; " * 50
    whole = [w for part in spelling.runs(text) for w in part]
    monkeypatch.setattr(spelling, "PORTION", 7)
    assert [w for part in spelling.runs(text) for w in part] == whole

"""The pipeline's rows against a plain computation of its stages."""

import re
from collections import defaultdict

import pytest
from test_llm_queries import check_pieces, slow_components, slow_fingerprint

import corpus_pipeline
from reelpress.llm import line_dedup, quality

FOLDER = "/root/testdata/sf0.001"
BLANKS = " \t\n\x0b\x0c\r"
COLUMNS = "doc_id long, text string, lang string, source string, n_chars long"


def words_of(text):
    return re.findall(r"[^\x20\x09-\x0D]+", text)


def line_fails(line):
    words, solid = words_of(line), "".join(words_of(line))
    if not words:
        return False
    symbols = len(re.findall(quality.ODD_SYMBOLS, solid))
    bars = len(re.findall(quality.SEPARATORS, solid))
    marks = len(re.findall(quality.MARKED_WORD, line))
    loud = len(words) >= quality.MIN_SHOUT and any(c.isupper() for c in line) and not any(c.islower() for c in line)
    return (
        symbols > quality.MAX_SYMBOLS * len(solid)
        or 2 * marks > len(words)
        or loud
        or (bars >= 3 and 3 * bars >= len(words))
        or any(p in line.lower() for p in quality.BOILERPLATE)
    )


def passes(text):
    words = words_of(text)
    places = defaultdict(list)
    for i in range(len(words) - 4):
        places[tuple(words[i : i + 5])].append(i)
    again = {i + k for at in places.values() if len(at) > 1 for i in at for k in range(5)}
    good = [line for line in text.split("\n") if not line_fails(line)]
    left = sum(len(w) for line in good for w in words_of(line))
    ok = len(words) >= 10 and 100 * len(again) <= 20 * len(words)
    return "\n".join(good) if ok and 1 - left / len("".join(words)) <= quality.MAX_LOST else None


def small_letters(text):
    return re.sub("[A-Z]", lambda m: m[0].lower(), text)


def slow_pipeline(docs):
    docs = {d: t for d, text in docs.items() if (t := passes(text or "")) is not None}
    docs = {d: t for d, t in docs.items() if any(c.isalpha() for c in t)}
    holders = defaultdict(set)
    key = lambda line: small_letters(line.strip(BLANKS))
    for d, t in docs.items():
        for line in t.split("\n"):
            holders[key(line)].add(d)
    gone = lambda d, line: len(k := key(line)) >= 10 and len(holders[k]) > 1 and min(holders[k]) != d
    cut = {d: [x for x in t.split("\n") if not gone(d, x)] for d, t in docs.items()}
    docs = {d: "\n".join(x) for d, x in cut.items() if "\n".join(x) or len(x) == len(docs[d].split("\n"))}
    roots = slow_components({d: slow_fingerprint(t) for d, t in docs.items()})
    return {d: t for d, t in docs.items() if roots[d] == d}


def test_pipeline_by_brute_force(spark):
    from test_llm_queries import crc
    from tokenizers import Tokenizer
    import public_tokenizers

    docs = {r.doc_id: r.text for r in spark.read.parquet(f"{FOLDER}/documents.parquet").collect()}
    rows = corpus_pipeline.run(spark, FOLDER)
    pieces = [
        r.asDict() | {"ids_crc32": crc(memoryview(r.ids).cast("B").cast("I").tolist())} for r in rows.collect()
    ]
    tokenizer = Tokenizer.from_file(public_tokenizers.path("byte_bpe_50k.json"))
    want = {
        d: tokenizer.encode(t, add_special_tokens=False).ids + [0] for d, t in slow_pipeline(docs).items()
    }
    assert 0 < len(want) < len(docs)
    from types import SimpleNamespace

    check_pieces([SimpleNamespace(**p) for p in pieces], want)


def test_stages_keep_columns_and_stand_odd_rows(spark, tmp_path):
    good = "This is a plain sentence of some ten or more words"
    rows = [
        (1, f"{good} one.", "en", "a", 1, "x"), (1, f"{good} one.", "en", "a", 1, "x"),
        (2, None, None, None, None, None), (3, "", "en", "a", 0, "x"), (None, f"{good} two.", "en", "a", 5, "x"),
        (4, f"{good} three.\nhome | about | us | more", "en", "a", 9, "x"), (5, "1 2 3 4 5 6 7 8 9 10 11", "en", "a", 3, "x"),
        (6, f"{good} one.", "en", "b", 1, "x"),
    ]
    docs = spark.createDataFrame(rows, f"{COLUMNS}, kept string")
    for number, (_, stage) in enumerate(corpus_pipeline.STAGES):
        made = stage(spark, docs, FOLDER)
        if number < 4:
            assert made.columns == docs.columns and made.schema["n_chars"].dataType == docs.schema["n_chars"].dataType
        made.write.parquet(str(tmp_path / str(number)))
        docs = spark.read.parquet(str(tmp_path / str(number)))
        if number == 3:
            left = sorted(((r.doc_id or 0), r.text, r.n_chars, r.kept) for r in docs.collect())
            assert [x[0] for x in left] == [0, 1, 4]
            assert left[2][1:] == (f"{good} three.", len(good) + 7, "x")


@pytest.mark.parametrize("name", [name for name, _ in corpus_pipeline.STAGES])
def test_stages_of_nothing(spark, name):
    empty = spark.createDataFrame([], COLUMNS)
    assert dict(corpus_pipeline.STAGES)[name](spark, empty, FOLDER).count() == 0


def test_keys_are_short_lines_apart():
    assert line_dedup.RESULT[0] == "kept_text"

"""Nulls, empty and very long texts, ties, repeated rows, empty tables and clashing column names."""

import hashlib
import random
import zlib
from functools import cache

import numpy as np
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from reelpress.llm import (
    byte_bpe,
    chat,
    components,
    exact_dedup,
    language_id,
    line_dedup,
    packing,
    quality,
    simhash,
    token_output,
    url_filter,
)

RULES = [
    ("net", "/", "block"),
    ("example.net", "/en/", "allow"),
    ("example.com", "/de/", "block"),
    ("org", "/fr", "allow"),
    ("same.org", "", "allow"),
    ("same.org", "", "block"),
]
URLS = [
    "http://A.Example.NET/en/1?x=/de/",
    "http://example.net/EN/1",
    "https://net/",
    "https://net",
    "https://planet/x",
    "http://x.example.com/de/y#z",
    "http://x.example.com/de",
    "http://q.org/french",
    "http://a.same.org",
    "http://a..net/x",
    "no scheme",
    "",
    None,
    "http://q.org/french",
]


def by_text(rows, key="doc_id"):
    return {r[key]: r for r in rows}


# --- 1 url filter


@pytest.mark.parametrize("most", [1000, 0])
def test_urls_by_trie_and_by_join(spark, most):
    pages = spark.createDataFrame(
        [(i, u, "mine") for i, u in enumerate(URLS)], "page_id long, url string, Verdict string"
    )
    rows = by_text(url_filter.judge_urls(pages, RULES, max_trie_rules=most).collect(), "page_id")
    assert [rows[i].rule for i in range(len(URLS))] == [
        "example.net/en/", "net/", "net/", None, None, "example.com/de/", None, "org/fr",
        "same.org", "net/", None, None, None, "org/fr",
    ]
    assert [rows[i].verdict for i in (0, 1, 3, 5, 7, 8, 10, 12)] == [
        "allow", "block", "allow", "block", "allow", "block", "allow", "allow",
    ]
    assert (rows[10].host, rows[10].path, rows[12].host) == ("", "", "")
    assert set(rows[0].asDict()) == {"page_id", "url", "host", "path", "rule", "verdict"}


def test_rules_from_a_table_and_no_pages(spark):
    rules = spark.createDataFrame(RULES, "host string, path string, verdict string")
    pages = spark.createDataFrame([(1, URLS[0])], "page_id long, url string")
    assert url_filter.judge_urls(pages, rules).first().rule == "example.net/en/"
    assert url_filter.judge_urls(pages.where("false"), rules).count() == 0


def test_trie_against_all_rules():
    rng = random.Random(5)
    hosts = [".".join(rng.choices(["a", "b", "c"], k=rng.randint(1, 3))) for _ in range(40)]
    paths = ["", "/", "/a", "/a/", "/a/b", "/b/a/"]
    rules = list({(rng.choice(hosts), rng.choice(paths)): rng.choice(["allow", "block"]) for _ in range(60)}.items())
    rules = [(h, p, v) for (h, p), v in rules]
    trie = url_filter.build_trie(rules)
    for _ in range(500):
        host, path = rng.choice(hosts), rng.choice([*paths, "/ab/c", "/a/bc"])
        fits = [
            (len(h) + len(p), len(h), h + p, v)
            for h, p, v in rules
            if (host == h or host.endswith("." + h)) and path.startswith(p)
        ]
        assert url_filter.look_up(trie, host, path) == (max(fits)[2:] if fits else None)


# --- 2 byte-level BPE


def test_bpe_of_odd_texts(spark, frame):
    texts = [None, "", " ", "\n\n  x", "naïve 東京 🙂🙂", "a" * 5000, "<|endoftext|>", "x\x00y", "ab " * 3000]
    docs = frame([(i, t, "mine") for i, t in enumerate(texts)], "doc_id long, text string, IDS string")
    docs = docs.unionByName(docs.limit(3))
    rows = byte_bpe.decode(byte_bpe.encode(docs, common_words=5)).collect()
    assert len(rows) == len(texts) + 3
    library = reference_bpe()
    for r in rows:
        text = texts[r.doc_id] or ""
        assert r.ids == library.encode_ordinary(text)
        assert bytes(r.decoded).decode() == text
    assert byte_bpe.encode(docs.where("false")).count() == 0
    clash = frame([(1, "a b")], "doc_id long, ids string")
    assert byte_bpe.encode(clash, "ids").columns == ["doc_id", "ids"]
    lists = spark.createDataFrame([(1, [64, 65]), (2, None), (3, [])], "n int, decoded array<int>")
    got = {r.n: r.decoded for r in byte_bpe.decode(lists, "decoded").collect()}
    assert got == {1: b"ab", 2: None, 3: b""}


@cache
def reference_bpe():
    import base64

    import public_tokenizers
    import tiktoken

    with open(public_tokenizers.path("byte_bpe_50k.tiktoken"), "rb") as lines:
        ranks = {base64.b64decode(a): int(b) for a, b in map(bytes.split, lines)}
    return tiktoken.Encoding(
        "own", pat_str=public_tokenizers.PATTERN, mergeable_ranks=ranks, special_tokens={}
    )


@settings(max_examples=200, deadline=None)
@given(st.text(alphabet="abcdeinorst", min_size=1, max_size=90))
def test_long_merges_are_the_library_s(word):
    library = reference_bpe()
    ids = library.encode_ordinary(word)
    for merge in (byte_bpe.merge_word, byte_bpe.merge_long):
        assert merge(word.encode(), library._mergeable_ranks) == ids


def test_the_fold_is_the_library_s(spark):
    rng = random.Random(2)
    words = ["".join(rng.choices("abcdeéinorst ß東", k=rng.randint(1, 20))) for _ in range(300)] + ["the", " and"]
    ranks = reference_bpe()._mergeable_ranks
    table = byte_bpe.rank_map(ranks)
    rows = spark.createDataFrame([(w,) for w in words], "w string").select(
        "w", byte_bpe.fold_merges(F.col("w"), table).alias("ids")
    )
    assert all(r.ids == reference_bpe()._core_bpe.encode_single_piece(r.w.encode()) for r in rows.collect())


# --- 3 SimHash


def test_simhash_edges(spark, frame):
    long = " ".join(f"word{i}" for i in range(200_000))
    rows = [(1, None), (2, ""), (3, " \n"), (4, "one"), (5, "ONE"), (6, "one two"), (7, long),
            (8, long + " more"), (9, "one"), (9, "one"), (None, "one")]
    docs = frame([(i, t, "x") for i, t in rows], "doc_id long, text string, fingerprint string")
    got = simhash.near_duplicates(docs).collect()
    assert len(got) == len(rows)
    roots = {r.doc_id: r.component_id for r in got}
    assert roots == {1: 1, 2: 1, 3: 1, 4: 4, 5: 4, 6: 6, 7: 7, 8: 7, 9: 4, None: 4}
    assert {r.fingerprint for r in got if r.doc_id in (1, 2, 3)} == {"0" * 16}
    assert simhash.near_duplicates(docs.where("false")).count() == 0


@pytest.mark.parametrize(("prefix", "most"), [(8, 4000), (12, 50), (32, 50)])
def test_links_of_dense_fingerprints(spark, monkeypatch, prefix, most):
    rng = random.Random(prefix)
    codes = set()
    for _ in range(30):
        code = rng.getrandbits(64)
        for _ in range(30):
            for _ in range(rng.randrange(5)):
                code ^= 1 << rng.randrange(64)
            codes.add(code)
    monkeypatch.setattr(simhash, "prefix_bits", lambda n: prefix)
    monkeypatch.setattr(simhash._portions, "__defaults__", (most,))
    values = np.array(sorted(codes), np.uint64)
    table = spark.createDataFrame([(c,) for c in values.view(np.int64).tolist()], "code long")
    links = simhash.fingerprint_links(table, len(codes))
    roots = {r.node: r.root for r in components.connected(links).collect()}
    mine = {c: roots.get(c, c) for c in values.view(np.int64).tolist()}
    for at in range(len(values)):
        near = np.bitwise_count(values ^ values[at]) <= 3
        assert {mine[c] for c in values[near].view(np.int64).tolist()} == {mine[int(values[at : at + 1].view(np.int64)[0])]}
    assert all(
        (int(r.a) ^ int(r.b)) & (2**64 - 1) != 0 and ((int(r.a) ^ int(r.b)) & (2**64 - 1)).bit_count() <= 3
        for r in links.collect()
    )


def test_components_of_a_long_chain(spark):
    edges = spark.range(300).select(F.col("id").alias("a"), (F.col("id") + 1).alias("b"))
    edges = edges.unionByName(edges.limit(5)).unionByName(
        spark.createDataFrame([(1000, 1001), (1002, 1001), (5, 5)], "a long, b long")
    )
    roots = {r.node: r.root for r in components.connected(edges).collect()}
    assert len({roots[i] for i in range(301)}) == 1
    assert roots[1000] == roots[1001] == roots[1002] != roots[0]
    assert components.connected(edges.where("false")).count() == 0


# --- 4 line dedup


def test_lines_edges(spark, frame):
    shared = "A line that is shared"
    rows = [
        (3, f"own three words\n{shared}\n\t{shared.upper()} \nend"),
        (1, f"{shared}\n{shared}"),
        (2, shared),
        (4, None),
        (5, ""),
        (6, "short\n\n\n"),
        (7, "short\n\n\n"),
        (8, "\n".join(f"line number {i} of eight" for i in range(50_000))),
        (None, f"{shared}\nlast but one"),
    ]
    docs = frame([(i, t, "x") for i, t in rows], "doc_id long, text string, n_lines string")
    got = by_text(line_dedup.dedup_lines(docs).collect())
    assert {k: v.kept_text for k, v in got.items()} == {
        3: "own three words\nend", 1: f"{shared}\n{shared}", 2: "", 4: "", 5: "",
        6: "short\n\n\n", 7: "short\n\n\n", 8: rows[7][1], None: "last but one",
    }
    assert {k: (v.n_lines, v.n_dropped) for k, v in got.items()} == {
        3: (4, 2), 1: (2, 0), 2: (1, 1), 4: (1, 0), 5: (1, 0), 6: (4, 0), 7: (4, 0),
        8: (50_000, 0), None: (2, 1),
    }
    assert line_dedup.dedup_lines(docs.where("false")).count() == 0


def test_lines_need_enough_documents(spark, frame):
    docs = frame([(i, "twice it is\nand three times" if i < 3 else "and three times\nfour words or so") for i in (1, 2, 3)])
    got = by_text(line_dedup.dedup_lines(docs, min_docs=3).collect())
    assert [got[i].n_dropped for i in (1, 2, 3)] == [0, 1, 1]


def test_repeated_rows_are_one_document(spark, frame):
    docs = frame([(1, "the very same line")] * 2 + [(2, "another line here"), (2, "the very same line")])
    got = sorted((r.doc_id, r.kept_text) for r in line_dedup.dedup_lines(docs).collect())
    assert got == [(1, "the very same line")] * 2 + [(2, ""), (2, "another line here")]


# --- 5 and 10 packing


def test_differencing_is_a_partition():
    rng = random.Random(3)
    for k in (1, 2, 7, 40):
        sizes = [rng.randint(1, 256) for _ in range(10 * k)]
        groups = packing.difference(sizes, k)
        assert sorted(i for g in groups for i in g) == list(range(len(sizes)))
        sums = [sum(sizes[i] for i in g) for g in groups]
        assert len(groups) == k and max(sums) - min(sums) <= 256
    assert packing.difference([], 3) == []


def test_windows_rise_until_none_is_too_full():
    sizes = [200] * 11  # 2200 ids need three windows of 1024, since five fit in one
    groups = packing.fill_windows(sizes)
    assert len(groups) == 3 and max(len(g) for g in groups) <= 5
    assert packing.fill_windows([]) == []
    assert packing.fill_windows([1024, 1024]) in ([[0], [1]], [[1], [0]])


def test_pieces_of_odd_documents(spark, frame):
    rows = [(1, None), (2, ""), (None, "no id"), (3, "word " * 5000), (4, "x"), (4, "x")]
    got = packing.pack_documents(
        frame([(i, t, 0) for i, t in rows], "doc_id long, text string, offset int")
    ).collect()
    assert sorted(r.doc_tokens for r in got if r.doc_id in (1, 2)) == [1, 1]
    assert sum(r.length for r in got if r.doc_id == 3) == next(r.doc_tokens for r in got if r.doc_id == 3)
    assert len([r for r in got if r.doc_id == 4]) == 2 and any(r.doc_id is None for r in got)
    assert packing.pack_documents(frame([])).count() == 0


def test_best_fit_takes_the_tightest_row():
    assert sorted(map(sorted, token_output.best_fit([6, 5, 4, 3, 2], 10))) == [[0, 2], [1, 3, 4]]
    rng = random.Random(1)
    sizes = [rng.randint(1, 100) for _ in range(500)]
    rows = token_output.best_fit(sizes, 100)
    assert sorted(i for r in rows for i in r) == list(range(500))
    assert max(sum(sizes[i] for i in r) for r in rows) <= 100
    assert len(rows) <= 1.25 * sum(sizes) / 100
    assert token_output.best_fit([], 10) == []


def test_matrix_rows(spark, frame, tmp_path):
    docs = frame([(1, "word " * 5000), (2, None), (None, "x y z"), (3, "a b"), (3, "a b")])
    packed = token_output.packed_rows(docs, width=512)
    token_output.write_matrix(packed, str(tmp_path / "out"))
    rows = spark.read.parquet(str(tmp_path / "out")).collect()
    assert sum(r.n_tokens for r in rows) == sum(r.cu_seqlens[-1] for r in rows)
    for r in rows:
        ids, positions = np.frombuffer(r.ids, "<u4"), np.frombuffer(r.positions, "<i4")
        assert len(ids) == len(positions) == 512
        assert all(ids[b - 1] == 0 for d, b in zip(r.doc_ids, r.cu_seqlens[1:], strict=True) if d == 2)
        for a, b in zip(r.cu_seqlens, r.cu_seqlens[1:], strict=False):
            assert positions[a:b].tolist() == list(range(b - a))
        assert not ids[r.n_tokens :].any() and not positions[r.n_tokens :].any()
    assert sum(d == 3 for r in rows for d in r.doc_ids) == 2
    assert token_output.packed_rows(docs.where("false")).count() == 0


# --- 6 language ID


def test_codewords_are_apart():
    for n in (2, 4, 7, 12):
        code = language_id.codewords(n)
        assert set(np.unique(code)) <= {-1, 1}
        apart = min((code[i] != code[j]).sum() for i in range(n) for j in range(i))
        assert apart >= (1 if n == 2 else code.shape[1] / 4)


def test_language_edges(spark, frame):
    words = {"aa": "alpha beta gamma delta", "bb": "uno dos tres cuatro", "cc": "ichi ni san shi"}
    rows = [(i, f"{words[lang]} " * 3, lang) for i, lang in enumerate(list(words) * 20)]
    rows += [(100, None, "aa"), (101, "123 !?", "bb"), (102, "", None), (103, "uno dos", None), (None, "ichi ni", "cc")]
    rows += [(103, "uno dos", None), (104, "gamma delta " * 200_000, None)]
    docs = frame([(*r, "mine") for r in rows], "doc_id long, text string, lang string, Score string")
    got = language_id.identify(docs).collect()
    told = {r.doc_id: r.lang_pred for r in got}
    assert len(got) == len(rows)
    assert [told[i] for i in (100, 101, 102, 103, None, 104)] == ["und", "und", "und", "bb", "cc", "aa"]
    assert all(told[i] == rows[i][2] for i in range(60))
    assert all(0 <= r.score <= 1 for r in got)
    assert {r.lang_pred for r in language_id.identify(docs.withColumn("lang", F.lit(None).cast("string"))).collect()} == {"und"}
    assert language_id.identify(docs.where("false")).count() == 0


def test_blocks_do_not_change_features(monkeypatch):
    letters = language_id.letter_table()
    text = "Où est la bibliothèque? " * 50
    whole = language_id.features(text, letters)
    monkeypatch.setattr(language_id, "BLOCK", 97)
    assert np.abs(language_id.features(text, letters) - whole).max() < 0.02


def test_held_out_rule(spark, frame):
    rows = frame([(i, "") for i in (0, 7, 123456)] + [(None, "")]).select("doc_id", language_id.held_out().alias("h")).collect()
    assert [r.h for r in rows] == [zlib.crc32(str(r.doc_id).encode()) % 3 == 1 if r.doc_id is not None else False for r in rows]


# --- 7 quality


def test_quality_edges(spark, frame):
    good = "This is a plain sentence of some ten or more words, and it goes on for quite a while."
    rows = [
        (1, None), (2, ""), (3, "few words only"), (4, good),
        (5, f"{good}\nhome | about | contact | help\nAll Rights Reserved by us"),
        (6, "BUY!! NOW!! " * 10), (7, "same five words in here " * 10), (8, good),
        (9, f"{good}\n{good}\n \n \n"), (10, "a# b$ c% d& " * 5),
        (11, " ".join(f"w{i}" for i in range(300_000))), (12, "WHY IS ALL THIS IN CAPITALS AND SO VERY LOUD HERE"),
    ]
    docs = frame([(i, t, "x") for i, t in rows], "doc_id long, text string, KEPT string")
    got = by_text(quality.apply_rules(docs).collect())
    assert {k for k, r in got.items() if r.kept} == {4, 5, 8, 11}
    assert got[5].clean_text == good and 0 < got[5].lost_share < 0.5
    assert (got[1].n_words, got[1].base_failed, got[1].clean_text) == (0, True, "")
    assert (got[9].n_dup_lines, got[9].n_repeat_words) == (1, 2 * len(good.split()))
    assert got[7].n_repeat_words == 50 and got[7].base_failed
    assert (got[10].n_symbols, got[10].word_chars) == (20, 40)
    assert got[11].n_repeat_words == 0 and got[11].n_words == 300_000
    assert quality.apply_rules(docs.where("false")).count() == 0


# --- 8 exact dedup


def test_exact_edges(spark, frame):
    long = "x" * 3_000_000
    rows = [(1, "a"), (2, "a"), (3, None), (4, ""), (5, "A"), (6, long), (7, long), (8, long + "y"),
            (9, "ab"), (9, "ab"), (None, "q"), (None, "q"), (None, "a")]
    docs = frame([(i, t, "x") for i, t in rows], "doc_id long, text string, keep_id string").repartition(3)
    for bytes_held in (exact_dedup.SUBTREE_BYTES, 10):
        got = exact_dedup.mark_duplicates(docs, subtree_bytes=bytes_held).collect()
        assert len(got) == len(rows)
        assert {r.doc_id: (r.keep_id, r.group_size) for r in got if r.doc_id} == {
            1: (2, 3), 2: (2, 3), 3: (4, 2), 4: (4, 2), 5: (5, 1), 6: (7, 2), 7: (7, 2), 8: (8, 1), 9: (9, 2),
        }
        assert sorted((r.keep_id or 0, r.kept) for r in got if r.doc_id is None) == [(0, True), (0, True), (2, False)]
        assert {r.text_sha256 for r in got if r.doc_id in (3, 4)} == {hashlib.sha256(b"").hexdigest()}
    stay = exact_dedup.deduplicate(docs, keep="smallest").collect()
    assert sorted((r.doc_id or 0) for r in stay) == [0, 1, 3, 5, 6, 8, 9]
    assert set(stay[0].asDict()) == {"doc_id", "text", "keep_id"}
    assert exact_dedup.mark_duplicates(docs.where("false")).count() == 0


@settings(max_examples=100, deadline=None)
@given(st.lists(st.binary(max_size=6).map(lambda b: bytes(x % 3 for x in b)), max_size=40))
def test_trie_holds_what_a_dictionary_holds(keys):
    trie, plain = exact_dedup.Patricia(min), {}
    for i, key in enumerate(keys):
        trie.insert(key, i, 1)
        plain.setdefault(key, []).append(i)
    assert {k: (best, n) for k, best, n, _ in trie.items()} == {k: (min(v), len(v)) for k, v in plain.items()}


# --- 9 chat


def test_chat_links(spark):
    rows = [
        (1, 0, "user", "Hello there\nHow do I join tables?"),
        (1, 1, "assistant", "> How do I  JOIN tables?\nUse a key."),
        (1, 2, "user", "> > How do I join tables?\n> Use a key.\nThanks!"),
        (1, 3, "user", "Hello there"),
        (1, 4, "assistant", "> Hello there\nHi."),
        (1, 5, "user", "> never said\nWhat?"),
        (1, 6, None, None),
        (1, 7, "user", "> ---\n> > Use a key.\nok"),
        (2, 0, "user", "> Hello there\nother conversation"),
        (None, 1, "user", "> Hello there"),
        (1, None, "user", "> Hello there"),
        (1, 4, "assistant", "> Hello there\nHi."),
    ]
    messages = spark.createDataFrame(
        [(*r, "x") for r in rows], "conv_id long, turn long, role string, text string, Parent_turn string"
    )
    got = chat.in_reply_order(chat.link_quotes(messages)).collect()
    assert len(got) == len(rows)
    one = {r.turn: r for r in got if r.conv_id == 1}
    assert {t: r.parent_turn for t, r in one.items()} == {
        0: None, 1: 0, 2: 1, 3: None, 4: 3, 5: None, 6: None, 7: 1, None: None,
    }
    assert (one[2].thread_turn, one[2].reply_depth, one[2].own_text) == (0, 2, "Thanks!")
    assert (one[7].thread_turn, one[7].reply_depth) == (0, 2)
    assert (one[6].own_text, one[6].formatted) == ("", "<|user|>\n\n")
    assert one[1].formatted == "<|assistant|>\nUse a key.\n" and one[1].n_quoted_lines == 1
    order = [r.turn for r in got if r.conv_id == 1 and r.turn is not None]
    assert order == [0, 1, 2, 7, 3, 4, 4, 5, 6]
    assert chat.link_quotes(messages.where("false")).count() == 0


def test_a_long_chain_of_replies(spark):
    rows = [(1, i, "user", (f"> message {i - 1}\n" if i else "") + f"message {i}") for i in range(40)]
    messages = spark.createDataFrame(rows, "conv_id long, turn long, role string, text string")
    got = chat.link_quotes(messages).collect()
    assert {r.turn: (r.thread_turn, r.reply_depth) for r in got} == {i: (0, i) for i in range(40)}


def test_quotes_by_passage(spark):
    """A signature does not outvote the body; quotes wrapped anew and of a part find their original."""
    signature = "Best wishes\nThe team of the north office\nSecond floor, room nine"
    body = "A whole new body that nobody has written before in this talk. It ends with a short line."
    wrapped = "\n".join("> " + " ".join(body.split()[i : i + 4]) for i in range(0, len(body.split()), 4))
    texts = {
        0: "Good day\n" + signature,
        **{i: f"message {i}\n" + signature for i in range(1, 4)},
        4: body + "\n" + signature,
        5: "\n".join("> " + x for x in (body + "\n" + signature).split("\n")) + "\nagreed",
        6: wrapped + "\nso do I",
        7: "> that nobody has written before\nreally?",
        8: "> It ends with a short line.\ntrue",
        **{i: f"message {i}\n" + signature for i in range(9, 20)},
        20: "> so do I\n" + "\n".join("> " + x for x in signature.split("\n")) + "\nfine",
        21: "> Best wishes\nthanks",
        22: "> a\0b\n\0\n> so do I\nNUL characters",
        23: "> \n>\n\n> > \n",
        24: " ".join(f"w{i}" for i in range(30_000)),
        25: "> " + " ".join(f"W{i}" for i in range(29_000, 29_010)),
    }
    rows = [(1, t, "user", x) for t, x in texts.items()]
    messages = spark.createDataFrame(rows, "conv_id long, turn long, role string, text string")
    parents = {r.turn: r.parent_turn for r in chat.link_quotes(messages).collect()}
    wanted = {5: 4, 6: 4, 7: 4, 8: 4, 20: 6, 21: 0, 22: 6, 25: 24}
    assert {t: p for t, p in parents.items() if p is not None} == wanted


def test_every_holder_of_a_unit_counts(spark):
    """Two lines that many messages hold, both of them in one message only."""
    texts = {
        **{t: f"message {t}\nfirst stock line" for t in range(12)},
        12: "message 12\nfirst stock line\nmiddle of 12\nsecond stock line",
        **{t: f"message {t}\nsecond stock line" for t in range(13, 25)},
        25: "> first stock line\nwhat I say\n> second stock line",
        26: "> message 3\n> second stock line",
    }
    rows = [(1, t, "user", x) for t, x in texts.items()]
    messages = spark.createDataFrame(rows, "conv_id long, turn long, role string, text string")
    parents = {r.turn: r.parent_turn for r in chat.link_quotes(messages, few_holders=None).collect()}
    assert {t: p for t, p in parents.items() if p is not None} == {25: 12, 26: 24}
    few = {r.turn: r.parent_turn for r in chat.link_quotes(messages).collect()}
    assert few[26] == 3


def test_parents_of_quoting_replies(spark):
    from reelpress.llm.queries import QUERIES

    rows = QUERIES["parents_of_quoting_replies"](spark, "/root/testdata/sf0.01").collect()
    asked = [r for r in rows if r.true_parent is not None]
    assert len(asked) > 100
    assert sum(r.parent_turn == r.true_parent for r in asked) >= 0.9 * len(asked)


def test_chat_sql_agrees_on_quotes(spark, tmp_path):
    import duckdb
    from compare import difference

    from reelpress.llm.queries import ORACLE, QUERIES

    rng, said = random.Random(8), {}
    rows = []
    for conv in range(20):
        for turn in range(12):
            lines = [f"line {rng.randrange(6)} of {conv % 3}" for _ in range(2)]
            for _ in range(rng.randrange(3)):
                if turn:
                    quoted = rng.choice(said[conv, rng.randrange(turn)])
                    lines.insert(0, "> " * rng.randint(1, 2) + quoted.upper())
            said[conv, turn] = [x.lstrip("> ") for x in lines]
            rows.append((conv, turn, rng.choice(["user", None]), rng.choice(["\n".join(lines), "\n".join(lines), None])))
    frame = spark.createDataFrame(rows, "conv_id long, turn long, role string, text string")
    frame.coalesce(1).write.parquet(f"{tmp_path}/conversations.parquet")
    con = duckdb.connect()
    con.execute(f"CREATE VIEW conversations AS SELECT * FROM '{tmp_path}/conversations.parquet/*.parquet'")
    name = "op9_chat_quotation_linking"
    made = QUERIES[name](spark, str(tmp_path))
    assert made.where("parent_turn IS NOT NULL").count() > 20
    assert difference(made, con, ORACLE[name]) is None


def test_large_ids_beside_nulls_stay_exact(spark, frame):
    big = 2**60 + 1
    docs = frame([(big, "some words"), (big + 1, "some words"), (None, "others")]).coalesce(1)
    pieces = packing.pack_documents(docs).collect()
    assert {r.doc_id for r in pieces} == {big, big + 1, None}
    rows = token_output.packed_rows(docs).collect()
    assert {d for r in rows for d in r.doc_ids} == {big, big + 1, None}
    kept = exact_dedup.mark_duplicates(docs).collect()
    assert {(r.doc_id, r.keep_id) for r in kept} == {(big, big + 1), (big + 1, big + 1), (None, None)}
    same = frame([(big, "some more words"), (None, "some more words")])
    assert {r.component_id for r in simhash.near_duplicates(same).collect()} == {big}


def test_added_tokens_are_the_library_s_plain_call(frame):
    import public_tokenizers
    from tokenizers import Tokenizer

    texts = ["a <|endoftext|> b", "<|endoftext|><|endoftext|>é", "<|endoftext|", "plain"]
    library = Tokenizer.from_file(public_tokenizers.path("byte_bpe_50k.json"))
    rows = packing.pack_documents(frame(enumerate(texts))).collect()
    got = {r.doc_id: np.frombuffer(r.ids, "<u4").tolist() for r in rows}
    assert got == {i: library.encode(t, add_special_tokens=False).ids + [0] for i, t in enumerate(texts)}
    assert 50256 in got[0] and 50256 not in got[2]

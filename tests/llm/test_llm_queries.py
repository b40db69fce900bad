"""Every query against its SQL, or against brute force where SQL cannot state it."""

import base64
import hashlib
import os
import re
import zlib
from collections import defaultdict

import numpy as np
import public_tokenizers
import pytest
import tiktoken
import xxhash
from compare import connect, difference
from tokenizers import Tokenizer

import __spark_entry__ as entry_module
from reelpress.llm.queries import ORACLE, QUERIES

FOLDER = os.environ.get("TEST_SF_DIR", "/root/testdata/sf0.001")


@pytest.fixture(scope="module")
def con():
    return connect(FOLDER)


@pytest.fixture(scope="module")
def texts(spark):
    rows = spark.read.parquet(f"{FOLDER}/documents.parquet").select("doc_id", "text").collect()
    return {r.doc_id: r.text or "" for r in rows}


@pytest.fixture(scope="module")
def token_ids(texts):
    tokenizer = Tokenizer.from_file(public_tokenizers.path("byte_bpe_50k.json"))
    return {d: tokenizer.encode(t, add_special_tokens=False).ids + [0] for d, t in texts.items()}


def crc(ids, kind="<u4"):
    return zlib.crc32(np.array(ids, kind).tobytes())


def sha(data):
    return hashlib.sha256(data if isinstance(data, bytes) else data.encode()).hexdigest()


@pytest.mark.parametrize("name", list(ORACLE))
def test_against_sql(spark, con, name):
    assert difference(QUERIES[name](spark, FOLDER), con, ORACLE[name]) is None


def test_one_query_per_operator():
    numbers = sorted(int(found[1]) for name in QUERIES if (found := re.match(r"op(\d+)_", name)))
    assert numbers == list(range(1, 14))
    assert set(QUERIES) | {"pipeline"} <= set(entry_module.queries())


def test_byte_bpe_is_the_library_s(spark, texts):
    with open(public_tokenizers.path("byte_bpe_50k.tiktoken"), "rb") as lines:
        ranks = {base64.b64decode(a): int(b) for a, b in map(bytes.split, lines)}
    library = tiktoken.Encoding(
        "own", pat_str=public_tokenizers.PATTERN, mergeable_ranks=ranks, special_tokens={}
    )
    rows = QUERIES["op2_byte_bpe"](spark, FOLDER).collect()
    assert len(rows) == len(texts)
    for r in rows:
        ids = library.encode_ordinary(texts[r.doc_id])
        assert r.n_tokens == len(ids)
        assert r.ids_sha256 == sha(" ".join(map(str, ids)))
        assert r.decoded_sha256 == sha(texts[r.doc_id])


def slow_fingerprint(text):
    words = re.findall(r"[^\x20\x09-\x0D]+", re.sub("[A-Z]", lambda m: m[0].lower(), text))
    if not words:
        return 0
    shingles = [" ".join(words[i : i + 3]) for i in range(max(1, len(words) - 2))]
    codes = [xxhash.xxh64_intdigest(s.encode(), 42) for s in shingles]
    return sum(1 << b for b in range(64) if 2 * sum(c >> b & 1 for c in codes) > len(codes))


def slow_components(codes):
    """Smallest member reachable over differences of at most three bits; codes by id."""
    ids = sorted(codes)
    values = np.array([codes[i] for i in ids], np.uint64)
    root = {i: i for i in ids}

    def find(i):
        while root[i] != i:
            i = root[i]
        return i

    for at, i in enumerate(ids):
        for other in np.flatnonzero(np.bitwise_count(values[at + 1 :] ^ values[at]) <= 3).tolist():
            a, b = find(i), find(ids[at + 1 + other])
            root[max(a, b)] = min(a, b)
    return {i: find(i) for i in ids}


def test_simhash_by_brute_force(spark, texts):
    rows = QUERIES["op3_simhash_near_dedup"](spark, FOLDER).collect()
    codes = {d: slow_fingerprint(t) for d, t in texts.items()}
    roots = slow_components(codes)
    assert {r.doc_id: (r.fingerprint, r.component_id) for r in rows} == {
        d: (f"{codes[d]:016x}", roots[d]) for d in texts
    }
    assert len(set(roots.values())) < len(texts)


def check_pieces(rows, token_ids):
    by_doc, by_sequence = defaultdict(list), defaultdict(list)
    for r in rows:
        by_doc[r.doc_id].append(r)
        by_sequence[r.sequence_id].append(r)
    assert set(by_doc) == set(token_ids)
    for doc, ids in token_ids.items():
        at = 0
        for r in sorted(by_doc[doc], key=lambda r: r.start):
            assert (r.start, r.doc_tokens) == (at, len(ids))
            assert r.ids_crc32 == crc(ids[at : at + r.length])
            at += r.length
        assert at == len(ids)
    for pieces in by_sequence.values():
        at = 0
        for r in sorted(pieces, key=lambda r: r.offset):
            assert r.offset == at
            at += r.length
        assert at <= 1024
    return by_sequence


def test_packing_keeps_every_id_and_pads_little(spark, token_ids):
    rows = QUERIES["op5_packing"](spark, FOLDER).collect()
    sequences = check_pieces(rows, token_ids)
    assert sum(map(len, token_ids.values())) > 0.97 * 1024 * len(sequences)


def test_token_output_keeps_every_id(spark, token_ids):
    seen = defaultdict(int)
    rows = QUERIES["op10_token_output"](spark, FOLDER).collect()
    for r in rows:
        ids, positions = [], []
        for doc, start, a, b in zip(r.doc_ids, r.starts, r.cu_seqlens, r.cu_seqlens[1:], strict=False):
            ids += token_ids[doc][start : start + b - a]
            positions += range(b - a)
            seen[doc] += b - a
        pad = [0] * (2048 - len(ids))
        assert (r.n_tokens, r.ids_crc32) == (len(ids), crc(ids + pad))
        assert r.positions_crc32 == crc(positions + pad, "<i4")
    assert seen == {d: len(ids) for d, ids in token_ids.items()}
    assert sum(seen.values()) > 0.97 * 2048 * len(rows)


def test_language_on_held_out_rows(spark, texts):
    truth = {
        r.doc_id: r.lang
        for r in spark.read.parquet(f"{FOLDER}/documents.parquet").select("doc_id", "lang").collect()
    }
    rows = QUERIES["op6_language_id"](spark, FOLDER).collect()
    assert {r.doc_id: r.held_out for r in rows} == {
        d: zlib.crc32(str(d).encode()) % 3 == 1 for d in texts
    }
    told = [r.lang_pred == truth[r.doc_id] for r in rows if r.held_out]
    assert sum(told) >= 0.97 * len(told)
    assert all(0 <= r.score <= 1 for r in rows)


def test_chat_of_unquoted_messages(spark):
    messages = spark.read.parquet(f"{FOLDER}/conversations.parquet").collect()
    rows = QUERIES["op9_chat_quotation_linking"](spark, FOLDER).collect()
    blanks = " \t\n\x0b\x0c\r"
    assert {(r.conv_id, r.turn): r.own_sha256 for r in rows} == {
        (m.conv_id, m.turn): sha((m.text or "").strip(blanks)) for m in messages
    }
    assert all(r.n_quoted_lines == 0 and r.thread_turn == r.turn for r in rows)
    assert [(r.conv_id, r.turn) for r in rows] == sorted((r.conv_id, r.turn) for r in rows)

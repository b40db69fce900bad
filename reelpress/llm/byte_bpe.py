"""Byte-level BPE: ranked merges folded over the bytes of distinct words.

The corpus' distinct words are counted (only words and counts are shuffled), and the frequent ones, as
many as fit ``COMMON_WORDS`` entries of at most ``FOLD_BYTES`` bytes, so that the size of the broadcast
is bounded, are encoded by ``fold_merges``. That is a Spark expression: a word's bytes are an array, and a
fold merges, step by step, the leftmost pair of lowest rank, looked up in a literal map of ranks
(in buckets, since looking a key up in one Spark map is linear).

Words beyond the dictionary, a few hundredths of all, are merged in the task that reads them, in the
same order by the same ranks, once per task and cached: ``merge_word``, and ``merge_long`` with a
heap for long ones. The fold costs some 70 microseconds a word, and distinct words grow with the
corpus; README has the figures of folding them all. No text leaves its task.

``decode`` concatenates the binary pieces of the ids.

Defined results: a null text counts as empty and has no ids; repeated rows are encoded
alike; an empty table gives an empty result; input columns named like a result column are
replaced. Strings of special tokens are ordinary text.
"""

from __future__ import annotations

import base64
import heapq
import json
import zlib
from collections import Counter
from collections.abc import Callable, Iterator
from itertools import pairwise
from struct import pack

import numpy as np
import pandas as pd
import public_tokenizers
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from reelpress.llm.common import text_of, without
from reelpress.llm.tokens import word_finder
from reelpress.session import use_checkpoints

#: Words in the broadcast dictionary, at most.
COMMON_WORDS = 200_000
#: Bytes of a word that the fold takes; its cost is quadratic.
FOLD_BYTES = 64
#: Words beyond the dictionary that a task remembers.
CACHED_WORDS = 100_000
#: Rows that are worked on at a time.
PORTION_ROWS = 256
#: Bytes from which a heap is worth while.
LONG_BYTES = 256
#: Buckets of the literal rank map.
BUCKETS = 16_384
#: Distinct words counted in a task before they are given out.
COUNTED_WORDS = 80_000


def read_ranks(spark: SparkSession, path: str) -> dict[bytes, int]:
    """Ranks of a tiktoken file, read by Spark so that any store will do."""
    rows = spark.read.text(path if "://" in path else f"file://{path}").collect()
    pairs = (row[0].split() for row in rows if row[0].strip())
    return {base64.b64decode(piece): int(rank) for piece, rank in pairs}


def rank_map(ranks: dict[bytes, int]) -> Column:
    """Literal array of small maps from a byte string in hex to its rank."""
    buckets: list[dict[str, int]] = [{} for _ in range(BUCKETS)]
    for piece, rank in ranks.items():
        key = piece.hex().upper()
        buckets[zlib.crc32(key.encode()) % BUCKETS][key] = rank
    return F.from_json(F.lit(json.dumps(buckets, separators=(",", ":"))), "array<map<string,int>>")


def _rank(table: Column, key: Column) -> Column:
    bucket = F.crc32(key.cast("binary")) % BUCKETS
    return F.try_element_at(F.get(table, bucket.cast("int")), key)


_NO_RANK = 1 << 31


def _let(value: Column, use: Callable[[Column], Column]) -> Column:
    """``use`` of a value that is computed once; a lambda's body would compute it at each use."""
    return F.get(F.transform(F.array(value), use), F.lit(0))


def fold_merges(word: Column, table: Column) -> Column:
    """Ids of a word as array<int>.

    The state has the parts, byte strings in hex, and the rank of each with its right neighbour;
    a merge looks up the two new neighbourhoods only.
    """

    def rank(a: Column, b: Column) -> Column:
        return _rank(table, F.concat(a, b))

    def merge(state: Column, at: Column) -> Column:
        """Joins the part at place ``at`` (from 1) with the next."""
        parts, pairs = state["parts"], state["pairs"]
        none = F.array().cast("array<int>")

        def around(joint: Column) -> Column:
            left = F.when(at > 1, F.array(rank(F.get(parts, at - 2), joint))).otherwise(none)
            right = F.when(at < F.size(pairs), F.array(rank(joint, F.get(parts, at + 1)))).otherwise(none)
            return F.struct(
                F.concat(
                    F.slice(parts, F.lit(1), at - 1), F.array(joint), F.slice(parts, at + 2, F.size(parts))
                ).alias("parts"),
                F.concat(
                    F.slice(pairs, F.lit(1), F.greatest(at - 2, F.lit(0))),
                    left,
                    right,
                    F.slice(pairs, at + 2, F.size(pairs)),
                ).alias("pairs"),
            )

        return _let(F.concat(F.get(parts, at - 1), F.get(parts, at)), around)

    def step(state: Column, _: Column) -> Column:
        return _let(
            F.array_min(state["pairs"]),
            lambda best: F.when(best.isNull(), state).otherwise(
                _let(
                    F.array_position(state["pairs"], best).cast("int"), lambda at: merge(state, at)
                )
            ),
        )

    def fold(whole: Column) -> Column:
        size = (F.length(whole) / 2).cast("int")
        at = lambda i: F.substr(whole, i * 2 - 1, F.lit(2))
        start = F.struct(
            F.transform(F.sequence(F.lit(1), size), at).alias("parts"),
            F.transform(
                F.slice(F.sequence(F.lit(1), size), F.lit(1), size - 1),
                lambda i: _rank(table, F.substr(whole, i * 2 - 1, F.lit(4))),
            ).alias("pairs"),
        )
        folded = F.aggregate(
            F.sequence(F.lit(1), size),
            start,
            step,
            lambda s: F.transform(s["parts"], lambda p: _rank(table, p)),
        )
        return _let(
            _rank(table, whole),
            lambda known: F.when(known.isNotNull(), F.array(known)).otherwise(folded),
        )

    return _let(F.hex(F.encode(word, "UTF-8")), fold)


def merge_word(word: bytes, ranks: dict[bytes, int]) -> list[int]:
    """The same merges in Python, in steps linear in the number of parts."""
    if word in ranks:
        return [ranks[word]]
    if len(word) > LONG_BYTES:
        return merge_long(word, ranks)
    rank = ranks.get
    # part i lies between ends[i] and ends[i + 1]; pairs[i] is its rank with the next
    ends = list(range(len(word) + 1))
    pairs = [rank(word[i : i + 2], _NO_RANK) for i in ends[:-2]]
    while pairs and (best := min(pairs)) != _NO_RANK:
        at = pairs.index(best)
        del pairs[at], ends[at + 1]
        if at:
            pairs[at - 1] = rank(word[ends[at - 1] : ends[at + 1]], _NO_RANK)
        if at < len(pairs):
            pairs[at] = rank(word[ends[at] : ends[at + 2]], _NO_RANK)
    return [ranks[word[a:b]] for a, b in pairwise(ends)]


def merge_long(word: bytes, ranks: dict[bytes, int]) -> list[int]:
    """The same merges by a heap over linked parts, for words of any length."""
    if word in ranks:
        return [ranks[word]]
    n = len(word)
    end, before = list(range(1, n + 1)), list(range(-1, n - 1))  # by the start of a part
    alive = [True] * n
    heap = [(ranks[word[i : i + 2]], i, i + 2) for i in range(n - 1) if word[i : i + 2] in ranks]
    heapq.heapify(heap)

    def offer(i: int) -> None:
        if i >= 0 and end[i] < n and (rank := ranks.get(word[i : end[end[i]]])) is not None:
            heapq.heappush(heap, (rank, i, end[end[i]]))

    while heap:
        _, i, upto = heapq.heappop(heap)
        # stale: the part is gone, or it or its neighbour has grown since
        if not alive[i] or end[i] >= n or end[end[i]] != upto:
            continue
        alive[end[i]] = False
        end[i] = upto
        if upto < n:
            before[upto] = i
        offer(i)
        offer(before[i])
    return [ranks[word[i : end[i]]] for i in range(n) if alive[i]]


def encode(
    docs: DataFrame,
    text: str = "text",
    ranks_path: str | None = None,
    common_words: int = COMMON_WORDS,
) -> DataFrame:
    """``docs`` with ``ids``, the token ids as array<int>."""
    spark = docs.sparkSession
    use_checkpoints(spark)
    ranks = read_ranks(spark, ranks_path or public_tokenizers.path("byte_bpe_50k.tiktoken"))
    table = rank_map(ranks)
    words = count_words(docs.select(text_of(text).alias("text"))).checkpoint()
    common = (
        _common(words.where(F.octet_length("word") <= FOLD_BYTES), common_words)
        .select("word", fold_merges(F.col("word"), table).alias("ids"))
        .toArrow()
    )
    shared = spark.sparkContext.broadcast((_packed(common), ranks))
    del common

    if text.lower() == "ids":
        docs, text = docs.withColumnRenamed(text, "__text"), "__text"
    plain = without(docs, "ids")
    place = plain.columns.index(text)
    schema = T.StructType([*plain.schema.fields, T.StructField("ids", T.ArrayType(T.IntegerType()))])

    def assemble(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        data, ranks = shared.value
        known, find = _Ids(_unpacked(data), ranks), word_finder()
        for part in _portions(batches):
            rows = [known.ids_of(find(text or "")) for text in part.column(place).to_pylist()]
            yield _with_column(part, schema, _lists(rows))

    return plain.mapInArrow(assemble, schema).drop("__text")


def _portions(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """A few hundred rows at a time, so that what is made of them stays small."""
    for batch in batches:
        for at in range(0, batch.num_rows, PORTION_ROWS):
            yield batch.slice(at, PORTION_ROWS)


def _with_column(part: pa.RecordBatch, schema: T.StructType, made: pa.Array) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays([*part.columns, made], schema.fieldNames())


def _lists(rows: list[bytes]) -> pa.Array:
    """Rows of little-endian ids as one array of lists."""
    ends = np.cumsum([0, *(len(row) // 4 for row in rows)]).astype(np.int32)
    return pa.ListArray.from_arrays(pa.array(ends), pa.array(np.frombuffer(b"".join(rows), "<i4")))


class _Ids(dict):
    """Word -> little-endian ids: the dictionary, and a bounded cache of the words beyond it."""

    def __init__(self, known: dict[str, bytes], ranks: dict[bytes, int]):
        super().__init__(known)
        self.ranks, self.cached = ranks, []

    def __missing__(self, word: str) -> bytes:
        ids = merge_word(word.encode("utf-8"), self.ranks)
        self[word] = ids = pack(f"<{len(ids)}i", *ids)
        self.cached.append(word)
        return ids

    def ids_of(self, words: list[str]) -> bytes:
        found = b"".join(map(self.__getitem__, words))
        if len(self.cached) > CACHED_WORDS:
            for word in self.cached:
                del self[word]
            self.cached = []
        return found


def _packed(common: pa.Table) -> bytes:
    sink = pa.BufferOutputStream()
    with pa.ipc.new_stream(sink, common.schema) as stream:
        stream.write_table(common)
    return sink.getvalue().to_pybytes()


def _unpacked(data: bytes) -> dict[str, bytes]:
    known: dict[str, bytes] = {}
    with pa.ipc.open_stream(data) as stream:
        for batch in stream:
            ids = batch.column(1)
            flat, ends = ids.values.to_numpy().astype("<i4").tobytes(), (4 * ids.offsets.to_numpy()).tolist()
            pieces = [flat[a:b] for a, b in zip(ends, ends[1:], strict=False)]
            known.update(zip(batch.column(0).to_pylist(), pieces, strict=True))
    return known


def count_words(texts: DataFrame) -> DataFrame:
    """Distinct words of the splitting pattern and how often they occur."""

    def count(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        find, seen = word_finder(), Counter()
        for batch in batches:
            for text in batch["text"]:
                seen.update(find(text))
                if len(seen) > COUNTED_WORDS:
                    yield pd.DataFrame(seen.items(), columns=["word", "n"])
                    seen = Counter()
        yield pd.DataFrame(seen.items(), columns=["word", "n"])

    return texts.mapInPandas(count, "word string, n long").groupBy("word").agg(F.sum("n").alias("n"))


def _common(words: DataFrame, most: int) -> DataFrame:
    """The most frequent words, down to a count at which they are at most ``most``.

    Counts go in steps of a quarter octave; only the number of words per step is fetched.
    """
    step = F.floor(4 * F.log2("n"))
    total, least = 0, 1 << 20
    for row in sorted(words.groupBy(step.alias("step")).count().collect(), reverse=True):
        total += row["count"]
        if total > most:
            break
        least = row["step"]
    return words.where(step >= least)


def decode(df: DataFrame, ids: str = "ids", ranks_path: str | None = None) -> DataFrame:
    """``df`` with ``decoded``, the concatenated byte pieces of the ids."""
    spark = df.sparkSession
    ranks = read_ranks(spark, ranks_path or public_tokenizers.path("byte_bpe_50k.tiktoken"))
    shared = spark.sparkContext.broadcast({rank: piece for piece, rank in ranks.items()})
    if ids.lower() == "decoded":
        df, ids = df.withColumnRenamed(ids, "__ids"), "__ids"
    plain = without(df, "decoded")
    place = plain.columns.index(ids)
    schema = T.StructType([*plain.schema.fields, T.StructField("decoded", T.BinaryType())])

    def join(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        piece = shared.value.__getitem__
        for part in _portions(batches):
            rows = part.column(place)
            # lists without values between them, so that lengths tell where each lies
            pieces = list(map(piece, rows.flatten().to_numpy().tolist()))
            sizes = rows.value_lengths().fill_null(0).to_numpy()
            ends = np.cumsum([0, *sizes]).tolist()
            texts = [b"".join(pieces[a:b]) for a, b in pairwise(ends)]
            made = [None if gone else t for gone, t in zip(rows.is_null().to_pylist(), texts, strict=True)]
            yield _with_column(part, schema, pa.array(made, pa.binary()))

    return plain.mapInArrow(join, schema).drop("__ids")

"""Exact dedup: owners of texts in Patricia tries (compressed radix tries over bytes).

Every task first puts its own rows into tries, so a text repeated within a task leaves it once,
with the number of rows and the best id. What is left is partitioned and sorted by length and
content hash; the owner of a partition inserts the full byte strings into tries and each
terminal node keeps the best id and the number of rows. Equal is decided by the bytes, the hash
only deals out. A trie holds one subtree at a time: once ``SUBTREE_BYTES`` are held, it is given
out and begun anew at the next change of (length, hash), where no later text can match an
earlier one. Sorting, and the spilling it needs, is Spark's.

Membership joins the small rows (id, digest) to one row per text, so hot digests can be split.

Defined results: a null text counts as empty; the largest (or smallest) id stays, null ids only
where a group has no other; repeated rows with the id that stays are all marked kept, and
``deduplicate`` leaves one of them; an empty table gives an empty result.
"""

from __future__ import annotations

import hashlib
from collections.abc import Callable, Iterator
from itertools import islice

import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from reelpress.llm.common import text_of

#: Bytes of text that a trie holds before it is given out at the next boundary.
SUBTREE_BYTES = 32_000_000

# ids go as text: beside nulls pandas would make large whole numbers inexact
_OWNED = "body binary, len long, hash long, best string, n long"
_DIGESTS = "digest binary, keep_id long, group_size long"


class Patricia:
    """Byte strings with a best id and a count at their terminal nodes.

    A node is ``[label, children by first byte, terminal]``; a terminal is ``[best, n, code]``.
    """

    def __init__(self, better: Callable[[list[int]], int]):
        self.better, self.root, self.bytes = better, [b"", {}, None], 0

    def insert(self, key: bytes, best: int | None, n: int, code: int = 0) -> None:
        node, at, size = self.root, 0, len(key)
        while at < size:
            child = node[1].get(key[at])
            if child is None:
                node[1][key[at]] = node = [key[at:], {}, None]
                self.bytes += size - at
                break
            label = child[0]
            if not key.startswith(label, at):
                same = _common(label, key, at)
                lower = [label[same:], child[1], child[2]]
                child[:] = [label[:same], {label[same]: lower}, None]
                at, node = at + same, child
                continue
            at, node = at + len(label), child
        if node[2] is None:
            node[2] = [best, n, code]
            return
        held = node[2]
        known = [x for x in (held[0], best) if x is not None]
        held[0] = self.better(known) if known else None
        held[1] += n

    def items(self) -> Iterator[tuple[bytes, int | None, int, int]]:
        stack = [(b"", self.root)]
        while stack:
            prefix, (label, children, terminal) = stack.pop()
            whole = prefix + label
            if terminal:
                yield whole, *terminal
            stack += [(whole, child) for child in children.values()]


def _common(label: bytes, key: bytes, at: int) -> int:
    """Length of the common prefix of label and key[at:], which differ within the label."""
    low, high = 0, min(len(label), len(key) - at)
    while low < high:
        mid = (low + high + 1) // 2
        if label[:mid] == key[at : at + mid]:
            low = mid
        else:
            high = mid - 1
    return low


def _number(value: str | None) -> int | None:
    return None if value is None else int(value)


def duplicate_groups(
    docs: DataFrame,
    text: str = "text",
    doc_id: str = "doc_id",
    keep: str = "largest",
    normalize: Callable[[Column], Column] | None = None,
    subtree_bytes: int = SUBTREE_BYTES,
) -> DataFrame:
    """One row per different text: digest (SHA-256), keep_id and group_size."""
    better = {"largest": max, "smallest": min}[keep]
    body = _normalised(text, normalize)
    rows = docs.select(
        F.encode(body, "UTF-8").alias("body"),
        F.octet_length(body).cast("long").alias("len"),
        F.xxhash64(body).alias("hash"),
        F.col(doc_id).cast("string").alias("best"),
        F.lit(1).cast("long").alias("n"),
    )

    def combine(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        trie = Patricia(better)
        for batch in batches:
            for body, _, code, best, n in batch.itertuples(index=False):
                trie.insert(bytes(body), _number(best), n, code)
                if trie.bytes > subtree_bytes:
                    yield from _given(trie)
                    trie = Patricia(better)
        yield from _given(trie)

    def own(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        trie, last = Patricia(better), None
        for batch in batches:
            for body, size, code, best, n in batch.itertuples(index=False):
                if trie.bytes > subtree_bytes and (size, code) != last:
                    yield from _digests(trie)
                    trie = Patricia(better)
                last = (size, code)
                trie.insert(bytes(body), _number(best), n)
        yield from _digests(trie)

    local = rows.mapInPandas(combine, _OWNED)
    dealt = local.repartition("len", "hash").sortWithinPartitions("len", "hash")
    return dealt.mapInPandas(own, _DIGESTS)


def mark_duplicates(docs: DataFrame, text: str = "text", doc_id: str = "doc_id", **options) -> DataFrame:
    """One row per document: doc_id, keep_id, group_size, kept and text_sha256."""
    owners = duplicate_groups(docs, text, doc_id, **options)
    body = _normalised(text, options.get("normalize"))
    members = docs.select(
        F.col(doc_id).cast("long").alias("doc_id"), F.unhex(F.sha2(body, 256)).alias("digest")
    )
    return members.join(owners, "digest").select(
        "doc_id",
        "keep_id",
        "group_size",
        F.col("doc_id").eqNullSafe(F.col("keep_id")).alias("kept"),
        F.lower(F.hex("digest")).alias("text_sha256"),
    )


def deduplicate(docs: DataFrame, text: str = "text", doc_id: str = "doc_id", **options) -> DataFrame:
    """The documents that stay, one per text, with all their columns."""
    body = _normalised(text, options.get("normalize"))
    owners = duplicate_groups(docs, text, doc_id, **options).withColumnsRenamed(
        {"digest": "__digest", "keep_id": "__keep"}
    )
    keyed = docs.withColumn("__own", F.unhex(F.sha2(body, 256)))
    kept = keyed.join(
        owners.select("__digest", "__keep"),
        (F.col("__own") == F.col("__digest")) & F.col(doc_id).cast("long").eqNullSafe(F.col("__keep")),
    )
    return kept.dropDuplicates(["__own"]).drop("__own", "__digest", "__keep")


def _normalised(text: str, normalize: Callable[[Column], Column] | None) -> Column:
    return normalize(text_of(text)) if normalize else text_of(text)


def _given(trie: Patricia) -> Iterator[pd.DataFrame]:
    rows = (
        (body, len(body), code, None if best is None else str(best), n)
        for body, best, n, code in trie.items()
    )
    while part := list(islice(rows, 1000)):
        yield pd.DataFrame(part, columns=["body", "len", "hash", "best", "n"])


def _digests(trie: Patricia) -> Iterator[pd.DataFrame]:
    rows = ((hashlib.sha256(body).digest(), best, n) for body, best, n, _ in trie.items())
    while part := list(islice(rows, 1000)):
        frame = pd.DataFrame(part, columns=["digest", "keep_id", "group_size"], dtype=object)
        yield frame.astype({"keep_id": "Int64", "group_size": "int64"})

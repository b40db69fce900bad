"""SimHash near-dedup by meet-in-the-middle ball hashing.

Two fingerprints within ``RADIUS`` = 3 bits of each other have a common variant: one that is
one flipped bit from the first and two from the second. So every fingerprint emits all variants
within half the radius (rounded down: itself and 64 single flips), and half of them, those with
an odd number of set bits, also the variants two flips away (half the radius rounded up):

* fingerprints two bits apart, or equal, meet in single flips;
* fingerprints one or three bits apart have different parity, and the odd one's double flips
  meet the single flips of the even one. Of any three bits two lie in the same 32-bit half,
  so double flips within a half are enough: 2 x 496.

All members of a variant that is near to one of them are within three bits of that one, so a
variant needs no pairs, only links from its first near member to the others: no link between
two fingerprints is lost, for the first near member is linked to both. Links are verified by
their differing bits.

Variants are shuffled by their leading bits, as many as the number of fingerprints calls for
(``prefix_bits``): a fingerprint sends one row per way of flipping at most two of these bits,
not one per variant, and the variants are written out where they meet, a bounded portion at a
time; a bucket with too many rows is dealt out further by its next bits. Exact copies never
multiply: one row per fingerprint takes part, and documents join back to its component. A
variant has at most 65 near and 992 far members, so no such group grows with the data.
"""

from __future__ import annotations

from collections.abc import Iterator, Sequence
from itertools import pairwise
from typing import NamedTuple

import numpy as np
import pandas as pd
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from reelpress.llm.common import text_of
from reelpress.llm.components import connected
from reelpress.session import use_checkpoints

RADIUS = 3
#: Shingles whose bits are counted at a time.
BLOCK = 65_536
#: Rows whose far variants are written out at a time.
FAR_ROWS = 1000


def fingerprint(text: str, words: int = 3, seed: int = 42) -> int:
    """Majority of the shingles' XXH64 bits; 0 without words."""
    tokens = text.encode("utf-8", "surrogatepass").lower().split()
    if not tokens:
        return 0
    buffer = memoryview(b" ".join(tokens))
    ends = np.cumsum([len(t) + 1 for t in tokens]) - 1
    starts = np.concatenate(([0], ends[:-1] + 1))
    n = max(1, len(tokens) - words + 1)
    digest, ends = xxhash.xxh64_intdigest, ends[len(tokens) - n :]
    counts = np.zeros(64, np.int64)
    for at in range(0, n, BLOCK):
        upto = min(n, at + BLOCK)
        hashes = np.fromiter(
            (
                digest(buffer[a:b], seed)
                for a, b in zip(starts[at:upto].tolist(), ends[at:upto].tolist(), strict=True)
            ),
            np.uint64,
            upto - at,
        )
        bits = np.unpackbits(hashes.astype("<u8").view(np.uint8).reshape(-1, 8), axis=1, bitorder="little")
        counts += bits.sum(axis=0, dtype=np.int64)
    return int(sum(1 << i for i in np.flatnonzero(2 * counts > n).tolist()))


def with_fingerprint(docs: DataFrame, text: str = "text", words: int = 3) -> DataFrame:
    """Adds ``fingerprint`` as a long (two's complement); a null text counts as empty."""

    @F.pandas_udf("long")
    def mark(parts: Iterator[pd.Series]) -> Iterator[pd.Series]:
        for texts in parts:
            codes = np.fromiter((fingerprint(t, words) for t in texts), np.uint64, len(texts))
            yield pd.Series(codes.view(np.int64))

    return docs.withColumn("fingerprint", mark(text_of(text)))


def prefix_bits(n: int) -> int:
    """Leading bits that deal out the variants of n fingerprints: about a thousand rows each."""
    return min(32, max(8, n.bit_length() - 4))


def _flips(low: int, high: int, count: int) -> np.ndarray:
    """Masks with ``count`` of the bits from low up to high (exclusive) set."""
    one = [1 << b for b in range(low, high)]
    if count == 0:
        return np.zeros(1, np.uint64)
    if count == 1:
        return np.array(one, np.uint64)
    return np.array([x | y for i, x in enumerate(one) for y in one[i + 1 :]], np.uint64)


def _odd(codes: np.ndarray) -> np.ndarray:
    return np.bitwise_count(codes) % 2 == 1


class Rows(NamedTuple):
    """Fingerprints, each with some of its leading bits flipped: how many, and the outcome."""

    code: np.ndarray
    flipped: np.ndarray
    flips: np.ndarray

    def take(self, which) -> Rows:
        return Rows(*[x[which] for x in self])


def _deal(rows: Rows, low: int, high: int) -> Iterator[Rows]:
    """Flips bits from low up to high (exclusive): two at most in all, and two only if odd."""
    for more in range(3):
        for before in range(3 - more):
            part = rows.take(
                (rows.flips == before) & (_odd(rows.code) if before + more == 2 else True)
            )
            masks = _flips(low, high, more)
            if len(part.code) and len(masks):
                yield Rows(
                    np.repeat(part.code, len(masks)),
                    (part.flipped[:, None] ^ masks).ravel(),
                    np.full(len(part.code) * len(masks), before + more, np.int32),
                )


def _send(prefix: int):
    def send(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            every = batch["code"].to_numpy(np.int64).view(np.uint64)
            for at in range(0, len(every), 2000):
                code = every[at : at + 2000]
                for rows in _deal(Rows(code, code, np.zeros(len(code), np.int32)), 64 - prefix, 64):
                    yield pd.DataFrame(
                        {
                            "bucket": (rows.flipped >> np.uint64(64 - prefix)).astype(np.int64),
                            "code": rows.code.view(np.int64),
                            "flips": rows.flips,
                        }
                    )

    return send


def _variants(rows: Rows, prefix: int) -> Iterator[tuple[np.ndarray, np.ndarray, bool]]:
    """(variants, their fingerprints, whether near) for rows whose leading bits are settled."""
    rest = 64 - prefix
    for flips in (0, 1):
        part = rows.take(rows.flips == flips)
        for more in range(2 - flips):
            yield *_spread(part, _flips(0, rest, more)), True
    odd = rows.take(_odd(rows.code))
    for flips, masks in (
        (0, (_flips(32, rest, 2), _flips(0, 32, 2))),
        (1, (_flips(32, rest, 1),)),
        (2, (_flips(0, 0, 0),)),
    ):
        every = odd.take(odd.flips == flips)
        for at in range(0, len(every.code), FAR_ROWS):
            for mask in masks:
                if len(mask):
                    yield *_spread(every.take(slice(at, at + FAR_ROWS)), mask), False


def _spread(rows: Rows, masks: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    return (rows.flipped[:, None] ^ masks).ravel(), np.repeat(rows.code, len(masks))


def links_within(rows: Rows, prefix: int) -> np.ndarray:
    """Links from the first near member of each variant to all its other members."""
    near = [(v, s) for v, s, is_near in _variants(rows.take(rows.flips < 2), prefix) if is_near]
    variants, sources = (np.concatenate(x) for x in zip(*near, strict=True))
    if not len(variants):
        return np.empty((0, 2), np.uint64)
    order = np.lexsort((sources, variants))
    variants, sources = variants[order], sources[order]
    starts = np.flatnonzero(np.append(True, variants[1:] != variants[:-1]))
    heads, head_codes = variants[starts], sources[starts]
    sizes = np.diff(np.append(starts, len(variants)))
    found = [np.stack([np.repeat(head_codes, sizes), sources], 1)]
    for v, s, is_near in _variants(rows, prefix):
        if not is_near:
            at = np.minimum(np.searchsorted(heads, v), len(heads) - 1)
            hit = heads[at] == v
            found.append(np.stack([head_codes[at[hit]], s[hit]], 1))
    links = np.concatenate(found)
    links = links[links[:, 0] != links[:, 1]]
    return np.unique(links[np.bitwise_count(links[:, 0] ^ links[:, 1]) <= RADIUS], axis=0)


def _meet(prefix: int):
    def meet(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        """Rows come sorted by bucket; a bucket that may go on in the next batch is kept."""
        kept: list[pd.DataFrame] = []
        for batch in batches:
            if not len(batch):
                continue
            if kept and kept[-1]["bucket"].iloc[-1] != batch["bucket"].iloc[0]:
                yield from _whole(pd.concat(kept), prefix)
                kept = []
            ends = batch["bucket"] == batch["bucket"].iloc[-1]
            if not ends.all():
                yield from _whole(pd.concat([*kept, batch[~ends]]), prefix)
                kept = []
            kept.append(batch[ends])
        if kept:
            yield from _whole(pd.concat(kept), prefix)

    return meet


def _whole(frame: pd.DataFrame, prefix: int) -> Iterator[pd.DataFrame]:
    """Works through whole buckets, small ones together, large ones dealt out further."""
    bucket = frame["bucket"].to_numpy().view(np.uint64)
    code = frame["code"].to_numpy(np.int64).view(np.uint64)
    rest = np.uint64(64 - prefix)
    low = code & ((np.uint64(1) << rest) - np.uint64(1))
    rows = Rows(code, (bucket << rest) | low, frame["flips"].to_numpy())
    for part, bits in _portions(rows, prefix):
        links = links_within(part, bits)
        if len(links):
            links = links.view(np.int64)
            yield pd.DataFrame({"a": links[:, 0], "b": links[:, 1]})


def _portions(rows: Rows, prefix: int, most: int = 4000) -> Iterator[tuple[Rows, int]]:
    """Portions of about ``most`` rows that hold whole buckets of ``prefix`` bits or more."""
    shift, size = np.uint64(64 - prefix), len(rows.code)
    bucket = rows.flipped >> shift
    cuts = [0, *(np.flatnonzero(np.diff(bucket)) + 1).tolist(), size]
    at = 0
    for before, cut in pairwise(cuts):
        if cut - at > most and before > at:
            yield rows.take(slice(at, before)), prefix
            at = before
        if cut - at > most and prefix < 32:
            deeper = min(32, prefix + 8)
            dealt = [*_deal(rows.take(slice(at, cut)), 64 - deeper, 64 - prefix)]
            joined = Rows(*[np.concatenate(x) for x in zip(*dealt, strict=True)])
            order = np.argsort(joined.flipped >> np.uint64(64 - deeper), kind="stable")
            yield from _portions(joined.take(order), deeper, most)
            at = cut
    if at < size:
        yield rows.take(slice(at, size)), prefix


def fingerprint_links(codes: DataFrame, n: int) -> DataFrame:
    """Links (a, b) that join all ``code`` within three bits into components; n: about how many."""
    prefix = prefix_bits(n)
    sent = codes.mapInPandas(_send(prefix), "bucket long, code long, flips int")
    return (
        sent.repartition("bucket")
        .sortWithinPartitions("bucket")
        .mapInPandas(_meet(prefix), "a long, b long")
        .distinct()
    )


def near_components(
    docs: DataFrame,
    text: str = "text",
    doc_id: str = "doc_id",
    words: int = 3,
    carry: Sequence[Column] = (),
) -> DataFrame:
    """One row per document: doc_id, fingerprint (long), root, component_id and the ``carry`` columns.

    ``root`` names a component even where all of its ids are null; ``carry`` columns should be narrow,
    since they are written and shuffled with the fingerprints.
    """
    use_checkpoints(docs.sparkSession)
    marked = (
        with_fingerprint(
            docs.select(F.col(doc_id).alias("doc_id"), F.col(text).alias("text"), *carry), words=words
        )
        .drop("text")
        .checkpoint()
    )
    first = marked.groupBy("fingerprint").agg(F.min("doc_id").alias("first_id")).checkpoint()
    links = fingerprint_links(first.select(F.col("fingerprint").alias("code")), first.count())
    roots = connected(links).withColumnRenamed("node", "fingerprint")
    rooted = first.join(roots, "fingerprint", "left").withColumn(
        "root", F.coalesce("root", "fingerprint")
    )
    lowest = rooted.groupBy("root").agg(F.min("first_id").alias("component_id"))
    classes = rooted.join(lowest, "root").select("fingerprint", "root", "component_id")
    return marked.join(classes, "fingerprint")


def near_duplicates(
    docs: DataFrame, text: str = "text", doc_id: str = "doc_id", words: int = 3
) -> DataFrame:
    """One row per document: doc_id, fingerprint (16 hex digits) and component_id.

    component_id is the smallest doc_id that links of at most three bits reach. Documents
    without words have fingerprint zero and are linked like any other; null ids never become a
    component_id unless the component has no other; repeated rows stay; an empty table gives an
    empty result.
    """
    return near_components(docs, text, doc_id, words).select(
        "doc_id",
        F.lower(F.lpad(F.hex("fingerprint"), 16, "0")).alias("fingerprint"),
        "component_id",
    )

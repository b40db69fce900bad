"""Bit positions of an approximate-membership (Bloom) sketch."""

from __future__ import annotations

import math

from pyspark.sql import Column
from pyspark.sql import functions as F

# ---- fixed values -----------------------------------------------------------------------
SKETCH_BITS, SKETCH_ERROR = 10000, 0.01
# -----------------------------------------------------------------------------------------


def hash_count(bits: int = SKETCH_BITS, error: float = SKETCH_ERROR) -> int:
    """Number of hash functions: ``-ln(error) / ln(2)``, at least 1 and at most ``bits``."""
    return max(1, min(int(-math.log(error) / math.log(2)), bits))


def sized_bits(items: Column, error: float = SKETCH_ERROR) -> Column:
    """Bits for a number of items at an error rate: ``items * hashes / ln(2)``.

    That many bits leave half of them unset once all items are in.
    """
    hashes = max(1, round(-math.log(error) / math.log(2)))
    return F.greatest(F.lit(1), F.ceil(items * F.lit(hashes / math.log(2)))).cast("bigint")


def position(item: Column, index: int, bits: int | Column = SKETCH_BITS) -> Column:
    """``md5(item followed by index)``, read as one 128-bit number, modulo ``bits``.

    The digest is folded in eight 16-bit pieces, which keeps every step within a bigint for
    up to 2**47 bits.
    """
    digest = F.md5(F.concat(item, F.lit(str(index))))
    size = bits if isinstance(bits, Column) else F.lit(bits)
    value = F.lit(0).cast("bigint")
    for start in range(1, 33, 4):
        piece = F.conv(F.substring(digest, start, 4), 16, 10).cast("bigint")
        value = F.pmod(value * F.lit(2**16) + piece, size.cast("bigint"))
    return value


def positions(
    item: Column, bits: int | Column = SKETCH_BITS, hashes: int | None = None
) -> Column:
    """Bit positions of an item; name the number of ``hashes`` where ``bits`` is a column."""
    if hashes is None:
        hashes = hash_count() if isinstance(bits, Column) else hash_count(bits)
    return F.array(*(position(item, index, bits) for index in range(hashes)))

"""Packed id matrices by best-fit-decreasing with a segment tree over free capacities.

Documents, with the end id appended, longer than a row are split at multiples of the row's length,
so nothing is lost; full rows are written as they are. The other pieces are packed in blocks, longest
first, each into the row with the least free capacity that still takes it; a segment tree over
capacities finds that capacity in logarithmic time.

A result row is one row of the matrix: ``ids`` (``width`` little-endian unsigned 32-bit numbers, padded
with the pad id), ``positions`` (the same shape; they begin at 0 with every segment and are 0 in the
padding), ``cu_seqlens`` (0 and the ends of segments), ``doc_ids`` and ``starts`` (where each segment
begins in its document).

No shuffle is needed and blocks are bounded, so hot sources and groups of copies are only more
blocks; only the last block of a task is small.

Defined results: a null text counts as empty and has the end id only; a null doc_id stays null;
repeated rows are packed once each; an empty table gives an empty result.
"""

from __future__ import annotations

from collections.abc import Iterator
from itertools import count

import numpy as np
import pandas as pd
import public_tokenizers
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from reelpress.llm.common import text_of
from reelpress.llm.tokens import encoder

WIDTH = 2048
#: Ids in a block of pieces.
BLOCK_IDS = 1 << 19

ROWS = (
    "sequence_id long, n_tokens int, ids binary, positions binary, cu_seqlens array<int>,"
    " doc_ids array<long>, starts array<long>"
)
_COLUMNS = ["sequence_id", "n_tokens", "ids", "positions", "cu_seqlens", "doc_ids", "starts"]


class Capacities:
    """How many rows have each free capacity, as a segment tree of sums."""

    def __init__(self, most: int):
        self.leaves = 1 << most.bit_length()
        self.sums = [0] * (2 * self.leaves)

    def change(self, capacity: int, by: int) -> None:
        at = capacity + self.leaves
        while at:
            self.sums[at] += by
            at >>= 1

    def least(self, capacity: int) -> int | None:
        """The least capacity in use that is not below ``capacity``."""
        at = capacity + self.leaves
        if self.sums[at]:
            return capacity
        while at > 1:
            if at % 2 == 0 and self.sums[at + 1]:
                at += 1
                while at < self.leaves:
                    at = 2 * at if self.sums[2 * at] else 2 * at + 1
                return at - self.leaves
            at >>= 1
        return None


def best_fit(sizes: list[int], width: int) -> list[list[int]]:
    """Positions of ``sizes`` by row; every size is from 1 to ``width``."""
    free = Capacities(width)
    by_capacity: dict[int, list[int]] = {}
    rows: list[list[int]] = []
    for i in sorted(range(len(sizes)), key=lambda i: -sizes[i]):
        capacity = free.least(sizes[i])
        if capacity is None:
            row, capacity = len(rows), width
            rows.append([])
        else:
            row = by_capacity[capacity].pop()
            free.change(capacity, -1)
        rows[row].append(i)
        left = capacity - sizes[i]
        by_capacity.setdefault(left, []).append(row)
        free.change(left, 1)
    return rows


def packed_rows(
    docs: DataFrame,
    text: str = "text",
    doc_id: str = "doc_id",
    tokenizer: str | None = None,
    end_id: int = 0,
    pad_id: int = 0,
    width: int = WIDTH,
) -> DataFrame:
    """One row per row of the matrix; ``tokenizer`` is a file that every executor has."""
    path = tokenizer or public_tokenizers.path("byte_bpe_50k.json")
    end = np.array([end_id], "<u4").tobytes()
    pad = np.array([pad_id], "<u4").tobytes()

    def pack(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        encode = encoder(path)
        numbers = count(TaskContext.get().partitionId() << 40)
        climb = np.arange(width, dtype="<i4")
        full_positions = climb.tobytes()

        def row(pieces: list[tuple]) -> tuple:
            sizes = [len(p[2]) // 4 for p in pieces]
            n = sum(sizes)
            ids = b"".join([p[2] for p in pieces] + [pad] * (width - n))
            if len(pieces) == 1 and n == width:
                positions = full_positions
            else:
                places = np.zeros(width, "<i4")
                places[:n] = np.concatenate([climb[:s] for s in sizes])
                positions = places.tobytes()
            ends = np.cumsum([0, *sizes]).tolist()
            return next(numbers), n, ids, positions, ends, [p[0] for p in pieces], [p[1] for p in pieces]

        def out(rows: list[tuple]) -> pd.DataFrame:
            return pd.DataFrame(rows, columns=_COLUMNS)

        block, held, rows = [], 0, []
        for batch in batches:
            for doc, body in zip(batch["doc_id"], batch["text"], strict=True):
                doc = None if doc is None else int(doc)
                data = encode(body) + end
                for at in range(0, len(data), 4 * width):
                    piece = (doc, at // 4, data[at : at + 4 * width])
                    if len(piece[2]) == 4 * width:
                        rows.append(row([piece]))
                    else:
                        block.append(piece)
                        held += len(piece[2]) // 4
                if held >= BLOCK_IDS:
                    fits = best_fit([len(p[2]) // 4 for p in block], width)
                    rows += [row([block[i] for i in group]) for group in fits]
                    block, held = [], 0
                if len(rows) >= 500:
                    yield out(rows)
                    rows = []
        fits = best_fit([len(p[2]) // 4 for p in block], width)
        rows += [row([block[i] for i in group]) for group in fits]
        if rows:
            yield out(rows)

    # ids go as text: beside nulls pandas would make large whole numbers inexact
    rows = docs.select(F.col(doc_id).cast("string").alias("doc_id"), text_of(text).alias("text"))
    return rows.mapInPandas(pack, ROWS)


def write_matrix(packed: DataFrame, path: str, rows_per_file: int = 65_536) -> None:
    """Writes the rows as files of at most ``rows_per_file`` rows; binary columns are the matrix."""
    packed.write.option("maxRecordsPerFile", rows_per_file).parquet(path)

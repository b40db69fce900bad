"""Packing by Karmarkar-Karp multiway differencing.

A document's ids, with the end id appended, are cut at multiples of the window size: full windows
need no packing. What is left of documents is cut to at most ``grain`` ids and packed in blocks.
In a block every piece starts as a partition of k windows with one window filled; the two
partitions with the largest spread are merged, the fullest windows of one with the emptiest of
the other, until one is left, whose windows are nearly equal. If one of them exceeds the window
size the number of windows rises and the block is packed again; it starts from the least
number that can hold the block.

Packing needs no shuffle: a block is filled from the rows of one task and holds ``BLOCK_WINDOWS``
windows, so memory and time per block are bounded, a hot source or group of copies is just more
blocks, and only the last block of a task is small. Window ids are unique: the task's partition in the
upper bits. They depend on how the input is split; rows of a task come in the order of its
input, so a repeated task repeats its windows.

Defined results: a null text counts as empty and has the end id only; a null doc_id stays
null; repeated rows are packed once each; an empty table gives an empty result.
"""

from __future__ import annotations

import heapq
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

WINDOW = 1024
GRAIN = 256
#: Windows in a block.
BLOCK_WINDOWS = 128

PIECES = (
    "doc_id long, start long, length long, ids binary, doc_tokens long, sequence_id long, offset long"
)
_COLUMNS = ["doc_id", "start", "length", "ids", "doc_tokens", "sequence_id", "offset"]


def difference(sizes: list[int], k: int) -> list[list[int]]:
    """Positions of ``sizes`` in k groups of nearly equal sums."""
    order = count()
    heap, merged = [], []  # merged: pairs of nodes; a node below len(sizes) is a piece
    for i, size in enumerate(sizes):
        sums, nodes = np.zeros(k, np.int64), np.full(k, -1)
        sums[-1], nodes[-1] = size, i
        heap.append((-size, next(order), sums, nodes))
    heapq.heapify(heap)
    while len(heap) > 1:
        _, _, sums, nodes = heapq.heappop(heap)
        _, _, other, theirs = heapq.heappop(heap)
        sums, theirs = sums + other[::-1], theirs[::-1]
        joint = np.where(nodes < 0, theirs, nodes)
        for at in np.flatnonzero((nodes >= 0) & (theirs >= 0)).tolist():
            merged.append((int(nodes[at]), int(theirs[at])))
            joint[at] = len(sizes) + len(merged) - 1
        by_sum = np.argsort(sums, kind="stable")
        sums = sums[by_sum]
        sums -= sums[0]
        heapq.heappush(heap, (-int(sums[-1]), next(order), sums, joint[by_sum]))
    groups = []
    for node in heap[0][3].tolist() if heap else ():
        stack, group = [node] if node >= 0 else [], []
        while stack:
            at = stack.pop()
            if at < len(sizes):
                group.append(at)
            else:
                stack += merged[at - len(sizes)]
        groups.append(group)
    return groups


def fill_windows(sizes: list[int], window: int = WINDOW) -> list[list[int]]:
    """The least number of windows that differencing needs so that none exceeds its size."""
    k = -(-sum(sizes) // window)
    while True:
        groups = difference(sizes, k)
        over = sum(max(0, sum(sizes[i] for i in group) - window) for group in groups)
        if not over:
            return [sorted(group) for group in groups if group]
        k += max(1, -(-over // window))


def pack_documents(
    docs: DataFrame,
    text: str = "text",
    doc_id: str = "doc_id",
    tokenizer: str | None = None,
    end_id: int = 0,
    window: int = WINDOW,
    grain: int = GRAIN,
) -> DataFrame:
    """One row per piece: the document, where the piece lies in it and in which window.

    ``ids`` holds the piece's ids as little-endian unsigned 32-bit numbers. ``tokenizer`` is a
    file that every executor has.
    """
    path = tokenizer or public_tokenizers.path("byte_bpe_50k.json")
    end = np.array([end_id], "<u4").tobytes()

    def pack(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        encode = encoder(path)
        ids = count(TaskContext.get().partitionId() << 40)
        rows, block, held = [], [], 0
        for batch in batches:
            for doc, body in batch.itertuples(index=False):
                doc = None if doc is None else int(doc)
                data = encode(body) + end
                n = len(data) // 4
                full = n - n % window
                for at in range(0, full, window):
                    part = data[4 * at : 4 * (at + window)]
                    rows.append((doc, at, window, part, n, next(ids), 0))
                for at in range(full, n, grain):
                    part = data[4 * at : 4 * (at + grain)]
                    block.append((doc, at, len(part) // 4, part, n))
                held += n - full
                if held >= BLOCK_WINDOWS * window:
                    rows += _placed(block, ids, window)
                    block, held = [], 0
                if len(rows) >= 4000:
                    yield _frame(rows)
                    rows = []
        if block:
            rows += _placed(block, ids, window)
        if rows:
            yield _frame(rows)

    # ids go as text: beside nulls pandas would make large whole numbers inexact
    rows = docs.select(F.col(doc_id).cast("string").alias("doc_id"), text_of(text).alias("text"))
    return rows.mapInPandas(pack, PIECES)


def _placed(block: list[tuple], ids: Iterator[int], window: int) -> Iterator[tuple]:
    for group in fill_windows([piece[2] for piece in block], window):
        sequence, offset = next(ids), 0
        for i in group:
            yield (*block[i], sequence, offset)
            offset += block[i][2]


def _frame(rows: list[tuple]) -> pd.DataFrame:
    ids = pd.array([row[0] for row in rows], "Int64")
    frame = pd.DataFrame([row[1:] for row in rows], columns=_COLUMNS[1:])
    frame.insert(0, "doc_id", ids)
    return frame

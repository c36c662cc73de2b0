"""Best-fit packing by hierarchical residual packing.

Documents become pieces of at most `capacity` tokens. Every partition packs its own pieces best-fit in decreasing order
and emits the bins that are nearly full. What is underfull goes on as one item each, members kept in place, to the next
round, where fewer partitions pack those items best-fit again, up to the root of the tree. A round never hands one task
more than `task_items` items: if so many are left, the tree stays as wide as they need and is dealt anew for a few rounds.

Defined results: a null or empty text has only its end token; repeated rows and null ids are packed like any others;
an empty table gives no rows; other columns are not read. The order of the input changes sequence ids, never coverage.
"""

from __future__ import annotations

import math
import zlib

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import stash, texts_of, tidy
from .tokens import encoder

CAPACITY, END_ID = 4096, 1
#: A bin with at most this many free tokens is final before the root.
SLACK = 8
FAN_IN, TASK_ITEMS = 8, 100_000
#: Pieces of text that the encoder remembers in each of two generations.
MEMO = 200_000
MEMBER = "struct<doc_id:bigint,piece:int,start:bigint,length:bigint,ids_crc32:bigint>"
BINS = f"fill int, done boolean, members array<{MEMBER}>"
PIECE = "doc_id long, piece int, start long, length long, ids_crc32 long"


def _pieces(path: str, kind: str, capacity: int, end_id: int):
    tail = end_id.to_bytes(4, "little")

    def run(batches):
        enc = encoder(path, kind, MEMO)
        for b in batches:
            cols = [[], [], [], [], []]
            for doc, ids in zip(b.column("doc_id").to_pylist(), map(enc.encode, texts_of(b.column("text")))):
                ids += tail
                for piece, at in enumerate(range(0, len(ids), 4 * capacity)):
                    part = ids[at : at + 4 * capacity]
                    for c, v in zip(cols, (doc, piece, at // 4, len(part) // 4, zlib.crc32(part))):
                        c.append(v)
            kinds = (pa.int64(), pa.int32(), pa.int64(), pa.int64(), pa.int64())
            yield pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(cols, kinds)], names=["doc_id", "piece", "start", "length", "ids_crc32"])

    return run


def token_pieces(docs: DataFrame, tokenizer: str, kind: str = "word", capacity: int = CAPACITY, end_id: int = END_ID) -> DataFrame:
    """doc_id, piece, start, length, ids_crc32 of the pieces of every document; only longer documents are cut."""
    return docs.select("doc_id", "text").mapInArrow(_pieces(tokenizer, kind, capacity, end_id), PIECE)


def best_fit(sizes: list[int], capacity: int) -> list[list[int]]:
    """Item numbers by bin, best fit in decreasing order; one bit for each free size tells which bins are open."""
    order = sorted(range(len(sizes)), key=lambda i: -sizes[i])
    bins: list[list[int]] = []
    free: list[list[int]] = [[] for _ in range(capacity + 1)]
    open_sizes = 0
    for i in order:
        size = sizes[i]
        fits = open_sizes >> size
        if fits:
            room = size + (fits & -fits).bit_length() - 1
            b = free[room].pop()
            if not free[room]:
                open_sizes &= ~(1 << room)
            bins[b].append(i)
        else:
            room, b = capacity, len(bins)
            bins.append([i])
        if room > size:
            free[room - size].append(b)
            open_sizes |= 1 << (room - size)
    return bins


def _round(capacity: int, slack: int, last: bool):
    """Pack a partition's items (fill, members); done: nearly full, or the last round."""

    def run(batches):
        fills, members = [], []
        for b in batches:
            if "members" in b.schema.names:
                fills += b.column("fill").to_pylist()
                members += b.column("members").to_pylist()
            else:
                fills += b.column("length").to_pylist()
                members += [[x] for x in b.to_pylist()]
        bins = best_fit(fills, capacity)
        for lo in range(0, len(bins), 2000):
            part = bins[lo : lo + 2000]
            fill = [sum(fills[i] for i in b) for b in part]
            yield pa.RecordBatch.from_arrays(
                [pa.array(fill, pa.int32()), pa.array([last or f >= capacity - slack for f in fill], pa.bool_()),
                 pa.array([[m for i in b for m in members[i]] for b in part], pa.list_(pa.struct([("doc_id", pa.int64()), ("piece", pa.int32()), ("start", pa.int64()), ("length", pa.int64()), ("ids_crc32", pa.int64())])))],
                names=["fill", "done", "members"])

    return run


def pack(pieces: DataFrame, capacity: int = CAPACITY, slack: int = SLACK, fan_in: int = FAN_IN, task_items: int = TASK_ITEMS) -> DataFrame:
    """The pieces with sequence_id and offset: a tree of best-fit rounds, each written in the shared folder."""
    return _merge(pieces.mapInArrow(_round(capacity, slack, False), BINS), capacity, slack, fan_in, task_items)


def _merge(leaves: DataFrame, capacity: int, slack: int, fan_in: int, task_items: int) -> DataFrame:
    """The rounds after the first, whose bins `leaves` has."""
    parts = max(1, leaves.rdd.getNumPartitions())
    level = stash(leaves, "bins-0")
    finished, wide_rounds = [level.filter("done")], 0
    while True:
        left = level.filter("NOT done")
        n = left.count()
        if not n:
            break
        least = math.ceil(n / task_items)
        parts = max(least, math.ceil(parts / fan_in))
        wide_rounds += parts == least > 1
        last = parts == 1 or wide_rounds > 3
        level = stash(left.select("fill", "members").repartition(parts).mapInArrow(_round(capacity, slack, last), BINS), "bins")
        finished.append(level.filter("done"))
        if last:
            break
    done = finished[0]
    for x in finished[1:]:
        done = done.unionByName(x)
    # written tables only from here on, so the ids are the same in every attempt of a task
    def place(batches):
        for b in batches:
            members = b.column("members")
            sizes, flat = np.diff(members.offsets.to_numpy()), members.flatten()
            length = flat.field("length").to_numpy()
            ends = np.cumsum(length)
            first = np.concatenate(([0], np.cumsum(sizes)))[:-1]
            offset = ends - length - np.repeat((ends - length)[first] if len(first) else ends, sizes)
            yield pa.RecordBatch.from_arrays(
                [*flat.flatten(), b.column("sequence_id").take(pa.array(np.repeat(np.arange(b.num_rows), sizes))), pa.array(offset, pa.int64())],
                names=["doc_id", "piece", "start", "length", "ids_crc32", "sequence_id", "offset"])

    return done.select(F.monotonically_increasing_id().alias("sequence_id"), "members").mapInArrow(place, f"{PIECE}, sequence_id long, offset long")


def pack_documents(docs: DataFrame, tokenizer: str, kind: str = "word", capacity: int = CAPACITY, end_id: int = END_ID) -> DataFrame:
    """Encode, cut and pack the documents; encoding and the first round share one Python worker a task."""
    cut, fit = _pieces(tokenizer, kind, capacity, end_id), _round(capacity, SLACK, False)
    leaves = docs.select("doc_id", "text").mapInArrow(tidy(lambda batches: fit(cut(batches)), lambda: encoder(tokenizer, kind, MEMO).forget_older()), BINS)
    return _merge(leaves, capacity, SLACK, FAN_IN, TASK_ITEMS)

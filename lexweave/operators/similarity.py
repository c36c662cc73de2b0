"""Vector joins in blocks: packed matrices meet, never pairs of rows."""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from lexweave.plans.cut import stash

BLOCK = 2048


#: Rows of a written file of blocks, so that a split of the table holds whole files and tasks are many.
FILE_ROWS = 8192


def _pack(batches):
    for b in batches:
        sizes = np.array([len(v) for v in b.column("vector").to_pylist()])
        for at in (x[lo : lo + BLOCK] for d in np.unique(sizes) for x in [np.flatnonzero(sizes == d)] for lo in range(0, len(x), BLOCK)):
            p = b.take(pa.array(at))
            v = np.array(p.column("vector").to_pylist(), np.float64).reshape(p.num_rows, -1)
            n = np.linalg.norm(v, axis=1)
            v = v / np.where(n == 0, 1, n)[:, None]
            ids = p.column("id").to_numpy(zero_copy_only=False).astype(np.int64)
            yield pa.RecordBatch.from_arrays([pa.array([v.shape[1]], pa.int32()), pa.array([ids.min()]), pa.array([ids.max()]), pa.array([ids.tobytes()]), pa.array([v.tobytes()])], names=["dim", "low", "high", "ids", "matrix"])


def _packed(df: DataFrame) -> DataFrame:
    rows = df.select("id", "vector").filter("id IS NOT NULL AND size(vector) > 0")
    dealt = rows.repartitionByRange(max(1, -(-rows.count() // FILE_ROWS)), "id")
    return dealt.mapInArrow(_pack, "dim int, low long, high long, ids binary, matrix binary")


def _best(own: np.ndarray, found: list[tuple], k: int) -> tuple:
    """Of (row, right id, similarity) arrays the k best of each row by similarity to 9 places and right id, and each row's least of k."""
    i, j, s = (np.concatenate(x) for x in zip(*found))
    key = np.round(s, 9)
    order = np.lexsort((j, -key, i))
    i, j, s, key = i[order], j[order], s[order], key[order]
    rank = np.arange(len(i)) - np.searchsorted(i, i)
    least = np.full(len(own), -np.inf)
    least[i[rank == k - 1]] = key[rank == k - 1]
    return (i[rank < k], j[rank < k], s[rank < k]), least


def _match(k: int | None, least: float, triangular: bool, with_self: bool):
    def run(batches):
        at, li, best, cut = None, None, None, None
        rows = lambda i, j, s: pa.RecordBatch.from_arrays([pa.array(li[i]), pa.array(j), pa.array(s), pa.array(np.round(s, 9))], names=["left_id", "right_id", "similarity", "key"])
        for b in batches:
            for r in (b.slice(x, 1).to_pylist()[0] for x in range(b.num_rows)):
                if at != r["l_ids"]:  # the rows of a task come left block by left block
                    if best is not None:
                        yield rows(*best)
                    at, li, best, cut = r["l_ids"], np.frombuffer(r["l_ids"], np.int64), None, None
                    lv = np.frombuffer(r["l_matrix"], np.float64).reshape(-1, r["l_dim"])
                ri, rv = np.frombuffer(r["r_ids"], np.int64), np.frombuffer(r["r_matrix"], np.float64).reshape(-1, r["l_dim"])
                s = lv @ rv.T
                ok = s >= least
                if triangular:
                    ok &= li[:, None] < ri
                elif not with_self:
                    ok &= li[:, None] != ri
                if k is not None and cut is not None:
                    ok &= s >= cut[:, None] - 2e-9
                elif k is not None and s.shape[1] > k:
                    masked = np.where(ok, s, -2.0)
                    ok &= masked >= np.partition(masked, s.shape[1] - k, axis=1)[:, s.shape[1] - k][:, None] - 2e-9
                i, j = np.nonzero(ok)
                if k is None:
                    yield rows(i, ri[j], s[i, j])
                else:
                    best, cut = _best(li, [*([] if best is None else [best]), (i, ri[j], s[i, j])], k)
        if best is not None:
            yield rows(*best)

    return run


FOUND = "left_id long, right_id long, similarity double, key double"


def similarity_join(left: DataFrame, right: DataFrame, least: float = 0.85, k: int | None = None, triangular: bool = False, with_self: bool = False) -> DataFrame:
    """(left_id, right_id, similarity) of the pairs of (id, vector) with cosine >= least; with k, each left's best k.

    The written blocks meet as splits of two tables, every left split with every right one: a task reads its two, so blocks
    are copied by no shuffle and a task holds one right split. With k a task keeps the best of a left block over its whole
    right split. Triangular pairs of blocks whose ids can't fit are left out. Ties, to 9 places, go to the smaller right_id.
    A table that meets itself is packed and written once.
    """
    packed = stash(_packed(left), "left-blocks")
    side = lambda blocks, name: blocks.select(*(F.col(c).alias(f"{name}_{c}") for c in blocks.columns))
    ls, rs = side(packed, "l"), side(packed if right is left else stash(_packed(right), "right-blocks"), "r")
    fits = F.col("l_dim") == F.col("r_dim")
    cells = ls.join(rs.hint("shuffle_replicate_nl"), fits & (F.col("l_low") < F.col("r_high")) if triangular else fits)
    found = cells.select("l_dim", "l_ids", "l_matrix", "r_ids", "r_matrix").mapInArrow(_match(k, least, triangular, with_self), FOUND)
    best = found if k is None else top_per(found, ["left_id"], [F.desc("key"), F.asc("right_id")], k)
    return best.drop("key")


def top_per(df: DataFrame, keys: list[str], order: list, k: int) -> DataFrame:
    return df.withColumn("__rank", F.row_number().over(Window.partitionBy(*keys).orderBy(*order))).filter(F.col("__rank") <= k).drop("__rank")

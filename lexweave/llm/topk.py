"""Exact top-k search by exhaustive term-at-a-time accumulation.

Vectors are sparse rows of (term, integer weight). Candidates are dealt evenly into blocks whose postings list, for each
term, the rows that hold it; query rows are dealt into blocks of their own, GROUP of which make a query group. A cell of the
grid (candidate block, query group) is one task: the candidate block is read once and the group's query blocks stream past
it. Each query term scatters its weighted postings into a dense array of scores, a partition selection keeps the k best of
every query, and the cells' lists are merged by rank. Every query meets every candidate once; rows travel in packed blocks,
never as pairs. Blocks hold at most BLOCK_WEIGHTS weights, in 16, 32 or 64 bits as they need, so a cell's memory is bounded.

Scores are exact: sums that may pass 64 bits are added up as whole numbers of any size. A weight or score beyond a long is
given as the nearest long.

Defined results: vectors that are null, or hold a null or non-finite component, take no part; a shorter vector is zero in
its missing terms; ties go to the smaller id; a query's own row is every row with its id, so repeated rows of a query are
left out too, and each repeated query row gets a list of its own; null ids take no part; an empty table gives no rows.
"""

from __future__ import annotations

import math

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from .common import stash

CANDIDATES, QUERIES, GROUP, TILE = 8192, 1024, 8, 128
#: Weights in a block of candidates; blocks of queries hold as many fewer as they have rows fewer.
BLOCK_WEIGHTS = 4_000_000
BLOCK = "block int, n long, bits int, ids binary, indptr binary, terms binary, weights binary"
LONG = np.iinfo(np.int64).max
FOUND = "query_block int, query_row int, query_id long, vec_id long, place long, score long"


def quantised(df: DataFrame, vector: str = "embedding", scale: float = 64.0) -> DataFrame:
    """(vec_id, weights): floor(scale * x) of each component of the vectors that are whole."""
    v = F.col(vector)
    whole = v.isNotNull() & F.forall(v, lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf"))) & F.col("vec_id").isNotNull()
    return df.filter(whole).select("vec_id", F.transform(v, lambda x: F.floor(F.lit(scale) * x.cast("double")).cast("long")).alias("weights"))


def _pack(batches):
    """All rows of a partition as one block, sorted by id: row pointers, terms and weights of what is not zero."""
    ids, lens, flat = [], [], []
    for b in batches:
        ids.append(b.column("vec_id").to_numpy(zero_copy_only=False).astype(np.int64))
        w = b.column("weights")
        lens.append(np.diff(w.offsets.to_numpy()).astype(np.int64))
        flat.append(w.flatten().to_numpy(zero_copy_only=False).astype(np.int64))
    if not ids or not sum(map(len, ids)):
        return
    ids, lens, flat = (np.concatenate(x) for x in (ids, lens, flat))
    starts = np.concatenate(([0], np.cumsum(lens)))
    terms = np.arange(len(flat)) - np.repeat(starts[:-1], lens)
    rows = np.repeat(np.arange(len(ids)), lens)
    place = np.empty(len(ids), np.int64)
    order = np.argsort(ids, kind="stable")
    place[order] = np.arange(len(ids))
    keep = flat != 0
    rows, terms, flat = place[rows[keep]], terms[keep], flat[keep]
    by = np.lexsort((terms, rows))
    indptr = np.concatenate(([0], np.cumsum(np.bincount(rows, minlength=len(ids)))))
    block = TaskContext.get().partitionId()
    most = max((abs(int(f(flat))) for f in (np.min, np.max)), default=0) if len(flat) else 0
    bits = 16 if most < 2**15 else 32 if most < 2**31 else 64
    values = [block, len(ids), bits, ids[order].tobytes(), indptr.astype(np.int64).tobytes(), terms[by].astype(np.int32).tobytes(), flat[by].astype(f"i{bits // 8}").tobytes()]
    kinds = [pa.int32(), pa.int64(), pa.int32(), *[pa.binary()] * 4]
    yield pa.RecordBatch.from_arrays([pa.array([v], t) for v, t in zip(values, kinds)], names=["block", "n", "bits", "ids", "indptr", "terms", "weights"])


def blocks(vectors: DataFrame, rows: int) -> tuple[DataFrame, int]:
    """vectors dealt evenly into packed blocks of about `rows` rows, fewer if they are long; and the number of blocks."""
    n, weights = vectors.agg(F.count("*"), F.coalesce(F.sum(F.size("weights").cast("long")), F.lit(0))).first()
    made = max(1, math.ceil(n / rows), math.ceil(weights / (BLOCK_WEIGHTS * rows / CANDIDATES)))
    return stash(vectors.repartition(made).mapInArrow(_pack, BLOCK), "blocks"), made


def _csr(row: dict):
    a = lambda c, t: np.frombuffer(row[c], t)
    return a("ids", np.int64), a("indptr", np.int64), a("terms", np.int32), a("weights", f"i{row['bits'] // 8}")


class Postings:
    """A candidate block by term, ready for query blocks."""

    def __init__(self, cand):
        self.ids, ptr, terms, weights = cand
        by = np.argsort(terms, kind="stable")
        self.n, self.rows, self.weights = len(self.ids), np.repeat(np.arange(len(self.ids)), np.diff(ptr))[by], weights[by]
        self.terms = int(terms.max(initial=-1)) + 1
        self.bounds = np.searchsorted(terms[by], np.arange(self.terms + 1))
        self.most = _most(weights)

    def scores(self, query, lo: int, hi: int, kind) -> np.ndarray:
        """Scores of query rows lo to hi against every candidate, accumulated term by term."""
        _, q_ptr, q_terms, q_w = query
        own = slice(q_ptr[lo], q_ptr[hi])
        weights = np.zeros((hi - lo, max(self.terms, int(q_terms[own].max(initial=-1)) + 1)), kind)
        weights[np.repeat(np.arange(hi - lo), np.diff(q_ptr[lo : hi + 1])), q_terms[own]] = q_w[own]
        scores = np.zeros((hi - lo, self.n), kind)
        for t in np.unique(q_terms[own]):
            if t >= self.terms:
                break
            a, b = self.bounds[t], self.bounds[t + 1]
            if 2 * (b - a) > self.n:  # most rows hold the term: its postings as one dense row
                dense = np.zeros(self.n, kind)
                dense[self.rows[a:b]] = self.weights[a:b]
                scores += weights[:, t, None] * dense
            elif a < b:
                scores[:, self.rows[a:b]] += weights[:, t, None] * self.weights[a:b].astype(kind)
        return scores


def _most(weights: np.ndarray) -> int:
    return max(abs(int(weights.min())), abs(int(weights.max()))) if len(weights) else 0


def accumulate(query, cand: Postings, k: int, tile: int = TILE):
    """Best k of one candidate block for each query row: (query row, candidate place, score) arrays."""
    q_ids, q_ptr, q_terms, q_w = query
    n, bits = cand.n, max(cand.n - 1, 1).bit_length()
    # in whole numbers of any size: the greatest sum a score can have
    most = _most(q_w) * cand.most * max(cand.terms, 1)
    kind = np.int32 if most < 2**31 else np.int64 if most <= LONG else object
    out = []
    for lo in range(0, len(q_ids), tile):
        hi = min(lo + tile, len(q_ids))
        scores = cand.scores(query, lo, hi, kind)
        if kind is object:
            scores = np.clip(scores, -LONG, LONG)
        scores = scores.astype(np.int64)
        taken = np.zeros((hi - lo, n), bool)
        for i, (x, y) in enumerate(zip(np.searchsorted(cand.ids, q_ids[lo:hi]), np.searchsorted(cand.ids, q_ids[lo:hi], "right"))):
            taken[i, x:y] = True
        if k >= n:
            top = np.tile(np.arange(n), (hi - lo, 1))
        elif most < 2 ** (62 - bits):  # score and place fit in one number
            key = (scores << bits) + (n - 1 - np.arange(n))
            key[taken] = np.iinfo(np.int64).min
            top = np.argpartition(~key, k - 1, axis=1)[:, :k]
        else:
            key = scores.copy()
            key[taken] = np.iinfo(np.int64).min
            top = np.argsort(~key, axis=1, kind="stable")[:, :k]  # ~ turns the order without overflow; equal scores stay by place
        r = np.repeat(np.arange(hi - lo), top.shape[1])
        top = top.ravel()
        ok = ~taken[r, top]
        out.append((r[ok] + lo, top[ok], scores[r[ok], top[ok]]))
    return tuple(np.concatenate(x) for x in zip(*out)) if out else tuple(np.zeros(0, np.int64) for _ in range(3))


def _cell(k: int):
    def run(query_group: pa.Table, candidates: pa.Table) -> pa.Table:
        cols = [[] for _ in range(6)]
        for c in candidates.to_pylist():
            cand = Postings(_csr(c))
            for row in query_group.to_pylist():
                query = _csr(row)
                r, place, score = accumulate(query, cand, k)
                for col, v in zip(cols, (np.full(len(r), row["block"]), r, query[0][r], cand.ids[place], place + (c["block"] << 32), score)):
                    col.append(v)
        kinds = (pa.int32(), pa.int32(), pa.int64(), pa.int64(), pa.int64(), pa.int64())
        return pa.table([pa.array(np.concatenate(c) if c else np.zeros(0, np.int64), t) for c, t in zip(cols, kinds)], names=["query_block", "query_row", "query_id", "vec_id", "place", "score"])

    return run


def top_k(queries: DataFrame, candidates: DataFrame, k: int = 20, candidate_rows: int = CANDIDATES, query_rows: int = QUERIES) -> DataFrame:
    """query_id, rank, vec_id, score of the k best candidates of every query; both inputs are (vec_id, weights)."""
    (q, nq), (c, nc) = blocks(queries, query_rows), blocks(candidates, candidate_rows)
    groups = math.ceil(nq / GROUP)
    # one packed copy of a candidate block for every query group, one of a query block for every candidate block
    cells = min(nc * groups, 100_000)
    qs = q.withColumn("g", F.floor(F.col("block") / GROUP).cast("int")).withColumn("c", F.explode(F.sequence(F.lit(0), F.lit(nc - 1)))).repartition(cells, "c", "g")
    cs = c.withColumn("c", F.col("block")).withColumn("g", F.explode(F.sequence(F.lit(0), F.lit(groups - 1)))).repartition(cells, "c", "g")
    found = qs.groupBy("c", "g").cogroup(cs.groupBy("c", "g")).applyInArrow(_cell(k), FOUND)
    w = Window.partitionBy("query_block", "query_row").orderBy(F.desc("score"), "vec_id", "place")
    best = found.withColumn("rank", F.row_number().over(w)).filter(F.col("rank") <= k)
    return best.select("query_id", "rank", "vec_id", "score")

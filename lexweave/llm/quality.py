"""Quality classifier: a factorisation machine.

Features of a text are its words hashed into 2^15 columns (log counts, unit length), the hashed words' own shape, and
columns for statistics of its structure (letter case, symbols, repetition, line and word lengths) and metadata (its
length). The machine adds a global weight, a weight for each feature and the pairwise interactions of all features, each
pair's strength the inner product of two low-rank vectors, evaluated in time linear in the features by the sum-of-squares
identity: 1/2 * sum_f ((sum_i v_if x_i)^2 - sum_i v_if^2 x_i^2).

It is trained here by AdaGrad on at most PER_CLASS labelled documents of each class (lowest hash of the id); scoring
reads every word of every text. The score is a logistic of the machine's value, calibrated to the labelled rows' shares.

Defined results: null and empty texts are scored from their statistics (all zero); repeated rows score alike; rows with a
null doc_id are scored and held_out is null; no labelled rows at all give the score 0.5; other columns are not read.
"""

from __future__ import annotations

import re
import zlib

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import texts_of

PER_CLASS = 3000
COLUMNS, STATS, RANK, MEMO = 2**15, 14, 8, 150_000
EPOCHS, RATE, L2 = 6, 0.05, 1e-5
_TOKEN = re.compile(rb"[^\x20\x09-\x0D]+")

_memo: dict[bytes, int] = {}


def text_features(text: str) -> tuple[np.ndarray, np.ndarray]:
    """(columns, values): hashed words, then the statistics at COLUMNS and up."""
    raw = text.encode()
    words = raw.split()
    if len(_memo) > MEMO:
        _memo.clear()
    for w in set(words):
        if w not in _memo:
            _memo[w] = zlib.crc32(w.lower()) % COLUMNS
    n = len(words)
    stats = np.zeros(STATS)
    if n:
        ids = np.fromiter(map(_memo.__getitem__, words), np.int64, n)
        cols, counts = np.unique(ids, return_counts=True)
        vals = np.log1p(counts)
        vals /= np.sqrt((vals**2).sum())
        a = np.frombuffer(raw, np.uint8)
        letters = max(1, int(((a >= 65) & (a <= 90) | (a >= 97) & (a <= 122) | (a >= 128)).sum()))
        lines = [x for x in raw.split(b"\n") if x.strip()]
        longest = np.fromiter(map(len, words), np.int64, n)
        stats[:] = (
            1.0, ((a >= 65) & (a <= 90)).sum() / letters, np.isin(a, np.frombuffer(b"#*$%&|<>{}[]=~^_\\", np.uint8)).sum() / n, ((a >= 48) & (a <= 57)).sum() / len(a),
            np.isin(a, np.frombuffer(b"!?", np.uint8)).sum() / n, np.isin(a, np.frombuffer(b".,;:", np.uint8)).sum() / n, len(set(words)) / n, (ids[1:] == ids[:-1]).mean() if n > 1 else 0.0,
            1 - len(set(lines)) / max(1, len(lines)), longest.mean() / 10, longest.std() / 10, np.log1p(n) / 10, np.log1p(n / max(1, len(lines))) / 5,
            counts.max() / n,
        )
        stats[1:] = np.minimum(stats[1:], 3.0)
    else:
        cols, vals = np.zeros(0, np.int64), np.zeros(0)
        stats[0] = 1.0
    return np.concatenate((cols, COLUMNS + np.arange(STATS))).astype(np.int32), np.concatenate((vals, stats)).astype(np.float32)


class Machine:
    def __init__(self, rank: int = RANK, seed: int = 7):
        rng = np.random.default_rng(seed)
        size = COLUMNS + STATS
        self.bias, self.w, self.v = 0.0, np.zeros(size, np.float32), (rng.standard_normal((size, rank)) * 0.01).astype(np.float32)

    def value(self, cols: np.ndarray, x: np.ndarray) -> float:
        v = self.v[cols] * x[:, None]
        s = v.sum(0)
        return float(self.bias + self.w[cols] @ x + 0.5 * (s @ s - (v * v).sum()))

    def fit(self, rows: list[tuple[np.ndarray, np.ndarray, int]], epochs: int = EPOCHS, rate: float = RATE, l2: float = L2, seed: int = 11) -> "Machine":
        """AdaGrad over single rows in a fixed shuffled order; classes weigh alike."""
        rng = np.random.default_rng(seed)
        gb, gw, gv = 1e-2, np.full_like(self.w, 1e-2), np.full_like(self.v, 1e-2)
        ones = sum(r[2] for r in rows)
        weight = (len(rows) / max(2 * (len(rows) - ones), 1), len(rows) / max(2 * ones, 1))
        for _ in range(epochs):
            for i in rng.permutation(len(rows)):
                cols, x, y = rows[i]
                v = self.v[cols]
                s = x @ v
                z = self.bias + self.w[cols] @ x + 0.5 * (s @ s - ((v * x[:, None]) ** 2).sum())
                g = weight[y] * (1.0 / (1.0 + np.exp(-np.clip(z, -30, 30))) - y)
                gb += g * g
                self.bias -= rate * g / np.sqrt(gb)
                dw = g * x + l2 * self.w[cols]
                gw[cols] += dw * dw
                self.w[cols] -= rate * dw / np.sqrt(gw[cols])
                dv = g * (x[:, None] * s - v * (x * x)[:, None]) + l2 * v
                gv[cols] += dv * dv
                self.v[cols] -= rate * dv / np.sqrt(gv[cols])
        return self


def _featurise(batches):
    for b in batches:
        f = [text_features(t) for t in texts_of(b.column("text"))]
        yield pa.RecordBatch.from_arrays([b.column("doc_id"), pa.array([c.tobytes() for c, _ in f], pa.binary()), pa.array([x.tobytes() for _, x in f], pa.binary())], names=["doc_id", "cols", "vals"])


def _apply(machine, offset):
    def run(batches):
        m = machine.value
        for b in batches:
            z = np.array([m.value(*text_features(t)) for t in texts_of(b.column("text"))]) + offset
            yield pa.RecordBatch.from_arrays([b.column("doc_id"), pa.array(1.0 / (1.0 + np.exp(-np.clip(z, -40, 40))))], names=["doc_id", "score"])

    return run


def train(docs: DataFrame, labels: DataFrame, usable: str = "crc32(cast(doc_id AS string)) % 5 <> 0", per_class: int = PER_CLASS):
    """(machine, offset): the broadcast machine and the log odds of the labelled rows, as training weighs classes alike."""
    ids = labels.filter("doc_id IS NOT NULL AND quality IS NOT NULL").select("doc_id", "quality").filter(usable)
    h = F.xxhash64(F.col("doc_id"), F.lit(23))
    taken = [ids.filter(F.col("quality") == v).orderBy(h, "doc_id").limit(per_class) for v in (1, 0)]
    sample = F.broadcast(taken[0].unionByName(taken[1]))  # at most 2 * per_class ids
    rows = docs.select("doc_id", "text").join(sample.select("doc_id").distinct(), "doc_id", "left_semi").mapInArrow(_featurise, "doc_id long, cols binary, vals binary").join(sample, "doc_id").orderBy(h, "doc_id").toArrow().to_pylist()
    data = [(np.frombuffer(r["cols"], np.int32), np.frombuffer(r["vals"], np.float32), int(r["quality"])) for r in rows]
    machine = Machine()
    if data:
        machine.fit(data)
    else:
        machine.v[:] = 0.0  # untrained: every score is 0.5
    shares = {r["quality"]: r["n"] for r in ids.groupBy("quality").agg(F.count("*").alias("n")).collect()}
    offset = float(np.log((shares.get(1, 0) + 1) / (shares.get(0, 0) + 1)))
    return docs.sparkSession.sparkContext.broadcast(machine), offset if data else 0.0


def quality_scores(docs: DataFrame, labels: DataFrame, usable: str = "crc32(cast(doc_id AS string)) % 5 <> 0", per_class: int = PER_CLASS) -> DataFrame:
    """doc_id and score of every document."""
    machine, offset = train(docs, labels, usable, per_class)
    return docs.select("doc_id", "text").mapInArrow(_apply(machine, offset), "doc_id long, score double")

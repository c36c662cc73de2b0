"""Toxicity: class-conditional Kneser-Ney models of expressions.

An expression is a lower-cased word, written as a path of prefixes: 3, 4, 5 and 6 letters, then the word. Each class has a
model of its own: the probability of the next step given the prefix before it is the class's discounted document count,
and what the discounts take is dealt by a backoff that both classes share: continuation counts, the share of the distinct
words below a prefix that go on with the step. The steps from a prefix sum to 1 in each class. Discounts are estimated for
each class from its counts of counts (one for 1, one for 2, one for more); counts of at most CUTOFF documents go to the
backoff whole, so rare expressions are smoothed to the shared counts, and a new word on a prefix known as toxic still weighs.

A class with less text leaves more to its backoff, which alone would make every unseen word look like it. So a step's
log-likelihood is taken over the class's own backoff, ln(P(step) / (backoff weight * shared)), and the ratio of a word is
the toxic sum less the ordinary one. A passage of `window` words is as toxic as its length-normalised ratio. A text's
features are its most toxic passages (the best two that do not overlap) and the length-normalised ratio of the whole text; a
logistic curve, fitted on labelled rows whose counts are left out, maps them to a score.

The counts come from all labelled documents that may be used. The four weights of the curve come from at most PER_CLASS of
each class (lowest hash of the id), each scored by the counts of the other folds; scoring reads every word of every text.
Counts, discounts and steps are computed in Spark; the driver gets 24 bytes of each step whose ratio is not about 0.

Defined results: null and empty texts score like a text with no evidence; repeated rows score alike; rows with a null
doc_id are scored and held_out is null; no labelled rows at all give the score 0; other columns are not read.
"""

from __future__ import annotations

import re
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import stash, texts_of, tidy
from .ngramjoin import BROADCAST_IDS

PER_CLASS, FOLDS = 4000, 3
PREFIXES = (3, 4, 5, 6)
CUTOFF, WINDOW, MEMO = 2, 4, 150_000
#: Steps whose ratios are all smaller than this weigh nothing.
LEAST_RATIO = 0.02
#: No single expression lowers a passage by more than FLOOR: ordinary words beside a toxic expression do not excuse it.
FLOOR = 0.5
THRESHOLD = 0.3
_WORD = re.compile(r"[^\W_]+")
WORD_SQL = r"[\p{L}\p{N}]+"
#: The model of all folds, then the one that leaves each fold out.
VIEWS = (None, *range(FOLDS))


@dataclass
class KneserNey:
    """Ratio (toxic over ordinary) of every step: sorted 64-bit hashes of the steps, and their ratios."""

    steps: np.ndarray
    ratios: np.ndarray

    def at(self, keys: list[str]) -> list[float]:
        """The ratio of each step; 0 for one the model does not have."""
        import xxhash

        if not len(self.steps) or not keys:
            return [0.0] * len(keys)
        digest = xxhash.xxh64_intdigest
        h = np.fromiter((digest(k, 42) for k in keys), np.uint64, len(keys)).view(np.int64)
        place = np.minimum(np.searchsorted(self.steps, h), len(self.steps) - 1)
        return np.where(self.steps[place] == h, self.ratios[place], 0.0).tolist()

    def ratio(self, words: list[str], memo: dict | None = None) -> np.ndarray:
        """The ratio of each word, at least -FLOOR; `memo` keeps the sums of the prefixes' ratios."""
        memo = {} if memo is None else memo
        own = self.at(["=" + w for w in words])
        longest = [w[: next((k for k in reversed(PREFIXES) if len(w) > k), 0)] for w in words]
        new = {p for p in longest if p and p not in memo}
        if new:
            steps = {p[:k] for p in new for k in PREFIXES if k <= len(p)}
            value = dict(zip(steps, self.at(["<" + p for p in steps])))
            memo.update((p, sum(value[p[:k]] for k in PREFIXES if k <= len(p))) for p in new)
        memo[""] = 0.0
        return np.maximum(np.array(own) + np.fromiter(map(memo.__getitem__, longest), float, len(longest)), -FLOOR)


def features(ratios: np.ndarray, window: int = WINDOW) -> tuple[float, float, float]:
    """Best passage, best passage apart from it, and mean of the whole text."""
    n = len(ratios)
    if not n:
        return 0.0, 0.0, 0.0
    sums = np.convolve(ratios, np.ones(window))[: n + window - 1] / window
    best = int(sums.argmax())
    apart = np.concatenate((sums[: max(best - window + 1, 0)], sums[best + window :]))
    return float(sums[best]), float(apart.max(initial=0.0)), float(ratios.mean())


class _Scorer:
    """Features of texts; words are looked up together, and remembered."""

    def __init__(self, model: KneserNey):
        self.model, self.memo, self.prefixes = model, {}, {}

    def __call__(self, texts) -> np.ndarray:
        out, held, size = [], [], 0
        for t in texts:
            held.append(_WORD.findall(t.lower()))
            size += len(held[-1])
            if size > MEMO:
                out += self._held(held)
                held, size = [], 0
        return np.array(out + self._held(held)).reshape(-1, 3)

    def _held(self, held: list[list[str]]) -> list[tuple]:
        memo = self.memo
        if len(memo) > MEMO:
            memo.clear()
            self.prefixes.clear()
        new = [w for w in set().union(*held) if w not in memo]
        memo.update(zip(new, self.model.ratio(new, self.prefixes).tolist()))
        return [features(np.fromiter(map(memo.__getitem__, words), np.float64, len(words))) for words in held]


def _apply(model, curve):
    def run(batches):
        score = _Scorer(model.value)
        for b in batches:
            x = score(texts_of(b.column("text")))
            p = curve_value(x, curve)
            yield pa.RecordBatch.from_arrays([b.column("doc_id"), *(pa.array(x[:, k]) for k in range(3)), pa.array(p)], names=["doc_id", "passage", "second", "whole", "score"])

    return run


SCORES = "doc_id long, passage double, second double, whole double, score double"


def curve_value(x: np.ndarray, curve: np.ndarray) -> np.ndarray:
    z = _squash(x) @ curve
    return 1.0 / (1.0 + np.exp(-np.clip(z, -40, 40)))


def _squash(x: np.ndarray) -> np.ndarray:
    return np.column_stack((x[:, 0], x[:, 1], np.clip(x[:, 2], -1, 1), np.ones(len(x))))


def fit_curve(x: np.ndarray, y: np.ndarray, ridge: float = 1e-2, rounds: int = 50) -> np.ndarray:
    """Logistic regression by Newton steps; no rows or one class give a constant curve."""
    if not len(y) or y.min() == y.max():
        return np.array([0.0, 0.0, 0.0, -40.0 if not len(y) or y.max() == 0 else 40.0])
    a, w = _squash(x), np.zeros(4)
    for _ in range(rounds):
        p = 1.0 / (1.0 + np.exp(-np.clip(a @ w, -30, 30)))
        h = (a * (p * (1 - p))[:, None]).T @ a + ridge * np.eye(4)
        step = np.linalg.solve(h, a.T @ (y - p) - ridge * w)
        w = w + step
        if np.abs(step).max() < 1e-8:
            break
    return w


def bounded(labelled: DataFrame, label: str, per_class: int, keep: str) -> DataFrame:
    """At most per_class rows of each label that `keep` selects, by lowest hash of the id: two bounded top-n scans."""
    h = F.xxhash64(F.col("doc_id"), F.lit(17))
    parts = [labelled.filter(keep).filter(F.col(label) == v).orderBy(h, "doc_id").limit(per_class) for v in (1, 0)]
    return parts[0].unionByName(parts[1])


def _cross(models):
    def run(batches):
        steps, ratios = models.value
        scorers = [_Scorer(KneserNey(steps, ratios[f + 1])) for f in range(FOLDS)]
        for b in batches:
            for f in range(FOLDS):
                part = b.filter(pc.equal(b.column("fold"), f))
                x = scorers[f](texts_of(part.column("text")))
                yield pa.RecordBatch.from_arrays([*(pa.array(x[:, k]) for k in range(3)), part.column("toxic")], names=["passage", "second", "whole", "toxic"])

    return run


def count_steps(texts: DataFrame, ids: DataFrame) -> DataFrame:
    """Every step of the words of the texts (doc_id, text) of all ids (doc_id, toxic, fold): step ('<' and a prefix, or '='
    and a word), parent ('' at the top), and for each view v: tv and ov, the documents of the toxic and of the ordinary
    class with it, and dv, the distinct words below it."""
    folds = range(FOLDS)
    words = (
        texts.join(ids, "doc_id")
        .select("toxic", "fold", F.explode(F.array_distinct(F.regexp_extract_all(F.lower(F.coalesce("text", F.lit(""))), F.lit(WORD_SQL), F.lit(0)))).alias("word"))
        .groupBy("word").agg(*(F.sum(F.expr(f"if(fold = {f}, {v}, 0)")).alias(f"{c}{f}") for f in folds for c, v in (("t", "toxic"), ("o", "1 - toxic"))))
    )
    kept = lambda view: [f for f in folds if f != view]
    viewed = [F.expr(" + ".join(f"{c}{f}" for f in kept(view))).alias(f"{c}_{i}") for i, view in enumerate(VIEWS) for c in "to"]
    counted = words.select("word", *viewed).select("*", *(F.expr(f"if(t_{i} + o_{i} > 0, 1L, 0L)").alias(f"d_{i}") for i in range(len(VIEWS))))
    chain = F.expr(f"filter(array({', '.join(map(str, PREFIXES))}), k -> char_length(word) > k)")
    steps = F.expr(
        "concat(transform(ks, (k, i) -> struct(concat('<', left(word, k)) AS step, if(i = 0, '', concat('<', left(word, ks[i - 1]))) AS parent)),"
        " array(struct(concat('=', word) AS step, if(size(ks) = 0, '', concat('<', left(word, ks[size(ks) - 1]))) AS parent)))")
    sums = [F.sum(f"{c}_{i}").alias(f"{c}_{i}") for i in range(len(VIEWS)) for c in "tod"]
    return stash(counted.withColumn("ks", chain).withColumn("s", F.explode(steps)).groupBy("s.step", "s.parent").agg(*sums), "toxic-steps")


def discounts(steps: DataFrame, cutoff: int = CUTOFF) -> dict[str, str]:
    """For each class and view, SQL for what a step's count gives to the backoff: all of a count up to the cut-off, else a
    discount estimated from the counts of counts n1 to n4: k - (k + 1) * Y * n(k+1) / nk, Y = n1 / (n1 + 2 n2)."""
    names = [f"{c}_{i}" for i in range(len(VIEWS)) for c in "to"]
    n = steps.agg(*(F.count_if(F.col(c) == j).alias(f"{c}_{j}") for c in names for j in range(1, 5))).first()
    out = {}
    for c in names:
        n1, n2, n3, n4 = (max(n[f"{c}_{j}"], 1) for j in range(1, 5))
        y = n1 / (n1 + 2 * n2)
        d = [min(max(k - (k + 1) * y * b / a, 0.1), k) for k, a, b in ((1, n1, n2), (2, n2, n3), (3, n3, n4))]
        out[c] = f"CASE WHEN {c} <= {cutoff} THEN cast({c} AS double) WHEN {c} = 1 THEN {d[0]!r}D WHEN {c} = 2 THEN {d[1]!r}D ELSE {d[2]!r}D END"
    return out


def step_ratios(steps: DataFrame, cutoff: int = CUTOFF) -> DataFrame:
    """step and, for each view, ratio, p_toxic and p_ordinary: the probabilities of the step from its parent."""
    taken = discounts(steps, cutoff)
    views = range(len(VIEWS))
    with_taken = steps.select("*", *(F.expr(x).alias(f"taken_{c}") for c, x in taken.items()))
    below = with_taken.groupBy("parent").agg(*(F.sum(f"{c}_{i}").cast("double").alias(f"all_{c}_{i}") for i in views for c in "tod"), *(F.sum(f"taken_{c}").alias(f"left_{c}") for c in taken))
    met = with_taken.join(below, "parent")
    gain = lambda c, i: f"if({c}_{i} > 0, ln(1D + ({c}_{i} - taken_{c}_{i}) / (left_{c}_{i} * d_{i} / all_d_{i})), 0D)"
    p = lambda c, i: f"if(all_d_{i} = 0, 0D, if(all_{c}_{i} = 0, d_{i} / all_d_{i}, ({c}_{i} - taken_{c}_{i} + left_{c}_{i} * d_{i} / all_d_{i}) / all_{c}_{i}))"
    return met.select("step", "parent", *(F.expr(f"{gain('t', i)} - {gain('o', i)}").alias(f"ratio_{i}") for i in views), *(F.expr(p(c, i)).alias(f"{name}_{i}") for i in views for c, name in (("t", "p_toxic"), ("o", "p_ordinary"))))


def train(docs: DataFrame, labels: DataFrame, usable: str = "crc32(cast(doc_id AS string)) % 4 <> 2", per_class: int = PER_CLASS):
    """(model, curve) from the labelled rows that `usable` selects: all of them count; at most per_class of each class calibrate."""
    ids = labels.filter("doc_id IS NOT NULL AND toxic IS NOT NULL").select("doc_id", F.col("toxic").cast("int").alias("toxic")).filter(usable).withColumn("fold", F.expr(f"cast(pmod(xxhash64(doc_id, 29), {FOLDS}) AS int)"))
    texts = docs.select("doc_id", "text")
    # a checked size: up to BROADCAST_IDS ids go to all executors, more meet the texts by a shuffle
    few = ids.count() <= BROADCAST_IDS
    found = step_ratios(count_steps(texts, F.broadcast(ids) if few else ids))
    names = [f"ratio_{i}" for i in range(len(VIEWS))]
    weighty = found.filter(F.greatest(*(F.abs(n) for n in names)) > LEAST_RATIO)
    got = weighty.select(F.xxhash64("step").alias("h"), *(F.col(n).cast("float").alias(n) for n in names)).toArrow()
    order = np.argsort(got["h"].to_numpy())
    steps, ratios = got["h"].to_numpy()[order], [got[n].to_numpy()[order] for n in names]
    context = docs.sparkSession.sparkContext
    crossed = context.broadcast((steps, ratios))
    held = F.broadcast(bounded(ids, "toxic", per_class, "true"))  # at most 2 * per_class ids
    scored = texts.join(held, "doc_id").select("text", "fold", "toxic").mapInArrow(tidy(_cross(crossed)), "passage double, second double, whole double, toxic int").toPandas()
    crossed.unpersist()
    return context.broadcast(KneserNey(steps, ratios[0])), fit_curve(scored[["passage", "second", "whole"]].to_numpy(float), scored["toxic"].to_numpy(float))


def toxicity_scores(docs: DataFrame, labels: DataFrame, usable: str = "crc32(cast(doc_id AS string)) % 4 <> 2", per_class: int = PER_CLASS) -> DataFrame:
    """doc_id and score of every document, with the features behind it."""
    model, curve = train(docs, labels, usable, per_class)
    return docs.select("doc_id", "text").mapInArrow(tidy(_apply(model, curve)), SCORES)


def _judge(model, curve, schema, threshold):
    def run(batches):
        score = _Scorer(model.value)
        for b in batches:
            x = score(texts_of(b.column("text")))
            yield b.filter(pa.array(curve_value(x, curve) < threshold))

    return run


def keep_ordinary(docs: DataFrame, labels: DataFrame, threshold: float = THRESHOLD) -> DataFrame:
    """The documents that score below the threshold, all columns as they were."""
    model, curve = train(docs, labels)
    return docs.mapInArrow(tidy(_judge(model, curve, None, threshold)), docs.schema)

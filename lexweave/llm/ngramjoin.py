"""N-gram Jaccard join with Bayesian candidate pruning.

Texts are sets of five-word shingles (a shorter text is one shingle of all its words). Texts with equal sets are one node
from the start. Nodes that agree on all MinHash values of a band are candidates; a candidate pair's MinHash values are
then compared a few at a time, and the pair is dropped once the posterior probability that its similarity reaches the
threshold falls below the tolerance. What is left is verified on the whole shingle sets.

Bands with few nodes in a bucket give pairs of nodes. Buckets with more than `small` nodes are never listed as pairs: their
nodes form cores (the components of crowded buckets), and a core is dealt into tiles of bounded size. Each pair of tiles is
first compared and pruned on signatures alone; only the texts with a partner left send their shingle sets to a second task,
which verifies them and returns per node its number of links, with a spanning forest of the links. So every link between
different texts counts, sets travel for likely links only, and nothing grows with the square of a group but arithmetic.

Pruning compares one byte of each MinHash value, so two unequal values agree by chance in 1 of 256 cases; the posterior
allows for it. Word hashes and shingles are 64-bit, set identities 128-bit. Candidates miss a pair at the threshold with a probability of
(1 - t^rows)^bands, 5e-8 for t = 0.8; the tolerance of pruning is 1e-9.

Defined results: null and empty texts have no shingles and are similar to one another only; ties and repeated rows are
copies; a class is named by its smallest doc_id (null if it has none but null ids), so where one id stands on different
texts, or ids are null, separate classes can have the same name: keep_one tells them apart and keeps a row of each; an empty
table gives no rows; other columns are not read.
"""

from __future__ import annotations

import hashlib
import math

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from lexweave.operators.components import connected_components

from .common import stash, texts_of, tidy

WORDS, THRESHOLD, TOLERANCE = 5, 0.8, 1e-9
BANDS, ROWS = 32, 4
HASHES, STEP = BANDS * ROWS, 16
SMALL, TILE = 64, 1024
#: Bytes of shingle sets in a tile (8 a shingle), on average: cores of long texts get more tiles of fewer texts.
TILE_BYTES = 8_000_000
#: Ids of texts to be verified that may be broadcast (8 bytes each).
BROADCAST_IDS = 2_000_000
#: Parts in which a core's nodes meet its number of tiles.
SALTS = 64
_MEMO = 150_000
_rng = np.random.default_rng(20240229)
_A = _rng.integers(1, 2**63, HASHES, dtype=np.uint64) * np.uint64(2) + np.uint64(1)
_B = _rng.integers(0, 2**63, HASHES, dtype=np.uint64)
_MIX = np.uint64(0x9E3779B97F4A7C15)
_words: dict[bytes, int] = {}


def shingles(text: str, words: int = WORDS) -> np.ndarray:
    """Sorted distinct 64-bit hashes of the text's shingles; none for a text without words."""
    import xxhash

    tokens = text.encode().split()
    if not tokens:
        return np.zeros(0, np.uint64)
    if len(_words) > _MEMO:
        _words.clear()
    for w in set(tokens):
        if w not in _words:
            _words[w] = xxhash.xxh3_64_intdigest(w)
    h = np.fromiter(map(_words.__getitem__, tokens), np.uint64, len(tokens))
    k = min(words, len(h))
    s = np.full(len(h) - k + 1, k, np.uint64)
    for i in range(k):
        s = s * _MIX + h[i : len(h) - k + 1 + i]
        s ^= s >> np.uint64(29)
    return np.unique(s * _MIX)


def _forget() -> None:
    _words.clear()


def signature(s: np.ndarray) -> np.ndarray:
    best = np.full(HASHES, 2**32 - 1, np.uint32)
    for lo in range(0, len(s), 2048):
        part = s[None, lo : lo + 2048] * _A[:, None]
        part += _B[:, None]
        np.minimum(best, (part.min(1) >> np.uint64(32)).astype(np.uint32), out=best)
    return best


def set_key(s: np.ndarray) -> bytes:
    return hashlib.blake2b(s.tobytes(), digest_size=16).digest()


def least_matches(threshold: float = THRESHOLD, tolerance: float = TOLERANCE, hashes: int = HASHES, step: int = STEP) -> dict[int, int]:
    """For each number n of compared values: the fewest matches with which a pair stays.

    Under a uniform prior the posterior of the chance of a match is Beta(m + 1, n - m + 1), and P(S >= t) = P(Binomial(n + 1, t) <= m).
    A pair at the threshold matches in one byte with the chance threshold + (1 - threshold) / 256.
    """
    threshold += (1 - threshold) / 256
    out = {}
    for n in range(step, hashes + 1, step):
        total, m = 0.0, -1
        while total < tolerance:
            m += 1
            total += math.comb(n + 1, m) * threshold**m * (1 - threshold) ** (n + 1 - m)
        out[n] = m
    return out


def prune(sig: np.ndarray, i: np.ndarray, j: np.ndarray, least: dict[int, int]) -> np.ndarray:
    """Which of the pairs (i, j) survive the incremental comparison."""
    alive, matches = np.arange(len(i)), np.zeros(len(i), np.int32)
    for n, m in least.items():
        part = slice(n - STEP, n)
        matches[alive] += (sig[i[alive], part] == sig[j[alive], part]).sum(1, dtype=np.int32)
        alive = alive[matches[alive] >= m]
    return alive


def band_hashes(sig: np.ndarray) -> np.ndarray:
    """A 64-bit bucket for each band of a signature."""
    rows = sig.reshape(BANDS, ROWS).astype(np.uint64)
    h = np.arange(BANDS, dtype=np.uint64)
    for r in range(ROWS):
        h = (h ^ rows[:, r]) * _MIX
        h ^= h >> np.uint64(31)
    return h


def _sign(batches):
    for b in batches:
        keys, bands, sigs = [], [], []
        for t in texts_of(b.column("text")):
            s = shingles(t)
            sig = signature(s) if len(s) else None
            keys.append(set_key(s))
            bands.append(None if sig is None else band_hashes(sig).tobytes())
            sigs.append(None if sig is None else sig.astype(np.uint8).tobytes())
        yield pa.RecordBatch.from_arrays([b.column("doc_id"), pa.array(keys, pa.binary()), pa.array(bands, pa.binary()), pa.array(sigs, pa.binary())], names=["doc_id", "key", "bands", "sig"])


def _buckets(batches):
    for b in batches:
        for lo in range(0, b.num_rows, 2000):
            part = b.slice(lo, 2000)
            h = np.frombuffer(b"".join(part.column("bands").to_pylist()), np.int64)
            yield pa.RecordBatch.from_arrays([pa.array(h), part.column("nid").take(pa.array(np.repeat(np.arange(part.num_rows), BANDS)))], names=["bucket", "nid"])


def _pairs(least):
    def run(table: pa.Table) -> pa.Table:
        ids, core = table.column("nid").to_numpy(), table.column("core").fill_null(-1).to_numpy()
        sig = np.frombuffer(b"".join(table.column("sig").to_pylist()), np.uint8).reshape(-1, HASHES)
        i, j = np.triu_indices(len(ids), 1)
        apart = (core[i] < 0) | (core[i] != core[j])  # pairs of one core are its tiles' work
        i, j = i[apart], j[apart]
        alive = prune(sig, i, j, least)
        x, y = ids[i[alive]], ids[j[alive]]
        return pa.table({"a": pa.array(np.minimum(x, y), pa.int64()), "b": pa.array(np.maximum(x, y), pa.int64())})

    return run


def _sets(batches):
    for b in batches:
        keys, sets = [], []
        for t in texts_of(b.column("text")):
            s = shingles(t)
            keys.append(set_key(s))
            sets.append(s.tobytes())
        yield pa.RecordBatch.from_arrays([pa.array(keys, pa.binary()), pa.array(sets, pa.binary())], names=["key", "set"])


def jaccard(a: np.ndarray, b: np.ndarray) -> float:
    both = len(np.intersect1d(a, b, assume_unique=True))
    return both / (len(a) + len(b) - both)


def _verify(threshold: float):
    def run(batches):
        for b in batches:
            load = lambda c: [np.frombuffer(x, np.uint64) for x in b.column(c).to_pylist()]
            yield b.select(["a", "b", "a_copies", "b_copies"]).filter(pa.array([jaccard(x, y) >= threshold for x, y in zip(load("a_set"), load("b_set"))], pa.bool_()))

    return run


def common_counts(sets: list[np.ndarray], split: int) -> np.ndarray:
    """Sizes of the intersections of sets[:split] (rows) with sets[split:] (columns), by products of 0/1 matrices."""
    lens = np.array([len(s) for s in sets])
    values, column = np.unique(np.concatenate(sets), return_inverse=True)
    shared = np.bincount(column, minlength=len(values)) > 1
    row, keep = np.repeat(np.arange(len(sets)), lens), shared[column]
    number = np.cumsum(shared) - 1
    row, column = row[keep], number[column[keep]]
    order = np.argsort(column, kind="stable")
    row, column = row[order], column[order]
    total, width = np.zeros((split, len(sets) - split), np.float32), 4096
    for lo in range(0, int(shared.sum()), width):
        a, b = np.searchsorted(column, (lo, lo + width))
        dense = np.zeros((len(sets), width), np.float32)
        dense[row[a:b], column[a:b] - lo] = 1
        total += dense[:split] @ dense[split:].T
    return total


def _survivors(least):
    """The nodes of a pair of tiles that have a partner left after pruning."""

    def run(table: pa.Table) -> pa.Table:
        lo, hi = table.column("lo")[0].as_py(), table.column("hi")[0].as_py()
        tile = table.column("tile").to_numpy()
        sig = np.frombuffer(b"".join(table.column("sig").to_pylist()), np.uint8).reshape(-1, HASHES)
        left, right = np.nonzero(tile == lo)[0], np.nonzero(tile == hi)[0]
        stays, match = np.zeros(len(tile), bool), np.zeros((len(left), len(right)), np.int16)
        for n, m in least.items():
            for k in range(n - STEP, n):
                match += sig[left, None, k] == sig[None, right, k]
            open_pairs = match >= m
            if lo == hi:
                np.fill_diagonal(open_pairs, False)
            if not open_pairs.any():
                break
        else:
            stays[left[open_pairs.any(1)]] = True
            stays[right[open_pairs.any(0)]] = True
        return table.filter(pa.array(stays)).select(["core", "lo", "hi", "tile", "nid"])

    return run


def _tiles(threshold: float, least):
    first, rest = STEP, {n: m for n, m in least.items() if n > STEP}

    def run(table: pa.Table) -> pa.Table:
        table = table.sort_by([("tile", "ascending"), ("nid", "ascending")])
        lo, hi = table.column("lo")[0].as_py(), table.column("hi")[0].as_py()
        ids, copies = table.column("nid").to_numpy(), table.column("copies").to_numpy()
        sets = [np.frombuffer(x, np.uint64) for x in table.column("set").to_pylist()]
        sig = np.frombuffer(b"".join(table.column("sig").to_pylist()), np.uint8).reshape(-1, HASHES)
        split = int((table.column("tile").to_numpy() == lo).sum())  # sorted: tile lo first
        n, sizes = len(ids), np.array([len(s) for s in sets])
        right = np.arange(n) if lo == hi else np.arange(split, n)
        links, ends = np.zeros(n, np.int64), []
        parent = list(range(n))

        def root(x):
            while parent[x] != x:
                parent[x] = parent[parent[x]]
                x = parent[x]
            return x

        if split and len(right):
            match = np.zeros((split, len(right)), np.int16)
            for k in range(first):
                match += sig[:split, None, k] == sig[None, right, k]
            i, j = np.nonzero(match >= least[first])
            if lo == hi:
                i, j = i[i < j], j[i < j]
            count, step = match[i, j].astype(np.int32), STEP
            for m_n, m in rest.items():
                part = slice(m_n - step, m_n)
                for c in range(0, len(i), 200_000):
                    s = slice(c, c + 200_000)
                    count[s] += (sig[i[s], part] == sig[right[j[s]], part]).sum(1, dtype=np.int32)
                stay = count >= m
                i, j, count = i[stay], j[stay], count[stay]
            if len(i):
                both = common_counts(sets + sets, n)[:split] if lo == hi else common_counts(sets, split)
                both = both[i, j]
                ok = both >= threshold * (sizes[i] + sizes[right[j]] - both) - 1e-6
                i, j = i[ok], right[j[ok]]
                np.add.at(links, i, copies[j])
                np.add.at(links, j, copies[i])
                for a, b in zip(i.tolist(), j.tolist()):
                    a, b = root(a), root(b)
                    if a != b:
                        parent[max(a, b)] = min(a, b)
        linked = np.nonzero(links)[0]
        return pa.table({"nid": pa.array(ids[linked], pa.int64()), "links": pa.array(links[linked], pa.int64()), "to": pa.array([int(ids[root(x)]) for x in linked], pa.int64())})

    return run


def near_duplicates(docs: DataFrame, threshold: float = THRESHOLD, tolerance: float = TOLERANCE, small: int = SMALL, tile: int = TILE) -> tuple[DataFrame, DataFrame]:
    """(signed, classes): (doc_id, key) of every row, and for every key its class_id, copies, n_links and group.

    group tells classes apart, as class_id may be null or the same in several.

    class_id is the smallest doc_id of all rows linked directly or over others; n_links counts the other rows whose
    similarity is at least the threshold.
    """
    least = least_matches(threshold, tolerance)
    signed = stash(docs.select("doc_id", "text").mapInArrow(tidy(_sign, _forget), "doc_id long, key binary, bands binary, sig binary"), "signed")
    # nid is fixed when the table is written
    nodes = stash(signed.groupBy("key").agg(F.min("doc_id").alias("first_id"), F.count("*").alias("copies"), F.first("bands").alias("bands"), F.first("sig").alias("sig")).withColumn("nid", F.monotonically_increasing_id()), "nodes")
    buckets = nodes.filter("bands IS NOT NULL").select("nid", "bands").mapInArrow(tidy(_buckets), "bucket long, nid long")
    crowded = buckets.groupBy("bucket").agg(F.count("*").alias("size"), F.min("nid").alias("least")).filter("size > 1")
    members = stash(buckets.join(crowded, "bucket"), "members")

    hot = members.filter(F.col("size") > small)
    stars = hot.select("nid", "least").filter("nid <> least").distinct()
    cores = stash(connected_components(stars, "nid", "least").select(F.col("node").alias("nid"), F.col("component").alias("core")), "cores")

    lean = members.filter(F.col("size") <= small).join(nodes.select("nid", "sig"), "nid").join(cores, "nid", "left")
    pairs = stash(lean.select("bucket", "nid", "sig", "core").groupBy("bucket").applyInArrow(_pairs(least), "a long, b long").distinct(), "pairs")

    ends = pairs.select(F.col("a").alias("nid")).unionByName(pairs.select(F.col("b").alias("nid"))).unionByName(cores.select("nid")).distinct()
    wanted = stash(ends.join(nodes.select("nid", "key", "first_id", "copies", "sig"), "nid"), "wanted")
    ids = stash(wanted.select(F.col("first_id").alias("wanted_id")).distinct(), "wanted-ids")
    # a checked size: up to BROADCAST_IDS ids go to all executors, more are met by a shuffle
    few = ids.count() <= BROADCAST_IDS
    known = ids.filter("wanted_id IS NOT NULL")
    texts = docs.select("doc_id", "text").join(F.broadcast(known) if few else known, F.col("doc_id") == F.col("wanted_id"), "left_semi")
    if not ids.filter("wanted_id IS NULL").isEmpty():
        # rows without an id are no join key: they are read by a filter
        texts = texts.unionByName(docs.select("doc_id", "text").filter("doc_id IS NULL"))
    sets = stash(texts.mapInArrow(tidy(_sets, _forget), "key binary, set binary").groupBy("key").agg(F.first("set").alias("set")).join(wanted, "key").withColumn("bytes", F.length("set")), "sets")

    side = lambda s: sets.select(F.col("nid").alias(s), F.col("set").alias(f"{s}_set"), F.col("copies").alias(f"{s}_copies"))
    links = stash(pairs.join(side("a"), "a").join(side("b"), "b").mapInArrow(tidy(_verify(threshold)), "a long, b long, a_copies long, b_copies long"), "links")

    # cores are sized and met by narrow rows, salted: a core of the tiles has more than `small` nodes, so copies of its size are fewer
    sized = sets.select("nid", "bytes").join(cores, "nid")
    tiling = sized.groupBy("core").agg(F.ceil(F.greatest(F.count("*") / F.lit(tile), F.sum("bytes") / F.lit(TILE_BYTES))).cast("int").alias("tiles"))
    salted = tiling.withColumn("salt", F.explode(F.sequence(F.lit(0), F.lit(SALTS - 1))))
    where = sized.withColumn("salt", F.expr(f"cast(pmod(xxhash64(nid, 1), {SALTS}) AS int)")).join(salted, ["core", "salt"]).select("nid", "core", "tiles")
    placed = sets.select("nid", "sig").join(where, "nid").withColumn("tile", F.expr("cast(pmod(xxhash64(nid), tiles) AS int)")).withColumn("other", F.explode(F.expr("sequence(0, tiles - 1)")))
    compared = placed.select("core", F.least("tile", "other").alias("lo"), F.greatest("tile", "other").alias("hi"), "tile", "nid", "sig")
    likely = stash(compared.groupBy("core", "lo", "hi").applyInArrow(_survivors(least), "core long, lo int, hi int, tile int, nid long"), "likely")
    dealt = likely.join(sets.select("nid", "copies", "set", "sig"), "nid")
    tiles = stash(dealt.groupBy("core", "lo", "hi").applyInArrow(_tiles(threshold, least), "nid long, links long, to long"), "tiles")

    counts = links.select(F.col("a").alias("nid"), F.col("b_copies").alias("links")).unionByName(links.select(F.col("b").alias("nid"), F.col("a_copies").alias("links"))).unionByName(tiles.select("nid", "links")).groupBy("nid").agg(F.sum("links").alias("links"))
    edges = links.select(F.col("a").alias("src"), F.col("b").alias("dst")).unionByName(tiles.select(F.col("nid").alias("src"), F.col("to").alias("dst")))
    grouped = connected_components(edges).select(F.col("node").alias("nid"), "component")
    lone = nodes.select("nid", "key", "first_id", "copies")
    first = lone.join(grouped, "nid").groupBy("component").agg(F.min("first_id").alias("class_first"))
    named = grouped.join(first, "component").select("nid", "component", "class_first", F.lit(True).alias("in_class"))
    classes = lone.join(named, "nid", "left").join(counts, "nid", "left").select(
        "key", F.when(F.col("in_class"), F.col("class_first")).otherwise(F.col("first_id")).alias("class_id"), "copies", (F.col("copies") - 1 + F.coalesce("links", F.lit(0))).alias("n_links"), F.coalesce("component", "nid").alias("group"))
    return signed.select("doc_id", "key"), classes


def ngram_join(docs: DataFrame, threshold: float = THRESHOLD) -> DataFrame:
    """doc_id, class_id, n_links of every row of docs."""
    signed, classes = near_duplicates(docs, threshold)
    return signed.join(classes, "key").select("doc_id", "class_id", "n_links")


def _keyed(schema_names):
    def run(batches):
        for b in batches:
            keys = [set_key(shingles(t)) for t in texts_of(b.column("text"))]
            yield pa.RecordBatch.from_arrays([*b.columns, pa.array(keys, pa.binary())], names=[*schema_names, "__key"])

    return run


def keep_one(docs: DataFrame, threshold: float = THRESHOLD) -> DataFrame:
    """One row of every class, all columns as they were: a row with the class's smallest doc_id.

    An id that stands on one row names that row, so such rows are kept or dropped by id alone. Only texts whose id repeats
    or is null are shingled again, to tell their rows apart.
    """
    from pyspark.sql import types as T

    signed, classes = near_duplicates(docs, threshold)
    both = signed.join(classes.select("key", "class_id", "group"), "key").filter(F.col("doc_id").eqNullSafe(F.col("class_id")))
    chosen = stash(both.groupBy("group").agg(F.min(F.struct("key", "class_id")).alias("x")).select(F.col("x.key").alias("__chosen"), F.col("x.class_id").alias("__class_id")), "chosen")
    per_id = signed.filter("doc_id IS NOT NULL").groupBy("doc_id").agg(F.count("*").alias("rows"))
    ids = stash(per_id.join(chosen.filter("__class_id IS NOT NULL").select(F.col("__class_id").alias("doc_id")).distinct().withColumn("wanted", F.lit(True)), "doc_id", "left"), "ids")
    away = ids.filter("rows > 1 OR wanted IS NULL").select("doc_id")
    again = ids.filter("rows > 1 AND wanted").select("doc_id")
    # checked sizes: the ids that go, or that repeat, are sent to all executors up to BROADCAST_IDS, else met by a shuffle
    met = lambda df: F.broadcast(df) if df.count() <= BROADCAST_IDS else df
    plain = docs.filter("doc_id IS NOT NULL").join(met(away), "doc_id", "left_anti").select(*(f"`{c}`" for c in docs.columns))
    unclear = docs.filter("doc_id IS NOT NULL").join(met(again), "doc_id", "left_semi").select(*(f"`{c}`" for c in docs.columns))
    if not chosen.filter("__class_id IS NULL").isEmpty():
        unclear = unclear.unionByName(docs.filter("doc_id IS NULL"))
    keyed = unclear.mapInArrow(tidy(_keyed(docs.columns), _forget), T.StructType([*docs.schema.fields, T.StructField("__key", T.BinaryType())]))
    kept = keyed.join(chosen, F.col("doc_id").eqNullSafe(F.col("__class_id")) & (F.col("__key") == F.col("__chosen")), "left_semi")
    # a key belongs to one class; exact copies with one id, or with none, are its rows
    return plain.unionByName(kept.dropDuplicates(["__key"]).select(*(f"`{c}`" for c in docs.columns)))

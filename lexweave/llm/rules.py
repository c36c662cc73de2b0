"""Quality rules as a short-circuit cascade.

Every rule is a native expression over text statistics. On a bounded sample the cascade measures what a rule with its
statistics costs and which rows it rejects. It then asks the rule with the most rejections per cost first, next the one with
the most per cost among the rows that are left, and so on. A rule's cost is the slope of the time over how often it is
evaluated (once and REPEATS times a row), so the start of a job is no part of it. The filter is one
CASE in which each rule computes its own statistics from the text and its words, so a document that one rule rejects
costs nothing of the next rule's statistics. Where the statistics are wanted as columns, the rules read those instead.
The order changes the time and never the verdict.

The sample is the first rows of the first partitions with texts of at most SAMPLE_TEXT_BYTES, written once in the shared
folder; it decides the order only. Words are runs between white space, so texts in scripts written without spaces have few
and long words: `few_words` and `word_length` reject most of them. Give such texts other rules.

Defined results: a null or empty text has no words, so all statistics are 0 and it is rejected by `few_words`;
repeated rows are judged alike; extra columns pass through, and a column named like a statistic does not clash,
as statistics live in one struct column whose name the caller chooses.
"""

from __future__ import annotations

import time
from dataclasses import dataclass
from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from lexweave.plans.cut import drop, stash

#: Rows of the sample on which costs and selectivities are estimated (its only use).
SAMPLE_ROWS = 2000
#: Evaluations of each sample row in the longer of the two timed jobs.
REPEATS = 5
#: Bytes of a text of that sample; longer ones take no part in the estimates (and are judged whole like all others).
SAMPLE_TEXT_BYTES = 20_000


@dataclass(frozen=True)
class Rule:
    """`rejects` is SQL over {s.<statistic>} and {t}, the text."""

    name: str
    rejects: str


BASE_RULES = (
    Rule("few_words", "{s.n_words} < 20"),
    Rule("repeated_windows", "100 * {s.n_repeat_words} > 30 * {s.n_words}"),
)

RULES = (
    *BASE_RULES,
    Rule("symbols", "10 * {s.n_symbols} > 3 * {s.n_words}"),
    Rule("word_length", "{s.word_chars} < 2 * {s.n_words} OR {s.word_chars} > 25 * {s.n_words}"),
    Rule("repeated_lines", "2 * {s.n_dup_lines} > {s.n_lines}"),
    Rule("shouting", "10 * regexp_count({t}, '\\\\p{{Lu}}{{2,}}') > 6 * {s.n_words}"),
)

_SPLIT = r"[\\x20\\x09-\\x0D]+"

# Positions of 8-word windows are sorted with the windows' hashes only where some hash repeats; the covered words
# are then counted from the sorted starts of the repeated windows.
_COVERED = """
aggregate(
  transform(array(sort_array(transform(h, (x, i) -> struct(x AS x, i AS i)))), s ->
    sort_array(transform(filter(s, (e, k) -> e.x = get(s, k - 1).x OR e.x = get(s, k + 1).x), e -> e.i)))[0],
  named_struct('n', 0L, 'stop', 0L),
  (a, p) -> named_struct('n', a.n + 8L - greatest(0L, a.stop - p), 'stop', p + 8L),
  a -> a.n)
"""

_WORDS = f"filter(split(coalesce({{t}}, ''), '{_SPLIT}'), x -> x <> '')"
_FULL_LINES = r"filter(split(coalesce({t}, ''), '\n', -1), x -> x rlike '[^\\x20\\x09-\\x0D]')"

# Each statistic over {t}, the text, {w}, its words, and {l}, its lines with a word.
_STAT = {
    "n_words": "cast(size({w}) AS bigint)",
    "word_chars": "cast(char_length(array_join({w}, '')) AS bigint)",
    "n_symbols": "cast(coalesce(regexp_count({t}, '[#*$%&|<>]'), 0) AS bigint)",
    "n_dup_lines": "cast(size({l}) - size(array_distinct({l})) AS bigint)",
    "n_repeat_words": "transform(array(if(size({w}) < 9, array(), transform(sequence(1, greatest(size({w}) - 7, 1)), i -> xxhash64(slice({w}, i, 8))))),"
    f" h -> if(size(array_distinct(h)) = size(h), 0L, {_COVERED}))[0]",
    "n_lines": "cast(size({l}) AS bigint)",
}


class _Columns:
    """Statistics read from a struct column."""

    def __init__(self, struct: str):
        self.struct = struct

    def __getattr__(self, name: str) -> str:
        return f"`{self.struct}`.{name}"


class _Lazy:
    """Statistics computed where a rule names them, from the text and its words `w`."""

    def __init__(self, t: str):
        self.t = t

    def __getattr__(self, name: str) -> str:
        return f"({_STAT[name].format(t=self.t, w='w', l=_FULL_LINES.format(t=self.t))})"


def text_stats(text: str = "text") -> F.Column:
    """One struct of all statistics of the whole text, each array bound once inside one expression."""
    t = f"`{text}`"
    fields = ", ".join(f"'{n}', {x.format(t=t, w='w', l='l')}" for n, x in _STAT.items())
    return F.expr(f"transform(array({_WORDS.format(t=t)}), w -> transform(array({_FULL_LINES.format(t=t)}), l -> named_struct({fields}))[0])[0]")


def _asked(rules, text: str) -> F.Column:
    """The name of the first rule that rejects; the words are split once, all else is computed by the rule that asks for it."""
    t = f"`{text}`"
    chain = " ".join(f"WHEN coalesce({r.rejects.format(s=_Lazy(t), t=t)}, false) THEN '{r.name}'" for r in rules)
    return F.expr(f"transform(array({_WORDS.format(t=t)}), w -> CASE {chain} END)[0]") if rules else F.lit(None).cast("string")


def bounded_sample(docs: DataFrame, text: str, rows: int = SAMPLE_ROWS, text_bytes: int = SAMPLE_TEXT_BYTES) -> DataFrame:
    """`t`, the texts of the first rows, as a local table of at most rows * text_bytes bytes (40 MB by default).

    Collecting a limit reads partition after partition until it has its rows, while a limit inside a plan takes that many
    rows of every partition through a shuffle. The rows stay in the JVM.
    """
    spark = docs.sparkSession
    few = docs.select(F.col(text).alias("t")).filter(F.coalesce(F.octet_length("t"), F.lit(0)) <= text_bytes).limit(rows)._jdf
    return DataFrame(spark._jsparkSession.createDataFrame(few.collectAsList(), few.schema()), spark)


def rule_costs(sample: DataFrame, rules: tuple[Rule, ...], repeats: int = REPEATS) -> dict[str, float]:
    """Seconds a row of each rule with its statistics: the slope between one and `repeats` evaluations of every row."""
    n = max(sample.count(), 1)

    def seconds(rule: Rule, times: int) -> float:
        # a row's evaluations differ by a blank at the end, so that none is shared
        rows = sample.select(F.explode(F.sequence(F.lit(1), F.lit(times))).alias("k"), "t").select(F.concat("t", F.repeat(F.lit(" "), F.col("k"))).alias("t"))
        began = time.perf_counter()
        rows.agg(F.count(_asked((rule,), "t"))).first()
        return time.perf_counter() - began

    found = {}
    for rule in rules:
        seconds(rule, 1)  # compiles the rule
        found[rule.name] = max(seconds(rule, repeats) - seconds(rule, 1), 1e-6) / ((repeats - 1) * n)
    return found


def greedy_order(costs: dict[str, float], masks: dict[int, int]) -> list[dict]:
    """Names in order with the cost, and the share rejected of the rows that come so far; masks counts sample rows by the
    rules that reject them, bit k for the k-th name."""
    names, left, total = list(costs), dict(masks), max(sum(masks.values()), 1)
    out = []
    while len(out) < len(names):
        still = max(sum(left.values()), 1)
        rest = [(k, sum(n for m, n in left.items() if m >> k & 1) / still) for k, x in enumerate(names) if x not in {y["name"] for y in out}]
        k, share = max(rest, key=lambda x: (x[1] / costs[names[x[0]]], -costs[names[x[0]]]))
        out.append({"name": names[k], "cost": costs[names[k]], "selectivity": share, "reached": sum(left.values()) / total})
        left = {m: n for m, n in left.items() if not m >> k & 1}
    return out


def order_rules(docs: DataFrame, rules: tuple[Rule, ...] = RULES, text: str = "text", sample_rows: int = SAMPLE_ROWS) -> list[dict]:
    """rule, cost and selectivity (of the rows that reach it) in the order of the cascade."""
    sample = stash(bounded_sample(docs, text, sample_rows), "rule-sample")
    rejects = [F.when(_asked((r,), "t").isNotNull(), F.lit(1 << k)).otherwise(F.lit(0)) for k, r in enumerate(rules)]
    # at most one row for each row of the sample
    masks = {x["m"]: x["n"] for x in sample.select(reduce(lambda a, b: a + b, rejects, F.lit(0)).alias("m")).groupBy("m").agg(F.count("*").alias("n")).collect()}
    by_name = {r.name: r for r in rules}
    found = [{"rule": by_name[x["name"]], **x} for x in greedy_order(rule_costs(sample, rules), masks)]
    drop(sample)
    return found


def cascade(docs: DataFrame, rules: tuple[Rule, ...] = RULES, text: str = "text", stats: str | None = "stats", verdict: str = "rejected_by") -> DataFrame:
    """docs with `rejected_by`, the name of the first rule, in cascade order, that rejects (null: kept), and the struct `stats`, if named."""
    ordered = [x["rule"] for x in order_rules(docs, rules, text)]
    if stats is None:
        return docs.withColumn(verdict, _asked(ordered, text))
    tests = [F.when(F.expr(f"coalesce({r.rejects.format(s=_Columns(stats), t=f'`{text}`')}, false)"), F.lit(r.name)) for r in ordered]
    return docs.withColumn(stats, text_stats(text)).withColumn(verdict, F.coalesce(*tests) if tests else F.lit(None).cast("string"))


def quality_rules(docs: DataFrame, rules: tuple[Rule, ...] = RULES) -> DataFrame:
    """doc_id, the statistics, base_failed and kept of every document."""
    s = "__stats"
    judged = cascade(docs.select("doc_id", "text"), rules, stats=s, verdict="__by")
    base = " OR ".join(f"({r.rejects.format(s=_Columns(s), t='text')})" for r in BASE_RULES)
    return judged.select(
        "doc_id", *(F.col(f"{s}.{c}").alias(c) for c in ("n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words")),
        F.expr(base).alias("base_failed"), (F.col("__by").isNull() & ~F.expr(base)).alias("kept"),
    )


def keep_good(docs: DataFrame, rules: tuple[Rule, ...] = RULES) -> DataFrame:
    """The documents no rule rejects, with their own columns only."""
    return cascade(docs, rules, stats=None, verdict="__by").filter("__by IS NULL").select(*(f"`{c}`" for c in docs.columns))

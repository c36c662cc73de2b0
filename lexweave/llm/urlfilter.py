"""URL filter: path rules first, then a verdict from the link graph of hosts.

A rule is `host/path-prefix`; it fits its host and every subdomain when the path starts with the rule's path, and the
longest fitting rule wins. Pages no rule fits are judged by their host: trust flows from hosts that rules allow along
links (personalised PageRank), distrust flows from hosts that rules block against the links, and a host whose distrust
exceeds its trust by more than a threshold is blocked.

Each of the two is a distribution over hosts that sums to 1: the seeds are scaled to sum 1, and what reaches a host without
links goes back to the seeds. (That equals spreading without it and scaling the result to sum 1, which is how it is done.)
Scores are then given in units of one seed, by the seeds' total weight, so the threshold means the same on graphs of any
size: a host that nothing links to or from has its own share of allowed or blocked pages as its score. Rounds go on until
what is still to come sums to at most the tolerance. Links of hosts with many are dealt into salted parts.

Up to EXPRESSION_RULES rules are one expression; more are met by a join on the host's suffixes and the path's prefixes.

Defined results: a null url or one without `://` has empty host and path, no rule and the verdict of the empty host
(allow, as it has no links); null html has no links; repeated rows are judged alike; an empty table gives no rows; other
columns are not read.
"""

from __future__ import annotations

from dataclasses import dataclass
from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from lexweave.plans.cut import drop

from .common import stash

UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
HREF = r"""(?i)<a\s[^>]*?href\s*=\s*["']?((?:[a-z][a-z0-9+.-]*:)?//[^"'\s>]*)"""
#: The SQL goes on for SQL_ROUNDS hops, after which 0.85^SQL_ROUNDS of the flow is left: less than TOLERANCE of 10^8 seeds.
SQL_ROUNDS, DAMPING, THRESHOLD, TOLERANCE = 170, 0.85, 0.05, 1e-4
EXPRESSION_RULES = 200
#: Links of a host in one salted part, about.
HUB = 100_000
#: Rounds between additions of the waves.
FOLD = 12


@dataclass(frozen=True)
class UrlRule:
    verdict: str  # block or allow
    rule: str  # host/path-prefix

    @property
    def host(self) -> str:
        return self.rule.partition("/")[0]

    @property
    def path(self) -> str:
        return "/" + self.rule.partition("/")[2]


RULES = (UrlRule("block", "net/"), UrlRule("allow", "example.net/en/"), UrlRule("block", "example.com/de/"), UrlRule("allow", "org/fr/"))


def split_url(df: DataFrame) -> DataFrame:
    """df with host (A-Z lower-cased) and path of its column url."""
    rest = "coalesce(if(instr(`url`, '://') > 0, substring(`url`, instr(`url`, '://') + 3), ''), '')"
    host = f"regexp_extract({rest}, '^[^/?#]*', 0)"
    path = f"regexp_extract(substring({rest}, char_length({host}) + 1), '^[^?#]*', 0)"
    return df.withColumns({"host": F.translate(F.expr(host), UPPER, LOWER), "path": F.expr(path)})


def with_rule(df: DataFrame, rules: tuple[UrlRule, ...] = RULES) -> DataFrame:
    """df (host, path) with the longest fitting rule and its verdict, both null where none fits."""
    if len(rules) > EXPRESSION_RULES:
        return _joined_rules(df, rules)
    chain = verdict = None
    for r in sorted(rules, key=lambda r: (-len(r.rule), r.rule)):
        fits = ((F.col("host") == r.host) | F.col("host").endswith("." + r.host)) & F.col("path").startswith(r.path)
        chain = F.when(fits, r.rule) if chain is None else chain.when(fits, r.rule)
        verdict = F.when(fits, r.verdict) if verdict is None else verdict.when(fits, r.verdict)
    none = F.lit(None).cast("string")
    return df.withColumn("rule", none if chain is None else chain).withColumn("by_rule", none if verdict is None else verdict)


def _joined_rules(df: DataFrame, rules: tuple[UrlRule, ...]) -> DataFrame:
    """with_rule for any number of rules: each distinct (host, path) meets the rules of its host's suffixes by equality of
    host and path prefix, for the lengths of prefixes that the suffix has rules of."""
    known = df.sparkSession.createDataFrame([(r.host, r.path, r.rule, r.verdict) for r in rules], "r_host string, r_path string, rule string, by_rule string").groupBy("r_host", "r_path").agg(F.min(F.struct("rule", "by_rule")).alias("r"))
    lengths = known.groupBy("r_host").agg(F.collect_set(F.char_length("r_path")).alias("lengths"))
    pairs = df.select("host", "path").distinct()
    suffixes = pairs.withColumn("r_host", F.explode(F.expr("transform(sequence(1, size(split(host, '[.]'))), i -> array_join(slice(split(host, '[.]'), i, 1000000), '.'))")))
    prefixes = suffixes.join(lengths, "r_host").withColumn("n", F.explode("lengths")).filter("char_length(path) >= n").withColumn("r_path", F.expr("left(path, n)"))
    best = prefixes.join(known, ["r_host", "r_path"]).groupBy("host", "path").agg(F.min_by("r", F.struct(-F.char_length("r.rule"), "r.rule")).alias("r"))
    named = best.select(F.col("host").alias("m_host"), F.col("path").alias("m_path"), "r.rule", "r.by_rule")
    return df.join(named, (F.col("host") == F.col("m_host")) & (F.col("path") == F.col("m_path")), "left").drop("m_host", "m_path")


def host_links(pages: DataFrame) -> DataFrame:
    """(src, dst, n): absolute and protocol-relative links between different hosts, counted before and after the shuffle."""
    found = split_url(pages.select("url", F.regexp_extract_all("html", F.lit(HREF), F.lit(1)).alias("links")).filter(F.size("links") > 0))
    links = found.select(F.col("host").alias("src"), F.explode(F.expr("transform(links, u -> if(startswith(u, '//'), concat('http:', u), u))")).alias("url"))
    return split_url(links).select("src", F.col("host").alias("dst")).filter("src <> dst AND src <> '' AND dst <> ''").groupBy("src", "dst").agg(F.count("*").alias("n"))


def shares(links: DataFrame) -> DataFrame:
    """(kind, src, dst, salt, parts, share): the links forward for trust and backward for distrust, each with its share of all
    links from its start; the links of a start with more than HUB are dealt into parts."""
    both = links.select(F.lit("trust").alias("kind"), "src", "dst", "n").unionByName(links.select(F.lit("distrust").alias("kind"), F.col("dst").alias("src"), F.col("src").alias("dst"), "n"))
    totals = both.groupBy("kind", "src").agg(F.sum("n").alias("total"), F.ceil(F.count("*") / F.lit(HUB)).cast("int").alias("parts"))
    return both.join(totals, ["kind", "src"]).select("kind", "src", "dst", F.expr("cast(pmod(xxhash64(dst), parts) AS int)").alias("salt"), "parts", (F.col("n") / F.col("total")).alias("share"))


def spread(seeds: DataFrame, links: DataFrame, tolerance: float, damping: float) -> DataFrame:
    """(kind, host, score): personalised PageRank of each kind from (kind, host, seed), scaled to sum to the seeds' weight.

    Both kinds take each round together: one join and one aggregate. What flows falls by the damping at least, so the
    rounds end. Every FOLD rounds the waves are added up and their tables deleted.
    """
    hubs = links.filter("parts > 1").select(F.col("kind").alias("h_kind"), F.col("src").alias("h_src"), "parts").distinct()
    hubs = stash(hubs, "hubs")  # at most one row for HUB links
    added = lambda tables: reduce(DataFrame.unionByName, tables).groupBy("kind", "host").agg(F.sum("score").alias("score"))
    waves = [stash(seeds.select("kind", "host", ((1 - damping) * F.col("seed")).alias("score")).filter("score > 0"), "wave")]
    while (waves[-1].agg(F.sum("score")).first()[0] or 0.0) * damping / (1 - damping) > tolerance:
        out = waves[-1].join(hubs, (F.col("kind") == F.col("h_kind")) & (F.col("host") == F.col("h_src")), "left").select(
            F.col("kind").alias("w_kind"), "host", "score", F.explode(F.expr("sequence(0, coalesce(parts, 1) - 1)")).alias("w_salt"))
        met = links.join(out, (F.col("kind") == F.col("w_kind")) & (F.col("src") == F.col("host")) & (F.col("salt") == F.col("w_salt")))
        waves.append(stash(met.groupBy("kind", F.col("dst").alias("host")).agg(F.sum(F.col("share") * F.col("score") * damping).alias("score")), "wave"))
        if len(waves) > FOLD:
            past = stash(added(waves[:-1]), "rank")
            drop(*waves[:-1])
            waves = [past, waves[-1]]
    score = stash(added(waves), "rank")
    drop(*waves)
    reached = score.groupBy("kind").agg(F.sum("score").alias("reached")).join(seeds.groupBy("kind").agg(F.sum("seed").alias("weight")), "kind")
    return score.join(reached, "kind").select("kind", "host", (F.col("score") / F.col("reached") * F.col("weight")).alias("score"))


def judged_hosts(pages_ruled: DataFrame, links: DataFrame, tolerance: float = TOLERANCE, damping: float = DAMPING, threshold: float = THRESHOLD) -> DataFrame:
    """(host, trust, distrust) of the hosts whose distrust exceeds their trust by more than the threshold.

    A host's seeds are the shares of its pages that rules allow and block.
    """
    by_host = pages_ruled.groupBy("host").agg(F.avg(F.expr("if(by_rule = 'allow', 1D, 0D)")).alias("trust"), F.avg(F.expr("if(by_rule = 'block', 1D, 0D)")).alias("distrust"))
    seeds = stash(by_host.filter("host <> ''").select("host", F.expr("stack(2, 'trust', trust, 'distrust', distrust) AS (kind, seed)")).filter("seed > 0"), "seeds")
    links = stash(links, "links")
    scores = seeds.withColumnRenamed("seed", "score") if links.isEmpty() else spread(seeds, stash(shares(links), "shares"), tolerance, damping)
    both = scores.groupBy("host").agg(*(F.coalesce(F.sum(F.when(F.col("kind") == k, F.col("score"))), F.lit(0.0)).alias(k) for k in ("trust", "distrust")))
    return both.filter(F.col("distrust") - F.col("trust") > threshold)


def url_filter(pages: DataFrame, rules: tuple[UrlRule, ...] = RULES, tolerance: float = TOLERANCE, damping: float = DAMPING, threshold: float = THRESHOLD) -> DataFrame:
    """page_id, host, path, rule and verdict of every page."""
    ruled = with_rule(split_url(pages.select("page_id", "url")), rules)
    blocked = stash(judged_hosts(ruled, host_links(pages), tolerance, damping, threshold).select("host", F.lit("block").alias("by_graph")), "blocked-hosts")
    return ruled.join(blocked, "host", "left").select("page_id", "host", "path", "rule", F.coalesce("by_rule", "by_graph", F.lit("allow")).alias("verdict"))


def oracle(rules: tuple[UrlRule, ...] = RULES, rounds: int = SQL_ROUNDS, damping: float = DAMPING, threshold: float = THRESHOLD) -> str:
    """DuckDB SQL for url_filter: a recursive table of waves, added up at the end."""
    def parts(src: str, url: str, keep: str) -> str:
        return (f"SELECT {keep}, translate(regexp_extract(rest, '^[^/?#]*'), '{UPPER}', '{LOWER}') AS host, regexp_extract(substr(rest, length(regexp_extract(rest, '^[^/?#]*')) + 1), '^[^?#]*') AS path"
                f" FROM (SELECT *, coalesce(CASE WHEN instr({url}, '://') > 0 THEN substr({url}, instr({url}, '://') + 3) END, '') AS rest FROM {src})")

    order = sorted(rules, key=lambda r: (-len(r.rule), r.rule))
    case = lambda v: "CASE " + " ".join(f"WHEN (host = '{r.host}' OR ends_with(host, '.{r.host}')) AND starts_with(path, '{r.path}') THEN '{getattr(r, v)}'" for r in order) + " END"
    href = HREF.replace("'", "''")
    ctes = [
        f"split AS ({parts('pages', 'url', 'page_id, url, html')})",
        f"ruled AS (SELECT *, {case('rule')} AS rule, {case('verdict')} AS by_rule FROM split)",
        f"hrefs AS (SELECT src, CASE WHEN starts_with(u, '//') THEN 'http:' || u ELSE u END AS u FROM (SELECT host AS src, unnest(regexp_extract_all(html, '{href}', 1)) AS u FROM split))",
        f"pairs AS (SELECT src, host AS dst FROM ({parts('hrefs', 'u', 'src')}) WHERE src <> host AND src <> '' AND host <> '')",
        "counted AS MATERIALIZED (SELECT src, dst, count(*) AS n FROM pairs GROUP BY ALL)",
        "shares AS MATERIALIZED (SELECT 'trust' AS kind, src, dst, n / sum(n) OVER (PARTITION BY src) AS share FROM counted UNION ALL SELECT 'distrust', dst, src, n / sum(n) OVER (PARTITION BY dst) FROM counted)",
        "rated AS (SELECT host, avg(CASE WHEN by_rule = 'allow' THEN 1.0::DOUBLE ELSE 0 END) AS t, avg(CASE WHEN by_rule = 'block' THEN 1.0::DOUBLE ELSE 0 END) AS b FROM ruled WHERE host <> '' GROUP BY host)",
        "seeds AS MATERIALIZED (SELECT 'trust' AS kind, host, t AS seed FROM rated WHERE t > 0 UNION ALL SELECT 'distrust', host, b FROM rated WHERE b > 0)",
        f"waves AS (SELECT kind, host, {1 - damping} * seed AS score, 0 AS hop FROM seeds UNION ALL"
        f" SELECT s.kind, dst, sum(share * score * {damping}), hop + 1 FROM waves w JOIN shares s ON s.kind = w.kind AND s.src = w.host WHERE hop < {rounds} GROUP BY s.kind, dst, hop)",
        "ranks AS (SELECT kind, host, sum(score) AS score FROM waves GROUP BY ALL)",
        "scaled AS (SELECT kind, host, score / sum(score) OVER (PARTITION BY kind) * weight AS score FROM ranks JOIN (SELECT kind, sum(seed) AS weight FROM seeds GROUP BY kind) USING (kind))",
        f"blocked AS (SELECT host FROM scaled GROUP BY host HAVING sum(CASE kind WHEN 'trust' THEN -score ELSE score END) > {threshold})",
    ]
    return "WITH RECURSIVE " + ",\n".join(ctes) + "\nSELECT page_id, host, path, rule, coalesce(by_rule, CASE WHEN host IN (SELECT host FROM blocked) THEN 'block' END, 'allow') AS verdict FROM ruled"

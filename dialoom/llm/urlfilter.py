"""URL filtering with block and allow rules, and gradient-boosted trees for URLs that no rule fits.

The trees see lexical features only: lengths, path depth, shares of digits, entropy, parameter counts and
statistics of the host's suffix. They are fitted to the URLs that rules label (a bounded sample) with
histograms of gradients, and then become one SQL expression, so that all URLs are judged inside the JVM.
"""

from __future__ import annotations

import math
from dataclasses import dataclass

import numpy as np
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from dialoom.llm.shared import Scratch


@dataclass(frozen=True)
class Rule:
    verdict: str
    host: str
    path: str

    @property
    def name(self) -> str:
        return self.host + self.path


RULES = (
    Rule("block", "com", "/en/"),
    Rule("allow", "example.com", "/en/7"),
    Rule("allow", "net", "/de/"),
    Rule("block", "example.net", "/de/8"),
    Rule("block", "org", "/es/"),
)


@dataclass(frozen=True)
class Plan:
    #: Most labelled URLs that the trees are fitted to, drawn by a hash of id and URL, so that copies don't come together.
    sample: int = 20_000
    trees: int = 24
    depth: int = 3
    rate: float = 0.3
    bins: int = 24
    #: Most suffixes whose statistics are in the expression; those of all others are joined, with the same result.
    suffixes: int = 256
    #: Rules that are tested in one expression; more are joined by host suffix and path prefix, with the same result.
    rules: int = 200
    #: Parts of the labelled URLs; the statistics of a suffix that the trees are fitted to come from the other parts.
    folds: int = 5


FEATURES = ("length", "host_length", "path_length", "depth", "host_dots", "digits", "path_digits", "hyphens", "entropy", "parameters", "has_fragment", "secure", "suffix_rows", "suffix_blocked")


def parse(url: Column) -> dict[str, Column]:
    """Host and path; both empty if the url is null or has no ``://``."""
    at = F.instr(url, "://")
    rest = F.when(at > 0, F.substring(url, at + 3, F.length(url))).otherwise(F.lit(""))
    rest = F.coalesce(rest, F.lit(""))
    upper, lower = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
    return {
        "host": F.translate(F.regexp_extract(rest, r"^([^/?#]*)", 1), upper, lower),
        "path": F.regexp_extract(rest, r"^[^/?#]*([^?#]*)", 1),
    }


def _best_first(rules: tuple[Rule, ...]) -> list[Rule]:
    """The longest first; of equally long ones that with the longer host, then a block."""
    return sorted(rules, key=lambda r: (-len(r.name), -len(r.host), r.verdict != "block", r.name))


def fitting(rules: tuple[Rule, ...], host: Column, path: Column) -> tuple[Column, Column]:
    """Name and verdict of the longest rule that fits (of equally long ones, that with the longer host, then a block)."""
    name = verdict = None
    for r in _best_first(rules):
        fits = ((host == r.host) | host.endswith("." + r.host)) & path.startswith(r.path)
        name = F.when(fits, r.name) if name is None else name.when(fits, r.name)
        verdict = F.when(fits, r.verdict) if verdict is None else verdict.when(fits, r.verdict)
    null = F.lit(None).cast("string")
    return (null, null) if name is None else (name.otherwise(null), verdict.otherwise(null))


def by_join(rows: DataFrame, rules: tuple[Rule, ...]) -> DataFrame:
    """Adds ``rule`` and ``ruled`` to rows with host and path, for any number of rules.

    Each different (host, path) is given its host's suffixes and those prefixes of its path that are as long as some
    rule's path, and these meet the rules by equality: what is joined doesn't grow with the number of rules that a host
    has. The least place in the rules' order wins.
    """
    spark = rows.sparkSession
    order = _best_first(rules)
    places: dict[tuple[str, str], int] = {}
    for i, r in enumerate(order):
        places.setdefault((r.host, r.path), i)
    table = spark.createDataFrame([(h, p, i, order[i].name, order[i].verdict) for (h, p), i in places.items()], "rule_host string, rule_path string, place int, rule string, ruled string")
    lengths = F.array(*map(F.lit, sorted({len(r.path) for r in rules})))
    kinds = rows.select("host", "path").distinct()
    labels = F.split("host", r"\.")
    suffixes = F.transform(F.sequence(F.lit(1), F.size(labels)), lambda i: F.array_join(F.slice(labels, i, F.size(labels)), "."))
    prefixes = F.transform(F.filter(lengths, lambda n: n <= F.length("path")), lambda n: F.substring(F.col("path"), F.lit(1), n))
    tried = kinds.select("host", "path", F.explode(F.array_distinct(suffixes)).alias("rule_host"), prefixes.alias("ps")).select("host", "path", "rule_host", F.explode("ps").alias("rule_path"))
    met = tried.join(table, ["rule_host", "rule_path"]).groupBy("host", "path").agg(F.min(F.struct("place", "rule", "ruled")).alias("r"))
    return rows.join(met.select("host", "path", "r.rule", "r.ruled"), ["host", "path"], "left")


def _with_suffixes(rows: DataFrame, top: dict[str, tuple[int, float]], others: DataFrame | None) -> DataFrame:
    """Adds ``suffix_rows`` and ``suffix_blocked``, of the suffixes in ``top`` by a map and of the others, if there are any, by
    a join with ``others(suffix, deal, other_rows, other_blocked)``, where ``deal`` is 0."""
    maps = [F.create_map(*(F.lit(x) for s, v in top.items() for x in (s, float(v[k]))))[F.col("suffix")] if top else F.lit(None).cast("double") for k in (0, 1)]
    if others is None:
        return rows.withColumns({"suffix_rows": maps[0], "suffix_blocked": maps[1]})
    # rows of frequent suffixes meet nothing there, and are dealt out by their URLs
    rows = rows.withColumn("deal", F.when(maps[0].isNull(), F.lit(0).cast("long")).otherwise(F.xxhash64("url")))
    rows = rows.join(others, ["suffix", "deal"], "left")
    found = {"suffix_rows": F.coalesce(maps[0], "other_rows"), "suffix_blocked": F.coalesce(maps[1], "other_blocked")}
    return rows.withColumns(found).drop("deal", "other_rows", "other_blocked")


def _with_features(rows: DataFrame) -> DataFrame:
    """Of rows that have their suffix's statistics."""
    url, path = F.coalesce("url", F.lit("")), F.col("path")
    count = lambda s, kept: F.length(F.regexp_replace(s, f"[^{kept}]", "")).cast("double")
    rows = rows.withColumn("u", F.substring(url, 1, 1 << 30)).withColumn("n", F.greatest(F.lit(1), F.length(url)).cast("double"))
    chars = F.array_distinct(F.split("u", ""))
    each = F.transform(chars, lambda c: (F.col("n") - F.length(F.replace(F.col("u"), c, F.lit("")))) / F.col("n"))
    entropy = F.aggregate(each, F.lit(0.0), lambda a, p: a - F.when(p > 0, p * F.log2(p)).otherwise(0.0))
    query = F.regexp_extract("u", r"\?([^#]*)", 1)
    return rows.withColumns(
        {
            "length": F.length("u").cast("double"),
            "host_length": F.length("host").cast("double"),
            "path_length": F.length(path).cast("double"),
            "depth": F.size(F.filter(F.split(path, "/"), lambda s: s != "")).cast("double"),
            "host_dots": count(F.col("host"), "."),
            "digits": count(F.col("u"), "0-9") / F.col("n"),
            "path_digits": count(path, "0-9"),
            "hyphens": count(F.col("u"), "_-"),
            "entropy": entropy,
            "parameters": F.size(F.filter(F.split(query, "&"), lambda s: s != "")).cast("double"),
            "has_fragment": F.contains("u", F.lit("#")).cast("double"),
            "secure": F.startswith("u", F.lit("https://")).cast("double"),
        }
    ).drop("u", "n")


def boost(x: np.ndarray, y: np.ndarray, plan: Plan) -> tuple[float, list]:
    """Log-odds to start from, and trees: a leaf is a number, a node (feature, threshold, left, right), left at or below."""
    share = (y.sum() + 1) / (len(y) + 2)
    start = math.log(share / (1 - share))
    if len(y) == 0 or y.min() == y.max():
        return start, []
    cuts = [np.unique(np.quantile(x[:, j], np.linspace(0, 1, plan.bins + 1)[1:-1])) for j in range(x.shape[1])]
    binned = np.stack([np.searchsorted(c, x[:, j], "left") for j, c in enumerate(cuts)], axis=1)  # value <= cut b  <=>  bin <= b
    score, trees = np.full(len(y), start), []

    def grow(rows, g, h, depth):
        total_g, total_h = g[rows].sum(), h[rows].sum()
        leaf = float(-plan.rate * total_g / (total_h + 1.0))
        best = (1e-6, None, None)
        if depth:
            for j, c in enumerate(cuts):
                if not len(c):
                    continue
                gs = np.cumsum(np.bincount(binned[rows, j], g[rows], len(c) + 1))[:-1]
                hs = np.cumsum(np.bincount(binned[rows, j], h[rows], len(c) + 1))[:-1]
                gain = gs**2 / (hs + 1) + (total_g - gs) ** 2 / (total_h - hs + 1) - total_g**2 / (total_h + 1)
                gain[(hs < 1) | (total_h - hs < 1)] = 0
                b = int(gain.argmax())
                if gain[b] > best[0]:
                    best = (float(gain[b]), j, b)
        _, j, b = best
        if j is None:
            score[rows] += leaf
            return leaf
        left = binned[rows, j] <= b
        return (j, float(cuts[j][b]), grow(rows[left], g, h, depth - 1), grow(rows[~left], g, h, depth - 1))

    for _ in range(plan.trees):
        p = 1 / (1 + np.exp(-score))
        trees.append(grow(np.arange(len(y)), p - y, p * (1 - p), plan.depth))
    return start, trees


def tree_sql(tree) -> str:
    if not isinstance(tree, tuple):
        return f"{tree!r}D"
    j, cut, left, right = tree
    return f"CASE WHEN {FEATURES[j]} <= {cut!r}D THEN {tree_sql(left)} ELSE {tree_sql(right)} END"


def judge(pages: DataFrame, rules: tuple[Rule, ...] = RULES, plan: Plan = Plan()) -> DataFrame:
    """One row per row of ``pages(page_id, url)``: page_id, host, path, rule, verdict, score (of being blocked).

    A null url, or one without ``://``, has an empty host and path, fits no rule and is judged by the trees.
    Where rules label no URL, or all alike, the trees are empty and the commoner label decides (allow on a tie
    or without labels). Equal URLs are judged alike; repeated rows are all returned.
    """
    rows = pages.select("page_id", "url")
    rows = rows.withColumns(parse(F.col("url")))
    if len(rules) > plan.rules:
        rows = by_join(rows, rules)
    else:
        name, verdict = fitting(rules, F.col("host"), F.col("path"))
        rows = rows.withColumns({"rule": name, "ruled": verdict})
    rows = rows.withColumns({"suffix": F.coalesce(F.regexp_extract("host", r"([^.]*)$", 1), F.lit("")), "fold": F.pmod(F.xxhash64("url", F.lit(2)), F.lit(plan.folds)).cast("int")})
    blocked = lambda *fold: F.coalesce(F.sum(((F.col("ruled") == "block") & (F.col("fold") == fold[0] if fold else F.lit(True))).cast("double")), F.lit(0.0))
    labelled = lambda *fold: F.count(F.when(F.col("fold") == fold[0], F.col("ruled")) if fold else F.col("ruled"))
    of_fold = [f.alias(f"{c}{i}") for i in range(plan.folds) for c, f in (("k", labelled(i)), ("b", blocked(i)))]
    scratch = Scratch(rows.sparkSession, "urls")
    stats = rows.groupBy("suffix").agg(F.count("*").alias("n"), labelled().alias("k"), blocked().alias("b"), *of_fold)
    stats = scratch.save(stats.withColumn("deal", F.lit(0).cast("long")), "suffixes")
    whole = stats.agg(F.sum("k").alias("k"), F.sum("b").alias("b"), F.count("*").alias("kinds")).first()
    base = ((whole["b"] or 0) + 1) / ((whole["k"] or 0) + 2)
    rate = lambda b, k: (b + 10 * base) / (k + 10)
    top = {r["suffix"]: (r["n"], rate(r["b"], r["k"])) for r in stats.orderBy(F.desc("n"), "suffix").limit(plan.suffixes).select("suffix", "n", "k", "b").collect()}
    others = None
    if whole["kinds"] > len(top):
        others = stats.where(~F.col("suffix").isin(*top)) if top else stats
        others = others.select("suffix", "deal", F.col("n").cast("double").alias("other_rows"), rate(F.col("b"), F.col("k")).alias("other_blocked"))
    featured = _with_features(_with_suffixes(rows, top, others))
    share = min(1.0, 1.1 * plan.sample / whole["k"]) if whole["k"] else 1.0
    drawn = rows.where(F.col("ruled").isNotNull() & (F.pmod(F.xxhash64("page_id", "url"), F.lit(1 << 30)) < int(share * (1 << 30))))
    order = F.xxhash64("page_id", "url", F.lit(1)), F.col("page_id")
    # a labelled URL must not be told by its own label
    kept = lambda c: F.col(c) - F.array(*(f"{c}{i}" for i in range(plan.folds)))[F.col("fold")]
    sample = drawn.orderBy(*order).limit(plan.sample).join(stats.drop("deal"), "suffix")
    sample = sample.withColumns({"suffix_rows": F.col("n").cast("double"), "suffix_blocked": rate(kept("b"), kept("k"))}).drop(*stats.columns[1:])
    got = _with_features(sample).orderBy(*order).select(*FEATURES, "ruled").collect()
    if others is None:
        scratch.drop("suffixes")
    x = np.array([[r[f] for f in FEATURES] for r in got], float).reshape(len(got), len(FEATURES))
    y = np.array([r["ruled"] == "block" for r in got], float)
    start, trees = boost(x, y, plan)
    odds = " + ".join([f"{start!r}D", *(f"({tree_sql(t)})" for t in trees)])
    score = F.expr(f"1D / (1D + exp(-({odds})))")
    by_trees = F.when(F.col("score") > 0.5, "block").otherwise("allow")
    return featured.withColumn("score", score).select("page_id", "host", "path", "rule", F.coalesce("ruled", by_trees).alias("verdict"), "score")

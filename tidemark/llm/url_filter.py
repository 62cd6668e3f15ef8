"""URL filters (operator 12): rules, and gradient-boosted trees on lexical features for the URLs that no rule fits.

A rule is a host, which holds for its subdomains too, and the start of a path; the longest that fits decides. The URLs that a rule
fits are the labelled ones: trees learn from them what blocked URLs look like and judge the rest. Features are lengths, depth,
shares of digits and other characters, entropy, parameter counts, and statistics of suffixes: for the host's last label, its last
two, the path's first folder and its file extension, how many labelled URLs have it and which share of them is blocked. Statistics
count all distinct labelled URLs; in training a URL's own label is left out of them. The trees are fitted on at most ``SAMPLE``
distinct labelled URLs in hash order, so a URL with any number of copies is one of them.

A null url, or one without ``://``, has an empty host and path and is judged by its other features. Without labelled URLs
all others are allowed; if all labels agree, others get that verdict. Repeated rows give repeated rows; an empty table gives an empty
table. Only page_id and url are read, so other columns may have any name. URLs are read whole.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.ml.classification import GBTClassificationModel, GBTClassifier
from pyspark.ml.feature import VectorAssembler
from pyspark.ml.functions import vector_to_array
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidemark.llm.common import written

#: (verdict, host and start of the path).
RULES = (("allow", "org/"), ("block", "example.org/es/"), ("block", "example.org/en/1"), ("allow", "com/fr/"), ("block", "com/de/"))
#: Distinct labelled URLs used for fitting, at most.
SAMPLE = 10_000
TREES, DEPTH, RATE, SEED = 20, 4, 0.3, 12
#: A suffix counts as this many more URLs with the share of all.
PRIOR = 4.0
_UPPER, _LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
LEXICAL = (
    "n_url", "n_host", "n_path", "n_query", "depth", "labels", "parameters", "digits", "host_digits", "entropy", "symbols", "hyphens",
    "secure", "fragment",
)
SUFFIXES = ("top", "site", "folder", "extension")
FEATURES = [*LEXICAL, *(f"{s}_{x}" for s in SUFFIXES for x in ("share", "count"))]


@dataclass
class Model:
    """``trees`` is null where ``verdict`` is everybody's."""

    trees: GBTClassificationModel | None
    verdict: str
    statistics: DataFrame
    share: float


def host_of(url: Column) -> Column:
    host = F.regexp_extract(F.coalesce(url, F.lit("")), r"(?s)^.*?://([^/?#]*)", 1)
    return F.translate(host, _UPPER, _LOWER)


def path_of(url: Column) -> Column:
    return F.regexp_extract(F.coalesce(url, F.lit("")), r"(?s)^.*?://[^/?#]*([^?#]*)", 1)


def rule_of(host: Column, path: Column, rules=RULES) -> Column:
    """(verdict, rule) of the longest rule that fits, of equally long ones a block; null if none does."""
    found = []
    for verdict, rule in sorted(rules, key=lambda r: (-len(r[1]), r[0] != "block")):
        own, slash, start = rule.partition("/")
        fits = ((host == own) | host.endswith("." + own)) & path.startswith(slash + start)
        found.append(F.when(fits, F.struct(F.lit(verdict).alias("verdict"), F.lit(rule).alias("rule"))))
    return F.coalesce(*found, F.lit(None).cast("struct<verdict:string,rule:string>"))


def ruled(pages: DataFrame, rules=RULES) -> DataFrame:
    """(page_id, url, host, path, rule, verdict); the last two are null where no rule fits."""
    rows = pages.select("page_id", "url", host_of(F.col("url")).alias("host"), path_of(F.col("url")).alias("path"))
    rows = rows.withColumn("_found", rule_of(F.col("host"), F.col("path"), rules))
    return rows.select("page_id", "url", "host", "path", F.col("_found.rule").alias("rule"), F.col("_found.verdict").alias("verdict"))


def entropy(text: Column) -> Column:
    """Bits per character: sorted, equal characters are runs, whose lengths are the counts."""
    runs = F.regexp_extract_all(F.array_join(F.array_sort(F.split(text, "")), ""), F.lit(r"(?s)(.)\1*"), F.lit(0))
    n = F.length(text)
    told = F.aggregate(runs, F.lit(0.0), lambda s, r: s + F.length(r) * F.log2(F.length(r)))
    return F.when(n > 0, F.log2(n) - told / n).otherwise(0.0)


def _count(text: Column, of: str) -> Column:
    return F.length(F.regexp_replace(text, f"[^{of}]", "")).cast("double")


def with_features(rows: DataFrame) -> DataFrame:
    """``rows`` (url, host, path) with the lexical features and the names of the suffixes."""
    url, host, path = F.coalesce("url", F.lit("")), F.col("host"), F.col("path")
    query = F.regexp_extract(url, r"(?s)^[^?#]*\?([^#]*)", 1)
    n = F.greatest(F.length(url), F.lit(1))
    last = F.element_at(F.split(path, "/"), -1)
    return rows.withColumns({
        "n_url": F.log1p(F.length(url)), "n_host": F.length(host).cast("double"), "n_path": F.log1p(F.length(path)),
        "n_query": F.log1p(F.length(query)), "depth": _count(path, "/"), "labels": _count(host, "."),
        "parameters": F.when(query != "", _count(query, "&;") + 1).otherwise(0.0), "digits": _count(url, "0-9") / n,
        "host_digits": _count(host, "0-9") / F.greatest(F.length(host), F.lit(1)), "entropy": entropy(url),
        "symbols": _count(url, "%_~=+") / n, "hyphens": _count(host, r"\-"), "secure": url.startswith("https:").cast("double"),
        "fragment": url.contains("#").cast("double"),
        "top": F.substring_index(host, ".", -1), "site": F.substring_index(host, ".", -2),
        "folder": F.regexp_extract(path, r"(?s)^/([^/]*)/", 1), "extension": F.regexp_extract(last, r"(?s)\.([^.]*)$", 1),
    })


def statistics(urls: DataFrame) -> DataFrame:
    """(kind, name, n, blocked) of every suffix among distinct labelled URLs (suffix names, blocked); written."""
    names = F.explode(F.array(*[F.struct(F.lit(s).alias("kind"), F.col(s).alias("name")) for s in SUFFIXES]))
    each = urls.select(names.alias("s"), "blocked").select("s.*", "blocked")
    return written(each.groupBy("kind", "name").agg(F.count("*").alias("n"), F.sum("blocked").alias("blocked")), "suffixes")


def with_statistics(rows: DataFrame, found: DataFrame, share: float, own: Column | None = None) -> DataFrame:
    """``rows`` with each suffix's share of blocked URLs and count; ``own`` is the row's label, which is left out.

    Spark broadcasts a kind's statistics if they are small and else splits a frequent suffix's rows, as they are a table.
    """
    for s in SUFFIXES:
        these = found.filter(F.col("kind") == s).select(F.col("name").alias(s), F.col("n").alias("_n"), F.col("blocked").alias("_b"))
        n, b = F.coalesce("_n", F.lit(0)), F.coalesce("_b", F.lit(0))
        n, b = (n, b) if own is None else (n - 1, b - own)
        rows = rows.join(these, s, "left").withColumns({
            f"{s}_share": (b + PRIOR * share) / (n + PRIOR), f"{s}_count": F.log1p(n),
        }).drop("_n", "_b")
    return rows


def _assembled(rows: DataFrame) -> DataFrame:
    return VectorAssembler(inputCols=FEATURES, outputCol="_features").transform(rows)


def fit(urls: DataFrame, bound: int = SAMPLE) -> Model:
    """A model from the labelled URLs (url, host, path, verdict)."""
    once = urls.filter("url is not null").groupBy("url", "host", "path").agg(F.max(F.when(F.col("verdict") == "block", 1).otherwise(0)).alias("blocked"))
    once = written(with_features(once).select("url", "blocked", *LEXICAL, *SUFFIXES), "labelled")
    n, blocked = once.agg(F.count("*"), F.sum("blocked")).first()
    share = (blocked or 0) / max(n, 1)
    found = statistics(once)
    if share in (0.0, 1.0):
        return Model(None, "block" if share else "allow", found, share)
    chosen = once.orderBy(F.xxhash64("url"), "url").limit(bound)
    rows = with_statistics(chosen, found, share, F.col("blocked"))
    # the bounded sample, as one table: the trees' jobs don't repeat the joins
    rows = written(rows.select(F.col("blocked").cast("double").alias("blocked"), *FEATURES).coalesce(2), "sample")
    trees = GBTClassifier(featuresCol="_features", labelCol="blocked", maxIter=TREES, maxDepth=DEPTH, stepSize=RATE, seed=SEED)
    return Model(trees.fit(_assembled(rows)), "", found, share)


def predicted(rows: DataFrame, model: Model) -> DataFrame:
    """``rows`` (url, host, path) with ``score`` (0 to 1, higher: block likelier) and ``verdict``."""
    kept = rows.columns
    if model.trees is None:
        return rows.withColumns({"score": F.lit(model.share), "verdict": F.lit(model.verdict)})
    out = model.trees.transform(_assembled(with_statistics(with_features(rows), model.statistics, model.share)))
    score = vector_to_array("probability")[1]
    return out.select(*kept, score.alias("score"), F.when(score >= 0.5, "block").otherwise("allow").alias("verdict"))


def judge(pages: DataFrame, rules=RULES) -> DataFrame:
    """(page_id, host, path, rule, verdict, score) of every row; score is null where a rule decides."""
    rows = ruled(pages, rules)
    model = fit(rows.filter("rule is not null").select("url", "host", "path", "verdict"))
    rest = predicted(rows.filter("rule is null").select("page_id", "url", "host", "path"), model)
    columns = ["page_id", "host", "path", "rule", "verdict", "score"]
    by_rule = rows.filter("rule is not null").withColumn("score", F.lit(None).cast("double"))
    return by_rule.select(*columns).unionByName(rest.withColumn("rule", F.lit(None).cast("string")).select(*columns))

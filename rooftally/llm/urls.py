"""URL filter: a list of host and path rules, and gradient-boosted trees on lexical features for all other URLs.

Only DataFrame functions and Spark's own tree learner: URLs that a rule decides are the labelled ones; their
distinct feature rows, weighted by their number, train the trees, which judge the rest.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.ml.classification import GBTClassifier
from pyspark.ml.feature import VectorAssembler
from pyspark.ml.functions import vector_to_array
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from rooftally.session import lookup_join, stage

#: Distinct feature rows of labelled URLs that the trees are trained on at most, chosen by a hash.
TRAIN_ROWS = 200_000
TREES, DEPTH, SEED = 12, 3, 7
#: URLs with the average share that a suffix's own share is mixed with.
PRIOR_URLS = 20
FEATURES = ["f_length", "f_host_length", "f_labels", "f_depth", "f_digits", "f_entropy", "f_parameters", "f_hyphens", "f_suffix", "f_site"]


@dataclass(frozen=True)
class Rule:
    """``where`` is a host and the start of a path, like ``example.net/en/``; it holds for all subdomains too."""

    where: str
    verdict: str

    @property
    def host(self) -> str:
        return self.where.partition("/")[0]

    @property
    def path(self) -> str:
        return "/" + self.where.partition("/")[2]


def lower_ascii(text: Column) -> Column:
    return F.translate(text, "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def after_scheme(url: Column) -> Column:
    """What follows the first ``://``; empty without one and for NULL."""
    at = F.instr(url, "://")
    return F.coalesce(F.when(at > 0, F.substring(url, at + 3, F.length(url))), F.lit(""))


def host_of(url: Column) -> Column:
    return lower_ascii(F.regexp_extract(after_scheme(url), "^([^/?#]*)", 1))


def path_of(url: Column) -> Column:
    return F.regexp_extract(after_scheme(url), "^[^/?#]*([^?#]*)", 1)


def longest_rule(host: Column, path: Column, rules: list[Rule], field: str) -> Column:
    """``field`` of the longest rule that fits, else NULL. For lists of up to a few hundred rules."""
    found = F.lit(None).cast("string")
    for rule in sorted(rules, key=lambda r: (len(r.where), r.where)):
        fits = ((host == rule.host) | host.endswith("." + rule.host)) & path.startswith(rule.path)
        found = F.when(fits, F.lit(getattr(rule, field))).otherwise(found)
    return found


def count_of(text: Column, what: str) -> Column:
    return F.length(text) - F.length(F.replace(text, F.lit(what), F.lit("")))


def lexical(url: Column, host: Column, path: Column) -> dict[str, Column]:
    """Features of a URL's text alone."""
    size = F.length(url)
    share = lambda c: (size - F.length(F.replace(url, c, F.lit("")))) / size
    entropy = F.aggregate(F.array_distinct(F.split(url, "")), F.lit(0.0), lambda s, c: F.when(c == "", s).otherwise(s - share(c) * F.log2(share(c))))
    return {
        "f_length": size,
        "f_host_length": F.length(host),
        "f_labels": F.size(F.split(host, "\\.")),
        "f_depth": count_of(path, "/"),
        "f_digits": F.when(size > 0, (size - F.length(F.translate(url, "0123456789", ""))) / size).otherwise(0.0),
        "f_entropy": F.when(size > 0, entropy).otherwise(0.0),
        "f_parameters": count_of(url, "=") + count_of(url, "&"),
        "f_hyphens": count_of(url, "-"),
    }


def suffix_share(rows: DataFrame, labelled: DataFrame, key: str, name: str, mean: float) -> DataFrame:
    """``rows`` with the share of blocked URLs among the labelled ones of the same ``key``, drawn to the mean."""
    known = labelled.groupBy(key).agg(F.count(F.lit(1)).alias("_n"), F.sum("_label").alias("_blocked"))
    known = known.select(key, ((F.col("_blocked") + PRIOR_URLS * mean) / (F.col("_n") + PRIOR_URLS)).alias(name))
    return lookup_join(rows, stage(known), [key], "left", max_rows=50_000).fillna(mean, [name])


def judge_urls(pages: DataFrame, rules: list[Rule], page_id: str = "page_id", url: str = "url", max_train_rows: int = TRAIN_ROWS) -> DataFrame:
    """A verdict for every URL: the longest rule's, else that of trees trained on the URLs that rules decide.

    Returns ``page_id``, ``host``, ``path``, ``rule`` (NULL where none fits), ``verdict`` (``allow`` or ``block``), ``score``
    (the trees' probability of ``block``; 1 or 0 where a rule decides). NULL URLs and those without ``://`` have an empty
    host and path and are judged by the trees as an empty text. Without labelled URLs everything is allowed; with one
    kind of label that kind is the verdict. Repeated rows and ids are kept, other input columns are not read.
    """
    raw = F.coalesce(F.col(url).cast("string"), F.lit(""))
    rows = pages.select(F.col(page_id).alias("page_id"), raw.alias("_url"), host_of(F.col(url)).alias("host"), path_of(F.col(url)).alias("path"))
    rows = rows.withColumns({f"_{f}": longest_rule(F.col("host"), F.col("path"), rules, f) for f in ("where", "verdict")})
    rows = rows.withColumn("_label", F.when(F.col("_verdict").isNotNull(), (F.col("_verdict") == "block").cast("int")))
    decided = rows.filter("_label IS NOT NULL")
    n, blocked = decided.agg(F.count(F.lit(1)), F.coalesce(F.sum("_label"), F.lit(0))).first()
    ruled = decided.select("page_id", "host", "path", F.col("_where").alias("rule"), F.col("_verdict").alias("verdict"), F.col("_label").cast("double").alias("score"))
    left = rows.filter("_label IS NULL").select("page_id", "host", "path", "_url")
    if blocked in (0, n):
        constant = 1.0 if n and blocked == n else 0.0
        judged = left.withColumn("score", F.lit(constant))
    else:
        judged = by_trees(left, decided, blocked / n, max_train_rows)
    judged = judged.select("page_id", "host", "path", F.lit(None).cast("string").alias("rule"), F.when(F.col("score") >= 0.5, "block").otherwise("allow").alias("verdict"), "score")
    return ruled.unionByName(judged)


def by_trees(left: DataFrame, decided: DataFrame, mean: float, max_train_rows: int) -> DataFrame:
    """``left`` with the ``score`` of trees trained on ``decided``."""
    labels = F.split("host", "\\.")
    ends = {"_suffix": F.element_at(labels, -1), "_site": F.concat_ws(".", F.slice(labels, F.greatest(F.lit(1), F.size(labels) - 1), 2))}
    label_rows = decided.select("_url", "host", "path", "_label").withColumns(ends)

    def featured(rows: DataFrame) -> DataFrame:
        rows = rows.withColumns(lexical(F.col("_url"), F.col("host"), F.col("path")))
        for key, name in (("_suffix", "f_suffix"), ("_site", "f_site")):
            rows = suffix_share(rows, label_rows, key, name, mean)
        return rows

    train = featured(label_rows).groupBy(*FEATURES, "_label").agg(F.count(F.lit(1)).cast("double").alias("_weight"))
    train = stage(train)
    size = train.count()
    if size > max_train_rows:
        train = train.filter(F.xxhash64(*FEATURES, "_label").cast("double") / 2.0**64 + 0.5 <= max_train_rows / size)
    assemble = VectorAssembler(inputCols=FEATURES, outputCol="_features", handleInvalid="keep")
    trees = GBTClassifier(featuresCol="_features", labelCol="_label", weightCol="_weight", maxIter=TREES, maxDepth=DEPTH, seed=SEED)
    model = trees.fit(assemble.transform(train))
    scored = model.transform(assemble.transform(featured(left.withColumns(ends))))
    return scored.withColumn("score", vector_to_array("probability")[1])

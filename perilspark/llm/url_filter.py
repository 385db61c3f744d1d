"""URL filter: allow and block rules first, gradient-boosted trees on lexical features for the rest.

Everything is DataFrame functions and Spark ML; the urls that a rule decides are the labelled ones from which the trees
learn (a bounded sample, ``TRAIN_ROWS``).
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.ml.classification import GBTClassifier
from pyspark.ml.feature import VectorAssembler
from pyspark.ml.functions import vector_to_array
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from perilspark.llm.common import bounded_sample
from perilspark.session import materialise

TRAIN_ROWS, TRAIN_PARTS = 20_000, 8
TREES, DEPTH, SEED = 20, 4, 1
_UPPER, _LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"


@dataclass(frozen=True)
class Rule:
    """A rule ``host/path``: it fits the host and its subdomains where the url's path starts with the rule's."""

    verdict: str
    text: str

    @property
    def host(self) -> str:
        return self.text.partition("/")[0]

    @property
    def path(self) -> str:
        return self.text[len(self.host) :]


#: The rules of the registered query.
RULES = [
    Rule("allow", "org/"),
    Rule("block", "example.org/es/"),
    Rule("block", "example.org/en/1"),
    Rule("allow", "com/fr/"),
    Rule("block", "com/de/"),
]

FEATURES = [
    "url_length", "host_length", "path_length", "depth", "labels", "digit_ratio", "hyphens", "entropy", "parameters", "fragment",
    "extension", "suffix_count", "suffix_blocked",
]


def with_parts(urls: DataFrame, url: str) -> DataFrame:
    """Adds ``host`` (A-Z lower-cased) and ``path``; both empty for a null url or one without ``://``."""
    at = F.instr(F.col(url), "://")
    rest = F.when(at > 0, F.col(url).substr(at + 3, F.length(url))).otherwise(F.lit(""))
    rest = F.coalesce(rest, F.lit(""))
    host = F.regexp_extract(rest, "^[^/?#]*", 0)
    path = F.regexp_extract(rest.substr(F.length(host) + 1, F.length(rest)), "^[^?#]*", 0)
    return urls.withColumns({"host": F.translate(host, _UPPER, _LOWER), "path": path})


def rule_column(rules: list[Rule], what: str) -> Column:
    """Text or verdict of the longest rule that fits; null if none does."""
    fits = []
    for rule in sorted(rules, key=lambda r: -len(r.text)):
        host = (F.col("host") == rule.host) | F.col("host").endswith("." + rule.host)
        fits.append(F.when(host & F.col("path").startswith(rule.path), F.lit(getattr(rule, what))))
    return F.coalesce(*fits) if fits else F.lit(None).cast("string")


def entropy(text: Column) -> Column:
    """Bits a character of a text's letter distribution."""
    letters = F.split(text, "")
    n = F.size(letters)
    share = lambda c: F.size(F.filter(letters, lambda x: x == c)) / n
    return -F.aggregate(F.array_distinct(letters), F.lit(0.0), lambda total, c: total + share(c) * F.log2(share(c)))


def with_features(urls: DataFrame, url: str) -> DataFrame:
    """Adds the lexical features and ``suffix``, the host's last label."""
    text = F.coalesce(F.col(url), F.lit(""))
    size = F.greatest(F.length(text), F.lit(1))
    count = lambda x, pattern: F.regexp_count(x, F.lit(pattern)).cast("double")
    query = F.regexp_extract(text, r"\?([^#]*)", 1)
    return urls.withColumns({
        "url_length": F.length(text).cast("double"),
        "host_length": F.length("host").cast("double"),
        "path_length": F.length("path").cast("double"),
        "depth": count(F.col("path"), "/"),
        "labels": count(F.col("host"), r"\."),
        "digit_ratio": count(text, "[0-9]") / size,
        "hyphens": count(F.col("host"), "-"),
        "entropy": F.coalesce(entropy(text), F.lit(0.0)),
        "parameters": count(query, "[^&]+"),
        "fragment": F.contains(text, F.lit("#")).cast("double"),
        "extension": F.col("path").rlike(r"\.[A-Za-z0-9]+$").cast("double"),
        "suffix": F.regexp_extract("host", r"[^.]*$", 0),
    })


def judge_urls(pages: DataFrame, rules: list[Rule] | None = None, key: str = "page_id", url: str = "url") -> DataFrame:
    """``key``, ``host``, ``path``, ``rule`` (the longest that fits, else null), ``verdict`` and ``score``.

    The verdict is the rule's; without a rule it is ``block`` if the trees give blocking at least one half, else
    ``allow``. Where the rules decide no urls of both kinds, there is nothing to learn and the rest is allowed
    (score 0). A null url or one without ``://`` has an empty host and path, fits no rule and is scored like others. One
    row for each row, repeated ones included; an empty table gives no rows; other columns are ignored.
    """
    rules = RULES if rules is None else rules
    rows = with_parts(pages.select(F.col(key).alias("id"), F.col(url).alias("url")), "url")
    rows = rows.withColumns({"rule": rule_column(rules, "text"), "by_rule": rule_column(rules, "verdict")})
    rows = materialise(with_features(rows, "url"), "urls")
    blocked = (F.col("by_rule") == "block").cast("double")
    # Counts of a host's last label over all urls, and the smoothed share of blocked ones among those that rules decide.
    suffixes = rows.groupBy("suffix").agg(
        F.log1p(F.count("*").cast("double")).alias("suffix_count"),
        ((F.coalesce(F.sum(blocked), F.lit(0.0)) + 1) / (F.count("by_rule") + 2)).alias("suffix_blocked"),
    )
    rows = VectorAssembler(inputCols=FEATURES, outputCol="features").transform(rows.join(materialise(suffixes, "suffixes"), "suffix", "left"))
    known = rows.where(F.col("by_rule").isNotNull()).withColumn("label", blocked)
    kinds = {r["by_rule"] for r in known.groupBy("by_rule").count().collect()}
    if len(kinds) < 2:
        scored = rows.withColumn("score", F.lit(0.0))
    else:
        # A bounded table in few files: the trees go over it once a level.
        sample = materialise(bounded_sample(known.select("id", "features", "label"), "id", TRAIN_ROWS).repartition(TRAIN_PARTS), "url-train")
        trees = GBTClassifier(maxIter=TREES, maxDepth=DEPTH, seed=SEED, stepSize=0.2).fit(sample)
        scored = trees.transform(rows).withColumn("score", vector_to_array("probability")[1])
    method = F.when(F.col("score") >= 0.5, "block").otherwise("allow")
    return scored.select(F.col("id").alias(key), "host", "path", "rule", F.coalesce("by_rule", method).alias("verdict"), "score")

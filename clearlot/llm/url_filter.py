"""URL verdicts from listed rules and from mined token combinations.

A listed rule names a host and the start of a path. It fits its host and all subdomains; of the rules that fit, the
longest decides. For all other URLs, frequent combinations of URL tokens are mined from labelled URLs with FP-growth.
Combinations that lead to a label with enough support and confidence are the mined rules. They are matched by an inverted
index: every token names the rules that hold it, and a rule fits a URL that reaches all of its tokens. The fitting rule of
highest confidence decides, then support, then size, then the token list; where none fits, the default does.

Null URLs, and URLs without ``://``, have empty host and path and get the default unless a rule is mined for them. Ids and
URLs may repeat. Without labelled URLs no rule is mined.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.ml.fpm import FPGrowth
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

ALLOW, BLOCK = "allow", "block"
#: With these bounds at most 1 / MIN_SUPPORT times the tokens of a URL are frequent, whatever the number of URLs.
MIN_SUPPORT = 0.005
MIN_CONFIDENCE = 0.75
#: Mined rules up to this number are broadcast; more are shuffled.
BROADCAST_RULES = 100_000
_LABEL = "label="


@dataclass(frozen=True)
class Rule:
    verdict: str
    host: str
    path: str

    @property
    def name(self) -> str:
        return self.host + self.path


def host_of(url: Column) -> Column:
    """After the first ``://`` up to ``/``, ``?``, ``#`` or the end, with A-Z in lower case."""
    found = F.regexp_extract(url, r"(?s)^.*?://([^/?#]*)", 1)
    return F.coalesce(
        F.translate(found, "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"), F.lit("")
    )


def path_of(url: Column) -> Column:
    """After the host up to ``?``, ``#`` or the end."""
    return F.coalesce(F.regexp_extract(url, r"(?s)^.*?://[^/?#]*([^?#]*)", 1), F.lit(""))


def listed_rule(host: Column, path: Column, rules: list[Rule]) -> tuple[Column, Column]:
    """Name and verdict of the longest listed rule that fits, else null; of equal ones the first in the list."""
    name, verdict = F.lit(None).cast("string"), F.lit(None).cast("string")
    for rule in sorted(rules, key=lambda one: len(one.name)):
        fits = ((host == rule.host) | host.endswith("." + rule.host)) & path.startswith(rule.path)
        name = F.when(fits, rule.name).otherwise(name)
        verdict = F.when(fits, rule.verdict).otherwise(verdict)
    return name, verdict


def tokens_of(url: Column) -> Column:
    """The tokens of a URL: scheme, host, its parent domains, path segments and query keys; numbers count as one token."""
    host, path = host_of(url), path_of(url)
    labels = F.split(host, r"\.")
    parents = F.transform(
        F.sequence(F.lit(1), F.size(labels)),
        lambda i: F.concat(F.lit("domain="), F.array_join(F.slice(labels, i, F.size(labels)), ".")),
    )
    segments = F.transform(
        F.filter(F.split(path, "/"), lambda part: part != ""),
        lambda part: F.concat(F.lit("path="), F.regexp_replace(part, r"[0-9]+", "0")),
    )
    query = F.regexp_extract(url, r"(?s)\?([^#]*)", 1)
    keys = F.transform(
        F.filter(F.split(query, "&"), lambda part: part != ""),
        lambda part: F.concat(F.lit("query="), F.element_at(F.split(part, "="), 1)),
    )
    scheme = F.array(F.concat(F.lit("scheme="), F.lower(F.regexp_extract(url, r"(?s)^(.*?)://", 1))))
    named = F.array_sort(F.array_distinct(F.concat(scheme, parents, segments, keys)))
    return F.when(url.isNull() | ~url.contains("://"), F.array().cast("array<string>")).otherwise(named)


def mine_rules(
    labelled: DataFrame, min_support: float = MIN_SUPPORT, min_confidence: float = MIN_CONFIDENCE
) -> DataFrame:
    """Rules ``tokens -> verdict`` with confidence and support from rows of ``tokens`` and ``verdict``."""
    spark = labelled.sparkSession
    items = F.concat("tokens", F.array(F.concat(F.lit(_LABEL), F.col("verdict"))))
    baskets = labelled.where(F.col("verdict").isNotNull()).select(items.alias("items"))
    empty = spark.createDataFrame([], "tokens array<string>, verdict string, confidence double, support double")
    if baskets.isEmpty():
        return empty
    model = FPGrowth(itemsCol="items", minSupport=min_support, minConfidence=min_confidence).fit(baskets)
    found = model.associationRules
    return found.where(
        F.col("consequent")[0].startswith(_LABEL) & ~F.exists("antecedent", lambda token: token.startswith(_LABEL))
    ).select(
        F.array_sort("antecedent").alias("tokens"),
        F.substring(F.col("consequent")[0], len(_LABEL) + 1, 1_000).alias("verdict"),
        "confidence",
        "support",
    )


def pruned(rules: DataFrame) -> DataFrame:
    """Without rules that hold a single-token rule of the same verdict with at least their confidence.

    Such a rule never decides against the shorter one in another way, as both name the same verdict.
    """
    single = rules.where(F.size("tokens") == 1).select(
        F.col("tokens")[0].alias("token"), F.col("verdict").alias("same"), F.col("confidence").alias("least")
    )
    held = rules.where(F.size("tokens") > 1).withColumn("token", F.explode("tokens"))
    covered = held.join(
        single, (held.token == single.token) & (held.verdict == single.same) & (single.least >= held.confidence)
    ).select(held.tokens, held.verdict).distinct()
    return rules.join(covered, ["tokens", "verdict"], "left_anti")


def match_rules(sets: DataFrame, rules: DataFrame, broadcast_rules: int = BROADCAST_RULES) -> DataFrame:
    """The deciding rule of every token set in ``sets`` (column ``tokens``, distinct rows): ``verdict`` and its rule."""
    numbered = rules.withColumn("rule", F.array_join("tokens", " "))
    postings = numbered.select(
        F.explode("tokens").alias("token"), "rule", "verdict", "confidence", "support", F.size("tokens").alias("needs")
    )
    if rules.limit(broadcast_rules + 1).count() <= broadcast_rules:
        postings = F.broadcast(postings)
    best = F.max(F.struct("confidence", "support", "needs", "rule", "verdict")).alias("best")
    return (
        sets.select("tokens", F.explode("tokens").alias("token"))
        .join(postings, "token")
        .groupBy("tokens", "rule", "verdict", "confidence", "support", "needs")
        .agg(F.count("*").alias("reached"))
        .where(F.col("reached") == F.col("needs"))
        .groupBy("tokens")
        .agg(best)
        .select("tokens", F.col("best.verdict").alias("mined"), F.col("best.rule").alias("mined_rule"))
    )


def judge_urls(
    pages: DataFrame,
    labels: DataFrame,
    rules: list[Rule],
    id_column: str = "page_id",
    url_column: str = "url",
    default: str = ALLOW,
    min_support: float = MIN_SUPPORT,
    min_confidence: float = MIN_CONFIDENCE,
) -> DataFrame:
    """Per page its host, path, listed ``rule`` (or null), ``verdict`` and ``mined_rule`` (where that decided).

    ``labels`` has the columns ``id`` and ``verdict``; rows without an id or a verdict, and ids that are given several
    verdicts, teach nothing.
    """
    known = (
        labels.where(F.col("id").isNotNull() & F.col("verdict").isNotNull())
        .groupBy("id")
        .agg(F.min("verdict").alias("verdict"), F.max("verdict").alias("other"))
        .where(F.col("verdict") == F.col("other"))
        .drop("other")
    )
    url = F.col("url")
    own = pages.select(F.col(id_column).alias("id"), F.col(url_column).alias("url"))
    taught = own.withColumn("tokens", tokens_of(url)).join(known, "id").select("tokens", "verdict")
    mined = pruned(mine_rules(taught, min_support, min_confidence))
    host, path = host_of(url), path_of(url)
    name, verdict = listed_rule(F.col("host"), F.col("path"), rules)
    judged = own.withColumns({"host": host, "path": path, "tokens": tokens_of(url)}).select(
        "id", "host", "path", "tokens", name.alias("rule"), verdict.alias("listed")
    )
    sets = judged.where(F.col("listed").isNull()).select("tokens").distinct()
    found = match_rules(sets, mined)
    return judged.join(found, "tokens", "left").select(
        F.col("id").alias(id_column),
        "host",
        "path",
        "rule",
        F.coalesce("listed", "mined", F.lit(default)).alias("verdict"),
        F.when(F.col("listed").isNull(), F.col("mined_rule")).alias("mined_rule"),
    )

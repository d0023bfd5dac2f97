"""URL filters: given rules by host and path, and association rules mined from the URLs that these label.

A URL is a basket of tokens: parts of its host (``h:``), path (``p:``) and query (``q:``), A-Z lower-cased, runs of
digits as ``0``. FP-growth finds the combinations of tokens and label with enough support among labelled
URLs; those that imply a label with enough confidence are the rules. A rule that a shorter one implies
with the same or a higher confidence is left out: the shorter one has at least its support, so it decides first.

Tokens with the same occurrences are one item for the miner, named by the smallest: a hot URL of many tokens
would otherwise have as many frequent combinations as subsets. URLs are matched through an inverted index:
each is cut to the tokens that rules use, and a rule is filed under its rarest token only. Equal baskets are
matched once.

Built-in DataFrame functions and Spark's own miner only.
"""

from __future__ import annotations

import math
from collections.abc import Sequence
from functools import reduce

from pyspark.ml.fpm import FPGrowth
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..session import written
from .common import free_name, lower_ascii

ALLOW, BLOCK = "allow", "block"
#: Verdict, host and beginning of the path of the given rules.
RULES = (
    (ALLOW, "org", "/"),
    (BLOCK, "example.org", "/es/"),
    (BLOCK, "example.org", "/en/1"),
    (ALLOW, "com", "/fr/"),
    (BLOCK, "com", "/de/"),
)
MIN_SUPPORT, MIN_CONFIDENCE = 0.01, 0.9
#: Given rules are one expression, so their number has a bound.
MOST_RULES = 1000

_APART = r"[\x00-\x2F\x3A-\x60\x7B-\x7F]+"


def _rest(url: Column) -> Column:
    """What follows the first ``://``; empty without one."""
    at = F.instr(url, "://")
    return F.when(at > 0, F.substring(url, at + 3, F.length(url))).otherwise("")


def host_of(url: Column) -> Column:
    return lower_ascii(F.regexp_extract(_rest(url), "^[^/?#]*", 0))


def path_of(url: Column) -> Column:
    return F.regexp_extract(_rest(url), "^[^/?#]*([^?#]*)", 1)


def tokens_of(url: Column) -> Column:
    """The URL's basket: distinct tokens in code-point order."""

    def tokens(text: Column, mark: str) -> Column:
        parts = F.split(F.regexp_replace(lower_ascii(text), "[0-9]+", "0"), _APART)
        return F.transform(F.filter(parts, lambda x: x != ""), lambda x: F.concat(F.lit(mark), x))

    after = F.regexp_extract(_rest(url), "(?s)^[^?#]*(.*)$", 1)
    return F.array_sort(F.array_distinct(F.concat(tokens(host_of(url), "h:"), tokens(path_of(url), "p:"), tokens(after, "q:"))))


def given(host: Column, path: Column, rules: Sequence[tuple[str, str, str]]) -> tuple[Column, Column]:
    """The longest rule that fits (of equally long ones, that of the longer host), and its verdict; else nulls."""
    if len(rules) > MOST_RULES:
        raise ValueError(f"more than {MOST_RULES} rules")
    if not rules:
        return F.lit(None).cast("string"), F.lit(None).cast("string")
    ordered = sorted(rules, key=lambda r: (-len(r[1] + r[2]), -len(r[1]), r[1:]))
    fits = [((host == h) | host.endswith(f".{h}")) & path.startswith(p) for _, h, p in ordered]
    name = reduce(lambda c, r: c.when(r[0], f"{r[1][1]}{r[1][2]}"), zip(fits, ordered, strict=True), F)
    verdict = reduce(lambda c, r: c.when(r[0], r[1][0]), zip(fits, ordered, strict=True), F)
    return name, verdict


def _key(tokens: Column) -> Column:
    return F.unhex(F.md5(F.array_join(tokens, "\n")))


def mine(labelled: DataFrame, min_support: float = MIN_SUPPORT, min_confidence: float = MIN_CONFIDENCE) -> DataFrame:
    """``(antecedent, label, confidence, n)`` from ``(tokens, label)``; ``n`` URLs hold the tokens and the label.

    Every row counts, equal ones too. ``min_support`` is a share of all rows. No rows, no rules.
    """
    spark = labelled.sparkSession
    rows = written(labelled.select(_key(F.col("tokens")).alias("key"), "tokens", "label"), "labelled")
    total = rows.count()
    if not total:
        return spark.createDataFrame([], "antecedent array<string>, label string, confidence double, n bigint")
    baskets = written(rows.groupBy("key").agg(F.any_value("tokens").alias("tokens"), F.count(F.lit(1)).alias("n")), "baskets")
    places = baskets.select("key", "n", F.explode("tokens").alias("token"))
    stats = places.groupBy("token").agg(F.sum("n").alias("n"), F.sum(F.xxhash64("key").cast("decimal(38,0)")).alias("where"))
    frequent = stats.where(F.col("n") >= math.ceil(min_support * total))
    items = written(frequent.groupBy("n", "where").agg(F.min("token").alias("token")).select("token"), "items")
    cut = places.join(items, "token").groupBy("key").agg(F.collect_list("token").alias("items"))
    mark = F.concat(F.lit("="), F.col("label"))
    transactions = rows.select("key", "label").join(cut, "key", "left").select(
        F.concat(F.coalesce("items", F.array().cast("array<string>")), F.array(mark)).alias("items")
    )
    model = FPGrowth(itemsCol="items", minSupport=min_support, minConfidence=min_confidence).fit(written(transactions, "transactions"))
    label = F.col("consequent")[0]
    # the miner gives the support as a share; times all rows it is the count again
    found = model.associationRules.where(label.startswith("=")).select(
        F.array_sort("antecedent").alias("antecedent"),
        F.substring(label, 2, 1 << 30).alias("label"),
        "confidence",
        F.round(F.col("support") * total).cast("bigint").alias("n"),
    )
    rules = written(found.where(~F.exists("antecedent", lambda t: t.startswith("="))), "rules")
    without = F.explode(F.transform("antecedent", lambda t: F.array_remove("antecedent", t)))
    shorter = rules.select("label", "antecedent", "confidence", without.alias("part")).join(
        rules.select("label", F.col("antecedent").alias("part"), F.col("confidence").alias("already")), ["label", "part"]
    )
    implied = shorter.where("already >= confidence").select("label", "antecedent").distinct()
    return rules.join(implied, ["label", "antecedent"], "left_anti").select("antecedent", "label", "confidence", "n")


def match(baskets: DataFrame, rules: DataFrame) -> DataFrame:
    """``(key, label, pattern, confidence)`` of each distinct ``(key, tokens)`` that a mined rule fits.

    The rule with the highest confidence decides, then that with the most support, the fewest tokens, one that
    blocks, the smaller label, the smaller tokens.
    """
    rules = written(rules, "rules")
    places = rules.select(F.explode("antecedent").alias("token")).distinct()
    found = baskets.select("key", F.explode("tokens").alias("token"))
    cut = found.join(places, "token").groupBy("key").agg(F.sort_array(F.collect_list("token")).alias("tokens"))
    cut = written(cut.withColumn("cut", _key(F.col("tokens"))), "cut")
    kinds = cut.groupBy("cut").agg(F.any_value("tokens").alias("tokens"))
    often = kinds.select(F.explode("tokens").alias("token")).groupBy("token").agg(F.count(F.lit(1)).alias("often"))
    by_token = rules.select("*", F.explode("antecedent").alias("token")).join(often, "token")
    index = by_token.groupBy("antecedent", "label").agg(
        F.min(F.struct("often", "token"))["token"].alias("token"),
        F.any_value("confidence").alias("confidence"),
        F.any_value("n").alias("n"),
    )
    hits = (
        kinds.select("cut", "tokens", F.explode("tokens").alias("token"))
        .join(index, "token")
        .where(F.size(F.array_except("antecedent", "tokens")) == 0)
    )
    rank = F.struct((-F.col("confidence")).alias("c"), (-F.col("n")).alias("n"), F.size("antecedent").alias("size"))
    best = hits.groupBy("cut", rank.alias("rank"), "label").agg(F.min("antecedent").alias("antecedent"))
    first = best.groupBy("cut").agg(
        F.min(F.struct("rank", F.when(F.col("label") == BLOCK, 0).otherwise(1).alias("later"), "label", "antecedent")).alias("r")
    )
    named = first.select(
        "cut",
        F.col("r.label").alias("label"),
        F.array_join("r.antecedent", " ").alias("pattern"),
        (-F.col("r.rank.c")).alias("confidence"),
    )
    return cut.select("key", "cut").join(named, "cut").drop("cut")


def judge(
    pages: DataFrame,
    url_col: str = "url",
    rules: Sequence[tuple[str, str, str]] = RULES,
    min_support: float = MIN_SUPPORT,
    min_confidence: float = MIN_CONFIDENCE,
    default: str = ALLOW,
) -> DataFrame:
    """``pages`` with ``host``, ``path``, ``rule``, ``verdict``, ``pattern`` and ``confidence``, in place of columns of those names.

    Where a given rule fits, it decides, and its verdict is a label to learn from. The mined rules decide on
    the rest; where none fits, ``default`` does. ``pattern`` has the tokens of the mined rule that decided.
    A null URL or one without ``://`` has an empty host and path and no tokens. Repeated rows stay and
    count as labels again; an empty table gives no rows; a URL's length has no bound.
    """
    url = F.col(url_col).cast("string")
    added = ("host", "path", "rule", "verdict", "pattern", "confidence")
    others = [c for c in pages.columns if c.lower() not in added]
    spare = {n: free_name(pages, f"_{n}") for n in ("key", "tokens", "label", *added)}
    rows = pages.withColumns(
        {spare["host"]: F.coalesce(host_of(url), F.lit("")), spare["path"]: F.coalesce(path_of(url), F.lit(""))}
    )
    rule, verdict = given(F.col(spare["host"]), F.col(spare["path"]), rules)
    rows = rows.withColumns({spare["rule"]: rule, spare["verdict"]: verdict})
    rows = rows.withColumn(spare["tokens"], F.coalesce(tokens_of(url), F.array().cast("array<string>")))
    rows = rows.withColumn(spare["key"], _key(F.col(spare["tokens"])))
    slim = written(
        rows.select(F.col(spare["key"]).alias("key"), F.col(spare["tokens"]).alias("tokens"), F.col(spare["verdict"]).alias("label")),
        "urls",
    )
    found = mine(slim.where("label IS NOT NULL").select("tokens", "label"), min_support, min_confidence)
    rest = slim.where("label IS NULL").groupBy("key").agg(F.any_value("tokens").alias("tokens"))
    key, open_ = spare["key"], F.col(spare["verdict"]).isNull()
    hits = written(match(rest, found), "matches").select(
        F.col("key").alias(key),
        F.col("label").alias(spare["label"]),
        F.col("pattern").alias(spare["pattern"]),
        F.col("confidence").alias(spare["confidence"]),
    )
    return rows.join(hits, key, "left").select(
        *[F.col(f"`{c}`") for c in others],
        F.col(spare["host"]).alias("host"),
        F.col(spare["path"]).alias("path"),
        F.col(spare["rule"]).alias("rule"),
        F.coalesce(spare["verdict"], spare["label"], F.lit(default)).alias("verdict"),
        F.when(open_, F.col(spare["pattern"])).alias("pattern"),
        F.when(open_, F.col(spare["confidence"])).alias("confidence"),
    )

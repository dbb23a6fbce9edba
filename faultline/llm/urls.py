"""URL filters: listed rules, and association rules mined from labelled URLs.

Tokens that lie in exactly the same labelled URLs, such as the parts of one deep path, are one class to
the miner. FP-growth finds the combinations of classes that go with the label `block`; rules of enough
support and confidence are kept, without those that a shorter rule makes redundant. A URL fits a rule if
it has a token of each of its classes. Rules match through an inverted index: each stands under its rarest
class, and a URL looks up the classes of its tokens.
"""

from __future__ import annotations

import math
from collections.abc import Sequence

from pyspark.ml.fpm import FPGrowth
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from faultline.llm.common import ascii_lower, staged
from faultline.session import attach

BLOCK, ALLOW = "block", "allow"
TARGET = "label:block"

SUPPORT = 0.0005
CONFIDENCE = 0.6
# A rule rests on this many labelled rows at least.
LEAST_ROWS = 20

ListedRule = tuple[str, str, str]

# Host, path and verdict of the listed rules.
LISTED: list[ListedRule] = [
    ("net", "/", BLOCK),
    ("example.net", "/en/", ALLOW),
    ("example.com", "/de/", BLOCK),
    ("org", "/fr/", ALLOW),
]


def host_and_path(url: Column) -> tuple[Column, Column]:
    """Both empty for a null url or one without `://`."""
    at = F.coalesce(F.position(F.lit("://"), url), F.lit(0))
    rest = F.when(at > 0, F.substr(url, at + 3)).otherwise(F.lit(""))
    host = ascii_lower(F.regexp_extract(rest, r"^([^/?#]*)", 1))
    return host, F.regexp_extract(rest, r"^[^/?#]*([^?#]*)", 1)


def listed(host: Column, path: Column, rules: Sequence[ListedRule] = LISTED) -> Column:
    """The longest listed rule that fits, as a struct of rule and verdict, or null. The list is a
    parameter, and the plan holds it whole."""
    fitting = [
        F.when(
            ((host == h) | F.endswith(host, F.lit(f".{h}"))) & F.startswith(path, F.lit(p)),
            F.struct(
                F.lit(len(h) + len(p)).alias("length"),
                F.lit(h + p).alias("rule"),
                F.lit(verdict).alias("verdict"),
            ),
        )
        for h, p, verdict in rules
    ]
    return F.array_max(F.array_compact(F.array(*fitting)))


def tokens(url: Column) -> Column:
    """Scheme, labels of the host, parts of the path (digits as #), ending, and names of the query."""
    host, path = host_and_path(url)
    parts = F.filter(F.split(path, "/"), lambda p: p != "")
    query = F.split(F.regexp_extract(url, r"\?([^#]*)", 1), "&")
    none = F.array().cast("array<string>")

    def marked(kind: str, items: Column) -> Column:
        return F.transform(F.filter(items, lambda x: x != ""), lambda x: F.concat(F.lit(kind), x))

    found = F.concat(
        marked("scheme:", F.array(F.regexp_extract(url, r"^([A-Za-z]+)://", 1))),
        marked("host:", F.split(host, r"\.")),
        marked("path:", F.transform(parts, lambda p: F.regexp_replace(p, r"[0-9]+", "#"))),
        marked("query:", F.transform(query, lambda q: F.substring_index(q, "=", 1))),
    )
    return F.when(host != "", F.array_distinct(found)).otherwise(none)


def mine(
    labelled: DataFrame, support: float = SUPPORT, confidence: float = CONFIDENCE
) -> DataFrame:
    """Rules from rows of `url, block` (boolean): `tokens, alike, confidence, support`.

    `tokens` names the classes of a rule, `alike` lists the tokens of each. A rule has at least the given share of all labelled rows (`LEAST_ROWS` of them at least), and of
    the rows it fits. A rule that contains another of no less confidence is left out. Rows without
    a label are ignored.
    """
    rows = labelled.filter(F.col("block").isNotNull()).select(
        tokens(F.col("url")).alias("tokens"), "block", F.monotonically_increasing_id().alias("row")
    )
    rows = staged(rows.filter((F.size("tokens") > 0) | F.col("block")), "labelled-urls")
    schema = "tokens array<string>, alike array<array<string>>, confidence double, support double"
    total = rows.count()
    if total < LEAST_ROWS:
        return rows.sparkSession.createDataFrame([], schema)
    least = max(support, LEAST_ROWS / total)
    classes = staged(_classes(rows, math.ceil(least * total)), "token-classes")
    # A class stands for its tokens in every row that has one of them, and so has all.
    placed = attach(
        rows.select("row", F.explode("tokens").alias("token")), classes.select("token", "class"), "token"
    )
    items = placed.filter(F.col("class").isNotNull()).groupBy("row")
    sets = rows.select("row", "block").join(
        items.agg(F.collect_set("class").alias("classes")), "row", "left"
    )
    target = F.when(F.col("block"), F.array(F.lit(TARGET))).otherwise(F.array().cast("array<string>"))
    found = F.concat(F.coalesce("classes", F.array().cast("array<string>")), target)
    # Rows without an item count in the total: the share is of all rows.
    baskets = staged(sets.select(found.alias("items")), "baskets")
    model = FPGrowth(itemsCol="items", minSupport=least, minConfidence=confidence).fit(baskets)
    rules = staged(
        model.associationRules.filter(F.element_at("consequent", 1) == TARGET).select(
            F.array_sort("antecedent").alias("tokens"), "confidence", "support"
        ),
        "url-rules",
    )
    # A shorter rule that is part of a longer one stands under its first token, which both have.
    shorter = rules.select(
        F.col("tokens").alias("fewer"),
        F.col("confidence").alias("as_sure"),
        F.get("tokens", F.lit(0)).alias("entry"),
    )
    longer = rules.withColumn("entry", F.explode("tokens"))
    redundant = (
        longer.join(shorter, "entry")
        .filter(F.size("fewer") < F.size("tokens"))
        .filter(F.size(F.array_except("fewer", "tokens")) == 0)
        .filter(F.col("as_sure") >= F.col("confidence"))
        .select("tokens")
    )
    members = classes.groupBy("class").agg(F.array_sort(F.collect_list("token")).alias("members"))
    kept = rules.join(redundant, "tokens", "left_anti")
    named = kept.select("*", F.posexplode("tokens").alias("place", "class")).join(members, "class")
    alike = F.array_sort(F.collect_list(F.struct("place", "members")))["members"].alias("alike")
    return named.groupBy("tokens", "confidence", "support").agg(alike).select(
        "tokens", "alike", "confidence", "support"
    )


def _classes(rows: DataFrame, least: int) -> DataFrame:
    """`token, class` of the tokens in at least `least` rows: tokens of the same rows have the same class,
    named by the first of them. Two hashes of the set of rows tell whether it is the same."""
    each = rows.select("row", F.explode("tokens").alias("token"))
    sums = (
        each.groupBy("token")
        .agg(
            F.count(F.lit(1)).alias("n"),
            F.sum(F.xxhash64("row").cast("decimal(38,0)")).alias("sum"),
            F.bit_xor(F.xxhash64(F.lit(1), "row")).alias("xor"),
        )
        .filter(F.col("n") >= least)
    )
    same = ["n", "sum", "xor"]
    return sums.join(sums.groupBy(*same).agg(F.min("token").alias("class")), same)


def match(pages: DataFrame, rules: DataFrame) -> DataFrame:
    """The surest mined rule that fits each row of `page, tokens`: `page, matched`."""
    class_of = rules.select(F.explode(F.arrays_zip("tokens", "alike")).alias("_")).select(
        F.col("_.tokens").alias("class"), F.explode("_.alike").alias("token")
    )
    # The tokens of a page as far as rules know them, each by its class.
    pages = (
        pages.select("page", F.explode("tokens").alias("token"))
        .join(class_of.distinct(), "token")
        .groupBy("page")
        .agg(F.collect_set("class").alias("tokens"))
    )
    used = rules.select(F.explode("tokens").alias("token")).distinct()
    frequent = (
        pages.select(F.explode("tokens").alias("token"))
        .join(used, "token", "left_semi")
        .groupBy("token")
        .agg(F.count(F.lit(1)).alias("n"))
    )
    index = (
        rules.select(F.col("tokens").alias("rule"), "confidence", F.explode("tokens").alias("token"))
        .join(frequent, "token")
        .groupBy("rule", "confidence")
        .agg(F.min(F.struct("n", "token"))["token"].alias("token"))
    )
    return (
        pages.select("page", "tokens", F.explode("tokens").alias("token"))
        .join(index, "token")
        .filter(F.size(F.array_except("rule", "tokens")) == 0)
        .groupBy("page")
        .agg(F.max(F.struct("confidence", "rule")).alias("matched"))
    )


def judge(
    pages: DataFrame,
    labelled: DataFrame,
    rules: Sequence[ListedRule] = LISTED,
    support: float = SUPPORT,
    confidence: float = CONFIDENCE,
) -> DataFrame:
    """The verdict on every url.

    Returns `page_id, host, path, rule, verdict, confidence`, one row per input row. Where no listed
    rule fits, a mined rule that fits means `block`, and `confidence` is that of the surest; else the
    url is allowed. Urls that are null or without `://` are allowed. Repeated rows get the same
    verdict, with or without a `page_id`. Other columns are ignored.
    """
    host, path = host_and_path(F.col("url"))
    rows = pages.select("page_id", "url", host.alias("host"), path.alias("path")).withColumn(
        "_listed", listed(F.col("host"), F.col("path"), rules)
    )
    # Equal urls are judged once.
    open_urls = (
        rows.filter(F.col("_listed").isNull() & (F.col("host") != ""))
        .select(F.col("url").alias("page"))
        .distinct()
        .withColumn("tokens", tokens(F.col("page")))
    )
    found = match(open_urls, mine(labelled, support, confidence))
    judged = rows.join(
        found.select(F.col("page").alias("url"), F.col("matched.confidence").alias("confidence")),
        "url",
        "left",
    )
    mined = F.col("_listed").isNull() & F.col("confidence").isNotNull()
    return judged.select(
        "page_id",
        "host",
        "path",
        F.col("_listed.rule").alias("rule"),
        F.when(mined, BLOCK).otherwise(F.coalesce("_listed.verdict", F.lit(ALLOW))).alias("verdict"),
        F.when(mined, F.col("confidence")).alias("confidence"),
    )

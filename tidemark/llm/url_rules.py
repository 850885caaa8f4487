"""URL filter: a rule list, and association rules mined from what it decides.

A listed rule is a host and a beginning of the path; it fits its host, all
subdomains, and paths that begin so; the longest fitting rule wins. Every url
becomes a set of tokens (parts of host and path, extension, query keys), digits made alike.

Rules are mined from the listed urls, whose verdicts are the labels: token combinations
that lead to a block, with the support and the confidence asked for. Tokens that hold in
the very same labelled urls are one item, or else every subset of a shared path would be a
combination; rarer tokens than the support can't be in a rule and are left out. FP-growth counts the
combinations of items; those of which a part has as much confidence are dropped. Each kept rule is indexed
under its rarest item; a url no listed rule decides meets only the rules under its own
items, and is blocked when it holds one token or more of each item of a rule. That gives
the verdicts that all combinations of single tokens would give.

Defined cases: a null url, or one without ://, has an empty host and path, fits no
listed rule and is allowed unless a mined rule of its tokens blocks it; repeated
rows count, and get their verdict, each; without listed urls nothing is mined; an empty table gives an empty result.
"""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.ml.fpm import FPGrowth
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidemark.llm.rows import column
from tidemark.session import materialize

RULES = (
    ("allow", "com", "/"),
    ("block", "example.com", "/en/"),
    ("allow", "www.example.com", "/en/"),
    ("block", "net", "/es/"),
    ("block", "net", "/fr/"),
)
BLOCKED = "verdict:block"


@dataclass(frozen=True)
class Mining:
    """The least share of the labelled urls that hold a rule and are blocked, and the least share of those that hold it.

    A single url makes no rule, however few there are.
    """

    support: float = 0.005
    confidence: float = 0.8
    urls: int = 2

    def least(self, labelled: int) -> float:
        """The support as a share of so many labelled urls."""
        return min(1.0, max(self.support, self.urls / max(1, labelled)) * (1 - 1e-12))  # as products round


def _lower(text: Column) -> Column:
    return F.translate(text, "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def parts(pages: DataFrame, rules: Sequence[tuple[str, str, str]], id_col: str, url_col: str) -> DataFrame:
    """page_id, url, host, path, and the longest fitting rule and its verdict."""
    url = F.coalesce(column(pages, url_col).cast("string"), F.lit(""))
    pattern = r"://([^/?#]*)([^?#]*)"
    rows = pages.select(
        column(pages, id_col).cast("bigint").alias("page_id"),
        url.alias("url"),
        _lower(F.regexp_extract(url, pattern, 1)).alias("host"),
        F.regexp_extract(url, pattern, 2).alias("path"),
    )
    rule, verdict = F.lit(None).cast("string"), F.lit(None).cast("string")
    for kind, host, path in sorted(rules, key=lambda r: len(r[1] + r[2])):
        fits = ((F.col("host") == host) | F.col("host").endswith("." + host)) & F.col("path").startswith(path)
        rule = F.when(fits, F.lit(host + path)).otherwise(rule)
        verdict = F.when(fits, F.lit(kind)).otherwise(verdict)
    return rows.withColumn("rule", rule).withColumn("listed", verdict)


def tokens() -> Column:
    """The tokens of url, host and path."""

    def marked(kind: str, items: Column) -> Column:
        return F.transform(F.filter(items, lambda x: x != ""), lambda x: F.concat(F.lit(kind), F.regexp_replace(x, "[0-9]+", "0")))

    query = F.split(F.regexp_extract("url", r"\?([^#]*)", 1), "&")
    return F.array_distinct(
        F.concat(
            marked("host:", F.split("host", r"\.")),
            marked("path:", F.split("path", "/")),
            marked("extension:", F.array(F.regexp_extract("path", r"\.([A-Za-z0-9]+)$", 1))),
            marked("query:", F.transform(query, lambda x: F.split(x, "=")[0])),
        )
    )


def items(labelled: DataFrame, mining: Mining = Mining()) -> DataFrame:
    """(token, item) of the tokens frequent enough for a rule; tokens of the very same rows share an item.

    From (row, tokens). There are at most (tokens of a url, on average) / support of them.
    """
    n = labelled.count()
    least = max(mining.least(n) * n, mining.urls)
    each = labelled.select("row", F.explode("tokens").alias("token"))
    mark = [F.bit_xor(F.xxhash64(F.lit(k), "row")).alias(f"mark{k}") for k in (1, 2)]
    seen = each.groupBy("token").agg(F.count("*").alias("n"), *mark).where(F.col("n") >= least)
    seen = materialize(seen, "tokens")
    names = seen.groupBy("n", "mark1", "mark2").agg(F.min("token").alias("item"))
    return materialize(seen.join(names, ["n", "mark1", "mark2"]).select("token", "item"), "items")


def held(rows: DataFrame, known: DataFrame) -> DataFrame:
    """(row, items) of (row, tokens), for rows that hold an item."""
    each = rows.select("row", F.explode("tokens").alias("token")).join(known, "token")
    return each.groupBy("row").agg(F.collect_set("item").alias("items"))


def mine(labelled: DataFrame, known: DataFrame, mining: Mining = Mining()) -> DataFrame:
    """(antecedent, confidence, support, anchor) of the rules that lead to a block, from (row, tokens, blocked)."""
    marked = labelled.join(held(labelled, known), "row", "left").withColumn("items", F.coalesce("items", F.array().cast("array<string>")))
    marked = marked.select(
        F.when(F.col("blocked"), F.concat("items", F.array(F.lit(BLOCKED)))).otherwise(F.col("items")).alias("items")
    )
    schema = "antecedent array<string>, confidence double, support double, anchor string"
    n = marked.count()
    if n < mining.urls:
        return marked.sparkSession.createDataFrame([], schema)
    model = FPGrowth(itemsCol="items", minSupport=mining.least(n), minConfidence=mining.confidence).fit(marked)
    found = model.associationRules.where(F.col("consequent")[0] == BLOCKED)
    found = materialize(found.select(F.array_sort("antecedent").alias("antecedent"), "confidence", "support"), "rules")
    shorter = found.select(F.col("antecedent").alias("part"), F.col("confidence").alias("sure"))
    # each rule against the rules over all but one of its items; a still shorter one prunes those first
    dropped = found.select(
        "antecedent", "confidence", F.explode(F.transform("antecedent", lambda x: F.array_remove("antecedent", x))).alias("part")
    )
    beaten = dropped.join(shorter, "part").where("sure >= confidence").select("antecedent").distinct()
    alone = model.freqItemsets.where(F.size("items") == 1).select(F.col("items")[0].alias("item"), "freq")
    rare = (
        found.join(beaten, "antecedent", "left_anti")
        .withColumn("item", F.explode("antecedent"))
        .join(alone, "item")
        .groupBy("antecedent", "confidence", "support")
        .agg(F.min(F.struct("freq", "item")).alias("rarest"))
    )
    return materialize(rare.select("antecedent", "confidence", "support", F.col("rarest.item").alias("anchor")), "kept")


def judge(
    pages: DataFrame,
    rules: Sequence[tuple[str, str, str]] = RULES,
    mining: Mining = Mining(),
    id_col: str = "page_id",
    url_col: str = "url",
) -> DataFrame:
    """One row per page: host, path, rule, verdict, and the confidence of the mined rule that blocks it."""
    rows = parts(pages, rules, id_col, url_col).withColumn("tokens", tokens())
    rows = materialize(rows.withColumn("row", F.monotonically_increasing_id()), "urls")
    labelled = rows.where("listed is not null").select("row", "tokens", (F.col("listed") == "block").alias("blocked"))
    known = items(labelled, mining)
    mined = mine(labelled, known, mining)
    open_ = held(rows.where("listed is null").select("row", "tokens"), known).withColumn("anchor", F.explode("items"))
    hits = open_.join(mined, "anchor").where(F.size(F.array_except("antecedent", "items")) == 0)
    hits = hits.groupBy("row").agg(F.max("confidence").alias("confidence"))
    verdict = F.coalesce("listed", F.when(F.col("confidence").isNotNull(), "block").otherwise("allow"))
    return rows.join(hits, "row", "left").select("page_id", "host", "path", "rule", verdict.alias("verdict"), "confidence")

"""URL verdicts: a fixed rule list first, then association rules mined from labelled URLs.

A URL becomes a set of tokens.  FP-growth finds the token sets that labelled pages share with the
label `block`; rules of too little support, confidence or lift go, and so does a rule that says no more
than one with fewer tokens.  A rule is filed under its rarest token; a page meets only the rules
filed under one of its tokens and keeps those whose tokens it has all.
"""

from __future__ import annotations

import math

from pyspark.ml.fpm import FPGrowth
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from txnlake.llm.common import RID, numbered, stored

# (host, path, verdict); fixed values of the contract.
RULES = [
    ("net", "/", "block"),
    ("example.net", "/en/", "allow"),
    ("example.com", "/de/", "block"),
    ("org", "/fr/", "allow"),
]
LABEL = "label=block"
MIN_SUPPORT = 0.001  # of the labelled pages
MIN_COUNT = 20  # labelled pages that a rule has to be seen on, however few there are
MIN_CONFIDENCE = 0.6
MIN_LIFT = 1.5  # of the share of blocked pages, or by which the share of the others has to fall
RULE_COLUMNS = ["rule_id", "tokens", "confidence", "support", "lift"]
RULE_SCHEMA = "rule_id long, tokens array<string>, confidence double, support double, lift double"
ALL_A_TO_Z = ("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def ascii_lower(text: Column) -> Column:
    return F.translate(text, *ALL_A_TO_Z)


def _after_scheme(url: Column) -> Column:
    """What follows the first `://`; empty without one, and for null."""
    at = F.instr(url, "://")
    return F.when(at > 0, F.substring(url, at + 3, F.length(url))).otherwise(F.lit(""))


def host_of(url: Column) -> Column:
    return ascii_lower(F.regexp_extract(_after_scheme(url), r"(?s)^([^/?#]*)", 1))


def path_of(url: Column) -> Column:
    return F.regexp_extract(_after_scheme(url), r"(?s)^[^/?#]*([^?#]*)", 1)


def fixed_rule(host: Column, path: Column, rules=RULES) -> tuple[Column, Column]:
    """Name and verdict of the longest rule that fits, null where none does."""
    name, verdict = F.lit(None).cast("string"), F.lit(None).cast("string")
    for rule_host, rule_path, rule_verdict in sorted(rules, key=lambda r: len(r[0] + r[1])):
        fits = ((host == rule_host) | host.endswith(f".{rule_host}")) & path.startswith(rule_path)
        name = F.when(fits, F.lit(rule_host + rule_path)).otherwise(name)
        verdict = F.when(fits, F.lit(rule_verdict)).otherwise(verdict)
    return name, verdict


def document_of(url: Column) -> Column:
    """The number that ends the path, before a file type or `/`: that of the document; else null."""
    number = F.regexp_extract(path_of(url), r"/([0-9]+)(?:\.[^/.]*)?/?$", 1)
    return number.try_cast("long")


def tokens_of(url: Column) -> Column:
    """The set of tokens: host labels, path words without plain numbers, query keys, file type."""
    rest = _after_scheme(url)
    query = F.regexp_extract(rest, r"(?s)\?([^#]*)", 1)
    words = F.filter(
        F.split(ascii_lower(path_of(url)), "[/._-]+"),
        lambda w: (w != "") & ~w.rlike("^[0-9]+$"),
    )
    keys = F.transform(F.split(ascii_lower(query), "&"), lambda w: F.split(w, "=")[0])
    labels = F.filter(F.split(host_of(url), r"\."), lambda w: w != "")
    parts = F.concat(
        F.transform(labels, lambda w: F.concat(F.lit("host:"), w)),
        F.transform(words, lambda w: F.concat(F.lit("path:"), w)),
        F.transform(F.filter(keys, lambda w: w != ""), lambda w: F.concat(F.lit("query:"), w)),
    )
    return F.array_distinct(parts)


def mine(
    labelled: DataFrame,
    min_support: float = MIN_SUPPORT,
    min_confidence: float = MIN_CONFIDENCE,
    min_lift: float = MIN_LIFT,
    min_count: int = MIN_COUNT,
) -> DataFrame:
    """Rules from rows (tokens, blocked): rule_id, tokens, confidence, support, lift.

    Where most rows are blocked no rule can reach the lift; there it is enough when the share of rows
    that are not blocked is `min_lift` times smaller than in the whole.  Rows without a label or
    without tokens teach nothing; no labelled rows give no rules.

    FP-growth finds all sets of tokens, 2^k of k tokens that come together.  Three kinds of tokens
    are thus taken out of the baskets before, which changes no rule: tokens on too few blocked pages;
    tokens that are on blocked pages only, as a rule of more tokens says no more than the token
    alone; and all but one of the tokens that are on the same pages, whose rules are spelt out for
    the others afterwards.
    """
    known = labelled.filter(F.col("blocked").isNotNull() & (F.size("tokens") > 0)).select(
        F.array_sort(F.array_distinct("tokens")).alias("tokens"), "blocked"
    )
    known = stored(known, "url-baskets")
    n, n_blocked = known.agg(F.count(F.lit(1)), F.count_if("blocked")).first()
    if n < min_count or not n_blocked:
        return known.sparkSession.createDataFrame([], RULE_SCHEMA)
    share = max(min_support, min_count / n)
    base = n_blocked / n
    lift = F.col("confidence") / base
    fewer = (lift > 1) & ((1 - F.col("confidence")) * min_lift <= 1 - base)
    tells = (F.col("confidence") >= min_confidence) & ((lift >= min_lift) | fewer)
    tokens = stored(_token_counts(known, math.ceil(share * n)), "url-tokens")
    sure = tokens.filter("blocked = n").select(
        F.array("token").alias("tokens"),
        F.lit(1.0).alias("confidence"),
        (F.col("blocked") / n).alias("support"),
    )
    groups = stored(_groups(tokens.filter("blocked < n")), "url-groups")
    model = FPGrowth(itemsCol="items", minSupport=share, minConfidence=min_confidence).fit(
        stored(_baskets(known, groups), "url-items")
    )
    found = model.associationRules.filter(
        (F.size("consequent") == 1) & (F.col("consequent")[0] == LABEL) & tells
    ).select(F.array_sort("antecedent").alias("tokens"), "confidence", "support")
    found = _without_redundant(stored(_with_id(found), "url-rules"))
    rules = _spelt_out(found, groups).unionByName(sure.filter(tells))
    return _with_id(rules.withColumn("lift", lift)).select(*RULE_COLUMNS)


def _with_id(rules: DataFrame) -> DataFrame:
    return rules.withColumn("rule_id", F.xxhash64("tokens"))


def _token_counts(known: DataFrame, least: int) -> DataFrame:
    """Tokens on at least so many blocked pages: token, n, blocked, same.

    No other token is in a rule.  `same` is equal for tokens that are on the same pages.
    """
    sets = known.groupBy("tokens").agg(
        F.count(F.lit(1)).alias("n"), F.count_if("blocked").alias("blocked")
    )
    hashed = sets.select(
        F.explode("tokens").alias("token"),
        "n",
        "blocked",
        F.xxhash64("tokens").alias("h1"),
        F.xxhash64(F.lit(1), "tokens").alias("h2"),
    )
    return (
        hashed.groupBy("token")
        .agg(
            F.sum("n").alias("n"),
            F.sum("blocked").alias("blocked"),
            F.struct(F.bit_xor("h1"), F.bit_xor("h2"), F.sum("n"), F.sum("blocked")).alias("same"),
        )
        .filter(F.col("blocked") >= least)
    )


def _groups(tokens: DataFrame) -> DataFrame:
    """Tokens that are on the same pages as one: item (the first of them), members."""
    return tokens.groupBy("same").agg(
        F.min("token").alias("item"), F.array_sort(F.collect_list("token")).alias("members")
    ).select("item", "members")


def _baskets(known: DataFrame, groups: DataFrame) -> DataFrame:
    """A row (items) for each labelled page: its tokens that are the first of a group, and the label."""
    rows = known.withColumn("row", F.monotonically_increasing_id())
    rows = stored(rows, "url-rows")
    picked = (
        rows.select("row", F.explode("tokens").alias("item"))
        .join(groups.select("item"), "item")
        .groupBy("row")
        .agg(F.collect_set("item").alias("items"))
    )
    items = F.coalesce("items", F.array().cast("array<string>"))
    return rows.join(picked, "row", "left").select(
        F.when(F.col("blocked"), F.concat(items, F.array(F.lit(LABEL)))).otherwise(items).alias("items")
    )


def _spelt_out(rules: DataFrame, groups: DataFrame) -> DataFrame:
    """Rules of tokens: one token of each group of a rule, in every way."""
    choices = (
        rules.select("rule_id", F.explode("tokens").alias("item"))
        .join(groups, "item")
        .groupBy("rule_id")
        .agg(F.collect_list("members").alias("of"))
    )
    ways = F.aggregate(
        "of",
        F.array(F.array().cast("array<string>")),
        lambda ways, members: F.flatten(
            F.transform(
                ways,
                lambda way: F.transform(members, lambda token: F.concat(way, F.array(token))),
            )
        ),
    )
    spelt = choices.select("rule_id", F.explode(ways).alias("way"))
    return rules.join(spelt, "rule_id").select(
        F.array_sort("way").alias("tokens"), "confidence", "support"
    )


def _filed(rules: DataFrame) -> DataFrame:
    """Rules under one token each: the one that the fewest rules have, so that entries stay short."""
    entries = rules.select("rule_id", F.explode("tokens").alias("token"))
    seen = entries.groupBy("token").agg(F.count(F.lit(1)).alias("seen"))
    choice = (
        entries.join(seen, "token")
        .groupBy("rule_id")
        .agg(F.min(F.struct("seen", "token")).alias("least"))
        .select("rule_id", F.col("least.token").alias("token"))
    )
    return rules.join(choice, "rule_id")


def _without_redundant(rules: DataFrame) -> DataFrame:
    """Without rules to which a rule with fewer tokens gives the same confidence or more."""
    part = _filed(rules).select(
        "token", F.col("tokens").alias("fewer"), F.col("confidence").alias("as_sure")
    )
    whole = rules.select("rule_id", "tokens", "confidence", F.explode("tokens").alias("token"))
    covered = whole.join(part, "token").filter(
        (F.size("fewer") < F.size("tokens"))
        & (F.col("as_sure") >= F.col("confidence"))
        & (F.size(F.array_except("fewer", "tokens")) == 0)
    )
    return rules.join(covered.select("rule_id"), "rule_id", "left_anti")


def match(sets: DataFrame, rules: DataFrame) -> DataFrame:
    """For rows (key, tokens) the surest rule that fits: key, best (struct of the rule)."""
    index = _filed(rules).withColumnRenamed("tokens", "needed")
    probes = sets.select("key", "tokens", F.explode("tokens").alias("token"))
    fits = probes.join(index, "token").filter(F.size(F.array_except("needed", "tokens")) == 0)
    best = F.struct("confidence", "support", F.size("needed").alias("n"), "rule_id", "needed")
    return fits.groupBy("key").agg(F.max(best).alias("best"))


def judge(
    pages: DataFrame,
    labels: DataFrame,
    rules=RULES,
    min_support: float = MIN_SUPPORT,
    min_confidence: float = MIN_CONFIDENCE,
    min_lift: float = MIN_LIFT,
    min_count: int = MIN_COUNT,
    key: str = "page_id",
) -> DataFrame:
    """One row for each page: page_id, host, path, rule, verdict, mined, confidence.

    `labels` has (page_id, blocked), or another `key` that both tables have.  The fixed rules
    decide first; other pages are blocked when a mined rule fits, which `mined` then shows with its
    `confidence`, and allowed when none does.  A null URL or one without `://` has empty host and
    path and no tokens, and is allowed.  A page id that occurs in several rows gets a row for each;
    labels of one key are blocked when any of them is; null keys and null labels teach nothing.
    Empty tables give an empty result or no rules.  Other columns are not read.
    """
    url = F.coalesce(F.col("url"), F.lit(""))
    rows = numbered(pages, "page_id", "url", F.col(key).alias("of")).select(
        RID, "page_id", "of", host_of(url).alias("host"), path_of(url).alias("path"),
        tokens_of(url).alias("tokens"),
    )
    known = (
        labels.filter(F.col(key).isNotNull() & F.col("blocked").isNotNull())
        .groupBy(F.col(key).alias("of"))
        .agg(F.max("blocked").alias("blocked"))
    )
    # Written, so that the join below is one of two plain shuffles and can be split at a hot key.
    labelled = rows.select("of", "tokens").join(stored(known, "url-labels"), "of").drop("of")
    mined = stored(mine(labelled, min_support, min_confidence, min_lift, min_count), "url-mined")
    # Many pages share a token set: match each set once.
    keyed = rows.withColumn("key", F.xxhash64(F.array_sort("tokens")))
    sets = keyed.groupBy("key", F.array_sort("tokens").alias("tokens")).agg(
        F.count(F.lit(1)).alias("n")
    )
    best = match(
        sets.withColumn("key", F.struct("key", "tokens")), mined
    ).select(F.col("key.key").alias("key"), F.col("key.tokens").alias("set"), "best")
    name, verdict = fixed_rule(F.col("host"), F.col("path"), rules)
    same = (keyed["key"] == best["key"]) & (F.array_sort(keyed["tokens"]) == best["set"])
    learned = F.when(F.col("best").isNotNull(), F.lit("block")).otherwise(F.lit("allow"))
    return keyed.join(best, same, "left").select(
        "page_id",
        "host",
        "path",
        name.alias("rule"),
        F.coalesce(verdict, learned).alias("verdict"),
        F.col("best.needed").alias("mined"),
        F.col("best.confidence").alias("confidence"),
    )


def labels_of_documents(labels: DataFrame) -> DataFrame:
    """Rows (doc_id, blocked): documents of low quality or toxic are blocked."""
    bad = (F.col("quality") == 0) | (F.col("toxic") == 1)
    return labels.select("doc_id", bad.alias("blocked"))


def with_document(pages: DataFrame) -> DataFrame:
    """Pages and the number of the document that each was made from, by its URL, as doc_id."""
    return pages.withColumn("doc_id", document_of(F.col("url")))

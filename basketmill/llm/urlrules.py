"""URL filter: listed host rules, and association rules mined from the pages that the list decides.

Spark's FP-growth mines combinations of URL tokens together with the label. Rules whose consequent is a
label, with enough support and confidence, are kept unless a rule with fewer tokens says the same at
least as surely. They become an inverted index by their rarest token, a table that the tokens of pages are
joined with, so a page meets only rules under its own tokens. Everything is DataFrame code.
"""

from __future__ import annotations

import math
from dataclasses import dataclass
from itertools import product

from pyspark.ml.fpm import FPGrowth
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from basketmill.llm.staging import written

MIN_SUPPORT = 0.01
MIN_CONFIDENCE = 0.8
LEAST_PAGES = 3
DEFAULT = "allow"

# Fixed values: (verdict, host, path). A rule fits its host and all subdomains.
LISTED = (("block", "net", "/"), ("allow", "example.net", "/en/"), ("block", "example.com", "/de/"), ("allow", "org", "/fr/"))


@dataclass(frozen=True)
class UrlRule:
    tokens: tuple[str, ...]
    verdict: str
    confidence: float
    support: float


def host_and_path(url: Column) -> tuple[Column, Column]:
    """Both empty for null and for an url without a scheme."""
    at = F.instr(url, "://")
    rest = F.when(at > 0, F.substring(url, at + 3, F.length(url))).otherwise(F.lit(""))
    rest = F.coalesce(rest, F.lit(""))
    host = F.translate(F.regexp_extract(rest, "^([^/?#]*)", 1), "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")
    return host, F.regexp_extract(rest, "^[^/?#]*([^?#]*)", 1)


def listed_rule(host: Column, path: Column, listed=LISTED) -> tuple[Column, Column]:
    """Name and verdict of the longest listed rule that fits, else null."""
    name = verdict = None
    for kind, domain, start in sorted(listed, key=lambda r: (-len(r[1] + r[2]), r)):
        fits = ((host == domain) | host.endswith(f".{domain}")) & path.startswith(start)
        name = F.when(fits, F.lit(domain + start)) if name is None else name.when(fits, F.lit(domain + start))
        verdict = F.when(fits, F.lit(kind)) if verdict is None else verdict.when(fits, F.lit(kind))
    return name, verdict


def url_tokens(url: Column, host: Column, path: Column) -> Column:
    """Host labels, path segments with digits as #, query keys and a fragment mark, each with its kind."""
    labels = F.transform(F.split(host, r"\."), lambda x: F.concat(F.lit("h:"), x))
    segments = F.transform(F.split(F.regexp_replace(path, "[0-9]+", "#"), "/"), lambda x: F.concat(F.lit("p:"), x))
    query = F.split(F.regexp_extract(F.coalesce(url, F.lit("")), r"^[^?#]*\?([^#]*)", 1), "&")
    keys = F.transform(query, lambda x: F.concat(F.lit("q:"), F.substring_index(x, "=", 1)))
    mark = F.when(F.contains(F.coalesce(url, F.lit("")), F.lit("#")), F.array(F.lit("f:"))).otherwise(F.array().cast("array<string>"))
    return F.array_except(F.array_distinct(F.concat(labels, segments, keys, mark)), F.array(F.lit("h:"), F.lit("p:"), F.lit("q:")))


def without_redundant(rules: list[UrlRule]) -> list[UrlRule]:
    """Rules for which no rule of the same verdict with fewer tokens, all of them its own, is as confident."""
    kept: list[UrlRule] = []
    by_token: dict[str, list[UrlRule]] = {}
    for rule in sorted(rules, key=lambda r: (len(r.tokens), r.tokens, r.verdict)):
        own = set(rule.tokens)
        known = (r for t in rule.tokens for r in by_token.get(t, ()))
        if any(r.verdict == rule.verdict and r.confidence >= rule.confidence and own.issuperset(r.tokens) for r in known):
            continue
        kept.append(rule)
        for token in rule.tokens:
            by_token.setdefault(token, []).append(rule)
    return kept


@dataclass(frozen=True)
class Mined:
    """Rules over items, and the tokens that each item stands for. An item is a token, or several that share all labelled pages."""

    rules: DataFrame  # items, verdict, confidence, support, key (the rarest item)
    members: DataFrame  # item, token


def _items_of(tokens: DataFrame, members: DataFrame) -> DataFrame:
    """(tokens, items) for the distinct token sets of ``tokens`` that have any item."""
    each = tokens.select("tokens").distinct().select("tokens", F.explode("tokens").alias("token"))
    return each.join(members, "token").groupBy("tokens").agg(F.array_sort(F.collect_set("item")).alias("items"))


def _members(rows: DataFrame, least: float) -> DataFrame:
    """Tokens on at least ``least`` pages by the item they belong to, with the pages of the item.

    They number at most the tokens of a mean page over the share that ``least`` is of the pages. Tokens on the same pages
    say the same, and any choice of them would be an itemset of its own: they are one item.
    """
    page = F.xxhash64("tokens", "verdict")
    each = rows.select(F.explode("tokens").alias("token"), page.alias("page"))
    pages = each.groupBy("token").agg(
        F.count("*").alias("pages"), F.sum(F.col("page").cast("decimal(38,0)")).alias("sum"), F.bit_xor(F.xxhash64(F.lit(1), "page")).alias("xor")
    )
    same = pages.where(F.col("pages") >= least).groupBy("pages", "sum", "xor").agg(F.min("token").alias("item"), F.collect_list("token").alias("tokens"))
    return same.select("item", "pages", F.explode("tokens").alias("token"))


def _redundant(rules: DataFrame) -> DataFrame:
    """Rules with a rule of the same verdict and fewer items, all of them theirs, that is as confident."""
    shorter = rules.select(F.col("items").alias("fewer"), "verdict", F.col("confidence").alias("sure"), F.element_at("items", 1).alias("item"))
    longer = rules.select("items", "verdict", "confidence", F.explode("items").alias("item"))
    inside = (F.size("fewer") < F.size("items")) & (F.col("sure") >= F.col("confidence")) & (F.size(F.array_except("fewer", "items")) == 0)
    return longer.join(shorter, ["verdict", "item"]).where(inside).select("items", "verdict").distinct()


def mined_rules(labelled: DataFrame, min_support: float = MIN_SUPPORT, min_confidence: float = MIN_CONFIDENCE) -> Mined | None:
    """All rules from (tokens, verdict) rows that are not redundant; support is a share of the rows, three rows at least.

    Rules are mined, pruned and kept as tables, however many there are. Null without rows.
    """
    rows = written(labelled.select(F.array_sort(F.array_distinct("tokens")).alias("tokens"), "verdict"), "labelled_urls")
    n = rows.count()
    if not n:
        return None
    support = max(min_support, LEAST_PAGES / n)
    # FP-growth counts an itemset from the support's ceiling on.
    members = written(_members(rows, math.ceil(support * n)), "url_items")
    label = F.concat(F.lit("="), F.col("verdict"))
    items = F.coalesce("items", F.array().cast("array<string>"))
    # Both sides come from scans, so that Spark can split a token set of very many pages.
    baskets = rows.join(written(_items_of(rows, members), "url_token_items"), "tokens", "left").select(F.array_append(items, label).alias("items"))
    model = FPGrowth(itemsCol="items", minSupport=support, minConfidence=min_confidence).fit(written(baskets, "url_baskets"))
    found = model.associationRules.where(F.element_at("consequent", 1).startswith("="))
    found = found.where(~F.exists("antecedent", lambda t: t.startswith("=")))
    verdict = F.substring(F.element_at("consequent", 1), 2, 1 << 30).alias("verdict")
    rules = written(found.select(F.array_sort("antecedent").alias("items"), verdict, "confidence", "support"), "url_rules")
    kept = rules.join(_redundant(rules), ["items", "verdict"], "left_anti")
    pages = members.select("item", "pages").distinct()
    rarest = kept.select("items", F.explode("items").alias("item")).join(pages, "item").groupBy("items")
    keys = rarest.agg(F.min_by("item", F.struct("pages", "item")).alias("key"))
    return Mined(written(kept.join(keys, "items"), "url_index"), members.select("item", "token"))


def mine(labelled: DataFrame, min_support: float = MIN_SUPPORT, min_confidence: float = MIN_CONFIDENCE) -> list[UrlRule]:
    """The rules of ``mined_rules`` in tokens, one for every choice among tokens on the same pages; for looking at few rules."""
    mined = mined_rules(labelled, min_support, min_confidence)
    if mined is None:
        return []
    tokens: dict[str, list[str]] = {}
    for row in mined.members.collect():
        tokens.setdefault(row.item, []).append(row.token)
    return [
        UrlRule(tuple(sorted(choice)), r.verdict, r.confidence, r.support)
        for r in mined.rules.collect()
        for choice in product(*(tokens[i] for i in r["items"]))
    ]


def verdicts(tokens: DataFrame, mined: Mined) -> DataFrame:
    """(tokens, mined) for the distinct token sets that a rule fits: the verdict of the most confident rule, the one of more
    items and support first. A set meets only the rules whose rarest item it has."""
    held = _items_of(tokens, mined.members).select("tokens", F.col("items").alias("own"), F.explode("items").alias("key"))
    fitting = held.join(mined.rules, "key").where(F.size(F.array_except("items", "own")) == 0)
    rank = F.struct("confidence", F.size("items"), "support", "verdict")
    return fitting.groupBy("tokens").agg(F.max(rank)["verdict"].alias("mined"))


def mined_verdict(tokens: Column, rules: list[UrlRule]) -> Column:
    """``verdicts`` of a few rules as one expression; null if none fits."""
    if not rules:
        return F.lit(None).cast("string")
    uses: dict[str, int] = {}
    for rule in rules:
        for token in rule.tokens:
            uses[token] = uses.get(token, 0) + 1
    index: dict[str, list[UrlRule]] = {}
    for rule in rules:
        index.setdefault(min(rule.tokens, key=lambda t: (uses[t], t)), []).append(rule)

    def entry(rule: UrlRule) -> Column:
        needs = F.array(*map(F.lit, rule.tokens))
        rank = F.struct(F.lit(rule.confidence), F.lit(len(rule.tokens)), F.lit(rule.support), F.lit(rule.verdict).alias("verdict"))
        return F.struct(needs.alias("needs"), rank.alias("rank"))

    lookup = F.create_map(*[c for t, held in index.items() for c in (F.lit(t), F.array(*map(entry, held)))])
    known = F.array_intersect(tokens, F.array(*map(F.lit, index)))
    candidates = F.flatten(F.transform(known, lambda t: F.try_element_at(lookup, t)))
    fitting = F.filter(candidates, lambda r: F.size(F.array_except(r["needs"], tokens)) == 0)
    return F.array_max(F.transform(fitting, lambda r: r["rank"]))["verdict"]


def judge_urls(pages: DataFrame, listed=LISTED, **mining) -> DataFrame:
    """Per page: page_id, host, path, rule, verdict and by (list, mined or default).

    The listed rules decide first, and the pages they decide are what rules are mined from. A page that
    neither decides is allowed. A null url, or one without a scheme, has an empty host and path and is
    allowed. Repeated pages have a row each; a page without an id too.
    """
    url = F.col("url").cast("string")
    host, path = host_and_path(url)
    parts = pages.select("page_id", url.alias("url"), host.alias("host"), path.alias("path"))
    rule, decided = listed_rule(F.col("host"), F.col("path"), listed)
    parts = parts.select("page_id", "host", "path", rule.alias("rule"), decided.alias("decided"), url_tokens(F.col("url"), F.col("host"), F.col("path")).alias("tokens"))
    parts = parts.withColumn("tokens", F.array_sort("tokens"))
    rules = mined_rules(parts.where("decided IS NOT NULL").select("tokens", F.col("decided").alias("verdict")), **mining)
    if rules is None:
        mined = parts.withColumn("mined", F.lit(None).cast("string"))
    else:
        found = written(verdicts(parts.where("decided IS NULL"), rules), "url_verdicts")
        mined = parts.join(found, "tokens", "left").withColumn("mined", F.when(F.col("decided").isNull(), F.col("mined")))
    by = F.when(F.col("decided").isNotNull(), "list").when(F.col("mined").isNotNull(), "mined").otherwise("default")
    return mined.select("page_id", "host", "path", "rule", F.coalesce("decided", "mined", F.lit(DEFAULT)).alias("verdict"), by.alias("by"))

"""URL filters: given rules for hosts and paths, and association rules mined from the pages they judge.

A given rule names a host, with all its subdomains, and a beginning of the path; the longest rule that
fits a url decides. The urls so judged are the labels: FP-growth mines their tokens (host labels and
their parts, path segments, file kind, query keys, scheme, fragment) together with the verdict. Rules
that end in a verdict with enough support and confidence are kept, less those for which a shorter one
is as sure. An inverted index from each rule's rarest token finds the rules that can fit the other
urls, whose surest rule gives the verdict; without one it is DEFAULT.

Only DataFrame operations run. Verdicts are found once per distinct url, so a url or host that makes
a third of all pages costs one row. All tokens that reach SUPPORT are mined, in itemsets of any length:
there are at most 1 / SUPPORT times as many as a url has. Tokens that occur in exactly the same judged
urls are mined once and their rules written for each of them. Only tokens of all judged urls are left
out: a rule from them is no surer than the share of its verdict.

Edge cases: a null or relative url has an empty host and path and no tokens. Repeated pages are judged
alike. Without a judged url, nothing is mined and all others get DEFAULT. Extra columns are ignored.
"""

from __future__ import annotations

from dataclasses import dataclass
from functools import reduce

from pyspark.ml.fpm import FPGrowth
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from halala.llm.shared import written

ALLOW, BLOCK = "allow", "block"
DEFAULT = ALLOW
SUPPORT, CONFIDENCE = 0.005, 0.6

_UPPER, _LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"


@dataclass(frozen=True)
class Rule:
    host: str
    path: str
    verdict: str

    @property
    def name(self) -> str:
        return self.host + self.path

    def fits(self, host: Column, path: Column) -> Column:
        return ((host == self.host) | host.endswith("." + self.host)) & path.startswith(self.path)


def host_of(url: Column) -> Column:
    found = F.regexp_extract(url, r"(?s)^.*?://([^/?#]*)", 1)
    return F.coalesce(F.translate(found, _UPPER, _LOWER), F.lit(""))


def path_of(url: Column) -> Column:
    return F.coalesce(F.regexp_extract(url, r"(?s)^.*?://[^/?#]*([^?#]*)", 1), F.lit(""))


def longest(rules: list[Rule], host: Column, path: Column) -> Column:
    """The name of the longest rule that fits, the longer host first of equals; null for none."""
    ordered = sorted(rules, key=lambda r: (-len(r.name), -len(r.host), r.name))
    return F.coalesce(*(F.when(r.fits(host, path), F.lit(r.name)) for r in ordered), F.lit(None).cast("string"))


def _named(prefix: str, parts: Column) -> Column:
    return F.transform(F.filter(parts, lambda x: x != ""), lambda x: F.concat(F.lit(prefix), x))


def tokens_of(url: Column, host: Column, path: Column) -> Column:
    """Distinct tokens of a url; numbers are all alike."""
    low = F.regexp_replace(F.lower(path), "[0-9]+", "0")
    query = F.regexp_extract(url, r"(?s)^.*?://[^?#]*\?([^#]*)", 1)
    keys = F.transform(F.split(query, "&"), lambda x: F.substring_index(x, "=", 1))
    parts = [
        _named("host:", F.split(host, r"\.")), _named("host:", F.split(host, r"[.\-_]")),
        _named("path:", F.split(low, r"/")), _named("path:", F.split(low, r"[/.\-_]")), _named("query:", keys),
        _named("scheme:", F.array(F.regexp_extract(url, r"(?s)^(.*?)://", 1))),
        F.when(F.regexp_extract(url, r"(?s)^.*?://[^#]*(#)", 1) == "#", F.array(F.lit("fragment"))).otherwise(F.array().cast("array<string>")),
    ]
    return F.when(host != "", F.array_distinct(F.concat(*parts))).otherwise(F.array().cast("array<string>"))


def token_classes(judged: DataFrame, support: float = SUPPORT) -> list[list[str]]:
    """All tokens with enough support, but those of every url; tokens of exactly the same urls are one class."""
    total = judged.count()
    if not total:
        return []
    alike = judged.groupBy(F.array_sort("tokens").alias("tokens")).agg(F.count("*").alias("n"))
    # Two sets of token lists are equal when both sums of their 64-bit hashes are.
    marks = [F.xxhash64("tokens", F.lit(i)).alias(f"x{i}") for i in (1, 2)]
    counts = alike.select("n", *marks, F.explode("tokens").alias("token")).groupBy("token")
    counts = counts.agg(F.sum("n").alias("n"), F.bit_xor("x1").alias("x1"), F.bit_xor("x2").alias("x2")).where((F.col("n") >= support * total) & (F.col("n") < total))
    classes = counts.groupBy("n", "x1", "x2").agg(F.array_sort(F.collect_list("token")).alias("members"))
    return sorted(r["members"] for r in classes.collect())


def _needed(rules: DataFrame, confidence: float) -> DataFrame:
    """The rules that are sure enough, and surer of their verdict than every part of their tokens.

    `rules` holds all frequent ones, however unsure. Level by level: the surest part of a rule is the surest among
    those that lack one token and their parts, so a rule of n tokens is compared with n others.
    """
    longest_rule = rules.agg(F.max("size")).first()[0] or 0
    kept, before = [], None
    for size in range(1, longest_rule + 1):
        level = rules.where(F.col("size") == size)
        if before is None:
            level = level.withColumn("part_confidence", F.lit(None).cast("double"))
        else:
            known = before.select(F.col("tokens").alias("part"), "verdict", F.greatest("confidence", "part_confidence").alias("best"))
            parts = level.select("tokens", "verdict", F.explode(F.transform("tokens", lambda t: F.array_except("tokens", F.array(t)))).alias("part"))
            best = parts.join(known, ["part", "verdict"]).groupBy("tokens", "verdict").agg(F.max("best").alias("part_confidence"))
            level = level.join(best, ["tokens", "verdict"])
        before = written(level.select(*rules.columns, "part_confidence"))
        kept.append(before.where((F.col("confidence") >= confidence) & (F.col("part_confidence").isNull() | (F.col("confidence") > F.col("part_confidence")))))
    return reduce(DataFrame.unionByName, kept, rules.limit(0).withColumn("part_confidence", F.lit(None).cast("double"))).drop("part_confidence")


def _choices(lists: Column) -> Column:
    """All lists of one element of each list."""
    none = F.array(F.array().cast("array<string>"))
    return F.aggregate(lists, none, lambda found, some: F.flatten(F.transform(found, lambda y: F.transform(some, lambda x: F.concat(y, F.array(x))))))


def mined(judged: DataFrame, support: float = SUPPORT, confidence: float = CONFIDENCE) -> DataFrame | None:
    """(rule, tokens, size, verdict, confidence, support) from judged(tokens, verdict); None without labels."""
    classes = token_classes(judged, support)
    if not classes:
        return None
    first = [c[0] for c in classes]
    kept = F.filter("tokens", lambda t: t.isin(first))
    baskets = judged.select(F.concat(kept, F.array(F.concat(F.lit("verdict:"), "verdict"))).alias("items"))
    model = FPGrowth(itemsCol="items", minSupport=support, minConfidence=0.0).fit(baskets)
    found = model.associationRules.where(F.element_at("consequent", 1).startswith("verdict:")).select(
        F.array_sort("antecedent").alias("tokens"), F.size("antecedent").alias("size"),
        F.substring_index(F.element_at("consequent", 1), ":", -1).alias("verdict"), "confidence", "support",
    )
    rules = written(found.where("not exists(tokens, t -> t like 'verdict:%')"))
    needed = _needed(rules, confidence)
    # Whatever member of a class a url has, the rule holds for it.
    members = F.create_map(*(x for c in classes for x in (F.lit(c[0]), F.array(*map(F.lit, c)))))
    every = needed.withColumn("tokens", F.explode(_choices(F.transform("tokens", lambda t: members[t]))))
    every = every.withColumn("tokens", F.array_sort("tokens")).withColumn("rule", F.array_join("tokens", " "))
    return written(every.select("rule", "tokens", "size", "verdict", "confidence", "support"))


def _indexed(rules: DataFrame, tokens: DataFrame) -> DataFrame:
    """Rules by their rarest token: the one that the fewest urls have."""
    often = tokens.groupBy("token").agg(F.count("*").alias("often"))
    each = rules.select("rule", "verdict", F.explode("tokens").alias("token")).join(often, "token", "left")
    rarest = each.groupBy("rule", "verdict").agg(F.min(F.struct(F.coalesce("often", F.lit(0)).alias("often"), "token")).alias("first"))
    return rules.join(rarest, ["rule", "verdict"]).select("*", F.col("first.token").alias("token")).drop("first")


def judged_by_rules(urls: DataFrame, rules: DataFrame) -> DataFrame:
    """(url, mined_rule, mined_verdict): the surest mined rule that fits each of urls(url, tokens)."""
    each = urls.select("url", F.col("tokens").alias("own"), F.explode("tokens").alias("token"))
    found = each.join(_indexed(rules, each.select("token")), "token")
    fits = found.where(F.size(F.array_intersect("own", "tokens")) == F.col("size"))
    rank = F.struct("confidence", "support", F.col("size"), F.col("verdict"), F.col("rule"))
    best = fits.groupBy("url").agg(F.max(rank).alias("best"))
    return best.select("url", F.col("best.rule").alias("mined_rule"), F.col("best.verdict").alias("mined_verdict"))


def verdicts(pages: DataFrame, given: list[Rule]) -> DataFrame:
    """(page_id, host, path, rule, verdict, mined_rule) for every row of pages(page_id, url, …)."""
    url = F.col("url")
    parts = pages.select("url").distinct().select("url", host_of(url).alias("host"), path_of(url).alias("path"))
    named = parts.withColumn("rule", longest(given, F.col("host"), F.col("path"))).withColumn("tokens", tokens_of(url, F.col("host"), F.col("path")))
    by_name = reduce(lambda c, r: c.when(F.col("rule") == r.name, F.lit(r.verdict)), given, F.when(F.lit(False), F.lit("")))
    urls = written(named.withColumn("ruled", by_name))
    rules = mined(urls.where("ruled is not null").select("tokens", F.col("ruled").alias("verdict")))
    if rules is None:
        decided = urls.select("*", F.lit(None).cast("string").alias("mined_rule"), F.lit(DEFAULT).alias("mined_verdict"))
    else:
        own = judged_by_rules(urls.where("ruled is null").select("url", "tokens"), rules)
        decided = urls.join(own, "url", "left")
    known = decided.select("url", "host", "path", "rule", F.coalesce("ruled", "mined_verdict", F.lit(DEFAULT)).alias("verdict"), "mined_rule").alias("u")
    return pages.select("page_id", "url").alias("p").join(known, F.col("p.url").eqNullSafe(F.col("u.url"))).select("page_id", "host", "path", "rule", "verdict", "mined_rule")

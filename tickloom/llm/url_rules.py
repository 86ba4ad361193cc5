"""URL filtering by association rules, with DataFrame operations only.

Labelled urls become baskets of host and path tokens plus the item ``label:bad`` where the label says
so.  Spark's FP-growth mines frequent token combinations; rules that conclude ``label:bad`` are kept
if their confidence, support and lift (confidence by the share of bad urls) reach the thresholds, the
lower end of the confidence's interval (Wilson) is above that share, and no shorter rule among
their own tokens is as confident.  The interval is one of 95 % for all combinations together: every frequent one is a rule
that chance might have made, so each is tested at 5 % by their number (Bonferroni).  An inverted index holds each rule under its rarest token, so a url meets only rules
whose rarest token it has; what meets is checked for all tokens of the rule.

Explicit (host, path) rules come first: a rule fits its host and all subdomains where the path starts
with the rule's, and the longest fitting rule decides.  Else the most confident mined rule that meets
decides (fewer tokens, then the first by its tokens, on ties) and is told as ``learned``.  Null urls and
urls without ``://`` have an empty host and path, fit no rule and are allowed.  Urls are read whole,
however long.  Repeated rows give a row each; a label without a page and a page without a label count
nowhere.  Empty tables give no rules or no rows.  Other columns are ignored, whatever their names.
"""

from __future__ import annotations

from statistics import NormalDist

from pyspark.ml.fpm import FPGrowth
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ._shared import settle, shuffle_partitions

BAD = "label:bad"
#: (verdict, host, path)
RULES = (("block", "net", "/"), ("allow", "example.net", "/en/"), ("block", "example.com", "/de/"), ("allow", "org", "/fr/"))
#: index rows of about 200 bytes
BROADCAST_RULES = 50_000
_UPPER, _LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"


def host_and_path(url: Column) -> tuple[Column, Column]:
    at = F.instr(url, "://")
    rest = F.when(at > 0, F.substring(url, at + 3, F.length(url)))
    host = F.translate(F.regexp_extract(rest, "^[^/?#]*", 0), _UPPER, _LOWER)
    return F.coalesce(host, F.lit("")), F.coalesce(F.regexp_extract(rest, "^[^/?#]*([^?#]*)", 1), F.lit(""))


def tokens(host: Column, path: Column) -> Column:
    """Distinct tokens: host labels, and letter runs of the path."""
    labels = F.transform(F.filter(F.split(host, r"\."), lambda x: x != ""), lambda x: F.concat(F.lit("h:"), x))
    parts = F.transform(F.filter(F.split(F.translate(path, _UPPER, _LOWER), r"[^\p{L}]+"), lambda x: x != ""), lambda x: F.concat(F.lit("p:"), x))
    return F.array_distinct(F.concat(labels, parts))


def explicit_rule(host: Column, path: Column, rules=RULES) -> tuple[Column, Column]:
    """The longest fitting explicit rule as text, and its verdict; null where none fits."""
    name, verdict = F.lit(None).cast("string"), F.lit(None).cast("string")
    for what, h, p in sorted(rules, key=lambda r: len(r[1] + r[2])):
        fits = ((host == h) | host.endswith("." + h)) & path.startswith(p)
        name, verdict = F.when(fits, F.lit(h + p)).otherwise(name), F.when(fits, F.lit(what)).otherwise(verdict)
    return name, verdict


def mine(urls: DataFrame, bad: DataFrame, min_support: float = 0.002, min_confidence: float = 0.6, min_rows: int = 5, min_lift: float = 1.5) -> DataFrame:
    """``tokens, head, confidence, support, lift`` of the rules.

    ``urls`` has ``id, tokens``, ``bad`` has ``id, bad``; ``head`` is the rule's rarest token.
    """
    spark = urls.sparkSession
    baskets = urls.join(bad, "id").select(F.when(F.col("bad"), F.concat("tokens", F.array(F.lit(BAD)))).otherwise(F.col("tokens")).alias("items"))
    baskets = settle(baskets)
    n, hits = baskets.agg(F.count("*"), F.count_if(F.array_contains("items", BAD))).first()
    schema = T.StructType.fromDDL("tokens array<string>, head string, confidence double, support double, lift double")
    if not hits:
        return spark.createDataFrame([], schema)
    support = min(1.0, max(min_support, min_rows / n))
    model = FPGrowth(itemsCol="items", minSupport=support, minConfidence=min_confidence, numPartitions=shuffle_partitions(spark)).fit(baskets)
    sets = settle(model.freqItemsets)
    good = sets.where(F.array_contains("items", BAD) & (F.size("items") > 1)).select(F.array_sort(F.array_remove("items", BAD)).alias("tokens"), F.col("freq").alias("both"))
    whole = sets.where(~F.array_contains("items", BAD)).select(F.array_sort("items").alias("tokens"), "freq")
    share, z = hits / n, NormalDist().inv_cdf(1 - 0.025 / max(1, whole.count()))
    c, m = F.col("both") / F.col("freq"), F.col("freq")
    least = (c + z * z / (2 * m) - z * F.sqrt(c * (1 - c) / m + z * z / (4 * m * m))) / (1 + z * z / m)
    rules = good.join(whole, "tokens").where(least > share).select("tokens", c.alias("confidence"), (F.col("both") / n).alias("support"), (c / share).alias("lift"))
    rules = rules.where((F.col("confidence") >= min_confidence) & (F.col("lift") >= min_lift))
    rules = rules.withColumn("rule", F.monotonically_increasing_id())
    rules = settle(rules)
    # a longer rule must be more confident than each rule on one token less
    shorter = rules.where(F.size("tokens") > 1).select("rule", "confidence", F.explode(F.transform("tokens", lambda x: F.array_remove("tokens", x))).alias("less"))
    beaten = shorter.join(rules.select(F.col("tokens").alias("less"), F.col("confidence").alias("as_good")), "less").where("as_good >= confidence").select("rule").distinct()
    rules = rules.join(beaten, "rule", "left_anti")
    single = whole.where(F.size("tokens") == 1).select(F.col("tokens")[0].alias("token"), "freq")
    heads = rules.select("rule", F.explode("tokens").alias("token")).join(single, "token").groupBy("rule").agg(F.min_by("token", F.struct("freq", "token")).alias("head"))
    return settle(rules.join(heads, "rule").select("tokens", "head", "confidence", "support", "lift"))


def filter_urls(pages: DataFrame, labels: DataFrame, id_col: str = "page_id", url_col: str = "url", rules=RULES, **options) -> DataFrame:
    """``page_id, host, path, rule, verdict, learned, confidence, lift`` of every page.

    ``labels`` has ``doc_id`` (the page's id), ``quality`` and ``toxic``; a url is bad where quality is
    0 or toxic is 1 in any of its labels.
    """
    own = pages.select(F.col(id_col).alias("id"), F.col(url_col).alias("url"))
    host, path = host_and_path(F.col("url"))
    own = own.select("id", host.alias("host"), path.alias("path"))
    own = own.withColumn("tokens", tokens(F.col("host"), F.col("path")))
    bad = labels.groupBy(F.col("doc_id").alias("id")).agg(F.max(F.coalesce((F.col("quality") == 0) | (F.col("toxic") == 1), F.lit(False))).alias("bad"))
    index = mine(own.select("id", "tokens"), bad, **options)
    small = index.limit(BROADCAST_RULES + 1).count() <= BROADCAST_RULES
    # equal hosts and paths get one decision
    met = own.select("host", "path", "tokens").distinct().withColumn("head", F.explode("tokens"))
    listed = index.select("head", F.col("tokens").alias("need"), "confidence", "lift")
    met = met.join(F.broadcast(listed) if small else listed, "head").where(F.size(F.array_except("need", "tokens")) == 0)
    best = F.struct(-F.col("confidence"), F.size("need"), "need")
    hits = met.groupBy("host", "path").agg(F.min_by(F.struct("need", "confidence", "lift"), best).alias("by"))
    name, verdict = explicit_rule(F.col("host"), F.col("path"), rules)
    out = own.drop("tokens").join(hits, ["host", "path"], "left")
    learned = F.when(F.col("by").isNotNull(), F.lit("block")).otherwise(F.lit("allow"))
    out = out.withColumn("by", F.when(verdict.isNull(), F.col("by")))
    return out.select(F.col("id").alias("page_id"), "host", "path", name.alias("rule"), F.coalesce(verdict, learned).alias("verdict"), F.array_join("by.need", " ").alias("learned"), "by.confidence", "by.lift")

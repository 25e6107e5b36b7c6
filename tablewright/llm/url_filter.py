"""URL filter: listed rules by host and path, and association rules that FP-growth mines from labels.

Everything is DataFrame functions and Spark's FP-growth. A URL's tokens are all its named parts: domain
levels, path parts, extension, query names; nothing is cut from a URL. The transactions are the
tokens of the labelled bad URLs, so the support of a set is the bad pages that have it (a share of
the labelled URLs and a number of them, at least); how many labelled URLs have it at all then gives
its confidence.

So that long URLs do not make every subset of their parts an itemset, what cannot make a rule surer is left
out before: tokens below the support; tokens of every labelled URL; tokens that are always bad, which are
rules by themselves; and tokens that always occur together count as one. Sets grow with the
combinations of what is left on bad URLs, and no join pairs tokens with each other.

Matching is an inverted index: each rule is filed under the rarest of its tokens, a URL's
tokens are joined with it, and a rule counts when all its tokens are there. Spark broadcasts
the index while it is small and joins by shuffle otherwise.

Defined cases: a null URL, or one without ``://``, has an empty host and path, no tokens and
the verdict allow; repeated rows get equal results; labels without a URL, and null labels,
are not mined; without labels nothing is mined and the listed rules still hold.
"""

from __future__ import annotations

import math

from pyspark.ml.fpm import FPGrowth
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tablewright.llm.common import bind, lower_ascii, written
from tablewright.operators.joins import per_join_key

#: The listed rules, as (verdict, host, path).
RULES = [
    ("allow", "org", "/"),
    ("block", "example.org", "/es/"),
    ("block", "example.org", "/en/1"),
    ("allow", "com", "/fr/"),
    ("block", "com", "/de/"),
]
MIN_SUPPORT = 0.0005
#: Bad pages that a rule rests on, at least, however few are labelled.
MIN_PAGES = 5
MIN_CONFIDENCE = 0.5
MIN_LIFT = 1.5


def parts(url: Column) -> Column:
    """Struct of host (A-Z lowered) and path."""
    at = F.instr(url, "://")
    rest = F.when(at > 0, F.substr(url, at + 3))
    host = lower_ascii(F.regexp_extract(rest, r"^([^/?#]*)", 1))
    path = F.regexp_extract(rest, r"^[^/?#]*([^?#]*)", 1)
    return F.struct(F.coalesce(host, F.lit("")).alias("host"), F.coalesce(path, F.lit("")).alias("path"))


def listed(host: Column, path: Column, rules: list[tuple[str, str, str]]) -> Column:
    """Struct of rule and verdict of the longest listed rule that fits, else null."""
    out = F.lit(None).cast("struct<rule:string,verdict:string>")
    for verdict, name, start in sorted(rules, key=lambda r: len(r[1] + r[2])):
        fits = ((host == name) | host.endswith("." + name)) & path.startswith(start)
        out = F.when(fits, F.struct(F.lit(name + start).alias("rule"), F.lit(verdict).alias("verdict"))).otherwise(out)
    return out


def tokens(url: Column, host: Column, path: Column) -> Column:
    """The named parts of a URL; digits become # so that ids do not tell pages apart."""

    def plain(x: Column) -> Column:
        return F.regexp_replace(lower_ascii(x), "[0-9]+", "#")

    labels = F.filter(F.split(host, r"\."), lambda x: x != "")
    levels = F.transform(F.reverse(labels), lambda x, i: F.concat(F.lit("host"), i, F.lit("="), x))
    steps = F.filter(F.split(path, "/"), lambda x: x != "")
    named = F.transform(steps, lambda x, i: F.concat(F.lit("path"), i, F.lit("="), plain(x)))
    ending = F.regexp_extract(path, r"\.([A-Za-z0-9]{1,5})$", 1)
    query = F.regexp_extract(url, r"\?([^#]*)", 1)
    asked = F.transform(
        F.array_distinct(F.filter(F.split(query, "&"), lambda x: x != "")),
        lambda x: F.concat(F.lit("query="), plain(F.regexp_extract(x, "^([^=]*)", 1))),
    )
    more = F.array(
        F.when(ending != "", F.concat(F.lit("ending="), F.lower(ending))),
        F.when(F.instr(url, "#") > 0, F.lit("fragment")),
    )
    found = F.array_distinct(F.array_compact(F.concat(levels, named, asked, more)))
    return F.when(host == "", F.array().cast("array<string>")).otherwise(found)


def with_parts(pages: DataFrame) -> DataFrame:
    split = pages.select("page_id", "url", parts(F.col("url")).alias("p")).select("page_id", "url", "p.host", "p.path")
    return split.withColumn("tokens", tokens(F.col("url"), F.col("host"), F.col("path")))


def mine(
    urls: DataFrame,
    labels: DataFrame,
    min_support: float = MIN_SUPPORT,
    min_confidence: float = MIN_CONFIDENCE,
    min_lift: float = MIN_LIFT,
) -> tuple[DataFrame, DataFrame]:
    """token, same: the class of each frequent token; and tokens, confidence: rules from classes to a bad label."""
    bad = F.greatest((F.col("quality") == 0).cast("int"), (F.col("toxic") == 1).cast("int"))
    marked = labels.groupBy(F.col("doc_id").alias("page_id")).agg(F.max(bad).alias("bad"))
    known = urls.join(marked.filter("bad IS NOT NULL"), "page_id").filter(F.size("tokens") > 0)
    baskets = known.groupBy("tokens").agg(F.count("*").alias("n"), F.sum("bad").alias("bad"))
    baskets = written(baskets.withColumn("basket", F.xxhash64("tokens")), "url-baskets")
    total, all_bad = baskets.agg(F.sum("n"), F.sum("bad")).first()
    least = max(min_support * (total or 0), MIN_PAGES)
    sure = max(min_confidence, min_lift * (all_bad or 0) / (total or 1))
    held = baskets.select("basket", "n", "bad", F.explode("tokens").alias("token"))
    counts = [F.sum("n").alias("n"), F.sum("bad").alias("bad")]
    marks = [F.bit_xor("basket").alias("x"), F.sum(F.pmod("basket", F.lit(1 << 31))).alias("y"), F.count("*").alias("z")]
    frequent = written(held.groupBy("token").agg(*counts, *marks).filter(F.col("bad") >= least), "url-tokens")
    first = frequent.groupBy("x", "y", "z").agg(F.min("token").alias("same"))
    classes = frequent.join(first, ["x", "y", "z"]).select("token", "same", "n", "bad")
    classes = written(classes, "url-classes")
    mixed = classes.filter((F.col("token") == F.col("same")) & (F.col("bad") < F.col("n")) & (F.col("n") < (total or 0)))
    held = held.join(mixed.select("token"), "token").select("basket", "n", "bad", "token")
    reduced = held.groupBy("basket", "n", "bad").agg(F.array_sort(F.collect_list("token")).alias("items"))
    reduced = written(reduced.groupBy("items").agg(*counts), "url-reduced")
    sets = _sets(reduced, least).unionAll(classes.filter("token = same").select(F.array("token"), "n", "bad")).distinct()
    rules = sets.select("tokens", (F.col("bad") / F.col("n")).alias("confidence"))
    return classes.select("token", "same"), rules.filter(F.col("confidence") >= sure - 1e-12)


def _sets(baskets: DataFrame, least: float) -> DataFrame:
    """tokens, n, bad: the sets of two tokens or more that ``least`` bad pages have, and who has them."""
    bad = baskets.filter((F.col("bad") > 0) & (F.size("items") > 1))
    # FP-growth knows no weights: a basket is there for each of its pages
    pages = written(bad.select(F.explode(F.array_repeat("items", F.col("bad").cast("int"))).alias("items")), "url-bad")
    many = pages.count()
    if many < least:
        return baskets.select(F.col("items").alias("tokens"), "n", "bad").limit(0)
    # a share that stands for the whole number ``least`` whatever the rounding
    model = FPGrowth(itemsCol="items", minSupport=(math.ceil(least) - 0.5) / many).fit(pages)
    found = model.freqItemsets.filter(F.size("items") > 1).select(F.array_sort("items").alias("tokens"), F.col("freq").alias("bad"))
    found = written(found.withColumn("id", F.monotonically_increasing_id()), "url-sets")
    held = _filed(baskets.select("items", "n"), "items", found)
    return held.groupBy("id", "tokens", "bad").agg(F.sum("n").alias("n")).select("tokens", "n", "bad")


def _filed(baskets: DataFrame, items: str, sets: DataFrame) -> DataFrame:
    """Every basket with every set of ``sets`` (tokens) that lies in it, by an inverted index.

    A set is filed under the rarest of its tokens, so common tokens lead to few sets.
    """
    token = F.explode(items).alias("token")
    frequency = per_join_key(baskets.select(token), ["token"], F.count("*").alias("often"))
    filed = sets.select("id", F.explode("tokens").alias("token")).join(frequency, "token")
    rarest = filed.groupBy("id").agg(F.min(F.struct("often", "token")).alias("rarest"))
    index = written(sets.join(rarest, "id").withColumn("token", F.col("rarest.token")).drop("rarest"), "url-index")
    met = baskets.select("*", token).join(index, "token")
    return met.filter(F.size(F.array_except("tokens", items)) == 0).drop("token")


def match(urls: DataFrame, classes: DataFrame, rules: DataFrame) -> DataFrame:
    """url, confidence of the surest rule that fits: the URLs that a mined rule blocks."""
    named = urls.select("url", F.explode("tokens").alias("token")).distinct().join(classes, "token")
    urls = written(named.groupBy("url").agg(F.collect_set("same").alias("held")), "url-held")
    rules = written(rules.withColumn("id", F.xxhash64("tokens")), "url-rules")
    return _filed(urls, "held", rules).groupBy("url").agg(F.max("confidence").alias("confidence"))


def judge(pages: DataFrame, labels: DataFrame, rules: list[tuple[str, str, str]] = RULES, **limits: float) -> DataFrame:
    """A row for each page: host, path, the listed rule, the verdict, the surest mined rule."""
    urls = with_parts(pages)
    blocked = match(urls, *mine(urls, labels, **limits)).withColumnRenamed("url", "blocked_url")
    by_list = bind(listed(F.col("host"), F.col("path"), rules), lambda x: x)
    method = F.when(F.col("confidence").isNotNull(), "block").otherwise("allow")
    joined = urls.join(blocked, F.col("url") == F.col("blocked_url"), "left").withColumn("listed", by_list)
    return joined.select(
        "page_id", "host", "path", F.col("listed.rule").alias("rule"),
        F.coalesce("listed.verdict", method).alias("verdict"), F.col("confidence").alias("mined_confidence"),
    )

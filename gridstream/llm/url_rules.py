"""URL filters (operator 7): association-rule filtering, native Spark throughout.

Labelled pages become transactions of URL tokens (host suffixes, path words,
query names); Spark's FP-growth mines token combinations together with the
label ``bad``, and rules {tokens} -> bad are kept above a support and a
confidence.  A rule is indexed under its rarest token; a page meets only the
rules indexed under one of its tokens and is blocked if it has all tokens of
one.  Fixed rules (host, path) come first: the longest that fits decides.

A page's label is the row of ``labels`` whose doc_id is the page_id: bad if
quality is 0 or toxic is 1.  Rules need MIN_PAGES bad pages, however many are
labelled, and MIN_CONFIDENCE; tokens on fewer bad pages are dropped before mining.
A rule has any number of tokens.

Before mining, two steps keep the number of token sets small without changing a
verdict.  A token that is a rule by itself is taken out of the transactions:
every set that holds it is covered by it.  Tokens on the same labelled pages
(equal count, and equal xor and sum of 64-bit hashes of the pages) are
one class, mined as one token; a page has a class if it has any of its tokens.
So one long bad url on many rows gives single rules or one class, not 2**n sets.
What is still exponential, as in any mining of all frequent sets: tokens that
meet on MIN_PAGES bad pages, are no rules alone and lie on different pages each.
A rule whose tokens less one are a rule is left out.

Edge cases: a null url, or one without ``://``, has an empty host and path, no
tokens and is allowed; equal urls are judged once, each row gets the verdict; a
null page_id has no label; several labels of a page count as bad if one is; no
labels, or no rule above the limits, leave the fixed rules; other columns are
not read; an empty table gives no rows.
"""

from __future__ import annotations

from pyspark.ml.fpm import FPGrowth
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from gridstream.llm.common import shuffle_parts, table, written

#: Fixed rules: (verdict, host, path prefix).
FIXED: list[tuple[str, str, str]] = [("block", "net", "/"), ("allow", "example.net", "/en/"), ("block", "example.com", "/de/"), ("allow", "org", "/fr/")]
MIN_PAGES, MIN_CONFIDENCE = 20, 0.8
BAD = "label=bad"
UPPER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ"


def parsed(pages: DataFrame, url_col: str = "url") -> DataFrame:
    """The rows with host and path of their url."""
    url = F.coalesce(F.col(url_col), F.lit(""))
    at = F.instr(url, "://")
    rest = F.when(at > 0, F.substring(url, at + 3, F.length(url))).otherwise(F.lit(""))
    return (pages.withColumn("_rest", rest)
            .withColumn("host", F.translate(F.regexp_extract("_rest", "^[^/?#]*", 0), UPPER, UPPER.lower()))
            .withColumn("path", F.regexp_extract("_rest", "^[^/?#]*([^?#]*)", 1)).drop("_rest"))


def fits(host: str, path: str) -> Column:
    own = F.col("host")
    return ((own == host) | own.endswith("." + host)) & F.col("path").startswith(path)


def fixed_rule(rules: list[tuple[str, str, str]] = FIXED) -> tuple[Column, Column]:
    """(rule, verdict) of the longest fixed rule that fits, else null."""
    ordered = sorted(rules, key=lambda r: (-len(r[1] + r[2]), r[1] + r[2]))
    name, verdict = F.lit(None).cast("string"), F.lit(None).cast("string")
    for what, host, path in reversed(ordered):
        name = F.when(fits(host, path), F.lit(host + path)).otherwise(name)
        verdict = F.when(fits(host, path), F.lit(what)).otherwise(verdict)
    return name, verdict


def tokens(url_col: str = "url") -> Column:
    """Distinct tokens of a url: host suffixes, path words, query names."""
    labels = F.filter(F.split("host", "\\."), lambda x: x != "")
    hosts = F.when(F.size(labels) > 0, F.transform(
        F.sequence(F.lit(1), F.size(labels)), lambda i: F.concat(F.lit("host="), F.array_join(F.slice(labels, i, F.size(labels)), "."))))
    words = F.transform(F.filter(F.split("path", "/"), lambda x: x != ""), lambda x: F.concat(F.lit("path="), x))
    query = F.regexp_extract(F.coalesce(F.col(url_col), F.lit("")), "^[^?#]*\\?([^#]*)", 1)
    names = F.transform(F.filter(F.split(query, "&"), lambda x: x != ""), lambda x: F.concat(F.lit("query="), F.substring_index(x, "=", 1)))
    none = F.array().cast("array<string>")
    return F.array_distinct(F.concat(F.coalesce(hosts, none), words, names))


def reduced(labelled: DataFrame, min_pages: int = MIN_PAGES, min_confidence: float = MIN_CONFIDENCE) -> tuple[DataFrame, DataFrame, DataFrame]:
    """(cells, single, classes) of ``labelled`` (items, bad): the transactions as
    rows (n, bad, item), tokens that are rules by themselves, and the class
    (its least token) of every other token on ``min_pages`` bad pages."""
    able = (labelled.where("bad").select(F.explode("items").alias("item")).groupBy("item").agg(F.count("*").alias("_bad"))
            .where(F.col("_bad") >= min_pages).select("item"))
    numbered = labelled.withColumn("n", F.monotonically_increasing_id()).select("n", "bad", F.explode("items").alias("item"))
    cells = written(numbered.join(able, "item"), "cells")
    spread = F.pmod(F.xxhash64(F.lit("s"), "n"), F.lit((1 << 31) - 1))
    stats = cells.groupBy("item").agg(F.count("*").alias("all"), F.count_if("bad").alias("bad"),
                                      F.bit_xor(F.xxhash64("n")).alias("x"), F.sum(spread).alias("s"))
    alone = F.col("bad") / F.col("all") >= min_confidence
    rest = stats.where(~alone)
    least = rest.groupBy("all", "x", "s").agg(F.min("item").alias("class"))
    return cells, stats.where(alone).select("item"), rest.join(least, ["all", "x", "s"]).select("item", "class")


def rules_and_classes(labelled: DataFrame, min_pages: int = MIN_PAGES, min_confidence: float = MIN_CONFIDENCE) -> tuple[DataFrame, DataFrame]:
    """(items, anchor) of the rules {items} -> bad over classes of tokens, and
    (item, class): the class of every token that a rule may need."""
    spark = labelled.sparkSession
    cells, single, classes = reduced(labelled, min_pages, min_confidence)
    single, classes = written(single, "single"), written(classes, "classes")
    own = cells.join(classes, "item").groupBy("n", "bad").agg(F.collect_set("class").alias("items"))
    transactions = written(own.select(F.when(F.col("bad"), F.array_append("items", F.lit(BAD))).otherwise(F.col("items")).alias("items")), "transactions")
    rules = single.select(F.array("item").alias("items"), F.col("item").alias("anchor"))
    n = transactions.count()
    if n:
        # half a page less, as the product with n is rounded up
        model = FPGrowth(itemsCol="items", minSupport=min(1.0, (min_pages - 0.5) / n), minConfidence=min_confidence,
                         numPartitions=shuffle_parts(spark)).fit(transactions)
        mined = written(model.associationRules.where(F.array_join("consequent", ",") == BAD)
                        .select(F.sort_array("antecedent").alias("items")), "mined")
        less = mined.where(F.size("items") > 1).select("items", F.explode("items").alias("out")).select(
            F.array_except("items", F.array("out")).alias("part"), F.col("items").alias("whole"))
        wide = less.join(mined.withColumnRenamed("items", "part"), "part").select(F.col("whole").alias("items")).distinct()
        freq = model.freqItemsets.where(F.size("items") == 1).select(F.col("items")[0].alias("item"), "freq")
        anchored = (mined.join(wide, "items", "left_anti").select("items", F.explode("items").alias("item")).join(freq, "item")
                    .groupBy("items").agg(F.min_by("item", F.struct("freq", "item")).alias("anchor")))
        rules = rules.unionByName(anchored)
    return written(rules, "rules"), classes.unionByName(single.select("item", F.col("item").alias("class")))


def mined_rules(labelled: DataFrame, min_pages: int = MIN_PAGES, min_confidence: float = MIN_CONFIDENCE) -> DataFrame:
    """(items, anchor) of the rules {items} -> bad; ``labelled`` has items and bad."""
    return rules_and_classes(labelled, min_pages, min_confidence)[0]


def matched_urls(pages: DataFrame, rules: DataFrame, classes: DataFrame, url_col: str = "url") -> DataFrame:
    """Distinct urls that have all classes of a rule."""
    own = pages.where(F.col(url_col).isNotNull()).select(F.col(url_col).alias("url"), "host", "path").distinct()
    placed = (own.select("url", F.explode(tokens("url")).alias("item")).join(classes, "item")
              .groupBy("url").agg(F.collect_set("class").alias("own")))
    met = placed.select("url", "own", F.explode("own").alias("anchor")).join(rules, "anchor")
    return met.where(F.size(F.array_except("items", "own")) == 0).select("url").distinct()


def judged(pages: DataFrame, labels: DataFrame, id_col: str = "page_id", url_col: str = "url") -> DataFrame:
    """page_id, host, path, rule, verdict."""
    own = parsed(pages.select(F.col(id_col).alias("page_id"), F.col(url_col).alias("url")))
    bad = (labels.where(F.col("doc_id").isNotNull()).groupBy(F.col("doc_id").alias("page_id"))
           .agg(F.max((F.coalesce(F.col("quality") == 0, F.lit(False))) | F.coalesce(F.col("toxic") == 1, F.lit(False))).alias("bad")))
    labelled = own.join(bad, "page_id").select(tokens().alias("items"), "bad")
    blocked = matched_urls(own, *rules_and_classes(labelled)).withColumn("_bad", F.lit(True))
    rule, verdict = fixed_rule()
    return (own.join(blocked, "url", "left")
            .select("page_id", "host", "path", rule.alias("rule"),
                    F.coalesce(verdict, F.when(F.col("_bad"), F.lit("block")).otherwise(F.lit("allow"))).alias("verdict")))


def op7_url_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    return judged(table(spark, sf_dir, "pages"), table(spark, sf_dir, "labels"))


OP7_SQL = r"""
WITH RECURSIVE u AS (SELECT page_id, url, CASE WHEN strpos(coalesce(url, ''), '://') > 0 THEN substr(url, strpos(url, '://') + 3) ELSE '' END AS rest FROM pages),
p AS (SELECT page_id, url, translate(regexp_extract(rest, '^[^/?#]*', 0), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS host,
    regexp_extract(rest, '^[^/?#]*([^?#]*)', 1) AS path FROM u),
s AS (SELECT *, list_filter(string_split(host, '.'), lambda x: x <> '') AS l FROM p),
t AS (SELECT page_id, url, host, path, list_distinct(list_concat(
    list_transform(range(1, len(l) + 1), lambda i: 'host=' || array_to_string(list_slice(l, i, len(l)), '.')),
    list_transform(list_filter(string_split(path, '/'), lambda x: x <> ''), lambda x: 'path=' || x),
    list_transform(list_filter(string_split(regexp_extract(coalesce(url, ''), '^[^?#]*\?([^#]*)', 1), '&'), lambda x: x <> ''),
                   lambda x: 'query=' || string_split(x, '=')[1]))) AS items FROM s),
b AS (SELECT doc_id AS page_id, max(CASE WHEN quality = 0 OR toxic = 1 THEN 1 ELSE 0 END) AS bad FROM labels GROUP BY doc_id),
x AS (SELECT row_number() OVER () AS n, items, bad FROM t JOIN b USING (page_id)),
c AS (SELECT n, bad, unnest(items) AS a FROM x),
o AS (SELECT a, CAST(sum(bad) AS DOUBLE) / count(*) >= 0.8 AS alone FROM c GROUP BY a HAVING sum(bad) >= 20),
i AS (SELECT n, bad, a FROM c JOIN o USING (a) WHERE NOT alone),
k AS (SELECT [a] AS s, a AS z, n, bad FROM i
  UNION ALL SELECT s, z, n, bad FROM (SELECT *, sum(bad) OVER (PARTITION BY s) AS f FROM (
    SELECT list_append(k.s, i.a) AS s, i.a AS z, k.n, k.bad FROM k JOIN i ON i.n = k.n AND i.a > k.z)) WHERE f >= 20),
r AS (SELECT s FROM k GROUP BY s HAVING CAST(sum(bad) AS DOUBLE) / count(*) >= 0.8 UNION ALL SELECT [a] FROM o WHERE alone),
m AS (SELECT DISTINCT url FROM t JOIN r ON len(list_filter(r.s, lambda y: NOT list_contains(t.items, y))) = 0),
f AS (SELECT *, CASE
    WHEN (host = 'example.com' OR host LIKE '%.example.com') AND starts_with(path, '/de/') THEN 'example.com/de/'
    WHEN (host = 'example.net' OR host LIKE '%.example.net') AND starts_with(path, '/en/') THEN 'example.net/en/'
    WHEN (host = 'org' OR host LIKE '%.org') AND starts_with(path, '/fr/') THEN 'org/fr/'
    WHEN (host = 'net' OR host LIKE '%.net') AND starts_with(path, '/') THEN 'net/' END AS rule FROM t)
SELECT page_id, host, path, rule, CASE WHEN rule IN ('net/', 'example.com/de/') THEN 'block' WHEN rule IS NOT NULL THEN 'allow'
    WHEN url IN (SELECT url FROM m) THEN 'block' ELSE 'allow' END AS verdict FROM f
"""

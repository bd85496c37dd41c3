"""Mixing sources to target weights (operator 9): Efraimidis-Spirakis sampling,
native Spark throughout.

Sources in code-point order (null last) weigh WEIGHTS in turn and share
SHARE of all words; a target stops at MOST_EPOCHS times its source's size and
the excess is shared again by weight until none is above.  That is a water
level: with sources sorted by limit per weight, those below the level take
their limit, all others level * weight, found with running sums.

A document gets the exponential key -ln(u) / weight, u from an MD5 of its id
and a seed, weight its quality.  Where an id is null or on several rows, u is
drawn from the id, an MD5 of the text, and a number among equal rows: such rows
spread like others and are sampled by chance.  A source takes whole epochs first, then
documents by key until its budget is used; the document at the edge is taken
if that comes nearer.  The running sum within a source is split: keys fall
into ranges of about RANGE_ROWS documents, ranges are summed first, and each
range adds the sum of those before it, so a source of any size is no single
task.

Weights come from ``labels``: good quality 2, bad 0.5, unlabelled 1, toxic a
quarter of that.  Key ranges stay within a factor (largest over least weight)
of even.  The table of sources (not documents) is ordered in one task.

Edge cases: a null text has size 0 and takes nothing; a null source is a source
of its own; a null doc_id counts as an empty one in the key; equal rows are
numbered by slices, whatever their order, and get keys of their own; rows
with equal keys follow by id, then size;
other columns pass through untouched; empty tables, and tables without words,
give targets of 0.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from gridstream.llm.common import table, written

WEIGHTS = (3, 1, 2)
SHARE_PERCENT = 150
MOST_EPOCHS = 2
SEED = "mix-1"
SLICES = 64                        # of equal rows
RANGE_ROWS = 5000


def words(text: str = "text") -> Column:
    return F.coalesce(F.regexp_count(F.col(text), F.lit("[^\\x20\\x09-\\x0D]+")), F.lit(0)).cast("long")


def quality_weights(labels: DataFrame) -> DataFrame:
    """(id, weight): one row for each labelled document."""
    return (labels.where("doc_id is not null").groupBy(F.col("doc_id").alias("_label_id"))
            .agg(F.max("quality").alias("q"), F.max("toxic").alias("t"))
            .select("_label_id", (F.when(F.col("q") == 1, 2.0).when(F.col("q") == 0, 0.5).otherwise(1.0)
                                  * F.when(F.col("t") == 1, 0.25).otherwise(1.0)).alias("_label_weight")))


def marked(rows: DataFrame, id_col: str = "doc_id") -> DataFrame:
    """``rows`` (with digest) and ``mark``: empty where the id is on this row only,
    else the digest and the row's number among equal rows."""
    several = written(rows.where(F.col(id_col).isNotNull()).groupBy(F.col(id_col).alias("_several")).agg(F.count("*").alias("_rows"))
                      .where("_rows > 1").drop("_rows"), "several-ids")
    d = rows.join(several, F.col(id_col) == F.col("_several"), "left")
    some = F.col(id_col).isNull() | F.col("_several").isNotNull()
    # equal rows: counted by slice, the counts summed, and numbered within a
    # slice; the slices are written, as they must be the same in both places
    rest = written(d.where(some).drop("_several").withColumn("_slice", F.monotonically_increasing_id() % SLICES), "equal-rows")
    counts = rest.groupBy(id_col, "digest", "_slice").agg(F.count("*").alias("_n"))
    upto = Window.partitionBy(id_col, "digest").orderBy("_slice").rowsBetween(Window.unboundedPreceding, -1)
    bases = counts.select(F.col(id_col).alias("_id"), F.col("digest").alias("_d"), F.col("_slice").alias("_s"), F.coalesce(F.sum("_n").over(upto), F.lit(0)).alias("_base"))
    within = Window.partitionBy(id_col, "digest", "_slice").orderBy("size")
    numbered = (rest.withColumn("_nth", F.row_number().over(within))
                .join(bases, F.col(id_col).eqNullSafe(F.col("_id")) & (F.col("digest") == F.col("_d")) & (F.col("_slice") == F.col("_s")))
                .withColumn("mark", F.concat_ws(":", F.lit(""), "digest", (F.col("_nth") + F.col("_base")).cast("string"))))
    return (d.where(~some).drop("_several").withColumn("mark", F.lit(""))
            .unionByName(numbered.drop("_slice", "_nth", "_id", "_d", "_s", "_base")))


def key(id_col: str, weight: str) -> Column:
    """Exponential key of a document: the less, the earlier it is taken."""
    digest = F.md5(F.concat(F.lit(SEED + ":"), F.coalesce(F.col(id_col).cast("string"), F.lit("")), F.col("mark")))
    u = (F.conv(F.substring(digest, 1, 13), 16, 10).cast("double") + 0.5) / float(1 << 52)
    return -F.log(u) / F.col(weight)


def targets(rows: DataFrame) -> DataFrame:
    """One row for each source: source, source_size, n_rows, least weight, target."""
    own = rows.groupBy("source").agg(F.sum("size").alias("source_size"), F.count("*").alias("n_rows"), F.min("weight").alias("least_weight"))
    turn = (F.row_number().over(Window.orderBy(F.col("source").asc_nulls_last())) - 1) % len(WEIGHTS)
    share = F.when(turn == 0, WEIGHTS[0]).when(turn == 1, WEIGHTS[1]).otherwise(WEIGHTS[2]).cast("long")
    limited = own.withColumn("w", share).withColumn("most", MOST_EPOCHS * F.col("source_size"))
    by = Window.orderBy(F.col("most") / F.col("w"), F.col("source").asc_nulls_last())
    before = by.rowsBetween(Window.unboundedPreceding, -1)
    every = Window.partitionBy()
    # 2 * budget = 3 * all sizes, kept whole
    level = (limited.withColumn("n", F.row_number().over(by))
             .withColumn("left2", SHARE_PERCENT // 50 * F.sum("source_size").over(every) - 2 * F.coalesce(F.sum("most").over(before), F.lit(0)))
             .withColumn("rest", F.sum("w").over(every) - F.coalesce(F.sum("w").over(before), F.lit(0)))
             .withColumn("below", 2 * F.col("most") * F.col("rest") <= F.col("left2") * F.col("w")))
    first = level.withColumn("edge", F.min(F.when(~F.col("below"), F.col("n"))).over(every))
    at = lambda c: F.max(F.when(F.col("n") == F.col("edge"), F.col(c))).over(every)
    return (first.withColumn("top", at("left2")).withColumn("under", at("rest"))
            .select("source", "source_size", "n_rows", "least_weight",
                    F.when(F.col("edge").isNull() | (F.col("n") < F.col("edge")), F.col("most").cast("double"))
                    .otherwise((F.col("top") * F.col("w")).cast("double") / (2 * F.col("under")).cast("double")).alias("target")))


def mixed(rows: DataFrame, id_col: str = "doc_id") -> DataFrame:
    """``rows`` (with source, size, weight and digest) and source_size, target, taken."""
    goal = written(targets(rows), "targets")
    keyed = (marked(rows, id_col).withColumn("key", key(id_col, "weight"))
             .join(goal.withColumnRenamed("source", "_source"), F.col("source").eqNullSafe(F.col("_source"))).drop("_source"))
    ranges = F.greatest(F.lit(1), F.ceil(F.col("n_rows") / RANGE_ROWS))
    placed = keyed.withColumn("range", F.least(ranges - 1, F.floor(ranges * (1 - F.exp(-F.col("least_weight") * F.col("key"))))).cast("int"))
    sums = placed.groupBy("source", "range").agg(F.sum("size").alias("own"))
    upto = Window.partitionBy("source").orderBy("range").rowsBetween(Window.unboundedPreceding, -1)
    bases = sums.select(F.col("source").alias("_source"), F.col("range").alias("_range"), F.coalesce(F.sum("own").over(upto), F.lit(0)).alias("base"))
    within = Window.partitionBy("source", "range").orderBy("key", id_col, "size").rowsBetween(Window.unboundedPreceding, 0)
    running = (placed.withColumn("upto", F.sum("size").over(within))
               .join(bases, F.col("source").eqNullSafe(F.col("_source")) & (F.col("range") == F.col("_range")))
               .withColumn("upto", F.col("upto") + F.col("base")))
    epochs = F.when(F.col("source_size") > 0, F.floor(F.col("target") / F.col("source_size"))).otherwise(F.lit(0))
    more = F.col("upto") - F.col("size") / 2.0 <= F.col("target") - epochs * F.col("source_size")
    return (running.withColumn("taken", F.col("size") * (epochs + F.when(more & (epochs < MOST_EPOCHS), 1).otherwise(0)))
            .drop("digest", "mark", "key", "n_rows", "least_weight", "range", "upto", "base", "_source", "_range"))


def sized(docs: DataFrame, id_col: str = "doc_id") -> DataFrame:
    """(row, doc id, source, size, digest): ``row`` holds all columns of ``docs``."""
    return docs.select(F.struct(*[F.col(f"`{c}`") for c in docs.columns]).alias("row"), F.col(id_col).cast("long").alias("doc_id"), "source",
                       words().alias("size"), F.md5(F.coalesce("text", F.lit(""))).alias("digest"))


def with_weight(rows: DataFrame, labels: DataFrame) -> DataFrame:
    return (rows.join(quality_weights(labels), F.col("doc_id") == F.col("_label_id"), "left")
            .withColumn("weight", F.coalesce("_label_weight", F.lit(1.0))).drop("_label_id", "_label_weight"))


def weighted(docs: DataFrame, labels: DataFrame, id_col: str = "doc_id") -> DataFrame:
    """(row, doc id, source, size, digest, weight) of every document."""
    return with_weight(sized(docs, id_col), labels)


def op9_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    sizes = written(with_weight(sized(docs).drop("row"), table(spark, sf_dir, "labels")), "sizes")
    return mixed(sizes).select("doc_id", "size", "source_size", "target", "taken")


def stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Pipeline stage: each document as often as the mix takes it.  The mix works
    on sizes; the texts move once, to the places that it took."""
    rows = written(sized(docs).withColumn("place", F.monotonically_increasing_id()), "rows")
    sizes = written(with_weight(rows.drop("row"), table(spark, sf_dir, "labels")), "sizes")
    copies = F.when(F.col("size") > 0, (F.col("taken") / F.col("size")).cast("int")).otherwise(F.lit(0))
    taken = mixed(sizes).where(copies > 0).select("place", copies.alias("copies"))
    again = rows.select("row", "place").join(taken, "place").select("row", F.explode(F.sequence(F.lit(1), "copies")).alias("copy"))
    return again.select(*[F.col(f"row.`{c}`").alias(c) for c in docs.columns])


OP9_SQL = r"""
WITH q AS (SELECT doc_id, (CASE max(quality) WHEN 1 THEN 2.0::DOUBLE WHEN 0 THEN 0.5::DOUBLE ELSE 1.0::DOUBLE END)
                  * (CASE max(toxic) WHEN 1 THEN 0.25::DOUBLE ELSE 1.0::DOUBLE END) AS weight FROM labels WHERE doc_id IS NOT NULL GROUP BY doc_id),
d AS (SELECT d.doc_id, source, CAST(len(list_filter(string_split_regex(coalesce(text, ''), '[\x20\x09-\x0D]+'), lambda x: x <> '')) AS BIGINT) AS size,
      -ln((CAST('0x' || substr(md5('mix-1:' || coalesce(CAST(d.doc_id AS VARCHAR), '')), 1, 13) AS BIGINT)::DOUBLE + 0.5) / 4503599627370496.0::DOUBLE)
        / coalesce(q.weight, 1.0::DOUBLE) AS key FROM documents d LEFT JOIN q USING (doc_id)),
s AS (SELECT source, CAST(sum(size) AS BIGINT) AS source_size FROM d GROUP BY source),
w AS (SELECT *, 2 * source_size AS most, [3, 1, 2][(row_number() OVER (ORDER BY source NULLS LAST) - 1) % 3 + 1] AS w FROM s),
l AS (SELECT *, row_number() OVER o AS n, 3 * (SELECT sum(source_size) FROM s) - 2 * coalesce(sum(most) OVER (o ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS left2,
      (SELECT sum(w) FROM w) - coalesce(sum(w) OVER (o ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS rest
      FROM w WINDOW o AS (ORDER BY most::DOUBLE / w, source NULLS LAST)),
e AS (SELECT min(n) AS n FROM l WHERE 2 * most * rest > left2 * w),
t AS (SELECT source, source_size, CASE WHEN (SELECT n FROM e) IS NULL OR n < (SELECT n FROM e) THEN most::DOUBLE
      ELSE ((SELECT left2 FROM l WHERE n = (SELECT n FROM e)) * w)::DOUBLE / (2 * (SELECT rest FROM l WHERE n = (SELECT n FROM e)))::DOUBLE END AS target FROM l),
r AS (SELECT doc_id, size, source_size, target, sum(size) OVER (PARTITION BY d.source ORDER BY key, doc_id, size ROWS UNBOUNDED PRECEDING) AS upto,
      CASE WHEN source_size > 0 THEN CAST(floor(target / source_size) AS BIGINT) ELSE 0 END AS epochs FROM d JOIN t ON d.source IS NOT DISTINCT FROM t.source)
SELECT doc_id, size, source_size, target, CAST(size * (epochs + CASE WHEN upto::DOUBLE - size / 2.0::DOUBLE <= target - epochs * source_size AND epochs < 2 THEN 1 ELSE 0 END) AS BIGINT) AS taken FROM r
"""

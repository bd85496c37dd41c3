"""Quality rules (operator 6): a ledger of rule bits, native Spark throughout.

Every rule is evaluated once per document; the ledger keeps its measurements
and one failure bit per rule.  A policy is a named version with a mask of
rules, so another policy, or the effect of leaving a rule out, needs no second
look at the texts: verdicts are ``bits & mask = 0`` and ablations are counts
over the few distinct bit patterns.

Repeated words are found inside each document without a join: words are hashed
once, 8-word windows by their words' hashes (64 bits) with their places, sorted,
and neighbours compared; the
covered words are the sum of min(8, gap to the next repeated window).

Edge cases: a null text has no words, lines or symbols; a text without words
fails ``few_words``; repeated rows get equal results, each its own row; a null
doc_id is kept as it is; extra columns are not read; an empty table gives an
empty ledger.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from gridstream.llm.common import SPACES, table

WINDOW = 8
SYMBOLS = "#*$%&|<>"
UPPER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ"
SPLIT = "[\\x20\\x09-\\x0D]+"

#: Rules in the order of their bits: name and the condition under which a document fails.
RULES: list[tuple[str, str]] = [
    ("few_words", "n_words < 20"),
    ("repeated_words", "100 * n_repeat_words > 30 * n_words"),
    ("symbols", "n_symbols > n_words"),
    ("duplicate_lines", "100 * n_dup_lines > 50 * n_lines"),
    ("short_words", "word_chars < 2 * n_words"),
    ("long_words", "word_chars > 20 * n_words"),
    ("shouting", "n_words > 0 and 100 * n_upper > 50 * word_chars"),
]
BIT = {name: 1 << i for i, (name, _) in enumerate(RULES)}
BASE = ("few_words", "repeated_words")
#: Versions of the verdict: the rules that each applies.
POLICIES: dict[str, tuple[str, ...]] = {
    "v1": (*BASE, "symbols"),
    "v2": (*BASE, "symbols", "duplicate_lines", "short_words", "long_words"),
    "v3": tuple(BIT),
}
CURRENT = "v3"


def mask_of(policy: str) -> int:
    return reduce(int.__or__, (BIT[r] for r in POLICIES[policy]))


def without(text: Column, characters: str) -> Column:
    return F.translate(text, characters, "")


def _repeat_words(windows: str) -> Column:
    """Words inside windows that occur twice or more, from the sorted windows."""
    s = F.col(windows)
    twin = F.filter(s, lambda x, i: (F.get(s, i - 1)["h"] == x["h"]) | (F.get(s, i + 1)["h"] == x["h"]))
    return F.sort_array(F.transform(twin, lambda x: x["p"]))


def measured(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """doc_id and the measurements that the rules read."""
    text = docs.select(F.col(id_col).alias("doc_id"), F.coalesce(text_col, F.lit("")).alias("text"))
    lines = F.filter(F.split("text", "\n"), lambda x: without(x, SPACES) != "")
    parts = text.select(
        "doc_id", F.filter(F.split("text", SPLIT), lambda w: w != "").alias("words"), lines.alias("lines"),
        F.length(without(F.col("text"), SPACES)).cast("long").alias("word_chars"),
        (F.length("text") - F.length(without(F.col("text"), SYMBOLS))).cast("long").alias("n_symbols"),
        (F.length("text") - F.length(without(F.col("text"), UPPER))).cast("long").alias("n_upper"))
    # Each word is hashed once; a window's hash is that of its words' hashes.
    coded = parts.select("*", F.transform("words", lambda w: F.xxhash64(w)).alias("codes"))
    hashed = coded.select(
        "*", F.when(F.size("words") >= WINDOW, F.transform(
            F.sequence(F.lit(0), F.size("words") - WINDOW), lambda i: F.xxhash64(*[F.get("codes", i + k) for k in range(WINDOW)])))
        .otherwise(F.array().cast("array<bigint>")).alias("hashes"))
    # Most documents repeat no window: only the others sort theirs with the places.
    placed = hashed.select(
        "*", F.when(F.size(F.array_distinct("hashes")) < F.size("hashes"), F.sort_array(F.transform(
            "hashes", lambda h, p: F.struct(h.alias("h"), p.alias("p"))))).alias("windows"))
    repeated = placed.select("*", F.when(F.col("windows").isNotNull(), _repeat_words("windows")).alias("places"))
    covered = F.aggregate(
        F.transform("places", lambda p, i: F.least(F.lit(WINDOW), F.coalesce(F.get("places", i + 1) - p, F.lit(WINDOW)))),
        F.lit(0).cast("long"), lambda a, x: a + x)
    return repeated.select(
        "doc_id", F.size("words").cast("long").alias("n_words"), "word_chars", "n_symbols",
        (F.size("lines") - F.size(F.array_distinct("lines"))).cast("long").alias("n_dup_lines"),
        F.coalesce(covered, F.lit(0)).cast("long").alias("n_repeat_words"),
        F.size("lines").cast("long").alias("n_lines"), "n_upper")


def ledger(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """The measurements and ``fail_bits``, every rule evaluated once."""
    bits = reduce(lambda a, b: a.bitwiseOR(b), (F.when(F.expr(test), F.lit(BIT[name])).otherwise(F.lit(0)) for name, test in RULES))
    return measured(docs, id_col, text_col).withColumn("fail_bits", bits)


def fails(policy: str) -> Column:
    return F.col("fail_bits").bitwiseAND(F.lit(mask_of(policy))) != 0


def ablations(book: DataFrame) -> DataFrame:
    """For each policy and rule: documents that fail the rule, that fail it
    alone (a policy without it would keep them), and that the policy keeps.
    The ledger is first counted by bit pattern, at most 2**rules rows."""
    patterns = book.groupBy("fail_bits").agg(F.count("*").alias("n"))
    plan = F.explode(F.array(*[F.struct(F.lit(p).alias("policy"), F.lit(r).alias("rule"), F.lit(BIT[r]).alias("bit"), F.lit(mask_of(p)).alias("mask"))
                               for p in POLICIES for r in POLICIES[p]])).alias("x")
    rows = patterns.select("fail_bits", "n", plan).select("fail_bits", "n", "x.*")
    hit = F.col("fail_bits").bitwiseAND(F.col("mask"))
    return rows.groupBy("policy", "rule").agg(
        F.sum(F.when(hit.bitwiseAND(F.col("bit")) != 0, F.col("n")).otherwise(0)).alias("n_failed"),
        F.sum(F.when(hit == F.col("bit"), F.col("n")).otherwise(0)).alias("n_alone"),
        F.sum(F.when(hit == 0, F.col("n")).otherwise(0)).alias("n_kept"))


def op6_quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    book = ledger(table(spark, sf_dir, "documents"))
    base = F.col("fail_bits").bitwiseAND(F.lit(BIT["few_words"] | BIT["repeated_words"])) != 0
    return book.select("doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words",
                       base.alias("base_failed"), (~base & ~fails(CURRENT)).alias("kept"), "fail_bits")


OP6_SQL = r"""
WITH w AS (SELECT doc_id, coalesce(text, '') AS text,
    list_filter(string_split_regex(coalesce(text, ''), '[\x20\x09-\x0D]+'), lambda x: x <> '') AS words,
    list_filter(string_split(coalesce(text, ''), chr(10)), lambda x: regexp_matches(x, '[^\x20\x09-\x0D]')) AS lines FROM documents),
g AS (SELECT doc_id, unnest(range(len(words) - 7)) AS p, words FROM w WHERE len(words) >= 8),
h AS (SELECT doc_id, p, list_slice(words, p + 1, p + 8) AS k FROM g),
d AS (SELECT doc_id, p, count(*) OVER (PARTITION BY doc_id, k) AS n FROM h),
c AS (SELECT doc_id, least(8, coalesce(lead(p) OVER (PARTITION BY doc_id ORDER BY p) - p, 8)) AS gap FROM d WHERE n > 1),
r AS (SELECT doc_id, CAST(sum(gap) AS BIGINT) AS n_repeat_words FROM c GROUP BY doc_id),
m AS (SELECT doc_id, CAST(len(words) AS BIGINT) AS n_words, CAST(length(regexp_replace(text, '[\x20\x09-\x0D]', '', 'g')) AS BIGINT) AS word_chars,
    CAST(length(regexp_replace(text, '[^#*$%&|<>]', '', 'g')) AS BIGINT) AS n_symbols,
    CAST(len(lines) - len(list_distinct(lines)) AS BIGINT) AS n_dup_lines, coalesce(n_repeat_words, 0) AS n_repeat_words,
    len(lines) AS n_lines, length(regexp_replace(text, '[^A-Z]', '', 'g')) AS n_upper
    FROM w LEFT JOIN r USING (doc_id)),
b AS (SELECT *, (CASE WHEN n_words < 20 THEN 1 ELSE 0 END) | (CASE WHEN 100 * n_repeat_words > 30 * n_words THEN 2 ELSE 0 END)
    | (CASE WHEN n_symbols > n_words THEN 4 ELSE 0 END) | (CASE WHEN 100 * n_dup_lines > 50 * n_lines THEN 8 ELSE 0 END)
    | (CASE WHEN word_chars < 2 * n_words THEN 16 ELSE 0 END) | (CASE WHEN word_chars > 20 * n_words THEN 32 ELSE 0 END)
    | (CASE WHEN n_words > 0 AND 100 * n_upper > 50 * word_chars THEN 64 ELSE 0 END) AS fail_bits FROM m)
SELECT doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, (fail_bits & 3) <> 0 AS base_failed,
    fail_bits = 0 AS kept, CAST(fail_bits AS INTEGER) AS fail_bits FROM b
"""

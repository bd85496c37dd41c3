"""Fixtures of the training-data tests: awkward rows, and brute-force words."""

import random
import re

from pyspark.sql import types as T

WORD = re.compile(r"[^\x20\x09-\x0D]+")
CLASHING = ["bucket", "key", "size", "weight", "target", "taken", "row", "rank", "_id", "_key", "_rest", "starts", "flags", "class_doc", "items"]
DOCS = T.StructType([T.StructField("doc_id", T.LongType()), T.StructField("text", T.StringType()), T.StructField("lang", T.StringType()),
                     T.StructField("source", T.StringType()), T.StructField("n_chars", T.LongType())]
                    + [T.StructField(c, T.StringType()) for c in CLASHING])


def words(text):
    return WORD.findall(text or "")


def prose(seed, n, vocabulary=400):
    r = random.Random(seed)
    return " ".join(f"w{r.randrange(vocabulary)}" for _ in range(n))


def awkward_texts():
    """(doc_id, text): nulls, empties, repeats, ties, near copies, shared passages, a long text."""
    base = prose(1, 300)
    near = base.split()
    near[150] = "changed"
    passage = prose(2, 60)
    rows = [(1, None), (2, ""), (3, " \t\n\x0b\f\r "), (4, "one"), (5, "one two three four"), (5, "one two three four"),
            (6, base), (7, base), (8, " ".join(near)), (9, base.replace(" ", "\n")), (None, "an id is missing here"),
            (10, prose(3, 40) + " " + passage + " " + prose(4, 40)), (11, prose(5, 30) + "\n" + passage + "\n" + prose(6, 30)),
            (12, "echo " * 200), (13, "echo " * 200), (14, prose(7, 30000, 5000)), (15, "é ñ ß 日本 \u2581 🙂 \u200b\x00\x85 <|x|> </s>"),
            (16, "12 34 -- ..."), (-17, prose(8, 100)), (18, "line\nline\nline\n\nother"), (19, "x" * 100000), (20, base + " " + base)]
    return rows


def documents(spark, rows=None):
    rows = awkward_texts() if rows is None else rows
    langs, sources = ["en", "de", None], ["b", "a", None, "ä"]
    full = [(i, t, langs[k % 3], sources[k % 4], len(t or ""), *[c + "!" for c in CLASHING]) for k, (i, t) in enumerate(rows)]
    return spark.createDataFrame(full, DOCS).repartition(3)

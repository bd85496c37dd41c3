"""MinHash near-dedup (operator 8): BagMinHash signatures of word shingles.

A text is the multiset of its 5-word shingles.  Each shingle owns Poisson
processes over discretised weights: level 0 covers the weight [0, 1), level j
the weights [2**(j-1), 2**j).  Points of a level arrive at rate
m * (width of the level), each falls on one of m signature positions and on
one unit of weight inside the level, and counts only if that unit is below the
shingle's multiplicity.  A position keeps its first point, so two texts agree
in a position with probability sum(min) / sum(max) of the multiplicities, the
weighted Jaccard similarity.  Points are drawn only up to a time by which all
positions of the text are most likely taken (drawn further where they are
not), so a text of n shingles costs about n + m log m draws, not n * m.

Bands of the signature give candidates, and candidates are verified exactly on
the texts.  Buckets are never expanded to all their pairs: equal texts are one
node; each bucket is compared with one pivot (its member of most shared
buckets); links join classes; what stays in another class meets a second pivot.
The texts of buckets that still hold several classes are joined by a prefix
filter: with shingles in one global order, the rarer the earlier, two texts of
similarity t overlap in t / (1 + t) * (|x| + |y|) shingles at least, so they share
one among the first |x| - overlap + 1 of either, at places that leave room for
that overlap.  So no link between candidates is lost, and a text far from all
others, whose first shingles nobody has, meets none of a large group.

The node is the distinct text, named by its digest; nodes are linked by
verified similarity only.  The pipeline stage keeps one row of each class of
texts, whatever the ids: texts that share an id are not joined, and rows without
id meet the others.  op8 reports documents: a doc_id on rows of several texts is
one document, whose texts' classes are joined in the report.

Edge cases: texts without words (null, empty, white space) are a class of
their own each; texts of 1 to 4 words are one shingle of all their words;
a null doc_id links nothing in op8's report and has the classes of an equal
text there, else null; repeated rows get equal results; other columns pass
through in the stage; an empty table gives an empty result.
"""

from __future__ import annotations

from collections import OrderedDict
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from gridstream.llm.common import in_batches, mix, slices, table, words_of, written
from gridstream.llm.components import components

SHINGLE = 5
SIMILAR = 0.8
BANDS, ROWS = 20, 4                # a link at 0.8 is missed with probability 3e-5
COUNTERS = 1 << 18                 # cells that order the shingles, 2 MB


def shingles(texts: pa.Array, length: int = SHINGLE) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Multisets of all texts: (text, shingle hash, multiplicity), by text."""
    words = words_of(texts)
    h, n = words.hashes, np.diff(words.first)
    counts = np.where(n >= length, n - length + 1, (n > 0).astype(n.dtype))
    text = np.repeat(np.arange(n.size), counts)
    start = words.first[:-1][text] + np.arange(text.size) - (np.cumsum(counts) - counts)[text]
    end = words.first[1:][text]
    total = np.zeros(text.size, np.uint64)
    for k in range(length):
        at = start + k
        there = at < end
        part = mix(h[np.minimum(at, max(h.size - 1, 0))], 11 + k) if h.size else total
        total += np.where(there, part, np.uint64(0))
    shingle = mix(total, 3)
    own = mix(shingle ^ mix(text.astype(np.uint64), 5), 7)      # equal only for equal text and shingle
    _, at, many = np.unique(own, return_index=True, return_counts=True)
    order = np.argsort(text[at], kind="stable")
    at = at[order]
    return text[at], shingle[at], many[order]


def _uniform(x: np.ndarray) -> np.ndarray:
    """(0, 1] from 64 random bits."""
    return ((x >> np.uint64(11)).astype(np.float64) + 1.0) * (1.0 / (1 << 53))


def bag_minhash(text: np.ndarray, element: np.ndarray, weight: np.ndarray, n_texts: int, m: int) -> np.ndarray:
    """Signatures (n_texts x m arrival times); inf throughout for an empty text."""
    out = np.full(n_texts * m, np.inf)
    mass = np.bincount(text, weights=weight, minlength=n_texts)
    limit = np.where(mass > 0, (np.log(m) + 3.0) / np.maximum(mass, 1), 0.0)
    todo = np.arange(text.size)
    while todo.size:
        _draw(out, text[todo], element[todo], weight[todo], limit, m)
        late = (out.reshape(n_texts, m).max(axis=1) > limit) & (mass > 0)
        limit = np.where(late, limit * 1.7, limit)
        todo = todo[late[text[todo]]]
    return out.reshape(n_texts, m)


def _draw(out: np.ndarray, text, element, weight, limit: np.ndarray, m: int) -> None:
    """All points up to each text's time limit, level by level."""
    top = int(weight.max()).bit_length() if weight.size else 0
    for level in range(top + 1):
        low = 0 if level == 0 else 1 << (level - 1)
        width = max(low, 1)
        own = np.flatnonzero(weight > low)
        if not own.size:
            break
        seed = mix(element[own], 101 + level)
        until = limit[text[own]]
        clock = np.zeros(own.size)
        step, block = 0, 1
        while own.size:
            salt = (np.arange(step + 1, step + block + 1, dtype=np.uint64) * np.uint64(0xA24BAED4963EE407))[None, :]
            bits = mix(seed[:, None] ^ salt, 17)
            times = clock[:, None] + np.cumsum(-np.log(_uniform(bits)), axis=1) / (m * width)
            i, j = np.nonzero(times <= until[:, None])
            if i.size:
                where = mix(bits[i, j], 23)
                unit = low + (where >> np.uint64(32)) % np.uint64(width)
                counts = unit < weight[own[i]]
                place = text[own[i]] * m + ((where & np.uint64(0xFFFFFFFF)) * np.uint64(m) >> np.uint64(32)).astype(np.int64)
                np.minimum.at(out, place[counts], times[i, j][counts])
            on = times[:, -1] <= until
            own, seed, until, clock = own[on], seed[on], until[on], times[on, -1]
            step += block
            block = min(block * 2, 64)


SIGNED = T.StructType([T.StructField("doc", T.LongType()), T.StructField("same", T.BinaryType()),
                       T.StructField("bands", T.ArrayType(T.LongType()))])


def _sign(bands: int, rows: int, length: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part in slices(batches):
            text, element, weight = shingles(part["text"], length)
            n = part.num_rows
            seen = np.bincount(text, minlength=n) > 0
            sig = bag_minhash(text, element, weight, n, bands * rows)
            key = sig.view(np.uint64).reshape(n, bands, rows)
            band = np.tile(mix(np.arange(bands, dtype=np.uint64), 31), (n, 1))
            for r in range(rows):
                band = mix(band ^ key[:, :, r], 37)
            offsets = np.concatenate(([0], np.cumsum(np.where(seen, bands, 0)))).astype(np.int32)
            lists = pa.ListArray.from_arrays(pa.array(offsets), pa.array(band[seen].reshape(-1).view(np.int64)))
            yield pa.RecordBatch.from_arrays([part["doc"].combine_chunks(), part["same"].combine_chunks(), lists],
                                             ["doc", "same", "bands"])
    return run


def _bags(texts: pa.Array, length: int) -> list[tuple[np.ndarray, np.ndarray]]:
    """The multiset of each text: sorted shingles and their multiplicities."""
    text, element, weight = shingles(texts, length)
    order = np.lexsort((element, text))
    text, element, weight = text[order], element[order], weight[order]
    cut = np.searchsorted(text, np.arange(len(texts) + 1))
    return [(element[i:j], weight[i:j]) for i, j in zip(cut[:-1], cut[1:])]


def similarity(a: tuple[np.ndarray, np.ndarray], b: tuple[np.ndarray, np.ndarray]) -> float:
    """Weighted Jaccard similarity of two multisets (sorted elements, weights)."""
    _, i, j = np.intersect1d(a[0], b[0], assume_unique=True, return_indices=True)
    least = int(np.minimum(a[1][i], b[1][j]).sum())
    most = int(a[1].sum() + b[1].sum()) - least
    return least / most if most else 0.0


def _compare(length: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        pivots: OrderedDict = OrderedDict()        # a few multisets, as many rows share a pivot

        def pivot(text) -> tuple:
            raw = text.as_py()
            if raw not in pivots:
                pivots[raw] = _bags(pa.array([raw]), length)[0]
                if len(pivots) > 64:
                    pivots.popitem(last=False)
            return pivots[raw]

        for part in slices(batches, "x"):
            own = _bags(part["x"], length)
            scores = [similarity(a, pivot(y)) for a, y in zip(own, part["y"])]
            yield pa.RecordBatch.from_arrays([part["doc"].combine_chunks(), part["pivot"].combine_chunks(),
                                              pa.array(scores, pa.float64())], ["doc", "pivot", "similarity"])
    return run


def verified(pairs: DataFrame, texts: DataFrame, length: int = SHINGLE) -> DataFrame:
    """Exact similarities of (doc, pivot) pairs, from whole texts."""
    both = (pairs.join(texts.select(F.col("doc"), F.col("text").alias("x")), "doc")
            .join(texts.select(F.col("doc").alias("pivot"), F.col("text").alias("y")), "pivot")
            .select("doc", "pivot", "x", "y"))
    return (in_batches(both, _compare(length), "doc long, pivot long, similarity double")
            .groupBy("doc", "pivot").agg(F.max("similarity").alias("similarity")))


def _unresolved(members: DataFrame, classes: DataFrame) -> DataFrame:
    """Members with their class, of buckets that hold several classes."""
    named = (members.join(classes.withColumnRenamed("node", "doc"), "doc", "left")
             .withColumn("root", F.coalesce("root", "doc")))
    open_ = named.groupBy("bucket").agg(F.min("root").alias("_a"), F.max("root").alias("_b")).where("_a < _b").select("bucket")
    return named.join(open_, "bucket")


def tokens(texts: pa.Array, length: int) -> tuple[np.ndarray, np.ndarray]:
    """(text, token): the multisets as sets, each repetition of a shingle a token of its own."""
    text, element, weight = shingles(texts, length)
    nth = np.arange(int(weight.sum())) - np.repeat(np.cumsum(weight) - weight, weight)
    return np.repeat(text, weight), mix(np.repeat(element, weight) ^ mix(nth.astype(np.uint64), 41), 43)


def _counted(length: int):
    """Token counts of a task in COUNTERS cells, in blocks."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros(COUNTERS, np.int64)
        for part in slices(batches):
            total += np.bincount(_cell(tokens(part["text"], length)[1]), minlength=COUNTERS)
        blocks = total.reshape(16, -1)
        yield pa.RecordBatch.from_arrays([pa.array(range(16), pa.int32()), pa.array([b.tobytes() for b in blocks], pa.binary())], ["block", "counts"])
    return run


def _cell(token: np.ndarray) -> np.ndarray:
    return (token % np.uint64(COUNTERS)).astype(np.int64)


def _summed(rows: pa.Table) -> pa.Table:
    total = sum(np.frombuffer(c, np.int64) for c in rows["counts"].to_pylist())
    return pa.table({"block": rows["block"].slice(0, 1), "counts": [total.tobytes()]})


def _prefixes(counts: np.ndarray, length: int, similar: float):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part in slices(batches):
            text, token = tokens(part["text"], length)
            size = np.bincount(text, minlength=part.num_rows)
            share = similar / (1 + similar)
            reach = lambda other: size - np.ceil(share * (size + other) - 1e-9).astype(np.int64) + 1
            as_long, as_short = reach(np.maximum(part["least"].to_numpy(), similar * size)), reach(size)
            order = np.lexsort((token, counts[_cell(token)], text))
            place = np.arange(text.size) - (np.cumsum(size) - size)[text]
            take = place < as_long[text]
            own, place = text[take], place[take]
            yield pa.RecordBatch.from_arrays([pa.array(token[order][take].view(np.int64)), pa.array(part["doc"].to_numpy()[own]),
                                              pa.array(part["root"].to_numpy()[own]), pa.array(size[own], pa.int64()),
                                              pa.array(place, pa.int64()), pa.array(place < as_short[own])],
                                             ["token", "doc", "root", "size", "place", "short"])
    return run


def _sizes(length: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part in slices(batches):
            n = np.diff(words_of(part["text"]).first)
            size = np.where(n >= length, n - length + 1, (n > 0).astype(n.dtype))
            yield pa.RecordBatch.from_arrays([part["doc"].combine_chunks(), pa.array(size, pa.int64())], ["doc", "size"])
    return run


def prefix_pairs(left: DataFrame, texts: DataFrame, length: int, similar: float) -> DataFrame:
    """(doc, pivot) of different classes that may be similar, among the members
    of open buckets (bucket, doc, root), by the prefix filter.

    The order of shingles comes from COUNTERS counts (a bounded array, the only
    thing that tasks get from the driver); any order gives the same links, a
    good one fewer pairs.  The least size of a text's fellow members bounds |y|.
    """
    own = written(texts.join(left.select("doc", "root").distinct(), "doc"), "open-texts")
    blocks = in_batches(own.select("text"), _counted(length), "block int, counts binary").groupBy("block").applyInArrow(
        _summed, "block int, counts binary").orderBy("block").collect()
    counts = np.concatenate([np.frombuffer(r.counts, np.int64) for r in blocks]) if blocks else np.zeros(COUNTERS, np.int64)
    sizes = in_batches(own.select("doc", "text"), _sizes(length), "doc long, size long")
    placed = left.select("bucket", "doc").join(sizes, "doc")
    lows = placed.groupBy("bucket").agg(F.min("size").alias("low"))
    least = placed.select("bucket", "doc").join(lows, "bucket").groupBy("doc").agg(F.min("low").alias("least"))
    found = written(in_batches(own.join(least, "doc").select("doc", "root", "least", "text"),
        _prefixes(counts, length, similar), "token long, doc long, root long, size long, place long, short boolean"), "prefixes")
    shared = found.groupBy("token").agg(F.min("root").alias("_a"), F.max("root").alias("_b")).where("_a < _b").select("token")
    some = found.join(shared, "token")
    a, b = some.where("short").alias("a"), some.alias("b")        # a is the shorter text of a pair
    room = F.least(F.expr("a.size - a.place"), F.expr("b.size - b.place")) * (1 + similar)
    return (a.join(b, F.col("a.token") == F.col("b.token"))
            .where((F.col("a.root") != F.col("b.root")) & (F.col("a.size") <= F.col("b.size"))
                   & (room >= similar * (F.col("a.size") + F.col("b.size")) - 1e-6))
            .select(F.greatest("a.doc", "b.doc").alias("doc"), F.least("a.doc", "b.doc").alias("pivot")).distinct())


def digest(text_col: str) -> Column:
    """Name of a text (hex of 16 bytes); null for a null text."""
    return F.substring(F.sha2(F.col(f"`{text_col}`").cast("binary"), 256), 1, 32)


def has_words(text_col: str) -> Column:
    return F.coalesce(F.col(f"`{text_col}`").rlike(r"[^\x20\x09-\x0D]"), F.lit(False))


def signatures(docs: DataFrame, id_col: str, text_col: str, length: int, bands: int, rows: int) -> tuple[DataFrame, DataFrame]:
    """Rows (doc, text, same), where ``same`` names a text with words, and their signatures."""
    own = docs.select(F.col(id_col).cast("long").alias("doc"), F.col(text_col).alias("text"),
                      F.when(has_words(text_col), F.unhex(digest(text_col))).alias("same"))
    return own, written(in_batches(own, _sign(bands, rows, length), SIGNED), "signatures")


def text_classes(own: DataFrame, signed: DataFrame, length: int = SHINGLE, similar: float = SIMILAR) -> DataFrame:
    """(same, text_doc, root) of every text with words in ``signed``: its least
    doc_id (null where all its rows lack one) and its class, a number of this run."""
    known = written(signed.where("same is not null").groupBy("same").agg(F.min("doc").alias("text_doc"), F.first("bands").alias("bands"))
                    .withColumn("doc", F.monotonically_increasing_id()), "nodes")
    nodes = known.select("doc", F.explode(F.array_distinct("bands")).alias("bucket"))
    # Buckets with several texts; the pivot of a bucket is the member of most shared buckets.
    shared = nodes.groupBy("bucket").agg(F.count("*").alias("n")).where("n > 1")
    members = written(nodes.join(shared, "bucket"), "members")
    degree = members.groupBy("doc").agg(F.sum("n").alias("degree"))
    members = written(members.select("bucket", "doc").join(degree, "doc"), "members")
    wanted = known.select("same", "doc").join(degree.select("doc"), "doc")
    texts = written(own.where("same is not null").groupBy("same").agg(F.first("text").alias("text"))
                    .join(wanted, "same").select("doc", "text"), "texts")
    left, links = members, None
    for turn in ("one", "two"):
        pivots = left.groupBy("bucket").agg(F.max(F.struct("degree", -F.col("doc"))).alias("p")).select(
            "bucket", (-F.col("p.col2")).alias("pivot"))
        met = left.join(pivots, "bucket").where("doc <> pivot").select("doc", "pivot").distinct()
        new = written(verified(met, texts, length).where(F.col("similarity") >= similar), f"pivot-{turn}")
        links = links.union(new) if links else new
        classes = written(components(links.select(F.col("doc").alias("a"), F.col("pivot").alias("b"))), "classes")
        left = written(_unresolved(members, classes), "open")
        if turn == "one":
            # the next pivot of a bucket comes from outside the first pivot's class
            first = pivots.join(classes.select(F.col("node").alias("pivot"), F.col("root").alias("at")), "pivot", "left")
            left = left.join(first.select("bucket", F.coalesce("at", "pivot").alias("at")), "bucket").withColumn(
                "degree", F.when(F.col("root") == F.col("at"), F.lit(-1)).otherwise(F.col("degree")))
    more = verified(prefix_pairs(left, texts, length, similar), texts, length).where(F.col("similarity") >= similar)
    more = written(more, "links")
    if more.limit(1).count():
        classes = written(components(links.union(more).select(F.col("doc").alias("a"), F.col("pivot").alias("b"))), "classes")
    return (known.select("same", "text_doc", "doc").join(classes.select(F.col("node").alias("doc"), "root"), "doc", "left")
            .select("same", "text_doc", F.coalesce("root", "doc").alias("root")))


def near_duplicates(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", length: int = SHINGLE,
                    similar: float = SIMILAR, bands: int = BANDS, rows: int = ROWS) -> DataFrame:
    """(doc, text_doc, class_doc) of every document: the least doc_id with the
    same text, and the least doc_id of its near-duplicate class."""
    own, signed = signatures(docs, id_col, text_col, length, bands, rows)
    found = text_classes(own.where("doc is not null"), signed.where("doc is not null"), length, similar)
    least = found.groupBy("root").agg(F.min("text_doc").alias("class_doc"))
    named = written(signed.select("doc", "same").join(found.join(least, "root").drop("root"), "same", "left").select(
        "doc", F.coalesce("text_doc", "doc").alias("text_doc"), F.coalesce("class_doc", "doc").alias("class_doc")), "named")
    # A doc_id on rows of several texts is one document: its texts' classes are joined.
    several = named.groupBy("doc").agg(F.min("class_doc").alias("a"), F.max("class_doc").alias("_b")).where("doc is not null and a < _b")
    bridges = named.join(several.select("doc", "a"), "doc").where("class_doc <> a").select("a", F.col("class_doc").alias("b"))
    joined = components(bridges).select(F.col("node").alias("class_doc"), "root")
    return named.join(joined, "class_doc", "left").select("doc", "text_doc", F.coalesce("root", "class_doc").alias("class_doc"))


def op8_near_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One row per document: its text's first document and its class id."""
    out = near_duplicates(table(spark, sf_dir, "documents"))
    return out.select(F.col("doc").alias("doc_id"), F.col("text_doc").alias("text_id"), F.col("class_doc").alias("class_id"))


def stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Pipeline stage: of each class of texts one row stays, that of the least id
    (a row without id where the class has none, the least digest among texts of
    one id); a text without words stays once for each id."""
    own, signed = signatures(docs, "doc_id", "text", SHINGLE, BANDS, ROWS)
    place = lambda name, doc: F.concat(F.coalesce(name, F.lit("")), F.lit(":"), F.coalesce(doc.cast("string"), F.lit("")))
    least = text_classes(own, signed).groupBy("root").agg(F.min(F.struct(F.col("text_doc").isNull(), "text_doc", "same")).alias("_k"))
    keep = least.select(place(F.lower(F.hex("_k.same")), F.col("_k.text_doc")).alias("_at"), F.lit(True).alias("_keep"))
    row = F.struct(*[F.col(f"`{c}`") for c in docs.columns])
    once = (docs.select(place(digest("text"), F.col("doc_id").cast("long")).alias("_at"), has_words("text").alias("_words"), row.alias("_row"))
            .groupBy("_at").agg(F.first("_words").alias("_words"), F.first("_row").alias("_row")))
    return (once.join(keep, "_at", "left").where("_keep or not _words")
            .select(*[F.col(f"_row.`{c}`").alias(c) for c in docs.columns]))


OP8_SQL = r"""
WITH RECURSIVE w AS (SELECT doc_id, text, list_filter(string_split_regex(coalesce(text, ''), '[\x20\x09-\x0D]+'), lambda x: x <> '') AS words FROM documents),
s AS (SELECT doc_id, unnest(CASE WHEN len(words) >= 5 THEN list_transform(range(1, len(words) - 3), lambda i: array_to_string(list_slice(words, i, i + 4), ' '))
                            WHEN len(words) > 0 THEN [array_to_string(words, ' ')] ELSE [] END) AS key FROM w),
n AS (SELECT doc_id, key, count(*) AS n FROM s GROUP BY ALL),
t AS (SELECT doc_id, sum(n) AS total FROM n GROUP BY doc_id),
p AS (SELECT a.doc_id AS a, b.doc_id AS b, sum(least(a.n, b.n)) AS least FROM n a JOIN n b ON a.key = b.key AND a.doc_id <> b.doc_id GROUP BY ALL),
l AS (SELECT a, b FROM p JOIN t x ON x.doc_id = a JOIN t y ON y.doc_id = b WHERE least >= 0.8 * (x.total + y.total - least)),
r(a, b) AS (SELECT a, b FROM l UNION SELECT r.a, l.b FROM r JOIN l ON r.b = l.a),
c AS (SELECT a AS doc_id, min(b) AS least FROM r GROUP BY a),
e AS (SELECT text, min(doc_id) AS text_id FROM w WHERE len(words) > 0 GROUP BY text)
SELECT doc_id, coalesce(text_id, doc_id) AS text_id, coalesce(least(c.least, doc_id), doc_id) AS class_id
FROM w LEFT JOIN e USING (text) LEFT JOIN c USING (doc_id)
"""

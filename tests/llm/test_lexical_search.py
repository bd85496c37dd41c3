"""Ranked lexical search against a plain loop over all documents."""

import math
import random
import re
from collections import Counter

import numpy as np
import pyarrow as pa
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from gridstream.llm import lexical_search as L

from helpers import DOCS, awkward_texts, documents, prose

TERM = re.compile(r"[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+")


def terms(text):
    return [re.sub("[A-Z]", lambda m: m[0].lower(), t) for t in TERM.findall(text or "")]


def brute(docs, items, k=20):
    own = [(d, Counter(terms(t)), len(terms(t))) for d, t in docs]
    own = [x for x in own if x[2]]
    n_docs, n_terms = len(own), sum(x[2] for x in own)
    df = Counter(t for _, c, _ in own for t in c)
    out = []
    for item, text in items:
        scores = []
        for doc, c, n in own:
            m = 100 - 25 + 25 * n * n_docs // n_terms
            s = sum(math.floor(1000 * math.log((2 * n_docs + 2) / (2 * df[t] + 1))) * (1000000000 * c[t] // (1000 * c[t] + 12 * m))
                    for t in terms(text) if c[t])
            if s:
                scores.append((-s, doc is not None, doc))
        out += [(item, r + 1, doc, -s) for r, (s, _, doc) in enumerate(sorted(scores)[:k])]
    return Counter(out)


def items_of(spark, rows):
    return spark.createDataFrame([(i, t, "x", "y") for i, t in rows], "item_id long, text string, item string, copies string").repartition(2)


def got(df):
    return Counter((r.item_id, r["rank"], r.doc_id, r.score) for r in df.collect())


@settings(max_examples=300, deadline=None)
@given(st.lists(st.one_of(st.none(), st.text(alphabet=st.sampled_from("aZ9 é日\x00\x85\xa0-\n_`{"), max_size=20)), max_size=5))
def test_terms(texts):
    flat, to = L.split_terms(pa.array(texts, pa.string()))
    flat = flat.to_pylist()
    assert [flat[a:b] for a, b in zip(to[:-1], to[1:])] == [terms(t) for t in texts]


@pytest.mark.parametrize("width", [1, 8, 9, 64, 65, 200])
def test_masks(width):
    r = np.random.default_rng(width)
    present = r.random((width, 300)) < 0.02 * r.integers(1, 20)
    distinct, group = L.masks(present)
    assert np.array_equal(distinct[:, group], present)
    assert len({tuple(c) for c in present.T}) == distinct.shape[1]


def test_awkward_rows(spark):
    docs = awkward_texts() + [(30, "Apple apple PEAR"), (31, "apple pear"), (31, "apple pear"), (None, "apple pear"), (29, "apple pear")]
    items = [(1, "apple pear"), (1, "apple pear"), (2, "apple apple unheard"), (3, None), (4, ""), (None, "one two"), (5, "echo w1 w2 W3 é 日本"),
             (6, prose(1, 300)), (7, " ".join(f"w{i}" for i in range(400)))]
    assert got(L.ranked_search(documents(spark, docs), items_of(spark, items))) == brute(docs, items)


@pytest.mark.parametrize("block_bytes,k", [(1 << 20, 20), (50, 3)])
def test_many_documents(spark, block_bytes, k, monkeypatch):
    r = random.Random(5)
    docs = [(r.choice([i, i // 2]), " ".join(f"w{int(r.paretovariate(0.7)) % 300}" for _ in range(r.randrange(1, 60)))) for i in range(1500)]
    items = [(i, " ".join(f"w{int(r.paretovariate(0.5)) % 300}" for _ in range(r.randrange(1, 12)))) for i in range(12)]
    assert got(L.ranked_search(documents(spark, docs), items_of(spark, items), k, block_bytes)) == brute(docs, items, k)


def test_small_blocks_of_documents(spark):
    """The running threshold of a task leaves nothing out."""
    r = random.Random(9)
    docs = [(i, " ".join(f"w{r.randrange(40)}" for _ in range(r.randrange(1, 30)))) for i in range(400)]
    texts = [" ".join(f"w{r.randrange(40)}" for _ in range(8)) for _ in range(6)]
    own = [(Counter(terms(t)), len(terms(t))) for _, t in docs]
    vocabulary = sorted({t for c, _ in own for t in c})
    n_docs, n_terms = len(own), sum(n for _, n in own)
    for text in texts:
        df = Counter(t for c, _ in own for t in c)
        query = [(vocabulary.index(t), math.floor(1000 * math.log((2 * n_docs + 2) / (2 * df[t] + 1))) * n) for t, n in Counter(terms(text)).items()]
        best = np.zeros(0, np.int64), np.zeros(0, np.int64)
        for at in range(0, 400, 16):
            part = own[at:at + 16]
            cells = [(j, vocabulary.index(t), x) for j, (c, _) in enumerate(part) for t, x in c.items()]
            doc, term, tf = (np.array(x) for x in zip(*cells))
            block = L.Postings(np.array([n for _, n in part]), doc, term, tf, n_docs, n_terms)
            best = L.best_in_block(block, np.arange(at, at + 16), query, 5, *best)
        assert Counter((0, i + 1, int(d), int(s)) for i, (s, d) in enumerate(zip(*best))) == brute(docs, [(0, text)], 5)


def test_empty_tables(spark):
    none, items = spark.createDataFrame([], DOCS), items_of(spark, [(1, "one two")])
    assert L.ranked_search(none, items).count() == 0
    assert L.ranked_search(documents(spark), items.where(F.lit(False))).count() == 0

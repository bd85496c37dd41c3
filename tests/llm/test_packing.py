"""Packing: every id once, windows without gaps, little padding."""

import zlib
from collections import defaultdict

import numpy as np
import public_tokenizers
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from tokenizers import Tokenizer

from gridstream.llm import packing
from gridstream.llm.packing import Piece, Windows, by_powers, packed

from helpers import DOCS, awkward_texts, documents, prose

PATH = public_tokenizers.path("word_bpe_49k.json")


def padding(lengths, size):
    return sum(0 if n & (n - 1) == 0 else size - n for n in lengths)


def checked(rows, texts, size):
    """Pieces against the library's ids; the lengths of the sequences."""
    tokenizer = Tokenizer.from_file(PATH)
    ids = {}
    for doc, text in texts:
        ids.setdefault(doc, []).append(np.array(tokenizer.encode(text or "", add_special_tokens=False).ids + [1], "<u4"))
    own, sequences = defaultdict(list), defaultdict(list)
    for r in rows:
        own[r.doc_id].append(r)
        sequences[r.sequence_id].append((r.offset, r.length))
    assert set(own) == set(ids)
    for doc, pieces in own.items():
        if len(ids[doc]) > 1:                     # several rows of one id: equal ones here
            assert all(np.array_equal(x, ids[doc][0]) for x in ids[doc])
        want = ids[doc][0]
        assert sum(p.length for p in pieces) == want.size * len(ids[doc])
        if len(ids[doc]) == 1:
            pieces.sort(key=lambda p: p.start)
            assert [p.start for p in pieces] == np.cumsum([0] + [p.length for p in pieces])[:-1].tolist()
        for p in pieces:
            assert p.doc_tokens == want.size
            assert p.ids_crc32 == zlib.crc32(want[p.start:p.start + p.length].tobytes())
    lengths = []
    for parts in sequences.values():
        parts.sort()
        assert [o for o, _ in parts] == np.cumsum([0] + [n for _, n in parts])[:-1].tolist()
        lengths.append(sum(n for _, n in parts))
    assert max(lengths) <= size
    return lengths


def test_packing_awkward_rows(spark):
    texts = [(d, t) for d, t in awkward_texts()]
    lengths = checked(packed(documents(spark, texts), PATH).collect(), texts, 2048)
    assert padding(lengths, 2048) <= 16 * len(lengths)


@pytest.mark.parametrize("size,most,merge", [(64, 4, 256), (32, 1, 1 << 20)])
def test_packing_small_windows(spark, size, most, merge):
    texts = [(i, prose(i, i * 7 % 90)) for i in range(300)]
    docs = documents(spark, texts).repartition(13, "doc_id")
    lengths = checked(packed(docs, PATH, size=size, most=most, slack=2, merge_tokens=merge).collect(), texts, size)
    assert padding(lengths, size) <= 2 * len(lengths)


def test_packing_a_document_of_many_windows(spark):
    texts = [(1, prose(3, 40000)), (2, None), (3, "")]
    lengths = checked(packed(documents(spark, texts), PATH).collect(), texts, 2048)
    assert sum(n == 2048 for n in lengths) >= sum(lengths) // 2048 - 1 and padding(lengths, 2048) == 0


def test_packing_empty_and_rerun(spark):
    assert packed(spark.createDataFrame([], DOCS), PATH).count() == 0
    docs = documents(spark, [(i, prose(i, 50)) for i in range(200)]).repartition(4, "doc_id").sortWithinPartitions("doc_id")
    assert sorted(map(tuple, packed(docs, PATH).collect())) == sorted(map(tuple, packed(docs, PATH).collect()))


@settings(max_examples=200, deadline=None)
@given(st.lists(st.integers(1, 100), max_size=60), st.integers(1, 5), st.integers(0, 6))
def test_windows(sizes, most, slack):
    w = Windows(32, most, slack)
    for i, n in enumerate(sizes):
        w.place(Piece(i, 0, np.arange(n, dtype="<u4"), n))
        assert len(w.open) <= most
    done = w.taken()
    assert all(32 - slack <= sum(p.ids.size for p in x) <= 32 for x in done)
    row = w.joined()
    done += w.taken() + by_powers(row)
    got = defaultdict(list)
    for p in (p for x in done for p in x):
        got[p.doc_id].append((p.start, p.ids.tolist()))
    for i, n in enumerate(sizes):
        assert sum((ids for _, ids in sorted(got[i])), []) == list(range(n))


def test_sequence_ids_are_of_one_round_and_task():
    rows = packing._Rows(2, 5)
    rows.add([[Piece(1, 0, np.zeros(3, "<u4"), 3)]])
    assert rows.held[0][5] == (2 << 56) + (5 << 32)

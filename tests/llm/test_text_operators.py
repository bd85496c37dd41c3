"""Operators over texts against brute force, on the awkward rows and the small table."""

import hashlib
import os
import random
import tracemalloc
import zlib
from collections import Counter

import numpy as np
import public_tokenizers
import pyarrow as pa
import pytest
import sentencepiece
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F
from tokenizers import Tokenizer

from gridstream.llm import common, components, language_id, near_dedup, sentencepiece_bpe, substring_dedup, token_files

from helpers import CLASHING, awkward_texts, documents, prose, words

SF = "/root/testdata/sf0.001"
BPE, PIECES = public_tokenizers.path("word_bpe_49k.json"), public_tokenizers.path("piece_bpe_32k.model")


def small(spark):
    return [(r.doc_id, r.text) for r in common.table(spark, SF, "documents").collect()]


# --- words --------------------------------------------------------------------

def test_words_and_hashes():
    texts = [t for _, t in awkward_texts()]
    w = common.words_of(pa.array(texts))
    raw = w.data.tobytes()
    found = [raw[a:b].decode() for a, b in zip(w.starts, w.ends)]
    assert found == [x for t in texts for x in words(t)]
    assert [words(t) for t in texts] == [found[a:b] for a, b in zip(w.first[:-1], w.first[1:])]
    by_word = {}
    for x, h in zip(found, w.hashes.tolist()):
        assert by_word.setdefault(x, h) == h
    assert len(set(by_word.values())) == len(by_word)


def test_hashes_do_not_depend_on_blocks(monkeypatch):
    text = pa.array([prose(1, 5000)])
    whole = common.words_of(text).hashes
    monkeypatch.setattr(common, "BLOCK_BYTES", 1000)
    assert (common.words_of(text).hashes == whole).all()


def test_slices_keep_all_rows():
    rows = [prose(i, 50) for i in range(100)] + [None, "", prose(5, 3000)]
    batches = pa.table({"text": rows}).to_batches(max_chunksize=17)
    parts = list(common.slices(iter(batches), most=2000))
    assert [x for p in parts for x in p["text"].to_pylist()] == rows
    assert len(parts) > 10


# --- substring dedup ----------------------------------------------------------

def brute_removed(rows, window=20):
    seen, out = {}, {}
    for key in sorted({(common_id(i), h, t or "") for i, t, h in rows}):
        w = words(key[2])
        gone = [False] * len(w)
        for k in range(len(w) - window + 1):
            x = tuple(w[k:k + window])
            if x in seen:
                gone[k:k + window] = [True] * window
            seen.setdefault(x, key)
        out[key[0], key[2]] = (len(w), sum(gone), " ".join(a for a, b in zip(w, gone) if not b))
    return out


def common_id(i):
    return substring_dedup.FIRST if i is None else i


def check_repeats(spark, rows):
    docs = documents(spark, rows)
    got = substring_dedup.remove_repeats(docs, digest=True).collect()
    hashes = {r.text: r.h for r in docs.selectExpr("text", "hash(text) as h").collect()}
    want = brute_removed([(i, t, hashes[t]) for i, t in rows])
    expected = Counter((i, *want[common_id(i), t or ""][:2], hashlib.sha256(want[common_id(i), t or ""][2].encode()).hexdigest()) for i, t in rows)
    assert Counter((r._rest.doc_id, r.n_words, r.n_removed, r.result) for r in got) == expected
    return got


def test_substring_dedup_awkward(spark):
    got = check_repeats(spark, awkward_texts())
    assert all(getattr(r._rest, c) == c + "!" for r in got for c in CLASHING)


def test_substring_dedup_small_table(spark):
    check_repeats(spark, small(spark))


def test_substring_dedup_one_passage_everywhere(spark):
    rows = [(i, prose(100 + i, 5) + " " + prose(9, 30) + " " + prose(200 + i, 5)) for i in range(300)]
    got = check_repeats(spark, rows)
    assert sum(r.n_removed for r in got) >= 299 * 30


def test_substring_stage_cuts_texts(spark):
    docs = documents(spark)
    out = substring_dedup.stage(spark, docs, SF)
    assert out.columns == docs.columns
    rows = {r.doc_id: r.text for r in out.collect()}
    assert rows[7] == "" and rows[1] is None and rows[14] == dict(awkward_texts())[14]
    assert words(rows[11]) == words(prose(5, 30) + " " + prose(6, 30)) and "\n" in rows[11]
    assert substring_dedup.remove_repeats(docs.limit(0)).count() == 0


def test_packed_windows_round_trip():
    r = np.random.default_rng(1)
    ids = np.sort(r.integers(-5, 50, 500))
    keys = (ids % 3).astype(np.int32)
    starts = np.concatenate([np.sort(r.integers(0, 100000, n)) for n in np.unique(ids, return_counts=True)[1]])
    hashes = r.integers(0, 2**63, 500).astype(np.uint64)
    out = substring_dedup.unpack(substring_dedup.pack(ids, keys, starts, hashes))
    assert all((a == b).all() for a, b in zip(out, (ids, keys, starts, hashes)))


# --- near duplicates ----------------------------------------------------------

def bag(text, n=5):
    w = words(text)
    return Counter(tuple(w[k:k + n]) for k in range(max(1, len(w) - n + 1))) if w else Counter()


def brute_classes(rows, similar=0.8):
    rows = [(i, bag(t)) for i, t in rows if i is not None]
    parent = {i: i for i, _ in rows}

    def top(x):
        while parent[x] != x:
            x = parent[x]
        return x
    for a in range(len(rows)):
        for b in range(a):
            x, y = rows[a][1], rows[b][1]
            if x and y:
                low = sum((x & y).values())
                if low / (sum(x.values()) + sum(y.values()) - low) >= similar:
                    p, q = sorted((top(rows[a][0]), top(rows[b][0])))
                    parent[q] = p
    return {i: top(i) for i in parent}


def classes(spark, rows):
    return {r.doc: r.class_doc for r in near_dedup.near_duplicates(documents(spark, rows)).collect()}


def test_near_dedup_awkward(spark):
    rows = awkward_texts()
    got = classes(spark, rows)
    assert got.pop(None) is None
    assert got == brute_classes(rows)
    assert got[8] == got[9] == got[7] == 6 and got[20] == 20


def test_near_dedup_star_and_chain(spark):
    """Copies of one base that are near to it but not to each other, and a
    chain of texts of which each is near to the next only; the base is not
    the least id."""
    base = prose(50, 200).split()
    rows = [(100, " ".join(base))]
    for i in range(40):
        w = list(base)
        for k in random.Random(i).sample(range(5, 195), 4):
            w[k] = f"c{i}_{k}"
        rows.append((i, " ".join(w)))
    chain = prose(51, 220).split()
    for i in range(8):
        rows.append((200 + i, " ".join(chain[i * 8:i * 8 + 150])))
    assert classes(spark, rows) == brute_classes(rows)


def test_near_dedup_one_id_with_several_texts(spark):
    a, b, c = prose(60, 80), prose(61, 80), prose(62, 80)
    got = near_dedup.near_duplicates(documents(spark, [(1, a), (2, b), (5, a + " more"), (5, b), (5, c), (9, c), (7, prose(63, 80))])).collect()
    assert {(r.doc, r.class_doc) for r in got} == {(1, 1), (2, 1), (5, 1), (9, 1), (7, 7)}


def test_near_dedup_stage_keeps_every_text_class(spark):
    """Unrelated texts under one id stay, one row of each class; rows without id meet the others."""
    a, b, c, d = (prose(s, 80) for s in (60, 61, 62, 63))
    rows = [(1, a), (2, b), (5, a), (5, b), (5, c), (9, c), (None, c + " more"), (None, d), (None, d), (None, d + " more"),
            (0, None), (0, prose(64, 80)), (0, prose(65, 80)), (7, prose(65, 80) + " more")]
    got = [(r.doc_id, r.text) for r in near_dedup.stage(spark, documents(spark, rows), SF).collect()]
    apart = [r for r in got if r[1] is None or not r[1].startswith(d)]
    assert sorted(apart, key=str) == sorted([(1, a), (2, b), (5, c), (0, None), (0, prose(64, 80)), (0, prose(65, 80))], key=str)
    assert len(got) == len(apart) + 1


def test_near_dedup_small_table_and_stage(spark):
    rows = small(spark)
    assert classes(spark, rows) == brute_classes(rows)
    docs = documents(spark)
    kept = near_dedup.stage(spark, docs, SF)
    assert kept.columns == docs.columns
    assert sorted(str(r.doc_id) for r in kept.collect()) == sorted(
        str(i) for i in {i for i, _ in awkward_texts()} - {7, 8, 9, 13})
    assert near_dedup.near_duplicates(docs.limit(0)).count() == 0


def test_bag_minhash_is_unbiased():
    """The share of equal positions is the weighted Jaccard similarity."""
    r = np.random.default_rng(3)
    element = r.integers(0, 2**63, 60).astype(np.uint64)
    a, b = r.integers(0, 9, 60), r.integers(0, 9, 60)
    want = np.minimum(a, b).sum() / np.maximum(a, b).sum()
    text = np.concatenate((np.zeros((a > 0).sum(), int), np.ones((b > 0).sum(), int)))
    sig = near_dedup.bag_minhash(text, np.concatenate((element[a > 0], element[b > 0])), np.concatenate((a[a > 0], b[b > 0])), 3, 20000)
    assert abs((sig[0] == sig[1]).mean() - want) < 0.015
    assert np.isinf(sig[2]).all() and np.isfinite(sig[:2]).all()


def test_components(spark):
    r = random.Random(2)
    edges = [(r.randrange(300), r.randrange(300)) for _ in range(220)] + [(i, i + 1) for i in range(1000, 1100)] + [(5000, k) for k in range(5001, 5200)]
    parent = {}

    def top(x):
        parent.setdefault(x, x)
        while parent[x] != x:
            x = parent[x]
        return x
    for a, b in edges:
        if a != b:
            p, q = sorted((top(a), top(b)))
            parent[q] = p
    got = {x.node: x.root for x in components.components(spark.createDataFrame(edges, "a long, b long")).collect()}
    assert got == {x: top(x) for x in parent}
    assert components.components(spark.createDataFrame([], "a long, b long")).count() == 0


# --- token files --------------------------------------------------------------

def check_tokens(spark, rows):
    folder = common.shared_path(spark, "tokens")
    manifest = token_files.write_token_files(documents(spark, rows), folder, BPE)
    got = token_files.read_token_files(manifest, folder).collect()
    tokenizer, start, want = Tokenizer.from_file(BPE), 0, []
    for i, t in sorted(rows, key=lambda r: (r[0] is not None, r[0] or 0, (r[1] or "").encode())):
        ids = tokenizer.encode(t or "", add_special_tokens=False).ids + [1]
        want.append((i, start, len(ids), zlib.crc32(np.array(ids, "<u4").tobytes())))
        start += len(ids)
    assert sorted(map(tuple, got), key=lambda r: r[1]) == want


def test_token_files_awkward(spark):
    check_tokens(spark, awkward_texts())


def test_token_files_small_table(spark):
    check_tokens(spark, small(spark))


def test_token_files_of_no_documents(spark):
    folder = common.shared_path(spark, "tokens")
    manifest = token_files.write_token_files(documents(spark).limit(0), folder, BPE)
    assert token_files.read_token_files(manifest, folder).count() == 0


def test_token_files_have_one_file_of_manifest(spark):
    folder = common.shared_path(spark, "tokens")
    manifest = token_files.write_token_files(documents(spark), folder, BPE)
    assert manifest.count() > 1 and len(manifest.inputFiles()) == 1


def test_tokens_word_by_word():
    encoder, tokenizer = token_files.WordEncoder(BPE), Tokenizer.from_file(BPE)
    alphabet = "aAbé ñß'st\t\n\x0b\f\r.,12日\u0301\u0130\u0958<|endoftext|>Σς"
    r = random.Random(4)
    texts = ["".join(r.choice(alphabet) for _ in range(r.randrange(40))) for _ in range(2000)]
    texts += ["<|endoftext|>", "a<|startoftext|> b", "ΟΔΟΣ ΑΣ", "a \u0301b"]
    ids, to = encoder.encode(pa.array(texts), 1)
    for i, t in enumerate(texts):
        assert ids[to[i]:to[i + 1]].tolist() == tokenizer.encode(t, add_special_tokens=False).ids + [1], t


# --- SentencePiece ------------------------------------------------------------

def library():
    return sentencepiece.SentencePieceProcessor(model_file=PIECES)


@settings(max_examples=300, deadline=None)
@given(st.text(alphabet=st.one_of(st.characters(exclude_categories=["Cs"]), st.sampled_from(" \u2581aeinrst\n")), max_size=60))
def test_sentencepiece_is_the_library(text):
    model, sp = sentencepiece_bpe.model_of(PIECES), library()
    ids = sentencepiece_bpe.encode(model, [text])[0]
    assert ids == [*sp.encode(text), 2]
    assert model.decode(ids) == sp.decode(ids)


def test_sentencepiece_documents(spark):
    sp = library()
    for rows in (awkward_texts(), small(spark)):
        got = sentencepiece_bpe.digests(documents(spark, rows), PIECES).collect()
        want = []
        for i, t in rows:
            ids = sp.encode(t or "") + [2]
            want.append((i, len(ids), hashlib.sha256(" ".join(map(str, ids)).encode()).hexdigest(), hashlib.sha256(sp.decode(ids).encode()).hexdigest()))
        assert Counter(map(tuple, got)) == Counter(want)
    assert sentencepiece_bpe.digests(documents(spark).limit(0), PIECES).count() == 0
    ids = {r.doc_id: r.ids for r in sentencepiece_bpe.encoded(documents(spark, [(1, "two words"), (2, None)]), PIECES).collect()}
    assert ids == {1: sp.encode("two words") + [2], 2: [2]}


# --- language ID --------------------------------------------------------------

def test_language_id_held_out(spark):
    got = language_id.op3_language_id(spark, "/root/testdata/sf0.01").collect()
    lang = {r.doc_id: r.lang for r in common.table(spark, "/root/testdata/sf0.01", "documents").collect()}
    held = [r for r in got if r.held_out]
    assert len(got) == len(lang) and 0.25 < len(held) / len(got) < 0.42
    assert all(r.held_out == (zlib.crc32(str(r.doc_id).encode()) % 3 == 1) and 0 <= r.score <= 1 for r in got)
    assert sum(lang[r.doc_id] == r.lang_pred for r in held) / len(held) > 0.97


def test_language_id_awkward(spark):
    docs = documents(spark)
    model = language_id.fit(docs)
    rows = language_id.predicted(docs, model).collect()
    assert len(rows) == len(awkward_texts())
    none = {r.row.doc_id for r in rows if r.lang_pred == "und"}
    assert none == {1, 2, 3, 16} and all(r.score == 0 for r in rows if r.lang_pred == "und")
    assert all(getattr(r.row, c) == c + "!" for r in rows for c in CLASHING)
    empty = language_id.fit(docs.limit(0))
    assert {r.lang_pred for r in language_id.predicted(docs, empty).collect()} == {"und"}
    assert language_id.predicted(docs.limit(0), model).count() == 0


def test_language_kernel_is_the_presence_kernel():
    """The kernel by matrix products equals sets of grams, one by one."""
    texts = ["Das ist ein Haus.", "This is a house, das!", "", "123", "ÉÉ éé"]

    def grams(t):
        blank = "".join(c.lower() if c.isalpha() else " " for c in t)
        line = (" " if blank and not blank[0].isalpha() else "") + " ".join(blank.split()) + (" " if blank and not blank[-1].isalpha() else "")
        return {line[i:i + n] for n in (1, 2, 3) for i in range(len(line) - n + 1)}
    alphabet = "".join(sorted({c for t in texts for c in t.lower() if c.isalpha()}))
    letters = language_id.letter_table(alphabet)
    codes, bounds = language_id.code_points(pa.array(texts))
    code, owner, lettered = language_id.grams(codes, bounds, letters)
    sets = [set(code[owner == i].tolist()) for i in range(len(texts))]
    assert lettered.tolist() == [True, True, False, False, True]
    for i in (0, 1, 4):
        for j in (0, 1, 4):
            assert len(sets[i] & sets[j]) == pytest.approx(len(grams(texts[i]) & grams(texts[j])), abs=4)


def test_language_id_many_languages_and_scripts(spark):
    """80 languages over four scripts, one with long texts only: all are learned and told apart."""
    r = random.Random(8)
    scripts = ["abcdefghijklmnopqrstuvwxyz", "αβγδεζηθικλμνξοπρστυφχψω", "абвгдежзийклмнопрстуфхцчшщъыьэюя", "".join(chr(0x4E00 + 7 * i) for i in range(300))]
    rows, n = [], 0
    for k in range(80):
        letters = r.sample(scripts[k % 4], 9)
        words = ["".join(r.choices(letters, k=r.randrange(2, 6))) for _ in range(40)]
        for _ in range(24):
            rows.append((n, " ".join(r.choices(words, k=2500 if k == 3 else 60)), f"l{k:02d}", "s", 0))
            n += 1
    docs = spark.createDataFrame(rows, "doc_id long, text string, lang string, source string, n_chars long").repartition(4)
    model = language_id.fit(docs)
    assert len(model.languages) == 80 and min(len(t) for _, t, lang, *_ in rows if lang == "l03") > language_id.LANDMARK_CHARS
    got = {r.row.doc_id: (r.row.lang, r.lang_pred) for r in language_id.predicted(docs, model).collect()}
    held = [p for i, p in got.items() if zlib.crc32(str(i).encode()) % 3 == 1]
    assert sum(a == b for a, b in held) / len(held) > 0.95 and all(b == "l03" for a, b in held if a == "l03")


def test_language_kernel_by_lists_equals_products(spark, monkeypatch):
    docs = documents(spark, [(i, prose(i, 50 + i)) for i in range(40)])
    model = language_id.fit(docs.withColumn("lang", F.when(F.col("doc_id") % 2 == 0, "a").otherwise("b")))
    texts = pa.array([prose(99, 500), "", None, "x y z w1"])
    dense = language_id.Scorer(model)
    monkeypatch.setattr(language_id, "DENSE_CELLS", 0)
    lists = language_id.Scorer(model)
    assert dense.dense is not None and lists.dense is None
    assert np.allclose(dense.kernel(texts)[0], lists.kernel(texts)[0], atol=1e-6)


def test_token_files_of_a_large_vocabulary(spark):
    """A vocabulary of more than 65,536 ids needs and gets uint32 files."""
    from tokenizers import Tokenizer, models, pre_tokenizers
    vocabulary = {"[UNK]": 0, "[END]": 1} | {f"w{i}</w>": i + 2 for i in range(70000)}
    own = Tokenizer(models.WordLevel(vocabulary, unk_token="[UNK]"))
    own.pre_tokenizer = pre_tokenizers.WhitespaceSplit()
    path = common.shared_path(spark, "vocabulary").replace("file:", "")
    os.makedirs(path)
    own.save(f"{path}/t.json")
    assert token_files.id_type(f"{path}/t.json") == "<u4" and token_files.id_type(BPE) == "<u2"
    rows = [(i, " ".join(f"w{(i * 9973 + j * 77) % 70000}</w>" for j in range(50))) for i in range(40)]
    folder = common.shared_path(spark, "tokens")
    manifest = token_files.write_token_files(documents(spark, rows), folder, f"{path}/t.json")
    got = {r.doc_id: (r.n_tokens, r.ids_crc32) for r in token_files.read_token_files(manifest, folder).collect()}
    for i, t in rows:
        ids = own.encode(t).ids + [1]
        assert got[i] == (len(ids), zlib.crc32(np.array(ids, "<u4").tobytes()))
    assert {r.dtype for r in manifest.collect()} == {"<u4"} and max(max(own.encode(t).ids) for _, t in rows) > 65536
    with pytest.raises(ValueError):
        token_files.write_token_files(documents(spark, rows), folder, f"{path}/t.json", dtype="<u2")


def test_sentencepiece_long_words():
    """Texts without spaces: equal to the library, and no round for each character."""
    import time
    model, sp, r = sentencepiece_bpe.model_of(PIECES), library(), random.Random(3)
    texts = ["".join(r.choices("abcdefghijklmnopqrstuvwxyz", k=160000)), "x" * 5000, "".join(chr(r.randrange(0x4E00, 0x9FA5)) for _ in range(20000)),
             "".join(r.choices("ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789+/", k=50000)), "a" * 65 + "▁" * 70 + "日" * 66]
    for t in texts:
        began = time.time()
        ids = sentencepiece_bpe.encode(model, [t + " and more"])[0]
        assert time.time() - began < 10
        assert ids == [*sp.encode(t + " and more"), 2]


def bucket_rows(n_bodies, size, shared, seed=3):
    """Rows of one hash bucket: ``n_bodies`` packs of ``size`` windows, of which ``shared`` have a hash that others have too."""
    r, rows = np.random.default_rng(seed), []
    again = r.integers(1, 1 << 63, shared * 2, dtype=np.uint64)
    for i in range(n_bodies):
        own = np.concatenate((r.integers(1, 1 << 63, size - shared, dtype=np.uint64), r.choice(again, shared, replace=False)))
        ids = np.sort(r.integers(0, 50, size)) + 50 * i
        rows.append((ids, ids * 7, np.arange(size), own))
    body = [substring_dedup.pack(*x) for x in rows]
    return rows, pa.table({"bucket": pa.array([0] * n_bodies, pa.int32()), "flags": [False] * n_bodies, "body": pa.array(body, pa.binary())})


def test_substring_dedup_bucket_finds_all_later_windows():
    rows, bucket = bucket_rows(6, 400, 150)
    first = {}
    every = sorted((i, k, s, h) for x in rows for i, k, s, h in zip(*(a.tolist() for a in x)))
    later = {x[:3] for x in every if first.setdefault(x[3], x[:3]) != x[:3]}
    assert later
    flagged = substring_dedup.pack(np.array([-5, -5]), np.array([1, 1]), np.array([3, 9]), None)
    bucket = pa.concat_tables([bucket, pa.table({"bucket": pa.array([0], pa.int32()), "flags": [True], "body": pa.array([flagged], pa.binary())})])
    for most in (7, 100, 10_000):
        out = substring_dedup.repeats_of_bucket(5, most)(bucket)
        got = [w for b in out["body"].to_pylist() for w in zip(*(a.tolist() for a in substring_dedup.unpack(b, False)[:3]))]
        assert len(got) == len(set(got)) and set(got) == later | {(-5, 1, 3), (-5, 1, 9)}


def test_substring_dedup_bucket_unpacks_only_repeated_windows():
    _, bucket = bucket_rows(40, 20_000, 100)
    run = substring_dedup.repeats_of_bucket(5)
    run(bucket.slice(0, 2))
    tracemalloc.start()
    try:
        run(bucket)
        assert tracemalloc.get_traced_memory()[1] < 30 * 40 * 20_000      # bytes a window; all unpacked took about 90
    finally:
        tracemalloc.stop()


def test_substring_dedup_tells_texts_of_one_id_apart(spark):
    """Two texts without an id whose 32-bit hashes are equal: the one that nothing repeats loses no word."""
    a, b = (" ".join(f"w{j}_{i}" for j in range(30)) for i in (114031, 137301))
    docs = spark.createDataFrame([(None, a), (None, b), (5, "x " + a + " y")], "doc_id long, text string")
    got = {(r["_rest"].doc_id, r["result"]): r.n_removed for r in substring_dedup.remove_repeats(docs).collect()}
    assert got[(None, a)] == 0 and got[(None, b)] == 0 and [n for (i, _), n in got.items() if i == 5] == [30]


def test_substring_buckets_grow_with_the_input(spark, monkeypatch):
    docs = documents(spark, [(i, prose(i % 30, 400)) for i in range(60)])
    few = sorted(map(str, substring_dedup.remove_repeats(docs).collect()))
    assert substring_dedup.bucket_count(docs) == common.shuffle_parts(spark)
    assert substring_dedup.bucket_count(docs, most=2000) > 100
    monkeypatch.setattr(substring_dedup, "bucket_count", lambda *_: 101)
    assert sorted(map(str, substring_dedup.remove_repeats(docs).collect())) == few

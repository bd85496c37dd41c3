"""The pipeline's stages, and the whole run, against brute force on the small table."""

import hashlib
import math
from collections import Counter
from fractions import Fraction

import numpy as np
import public_tokenizers
import sentencepiece

import corpus_pipeline
from gridstream.llm import language_id, mixing
from gridstream.llm.common import table

from helpers import WORD, words
from test_text_operators import brute_classes

SF = "/root/testdata/sf0.001"
COLUMNS = "doc_id long, text string, lang string, source string, n_chars long"


def rows_of(df):
    return [tuple(r) for r in df.select("doc_id", "text", "lang", "source").collect()]


def language_kept(docs, model):
    """Ids that stay: grams as sets, one kernel value after the other."""
    letters = language_id.letter_table(model.alphabet)
    marks = np.split(model.marks, model.offsets[1:-1])
    of_gram = dict(zip(model.grams.tolist(), marks))
    kept = set()
    for doc, text, *_ in docs:
        kinds = [int(letters[ord(c)]) for c in text or ""]
        if not any(kinds):
            continue
        line = [k for i, k in enumerate(kinds) if k or i == 0 or kinds[i - 1]]
        own = set()
        for n, base in ((1, 0), (2, 128), (3, 128 + 128 ** 2)):
            for i in range(len(line) - n + 1):
                code = 0
                for k in line[i:i + n]:
                    code = code * 128 + k
                own.add(code + base)
        known = [g for g in own if g in of_gram]
        shared = np.zeros(model.sizes.size)
        for g in known:
            shared[of_gram[g]] += 1
        scores = language_id.SHARPNESS * (shared / math.sqrt(max(1, len(known))) / np.sqrt(np.maximum(model.sizes, 1))) @ model.coefficients.astype(float)
        share = np.exp(scores - scores.max())
        if share.max() / share.sum() >= language_id.REJECT_BELOW:
            kept.add(doc)
    return kept


def near_kept(docs):
    classes = brute_classes([(i, t) for i, t, *_ in docs])
    return {i for i, t, *_ in docs if classes[i] == i or not words(t)}


def repeats_cut(docs, window=20):
    """Texts without the words of windows that start earlier."""
    seen, out = set(), {}
    for doc, text, *_ in sorted(docs, key=lambda r: r[0]):
        found = list(WORD.finditer(text or ""))
        gone = [False] * len(found)
        for k in range(len(found) - window + 1):
            x = tuple(m[0] for m in found[k:k + window])
            if x in seen:
                gone[k:k + window] = [True] * window
            seen.add(x)
        made, at = "", 0
        for k, m in enumerate(found):
            if gone[k] and (k == 0 or not gone[k - 1]):
                made += text[at:m.start()]
            if gone[k]:
                at = found[k + 1].start() if k + 1 < len(found) else len(text)
        out[doc] = None if text is None else made + text[at:]
    return out


def copies_of(docs, labels):
    """How often the mix takes each document: targets shared again and again, keys in order."""
    size = {i: len(words(t)) for i, t, *_ in docs}
    sources = sorted({s for *_, s in docs}, key=lambda s: (s is None, s or ""))
    total = {s: sum(size[i] for i, *_, x in docs if x == s) for s in sources}
    weight = {s: (3, 1, 2)[k % 3] for k, s in enumerate(sources)}
    target, open_, left = {}, set(sources), Fraction(3, 2) * sum(total.values())
    while open_:
        level = left / sum(weight[s] for s in open_)
        full = {s for s in open_ if level * weight[s] > 2 * total[s]}
        if not full:
            target.update({s: level * weight[s] for s in open_})
            break
        for s in full:
            target[s] = Fraction(2 * total[s])
            left -= target[s]
        open_ -= full
    out = {}
    for s in sources:
        keyed = []
        for i, _, _, x in docs:
            if x == s:
                q, t = labels.get(i, (None, None))
                u = (int(hashlib.md5(f"{mixing.SEED}:{i}".encode()).hexdigest()[:13], 16) + 0.5) / (1 << 52)
                keyed.append((-math.log(u) / ({1: 2.0, 0: 0.5}.get(q, 1.0) * (0.25 if t == 1 else 1.0)), i))
        epochs, upto = int(target[s] // total[s]) if total[s] else 0, 0
        for _, i in sorted(keyed):
            upto += size[i]
            out[i] = (epochs + (epochs < 2 and upto - size[i] / 2 <= target[s] - epochs * total[s])) if size[i] else 0
    return out


def test_run_is_the_chain_of_brute_force_stages(spark):
    stages = dict(corpus_pipeline.STAGES)
    df = table(spark, SF, "documents")
    docs = rows_of(df)
    labels = {}
    for r in table(spark, SF, "labels").collect():
        q, t = labels.get(r.doc_id, (None, None))
        labels[r.doc_id] = (r.quality if q is None else max(q, r.quality or 0), r.toxic if t is None else max(t, r.toxic or 0))

    kept = language_kept(docs, language_id.fit(df.select("doc_id", "lang", "text")))
    first = stages["language_id"](spark, df, SF)
    assert {r[0] for r in rows_of(first)} == kept and 100 < len(kept) <= len(docs)
    docs = [d for d in docs if d[0] in kept]

    alone = near_kept(docs)
    assert len(alone) < len(docs)
    docs = [d for d in docs if d[0] in alone]

    cut = repeats_cut(docs)
    assert any(cut[i] != t for i, t, *_ in docs)
    docs = [(i, cut[i], lang, s) for i, _, lang, s in docs]

    copies = copies_of(docs, labels)
    mixed = stages["mixing"](spark, spark.createDataFrame([(*d, len(d[1])) for d in docs], COLUMNS).select(*df.columns), SF)
    assert Counter(r[0] for r in rows_of(mixed)) == Counter({i: n for i, n in copies.items() if n})
    assert max(copies.values()) == 2 and min(copies.values()) == 0

    sp = sentencepiece.SentencePieceProcessor(model_file=public_tokenizers.path("piece_bpe_32k.model"))
    want = Counter()
    for i, text, *_ in docs:
        ids = sp.encode(text) + [2]
        want[i, len(ids), hashlib.sha256(" ".join(map(str, ids)).encode()).hexdigest(), hashlib.sha256(sp.decode(ids).encode()).hexdigest()] += copies[i]
    assert Counter(map(tuple, corpus_pipeline.run(spark, SF).collect())) == +want

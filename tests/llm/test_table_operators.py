"""Chat formatting, top-k search, rules, URLs, mixing, the pipeline and the registered SQL."""

import hashlib
from collections import Counter, defaultdict

import duckdb
import numpy as np
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

import __spark_entry__ as entry
import corpus_pipeline
from gridstream.llm import chat_format, mixing, quality_rules, topk_search, url_rules
from gridstream.llm.queries import QUERIES, SQL

from helpers import awkward_texts, documents, words

SF = "/root/testdata/sf0.001"
TABLES = ["documents", "embeddings", "pages", "benchmark", "labels", "conversations"]


@pytest.mark.parametrize("name", sorted(SQL))
def test_sql(spark, name):
    con = duckdb.connect()
    for t in TABLES:
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{SF}/{t}.parquet')")
    df = QUERIES[name](spark, SF)
    c = con.execute(SQL[name])
    names = [d[0] for d in c.description]
    assert sorted(names) == sorted(df.columns)
    assert Counter(map(tuple, c.fetchall())) == Counter(tuple(r[n] for n in names) for r in df.collect())


def test_all_queries_are_registered():
    q = entry.queries()
    assert [n for n in range(1, 14) if not any(k.startswith(f"op{n}_") for k in q)] == [] and "pipeline" in q


@pytest.mark.parametrize("name", ["op6_quality_rules", "op7_url_rules", "op9_mixing"])
def test_native_plans(spark, name):
    plan = QUERIES[name](spark, SF)._jdf.queryExecution().executedPlan().toString()
    assert not any(x in plan for x in ("Python", "Pandas", "Arrow", "Cartesian", "BroadcastNestedLoop"))


# --- chat ---------------------------------------------------------------------

TEXT = st.text(alphabet=st.one_of(st.characters(exclude_categories=["Cs"]), st.sampled_from("<|\\>\n")), max_size=30)


@settings(max_examples=200, deadline=None)
@given(st.lists(st.tuples(st.one_of(st.sampled_from(["user", "assistant", "system"]), TEXT), TEXT), max_size=5))
def test_chat_round_trip(turns):
    template = chat_format.Template(chat_format.CHAT)
    text, spans = template.render([{"role": r, "text": t} for r, t in turns])
    assert list(chat_format.read_back(text)) == turns
    assert [chat_format.unescape(text[a:b]) for a, b in spans] == [t for r, t in turns if r == "assistant" and t]
    parts = list(template.segments(iter([{"role": r, "text": t} for r, t in turns]), 20))
    assert "".join(p for p, _ in parts) == text


def test_template_language():
    render = lambda source, **names: chat_format.Template(source).render(names.pop("messages", []), **names)[0]
    assert render("{% if 1 == 1 and not false %}a{{ 'b' ~ 3 }}{% else %}c{% endif %}") == "ab3"
    assert chat_format.Template("x{{ 'y' }}{% if 'a' in 'abc' %}z{% endif %}").tree == [("text", "xyz")]
    assert render("{% for m in messages %}{{ loop.index }}{% if not loop.last %},{% endif %}{% endfor %}", messages=["a", "b"]) == "1,2"
    assert render("{% set x = m.a['b'][0] | upper %}{{ x }}{{ m.none | default('!') }}", m={"a": {"b": ["q"]}}) == "Q!"
    assert render("a  {%- if n >= 2 -%}  b  {%- elif n == 1 %}c{% endif %}{# no #}", n=2) == "ab"
    assert render("{{ m.__class__ }}{{ m.keys }}", m={}) == ""           # only the mapping's own keys
    for bad in ("{{ f() }}", "{% for x in y %}", "{{ x | nothing }}", "{% else %}", "{{ 1 + }}", "{% import os %}", "{{ x", "a {% if x", "{{ x }} {# y"):
        with pytest.raises(chat_format.TemplateError):
            chat_format.Template(bad)
    whole = chat_format.Template("{{ messages[0].role }}{% for m in messages %}{{ m.role }}{% endfor %}")
    assert not whole.streams and "".join(t for t, _ in whole.segments(iter([{"role": "a"}, {"role": "b"}]), 1)) == "aab"


def test_chat_awkward_rows(spark):
    rows = [(1, 1, "user", None), (1, 0, None, "x"), (1, None, "assistant", "first"), (None, 0, "user", "no id"), (2, 0, "assistant", "same"),
            (2, 0, "assistant", "same"), (3, 0, "assistant", "<|im_end|>" * 50000), (4, 0, "a\nb\\", "")]
    turns = spark.createDataFrame([(*r, "x") for r in rows], "conv_id long, turn long, role string, text string, segment string")
    got = {r.conv_id: r for r in chat_format.digests(chat_format.formatted(turns, size=1000)).collect()}
    by = defaultdict(list)
    for c, t, r, x in sorted(rows, key=lambda r: (r[1] is not None, r[1] or 0, r[2] or "", r[3] or "")):
        by[c].append((r or "", x or ""))
    for c, own in by.items():
        loss = "".join(x for r, x in own if r == "assistant")
        assert (got[c].n_turns, got[c].turns_sha256) == (len(own), hashlib.sha256("".join(f"{r}\n{x}\n" for r, x in own).encode()).hexdigest())
        assert (got[c].loss_chars, got[c].loss_sha256) == (len(loss), hashlib.sha256(loss.encode()).hexdigest())
    assert chat_format.formatted(turns.limit(0)).count() == 0


def test_a_long_conversation_leaves_in_segments(spark):
    turns = spark.range(3000).selectExpr("7L as conv_id", "id as turn", "'assistant' as role", "repeat('ab ', 50) as text")
    segments = chat_format.formatted(turns, size=10000).collect()
    assert len(segments) > 30 and max(len(r.text) for r in segments) < 12000


# --- top-k --------------------------------------------------------------------

def test_topk_awkward(spark):
    r = np.random.default_rng(5)
    rows = [(i, [float(x) for x in r.normal(size=8)]) for i in range(300)]
    rows += [(300 + i, [0.5] * 8) for i in range(200)]                     # ties
    rows += [(1000, None), (1001, [1.0, None]), (1050, [float("nan")] * 8), (1100, [float("inf")]), (1150, []), (1200, [3.0]), (None, [1.0] * 8),
             (50, rows[50][1]), (1250, [1.0] * 12)]
    df = spark.createDataFrame([(i, v, "x") for i, v in rows], "vec_id long, embedding array<double>, rank string").repartition(4)
    sound = {i: [int(np.floor(256 * x)) for x in v] for i, v in rows
             if i is not None and v is not None and all(x is not None and np.isfinite(x) for x in v)}
    want = []
    for q in (i for i in sound if i % 50 == 0):
        scores = sorted((-sum(a * b for a, b in zip(sound[q], sound[c])), c) for c in sound if c != q)
        want += [(q, k + 1, c, -s) for k, (s, c) in enumerate(scores[:5])]
    for group in (1, 2, 16):           # query blocks that share a copy of a candidate block
        got = topk_search.top_k(df, F.col("vec_id") % 50 == 0, block=64, query_block=3, group=group).collect()
        assert Counter(map(tuple, got)) == Counter(want)
    few = topk_search.top_k(df.where("vec_id in (0, 1, 2)"), F.col("vec_id") % 50 == 0).collect()
    assert len(few) == 2
    assert topk_search.top_k(df.limit(0), F.col("vec_id") % 50 == 0).count() == 0


def test_topk_wide_sums(spark):
    """Sums beyond 32 bits, weights within and beyond them, beside small ones."""
    r = np.random.default_rng(6)
    rows = [(i, [float(x) for x in r.normal(size=6) * 10.0 ** (i % 8)]) for i in range(240)]
    df = spark.createDataFrame(rows, "vec_id long, embedding array<double>")
    ints = {i: [int(np.floor(256 * x)) for x in v] for i, v in rows}
    want = []
    for q in range(0, 240, 50):
        scores = sorted((-sum(a * b for a, b in zip(ints[q], ints[c])), c) for c in ints if c != q)
        want += [(q, k + 1, c, -s) for k, (s, c) in enumerate(scores[:5])]
    got = topk_search.top_k(df, F.col("vec_id") % 50 == 0, block=32, query_block=2).collect()
    assert Counter(map(tuple, got)) == Counter(want)


def test_topk_block_scores():
    r = np.random.default_rng(7)
    for top in (300, 2**20, 2**33):
        sizes = r.integers(0, 7, 50)
        weights = r.integers(-top, top, int(sizes.sum())) * (r.random(int(sizes.sum())) < 0.7)
        block = topk_search.Postings(np.arange(50), sizes, weights)
        own = r.integers(-200, 200, 9)
        cut = np.cumsum(sizes) - sizes
        assert block.scores(own).tolist() == [sum(int(x) * int(y) for x, y in zip(own, weights[c:c + n])) for c, n in zip(cut, sizes)]


# --- quality rules ------------------------------------------------------------

def test_quality_measures_awkward(spark):
    rows = awkward_texts()
    got = Counter((r.doc_id, r.n_words, r.word_chars, r.n_symbols, r.n_dup_lines, r.n_repeat_words)
                  for r in quality_rules.ledger(documents(spark, rows)).collect())
    want = Counter()
    for i, t in rows:
        w = words(t)
        seen = Counter(tuple(w[k:k + 8]) for k in range(len(w) - 7))
        inside = {k + d for k in range(len(w) - 7) if seen[tuple(w[k:k + 8])] > 1 for d in range(8)}
        lines = [x for x in (t or "").split("\n") if words(x)]
        want[i, len(w), sum(map(len, w)), sum(c in "#*$%&|<>" for c in t or ""), len(lines) - len(set(lines)), len(inside)] += 1
    assert got == want
    assert quality_rules.ledger(documents(spark, []).limit(0)).count() == 0


def test_ablations(spark):
    book = quality_rules.ledger(documents(spark))
    bits = [r.fail_bits for r in book.collect()]
    for r in quality_rules.ablations(book).collect():
        mask, bit = quality_rules.mask_of(r.policy), quality_rules.BIT[r.rule]
        assert (r.n_failed, r.n_alone, r.n_kept) == (sum(b & bit > 0 for b in bits), sum(b & mask == bit for b in bits), sum(b & mask == 0 for b in bits))


# --- URLs ---------------------------------------------------------------------

def test_url_rules_awkward(spark):
    urls = [None, "", "no scheme/net/", "http://", "HTTP://A.Example.NET/en/x?y#z", "x://example.net/de", "x://example.com/de/1", "x://myexample.com/de/1",
            "x://example.com/DE/", "x://a.org/fr/", "x://a.org/fr", "x://net", "x://net?x=://org/fr/", "x://NET/", "x://a#b/c", "x://İ.org/fr/", "x://net/\n"]
    pages = spark.createDataFrame([(i, u, "x") for i, u in enumerate(urls)] + [(None, "x://net/", "x")], "page_id long, url string, host string")
    labels = spark.createDataFrame([], "doc_id long, quality int, toxic int")
    got = {r.page_id: r for r in url_rules.judged(pages, labels).collect()}
    shown = [(got[i].host, got[i].path, got[i].rule) for i in range(len(urls))]
    assert shown == [("", "", None), ("", "", None), ("", "", None), ("", "", None), ("a.example.net", "/en/x", "example.net/en/"),
                     ("example.net", "/de", "net/"), ("example.com", "/de/1", "example.com/de/"), ("myexample.com", "/de/1", None),
                     ("example.com", "/DE/", None), ("a.org", "/fr/", "org/fr/"), ("a.org", "/fr", None), ("net", "", None), ("net", "", None),
                     ("net", "/", "net/"), ("a", "", None), ("İ.org", "/fr/", "org/fr/"), ("net", "/\n", "net/")]
    assert got[None].verdict == "block" and got[4].verdict == "allow" and got[5].verdict == "block" and got[7].verdict == "allow"


def test_url_rules_learn_combinations(spark):
    rows = []
    for i in range(400):
        host, word = ("spam.com", "good.com")[i % 2], ("casino", "news")[(i // 2) % 2]
        rows.append((i, f"http://{host}/{word}/{i}", int(host == "spam.com" and word == "casino")))
    pages = spark.createDataFrame([(i, u) for i, u, _ in rows], "page_id long, url string")
    labels = spark.createDataFrame([(i, 1 - b, 0) for i, _, b in rows[:200]], "doc_id long, quality int, toxic int")
    got = {r.page_id: r.verdict for r in url_rules.judged(pages, labels).collect()}
    assert all(got[i] == ("block" if b else "allow") for i, _, b in rows)


def test_url_rules_need_as_many_pages_of_a_large_table(spark):
    """20 bad pages make a rule, also where they are less than 0.2 % of the labelled pages; 19 don't."""
    urls = spark.range(12000).selectExpr("id", "CASE WHEN id < 20 THEN 'tail.bad' WHEN id < 39 THEN 'less.worse' ELSE concat('h', id % 50, '.com') END AS host")
    labelled = urls.selectExpr("array(concat('host=', host), concat('path=', id % 7)) AS items", "id < 39 AS bad")
    assert [r["items"] for r in url_rules.mined_rules(labelled).collect()] == [["host=tail.bad"]]


def test_url_rules_of_four_tokens(spark):
    """Pages are bad with all four words only; each three of them are as often on good pages."""
    words = ["a", "b", "c", "d"]
    rows = [(f"http://x.com/{'/'.join(words)}/{i}", 0) for i in range(40)]
    rows += [(f"http://x.com/{'/'.join(w for w in words if w != out)}/{i}", 1) for out in words for i in range(40)]
    pages = spark.createDataFrame([(i, u) for i, (u, _) in enumerate(rows)], "page_id long, url string")
    labels = spark.createDataFrame([(i, q, 0) for i, (_, q) in enumerate(rows)], "doc_id long, quality int, toxic int")
    got = {r.page_id: r.verdict for r in url_rules.judged(pages, labels).collect()}
    assert all(got[i] == ("allow" if q else "block") for i, (_, q) in enumerate(rows))
    items = [[f"path={w}" for w in words if w != out] for out in [None, *words] for _ in range(40)]
    labelled = spark.createDataFrame([(t, len(t) == 4) for t in items], "items array<string>, bad boolean")
    assert [r["items"] for r in url_rules.mined_rules(labelled).collect()] == [[f"path={w}" for w in words]]


# --- mixing -------------------------------------------------------------------

def brute_targets(sizes):
    names = sorted(sizes, key=lambda s: (s is None, s))
    weight = {s: (3, 1, 2)[i % 3] for i, s in enumerate(names)}
    out, free, left = {}, set(names), 1.5 * sum(sizes.values())
    while True:
        total = sum(weight[s] for s in free)
        over = {s for s in free if left * weight[s] / total > 2 * sizes[s] or not sizes[s]}
        if not over:
            return out | {s: left * weight[s] / total for s in free}
        for s in over:
            out[s] = 2.0 * sizes[s]
            left -= out[s]
        free -= over
        if not free:
            return out


def test_mixing_awkward(spark):
    rows = awkward_texts()
    docs = documents(spark, rows)
    labels = spark.createDataFrame([(6, 1, 0), (6, 0, 1), (None, 1, 0), (14, None, None)], "doc_id long, quality int, toxic int")
    run = lambda: mixing.mixed(mixing.weighted(docs, labels)).collect()
    got = run()
    by = defaultdict(int)
    for r in got:
        by[r.source] += r.size
    want = brute_targets(dict(by))
    assert len(got) == len(rows)
    for r in got:
        assert r.size == len(words(r.row.text)) and r.source_size == by[r.source] and r.target == pytest.approx(want[r.source])
        assert 0 <= r.taken <= 2 * r.size and (not r.size or r.taken % r.size == 0)
    assert Counter(map(str, run())) == Counter(map(str, got))
    assert mixing.mixed(mixing.weighted(docs.limit(0), labels)).count() == 0


def test_mixing_many_ranges(spark, monkeypatch):
    """Key ranges change nothing: sources come near their targets, running sums are whole."""
    docs = spark.range(4000).selectExpr("id as doc_id", "repeat('w ', cast(id % 40 + 1 as int)) as text", "if(id % 3 = 0, 'b', 'a') as source")
    labels = spark.range(4000).selectExpr("id as doc_id", "cast(id % 2 as int) as quality", "cast(id % 5 = 0 as int) as toxic")
    run = lambda: {r.doc_id: r.taken for r in mixing.mixed(mixing.weighted(docs, labels)).collect()}
    one = run()
    monkeypatch.setattr(mixing, "RANGE_ROWS", 37)
    assert run() == one
    rows = mixing.mixed(mixing.weighted(docs, labels)).collect()
    for s in ("a", "b"):
        own = [r for r in rows if r.source == s]
        assert abs(sum(r.taken for r in own) - own[0].target) <= 20


# --- pipeline -----------------------------------------------------------------

def test_pipeline(spark):
    stages = dict(corpus_pipeline.STAGES)
    assert list(stages) == ["language_id", "near_dedup", "substring_dedup", "mixing", "sentencepiece"]
    out = corpus_pipeline.run(spark, SF)
    assert out.columns == ["doc_id", "n_tokens", "ids_sha256", "decoded_sha256"] and out.count() > 100


def test_stages_on_awkward_and_empty_rows(spark):
    docs = documents(spark)
    for name, stage in corpus_pipeline.STAGES:
        for own in (docs, docs.limit(0)):
            out = stage(spark, own, SF)
            assert name == "sentencepiece" or out.columns == docs.columns
            out.count()


def test_url_rules_of_a_long_bad_url(spark):
    """A url of 40 words on 25 bad rows; another of 40 words on bad and good rows
    alike; a third of 40 words that is bad with one query name only."""
    import time
    w, v, x = ([f"{c}{i}" for i in range(40)] for c in "wvx")
    rows = [("http://a.b.c.d.e/" + "/".join(w), 0)] * 25 + [("http://a.b.c.d.e/" + "/".join(v), i % 2) for i in range(60)]
    rows += [("http://q.r/" + "/".join(x) + "?go=1", 0)] * 25 + [("http://q.r/" + "/".join(x), 1)] * 25 + [(f"http://s{i}.t/?go=1", 1) for i in range(25)]
    urls = ["http://x.y/w3", "http://a.b.c.d.e/v1/v2", "http://other.t/x7/news?go=9", "http://other.t/x7/news", "http://other.t/?go=9"]
    pages = spark.createDataFrame(list(enumerate([u for u, _ in rows] + urls)), "page_id long, url string")
    labels = spark.createDataFrame([(i, q, 0) for i, (_, q) in enumerate(rows)], "doc_id long, quality int, toxic int")
    began = time.time()
    got = {r.page_id: r.verdict for r in url_rules.judged(pages, labels).collect()}
    assert time.time() - began < 60
    assert [got[i] for i in range(len(rows), len(rows) + 5)] == ["block", "allow", "block", "allow", "allow"]
    for i, (u, _) in enumerate(rows):
        assert got[i] == ("block" if "w1/" in u or ("x1/" in u and "go" in u) else "allow"), u


# --- mixing without ids of their own ------------------------------------------

def test_mixing_samples_rows_without_id_by_chance(spark):
    """Texts of rising length without an id, and copies under one id: the partial
    epoch takes them by chance, not by size, and the same in any order of rows."""
    rows = [(None, "w " * (1 + i % 50), "a") for i in range(1500)] + [(7, "same text here", "a")] * 500 + [(100 + i, "x y z", "b") for i in range(300)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, source string")
    labels = spark.createDataFrame([], "doc_id long, quality int, toxic int")
    run = lambda d: mixing.mixed(mixing.weighted(d, labels)).select("doc_id", "source", "size", "taken", "target").collect()
    got = run(docs.repartition(3))
    assert len(got) == len(rows) and Counter(map(tuple, got)) == Counter(map(tuple, run(docs.repartition(7, "text"))))
    own = [r for r in got if r.source == "a"]
    epochs = int(own[0].target // sum(r.size for r in own))
    more = [r for r in own if r.taken > epochs * r.size]
    share = sum(r.size for r in more) / sum(r.size for r in own)
    assert 0.05 < share < 0.95
    for some in (lambda r: r.size < 15 and r.doc_id is None, lambda r: r.size > 35, lambda r: r.doc_id == 7):
        whole = [r for r in own if some(r)]
        assert abs(sum(some(r) for r in more) / len(whole) - share) < 0.1
    assert abs(sum(r.taken for r in own) - own[0].target) <= 50

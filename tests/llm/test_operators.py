"""Operators against brute force, and the edge cases that their docstrings define."""

import glob
import hashlib
import math
import os
import re
import time
import tracemalloc
from collections import Counter
from itertools import combinations

import duckdb
import numpy as np
import pytest
from pyspark.sql import functions as F

from granary.llm import chat, decontam, html, langid, licenses, mixing, ngram_join, pii, quality, suffix
from granary.llm.common import components, ready
from granary.llm.queries import QUERIES, SQL
from granary.llm.shingles import shingle_set

DATA = "/root/testdata/sf0.001"
WS = re.compile(r"[^\x20\x09-\x0D]+")
LOW = {i: i + 32 for i in range(65, 91)}
DOCS = "doc_id long, text string, lang string, source string"


@pytest.fixture(scope="module", autouse=True)
def checkpoints(spark):
    ready(spark)


@pytest.fixture(scope="module")
def real(spark):
    return spark.read.parquet(f"{DATA}/documents.parquet")


@pytest.fixture(scope="module")
def con():
    c = duckdb.connect()
    for p in glob.glob(f"{DATA}/*.parquet"):
        c.sql(f"create view {os.path.basename(p)[:-8]} as select * from '{p}'")
    return c


def by_id(df):
    return {r.doc_id: r for r in df.collect()}


def edge(spark):
    """Null, empty, blank, long, repeated rows, a null id and clashing extra columns."""
    rows = [(1, None, None, None), (2, "", "en", "s"), (3, " \t\n", "en", "s"), (4, "word " * 40_000, "en", "s"), (5, "same text here now", "en", "s"), (5, "same text here now", "en", "s"), (None, "same text here now", None, "t")]
    df = spark.createDataFrame(rows, DOCS)
    return df.withColumns({"key": F.lit(1), "n": F.lit(2), "size": F.lit("x"), "score": F.lit(0.0), "taken": F.lit(1), "kept": F.lit(True)})


OVER_DOCUMENTS = {
    "identify": langid.identify,
    "report": pii.report,
    "redact": pii.redact,
    "mix": mixing.mix,
    "similar": ngram_join.similar,
    "licenses": licenses.scan_licenses,
    "quality": quality.quality,
    "dedup": suffix.dedup,
}


@pytest.mark.parametrize("name", OVER_DOCUMENTS)
def test_edge_cases_keep_every_row(spark, name):
    f = OVER_DOCUMENTS[name]
    assert f(edge(spark)).count() == 7
    assert f(edge(spark).where("doc_id < 0")).count() == 0


@pytest.mark.parametrize("name", sorted(SQL))
def test_query_agrees_with_sql(spark, con, name):
    got, want = QUERIES[name](spark, DATA), con.sql(SQL[name])
    assert sorted(got.columns) == sorted(want.columns)
    cols, at = sorted(got.columns), {c: i for i, c in enumerate(want.columns)}
    norm = lambda v: float(f"{v:.9g}") if isinstance(v, float) else v
    assert sorted(str([norm(r[c]) for c in cols]) for r in got.collect()) == sorted(str([norm(r[at[c]]) for c in cols]) for r in want.fetchall())


# ---- language ----


def test_forward_sums_all_segmentations():
    vocab = [langid.MARK, "a", "b", "ab", langid.MARK + "a", "ba"]
    p = np.array([[0.1], [0.2], [0.3], [0.1], [0.2], [0.1]])
    lattice = langid.Lattice(vocab)
    prob = dict(zip(vocab, p[:, 0]))

    def brute(s):
        return 1.0 if not s else sum(prob[s[:k]] * brute(s[k:]) for k in range(1, len(s) + 1) if s[:k] in prob)

    for w in ("a", "ab", "abab", "bba"):
        assert math.isclose(lattice.score([w], lattice.weights(p))[0, 0], math.log(brute(langid.MARK + w)), rel_tol=1e-9)


def test_language_held_out_accuracy(spark):
    docs = spark.read.parquet("/root/testdata/sf0.01/documents.parquet")
    got = by_id(langid.identify(docs))
    held = [r for r in docs.select("doc_id", "lang").collect() if got[r.doc_id].held_out]
    assert len(held) > 150 and sum(got[r.doc_id].lang_pred == r.lang for r in held) >= 0.97 * len(held)
    assert all(0 <= r.score <= 1 for r in got.values())


def test_language_without_letters_or_labels(spark):
    df = spark.createDataFrame([(1, "12 %", "en"), (2, None, "en"), (3, "word", None)], "doc_id long, text string, lang string")
    got = by_id(langid.identify(df))
    assert (got[1].lang_pred, got[2].lang_pred, got[1].score) == ("und", "und", 0.0)
    assert by_id(langid.identify(df.where("doc_id = 3")))[3].lang_pred == "und"


# ---- html ----


def test_article_without_boilerplate():
    page = """<html><head><title>T</title><style>p{}</style><script>var t="</p>";</script></head><body><header><h1>Site</h1></header><nav><ul><li><a href="/">Home</a></ul></nav>
    <div class="cookie-notice">We use cookies on this site, accept them please.</div><div class="ad">Buy now</div><article><h1>A &amp; B</h1><p>First   long paragraph of the text,<br>with a break &copy; 2020.<p>Short.<p><b>Bold long paragraph that goes on and on.<br>
    <p>More of the article, at some length too.</p><form><input name=q><p>Search</p></form></article><aside><p>Related things that are quite long as well, but not the article.</p></aside><section id="comments"><p>Great article, thanks a lot for writing this up!</p></section><footer>&copy; me</footer></body></html>"""
    assert html.main_text(page).split("\n") == ["A & B", "First long paragraph of the text, with a break © 2020.", "Short.", "Bold long paragraph that goes on and on.", "More of the article, at some length too."]


@pytest.mark.parametrize("page", [None, "", "<p", "<nav>menu</nav>", "<!-- only -->", "<script>x"])
def test_pages_without_text(page):
    assert html.main_text(page) == ""


def test_cut_off_and_plain_pages():
    assert html.main_text("<div><p>Some text here &amp; there<p>and then cut o</arti") == "Some text here & there\nand then cut o"
    assert html.main_text("a < b and c") == "a < b and c"
    assert html.main_text("<p>x</p>" + "<div>" * 3000 + "deep") != ""


def test_generated_pages_lose_nothing(spark):
    for r in spark.read.parquet(f"{DATA}/pages.parquet").collect():
        body = re.search(r"<article>(.*?)(?:</article>|$)", r.html, re.S)[1]
        want = [" ".join(__import__("html").unescape(re.sub(r"<[^>]*>?", " ", x)).split()) for x in re.split(r"</?(?:p|h1)\b[^>]*>", body)]
        assert html.main_text(r.html) == "\n".join(x for x in want if x)


PARTS = "".join(f"<p>Paragraph number {i} holds a good deal of running text, as articles do, and goes on for some while.</p>" for i in range(6))
MENU = "<nav><ul>" + "<li><a href=/>Home</a></li>" * 6 + "</ul></nav>"


@pytest.mark.parametrize(
    ("page", "blocks"),
    [
        (f'<body>{MENU}<div class="content has-sidebar"><h1>Title of it</h1>{PARTS}</div><footer>c</footer>', 7),
        (f'<body><form id="aspnetForm">{MENU}<h1>Title of it</h1>{PARTS}</form>', 7),
        (f'<article><h1>T</h1>{PARTS}<h2 id="discussion">Discussion</h2><p id="search-1">Short.</p></article>', 9),
        (f"<body>{MENU}<div><p>One short.</p><p>Two short.</p><div>{PARTS}</div></div>", 8),
        ("<div>x" * 1000, 1000),
        (f"<main>{PARTS}<article><p>A reader wrote this comment, which is nested and so not a part of it.</p></article></main>", 6),
        (f"<body><div role=navigation>Some way around</div>{PARTS}<aside><p>Not so.</p></aside>", 6),
    ],
)
def test_region_is_chosen_by_ratio_not_by_class_names(page, blocks):
    assert len(html.main_text(page).split("\n")) == blocks


@pytest.mark.parametrize("page", ["<div>" * 100_000, "<span>x" * 100_000 + "<p>y" * 1000, "<" * 100_000, "<!--" * 100_000, "<a " * 50_000, '<a b="' * 50_000 + ">", "<p><b>x" * 50_000, "<ul><li>x" * 50_000, "</" * 50_000 + ">", "<script>" * 50_000])
def test_time_grows_with_length_only(page):
    began = time.process_time()
    html.main_text(page)
    assert time.process_time() - began < 10


def test_extract_on_edge_tables(spark):
    page = f"<body>{MENU}<h1>Title of it</h1>{PARTS}"
    rows = [(1, "u", None), (2, None, ""), (3, "u", page), (3, "u", page), (None, "u", "<p>a</p>"), (4, "u", "<p>" + "word " * 200_000)]
    pages = spark.createDataFrame(rows, "page_id long, url string, html string").withColumns({"text": F.lit("x"), "n_chars": F.lit(1)})
    got = html.extract(pages).collect()
    assert sorted((r.page_id or 0, r.n_chars) for r in got) == [(0, 1), (1, 0), (2, 0), (3, len(html.main_text(page))), (3, len(html.main_text(page))), (4, 999_999)]
    assert html.extract(pages.limit(0)).collect() == []
    assert html.extract(pages).columns == ["page_id", "url", "text", "n_chars"]


def test_extract_agrees_with_the_articles_of_all_pages(spark):
    """The query's rows against text cut out of each page's source by regular expressions."""
    for r in QUERIES["op2_html_extraction"](spark, DATA).join(spark.read.parquet(f"{DATA}/pages.parquet"), ["page_id", "url"]).collect():
        body = re.search(r"<article>(.*?)(?:</article>|$)", r.html, re.S)[1]
        want = [" ".join(__import__("html").unescape(re.sub(r"<[^>]*>?", " ", x)).split()) for x in re.split(r"</?(?:p|h1)\b[^>]*>", body)]
        assert r.text == "\n".join(x for x in want if x)


# ---- personal data ----


def luhn(s):
    return sum(d if i % 2 == 0 else (2 * d) % 10 + d // 5 for i, d in enumerate(map(int, reversed(s)))) % 10 == 0


def base_spans(t):
    n = lambda s: sum(c.isdigit() for c in s)
    rules = [
        ("email", r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+", lambda s: True),
        ("ip", r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)", lambda s: all(int(x) <= 255 for x in s.split("."))),
        ("card", r"[0-9]([\x20-]?[0-9])+", lambda s: 16 <= n(s) <= 19 and luhn(re.sub("[ -]", "", s))),
        ("phone", r"\+[0-9][\x20().0-9-]+[0-9]", lambda s: 8 <= n(s) <= 15),
    ]
    return [(k, m.start(), m.end()) for k, rx, ok in rules for m in re.finditer(rx, t or "") if ok(m[0])]


TRICKY = ["a@b.c_d@e.f x@y x@y.z.", "1.2.3.4.5.6.7.8 1.2.3.256 0001.02.3.4", "4111 1111 1111 1111 4111-1111-1111-1112 41111111111111111111", "+1 (555) 123-4567 +1+12345678 +49.30.1234567-", "é@é.de ü.x@y-z.org 😀 a@b.co", "9" * 30_000, "1.1.1.1" * 3, "4" * 16 + "- 4000 0000 0000 0000 006", "12 34 56 78 90 12 34 52 8"]


def test_base_spans_by_brute_force(spark, real):
    texts = real.select("doc_id", "text").unionAll(spark.createDataFrame([(10_000 + i, t) for i, t in enumerate(TRICKY)], "doc_id long, text string"))
    got = by_id(pii.report(texts))
    for r in texts.collect():
        want = base_spans(r.text)
        joined = ",".join(f"{k}:{s}:{e}" for k, s, e in want)
        g = got[r.doc_id]
        assert g.base_sha256 == hashlib.sha256(joined.encode()).hexdigest(), r.text[:200]
        assert g.spans.startswith(joined)
        assert (g.n_email, g.n_ip, g.n_card, g.n_phone) == tuple(Counter(k for k, *_ in want)[k] for k in pii.KINDS)


def test_contexts_discover(spark):
    rows = [(i, f"please write to user{i}@site.org today") for i in range(6)] + [(10, "please write to member-20391 today"), (11, "we saw record-20391 here"), (12, "contact other-200391x now")]
    got = by_id(pii.report(spark.createDataFrame(rows, "doc_id long, text string")))
    assert got[10].spans == "context:16:28" and got[11].spans == "" and got[12].spans == ""


def test_redaction(spark):
    df = spark.createDataFrame([(1, "mail a@b.co or 1.2.3.4.", 23), (2, None, None), (3, "clean", 5)], "doc_id long, text string, n_chars long")
    assert [tuple(r) for r in pii.redact(df).orderBy("doc_id").collect()] == [(1, "mail <EMAIL> or <IP>.", 21), (2, None, None), (3, "clean", 5)]


# ---- mixing ----


def test_water_filling(spark):
    src = spark.createDataFrame([("a", 10), ("b", 1000), ("c", 1000), (None, 50)], "source string, source_size long")
    t = {r.source: r.target for r in mixing.targets(src).collect()}
    assert t["a"] == 20.0 and math.isclose(sum(t.values()), 1.5 * 2060) and all(t[k] <= 2 * s for k, s in (("a", 10), ("b", 1000), ("c", 1000), (None, 50)))
    assert (t["b"], t["c"], t[None]) == (1980.0, 990.0, 100.0)  # weights 5, 2, 1, 5: what a and null leave goes 2 to 1


def test_mix_meets_targets_and_repeats(spark, real):
    a = mixing.mix(real).collect()
    per = {}
    names = {r.doc_id: r.source for r in real.collect()}
    for r in a:
        assert 0 <= r.taken <= 2 * r.size
        per.setdefault(names[r.doc_id], [r.target, 0])[1] += r.taken
    assert all(abs(t - n) <= 1 for t, n in per.values())
    assert sorted(map(tuple, a)) == sorted(map(tuple, mixing.mix(real.repartition(7)).collect()))


# ---- near duplicates ----


def brute_components(texts, percent=85):
    sets = {}
    for d, t in texts:
        w = WS.findall((t or "").translate(LOW))
        sets[d] = {tuple(w[i : i + 4]) for i in range(len(w) - 3)} if len(w) >= 4 else ({tuple(w)} if w else set())
    low = {d: d for d in sets}

    def find(x):
        while low[x] != x:
            x = low[x]
        return x

    for a, b in combinations(sorted(sets), 2):
        n = len(sets[a] & sets[b])
        if n and 100 * n >= percent * len(sets[a] | sets[b]):
            x, y = find(a), find(b)
            low[max(x, y)] = min(x, y)
    return {d: (len(sets[d]), find(d)) for d in sets}


@pytest.mark.parametrize("tile", [1, 2, 256])
def test_similar_by_brute_force(spark, tile):
    rng = np.random.default_rng(3)
    texts = []
    for g in range(6):
        base = [f"w{g}_{i}" for i in range(int(rng.integers(5, 120)))]
        for _ in range(7):
            w = list(base)
            for _ in range(int(rng.integers(0, 4))):
                w[int(rng.integers(len(w)))] = f"x{rng.integers(10**6)}"
            texts.append((len(texts) + 1, " ".join(w)))
    texts += [(900, None), (901, ""), (902, "One Two"), (903, "one  two"), (904, "one")]
    got = ngram_join.similar(spark.createDataFrame(texts, "doc_id long, text string"), tile=tile).collect()
    assert {r.doc_id: (r.n_shingles, r.component_id) for r in got} == brute_components(texts)


def test_linked_sets_share_a_signature():
    rng = np.random.default_rng(5)
    bounds = ngram_join.families(85, 1000)
    for _ in range(400):
        n = int(rng.integers(1, 300))
        x = rng.integers(0, 2**63, n, dtype=np.uint64)
        k = int(rng.integers(0, max(1, n // 6) + 1))
        y = np.unique(np.concatenate([x[k // 2 :], rng.integers(0, 2**63, k // 2, dtype=np.uint64)]))
        x = np.unique(x)
        both = len(np.intersect1d(x, y))
        if 100 * both >= 85 * (len(x) + len(y) - both) and both < max(len(x), len(y)):
            assert len(np.intersect1d(ngram_join.signatures(x, 85, bounds), ngram_join.signatures(y, 85, bounds)))


def test_tree_join_prunes_no_link():
    rng = np.random.default_rng(1)
    base = rng.integers(0, 2**63, 60, dtype=np.uint64)
    sets = [np.unique(np.concatenate([base[rng.random(60) < 0.97], rng.integers(0, 2**63, 2, dtype=np.uint64)])) for _ in range(60)]
    links = set(ngram_join.tree_join(sets, list(range(60)), None, 85))
    want = {(a, b) for a, b in combinations(range(60), 2) if 100 * (n := len(np.intersect1d(sets[a], sets[b]))) >= 85 * (len(sets[a]) + len(sets[b]) - n)}
    groups = lambda e: sorted(map(sorted, _groups(60, e)))
    assert groups(links) == groups(want) and all((min(x), max(x)) in want for x in links)


def _groups(n, edges):
    g = [{i} for i in range(n)]
    for a, b in edges:
        if g[a] is not g[b]:
            g[a] |= g[b]
            for i in g[b]:
                g[i] = g[a]
    return {id(x): x for x in g}.values()


def test_components_of_a_chain(spark):
    e = spark.createDataFrame([(i, i + 1) for i in range(50)] + [(100, 101), (7, 7)], "a long, b long")
    got = {r.node: r.component for r in components(e).collect()}
    assert all(got[i] == 0 for i in range(51)) and got[100] == got[101] == 100


# ---- licenses ----


def test_license_base_by_brute_force(spark, real):
    odd = [(9001, "GNU general-public LICENSE, mit license cc by"), (9002, "apache x license"), (9003, licenses.TEMPLATES["bsd"] + " tail"), (9004, "x " + licenses.TEMPLATES["mit"][:300].replace("deal", "DEAL"))]
    df = real.select("doc_id", "text").unionAll(spark.createDataFrame(odd, "doc_id long, text string"))
    got = by_id(licenses.scan_licenses(df))
    for r in df.collect():
        w = re.findall(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", (r.text or "").translate(LOW))
        hits = sorted((i, label) for p, label in licenses.PHRASES.items() for i in range(len(w)) if w[i : i + len(p.split())] == p.split())
        g = got[r.doc_id]
        assert (g.n_words, g.n_base, g.first_word, g.last_word, g.base_labels) == (len(w), len(hits), hits[0][0] if hits else None, hits[-1][0] if hits else None, ",".join(sorted({x for _, x in hits})))
        assert set(filter(None, g.base_labels.split(","))) <= set(g.labels.split(",")) and 0 <= g.score <= 1
    assert got[9003].labels == "bsd" and got[9003].score == 1.0 and got[9004].labels == "mit"


def test_matching_statistics_by_brute_force():
    texts = [[0, 1, 2, 1, 2, 3], [2, 3, 0, 0, 1]]
    a = licenses.Automaton(texts)
    subs = {tuple(t[i:j]) for t in texts for i in range(len(t)) for j in range(i, len(t) + 1)}
    q = [1, 2, 3, 0, 0, 1, 2, 9 % 4, 1, 2, 1]
    want = [max(n for n in range(i + 2) if tuple(q[i + 1 - n : i + 1]) in subs) for i in range(len(q))]
    assert [n for _, n in a.statistics(q)] == want


# ---- quality ----


def test_statistics_by_brute_force(spark, real):
    odd = [(9001, "a b c d e a b c d e f"), (9002, "x x x x x x x"), (9003, "l1 #\nl1 #\n \n \nl1 #"), (9004, None), (9005, "a b c d")]
    df = real.select("doc_id", "text").unionAll(spark.createDataFrame(odd, "doc_id long, text string"))
    got = by_id(quality.statistics(df, "doc_id"))
    for r in df.collect():
        t = r.text or ""
        w = WS.findall(t)
        n = Counter(tuple(w[i : i + 5]) for i in range(len(w) - 4))
        rep = len({i + k for i in range(len(w) - 4) if n[tuple(w[i : i + 5])] > 1 for k in range(5)})
        lines = [x for x in t.split("\n") if WS.search(x)]
        want = (len(w), sum(map(len, w)), sum(c in "#*$%&|<>" for c in t), len(lines) - len(set(lines)), rep)
        g = got[r.doc_id]
        assert (g.n_words, g.word_chars, g.n_symbols, g.n_dup_lines, g.n_repeat_words) == want
        assert g.base_failed == (len(w) < 10 or 100 * rep > 20 * len(w))


def test_outliers_go_and_clean_documents_stay(spark):
    rng = np.random.default_rng(2)
    clean = [(i, " ".join("abcdefgh"[: int(rng.integers(2, 9))] + str(rng.integers(10**4)) for _ in range(60)), "en", "s") for i in range(200)]
    junk = [(1000 + i, " ".join(f"{'#$%&' * 6}{rng.integers(10**6)}" for _ in range(60)), "en", "s") for i in range(30)]
    got = by_id(quality.quality(spark.createDataFrame(clean + junk, DOCS)))
    assert all(got[i].kept for i, *_ in clean) and not any(got[i].kept for i, *_ in junk)


def test_each_feature_rejects_alone(spark):
    rng = np.random.default_rng(6)
    word = lambda: f"w{rng.integers(10**6)}"
    clean = [(i, " ".join(word() for _ in range(300)), "en", "s") for i in range(100)]
    lines = [(1000 + i, "\n".join(f"{word()} {word()} {word()} {word()}\nsame" for _ in range(60)), "en", "s") for i in range(5)]
    symbols = [(2000 + i, " ".join(word() if k % 3 else word()[:-1] + "##" for k in range(300)), "en", "s") for i in range(5)]
    words = [(3000 + i, " ".join([word() for _ in range(250)] + 5 * [phrase := " ".join(word() for _ in range(11))]), "en", "s") for i in range(5)]
    got = by_id(quality.quality(spark.createDataFrame(clean + lines + symbols + words, DOCS)))
    assert all(got[i].kept for i, *_ in clean) and all(got[i].n_dup_lines == 59 for i, *_ in lines)
    assert not any(r.base_failed or r.kept for i, r in got.items() if i >= 1000)


def test_estimates_have_the_least_determinant(spark):
    """Against all subsets of small groups, with outliers in about a quarter of the rows."""
    rng, rows = np.random.default_rng(5), []
    for k in range(3):
        a = rng.normal(size=(4, 4)) * 20_000
        x = rng.normal(size=(12 + k % 2, 4)) @ a.T
        rows += [(f"g{k}", None, *map(int, v)) for v in np.vstack([x, x[: 4 - k % 2] + 2_000_000 * rng.normal(size=(4 - k % 2, 4))]).round()]
    df = spark.createDataFrame(rows, "lang string, source string, f0 long, f1 long, f2 long, f3 long").checkpoint()
    got = {r.lang: r for r in quality.estimates(df).collect()}
    for k in range(3):
        x = np.array([r[2:] for r in rows if r[0] == f"g{k}"], float)
        h = math.ceil(quality.SUPPORT * len(x))
        best = min(combinations(range(len(x)), h), key=lambda c: np.linalg.det(np.cov(x[list(c)].T, bias=True)))
        cov = np.cov(x[list(best)].T, bias=True) * quality.consistency()
        r = got[f"g{k}"]
        assert np.allclose([r[f"c{i}"] for i in range(4)], x[list(best)].mean(0))
        assert np.allclose([r[f"l{i}{j}"] for i in range(4) for j in range(i + 1)], [np.linalg.cholesky(cov)[i, j] for i in range(4) for j in range(i + 1)])
        assert np.isclose(r.det, np.log(np.linalg.det(cov)) / 2)
    d = sorted(r.d2 for r in quality.outliers(df).collect())
    assert 1 < np.median(d) < 10 and sum(x > quality.CUTOFF for x in d) >= 6


def test_singular_groups_and_one_row(spark):
    df = spark.createDataFrame([("a", "s", 5, 0, 0, 0)] * 9 + [("a", "s", 5, 9000, 0, 0), ("b", None, 1, 2, 3, 4)], "lang string, source string, f0 long, f1 long, f2 long, f3 long").checkpoint()
    assert sorted(round(r.d2, 6) for r in quality.outliers(df).collect()) == [0.0] * 10 + [(9000 / (1000 * quality.FEATURES["f1"])) ** 2]


# ---- suffixes ----


@pytest.mark.parametrize("held", [10, 10**6])
def test_suffix_order(held):
    rng = np.random.default_rng(0)
    for size in (1, 2, 50, 3000):
        t = rng.integers(1, 4, size).astype(np.uint16)
        t[rng.random(size) < 0.02] = 0
        b = t.astype(">u2").tobytes()
        sa = suffix.suffix_array(t, 100, held)
        keys = [b[2 * i : 2 * i + 200] for i in sa]
        assert sorted(sa.tolist()) == list(range(size)) and keys == sorted(keys)


def brute_removed(docs, n=100):
    seen, out = {}, {}
    for d, t in sorted(docs):
        b = (t or "").encode()
        gone = bytearray(len(b))
        for i in range(len(b) - n + 1):
            w = b[i : i + n]
            if w in seen:
                gone[i : i + n] = b"\1" * n
            else:
                seen[w] = (d, i)
        kept = bytes(c for c, g in zip(b, gone) if not g)
        out[d] = (len(b), sum(gone), len(re.findall(b"\x01+", bytes(gone))), hashlib.sha256(kept).hexdigest())
    return out


def test_dedup_by_brute_force(spark):
    rng = np.random.default_rng(9)
    word = lambda: "".join("abcdeé"[k] for k in rng.integers(0, 6, 5))
    shared = " ".join(word() for _ in range(60))
    docs = [(1, "x" * 400), (2, None), (3, "short"), (4, "ab" * 150)]
    for i in range(5, 60):
        k = int(rng.integers(0, 200))
        docs.append((i, " ".join(word() for _ in range(int(rng.integers(1, 40)))) + shared[k : k + int(rng.integers(50, 300))] + " ".join(word() for _ in range(int(rng.integers(1, 40))))))
    docs += [(70, docs[10][1]), (71, docs[20][1] + docs[20][1])]
    want = brute_removed(docs)
    for shard, held in ((20_000, 10**6), (3, 50), (1, 50)):
        got = suffix.dedup(spark.createDataFrame(docs, "doc_id long, text string"), shard=shard, held=held).collect()
        assert {r.doc_id: (r.n_bytes, r.n_removed, r.n_spans, r.kept_sha256) for r in got} == want


def test_every_window_is_sorted_once(spark, monkeypatch):
    """Contexts of neighbouring anchors share no window, also where short texts are looked at together."""
    rng = np.random.default_rng(4)
    word = lambda: "".join("abcdeé"[k] for k in rng.integers(0, 6, 5))
    shared = [" ".join(word() for _ in range(30)) for _ in range(4)]
    docs = [(d, " ".join(word() if rng.random() < 0.6 else shared[int(rng.integers(0, 4))] for _ in range(int(rng.integers(1, 12))))) for d in range(60)] + [(60, None), (61, "")]
    got, split = [], suffix._split

    def sees(contexts, most):
        got.extend(contexts.select("oid", "key", "start", "context").collect())
        return split(contexts, most)

    monkeypatch.setattr(suffix, "_split", sees)
    monkeypatch.setattr(suffix, "CHUNK", 700, raising=False)
    rows = suffix.dedup(spark.createDataFrame(docs, "doc_id long, text string")).collect()
    assert {r.doc_id: (r.n_bytes, r.n_removed, r.n_spans, r.kept_sha256) for r in rows} == brute_removed(docs)
    windows = [(r.oid, r.key, r.start + k) for r in got for k in range(len(r.context) - 99)]
    assert len(windows) > 1000 and len(set(windows)) == len(windows)


def test_sort_takes_little_memory(monkeypatch):
    """A sort's arrays are as narrow as its positions, and wider ones give the same."""
    rng = np.random.default_rng(5)
    words = ["".join("abcdefghijkl"[k] for k in rng.integers(0, 12, rng.integers(2, 9))) for _ in range(300)]
    text = " ".join(words[k] for k in rng.integers(0, 300, 30_000)).encode()
    contexts = [text[a : a + 133] for a in rng.integers(0, len(text) - 133, 12_000)]
    tracemalloc.start()
    try:
        got = suffix.repeats(contexts, np.arange(len(contexts)) << 32)
        peak = tracemalloc.get_traced_memory()[1]
    finally:
        tracemalloc.stop()
    assert sum(map(len, got)) > 10_000 and peak < 50 * sum(map(len, contexts))
    t = rng.integers(0, 5, 2000).astype(np.uint16)
    narrow = suffix.suffix_array(t, 100, 50)
    monkeypatch.setattr(suffix, "_kind", lambda n: np.int64)
    wide = suffix.suffix_array(t, 100, 50)
    assert narrow.dtype == np.int32 and wide.dtype == np.int64 and narrow.tolist() == wide.tolist()


def test_anchors_are_sorted_once(spark):
    """(oid, anchor, ctx, again): an equal context that came earlier makes a row late, another one its anchor mixed."""
    rows = [(1, 7, 1, False), (2, 7, 2, False), (3, 7, 1, False), (4, 8, 5, False), (5, 8, 5, False), (6, 9, 5, False), (7, 7, 3, True), (8, 9, 6, True)]
    place = 300 << 16 | 4 << 8 | 2
    df = spark.createDataFrame([(o, 0, a, c, place, g) for o, a, c, g in rows], "oid long, key long, anchor long, ctx long, place long, again boolean")
    out = suffix._compared(df)
    assert {r.oid: (r.first, r.last, r.off, r.mixed, r.late) for r in out.collect()} == {o: (300, 304, 2, o < 4, o not in (1, 2)) for o in (1, 2, 3, 5, 7, 8)}
    assert {r.oid: r.anchor for r in out.where("mixed").collect()} == {1: 7, 2: 7, 3: 7}
    plan = out._jdf.queryExecution().sparkPlan().toString(), out._jdf.queryExecution().executedPlan().toString()
    assert plan[0].count("Window [") == 2 and len(re.findall(r"\bSort \[", plan[1].split("== Initial Plan ==")[-1])) == 1


# ---- chat ----


def test_template_language():
    render = chat.compile_template("{% if role == 'a' + 'b' %}x{{ text | upper }}{% else %}{% if 'p' != 'p' %}never{% endif %}[{{ role }}]{% endif %}")
    assert render("ab", "q")[0] == "xQ" and render("c", "q")[0] == "[c]"
    assert chat.fold(chat.parse("{% if 'a' == 'a' %}y{{ 'z' | upper }}{% endif %}")) == [("out", ("const", "yZ"))]
    for bad in ("{{ role.__class__ }}", "{{ open('x') }}", "{% for x in y %}", "{{ other }}", "{{ text | eval }}", "{% if role %}"):
        with pytest.raises(chat.TemplateError):
            chat.compile_template(bad)


def test_round_trip():
    render = chat.compile_template()
    turns = [("user", "</s>[INST] ok [/INST]"), ("assistant", "\\</s>\n[TURN]x[TEXT]"), ("system", ""), ("assistant", "</s>\n\\"), ("we[TEXT]ird", "é😀")]
    out = [render(*t) for t in turns]
    assert chat.read_back("".join(x for x, _ in out)) == turns
    assert [chat.unescape(x[s:e]) for x, spans in out for s, e in spans] == [t for r, t in turns if r == "assistant"]
    with pytest.raises(ValueError):
        chat.read_back("[TURN]a")


def test_chat_edges(spark):
    rows = [(None, 1, "user", None), (1, 0, None, "x"), (1, 0, None, "x"), (1, None, "assistant", "y")]
    df = spark.createDataFrame(rows, "conv_id long, turn long, role string, text string").withColumn("formatted", F.lit(1))
    got = {r.conv_id: (r.n_turns, r.loss_chars) for r in chat.digests(df).collect()}
    assert got == {None: (1, 0), 1: (3, 1)} and chat.digests(df.where("false")).count() == 0


# ---- decontamination ----


def test_contamination_edges_and_blocks(spark, monkeypatch):
    docs = spark.createDataFrame([(1, "The CAT sat on the mat and then it ran, away"), (2, None), (3, "a tiny item"), (3, "a tiny item"), (None, "tiny, Item!")], "doc_id long, text string")
    bench = spark.createDataFrame([(7, "the cat sat on the mat and then it ran home"), (8, "tiny item"), (8, "tiny item"), (9, None), (None, "...")], "item_id long, text string")
    want = [(None, 2, 2, 1, "8"), (1, 11, 10, 1, "7"), (2, 0, 0, 0, ""), (3, 3, 2, 1, "8"), (3, 3, 2, 1, "8")]
    for size in (10**6, 5):
        monkeypatch.setattr(decontam, "BLOCK_BYTES", size)
        got = decontam.contamination(docs, bench).collect()
        assert sorted(((r.doc_id, r.n_words, r.n_hit, r.n_items, r.items_sha256) for r in got), key=str) == sorted(((*w[:4], hashlib.sha256(w[4].encode()).hexdigest()) for w in want), key=str)
    assert decontam.decontaminate(docs, bench).count() == 1
    cut = [r.text for r in decontam.decontaminate(docs, bench, remove="spans").orderBy("doc_id", "text").collect()]
    assert cut == ["!", ", away", None, "a ", "a "]
    assert decontam.contamination(docs, bench.where("false")).where("contaminated").count() == 0


# ---- sizes and switches change nothing ----


def test_long_words_are_scored_like_short_ones():
    lattice = langid.Lattice(langid.pieces())
    w = lattice.weights(np.random.default_rng(0).dirichlet(np.ones(lattice.size), 3).T)
    words = ["tree", "internationalisation" * 4, "verylongword" * 20, "ab" * 700]
    for word, got in zip(words, lattice.score(words, w)):
        codes, n = lattice.codes([word])
        ids, log = lattice.ids(codes), [np.zeros(3)]
        for j in range(1, int(n[0]) + 1):
            log.append(np.logaddexp.reduce([log[j - k] + np.log(np.maximum(w[ids[k - 1][0, j - k]], 1e-300)) for k in range(1, min(len(ids), j) + 1)]))
        assert np.allclose(got, log[-1] - n[0] * np.log(langid.SCALE), rtol=1e-9)


def test_numerals_are_no_letters(spark):
    assert langid._letters("½ ² ① a½b") == ["a", "b"]
    docs = spark.createDataFrame([(k, "the cat sat on the mat", "en") for k in range(8)] + [(9, "½ ² ①", "en")], "doc_id long, text string, lang string")
    assert by_id(langid.identify(docs))[9].lang_pred == "und"


def test_licenses_need_the_order_of_their_template():
    s, w = licenses.Scanner(), licenses.TEMPLATES["bsd"].split()
    backwards = [x for k in range(len(w) // 12, -1, -1) for x in w[12 * k : 12 * k + 12]]
    assert s.scan(" ".join(backwards))["spans"] == []
    twice = s.scan("a b " + " ".join(w) + " c d " + " ".join(w))["spans"]
    assert [(x[0], x[3]) for x in twice] == [("bsd", 1.0)] * 2 and twice[0][1] == 2 and twice[1][1] == twice[0][2] + 2
    for name, text in licenses.TEMPLATES.items():
        assert name in {x[0] for x in s.scan("so it says here: " + text)["spans"]}


def test_chain_is_the_longest_rising_one():
    rng = np.random.default_rng(3)
    for _ in range(50):
        points = [(i, int(t)) for i, t in enumerate(rng.integers(0, 12, 14))]
        c = licenses.Chain()
        for p in points:
            c.add(p)
        best = max(sum(1 for _ in x) for n in range(1, 8) for x in combinations(points, n) if all(a[1] < b[1] for a, b in zip(x, x[1:])))
        assert min(7, len(c.best())) == best and all(a[0] < b[0] and a[1] < b[1] for a, b in zip(c.best(), c.best()[1:]))


@pytest.mark.parametrize("block", [5, 60, 10**9])
def test_blocks_of_the_benchmark_change_nothing(spark, monkeypatch, block):
    monkeypatch.setattr(decontam, "BLOCK_BYTES", block)
    monkeypatch.setattr(decontam, "PASSES", 2)
    bench = spark.createDataFrame([("p", "a1 a2 a3 a4"), ("q", "a3 a4 a5 a6"), ("r", None), ("r", "one"), ("s", "b1 b2 b3 b4 b5"), ("t", "b2 b3 b4 b5 b6")], "item_id string, text string")
    docs = spark.createDataFrame([(1, "z A1, a2 a3 a4 a5 a6. y", 5), (2, None, 0), (3, "b1 b2 b3 b4 b5 b6 c", 1), (4, "", 0), (5, "one by one", 9)], "doc_id long, text string, n_chars long").withColumn("hits", F.lit("x"))
    got = by_id(decontam.decontaminate(docs, bench, remove="spans", n=4))
    assert {k: r.text for k, r in got.items()} == {1: "z . y", 2: None, 3: " c", 4: "", 5: " by "}
    assert got[1].n_chars == 5 and got[1].hits == "x"
    assert sorted(by_id(decontam.decontaminate(docs, bench, n=4))) == [2, 4]
    n = by_id(decontam.contamination(docs, bench, n=4))
    assert [(n[k].n_words, n[k].n_hit, n[k].n_items) for k in (1, 2, 3, 5)] == [(8, 6, 2), (0, 0, 0), (7, 6, 2), (3, 2, 1)]
    assert n[3].items_sha256 == hashlib.sha256(b"s,t").hexdigest()
    assert decontam.contamination(docs.limit(0), bench).collect() == [] and not any(r.contaminated for r in decontam.contamination(docs, bench.limit(0)).collect())


def test_pieces_of_long_items_hold_every_window(spark, monkeypatch):
    words = [f"w{k}" for k in range(57)]
    docs = spark.createDataFrame([(k, " ".join(words[k : k + 10])) for k in range(48)], "doc_id long, text string")
    monkeypatch.setattr(decontam, "PIECE", 7)
    assert all(r.n_hit == 10 and r.n_items == 1 for r in decontam.contamination(docs, spark.createDataFrame([("x", " ".join(words))], "item_id string, text string")).collect())


def test_equal_digests_are_told_apart(spark, monkeypatch):
    """A first seed under which all sets have one digest is given up."""
    real_nodes = ngram_join._nodes
    monkeypatch.setattr(ngram_join, "_nodes", lambda docs, k, seed: real_nodes(docs, k, seed).withColumn("node", F.lit(7).cast("long")) if seed == 0 else real_nodes(docs, k, seed))
    docs = spark.createDataFrame([(1, "a b c d e f"), (2, "a b c d e f"), (3, "g h i j k l")], "doc_id long, text string")
    assert {r.doc_id: r.component_id for r in ngram_join.similar(docs).collect()} == {1: 1, 2: 1, 3: 3}


def test_a_chain_of_near_copies_over_many_tiles(spark):
    """Neighbours are linked, others are not: components are found across tiles."""
    words = [f"w{k}" for k in range(400)]
    docs = [(k, " ".join(words[3 * k : 3 * k + 100])) for k in range(60)] + [(100 + k, " ".join(words[:100]) + f" tail{k}") for k in range(40)]
    got = {r.doc_id: r.component_id for r in ngram_join.similar(spark.createDataFrame(docs, "doc_id long, text string"), tile=4).collect()}
    assert set(got.values()) == {0} and len(got) == 100


def test_a_shared_passage_makes_no_candidates(spark):
    """One equal part is less than a link needs: documents with a common passage and nothing else alike are not compared."""
    common = " ".join(f"c{k}" for k in range(12))
    docs = spark.createDataFrame([(d, " ".join(f"w{d}_{k}" for k in range(40)) + " " + common) for d in range(200)], "doc_id long, text string")
    assert ngram_join._candidates(docs, 4, 85, 0).count() == 0


def test_what_linked_sets_share_is_what_they_need():
    rng = np.random.default_rng(6)
    bounds, met = ngram_join.families(85, 1000), 0
    for _ in range(600):
        n = int(rng.integers(4, 300))
        x = rng.integers(0, 2**63, n, dtype=np.uint64)
        k = int(rng.integers(1, max(1, n // 6) + 1))
        y = np.unique(np.concatenate([x[k // 2 :], rng.integers(0, 2**63, k - k // 2, dtype=np.uint64)]))
        x = np.unique(x)
        both = len(np.intersect1d(x, y))
        if 100 * both >= 85 * (len(x) + len(y) - both):
            (s, m), (t, o) = ngram_join.signed(x, 85, bounds), ngram_join.signed(y, 85, bounds)
            met += 1
            assert any(np.isin(s[m == a], t[o == b]).sum() >= max(a, b) >> 1 for a in set(m.tolist()) for b in set(o.tolist()))
    assert met > 100


def test_edited_copies_begin_no_link(spark):
    """Copies of one text with many edits each are one block, but only those with few begin a link; the result is brute force's."""
    rng = np.random.default_rng(8)
    base, texts = [f"b{k}" for k in range(150)], []
    for d in range(60):
        w = list(base)
        for p in rng.choice(150, 1 if d < 20 else 14, replace=False):
            w[p] = f"e{d}_{p}"
        texts.append((d, " ".join(w)))
    each = spark.createDataFrame([(d, bytearray(ngram_join.shingle_set(t, 4).tobytes())) for d, t in texts], "node long, set binary")
    assert {r.node for r in ngram_join._prefixes(each, 85).collect()} == set(range(20))
    got = ngram_join.similar(spark.createDataFrame(texts, "doc_id long, text string"), tile=8).collect()
    assert {r.doc_id: (r.n_shingles, r.component_id) for r in got} == brute_components(texts)


def test_hot_passages_are_parted(spark):
    """Passages of 40 to 130 bytes in every document, with other text around: shards of two contexts part them down to single windows."""
    rng = np.random.default_rng(1)
    word = lambda n: "".join("abcdefghij"[k] for k in rng.integers(0, 10, n))
    long, short, mid = word(130), word(40), word(104)
    docs = [(k, f"{word(60)} {long} {word(50)} {short} {word(60)} {mid} {word(40)}") for k in range(30)]
    want = brute_removed(docs)
    got = suffix.dedup(spark.createDataFrame([(str(d), t) for d, t in docs], "doc_id string, text string").withColumns({"oid": F.lit(1), "key": F.lit(2)}), shard=2, held=100).collect()
    assert {int(r.doc_id): (r.n_bytes, r.n_removed, r.n_spans, r.kept_sha256) for r in got} == want


PROSE = "This is a paragraph of the article with many words, so that the ratio of its text to its tags is high. "


@pytest.mark.parametrize(
    "page",
    [
        "<html><head><title>T</title><body><article>{}</article>",
        "<html><head><title>T<body><article>{}</article>",
        "<head><meta charset=utf-8><article>{}</article>",
        "<body><button>Share<article>{}</article></body>",
        "<body><select><option>a<option>b<div>{}</div>",
        "<body><canvas>no canvas<div>{}</div>",
        "<script>var s = '<!--';</script><article>{}</article>",
        "<style>/* <!-- */</style><article>{}</article>",
        "<img alt='<!--'><article>{}</article><p title='-'>",
        "<article>{}</article><!-- a comment without end <p>gone</p>",
    ],
)
def test_left_out_end_tags_lose_no_page(page):
    assert html.main_text(page.format(f"<p>{PROSE}</p><p>{PROSE}</p>")) == "\n".join([PROSE.strip()] * 2)


def test_hidden_elements_with_end_tags_stay_hidden():
    page = f"<body><button><div>Share</div></button><select><option>a</select><article><p>{PROSE}</p><p>{PROSE}<button>Copy</button></p></article></body>"
    assert html.main_text(page) == "\n".join([PROSE.strip()] * 2)


COMMENTS = {
    "times": "<div class=x><h3>Two remarks</h3><div><b>Ann</b> 12:30<p>I like this text very much, it is great.</p></div><div><b>Bob</b> 12:35<p>I do not like it, and here is why, dear writer.</p></div></div>",
    "replies": "<section><div><p>Ann<p>I like this text very much indeed.<p><a href=r>Reply</a></div><div><p>Bob<p>Not so good, I would say.<p><a href=r>Reply</a></div></section>",
    "label": "<div><p>Anzeige</p><p>Buy these wonderful shoes now at half price, today only.</p></div>",
    "link": "<div><a href=x>Buy these wonderful shoes now</a></div>",
}


@pytest.mark.parametrize("inside", [False, True])
@pytest.mark.parametrize("name", COMMENTS)
def test_comments_and_advertisements_by_structure(name, inside):
    text = f"<h1>Title</h1><p>{PROSE * 3}</p><p>{PROSE * 2}</p>"
    page = f"<body><main>{text}{COMMENTS[name]}</main></body>" if inside else f"<body><div>{text}</div>{COMMENTS[name]}</body>"
    assert html.main_text(page) == "\n".join(["Title", (PROSE * 3).strip(), (PROSE * 2).strip()])


def test_sections_of_an_article_are_no_comments():
    page = "<body><article><h1>T</h1>" + "".join(f"<section><h2>Part {i}</h2><p>{PROSE}</p><p>In 2019 it was so.</p></section>" for i in range(3)) + "</article></body>"
    assert html.main_text(page).count("Part") == 3 and html.main_text(page).count("2019") == 3


@pytest.mark.parametrize("page", ["<div>" * 20000 + "x", "<div>x" * 20000, "<button>" * 20000, "<head>" * 20000, "<script>" + "<!--" * 20000, "<p title='" + "<!--" * 2000 + "'>x"])
def test_odd_pages_take_little_time(page):
    began = time.time()
    html.main_text(page)
    assert time.time() - began < 5

"""Importance resampling, packing and collocations against brute force and on edge tables."""

import glob
import hashlib
import math
import os
import re
import time
import zlib
from collections import Counter

import duckdb
import numpy as np
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from granary.llm import collocations, packing, resample
from granary.llm.common import ready
from granary.llm.queries import QUERIES, SQL

DATA = "/root/testdata/sf0.001"
LOW = {i: i + 32 for i in range(65, 91)}


@pytest.fixture(scope="module", autouse=True)
def checkpoints(spark):
    ready(spark)


@pytest.fixture(scope="module")
def real(spark):
    return spark.read.parquet(f"{DATA}/documents.parquet").select("doc_id", "text", "lang").collect()


@pytest.mark.parametrize("name", ["op11_importance_resampling", "op13_phrase_collocations"])
def test_agrees_with_sql(spark, name):
    con = duckdb.connect()
    for p in glob.glob(f"{DATA}/*.parquet"):
        con.sql(f"create view {os.path.basename(p)[:-8]} as select * from '{p}'")
    want = con.sql(SQL[name])
    got = QUERIES[name](spark, DATA)
    assert sorted(got.columns) == sorted(want.columns)
    assert sorted(map(str, got.select(*want.columns).collect())) == sorted(str(r) for r in spark.createDataFrame(want.fetchall(), got.select(*want.columns).schema).collect())


# --- resampling


def drawn(docs, target, n, buckets, least, share, seed):
    words = lambda t: re.findall(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", (t or "").translate(LOW))
    feats = lambda t: [" ".join(w[i : i + k]) for w in [words(t)] for k in range(1, n + 1) for i in range(len(w) - k + 1)]
    bucket = lambda f: zlib.crc32(f.encode()) % buckets
    s, t = Counter(bucket(f) for _, x in docs for f in feats(x)), Counter(bucket(f) for x in target for f in feats(x))
    alls, allt = sum(s.values()), sum(t.values())
    gain = {b: math.floor(1000 * math.log((t[b] + 1) * (alls + buckets) / ((s[b] + 1) * (allt + buckets)))) for b in s}
    out = []
    for d, x in docs:
        f = feats(x)
        h = int(hashlib.sha256(f"{seed}{'' if d is None else d}".encode()).hexdigest()[:8], 16)
        w = sum(gain[bucket(g)] for g in f)
        out.append([d, len(f), w, w + math.floor(-1000 * math.log(-math.log((h + 0.5) / 4294967296))), None, len(words(x))])
    able = sorted((r for r in out if r[5] >= least), key=lambda r: (-r[3], r[0] is None, r[0] or 0))
    for i, r in enumerate(able[: len(able) * share // 100]):
        r[4] = i + 1
    return [tuple(r[:5]) for r in out]


@pytest.mark.parametrize("n", [1, 3])
def test_resampling_by_brute_force(spark, real, n):
    docs = [(r.doc_id, r.text) for r in real] + [(-1, None), (-2, ""), (-3, "ÄÖ É Straße straße " * 9), (None, "some words " * 12)]
    target = [r.text for r in spark.read.parquet(f"{DATA}/benchmark.parquet").collect()] + [None, ""]
    df, t = spark.createDataFrame([(d, x, 7, "w") for d, x in docs], "doc_id long, text string, rank int, weight string").repartition(3), spark.createDataFrame([(x,) for x in target], "text string")
    got = [tuple(r) for r in resample.resample(df, t, n=n, buckets=500, min_words=15, share=30).collect()]
    assert sorted(got, key=str) == sorted(drawn(docs, target, n, 500, 15, 30, "2024:"), key=str)


def test_resampling_of_equal_rows_and_empty_tables(spark):
    text = "words that repeat " * 10
    got = resample.resample(spark.createDataFrame([(1, text)] * 6, "doc_id long, text string"), spark.createDataFrame([], "text string"), share=50).collect()
    assert len(got) == 6 and len({r.score for r in got}) == 1 and sorted(r.rank for r in got if r.rank) == [1, 2, 3]
    assert resample.resample(spark.createDataFrame([], "doc_id long, text string"), spark.createDataFrame([], "text string")).count() == 0


def test_ranks_over_many_partitions(spark):
    rows = spark.range(0, 5000, numPartitions=13).select(F.col("id").alias("doc_id"), F.pmod(F.xxhash64("id"), F.lit(7)).alias("score"))
    got = resample.ranked(rows, F.desc("score"), F.asc("doc_id")).orderBy("at").collect()
    assert [r.at for r in got] == list(range(5000))
    assert [(-r.score, r.doc_id) for r in got] == sorted((-r.score, r.doc_id) for r in got)


# --- packing


@pytest.fixture(scope="module")
def tokens():
    import public_tokenizers
    from tokenizers import Tokenizer

    t = Tokenizer.from_file(public_tokenizers.path("byte_bpe_50k.json"))
    t.encode_special_tokens = True
    return lambda text: [*t.encode(text or "", add_special_tokens=False).ids, 0]


@settings(max_examples=300, deadline=None)
@given(text=st.text(alphabet=st.one_of(st.characters(codec="utf-8"), st.sampled_from(" \n\t'ab.1 \x1c\x85"))), size=st.integers(1, 9))
def test_ids_are_those_of_the_tokenizers_library(tokens, text, size):
    assert packing.encoded(known(), text, size).tolist() == tokens(text)


def known(kept=[]):  # noqa: B006
    return kept[0] if kept else kept.append(packing.load_tokenizer(None)) or kept[0]


def checked(rows, ids, most):
    """Whatever the combinations: pieces and places of each row as the contract has them."""
    bins = {}
    for r in rows:
        bins.setdefault(r.sequence_id, []).append((r.offset, r.length))
    for b in bins.values():
        at = 0
        for offset, n in sorted(b):
            assert offset == at
            at += n
        assert at <= most
    found = Counter((r.doc_id, r.piece, r.start, r.length, r.ids_crc32) for r in rows)
    want = Counter()
    for d, x in ids:
        first = len(x) if len(x) <= most else len(x) % most or most
        for p, (s, e) in enumerate([(0, first)] + [(s, s + most) for s in range(first, len(x), most)]):
            want[d, p, s, e - s, zlib.crc32(np.array(x[s:e], "<u4").tobytes())] += 1
    assert found == want
    return len(bins)


def test_packing_by_brute_force(spark, real, tokens):
    ids = [(r.doc_id, tokens(r.text)) for r in real]
    rows = QUERIES["op12_minimum_bin_slack"](spark, DATA).collect()
    bins, total = checked(rows, ids, 2048), sum(len(x) for _, x in ids)
    assert bins <= math.ceil(total / 2048) + 2


@pytest.mark.parametrize("most", [1, 7, 64])
def test_packing_edges(spark, tokens, most):
    texts = [(1, None), (2, ""), (3, "a b c d e f g h i j k l m n"), (3, "a b c d e f g h i j k l m n"), (None, "x " * 50), (5, "<|endoftext|>")]
    df = spark.createDataFrame([(*t, 1) for t in texts], "doc_id long, text string, length int")
    packed = packing.pack(df, most=most)
    rows = packed.collect()
    checked(rows, [(d, tokens(x)) for d, x in texts], most)
    whole = {r.sequence_id: np.frombuffer(r.ids, "<u4").tolist() for r in packing.sequences(spark.createDataFrame(rows, packed.schema)).collect()}
    for r in rows:
        assert whole[r.sequence_id][r.offset : r.offset + r.length] == np.frombuffer(r.ids, "<u4").tolist()
    assert packing.pack(df.limit(0)).count() == 0


@settings(max_examples=200, deadline=None)
@given(left=st.dictionaries(st.integers(1, 30), st.integers(1, 4), min_size=1, max_size=8), room=st.integers(0, 60))
def test_fullest_is_the_best_of_all_multisets(left, room):
    sums = {0}
    for n, c in left.items():
        sums = {s + n * k for s in sums for k in range(c + 1)}
    used = packing.fullest(left, room)
    assert all(used[n] <= left[n] for n in used) and sum(n * c for n, c in used.items()) == max(s for s in sums if s <= room)


def test_combinations_use_up_the_histogram():
    r = np.random.default_rng(1)
    histogram = Counter(np.minimum(2048, r.lognormal(6, 1, 20000).astype(int) + 1).tolist())
    used, bins = Counter(), 0
    for times, c in packing.combinations(dict(histogram), 2048):
        assert sum(n * k for n, k in c.items()) <= 2048
        bins += times
        for n, k in c.items():
            used[n] += k * times
    assert used == histogram and bins <= math.ceil(sum(n * c for n, c in histogram.items()) / 2048) + 3


# --- collocations


def mined(docs, longest, least, top, cover):
    f, n = Counter(), Counter()
    for text, lang in docs:
        lang = "und" if lang is None else lang
        for piece in re.split(r"[.,;:!?\x0A-\x0D]", (text or "").translate(LOW)):
            w = re.findall(r"[^\x20\x09]+", piece)
            n[lang] += len(w)
            f.update((lang, tuple(w[i : i + k])) for k in range(1, longest + 1) for i in range(len(w) - k + 1))
    held = {x: c for x, c in f.items() if len(x[1]) > 1 and c >= least}
    gone = {(lang, y[i:j]) for (lang, y), c in held.items() for i in range(len(y)) for j in range(i + 2, len(y) + 1) if j - i < len(y) and (lang, y[i:j]) in held and 100 * c >= cover * held[lang, y[i:j]]}
    rows = {}
    for (lang, x), a in held.items():
        if (lang, x) not in gone:
            s, k = min((1000 * a * n[lang] // (f[lang, x[:k]] * f[lang, x[k:]]), k) for k in range(1, len(x)))
            rows.setdefault(lang, []).append((-s, -a, " ".join(x).encode(), f[lang, x[:k]], f[lang, x[k:]]))
    return sorted((lang, i + 1, p.decode(), -a, l, r, n[lang], -s) for lang, x in rows.items() for i, (s, a, p, l, r) in enumerate(sorted(x)[:top]))


EDGES = [(None, "en"), ("", None), ("a b a b a b a b", None), ("a b a b", "und"), ("A B. a b,c d\na\tb", "en"), ("é É x é É x é", "fr"), ("x " * 300, "en"), ("one two three four five six " * 6, "de")]


@pytest.mark.parametrize("least, cover, top", [(2, 100, 2000), (3, 60, 5)])
def test_collocations_by_brute_force(spark, real, monkeypatch, least, cover, top):
    monkeypatch.setattr(collocations, "TEXT", 200)
    monkeypatch.setattr(collocations, "BLOCK", 500)
    monkeypatch.setattr(collocations, "CHUNK", 64)
    monkeypatch.setattr(collocations, "FAN", 2)
    docs = EDGES + [(r.text, r.lang) for r in real[:40]]
    df = spark.createDataFrame([(t, lang, 1) for t, lang in docs], "text string, lang string, n int").repartition(7)
    got = collocations.collocations(df, least=least, cover=cover, top=top)
    assert sorted(map(tuple, got.collect())) == mined(docs, 5, least, top, cover)


def test_collocations_of_nothing(spark):
    schema = "text string, lang string"
    assert collocations.collocations(spark.createDataFrame([], schema)).count() == 0
    assert collocations.collocations(spark.createDataFrame([("a b", "en"), (None, None)], schema)).count() == 0


def test_partitions_that_change_between_passes(spark):
    docs = [("a b c a b c", "en")] * 30 + [(f"d{i} e f", "en") for i in range(30)]
    df = spark.createDataFrame(docs, "text string, lang string").repartition(5, F.rand())
    assert sorted(map(tuple, collocations.collocations(df, least=5).collect())) == mined(docs, 5, 5, 2000, 100)


def test_phrases_with_equal_keys_are_told_apart(spark, monkeypatch):
    plain = collocations.Words.key

    def key(self, k, which=0):
        x = plain(self, k, which)
        return x if which or self.seed else x & np.uint64(0xFFF0000000000000)  # 4096 keys under the first seed

    monkeypatch.setattr(collocations.Words, "key", key)
    docs = [(" ".join(f"w{(i * 7 + j) % 90}" for j in range(60)), "en") for i in range(40)]
    df = spark.createDataFrame(docs, "text string, lang string")
    assert sorted(map(tuple, collocations.collocations(df, least=5).collect())) == mined(docs, 5, 5, 2000, 100)


def test_scores_beyond_64_bits(spark):
    a, n, l, r = 10**13, 10**16, 3 * 10**13, 7 * 10**12
    got = spark.sql(f"SELECT cast({a} as bigint) a, cast({n} as bigint) n, cast({l} as bigint) l, cast({r} as bigint) r").select(collocations.score()).first()[0]
    assert got == 1000 * a * n // (l * r)


def test_perfect_hash_is_minimal_and_perfect():
    for n in (0, 1, 2, 1000, 50000):
        keys = np.unique(np.random.default_rng(n).integers(0, 1 << 63, n).astype(np.uint64))
        h = collocations.PerfectHash(keys)
        assert sorted(h.slots(keys).tolist()) == list(range(len(keys)))
        others = h.slots(keys + np.uint64(1))
        assert ((others >= -1) & (others < max(1, len(keys)))).all()


def test_long_texts_in_time(spark):
    text = "word " * 200_000 + "." + "an other " * 100_000
    began = time.time()
    got = collocations.collocations(spark.createDataFrame([(text, "en")], "text string, lang string")).collect()
    assert time.time() - began < 90
    assert sorted(map(tuple, got)) == mined([(text, "en")], 5, 100, 2000, 100)

"""The pipeline's stages, each against a plain statement of what it must do."""

from pyspark.sql import functions as F

import corpus_pipeline
from granary.llm.common import ready

from .test_operators import DATA, brute_components


def test_stages(spark):
    ready(spark)
    docs = spark.read.parquet(f"{DATA}/documents.parquet")
    kept, ids = docs, lambda d: {r.doc_id for r in d.select("doc_id").collect()}
    for name, stage in corpus_pipeline.STAGES[:-1]:
        before = spark.createDataFrame(kept.collect(), kept.schema)
        kept = stage(spark, before, DATA)
        assert kept.columns == docs.columns and ids(kept) <= ids(before)
        if name == "near_duplicates":
            assert ids(kept) == {c for _, c in brute_components([(r.doc_id, r.text) for r in before.collect()]).values()}
        if name == "language_id":
            assert len(ids(before) - ids(kept)) <= 0.02 * len(ids(before))
        if name == "personal_data":
            assert ids(kept) == ids(before) and not kept.where("text like '%@mail%'").count()
    end = corpus_pipeline.STAGES[-1][1](spark, kept, DATA)
    assert ids(end) == ids(kept)


def test_run_repeats(spark):
    a, b = (sorted(map(tuple, corpus_pipeline.run(spark, DATA).collect())) for _ in range(2))
    assert a == b and a


def test_one_of_each_group_stays(spark):
    ready(spark)
    rows = [(1, "a b c d e f g h i j"), (2, "a b c d e f g h i j"), (1, "a b c d e f g h i j"), (3, None), (4, "other words are here for you")]
    got = corpus_pipeline.near_duplicates(spark, spark.createDataFrame(rows, "doc_id long, text string"), DATA)
    assert sorted(r.doc_id for r in got.collect()) == [1, 3, 4]


def brute_kept(texts, k, percent):
    sets = {}
    for d, t in texts:
        w = t.split()
        sets[d] = {tuple(w[i : i + k]) for i in range(len(w) - k + 1)} if len(w) >= k else {tuple(w)}
    low = {d: d for d in sets}
    for _ in sets:
        for a in sets:
            for b in sets:
                if 100 * len(sets[a] & sets[b]) >= percent * len(sets[a] | sets[b]):
                    low[a] = low[b] = min(low[a], low[b])
    return {low[d] for d in sets}


def test_near_copies_of_five_words_and_four_fifths_go(spark):
    ready(spark)
    rows = []
    for g, added in enumerate((15, 22, 24, 25, 26, 40)):  # 100 shingles of five words, and so many more
        base = [f"w{g}_{i}" for i in range(104)]
        rows += [(10 * g + 1, " ".join(base)), (10 * g + 2, " ".join(base + [f"x{g}_{i}" for i in range(added)]))]
    rows += [(101 + j, " ".join(f"e{i}" if not j or i % 25 else f"e{i}_{j}" for i in range(120))) for j in range(3)]
    got = {r.doc_id for r in corpus_pipeline.near_duplicates(spark, spark.createDataFrame(rows, "doc_id long, text string"), DATA).collect()}
    assert got == brute_kept(rows, 5, 80) != brute_kept(rows, 4, 85)
    assert 12 not in got and 32 not in got and 42 in got


def test_stages_on_edge_tables(spark):
    """Nulls in any column, empty and very long texts, equal rows, clashing names, an empty table."""
    rows = [(1, None, None, None, 0), (2, "", "en", "s", 0), (3, "the cat sat on the mat and the dog ran away from it " * 3000, "en", "s", 1), (4, "the dog and the cat are at home today and stay there all day", "en", "s", 2), (4, "the dog and the cat are at home today and stay there all day", "fr", None, 2), (None, "the rain in spain stays mainly in the plain they say", "en", None, 3)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, lang string, source string, n_chars long").withColumns({k: F.lit(7) for k in ("score", "lang_pred", "_kept", "_rows", "_hash", "key", "size")})
    for name, stage in corpus_pipeline.STAGES[:-1]:
        out = stage(spark, docs, DATA)
        assert out.columns == docs.columns and stage(spark, docs.limit(0), DATA).collect() == []
        kept = out.collect()
        assert all(r.score == 7 and r.lang_pred == 7 and r.key == 7 for r in kept)
        assert {r.doc_id for r in kept} >= ({3, 4} if name != "language_id" else set())
        if name == "near_duplicates":
            assert len(kept) == 5 and [r.lang for r in kept if r.doc_id == 4] == ["en"]
    assert corpus_pipeline.STAGES[-1][1](spark, docs, DATA).count() == 6

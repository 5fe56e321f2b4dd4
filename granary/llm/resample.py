"""Importance resampling towards a target distribution of hashed n-grams. SQL functions only.

Texts are exploded into n-gram buckets twice: once for the counts of buckets, once to meet their gains, a broadcast table of at most ``buckets`` rows. A document's buckets are summed in its own task before one narrow row of it is shuffled. Ranks come from a distributed sort: a row's place in its partition, added to the rows of the partitions before.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from granary.llm.common import ascii_lower, ready
from granary.operators.lineage import settled

#: What is not part of a word.
BREAK = r"[\x00-\x2F\x3A-\x60\x7B-\x7F]+"
GRAMS, BUCKETS, MIN_WORDS, SHARE, SEED = 1, 10_000, 20, 10, "2024:"


def _run(words: Column, k: int):
    return lambda at: F.array_join(F.slice(words, at, k), " ")


def grams(words: Column, n: int) -> Column:
    """All runs of 1 to n words, joined by a space, repeats kept."""
    runs = [words]
    for k in range(2, n + 1):
        starts = F.when(F.size(words) >= k, F.sequence(F.lit(1), F.size(words) - (k - 1))).otherwise(F.array().cast("array<int>"))
        runs.append(F.transform(starts, _run(words, k)))
    return F.concat(*runs) if n > 1 else words


def _exploded(docs: DataFrame, n: int, buckets: int, *keep: Column) -> DataFrame:
    """The kept columns, n_words and bucket: a row for each feature of each document, one without a bucket for a document of none."""
    words = docs.select(*keep, F.array_remove(F.split(ascii_lower(F.coalesce("text", F.lit(""))), BREAK, -1), "").alias("_words"))
    hashed = F.transform(grams(F.col("_words"), n), lambda g: (F.crc32(g.cast("binary")) % buckets).cast("int"))
    return words.select(*[c for c in words.columns if c != "_words"], F.size("_words").cast("long").alias("n_words"), F.explode_outer(hashed).alias("bucket"))


def gain_table(docs: DataFrame, target: DataFrame, n: int = GRAMS, buckets: int = BUCKETS) -> DataFrame:
    """(bucket, gain) of the buckets that documents have: floor(1000 ln) of the ratio of the smoothed shares of the target and of the documents."""
    count = lambda df, name: _exploded(df, n, buckets).where("bucket is not null").groupBy("bucket").agg(F.count("*").alias(name))
    both = settled(count(docs, "s").join(count(target, "t"), "bucket", "full").select("bucket", F.coalesce("s", F.lit(0)).alias("s"), F.coalesce("t", F.lit(0)).alias("t")))
    all_s, all_t = (float(x or 0) for x in both.agg(F.sum("s"), F.sum("t")).first())
    ratio = (F.col("t") + 1.0) * F.lit(all_s + buckets) / ((F.col("s") + 1.0) * F.lit(all_t + buckets))
    return both.where("s > 0").select("bucket", F.floor(1000 * F.log(ratio)).cast("long").alias("gain"))


def ranked(rows: DataFrame, *order: Column) -> DataFrame:
    """The rows with ``at``, their place from 0 in the order. Range partitions are sorted apart; only the sizes of partitions are summed up in one task."""
    placed = settled(rows.orderBy(*order).withColumn("at", F.monotonically_increasing_id()))
    part = F.shiftright("at", 33)
    sizes = placed.groupBy(part.alias("part")).agg(F.count("*").alias("n"))
    before = sizes.select("part", (F.sum("n").over(Window.orderBy("part")) - F.col("n")).alias("before"))
    return placed.withColumn("part", part).join(F.broadcast(before), "part").withColumn("at", F.col("before") + F.col("at").bitwiseAND(F.lit((1 << 33) - 1))).drop("part", "before")


def resample(docs: DataFrame, target: DataFrame, *, n: int = GRAMS, buckets: int = BUCKETS, min_words: int = MIN_WORDS, share: int = SHARE, seed: str = SEED) -> DataFrame:
    """docs (doc_id, text), target (text) -> doc_id, n_features, weight, score, rank: a row for each document.

    weight is the sum of the gains of a document's features, score that plus Gumbel noise made from sha256(seed + doc_id), so that the highest scores are a sample without replacement, weighted by the exponential of weight. Of the documents with min_words words or more, floor(share %) have a rank, from 1.

    Null or empty text: no features, weight 0, never drawn. Null doc_id: noise of the seed alone, last among ties. Equal rows: each takes part, with the same score. Empty documents: no rows; empty target: gains of a target without features. Other columns are ignored.
    """
    ready(docs.sparkSession)
    gains = gain_table(docs, target, n, buckets)
    x = _exploded(docs, n, buckets, F.monotonically_increasing_id().alias("row"), F.col("doc_id")).join(F.broadcast(gains), "bucket", "left")
    x = x.groupBy("row", "doc_id", "n_words").agg(F.count("bucket").alias("n_features"), F.coalesce(F.sum("gain"), F.lit(0)).cast("long").alias("weight"))
    digest = F.sha2(F.concat(F.lit(seed), F.coalesce(F.col("doc_id").cast("string"), F.lit(""))).cast("binary"), 256)
    u = (F.conv(F.substring(digest, 1, 8), 16, 10).cast("long") + 0.5) / 4294967296.0
    weighed = settled(x.withColumn("score", (F.col("weight") + F.floor(-1000 * F.log(-F.log(u)))).cast("long")).drop("row"))
    rows = ranked(weighed.where(F.col("n_words") >= min_words), F.desc("score"), F.asc_nulls_last("doc_id"))
    drawn = weighed.where(F.col("n_words") >= min_words).count() * share // 100
    shown = ["doc_id", "n_features", "weight", "score"]
    rest = weighed.where(F.col("n_words") < min_words).select(*shown, F.lit(None).cast("long").alias("rank"))
    return rows.select(*shown, F.when(F.col("at") < drawn, F.col("at") + 1).alias("rank")).unionAll(rest)


_WORDS = r"regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+')"
SQL = rf"""
WITH c AS (SELECT list_transform(range(256), lambda i: list_reduce([i, 0, 0, 0, 0, 0, 0, 0, 0], lambda a, z: CASE WHEN a % 2 = 1 THEN xor(3988292384, a // 2) ELSE a // 2 END)) AS c),
d AS MATERIALIZED (SELECT doc_id, {_WORDS} AS w FROM documents),
f AS MATERIALIZED (SELECT doc_id, unnest(w) AS g FROM d),
b AS MATERIALIZED (SELECT unnest({_WORDS}) AS g FROM benchmark),
v AS (SELECT g, hex(encode(g)) AS h FROM (SELECT DISTINCT g FROM (SELECT g FROM f UNION ALL SELECT g FROM b))),
k AS MATERIALIZED (SELECT g, xor(list_reduce(list_prepend(4294967295, list_transform(range(0, len(h), 2), lambda p: ('0x' || h[p + 1:p + 2])::BIGINT)), lambda a, x: xor(c[(xor(a, x) & 255) + 1], a >> 8)), 4294967295) % 10000 AS bucket FROM v, c),
s AS (SELECT bucket, count(*) AS s FROM f JOIN k USING (g) GROUP BY 1),
t AS (SELECT bucket, count(*) AS t FROM b JOIN k USING (g) GROUP BY 1),
a AS (SELECT (SELECT count(*) FROM f)::DOUBLE AS s, (SELECT count(*) FROM b)::DOUBLE AS t),
gain AS (SELECT s.bucket, floor(1000 * ln((coalesce(t.t, 0) + 1.0::DOUBLE) * (a.s + 10000) / ((s.s + 1.0::DOUBLE) * (a.t + 10000))))::BIGINT AS gain FROM s LEFT JOIN t ON s.bucket = t.bucket, a),
w AS (SELECT doc_id, sum(gain)::BIGINT AS weight FROM f JOIN k USING (g) JOIN gain USING (bucket) GROUP BY 1),
x AS (SELECT doc_id, len(d.w)::BIGINT AS n_features, coalesce(w.weight, 0)::BIGINT AS weight, (('0x' || sha256('2024:' || doc_id)[1:8])::BIGINT + 0.5::DOUBLE) / 4294967296 AS u FROM d LEFT JOIN w USING (doc_id)),
y AS (SELECT doc_id, n_features, weight, (weight + floor(-1000 * ln(-ln(u))))::BIGINT AS score FROM x),
z AS (SELECT doc_id, row_number() OVER (ORDER BY score DESC, doc_id) AS r, count(*) OVER () AS n FROM y WHERE n_features >= 20)
SELECT y.doc_id, n_features, weight, score, CASE WHEN r <= 10 * n // 100 THEN r END::BIGINT AS rank FROM y LEFT JOIN z USING (doc_id)
"""

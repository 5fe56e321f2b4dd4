"""Phrase collocation mining.

1. Candidates, level by level: mappers emit the keys of k-word phrases whose first and last k-1 words passed the level before, with their number in the batch; keys whose sum reaches the threshold are candidates. A sum over a 64-bit key is never below a phrase's count, so no frequent phrase is lost. What passed before is known to mappers by a filter of fixed size (false hits only add keys, which are counted and go).
2. A minimal perfect hash over the candidates of all levels, in blocks of bounded size, each built in a task. Mappers look windows up, verify the stored key, bincount the slots in numpy arrays and add up a second key of each phrase; the arrays are summed in a tree.
3. Phrases are put together from their first and last k-1 words, and carry the counts of all their beginnings and ends, so that every cut is read from their slots.

Two different phrases that meet in a candidate's key are noticed by the sum of the second keys; the run is then made again with another seed.
"""

from __future__ import annotations

import hashlib
import pickle
import re
from collections.abc import Callable, Iterator
from itertools import chain, count

import numpy as np
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from granary.llm.common import ready
from granary.llm.shingles import M1, M2, M3, mix
from granary.operators.lineage import discard, settled

LONGEST, LEAST, TOP, COVER = 5, 100, 2000, 100
#: Bytes of text hashed at once; bits of the filter (as a power of two); candidates of a block, blocks of a pass over the texts, slots of a chunk, arrays added up in a task.
TEXT, FILTER, BLOCK, PASS, CHUNK, FAN = 1 << 20, 26, 1 << 19, 4, 1 << 14, 64
_KIND = np.zeros(256, np.uint8)
_KIND[[0x20, 0x09]] = 1
_KIND[[*b".,;:!?", 0x0A, 0x0B, 0x0C, 0x0D]] = 2
_STOP = re.compile(rb"[.,;:!?\n-\r]")


class PerfectHash:
    """A minimal perfect hash of distinct 64-bit keys: level after level, keys that are alone in their place of a bit array take it, the others go on to the next; a slot is the number of bits set before."""

    def __init__(self, keys: np.ndarray):
        self.sizes, words = [], []
        while len(keys):
            m = max(64, -(-2 * len(keys) // 64) * 64)
            at = self.places(keys, len(self.sizes), m)
            alone = np.bincount(at, minlength=m)[at] == 1
            bits = np.zeros(m, np.uint8)
            bits[at[alone]] = 1
            words.append(np.packbits(bits, bitorder="little").view(np.uint64))
            self.sizes.append(m)
            keys = keys[~alone]
        self.words = np.concatenate([*words, np.zeros(0, np.uint64)])
        self.before = np.concatenate([[0], np.cumsum(np.bitwise_count(self.words))]).astype(np.int64)

    @staticmethod
    def places(keys: np.ndarray, level: int, m: int) -> np.ndarray:
        return (mix(keys + np.array([level + 1], np.uint64) * M3) % np.uint64(m)).astype(np.int64)

    def slots(self, keys: np.ndarray) -> np.ndarray:
        """The slot of each key; of keys that are not in it, any slot or -1."""
        out, todo, base = np.full(len(keys), -1, np.int64), np.arange(len(keys)), 0
        for level, m in enumerate(self.sizes):
            at = self.places(keys[todo], level, m) + base
            word, bit = self.words[at >> 6], (at & 63).astype(np.uint64)
            hit = (word >> bit & np.uint64(1)) == 1
            out[todo[hit]] = self.before[at[hit] >> 6] + np.bitwise_count(word[hit] & ((np.uint64(1) << bit[hit]) - np.uint64(1)))
            todo, base = todo[~hit], base + m
        return out


class Words:
    """The words of texts of one language: places, pieces, and for each length the keys of the phrases that start there."""

    def __init__(self, data: bytes, language: str, seed: int):
        self.seed = seed
        b = np.frombuffer(data, np.uint8)
        kind = _KIND[b]
        at = np.flatnonzero(kind == 0)
        first = np.flatnonzero(np.diff(at, prepend=-2) > 1)
        n = np.diff(first, append=len(at))
        place = np.arange(len(at)) - np.repeat(first, n)
        code = b[at].astype(np.uint64) + np.uint64(1)
        self.data, self.first, self.end = data, at[first], at[first] + n
        self.piece = np.cumsum(kind == 2)[self.first]
        salt = [np.uint64(x) for x in np.frombuffer(hashlib.blake2b(f"{seed}:{language}".encode("utf-8", "surrogatepass"), digest_size=16).digest(), "<u8")]
        powers = [np.cumprod(np.concatenate([np.ones(1, np.uint64), np.full(int(n.max()) if len(n) else 0, m | np.uint64(1))]), dtype=np.uint64) for m in (M1 ^ salt[0], M2 ^ salt[1])]
        self.hash = [mix(np.add.reduceat(code * p[place], first) + n.astype(np.uint64)) if len(n) else np.zeros(0, np.uint64) for p in powers]
        self.keys = [[mix(h ^ s)] for h, s in zip(self.hash, salt)]

    def __len__(self) -> int:
        return len(self.first)

    def key(self, k: int, which: int = 0) -> np.ndarray:
        """Keys of the k-word phrases from each word on, those that leave their piece included."""
        keys = self.keys[which]
        while len(keys) < k:
            m = max(0, len(self) - len(keys))
            keys.append(mix(keys[-1][:m] * (M2 if which else M1) + self.hash[which][len(self) - m :] + np.uint64(1)))
        return keys[k - 1]

    def whole(self, k: int) -> np.ndarray:
        m = max(0, len(self) - k + 1)
        return self.piece[:m] == self.piece[len(self) - m :]


def batches(b, seed: int) -> Iterator[tuple[str, Words]]:
    """The words of an Arrow batch (text, lang), language by language, in runs of about TEXT bytes that end between pieces. A piece is never cut."""
    texts: dict[str, list[bytes]] = {}
    for t, lang in zip(b.column(0).to_pylist(), b.column(1).to_pylist()):
        if t:
            texts.setdefault("und" if lang is None else lang, []).append(t.encode("utf-8", "surrogatepass").lower())
    for lang, found in texts.items():
        data, at = b"\n".join(found), 0
        while at < len(data):
            stop = _STOP.search(data, at + TEXT)
            end = stop.start() if stop else len(data)
            yield lang, Words(data[at:end], lang, seed)
            at = end


def in_filter(bits: np.ndarray, keys: np.ndarray) -> np.ndarray:
    at = keys >> np.uint64(64 - FILTER)
    return (bits[(at >> np.uint64(3)).astype(np.int64)] >> (at & np.uint64(7)).astype(np.uint8) & 1) == 1


def _mapped(docs: DataFrame, schema: str, make: Callable) -> DataFrame:
    """mapInArrow; make() gives, once a task, a function of a batch to columns, and one of nothing to the columns that end the task."""
    from pyspark.sql.types import _parse_datatype_string

    kind = _parse_datatype_string(schema)

    def run(found):
        import pyarrow as pa
        from pyspark.sql.pandas.types import to_arrow_schema

        form = to_arrow_schema(kind)
        step, last = make()
        for x in chain(map(step, found), last()):
            n = len(next(iter(x.values())))
            yield pa.RecordBatch.from_arrays([pa.array(x[f.name], f.type) if f.name in x else pa.nulls(n, f.type) for f in form], schema=form)

    return docs.mapInArrow(run, kind)


def candidates(docs: DataFrame, k: int, least: int, passed, seed: int) -> DataFrame:
    """(key, part): keys of k-word phrases that may be there ``least`` times, and the last partition that has each. ``passed``: the broadcast filter of shorter ones."""

    def make():
        def step(b):
            keys, counts = [np.zeros(0, np.uint64)], [np.zeros(0, np.int64)]
            for _, w in batches(b, seed):
                ok = w.whole(k)
                if k > 1:
                    part = in_filter(passed.value, w.key(k - 1))
                    ok &= part[: len(ok)] & part[len(part) - len(ok) :]
                x, n = np.unique(w.key(k)[ok], return_counts=True)
                keys.append(x)
                counts.append(n)
            return {"key": np.concatenate(keys).view(np.int64), "n": np.concatenate(counts)}

        return step, lambda: ()

    return _mapped(docs, "key long, n long", make).withColumn("part", F.spark_partition_id()).groupBy("key").agg(F.sum("n").alias("n"), F.max("part").alias("part")).where(F.col("n") >= least).select("key", "part")


def filter_bits(keys: DataFrame, bits: np.ndarray) -> np.ndarray:
    """The filter with the keys added. Chunks of it are made in tasks; its size is fixed."""

    def chunk(group):
        import pyarrow as pa

        at = group["at"].to_numpy()
        one = np.zeros(1 << 16, np.uint8)
        one[at & 0xFFFF] = 1
        return pa.table({"chunk": pa.array([int(at[0]) >> 16], pa.int64()), "bits": pa.array([np.packbits(one, bitorder="little").tobytes()], pa.binary())})

    at = keys.select(F.shiftrightunsigned("key", 64 - FILTER).alias("at")).distinct().withColumn("chunk", F.shiftright("at", 16))
    bits = bits.copy()
    for r in at.groupBy("chunk").applyInArrow(chunk, "chunk long, bits binary").collect():
        bits[r.chunk << 13 : (r.chunk + 1) << 13] |= np.frombuffer(r.bits, np.uint8)
    return bits


def hashed_blocks(keys: DataFrame, blocks: int) -> DataFrame:
    """(block, hash): for each block the perfect hash of its keys, and by slot the keys and their partitions."""

    def build(group):
        import pyarrow as pa

        keys = group["key"].to_numpy().view(np.uint64)
        h = PerfectHash(keys)
        stored, parts, slots = np.empty_like(keys), np.empty(len(keys), np.int32), h.slots(keys)
        stored[slots], parts[slots] = keys, group["part"].to_numpy()
        return pa.table({"block": pa.array([group["block"][0].as_py()], pa.int64()), "hash": pa.array([pickle.dumps((h, stored, parts))], pa.binary())})

    return keys.withColumn("block", F.shiftrightunsigned("key", 20) % blocks).groupBy("block").applyInArrow(build, "block long, hash binary")


def counted(docs: DataFrame, blocks: int, sent, passed, longest: int, seed: int, first: bool, everyone: bool) -> DataFrame:
    """One pass over the texts for the blocks in ``sent``. Rows of three kinds: words of a language (lang, n; in the first pass); what a slot stands for (slot, k, key, check, head, tail, and of words the text and lang), told by the task of the slot's partition, or by everyone that has it; for a chunk of slots their counts, and the sums of their check keys (chunk, counts)."""

    def make():
        from pyspark import TaskContext

        part = TaskContext.get().partitionId()
        held = {b: pickle.loads(x) for b, x in sent.value.items()}
        sums = {b: np.zeros((2, len(keys)), np.uint64) for b, (_, keys, _) in held.items()}
        wanted = {b: np.ones(len(parts), bool) if everyone else parts == part for b, (_, _, parts) in held.items()}
        words: dict[str, int] = {}

        def step(batch):
            out = {c: [] for c in ("block", "slot", "k", "key", "check", "head", "tail", "text", "lang")}
            for lang, w in batches(batch, seed):
                words[lang] = words.get(lang, 0) + len(w)
                for k in range(1, longest + 1):
                    at = np.flatnonzero(w.whole(k))
                    at = at[in_filter(passed.value, w.key(k)[at])]
                    keys = w.key(k)[at]
                    of = (keys >> np.uint64(20)) % np.uint64(blocks)
                    for b, (h, stored, _) in held.items():
                        here = np.flatnonzero(of == b)
                        slot = h.slots(keys[here])
                        real = slot >= 0
                        real[real] = stored[slot[real]] == keys[here[real]]
                        slot, places = slot[real], at[here[real]]
                        check = w.key(k, 1)[places]
                        sums[b][0] += np.bincount(slot, minlength=len(stored)).astype(np.uint64)
                        np.add.at(sums[b][1], slot, check)
                        new, once = np.unique(slot, return_index=True)
                        told = once[wanted[b][new]]
                        wanted[b][slot[told]] = False
                        p, n = places[told], len(told)
                        out["block"] += [b] * n
                        out["slot"] += slot[told].tolist()
                        out["k"] += [k] * n
                        out["key"] += stored[slot[told]].view(np.int64).tolist()
                        out["check"] += check[told].view(np.int64).tolist()
                        out["head"] += w.key(k - 1)[p].view(np.int64).tolist() if k > 1 else [None] * n
                        out["tail"] += w.key(k - 1)[p + 1].view(np.int64).tolist() if k > 1 else [None] * n
                        out["text"] += [w.data[w.first[i] : w.end[i]].decode("utf-8", "replace") for i in p] if k == 1 else [None] * n
                        out["lang"] += [lang if k == 1 else None] * n
            return out

        def last():
            if first:
                yield {"lang": list(words), "n": list(words.values())}
            for b, total in sums.items():
                for c in range(0, total.shape[1], CHUNK):
                    x = total[:, c : c + CHUNK]
                    if x[0].any():
                        yield {"block": [b], "chunk": [c // CHUNK], "part": [part], "counts": [x.tobytes()]}

        return step, last

    return _mapped(docs, "lang string, n long, block long, slot long, k int, key long, check long, head long, tail long, text string, chunk long, part long, counts binary", make)


def tree_sum(arrays: DataFrame) -> DataFrame:
    """(block, chunk, part, counts) -> block, slot, f, and the sum of check keys: at most FAN arrays are added up in a task, level by level."""

    def add(group):
        import pyarrow as pa

        total = np.sum([np.frombuffer(x, np.uint64) for x in group["counts"].to_pylist()], axis=0, dtype=np.uint64)
        return pa.table({c: group[c][:1] for c in ("block", "chunk", "part")} | {"counts": pa.array([total.tobytes()], pa.binary())})

    most = arrays.agg(F.max("part")).first()[0] or 0
    while True:
        arrays = arrays.withColumn("part", F.floor(F.col("part") / FAN).cast("long")).groupBy("block", "chunk", "part").applyInArrow(add, "block long, chunk long, part long, counts binary")
        most //= FAN
        if not most:
            break

    def rows(found):
        import pyarrow as pa

        for b in found:
            for block, chunk, x in zip(*(b.column(c).to_pylist() for c in ("block", "chunk", "counts"))):
                f, checks = np.frombuffer(x, np.int64).reshape(2, -1)
                slot = np.flatnonzero(f)
                yield pa.RecordBatch.from_arrays([pa.array(np.full(len(slot), block)), pa.array(slot + chunk * CHUNK), pa.array(f[slot]), pa.array(checks[slot])], names=["block", "slot", "f", "checks"])

    return arrays.select("block", "chunk", "counts").mapInArrow(rows, "block long, slot long, f long, checks long")


def frequent(docs: DataFrame, longest: int, least: int) -> tuple[DataFrame, DataFrame]:
    """(lang, n): words of each language; (key, k, f, head, tail, text, lang): the phrases that are there ``least`` times, under a seed for which no two phrases of the corpus meet in a candidate's key: else the sum of a slot's check keys is not f times its phrase's. Should the texts be parted anew between passes, so that a slot's partition does not have it, the pass is made again and every task tells what it has."""
    send = docs.sparkSession.sparkContext.broadcast
    for seed in count():
        bits, levels, passed = np.zeros(1 << (FILTER - 3), np.uint8), [], None
        for k in range(1, longest + 1):
            levels.append(settled(candidates(docs, k, least, passed, seed)))
            bits = filter_bits(levels[-1], bits)
            if passed:
                passed.destroy()
            passed = send(bits)
        keys = levels[0]
        for x in levels[1:]:
            keys = keys.unionAll(x)
        keys = keys.groupBy("key").agg(F.max("part").alias("part"))
        blocks = max(1, -(-sum(x.count() for x in levels) // BLOCK))
        hashes = settled(hashed_blocks(keys, blocks))
        for everyone in (False, True):
            found = []
            for b in range(0, blocks, PASS):
                sent = send({r.block: bytes(r.hash) for r in hashes.where(F.col("block").between(b, b + PASS - 1)).collect()})
                found.append(settled(counted(docs, blocks, sent, passed, longest, seed, b == 0, everyone)))
                sent.destroy()
            rows = found[0]
            for x in found[1:]:
                rows = rows.unionAll(x)
            told = rows.where("slot is not null").groupBy("block", "slot").agg(*[F.min(c).alias(c) for c in ("k", "key", "check", "head", "tail", "text", "lang")])
            phrases = settled(tree_sum(rows.where("chunk is not null").select("block", "chunk", "part", "counts")).where(F.col("f") >= least).join(told, ["block", "slot"], "left"))
            if phrases.where("key is null").isEmpty():
                break
            discard(phrases, *found)
        passed.destroy()
        discard(hashes, *levels)
        if phrases.where(_modulo(F.col("f").cast("decimal(17,0)") * F.col("check").cast("decimal(20,0)")) != _modulo(F.col("checks").cast("decimal(20,0)"))).isEmpty():
            return rows.where("n is not null").groupBy("lang").agg(F.sum("n").alias("n")), phrases.select("key", "k", "f", "head", "tail", "text", "lang")
        discard(phrases, *found)


def score() -> Column:
    """floor(1000 * a * n / (l * r)) of columns a, n, l, r (at most 10^17 each), without rounding."""
    return F.expr("(cast(a as decimal(17,0)) * cast(n as decimal(17,0)) * 1000) div (cast(l as decimal(19,0)) * cast(r as decimal(18,0)))")


def _modulo(x: Column) -> Column:
    return F.pmod(x.cast("decimal(38,0)"), F.lit(str(1 << 64)).cast("decimal(38,0)"))


def collocations(docs: DataFrame, *, longest: int = LONGEST, least: int = LEAST, top: int = TOP, cover: int = COVER) -> DataFrame:
    """docs (text, lang) -> lang, rank, phrase, a, l, r, n, score: of each language the ``top`` phrases of 2 to ``longest`` words by score.

    Texts have A-Z lower-cased and are split at [.,;:!?] and line ends into pieces, these at spaces and tabs into words. a counts a phrase within pieces, overlaps included; phrases with a >= least are candidates. A cut into l and r (counts of the parts) scores floor(1000 * a * n / (l * r)), n the language's words; the lowest cut counts, of equal ones the first. A phrase goes if a longer candidate holds it and has ``cover`` percent of its count. Order: score, a, phrase (bytes). Arithmetic is exact.

    Null or empty text: no words. Null lang: und, together with that name. Equal rows: each counts. Empty table or no candidate: no rows. A piece, not a text, is what a task must hold. Other columns are ignored.
    """
    ready(docs.sparkSession)
    n, found = frequent(docs.select("text", "lang"), longest, least)
    one = found.where("k = 1").select("key", "lang", F.col("text").alias("phrase"), F.col("text").alias("word"), "f", F.array("f").alias("heads"), F.array("f").alias("tails"))
    levels = [one]
    for k in range(2, longest + 1):
        a, b = levels[-1].alias("a"), levels[-1].alias("b")
        x = found.where(F.col("k") == k).alias("x").join(a, F.col("x.head") == F.col("a.key")).join(b, F.col("x.tail") == F.col("b.key"))
        levels.append(settled(x.select("x.key", "x.head", "x.tail", "a.lang", F.concat_ws(" ", "a.phrase", "b.word").alias("phrase"), "b.word", "x.f", F.concat("a.heads", F.array("x.f")).alias("heads"), F.concat("b.tails", F.array("x.f")).alias("tails"))))
    kept = []
    for k in range(2, longest + 1):
        x = levels[k - 1]
        if k < longest:
            longer = levels[k].select(F.explode(F.array("head", "tail")).alias("key"), F.col("f").alias("more")).groupBy("key").agg(F.max("more").alias("more"))
            x = x.join(longer, "key", "left").where(F.col("more").isNull() | (F.col("more").cast("decimal(20,0)") * 100 < F.col("f").cast("decimal(20,0)") * cover))
        parts = F.array(*[F.struct(F.lit(j).alias("j"), F.col("heads")[j - 1].alias("l"), F.col("tails")[k - j - 1].alias("r")) for j in range(1, k)])
        kept.append(x.select("lang", "phrase", F.col("f").alias("a"), F.explode(parts).alias("c"), F.lit(k).alias("k")))
    rows = kept[0]
    for x in kept[1:]:
        rows = rows.unionAll(x)
    rows = rows.join(n, "lang").select("lang", "phrase", "a", "n", F.col("c.j").alias("j"), F.col("c.l").alias("l"), F.col("c.r").alias("r"))
    rows = rows.withColumn("score", score())
    cut = rows.groupBy("lang", "phrase", "a", "n").agg(F.min(F.struct("score", "j", "l", "r")).alias("c")).select("lang", "phrase", "a", "n", "c.l", "c.r", "c.score")
    order = Window.partitionBy("lang").orderBy(F.desc("score"), F.desc("a"), "phrase")
    return cut.withColumn("rank", F.row_number().over(order).cast("long")).where(F.col("rank") <= top).select("lang", "rank", "phrase", "a", "l", "r", "n", "score")


SQL = r"""
WITH p AS (SELECT coalesce(lang, 'und') AS lang, unnest(regexp_split_to_array(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[.,;:!?
-
]')) AS p FROM documents),
w AS (SELECT lang, regexp_extract_all(p, '[^ 	]+') AS w FROM p),
n AS (SELECT lang, sum(len(w))::BIGINT AS n FROM w GROUP BY 1),
f AS MATERIALIZED (SELECT lang, k, g, count(*)::BIGINT AS f FROM (SELECT lang, k, unnest(list_transform(range(1, len(w) - k + 2), lambda i: w[i:i + k - 1])) AS g FROM w, (SELECT unnest(range(1, 6)) AS k)) GROUP BY ALL HAVING count(*) >= 100),
c AS (SELECT lang, k, g, f AS a, unnest(range(1, k)) AS j FROM f WHERE k > 1),
s AS (SELECT c.lang, c.k, c.g, c.a, j, x.f AS l, y.f AS r, n.n, (1000::HUGEINT * c.a * n.n) // (x.f::HUGEINT * y.f) AS score FROM c JOIN f x ON x.lang = c.lang AND x.g = c.g[1:j] JOIN f y ON y.lang = c.lang AND y.g = c.g[j + 1:] JOIN n ON n.lang = c.lang),
b AS (SELECT lang, k, g, a, n, min((score, j, l, r)) AS m FROM s GROUP BY ALL),
h AS (SELECT lang, g[i:i + j - 1] AS g, max(f) AS f FROM (SELECT lang, g, f, i, unnest(range(2, k - i + 2)) AS j, k FROM (SELECT lang, g, f, k, unnest(range(1, k)) AS i FROM f WHERE k > 2)) WHERE j < k GROUP BY ALL),
o AS (SELECT b.lang, array_to_string(b.g, ' ') AS phrase, a, m[3] AS l, m[4] AS r, n, m[1]::BIGINT AS score FROM b LEFT JOIN h ON h.lang = b.lang AND h.g = b.g WHERE h.f IS NULL OR 100 * h.f < 100 * a)
SELECT * FROM (SELECT lang, row_number() OVER (PARTITION BY lang ORDER BY score DESC, a DESC, phrase) AS rank, phrase, a, l, r, n, score FROM o) WHERE rank <= 2000
"""

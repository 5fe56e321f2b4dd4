"""Benchmark decontamination: a broadcast hash set of test n-grams, scanned over training token windows, hits verified."""

from __future__ import annotations

from collections.abc import Callable

import numpy as np
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from granary.llm.common import arrow_map, ready
from granary.llm.shingles import hashed_words, windows

N = 10
#: Most bytes of benchmark text in one broadcast, on average: its windows take about eight times as much in a task. A larger benchmark is scanned in blocks of this size, each a pass over the documents; so many passes follow each other in one stage.
BLOCK_BYTES, PASSES = 8_000_000, 4
#: An item with more windows is sent in pieces that overlap by a window less a word.
PIECE = 100_000
_INSIDE = np.zeros(256, bool)
_INSIDE[[*range(48, 58), *range(97, 123), *range(128, 256)]] = True
HITS, ITEMS, WORDS = "_granary_hits", "_granary_items", "_granary_words"


def tokens(text: str | None) -> tuple[bytes, np.ndarray, np.ndarray, np.ndarray]:
    """The text as lower-cased UTF-8, and first byte, end and hash of its words ``[^\\x00-\\x2F\\x3A-\\x60\\x7B-\\x7F]+``."""
    raw = (text or "").encode("utf-8", "surrogatepass").lower()
    b = np.frombuffer(raw, np.uint8)
    return (raw, *hashed_words(b, _INSIDE[b]))


class Grams:
    """The windows of benchmark items: for each length, sorted hashes, and the item and bytes that each comes from. Holds arrays only, built once, and is the same in every process."""

    def __init__(self, items: list[tuple[str, str]], n: int):
        self.ids, self.text, found = [i for i, _ in items], [], {}
        for k, (_, text) in enumerate(items):
            raw, first, end, h = tokens(text)
            self.text.append(raw)
            size = min(n, len(h))
            if size:
                m = len(h) - size + 1
                found.setdefault(size, []).append((windows(h, size), np.full(m, k, np.int32), first[:m].astype(np.int32), end[size - 1 :].astype(np.int32)))
        self.tables = {}
        for size, parts in found.items():
            h, item, first, end = map(np.concatenate, zip(*parts))
            order = np.lexsort((item, h))
            h, item, first, end = h[order], item[order], first[order], end[order]
            keep = np.ones(len(h), bool)
            for k in np.flatnonzero((h[1:] == h[:-1]) & (item[1:] == item[:-1])) + 1:  # the same window again in an item
                keep[k] = self.text[item[k]][first[k] : end[k]] != self.text[item[k - 1]][first[k - 1] : end[k - 1]]
            self.tables[size] = tuple(x[keep] for x in (h, item, first, end))
        self.filters = None

    def scan(self, text: str | None) -> tuple[int, list[tuple[int, int]], set[str]]:
        """Number of words, runs of hit words, and the items with windows in the text."""
        if self.filters is None:  # one look-up rules out nearly all windows
            self.filters = {}
            for size, (h, *_) in self.tables.items():
                bits = min(26, max(16, len(h).bit_length() + 4))
                self.filters[size] = (np.uint64(64 - bits), np.zeros(1 << bits, bool))
                self.filters[size][1][(h >> self.filters[size][0]).astype(np.int64)] = True
        raw, first, end, h = tokens(text)
        mask, ids = None, set()
        for size, (keys, item, a, b) in self.tables.items():
            shift, seen = self.filters[size]
            g = windows(h, size)
            at = np.flatnonzero(seen[(g >> shift).astype(np.int64)])
            low, high = np.searchsorted(keys, g[at]), np.searchsorted(keys, g[at], "right")
            for j, lo, hi in zip(at[low < high].tolist(), low[low < high].tolist(), high[low < high].tolist()):
                said = [raw[x:y] for x, y in zip(first[j : j + size].tolist(), end[j : j + size].tolist())]
                for k in range(lo, hi):
                    if said == _split(self.text[item[k]][a[k] : b[k]]):
                        ids.add(self.ids[item[k]])
                        mask = np.zeros(len(h), bool) if mask is None else mask
                        mask[j : j + size] = True
        if mask is None:
            return len(h), [], ids
        edge = np.flatnonzero(np.diff(mask, prepend=False, append=False))
        return len(h), list(zip(edge[::2].tolist(), edge[1::2].tolist())), ids


def _split(raw: bytes) -> list[bytes]:
    b = np.frombuffer(raw, np.uint8)
    first, end, _ = hashed_words(b, _INSIDE[b])
    return [raw[x:y] for x, y in zip(first.tolist(), end.tolist())]


def _pieces(bench: DataFrame, n: int) -> DataFrame:
    """Distinct (item, text): whole items, or the pieces of very long ones."""
    piece = PIECE

    def make():
        def f(b):
            out = {"item": [], "text": []}
            for i, t in zip(b["item"], b["text"]):
                raw, first, end, _ = tokens(t)
                for k in range(0, max(1, len(first) - n + 1), piece) if len(first) else ():
                    stop = min(len(first), k + piece + n - 1)
                    out["item"].append(i)
                    out["text"].append(raw[first[k] : end[stop - 1]].decode("utf-8", "replace"))
            return out

        return f

    items = bench.select(F.coalesce(F.col("item_id").cast("string"), F.lit("")).alias("item"), "text").where("text is not null")
    return arrow_map(items, make, "item string, text string").distinct()


def _blocks(bench: DataFrame, n: int):
    """Broadcasts of Grams, one after the other; only one block of the benchmark is in the driver at a time."""
    pieces = _pieces(bench, n)
    size = pieces.agg(F.coalesce(F.sum(F.octet_length("text")), F.lit(0))).first()[0]
    many = max(1, -(-size // BLOCK_BYTES))
    if many > 1:
        pieces = pieces.checkpoint()
    for k in range(many):
        block = pieces if many == 1 else pieces.where(F.pmod(F.xxhash64("item", "text"), F.lit(many)) == k)
        yield k == many - 1, bench.sparkSession.sparkContext.broadcast(Grams([(r.item, r.text) for r in block.collect()], n))


def hits(docs: DataFrame, bench: DataFrame, n: int, drop: tuple[str, ...] = ()) -> DataFrame:
    """docs with the number of words, the runs of hit words and the items found, over all blocks of the benchmark; without the columns in ``drop``. No shuffle; a text is scanned as it is, whatever the blocks."""
    ready(docs.sparkSession)
    docs = docs.withColumns({WORDS: F.lit(0).cast("long"), HITS: F.array().cast("array<struct<s:int,e:int>>"), ITEMS: F.array().cast("array<string>")})
    for k, (last, sent) in enumerate(_blocks(bench, n)):
        names = [c for c in docs.columns if not last or c not in drop]
        docs = docs.mapInArrow(_pass(sent, names), StructType([docs.schema[c] for c in names]))
        if not last and k % PASSES == PASSES - 1:
            docs = docs.checkpoint()
    return docs


def _pass(sent, names: list[str]) -> Callable:
    def run(batches):
        import pyarrow as pa

        grams = sent.value
        for b in batches:
            words, runs, items = [], [], []
            for t, r, i in zip(b.column("text").to_pylist(), b.column(HITS).to_pylist(), b.column(ITEMS).to_pylist()):
                many, new, ids = grams.scan(t)
                words.append(many)
                runs.append(_united([*((x["s"], x["e"]) for x in r), *new]) if new else r)
                items.append(sorted({*i, *ids}))
            said = {WORDS: words, HITS: runs, ITEMS: items}
            cols = [pa.array(said[c], b.schema.field(c).type) if c in said else b.column(c) for c in names]
            yield pa.RecordBatch.from_arrays(cols, names=names)

    return run


def _united(runs: list[tuple[int, int]]) -> list[dict]:
    out: list[dict] = []
    for s, e in sorted(runs):
        if out and s <= out[-1]["e"]:
            out[-1]["e"] = max(out[-1]["e"], e)
        else:
            out.append({"s": s, "e": e})
    return out


def contamination(docs: DataFrame, bench: DataFrame, n: int = N) -> DataFrame:
    """doc_id, n_words, n_hit, n_items, items_sha256, contaminated for docs (doc_id, text) against bench (item_id, text).

    A benchmark of a bounded size is broadcast as one set of hashed windows; a larger one goes in blocks, each a pass, whose hit positions are united. Equal hashes are verified on the words themselves. Null or wordless text: no words, not contaminated. Null item ids count as one item named ''. Equal rows count one by one; an empty benchmark hits nothing; an empty table gives no rows. Other columns are ignored.
    """
    found = hits(docs.select("doc_id", "text"), bench, n, drop=("text",))
    n_hit = F.aggregate(HITS, F.lit(0).cast("long"), lambda a, x: a + x["e"] - x["s"])
    return found.select("doc_id", F.col(WORDS).alias("n_words"), n_hit.alias("n_hit"), F.size(ITEMS).cast("long").alias("n_items"), F.sha2(F.array_join(F.array_sort(ITEMS), ","), 256).alias("items_sha256"), (F.size(HITS) > 0).alias("contaminated"))


def decontaminate(docs: DataFrame, bench: DataFrame, *, remove: str = "documents", n: int = N) -> DataFrame:
    """The documents without hit ones (remove='documents'), or all with their hit spans cut out (remove='spans': first to last byte of each run of hit words, found on the text as it was). Columns stay; rows with null text stay. n_chars follows the text where there is such a column. An empty benchmark changes nothing."""
    found = hits(docs, bench, n)
    if remove == "documents":
        return found.where(F.size(HITS) == 0).select(*docs.columns)
    at = docs.columns.index("text")

    def cut(batches):
        import pyarrow as pa

        for b in batches:
            texts = []
            for t, runs in zip(b.column("text").to_pylist(), b.column(HITS).to_pylist()):
                if runs:
                    raw, (_, first, end, _) = t.encode("utf-8", "surrogatepass"), tokens(t)
                    edges = [0, *(x for r in runs for x in (first[r["s"]], end[r["e"] - 1])), len(raw)]
                    t = b"".join(raw[x:y] for x, y in zip(edges[::2], edges[1::2])).decode("utf-8", "surrogatepass")
                texts.append(t)
            cols = list(b.columns[: len(docs_columns)])
            cols[at] = pa.array(texts, pa.string())
            yield pa.RecordBatch.from_arrays(cols, names=docs_columns)

    docs_columns = docs.columns
    out = found.mapInArrow(cut, docs.schema)
    return out.withColumn("n_chars", F.length("text").cast(docs.schema["n_chars"].dataType)) if "n_chars" in docs.columns else out


_WORDS = r"regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+')"
SQL = rf"""
WITH i AS (SELECT coalesce(item_id::VARCHAR, '') AS item, {_WORDS} AS w FROM benchmark),
g AS (SELECT DISTINCT item, len(l) AS k, array_to_string(l, ' ') AS gram FROM (SELECT item, unnest(list_transform(range(1, greatest(len(w) - 9, 1) + 1), lambda p: w[p:p + least(10, len(w)) - 1])) AS l FROM i WHERE len(w) > 0)),
ks AS (SELECT DISTINCT k FROM g),
d AS (SELECT doc_id, {_WORDS} AS w FROM documents),
p AS (SELECT doc_id, k, unnest(range(1, len(w) - k + 2)) AS pos, w FROM d, ks WHERE len(w) >= k),
h AS (SELECT p.doc_id, p.pos, p.k, g.item FROM (SELECT doc_id, k, pos, array_to_string(w[pos:pos + k - 1], ' ') AS gram FROM p) p JOIN g ON p.gram = g.gram AND p.k = g.k),
n AS (SELECT doc_id, count(DISTINCT hit) AS n_hit FROM (SELECT doc_id, unnest(range(pos, pos + k)) AS hit FROM h) GROUP BY doc_id),
m AS (SELECT doc_id, count(*) AS n_items, string_agg(item, ',' ORDER BY item) AS items FROM (SELECT DISTINCT doc_id, item FROM h) GROUP BY doc_id)
SELECT d.doc_id, len(d.w)::BIGINT AS n_words, coalesce(n_hit, 0)::BIGINT AS n_hit, coalesce(n_items, 0)::BIGINT AS n_items, sha256(coalesce(items, '')) AS items_sha256, coalesce(n_hit, 0) > 0 AS contaminated
FROM d LEFT JOIN n USING (doc_id) LEFT JOIN m USING (doc_id)
"""

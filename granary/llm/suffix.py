"""Suffix-array deduplication of long repeated byte strings.

Every WINDOW-byte string holds the winnowing anchor that its own bytes select: the Q-gram of least hash. Equal strings select the same anchor, so only anchors that occur twice matter. An anchor's context is all windows that select it, so a window is in one context only. Equal contexts are found by hash; where contexts of one anchor differ, the distinct ones go to a shard, whose suffixes are sorted by induced sorting over disk-backed bucket queues: neighbours with a common prefix of WINDOW bytes are the repeats. An anchor with more contexts than a shard holds is parted by the bytes that windows share, down to single windows, so a shard is bounded and its text and arrays fit in a task; what the method asks for beyond that (common prefixes carried in the queues, recursion over more than one level, shards larger than memory) is not done.
"""

from __future__ import annotations

import hashlib
import tempfile

import numpy as np
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from granary.llm.common import apart, arrow_map, ready, release
from granary.llm.shingles import M1, M2, mix

WINDOW, Q = 100, 32
SIDE = WINDOW - Q
#: Contexts in a shard, on average; entries that a queue holds in memory before it writes them to disk.
SHARD, HELD = 20_000, 4_000_000
#: Bytes of short texts that are looked at together.
CHUNK = 1 << 17


def _grams(b: np.ndarray, q: int) -> np.ndarray:
    """Hash of each q-gram (q a power of 2) by doubling."""
    h, n, m = b.astype(np.uint64) + np.uint64(1), 1, int(M1)
    while n < q:
        h = h[:-n] * np.uint64(m) + h[n:]
        n, m = 2 * n, m * m % (1 << 64)
    return mix(h)


def anchors(b: np.ndarray, size: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Positions of the Q-grams that are the least (rightmost of equals) in some window of one text, with the first and the last start of these windows; texts of these sizes follow each other in b."""
    none = np.zeros(0, np.int64)
    if len(b) < WINDOW:
        return none, none, none
    mask = np.uint64(0xFFFFFFFF)
    h = (_grams(b, Q) & ~mask) | (mask - np.arange(len(b) - Q + 1, dtype=np.uint64))
    low, n, span = h, 1, SIDE + 1
    while 2 * n <= span:
        low, n = np.minimum(low[:-n], low[n:]), 2 * n
    at = mask - (np.minimum(low[: len(h) - span + 1], low[span - n : len(h) - n + 1]) & mask)
    start = np.flatnonzero(np.arange(len(at)) + WINDOW <= np.repeat(np.cumsum(size), size)[: len(at)])
    at = at[start].astype(np.int64)
    run = np.flatnonzero(np.diff(at, prepend=-1))
    return at[run], start[run], start[np.append(run[1:], len(at))[: len(run)] - 1]


class Queue:
    """A monotone, disk-backed priority queue for induction: a bucket per first byte. Positions reach a bucket in order, so a bucket is an append-only run; runs beyond HELD entries go to disk, a file that is gone with the task, and are read back one at a time."""

    def __init__(self, buckets: int, held: int = HELD):
        self.held, self.runs, self.n, self.file = held, [[] for _ in range(buckets)], 0, None

    def push(self, bucket: int, items: np.ndarray) -> None:
        self.runs[bucket].append(items)
        self.n += len(items)
        if self.n > self.held:
            self.spill()

    def spill(self) -> None:
        self.file = self.file or tempfile.TemporaryFile()
        for runs in self.runs:
            for k, r in enumerate(runs):
                if isinstance(r, np.ndarray):
                    at = self.file.seek(0, 2)
                    r.tofile(self.file)
                    runs[k] = (at, len(r), r.dtype)
        self.n = 0

    def pop(self, bucket: int) -> np.ndarray:
        """All entries of a bucket; it is empty then."""
        out = []
        for r in self.runs[bucket]:
            if isinstance(r, tuple):
                self.file.flush()
                self.file.seek(r[0])
                r = np.fromfile(self.file, r[2], r[1])
            else:
                self.n -= len(r)
            out.append(r)
        self.runs[bucket] = []
        return np.concatenate(out) if out else np.zeros(0, np.int32)


def _kind(n: int) -> type:
    """The narrowest kind of the positions below n, and of n and n + 1: arrays of them are what a sort's memory is."""
    return np.int32 if n < 2**31 - 2 else np.int64


def suffix_array(text: np.ndarray, depth: int = WINDOW, held: int = HELD) -> np.ndarray:
    """Positions of text (uint16, 0 the separator) in the order of their first ``depth`` symbols.

    Left-most S suffixes are sorted on the reduced text; L suffixes are induced from them bucket by bucket upwards, S suffixes downwards. A bucket is induced in rounds: the predecessors of what came from other buckets, then those of the round before. Order among suffixes equal to the depth is free.
    """
    n = len(text)
    if n < 2:
        return np.arange(n)
    t, kind = text, _kind(n)
    known = np.arange(n, dtype=kind)
    known[:-1][t[1:] == t[:-1]] = n
    nearest = np.minimum.accumulate(known[::-1], out=known[::-1])[::-1]
    is_s = np.append(t[1:] > t[:-1], False)[nearest]
    del known, nearest
    lms = (np.flatnonzero(is_s[1:] & ~is_s[:-1]) + 1).astype(kind)
    size = int(t.max()) + 1

    def by_char(items: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        c = t[items]
        order = np.argsort(c, kind="stable")  # a radix sort, as symbols have 16 bits
        return items[order], np.concatenate([[0], np.cumsum(np.bincount(c, minlength=size))])

    def reduced(items: np.ndarray) -> np.ndarray:
        """Order of the left-most S suffixes: their substrings are named in order (a proper prefix comes after what it is a prefix of, as the next S suffix starts there), and the names are sorted by doubling: two symbols a name at least, so 2 ** k names reach the depth."""
        m = len(items)
        length = np.diff(items, append=kind(n)) + kind(1)  # the last ends with the end of the text, the least symbol
        padded = np.append(t, np.uint16(0)).astype(np.uint32)
        padded[:n] += np.uint32(1)
        names, groups, at = np.zeros(m, kind), np.arange(m, dtype=kind), 0
        while len(groups):  # four symbols at a time, only where names are still equal
            pos, left = np.minimum(items[groups], n - at) + kind(at), length[groups] - kind(at)
            key = np.zeros(len(groups), np.uint64)
            for k in range(4):
                key <<= np.uint64(16)
                key |= np.where(left > k, padded[np.minimum(pos, n - k) + kind(k)], np.uint32(0xFFFF))
            order = np.lexsort((key, names[groups])).astype(kind)
            g, k_ = names[groups][order], key[order]
            fresh = np.concatenate([[True], (g[1:] != g[:-1]) | (k_[1:] != k_[:-1])])
            start = np.concatenate([[True], g[1:] != g[:-1]])
            place = np.arange(len(order), dtype=kind)
            first, base = np.maximum.accumulate(place * fresh), np.maximum.accumulate(place * start)
            names[groups[order]] = g + first - base  # a name is the number of substrings before it
            at += 4
            many = ~(fresh & np.append(fresh[1:], True))
            groups = groups[order[many & (left[order] >= 4)]]
        reach = 1
        while reach * 2 <= depth:
            key = names.astype(np.int64) * (m + 1)
            if reach < m:
                key[: m - reach] += names[reach:] + kind(1)
            order = np.argsort(key)
            key = key[order]
            new = np.cumsum(np.append(False, key[1:] != key[:-1]), dtype=kind)
            names[order] = new
            if new[-1] == m - 1:
                break
            reach *= 2
        return items[np.argsort(names)]

    lms = reduced(lms) if len(lms) else lms
    queue, seeds = Queue(size, held), by_char(lms)
    out_l: list[np.ndarray] = []

    def send(items: np.ndarray, want_s: bool, low: int, up: bool) -> np.ndarray:
        """Pushes predecessors of the type into later buckets; returns those of this bucket."""
        prev = items[items > 0] - kind(1)
        prev = prev[is_s[prev] == want_s]
        c = t[prev]
        prev = prev[(c >= low) if up else (c <= low)]
        got, cut = by_char(prev)
        for ch in np.flatnonzero(np.diff(cut)).tolist():
            if ch != low:
                queue.push(ch, got[cut[ch] : cut[ch + 1]])
        return got[cut[low] : cut[low + 1]]

    if not is_s[n - 1]:
        queue.push(int(t[n - 1]), np.array([n - 1], kind))
    for c in range(size):
        now, got = queue.pop(c), []
        while len(now):
            got.append(now)
            now = send(now, False, c, True)
        out_l.append(np.concatenate(got) if got else np.zeros(0, kind))
        send(seeds[0][seeds[1][c] : seeds[1][c + 1]], False, c, True)
    queue, out = Queue(size, held), []
    for c in range(size - 1, -1, -1):  # everything in falling order
        now, got = queue.pop(c), []
        while len(now):
            got.append(now)
            now = send(now, True, c, False)
        falling = out_l[c][::-1]
        out += [*got, falling]
        send(falling, True, c, False)
    return np.concatenate(out)[::-1]


def repeats(contexts: list[bytes], order: np.ndarray, depth: int = WINDOW, held: int = HELD) -> list[np.ndarray]:
    """For each context, the starts of its windows that also start earlier; order[i] is the place in the corpus of context i's first byte."""
    size = np.array([len(c) for c in contexts])
    begin = np.concatenate([[0], np.cumsum(size + 1)])
    raw = np.frombuffer(b"\0".join(contexts) + b"\0", np.uint8)
    text = raw.astype(np.uint16) + np.uint16(1)
    text[begin[1:] - 1] = 0
    fits = np.ones(len(text), bool)
    for k in range(depth):  # a window that starts here ends in its context
        fits[np.maximum(begin[1:] - 1 - k, begin[:-1])] = False
    sa = suffix_array(text, depth, held)
    sa = sa[fits[sa]]
    if not len(sa):
        return [sa for _ in contexts]
    same, windows = np.zeros(len(sa), bool), np.lib.stride_tricks.sliding_window_view(raw, depth)
    for a in range(1, len(sa), 50_000):  # the common prefix of neighbours reaches the depth
        same[a : a + 50_000] = (windows[sa[a : a + 50_000]] == windows[sa[a - 1 : a - 1 + len(sa[a : a + 50_000])]]).all(axis=1)
    owner = np.searchsorted(begin, sa, "right") - 1
    place = order[owner] + (sa - begin[owner])
    del owner
    first = np.flatnonzero(~same)
    least = np.repeat(np.minimum.reduceat(place, first), np.diff(np.append(first, len(sa))))
    late = sa[place > least]
    late = late[np.argsort(late)]
    cut = np.searchsorted(late, begin)
    return [late[cut[i] : cut[i + 1]] - begin[i] for i in range(len(contexts))]


def _runs(starts: np.ndarray, depth: int = WINDOW) -> list[tuple[int, int]]:
    edge = np.flatnonzero(np.diff(starts, prepend=-2) > 1)
    stop = np.append(edge[1:], len(starts)) - 1
    return [(int(starts[a]), int(starts[b]) + depth) for a, b in zip(edge, stop)] if len(starts) else []


def _occurrences(docs: DataFrame) -> DataFrame:
    """oid, key, anchor, context hash and place (start of the first window, and in the two lower bytes the number of further ones and the anchor's offset in the first) of every anchor, and whether an equal context starts earlier in the batch: such a row needs no look at the others, and is dealt out by its document instead of its anchor, so that a passage of very many documents is a row a batch. Short texts are looked at together, CHUNK bytes at a time."""

    def make():
        def look(texts, size):
            x = np.frombuffer(b"".join(texts), np.uint8)
            p, s0, s1 = anchors(x, size)
            step = np.concatenate([np.zeros(1, np.uint64), np.cumsum((x.astype(np.uint64) + np.uint64(1)) * _power(len(x)), dtype=np.uint64)])
            ctx = mix((step[s1 + WINDOW] - step[s0]) * _inverse(len(x))[s0] + mix((p - s0).astype(np.uint64) * M1 + (s1 + WINDOW - p).astype(np.uint64)))
            row = np.searchsorted(np.cumsum(size), s0, "right")
            first = s0 - (np.cumsum(size) - size)[row]
            return row, (_grams(x, Q)[p] if len(p) else p).view(np.int64), ctx.view(np.int64), first, s1 - s0, p - s0

        def f(b):
            texts = [t or b"" for t in b["text"]]
            size, ids = np.array([len(t) for t in texts], np.int64), list(zip(b["oid"], b["key"]))
            edge = np.flatnonzero(np.diff(np.cumsum(size) // CHUNK, prepend=-1)).tolist() + [len(texts)]
            seen = [(i, look(texts[i:j], size[i:j])) for i, j in zip(edge, edge[1:])] or [(0, look([], size))]
            row = np.concatenate([x[0] + i for i, x in seen])
            anchor, ctx, first, more, off = (np.concatenate(c) for c in list(zip(*(x for _, x in seen)))[1:])
            rank = {d: k for k, d in enumerate(sorted(set(ids)))}
            place = np.array([rank[d] for d in ids], np.int64)[row] * (1 << 32) + first
            again = np.zeros(len(row), bool)
            if len(row):
                order = np.argsort(ctx)  # were two contexts of one hash not equal, their rows would be compared later
                run = np.flatnonzero(np.append(True, (np.diff(ctx[order]) != 0) | (np.diff(anchor[order]) != 0)))
                again[order] = place[order] > np.repeat(np.minimum.reduceat(place[order], run), np.diff(np.append(run, len(row))))
            return {"oid": _column(b["oid"], row), "key": _column(b["key"], row), "anchor": _column(anchor), "ctx": _column(ctx), "place": _column(first << 16 | more << 8 | off), "again": _column(again)}

        return f

    return arrow_map(docs.select("oid", "key", F.col("text").cast("binary")), make, "oid long, key long, anchor long, ctx long, place long, again boolean")


def _column(values, rows=None):
    """An Arrow array of a numpy array, or of a list of longs at these rows."""
    import pyarrow as pa

    return pa.array(values if rows is None else np.array(values, np.int64)[rows])


_table: dict[int, np.ndarray] = {}


def _grown(m: int, n: int) -> np.ndarray:
    if m not in _table or len(_table[m]) < n + 1:
        _table[m] = np.cumprod(np.concatenate([np.ones(1, np.uint64), np.full(2 * n + 1, m, np.uint64)]), dtype=np.uint64)
    return _table[m]


def _power(n: int) -> np.ndarray:
    return _grown(int(M1), n)[:n]


def _inverse(n: int) -> np.ndarray:
    return _grown(pow(int(M1), -1, 1 << 64), n)


def _split(contexts: DataFrame, most: int) -> DataFrame:
    """Contexts with the group in which they are sorted, and the range of places [lo, hi] that the anchor has in the windows looked at there.

    At first all of an anchor's contexts are a group, with the places 0 to SIDE. A group of more than ``most`` is parted: the range of places in four, and in each part by the bytes that all windows with these places have in common; a context is cut to those windows. Equal windows stay together, and in the end a group is one window. The anchors with more than that are marked ``hot``; later groups to be parted are found by counts, and only their contexts are written again; four rounds reach single places.
    """
    every = contexts.withColumns({"group": F.col("anchor"), "lo": F.lit(0), "hi": F.lit(SIDE)})
    done, held = every.where("not hot").drop("hot"), every.where("hot").drop("hot")
    while not held.isEmpty():
        step = F.ceil((F.col("hi") - F.col("lo") + 1) / 4).cast("int")
        parts = F.explode(F.transform(F.sequence(F.col("lo"), F.col("hi"), step), lambda a: F.struct(a.alias("lo"), F.least(a + step - 1, F.col("hi")).alias("hi"))))
        p = held.withColumn("p", parts).withColumns({"lo": F.col("p.lo"), "hi": F.col("p.hi")}).drop("p")
        p = p.where((F.col("off") >= F.col("lo")) & (F.length("context") >= F.col("off") + WINDOW - F.col("hi")))
        common = F.substring(F.col("context"), F.col("off") - F.col("lo") + 1, F.lit(WINDOW) - F.col("hi") + F.col("lo"))
        left = F.greatest(F.col("off") - F.col("hi"), F.lit(0))
        cut = F.substring(F.col("context"), left + 1, F.col("off") + WINDOW - F.col("lo") - left)
        p = p.select("oid", "key", "anchor", (F.col("start") + left).alias("start"), (F.col("off") - left).alias("off"), cut.alias("context"), F.xxhash64("anchor", "lo", "hi", common).alias("group"), "lo", "hi").checkpoint()
        large = p.where("lo < hi").groupBy(F.col("group").alias("g")).agg(F.count("*").alias("many")).where(F.col("many") > most).select("g", F.lit(True).alias("hot"))
        p = p.join(apart(large, "g"), F.col("group") == F.col("g"), "left").withColumn("hot", F.coalesce("hot", F.lit(False))).drop("g").checkpoint()
        done, held = done.unionByName(p.where("not hot").drop("hot")), p.where("hot").drop("hot")
    return done


def _equal(one: DataFrame) -> DataFrame:
    """Groups of single windows: all but the first are repeats. The windows themselves are compared; the first is found by a minimum that is merged before the shuffle."""
    at = F.struct("oid", "key", "start")
    w = one.where(F.length("context") == WINDOW).select("oid", "key", "start", F.sha2("context", 256).alias("window"))
    first = w.groupBy("window").agg(F.min(at).alias("first")).select(F.concat("window", F.lit("")).alias("window"), "first")
    return w.join(first, "window").where(at > F.col("first")).select("oid", "key", F.col("start").alias("s"), (F.col("start") + WINDOW).alias("e"))


def _compared(seen: DataFrame) -> DataFrame:
    """The rows of ``_occurrences`` that are repeats as a whole (``late``), or whose anchor has several contexts (``mixed``). A row that has an equal one in its batch is dealt out by its document. The windows share one sort, as both are in the order of contexts."""
    at, again = F.struct("oid", "key", "place"), F.col("again")
    seen = seen.withColumn("anchor", F.when(again, F.xxhash64("key", "place")).otherwise(F.col("anchor")))
    by = Window.partitionBy("anchor", "again").orderBy("ctx").rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing)
    seen = seen.withColumn("mixed", ~again & (F.min("ctx").over(by) < F.max("ctx").over(by))).withColumn("least", F.when(~again, F.min(at).over(Window.partitionBy("anchor", "again", "ctx"))))
    late = again | (at > F.col("least"))
    first, more = F.shiftright("place", 16), F.shiftright("place", 8).bitwiseAND(F.lit(255))
    where = ("first", first), ("last", first + more), ("off", F.col("place").bitwiseAND(F.lit(255)))
    return seen.where(F.col("mixed") | late).select("oid", "key", "anchor", *(c.cast("int").alias(n) for n, c in where), "mixed", late.alias("late"))


def repeated_runs(docs: DataFrame, *, shard: int = SHARD, held: int = HELD) -> DataFrame:
    """docs (oid, key, doc_id, text) -> oid, key, runs: array of byte ranges [s, e) that are repeats, s in the upper 32 bits. A row for each document with any."""
    seen = _compared(_occurrences(docs)).checkpoint()
    release(docs.sparkSession)
    full = seen.where("late").select("oid", "key", F.col("first").alias("s"), (F.col("last") + WINDOW).alias("e"))
    lead = seen.where("mixed and not late")
    shards = F.greatest(F.lit(1), F.ceil(F.lit(lead.count() / shard))).cast("int")
    large = lead.groupBy(F.col("anchor").alias("group")).agg(F.count("*").alias("many")).where(F.col("many") > shard).select("group", F.lit(True).alias("hot"))
    lead = lead.join(apart(large, "group"), F.col("anchor") == F.col("group"), "left").withColumn("hot", F.coalesce("hot", F.lit(False)))
    lead = lead.groupBy("oid", "key").agg(*(F.collect_list(c).alias(c) for c in ("first", "last", "off", "anchor", "hot"))).join(docs, ["oid", "key"])

    def make():
        def f(b):
            of = [k for k, a in enumerate(b["first"]) for _ in a]
            out = {c: [v for a in b[c] for v in a] for c in ("anchor", "first", "last", "off", "hot")}
            start, last = out.pop("first"), out.pop("last")
            return out | {"oid": [b["oid"][k] for k in of], "key": [b["key"][k] for k in of], "start": start, "context": [b["text"][k][s : e + WINDOW] for k, s, e in zip(of, start, last)]}

        return f

    contexts = arrow_map(lead.select("oid", "key", "first", "last", "off", "anchor", "hot", F.col("text").cast("binary")), make, "oid long, key long, anchor long, start int, off int, hot boolean, context binary").checkpoint()
    found = _split(contexts, shard).withColumn("shard", F.pmod("group", shards))

    def sort(group):
        import pyarrow as pa

        g = group.select(["oid", "key", "start", "context"]).to_pydict()
        doc = {d: i for i, d in enumerate(sorted(set(zip(g["oid"], g["key"]))))}
        order = np.array([doc[d] for d in zip(g["oid"], g["key"])], np.int64) * (1 << 32) + np.array(g["start"], np.int64)
        rows = [(o, k, s + a, s + e) for o, k, s, late in zip(g["oid"], g["key"], g["start"], repeats(g["context"], order, held=held)) for a, e in _runs(late)]
        return pa.table({n: pa.array([r[i] for r in rows], t) for i, (n, t) in enumerate((("oid", pa.int64()), ("key", pa.int64()), ("s", pa.int32()), ("e", pa.int32())))})

    sorted_ = found.where("lo < hi").groupBy("shard").applyInArrow(sort, "oid long, key long, s int, e int")
    return full.unionAll(sorted_).unionAll(_equal(found.where("lo = hi"))).distinct().groupBy("oid", "key").agg(F.collect_list(F.shiftleft(F.col("s").cast("long"), 32).bitwiseOR(F.col("e"))).alias("runs"))


def dedup(docs: DataFrame, *, shard: int = SHARD, held: int = HELD, keep_text: bool = False) -> DataFrame:
    """docs (doc_id, text) -> doc_id, n_bytes, n_removed, n_spans, kept_sha256, and with keep_text the remaining text (bytes that are no UTF-8 are replaced).

    A byte goes if a 100-byte string over it also starts earlier: in a smaller doc_id, or the same document. Null doc_ids, and those that are no integers, come first. Equal rows are one document, and all are judged alike; other rows with equal ids are ordered by a hash of their text. Null or short text: nothing is removed. Empty table: no rows. Other columns are ignored.
    """
    ready(docs.sparkSession)
    docs = docs.select(F.coalesce(F.col("doc_id").try_cast("long"), F.lit(-(2**63))).alias("oid"), F.xxhash64("doc_id", "text").alias("key"), "doc_id", "text")
    runs = repeated_runs(docs, shard=shard, held=held)  # both joins read the same exchange of the texts
    kind = docs.schema["doc_id"].dataType.simpleString()

    def make():
        def f(b):
            out = {k: [] for k in ("doc_id", "n_bytes", "n_removed", "n_spans", "kept_sha256", "text")}
            for i, t, runs in zip(b["doc_id"], b["text"], b["runs"]):
                x, left, last, spans = t or b"", [], 0, 0
                for r in sorted(runs or ()):
                    s, e = r >> 32, r & 0xFFFFFFFF
                    if s > last or not spans:
                        left.append(x[last:s])
                        spans += 1
                    last = max(last, e)
                kept = b"".join([*left, x[last:]])
                for k, v in zip(out, (i, len(x), len(x) - len(kept), spans, hashlib.sha256(kept).hexdigest(), kept.decode("utf-8", "replace") if keep_text else None)):
                    out[k].append(v)
            return out

        return f

    out = arrow_map(docs.join(runs, ["oid", "key"], "left").select("doc_id", F.col("text").cast("binary"), "runs"), make, f"doc_id {kind}, n_bytes long, n_removed long, n_spans long, kept_sha256 string, text string")
    return out if keep_text else out.drop("text")


SQL = """
WITH d AS (SELECT doc_id, encode(coalesce(text, '')) AS b FROM documents),
h AS (SELECT doc_id, hex(b) AS h, octet_length(b) AS n FROM d),
w AS (SELECT doc_id, p, md5(h[2 * p + 1:2 * p + 200]) AS k FROM (SELECT doc_id, h, unnest(range(0, n - 99)) AS p FROM h WHERE n >= 100)),
f AS (SELECT doc_id, p FROM w QUALIFY row_number() OVER (PARTITION BY k ORDER BY doc_id, p) > 1),
g AS (SELECT doc_id, p, p > coalesce(max(p) OVER (PARTITION BY doc_id ORDER BY p ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING) + 100, -1) AS fresh FROM f),
r AS (SELECT doc_id, min(p) AS s, max(p) + 100 AS e FROM (SELECT *, sum(fresh::INT) OVER (PARTITION BY doc_id ORDER BY p) AS run FROM g) GROUP BY doc_id, run),
k AS (SELECT doc_id, sum(e - s) AS removed, count(*) AS spans, list(s ORDER BY s) AS ss, list(e ORDER BY s) AS es FROM r GROUP BY doc_id)
SELECT h.doc_id, n::BIGINT AS n_bytes, coalesce(removed, 0)::BIGINT AS n_removed, coalesce(spans, 0)::BIGINT AS n_spans,
sha256(unhex(CASE WHEN spans IS NULL THEN h ELSE h[1:2 * ss[1]] || array_to_string(list_transform(range(1, spans + 1), lambda i: h[2 * es[i] + 1:CASE WHEN i = spans THEN 2 * n ELSE 2 * ss[i + 1] END]), '') END)) AS kept_sha256
FROM h LEFT JOIN k USING (doc_id)
"""

"""N-gram Jaccard join on signature trees.

1. Each distinct shingle set is a node. Sets of a size family are cut into k parts by hash, k above the most differences that two linked sets can have: linked sets have several equal parts that are not empty (see ``signed``). Only (hash, node) pairs are shuffled. A node with fewer shared parts than a link needs has no link and goes; the others that share a part's hash are candidates. At the size of a corpus, bitmaps of whole tiles are full and prune nothing, so this step, not the upper levels of a tree, keeps unlike sets apart.
2. Connected candidates are a block. Small blocks are joined each by itself, many to a task.
3. In a large block, shingles are ordered by the number of its sets that have them. If two sets are linked, their first common shingle comes so early in both that what follows is enough for their sizes (see ``_prefixes``): sets that share such a shingle are a group, and shingles of one set alone, as edits make them, lead to nothing. Each set meets the hub of its groups, the set with the fewest shingles of its own. Groups whose sets are then not all connected are open; their sets meet: many small groups make a task together; of a large one, the sets outside its largest component meet all others, tile by tile, in tasks of their own. No block or group of any size comes together in one task.
4. In a task, signature trees over the sets are traversed in pairs: a node holds the OR of its sets' token bitmaps and the range of their sizes. Node pairs are pruned if the largest possible overlap is too small, or if all their sets are connected already.
5. The links found, a spanning forest for each task, give the components.
"""

from __future__ import annotations

from bisect import bisect_right
from collections.abc import Iterator

import numpy as np
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from granary.llm.common import apart, arrow_map, components, ready, release
from granary.llm.shingles import M1, digest, mix, shingle_set
from granary.operators.lineage import settled

K, PERCENT = 4, 85
TILE, BITS, LEAF, FAN = 256, 4096, 8, 8


def families(percent: int, most: int) -> list[int]:
    """First sizes of the classes: linked sets are in the same class or in neighbouring ones."""
    b = [1]
    while b[-1] <= most:
        b.append(100 * b[-1] // percent + 1)
    return b


def signed(x: np.ndarray, percent: int, bounds: list[int]) -> tuple[np.ndarray, np.ndarray]:
    """Part hashes of a set, for the family of its class and of the one below; and for each 2 * need + (1 in the family below), need being how many hashes of this family the set shares with any set that it is linked with.

    Linked sets x and y of a family differ in at most d elements, so of k = d + 1 + spare parts at least spare + 1 are equal. If a set has no more than ``spare`` empty parts, all but these are equal parts that are not empty. The few sets with more empty parts also give a hash for each of these, and need one.
    """
    c, out, needs = bisect_right(bounds, len(x)) - 1, [], []
    for f in (c, c - 1):
        if f < 0:
            continue
        small = bounds[f + 1] - 1
        large = min(bounds[f + 2] - 1, 100 * small // percent)
        d = (100 - percent) * (small + large) // (100 + percent)
        if d == 0:  # only equal sets are linked
            continue
        spare = 2 + d // 16
        k = d + 1 + spare
        part = ((x >> np.uint64(17)) % np.uint64(k)).astype(np.int64)
        order = np.argsort(part, kind="stable")
        full, first = np.unique(part[order], return_index=True)
        out.append(mix(np.add.reduceat(mix(x[order] + M1), first) + mix(full.astype(np.uint64) + np.uint64(f << 32))))
        if k - len(full) > spare:
            empty = np.setdiff1d(np.arange(k), full)
            out.append(mix(mix(empty.astype(np.uint64) + np.uint64(f << 32)) ^ M1))
        need = max(1, spare + 1 - (k - len(full)))
        needs.append(np.full(sum(map(len, out)) - sum(map(len, needs)), 2 * need + (f != c), np.int64))
    return (np.concatenate(out), np.concatenate(needs)) if out else (np.zeros(0, np.uint64), np.zeros(0, np.int64))


def signatures(x: np.ndarray, percent: int, bounds: list[int]) -> np.ndarray:
    return signed(x, percent, bounds)[0]


class Tree:
    """A node of a signature tree: OR of the bitmaps, sizes from lo to hi, and the most tokens of a set that share a bit with another."""

    __slots__ = ("bits", "lo", "hi", "excess", "sets", "children", "one")

    def __init__(self, sets: list[int], children: list[Tree], bits: int, lo: int, hi: int, excess: int):
        self.sets, self.children, self.bits, self.lo, self.hi, self.excess, self.one = sets, children, bits, lo, hi, excess, len(sets) == 1

    @staticmethod
    def build(members: list[int], sets: list[np.ndarray]) -> Tree:
        """Bottom up, neighbours by least hashes: like sets come under one node."""
        level = []
        for i in sorted(members, key=lambda i: (*sets[i][:3].tolist(), len(sets[i]))):
            on = np.zeros(BITS, bool)
            on[(sets[i] & np.uint64(BITS - 1)).astype(np.int64)] = True
            level.append(Tree([i], [], int.from_bytes(np.packbits(on).tobytes()), len(sets[i]), len(sets[i]), len(sets[i]) - int(on.sum())))
        fan = LEAF
        while len(level) > 1:
            up = []
            for a in range(0, len(level), fan):
                some, bits = level[a : a + fan], 0
                for t in some:
                    bits |= t.bits
                up.append(Tree([i for t in some for i in t.sets], some, bits, min(t.lo for t in some), max(t.hi for t in some), max(t.excess for t in some)))
            level, fan = up, FAN
        return level[0]


def tree_join(sets: list[np.ndarray], left: list[int], right: list[int] | None, percent: int, known: list | None = None) -> Iterator[tuple[int, int]]:
    """A spanning forest of the links among ``left``, or between left and right: dual traversal with pruning. Sets with equal ``known`` are connected already."""
    first: dict = {}
    parent = [first.setdefault(known[i], i) if known else i for i in range(len(sets))]

    def find(i: int) -> int:
        while parent[i] != i:
            parent[i] = parent[parent[i]]
            i = parent[i]
        return i

    def connected(t: Tree) -> bool:
        if not t.one:
            r = find(t.sets[0])
            t.one = all(find(i) == r for i in t.sets)
        return t.one

    cached: dict[int, set] = {}

    def elements(i: int) -> set:
        if i not in cached:
            cached[i] = set(sets[i].tolist())
        return cached[i]

    def never(a: Tree, b: Tree) -> bool:
        most = min((a.bits & b.bits).bit_count() + min(a.excess, b.excess), a.hi, b.hi)
        return (100 + percent) * most < percent * (a.lo + b.lo) or 100 * most < percent * max(a.lo, b.lo)

    a = Tree.build(left, sets)
    stack = [(a, a if right is None else Tree.build(right, sets))]
    while stack:
        a, b = stack.pop()
        if a is not b and never(a, b):
            continue
        if connected(a) and connected(b) and find(a.sets[0]) == find(b.sets[0]):
            continue
        if a is b:
            kids = a.children
            stack += [(kids[i], kids[j]) for i in range(len(kids)) for j in range(i + 1, len(kids))]
            stack += [(x, x) for x in kids if x.children]
        elif not a.children and not b.children:
            i, j = a.sets[0], b.sets[0]
            both = len(elements(i) & elements(j))
            if 100 * both >= percent * (len(sets[i]) + len(sets[j]) - both):
                parent[find(i)] = find(j)
                yield i, j
        elif b.children and (not a.children or len(b.sets) >= len(a.sets)):
            stack += [(a, x) for x in b.children]
        else:
            stack += [(x, b) for x in a.children]


def _nodes(docs: DataFrame, k: int, seed: int) -> DataFrame:
    """doc_id, text hash, n, node: the digest of the shingle set, null without words; and another digest."""

    def make():
        def f(b):
            sets = [shingle_set(t, k) for t in b["text"]]
            return b | {"n": [len(x) for x in sets], "node": [digest(x, seed) if len(x) else None for x in sets], "check": [digest(x, seed + 1) if len(x) else None for x in sets]}

        return f

    kind = docs.schema["doc_id"].dataType.simpleString()
    return arrow_map(docs.select("doc_id", F.xxhash64("text").alias("hash"), "text"), make, f"doc_id {kind}, hash long, n long, node long, check long")


def _distinct_nodes(docs: DataFrame, k: int) -> tuple[DataFrame, int]:
    """The nodes, and the seed under which no two sets have the same digest: of sets with equal digests, the other digest and the size are equal, too."""
    seed = 0
    while True:
        nodes = settled(_nodes(docs, k, seed))
        said = nodes.where("node is not null").groupBy("node").agg(F.min(F.struct("n", "check")).alias("x"), F.max(F.struct("n", "check")).alias("y"))
        if said.where("x <> y").isEmpty():
            return nodes.drop("check"), seed
        seed += 2


def _shared(docs: DataFrame, k: int, percent: int, seed: int) -> DataFrame:
    """(sig, node, m): the signatures that a node shares with another, and what it needs (see ``signed``). Of a batch's nodes with a signature only the least is dealt out by it, the others by themselves, so a signature that very many nodes share gives a row a batch."""

    def make():
        from pyarrow import array

        seen: set[int] = set()

        def f(b):
            sig, node, m = [np.zeros(0, np.uint64)], [np.zeros(0, np.int64)], [np.zeros(0, np.int64)]
            for t in b["text"]:
                x = shingle_set(t, k)
                if len(x) and (d := digest(x, seed)) not in seen:  # a task tells of each set once
                    if len(seen) > 1_000_000:
                        seen.clear()
                    seen.add(d)
                    if len(x) >= bounds[-3]:
                        bounds[:] = families(percent, 2 * len(x))
                    s, need = signed(x, percent, bounds)
                    sig.append(s)
                    m.append(need)
                    node.append(np.full(len(s), d, np.int64))
            sig, node, m = np.concatenate(sig).view(np.int64), np.concatenate(node), np.concatenate(m)
            order = np.lexsort((node, sig))
            sig, node, m = sig[order], node[order], m[order]
            new = np.diff(sig, prepend=sig[:1] - 1) != 0
            met = np.append(~new[1:], False) | ~new  # shared within the batch
            return {"route": array(np.where(new, sig, node)), "sig": array(sig, mask=new), "node": array(node), "m": array(np.where(met, -m, m))}

        bounds = families(percent, 1_000_000)
        return f

    rows, by = arrow_map(docs.select("text"), make, "route long, sig long, node long, m long"), Window.partitionBy("route")
    rows = rows.withColumn("other", F.min("node").over(by) < F.max("node").over(by)).where("other or m < 0")
    return rows.select(F.coalesce("sig", "route").alias("sig"), "node", F.abs("m").alias("m"))


def _candidates(docs: DataFrame, k: int, percent: int, seed: int) -> DataFrame:
    """Distinct (a, b): nodes that share a signature, and the least node that has it; only of nodes that share as many as a link needs."""
    rows = settled(_shared(docs, k, percent, seed))
    enough = rows.groupBy("node", "m").agg(F.count("*").alias("n")).where("n >= shiftright(m, 1)").select("node", "m")
    rows = settled(rows.join(apart(enough, "node"), ["node", "m"]).select("sig", "node"), rows)
    least = rows.groupBy("sig").agg(F.min("node").alias("b"), F.max("node").alias("c")).where("b < c").select("sig", "b")
    return rows.join(apart(least, "sig"), "sig").select(F.col("node").alias("a"), "b").where("a > b").distinct()


def _prefixes(each: DataFrame, percent: int) -> DataFrame:
    """each (node, set) -> (group, node, own): the shingles at which a link of the set can begin.

    All sets have their shingles in the same order: by the number of sets that have it, then by value. Let w be the first common shingle of two linked sets of n and l shingles, at place p of the first one: then n - p is at least their overlap, so 100 + percent times n - p is at least percent * (n + l), which bounds l by ``most``. ``own`` is the number of shingles that no other set has; they come first and begin no link.
    """

    def make():
        def f(b):
            n = [len(s) // 8 for s in b["set"]]
            return {"node": np.repeat(np.array(b["node"], np.int64), n).tolist(), "n": np.repeat(np.array(n, np.int64), n).tolist(), "w": np.frombuffer(b"".join(b["set"]), np.int64).tolist()}

        return f

    rows = settled(arrow_map(each.select("node", "set"), make, "node long, n long, w long"))
    often = rows.groupBy("w").agg(F.count("*").alias("sets")).where("sets > 1")
    found = rows.join(apart(often, "w"), "w").groupBy("node", "n").agg(F.sort_array(F.collect_list(F.struct("sets", "w"))).alias("ws"))
    found = found.withColumn("own", F.col("n") - F.size("ws")).select("node", "n", "own", F.posexplode("ws").alias("p", "x"))
    most = F.floor((100 + percent) * (F.col("n") - F.col("own") - F.col("p")) / percent) - F.col("n")
    found = settled(found.select("node", "n", "own", F.col("x.w").alias("group"), most.alias("most")).where(100 * F.col("most") >= percent * F.col("n")), rows)
    fit = found.groupBy("group").agg(F.count("*").alias("sets"), F.min("n").alias("least"), F.max("most").alias("reach")).where("sets > 1 and least <= reach").drop("sets")
    return found.join(apart(fit, "group"), "group").where("most >= least and n <= reach").select("group", "node", "own")


def _open(groups: DataFrame) -> DataFrame:
    """groups (group, node, known) -> (block, node, known): the groups whose sets are not all connected, one for each membership."""
    rows = groups.withColumnRenamed("group", "block")
    same = rows.groupBy("block").agg(F.count("*").alias("n"), F.sum(F.xxhash64("node").cast("decimal(38,0)")).alias("x"), F.sum(F.xxhash64("node", F.lit(1)).cast("decimal(38,0)")).alias("y"), F.min("known").alias("lo"), F.max("known").alias("hi")).where("lo < hi")
    asked = same.groupBy("n", "x", "y").agg(F.min("block").alias("block")).select("block")
    return rows.join(apart(asked, "block"), "block")


def _joined(met: DataFrame, percent: int) -> DataFrame:
    """Links (a, b) of the groups (bundle, i, j) of sets, block by block; ``left`` tells the two sides, null where all are one."""

    def join(group):
        import pyarrow as pa

        blocks: dict[int, dict] = {}
        for block, n, side, known, s in zip(*(group[c].to_pylist() for c in ("block", "node", "left", "known", "set"))):
            blocks.setdefault(block, {})[n] = side, known, np.frombuffer(s, np.uint64)
        a, b = [], []
        for rows in blocks.values():
            names = sorted(rows)
            at = {side: [k for k, x in enumerate(names) if rows[x][0] is side] for side in (None, True, False)}
            left, right = (at[None], None) if at[None] else (at[True], at[False])
            if left and right != []:
                for x, y in tree_join([rows[x][2] for x in names], left, right, percent, [rows[x][1] for x in names]):
                    a.append(names[x])
                    b.append(names[y])
        return pa.table({"a": pa.array(a, pa.int64()), "b": pa.array(b, pa.int64())})

    return met.groupBy("bundle", "i", "j").applyInArrow(join, "a long, b long")


def similar(docs: DataFrame, *, k: int = K, percent: int = PERCENT, tile: int = TILE) -> DataFrame:
    """docs (doc_id, text) -> doc_id, n_shingles, component_id.

    Two documents link when 100 * intersection >= percent * union of their sets of distinct k-word shingles (A-Z lower-cased; fewer than k words are one shingle). component_id is the least doc_id reachable. No words or null text: n_shingles 0, component_id its own. Null doc_ids take part, but name a component only if it has no other. Equal rows: each. Empty table: no rows. Other columns are ignored. Sets are named by 64-bit digests, under a seed for which all are distinct.
    """
    ready(docs.sparkSession)
    docs = docs.select("doc_id", "text")
    nodes, seed = _distinct_nodes(docs, k)
    blocks = settled(components(_candidates(docs, k, percent, seed)).withColumnRenamed("component", "block"))
    release(docs.sparkSession)
    one = nodes.where("node is not null").groupBy("node").agg(F.min(F.struct("doc_id", "hash")).alias("x")).select("node", "x.*")

    def sets(members: DataFrame) -> DataFrame:
        """members (node, ...) with the set of each."""
        o, d = members.join(one, "node").withColumnRenamed("doc_id", "id").withColumnRenamed("hash", "h"), docs.withColumn("hash", F.xxhash64("text"))
        texts = d.join(o, F.col("doc_id").eqNullSafe(F.col("id")) & (F.col("hash") == F.col("h"))).select(*members.columns, "text")

        def make():
            return lambda b: b | {"set": [shingle_set(t, k).tobytes() for t in b["text"]]}

        return arrow_map(texts, make, ", ".join(f"{c} {t}" for c, t in members.dtypes) + ", set binary")

    small = F.col("many") <= tile
    many = blocks.groupBy("block").agg(F.count("*").alias("many"))
    each = settled(sets(blocks.join(apart(many, "block"), "block")))
    release(docs.sparkSession)
    none, zero = F.lit(None).cast("boolean"), F.lit(0)
    bundles = max(1, each.where(small).count() // (2 * tile))
    links = settled(_joined(each.where(small).select(F.pmod(F.xxhash64("block"), F.lit(bundles)).alias("bundle"), "block", zero.alias("i"), zero.alias("j"), none.alias("left"), F.col("node").alias("known"), "node", "set"), percent))
    each = each.where(~small).select("node", "set")
    if not each.isEmpty():
        groups = settled(_prefixes(each, percent))
        release(docs.sparkSession)
        hubs = groups.groupBy("group").agg(F.min_by("node", F.struct("own", "node")).alias("block"))
        pairs = settled(groups.join(apart(hubs, "group"), "group").where("node <> block").select("block", "node").distinct())
        bundles = max(1, pairs.count() // (2 * tile))
        parts = pairs.groupBy("block").agg(F.ceil(F.count("*") / tile).cast("int").alias("parts"))
        left = pairs.join(apart(parts, "block"), "block").select("block", F.pmod(F.xxhash64("node"), F.col("parts")).cast("int").alias("i"), F.lit(True).alias("left"), "node")
        right = parts.select("block", F.explode(F.sequence(F.lit(0), F.col("parts") - 1)).alias("i"), F.lit(False).alias("left"), F.col("block").alias("node"))
        met = left.unionAll(right).join(apart(each, "node"), "node").select(F.pmod(F.xxhash64("block"), F.lit(bundles)).alias("bundle"), "block", "i", zero.alias("j"), "left", F.col("node").alias("known"), "node", "set")
        hubbed = settled(_joined(met, percent))
        links = links.unionAll(hubbed)
        known = groups.join(apart(components(hubbed), "node"), "node", "left").select("group", "node", F.coalesce("component", "node").alias("known"))
        asked = settled(_open(known))
        release(docs.sparkSession)
        most = asked.groupBy("block", "known").agg(F.count("*").alias("n")).groupBy("block").agg(F.max_by("known", F.struct("n", "known")).alias("most"), F.max("n").alias("inner"), F.sum("n").alias("all"))
        sized = asked.join(apart(most, "block"), "block")
        small = sized.where(F.col("all") <= tile)
        bundles = max(1, small.count() // (4 * tile))
        few = small.select(F.pmod(F.xxhash64("block"), F.lit(bundles)).alias("bundle"), "block", F.lit(0).alias("i"), F.lit(0).alias("j"), none.alias("left"), "known", "node")
        large = sized.where(F.col("all") > tile).withColumns({"outside": F.col("known") != F.col("most"), "m": F.ceil(F.col("inner") / tile).cast("int"), "u": F.ceil((F.col("all") - F.col("inner")) / tile).cast("int")})
        large = large.withColumn("at", F.pmod(F.xxhash64("node", F.lit(1)), F.when(F.col("outside"), F.col("u")).otherwise(F.col("m"))).cast("int"))
        at = F.col("at")
        pair = lambda i, j, left: F.struct(i.cast("int").alias("i"), j.cast("int").alias("j"), left.alias("left"))
        outer = F.transform(F.sequence(F.lit(0), F.col("u") - 1), lambda x: pair(F.least(at, x), F.greatest(at, x), F.when(at != x, at < x)))
        cross = F.transform(F.sequence(F.lit(0), F.when(F.col("outside"), F.col("m")).otherwise(F.col("u")) - 1), lambda x: F.when(F.col("outside"), pair(at, -1 - x, F.lit(True))).otherwise(pair(x, -1 - at, F.lit(False))))
        tiled = large.withColumn("p", F.explode(F.when(F.col("outside"), F.concat(outer, cross)).otherwise(cross))).select(F.col("block").alias("bundle"), "block", "p.i", "p.j", "p.left", "known", "node")
        meeting = few.unionAll(tiled)
        links = links.unionAll(_joined(meeting.join(apart(each, "node"), "node").select("bundle", "block", "i", "j", "left", "known", "node", "set"), percent))
    found = components(links)
    named = nodes.join(apart(found, "node"), "node", "left").withColumn("component", F.coalesce("component", "node"))
    least = named.where("node is not null").groupBy("component").agg(F.min("doc_id").alias("component_id"))
    return named.join(apart(least, "component"), "component", "left").select("doc_id", F.col("n").alias("n_shingles"), F.when(F.col("node").isNull(), F.col("doc_id")).otherwise(F.col("component_id")).alias("component_id"))


_LOW = "translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz')"
SQL = rf"""
WITH RECURSIVE w AS (SELECT doc_id, regexp_extract_all({_LOW}, '[^\x20\x09-\x0D]+') AS w FROM documents),
s AS (SELECT doc_id, list_distinct(CASE WHEN len(w) = 0 THEN [] WHEN len(w) < 4 THEN [array_to_string(w, ' ')] ELSE list_transform(range(1, len(w) - 2), lambda p: array_to_string(w[p:p + 3], ' ')) END) AS s FROM w),
e AS (SELECT doc_id, len(s) AS n, unnest(s) AS g FROM s),
r AS (SELECT g FROM e GROUP BY g HAVING count(*) > 1),
p AS (SELECT a.doc_id AS a, b.doc_id AS b FROM (SELECT * FROM e SEMI JOIN r USING (g)) a JOIN (SELECT * FROM e SEMI JOIN r USING (g)) b USING (g) WHERE a.doc_id <> b.doc_id GROUP BY a.doc_id, b.doc_id, a.n, b.n HAVING 100 * count(*) >= 85 * (a.n + b.n - count(*))),
t AS (SELECT a, b FROM p UNION SELECT t.a, p.b FROM t JOIN p ON t.b = p.a)
SELECT s.doc_id, len(s.s)::BIGINT AS n_shingles, least(s.doc_id, coalesce(m.b, s.doc_id)) AS component_id FROM s LEFT JOIN (SELECT a, min(b) AS b FROM t GROUP BY a) m ON s.doc_id = m.a
"""

"""Personal data: base patterns as seeds, and bootstrapped contextual extraction on a graph of lexical patterns and instances. DataFrame functions only."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

KINDS = ("email", "ip", "card", "phone")
#: The base patterns, written so that Java scans them in linear time and without recursion: a match starts where the one before ended, or at the start of a run. Only chains of 16 to 19 digits can be cards.
EMAIL = r"(?:\G|(?<![A-Za-z0-9._%+-]))[A-Za-z0-9._%+-]++@[A-Za-z0-9-]++(?:\.[A-Za-z0-9-]++)++"
IP = r"(?:\G|(?<![0-9]))[0-9]++(?:\.[0-9]++){3}"
CARD = r"(?<![0-9])(?<![0-9][ -])[0-9](?:[ -]?[0-9]){15,18}+(?![ -]?[0-9])"
PHONE = r"\+[0-9][ ().0-9-]+[0-9]"
#: What contexts may discover: identifier-like tokens with a digit.
CANDIDATE = r"(?<![A-Za-z0-9_-])(?=[A-Za-z_-]*+[0-9])[A-Za-z0-9_-]{9,}+"
#: A pattern is the two tokens before. It is trusted with so many distinct seeds and such a share of them among its instances; instances above TRUST seed the next round.
SEEDS, SHARE, TRUST, ROUNDS, CONTEXT = 3, 0.8, 0.9, 3, 48
SPANS = "array<struct<s:int,e:int>>"


def _luhn(m: Column) -> Column:
    digits = F.reverse(F.split(F.regexp_replace(m, "[ -]", ""), ""))
    value = F.transform(digits, lambda c, i: F.when(i % 2 == 0, c.cast("int")).otherwise((c.cast("int") * 2) % 10 + F.floor(c.cast("int") / 5).cast("int")))
    return F.aggregate(value, F.lit(0), lambda a, x: a + x) % 10 == 0


def _digits(m: Column) -> Column:
    return F.length(F.regexp_replace(m, "[^0-9]", ""))


OK = {
    "email": lambda m: F.lit(True),
    "ip": lambda m: m.rlike(r"^(?:0*+(?:25[0-5]|2[0-4][0-9]|1[0-9][0-9]|[1-9]?[0-9]|)(?:\.|$)){4}$"),
    "card": _luhn,
    "phone": lambda m: _digits(m).between(8, 15),
}


def _spans(text: Column, found: str, rx: str, ok) -> Column:
    """Spans (start, end in code points) of the matches in column ``found`` that are ok: lengths of the text between matches, and of the matches, summed up."""
    zipped = F.arrays_zip(F.split(text, rx, -1).alias("g"), F.col(found).alias("m"))
    zero = F.struct(F.lit(0).alias("at"), F.array().cast(SPANS).alias("out"))

    def step(a, x):
        s = a["at"] + F.length(x["g"])
        e = s + F.coalesce(F.length(x["m"]), F.lit(0))
        keep = x["m"].isNotNull() & ok(x["m"])
        return F.struct(e.alias("at"), F.when(keep, F.concat(a["out"], F.array(F.struct(s.alias("s"), e.alias("e"))))).otherwise(a["out"]).alias("out"))

    return F.when(F.size(found) > 0, F.aggregate(zipped, zero, step, lambda a: a["out"])).otherwise(F.array().cast(SPANS))


def _context(text: Column, start: Column) -> Column:
    """The two tokens before a span, lower case, digits as 0; null if there aren't two within CONTEXT characters."""
    left = F.substring(text, F.greatest(start - CONTEXT + 1, F.lit(1)), F.least(start, F.lit(CONTEXT)))
    two = F.regexp_extract(left, r"(\S+\s+\S+)\s*$", 1)
    return F.when(two != "", F.regexp_replace(F.regexp_replace(F.lower(two), r"\s+", " "), "[0-9]", "0"))


def _key(*columns) -> Column:
    """128 bits of the columns: two hashes that start apart, so that spans never reach another text."""
    return F.concat(F.hex(F.xxhash64(*columns)), F.hex(F.xxhash64(F.lit("granary"), *columns)))


def base(docs: DataFrame, *keep: str) -> DataFrame:
    """keep, key, the spans of each kind, and arrays seed and cand of (s, e, instance, pattern). Row by row. Each pattern runs only over texts with a character that it needs."""
    text = F.coalesce(F.col("text"), F.lit(""))
    need = {"email": "@", "ip": ".", "card": None, "phone": "+"}
    rx = {"email": EMAIL, "ip": IP, "card": CARD, "phone": PHONE, "cand": CANDIDATE}
    none = F.array().cast("array<string>")
    d = docs.select(*keep, text.alias("_t"), *[(F.when(F.contains(text, F.lit(need[k])), F.regexp_extract_all(text, F.lit(r), F.lit(0))).otherwise(none) if need.get(k) else F.regexp_extract_all(text, F.lit(r), F.lit(0))).alias(f"_{k}") for k, r in rx.items()])
    d = d.select(*keep, "_t", *[_spans(F.col("_t"), f"_{k}", rx[k], OK[k]).alias(k) for k in KINDS], _spans(F.col("_t"), "_cand", CANDIDATE, lambda m: F.lit(True)).alias("_c"))
    every = F.concat(*KINDS)
    d = d.withColumn("_c", F.filter("_c", lambda c: ~F.exists(every, lambda b: (b["s"] < c["e"]) & (c["s"] < b["e"]))))

    def told(spans):
        return F.filter(F.transform(spans, lambda x: F.struct(x["s"].alias("s"), x["e"].alias("e"), F.substring("_t", x["s"] + 1, x["e"] - x["s"]).alias("instance"), _context(F.col("_t"), x["s"]).alias("pattern"))), lambda x: x["pattern"].isNotNull())

    return d.select(*keep, _key(*keep, "_t").alias("key"), *KINDS, told(every).alias("seed"), told(F.col("_c")).alias("cand"))


def discover(found: DataFrame) -> DataFrame:
    """found (key, seed, cand) -> (key, s, e) of the spans that trusted patterns add.

    Edges are distinct (pattern, instance) pairs. Each round scores patterns by the mean score of their instances and instances by the noisy-or of their trusted patterns, and what is scored TRUST or more is a seed of the next. All by grouped sums, so that a pattern or instance of any frequency is reduced before it is shuffled.
    """
    some = found.where("size(seed) + size(cand) > 0")
    edges = some.select(F.explode(F.concat(F.transform("seed", lambda x: F.struct(x["pattern"].alias("p"), x["instance"].alias("i"), F.lit(1.0).alias("seed"))), F.transform("cand", lambda x: F.struct(x["pattern"].alias("p"), x["instance"].alias("i"), F.lit(0.0).alias("seed"))))).alias("x")).groupBy("x.p", "x.i").agg(F.max("x.seed").alias("seed")).checkpoint()
    seeds = edges.groupBy("i").agg(F.max("seed").alias("seed"))
    scores = seeds.select("i", "seed", F.col("seed").alias("score"))
    for _ in range(ROUNDS):
        patterns = edges.select("p", "i").join(scores, "i").groupBy("p").agg(F.avg("score").alias("share"), F.sum(F.when(F.col("score") >= TRUST, 1).otherwise(0)).alias("n")).where((F.col("n") >= SEEDS) & (F.col("share") >= SHARE)).select("p", "share").checkpoint()
        by = edges.select("p", "i").join(patterns, "p").groupBy("i").agg((1 - F.exp(F.sum(F.log(F.greatest(1 - F.col("share"), F.lit(1e-6)))))).alias("by"))
        scores = seeds.join(by, "i", "left").select("i", "seed", F.greatest("seed", F.coalesce("by", F.lit(0.0))).alias("score"))
    return some.select("key", F.explode("cand").alias("x")).join(patterns, F.col("x.pattern") == F.col("p")).select("key", "x.s", "x.e").distinct()


def spans(docs: DataFrame, *keep: str) -> DataFrame:
    """keep, key, the base spans of each kind and context: what the trusted patterns added."""
    found = base(docs, *keep).checkpoint()
    more = discover(found).groupBy("key").agg(F.array_sort(F.collect_list(F.struct("s", "e"))).alias("context"))
    return found.drop("seed", "cand").join(more, "key", "left").withColumn("context", F.coalesce("context", F.array().cast(SPANS)))


def _joined(*kinds: str) -> Column:
    def told(kind):
        return F.transform(kind, lambda x: F.concat_ws(":", F.lit(kind), x["s"].cast("string"), x["e"].cast("string")))

    return F.array_join(F.concat(*map(told, kinds)), ",")


def report(docs: DataFrame) -> DataFrame:
    """doc_id, n_email, n_ip, n_card, n_phone, base_sha256, spans of docs (doc_id, text). Null or empty text: no spans. Equal rows: each. Other columns are ignored."""
    return spans(docs.select("doc_id", "text"), "doc_id").select("doc_id", *[F.size(k).cast("long").alias(f"n_{k}") for k in KINDS], F.sha2(_joined(*KINDS), 256).alias("base_sha256"), _joined(*KINDS, "context").alias("spans"))


def redact(docs: DataFrame) -> DataFrame:
    """The documents with every span replaced by <KIND>; overlapping spans as one. Columns stay; n_chars follows the text where there is such a column. Null text stays null."""
    keyed = docs.withColumn("_granary_key", _key("doc_id", F.coalesce("text", F.lit(""))))
    found = spans(docs.select("doc_id", "text"), "doc_id")
    def named(kind):
        return F.transform(kind, lambda x: F.struct(x["s"].alias("s"), x["e"].alias("e"), F.lit(f"<{kind.upper()}>").alias("k")))

    flat = F.array_sort(F.concat(*map(named, (*KINDS, "context"))))
    found = found.where(" + ".join(f"size({k})" for k in (*KINDS, "context")) + " > 0").select(F.col("key").alias("_granary_found"), flat.alias("_granary_spans")).dropDuplicates(["_granary_found"])
    out = F.aggregate(
        "_granary_spans",
        F.struct(F.lit(0).alias("at"), F.array().cast("array<string>").alias("out")),  # pieces, not the growing text
        lambda a, x: F.struct(F.greatest(a["at"], x["e"]).alias("at"), F.when(x["s"] < a["at"], a["out"]).otherwise(F.concat(a["out"], F.array(F.substring("text", a["at"] + 1, x["s"] - a["at"]), x["k"]))).alias("out")),
        lambda a: F.array_join(F.concat(a["out"], F.array(F.substring(F.col("text"), a["at"] + 1, F.length("text")))), ""),
    )
    d = keyed.join(found, F.col("_granary_key") == F.col("_granary_found"), "left")
    d = d.withColumn("text", F.when(F.col("_granary_spans").isNull(), F.col("text")).otherwise(out))
    if "n_chars" in docs.columns:
        d = d.withColumn("n_chars", F.length("text").cast(docs.schema["n_chars"].dataType))
    return d.select(*docs.columns)

"""Packing token pieces into sequences by minimum bin slack.

Documents are tokenised where they lie and cut into pieces. Only the histogram of piece lengths, at most ``most`` numbers whatever the corpus, is packed: for each sequence a bitset dynamic programme over the lengths that are left finds the fullest combination that holds the longest of them, and the combination is taken as often as the histogram allows. Pieces get their places by rank: sorted by length in range partitions, the pieces of a length are dealt to the combinations in turn.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from granary.llm.common import arrow_map, ready
from granary.llm.resample import ranked
from granary.operators.lineage import settled

#: Tokens of a sequence; the id after each document; long texts are cut into parts of so many characters.
MOST, END, CALL = 2048, 0, 1 << 19
#: Fixed value: how a byte-level tokenizer splits texts before its merges.
PATTERN = r"'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"
TOKENIZER = "byte_bpe_50k.json"


def parts(text: str, size: int = CALL) -> Iterator[str]:
    """The text in parts of about ``size`` characters. Cuts lie before a single space between visible characters, where a byte-level tokenizer starts a word, so the parts' tokens are the text's."""
    at = 0
    while len(text) - at > size:
        cut = text.find(" ", at + size)
        while 0 < cut < len(text) - 1 and (text[cut - 1].isspace() or text[cut + 1].isspace()):
            cut = text.find(" ", cut + 1)
        if not 0 < cut < len(text) - 1:
            break
        yield text[at:cut]
        at = cut
    yield text[at:]


def load_tokenizer(path: str | None):
    """An encoder of the byte-level vocabulary in a tokenizers file that every executor has: the ids are those of that library, at a fifth of the time. Ids are ranks of merges. Strings of special tokens are ordinary text."""
    import json

    import tiktoken

    if path is None:
        import public_tokenizers

        path = public_tokenizers.path(TOKENIZER)
    with open(path, encoding="utf-8") as f:
        made = json.load(f)
    if made["pre_tokenizer"] != {"type": "ByteLevel", "add_prefix_space": False, "trim_offsets": True, "use_regex": True} or made["normalizer"]:
        raise ValueError(f"{path} is no plain byte-level vocabulary")
    shown = [*range(33, 127), *range(161, 173), *range(174, 256)]  # bytes written as themselves; the others in turn from 256 on
    byte = {chr(b): b for b in shown} | {chr(256 + i): b for i, b in enumerate(x for x in range(256) if x not in shown)}
    special = {t["content"] for t in made["added_tokens"]}
    ranks = {bytes(byte[c] for c in t): i for t, i in made["model"]["vocab"].items() if t not in special}
    return tiktoken.Encoding("own", pat_str=PATTERN, mergeable_ranks=ranks, special_tokens={})


def encoded(tokenizer, text: str | None, size: int = CALL) -> np.ndarray:
    """Ids of the text and END, as little-endian unsigned 32-bit numbers."""
    found = [np.array(tokenizer.encode_ordinary(p), "<u4") for p in parts(text or "", size)]
    return np.concatenate([*found, np.array([END], "<u4")])


def cuts(n: int, most: int) -> list[tuple[int, int]]:
    """(start, length) of the pieces of n tokens: whole ones at the end, what is over first."""
    first = n % most or most
    return [(0, first)] + [(s, most) for s in range(first, n, most)]


def pieces(docs: DataFrame, *, most: int = MOST, tokenizer: str | None = None) -> DataFrame:
    """docs (doc_id, text) -> doc_id, piece, start, length, ids (binary, little-endian unsigned 32-bit): one row for each piece of at most ``most`` tokens. Null text is empty: one piece, END alone."""

    def make():
        known = load_tokenizer(tokenizer)

        def f(b):
            out = {c: [] for c in ("doc_id", "piece", "start", "length", "ids")}
            for d, t in zip(b["doc_id"], b["text"]):
                ids = encoded(known, t)
                for p, (s, n) in enumerate(cuts(len(ids), most)):
                    for c, x in zip(out, (d, p, s, n, ids[s : s + n].tobytes())):
                        out[c].append(x)
            return out

        return f

    kind = docs.schema["doc_id"].dataType.simpleString()
    return arrow_map(docs.select("doc_id", "text"), make, f"doc_id {kind}, piece int, start long, length long, ids binary")


def fullest(left: dict[int, int], room: int) -> dict[int, int]:
    """The bounded multiset of lengths with the greatest sum up to room. Bit s of ``reach`` tells that s can be filled; lengths enter the longest first, their copies doubled up, until room itself can be; of equal sums, the longer lengths are used."""
    reach, wanted, steps = 1, 1 << room, []
    inside = (wanted << 1) - 1
    for n in sorted((n for n in left if n <= room), reverse=True):
        copies, k = min(left[n], room // n), 1
        while copies > 0 and not reach & wanted:
            k = min(k, copies)
            steps.append((reach, n, k))
            reach |= (reach << n * k) & inside
            copies, k = copies - k, 2 * k
    at, used = reach.bit_length() - 1, {}
    for before, n, k in reversed(steps):
        if not before >> at & 1:
            used[n] = used.get(n, 0) + k
            at -= n * k
    return used


def combinations(histogram: dict[int, int], most: int) -> Iterator[tuple[int, dict[int, int]]]:
    """(times, {length: copies}) until nothing of the histogram is left. As the longest length goes first, and a combination that is fullest stays so while it can be had, every sequence has the least slack."""
    left = {n: c for n, c in histogram.items() if c > 0}
    while left:
        longest = max(left)
        rest = left | {longest: left[longest] - 1}
        used = fullest({n: c for n, c in rest.items() if c}, most - longest)
        used[longest] = used.get(longest, 0) + 1
        times = min(left[n] // c for n, c in used.items())
        for n, c in used.items():
            left[n] -= c * times
            if not left[n]:
                del left[n]
        yield times, used


def slots(histogram: dict[int, int], most: int) -> np.ndarray:
    """Rows (first rank, copies, sequence, offset): from a rank on, the pieces in order of length fill ``copies`` places from ``offset`` in each sequence from ``sequence`` on."""
    begin, at = {}, 0
    for n in sorted(histogram):
        begin[n], at = at, at + histogram[n]
    rows, sequence = [], 0
    for times, used in combinations(histogram, most):
        offset = 0
        for n, c in sorted(used.items(), reverse=True):
            rows.append((begin[n], c, sequence, offset))
            begin[n], offset = begin[n] + c * times, offset + n * c
        sequence += times
    return np.array(sorted(rows), np.int64).reshape(-1, 4)


def place(found: DataFrame, *, most: int = MOST) -> DataFrame:
    """found (doc_id, piece, length, ...) -> also sequence_id, offset. The histogram of lengths, at most ``most`` rows, and the places made of it are all that the driver holds."""
    spark = ready(found.sparkSession)
    rows = settled(found)
    histogram = {r.length: r.n for r in rows.groupBy("length").agg(F.count("*").alias("n")).collect()}
    table = spark.sparkContext.broadcast(slots(histogram, most))
    placed = ranked(rows, F.col("length"), F.asc_nulls_last("doc_id"), F.col("piece"))

    @F.pandas_udf("sequence_id long, offset long")
    def where(at, length):
        import pandas as pd

        t = table.value
        row = t[np.searchsorted(t[:, 0], at.to_numpy(), "right") - 1] if len(t) else np.zeros((0, 4), np.int64)
        past = at.to_numpy() - row[:, 0]
        return pd.DataFrame({"sequence_id": row[:, 2] + past // np.maximum(row[:, 1], 1), "offset": row[:, 3] + past % np.maximum(row[:, 1], 1) * length.to_numpy()})

    return placed.withColumn("w", where("at", "length")).select(*found.columns, "w.*")


def pack(docs: DataFrame, *, most: int = MOST, tokenizer: str | None = None, ids: bool = True) -> DataFrame:
    """docs (doc_id, text) -> doc_id, piece, start, length, ids_crc32, sequence_id, offset, and the ids (binary) if wanted.

    Documents of more than ``most`` tokens, END included, are cut into pieces of ``most`` tokens; only the first may be shorter. Pieces of a sequence lie one after another from offset 0.

    Null or empty text: END alone, one piece. Null doc_ids and equal rows: each row is packed. Empty table: no rows. Other columns are ignored.
    """
    ready(docs.sparkSession)
    found = pieces(docs, most=most, tokenizer=tokenizer).withColumn("ids_crc32", F.crc32("ids"))
    return place(found if ids else found.drop("ids"), most=most)


def sequences(packed: DataFrame) -> DataFrame:
    """What pack gives with ids -> (sequence_id, n_tokens, n_pieces, ids): the sequences themselves. A group holds at most the tokens of one sequence."""
    g = packed.groupBy("sequence_id").agg(F.sum("length").alias("n_tokens"), F.count("*").alias("n_pieces"), F.sort_array(F.collect_list(F.struct("offset", "doc_id", "piece", "ids"))).alias("p"))
    return g.select("sequence_id", "n_tokens", "n_pieces", F.aggregate("p", F.lit(b""), lambda a, x: F.concat(a, x["ids"])).alias("ids"))

"""Language identification: per-language piece unigrams over a fixed public vocabulary, segmentations summed out."""

from __future__ import annotations

import re

import numpy as np
import regex
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from granary.llm.common import arrow_map

VOCABULARY = "/opt/tokenizers/piece_bpe_32k.model"
MARK = "\u2581"
#: Longer words are scored by a recursion that is scaled as it goes.
LONG = 40
SCALE, UNKNOWN = 16.0, 1e-7
MULT = np.uint64(0x9E3779B97F4A7C15)
#: The model is fitted on about so many labelled documents of each language.
SAMPLE_DOCUMENTS = 200
WORDS, LETTERS = re.compile(r"[^\W\d_]+"), regex.compile(r"\p{L}+")


def pieces(path: str = VOCABULARY) -> list[str]:
    """The vocabulary's pieces of lower-case letters, with or without the word mark."""
    import sentencepiece

    sp = sentencepiece.SentencePieceProcessor(model_file=path)
    found = (sp.id_to_piece(i) for i in range(sp.get_piece_size()))
    return sorted({p for p in found if p.lower() == p and (p == MARK or p.removeprefix(MARK).isalpha())})


class Lattice:
    """Looks up every substring of a batch of words at once."""

    def __init__(self, vocabulary: list[str]):
        h = np.array([self._hash(p) for p in vocabulary], np.uint64)
        self.order = np.argsort(h)
        self.keys, self.size = h[self.order], len(vocabulary)
        self.length = np.array([len(p) for p in vocabulary])
        self.longest = int(self.length.max())
        self.filter = np.zeros(1 << 20, bool)
        self.filter[(self.keys >> np.uint64(44)).astype(np.int64)] = True

    @staticmethod
    def _hash(p: str) -> int:
        h = 0
        for c in p:
            h = (h * int(MULT) + ord(c) + 1) % (1 << 64)
        return (h ^ (h >> 31)) * 0xBF58476D1CE4E5B9 % (1 << 64)

    def codes(self, words: list[str]) -> tuple[np.ndarray, np.ndarray]:
        n = np.array([len(w) + 1 for w in words])
        flat = np.frombuffer("".join([(MARK + w).ljust(n.max(), "\0") for w in words]).encode("utf-32-le"), np.uint32)
        return flat.reshape(len(words), -1), n

    def ids(self, codes: np.ndarray) -> list[np.ndarray]:
        """For each length k, the piece at each start; self.size where there is none, self.size + 1 for a single unknown letter."""
        out, h = [], np.zeros(codes.shape, np.uint64)
        for k in range(1, min(self.longest, codes.shape[1]) + 1):
            h = h[:, : codes.shape[1] - k + 1] * MULT + codes[:, k - 1 :] + np.uint64(1)
            m = (h ^ (h >> np.uint64(31))) * np.uint64(0xBF58476D1CE4E5B9)
            got = np.full(h.shape, self.size + (k == 1), np.int32)
            r, c = np.nonzero(self.filter[(m >> np.uint64(44)).astype(np.int64)])
            at = np.searchsorted(self.keys, m[r, c]).clip(max=self.size - 1)
            hit = self.keys[at] == m[r, c]
            got[r[hit], c[hit]] = self.order[at[hit]]
            out.append(got)
        return out

    def weights(self, p: np.ndarray) -> np.ndarray:
        """Piece probabilities [pieces, languages], scaled by length, with rows for no piece and an unknown letter."""
        return np.vstack([p * SCALE ** self.length[:, None], np.zeros(p.shape[1]), np.full(p.shape[1], UNKNOWN * SCALE)])

    @staticmethod
    def forward(ids: list[np.ndarray], w: np.ndarray) -> np.ndarray:
        """alpha[j, word, language]: the summed weight of all segmentations of the first j letters."""
        n, m = ids[0].shape
        alpha = np.zeros((m + 1, n, w.shape[1]))
        alpha[0] = 1
        for j in range(1, m + 1):
            for k in range(1, min(len(ids), j) + 1):
                alpha[j] += alpha[j - k] * w[ids[k - 1][:, j - k]]
        return alpha

    @staticmethod
    def scaled(ids: list[np.ndarray], w: np.ndarray, n: np.ndarray) -> np.ndarray:
        """Logarithm of the forward sum at the end of each word. Only the last sums are held, brought to a common scale at every 16th letter, so words of any length neither overflow nor vanish."""
        many, m = ids[0].shape
        last, log, out = [np.ones((many, w.shape[1]))], np.zeros((many, w.shape[1])), np.zeros((many, w.shape[1]))
        for j in range(1, m + 1):
            now = sum(last[-k] * w[ids[k - 1][:, j - k]] for k in range(1, min(len(ids), j) + 1))
            last = [*last[-len(ids) :], now]
            if j % 16 == 0:
                top = np.maximum.reduce(last)
                last, log = [x / top for x in last], log + np.log(top)
            out[n == j] = (np.log(last[-1]) + log)[n == j]
        return out

    def score(self, words: list[str], w: np.ndarray) -> np.ndarray:
        """log P(word | language) of each word, over all segmentations."""
        out = np.empty((len(words), w.shape[1]))
        for some in _groups(words, sorted(range(len(words)), key=lambda i: len(words[i]))):
            codes, n = self.codes([words[i] for i in some])
            if codes.shape[1] > LONG + 1:
                out[some] = self.scaled(self.ids(codes), w, n) - n[:, None] * np.log(SCALE)
            else:
                alpha = self.forward(self.ids(codes), w)
                out[some] = np.log(alpha[n, np.arange(len(some))]) - n[:, None] * np.log(SCALE)
        return out

    def fit(self, words: dict[str, int], rounds: int = 4, add: float = 0.01) -> np.ndarray:
        """Expectation maximisation of the piece probabilities of one language. Words of more than LONG letters, as in scripts without spaces, teach in runs of LONG letters; only pieces across two runs are not seen."""
        runs: dict[str, int] = {}
        for x, n in words.items():
            for a in range(0, len(x), LONG):
                runs[x[a : a + LONG]] = runs.get(x[a : a + LONG], 0) + n
        p, by, words = np.full((self.size, 1), 1.0 / self.size), sorted(runs, key=len), runs
        for _ in range(rounds):
            count, w = np.zeros(self.size + 2), self.weights(p)
            for a in range(0, len(by), 8192):
                some = by[a : a + 8192]
                codes, n = self.codes(some)
                ids = self.ids(codes)
                alpha = self.forward(ids, w)[:, :, 0]
                m, beta = ids[0].shape[1], np.zeros((ids[0].shape[1] + 1, len(some)))
                beta[n, np.arange(len(some))] = 1
                share = np.array([words[x] for x in some]) / alpha[n, np.arange(len(some))]
                for i in range(m - 1, -1, -1):
                    for k in range(1, min(len(ids), m - i) + 1):
                        g = ids[k - 1][:, i]
                        part = w[g, 0] * beta[i + k]
                        beta[i] += part
                        np.add.at(count, g, alpha[i] * part * share)
            p = ((count[: self.size] + add) / (count[: self.size].sum() + add * self.size))[:, None]
        return p[:, 0]


def _groups(words: list[str], by: list[int]):
    """Runs of ``by``, in order of length, of at most 8,192 words and about as many letters as so many words of LONG have."""
    a = 0
    while a < len(by):
        short = len(words[by[a]]) <= LONG
        b = min(a + 8192, len(by))
        while b - a > 1 and ((len(words[by[b - 1]]) <= LONG) != short or (b - a) * len(words[by[b - 1]]) > 8192 * LONG):
            b = a + (b - a) // 2
        yield by[a:b]
        a = b


def _letters(text: str | None) -> list[str]:
    """Runs of letters, lower case. The faster pattern also takes numerals such as one half, which are split off."""
    words = WORDS.findall((text or "").lower())
    return words if all(map(str.isalpha, words)) else [x for w in words for x in ([w] if w.isalpha() else LETTERS.findall(w))]


def fold(doc_id) -> F.Column:
    return F.crc32(F.coalesce(F.col(doc_id).cast("string"), F.lit("")).cast("binary")) % 4


def train(labelled: DataFrame, *, vocabulary: str = VOCABULARY, sample_documents: int = SAMPLE_DOCUMENTS) -> dict:
    """labelled (doc_id, text, lang) -> model. Fitted on about ``sample_documents`` whole documents of each language, chosen by a hash of doc_id; only their word counts reach the driver."""
    d = labelled.where("lang is not null and text is not null")
    lang_n = {r.lang: r.n for r in d.groupBy("lang").agg(F.count("*").alias("n")).collect()}
    share = F.lit(0.0)
    for k, n in sorted(lang_n.items()):
        share = F.when(F.col("lang") == k, F.lit(min(1.0, sample_documents / n))).otherwise(share)
    d = d.where(F.pmod(F.xxhash64(F.col("doc_id").cast("string")), F.lit(1_000_000)) < share * 1_000_000)

    def count():
        def f(b):
            from collections import Counter

            total: dict[str, Counter] = {}
            for lang, text in zip(b["lang"], b["text"]):
                total.setdefault(lang, Counter()).update(_letters(text))
            flat = [(k, w, n) for k, c in total.items() for w, n in c.items()]
            return {"lang": [x[0] for x in flat], "word": [x[1] for x in flat], "n": [x[2] for x in flat]}

        return f

    words: dict[str, dict[str, int]] = {}
    for r in arrow_map(d.select("lang", "text"), count, "lang string, word string, n long").groupBy("lang", "word").agg(F.sum("n").alias("n")).orderBy("lang", "word").collect():
        words.setdefault(r.lang, {})[r.word] = r.n
    vocab = pieces(vocabulary)
    lattice = Lattice(vocab)
    return {"langs": sorted(words), "pieces": vocab, "p": np.column_stack([lattice.fit(words[k]) for k in sorted(words)]) if words else np.zeros((len(vocab), 0))}


def predict(spark: SparkSession, docs: DataFrame, model: dict) -> DataFrame:
    """docs (any columns with text) -> the same with lang_pred and score (posterior of the prediction, equal priors). Text that is null or has no letter, and any text where no language was learned: und, 0."""
    sent = spark.sparkContext.broadcast(model)
    docs = docs.drop("lang_pred", "score")
    at = docs.columns.index("text")

    def run(batches):
        import pyarrow as pa

        m = sent.value
        lattice = Lattice(m["pieces"])
        w, known, table, langs = lattice.weights(m["p"]), {}, np.zeros((0, len(m["langs"]))), m["langs"]
        for b in batches:
            lists = [_letters(t) for t in b.column(at).to_pylist()]
            if len(known) > 600_000:  # forgotten words are scored again
                known, table = {}, table[:0]
            new = [x for x in set().union(*lists) if x not in known]
            if new and langs:
                known.update(zip(new, range(len(known), len(known) + len(new))))
                table = np.vstack([table, lattice.score(new, w)])
            lang, score = [], []
            for x in lists:
                if not x or not langs:
                    lang.append("und")
                    score.append(0.0)
                    continue
                s = table[np.fromiter(map(known.__getitem__, x), np.int64, len(x))].sum(axis=0)
                k = int(s.argmax())
                lang.append(langs[k])
                score.append(float(1 / np.exp(s - s[k]).sum()))
            yield pa.RecordBatch.from_arrays([*b.columns, pa.array(lang, pa.string()), pa.array(score, pa.float64())], names=[*b.schema.names, "lang_pred", "score"])

    return docs.mapInArrow(run, _with(docs, "lang_pred string, score double"))


def _with(df: DataFrame, more: str):
    from pyspark.sql.types import StructType, _parse_datatype_string

    return StructType([*df.schema.fields, *_parse_datatype_string(more).fields])


def identify(docs: DataFrame, *, vocabulary: str = VOCABULARY) -> DataFrame:
    """doc_id, held_out, lang_pred, score of docs (doc_id, text, lang). Learned from the documents whose crc32(doc_id) mod 4 is not 2; a null doc_id counts as the empty string. Equal rows: each. Other columns are ignored."""
    model = train(docs.where(fold("doc_id") != 2), vocabulary=vocabulary)
    out = predict(docs.sparkSession, docs.select("doc_id", "text"), model)
    return out.select("doc_id", (fold("doc_id") == 2).alias("held_out"), "lang_pred", "score")

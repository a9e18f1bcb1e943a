"""Language identification by segmentation-marginalised unigrams.

The pieces of a fixed public vocabulary get one probability per language. The
probability of a word is the sum over all ways to cut it into pieces, found by
the forward algorithm; a text is the product of its words. The piece
probabilities are fitted by expectation-maximisation (forward-backward), on at
most ``sample_docs`` labelled texts of each language, chosen by the hash of
their doc_id and used whole.

Words are runs of letters in lower case, preceded by the word mark of the
vocabulary; a character that is no piece is spelled in its byte pieces.

Defined results:

* null text or no letter (numerals are none): ``und``, score 0;
* no labelled training text at all: ``und``, score 0;
* ``score``: posterior of the predicted language, all equally likely before;
* equal likelihoods: the first language by name;
* null doc_id: not held out and not learned from; repeated rows: the same
  result for each; empty table: empty result; other columns are ignored.

The model sent to the tasks has (languages) x (vocabulary) numbers: about
0.25 MB per language. Each task remembers at most ``CACHE_CELLS`` word scores
(800,000 words with four languages).
"""

from __future__ import annotations

import math
import re
from collections import Counter
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from gaugeflow.llm.common import bound_batches, pick, stage

VOCABULARY = "/opt/tokenizers/piece_bpe_32k.model"
SAMPLE_DOCS = 200   # labelled texts per language to learn from
MARGIN_DOCS = 100   # more of them are ranked, so that a cut by hash leaves enough
ROUNDS = 3          # of expectation-maximisation
SMOOTHING = 0.1     # added to the expected count of every piece
CACHE_CELLS = 3_200_000  # word scores that a task remembers, over all languages
SLICE_CHARS = 1 << 20  # of text scored together
AT_ONCE = 4096         # words that go through the forward sums together
LONG = 60              # letters from which a word goes alone
WORD_MARK = "▁"

_WORD = re.compile(r"[^\W\d_]+")


class Pieces:
    """The vocabulary: piece to number, all piece prefixes, byte pieces."""

    def __init__(self, pieces: list[str]):
        self.ids = {p: i for i, p in enumerate(pieces)}
        self.size = len(pieces)
        self.prefixes = {p[:i] for p in pieces for i in range(1, len(p) + 1)}

    @classmethod
    def load(cls, path: str) -> Pieces:
        import sentencepiece

        sp = sentencepiece.SentencePieceProcessor(model_file=path)
        return cls([sp.id_to_piece(i) for i in range(sp.get_piece_size())])

    def edges(self, word: str) -> tuple[list[tuple[int, int, tuple[int, ...]]], int]:
        """(from, to, piece numbers) of every piece in the marked word, by
        start, and the number of characters. Several numbers: byte pieces."""
        s, out = WORD_MARK + word, []
        n, ids, prefixes = len(s), self.ids, self.prefixes
        for i in range(n):
            j = i + 1
            part = s[i:j]
            if part not in ids:
                out.append((i, j, tuple(ids[f"<0x{b:02X}>"] for b in part.encode("utf-8", "surrogatepass")
                                        if f"<0x{b:02X}>" in ids)))
            while part in prefixes:
                if part in ids:
                    out.append((i, j, (ids[part],)))
                j += 1
                if j > n:
                    break
                part = s[i:j]
        return out, n


def words(text: str | None) -> Counter:
    """Runs of letters with their counts. The pattern also takes numerals
    that are no digits (such as a half); they are taken out of the runs."""
    found = Counter(_WORD.findall((text or "").lower()))
    for w in [w for w in found if not w.isalpha()]:
        n = found.pop(w)
        for part in "".join(c if c.isalpha() else " " for c in w).split():
            found[part] += n
    return found


def _weight(p: list[float], numbers: tuple[int, ...]) -> float:
    w = 1.0
    for k in numbers:
        w *= p[k]
    return w


def log_probability(edges, n: int, p: list[float]) -> float:
    """Log of the summed probability of all segmentations (forward)."""
    a = [0.0] * (n + 1)
    a[0] = 1.0
    for i, j, numbers in edges:
        a[j] += a[i] * (p[numbers[0]] if len(numbers) == 1 else _weight(p, numbers))
    if a[n] > 1e-290:
        return math.log(a[n])
    low = float("-inf")  # a long word: the same sums in logarithms
    la = [low] * (n + 1)
    la[0] = 0.0
    for i, j, numbers in edges:
        x = la[i] + sum(math.log(p[k]) for k in numbers)
        hi, lo = max(la[j], x), min(la[j], x)
        la[j] = hi if lo == low else hi + math.log1p(math.exp(lo - hi))
    return la[n]


def _log_add(x: float, y: float) -> float:
    hi, lo = max(x, y), min(x, y)
    return hi if lo == float("-inf") else hi + math.log1p(math.exp(lo - hi))


def _shares(edges, n: int, p: list[float]) -> list[float]:
    """Expected uses of each edge in one word, in logarithms: for words whose
    sums are too small for a float."""
    low = float("-inf")
    w = [sum(math.log(p[k]) for k in numbers) for _, _, numbers in edges]
    a, b = [low] * (n + 1), [low] * (n + 1)
    a[0] = b[n] = 0.0
    for (i, j, _), x in zip(edges, w, strict=True):
        a[j] = _log_add(a[j], a[i] + x)
    for (i, j, _), x in zip(reversed(edges), reversed(w), strict=True):
        b[i] = _log_add(b[i], x + b[j])
    return [math.exp(a[i] + x + b[j] - a[n]) for (i, j, _), x in zip(edges, w, strict=True)]


def fit(pieces: Pieces, counts: dict[str, int], rounds: int = ROUNDS) -> list[float]:
    """Piece probabilities of one language from its word counts."""
    p = [1.0 / pieces.size] * pieces.size
    for _ in range(rounds):
        got = [SMOOTHING] * pieces.size
        for word, c in counts.items():
            edges, n = pieces.edges(word)
            w = [_weight(p, k) for _, _, k in edges]
            a, b = [0.0] * (n + 1), [0.0] * (n + 1)
            a[0] = b[n] = 1.0
            for (i, j, _), x in zip(edges, w, strict=True):
                a[j] += a[i] * x
            if a[n] < 1e-290:  # a long word, or some 20 characters spelled in bytes
                for (_, _, k), e in zip(edges, _shares(edges, n, p), strict=True):
                    for m in k:
                        got[m] += c * e
                continue
            for (i, j, _), x in zip(reversed(edges), reversed(w), strict=True):
                b[i] += x * b[j]
            for (i, j, k), x in zip(edges, w, strict=True):
                e = c * a[i] * x * b[j] / a[n]
                for m in k:
                    got[m] += e
        total = sum(got)
        p = [x / total for x in got]
    return p


class Scorer:
    """Scores texts in all languages; remembers a bounded number of words."""

    def __init__(self, pieces: Pieces, model: dict[str, list[float]]):
        self.pieces, self.langs = pieces, sorted(model)
        self.tables = [model[lang] for lang in self.langs]
        #: Known piece prefixes, with the piece's number or -1.
        self.numbers = {p: pieces.ids.get(p, -1) for p in pieces.prefixes}
        self.room = max(1, CACHE_CELLS // max(1, len(model)))
        self._forget()

    def _forget(self) -> None:
        self.seen: dict[str, int] = {}
        self.scores = np.empty((self.room, len(self.langs)))
        self.spelled: dict[str, int] = {}  # characters that are no piece
        self.p = np.array(self.tables, np.float64).reshape(len(self.langs), self.pieces.size).T

    def _spell(self, char: str) -> int:
        """Number of the row that holds a character's byte pieces multiplied."""
        at = self.spelled.get(char)
        if at is None:
            ids = self.pieces.ids
            row = [_weight(t, tuple(ids[x] for x in (f"<0x{b:02X}>" for b in char.encode("utf-8", "surrogatepass")) if x in ids))
                   for t in self.tables]
            at = self.spelled[char] = len(self.p)
            self.p = np.vstack([self.p, row])
        return at

    def forward(self, words: list[str]) -> np.ndarray:
        """Log probability of each word in each language: the forward sums of
        all words at once, place by place."""
        size = max(map(len, words)) + 2
        places: list[list[int]] = [[] for _ in range(size)]
        numbers, spell = self.numbers, self._spell
        for w, word in enumerate(words):
            s = WORD_MARK + word
            n = len(s)
            for i in range(n):
                add = places[i].append
                j = i + 1
                k = numbers.get(s[i:j])
                if k is None or k < 0:
                    add((w * size + j) << 32 | spell(s[i:j]))
                while k is not None:
                    if k >= 0:
                        add((w * size + j) << 32 | k)
                    j += 1
                    if j > n:
                        break
                    k = numbers.get(s[i:j])
        a = np.zeros((len(words) * size, len(self.langs)))
        a[::size] = 1.0
        for i, found in enumerate(places):
            if found:
                x = np.array(found, np.int64)
                to = x >> 32  # each once, as a piece from here to there is one string
                a[to] += a[to // size * size + i] * self.p[x & 0xFFFFFFFF]
        end = a[np.arange(len(words)) * size + np.array([len(w) + 1 for w in words])]
        out = np.log(np.maximum(end, 1e-300))
        for w in np.flatnonzero((end < 1e-290).any(axis=1)):
            edges, n = self.pieces.edges(words[w])
            out[w] = [log_probability(edges, n, p) for p in self.tables]
        return out

    def _rows(self, found: list[str]) -> np.ndarray:
        """Scores of different words, from memory or computed."""
        new = [w for w in found if w not in self.seen]
        if len(self.seen) + len(new) > self.room:
            self._forget()
            new = found
        if len(new) > self.room:  # one text of very many words
            return np.concatenate([self._rows(found[i:i + self.room]) for i in range(0, len(found), self.room)])
        short = [w for w in new if len(w) <= LONG]
        for i in range(0, len(short), AT_ONCE):
            part = short[i:i + AT_ONCE]
            at = len(self.seen)
            self.scores[at:at + len(part)] = self.forward(part)
            self.seen.update(zip(part, range(at, at + len(part)), strict=True))
        for w in new:
            if len(w) > LONG:
                edges, n = self.pieces.edges(w)
                self.scores[len(self.seen)] = [log_probability(edges, n, p) for p in self.tables]
                self.seen[w] = len(self.seen)
        return self.scores[[self.seen[w] for w in found]]

    def predict(self, texts: list[str | None]) -> list[tuple[str, float]]:
        """(language, posterior) of each text."""
        if not self.langs:
            return [("und", 0.0)] * len(texts)
        index: dict[str, int] = {}
        which: list[int] = []
        times: list[int] = []
        sizes = []
        for t in texts:
            found = words(t)
            which += [index.setdefault(w, len(index)) for w in found]
            times += found.values()
            sizes.append(len(found))
        if not index:
            return [("und", 0.0)] * len(texts)
        rows = self._rows(list(index))[which] * np.array(times, np.float64)[:, None]
        doc = np.repeat(np.arange(len(texts)), sizes)
        sums = np.stack([np.bincount(doc, rows[:, k], len(texts)) for k in range(len(self.langs))], axis=1)
        best = sums.argmax(axis=1)
        score = 1.0 / np.exp(sums - sums.max(axis=1, keepdims=True)).sum(axis=1)
        return [(self.langs[b], float(x)) if n else ("und", 0.0) for b, x, n in zip(best, score, sizes, strict=True)]


def fold(doc_id: Column) -> Column:
    return F.crc32(doc_id.cast("string")) % 4


def training_rows(documents: DataFrame, sample_docs: int = SAMPLE_DOCS, held_out_fold: int = 2) -> DataFrame:
    """``lang`` and ``text`` of at most ``sample_docs`` different rows per
    language, none of the held-out fold. Repeated rows count once; rows of one
    doc_id are told apart by the hash of their text.

    They are the first by a hash of the row. Before they are ranked, which is
    one task per language, rows beyond a cut of that hash go: it is set from
    the language's count to leave about twice the sample, so that the task does
    not grow with the language."""
    from pyspark.sql import Window

    docs = pick(documents, doc_id="doc_id", text="text", lang="lang").filter(
        F.col("lang").isNotNull() & F.col("text").isNotNull() & (fold(F.col("doc_id")) != held_out_fold)).withColumn(
        "mark", F.xxhash64("text"))
    row = ["doc_id", "lang", "mark"]
    rows = stage(docs.select(row).distinct().withColumn("place", F.shiftrightunsigned(F.xxhash64("doc_id", "mark"), 33)), "langid-rows")
    counts = stage(rows.groupBy("lang").agg(F.count("*").alias("rows")), "langid-counts")
    near = rows.join(counts, "lang").filter(F.col("place") * F.col("rows") <= (2 * sample_docs + MARGIN_DOCS) * 2.0 ** 31)
    order = Window.partitionBy("lang").orderBy("place", "doc_id", "mark")
    chosen = stage(near.withColumn("n", F.row_number().over(order)).filter(F.col("n") <= sample_docs).select(row), "langid-sample")
    return docs.join(chosen, row, "left_semi").dropDuplicates(row).select("lang", "text")


def train(documents: DataFrame, vocabulary: str = VOCABULARY, sample_docs: int = SAMPLE_DOCS,
          held_out_fold: int = 2) -> dict[str, list[float]]:
    """Piece probabilities per language, fitted in one task per language on
    its bounded sample. Learns from no document of the held-out fold."""
    sample = training_rows(documents, sample_docs, held_out_fold)
    pieces = Pieces.load(vocabulary)

    def learn(pdf):
        import pandas as pd

        counts: Counter = Counter()
        for t in pdf["text"]:
            counts.update(words(t))
        return pd.DataFrame({"lang": [pdf["lang"].iloc[0]], "p": [fit(pieces, counts)]})

    rows = sample.groupBy("lang").applyInPandas(learn, "lang string, p array<double>").collect()
    return {r.lang: r.p for r in rows}


def identify(documents: DataFrame, vocabulary: str = VOCABULARY, sample_docs: int = SAMPLE_DOCS,
             held_out_fold: int = 2) -> DataFrame:
    """A row per document: ``doc_id``, ``held_out``, ``lang_pred``, ``score``."""
    spark = documents.sparkSession
    bound_batches(spark)
    sent = spark.sparkContext.broadcast((Pieces.load(vocabulary), train(documents, vocabulary, sample_docs, held_out_fold)))
    docs = pick(documents, doc_id="doc_id", text="text").select(
        "doc_id", F.coalesce(fold(F.col("doc_id")) == held_out_fold, F.lit(False)).alias("held_out"), "text")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        scorer = Scorer(*sent.value)
        for b in batches:
            found, part, size = [], [], 0
            for t in b.column(2):
                part.append(t.as_py())
                size += len(part[-1] or "")
                if size >= SLICE_CHARS:
                    found += scorer.predict(part)
                    part, size = [], 0
            found += scorer.predict(part)
            yield pa.RecordBatch.from_arrays(
                [b.column(0), b.column(1), pa.array([x for x, _ in found], pa.string()),
                 pa.array([x for _, x in found], pa.float64())], ["doc_id", "held_out", "lang_pred", "score"])

    return docs.mapInArrow(run, "doc_id long, held_out boolean, lang_pred string, score double")

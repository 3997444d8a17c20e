"""Toxicity of texts behind obfuscated spelling: a noisy channel, then a classifier.

Channel: a writer may replace letters by look-alikes, put separators or spaces
between letters and repeat letters. Each suspicious token becomes a lattice of
what its characters can stand for, and Viterbi search finds the reading that a
character trigram model of the corpus and the channel together make likeliest.
Tokens of letters only, without a letter three times in a row, are their own
reading; plain numbers have none. Where a token ends in signs that may be letters
or punctuation, it is read both ways. Runs of spaced letters and readings that
are longer than words are also cut into words by the same character model. The
scorer sees the restored words only, at their whole length.

Scorer: logistic regression (Spark ML) on the presence of character n-grams of
restored words: all that occur more often in toxic documents by a z score over
MIN_Z, and in at least MIN_TOXIC of them.
Labels are learnt from at most `max_labelled` documents (by hash of the id)
outside the held-out fifth; trigram counts are taken over all documents.
"""

from __future__ import annotations

import math
import re
from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass, field
from itertools import compress
from operator import and_

import numpy as np
import pyarrow as pa
from pyspark.ml.classification import LogisticRegression
from pyspark.ml.feature import CountVectorizerModel
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidemark.llm.common import documents, table
from tidemark.llm.registry import query
from tidemark.session import materialise

#: Letters of the character model; any other character is a word end (code 0). At most 64 symbols in all.
LETTERS = "abcdefghijklmnopqrstuvwxyzäöüßàâæçéèêëîïôœùûÿñóíáú"
SYMBOLS = 64
#: Look-alikes: what a character may stand for.
LOOKS = {"0": "o", "1": "il", "2": "z", "3": "e", "4": "a", "5": "s", "6": "bg", "7": "t", "8": "b", "9": "g",
         "@": "a", "$": "s", "!": "i", "|": "il", "+": "t", "(": "c", "<": "c", "€": "e", "£": "l", "¡": "i"}
SEPARATORS = set(".-_*~'`,:;/\\^=​‌‍­")
#: Log probabilities of the channel: look-alike, left-out separator, left-out repetition, letter behind a mask.
LOOK_COST, SEPARATOR_COST, REPEAT_COST, MASK_COST = -1.5, -0.5, -0.7, -3.0
SPACED = re.compile(r"(?<!\S)(?:[^\W_]|[@$!|+(<€£])(?:[ .\-_*][^\W_\s]|[ .\-_*][@$!|+(<€£]){2,}(?!\S)")
JOINTS = frozenset(".-_*")  # of spaced letters, besides the space
EDGE = re.compile(r"^[^\w@$!|+(<€£¡]+|[^\w]+$")
#: As EDGE, but look-alikes at the end stay.
OUTER_EDGE = re.compile(r"^[^\w@$!|+(<€£¡]+|[^\w@$!|+(<€£¡]+$")
NUMBER = re.compile(r"[-+(<>=~#]*[$€£]?[-+]?\d[\d.,:;/\-+()=*^'’]*[%°$€£]?[).,:;!?]*")
PLAIN = re.compile(r"[^\W\d_]+")
#: Signs that only end a word: no look-alikes.
ENDS = frozenset(".,;:?")
THRICE = re.compile(r"(.)\1\1")
#: Readings longer than this are no single words and are also cut into words.
LONGEST = 40
CACHE = 200_000
GRAM_SIZES = (3, 4, 5, 6)
MAX_LABELLED, MIN_TOXIC, MIN_Z = 20_000, 5, 3
FOLDS = 5


# --- character model -------------------------------------------------------------------------------------------------

def char_counts(docs: DataFrame) -> np.ndarray:
    """Trigram counts over the whole text of all documents, SYMBOLS in each direction."""
    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        codes = np.zeros(0x110000, dtype=np.int32)
        for i, c in enumerate(LETTERS):
            codes[[ord(c), ord(c.upper()) if len(c.upper()) == 1 else ord(c)]] = i + 1
        total = np.zeros(SYMBOLS**3, dtype=np.int64)
        for batch in batches:
            for text in batch.column(0):
                data = (text.as_py() or b"").decode(errors="replace").encode("utf-32-le", errors="replace")
                for at in range(0, max(len(data), 1), 1 << 22):
                    c = codes[np.frombuffer(data[max(0, at - 8):at + (1 << 22)], dtype=np.uint32)]
                    if at == 0:
                        c = np.concatenate([[0, 0], c])
                    if len(c) > 2:
                        total += np.bincount((c[:-2] * SYMBOLS + c[1:-1]) * SYMBOLS + c[2:], minlength=SYMBOLS**3)
        at = np.flatnonzero(total)
        yield pa.RecordBatch.from_arrays([pa.array(at, pa.int32()), pa.array(total[at], pa.int64())], names=["gram", "n"])

    counts = np.zeros(SYMBOLS**3)
    rows = docs.select(F.col("text").cast("binary").alias("text")).mapInArrow(count, "gram int, n long")
    for gram, n in rows.groupBy("gram").agg(F.sum("n").alias("n")).collect():  # at most SYMBOLS ** 3 rows
        counts[gram] = n
    return counts.reshape(SYMBOLS, SYMBOLS, SYMBOLS)


def char_model(counts: np.ndarray) -> np.ndarray:
    """Log probability of a symbol after two others, interpolated with shorter contexts."""
    one = (counts.sum(axis=(0, 1)) + 1) / (counts.sum() + SYMBOLS)
    two = (counts.sum(axis=0) + 4 * one) / (counts.sum(axis=0).sum(axis=1, keepdims=True) + 4)
    return np.log((counts + 4 * two) / (counts.sum(axis=2, keepdims=True) + 4)).astype(np.float32)


# --- noisy channel ---------------------------------------------------------------------------------------------------

@dataclass
class Reader:
    """Restores tokens; equal tokens are read once while the table of readings lasts."""

    model: np.ndarray
    readings: dict[str, list[str]] = field(default_factory=dict)

    def __post_init__(self):
        self.code = {c: i + 1 for i, c in enumerate(LETTERS)}

    def words(self, text: str | None) -> list[str]:
        """The restored words of a text, in lower case; those of equal tokens once."""
        if not text:
            return []
        if len(self.readings) > CACHE:
            self.readings.clear()
        text = text.lower()
        out: list[str] = []
        tokens = text.split()
        for spaced in SPACED.findall(text) if may_be_spaced(tokens) else ():
            for word in self.read(re.sub(r"[ .\-_*]", "", spaced)):
                out += dict.fromkeys([word, *self.segments(word)])
        for token in dict.fromkeys(tokens):
            found = self.readings.get(token)
            if found is None:
                # most tokens are a word, or a word and one sign that ends it, and need no further look
                word = token[:-1] if token[-1] in ENDS else token
                is_word = len(word) <= LONGEST and word.isalpha() and not THRICE.search(word)
                found = self.readings[token] = [word] if is_word else self.read(token)
            out += found
        return out

    def read(self, token: str) -> list[str]:
        """The readings of a token, and the words in those that are longer than a word."""
        out = self.readings_of(token)
        return out + [part for word in out if len(word) > LONGEST for part in self.segments(word)]

    def readings_of(self, token: str) -> list[str]:
        if token.isalpha() and not THRICE.search(token):
            return [token]
        core, outer = EDGE.sub("", token), OUTER_EDGE.sub("", token)
        if NUMBER.fullmatch(outer):
            return []
        if core.isalpha() and not THRICE.search(core):
            plain = [core]
        else:
            # the plain parts stay as well: "black/white" is two words
            plain = PLAIN.findall(core)
            self.add_reading(core, plain)
        if outer != core:
            self.add_reading(outer, plain)
        return plain

    def add_reading(self, core: str, found: list[str]) -> None:
        if any(c.isalpha() or c in LOOKS for c in core):
            best = self.viterbi(core)
            if best and best not in found:
                found.append(best)

    def segments(self, word: str) -> list[str]:
        """The likeliest cut of a run of letters into words."""
        model, codes = self.model, [self.code.get(c, 0) for c in word]
        # states: the letter before is the last of its word (True), or the word goes on
        score = {False: float(model[0, 0, codes[0]]) if codes else 0.0}
        cuts: list[dict[bool, bool]] = []
        for i in range(1, len(codes)):
            a, b, c = codes[i - 2] if i > 1 else 0, codes[i - 1], codes[i]
            following: dict[bool, float] = {}
            came: dict[bool, bool] = {}
            # `began` says that the word began with the letter before, so nothing but a word end precedes it
            for began, value in score.items():
                before = 0 if began else a
                on = value + float(model[before, b, c])
                new = value + float(model[before, b, 0]) + float(model[b, 0, c])
                for now, total in ((False, on), (True, new)):
                    if now not in following or following[now] < total:
                        following[now], came[now] = total, began
            score = following
            cuts.append(came)
        ended = {began: value + float(model[0 if began or len(codes) < 2 else codes[-2], codes[-1], 0])
                 for began, value in score.items()} if codes else {}
        out, end = [], len(word)
        state = max(ended, key=ended.get, default=False)
        for i in range(len(word) - 1, 0, -1):
            if state:
                out.append(word[i:end])
                end = i
            state = cuts[i - 1][state]
        return [word[:end], *reversed(out)] if word else []

    def options(self, token: str, i: int) -> list[tuple[str, float]]:
        """What character i can stand for ("" = nothing), with its cost."""
        c = token[i]
        out = []
        if c.isalpha():
            out.append((c, 0.0))
            if i and token[i - 1] == c:
                out.append(("", REPEAT_COST))
        else:
            out += [(letter, LOOK_COST) for letter in LOOKS.get(c, "")]
            if i and token[i - 1] == c:
                out.append(("", REPEAT_COST))
            if c in SEPARATORS or c not in LOOKS:
                out.append(("", SEPARATOR_COST))
            if c == "*":
                out += [(letter, MASK_COST) for letter in "aeiou"]
        return out

    def viterbi(self, token: str) -> str:
        """The likeliest reading: states are the last two letters."""
        model, code = self.model, self.code
        states: dict = {(0, 0): (0.0, None)}  # a text is its last letter and the text before it
        for i in range(len(token)):
            following: dict = {}
            for letter, cost in self.options(token, i):
                symbol = code.get(letter, 0)
                for (a, b), (score, text) in states.items():
                    key, value = ((a, b), score + cost) if not letter else (
                        (b, symbol), score + cost + float(model[a, b, symbol]))
                    if key not in following or following[key][0] < value:
                        following[key] = value, (text, letter) if letter else text
            states = following or states
        states = {key: (score, spelt(text)) for key, (score, text) in states.items()}
        # reading nothing is not free: compare per letter
        ended = ((score + float(model[a, b, 0])) / (len(text) + 1) for (a, b), (score, text) in states.items())
        return max(zip(ended, (text for _, text in states.values())), default=(0.0, ""))[1]


def may_be_spaced(tokens: list[str]) -> bool:
    """False if SPACED finds nothing in a text of these tokens: it needs "a-b" within one, or two neighbours like "a b"."""
    loose = [len(token) == 1 or token[1] in JOINTS for token in tokens]
    return any(map(and_, loose, loose[1:])) or any(len(token) > 2 for token in compress(tokens, loose))


def spelt(text: tuple | None) -> str:
    letters = []
    while text:
        text, letter = text
        letters.append(letter)
    return "".join(reversed(letters))


def grams(word: str) -> set[str]:
    """Character n-grams of a word with its ends marked."""
    marked = f"^{word}$"
    return {marked[i:i + n] for n in GRAM_SIZES for i in range(len(marked) - n + 1)}


# --- scorer ----------------------------------------------------------------------------------------------------------

@dataclass
class ToxicityModel:
    chars: np.ndarray
    weights: dict[str, float]
    bias: float

    def scorer(self):
        """A function from text to score: one pass of an automaton over the restored words finds all n-grams."""
        import ahocorasick

        reader, automaton = Reader(self.chars), ahocorasick.Automaton()
        for gram, weight in self.weights.items():
            # words stand between single spaces, which are their ends
            automaton.add_word(gram.replace("^", " ").replace("$", " "), (gram, weight))
        if self.weights:
            automaton.make_automaton()

        def score(text: str) -> float:
            words = " ".join(["", *dict.fromkeys(reader.words(text)), ""])
            hits = dict(found for _, found in automaton.iter(words)) if self.weights else {}
            z = self.bias + sum(hits[g] for g in sorted(hits))
            return 1 / (1 + math.exp(-max(-500.0, min(500.0, z))))

        return score

    def score(self, docs: DataFrame) -> DataFrame:
        """(doc_id, score, predicted) of every row; a NULL or empty text has the score of no evidence."""
        def each(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            score = self.scorer()
            for batch in batches:
                scores = [score((t.as_py() or b"").decode(errors="replace")) for t in batch.column(1)]
                yield pa.RecordBatch.from_arrays(
                    [batch.column(0), pa.array(scores, pa.float64()), pa.array([int(s >= 0.5) for s in scores], pa.int32())],
                    names=["doc_id", "score", "predicted"])

        rows = docs.select("doc_id", F.col("text").cast("binary").alias("text"))
        return rows.mapInArrow(each, f"doc_id {docs.schema['doc_id'].dataType.simpleString()}, score double, predicted int")

    def clean(self, docs: DataFrame) -> DataFrame:
        """The rows of `docs` that are not toxic, all columns as they are."""
        at = docs.columns.index("text")

        def each(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            score = self.scorer()
            for batch in batches:
                yield batch.filter(pa.array([score(t.as_py() or "") < 0.5 for t in batch.column(at)], pa.bool_()))

        return docs.mapInArrow(each, docs.schema)


def held_out(doc_id: str = "doc_id"):
    """One fifth of the documents, by the checksum of the id as text (a NULL id counts as empty)."""
    return F.crc32(F.coalesce(F.col(doc_id).cast("string"), F.lit(""))) % FOLDS == 0


def train(docs: DataFrame, labels: DataFrame, max_labelled: int = MAX_LABELLED) -> ToxicityModel:
    """Character model over all `docs`; scorer from (doc_id, toxic) rows outside the held-out fifth.

    At most `max_labelled` labelled documents are learnt from, those of the lowest
    hash of their id, which bounds the n-grams too. Rows without label or text are no examples. Without examples
    of both kinds the score is the share of toxic ones (0 without any).
    """
    chars = char_model(char_counts(docs))
    picked = (labels.select("doc_id", F.col("toxic").cast("int").alias("toxic")).filter("doc_id IS NOT NULL AND toxic IN (0, 1)")
              .filter(~held_out()).orderBy(F.xxhash64("doc_id"), "doc_id", "toxic").limit(max_labelled))
    picked = materialise(picked, "toxicity-labels")
    texts = docs.select(F.col("doc_id"), F.col("text").cast("binary").alias("text")).filter("text IS NOT NULL")

    def restore(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        reader = Reader(chars)
        for batch in batches:
            words = [sorted(set(reader.words(t.as_py().decode(errors="replace")))) for t in batch.column(1)]
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(words, pa.list_(pa.string()))], names=["toxic", "words"])

    examples = materialise(texts.join(picked, "doc_id").select("toxic", "text").mapInArrow(
        restore, "toxic int, words array<string>"), "toxicity-examples")
    sizes = dict(examples.groupBy("toxic").count().collect())
    if len(sizes) < 2:
        share = float(bool(sizes.get(1)))
        return ToxicityModel(chars, {}, 10.0 if share else -10.0)

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            tallies: Counter = Counter()
            for toxic, words in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()):
                tallies.update((g, toxic) for g in set().union(*map(grams, words)))
            yield pa.RecordBatch.from_arrays(
                [pa.array([g for g, _ in tallies], pa.string()), pa.array([t for _, t in tallies], pa.int32()),
                 pa.array(tallies.values(), pa.int64())], names=["gram", "toxic", "n"])

    n1, n0 = sizes[1], sizes[0]
    z = F.expr(f"(a / {n1} - b / {n0}) / sqrt((a + b + 1) / {n1 + n0} * (1 / {n1} + 1 / {n0}))")
    chosen = (examples.mapInArrow(count, "gram string, toxic int, n long").groupBy("gram")
              .agg(F.sum(F.expr("if(toxic = 1, n, 0)")).alias("a"), F.sum(F.expr("if(toxic = 0, n, 0)")).alias("b"))
              .filter(F.col("a") >= MIN_TOXIC).withColumn("z", z).filter(F.col("z") > MIN_Z).orderBy(F.desc("z"), "gram"))
    vocabulary = [r.gram for r in chosen.collect()]
    if not vocabulary:
        return ToxicityModel(chars, {}, math.log((n1 + 1) / (n0 + 1)))
    chosen_set = set(vocabulary)

    def keep(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            found = [sorted(chosen_set.intersection(set().union(*map(grams, words)))) for words in batch.column(1).to_pylist()]
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(found, pa.list_(pa.string()))], names=["label", "grams"])

    vectors = CountVectorizerModel.from_vocabulary(vocabulary, "grams", "features", minTF=1.0)
    vectors.setBinary(True)
    matrix = materialise(examples.mapInArrow(keep, "label int, grams array<string>"), "toxicity-matrix")
    fitted = LogisticRegression(maxIter=100, regParam=0.0001, standardization=False).fit(vectors.transform(matrix))
    return ToxicityModel(chars, dict(zip(vocabulary, map(float, fitted.coefficients.toArray()))), float(fitted.intercept))


def toxicity(docs: DataFrame, labels: DataFrame, **bounds: int) -> DataFrame:
    """(doc_id, held_out, score, predicted) of every row of `docs`. Only doc_id and text are used."""
    scored = train(docs, labels, **bounds).score(docs)
    return scored.select("doc_id", held_out().alias("held_out"), "score", "predicted")


@query("op7_toxicity")
def op7_toxicity(spark, sf_dir):
    return toxicity(documents(spark, sf_dir), table(spark, sf_dir, "labels"))

"""Spelling variants: words one inserted, deleted or replaced code point apart, by permuterm rotations.

Every word is ended by a terminator and stands in one list by all its rotations.
A rotation that starts behind a code point ends with it: "$abc" turned so that "b"
is last is "c$ab". Its prefix without the last code point ("c$a") is what remains
if "b" is edited. So the words that differ there by a replacement are those whose
rotations continue that prefix by one code point, and the word that lacks the code
point is the one with this very prefix as a rotation. Each rotation is dealt out
by its prefix and, as a whole, by itself; the tasks sort their part of the list
and scan it group by group. A group has at most one member for each code point of
the alphabet and one for none, whatever the size of the corpus, and it is not
expanded into pairs: each member gets its number of neighbours and the best one.

Two words that differ by a replacement share one group. Words that differ by an
insertion share one for each place of the run of equal code points it falls in;
only the first place of the run counts.

The words are numbered in code-point order, and entries carry the number instead
of the word. A prefix of more than `HEAD` code points is kept as these and a
127-bit digest of the whole, so a word takes space in proportion to its length.
"""

from __future__ import annotations

import string
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidemark.llm.common import Scratch, documents
from tidemark.llm.registry import query

#: Letters of words; values of the contract.
LETTERS = "A-Za-zÀ-ÿ"
TERMINATOR = "$"
WHOLE, EDITED, FIRST = 0, 1, 2  # an entry is a whole rotation, or one without its last code point (first of a run or not)
HEAD = 48
PRIME, BASE = 2**127 - 1, 0x5DEECE66D1B54A32D192ED03B  # of the digest
ENTRIES = 1 << 16  # of an Arrow batch


def counted_words(docs: DataFrame, min_length: int = 7, min_count: int = 2, every: int = 31) -> DataFrame:
    """(word, n): runs of letters in lower case (A-Z only), with how often they occur.

    Let h be the CRC-32 of "<doc_id>:<run>". Where `every` divides h, the run loses
    the code point at h modulo its length, which stands for a typing error. Words
    of under `min_length` code points or `min_count` occurrences are left out. A NULL
    id counts as an empty one, a NULL text has no words, a repeated row counts again.
    """
    # shorter runs cannot become words of that length
    runs = docs.select("doc_id", F.explode(F.regexp_extract_all("text", F.lit(f"[{LETTERS}]{{{min_length},}}"), F.lit(0))).alias("run"))
    runs = runs.select("doc_id", F.translate("run", string.ascii_uppercase, string.ascii_lowercase).alias("run"))
    h = F.crc32(F.concat(F.coalesce(F.col("doc_id").cast("string"), F.lit("")), F.lit(":"), F.col("run")).cast("binary"))
    runs = runs.select("run", h.alias("h"))
    at = (F.col("h") % F.length("run")).cast("int")
    word = F.when(F.col("h") % every == 0, F.concat(F.substring("run", F.lit(1), at), F.substring("run", at + 2, F.length("run")))
                  ).otherwise(F.col("run"))
    return (runs.select(word.alias("word")).filter(F.length("word") >= min_length)
            .groupBy("word").agg(F.count(F.lit(1)).alias("n")).filter(F.col("n") >= min_count))


def numbered(words: DataFrame) -> DataFrame:
    """(word_id, word, n), ids rising in code-point order; to be written before use."""
    return (words.repartitionByRange("word").sortWithinPartitions("word")
            .select(F.monotonically_increasing_id().alias("word_id"), "word", "n"))


def rotations(word: str) -> Iterator[tuple[str, str, int]]:
    """(head, tail, kind) of every entry of a word: its rotations, and those without their last code point."""
    size, round_ = len(word), (word + TERMINATOR) * 2
    if size < HEAD:
        for at in range(size + 1):
            yield round_[at:at + size + 1], "", WHOLE
        for at in range(size):
            yield round_[at + 1:at + 1 + size], "", EDITED if at and word[at - 1] == word[at] else FIRST
        return
    sums = [0]
    for c in round_:
        sums.append((sums[-1] * BASE + ord(c)) % PRIME)
    powers = {length: pow(BASE, length, PRIME) for length in (size, size + 1)}

    def entry(start: int, length: int) -> tuple[str, str]:
        if length <= HEAD:
            return round_[start:start + length], ""
        return round_[start:start + HEAD], f"{length}:{(sums[start + length] - sums[start] * powers[length]) % PRIME:x}"

    for at in range(size + 1):
        yield *entry(at, size + 1), WHOLE
    for at in range(size):
        yield *entry(at + 1, size), EDITED if at and word[at - 1] == word[at] else FIRST


def entries(words: DataFrame) -> DataFrame:
    """The list of rotations: (head, tail, kind, word_id, n)."""
    names = ["head", "tail", "kind", "word_id", "n"]

    def batch(heads, tails, kinds, ids, counts) -> pa.RecordBatch:
        return pa.RecordBatch.from_arrays([pa.array(heads, pa.string()), pa.array(tails, pa.string()), pa.array(kinds, pa.int8()),
                                           pa.array(ids, pa.int64()), pa.array(counts, pa.int64())], names=names)

    def turn(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        rows: tuple[list, ...] = ([], [], [], [], [])
        heads, tails, kinds, ids, counts = rows
        for part in batches:
            for word_id, word, n in zip(*(column.to_pylist() for column in part.columns)):
                for head, tail, kind in rotations(word):
                    heads.append(head)
                    tails.append(tail)
                    kinds.append(kind)
                    ids.append(word_id)
                    counts.append(n)
                    if len(heads) == ENTRIES:
                        yield batch(*rows)
                        for column in rows:
                            column.clear()
        yield batch(*rows)

    return words.select("word_id", "word", "n").mapInArrow(turn, "head string, tail string, kind byte, word_id long, n long")


def scan(group: list[tuple[int, int, int]]) -> Iterator[tuple[int, int, int, int]]:
    """(word_id, neighbours, n of the best, id of the best) from one group of (-n, word_id, kind)."""
    group.sort()
    edited = [m for m in group if m[2] != WHOLE]
    first = [m for m in edited if m[2] == FIRST]
    shorter = next((m for m in group if m[2] == WHOLE), None)
    if shorter and first:
        yield shorter[1], len(first), -first[0][0], first[0][1]
    for member in edited:
        # replacements, and the word that lacks the code point
        near = [edited[1] if member is edited[0] else edited[0]] if len(edited) > 1 else []
        joined = shorter is not None and member[2] == FIRST
        if joined:
            near.append(shorter)
        if near:
            best = min(near)
            yield member[1], len(edited) - 1 + joined, -best[0], best[1]


def neighbours(words: DataFrame) -> DataFrame:
    """(word_id, n_near, near_n, near_id) of the words that have near ones: their number, and the one of largest n (then smallest id)."""
    names = ["word_id", "n_near", "near_n", "near_id"]

    def groups(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        rest = None  # the last group of a batch may go on in the next
        for batch in batches:
            table = pa.Table.from_batches([batch] if rest is None else [rest, batch]).combine_chunks()
            if not table.num_rows:
                continue
            starts = borders(table)
            rest = table.slice(starts[-1]).combine_chunks().to_batches()[0]
            yield found(table, starts)
        if rest is not None:
            table = pa.Table.from_batches([rest])
            yield found(table, np.array([0, table.num_rows]))

    def borders(table: pa.Table) -> np.ndarray:
        same = np.ones(table.num_rows - 1, dtype=bool)
        for name in ("head", "tail"):
            column = table.column(name)
            same &= pc.equal(column.slice(1), column.slice(0, table.num_rows - 1)).to_numpy(zero_copy_only=False)
        return np.concatenate([[0], np.flatnonzero(~same) + 1])

    def found(table: pa.Table, starts: np.ndarray) -> pa.RecordBatch:
        kind, word_id, n = (table.column(c).to_numpy() for c in ("kind", "word_id", "n"))
        out = []
        for at in np.flatnonzero(np.diff(starts) > 1):
            part = slice(starts[at], starts[at + 1])
            out.extend(scan(list(zip((-n[part]).tolist(), word_id[part].tolist(), kind[part].tolist()))))
        columns = list(zip(*out)) or [[]] * len(names)
        return pa.RecordBatch.from_arrays([pa.array(c, pa.int64()) for c in columns], names=names)

    listed = entries(words).repartition("head", "tail").sortWithinPartitions("head", "tail")
    best = F.max(F.struct("near_n", (-F.col("near_id")).alias("id"))).alias("best")
    return (listed.mapInArrow(groups, "word_id long, n_near long, near_n long, near_id long")
            .groupBy("word_id").agg(F.sum("n_near").alias("n_near"), best)
            .select("word_id", "n_near", F.col("best.near_n").alias("near_n"), (-F.col("best.id")).alias("near_id")))


def variants(docs: DataFrame, min_length: int = 7, min_count: int = 2, every: int = 31, factor: int = 10) -> DataFrame:
    """(word, form, root, n, n_near, form_n) of the words of documents; see `counted_words`.

    `form` is the near word of largest n (ties: the first in code-point order), if
    that is at least `factor` times the word's own, else NULL; `root` follows forms
    to the last. A word without near words has n_near 0; an empty table gives no
    rows. Columns other than doc_id and text are left out.
    """
    scratch = Scratch(docs.sparkSession)
    words = scratch.save("words", numbered(counted_words(docs, min_length, min_count, every)))
    near = scratch.save("near", neighbours(words))
    listed = scratch.save("listed", words.join(near, "word_id", "left").select(
        "word_id", "word", "n", F.coalesce("n_near", F.lit(0).cast("long")).alias("n_near"),
        *(F.when(F.col("near_n") >= factor * F.col("n"), F.col(c)).alias(name) for c, name in (("near_n", "form_n"), ("near_id", "form_id")))))
    scratch.drop("near")
    # a form has `factor` times the n, so chains end; the way along them doubles in every round
    forms = listed.filter("form_id IS NOT NULL").select("word_id", F.col("form_id").alias("root_id"))
    roots, at = scratch.save("roots-0", forms), 0
    while True:
        on = roots.select(F.col("word_id").alias("root_id"), F.col("root_id").alias("next_id"))
        after = scratch.save(f"roots-{at + 1}", roots.join(on, "root_id", "left").select(
            "word_id", F.coalesce("next_id", "root_id").alias("root_id"), F.col("next_id").isNotNull().alias("moved")))
        scratch.drop(f"roots-{at}")
        roots, at = after, at + 1
        if roots.filter("moved").isEmpty():
            break
    names = words.select(F.col("word_id").alias("name_id"), F.col("word").alias("name"))
    named = (roots.join(names, F.col("root_id") == F.col("name_id")).select("word_id", F.col("name").alias("root"))
             .join(listed.select("word_id", "form_id").filter("form_id IS NOT NULL"), "word_id")
             .join(names, F.col("form_id") == F.col("name_id")).select("word_id", "root", F.col("name").alias("form")))
    out = scratch.save("variants", listed.join(named, "word_id", "left").select(
        "word", "form", F.coalesce("root", "word").alias("root"), "n", "n_near", "form_n"))
    scratch.drop("words", "listed", f"roots-{at}")
    return out


@query("op13_spelling_variants")
def op13_spelling_variants(spark, sf_dir):
    return variants(documents(spark, sf_dir))

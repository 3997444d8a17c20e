"""Quality rules: counts, and the divergence of a document's histograms from those of its language.

The character-class histogram and the histogram of common words of a document
are compared with language references by the Jensen-Shannon distance (base 2,
square root, 0 to 1). A short document differs from its language by chance, so
each limit falls with the square root of the number of words, and documents under
`min_words` words are not compared at all.

References come from the documents themselves: for each language the median share
of every character class, and its `n_common` most frequent words, over all
documents that pass the base rules. Documents of other languages (or of none) are
compared with a reference over all languages.
"""

from __future__ import annotations

import math
import re
from collections import Counter, defaultdict
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidemark.llm.common import documents
from tidemark.llm.registry import query
from tidemark.session import materialise

LANGUAGES = ("en", "de", "fr", "es")
EVERY = ""  # the reference over all languages
SYMBOLS = b"#*$%&|<>"
#: Character classes of UTF-8 bytes; a byte that continues a character is in none.
CLASSES = {
    "small": b"abcdefghijklmnopqrstuvwxyz", "capital": b"ABCDEFGHIJKLMNOPQRSTUVWXYZ", "digit": b"0123456789",
    "space": b" \t\n\x0b\x0c\r", "stop": b".,;:!?'\"-()", "symbol": SYMBOLS, "beyond": bytes(range(0xC0, 0x100)),
}
N_CLASSES = len(CLASSES) + 1  # and everything else
BINS = 1000  # shares are counted in thousandths
#: A limit is base + slope / sqrt(number of words).
CLASS_LIMIT, WORD_LIMIT = (0.12, 0.5), (0.24, 2.3)
MIN_WORDS, N_COMMON = 50, 100
#: Distinct words that a task holds for a language before it passes counts on, or forgets what it has looked up.
FLUSH, CACHE = 30_000, 50_000
EDGE = re.compile(r"^[\W_]+|[\W_]+$")
BASE = {"n_words": pa.int64(), "word_chars": pa.int64(), "n_symbols": pa.int64(), "n_dup_lines": pa.int64(),
        "n_repeat_words": pa.int64(), "base_failed": pa.bool_()}


def class_table() -> np.ndarray:
    of = np.full(256, N_CLASSES - 1)
    for i, members in enumerate(CLASSES.values()):
        of[list(members)] = i
    return of


def byte_counts(text: bytes) -> np.ndarray:
    return np.bincount(np.frombuffer(text, dtype=np.uint8), minlength=256)


def class_counts(counts: np.ndarray) -> np.ndarray:
    counts = counts.copy()
    counts[0x80:0xC0] = 0
    return np.bincount(class_table(), weights=counts, minlength=N_CLASSES)


def repeated_words(words: list[bytes]) -> int:
    """Words inside a window of three that is found again in the text."""
    windows = list(zip(words, words[1:], words[2:]))
    if len(set(windows)) == len(windows):
        return 0
    counts = Counter(windows)
    covered = past = 0
    for i, window in enumerate(windows):
        if counts[window] > 1:
            covered += i + 3 - max(past, i)
            past = i + 3
    return covered


def base_counts(text: bytes, words: list[bytes], counts: np.ndarray) -> dict:
    seen, repeated = set(), 0
    for line in text.split(b"\n"):
        if line in seen:
            repeated += 1
        elif line.strip():
            seen.add(line)
    space = counts[list(CLASSES["space"])].sum()
    n, again = len(words), repeated_words(words)
    return {"n_words": n, "word_chars": int(len(text) - counts[0x80:0xC0].sum() - space),
            "n_symbols": int(counts[list(SYMBOLS)].sum()), "n_dup_lines": repeated, "n_repeat_words": again,
            "base_failed": n < 50 or 100 * again > 50 * n}


def fails_base(words: list[bytes]) -> bool:
    """`base_failed` alone: the repeated words are counted only where they could be enough."""
    n = len(words)
    if n < 50:
        return True
    # a repeat makes two windows at most repeated ones, and so six words
    repeats = n - 2 - len(set(zip(words, words[1:], words[2:])))
    return 12 * repeats > n and 100 * repeated_words(words) > 50 * n


def plain(word: bytes) -> str:
    """Lower case without punctuation at the ends; nothing if no letter or digit is left."""
    return EDGE.sub("", word.decode(errors="replace").lower())


def distance(p: np.ndarray, q: np.ndarray) -> float:
    """Jensen-Shannon distance of two histograms; 1 if one of them is empty."""
    if not p.sum() or not q.sum():
        return 1.0
    p, q = p / p.sum(), q / q.sum()
    m = (p + q) / 2
    total = sum(float((a[a > 0] * np.log2(a[a > 0] / m[a > 0])).sum()) for a in (p, q))
    return math.sqrt(max(0.0, total / 2))


def references(docs: DataFrame, languages: tuple[str, ...] = LANGUAGES, n_common: int = N_COMMON) -> dict:
    """language → (class shares, {common word: position}, counts of the common words and of all others).

    Words are counted in the tasks first, and a language takes at most `n_common`
    words and `N_CLASSES` x `BINS` shares to the driver.
    """
    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        found: dict = defaultdict(Counter)

        def flush():
            rows: Counter = Counter()
            for (lang, kind), tally in found.items():
                for key, n in tally.items():
                    rows[lang, kind, key if kind else plain(key)] += n
            found.clear()
            columns = list(zip(*rows)) or [(), (), ()]
            kinds = pa.string(), pa.int32(), pa.string(), pa.int64()
            return pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip([*columns, list(rows.values())], kinds)],
                                              names=["lang", "kind", "key", "n"])

        for batch in batches:
            for lang, text in zip(batch.column(0).to_pylist(), batch.column(1)):
                text = text.as_py() or b""
                words = text.split()
                if fails_base(words):
                    continue
                lang = lang if lang in languages else EVERY
                classes = class_counts(byte_counts(text))
                for i, share in enumerate((BINS * classes / classes.sum()).astype(int).tolist()):
                    found[lang, 1 + i][str(share)] += 1
                found[lang, 0].update(words)
                if len(found[lang, 0]) > FLUSH:
                    yield flush()
        yield flush()

    schema = "lang string, kind int, key string, n long"
    counted = docs.select("lang", F.col("text").cast("binary").alias("text")).mapInArrow(count, schema)
    counted = materialise(counted.groupBy("lang", "kind", "key").agg(F.sum("n").alias("n")), "reference-counts")
    out: dict = {}
    for lang in dict.fromkeys((*languages, EVERY)):
        of_lang = counted.filter(F.lit(True) if lang == EVERY else F.col("lang") == lang).filter("kind = 0 AND key <> ''")
        of_lang = of_lang.groupBy("key").agg(F.sum("n").alias("n"))
        total = of_lang.agg(F.sum("n")).first()[0]
        if total is not None:
            # every task keeps its `n_common` most frequent words
            first = of_lang.orderBy(F.desc("n"), "key").limit(n_common).collect()
            out[lang] = [np.zeros(N_CLASSES), {r.key: i for i, r in enumerate(first)}, [*(r.n for r in first), total - sum(r.n for r in first)]]
    totals = counted.filter(F.col("lang") != EVERY).unionByName(
        counted.groupBy(F.lit(EVERY).alias("lang"), "kind", "key").agg(F.sum("n").alias("n")))
    shares = defaultdict(list)
    for lang, kind, key, n in totals.filter("kind > 0").collect():
        shares[lang, kind - 1].append((int(key), n))
    for (lang, i), tally in shares.items():
        if lang in out:
            half, below = sum(n for _, n in tally) / 2, 0
            for share, n in sorted(tally):
                below += n
                if below >= half:
                    out[lang][0][i] = share + 0.5
                    break
    return {lang: (classes, index, np.array(counts, float)) for lang, (classes, index, counts) in out.items()}


def limit(pair: tuple[float, float], n_words: int) -> float:
    return pair[0] + pair[1] / math.sqrt(max(1, n_words))


def quality(docs: DataFrame, languages: tuple[str, ...] = LANGUAGES, n_common: int = N_COMMON,
            class_limit: tuple[float, float] = CLASS_LIMIT, word_limit: tuple[float, float] = WORD_LIMIT,
            min_words: int = MIN_WORDS) -> DataFrame:
    """(doc_id, the base counts, base_failed, js_classes, js_words, kept) of every row.

    A NULL or empty text has no words and fails the base rules, as do fewer than 50
    words and texts of which more than half the words are in repeated windows of
    three. Below `min_words` words the distances are NULL and do not count. Without
    any document that passes the base rules there is no reference, and distances
    are NULL as well. Other columns than doc_id, text and lang are not used.
    """
    refs = references(docs, languages, n_common)

    def judge(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known: dict[str, dict[bytes, int]] = {lang: {} for lang in refs}
        for batch in batches:
            rows = []
            for lang, text in zip(batch.column(1).to_pylist(), batch.column(2)):
                text = text.as_py() or b""
                words, counts = text.split(), byte_counts(text)
                row = base_counts(text, words, counts)
                lang = lang if lang in languages and lang in refs else EVERY
                js = None, None
                if lang in refs and row["n_words"] >= min_words:
                    classes, index, common = refs[lang]
                    at, histogram = known[lang], np.zeros(len(common))
                    if len(at) > CACHE:
                        at.clear()
                    for word, n in Counter(words).items():
                        if (i := at.get(word)) is None:
                            # words without a letter or digit are in no histogram
                            i = at[word] = index.get(key, len(index)) if (key := plain(word)) else -1
                        if i >= 0:
                            histogram[i] += n
                    js = distance(class_counts(counts), classes), distance(histogram, common)
                kept = not row["base_failed"] and (js[0] is None or (
                    js[0] <= limit(class_limit, row["n_words"]) and js[1] <= limit(word_limit, row["n_words"])))
                rows.append((*row.values(), *js, kept))
            columns = list(zip(*rows)) or [()] * (len(BASE) + 3)
            kinds = [*BASE.values(), pa.float64(), pa.float64(), pa.bool_()]
            yield pa.RecordBatch.from_arrays([batch.column(0), *(pa.array(c, t) for c, t in zip(columns, kinds))],
                                             names=["doc_id", *BASE, "js_classes", "js_words", "kept"])

    rows = docs.select("doc_id", "lang", F.col("text").cast("binary").alias("text"))
    return rows.mapInArrow(judge, f"doc_id {docs.schema['doc_id'].dataType.simpleString()}, n_words long, word_chars long, "
                           "n_symbols long, n_dup_lines long, n_repeat_words long, base_failed boolean, "
                           "js_classes double, js_words double, kept boolean")


@query("op5_quality_rules")
def op5_quality_rules(spark, sf_dir):
    return quality(documents(spark, sf_dir))

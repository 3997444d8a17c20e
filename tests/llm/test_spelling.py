import random
import re
import zlib
from collections import Counter

import pytest
from helpers import documents, odd_texts

from tidemark.llm.common import Scratch
from tidemark.llm.spelling import HEAD, FIRST, WHOLE, counted_words, neighbours, numbered, rotations, variants

RUN = re.compile("[A-Za-zÀ-ÿ]+")


def words_of(rows, min_length=7, min_count=2, every=31):
    counts = Counter()
    for doc_id, text in rows:
        for run in RUN.findall(text or ""):
            run = "".join(c.lower() if "A" <= c <= "Z" else c for c in run)
            h = zlib.crc32(f"{'' if doc_id is None else doc_id}:{run}".encode())
            if h % every == 0:
                run = run[:h % len(run)] + run[h % len(run) + 1:]
            if len(run) >= min_length:
                counts[run] += 1
    return {w: n for w, n in counts.items() if n >= min_count}


def near(a, b):
    if len(a) == len(b):
        return sum(x != y for x, y in zip(a, b)) == 1
    a, b = sorted((a, b), key=len)
    return len(b) == len(a) + 1 and any(b[:i] + b[i + 1:] == a for i in range(len(b)))


def brute(words, factor=10):
    form, out = {}, []
    for w in words:
        partners = [x for x in words if near(w, x)]
        best = min(partners, key=lambda x: (-words[x], x), default=None)
        form[w] = best if best is not None and words[best] >= factor * words[w] else None
        out.append((w, len(partners)))
    rows = []
    for w, n_near in out:
        root = w
        while form[root] is not None:
            root = form[root]
        rows.append((w, form[w], root, words[w], n_near, words[form[w]] if form[w] else None))
    return sorted(rows, key=repr)


def noisy(rng, n_docs, copies=40):
    stems = ["".join(rng.choices("aabcdeéÀx", k=rng.randint(7, 11))) for _ in range(12)]
    out = []
    for _ in range(n_docs):
        text = []
        for _ in range(rng.randint(0, copies)):
            word = list(stems[min(rng.randrange(12), rng.randrange(12))])
            for _ in range(rng.choice([0, 0, 0, 1, 1, 2])):
                at = rng.randrange(len(word))
                edit = rng.randrange(3)
                word[at:at + (edit > 0)] = [] if edit == 1 else [rng.choice("aabcdeéÀx")]
            text.append("".join(word).upper() if rng.random() < 0.1 else "".join(word))
        out.append(rng.choice([" ", "-", "1", "\n", "漢"]).join(text))
    return out


@pytest.mark.parametrize("seed", range(3))
def test_variants_equal_brute_force(spark, rows, seed):
    rng = random.Random(seed)
    texts = noisy(rng, 150) + odd_texts() + ["Aaaaaaaa aaaaaaaa aaaaaaa aaaaaaa baaaaaaa baaaaaaa"] * 2
    docs = documents(spark, texts, clash=True).withColumnRenamed("words", "word").withColumnRenamed("at", "n")
    got = variants(docs)
    assert got.columns == ["word", "form", "root", "n", "n_near", "form_n"]
    expected = brute(words_of(enumerate(texts)))
    assert rows(got) == expected and len(expected) > 60


def test_words_with_deletions_and_null_ids(spark, rows):
    rng = random.Random(8)
    texts = ["".join(rng.choices("abcXYZé ", weights=[5] * 7 + [2], k=300)) for _ in range(60)]
    docs = spark.createDataFrame([(i if i % 3 else None, t) for i, t in enumerate(texts)], "doc_id long, text string")
    expected = words_of([(i if i % 3 else None, t) for i, t in enumerate(texts)], 3, 1, 2)
    assert rows(counted_words(docs, 3, 1, 2)) == sorted(expected.items(), key=repr)
    assert any(w not in "".join(texts).lower() for w in expected)  # some words exist only by deletion


def test_long_words_and_repeated_rows(spark, rows):
    rng = random.Random(2)
    base = "".join(rng.choices("ab", k=3 * HEAD))
    edits = [base, base[:100] + "x" + base[100:], base[:100] + "y" + base[100:], base[:-1], base[1:], base[:60] + "z" + base[61:], base[::-1],
             base[:HEAD - 1], base[:HEAD], base[:HEAD + 1], base[:HEAD - 2] + "q"]
    texts = [" ".join(edits * 2)] + [base] * 40 + ["giant" * 8_000] * 2
    assert rows(variants(documents(spark, texts))) == brute(words_of(enumerate(texts)))
    twice = documents(spark, ["spelling"]).union(documents(spark, ["spelling"]))
    assert rows(variants(twice, every=1 << 40)) == [("spelling", None, "spelling", 2, 0, None)]


def test_roots_at_the_end_of_chains(spark, rows):
    chain = {"abcdefgh": 2, "abcdefg": 30, "abcdefgx": 300, "abcdeffgx": 3_000, "abcdeffgxyz": 2}
    texts = [" ".join([w] * n) for w, n in chain.items()]
    found = rows(variants(documents(spark, texts), every=1 << 40))
    assert found == brute(words_of(enumerate(texts), every=1 << 40))
    assert ("abcdefgh", "abcdefgx", "abcdeffgx", 2, 2, 300) in found and ("abcdefg", "abcdefgx", "abcdeffgx", 30, 2, 300) in found


def test_entries_grow_with_length_and_groups_are_bounded(spark):
    for word in ("abcdefg", "a" * HEAD, "ab" * 4_000):
        listed = list(rotations(word))
        assert len(listed) == 2 * len(word) + 1 and len(set(listed)) > len(word) // 2
        assert sum(len(h) + len(t) for h, t, _ in listed) < 100 * len(listed)
        assert sum(kind == WHOLE for *_, kind in listed) == len(word) + 1
    assert sum(kind == FIRST for *_, kind in rotations("aabbbcdd")) == 4
    # every word is near every other: one group, and one row for each member
    letters = "abcdefghijklmnopqrstuvwxyzàáâ"
    words = Scratch(spark).save("words", numbered(spark.createDataFrame([(f"sam{c}word", 5) for c in letters], "word string, n long")))
    found = neighbours(words).collect()
    assert len(found) == len(letters) and {r.n_near for r in found} == {len(letters) - 1}


def test_nothing_to_compare(spark):
    assert variants(documents(spark, [])).collect() == []
    assert variants(documents(spark, [None, "", "short words only"])).collect() == []

import hashlib
import random
from collections import Counter

import numpy as np
import pytest
import xxhash
from helpers import DOCS, Union, documents, odd_texts, prose, words_of

from tidemark.llm import simhash
from tidemark.llm.common import Scratch, components
from tidemark.llm.lines import line_classes, links, lower_labels, rare_groups, without_repeated_lines
from tidemark.llm.passages import common, intervals, maximal_repeats, removal_digests, with_spans
from tidemark.llm.simhash import simhash_classes, traverse, without_near_duplicates


# --- union-find ------------------------------------------------------------------------------------------------------

@pytest.mark.parametrize("shape", ["chain", "star", "random", "none"])
def test_components(spark, shape):
    rng = random.Random(4)
    pairs = {"chain": [(i, i + 1) for i in range(300)], "star": [(0, i) for i in range(1, 400)],
             "random": [(rng.randrange(500), rng.randrange(500)) for _ in range(300)], "none": []}[shape]
    want = Union({i for p in pairs if p[0] != p[1] for i in p})
    for a, b in pairs:
        if a != b:
            want.join(a, b)
    got = {r.node: r.component for r in components(spark.createDataFrame(pairs, "a long, b long")).collect()}
    assert got == {i: want.find(i) for i in want.parent}


# --- fingerprints ----------------------------------------------------------------------------------------------------

def plain_print(text):
    words = words_of("".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text or ""))
    parts = [" ".join(words[i:i + 3]) for i in range(max(1, len(words) - 2))] if words else []
    hashes = [xxhash.xxh64_intdigest(p.encode(), 42) for p in parts]
    return sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hashes) > len(hashes))


@pytest.mark.parametrize("task_keys", [20, 32_768])
def test_simhash_classes_equal_brute_force(spark, task_keys):
    rng = random.Random(5)
    texts = odd_texts()
    for _ in range(40):
        words = prose(rng, rng.randint(100, 600)).split()
        for _ in range(rng.choice([1, 2, 5])):
            changed = list(words)
            changed[rng.randrange(len(words))] = rng.choice(["zzz", "qqq", changed[0].upper()])
            texts.append(" ".join(changed))
    prints = [plain_print(t) for t in texts]
    union = Union(range(len(texts)))
    for i, a in enumerate(prints):
        for j in range(i):
            if (a ^ prints[j]).bit_count() <= 3:
                union.join(i, j)
    assert 10 < sum(len(g) > 1 for g in union.groups().values())
    got = {r.doc_id: (r.fingerprint, r.component_id) for r in
           simhash_classes(documents(spark, texts, clash=True), task_keys=task_keys).collect()}
    assert got == {i: (f"{p:016x}", union.find(i)) for i, p in enumerate(prints)}


@pytest.mark.parametrize("bits", [8, 16, 64])
def test_traversal_connects_what_all_pairs_connect(bits):
    rng = np.random.default_rng(6)
    for _ in range(10):
        keys = rng.integers(0, 2**63, 200, dtype=np.int64).astype(np.uint64) << np.uint64(1)
        keys[100:] = keys[:100] ^ (np.uint64(1) << rng.integers(64 - bits, 64, 100).astype(np.uint64))
        keys = np.sort(keys & np.uint64(((1 << bits) - 1) << (64 - bits)))
        want, got = Union(range(200)), Union(range(200))
        for a, b in zip(*np.nonzero(np.bitwise_count(keys[:, None] ^ keys[None, :]) <= 3)):
            want.join(int(a), int(b))
        for a, b in traverse(keys, 0, 3, 0, bits):
            got.join(a, b)
        assert [want.find(i) for i in range(200)] == [got.find(i) for i in range(200)]


def test_simhash_of_an_empty_table_and_null_ids(spark):
    assert simhash_classes(documents(spark, [])).collect() == []
    df = spark.createDataFrame([(None, "a b c", "", "", 5), (3, "a b c", "", "", 5), (None, None, "", "", 0)], DOCS)
    assert sorted((str(r.doc_id), str(r.component_id)) for r in simhash_classes(df).collect()) == [
        ("3", "3"), ("None", "3"), ("None", "None")]


def test_near_duplicates_of_five_word_shingles(spark):
    rng = random.Random(7)
    base = [prose(rng, 200) for _ in range(30)]
    texts, group = [], []
    for i, text in enumerate(base):
        texts.append(text)
        group.append(i)
        for _ in range(i % 3):
            words = text.split()
            words[rng.randrange(len(words))] = "changed"
            texts.append(" ".join(words).upper() if i % 2 else " ".join(words))
            group.append(i)
    kept = without_near_duplicates(documents(spark, texts, clash=True))
    rows = kept.collect()
    assert sorted(group[r.doc_id] for r in rows) == list(range(30))
    assert all(r.doc_id == group.index(group[r.doc_id]) and r.text == texts[r.doc_id] for r in rows)
    assert kept.columns == documents(spark, [], clash=True).columns


def test_near_duplicates_are_those_of_exact_similarity(spark):
    # pairs on both sides of 0.8: the second copy of a text has its last words replaced
    rng = random.Random(21)
    texts, want = [], {}
    for i in range(120):
        words = [f"w{rng.randrange(10**6)}" for _ in range(204)]
        tail = rng.choice([18, 21, 24, 30, 36, 42])
        other = words[:204 - tail] + [f"v{rng.randrange(10**6)}" for _ in range(tail)]
        x, y = ({tuple(w[k:k + 5]) for k in range(200)} for w in (words, other))
        want[i] = len(x & y) / len(x | y) >= 0.8
        texts += [" ".join(words), " ".join(other)]
    kept = {r.doc_id for r in without_near_duplicates(documents(spark, texts)).collect()}
    assert 20 < sum(want.values()) < 100
    # documents below the threshold all stay; of those above, candidates may miss one
    assert all(2 * i + 1 in kept for i in want if not want[i]) and all(2 * i in kept for i in want)
    assert sum(2 * i + 1 not in kept for i in want if want[i]) >= 0.98 * sum(want.values())


def test_near_duplicates_of_odd_rows(spark):
    rows = [(1, "x y z", "", "", 5)] * 3 + [(None, None, "", "", None), (None, "", "", "", 0), (2, " ", "", "", 1), (5, "other text", "", "", 1)]
    kept = without_near_duplicates(spark.createDataFrame(rows, DOCS)).collect()
    assert sorted(str(r.text) for r in kept)[-2:] == ["other text", "x y z"] and len(kept) == 3
    assert without_near_duplicates(documents(spark, [])).collect() == []


# --- lines -----------------------------------------------------------------------------------------------------------

def plain_lines(texts):
    out = {}
    for i, text in enumerate(texts):
        for n, line in enumerate((text or "").split("\n")):
            if (line := line.strip(" \t\r\x0b\x0c").lower()):
                out[i, n] = line
    return out


def similar(a, b):
    x, y = ({s[i:i + 8] for i in range(max(1, len(s) - 7))} for s in (a, b))
    return len(x & y) / len(x | y)


@pytest.fixture(scope="module")
def line_texts():
    rng = random.Random(8)
    lines = [prose(rng, rng.randint(8, 40)) for _ in range(25)]
    texts = odd_texts()
    for _ in range(60):
        picked = []
        for _ in range(rng.randint(1, 4)):
            line = rng.choice(lines)
            if rng.random() < 0.5:
                at = rng.randrange(len(line))
                line = line[:at] + rng.choice(["#", "", "xy"]) + line[at + 1:]
            picked.append(line if rng.random() < 0.8 else " " + line.upper() + "\t")
        texts.append("\n".join(picked))
    return texts


def test_line_classes_connect_similar_lines(spark, line_texts):
    lines = plain_lines(line_texts)
    union = Union(lines)
    distinct = {}
    for place, line in lines.items():
        union.join(place, distinct.setdefault(line, place))
    texts, pairs = list(distinct), []
    for i, a in enumerate(texts):
        for b in texts[:i]:
            if similar(a, b) >= 0.8:
                pairs.append((distinct[a], distinct[b]))
                union.join(*pairs[-1])
    got = {(r.doc_id, r.line_no): r for r in line_classes(documents(spark, line_texts, clash=True)).collect()}
    assert set(got) == set(lines)
    first = {place: (r.first_doc_id, r.first_line_no) for place, r in got.items()}
    for place, r in got.items():
        assert r.kept == (first[place] == place)
        # links are verified, so classes are never joined wrongly
        assert union.find(first[place]) == union.find(place)
    # banding may miss a pair
    assert len(pairs) > 100 and sum(first[a] == first[b] for a, b in pairs) >= 0.98 * len(pairs)


def edited(rng, line):
    """`line` with a character appended, replaced at the end or replaced anywhere."""
    kind = rng.randrange(3)
    if kind == 0:
        return line + "!"
    at = len(line) - 1 if kind == 1 else rng.randrange(len(line))
    return line[:at] + "#" + line[at + 1:]


@pytest.mark.parametrize("kind,low,high,least", [("spaced", 10, 20, 1), ("spaced", 20, 40, 1), ("spaced", 40, 60, 1), ("spaced", 60, 80, 1),
                                                 ("unspaced", 12, 90, 1), ("unspaced", 100, 400, 0.98), ("spaced", 100, 200, 0.98)])
def test_recall_by_length_of_line(spark, kind, low, high, least):
    rng = random.Random(low + high)
    texts, pairs = [], []
    while len(pairs) < 150:
        line = prose(rng, 80)[:rng.randrange(low, high)].strip().lower()
        if kind == "unspaced":
            line = "".join(chr(0x4E00 + rng.randrange(3000)) for _ in line)
        other = edited(rng, line)
        if other != line and similar(line, other) >= 0.8:
            pairs.append((len(texts), len(texts) + 1))
            texts += [line, other]
    first = {r.doc_id: r.first_doc_id for r in line_classes(documents(spark, texts)).collect()}
    assert sum(first[a] == first[b] for a, b in pairs) >= least * len(pairs)


def test_short_lines_meet(spark):
    texts = ["hello beautiful world", "hello beautiful world!", "abcdefghijk", "abcdefghijkl"]
    assert [r.first_doc_id for r in line_classes(documents(spark, texts)).orderBy("doc_id").collect()] == [0, 0, 2, 2]


def test_hot_band_is_compared_to_the_end(spark):
    # a long shared start gives all lines common bands; only some pairs are similar, and not to the first line
    rng = random.Random(9)
    start = prose(rng, 60)
    tails = [prose(rng, 60) for _ in range(12)]
    texts = [f"{start} {t}" for t in tails] + [f"{start} {t} x" for t in tails]
    rows = {r.doc_id: r.first_doc_id for r in line_classes(documents(spark, texts)).collect()}
    assert rows == {i: i % 12 for i in range(24)}


def test_documents_without_repeated_lines(spark, line_texts):
    df = documents(spark, line_texts, clash=True)
    gone = {(r.doc_id, r.line_no) for r in line_classes(df).filter("NOT kept").collect()}
    out = without_repeated_lines(df)
    assert out.columns == df.columns
    got = {r.doc_id: r for r in out.collect()}
    for i, text in enumerate(line_texts):
        left = None if text is None else "\n".join(x for n, x in enumerate(text.split("\n")) if (i, n) not in gone)
        if left != text and not left.strip(" \n\t\r\x0b\x0c"):
            assert i not in got
        else:
            assert got[i].text == left and got[i].n_chars == (None if left is None else len(left))


def test_lines_of_empty_tables_and_repeated_rows(spark):
    assert line_classes(documents(spark, [])).collect() == []
    assert line_classes(documents(spark, [None, "", "\n"])).collect() == []
    df = spark.createDataFrame([(1, "one line", "", "", 8)] * 2 + [(None, "one line", "", "", 8)], DOCS)
    assert sorted((str(r.doc_id), r.kept) for r in line_classes(df).collect()) == [("1", False), ("1", False), ("None", True)]


# --- passages --------------------------------------------------------------------------------------------------------

def plain_removal(texts, length):
    data = [(t or "").encode() for t in texts]
    counts = Counter(d[i:i + length] for d in data for i in range(len(d) - length + 1))
    out = []
    for d in data:
        gone = np.zeros(len(d), bool)
        for i in range(len(d) - length + 1):
            if counts[d[i:i + length]] > 1:
                gone[i:i + length] = True
        runs = int(np.sum(gone & ~np.concatenate([[False], gone[:-1]])))
        out.append((len(d), int(gone.sum()), runs, hashlib.sha256(bytes(b for b, g in zip(d, gone) if not g)).hexdigest()))
    return out


@pytest.mark.parametrize("hot", [50_000, 1])
@pytest.mark.parametrize("gram", [3, 12])
def test_removed_bytes_equal_brute_force(spark, hot, gram):
    rng = random.Random(gram)
    passages = ["".join(rng.choices("abcdefgh ", k=rng.randint(10, 40))) for _ in range(5)]
    texts = odd_texts()[:9] + ["a" * 40, "ab" * 20, "é" * 30]
    for _ in range(60):
        text = "".join(rng.choice(passages) if rng.random() < 0.5 else "".join(rng.choices("abc", k=rng.randint(0, 15)))
                       for _ in range(rng.randint(0, 6)))
        texts += [text] * rng.choice([1, 1, 2])
    got = {r[0]: tuple(r)[1:] for r in removal_digests(documents(spark, texts, clash=True), length=12, gram=gram, hot=hot).collect()}
    assert [got[i] for i in range(len(texts))] == plain_removal(texts, 12)


def test_production_length_and_a_long_text(spark):
    rng = random.Random(10)
    passage = "".join(rng.choices("abcdefghij ", k=260))
    long_text = "".join(rng.choices("abcdefghij ", k=700_000))
    texts = [f"one {passage} end", f"two {passage[:210]}", long_text, long_text[600_000:600_300], passage[:199]]
    got = {r[0]: tuple(r)[1:] for r in removal_digests(documents(spark, texts)).collect()}
    assert [got[i] for i in range(len(texts))] == plain_removal(texts, 200)


def test_passages_of_an_empty_table_and_repeated_rows(spark):
    assert removal_digests(documents(spark, [])).collect() == []
    df = spark.createDataFrame([(1, "r" * 250, "", "", 250)] * 2 + [(None, "s" * 150, "", "", 150)], DOCS)
    assert sorted((r.n_bytes, r.n_removed) for r in removal_digests(df).collect()) == [(150, 0), (250, 250), (250, 250)]
    assert {len(r.spans or []) > 0 for r in with_spans(df).collect()} == {True, False}


def test_maximal_repeats_come_with_all_occurrences():
    text = [b"xxABCDEyy", b"zzABCDEyw", b"qqABCDEyy"]
    lead = 4  # the anchor is C
    found = set()
    for before, after, who in maximal_repeats([t[:lead][::-1] for t in text], [t[lead:] for t in text], 5):
        found.add((before, after, tuple(sorted(who))))
    # ABCDEy in all three; ABCDEyy in two of them, which differ to the left
    assert found == {(2, 4, (0, 1, 2)), (2, 5, (0, 2))}
    assert common(b"abc", b"abd") == 2 and common(b"", b"a") == 0 and common(b"ab", b"ab") == 2
    assert sorted(intervals([2, 1, 1], 4)) == [(1, 0, 4), (2, 0, 2)]


def test_passages_of_very_many_repeated_rows(spark):
    rng = random.Random(12)
    text, other = prose(rng, 300), prose(rng, 120)
    part = text[100:500]
    one = documents(spark, [text, f"{other}{part}", prose(rng, 100), "short"])
    repeated = one.filter("doc_id = 0").crossJoin(spark.range(20_000)).drop("id").unionByName(one).unionByName(one.filter("doc_id = 3"))
    found = {}
    for r in removal_digests(repeated).collect():
        found.setdefault(r.doc_id, Counter())[r.n_bytes, r.n_removed, r.n_spans] += 1
    assert found[0] == {(len(text), len(text), 1): 20_001}
    assert found[1] == {(len(other) + 400, 400, 1): 1}
    assert all(removed == 0 for _, removed, _ in found[2]) and found[3] == {(5, 0, 0): 2}


def template_lines(n):
    """Lines of one template with words of their own, 0.6 to 0.8 alike; every tenth has a near copy."""
    rng = random.Random(5)
    template = prose(rng, 24).split()
    texts = []
    for i in range(n):
        words = list(template)
        for at in rng.sample(range(24), 2):
            words[at] = "".join(rng.choices("abdeghilmnoprstu", k=7))
        texts.append(" ".join(words))
        if i % 10 == 0:
            texts.append(texts[-1] + ".")
    return texts


def test_pairs_of_a_template_grow_in_proportion(spark, monkeypatch):
    seen = []
    save = Scratch.save

    def counted(self, name, df):
        out = save(self, name, df)
        if name == "line-pairs":
            seen.append(out.count())
        return out

    monkeypatch.setattr(Scratch, "save", counted)
    totals = []
    for n in (1_000, 5_000):
        seen.clear()
        texts = template_lines(n)
        first = {r.doc_id: r.first_doc_id for r in line_classes(documents(spark, texts)).collect()}
        assert all(first[i] == first[i - 1] for i in range(1, len(texts)) if texts[i] == texts[i - 1] + ".")
        totals.append(sum(seen))
    assert totals[1] <= 10 * totals[0], totals


def test_template_components_equal_all_pairs(spark):
    texts = template_lines(150)
    union = Union(range(len(texts)))
    for a in range(len(texts)):
        for b in range(a):
            if similar(texts[a], texts[b]) >= 0.8:
                union.join(a, b)
    first = {r.doc_id: r.first_doc_id for r in line_classes(documents(spark, texts)).collect()}
    assert first == {i: union.find(i) for i in range(len(texts))}


def test_rounds_of_linking_add_few_tables(spark, monkeypatch):
    # plans stay in the driver's memory: a union-find in every round made 10 of these tables
    seen, save = [], Scratch.save
    monkeypatch.setattr(Scratch, "save", lambda self, name, df: seen.append(name) or save(self, name, df))
    texts = template_lines(60)
    lines = spark.createDataFrame([(i, t) for i, t in enumerate(texts)], "id long, line string")
    assert links(lines, 8, 16, 4, 0.8).count() >= 6
    assert sum(name.startswith("lines-") for name in seen) <= 5, seen


def test_small_bands_need_no_rare_shingles_and_lines_have_few_bands(spark, monkeypatch):
    # bands of all runs took over 60 rows a short line, and every unconnected band went through rounds of rare shingles
    seen, bands, save = [], [], Scratch.save

    def kept(self, name, df):
        seen.append(name)
        out = save(self, name, df)
        if name == "line-bands":
            bands.extend(len(r.bands) for r in out.select("bands").collect())
        return out

    monkeypatch.setattr(Scratch, "save", kept)
    texts = template_lines(12) + [text[:90] for text in template_lines(6)]
    union = Union(range(len(texts)))
    for a in range(len(texts)):
        for b in range(a):
            if similar(texts[a], texts[b]) >= 0.8:
                union.join(a, b)
    lines = spark.createDataFrame(list(enumerate(texts)), "id long, line string")
    linked = Union(range(len(texts)))
    for a, b in links(lines, 8, 16, 4, 0.8).collect():
        linked.join(a, b)
    assert [linked.find(i) for i in range(len(texts))] == [union.find(i) for i in range(len(texts))]
    assert len(set(map(union.find, range(len(texts))))) < len(texts)
    assert max(bands) <= 40 and not any(name.startswith("line-groups") for name in seen), (bands, seen)


def test_lower_labels_stay_within_a_component_and_join_stars(spark):
    rng = random.Random(3)
    pairs = [(rng.randrange(40), rng.randrange(40)) for _ in range(25)]
    stars = [(100 + 10 * s, 100 + 10 * s + rng.choice([-1, 1]) * i) for s in range(5) for i in range(1, 5)]
    union = Union(range(200))
    for pair in pairs + stars:
        union.join(*pair)
    moved = {r.component: r.moved for r in lower_labels(spark.createDataFrame(pairs + stars, "a long, b long")).collect()}
    assert set(moved) == {x for pair in pairs + stars for x in pair}
    assert all(union.find(x) == union.find(y) and y <= x for x, y in moved.items())
    assert all(moved[x] == union.find(x) for pair in stars for x in pair)


def test_shingles_of_one_component_make_no_groups(spark):
    sets = spark.createDataFrame([(0, [1, 2, 3, 4, 5], 5), (1, [1, 2, 3, 4, -6], 5), (2, [-6, 7, 8, 9, 10], 5), (3, [7, 8, 9, 10, -6, 11], 6)],
                                 "id long, shingles array<int>, n int")
    lines = spark.createDataFrame([(0, 0), (1, 0), (2, 2), (3, 3)], "id long, component long")
    scratch = Scratch(spark)
    found = [tuple(r) for r in rare_groups(scratch, lines, sets, 0.8).select("id", "shingle", "after").collect()]
    # line 1 shares one of its five shingles with other components, so it can be like none of them
    assert {i for i, _, _ in found} == {2, 3} and sorted(a for i, _, a in found if i == 2) == [3, 4]


@pytest.mark.parametrize("bits, budget", [(64, 3), (32, 4)])
def test_a_large_trie_keeps_the_copies_of_a_key_bounded(spark, monkeypatch, bits, budget):
    rng, upper = random.Random(5), 64 - bits
    near = lambda x: x ^ sum(1 << b for b in rng.sample(range(upper, 64), rng.randint(1, budget + 1)))
    some = [rng.getrandbits(bits) << upper for _ in range(300)]
    found = sorted({*some, *(near(x) for x in some for _ in range(2)), *(rng.getrandbits(bits) << upper for _ in range(1_500))})
    signed = [x - (1 << 64) if x >> 63 else x for x in found]
    keys = spark.createDataFrame([(7, x, i) for i, x in enumerate(signed)], "tree int, key long, node long")
    joined, union = [], simhash._union
    monkeypatch.setattr(simhash, "_union", lambda frames: joined.append(union(frames)) or joined[-1])
    links = simhash.trie_links(keys, budget, bits, task_keys=100).collect()
    assert joined[-1].count() <= (budget + 1) * len(found)
    parent = list(range(len(found)))

    def root(i):
        while parent[i] != i:
            i = parent[i]
        return i

    for a, b in links:
        assert (found[a] ^ found[b]).bit_count() <= budget
        parent[root(a)] = root(b)
    pairs = [(i, j) for i in range(len(found)) for j in range(i) if (found[i] ^ found[j]).bit_count() <= budget]
    assert len(pairs) > 200 and all(root(i) == root(j) for i, j in pairs)


@pytest.mark.parametrize("depth, cross, exact, budget, bits", [(0, False, 0, 4, 32), (2, True, 0, 4, 32), (1, False, 6, 4, 32), (6, False, 6, 3, 32),
                                                               (0, False, 0, 3, 64), (1, True, 0, 2, 12), (9, True, 0, 3, 9)])
@pytest.mark.parametrize("every", [False, True])
def test_traversal_finds_every_pair_within_the_budget(depth, cross, exact, budget, bits, every):
    rng = np.random.default_rng(11)
    n, low = 600, (1 << (bits - depth)) - 1
    keys = rng.integers(0, 2**63, n, dtype=np.int64).astype(np.uint64) << np.uint64(1)
    for at in range(1, 5):  # near ones, some over the budget
        keys[at * 120:(at + 1) * 120] = keys[:120] ^ np.bitwise_or.reduce(
            np.uint64(1) << rng.integers(64 - bits, 64, (at, 120)).astype(np.uint64), axis=0)
    keys &= np.uint64(low << (64 - bits))
    if cross:
        keys |= rng.integers(0, 2, n).astype(np.uint64) << np.uint64(64 - depth)
    full, labels = rng.integers(0, 2**63, (n, 2), dtype=np.int64).astype(np.uint64), rng.integers(0, 200, n)
    order = np.argsort(keys, kind="stable")
    keys, full, labels = keys[order], full[order], labels[order]
    split = int(np.searchsorted(keys >> np.uint64(64 - depth), np.uint64(1))) if cross else 0
    limit = 62
    differ = keys[:, None] ^ keys[None, :]
    near = (np.bitwise_count(differ) <= budget) & (np.bitwise_count(full[:, None] ^ full[None, :]).sum(axis=2) <= limit) & np.triu(np.ones((n, n), bool), 1)
    if cross:  # pairs inside one subtree are other tasks' work
        near &= (np.arange(n) < split)[:, None] & (np.arange(n) >= split)[None, :]
    asked = near & (differ >> np.uint64(64 - exact) == 0) if exact else near
    got = {tuple(sorted(map(int, pair))) for pair in traverse(keys, split, budget, depth, bits, full, limit, labels if every else None, every, exact)}
    assert got <= set(zip(*np.nonzero(near))) and asked.sum() > 30
    if every:
        assert got >= {(int(a), int(b)) for a, b in zip(*np.nonzero(asked)) if labels[a] != labels[b]}
    else:
        union, want = Union(range(n)), Union(range(n))
        for a, b in got:
            union.join(a, b)
        for a, b in zip(*np.nonzero(asked)):
            want.join(int(a), int(b))
        assert all(union.find(int(a)) == union.find(int(b)) for a, b in zip(*np.nonzero(asked)))


def test_few_keys_are_compared_that_are_not_near(monkeypatch):
    # one descent with the whole budget compared over 2,500 keys for each key here, and the more the more keys there are
    compared, compare = [], simhash.compare

    def counted(keys, alo, ahi, blo, bhi, *more):
        compared.append(int(((ahi - alo) * (bhi - blo)).sum()))
        return compare(keys, alo, ahi, blo, bhi, *more)

    monkeypatch.setattr(simhash, "compare", counted)
    rng = np.random.default_rng(12)
    n, bits = 16_000, 26
    keys = np.sort(rng.integers(0, 1 << bits, n, dtype=np.int64).astype(np.uint64) << np.uint64(64 - bits))
    links = traverse(keys, 0, 4, 0, bits)
    assert sum(compared) <= 500 * n, sum(compared) / n
    some = rng.integers(0, n, 200)
    parent = list(range(n))

    def root(i):
        while parent[i] != i:
            i = parent[i]
        return i

    for a, b in links:
        parent[root(int(a))] = root(int(b))
    for i in some.tolist():
        for j in np.flatnonzero(np.bitwise_count(keys ^ keys[i]) <= 4).tolist():
            assert root(i) == root(j)


def test_fingerprints_of_several_seeds_and_many_shingles():
    rng = random.Random(13)
    for n in (0, 1, 2, 254, 255, 256, 700):
        parts = [rng.randbytes(rng.randrange(40)) for _ in range(n)]
        want = []
        for seed in (42, 43, 7):
            hashes = [xxhash.xxh64_intdigest(p, seed) for p in parts]
            bits = sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hashes) > n)
            want.append(bits - (1 << 64) if bits >> 63 else bits)
        assert simhash.fingerprint(parts, (42, 43, 7)) == want

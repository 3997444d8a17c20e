import math
import random
import zlib
from collections import Counter

import numpy as np
import pytest
from helpers import DOCS, documents, odd_texts, prose, words_of

from tidemark.llm import quality as q
from tidemark.llm import secrets as sec
from tidemark.llm import toxicity as tox


# --- quality rules ---------------------------------------------------------------------------------------------------

def plain_base(text):
    words = words_of(text)
    windows = list(zip(words, words[1:], words[2:]))
    counts, covered = Counter(windows), set()
    for i, w in enumerate(windows):
        if counts[w] > 1:
            covered |= {i, i + 1, i + 2}
    seen, dup = set(), 0
    for line in (text or "").split("\n"):
        if words_of(line):
            dup += line in seen
            seen.add(line)
    n = len(words)
    return (n, sum(map(len, words)), sum(c in "#*$%&|<>" for c in text or ""), dup, len(covered),
            n < 50 or 100 * len(covered) > 50 * n)


@pytest.fixture(scope="module")
def mixed_texts():
    rng = random.Random(11)
    good = [prose(rng, rng.randint(60, 400)) for _ in range(120)]
    noise = [" ".join(w + rng.choice(["###", "$$$", "%%%"]) for w in prose(rng, 150).split()) for _ in range(8)]
    shout = [" ".join(w.upper() + "!!" for w in prose(rng, 150).split()) for _ in range(8)]
    lists = [" | ".join("".join(rng.choices("abdeghilmnoprstu", k=9)) for _ in range(150)) for _ in range(8)]
    again = ["\n".join([prose(rng, 12)] * 20) for _ in range(4)]
    return {"good": good, "bad": noise + shout + lists + again, "odd": odd_texts()}


def test_base_counts_and_verdicts(spark, mixed_texts):
    texts = mixed_texts["good"] + mixed_texts["bad"] + mixed_texts["odd"]
    rows = [(i, t, "en", "s", 0) for i, t in enumerate(texts)]
    df = spark.createDataFrame(rows, DOCS).selectExpr("*", "'x' AS kept", "'x' AS n_words", "'x' AS key").repartition(3)
    got = {r.doc_id: r for r in q.quality(df).collect()}
    assert len(got) == len(texts)
    for i, text in enumerate(texts):
        r = got[i]
        assert (r.n_words, r.word_chars, r.n_symbols, r.n_dup_lines, r.n_repeat_words, r.base_failed) == plain_base(text), repr(text)[:80]
        assert not (r.base_failed and r.kept)
    n = len(mixed_texts["good"])
    assert all(got[i].kept for i in range(n))
    assert not any(got[i].kept for i in range(n, n + len(mixed_texts["bad"])))


def test_references_equal_plain_counts(spark, mixed_texts):
    texts = mixed_texts["good"]
    df = spark.createDataFrame([(i, t, ("en", "de", "xx")[i % 3], "s", 0) for i, t in enumerate(texts)], DOCS).repartition(4)
    refs = q.references(df)
    for lang, pick in (("en", [0]), ("de", [1]), (q.EVERY, [0, 1, 2])):
        words = Counter(q.plain(w.encode()) for i, t in enumerate(texts) if i % 3 in pick for w in words_of(t))
        del words[""]
        top = sorted(words.items(), key=lambda x: (-x[1], x[0]))[:q.N_COMMON]
        classes, index, counts = refs[lang]
        assert [w for w, _ in sorted(index.items(), key=lambda x: x[1])] == [w for w, _ in top]
        assert counts.tolist() == [n for _, n in top] + [sum(words.values()) - sum(n for _, n in top)]


def test_distance():
    assert q.distance(np.array([1.0, 0]), np.array([0, 1.0])) == 1.0
    assert q.distance(np.array([2.0, 2]), np.array([1.0, 1])) == 0.0
    p, r = np.array([0.5, 0.5]), np.array([0.9, 0.1])
    m = (p + r) / 2
    want = math.sqrt(sum(a * math.log2(a / b) for x in (p, r) for a, b in zip(x, m)) / 2)
    assert abs(q.distance(p, r) - want) < 1e-12 and q.distance(np.zeros(2), p) == 1.0


def test_quality_of_empty_tables(spark):
    assert q.quality(documents(spark, [])).collect() == []
    rows = q.quality(documents(spark, [None, prose(random.Random(1), 60)])).collect()
    assert {r.doc_id: r.kept for r in rows} == {0: False, 1: True}


# --- secrets ---------------------------------------------------------------------------------------------------------

@pytest.fixture(scope="module")
def secret_texts():
    rng = random.Random(12)
    texts, planted = [], {}
    for i in range(120):
        words = prose(rng, 80).split()
        kind = i % 6
        value = {0: "AKIA" + "".join(rng.choices("ABCDEFGHIJKLMNOPQRSTUVWXYZ234567", k=16)),
                 1: "".join(rng.choices("0123456789abcdef", k=40)), 2: "".join(rng.choices("0123456789abcdef", k=18)),
                 3: "".join(rng.choices("0123456789", k=16)), 4: "".join(rng.choice(WORDS4) for _ in range(6)), 5: ""}[kind]
        shown = {1: f'token = "{value}"', 2: f"password={value}"}.get(kind, value)
        words.insert(rng.randrange(len(words)), shown)
        texts.append(" ".join(w for w in words if w))
        if kind < 3:
            planted[i] = value
    return texts, planted


WORDS4 = ["that", "with", "from", "this", "have", "said", "each", "which", "their", "time"]


def test_secrets_are_found_where_they_are(spark, secret_texts):
    texts, planted = secret_texts
    odd = odd_texts()
    df = documents(spark, texts + odd, clash=True)
    rows = sec.scan(df).collect()
    found = {}
    for r in rows:
        text = (texts + odd)[r.doc_id]
        value = text[r.start:r.start + r.length]
        import hashlib
        assert hashlib.sha256(value.encode()).hexdigest() == r.sha256
        assert 0 <= r.score <= 1 and r.is_secret == (r.score >= 0.5)
        if r.is_secret:
            found[r.doc_id] = value
    assert found == planted
    assert len(rows) > len(planted)  # digits and joined words are candidates as well


def test_redaction(spark, secret_texts):
    texts, planted = secret_texts
    df = documents(spark, texts + odd_texts(), clash=True)
    out = sec.redact(df)
    assert out.columns == df.columns
    got = {r.doc_id: r for r in out.collect()}
    for i, text in enumerate(texts + odd_texts()):
        want = text.replace(planted[i], sec.REDACTED) if i in planted else text
        assert got[i].text == want and got[i].n_chars == (None if want is None else len(want))


def test_forest_learns_from_given_findings(spark, secret_texts):
    texts, _ = secret_texts
    rng = random.Random(13)
    findings = [("".join(rng.choices("0123456789", k=16)), "card ", " paid", "src", 1) for _ in range(40)]
    findings += [("".join(rng.choices("0123456789abcdef", k=40)), "commit ", " merged", "src", 0) for _ in range(40)]
    labelled = spark.createDataFrame(findings, "value string, before string, after string, path string, label int")
    rows = sec.scan(documents(spark, texts), labelled).collect()
    verdicts = {r.doc_id % 6: r.is_secret for r in rows if r.length in (16, 40)}
    assert verdicts[3] and not verdicts[1]


def test_a_hot_finding_does_not_fill_the_sample(spark, secret_texts):
    texts, _ = secret_texts
    rng = random.Random(19)
    findings = [("".join(rng.choices("0123456789", k=16)), "card ", " paid", "src", 1) for _ in range(10)]
    findings += [("".join(rng.choices("0123456789abcdef", k=40)), "commit ", " merged", "src", 0) for _ in range(10)]
    schema = "value string, before string, after string, path string, label int"
    lowest = spark.createDataFrame(findings, schema).selectExpr("*", "xxhash64(value, before, after) AS h").orderBy("h").first()
    hot = [tuple(lowest)[:5]] * 40
    rows = sec.scan(documents(spark, texts), spark.createDataFrame(findings + hot, schema), max_findings=20).collect()
    verdicts = {r.doc_id % 6: r.is_secret for r in rows if r.length in (16, 40)}
    assert verdicts[3] and not verdicts[1]


def labelled_texts():
    """Texts with one value each that the corpus rule cannot judge, and whether it is a secret."""
    rng = random.Random(29)
    texts, labels = [], []

    def key(alphabet, size):
        return "".join(rng.choices(alphabet, k=size))

    hexes, base = "0123456789abcdef", "ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789"
    for i in range(30):
        u = key(hexes, 32)
        day = f"20{rng.randrange(10, 30)}-{rng.randrange(1, 13):02}-{rng.randrange(1, 29):02}"
        kinds = [
            (f"request {u[:8]}-{u[8:12]}-{u[12:16]}-{u[16:20]}-{u[20:]} was", 0),
            (f"id={u[:8]}-{u[8:12]}-{u[12:16]}-{u[16:20]}-{u[20:]} was", 0),
            (f"in /var/lib/data/{key('abcdefghij', 8)}/{day}/part-{i:04} there", 0),
            (f"path=/srv/{rng.choice(WORDS4)}/{rng.choice(WORDS4)}-{rng.choice(WORDS4)}/v{i}/index then", 0),
            (f"sha256 {key(hexes, 64)} matches", 0), (f"checksum: {key(hexes, 32)} matches", 0),
            (f"version release-{i}-{rng.randrange(20)}-3-build-{day.replace('-', '')} came", 0),
            (f"with {rng.choice(WORDS4)}_{rng.choice(WORDS4)}_{rng.choice(WORDS4)}_{rng.randrange(10, 99)} here", 0),
            (f"use {key(base, 32)} for it", 1), (f"x = {key(base, 40)} for it", 1), (f'secret: "{key(base, 24)}" end', 1),
            (f"password={key(base + '!@#', 14)} end", 1), (f"api_key = {key(hexes, 32)} end", 1)]
        for shown, label in kinds:
            texts.append(f"{prose(rng, 30)} {shown} {prose(rng, 30)}")
            labels.append(label)
    return texts, labels


def test_forest_judges_values_and_not_only_names(spark, secret_texts):
    texts, labels = labelled_texts()
    corpus = secret_texts[0]
    rows = sec.scan(documents(spark, corpus + texts)).collect()
    verdict = {i: False for i in range(len(texts))}
    for r in rows:
        if r.doc_id >= len(corpus):
            verdict[r.doc_id - len(corpus)] |= r.is_secret
    kinds = {}
    for i, label in enumerate(labels):
        kinds.setdefault((i % 13, label), []).append(verdict[i])
    shares = {k: sum(v) / len(v) for k, v in kinds.items()}
    right = sum(verdict[i] and label for i, label in enumerate(labels))
    precision, recall = right / sum(verdict.values()), right / sum(labels)
    print(f"precision {precision:.3f}, recall {recall:.3f}", shares)
    assert precision >= 0.95 and recall >= 0.95, shares
    assert shares[8, 1] >= 0.9, "bare keys, which no rule names"


def test_repeated_rows_of_findings(spark):
    rows = sec.scan(documents(spark, ["password=a1b2c3d4e5f6a7b8c9"]).union(documents(spark, ["password=a1b2c3d4e5f6a7b8c9"]))).collect()
    assert len(rows) == 2 and rows[0] == rows[1] and rows[0].is_secret


def test_secrets_of_empty_tables(spark):
    assert sec.scan(documents(spark, [])).collect() == []
    assert sec.redact(documents(spark, [None, ""])).count() == 2
    one = sec.scan(documents(spark, ["password=a1b2c3d4e5f6a7b8c9"])).collect()
    assert [(r.start, r.length, r.is_secret) for r in one] == [(9, 18, True)]


# --- toxicity --------------------------------------------------------------------------------------------------------

BAD = ["idiot", "moron", "pathetic", "worthless", "disgusting"]


def disguised(rng, word):
    kind = rng.randrange(5)
    if kind == 0:
        return "".join({"i": "1", "o": "0", "e": "3", "a": "@", "s": "$", "t": "7"}.get(c, c) if rng.random() < 0.7 else c for c in word)
    if kind == 1:
        return rng.choice([" ", ".", "-"]).join(word)
    if kind == 2:
        at = rng.randrange(1, len(word))
        return word[:at] + word[at - 1] * 4 + word[at:]
    return word.upper() + "!" if kind == 3 else word


@pytest.fixture(scope="module")
def toxic_texts():
    rng = random.Random(14)
    texts, labels = [], []
    for i in range(600):
        words = prose(rng, 60).split()
        toxic = i % 3 == 0
        if toxic:
            plain = i < 450  # the last ones are all disguised, and most of them held back from training below
            for _ in range(2):
                word = rng.choice(BAD)
                words.insert(rng.randrange(len(words)), word if plain else disguised(rng, word))
        texts.append(" ".join(words))
        labels.append(int(toxic))
    return texts, labels


def test_disguised_words_are_found_and_clean_texts_left_alone(spark, toxic_texts):
    texts, toxic = toxic_texts
    odd = odd_texts()
    df = documents(spark, texts + odd, clash=True)
    labels = spark.createDataFrame([(i, 1, t) for i, t in enumerate(toxic) if i < 450] + [(None, 1, 1), (5, 1, None)],
                                   "doc_id long, quality int, toxic int")
    rows = {r.doc_id: r for r in tox.toxicity(df, labels).collect()}
    assert len(rows) == len(texts) + len(odd)
    for i, r in rows.items():
        assert r.held_out == (zlib.crc32(str(i).encode()) % 5 == 0) and 0 <= r.score <= 1 and r.predicted == (r.score >= 0.5)
    unseen = [i for i in range(len(texts)) if i >= 450 or rows[i].held_out]
    right = sum(rows[i].predicted == toxic[i] for i in unseen)
    assert right >= 0.95 * len(unseen)
    assert not any(rows[i].predicted for i in range(len(texts), len(rows)))
    kept = tox.train(df, labels).clean(df)
    assert kept.columns == df.columns
    assert {r.doc_id for r in kept.collect()} == {i for i, r in rows.items() if not r.predicted}


def test_every_telling_ngram_has_a_weight(spark):
    rng = random.Random(18)
    vocabulary = ["".join(rng.choices("abcdefghijklmnopqrstuvwxyz", k=9)) for _ in range(100)]
    # a toxic document has one word of 100, each in 25 of them
    texts = [prose(rng, 15) + (f" {vocabulary[i // 2 % 100]}" if i % 2 else "") for i in range(5000)]
    labels = spark.createDataFrame([(i, i % 2) for i in range(5000)], "doc_id long, toxic int")
    model = tox.train(documents(spark, texts), labels)
    assert all(f"^{w[:5]}" in model.weights and w[2:8] in model.weights for w in vocabulary)
    score = model.scorer()
    assert all(score(f"{prose(rng, 15)} {w}") >= 0.5 for w in vocabulary)


def test_held_out_labels_do_not_matter(spark, toxic_texts):
    texts, toxic = toxic_texts
    df = documents(spark, texts[:200])
    def scores(flip):
        rows = [(i, 1, 1 - t if flip and zlib.crc32(str(i).encode()) % 5 == 0 else t) for i, t in enumerate(toxic[:200])]
        labels = spark.createDataFrame(rows, "doc_id long, quality int, toxic int").coalesce(1)
        return {r.doc_id: round(r.score, 6) for r in tox.toxicity(df, labels).collect()}
    assert scores(False) == scores(True)


def test_readings(spark):
    rng = random.Random(15)
    corpus = [prose(rng, 200) + " " + " ".join(rng.choices(BAD, k=10)) for _ in range(30)]
    reader = tox.Reader(tox.char_model(tox.char_counts(documents(spark, corpus))))
    for token, word in {"1d10t": "idiot", "p@thet1c": "pathetic", "m-o-r-o-n": "moron", "w o r t h l e s s": "worthless",
                        "disguuuusting": "disgusting", "IDIOT!!": "idiot"}.items():
        assert word in reader.words(token), token
    assert reader.words("the water.") == ["the", "water"] and reader.words(None) == [] and reader.words("4.0 (207)") == []


def test_readings_of_long_and_masked_tokens(spark):
    rng = random.Random(17)
    corpus = [prose(rng, 200) + " " + " ".join(rng.choices([*BAD, "dumbass"], k=10)) for _ in range(30)]
    reader = tox.Reader(tox.char_model(tox.char_counts(documents(spark, corpus))))
    for token, word in {"1d107": "idiot", "i...d...i...o...t": "idiot", "dumba$$": "dumbass", "1d10t5": "idiots",
                        "water!": "water", "idiot$$$": "idiot"}.items():
        assert word in reader.words(token), token
    letters = "these people are all water idiots".replace(" ", "") * 2
    assert any("idiot" in w for w in reader.words(" ".join(letters))) and "idiots" in "".join(reader.words(letters[30:] + "-" + letters))
    long = "water" * 12 + "1d10t"
    assert any("idiot" in w for w in reader.words(long))
    assert any("idiot" in w for w in reader.words("漢字" * 30 + "idiot"))
    assert reader.words("$1,200.50 10:30 (207) +1-555-0100 50% <3 €20") == []
    cut = reader.segments("waterpathetic")
    assert "".join(cut) == "waterpathetic" and cut == ["water", "pathetic"]


def test_toxic_end_of_a_long_word_is_scored():
    chars = tox.char_model(np.zeros((tox.SYMBOLS,) * 3))
    score = tox.ToxicityModel(chars, {"idiot": 5.0}, -2.0).scorer()
    assert score("x " + " ".join("thesepeoplearenotmyfriendstheyaresuchidiots")) > 0.5
    assert score("wateriswetandthepeoplewalkaroundinthemidiot") > 0.5 > score("water is wet")


def test_viterbi_is_the_best_of_all_readings(spark):
    rng = random.Random(16)
    reader = tox.Reader(tox.char_model(tox.char_counts(documents(spark, [prose(rng, 300)]))))

    def readings(token, i=0, a=0, b=0, score=0.0, text=""):
        if i == len(token):
            yield (score + float(reader.model[a, b, 0])) / (len(text) + 1), text
            return
        for letter, cost in reader.options(token, i):
            symbol = reader.code.get(letter, 0)
            step = float(reader.model[a, b, symbol]) if letter else 0.0
            yield from readings(token, i + 1, *((b, symbol) if letter else (a, b)), score + cost + step, text + letter)

    for _ in range(60):
        token = "".join(rng.choices("01abeost.-$|1", k=rng.randint(1, 7)))
        best = {}
        for score, text in readings(token):
            best[text] = max(score, best.get(text, -1e9))
        # states end with the last two letters, so among readings of one length the search is exact
        got = reader.viterbi(token)
        assert best[got] >= max((s for t, s in best.items() if len(t) == len(got) and t[-2:] == got[-2:]), default=-1e9) - 1e-4


def test_character_counts_equal_plain_counts(spark):
    texts = odd_texts() + ["Äb c", "ß"]
    counts = tox.char_counts(documents(spark, texts))
    want = Counter()
    code = {c: i + 1 for i, c in enumerate(tox.LETTERS)} | {c.upper(): i + 1 for i, c in enumerate(tox.LETTERS) if len(c.upper()) == 1}
    for t in texts:
        line = [0, 0] + [code.get(c, 0) for c in t or ""]
        want.update(zip(line, line[1:], line[2:]))
    assert {tuple(map(int, k)): int(counts[tuple(k)]) for k in np.argwhere(counts)} == dict(want)


def test_texts_without_spaced_letters_are_not_searched_for_them():
    rng, passed = random.Random(6), 0
    for _ in range(20_000):
        text = "".join(rng.choices("abé.-_* \n\t@!1,\x1c", k=rng.randint(0, 14)))
        may = tox.may_be_spaced(text.split())
        assert may or not tox.SPACED.findall(text), repr(text)
        passed += not may
    assert passed > 4_000


def test_plain_words_are_read_without_the_channel(monkeypatch):
    seen, reader = [], tox.Reader(np.zeros((64, 64, 64), np.float32))
    monkeypatch.setattr(tox.Reader, "read", lambda self, token: seen.append(token) or [])
    assert reader.words("Plain words, read; at once. Word") == ["plain", "words", "read", "at", "once", "word"]
    assert seen == [] and reader.words("id1ot soooo no! " + "x" * 50) == [] and len(seen) == 4


def test_toxicity_without_examples(spark):
    none = spark.createDataFrame([], "doc_id long, quality int, toxic int")
    assert tox.toxicity(documents(spark, []), none).collect() == []
    assert [r.predicted for r in tox.toxicity(documents(spark, ["a b", None]), none).collect()] == [0, 0]


def test_words_of_a_corpus_are_few_literals_of_a_plan(spark):
    words = [f"word{i}" for i in range(500)]
    df = sec.built(documents(spark, ["a"]), words, 64)
    assert df._jdf.queryExecution().analyzed().toJSON().count("expressions.Literal") < 5_000
    rows = df.collect()
    assert len(rows) == 64 and all(any(w in r.before.split() for w in words) for r in rows)

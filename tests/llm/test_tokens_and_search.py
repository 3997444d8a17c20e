import hashlib
import random

import numpy as np
import pytest
import sentencepiece
from helpers import documents, odd_texts, prose

from tidemark.llm.pieces import ChunkTable, decoded, default_model, digests, with_ids
from tidemark.llm.search import top_k


@pytest.fixture(scope="module")
def model():
    return sentencepiece.SentencePieceProcessor(model_file=default_model())


def test_chunks_give_the_ids_of_the_whole_text(model):
    rng = random.Random(2)
    letters = list(" ▁ab\n\t\x00é漢😀<s>|0　.") + ["  ", "the"]
    texts = [t for t in odd_texts() if t is not None] + ["".join(rng.choices(letters, k=rng.randint(0, 40))) for _ in range(5_000)]
    with open(default_model(), "rb") as file:
        table = ChunkTable(file.read(), limit=100)
    for text in texts:
        chunks = table.chunks(text)
        table.add([chunks])
        assert table.encode(chunks) == model.encode(text, add_eos=True), repr(text)


def test_digests_equal_the_library(spark, model):
    texts = odd_texts() + [prose(random.Random(i), 50) for i in range(40)]
    rows = {r.doc_id: r for r in digests(documents(spark, texts, clash=True)).collect()}
    assert len(rows) == len(texts)
    for i, text in enumerate(texts):
        ids = model.encode(text or "", add_eos=True)
        assert rows[i].n_tokens == len(ids)
        assert rows[i].ids_sha256 == hashlib.sha256(" ".join(map(str, ids)).encode()).hexdigest()
        assert rows[i].decoded_sha256 == hashlib.sha256(model.decode(ids).encode()).hexdigest()


def test_round_trip(spark):
    texts = [t for t in odd_texts() if t is not None] + [prose(random.Random(9), 200)]
    back = {r.doc_id: r.text for r in decoded(with_ids(documents(spark, texts))).collect()}
    assert back == dict(enumerate(texts))


def test_tokens_of_an_empty_table(spark):
    assert digests(documents(spark, [])).collect() == []


VECTORS = "vec_id long, embedding array<float>, label int, score string, block string"


def brute(vectors, k, every):
    used = {i: [int(np.floor(1024 * float(np.float32(c)))) for c in v] for i, v in vectors
            if v and all(c is not None and np.isfinite(c) for c in v)}
    out = []
    for q in used:
        if q % every == 0:
            scores = sorted((-sum(a * b for a, b in zip(used[q], used[x])), x) for x in used if x != q)[:k]
            out += [(q, rank + 1, x, -s) for rank, (s, x) in enumerate(scores)]
    return sorted(out)


@pytest.mark.parametrize("block_rows,query_rows", [(4096, 1024), (40, 7)])
def test_top_k_equals_brute_force(spark, block_rows, query_rows):
    rng = np.random.default_rng(3)
    vectors = [(i, (rng.normal(size=12) * (10 if i % 50 == 0 else 1)).astype(np.float32).tolist()) for i in range(400)]
    vectors += [(400 + i, vectors[7][1]) for i in range(30)]  # ties
    vectors += [(500, None), (510, []), (520, [1.0] * 11 + [None]), (530, [float("nan")] * 12), (540, [float("inf")] + [0.0] * 11),
                (550, [0.0] * 12), (560, [0.5] * 5)]
    df = spark.createDataFrame([(i, v, 0, "x", "y") for i, v in vectors], VECTORS).repartition(4)
    got = sorted((r.query_id, r.rank, r.vec_id, r.score) for r in
                 top_k(df, "vec_id % 10 = 0", 10, block_rows=block_rows, query_rows=query_rows).collect())
    assert got == brute(vectors, 10, 10)


def test_top_k_with_few_rows_and_none(spark):
    empty = spark.createDataFrame([], VECTORS)
    assert top_k(empty).collect() == []
    few = spark.createDataFrame([(0, [1.0, 2.0], 0, "", ""), (1, [3.0, -1.0], 0, "", ""), (None, [9.0, 9.0], 0, "", "")], VECTORS)
    assert [tuple(r) for r in top_k(few).collect()] == [(0, 1, 1, 1024 * 1024)]

import hashlib
import random
from heapq import heappop

import numpy as np
import public_tokenizers
import pyarrow as pa
import pytest
import tiktoken
from helpers import documents, odd_texts, prose

from tidemark.llm.bytepairs import BytePairs, Known, RankQueue, Splitter, class_differences, decoded, default_pattern, encoded, read_ranks
from tidemark.llm.registry import QUERIES

NEWER = "\U00010ee7\u0558\ua7ce\U00012550"  # letters and numbers of later versions of Unicode


@pytest.fixture(scope="module")
def library():
    return tiktoken.Encoding("own", pat_str=public_tokenizers.PATTERN, mergeable_ranks=read_ranks(), special_tokens={})


def numbers(ids):
    return np.frombuffer(ids, np.int32).tolist()


@pytest.fixture(scope="module")
def encode():
    """Ids of texts whose pre-tokens go through one queue."""
    split, model = Splitter(default_pattern(), class_differences(default_pattern())), BytePairs(read_ranks())

    def ids(*texts):
        return [numbers(found) for found in Known(model).encode([split(text) for text in texts])]

    return ids


def test_lower_ranks_come_first_in_the_middle_of_a_rank():
    # "bc" is worked on from the left; its first merge makes "abc" of lower rank, which has to go before the next "bc"
    tokens = [bytes([b]) for b in range(256)] + [b"abc", b"cd", b"bc", b"abcd", b"da"]
    ranks, rng = {token: rank for rank, token in enumerate(tokens)}, random.Random(2)
    theirs = tiktoken.Encoding("t", pat_str=r"[\s\S]+", mergeable_ranks=ranks, special_tokens={})
    pieces = ["".join(rng.choices("abcd", k=rng.randint(1, 12))) for _ in range(3_000)]
    model = BytePairs(ranks)
    got = [np.frombuffer(ids, np.int32).tolist() for ids in model.encode_pieces([piece.encode() for piece in pieces])]
    assert got == [theirs.encode_ordinary(piece) for piece in pieces]
    # few queues are filled: opening a rank costs as much as some merges
    model.merge = lambda pieces: opened.append(len(pieces)) or BytePairs.merge(model, pieces)
    opened = []
    model.encode_pieces([b"ab" + bytes(rng.choices(b"abcd", k=9)) for _ in range(8_000)])
    assert len(opened) == 1


def test_queue_gives_least_rank_then_leftmost_place():
    rng, queue, waiting = random.Random(4), RankQueue(50_256), []

    def pop():
        rank = queue.least()
        if rank < 0:
            return None
        place = heappop(queue.buckets[rank])
        if not queue.buckets[rank]:
            queue.close(rank)
        return rank, place

    for _ in range(4_000):
        if rng.random() < 0.6 or not waiting:
            waiting.append((rng.choice([rng.randrange(50_256), rng.randrange(40)]), rng.randrange(1_000_000)))
            queue.push(*waiting[-1])
        else:
            waiting.sort()
            assert pop() == waiting.pop(0)
    assert [pop() for _ in range(len(waiting))] == sorted(waiting)
    assert pop() is None and queue.top == 0 and not any(queue.words)
    queue.fill(np.array([3, -1, 700, 3, -1]))
    assert [pop() for _ in range(4)] == [(3, 0), (3, 3), (700, 2), None]
    assert RankQueue(1).least() == -1


def test_random_texts_equal_the_library(library, encode):
    rng = random.Random(1)
    letters = list("aaab t'sREé漢😀 \n\t\u00a0\u3000١5!.-_") + ["  ", "the", "ing", "'ll", *NEWER]
    texts = ["".join(rng.choices(letters, k=rng.randint(0, 40))) for _ in range(6_000)]
    for text, ids in zip(texts, encode(*texts), strict=True):
        assert ids == library.encode_ordinary(text), repr(text)


def test_pre_tokens_do_not_touch_each_other(library):
    rng, model = random.Random(3), BytePairs(read_ranks())
    pieces = ["".join(rng.choices("aabcn", k=rng.randint(1, 9))).encode() for _ in range(500)]
    together = [numbers(ids) for ids in model.encode_pieces(pieces)]
    assert together == [numbers(model.encode_pieces([piece])[0]) for piece in pieces]
    assert together == [library.encode_ordinary(piece.decode()) for piece in pieces]
    assert model.encode_pieces([]) == []


def test_every_code_point_is_cut_as_by_the_library(library, encode):
    texts = ["".join(f"a{chr(c)}a {chr(c)}1{chr(c)}  x" for c in range(first, first + 64) if not 0xD800 <= c < 0xE000)
             for first in range(0, 0x110000, 64)]
    assert encode(*texts) == [library.encode_ordinary(text) for text in texts]


@pytest.mark.parametrize("text", ["a" * 40_000, " " * 30_000, "ab" * 20_000, "漢字" * 9_000, "-=" * 15_000 + "x", "\n" * 20_001])
def test_very_long_pre_tokens(library, encode, text):
    mixed = "".join(random.Random(len(text)).choices("etaoinshrdlu", k=60_000))
    assert encode(text, mixed) == [library.encode_ordinary(text), library.encode_ordinary(mixed)]


def test_rows_equal_the_library(spark, library):
    texts = odd_texts() + [prose(random.Random(i), 60) for i in range(20)] + ["<|endoftext|>", f"x{NEWER}y"] + ["again and again"] * 5
    docs = documents(spark, texts, clash=True).withColumnRenamed("value", "ids").withColumnRenamed("at", "bytes")
    back = {r.doc_id: r for r in decoded(encoded(docs)).collect()}
    assert len(back) == len(texts)
    for i, text in enumerate(texts):
        assert list(back[i].ids) == library.encode_ordinary(text or "")
        assert bytes(back[i].bytes) == (text or "").encode()


def test_odd_rows(spark):
    assert encoded(documents(spark, [])).collect() == []
    repeated = documents(spark, ["one two"]).union(documents(spark, ["one two"]))
    assert len({tuple(r.ids) for r in encoded(repeated).collect()}) == 1 and encoded(repeated).count() == 2
    nothing = spark.createDataFrame([(1, None), (None, [])], "doc_id long, ids array<int>")
    assert sorted(((r.doc_id, r.bytes) for r in decoded(nothing).collect()), key=repr) == [(1, None), (None, b"")]


def test_query(spark, library, tmp_path):
    texts = odd_texts()
    documents(spark, texts).write.parquet(str(tmp_path / "documents.parquet"))
    rows = {r.doc_id: r for r in QUERIES["op11_byte_bpe"](spark, str(tmp_path)).collect()}
    for i, text in enumerate(texts):
        ids = library.encode_ordinary(text or "")
        assert rows[i].n_tokens == len(ids)
        assert rows[i].ids_sha256 == hashlib.sha256(",".join(map(str, ids)).encode()).hexdigest()
        assert rows[i].decoded_sha256 == hashlib.sha256((text or "").encode()).hexdigest()


def test_rows_of_a_batch_are_decoded_together():
    """Slices, NULL and empty rows get their own bytes; ids that are no tokens raise."""
    rng, model = random.Random(5), BytePairs(read_ranks())
    rows = [None if i % 7 == 0 else [rng.randrange(model.stop) for _ in range(rng.randrange(40) * (i % 5))] for i in range(200)]
    batch = pa.array(rows, pa.list_(pa.int32()))
    for start, length in ((0, 200), (3, 150), (7, 1), (1, 6)):
        want = [None if ids is None else model.decode(ids) for ids in rows[start:start + length]]
        assert model.decode_rows(batch.slice(start, length)).to_pylist() == want
    for wrong in ([model.stop], [-1], [None]):
        with pytest.raises(LookupError):
            model.decode_rows(pa.array([wrong], pa.list_(pa.int32())))

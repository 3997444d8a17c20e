"""SentencePiece encoding and decoding through tables of distinct chunks.

No piece of the model crosses from a character to a following whitespace marker,
so a normalised text can be cut before every run of markers ("marked words") and
each chunk can be segmented alone. A task keeps a table of the distinct chunks it
has met, segments only new ones, and puts the ids back by position. The table is
dropped when it has `TABLE_CHUNKS` entries, which bounds memory and changes no
result. There is no shuffle: documents stay where they were read.
"""

from __future__ import annotations

import hashlib
import re
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidemark.llm.common import documents
from tidemark.llm.registry import query

MARK = "▁"
CHUNK = re.compile(f"{MARK}+[^{MARK}]*|[^{MARK}]+")
TABLE_CHUNKS = 200_000
#: Rows of an Arrow batch that are worked on together.
ROWS = 256


def default_model() -> str:
    import public_tokenizers

    return public_tokenizers.path("piece_bpe_32k.model")


class ChunkTable:
    """Distinct chunk → ids, filled on demand from one model."""

    def __init__(self, model: bytes, limit: int = TABLE_CHUNKS):
        import sentencepiece

        self.model = sentencepiece.SentencePieceProcessor(model_proto=model)
        pieces = (self.model.id_to_piece(i) for i in range(self.model.get_piece_size()))
        if any(re.search(f"[^{MARK}]{MARK}", p) for p in pieces):
            raise ValueError("the model has pieces that cross whitespace markers")
        if self.model.normalize("a b") != f"{MARK}a{MARK}b":
            raise ValueError("the model does not mark the start of a text and its spaces")
        self.end, self.limit, self.ids = self.model.eos_id(), limit, {}
        self._alone()

    def _alone(self) -> None:
        # encode() returns nothing for a single marker, as it would stand for an empty text
        self.ids = {MARK: [self.model.piece_to_id(MARK)]}

    def chunks(self, text: str | None) -> list[str]:
        return CHUNK.findall(self.model.normalize(text)) if text else []

    def add(self, chunks: list[list[str]]) -> None:
        """Segment the chunks that are not in the table."""
        if len(self.ids) > self.limit:
            self._alone()
        new = list(set().union(*chunks).difference(self.ids)) if chunks else []
        # a chunk starts with a marker, which encode() puts there itself
        if new:
            self.ids.update(zip(new, self.model.encode([c[1:] for c in new], num_threads=1), strict=True))

    def encode(self, chunks: list[str]) -> list[int]:
        """Ids of a text cut into `chunks`, with the end id."""
        ids: list[int] = []
        for found in map(self.ids.__getitem__, chunks):
            ids += found
        ids.append(self.end)
        return ids


def with_ids(docs: DataFrame, model_path: str | None = None, id_column: str = "doc_id") -> DataFrame:
    """(doc_id, ids array<int>) of each document, the end id last; a NULL text counts as empty."""
    schema = f"{id_column} {docs.schema[id_column].dataType.simpleString()}, ids array<int>"
    return _each(docs, model_path, id_column, schema, lambda _, ids: {"ids": ids}, {"ids": pa.list_(pa.int32())})


def digests(docs: DataFrame, model_path: str | None = None, id_column: str = "doc_id") -> DataFrame:
    """(doc_id, n_tokens, ids_sha256, decoded_sha256) of each document, after a round trip."""
    def digest(model, ids):
        return {
            "n_tokens": len(ids),
            "ids_sha256": hashlib.sha256(" ".join(map(str, ids)).encode()).hexdigest(),
            "decoded_sha256": hashlib.sha256(model.decode(ids).encode()).hexdigest(),
        }

    schema = f"{id_column} {docs.schema[id_column].dataType.simpleString()}, n_tokens long, ids_sha256 string, decoded_sha256 string"
    return _each(docs, model_path, id_column, schema, digest,
                 {"n_tokens": pa.int64(), "ids_sha256": pa.string(), "decoded_sha256": pa.string()})


def decoded(rows: DataFrame, model_path: str | None = None, id_column: str = "doc_id") -> DataFrame:
    """(doc_id, text) from (doc_id, ids); NULL ids give a NULL text."""
    model = _read_model(model_path)

    def decode(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        import sentencepiece

        processor = sentencepiece.SentencePieceProcessor(model_proto=model)
        for batch in batches:
            texts = [None if ids is None else processor.decode(ids) for ids in batch.column(1).to_pylist()]
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(texts, pa.string())], names=[id_column, "text"])

    kind = rows.schema[id_column].dataType.simpleString()
    return rows.select(id_column, F.col("ids").cast("array<int>").alias("ids")).mapInArrow(decode, f"{id_column} {kind}, text string")


def _read_model(path: str | None) -> bytes:
    """The model travels with the task (it has a fixed size), so executors need no file."""
    with open(path or default_model(), "rb") as file:
        return file.read()


def _each(docs: DataFrame, model_path, id_column: str, schema: str, make, types: dict) -> DataFrame:
    model = _read_model(model_path)

    def encode(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        chunk_table = ChunkTable(model)
        for whole in batches:
            for at in range(0, whole.num_rows, ROWS):
                batch = whole.slice(at, ROWS)
                chunks = [chunk_table.chunks(text) for text in batch.column(1).to_pylist()]
                chunk_table.add(chunks)
                rows = [make(chunk_table.model, chunk_table.encode(c)) for c in chunks]
                yield pa.RecordBatch.from_arrays(
                    [batch.column(0), *(pa.array([r[n] for r in rows], t) for n, t in types.items())],
                    names=[id_column, *types])

    return docs.select(id_column, "text").mapInArrow(encode, schema)


@query("op4_sentencepiece")
def op4_sentencepiece(spark, sf_dir):
    return digests(documents(spark, sf_dir))

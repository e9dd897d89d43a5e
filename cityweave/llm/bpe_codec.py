"""BPE encoding and decoding by forced boundaries.

Byte pairs that occur inside no vocabulary token mark certain cuts: no merge
can span them.  Texts are cut at white space (held by no token) and words at
the other such pairs; the fragments are encoded independently and their ids
concatenated (``tokens.WordBpe``).  Only the last fragment of a word carries
the end-of-word mark.

Defined results: null or empty text has no ids and decodes to the empty text;
null ids stay null; repeated rows give repeated rows.
"""

from __future__ import annotations

import hashlib

import pyarrow as pa
from pyspark.sql import DataFrame

from cityweave.llm.shared import map_batches, texts_of
from cityweave.llm.tokens import WordBpe, encoder, read_vocabulary, word_cache


def encode(docs: DataFrame, vocabulary: str, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``id_col, ids array<int>`` for every row; no shuffle."""
    raw = read_vocabulary(docs.sparkSession, vocabulary)
    kind = docs.schema[id_col].dataType.simpleString()

    def make():
        cache = word_cache(raw.value)

        def ids_of(batch: pa.RecordBatch) -> pa.RecordBatch:
            blobs = [cache.encode(t) for t in texts_of(batch.column(1))]
            return pa.RecordBatch.from_arrays([batch.column(0), id_lists(blobs)], [id_col, "ids"])

        return ids_of

    return map_batches(docs.select(id_col, text_col), make, f"`{id_col}` {kind}, ids array<int>")


def id_lists(blobs: list[bytes]) -> pa.Array:
    """Arrow list<int32> whose rows are the little-endian ids of ``blobs``."""
    ends = [0]
    for b in blobs:
        ends.append(ends[-1] + len(b) // 4)
    values = pa.Array.from_buffers(pa.int32(), ends[-1], [None, pa.py_buffer(b"".join(blobs))])
    return pa.ListArray.from_arrays(pa.array(ends, pa.int32()), values)


def decode(encoded: DataFrame, vocabulary: str, id_col: str = "doc_id", ids_col: str = "ids") -> DataFrame:
    """``id_col, text``: the tokens' strings joined by blanks, as a file without a decoder gives them."""
    raw = read_vocabulary(encoded.sparkSession, vocabulary)
    kind = encoded.schema[id_col].dataType.simpleString()

    def make():
        names = encoder(WordBpe, raw.value).names

        def text_of(batch: pa.RecordBatch) -> pa.RecordBatch:
            texts = [" ".join(map(names.__getitem__, ids or ())) for ids in batch.column(1).to_pylist()]
            return pa.RecordBatch.from_arrays([batch.column(0), pa.array(texts, pa.string())], [id_col, "text"])

        return text_of

    return map_batches(encoded.select(id_col, ids_col), make, f"`{id_col}` {kind}, text string")


def round_trip_digests(docs: DataFrame, vocabulary: str, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``id_col, n_tokens, ids_sha256, decoded_sha256``: encode and decode in one pass over the texts."""
    raw = read_vocabulary(docs.sparkSession, vocabulary)
    kind = docs.schema[id_col].dataType.simpleString()

    def make():
        cache = word_cache(raw.value)
        names = cache.encoder.names

        def digests(batch: pa.RecordBatch) -> pa.RecordBatch:
            counts, ids_hex, text_hex = [], [], []
            for text in texts_of(batch.column(1)):
                ids = cache.encode(text)
                decoded = " ".join(map(names.__getitem__, memoryview(ids).cast("I")))
                counts.append(len(ids) // 4)
                ids_hex.append(hashlib.sha256(ids).hexdigest())
                text_hex.append(hashlib.sha256(decoded.encode()).hexdigest())
            return pa.RecordBatch.from_arrays(
                [batch.column(0), pa.array(counts, pa.int64()), pa.array(ids_hex), pa.array(text_hex)],
                [id_col, "n_tokens", "ids_sha256", "decoded_sha256"],
            )

        return digests

    return map_batches(
        docs.select(id_col, text_col), make, f"`{id_col}` {kind}, n_tokens bigint, ids_sha256 string, decoded_sha256 string"
    )

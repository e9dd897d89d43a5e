"""Token counts by overlap resynchronisation.

A text up to ``chunk_bytes`` is encoded at once.  A longer one is encoded in
chunks that overlap; two neighbouring chunks are spliced at a *proven stable
common boundary*: a position in the overlap at which both encodings have a
token border and at which the splitting pattern always ends a piece, whatever
stands before or after (letter | non-letter, digit | non-digit, or
non-white | white space).  From such a position on, the later chunk splits as
the whole text does; before it, the earlier chunk does.  Where the overlap has
no such position, it is doubled, at last up to the spliced part's start, so a
text without any boundary is encoded whole.

Defined results: null or empty text has 0 bytes and 0 tokens; a null id stays
null; repeated rows give repeated rows; extra columns are not read.
"""

from __future__ import annotations

import unicodedata

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame

from cityweave.llm.shared import map_batches, texts_of
from cityweave.llm.tokens import ByteBpe, encoder, read_vocabulary

CHUNK_BYTES = 32_768
OVERLAP_BYTES = 512
MIN_OVERLAP = 64  # longer than any special string


def _char_start(data: bytes, at: int) -> int:
    while 0 < at < len(data) and data[at] & 0xC0 == 0x80:
        at -= 1
    return at


def _always_splits(data: bytes, at: int) -> bool:
    """True where the pattern ends a piece at ``at`` in every text with these neighbours."""
    if data[at] & 0xC0 == 0x80:  # inside a character
        return False
    before = data[_char_start(data, at - 1) : at].decode()
    after = data[at : at + 4].decode(errors="ignore")[:1]
    if not before or not after:
        return False
    b, a = unicodedata.category(before)[0], unicodedata.category(after)[0]
    if b == "L" or b == "N":
        return a != b and a not in "MC"
    return not before.isspace() and b not in "MCZ" and after in " \t\n\r"


def _stable_boundary(data: bytes, left: np.ndarray, right: np.ndarray, lo: int, hi: int) -> int | None:
    """A common token border in (lo, hi) at which the pattern always splits; the last one."""
    both = np.intersect1d(left, right, assume_unique=True)
    for at in both[(both > lo) & (both < hi - 4)][::-1].tolist():
        if _always_splits(data, at):
            return at
    return None


def encode_resync(enc: ByteBpe, text: bytes, chunk: int = CHUNK_BYTES, overlap: int = OVERLAP_BYTES) -> np.ndarray:
    """Ids of a whole text, equal to encoding it at once."""
    if len(text) <= chunk:
        return enc.encode(text.decode())
    if overlap < MIN_OVERLAP:
        raise ValueError(f"overlap must be at least {MIN_OVERLAP} bytes")
    out: list[np.ndarray] = []
    start, end = 0, _char_start(text, chunk)
    ids = enc.encode(text[start:end].decode())
    borders = start + np.cumsum(enc.token_bytes[ids])
    while end < len(text):
        width = overlap
        while True:
            begin = max(start, _char_start(text, end - width))
            reach = _char_start(text, min(len(text), end + max(chunk, width)))
            later = enc.encode(text[begin:reach].decode())
            later_borders = begin + np.cumsum(enc.token_bytes[later])
            if begin == start:  # widened to all that is not yet spliced
                ids, borders = later, later_borders
                break
            at = _stable_boundary(text, borders, later_borders, begin, end)
            if at is not None:
                out.append(ids[: np.searchsorted(borders, at, "right")])
                k = np.searchsorted(later_borders, at, "right")
                start, ids, borders = at, later[k:], later_borders[k:]
                break
            width *= 2
        end = reach
    return np.concatenate([*out, ids])


def token_counts(
    docs: DataFrame,
    vocabulary: str,
    id_col: str = "doc_id",
    text_col: str = "text",
    limit: int = 1024,
    chunk_bytes: int = CHUNK_BYTES,
    overlap_bytes: int = OVERLAP_BYTES,
) -> DataFrame:
    """``id_col, n_bytes, n_tokens, over_limit`` for every row of ``docs``; no shuffle."""
    raw = read_vocabulary(docs.sparkSession, vocabulary)
    kind = docs.schema[id_col].dataType.simpleString()

    def make():
        enc = encoder(ByteBpe, raw.value)

        def count(batch: pa.RecordBatch) -> pa.RecordBatch:
            texts = texts_of(batch.column(1))
            n = np.array([len(encode_resync(enc, t, chunk_bytes, overlap_bytes)) for t in texts], np.int64)
            sizes = np.array([len(t) for t in texts], np.int64)
            return pa.RecordBatch.from_arrays(
                [batch.column(0), pa.array(sizes), pa.array(n), pa.array(n > limit)],
                [id_col, "n_bytes", "n_tokens", "over_limit"],
            )

        return count

    return map_batches(
        docs.select(id_col, text_col), make, f"`{id_col}` {kind}, n_bytes bigint, n_tokens bigint, over_limit boolean"
    )

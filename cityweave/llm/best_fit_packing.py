"""Vector best-fit packing of documents into sequences.

A document longer than a sequence is cut into full pieces and one shorter
first piece; other documents stay whole.  Every piece asks for three
capacities of a sequence: tokens, documents and attention cost (the sum of
squared piece lengths).  Pieces are taken by falling length; among the open
sequences in which a piece keeps *every* residual capacity at zero or more,
the one with the best score gets it: the largest weighted dot product of
demand and residual, or the smallest weighted norm of what would be left.

Pieces are dealt by hash to groups of about ``GROUP_PIECES``; each group is
packed by itself, in bounded memory, and loses at most a few part-filled
sequences.  Only piece sizes are shuffled, never token ids.

Defined results: null or empty text is one piece that holds the end id alone;
null ids and repeated rows are packed like any others; no rows give none.
"""

from __future__ import annotations

import heapq
import math
import zlib

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from cityweave.llm.shared import map_batches, texts_of, written
from cityweave.llm.tokens import ByteBpe, encoder, read_vocabulary

GROUP_PIECES = 100_000
SEQUENCE_TOKENS = 1024


def cut_pieces(docs: DataFrame, vocabulary: str, size: int, end_id: int | None, id_col: str, text_col: str, keep_ids: bool) -> DataFrame:
    """One row a piece: ``id, row_key, piece, start, length, ids_crc32`` (and ``ids``)."""
    raw = read_vocabulary(docs.sparkSession, vocabulary)
    kind = docs.schema[id_col].dataType.simpleString()
    schema = f"id {kind}, piece int, start bigint, length bigint, ids_crc32 bigint" + ", ids array<int>" * keep_ids
    tail = [] if end_id is None else [end_id]

    def make():
        enc = encoder(ByteBpe, raw.value)

        def cut(batch: pa.RecordBatch) -> pa.RecordBatch:
            owner, piece, starts, lengths, crcs, lists = [], [], [], [], [], []
            for row, text in enumerate(texts_of(batch.column(1))):
                ids = np.append(enc.encode(text.decode()), np.array(tail, np.uint32)).astype("<u4")
                first = len(ids) % size if len(ids) > size else len(ids)
                at = 0
                for k, end in enumerate(range(first if first or not len(ids) else size, len(ids) + 1, size)):
                    part = ids[at:end]
                    owner.append(row)
                    piece.append(k)
                    starts.append(at)
                    lengths.append(end - at)
                    crcs.append(zlib.crc32(part.tobytes()))
                    lists.append(part.astype(np.int32)) if keep_ids else None
                    at = end
            columns = [batch.column(0).take(pa.array(owner, pa.int64())), pa.array(piece, pa.int32())]
            columns += [pa.array(x, pa.int64()) for x in (starts, lengths, crcs)]
            columns += [pa.array(lists, pa.list_(pa.int32()))] * keep_ids
            return pa.RecordBatch.from_arrays(columns, ["id", "piece", "start", "length", "ids_crc32", "ids"][: len(columns)])

        return cut

    return map_batches(docs.select(id_col, text_col), make, schema)


def vector_best_fit(
    lengths: np.ndarray, size: int, max_docs: int, max_cost: int, score: str = "norm", weights: tuple[float, float, float] = (1.0, 0.25, 0.25)
) -> tuple[np.ndarray, np.ndarray]:
    """Sequence number and offset of each piece.

    Open sequences of equal residuals are one kind (of its members the least
    number is taken); every piece is scored against all kinds at once, so the
    choice is that of an exhaustive search.  A piece that alone exceeds a
    capacity gets a sequence of its own.
    """
    order = np.argsort(-lengths, kind="stable")
    sequence, offset = np.empty(len(lengths), np.int64), np.empty(len(lengths), np.int64)
    w = np.array(weights)[:, None] / np.array([[size], [max_docs], [max_cost]], float)
    room = np.full((3, 64), -1.0)  # residual tokens, documents, cost of each kind; negative: slot not used
    members: list[list[int]] = []  # heap of sequence numbers of each slot
    slots: dict[tuple[int, int, int], int] = {}
    free: list[int] = []
    opened = 0
    for i in order.tolist():
        n = int(lengths[i])
        need = np.array([[n], [1], [n * n]], float)
        now = room[:, : len(members)]
        left = now - need
        fits = (left >= 0).all(axis=0)
        if fits.any():
            points = ((w * left) ** 2).sum(axis=0) if score == "norm" else -(w * w * need * now).sum(axis=0)
            slot = int(np.argmin(np.where(fits, points, np.inf)))
            kind = tuple(int(x) for x in room[:, slot])
            number = heapq.heappop(members[slot])
            if not members[slot]:
                room[:, slot] = -1.0
                del slots[kind]
                heapq.heappush(free, slot)
        else:
            number, kind = opened, (size, max_docs, max_cost)
            opened += 1
        sequence[i], offset[i] = number, size - kind[0]
        rest = (kind[0] - n, kind[1] - 1, kind[2] - n * n)
        if min(rest) <= 0:
            continue
        if rest not in slots:
            if free:
                slots[rest] = heapq.heappop(free)
            else:
                slots[rest] = len(members)
                members.append([])
                if len(members) > room.shape[1]:
                    room = np.hstack([room, np.full_like(room, -1.0)])
            room[:, slots[rest]] = rest
        heapq.heappush(members[slots[rest]], number)
    return sequence, offset


def pack(
    pieces: DataFrame, size: int = SEQUENCE_TOKENS, max_docs: int | None = None, max_cost: int | None = None, score: str = "norm", group_pieces: int = GROUP_PIECES
) -> DataFrame:
    """Add ``sequence_id`` and ``offset`` to the rows of ``cut_pieces`` (kept as a table first)."""
    max_docs, max_cost = max_docs or size, max_cost or size * size
    spark = pieces.sparkSession
    rows = written(pieces, "pieces")
    groups = max(1, math.ceil(rows.count() / group_pieces))
    fields = [f for f in rows.schema.fields if f.name != "ids"]
    schema = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in fields) + ", sequence_id bigint, offset bigint"

    def fill(key: tuple, frame: pd.DataFrame) -> pd.DataFrame:
        frame = frame.drop(columns="_group").reset_index(drop=True)
        number, offset = vector_best_fit(frame["length"].to_numpy(), size, max_docs, max_cost, score)
        return frame.assign(sequence_id=number * groups + key[0], offset=offset)

    names = [f.name for f in fields]
    deal = F.pmod(F.xxhash64("id", "piece", "ids_crc32"), F.lit(groups)).alias("_group")
    return rows.select(*names, deal).groupBy("_group").applyInPandas(fill, schema)


def packed(
    docs: DataFrame, vocabulary: str, size: int = SEQUENCE_TOKENS, end_id: int | None = 2, id_col: str = "doc_id", text_col: str = "text", **options
) -> DataFrame:
    """Cut and pack ``docs``: ``id, piece, start, length, ids_crc32, sequence_id, offset``."""
    return pack(cut_pieces(docs, vocabulary, size, end_id, id_col, text_col, keep_ids=False), size, **options)

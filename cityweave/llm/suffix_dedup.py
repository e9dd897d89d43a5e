"""Exact removal of repeated byte strings by a distributed, sampled suffix sort.

A byte goes if it lies in a ``width``-byte string that also starts earlier
(smaller document, or same document and earlier start); strings are judged on
the input.  A document is an id with a text, told by the first 128 bits of the
text's SHA-256 (``tag``); documents are ordered by id, then tag.

1. Every window of ``width`` bytes has an anchor: its ``GRAM``-byte gram of
   least hash.  Equal windows have equal anchors at equal offsets, so only
   anchors whose gram occurs twice or more matter (counted with map-side
   partial sums, kept by a semi join; AQE splits hot grams there).
2. The suffixes at these anchors are range-partitioned by their leading bytes,
   with splitters sampled from them; ties are cut by (document, position), so that a
   passage found in a third of all documents is spread over buckets.
3. Each bucket, sized by the number of anchors and solved by itself, sorts its suffixes (and the reversed texts left of the anchors)
   by multikey sort; common prefixes of neighbours give, for every window, its
   class of equal windows.  All but a class's first occurrence are repeats.
4. Across boundaries: a class can reach into another bucket only if its part
   right of the anchor is a prefix of a splitter.  Such classes send their first
   occurrence with its bytes to one more grouping, which finds the first of all.

Documents equal as a whole have one tag: only the first of them goes through
steps 2 to 4, the others are removed whole.

Defined results: null text counts as empty; texts shorter than ``width`` stay
as they are; a null id counts as the smallest; repeated rows of one document
count as that document and each gets its result; different texts under one id
(or under no id) are documents of their own; extra columns are not read.
"""

from __future__ import annotations

from bisect import bisect_right

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from cityweave.llm.shared import map_batches, text_digest, texts_of, written
from cityweave.llm.suffix_sort import GRAM, Prefixes, anchors, common_prefix, rows_of

WIDTH = 100
NO_ID = -(1 << 63)  # stands for a null id
DOC = ("did", "tag")  # what names a document
SAMPLE_ONE_IN = 64  # anchors read for splitters
BUCKETS_PER_PARTITION = 4
BUCKET_SUFFIXES = 20_000  # suffixes that a bucket should hold
SPLITTERS_MAX = 200_000  # rows of the sample that the driver takes, by expectation
_REACH = 1 << 8  # packs (position, left reach of first and last window)


def _anchor_rows(docs: DataFrame, width: int) -> DataFrame:
    """``gram, did, tag, at``: one row an anchor."""

    def make():
        def find(batch: pa.RecordBatch) -> pa.RecordBatch:
            texts = texts_of(batch.column(2))
            ends = np.cumsum([len(t) for t in texts])
            data = np.frombuffer(b"".join(texts), np.uint8)
            gram, at, first, last = anchors(data, ends, width)
            text = np.searchsorted(ends, at, "right")
            local = at - np.concatenate([[0], ends])[text]
            packed = (local * _REACH + first) * _REACH + last
            did, tag = (batch.column(i).take(pa.array(text)) for i in (0, 1))
            return pa.RecordBatch.from_arrays([pa.array(gram.view(np.int64)), did, tag, pa.array(packed)], ["gram", "did", "tag", "at"])

        return find

    return map_batches(docs.select("did", "tag", "text"), make, "gram bigint, did bigint, tag binary, at bigint")


def _candidates(docs: DataFrame, width: int) -> DataFrame:
    """``did, tag, at`` of the first document of each text: its anchors of repeated grams, if any."""
    rows = _anchor_rows(docs.where(F.octet_length("text") >= width), width)
    # written first: a join with a plain table can be split at a gram that very many documents share
    repeated = written(rows.groupBy("gram").agg(F.count(F.lit(1)).alias("n")).where("n > 1").select("gram"), "repeated-grams")
    kept = rows.join(repeated, "gram", "left_semi").groupBy(*DOC).agg(F.sort_array(F.collect_set("at")).alias("at"))
    firsts = docs.groupBy("tag").agg(F.min("did").alias("did"))
    return firsts.join(kept, list(DOC), "left").select(*DOC, "at")


def _suffix_rows(docs: DataFrame, side: DataFrame, width: int, splitters) -> DataFrame:
    """``bucket, did, tag, at, span``: the text around each anchor, from its first window's start to its last one's end."""
    # all columns of docs are kept, so that both joins of the texts read one shuffle of them
    joined = docs.join(side, list(DOC)).select(*DOC, "text", "at", *docs.columns[3:])

    def make():
        cuts = splitters.value if splitters is not None else []

        def spans(batch: pa.RecordBatch) -> pa.RecordBatch:
            out_row, out_at, out_span, out_bucket = [], [], [], []
            names = zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), strict=True)
            for row, ((did, tag), text, packed) in enumerate(zip(names, texts_of(batch.column(2)), batch.column(3), strict=True)):
                for at in packed.values.to_numpy().tolist():
                    rest, last = divmod(at, _REACH)
                    p, first = divmod(rest, _REACH)
                    out_row.append(row)
                    out_at.append(at)
                    out_span.append(text[p - first : p - last + width])
                    out_bucket.append(bisect_right(cuts, (text[p : p - last + width], did, tag, p)))
            did, tag = (batch.column(i).take(pa.array(out_row, pa.int64())) for i in (0, 1))
            return pa.RecordBatch.from_arrays(
                [pa.array(out_bucket, pa.int32()), did, tag, pa.array(out_at, pa.int64()), pa.array(out_span, pa.binary())],
                ["bucket", "did", "tag", "at", "span"],
            )

        return spans

    return map_batches(joined, make, "bucket int, did bigint, tag binary, at bigint, span binary")


def _splitters(docs: DataFrame, side: DataFrame, width: int, least: int) -> list[tuple[bytes, int, bytes, int]]:
    """Suffixes that part a sample into even buckets of about ``BUCKET_SUFFIXES``, ``least`` buckets or more.

    The sample takes single anchors by a hash of document and place, whatever
    their documents' sizes; its rate is set so that the driver gets about
    ``SPLITTERS_MAX`` short suffixes at most.
    """
    total = side.agg(F.sum(F.size("at"))).first()[0] or 0
    buckets = max(least, -(-total // BUCKET_SUFFIXES))
    one_in = max(SAMPLE_ONE_IN if total > 100 * buckets * SAMPLE_ONE_IN else 4, 1 + total // SPLITTERS_MAX)
    picked = F.pmod(F.xxhash64(*DOC, "at", F.lit("splitters")), F.lit(one_in)) == 0
    anchors_picked = side.select(*DOC, F.explode("at").alias("at")).where(picked).groupBy(*DOC).agg(F.collect_list("at").alias("at"))
    # at most about SPLITTERS_MAX rows: broadcast, so that the texts stay in place; repeated rows of a document give the same suffixes
    sample = _suffix_rows(docs, F.broadcast(anchors_picked), width, None).dropDuplicates([*DOC, "at"])
    offset = (F.shiftright("at", 8) % F.lit(_REACH)).cast("int")
    rows = sample.select(F.substring("span", 1, 2 * width).alias("span"), offset.alias("first"), *DOC, F.shiftright("at", 16).alias("p")).collect()
    keys = sorted((bytes(r["span"])[r["first"] :], r["did"], bytes(r["tag"]), r["p"]) for r in rows)
    return [keys[len(keys) * i // buckets] for i in range(1, buckets)] if len(keys) >= buckets else keys


def _bucket_repeats(suffixes: DataFrame, width: int, splitters, partitions: int) -> DataFrame:
    """``key, did, tag, start, end``: repeated ranges (empty key), and first windows at boundaries (key: their bytes)."""
    left_width = width - GRAM

    def solve(batches):
        """One bucket at a time: rows come in the order of buckets."""
        held: list[pa.RecordBatch] = []
        for batch in batches:
            own = batch.column(0).to_numpy()
            for a, b in zip(ends := [0, *(np.flatnonzero(np.diff(own)) + 1).tolist()], [*ends[1:], len(own)], strict=True):
                if held and a < b and held[-1].column(0)[0].as_py() != own[a]:
                    yield bucket_ranges(held)
                    held = []
                if a < b:
                    held.append(batch.slice(a, b - a))
        if held:
            yield bucket_ranges(held)

    def bucket_ranges(parts: list[pa.RecordBatch]) -> pa.RecordBatch:
        table = pa.Table.from_batches(parts)
        cuts = splitters.value
        did, packed = table["did"].to_numpy(), table["at"].to_numpy()
        tag = np.frombuffer(b"".join(table["tag"].to_pylist()), ">u8").reshape(-1, 2)
        order = np.lexsort((packed, tag[:, 1], tag[:, 0], did))  # by document and position
        did, tag, packed, bucket = did[order], tag[order], packed[order], table["bucket"].to_numpy()[order]
        new = (did[1:] != did[:-1]) | (tag[1:] != tag[:-1]).any(axis=1)
        doc = np.concatenate([[0], np.cumsum(new)])  # numbers the documents in order
        spans = table["span"].take(pa.array(order)).to_pylist()
        del table, parts
        p, first, last = packed // _REACH**2, packed // _REACH % _REACH, packed % _REACH
        heads = first.tolist()
        right = rows_of([s[h:] for s, h in zip(spans, heads, strict=True)], width)
        left = rows_of([s[:h][::-1] for s, h in zip(spans, heads, strict=True)], left_width)
        by_right, by_left = Prefixes(right), Prefixes(left)
        edge = np.zeros(len(did), np.int64)  # bytes shared with a splitter of the bucket
        for b in np.unique(bucket).tolist():
            rows = np.flatnonzero(bucket == b)
            for k in (b - 1, b):
                if 0 <= k < len(cuts):
                    cut = cuts[k][0]
                    shared = common_prefix(right[rows], np.broadcast_to(rows_of([cut], width), (len(rows), width)))
                    edge[rows] = np.maximum(edge[rows], np.minimum(shared, len(cut)))
        repeat = np.zeros((len(did), left_width + 2), bool)
        keys, owners, starts, ends = [], [], [], []
        # a span equal to an earlier one as a whole: all its windows are repeats
        whole = (by_right.classes(width) * np.int64(len(did)) + by_left.classes(left_width)) * _REACH**2 + packed % _REACH**2
        _, at, which = np.unique(whole, return_index=True, return_inverse=True)
        head = at[which]
        later = np.flatnonzero((doc != doc[head]) | (p != p[head]))
        offsets = np.arange(left_width + 2)
        repeat[later] = (offsets >= last[later, None]) & (offsets <= first[later, None])
        fresh = np.ones(len(did), bool)
        fresh[later] = False
        for j in range(left_width + 1):
            rows = np.flatnonzero((last <= j) & (j <= first) & fresh)
            if not len(rows):
                continue
            same = by_right.classes(width - j)[rows] * np.int64(len(did)) + by_left.classes(j)[rows]
            _, at, which = np.unique(same, return_index=True, return_inverse=True)
            head = rows[at[which]]
            repeat[rows, j] = (doc[rows] != doc[head]) | (p[rows] != p[head])
            for r in rows[(head == rows) & (edge[rows] >= width - j)].tolist():
                keys.append(spans[r][heads[r] - j : heads[r] - j + width])
                owners.append(r)
                starts.append(p[r] - j)
                ends.append(p[r] - j + width)
        change = np.diff(repeat.astype(np.int8), axis=1, prepend=0)
        row, opened = np.nonzero(change == 1)
        _, closed = np.nonzero(change == -1)
        start, end = p[row] - closed + 1, p[row] - opened + width
        owner = np.concatenate([row, np.array(owners, np.int64)])
        columns = [
            pa.array([b""] * len(row) + keys, pa.binary()),
            pa.array(did[owner]),
            pa.array([t.tobytes() for t in tag[owner]], pa.binary()),
            pa.array(np.concatenate([start, np.array(starts, np.int64)])),
            pa.array(np.concatenate([end, np.array(ends, np.int64)])),
        ]
        return pa.RecordBatch.from_arrays(columns, ["key", "did", "tag", "start", "end"])

    return suffixes.repartition(partitions, "bucket").sortWithinPartitions("bucket").mapInArrow(solve, "key binary, did bigint, tag binary, start bigint, `end` bigint")


def _merged(ranges: list[tuple[int, int]]) -> list[tuple[int, int]]:
    out: list[tuple[int, int]] = []
    for a, b in sorted(ranges):
        if out and a <= out[-1][1]:
            out[-1] = (out[-1][0], max(out[-1][1], b))
        else:
            out.append((a, b))
    return out


def _whole_chars(text: bytes, a: int, b: int) -> tuple[int, int]:
    """The largest range of whole characters inside [a, b)."""
    while a < b and text[a] & 0xC0 == 0x80:
        a += 1
    while a < b < len(text) and text[b] & 0xC0 == 0x80:
        b -= 1
    return a, b


def suffix_dedup(
    docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", width: int = WIDTH, whole_chars: bool = False, carry: tuple[str, ...] = ()
) -> DataFrame:
    """``did, n_bytes, n_removed, n_spans, kept binary, spans`` for every row.

    ``spans`` are the maximal removed ranges in bytes.  With ``whole_chars``
    a range gives up the parts of characters at its ends, so that ``kept`` is
    UTF-8.  ``did`` is the id, null where the id is null.  The columns ``carry``
    come back in a struct ``carried``.
    """
    if not 2 * GRAM <= width < _REACH:
        raise ValueError(f"width must be {2 * GRAM} to {_REACH - 1} bytes")
    spark = docs.sparkSession
    partitions = int(spark.conf.get("spark.sql.shuffle.partitions"))
    docs = docs.select(
        F.coalesce(F.col(id_col).cast("bigint"), F.lit(NO_ID)).alias("did"),
        text_digest(text_col).alias("tag"),
        F.coalesce(F.col(text_col), F.lit("")).alias("text"),
        *([F.struct(*carry).alias("carried")] if carry else []),
    )
    side = written(_candidates(docs, width), "suffix-candidates")
    splitters = spark.sparkContext.broadcast(_splitters(docs, side, width, partitions * BUCKETS_PER_PARTITION))
    found = _bucket_repeats(_suffix_rows(docs, side.where("at is not null"), width, splitters), width, splitters, partitions)
    found = written(found, "ranges")
    here, settled = F.struct(*DOC, "start"), F.octet_length("key") == 0
    # only classes at boundaries meet once more
    edges = found.where(~settled).withColumn("first", F.min(here).over(Window.partitionBy("key"))).where(here > F.col("first"))
    ranges = found.where(settled).select(*DOC, "start", "end").unionByName(edges.select(*DOC, "start", "end"))
    repeats = ranges.groupBy(*DOC).agg(F.collect_list(F.struct("start", "end")).alias("ranges"))
    joined = (
        docs.join(side.select(*DOC, F.lit(True).alias("first")), list(DOC), "left")
        .join(repeats, list(DOC), "left")
        .select("did", "text", F.coalesce("first", F.lit(False)).alias("first"), "ranges", *docs.columns[3:])
    )
    carried = docs.schema.fields[3:]
    names = ["did", "n_bytes", "n_removed", "n_spans", "kept", "spans", *(f.name for f in carried)]

    def make():
        def cut(batch: pa.RecordBatch) -> pa.RecordBatch:
            texts, sizes, removed, spans, kept = texts_of(batch.column(1)), [], [], [], []
            for text, first, found in zip(texts, batch.column(2).to_pylist(), batch.column(3).to_pylist(), strict=True):
                if not first and len(text) >= width:
                    ranges = [(0, len(text))]
                else:
                    ranges = _merged([(r["start"], r["end"]) for r in found or ()])
                if whole_chars:
                    ranges = [r for r in (_whole_chars(text, a, b) for a, b in ranges) if r[0] < r[1]]
                edges = [0, *(x for r in ranges for x in r), len(text)]
                kept.append(b"".join(text[a:b] for a, b in zip(edges[::2], edges[1::2], strict=True)))
                sizes.append(len(text))
                removed.append(len(text) - len(kept[-1]))
                spans.append([{"start": a, "end": b} for a, b in ranges])
            return pa.RecordBatch.from_arrays(
                [
                    batch.column(0),
                    *(pa.array(x, pa.int64()) for x in (sizes, removed, [len(s) for s in spans])),
                    pa.array(kept, pa.binary()),
                    pa.array(spans, pa.list_(pa.struct([("start", pa.int64()), ("end", pa.int64())]))),
                    *batch.columns[4:],
                ],
                names,
            )

        return cut

    schema = "did bigint, n_bytes bigint, n_removed bigint, n_spans bigint, kept binary, spans array<struct<start:bigint,`end`:bigint>>"
    schema += "".join(f", `{f.name}` {f.dataType.simpleString()}" for f in carried)
    return map_batches(joined, make, schema).withColumn("did", F.nullif("did", F.lit(NO_ID)))

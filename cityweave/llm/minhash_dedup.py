"""Near-duplicate documents by circulant MinHash, confirmed on full shingle sets.

One permutation ``sigma`` scatters the shingles over 32-bit positions; a
second, ``pi``, is shifted circularly by k for signature coordinate k:
``min over shingles of pi(sigma(s) + k mod 2^32)``.  ``pi`` is a bijection of
the positions; ``sigma`` mixes 64 bits by a bijection and keeps 32 of them, so
a few shingles may share a position, which only affects who is a candidate.
The two give all ``BANDS * ROWS`` coordinates.

A document is an id with a text; its key is the id and the first 128 bits of
the text's SHA-256, in bytes that sort by id, then digest.  Keys name sets,
candidates and links.

1. Documents with equal shingle sets (128-bit digest) are one set; its least
   key stands for it.
2. Sets that share a band are candidates.  The centre of a set is the least
   key that shares a bucket with it.  Every set is compared with its centre, and
   what it adds to the centre's shingles and lacks of them (its edits) is kept.
3. Two sets of one centre differ by their edits that are not shared, so their
   exact similarity follows from the edits alone.  Sets near their centre are
   linked through it; each of the others is compared with all sets of that
   centre, in blocks, through an index of the edits.  No pairs leave the block
   but a spanning forest of its links.
4. Candidates with different centres that still lie in different components
   are compared in blocks as well, by their whole sets: in each band the sets
   outside its largest component with all.  A pair inside one component
   changes no component, so nothing is lost.

Links are confirmed on the whole sets of 64-bit shingle hashes.

With 40 bands of 6 rows a pair at similarity 0.8 shares no band with
probability 5e-6, one at 0.9 with less than 1e-13.

Defined results: null or empty text (no words) has an empty set and is linked
with nothing; a text of fewer words than a shingle has one shingle, its whole
sequence; a null id counts as the smallest; different texts under one id (or
under no id) are documents of their own, of which one component keeps the one
of least key; repeated rows of one document share its set and its result;
extra columns are not read.
"""

from __future__ import annotations

import hashlib

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from cityweave.llm.components import connected_components
from cityweave.llm.shared import map_batches, text_digest, texts_of, written

NO_ID = -(1 << 63)  # stands for a null id
BANDS, ROWS = 40, 6
KEY_BYTES = 24
BROADCAST_IDS_BYTES = 32 << 20  # a counted id list up to this size is broadcast, a larger one is joined by shuffle
BLOCK_SETS = 1024  # sets of one centre compared in one task, on either side
BLOCK_SHINGLES = 1 << 20  # and their shingles, where whole sets are compared
_CHUNK = 1 << 15  # shingles permuted at once: stays in the processor's cache


def _key(did: str, tag: str) -> Column:
    """Id and digest as bytes that sort like the two; never null if they aren't."""
    head = F.unhex(F.lpad(F.hex(F.col(did).bitwiseXOR(F.lit(NO_ID))), 16, "0"))
    return F.coalesce(F.concat(head, tag), F.lit(b""))


def _id_of(key: Column) -> Column:
    return F.conv(F.hex(F.substring(key, 1, 8)), 16, -10).cast("bigint").bitwiseXOR(F.lit(NO_ID))


def _mix64(h: np.ndarray) -> np.ndarray:
    h = (h ^ (h >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    h = (h ^ (h >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return h ^ (h >> np.uint64(31))


def shingle_hashes(text: bytes, k: int) -> np.ndarray:
    """Sorted distinct 64-bit hashes of the ``k``-word shingles; ASCII letters in lower case."""
    words = text.lower().split()
    if not words:
        return np.empty(0, np.uint64)
    h = np.fromiter(map(xxhash.xxh3_64_intdigest, words), np.uint64, len(words))
    n = max(1, len(words) - k + 1)
    out = np.full(n, k if len(words) >= k else -len(words), np.int64).view(np.uint64)
    for i in range(min(k, len(words))):
        out = _mix64(out * np.uint64(0x9E3779B97F4A7C15) + h[i : i + n])
    return np.unique(out)


def _band_hashes(sets: list[np.ndarray], bands: int, rows: int) -> np.ndarray:
    """Band hashes (sets x bands) of non-empty shingle sets."""
    out = np.empty((len(sets), bands), np.uint64)
    at = 0
    while at < len(sets):
        end, size = at, 0
        while end < len(sets) and (end == at or size + len(sets[end]) <= _CHUNK):
            size += len(sets[end])
            end += 1
        part = sets[at:end]
        starts = np.cumsum([0, *map(len, part[:-1])])
        sigma = (_mix64(np.concatenate(part) ^ np.uint64(0xA5A5F00D5EED1234)) >> np.uint64(32)).astype(np.uint32)
        v, t = np.empty_like(sigma), np.empty_like(sigma)
        for band in range(bands):
            h = np.full(len(part), band + 1, np.uint64)
            for row in range(rows):
                np.add(sigma, np.uint32(band * rows + row), out=v)  # circular shift
                np.right_shift(v, 16, out=t)
                np.bitwise_xor(v, t, out=v)
                np.multiply(v, np.uint32(0x85EBCA6B), out=v)
                np.right_shift(v, 13, out=t)
                np.bitwise_xor(v, t, out=v)
                np.multiply(v, np.uint32(0xC2B2AE35), out=v)
                np.right_shift(v, 16, out=t)
                np.bitwise_xor(v, t, out=v)
                h = _mix64(h * np.uint64(0x9E3779B97F4A7C15) + np.minimum.reduceat(v, starts))
            out[at:end, band] = h
        at = end
    return out


def signatures(docs: DataFrame, shingle_words: int, bands: int = BANDS, rows: int = ROWS) -> DataFrame:
    """``sid, n, digest, bands`` for every row of ``docs(sid, text)``; no shuffle."""

    def make():
        def sign(batch: pa.RecordBatch) -> pa.RecordBatch:
            sets = [shingle_hashes(t, shingle_words) for t in texts_of(batch.column(1))]
            full = [i for i, s in enumerate(sets) if len(s)]
            lists: list[list[int] | None] = [None] * len(sets)
            if full:
                for i, row in zip(full, _band_hashes([sets[i] for i in full], bands, rows).view(np.int64).tolist(), strict=True):
                    lists[i] = row
            digests = [hashlib.blake2b(s.tobytes(), digest_size=16).digest() if len(s) else None for s in sets]
            return pa.RecordBatch.from_arrays(
                [batch.column(0), pa.array([len(s) for s in sets], pa.int64()), pa.array(digests, pa.binary()), pa.array(lists, pa.list_(pa.int64()))],
                ["sid", "n", "digest", "bands"],
            )

        return sign

    return map_batches(docs.select("sid", "text"), make, "sid binary, n bigint, digest binary, bands array<bigint>")


def _full_sets(docs: DataFrame, ids: DataFrame, shingle_words: int) -> DataFrame:
    """``sid, shingles`` of the documents named in ``ids(sid)``."""
    few = ids.count() * KEY_BYTES <= BROADCAST_IDS_BYTES
    named = docs.join(F.broadcast(ids) if few else ids, "sid", "left_semi")

    def make():
        def shingle(batch: pa.RecordBatch) -> pa.RecordBatch:
            sets = [shingle_hashes(t, shingle_words).view(np.int64) for t in texts_of(batch.column(1))]
            return pa.RecordBatch.from_arrays([batch.column(0), pa.array(sets, pa.list_(pa.int64()))], ["sid", "shingles"])

        return shingle

    return map_batches(named.select("sid", "text"), make, "sid binary, shingles array<bigint>").dropDuplicates(["sid"])


def _compared(pairs: DataFrame, sets: DataFrame) -> DataFrame:
    """The pairs ``(a, b)`` with ``plus`` and ``minus`` (shingles of a alone, of b alone) and both sizes."""
    left = sets.select(F.col("sid").alias("a"), F.col("shingles").alias("x"))
    right = sets.select(F.col("sid").alias("b"), F.col("shingles").alias("y"))
    sizes = [F.size(c).cast("bigint").alias(f"n_{s}") for c, s in (("x", "a"), ("y", "b"))]
    alone = [F.array_except("x", "y").alias("plus"), F.array_except("y", "x").alias("minus")]
    return pairs.join(left, "a").join(right, "b").select("a", "b", *sizes, *alone)


def _near(percent: int) -> str:
    """Similarity of at least ``percent``, from the sizes and the number of shingles not shared."""
    return f"(n_a + n_b) * {100 - percent} >= (size(plus) + size(minus)) * {100 + percent}L"


def links_of_block(members: dict[str, list], far: dict[str, list], percent: int) -> list[tuple[bytes, bytes]]:
    """Spanning forest of the links between ``far`` sets and ``members`` of one centre.

    Both hold ``sid``, ``n`` (set size) and ``edits`` (codes of added and
    lacking shingles).  An index lists the members of every edit; counting
    the lists of a set's edits gives what it shares with each member.
    """
    sizes = np.array(members["n"], np.int64)
    counts = np.array([len(e) for e in members["edits"]], np.int64)
    owner = np.repeat(np.arange(len(counts)), counts)
    codes = np.concatenate([np.asarray(e, np.int64) for e in members["edits"]]) if counts.sum() else np.empty(0, np.int64)
    order = np.argsort(codes, kind="stable")
    codes, owner = codes[order], owner[order]
    root: dict[bytes, bytes] = {}

    def find(x: bytes) -> bytes:
        root.setdefault(x, x)
        while root[x] != x:
            root[x] = root[root[x]]
            x = root[x]
        return x

    for sid, n, edits in zip(far["sid"], far["n"], far["edits"], strict=True):
        own = np.asarray(edits, np.int64)
        lo, hi = np.searchsorted(codes, own, "left"), np.searchsorted(codes, own, "right")
        width = hi - lo
        at = np.repeat(lo - np.concatenate([[0], np.cumsum(width)[:-1]]), width) + np.arange(width.sum())
        shared = np.bincount(owner[at], minlength=len(counts))
        apart = len(own) + counts - 2 * shared
        for k in np.flatnonzero((n + sizes) * (100 - percent) >= apart * (100 + percent)).tolist():
            x, y = find(sid), find(members["sid"][k])
            if x != y:
                root[max(x, y)] = min(x, y)
    return [(x, find(x)) for x in list(root) if find(x) != x]


def _solved(table: pa.Table, sid: str, percent: int) -> pa.Table:
    """Links of one block: rows marked ``far`` against the others."""
    far = table["far"].to_numpy()

    def side(rows: pa.Table) -> dict[str, list]:
        edits = rows["edits"].combine_chunks()
        values, ends = edits.values.to_numpy(zero_copy_only=False), edits.offsets.to_numpy()
        return {"sid": rows[sid].to_pylist(), "n": rows["n"].to_pylist(), "edits": [values[i:j] for i, j in zip(ends[:-1], ends[1:], strict=True)]}

    links = links_of_block(side(table.filter(pa.array(~far))), side(table.filter(pa.array(far))), percent)
    return pa.table({"a": pa.array([x for x, _ in links], pa.binary()), "b": pa.array([y for _, y in links], pa.binary())})


def _links_by_centre(edits: DataFrame, percent: int, block: int) -> DataFrame:
    """Links ``(a, b)`` between sets of one centre of which at least one is not near it.

    ``edits(a, b, n_a, n_b, plus, minus)``: a set, its centre, and its edits.
    """
    far = edits.withColumn("far", ~F.expr(_near(percent)))
    groups = far.groupBy("b").agg(F.count(F.lit(1)).alias("n"), F.count_if("far").alias("n_far")).where("n > 1 and n_far > 0")
    blocks = [F.ceil(F.col(c) / F.lit(block)).cast("int").alias(f"{c}_blocks") for c in ("n", "n_far")]
    rows = far.join(groups.select("b", *blocks), "b").select(
        "b", "a", F.col("n_a").alias("n"), "far", "n_blocks", "n_far_blocks",
        # a lacking shingle gets another code than the same one added
        F.concat("plus", F.transform("minus", lambda h: F.xxhash64(h, F.lit("minus")))).alias("edits"),
    )
    deal, every = F.xxhash64("a"), lambda n: F.explode(F.sequence(F.lit(0), F.col(n) - 1))
    members = rows.withColumn("mb", F.pmod(deal, F.col("n_blocks")).cast("int")).withColumn("fb", every("n_far_blocks")).withColumn("far", F.lit(False))
    others = rows.where("far").withColumn("fb", F.pmod(deal, F.col("n_far_blocks")).cast("int")).withColumn("mb", every("n_blocks"))
    names = ("b", "mb", "fb", "a", "n", "far", "edits")

    def solve(table: pa.Table) -> pa.Table:
        return _solved(table, "a", percent)

    both = members.select(*names).unionByName(others.select(*names))
    # dealt anew by block: rows that lie by centre would leave all its blocks to one task
    return both.repartition("b", "mb", "fb").groupBy("b", "mb", "fb").applyInArrow(solve, "a binary, b binary")


def _links_between(placed: DataFrame, sets: DataFrame, percent: int) -> DataFrame:
    """Links ``(a, b)`` between sets that share a band but neither centre nor component.

    ``placed(band, sid, n, centre, part)``.  In a band, the sets outside its
    largest component are compared with all, in blocks bounded in sets and in
    shingles; no pairs leave a block but a spanning forest of its links.
    """
    split = placed.groupBy("band").agg(F.min("part").alias("p"), F.max("part").alias("q"), F.min("centre").alias("c"), F.max("centre").alias("d"))
    rows = placed.join(split.where("p <> q and c <> d").select("band"), "band")
    sizes = rows.groupBy("band", "part").agg(F.count(F.lit(1)).alias("sets"), F.sum("n").alias("shingles"))
    total, largest = F.struct(F.sum("sets").alias("sets"), F.sum("shingles").alias("shingles")), F.max(F.struct("sets", "shingles", "part"))
    bands = sizes.groupBy("band").agg(total.alias("all"), largest.alias("main"))

    def blocks(of_sets: str, of_shingles: str) -> Column:
        return F.ceil(F.greatest(F.expr(of_sets) / BLOCK_SETS, F.expr(of_shingles) / BLOCK_SHINGLES, F.lit(1))).cast("int")

    bands = bands.select(
        "band",
        F.col("main.part").alias("main"),
        blocks("all.sets", "all.shingles").alias("m_blocks"),
        blocks("all.sets - main.sets", "all.shingles - main.shingles").alias("f_blocks"),
    )
    rows = rows.join(bands, "band").select("band", "sid", "n", (F.col("part") != F.col("main")).alias("far"), "m_blocks", "f_blocks")
    deal, every = F.xxhash64("sid"), lambda n: F.explode(F.sequence(F.lit(0), F.col(n) - 1))
    members = rows.withColumn("mb", F.pmod(deal, F.col("m_blocks")).cast("int")).withColumn("fb", every("f_blocks")).withColumn("far", F.lit(False))
    others = rows.where("far").withColumn("fb", F.pmod(deal, F.col("f_blocks")).cast("int")).withColumn("mb", every("m_blocks"))
    names = ("band", "mb", "fb", "sid", "n", "far")
    both = members.select(*names).unionByName(others.select(*names)).join(sets.withColumnRenamed("shingles", "edits"), "sid")

    def solve(table: pa.Table) -> pa.Table:
        return _solved(table, "sid", percent)

    return both.select(*names, "edits").repartition("band", "mb", "fb").groupBy("band", "mb", "fb").applyInArrow(solve, "a binary, b binary").distinct()


def near_duplicates(
    docs: DataFrame,
    id_col: str = "doc_id",
    text_col: str = "text",
    shingle_words: int = 5,
    percent: int = 80,
    bands: int = BANDS,
    rows: int = ROWS,
) -> DataFrame:
    """``did, n_shingles, component_id, kept, tag`` for every row of ``docs``; ``tag`` is the text's digest."""
    named = docs.select(F.coalesce(F.col(id_col).cast("bigint"), F.lit(NO_ID)).alias("did"), text_digest(text_col).alias("tag"), F.col(text_col).alias("text"))
    docs = named.select(_key("did", "tag").alias("sid"), "text")
    signed = written(signatures(docs, shingle_words, bands, rows), "signatures").withColumnRenamed("sid", "own")
    # only digests of several rows are joined, from a written table: few are broadcast, a hot one can be split
    same = signed.where("n > 0").groupBy("digest").agg(F.min("own").alias("first"), F.count(F.lit(1)).alias("times")).where("times > 1")
    firsts = written(same.select("digest", "first"), "repeated-sets")
    named = signed.where("n > 0").join(firsts, "digest", "left").withColumn("sid", F.coalesce("first", "own"))
    members = named.where("own = sid").select("sid", "n", F.explode("bands").alias("band"))
    # bands of several sets are told by 64-bit hashes, since every set's bands move here; keys only move with those
    tag = F.xxhash64("sid")
    shared = members.groupBy("band").agg(F.min(tag).alias("least"), F.max(tag).alias("most")).where("least <> most")
    buckets = written(members.join(shared.select("band"), "band").distinct(), "buckets")
    sets = written(_full_sets(docs, buckets.select("sid").distinct(), shingle_words), "shingle-sets")

    firsts_of_bands = buckets.groupBy("band").agg(F.min("sid").alias("least"))
    centres = buckets.join(firsts_of_bands, "band").groupBy("sid").agg(F.min("least").alias("centre"), F.first("n").alias("n"))
    pairs = centres.where("sid <> centre").select(F.col("sid").alias("a"), F.col("centre").alias("b"))
    edits = written(_compared(pairs, sets), "edits")
    found = edits.where(_near(percent)).select("a", "b").unionByName(_links_by_centre(edits, percent, BLOCK_SETS))
    links = written(found, "links")
    parts = connected_components(links)

    # candidates of different centres that still lie in different components
    placed = centres.join(parts, centres["sid"] == parts["node"], "left").select("sid", "centre", F.coalesce("component", "sid").alias("part"))
    more = written(_links_between(buckets.select("band", "sid", "n").join(placed, "sid"), sets, percent), "more-links")
    if not more.isEmpty():
        parts = connected_components(links.unionByName(more))

    joined = named.join(parts, named["sid"] == parts["node"], "left").select("own", "n", F.coalesce("component", "sid").alias("component"))
    # documents without words meet no key of a join
    every = joined.unionByName(signed.where("n = 0").select("own", "n", F.col("own").alias("component")))
    component = F.col("component")
    return every.select(
        F.nullif(_id_of(F.col("own")), F.lit(NO_ID)).alias("did"),
        F.col("n").alias("n_shingles"),
        F.nullif(_id_of(component), F.lit(NO_ID)).alias("component_id"),
        (F.col("own") == component).alias("kept"),
        F.substring("own", 9, 16).alias("tag"),
    )

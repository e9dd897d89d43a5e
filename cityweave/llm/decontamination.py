"""Benchmark decontamination: word windows of test items found in training texts.

Texts are lower-cased in A-Z and cut into words; a window is ``width``
consecutive words of an item, or all words of a shorter item.  The windows of
all items form a hash set, sent to every task; a task scans the windows of its
documents, tests their hashes, and verifies each hit word by word.  Hit words
can be cut out as spans, or their documents dropped.

The set is broadcast with its words up to ``SET_BYTES`` (measured first): the
work is then map only, however often a passage occurs.  A larger set is
broadcast as a table of ``TABLE_BITS`` bits of its hashes, whose size does not
depend on the items; windows that pass it are verified by a join with the
items' windows, in which a passage that many documents share can be split, as
the items' side has one row a window.  Results are the same.

Defined results: null and empty texts have no words and no hits; null ids and
repeated rows keep a row each; an item without id is named by the empty text,
and items of one id count once; items without words have no windows; without
items nothing is hit; other columns are left out.
"""

from __future__ import annotations

import re

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from cityweave.llm.shared import map_batches, text_digest, texts_of, written

WIDTH = 10
SET_BYTES = 16 << 20
TABLE_BITS = 27
# Words as bytes: every byte of a character beyond ASCII is at least 0x80.
WORD = re.compile(rb"[0-9a-z\x80-\xff]+")
REMOVE = (None, "spans", "documents")


def words_of(text: bytes) -> list[bytes]:
    return WORD.findall(text.lower())  # bytes.lower() changes A-Z alone


def _factors(width: int) -> np.ndarray:
    return np.random.default_rng(10).integers(1, 1 << 63, width, np.uint64) * np.uint64(2) + np.uint64(1)


def hashes(codes: np.ndarray, n: int, factors: np.ndarray) -> np.ndarray:
    """Hash of every window of ``n`` word codes."""
    total = np.full(max(0, len(codes) - n + 1), n, np.uint64)
    for j in range(n):
        total += codes[j : len(codes) - n + 1 + j] * factors[j]
    return total


def word_codes(words: list[bytes]) -> np.ndarray:
    return np.fromiter(map(xxhash.xxh3_64_intdigest, words), np.uint64, len(words))


def item_windows(items: DataFrame, item_id: str, text: str, width: int) -> DataFrame:
    """Distinct ``item string, n int, words string, hash bigint``."""

    def make():
        factors = _factors(width)

        def cut(batch: pa.RecordBatch) -> pa.RecordBatch:
            rows: list[tuple] = []
            for item, text in zip(batch.column(0).to_pylist(), texts_of(batch.column(1)), strict=True):
                words = words_of(text)
                n = min(width, len(words))
                if n:
                    keys = hashes(word_codes(words), n, factors).view(np.int64).tolist()
                    rows += ((item, n, b" ".join(words[i : i + n]).decode(), k) for i, k in enumerate(keys))
            columns = list(zip(*rows, strict=True)) or [()] * 4
            kinds = (pa.string(), pa.int32(), pa.string(), pa.int64())
            return pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(columns, kinds, strict=True)], ["item", "n", "words", "hash"])

        return cut

    named = items.select(F.coalesce(F.col(item_id).cast("string"), F.lit("")).alias("item"), text)
    return map_batches(named, make, "item string, n int, words string, hash bigint").distinct()


class Scanner:
    """Hits of a batch's texts: windows whose hash is in the bit table."""

    def __init__(self, table: np.ndarray, sizes: list[int], width: int):
        self.table, self.sizes, self.factors = table, sizes, _factors(width)
        self.mask = np.uint64(len(table) * 8 - 1)

    def scan(self, texts: list[bytes]) -> tuple[list[list[bytes]], list[tuple[int, int, int]]]:
        """Words of each text, and ``(text, place, n)`` of windows that pass the table."""
        words = [words_of(t) for t in texts]
        counts = [len(w) for w in words]
        first = np.concatenate([[0], np.cumsum(counts)])
        owner = np.repeat(np.arange(len(texts)), counts)
        codes = np.concatenate([word_codes(w) for w in words]) if words else np.empty(0, np.uint64)
        found = []
        for n in self.sizes:
            if len(codes) < n:
                continue
            slot = hashes(codes, n, self.factors) & self.mask
            bit = self.table[slot >> np.uint64(3)] >> (slot & np.uint64(7)).astype(np.uint8) & 1
            for at in np.flatnonzero(bit.astype(bool) & (owner[: len(slot)] == owner[n - 1 :])).tolist():
                found.append((int(owner[at]), at - int(first[owner[at]]), n))
        return words, found


def _verdicts(ids: pa.Array, texts: list[bytes], words: list[list[bytes]], hits: list[tuple[int, int, int, tuple]], cut: bool) -> pa.RecordBatch:
    """Result rows of a batch from its verified hits ``(text, place, n, items)``."""
    by_text: dict[int, list[tuple]] = {}
    for row, at, n, items in hits:
        by_text.setdefault(row, []).append((at, n, items))
    n_hit, named, spans, kept = [], [], [], []
    for row, text in enumerate(texts):
        own = sorted(by_text.get(row, ()), key=lambda h: h[:2])
        runs: list[list[int]] = []
        for at, n, _ in own:
            if runs and at <= runs[-1][1]:
                runs[-1][1] = max(runs[-1][1], at + n)
            else:
                runs.append([at, at + n])
        places = [m.span() for m in WORD.finditer(text.lower())] if runs else []
        ranges = [(places[a][0], places[b - 1][1]) for a, b in runs]
        n_hit.append(sum(b - a for a, b in runs))
        named.append(sorted({i for _, _, items in own for i in items}))
        spans.append([{"start": a, "end": b} for a, b in ranges])
        if cut:
            ends = [0, *(b for _, b in ranges)]
            kept.append(b"".join(text[a:b] for a, b in zip(ends, [*(a for a, _ in ranges), len(text)], strict=True)).decode())
    span = pa.list_(pa.struct([("start", pa.int64()), ("end", pa.int64())]))
    columns = [ids, pa.array([len(w) for w in words], pa.int64()), pa.array(n_hit, pa.int64()), pa.array([len(x) for x in named], pa.int64())]
    columns += [pa.array(named, pa.list_(pa.string())), pa.array(spans, span)] + [pa.array(kept, pa.string())] * cut
    return pa.RecordBatch.from_arrays(columns, ["id", "n_words", "n_hit", "n_items", "items", "spans", "kept"][: len(columns)])


def _bit_table(windows: DataFrame, bits: int) -> np.ndarray:
    """Bits of the windows' hashes; at most ``2 ** bits / 64`` sums reach the driver."""
    slot = F.col("hash").bitwiseAND(F.lit((1 << bits) - 1))
    words = windows.groupBy(F.shiftright(slot, 6).alias("at")).agg(F.expr("bit_or(shiftleft(1L, cast(hash & 63 as int)))").alias("bits"))
    found, table = words.toArrow(), np.zeros(max(1, (1 << bits) // 64), np.int64)
    table[found["at"].to_numpy()] = found["bits"].to_numpy()
    return table.view(np.uint8)


def decontaminate(
    docs: DataFrame,
    items: DataFrame,
    id_col: str = "doc_id",
    text_col: str = "text",
    item_id: str = "item_id",
    item_text: str = "text",
    width: int = WIDTH,
    remove: str | None = None,
    set_bytes: int = SET_BYTES,
    table_bits: int = TABLE_BITS,
) -> DataFrame:
    """``id, n_words, n_hit, n_items, items, spans`` of every document.

    ``items`` are sorted as text; ``spans`` are the runs of hit words, in bytes
    of the UTF-8 text.  ``remove="spans"`` adds ``kept``, the text without
    them; ``remove="documents"`` leaves out documents with a hit.  The results
    don't depend on ``set_bytes`` and ``table_bits``.
    """
    if remove not in REMOVE:
        raise ValueError(f"remove must be one of {REMOVE}, got {remove!r}")
    cut = remove == "spans"
    spark = docs.sparkSession
    windows = written(item_windows(items, item_id, item_text, width), "windows")
    size = F.octet_length("words") + F.octet_length("item") + F.lit(64)
    count, total, sizes = windows.agg(F.count(F.lit(1)), F.sum(size), F.array_sort(F.collect_set("n"))).first()
    named = docs.select(F.col(id_col).alias("id"), F.col(text_col).alias("text"))
    kind = named.schema["id"].dataType.simpleString()
    schema = f"id {kind}, n_words bigint, n_hit bigint, n_items bigint, items array<string>, spans array<struct<start:bigint,end:bigint>>" + ", kept string" * cut
    if (total or 0) <= set_bytes:
        held: dict[bytes, tuple] = {}
        for w in windows.select("words", "item").toArrow().to_pylist():
            held[w["words"].encode()] = (*held.get(w["words"].encode(), ()), w["item"])
        bits = min(table_bits, max(6, (64 * count).bit_length()))
        known = spark.sparkContext.broadcast((_bit_table(windows, bits), held))

        def make():
            table, held = known.value
            scanner = Scanner(table, sizes, width)

            def mark(batch: pa.RecordBatch) -> pa.RecordBatch:
                texts = texts_of(batch.column(1))
                words, found = scanner.scan(texts)
                hits = [(row, at, n, items) for row, at, n in found if (items := held.get(b" ".join(words[row][at : at + n])))]
                return _verdicts(batch.column(0), texts, words, hits, cut)

            return mark

        rows = map_batches(named, make, schema)
    else:
        rows = _joined(named, windows, sizes, width, table_bits, schema, cut)
    return rows.where("n_hit = 0") if remove == "documents" else rows


def _joined(named: DataFrame, windows: DataFrame, sizes: list[int], width: int, bits: int, schema: str, cut: bool) -> DataFrame:
    """The same for a set of any size: hits of the bit table verified by a join."""
    table = named.sparkSession.sparkContext.broadcast(_bit_table(windows, bits))

    def make_scan():
        scanner = Scanner(table.value, sizes, width)

        def scan(batch: pa.RecordBatch) -> pa.RecordBatch:
            words, found = scanner.scan(texts_of(batch.column(1)))
            tags = batch.column(0).take(pa.array([row for row, _, _ in found], pa.int64()))
            rest = [pa.array(x, t) for x, t in (([at for _, at, _ in found], pa.int32()), ([n for _, _, n in found], pa.int32()))]
            keys = pa.array([b" ".join(words[row][at : at + n]).decode() for row, at, n in found], pa.string())
            return pa.RecordBatch.from_arrays([tags, *rest, keys], ["tag", "at", "n", "words"])

        return scan

    # equal texts have equal hits: each is scanned, verified and gathered once
    texts = named.select(text_digest("text").alias("tag"), "text").dropDuplicates(["tag"])
    found = map_batches(texts, make_scan, "tag binary, at int, n int, words string")
    held = windows.groupBy("words").agg(F.collect_list("item").alias("items"))
    hits = found.join(held, "words").groupBy("tag").agg(F.collect_list(F.struct("at", "n", "items")).alias("hits"))
    docs = named.withColumn("tag", F.when(F.col("text") != "", text_digest("text")))  # texts without words join nothing

    def make():
        def mark(batch: pa.RecordBatch) -> pa.RecordBatch:
            texts = texts_of(batch.column(1))
            hits = [(row, h["at"], h["n"], h["items"]) for row, own in enumerate(batch.column(2).to_pylist()) for h in own or ()]
            return _verdicts(batch.column(0), texts, [words_of(t) for t in texts], hits, cut)

        return mark

    return map_batches(docs.join(hits, "tag", "left").select("id", "text", "hits"), make, schema)

"""Compression classifier: zstandard dictionaries of good and bad text.

Two dictionaries are trained, on text that is labelled good and bad.  A text
is compressed in blocks with either; the normalised difference of the two
sizes, together with the sizes per byte (with either dictionary and with
none), goes through a logistic model, fitted on other labelled rows, which
calibrates the score.

Fitting uses a bounded sample of labelled rows: ``SAMPLE_ROWS`` of each class
by least hash of the id, halves of it for the dictionaries (one block of each
text) and for the calibration.  Scoring covers every row, in one pass without
a shuffle.

Defined results: null and empty texts get a score like any other; labels that
are null or not 0/1 are ignored, of several labels of a document the least
counts; without labelled rows of both classes the score is the share of label
1 (0.5 without any); null ids are never held out; repeated rows give repeated
rows; extra columns are not read.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
import zstandard
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from cityweave.llm.shared import map_batches, texts_of

SAMPLE_ROWS = 6000
DICTIONARY_BYTES = 112_640
LEVEL = 3
BLOCK = 2048  # bytes compressed at once when scoring
SAMPLE_BLOCK = 4096  # bytes of one text that a dictionary is trained on
RIDGE = 1e-3


def held_out(id_col: str = "doc_id") -> Column:
    """Rows that learning never sees: crc32 of the id's text mod 4 is 2."""
    return F.coalesce(F.crc32(F.col(id_col).cast("string").cast("binary")) % 4 == 2, F.lit(False))


def _compressor(dictionary: bytes | None) -> zstandard.ZstdCompressor:
    plain = dict(level=LEVEL, write_content_size=False, write_checksum=False, write_dict_id=False)
    if not dictionary:
        return zstandard.ZstdCompressor(**plain)
    data = zstandard.ZstdCompressionDict(dictionary)
    data.precompute_compress(level=LEVEL)
    return zstandard.ZstdCompressor(dict_data=data, **plain)


class Features:
    """Compressed-size features of texts under a pair of dictionaries."""

    def __init__(self, bad: bytes, good: bytes):
        self._parts = [_compressor(d) for d in (bad, good, None)]

    def __call__(self, text: bytes) -> np.ndarray:
        rows = []
        for at in range(0, max(1, len(text)), BLOCK):
            begin = max(0, min(at, len(text) - BLOCK))  # the last block is a full one too
            block = text[begin : begin + BLOCK]
            bad, good, none = (len(c.compress(block)) for c in self._parts)
            size = max(32, len(block))
            rows.append(((bad - good) / max(bad, good), good / size, none / size, bad / size))
        x = np.array(rows)
        flat = np.array([*x.mean(0), x[:, 0].min(), x[:, 1].min(), x[:, 2].min(), x[:, 1].max(), np.log1p(len(text))])
        return np.concatenate([flat, *[flat[i] * flat[i:] for i in range(len(flat))]])


class Logistic:
    """Ridge logistic regression by Newton steps, on standardised features."""

    def __init__(self, x: np.ndarray, y: np.ndarray, steps: int = 30):
        self.mean, self.scale = x.mean(0), x.std(0) + 1e-9
        z, self.w = self._design(x), np.zeros(x.shape[1] + 1)
        for _ in range(steps):
            p = self._sigmoid(z @ self.w)
            hessian = (z * (p * (1 - p) + 1e-6)[:, None]).T @ z / len(y) + RIDGE * np.eye(len(self.w))
            self.w -= np.linalg.solve(hessian, z.T @ (p - y) / len(y) + RIDGE * self.w)

    @staticmethod
    def _sigmoid(v: np.ndarray) -> np.ndarray:
        return 1 / (1 + np.exp(-np.clip(v, -30, 30)))

    def _design(self, x: np.ndarray) -> np.ndarray:
        return np.hstack([(x - self.mean) / self.scale, np.ones((len(x), 1))])

    def __call__(self, x: np.ndarray) -> np.ndarray:
        return self._sigmoid(self._design(x) @ self.w)


def _train_dictionary(blocks: list[bytes]) -> bytes:
    """A trained dictionary, or the blocks themselves where there are too few to train on."""
    try:
        return zstandard.train_dictionary(DICTIONARY_BYTES, blocks, level=LEVEL).as_bytes()
    except zstandard.ZstdError:
        return b"".join(blocks)[-DICTIONARY_BYTES:].ljust(8, b" ")


def fit(docs: DataFrame, labels: DataFrame, id_col: str, text_col: str, label_col: str, sample_rows: int = SAMPLE_ROWS):
    """``(bad dictionary, good dictionary, model)``, or the prior score where a class has too few rows."""
    known = (
        labels.where(F.col(label_col).isin(0, 1) & F.col(id_col).isNotNull() & ~held_out(id_col))
        .groupBy(F.col(id_col).alias("_id"))
        .agg(F.min(label_col).cast("int").alias("label"))
        .withColumn("h", F.xxhash64("_id", F.lit("fit")))
    )
    chosen = known.where("label = 0").orderBy("h", "_id").limit(sample_rows).unionByName(known.where("label = 1").orderBy("h", "_id").limit(sample_rows))
    texts = docs.select(F.col(id_col).alias("_id"), F.coalesce(F.col(text_col), F.lit("")).alias("text"))
    sample = texts.join(F.broadcast(chosen), "_id")  # at most 2 * sample_rows ids
    spread = F.lit(SAMPLE_BLOCK)
    begin = F.pmod(F.shiftright("h", 3), F.greatest(F.octet_length("text") - spread, F.lit(0)) + 1)
    block = F.substring(F.col("text").cast("binary"), (begin + 1).cast("int"), spread)
    own = (F.col("h") % 2) == 0
    rows = sample.where(own).select("label", block.alias("block")).collect()
    blocks = {q: [bytes(r["block"]) for r in rows if r["label"] == q and r["block"]] for q in (0, 1)}
    if min(map(len, blocks.values())) < 2:
        share = known.agg(F.avg("label")).first()[0]
        return None, None, 0.5 if share is None else float(share)
    bad, good = (_train_dictionary(sorted(blocks[q])) for q in (0, 1))

    def make():
        features = Features(bad, good)

        def measure(batch: pa.RecordBatch) -> pa.RecordBatch:
            x = [features(t).tolist() for t in texts_of(batch.column(1))]
            return pa.RecordBatch.from_arrays([batch.column(0), pa.array(x, pa.list_(pa.float64()))], ["label", "x"])

        return measure

    # only the features of at most 2 * sample_rows rows come to the driver
    measured = map_batches(sample.where(~own).select("label", "text"), make, "label int, x array<double>").collect()
    if len({r["label"] for r in measured}) < 2:
        return None, None, float(np.mean([r["label"] for r in measured])) if measured else 0.5
    measured.sort(key=lambda r: (r["label"], r["x"]))
    return bad, good, Logistic(np.array([r["x"] for r in measured]), np.array([r["label"] for r in measured], float))


def classify(
    docs: DataFrame, labels: DataFrame, id_col: str = "doc_id", text_col: str = "text", label_col: str = "quality", threshold: float = 0.7, keep: tuple[str, ...] = ()
) -> DataFrame:
    """``id_col, held_out, score, predicted`` (and the columns ``keep``) for every row of ``docs``."""
    bad, good, model = fit(docs, labels, id_col, text_col, label_col)
    rows = docs.select(F.col(text_col).alias("_text"), F.col(id_col), held_out(id_col).alias("held_out"), *keep)
    fields = rows.schema.fields[1:]
    schema = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in fields) + ", score double, predicted int"

    def make():
        features = None if bad is None else Features(bad, good)

        def score(batch: pa.RecordBatch) -> pa.RecordBatch:
            texts = texts_of(batch.column(0))
            s = np.full(len(texts), model) if features is None else model(np.array([features(t) for t in texts]))
            columns = [*batch.columns[1:], pa.array(s), pa.array((s >= threshold).astype(np.int32))]
            return pa.RecordBatch.from_arrays(columns, [*(f.name for f in fields), "score", "predicted"])

        return score

    return map_batches(rows, make, schema)

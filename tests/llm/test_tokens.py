"""Token operators against the tokenizers library on whole texts."""

import hashlib
import math
import random
import zlib

import numpy as np
import public_tokenizers
import pytest
from pyspark.sql import functions as F
from tokenizers import Tokenizer

from cityweave.llm import best_fit_packing, bpe_codec, token_counts, token_output
from cityweave.llm.tokens import ByteBpe, WordBpe, WordCache

from .cases import edge_rows, edge_table, sorted_rows

BYTE = public_tokenizers.path("byte_bpe_50k.json")
WORD = public_tokenizers.path("word_bpe_49k.json")


@pytest.fixture(scope="module")
def byte_ids():
    t = Tokenizer.from_file(BYTE)
    return lambda text: t.encode(text or "", add_special_tokens=False).ids


@pytest.fixture(scope="module")
def word_tok():
    return Tokenizer.from_file(WORD)


def _random_texts(alphabet: str, n: int, size: int) -> list[str]:
    rng = random.Random(3)
    return ["".join(rng.choice(alphabet) for _ in range(rng.randrange(size))) for _ in range(n)]


ODD = _random_texts("aAbzZ'sStdrevml\"..,!?_- \n\t1²½éÉßİŉǅª·×中á\xa0\x85\x1c<|>", 1500, 60)


def test_encoders_equal_the_library(byte_ids, word_tok):
    byte, word = (k(open(p, "rb").read()) for k, p in ((ByteBpe, BYTE), (WordBpe, WORD)))
    cache = WordCache(word)
    for text in ODD + ["<|startoftext|>a<|endoftext|>", "don't<|ENDOFTEXT|>"]:
        assert byte.encode(text).tolist() == byte_ids(text)
        expected = word_tok.encode(text, add_special_tokens=False).ids
        assert np.frombuffer(cache.encode(text.encode()), "<u4").tolist() == expected
        assert np.frombuffer(word.encode_text(text.encode()), "<u4").tolist() == expected


def test_every_token_is_reached_by_its_own_text():
    word = WordBpe(open(WORD, "rb").read())
    tokenizer = Tokenizer.from_file(WORD)
    rng = random.Random(1)
    for token in rng.sample(sorted(tokenizer.get_vocab(with_added_tokens=False)), 2000):
        if token.endswith("</w>") and token[:-4].isascii() and token[:-4].isalpha() and token[:-4].islower():
            assert word.encode_word(token[:-4].encode()) == [tokenizer.token_to_id(token)]


@pytest.mark.parametrize("chunk,overlap", [(128, 64), (500, 100), (4096, 512)])
def test_resync_equals_one_encoding(chunk, overlap, byte_ids):
    enc = ByteBpe(open(BYTE, "rb").read())
    for text in [*ODD[:300], *(r[1] or "" for r in edge_rows())]:
        text = (text * 4)[:20_000]
        assert token_counts.encode_resync(enc, text.encode(), chunk, overlap).tolist() == byte_ids(text)


def test_token_counts(spark, byte_ids):
    got = sorted_rows(token_counts.token_counts(edge_table(spark), BYTE, chunk_bytes=2000))
    want = [(i, len((t or "").encode()), n := len(byte_ids(t)), n > 1024) for i, t, *_ in edge_rows()]
    assert got == sorted(want, key=repr)


def test_codec_round_trip(spark, word_tok):
    docs = edge_table(spark)
    got = sorted_rows(bpe_codec.round_trip_digests(docs, WORD))
    want = []
    for i, t, *_ in edge_rows():
        ids = word_tok.encode(t or "", add_special_tokens=False).ids
        text = word_tok.decode(ids, skip_special_tokens=False)
        want.append((i, len(ids), hashlib.sha256(np.array(ids, "<u4").tobytes()).hexdigest(), hashlib.sha256(text.encode()).hexdigest()))
    assert got == sorted(want, key=repr)
    decoded = {(i, t) for i, t in sorted_rows(bpe_codec.decode(bpe_codec.encode(docs, WORD), WORD))}
    assert {(i, hashlib.sha256(t.encode()).hexdigest()) for i, t in decoded} == {(i, d) for i, _, _, d in want}


@pytest.mark.parametrize("encoding", ["dictionary", "delta"])
def test_token_files(spark, word_tok, encoding):
    rows = token_output.with_crc32(token_output.token_files(edge_table(spark), WORD, encoding=encoding)).collect()
    ids = {}
    for i, t, *_ in edge_rows():
        ids[i] = [*word_tok.encode(t or "", add_special_tokens=False).ids, 2]
    assert len(rows) == len(edge_rows())
    at = 0
    for r in sorted(rows, key=lambda r: (r["start"])):
        own = np.array(ids[r["id"]], "<u4")
        assert (r["start"], r["n_tokens"], r["ids_crc32"]) == (at, len(own), zlib.crc32(own.tobytes()))
        at += len(own)
    order = [r["id"] for r in sorted(rows, key=lambda r: r["start"])]
    assert order == sorted(order, key=lambda i: (i is not None, i or 0))


def test_token_files_spread_a_hot_id(spark, tmp_path):
    """A third of the rows under no id, and a third under one, lie in many partitions."""
    rows = [(None if i % 3 == 0 else 7 if i % 3 == 1 else i, f"text number {i} of them", "en", "s", 1) for i in range(600)]
    token_output.write_token_files(edge_table(spark, rows), str(tmp_path / "t"), WORD)
    files = spark.read.parquet(str(tmp_path / "t"))
    assert files.groupBy("part").count().agg(F.max("count")).first()[0] < 200
    got = token_output.read_token_files(spark, str(tmp_path / "t"), ("id", "start", "n_tokens")).orderBy("start").collect()
    assert [r["id"] for r in got] == sorted((r[0] for r in rows), key=lambda i: (i is not None, i or 0))
    assert all(a["start"] + a["n_tokens"] == b["start"] for a, b in zip(got, got[1:], strict=False))


def test_token_file_layout(spark, tmp_path):
    import pyarrow.parquet as pq

    for encoding, mark in (("dictionary", "RLE_DICTIONARY"), ("delta", "DELTA_BINARY_PACKED")):
        path = str(tmp_path / encoding)
        token_output.write_token_files(edge_table(spark), path, WORD, encoding=encoding)
        files = list((tmp_path / encoding).glob("*.parquet"))
        columns = {}
        for f in files:
            group = pq.ParquetFile(f).metadata.row_group(0)
            for c in range(group.num_columns):
                column = group.column(c)
                columns.setdefault(column.path_in_schema, []).append(column)
        ids = next(v for k, v in columns.items() if k.startswith("ids"))
        assert any(mark in c.encodings or "PLAIN_DICTIONARY" in c.encodings and encoding == "dictionary" for c in ids)
        assert all(c.has_column_index and c.has_offset_index for c in columns["n_tokens"])
    plan = token_output.read_token_files(spark, str(tmp_path / "delta"), ("id", "start", "n_tokens"))._jdf.queryExecution().toString()
    scan = plan[plan.index("Physical Plan") :]
    assert "ids" not in scan[scan.index("ReadSchema") :].split("\n")[0]


def _check_packing(rows, size):
    sequences = {}
    for r in rows:
        sequences.setdefault(r["sequence_id"], []).append((r["offset"], r["length"]))
    for parts in sequences.values():
        at = 0
        for offset, length in sorted(parts):
            assert offset == at
            at += length
        assert at <= size
    return sequences


def test_packing(spark, byte_ids):
    rows = best_fit_packing.packed(edge_table(spark), BYTE).collect()
    sequences = _check_packing(rows, 1024)
    ids = {i: [*byte_ids(t), 2] for i, t, *_ in edge_rows()}
    total = 0
    for r in rows:
        own = ids[r["id"]]
        part = np.array(own[r["start"] : r["start"] + r["length"]], "<u4")
        assert r["ids_crc32"] == zlib.crc32(part.tobytes()) and len(part) == r["length"]
        assert len(own) > 1024 or r["length"] == len(own)
        total += r["length"]
    assert total == sum(len(ids[i]) for i, *_ in edge_rows())
    assert len(sequences) <= math.ceil(total / 1024) + 1


@pytest.mark.parametrize("score", ["norm", "dot"])
def test_vector_capacities_hold(score):
    rng = np.random.default_rng(0)
    lengths = rng.integers(1, 257, 3000)
    sequence, offset = best_fit_packing.vector_best_fit(lengths, 256, 5, 20_000, score)
    for s in np.unique(sequence):
        own = lengths[sequence == s]
        assert own.sum() <= 256 and len(own) <= 5 and ((own**2).sum() <= 20_000 or len(own) == 1)
        assert sorted(offset[sequence == s]) == np.concatenate([[0], np.cumsum(own[np.argsort(offset[sequence == s])])[:-1]]).tolist()


@pytest.mark.parametrize("score", ["norm", "dot"])
@pytest.mark.parametrize(("docs", "cost"), [(64, 64 * 64), (3, 1500)])
def test_choice_is_that_of_an_exhaustive_search(score, docs, cost):
    size, weights = 64, np.array([1.0, 0.25, 0.25])
    scale = weights / np.array([size, docs, cost])
    for seed in range(10):
        lengths = np.random.default_rng(seed).integers(1, size + 1, 150)
        sequence, _ = best_fit_packing.vector_best_fit(lengths, size, docs, cost, score, tuple(weights))
        room: dict[int, np.ndarray] = {}
        for i in np.argsort(-lengths, kind="stable"):
            n = lengths[i]
            need = np.array([n, 1, n * n])
            points = {
                s: ((scale * (r - need)) ** 2).sum() if score == "norm" else -(scale**2 * need * r).sum()
                for s, r in room.items()
                if (r >= need).all() and (r > 0).all()
            }
            if points:
                assert points[sequence[i]] == pytest.approx(min(points.values()), abs=1e-12)
            else:
                assert sequence[i] not in room
            room[sequence[i]] = room.get(sequence[i], np.array([size, docs, cost])) - need


def test_best_fit_is_close_to_the_bound():
    lengths = np.random.default_rng(1).integers(1, 1025, 20_000)
    sequence, _ = best_fit_packing.vector_best_fit(lengths, 1024, 1024, 1024**2)
    assert len(np.unique(sequence)) <= 1.01 * lengths.sum() / 1024 + 1


def test_empty_tables(spark):
    none = edge_table(spark, [])
    assert token_counts.token_counts(none, BYTE).count() == 0
    assert bpe_codec.round_trip_digests(none, WORD).count() == 0
    assert token_output.with_crc32(token_output.token_files(none, WORD)).count() == 0
    assert best_fit_packing.packed(none, BYTE).count() == 0

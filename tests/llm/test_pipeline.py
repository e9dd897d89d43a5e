"""Every pipeline stage against a brute-force version on its own input."""

import math

import numpy as np
import public_tokenizers
import pytest
from tokenizers import Tokenizer

import corpus_pipeline
from cityweave.llm import quality_classifier
from cityweave.llm.shared import written

from .cases import edge_table
from .test_dedup import shingles
from .test_text_quality import brute_spans

SF = "/root/testdata/sf0.01"


def _key(i):
    return (i is not None, i or 0)


def _texts(df):
    return {(r["doc_id"], r["text"] or "") for r in df.collect()}


def _components(texts, k=5, percent=80):
    sets = {i: shingles(t, k) for i, t in texts}
    holders, root = {}, {i: i for i in sets}

    def find(x):
        while root[x] != x:
            x = root[x]
        return x

    for i in sorted(sets, key=_key):
        near = {j for s in sets[i] for j in holders.get(s, ())}
        for j in near:
            both = len(sets[i] & sets[j])
            if 100 * both >= percent * len(sets[i] | sets[j]):
                a, b = sorted((find(i), find(j)), key=_key)
                root[b] = a
        for s in sets[i]:
            holders.setdefault(s, []).append(i)
    return {i: find(i) for i in sets}


def _without_repeats(texts, width=100):
    seen, out = set(), {}
    for i, t in sorted(texts, key=lambda x: _key(x[0])):
        b = t.encode()
        gone = np.zeros(len(b) + 1, np.int8)
        for s in range(len(b) - width + 1):
            w = b[s : s + width]
            if w in seen:
                gone[s : s + width] = 1
            seen.add(w)
        step = np.diff(gone, prepend=0)
        kept, at = b"", 0
        for a, z in zip(np.flatnonzero(step == 1).tolist(), np.flatnonzero(step == -1).tolist(), strict=True):
            while a < z and b[a] & 0xC0 == 0x80:
                a += 1
            while a < z < len(b) and b[z] & 0xC0 == 0x80:
                z -= 1
            kept += b[at:a]
            at = max(at, z)
        kept += b[at:]
        out[i] = (kept.decode(), len(kept) < len(b))
    return out


@pytest.mark.parametrize("source", ["documents", "edges"])
def test_stages(spark, source):
    docs = spark.read.parquet(f"{SF}/documents.parquet") if source == "documents" else edge_table(spark)
    stages = dict(corpus_pipeline.STAGES)
    assert [s for s in stages] == ["quality_classifier", "minhash_dedup", "suffix_dedup", "secret_scan", "best_fit_packing"]

    good = written(stages["quality_classifier"](spark, docs, SF), "t1")
    assert good.columns == list(corpus_pipeline.COLUMNS)
    scored = quality_classifier.classify(docs, spark.read.parquet(f"{SF}/labels.parquet"), keep=("text",)).where("predicted = 1")
    assert _texts(good) == _texts(scored)
    if source == "edges":  # the later stages work on all the awkward rows
        good = written(docs.select(*corpus_pipeline.COLUMNS), "t1")

    before = _texts(good)
    unique = written(stages["minhash_dedup"](spark, good, SF), "t2")
    component = _components(before)
    assert sorted(_texts(unique), key=repr) == sorted(((i, t) for i, t in before if component[i] == i), key=repr)
    assert unique.count() == len(_texts(unique))

    before = _texts(unique)
    fresh = written(stages["suffix_dedup"](spark, unique, SF), "t3")
    want = {(i, t) for i, (t, cut) in _without_repeats(before).items() if t or not cut}
    assert _texts(fresh) == want
    assert all(r["n_chars"] == len(r["text"]) for r in fresh.collect())

    clean = written(stages["secret_scan"](spark, fresh, SF), "t4")
    assert clean.columns == list(corpus_pipeline.COLUMNS)
    texts = dict(_texts(clean))
    for i, t in _texts(fresh):
        assert not brute_spans(texts[i])
        assert (texts[i] == t) == (not brute_spans(t))

    rows = stages["best_fit_packing"](spark, clean, SF).collect()
    tokenizer = Tokenizer.from_file(public_tokenizers.path("byte_bpe_50k.json"))
    lengths = {i: len(tokenizer.encode(t, add_special_tokens=False).ids) + 1 for i, t in _texts(clean)}
    packed = {}
    for r in rows:
        packed[r["doc_id"]] = packed.get(r["doc_id"], 0) + r["length"]
    assert packed == lengths
    assert len({r["sequence_id"] for r in rows}) <= math.ceil(sum(lengths.values()) / 1024) * 1.02 + 2


def test_empty_documents(spark):
    docs = edge_table(spark, [])
    for _, stage in corpus_pipeline.STAGES:
        result = stage(spark, docs, SF)
        assert result.count() == 0
        docs = docs if "text" not in result.columns else result

"""Suffix dedup and MinHash near-dedup against brute force."""

import hashlib
import random

import numpy as np
import pytest
from pyspark.sql import functions as F

import corpus_pipeline
from cityweave.llm import minhash_dedup, queries, suffix_dedup
from cityweave.llm.components import connected_components
from cityweave.llm.shared import text_digest
from cityweave.llm.suffix_sort import GRAM, anchors, common_prefix, multikey_order

from .cases import edge_rows, edge_table, words


def brute_repeats(rows, width):
    """{(id, text): (n_bytes, n_removed, n_spans, kept)}; ids with one text each."""
    seen, out = set(), {}
    for i, t in sorted({(r[0], r[1] or "") for r in rows}, key=lambda x: (x[0] is not None, x[0] or 0)):
        b = t.encode()
        gone = np.zeros(len(b) + 1, np.int8)
        for s in range(len(b) - width + 1):
            if b[s : s + width] in seen:
                gone[s : s + width] = 1
            seen.add(b[s : s + width])
        kept = bytes(x for x, g in zip(b, gone, strict=False) if not g)
        out[i] = (len(b), len(b) - len(kept), int((np.diff(gone, prepend=0) == 1).sum()), kept)
    return out


def check_suffix(spark, rows, width=100, **options):
    want = brute_repeats(rows, width)
    got = suffix_dedup.suffix_dedup(edge_table(spark, rows), width=width, **options).collect()
    assert len(got) == len(rows)
    for r in got:
        assert (r["n_bytes"], r["n_removed"], r["n_spans"], bytes(r["kept"])) == want[r["did"]], r["did"]


def test_suffix_dedup_edges(spark):
    check_suffix(spark, edge_rows())


@pytest.mark.parametrize("seed", [1, 2, 3])
def test_suffix_dedup_random(spark, seed):
    rng = random.Random(seed)
    pool = ["".join(rng.choice("ab") for _ in range(rng.randint(30, 260))) for _ in range(12)]
    rows = []
    for i in range(60):
        text = "".join(rng.choice(pool) if rng.random() < 0.5 else "".join(rng.choice("abcdefgh") for _ in range(60)) for _ in range(6))
        rows.append((i * 3, text, "en", "s", 1))
    check_suffix(spark, rows)


def test_many_buckets_in_a_partition(spark, monkeypatch):
    """Buckets are solved one by one, also where a batch holds many or a bucket spans batches."""
    monkeypatch.setattr(suffix_dedup, "BUCKET_SUFFIXES", 3)
    rng = random.Random(21)
    pool = ["".join(rng.choice("abcd") for _ in range(rng.randint(100, 300))) for _ in range(15)]
    rows = [(i, " ".join(rng.choice(pool) for _ in range(4)) + f" {i}", "en", "s", 1) for i in range(80)]
    before = spark.conf.get("spark.sql.shuffle.partitions")
    try:
        spark.conf.set("spark.sql.shuffle.partitions", "2")
        check_suffix(spark, rows)
    finally:
        spark.conf.set("spark.sql.shuffle.partitions", before)


def test_suffix_classes_across_buckets(spark, monkeypatch):
    """A passage shared by all documents is cut by splitters many times over."""
    rng = random.Random(5)
    passage = "".join(rng.choice("abcdef") for _ in range(300))
    rows = [(i, "".join(rng.choice("xyz") for _ in range(rng.randint(0, 80))) + passage[rng.randint(0, 100) : rng.randint(180, 300)], "en", "s", 1) for i in range(200)]
    monkeypatch.setattr(suffix_dedup, "BUCKETS_PER_PARTITION", 40)
    check_suffix(spark, rows)


def test_splitters_of_one_giant_document(spark, monkeypatch):
    """The sample is bounded although one document, repeated in many rows, has nearly all anchors."""
    monkeypatch.setattr(suffix_dedup, "SPLITTERS_MAX", 100)
    sizes = []
    for i in range(12):  # whatever the hash of the giant document
        rows = [(i, chr(97 + i) * 20_000, "en", "s", 1)] * 3 + [(50, "short", "en", "s", 1)]
        docs = edge_table(spark, rows).select(F.col("doc_id").alias("did"), text_digest("text").alias("tag"), "text")
        side = docs.distinct().select("did", "tag", F.when(F.col("did") < 50, F.transform(F.sequence(F.lit(0), F.lit(19_000)), lambda p: p.cast("bigint") * 65536)).alias("at"))
        sizes.append(len(suffix_dedup._splitters(docs, side, 100, 10**6)))
    assert all(50 <= n <= 160 for n in sizes), sizes


def test_suffix_dedup_whole_characters(spark):
    got = suffix_dedup.suffix_dedup(edge_table(spark), whole_chars=True).collect()
    for r in got:
        bytes(r["kept"]).decode()


def test_suffix_dedup_several_texts_under_one_id(spark):
    """Texts under no id, or under one id, are documents of their own: what is cut of one stays in another."""
    rng = random.Random(11)
    fresh = lambda n: "".join(rng.choice("abcdefghijklmnop") for _ in range(n))
    passage = fresh(120)
    ids = [None] * 25 + [7] * 10 + [8, 9]
    rows = [(i, fresh(rng.randint(0, 300)) + passage + fresh(rng.randint(0, 300)), "en", "s", 1) for i in ids]
    rows += [(None, fresh(300) + passage, "en", "s", 1), (None, fresh(100) + passage + fresh(400), "en", "s", 1)]
    rows += [rows[3], rows[27], (7, rows[0][1], "en", "s", 1), (None, None, "en", "s", 1), (7, "", "en", "s", 1), (7, "x", "en", "s", 1)]
    seen, want = set(), {}
    key = lambda x: (x[0] is not None, x[0] or 0, hashlib.sha256(x[1].encode()).digest())
    for i, t in sorted({(r[0], r[1] or "") for r in rows}, key=key):
        gone = np.zeros(len(t) + 1, np.int8)
        for s in range(len(t) - 99):
            if t[s : s + 100] in seen:
                gone[s : s + 100] = 1
            seen.add(t[s : s + 100])
        want[i, t] = "".join(x for x, g in zip(t, gone, strict=False) if not g), int((np.diff(gone, prepend=0) == 1).sum())
    table = edge_table(spark, rows).withColumn("whole", F.coalesce("text", F.lit("")))
    got = suffix_dedup.suffix_dedup(table, carry=("whole",)).collect()
    assert len(got) == len(rows)
    for r in got:
        assert (bytes(r["kept"]).decode(), r["n_spans"]) == want[r["did"], r["carried"]["whole"]]


def test_suffix_dedup_empty_table(spark):
    assert suffix_dedup.suffix_dedup(edge_table(spark, [])).count() == 0


def test_every_window_has_one_anchor():
    rng = np.random.default_rng(0)
    data = rng.integers(97, 100, 5000).astype(np.uint8)
    ends = np.array([700, 701, 2500, 5000])
    _, at, first, last = anchors(data, ends, 100)
    windows = [s for p, a, b in zip(at, first, last, strict=True) for s in range(p - a, p - b + 1)]
    want = [s for a, b in zip([0, *ends], ends, strict=False) for s in range(a, b - 99)]
    assert windows == want
    assert all(0 <= b <= a <= 100 - GRAM for a, b in zip(first, last, strict=True))


def test_multikey_order():
    rng = np.random.default_rng(0)
    rows = rng.integers(0, 2, (2000, 21)).astype(np.uint8)
    rows[:500, :15] = 1
    order = multikey_order(rows)
    assert [bytes(rows[i]) for i in order] == sorted(map(bytes, rows))
    assert common_prefix(rows[:1], rows[:1])[0] == 21


def shingles(text, k):
    w = (text or "").encode().lower().split()
    return frozenset(zip(*(w[i:] for i in range(k)), strict=False)) if len(w) >= k else frozenset([tuple(w)] if w else [])


def check_near(spark, rows, k):
    sets = {r[0]: shingles(r[1], k) for r in rows}
    component = {i: i for i in sets}
    key = lambda i: -(1 << 63) if i is None else i
    changed = True
    while changed:
        changed = False
        for a in sets:
            for b in sets:
                both = len(sets[a] & sets[b])
                if both and 100 * both >= 80 * len(sets[a] | sets[b]) and key(component[b]) < key(component[a]):
                    component[a], changed = component[b], True
    got = minhash_dedup.near_duplicates(edge_table(spark, rows), shingle_words=k).collect()
    assert len(got) == len(rows)
    for r in got:
        assert (r["n_shingles"], r["component_id"], r["kept"]) == (len(sets[r["did"]]), component[r["did"]], component[r["did"]] == r["did"])


@pytest.mark.parametrize("k", [2, 5])
def test_near_duplicates_edges(spark, k):
    check_near(spark, edge_rows(), k)


def test_near_duplicates_chain(spark):
    """Each text is near the next one only; a star would not join them."""
    rng = random.Random(9)
    w = words(rng, 400)
    rows = [(1000 - i, " ".join(w[i * 8 : i * 8 + 100]), "en", "s", 1) for i in range(30)]
    check_near(spark, rows, 2)


def linked_components(sets, percent=80):
    """{id: least id reachable} by comparing all pairs once."""
    least = {i: i for i in sets}

    def find(i):
        while least[i] != i:
            i = least[i]
        return i

    ids = sorted(sets)
    for at, a in enumerate(ids):
        for b in ids[at + 1 :]:
            both = len(sets[a] & sets[b])
            if both and 100 * both >= percent * (len(sets[a]) + len(sets[b]) - both):
                x, y = find(a), find(b)
                least[max(x, y)] = min(x, y)
    return {i: find(i) for i in ids}


def test_many_sets_of_one_centre_and_many_empty_texts(spark):
    """More far sets of one centre than a block holds; a third of the texts without words."""
    rng = random.Random(31)
    base, places = words(rng, 200), list(range(5, 195, 3))
    rows = [(0, " ".join(base), "en", "s", 1)]
    for i in range(1, 1101):
        w, family = list(base), random.Random(i % 90)
        for at in family.sample(places, 12):
            w[at] = f"w{i % 90}x{at}"
        w[1] = f"own{i}"
        rows.append((i, " ".join(w), "en", "s", 1))
    rows += [(2000 + i, (None, "", " \n ")[i % 3], "en", "s", 1) for i in range(550)]
    want = linked_components({r[0]: shingles(r[1], 2) for r in rows})
    got = minhash_dedup.near_duplicates(edge_table(spark, rows), shingle_words=2).collect()
    assert {r["did"]: r["component_id"] for r in got} == want and len(got) == len(rows)
    assert 3 < len({c for i, c in want.items() if i < 2000}) < 200


@pytest.mark.parametrize("block_sets, block_shingles", [(4, 1 << 20), (1024, 300)])
def test_near_duplicates_in_small_blocks(spark, monkeypatch, block_sets, block_shingles):
    monkeypatch.setattr(minhash_dedup, "BLOCK_SETS", block_sets)
    monkeypatch.setattr(minhash_dedup, "BLOCK_SHINGLES", block_shingles)
    rng = random.Random(9)
    w = words(rng, 400)
    check_near(spark, [(1000 - i, " ".join(w[i * 8 : i * 8 + 100]), "en", "s", 1) for i in range(30)], 2)


@pytest.mark.parametrize("block_sets, block_shingles", [(1024, 1 << 20), (3, 1 << 20), (1024, 100)])
def test_links_between_centres(spark, monkeypatch, block_sets, block_shingles):
    """One band of sets with centres of their own: its links join what all pairs would."""
    monkeypatch.setattr(minhash_dedup, "BLOCK_SETS", block_sets)
    monkeypatch.setattr(minhash_dedup, "BLOCK_SHINGLES", block_shingles)
    rng = random.Random(4)
    sets = {}
    for i in range(40):
        low = 1000 * (i % 9)
        sets[i] = frozenset(low + k for k in range(40) if rng.random() < 0.93)
    key = lambda i: bytes([i])
    part = {i: 0 if i % 9 == 0 else i for i in sets}  # sets of one component in a band with others
    placed = spark.createDataFrame([(7, bytearray(key(i)), len(sets[i]), bytearray(key(i)), bytearray(key(part[i]))) for i in sets], "band bigint, sid binary, n bigint, centre binary, part binary")
    table = spark.createDataFrame([(bytearray(key(i)), sorted(sets[i])) for i in sets], "sid binary, shingles array<bigint>")
    links = minhash_dedup._links_between(placed, table, 80).collect()
    joined = dict(part)
    for _ in sets:
        for r in links:
            a, b = r["a"][0], r["b"][0]
            assert a % 9 == b % 9
            low = min(joined[a], joined[b])
            joined = {i: low if c in (joined[a], joined[b]) else c for i, c in joined.items()}
    want = linked_components(sets)
    for i in sets:  # sets that were one component before stay one
        if i % 9 == 0:
            want[i] = 0
    assert joined == want


def several_texts_rows():
    """Two texts and more under no id and under one id, with near copies under other ids."""
    rng = random.Random(12)
    texts = [words(rng, 100) for _ in range(9)]
    rows = [(None, " ".join(t), "en", "s", 1) for t in texts[:6]] + [(7, " ".join(t), "en", "s", 1) for t in texts[6:]]
    rows += [(50 + i, " ".join([*t, "tail"]), "en", "s", 1) for i, t in enumerate(texts)]
    rows += [(None, " ".join([*texts[0], "end"]), "en", "s", 1), (None, "  ".join(texts[1]), "en", "s", 1), (7, " ".join(texts[2]), "en", "s", 1)]
    return [*rows, rows[3], rows[7], (None, None, "en", "s", 1), (None, "", "en", "s", 1)], 9


def least_documents(rows, k):
    """{(id, text): least (id, text) of its component}, by id, then SHA-256 of the text."""
    key = lambda x: (x[0] is not None, x[0] or 0, hashlib.sha256(x[1].encode()).digest())
    sets = {(r[0], r[1] or ""): shingles(r[1], k) for r in rows}
    least = {d: d for d in sets}
    for _ in sets:
        for a in sets:
            for b in sets:
                both = len(sets[a] & sets[b])
                if both and 100 * both >= 80 * len(sets[a] | sets[b]):
                    least[a] = min(least[a], least[b], key=key)
    return least


def test_near_duplicates_several_texts_under_one_id(spark):
    rows, components = several_texts_rows()
    least = least_documents(rows, 2)
    assert len({d for d in least.values() if d[1]}) == components
    got = minhash_dedup.near_duplicates(edge_table(spark, rows), shingle_words=2).collect()
    assert len(got) == len(rows)
    tag = lambda t: hashlib.sha256(t.encode()).digest()[:16]
    want = {(i, tag(t)): (least[i, t][0], least[i, t] == (i, t)) for i, t in least}
    for r in got:
        assert (r["component_id"], r["kept"]) == want[r["did"], bytes(r["tag"])]


def test_kept_of_the_query_is_by_id(spark, tmp_path):
    """The query's ``kept`` says that the id is its component's, whichever of its texts the row holds."""
    edge_table(spark, several_texts_rows()[0]).write.parquet(f"{tmp_path}/documents.parquet")
    for r in queries.op6_minhash_dedup(spark, str(tmp_path)).collect():
        assert r["kept"] == (r["doc_id"] == r["component_id"])


def test_near_duplicate_stage_several_texts_under_one_id(spark):
    rows, _ = several_texts_rows()
    least = least_documents(rows, 5)
    got = corpus_pipeline.near_duplicate_stage(spark, edge_table(spark, rows), "").select("doc_id", "text").collect()
    want = sorted([d for d in least if least[d] == d] + [(None, None)], key=repr)  # null and empty text both stay
    assert sorted(((r["doc_id"], r["text"]) for r in got), key=repr) == want


def test_near_duplicates_empty_table(spark):
    assert minhash_dedup.near_duplicates(edge_table(spark, [])).count() == 0


def test_circulant_coordinates_estimate_similarity():
    rng = random.Random(2)
    w = words(rng, 4000)
    a, b = " ".join(w[:3000]).encode(), " ".join(w[300:3300]).encode()
    x, y = (minhash_dedup.shingle_hashes(t, 1) for t in (a, b))
    signs = minhash_dedup._band_hashes([x, y], 400, 1)
    true = len(np.intersect1d(x, y)) / len(np.union1d(x, y))
    assert abs((signs[0] == signs[1]).mean() - true) < 0.08


def test_components(spark):
    rng = random.Random(4)
    edges = [(rng.randrange(300), rng.randrange(300)) for _ in range(200)] + [(i, i + 1) for i in range(1000, 1040)] + [(5, 5), (None, 3)]
    parent = {}

    def find(x):
        parent.setdefault(x, x)
        while parent[x] != x:
            x = parent[x]
        return x

    for a, b in edges:
        if a is not None and a != b:
            x, y = find(a), find(b)
            parent[max(x, y)] = min(x, y)
    df = spark.createDataFrame(edges, "a bigint, b bigint")
    got = {r["node"]: r["component"] for r in connected_components(df).collect()}
    assert got == {x: find(x) for x in parent if find(x) != x}
    assert connected_components(df.where(F.lit(False))).count() == 0


def test_bands_of_several_sets_are_told_without_moving_keys(spark, monkeypatch):
    from cityweave.llm import minhash_dedup

    plans, keep = {}, minhash_dedup.written

    def seen(df, name):
        plans[name] = df._jdf.queryExecution().optimizedPlan().toString()
        return keep(df, name)

    monkeypatch.setattr(minhash_dedup, "written", seen)
    a, b = " ".join(f"w{i}" for i in range(60)), " ".join(f"v{i}" for i in range(60))
    docs = spark.createDataFrame([(4, a), (2, a + " end"), (9, a), (9, a), (7, b), (None, None)], "doc_id bigint, text string")
    got = sorted((r.did or 0, r.component_id or 0, r.kept) for r in minhash_dedup.near_duplicates(docs, shingle_words=2).collect())
    assert got == [(0, 0, True), (2, 2, True), (4, 2, False), (7, 7, True), (9, 2, False), (9, 2, False)]
    assert "min(sid" not in plans["buckets"] and "max(sid" not in plans["buckets"]

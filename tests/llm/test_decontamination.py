"""Benchmark decontamination against brute force."""

import random
import re

import pytest
from pyspark.sql import functions as F

from cityweave.llm import decontamination as dc

from .cases import EXTRA, edge_rows, edge_table, words

LOWER = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def split(text):
    return re.findall(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", (text or "").translate(LOWER))


def brute(texts, items, width=10):
    """[(n_words, n_hit, items)] of the texts."""
    windows = set()
    for i, t in items:
        w = split(t)
        n = min(width, len(w))
        windows |= {("" if i is None else str(i), tuple(w[k : k + n])) for k in range(len(w) - n + 1) if n}
    out = []
    for t in texts:
        w, hit, named = split(t), set(), set()
        for item, win in windows:
            for k in range(len(w) - len(win) + 1):
                if tuple(w[k : k + len(win)]) == win:
                    hit |= set(range(k, k + len(win)))
                    named.add(item)
        out.append((len(w), len(hit), sorted(named)))
    return out


def item_table(spark, items):
    return spark.createDataFrame(items, "item_id bigint, text string").withColumns({c: F.lit("x") for c in EXTRA})


def cases():
    rng = random.Random(3)
    long_item = " ".join(words(rng, 40))
    items = [(1, long_item), (1, "short one"), (2, " ".join(long_item.split()[5:25])), (None, "NAMELESS test-item 7"), (3, None), (4, "..."), (10, "Ünïcode ÉÉ 中文")]
    rows = [
        (1000 + i, t, "en", "s", 1)
        for i, t in enumerate([
            long_item.upper() + "!",
            " ".join(long_item.split()[3:14]),
            " ".join(long_item.split()[3:12]),
            "a short, ONE? shorter one short  one",
            "nameless\x00test item\n7 and nameless test item 70",
            "ünïcode éÉ 中文",
            "Ünïcode ÉÉ 中文",
            "x " * 30_000 + long_item + " y" * 30_000,
        ])
    ]
    rows += [(1100 + i, f"{i} {' '.join(long_item.split()[:15])} tail", "en", "hot", 1) for i in range(40)]
    rows += [(None, "short one", None, None, None)] * 3
    return rows + edge_rows(), items


@pytest.mark.parametrize("set_bytes, bits", [(1 << 20, 27), (0, 27), (0, 7)])
def test_against_brute_force(spark, set_bytes, bits):
    """A set that is broadcast whole, and bit tables with few and with very many false hits."""
    rows, items = cases()
    got = dc.decontaminate(edge_table(spark, rows), item_table(spark, items), set_bytes=set_bytes, table_bits=bits).collect()
    want = brute([r[1] for r in rows], items)
    assert sorted((r["id"], r["n_words"], r["n_hit"], r["items"], r["n_items"]) for r in got if r["id"] is not None) == sorted(
        (r[0], a, b, c, len(c)) for r, (a, b, c) in zip(rows, want, strict=True) if r[0] is not None
    )
    assert [r["n_hit"] for r in got if r["id"] is None].count(2) == 3
    assert sum(r["n_hit"] > 0 for r in got) > 45


@pytest.mark.parametrize("set_bytes", [1 << 20, 0])
def test_removal(spark, set_bytes):
    rows, items = cases()
    docs, tests = edge_table(spark, rows), item_table(spark, items)
    got = {r["id"]: r for r in dc.decontaminate(docs, tests, remove="spans", set_bytes=set_bytes).collect()}
    assert got[1000]["kept"] == "!" and got[1003]["kept"] == "a ? shorter one " and got[1002]["kept"] == rows[2][1]
    assert got[1006]["kept"] == "" and got[1007]["kept"] == "x " * 30_000 + " y" * 30_000
    assert not any(n for _, n, _ in brute([r["kept"] for r in got.values() if len(r["kept"]) < 5000], items))
    left = dc.decontaminate(docs, tests, remove="documents", set_bytes=set_bytes)
    assert {r["id"] for r in left.collect() if r["id"] is not None} == {i for i, r in got.items() if not r["n_hit"]} - {None}
    with pytest.raises(ValueError):
        dc.decontaminate(docs, tests, remove="all")


@pytest.mark.parametrize("set_bytes", [1 << 20, 0])
def test_empty_tables(spark, set_bytes):
    rows, items = cases()
    assert dc.decontaminate(edge_table(spark, rows).limit(0), item_table(spark, items), set_bytes=set_bytes).count() == 0
    none = dc.decontaminate(edge_table(spark, rows), item_table(spark, items).limit(0), set_bytes=set_bytes - 1)
    assert none.count() == len(rows) and none.where("n_hit > 0 or n_items > 0 or size(spans) > 0").count() == 0


def test_small_width(spark):
    rng = random.Random(9)
    texts = [" ".join(rng.choice("abc") for _ in range(rng.randint(0, 12))) for _ in range(60)]
    items = [(i, " ".join(rng.choice("abcd") for _ in range(rng.randint(0, 6)))) for i in range(12)]
    rows = [(i, t, "en", "s", 1) for i, t in enumerate(texts)]
    got = dc.decontaminate(edge_table(spark, rows), item_table(spark, items), width=3).collect()
    assert sorted((r["id"], r["n_words"], r["n_hit"], r["items"]) for r in got) == [(i, *w) for i, w in enumerate(brute(texts, items, 3))]

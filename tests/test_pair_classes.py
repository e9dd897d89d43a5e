"""Class rows stand for exactly the pairs of a full enumeration."""

import itertools
import random

import pytest

from cityweave.operators import pair_classes as pc
from tests.conftest import rows


def _data(seed):
    rng = random.Random(seed)
    subs = {(u, c) for u in range(40) for c in range(6) if rng.random() < 0.35}
    subs |= {(100 + u, c) for u in range(25) for c in (0, 3)}  # one large class
    contacts = {tuple(sorted(rng.sample(sorted({u for u, _ in subs}), 2))) for _ in range(120)} | {(5, 5)}
    return sorted(subs), sorted(contacts)


def _pairs(subs):
    by_channel = {}
    for u, c in subs:
        by_channel.setdefault(c, []).append(u)
    return {(c, a, b) for c, us in by_channel.items() for a, b in itertools.combinations(sorted(us), 2)}


def _frames(spark, subs, contacts):
    channels = spark.createDataFrame(subs + [(7, None), (999, None)], "user_id long, subscription_channel long")
    return channels, spark.createDataFrame(contacts, "user_left long, user_right long")


@pytest.mark.parametrize("seed", [1, 2])
def test_expansion_equals_enumeration(spark, seed):
    subs, contacts = _data(seed)
    channels, met = _frames(spark, subs, contacts)
    classes = pc.channel_classes(channels)
    table = pc.pairs_without_contact_classes(channels, met, classes).cache()
    want = _pairs(subs)
    listed = [tuple(r) for r in pc.expand(table, classes).collect()]
    assert len(listed) == len(want) and set(listed) == want
    inside = {(c, a, b) for c, a, b in want if (a, b) in set(contacts)}
    assert {tuple(r) for r in pc.contact_exceptions(channels, met).collect()} == inside
    got = table.groupBy("subscription_channel").agg({"pairs_within": "sum", "pairs_after": "sum", "free_within": "sum", "free_after": "sum"}).collect()
    for r in got:
        c = r["subscription_channel"]
        assert r["sum(pairs_within)"] + r["sum(pairs_after)"] == sum(p[0] == c for p in want)
        assert r["sum(free_within)"] + r["sum(free_after)"] == sum(p[0] == c for p in want - inside)
    assert table.count() < len(want) / 4  # rows are classes, not pairs


def test_classes_share_channel_sets(spark):
    channels, _ = _frames(spark, [(3, 1), (3, 2), (1, 2), (1, 1), (2, 1), (4, 12)], [(1, 2)])
    assert rows(pc.channel_classes(channels)) == [(1, 1), (2, 2), (3, 1), (4, 4)]


def test_empty(spark):
    channels, met = _frames(spark, [], [(1, 2)])
    classes = pc.channel_classes(channels)
    assert pc.pairs_without_contact_classes(channels, met, classes).count() == 0

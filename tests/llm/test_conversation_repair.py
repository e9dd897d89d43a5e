"""Conversation repair against brute force over all edits."""

import hashlib
import random
import re
import zlib

import pytest
from pyspark.sql import functions as F

from cityweave.llm import conversation_repair as cr

from .cases import EXTRA

SCHEMA = "conv_id bigint, turn bigint, role string, text string"
COLUMNS = ("conv_id", "gaps", "blank", "duplicate", "truncated", "illegal", "cost", "audit", "repaired_sha256")
NOT_BLANK = re.compile(r"[^\x20\x09-\x0D]")


def tag(text):
    return hashlib.sha256(text.encode()).digest()[:16]


def damage(rows):
    out = []
    for conv, turn, role, text in rows:
        k = zlib.crc32(f"{' ' if conv is None else conv}:{' ' if turn is None else turn}".encode()) % 20
        role, text = " " if role is None else role, " " if text is None else text
        text = "" if k == 1 else re.sub("[.!?]", "", text) if k == 2 else text
        out += [(conv, turn, "user" if k == 4 else role, text)] * (0 if k == 0 else 2 if k == 3 else 1)
    return out


def faults(turns):
    seen, out = set(), []
    for _, _, role, text in turns:
        shown = NOT_BLANK.findall(text)
        out.append("blank" if not shown else "duplicate" if (role, text) in seen else "truncated" if shown[-1] not in ".!?" else None)
        seen.add((role, text))
    return out


def cheapest(turns, kinds):
    """Least (cost, audit, repaired) by a search over tuples that knows nothing of digits."""
    legal = re.compile(r"(s?(ua)*(u)?)?\Z")
    paths = {"": (0, "", ())}  # roles so far, shortened to what matters: start, s, ...u, ...a

    def name(roles):
        return {"": "", "s": "s"}.get(roles, roles[-1] if roles else "")

    def push(new, roles, weight):
        key = name(roles)
        if key not in new or weight[:2] < new[key][:2]:
            new[key] = weight

    def inserted(paths):
        out = dict(paths)
        for _ in range(2):
            for key, (cost, audit, kept) in list(out.items()):
                for r in ("user", "assistant"):
                    if allowed(key, r):
                        push(out, (key + r[0])[-1] if key else r[0], (cost + 5, audit + "I", (*kept, (r, ""))))
        return out

    def allowed(key, role):
        return (role[:1], key) in {("s", ""), ("u", ""), ("u", "s"), ("u", "a"), ("a", "u")}

    for (_, _, role, text), kind in zip(turns, kinds, strict=True):
        new = {}
        for key, (cost, audit, kept) in inserted(paths).items():
            push(new, key, (cost + 2, audit + "D", kept))
            if kind in ("blank", "duplicate"):
                continue
            extra = 5 if kind else 0
            for letter, r, c in (("K", role, 0), ("R", "user", 1), ("R", "assistant", 1)):
                if allowed(key, r):
                    push(new, r[:1], (cost + c + extra, audit + letter, (*kept, (r, text))))
        paths = new
    assert legal
    return min((v for k, v in inserted(paths).items() if k in ("", "a")), key=lambda v: v[:2])


def brute(rows):
    by_conv = {r[0]: [] for r in rows}
    for r in damage(rows):
        by_conv[r[0]].append(r)
    out = []
    for conv, turns in by_conv.items():
        turns.sort(key=lambda r: (r[1] is not None, r[1] or 0, r[2], tag(r[3])))
        kinds = faults(turns)
        times = [t for _, t, _, _ in turns if t is not None]
        gaps = max(times) - min(times) + 1 - len(set(times)) if times else 0
        illegal = sum(a[2][:1] + b[2][:1] not in ("su", "ua", "au") for a, b in zip(turns, turns[1:], strict=False))
        cost, audit, kept = cheapest(turns, kinds)
        digest = hashlib.sha256("\n".join(f"{r}:{t}" for r, t in kept).encode()).hexdigest()
        out.append((conv, gaps, kinds.count("blank"), kinds.count("duplicate"), kinds.count("truncated"), illegal, cost, audit, digest))
    return sorted(out, key=repr)


def found(spark, rows):
    df = spark.createDataFrame(rows, SCHEMA).withColumns({c: F.lit("x") for c in (*EXTRA, "conv", "no", "edits")}).repartition(3)
    return sorted((tuple(r[c] for c in COLUMNS) for r in cr.repaired_conversations(df).collect()), key=repr)


def made(seed, convs, longest):
    rng = random.Random(seed)
    rows = []
    for c in range(convs):
        for t in range(rng.randint(0, longest)):
            role = rng.choice(["system", "user", "assistant", "user", "assistant", "tool", None, "ultra", ""])
            text = rng.choice(["Yes.", "Why?", "cut off", " ", "", None, "é!", "End.\n\t ", "One. two", f"No {t}.", f"More {t}!", "a ", ". "])
            rows.append((c, rng.choice([t, t, t, t + 3, t - 1, None]), role, text))
    return rows


@pytest.mark.parametrize("chunk", [256, 3])
def test_against_brute_force(spark, monkeypatch, chunk):
    monkeypatch.setattr(cr, "CHUNK", chunk)
    rows = made(1, 60, 9) + made(2, 5, 60)
    rows += [(None, None, None, None)] * 4 + [(None, t, "user", f"{t}.") for t in range(40)] + [(None, 3, "user", "3.")] * 9
    rows += [(900, -(1 << 40), "user", "Far away."), (900, 1 << 40, "assistant", "Far off.")]
    rows += [(901, 0, "user", "x" * 200_000 + " " * 50_000 + "."), (901, 1, "assistant", "?" + " " * 100_000)]
    assert found(spark, rows) == brute(rows)


def test_whole_conversations_dropped(spark):
    gone = [(c, t, "user", "Hi.") for c in range(3000, 3400) for t in (5,) if zlib.crc32(f"{c}:{t}".encode()) % 20 == 0]
    assert len(gone) > 5
    empty = hashlib.sha256(b"").hexdigest()
    assert found(spark, gone) == sorted(((r[0], 0, 0, 0, 0, 0, 0, "", empty) for r in gone), key=repr)


def test_empty_table(spark):
    assert found(spark, []) == []


def test_levels_of_chunks_agree(monkeypatch):
    """The same integers solve a long conversation in one piece and level by level."""
    rng = random.Random(8)
    steps = [cr.ROW_STEPS[rng.choice("sua") if rng.random() < 0.9 else "", rng.randrange(3)] for _ in range(400)]
    whole = cr.solve([*steps, cr.LAST_STEP], 6)
    least = min(whole[cr.START, s] for s in cr.DONE if (cr.START, s) in whole)
    want = least >> 6 * 401, cr.slots(least & (1 << 6 * 401) - 1, 401)
    monkeypatch.setattr(cr, "CHUNK", 5)
    solved = [cr.summary(cr.solve(steps[i : i + 5], 6), 30) for i in range(0, 400, 5)]
    cost, ranks = cr.chosen([*(s for s, _ in solved), {k: (c, 2 if d else 1) for k, (c, d) in cr.LAST_STEP.items()}])
    audit = "".join(cr.slots(a[r - 1], 5) for (_, a), r in zip(solved, ranks, strict=False))
    assert (cost, audit.replace(" ", "") + "I" * (ranks[-1] == 2)) == (want[0], want[1].replace(" ", "").rstrip("\0"))

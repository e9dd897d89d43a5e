"""Conversation structure repair by scalar big-integer weights.

A conversation is the sequence of its rows by turn (nulls first; rows of one
turn by role, then text digest, equal rows side by side).  The first of a
row's faults counts: blank, duplicate (role and text seen earlier), truncated
(no closing mark).  Edits turn the rows into ``(s?(ua)+)?``: Keep, Rerole to
user or assistant, Delete, Insert an empty user or assistant turn.

One integer decides everything.  An edit's weight is ``cost << width`` plus the
letters it writes, as digits at fixed places: two for each row (an Insert
before it, its own edit) in the order of the rows, ``D I K R`` as 1 to 4, and
zeros behind the letters, so a shorter list of edits comes first.  The least
sum over the paths of the acyclic graph (row, grammar state) has the least
cost and, of those, the ASCII-least audit; its low digits are the audit.  A
second Insert in one gap would only come back to a state that cost less.

Conversations of any length: the order (conversation, turn, role, digest) is
cut into ranges by rank, and a range into chunks of ``CHUNK`` rows.  A chunk's
graph is solved between all pairs of states; what the chunk's audit is worth
to its neighbours is its rank among the pairs, one digit, so chunks are solved
by the same integers as rows, level by level.  Only chunk summaries of a
conversation meet in one task.  Texts are named by 128 bits of their SHA-256;
they move once, to the rows that stay.

Defined results: null id, role and text count as one space where text is
compared, hashed or written; null ids are one conversation; repeated rows are
duplicates; a conversation without rows has zeros, an empty audit and the hash
of the empty text; other columns are left out; no rows give none.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.pandas.types import from_arrow_schema, to_arrow_type

from cityweave.llm.shared import small_batches, written

# Costs and marks of the repair.
REROLE, DELETE, INSERT, TRUNCATED = 1, 2, 5, 5
MARKS = "[.!?]"
ROLES = {"u": "user", "a": "assistant"}
LETTERS = "\0DIKR"  # digit of a letter: its place

CHUNK = 256
START, SYSTEM, USER, ASSISTANT = range(4)  # grammar states: nothing yet, or the role of the last turn
STATES = range(4)
NEXT = {("s", START): SYSTEM, ("u", START): USER, ("u", SYSTEM): USER, ("u", ASSISTANT): USER, ("a", USER): ASSISTANT}
DONE = (START, ASSISTANT)
MUST_GO, CUT_OFF, FINE = range(3)  # blank or duplicate, truncated, no fault

# A step is {(state before, state after): (cost, digit)}.
Step = dict[tuple[int, int], tuple[int, int]]
_ROW_BITS, _RANK_BITS = 6, 5


def _put(step: Step, key: tuple[int, int], weight: tuple[int, int]) -> None:
    step[key] = min(step.get(key, weight), weight)


def row_step(initial: str, fault: int) -> Step:
    """Edits of one row, with an Insert before it or not; its digit is two letters."""
    step: Step = {}
    gaps = {(s, s): (0, 0) for s in STATES}
    for role in ROLES:
        for s in STATES:
            if (role, s) in NEXT:
                gaps[s, NEXT[role, s]] = (INSERT, LETTERS.index("I"))
    stays = TRUNCATED if fault == CUT_OFF else 0
    for (a, b), (cost, before) in gaps.items():
        edits = [(b, DELETE, "D")]
        if fault != MUST_GO:
            edits += [(NEXT[initial, b], stays, "K")] if (initial, b) in NEXT else []
            edits += [(NEXT[r, b], REROLE + stays, "R") for r in ROLES if (r, b) in NEXT]
        for to, own, letter in edits:
            digit = LETTERS.index(letter)
            _put(step, (a, to), (cost + own, (before << 3 | digit) if before else digit << 3))
    return step


ROW_STEPS = {(initial, fault): row_step(initial, fault) for initial in ("s", "u", "a", "") for fault in (MUST_GO, CUT_OFF, FINE)}
LAST_STEP: Step = {(s, s): (0, 0) for s in STATES} | {(s, NEXT[r, s]): (INSERT, LETTERS.index("I") << 3) for r in ROLES for s in STATES if (r, s) in NEXT}


def solve(steps: list[Step], bits: int) -> dict[tuple[int, int], int]:
    """Least integer between every two states: the cost above, one digit of ``bits`` a step below."""
    width, out = bits * len(steps), {}
    for start in STATES:
        best = {start: 0}
        for place, step in enumerate(steps, 1):
            shift, new = width - bits * place, {}
            for (a, b), (cost, digit) in step.items():
                if a in best:
                    weight = best[a] + (cost << width) + (digit << shift)
                    if b not in new or weight < new[b]:
                        new[b] = weight
            best = new
        out |= {(start, to): w for to, w in best.items()}
    return out


def digits(weight: int, n: int, bits: int) -> list[int]:
    return [weight >> bits * (n - 1 - i) & (1 << bits) - 1 for i in range(n)]


def summary(weights: dict[tuple[int, int], int], width: int) -> tuple[Step, list[int]]:
    """The solved steps as one step, whose digit ranks the audits, and the audits by rank (from 1)."""
    audits = sorted({w & (1 << width) - 1 for w in weights.values()})
    rank = {a: r for r, a in enumerate(audits, 1)}
    return {k: (w >> width, rank[w & (1 << width) - 1]) for k, w in weights.items()}, audits


def chosen(steps: list[Step]) -> tuple[int, list[int]]:
    """Least cost of a whole conversation and the digit of each of its steps, level by level."""
    levels, below = [], steps
    while len(below) > CHUNK:
        parts = [below[i : i + CHUNK] for i in range(0, len(below), CHUNK)]
        solved = [summary(solve(p, _RANK_BITS), _RANK_BITS * len(p)) for p in parts]
        levels.append((parts, [audits for _, audits in solved]))
        below = [step for step, _ in solved]
    found = solve(below, _RANK_BITS)
    width = _RANK_BITS * len(below)
    least = min(found[START, s] for s in DONE if (START, s) in found)
    ranks = digits(least, len(below), _RANK_BITS)
    for parts, audits in reversed(levels):
        ranks = [d for part, own, r in zip(parts, audits, ranks, strict=True) for d in digits(own[r - 1], len(part), _RANK_BITS)]
    return least >> width, ranks


def slots(audit: int, n: int) -> str:
    """Two letters a row: the Insert before it (or a blank) and its own edit."""
    out = []
    for d in digits(audit, n, _ROW_BITS):
        first, second = LETTERS[d >> 3], LETTERS[d & 7]
        out.append(first + second if second != "\0" else " " + first)
    return "".join(out)


def damaged(conversations: DataFrame) -> DataFrame:
    """Rows after the drill's damage, by ``crc32(conv_id:turn) % 20``: ``conv, turn, role, text``."""
    spaced = lambda c: F.coalesce(F.col(c).cast("string"), F.lit(" "))
    kind = F.crc32(F.concat(spaced("conv_id"), F.lit(":"), spaced("turn")).cast("binary")) % 20
    role, text = spaced("role"), spaced("text")
    broken = F.when(kind == 1, F.lit("")).when(kind == 2, F.regexp_replace(text, MARKS, "")).otherwise(text)
    return conversations.where(kind != 0).select(
        F.col("conv_id").alias("conv"),
        F.col("turn").cast("bigint").alias("turn"),
        F.when(kind == 4, F.lit("user")).otherwise(role).alias("role"),
        broken.alias("text"),
        F.explode(F.when(kind == 3, F.array(F.lit(0), F.lit(1))).otherwise(F.array(F.lit(0)))).alias("copy"),
    ).drop("copy")


ORDER = ("conv", "turn", "role", "tag")
SPACE = " \t\n\x0b\x0c\r"


def distinct_turns(turns: DataFrame) -> DataFrame:
    """Distinct rows with their number, written: ``conv, turn, role, tag, text, n``; equal rows are counted where they are before they move."""
    tag = F.substring(F.unhex(F.sha2("text", 256)), 1, 16).alias("tag")
    return written(turns.select("conv", "turn", "role", tag, "text").groupBy(*ORDER).agg(F.max("text").alias("text"), F.count(F.lit(1)).alias("n")), "turns")


def with_faults(distinct: DataFrame) -> DataFrame:
    """``conv, turn, role, tag, n, fault``: the fault of a row's first copy."""
    first = distinct.groupBy("conv", "role", "tag").agg(F.min(F.struct(F.col("turn").isNotNull(), "turn")).alias("f"), F.count(F.lit(1)).alias("m"))
    first = first.where("m > 1").select(F.col("conv").alias("c"), F.col("role").alias("r"), F.col("tag").alias("t"), F.col("f.turn").alias("at"), F.lit(True).alias("again"))
    same = F.col("conv").eqNullSafe(F.col("c")) & (F.col("role") == F.col("r")) & (F.col("tag") == F.col("t"))
    shown = F.rtrim("text", F.lit(SPACE))
    seen = F.coalesce("again", F.lit(False)) & ~F.col("turn").eqNullSafe(F.col("at"))
    fault = F.when(F.col("blank"), F.lit("blank")).when(seen, F.lit("duplicate")).when(F.col("open"), F.lit("truncated"))
    marked = distinct.select(*ORDER, "n", (shown == "").alias("blank"), (~F.substring(shown, -1, 1).rlike(MARKS)).alias("open"))
    return marked.join(first, same, "left").select(*ORDER, "n", fault.alias("fault"))


class _Chunk:
    """Rows of one conversation that lie side by side in one range."""

    def __init__(self, conv, no: int):
        self.conv, self.no, self.initials = conv, no, ""
        self.steps: list[Step] = []
        self.counts = dict.fromkeys(("blank", "duplicate", "truncated", "illegal", "turns"), 0)
        self.least = self.most = None  # turns at both ends, without nulls

    def add(self, turn, role: str, fault: str | None) -> None:
        initial = role[:1] or "?"
        self.counts["illegal"] += bool(self.initials) and self.initials[-1] + initial not in ("su", "ua", "au")
        self.initials += initial
        if turn is not None:
            self.counts["turns"] += turn != self.most
            self.least, self.most = turn if self.least is None else self.least, turn
        if fault:
            self.counts[fault] += 1
        self.steps.append(ROW_STEPS[initial if initial in "sua" else "", {None: FINE, "truncated": CUT_OFF}.get(fault, MUST_GO)])

    def row(self) -> dict:
        step, audits = summary(solve(self.steps, _ROW_BITS), _ROW_BITS * len(self.steps))
        entries = [{"a": a, "b": b, "cost": c, "digit": d} for (a, b), (c, d) in step.items()]
        ends = {"initials": self.initials, "least": self.least, "most": self.most}
        return {"conv": self.conv, "no": self.no, **self.counts, **ends, "step": entries, "audits": [slots(x, len(self.steps)) for x in audits]}


def _chunk_type(conv: pa.DataType) -> pa.StructType:
    counts = [(c, pa.int64()) for c in ("blank", "duplicate", "truncated", "illegal", "turns")]
    entry = pa.struct([("a", pa.int32()), ("b", pa.int32()), ("cost", pa.int64()), ("digit", pa.int32())])
    ends = [("initials", pa.string()), ("least", pa.int64()), ("most", pa.int64())]
    return pa.struct([("conv", conv), ("no", pa.int64()), *counts, *ends, ("step", pa.list_(entry)), ("audits", pa.list_(pa.string()))])


PLACE_BITS = 40  # a chunk's number: its range above, its place in the range below


def chunks_of(rows: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Copies of the rows with their chunk (``no``) and place in it (``at``), and the solved chunks."""
    conv = to_arrow_type(rows.schema["conv"].dataType)
    row = pa.struct([("conv", conv), ("turn", pa.int64()), ("role", pa.string()), ("tag", pa.binary()), ("no", pa.int64()), ("at", pa.int32())])
    out = pa.schema([("row", row), ("chunk", _chunk_type(conv))])

    def tagged(placed: list[dict], ended: list[dict]) -> pa.RecordBatch:
        rows, chunks = pa.array([*placed, *[None] * len(ended)], out.field("row").type), pa.array([*[None] * len(placed), *ended], out.field("chunk").type)
        return pa.RecordBatch.from_arrays([rows, chunks], schema=out)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        chunk, number = None, 0
        for batch in batches:
            placed, ended = [], []
            for r in batch.to_pylist():
                for copy in range(r["n"]):
                    if chunk is None or chunk.conv != r["conv"] or len(chunk.steps) == CHUNK:
                        if chunk:
                            ended.append(chunk.row())
                        chunk, number = _Chunk(r["conv"], (r["part"] << PLACE_BITS) + number), number + 1
                    placed.append({k: r[k] for k in ORDER} | {"no": chunk.no, "at": len(chunk.steps)})
                    chunk.add(r["turn"], r["role"], r["fault"] if not copy or r["fault"] == "blank" else "duplicate")
                    if len(placed) == 10_000:
                        yield tagged(placed, ended)
                        placed, ended = [], []
            yield tagged(placed, ended)
        if chunk:
            yield tagged([], [chunk.row()])

    order = [F.col(c).asc_nulls_first() for c in ORDER]
    ranges = int(rows.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    ranged = rows.repartitionByRange(ranges, *order).sortWithinPartitions(*order).withColumn("part", F.spark_partition_id().cast("bigint"))
    both = written(ranged.mapInArrow(run, from_arrow_schema(out)), "chunks")
    return both.where("row is not null").select("row.*"), both.where("chunk is not null").select("chunk.*")


def _edits(state: int, initials: str, own: str) -> tuple[int, str]:
    """State after the rows, and two signs a row: the role inserted before it, and ``D``, ``K`` or the new role."""
    out = []
    for initial, before, edit in zip(initials, own[::2], own[1::2], strict=True):
        signs = [" ", edit]
        if before == "I":
            signs[0] = "a" if state == USER else "u"
            state = NEXT[signs[0], state]
        if edit == "R":
            signs[1] = "a" if state == USER else "u"
        if edit != "D":
            state = NEXT[initial if edit == "K" else signs[1], state]
        out += signs
    return state, "".join(out)


def decided(chunks: DataFrame) -> DataFrame:
    """Per chunk ``conv, no, edits`` (two signs a row) and ``tail`` (the role of an Insert at the end); a
    conversation's totals are on its first chunk (``head``)."""
    conv = to_arrow_type(chunks.schema["conv"].dataType)
    counts = ("gaps", "blank", "duplicate", "truncated", "illegal", "cost")
    head = pa.struct([*((c, pa.int64()) for c in counts), ("audit", pa.string())])
    out = pa.schema([("conv", conv), ("no", pa.int64()), ("edits", pa.string()), ("tail", pa.string()), ("head", head)])

    def merge(table: pa.Table) -> pa.Table:
        parts = sorted(table.to_pylist(), key=lambda p: p["no"])
        steps = [{(e["a"], e["b"]): (e["cost"], e["digit"]) for e in p["step"]} for p in parts]
        cost, ranks = chosen([*steps, {k: (c, 2 if d else 1) for k, (c, d) in LAST_STEP.items()}])
        lists = [p["audits"][r - 1] for p, r in zip(parts, ranks, strict=False)]
        totals = {c: sum(p[c] for p in parts) for c in counts[1:5]}
        totals["illegal"] += sum(p["initials"][-1] + q["initials"][0] not in ("su", "ua", "au") for p, q in zip(parts, parts[1:], strict=False))
        timed, gaps = [p for p in parts if p["most"] is not None], 0
        if timed:
            turns = sum(p["turns"] for p in timed) - sum(p["most"] == q["least"] for p, q in zip(timed, timed[1:], strict=False))
            gaps = min(timed[-1]["most"] - timed[0]["least"] + 1 - turns, (1 << 63) - 1)
        audit = "".join(lists).replace(" ", "") + "I" * (ranks[-1] == 2)
        rows, state = [], START
        for p, own in zip(parts, lists, strict=True):
            state, edits = _edits(state, p["initials"], own)
            rows.append({"conv": p["conv"], "no": p["no"], "edits": edits, "tail": None, "head": None})
        rows[0]["head"] = {"gaps": gaps, **totals, "cost": cost, "audit": audit}
        rows[-1]["tail"] = ("a" if state == USER else "u") if ranks[-1] == 2 else None
        return pa.Table.from_pylist(rows, schema=out)

    return written(chunks.groupBy("conv").applyInArrow(merge, from_arrow_schema(out)), "decided")


def _full(role: Column, own: Column) -> Column:
    return F.when(role == "u", F.lit(ROLES["u"])).when(role == "a", F.lit(ROLES["a"])).otherwise(own)


def repair(turns: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Totals ``conv, gaps, blank, duplicate, truncated, illegal, cost, audit`` and the repaired rows
    ``conv, no, at, role, text`` in the order of ``(no, at)``, of ``turns(conv, turn, role, text)``."""
    distinct = distinct_turns(turns)
    rows, chunks = chunks_of(with_faults(distinct))
    plans = decided(chunks)
    sign = lambda k: F.substring("edits", 2 * F.col("at") + k, F.lit(1))
    edited = rows.join(plans.select("no", "edits"), "no").withColumns({"before": sign(1), "own": sign(2)})
    stays = edited.where("own <> 'D'").alias("e")
    same = F.col("e.conv").eqNullSafe(F.col("d.conv")) & F.col("e.turn").eqNullSafe(F.col("d.turn"))
    same &= (F.col("e.role") == F.col("d.role")) & (F.col("e.tag") == F.col("d.tag"))
    place = lambda late: (F.col("at").cast("bigint") * 2 + late).alias("at")
    kept = stays.join(distinct.alias("d"), same).select("e.conv", "no", place(1), _full(F.col("own"), F.col("e.role")).alias("role"), "d.text")
    added = edited.where("before <> ' '").select("conv", "no", place(0), _full(F.col("before"), F.lit("")).alias("role"), F.lit("").alias("text"))
    tail = plans.where("tail is not null").select("conv", "no", F.lit(2 * CHUNK).cast("bigint").alias("at"), _full(F.col("tail"), F.lit("")).alias("role"), F.lit("").alias("text"))
    return plans.where("head is not null").select("conv", "head.*"), kept.unionByName(added).unionByName(tail)


def digests(repaired: DataFrame) -> DataFrame:
    """``conv, repaired_sha256`` of the newline-joined ``role:text`` of each conversation.

    A SHA-256 runs through its text from the first byte to the last, so a
    conversation passes one task; it passes as a stream, and only a batch of
    its sorted rows is held.
    """
    conv = to_arrow_type(repaired.schema["conv"].dataType)
    out = pa.schema([("conv", conv), ("repaired_sha256", pa.string())])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        conv, state = None, None
        for batch in batches:
            ended = []
            for r in batch.to_pylist():
                line = f"{r['role']}:{r['text']}".encode()
                if state is None or r["conv"] != conv:
                    if state is not None:
                        ended.append({"conv": conv, "repaired_sha256": state.hexdigest()})
                    conv, state = r["conv"], hashlib.sha256(line)
                else:
                    state.update(b"\n" + line)
            yield pa.RecordBatch.from_pylist(ended, schema=out)
        if state is not None:
            yield pa.RecordBatch.from_pylist([{"conv": conv, "repaired_sha256": state.hexdigest()}], schema=out)

    small_batches(repaired.sparkSession)
    return repaired.repartition("conv").sortWithinPartitions("conv", "no", "at").mapInArrow(run, from_arrow_schema(out))


def repaired_conversations(conversations: DataFrame) -> DataFrame:
    """Every original ``conv_id`` of the damaged conversations with its totals, audit and digest."""
    totals, rows = repair(damaged(conversations))
    ids = conversations.select(F.col("conv_id").alias("id")).distinct()
    hashed = digests(rows).withColumnRenamed("conv", "c")
    joined = ids.join(totals, F.col("id").eqNullSafe(F.col("conv")), "left").join(hashed, F.col("id").eqNullSafe(F.col("c")), "left")
    counts = [F.coalesce(c, F.lit(0)).cast("bigint").alias(c) for c in ("gaps", "blank", "duplicate", "truncated", "illegal", "cost")]
    empty = hashlib.sha256(b"").hexdigest()
    return joined.select(
        F.col("id").alias("conv_id"), *counts, F.coalesce("audit", F.lit("")).alias("audit"), F.coalesce("repaired_sha256", F.lit(empty)).alias("repaired_sha256")
    )

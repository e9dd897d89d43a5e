"""Quality rules with adaptive thresholds from mergeable quantile sketches.

Per document a few counts are taken (base rules), then ratios of them.  For
every (language, source) a KLL sketch of each ratio is aggregated over the
documents that pass the base rules (partial sketches merge map-side, so a hot
source costs no more than another).  A group's limit is the quantile ``level``
of its own sketch, drawn towards its language's and that towards all
documents' in proportion to ``PRIOR`` documents, so that small groups lean on
larger ones and nothing switches at a size.  The wider sketches are merged
from the group sketches, not from the rows.  No limit exceeds ``CAP`` times
the median group's, so a source that is dirty as a whole doesn't set its own
measure, however many rows it has.  A document fails if a ratio exceeds its
group's limit; ``LEAST`` only stands in where a limit is next to nothing, as
where nearly all ratios are 0.

Defined results: null or empty text has no words and fails the base rule;
null language or source is a group of its own; repeated rows count repeatedly;
extra columns are not read.  An empty table gives none.
"""

from __future__ import annotations

from collections import Counter
from dataclasses import dataclass

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from cityweave.llm.shared import map_batches, texts_of, written

# The symbols that are counted.
SYMBOLS = b"#*$%&|<>"
MIN_WORDS = 50
MAX_REPEAT_PERCENT = 50
SKETCH_K = 2048
LEVEL = 0.98  # a group's documents above this quantile of its ratio fail
PRIOR = 200  # documents that a wider sketch counts for in a narrower one's limit
CAP = 3.0  # limits in terms of the median group's
LEAST = 0.02  # one in fifty is never unusual
COUNTS = ("n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "n_lines")


@dataclass(frozen=True)
class Rule:
    """``over / under`` of the counts; values above the quantile ``level`` of a group fail."""

    name: str
    over: str
    under: str
    level: float = LEVEL


RULES = (
    Rule("symbols", "n_symbols", "word_chars"),
    Rule("dup_lines", "n_dup_lines", "n_lines"),
    Rule("repeats", "n_repeat_words", "n_words"),
)


def _repeat_words(words: list[bytes]) -> int:
    """Words inside 3-word windows that the text holds twice or more."""
    windows = list(zip(words, words[1:], words[2:], strict=False))
    if len(set(windows)) == len(windows):
        return 0
    times = Counter(windows)
    total, upto = 0, 0
    for i, w in enumerate(windows):
        if times[w] > 1:
            total += i + 3 - max(i, upto)
            upto = i + 3
    return total


def text_counts(text: bytes) -> tuple[int, ...]:
    """``COUNTS`` of one text."""
    words = text.split()  # of bytes: ASCII white space alone
    seen: set[bytes] = set()
    lines = dups = 0
    for line in text.split(b"\n"):
        if line.strip():
            lines += 1
            dups += line in seen
            seen.add(line)
    chars = len(b"".join(words).decode())
    return len(words), chars, sum(map(text.count, (SYMBOLS[i : i + 1] for i in range(len(SYMBOLS))))), dups, _repeat_words(words), lines


def counts(docs: DataFrame, id_col: str, text_col: str, group_cols: tuple[str, ...]) -> DataFrame:
    """``id, g0.., COUNTS`` for every row; no shuffle."""
    kind = docs.schema[id_col].dataType.simpleString()
    groups = [F.col(c).cast("string").alias(f"g{i}") for i, c in enumerate(group_cols)]

    names = ["id", *(f"g{i}" for i in range(len(groups))), *COUNTS]

    def make():
        def count(batch: pa.RecordBatch) -> pa.RecordBatch:
            rows = [text_counts(t) for t in texts_of(batch.column(1))]
            columns = [pa.array(x, pa.int64()) for x in zip(*rows, strict=True)]
            return pa.RecordBatch.from_arrays([batch.column(0), *batch.columns[2:], *columns], names)

        return count

    schema = f"id {kind}, " + ", ".join([*(f"g{i} string" for i in range(len(groups))), *(f"{c} bigint" for c in COUNTS)])
    return map_batches(docs.select(F.col(id_col).alias("id"), F.col(text_col).alias("text"), *groups), make, schema)


def _ratio(rule: Rule) -> Column:
    return F.col(rule.over) / F.greatest(F.col(rule.under), F.lit(1))


def base_failed() -> Column:
    return (F.col("n_words") < MIN_WORDS) | (F.col("n_repeat_words") * 100 > F.col("n_words") * MAX_REPEAT_PERCENT)


def thresholds(counted: DataFrame, n_groups: int = 2, rules: tuple[Rule, ...] = RULES, prior: float = PRIOR) -> DataFrame:
    """``g0.., limit_<rule>`` for each group of ``counted`` with a document that passes the base rules."""
    groups = [f"g{i}" for i in range(n_groups)]
    sketches = counted.where(~base_failed()).groupBy(*groups).agg(
        F.count(F.lit(1)).alias("n"), *[F.kll_sketch_agg_double(_ratio(r), F.lit(SKETCH_K)).alias(r.name) for r in rules]
    )
    sketches = written(sketches, "sketches")

    def merged(r: Rule) -> Column:
        return F.kll_merge_agg_double(r.name, F.lit(SKETCH_K))

    by_lang = [merged(r).alias(f"{r.name}_wide") for r in rules]
    wide = sketches.groupBy(F.col("g0").alias("g0_wide")).agg(F.sum("n").alias("n_wide"), *by_lang)
    joined = sketches.join(wide, F.col("g0").eqNullSafe(F.col("g0_wide")), "left")

    def limit(rule: Rule) -> Column:
        def q(sketch: Column) -> Column:
            return F.kll_sketch_get_quantile_double(sketch, F.lit(rule.level))

        def drawn(own: Column, n: str, wider: Column) -> Column:
            return (F.col(n) * own + F.lit(prior) * wider) / (F.col(n) + F.lit(prior))

        every = q(sketches.select(merged(rule)).scalar())  # one row, as the median
        median = sketches.select(F.percentile_approx(q(F.col(rule.name)), 0.5)).scalar()
        lang = drawn(q(F.col(f"{rule.name}_wide")), "n_wide", every)
        own = drawn(q(F.col(rule.name)), "n", lang)
        return F.greatest(F.lit(LEAST), F.least(own, F.lit(CAP) * median)).alias(f"limit_{rule.name}")

    return joined.select(*groups, *[limit(r) for r in rules])


def quality_rules(
    docs: DataFrame,
    id_col: str = "doc_id",
    text_col: str = "text",
    group_cols: tuple[str, ...] = ("lang", "source"),
    rules: tuple[Rule, ...] = RULES,
) -> DataFrame:
    """``id, COUNTS, base_failed, failed_rules, kept`` for every row of ``docs``."""
    counted = written(counts(docs, id_col, text_col, group_cols), "quality-counts")
    limits = thresholds(counted, len(group_cols), rules)
    for i in range(len(group_cols)):
        limits = limits.withColumnRenamed(f"g{i}", f"h{i}")
    same = [F.col(f"g{i}").eqNullSafe(F.col(f"h{i}")) for i in range(len(group_cols))]
    failed = F.filter(
        F.array(*[F.when(_ratio(r) > F.coalesce(f"limit_{r.name}", F.lit(float("inf"))), F.lit(r.name)) for r in rules]), F.isnotnull
    )
    rows = counted.join(limits, same, "left").select("id", *COUNTS, base_failed().alias("base_failed"), failed.alias("failed_rules"))
    return rows.withColumn("kept", ~F.col("base_failed") & (F.size("failed_rules") == 0))

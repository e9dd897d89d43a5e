"""Row counts of every stage of a job.

The reference counted each intermediate table with an action that computed it
again (11, 8 and 13 jobs a run).  Here a stage that is written anyway is
counted from its files' footers, which hold each part's rows: exact under task
retries and lost executors, and a stage that several steps read is counted
once.  Stages that list pairs are counted without listing them.  ``track``
wraps a stage that is never written in an ``Observation``.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Observation
from pyspark.sql import functions as F


class StageAudit:
    """Collects ``rows`` per named stage of one job run, in the order of the stages."""

    def __init__(self) -> None:
        self._counts: dict[str, int | Observation] = {}

    def written(self, name: str, table: DataFrame) -> DataFrame:
        """Count a table that was read back from files; only footers are read."""
        self._counts[name] = table.count()
        return table

    def put(self, name: str, rows: int | None) -> None:
        """Record a count that follows from other tables (None: an empty sum)."""
        self._counts[name] = int(rows or 0)

    def track(self, name: str, df: DataFrame) -> DataFrame:
        """Return ``df`` instrumented with a row counter named ``name``.

        Only wrap a DataFrame that appears once in the final plan (Spark
        refuses two metric nodes of the same name in one query).
        """
        obs = Observation(name)
        self._counts[name] = obs
        return df.observe(obs, F.count(F.lit(1)).alias("rows"))

    def counts(self) -> dict[str, int]:
        """Row counts of every stage (call after the action).

        A tracked stage that Spark left out of the plan because its input was
        empty reports no metric; it counts as 0 rows.
        """
        return {name: n if isinstance(n, int) else int(n.get.get("rows", 0)) for name, n in self._counts.items()}

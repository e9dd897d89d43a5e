"""Secret scans over an incremental blob ledger, in DataFrame functions only.

Every historical version of a path is content-addressed (SHA-256 of its
text).  The ledger holds one row for each (blob, rule, rule version) ever
scanned, findings or none; a run scans only the pairs that it lacks, each
distinct blob once, and joins the findings back to all paths with that blob.

The ledger is stored in batches, ``<ledger>/batch-<id>``.  A run writes its
batch beside them and renames it when it is whole, so a killed run leaves none
and the next one scans its pairs again; two runs at once may both add a pair,
which counts once.  Entries name content and rule version only, so they hold
for any table; a changed pattern needs a new version.

Spans come from two views of one regular expression: the matches, and the
texts between them.  A match starts where the texts and matches before it
end, a running sum over the blob's matches; no row-at-a-time code.

Defined results: null text counts as the empty blob; an empty blob has no
findings; repeated rows give repeated rows; null paths keep their findings;
extra columns are not read.  An empty table gives none.
"""

from __future__ import annotations

import uuid
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from cityweave.llm.shared import new_table_path, written


@dataclass(frozen=True)
class Rule:
    """A pattern whose matches count if ``group`` has at least ``least`` characters."""

    name: str
    pattern: str
    group: int = 0
    least: int = 1
    version: str = "1"


# The base rules.  A run of [0-9a-f] or [A-Z0-9] that is too short holds no
# longer one, so these two take their least length in the pattern.
BASE_RULES = (
    Rule("assign", r"""(?i)(password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""", 2, 8),
    Rule("access", r"AKIA[A-Z0-9]{12,}"),
    Rule("hex", r"[0-9a-f]{32,}"),
)

LEDGER = "digest string, rule string, version string, spans array<struct<start:bigint,end:bigint>>"


def _lengths(text: Column, rule: Rule) -> Column:
    """Per match: characters before it since the last one, of it, and of its group; null without a match."""
    pattern = F.lit(rule.pattern)
    between = F.transform(F.split(text, rule.pattern, -1), F.length)
    whole = F.transform(F.regexp_extract_all(text, pattern, F.lit(0)), F.length)
    if rule.group:
        part = F.transform(F.regexp_extract_all(text, pattern, F.lit(rule.group)), F.length)
    else:
        part = whole
    zipped = F.arrays_zip(F.slice(between, F.lit(1), F.size(whole)).alias("gap"), whole.alias("whole"), part.alias("part"))
    return F.when(text.rlike(rule.pattern), zipped)


def with_digest(versions: DataFrame, path_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``path, digest, text`` of every version; null text is the empty blob."""
    text = F.coalesce(F.col(text_col), F.lit(""))
    return versions.select(F.col(path_col).alias("path"), F.sha2(text, 256).alias("digest"), text.alias("text"))


def new_entries(versions: DataFrame, ledger: DataFrame | None = None, rules: tuple[Rule, ...] = BASE_RULES) -> DataFrame:
    """Ledger rows for the (blob, rule version) pairs of ``versions(digest, text)`` that ``ledger`` lacks."""
    blobs = versions.select("digest", "text").dropDuplicates(["digest"])
    wanted = F.array(*[F.lit(f"{r.name}@{r.version}") for r in rules])
    if ledger is None:
        blobs = blobs.withColumn("todo", wanted)
    else:
        seen = ledger.groupBy("digest").agg(F.collect_set(F.concat_ws("@", "rule", "version")).alias("seen"))
        todo = F.array_except(wanted, F.coalesce("seen", F.array().cast("array<string>")))
        blobs = blobs.join(seen, "digest", "left").withColumn("todo", todo).where(F.size("todo") > 0)
    scans = [
        F.struct(
            F.lit(r.name).alias("rule"),
            F.lit(r.version).alias("version"),
            F.lit(r.least).alias("least"),
            F.array_contains("todo", f"{r.name}@{r.version}").alias("due"),
            F.when(F.array_contains("todo", f"{r.name}@{r.version}"), _lengths(F.col("text"), r)).alias("matches"),
        )
        for r in rules
    ]
    pairs = blobs.select("digest", F.explode(F.array(*scans)).alias("s")).select("digest", "s.*").where("due")
    found = pairs.select("digest", "rule", "version", "least", F.posexplode_outer("matches").alias("at", "m"))
    so_far = Window.partitionBy("digest", "rule", "version").orderBy("at")
    end = F.sum(F.col("m.gap") + F.col("m.whole")).over(so_far)
    spans = found.select("digest", "rule", "version", "least", "m", end.alias("end"))
    span = F.struct((F.col("end") - F.col("m.whole")).cast("bigint").alias("start"), F.col("end").cast("bigint").alias("end"))
    return spans.groupBy("digest", "rule", "version").agg(
        F.sort_array(F.collect_list(F.when(F.col("m.part") >= F.col("least"), span))).alias("spans")
    )


LEDGER_CONF = "spark.cityweave.secretLedger"


def ledger_path(spark: SparkSession) -> str:
    """The ledger that the session names in ``LEDGER_CONF``; without one, a ledger of this call alone, which scans every blob."""
    return spark.conf.get(LEDGER_CONF, None) or new_table_path(spark, "secret-ledger")


def _hadoop(spark: SparkSession, path: str):
    p = spark._jvm.org.apache.hadoop.fs.Path(path)
    return p, p.getFileSystem(spark._jsc.hadoopConfiguration())


def read_ledger(spark: SparkSession, path: str) -> DataFrame | None:
    """Rows of the ledger's whole batches; None if there is none yet."""
    folder, files = _hadoop(spark, path)
    if not files.exists(folder):
        return None
    batches = [b.getPath().toString() for b in files.listStatus(folder) if b.getPath().getName().startswith("batch-")]
    return spark.read.schema(LEDGER).parquet(*batches) if batches else None


def append_entries(entries: DataFrame, path: str) -> None:
    """Add ``entries`` to the ledger as one batch, in one rename; no batch without entries."""
    spark = entries.sparkSession
    name = uuid.uuid4().hex
    entries.write.parquet(f"{path}/_new-{name}")
    staged, files = _hadoop(spark, f"{path}/_new-{name}")
    if spark.read.schema(LEDGER).parquet(staged.toString()).isEmpty():
        files.delete(staged, True)
    elif not files.rename(staged, _hadoop(spark, f"{path}/batch-{name}")[0]):
        raise OSError(f"batch of the ledger not added: {staged}")


def scan(versions: DataFrame, path: str, rules: tuple[Rule, ...] = BASE_RULES) -> DataFrame:
    """Scan the pairs of ``versions(digest, text)`` that the ledger at ``path`` lacks, add them, and return the ledger."""
    spark = versions.sparkSession
    append_entries(new_entries(versions, read_ledger(spark, path), rules), path)
    ledger = read_ledger(spark, path)
    return spark.createDataFrame([], LEDGER) if ledger is None else ledger


def findings_by_blob(ledger: DataFrame, rules: tuple[Rule, ...] = BASE_RULES) -> DataFrame:
    """``digest, findings`` of the blobs with any: spans by start, then rule order."""
    order = {r.name: i for i, r in enumerate(rules)}
    current = ledger.where(F.concat_ws("@", "rule", "version").isin([f"{r.name}@{r.version}" for r in rules]))
    rank = F.create_map(*[F.lit(x) for r in rules for x in (r.name, order[r.name])])[F.col("rule")]
    one = F.transform("spans", lambda s: F.struct(s["start"].alias("start"), rank.alias("rank"), s["end"].alias("end"), F.col("rule").alias("rule")))
    current = current.where(F.size("spans") > 0).dropDuplicates(["digest", "rule", "version"])
    return current.groupBy("digest").agg(F.sort_array(F.flatten(F.collect_list(one))).alias("findings"))


def findings(versions: DataFrame, ledger: DataFrame, rules: tuple[Rule, ...] = BASE_RULES) -> DataFrame:
    """``path, digest, findings`` for every version of ``versions(path, digest)``.

    The blobs with findings are written first, so that the join can broadcast
    them if they are few, and split a blob that very many paths share.
    """
    found = written(findings_by_blob(ledger, rules), "findings")
    return versions.select("path", "digest").join(found, "digest", "left").select("path", "digest", "findings")


def redacted(text: Column, spans: Column, mark: str = "[SECRET]") -> Column:
    """``text`` with its (sorted) findings replaced by ``mark``; overlapping ones are replaced together."""
    start = F.struct(F.lit("").alias("done"), F.lit(0).cast("bigint").alias("at"))

    def step(acc, s):
        gap = F.substring(text, (acc["at"] + 1).cast("int"), (s["start"] - acc["at"]).cast("int"))
        fresh = s["start"] >= acc["at"]
        done = F.when(fresh, F.concat(acc["done"], gap, F.lit(mark))).otherwise(acc["done"])
        return F.struct(done.alias("done"), F.greatest(acc["at"], s["end"]).alias("at"))

    folded = F.aggregate(spans, start, step)
    tail = F.substring(text, (folded["at"] + 1).cast("int"), F.length(text))
    return F.when(F.size(F.coalesce(spans, F.array())) > 0, F.concat(folded["done"], tail)).otherwise(text)

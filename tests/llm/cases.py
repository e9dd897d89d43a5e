"""Small tables with the awkward cases that every operator must handle."""

import random

from pyspark.sql import functions as F

# names that operators use inside, as extra columns that must not disturb them
EXTRA = ("did", "id", "n", "digest", "bands", "sid", "node", "component", "least", "at", "first", "text2", "part", "path", "score", "rank", "label", "bucket", "_id", "_text")
SCHEMA = "doc_id bigint, text string, lang string, source string, n_chars bigint"


def words(rng: random.Random, n: int) -> list[str]:
    return ["".join(rng.choice("abcdefghiklmnorstuw") for _ in range(rng.randint(2, 9))) for _ in range(n)]


def edge_rows() -> list[tuple]:
    rng = random.Random(7)
    passage = " ".join(words(rng, 40))
    base = " ".join(words(rng, 120))
    near = base.replace(" ", "  ", 3) + " tail"
    odd = "Don't <|endoftext|> Σίσυφος ΟΔΟΣ İ \x00\x1c é ́ 中文字符，没有 123४५ 😀👩‍👧\r\n\t " * 30
    rows = [
        (None, "a text under no id", "en", None, 1),
        (1, None, None, None, None),
        (2, "", "en", "s", 0),
        (3, "x", "en", "s", 1),
        (4, " \n\t ", "en", "s", 4),
        (5, base, "en", "s", 9),
        (6, base, "en", "s", 9),
        (6, base, "en", "s", 9),
        (7, near, "de", "s", 9),
        (8, odd, None, "s", 9),
        (9, "z" * 40_000, "en", "s", 9),
        (10, " ".join(words(rng, 30_000)), "en", "s", 9),
        (11, passage + " " + " ".join(words(rng, 30)) + " " + passage, "fr", "s", 9),
        (-12, " ".join(words(rng, 20)) + "\n" + passage, "fr", "s", 9),
        (13, "中" * 9000 + "é" * 100 + "中" * 50, "zh", "s", 9),
        (14, "same line\n" * 60, "en", "s", 9),
        (15, "é" * 51 + " " + "é" * 50 + "ü", "en", "s", 9),
    ]
    rows += [(100 + i, f"{passage} {' '.join(words(rng, 25))}", "en", "hot", 9) for i in range(30)]
    rows += [(200 + i, base + f" v{i}", "en", "hot", 9) for i in range(30)]
    return rows


def edge_table(spark, rows=None):
    df = spark.createDataFrame(edge_rows() if rows is None else rows, SCHEMA)
    return df.withColumns({c: F.lit("extra") for c in EXTRA}).repartition(3)


def sorted_rows(df):
    return sorted((tuple(r) for r in df.collect()), key=repr)

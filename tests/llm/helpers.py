"""Small tables with every odd case: nulls, empty and very long texts, ties,
repeated rows, clashing column names."""

import re

WORD = re.compile(r"[^\x20\x09-\x0D]+")
LOWER = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")

PROSE = ("the river ran slowly past old stone houses while children played near the wooden "
         "bridge and watched small boats drift toward the quiet harbour at dusk").split()


def prose(n, start=0):
    return " ".join(PROSE[(start + 7 * i + i * i // 3) % len(PROSE)] + str((start * 31 + i) % 97)
                    for i in range(n))


def odd_documents(spark):
    """doc_id, text, lang, source, n_chars, and columns that clash with outputs."""
    base = prose(60)
    rows = [(1, base, "en", "a", 1), (2, base, "en", "b", 1), (2, base, "en", "b", 1),
            (3, None, None, None, None), (4, "", "en", "a", 0), (5, " \t\n ", "en", None, 3),
            (None, "one two", "en", "", 7), (None, None, None, None, None),
            (6, prose(60, 5) + " tail", "de", "a", 9), (7, prose(30000, 3), "en", "a", 9),
            (8, "x" * 200_000, "en", "c", 9), (9, "One TWO", "en", "c", 7),
            (10, base.replace("river", "stream"), "en", "a", 1),
            (11, "naïve café   ½ Σας 中文 <|endoftext|> it's", "fr", "c", 5)]
    schema = "doc_id long, text string, lang string, source string, n_chars long"
    df = spark.createDataFrame(rows, schema)
    from pyspark.sql import functions as F
    for name in ("size", "key", "shard", "slot", "kept", "score", "ids", "token", "set_id",
                 "component", "a.b", "c0", "first", "host", "path"):
        df = df.withColumn(name, F.lit("clash"))
    return df


def empty(spark, schema):
    return spark.createDataFrame([], schema)

"""Run in its own process: queries with tasks that fail on their first attempt
(Spark retries them); prints one JSON line with the outcomes."""

import json
import os
import sys

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.dirname(os.path.abspath(__file__)))))

from pyspark import TaskContext  # noqa: E402
from pyspark.sql import SparkSession  # noqa: E402
from pyspark.sql import functions as F  # noqa: E402

from tidylake.operators import joins  # noqa: E402
from tidylake.plans import acceptance  # noqa: E402
from tidylake.session import configure  # noqa: E402
from tidylake.sources import html_tables  # noqa: E402
from tools.oracle_check import canon, compare, duck  # noqa: E402

TABLE_DIR = sys.argv[1]
MARKS = sys.argv[2]  # a marker file per injected failure


def flaky(fn, tag):
    """Fail the first attempt of every even partition, then behave."""
    def wrapped(*args, **kwargs):
        ctx = TaskContext.get()
        if ctx is not None and ctx.attemptNumber() == 0 and ctx.partitionId() % 2 == 0:
            open(os.path.join(MARKS, f"{tag}-{ctx.stageId()}-{ctx.partitionId()}"), "w").close()
            raise RuntimeError("injected task failure")
        return fn(*args, **kwargs)
    return wrapped


def main():
    spark = (SparkSession.builder.master("local[2,4]").appName("retry")
             .config("spark.ui.enabled", "false")
             .config("spark.sql.shuffle.partitions", "4").getOrCreate())
    spark.sparkContext.setLogLevel("OFF")
    configure(spark)
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    con = duck(TABLE_DIR)
    out = {}

    # 1) failure inside the Python HTML parse
    original = html_tables.parse_tables
    html_tables.parse_tables = flaky(original, "html")
    try:
        ok, n, m, _, _ = compare(spark, TABLE_DIR, "html_table_extract",
                                 acceptance.html_table_extract,
                                 acceptance.ORACLE_SQL["html_table_extract"], con)
        out["html_table_extract"] = [ok, n, m]
    finally:
        html_tables.parse_tables = original

    # 2) failure downstream of salted shuffle joins (large-table plan)
    joins.DEFAULT_MAX_BROADCAST_ROWS = 100
    df = acceptance.gold_enriched(spark, TABLE_DIR)

    def identity(batches):
        for b in batches:
            yield b

    failing = df.mapInPandas(flaky(identity, "join"), df.schema)
    got = canon([tuple(r) for r in failing.collect()], failing.columns)
    res = con.execute(acceptance.ORACLE_SQL["gold_enriched"])
    want = canon(res.fetchall(), [c[0] for c in res.description])
    out["gold_enriched_shuffle"] = [got == want, len(got), len(want)]
    print(json.dumps(out))


if __name__ == "__main__":
    main()

import os
import sys

import pytest

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

from jobmart.schemas import RAW_POSTING  # noqa: E402

SF001 = "/root/testdata/sf0.001"


@pytest.fixture(scope="session")
def spark():
    from pyspark.sql import SparkSession
    from jobmart.session import ensure_checkpoint_dir
    s = (SparkSession.builder.master("local[4]")
         .config("spark.sql.shuffle.partitions", "8")
         .config("spark.ui.enabled", "false")
         .config("spark.sql.session.timeZone", "UTC")
         .getOrCreate())
    s.sparkContext.setLogLevel("ERROR")
    ensure_checkpoint_dir(s)
    yield s


def raw_df(spark, rows):
    """Raw postings from dicts; missing keys are NULL, ingest_seq = list order."""
    names = [f.name for f in RAW_POSTING.fields]
    data = []
    for i, r in enumerate(rows):
        d = {"ingest_seq": i, **r}
        data.append(tuple(d.get(n) for n in names))
    return spark.createDataFrame(data, RAW_POSTING)


def shuffled(df):
    """(column names, rows) of every exchange in a finished adaptive plan."""
    found, todo = [], [df._jdf.queryExecution().executedPlan().executedPlan()]
    while todo:
        node = todo.pop()
        if node.nodeName() in ("Exchange", "BroadcastExchange"):
            m = node.metrics()
            names = [node.output().apply(i).name() for i in range(node.output().size())]
            found.append((names, m.apply("shuffleRecordsWritten" if m.contains("shuffleRecordsWritten") else "numOutputRows").value()))
        kids = node.children()
        todo += [kids.apply(i) for i in range(kids.size())]
        if "QueryStage" in node.nodeName():
            todo.append(node.plan())
    return found

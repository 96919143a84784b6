from __future__ import annotations

from endmark.operators.aggregates import read_end_counts
from endmark.streaming import evidence


def test_stream_equals_batch(spark, tmp_path):
    source, out, state = (str(tmp_path / x) for x in ("in", "out", "state"))
    first = spark.createDataFrame([("S", "c", "+", k % 5, "read_3p", k % 2 == 0) for k in range(40)], evidence.SCHEMA)
    second = spark.createDataFrame([("S", "c", "-", k % 3, "read_3p", False) for k in range(9)] + [("S", "c", "+", 0, "read_3p", True)], evidence.SCHEMA)
    for part in (first, second):
        part.write.mode("append").parquet(source)
        evidence.counted(evidence.read_end_stream(spark, source), out, state).awaitTermination(60)
    want = read_end_counts(first.union(second))
    assert sorted(map(tuple, evidence.total(spark, out).collect())) == sorted(map(tuple, want.collect()))

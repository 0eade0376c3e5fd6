"""Rules of uniqueness against counting by hand: nulls, ties of bits, several keys, a key with half of all rows."""

import random
from collections import Counter

import pytest
from pyspark.sql import functions as F

from busmill.operators import rules

SCHEMA = "id long, a string, b double, c int"


def table_of(seed, n=600):
    rng = random.Random(seed)
    some = lambda values: rng.choice(values)
    return [(k, some([None, "hot", "hot", f"v{rng.randrange(n)}"]), some([None, 0.0, -0.0, float("nan"), float(rng.randrange(n))]), some([None, 1, rng.randrange(n)])) for k in range(n)]


def value(x):
    return "nan" if x != x else x + 0.0 if isinstance(x, float) else x


def repeats(rows, columns):
    keys = [tuple(value(r[c]) for c in columns) for r in rows]
    n = Counter(k for k in keys if None not in k)
    return {r[0] for r, k in zip(rows, keys, strict=True) if n[k] > 1}


@pytest.mark.parametrize("cells", [64, rules.CELLS])
def test_marks_equal_counts(spark, cells):
    for seed in range(3):
        rows = table_of(seed)
        keys = [["a"], ["b"], ["a", "c"], ["a", "b", "c"]]
        out = rules.with_repeats(spark.createDataFrame(rows, SCHEMA), keys, cells).collect()
        assert sorted(r.id for r in out) == list(range(len(rows)))
        for columns in keys:
            mark = f"_repeated {','.join(columns)}"
            assert {r.id for r in out if r[mark]} == repeats(rows, ["id a b c".split().index(c) for c in columns])


def test_several_rules_and_their_summary(spark):
    rows = table_of(7)
    suite = [
        {"type": "expect_column_values_to_be_unique", "kwargs": {"column": "a"}},
        {"type": "expect_compound_columns_to_be_unique", "kwargs": {"column_list": ["b", "c"]}},
        {"type": "expect_column_values_to_not_be_null", "kwargs": {"column": "c"}},
    ]
    df = spark.createDataFrame(rows, SCHEMA)
    out = rules.validate(df, suite, F.lit(0))
    a, bc, null = repeats(rows, [1]), repeats(rows, [2, 3]), {r[0] for r in rows if r[3] is None}
    assert out.valid.columns == df.columns and out.invalid.columns == [*df.columns, "invalid_reason", "validation_failed_at"]
    assert {r.id for r in out.valid.collect()} == set(range(len(rows))) - (a | bc | null)
    assert {r.id for r in out.invalid.collect()} == a | bc | null
    told = {r.rule.partition(":")[2]: r.failures for r in out.summary.first().violation_reasons}
    assert told == {"a": len(a), "b,c": len(bc), "c": len(null)}
    empty = rules.validate(df.limit(0), suite, F.lit(0))
    assert empty.valid.count() == empty.invalid.count() == 0 and empty.summary.first().rows_failed == 0


def test_a_frequent_key_is_split(spark):
    """Half of all rows have one key: no window, and no task of the join holds them all."""
    settings = {"spark.sql.autoBroadcastJoinThreshold": "-1", "spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes": "64KB", "spark.sql.adaptive.advisoryPartitionSizeInBytes": "64KB",
                "spark.sql.adaptive.skewJoin.skewedPartitionFactor": "2", "spark.sql.shuffle.partitions": "16"}
    before = {k: spark.conf.get(k, None) for k in settings}
    try:
        for k, v in settings.items():
            spark.conf.set(k, v)
        n = 200_000
        df = spark.range(0, n, 1, 16).select(F.when(F.col("id") % 2 == 0, -1).otherwise(F.col("id") % (n - 1000)).alias("k"), F.sha2(F.col("id").cast("string"), 256).alias("text"))
        out = rules.with_repeats(df, [["k"]]).where("`_repeated k`")
        assert "Window" not in out._jdf.queryExecution().toString()
        sizes = [r.n for r in out.groupBy(F.spark_partition_id()).agg(F.count("*").alias("n"), F.max("text")).collect()]
        assert sum(sizes) == n // 2 + 1000 and max(sizes) < n // 8
    finally:
        for k, v in before.items():
            spark.conf.unset(k) if v is None else spark.conf.set(k, v)

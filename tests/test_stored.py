"""Tables that are kept: buckets that move nothing, distinct counts by owners."""

import random
import uuid

from pyspark.sql import functions as F

from tsforge.operators import buckets, catalog
from tsforge.plans import qc


def plan_of(df):
    df.collect()
    return df._jdf.queryExecution().executedPlan().toString()


def test_masks_meet_facts_without_an_exchange(spark, tmp_path):
    rows = [(i, bytes([i % 7]), "v", i / 3) for i in range(500)]
    facts = spark.createDataFrame(rows, "time_ns long, series_id binary, variable string, observed_value double")
    masks = facts.filter("time_ns % 3 = 0").select("time_ns", "series_id", "variable", F.col("time_ns").alias("mask"))
    layout = buckets.Layout(("time_ns", "series_id", "variable"), 4)
    names = [f"t_{uuid.uuid4().hex}" for _ in range(2)]
    a, b = layout.write(facts, names[0], f"{tmp_path}/facts"), layout.write(masks, names[1], f"{tmp_path}/masks")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        for _ in range(2):  # and after it was written again
            joined = qc.attach_masks(a, b, ("time_ns", "series_id"))
            plan = plan_of(joined)
            assert "Exchange" not in plan and "SortMergeJoin" in plan
            assert {r.time_ns: int(r.qc_bits) for r in joined.collect()} == {i: i if i % 3 == 0 else 0 for i in range(500)}
            b = layout.write(masks.filter("true"), names[1], f"{tmp_path}/masks")
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
        for n in names:
            spark.sql(f"drop table {n}")


def test_distinct_counts_by_owners(spark):
    rng = random.Random(1)
    rows = [(rng.choice(["s", "s", "s", "t", None]), rng.choice([None, *map(str, range(40))]), rng.randrange(9), rng.choice(["x", None])) for _ in range(900)]
    df = spark.createDataFrame(rows, "k string, a string, b int, c string")
    found = catalog.distinct_counts(df, ["k"], {"as": F.col("a"), "pairs": F.struct("a", "b"), "cs": F.col("c")})
    want = {k: (len({r[1] for r in rows if r[0] == k and r[1] is not None}), len({(r[1], r[2]) for r in rows if r[0] == k}), len({r[3] for r in rows if r[0] == k} - {None})) for k in ("s", "t", None)}
    assert {r[0]: tuple(r[1:]) for r in found.collect()} == want
    assert "Expand" not in plan_of(found)
    one = catalog.sensors(spark.range(1000).selectExpr("'only' as sensor", "cast(id % 50 as string) as vsn", "cast(id as string) as instrument_id", "1L as rows", "id as minimum_time", "id as maximum_time"))
    assert tuple(one.first()) == ("only", 1000, 0, 999, 50, 1000) and "Expand" not in plan_of(one)


def test_files_are_skipped_before_they_are_opened(spark, tmp_path):
    from tsforge.operators import file_index

    facts, index = str(tmp_path / "facts"), str(tmp_path / "index")
    rows = spark.range(4000).selectExpr("id % 20 as part", "id div 4 as t", "unhex(substr(sha2(cast(id % 20 * 100 + id % 100 div 20 as string), 256), 1, 32)) as series_id", "id as value").withColumnRenamed("t", "time_ns")
    rows.repartitionByRange(20, "part").write.partitionBy("part").parquet(facts)
    assert file_index.update(spark, facts, index) == 20 and file_index.update(spark, facts, index) == 0
    for key in (0, 503, 1904):
        one = rows.filter(F.col("series_id") == F.unhex(F.substring(F.sha2(F.lit(str(key)), 256), 1, 32)))
        series = bytes(one.first().series_id)
        found = file_index.read(spark, facts, index, series=[series])
        assert sorted(r.value for r in found.collect()) == sorted(r.value for r in one.collect())
        assert file_index.candidates(spark, index, series=[series]).count() <= 2
    assert file_index.candidates(spark, index, series=[b"none"]).count() <= 1 and file_index.candidates(spark, index, series=[]).count() == 0
    late = spark.range(10).selectExpr("99 as part", "id + 5000 as time_ns", "cast('x' as binary) as series_id", "id as value")
    late.write.partitionBy("part").mode("append").parquet(facts)
    assert file_index.update(spark, facts, index) == 1 if late.rdd.getNumPartitions() == 1 else file_index.update(spark, facts, index) > 0
    found = file_index.read(spark, facts, index, 5002, 5004)
    assert sorted(r.time_ns for r in found.collect()) == [5002, 5003] and {r.part for r in found.select("part").collect()} == {99}
    assert found.select("_metadata.file_path").distinct().count() <= 2
    nothing = spark.createDataFrame([(7, None, None, 1)], "part int, time_ns long, series_id binary, value long")
    nothing.write.partitionBy("part").mode("append").parquet(facts)
    file_index.update(spark, facts, index)
    assert file_index.candidates(spark, index, 10**9, None).count() == 1
    assert file_index.read(spark, facts, index, 10**9).count() == 0

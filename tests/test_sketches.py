from pyspark.sql import functions as F

from tablewarden.operators.sketches import build_sketches, estimates, merge_sketches


def test_merged_loads_equal_one_load(spark):
    df = spark.range(60_000).select((F.col("id") % 3).alias("g"), (F.col("id") % 5000).alias("x"),
                                    F.col("id").cast("double").alias("y"))
    loads = [build_sketches(df.where(F.col("y") % 2 == i), ["g"], {"x": "x"}, {"y": "y"}) for i in (0, 1)]
    both = estimates(merge_sketches(loads[0].union(loads[1]), [])).first()
    whole = estimates(build_sketches(df, [], {"x": "x"}, {"y": "y"})).first()
    assert both["rows"] == whole["rows"] == 60_000
    assert abs(both["x_distinct"] - 5000) <= 125 and both["x_distinct"] == whole["x_distinct"]
    for got, exact in zip(both["y_quantiles"], (30_000, 57_000, 59_400)):
        assert abs(got - exact) <= 1200


def test_hot_group_and_few_values(spark):
    df = spark.range(30_000).select(F.when(F.col("id") < 29_990, "hot").otherwise(F.col("id").cast("string"))
                                    .alias("g"), F.lit(7).alias("x"))
    found = {r["g"]: r for r in estimates(build_sketches(df, ["g"], {"x": "x"}, {"x": "x"})).collect()}
    assert len(found) == 11 and found["hot"]["rows"] == 29_990
    assert all(r["x_distinct"] == 1 and set(r["x_quantiles"]) == {7.0} for r in found.values())


def test_nulls_nan_and_empty_tables(spark):
    df = spark.createDataFrame([("a", None, None), ("a", None, float("nan")), ("b", "t", 1.5), (None, "t", 2.5)],
                               "g string, x string, y double")
    found = {r["g"]: r for r in estimates(build_sketches(df, ["g"], {"x": "x"}, {"y": "y"}), (0.5,)).collect()}
    assert found["a"]["x_distinct"] == 0 and found["a"]["y_quantiles"] is None
    assert found["b"]["y_quantiles"] == [1.5] and found[None]["y_quantiles"] == [2.5]
    empty = build_sketches(df.limit(0), ["g"], {"x": "x"}, {"y": "y"})
    assert empty.count() == 0
    total = estimates(merge_sketches(empty, [])).first()
    assert total["rows"] == 0 and total["x_distinct"] == 0 and total["y_quantiles"] is None

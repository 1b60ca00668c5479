import pytest
from pyspark.ml import PipelineModel
from pyspark.sql import functions as F

from lagline.functions import columns as c
from lagline.functions.dates import add_date_parts
from lagline.functions.labels import add_late_label, require_both_classes
from lagline.operators import cleaning, correlation, profiling


def test_late_label_with_missing_side(spark):
    df = spark.createDataFrame([(5, 3), (3, 3), (None, 3), (4, None)], "real int, planned int")
    assert [r["late"] for r in add_late_label(df, "real", "planned", "late").collect()] == [1, 0, 0, 0]
    with pytest.raises(ValueError, match="planned_days"):
        add_late_label(df, "real", "planned_days", "late")
    with pytest.raises(ValueError, match="one class"):
        require_both_classes(df.withColumn("late", F.lit(0)), "late")


def test_cap_keeps_nulls_and_is_idempotent(spark):
    df = spark.createDataFrame([(float(i),) for i in range(20)] + [(1000.0,), (-500.0,), (None,)], "x double")
    model = cleaning.IqrCapper(columns=["x"]).fit(df)
    once = model.transform(df)
    assert once.where("x is null").count() == 1
    low, high = once.agg(F.min("x"), F.max("x")).first()
    limits = cleaning.iqr_limits(df, ["x"])["x"]
    assert (low, high) == (limits["lower"], limits["upper"])
    assert sorted(once.collect(), key=str) == sorted(model.transform(once).collect(), key=str)


def test_zero_range_makes_a_constant(spark):
    df = spark.createDataFrame([(1.0,)] * 10 + [(9.0,)], "x double")
    capped = cleaning.IqrCapper(columns=["x"]).fit(df).transform(df)
    assert [r["x"] for r in capped.distinct().collect()] == [1.0]


def test_label_and_booleans_are_not_capped(spark):
    df = spark.createDataFrame([(1.0, 0, True)] * 9 + [(50.0, 1, False)], "x double, late int, flag boolean")
    capped = cleaning.IqrCapper(labelCol="late").fit(df).transform(df)
    assert capped.agg(F.max("late")).first()[0] == 1 and dict(capped.dtypes)["flag"] == "boolean"


def test_mode_ties_and_empty_columns(spark):
    df = spark.createDataFrame(
        [("b", None, 1.0), ("a", None, None), ("b", None, 3.0), ("a", None, 5.0), (None, None, None)],
        "s string, empty string, x double",
    )
    filled = cleaning.GapFiller().fit(df).transform(df)
    last = filled.collect()[-1]
    assert (last["s"], last["empty"], last["x"]) == ("a", "Unknown", 3.0)


def test_rare_values_and_null(spark):
    rows = [("a",)] * 5 + [("b",)] * 4 + [("c",)] * 2 + [(None,)]
    df = spark.createDataFrame(rows, "s string")
    got = cleaning.RareFolder(maxCategories=2).fit(df).transform(df)
    assert {r["s"]: r["count"] for r in got.groupBy("s").count().collect()} == {"a": 5, "b": 4, "Other": 3}
    untouched = cleaning.RareFolder(maxCategories=4).fit(df)  # three values and NULL: four
    assert untouched.getOrDefault("kept") == {}
    with_null = spark.createDataFrame([("a",)] * 5 + [(None,)] * 4 + [("c",)], "s string")
    got = cleaning.RareFolder(maxCategories=2).fit(with_null).transform(with_null)
    assert {r["s"]: r["count"] for r in got.groupBy("s").count().collect()} == {"a": 5, None: 4, "Other": 1}


def test_fitted_stages_survive_saving(spark, tmp_path):
    df = spark.createDataFrame([("a", 1.0), ("b", None), (None, 9.0), ("a", 2.0)], "s string, x double")
    filler = cleaning.GapFiller().fit(df)
    folder = cleaning.RareFolder(maxCategories=1).fit(df)
    capper = cleaning.IqrCapper(columns=["x"]).fit(df)
    model = PipelineModel([cleaning.ColumnDropper(columns=["nope"]), filler, folder, capper])
    model.write().overwrite().save(str(tmp_path / "m"))
    again = PipelineModel.load(str(tmp_path / "m"))
    assert again.transform(df).collect() == model.transform(df).collect()


def test_duplicates_of_nothing(spark):
    empty = spark.createDataFrame([], "a int")
    assert cleaning.duplicate_count(empty).first().asDict() == {"n_rows": 0, "n_duplicates": 0, "pct_duplicates": 0.0}


def test_nan_and_odd_names(spark):
    df = spark.createDataFrame([(float("nan"), 1), (2.0, 2)], "`a.b (c)` double, ` d ` int")
    clean = c.trim_column_names(c.nan_to_null(df))
    assert clean.columns == ["a.b (c)", "d"]
    found = {r["column"]: r["n_null"] for r in cleaning.null_counts(clean).collect()}
    assert found == {"a.b (c)": 1, "d": 0}


def test_bad_dates_become_missing_parts(spark):
    df = spark.createDataFrame([("1/31/2018 22:56",), ("soon",)], "`when` string")
    rows = add_date_parts(df, "when", "order_", "M/d/yyyy HH:mm").collect()
    assert tuple(rows[0]) == (2018, 1, 31, 2, 1) and tuple(rows[1]) == (None,) * 5
    assert add_date_parts(df, "missing", "order_").columns == ["when"]


def test_histogram_closes_the_last_bin(spark):
    df = spark.createDataFrame([(float(i),) for i in range(11)], "x double")
    bins = profiling.histogram(df, ["x"], 5).orderBy("bin").collect()
    assert [r["n"] for r in bins] == [2, 2, 2, 2, 3]
    constant = spark.createDataFrame([(4.0,)] * 3, "x double")
    got = {r["bin"]: (r["n"], r["lower"], r["upper"]) for r in profiling.histogram(constant, ["x"], 2).collect()}
    assert got == {0: (0, 3.5, 4.0), 1: (3, 4.0, 4.5)}


def test_value_lists(spark):
    df = spark.createDataFrame([(str(i % 5), f"{i % 15:02d}", str(i)) for i in range(60)], "a string, b string, c string")
    got = {r["column"]: r["values"] for r in profiling.distinct_value_lists(df, ["a", "b", "c"]).collect()}
    assert got["a"] == list("01234") and got["b"] == [f"{i:02d}" for i in range(10)] and got["c"] is None


def test_approximate_distinct_counts(spark):
    df = spark.createDataFrame([("x",), ("y",), (None,)], "a string")
    assert profiling.distinct_counts(df, ["a"], exact=False).first().asDict() == {
        "column": "a", "n_distinct": 2, "n_with_null": 3,
    }


def test_nan_is_missing_everywhere(spark):
    """NaN counts, fills, caps and correlates as NULL does."""
    nan = float("nan")
    df = spark.createDataFrame([(1, nan, 1.0), (2, 1.0, 2.0), (3, 2.0, nan), (4, 9.0, 4.0), (5, None, 5.0)], "id int, x double, y double")
    null = df.select("id", *[F.when(~F.isnan(c), F.col(c)).alias(c) for c in ("x", "y")])

    def same(operator):
        return [sorted(operator(d).collect(), key=str) for d in (df, null)]

    for operator in (
        cleaning.null_counts,
        cleaning.total_nulls,
        lambda d: cleaning.GapFiller(numericCols=["x", "y"], textCols=[]).fit(d).transform(d),
        lambda d: cleaning.fill_zero(d, ["x", "y"]),
        lambda d: cleaning.outlier_summary(d, ["x", "y"]),
        lambda d: cleaning.outlier_rows(d, "x"),
        lambda d: profiling.describe_numeric(d, ["x", "y"]),
        lambda d: correlation.correlation_pairs(d, ["x", "y"]),
    ):
        got, want = same(operator)
        assert got == want
    assert {r["column"]: r["n_null"] for r in cleaning.null_counts(df).collect()} == {"id": 0, "x": 2, "y": 1}


def test_distinct_rows_are_not_shuffled(spark):
    """No row of a table without copies is shuffled whole; with some, only these and few others are."""
    wide = spark.range(20_000).select("id", *[F.concat(F.lit(f"{i}-"), F.col("id")).alias(f"c{i}") for i in range(10)])
    plan = cleaning.drop_duplicate_rows(wide)._jdf.queryExecution().executedPlan().toString()
    assert "Exchange" not in plan
    some = wide.unionAll(wide.where("id < 100"))
    found = cleaning.drop_duplicate_rows(some)
    assert found.count() == 20_000 and found.distinct().count() == 20_000
    assert some.where(cleaning._maybe_copied(some)).count() < 3_000
    row = cleaning.duplicate_count(some).first()
    assert (row["n_rows"], row["n_duplicates"]) == (20_100, 100)
    assert tuple(cleaning.duplicate_count(wide).first())[:2] == (20_000, 0)


def test_copies_with_nulls_and_hot_rows(spark):
    rows = [(None, "a")] * 500 + [("a", None)] * 3 + [(None, None)] * 2 + [("b", "b")]
    df = spark.createDataFrame(rows, "x string, y string").repartition(4)
    assert sorted(cleaning.drop_duplicate_rows(df).collect(), key=str) == sorted(df.distinct().collect(), key=str)
    assert tuple(cleaning.duplicate_count(df).first())[:2] == (506, 502)
    empty = cleaning.duplicate_count(df.where("false")).first()
    assert (empty["n_rows"], empty["n_duplicates"], empty["pct_duplicates"]) == (0, 0, 0.0)

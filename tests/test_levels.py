"""The distributed dictionary of levels and the codes made from it."""

import pytest
from pyspark.ml import PipelineModel
from pyspark.ml.functions import vector_to_array
from pyspark.sql import functions as F

from lagline.operators import features


def table(spark):
    rows = [(1, "b", "x"), (2, "a", None), (3, None, "x"), (4, "ä", "x"), (5, "B", "x"), (6, "b", "x")]
    return spark.createDataFrame(rows, "id int, ab string, c string")


def test_levels_are_numbered_in_order(spark):
    found = features.level_table(table(spark), ["ab", "c"]).collect()
    assert sorted((r["column"], r["slot"], r["value"], r["width"]) for r in found) == [
        ("ab", 0, "B", 4), ("ab", 1, "a", 4), ("ab", 2, "b", 4), ("ab", 3, "ä", 4), ("c", 0, "x", 1),
    ]


def test_many_levels_stay_on_the_executors(spark):
    df = spark.range(50_000).select((F.col("id") % 20_000).cast("string").alias("v"))
    levels = features.level_table(df, ["v"])
    coded = features.with_level_slots(df, ["v"], levels)
    row = coded.agg(F.count_distinct("v_slot"), F.min("v_slot"), F.max("v_slot"), F.count("v_slot")).first()
    assert tuple(row) == (20_000, 0, 19_999, 50_000)
    order = coded.distinct().orderBy("v").select("v_slot").limit(5).collect()
    assert [r[0] for r in order] == [0, 1, 2, 3, 4]


@pytest.mark.parametrize("drop_first", [False, True])
def test_codes_and_persistence(spark, tmp_path, drop_first):
    df = table(spark)
    (stage,), vectors = features.fit_one_hot(df, ["ab", "c"], drop_first)
    PipelineModel([stage]).write().overwrite().save(str(tmp_path / "m"))
    new = df.union(spark.createDataFrame([(7, "unseen", "b")], df.schema))
    for model in (stage, PipelineModel.load(str(tmp_path / "m"))):
        coded = model.transform(new)
        assert [c for c in coded.columns if c not in df.columns] == vectors
        slots = {r["id"]: [v for x in vectors for v in r[x]] for r in coded.select("id", *[vector_to_array(f"`{v}`").alias(v) for v in vectors]).collect()}
        names = ["ab_B", "ab_a", "ab_b", "ab_ä", "c_x"] if not drop_first else ["ab_a", "ab_b", "ab_ä"]
        assert stage.slot_names() == names
        for r in new.collect():
            assert slots[r["id"]] == [float(n in (f"ab_{r['ab']}", f"c_{r['c']}")) for n in names]


def test_columns_without_values(spark):
    df = spark.createDataFrame([(1, None)], "id int, v string")
    (stage,), vectors = features.fit_one_hot(df, ["v"])
    assert vectors == [] and stage.slot_names() == [] and stage.transform(df).columns == ["id", "v"]
    assert features.fit_one_hot(df, []) == ([], [])

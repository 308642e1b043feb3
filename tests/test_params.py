"""Configuration parameters and registry."""

from billshift.operators import params

CONFIG = "MODEL_BUSNS_ID string, CONFIG_FLD string, CONFIG_FLD_VAL string, seq int"


def config(spark):
    return spark.createDataFrame(
        [("m1", "a", "9", 1), ("m1", "a", "10", 2), ("m1", "b", None, 3), ("m2", "a", "7", 4)], CONFIG
    )


def test_frame_keeps_every_entry(spark):
    rows = params.params_frame(config(spark), "m1").collect()
    assert sorted((r[0], r[1] or "") for r in rows) == [("a", "10"), ("a", "9"), ("b", "")]


def test_map_takes_the_last_value_of_a_key(spark):
    maps = {r[0]: r[1] for r in params.params_map(config(spark), "seq").collect()}
    assert maps == {"m1": {"a": "10", "b": None}, "m2": {"a": "7"}}


def test_map_without_order_is_still_the_same_every_time(spark):
    maps = {r[0]: r[1] for r in params.params_map(config(spark).where("CONFIG_FLD = 'a'")).collect()}
    assert maps == {"m1": {"a": "9"}, "m2": {"a": "7"}}


def test_missing_and_present_models(spark):
    asked = spark.createDataFrame([("m1",), ("m3",), ("m3",)], "MODEL_BUSNS_ID string")
    assert [r[0] for r in params.missing_models(asked, config(spark)).collect()] == ["m3"]
    assert params.has_model(config(spark), "m2")
    assert not params.has_model(config(spark), "m9")

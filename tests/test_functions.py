"""Time and text expressions."""

import pytest
from pyspark.sql import functions as F

from plantpulse.functions.text import general_key, is_safe
from plantpulse.functions.time import bucket, epoch_ms, from_epoch_ms
from plantpulse.operators.joins import translate
from plantpulse.sources.standins import Plant

from .fixtures import values


def one(spark, column):
    return spark.range(1).select(column).first()[0]


def test_epoch(spark):
    moment = F.lit("2021-01-29 04:29:00.786").cast("timestamp_ntz")
    assert one(spark, epoch_ms(moment)) == 1611894540786.0
    assert one(spark, from_epoch_ms(F.lit(1611894540786))).isoformat() == "2021-01-29T04:29:00"


def test_bucket_before_the_epoch(spark):
    assert one(spark, bucket(F.lit("1969-12-31 23:50:00").cast("timestamp_ntz"), 3600)).isoformat() == "1969-12-31T23:00:00"


@pytest.mark.parametrize("text,safe", [
    ("this is not a dangerous text !", 1), ("this -- is", 0), (None, 1), ("", 1), ("SELECT", 1), ("select", 0),
    ("a@b", 1), ("a@", 0), ("a@\n", 1), ("a@@b", 0), ("thisisnospy", 1), ("sp_x", 0), ("boxpro", 1), ("it's", 0),
    ("first\nsecond */", 0), ("weekend", 0)])
def test_screening(spark, text, safe):
    assert one(spark, is_safe(F.lit(text).cast("string"))) == safe


@pytest.mark.parametrize("language,text", [
    ("en_US", "Emergency stop"), ("pl_PL", "Wylacznik awaryjny"), ("da_DD", "Emergency stop"), ("nl_BE", "Noodstop")])
def test_translation(spark, language, text):
    df = spark.createDataFrame([("_29_3_39_1",)], "skey string")
    table = Plant(spark, "").translations
    assert values(translate(df, table, language, 6), "translation") == [(text,)]


def test_general_key(spark):
    assert one(spark, general_key(F.lit("_29_2_39_1"))) == "_29_1_39_1"


def test_raw_names(spark):
    from plantpulse.schemas import WEIGHTS, from_raw

    raw = spark.createDataFrame([("1", 2.0, "x")], "machineserial string, recipientweight_fNetWeight double, other string")
    assert from_raw(raw).columns == ["serial", "net", "other"]
    assert "net" in WEIGHTS.fieldNames()

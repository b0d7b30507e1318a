import pytest
from pyspark.sql import functions as F

from termweave.functions import text as T


def one(spark, column, value):
    return spark.createDataFrame([(value,)], "s string").select(column(F.col("s")).alias("x")).first().x


@pytest.mark.parametrize(
    ("given", "norm", "types"),
    [
        ("ABDOMEN", "abdomen", ["case"]),
        ("Abdomen, NOS", "abdomen", ["nos", "case"]),
        ("Cancer, Lung", "lung cancer", ["uninv", "case"]),
        ("1,4-alpha-Glucan Branching Enzyme", "1,4 alpha glucan branching enzyme", ["case", "hyphen"]),
        ("[X]Lung cancer", "lung cancer", ["parenth", "case"]),
        ("lung's cancers' x", "lung cancers x", ["poss"]),
        ("[x]lung", "[x]lung", []),
        ("a  b", "a b", ["hyphen"]),
        ("", "", []),
        ("cancer, of lung", "cancer, of lung", []),
    ],
)
def test_normalize(spark, given, norm, types):
    got = one(spark, T.normalize, given)
    assert (got.norm, got.types) == (norm, types)
    assert one(spark, T.normalize, norm).norm == norm


def test_records(spark):
    assert one(spark, T.parse_record, "a||b|") == ["a", "", "b"]
    assert one(spark, lambda c: T.split_keep_empty(c, "|"), "|a") == ["a"]
    assert one(spark, lambda c: T.split_keep_empty(c, "|"), "a||b") == ["a", "", "b"]
    assert one(spark, lambda c: T.split_keep_empty(c, "|"), "a|") == ["a", ""]
    assert one(spark, lambda c: T.split_keep_empty(c, "|"), "") == []
    assert one(spark, T.is_lowercase, None) is True
    assert one(spark, T.restore_status, "a|p|b|p|") == "a|P|b|p|"
    assert one(spark, T.reader_tokens, "Don't stop (now) 12%") == ["don", "'t", "stop", "(", "now", ")", "12", "%"]

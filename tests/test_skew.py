"""Hot keys: found, joined by broadcast, and without effect on the result."""

import pytest
from pyspark.sql import functions as F

from fareloom.operators import clean, gold, skew
from fareloom.plans import inputs


def skewed(spark, n=30000):
    hot = F.when(F.col("id") % 3 == 0, F.lit(7)).when(F.col("id") % 10 == 1, F.lit(8))
    return spark.range(n).select(hot.otherwise(F.col("id") % 5000).alias("k"), "id")


def test_hot_keys_are_found(spark, monkeypatch):
    assert skew.hot_keys(skewed(spark), "k") == []
    monkeypatch.setattr(skew, "HOT_ROWS", 1000)
    assert sorted(skew.hot_keys(skewed(spark), "k")) == [7, 8]
    monkeypatch.setattr(skew, "SAMPLE_ROWS", 5000)
    assert sorted(skew.hot_keys(skewed(spark), "k")) == [7, 8]
    monkeypatch.setattr(skew, "HOT_ROWS", 100_000)
    assert skew.hot_keys(skewed(spark), "k") == []


@pytest.mark.parametrize("hot", [[], [7], [7, 8, 123456]])
def test_join_is_the_same_for_any_choice_of_hot_keys(spark, hot):
    rows = skewed(spark).unionAll(spark.sql("SELECT CAST(NULL AS BIGINT), CAST(-1 AS BIGINT)"))
    lookup = spark.range(0, 5000, 2).select(F.col("id").alias("j"), (F.col("id") * 2).alias("v"))
    plain = rows.join(lookup, F.col("k") == F.col("j"))
    split = skew.lookup_join(rows, lookup, "k", "j", hot)
    assert split.count() == plain.count()
    assert split.exceptAll(plain).isEmpty()


def test_trips_do_not_change_when_keys_are_hot(spark, sf_dir, monkeypatch):
    plain = gold.daily_summary(inputs.trips(spark, sf_dir)).collect()
    accounts = clean.cleaning_accounts(inputs.bronze(spark, sf_dir)).collect()
    for (name, key), hot in {("lineitem", "l_orderkey"): [5, 97], ("lineitem", "l_suppkey"): [1, 2],
                             ("orders", "o_custkey"): [3]}.items():
        monkeypatch.setitem(inputs._HOT_KEYS, (sf_dir, name, key), hot)
    assert sorted(gold.daily_summary(inputs.trips(spark, sf_dir)).collect()) == sorted(plain)
    assert clean.cleaning_accounts(inputs.bronze(spark, sf_dir)).collect() == accounts

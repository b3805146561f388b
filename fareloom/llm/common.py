"""Shared helpers: reading tables, tables in the shared folder, joins on keys with counted copies."""

from __future__ import annotations

import sys
import tempfile
import uuid
from collections.abc import Callable

from pyspark import cloudpickle
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

#: Words are what lies between these characters, written as a Java class.
SPACE = "[\\x20\\x09-\\x0D]"
#: A key with more than 1/HOT_SHARE of all rows is joined by broadcast: at most HOT_SHARE keys, at any size.
HOT_SHARE = 256


def by_value(module: str) -> None:
    """Functions of the module travel to the executors whole, so those need not have this package installed."""
    cloudpickle.register_pickle_by_value(sys.modules[module])


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """One of the given tables."""
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def shared_dir(spark: SparkSession, name: str) -> str:
    """A fresh folder that driver and executors share: below spark.checkpoint.dir.

    Only a local session, whose executors are threads of the driver, may do without that setting.
    """
    root = spark.sparkContext.getConf().get("spark.checkpoint.dir") or spark.conf.get("spark.checkpoint.dir", None)
    if not root:
        if not spark.sparkContext.master.startswith("local"):
            raise ValueError("set spark.checkpoint.dir to a folder that all executors share")
        if spark.sparkContext.master.startswith("local-cluster"):
            raise ValueError("set spark.checkpoint.dir to a folder that all executors share")
        root = tempfile.mkdtemp(prefix="fareloom-llm-")
        spark.conf.set("spark.checkpoint.dir", root)
    return f"{root.rstrip('/')}/{name}-{uuid.uuid4().hex}"


def stored(df: DataFrame, name: str) -> DataFrame:
    """The rows, written once to the shared folder and read from there: cuts lineage, survives lost executors."""
    path = shared_dir(df.sparkSession, name)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def let(value: Column, use: Callable[[Column], Column]) -> Column:
    """use(value) with value computed once per row, however often `use` refers to it."""
    return F.transform(F.array(value), use)[0]


def join_counted(
    left: DataFrame, right: DataFrame, key: str, copies: str, how: str = "left", merged: bool = False
) -> DataFrame:
    """left join right on `key`, whatever share of left one key has.

    right: one row per key, with the number of left's rows in `copies` (dropped). Keys with more than 1/HOT_SHARE
    of all rows number at most HOT_SHARE, so those are broadcast by proof; the rest is shuffled. left is read
    twice and should be a stored table. how: "left" or "inner". Null keys match nothing.
    merged: the rest is shuffled even where Spark takes right for small by the compressed bytes of its files.
    """
    total = right.agg(F.sum(copies)).first()[0] or 0
    is_hot = F.col(copies) * HOT_SHARE > F.lit(total)
    hot = right.filter(is_hot).drop(copies)
    cold = right.filter(~is_hot).drop(copies)
    cold = cold.hint("merge") if merged else cold
    hot_keys = hot.select(key)
    on_hot = left.join(F.broadcast(hot), key, "inner")
    rest = left.join(F.broadcast(hot_keys), key, "left_anti").join(cold, key, how)
    return on_hot.unionByName(rest)

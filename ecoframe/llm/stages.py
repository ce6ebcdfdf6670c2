"""Lineage cuts and skew-safe joins shared by the operators."""

from __future__ import annotations

from collections.abc import Iterator
from contextlib import contextmanager
from contextvars import ContextVar

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ecoframe.session import scratch_path

SALTS = 32


_OWNED: ContextVar[list[Stages] | None] = ContextVar("owned", default=None)


class Stages:
    """Tables written for one run below the shared work folder.

    They survive lost executors; those that no later step reads are removed as
    soon as the step after them is written.  Tables that the (lazy) result of an operator still reads stay, until the
    end of the `owned` block, if any, in which the operator was called."""

    def __init__(self, spark: SparkSession, name: str):
        self.spark, self.base = spark, scratch_path(spark, name)
        made = _OWNED.get()
        if made is not None:
            made.append(self)

    def write(self, df: DataFrame, name: str) -> DataFrame:
        df.write.mode("overwrite").parquet(f"{self.base}/{name}")
        return self.spark.read.schema(df.schema).parquet(f"{self.base}/{name}")

    def remove(self, *names: str) -> None:
        for name in names:
            self._delete(f"{self.base}/{name}")

    def remove_all(self) -> None:
        self._delete(self.base)

    def _delete(self, folder: str) -> None:
        path = self.spark.sparkContext._jvm.org.apache.hadoop.fs.Path(folder)
        path.getFileSystem(self.spark.sparkContext._jsc.hadoopConfiguration()).delete(path, True)


@contextmanager
def owned() -> Iterator[None]:
    """Tables of the operators called inside are removed at the end, also after an error: write their results before."""
    made: list[Stages] = []
    token = _OWNED.set(made)
    try:
        yield
    finally:
        _OWNED.reset(token)
        for stages in made:
            stages.remove_all()


def partitions(spark: SparkSession) -> int:
    return int(spark.conf.get("spark.sql.shuffle.partitions"))


def salted_join(rows: DataFrame, groups: DataFrame, keys: list[str], spread: str, how: str = "inner",
                salts: int = SALTS) -> DataFrame:
    """``rows`` with the columns of their (one) row of ``groups``.

    A key that holds a large share of the rows is dealt to ``salts`` tasks: the group
    rows are first joined to the (key, salt) pairs that occur, at most ``salts`` a key."""
    salted = rows.withColumn("_salt", F.pmod(F.xxhash64(spread), F.lit(salts)))
    present = salted.select(*keys, "_salt").distinct().join(groups, keys)
    return salted.join(present, [*keys, "_salt"], how).drop("_salt")

"""Small helpers shared by the operators of this subpackage."""

from __future__ import annotations

import pickle

from pyspark import cloudpickle
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from claimsmith.operators.keys import _delete_path, scratch_table_path, shuffles_freed
from claimsmith.sources.io import materialize

UPPER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ"
LOWER = UPPER.lower()
#: White space of the word contracts: space and the five control characters.
WHITE = "\t\n\x0b\x0c\r "
WORD_RE = r"[^\x20\x09-\x0D]+"

__all__ = ["LOWER", "UPPER", "WHITE", "WORD_RE", "Scratch", "Shared", "ascii_lower", "crc32_mod", "free_name",
           "materialize", "read_table", "shuffles_freed", "utf8"]


def read_table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def utf8(col: str | Column) -> Column:
    """A text as its UTF-8 bytes; null stays null."""
    return (F.col(col) if isinstance(col, str) else col).cast("binary")


def ascii_lower(col: Column) -> Column:
    """A-Z lowered, every other character as it is. ``lower`` also changes
    other alphabets, so it serves for texts of single-byte characters only."""
    plain = F.octet_length(col) == F.char_length(col)
    return F.when(plain, F.lower(col)).otherwise(F.translate(col, UPPER, LOWER))


def crc32_mod(col: str, n: int) -> Column:
    """crc32 of the value's text, modulo n (null: null)."""
    return F.crc32(F.col(col).cast("string").cast("binary")) % F.lit(n)


def free_name(taken: list[str], name: str) -> str:
    """A column name like ``name`` that none of the taken ones equals."""
    have = {c.lower() for c in taken}
    while name.lower() in have:
        name += "_"
    return name


class Shared:
    """A bounded object sent to the tasks once per executor, with the classes
    it consists of."""

    def __init__(self, spark: SparkSession, value):
        self._raw = spark.sparkContext.broadcast(cloudpickle.dumps(value))

    def __getstate__(self) -> dict:
        return {"_raw": self._raw}

    @property
    def value(self):
        if "_value" not in self.__dict__:
            self._value = pickle.loads(self._raw.value)
        return self._value

    def destroy(self) -> None:
        """Free it everywhere, once no task needs it again."""
        self._raw.destroy()


class Scratch:
    """Tables of one operator call in the shared checkpoint folder; ``drop``
    frees those that no later step reads."""

    def __init__(self, spark: SparkSession, kind: str):
        self.spark, self.kind = spark, kind

    def write(self, df: DataFrame, compression: str | None = None) -> tuple[DataFrame, str]:
        path = scratch_table_path(self.spark, self.kind)
        df.write.parquet(path, compression=compression)
        return self.spark.read.schema(df.schema).parquet(path), path

    def drop(self, path: str) -> None:
        _delete_path(self.spark, path)

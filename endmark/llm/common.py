"""Helpers shared by the corpus operators."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..plans.storage import forget, shared_dir, spread, written

__all__ = ["SPACE", "forget", "fresh", "looked_up", "once", "shared_dir", "spread", "table", "text_of", "words_of", "written"]

#: White space of the word rules: U+0020 and U+0009 to U+000D.
SPACE = "\\x20\\x09-\\x0D"


def text_of(name: str = "text") -> Column:
    """The text column, null read as empty."""
    return F.coalesce(F.col(name), F.lit(""))


def words_of(text: Column) -> Column:
    """Words `[^\\x20\\x09-\\x0D]+` in order, repeats kept."""
    return F.array_remove(F.split(text, f"[{SPACE}]+"), "")


def fresh(df: DataFrame, *names: str) -> list[str]:
    """Column names built from `names` that df does not have (input tables may bring any extra columns)."""
    taken = {c.lower() for c in df.columns}
    out = []
    for name in names:
        new = f"_{name}"
        while new.lower() in taken:
            new = f"_{new}"
        taken.add(new.lower())
        out.append(new)
    return out


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def once(df: DataFrame, name: str, value: Column) -> DataFrame:
    """df with a column that is computed once a row: later filters on it stay above it. (Through a plain projection Catalyst
    pushes a filter down with the column's whole expression in it, and what that refers to in turn.)"""
    return df.select("*", F.explode(F.array(value)).alias(name))


def looked_up(rows: DataFrame, key: str, values: DataFrame, name: str, salts: int = 512) -> DataFrame:
    """rows (all columns not null) with the column `name` of values, which has one row for each key; null where it has none. A key may hold
    any share of rows: they are dealt by (key, salt), and a key's value goes to at most `salts` such groups."""
    salt, at = fresh(rows, "salt", "at")
    salted = rows.withColumn(salt, F.pmod(F.xxhash64(*rows.columns), F.lit(salts)).cast("int"))
    groups = salted.select(key, salt).distinct().join(values.select(key, name), key)
    return salted.join(groups.withColumnRenamed(key, at), (F.col(key) == F.col(at)) & salted[salt].eqNullSafe(groups[salt]), "left").drop(at).drop(salt)

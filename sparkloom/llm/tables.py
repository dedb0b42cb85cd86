"""Table access for the training-data queries: the whole Parquet table, nothing else."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType


def read(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


def extended(schema: StructType, **fields: str) -> StructType:
    """A copy of ``schema`` with more fields, given as name=type."""
    out = StructType(list(schema.fields))
    for name, kind in fields.items():
        out = out.add(name, kind)
    return out


def split_by_slot(rows: DataFrame, key: Column, hits: DataFrame, hit_key: Column, slots: int = 1 << 20):
    """(rows whose key may be among the keys of ``hits``, all other rows).

    Keys are hashed into a table of ``slots`` slots, whose size does not depend on the data;
    a row whose slot no hit falls into needs no join, so its text is not shuffled. When all
    slots are full nothing is saved, and nothing is lost.
    """
    taken = F.broadcast(hits.select(F.pmod(hit_key, F.lit(slots)).alias("__slot")).distinct())
    marked = rows.withColumn("__slot", F.coalesce(F.pmod(key, F.lit(slots)), F.lit(-1)))
    return (
        marked.join(taken, "__slot", "left_semi").drop("__slot"),
        marked.join(taken, "__slot", "left_anti").drop("__slot"),
    )


def refuse_clash(rows: DataFrame, *names: str) -> None:
    """Raise if ``rows`` already has a column that an operator adds (in any letter case)."""
    have = {c.lower() for c in rows.columns}
    clash = [n for n in names if n.lower() in have]
    if clash:
        raise ValueError(f"the table already has the columns {', '.join(clash)}: rename them first")

"""Helpers shared by the operators of this package."""

from __future__ import annotations

import uuid
from collections.abc import Callable, Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from basketflow.session import shared_dir
from basketflow.sources.tables import table  # noqa: F401 - re-exported for the query modules


def stage(df: DataFrame, label: str) -> DataFrame:
    """Write ``df`` as parquet below the shared folder and read it back.

    Cuts the lineage (a lost executor re-reads the files instead of
    recomputing), keeps column pruning and file statistics for later reads.
    """
    spark = df.sparkSession
    path = f"{shared_dir(spark).rstrip('/')}/llm-{label}-{uuid.uuid4().hex[:12]}"
    df.write.parquet(path)
    out = spark.read.schema(df.schema).parquet(path)
    out._llm_path = path
    return out


def drop_stage(df: DataFrame) -> None:
    """Delete the files behind a frame returned by :func:`stage`."""
    path = getattr(df, "_llm_path", None)
    if path is None:
        return
    jvm = df.sparkSession._jvm
    p = jvm.org.apache.hadoop.fs.Path(path)
    p.getFileSystem(df.sparkSession._jsc.hadoopConfiguration()).delete(p, True)


def with_fields(schema: T.StructType, new: list[T.StructField], drop: tuple[str, ...] = ()) -> T.StructType:
    """``schema`` without ``drop`` and without fields that ``new`` replaces, then ``new``."""
    gone = {f.name for f in new} | set(drop)
    return T.StructType([f for f in schema.fields if f.name not in gone] + list(new))


def packed(df: DataFrame) -> Column:
    """All columns of ``df`` in one struct: no name beside it can clash with them."""
    return F.struct(*[F.col(f"`{c}`") for c in df.columns])


def fresh(df: DataFrame, name: str) -> str:
    """``name``, made longer until no column of ``df`` has it."""
    taken = {c.lower() for c in df.columns}
    while name in taken:
        name += "_"
    return name


def strings(column: pa.Array) -> Iterator[str | None]:
    """The values of a string column; bytes that are no UTF-8 become U+FFFD."""
    for x in column:
        try:
            yield x.as_py()
        except UnicodeDecodeError:
            yield x.as_buffer().to_pybytes().decode("utf-8", "replace")


def let(value: Column, body: Callable[[Column], Column]) -> Column:
    """``body(value)`` with ``value`` evaluated once, even inside lambdas and pushed-down filters."""
    return F.transform(F.array(value), body)[0]

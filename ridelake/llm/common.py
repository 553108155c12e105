"""Helpers shared by the corpus operators.

Conventions every operator of this subpackage keeps:

* only the columns an operator names are read; extra columns, whatever their
  names, never reach its working columns;
* a document row is identified by ``row_key`` (id and whole text), so exactly
  repeated rows are one document and rows that merely share an id are not;
* intermediate results are written below ``spark.checkpoint.dir`` as Parquet
  (``materialize``), so a lost executor costs a re-read and not a re-run.
"""

from __future__ import annotations

import tempfile
import zipfile
from collections.abc import Callable, Iterable
from pathlib import Path

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql.types import StructField, StructType

import ridelake
from ridelake.session import scratch_path


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


def materialize(df: DataFrame, name: str) -> DataFrame:
    """Write ``df`` to the shared scratch folder and read it back."""
    spark = df.sparkSession
    path = scratch_path(spark, name)
    df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def _ship(spark: SparkSession) -> None:
    """Give the executors this package's modules, once a Spark context."""
    sc = spark.sparkContext
    if getattr(sc, "_ridelake_shipped", False):
        return
    top = Path(ridelake.__file__).parent
    target = Path(tempfile.mkdtemp(prefix="ridelake-code-")) / "ridelake.zip"
    with zipfile.ZipFile(target, "w") as z:
        for f in sorted(top.rglob("*.py")):
            z.write(f, str(f.relative_to(top.parent)))
    sc.addPyFile(str(target))
    sc._ridelake_shipped = True


def map_arrow(df: DataFrame, function: Callable, schema: str | StructType) -> DataFrame:
    """``mapInArrow`` with this package importable in the tasks."""
    _ship(df.sparkSession)
    return df.mapInArrow(function, schema)


def whole_row(df: DataFrame) -> Column:
    """All columns of ``df`` as the struct ``row``, whatever characters their names hold."""
    return F.struct(*[F.col("`" + c.replace("`", "``") + "`") for c in df.columns]).alias("row")


def carrying(df: DataFrame, rest: str) -> StructType:
    """The column ``row`` of ``df`` and the columns of ``rest`` (DDL), as a schema."""
    return StructType([StructField("row", df.schema["row"].dataType), *StructType.fromDDL(rest).fields])


def row_key(id_col: str = "doc_id", text_col: str = "text") -> Column:
    """16 bytes that identify a document row by its id and its whole text."""
    named = F.concat_ws(
        ":", F.coalesce(F.col(id_col).cast("string"), F.lit("null")),
        F.when(F.col(text_col).isNull(), F.lit("n")).otherwise(F.lit("t")),
        F.coalesce(F.col(text_col).cast("string"), F.lit("")))
    return F.substring(F.unhex(F.sha2(named, 256)), 1, 16)


RANK_BYTES = 21


def document_rank(id_col: str = "doc_id", text_col: str = "text") -> Column:
    """``RANK_BYTES`` bytes that identify a document row and order rows by id (none last),
    then by the key of the row."""
    doc = F.col(id_col).cast("long")
    return F.concat(F.when(doc.isNull(), F.unhex(F.lit("01"))).otherwise(F.unhex(F.lit("00"))),
                    F.unhex(F.lpad(F.hex(F.coalesce(doc, F.lit(0)).bitwiseXOR(F.lit(-2 ** 63))), 16, "0")),
                    F.substring(row_key(id_col, text_col), 1, 12))


def fresh(taken: Iterable[str], base: str) -> str:
    """A column name that no column in ``taken`` has (ignoring case)."""
    names = {c.lower() for c in taken}
    while base.lower() in names:
        base = "_" + base
    return base


def texts(batch: pa.RecordBatch, column: str = "text") -> list[bytes | None]:
    """UTF-8 bytes of a string column (None for null)."""
    return batch.column(batch.schema.get_field_index(column)).cast(pa.large_binary()).to_pylist()


def partition_id() -> int:
    from pyspark import TaskContext

    ctx = TaskContext.get()
    return ctx.partitionId() if ctx else 0


PARTIALS = 256  # task results that the driver adds up; more are first added up in tasks


def summed(df: DataFrame, of: Callable[[Iterable[pa.RecordBatch]], np.ndarray | None], tasks: int) -> np.ndarray | None:
    """The sum of what ``of`` gives for the batches of each task (an array of doubles of one shape,
    or None), always added up in one order. ``tasks``: about how many tasks ``df`` has."""
    schema = "part binary, shape array<int>"

    def row(total: np.ndarray) -> pa.RecordBatch:
        return pa.RecordBatch.from_arrays([pa.array([total.astype("<f8").tobytes()], pa.binary()),
                                           pa.array([list(total.shape)], pa.list_(pa.int32()))], names=["part", "shape"])

    def run(batches):
        total = of(batches)
        if total is not None:
            yield row(total)

    def add(batches):
        found = sorted((p, tuple(s)) for b in batches for p, s in zip(b.column(0).to_pylist(), b.column(1).to_pylist(), strict=True))
        if found:
            yield row(sum(np.frombuffer(p, "<f8").reshape(s) for p, s in found))

    parts = map_arrow(df, run, schema)
    if tasks > PARTIALS:
        parts = map_arrow(parts.repartition(int(tasks ** 0.5), F.xxhash64("part")), add, schema)
    found = sorted((bytes(r["part"]), tuple(r["shape"])) for r in parts.collect())
    return sum(np.frombuffer(p, "<f8").reshape(s) for p, s in found) if found else None


def in_slices(df: DataFrame, order: list[str], name: str) -> DataFrame:
    """``df`` written in the order of its columns ``order``, dealt by range: a slice
    (new column ``slice``) holds what lies between two sampled bounds, so a value on
    many rows is parted by the columns after it, and slice numbers follow the order."""
    return materialize(df.repartitionByRange(*order).sortWithinPartitions(*order)
                       .withColumn("slice", F.spark_partition_id()), name)


def running_total(df: DataFrame, order: list[str], value: str, name: str, within: list[str] | None = None) -> DataFrame:
    """``df`` with ``before`` (and ``slice``): the sum of ``value`` over the rows that come
    before a row by ``order``, inside its group of equal ``within`` columns (no nulls;
    they must lead ``order``).

    Slices are summed alone; only one sum a slice and group is carried over, so no task
    holds a group and a group of any size is spread over slices."""
    within = within or []
    rows = in_slices(df, order, name)
    sums = rows.groupBy(*within, "slice").agg(F.sum(value).alias("own"))
    earlier = Window.partitionBy(*within).orderBy("slice").rowsBetween(Window.unboundedPreceding, -1)
    first = sums.select(*within, "slice", F.coalesce(F.sum("own").over(earlier), F.lit(0)).alias("first"))
    inside = Window.partitionBy("slice", *within).orderBy(*order).rowsBetween(Window.unboundedPreceding, -1)
    return (rows.withColumn("inner", F.coalesce(F.sum(value).over(inside), F.lit(0)))
            .join(first, [*within, "slice"])
            .withColumn("before", F.col("first") + F.col("inner")).drop("first", "inner"))

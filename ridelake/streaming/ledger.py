"""Write, then acknowledge: a stream sink that knows which batches it has taken.

A micro-batch is acknowledged by the checkpoint only after the sink has returned; when
the stream fails in between, the same batch comes again. Each batch is written to a
folder of its own, then entered in the ledger (one small file, put in place by a
rename), and readers take only batches that the ledger names:

* failure before the entry: the folder is written over when the batch comes again;
* failure after the entry: the batch that comes again is recognised and not written.

Batch numbers begin anew with every checkpoint, so a ledger entry is a pair of stream
(named by its checkpoint) and batch, and several streams can feed one table.
"""

from __future__ import annotations

import hashlib
import json
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery
from pyspark.sql.types import LongType, StringType, StructField, StructType

from ridelake.plans.models import flatten_status
from ridelake.session import path_exists, write_text
from ridelake.streaming.status import DEFAULT_MAX_FILES, _trigger, stream_status, valid_documents

ENTRY = StructType([StructField("stream", StringType()), StructField("batch", LongType()), StructField("rows", LongType())])


def stream_name(checkpoint: str) -> str:
    return hashlib.md5(checkpoint.rstrip("/").encode()).hexdigest()


@dataclass(frozen=True)
class Ledger:
    root: str
    stream: str

    def folder(self, batch: int) -> str:
        return f"{self.root}/data/stream={self.stream}/batch={batch}"

    def entry(self, batch: int) -> str:
        return f"{self.root}/ledger/{self.stream}-{batch:012d}.json"

    def has(self, spark: SparkSession, batch: int) -> bool:
        return path_exists(spark, self.entry(batch))

    def take(self, rows: DataFrame, batch: int) -> bool:
        """Write the batch and enter it; False if it has been taken before."""
        spark = rows.sparkSession
        if self.has(spark, batch):
            return False
        rows.write.mode("overwrite").parquet(self.folder(batch))
        written = spark.read.schema(rows.schema).parquet(self.folder(batch)).count()  # from the footers
        write_text(spark, self.entry(batch), json.dumps({"stream": self.stream, "batch": batch, "rows": written}))
        return True


def read_ledger(spark: SparkSession, root: str) -> DataFrame:
    """(stream, batch, rows) of every batch taken."""
    if not path_exists(spark, f"{root}/ledger"):
        return spark.createDataFrame([], ENTRY)
    return spark.read.schema(ENTRY).json(f"{root}/ledger")


def read_batches(spark: SparkSession, root: str, schema: StructType) -> DataFrame:
    """The rows of all batches in the ledger."""
    if not path_exists(spark, f"{root}/ledger"):
        return spark.createDataFrame([], schema)
    full = StructType([*schema.fields, *ENTRY.fields[:2]])
    data = spark.read.schema(full).parquet(f"{root}/data")
    # on the folders' names, so folders without an entry aren't read
    return data.join(read_ledger(spark, root).select("stream", "batch"), ["stream", "batch"], "left_semi").select(*schema.names)


def start_ledger_stream(spark: SparkSession, landing_dir: str, root: str, checkpoint: str,
                        trigger: str | None = None, available_now: bool = False,
                        max_files_per_trigger: int = DEFAULT_MAX_FILES, ingestion_at=None,
                        name: str | None = None, after_write=None) -> StreamingQuery:
    """Feed files -> flattened rows -> the ledger table at ``root``. ``after_write(batch)``,
    where given, is called between the write and the acknowledgement."""
    ledger = Ledger(root, stream_name(checkpoint))
    flat = flatten_status(valid_documents(stream_status(spark, landing_dir, max_files_per_trigger)), ingestion_at)

    def take(rows: DataFrame, batch: int) -> None:
        ledger.take(rows, batch)
        if after_write is not None:
            after_write(batch)

    writer = flat.writeStream.outputMode("append").foreachBatch(take).option("checkpointLocation", checkpoint)
    return _trigger(writer.queryName(name) if name else writer, trigger, available_now).start()




def total_rows(spark: SparkSession, root: str) -> int:
    return read_ledger(spark, root).agg(F.coalesce(F.sum("rows"), F.lit(0))).first()[0]

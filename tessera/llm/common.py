"""Shared pieces: table access, scratch tables in the shared folder, text splitting and Arrow helpers."""

from __future__ import annotations

import ctypes
import hashlib
import os
import re
import tempfile
import uuid
from collections.abc import Callable, Iterator

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

#: Rows in an Arrow batch. Texts can be long, so batches are kept well below Spark's default of 10,000 rows.
BATCH_ROWS = 512

#: Largest data, in rows, that an operator hands to every executor. Beyond it the same join is shuffled.
BROADCAST_ROWS = 500_000

#: White space of the word rules, as fixed by the result contracts.
SPACE = " \t\n\x0b\x0c\r"

_LOWER_BYTES = bytes(range(65)) + bytes(range(97, 123)) + bytes(range(91, 256))
_LOWER_CHARS = {i: i + 32 for i in range(65, 91)}


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def lower_ascii(text: str) -> str:
    """A-Z become a-z; every other character stays."""
    return text.translate(_LOWER_CHARS)


def lower_ascii_bytes(raw: bytes) -> bytes:
    return raw.translate(_LOWER_BYTES)


def words_of(raw: bytes) -> list[bytes]:
    """Words `[^\\x20\\x09-\\x0D]+` of UTF-8 text: bytes.split() knows exactly these six separators."""
    return raw.split()


def utf8(text: str | None) -> bytes:
    """UTF-8 of a text, empty for null. Spark strings are valid UTF-8, so nothing is replaced."""
    return text.encode("utf-8", "surrogatepass") if text else b""


def sha256_hex(raw: bytes) -> str:
    return hashlib.sha256(raw).hexdigest()


def prepare(spark: SparkSession) -> None:
    """Small Arrow batches, and workers that find this package where it isn't installed (same path on every machine)."""
    root = os.path.dirname(os.path.dirname(os.path.dirname(os.path.abspath(__file__))))
    paths = [p for p in spark.sparkContext.environment.get("PYTHONPATH", "").split(os.pathsep) if p]
    if root not in paths:
        spark.sparkContext.environment["PYTHONPATH"] = os.pathsep.join([root, *paths])
    if int(spark.conf.get("spark.sql.execution.arrow.maxRecordsPerBatch")) > BATCH_ROWS:
        spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", str(BATCH_ROWS))


def give_back() -> None:
    """Memory that this worker process has freed returns to the system: the process lives on for tasks of other operators."""
    pa.default_memory_pool().release_unused()
    if trim := getattr(ctypes.CDLL(None), "malloc_trim", None):  # glibc only
        trim(0)


def map_batches(df: DataFrame, function: Callable[[pa.RecordBatch], pa.RecordBatch | None], schema: str) -> DataFrame:
    """`function` over Arrow batches; a batch for which it returns None gives no rows."""
    prepare(df.sparkSession)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            if batch.num_rows and (out := function(batch)) is not None:
                yield out

    return df.mapInArrow(run, schema)


def shared_folder(spark: SparkSession) -> str:
    """The folder that the session names in spark.checkpoint.dir. Where it is unset, a temporary one in local mode, else an error."""
    sc = spark.sparkContext
    if named := sc.getConf().get("spark.checkpoint.dir", None):
        return named.rstrip("/")
    if sc._jsc.sc().getCheckpointDir().isEmpty():
        if not sc.master.startswith("local"):
            raise ValueError("spark.checkpoint.dir names no folder that all machines share")
        sc.setCheckpointDir(tempfile.mkdtemp(prefix="tessera-"))
    return sc._jsc.sc().getCheckpointDir().get().rstrip("/")


_CLEANUP = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"


class Scratch:
    """Tables written to the shared folder: they cut lineage, survive lost executors and are reused without recomputing."""

    def __init__(self, spark: SparkSession, label: str) -> None:
        self.spark, self.root = spark, f"{shared_folder(spark)}/{re.sub(r'[^a-z0-9]+', '-', label.lower())}-{uuid.uuid4().hex}"

    def path(self, name: str) -> str:
        return f"{self.root}/{name}"

    def keep(self, df: DataFrame, name: str, *by: str) -> DataFrame:
        """Written as Parquet, in folders by the columns `by` if any are named, and read again."""
        schema = df.schema
        # The table replaces what was shuffled for it, so those files go when the write is done.
        before = self.spark.conf.get(_CLEANUP, None)
        self.spark.conf.set(_CLEANUP, "true")
        try:
            df.write.mode("overwrite").option("compression", "zstd").partitionBy(*by).parquet(self.path(name))
        finally:
            self.spark.conf.unset(_CLEANUP) if before is None else self.spark.conf.set(_CLEANUP, before)
        return self.spark.read.schema(schema).parquet(self.path(name))

    def drop(self, *names: str) -> None:
        """Deletes tables that no later plan reads."""
        jvm = self.spark._jvm
        for name in names or ("",):
            where = jvm.org.apache.hadoop.fs.Path(self.path(name) if name else self.root)
            where.getFileSystem(self.spark._jsc.hadoopConfiguration()).delete(where, True)


def small(df: DataFrame, rows: int | None = None, limit: int = BROADCAST_ROWS) -> DataFrame:
    """`df` marked for broadcast if its counted rows are within the limit, else as it is, to be shuffled. `df` should be a written table."""
    return F.broadcast(df) if (df.count() if rows is None else rows) <= limit else df


def column_list(batch: pa.RecordBatch, name: str) -> list:
    return batch.column(batch.schema.get_field_index(name)).to_pylist()


def ascii_crc(column: str) -> F.Column:
    """crc32 of a column as text: the fold rule of the contracts."""
    return F.crc32(F.col(column).cast("string").cast("binary"))

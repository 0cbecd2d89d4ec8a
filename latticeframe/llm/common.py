"""Small helpers shared by the training-data operators."""

from __future__ import annotations

import tempfile
import uuid
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

#: ASCII white space, the only word separator of the operators that split into words.
ASCII_SPACE = " \t\n\x0b\x0c\r"
#: Bytes of text that Python takes at once
CHUNK_BYTES = 8 << 20


def ensure_checkpoint_dir(spark: SparkSession) -> str:
    """The shared folder for checkpoints. On one machine (local mode, as in tests) a session may name none."""
    folder = spark.conf.get("spark.checkpoint.dir", "") or ""
    if not folder:
        if spark.sparkContext.master.split("[")[0] != "local":
            raise ValueError("spark.checkpoint.dir must name a folder that driver and executors share")
        folder = tempfile.mkdtemp(prefix="lattice-ckpt-")
        spark.conf.set("spark.checkpoint.dir", folder)
    if spark.sparkContext.getCheckpointDir() is None:
        spark.sparkContext.setCheckpointDir(folder)
    return folder


def cut(df: DataFrame) -> DataFrame:
    """Materialise `df` in the shared checkpoint folder and cut its lineage."""
    ensure_checkpoint_dir(df.sparkSession)
    return df.checkpoint(eager=True)


def stored(df: DataFrame, name: str) -> DataFrame:
    """`df` written to the shared folder and read again: compressed on disk, cut from its lineage, safe to rescan."""
    spark = df.sparkSession
    path = f"{ensure_checkpoint_dir(spark).rstrip('/')}/{name}-{uuid.uuid4().hex}"
    df.write.parquet(path)
    table = spark.read.schema(df.schema).parquet(path)
    table._stored_at = path
    return table


def discard(*tables: DataFrame) -> None:
    """Delete what `stored` wrote, once everything that reads these tables has itself been written."""
    for table in tables:
        path = table.sparkSession._jvm.org.apache.hadoop.fs.Path(table._stored_at)
        path.getFileSystem(table.sparkSession._jsc.hadoopConfiguration()).delete(path, True)


def read_table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def only(df: DataFrame, **columns: str) -> DataFrame:
    """Exactly the named columns, cast: later helper columns can't clash with extra ones of the input."""
    return df.select(*(F.col(f"`{name}`").cast(kind).alias(name) for name, kind in columns.items()))


def row_slices(batch: pa.RecordBatch, rows: int = 256, limit: int = CHUNK_BYTES) -> Iterator[pa.RecordBatch]:
    """A batch in slices of at most `rows` rows and `limit` bytes of text; a longer text is a slice of its own."""
    total = np.zeros(batch.num_rows + 1, np.int64)
    for column in batch.columns:
        if pa.types.is_string(column.type) or pa.types.is_binary(column.type):
            total[1:] += np.cumsum(pc.fill_null(pc.binary_length(column), 0).to_numpy(zero_copy_only=False))
    at = 0
    while at < batch.num_rows:
        fits = int(np.searchsorted(total, total[at] + limit, side="right")) - 1
        end = max(at + 1, min(at + rows, fits, batch.num_rows))
        yield batch.slice(at, end - at)
        at = end


def map_rows(
    df: DataFrame, schema: T.StructType | str, make: Callable[[], Callable[..., list[tuple]]], chunk: int = 256
) -> DataFrame:
    """Rows to rows in Python, a few hundred at a time.

    `make()` is called once in each task and returns `f(*column_lists) -> list of output tuples`.
    Output batches follow input slices, so memory stays bounded by `chunk` rows and `CHUNK_BYTES` bytes of text (or one
    longer text) whatever the partition holds.
    """
    struct = T._parse_datatype_string(schema) if isinstance(schema, str) else schema
    from pyspark.sql.pandas.types import to_arrow_schema

    out_schema = to_arrow_schema(struct)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        f = make()
        for batch in batches:
            for part in row_slices(batch, chunk):
                rows = f(*(c.to_pylist() for c in part.columns))
                if rows:
                    cols = list(zip(*rows, strict=True))
                    yield pa.RecordBatch.from_arrays(
                        [pa.array(c, type=t.type) for c, t in zip(cols, out_schema, strict=True)], schema=out_schema
                    )

    return df.mapInArrow(run, struct)

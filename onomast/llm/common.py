"""What the training-data operators share: Arrow batch handling, settling of intermediate tables."""

from __future__ import annotations

import ctypes
import gc
import os
import tempfile
import uuid
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.pandas.types import to_arrow_schema
from pyspark.sql.types import StructField, StructType

#: Bytes of text that a Python worker holds in working arrays at once.
SLICE_BYTES = 2 << 20
BATCH_ROWS = 2000


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def checkpoint_dir(spark: SparkSession) -> str:
    """The shared folder of the session. Only in local mode, where all tasks share the machine, one is made where none is set."""
    found = spark.conf.get("spark.checkpoint.dir", None)
    if not found:
        if not spark.sparkContext.master.startswith("local"):
            raise RuntimeError("set spark.checkpoint.dir to a folder that driver and executors share")
        found = os.path.join(tempfile.gettempdir(), "onomast-checkpoints")
        spark.sparkContext.setCheckpointDir(found)
    return found


def settle(df: DataFrame) -> DataFrame:
    """Cuts the lineage with a reliable checkpoint in the shared folder."""
    checkpoint_dir(df.sparkSession)
    return df.checkpoint(eager=True)


#: Tables of `settle_table` that this process has written and not deleted.
SETTLED: list[str] = []


def settle_table(df: DataFrame) -> DataFrame:
    """Cuts the lineage with a Parquet table in the shared folder: columns compress well, and it is read more than once. Its size on
    disk is known to the planner, which broadcasts it only below spark.sql.autoBroadcastJoinThreshold. See `drop_settled`."""
    spark = df.sparkSession
    path = f"{checkpoint_dir(spark).rstrip('/')}/onomast-{uuid.uuid4().hex}"
    SETTLED.append(path)
    df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def drop_settled(spark: SparkSession, since: int = 0, keep: DataFrame | None = None) -> None:
    """Deletes settled tables, from the `since`-th on, but for those that `keep` reads. For when no result needs them any more."""
    kept = {f.rsplit("/", 2)[-2] for f in keep.inputFiles()} if keep is not None else set()
    path_of = spark._jvm.org.apache.hadoop.fs.Path
    for path in [x for x in SETTLED[since:] if x.rsplit("/", 1)[-1] not in kept]:
        where = path_of(path)
        where.getFileSystem(spark._jsparkSession.sessionState().newHadoopConf()).delete(where, True)
        SETTLED.remove(path)


def small_batches(spark: SparkSession) -> None:
    """Bounds the rows of an Arrow batch: texts are long, and a worker holds a batch or two."""
    if int(spark.conf.get("spark.sql.execution.arrow.maxRecordsPerBatch")) > BATCH_ROWS:
        spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", str(BATCH_ROWS))


def release() -> None:
    """Gives a worker's freed memory back to the system: workers live on, and the next stage may need it."""
    pa.default_memory_pool().release_unused()
    try:
        ctypes.CDLL(None).malloc_trim(0)
    except (AttributeError, OSError):  # another C library
        pass


#: By operator's module: drops what its tasks leave in a worker for the next one, and says whether there was anything.
LEFT: dict[str, Callable[[], bool]] = {}


def make_room(module: str) -> None:
    """Drops what tasks of other operators than `module` left in this worker: workers live on through all stages, and what one stage left would
    count in each that follows. Only what is made again on demand is left, so no result depends on it."""
    if any([drop() for name, drop in LEFT.items() if name != module]):
        gc.collect()
        release()


def slices(batch: pa.RecordBatch, column: str, limit: int = SLICE_BYTES) -> Iterator[pa.RecordBatch]:
    """Cuts a batch into slices whose texts hold about `limit` bytes; one row may exceed it alone."""
    if batch.num_rows == 0:
        return
    col = batch.column(batch.schema.get_field_index(column))
    size = np.asarray(pc.fill_null(pc.binary_length(col), 0), np.int64)
    part = np.cumsum(size) // limit
    cuts = np.flatnonzero(np.diff(part)) + 1
    for lo, hi in zip([0, *cuts.tolist()], [*cuts.tolist(), batch.num_rows], strict=True):
        yield batch.slice(lo, hi - lo)


def per_slice(df: DataFrame, fn: Callable[[pa.RecordBatch], dict[str, object]], schema: str | StructType, text: str = "text", limit: int = SLICE_BYTES) -> DataFrame:
    """Applies `fn` to slices of Arrow batches; it returns column name -> array-like. Without `text`, batches are not cut."""
    small_batches(df.sparkSession)
    made = to_arrow_schema(StructType.fromDDL(schema) if isinstance(schema, str) else schema)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        make_room(fn.__module__)
        for batch in batches:
            for part in slices(batch, text, limit) if text else [batch]:
                got = fn(part)
                cols = [got[f.name] for f in made]
                cols = [c.cast(f.type) if isinstance(c, (pa.Array, pa.ChunkedArray)) else pa.array(c, f.type) for c, f in zip(cols, made, strict=True)]
                yield pa.RecordBatch.from_arrays([c.combine_chunks() if isinstance(c, pa.ChunkedArray) else c for c in cols], schema=made)
        release()

    return df.mapInArrow(run, schema)


def texts_of(batch: pa.RecordBatch, column: str = "text") -> list[str]:
    """The texts of a slice, null as empty."""
    return [x or "" for x in batch.column(batch.schema.get_field_index(column)).to_pylist()]


def crc_mod(column: str, n: int):
    """crc32 of the id as text, modulo n: the fold rule of the contracts."""
    return F.crc32(F.col(column).cast("string").cast("binary")) % n


def carried(docs: DataFrame, fn: Callable[[pa.RecordBatch], dict[str, object]], extra: str) -> DataFrame:
    """Like per_slice, with each row of `docs` beside what `fn` returns, as the struct `row`: its columns keep their names and
    cannot clash with the new ones. `fn` gets doc_id, text, row."""
    schema = StructType([StructField("row", docs.schema), *StructType.fromDDL(extra).fields])
    whole = docs.select(F.struct(*[F.col(f"`{c}`") for c in docs.columns]).alias("row"))
    small_batches(docs.sparkSession)
    made = to_arrow_schema(schema)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        make_room(fn.__module__)
        for batch in batches:
            row = batch.column(0)
            view = pa.RecordBatch.from_arrays([row.field("doc_id"), row.field("text"), row], names=["doc_id", "text", "row"])
            for part in slices(view, "text"):
                got = fn(part) | {"row": part.column(2)}
                yield pa.RecordBatch.from_arrays([got[f.name].cast(f.type) if isinstance(got[f.name], pa.Array) else pa.array(got[f.name], f.type) for f in made], schema=made)
        release()

    return whole.mapInArrow(run, schema)

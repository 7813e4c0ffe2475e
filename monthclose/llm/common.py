"""What several of the operators need: tables, lineage cuts, row keys, Arrow columns as numpy arrays."""

from __future__ import annotations

import os
import tempfile
import zipfile
from collections.abc import Callable, Iterator, Sequence
from pathlib import Path

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

WHITE = r"[\x20\x09-\x0D]+"
WORD = r"[^\x20\x09-\x0D]+"
ROW_KEY = ("__key_a", "__key_b")


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def shared_folder(spark: SparkSession) -> str:
    """The folder all executors see, as the cluster names it. A local session may do without: it has one machine."""
    named = spark.conf.get("spark.checkpoint.dir", None) or spark.sparkContext.getCheckpointDir()
    if not named:
        if not spark.sparkContext.master.startswith("local"):
            raise ValueError("spark.checkpoint.dir must name a folder that driver and executors share")
        named = tempfile.mkdtemp(prefix="checkpoint-")
    return named


def remove_folder(spark: SparkSession, folder: str) -> None:
    path = spark._jvm.org.apache.hadoop.fs.Path(folder)
    path.getFileSystem(spark._jsc.hadoopConfiguration()).delete(path, True)


def settle(df: DataFrame) -> DataFrame:
    """``df`` written to the shared checkpoint folder and read from there: no lineage, survives lost executors."""
    context = df.sparkSession.sparkContext
    if not context.getCheckpointDir():
        context.setCheckpointDir(shared_folder(df.sparkSession))
    return df.checkpoint()


def ship_package(spark: SparkSession) -> None:
    """Send this package to the executors, so that functions in it can be loaded there wherever they run."""
    context = spark.sparkContext
    if any(path.endswith("monthclose.zip") for path in context._python_includes):
        return
    root = Path(__file__).resolve().parents[1]
    archive = os.path.join(tempfile.mkdtemp(prefix="package-"), "monthclose.zip")
    with zipfile.ZipFile(archive, "w") as out:
        for source in sorted(root.rglob("*.py")):
            out.write(source, f"monthclose/{source.relative_to(root)}")
    context.addPyFile(archive)


def text_or_empty(text: str = "text") -> Column:
    return F.coalesce(F.col(text), F.lit(""))


def columns_of(df: DataFrame) -> list[Column]:
    """All columns by name, whatever characters the names hold."""
    return [F.col("`" + c.replace("`", "``") + "`") for c in df.columns]


def carried(df: DataFrame) -> DataFrame:
    """All columns of ``df`` as one column ``row``, so that none can share a name with what is computed beside them;
    ``select("row.*")`` gives them back as they were."""
    return df.select(F.struct(*columns_of(df)).alias("row"))


def with_row_key(rows: DataFrame) -> DataFrame:
    """``rows`` (row) plus two 64-bit hashes of doc_id and text; rows that agree in both columns share them, null and
    '' differ."""
    key, text, absent = F.col("row.doc_id"), F.col("row.text"), F.col("row.text").isNull()
    return rows.withColumns(
        {ROW_KEY[0]: F.xxhash64(key, text, absent), ROW_KEY[1]: F.xxhash64(absent, text, key, F.lit(1))}
    )


def one_row_per_key(rows: DataFrame, staying: DataFrame) -> DataFrame:
    """The rows (row, with their key) whose key is in ``staying`` (the key, n: how many rows share it), one for each
    key. Only keys of several rows are grouped, after a map-side combine; all others pass as they are."""
    kept = rows.join(staying, list(ROW_KEY))
    alone = kept.where("n = 1").select("row")
    alike = kept.where("n > 1").groupBy(*ROW_KEY).agg(F.first("row").alias("row")).select("row")
    return alone.unionByName(alike).select("row.*")


def crc_share(key: str, modulus: int) -> Column:
    """crc32 of the id as text, modulo ``modulus``; a null id counts as an empty text."""
    return F.crc32(F.coalesce(F.col(key).cast("string"), F.lit("")).cast("binary")) % modulus


_STATE: dict = {}


def worker_state(name: str, value, make: Callable):
    """``make(value)``, kept by this worker until another name or value is asked for. One slot for all operators: a
    worker that Spark uses again in a later stage holds nothing of the earlier ones."""
    key = (name, value)
    if key not in _STATE:
        _STATE.clear()
        _STATE[key] = make(value)
    return _STATE[key]


def numbers(column: pa.Array | pa.ChunkedArray, dtype=np.int64) -> np.ndarray:
    return column.to_numpy(zero_copy_only=False).astype(dtype, copy=False)


def raw_bytes(column: pa.Array, width: int) -> np.ndarray:
    """A binary column whose values are all ``width`` bytes long, as a matrix of bytes."""
    offsets = np.frombuffer(column.buffers()[1], np.int32)[column.offset : column.offset + len(column) + 1]
    data = column.buffers()[2]
    flat = np.frombuffer(data, np.uint8) if data is not None else np.empty(0, np.uint8)
    return flat[offsets[0] : offsets[-1]].reshape(-1, width)


def utf8(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """The bytes of a text column, and where each text starts and the last ends; nulls are empty."""
    if column.null_count:
        column = column.fill_null("")
    offsets = np.frombuffer(column.buffers()[1], np.int32)[column.offset : column.offset + len(column) + 1]
    data = column.buffers()[2]
    flat = np.frombuffer(data, np.uint8) if data is not None else np.empty(0, np.uint8)
    return flat[offsets[0] : offsets[-1]], (offsets - offsets[0]).astype(np.int64)


def runs(batches: Iterator[pa.RecordBatch], keys: Sequence[str]) -> Iterator[tuple[tuple, pa.RecordBatch]]:
    """Slices of sorted batches in which all ``keys`` (whole numbers) stay the same; a run may come in several."""
    for batch in batches:
        if not batch.num_rows:
            continue
        columns = [numbers(batch.column(k)) for k in keys]
        change = np.zeros(batch.num_rows, bool)
        change[0] = True
        for c in columns:
            change[1:] |= c[1:] != c[:-1]
        starts = np.flatnonzero(change)
        ends = np.append(starts[1:], batch.num_rows)
        for a, b in zip(starts.tolist(), ends.tolist(), strict=True):
            yield tuple(int(c[a]) for c in columns), batch.slice(a, b - a)


def whole_numbers(column: pa.Array, scale: int) -> np.ndarray:
    """floor(scale * x) of the components x of vectors, as a matrix; all are of one length, without nulls."""
    width = len(column[0]) if len(column) else 0
    scaled = np.floor(numbers(column.flatten(), np.float64).reshape(len(column), width) * scale)
    if scaled.size and np.abs(scaled).max() >= 2.0**62:
        raise OverflowError("a vector's component does not fit a 64-bit whole number")
    return scaled.astype(np.int64)

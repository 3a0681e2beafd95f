"""Helpers shared by the training-data operators: staging in the shared folder, byte-level word layout."""

from __future__ import annotations

import atexit
import shutil
import tempfile
import uuid
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession

#: White space of the word rule `[^\x20\x09-\x0D]+`, as a regular expression class.
SPACE = r"[\x20\x09-\x0D]"
WORD = r"[^\x20\x09-\x0D]+"

_IS_SPACE = np.zeros(256, bool)
_IS_SPACE[[0x20, *range(0x09, 0x0E)]] = True
_LOWER = np.arange(256, dtype=np.uint8)
_LOWER[ord("A") : ord("Z") + 1] += 32


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def shared_dir(spark: SparkSession) -> str:
    """The folder every executor sees: spark.checkpoint.dir, or a folder of our own where it is unset and all run here (tests)."""
    at = spark.conf.get("spark.checkpoint.dir", None)
    if at:
        return at.rstrip("/")
    if not spark.sparkContext.master.startswith("local[") and spark.sparkContext.master != "local":
        raise ValueError("spark.checkpoint.dir is to name a folder that the driver and all executors share")
    own = getattr(shared_dir, "own", None)
    if own is None:
        own = shared_dir.own = tempfile.mkdtemp(prefix="folioflow-")
        atexit.register(shutil.rmtree, own, ignore_errors=True)
    return f"file://{own}"


def staged(df: DataFrame, what: str) -> DataFrame:
    """Write df as Parquet to the shared folder and read it back: lineage is cut, and a lost executor costs nothing."""
    path = f"{shared_dir(df.sparkSession)}/{what}-{uuid.uuid4().hex}"
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def discard(df: DataFrame) -> None:
    """Delete the table that `staged` wrote for df; for tables between rounds that nothing reads any more."""
    spark = df.sparkSession
    for name in {f.rsplit("/", 1)[0] for f in df.inputFiles()}:
        at = spark._jvm.org.apache.hadoop.fs.Path(name)
        at.getFileSystem(spark._jsc.hadoopConfiguration()).delete(at, True)


def text_slices(batch: pa.RecordBatch, column: str, target: int = 2 << 20) -> Iterator[tuple[int, int, np.ndarray, np.ndarray]]:
    """Cut a batch into row ranges of about `target` text bytes; a longer text is one range of its own.

    Yields (first row, end row, bytes, offsets); offsets has one more entry than rows. A null text has no bytes.
    """
    col = batch.column(batch.schema.get_field_index(column))
    if not pa.types.is_large_string(col.type):
        col = col.cast(pa.large_string())
    n = len(col)
    if not n:
        return
    if col.null_count:
        col = col.fill_null("")
    _, offs, data = col.buffers()
    off = np.frombuffer(offs, np.int64, n + 1, col.offset * 8)
    buf = np.frombuffer(data, np.uint8) if data is not None and data.size else np.zeros(0, np.uint8)
    lo = 0
    while lo < n:
        hi = max(lo + 1, int(np.searchsorted(off, off[lo] + target, "right")) - 1)
        hi = min(hi, n)
        yield lo, hi, buf[off[lo] : off[hi]], off[lo : hi + 1] - off[lo]
        lo = hi


def words_of(buf: np.ndarray, off: np.ndarray, lower: bool) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """Words of each text, re-spaced by single blanks.

    Returns (bytes, start, end, first): `bytes` holds the words with one blank after each, start and end delimit word i,
    and words first[d]..first[d+1] belong to text d.
    """
    space = _IS_SPACE[buf]
    head = np.zeros(len(buf) + 1, bool)
    head[off[:-1]] = True
    head = head[: len(buf)]
    before = np.empty(len(buf), bool)
    if len(buf):
        before[0], before[1:] = True, space[:-1]
    starts = np.flatnonzero(~space & (before | head))
    after = np.empty(len(buf), bool)
    if len(buf):
        after[-1], after[:-1] = True, space[1:] | head[1:]
    ends = np.flatnonzero(~space & after) + 1
    lengths = ends - starts
    out_start = np.concatenate([[0], np.cumsum(lengths + 1)]).astype(np.int64)
    out = np.full(int(out_start[-1]), 0x20, np.uint8)
    solid = np.flatnonzero(~space)
    out[solid - np.repeat(starts - out_start[:-1], lengths)] = (_LOWER[buf] if lower else buf)[solid]
    return out, out_start[:-1], out_start[:-1] + lengths, np.searchsorted(starts, off)

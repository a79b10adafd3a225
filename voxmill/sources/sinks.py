"""Sinks: segment tables, split outputs, ledgers, reports, WAV bytes."""

from __future__ import annotations

import uuid
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyarrow import fs
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from voxmill.functions.audio import encode_wav


def write_table(df: DataFrame, path: str, *partitions: str) -> None:
    """Replace a Parquet table: it is written whole beside the old one, which stays until then, and takes its place by renaming.

    If a run is lost between the two renames, the old table lies at <path>.old and is put back by the next call.
    """
    sc = df.sparkSession.sparkContext
    hadoop = sc._jvm.org.apache.hadoop.fs.Path
    target, old, new = (hadoop(x) for x in (path.rstrip("/"), f"{path.rstrip('/')}.old", f"{path.rstrip('/')}.{uuid.uuid4().hex}.new"))
    store = target.getFileSystem(sc._jsc.hadoopConfiguration())
    if store.exists(old) and not store.exists(target):
        store.rename(old, target)
    try:
        (df.write.partitionBy(*partitions) if partitions else df.write).parquet(new.toString())
    except Exception:
        store.delete(new, True)
        raise
    store.delete(old, True)
    if store.exists(target) and not store.rename(target, old):
        raise OSError(f"{path} can't be moved")
    if not store.rename(new, target):
        raise OSError(f"{new} can't be moved to {path}")
    store.delete(old, True)


def write_split(classified: DataFrame, path: str, column: str = "decision") -> None:
    """One table partitioned by decision: kept and rejected rows from one pass."""
    write_table(classified, path, column)


def write_json(df: DataFrame, path: str) -> None:
    df.write.mode("overwrite").json(path)


def report_row(sections: dict[str, DataFrame]) -> DataFrame:
    """One row with a JSON text for each section; sections are small reports."""
    out = None
    for name, df in sections.items():
        one = df.agg(F.to_json(F.collect_list(F.struct(*[F.col(f"`{c}`") for c in df.columns]))).alias(name))
        out = one if out is None else out.crossJoin(one)  # one row with one row
    return out


def record(ledger: DataFrame | None, results: DataFrame) -> DataFrame:
    """The ledger (video_id, status, error, updated_at) with the results of a run: the newest row of each video counts."""
    new = results.select("video_id", "status", "error", F.current_timestamp().alias("updated_at"))
    both = new if ledger is None else ledger.unionByName(new)
    latest = both.groupBy("video_id").agg(F.max_by(F.struct("status", "error", "updated_at"), "updated_at").alias("x"))
    return latest.select("video_id", "x.*")


def write_wavs(waves: DataFrame, folder: str) -> DataFrame:
    """Write (segment_id, sr, samples) as 16-bit WAV files to a folder that executors share; segment_id, path, status and error of each.

    A file appears under its name when it is whole, so that a task may run again. Nothing is written before the result is read.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        target, root = fs.FileSystem.from_uri(folder if "://" in folder else f"file://{folder}")
        target.create_dir(root, recursive=True)
        for batch in batches:
            rows = []
            for i, (ident, sr) in enumerate(zip(batch.column("segment_id").to_pylist(), batch.column("sr").to_pylist(), strict=True)):
                path = f"{root}/{ident}.wav"
                try:
                    samples = batch.column("samples")[i].values  # one waveform at a time
                    if samples is None:
                        raise ValueError("no samples")
                    part = f"{path}.{uuid.uuid4().hex}.part"
                    with target.open_output_stream(part) as out:
                        out.write(encode_wav(samples.to_numpy(zero_copy_only=False).astype(np.float64), sr))
                    target.move(part, path)
                    rows.append((ident, path, "success", None))
                except Exception as e:  # one bad record doesn't end the run
                    rows.append((ident, None, "failed", f"{type(e).__name__}: {e}"))
            cols = list(zip(*rows, strict=True)) or [[]] * 4
            yield pa.RecordBatch.from_pydict({n: pa.array(c, pa.string()) for n, c in zip(("segment_id", "path", "status", "error"), cols, strict=True)})

    return waves.select(F.col("segment_id").cast("string"), "sr", "samples").mapInArrow(run, "segment_id string, path string, status string, error string")

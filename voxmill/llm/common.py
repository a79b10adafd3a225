"""Shared helpers: table access, the shared folder, label folds and bounded Arrow batches."""

from __future__ import annotations

import uuid
from collections.abc import Iterator

import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from voxmill.session import cut, shared_dir

__all__ = ["by_key", "cut", "fold", "fresh_path", "label_sample", "shared_dir", "small_batches", "spread", "table", "texts_of", "unique_labels", "unused", "whole_groups"]


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def spread(df: DataFrame) -> DataFrame:
    """df dealt out to every core where its files can't be split into as many parts; else as it is."""
    cores = df.sparkSession.sparkContext.defaultParallelism
    return df.repartition(cores) if df.rdd.getNumPartitions() < cores else df


def fresh_path(spark: SparkSession, name: str) -> str:
    return f"{shared_dir(spark).rstrip('/')}/{name}-{uuid.uuid4().hex}"


def unused(df: DataFrame, name: str) -> str:
    """name, with as many underscores in front as keep it apart from the columns of df."""
    taken = {c.lower() for c in df.columns}
    while name.lower() in taken:
        name = f"_{name}"
    return name


def fold(column: str, folds: int):
    """crc32 of the id as text, modulo folds; null ids count as the empty text."""
    return F.crc32(F.coalesce(F.col(column).cast("string"), F.lit("")).cast("binary")) % folds


def unique_labels(labels: DataFrame, column: str) -> DataFrame:
    """One (doc_id, label) per labelled document: the largest non-null label where rows repeat."""
    return (
        labels.where(F.col("doc_id").isNotNull() & F.col(column).isNotNull())
        .groupBy("doc_id")
        .agg(F.max(F.col(column).cast("int")).alias("label"))
    )


def label_sample(labels: DataFrame, column: str, keep, limit: int) -> DataFrame:
    """At most `limit` labelled rows that satisfy `keep`, chosen by a hash of the id: of proven size, so it may be broadcast.

    Of more rows than that a share by hash is taken first, so that the final order sees about `limit` rows from all partitions together.
    """
    rows = unique_labels(labels, column).where(keep)
    share = min(1.0, limit / max(rows.count(), 1))
    place = F.xxhash64("doc_id")
    if share < 1:
        rows = rows.where(F.pmod(place, F.lit(1 << 30)) < int(share * (1 << 30)))
    return rows.orderBy(place, "doc_id").limit(limit)


def small_batches(batches: Iterator[pa.RecordBatch], text: str, max_bytes: int = 1 << 20) -> Iterator[pa.RecordBatch]:
    """The same rows in slices of at most max_bytes of the text column (single longer texts stand alone)."""
    for batch in batches:
        sizes = pc.binary_length(batch.column(text)).fill_null(0).to_pylist()
        start = total = 0
        for i, size in enumerate(sizes):
            if i > start and total + size > max_bytes:
                yield batch.slice(start, i - start)
                start, total = i, 0
            total += size
        if start < len(sizes):
            yield batch.slice(start)


def texts_of(batch: pa.RecordBatch, name: str = "text") -> list[str]:
    """The column as Python texts, null as the empty text."""
    return [t or "" for t in batch.column(name).to_pylist()]


def whole_groups(batches: Iterator[pa.RecordBatch], keys: list[str]) -> Iterator[pa.RecordBatch]:
    """Of rows sorted by `keys`, batches that hold whole groups only: a group that a batch cuts waits for its rest."""
    waiting: list[pa.RecordBatch] = []
    for batch in batches:
        if not batch.num_rows:
            continue
        n = batch.num_rows
        key = [batch.column(k)[n - 1].as_py() for k in keys]
        last = n - 1
        while last and [batch.column(k)[last - 1].as_py() for k in keys] == key:
            last -= 1
        if not last:  # one group fills the batch: it may go on, and waiting rows may belong to it
            if waiting and [waiting[-1].column(k)[-1].as_py() for k in keys] != key:
                yield _joined(waiting)
                waiting = []
            waiting.append(batch)
            continue
        yield _joined([*waiting, batch.slice(0, last)])
        waiting = [batch.slice(last)]
    if waiting:
        yield _joined(waiting)


def _joined(parts: list[pa.RecordBatch]) -> pa.RecordBatch:
    return parts[0] if len(parts) == 1 else pa.Table.from_batches(parts).combine_chunks().to_batches()[0]


def by_key(df: DataFrame, *keys: str) -> DataFrame:
    """Rows of a key together in one partition, in order of the keys: for groups of bounded size."""
    return df.repartition(*keys).sortWithinPartitions(*keys)

"""Greedy batching of files under a byte and a file limit.

Files are taken in order; a batch closes when the next file would take it over
the byte limit (a single file always fits) or when it has reached the file limit.
Where a batch starts depends on where the one before it started, so this is a
sequential walk over each folder. To keep a huge folder off a single task the walk
is split: a batch never exceeds ``max_files``, so the walk enters a chunk of files
at one of its first ``max_files`` places. Each chunk works out, for all those entry
places, where the walk leaves and how many batches begin inside; the chunk
summaries are chained per folder; then every chunk numbers its own files.
"""

from __future__ import annotations

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from texelframe.session import cut_lineage

# Input bytes and files per batch.
MAX_BATCH_BYTES = 104_857_600
MAX_BATCH_FILES = 500

CHUNK_FILES = 500_000


def number_in_order(df: DataFrame, by: list[str], order: list[str]) -> DataFrame:
    """Add ``_pos``, the 0-based place within each group, without one task per group.

    Range partitioning puts the total order over many partitions; a place is the
    index inside the partition plus the group's rows in earlier partitions.
    """
    placed = df.repartitionByRange(*by, *order).sortWithinPartitions(*by, *order)
    # The partition layout is sampled, so it has to be pinned before it is counted.
    placed = cut_lineage(
        placed.withColumns({"_part": F.spark_partition_id(), "_id": F.monotonically_increasing_id()})
    )
    earlier = Window.partitionBy(*by).orderBy("_part").rowsBetween(Window.unboundedPreceding, -1)
    offsets = (
        placed.groupBy(*by, "_part")
        .agg(F.count(F.lit(1)).alias("_n"), F.min("_id").alias("_first"))
        .withColumn("_before", F.coalesce(F.sum("_n").over(earlier), F.lit(0)))
        .drop("_n")
    )
    numbered = join_null_safe(placed, offsets, [*by, "_part"])
    return numbered.withColumn("_pos", F.col("_id") - F.col("_first") + F.col("_before")).drop(
        "_part", "_id", "_first", "_before"
    )


def join_null_safe(left: DataFrame, right: DataFrame, keys: list[str]) -> DataFrame:
    """Inner join in which null keys are equal; keys come once, from the left."""
    renamed = right.withColumnsRenamed({k: f"_right_{k}" for k in keys})
    same = [F.col(k).eqNullSafe(F.col(f"_right_{k}")) for k in keys]
    return left.join(renamed, same).drop(*[f"_right_{k}" for k in keys])


def next_starts(sizes: np.ndarray, max_bytes: int, max_files: int) -> np.ndarray:
    """For a batch starting at each place, the place where the next one starts."""
    n = len(sizes)
    ends = np.concatenate([[0], np.cumsum(sizes)])
    at = np.arange(n)
    fits = np.searchsorted(ends, ends[:-1] + max_bytes, side="right") - 1
    return np.minimum(np.maximum(fits, at + 1), at + max_files)


def summarize_chunk(sizes: np.ndarray, own: int, max_bytes: int, max_files: int) -> tuple[np.ndarray, np.ndarray]:
    """Per entry place: where the walk leaves, counted from the chunk's end, and starts inside.

    ``sizes`` holds the chunk's own files followed by the margin of the next chunk.
    Following the walk in doubling steps handles all entry places at once.
    """
    jump = np.concatenate([next_starts(sizes, max_bytes, max_files), [len(sizes)]])
    places = np.arange(len(jump))
    outside = places >= own
    jump = np.where(outside, places, jump)
    starts = np.where(outside, 0, 1)
    while not outside[jump].all():
        starts = starts + starts[jump]
        jump = jump[jump]
    entries = np.minimum(np.arange(max_files), len(sizes))
    return jump[entries] - own, starts[entries]


def assign_batches(
    files: DataFrame,
    max_bytes: int = MAX_BATCH_BYTES,
    max_files: int = MAX_BATCH_FILES,
    by: tuple[str, ...] = ("dir",),
    order: tuple[str, ...] = ("path",),
    chunk_files: int = CHUNK_FILES,
) -> DataFrame:
    """Add ``batch_id``, counted from 0 within each folder, in the given order.

    ``order`` must be a total order inside a folder. A null folder is one like others; a file
    of unknown size counts as empty. A task holds ``chunk_files`` files and the entry places of
    a chunk, so ``max_files`` may not be above that.
    """
    if max_files > chunk_files:
        raise ValueError("max_files above chunk_files: a task would have to hold more files than chunk_files")
    by = list(by)
    numbered = number_in_order(files, by, list(order)).withColumns(
        {"_chunk": F.floor(F.col("_pos") / chunk_files), "_at": F.col("_pos") % chunk_files}
    )
    # Files near a chunk's start also serve as margin of the chunk before.
    margin = (F.col("_at") < max_files) & (F.col("_chunk") > 0)
    sizes = numbered.select(
        *by,
        F.explode(F.array_compact(F.array(
            F.struct(F.col("_chunk"), F.col("_at")),
            F.when(margin, F.struct((F.col("_chunk") - 1).alias("_chunk"), (F.col("_at") + chunk_files).alias("_at"))),
        ))).alias("p"),
        F.coalesce(F.col("n_bytes").cast("bigint"), F.lit(0)).alias("n_bytes"),
    ).select(*by, "p.*", "n_bytes")
    key_fields = [files.schema[c] for c in by]
    long = T.LongType()

    def summarize(rows: pd.DataFrame) -> pd.DataFrame:
        rows = rows.sort_values("_at")
        own = int((rows["_at"] < chunk_files).sum())
        leave, starts = summarize_chunk(rows["n_bytes"].to_numpy(), own, max_bytes, max_files)
        summary = rows[[*by, "_chunk"]].iloc[:1].copy()
        summary["_leave"], summary["_starts"] = [leave.tolist()], [starts.tolist()]
        return summary

    def chain(rows: pd.DataFrame) -> pd.DataFrame:
        rows = rows.sort_values("_chunk")
        entry, first = 0, 0
        entries, firsts = [], []
        for leave, starts in zip(rows["_leave"], rows["_starts"]):
            entries.append(entry)
            firsts.append(first)
            entry, first = int(leave[entry]), first + int(starts[entry])
        return rows[[*by, "_chunk"]].assign(_entry=entries, _first=firsts)

    def number(rows: pd.DataFrame) -> pd.DataFrame:
        rows = rows.sort_values("_at")
        own = int((rows["_at"] < chunk_files).sum())
        jump = next_starts(rows["n_bytes"].to_numpy(), max_bytes, max_files)
        begins = np.zeros(len(rows), dtype=np.int64)
        at = int(rows["_entry"].iloc[0])
        while at < own:
            begins[at] = 1
            at = jump[at]
        batch = rows["_first"].iloc[0] - 1 + np.cumsum(begins)
        return rows[[*by, "_chunk", "_at"]].assign(batch_id=batch).iloc[:own]

    lists = [T.StructField(c, T.ArrayType(long)) for c in ("_leave", "_starts")]
    chunk_key = [*key_fields, T.StructField("_chunk", long)]
    summaries = sizes.groupBy(*by, "_chunk").applyInPandas(summarize, T.StructType(chunk_key + lists))
    # One short row per chunk_files files.
    walk = summaries.groupBy(*by).applyInPandas(
        chain, T.StructType(chunk_key + [T.StructField("_entry", long), T.StructField("_first", long)])
    )
    placed = T.StructType(chunk_key + [T.StructField("_at", long), T.StructField("batch_id", long)])
    batches = join_null_safe(sizes, walk, [*by, "_chunk"]).groupBy(*by, "_chunk").applyInPandas(number, placed)
    return join_null_safe(numbered, batches, [*by, "_chunk", "_at"]).drop("_chunk", "_at", "_pos")


def batch_report(batched: DataFrame, by: tuple[str, ...] = ("dir",)) -> DataFrame:
    """Files and bytes of each batch."""
    return batched.groupBy(*by, "batch_id").agg(
        F.count(F.lit(1)).alias("n_files"), F.sum("n_bytes").cast("bigint").alias("total_bytes")
    )

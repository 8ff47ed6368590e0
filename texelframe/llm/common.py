"""Helpers shared by the operators of this subpackage."""

from __future__ import annotations

import gc
import itertools
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from texelframe.session import cut_lineage

SLICE_BYTES = 2_000_000


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def stored(df: DataFrame) -> DataFrame:
    """df written once as Parquet into the shared folder and read from there; removed when the session ends."""
    return cut_lineage(df)


def crc_mod(doc_id: Column, n: int) -> Column:
    """crc32 of doc_id as text, modulo n; a null id counts as empty text."""
    return F.crc32(F.coalesce(doc_id.cast("string"), F.lit("")).cast("binary")) % n


def slices(batch: pa.RecordBatch, column: str) -> Iterator[pa.RecordBatch]:
    """A batch in runs of rows of about SLICE_BYTES of text, so that long texts don't add up; no text is cut."""
    sizes = pc.fill_null(pc.binary_length(batch.column(column)), 0).to_numpy(zero_copy_only=False)
    run = np.cumsum(sizes, dtype=np.int64) // SLICE_BYTES
    edges = [0, *(np.flatnonzero(np.diff(run)) + 1).tolist(), len(sizes)] if len(sizes) else []
    for a, b in zip(edges, edges[1:]):
        if b > a:
            # copied: some Arrow kernels misread the text of sliced arrays
            yield batch.take(pa.array(np.arange(a, b)))


class Words:
    """The white-space separated words of a column of texts, as codes into the distinct words.

    codes      the code of every word, texts one after another
    ends       for each text, the number of words up to its end
    distinct   the words as an Arrow array of strings
    White space is the ASCII one: 0x20 and 0x09 to 0x0D. A null text has no word.
    """

    def __init__(self, texts: pa.Array):
        parts = pc.ascii_split_whitespace(pc.fill_null(texts, "").cast(pa.large_string()))
        coded = pc.dictionary_encode(parts.values)
        codes = coded.indices.to_numpy(zero_copy_only=False)
        ends = parts.offsets.to_numpy()[1:].astype(np.int64) - parts.offsets[0].as_py()
        empty = pc.index(coded.dictionary, pa.scalar("", coded.dictionary.type)).as_py()
        if empty >= 0:  # before leading and after trailing white space
            keep = codes != empty
            ends = np.concatenate([[0], np.cumsum(keep)])[ends]
            codes = codes[keep]
        self.codes, self.ends, self.distinct = codes, ends, coded.dictionary

    @property
    def starts(self) -> np.ndarray:
        return np.concatenate([[0], self.ends[:-1]]).astype(np.int64)

    @property
    def counts(self) -> np.ndarray:
        return np.diff(self.ends, prepend=0)

    def rows(self) -> np.ndarray:
        """For every word, the index of its text."""
        return np.repeat(np.arange(len(self.ends)), self.counts)


class Memo:
    """A cache of words that holds at most about `limit` bytes.

    It has two generations, of which the older is forgotten when the younger is full. Words of more than
    `LONG_WORD` characters aren't kept: they are rare, and as many of them as short ones would be any size.
    """

    LONG_WORD = 64
    OVERHEAD = 250  # bytes of an entry besides its value: the word, objects and their place in a dictionary

    def __init__(self, limit: int):
        self.limit, self.held, self.young, self.old = limit // 2, 0, {}, {}

    def find(self, words: list[str]) -> tuple[list[bytes | None], list[int]]:
        """The value of each word, and the places of words that have none."""
        found = [*map(self.young.get, words)]
        missing = [k for k, x in enumerate(found) if x is None]
        if missing and self.old:
            older = [*map(self.old.get, map(words.__getitem__, missing))]
            known = {words[k]: x for k, x in zip(missing, older) if x is not None}
            for k, x in zip(missing, older):
                found[k] = x
            self.keep(known)
            missing = [k for k in missing if found[k] is None]
        return found, missing

    def keep(self, values: dict[str, bytes]) -> None:
        if max(map(len, values), default=0) > self.LONG_WORD:
            values = {w: x for w, x in values.items() if len(w) <= self.LONG_WORD}
        size = self.OVERHEAD * len(values) + sum(map(len, values.values()))
        if self.held + size > self.limit:
            self.old, self.young, self.held = self.young, {}, 0
            if size > self.limit:  # as many of them as there is room for
                values = dict(itertools.islice(values.items(), int(len(values) * self.limit / size)))
        self.young.update(values)
        self.held += min(size, self.limit)


_of_stage: dict = {}


def of_stage(key: str, make: Callable):
    """A value that the tasks of one stage share in a Python worker. It goes when tasks of another stage come."""
    _drop_of_others()
    if key not in _of_stage:
        _of_stage[key] = make()
    return _of_stage[key]


def _drop_of_others() -> None:
    stage = TaskContext.get().stageId()
    if _of_stage.get("stage") != stage:
        _of_stage.clear()
        _of_stage["stage"] = stage


def release() -> None:
    """At the end of a task: give unused memory back, as its Python worker goes on to other stages."""
    _drop_of_others()
    gc.collect()
    pa.default_memory_pool().release_unused()


def ranges(starts: np.ndarray, counts: np.ndarray) -> np.ndarray:
    """starts[0], starts[0] + 1, ... for counts[0] places, then the same from starts[1], and so on."""
    total = int(counts.sum())
    before = np.cumsum(counts) - counts
    return np.arange(total, dtype=np.int64) + np.repeat(starts - before, counts)

"""Packing documents into training sequences of a fixed window, by sum of squares.

Each task packs the documents it reads. A document of at least a window fills whole
windows first. The rest goes, whole, to the fill level that minimises the sum of squared
counts of partially filled windows; counts are kept in an array by level, the windows of a
level in a stack. At the end of a task the windows still open are levelled: pieces of the
emptiest are cut to fill the fullest, so that at most one is left over; it is dealt out
in sequences of powers of two, which need no padding.

No rows are shuffled. A task holds the ids of the pieces in open windows, of which it closes all whenever
these are more than `OPEN_IDS` together, and the ids of a slice of texts.

Defined results: a null text is an empty one; an empty document is its end id alone; repeated
rows and ids are packed each by themselves; an empty table gives no rows; other columns are
ignored.
"""

from __future__ import annotations

import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame

from texelframe.llm.common import of_stage, release, slices
from texelframe.llm.encoding import Encoder, with_end

OPEN_IDS = 16_000_000  # of two bytes each
SCHEMA = (
    "doc_id long, start long, length long, ids_crc32 long, doc_tokens long, sequence_id long, `offset` long"
)


class Packer:
    """Places pieces (document number, start, length) into windows of `window` tokens.

    Closed windows are lists of pieces in `closed`, to be taken by the caller.
    """

    def __init__(self, window: int, open_ids: int = OPEN_IDS):
        self.window, self.limit = window, open_ids
        self.counts = np.zeros(window + 1, dtype=np.int64)  # open windows by fill level
        self.stacks: list[list[list[tuple]]] = [[] for _ in range(window)]
        self.held = 0  # ids in open windows
        self.closed: list[list[tuple]] = []

    def add(self, doc: int, tokens: int) -> None:
        full, rest = divmod(tokens, self.window)
        for k in range(full):
            self.closed.append([(doc, k * self.window, self.window)])
        if rest:
            self._place((doc, full * self.window, rest))

    def _place(self, piece: tuple) -> None:
        size, counts, window = piece[2], self.counts, self.window
        # change of the sum of squares: a window leaves level h (none if h is 0) and one
        # comes to level h + size (none if that fills it)
        to = 2 * counts[size : window + 1] + 1
        to[-1] = 0
        away = 1 - 2 * counts[: window + 1 - size]
        away[0] = 0
        cost = to + away
        cost[1:][counts[1 : window + 1 - size] == 0] = np.iinfo(np.int64).max
        level = int(len(cost) - 1 - np.argmin(cost[::-1]))  # the fullest of equals
        if level:
            content = self.stacks[level].pop()
            counts[level] -= 1
            self.held -= level
            content.append(piece)
        else:
            content = [piece]
        if level + size == window:
            self.closed.append(content)
        else:
            self.stacks[level + size].append(content)
            counts[level + size] += 1
            self.held += level + size
            if self.held >= self.limit:
                self.level_out()

    def level_out(self) -> None:
        """Close all open windows: those that are emptiest fill up the others, cut where they must be."""
        left = [(level, content) for level in range(self.window - 1, 0, -1) for content in self.stacks[level]]
        self.stacks = [[] for _ in range(self.window)]
        self.counts[:] = 0
        self.held = 0
        loose: list[tuple] = []
        k, last = 0, len(left) - 1
        while k <= last:
            level, content = left[k]
            room = self.window - level
            while room and (loose or last > k):
                if not loose:
                    loose = left[last][1]
                    last -= 1
                doc, start, length = loose.pop()
                if length > room:
                    loose.append((doc, start + room, length - room))
                    length = room
                content.append((doc, start, length))
                room -= length
            self._close(content, self.window - room)
            k += 1
        if loose:
            self._close(loose, sum(p[2] for p in loose))

    def _close(self, content: list[tuple], fill: int) -> None:
        """Close a window of `fill` tokens; one that isn't full is dealt out in powers of two."""
        if fill == self.window:
            self.closed.append(content)
            return
        content = content[::-1]
        for bit in reversed(range(fill.bit_length())):
            room = fill & (1 << bit)
            out = []
            while room:
                doc, start, length = content.pop()
                if length > room:
                    content.append((doc, start + room, length - room))
                    length = room
                out.append((doc, start, length))
                room -= length
            if out:
                self.closed.append(out)


def pack(docs: DataFrame, tokenizer: str, end_id: int, window: int = 4096) -> DataFrame:
    """One row per piece: its document, place in it, check sum of its ids, sequence and place there.

    Sequence ids are unique and the same in every run over the same files; the upper bits
    are the number of the task.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        first = TaskContext.get().partitionId() << 36
        packer, sequence = Packer(window), 0
        sums: dict[int, tuple] = {}  # documents with pieces in open windows
        n_docs = 0
        enc = of_stage(tokenizer, lambda: Encoder(tokenizer))

        def emit() -> Iterator[pa.RecordBatch]:
            nonlocal sequence
            rows = []
            for content in packer.closed:
                offset = 0
                for doc, start, length in content:
                    doc_id, tokens, ids, gone = sums[doc]
                    rest = ids[start - gone : start - gone + length]
                    rows.append((doc_id, start, length, zlib.crc32(rest.astype("<u4").tobytes()), tokens, first + sequence, offset))
                    offset += length
                    left[doc] -= length
                    if not left[doc]:
                        del sums[doc], left[doc]
                sequence += 1
            packer.closed = []
            if rows:
                columns = list(zip(*rows))
                yield pa.RecordBatch.from_arrays([pa.array(c, pa.int64()) for c in columns], names=names)

        left: dict[int, int] = {}  # tokens of a document that no closed window holds yet
        for batch in batches:
            for part in slices(batch, "text"):
                tokens, ends = with_end(*enc.encode(part.column("text")), end_id)
                begin = 0
                for doc_id, end in zip(part.column("doc_id").to_pylist(), ends.tolist()):
                    n = end - begin
                    rest = n - n % window
                    packer.add(n_docs, n)
                    left[n_docs] = n
                    sums[n_docs] = (doc_id, n, tokens[begin:end], 0)
                    if rest:
                        # whole windows are closed at once: only the rest's ids are kept
                        yield from emit()
                        if n_docs in sums:
                            sums[n_docs] = (doc_id, n, tokens[begin + rest : end].copy(), rest)
                    begin = end
                    n_docs += 1
                yield from emit()
                for doc, (doc_id, n, ids, gone) in sums.items():
                    if ids.base is not None:  # don't keep the whole slice alive
                        sums[doc] = (doc_id, n, ids.copy(), gone)
        packer.level_out()
        yield from emit()
        release()

    names = ["doc_id", "start", "length", "ids_crc32", "doc_tokens", "sequence_id", "offset"]
    return docs.select("doc_id", "text").mapInArrow(run, SCHEMA)

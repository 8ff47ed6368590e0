"""Token ids in files of canonical, length-limited Huffman codes.

The ids of all documents are counted; the driver makes code lengths of at most `MAX_BITS`
from the counts (one number per vocabulary entry), and every task codes its documents.

Format. A stored table `blocks`, in ascending doc_id order over the rows' `shard`, `block`:
each block holds about `BLOCK_TOKENS` ids in whole documents and can be decoded by itself:
`payload` are the codes, most significant bit first, each document from a new byte, `n_tokens`
their number, `bit_offsets` the place of every `CHECKPOINT`-th code of a document, `doc_ids` and
`doc_tokens` the documents, `start_in_shard` the number of ids in the shard's blocks before. Beside it a stored table `codes` has the code length of each id: the
codes follow canonically from (length, id). Both are Parquet, so that any store Spark knows can
hold them and a lost task leaves no half-written block.

Decoding reads a table of 2^longest entries (id and length) by the next bits, for all
checkpoints of a block at the same time.

Defined results: a null text is an empty one and gives the end id alone; rows with equal
doc_id stand in the order of their ids' bytes; a null doc_id comes first; an empty table
gives no block.
"""

from __future__ import annotations

import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from texelframe.llm.common import of_stage, ranges, release, slices, stored
from texelframe.llm.encoding import Encoder, with_end

MAX_BITS = 20
CHECKPOINT = 256
BLOCK_TOKENS = 1 << 20


def code_lengths(counts: dict[int, int], max_bits: int = MAX_BITS) -> dict[int, int]:
    """Optimal code lengths of at most max_bits, by package-merge."""
    symbols = sorted(counts, key=lambda s: (counts[s], s))
    if len(symbols) > 1 << max_bits:
        raise ValueError("more ids than codes of that length")
    if len(symbols) == 1:
        return {symbols[0]: 1}
    weights = np.array([counts[s] for s in symbols], dtype=np.float64)
    n = len(symbols)
    # For each bit level, which places of the merged list are single symbols; the first
    # 2n - 2 places of the last list are taken and followed back through the packages.
    level, singles = weights, []
    merged, is_single = weights, np.ones(n, dtype=bool)
    for _ in range(max_bits - 1):
        singles.append(is_single)
        packages = merged[: len(merged) // 2 * 2].reshape(-1, 2).sum(axis=1)
        both = np.concatenate([level, packages])
        order = np.argsort(both, kind="stable")
        merged, is_single = both[order], order < n
    singles.append(is_single)
    lengths, take = np.zeros(n, dtype=np.int64), 2 * n - 2
    for is_single in reversed(singles):
        k = int(is_single[:take].sum())
        lengths[:k] += 1
        take = 2 * (take - k)
    return dict(zip(symbols, lengths.tolist()))


def canonical(lengths: dict[int, int]) -> tuple[np.ndarray, np.ndarray]:
    """For each id up to the largest: its code and code length (0: no code)."""
    n = max(lengths, default=0) + 1
    codes, bits = np.zeros(n, dtype=np.uint64), np.zeros(n, dtype=np.int64)
    code = before = 0
    for length, symbol in sorted((length, s) for s, length in lengths.items()):
        code <<= length - before
        codes[symbol], bits[symbol] = code, length
        code, before = code + 1, length
    return codes, bits


def encode_bits(ids: np.ndarray, ends: np.ndarray, codes: np.ndarray, bits: np.ndarray) -> tuple[bytes, np.ndarray]:
    """The codes of ids in turn, and the bit offset of each. ends: of documents, each of which begins a new byte."""
    if not len(ids):
        return b"", np.zeros(0, dtype=np.int64)
    size = bits[ids]
    to = np.cumsum(size)
    counts = np.diff(ends, prepend=0)
    doc_bits = np.diff(np.concatenate([[0], to])[ends], prepend=0)
    pad = -doc_bits % 8
    at = to - size + np.repeat(np.cumsum(pad) - pad, counts)
    total = int(doc_bits.sum() + pad.sum())
    words = np.zeros(total // 64 + 2, dtype=np.uint64)
    code, word = codes[ids], at >> 6
    room = 64 - (at & 63) - size  # bits left in the word, negative if it runs over
    fits = np.where(room >= 0, code << np.maximum(room, 0).astype(np.uint64), code >> np.maximum(-room, 0).astype(np.uint64))
    first = np.flatnonzero(np.diff(word, prepend=-1))
    words[word[first]] = np.bitwise_or.reduceat(fits, first)
    over = np.flatnonzero(room < 0)
    words[word[over] + 1] |= code[over] << (64 + room[over]).astype(np.uint64)
    return words.astype(">u8").tobytes()[: total // 8], at


class Decoder:
    """Decodes blocks by a table over the next `longest` bits."""

    def __init__(self, codes: np.ndarray, bits: np.ndarray):
        self.longest = int(bits.max(initial=0))
        self.symbol = np.zeros(1 << self.longest, dtype=np.uint16)
        self.length = np.zeros(1 << self.longest, dtype=np.uint8)
        used = np.flatnonzero(bits)
        order = used[np.lexsort((used, bits[used]))]
        span = 1 << (self.longest - bits[order])
        self.symbol[: span.sum()] = np.repeat(order, span)
        self.length[: span.sum()] = np.repeat(bits[order], span)

    def decode(self, payload: bytes, doc_tokens: np.ndarray, offsets: np.ndarray, checkpoint: int = CHECKPOINT) -> np.ndarray:
        """The ids of a block. Runs of up to `checkpoint` ids begin at the offsets; all runs advance together."""
        data = np.frombuffer(payload + b"\0" * 8, dtype=np.uint8).astype(np.uint32)
        window = (data[:-3] << 24) | (data[1:-2] << 16) | (data[2:-1] << 8) | data[3:]
        runs = -(-doc_tokens // checkpoint)
        sizes = np.full(len(offsets), checkpoint, dtype=np.int64)
        ends = np.cumsum(runs)
        sizes[ends[runs > 0] - 1] = (doc_tokens - (runs - 1) * checkpoint)[runs > 0]
        longest_first = np.argsort(-sizes, kind="stable")
        live = np.searchsorted(-sizes[longest_first], -np.arange(int(sizes.max(initial=0))), side="left")
        at, starts = offsets[longest_first].astype(np.int64), (np.cumsum(sizes) - sizes)[longest_first]
        out = np.zeros(int(sizes.sum()), dtype=np.uint16)
        shift = np.uint32(32 - self.longest)
        for k, n in enumerate(live.tolist()):
            bit = at[:n]
            index = (window[bit >> 3] << (bit & 7).astype(np.uint32)) >> shift
            out[starts[:n] + k] = self.symbol[index]
            at[:n] = bit + self.length[index]
        return out


def token_rows(docs: DataFrame, tokenizer: str, end_id: int) -> DataFrame:
    """(doc_id, ids): each text's ids and end_id, as little-endian 16-bit numbers."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        enc = of_stage(tokenizer, lambda: Encoder(tokenizer))
        for batch in batches:
            for part in slices(batch, "text"):
                tokens, ends = with_end(*enc.encode(part.column("text")), end_id)
                edges = pa.array(np.concatenate([[0], ends * 2]), pa.int64())
                ids = pa.LargeBinaryArray.from_buffers(
                    pa.large_binary(), len(ends), [None, edges.buffers()[1], pa.py_buffer(tokens.astype("<u2").tobytes())]
                )
                yield pa.RecordBatch.from_arrays([part.column("doc_id").cast(pa.int64()), ids.cast(pa.binary())], names=["doc_id", "ids"])
        release()

    return docs.select("doc_id", "text").mapInArrow(run, "doc_id long, ids binary")


def count_ids(rows: DataFrame) -> dict[int, int]:
    """Occurrences of each id over all rows: at most one number per vocabulary entry reaches the driver."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        counts = np.zeros(1 << 16, dtype=np.int64)
        for part in (part for batch in batches for part in slices(batch, "ids")):
            counts += np.bincount(_flat(part.column("ids"))[0], minlength=1 << 16)
        seen = np.flatnonzero(counts)
        yield pa.RecordBatch.from_arrays([pa.array(seen, pa.int64()), pa.array(counts[seen], pa.int64())], names=["id", "n"])

    found = rows.select("ids").mapInArrow(run, "id long, n long").groupBy("id").agg(F.sum("n").alias("n"))
    return {r.id: r.n for r in found.collect()}


def _flat(ids: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """The numbers of a column of binaries one after another, and the ends of its rows."""
    edges = np.frombuffer(ids.buffers()[1], dtype=np.int32)[ids.offset : ids.offset + len(ids) + 1].astype(np.int64)
    raw = ids.buffers()[2]
    flat = np.frombuffer(raw, dtype=np.uint8)[edges[0] : edges[-1]].view("<u2") if raw is not None else np.zeros(0, "<u2")
    return flat, (edges[1:] - edges[0]) // 2


def write_blocks(rows: DataFrame, max_bits: int = MAX_BITS) -> tuple[DataFrame, DataFrame]:
    """Stored tables (blocks, codes) of the rows of token_rows, which should be stored: they are read twice."""
    spark = rows.sparkSession
    lengths = code_lengths(count_ids(rows), max_bits)
    table = stored(spark.createDataFrame([*lengths.items()], "id int, bits int").coalesce(1))
    shared = spark.sparkContext.broadcast(canonical(lengths))  # two numbers per vocabulary entry

    def code(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        codes, bits = shared.value
        shard, block, before = TaskContext.get().partitionId(), 0, 0
        for part in (part for batch in batches for part in slices(batch, "ids")):
            flat, ends = _flat(part.column("ids"))
            doc_ids, rows = part.column("doc_id"), []
            # documents up to each multiple of BLOCK_TOKENS make a block
            cuts = np.flatnonzero(np.diff(ends // BLOCK_TOKENS, prepend=0)) + 1
            for a, b in zip([0, *cuts], [*cuts, len(ends)]):
                if a == b:
                    continue
                begin = int(ends[a - 1]) if a else 0
                inside = ends[a:b] - begin
                payload, at = encode_bits(flat[begin : ends[b - 1]], inside, codes, bits)
                counts = np.diff(inside, prepend=0)
                runs = -(-counts // CHECKPOINT)
                at = at[ranges(inside - counts, runs) + (ranges(np.zeros_like(runs), runs) * (CHECKPOINT - 1))]
                rows.append((shard, block, before, int(inside[-1]), doc_ids[a:b].to_pylist(), counts.tolist(), at.tolist(), payload))
                block, before = block + 1, before + int(inside[-1])
            if rows:
                yield pa.RecordBatch.from_arrays([pa.array(x, k) for x, k in zip(zip(*rows), kinds)], names=names)

    names = ["shard", "block", "start_in_shard", "n_tokens", "doc_ids", "doc_tokens", "bit_offsets", "payload"]
    numbers = pa.list_(pa.int64())
    kinds = [pa.int64(), pa.int64(), pa.int64(), pa.int64(), numbers, numbers, numbers, pa.binary()]
    schema = (
        "shard long, block long, start_in_shard long, n_tokens long, doc_ids array<long>, doc_tokens array<long>, "
        "bit_offsets array<long>, payload binary"
    )
    dealt = rows.repartitionByRange("doc_id", F.xxhash64("ids")).sortWithinPartitions("doc_id", "ids")
    return stored(dealt.mapInArrow(code, schema)), table


def read_blocks(blocks: DataFrame, codes: DataFrame, digest: bool = False) -> DataFrame:
    """(doc_id, start, n_tokens, ids) from the stored tables; ids as 16-bit numbers, or ids_crc32 of them as 32-bit ones."""
    spark = blocks.sparkSession
    # one row per entry of the vocabulary
    shared = spark.sparkContext.broadcast(canonical({r.id: r.bits for r in codes.collect()}))
    # one row per shard, of which there are as many as partitions were written
    totals = blocks.groupBy("shard").agg(F.sum("n_tokens").alias("n"))
    before = totals.select("shard", (F.sum("n").over(Window.orderBy("shard")) - F.col("n")).alias("shard_start"))
    placed = blocks.join(F.broadcast(before), "shard").select(
        (F.col("shard_start") + F.col("start_in_shard")).alias("start"), "doc_ids", "doc_tokens", "bit_offsets", "payload"
    )

    def decode(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        decoder = Decoder(*shared.value)
        for batch in batches:
            for k in range(len(batch)):
                row = {name: batch.column(name)[k] for name in batch.schema.names}
                counts = row["doc_tokens"].values.to_numpy()
                ids = decoder.decode(row["payload"].as_py(), counts, row["bit_offsets"].values.to_numpy())
                ends = np.cumsum(counts)
                starts = ends - counts
                spans = list(zip(starts.tolist(), ends.tolist()))
                if digest:
                    wide = ids.astype("<u4")
                    last = pa.array([zlib.crc32(wide[a:b]) for a, b in spans], pa.int64())
                else:
                    last = pa.array([ids[a:b].astype("<u2").tobytes() for a, b in spans], pa.binary())
                yield pa.RecordBatch.from_arrays(
                    [row["doc_ids"].values, pa.array(starts + row["start"].as_py()), pa.array(counts), last],
                    names=["doc_id", "start", "n_tokens", "ids_crc32" if digest else "ids"],
                )

    return placed.mapInArrow(decode, "doc_id long, start long, n_tokens long, " + ("ids_crc32 long" if digest else "ids binary"))

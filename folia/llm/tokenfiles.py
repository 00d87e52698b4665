"""Token ids as word-aligned Simple-8b files.

Each 64-bit word holds a selector in its top four bits and as many ids as the selector's
width allows. Ids are coded in blocks of ``BLOCK`` ids that start at a word, and the word
at which each block starts is kept, so blocks can be decoded side by side. An id that
needs more than 60 bits takes an escape: a word with selector 15, and the id in the next one.

A file is a Parquet file of records, written by Spark's commit protocol. A record holds a
run of consecutive documents: their ids and lengths, the ids before them in the file,
the block offsets and the words.
Records stand in ascending order of document, and so do files by partition number.
"""

from collections.abc import Iterator
from zlib import crc32

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession, functions as F

from folia.llm.frames import running_offsets, with_text
from folia.llm.texts import text_slices
from folia.llm.tokenids import encoder
from folia.session import scratch_path

BLOCK = 1024

# Ids per word and bits per id of selectors 0 to 14; selector 15 escapes.
COUNTS = np.array([240, 120, 60, 30, 20, 15, 12, 10, 8, 7, 6, 5, 4, 3, 1])
WIDTHS = np.array([0, 0, 1, 2, 3, 4, 5, 6, 7, 8, 10, 12, 15, 20, 60])
ESCAPE = 15

RECORD = (
    "part int, start bigint, doc_ids array<bigint>, lengths array<bigint>, "
    "block_words array<bigint>, words binary"
)


def _fitting(values: np.ndarray) -> np.ndarray:
    """For each column: the first selector whose ids, from there on, all fit.

    ``values`` has a block in each row, padded by zeros, which fit everywhere.
    """
    # A float's exponent tells the bits of whole numbers that it holds exactly.
    bits = np.frexp(values.astype(np.float64))[1].astype(np.int8)
    for row, column in zip(*np.nonzero(bits > 52)):
        bits[row, column] = int(values[row, column]).bit_length()
    bits[bits > 60] = 64
    chosen = np.full(values.shape, ESCAPE, np.int8)
    # widest[:, i] is the most bits of `span` ids from i on; spans double.
    widest, spans = {1: bits}, 1
    while spans * 2 <= int(COUNTS.max()):
        last = widest[spans]
        ahead = np.zeros_like(last)
        ahead[:, : last.shape[1] - spans] = last[:, spans:]
        widest[spans * 2] = np.maximum(last, ahead)
        spans *= 2
    for selector in range(len(COUNTS) - 1, -1, -1):
        count = int(COUNTS[selector])
        span = 1 << (count.bit_length() - 1)
        head, tail = widest[span], np.zeros_like(bits)
        if count - span < bits.shape[1]:
            tail[:, : bits.shape[1] - (count - span)] = head[:, count - span :]
        chosen[np.maximum(head, tail) <= WIDTHS[selector]] = selector
    return chosen


def encode(values: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Words of the values, and the word at which each block of ``BLOCK`` values starts."""
    values = np.asarray(values, np.uint64)
    blocks = -(-len(values) // BLOCK)
    if not blocks:
        return np.zeros(0, np.uint64), np.zeros(0, np.int64)
    padded = np.zeros((blocks, BLOCK), np.uint64)
    padded.reshape(-1)[: len(values)] = values
    sizes = np.full(blocks, BLOCK)
    sizes[-1] = len(values) - (blocks - 1) * BLOCK
    chosen = _fitting(padded)
    wide = np.concatenate([padded, np.zeros((blocks, int(COUNTS.max())), np.uint64)], axis=1)
    # All blocks take their next word at the same time.
    place, lane, step = np.zeros(blocks, np.int64), np.arange(blocks), 0
    owners, orders, words = [], [], []
    while len(lane):
        selectors = chosen[lane, place[lane]]
        for selector in np.unique(selectors):
            at = lane[selectors == selector]
            escaped = selector == ESCAPE
            head = np.uint64(selector) << np.uint64(60)
            count = 1 if escaped else int(COUNTS[selector])
            if escaped:
                made = np.full(len(at), head, np.uint64)
            else:
                made = np.full(len(at), head, np.uint64)
                width = int(WIDTHS[selector])
                if width:
                    taken = wide[at[:, None], place[at][:, None] + np.arange(count)]
                    shifts = (np.arange(count) * width).astype(np.uint64)
                    made |= np.bitwise_or.reduce(taken << shifts, axis=1)
            owners.append(at)
            orders.append(np.full(len(at), 2 * step))
            words.append(made)
            if escaped:
                owners.append(at)
                orders.append(np.full(len(at), 2 * step + 1))
                words.append(wide[at, place[at]])
            place[at] += count
        lane, step = lane[place[lane] < sizes[lane]], step + 1
    owner, order = np.concatenate(owners), np.concatenate(orders)
    stream = np.concatenate(words)[np.lexsort((order, owner))]
    per_block = np.bincount(owner, minlength=blocks)
    return stream, np.cumsum(per_block) - per_block


def decode(words: np.ndarray, block_words: np.ndarray, n: int) -> np.ndarray:
    """The first ``n`` values of a coded stream."""
    words = np.asarray(words, np.uint64)
    if not n:
        return np.zeros(0, np.uint64)
    selectors = (words >> np.uint64(60)).astype(np.int64)
    escaped = np.zeros(len(words), bool)
    # The word after an escape holds a plain value, and may look like an escape itself.
    for at in np.flatnonzero(selectors == ESCAPE):
        if not escaped[at]:
            escaped[at + 1] = True
    heads = np.flatnonzero(~escaped)
    kinds = selectors[heads]
    sizes = np.where(kinds == ESCAPE, 1, np.append(COUNTS, 0)[kinds])
    # A block's last word may be padded; its values count up to the end of the block.
    blocks = len(block_words)
    block_of = np.searchsorted(block_words, heads, side="right") - 1
    starts = np.cumsum(sizes) - sizes
    first_of_block = starts[np.searchsorted(heads, block_words)]
    inside = starts - first_of_block[block_of]
    limit = np.full(blocks, BLOCK)
    limit[-1] = n - (blocks - 1) * BLOCK
    out = np.zeros((blocks, BLOCK + int(COUNTS.max())), np.uint64)
    for kind in np.unique(kinds):
        at = np.flatnonzero(kinds == kind)
        if kind == ESCAPE:
            out[block_of[at], inside[at]] = words[heads[at] + 1]
            continue
        width, count = int(WIDTHS[kind]), int(COUNTS[kind])
        if not width:
            continue
        shifts = (np.arange(count) * width).astype(np.uint64)
        mask = np.uint64((1 << width) - 1)
        values = (words[heads[at]][:, None] >> shifts) & mask
        out[block_of[at][:, None], inside[at][:, None] + np.arange(count)] = values
    return np.concatenate([out[:-1, :BLOCK].reshape(-1), out[-1, : limit[-1]]])


def write_files(docs: DataFrame, tokenizer_path: str, path: str, end_id: int = 2) -> None:
    """Encode documents and write their ids, in ascending order of ``doc_id``.

    A NULL text is empty and has the end id alone; NULL ids come first; repeated rows are
    written each; other columns are left out; an empty table gives an empty set of files.
    """

    def records(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        words, part, start = encoder(tokenizer_path, spaces=False), TaskContext.get().partitionId(), 0
        for batch in batches:
            for rows in text_slices(batch, limit=4 << 20):
                ids, ends = words.encode(rows.column("text"), end_id)
                lengths = np.diff(ends)
                stream, block_words = encode(ids)
                yield pa.RecordBatch.from_pydict(
                    {
                        "part": pa.array([part], pa.int32()),
                        "start": pa.array([start], pa.int64()),
                        "doc_ids": pa.array([rows.column("doc_id").to_pylist()], pa.list_(pa.int64())),
                        "lengths": pa.array([lengths], pa.list_(pa.int64())),
                        "block_words": pa.array([block_words], pa.list_(pa.int64())),
                        "words": pa.array([stream.astype("<u8").tobytes()], pa.binary()),
                    }
                )
                start += len(ids)

    # The text's hash lets many rows with one id be dealt to several partitions.
    rows = with_text(docs).withColumn("_tie", F.xxhash64("text"))
    ordered = rows.repartitionByRange("doc_id", "_tie").sortWithinPartitions("doc_id", "_tie")
    ordered.select("doc_id", "text").mapInArrow(records, RECORD).write.mode("errorifexists").parquet(path)


def read_files(spark: SparkSession, path: str, keep_ids: bool = False) -> DataFrame:
    """Read files back: ``doc_id, start, n_tokens, ids_crc32`` and, if wanted, ``ids``.

    ``start`` is the number of ids of all documents before this one.
    """
    records = spark.read.schema(RECORD).parquet(path)

    def documents(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for i in range(batch.num_rows):
                row = {name: batch.column(name)[i] for name in batch.schema.names}
                lengths = row["lengths"].values.to_numpy()
                words = np.frombuffer(row["words"].as_buffer(), "<u8")
                ids = decode(words, row["block_words"].values.to_numpy(), int(lengths.sum()))
                raw = ids.astype("<u4").view(np.uint8)
                ends = np.concatenate([[0], np.cumsum(lengths)])
                bytes_at = (4 * ends).tolist()
                columns = {
                    "doc_id": row["doc_ids"].values,
                    "start": pa.array(ends[:-1] + row["start"].as_py() + row["_before__ids"].as_py()),
                    "n_tokens": pa.array(lengths),
                    "ids_crc32": pa.array(
                        [crc32(raw[a:b]) for a, b in zip(bytes_at, bytes_at[1:])], pa.int64()
                    ),
                }
                if keep_ids:
                    columns["ids"] = pa.ListArray.from_arrays(
                        pa.array(ends.astype(np.int32)), pa.array(ids.astype(np.int64))
                    )
                yield pa.RecordBatch.from_pydict(columns)

    # Only sizes are summed up; one row per file is safe to broadcast.
    size = F.aggregate("lengths", F.lit(0).cast("long"), lambda total, x: total + x)
    totals = records.groupBy(F.col("part").alias("_part")).agg(F.sum(size).alias("_ids"))
    placed = records.join(
        F.broadcast(running_offsets(totals, [], ["_ids"])), F.col("part") == F.col("_part")
    )
    schema = "doc_id bigint, start bigint, n_tokens bigint, ids_crc32 bigint"
    return placed.mapInArrow(documents, schema + (", ids array<bigint>" if keep_ids else ""))


def token_files(docs: DataFrame, tokenizer_path: str, end_id: int = 2) -> DataFrame:
    """Write the documents' files to the shared scratch folder and read them back."""
    path = scratch_path(docs.sparkSession, "token-files")
    write_files(docs, tokenizer_path, path, end_id)
    return read_files(docs.sparkSession, path)

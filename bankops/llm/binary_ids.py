"""Token ids in binary files: frequency-ranked, byte-aligned variable length, lengths in separate control bytes.

A file is a Parquet table of blocks. A block holds whole documents: their ids and token counts, the vocabulary of the block
by falling frequency, two control bits for each token (its rank takes one to four bytes) and the bytes of the ranks. A frequent
token has a low rank and takes one byte. Each block has its own vocabulary, so it can be written in one pass over the
texts and read alone.
"""

from __future__ import annotations

import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from bankops.llm.text import text_slices
from bankops.llm.tokens import piece_encoder

SEGMENT_BYTES = 32 << 20  # of text in a task
BLOCK_TOKENS = 2_000_000
END_ID = 2

# lengths of the four values that a control byte describes, and the mask of a value by its length
_LENGTHS = np.array([[(c >> (2 * k) & 3) + 1 for k in range(4)] for c in range(256)], np.uint8)
_MASKS = np.array([0, 0xFF, 0xFFFF, 0xFFFFFF, 0xFFFFFFFF], np.uint32)


def encode_values(values: np.ndarray) -> tuple[bytes, bytes]:
    """Control bytes and data bytes of unsigned 32-bit values."""
    v = values.astype(np.uint32)
    size = 1 + (v > 0xFF).astype(np.int64) + (v > 0xFFFF) + (v > 0xFFFFFF)
    codes = np.zeros(-(-len(v) // 4) * 4, np.uint8)
    codes[: len(v)] = size - 1
    control = (codes.reshape(-1, 4) << np.array([0, 2, 4, 6], np.uint8)).sum(axis=1, dtype=np.uint8)
    at = np.cumsum(size) - size
    data = np.zeros(int(size.sum()), np.uint8)
    for k in range(4):
        has = size > k if k else slice(None)
        data[at[has] + k] = (v[has] >> np.uint32(8 * k)).astype(np.uint8)
    return control.tobytes(), data.tobytes()


def decode_values(control: bytes, data: bytes, n: int) -> np.ndarray:
    size = _LENGTHS[np.frombuffer(control, np.uint8)].reshape(-1)[:n]
    at = np.cumsum(size, dtype=np.int64) - size
    padded = np.frombuffer(data + b"\0\0\0\0", np.uint8)
    four = np.ndarray(len(padded) - 3, dtype="<u4", buffer=padded, strides=(1,))
    return four[at] & _MASKS[size]


def encode_block(ids: np.ndarray) -> tuple[bytes, bytes, bytes]:
    """Vocabulary, control and data bytes; equal frequencies in order of the id."""
    counts = np.bincount(ids)
    used = np.flatnonzero(counts)
    words = used[np.argsort(-counts[used], kind="stable")]
    rank = np.zeros(len(counts), np.uint32)
    rank[words] = np.arange(len(words), dtype=np.uint32)
    return words.astype("<u4").tobytes(), *encode_values(rank[ids])


def decode_block(vocabulary: bytes, control: bytes, data: bytes, n: int) -> np.ndarray:
    return np.frombuffer(vocabulary, "<u4")[decode_values(control, data, n)]


def _blocks(tokenizer: str, end_id: int, block_tokens: int):
    def blocks(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encoder, segment, number = piece_encoder(tokenizer), TaskContext.get().partitionId(), 0
        held: list[tuple] = []
        waiting = 0

        def block() -> pa.RecordBatch:
            keys = pa.concat_arrays([k for k, _, _ in held])
            sizes = np.concatenate([s for _, s, _ in held])
            ids = np.concatenate([x for _, _, x in held])
            n = pa.array([0, len(keys)], pa.int32())
            return pa.RecordBatch.from_arrays(
                [
                    pa.array([segment], pa.int64()), pa.array([number], pa.int64()), pa.array([len(ids)], pa.int64()),
                    pa.ListArray.from_arrays(n, keys), pa.ListArray.from_arrays(n, pa.array(sizes)),
                    *(pa.array([x], pa.binary()) for x in encode_block(ids)),
                ],
                ["segment", "block", "tokens", "doc_ids", "sizes", "vocabulary", "control", "data"],
            )

        for batch in batches:
            for lo, hi, data, offs in text_slices(batch.column(0)):
                ids, sizes = encoder.encode(data, offs)
                total = sizes + 1
                every = np.full(int(total.sum()), end_id, np.uint32)
                body = np.ones(len(every), bool)
                body[np.cumsum(total) - 1] = False
                every[body] = ids
                held.append((batch.column(1).slice(lo, hi - lo), total, every))
                waiting += len(every)
                if waiting >= block_tokens:
                    yield block()
                    held, waiting, number = [], 0, number + 1
        if held:
            yield block()

    return blocks


def write_ids(
    docs: DataFrame,
    path: str,
    id_col: str = "doc_id",
    text_col: str = "text",
    tokenizer: str = "byte_bpe_50k.json",
    end_id: int = END_ID,
    segment_bytes: int = SEGMENT_BYTES,
    block_tokens: int = BLOCK_TOKENS,
) -> None:
    """Write the token ids of all texts under ``path``, documents in ascending order of their id, null ids first.

    A null text is an empty one: it has the end id alone. Rows with equal ids stand together, by a hash of the text; rows
    equal in both are told apart by the input partition, so a repeated id or row can be spread over segments. Other columns
    are not read. An empty table gives no blocks.
    """
    spark = docs.sparkSession
    text = F.coalesce(F.col(text_col), F.lit(""))
    size = docs.agg(F.sum(F.octet_length(text))).first()[0] or 0
    segments = max(spark.sparkContext.defaultParallelism, -(-size // segment_bytes))
    order = [F.asc_nulls_first("key"), "tie", "part"]
    rows = docs.select(
        text.alias("text"), F.col(id_col).alias("key"), F.xxhash64(text).alias("tie"), F.spark_partition_id().alias("part")
    )
    rows = rows.repartitionByRange(int(segments), *order).sortWithinPartitions(*order)
    key = docs.schema[id_col].dataType
    long, binary = T.LongType(), T.BinaryType()
    schema = T.StructType(
        [T.StructField(n, long) for n in ("segment", "block", "tokens")]
        + [T.StructField("doc_ids", T.ArrayType(key)), T.StructField("sizes", T.ArrayType(long))]
        + [T.StructField(n, binary) for n in ("vocabulary", "control", "data")]
    )
    blocks = rows.select("text", "key").mapInArrow(_blocks(tokenizer, end_id, block_tokens), schema)
    blocks.write.option("compression", "uncompressed").parquet(path)


def read_ids(spark: SparkSession, path: str, with_ids: bool = True) -> DataFrame:
    """Decode the files: doc_id, start, n_tokens, ids_crc32 and, if asked for, ids.

    ``start`` counts the ids of all documents before; ``ids_crc32`` is over the ids as little-endian 32-bit numbers.
    """
    stored_blocks = spark.read.parquet(path)
    key = stored_blocks.schema["doc_ids"].dataType.elementType
    fields = [T.StructField("segment", T.LongType()), T.StructField("block", T.LongType()), T.StructField("doc_id", key)]
    fields += [T.StructField(n, T.LongType()) for n in ("within", "n_tokens", "ids_crc32")]
    if with_ids:
        fields.append(T.StructField("ids", T.ArrayType(T.LongType())))

    def decode(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for r in range(batch.num_rows):
                segment, number, tokens = (batch.column(k)[r].as_py() for k in range(3))
                keys, sizes = batch.column(3)[r].values, batch.column(4)[r].values.to_numpy()
                ids = decode_block(*(batch.column(k)[r].as_py() for k in (5, 6, 7)), tokens)
                ends = np.cumsum(sizes)
                view = memoryview(np.ascontiguousarray(ids, "<u4")).cast("B")
                pairs = zip((ends - sizes).tolist(), ends.tolist())
                crc = np.fromiter((zlib.crc32(view[4 * a : 4 * b]) for a, b in pairs), np.int64, len(sizes))
                n = len(sizes)
                out = [
                    pa.array(np.full(n, segment)), pa.array(np.full(n, number)), keys,
                    pa.array(ends - sizes), pa.array(sizes), pa.array(crc),
                ]
                if with_ids:
                    bounds = np.append(0, ends).astype(np.int32)
                    out.append(pa.ListArray.from_arrays(pa.array(bounds), pa.array(ids.astype(np.int64))))
                yield pa.RecordBatch.from_arrays(out, [f.name for f in fields])

    columns = ["segment", "block", "tokens", "doc_ids", "sizes", "vocabulary", "control", "data"]
    rows = stored_blocks.select(*columns).mapInArrow(decode, T.StructType(fields))
    # one number for each block of two million tokens: offsets of segments, then of blocks in their segment
    blocks = stored_blocks.select("segment", "block", "tokens")
    segments = blocks.groupBy("segment").agg(F.sum("tokens").alias("tokens"))
    up_to = (Window.unboundedPreceding, -1)
    segments = segments.select(
        "segment", F.coalesce(F.sum("tokens").over(Window.orderBy("segment").rowsBetween(*up_to)), F.lit(0)).alias("base")
    )
    inside = F.sum("tokens").over(Window.partitionBy("segment").orderBy("block").rowsBetween(*up_to))
    firsts = blocks.select("segment", "block", F.coalesce(inside, F.lit(0)).alias("inside")).join(segments, "segment")
    out = rows.join(firsts, ["segment", "block"]).withColumn("start", F.col("base") + F.col("inside") + F.col("within"))
    return out.select("doc_id", "start", "n_tokens", "ids_crc32", *(["ids"] if with_ids else []))

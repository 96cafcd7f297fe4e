"""Files of token ids: documents in order of their id, in frames of range-coded blocks.

A file is a Parquet file, written and read by Spark. Each row is a frame: whole documents
with their ids and lengths, about a block's worth of token ids, and the blocks they are coded
in. A block starts from an empty model and carries a checksum, so frames can be read in any
order and a damaged block is found. ``part`` orders the files, ``first`` counts the part's ids
before the frame.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from wardwatch.llm.rangecoder import BLOCK, decode, encode
from wardwatch.llm.wordids import encoded_chunks, word_ids

END = 0


def _bounds(n: int) -> list[int]:
    """Where a frame of ``n`` ids is cut into blocks of about ``BLOCK`` ids."""
    blocks = max(1, round(n / BLOCK))
    return [n * k // blocks for k in range(blocks + 1)]


def write_tokens(
    docs: DataFrame,
    tokenizer: str,
    folder: str,
    id_column="doc_id",
    text_column="text",
    end: int = END,
) -> None:
    """Write every text's ids, each followed by ``end``, in ascending order of the id.

    A null text is empty: its ids are ``end`` alone. Null ids come first; rows of one id
    stay in the order of the table, so repeated rows are kept. An empty table gives an
    empty table of frames. Other columns are not read.
    """
    rows = docs.select(
        F.col(id_column).alias("id"),
        F.make_valid_utf8(text_column).alias("text"),
        F.monotonically_increasing_id().alias("place"),
    )
    rows = rows.repartitionByRange("id", "place").sortWithinPartitions("id", "place")
    kind = docs.schema[id_column].dataType
    schema = T.StructType(
        [
            T.StructField("part", T.IntegerType()),
            T.StructField("frame", T.IntegerType()),
            T.StructField("first", T.LongType()),
            T.StructField("tokens", T.LongType()),
            T.StructField("vocabulary", T.IntegerType()),
            T.StructField("ids", T.ArrayType(kind)),
            T.StructField("lengths", T.ArrayType(T.LongType())),
            T.StructField("blocks", T.ArrayType(T.BinaryType())),
        ]
    )

    def run(batches):
        encoder = word_ids(tokenizer)
        vocabulary = max(end + 1, encoder.source.tokenizer.get_vocab_size())
        part, number, first = TaskContext.get().partitionId(), 0, 0
        waiting, size = [], 0

        def flush():
            names, lengths, ids = zip(*waiting)
            names, lengths, ids = pa.concat_arrays(names), np.concatenate(lengths), np.concatenate(ids)
            cuts = _bounds(size)
            blocks = encode([ids[a:b] for a, b in zip(cuts, cuts[1:])], vocabulary)
            arrays = [
                pa.array([part], pa.int32()),
                pa.array([number], pa.int32()),
                pa.array([first], pa.int64()),
                pa.array([size], pa.int64()),
                pa.array([vocabulary], pa.int32()),
                pa.ListArray.from_arrays(pa.array([0, len(names)], pa.int32()), names),
                pa.array([lengths], pa.list_(pa.int64())),
                pa.array([blocks], pa.list_(pa.binary())),
            ]
            return pa.RecordBatch.from_arrays(arrays, schema.names)

        for batch in batches:
            for low, ids, bounds in encoded_chunks(batch.column(1), encoder):
                lengths = np.diff(bounds) + 1
                ends = np.zeros(len(ids) + len(lengths), bool)
                ends[np.cumsum(lengths) - 1] = True
                closed = np.full(len(ends), end, np.uint32)
                closed[~ends] = ids
                waiting.append((batch.column(0).slice(low, len(lengths)), lengths, closed))
                size += len(closed)
                if size >= BLOCK:
                    yield flush()
                    number, first = number + 1, first + size
                    waiting, size = [], 0
        if waiting:
            yield flush()

    rows.select("id", "text").mapInArrow(run, schema).write.parquet(folder)


def read_tokens(spark: SparkSession, folder: str, id_column="doc_id") -> DataFrame:
    """(id, start, n_tokens, ids) of each document in the files.

    ``start`` counts the ids of all documents before it; ``ids`` are little-endian unsigned
    32-bit numbers. A block whose checksum differs fails the job.
    """
    frames = spark.read.parquet(folder)
    kind = frames.schema["ids"].dataType.elementType
    schema = T.StructType(
        [
            T.StructField(id_column, kind),
            T.StructField("part", T.IntegerType()),
            T.StructField("offset", T.LongType()),
            T.StructField("n_tokens", T.LongType()),
            T.StructField("tokens", T.BinaryType()),
        ]
    )

    def run(batches):
        for batch in batches:
            for row in range(batch.num_rows):
                part, first, tokens, vocabulary = (batch.column(k)[row].as_py() for k in range(4))
                names = batch.column(4)[row].values
                lengths = np.asarray(batch.column(5)[row].values).astype(np.int64)
                ids = decode(batch.column(6)[row].as_py(), np.diff(_bounds(tokens)), vocabulary)
                ends = np.concatenate([[0], np.cumsum(lengths)])
                buffers = [
                    None,
                    pa.py_buffer((4 * ends).astype(np.int32)),
                    pa.py_buffer(np.concatenate(ids).astype("<u4")),
                ]
                arrays = [
                    names,
                    pa.array(np.full(len(lengths), part, np.int32)),
                    pa.array(first + ends[:-1]),
                    pa.array(lengths),
                    pa.BinaryArray.from_buffers(pa.binary(), len(lengths), buffers),
                ]
                yield pa.RecordBatch.from_arrays(arrays, schema.names)

    found = frames.select(
        "part", "first", "tokens", "vocabulary", "ids", "lengths", "blocks"
    ).mapInArrow(run, schema)
    earlier = Window.orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    parts = frames.groupBy("part").agg(F.sum("tokens").alias("n"))
    # One row per file.
    bases = F.broadcast(
        parts.select("part", F.coalesce(F.sum("n").over(earlier), F.lit(0)).alias("base"))
    )
    return found.join(bases, "part").select(
        id_column,
        (F.col("base") + F.col("offset")).alias("start"),
        "n_tokens",
        F.col("tokens").alias("ids"),
    )

"""Shared helpers of the operators: scratch tables, bounded bit filters, Arrow mapping."""

from __future__ import annotations

import uuid
from collections.abc import Callable, Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.pandas.types import to_arrow_schema
from pyspark.sql.types import StructType


def read(spark: SparkSession, sf_dir: str, table: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{table}.parquet")


def scratch_folder(spark: SparkSession) -> str:
    """A new folder below spark.checkpoint.dir, or below the warehouse where that is unset.

    Both are places that the driver and all executors share.
    """
    root = spark.conf.get("spark.checkpoint.dir", None)
    root = root or f"{spark.conf.get('spark.sql.warehouse.dir')}/scratch"
    return f"{root}/llm-{uuid.uuid4().hex}"


def stored(frame: DataFrame, *partition_by: str) -> DataFrame:
    """The frame written once to shared storage and read back: cuts the lineage and the work."""
    path = scratch_folder(frame.sparkSession)
    frame.write.partitionBy(*partition_by).parquet(path)
    return frame.sparkSession.read.schema(frame.schema).parquet(path)


def arrow_map(
    frame: DataFrame, rows: Callable[[pa.RecordBatch], Iterator[dict]], schema: str
) -> DataFrame:
    """mapInArrow with column dictionaries instead of record batches."""
    target = to_arrow_schema(StructType.fromDDL(schema))
    names = frame.columns

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for columns in rows(batch.rename_columns(names)):
                arrays = [_array(columns[f.name], f.type) for f in target]
                yield pa.RecordBatch.from_arrays(arrays, schema=target)

    # Sent by place, because names may hold dots.
    return frame.toDF(*[f"c{i}" for i in range(len(names))]).mapInArrow(run, schema)


def unused(frame: DataFrame, *names: str) -> list[str]:
    """The names, lengthened where the frame has such columns."""
    taken = {name.lower() for name in frame.columns}
    free = []
    for name in names:
        while name.lower() in taken:
            name += "_"
        free.append(name)
    return free


def _array(values, kind: pa.DataType) -> pa.Array:
    if isinstance(values, (pa.Array, pa.ChunkedArray)):
        return (values.combine_chunks() if isinstance(values, pa.ChunkedArray) else values).cast(kind)
    if isinstance(values, np.ndarray) and values.dtype == np.uint64:
        values = values.view(np.int64)
    return pa.array(values, type=kind)


def lists(values: np.ndarray, bounds: np.ndarray) -> pa.Array:
    """A list column of int64 from flat values and list bounds."""
    flat = pa.array(np.ascontiguousarray(values).view(np.int64))
    return pa.ListArray.from_arrays(pa.array(bounds.astype(np.int32)), flat)


#: Most bits of a filter sent to all tasks (8 MB). A fuller filter lets more rows through,
#: never fewer, so results do not depend on it.
FILTER_BITS = 1 << 26
_CHUNK_BITS = 1 << 19


class BitFilter:
    """A one-hash Bloom filter of fixed size, built by Spark from a column of 64-bit hashes."""

    def __init__(self, spark: SparkSession, keys: DataFrame, column: str, bits: int = FILTER_BITS):
        position = F.shiftrightunsigned(F.col(column), 64 - bits.bit_length() + 1)
        parts = (
            keys.select((position / _CHUNK_BITS).cast("int").alias("chunk"), position.alias("at"))
            .distinct()
            .groupBy("chunk")
            .applyInPandas(_pack, "chunk int, bits binary")
        )
        packed = np.zeros(bits // 8, np.uint8)
        size = _CHUNK_BITS // 8
        for chunk, piece in parts.collect():  # at most bits / 2**19 rows of 64 kB
            packed[chunk * size : (chunk + 1) * size] = np.frombuffer(piece, np.uint8)
        self._bits = bits
        self._shared = spark.sparkContext.broadcast(packed)

    def contains(self, hashes: np.ndarray) -> np.ndarray:
        at = hashes.view(np.uint64) >> np.uint64(64 - self._bits.bit_length() + 1)
        return (self._shared.value[at >> np.uint64(3)] >> (at & np.uint64(7)).astype(np.uint8)) & 1 > 0

    def __getstate__(self):
        return {"_bits": self._bits, "_shared": self._shared}


def _pack(positions: pd.DataFrame) -> pd.DataFrame:
    bits = np.zeros(_CHUNK_BITS, bool)
    bits[positions["at"].to_numpy() % _CHUNK_BITS] = True
    packed = np.packbits(bits, bitorder="little").tobytes()
    return pd.DataFrame({"chunk": [positions["chunk"].iloc[0]], "bits": [packed]})


def hex_digest(text: Column) -> Column:
    """Lowercase hex SHA-256 of a string in UTF-8, or of bytes."""
    return F.sha2(text, 256)

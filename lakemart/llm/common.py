"""Helpers shared by the operators: input columns, batching, durable intermediates."""

from __future__ import annotations

import ctypes
import gc
import uuid
from collections.abc import Iterator
from contextlib import contextmanager

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..session import ensure_checkpoint_dir

#: Text handled at a time inside a task: bounds the memory of the numpy kernels.
BLOCK_BYTES = 1 << 20


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def id_text(df: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Only the id and the text (null: empty) of ``df``, under fixed names, so that
    further columns of the input can neither clash nor be read."""
    return df.select(
        df[id_col].cast("long").alias("doc_id"),
        F.coalesce(df[text_col].cast("string"), F.lit("")).alias("text"),
    )


def settled(df: DataFrame, spark: SparkSession) -> DataFrame:
    """``df`` computed once into the shared checkpoint folder, its lineage cut there."""
    ensure_checkpoint_dir(spark)
    return df.checkpoint(eager=True)


class Scratch:
    """A folder of its own in the shared checkpoint folder, for tables between steps. Only
    the last one written is kept: the one before goes when the next is complete."""

    def __init__(self, spark: SparkSession):
        self.spark = spark
        self.root = f"{ensure_checkpoint_dir(spark).rstrip('/')}/steps-{uuid.uuid4().hex}"
        self.last: str | None = None

    def written(self, df: DataFrame, name: str) -> DataFrame:
        path = f"{self.root}/{name}"
        df.write.parquet(path)
        if self.last:
            place = self.spark._jvm.org.apache.hadoop.fs.Path(self.last)
            place.getFileSystem(self.spark._jsc.hadoopConfiguration()).delete(place, True)
        self.last = path
        return self.spark.read.parquet(path)


def shuffle_width(spark: SparkSession) -> int:
    return int(spark.conf.get("spark.sql.shuffle.partitions"))


def give_back() -> None:
    """Return freed memory to the machine, so that a worker between tasks holds little."""
    pa.default_memory_pool().release_unused()
    trim = getattr(ctypes.CDLL(None), "malloc_trim", None)  # glibc has it
    if trim:
        trim(0)


def blocks(
    batches: Iterator[pa.RecordBatch], limit: int = BLOCK_BYTES, text: str = "text"
) -> Iterator[pa.RecordBatch]:
    """Slices of the batches of about ``limit`` bytes of text (a longer text stays whole)."""
    for batch in batches:
        column = batch.column(batch.schema.get_field_index(text))
        if not len(column):
            continue
        sizes = np.asarray(pc.binary_length(column).fill_null(0), dtype=np.int64)
        cuts = (np.cumsum(sizes) - 1) // limit
        edges = np.flatnonzero(np.diff(cuts)) + 1
        for a, b in zip([0, *edges.tolist()], [*edges.tolist(), len(sizes)], strict=True):
            yield batch.slice(a, b - a)
    give_back()


def string_bytes(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """The UTF-8 bytes of a string column without nulls, and the offsets of its texts."""
    column = column.cast(pa.large_binary())
    offsets = np.frombuffer(column.buffers()[1], dtype=np.int64)
    offsets = offsets[column.offset : column.offset + len(column) + 1]
    data = column.buffers()[2]
    raw = np.frombuffer(data, dtype=np.uint8) if data is not None else np.zeros(0, np.uint8)
    return raw[offsets[0] : offsets[-1]], offsets - offsets[0]


ARROW = {
    "long": pa.int64(),
    "int": pa.int32(),
    "double": pa.float64(),
    "boolean": pa.bool_(),
    "string": pa.string(),
    "binary": pa.binary(),
    "array<int>": pa.list_(pa.int32()),
    "array<long>": pa.list_(pa.int64()),
}


def names(schema: str) -> list[str]:
    return [field.split()[0] for field in schema.split(", ")]


def rows(schema: str, columns: dict) -> pa.RecordBatch:
    """A batch of the named columns (Python lists or numpy arrays) under a Spark schema
    of "name type" pairs."""
    fields = [pa.field(n, ARROW[t]) for n, t in (f.split() for f in schema.split(", "))]
    arrays = [
        columns[f.name] if isinstance(columns[f.name], pa.Array) else pa.array(columns[f.name], f.type)
        for f in fields
    ]
    return pa.RecordBatch.from_arrays(arrays, schema=pa.schema(fields))


@contextmanager
def acyclic() -> Iterator[None]:
    """While large memories of words grow, which hold no cycles: without the collector's
    passes over them."""
    on = gc.isenabled()
    gc.disable()
    try:
        yield
    finally:
        if on:
            gc.enable()


class Remembered:
    """Values by word in two generations of about ``limit`` words: when the young one is
    full it becomes the old one, and what is asked for again moves back to the young. So
    common words stay, however many rare ones pass. Words of over ``longest`` characters
    are forgotten after their block, which bounds the bytes too."""

    def __init__(self, limit: int, longest: int = 64):
        self.limit, self.longest = limit, longest
        self.young: dict = {}
        self.old: dict = {}
        self.once: list = []

    def lacking(self, wanted: set) -> set:
        """Which of the words must be learnt; all others are in ``young`` from now on."""
        for word in self.once:
            self.young.pop(word, None)
        new = wanted.difference(self.young)
        if self.young and len(self.young) + len(new) > self.limit:
            self.old, self.young, new = self.young, {}, wanted
        old, young = self.old, self.young
        found = [word for word in new if word in old]
        for word in found:
            young[word] = old[word]
        new = new.difference(found)
        self.once = [word for word in new if len(word) > self.longest]
        return new

    def get(self, word):
        """One word's value or None."""
        value = self.young.get(word)
        if value is None and (value := self.old.get(word)) is not None:
            self.put(word, value)
        return value

    def put(self, word, value) -> None:
        if len(self.young) >= self.limit:
            self.old, self.young = self.young, {}
        if len(word) <= self.longest:
            self.young[word] = value


def id_remainder(id_col: Column, divisor: int) -> Column:
    """crc32 of the id as decimal text, modulo ``divisor`` (null id: the empty text)."""
    return F.crc32(F.coalesce(id_col.cast("string"), F.lit("")).cast("binary")) % divisor

"""What several operators of this subpackage need."""

from __future__ import annotations

import ctypes
from collections.abc import Callable, Iterator
from uuid import uuid4

import pyarrow as pa
import pyarrow.compute as pc
import xxhash
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from marginalia.session import ensure_checkpoint_dir

UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
#: The characters of ``[\x20\x09-\x0D]``.
BLANKS = " \t\n\x0b\x0c\r"
#: Keys of eight bytes that are broadcast at most: some tens of MB in a hash table.
BROADCAST_KEYS = 500_000
#: Whether Spark deletes the shuffle files of a statement when it ends.
FREE_SHUFFLES = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"
#: How much of a batch Spark hands to Python at once, and how much that is where rows are whole documents.
BATCH_LIMIT, BATCH_BYTES = "spark.sql.execution.arrow.maxBytesPerBatch", 4_000_000


def table(spark: SparkSession, folder: str, name: str, *columns: str) -> DataFrame:
    """Named columns of ``<folder>/<name>.parquet``."""
    return spark.read.parquet(f"{folder}/{name}.parquet").select(*columns)


def fold(text: Column) -> Column:
    """A-Z in lower case, all else unchanged."""
    return F.translate(text, UPPER, LOWER)


def fold_remainder(doc_id: Column, parts: int = 5) -> Column:
    """crc32 of the id as text, modulo ``parts``: the fold of a document (null id: null)."""
    return F.crc32(doc_id.cast("string").cast("binary")) % parts


def settled(df: DataFrame) -> DataFrame:
    """The rows, computed once and kept as a table in the folder that ``spark.checkpoint.dir`` names.

    Later stages read the table, so a lost executor costs a read, not the work.
    Columns are stored compressed, which takes far less room than a checkpoint of rows. What was
    shuffled to compute them is of no use once the table is there, and its files are deleted.
    """
    spark = df.sparkSession
    path = f"{ensure_checkpoint_dir(spark).rstrip('/')}/settled-{uuid4().hex}"
    before = spark.conf.get(FREE_SHUFFLES, "false")
    spark.conf.set(FREE_SHUFFLES, "true")
    try:
        df.write.parquet(path)
    finally:
        spark.conf.set(FREE_SHUFFLES, before)
    return spark.read.schema(df.schema).parquet(path)


def small_batches(spark: SparkSession) -> None:
    """From now on batches for Python hold some MB, not up to 64 of them; a limit that the session was given stays.

    The JVM and the worker both hold a batch whole, beside the heap, in every task.
    """
    if spark.conf.get(BATCH_LIMIT, None) is None:
        spark.conf.set(BATCH_LIMIT, str(BATCH_BYTES))


def give_back() -> None:
    """The worker gives back what its allocators hold unused."""
    pa.default_memory_pool().release_unused()
    trim = getattr(ctypes.CDLL(None), "malloc_trim", None)
    if trim:
        trim(0)


def released(run: Callable[[Iterator], Iterator]) -> Callable[[Iterator], Iterator]:
    """``run``, after which the worker gives back memory.

    Idle workers stay beside the next stages, as many as any stage had at once.
    """

    def whole(batches):
        yield from run(batches)
        give_back()

    return whole


def with_columns(df: DataFrame, more: str) -> StructType:
    """The schema of ``df``, whatever its columns are called, and further columns."""
    return StructType(df.schema.fields + StructType.fromDDL(more).fields)


def narrowed(df: DataFrame, keys: DataFrame, key: str) -> DataFrame:
    """The rows of ``df`` whose key is in the settled, distinct ``keys``.

    At most ``BROADCAST_KEYS`` keys, which are counted first, are broadcast, so that
    wide rows stay where they are; more of them are joined by a shuffle.
    """
    few = keys.limit(BROADCAST_KEYS + 1).count() <= BROADCAST_KEYS
    return df.join(F.broadcast(keys) if few else keys, key, "left_semi")


def stretches(batches: Iterator[pa.RecordBatch], column: str, limit: int) -> Iterator[pa.RecordBatch]:
    """The batches cut into runs of rows with about ``limit`` bytes in a text column, a row at least."""
    for batch in batches:
        start, total = 0, 0
        for at, size in enumerate(pc.binary_length(batch.column(column)).to_pylist()):
            if at > start and total + (size or 0) > limit:
                yield batch.slice(start, at - start)
                start, total = at, 0
            total += size or 0
        if start < batch.num_rows:
            yield batch.slice(start)


def gathered(batches: Iterator[pa.RecordBatch], column: str, limit: int) -> Iterator[pa.RecordBatch]:
    """The batches, several as one until they have ``limit`` bytes in a column."""
    held, total = [], 0
    for batch in batches:
        held.append(batch)
        total += batch.column(column).nbytes
        if total >= limit:
            yield from pa.Table.from_batches(held).combine_chunks().to_batches()
            held, total = [], 0
    if held:
        yield from pa.Table.from_batches(held).combine_chunks().to_batches()


def with_text(batches: Iterator[pa.RecordBatch], column: str, within: tuple[str, int] | None) -> Iterator[pa.RecordBatch]:
    """The batches with a ``column`` of text: that field of a struct they have, without a copy, or the column they have."""
    for batch in batches:
        if within:
            name, field = within
            batch = batch.append_column(column, pc.struct_field(batch.column(name), [field]).cast(pa.binary()))
        yield batch


class Memo(dict):
    """A function of a word, remembered for at most ``limit`` words; then it starts anew."""

    def __init__(self, compute: Callable[[bytes], object], limit: int = 300_000):
        self.compute, self.limit = compute, limit

    def __missing__(self, word: bytes):
        if len(self) >= self.limit:
            self.clear()
        value = self[word] = self.compute(word)
        return value


def word_hash(word: bytes) -> int:
    """64 bits, as a signed number."""
    value = xxhash.xxh64_intdigest(word)
    return value - (1 << 64) if value >> 63 else value

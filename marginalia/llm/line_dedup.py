"""Line deduplication across documents, in DataFrame functions alone.

Lines are named by 128-bit hashes. Of a hash that several documents hold, the
smallest document keeps its lines and the others lose theirs. What comes back
is a bitmap of kept lines for each document that loses any, not its text.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql.types import NumericType

from marginalia.llm.common import BLANKS, fold

MIN_CHARS = 10
#: Ids that share a chunk of a hash: the most rows that one sorted run of a hash can have
#: (each id once), whatever share of all documents holds the line.
CHUNK_IDS = 4096
#: Ids that are no numbers are cut by the upper bits of a hash, all but so many.
HASHED_BITS = 48
WORD_BITS = 63


def lines(text: Column) -> Column:
    """The text split at each newline; null or empty gives one empty line."""
    return F.split(F.coalesce(text, F.lit("")), "\n", -1)


def line_key(line: Column) -> Column:
    return fold(F.trim(line, F.lit(BLANKS)))


def first_holders(held: DataFrame) -> DataFrame:
    """``(hash, first_id)`` of the hashes that more than one id of ``(hash, doc_id)`` holds.

    Rows are range-partitioned by hash and chunk of ids and sorted by hash and
    id, and the first row of each run is streamed out. A chunk's run is at most
    ``CHUNK_IDS`` ids long, so a hash in a third of all documents is many short
    runs; their first rows meet in a sum of partial sums.
    """
    run = Window.partitionBy("hash", "chunk").orderBy("doc_id")
    number = held.schema["doc_id"].dataType
    if isinstance(number, NumericType):
        chunk = F.floor(F.col("doc_id").cast("double") / CHUNK_IDS)
    else:  # ids that are no numbers: parts of equal size, by a hash
        chunk = F.shiftrightunsigned(F.xxhash64("doc_id"), HASHED_BITS)
    chunked = held.withColumn("chunk", chunk)
    runs = chunked.repartitionByRange("hash", "chunk").sortWithinPartitions("hash", "chunk", "doc_id")
    whole = run.rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing)
    firsts = runs.select(
        "hash", "doc_id", F.lag("doc_id").over(run).isNull().alias("first"), F.last("doc_id").over(whole).alias("last_id")
    ).filter("first")
    summed = firsts.groupBy("hash").agg(F.min("doc_id").alias("first_id"), F.max("last_id").alias("last_id"))
    return summed.filter("last_id > first_id").select("hash", "first_id")


def keep_bitmaps(
    docs: DataFrame, *, key: str = "doc_id", text: str = "text", min_chars: int = MIN_CHARS
) -> DataFrame:
    """``(doc_id, text_hash, n_lines, n_dropped, keep)`` of each document that loses lines.

    ``keep`` has a bit for each line, 63 to a number, lowest first; numbers after
    the last one that is not full of ones are left off (``is_kept`` reads it).
    A row is told by its id and its text's hash: rows that repeat both lose the
    same lines, rows that repeat an id alone do not lose lines to each other.
    Ids are of any type that has an order. A null id neither claims nor loses lines. Keys shorter than ``min_chars``
    code points are never dropped.
    """
    rows = docs.select(
        F.col(key).alias("doc_id"), F.xxhash64(text).alias("text_hash"), lines(F.col(text)).alias("lines")
    ).filter(F.col("doc_id").isNotNull())
    keys = F.transform("lines", line_key)
    hashes = F.transform(keys, lambda k: F.when(F.char_length(k) >= min_chars, F.unhex(F.md5(k.cast("binary")))))
    hashed = rows.select("doc_id", "text_hash", F.size("lines").alias("n_lines"), hashes.alias("hashes"))
    held = hashed.select("doc_id", F.explode(F.array_compact(F.array_distinct("hashes"))).alias("hash"))
    placed = hashed.select("doc_id", "text_hash", "n_lines", F.posexplode_outer("hashes").alias("pos", "hash"))
    lost = placed.filter("hash IS NOT NULL").join(first_holders(held), "hash").filter("doc_id > first_id")
    bit = lost.select(
        "doc_id", "text_hash", "n_lines", F.expr(f"int(pos div {WORD_BITS})").alias("word"),
        F.expr(f"shiftleft(1L, pos % {WORD_BITS})").alias("bit"),
    )
    # Rows that repeat id and text give the same bits again: or, not sum.
    words = bit.groupBy("doc_id", "text_hash", "n_lines", "word").agg(F.bit_or("bit").alias("dropped"))
    full = (1 << WORD_BITS) - 1
    per_doc = words.groupBy("doc_id", "text_hash", "n_lines").agg(
        F.map_from_entries(F.collect_list(F.struct("word", F.bitwise_not("dropped").bitwiseAND(F.lit(full))))).alias("of"),
        F.max("word").alias("last"), F.sum(F.bit_count("dropped")).cast("long").alias("n_dropped"),
    )
    keep = F.transform(F.sequence(F.lit(0), F.col("last")), lambda w: F.coalesce(F.col("of")[w], F.lit(full)))
    return per_doc.select("doc_id", "text_hash", F.col("n_lines").cast("long").alias("n_lines"), "n_dropped", keep.alias("keep"))


def is_kept(keep: Column, pos: Column) -> Column:
    """Whether line ``pos`` stays; a missing bitmap or number keeps all its lines."""
    word = F.get(keep, F.floor(pos / WORD_BITS).cast("int"))
    return F.coalesce(F.getbit(word, pos % WORD_BITS) == 1, F.lit(True))


def deduplicated(docs: DataFrame, *, key: str = "doc_id", text: str = "text", min_chars: int = MIN_CHARS) -> DataFrame:
    """``(doc_id, n_lines, n_dropped, kept_text)``, a row for each row of ``docs``.

    A document without losses keeps its text as it is, empty for null.
    """
    maps = keep_bitmaps(docs, key=key, text=text, min_chars=min_chars)
    maps = maps.select(F.col("doc_id").alias("_id"), F.col("text_hash").alias("_hash"), "n_dropped", "keep")
    rows = docs.select(F.col(key).alias("doc_id"), F.col(text).alias("text"), F.xxhash64(text).alias("text_hash"))
    joined = rows.join(maps, (F.col("doc_id") == F.col("_id")) & (F.col("text_hash") == F.col("_hash")), "left")
    split = lines(F.col("text"))
    kept = F.array_join(F.filter(split, lambda _, i: is_kept(F.col("keep"), i)), "\n")
    return joined.select(
        "doc_id", F.size(split).cast("long").alias("n_lines"), F.coalesce("n_dropped", F.lit(0)).cast("long").alias("n_dropped"),
        F.when(F.col("keep").isNull(), F.coalesce("text", F.lit(""))).otherwise(kept).alias("kept_text"),
    )

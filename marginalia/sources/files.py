"""Documents, keys, feature tables and label streams from files."""

from __future__ import annotations

import os
import re
from urllib.parse import urlsplit

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql.utils import AnalysisException

from marginalia.functions import keys as ky
from marginalia.operators.lookup import BROADCAST_BYTES, measured_bytes
from marginalia.session import ensure_checkpoint_dir
from marginalia.sources import listing

LOG_LINES = 2  # fixed value: lines a tagger prints before its labels


def stored_path():
    """The file's path as it is stored (the metadata column is URL-encoded)."""
    return F.url_decode(F.replace(F.col("_metadata.file_path"), F.lit("+"), F.lit("%2B")))


def _scheme_free(path: str) -> str:
    return re.sub("^[A-Za-z][A-Za-z0-9+.-]*:(//[^/]*)?", "", path)


def _below(folder: str, path: Column) -> Column:
    """The part of a path below the folder, whatever form its scheme has: the folder is cut off once, from the left.

    Of a folder with wildcards, the part before the first of them is cut off.
    """
    fixed = re.split(r"[^/]*[*?{\[]", folder, maxsplit=1)[0]
    root = _scheme_free(fixed).strip("/")
    if fixed == _scheme_free(fixed) and not fixed.startswith("/"):
        # A relative folder: where it begins is the file system's matter, so its first occurrence counts.
        near = os.path.abspath(fixed).strip("/")
        bare = F.ltrim(F.regexp_replace(path, "^[A-Za-z][A-Za-z0-9+.-]*:(//[^/]*)?", ""), F.lit("/"))
        rest = F.substring(path, F.locate(f"/{root}/", path) + len(root) + 2, F.length(path))
        return F.when(bare.startswith(f"{near}/"), F.substring(bare, len(near) + 2, 1 << 30)).otherwise(rest)
    bare = F.ltrim(F.regexp_replace(path, "^[A-Za-z][A-Za-z0-9+.-]*:(//[^/]*)?", ""), F.lit("/"))
    return F.substring(bare, len(root) + 2 if root else 1, 1 << 30)


def scan_session(spark: SparkSession, **settings: str) -> SparkSession:
    """A session beside the caller's, with its settings and these: how a scan is split is the scan's own matter."""
    beside = spark.newSession()
    for name, value in spark.conf.getAll.items():
        if beside.conf.isModifiable(name):
            beside.conf.set(name, value)
    for name, value in settings.items():
        beside.conf.set(name, value)
    return beside


def _keys(
    spark: SparkSession, folder: str, *, prefix: str = "", start_after: str = "", recursive: bool = True
) -> DataFrame:
    """``(key, length, modified)``, listed by the tasks; stores that only Spark opens are listed by its file index,
    which leaves out files of zero length."""
    if listing.can_list(folder):
        try:
            spark.dataSource.register(listing.KeyListing)
        except AnalysisException as known:  # by another session of the application
            if known.getCondition() != "DATA_SOURCE_ALREADY_EXISTS":
                raise
        found = spark.read.format("keys").option("prefix", prefix).option("start_after", start_after)
        place = folder if urlsplit(folder).scheme else os.path.abspath(folder)
        return found.option("recursive", str(recursive).lower()).load(place)
    files = spark.read.format("binaryFile").option("recursiveFileLookup", recursive).load(folder)
    keys = files.select(
        _below(folder, F.col("path")).alias("key"), "length", F.col("modificationTime").alias("modified")
    )
    return keys.filter(ky.listed_after(F.col("key"), prefix, start_after))


def _document_id(key: Column, recursive: bool, short_ids: bool) -> Column:
    """The key without its extension; the base name alone where only one folder is read."""
    parent = F.regexp_extract(key, "^(.*/)?[^/]*$", 1) if recursive else F.lit("")
    return F.concat(parent, ky.short_id(key) if short_ids else ky.document_id(key))


def whole_files(
    spark: SparkSession, folder: str, *, suffix: str, recursive: bool = False, min_partitions: int | None = None,
    short_ids: bool = False, keep_empty: bool = True,
) -> DataFrame:
    """``(doc_id, path, text)``, one row per file with this suffix.

    Spark's scans pass over files of zero length; they are taken from the
    listing, which the tasks make, and give empty documents (``keep_empty=False``: no row).  With
    ``recursive``, an id is the path below the folder, so that equal names in two folders stay apart.

    ``min_partitions`` splits the scan itself finer, nothing is shuffled and no
    setting of the caller's session is changed.
    """
    reader = scan_session(spark, **{"spark.sql.files.minPartitionNum": str(min_partitions)}) if min_partitions else spark
    options = {"pathGlobFilter": f"*{suffix}", "recursiveFileLookup": recursive}
    files = reader.read.text(folder, wholetext=True, **options)
    named = files.select(stored_path().alias("path"), F.col("value").alias("text"))
    key = _below(folder, F.col("path")) if recursive else F.col("path")
    found = named.select(_document_id(key, recursive, short_ids).alias("doc_id"), "path", "text")
    if not keep_empty or not listing.can_list(folder) or re.search(r"[*?{\[]", folder):
        return found
    empty = _keys(spark, folder, recursive=recursive).filter("length = 0").filter(ky.has_suffix(F.col("key"), suffix))
    return found.unionByName(empty.select(
        _document_id(F.col("key"), recursive, short_ids).alias("doc_id"),
        F.concat(F.lit(folder.rstrip("/") + "/"), "key").alias("path"), F.lit("").alias("text"),
    ))


def numbered_lines(
    spark: SparkSession, folder: str, *, suffix: str, recursive: bool = False, short_ids: bool = False,
    split_bytes: int | None = None,
) -> DataFrame:
    """``(doc_id, path, line_no, line)`` of files of any size, lines numbered from 0 in each file.

    A large file is read by many tasks, split as any text is.  One pass counts
    the lines of each split; a line's number is its place in its split and the
    lines of the splits before it.  How the files are split is fixed for both
    passes (``split_bytes``, or the session's ``maxPartitionBytes``).
    """
    size = str(split_bytes or spark.conf.get("spark.sql.files.maxPartitionBytes"))
    fixed = spark.conf.get("spark.sql.files.minPartitionNum", None) or spark.conf.get("spark.sql.shuffle.partitions")
    reader = scan_session(
        spark, **{"spark.sql.files.maxPartitionBytes": size, "spark.sql.files.minPartitionNum": str(fixed)}
    )
    ensure_checkpoint_dir(reader)
    options = {"pathGlobFilter": f"*{suffix}", "recursiveFileLookup": recursive, "lineSep": "\n"}
    scanned = reader.read.text(folder, **options).select(
        stored_path().alias("path"), F.col("_metadata.file_block_start").alias("_start"),
        F.monotonically_increasing_id().alias("_place"), F.col("value").alias("line"),
    )
    blocks = scanned.groupBy("path", "_start").agg(F.count("*").alias("_lines"), F.min("_place").alias("_first"))
    before = Window.partitionBy("path").orderBy("_start").rowsBetween(Window.unboundedPreceding, -1)
    based = blocks.withColumn("_base", F.coalesce(F.sum("_lines").over(before), F.lit(0))).drop("_lines").checkpoint()
    if measured_bytes(based) <= BROADCAST_BYTES:
        based = F.broadcast(based)
    joined = scanned.join(based, ["path", "_start"], "left")
    number = F.coalesce(
        F.col("_place") - F.col("_first") + F.col("_base"),
        F.raise_error(F.lit("the files changed while they were read")).cast("long"),
    )
    key = _below(folder, F.col("path")) if recursive else F.col("path")
    return joined.select(_document_id(key, recursive, short_ids).alias("doc_id"), "path", number.alias("line_no"), "line")


def text_documents(spark: SparkSession, folder: str, **options) -> DataFrame:
    """Whole plain-text documents."""
    return whole_files(spark, folder, suffix=".txt", **options)


def markup_documents(spark: SparkSession, folder: str, **options) -> DataFrame:
    """Whole page-markup documents."""
    return whole_files(spark, folder, suffix=".xml", **options)


def list_keys(
    spark: SparkSession, folder: str, *, prefix: str = "", start_after: str = "", suffix: str = ""
) -> DataFrame:
    """``(key, length, modified)`` of the files under a folder, empty ones included; contents are not read.

    Keys are relative to the folder; ``prefix`` and ``start_after`` act on them,
    and folders that they rule out are not entered.
    """
    return _keys(spark, folder, prefix=prefix, start_after=start_after).filter(ky.has_suffix(F.col("key"), suffix))


def feature_tokens(spark: SparkSession, folder: str, *, suffix: str = ".txt", split_bytes: int | None = None) -> DataFrame:
    """``(doc_id, pos, token)``: the first column of stored feature lines, as strings.

    A file is one document of any size; its line order is the token order.
    """
    lines = numbered_lines(spark, folder, suffix=suffix, split_bytes=split_bytes)
    return lines.select("doc_id", F.col("line_no").cast("int").alias("pos"), F.split("line", " ")[0].alias("token"))


def label_stream(spark: SparkSession, folder: str, *, suffix: str = ".txt", split_bytes: int | None = None) -> DataFrame:
    """``(doc_id, pos, label)`` from a tagger's printed output, one file of any size per document.

    The first two lines are log lines; every label line ends in one extra character.
    """
    lines = numbered_lines(spark, folder, suffix=suffix, split_bytes=split_bytes).filter(F.col("line_no") >= LOG_LINES)
    label = F.substring("line", F.lit(1), F.length("line") - 1)
    return lines.select("doc_id", (F.col("line_no") - LOG_LINES).cast("int").alias("pos"), label.alias("label"))

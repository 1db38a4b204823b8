"""Ordered work over row tables ``(key, order, ...)`` of any key size.

For sequences that arrive as rows (label streams, events, turns) rather than
inside a document row.  One key may own a large share of all rows, so a plain
window per key would put that share in one task.  Here every key is cut into
chunks, a number that never falls along the order: the heavy windows run per
(key, chunk), and only one summary row per chunk (or the two runs at its edges)
goes through a window per key.  Chunks come from dense positions, or are measured:
only keys of more than ``CHUNK_ROWS`` rows are cut, at quantiles of their order.
"""

from __future__ import annotations

from math import ceil, isqrt

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from marginalia.functions.sequence import let
from marginalia.functions.spans import begins, continues, label_type
from marginalia.operators.lookup import lookup
from marginalia.session import ensure_checkpoint_dir

CHUNK_ROWS = 65_536


def position_chunk(pos: str = "pos", rows: int = CHUNK_ROWS) -> Column:
    """Chunk of a dense integer position."""
    return F.floor(F.col(pos) / rows)


def _cuts_below(cuts: Column, value: Column, width: int) -> Column:
    """How many of the ascending ``cuts`` are at most ``value``: by every ``width``-th of them, then those in between."""
    coarse = F.size(F.filter(cuts, lambda c, i: (i % width == width - 1) & (c <= value)))
    return let(coarse, lambda n: n * width + F.size(F.filter(F.slice(cuts, n * width + 1, F.lit(width)), lambda c: c <= value)))


def with_chunks(df: DataFrame, key: str, order: list[str], chunk: Column | None, rows: int | None = None) -> DataFrame:
    """Add ``_chunk``: the given one, or one by which no key has many more than ``rows`` rows of a chunk.

    Rows are counted by key.  Keys that are too large, if there are any, are cut
    at quantiles of the first order column, a number, date or time; rows that
    are equal in it stay together.  The cuts are checkpointed, so they hold for
    all that is made of the rows, also after an executor is lost.
    """
    if chunk is not None:
        return df.withColumn("_chunk", chunk)
    rows = rows or CHUNK_ROWS
    by_hash = F.xxhash64(key).alias("_hash")  # keys that share a hash share cuts, which is as good
    large = df.groupBy(by_hash).agg(F.count("*").alias("_rows")).filter(F.col("_rows") > rows)
    ensure_checkpoint_dir(df.sparkSession)
    found = large.agg(F.max("_rows").alias("most"), F.count("*").alias("keys"), F.sum("_rows").alias("all")).first()
    if not found["keys"]:
        return df.withColumn("_chunk", F.lit(0))
    large = large.checkpoint()
    parts = ceil(found["most"] / rows)
    shares = F.array(*[F.lit(n / parts) for n in range(1, parts)])
    place = F.col(order[0])
    keyed = df.select(by_hash, place.alias("_place"))
    of_large = keyed.join(F.broadcast(large) if found["keys"] <= 100_000 else large, "_hash")
    cuts = of_large.groupBy("_hash", "_rows").agg(F.percentile_approx("_place", shares, 10 * parts).alias("_all"))
    # A key has as many cuts as its own size asks for.
    step = F.greatest(F.floor(F.lit(parts) * rows / F.col("_rows")), F.lit(1)).cast("int")
    cuts = cuts.select(F.col("_hash").alias("_of"), F.array_distinct(F.filter("_all", lambda c, i: (i + 1) % step == 0)).alias("_cuts"))
    cuts = cuts.checkpoint()
    size = 64 * found["keys"] + 16 * ceil(2 * found["all"] / rows)
    joined = lookup(df, cuts, F.xxhash64(key), word="_of", salt_by=order, measured=size)
    number = _cuts_below(F.col("_cuts"), place, isqrt(parts) + 1)
    return joined.withColumn("_chunk", F.when(F.col("_cuts").isNotNull() & place.isNotNull(), number).otherwise(0)).drop("_cuts")


def _chunk_windows(key: str, order: list[str]):
    per_chunk = Window.partitionBy(key, "_chunk").orderBy(*order)
    over_chunks = Window.partitionBy(key).orderBy("_chunk")
    return per_chunk, over_chunks


def _with_carry(df: DataFrame, key: str, summary: Column, carry) -> DataFrame:
    """Join each (key, chunk) with what ``carry`` makes of the earlier summaries."""
    summaries = df.groupBy(key, "_chunk").agg(summary.alias("_summary"))
    over_chunks = Window.partitionBy(key).orderBy("_chunk")
    carried = summaries.select(key, "_chunk", carry(F.col("_summary"), over_chunks).alias("_carry"))
    # A null key or chunk is a key like any other: its rows stay.
    carried = carried.withColumnsRenamed({key: "_key", "_chunk": "_part"})
    same = df[key].eqNullSafe(carried["_key"]) & df["_chunk"].eqNullSafe(carried["_part"])
    return df.join(carried, same).drop("_key", "_part")


def running_sum(
    df: DataFrame, value: Column, out: str, *, key: str, order: list[str], chunk: Column | None = None
) -> DataFrame:
    """Add the sum of ``value`` over the earlier rows of the key (0 for the first)."""
    per_chunk, _ = _chunk_windows(key, order)
    earlier = per_chunk.rowsBetween(Window.unboundedPreceding, -1)
    rows = with_chunks(df, key, order, chunk).withColumn("_value", value)
    rows = _with_carry(
        rows, key, F.sum("_value"),
        lambda s, w: F.coalesce(F.sum(s).over(w.rowsBetween(Window.unboundedPreceding, -1)), F.lit(0)),
    )
    total = F.col("_carry") + F.coalesce(F.sum("_value").over(earlier), F.lit(0))
    return rows.withColumn(out, total).drop("_chunk", "_value", "_carry")


def carry_forward(
    df: DataFrame, value: Column, out: str, *, key: str, order: list[str], chunk: Column | None = None
) -> DataFrame:
    """Add the last non-null ``value`` among the earlier rows of the key."""
    per_chunk, _ = _chunk_windows(key, order)
    earlier = per_chunk.rowsBetween(Window.unboundedPreceding, -1)
    rows = with_chunks(df, key, order, chunk).withColumn("_value", value)
    place = F.when(F.col("_value").isNotNull(), F.struct(*order))
    rows = _with_carry(
        rows, key, F.max_by("_value", place),
        lambda s, w: F.last(s, ignorenulls=True).over(w.rowsBetween(Window.unboundedPreceding, -1)),
    )
    last = F.coalesce(F.last("_value", ignorenulls=True).over(earlier), F.col("_carry"))
    return rows.withColumn(out, last).drop("_chunk", "_value", "_carry")


def token_offsets(
    tokens: DataFrame, *, doc: str = "doc_id", pos: str = "pos", token: str = "token", chunk: Column | None = None
) -> DataFrame:
    """Add ``tok_start`` and ``tok_end`` in the blank-joined text of each document."""
    chunk = position_chunk(pos) if chunk is None else chunk
    rows = running_sum(tokens, F.length(token) + 1, "tok_start", key=doc, order=[pos], chunk=chunk)
    return rows.withColumn("tok_end", F.col("tok_start") + F.length(token))


def section_carry(
    rows: DataFrame, is_header: Column, text: Column, *, key: str, order: list[str], chunk: Column | None = None,
    out: str = "section",
) -> DataFrame:
    """Add the text of the last header before the row; headers themselves get null."""
    carried = carry_forward(rows, F.when(is_header, text), out, key=key, order=order, chunk=chunk)
    return carried.withColumn(out, F.when(~is_header, F.col(out)))


def align_labels(
    tokens: DataFrame, labels: DataFrame, *, doc: str = "doc_id", pos: str = "pos"
) -> DataFrame:
    """Positional pairing of two row tables, cut to the shorter one.

    The position is part of the join key, so a long document is spread out.
    """
    return tokens.join(labels, [doc, pos])


def _edges(segments: DataFrame, key: str, number: str) -> tuple[DataFrame, DataFrame]:
    """Segments inside a chunk, and those that touch its start or end."""
    per_chunk = Window.partitionBy(key, "_chunk")
    marked = segments.withColumn("_last", F.max(number).over(per_chunk)).withColumn(
        "_first", F.min(number).over(per_chunk)
    )
    edge = (F.col(number) == F.col("_last")) | (F.col(number) == F.col("_first"))
    return marked.filter(~edge), marked.filter(edge)


def runs(
    df: DataFrame, label: str, *, key: str, order: list[str], chunk: Column | None = None
) -> DataFrame:
    """Runs of equal labels: ``(key, label, first, last, rows)``.

    ``first`` and ``last`` hold the order columns at the run's ends.  Rows are
    reduced to runs inside each chunk; only edge runs can join across chunks.
    """
    per_chunk, _ = _chunk_windows(key, order)
    changed = ~F.col(label).eqNullSafe(F.lag(label).over(per_chunk)) | F.row_number().over(per_chunk).eqNullSafe(1)
    rows = with_chunks(df, key, order, chunk).withColumn("_changed", changed.cast("int"))
    rows = rows.withColumn("_run", F.sum("_changed").over(per_chunk))
    place = F.struct(*order)
    local = rows.groupBy(key, "_chunk", "_run", label).agg(
        F.min(place).alias("first"), F.max(place).alias("last"), F.count("*").alias("rows")
    )
    inner, edge = _edges(local, key, "_run")
    over_edges = Window.partitionBy(key).orderBy("_chunk", "_run")
    joins = (F.lag("_chunk").over(over_edges) != F.col("_chunk")) & F.col(label).eqNullSafe(
        F.lag(label).over(over_edges)
    )
    edge = edge.withColumn("_new", F.when(joins, 0).otherwise(1))
    edge = edge.withColumn("_group", F.sum("_new").over(over_edges))
    merged = edge.groupBy(key, "_group", label).agg(
        F.min("first").alias("first"), F.max("last").alias("last"), F.sum("rows").alias("rows")
    )
    columns = [key, label, "first", "last", "rows"]
    return inner.select(*columns).unionByName(merged.select(*columns))


def _ordered_text(pieces: str) -> Column:
    return F.array_join(F.transform(F.array_sort(pieces), lambda p: p["text"]), " ")


def bio_entities(
    df: DataFrame, *, doc: str = "doc_id", pos: str = "pos", token: str = "token", label: str = "label",
    start: str = "tok_start", end: str = "tok_end", chunk: Column | None = None,
) -> DataFrame:
    """BIO decode of a row table with offsets: ``(doc, text, start, end, type)``.

    The rules are those of ``functions.spans.bio_spans``.  Outside rows are
    dropped first, so only entity tokens are shuffled; a gap in the positions
    then closes an entity.  ``I`` rows that open a chunk may continue the last
    segment of the chunk before.
    """
    per_chunk, _ = _chunk_windows(doc, [pos])
    rows = df.filter(begins(F.col(label)) | continues(F.col(label)))
    rows = rows.withColumn("_chunk", position_chunk(pos) if chunk is None else chunk)
    gap = F.coalesce(F.col(pos) != F.lag(pos).over(per_chunk) + 1, F.lit(False))
    rows = rows.withColumn("_head", (begins(F.col(label)) | gap).cast("int"))
    rows = rows.withColumn("_seg", F.sum("_head").over(per_chunk))
    local = rows.groupBy(doc, "_chunk", "_seg").agg(
        F.min_by(label, pos).alias("_label"),
        F.min(start).alias("start"),
        F.max(end).alias("end"),
        F.min(pos).alias("_from"),
        F.max(pos).alias("_to"),
        F.collect_list(F.struct(F.col(pos).alias("at"), F.col(token).alias("text"))).alias("_pieces"),
    )
    inner, edge = _edges(local, doc, "_seg")
    over_edges = Window.partitionBy(doc).orderBy("_from")
    joins = continues(F.col("_label")) & (F.col("_from") == F.lag("_to").over(over_edges) + 1)
    edge = edge.withColumn("_new", F.when(joins, 0).otherwise(1))
    edge = edge.withColumn("_group", F.sum("_new").over(over_edges))
    merged = edge.groupBy(doc, "_group").agg(
        F.min_by("_label", "_from").alias("_label"),
        F.min("start").alias("start"),
        F.max("end").alias("end"),
        F.flatten(F.collect_list("_pieces")).alias("_pieces"),
    )
    columns = [doc, "_label", "start", "end", "_pieces"]
    segments = inner.select(*columns).unionByName(merged.select(*columns))
    return segments.filter(begins(F.col("_label"))).select(
        doc,
        _ordered_text("_pieces").alias("text"),
        "start",
        "end",
        label_type(F.col("_label")).alias("type"),
    )


def entity_arrays(entities: DataFrame, *, doc: str = "doc_id", columns: tuple[str, ...] = ("text", "start", "end", "type")) -> DataFrame:
    """Entity rows to one array per document, ordered by offset."""
    lead = F.struct("start", "end", *[c for c in columns if c not in ("start", "end")])
    grouped = entities.groupBy(doc).agg(F.sort_array(F.collect_list(lead)).alias("_sorted"))
    return grouped.select(
        doc, F.transform("_sorted", lambda e: F.struct(*[e[c].alias(c) for c in columns])).alias("entities")
    )

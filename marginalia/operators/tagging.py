"""Sequence taggers: built-in rules and word lists, and models the user brings."""

from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.pandas.types import to_arrow_schema

from marginalia.functions import features as ft
from marginalia.functions import spans as sp
from marginalia.functions import text as tx
from marginalia.functions.sequence import MARK, let, positions, running_total, segments
from marginalia.operators.features import feature_columns, with_word_values, word_table
from marginalia.operators.lookup import BROADCAST_BYTES, lookup, measured_bytes
from marginalia.operators.text import explode_rows

SENTENCE_BATCH = 50  # fixed value: sentences handed to an entity model at once
HELD = 65_536  # tokens or chunks that are Python objects at once, or those of one document
MEMO_FEATURES = 50_000  # words whose features a task remembers before it starts afresh

FOUND_TYPE = "array<struct<sent_id:int,text:string,start:int,end:int,type:string>>"


# --- built-in taggers -------------------------------------------------------


def rule_labels(tokens: Column, kind: Callable[[Column], Column] = ft.rule_type) -> Column:
    """BIO labels of a token array by a rule on each (ASCII) token."""
    return let(F.transform(tokens, lambda t: kind(t)), sp.bio_labels)


def rule_tags(df: DataFrame, *, doc: str = "doc_id", text: str = "text", keep: tuple[str, ...] = (), kind=ft.rule_type) -> DataFrame:
    """``(doc, keep..., tokens, labels)`` by the built-in rule; one row per document."""
    tokens = tx.ascii_tokens(text)
    pair = let(tokens, lambda tk: F.struct(tk.alias("tokens"), rule_labels(tk, kind).alias("labels")))
    return df.select(doc, *keep, pair.alias("_t")).select(
        doc, *keep, F.col("_t.tokens").alias("tokens"), F.col("_t.labels").alias("labels")
    )


def lexicon_tags(
    df: DataFrame, gazetteer: DataFrame, *, doc: str = "doc_id", text: str = "text", word: str = "word",
    kind: str = "type", broadcast_bytes: int = BROADCAST_BYTES,
) -> DataFrame:
    """``(doc, pos, token, label, tok_start, tok_end)`` by a gazetteer ``(word, type)``.

    Offsets in the blank-joined text come along.  The previous token travels
    with each row and is looked up as well, so that B and I are told apart
    without a window.
    """
    tokens = let(
        sp.token_offsets(tx.ascii_tokens(text)),
        lambda tk: F.transform(
            tk, lambda t, i: t.withField("before", F.when(i > 0, F.get(tk, i - 1)["token"]))
        ),
    )
    rows = explode_rows(df, tokens, doc).select(doc, "pos", "item.*")
    types = gazetteer.groupBy(word).agg(F.min(kind).alias("_type"))
    args = {"word": word, "salt_by": [doc, "pos"], "broadcast_bytes": broadcast_bytes}
    args["measured"] = measured_bytes(types)
    rows = lookup(rows, types, F.col("token"), **args)
    # The type before matters only where there is one to go on with.
    before = F.when(F.col("_type").isNotNull(), F.col("before"))
    rows = lookup(rows, types.withColumnRenamed("_type", "_type_before"), before, **args)
    label = sp.bio_label(F.col("_type"), F.col("_type_before"))
    return rows.select(doc, "pos", "token", label.alias("label"), "tok_start", "tok_end")


def rule_entities(marked: Column, kind: Callable[[Column], Column] = ft.rule_type) -> Column:
    """Entities of a text with character offsets, as a model would give them.

    ``marked`` is ASCII text with a mark wherever a sentence ends.  Neighbouring
    tokens of one type in one sentence make an entity; its text is the text
    from its first to its last character.
    """

    def unmarked(text: Column) -> Column:
        return F.replace(text, F.lit(MARK), F.lit(""))

    def measured(ps: Column, bounds: Column, kinds: Column) -> Column:
        return F.transform(
            segments(bounds, F.size(ps)),
            lambda s: F.struct(
                unmarked(F.array_join(F.slice(ps, s["first"] + 1, s["last"] - s["first"] + 1), "")).alias("text"),
                F.get(kinds, s["first"]).alias("type"),
            ),
        )

    def entities(parts: Column) -> Column:
        return let(
            running_total(F.transform(parts, lambda p: F.length(p["text"]))),
            lambda at: F.transform(
                F.filter(
                    F.transform(parts, lambda p, k: p.withField("start", F.get(at, k))),
                    lambda p: p["type"].isNotNull(),
                ),
                lambda p: let(
                    tx.piece_token(p["text"]),
                    lambda text: F.struct(
                        text.alias("text"),
                        p["start"].alias("start"),
                        (p["start"] + F.length(text)).alias("end"),
                        p["type"].alias("type"),
                    ),
                ),
            ),
        )

    def decode(ps: Column, kinds: Column) -> Column:
        def is_cut(k: Column, i: Column) -> Column:
            before = F.get(kinds, i - 1)
            ended = k.isNotNull() & F.get(ps, i - 1).contains(MARK)
            return (i == 0) | ~k.eqNullSafe(before) | ended

        return let(
            positions(kinds, is_cut),
            lambda bounds: let(measured(ps, bounds, kinds), entities),
        )

    return let(
        F.split(marked, tx.PIECE_CUT, -1),
        lambda ps: let(F.transform(ps, lambda p: kind(tx.piece_token(p))), lambda kinds: decode(ps, kinds)),
    )


def rule_found(sentences: Column, kind: Callable[[Column], Column] = ft.rule_type) -> Column:
    """Sentence entities of a whole document, in the shape ``tag_sentences`` gives."""
    return F.flatten(
        F.transform(
            sentences,
            lambda s, i: F.transform(
                rule_entities(s, kind),
                lambda e: F.struct(
                    i.alias("sent_id"),
                    e["text"].alias("text"),
                    e["start"].alias("start"),
                    e["end"].alias("end"),
                    e["type"].alias("type"),
                ),
            ),
        )
    )


def document_offsets(found: Column, sentences: Column) -> Column:
    """Sentence offsets to document offsets: add the length of the earlier sentences."""
    return let(running_total(F.transform(sentences, F.length)), lambda base: moved_by(found, base))


def moved_by(found: Column, base: Column) -> Column:
    """Sentence offsets to document offsets, given where each sentence begins."""
    return F.transform(
        found,
        lambda e: F.struct(
            e["text"].alias("text"),
            (e["start"] + F.get(base, e["sent_id"])).alias("start"),
            (e["end"] + F.get(base, e["sent_id"])).alias("end"),
            e["type"].alias("type"),
        ),
    )


# --- taggers the user brings ------------------------------------------------


def _annotate(
    df: DataFrame, open_model: Callable[[], Callable], column: str, apply: Callable, out: str, kind: str
) -> DataFrame:
    """Add ``out = apply(model, value)`` for each document, and how that went.

    The model is opened once per partition.  A document it fails on keeps its
    row: ``status`` is ``error``, ``error`` tells why and ``out`` is null.
    """
    added = T.StructType.fromDDL(f"{out} {kind}, status string, error string")
    schema = T.StructType(df.schema.fields + added.fields)
    arrow = to_arrow_schema(schema)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        model = open_model()
        for part in _small(batches, column):
            results, errors = [], []
            for value in part.column(column).to_pylist():
                try:
                    results.append(apply(model, list(value)))
                    errors.append(None)
                except Exception as failure:  # one bad document must not end the job
                    results.append(None)
                    errors.append(f"{type(failure).__name__}: {failure}")
            status = ["ok" if e is None else "error" for e in errors]
            made = [pa.array(v, arrow.field(n).type) for n, v in ((out, results), ("status", status), ("error", errors))]
            yield pa.RecordBatch.from_arrays([*part.columns, *made], names=arrow.names)

    return df.mapInArrow(run, schema)


def _small(batches: Iterator[pa.RecordBatch], column: str) -> Iterator[pa.RecordBatch]:
    """Slices of the batches with about ``HELD`` elements of ``column``, so that few of them are Python objects at once."""
    for part in batches:
        ends = np.cumsum(pc.fill_null(pc.list_value_length(part.column(column)), 0).to_numpy(zero_copy_only=False) + 1)
        first = 0
        while first < part.num_rows:
            before = ends[first - 1] if first else 0
            after = max(int(np.searchsorted(ends, before + HELD, "right")), first + 1)
            yield part.slice(first, after - first)
            first = after


def tag_sequences(
    df: DataFrame, open_tagger: Callable[[], Callable], *, sequence: str = "tokens", out: str = "labels"
) -> DataFrame:
    """Label every document with a sequence model, one document = one sequence.

    The tagger gets the sequence (a list of tokens, or of feature rows as dicts)
    and gives one label per element; any other number is an error of the document.
    """

    def labels(tagger, values: list) -> list[str]:
        found = [str(label) for label in tagger(values)]
        if len(found) != len(values):
            raise ValueError(f"{len(found)} labels for {len(values)} elements")
        return found

    return _annotate(df, open_tagger, sequence, labels, out, "array<string>")


def _labelled(sequences: Iterator[tuple[dict, list[dict]]], open_tagger: Callable, schema: pa.Schema) -> Iterator[pa.RecordBatch]:
    """``(document's columns, its feature rows)`` to rows with tokens, labels and how that went."""
    tagger, held = open_tagger(), []
    for head, features in sequences:
        row = {**head, "tokens": [f["names"] for f in features], "labels": None, "status": "ok", "error": None}
        try:
            row["labels"] = [str(label) for label in tagger(features)]
            if len(row["labels"]) != len(features):
                raise ValueError(f"{len(row['labels'])} labels for {len(features)} elements")
        except Exception as failure:  # one bad document must not end the job
            row |= {"labels": None, "status": "error", "error": f"{type(failure).__name__}: {failure}"}
        held.append(row)
        if len(held) == 64:
            yield pa.RecordBatch.from_pylist(held, schema)
            held = []
    if held:
        yield pa.RecordBatch.from_pylist(held, schema)


def _objects(values: pa.Array) -> list:
    """As ``to_pylist``; strings and plain numbers at once, not one by one, which takes a tenth of the time."""
    kind = values.type
    if pa.types.is_list(kind):
        flat, ends = _objects(values.flatten()), np.cumsum(pc.fill_null(pc.list_value_length(values), 0).to_numpy(zero_copy_only=False)).tolist()
        rows = (flat[start:end] for start, end in zip([0, *ends], ends))
        return [row if known else None for row, known in zip(rows, values.is_valid().to_pylist())]
    if pa.types.is_string(kind) or not values.null_count and (pa.types.is_boolean(kind) or pa.types.is_integer(kind) or pa.types.is_floating(kind)):
        return values.to_numpy(zero_copy_only=False).tolist()
    return values.to_pylist()


def _as_dicts(rows: pa.StructArray) -> Iterator[dict]:
    """The rows as dicts, read column by column."""
    names = [f.name for f in rows.type]
    return (dict(zip(names, values)) for values in zip(*map(_objects, rows.flatten())))


def _streamed(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple[dict, list[dict]]]:
    """Documents whose distinct words stream by; each begins with a row that has its columns and its tokens.

    Features are read once for each word that is not remembered; the tagger gets copies of its own.
    """
    memo: dict[str, dict] = {}
    head, raw, values = None, [], {}

    def features() -> list[dict]:
        return [dict(values[t]) for t in raw]

    for batch in batches:
        words, made = _objects(batch.column("token")), batch.column("_feature")
        fresh = {w: n for n, w in enumerate(words) if w is not None and w not in memo}
        if len(memo) + len(fresh) > MEMO_FEATURES:
            memo = {}
            fresh = {w: n for n, w in enumerate(words) if w is not None}
        memo.update(zip(fresh, _as_dicts(made.take(pa.array(fresh.values(), pa.int32())))))
        firsts = pc.is_valid(batch.column("_head")).to_numpy(zero_copy_only=False).nonzero()[0]
        heads = iter(batch.column("_head").take(firsts).to_pylist())
        tokens = iter(_objects(batch.column("_raw").take(firsts)))
        # Rows before the first head go on with the document at hand.
        values.update((w, memo[w]) for w in words[:firsts[0] if len(firsts) else None])
        for at, end in zip(firsts, [*firsts[1:], len(words)]):
            if head is not None:
                yield head, features()
            head, raw = next(heads), next(tokens) or []
            values = {w: memo[w] for w in words[at:end] if w is not None}
    if head is not None:
        yield head, features()


def _with_vocabulary(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple[dict, list[dict]]]:
    """Documents of a part behind the values of all its words."""
    part, values = None, {}
    for batch in batches:
        for row in batch.to_pylist():
            if row["_part"] != part:
                part, values = row["_part"], {}
            if row["_head"] is None:
                values[row["token"]] = {n: row[n] for n in ("ExistinDict", "Lemma", "Stem")}
            else:
                found = ((f, values[t]) for t, f in zip(row["_raw"] or [], row["_features"] or []))
                yield row["_head"], [{n: w[n] if n in w else f[n] for n in ft.FEATURE_ORDER} for f, w in found]


def tag_features(
    df: DataFrame, open_tagger: Callable[[], Callable], *, lexicon: DataFrame, lemmas: DataFrame, stems: DataFrame | None = None,
    stemmer: Callable[[str], str] | None = None, doc: str = "doc_id", text: str = "text", keep: tuple[str, ...] = (),
    broadcast_bytes: int = BROADCAST_BYTES,
) -> DataFrame:
    """``(doc, keep..., tokens, labels, status, error)``, one row for each document.

    The tagger gets a document's tokens as a list of dicts of the 19 features,
    in order, and gives one label for each; a null or empty text is an empty list.

    A word table up to ``broadcast_bytes`` is broadcast: the distinct words of a
    document are rows only between the scan and the tagger, behind its tokens,
    and nothing of a document is shuffled.  Beyond it, the distinct words of a part
    of the documents are looked up, and the part's documents are dealt behind
    their words' values; a frequent word counts once in each part.
    """
    table = word_table(lexicon, lemmas, stems)
    size = measured_bytes(table)
    head = F.struct(doc, *keep)
    raw = df.select(head.alias("_doc"), tx.tokens(text).alias("_raw"))
    kinds = T.StructType([*df.select(doc, *keep).schema.fields, *T.StructType.fromDDL(
        "tokens array<string>, labels array<string>, status string, error string").fields])
    arrow = to_arrow_schema(kinds)
    if size <= broadcast_bytes:
        # Only a document's first row has its columns and its tokens: beside each word they would be copied as often as it has words.
        no_word = F.array(F.lit(None).cast("string"))
        distinct = F.when(F.size("_raw") > 0, F.array_distinct("_raw")).otherwise(no_word)
        packed = F.transform(distinct, lambda t, n: F.struct(
            F.when(n == 0, F.col("_doc")).alias("_head"), F.when(n == 0, F.col("_raw")).alias("_raw"), t.alias("token")
        ))
        rows = raw.select(F.explode(packed).alias("_row")).select("_row.*")
        valued = with_word_values(rows, table, salt_by=["token"], stemmer=stemmer, broadcast_bytes=broadcast_bytes, measured=size)
        made = valued.select("_head", "_raw", "token", F.struct(*feature_columns()).alias("_feature"))
        return made.mapInArrow(lambda batches: _labelled(_streamed(batches), open_tagger, arrow), kinds)
    parts = int(df.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    dealt = raw.withColumn("_part", F.pmod(F.xxhash64("_raw"), F.lit(parts)).cast("int"))
    words = dealt.select("_part", F.explode(F.array_distinct("_raw")).alias("token")).distinct()
    valued = with_word_values(words, table, salt_by=["_part"], stemmer=stemmer, broadcast_bytes=broadcast_bytes, measured=size)

    def described(t: Column) -> Column:
        return let(tx.ascii_drop(t), lambda name: F.struct(name.alias("names"), *[c.alias(n) for n, c in ft.token_features(name).items()]))

    docs = dealt.select("_part", F.col("_doc").alias("_head"), "_raw", F.transform("_raw", described).alias("_features"))
    both = docs.unionByName(valued.drop("names"), allowMissingColumns=True)
    ordered = both.repartition("_part").sortWithinPartitions("_part", F.col("_head").isNotNull())
    return ordered.mapInArrow(lambda batches: _labelled(_with_vocabulary(batches), open_tagger, arrow), kinds)


def _batched(model, texts: list[str]) -> list:
    """The model's results for one batch, one for each text."""
    results = list(model(texts))
    if len(results) != len(texts):
        raise ValueError(f"{len(results)} results for {len(texts)} texts")
    return results


class SentenceBuffer:
    """Sentences of documents that wait for a full batch, and documents that wait for their sentences.

    A batch holds sentences of as many documents as it takes.  Where the model
    fails on it, each document's sentences are tried by themselves, so that a
    document fails by its own sentences alone.
    """

    def __init__(self, model, batch: int):
        self.model, self.batch = model, batch
        self.waiting: list[tuple[dict, int, str]] = []  # (document, number, sentence)
        self.documents: list[dict] = []

    def add(self, head, sentences: list[str]) -> None:
        document = {"head": head, "found": [], "open": len(sentences), "error": None}
        self.documents.append(document)
        for number, sentence in enumerate(sentences):
            self.waiting.append((document, number, sentence))
            if len(self.waiting) == self.batch:
                self.flush()

    def flush(self) -> None:
        some, self.waiting = self.waiting, []
        if not some:
            return
        try:
            self._take(some)
        except Exception:
            for document in {id(d): d for d, _, _ in some}.values():
                own = [x for x in some if x[0] is document]
                try:
                    self._take(own)
                except Exception as failure:  # one bad document must not end the job
                    document["error"] = document["error"] or f"{type(failure).__name__}: {failure}"
        for document, _, _ in some:
            document["open"] -= 1

    def _take(self, some: list[tuple[dict, int, str]]) -> None:
        results = [
            [{"sent_id": number, "text": text, "start": start, "end": end, "type": kind} for text, start, end, kind in found]
            for (_, number, _), found in zip(some, _batched(self.model, [text for _, _, text in some]))
        ]
        for (document, _, _), found in zip(some, results):
            document["found"] += found

    def finished(self) -> Iterator[dict]:
        """Documents without open sentences, in order."""
        done = 0
        while done < len(self.documents) and not self.documents[done]["open"]:
            yield self.documents[done]
            done += 1
        del self.documents[:done]


def tag_sentences(
    df: DataFrame, open_model: Callable[[], Callable], *, sentences: str = "sentences", out: str = "found",
    batch: int = SENTENCE_BATCH, keep_sentences: bool = True,
) -> DataFrame:
    """Find entities with a model that reads lists of sentences, and tell how that went by ``status`` and ``error``.

    The model gives, for each sentence, its ``(text, start, end, type)``
    entities with offsets into the sentence.  Batches are filled across
    documents: a partition of n sentences makes ceil(n / batch) calls.  A
    document the model fails on has null in ``out``; a null array has no sentences.
    """
    kept = [f for f in df.schema.fields if keep_sentences or f.name != sentences]
    schema = T.StructType(kept + T.StructType.fromDDL(f"{out} {FOUND_TYPE}, status string, error string").fields)
    names, arrow = [f.name for f in kept], to_arrow_schema(schema)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        buffer = SentenceBuffer(open_model(), batch)

        def rows() -> list[dict]:
            return [
                {**d["head"], out: None if d["error"] else d["found"], "status": "error" if d["error"] else "ok", "error": d["error"]}
                for d in buffer.finished()
            ]

        for part in batches:
            for head, texts in zip(part.select(names).to_pylist(), part.column(sentences).to_pylist()):
                buffer.add(head, texts or [])
            if done := rows():
                yield pa.RecordBatch.from_pylist(done, arrow)
        buffer.flush()
        if done := rows():
            yield pa.RecordBatch.from_pylist(done, arrow)

    return df.mapInArrow(run, schema)


def tag_chunks(
    df: DataFrame, open_model: Callable[[], Callable], *, chunks: str = "chunks", out: str = "tagged"
) -> DataFrame:
    """Tokens with entity labels by a model that reads one chunk text at a time.

    The model gives ``(token, label)`` pairs; a document's chunks are joined.
    """

    def pairs(model, texts: list[str]) -> list[dict]:
        return [{"token": t, "label": k} for text in texts for t, k in model(text)]

    return _annotate(df, open_model, chunks, pairs, out, "array<struct<token:string,label:string>>")

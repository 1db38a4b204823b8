"""Negation cues and assertion of entities, inside one document row.

The scope rules follow the published NegEx algorithm (Chapman et al., Journal
of Biomedical Informatics 34, 2001).  A document's tokens, cues and entities
stay in its row; each entity is compared with its nearest cues only, which is
enough: if any cue of a kind reaches it, the nearest one does.
"""

from __future__ import annotations

from collections import defaultdict

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from marginalia.functions import text as tx
from marginalia.functions.sequence import MARK, counts_up_to, let, positions, running_total, segments
from marginalia.operators.lookup import BROADCAST_BYTES, lookup
from marginalia.operators.phrases import found_phrases, phrase_table
from marginalia.operators.text import explode_rows

NEGATED = "negated"
AFFIRMED = "affirmed"
REACH = 5  # tokens between a cue and the entity it can reach
KINDS = ("pre", "post", "pseudo", "term")

# Pairs (cue, kind), which become part of the plan, or a table of those two columns, which is joined.
Cues = list[tuple[str, str]] | DataFrame
LISTED = 1000  # cues that become part of the plan at most; a longer list is made a table


def scope_tokens(text: Column) -> Column:
    """``array<struct<word, start, end, stop, sent_id>>`` in document order.

    ``word`` is the token in lower case.  No cue runs on past a token with
    ``stop``: a line end, a sentence end or a non-ASCII character follows it.
    """
    low = 1 << 32  # a piece's characters, and above them the sentences that end in it

    def measure(p: Column) -> Column:
        """Marks are no characters of the text."""
        size = F.length(p).cast("long")
        marks = size - F.length(F.replace(p, F.lit(MARK), F.lit("")))
        return F.when(p.contains(MARK), size + marks * (low - 1)).otherwise(size)

    def described(p: Column, word: Column, at: Column) -> Column:
        own = F.substring_index(p, MARK, 1)  # what follows a mark is of another sentence
        ends = (p.contains("\n") | p.contains(tx.FOREIGN)) & (own.contains("\n") | own.contains(tx.FOREIGN))
        start = at.bitwiseAND(low - 1).cast("int")
        return F.struct(
            F.lower(word).alias("word"),
            start.alias("start"),
            (start + F.length(word)).alias("end"),
            ends.alias("stop"),
            F.shiftright(at, 32).cast("int").alias("sent_id"),
        )

    def tokens(ps: Column, words: Column, at: Column) -> Column:
        every = F.transform(ps, lambda p, i: described(p, F.get(words, i), F.get(at, i)))
        # Separators at the text's begin are a piece without a token.
        return F.when(F.get(words, F.lit(0)) == "", F.slice(every, F.lit(2), F.size(ps))).otherwise(every)

    return let(
        tx.marked_scope_text(text),
        lambda m: let(F.split(m, tx.PIECE_CUT, -1), lambda ps: let(tx.piece_words(m), lambda words: let(
            running_total(F.transform(ps, measure), "long"),
            lambda at: tokens(ps, words, at),
        ))),
    )


def _by_words(cues: list[tuple[str, str]]) -> dict[int, dict[str, str]]:
    """Cues by number of words: normalised phrase to kind."""
    table: dict[int, dict[str, str]] = defaultdict(dict)
    for cue, kind in cues:
        if kind not in KINDS:
            raise ValueError(f"unknown cue kind {kind!r}")
        words = cue.lower().split()
        if words:
            table[len(words)][" ".join(words)] = kind
    return table


def _as_table(spark: SparkSession, cues: Cues) -> DataFrame | None:
    """The cues as phrases, if they are a table or too many for the plan."""
    if not isinstance(cues, DataFrame):
        if len(cues) <= LISTED:
            return None
        cues = spark.createDataFrame(list({" ".join(c.lower().split()): (c, k) for c, k in cues}.values()), "cue string, kind string")
    known = F.when(F.col("kind").isin(*KINDS), F.col("kind"))
    checked = F.coalesce(known, F.raise_error(F.concat(F.lit("unknown cue kind "), F.col("kind"))).cast("string"))
    return phrase_table(cues.select("cue", checked.alias("kind")), "cue", "kind")


def _longest(phrases: DataFrame) -> int:
    return phrases.agg(F.max("words")).first()[0] or 1


def _table_cues(texts: DataFrame, phrases: DataFrame, longest: int, by: list[str], text: str, broadcast_bytes: int) -> DataFrame:
    """``(by..., found)`` of texts that hold cues: ``array<struct<i, n, phrase, value, ends>>`` by scope tokens."""

    def begins(tk: Column) -> Column:
        """The tokens no cue runs on to: a sentence's first ones, and those behind a ``stop``."""

        def fresh(t: Column, before: Column) -> Column:
            return before["stop"] | (before["sent_id"] != t["sent_id"])

        return positions(tk, lambda t, i: (i == 0) | fresh(t, F.get(tk, i - 1)))

    def ahead(words: Column, ends: Column, t: Column, i: Column, last: Column) -> Column:
        """The token and those behind it up to ``last``, as far as any cue goes, as text and as their ends."""
        n = F.least(last - i + 1, F.lit(longest))
        return F.struct(
            i.alias("i"), t["word"].alias("opener"), F.array_join(F.slice(words, i + 1, n), " ").alias("ahead"),
            F.slice(ends, i + 1, n).alias("ends"), t["start"].alias("start"), t["sent_id"].alias("sent_id"),
        )

    def windows(tk: Column, words: Column, ends: Column) -> Column:
        return F.flatten(F.transform(
            segments(begins(tk), F.size(tk)),
            lambda s: F.transform(
                F.slice(tk, s["first"] + 1, s["last"] - s["first"] + 1),
                lambda t, k: ahead(words, ends, t, s["first"] + k, s["last"]),
            ),
        ))

    rows = let(scope_tokens(F.col(text)), lambda tk: let(
        F.transform(tk, lambda t: t["word"]), lambda words: let(
            F.transform(tk, lambda t: t["end"]), lambda ends: windows(tk, words, ends)
        )
    ))
    words = explode_rows(texts, rows, *by, pos="_nth", item="_item").select(*by, "_item.*")
    return found_phrases(words, phrases, by=by, longest=longest, keep=("start", "sent_id"), broadcast_bytes=broadcast_bytes)


def _dense(found: Column, size: Column) -> Column:
    """Marks along the tokens, as ``cue_marks`` gives them, out of the cues in order."""
    none = F.lit(None).cast("struct<n:int,kind:string,cue:string>")

    def stretch(f: Column, k: Column) -> Column:
        before = F.coalesce(F.get(found, k - 1)["i"] + 1, F.lit(0))
        mark = F.struct(f["n"].alias("n"), f["value"].alias("kind"), f["phrase"].alias("cue"))
        return F.concat(F.array_repeat(none, f["i"] - before), F.array(mark))

    last = F.coalesce(F.get(found, F.size(found) - 1)["i"] + 1, F.lit(0))
    return F.concat(F.flatten(F.transform(found, stretch)), F.array_repeat(none, size - last))


def cue_marks(tokens: Column, cues: Cues) -> Column:
    """``array<struct<n, kind, cue>>`` along the scope tokens: the cue of ``n`` words that begins at each, or null.

    At each token the longest cue counts; a cue inside a longer one is dropped.
    """
    table = _by_words(cues)
    if not table:
        return F.transform(tokens, lambda t: F.lit(None).cast("struct<n:int,kind:string,cue:string>"))
    openers = sorted({phrase.split()[0] for phrases in table.values() for phrase in phrases})
    lengths = sorted(table, reverse=True)

    def kind_of(phrase: Column) -> Column:
        """One hashed set per kind, so the time of a lookup does not grow with the list."""
        chain = F.lit(None).cast("string")
        for kind in KINDS:
            of_kind = sorted(p for phrases in table.values() for p, k in phrases.items() if k == kind)
            if of_kind:
                chain = F.when(phrase.isin(of_kind), F.lit(kind)).otherwise(chain)
        return chain

    def match(tk: Column, t: Column, i: Column) -> Column:
        """Words of the longest cue that starts at token ``i``."""

        def fits(n: int) -> Column:
            if n == 1:
                return t["word"].isin(sorted(table[1]))
            whole = F.get(tk, i + n - 1)["sent_id"] == t["sent_id"]
            for step in range(n - 1):
                whole = whole & ~F.get(tk, i + step)["stop"]
            words = F.transform(F.slice(tk, i + 1, F.lit(n)), lambda x: x["word"])
            return whole & F.array_join(words, " ").isin(sorted(table[n]))

        chain = F.when(~t["word"].isin(openers), F.lit(None).cast("int"))
        for n in lengths:
            chain = chain.when(fits(n), F.lit(n))
        return chain

    def mark(tk: Column, i: Column, n: Column) -> Column:
        phrase = F.array_join(F.transform(F.slice(tk, i + 1, n), lambda x: x["word"]), " ")
        return let(phrase, lambda p: F.struct(n.alias("n"), kind_of(p).alias("kind"), p.alias("cue")))

    return let(
        F.transform(tokens, lambda t, i: match(tokens, t, i)),
        lambda ns: F.transform(
            ns, lambda n, i: F.when(n.isNotNull() & ~_covered(ns, i, n, max(lengths)), mark(tokens, i, n))
        ),
    )


def _covered(ns: Column, i: Column, n: Column, reach: int) -> Column:
    """A cue that starts up to ``reach - 1`` tokens earlier ends no earlier."""
    hit = F.lit(False)
    for back in range(1, reach):
        hit = hit | F.coalesce(F.when(i >= back, F.get(ns, i - back)) - back >= n, F.lit(False))
    return hit


def find_cues(tokens: Column, cues: Cues) -> Column:
    """``array<struct<first, last, kind, cue, sent_id, start, end>>`` for scope tokens, by ``cue_marks``."""

    def placed(m: Column, i: Column) -> Column:
        first, last = F.get(tokens, i), F.get(tokens, i + m["n"] - 1)
        return F.struct(
            i.alias("first"), (i + m["n"] - 1).alias("last"), m["kind"].alias("kind"), m["cue"].alias("cue"),
            first["sent_id"].alias("sent_id"), first["start"].alias("start"), last["end"].alias("end"),
        )

    return let(
        cue_marks(tokens, cues),
        lambda marks: F.array_compact(F.transform(marks, lambda m, i: F.when(m.isNotNull(), placed(m, i)))),
    )


def _placed(es: Column, tokens: Column) -> Column:
    """First token, last token and sentence of each entity."""
    starts = F.transform(tokens, lambda t: t["start"])
    ends = F.transform(tokens, lambda t: t["end"])
    return let(
        counts_up_to(F.transform(es, lambda e: e["start"]), ends),
        lambda firsts: let(
            counts_up_to(F.transform(es, lambda e: e["end"] - 1), starts),
            lambda lasts: F.transform(
                firsts,
                lambda first, i: F.struct(
                    first.alias("first"),
                    F.greatest(F.get(lasts, i) - 1, first).alias("last"),
                    F.get(tokens, first)["sent_id"].alias("sent_id"),
                ),
            ),
        ),
    )


def _negated(p: Column, tokens: Column, marks: Column, longest: int, reach: int) -> Column:
    """Whether a cue reaches the entity: only the tokens within reach on either side are looked at."""

    def at(i: Column) -> Column:
        return F.get(marks, i)

    def places(first: Column, last: Column) -> Column:
        return F.when(first <= last, F.sequence(first, last)).otherwise(F.array().cast("array<int>"))

    def stopped(first: Column, last: Column) -> Column:
        """A ``term`` cue lies wholly from ``first`` to ``last``."""
        return F.exists(places(first, last), lambda j: F.coalesce((at(j)["kind"] == "term") & (j + at(j)["n"] - 1 <= last), F.lit(False)))

    def before(s: Column) -> Column:
        end = s + at(s)["n"]  # the token behind the cue
        near = (at(s)["kind"] == "pre") & (end <= p["first"]) & (p["first"] - end <= reach)
        return F.coalesce(near & (F.get(tokens, s)["sent_id"] == p["sent_id"]), F.lit(False)) & ~stopped(end, p["first"] - 1)

    def after(s: Column) -> Column:
        near = (at(s)["kind"] == "post") & (F.get(tokens, s)["sent_id"] == p["sent_id"])
        return F.coalesce(near, F.lit(False)) & ~stopped(p["last"] + 1, s - 1)

    return F.exists(places(F.greatest(p["first"] - reach - longest, F.lit(0)), p["first"] - 1), before) | F.exists(
        places(p["last"] + 1, F.least(p["last"] + 1 + reach, F.size(marks) - 1)), after
    )


def cue_spans(
    df: DataFrame, cues: Cues, *, doc: str = "doc_id", text: str = "text", broadcast_bytes: int = BROADCAST_BYTES
) -> DataFrame:
    """``(doc, sent_id, start, end, cue, kind)`` of every cue in every document."""
    phrases = _as_table(df.sparkSession, cues)
    if phrases is None:
        scoped = df.select(doc, scope_tokens(F.col(text)).alias("_tokens"))
        found = scoped.select(doc, let(F.col("_tokens"), lambda tk: find_cues(tk, cues)).alias("_cues"))
        rows = explode_rows(found, F.col("_cues"), doc)
        return rows.select(doc, *[F.col(f"item.{c}").alias(c) for c in ("sent_id", "start", "end", "cue", "kind")])
    numbered = df.select(doc, text, F.monotonically_increasing_id().alias("_row"))
    found = _table_cues(numbered, phrases, _longest(phrases), [doc, "_row"], text, broadcast_bytes)
    found = found.select(doc, F.explode("found").alias("x"))
    return found.select(
        doc, "x.sent_id", "x.start", "x.end", F.col("x.phrase").alias("cue"), F.col("x.value").alias("kind")
    )


def assert_entities(
    df: DataFrame, cues: Cues, *, text: str = "text", entities: str = "entities", reach: int = REACH,
    broadcast_bytes: int = BROADCAST_BYTES,
) -> DataFrame:
    """Add ``assertion`` to the entity array of every document row.

    Entities carry character offsets into the length-kept text.  An entity is
    negated when, in its sentence, a ``pre`` cue ends at most ``reach`` tokens
    before it with no ``term`` cue between, or a ``post`` cue starts at most
    ``reach`` tokens after it likewise.  ``pseudo`` cues negate nothing and,
    being longer, displace the cue inside them.

    Listed cues are found in the document's row.  The cues of a table are found
    once for each text and looked up by the text's digest, so that texts stay where they are.
    """
    phrases = _as_table(df.sparkSession, cues)
    if phrases is not None:
        texts = df.select(F.md5(F.col(text).cast("binary")).alias("_digest"), F.col(text).alias("_text"))
        longest = _longest(phrases)
        found = _table_cues(texts, phrases, longest, ["_digest"], "_text", broadcast_bytes)
        found = found.withColumn("found", F.transform("found", lambda f: f.dropFields("end", "start", "sent_id")))
        size = found.agg(F.sum(64 + 48 * F.size("found"))).first()[0] or 0
        joined = lookup(
            df, found, F.md5(F.col(text).cast("binary")), word="_digest", salt_by=[text], broadcast_bytes=broadcast_bytes, measured=size
        )
        cues_of = F.coalesce("found", F.array().cast(dict(found.dtypes)["found"]))
        return _asserted(joined, lambda tk: let(cues_of, lambda f: _dense(f, F.size(tk))), longest, text, entities, reach).drop("found")
    longest = max(_by_words(cues), default=1)
    return _asserted(df, lambda tk: cue_marks(tk, cues), longest, text, entities, reach)


def _asserted(df: DataFrame, marks_of, longest: int, text: str, entities: str, reach: int) -> DataFrame:
    shown = F.coalesce(F.col(entities), F.array().cast(dict(df.dtypes)[entities]))

    def asserted(es: Column) -> Column:
        return let(
            scope_tokens(F.col(text)),
            lambda tk: let(marks_of(tk), lambda marks: let(
                F.when(F.exists(marks, lambda m: m["kind"].isin("pre", "post")), _placed(es, tk)),
                lambda places: F.transform(es, lambda e, i: let(F.get(places, i), lambda p: e.withField(
                    "assertion", F.when(p.isNotNull() & _negated(p, tk, marks, longest, reach), F.lit(NEGATED)).otherwise(F.lit(AFFIRMED))
                ))),
            )),
        )

    # A text without entities is not taken apart.
    none = F.transform(shown, lambda e: e.withField("assertion", F.lit(AFFIRMED)))
    result = let(shown, lambda es: F.when(F.size(es) > 0, asserted(es)).otherwise(none))
    return df.select(*[
        F.when(F.col(c).isNotNull(), result).alias(c) if c == entities else F.col(c) for c in df.columns
    ])

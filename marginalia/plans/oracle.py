"""The catalogue's queries restated as plain SQL for an independent engine.

Sequences are unnested to rows and solved with window functions and joins here,
where the library works on arrays inside a document row.
"""

from __future__ import annotations

SEP = r"[\t-\r\x1c-\x20\x{85}\x{A0}\x{1680}\x{2000}-\x{200A}\x{2028}\x{2029}\x{202F}\x{205F}\x{3000};.,:]"
NSEP = r"[^\t-\r\x1c-\x20\x{85}\x{A0}\x{1680}\x{2000}-\x{200A}\x{2028}\x{2029}\x{202F}\x{205F}\x{3000};.,:]"
BLANKS = r"[ \t\n\v\f\r]"
CUT = "chr(1)"

CUE_VALUES = """
('is', 'pre'), ('by', 'pre'), ('le', 'pre'), ('der', 'pre'), ('que el', 'pre'),
('was', 'post'), ('des', 'post'), ('la', 'post'),
('and', 'term'), ('und', 'term'), ('et', 'term'), ('y', 'term'),
('is the', 'pseudo'), ('by the', 'pseudo'), ('of the', 'pseudo'), ('that is it', 'pseudo')
"""


def drop(c: str) -> str:
    return rf"regexp_replace({c}, '[^\x00-\x7F]', '', 'g')"


def blank(c: str) -> str:
    return rf"regexp_replace({c}, '[^\x00-\x7F]', ' ', 'g')"


def newline(c: str) -> str:
    return rf"regexp_replace({c}, '[^\x00-\x7F]', chr(10), 'g')"


def returns(c: str) -> str:
    return f"replace({c}, chr(13), chr(10))"


def model(c: str) -> str:
    return f"replace({blank(returns(c))}, chr(10), ' ')"


def cut_sentences(c: str) -> str:
    return rf"regexp_replace({c}, '([.?])({BLANKS}+[A-Z])', '\1' || {CUT} || '\2', 'g')"


def kind(t: str, number: str = "NUM") -> str:
    return rf"""CASE WHEN regexp_matches({t}, '^[0-9]+$') THEN '{number}'
      WHEN regexp_matches({t}, '[A-Z]') AND NOT regexp_matches({t}, '(^|[^A-Za-z])[a-z]|[A-Za-z][A-Z]')
      THEN 'NAME' END"""


def numbered(source: str, array: str, key: str, out: str, pos: str) -> str:
    """Rows of an array with their position from 0."""
    return f"""SELECT {key}, unnest({array}) AS {out}, unnest(range(len({array})))::INTEGER AS {pos}
      FROM {source}"""


TOK = f"""
tok_list AS (SELECT doc_id, list_filter(string_split_regex(text, '{SEP}+'), lambda x: x <> '') AS a FROM documents),
tok AS ({numbered('tok_list', 'a', 'doc_id', 'token', 'pos')}),
atok AS (SELECT doc_id, pos, token, {drop('token')} AS t FROM tok)"""

LINES = f"""
line_list AS (SELECT doc_id, string_split_regex(text, '{SEP}') AS a FROM documents),
line_cut AS (SELECT doc_id, CASE WHEN a[-1] = '' THEN a[:len(a) - 1] ELSE a END AS a FROM line_list),
lines AS ({numbered('line_cut', 'a', 'doc_id', 'line', 'pos')})"""

LINE_LABELS = f"""{LINES},
line_labels AS (SELECT doc_id, pos, coalesce({kind(drop('line'))}, 'O') AS label FROM lines)"""

LABELS = f"""{TOK},
kinds AS (SELECT doc_id, pos, t, {kind('t')} AS k FROM atok),
labelled AS (SELECT doc_id, pos, t AS token, CASE WHEN k IS NULL THEN 'O'
    WHEN k = lag(k) OVER (PARTITION BY doc_id ORDER BY pos) THEN 'I-' || k ELSE 'B-' || k END AS label FROM kinds)"""

GAZETTEER = f"""
words AS (SELECT DISTINCT unnest(list_filter(string_split_regex(text, '{SEP}+'), lambda x: x <> '')) AS word
    FROM benchmark),
ascii_words AS (SELECT DISTINCT {drop('word')} AS word FROM words),
gazetteer AS (SELECT word, CASE WHEN length(word) > 6 THEN 'LONG' ELSE 'SHORT' END AS type
    FROM ascii_words WHERE length(word) > 3)"""

LEXICON_LABELS = f"""{TOK}, {GAZETTEER},
kinds AS (SELECT doc_id, pos, t, g.type AS k FROM atok LEFT JOIN gazetteer g ON g.word = t),
labelled AS (SELECT doc_id, pos, t AS token, CASE WHEN k IS NULL THEN 'O'
    WHEN k = lag(k) OVER (PARTITION BY doc_id ORDER BY pos) THEN 'I-' || k ELSE 'B-' || k END AS label FROM kinds)"""

OFFSETS = """
offsets AS (SELECT *, coalesce(sum(length(token) + 1) OVER (PARTITION BY doc_id ORDER BY pos
    ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0)::BIGINT AS tok_start FROM labelled)"""

BIO = f"""{OFFSETS},
grouped AS (SELECT *, sum(CASE WHEN label LIKE 'I-%' OR label = 'I' THEN 0 ELSE 1 END)
    OVER (PARTITION BY doc_id ORDER BY pos) AS grp FROM offsets),
entities AS (SELECT doc_id, string_agg(token, ' ' ORDER BY pos) AS text, min(tok_start) AS start,
    max(tok_start + length(token)) AS "end", substr(arg_min(label, pos), 3) AS type
  FROM grouped WHERE grp > 0 GROUP BY doc_id, grp HAVING arg_min(label, pos) LIKE 'B-%')"""

ENTITY_COLUMNS = 'doc_id, text, start, "end", type'


def sentence_entities(source: str, doc: str, number: str = "NUM") -> str:
    """Sentences of ``source(doc, text)`` and the rule's entities in document offsets."""
    return f"""
sent_list AS (SELECT {doc}, string_split({cut_sentences(model('text'))}, {CUT}) AS a FROM {source}),
sent AS ({numbered('sent_list', 'a', doc, 'sentence', 'sent_id')}),
sent_at AS (SELECT *, coalesce(sum(length(sentence)) OVER (PARTITION BY {doc} ORDER BY sent_id
    ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0)::BIGINT AS base FROM sent),
piece_list AS (SELECT {doc}, sent_id, base, sentence,
    string_split(regexp_replace(sentence, '({SEP})({NSEP})', '\\1' || {CUT} || '\\2', 'g'), {CUT}) AS a FROM sent_at),
pieces AS (SELECT {doc}, sent_id, base, sentence, unnest(a) AS piece, unnest(range(len(a))) AS n FROM piece_list),
located AS (SELECT *, coalesce(sum(length(piece)) OVER (PARTITION BY {doc}, sent_id ORDER BY n
    ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0)::BIGINT AS local,
    regexp_replace(piece, '{SEP}+$', '') AS t FROM pieces),
typed AS (SELECT *, {kind('t', number)} AS k FROM located),
marked AS (SELECT *, CASE WHEN n > 0 AND k IS NOT DISTINCT FROM
    lag(k) OVER (PARTITION BY {doc}, sent_id ORDER BY n) THEN 0 ELSE 1 END AS new FROM typed),
runs AS (SELECT *, sum(new) OVER (PARTITION BY {doc}, sent_id ORDER BY n) AS run FROM marked),
spans AS (SELECT {doc}, sent_id, base, k AS type, min(local) AS s, max(local + length(t)) AS e, any_value(sentence) AS sentence
    FROM runs WHERE k IS NOT NULL GROUP BY {doc}, sent_id, base, run, k),
entities AS (SELECT {doc}, substr(sentence, s + 1, e - s) AS text, base + s AS start, base + e AS "end", type
    FROM spans)"""


SECTIONED = f"""{sentence_entities('documents', 'doc_id', 'SectionHeader')},
sectioned AS (SELECT *, CASE WHEN type <> 'SectionHeader' THEN last_value(
    CASE WHEN type = 'SectionHeader' THEN text END IGNORE NULLS) OVER (PARTITION BY doc_id ORDER BY start
    ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING) END AS section FROM entities)"""

SCOPES = f"""
scope_list AS (SELECT doc_id, string_split(replace({cut_sentences(blank(returns('text')))},
    chr(10), chr(10) || {CUT}), {CUT}) AS a FROM documents),
scope AS ({numbered('scope_list', 'a', 'doc_id', 'sentence', 'sent_id')}),
scope_at AS (SELECT *, coalesce(sum(length(sentence)) OVER (PARTITION BY doc_id ORDER BY sent_id
    ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0)::BIGINT AS start FROM scope)"""

# Tokens with character offsets on the cue form of the text, then cues by 1-3 word phrases.
CUE_MATCHES = f"""{SCOPES},
cue_docs AS (SELECT doc_id, {newline(returns('text'))} AS c FROM documents),
cpiece_list AS (SELECT doc_id,
    string_split(regexp_replace(c, '({SEP})({NSEP})', '\\1' || {CUT} || '\\2', 'g'), {CUT}) AS a FROM cue_docs),
cpieces AS ({numbered('cpiece_list', 'a', 'doc_id', 'piece', 'n')}),
clocated AS (SELECT *, coalesce(sum(length(piece)) OVER (PARTITION BY doc_id ORDER BY n
    ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0)::BIGINT AS start,
    regexp_replace(piece, '{SEP}+$', '') AS token,
    coalesce(sum(length(piece) - length(replace(piece, chr(10), ''))) OVER (PARTITION BY doc_id ORDER BY n
    ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS line FROM cpieces),
ctok AS (SELECT doc_id, start, start + length(token) AS "end", token, line,
    row_number() OVER (PARTITION BY doc_id ORDER BY n) - 1 AS pos FROM clocated WHERE token <> ''),
stok AS (SELECT c.*, s.sent_id FROM ctok c ASOF JOIN scope_at s ON c.doc_id = s.doc_id AND c.start >= s.start),
next_tok AS (SELECT *, lower(token) AS w1,
    CASE WHEN lead(line, 1) OVER w = line AND lead(sent_id, 1) OVER w = sent_id
      THEN lower(lead(token, 1) OVER w) END AS w2, lead("end", 1) OVER w AS end2,
    CASE WHEN lead(line, 2) OVER w = line AND lead(sent_id, 2) OVER w = sent_id
      THEN lower(lead(token, 2) OVER w) END AS w3, lead("end", 2) OVER w AS end3
  FROM stok WINDOW w AS (PARTITION BY doc_id ORDER BY pos)),
phrases AS (
  SELECT doc_id, sent_id, pos, 1 AS n, start, "end", w1 AS cue FROM next_tok
  UNION ALL SELECT doc_id, sent_id, pos, 2, start, end2, w1 || ' ' || w2 FROM next_tok
  UNION ALL SELECT doc_id, sent_id, pos, 3, start, end3, w1 || ' ' || w2 || ' ' || w3 FROM next_tok),
cue_table(cue, kind) AS (VALUES {CUE_VALUES}),
hits AS (SELECT p.*, p.pos + p.n - 1 AS last, kind FROM phrases p JOIN cue_table USING (cue)),
longest AS (SELECT *, row_number() OVER (PARTITION BY doc_id, pos ORDER BY n DESC) AS rn FROM hits),
cues AS (SELECT doc_id, sent_id, pos AS first, last, start, "end", cue, kind FROM (
    SELECT *, max(last) OVER (PARTITION BY doc_id ORDER BY pos ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING)
      AS seen FROM longest WHERE rn = 1) WHERE seen IS NULL OR seen < last)"""

# Long words of the benchmark, and pairs and triples of neighbouring ones, as a cue table.
BENCHMARK_CUES = f"""
blist AS (SELECT item_id, list_filter(string_split_regex(text, '{SEP}+'), lambda x: x <> '') AS a FROM benchmark),
brows AS ({numbered('blist', 'a', 'item_id', 'token', 'pos')}),
bwords AS (SELECT item_id, pos, lower(token) AS w FROM brows WHERE regexp_matches(token, '^[A-Za-z]+$')),
cue_table AS (SELECT w AS cue, 'pre' AS kind FROM bwords WHERE length(w) > 6
  UNION SELECT x.w || ' ' || y.w, 'post' FROM bwords x JOIN bwords y ON y.item_id = x.item_id AND y.pos = x.pos + 1
  UNION SELECT x.w || ' ' || y.w || ' ' || z.w, 'term' FROM bwords x JOIN bwords y ON y.item_id = x.item_id AND y.pos = x.pos + 1
    JOIN bwords z ON z.item_id = x.item_id AND z.pos = x.pos + 2)"""

ASSERTED = f"""{sentence_entities('documents', 'doc_id')}, {CUE_MATCHES},
placed AS (SELECT e.*, a.pos AS first, b.pos AS last, a.sent_id FROM entities e
    JOIN stok a ON a.doc_id = e.doc_id AND a.start = e.start
    JOIN stok b ON b.doc_id = e.doc_id AND b."end" = e."end"),
before_cue AS (SELECT DISTINCT p.doc_id, p.start FROM placed p JOIN cues c ON c.doc_id = p.doc_id
    AND c.sent_id = p.sent_id AND c.kind = 'pre' AND c.last < p.first AND p.first - c.last - 1 <= 5
    WHERE NOT EXISTS (SELECT 1 FROM cues t WHERE t.doc_id = p.doc_id AND t.kind = 'term'
      AND t.first > c.last AND t.last < p.first)),
after_cue AS (SELECT DISTINCT p.doc_id, p.start FROM placed p JOIN cues c ON c.doc_id = p.doc_id
    AND c.sent_id = p.sent_id AND c.kind = 'post' AND c.first > p.last AND c.first - p.last - 1 <= 5
    WHERE NOT EXISTS (SELECT 1 FROM cues t WHERE t.doc_id = p.doc_id AND t.kind = 'term'
      AND t.last < c.first AND t.first > p.last)),
negated AS (SELECT * FROM before_cue UNION SELECT * FROM after_cue)"""


def elements(markup: str, tag: str) -> str:
    """Contents of the elements: cut at opening tags, keep what is before the closing tag."""
    return (
        rf"list_transform(string_split_regex({markup}, '<(?:[\w.-]+:)?{tag}(?:\s[^>]*)?>')[2:], "
        rf"lambda p: string_split_regex(p, '</(?:[\w.-]+:)?{tag}\s*>')[1])"
    )


def without(markup: str, tag: str) -> str:
    return rf"regexp_replace({markup}, '(?s)<{tag}(?:\s[^>]*)?>.*?</{tag}\s*>', '', 'g')"


def unescaped(c: str) -> str:
    c = f"regexp_replace({c}, '<[^>]*>', '', 'g')"
    for ref, char in (("&lt;", "<"), ("&gt;", ">"), ("&quot;", '"'), ("&apos;", "''"), ("&amp;", "&")):
        c = f"replace({c}, '{ref}', '{char}')"
    return c


PAGES = f"""
page_list AS (SELECT page_id, {elements(without(without('html', 'script'), 'style'), 'article')} AS a FROM pages),
page AS ({numbered('page_list', 'a', 'page_id', 'body', 'page_no')}),
pline_list AS (SELECT page_id, page_no, {elements('body', 'p')} AS a FROM page),
pline AS (SELECT page_id, page_no, unnest(a) AS raw, unnest(range(len(a)))::INTEGER AS line_no FROM pline_list),
page_lines AS (SELECT page_id, page_no, line_no, {unescaped('raw')} AS line FROM pline)"""

PAGE_TEXT = f"""{PAGES},
parts AS (SELECT page_id, page_no, -1 AS line_no, chr(10) || '<EPI_PAGEBREAKER>' || chr(10) || chr(10) AS part FROM page
    UNION ALL SELECT page_id, page_no, line_no, line FROM page_lines),
page_text AS (SELECT page_id, string_agg(part, chr(10) ORDER BY page_no, line_no) AS text FROM parts GROUP BY page_id)"""

# The output order of the feature table.
FEATURE_ORDER = [
    "names", "AllPunctuations", "HasPunctuation", "Digit", "ExistinDict", "Lemma", "Stem",
    "Lowercase", "Title", "Uppercase", "Vowel_count", "digit_in_words", "last_2", "last_3",
    "length", "percentageDigit", "percentagePunc", "percentageUpper", "percentagelower",
]
ALL_FEATURES = {
    "AllPunctuations": "regexp_matches(t, '^[[:punct:]]*$')",
    "HasPunctuation": "regexp_matches(t, '[[:punct:]]')",
    "Digit": "regexp_matches(t, '^[0-9]+$')",
    "Lowercase": "lower(t)",
    "Title": "regexp_matches(t, '[A-Z]') AND NOT regexp_matches(t, '(^|[^A-Za-z])[a-z]|[A-Za-z][A-Z]')",
    "Uppercase": "upper(t)",
    "Vowel_count": "length(regexp_replace(lower(t), '[^aeiou]', '', 'g'))",
    "digit_in_words": "regexp_matches(t, '[0-9]')",
    "last_2": "right(t, 2)",
    "last_3": "right(t, 3)",
    "length": "length(t)",
}
for _name, _class in (
    ("percentageDigit", "0-9"), ("percentagePunc", "[:punct:]"), ("percentageUpper", "A-Z"), ("percentagelower", "a-z"),
):
    ALL_FEATURES[_name] = (
        f"CASE WHEN t = '' THEN 0.0::DOUBLE ELSE "
        f"length(regexp_replace(t, '[^{_class}]', '', 'g'))::DOUBLE / length(t) END"
    )


def features(*names: str) -> str:
    columns = ", ".join(f'{ALL_FEATURES[n]} AS "{n}"' for n in names)
    return f"WITH {TOK} SELECT doc_id, pos, t AS names, {columns} FROM atok"


FORMS = f"""{TOK}, words AS (SELECT DISTINCT
    unnest(list_filter(string_split_regex(text, '{SEP}+'), lambda x: x <> '')) AS word FROM benchmark),
lemmas AS (SELECT word, regexp_replace(word, 's$', '') AS lemma FROM words WHERE word LIKE '%s'),
stems AS (SELECT word, regexp_replace(lower(word), '(ing|ed|es|s)$', '') AS stem FROM words)"""

LINE_CHUNKS = rf"""WITH RECURSIVE
raw AS (SELECT doc_id, string_split(text, chr(10)) AS a FROM documents),
cut AS (SELECT doc_id, CASE WHEN a[-1] = '' THEN a[:len(a) - 1] ELSE a END AS a FROM raw),
doc_lines AS (SELECT doc_id, unnest(a) AS l, unnest(range(len(a)))::INTEGER AS pos FROM cut),
clean AS (SELECT doc_id, pos, regexp_replace({drop('l')}, '^[\t-\r\x1c-\x20]+|[\t-\r\x1c-\x20]+$', '', 'g') AS l
    FROM doc_lines),
walk AS (
  SELECT doc_id, pos, l, 0 AS chunk, 1 AS size FROM clean WHERE pos = 0
  UNION ALL
  SELECT c.doc_id, c.pos, c.l,
    CASE WHEN w.size = 50 OR (w.l LIKE '%.%' AND w.size > 10) THEN w.chunk + 1 ELSE w.chunk END,
    CASE WHEN w.size = 50 OR (w.l LIKE '%.%' AND w.size > 10) THEN 1 ELSE w.size + 1 END
  FROM walk w JOIN clean c ON c.doc_id = w.doc_id AND c.pos = w.pos + 1)
SELECT doc_id, chunk, string_agg(l, ' ' ORDER BY pos) AS chunk_text FROM walk GROUP BY doc_id, chunk"""


def run_sql(key: str, label: str, order: str, first: str, last: str, table: str) -> str:
    return f"""WITH marked AS (SELECT *, CASE WHEN {label} = lag({label}) OVER w THEN 0 ELSE 1 END AS new
    FROM {table} WINDOW w AS (PARTITION BY {key} ORDER BY {order})),
  grouped AS (SELECT *, sum(new) OVER (PARTITION BY {key} ORDER BY {order}) AS run FROM marked)
  SELECT {key}, {label}, {first}, {last}, count(*) AS rows FROM grouped GROUP BY {key}, run, {label}"""


def carried(key: str, order: str, header: str, text: str, columns: str, table: str) -> str:
    return f"""SELECT {columns}, CASE WHEN NOT ({header}) THEN last_value(CASE WHEN {header} THEN {text} END IGNORE NULLS)
    OVER (PARTITION BY {key} ORDER BY {order} ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING) END AS section
    FROM {table}"""


def bool_word(expression: str) -> str:
    return f"CASE WHEN {expression} THEN 'True' ELSE 'False' END"


def oracle_sql() -> dict[str, str]:
    f = ALL_FEATURES
    whole = list(f)
    feature_row = {
        "names": "t", "ExistinDict": "w.word IS NOT NULL", "Lemma": "coalesce(l.lemma, t)", "Stem": "coalesce(s.stem, t)",
        **f,
    }
    # Flags as words, shares as the shortest decimal numbers that are they, the rest as it is.
    flags = {"AllPunctuations", "HasPunctuation", "Digit", "ExistinDict", "Title", "digit_in_words"}
    line = ", ".join(
        bool_word(feature_row[n]) if n in flags else f"({feature_row[n]})::VARCHAR" for n in FEATURE_ORDER
    )
    joined = "FROM atok LEFT JOIN words w ON w.word = token LEFT JOIN lemmas l ON l.word = t LEFT JOIN stems s ON s.word = t"
    return {
        "ascii_drop": f"SELECT doc_id, {drop('text')} AS text FROM documents",
        "ascii_blank": f"SELECT doc_id, {blank('text')} AS text FROM documents",
        "ascii_newline": f"SELECT doc_id, {newline('text')} AS text FROM documents",
        "newline_norm": f"SELECT doc_id, replace({returns('text')}, chr(10), ' ') AS text FROM documents",
        "tokenize": f"WITH {TOK} SELECT doc_id, pos, token FROM tok",
        "tokenize_keep_empty": f"WITH {LINES} SELECT doc_id, pos, line FROM lines",
        "word_count": f"""WITH {LINES} SELECT d.doc_id, count(pos) AS lines,
            count(*) FILTER (WHERE line <> '') AS words
            FROM documents d LEFT JOIN lines USING (doc_id) GROUP BY d.doc_id""",
        "chunks": f"""WITH {LINES} SELECT doc_id, pos // 50 AS chunk,
            string_agg({drop('line')}, ' ' ORDER BY pos) AS chunk_text FROM lines GROUP BY doc_id, pos // 50""",
        "line_chunks": LINE_CHUNKS,
        "sentences": f"""WITH {sentence_entities('documents', 'doc_id')} SELECT doc_id, sent_id, base AS start,
            base + length(sentence) AS "end", sentence FROM sent_at""",
        "line_sentences": f"""WITH {SCOPES} SELECT doc_id, sent_id, start,
            start + length(sentence) AS "end", sentence FROM scope_at""",
        "token_features": features(*whole),
        "suffixes": features("last_2", "last_3", "length"),
        "case_flags": features("Lowercase", "Uppercase", "Title"),
        "punct_flags": features("Digit", "digit_in_words", "HasPunctuation", "AllPunctuations"),
        "char_shares": features("percentageDigit", "percentagePunc", "percentageUpper", "percentagelower"),
        "vowel_count": features("Vowel_count"),
        "feature_lines": f"WITH {FORMS} SELECT doc_id, pos, concat_ws(' ', {line}) AS line {joined}",
        "in_lexicon": f"""WITH {FORMS} SELECT doc_id, pos, token, word IS NOT NULL AS "ExistinDict"
            FROM tok LEFT JOIN words ON word = token""",
        "lemma_lookup": f"""WITH {FORMS} SELECT doc_id, pos, token, coalesce(lemma, t) AS "Lemma"
            FROM atok LEFT JOIN lemmas ON word = t""",
        "stem_vocab": f"""WITH {FORMS} SELECT doc_id, pos, token, coalesce(stem, t) AS "Stem"
            FROM atok LEFT JOIN stems ON word = t""",
        "stem_function": f"""WITH {TOK} SELECT doc_id, pos, token,
            regexp_replace(lower(t), '(ing|ed|es|s)$', '') AS "Stem" FROM atok""",
        "feature_table": f"""WITH {FORMS} SELECT doc_id, pos, {', '.join(f'{e} AS "{n}"' for n, e in feature_row.items())}
            {joined}""",
        "rule_labels": f"WITH {LABELS} SELECT doc_id, pos, token, label FROM labelled",
        "lexicon_labels": f"WITH {LEXICON_LABELS} SELECT doc_id, pos, token, label FROM labelled",
        "label_align": f"""WITH {TOK}, {LINE_LABELS} SELECT t.doc_id, t.pos, t.token, l.label FROM tok t
            JOIN line_labels l ON l.doc_id = t.doc_id AND l.pos = t.pos""",
        "align_diagnostics": f"""WITH {TOK}, {LINES},
            a AS (SELECT doc_id, count(*) AS n FROM tok GROUP BY doc_id),
            b AS (SELECT doc_id, count(*) AS n FROM lines GROUP BY doc_id),
            c AS (SELECT coalesce(a.doc_id, b.doc_id) AS doc_id, coalesce(a.n, 0) AS tokens, coalesce(b.n, 0) AS labels
              FROM a FULL JOIN b ON a.doc_id = b.doc_id)
            SELECT *, least(tokens, labels) AS aligned, tokens <> labels AS mismatch FROM c""",
        "token_offsets": f"""WITH {LABELS}, {OFFSETS} SELECT doc_id, pos, token, tok_start,
            tok_start + length(token) AS tok_end FROM offsets""",
        "token_offset_rows": f"""WITH {LABELS}, {OFFSETS} SELECT doc_id, pos, token, tok_start,
            tok_start + length(token) AS tok_end FROM offsets""",
        "bio_entities": f"WITH {LABELS}, {BIO} SELECT {ENTITY_COLUMNS} FROM entities",
        "user_sequence_tagger": f"WITH {LABELS}, {BIO} SELECT {ENTITY_COLUMNS} FROM entities",
        "feature_tagger": f"""WITH {FORMS},
            valued AS (SELECT doc_id, pos, t, w.word IS NOT NULL AS known, coalesce(l.lemma, t) AS lemma,
              coalesce(s.stem, t) AS stem {joined}),
            kinds AS (SELECT doc_id, pos, t, CASE WHEN {f['Digit']} THEN 'NUM' WHEN known AND {f['Title']} THEN 'KNOWN'
              WHEN stem <> t AND {f['percentagelower']} = 1.0 THEN CASE WHEN lemma = t THEN 'FORM' ELSE 'PLURAL' END END AS k
              FROM valued),
            labelled AS (SELECT doc_id, pos, t AS token, CASE WHEN k IS NULL THEN 'O'
              WHEN k = lag(k) OVER (PARTITION BY doc_id ORDER BY pos) THEN 'I-' || k ELSE 'B-' || k END AS label FROM kinds),
            {BIO} SELECT {ENTITY_COLUMNS} FROM entities""",
        "bio_entity_rows": f"WITH {LEXICON_LABELS}, {BIO} SELECT {ENTITY_COLUMNS} FROM entities",
        "entity_arrays": f"""WITH {LABELS}, {BIO}, arrays AS (SELECT doc_id, count(*) AS n,
            to_json(list({{'text': text, 'start': start, 'end': "end", 'type': type}} ORDER BY start))::VARCHAR AS records
            FROM entities GROUP BY doc_id)
            SELECT d.doc_id, coalesce(n, 0)::INTEGER AS n, coalesce(records, '[]') AS records
            FROM documents d LEFT JOIN arrays USING (doc_id)""",
        "entity_counts": f"""WITH {LABELS}, {BIO} SELECT d.lang, e.type, count(*) AS entities,
            sum(e."end" - e.start)::BIGINT AS chars FROM entities e JOIN documents d USING (doc_id) GROUP BY d.lang, e.type""",
        "run_entities": f"""WITH {LINES},
            ruled AS (SELECT doc_id, pos, {drop('line')} AS raw, coalesce({kind(drop('line'))}, 'O') AS raw_label FROM lines),
            blanked AS (SELECT doc_id, pos, CASE WHEN raw IN (' ', '  ', '-') THEN '' ELSE raw END AS token,
              CASE WHEN raw IN (' ', '  ', '-') OR trim(raw_label) = '' THEN 'O' ELSE raw_label END AS label FROM ruled),
            labelled AS (SELECT * FROM blanked), {OFFSETS},
            marked AS (SELECT *, CASE WHEN label = lag(label) OVER (PARTITION BY doc_id ORDER BY pos) THEN 0 ELSE 1 END AS new
              FROM offsets),
            grouped AS (SELECT *, sum(new) OVER (PARTITION BY doc_id ORDER BY pos) AS run FROM marked)
            SELECT doc_id, string_agg(token, ' ' ORDER BY pos) AS text, min(tok_start) AS start,
              max(tok_start + length(token)) AS "end", label AS type
            FROM grouped WHERE label <> 'O' GROUP BY doc_id, run, label""",
        "blank_rule": f"""WITH {LINE_LABELS} SELECT l.doc_id, l.pos,
            CASE WHEN {drop('line')} IN (' ', '  ', '-') THEN '' ELSE {drop('line')} END AS token,
            CASE WHEN {drop('line')} IN (' ', '  ', '-') OR trim(label) = '' THEN 'O' ELSE label END AS label
            FROM lines l JOIN line_labels k ON k.doc_id = l.doc_id AND k.pos = l.pos""",
        "role_runs": run_sql(
            "conv_id", "role", "turn", "min(turn) AS first_turn", "max(turn) AS last_turn", "conversations"
        ),
        "event_runs": run_sql(
            "user_id", "event_type", "ts, event_id", "arg_min(event_id, (ts, event_id)) AS first_event",
            "arg_max(event_id, (ts, event_id)) AS last_event", "events",
        ),
        "turn_sections": carried("conv_id", "turn", "role = 'system'", "text", "conv_id, turn, role", "conversations"),
        "event_sections": carried(
            "user_id", "ts, event_id", "event_type = 'error'", "event_id::VARCHAR", "user_id, event_id, event_type", "events"
        ),
        "sentence_offsets": f"WITH {sentence_entities('documents', 'doc_id')} SELECT {ENTITY_COLUMNS} FROM entities",
        "section_carry": f"WITH {SECTIONED} SELECT {ENTITY_COLUMNS}, section FROM sectioned",
        "entity_trim": rf"""WITH l AS (SELECT doc_id,
              string_split(replace({blank(returns('text'))}, chr(10), chr(10) || {CUT}), {CUT}) AS a FROM documents),
            raw AS ({numbered('l', 'a', 'doc_id', 'piece', 'n')}),
            placed AS (SELECT *, coalesce(sum(length(piece)) OVER (PARTITION BY doc_id ORDER BY n
              ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0)::BIGINT AS start FROM raw),
            t AS (SELECT doc_id, regexp_replace(piece, '^[\t-\r\x1c-\x20]+|[\t-\r\x1c-\x20]+$', '', 'g') AS text,
              start, start + length(piece) AS "end", 'LINE' AS type FROM placed)
            SELECT {ENTITY_COLUMNS} FROM t WHERE text <> ''""",
        "entity_records": f"""WITH {SECTIONED}, arrays AS (SELECT doc_id, to_json(list({{'text': text, 'start': start,
              'end': "end", 'type': type, 'section': section}} ORDER BY start))::VARCHAR AS records
              FROM sectioned GROUP BY doc_id)
            SELECT d.doc_id, coalesce(records, '[]') AS records FROM documents d LEFT JOIN arrays USING (doc_id)""",
        "markup_lines": f"WITH {PAGES} SELECT page_id, page_no, line_no, line FROM page_lines",
        "markup_text": f"""WITH {PAGE_TEXT} SELECT p.page_id, coalesce(text, '') AS html
            FROM pages p LEFT JOIN page_text USING (page_id)""",
        "page_counts": f"""WITH {PAGES},
            a AS (SELECT page_id, count(*) AS n FROM page GROUP BY page_id),
            b AS (SELECT page_id, count(*) AS n, sum(length(line)) AS c FROM page_lines GROUP BY page_id)
            SELECT p.page_id, coalesce(a.n, 0) AS pages, coalesce(b.n, 0) AS lines, coalesce(b.c, 0)::BIGINT AS chars
            FROM pages p LEFT JOIN a USING (page_id) LEFT JOIN b USING (page_id)""",
        "page_entities": f"""WITH {PAGE_TEXT}, {sentence_entities('page_text', 'page_id')}
            SELECT page_id, text, start, "end", type FROM entities""",
        "cue_spans": f'WITH {CUE_MATCHES} SELECT doc_id, sent_id, start, "end", cue, kind FROM cues',
        "cue_table_spans": f"""WITH {BENCHMARK_CUES}, {CUE_MATCHES.replace(f"cue_table(cue, kind) AS (VALUES {CUE_VALUES}),", "")}
            SELECT doc_id, sent_id, start, "end", cue, kind FROM cues""",
        "assertions": f"""WITH {ASSERTED} SELECT e.doc_id, text, e.start, "end", type,
            CASE WHEN n.doc_id IS NULL THEN 'affirmed' ELSE 'negated' END AS assertion
            FROM entities e LEFT JOIN negated n ON n.doc_id = e.doc_id AND n.start = e.start""",
        "user_sentence_model": rf"""WITH m AS (SELECT doc_id, {model('text')} AS t FROM documents),
            x AS (SELECT doc_id, regexp_extract_all(t, '\b[A-Z]{{2,}}\b') AS words,
              string_split_regex(t, '\b[A-Z]{{2,}}\b') AS gaps FROM m),
            y AS (SELECT doc_id, unnest(words) AS text, unnest(gaps[:len(words)]) AS gap,
              unnest(range(len(words))) AS n FROM x),
            z AS (SELECT doc_id, n, text, (sum(length(gap) + length(text)) OVER (PARTITION BY doc_id ORDER BY n))::BIGINT
              AS "end" FROM y)
            SELECT doc_id, text, "end" - length(text) AS start, "end", 'CAPS' AS type FROM z""",
        "failed_taggings": f"""WITH {TOK}, bad AS (SELECT DISTINCT doc_id FROM atok WHERE regexp_matches(t, '^[0-9]+$'))
            SELECT d.doc_id, CASE WHEN b.doc_id IS NULL THEN 'ok' ELSE 'error' END AS status,
              CASE WHEN b.doc_id IS NOT NULL THEN 'ValueError: numbers are not supported' END AS error
            FROM documents d LEFT JOIN bad b USING (doc_id)""",
        "pending_after_failures": f"""WITH {TOK}
            SELECT DISTINCT doc_id FROM atok WHERE regexp_matches(t, '^[0-9]+$')""",
        "key_filter": "SELECT page_id, url FROM pages WHERE url LIKE '%.html'",
        "key_prefix": "SELECT page_id, url FROM pages WHERE starts_with(url, 'https://') AND url > 'https://m'",
        "doc_key": r"""WITH b AS (SELECT page_id, string_split(url, '/')[-1] AS base FROM pages)
            SELECT page_id, string_split(base, '.')[1] AS short_id,
              CASE WHEN contains(base, '.') THEN left(base, length(base) - strpos(reverse(base), '.')) ELSE base END
              AS document_id FROM b""",
        "batches": """WITH k AS (SELECT doc_id, row_number() OVER (ORDER BY doc_id) - 1 AS i, count(*) OVER () AS n
              FROM documents),
            s AS (SELECT doc_id, i, n, least(32, n) AS size FROM k),
            filled AS (SELECT doc_id, i, size FROM s
              UNION ALL SELECT doc_id, i + n, size FROM s WHERE i < (size - n % size) % size)
            SELECT i // size AS batch, i % size AS slot, doc_id FROM filled""",
        "pending_docs": "SELECT doc_id, text FROM documents WHERE doc_id NOT IN (SELECT doc_id FROM labels)",
        "failed_docs": "SELECT doc_id FROM documents WHERE doc_id NOT IN (SELECT doc_id FROM labels)",
        "processed_keys": "SELECT doc_id FROM documents",
        "output_count": "SELECT count(*) AS outputs FROM pages WHERE starts_with(url, 'https://')",
        "run_summary": """WITH c AS (SELECT (SELECT count(*) FROM documents) AS inputs,
              (SELECT count(*) FROM labels) AS outputs)
            SELECT inputs, outputs, outputs AS success, greatest(inputs - outputs, 0) AS failed,
              TIMESTAMP '2024-01-01 08:00:00' AS start, TIMESTAMP '2024-01-01 09:30:30' AS "end",
              5430.0::DOUBLE AS total_seconds, 2 AS instances FROM c""",
    }

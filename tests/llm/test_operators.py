"""Each operator against brute force, a library or held-out rows, and over awkward tables."""

import hashlib
import math
import random
import zlib

import public_tokenizers
import pytest
from pyspark.sql import functions as F
from tokenizers import Tokenizer

import corpus_pipeline
from marginalia.llm import (
    bpe, exact_dedup, fingerprints, jaccard_join, langid, line_dedup, lm_score, packing, quality, queries, url_filter,
)

SF = "/root/testdata/sf0.001"
WORDS, PIECES = queries.word_vocabulary(), queries.piece_vocabulary()
SCHEMA = "doc_id long, text string, hash string, id string, lang string, quality int, chunk int"
TEXTS = [
    None, "", " \t\n ", "One small text here.", "One small text here.", "one  small\ttext\nhere.", "é" * 3, "12 34 !!",
    "the same words again and again in a row of many words " * 400, "x" * 20_000, "a\x00b <|endoftext|> c d",
    "A line that is long enough\nshort\nA line that is long enough\n", "a LINE that is long enough  \nother text line 2",
]


@pytest.fixture(scope="module")
def awkward(spark):
    """Nulls, empty and long texts, ties, rows given twice, a null id, and columns with clashing names."""
    rows = [(i, t, "h", "i", "en" if i % 2 else None, i % 2, 1) for i, t in enumerate(TEXTS)]
    rows += [rows[3], rows[3], (None, "One small text here.", None, None, None, None, None), (None, None, None, None, None, None, None)]
    return spark.createDataFrame(rows, SCHEMA).repartition(3).cache()


def labels_of(docs):
    return docs.select("doc_id", "quality")


OPERATORS = {
    "quality": lambda d: quality.scores(d, labels_of(d)),
    "lines": line_dedup.deduplicated,
    "exact": exact_dedup.exact_groups,
    "lm": lambda d: lm_score.scores(d, F.col("doc_id") % 2 == 0, settings=lm_score.Settings(bits=14)),
    "near": jaccard_join.near_groups,
    "langid": lambda d: langid.languages(d, d, PIECES),
    "fingerprints": fingerprints.fingerprints,
    "edits": fingerprints.edit_likeness,
    "bpe": lambda d: bpe.encoded(d, WORDS),
    "digests": lambda d: bpe.digests(d, WORDS),
}


@pytest.mark.parametrize("name", OPERATORS)
def test_a_row_for_each_row(awkward, name):
    rows = OPERATORS[name](awkward).collect()
    key = lambda x: (x is None, x or 0)
    assert sorted((r["doc_id"] for r in rows), key=key) == sorted((r["doc_id"] for r in awkward.collect()), key=key)


@pytest.mark.parametrize("name", [*OPERATORS, "packing"])
def test_empty_table(awkward, name):
    operator = OPERATORS.get(name, lambda d: packing.packed(d, WORDS))
    assert operator(awkward.filter("doc_id > 1000")).collect() == []


def test_empty_rules_and_null_urls(spark):
    pages = spark.createDataFrame([(1, None), (2, "no host"), (3, "http://A.com"), (3, "http://A.com"), (None, "http://b.net/x?y")], "page_id long, url string")
    none = spark.createDataFrame([], "host string, path string, verdict string")
    rows = url_filter.judged(pages, none).collect()
    assert len(rows) == 5 and {r["verdict"] for r in rows} == {"allow"} and {r["host"] for r in rows} == {"", "a.com", "b.net"}


def test_url_rules_by_brute_force(spark):
    rnd = random.Random(3)
    hosts = ["com", "a.com", "b.a.com", "net", "xa.com", "a.net"]
    paths = ["/", "/e", "/en/", "/en/x", ""]
    rules = [(rnd.choice(hosts), rnd.choice(paths), rnd.choice(["allow", "block"])) for _ in range(9)]
    rules = list({r[:2]: r for r in rules}.values())
    urls = [(i, f"http://{rnd.choice(hosts)}{rnd.choice(paths)}{rnd.choice(['', 'x', '?q=/en/', '#f'])}") for i in range(300)]
    got = url_filter.judged(
        spark.createDataFrame(urls, "page_id long, url string"),
        spark.createDataFrame(rules, "host string, path string, verdict string"), salt_rows=20,
    ).collect()
    for r in got:
        fits = [x for x in rules if (r["host"] == x[0] or r["host"].endswith("." + x[0])) and r["path"].startswith(x[1])]
        best = max(fits, key=lambda x: (len(x[0] + x[1]), len(x[0])), default=None)
        assert (r["rule"], r["verdict"]) == ((best[0] + best[1], best[2]) if best else (None, "allow")), r


def test_lines_keep_bitmap(awkward):
    kept = {(r["doc_id"], r["kept_text"]): r["n_dropped"] for r in line_dedup.deduplicated(awkward).collect()}
    assert kept[12, "other text line 2"] == 1 and kept[11, TEXTS[11]] == 0 and kept[None, "One small text here."] == 0
    assert kept[0, ""] == 0 and kept[4, ""] == 1  # its one line belongs to document 3


def test_collisions_are_told_apart(spark):
    docs = spark.createDataFrame([(i, f"text {i % 7}") for i in range(60)], "doc_id long, text string")
    weak = exact_dedup.exact_groups(docs, hashed=lambda c: F.length(c)).collect()
    assert all(r["keep_id"] == r["doc_id"] % 7 and r["kept"] == (r["doc_id"] < 7) for r in weak)
    assert {r["doc_id"]: r["group_size"] for r in weak} == {i: len(range(i % 7, 60, 7)) for i in range(60)}


def test_near_groups_by_brute_force(spark):
    rnd = random.Random(5)
    base = [[rnd.choice("abcdefghijklmnopqrstuvwxyz") * 2 + str(rnd.randrange(400)) for _ in range(n)] for n in (3, 5, 6, 9, 14, 25, 60, 130, 400)]
    texts = []
    for words in base:
        for _ in range(14):
            copy = list(words)
            for _ in range(rnd.randrange(0, 1 + len(words) // 20 + 1)):
                copy[rnd.randrange(len(copy))] = "edit" + str(rnd.randrange(9))
            texts.append(" ".join(copy[rnd.randrange(2):]))
    sets = []
    for t in texts:
        w = t.split()
        n = min(5, len(w))
        sets.append({tuple(w[i : i + n]) for i in range(len(w) - n + 1)})
    root = list(range(len(texts)))
    for a in range(len(texts)):
        for b in range(a):
            if 100 * len(sets[a] & sets[b]) >= 80 * len(sets[a] | sets[b]) and root[a] != root[b]:
                low, high = sorted((root[a], root[b]))
                root = [low if r == high else r for r in root]
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string").repartition(4)
    for limit in (2_000, 0):  # also with each open signature told apart by a second one
        jaccard_join.OPEN_PAIRS = limit
        try:
            got = {r["doc_id"]: (r["n_shingles"], r["component_id"]) for r in jaccard_join.near_groups(docs).collect()}
        finally:
            jaccard_join.OPEN_PAIRS = 2_000
        assert got == {i: (len(s), root[i]) for i, s in enumerate(sets)}


def test_encoding_equals_the_library(spark, awkward):
    library = Tokenizer.from_file(WORDS)
    rnd = random.Random(1)
    parts = ["th", "in", "er", "on", "an", "re", "ing", "at", "é", "ß", "'s", "!", "1", "Σ", " "]
    texts = ["".join(rnd.choice(parts) for _ in range(rnd.randint(1, 30))) for _ in range(800)]
    docs = awkward.select("doc_id", "text").unionByName(spark.createDataFrame([(100 + i, t) for i, t in enumerate(texts)], "doc_id long, text string"))
    want = {}
    for r in docs.collect():
        ids = library.encode(r["text"] or "", add_special_tokens=False).ids
        want[r["doc_id"], r["text"]] = (ids, library.decode(ids, skip_special_tokens=False))
    by_id = {r["doc_id"]: r["text"] for r in docs.filter("doc_id IS NOT NULL").collect()}
    for r in bpe.encoded(docs.filter("doc_id IS NOT NULL"), WORDS).collect():
        assert (r["ids"], r["decoded"]) == want[r["doc_id"], by_id[r["doc_id"]]]
    for r in bpe.digests(docs.filter("doc_id IS NOT NULL"), WORDS).collect():
        ids, text = want[r["doc_id"], by_id[r["doc_id"]]]
        assert r["n_tokens"] == len(ids) and r["decoded_sha256"] == hashlib.sha256(text.encode()).hexdigest()
        assert r["ids_sha256"] == hashlib.sha256(" ".join(map(str, ids)).encode()).hexdigest()


def test_packing_is_whole_and_tight(spark):
    library = Tokenizer.from_file(WORDS)
    docs = spark.read.parquet(f"{SF}/documents.parquet").select("doc_id", "text")
    rows = packing.packed(docs, WORDS, capacity=512).collect()
    ids = {r["doc_id"]: library.encode(r["text"] or "", add_special_tokens=False).ids + [0] for r in docs.collect()}
    bins, seen = {}, {}
    for r in rows:
        own = ids[r["doc_id"]][r["start"] : r["start"] + r["length"]]
        assert len(own) == r["length"] and zlib.crc32(b"".join(i.to_bytes(4, "little") for i in own)) == r["ids_crc32"]
        assert r["start"] == 512 * r["piece"]
        seen[r["doc_id"]] = seen.get(r["doc_id"], 0) + r["length"]
        bins.setdefault(r["sequence_id"], []).append((r["offset"], r["length"]))
    assert seen == {k: len(v) for k, v in ids.items()}
    for places in bins.values():
        at = 0
        for offset, length in sorted(places):
            assert offset == at
            at += length
        assert at <= 512
    assert len(bins) <= 1.01 * -(-sum(seen.values()) // 512) + 1


def test_best_two_fit_replaces_the_smallest():
    bins = packing.best_two_fit({6: 1, 3: 1, 2: 2}, 10)
    assert bins[0] == ([6, 2, 2], 1) and bins[1] == ([3], 1)
    with pytest.raises(ValueError):
        packing.best_two_fit({11: 1}, 10)


def test_fingerprints_of_equal_and_shifted_texts(awkward):
    rnd = random.Random(2)
    text = " ".join("".join(rnd.choice("aeioustrn") for _ in range(rnd.randint(2, 9))) for _ in range(400)).encode()
    a, b, c = fingerprints.sketches([text, b"some words before " + text, text[::-1]])
    one = lambda x, y: fingerprints.likeness(x[None], y[None])[0]
    assert one(a, b) > 0.9 and one(a, c) < 0.1 and (fingerprints.sketches([text]) == a).all()
    alone = {r["doc_id"]: r["fingerprint"] for r in fingerprints.fingerprints(awkward).collect()}
    assert alone[3] == alone[4] and alone[0] == alone[1]


def test_edits_follow_the_order_of_ids(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet").select("doc_id", "text")
    texts = [r["text"] for r in docs.orderBy("doc_id").collect()]
    rows = sorted(fingerprints.edit_likeness(docs.repartition(5)).collect(), key=lambda r: r["doc_id"])
    for i, r in enumerate(rows):
        changed = fingerprints.edited(texts[i], texts[(i + 1) % len(texts)]).encode()
        assert r["n_chars"] == len(texts[i]) and r["edited_sha256"] == hashlib.sha256(changed).hexdigest()
        assert r["edited_fingerprint"] == fingerprints.shown(fingerprints.sketches([changed])[0])
    assert sum(r["near_edited"] - r["near_next"] for r in rows) / len(rows) > 0.25


def test_language_and_quality_of_held_out_rows(spark):
    folder = "/root/testdata/sf0.01"
    lang = spark.read.parquet(f"{folder}/documents.parquet").select("doc_id", "lang")
    found = queries.op8_language_id(spark, folder).join(lang, "doc_id").filter("held_out").toPandas()
    assert (found["lang"] == found["lang_pred"]).mean() > 0.97 and found["score"].between(0, 1).all()
    labels = spark.read.parquet(f"{folder}/labels.parquet")
    judged = queries.op1_quality_classifier(spark, folder).join(labels, "doc_id").filter("held_out").toPandas()
    assert (judged["quality"] == judged["predicted"]).mean() > 0.8
    assert judged[judged["quality"] == 1]["predicted"].mean() > 0.97


def test_language_forward_sums_all_segmentations():
    pieces = {"a": 1, "b": 2, "ab": 3}
    import numpy as np

    chance = np.array([[0.0], [0.5], [0.25], [0.25], [0.0]])
    [(_, lattice)] = list(langid.lattices(["ab"], langid.PieceTrie(pieces), 2))
    assert langid.forward(lattice, chance)[0, -1, 0] == pytest.approx(0.5 * 0.25 + 0.25)


def test_language_pieces_of_any_length_over_stretches():
    """Counts and probabilities are those of the whole word, however it is read; nothing underflows."""
    import numpy as np

    pieces = {"a": 1, "b": 2, "ab": 3, "abababababab": 4, "bbb": 5}
    words = {"abababababab": 3, "ab" * 20 + "bbb": 2, "b" * 90 + "a": 1, "xab": 1, "a": 4}
    whole = langid.fitted(words, pieces, langid.Settings(word_chars=1000))
    assert whole[4] > 0.05
    for size in (1, 5, 12, 32):
        assert np.allclose(langid.fitted(words, pieces, langid.Settings(word_chars=size)), whole, rtol=1e-9)
    trie, chance = langid.PieceTrie(pieces), np.append(whole, 0)[:, None]

    def brute(word):
        total = [1.0]
        for end in range(1, len(word) + 1):
            total.append(sum(
                total[end - n] * (whole[pieces.get(word[end - n : end], 0)] if n == 1 or word[end - n : end] in pieces else 0)
                for n in range(1, min(end, 12) + 1)
            ))
        return math.log(total[-1])

    for size in (3, 32):
        assert np.allclose(langid.log_chances(list(words), trie, chance, size)[:, 0], [brute(w) for w in words])
    [[log]] = langid.log_chances(["x" * 20_000], trie, chance, 32)
    assert log == pytest.approx(20_000 * math.log(whole[0]))
    assert max(map(len, langid.load_pieces(PIECES))) == 16


def test_ftrl_by_plain_arithmetic():
    """McMahan et al., "Ad click prediction" (2013), algorithm 1, feature by feature."""
    import numpy as np

    settings = quality.Settings(bits=5, l1=0.05, l2=0.1, alpha=0.7, beta=1.0)
    model, rnd = quality.Ftrl(settings), random.Random(10)
    z, n = [0.0] * 32, [0.0] * 32

    def weight(i):
        if abs(z[i]) <= settings.l1:
            return 0.0
        return -(z[i] - math.copysign(settings.l1, z[i])) / ((settings.beta + math.sqrt(n[i])) / settings.alpha + settings.l2)

    for _ in range(300):
        at = sorted(rnd.sample(range(32), rnd.randrange(1, 9)))
        values, label = [rnd.uniform(0.1, 1) for _ in at], rnd.randrange(2)
        w = [weight(i) for i in at]
        chance = 1 / (1 + math.exp(-sum(x * y for x, y in zip(w, values))))
        for i, own, value in zip(at, w, values):
            gradient = (chance - label) * value
            step = (math.sqrt(n[i] + gradient**2) - math.sqrt(n[i])) / settings.alpha
            z[i] += gradient - step * own
            n[i] += gradient**2
        model.learn(np.array(at), np.array(values), label)
    got = model.weights(np.arange(32))
    assert list(got) == pytest.approx([weight(i) for i in range(32)]) and any(got)


def test_quality_features_by_plain_counts():
    """A feature for each term, pair of neighbours and equality of neighbours, and one for the text."""
    from collections import Counter

    from marginalia.llm.common import Memo, word_hash

    def plain(text):
        parts = [t for w in text.split() for t in quality.TERM.findall(w)]
        spread, full = 0xD6E8FEB86659FD93, 1 << 64
        number = lambda x: (x * spread % full) >> 46
        hashed = [word_hash(t) % full for t in parts]
        pairs = list(zip(hashed, hashed[1:]))
        return Counter([0] + [number(x) for x in hashed] + [number((b * 0x9E3779B97F4A7C15 + a) % full) for a, b in pairs]
                       + [2 if a == b else 1 for a, b in pairs])

    known = Memo(quality.terms)
    for text in (b"", b" ", b"one", b"a a b, b", "\u00e9t\u00e9 -- no. No!".encode(), b"x" * 5000, b"w " * 3000):
        counts = plain(text)
        index, value = quality.scaled(quality.features(text, known, 18))
        assert list(index) == sorted(counts)
        assert list(value) == pytest.approx([math.sqrt(counts[i] / sum(counts.values())) for i in sorted(counts)])


def plain_sketch(text: bytes) -> list[int]:
    """The parse of one text, symbol by symbol."""
    full, odd, base = 1 << 64, 0x9E3779B97F4A7C15, 0xD6E8FEB86659FD93

    def mix(x):
        x = (x ^ (x >> 32)) * odd % full
        x = (x ^ (x >> 29)) * 0xBF58476D1CE4E5B9 % full
        return x ^ (x >> 32)

    def toss(symbols):
        out = []
        for i, x in enumerate(symbols):
            differ = x ^ symbols[i - 1] if i else 1
            bit = (differ & -differ).bit_length() - 1
            out.append(2 * bit + (x >> bit & 1))
        return out

    least, symbols = {}, list(text)
    for level in (1, 2, 3):
        runs = []
        for x in symbols:
            if runs and runs[-1][0] == x:
                runs[-1][1] += 1
            else:
                runs.append([x, 1])
        labels = [x for x, _ in runs]
        for _ in range(3 if level == 1 else 4):
            labels = toss(labels)
        assert all(x < 6 for x in labels)
        parts = []
        for i, run in enumerate(runs):
            if not i or i + 1 < len(runs) and labels[i - 1] < labels[i] > labels[i + 1]:
                parts.append([])
            parts[-1].append(run)
        symbols = [
            mix(sum(mix((x + n * odd) % full) * pow(base, min(i, 63) + 1, full) for i, (x, n) in enumerate(part)) % full) for part in parts
        ]
        if level > 1:
            for x in symbols:
                name = mix((x + level) % full)
                least[name >> 58] = min(least.get(name >> 58, full), name % (1 << 58))
    return [min(mix(least[i]) >> 48, 0xFFFE) if i in least else 0xFFFF for i in range(fingerprints.BINS)]


def test_parse_by_plain_steps():
    rnd = random.Random(11)
    texts = [b"", b"a", b"ab", b"aaaa", b"a" * 500, "\u00e9t\u00e9 d'hiver".encode(), bytes(range(256))]
    texts += [" ".join(rnd.choices(["one", "two", "three", "quite", "longer"], k=n)).encode() for n in (3, 40, 400)]
    assert fingerprints.sketches(texts).tolist() == [plain_sketch(t) for t in texts]


def random_model(bits: int, seed: int):
    import numpy as np

    rnd = np.random.default_rng(seed)
    mix = lm_score.Mixer(rnd.normal(0.2, 0.3, (lm_score.GATES, lm_score.INPUTS)), rnd.uniform(1, 5, (256, lm_score.STEPS)), np.full((256, lm_score.STEPS), 6.0))
    return mix, rnd.normal(0, 2, 2 << bits), rnd.integers(0, 9, 2 << bits).astype(np.uint8)


@pytest.mark.parametrize("stem", [b"", b"a", b"word", b"\xc3\xa9t\xc3"])
def test_probabilities_of_the_next_byte_sum_to_one(stem):
    import numpy as np

    mix, table, often = random_model(10, 4)
    rows = lm_score.Bits([stem + bytes([x]) for x in range(256)], 10)
    here = np.flatnonzero(rows.pos == len(stem))
    total = np.ones(256)
    for bit in range(8):
        node, value, slots = rows.slots(bit)
        chance = mix.predict(node, [table[s] for s in slots], often[slots[-1]], often[slots[-2]])[3]
        total *= np.where(value == 1, chance, 1 - chance)[here]
    assert len(set(total)) > 100 and total.sum() == pytest.approx(1)


def test_mixer_by_plain_arithmetic():
    import numpy as np

    mix, table, often = random_model(8, 5)
    rnd = random.Random(6)
    size, rate = 40, 0.05
    node = np.array([rnd.randrange(1, 256) for _ in range(size)], np.uint32)
    inputs = [np.array([rnd.uniform(-6, 6) for _ in range(size)]) for _ in range(lm_score.INPUTS)]
    word, order = (np.array([rnd.randrange(9) for _ in range(size)], np.uint8) for _ in range(2))
    value, weight = np.array([rnd.randrange(2) for _ in range(size)]), np.array([rnd.uniform(0.5, 3) for _ in range(size)])
    weights, hits, seen = mix.weights.copy(), mix.hits.copy(), mix.seen.copy()
    gate, mixed, cell, chance = mix.predict(node, inputs, word, order)
    logistic = lambda x: 1 / (1 + math.exp(-x))
    slopes, totals = {}, {}
    for i in range(size):
        g = int(word[i]) * 5 + int(order[i]) // 2
        x = max(-12, min(12, sum(weights[g, n] * inputs[n][i] for n in range(lm_score.INPUTS))))
        step = max(0, min(lm_score.STEPS - 1, round((x + 8) * 2)))
        assert (gate[i], mixed[i]) == (g, pytest.approx(x))
        assert chance[i] == pytest.approx((logistic(x) + hits[node[i], step] / seen[node[i], step]) / 2)
        totals[g] = totals.get(g, 0) + weight[i]
        for n in range(lm_score.INPUTS):
            slopes[g, n] = slopes.get((g, n), 0) + (value[i] - logistic(x)) * weight[i] * inputs[n][i]
    mix.learn(gate, mixed, cell, inputs, value, weight, rate)
    for (g, n), slope in slopes.items():
        slope /= totals[g]
        assert mix.weights[g, n] == pytest.approx(weights[g, n] + rate * slope / math.sqrt(1e-4 + slope**2))
    assert mix.seen.sum() == pytest.approx(seen.sum() + weight.sum()) and mix.hits.sum() == pytest.approx(hits.sum() + (weight * value).sum())


def test_outcomes_of_contexts_by_brute_force():
    import numpy as np

    rnd = random.Random(8)
    for _ in range(60):
        counted = {(rnd.randrange(5), rnd.randrange(6)): rnd.randrange(5) for _ in range(rnd.randrange(1, 25))}
        keys = sorted(counted)
        packed = np.array([(c << lm_score.WORD_BITS) | w for c, w in keys], np.uint64)
        plain, without = lm_score.outcomes(packed, np.array([counted[k] for k in keys]))
        for i, (context, word) in enumerate(keys):
            for found, less in ((plain[i], 0), (without[i], 1)):
                if counted[context, word] < less:
                    continue  # no learned token to be left out
                left = {w: n - less * (w == word) for (c, w), n in counted.items() if c == context}
                total = sum(left.values())
                if not total:
                    assert found == 0
                    continue
                top = min(left, key=lambda w: (-left[w], w))
                steps = [0 if x == 0 else min(x.bit_length(), 7) for x in (left[top], total - left[top])]
                assert found == 1 + (top == word) + 2 * (8 * steps[0] + steps[1])


def test_lm_sees_over_words_and_not_tasks(spark):
    """A text told by another's order of words scores above the same words shuffled, whatever the partitions."""
    rnd = random.Random(9)
    words = [f"w{i}" for i in range(60)]
    texts = [" ".join(rnd.choices(words, k=80)) for _ in range(10)] * 2  # copies, so that contexts tell something
    shuffled = texts[0].split()
    rnd.shuffle(shuffled)
    rows = [(i, t, True) for i, t in enumerate(texts)] + [(100, texts[0], False), (101, " ".join(shuffled), False), (102, None, None), (102, None, None)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, learn boolean")
    small = lm_score.Settings(bits=12, block_bytes=2_000, range_tokens=300, lane_words=20, common=5)
    found = []
    for parts in (1, 7):
        out = lm_score.scores(docs.repartition(parts), F.col("learn"), extra=(F.col("text").alias("score"),), settings=small)
        assert out.columns[:2] == ["doc_id", "score"]
        found.append(sorted((r["doc_id"], r[6], r["bits_per_byte"]) for r in out.collect()))
    one, seven = found
    assert [x[0] for x in one] == [x[0] for x in seven]
    assert [x[1] for x in one] == pytest.approx([x[1] for x in seven]) and [x[2] for x in one] == pytest.approx([x[2] for x in seven])
    of = {x[0]: x[1] for x in one}
    assert of[100] > of[101] + 20
    assert of[102] < 0


def test_lm_counts_of_tokens(spark):
    rows = queries.op5_lm_scoring(spark, SF).toPandas()
    assert (rows["score"] < 0).all() and (rows["n_known"] <= rows["n_tokens"]).all()
    known = rows[~rows["held_out"]]
    assert (known["n_known"] == known["n_tokens"]).all() and rows["train_tokens"].nunique() == 1
    assert known["n_tokens"].sum() == rows["train_tokens"].iloc[0]


def test_lm_counts_by_brute_force(spark):
    from collections import Counter
    from math import log10

    docs = {r["doc_id"]: r["text"] or "" for r in spark.read.parquet(f"{SF}/documents.parquet").collect()}
    words = {i: t.encode().lower().split() + [b""] for i, t in docs.items()}
    train = Counter(w for i, ws in words.items() if zlib.crc32(str(i).encode()) % 5 != 1 for w in ws)
    n, v = sum(train.values()), len(train)
    for r in queries.op5_lm_scoring(spark, SF).collect():
        base = sum(log10((train[w] + 0.5) / (n + 0.5 * (v + 1))) for w in words[r["doc_id"]])
        assert r["train_tokens"] == n and r["base_score"] == pytest.approx(base)
        assert r["n_known"] == sum(train[w] > 0 for w in words[r["doc_id"]])


def test_stages_judge_rows_that_repeat_ids_or_have_none(spark):
    copy, other = " ".join(f"copy{i}" for i in range(200)), " ".join(f"other{i}" for i in range(200))
    alone = " ".join(f"alone{i}" for i in range(200))
    rows = [(1, copy), (1, copy), (2, copy), (2, alone), (None, copy), (None, other), (None, other), (3, None)]
    docs = spark.createDataFrame(rows, "doc_id long, text string").repartition(3)
    left = [(1, copy), (2, alone), (None, other), (3, None)]
    for stage in (corpus_pipeline.exact_deduplication, corpus_pipeline.ngram_jaccard_join):
        assert sorted(map(str, map(tuple, stage(spark, docs, SF).collect()))) == sorted(map(str, left))
    near = docs.withColumn("text", F.concat("text", F.lit(" "), F.coalesce(F.col("doc_id").cast("string"), F.lit("end"))))
    kept = corpus_pipeline.ngram_jaccard_join(spark, near, SF).collect()
    assert sorted(map(str, map(tuple, kept))) == sorted(map(str, [(1, f"{copy} 1"), (2, f"{alone} 2"), (None, f"{other} end"), (3, None)]))


def test_near_groups_of_an_id_with_a_null_text(spark):
    text = " ".join(f"w{i}" for i in range(200))
    docs = spark.createDataFrame([(1, text), (1, None), (2, f"{text} more"), (2, None)], "doc_id long, text string")
    rows = sorted((r["doc_id"], r["n_shingles"] > 0, r["component_id"]) for r in jaccard_join.near_groups(docs).collect())
    assert rows == [(1, False, 1), (1, True, 1), (2, False, 2), (2, True, 1)]  # a null text links with nothing


def test_pipeline_by_stages(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    before = docs
    for name, stage in corpus_pipeline.STAGES[:-1]:
        after = stage(spark, before, SF).cache()
        assert after.columns == docs.columns
        ids, kept = ({r["doc_id"] for r in x.select("doc_id").collect()} for x in (before, after))
        assert kept <= ids and len(kept) > 0.5 * len(ids), name
        before = after
    assert before.select("text").distinct().count() == before.count()
    rows = corpus_pipeline.run(spark, SF).collect()
    assert {r["doc_id"] for r in rows} == {r["doc_id"] for r in before.collect()}


@pytest.mark.parametrize("name", queries.oracle_sql())
def test_query_equals_sql(spark, name):
    from check import compare, connect

    assert compare(spark, connect(SF), SF, name).startswith("ok")


def clashing(spark):
    """Columns with names that operators use inside, or that need quoting; null, empty and repeated rows."""
    text = " ".join(f"the word{i} and of it" for i in range(60))
    rows = [(1, text, "en", 11, "r", "t", 1, "x y"), (1, text, "en", 11, "r", "t", 1, "x y"), (2, text + " more", "en", 12, None, "u", 2, ""),
            (3, None, None, 13, "", "", 3, None), (4, "", "en", 14, "", "", 3, None), (None, "other text of its own", "en", 15, "", "", 3, None)]
    return spark.createDataFrame(
        rows, "doc_id long, text string, lang string, _row long, row string, _text string, _document int, `a b.c` string"
    ).repartition(2)


@pytest.mark.parametrize("name, stage", corpus_pipeline.STAGES[:-1])
def test_stages_keep_columns_of_any_name(spark, name, stage):
    docs = clashing(spark)
    kept = stage(spark, docs, SF)
    assert kept.columns == docs.columns and kept.schema["a b.c"].dataType == docs.schema["a b.c"].dataType
    before, after = (sorted(map(str, map(tuple, x.collect()))) for x in (docs, kept))
    assert set(after) <= set(before)
    if name in ("exact_dedup", "ngram_jaccard_join"):
        numbers = sorted(r["_row"] for r in kept.collect())
        assert numbers == ([11, 12, 13, 15] if name == "exact_dedup" else [11, 13, 14, 15])
    assert stage(spark, docs.filter("_row > 99"), SF).collect() == []


def test_packing_of_columns_of_any_name(spark):
    docs = clashing(spark)
    rows = corpus_pipeline.best_fit_packing(spark, docs, SF).collect()
    assert len(rows) == 6 and corpus_pipeline.best_fit_packing(spark, docs.filter("_row > 99"), SF).collect() == []


def test_lines_of_ids_that_are_no_numbers(spark):
    line = "a line that is long enough"
    docs = spark.createDataFrame([(f"d{i}", f"{line}\nown line of number {i}") for i in range(40)] + [(None, line)], "doc_id string, text string")
    rows = {r["doc_id"]: (r["n_dropped"], r["kept_text"]) for r in line_dedup.deduplicated(docs).collect()}
    assert rows["d0"] == (0, f"{line}\nown line of number 0") and rows[None] == (0, line)
    assert all(rows[f"d{i}"] == (1, f"own line of number {i}") for i in range(1, 40))


def test_urls_of_many_labels_and_any_length(spark):
    rules = spark.createDataFrame([("b.com", "/", "block"), ("com", "/x", "allow")], "host string, path string, verdict string")
    many = "a." * 30_000 + "b.com"
    pages = spark.createDataFrame([(1, f"http://{many}/x"), (2, "http://b.com/" + "y" * 200_000), (3, "http://.com/x")], "page_id long, url string")
    rows = {r["page_id"]: (r["host"], r["rule"], r["verdict"]) for r in url_filter.judged(pages, rules).collect()}
    assert rows == {1: (many, "b.com/", "block"), 2: ("b.com", "b.com/", "block"), 3: (".com", "com/x", "allow")}


def test_no_rows_for_empty_tables_of_pages(spark):
    rules = spark.createDataFrame(queries.URL_RULES, "host string, path string, verdict string")
    assert url_filter.judged(spark.createDataFrame([], "page_id long, url string"), rules).collect() == []


def test_near_groups_of_one_large_component(spark):
    """A component of a third of all rows costs no pairs within itself, and no link to another is lost."""
    base = [f"w{i}" for i in range(120)]
    texts = [" ".join(base + [f"end{i}"]) for i in range(300)]
    texts += [" ".join(base[: 120 - k]) for k in (10, 14, 18)]  # linked with the large one, or with each other
    texts += [" ".join(f"o{i}x{j}" for j in range(50)) for i in range(100)]
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string").repartition(4)
    got = {r["doc_id"]: r["component_id"] for r in jaccard_join.near_groups(docs).collect()}
    assert all(got[i] == 0 for i in range(303)) and all(got[i] == i for i in range(303, 403))


def test_similar_sets_share_a_band_and_a_signature():
    import numpy as np

    rnd, similarity = np.random.default_rng(3), jaccard_join.Similarity()
    for small in range(1, 3000):
        band, large = similarity.bands(small)[0], 100 * small // 80
        assert all(band in similarity.bands(size) for size in {small, (small + large) // 2, large})
        assert (small + large) * 20 // 180 <= similarity.differing(band)
    for _ in range(1000):
        all_of = np.unique(rnd.integers(0, 2**63, int(np.exp(rnd.uniform(np.log(2), np.log(3000)))), dtype=np.uint64))
        mixed = rnd.permutation(all_of)
        common = -(-80 * len(mixed) // 100)
        cut = common + rnd.integers(0, len(mixed) - common + 1)
        a, b = np.sort(mixed[:cut]), np.sort(np.concatenate([mixed[:common], mixed[cut:]]))
        assert jaccard_join.similar(a, b, 80)
        left = []
        for one in (a, b):  # without those that each can spare, in an order of their own
            kept = set()
            for band in similarity.bands(len(one)):
                of = [(s, c) for s, c in zip(*jaccard_join.signatures(one, similarity)) if c >> jaccard_join.SPARE_BITS == band]
                kept |= {s for s, _ in sorted(of)[of[0][1] & ((1 << jaccard_join.SPARE_BITS) - 1) :]}
            left.append(kept)
        assert left[0] & left[1]

"""Every operator against a plain version of its contract, and on odd tables."""

import hashlib
import itertools
import math
import random
import re
import time
import zlib
from collections import Counter, defaultdict

import numpy as np
import pytest
from support import SF, same

from sigil.llm import chat, decontaminate, exact_dedup, line_dedup, maxent_lm, packing, pii, quality_crf, queries, repeats, simhash, substring_dedup, suffix_trees, tokens

BENCH = [(1, " ".join(f"w{k}" for k in range(100, 120))), (2, "no id at all"), (3, None), (4, "")]


def sha(x):
    return hashlib.sha256(x if isinstance(x, bytes) else x.encode()).hexdigest()


def rows(df):
    return [tuple(r) for r in df.collect()]


def bucket(i, mod):
    return zlib.crc32(("" if i is None else str(i)).encode()) % mod


# Quality


def test_quality_on_held_out(spark, docs):
    labels = spark.read.parquet("/root/testdata/sf0.01/labels.parquet")
    more = spark.read.parquet("/root/testdata/sf0.01/documents.parquet")
    model = quality_crf.train(more, labels)
    truth = {r.doc_id: r.quality for r in labels.collect()}
    found = [r for r in quality_crf.score(more, model).collect() if r.doc_id in truth]
    assert all(r.held_out == (bucket(r.doc_id, 5) == 0) and r.predicted == (r.score >= 0.3) and 0 <= r.score <= 1 for r in found)
    held = [r for r in found if r.held_out]
    assert np.mean([r.predicted == truth[r.doc_id] for r in held]) >= 0.95


@pytest.mark.parametrize("piece", [1, 2, 3, 256])
def test_chain_against_enumeration(piece):
    rng = np.random.default_rng(0)
    counts = np.array([1, 4, 2, 7, 5])
    unary, trans = rng.normal(size=(counts.sum(), 2)), rng.normal(size=(2, 2))
    marginal, pair = quality_crf.chain(unary, trans, counts, piece=piece)
    want_pair, at = np.zeros((2, 2)), 0
    for n in counts:
        paths = list(itertools.product((0, 1), repeat=n))
        weight = np.array([math.exp(sum(unary[at + t, s] for t, s in enumerate(p)) + sum(trans[a, b] for a, b in itertools.pairwise(p))) for p in paths])
        weight /= weight.sum()
        for t in range(n):
            assert marginal[at + t, 1] == pytest.approx(sum(w for w, p in zip(weight, paths, strict=True) if p[t]))
        for w, p in zip(weight, paths, strict=True):
            for a, b in itertools.pairwise(p):
                want_pair[a, b] += w
        at += n
    assert np.allclose(pair, want_pair)


def plain_lines(text):
    """Own features of each line, one by one."""
    groups = ("abcdefghijklmnopqrstuvwxyz", "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "0123456789", " \t\r\x0b\x0c", ".", ",;:", "!?", "$%&", "*#@", "|", "'\"`-", "()[]{}", "<>/\\=+~^_")
    kinds = (0, 1, 2, 3, 4, 4, 5, 5, 5, 5, 4, 4, 5)

    def fine(b):
        return next((k for k, g in enumerate(groups) if b < 128 and chr(b) in g), 13 if 128 <= b < 192 else 14 if b >= 192 else 15)

    def coarse(b):
        return 0 if b >= 128 else 3 if b == 10 else kinds[fine(b)] if fine(b) < 13 else 5

    out, seen = [], set()
    all_lines = text.encode().split(b"\n")
    for line in all_lines:
        n = len(line)
        f, p = np.zeros(16), np.zeros((6, 6))
        for b in line:
            f[fine(b)] += 1
        for x, y in itertools.pairwise(b"\n" + line + b"\n"):
            p[coarse(x), coarse(y)] += 1
        words = re.findall(rb"[^ \t\r\x0b\x0c\n]+", line)
        starts = sum(p[3, k] for k in range(6) if k != 3)
        key = tuple(words)
        doubled = sum(a == b for a, b in itertools.pairwise(words))
        out.append((f, p, n, starts, key in seen and n > 0, doubled))
        seen.add(key)
    return out


def plain_quality(model, text):
    """A document's score by its definition: features by line, all label sequences, the calibration."""
    found = plain_lines(text)
    own = []
    for f, p, n, starts, repeated, doubled in found:
        words = starts + 1
        own.append(np.concatenate([f / max(n, 1), p.ravel() / max(n, 1), [np.log1p(n) / 8, (f[0] + f[1] + f[14]) / words / 8, n == 0, repeated, np.log1p(words) / 6, doubled / words]]))
    w, size = model.weights.astype(float), len(own[0])
    up = []
    for t in range(len(own)):
        x = own[t] @ w[:size] + w[-1] + (w[-3] if t == 0 else own[t - 1] @ w[size : 2 * size]) + (w[-2] if t == len(own) - 1 else own[t + 1] @ w[2 * size : 3 * size])
        up.append(x)
    paths = list(itertools.product((0, 1), repeat=len(own)))
    weight = np.array([math.exp(sum(u * s for u, s in zip(up, path, strict=True)) + sum(model.trans[a, b] for a, b in itertools.pairwise(path))) for path in paths])
    marginal = weight @ np.array(paths) / weight.sum()
    long = np.array([max(f[2], 1) for f in found])
    mean = np.clip(marginal @ long / long.sum(), 1e-6, 1 - 1e-6)
    return 1 / (1 + math.exp(-(model.scale * math.log(mean / (1 - mean)) + model.shift)))


def some_model(seed=0):
    rng = np.random.default_rng(seed)
    return quality_crf.Model(rng.normal(size=3 * quality_crf.N_OWN + 3).astype(np.float32) / 3, rng.normal(size=(2, 2)), 1.3, -0.2)


def test_quality_scores_against_plain_version():
    random.seed(1)
    bits = ["word", "Word", "two  two", "1,234.5", "JUNK!!", "é", "日本", "\n", "\n", " ", "\t", "|", "$5", "(x)", "\x01", "two two"]
    texts = ["", "\n", "a", *("".join(random.choice(bits) + random.choice(["", " "]) for _ in range(random.randint(1, 25))) for _ in range(60))]
    texts = [t for t in texts if t.count("\n") < 10]
    model = some_model()
    want = [plain_quality(model, t) for t in texts]
    assert model.scores(texts) == pytest.approx(want, abs=1e-4)
    whole = model.means(texts)
    cut = [b for b in quality_crf.blocks(texts, 2)]
    assert max(len(b.own) for b in cut) <= 2 and sum(len(b.own) for b in cut) == sum(t.count("\n") + 1 for t in texts)
    assert np.allclose(np.concatenate([b.own for b in cut]), np.concatenate([b.own for b in quality_crf.blocks(texts)])) and len(whole) == len(texts)


def test_quality_gradient():
    """Against differences of the one function that the fit maximises, by enumeration."""
    rng = np.random.default_rng(2)
    pieces = [quality_crf.Piece(k, rng.normal(size=(n, quality_crf.N_OWN)).astype(np.float32), np.ones(n, int), k % 2, n + k) for k, n in enumerate((1, 4, 3))]
    work = quality_crf.Fit(3)
    work.model.weights, work.model.trans = rng.normal(size=3 * quality_crf.N_OWN + 3) / 4, rng.normal(size=(2, 2))
    found, size = work.gradient(pieces)
    assert size == pytest.approx(sum(len(p.own) / p.lines for p in pieces))

    def loss(values):
        w, trans, n = values[:-4], values[-4:].reshape(2, 2), quality_crf.N_OWN
        total = 0.0
        for p in pieces:
            x = p.own.astype(float)
            up = [x[t] @ w[:n] + w[-1] + (x[t - 1] @ w[n : 2 * n] if t else w[-3]) + (x[t + 1] @ w[2 * n : 3 * n] if t + 1 < len(x) else w[-2]) for t in range(len(x))]
            value = lambda path, up=up: sum(u * s for u, s in zip(up, path, strict=True)) + sum(trans[a, b] for a, b in itertools.pairwise(path))
            total -= (value((p.label,) * len(x)) - math.log(sum(math.exp(value(path)) for path in itertools.product((0, 1), repeat=len(x))))) / p.lines
        return total / size

    at = np.concatenate([work.model.weights, work.model.trans.ravel()])
    for k in [*range(0, len(at) - 7, 13), *range(len(at) - 7, len(at))]:
        move = np.zeros(len(at))
        move[k] = 1e-5
        assert found[k] == pytest.approx((loss(at + move) - loss(at - move)) / 2e-5, abs=1e-4)


def test_quality_of_many_lines():
    """Three million empty lines: seconds, and memory by the line."""
    import resource

    before = resource.getrusage(resource.RUSAGE_SELF).ru_maxrss
    began = time.perf_counter()
    assert 0 <= some_model().scores(["\n" * 3_000_000])[0] <= 1
    assert time.perf_counter() - began < 60
    assert resource.getrusage(resource.RUSAGE_SELF).ru_maxrss - before < 1_000_000  # kB


def test_quality_fit_takes_long_documents(spark):
    """A class that only long documents have is learned, whatever the parts in which the sample is read."""
    given = [(i, ("good line of words\n" * 600 if i % 2 else "BAD!! BAD!!\n" * 3)) for i in range(60)]
    docs = spark.createDataFrame([*given, given[3]], "doc_id long, text string").repartition(3)
    labels = spark.createDataFrame([(i, i % 2) for i, _ in given], "doc_id long, quality int")
    for part_bytes in (1 << 30, 4 << 20):
        model = quality_crf.train(docs, labels, epochs=4, part_bytes=part_bytes)
        assert model.scores([given[1][1], given[0][1]]).round().tolist() == [1, 0]
    again = quality_crf.train(docs.repartition(5), labels, epochs=4, part_bytes=4 << 20)
    assert np.allclose(again.weights, model.weights) and (again.scale, again.shift) == pytest.approx((model.scale, model.shift))


def test_quality_on_odd_tables(spark, odd, empty):
    labels = spark.createDataFrame([(1, 1), (10, 0), (10, 0), (None, 1), (3, None), (2, 7)], "doc_id long, quality int")
    for table in (labels, labels.where("false")):
        model = quality_crf.train(odd, table)
        found = rows(quality_crf.score(odd, model))
        assert len(found) == odd.count() and all(0 <= r[2] <= 1 for r in found)
        assert quality_crf.score(empty, model).count() == 0
        assert quality_crf.keep_good(odd, model).columns == odd.columns
    assert quality_crf.train(empty, labels).scores(["x"])[0] == 0.5


# Language model


def test_language_model(docs, texts):
    split = {i: maxent_lm.tokens(t) for i, t in texts.items()}
    c = Counter(w for i, t in split.items() if bucket(i, 10) for w in t)
    n, v = sum(c.values()), len(c)
    for options in ({}, {"size": 5000, "group": 3000}):
        found = maxent_lm.language_model(docs, **options).collect()
        assert len(found) == len(texts)
        for r in found:
            t = split[r.doc_id]
            assert (r.held_out, r.n_tokens, r.n_known, r.train_tokens) == (bucket(r.doc_id, 10) == 0, len(t), sum(c[w] > 0 for w in t), n)
            assert r.base_score == pytest.approx(sum(math.log10((c[w] + 0.1) / (n + 0.1 * (v + 1))) for w in t), rel=1e-9)
        held = [r for r in found if r.held_out]
        assert sum(r.score for r in held) > sum(r.base_score for r in held)


def random_model(levels, seed=0):
    """Weights at random over 500 words; and the words as (unit, key, count), with one unknown word in every cell."""
    m, rng = maxent_lm, np.random.default_rng(seed)
    leaf = rng.integers(0, m.CLASSES * m.SUBCLASSES, m.UNITS)
    leaf[rng.random(m.UNITS) < 0.5] |= m.SUBCLASSES - 1
    words = list(zip(rng.integers(0, m.UNITS, 500).tolist(), rng.integers(0, 1 << 32, 500).tolist(), rng.integers(1, 9, 500).tolist(), strict=True))
    mass, types = np.zeros(m.UNITS), np.zeros(m.UNITS)
    cell_mass, cell_types = np.zeros((2, m.CLASSES * m.DIGITS**levels))
    for unit, key, n in words:
        mass[unit] += n
        types[unit] += 1
        if leaf[unit] % m.SUBCLASSES == m.SUBCLASSES - 1:
            cell = leaf[unit] // m.SUBCLASSES
            for level in range(levels):
                cell = cell * m.DIGITS + (key >> 5 * level) % m.DIGITS
            cell_mass[cell] += n
            cell_types[cell] += 1
    model = m.fresh_model(m.Units(np.zeros(0, np.uint64), np.zeros(0, np.int64)), leaf, mass, types, levels, cell_mass, cell_types, int(mass.sum()), 500)
    for rows in (model.class_rows, model.sub_rows, model.word_rows):
        rows[:] = rng.normal(size=rows.shape)
    return model, words


@pytest.mark.parametrize("levels", [0, 1, 2])
def test_language_model_sums_to_one(levels):
    """Over all words and the unknown share of every subclass, or of every cell below the last ones."""
    m = maxent_lm
    model, words = random_model(levels)
    model.leaf = np.concatenate([model.leaf, np.arange(m.CLASSES * m.SUBCLASSES)])  # a unit that leads to each subclass
    outcomes = list(words)
    for k in range(m.CLASSES * m.SUBCLASSES):
        for key in range(m.DIGITS**levels if k % m.SUBCLASSES == m.SUBCLASSES - 1 else 1):
            outcomes.append((m.UNITS + k, key, 0))
    # Each as the third token of a document with a fixed history.
    given = np.array([x for unit, key, n in outcomes for x in ((5, 77, 1), (9, 78, 1), (unit, key, n))])
    found = m.token_scores(model, given[:, 0], given[:, 1].astype(np.uint32), given[:, 2], np.full(len(outcomes), 3), (0, 1))
    assert (10 ** found[2::3]).sum() == pytest.approx(1, abs=1e-3)


def plain_token_score(model, history, word):
    """log10 probability of a word (unit, key, count), from the weights, outcome by outcome. history: (unit, key), the last word first."""
    m = maxent_lm

    def mixed(x):
        x &= 0xFFFFFFFF
        return ((x ^ (x >> 15)) * 0xC2B2AE3D & 0xFFFFFFFF) >> 8

    def share(rows, features, bias, gold):
        z = [float(bias[k]) + sum(float(rows[f][k]) for f in features) for k in range(len(bias))]
        return z[gold] - math.log(sum(math.exp(x) for x in z))

    h = [u for u, _ in history]
    c, s = divmod(int(model.leaf[word[0]]), m.SUBCLASSES)
    pair = mixed(h[0] * 0x9E3779B1 + h[1] * 0x85EBCA77)
    log = share(model.class_rows, [h[0], m.UNITS + h[1], 2 * m.UNITS + h[2], 3 * m.UNITS + pair % (m.ROWS - 3 * m.UNITS)], model.class_bias, c)
    log += share(model.sub_rows, [mixed(h[i] * 0x9E3779B1 + c * 0x85EBCA77 + i * 0x27D4EB2F) % m.ROWS for i in (0, 1)], model.sub_bias[c], s)
    mass, types = model.mass[c * m.SUBCLASSES + s], model.types[c * m.SUBCLASSES + s]
    if s == m.SUBCLASSES - 1:
        node = c
        for level in range(model.levels):
            digit = (word[1] >> 5 * level) % m.DIGITS
            row = mixed(history[0][1] * 0x9E3779B1 + node * 0x85EBCA77 + level * 0x27D4EB2F) % m.ROWS
            log += share(model.word_rows, [row], model.word_bias[level][node], digit)
            node = node * m.DIGITS + digit
        mass, types = model.cell_mass[node], model.cell_types[node]
    return log / math.log(10) + math.log10((word[2] + 0.1) / (mass + 0.1 * (types + 1)))


@pytest.mark.parametrize("levels", [0, 1, 3])
def test_language_model_against_plain_scores(levels):
    model, words = random_model(levels, seed=levels)
    random.seed(levels)
    given = [random.choice(words) for _ in range(60)]
    counts, start = np.array([1, 2, 20, 37]), (3, 12345)
    found = maxent_lm.token_scores(model, *(np.array(x, kind) for x, kind in zip(zip(*given, strict=True), (np.int64, np.uint32, np.int64), strict=True)), counts, start)
    want, at = [], 0
    for n in counts.tolist():
        for k in range(n):
            history = [given[at + k - j][:2] if j <= k else start for j in (1, 2, 3)]
            want.append(plain_token_score(model, history, given[at + k]))
        at += n
    assert found == pytest.approx(want, abs=1e-4)


def test_language_model_scores_are_the_models(spark, docs, texts):
    """The operator's scores, word by word from the fitted weights and plain counts."""
    rows = docs.selectExpr("doc_id", "text", "pmod(crc32(CAST(CAST(doc_id AS STRING) AS BINARY)), 10) = 0 AS held_out")
    model, _ = maxent_lm.fit(rows)
    found = {r.doc_id: r.score for r in maxent_lm.language_model(docs).collect()}
    c = Counter(w for i, t in texts.items() if bucket(i, 10) for w in maxent_lm.tokens(t))
    for i in sorted(texts)[:12]:
        tokens_ = maxent_lm.tokens(texts[i])
        key, _, shape = maxent_lm._keys(tokens_)
        unit, low = model.units.of(key, shape).tolist(), maxent_lm._low(key).tolist()
        start = maxent_lm.start_of(model.units)
        total = 0.0
        for k, w in enumerate(tokens_[:300]):
            history = [(unit[k - j], low[k - j]) if j <= k else start for j in (1, 2, 3)]
            total += plain_token_score(model, history, (unit[k], low[k], c[w]))
        if len(tokens_) <= 300:
            assert found[i] == pytest.approx(total, rel=1e-3)


@pytest.mark.parametrize("rounds", [1, 2, 3])
def test_language_model_learns_from_every_position(spark, rounds):
    """Documents of eight tokens in one chunk; what follows what is only seen at position 5."""
    ids = range(4000)
    right = {i: f"a b c d x{i % 2} y{i % 2} e" for i in ids}
    held = [i for i in ids if not bucket(i, 10)]
    swapped = {10_000 + i: f"a b c d x{i % 2} y{1 - i % 2} e" for i in ids}
    swapped = {i: t for i, t in swapped.items() if not bucket(i, 10)}
    table = spark.createDataFrame([*right.items(), *swapped.items()], "doc_id long, text string").coalesce(1)
    score = {r.doc_id: r.score for r in maxent_lm.language_model(table, rounds=rounds).collect()}
    assert np.mean([score[i] for i in held]) > np.mean([score[i] for i in swapped]) + 0.05


def test_language_model_on_odd_tables(odd, empty):
    found = maxent_lm.language_model(odd).collect()
    assert len(found) == odd.count()
    assert {r.n_tokens for r in found if r.doc_id in (4, 5, 6)} == {1}
    assert all(math.isfinite(r.score) for r in found)
    assert maxent_lm.language_model(empty).count() == 0


# Exact


@pytest.mark.parametrize("name", sorted(queries.oracle_sql()))
def test_against_sql(spark, oracle, name):
    assert same(queries.queries()[name](spark, SF).toPandas(), oracle(queries.oracle_sql()[name]))


def test_exact_plan_is_native(docs):
    plan = exact_dedup.exact_dedup(docs)._jdf.queryExecution().toString()
    assert not re.search("Python|Pandas|Arrow|Cartesian|NestedLoop", plan)


def test_exact_on_odd_tables(odd, empty):
    found = exact_dedup.exact_dedup(odd).collect()
    assert len(found) == odd.count()
    by = defaultdict(list)
    for r in found:
        by[r.doc_id].append(r)
    assert by[2][0].keep_id == by[3][0].keep_id == 1 and by[1][0].group_size == 3 and by[1][0].kept and not by[3][0].kept
    assert (by[4][0].kept, by[5][0].keep_id, by[4][0].group_size) == (True, 4, 3) and by[6][0].keep_id == 6
    assert by[9][0].group_size == 2 and all(r.kept for r in by[9])
    assert sorted(r.kept for r in by[None]) == [False, True]
    assert exact_dedup.exact_dedup(empty).count() == 0


@pytest.mark.parametrize("options", [{}, {"hot": 50, "most": 1}, {"hot": 1, "most": 10_000}])
def test_exact_with_a_hot_group(spark, options):
    """Copies of a text also with one id, or without any, whose rows must not share one salt."""
    df = spark.range(3000).selectExpr("CASE WHEN id < 1500 AND id % 3 = 0 THEN NULL ELSE id DIV 2 * 2 END AS doc_id", "CASE WHEN id % 3 = 0 THEN 'same  text' WHEN id % 3 = 1 THEN 'other' ELSE concat('t', id) END AS text").repartition(5)
    found = exact_dedup.exact_dedup(df, **options)
    by = {r.text_sha256: (r.keep_id, r.group_size, r["count"]) for r in found.groupBy("text_sha256", "keep_id", "group_size").count().collect()}
    assert by[sha("same text")] == (1500, 1000, 1000) and by[sha("other")] == (0, 1000, 1000) and len(by) == 1002
    assert found.where("kept").count() >= 1002


# Repeats


def plain_repeats(ordered, window, split, key, glue):
    first, out = set(), []
    for i, t in ordered:
        symbols = split(t or "")
        keys, gone = [key(x) for x in symbols], [False] * len(symbols)
        for p in range(len(symbols) - window + 1):
            w = tuple(keys[p : p + window])
            if w in first:
                gone[p : p + window] = [True] * window
            first.add(w)
        out.append((i, len(symbols), sum(gone), glue.join(s for s, g in zip(symbols, gone, strict=True) if not g)))
    return out


@pytest.mark.parametrize("options", [{}, {"size": 4000, "group": 3000}])
def test_substrings(docs, texts, options):
    want = plain_repeats(sorted(texts.items()), 20, lambda t: t.encode().split(), bytes, b" ")
    found = substring_dedup.substring_dedup(docs, **options).collect()
    assert {r.doc_id: (r.n_words, r.n_removed, r.kept_sha256) for r in found} == {i: (n, g, sha(t)) for i, n, g, t in want}


@pytest.mark.parametrize("seed", range(3))
def test_short_windows_on_random_words(spark, seed):
    random.seed(seed)
    given = [(i, " ".join(random.choice("ab") for _ in range(random.randint(0, 25)))) for i in range(40)]
    df = spark.createDataFrame(given, "doc_id long, text string").repartition(3)
    want = plain_repeats(given, 4, lambda t: t.encode().split(), bytes, b" ")
    found = substring_dedup.substring_dedup(df, window=4, size=60, group=50).collect()
    assert {r.doc_id: (r.n_words, r.n_removed, r.text.encode()) for r in found} == {i: (n, g, t) for i, n, g, t in want}


@pytest.mark.parametrize("seed", range(20))
def test_internal_nodes(seed):
    """Against all word sequences that go on in two ways, or end, among the sorted suffixes."""
    random.seed(seed)
    suffixes = sorted([random.choice([b"a", b"b", b"c"]) for _ in range(random.randint(1, 7))] for _ in range(random.randint(1, 30)))
    want = set()
    for a, b in itertools.pairwise(suffixes):
        depth = suffix_trees.common_prefix(a, b)
        if depth:
            below = [k for k, s in enumerate(suffixes) if s[:depth] == a[:depth]]
            want.add((depth, below[0], below[-1] + 1))
    found = list(suffix_trees.internal_nodes(suffixes))
    assert len(found) == len(set(found)) and set(found) == want
    assert set(suffix_trees.internal_nodes(suffixes, 3)) == {x for x in want if x[0] >= 3}


def test_hot_prefixes_are_lengthened(spark):
    """A common opening of eight words, with other words after it: its group is split until each part fits."""
    opening = " ".join(f"o{k}" for k in range(8))
    given = [(i, f"{opening} " + " ".join(f"x{i}y{k}" for k in range(14))) for i in range(1500)]
    df = spark.createDataFrame(given, "doc_id long, text string").repartition(3)
    table = repeats.chunks(df, repeats.WORDS, "doc_id", "text", 5000)
    how = repeats.plan(table, repeats.WORDS, 100)
    assert len(how.longer) >= 3
    loads = {r.grp: r.n for r in repeats._loads(table, repeats.WORDS, how, None).collect()}
    assert sum(loads.values()) == 1500 * 3 and max(loads.values()) <= 200
    want = plain_repeats([*given, (2000, given[7][1])], 20, lambda t: t.encode().split(), bytes, b" ")
    more = df.unionByName(spark.createDataFrame([(2000, given[7][1])], df.schema))
    found = substring_dedup.substring_dedup(more, size=5000, group=100).collect()
    assert {r.doc_id: (r.n_words, r.n_removed, r.text.encode()) for r in found} == {i: (n, g, t) for i, n, g, t in want}


def test_one_document_of_many_lines(spark):
    given = [(1, "\n".join(f"l{k % 70_000}" for k in range(150_000))), (2, "\n".join(f"l{k}" for k in range(69_990, 70_010)))]
    df = spark.createDataFrame(given, "doc_id long, text string")
    want = plain_repeats(given, 3, lambda t: t.encode().split(b"\n"), bytes.strip, b"\n")
    found = line_dedup.line_dedup(df).collect()
    assert {r.doc_id: (r.n_lines, r.n_removed, sha(r.text)) for r in found} == {i: (n, g, sha(t)) for i, n, g, t in want}


def test_string_ids(spark):
    given = [("b", "x y z x y z"), ("a", "x y z q"), ("c", "x y z")]
    df = spark.createDataFrame(given, "doc_id string, text string").repartition(2)
    want = plain_repeats(sorted(given), 3, lambda t: t.encode().split(), bytes, b" ")
    found = substring_dedup.substring_dedup(df, window=3, size=3, group=2).collect()
    assert {r.doc_id: (r.n_words, r.n_removed, r.text.encode()) for r in found} == {i: (n, g, t) for i, n, g, t in want}


@pytest.mark.parametrize("options", [{}, {"size": 50, "group": 40}])
def test_lines(docs, texts, options):
    want = plain_repeats(sorted(texts.items()), 3, lambda t: t.encode().split(b"\n"), bytes.strip, b"\n")
    found = line_dedup.line_dedup(docs, **options).collect()
    assert {r.doc_id: (r.n_lines, r.n_removed, r.text.encode()) for r in found} == {i: (n, g, t) for i, n, g, t in want}


def test_repeats_on_odd_tables(odd, empty):
    found = substring_dedup.substring_dedup(odd).collect()
    assert len(found) == odd.count()
    by = {r.doc_id: r for r in found}
    assert (by[4].n_words, by[5].n_words, by[6].n_words, by[5].text) == (0, 0, 0, "")
    assert by[11].n_removed == 60_000 and by[7].n_removed == 60_000 - 977 - 19 + 19
    assert substring_dedup.substring_dedup(empty).count() == 0
    kept = line_dedup.without_repeated_lines(odd)
    assert kept.columns == odd.columns and kept.count() == odd.count()
    by = {r.doc_id: r for r in kept.collect()}
    assert by[2].text == "" and by[1].text.startswith("One") and by[2].n_chars == 0
    assert by[3].text.startswith("One  two") is True  # inner white space counts
    assert line_dedup.without_repeated_lines(empty).count() == 0


# Packing


def plain_pieces(texts, length=2048):
    import public_tokenizers
    from tokenizers import Tokenizer

    t = Tokenizer.from_file(public_tokenizers.path("word_bpe_49k.json"))
    out = {}
    for i, text in texts.items():
        ids = [*t.encode(text or "", add_special_tokens=False).ids, 0]
        for p, start in enumerate(range(0, len(ids), length)):
            part = ids[start : start + length]
            out[i, p] = (start, len(part), zlib.crc32(np.array(part, "<u4").tobytes()))
    return out


def gapless(found, length=2048):
    by = defaultdict(list)
    for r in found:
        by[r.sequence_id].append((r.offset, r.length))
    for parts in by.values():
        at = 0
        for offset, size in sorted(parts):
            assert offset == at
            at += size
        assert at <= length
    return len(by)


def test_packing(docs, texts):
    found = packing.pack(docs.coalesce(1)).collect()
    want = plain_pieces(texts)
    assert {(r.doc_id, r.piece): (r.start, r.length, r.ids_crc32) for r in found} == want
    assert gapless(found) <= math.ceil(sum(x[1] for x in want.values()) / 2048) + 2
    assert gapless(packing.pack(docs).collect()) <= math.ceil(sum(x[1] for x in want.values()) / 2048) * 1.1 + 4


def test_best_fit_is_bounded():
    random.seed(0)
    packer, free, opened = packing.BestFit(100, 5), {}, 0
    for _ in range(3000):
        size = random.randint(1, 100)
        fits = [f for f in free.values() if f >= size]
        which, offset = packer.place(size)
        if fits:
            assert free[which] == min(fits)
        else:
            if len(free) == 5:
                fullest = min(free.values())
                free.pop(next(b for b, f in free.items() if f == fullest and b not in {x for s in packer.by_free for x in s} | {which}))
            free[which] = 100
            opened += 1
        assert offset == 100 - free[which]
        free[which] -= size
        if not free[which]:
            del free[which]
        assert packer.open == len(free) <= 5
    assert packer.opened == opened


ODD_WORDS = ["á b c d", "x<|startoftext|>y <|endoftext|>", "ΣΑΣ σας İI ǅ", "'s don't I'LL we've'd", "\x85\x1c\x00 a\x0bb", "日本語 ١٢٣ ½ ẹ́", "a\ńb", " ̈x", "한글 한", "é b　c", "a1b22 ...!?x", "​ ﻿", "ǆ Ǳ ŉ"]


@pytest.mark.parametrize("text", ODD_WORDS)
def test_tokenizer_on_odd_words(text):
    assert {k: v for k, v in plain_pieces({0: text}).items()}[0, 0][2] == zlib.crc32(np.append(tokens.tokenizer().many([text])[0], 0).astype("<u4").tobytes())


def test_tokenizer_on_random_text():
    from hypothesis import given, settings
    from hypothesis import strategies as st

    @settings(max_examples=300, deadline=None)
    @given(st.text(st.characters(codec="utf-8"), max_size=40))
    def check(text):
        part = plain_pieces({0: text})[0, 0]
        assert part[2] == zlib.crc32(np.append(tokens.tokenizer().many([text])[0], 0).astype("<u4").tobytes())

    check()


@pytest.mark.parametrize("word", ["a" * 60_000, "aB1," * 20_000, "é日" * 9_000, "x" * 65, "<|" * 3_000])
def test_long_words(word):
    """Words of many kilobytes: the vocabulary's own ids, and nothing kept of them."""
    t = tokens.tokenizer()
    text = f"one {word} two {word}"
    assert plain_pieces({0: text}, 1 << 30)[0, 0][2] == zlib.crc32(np.append(t.many([text])[0], 0).astype("<u4").tobytes())
    assert max(map(len, t.words)) <= tokens.LONG and max(map(len, t.parts)) <= tokens.LONG


def test_token_caches_start_anew():
    t = tokens.tokenizer()
    small = tokens.WordTokenizer.__new__(tokens.WordTokenizer)
    small.__dict__ = t.__dict__ | {"words": {}, "older": {}, "parts": {}, "limit": 3}
    for text in ("a b c d e", "a b", "c d e f g h"):
        assert (small.many([text])[0] == t.many([text])[0]).all()


def test_packing_on_odd_tables(odd, empty):
    found = packing.pack(odd, with_ids=True).collect()
    gapless(found)
    assert Counter(r.doc_id for r in found if r.piece == 0) == Counter(r.doc_id for r in odd.select("doc_id").collect())
    assert {r.length for r in found if r.doc_id in (4, 5, 6)} == {1}
    assert all(len(r.ids) == r.length and zlib.crc32(np.array(r.ids, "<u4").tobytes()) == r.ids_crc32 for r in found)
    assert packing.pack(empty).count() == 0


# Decontamination


def plain_hits(words, items, window=13):
    hit, names = set(), set()
    for name, item in items:
        parts = [item] if 0 < len(item) < window else [item[k : k + window] for k in range(len(item) - window + 1)]
        for part in parts:
            for i in range(len(words) - len(part) + 1):
                if part and words[i : i + len(part)] == part:
                    hit.update(range(i, i + len(part)))
                    names.add(name)
    return hit, names


@pytest.mark.parametrize("seed", range(200))
def test_automaton_on_random_words(seed):
    random.seed(seed)
    window, letters = random.choice([2, 3, 4, 13]), [b"a", b"b", b"c", b"d"][: random.randint(1, 4)]
    items = [(str(i), [random.choice(letters) for _ in range(random.randint(0, 9 if window < 13 else 20))]) for i in range(random.randint(0, 5))]
    words = [random.choice([*letters, b"x"]) for _ in range(random.randint(0, 40))]
    automaton = decontaminate.Automaton(items, window)
    spans, found = automaton.spans(words)
    hit, names = plain_hits(words, items, window)
    assert ({k for s, e in spans for k in range(s, e)}, {automaton.names[i] for i in found}) == (hit, names)


@pytest.mark.parametrize(("most", "at_once"), [(10**6, 8), (300, 100), (300, 2)])
def test_contamination(spark, docs, texts, most, at_once):
    bench = spark.read.parquet(f"{SF}/benchmark.parquet")
    norm = lambda t: re.findall(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in t or ""))
    items = [(str(r.item_id), norm(r.text)) for r in bench.collect()]
    found = decontaminate.decontaminate(docs, bench, most_words=most, most=at_once).collect()
    assert any(r.contaminated for r in found)
    for r in found:
        words = norm(texts[r.doc_id])
        hit, names = plain_hits(words, items)
        assert (r.n_words, r.n_hit, r.n_items, r.items_sha256) == (len(words), len(hit), len(names), sha(",".join(sorted(names))))
        assert r.contaminated == (len(hit) > 0 and 20 * len(hit) >= len(words))


@pytest.mark.parametrize(("most", "at_once"), [(10**6, 8), (20, 8), (20, 1)])
def test_hit_spans_are_cut(spark, most, at_once):
    """Below the coverage limit too; also spans that meet after a cut, and never short items."""
    item, other = " ".join(f"w{k}" for k in range(20)), " ".join(f"v{k}" for k in range(16))
    bench = spark.createDataFrame([(1, item), (2, other), (3, "short one")], "item_id long, text string")
    rest = " ".join(f"x{k}" for k in range(2000))
    half = other.split()
    texts = {
        1: f"{rest}. {item.upper()}! {rest}",
        2: f"{rest} é {' '.join(half[:8])}, {item}; {' '.join(half[8:])} {rest}",
        3: f"{rest} short one {rest}",
        4: f"a {item} b",
        5: f"{item}\n{rest}",
        6: None,
    }
    table = spark.createDataFrame([(i, t, len(t or "")) for i, t in texts.items()], "doc_id long, text string, n_chars long")
    left = {r.doc_id: (r.text, r.n_chars) for r in decontaminate.drop_contaminated(table, bench, most_words=most, most=at_once).collect()}
    want = {1: f"{rest}. ! {rest}", 2: f"{rest} é  {rest}", 3: texts[3], 5: f"\n{rest}", 6: None}
    assert left == {i: (t, len(t or "")) for i, t in want.items()}
    again = decontaminate.decontaminate(spark.createDataFrame([(i, t) for i, (t, _) in left.items()], "doc_id long, text string"), bench)
    assert {r.doc_id: r.n_hit for r in again.collect()} == {1: 0, 2: 0, 3: 2, 5: 0, 6: 0}


def test_contamination_on_odd_tables(spark, odd, empty):
    bench = spark.createDataFrame(BENCH, "item_id long, text string")
    found = decontaminate.decontaminate(odd, bench).collect()
    assert len(found) == odd.count()
    assert {r.doc_id for r in found if r.contaminated} == {None}
    kept = decontaminate.drop_contaminated(odd, bench)
    assert kept.columns == odd.columns and kept.count() == odd.count() - 1
    assert decontaminate.decontaminate(empty, bench).count() == 0
    assert decontaminate.drop_contaminated(odd, bench.where("false")).count() == odd.count()


# Chats


@pytest.mark.parametrize("seed", range(100))
def test_windows_read_back(seed):
    """With made-up sizes, and with pieces counted by character."""
    random.seed(seed)
    bits = ["\\", "<|", "</s>", "[INST]", "a", "\n", "|>", "<", "<|end|>\n", "[", "\\<|", "é"]
    said = [(random.choice(["system", "user", "assistant", "assistant", "x<|"]), "".join(random.choice(bits) for _ in range(random.randint(0, 6) if k % 5 else 60))) for k in range(random.randint(0, 14))]
    given = [chat.Turn(*x, random.randint(1, 30)) for x in said]
    by_char = chat.Sizes(lambda texts: [len(t) for t in texts])
    for turns, budget, history, sizes in ((given, random.choice([30, 40, 60]), random.choice([0, 10, 20]), None), (list(by_char.turns(said)), random.choice([150, 300]), random.choice([0, 60]), by_char)):
        made = list(chat.windows(turns, budget, history, sizes))
        back, loss = [], []
        for w in made:
            system = [t for t in w.again if t.role == "system"]
            assert sum(t.size for t in w.again if t not in system) <= history
            text, spans = chat.render(w)
            if sizes:
                assert len(text) <= budget
            else:
                assert len(w.new) == 1 or sum(t.size for t in w.again + w.new) <= budget
            parsed = list(chat.parse(text))
            assert [(r, t) for _, r, t in parsed] == [(t.role, t.text) for t in w.again + w.new]
            for m, r, t in parsed:
                if m == "start":
                    back.append((r, t))
                elif m == "more":
                    back[-1] = (r, back[-1][1] + t)
            loss += [chat.unescape(text[s:e]) for s, e in spans]
        assert back == said
        assert "".join(loss) == "".join(t for r, t in said if r == "assistant")


@pytest.mark.parametrize("seed", range(6))
def test_windows_keep_the_token_budget(seed):
    """Every rendered window, through the tokenizer itself."""
    import public_tokenizers
    from tokenizers import Tokenizer

    whole = Tokenizer.from_file(public_tokenizers.path("word_bpe_49k.json"))
    random.seed(seed)
    words = ["hello", "world", "<|end|>", "\\", "[INST]", "é", "日本", "x" * 40, "1,234.5", "\n", "don't"]
    sizes = chat.token_sizes()
    lengths = [20] * 12 if seed == 0 else [random.choice([0, 5, 20, 200, 900, 3000]) for _ in range(25)]
    said = [("system" if k == 0 and seed % 2 else random.choice(["user", "assistant", "a <|start|> role"]), " ".join(random.choices(words, k=n))) for k, n in enumerate(lengths)]
    said.append(("user", "y<" * 20_000))  # one word of many windows
    if seed == 5:
        said.insert(0, ("system", "hello " * 5000))
    made = list(chat.windows(sizes.turns(said), sizes=sizes))
    assert len(made) > 3
    for w in made:
        text, _ = chat.render(w)
        assert len(whole.encode(text, add_special_tokens=False).ids) <= chat.BUDGET
    if seed == 0:  # full windows, not just small ones
        assert any(sum(t.size for t in w.again + w.new) > chat.BUDGET * 0.9 for w in made)


def test_chats(spark):
    turns = spark.read.parquet(f"{SF}/conversations.parquet").collect()
    by = defaultdict(list)
    for r in sorted(turns, key=lambda r: (r.conv_id, r.turn)):
        by[r.conv_id].append((r.role, r.text or ""))
    by[-7] = [("user", queries.CONTROL), ("assistant", queries.CONTROL)]
    found = queries.op7_chat_windows(spark, SF).collect()
    assert len(found) == len(by)
    for r in found:
        said = "".join(t for role, t in by[r.conv_id] if role == "assistant")
        assert (r.n_turns, r.turns_sha256) == (len(by[r.conv_id]), sha("".join(f"{a}\n{b}\n" for a, b in by[r.conv_id])))
        assert (r.loss_chars, r.loss_sha256) == (len(said), sha(said)) and r.formatted_chars > len(said)


def test_chats_on_odd_tables(spark):
    given = [(1, 2, "assistant", None, "x"), (1, None, "user", "first", None), (None, 1, None, "lost", "y"), (1, 2, "assistant", None, "x"), (2, 1, "assistant", "z " * 5000, None)]
    df = spark.createDataFrame(given, "conv_id long, turn long, role string, text string, window string")
    made = chat.format_chats(df)
    found = {r.conv_id: r for r in chat.read_back(made).collect()}
    assert {k: r.n_turns for k, r in found.items()} == {1: 3, None: 1, 2: 1}
    assert found[1].turns_sha256 == sha("user\nfirst\nassistant\n\nassistant\n\n") and found[2].loss_chars == 10_000
    assert chat.read_back(chat.format_chats(df.where("false"))).count() == 0


# SimHash


def plain_fingerprint(text):
    import xxhash

    words = re.findall(r"[^\x20\x09-\x0D]+", "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text or ""))
    shingles = [" ".join(words[k : k + 3]) for k in range(len(words) - 2)] if len(words) >= 3 else [" ".join(words)] if words else []
    h = [xxhash.xxh64_intdigest(s.encode(), 42) for s in shingles]
    return sum(1 << b for b in range(64) if 2 * sum(x >> b & 1 for x in h) > len(h))


def plain_components(ids, fps):
    label = dict(zip(ids, ids, strict=True))
    changed = True
    while changed:
        changed = False
        for (a, x), (b, y) in itertools.combinations(zip(ids, fps, strict=True), 2):
            if (x ^ y).bit_count() <= 3 and label[a] != label[b]:
                label[a] = label[b] = min(label[a], label[b])
                changed = True
    return label


def test_simhash(docs, texts):
    found = simhash.near_duplicates(docs).collect()
    fps = {i: plain_fingerprint(t) for i, t in texts.items()}
    assert {r.doc_id: r.fingerprint for r in found} == {i: f"{x:016x}" for i, x in fps.items()}
    assert {r.doc_id: r.component_id for r in found} == plain_components(list(fps), list(fps.values()))


def test_fingerprint_of_a_very_long_text():
    text = " ".join(f"W{k % 997} w{k}" for k in range(60_000))
    assert simhash.fingerprint(text) == plain_fingerprint(text)


@pytest.mark.parametrize("seed", range(4))
def test_ball_hashing(seed):
    rng = np.random.default_rng(seed)
    values = [int(x) for x in rng.integers(0, 2**63, 15)]
    for _ in range(150):
        x = values[rng.integers(len(values))]
        for b in rng.choice(64, rng.integers(1, 5), replace=False):
            x ^= 1 << int(b)
        values.append(x)
    v = np.unique(np.array(values, np.uint64))
    by = defaultdict(list)
    for k in range(0, len(v), 40):
        for part, a, b in simhash._emit(v[k : k + 40], 62):
            by[part].append((a, b))
    left, right = (np.concatenate(x) for x in zip(*(simhash.forest(*simhash._matches(p)) for p in by.values()), strict=True))
    every = np.nonzero(np.bitwise_count(v[:, None] ^ v[None]) <= 3)
    want = simhash.forest(v[every[0]], v[every[1]])
    got = simhash.forest(left, right)
    assert dict(zip(got[1].tolist(), got[0].tolist(), strict=True)) == dict(zip(want[1].tolist(), want[0].tolist(), strict=True))


def test_components_of_a_chain(spark):
    df = spark.range(200).selectExpr("id AS i", "id + 1 AS j")
    found = simhash.stars(df).collect()
    assert sorted(r.a for r in found) == list(range(1, 201)) and {r.b for r in found} == {0}


def test_simhash_on_odd_tables(odd, empty):
    found = simhash.near_duplicates(odd).collect()
    assert len(found) == odd.count()
    by = {r.doc_id: r for r in found if r.doc_id is not None}
    assert by[4].fingerprint == "0" * 16 and by[5].component_id == by[6].component_id == 4
    assert by[2].component_id == by[3].component_id == 1
    kept = simhash.one_of_each(odd)
    assert kept.columns == odd.columns
    assert not {2, 3, 5, 6} & {r.doc_id for r in kept.collect()}
    assert simhash.near_duplicates(empty).count() == 0


# Personal data

BASE = {"email": r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+", "ip": r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)", "card": r"[0-9]([\x20-]?[0-9])+", "phone": r"\+[0-9][\x20().0-9-]+[0-9]"}


def plain_pii(text):
    out = []
    for rank, (kind, pattern) in enumerate(BASE.items()):
        for m in re.finditer(pattern, text):
            digits = re.sub(r"[^0-9]", "", m[0])
            good = {"email": True, "ip": all(int(p) <= 255 for p in m[0].split(".")) if kind == "ip" else False, "card": 14 <= len(digits) <= 19 and pii.luhn(digits), "phone": 10 <= len(digits) <= 15}[kind]
            if good:
                out.append((m.start(), rank, m.end(), kind))
    return ",".join(f"{k}:{s}:{e}" for s, _, e, k in sorted(out))


def base_only(spans):
    return ",".join(s for s in spans.split(",") if s.split(":")[0] in BASE)


def test_pii(docs, texts):
    for r in pii.find_pii(docs).collect():
        want = plain_pii(texts[r.doc_id])
        assert base_only(r.spans) == want and r.base_sha256 == sha(want)
        assert (r.n_email, r.n_ip, r.n_card, r.n_phone) == tuple(want.count(f"{k}:") for k in BASE)


@pytest.mark.parametrize("seed", range(300))
def test_pii_on_random_text(seed):
    random.seed(seed)
    bits = ["a", "@", ".", "1", "4111", "1111", " ", "-", "+", "(", ")", "b.c", "255", "0", "é", "://", "x:y@", "IBAN ", "@@", "%", "account 12345678", "+1 (234) 555-6789"]
    text = "".join(random.choice(bits) for _ in range(random.randint(0, 40)))
    spans = pii.joined(pii.Finder().spans(text))
    assert base_only(spans) == plain_pii(text)


def test_added_kinds():
    found = lambda t: pii.joined(pii.Finder().spans(t))
    assert found("josé@exämple.com") == "email_intl:0:16"
    assert "login:4:25" in found("see ftp://me:pw@h.example x")
    assert found("IBAN: DE89 3704 0044 0532 0130 00.") .startswith("iban:6:33") or "iban:6:33" in found("IBAN: DE89 3704 0044 0532 0130 00.")
    assert "account:12:20" in found("account no: 12345678")
    assert pii.redact("a x@y.zz b", found("a x@y.zz b")) == "a <email> b"


RUNS = [lambda n: "0" * n + "1.2.3.4", lambda n: "7" * n + ".1.1.1 1.1.1." + "0" * n + "7", lambda n: "account" + " " * n + "12345678", lambda n: "account no" + "\n" * n, lambda n: "1." * n, lambda n: "+1 (" * n + "555 123 4567", lambda n: "a@" * n + "b.c"]


@pytest.mark.parametrize("make", RUNS)
def test_pii_on_long_runs(make):
    """Runs of digits, white space and half spans: no error, the contract's base spans, and linear time."""
    text, want = make(3000), []
    for rank, (kind, pattern) in enumerate(BASE.items()):
        for m in re.finditer(pattern, text):
            digits = re.sub(r"[^0-9]", "", m[0])
            good = {"email": lambda: True, "ip": lambda m=m: all(len(p.lstrip("0")) < 4 and int(p.lstrip("0") or 0) <= 255 for p in m[0].split(".")), "card": lambda d=digits: 14 <= len(d) <= 19 and pii.luhn(d), "phone": lambda d=digits: 10 <= len(d) <= 15}[kind]()
            if good:
                want.append((m.start(), rank, m.end(), kind))
    assert base_only(pii.joined(pii.Finder().spans(text))) == ",".join(f"{k}:{s}:{e}" for s, _, e, k in sorted(want))
    began = time.perf_counter()
    pii.Finder().spans(make(300_000))
    assert time.perf_counter() - began < 10


def test_pii_on_odd_tables(odd, empty):
    found = pii.find_pii(odd).collect()
    assert len(found) == odd.count()
    by = {r.doc_id: r for r in found}
    assert (by[8].n_email, by[8].n_ip, by[8].n_card, by[8].n_phone) == (1, 1, 1, 1) and by[5].spans == ""
    assert pii.find_pii(empty).count() == 0


def test_lm_sums_and_shares_are_those_of_plain_formulas():
    """Segment sums by order, and softmaxes without and with logits beyond the range of exp."""
    rng = np.random.default_rng(3)
    rows = rng.normal(size=(500, 32)).astype(np.float32)
    label = np.concatenate([np.zeros(300, int), rng.integers(1, 90, 200), [90]])
    order = rng.permutation(np.concatenate([np.arange(500), [7]]))[np.argsort(label, kind="stable")]
    heads = np.flatnonzero(np.diff(np.sort(label), prepend=-1))
    sums, turn = maxent_lm._segment_sums(rows, order, heads)
    assert sorted(turn.tolist()) == list(range(len(heads)))
    for found, k in zip(sums, turn, strict=True):
        end = heads[k + 1] if k + 1 < len(heads) else len(order)
        assert np.allclose(found, rows[order[heads[k] : end]].sum(0), atol=1e-4)
    gold = rng.integers(0, 32, 40)
    for scale in (1, 30, 1000):
        table = (scale * rng.normal(size=(64, 32))).astype(np.float32)
        features = rng.integers(0, 64, (2, 40)).astype(np.uint16)
        z = table[features[0]].astype(float) + table[features[1]] + 0.5
        top = z.max(1, keepdims=True)
        want = (z - top)[np.arange(40), gold] - np.log(np.exp(z - top).sum(1))
        found = maxent_lm._log_share(maxent_lm._logits(table, features, np.full(32, 0.5, np.float32)), gold)
        assert np.isfinite(found).all() and np.allclose(found, want, rtol=1e-5, atol=1e-4)

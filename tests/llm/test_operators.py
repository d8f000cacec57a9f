"""Each operator against a brute-force version, and on null, empty, long, repeated and clashing rows."""

import hashlib
import random
from collections import Counter

import numpy as np
import public_tokenizers
import pyarrow as pa
import pytest
from pyspark.sql import functions as F
from tokenizers import Tokenizer

import corpus_pipeline
from sensorlytics.llm import (bpe, exact_dedup, line_dedup, ngram_join, packing, pitman_yor, quality_classifier,
                              quality_rules, toxicity, url_filter)
from sensorlytics.llm.common import components, fold_of, most_frequent

SCHEMA = "doc_id long, text string, lang string, source string, n_chars long"
SF01 = "/root/testdata/sf0.01"


def rand_docs(n=60, seed=1):
    """Small documents with exact and near copies, nulls, empties, a long text and a repeated row."""
    rng = random.Random(seed)
    vocab = ["w%d" % i for i in range(300)] + ["Ünï", "été", "A'll", "<|endoftext|>"]
    texts = [" ".join(rng.choices(vocab, k=rng.choice([1, 2, 4, 12, 40, 90]))) for _ in range(n)]
    for _ in range(20):
        words = rng.choice(texts).split(" ")
        if len(words) > 20 and rng.random() < 0.7:
            words[rng.randrange(len(words))] = "edited"
        texts.append(" ".join(words))
    texts += [None, "", "   \n\t ", "x\n" * 50, " ".join(rng.choices(vocab, k=30_000))]
    rows = [(i, t, "en", rng.choice(["a", "a", "b", None]), len(t or "")) for i, t in enumerate(texts)]
    return rows + [rows[3], rows[3]]


@pytest.fixture(scope="module")
def docs(spark):
    return spark.createDataFrame(rand_docs(), SCHEMA)


@pytest.fixture(scope="module")
def empty(spark):
    return spark.createDataFrame([], SCHEMA)


def by_id(df, key="doc_id"):
    return {r[key]: r for r in df.collect()}


# ------------------------------------------------------------------ op1

def test_bpe_matches_the_library(spark, docs, empty):
    tok = Tokenizer.from_file(public_tokenizers.path(bpe.TOKENIZER))
    lexicon = bpe.build_lexicon(docs, max_words=150)
    got = by_id(bpe.round_trip_digests(docs, lexicon))
    enc = by_id(bpe.decode(bpe.encode(docs, lexicon)))
    for i, text, *_ in rand_docs():
        ids = tok.encode(text or "", add_special_tokens=False).ids
        raw = np.array(ids, "<u4").tobytes()
        assert got[i].n_tokens == len(ids) and got[i].ids_sha256 == hashlib.sha256(raw).hexdigest()
        decoded = tok.decode(ids, skip_special_tokens=False)
        assert got[i].decoded_sha256 == hashlib.sha256(decoded.encode()).hexdigest()
        assert bytes(enc[i].ids) == raw and enc[i].decoded == decoded and enc[i].n_chars == len(text or "")
    assert bpe.round_trip_digests(empty, bpe.build_lexicon(empty)).count() == 0


def test_lexicon_is_minimal_and_exact():
    v = bpe.Vocabulary(public_tokenizers.path(bpe.TOKENIZER))
    words = [b" walking", b" talking", b" walked", b" talked", b"a", b"", "é".encode()]
    lex = bpe.Lexicon(bpe.compile_lexicon(words, v))
    ask = [*words, b" walk", b" walkings", b"b"]
    numbers = lex.numbers(ask)
    for w, k in zip(ask, numbers.tolist()):
        assert (k >= 0) == (w in words and w != b"")
        if k >= 0:
            assert np.frombuffer(lex.packed_ids(k), "<u4").tolist() == v.merge(w)
    # " walking|ked" and " talking|ked" share everything after their first letters
    assert len(lex.final) < len({w[:i] for w in words for i in range(len(w) + 1)})


# ------------------------------------------------------------------ op2

def test_exact_groups(spark, docs, empty):
    rows = rand_docs()
    groups = {}
    for i, t, *_ in rows:
        groups.setdefault(t or "", []).append(i)
    got = exact_dedup.exact_groups(docs).collect()
    assert len(got) == len(rows)
    text = {i: t or "" for i, t, *_ in rows}
    for r in got:
        g = groups[text[r.doc_id]]
        assert (r.keep_id, r.group_size, r.kept) == (max(g), len(g), r.doc_id == max(g))
        assert r.text_sha256 == hashlib.sha256(text[r.doc_id].encode()).hexdigest()
    assert exact_dedup.exact_groups(empty).count() == 0
    nulls = spark.createDataFrame([(None, "a"), (None, "b"), (1, "a"), (None, None)], "doc_id long, text string")
    got = {(r.doc_id, r.text_sha256[:4]): r for r in exact_dedup.exact_groups(nulls).collect()}
    assert sorted((r.keep_id, r.group_size, r.kept) for r in got.values() if r.keep_id) == [(1, 2, False), (1, 2, True)]
    assert sum(r.keep_id is None and not r.kept for r in got.values()) == 2


@pytest.mark.parametrize("n", [0, 1, 2, 1000])
def test_perfect_hash(n):
    keys = np.random.default_rng(n).integers(0, 2**63, (n, 4)).astype("<u8")
    ph = exact_dedup.PerfectHash.from_bytes(exact_dedup.PerfectHash.build(keys).to_bytes())
    assert sorted(ph.slots(keys).tolist()) == list(range(n))


# ------------------------------------------------------------------ op3

def test_packing_obeys_its_rules(spark, docs, empty):
    rows = rand_docs()
    got = packing.pack(docs, capacity=64, block_docs=20).collect()
    source, words = {i: s for i, _, _, s, _ in rows}, {i: len((t or "").encode().split()) for i, t, *_ in rows}
    norm = {i: (t or "").lower().split() for i, t, *_ in rows}
    total, bins = Counter(), {}
    for r in got:
        total[r.doc_id] += r.n_words
        if r.bin_id is not None:
            bins.setdefault(r.bin_id, []).append(r)
    copies = Counter(i for i, *_ in rows)
    assert all(total[i] == words[i] * copies[i] for i in words)
    for b in bins.values():
        assert sum(r.n_words for r in b) == b[0].bin_words <= 64 and len(b) == b[0].bin_docs
        assert len({source[r.doc_id] for r in b}) == len(b)
        assert len({tuple(norm[r.doc_id]) for r in b}) == len(b)
    assert all(r.bin_id is None for r in got if r.n_words == 0)
    assert packing.pack(empty).count() == 0


def test_packing_takes_the_tightest_compatible_bin():
    rng = random.Random(4)
    for _ in range(50):
        items = sorted(((rng.randint(1, 30), rng.randint(0, 3), rng.randint(0, 5)) for _ in range(40)), reverse=True)
        at, _ = packing.pack_block(*zip(*items), capacity=40)
        state = []  # brute force over all bins
        for (size, s, c), b in zip(items, at):
            fit = [i for i, (w, ss, cc) in enumerate(state) if w + size <= 40 and s not in ss and c not in cc]
            if fit:
                assert state[b][0] == max(state[i][0] for i in fit) and b in fit
            else:
                assert b == len(state)
                state.append([0, set(), set()])
            state[b][0] += size
            state[b][1].add(s)
            state[b][2].add(c)


# ------------------------------------------------------------------ op4, op10

def test_quality_held_out(spark):
    p = quality_classifier.op4_quality_classifier(spark, SF01).join(
        spark.read.parquet(f"{SF01}/labels.parquet"), "doc_id").where("held_out").toPandas()
    assert (p.predicted == p.quality).mean() > 0.9 and p.score.between(0, 1).all()


def test_toxicity_held_out(spark):
    p = toxicity.op10_toxicity(spark, SF01).join(
        spark.read.parquet(f"{SF01}/labels.parquet"), "doc_id").where("held_out").toPandas()
    assert (p.predicted == p.toxic).mean() > 0.85 and p.score.between(0, 1).all()


def test_classifiers_on_odd_tables(spark, docs, empty):
    none = spark.createDataFrame([(1, None, None), (None, 1, 1)], "doc_id long, quality int, toxic int")
    for d in (docs, empty):
        rows = quality_classifier.feature_table(d)
        scored = quality_classifier.score_table(rows, quality_classifier.train(rows, none))
        assert scored.count() == d.count() and scored.where("score <> 0.5").count() == 0
        out = toxicity.score(d, toxicity.fit(d, none))
        assert out.count() == d.count() and "text" not in out.columns and out.where("score <> 0").count() == 0


def test_prior_estimate():
    rng = np.random.default_rng(0)
    good, bad = rng.normal(1, 1, (4000, 25)), rng.normal(-2, 1, (6000, 25))
    x_u = np.concatenate([rng.normal(1, 1, (4000, 25)), bad[:2000]])
    model = quality_classifier.fit(good.astype(np.float32), x_u.astype(np.float32))
    assert abs(model.prior - 2 / 3) < 0.08
    assert (model.score(bad[2000:]) < 0.5).mean() > 0.95 and (model.score(good) >= 0.5).mean() > 0.9


# ------------------------------------------------------------------ op5

def plain_distance(a, b):
    row = list(range(len(b) + 1))
    for i, x in enumerate(a, 1):
        last, row[0] = row[0], i
        for j, y in enumerate(b, 1):
            last, row[j] = row[j], min(row[j] + 1, row[j - 1] + 1, last + (x != y))
    return row[-1]


def test_edit_distance():
    rng = random.Random(2)
    for _ in range(300):
        a, b = ([rng.choice("abc") for _ in range(rng.randint(0, 14))] for _ in range(2))
        assert line_dedup.levenshtein(a, b) == plain_distance(a, b)
        if a and b:
            want = plain_distance(a, b) <= int(0.1 * max(len(a), len(b)) + 1e-9)
            assert line_dedup.similar(line_dedup.Line(" ".join(a)), line_dedup.Line(" ".join(b))) == want


def test_lines_are_verified_by_characters():
    """A short line with a wrong letter is similar; one with another word of nine is not."""
    rng = random.Random(8)
    for _ in range(300):
        a = "".join(rng.choice("abc ") for _ in range(rng.randint(1, 40)))
        b = "".join(c if rng.random() > 0.08 else rng.choice("abc") for c in a)[rng.randint(0, 2):]
        want = plain_distance(a, b) <= int(0.1 * max(len(a), len(b)) + 1e-9)
        assert line_dedup.similar(line_dedup.Letters(a), line_dedup.Letters(b)) == want
    line = "please enter your password again in the field below"
    lines = [line, line.replace("password", "passwort"), line.replace("password", "telephone number")]
    tile = pa.table({"id": [1, 2, 3], "words": lines, "side": [2, 2, 2], "simhash": pa.array([0, 0, 0], pa.int64())})
    assert line_dedup.verify_tile(tile) == [(1, 2)]
    for longer in range(1, 3000):
        assert line_dedup.band(longer) - line_dedup.band(longer - int(0.1 * longer + 1e-9)) in (0, 1)


def test_lines_are_kept_once(spark, empty):
    long = " ".join(f"word{i}" for i in range(400))
    edited = long.replace("word7 ", "other ")
    rows = [(1, f"first own line of one\n{long}", "en", "a", 0), (2, f"{long.upper()}\nsecond own line of two", "en", "a", 0),
            (3, f"{edited}!\nok", "en", "a", 0), (4, "ok", "en", "a", 0), (5, None, "en", "a", 0), (6, "", "en", "a", 0),
            (7, long, "en", "a", 0), (7, long, "en", "a", 0), (None, long, "en", "a", 0)]
    docs = spark.createDataFrame(rows, SCHEMA)
    few = line_dedup.MIN_WORDS  # leaves the short lines alone
    got = line_dedup.dedup_lines(docs, least_words=few).collect()
    assert len(got) == len(rows)
    text = {r.doc_id: r.text for r in got}
    assert text[1] == rows[0][1] and text[2] == "second own line of two" and text[4] == "ok"
    assert text[5] is None and text[6] == "" and text[7] == "" and text[None] == ""
    near = line_dedup.hashed_lines([x.encode() for x in (long, edited)])[3].view(np.uint64)
    if np.bitwise_count(near[0] ^ near[1]) <= line_dedup.MAX_BITS:
        assert text[3] == "ok"
    left = {r.doc_id for r in line_dedup.dedup_lines(docs, drop_emptied=True, least_words=few).collect()}
    assert left >= {1, 2, 3, 4, 5, 6} and 7 not in left
    text = {r.doc_id: r.text for r in line_dedup.dedup_lines(docs).collect()}  # by default lines of any length are equal
    assert text[1] == rows[0][1] and text[3].endswith("ok") and text[4] == "" and text[5] is None and text[6] == ""
    assert line_dedup.dedup_lines(empty).count() == 0


def test_hashed_lines_against_plain_lines():
    """Same lines and numbers as splitting each text; one name per normalised line; bits by majority."""
    rng = random.Random(5)
    texts = [x.encode() for x in (
        "", "a b c d e", "A-b 12 cc\td e\r\nx", "\n\n", "one two three four five\n", "z" * 100 + " q w e r t",
        "\x0ba\x0cb c d e f", " ".join(str(rng.random()) for _ in range(3000)), "\u00e9 \u00fc \u00f1 a b c\nA b, C d. e")]
    plain = [(i, k, b" ".join(w)) for i, t in enumerate(texts) for k, x in enumerate(t.split(b"\n"))
             if len(w := line_dedup.normalised(x)) >= line_dedup.MIN_WORDS]
    row, number, names, hashes = line_dedup.hashed_lines(texts)
    assert [(i, k) for i, k, _ in plain] == list(zip(row.tolist(), number.tolist()))
    seen = {}
    for (_, _, line), name, h in zip(plain, names.tolist(), hashes.tolist()):
        assert seen.setdefault(line, (name, h)) == (name, h)
        words, data = line.split(), np.frombuffer(line, np.uint8)
        at = np.cumsum([0] + [len(w) + 1 for w in words[:-1]])
        own = line_dedup.word_hashes(data, at, np.array([len(w) for w in words]))
        count = np.array([len(w) > 3 for w in words])
        own = own[count] if count.sum() >= line_dedup.MIN_WORDS else own
        ones = np.unpackbits(own.view(np.uint8).reshape(-1, 8), axis=1).sum(axis=0, dtype=int)
        assert np.packbits(ones * 2 > len(own)).view(np.int64)[0] == h
    assert len({name for name, _ in seen.values()}) == len(seen)
    assert all(len(x) == 0 for x in line_dedup.hashed_lines([b""]))


def test_lines_of_any_length_are_kept_once(spark, tmp_path):
    """The query cuts equal lines of few words, of one long word and of marks only; blank lines stay."""
    han = "\u5929\u5730\u7384\u9ec4\u5b87\u5b99\u6d2a\u8352\u65e5\u6708\u76c8\u6603"
    rows = [(1, f"Read more\n\nown line\n{han}", "en", "a", 0), (2, f"read  more!\n\n{han}\nanother", "en", "a", 0),
            (3, "-----\nok", "en", "a", 0), (4, "ok\n \n-----\n*****", "en", "a", 0)]
    spark.createDataFrame(rows, SCHEMA).write.parquet(f"{tmp_path}/documents.parquet")
    got = by_id(line_dedup.op5_line_dedup(spark, str(tmp_path)))
    assert got[1].text == rows[0][1] and got[2].text == "\nanother" and got[2].n_removed == 2
    assert got[3].text == rows[2][1] and got[4].text == " \n*****" and got[4].n_removed == 2
    left = corpus_pipeline.line_stage(spark, spark.createDataFrame([*rows, (5, "OK", "en", "a", 2)], SCHEMA), "")
    assert {r.doc_id for r in left.collect()} == {1, 2, 3, 4}


def test_an_edited_line_is_cut(spark):
    """End to end, without a condition: of the lines with one changed word the near ones go, and some are near."""
    long = " ".join(f"word{i}" for i in range(400))
    edited = [long.replace(f"word{i} ", "other ") for i in range(10, 18)]
    bits = line_dedup.hashed_lines([x.encode() for x in (long, *edited)])[3].view(np.uint64)
    near = (np.bitwise_count(bits[1:] ^ bits[0]) <= line_dedup.MAX_BITS).tolist()
    rows = [(0, long, "en", "a", 0), *((i, x, "en", "a", 0) for i, x in enumerate(edited, 1))]
    text = {r.doc_id: r.text for r in line_dedup.dedup_lines(spark.createDataFrame(rows, SCHEMA)).collect()}
    assert sum(near) >= 4 and text[0] == long and all(text[i] == "" for i, x in enumerate(near, 1) if x)


def test_near_hashes_finds_all_pairs(spark):
    rng = np.random.default_rng(3)
    base = rng.integers(0, 2**63, 200).astype(np.uint64)
    flips = np.array([sum(1 << int(b) for b in rng.choice(64, 3, replace=False)) for _ in base], np.uint64)
    all_ = np.unique(np.concatenate([base, base ^ flips])).view(np.int64)
    df = spark.createDataFrame([(int(x),) for x in all_], "simhash long")
    for blocks in (5, 6):
        comp = {r.id: r.comp for r in components(line_dedup.near_hashes(df, blocks)).collect()}
        for a, b in zip(base.view(np.int64).tolist(), (base ^ flips).view(np.int64).tolist()):
            assert comp[a] == comp[b]


# ------------------------------------------------------------------ op6

def test_language_model(spark, docs, empty):
    d = docs.where("doc_id IS NOT NULL")
    model, counts = pitman_yor.fit(d.where("doc_id % 4 <> 0").selectExpr("doc_id", "coalesce(text, '') AS text"), 2, 2)
    train = [((t or "").encode().lower().split()) for i, t, *_ in rand_docs() if i % 4]
    c = Counter(w for ws in train for w in ws)
    n, v = sum(c.values()) + len(train), len(c) + 1
    assert (model["tokens"], model["types"]) == (n, v)
    assert np.allclose((10.0 ** model["log_p"]).sum(1), 1, atol=1e-3)
    got = pitman_yor.score(docs, model, counts).collect()
    assert len(got) == docs.count()
    text = {i: (t or "").encode().lower().split() for i, t, *_ in rand_docs()}
    for r in got:
        ks = [c[w] for w in text[r.doc_id]] + [len(train)]
        assert r.n_tokens == len(ks) and r.n_known == sum(k > 0 for k in ks)
        assert r.base_score == pytest.approx(sum(np.log10((k + 1) / (n + v + 1)) for k in ks))
        assert np.isfinite(r.score) and r.score < 0
    model, counts = pitman_yor.fit(empty.select("doc_id", "text"), 1, 1)
    assert np.isfinite([r.score for r in pitman_yor.score(docs, model, counts).collect()]).all()


def test_seating_keeps_its_bounds_and_prefers_few_tables():
    rng = np.random.default_rng(5)
    n = np.array([1, 2, 5, 400, 30_000])
    t, w = np.ones(5, np.int64), np.full(5, np.nan)
    for _ in range(30):
        t, w = pitman_yor.sweep(n, t, w, np.full(5, 0.2), 0.5, 1.0, rng)
        assert (t >= 1).all() and (t <= n).all() and t[0] == 1
    p = pitman_yor.predictive(n.astype(float), t.astype(float), np.full(5, 0.2), 0.5, 1.0)
    assert p.sum() == pytest.approx(1)


def test_language_model_has_a_restaurant_for_each_word(spark):
    """Far beyond the 1,024 most frequent words, a context still tells what follows it."""
    rng = random.Random(3)
    pairs = [(f"a{i}", f"b{i}") for i in range(2000)]
    texts = [" ".join(w for p in rng.sample(pairs, 20) for w in p) for _ in range(600)]
    train = spark.createDataFrame([(t,) for t in texts], "text string")
    model, counts = pitman_yor.fit(train, 2, 2)
    ask = [(i, f"a{i} b{i if i % 2 else i + 1}") for i in range(1200, 2000)]
    got = by_id(pitman_yor.score(spark.createDataFrame(ask, "doc_id long, text string"), model, counts))
    n = Counter(w for t in texts for w in t.split())
    often = [i for i, _ in ask if n[f"a{i}"] >= 4 and n[f"b{i + 1}"] >= 4]
    assert len(often) > 500
    right, wrong = ([got[i].score for i in often if i % 2 == k] for k in (1, 0))
    assert np.median(right) > np.median(wrong) + 2


def test_language_model_scores_are_its_seating(spark, docs):
    """Scores against the formula, from the pairs of all training texts and the seats in the model's tables."""
    d = docs.where("doc_id IS NOT NULL")
    model, counts = pitman_yor.fit(d.where("doc_id % 4 <> 0").selectExpr("coalesce(text, '') AS text"), 2, 2)
    assert 0 in model["heavy"] and len(model["heavy"]) < model["types"]
    word = {b"": 0}
    for r in counts.collect():
        word.update((w, 2 + r["key"] + i * model["buckets"]) for i, w in enumerate(pitman_yor.unpack_words(r["a"])))
    state, seats, full = (t.collect() for t in model["tables"])
    code, n = {}, {}
    for r in (r for r in state if r["kind"] == pitman_yor.STATE):
        code[r["key"]], n[r["key"]] = pitman_yor.unpack(r["b"])[0].tolist(), pitman_yor.unpack(r["a"])[2].tolist()
    seen = {(c >> 32, c & 0xFFFFFFFF): x for g in code for c, x in zip(code[g], n[g])}
    text = {i: (t or "").encode().lower().split() for i, t, *_ in rand_docs()}
    train = [w for i, t, *_ in rand_docs() if i % 4 for w in [(t or "").encode().lower().split()]]
    want = Counter((word[u], word[w]) for x in train for u, w in zip([b"", *x], [*x, b""]))
    assert seen == want
    follow = Counter()
    for (u, _), x in want.items():
        follow[u] += x
    samples = []
    for s, now in enumerate(model["taken"]):
        t = {}
        for r in (r for r in seats if r["z"] == s):
            some = iter(pitman_yor.unpack(r["a"])[0].tolist())
            t.update(((c >> 32, c & 0xFFFFFFFF), next(some) if x > 1 else 1) for c, x in zip(code[r["key"]], n[r["key"]]))
        assert t.keys() == want.keys() and all(1 <= t[p] <= want[p] for p in t)
        of = Counter()
        for (u, _), x in t.items():
            of[u] += x
        m = {}
        for r in (r for r in full if r["z"] == s):
            c = pitman_yor.unpack(r["a"])[0].tolist()
            m.update((i, c[i // model["buckets"]]) for i in word.values() if (i % model["buckets"]) == r["key"])
        assert sum(m.values()) == now["customers"]
        samples.append((now, t, of, m))

    def p(u, w):
        out = 0.0
        for now, t, of, m in samples:
            top = now["theta_top"] + now["customers"]
            base = (m[w] - now["d_top"]) / top if w in m else (now["theta_top"] + now["d_top"] * len(m)) / top
            own = max(want[u, w] - model["d"] * t[u, w], 0) if (u, w) in want else 0
            out += (own + (now["theta"] + model["d"] * of[u]) * base) / (now["theta"] + follow[u]) / len(samples)
        return out

    context = next(u for u in sorted(follow) if 1 < follow[u] < 20)
    assert sum(p(context, w) for w in word.values()) + p(context, -1) == pytest.approx(1)
    for r in pitman_yor.score(docs, model, counts).collect():
        x = [word.get(w, -1) for w in text[r.doc_id]]
        assert r.score == pytest.approx(sum(np.log10(p(u, w)) for u, w in zip([0, *x], [*x, 0])), rel=1e-5)


def test_tables_are_drawn_from_their_distribution():
    d, theta, prior, others, n = 0.4, 1.5, 0.3, 7, 4
    want = {1: 1.0}
    for j in range(1, n):
        step = Counter()
        for t, w in want.items():
            step[t] += w * (j - d * t)
            step[t + 1] += w * (theta + d * (others + t)) * prior
        want = step
    rng, size = np.random.default_rng(1), 100_000
    got = pitman_yor.draw(np.full(size, n), np.full(size, prior), np.full(size, others), d, theta, rng, pitman_yor.stirling(d))
    share = np.array([want[t] for t in range(1, n + 1)]) / sum(want.values())
    assert np.allclose(np.bincount(got, minlength=n + 1)[1:] / size, share, atol=0.01)


# ------------------------------------------------------------------ op7

@pytest.mark.parametrize("shingle,sim", [(3, (9, 10)), (5, (8, 10))])
def test_near_groups(spark, docs, empty, shingle, sim):
    rows = rand_docs()
    sets = []
    for _, t, *_ in rows:
        w = (t or "").encode().lower().split()
        sets.append({tuple(w[i:i + shingle]) for i in range(max(1, len(w) - shingle + 1))} if w else set())
    up = list(range(len(rows)))

    def root(i):
        while up[i] != i:
            i = up[i]
        return i

    links = Counter()
    for i in range(len(rows)):
        for j in range(i):
            if sets[i] and sim[1] * len(sets[i] & sets[j]) >= sim[0] * len(sets[i] | sets[j]):
                links[i] += 1
                links[j] += 1
                up[max(root(i), root(j))] = min(root(i), root(j))
    comp = {i: min(rows[j][0] for j in range(len(rows)) if root(j) == root(i)) for i in range(len(rows))}
    got = {r.doc_id: r for r in ngram_join.near_groups(docs, shingle=shingle, similarity=sim).collect()}
    for i, row in enumerate(rows):
        r = got[row[0]]
        assert (r.n_shingles, r.component_id, r.n_links) == (len(sets[i]), comp[i], links[i])
    assert ngram_join.near_groups(empty).count() == 0


@pytest.mark.parametrize("num,den", [(9, 10), (8, 10), (2, 5)])
def test_sketches_lose_no_link(num, den):
    """Linked sets, of equal or other sketch lengths, end up in one group; groups of unlike sets fall apart."""
    rng = np.random.default_rng(8)
    sets = []
    for size in (3, 40, 120, 128, 131, 500, 1020):
        base = rng.integers(0, 2**63, size).astype(np.uint64)
        sets += [base, base[: max(1, -(-size * num // den))], np.append(base[size // 20:], rng.integers(0, 2**63, size // 40).astype(np.uint64))]
    passage = sets[-1][:300]
    sets += [np.append(passage, rng.integers(0, 2**63, 700).astype(np.uint64)) for _ in range(5)]
    for sides in ([2] * len(sets), [i % 2 for i in range(len(sets))]):
        tile = pa.table({"id": list(range(len(sets))), "n": [len(s) for s in sets], "side": sides,
                         "sketch": [ngram_join.parity_sketch(s) for s in sets]})
        union = ngram_join.Union(len(sets))
        for a, b in ngram_join.join_sketches(tile, num, den):
            union.join(a, b)
        for i in range(len(sets)):
            for j in range(i):
                both = len(np.intersect1d(sets[i], sets[j]))
                if both * den >= (len(sets[i]) + len(sets[j]) - both) * num and (sides[i] == 2 or sides[i] != sides[j]):
                    assert union.root(i) == union.root(j)
        if den == 10:
            assert len({union.root(i) for i in range(len(sets) - 5, len(sets))}) == 5


def test_pigeonhole_holds():
    """Any two sets that are similar enough share a signature, whatever the allocation."""
    rng = np.random.default_rng(8)
    for num, den in ((9, 10), (8, 10)):
        for n in (9, 10, 11, 14, 19, 25, 40, 90, 300, 900):
            for _ in range(12):
                a = np.unique(rng.integers(0, 2**63, n).astype(np.uint64))
                apart = ngram_join.most_apart(len(a), len(a), num, den)
                drop = int(rng.integers(0, apart + 1))
                b = np.unique(np.concatenate([a[drop:], rng.integers(0, 2**63, max(0, apart - drop)).astype(np.uint64)]))
                shared = len(np.intersect1d(a, b))
                if 0 < len(np.setxor1d(a, b)) and den * shared >= num * (len(a) + len(b) - shared):
                    assert np.intersect1d(ngram_join.signatures(a, num, den), ngram_join.signatures(b, num, den)).size


# ------------------------------------------------------------------ op8

def test_url_filter(spark):
    urls = ["http://x.net/", "http://x.net", "https://a.example.net/en/1?q#f", "https://Example.COM/de/a", "no scheme", None, "",
            "http://b.org/fr/2", "http://b.org/en/2", "http://notnet/", "ftp://ads-track.example.com/x", "http://h#a/b"]
    rows = spark.createDataFrame(list(enumerate(urls)), "page_id int, url string")
    got = {r.page_id: (r.host, r.path, r.rule, r.verdict) for r in url_filter.url_verdicts(rows).collect()}
    assert got[0] == ("x.net", "/", "net/", "block") and got[1] == ("x.net", "", None, "allow")
    assert got[2] == ("a.example.net", "/en/1", "example.net/en/", "allow")
    assert got[3] == ("example.com", "/de/a", "example.com/de/", "block")
    assert got[4] == got[5] == got[6] == ("", "", None, "allow")
    assert got[7] == ("b.org", "/fr/2", "org/fr/", "allow") and got[8][2:] == (None, "allow") and got[9][2:] == (None, "allow")
    assert got[10][2:] == (None, "block") and got[11][:2] == ("h", "")


def test_collisions_are_checked_against_strings(spark, monkeypatch):
    monkeypatch.setattr(url_filter.xxhash, "xxh64_intdigest", lambda k: len(k))
    index = url_filter.DigestArray(url_filter.build_index([("ab/", "block"), ("cd/", "allow"), ("longer/", "block")]))
    assert index.probe([b"cd/", b"ab/", b"xy/", b"longer/"]) == [b"allow", b"block", None, b"block"]


def test_dealt_probe(spark):
    entries = spark.createDataFrame([(f"h{i}/", "block") for i in range(500)], "key string, value string")
    keys = spark.createDataFrame([(f"h{i}/",) for i in range(400, 700)] * 2 + [(None,)], "key string")
    got = url_filter.probe_dealt(keys, entries, segment_entries=50).collect()
    assert sorted(r.key for r in got) == sorted(f"h{i}/" for i in range(400, 500))


# ------------------------------------------------------------------ op9

def test_line_frequency(spark, empty):
    body = lambda i: " ".join(f"t{i}x{k}" for k in range(30))
    rows = [(i, f"{body(i)}\nThe same   line everywhere", "en", "a", 0) for i in range(40)]
    rows += [(100 + i, "the same line everywhere " * 1 + "\n" + "shared boilerplate " * 15, "en", "a", 0) for i in range(2)]
    rows += [(200, None, "en", None, 0), (201, "", "en", "a", 0), (202, "a b " * 40, "en", "b", 0), (3, rows[3][1], "en", "a", 0)]
    got = {r.doc_id: r for r in quality_rules.document_verdicts(spark.createDataFrame(rows, SCHEMA)).collect()}
    assert got[5].kept and got[5].removed_words == 4 and got[5].removed_lines == 1 and got[3].removed_words == 4
    assert got[202].base_failed and got[202].n_repeat_words == 80 and got[200].base_failed and got[201].n_words == 0
    cut = {r.doc_id: r.text for r in quality_rules.without_frequent_lines(spark.createDataFrame(rows[:40], SCHEMA)).collect()}
    assert cut[7] == body(7)
    assert quality_rules.document_verdicts(empty).count() == 0


def test_depleted_documents_are_rejected(spark):
    line = " ".join(f"boiler{k}" for k in range(30))
    rows = [(i, f"{line}\nown tail {i} of it", "en", "a", 0) for i in range(30)]
    got = quality_rules.document_verdicts(spark.createDataFrame(rows, SCHEMA)).collect()
    assert all(not r.base_failed and not r.kept and r.removed_words == 30 for r in got)


# ------------------------------------------------------------------ helpers, pipeline

def test_components(spark):
    rng = random.Random(6)
    edges = [(rng.randrange(300), rng.randrange(300)) for _ in range(200)] + [(500, k) for k in range(501, 600)]
    up = {v: v for e in edges for v in e}

    def root(x):
        while up[x] != x:
            x = up[x]
        return x

    for a, b in edges:
        up[max(root(a), root(b))] = min(root(a), root(b))
    got = {r.id: r.comp for r in components(spark.createDataFrame(edges, "a long, b long")).collect()}
    assert all(got[v] == root(v) for v in got) and set(got) == {v for a, b in edges for v in (a, b) if a != b}


def test_most_frequent(spark):
    counts = spark.createDataFrame([("a", 5), ("b", 3), ("c", 3), ("d", 1)], "w string, n long")
    assert most_frequent(counts, "w", 1) == [("a", 5)]
    assert most_frequent(counts, "w", 2) == [("a", 5)]
    assert most_frequent(counts, "w", 3) == [("a", 5), ("b", 3), ("c", 3)]


def test_pipeline_stages(spark):
    docs = corpus_pipeline.table(spark, SF01, "documents")
    for name, stage in corpus_pipeline.STAGES:
        before = {r.doc_id for r in docs.select("doc_id").collect()}
        docs = corpus_pipeline.frozen(stage(spark, docs, SF01), f"test-{name}")
        after = {r.doc_id for r in docs.select("doc_id").distinct().collect()}
        assert after <= before and len(after) > 0.8 * len(before)
        if name != "best_fit_packing":
            assert docs.columns == corpus_pipeline.COLUMNS
    assert after == before


def test_quality_groups_of_unlabelled_rows_agree_with_one(spark, monkeypatch):
    """Unlabelled rows fitted in several groups and averaged mark the held-out labels as one group does."""
    docs, labels = (spark.read.parquet(f"{SF01}/{t}.parquet") for t in ("documents", "labels"))
    rows = quality_classifier.feature_table(docs)
    held = labels.where("quality IS NOT NULL").select(F.col("doc_id").alias("id"), "quality")
    right = []
    for most in (40_000, 150):
        monkeypatch.setattr(quality_classifier, "UNLABELLED", most)
        got = quality_classifier.score_table(rows, quality_classifier.train(rows, labels)).join(held, "id").toPandas()
        got = got[[fold_of(i, 3) == quality_classifier.HELD_OUT for i in got.id]]
        right.append((got.predicted == got.quality).mean())
    assert min(right) > 0.8 and abs(right[0] - right[1]) < 0.06, right

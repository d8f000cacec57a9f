"""Rows without an id or with the same one, very long words, and copies that lose most of their lines."""

import random
import time

import numpy as np
import public_tokenizers
from tokenizers import Tokenizer

import corpus_pipeline
from sensorlytics.llm import bpe, line_dedup, packing, quality_classifier

SCHEMA = "doc_id long, text string, lang string, source string, n_chars long"


def test_long_words_merge_like_short_ones(monkeypatch):
    vocabulary = bpe.Vocabulary(public_tokenizers.path(bpe.TOKENIZER))
    rng = random.Random(7)
    words = ["".join(rng.choices(letters, k=n)).encode() for letters in ("ab", "etaoinshr", "aA1é中") for n in (1, 2, 3, 50, 399)]
    words += [b"a" * 333, b"the" * 100, b""]
    assert [vocabulary.merge_long(w) for w in words] == [vocabulary.merge(w) for w in words]
    library = Tokenizer.from_file(public_tokenizers.path(bpe.TOKENIZER))
    long = "".join(rng.choices("etaoinshrdlu", k=20_000))
    assert vocabulary.merge(long.encode()) == library.encode(long, add_special_tokens=False).ids
    start = time.process_time()
    vocabulary.merge("".join(rng.choices("etaoinshrdlu", k=1_000_000)).encode())
    assert time.process_time() - start < 60


def test_rows_without_an_id_are_packed_in_many_blocks(spark):
    rows = [(None, f"w{i} x y", "en", "s", 6) for i in range(3000)] + [(7, "a b c", "en", "t", 5)] * 1500 + [(i, "q", "en", "u", 1) for i in range(300)]
    packed = packing.pack(spark.createDataFrame(rows, SCHEMA), block_docs=200)
    plan = packed._jdf.queryExecution().optimizedPlan().toString()
    assert "block" in plan
    got = packed.collect()
    assert len(got) == len(rows) and sum(r.n_words for r in got) == sum(len(t.split()) for _, t, *_ in rows)
    assert len({r.bin_id for r in got if r.doc_id is None}) >= 15  # bins are a block's own


def near_rows():
    """Five near-equal rows, two of them without an id and two with the same; equal rows; rows without words."""
    rng = random.Random(4)
    body = [f"k{i}" for i in range(200)]

    def edited(i):
        words = list(body)
        words[-1 - i] = "edited"
        return " ".join(words)

    rows = [(None, edited(0)), (None, edited(1)), (7, edited(2)), (7, edited(3)), (9, edited(4))]
    rows += [(20, " ".join(f"z{i}" for i in range(50)))] * 3 + [(None, " ".join(f"y{i}" for i in range(50)))] * 2
    rows += [(30, None), (31, ""), (31, ""), (None, None)]
    rows += [(40 + i, " ".join(f"v{rng.randrange(10**6)}" for _ in range(30))) for i in range(5)]
    return rows


def stage_input(spark, rows):
    return spark.createDataFrame([(d, t, "en", "s", len(t or "")) for d, t in rows], SCHEMA).repartition(3)


def test_one_row_of_each_near_group_stays(spark):
    rows = near_rows()
    got = corpus_pipeline.near_duplicate_stage(spark, stage_input(spark, rows), "").collect()

    def sets(text):
        w = (text or "").split()
        return frozenset(tuple(w[i:i + 5]) for i in range(max(1, len(w) - 4))) if w else frozenset()

    # brute force: components of all pairs
    shingles = [sets(t) for _, t in rows]
    group = list(range(len(rows)))
    for i in range(len(rows)):
        for j in range(i):
            a, b = shingles[i], shingles[j]
            if a and b and 10 * len(a & b) >= 8 * len(a | b):
                old, new = group[i], group[j]
                group = [new if g == old else g for g in group]
    sizes, ids = {}, {}
    for (d, _), g, s in zip(rows, group, shingles):
        if s:
            sizes[g] = sizes.get(g, 0) + 1
            ids.setdefault(g, []).append(d)
    assert sorted(sizes.values()) == [1, 1, 1, 1, 1, 2, 3, 5]
    wordless = [(d, t) for d, t in rows if not (t or "").split()]
    with_words = [(r.doc_id, r.text) for r in got if (r.text or "").split()]
    assert len(with_words) == len(sizes) and len(got) == len(sizes) + len(wordless)
    least = [min(v, key=lambda d: (d is None, d or 0)) for v in ids.values()]
    by_id = lambda d: (d is None, d or 0)
    assert sorted((d for d, _ in with_words), key=by_id) == sorted(least, key=by_id)
    assert corpus_pipeline.near_duplicate_stage(spark, stage_input(spark, rows).limit(0), "").count() == 0


def test_documents_are_judged_row_by_row(spark, monkeypatch):
    rows = [(None, "good text"), (None, "bad"), (5, "bad"), (5, "good text"), (6, None), (6, " \n"), (8, "good text")]

    at = quality_classifier.FEATURES.index("log_words")
    one, two = (quality_classifier.features(t)[at] for t in (b"bad", b"good text"))
    model = quality_classifier.Model([np.array([(one + two) / 2] if i == at else []) for i in range(len(quality_classifier.FEATURES))])
    model.weights[model.base[at]:model.base[at] + 2] = -5, 5  # one word is bad, two are good
    monkeypatch.setattr(quality_classifier, "train", lambda rows, labels: model)
    monkeypatch.setattr(corpus_pipeline, "table", lambda *a: None)
    docs = stage_input(spark, rows).coalesce(1)
    got = corpus_pipeline.quality_stage(spark, docs, "").select("doc_id", "text").collect()
    assert sorted(map(tuple, got), key=str) == sorted([(None, "good text"), (5, "good text"), (6, None), (6, " \n"), (8, "good text")], key=str)


def test_a_copy_that_loses_most_of_its_lines_goes(spark):
    rng = random.Random(9)
    lines = [" ".join("".join(rng.choices("abcdefgh", k=7)) for _ in range(12)) for _ in range(30)]
    rows = [(1, "\n".join(lines[:10])), (2, "\n".join(lines[:8] + lines[10:12])), (3, "\n".join([lines[0], *lines[12:22]])),
            (4, None), (5, ""), (6, "\n".join([lines[25]] * 20))]
    docs = stage_input(spark, rows)
    left = {r.doc_id: r.text for r in corpus_pipeline.line_stage(spark, docs, "").collect()}
    assert left == {1: rows[0][1], 3: "\n".join(lines[12:22]), 4: None, 5: "", 6: lines[25]}
    whole = {r.doc_id for r in line_dedup.dedup_lines(docs, least_words=0).collect()}
    assert whole == {1, 2, 3, 4, 5, 6}

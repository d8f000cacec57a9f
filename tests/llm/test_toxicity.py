"""Toxic words and phrases of low frequency in made-up texts that also hold harmless words of their own."""

import random

import pandas as pd
import pytest

from sensorlytics.llm import toxicity
from sensorlytics.llm.common import fold_of

PARTS = [a + b for a in "bcdfglmnprst" for b in "aeiou"]


def corpus(kinds: int, each: int, phrase: bool, rows: int = 4500, share: float = 0.12) -> pd.DataFrame:
    """Documents of 100 words, one in ten of them fresh; toxic ones hold ``each`` of ``kinds`` toxic words, or one
    of ten phrases of three ordinary words."""
    r = random.Random(7)
    word = lambda parts: "".join(r.choice(PARTS) for _ in range(parts))
    ordinary = [word(r.choice((2, 3))) for _ in range(800)]
    toxic = [word(4) for _ in range(kinds)]
    phrases = [[r.choice(ordinary) for _ in range(3)] for _ in range(10)]
    out = []
    for i in range(rows):
        y = int(r.random() < share)
        ws = [r.choice(ordinary) if r.random() < 0.9 else word(5) for _ in range(100)]
        for _ in range(each if y else 0):
            ws.insert(r.randrange(len(ws)), r.choice(toxic))
        if y and phrase:
            at = r.randrange(len(ws))
            ws[at:at] = r.choice(phrases)
        out.append((i, " ".join(ws), y))
    return pd.DataFrame(out, columns=["doc_id", "text", "toxic"])


@pytest.mark.parametrize("kinds,each,phrase", [(20, 1, False), (60, 1, False), (300, 3, False), (0, 0, True)])
def test_rare_toxic_words_and_phrases(spark, kinds, each, phrase):
    rows = corpus(kinds, each, phrase)
    docs = spark.createDataFrame(rows)
    model = toxicity.fit(docs, docs.select("doc_id", "toxic"))
    out = toxicity.score(docs, model).toPandas()
    held = out[[fold_of(i, 3) == toxicity.HELD_OUT for i in out.doc_id]]
    assert held[held.toxic == 1].predicted.mean() >= 0.9
    assert held[held.toxic == 0].predicted.mean() <= 0.02


def test_copies_of_one_text_are_no_evidence(spark):
    """An ordinary text copied into many rows labelled toxic by mistake does not make its words toxic."""
    rows = corpus(20, 2, False, rows=2500)
    copy = pd.DataFrame({"doc_id": range(10_000, 11_000), "text": rows[rows.toxic == 0].text.iloc[0], "toxic": 1})
    docs = spark.createDataFrame(pd.concat([rows, copy]))
    out = toxicity.score(docs, toxicity.fit(docs, docs.select("doc_id", "toxic"))).where("doc_id < 10000").toPandas()
    assert out[out.toxic == 1].predicted.mean() >= 0.9 and out[out.toxic == 0].predicted.mean() <= 0.02


def test_texts_without_words_score_the_share_of_toxic_ones(spark):
    docs = spark.createDataFrame([(i, "" if i % 2 else None, int(i % 4 == 0)) for i in range(400)],
                                 "doc_id long, text string, toxic int")
    out = toxicity.score(docs, toxicity.fit(docs, docs.select("doc_id", "toxic"))).toPandas()
    assert out.score.between(0, 1).all() and out.score.nunique() == 1 and len(out) == 400

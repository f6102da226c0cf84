"""Each stage of the pipeline against what its operator says about its own input."""

from __future__ import annotations

import os

import pytest

import corpus_pipeline as pipeline
from halala.llm import mixing, passages, wumanber
from halala.llm.fitting import fold
from halala.llm.shared import given, written
from tests.llm.rows import lower, odd, words

FOLDER = os.environ.get("TEST_SF_DIR", "/root/testdata/sf0.001")

pytestmark = pytest.mark.skipif(not os.path.isdir(FOLDER), reason="the given tables are not here")


def ids(df):
    return sorted(r["doc_id"] for r in df.select("doc_id").collect())


def test_stages_one_by_one(spark):
    docs = given(spark, FOLDER, "documents")
    got = {}
    for name, stage in pipeline.STAGES:
        before, docs = docs, written(stage(spark, docs, FOLDER))
        got[name] = (before, docs)
        if name != "tokens":
            assert docs.columns == before.columns

    before, after = got["quality"]
    model = passages.fitted(before, given(spark, FOLDER, "labels").where(fold("doc_id", 5) != 0))
    assert ids(after) == ids(passages.scored(before, model).where("score >= 0.3"))

    before, after = got["near_dedup"]
    sets = {r["doc_id"]: (lambda w: {tuple(w[j : j + 5]) for j in range(max(1, len(w) - 4))})(words(lower(r["text"]))) for r in before.collect()}
    label = {i: i for i in sets}
    changed = True
    while changed:
        changed = False
        for a, x in sets.items():
            for b, y in sets.items():
                if label[b] < label[a] and 100 * len(x & y) >= 80 * len(x | y):
                    label[a], changed = label[b], True
    assert ids(after) == sorted(set(label.values()))

    before, after = got["decontaminate"]
    assert ids(after) == ids(wumanber.contamination(before, given(spark, FOLDER, "benchmark")).where("not contaminated"))

    before, after = got["mix"]
    rated = mixing.rates(before, pipeline.labelled_domains(spark, FOLDER), pipeline.TARGETS, keep_all=True)
    times = {r["doc_id"]: r["n"] for r in rated.select("doc_id", mixing.copies(rated["rate"], "doc_id", "rank").alias("n")).collect()}
    assert ids(after) == sorted(i for i, n in times.items() for _ in range(n))
    assert min(times.values()) >= 1

    before, after = got["tokens"]
    assert ids(after) == ids(before)
    whole = sorted(tuple(r) for r in docs.collect())
    assert whole == sorted(tuple(r) for r in pipeline.run(spark, FOLDER).collect())


def test_rows_are_judged_by_their_own_texts(spark):
    """Null and repeated ids with different texts: near_dedup and decontaminate touch no other row."""
    item = given(spark, FOLDER, "benchmark").where("text is not null").orderBy("item_id").first()["text"]
    own = [" ".join(f"t{i}w{j}" for j in range(40)) for i in range(9)]
    texts = [(None, own[0]), (None, own[1]), (None, own[2]), (7, own[3]), (7, own[4]), (9, own[5]), (None, None), (None, None), (9, " ")]
    near = [(3, own[0]), (None, own[1] + " more"), (7, own[3])]
    df = spark.createDataFrame([(i, t, "en", "s", 1) for i, t in texts + near], "doc_id long, text string, lang string, source string, n_chars long")
    got = sorted(((r["doc_id"], r["text"]) for r in pipeline.near_dedup(spark, df, FOLDER).collect()), key=repr)
    left = [(3, own[0]), (None, own[2]), (7, own[3]), (7, own[4]), (9, own[5]), (None, None), (None, None), (9, " ")]
    assert [x for x in got if x[1] is None or not x[1].startswith(own[1])] == sorted(left, key=repr)
    assert len([x for x in got if x[1] and x[1].startswith(own[1])]) == 1

    dirty = [(None, own[6] + " " + item), (7, item)]
    df = spark.createDataFrame([(i, t, "en", "s", 1) for i, t in texts + dirty], df.schema)
    got = sorted(((r["doc_id"], r["text"]) for r in pipeline.decontaminate(spark, df, FOLDER).collect()), key=repr)
    assert got == sorted(texts, key=repr)


def test_stages_of_odd_and_empty_rows(spark):
    some = odd(spark)
    for _, stage in pipeline.STAGES:
        kept = stage(spark, some, FOLDER)
        assert 0 < kept.count()
        assert stage(spark, some.limit(0), FOLDER).count() == 0

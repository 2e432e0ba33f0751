"""The learned classifiers on held-out rows of the small tables and on small cases."""

import os

import numpy as np
import pytest
from pyspark.sql import functions as F

from lexloom.llm import quality, toxicity
from lexloom.llm.common import fitted, labelled_sample
from lexloom.llm.registry import queries

EDGE = [(None, None, "x", 1.0), (1, "", "x", 1.0), (1, "", "x", 1.0), (2, "you idiot " * 30000, None, None), (3, " \t\n", "x", 0.0), (4, "a", "x", 0.0)]


def auc(score, y):
    rank = np.empty(len(score))
    rank[np.argsort(score, kind="stable")] = np.arange(len(score))
    return (rank[y == 1].mean() - (y.sum() - 1) / 2) / (1 - y).sum()


#: Least precision and recall of the predictions on held-out labelled rows, by folder: for toxic rows, and for rows of low quality.
#: Some 3 in 100 labels of the tables are flipped (rows labelled toxic that hold nothing a toxic row shares with others, and
#: the other way round), which bounds both; sf0.001 has 5 and 3 such rows held out, too few to ask anything of.
LEAST = {"sf0.01": {"toxic": (0.9, 0.7), "quality": (0.9, 0.7)}, "sf0.1": {"toxic": (0.95, 0.75), "quality": (0.95, 0.95)}}


@pytest.mark.parametrize("folder", LEAST)
@pytest.mark.parametrize(("name", "label"), [("op5_toxicity", "toxic"), ("op6_quality_classifier", "quality")])
def test_held_out(spark, name, label, folder):
    path = f"/root/testdata/{folder}"
    if not os.path.isdir(path):
        pytest.skip("needs the tables")
    out = queries()[name](spark, path)
    docs = spark.read.parquet(f"{path}/documents.parquet")
    assert out.count() == docs.count()
    joined = out.join(spark.read.parquet(f"{path}/labels.parquet").dropDuplicates(["doc_id"]), "doc_id").where("held_out").toPandas()
    assert joined["score"].between(0, 1).all()
    want, said = (joined[label] == 1, joined["predicted"] == 1) if label == "toxic" else (joined[label] == 0, joined["predicted"] == 0)
    precision, recall = (want & said).sum() / max(1, said.sum()), (want & said).sum() / max(1, want.sum())
    print(f"{name} on {folder}: precision {precision:.3f}, recall {recall:.3f} of {want.sum()} among {len(joined)}")
    assert precision >= LEAST[folder][label][0] and recall >= LEAST[folder][label][1]
    assert auc(joined["score"].to_numpy(), joined[label].to_numpy()) > 0.85


def test_samples_are_bounded_and_defined(spark):
    docs = spark.createDataFrame([(1, "one", 1), (1, "another", 2), (2, None, 1), (3, "x" * 500, 1), (4, "four", 1), (5, "five", 1), (6, "no label", 1), (None, "no id", 1)], "doc_id long, text string, y int")
    labels = spark.createDataFrame([(1, 0), (1, 1), (2, 0), (3, 1), (4, 1), (5, None), (None, 1), (9, 1), (4, 1)], "doc_id long, toxic int")
    sample = lambda **bounds: sorted((r["doc_id"], r["text"], r["y"]) for r in labelled_sample(docs, labels, "toxic", F.lit(True), {0: 9, 1: 9}, **bounds).collect())
    assert sample() == [(1, "another", 1), (2, "", 0), (3, "x" * 500, 1), (4, "four", 1)]
    assert sample(text_bytes=100) == [(1, "another", 1), (2, "", 0), (4, "four", 1)]
    assert len(sample(text_bytes=100, most_bytes=8)) == 2
    assert fitted(labelled_sample(docs, labels, "toxic", F.lit(True), {0: 9, 1: 9}), lambda rows: rows) == [("another", 1), ("", 0), ("x" * 500, 1), ("four", 1)]


@pytest.mark.parametrize("rows", [[], [(1, None), (None, 1)]])
def test_no_labels(spark, rows):
    docs = spark.createDataFrame(EDGE, "doc_id long, text string, source string, score double")
    labels = spark.createDataFrame(rows, "doc_id long, quality int").withColumn("toxic", F.col("quality"))
    assert {r["score"] for r in quality.score_quality(docs, quality.fit_quality(docs, labels)).collect()} == {0.5}
    assert all(r["score"] < 0.5 for r in toxicity.score_toxicity(docs, toxicity.fit_toxicity(docs, labels)).collect())


def test_composed_machine_equals_its_parts():
    """Every word of a clause by definition: what stands how far before and after it."""
    rng = np.random.default_rng(7)
    for _ in range(400):
        clause = rng.choice(6, int(rng.integers(1, 16)), p=[0.4, 0.15, 0.1, 0.15, 0.1, 0.1]).tolist()
        want = []
        for k, symbol in enumerate(clause):
            if symbol in (toxicity.INSULT, toxicity.THREAT):
                mark = toxicity.NEGATED * (toxicity.NEGATION in clause[max(0, k - 3) : k])
                mark |= toxicity.AIMED * (toxicity.TARGET in clause[max(0, k - 4) : k] + clause[k + 1 : k + 5])
                mark |= toxicity.REPORTED * (toxicity.REPORT in clause[:k])
                want.append(8 * (symbol == toxicity.THREAT) + mark)
        kept = [k for k, s in enumerate(clause) if s]
        gaps = [b - a - 1 for a, b in zip([-1, *kept], kept, strict=False)]
        assert [p for p in toxicity.run_clause([clause[k] for k in kept], gaps) if p >= 0] == want


def test_quality_edges(spark):
    df = spark.createDataFrame(EDGE, "doc_id long, text string, source string, score double")
    model = quality.fit([("aa bb cc dd. " * 9, 1), ("zz zz zz zz " * 9, 0)] * 40, epochs=8)
    rows = quality.score_quality(df, model).collect()
    assert len(rows) == 6 and all(0 <= r["score"] <= 1 for r in rows)
    assert quality.score_quality(df.limit(0), model).count() == 0
    assert model.score([b"aa bb cc dd. " * 9])[0] > 0.8 > 0.2 > model.score([b"zz zz zz zz " * 9])[0]
    assert quality.fit([]).score([b""])[0] == 0.5


def test_sum_of_squares_equals_pairs():
    model = quality.fit([("aa bb cc", 1), ("zz zz yy", 0)] * 10, epochs=2)
    text = b"aa zz aa qq"
    w, bucket, stats = quality.describe([text])
    ids = [*bucket.tolist(), *model.bins(stats)[0].tolist()]
    x = [1 / len(w)] * len(w) + [1] * stats.shape[1]
    z = model.w0 + sum(model.w[i] * a for i, a in zip(ids, x, strict=True))
    z += sum(model.v[ids[i]] @ model.v[ids[j]] * x[i] * x[j] for i in range(len(ids)) for j in range(i))
    assert np.isclose(model.score([text])[0], 1 / (1 + np.exp(-z)), atol=1e-5)


def insults():
    filler = [f"word{chr(97 + i // 20)}{chr(97 + i % 20)}" for i in range(200)]
    rng = np.random.default_rng(0)
    clean = [" ".join(rng.choice(filler, 30)) + "." for _ in range(60)]
    bad = [" ".join([*rng.choice(filler, 10), "grumbler", *rng.choice(filler, 10)]) for _ in range(40)]
    return [(t, 0) for t in clean] + [(t, 1) for t in bad]


def test_grammar_learns_and_composes(spark):
    g = toxicity.fit(insults())
    score = lambda *t: g.score([x.encode() for x in t])
    assert (score("you are a grumbler", "Grumblers, all") > 0.7).all() and (score("you are late", "", "grum") < 0.5).all()
    seen = g.matches([b"you grumbler", b"not a grumbler", b"he said: grumbler", b"he said grumbler", b"a grumbler you", b"I kill the of and then more you"])
    assert [np.flatnonzero(x).tolist() for x in seen] == [[2], [1], [0], [6], [2], [8]]
    df = spark.createDataFrame(EDGE, "doc_id long, text string, source string, score double")
    assert toxicity.score_toxicity(df, g).where("score between 0 and 1").count() == 6
    assert toxicity.score_toxicity(df.limit(0), g).count() == 0
    assert toxicity.fit([]).score([b"plain words"])[0] < 0.5


def test_copies_do_not_teach_their_words():
    copies = [("odd phrase glimmer sits exactly here", 1)] * 30
    g = toxicity.fit(insults() + copies)
    assert g.score([b"odd phrase glimmer sits exactly here"])[0] < 0.5

"""The pipeline on the small tables: each stage's decisions take effect on what the one before kept."""

import os
import re

import pytest
from pyspark.sql import functions as F

import corpus_pipeline
from lexloom.llm import quality, simhash

SF = "/root/testdata/sf0.01"


@pytest.mark.skipif(not os.path.isdir(SF), reason="needs the small tables")
def test_stages(spark, tmp_path):
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    kept = [docs]
    for name, stage in corpus_pipeline.STAGES:
        stage(spark, kept[-1], SF).write.parquet(f"{tmp_path}/{name}")
        kept.append(spark.read.parquet(f"{tmp_path}/{name}"))
    assert all(x.columns == docs.columns for x in kept[:-1])
    first, good, lines, single, mixed = [x.toPandas() for x in kept[:-1]]
    # 1: exactly the documents that the classifier accepts, unchanged.
    model = quality.fit_quality(docs, spark.read.parquet(f"{SF}/labels.parquet"))
    score = dict(zip(first["doc_id"], model.score([t.encode() for t in first["text"]]), strict=True))
    assert set(good["doc_id"]) == {d for d, s in score.items() if s >= 0.3} and 0 < len(good) < len(first)
    assert dict(zip(good["doc_id"], good["text"], strict=True)).items() <= dict(zip(first["doc_id"], first["text"], strict=True)).items()
    # 2: no document goes, and no chunk stands in two places.
    from test_native import brute_dedup

    assert sorted(zip(lines["doc_id"], lines["text"], strict=True), key=str) == brute_dedup(list(zip(good["doc_id"], good["text"], strict=True)))
    assert (lines["n_chars"] == lines["text"].str.len()).all()
    # 3: the smallest id of each group of near copies: 5-word shingle sets of a Jaccard similarity of 0.8 or more.
    from test_jaccard import brute_lows

    near = brute_lows(list(zip(lines["doc_id"].tolist(), lines["text"], strict=True)))
    assert set(single["doc_id"]) == {d for d, low in near.items() if d == low} and len(single) < len(lines)
    # 4: each source's words are its budget.
    from test_native import brute_mix

    share, _ = brute_mix(list(zip(single["doc_id"], single["source"], single["text"], strict=True)))
    words = mixed["text"].map(lambda t: len(re.findall(r"[^\x20\x09-\x0D]+", t))).groupby(mixed["source"]).sum()
    assert all(words[s] == int(x + 0.5) for s, x in share.items())
    # 5: every piece has its place, and little room is left.
    packed = kept[-1].toPandas()
    assert packed["length"].sum() == packed.groupby("sequence_id")["length"].sum().sum()
    filled = packed.groupby("sequence_id")["length"].sum()
    assert filled.max() <= 1024 and len(filled) < 1.02 * filled.sum() / 1024 + 2
    assert set(packed["doc_id"]) == set(mixed["doc_id"]) and len(packed[packed["piece"] == 0]) == len(mixed)


SCHEMA = "doc_id long, text string, lang string, source string, n_chars long"


def labelled(spark, folder, rows):
    spark.createDataFrame(rows, "doc_id long, quality int, toxic int").write.mode("overwrite").parquet(f"{folder}/labels.parquet")
    return str(folder)


def test_empty_documents(spark, tmp_path):
    for sf in (SF, labelled(spark, tmp_path, [])):
        docs = spark.createDataFrame([], SCHEMA)
        for _, stage in corpus_pipeline.STAGES:
            docs = stage(spark, docs, sf)
            assert docs.count() == 0
    assert simhash.keep_one_per_group(spark.createDataFrame([], SCHEMA)).count() == 0


#: Null texts, ids and sources, empty and very long texts, repeated rows and ids.
EDGES = [
    (1, "one two three four five six", "en", "a", 27), (1, "one two three four five six", "en", "a", 27), (1, "another text of this id", "en", "a", 23), (2, "one two three four five six", "en", "b", 27), (3, None, None, "a", None), (4, "", "en", None, 0),
    (5, "long words " * 30_000, "en", "b", 330_000), (None, "text without id", "en", "a", 15), (None, None, None, None, None), (6, "lines\n" * 3 + "own line", "en", "b", 26), (7, "lines\n" * 3 + "own line", "en", None, 26),
]


def test_edges_and_clashing_columns(spark, tmp_path):
    """Every stage gives its defined result for odd rows, and columns of any name pass through."""
    sf = labelled(spark, tmp_path, [(1, None, None), (None, 1, 1)])
    names = ["row", "quality", "_quality", "id", "_kept", "nth", "_size", "_source", "_key", "_bucket", "_lines", "_id", "_th", "_drop", "c0", "text_", "a.b"]
    plain = spark.createDataFrame(EDGES, SCHEMA).repartition(3)
    docs = plain.select("*", *[F.lit(f"own {n}").alias(n) for n in names])
    own = lambda df: all(r[5 + k] == f"own {n}" for r in df.collect() for k, n in enumerate(names))
    counts = []
    for name, stage in corpus_pipeline.STAGES[:-1]:
        out = stage(spark, docs, sf)
        assert out.columns == docs.columns and own(out), name
        alone = stage(spark, plain, sf)
        assert alone.columns == plain.columns and sorted(map(str, alone.collect())) == sorted(str(r) for r in out.select(*plain.columns).collect()), name
        counts.append(out.count())
        docs, plain = out, alone
    # All score a half; none goes; groups: 1, 2 are one, the second text of id 1 goes with the id, null and empty are one, 6 and 7 are one.
    assert counts[:2] == [11, 11] and counts[2] == 6 and {r["doc_id"] for r in docs.collect()} <= {1, 5, 6, None}
    pieces = corpus_pipeline.STAGES[-1][1](spark, spark.createDataFrame(EDGES, SCHEMA), sf)
    assert pieces.where("piece = 0").count() == len(EDGES) and pieces.where("doc_id IS NULL").count() == 2
    assert pieces.groupBy("sequence_id").agg(F.sum("length").alias("n")).where("n > 1024").count() == 0


def test_mixing_leaves_no_empty_text(spark, tmp_path):
    out = corpus_pipeline.mix_sources(spark, spark.createDataFrame([(1, None, "en", "a", None), (2, "", "en", "a", 0)], SCHEMA), "")
    assert out.count() == 0

"""The pipeline on a small planted corpus: each stage against what it should do."""

import random

import pytest
from pyspark.sql import functions as F

import corpus_pipeline
from feedward.llm.words import words

SCHEMA = "doc_id long, text string, lang string, source string, n_chars long"


@pytest.fixture(scope="module")
def folder(spark, tmp_path_factory):
    rng = random.Random(9)
    vocabulary = ["".join(rng.choices("abdefghilmnoprstu", k=rng.randint(2, 9))) for _ in range(3000)]
    prose = lambda n: " ".join(rng.choices(vocabulary, k=n))
    passage, item = prose(60), prose(25)
    rows, labels = [], []
    for i in range(400):
        text = "\n".join(prose(rng.randint(12, 60)) for _ in range(rng.randint(1, 4)))
        toxic = i % 5 == 0
        if toxic:
            text += " " + " ".join(rng.choices(["scumbag", "vileness"], k=3)) + " " + prose(5)
        if i in (101, 102, 103):
            text += "\n" + passage
        if i in (111, 112):
            text += "\n" + " ".join(item.split()[1:12] if i == 111 else item.split()[13:24])
        rows.append((i, text, "en", f"src{0 if i % 3 else i % 7}", len(text)))
        if i % 2 == 0 or toxic:
            labels.append((i, 1, int(toxic)))
    copy = rows[201][1].split(" ")
    copy[-1] = "changed"
    rows += [(500, rows[201][1], "en", "src1", 1), (501, " ".join(copy), "en", "src1", 1), (502, None, "en", "src1", None),
             (None, "no id here", "en", None, 10), (503, "", None, "src2", 0)]
    path = tmp_path_factory.mktemp("pipeline")
    spark.createDataFrame(rows, SCHEMA).withColumn("text_hash", F.lit(1)).write.parquet(f"{path}/documents.parquet")
    spark.createDataFrame(labels, "doc_id long, quality int, toxic int").write.parquet(f"{path}/labels.parquet")
    spark.createDataFrame([(1, item), (2, prose(20))], "item_id long, text string").write.parquet(f"{path}/benchmark.parquet")
    return str(path), rows, passage, item


def test_stages(spark, folder):
    path, rows, passage, item = folder
    docs = spark.read.parquet(f"{path}/documents.parquet")
    columns, state = docs.columns, {}
    for name, stage in corpus_pipeline.STAGES:
        after = stage(spark, docs, path)
        if name != "mixing":
            assert after.columns == columns
        after.write.parquet(f"{path}/{name}")
        docs = spark.read.parquet(f"{path}/{name}")
        state[name] = docs.collect()
    ids = {name: {r.doc_id for r in found} for name, found in state.items()}
    clean = {r[0] for r in rows if r[0] is None or r[0] >= 400 or r[0] % 5}
    assert len(ids["toxicity"] - clean) <= 4 and len(clean - ids["toxicity"]) <= 4
    assert {None, 502, 503} <= ids["toxicity"]
    with_passage = [r.doc_id for r in state["line_dedup"] if passage in (r.text or "")]
    assert with_passage == [min({101, 102, 103} & ids["toxicity"])]
    assert 500 not in ids["line_dedup"]
    assert all(r.n_chars == len(r.text) for r in state["line_dedup"] if r.doc_id in (102, 103))
    empty = [r.doc_id for r in state["near_dedup"] if not (r.text or "").split()]
    assert empty == [502]
    assert not {111, 112} & ids["decontamination"]
    assert ids["near_dedup"] - ids["decontamination"] <= {111, 112}
    window = {tuple(words(item)[i : i + 10]) for i in range(16)}
    for r in state["decontamination"]:
        found = words(r.text or "")
        assert not any(tuple(found[i : i + 10]) in window for i in range(len(found)))
    assert ids["mixing"] <= ids["decontamination"]


def test_run_and_clean_documents_pass_whole(spark, folder):
    path, *_ = folder
    found = corpus_pipeline.run(spark, path)
    assert {"doc_id", "text", "mix_epoch", "mix_block", "mix_order"} <= set(found.columns)
    assert found.count() > 250


def test_empty_tables(spark, folder, tmp_path):
    path, *_ = folder
    for name in ("documents", "labels", "benchmark"):
        spark.read.parquet(f"{path}/{name}.parquet").limit(0).write.parquet(f"{tmp_path}/{name}.parquet")
    assert corpus_pipeline.run(spark, str(tmp_path)).count() == 0

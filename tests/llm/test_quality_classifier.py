import numpy as np
import pytest
from odd import ODD

from viewlens.llm import quality_classifier as qc


@pytest.fixture(scope="module")
def fitted(spark, tmp_path_factory):
    folder = "/root/testdata/sf0.01"
    docs = spark.read.parquet(f"{folder}/documents.parquet")
    labels = spark.read.parquet(f"{folder}/labels.parquet")
    return docs, labels, qc.fit(docs, labels, str(tmp_path_factory.mktemp("sample")))


def test_held_out_accuracy(fitted):
    docs, labels, model = fitted
    rows = qc.score_quality(docs, model).join(labels, "doc_id").where("held_out").collect()
    hit = {q: [r["predicted"] == q for r in rows if r["quality"] == q] for q in (0, 1)}
    assert len(hit[0]) > 3 and np.mean(hit[1]) > 0.97 and np.mean(hit[0]) > 0.8
    assert all((r["score"] >= 0.3) == (r["predicted"] == 1) and 0 <= r["score"] <= 1 for r in rows)


def test_odd_rows(fitted, documents):
    model = fitted[2]
    rows = qc.score_quality(documents(ODD), model).collect()
    assert len(rows) == len(ODD)
    assert len({r["score"] for r in rows if r["doc_id"] in (1, 2, 3)}) == 1
    assert len({r["score"] for r in rows if r["doc_id"] in (4, None)}) == 1
    kept = qc.accepted(documents(ODD), model)
    assert kept.columns == documents(ODD).columns
    assert kept.count() == sum(r["predicted"] for r in rows)
    assert qc.score_quality(documents([]), model).count() == 0


def test_without_labels(documents, spark, scratch):
    none = spark.createDataFrame([], "doc_id long, quality int, toxic int")
    model = qc.fit(documents(ODD), none, scratch)
    assert len({r["score"] for r in qc.score_quality(documents(ODD), model).collect()}) == 1


def test_sample_rules(documents, spark):
    labels = spark.createDataFrame(
        [(1, 0), (1, 1), (2, None), (None, 1), (3, 0), (3, 0)], "doc_id long, quality int"
    )
    docs = documents([(i, f"text {i}") for i in range(1, 6)])
    rows = {r["doc_id"]: r["label"] for r in qc.labelled_sample(docs, labels).collect()}
    assert rows.items() <= {1: 1, 3: 0}.items()
    assert qc.labelled_sample(docs, labels, 1).count() == 1


def test_gradient():
    rng = np.random.default_rng(0)
    x = rng.normal(size=(300, 4))
    y = (x[:, 0] * x[:, 1] > 0).astype(float)
    logit = qc.forward(x, qc.train_network(x, y))[1]
    assert ((logit > 0) == (y == 1)).mean() > 0.9
    assert qc.calibrate(10 * logit, y) > qc.calibrate(logit, y)

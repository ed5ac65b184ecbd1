"""Quality classifier: held-out accuracy, no leak from held-out labels, defined results for odd input."""

import numpy as np
from pyspark.sql import Row
from pyspark.sql import functions as F

from conftest import odd_rows, prose
from seriesmill.llm import quality


def corpus(n=360):
    docs, labels = [], []
    for i in range(n):
        text, good = prose(i + 50, 20 + i % 60), 1
        if i % 3 == 0:
            good = 0
            words = text.split()
            text = [" ".join(w + "&&&" for w in words), text.upper() + "!!", " ".join([words[0]] * 40), " | ".join(words)][i // 3 % 4]
        docs.append((i, text, "s", "x"))
        labels.append((i, good))
    return docs, labels


def frames(spark, flip=lambda i, q: q):
    docs, labels = corpus()
    return (
        spark.createDataFrame(docs, "doc_id long, text string, score string, predicted string"),
        spark.createDataFrame([(i, flip(i, q)) for i, q in labels], "doc_id long, quality int"),
    )


def test_held_out_accuracy_and_no_leak(spark, work):
    held = quality.fold(F.col("doc_id"), 4) == 2
    docs, labels = frames(spark)
    scored = quality.score_documents(docs, labels, work, ~held)
    assert scored.columns == ["doc_id", "text", "score", "predicted"]
    rows = scored.join(labels, "doc_id").filter(held).collect()
    assert len(rows) > 50 and np.mean([r.predicted == r.quality for r in rows]) >= 0.95
    assert all(0 <= r.score <= 1 and r.predicted == int(r.score >= 0.7) for r in rows)

    # labels of held-out rows play no part
    hidden = {r.doc_id for r in docs.filter(held).select("doc_id").collect()}
    _, wrong = frames(spark, lambda i, q: 1 - q if i in hidden else q)
    again = quality.score_documents(docs, wrong, work, ~held)
    same = scored.select("doc_id", "score").join(again.select("doc_id", F.col("score").alias("other")), "doc_id")
    assert same.filter("score <> other").isEmpty()


def test_odd_rows(odd, work, spark):
    labels = spark.createDataFrame([(4, 1), (4, 0), (7, 1), (8, 1), (10, 0), (15, 0), (99, 1), (None, 1), (13, None)], "doc_id long, quality int")
    rows = quality.score_documents(odd, labels, work).collect()
    assert len(rows) == len(odd_rows()) and all(0 <= r.score <= 1 for r in rows)
    blank = {r.score for r in rows if r.doc_id in (1, 2, 3)}
    assert len(blank) == 1


def test_without_two_classes(odd, nothing, work, spark):
    empty = spark.createDataFrame([], "doc_id long, quality int")
    assert {r.score for r in quality.score_documents(odd, empty, work).collect()} == {0.5}
    one = spark.createDataFrame([(7, 0)], "doc_id long, quality int")
    assert {r.score for r in quality.score_documents(odd, one, work).collect()} == {0.0}
    assert quality.score_documents(nothing, one, work).count() == 0


def test_calibration_is_a_temperature():
    rng = np.random.default_rng(0)
    x = rng.normal(size=(2000, quality.DIM))
    y = (rng.random(2000) < 1 / (1 + np.exp(-3 * x[:, 0]))).astype(float)
    model = quality.Model([], np.zeros((quality.FORMS, quality.DIM)), np.ones(quality.FORMS))
    quality.fit_network(model, x, y, np.ones(2000))
    p = 1 / (1 + np.exp(-model.logits(x) / model.temperature))
    middle = (p > 0.4) & (p < 0.6)
    assert abs(p.mean() - y.mean()) < 0.05 and model.temperature > 0 and abs(p[middle].mean() - y[middle].mean()) < 0.15


def test_query_knows_the_fold_of_every_row(spark, tmp_path):
    """The registered query over tables in files: a row without an id is scored and is not held out."""
    from seriesmill.llm import queries

    docs, labels = frames(spark)
    nameless = spark.createDataFrame([(None, "no id", "s", "x")], docs.schema)
    docs.unionByName(nameless).write.parquet(f"{tmp_path}/documents.parquet")
    labels.write.parquet(f"{tmp_path}/labels.parquet")
    rows = queries.op5_quality(spark, str(tmp_path)).collect()
    assert len(rows) == docs.count() + 1 and all(r.held_out is not None for r in rows)
    assert [r.held_out for r in rows if r.doc_id is None] == [False]


def test_driver_gets_each_sum_once(spark, work, monkeypatch):
    # the sums of all tasks meet in tasks: what the driver fetches does not grow with the parts of the sample
    frame = type(spark.range(0))
    docs, labels = frames(spark)
    fetched = []

    def fetch(self, *a, get=frame.toLocalIterator, **b):
        fetched.append([r.asDict() for r in get(self, *a, **b)])
        return iter([Row(**r) for r in fetched[-1]])

    monkeypatch.setattr(frame, "toLocalIterator", fetch)
    monkeypatch.setattr(quality, "STRIP", 16, raising=False)
    few = quality.fit(docs, labels, work)
    monkeypatch.setattr(frame, "repartition", lambda self, n, *cols, deal=frame.repartition: deal(self, 40, *cols))
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    try:
        many = quality.fit(docs, labels, work)
    finally:
        spark.conf.unset("spark.sql.adaptive.coalescePartitions.enabled")
    size = len(few.vectors)
    for rows in fetched:
        assert sum(len(r["total"]) for r in rows) <= 8 * size * quality.DIM
        assert sorted(r["first"] for r in rows) == sorted({r["first"] for r in rows})
    assert few.known == many.known and (few.weights == many.weights).all()

"""Quality: held-out accuracy, shrinkage, and odd rows."""

import tracemalloc

import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from concordat.llm import site_quality
from concordat.llm.common import table
from concordat.llm.site_quality import judge_quality, keep_good, site_rates

SF = "/root/testdata/sf0.01"


def test_held_out_accuracy(spark, monkeypatch):
    monkeypatch.setattr(site_quality.trained, "__defaults__", (150,))
    docs, labels = table(spark, SF, "documents"), table(spark, SF, "labels")
    fitted = labels.orderBy(F.xxhash64("doc_id"), "doc_id", "quality").limit(150).select("doc_id")
    unseen = labels.join(fitted, "doc_id", "left_anti")
    judged = judge_quality(docs, labels).join(unseen, "doc_id").select("quality", "kept").collect()
    assert len(judged) > 200
    assert sum(bool(row.quality) == row.kept for row in judged) / len(judged) > 0.97


def test_sparse_sites_are_drawn_to_the_whole(spark):
    rows = [("big", "a", 0.9)] * 400 + [("big", "b", 0.1)] * 400 + [("poor", "a", 0.1)] * 400
    rows += [("few", "a", 0.0)] * 2 + [("few", "b", 0.9)] * 50
    scored = spark.createDataFrame(rows, "host string, path string, p double")
    rates = {(r.host, r.path): r.rate for r in site_rates(scored).collect()}
    assert rates["big", "a"] > 0.8 and rates["big", "b"] < 0.2 and rates["poor", "a"] < 0.2
    assert 0.0 < rates["few", "a"] < rates["few", "b"] <= 0.9
    assert site_rates(scored.limit(0)).collect() == []


def test_odd_rows(spark):
    rows = [
        (1, "a fine text of words", "en", "s", "h"), (1, "a fine text of words", "en", "s", "h"),
        (2, None, None, None, None), (3, "", "en", "s", "i"), (None, "x " * 20000, "de", None, "j"),
    ]
    docs = spark.createDataFrame(rows, "doc_id long, text string, lang string, source string, host string")
    labels = spark.createDataFrame(
        [(1, 1, 0), (3, 0, 0), (3, None, 0), (None, 1, 0), (77, 1, 1), (3, 5, 0)],
        "doc_id long, quality int, toxic int",
    )
    for known in (labels, labels.limit(0), labels.where("quality = 1")):
        judged = judge_quality(docs, known).collect()
        assert len(judged) == len(rows)
        assert all(0 <= row.posterior <= 1 and row.rate is not None for row in judged)
        if known is not labels:
            assert all(row.kept and row.evidence == 0 for row in judged)
    assert judge_quality(docs.limit(0), labels).collect() == []
    kept = keep_good(docs, labels.limit(0))
    assert kept.columns == docs.columns
    assert sorted(map(tuple, kept.collect()), key=repr) == sorted(rows, key=repr)


@pytest.mark.parametrize("bad", ["", "no words", "word"])
def test_one_kind_of_label_is_no_evidence(bad):
    import numpy as np

    model = site_quality.fit(np.ones((3, 133)), np.ones(3))
    assert model.evidence(np.zeros((2, 133))).tolist() == [0, 0]


def test_features_hold_little_beside_the_texts():
    texts = pa.array([f"word{i % 97} and more of number {i} " * 20 for i in range(6000)])
    tracemalloc.start()
    found = site_quality.features(texts)
    peak = tracemalloc.get_traced_memory()[1]
    tracemalloc.stop()
    assert len(found) == len(texts) and peak < 45 * 1024 * 1024

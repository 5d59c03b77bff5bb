"""Centroid clustering beside a plain version."""

import hashlib
import math
import random

import pytest
from pyspark.sql import functions as F

from concordat.llm import scalar_tables
from concordat.llm.scalar_tables import cluster_vectors


def plain(rows, k, rounds, dims, scale=1024, salt="3"):
    kept = []
    for vec_id, vector in rows:
        if vector is None or len(vector) != dims:
            continue
        if any(x is None or not math.isfinite(x) for x in vector):
            continue
        kept.append((vec_id, [math.floor(scale * x) for x in vector]))

    def order(row):
        digest = hashlib.sha256(f"{salt}:{row[0]}".encode()).hexdigest()
        return row[0] is None, digest if row[0] is not None else "", row[1]

    centroids = [v for _, v in sorted(kept, key=order)[:k]]

    def nearest(v):
        return min((sum((a - b) ** 2 for a, b in zip(v, c)), i) for i, c in enumerate(centroids))

    for _ in range(rounds):
        groups = {}
        for _, v in kept:
            groups.setdefault(nearest(v)[1], []).append(v)
        for i, group in groups.items():
            centroids[i] = [sum(x) // len(group) for x in zip(*group)]
    placed = [(vec_id, *nearest(v)[::-1]) for vec_id, v in kept]
    inertia = [0] * k
    for _, cluster, distance in placed:
        inertia[cluster] += distance
    told = [hashlib.sha256(",".join(map(str, c)).encode()).hexdigest() for c in centroids]
    return sorted(
        ((i, c, d, inertia[c], sum(inertia), told[c]) for i, c, d in placed), key=repr
    )


def found(df):
    return sorted(map(tuple, df.collect()), key=repr)


@pytest.mark.parametrize("block_rows", [16_384, 7])
def test_equals_plain_rounds_on_odd_rows(spark, monkeypatch, block_rows):
    monkeypatch.setattr(scalar_tables, "BLOCK_ROWS", block_rows)
    rng = random.Random(3)
    rows = [(i, [rng.gauss(i % 5, 0.3) for _ in range(4)]) for i in range(120)]
    rows += [(i, [0.25, -0.25, 1.0, -1.5]) for i in range(200, 260)]  # a third are copies
    rows += [rows[0], rows[0], (0, [9.0, 9.0, 9.0, 9.0]), (None, [1.0, 2.0, 3.0, 4.0])]
    rows += [(900, None), (901, []), (902, [1.0] * 5), (903, [1.0, None, 1.0, 1.0])]
    rows += [(904, [float("nan")] * 4), (905, [float("inf"), 0.0, 0.0, 0.0])]
    df = spark.createDataFrame(rows, "vec_id long, embedding array<double>").repartition(5)
    # clashing names of further columns
    df = df.withColumn("cluster", F.lit("x")).withColumn("distance", F.lit(1)).withColumn("id", F.lit(2))
    got = found(cluster_vectors(df, k=6, rounds=5, dims=4))
    assert got == plain(rows, 6, 5, 4)
    assert len(got) == 184


def test_ties_and_few_vectors(spark):
    rows = [(1, [1.0]), (2, [1.0]), (3, [-1.0])]
    df = spark.createDataFrame(rows, "vec_id long, embedding array<float>")
    assert found(cluster_vectors(df, k=8, rounds=3, dims=1)) == plain(rows, 3, 3, 1)
    assert cluster_vectors(df.limit(0), dims=1).collect() == []
    assert cluster_vectors(df, dims=2).collect() == []


def test_ids_of_any_kind_and_means_below_zero(spark):
    rows = [(f"v{i}", [(-1) ** i * i / 1024, -i / 2048]) for i in range(30)]
    df = spark.createDataFrame(rows, "vec_id string, embedding array<double>")
    assert found(cluster_vectors(df, k=3, rounds=4, dims=2)) == plain(rows, 3, 4, 2)


def test_components_beyond_the_bound_are_an_error(spark):
    df = spark.createDataFrame([(1, [1e30])], "vec_id long, embedding array<double>")
    with pytest.raises(Exception, match="must stay below"):
        cluster_vectors(df, dims=1).collect()

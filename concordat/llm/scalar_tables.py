"""Centroid clustering of whole-numbered vectors by scalar lookup tables."""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from concordat.llm.common import staged

# Vectors of one block; a dimension's values then fit codes of two bytes.
BLOCK_ROWS = 16_384
# Components of one block at most, whatever the number of dimensions.
BLOCK_CELLS = 2_000_000
# Components stay below this, so that squared distances of up to 256 dimensions fit 63 bits.
LARGEST = 1 << 26


def whole_components(vector: Column, dims: int, scale: int) -> Column:
    """The vector with each component times ``scale`` rounded down, null where it is unfit.

    Unfit are missing vectors, other numbers of components and missing or non-finite components.
    """
    doubles = F.transform(vector, lambda x: x.cast("double"))
    fit = F.forall(
        doubles,
        lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < F.lit(float("inf"))),
    )
    whole = F.transform(
        doubles,
        lambda x: F.when(F.abs(x) * scale < LARGEST, F.floor(x * scale)).otherwise(
            F.raise_error(F.lit(f"components times {scale} must stay below {LARGEST}")).cast("long")
        ),
    )
    return F.when((F.size(vector) == dims) & fit, whole)


def _blocks(batches: Iterator[pa.RecordBatch], dims: int, rows: int) -> Iterator[pa.RecordBatch]:
    """Blocks of vectors: per dimension the values that occur, and each vector's place among them."""
    for batch in batches:
        for low in range(0, batch.num_rows, rows):
            part = batch.slice(low, rows)
            cells = part.column(1).flatten().to_numpy(zero_copy_only=False).reshape(-1, dims)
            values, codes, starts = [], [], [0]
            for column in cells.T:
                occurring, code = np.unique(column, return_inverse=True)
                values.append(occurring)
                codes.append(code.astype(np.uint16))
                starts.append(starts[-1] + len(occurring))
            ids = pa.ListArray.from_arrays([0, part.num_rows], part.column(0))
            yield pa.RecordBatch.from_arrays(
                [
                    ids,
                    pa.array([np.concatenate(codes).tobytes()], pa.binary()),
                    pa.array([np.concatenate(values).astype(np.int64).tobytes()], pa.binary()),
                    pa.array([starts], pa.list_(pa.int32())),
                ],
                names=["ids", "codes", "cell_values", "starts"],
            )


def _measured(batch: pa.RecordBatch, centroids: np.ndarray) -> Iterator[tuple]:
    """For each block: its ids, places, values, value starts, nearest centroids and distances.

    The table holds, for every occurring value of every dimension, its squared difference to each
    centroid; a distance is the sum of the rows its components point to.
    """
    for i in range(batch.num_rows):
        ids = batch.column(0)[i].values
        starts = np.array(batch.column(3)[i].as_py())
        values = np.frombuffer(batch.column(2)[i].as_py(), np.int64)
        codes = np.frombuffer(batch.column(1)[i].as_py(), np.uint16).reshape(len(starts) - 1, -1)
        dim_of = np.repeat(np.arange(len(starts) - 1), np.diff(starts))
        table = (values[:, None] - centroids.T[dim_of]) ** 2
        distances = np.zeros((codes.shape[1], len(centroids)), np.int64)
        for start, code in zip(starts, codes):
            distances += table[code + start]
        nearest = distances.argmin(axis=1)
        yield ids, codes, values, starts, nearest, distances[np.arange(len(nearest)), nearest]


def _totals(batches: Iterator[pa.RecordBatch], centroids: np.ndarray) -> Iterator[pa.RecordBatch]:
    """One row for each block and centroid with vectors: their number, sums and distance."""
    for batch in batches:
        out = []
        for _, codes, values, starts, nearest, distance in _measured(batch, centroids):
            for cluster in np.unique(nearest):
                mine = nearest == cluster
                places = codes[:, mine] + starts[:-1, None]
                often = np.bincount(places.ravel(), minlength=len(values))
                sums = np.add.reduceat(often * values, starts[:-1])
                out.append((int(cluster), int(mine.sum()), sums.tolist(), int(distance[mine].sum())))
        if out:
            kinds = [pa.int32(), pa.int64(), pa.list_(pa.int64()), pa.int64()]
            yield pa.RecordBatch.from_arrays(
                [pa.array(column, kind) for column, kind in zip(zip(*out), kinds)],
                names=["cluster", "members", "sums", "distance"],
            )


def _assigned(batches: Iterator[pa.RecordBatch], centroids: np.ndarray) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        for ids, _, _, _, nearest, distance in _measured(batch, centroids):
            yield pa.RecordBatch.from_arrays(
                [ids, pa.array(nearest, pa.int32()), pa.array(distance, pa.int64())],
                names=["id", "cluster", "distance"],
            )


def _summed(blocks: DataFrame, centroids: np.ndarray) -> tuple[dict, dict]:
    """Members and exact component sums, and summed distance, of every centroid with vectors.

    What comes to the driver is one number for each centroid and dimension.
    """
    parts = blocks.mapInArrow(
        lambda batches: _totals(batches, centroids),
        "cluster int, members long, sums array<long>, distance long",
    )
    # Place -1 carries the members, place -2 the distance.
    cells = parts.select(
        "cluster", F.posexplode(F.concat(F.array("members", "distance"), "sums")).alias("place", "x")
    )
    exact = F.sum(F.col("x").cast("decimal(38,0)")).alias("x")
    whole: dict[int, dict[int, int]] = {}
    for row in cells.groupBy("cluster", "place").agg(exact).collect():
        whole.setdefault(row.cluster, {})[row.place] = int(row.x)
    members = {c: (x[0], [x[2 + d] for d in range(len(x) - 2)]) for c, x in whole.items()}
    return members, {c: x[1] for c, x in whole.items()}


def cluster_vectors(
    vectors: DataFrame,
    k: int = 8,
    rounds: int = 10,
    dims: int = 64,
    scale: int = 1024,
    salt: str = "3",
    id_column: str = "vec_id",
    vector_column: str = "embedding",
) -> DataFrame:
    """Every fit vector with its cluster after ``rounds`` of exact whole-number k-means.

    Vectors are kept when they have ``dims`` components, none missing or non-finite; a component x
    counts as floor(scale * x).  The first centroids are the ``k`` kept vectors with the smallest
    sha256 of ``salt:id``; among equal ids the smaller vector comes first, rows without an id come
    last.  A round gives every vector to its nearest centroid (the smaller number among equals) and
    moves each centroid with vectors to their mean, rounded down.  With fewer than ``k`` kept
    vectors there are as many centroids as vectors; without any, no rows.  Repeated rows count and
    come back as often as they stand there, other columns are ignored.  Components whose scaled
    size reaches 2^26 are an error, since their distances could pass 63 bits.

    The vectors are written once as blocks of places in value tables; a round reads them, tabulates
    per block the squared difference of every occurring value to every centroid and sums up what
    the places point to.  Only sums for each centroid and dimension are shuffled or collected.
    """
    if not 0 < dims <= 256:
        raise ValueError("from 1 to 256 dimensions")
    whole = vectors.select(
        F.col(id_column).alias("id"),
        whole_components(F.col(vector_column), dims, scale).alias("whole"),
    ).where("whole is not null")
    order = F.sha2(F.concat(F.lit(f"{salt}:"), F.col("id").cast("string")), 256)
    first = whole.orderBy(order.asc_nulls_last(), "whole").limit(k).collect()
    kind = whole.schema["id"].dataType.simpleString()
    columns = (
        f"id {kind}, cluster int, distance long, cluster_inertia long, inertia long, "
        "centroid_sha256 string"
    )
    if not first:
        none = vectors.sparkSession.createDataFrame([], columns)
        return none.withColumnRenamed("id", id_column)
    centroids = np.array([row.whole for row in first], np.int64)
    rows = max(1, min(BLOCK_ROWS, BLOCK_CELLS // dims))
    blocks = staged(
        whole.mapInArrow(
            lambda batches: _blocks(batches, dims, rows),
            f"ids array<{kind}>, codes binary, cell_values binary, starts array<int>",
        ),
        "vector-blocks",
    )
    for _ in range(rounds):
        members, _ = _summed(blocks, centroids)
        moved = centroids.copy()
        for cluster, (count, sums) in members.items():
            moved[cluster] = [total // count for total in sums]
        if (moved == centroids).all():  # the remaining rounds would change nothing
            break
        centroids = moved
    _, distances = _summed(blocks, centroids)
    summary = [
        (c, distances.get(c, 0), hashlib.sha256(",".join(map(str, x.tolist())).encode()).hexdigest())
        for c, x in enumerate(centroids)
    ]
    spark = vectors.sparkSession
    told = spark.createDataFrame(summary, "cluster int, cluster_inertia long, centroid_sha256 string")
    placed = blocks.mapInArrow(
        lambda batches: _assigned(batches, centroids), f"id {kind}, cluster int, distance long"
    )
    # One row for each centroid.
    return placed.join(F.broadcast(told), "cluster").select(
        F.col("id").alias(id_column),
        "cluster",
        "distance",
        "cluster_inertia",
        F.lit(sum(distances.values())).cast("long").alias("inertia"),
        "centroid_sha256",
    )

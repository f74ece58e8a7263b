"""Centroid clustering by a stored distance matrix that is only ever updated.

Vectors become integers, so every figure is exact and the same on any cluster. Each
vector's row keeps its dot product with every centroid. A round changes them by the
components of a centroid that moved, never by the whole centroid, and the nearest
centroid follows from them: the squared distance is |v|^2 - 2 v.c + |c|^2.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tradevigil.llm.store import discard, stored_at

DIMENSIONS = 64
CENTROIDS = 8
ROUNDS = 10
SCALE = 1024
SEED = 3
#: A component of this size or more would let a squared distance leave 64 bits.
TOO_LARGE = 1 << 27

_STATE = "id {id}, v array<int>, dots array<bigint>, cluster int, distance bigint"


def integers(vectors: DataFrame, id_column: str, vector_column: str, dimensions: int = DIMENSIONS) -> DataFrame:
    """`id`, `v`: the vectors of the right length, whole and finite, as floor(SCALE * x).

    Left out: other lengths, NULL vectors, NULL, NaN or infinite components, and vectors
    with a component of `TOO_LARGE` or more after scaling, whose squared distances no 64-bit
    column can hold. Repeated rows and NULL or repeated ids stay, each as a row of its own.
    """
    known = vectors.select(F.col(id_column).alias("id"), F.col(vector_column).cast("array<double>").alias("x"))

    def usable(x):
        return F.coalesce(~F.isnan(x) & (F.abs(x) < TOO_LARGE / SCALE), F.lit(False))

    fit = known.where((F.size("x") == dimensions) & F.forall("x", usable))
    return fit.select("id", F.transform("x", lambda x: F.floor(x * SCALE).cast("int")).alias("v"))


def first_centroids(points: DataFrame, centroids: int, seed: int) -> np.ndarray:
    """The vectors with the smallest SHA-256 of `<seed>:<id>`; ties by components, NULL id as no text."""
    mark = F.sha2(F.concat(F.lit(f"{seed}:"), F.coalesce(F.col("id").cast("string"), F.lit(""))), 256)
    rows = points.select(mark.alias("mark"), "v").orderBy("mark", "v").limit(centroids).collect()
    return np.array([r["v"] for r in rows], dtype=np.int64)


def _matrix(column: pa.Array, kind: str) -> np.ndarray:
    flat = column.flatten().to_numpy(zero_copy_only=False).astype(kind, copy=False)
    return flat.reshape(len(column), -1)


def _lists(values: np.ndarray, kind: pa.DataType) -> pa.Array:
    offsets = np.arange(len(values) + 1, dtype=np.int32) * values.shape[1]
    return pa.ListArray.from_arrays(pa.array(offsets), pa.array(values.ravel(), kind))


def _moved(old: np.ndarray, new: np.ndarray) -> list[tuple[np.ndarray, np.ndarray]]:
    """Per centroid: the components that changed, and by how much."""
    steps = new - old
    return [(at := np.flatnonzero(s), s[at]) for s in steps]


def _updated(batches: Iterator[pa.RecordBatch], moved: list, norms: np.ndarray) -> Iterator[pa.RecordBatch]:
    """Dot products brought up to date by the changed components; nearest centroid anew."""
    for batch in batches:
        if not batch.num_rows:
            continue
        v = _matrix(batch.column("v"), "int64")
        known = "dots" in batch.schema.names
        dots = _matrix(batch.column("dots"), "int64").copy() if known else np.zeros((len(v), len(norms)), np.int64)
        for j, (at, change) in enumerate(moved):
            if len(at):
                dots[:, j] += v[:, at] @ change
        gap = norms - 2 * dots
        cluster = np.argmin(gap, axis=1)  # the first of equals: the smaller number
        distance = gap[np.arange(len(v)), cluster] + np.einsum("ij,ij->i", v, v)
        yield pa.RecordBatch.from_arrays(
            [
                batch.column("id"),
                batch.column("v"),
                _lists(dots, pa.int64()),
                pa.array(cluster.astype(np.int32)),
                pa.array(distance),
            ],
            names=["id", "v", "dots", "cluster", "distance"],
        )


def _partial_sums(batches: Iterator[pa.RecordBatch], centroids: int, dimensions: int) -> Iterator[pa.RecordBatch]:
    """One row per cluster and task: rows and component sums."""
    rows, sums = np.zeros(centroids, np.int64), np.zeros((centroids, dimensions), np.int64)
    for batch in batches:
        cluster = batch.column("cluster").to_numpy()
        v = _matrix(batch.column("v"), "int64") if batch.num_rows else None
        for j in np.unique(cluster):
            own = cluster == j
            rows[j] += own.sum()
            sums[j] += v[own].sum(axis=0)
    held = np.flatnonzero(rows)
    yield pa.RecordBatch.from_arrays(
        [pa.array(held.astype(np.int32)), pa.array(rows[held]), _lists(sums[held], pa.int64())],
        names=["cluster", "n", "sums"],
    )


def _means(state: DataFrame, old: np.ndarray) -> np.ndarray:
    """Centroids as floor(sum / count) of their vectors; empty ones stay. Centroids alone reach the driver."""
    k, dimensions = old.shape
    partial = state.select("cluster", "v").mapInArrow(
        lambda part: _partial_sums(part, k, dimensions), "cluster int, n bigint, sums array<bigint>"
    )
    total = (
        partial.select("cluster", "n", F.posexplode("sums").alias("at", "part"))
        .groupBy("cluster", "at")
        .agg(F.sum(F.col("n").cast("decimal(38,0)")).alias("n"), F.sum(F.col("part").cast("decimal(38,0)")).alias("total"))
    )
    new = old.copy()
    for r in total.collect():
        new[r["cluster"], r["at"]] = int(r["total"]) // int(r["n"])
    return new


def clustered(
    vectors: DataFrame,
    id_column: str = "vec_id",
    vector_column: str = "embedding",
    dimensions: int = DIMENSIONS,
    centroids: int = CENTROIDS,
    rounds: int = ROUNDS,
    seed: int = SEED,
) -> tuple[DataFrame, np.ndarray]:
    """Every usable vector with its cluster and squared distance, and the centroids.

    Rows: the id column, `cluster`, `distance`, and the matrix row `dots`. Each round
    assigns all vectors and moves the centroids; a last one assigns. A round's table is
    written to the shared folder before the one before it goes, so a lost executor costs part of a
    round. To the driver come centroids x dimensions numbers a round. Fewer vectors than
    centroids: as many centroids as vectors; no vectors: no rows and no centroids.
    """
    points, points_at = stored_at(integers(vectors, id_column, vector_column, dimensions), "points")
    kind = dict(points.dtypes)["id"]
    schema = _STATE.format(id=kind)
    spark = vectors.sparkSession
    now = first_centroids(points, centroids, seed)
    if not len(now):
        empty = spark.createDataFrame([], schema)
        return empty.select(F.col("id").alias(id_column), "cluster", "distance", "dots"), np.zeros((0, dimensions), np.int64)
    before = np.zeros_like(now)
    state, at = points, points_at
    for turn in range(rounds + 1):
        moved, norms = _moved(before, now), (now * now).sum(axis=1)
        step = state.select("id", "v", *(["dots"] if turn else []))
        newer, newer_at = stored_at(
            step.mapInArrow(lambda part, m=moved, n=norms: _updated(part, m, n), schema), f"round{turn}"
        )
        discard(spark, at)
        state, at = newer, newer_at
        if turn < rounds:
            before, now = now, _means(state, now)
    return state.select(F.col("id").alias(id_column), "cluster", "distance", "dots"), now


def report(vectors: DataFrame) -> DataFrame:
    """`op11`: vec_id, cluster, distance, cluster_inertia, inertia, centroid_sha256.

    Vectors that `integers` leaves out have no row. A sum of distances over 64 bits is NULL.
    No rows: no rows.
    """
    rows, centers = clustered(vectors)
    spark = vectors.sparkSession
    per = rows.groupBy("cluster").agg(F.sum(F.col("distance").cast("decimal(38,0)")).alias("d")).collect()
    total = sum(int(r["d"]) for r in per)
    fits = lambda n: n if n < 1 << 63 else None
    facts = [
        (
            r["cluster"],
            fits(int(r["d"])),
            fits(total),
            hashlib.sha256(",".join(map(str, centers[r["cluster"]].tolist())).encode()).hexdigest(),
        )
        for r in per
    ]
    known = spark.createDataFrame(facts, "cluster int, cluster_inertia bigint, inertia bigint, centroid_sha256 string")
    return rows.drop("dots").join(F.broadcast(known), "cluster").select(
        "vec_id", "cluster", "distance", "cluster_inertia", "inertia", "centroid_sha256"
    )


def _report_sql() -> str:
    """The same clustering as chained steps of plain SQL, distances from scratch each round."""
    steps = [
        """kept AS MATERIALIZED (SELECT row_number() OVER () AS r, vec_id,
  list_transform(embedding, lambda x: CAST(floor(1024 * CAST(x AS DOUBLE)) AS BIGINT)) AS v
  FROM embeddings WHERE len(embedding) = 64 AND len(list_filter(embedding, lambda x: x IS NOT NULL AND isfinite(x))) = 64)""",
        """c0 AS MATERIALIZED (SELECT row_number() OVER (ORDER BY sha256('3:' || CAST(vec_id AS VARCHAR)), v) - 1 AS j, v AS c
  FROM kept QUALIFY j < 8)""",
    ]
    far = "list_sum(list_transform(list_zip(v, c), lambda p: (p[1] - p[2]) * (p[1] - p[2])))"
    for i in range(ROUNDS + 1):
        steps.append(
            f"""a{i} AS MATERIALIZED (SELECT r, vec_id, v, CAST(j AS INTEGER) AS cluster, CAST({far} AS BIGINT) AS distance
  FROM kept, c{i} QUALIFY row_number() OVER (PARTITION BY r ORDER BY {far}, j) = 1)"""
        )
        if i < ROUNDS:
            steps.append(
                f"""s{i} AS (SELECT cluster, place, sum(x) AS s, count(*) AS n
  FROM (SELECT cluster, unnest(v) AS x, unnest(range(64)) AS place FROM a{i}) GROUP BY cluster, place)"""
            )
            steps.append(
                f"""m{i} AS (SELECT cluster, list(CAST((s - ((s % n) + n) % n) // n AS BIGINT) ORDER BY place) AS m FROM s{i} GROUP BY cluster)"""
            )
            steps.append(
                f"c{i + 1} AS MATERIALIZED (SELECT j, coalesce(m, c) AS c FROM c{i} LEFT JOIN m{i} ON cluster = j)"
            )
    return (
        "WITH "
        + ",\n".join(steps)
        + f"""
SELECT vec_id, cluster, distance, CAST(sum(distance) OVER (PARTITION BY cluster) AS BIGINT) AS cluster_inertia,
  CAST(sum(distance) OVER () AS BIGINT) AS inertia, sha256(array_to_string(c, ',')) AS centroid_sha256
FROM a{ROUNDS} JOIN c{ROUNDS} ON j = cluster"""
    )


REPORT_SQL = _report_sql()

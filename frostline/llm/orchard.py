"""Centroid clustering of vectors in whole numbers, each assigned by Orchard's search.

For every centroid the others are listed by their distance to it. A vector starts at one centroid and goes through its
list; when a listed one is closer, the search jumps to the beginning of that one's list. Centroids met before are passed
over. A list ends where its centroids are more than twice as far from the current one as the vector is: by the triangle
inequality none of them can be as close. At exactly twice they can tie, so the search goes on there. The result is that
of comparing with all centroids; of equally close ones the smaller number wins.

A component x counts as the integer floor(scale * x), so sums and distances are exact. Rows are kept if their array has
`dims` components, none of them null or non-finite; all others (null arrays too) are left out. Beyond 2**26 after scaling
an exact distance may not fit 64 bits, and the job fails with that message. Repeated rows count as often as they come; a
null id is hashed as empty text, and ties among the first centroids are settled by components. With fewer vectors than
centroids there are as many centroids as vectors. An empty table gives no row. Only the two named columns are read.

The driver holds the centroids, `k` rows of `dims` numbers. Each task sums its own vectors by centroid before anything is
shuffled, so a round moves `k` rows for each task, whatever the vectors.
"""

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import TaskContext
from pyspark.sql import DataFrame, functions as F

from frostline.llm.text import written

K, ROUNDS, DIMS, SCALE, SALT = 40, 5, 64, 256, "2:"
#: Largest component after scaling: four times a squared distance then fits 64 bits for up to 64 components.
_LARGEST = 1 << 26
#: Vectors that one step of the search takes together.
_STEP = 4096


class Orchard:
    """Centroids with their neighbours by distance."""

    def __init__(self, centroids: np.ndarray):
        self.centroids = centroids.astype(np.int64)
        gaps = np.array([((self.centroids - c) ** 2).sum(1) for c in self.centroids], np.int64)
        self.order = np.argsort(gaps, axis=1, kind="stable")
        self.gap = np.take_along_axis(gaps, self.order, axis=1)

    def nearest(self, vectors: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Number of the nearest centroid and the squared distance, for each row."""
        parts = [self._nearest(vectors[i:i + _STEP]) for i in range(0, len(vectors), _STEP)]
        if not parts:
            return np.zeros(0, np.int64), np.zeros(0, np.int64)
        return np.concatenate([c for c, _ in parts]), np.concatenate([d for _, d in parts])

    def _nearest(self, x: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        n, k = len(x), len(self.centroids)
        best, at = np.zeros(n, np.int64), np.zeros(n, np.int64)
        least = ((x - self.centroids[0]) ** 2).sum(1)
        visited = np.zeros((n, k), bool)
        visited[:, 0] = True
        going = np.arange(n)
        while len(going):
            going = going[at[going] < k]
            listed = best[going], at[going]
            near = self.gap[listed] <= 4 * least[going]
            going, met = going[near], self.order[listed][near]
            at[going] += 1
            new = ~visited[going, met]
            rows, met = going[new], met[new]
            visited[rows, met] = True
            distance = ((x[rows] - self.centroids[met]) ** 2).sum(1)
            closer = (distance < least[rows]) | ((distance == least[rows]) & (met < best[rows]))
            rows = rows[closer]
            best[rows], least[rows], at[rows] = met[closer], distance[closer], 0
        return best, least


def _matrix(column: pa.ListArray, dims: int) -> np.ndarray:
    return column.flatten().to_numpy(zero_copy_only=False).reshape(-1, dims).astype(np.int64)


def whole_numbers(vectors: DataFrame, vec_id: str = "vec_id", embedding: str = "embedding", dims: int = DIMS,
                  scale: int = SCALE) -> DataFrame:
    """(vec_id, x) of the rows that count: their components as integers."""
    def made(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            batch = batch.filter(pc.fill_null(pc.equal(pc.list_value_length(batch.column("x")), dims), False))
            flat = batch.column("x").flatten().cast(pa.float64())
            raw = flat.to_numpy(zero_copy_only=False).reshape(-1, dims)  # null becomes NaN
            sound = np.isfinite(raw).all(1)
            value = np.floor(raw[sound] * float(scale))
            if np.abs(value).max(initial=0) > _LARGEST:
                raise OverflowError(f"a component is beyond {_LARGEST} after scaling: exact distances would not fit 64 bits")
            kept = pa.array(value.astype(np.int32).ravel())
            at = pa.array(np.arange(0, value.size + 1, dims, dtype=np.int32))
            yield pa.RecordBatch.from_arrays([batch.column("vec_id").filter(pa.array(sound)), pa.ListArray.from_arrays(at, kept)], ["vec_id", "x"])

    held = vectors.select(F.col(vec_id).alias("vec_id"), F.col(embedding).alias("x"))
    kind = held.schema["vec_id"].dataType.simpleString()
    return held.mapInArrow(made, f"vec_id {kind}, x array<int>")


def _first(vectors: DataFrame, k: int, salt: str) -> np.ndarray:
    """The vectors whose hashed ids are smallest."""
    name = F.coalesce(F.col("vec_id").cast("string"), F.lit(""))
    rows = vectors.select("x", F.sha2(F.concat(F.lit(salt), name), 256).alias("h")).orderBy("h", "x").limit(k).collect()
    return np.array([r.x for r in rows], np.int64)


def _sums(vectors: DataFrame, tree: Orchard, dims: int) -> dict[int, tuple[int, list[int]]]:
    """How many vectors each centroid has, and their sums by component."""
    shared = vectors.sparkSession.sparkContext.broadcast(tree)

    def made(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        k = len(shared.value.centroids)
        count, total = np.zeros(k, np.int64), np.zeros((k, dims), np.int64)
        for batch in batches:
            x = _matrix(batch.column("x"), dims)
            cluster, _ = shared.value.nearest(x)
            order = np.argsort(cluster, kind="stable")
            held, first = np.unique(cluster[order], return_index=True)
            if len(held):
                total[held] += np.add.reduceat(x[order], first)
                count += np.bincount(cluster, minlength=k)
        held = np.flatnonzero(count)
        part = np.full(len(held), TaskContext.get().partitionId() % 64, np.int32)
        at = pa.array(np.arange(0, len(held) * dims + 1, dims, dtype=np.int32))
        yield pa.RecordBatch.from_arrays(
            [pa.array(part), pa.array(held, pa.int32()), pa.array(count[held]), pa.ListArray.from_arrays(at, pa.array(total[held].ravel()))],
            ["part", "cluster", "n", "total"])

    found = vectors.select("x").mapInArrow(made, "part int, cluster int, n bigint, total array<bigint>")
    sums = [F.sum("n").alias("n"), F.array(*[F.sum(F.col("total")[i]) for i in range(dims)]).alias("total")]
    rows = found.groupBy("part", "cluster").agg(*sums).groupBy("cluster").agg(*sums).collect()  # k rows
    return {r.cluster: (r.n, r.total) for r in rows}


def clustered(vectors: DataFrame, k: int = K, rounds: int = ROUNDS, vec_id: str = "vec_id", embedding: str = "embedding",
              dims: int = DIMS, scale: int = SCALE, salt: str = SALT) -> tuple[DataFrame, np.ndarray]:
    """(vec_id, cluster, distance) for every vector that counts, from a written table; and the final centroids."""
    held = written(whole_numbers(vectors, vec_id, embedding, dims, scale), "vectors")
    centroids = _first(held, k, salt).reshape(-1, dims)
    for _ in range(rounds if len(centroids) else 0):
        for number, (n, total) in _sums(held, Orchard(centroids), dims).items():
            centroids[number] = [value // n for value in total]
    kind = held.schema["vec_id"].dataType.simpleString()
    shared = held.sparkSession.sparkContext.broadcast(Orchard(centroids) if len(centroids) else None)

    def made(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            if batch.num_rows:
                cluster, distance = shared.value.nearest(_matrix(batch.column("x"), dims))
                yield pa.RecordBatch.from_arrays([batch.column("vec_id"), pa.array(cluster, pa.int32()), pa.array(distance)], ["vec_id", "cluster", "distance"])

    return written(held.mapInArrow(made, f"vec_id {kind}, cluster int, distance bigint"), "clusters"), centroids


def op12_orchard(spark, sf_dir: str) -> DataFrame:
    found, centroids = clustered(spark.read.parquet(f"{sf_dir}/embeddings.parquet"))
    sums = {r.cluster: r.s for r in found.groupBy("cluster").agg(F.sum("distance").alias("s")).collect()}  # k rows
    names = [hashlib.sha256(",".join(map(str, c)).encode()).hexdigest() for c in centroids.tolist()]
    rows = [(i, sums.get(i, 0), sum(sums.values()), name) for i, name in enumerate(names)]
    about = spark.createDataFrame(rows, "cluster int, cluster_inertia bigint, inertia bigint, centroid_sha256 string")
    return found.join(F.broadcast(about), "cluster").select(
        "vec_id", "cluster", "distance", "cluster_inertia", "inertia", "centroid_sha256")


def _assigned(centroids: str, out: str) -> str:
    """SQL: every vector with the nearest of the centroids of that table."""
    return f"""
{out} AS (
    SELECT r, arg_min(n, (d, n)) AS cluster, min(d) AS distance
    FROM (SELECT v.r, c.n, list_sum(list_transform(list_zip(v.x, c.x), lambda p: (p[1] - p[2]) * (p[1] - p[2])))::BIGINT AS d FROM v, {centroids} c)
    GROUP BY r)"""


def _moved(centroids: str, assigned: str, out: str) -> str:
    """SQL: the centroids after a round."""
    return f"""
{out}_sums AS (
    SELECT cluster, i, sum(c)::BIGINT AS s, count(*)::BIGINT AS m
    FROM (SELECT a.cluster, unnest(v.x) AS c, unnest(range(64)) AS i FROM {assigned} a JOIN v USING (r)) GROUP BY cluster, i),
{out} AS (
    SELECT n, coalesce(t.x, c.x) AS x FROM {centroids} c LEFT JOIN (
        SELECT cluster, list((s - ((s % m) + m) % m) // m ORDER BY i) AS x FROM {out}_sums GROUP BY cluster) t ON t.cluster = c.n)"""


def _sql() -> str:
    steps = [s for i in range(ROUNDS) for s in (_assigned(f"c{i}", f"a{i}"), _moved(f"c{i}", f"a{i}", f"c{i + 1}"))]
    return f"""
WITH v AS MATERIALIZED (
    SELECT row_number() OVER () AS r, vec_id, list_transform(embedding, lambda e: floor({SCALE} * e::DOUBLE)::BIGINT) AS x
    FROM embeddings
    WHERE len(embedding) = {DIMS} AND len(list_filter(embedding, lambda e: e IS NOT NULL AND isfinite(e))) = {DIMS}),
c0 AS (
    SELECT (row_number() OVER (ORDER BY h, x) - 1)::INTEGER AS n, x
    FROM (SELECT x, sha256('{SALT}' || coalesce(vec_id::VARCHAR, '')) AS h FROM v ORDER BY h, x LIMIT {K})),
{",".join([*steps, _assigned(f"c{ROUNDS}", "final")])}
SELECT vec_id, cluster, distance, (sum(distance) OVER (PARTITION BY cluster))::BIGINT AS cluster_inertia,
    (sum(distance) OVER ())::BIGINT AS inertia, sha256(array_to_string(c.x, ',')) AS centroid_sha256
FROM final JOIN v USING (r) JOIN c{ROUNDS} c ON c.n = cluster
"""


SQL = _sql()

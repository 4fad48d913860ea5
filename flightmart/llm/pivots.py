"""Centroid clustering with a LAESA pivot table (operator 11): exact integer k-means.

A vector counts if it has ``DIMENSIONS`` components, none null or non-finite; component x becomes
the integer floor(256 * x). The first centroids are the ``CENTROIDS`` counted vectors whose
``2:<vec_id>`` has the least SHA-256. Each of ``ROUNDS`` rounds assigns every vector to the nearest
centroid (squared Euclidean distance in integers; ties: the smaller number) and replaces every
non-empty centroid by the floor of its vectors' mean; then vectors are assigned once more.

The pivots are fixed: ``PIVOTS`` of the first centroids, each the one furthest from those chosen
before. The table (a vector's integers and its distances to the pivots) is written once. In a
round the distances between pivots and centroids, PIVOTS x CENTROIDS numbers, bound the distance
of any vector x to any centroid c from below: |d(x, p) - d(c, p)| <= d(x, c). The centroid of
the least bound is measured exactly; every centroid whose bound is above that distance is
ruled out, and the others receive exact integer distances. Bounds are lowered by more than the
rounding of their square roots, so none rules out a centroid wrongly, ties included.

A round is one pass over the table without a shuffle of vectors: each task adds its vectors up per
centroid, so at most CENTROIDS rows leave a task; Spark adds those up over all tasks, and CENTROIDS x
DIMENSIONS sums reach the driver. Centroids travel in the task's closure (20 KB). Nothing
grows with the number of vectors but the table, and a lost task repeats its own slice.

Edge cases: rows that don't count (null, short, long, null or non-finite components) are left out.
With fewer than CENTROIDS vectors each is a centroid at first; equal vectors then leave the
larger numbers empty, and empty centroids stay where they are. Without any the result is
empty. Repeated rows count as often as they occur. A null ``vec_id`` is hashed as no
digits (``2:``); equal hashes are put in order by components. Other columns are never read. A
component whose integer is beyond +-2**27 fails the job with a message: squared distances
of such vectors don't fit a long, so no result would be right.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from flightmart.llm.common import arrow_schema, map_batches, materialize, prepare, to_batch

DIMENSIONS = 64
CENTROIDS = 40
ROUNDS = 5
PIVOTS = 8
SCALE = 256
LIMIT = 1 << 27
PAIRS = 1 << 16      # exact distances computed at a time
SLACK = 1e-12        # of the distances; square roots and differences of doubles err by some 1e-15


def matrix(column: pa.Array, width: int) -> np.ndarray:
    """A list column of ``width`` integers a row as a matrix."""
    return np.asarray(column.flatten()).reshape(-1, width)


def integers(vectors: DataFrame, dimensions: int = DIMENSIONS, id_col: str = "vec_id",
             vector_col: str = "embedding") -> DataFrame:
    """``vec_id, v``: the vectors that count, as integers."""
    x = F.transform(F.col(vector_col), lambda c: c.cast("double"))
    # NaN is greater than any number, so one comparison finds it and both infinities
    fine = (F.size(vector_col) == dimensions) & F.forall(x, lambda c: c.isNotNull() & (F.abs(c) < float("inf")))
    scaled = F.transform(x, lambda c: F.floor(F.lit(float(SCALE)) * c))
    wide = F.exists(x, lambda c: F.abs(c) > float(LIMIT // SCALE))
    checked = F.when(wide, F.raise_error(F.lit(f"a component is beyond {LIMIT // SCALE}: squared distances don't fit a long"))
                     .cast("array<bigint>")).otherwise(scaled)
    rows = vectors.select(F.col(id_col).cast("long").alias("vec_id"), F.col(vector_col)).where(F.coalesce(fine, F.lit(False)))
    return rows.select("vec_id", checked.alias("v"))


def first_centroids(table: DataFrame, count: int = CENTROIDS, seed: str = "2") -> np.ndarray:
    """The ``count`` vectors of least hash, in its order (each task sends on ``count`` rows)."""
    name = F.sha2(F.concat(F.lit(f"{seed}:"), F.coalesce(F.col("vec_id").cast("string"), F.lit(""))), 256)
    rows = table.select(name.alias("h"), "v").orderBy("h", "v").limit(count).collect()
    return np.array([r.v for r in rows], np.int64)


def spread_pivots(centroids: np.ndarray, count: int = PIVOTS) -> np.ndarray:
    """``count`` of the centroids: the first, then always the one furthest from those chosen."""
    chosen = [0]
    far = squared(centroids, centroids[:1])[:, 0]
    while len(chosen) < min(count, len(centroids)):
        chosen.append(int(far.argmax()))
        far = np.minimum(far, squared(centroids, centroids[chosen[-1:]])[:, 0])
    return centroids[chosen]


def squared(x: np.ndarray, y: np.ndarray) -> np.ndarray:
    """Exact squared distances between all rows of two integer matrices."""
    out = np.empty((len(x), len(y)), np.int64)
    for j, c in enumerate(y):
        d = x - c
        out[:, j] = np.einsum("ij,ij->i", d, d)
    return out


def pivot_table(vectors: DataFrame, pivots: np.ndarray) -> DataFrame:
    """``vec_id, v, to_pivots`` with the distances to the pivots, written once."""

    def run(batch: pa.RecordBatch) -> dict:
        x = matrix(batch.column("v"), pivots.shape[1])
        far = np.sqrt(squared(x, pivots).astype(np.float64))
        offsets = np.arange(len(x) + 1, dtype=np.int32) * len(pivots)
        return {"vec_id": batch.column("vec_id"), "v": batch.column("v"),
                "to_pivots": pa.ListArray.from_arrays(offsets, pa.array(far.reshape(-1)))}

    return materialize(map_batches(vectors, run, "vec_id long, v array<long>, to_pivots array<double>"), "laesa-table")


def nearest(x: np.ndarray, to_pivots: np.ndarray, centroids: np.ndarray, pivots: np.ndarray):
    """Number of the nearest centroid, its squared distance, and how many exact distances it took."""
    between = np.sqrt(squared(centroids, pivots).astype(np.float64))
    bound = np.zeros((len(x), len(centroids)))
    for p in range(len(pivots)):
        a, b = to_pivots[:, p, None], between[None, :, p]
        np.maximum(bound, np.abs(a - b) - SLACK * (a + b), out=bound)
    rows = np.arange(len(x))
    best = bound.argmin(axis=1)
    d = x - centroids[best]
    dist = np.einsum("ij,ij->i", d, d)
    # a centroid stays if its bound does not exceed the distance already found
    stay = bound * (1 - SLACK) <= np.sqrt(dist.astype(np.float64))[:, None] * (1 + SLACK)
    stay[rows, best] = False
    at, number = np.nonzero(stay)
    for lo in range(0, len(at), PAIRS):
        i, j = at[lo:lo + PAIRS], number[lo:lo + PAIRS]
        d = x[i] - centroids[j]
        found = np.einsum("ij,ij->i", d, d)
        order = np.lexsort((j, found, i))          # of each vector the least distance, then number
        lead = order[np.concatenate([[True], np.diff(i[order]) > 0])]
        i, j, found = i[lead], j[lead], found[lead]
        better = (found < dist[i]) | ((found == dist[i]) & (j < best[i]))
        best[i[better]], dist[i[better]] = j[better], found[better]
    return best, dist, len(x) + len(at)


def moved(table: DataFrame, centroids: np.ndarray, pivots: np.ndarray) -> np.ndarray:
    """The centroids after one round."""
    width = centroids.shape[1]
    schema = "cluster int, n long, total array<long>"
    target = arrow_schema(schema)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros(centroids.shape, np.int64)
        count = np.zeros(len(centroids), np.int64)
        for batch in batches:
            x = matrix(batch.column("v"), width)
            best, _, _ = nearest(x, matrix(batch.column("to_pivots"), len(pivots)), centroids, pivots)
            np.add.at(total, best, x)
            count += np.bincount(best, minlength=len(centroids))
        held = np.flatnonzero(count)
        yield to_batch({"cluster": held.astype(np.int32), "n": count[held], "total": list(total[held])}, target)

    parts = table.select("v", "to_pivots").mapInArrow(run, schema)
    sums = parts.select("cluster", "n", F.posexplode("total").alias("place", "value"))
    sums = sums.groupBy("cluster", "place").agg(F.sum("n").alias("n"), F.sum("value").alias("value"))
    after = centroids.copy()
    for r in sums.collect():                       # centroids x dimensions rows
        after[r.cluster, r.place] = r.value // r.n
    return after


def assigned(table: DataFrame, centroids: np.ndarray, pivots: np.ndarray) -> DataFrame:
    """``vec_id, cluster, distance`` of every vector."""

    def run(batch: pa.RecordBatch) -> dict:
        x = matrix(batch.column("v"), centroids.shape[1])
        best, dist, _ = nearest(x, matrix(batch.column("to_pivots"), len(pivots)), centroids, pivots)
        return {"vec_id": batch.column("vec_id"), "cluster": best.astype(np.int32), "distance": dist}

    return map_batches(table, run, "vec_id long, cluster int, distance long")


def clustered(vectors: DataFrame, dimensions: int = DIMENSIONS, centroids: int = CENTROIDS, rounds: int = ROUNDS,
              pivots: int = PIVOTS) -> tuple[DataFrame, np.ndarray]:
    """Every counted vector with its cluster and squared distance, and the final centroids."""
    prepare(vectors.sparkSession)
    rows = integers(vectors, dimensions)
    now = first_centroids(rows, centroids)
    if not len(now):
        return vectors.sparkSession.createDataFrame([], "vec_id long, cluster int, distance long"), now
    fixed = spread_pivots(now, pivots)
    table = pivot_table(rows, fixed)
    for _ in range(rounds):
        now = moved(table, now, fixed)
    return assigned(table, now, fixed), now


def digests(vectors: DataFrame) -> DataFrame:
    """The assignment with the distances summed over each cluster and over all, and the centroids' SHA-256."""
    rows, centroids = clustered(vectors)
    rows = materialize(rows, "laesa-assigned")
    sums = rows.groupBy("cluster").agg(F.sum("distance").alias("s")).collect()      # a row a centroid
    whole = sum(r.s for r in sums)
    about = [(r.cluster, r.s, whole, hashlib.sha256(",".join(map(str, centroids[r.cluster].tolist())).encode()).hexdigest())
             for r in sums]
    known = vectors.sparkSession.createDataFrame(
        about, "cluster int, cluster_inertia long, inertia long, centroid_sha256 string")
    return rows.join(F.broadcast(known), "cluster").select(
        "vec_id", "cluster", "distance", "cluster_inertia", "inertia", "centroid_sha256")


def _oracle() -> str:
    """DuckDB SQL for ``digests`` over the table embeddings."""
    near = ("SELECT vid, c, d FROM (SELECT vid, c, d, row_number() OVER (PARTITION BY vid ORDER BY d, c) AS r FROM ("
            "SELECT x.vid, y.c, sum((x.v - y.v) * (x.v - y.v))::BIGINT AS d FROM parts x JOIN c{i} y ON x.p = y.p GROUP BY 1, 2)) WHERE r = 1")
    ctes = [f"""good AS MATERIALIZED (SELECT row_number() OVER () AS vid, vec_id, embedding AS e FROM embeddings WHERE len(embedding) = {DIMENSIONS}
  AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0)""",
            f"""vectors AS MATERIALIZED (SELECT vid, vec_id, list_transform(e, lambda x: floor({SCALE} * x::DOUBLE)::BIGINT) AS v FROM good)""",
            "parts AS MATERIALIZED (SELECT vid, unnest(v) AS v, generate_subscripts(v, 1) AS p FROM vectors)",
            f"""seeds AS MATERIALIZED (SELECT row_number() OVER (ORDER BY sha256('2:' || coalesce(vec_id::VARCHAR, '')), v) - 1 AS c, v FROM vectors
  ORDER BY c LIMIT {CENTROIDS})""",
            "c0 AS MATERIALIZED (SELECT c, unnest(v) AS v, generate_subscripts(v, 1) AS p FROM seeds)"]
    for i in range(ROUNDS):
        ctes.append(f"a{i} AS MATERIALIZED ({near.format(i=i)})")
        ctes.append(f"""m{i} AS MATERIALIZED (SELECT a.c, x.p, sum(x.v)::HUGEINT AS s, count(*) AS n FROM a{i} a JOIN parts x ON x.vid = a.vid GROUP BY 1, 2)""")
        ctes.append(f"""c{i + 1} AS MATERIALIZED (SELECT o.c, o.p, CASE WHEN m.n IS NULL THEN o.v
  ELSE ((m.s - ((m.s % m.n) + m.n) % m.n) // m.n)::BIGINT END AS v FROM c{i} o LEFT JOIN m{i} m ON m.c = o.c AND m.p = o.p)""")
    ctes.append(f"last AS MATERIALIZED ({near.format(i=ROUNDS)})")
    ctes.append(f"""names AS (SELECT c, sha256(string_agg(v::VARCHAR, ',' ORDER BY p)) AS h FROM c{ROUNDS} GROUP BY c)""")
    return "WITH " + ",\n".join(ctes) + """
SELECT v.vec_id, l.c::INTEGER AS cluster, l.d AS distance, (sum(l.d) OVER (PARTITION BY l.c))::BIGINT AS cluster_inertia,
       (sum(l.d) OVER ())::BIGINT AS inertia, n.h AS centroid_sha256
FROM last l JOIN vectors v ON v.vid = l.vid JOIN names n ON n.c = l.c"""


ORACLE = _oracle()

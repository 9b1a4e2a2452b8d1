"""Integer k-means whose exact distances are asked only of centroids that an n-simplex projection leaves possible."""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from siteledger.operators import staged

from .common import rows_of

SIZE = 64
CLUSTERS = 16
PIVOTS = 12
ROUNDS = 3
SLACK = 1e-5  # of the distances in play; far above what rounding can do to an apex, far below what bounds decide
FLAT = 0.05  # a pivot this near the span of those before it, as a share of their spread, would magnify rounding
PLAIN = 1 << 27  # components below this have squared distances in 64 bits
LIMB = 32
MAX_LONG = (1 << 63) - 1


@dataclass
class Simplex:
    """Pivots (rows) and their coordinates in the simplex that they span: each one lies in the space of those before it and one axis more."""

    pivots: np.ndarray
    base: np.ndarray

    @staticmethod
    def of(candidates: np.ndarray, most: int = PIVOTS) -> Simplex:
        """Takes candidates in order, and leaves out those that hardly add a dimension."""
        pivots, base = [], np.zeros((0, 0))
        for one in candidates:
            apex = Simplex(np.array(pivots), base).apexes(np.array([one]))[0] if pivots else np.zeros(0)
            if not pivots or apex[-1] > FLAT * max(np.linalg.norm(base, axis=1).max(initial=0.0), np.linalg.norm(apex)):
                wide = np.zeros((len(pivots) + 1, len(pivots)))
                wide[:-1, : base.shape[1]] = base
                if pivots:
                    wide[-1] = apex
                pivots, base = [*pivots, one], wide
            if len(pivots) == most:
                break
        return Simplex(np.array(pivots, float).reshape(len(pivots), candidates.shape[1] if candidates.ndim == 2 else 0), base)

    def apexes(self, vectors: np.ndarray) -> np.ndarray:
        """Apex coordinates from the distances to all pivots alone: the place of a vector on the simplex's base, and its height above it."""
        with np.errstate(over="ignore", invalid="ignore"):
            squares = np.stack([((vectors - p) ** 2).sum(axis=1) for p in self.pivots], axis=1)
            n = len(self.pivots)
            out = np.zeros((len(vectors), n))
            for k in range(1, n):  # the distance to pivot k, given the coordinates before, settles coordinate k
                b = self.base[k]
                across = out[:, : k - 1] @ b[: k - 1]
                out[:, k - 1] = ((squares[:, 0] - squares[:, k] + (b * b).sum()) / 2 - across) / b[k - 1]
            out[:, n - 1] = np.sqrt(np.maximum(squares[:, 0] - (out[:, : n - 1] ** 2).sum(axis=1), 0.0))
            # An apex has to have the distances that it came from; one spoilt by rounding bounds nothing.
            again = ((out[:, None, : n - 1] - self.base[None, :, :]) ** 2).sum(axis=2) + out[:, n - 1 :] ** 2
            off = np.abs(np.sqrt(again) - np.sqrt(squares)).max(axis=1)
            out[~(off <= SLACK / 10 * np.sqrt(squares).max(axis=1))] = np.nan
        return out


def bounds(points: np.ndarray, others: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Lower and upper bounds of the distances of all points to all others, given their apexes: heights on one side or on opposite ones."""
    flat = ((points[:, None, :-1] - others[None, :, :-1]) ** 2).sum(axis=2)
    one, two = points[:, -1, None], others[None, :, -1]
    return np.sqrt(flat + (one - two) ** 2), np.sqrt(flat + (one + two) ** 2)


def nearest(vectors: np.ndarray, apexes: np.ndarray, centroids: list[list[int]], simplex: Simplex) -> tuple[np.ndarray, list[int], int]:
    """Number of the nearest centroid of every vector, the exact squared distance, and how many exact distances were taken.

    A centroid is left out if its lower bound is above another one's upper bound
    by more than rounding can do; the rest is settled in integers, the smallest number first.
    """
    wide = max((abs(c) for centroid in centroids for c in centroid), default=0) >= PLAIN or np.abs(vectors).max(initial=0) >= PLAIN
    with np.errstate(over="ignore", invalid="ignore"):
        low, high = bounds(apexes, simplex.apexes(np.array(centroids, float)))
        least = high.min(axis=1)
        possible = ~(low > least[:, None] + SLACK * (np.abs(apexes).max(axis=1, initial=0.0)[:, None] + high))
    best, which, asked = None, np.zeros(len(vectors), np.int64), int(possible.sum())
    if wide:
        best = [0] * len(vectors)
        for i, vector in enumerate(vectors.tolist()):
            own = [int(x) for x in vector]
            best[i], which[i] = min((sum((a - b) ** 2 for a, b in zip(own, centroids[k], strict=True)), k) for k in np.flatnonzero(possible[i]).tolist())
        return which, best, asked
    whole, found = vectors.astype(np.int64), np.full(len(vectors), MAX_LONG)
    for k, centroid in enumerate(centroids):
        rows = np.flatnonzero(possible[:, k])
        distance = ((whole[rows] - np.array(centroid, np.int64)) ** 2).sum(axis=1)
        closer = distance < found[rows]
        found[rows[closer]], which[rows[closer]] = distance[closer], k
    return which, found.tolist(), asked


def _vectors(part: pa.RecordBatch, name: str) -> np.ndarray:
    column = part.column(part.schema.get_field_index(name))
    width = len(column.flatten()) // max(len(column), 1)
    return column.flatten().to_numpy(zero_copy_only=False).reshape(len(column), width)


def _apex_rows(simplex: Simplex):
    schema = pa.schema([("_id", pa.int64()), ("_v", pa.list_(pa.float64())), ("_apex", pa.list_(pa.float64()))])

    def run(parts: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part in parts:
            if len(part):
                apexes = simplex.apexes(_vectors(part, "_v"))
                lists = pa.ListArray.from_arrays(np.arange(0, apexes.size + 1, apexes.shape[1], dtype=np.int32), pa.array(apexes.ravel()))
                columns = [part.column(part.schema.get_field_index(c)) for c in ("_id", "_v")]
                yield pa.RecordBatch.from_arrays([*(c.cast(f.type) for c, f in zip(columns, schema, strict=False)), lists], schema=schema)

    return run


def _sum_rows(centroids: list[list[int]], simplex: Simplex):
    """Sums of a task's vectors by cluster and component, in limbs that add up without overflow; component -1 counts vectors."""

    def run(parts: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        sums: dict[int, list[int]] = {}
        counts: dict[int, int] = {}
        for part in parts:
            if not len(part):
                continue
            vectors = _vectors(part, "_v")
            which, _, _ = nearest(vectors, _vectors(part, "_apex"), centroids, simplex)
            plain = np.abs(vectors).max(initial=0) < PLAIN
            for k in np.unique(which).tolist():
                own = vectors[which == k]
                added = own.astype(np.int64).sum(axis=0).tolist() if plain else [sum(map(int, column)) for column in own.T.tolist()]
                sums[k] = [a + b for a, b in zip(sums.get(k, [0] * len(added)), added, strict=True)]
                counts[k] = counts.get(k, 0) + len(own)
        rows = [(k, -1, 0, n) for k, n in counts.items()]
        for k, values in sums.items():
            for at, value in enumerate(values):
                size, limb = abs(value), 0
                while size:
                    rows.append((k, at, limb, (size & ((1 << LIMB) - 1)) * (1 if value > 0 else -1)))
                    size, limb = size >> LIMB, limb + 1
        yield pa.RecordBatch.from_arrays([pa.array([r[i] for r in rows], pa.int64()) for i in range(4)], names=["cluster", "at", "limb", "part"])

    return run


def _assigned_rows(centroids: list[list[int]], simplex: Simplex):
    hashes = [hashlib.sha256(",".join(map(str, c)).encode()).hexdigest() for c in centroids]
    schema = pa.schema([("vec_id", pa.int64()), ("cluster", pa.int32()), ("_distance", pa.string()), ("centroid_sha256", pa.string())])

    def run(parts: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part in parts:
            if len(part):
                which, distances, _ = nearest(_vectors(part, "_v"), _vectors(part, "_apex"), centroids, simplex)
                columns = [[i for (i,) in rows_of(part, "_id")], which, list(map(str, distances)), [hashes[k] for k in which]]
                yield pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(columns, schema, strict=True)], schema=schema)

    return run


def _moved(kept: DataFrame, centroids: list[list[int]], simplex: Simplex) -> list[list[int]]:
    """Centroids after a round: floors of exact means; an empty one stays."""
    sums = kept.select("_v", "_apex").mapInArrow(_sum_rows(centroids, simplex), "cluster long, at long, limb long, part long")
    totals: dict[tuple[int, int], int] = {}
    for k, at, limb, part in sums.groupBy("cluster", "at", "limb").agg(F.sum("part")).collect():  # a few rows for each component of each centroid
        totals[k, at] = totals.get((k, at), 0) + (part << (LIMB * limb))
    return [[totals.get((k, i), 0) // totals[k, -1] for i in range(len(c))] if (k, -1) in totals else c for k, c in enumerate(centroids)]


def cluster(
    table: DataFrame, clusters: int = CLUSTERS, rounds: int = ROUNDS, pivots: int = PIVOTS, size: int = SIZE,
    scale: int = 64, id_col: str = "vec_id", vector_col: str = "embedding", seed: str = "1",
) -> DataFrame:
    """k-means in integers, with results that do not depend on the order of rows.

    Vectors with ``size`` components, none null or not finite, are kept; component x
    becomes floor(scale * x). The centroids start as the kept vectors whose ids have
    the smallest SHA-256 of ``seed:id``. In each round every vector goes to its
    nearest centroid and centroids become floors of the exact means.

    The distances of a vector to a few pivots, the first centroids, are taken once:
    they give its apex over the simplex of the pivots, which is stored with it. Distances of apexes bound
    true distances from below, and from above if one apex is put on the other side
    of the base. Each round bounds the distances to all centroids that way and takes
    exact distances only to those that can be nearest; pivots that hardly add a
    dimension are left out, and a margin far above rounding errors keeps ties exact.

    Result, one row per kept vector: id, cluster, distance (squared), cluster_inertia
    and inertia (sums of distances), centroid_sha256. Repeated rows count each; of
    equal hashes the smaller vector comes first; a null id hashes as empty text and
    stays null. Fewer vectors than centroids make fewer clusters; without vectors
    there are no rows.
    Components of any finite size are handled exactly; a distance or sum above 64 bits is null.
    """
    value = F.col(f"`{vector_col}`")
    # Multiplying by a power of two and taking the floor is exact in doubles, whose size has no bound of its own.
    grown = F.transform(value, lambda x: x.cast("double") * scale)
    top = F.lit(1.7976931348623157e308)
    fine = (F.size(value) == size) & F.forall(value, lambda x: F.coalesce((F.abs(x.cast("double")) <= top / scale), F.lit(False)))
    whole = F.transform(grown, lambda x: F.when(F.abs(x) < 2.0**52, F.floor(x).cast("double")).otherwise(x))  # above, doubles are integers
    read = table.where(F.coalesce(fine, F.lit(False))).select(F.col(f"`{id_col}`").cast("long").alias("_id"), whole.alias("_v"))
    named = F.sha2(F.concat(F.lit(f"{seed}:"), F.coalesce(F.col("_id").cast("string"), F.lit(""))).cast("binary"), 256)
    first = read.withColumn("_h", named).orderBy("_h", "_v").limit(clusters).select("_v").collect()  # as many rows as clusters
    centroids = [[int(x) for x in r["_v"]] for r in first]
    simplex = Simplex.of(np.array(centroids, float).reshape(len(centroids), size), pivots)
    kept = staged(read.mapInArrow(_apex_rows(simplex), "_id long, _v array<double>, _apex array<double>"))
    for _ in range(rounds):
        centroids = _moved(kept, centroids, simplex)
    kinds = "vec_id long, cluster int, _distance string, centroid_sha256 string"
    found = staged(kept.mapInArrow(_assigned_rows(centroids, simplex), kinds))
    exact = F.expr("try_cast(_distance AS decimal(38, 0))")
    sums = found.groupBy(F.col("cluster").alias("_c")).agg(F.try_sum(exact).alias("_inertia"), F.count(exact).alias("_known"), F.count("*").alias("_n"))
    own = F.when(F.col("_known") == F.col("_n"), F.col("_inertia"))
    every = Window.partitionBy(F.lit(0))  # of one row a centroid
    known = sums.withColumn("_inertia", own)
    known = known.select("_c", "_inertia", F.when(F.count("_inertia").over(every) == F.count("*").over(every), F.try_sum("_inertia").over(every)).alias("_all"))
    return found.join(F.broadcast(known), F.col("cluster") == F.col("_c")).select(
        F.col("vec_id").alias(id_col), "cluster", F.expr("try_cast(_distance AS bigint)").alias("distance"),
        F.expr("try_cast(_inertia AS bigint)").alias("cluster_inertia"), F.expr("try_cast(_all AS bigint)").alias("inertia"), "centroid_sha256",
    )

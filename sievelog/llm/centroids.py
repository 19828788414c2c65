"""Lloyd's rounds over whole-number vectors, each vector's nearest centroid found by the threshold algorithm.

For every dimension the centroids are sorted by their value. A vector walks each list outward from its own value, nearer
entries first; a centroid that it meets for the first time is compared exactly. What no list has shown yet is in every
dimension at least as far as that list's next entry, so once the squares of those frontier distances sum to strictly more
than the best exact distance, no centroid that is left can win or tie.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from math import floor

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import Scratch, carried

#: Components of a smaller size, and sums of some thousands of them, are exact as doubles and as 64-bit whole numbers.
SMALL = 1 << 50
#: Bits of the parts that sums travel in.
LIMB = 90
LONGEST = 2**63 - 1
RESULTS = ("cluster", "distance", "cluster_inertia", "inertia", "centroid_sha256")


def grid(vectors: np.ndarray, scale: int) -> np.ndarray:
    """floor(scale * x) of each component: 64-bit whole numbers, or Python's where one is too large for them."""
    scaled = np.floor(vectors * scale) if len(vectors) and np.abs(vectors).max() < SMALL / scale else None
    if scaled is not None or not len(vectors):
        return (vectors if scaled is None else scaled).astype(np.int64)
    whole = lambda x: int(x) * scale if abs(x) >= 2.0**53 else floor(x * scale)
    return np.array([[whole(x) for x in row] for row in vectors.tolist()], object)


def nearest(x: np.ndarray, centroids: list[list[int]]) -> tuple[np.ndarray, np.ndarray]:
    """Number of each row's nearest centroid (of equally near ones the smallest) and its squared distance."""
    k, dims = len(centroids), x.shape[1]
    widest = 2 * max([int(np.abs(x).max(initial=0)), *(abs(v) for c in centroids for v in c)])
    exact = np.int64 if dims * widest**2 <= LONGEST else object
    table = np.array(centroids, exact)
    x = x.astype(exact)
    order = np.array([sorted(range(k), key=lambda i: (centroids[i][d], i)) for d in range(dims)]).T
    lists = np.take_along_axis(table, order, 0)
    beyond = LONGEST if exact is np.int64 else 1 << 4200
    columns = np.arange(dims)
    high = sum(((lists[i] < x).astype(np.int64) for i in range(k)), np.zeros(x.shape, np.int64))
    low = high - 1
    seen = np.zeros((len(x), k), bool)
    best, who = np.full(len(x), beyond, exact), np.full(len(x), k)

    def gaps(rows: np.ndarray, low: np.ndarray, high: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        below = np.where(low >= 0, x[rows] - lists[np.maximum(low, 0), columns], beyond)
        above = np.where(high < k, lists[np.minimum(high, k - 1), columns] - x[rows], beyond)
        return below, above

    active = np.arange(len(x))
    while len(active):
        down, up = low[active], high[active]
        below, above = gaps(active, down, up)
        lower = below <= above
        met = np.zeros((len(active), k), bool)
        np.put_along_axis(met, order[np.where(lower, down, up), columns], True, 1)
        fresh = met & ~seen[active]
        seen[active] |= met
        for c in np.flatnonzero(fresh.any(0)):
            rows = active[fresh[:, c]]
            apart = x[rows] - table[c]
            distance = (apart * apart).sum(1)
            wins = (distance < best[rows]) | ((distance == best[rows]) & (c < who[rows]))
            best[rows[wins]], who[rows[wins]] = distance[wins], c
        low[active], high[active] = down - lower, up + ~lower
        left = active[~seen[active].all(1)]  # with a centroid left, every list still has an entry
        frontier = np.minimum(*gaps(left, low[left], high[left]))
        active = left[~((frontier * frontier).sum(1) > best[left])]
    return who, best


def limbs(total: int) -> Iterator[tuple[int, int]]:
    """(place, part) of a whole number in parts of 90 bits, so that sums of parts fit in a decimal; small numbers have one."""
    place = 0
    while not -(1 << LIMB) < total < 1 << LIMB:
        yield place, total & ((1 << LIMB) - 1)
        total, place = total >> LIMB, place + 1
    yield place, total


def cluster_vectors(vectors: DataFrame, key: str = "vec_id", column: str = "embedding", dims: int = 64, k: int = 16, rounds: int = 3, scale: int = 64, seed: str = "1") -> DataFrame:
    """(key, cluster int, distance long, cluster_inertia long, inertia long, centroid_sha256 string) of every vector with
    exactly ``dims`` components, none of them null or not finite.

    A component x counts as floor(scale * x). Centroids start as the ``k`` vectors with the smallest hash of seed and key
    (of one key's repeated rows the smaller vector first; null keys last), fewer if there are fewer. In each round every
    vector goes to its nearest centroid, of equally near ones to that of the smaller number, and centroids with vectors
    move to the floor of the mean. Repeated rows count each; no vectors, no rows; further columns are ignored, a key
    named like a result is refused. A distance beyond a long is null, and so
    are the sums that it enters.

    Each round reads the vectors where they lie. Tasks send sums and counts by cluster and dimension, which are added up in
    a shuffle; the driver gets k times dims of them, and keeps nothing else.
    """
    if key.lower() in RESULTS:
        raise ValueError(f"the key is named like a result: {key}")
    spark = vectors.sparkSession
    scratch = Scratch(spark, "clusters")
    x = F.col("vector")
    source = vectors.select(F.col(key).alias("id"), F.col(column).cast("array<double>").alias("vector"))
    odd = lambda v: v.isNull() | F.isnan(v) | (F.abs(v) == float("inf"))
    rows = scratch.save(source.filter((F.size(x) == dims) & ~F.exists(x, odd)), "vectors")
    digest = F.sha2(F.concat(F.lit(f"{seed}:"), F.col("id").cast("string")), 256)
    chosen = rows.select(digest.alias("h"), "vector").orderBy(F.col("h").asc_nulls_last(), "vector").limit(k).collect()
    centroids = grid(np.array([r.vector for r in chosen], float).reshape(-1, dims), scale).tolist()
    schema = f"id {rows.schema['id'].dataType.simpleString()}, cluster int, distance long"
    if not centroids:
        none = spark.createDataFrame([], f"{schema}, cluster_inertia long, inertia long, centroid_sha256 string")
        return none.withColumnRenamed("id", key)

    def matrices(batches: Iterator[pd.DataFrame], name: str) -> Iterator[tuple[pd.DataFrame, np.ndarray]]:
        for batch in batches:
            for lo in range(0, len(batch), 2048):
                part = batch.iloc[lo : lo + 2048]
                yield part, grid(np.stack(part[name].to_numpy()), scale)

    def sums_by(centroids: list[list[int]]):
        def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
            counts, sums = [0] * k, [[0] * dims for _ in range(k)]
            for _, block in matrices(batches, "vector"):
                cluster, _ = nearest(block, centroids)
                for c in np.unique(cluster).tolist():
                    mine = block[cluster == c]
                    counts[c] += len(mine)
                    sums[c] = [a + b for a, b in zip(sums[c], mine.sum(0).tolist(), strict=True)]
            found = [(c, d, place, str(part), counts[c]) for c in range(k) if counts[c] for d in range(dims) for place, part in limbs(sums[c][d])]
            yield pd.DataFrame(found, columns=["cluster", "dim", "place", "part", "n"])

        return run

    for _ in range(rounds):
        partial = rows.select("vector").mapInPandas(sums_by(centroids), "cluster int, dim int, place int, part string, n long")
        added = partial.groupBy("cluster", "dim", "place").agg(F.sum(F.col("part").cast("decimal(38,0)")).alias("part"), F.sum("n").alias("n")).collect()
        totals: dict[tuple[int, int], int] = {}
        counts: dict[int, int] = {}
        for r in added:
            totals[r.cluster, r.dim] = totals.get((r.cluster, r.dim), 0) + (int(r.part) << (LIMB * r.place))
            counts[r.cluster] = max(counts.get(r.cluster, 0), r.n)
        centroids = [[totals[c, d] // counts[c] for d in range(dims)] if c in counts else old for c, old in enumerate(centroids)]

    def assign(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for part, block in matrices(batches, "vector"):
            cluster, distance = nearest(block, centroids)
            yield pd.DataFrame({"id": part["id"], "cluster": cluster, "distance": pd.array([d if d <= LONGEST else None for d in distance.tolist()], "Int64")})

    carried_id = rows.select(*carried(rows, ["id"]), "vector")
    assigned = carried_id.mapInPandas(assign, f"id {carried_id.schema['id'].dataType.simpleString()}, cluster int, distance long")
    assigned = scratch.save(assigned.withColumn("id", F.col("id").cast(rows.schema["id"].dataType)), "assigned")
    sums = {r.cluster: None if r.lost else int(r.s) for r in assigned.groupBy("cluster").agg(F.sum(F.col("distance").cast("decimal(38,0)")).alias("s"), F.max(F.col("distance").isNull()).alias("lost")).collect()}
    fits = lambda v: v if v is not None and v <= LONGEST else None
    total = fits(None if None in sums.values() else sum(sums.values()))
    sha = lambda c: hashlib.sha256(",".join(map(str, centroids[c])).encode()).hexdigest()
    each = spark.createDataFrame([(c, fits(s), total, sha(c)) for c, s in sorted(sums.items())], "cluster int, cluster_inertia long, inertia long, centroid_sha256 string")
    return assigned.join(F.broadcast(each), "cluster").select(F.col("id").alias(key), "cluster", "distance", "cluster_inertia", "inertia", "centroid_sha256")

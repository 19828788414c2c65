"""Embedding near-duplicates by product quantisation.

A coarse k-means gives inverted lists; what a vector differs from its list's centre by is coded per subspace. For each
query a table of distances from its subvectors to all code words gives the distance to every coded vector by lookups.
A vector probes each list whose plane (between that list's centre and its own) it is no farther from than half the
threshold's radius. Of two vectors within the radius, at least one is that near to the plane between their centres,
because their distances to it add up to no more than the radius; so no pair is missed, whatever its direction. A pair
that both probe counts from either end, one that only one probes counts for both there. A vector is a candidate if its
looked-up distance, less its own coding error, is within the radius. Candidates are compared by exact cosine in double
precision.

Equal vectors are collapsed before and counted after. Lists are dealt in blocks of bounded size, so a list that holds a
third of all vectors is many tasks, and a block returns counts and its own components, never its pairs.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import Scratch, connected


def kmeans(x: np.ndarray, k: int, rounds: int = 10, seed: int = 0) -> np.ndarray:
    draw = np.random.default_rng(seed)
    centres = x[draw.choice(len(x), min(k, len(x)), replace=False)].copy()
    for _ in range(rounds):
        near = np.argmin(((centres**2).sum(1) - 2 * x @ centres.T), axis=1)
        counts = np.bincount(near, minlength=len(centres))
        sums = np.zeros_like(centres)
        np.add.at(sums, near, x)
        centres = np.where(counts[:, None] > 0, sums / np.maximum(counts, 1)[:, None], centres)
    return centres


class Index:
    """Coarse centres and residual code books, fitted on a bounded sample; every vector can be coded by them."""

    def __init__(self, sample: np.ndarray, lists: int, parts: int = 8, codes: int = 64):
        self.centres = kmeans(sample, lists)
        rest = sample - self.centres[self.nearest(sample)]
        self.parts = np.array_split(np.arange(sample.shape[1]), min(parts, sample.shape[1]))
        self.books = [kmeans(rest[:, p], codes, seed=i + 1) for i, p in enumerate(self.parts)]

    def distances(self, x: np.ndarray) -> np.ndarray:
        return np.maximum(0, (x**2).sum(1)[:, None] + (self.centres**2).sum(1) - 2 * x @ self.centres.T)

    def nearest(self, x: np.ndarray) -> np.ndarray:
        return np.argmin(self.distances(x), axis=1)

    def code(self, x: np.ndarray, near: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Codes (n, parts) and the distance of each vector from what its codes stand for."""
        rest = x - self.centres[near]
        codes = np.stack([np.argmin((b**2).sum(1) - 2 * rest[:, p] @ b.T, axis=1) for p, b in zip(self.parts, self.books, strict=True)], axis=1).astype(np.uint8)
        made = np.concatenate([b[codes[:, i]] for i, b in enumerate(self.books)], axis=1)
        return codes, np.sqrt(((rest - made) ** 2).sum(1))

    def probes(self, x: np.ndarray, reach: float) -> list[np.ndarray]:
        """Lists of each vector: its own, and those from whose side of the plane between the two centres it is at most
        ``reach`` away."""
        d = self.distances(x)
        rows, near = np.arange(len(x)), np.argmin(d, axis=1)
        apart = np.sqrt(np.maximum(1e-300, self.distances(self.centres[near])))
        within = (d - d[rows, near][:, None]) / (2 * apart) <= reach + 1e-6
        within[rows, near] = True
        return [np.flatnonzero(r) for r in within]

    def table_distances(self, x: np.ndarray, centre: int, codes: np.ndarray) -> np.ndarray:
        """Asymmetric distances (queries, vectors) by table lookups, for vectors of one list."""
        rest = x - self.centres[centre]
        total = np.zeros((len(x), len(codes)))
        for i, (p, b) in enumerate(zip(self.parts, self.books, strict=True)):
            table = (rest[:, p] ** 2).sum(1)[:, None] + (b**2).sum(1) - 2 * rest[:, p] @ b.T
            total += table[:, codes[:, i]]
        return np.sqrt(np.maximum(0, total))


def unit(values) -> np.ndarray | None:
    """The vector at length one in double precision; None if it is null, empty, zero or not finite throughout."""
    if values is None or not len(values):
        return None
    x = np.array([np.nan if v is None else v for v in values], np.float64)
    top = np.abs(x).max() if np.isfinite(x).all() else 0.0
    if not top:
        return None
    x = x / top
    return x / np.sqrt(x @ x)


def matrix(vectors, dims: int) -> np.ndarray:
    """Vectors as rows, short ones filled up with zeros."""
    lengths = {len(v) // 8 for v in vectors}
    if lengths == {dims}:
        return np.frombuffer(b"".join(vectors), np.float64).reshape(-1, dims)
    out = np.zeros((len(vectors), dims))
    for i, v in enumerate(vectors):
        out[i, : len(v) // 8] = np.frombuffer(v)
    return out


def _block(index: Index, threshold: float, list_id: int, members: pd.DataFrame, queries: pd.DataFrame) -> tuple[np.ndarray, np.ndarray, list[tuple[int, int]]]:
    """Links to count for each query and for each member (copies counted), and the block's links as a forest."""
    dims = index.centres.shape[1]
    m, q = matrix(members["vec"], dims), matrix(queries["vec"], dims)
    codes = np.frombuffer(b"".join(members["codes"]), np.uint8).reshape(len(members), -1)
    radius = np.sqrt(2 - 2 * threshold)
    near = index.table_distances(q, list_id, codes) - members["error"].to_numpy()[None, :] <= radius + 1e-6
    near &= queries["dims"].to_numpy()[:, None] == members["dims"].to_numpy()[None, :]
    a, b = np.nonzero(near)
    linked = np.zeros(near.shape, bool)
    for lo in range(0, len(a), 100_000):
        i, j = a[lo : lo + 100_000], b[lo : lo + 100_000]
        linked[i, j] = (q[i] * m[j]).sum(1) >= threshold
    counts = linked @ members["copies"].to_numpy()
    # A member that doesn't probe the query's list has the link from here alone.
    probes = [np.frombuffer(p, np.int32) for p in members["probes"]]
    answers = np.zeros((len(members), len(index.centres)), bool)
    answers[np.repeat(np.arange(len(members)), [len(p) for p in probes]), np.concatenate(probes)] = True
    home = queries["home"].to_numpy()
    alone = linked & (home != list_id)[:, None] & ~answers[:, home].T
    for_members = queries["copies"].to_numpy() @ alone
    mid, qid = members["rep"].to_numpy(), queries["rep"].to_numpy()
    busy, hit = np.flatnonzero(linked.any(1)), np.flatnonzero(linked.any(0))
    linked, big = linked[np.ix_(busy, hit)], np.iinfo(np.int64).max
    label = mid[hit].copy()
    while len(hit):  # smallest name among all that the block connects
        of_query = np.minimum(np.where(linked, label[None, :], big).min(1), qid[busy])
        fresh = np.minimum(np.where(linked, of_query[:, None], big).min(0), label)
        if (fresh == label).all():
            break
        label = fresh
    links = [(int(x), int(y)) for x, y in zip(mid[hit], label, strict=True) if x != y]
    if len(hit):
        links += [(int(x), int(y)) for x, y in zip(qid[busy], of_query, strict=True) if x != y]
    return counts, for_members, links


def near_vectors(vectors: DataFrame, threshold: float = 0.95, sample: int = 20_000, lists: int | None = None, key: str = "vec_id", column: str = "embedding") -> DataFrame:
    """One row per input row: key, n_links (other vectors with a cosine of at least ``threshold``), component_id (smallest
    key reachable), kept (key = component_id).

    Vectors that are null, empty, zero, or hold a null or non-finite component link with nothing; nor do vectors of
    different lengths. Equal vectors link with each other. Rows that repeat a key count as vectors of their own; rows with
    a null key count as vectors and are named by no component that has another key. The index is fitted on about
    ``sample`` vectors chosen by hash, and holds all. ``lists``: by default the root of the number of vectors, at most an
    eighth of the sample; it changes the work, never the result. An empty table gives an empty table.
    """
    spark = vectors.sparkSession
    scratch = Scratch(spark, "pq")

    @F.pandas_udf("binary")
    def units(column: pd.Series) -> pd.Series:
        return pd.Series([None if (x := unit(v)) is None else x.tobytes() for v in column], dtype=object)

    vec = F.col(column).cast("array<double>")
    rows = scratch.save(vectors.select(F.col(key).alias("id"), units(vec).alias("vec")), "rows")
    good = rows.filter("vec IS NOT NULL")
    reps = good.groupBy("vec").agg(F.min("id").alias("first"), F.count("*").alias("copies"))
    reps = scratch.save(reps.select("*", F.xxhash64("vec").alias("rep"), (F.octet_length("vec") / 8).cast("int").alias("dims")), "reps")
    n, dims = reps.agg(F.count("*"), F.max("dims")).first()
    alone = lambda df: df.select(F.col("id").alias(key), F.lit(0).cast("long").alias("n_links"), F.col("id").cast("long").alias("component_id"), F.lit(True).alias("kept"))
    if not n:
        return alone(rows)
    share = min(1.0, sample / n)
    drawn = [bytes(r.vec) for r in reps.filter(F.pmod(F.xxhash64("rep"), F.lit(1 << 20)) <= int(share * (1 << 20))).select("vec").collect()]
    many = lists or max(1, min(sample // 8, round(n**0.5)))
    index = spark.sparkContext.broadcast(Index(matrix(drawn, dims) if drawn else np.zeros((1, dims)), many))
    radius = float(np.sqrt(2 - 2 * threshold))

    def code(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            for lo in range(0, len(batch), 512):
                part = batch.iloc[lo : lo + 512]
                x = matrix(part["vec"], dims)
                near = index.value.nearest(x)
                codes, error = index.value.code(x, near)
                probes = index.value.probes(x, radius / 2)
                yield part.assign(home=near, codes=[c.tobytes() for c in codes], error=error, lists=[p.tolist() for p in probes], probes=[p.astype(np.int32).tobytes() for p in probes])

    held = scratch.save(reps.select("rep", "dims", "copies", "vec").mapInPandas(code, "rep long, dims int, copies long, vec binary, home int, codes binary, error double, lists array<int>, probes binary"), "coded")
    one = held.select("rep", "dims", "copies", "vec", "home", F.col("home").alias("list"), F.lit(True).alias("member"), "codes", "error", "probes")
    none = F.lit(None).cast("binary")
    coded = one.union(held.select("rep", "dims", "copies", "vec", "home", F.explode("lists").alias("list"), F.lit(False).alias("member"), none.alias("codes"), F.lit(0.0).alias("error"), none.alias("probes")))
    sizes = coded.groupBy("list").agg(F.count_if("member").alias("members"), F.count_if(~F.col("member")).alias("queries"))
    # Blocks of a size that spreads the work over the shuffle's partitions, between 128 and 2048 rows.
    many = int(spark.conf.get("spark.sql.shuffle.partitions"))
    work = held.agg(F.sum(F.size("lists") + 1)).first()[0]
    block = max(128, min(2048, work // (4 * many)))
    sizes = scratch.save(sizes.select("list", F.ceil(F.col("members") / block).cast("int").alias("m_blocks"), F.ceil(F.col("queries") / block).cast("int").alias("q_blocks")).filter("m_blocks > 0"), "sizes")
    spot = lambda blocks: F.pmod(F.xxhash64("rep", F.lit(5)), F.col(blocks)).cast("int")
    dealt = coded.join(sizes, "list")
    m, q = F.sequence(F.lit(0), F.col("m_blocks") - 1), F.sequence(F.lit(0), F.col("q_blocks") - 1)
    both = F.when(F.col("member"), F.transform(q, lambda i: F.struct(spot("m_blocks").alias("m"), i.alias("q")))).otherwise(F.transform(m, lambda i: F.struct(i.alias("m"), spot("q_blocks").alias("q"))))
    dealt = dealt.withColumn("at", F.explode(both)).select("list", F.col("at.m").alias("mb"), F.col("at.q").alias("qb"), "rep", "dims", "copies", "vec", "home", "member", "codes", "error", "probes")

    def compare(group: pd.DataFrame) -> pd.DataFrame:
        members, queries = group[group["member"]], group[~group["member"]]
        if not len(members) or not len(queries):
            return pd.DataFrame({"a": [], "b": [], "n": []}).astype("int64")
        counts, for_members, links = _block(index.value, threshold, int(group["list"].iloc[0]), members, queries)
        told = for_members > 0
        ids = np.concatenate([queries["rep"].to_numpy(), members["rep"].to_numpy()[told]])
        a, b = np.array(links, np.int64).reshape(-1, 2).T
        return pd.DataFrame({"a": np.append(ids, a), "b": np.append(ids, b), "n": np.concatenate([counts, for_members[told], np.zeros(len(a), np.int64)])})

    found = scratch.save(dealt.groupBy("list", "mb", "qb").applyInPandas(compare, "a long, b long, n long"), "found")
    counts = found.filter("a = b").groupBy(F.col("a").alias("rep")).agg(F.sum("n").alias("n"))
    roots = connected(found.filter("a <> b").select("a", "b"), scratch)
    named = scratch.save(reps.select("rep", "first").join(roots.withColumnRenamed("node", "rep"), "rep", "left").withColumn("root", F.coalesce("root", "rep")), "named")
    tops = scratch.save(named.groupBy("root").agg(F.min("first").alias("top")), "tops")
    placed = scratch.save(named.join(tops, "root").join(counts, "rep").select("rep", "top", "n"), "placed")
    result = good.select("id", F.xxhash64("vec").alias("rep")).join(placed, "rep")
    result = result.select(F.col("id").alias(key), (F.col("n") - 1).cast("long").alias("n_links"), F.col("top").cast("long").alias("component_id"), F.coalesce(F.col("id") == F.col("top"), F.lit(True)).alias("kept"))
    return result.union(alone(rows.filter("vec IS NULL")))

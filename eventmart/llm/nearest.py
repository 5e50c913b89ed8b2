"""Approximate nearest neighbours by inner product: probed lists, scanned dimension by dimension.

One more coordinate, sqrt(M^2 - |x|^2), 0 for a query, makes the largest inner product the smallest distance. Vectors so
lengthened are rotated at random and put in lists, by the nearest of some centres fitted on a bounded sample. A query
visits the ``probes`` lists nearest to it, the very nearest first: its ``k``-th best score there is the radius that it takes along
to the others. In a list the distance grows by blocks of columns; after each block a candidate is abandoned if the
hypothesis that it lies within the query's present radius is rejected by the distance so far, which estimates the whole
one as rotated columns are alike: of d columns, c hold about c/d of a distance, with a relative error of its root near
sqrt((1 - c/d) / 2c). What survives all blocks is scored exactly, in double precision on the original vectors, and equal
scores are ordered by vec_id.

Every vector is in exactly one list. Lists are cut by numbers of stored rows into parts of about ``_PART`` vectors, and the queries
of a list into parts of about ``_QUERIES``; each pair of parts is a group of bounded size, however large a list is and
however often a row is repeated. A query that finds
fewer neighbours than there are, as its lists hold too few, visits all lists.

Null vectors, zero vectors, vectors with a null or non-finite component or of another than the most frequent dimension, and
rows without vec_id take no part. Repeated rows are candidates each; all rows of a query's vec_id are its own. A query with
several rows takes the smallest vector. Empty tables, or tables of one vector, give empty results.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from eventmart.llm.common import stored

LISTS = 1024  # at most
PROBES = 0.7  # share of the lists that a query visits; vectors without clusters need many
_LEAST_PROBES = 24
SAMPLE_BYTES = 32 << 20  # of the vectors that the centres are fitted on
_PART, _QUERIES = 4096, 2048
_BLOCK = 16  # columns
_CONFIDENCE = 2.0  # of the test, in standard errors of the estimate: a true neighbour's exceeds it rarely
_FIRST = 2  # lists that a query visits to find its radius
_ROWS, _ASKED = 1024, 64  # candidates and queries tested at a time


@dataclass
class Lists:
    """Centres of the lists, with what lengthens and rotates a vector."""

    norm: float
    rotation: np.ndarray
    centres: np.ndarray

    def turned(self, x: np.ndarray, is_query: bool) -> np.ndarray:
        """Vectors lengthened by a coordinate and rotated."""
        rest = np.zeros(len(x)) if is_query else np.sqrt(np.maximum(self.norm**2 - (x * x).sum(axis=1), 0))
        return (np.hstack([x, rest[:, None]]) @ self.rotation).astype(np.float32)

    def nearest(self, turned: np.ndarray, n: int) -> np.ndarray:
        """Numbers of the ``n`` lists nearest to each vector, the nearest first."""
        away = (self.centres**2).sum(axis=1) - 2 * turned @ self.centres.T
        return np.argsort(away, axis=1, kind="stable")[:, :n]


def usable(vectors: DataFrame, column: str = "embedding") -> DataFrame:
    """vec_id and vector (array of doubles) of the rows that take part."""
    vector = F.col(column).cast("array<double>")
    good = vectors.select("vec_id", vector.alias("vector")).where(
        F.col("vec_id").isNotNull() & F.col("vector").isNotNull() & (F.size("vector") > 0)
        & ~F.exists("vector", lambda v: v.isNull() | F.isnan(v) | (F.abs(v) == float("inf")))
        & F.exists("vector", lambda v: v != 0)
    )
    sizes = good.groupBy(F.size("vector").alias("size")).count().orderBy(F.desc("count"), F.desc("size")).head(1)
    return good.where(F.size("vector") == (sizes[0]["size"] if sizes else 0))


def _means(x: np.ndarray, k: int, rounds: int = 12) -> np.ndarray:
    rng = np.random.default_rng(7)
    centres = x[rng.choice(len(x), k, replace=False)].copy()
    for _ in range(rounds):
        own = (centres**2).sum(axis=1)
        near = np.concatenate([np.argmin(own - 2 * x[at : at + _ROWS] @ centres.T, axis=1) for at in range(0, len(x), _ROWS)])
        held = np.bincount(near, minlength=k)
        sums = np.zeros_like(centres)
        np.add.at(sums, near, x)
        centres = np.where(held[:, None] > 0, sums / np.maximum(held, 1)[:, None], centres)
    return centres


def fit(good: DataFrame) -> Lists | None:
    """Lists for the vectors of ``usable``; None if there are none."""
    squares = F.aggregate("vector", F.lit(0.0), lambda total, v: total + v * v)
    known = good.agg(F.count(F.lit(1)).alias("n"), F.sqrt(F.max(squares)).alias("norm"), F.max(F.size("vector")).alias("d")).head()
    if not known["n"]:
        return None
    d, sample = known["d"], max(64, SAMPLE_BYTES // (8 * known["d"]))
    rows = good.orderBy(F.xxhash64("vec_id", "vector"), "vec_id").limit(sample).select("vector").toArrow()
    rotation = np.linalg.qr(np.random.default_rng(11).standard_normal((d + 1, d + 1)))[0]
    lists = Lists(known["norm"] * (1 + 1e-9), rotation, np.zeros((1, d + 1), np.float32))
    values = rows["vector"].combine_chunks().flatten().to_numpy().reshape(-1, d)
    x = np.unique(lists.turned(values, is_query=False), axis=0)
    lists.centres = _means(x, max(1, min(LISTS, int(known["n"] ** 0.5), len(x) // 8)))
    return lists


def index(good: DataFrame, lists: Lists) -> DataFrame:
    """Every vector with its list: vec_id, vector, turned, list, and a number of its row in the stored table."""
    shared = good.sparkSession.sparkContext.broadcast(lists)

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            if len(batch):
                turned = shared.value.turned(np.stack(batch["vector"].to_list()), is_query=False)
                batch["turned"] = [t.tobytes() for t in turned]
                batch["list"] = shared.value.nearest(turned, 1)[:, 0].astype(np.int32)
                yield batch

    listed = good.mapInPandas(run, "vec_id long, vector array<double>, turned binary, list int")
    return stored(listed.withColumn("row", F.monotonically_increasing_id()), "vectors")


def _visits(queries: DataFrame, lists: Lists, probes: int) -> DataFrame:
    """Each query once for each list that it visits, with the list's place in the order of nearness."""
    shared = queries.sparkSession.sparkContext.broadcast(lists)

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            for at in range(0, len(batch), 512):
                part = batch.iloc[at : at + 512].copy()
                turned = shared.value.turned(np.stack(part["vector"].to_list()), is_query=True)
                part["turned"] = [t.tobytes() for t in turned]
                part["list"] = list(shared.value.nearest(turned, probes).astype(np.int32))
                yield part

    visiting = queries.mapInPandas(run, "query_id long, vector array<double>, turned binary, list array<int>")
    return visiting.select("query_id", "vector", "turned", F.posexplode("list").alias("place", "list"))


@dataclass
class Found:
    """The best candidates of some queries: number of the query, id and score; and how many pairs were scored whole."""

    query: np.ndarray
    ids: np.ndarray
    scores: np.ndarray
    scored: int = 0


def _best(found: Found, k: int) -> Found:
    """The ``k`` best of each query, best first."""
    order = np.lexsort((found.ids, -found.scores, found.query))
    query = found.query[order]
    first = np.searchsorted(query, query)  # where each query begins
    order = order[np.arange(len(order)) - first < k]
    return Found(found.query[order], found.ids[order], found.scores[order], found.scored)


def _survivors(turned: np.ndarray, q_turned: np.ndarray, radius: np.ndarray, left: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The pairs of queries and candidates, among those ``left``, that no block of columns rejects."""
    d = turned.shape[1]
    so_far = query = row = None
    for begin in range(0, d, _BLOCK):
        end = min(begin + _BLOCK, d)
        some, asked = turned[:, begin:end], q_turned[:, begin:end]
        if query is None:  # all pairs at once; later blocks are for those that are left
            so_far = (asked**2).sum(axis=1)[:, None] + (some**2).sum(axis=1) - 2 * asked @ some.T
            query, row = np.nonzero(left)
            so_far = so_far[query, row]
        else:
            gap = some[row] - asked[query]
            so_far = so_far + np.einsum("ij,ij->i", gap, gap)
        error = _CONFIDENCE * ((1 - end / d) / (2 * end)) ** 0.5
        stays = so_far <= radius[query] * ((1 + error) ** 2 * end / d)
        query, row, so_far = query[stays], row[stays], so_far[stays]
    return query, row


def scan(
    x: np.ndarray, turned: np.ndarray, ids: np.ndarray, q: np.ndarray, q_turned: np.ndarray, own: np.ndarray,
    least: np.ndarray, norm: float, k: int,
) -> Found:
    """The ``k`` best of a part for each of some queries, as far as they reach the ``least`` score known to be among its best."""
    least = least.copy()
    base = (q * q).sum(axis=1) + norm**2
    held = Found(np.zeros(0, np.int64), np.zeros(0, np.int64), np.zeros(0))
    for at in range(0, len(ids), _ROWS):
        rows = slice(at, at + _ROWS)
        radius = np.maximum(base - 2 * least, 0) * (1 + 1e-4) + 1e-6 * base
        query, row = _survivors(turned[rows], q_turned, radius, own[:, None] != ids[rows])
        if not len(query):
            continue
        held = _best(Found(
            np.concatenate([held.query, query]),
            np.concatenate([held.ids, ids[rows][row]]),
            np.concatenate([held.scores, (x[rows][row] * q[query]).sum(axis=1)]),
            held.scored + len(query),
        ), k)
        last = np.flatnonzero(np.bincount(held.query, minlength=len(q)) == k)
        ends = np.searchsorted(held.query, last, side="right") - 1
        least[last] = np.maximum(least[last], held.scores[ends])
    return held


def _scanned(vectors: DataFrame, visits: DataFrame, norm: float, k: int) -> DataFrame:
    """The best of each visited part, as far as they reach the query's ``least``: query_id, vec_id, score."""
    parts = vectors.groupBy("list").agg(F.ceil(F.count(F.lit(1)) / _PART).cast("int").alias("parts"))
    asked = visits.groupBy("list").agg(F.ceil(F.count(F.lit(1)) / _QUERIES).cast("int").alias("asked"))
    sizes = stored(parts.join(asked, "list"), "list-sizes")  # a row per list
    cut = lambda column, parts: F.pmod(F.xxhash64(column), F.col(parts)).cast("int")
    every = lambda n: F.explode(F.sequence(F.lit(0), F.col(n) - 1))
    left = vectors.join(sizes, "list").select(
        "list", cut("row", "parts").alias("part"), every("asked").alias("ask"), "vec_id", "vector", "turned"
    )
    right = visits.join(sizes, "list").select(
        "list", every("parts").alias("part"), cut("query_id", "asked").alias("ask"), "query_id", "vector", "turned", "least"
    )

    def run(some: pd.DataFrame, queries: pd.DataFrame) -> pd.DataFrame:
        out = [(np.zeros(0, np.int64), np.zeros(0, np.int64), np.zeros(0))]
        if len(some) and len(queries):
            x, ids = np.stack(some["vector"].to_list()), some["vec_id"].to_numpy(np.int64)
            turned = np.stack([np.frombuffer(b, np.float32) for b in some["turned"]])
            for at in range(0, len(queries), _ASKED):
                few = queries.iloc[at : at + _ASKED]
                own = few["query_id"].to_numpy(np.int64)
                q_turned = np.stack([np.frombuffer(b, np.float32) for b in few["turned"]])
                found = scan(
                    x, turned, ids, np.stack(few["vector"].to_list()), q_turned, own, few["least"].to_numpy(float), norm, k
                )
                out.append((own[found.query], found.ids, found.scores))
        columns = [np.concatenate(c) for c in zip(*out, strict=True)]
        return pd.DataFrame(dict(zip(("query_id", "vec_id", "score"), columns, strict=True)))

    keys = ["list", "part", "ask"]
    return left.groupBy(*keys).cogroup(right.groupBy(*keys)).applyInPandas(run, "query_id long, vec_id long, score double")


def _ranked(found: DataFrame, k: int) -> DataFrame:
    best = Window.partitionBy("query_id").orderBy(F.desc("score"), "vec_id")
    return found.withColumn("rank", F.row_number().over(best)).where(F.col("rank") <= k)


def _search(vectors: DataFrame, queries: DataFrame, lists: Lists, probes: int, k: int) -> DataFrame:
    """The ``k`` best of each query among the lists it visits: query_id, vec_id, score, rank."""
    visits = stored(_visits(queries, lists, probes), "visits")
    nothing = F.lit(float("-inf"))
    near = visits.where(F.col("place") < _FIRST).withColumn("least", nothing)
    first = stored(_ranked(_scanned(vectors, near, lists.norm, k), k), "first-neighbours")
    reached = first.where(F.col("rank") == k).select("query_id", F.col("score").alias("least"))
    far = visits.where(F.col("place") >= _FIRST).join(reached, "query_id", "left")
    far = stored(far.withColumn("least", F.coalesce("least", nothing)), "further-visits")
    return _ranked(first.drop("rank").unionByName(_scanned(vectors, far, lists.norm, k)), k)


def search(vectors: DataFrame, queries: DataFrame, k: int, column: str = "embedding") -> DataFrame:
    """The ``k`` nearest of ``vectors`` for each query (rows of the same vec_id excluded): query_id, rank, vec_id, score."""
    good = stored(usable(vectors, column), "usable")
    asked = usable(queries, column).groupBy(F.col("vec_id").alias("query_id")).agg(F.min("vector").alias("vector"))
    lists = fit(good)
    empty = good.sparkSession.createDataFrame([], "query_id long, rank int, vec_id long, score double")
    if lists is None:
        return empty
    asked = stored(asked.where(F.size("vector") == lists.rotation.shape[0] - 1), "queries")
    held = index(good, lists)
    probes = max(_LEAST_PROBES, round(PROBES * len(lists.centres)))
    found = stored(_search(held, asked, lists, probes, k), "neighbours")
    if probes < len(lists.centres):
        enough = found.where(F.col("rank") == k).select("query_id")
        short = stored(asked.join(enough, "query_id", "left_anti"), "short")
        if short.head(1):
            again = _search(held, short, lists, len(lists.centres), k)
            found = found.join(short, "query_id", "left_anti").unionByName(again.select(found.columns))
    return found.select("query_id", "rank", "vec_id", "score")

"""Approximate nearest neighbours over balanced posting lists.

Centroids are fitted on a bounded sample and kept balanced by splitting large
clusters.  Every vector is posted to its nearest centroid's list and, near a
boundary, to several.  A query walks an in-memory graph of the centroids from
near to nearer until all that is left is too far, keeps every list whose
centroid is not much farther than the nearest one, however many these are, and
is compared with every vector of those lists, in blocks.

``exact`` adds a second round, which reads every other list that can hold a
vector as near as the k-th found, by the triangle inequality.
"""

from __future__ import annotations

import heapq
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tillroll.llm.common import written

#: The centroids are fitted on at most about so many vectors, chosen by a hash of the id; every vector is indexed.
SAMPLE = 20_000
#: Vectors per list aimed at, and the most lists (the bound of what is sent to the tasks).
LIST_SIZE, MAX_LISTS = 256, 4096
#: A vector is posted to at most so many lists, those whose centroid is at most so much farther than the nearest.
REPLICAS, BOUNDARY = 4, 0.1
#: A query reads all lists within a ratio of its nearest centroid, and as many as hold MIN_POSTED vectors.  The ratio
#: is that with which so many of the sample's vectors find this share of their nearest in the sample; RATIO without one.
RATIO, TARGET, CALIBRATION, HELD_OUT = 0.13, 0.95, 256, 5
MIN_POSTED = 64
#: Links that a centroid makes in the graph, and how much farther than the lists it wants a walk looks for a way on.
LINKS, MARGIN = 24, 0.06
#: Vectors of a list that one group holds; a longer list is dealt over several groups.
BLOCK = 4096
NEAREST = 10


def usable(vector: Column, dimension: int) -> Column:
    """Of the right length, no null or non-finite component, not zero."""
    bad = F.exists(vector, lambda x: x.isNull() | F.isnan(x) | (F.abs(x) == float("inf")))
    return vector.isNotNull() & (F.size(vector) == dimension) & ~bad & F.exists(vector, lambda x: x != 0)


def _matrix(column: pa.Array, dimension: int) -> np.ndarray:
    return column.flatten().to_numpy(zero_copy_only=False).astype(np.float64).reshape(-1, dimension)


def squared(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    return np.maximum((a * a).sum(1)[:, None] + (b * b).sum(1) - 2 * (a @ b.T), 0.0)


def balanced_centroids(sample: np.ndarray, lists: int, rounds: int = 8, seed: int = 7) -> np.ndarray:
    """k-means whose clusters of more than twice the mean size are split, and whose smallest give way."""
    rng = np.random.default_rng(seed)
    sample = np.unique(sample, axis=0)
    lists = min(lists, len(sample))
    centres = sample[rng.permutation(len(sample))[:lists]]
    for _ in range(rounds):
        near = np.concatenate([np.argmin(squared(x, centres), axis=1) for x in np.array_split(sample, max(1, len(sample) // 4096))])
        size = np.bincount(near, minlength=len(centres))
        moved = [sample[near == k].mean(0) for k in np.flatnonzero(size)]
        size = size[size > 0]
        order = np.argsort(-size, kind="stable")
        centres = np.array(moved)
        large = [k for k in order if size[k] > 2 * len(sample) / lists]
        spare = lists - len(centres)
        small = [k for k in order[::-1] if size[k] * 8 < len(sample) / lists][: max(0, len(large) - spare)]
        extra = []
        for k in large[: spare + len(small)]:
            away = rng.normal(size=centres.shape[1])
            shift = away / np.linalg.norm(away) * 0.05 * (np.linalg.norm(centres[k]) + 1e-12)
            extra.append(centres[k] + shift)
        centres = np.array([c for k, c in enumerate(centres) if k not in set(small)] + extra)
    return centres


class Index:
    """The centroids, their graph, and how many vectors each list is the nearest of and how far from it the last of these is."""

    def __init__(self, centres: np.ndarray, ratio: float | None = None):
        self.centres, self.ratio = centres, RATIO if ratio is None else ratio
        self.posted = np.zeros(len(centres), np.int64)
        self.radius = np.zeros(len(centres))
        # Built by insertion: each centroid links both ways to its nearest among those before it, so all connect.
        links: list[set[int]] = [set() for _ in centres]
        for i in range(1, len(centres)):
            d = ((centres[:i] - centres[i]) ** 2).sum(1)
            for j in (np.argpartition(d, LINKS)[:LINKS] if i > LINKS else range(i)):
                links[i].add(int(j))
                links[int(j)].add(i)
        self.links = [np.array(sorted(x), np.int64) for x in links]

    def walk(self, q: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Best-first search of the graph: (distance, centroid) of those met, nearest first.

        It ends when the nearest centroid not yet left is beyond the ratio and
        its margin, and those before it hold ``MIN_POSTED`` vectors.
        """
        seen = np.zeros(len(self.centres), bool)
        seen[0] = True
        ahead = [(float(np.sqrt(((self.centres[0] - q) ** 2).sum())), 0)]
        met, nearest, held = [], ahead[0][0], 0
        while ahead:
            d, c = heapq.heappop(ahead)
            if d > (1 + self.ratio + MARGIN) * nearest and held >= MIN_POSTED:
                break
            met.append((d, c))
            held += int(self.posted[c])
            new = self.links[c][~seen[self.links[c]]]
            if len(new):
                seen[new] = True
                e = np.sqrt(((self.centres[new] - q) ** 2).sum(1))
                nearest = min(nearest, float(e.min()))
                for x in zip(e.tolist(), new.tolist()):
                    heapq.heappush(ahead, x)
        found = sorted(met)
        return np.array([x[0] for x in found]), np.array([x[1] for x in found], np.int64)

    def probes(self, queries: np.ndarray) -> list[np.ndarray]:
        """Lists that each query reads, nearest first: all met within the ratio, and enough to hold ``MIN_POSTED`` vectors."""
        out = []
        for q in queries:
            d, c = self.walk(q)
            before = np.cumsum(self.posted[c]) - self.posted[c]
            out.append(c[(d <= (1 + self.ratio) * d[0]) | (before < MIN_POSTED)])
        return out

    def unproven(self, queries: np.ndarray, kth: np.ndarray) -> list[np.ndarray]:
        """Lists that ``probes`` leaves out and that can hold a vector of their own as near as the query's k-th found."""
        d = np.sqrt(squared(queries, self.centres))
        slack = 1e-6 * (d + self.radius + np.sqrt((queries * queries).sum(1))[:, None])  # more than rounding
        can = (d - self.radius - slack <= kth[:, None]) & (self.posted > 0)
        for row, read in zip(can, self.probes(queries)):
            row[read] = False
        return [np.flatnonzero(row) for row in can]

    def lists(self, vectors: np.ndarray) -> list[np.ndarray]:
        """Lists to post each vector to, nearest first."""
        d = np.sqrt(squared(vectors, self.centres))
        k = min(len(self.centres), REPLICAS)
        near = np.argpartition(d, k - 1, axis=1)[:, :k]
        near = np.take_along_axis(near, np.argsort(np.take_along_axis(d, near, 1), axis=1, kind="stable"), 1)
        far = np.take_along_axis(d, near, 1)
        return [n[x <= (1 + BOUNDARY) * x[0]] for n, x in zip(near, far)]


def fitted_ratio(index: Index, sample: np.ndarray, share: float = 1.0, k: int = NEAREST, target: float = TARGET) -> float:
    """The ratio within which a list of a share ``target`` of the sample's neighbours lies.

    Of the table's ``k`` nearest the sample, a share of it, holds so many less;
    beyond that, neighbours in the table are nearer and easier to find.
    """
    k = max(1, round(k * share))
    asked = np.unique(np.linspace(0, len(sample) - 1, CALIBRATION).astype(int))
    needed = []
    for i in asked:
        d = squared(sample[i:i + 1], sample)[0]
        d[i] = np.inf
        near = np.argpartition(d, min(k, len(d) - 1))[:k]
        near = near[np.isfinite(d[near])]
        if len(near):
            to = np.sqrt(squared(sample[i:i + 1], index.centres)[0])
            needed += [to[c].min() / max(to.min(), 1e-300) - 1 for c in index.lists(sample[near])]
    return float(np.quantile(needed, target)) if needed else RATIO


def build(vectors: DataFrame, dimension: int) -> tuple[Index, DataFrame] | None:
    """The index and the postings ``list, vec_id, embedding, nearest, far`` of all vectors; None without vectors."""
    spark = vectors.sparkSession
    n = vectors.count()
    if not n:
        return None
    share = min(1.0, SAMPLE / n)
    hashed = F.pmod(F.xxhash64(F.lit("ann"), "vec_id"), F.lit(1 << 30))
    # About SAMPLE vectors of any number; the limit only guards the driver.
    rows = vectors.where(hashed <= int(share * (1 << 30))).select("vec_id", "embedding").limit(2 * SAMPLE).collect()
    sample = np.array([r["embedding"] for r in sorted(rows, key=lambda r: r["vec_id"])], np.float64)
    # Of a table beyond the sample, the ratio is fitted on vectors that the centroids have not seen, as most of its own are.
    held = sample[::HELD_OUT] if share < 1 else sample
    fitted = np.delete(sample, np.s_[::HELD_OUT], axis=0) if share < 1 else sample
    index = Index(balanced_centroids(fitted, int(min(MAX_LISTS, max(1, -(-n // LIST_SIZE))))))
    index.ratio = fitted_ratio(index, held, len(held) / n)
    sent = spark.sparkContext.broadcast(index)

    def post(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for a in range(0, batch.num_rows, 2048):
                part = batch.slice(a, 2048)
                given = _matrix(part.column(1), dimension)
                chosen = sent.value.lists(given)
                at = np.repeat(np.arange(len(chosen)), [len(c) for c in chosen])
                first = np.concatenate([np.arange(len(c)) == 0 for c in chosen])
                far = np.linalg.norm(given[at] - sent.value.centres[np.concatenate(chosen)], axis=1)
                copied = part.take(pa.array(at))
                yield pa.RecordBatch.from_arrays(
                    [pa.array(np.concatenate(chosen).astype(np.int32)), copied.column(0), copied.column(1), pa.array(first), pa.array(far)],
                    names=["list", "vec_id", "embedding", "nearest", "far"])

    kind = vectors.schema["embedding"].dataType.simpleString()
    postings = written(vectors.select("vec_id", "embedding").mapInArrow(
        post, f"list int, vec_id long, embedding {kind}, nearest boolean, far double"), "postings")
    return index, postings


def search(embeddings: DataFrame, is_query: Column, k: int = NEAREST, exact: bool = False) -> DataFrame:
    """The ``k`` nearest other rows of each query row: ``query_id, rank, vec_id, score`` (Euclidean distance).

    Vectors that are null or zero, that hold null or non-finite components, or
    whose length is not the table's most frequent one take no part, nor do
    null ids.  A row is known by its id: a query's own id is no candidate of
    it, and of repeated ids the nearest counts.  Ties go to the smaller id.  A
    query with fewer than ``k`` candidates gets them all; an empty table gives
    no rows.  Other columns are ignored.  ``exact`` finds the true nearest, at
    the price of reading most lists where vectors lie evenly in many dimensions.
    """
    spark = embeddings.sparkSession
    given = embeddings.select(F.col("vec_id").cast("long").alias("vec_id"), "embedding", is_query.alias("_op_q"))
    sizes = given.where("embedding IS NOT NULL AND size(embedding) > 0").groupBy(F.size("embedding").alias("d")).count()
    common = sizes.orderBy(F.desc("count"), "d").first()
    schema = "query_id long, rank int, vec_id long, score double"
    if common is None:
        return spark.createDataFrame([], schema)
    dimension = common["d"]
    vectors = given.where(usable(F.col("embedding"), dimension) & F.col("vec_id").isNotNull())
    built = build(vectors, dimension)
    if built is None:
        return spark.createDataFrame([], schema)
    index, postings = built
    # A row per list: at most MAX_LISTS.
    filled = postings.groupBy("list").agg(F.count(F.lit(1)).alias("n"), F.count(F.when(F.col("nearest"), 1)).alias("own"),
                                          F.max(F.when(F.col("nearest"), F.col("far"))).alias("radius"))
    filled = {r["list"]: (r["n"], r["own"], r["radius"] or 0.0) for r in filled.collect()}
    for c, (_, own, radius) in filled.items():
        index.posted[c], index.radius[c] = own, radius
    blocks = np.array([max(1, -(-filled.get(c, (0,))[0] // BLOCK)) for c in range(len(index.centres))])
    sent = spark.sparkContext.broadcast((index, blocks))

    def route(batches: Iterator[pa.RecordBatch], again: bool) -> Iterator[pa.RecordBatch]:
        """A row per query, list and block of the list; in the second round, of the lists that the k-th distance leaves."""
        index, blocks = sent.value
        for batch in batches:
            for a in range(0, batch.num_rows, 512):
                part = batch.slice(a, 512)
                asked = _matrix(part.column(1), dimension)
                found = index.unproven(asked, part.column(2).to_numpy(zero_copy_only=False)) if again else index.probes(asked)
                cells = [(i, c, b) for i, f in enumerate(found) for c in f for b in range(blocks[c])]
                if cells:
                    at, lists, inside = map(np.array, zip(*cells))
                    copied = part.take(pa.array(at))
                    yield pa.RecordBatch.from_arrays(
                        [pa.array(lists.astype(np.int32)), pa.array(inside.astype(np.int32)), copied.column(0), copied.column(1), copied.column(2)],
                        names=["list", "block", "query_id", "query", "most"])

    kind = vectors.schema["embedding"].dataType.simpleString()
    queries = vectors.where("_op_q").dropDuplicates(["vec_id", "embedding"]).select("vec_id", "embedding")
    routed = f"list int, block int, query_id long, query {kind}, most double"
    table = spark.createDataFrame([(c, int(b)) for c, b in enumerate(blocks)], "list int, _op_blocks int")
    dealt = postings.join(F.broadcast(table), "list")  # a row per list: at most MAX_LISTS
    dealt = dealt.select("list", F.pmod(F.xxhash64("vec_id"), F.col("_op_blocks")).cast("int").alias("block"), "vec_id", "embedding", "nearest")

    def compare(left: pa.Table, right: pa.Table) -> pa.Table:
        out: list[tuple[np.ndarray, ...]] = []
        if left.num_rows and right.num_rows:
            v = _matrix(right.column("embedding").combine_chunks(), dimension)
            ids = right.column("vec_id").to_numpy()
            repeated = len(np.unique(ids)) < len(ids)
            asked = left.column("query_id").to_numpy()
            most = left.column("most").to_numpy()
            for i, q, m in zip(asked, _matrix(left.column("query").combine_chunks(), dimension), most):
                d = np.sqrt(((v - q) ** 2).sum(1))
                d[(ids == i) | (d > m)] = np.inf  # farther than the k-th found changes nothing
                if len(d) > 4 * k and not repeated:
                    edge = np.partition(d, k - 1)[k - 1]
                    some = np.flatnonzero(d <= edge)
                else:
                    some = np.arange(len(d))
                some = some[np.isfinite(d[some])]
                some = some[np.lexsort((ids[some], d[some]))]
                some = some[np.sort(np.unique(ids[some], return_index=True)[1])][:k]
                out.append((np.full(len(some), i), ids[some], d[some]))
        columns = [np.concatenate(c) if out else np.zeros(0) for c in (zip(*out) if out else ((), (), ()))]
        return pa.table({"query_id": pa.array(columns[0].astype(np.int64)), "vec_id": pa.array(columns[1].astype(np.int64)),
                         "score": pa.array(columns[2].astype(np.float64))})

    def nearest(asked: DataFrame, among: DataFrame, again: bool) -> DataFrame:
        return asked.mapInArrow(lambda batches: route(batches, again), routed).groupBy("list", "block").cogroup(
            among.select("list", "block", "vec_id", "embedding").groupBy("list", "block")).applyInArrow(
            compare, "query_id long, vec_id long, score double")

    def ranked(near: DataFrame) -> DataFrame:
        near = near.groupBy("query_id", "vec_id").agg(F.min("score").alias("score"))
        rank = F.row_number().over(Window.partitionBy("query_id").orderBy("score", "vec_id"))
        return near.withColumn("rank", rank).where(F.col("rank") <= k).select("query_id", "rank", "vec_id", "score")

    no_most = F.lit(float("inf")).alias("_op_k")
    found = ranked(nearest(queries.select("vec_id", "embedding", no_most), dealt, False))
    if not exact:
        return found
    first = written(found, "nearest")
    kth = first.where(F.col("rank") == k).select(F.col("query_id").alias("vec_id"), F.col("score").alias("_op_k"))
    left = queries.join(kth, "vec_id", "left").select("vec_id", "embedding", F.coalesce("_op_k", F.lit(float("inf"))).alias("_op_k"))
    # Every vector is in the list of its nearest centroid, so only these need be read.
    return ranked(first.select("query_id", "vec_id", "score").unionByName(nearest(left, dealt.where("nearest"), True)))

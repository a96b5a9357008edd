"""Near duplicates by an n-gram Jaccard join with adaptive multi-match prefixes.

A text's set holds the 64-bit hashes of its distinct word shingles.  All sets
are ordered by one global order, rare shingles first; two sets of a Jaccard
similarity of at least t share l tokens within their first
``n - ceil(t * n) + l`` tokens, for every l.  Each text picks the l of least
estimated cost: a longer prefix is indexed, and a pair is verified only if it
shares as many prefix tokens as the smaller of both l.

Steps, each a Spark job over written tables:

1. a count sketch of all shingles, of fixed size, gives the global order; an
   over-count in it changes the order and never the result;
2. texts with equal sets become one class, so copies cost nothing further;
3. the classes' prefix tokens are shuffled by token; tokens of one class go;
4. hub rounds: each class is verified against the hub of its tokens that it
   shares most with, which joins a group of n near copies by about n checks;
5. all remaining pairs that can still be similar and are not yet known to be
   connected are verified, so no link between different components is lost.
   A pair is made at a shared token only if enough of both sets lies from
   there on, as it does at the first token that similar sets share, and falls
   out unmade where the set whose prefix ends first has too many prefix tokens
   that no other prefix has.  Pairs, of which there is then about one per link,
   count their shared prefix tokens on the prefixes themselves and fall out
   unverified where these are too few;
6. connected components of the verified links.
"""

from __future__ import annotations

import time
import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from tillroll.llm.common import own_columns, pieces_of, text_of, words_of, written

WORDS = 5
PERCENT = 75
#: The sketch's buckets, in bits, and the chunks it is merged in.  The tasks get one byte per bucket.
SKETCH_BITS, SKETCH_CHUNKS = 22, 64
#: A bucket is heavy beyond this count and this many times the mean bucket.
HEAVY, OVER_MEAN = 64, 4
#: The largest l, and what verifying a pair costs in index rows.
MOST_MATCHES, VERIFY_COST = 4, 16
HUB_ROUNDS = 3
#: A place in the global order, in an int: the token's level and so many leading bits of its hash.
PLACE_BITS = 25

_M1, _M2, _M3 = (np.uint64(x) for x in (0x9E3779B97F4A7C15, 0xBF58476D1CE4E5B9, 0x94D049BB133111EB))


def _mix(x: np.ndarray) -> np.ndarray:
    with np.errstate(over="ignore"):
        x = x + _M1
        x = (x ^ (x >> np.uint64(30))) * _M2
        x = (x ^ (x >> np.uint64(27))) * _M3
        return x ^ (x >> np.uint64(31))


def shingles(texts: pa.Array, words: int = WORDS) -> tuple[np.ndarray, np.ndarray]:
    """(text number, shingle hash), in order of text, repeats included.

    A text of fewer words has one shingle, of all its words; without words none.
    """
    import xxhash

    at, codes, dictionary = words_of(texts)
    by_code = np.fromiter((xxhash.xxh64_intdigest(w.encode()) for w in dictionary), np.uint64, len(dictionary))
    hashes = by_code[codes] if len(codes) else np.zeros(0, np.uint64)
    n = len(at)
    length = np.bincount(at, minlength=len(texts))
    start = np.cumsum(length) - length
    if n >= words:
        full = np.flatnonzero(at[words - 1:] == at[: n - words + 1])
        value = np.zeros(len(full), np.uint64)
        for k in range(words):
            value = _mix(value ^ hashes[full + k])
    else:
        full, value = np.zeros(0, np.int64), np.zeros(0, np.uint64)
    short = np.flatnonzero((length > 0) & (length < words))
    extra = np.zeros(len(short), np.uint64)
    for k in range(words - 1):
        has = length[short] > k
        extra[has] = _mix(extra[has] ^ hashes[start[short[has]] + k])
    extra = _mix(extra ^ length[short].astype(np.uint64))
    doc = np.r_[at[full], short]
    order = np.argsort(doc, kind="stable")
    return doc[order], np.r_[value, extra][order]


def sets(texts: pa.Array, words: int = WORDS) -> list[np.ndarray]:
    """Each text's distinct shingle hashes, sorted."""
    doc, value = shingles(texts, words)
    edge = np.searchsorted(doc, np.arange(len(texts) + 1))
    return [np.unique(value[a:b]) for a, b in zip(edge[:-1], edge[1:])]


def sketch(docs: DataFrame, words: int = WORDS) -> np.ndarray:
    """Level per bucket over all texts: 0 up to the heavy threshold, then one more per doubling.

    Every task counts into a fixed table and passes it on in chunks, which are
    summed by chunk; the driver gets one byte per bucket.
    """
    size, width = 1 << SKETCH_BITS, (1 << SKETCH_BITS) // SKETCH_CHUNKS

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        table = np.zeros(size, np.int64)
        for batch in batches:
            for a, b in pieces_of(batch, 0):
                _, value = shingles(batch.column(0).slice(a, b - a), words)
                table += np.bincount((value >> np.uint64(64 - SKETCH_BITS)).astype(np.int64), minlength=size)
        if table.any():
            kind = "<u2" if table.max() < 1 << 16 else "<i8"
            for k in range(SKETCH_CHUNKS):
                raw = zlib.compress(table[k * width:(k + 1) * width].astype(kind).tobytes(), 1)
                yield pa.RecordBatch.from_arrays([pa.array([k], pa.int32()), pa.array([kind]), pa.array([raw], pa.binary())],
                                                 names=["chunk", "kind", "raw"])

    def add(tables: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        sums: dict[int, np.ndarray] = {}
        for batch in tables:
            for k, kind, raw in zip(*(batch.column(i).to_pylist() for i in range(3))):
                sums[k] = sums.get(k, 0) + np.frombuffer(zlib.decompress(raw), kind).astype(np.int64)
        for k, s in sums.items():
            yield pa.RecordBatch.from_arrays([pa.array([k], pa.int32()), pa.array([s.tobytes()], pa.binary())], names=["chunk", "raw"])

    parts = docs.select(text_of("text").alias("text")).mapInArrow(count, "chunk int, kind string, raw binary")
    merged = parts.repartition(SKETCH_CHUNKS, "chunk").mapInArrow(add, "chunk int, raw binary")
    table = np.zeros(size, np.int64)
    for r in merged.collect():  # SKETCH_CHUNKS rows, of fixed size
        table[r["chunk"] * width:(r["chunk"] + 1) * width] = np.frombuffer(r["raw"], np.int64)
    limit = max(HEAVY, OVER_MEAN * table.mean())
    return np.where(table > limit, np.floor(np.log2(np.maximum(table, 1) / limit)) + 1, 0).astype(np.uint8)


def matches(levels: np.ndarray, n: int, need: int) -> int:
    """The l of least estimated cost for a set whose tokens, in order, have these levels.

    Cost: the index rows that the prefix's tokens lead to, and verifications,
    which fall with the square of the matches asked for.
    """
    rows = np.cumsum(np.where(levels > 0, HEAVY * 2.0 ** levels, 1.0))
    best, at = None, 1
    for m in range(1, min(MOST_MATCHES, need) + 1):
        scanned = rows[n - need + m - 1]
        cost = scanned * (1 + VERIFY_COST / m ** 2)
        if best is None or cost < best:
            best, at = cost, m
    return at


def _sets_table(docs: DataFrame, levels: np.ndarray, words: int, percent: int) -> DataFrame:
    """Per row: a row number, the set's size and 128-bit digest, its prefix in the global order and the place where that ends."""
    sent = docs.sparkSession.sparkContext.broadcast(levels)  # one byte per bucket
    shift = np.uint64(64 - SKETCH_BITS)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        import xxhash
        from pyspark import TaskContext

        level, row = sent.value, TaskContext.get().partitionId() << 33
        for batch in batches:
            for a, b in pieces_of(batch, 2):
                k = b - a
                prefix, most, last, digest = [], [], [], []
                found = sets(batch.column(2).slice(a, k), words)
                for s in found:
                    n = len(s)
                    digest.append(xxhash.xxh3_128_digest(s.tobytes()))
                    if not n:
                        prefix.append(s[:0].view(np.int64))
                        most.append(0)
                        last.append(0)
                        continue
                    need = -(-percent * n // 100)
                    lv = level[(s >> shift).astype(np.int64)]
                    order = np.argsort(lv, kind="stable")
                    m = matches(lv[order], n, need)
                    prefix.append(s[order[: n - need + m]].view(np.int64))
                    most.append(m)
                    end = order[n - need + m - 1]
                    last.append(int(lv[end]) << PLACE_BITS | int(s[end]) >> (64 - PLACE_BITS))
                offsets = np.r_[0, np.cumsum([len(p) for p in prefix])].astype(np.int32)
                yield pa.RecordBatch.from_arrays(
                    [pa.array(np.arange(row, row + k)), batch.column(0).slice(a, k), batch.column(1).slice(a, k),
                     pa.array([len(s) for s in found], pa.int64()), pa.array(digest, pa.binary()), pa.array(most, pa.int32()),
                     pa.array(last, pa.int32()), pa.ListArray.from_arrays(pa.array(offsets), pa.array(np.concatenate(prefix)))],
                    names=["row", "doc_id", "text_hash", "n", "digest", "matches", "last", "prefix"])
                row += k

    given = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.xxhash64(text_of("text")).alias("text_hash"),
                        text_of("text").alias("text"))
    return given.mapInArrow(run, "row long, doc_id long, text_hash long, n long, digest binary, matches int, last int, prefix array<long>")


def _overlap(n: str, n2: str, percent: int) -> Column:
    """The tokens that sets of these sizes must share."""
    return F.expr(f"({percent} * ({n} + {n2}) + {99 + percent}) div {100 + percent}")


def _of_first(last: str, last2: str, value: Column, value2: Column) -> Column:
    """The value of the set whose prefix ends first in the global order; the greater one if their ends are too near to tell."""
    return F.when(F.col(last) < F.col(last2), value).when(F.col(last) > F.col(last2), value2).otherwise(F.greatest(value, value2))


def _possible(percent: int, n: str, n2: str, bound: str, bound2: str, last: str, last2: str) -> Column:
    """Whether two sets can be similar enough, by the most tokens that they can share.

    Where a's prefix ends first, its prefix tokens that are in b are in b's
    prefix too: they are among those that some other prefix holds, and a's rest
    is all that b can share beyond.  The other way round this does not hold.
    """
    return _overlap(n, n2, percent) <= _of_first(last, last2, F.col(bound), F.col(bound2))


def _enough(percent: int) -> Column:
    """Whether sets a and b share as many prefix tokens as similar sets must.

    Of the set whose prefix ends first, all shared prefix tokens are in both
    prefixes, so what they must share beyond these lies in its rest.
    """
    rest = lambda n, m: F.expr(f"({percent} * {n} + 99) div 100") - F.col(m)
    return F.col("c") >= F.greatest(F.least("m", "m2"), _overlap("n", "n2", percent) - _of_first("last", "last2", rest("n", "m"), rest("n2", "m2")))


def _verified(pairs: DataFrame, texts: DataFrame, words: int, percent: int) -> DataFrame:
    """Of the pairs (a, b), those whose whole sets are similar enough."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            keep = []
            for i in range(0, batch.num_rows, 256):
                left = sets(batch.column(2).slice(i, 256), words)
                right = sets(batch.column(3).slice(i, 256), words)
                for x, y in zip(left, right):
                    both = len(np.intersect1d(x, y, assume_unique=True))
                    keep.append(100 * both >= percent * (len(x) + len(y) - both))
            some = np.flatnonzero(keep)
            if len(some):
                yield pa.RecordBatch.from_arrays([batch.column(0).take(pa.array(some)), batch.column(1).take(pa.array(some))],
                                                 names=["a", "b"])

    one = texts.select(F.col("node").alias("a"), F.col("text").alias("text_a"))
    two = texts.select(F.col("node").alias("b"), F.col("text").alias("text_b"))
    both = pairs.select("a", "b").join(one, "a").join(two, "b").select("a", "b", "text_a", "text_b")
    return both.mapInArrow(run, "a long, b long")


def _release(spark: SparkSession) -> None:
    """Let the driver collect its garbage, upon which Spark removes the shuffle files of finished steps."""
    import gc

    for _ in range(2):
        gc.collect()
        spark.sparkContext._jvm.System.gc()
        time.sleep(0.5)


def components(edges: DataFrame) -> DataFrame:
    """``node, label``: the smallest node that is reachable over the edges (a, b), for every node with an edge.

    Smallest labels of the neighbours and a shortcut to the label's label, until
    nothing changes.  Each round is written, so that plans stay short.
    """
    both = written(edges.select("a", "b").unionByName(edges.select(F.col("b").alias("a"), F.col("a").alias("b"))).distinct(), "edges")
    labels = written(both.groupBy(F.col("a").alias("node")).agg(F.least(F.col("node"), F.min("b")).alias("label")), "labels")
    while True:
        near = both.join(labels.select(F.col("node").alias("b"), F.col("label").alias("_l")), "b").groupBy("a").agg(F.min("_l").alias("_l"))
        lower = labels.join(near.withColumnRenamed("a", "node"), "node").select("node", F.col("label").alias("_old"), F.least("label", "_l").alias("label"))
        lower = written(lower, "labels")
        to = lower.select(F.col("node").alias("_to"), F.col("label").alias("_next"))
        labels = written(lower.join(to, F.col("label") == F.col("_to")).select("node", "_old", F.col("_next").alias("label")), "labels")
        if labels.where("label <> _old").limit(1).count() == 0:
            return labels.select("node", "label")


def near_duplicates(docs: DataFrame, words: int = WORDS, percent: int = PERCENT) -> DataFrame:
    """Per row: ``doc_id, n_shingles, component_id, text_hash`` and ``links`` (of its class to other classes found).

    Null, empty and blank texts have no shingles and are linked with nothing:
    their component is their own id.  Texts with fewer words than a shingle are
    one shingle.  Rows are linked by their sets, so repeated rows and rows that
    share an id are separate; a component's id is the smallest of its rows' ids,
    null if all are null.  An empty table gives no rows; other columns are
    ignored, whatever their names.  ``links`` counts verified links; pairs
    already known to be connected are not verified again.
    """
    spark = docs.sparkSession
    given = docs.select("doc_id", "text")
    table = written(_sets_table(given, sketch(given, words), words, percent), "sets")
    some = table.where("n > 0")
    # Classes of equal sets; the first row stands for the class.  Partial sums merge copies before the shuffle.
    classes = written(some.groupBy("digest").agg(
        F.min("row").alias("node"), F.min("doc_id").alias("least_id"),
        F.min(F.struct("row", "doc_id", "text_hash", "n", "matches")).alias("first")), "classes")
    classes = classes.select("digest", "node", "least_id", F.col("first.doc_id").alias("doc_id"),
                             F.col("first.text_hash").alias("text_hash"), F.col("first.n").alias("n"), F.col("first.matches").alias("matches"))
    prefixes = table.select("row", "last", "prefix").join(classes.select(F.col("node").alias("row"), "n", "matches"), "row")
    tokens = prefixes.select(F.posexplode("prefix").alias("pos", "token"), F.col("row").alias("node"), F.col("n").cast("int").alias("n"),
                             F.col("matches").cast("int").alias("m"), (F.col("n") - F.size("prefix")).cast("int").alias("rest"), "last")
    group = Window.partitionBy("token")
    index = tokens.withColumn("_n", F.count(F.lit(1)).over(group)).withColumn("least", F.min("m").over(group))
    index = written(index.where("_n > 1").drop("_n"), "tokens")
    _release(spark)
    # A class can only be in a pair if it shares as many tokens as it asks for, or as the least that one it meets asks for.
    # The texts of such classes are fetched once; a text is found by its id and hash, so repeated rows give one.
    doubtful = index.groupBy("node").agg(F.count(F.lit(1)).alias("_n"), F.first("m").alias("_m"), F.min("least").alias("_l"))
    doubtful = doubtful.where(F.col("_n") >= F.least("_m", "_l"))
    # What a set can share with one whose prefix ends later: its rest and its prefix tokens that some other prefix holds.
    index = written(index.drop("least").join(doubtful, "node").select(
        "token", "pos", "node", "n", "m", "last", (F.col("rest") + F.col("_n")).cast("int").alias("bound")), "index")
    doubtful = index.select("node").distinct()
    same_id = F.coalesce(F.col("doc_id").cast("string"), F.lit(""))
    wanted = classes.join(doubtful, "node").select("node", same_id.alias("_i"), F.col("text_hash").alias("_h"))
    keyed = given.select(same_id.alias("_i"), text_of("text").alias("text")).withColumn("_h", F.xxhash64("text"))
    texts = written(keyed.join(wanted, ["_h", "_i"]).dropDuplicates(["_h", "_i"]).select("node", "text"), "texts")
    _release(spark)

    links: list[DataFrame] = []
    known: DataFrame | None = None

    def with_known(rows: DataFrame) -> DataFrame:
        if known is None:
            return rows.withColumn("known", F.col("node"))
        return rows.join(known, "node", "left").withColumn("known", F.coalesce("label", "node")).drop("label")

    shared = ["node", "known", "n", "m", "bound", "last"]
    for r in range(HUB_ROUNDS):
        rows = with_known(index)
        # First the set that can share the largest part of itself, next to the original of a group; then others.
        order = [F.col("bound") / -F.col("n"), F.lit(0), F.xxhash64(F.lit(r), "node")][r % 3]
        # Partial minima before the shuffle; a token that many classes hold is split in the join.
        hubs = rows.groupBy("token").agg(F.min(F.struct(order.alias("o"), *shared)).alias("hub"))
        met = rows.join(hubs, "token").where((F.col("hub.known") != F.col("known")) & _possible(
            percent, "n", "hub.n", "bound", "hub.bound", "last", "hub.last"))
        met = met.groupBy(F.col("node").alias("a"), F.col("hub.node").alias("b")).agg(
            F.count(F.lit(1)).alias("c"), F.first(F.least("m", "hub.m")).alias("m")).where("c >= m")
        best = met.groupBy("a").agg(F.max_by("b", F.struct("c", "b")).alias("b"))
        found = written(_verified(best, texts, words, percent), "links")
        _release(spark)
        links.append(found)
        if not found.limit(1).count():
            break
        known = components(_all(links))
    shared.append("pos")
    left = with_known(index)
    right = left.select("token", *[F.col(c).alias(f"{c}2") for c in shared])
    # Similar sets share nothing before their first shared token, so all that they must share lies from its places on.
    room = F.least(F.col("n") - F.col("pos"), F.col("n2") - F.col("pos2"))
    pairs = left.join(right, (left.token == right.token) & (F.col("node") < F.col("node2")) & (F.col("known") != F.col("known2"))
                      & (_overlap("n", "n2", percent) <= room) & _possible(percent, "n", "n2", "bound", "bound2", "last", "last2"))
    pairs = written(pairs.select(F.col("node").alias("a"), F.col("node2").alias("b"), "n", "n2", "m", "m2", "last", "last2").distinct(), "pairs")
    sides = table.select("row", "prefix")
    counted = pairs.join(sides.withColumnRenamed("row", "a"), "a").join(sides.select(F.col("row").alias("b"), F.col("prefix").alias("prefix2")), "b")
    pairs = counted.withColumn("c", F.size(F.array_intersect("prefix", "prefix2"))).where(_enough(percent))
    links.append(written(_verified(pairs, texts, words, percent), "links"))
    labels = components(_all(links))

    ends = _all(links)
    degree = ends.select(F.explode(F.array("a", "b")).alias("node")).groupBy("node").agg(F.count(F.lit(1)).alias("links"))
    grouped = classes.select("digest", "node", "least_id").join(labels, "node", "left").withColumn("label", F.coalesce("label", "node"))
    ids = grouped.groupBy("label").agg(F.min("least_id").alias("component_id"))
    grouped = grouped.join(ids, "label").join(degree, "node", "left").select("digest", "component_id", F.coalesce("links", F.lit(0)).alias("links"))
    rows = table.select("doc_id", "text_hash", "n", "digest")
    out = rows.where("n > 0").join(grouped, "digest").select(
        "doc_id", F.col("n").alias("n_shingles"), "component_id", "text_hash", "links")
    alone = rows.where("n = 0").select("doc_id", F.col("n").alias("n_shingles"), F.col("doc_id").alias("component_id"), "text_hash",
                                       F.lit(0).cast("long").alias("links"))
    return out.unionByName(alone)


def _all(links: list[DataFrame]) -> DataFrame:
    out = links[0]
    for x in links[1:]:
        out = out.unionByName(x)
    return out


def one_of_each(docs: DataFrame, words: int = WORDS, percent: int = PERCENT) -> DataFrame:
    """The rows of ``docs``, columns unchanged, less all but one of each group of near duplicates: that of the smallest id.

    Of repeated rows with that id one stays; rows without words all stay.
    """
    own_columns(docs)
    found = near_duplicates(docs, words, percent).where("n_shingles > 0")
    same = (F.col("doc_id") == F.col("component_id")) | F.col("component_id").isNull()
    keep = found.where(same).groupBy(F.col("component_id").alias("_op_id")).agg(F.min("text_hash").alias("_op_th"))
    text = text_of("text")
    blank = ~text.rlike(r"[^\x20\x09-\x0D]")
    keyed = docs.withColumn("_op_h", F.xxhash64(text))
    kept = keyed.where(~blank).join(keep, (F.col("_op_h") == F.col("_op_th")) & F.col("doc_id").cast("long").eqNullSafe(F.col("_op_id")))
    kept = kept.dropDuplicates(["_op_h", "_op_id"]).select(*docs.columns)
    return kept.unionByName(docs.where(blank))

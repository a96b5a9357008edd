"""How sources of a language differ in their words, over hash-consed segment trees.

A language keeps the terms of at least three of its documents.  Each of its
(language, source) groups and the language itself give every kept term a
smoothed share in billionths; groups are compared term by term, exactly.

Terms get ids in order of falling frequency and are cut into blocks of
consecutive ids.  Within a block, a group's counts are the leaves of a segment
tree.  Trees are hash-consed: equal counts are one leaf and equal pairs of
children one inner node, so identical subtrees, such as long runs of terms
that two groups hold never or once, are one node for all groups.  Two trees
are walked together from their roots; at each level equal pairs of nodes are
merged and counted, so a pair of nodes is opened, and a pair of counts priced,
once for each pair of groups.

Blocks, and pairs of chunks of sources within a block, are independent tasks
of bounded size; their sums add up in Spark.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tillroll.llm.common import pieces_of, running_total, text_of, written
from tillroll.llm.ngrams import byte_class, words
from tillroll.operators.lookup import lookup

#: Documents of a language that a term must be in, and the terms listed per group.
LEAST_DOCUMENTS, LISTED = 3, 200
#: The unit of shares, and what every count is raised by.
UNIT, SMOOTHING = 1_000_000_000, 1
#: Terms of a tree, and sources about which a task compares with so many others.
BLOCK, CHUNK = 1024, 32


def term_counts(docs: DataFrame) -> DataFrame:
    """``lang, source, term, n, d``: occurrences and documents of each group's terms; null columns as empty."""
    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        letters = byte_class(digits=False)
        for batch in batches:
            for a, b in pieces_of(batch, 2, 8_000_000):
                part = batch.slice(a, b - a)
                found = words(part.column(2), letters)
                lang, source = part.column(0).dictionary_encode(), part.column(1).dictionary_encode()
                group = lang.indices.to_numpy().astype(np.int64) * len(source.dictionary) + source.indices.to_numpy()
                term = found.strings().dictionary_encode()
                kinds = max(len(term.dictionary), 1)
                # Each document's different terms with their counts, then summed by group.
                each, n = np.unique(found.text * kinds + term.indices.to_numpy(), return_counts=True)
                key = group[each // kinds] * kinds + each % kinds
                keys, at = np.unique(key, return_inverse=True)
                total = np.bincount(at, n, len(keys)).astype(np.int64)
                g, t = keys // kinds, keys % kinds
                yield pa.RecordBatch.from_arrays(
                    [lang.dictionary.take(pa.array(g // len(source.dictionary))), source.dictionary.take(pa.array(g % len(source.dictionary))),
                     term.dictionary.take(pa.array(t)), pa.array(total), pa.array(np.bincount(at, minlength=len(keys)))],
                    names=["lang", "source", "term", "n", "d"])

    given = docs.select(text_of("lang").alias("lang"), text_of("source").alias("source"), text_of("text").alias("text"))
    counted = given.mapInArrow(count, "lang string, source string, term string, n long, d long")
    return counted.groupBy("lang", "source", "term").agg(F.sum("n").alias("n"), F.sum("d").alias("d"))


class Trees:
    """Segment trees over the rows of a matrix of counts, with shared nodes; -1 stands for no term."""

    def __init__(self, counts: np.ndarray):
        width = 1 << max(counts.shape[1] - 1, 0).bit_length()
        padded = np.full((len(counts), width), -1, np.int64)
        padded[:, : counts.shape[1]] = counts
        self.values, nodes = np.unique(padded, return_inverse=True)
        nodes = nodes.reshape(padded.shape)
        #: Per level from the leaves up, each node's left and right child.
        self.children: list[tuple[np.ndarray, np.ndarray]] = []
        n = len(self.values)
        while nodes.shape[1] > 1:
            pair = nodes[:, ::2].astype(np.int64) * n + nodes[:, 1::2]
            own, nodes = np.unique(pair, return_inverse=True)
            nodes = nodes.reshape(pair.shape)
            self.children.append((own // n, own % n))
            n = len(own)
        self.roots = nodes[:, 0] if nodes.shape[1] else np.zeros(len(counts), np.int64)

    def pairs(self, one: int, others: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
        """The pairs of counts of row ``one`` and each of ``others``: (place in others, value's number, value's number, how often)."""
        of, a, b = np.arange(len(others)), np.full(len(others), self.roots[one]), self.roots[others]
        often = np.ones(len(others), np.int64)
        for left, right in reversed(self.children):
            of, often = np.r_[of, of], np.r_[often, often]
            a, b = np.r_[left[a], right[a]], np.r_[left[b], right[b]]
            n = int(max(a.max(initial=0), b.max(initial=0))) + 1
            key, at = np.unique((of * n + a) * n + b, return_inverse=True)
            often = np.bincount(at, often, len(key)).astype(np.int64)
            of, a, b = key // (n * n), key // n % n, key % n
        return of, a, b, often


def shares(values: np.ndarray, total: int, kept: int) -> np.ndarray:
    """The share of each count, in units; exact, as the product may pass 64 bits.  No term (-1) has none."""
    return np.array([0 if c < 0 else 1 + UNIT * (c + SMOOTHING) // (total + SMOOTHING * kept) for c in values.tolist()], np.int64)


def _price(p: np.ndarray, q: np.ndarray) -> np.ndarray:
    """floor((p - q)^2 / q), where there is a term; p and q are at most about a billion, so the square fits."""
    return np.where(q > 0, (p - q) * (p - q) // np.maximum(q, 1), 0)


def _tile(table: pa.Table) -> pa.Table:
    """Part sums of all pairs of groups between two chunks over one block of terms, and the first terms of each group."""
    lang, one, two = table.column("lang")[0].as_py(), table.column("c1")[0].as_py(), table.column("c2")[0].as_py()
    is_group = pc.is_null(table.column("term"))
    groups, terms = table.filter(is_group), table.filter(pc.invert(is_group)).combine_chunks()
    names = groups.column("source").to_pylist()  # of two chunks
    order = sorted(range(len(names)), key=lambda i: (names[i] is not None, names[i] or ""))  # the language itself first
    names = [names[i] for i in order]
    total, chunk = ([groups.column(c)[i].as_py() for i in order] for c in ("total", "chunk"))
    kept, width = groups.column("kept")[0].as_py(), len(terms)
    counts = np.zeros((len(names), width), np.int64)
    if width:
        cells = terms.column("cells").combine_chunks()
        flat = pc.list_flatten(cells)
        column = pc.list_parent_indices(cells).to_numpy()
        coded = flat.field("source").dictionary_encode()
        at = {name: i for i, name in enumerate(names)}
        row = np.array([at[x] for x in coded.dictionary.to_pylist()], np.int64)[coded.indices.to_numpy()]
        counts[row, column] = flat.field("n").to_numpy()
        if one == two:
            counts[0] = terms.column("n").to_numpy()
    trees = Trees(counts)
    p = np.array([shares(trees.values, t, kept) for t in total]).reshape(len(names), len(trees.values))
    sources, parts, items, values = [], [], [], []
    own = [i for i in range(len(names)) if names[i] is not None]
    for i in own:
        others = np.array([j for j in own if j > i and {chunk[i], chunk[j]} == {one, two}], np.int64)
        if len(others):
            of, a, b, often = trees.pairs(i, others)
            x, y = p[i, a], p[others[of], b]
            # The group's share against the other's, and the other way round.
            for left, right, price in (([names[i]] * len(others), [names[j] for j in others], _price(x, y)),
                                       ([names[j] for j in others], [names[i]] * len(others), _price(y, x))):
                value = np.zeros(len(others), np.int64)
                np.add.at(value, of, often * price)
                sources += left
                items += right
                parts += ["pair"] * len(others)
                values += value.tolist()
    if one == two and width:
        name = terms.column("term").combine_chunks()
        leaf = np.searchsorted(trees.values, counts)
        for i in own:
            some = np.flatnonzero(counts[i] > 0)
            # Each pair of leaves is priced once.
            pair, back = np.unique(leaf[i, some] * len(trees.values) + leaf[0, some], return_inverse=True)
            x, q = p[i, pair // len(trees.values)], p[0, pair % len(trees.values)]
            more, value = (x > q)[back], _price(x, q)[back]
            listed = pa.table({"v": value[more], "t": name.take(pa.array(some[more]))})
            listed = listed.take(pc.sort_indices(listed, [("v", "descending"), ("t", "ascending")])[:LISTED])
            sources += [names[i]] * len(listed)
            parts += ["term"] * len(listed)
            items += listed.column("t").to_pylist()
            values += listed.column("v").to_pylist()
    return pa.table([pa.array([lang] * len(sources), pa.string()), pa.array(sources, pa.string()), pa.array(parts, pa.string()),
                     pa.array(items, pa.string()), pa.array(values, pa.int64())], names=["lang", "source", "part", "item", "value"])


def _tiles(c: Column, n: Column) -> Column:
    """The pairs of chunks that rows of chunk c take part in; c is null for the language itself, which every chunk is compared with."""
    every = F.sequence(F.lit(0), n - 1)
    return F.explode(F.transform(every, lambda o: F.struct(
        F.least(F.coalesce(c, o), o).alias("c1"), F.greatest(F.coalesce(c, o), o).alias("c2"))))


def audit(docs: DataFrame, least_documents: int = LEAST_DOCUMENTS) -> DataFrame:
    """``lang, source, part, item, value, rank`` for every (lang, source) group of ``docs``.

    Part ``pair`` lists all other sources of the language by divergence; part
    ``term`` the 200 terms that mark the group most against its language.
    Null texts, languages and sources count as empty ones; a group without
    terms is compared all the same, and a language without kept terms has the
    value 0 for every pair.  Equal values are ranked by item in byte order.
    Rows are documents, so repeated rows count each; ids are not read.  Very
    long texts are counted whole.  An empty table gives no rows; other columns
    are ignored, whatever their names.
    """
    given = docs.select(text_of("lang").alias("lang"), text_of("source").alias("source"), text_of("text").alias("text"))
    # A row per kept term, with its count in each source that has it.
    kept = term_counts(given).groupBy("lang", "term").agg(
        F.sum("n").alias("n"), F.sum("d").alias("d"), F.collect_list(F.struct("source", "n")).alias("cells"))
    kept = written(kept.where(F.col("d") >= least_documents).select("lang", "term", "n", "cells", F.lit(1).cast("long").alias("one")), "kept")
    # Written: the sums over it are taken apart from the tiles.
    numbered = running_total(kept, [F.col("lang"), F.col("n").desc(), F.col("term")], "one", "id")
    numbered = numbered.select("lang", "term", "n", "cells", F.expr(f"id div {BLOCK}").alias("block"))

    groups = given.select("lang", "source").distinct()
    totals = kept.select("lang", F.explode("cells").alias("c")).groupBy("lang", "c.source").agg(F.sum("c.n").alias("total"))
    groups = written(groups.join(totals, ["lang", "source"], "left").select("lang", "source", F.coalesce("total", F.lit(0)).alias("total")), "groups")
    langs = groups.groupBy("lang").agg(F.expr(f"CAST((count(*) + {CHUNK - 1}) div {CHUNK} AS int)").alias("chunks"))
    langs = langs.join(kept.groupBy("lang").agg(F.count(F.lit(1)).alias("kept"), F.sum("n").alias("lang_total")), "lang", "left")
    langs = written(langs.select("lang", "chunks", F.coalesce("kept", F.lit(0)).alias("kept"), F.coalesce("lang_total", F.lit(0)).alias("lang_total")), "langs")
    n_langs = langs.count()

    def chunk(source: Column) -> Column:
        return F.pmod(F.xxhash64(source), F.col("chunks")).cast("int")
    members = lookup(groups, langs, ["lang"], "inner", n_langs).select("lang", "source", "total", "kept", "chunks", chunk(F.col("source")).alias("chunk"))
    itself = langs.select("lang", F.lit(None).cast("string").alias("source"), F.col("lang_total").alias("total"), "kept", "chunks", F.lit(None).cast("int").alias("chunk"))
    # The block -1 has no terms; it gives the pairs of languages without any.
    blocks = numbered.select("lang", "block").distinct().unionByName(langs.select("lang", F.lit(-1).cast("long").alias("block")))
    key = ["lang", "block", "c.c1", "c.c2"]
    heads = members.unionByName(itself).select("*", _tiles(F.col("chunk"), F.col("chunks")).alias("c")).join(blocks, "lang")
    null = lambda name, kind: F.lit(None).cast(kind).alias(name)
    heads = heads.select(*key, "source", "total", "kept", "chunk", null("term", "string"), null("n", "long"), null("cells", "array<struct<source:string,n:bigint>>"))
    # A term goes to every pair of chunks, with the cells of their sources.
    every = F.sequence(F.lit(0), F.col("chunks") - 1)
    both = F.flatten(F.transform(every, lambda a: F.transform(F.sequence(a, F.col("chunks") - 1), lambda b: F.struct(a.alias("c1"), b.alias("c2")))))
    placed = lookup(numbered, langs.select("lang", "chunks"), ["lang"], "inner", n_langs).select("*", F.explode(both).alias("c"))
    own = F.when(F.col("chunks") == 1, F.col("cells")).otherwise(
        F.filter("cells", lambda x: (chunk(x["source"]) == F.col("c.c1")) | (chunk(x["source"]) == F.col("c.c2"))))
    placed = placed.select(*key, null("source", "string"), null("total", "long"), null("kept", "long"), null("chunk", "int"), "term", "n", own.alias("cells"))
    tiles = heads.unionByName(placed).groupBy("lang", "block", "c1", "c2").applyInArrow(
        _tile, "lang string, source string, part string, item string, value long")
    tiles = written(tiles, "tiles")

    by = Window.partitionBy("lang", "source").orderBy(F.col("value").desc(), "item")
    columns = ["lang", "source", "part", "item", "value", F.row_number().over(by).alias("rank")]
    pair = tiles.where("part = 'pair'").groupBy("lang", "source", "part", "item").agg(F.sum("value").alias("value")).select(*columns)
    term = tiles.where("part = 'term'").select(*columns).where(F.col("rank") <= LISTED)
    return pair.unionByName(term)


#: Every group with every kept term, exactly, in 128-bit integers.
ORACLE = r"""
WITH docs AS (SELECT row_number() OVER () AS row, coalesce(lang, '') AS lang, coalesce(source, '') AS source,
  translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS text FROM documents),
words AS (SELECT row, lang, source, unnest(regexp_extract_all(text, '[^\x00-\x40\x5B-\x60\x7B-\x7F]+')) AS term FROM docs),
kept AS (SELECT lang, term FROM words GROUP BY ALL HAVING count(DISTINCT row) >= 3),
sizes AS (SELECT lang, count(*) AS v FROM kept GROUP BY lang),
groups AS (SELECT DISTINCT lang, source FROM docs),
counted AS (SELECT lang, source, term, count(*) AS n FROM words SEMI JOIN kept USING (lang, term) GROUP BY ALL),
cells AS MATERIALIZED (SELECT lang, source, term, coalesce(n, 0)::HUGEINT AS n FROM groups JOIN kept USING (lang) LEFT JOIN counted USING (lang, source, term)),
shares AS MATERIALIZED (SELECT lang, source, term, n, 1 + 1000000000::HUGEINT * (n + 1) // (sum(n) OVER (PARTITION BY lang, source) + v) AS p
  FROM cells JOIN sizes USING (lang)),
whole AS (SELECT lang, term, sum(n) AS n FROM cells GROUP BY ALL),
lang_shares AS (SELECT lang, term, 1 + 1000000000::HUGEINT * (n + 1) // (sum(n) OVER (PARTITION BY lang) + v) AS q FROM whole JOIN sizes USING (lang)),
sums AS (SELECT a.lang, a.source, b.source AS item, sum((a.p - b.p) * (a.p - b.p) // b.p) AS value
  FROM shares a JOIN shares b ON a.lang = b.lang AND a.term = b.term AND a.source <> b.source GROUP BY ALL),
pairs AS (SELECT a.lang, a.source, 'pair' AS part, b.source AS item, coalesce(value, 0) AS value
  FROM groups a JOIN groups b ON a.lang = b.lang AND a.source <> b.source
  LEFT JOIN sums ON sums.lang = a.lang AND sums.source = a.source AND sums.item = b.source),
terms AS (SELECT lang, source, 'term' AS part, term AS item, (p - q) * (p - q) // q AS value FROM shares JOIN lang_shares USING (lang, term) WHERE n > 0 AND p > q),
ranked AS (SELECT *, row_number() OVER (PARTITION BY lang, source, part ORDER BY value DESC, encode(item)) AS rank
  FROM (SELECT * FROM pairs UNION ALL SELECT * FROM terms))
SELECT lang, source, part, item, CAST(value AS BIGINT) AS value, CAST(rank AS INTEGER) AS rank FROM ranked WHERE part = 'pair' OR rank <= 200"""

"""Ranked lexical search by presence masks.

Documents become postings over the items' terms (one pass, written once). Each task then takes its postings in blocks:
bitmap operations give every document of the block the mask of an item's terms it holds, equal masks form a group, and
groups are evaluated by descending maximum score until no group left can enter the item's best. Tasks hand on their best
per item only.
"""

from __future__ import annotations

import math
from collections import Counter
from typing import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute  # noqa: F401
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..session import local_frame
from .common import LOWER, UPPER, free_memory, written

#: Bytes of item texts that one round searches; more items are searched in several rounds.
ROUND_BYTES = 4 << 20
#: Postings of a block: what a task holds at once beside one document.
BLOCK_POSTINGS = 1 << 21
#: Longer texts are split into terms a piece of about this many bytes at a time.
PIECE_BYTES = 1 << 20
#: Partial results of an item are merged in this many groups first.
MERGE_GROUPS = 32
#: Documents evaluated before the first look at the bound.
FIRST_LOOK = 64
#: Terms are runs of ASCII letters, digits and everything beyond ASCII; A-Z count as a-z.
TERM = r"[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+"
_BYTES = bytes(b + 32 if 65 <= b <= 90 else b if b >= 128 or chr(b).isalnum() else 32 for b in range(256))


def term_counts(text: bytes) -> Counter:
    """Occurrences of every term of a UTF-8 text."""
    text = text.translate(_BYTES)
    if len(text) <= PIECE_BYTES:
        return Counter(text.split())
    counts, start = Counter(), 0
    while start < len(text):
        stop = text.find(b" ", start + PIECE_BYTES)
        stop = len(text) if stop < 0 else stop
        counts.update(text[start:stop].split())
        start = stop
    return counts


def _postings(docs: DataFrame, vocabulary: dict[bytes, int]) -> DataFrame:
    """(id, n, terms, tfs) of the documents with terms: n counts all terms, the arrays hold those of the vocabulary."""

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        free_memory()
        for batch in batches:
            keep, lengths, ends, terms, tfs = [], [], [0], [], []
            for row, text in enumerate(batch.column(1).cast(pa.binary())):
                counts = term_counts(text.as_py()) if text.is_valid else ()
                if not counts:
                    continue
                keep.append(row)
                lengths.append(counts.total())
                for term in counts.keys() & vocabulary.keys():
                    terms.append(vocabulary[term])
                    tfs.append(counts[term])
                ends.append(len(terms))
            offsets = pa.array(ends, pa.int32())
            yield pa.RecordBatch.from_arrays(
                [batch.column(0).take(pa.array(keep, pa.int32())), pa.array(lengths, pa.int64()),
                 pa.ListArray.from_arrays(offsets, pa.array(terms, pa.int32())),
                 pa.ListArray.from_arrays(offsets, pa.array(tfs, pa.int64()))],
                names=["id", "n", "terms", "tfs"])

    schema = T.StructType([T.StructField("id", docs.schema["id"].dataType)] + T.StructType.fromDDL(
        "n long, terms array<int>, tfs array<long>").fields)
    return docs.select("id", "text").mapInArrow(count, schema)


class _Best:
    """The best documents of an item so far; equal scores by ascending id, null ids last."""

    def __init__(self, size: int) -> None:
        self.size, self.rows = size, []  # (-score, id is null, id)

    @property
    def least(self) -> int:
        """Score below which nothing enters any more."""
        return -self.rows[-1][0] if len(self.rows) == self.size else 1

    def add(self, scores: np.ndarray, ids: np.ndarray, missing: np.ndarray) -> None:
        enters = scores >= self.least
        if len(self.rows) == self.size:
            _, last_missing, last = self.rows[-1]
            equal = np.flatnonzero(scores == self.least)
            if last_missing:
                enters[equal] = ~missing[equal]
            else:
                enters[equal] = ~missing[equal] & (ids[equal] < last).astype(bool)
        at = np.flatnonzero(enters)
        if len(at):
            new = zip((-scores[at]).tolist(), missing[at].tolist(), ids[at].tolist())
            self.rows = sorted([*self.rows, *new])[:self.size]


class _Block:
    """Postings of some documents, by document and by term, with the score of each posting."""

    def __init__(self, ids, missing, n, offsets, terms, tfs, weights, corpus) -> None:
        documents, occurrences = corpus
        self.ids, self.missing, self.offsets, self.terms = ids, missing, offsets, terms
        slack = 50 + (50 * n * documents) // occurrences
        owner = np.repeat(np.arange(len(n)), np.diff(offsets))
        self.scores = weights[terms] * ((10**9 * tfs) // (1000 * tfs + 20 * slack[owner]))
        order = np.argsort(terms, kind="stable")
        self.owner = owner[order]
        self.starts = np.searchsorted(terms[order], np.arange(len(weights) + 1))
        filled = np.flatnonzero(np.diff(self.starts))
        self.most = np.zeros(len(weights), np.int64)
        if len(filled):
            self.most[filled] = np.maximum.reduceat(self.scores[order], self.starts[filled])
        self.member = np.zeros(len(weights), bool)

    def masks(self, terms: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Documents by mask of the item's terms: group of each document, and the maximum score of each group."""
        masks = np.zeros((-(-len(terms) // 64), len(self.ids)), np.uint64)
        for k, term in enumerate(terms.tolist()):
            masks[k >> 6, self.owner[self.starts[term]:self.starts[term + 1]]] |= np.uint64(1 << (k & 63))
        group = np.zeros(len(self.ids), np.int64)
        for row in masks:
            values, at = np.unique(row, return_inverse=True)
            group = np.unique(group * len(values) + at, return_inverse=True)[1]
        sample = np.unique(group, return_index=True)[1]
        bound = np.zeros(len(sample), np.int64)
        for k, term in enumerate(terms.tolist()):
            bound += self.most[term] * ((masks[k >> 6, sample] >> np.uint64(k & 63)) & np.uint64(1)).astype(np.int64)
        return group, bound

    def search(self, terms: np.ndarray, best: _Best) -> int:
        """Evaluate masks by descending maximum until none left can enter; the number of documents evaluated."""
        terms = terms[self.most[terms] > 0]
        if not len(terms) or self.most[terms].sum() < best.least:
            return 0
        group, bound = self.masks(terms)
        bound = bound[group]
        able = np.flatnonzero(bound >= best.least)
        able = able[np.argsort(-bound[able], kind="stable")]
        self.member[terms] = True
        done, step = 0, FIRST_LOOK
        while done < len(able) and bound[able[done]] >= best.least:
            at = able[done:done + step]
            first, size = self.offsets[at], self.offsets[at + 1] - self.offsets[at]
            begin = np.cumsum(size) - size
            places = np.arange(begin[-1] + size[-1]) + np.repeat(first - begin, size)
            scores = np.add.reduceat(np.where(self.member[self.terms[places]], self.scores[places], 0), begin)
            best.add(scores, self.ids[at], self.missing[at])
            done, step = done + len(at), step * 2
        self.member[terms] = False
        return done


def _blocks(batch: pa.RecordBatch) -> Iterator[pa.RecordBatch]:
    """Slices of about ``BLOCK_POSTINGS`` postings, or one document."""
    ends = np.cumsum(pa.compute.list_value_length(batch.column("terms")).to_numpy(zero_copy_only=False), dtype=np.int64)
    start, base = 0, 0
    while start < batch.num_rows:
        stop = max(start + 1, int(np.searchsorted(ends, base + BLOCK_POSTINGS, side="right")))
        yield batch.slice(start, stop - start)
        start, base = stop, int(ends[stop - 1])


def _searched(postings: DataFrame, items: list[np.ndarray], weights: np.ndarray, corpus: tuple[int, int], k: int) -> DataFrame:
    """(item, id, score): of each task the ``k`` best documents of each item, by its number."""
    kind = postings.schema["id"].dataType

    def search(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        free_memory()
        best, id_type = [_Best(k) for _ in items], None
        for whole in batches:
            id_type = whole.schema.field("id").type
            for batch in _blocks(whole):
                ids = batch.column("id")
                missing = ids.is_null().to_numpy(zero_copy_only=False)
                values = ids.fill_null("" if pa.types.is_string(id_type) else 0).to_numpy(zero_copy_only=False)
                terms, tfs = batch.column("terms"), batch.column("tfs")
                offsets = np.append(0, np.cumsum(pa.compute.list_value_length(terms).to_numpy(zero_copy_only=False), dtype=np.int64))
                block = _Block(values, missing, batch.column("n").to_numpy(), offsets, terms.flatten().to_numpy(),
                               tfs.flatten().to_numpy(), weights, corpus)
                for item, of in zip(items, best):
                    block.search(item, of)
        rows = [(number, None if null else value, -score) for number, of in enumerate(best) for score, null, value in of.rows]
        if rows:
            numbers, values, scores = zip(*rows)
            yield pa.RecordBatch.from_arrays(
                [pa.array(numbers, pa.int32()), pa.array(values, id_type), pa.array(scores, pa.int64())], names=["item", "id", "score"])

    schema = T.StructType([T.StructField("item", T.IntegerType()), T.StructField("id", kind), T.StructField("score", T.LongType())])
    return postings.mapInArrow(search, schema)


def _round(docs: DataFrame, items: dict[object, set[bytes]], k: int) -> DataFrame | None:
    """(item, id, score, rank) of one round's items, given as identifier -> terms."""
    spark = docs.sparkSession
    vocabulary = {term: number for number, term in enumerate(sorted(set().union(*items.values())))}
    postings = written(_postings(docs, vocabulary), "postings")
    documents, occurrences = postings.agg(F.count("*"), F.sum("n")).first()
    if not documents or not vocabulary:
        return None
    holding = postings.select(F.explode("terms").alias("term")).groupBy("term").count().collect()  # one row a term of the round
    weights = np.zeros(len(vocabulary), np.int64)
    for term, df in holding:
        weights[term] = math.floor(1000 * math.log((2 * documents + 2) / (2 * df + 1)))
    numbered = [np.array(sorted(vocabulary[t] for t in terms), np.int64) for terms in items.values()]
    found = _searched(postings, numbered, weights, (documents, occurrences), k)
    order = (F.col("score").desc(), F.col("id").asc_nulls_last())
    group = F.pmod(F.xxhash64("id", F.spark_partition_id()), F.lit(MERGE_GROUPS))
    place = F.row_number().over(Window.partitionBy("item", "group").orderBy(*order))
    some = found.withColumn("group", group).withColumn("rank", place).where(F.col("rank") <= k)
    place = F.row_number().over(Window.partitionBy("item").orderBy(*order))
    return written(some.withColumn("rank", place).where(F.col("rank") <= k).select("item", "id", "score", "rank"), "found")


def ranked_search(
    df: DataFrame, items: DataFrame, k: int = 50, id_col: str = "doc_id", text_col: str = "text",
    item_col: str = "item_id", item_text_col: str = "text",
) -> DataFrame:
    """The ``k`` best documents of each item: item id, rank (from 1), document id, score above 0.

    Terms, weights and scores are integers as stated for op12: rarer terms weigh more, longer documents dampen. Null and
    empty texts have no terms, and items without terms no result. Rows of ``items`` with one id (null is an id) are one
    item with the terms of all. Every row of ``df`` is a document, equal rows too; equal scores rank by ascending id, null
    ids last. Empty tables give no rows; other columns are not read. Ids are whole numbers or strings. Very long texts are
    split into terms piece by piece; a document's postings fit a task.

    The items are searched in rounds of about ``ROUND_BYTES`` of text, each against all documents; tasks get the terms of
    a round only. What is shuffled is at most ``k`` rows an item and task.
    """
    docs = df.select(F.col(f"`{id_col}`").alias("id"), F.col(f"`{text_col}`").cast("string").alias("text"))
    asked = items.select(F.col(f"`{item_col}`").alias("item_id"), F.col(f"`{item_text_col}`").cast("string").alias("text"))
    asked = asked.where("text IS NOT NULL")
    spark, kind = df.sparkSession, asked.schema["item_id"].dataType.simpleString()
    size = asked.agg(F.sum(F.octet_length("text").cast("long"))).first()[0] or 0
    rounds = max(1, -(-size // ROUND_BYTES))
    results = []
    for number in range(rounds):
        of_round = asked.where(F.pmod(F.xxhash64("item_id"), F.lit(rounds)) == number) if rounds > 1 else asked
        terms: dict[object, set[bytes]] = {}
        for row in of_round.toLocalIterator():
            terms.setdefault(row["item_id"], set()).update(term_counts(row["text"].encode()))
        if not terms:
            continue
        found = _round(docs, terms, k)
        if found is not None:
            names = local_frame(spark, list(enumerate(terms)), f"item int, item_id {kind}")
            results.append(found.join(F.broadcast(names), "item"))  # items of one round
    if not results:
        results.append(docs.limit(0).select(F.lit(0).cast(kind).alias("item_id"), F.lit(0).alias("rank"), "id", F.lit(0).cast("long").alias("score")))
    out = results[0]
    for more in results[1:]:
        out = out.unionByName(more)
    return out.select(F.col("item_id").alias(item_col), "rank", F.col("id").alias(id_col), "score")


def oracle(k: int = 50) -> str:
    """The same in DuckDB SQL."""

    def terms(text: str) -> str:
        return f"regexp_extract_all(translate(coalesce({text}, ''), '{UPPER}', '{LOWER}'), '{TERM}')"

    return f"""
WITH d AS (SELECT row_number() OVER () AS r, doc_id, {terms('text')} AS t FROM documents),
s AS (SELECT count(*) AS docs, sum(len(t))::BIGINT AS total FROM d WHERE len(t) > 0),
q AS (SELECT DISTINCT item_id, unnest({terms('text')}) AS term FROM benchmark),
p AS (SELECT r, term, count(*) AS tf FROM (SELECT r, unnest(t) AS term FROM d) WHERE term IN (SELECT term FROM q) GROUP BY ALL),
w AS (SELECT term, floor(1000 * ln((2 * any_value(docs) + 2)::DOUBLE / (2 * count(*) + 1)))::BIGINT AS w FROM p, s GROUP BY term),
m AS (SELECT r, doc_id, 50 + (50 * len(t) * docs) // total AS m FROM d, s WHERE len(t) > 0),
c AS (SELECT item_id, doc_id, r, sum(w * ((1000000000 * tf) // (1000 * tf + 20 * m)))::BIGINT AS score
      FROM q JOIN p USING (term) JOIN w USING (term) JOIN m USING (r) GROUP BY ALL),
k AS (SELECT item_id, row_number() OVER (PARTITION BY item_id ORDER BY score DESC, doc_id ASC NULLS LAST)::INTEGER AS rank, doc_id, score
      FROM c WHERE score > 0)
SELECT * FROM k WHERE rank <= {k}"""

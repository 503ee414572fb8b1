"""Exact duplicates by content sort.

Sampled splitters deal the normalised texts into ranges, Spark's external sort puts equal texts next to each other, and
a window that compares neighbours in full keeps one row of every run. Only built-in column functions.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .common import shuffle_parts, written

#: The characters that do not count, ``[\x20\x09-\x0D]``.
BLANKS = (" ", "\n", "\r", "\t", "\x0b", "\x0c")
#: Bytes of text that one range shall hold, where the session's number of partitions gives more.
RANGE_BYTES = 64 << 20
#: A text with more than 1 / (PIECES * ranges) of all rows or bytes is split over several ranges.
PIECES = 4
#: Leading bytes that order the texts; the digest goes on from there.
HEAD = 16


def squeezed(text: Column) -> Column:
    """The text without blanks; null as the empty text."""
    out = F.coalesce(text, F.lit(""))
    for blank in BLANKS:
        out = F.replace(out, F.lit(blank), F.lit(""))
    return out


def _frequent(rows: DataFrame, parts: int | None) -> tuple[DataFrame, int]:
    """(mark, pieces) of the texts that are too frequent for one range, and the number of ranges.

    One count per 64-bit mark, combined before the shuffle. At most ``2 * PIECES`` texts a range can be that frequent, so
    the table is bounded by the number of ranges.
    """
    counts = written(
        rows.groupBy("mark").agg(F.count("*").alias("n"), F.sum(F.octet_length("squeezed").cast("long")).alias("bytes")), "marks")
    total = counts.agg(F.sum("n").alias("n"), F.sum("bytes").alias("bytes")).first()
    n, size = total["n"] or 0, total["bytes"] or 0
    parts = parts or max(shuffle_parts(rows.sparkSession), -(-size // RANGE_BYTES))
    share = F.greatest(F.col("n") / F.lit(max(n, 1)), F.col("bytes") / F.lit(max(size, 1)))
    pieces = F.least(F.col("n"), F.ceil(share * F.lit(PIECES * parts)))
    return written(counts.where((share * F.lit(PIECES * parts) > 1) & (F.col("n") > 1)).select("mark", pieces.alias("pieces")), "frequent"), parts


def exact_copies(df: DataFrame, id_col: str = "doc_id", text_col: str = "text", parts: int | None = None) -> DataFrame:
    """Per input row: id, keep_id, group_size, kept, text_sha256.

    Texts are equal when they agree without blanks. Of equal texts the row with the most characters stays, then the one
    with the smallest id (null ids last); of rows equal in both, one. Null counts as the empty text, so null, empty and
    blank texts are one group. An empty table gives an empty result; other columns are not read. A text of any length is
    one row of the sort. ``df`` must return the same rows when it is read again (a table, not a random sample).

    Every whole text goes through the sort. The order is by leading bytes, then SHA-256, then the whole text: long common
    beginnings do not pile up in a range, and copies are told apart by comparing texts in full. Texts that fill more than
    a fraction of a range are dealt over several; the leaders of these pieces are compared in a second, small sort.
    """
    text = F.col(f"`{text_col}`")
    rows = df.select(
        F.col(f"`{id_col}`").alias("id"), F.coalesce(F.char_length(text), F.lit(0)).alias("chars"), squeezed(text).alias("squeezed"))
    rows = rows.withColumn("mark", F.xxhash64("squeezed"))
    frequent, parts = _frequent(rows, parts)
    piece = F.when(F.col("pieces") > 1, F.pmod(F.xxhash64(F.monotonically_increasing_id()), F.col("pieces")))
    # bounded by the number of ranges
    dealt = rows.join(F.broadcast(frequent), "mark", "left").select(
        "id", "chars", "squeezed", F.substring(F.encode("squeezed", "UTF-8"), 1, HEAD).alias("head"),
        F.unhex(F.sha2("squeezed", 256)).alias("digest"), F.coalesce(piece, F.lit(-1)).alias("piece"))
    dealt = dealt.repartitionByRange(parts, "head", "digest", "piece")

    best_first = (F.col("chars").desc(), F.col("id").asc_nulls_last())
    run = Window.partitionBy("head", "digest", "piece", "squeezed").orderBy(*best_first)
    whole = run.rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing)
    place = F.row_number().over(run)
    split = F.col("piece") >= 0
    runs = written(
        dealt.withColumns({"place": place, "keep": F.first("id").over(whole), "n": F.count("*").over(whole)})
        .withColumn("squeezed", F.when(split & (F.col("place") == 1), F.col("squeezed"))), "runs")

    # leaders of the pieces of one text: as many as pieces
    text_of = Window.partitionBy("digest", "squeezed").orderBy(*best_first, "piece")
    every = text_of.rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing)
    joined = runs.where(split & (F.col("place") == 1)).select(
        "digest", "piece", F.first("keep").over(every).alias("keep_all"), F.sum("n").over(every).alias("n_all"),
        (F.row_number().over(text_of) == 1).alias("leads"))
    done = runs.join(F.broadcast(joined), ["digest", "piece"], "left")
    many = F.col("n_all").isNotNull()
    return done.select(
        F.col("id").alias(id_col), F.when(many, F.col("keep_all")).otherwise(F.col("keep")).alias("keep_id"),
        F.coalesce("n_all", "n").alias("group_size"),
        ((F.col("place") == 1) & F.coalesce("leads", F.lit(True))).alias("kept"),
        F.lower(F.hex("digest")).alias("text_sha256"))


def oracle() -> str:
    """The same in DuckDB SQL."""
    return r"""
WITH d AS (SELECT doc_id, length(coalesce(text, '')) AS chars, regexp_replace(coalesce(text, ''), '[\x20\x09-\x0D]', '', 'g') AS t
           FROM documents)
SELECT doc_id, first_value(doc_id) OVER best AS keep_id, count(*) OVER (PARTITION BY t) AS group_size,
       row_number() OVER best = 1 AS kept, sha256(t) AS text_sha256
FROM d WINDOW best AS (PARTITION BY t ORDER BY chars DESC, doc_id ASC NULLS LAST)"""

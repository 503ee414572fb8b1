"""Training corpus from raw documents: language, near duplicates, repeated passages, source mix, tokens.

Each stage takes the documents its predecessor kept and returns documents; the last returns their pieces.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from riskframe.llm.common import discard, table, written
from riskframe.llm.jaccard import jaccard_components
from riskframe.llm.language import UNKNOWN, learning_sample, with_language
from riskframe.llm.mixing import mix_sources, take
from riskframe.llm.pieces import encode_pieces
from riskframe.llm.repeats import remove_repeats


def language(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Drop documents without a recognisable language; a missing ``lang`` becomes the predicted one.

    Null texts and texts without a letter go. Where no document has a ``lang`` to learn from, all others stay as they are.
    """
    samples = learning_sample(docs.select("lang", "text"))
    if not samples:
        return docs.where(F.rlike("text", F.lit(r"\p{L}")))
    found = with_language(docs, samples).where(F.col("lang_pred") != UNKNOWN)
    return found.withColumn("lang", F.coalesce("lang", "lang_pred")).select(*docs.columns)


def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of documents linked by five-word shingles of Jaccard similarity 0.8 or more, one row stays: that of the smallest
    id, rows without an id last. Rows are told apart by number, so a repeated or missing id neither keeps copies nor
    drops another text. Texts without words stay.
    """
    row = max(docs.columns, key=len) + "_"
    numbered = written(docs.withColumn(row, F.monotonically_increasing_id()), "numbered")
    components = jaccard_components(numbered.select(row, "text"), row, words=5, percent=80)
    by_id = F.struct(F.col("doc_id").isNull().alias("missing"), "doc_id", row)
    linked = written(components.select(row, "component_id").join(numbered.select(row, "doc_id"), row), "linked")
    first = linked.groupBy("component_id").agg(F.min(by_id)[row].alias("stays"))
    dropped = written(linked.join(first, "component_id").where(F.col(row) != F.col("stays")).select(row), "dropped")
    discard(linked)
    return numbered.join(dropped, row, "left_anti").select(*docs.columns)


def repeated_passages(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Cut what an earlier document has, in strings of 50 bytes or more; documents of which nothing is left go.

    Ids are integers; a missing id comes after all others. Null texts become empty ones and stay.
    """
    others = tuple(c for c in docs.columns if c not in ("doc_id", "text"))
    # positions instead of names: whatever the other columns are called
    names = [f"c{k}" for k in range(len(others))]
    left = remove_repeats(docs, keep=others, as_text=True).toDF("id", "n_bytes", "n_removed", "n_spans", "spans", "kept", *names)
    left = left.where((F.length("kept") > 0) | (F.col("n_removed") == 0))
    now = {**{c: F.col(k) for c, k in zip(others, names)}, "doc_id": F.col("id"), "text": F.col("kept")}
    now["n_chars"] = F.length("kept").cast("long")
    return left.select(*[now[c].alias(c) for c in docs.columns])


def source_mix(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Every document as often as the mix of sources takes it."""
    return take(docs, mix_sources(docs))


def tokens(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The pieces of every document; those that the mix took more than once are cut differently each time."""
    same = Window.partitionBy("doc_id", F.xxhash64("text")).orderBy("source", "lang", "n_chars")
    encoded = encode_pieces(docs.withColumn("nth", F.row_number().over(same)), keep=("lang", "source", "n_chars"), copy_col="nth")
    return encoded.select("doc_id", "lang", "source", "n_chars", "pieces")


STAGES = [
    ("language", language),
    ("near_duplicates", near_duplicates),
    ("repeated_passages", repeated_passages),
    ("source_mix", source_mix),
    ("tokens", tokens),
]

#: Trained and iterative stages have no SQL form; the tests compare them with brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over ``documents``."""
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES:
        docs = written(stage(spark, docs, sf_dir), f"stage-{name}")
    return docs

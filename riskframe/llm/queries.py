"""The queries of the dealt operators, each over its whole table with production parameters."""

from __future__ import annotations

from pyspark.sql import functions as F

from . import collocations, exact_copies, licences, ranked_search
from .catalog import register
from .common import table
from .jaccard import jaccard_components
from .language import identify_languages, learning_sample
from .mixing import mix_sources
from .near_vectors import near_vectors
from .neighbours import nearest_neighbours
from .pieces import decode_pieces, encode_pieces
from .quality import fit_quality, score_quality
from .repeats import remove_repeats
from .urls import filter_urls


def fold(modulus: int):
    """crc32 of the document's id as text, modulo ``modulus``: the folds of the learned operators."""
    return F.crc32(F.col("doc_id").cast("string")) % modulus


@register("op1_suffix_array_dedup")
def op1_suffix_array_dedup(spark, sf_dir):
    done = remove_repeats(table(spark, sf_dir, "documents"))
    return done.select("doc_id", "n_bytes", "n_removed", "n_spans", F.sha2("kept", 256).alias("kept_sha256"))


@register("op2_nearest_neighbours")
def op2_nearest_neighbours(spark, sf_dir):
    embeddings = table(spark, sf_dir, "embeddings")
    found = nearest_neighbours(embeddings, embeddings.where("vec_id % 100 = 0"))
    return found.select("query_id", "rank", F.col("neighbour").alias("vec_id"), "score")


@register("op3_language_id")
def op3_language_id(spark, sf_dir):
    documents = table(spark, sf_dir, "documents")
    held_out = fold(4) == 2
    samples = learning_sample(documents.where(~held_out).select("lang", "text"))
    return identify_languages(documents, samples).select("doc_id", held_out.alias("held_out"), "lang_pred", "score")


@register("op4_quality_classifier")
def op4_quality_classifier(spark, sf_dir):
    documents = table(spark, sf_dir, "documents")
    held_out = fold(5) == 0
    scored = score_quality(documents, fit_quality(documents, table(spark, sf_dir, "labels").where(~held_out)))
    return scored.select("doc_id", held_out.alias("held_out"), "score", (F.col("score") >= 0.3).cast("int").alias("predicted"))


@register("op5_near_vectors")
def op5_near_vectors(spark, sf_dir):
    return near_vectors(table(spark, sf_dir, "embeddings"))


@register("op6_jaccard_join")
def op6_jaccard_join(spark, sf_dir):
    return jaccard_components(table(spark, sf_dir, "documents"), words=4, percent=85)


@register("op7_sentencepiece")
def op7_sentencepiece(spark, sf_dir):
    encoded = encode_pieces(table(spark, sf_dir, "documents"))
    return decode_pieces(encoded).select(
        "doc_id", F.coalesce(F.size("pieces"), F.lit(0)).cast("long").alias("n_pieces"), F.xxhash64("pieces").alias("pieces_hash"),
        F.col("decoded").eqNullSafe(F.col("text")).alias("lossless"))


@register("op8_license_scan", licences.oracle())
def op8_license_scan(spark, sf_dir):
    return licences.scan_licences(table(spark, sf_dir, "documents"))


@register("op9_mix_sources")
def op9_mix_sources(spark, sf_dir):
    return mix_sources(table(spark, sf_dir, "documents"))


@register("op10_url_filter")
def op10_url_filter(spark, sf_dir):
    return filter_urls(table(spark, sf_dir, "pages"))


@register("op11_exact_copies", exact_copies.oracle())
def op11_exact_copies(spark, sf_dir):
    return exact_copies.exact_copies(table(spark, sf_dir, "documents"))


@register("op12_ranked_search", ranked_search.oracle())
def op12_ranked_search(spark, sf_dir):
    return ranked_search.ranked_search(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"), k=50)


@register("op13_collocations", collocations.oracle())
def op13_collocations(spark, sf_dir):
    return collocations.collocations(table(spark, sf_dir, "documents"))

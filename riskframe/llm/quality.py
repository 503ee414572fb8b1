"""Quality by compression: how much better a dictionary of good text compresses a document than one of bad text.

A zstandard dictionary is built from bounded samples of either class. Every document is compressed, whole, in
blocks of ``BLOCK`` bytes with both dictionaries; the difference of the compressed sizes over the document's bytes
is the only feature. A rising curve, fitted on other rows of the bounded sample by isotonic regression, turns it
into the probability of good text.
"""

from __future__ import annotations

from dataclasses import dataclass
from typing import Iterator

import numpy as np
import pyarrow as pa
import zstandard
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import slices, written

#: The learning sample: per class at most ``SAMPLE_TEXTS`` distinct texts, ``SAMPLE_CHARS`` characters of each; every
#: fourth of them calibrates, the others fill the dictionaries.
SAMPLE_TEXTS, SAMPLE_CHARS = 2048, 4000
BLOCK, LEVEL, DICTIONARY_BYTES = 1000, 3, 112 << 10
SLICE_BYTES = 4 << 20


@dataclass(frozen=True)
class QualityModel:
    """Two dictionaries, and the probability of good text at points of (bad - good) / bytes."""

    good: bytes
    bad: bytes
    points: tuple[float, ...]
    chances: tuple[float, ...]

    def score(self, x: np.ndarray) -> np.ndarray:
        """Calibrated chance; where the curve is flat, larger differences still score a trifle higher."""
        trifle = 0.001
        return (1 - trifle) * np.interp(x, self.points, self.chances) + trifle * (0.5 + np.arctan(20 * x) / np.pi)


_compressors: dict[tuple, tuple] = {}


def _compressor(dictionary: bytes) -> zstandard.ZstdCompressor:
    made = zstandard.ZstdCompressionDict(dictionary) if dictionary else None
    if made:
        made.precompute_compress(level=LEVEL)
    return zstandard.ZstdCompressor(level=LEVEL, dict_data=made, write_content_size=False, write_dict_id=False)


def compressors(model: QualityModel) -> tuple:
    """Of good and bad text, made once per Python worker."""
    key = (model.good, model.bad)
    if key not in _compressors:
        _compressors.clear()
        _compressors[key] = (_compressor(model.good), _compressor(model.bad))
    return _compressors[key]


def difference(text: str | None, good, bad) -> float:
    """(size under bad - size under good) / bytes, over all blocks of the whole text; 0 for no text."""
    data = memoryview((text or "").encode())
    total = 0
    for at in range(0, len(data), BLOCK):
        block = data[at:at + BLOCK]
        total += len(bad.compress(block)) - len(good.compress(block))
    return total / len(data) if len(data) else 0.0


def _dictionary(texts: list[str]) -> bytes:
    blocks = [t.encode()[at:at + BLOCK] for t in texts for at in range(0, len(t.encode()), BLOCK)]
    try:
        return zstandard.train_dictionary(DICTIONARY_BYTES, blocks).as_bytes()
    except zstandard.ZstdError:  # too little text to train on: the text itself is the dictionary
        return b"".join(blocks)[-DICTIONARY_BYTES:]


def _isotonic(x: np.ndarray, y: np.ndarray, share: float) -> tuple[tuple[float, ...], tuple[float, ...]]:
    """Probability of good as a rising curve of x: pooled neighbours, joined by straight lines between their means.

    Rows are weighted to the true share of good rows; equal x count as one point.
    """
    weight = np.where(y == 1, share / (y == 1).mean(), (1 - share) / (y == 0).mean())
    points, where = np.unique(x, return_inverse=True)
    w = np.bincount(where, weights=weight)
    good = np.bincount(where, weights=weight * y)
    pools: list[list[float]] = []  # weight, weight of good rows, weight * x
    for one in zip(w, good, w * points):
        pools.append(list(one))
        while len(pools) > 1 and pools[-2][1] * pools[-1][0] >= pools[-1][1] * pools[-2][0]:
            last = pools.pop()
            pools[-1] = [a + b for a, b in zip(pools[-1], last)]
    return tuple(p[2] / p[0] for p in pools), tuple(p[1] / p[0] for p in pools)


def fit_quality(documents: DataFrame, labels: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> QualityModel:
    """Fit on the texts of ``documents`` that ``labels(id, quality)`` marks 0 or 1.

    The labelled ids are thinned first, to one per class and hash bucket; only their texts are looked up, so no
    text is shuffled. Null texts and other labels do not count, equal texts of a class count once. Without texts
    of both classes every score is the share of good labels (0.5 if there are none).
    """
    hashed = F.xxhash64("id")
    marked = labels.select(F.col(f"`{id_col}`").alias("id"), "quality").where(F.col("quality").isin(0, 1) & F.col("id").isNotNull())
    chosen = (
        marked.groupBy("quality", F.pmod(hashed, F.lit(SAMPLE_TEXTS)).alias("bucket"))
        .agg(F.min(F.struct(hashed.alias("h"), "id")).alias("x"), F.count("*").alias("n"))
        .select("quality", "bucket", F.col("x.id").alias("id"), "n")
    )
    chosen = written(chosen, "labelled")
    texts = documents.select(F.col(f"`{id_col}`").alias("id"), F.substring(F.col(f"`{text_col}`"), 1, SAMPLE_CHARS).alias("text"))
    # at most two rows per bucket: the bound that makes the broadcast safe
    found = texts.where(F.col("text").isNotNull()).join(F.broadcast(chosen.select("id", "quality", "bucket")), "id")
    found = found.groupBy("quality", "bucket").agg(F.min("text").alias("text")).collect()
    rows = [{"quality": q, "text": t, "bucket": b} for q, t, b in sorted({(r["quality"], r["text"], r["bucket"]) for r in found})]
    counts = chosen.select("quality", "n").collect()
    total = {q: sum(r["n"] for r in counts if r["quality"] == q) for q in (0, 1)}
    share = total[1] / (total[0] + total[1]) if counts else 0.5
    by_class = {q: list(dict.fromkeys(r["text"] for r in sorted(rows, key=lambda r: r["bucket"]) if r["quality"] == q)) for q in (0, 1)}
    if min(len(v) for v in by_class.values()) < 2:
        return QualityModel(b"", b"", (0.0,), (share,))
    train = {q: [t for k, t in enumerate(v) if k % 4] for q, v in by_class.items()}
    held = {q: [t for k, t in enumerate(v) if k % 4 == 0] for q, v in by_class.items()}
    good, bad = _dictionary(train[1]), _dictionary(train[0])
    pair = _compressor(good), _compressor(bad)
    x = np.array([difference(t, *pair) for q in (0, 1) for t in held[q]])
    y = np.array([q for q in (0, 1) for _ in held[q]])
    return QualityModel(good, bad, *_isotonic(x, y, share))


def score_quality(df: DataFrame, model: QualityModel, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Per row: id, score (0 to 1, higher is better) of the whole text. Null and empty texts have difference 0."""
    rows = df.select(F.col(f"`{id_col}`").alias("id"), F.col(f"`{text_col}`").alias("text"))
    kind = rows.schema["id"].dataType.simpleString()
    shared = df.sparkSession.sparkContext.broadcast(model)

    def score(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        fitted = shared.value
        pair = compressors(fitted)
        for part in slices(batches, "text", SLICE_BYTES):
            x = np.array([difference(t, *pair) for t in part.column("text").to_pylist()])
            yield pa.RecordBatch.from_arrays([part.column("id"), pa.array(fitted.score(x))], ["id", "score"])

    return rows.mapInArrow(score, f"id {kind}, score double").withColumnRenamed("id", id_col)

"""Language by cross-parsing entropy.

A bounded sample of labelled text per language is indexed by a suffix automaton. A text is cut into the longest
phrases that occur in a language's sample; the fewer phrases it takes, each worth the logarithm of the sample's
length in bits, the better that language describes the text. The language with the fewest normalised phrases wins.

The automata become one dense table ``state x symbol -> state`` whose missing transitions already hold the state
after a new phrase has begun (marked by the sign bit), so that a task advances many texts in step through all
languages with a handful of array operations per symbol.
"""

from __future__ import annotations

from typing import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import resident, slices, tidy

UNKNOWN = "und"
#: The learning sample: per language at most ``SAMPLE_TEXTS`` distinct pieces of ``SAMPLE_CHARS`` characters, each from
#: another text and from anywhere in it.
SAMPLE_TEXTS, SAMPLE_CHARS = 128, 160
#: A text is parsed in blocks of so many symbols (a phrase ends at a block's end), so one long text is as many lanes.
BLOCK = 1024
#: Bytes of text that a task holds as lanes at a time.
SLICE_BYTES = 1 << 20
_NEW = np.int32(-(2**31))


def symbols(data: np.ndarray) -> np.ndarray:
    """Raw byte classes: 0 for ASCII other than letters, 1-26 for letters in either case, other bytes as they are."""
    table = np.zeros(256, np.uint8)
    table[65:91] = table[97:123] = np.arange(1, 27)
    table[128:] = np.arange(128, 256)
    return table[data]


def suffix_automaton(text: list[int]) -> list[dict[int, int]]:
    """Transitions per state (0 is the start): the paths from the start spell exactly the substrings of ``text``."""
    moves, link, length, last = [{}], [-1], [0], 0
    for symbol in text:
        state = len(moves)
        moves.append({})
        link.append(0)
        length.append(length[last] + 1)
        at = last
        while at >= 0 and symbol not in moves[at]:
            moves[at][symbol] = state
            at = link[at]
        if at >= 0:
            after = moves[at][symbol]
            if length[after] == length[at] + 1:
                link[state] = after
            else:
                copy = len(moves)
                moves.append(dict(moves[after]))
                link.append(link[after])
                length.append(length[at] + 1)
                while at >= 0 and moves[at].get(symbol) == after:
                    moves[at][symbol] = copy
                    at = link[at]
                link[after] = link[state] = copy
        last = state
    return moves


class Automata:
    """The automata of all languages as one table; a state is the offset of its row."""

    def __init__(self, samples: tuple[tuple[str, bytes], ...]):
        self.languages = [name for name, _ in samples]
        raw = [symbols(np.frombuffer(text, np.uint8)) for _, text in samples]
        used = np.unique(np.concatenate([*raw, np.zeros(1, np.uint8)]))
        self.code = np.full(256, len(used), np.int32)  # bytes that no sample has share one code
        self.code[used] = np.arange(len(used))
        width, tables, starts, at = len(used) + 1, [], [], 0
        for one in raw:
            moves = suffix_automaton(self.code[one].tolist())
            # one more state: after a symbol that the sample lacks, and at the start, any symbol begins a phrase
            begin = at + len(moves) * width
            table = np.full((len(moves) + 1, width), begin | _NEW, np.int32)
            for symbol, state in moves[0].items():
                table[:, symbol] = (at + state * width) | _NEW
            rows = np.repeat(np.arange(len(moves)), [len(m) for m in moves])
            columns = np.fromiter((s for m in moves for s in m), np.int64, len(rows))
            table[rows, columns] = at + width * np.fromiter((t for m in moves for t in m.values()), np.int32, len(rows))
            tables.append(table.ravel())
            starts.append(begin)
            at += table.size
        self.table = np.concatenate(tables)
        self.starts = np.array(starts, np.int32)
        self.bits = np.log2(np.maximum([len(x) for x in raw], 2))

    @staticmethod
    def of(samples: tuple[tuple[str, bytes], ...]) -> "Automata":
        """Built once per Python worker."""
        return resident(("automata", samples), lambda: Automata(samples))

    def bits_per_symbol(self, data: np.ndarray, ends: np.ndarray) -> np.ndarray:
        """languages x texts: normalised phrases of the texts that end at ``ends`` in the bytes ``data``."""
        classes = symbols(data)
        texts = np.repeat(np.arange(len(ends)), np.diff(ends, prepend=0))
        keep = np.ones(len(data), bool)  # runs of other characters count as one
        keep[1:] = (classes[1:] > 0) | (classes[:-1] > 0) | (texts[1:] != texts[:-1])
        codes, texts = self.code[classes[keep]], texts[keep]
        sizes = np.bincount(texts, minlength=len(ends))
        blocks = -(-sizes // BLOCK)
        text_of = np.repeat(np.arange(len(ends)), blocks)
        nth = np.arange(len(text_of)) - np.repeat(np.cumsum(blocks) - blocks, blocks)
        begin = (np.cumsum(sizes) - sizes)[text_of] + nth * BLOCK
        length = np.minimum(BLOCK, sizes[text_of] - nth * BLOCK)
        order = np.argsort(-length, kind="stable")  # lanes still going are a prefix
        begin, length, text_of = begin[order], length[order], text_of[order]
        going = np.searchsorted(-length, -np.arange(1, BLOCK + 1), side="right")
        k, lanes = len(self.starts), len(begin)
        state = np.repeat(self.starts[:, None], lanes, axis=1)
        phrases = np.zeros((k, lanes), np.int32)
        for step in range(int(length[0]) if lanes else 0):
            n = going[step]
            after = self.table[state[:, :n] + codes[begin[:n] + step]]
            phrases[:, :n] += after < 0
            state[:, :n] = after & 0x7FFFFFFF
        total = np.stack([np.bincount(text_of, weights=row, minlength=len(ends)) for row in phrases])
        return total * self.bits[:, None] / np.maximum(sizes, 1)


def learning_sample(labelled: DataFrame) -> tuple[tuple[str, bytes], ...]:
    """Per language a bounded sample of ``labelled(lang, text)``: of every text the piece at a place that the text's hash
    selects (or from its first letter, if that has none), of the pieces one per hash bucket, so that equal pieces, such as
    a line that many texts open with, count once."""
    letter = F.lit(r"\p{L}")
    places = F.greatest(F.length("text") - SAMPLE_CHARS, F.lit(0)) + 1
    piece = F.substring("text", (F.pmod(F.xxhash64("text"), places) + 1).cast("int"), SAMPLE_CHARS)
    first = F.regexp_extract("text", rf"(?s)\p{{L}}.{{0,{SAMPLE_CHARS - 1}}}", 0)
    hashed = F.xxhash64("piece")
    chosen = (
        labelled.where(F.col("lang").isNotNull() & F.rlike("text", letter))
        .select("lang", F.when(F.rlike(piece, letter), piece).otherwise(first).alias("piece"))
        .groupBy("lang", F.pmod(hashed, F.lit(SAMPLE_TEXTS)).alias("bucket"))
        .agg(F.min(F.struct(hashed.alias("h"), F.col("piece").alias("text"))).alias("x"))
        .select("lang", "bucket", "x.text").collect()
    )
    by_language: dict[str, list] = {}
    for row in sorted(chosen, key=lambda r: (r["lang"], r["bucket"])):
        by_language.setdefault(row["lang"], []).append(row["text"])
    return tuple((lang, "\n".join(texts).encode()) for lang, texts in sorted(by_language.items()))


def with_language(df: DataFrame, samples: tuple[tuple[str, bytes], ...], text_col: str = "text") -> DataFrame:
    """``df`` with lang_pred and score (0 to 1: by how much the runner-up needs more phrases).

    Null texts and texts without a letter are ``und`` with score 0, as is everything when there is no sample.
    Ties go to the smaller language name; with a single language the score is 1. Whole texts are parsed. Columns
    of these names that ``df`` has already are replaced.
    """
    df = df.drop("lang_pred", "score")
    if not samples:
        return df.withColumns({"lang_pred": F.lit(UNKNOWN), "score": F.lit(0.0)})
    # positions instead of names: whatever the columns are called
    names = [f"c{k}" for k in range(len(df.columns))]
    text = F.col(names[df.columns.index(text_col)])
    lettered = F.coalesce(F.rlike(text, F.lit(r"\p{L}")), F.lit(False))
    shared = df.sparkSession.sparkContext.broadcast(samples)

    @F.arrow_udf("struct<lang: string, score: double>")
    @tidy
    def predict(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
        model = Automata.of(shared.value)
        known = pa.array(model.languages)
        for batch in batches:
            languages, scores = [], []
            for part in slices([pa.RecordBatch.from_arrays([batch], ["text"])], "text", SLICE_BYTES):
                texts = part.column("text")
                ends = pa.compute.fill_null(pa.compute.binary_length(texts), 0).to_numpy().cumsum(dtype=np.int64)
                data = np.frombuffer("".join(x for x in texts.to_pylist() if x).encode(), np.uint8)
                bits = model.bits_per_symbol(data, ends)
                low = bits.min(axis=0)
                second = np.partition(bits, 1, axis=0)[1] if len(bits) > 1 else np.full(len(low), np.inf)
                languages.append(bits.argmin(axis=0))
                scores.append(1 - np.divide(low, second, out=np.ones_like(low), where=second > 0))
            best = np.concatenate(languages) if languages else np.empty(0, np.int64)
            score = np.concatenate(scores) if scores else np.empty(0)
            yield pa.StructArray.from_arrays([known.take(pa.array(best)), pa.array(score)], ["lang", "score"])

    # only the texts go to Python, and only once: Catalyst may not repeat the parse in a filter on its result
    parsed = df.toDF(*names).withColumn("x", predict.asNondeterministic()(text))
    return parsed.select(
        *names, F.when(lettered, F.col("x.lang")).otherwise(UNKNOWN), F.when(lettered, F.col("x.score")).otherwise(0.0),
    ).toDF(*df.columns, "lang_pred", "score")


def identify_languages(df: DataFrame, samples: tuple[tuple[str, bytes], ...], id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Per row: id, lang_pred and score, as :func:`with_language` gives them."""
    rows = df.select(F.col(f"`{id_col}`").alias("id"), F.col(f"`{text_col}`").alias("text"))
    return with_language(rows, samples).select(F.col("id").alias(id_col), "lang_pred", "score")

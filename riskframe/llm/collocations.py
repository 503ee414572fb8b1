"""Phrase collocations: n-gram counts of shards from an FM-index over word ids, summed over all shards.

Texts become shards of word numbers. Level by level, each shard enumerates its n-grams by interval extension, one row an
n-gram and shard; a window over all shards sums them, and only n-grams that are frequent in the whole corpus go back to
the shards, where everything else is cut away before the next level. An n-gram is named by the smallest shard and number
it has, so names need no numbering job, and a key has at most one row a shard.
"""

from __future__ import annotations

from typing import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from .common import LOWER, UPPER, discard, free_memory, written
from .word_index import WordIndex, cut_runs

#: Bytes of text in a shard: a task holds an index of it, about 20 times as large.
SHARD_BYTES = 8 << 20
#: Shards that a task fills at the same time, one a language, hold so many times the bytes of a shard at most.
OPEN_SHARDS = 3
#: Bits of the number of an n-gram within its shard, and of the number of a shard within its partition.
NUMBER_BITS, SHARD_BITS = 25, 18
LONGEST = 4
#: What ends a piece, and what separates words.
ENDS, BLANKS = b".,;:!?\n\x0b\x0c\r", b" \t"
_BYTES = bytes(10 if b in ENDS else 32 if b in BLANKS else b + 32 if 65 <= b <= 90 else b for b in range(256))

_SHARDS = "lang string, shard long, total long, words array<string>, counts array<int>, seq binary"
_STATE = "lang string, shard long, words binary, marks binary, names binary"
_GRAMS = "own long, prefix long, suffix long, n long"


class _Numbers(dict):
    """Word -> number in order of appearance; the end of a piece is 0, the empty string -1."""

    def __init__(self) -> None:
        super().__init__({b"\n": 0, b"": -1})

    def __missing__(self, word: bytes) -> int:
        self[word] = number = len(self) - 1
        return number


class _Shard:
    def __init__(self) -> None:
        self.numbers, self.parts, self.size = _Numbers(), [], 0

    def add(self, text: bytes) -> None:
        cut = text.translate(_BYTES).replace(b"\n", b" \n ").split(b" ")
        numbers = np.fromiter(map(self.numbers.__getitem__, cut), np.int32, len(cut))
        self.parts.append(np.append(numbers[numbers >= 0], np.int32(0)))
        self.size += len(text)

    def row(self, lang: str, shard: int) -> pa.RecordBatch:
        seq = np.concatenate(self.parts)
        counts = np.bincount(seq, minlength=len(self.numbers) - 1)[1:]
        words = [w for w in self.numbers if w not in (b"\n", b"")]
        offsets = pa.array([0, len(words)], pa.int32())
        return pa.RecordBatch.from_arrays(
            [pa.array([lang]), pa.array([shard], pa.int64()), pa.array([int(counts.sum())], pa.int64()),
             pa.ListArray.from_arrays(offsets, pa.array(words, pa.binary()).cast(pa.string())),
             pa.ListArray.from_arrays(offsets, pa.array(counts, pa.int32())), pa.array([seq.tobytes()], pa.binary())],
            names=["lang", "shard", "total", "words", "counts", "seq"])


def _shards(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Fill shards language by language; a shard is handed on when its texts reach ``SHARD_BYTES``."""
    free_memory()
    base, made, filling = TaskContext.get().partitionId() << SHARD_BITS, 0, {}
    for batch in batches:
        for lang, text in zip(batch.column(0).to_pylist(), batch.column(1).cast(pa.binary())):
            of = filling.setdefault(lang, _Shard())
            of.add(text.as_py())
            full = [lang] if of.size >= SHARD_BYTES else []
            if not full and sum(s.size for s in filling.values()) >= OPEN_SHARDS * SHARD_BYTES:
                full = [max(filling, key=lambda x: filling[x].size)]
            for x in full:
                yield filling.pop(x).row(x, base + made)
                made += 1
    for x in sorted(filling):
        yield filling[x].row(x, base + made)
        made += 1
    if made >= 1 << SHARD_BITS:
        raise ValueError("too many languages in one partition")


def _state_row(lang, shard, words, marks, names) -> pa.Table:
    return pa.table({
        "lang": pa.array([lang], pa.string()), "shard": pa.array([shard], pa.int64()),
        "words": pa.array([words.astype(np.int32).tobytes()], pa.binary()),
        "marks": pa.array([marks.astype(np.int32).tobytes()], pa.binary()), "names": pa.array([names.tobytes()], pa.binary())})


_NO_STATE = _state_row("", 0, *[np.empty(0, np.int64)] * 3).slice(0, 0)


def _lookup(known: pa.Table, most: int) -> tuple[np.ndarray, np.ndarray]:
    """(mark of every number up to ``most``, 0 if it is not frequent; names, that of mark k at k)."""
    numbers = known.column("number").to_numpy()
    order = np.argsort(numbers)
    mark = np.zeros(most + 1, np.int64)
    mark[numbers[order]] = np.arange(1, len(order) + 1)
    return mark, np.append(np.int64(0), known.column("name").to_numpy()[order])


def _cut_words(shards: pa.Table, known: pa.Table) -> pa.Table:
    """First state: runs of frequent words. A word is its own mark, so marks are left out."""
    if not shards.num_rows or not known.num_rows:
        return _NO_STATE
    free_memory()
    seq = np.frombuffer(shards.column("seq")[0].as_py(), np.int32)
    mark, names = _lookup(known, int(seq.max(initial=0)))
    words = mark[seq]
    words = cut_runs(words, words, 1)[0]
    return _state_row(shards.column("lang")[0].as_py(), shards.column("shard")[0].as_py(), words, words[:0], names)


def _cut_grams(length: int):
    """Next state: runs of frequent n-grams of ``length`` words."""

    def cut(state: pa.Table, known: pa.Table) -> pa.Table:
        if not state.num_rows or not known.num_rows:
            return _NO_STATE
        free_memory()
        words = np.frombuffer(state.column("words")[0].as_py(), np.int32)
        index = WordIndex(words, length)
        first, size = index.ngrams()
        mark, names = _lookup(known, len(size))
        words, marks = cut_runs(words, mark[index.numbered(first, size)], length)
        return _state_row(state.column("lang")[0].as_py(), state.column("shard")[0].as_py(), words, marks, names)

    return cut


def _grams(length: int):
    """Rows of the n-grams of ``length`` words of every shard, with the names of their first and last ``length - 1`` words."""

    def grams(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for row in range(batch.num_rows):
                free_memory()
                words, marks = (np.frombuffer(batch.column(c)[row].as_py(), np.int32) for c in ("words", "marks"))
                names = np.frombuffer(batch.column("names")[row].as_py(), np.int64)
                if not len(words):
                    continue
                marks = marks if len(marks) else words
                index = WordIndex(words, length)
                first, size = index.ngrams()
                if len(size) >= 1 << NUMBER_BITS:
                    raise ValueError("a shard holds too many n-grams")
                at = index.places(first)
                del index
                own = (batch.column("shard")[row].as_py() << NUMBER_BITS) + np.arange(1, len(size) + 1)
                out = [own, names[marks[at]], names[marks[at + 1]], size.astype(np.int64)]
                for start in range(0, len(size), 1 << 16):
                    yield pa.RecordBatch.from_arrays(
                        [pa.array(c[start:start + (1 << 16)]) for c in out], names=["own", "prefix", "suffix", "n"])

    return grams


def _frequent(rows: DataFrame, keys: list[str], least: int, name: str) -> DataFrame:
    """Rows of the keys with a sum of ``least`` or more over all shards, with that sum ``f`` and the common ``name``."""
    same = Window.partitionBy(*keys)
    return written(
        rows.withColumns({"f": F.sum("n").over(same), "name": F.min("own").over(same)}).where(F.col("f") >= least).drop("n"), name)


def _cut(state: DataFrame, known: DataFrame, cut, name: str) -> DataFrame:
    """The next state of every shard, from what it has and which of its n-grams are frequent."""
    own = known.select(
        F.shiftright("own", NUMBER_BITS).alias("shard"), F.col("own").bitwiseAND((1 << NUMBER_BITS) - 1).cast("int").alias("number"), "name")
    return written(state.groupBy("shard").cogroup(own.groupBy("shard")).applyInArrow(cut, _STATE), name)


def _longer(known: DataFrame, shorter: DataFrame) -> DataFrame:
    """(name, prefix, suffix, lang, phrase, last, f, heads, tails): counts of all first and of all last words of an n-gram."""
    p = shorter.select(F.col("name").alias("prefix"), "lang", "phrase", "heads")
    s = shorter.select(F.col("name").alias("suffix"), "last", "tails")
    one = known.where(F.col("own") == F.col("name")).select("name", "prefix", "suffix", "f")
    return one.join(p, "prefix").join(s, "suffix").select(
        "name", "prefix", "suffix", "lang", F.concat_ws(" ", "phrase", "last").alias("phrase"), "last", "f",
        F.concat("heads", F.array("f")).alias("heads"), F.concat("tails", F.array("f")).alias("tails"))


def phrase_counts(df: DataFrame, least: int = 30, text_col: str = "text", lang_col: str = "lang") -> tuple[list[DataFrame], DataFrame]:
    """Frequent n-grams of 1 to 4 words, a table for each length, and (lang, total) of all words."""
    texts = df.select(
        F.coalesce(F.col(f"`{lang_col}`").cast("string"), F.lit("und")).alias("lang"),
        F.coalesce(F.col(f"`{text_col}`").cast("string"), F.lit("")).alias("text"))
    shards = written(texts.mapInArrow(_shards, _SHARDS), "shards")
    totals = written(shards.groupBy("lang").agg(F.sum("total").alias("total")), "totals")
    words = shards.select("lang", "shard", F.posexplode(F.arrays_zip("words", "counts")).alias("at", "w")).select(
        "lang", (F.shiftleft("shard", NUMBER_BITS) + F.col("at") + 1).alias("own"), F.col("w.words").alias("word"), F.col("w.counts").cast("long").alias("n"))
    known = _frequent(words, ["lang", "word"], least, "words")
    first = known.where(F.col("own") == F.col("name")).select(
        "name", "lang", F.col("word").alias("phrase"), F.col("word").alias("last"), "f", F.array("f").alias("heads"), F.array("f").alias("tails"))
    levels = [written(first, "level1")]
    state = _cut(shards.select("lang", "shard", "seq"), known, _cut_words, "state1")
    discard(shards, known)
    for length in range(2, LONGEST + 1):
        known = _frequent(state.mapInArrow(_grams(length), _GRAMS), ["prefix", "suffix"], least, f"grams{length}")
        levels.append(written(_longer(known, levels[-1]), f"level{length}"))
        if length < LONGEST:
            before, state = state, _cut(state, known, _cut_grams(length), f"state{length}")
            discard(before, known)
    return levels, totals


def collocations(
    df: DataFrame, least: int = 30, cover: int = 80, top: int = 2000, text_col: str = "text", lang_col: str = "lang",
) -> DataFrame:
    """The ``top`` phrases of 2 to 4 words of each language: lang, rank (from 1), phrase, a, l, r, n, score.

    ``a`` counts the phrase, ``l`` and ``r`` the two parts of its weakest cut, ``n`` all words of the language; the score is
    floor(2000000 a / (l + r)) in exact decimals. Phrases have ``least`` occurrences or more, never cross the end of a piece
    and go where a longer phrase around them has ``cover`` percent of their count or more: as counts only fall with length,
    the phrases one word longer decide. Ties in score rank by count, then phrase in byte order.

    Null texts are empty, a null language is ``und``, equal rows count each, an empty table gives no rows, other columns are
    not read. A very long text makes its shard longer; a shard is worked on by one task.
    """
    levels, totals = phrase_counts(df, least, text_col, lang_col)
    wide = "decimal(38,0)"
    out = None
    for length in range(2, LONGEST + 1):
        grams = levels[length - 1]
        if length < LONGEST:
            longer = levels[length]
            around = longer.select(F.col("prefix").alias("name"), F.col("f").alias("most")).unionByName(
                longer.select(F.col("suffix").alias("name"), F.col("f").alias("most")))
            grams = grams.join(around.groupBy("name").agg(F.max("most").alias("most")), "name", "left").where(
                F.col("most").isNull() | (F.col("most").cast(wide) * 100 < F.col("f").cast(wide) * cover))
        cuts = [F.struct((F.expr(f"(cast(f as {wide}) * 2000000) div cast(heads[{k - 1}] + tails[{length - k - 1}] as {wide})")).alias("score"),
                         F.lit(k).alias("k"), F.col("heads")[k - 1].alias("l"), F.col("tails")[length - k - 1].alias("r"))
                for k in range(1, length)]
        part = grams.select("lang", "phrase", F.col("f").alias("a"), F.array_min(F.array(*cuts)).alias("cut"))
        out = part if out is None else out.unionByName(part)
    rows = out.join(totals, "lang").select(
        "lang", "phrase", "a", F.col("cut.l").alias("l"), F.col("cut.r").alias("r"), F.col("total").alias("n"), F.col("cut.score").cast("long").alias("score"))
    best = Window.partitionBy("lang").orderBy(F.col("score").desc(), F.col("a").desc(), "phrase")
    ranked = rows.withColumn("rank", F.row_number().over(best)).where(F.col("rank") <= top)
    return ranked.select("lang", F.col("rank").cast("long").alias("rank"), "phrase", "a", "l", "r", "n", "score")


def oracle() -> str:
    """The same in DuckDB SQL."""
    grams = " UNION ALL ".join(
        f"SELECT lang, unnest([array_to_string(w[i:i + {n - 1}], ' ') FOR i IN range(1, len(w) - {n - 2})]) AS phrase FROM p" for n in range(1, 5))
    return rf"""
WITH t AS (SELECT coalesce(lang, 'und') AS lang,
                  unnest(string_split_regex(translate(coalesce(text, ''), '{UPPER}', '{LOWER}'), '[.,;:!?\x0A-\x0D]')) AS piece FROM documents),
p AS (SELECT lang, regexp_extract_all(piece, '[^\x20\x09]+') AS w FROM t),
s AS (SELECT lang, sum(len(w))::BIGINT AS n FROM p GROUP BY lang),
f AS (SELECT lang, phrase, count(*) AS f, string_split(phrase, ' ') AS w FROM ({grams}) GROUP BY ALL HAVING count(*) >= 30),
c AS (SELECT * FROM f WHERE len(w) >= 2),
part AS (SELECT lang, f, w, unnest(range(1, len(w) + 1)) AS i FROM c WHERE len(w) >= 3),
sub AS (SELECT lang, f, w, i, unnest(range(i + 1, len(w) + 1)) AS j FROM part),
m AS (SELECT lang, array_to_string(w[i:j], ' ') AS phrase, max(f) AS most FROM sub WHERE j - i + 1 < len(w) GROUP BY ALL),
k AS (SELECT c.lang, c.phrase, c.f AS a, c.w, unnest(range(1, len(c.w))) AS k FROM c LEFT JOIN m USING (lang, phrase)
      WHERE m.most IS NULL OR 100 * m.most < 80 * c.f),
x AS (SELECT k.lang, k.phrase, a, k, l.f AS l, r.f AS r, ((2000000::HUGEINT * a) // (l.f + r.f))::BIGINT AS score
      FROM k JOIN f l ON l.lang = k.lang AND l.phrase = array_to_string(k.w[1:k.k], ' ')
             JOIN f r ON r.lang = k.lang AND r.phrase = array_to_string(k.w[k.k + 1:len(k.w)], ' ')),
y AS (SELECT *, row_number() OVER (PARTITION BY lang, phrase ORDER BY score, k) AS place FROM x),
z AS (SELECT lang, row_number() OVER (PARTITION BY lang ORDER BY score DESC, a DESC, phrase) AS rank, phrase, a, l, r, n, score
      FROM y JOIN s USING (lang) WHERE place = 1)
SELECT * FROM z WHERE rank <= 2000"""

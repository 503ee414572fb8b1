"""Phrase collocations from FM-indexes against brute force."""

import random
import re
from collections import Counter

import numpy as np
import pytest
from pyspark.sql import functions as F

from riskframe.llm import collocations as module
from riskframe.llm.collocations import collocations
from riskframe.llm.word_index import WordIndex, cut_runs

LOW = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def brute(rows, least=30, cover=80, top=2000):
    counts, totals = {}, Counter()
    for lang, text in rows:
        lang = "und" if lang is None else lang
        for piece in re.split(r"[.,;:!?\x0A-\x0D]", (text or "").translate(LOW)):
            words = re.findall(r"[^\x20\x09]+", piece)
            totals[lang] += len(words)
            for n in range(1, 5):
                counts.setdefault(lang, Counter()).update(tuple(words[i:i + n]) for i in range(len(words) - n + 1))
    out = []
    for lang, f in counts.items():
        chosen = {p: a for p, a in f.items() if len(p) > 1 and a >= least}
        covered = {p[i:j] for p, a in chosen.items() for i in range(len(p)) for j in range(i + 2, len(p) + 1)
                   if j - i < len(p) and 100 * a >= cover * f[p[i:j]]}
        rows_ = []
        for p, a in chosen.items():
            if p in covered:
                continue
            score, _, l, r = min((2_000_000 * a // (f[p[:k]] + f[p[k:]]), k, f[p[:k]], f[p[k:]]) for k in range(1, len(p)))
            rows_.append((-score, -a, " ".join(p).encode(), l, r))
        rows_.sort()
        out += [(lang, k, p.decode(), -a, l, r, totals[lang], -s) for k, (s, a, p, l, r) in enumerate(rows_[:top], 1)]
    return sorted(out)


def corpus(n, seed, words=12):
    draw = random.Random(seed)
    names = [f"W{k}" for k in range(words)] + ["ñu", "中", "x'y"]
    fixed = ["new york city hall", "as soon as", "w1 w1 w1 w1 w1"]
    rows = []
    for k in range(n):
        text = " ".join(draw.choice(names + fixed) + draw.choice(["", "", "", ".", ",", " \t", "\n", "\r\n", "\x0b"]) for _ in range(draw.randint(0, 40)))
        rows.append((draw.choice(["en", "en", "de", None, "und"]), text))
    return rows


def found(spark, rows, parts=3, **settings):
    df = spark.createDataFrame(rows, "lang string, text string").repartition(parts)
    return sorted(tuple(r) for r in collocations(df, **settings).collect())


def test_matches_brute_force_over_many_shards(spark, monkeypatch):
    rows = corpus(1500, 1, 5) + [("en", None), ("fr", ""), ("fr", "one two"), ("en", "stop words " * 3000), ("xx", "a\x00b c " * 40)]
    want = brute(rows)
    assert len(want) > 60
    assert found(spark, rows) == want
    monkeypatch.setattr(module, "SHARD_BYTES", 900)
    assert found(spark, rows, parts=5) == want


def test_top_and_ties(spark):
    rows = [("en", "a b. c d. e f. A b")] * 40
    assert found(spark, rows, top=2) == brute(rows, top=2)
    assert found(spark, rows, least=81) == []


def test_hot_copies(spark):
    rows = [("en", "the same long text of a group of copies, again and again the same")] * 700 + corpus(60, 5)
    assert found(spark, rows) == brute(rows)


def test_empty_table_and_clashing_columns(spark):
    assert found(spark, []) == []
    df = spark.createDataFrame([("en", "a b")] * 30, "lang string, text string").withColumn("shard", F.lit(1)).withColumn("n", F.lit("x"))
    assert [r["phrase"] for r in collocations(df).collect()] == ["a b"]


def test_scores_beyond_64_bits(spark):
    """2,000,000 * a passes 64 bits for counts above 4.6e12."""
    row = spark.createDataFrame([(9_000_000_000_000, [9_500_000_000_000], [9_999_999_999_999])], "f long, heads array<long>, tails array<long>")
    got = row.select(F.expr("(cast(f as decimal(38,0)) * 2000000) div cast(heads[0] + tails[0] as decimal(38,0))")).first()[0]
    assert got == 2_000_000 * 9_000_000_000_000 // 19_499_999_999_999


@pytest.mark.parametrize("depth", [2, 3, 4])
@pytest.mark.parametrize("seed", range(4))
def test_intervals_are_the_ngrams(depth, seed):
    rng = np.random.default_rng(seed)
    words = np.append(rng.integers(0, 2 + 3 * seed, 500), 0).astype(np.int32)
    index = WordIndex(words, depth)
    first, size = index.ngrams()
    numbers = index.numbered(first, size)
    want = Counter(tuple(words[i:i + depth].tolist()) for i in range(len(words) - depth + 1) if (words[i:i + depth] > 0).all())
    got = {tuple(words[p:p + depth].tolist()): int(n) for p, n in zip(index.places(first), size)}
    assert got == want and len(got) == len(size)
    for i, number in enumerate(numbers.tolist()):
        gram = tuple(words[i:i + depth].tolist())
        assert (number > 0) == (gram in want)
        if number:
            at = index.places(first[number - 1:number])[0]
            assert tuple(words[at:at + depth].tolist()) == gram


def test_cut_runs_keeps_what_two_marks_cover():
    words = np.array([1, 2, 3, 0, 4, 5, 6, 7, 0])
    marks = np.array([9, 8, 0, 0, 7, 0, 6, 0, 0])
    got_words, got_marks = cut_runs(words, marks, 2)
    assert got_words.tolist() == [1, 2, 3, 0] and got_marks.tolist() == [9, 8, 0, 0]
    assert [a.tolist() for a in cut_runs(words, np.zeros(9, int), 2)] == [[], []]

"""Ranked lexical search by presence masks against brute force."""

import math
import random
import re
from collections import Counter

import numpy as np
import pytest
from pyspark.sql import functions as F

from riskframe.llm import ranked_search as module
from riskframe.llm.ranked_search import _Best, _Block, ranked_search, term_counts

TERM = re.compile(r"[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+")
LOW = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def terms(text):
    return Counter(TERM.findall((text or "").translate(LOW)))


def brute(docs, items, k=50):
    counted = [(i, terms(t)) for i, t in docs]
    counted = [(i, c) for i, c in counted if c]
    n, total = len(counted), sum(c.total() for _, c in counted)
    df = Counter(t for _, c in counted for t in c)
    asked = {}
    for item, text in items:
        if text is not None:
            asked.setdefault(item, set()).update(terms(text))
    out = []
    for item, wanted in asked.items():
        found = []
        for i, c in counted:
            m = 50 + (50 * c.total() * n) // total
            score = sum(math.floor(1000 * math.log((2 * n + 2) / (2 * df[t] + 1))) * ((10**9 * c[t]) // (1000 * c[t] + 20 * m))
                        for t in wanted if c[t])
            if score > 0:
                found.append((-score, i is None, i or 0, i))
        out += [(item, rank, i, -s) for rank, (s, _, _, i) in enumerate(sorted(found, key=lambda x: x[:3])[:k], 1)]
    return sorted(out, key=repr)


def found(spark, docs, items, **settings):
    d = spark.createDataFrame(docs, "doc_id long, text string").repartition(3)
    q = spark.createDataFrame(items, "item_id long, text string")
    return sorted((tuple(r) for r in ranked_search(d, q, **settings).collect()), key=repr)


def corpus(n, seed=3):
    draw = random.Random(seed)
    words = [f"w{k}" for k in range(150)] + ["ñandú", "Ünder", "x1", "中文"]
    weights = [1 / (k + 1) for k in range(len(words))]
    return [(k, " ".join(draw.choices(words, weights, k=draw.randint(0, 60)))) for k in range(n)]


def test_matches_brute_force(spark):
    docs = corpus(700) + [(None, "w3 w5 w9")] * 3 + [(5, "w3, W5;w9"), (5, "w3, W5;w9"), (900, None), (901, ""), (902, "-- !"),
                                                      (903, "w90 " * 5000)]
    items = corpus(12, 4) + [(50, None), (51, ""), (None, "w7 w8"), (1, "w100 w101"), (60, " ".join(f"w{k}" for k in range(150)))]
    assert found(spark, docs, items) == brute(docs, items)
    assert found(spark, docs, items, k=3) == brute(docs, items, 3)


def test_large_groups_of_copies_rank_by_id(spark):
    docs = [(2000 - k, "rare words of one text") for k in range(900)] + corpus(200)
    docs += [(None, "rare words of one text")] * 200
    items = [(1, "rare words"), (2, "text w1 w2")]
    assert found(spark, docs, items) == brute(docs, items)


def test_rounds_and_blocks_change_nothing(spark, monkeypatch):
    docs, items = corpus(150), corpus(9, 8)
    monkeypatch.setattr(module, "ROUND_BYTES", 400)
    assert found(spark, docs, items, k=7) == brute(docs, items, 7)


def test_empty_tables_and_clashing_columns(spark):
    assert found(spark, [], [(1, "a")]) == [] and found(spark, [(1, "a b")], []) == [] and found(spark, [(1, None)], [(1, "a")]) == []
    d = spark.createDataFrame([(1, "a"), (2, "b")], "doc_id long, text string").withColumn("n", F.lit(1)).withColumn("terms", F.lit(2)).withColumn("id", F.lit(0))
    q = spark.createDataFrame([(7, "a")], "item_id long, text string").withColumn("rank", F.lit(9)).withColumn("doc_id", F.lit(4))
    assert [r["doc_id"] for r in ranked_search(d, q).collect()] == [1]


def test_string_ids(spark):
    d = spark.createDataFrame([("b", "x y"), ("a", "x y"), (None, "x y"), ("c", "z")], "doc_id string, text string")
    q = spark.createDataFrame([("q", "x")], "item_id string, text string")
    assert [r["doc_id"] for r in ranked_search(d, q).orderBy("rank").collect()] == ["a", "b", None]


def test_long_texts_are_cut_between_terms(monkeypatch):
    text = ("Ab-c" + "d" * 50 + " ñ,") * 40
    whole = term_counts(text.encode())
    monkeypatch.setattr(module, "PIECE_BYTES", 7)
    assert term_counts(text.encode()) == whole
    assert {k.decode(): v for k, v in whole.items()} == dict(terms(text))


@pytest.mark.parametrize("seed", range(3))
def test_search_stops_before_all_masks(seed):
    """With a few good documents most masks are never evaluated, and the best are right."""
    rng = np.random.default_rng(seed)
    n_docs, n_terms = 5000, 40
    held = rng.random((n_docs, n_terms)) < np.linspace(0.5, 0.01, n_terms)
    docs, owned = np.nonzero(held)
    offsets = np.append(0, np.cumsum(held.sum(1)))
    tfs = rng.integers(1, 4, len(docs))
    weights = np.linspace(300, 4000, n_terms).astype(np.int64)
    n = rng.integers(50, 400, n_docs)
    block = _Block(np.arange(n_docs), np.zeros(n_docs, bool), n, offsets, owned, tfs, weights, (n_docs, int(n.sum())))
    best = _Best(50)
    evaluated = block.search(np.arange(n_terms), best)
    scores = np.zeros(n_docs, np.int64)
    np.add.at(scores, docs, block.scores)
    want = sorted((-int(s), False, k) for k, s in enumerate(scores) if s > 0)[:50]
    assert best.rows == want
    assert evaluated < n_docs

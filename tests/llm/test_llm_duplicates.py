"""Jaccard components and repeated passages against brute force; connected components."""

import hashlib
import random
import re

import numpy as np
import pytest
from pyspark.sql import functions as F

from riskframe.llm import components, jaccard, repeats, shingles, suffixes

DOCS = "doc_id long, text string"
WORDS = re.compile(r"[^\x20\x09-\x0D]+")
LOWER = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def sets_by_hand(text, k):
    w = WORDS.findall((text or "").translate(LOWER))
    return {tuple(w[i:i + k]) for i in range(len(w) - k + 1)} if len(w) >= k else ({tuple(w)} if w else set())


def smallest_reachable(n, links):
    root = list(range(n))
    while True:
        before = list(root)
        for a, b in links:
            root[a] = root[b] = min(root[a], root[b])
        if root == before:
            return root


def test_components_of_chains_stars_and_rings(spark):
    edges = [(k, k + 1) for k in range(40)] + [(100, k) for k in range(101, 150)] + [(200, 201), (201, 202), (202, 200), (7, 7), (900, 900)]
    df = spark.createDataFrame(edges, "a long, b long")
    got = {r["node"]: r["component"] for r in components.connected_components(df).collect()}
    assert all(got.get(k, k) == 0 for k in range(41)) and all(got.get(k, k) == 100 for k in range(100, 150))
    assert {got.get(k, k) for k in (200, 201, 202)} == {200} and got.get(900, 900) == 900
    assert components.connected_components(df.limit(0)).count() == 0


@pytest.mark.parametrize("most", [4, 1 << 17])
def test_components_by_contraction_in_tasks(spark, monkeypatch, most):
    """Edges that fit one task take no rounds of shuffles; in many tasks the rounds join what the tasks have."""
    rng, names = random.Random(5), []
    monkeypatch.setattr(components, "TASK_EDGES", most)
    monkeypatch.setattr(components, "written", lambda df, name, real=components.written: (names.append(name), real(df, name))[1])
    edges = [(k + 1, k) for k in range(30)] + [(rng.randrange(40, 120), rng.randrange(40, 120)) for _ in range(60)] + [(-5, 2**62), (None, 3)]
    edges += edges[:9]
    df = spark.createDataFrame(edges, "a long, b long").repartition(5)
    got = {r["node"]: r["component"] for r in components.connected_components(df).collect()}
    kept = [e for e in edges if None not in e and -5 not in e]
    assert [got.get(k, k) for k in range(120)] == smallest_reachable(120, kept) and got[2**62] == -5
    if most > len(edges):
        assert names == ["edges", "forest"]


@pytest.mark.parametrize("size", [10, 11, 12])
def test_words_that_cancel_in_powers_of_two_differ(size):
    """Thue-Morse words and their complements agree in every polynomial modulo 2^64."""
    word = "".join("ab"[k.bit_count() % 2] for k in range(1 << size))
    other = word.translate(str.maketrans("ab", "ba"))
    one, two = shingles.shingle_sets([f"{word} x y z", f"{other} x y z"], 4)
    assert not set(one.tolist()) & set(two.tolist())
    assert shingles.shingle_sets([f" q {word}"], 1)[0].tolist() == shingles.shingle_sets([f"{word}\n\tq"], 1)[0].tolist()


def test_shingle_sets_match_tuples():
    texts = ["a b c d e", "A b C d e", "", None, " \t\n", "one", "one two", "x " * 500, "ä Ö ö\u00a0b c", "a  b\tc\nd e f"]
    for k in (4, 5):
        for text, got in zip(texts, shingles.shingle_sets(texts, k)):
            assert len(got) == len(sets_by_hand(text, k))
    same = shingles.shingle_sets(["a b c d e", "A  B c\nd E"], 4)
    assert (same[0] == same[1]).all()


def near_copies(seed=2):
    rng = random.Random(seed)
    vocabulary = [f"w{k}" for k in range(60)]
    passage = " ".join(rng.choice(vocabulary) for _ in range(30))
    rows = []
    for group in range(25):
        base = [rng.choice(vocabulary) for _ in range(rng.choice((3, 20, 90, 150)))]
        for _ in range(rng.randint(1, 12)):
            words = list(base)
            for _ in range(rng.choice((0, 1, 1, 2, 3))):
                words[rng.randrange(len(words))] = rng.choice(vocabulary)
            rows.append(" ".join(words) + (" " + passage if rng.random() < 0.3 else ""))
    rows += [None, "", "  ", "short text", "Short text", "word " * 4000, "word " * 4000]
    rng.shuffle(rows)
    return rows


@pytest.mark.parametrize("words, percent", [(4, 85), (5, 80)])
def test_jaccard_components_against_all_pairs(spark, monkeypatch, words, percent):
    monkeypatch.setattr(jaccard, "FLUSH", 500)
    texts = near_copies()
    df = spark.createDataFrame(list(enumerate(texts)), DOCS).withColumns({"id": F.lit("x"), "n": F.lit(0), "node": F.lit(1), "h": F.lit(2)})
    got = sorted((r["doc_id"], r["n_shingles"], r["component_id"]) for r in jaccard.jaccard_components(df, words=words, percent=percent).collect())
    sets = [sets_by_hand(t, words) for t in texts]
    links = [(a, b) for a in range(len(sets)) for b in range(a + 1, len(sets))
             if sets[a] and sets[b] and 100 * len(sets[a] & sets[b]) >= percent * len(sets[a] | sets[b])]
    root = smallest_reachable(len(sets), links)
    assert len(links) > 50
    assert got == [(k, len(s), r) for k, (s, r) in enumerate(zip(sets, root))]


def test_jaccard_edge_tables(spark):
    assert jaccard.jaccard_components(spark.createDataFrame([], DOCS)).count() == 0
    rows = [(5, "a b c d e f"), (5, "a b c d e f"), (3, "A B c d e f"), (None, "a b c d e f"), (None, None), (9, "zz")]
    got = sorted(str(tuple(r)) for r in jaccard.jaccard_components(spark.createDataFrame(rows, DOCS)).collect())
    assert got == sorted(["(5, 2, 3)", "(5, 2, 3)", "(3, 2, 3)", "(None, 2, 3)", "(None, 0, None)", "(9, 1, 9)"])


def packed(strings):
    return np.frombuffer(b"".join(b"\xff" + s for s in strings), np.uint8), np.cumsum([len(s) + 1 for s in strings])


def test_suffix_collection_against_sorting():
    rng = random.Random(3)
    for _ in range(40):
        strings = [bytes(rng.choice(b"ab") for _ in range(rng.randint(0, 14))) for _ in range(rng.randint(1, 12))]
        text, ends = packed(strings)
        start, common = suffixes.suffix_collection(text, ends)
        of = np.searchsorted(ends, start)
        want = sorted((s[k:], i) for i, s in enumerate(strings) for k in range(len(s) + 1))
        assert [(text[a:ends[i]].tobytes(), i) for a, i in zip(start, of)] == want
        for k in range(1, len(want)):
            a, b = want[k - 1][0], want[k][0]
            assert common[k] == next((n for n in range(min(len(a), len(b))) if a[n] != b[n]), min(len(a), len(b)))


def cut_by_hand(rows):
    """Per row (id, n_bytes, n_removed, n_spans, sha256 of what is left)."""
    width, owner = repeats.WIDTH, {}
    key = {k: (2**63 - 1 if k is None else k) for k, _ in rows}
    for k, text in rows:
        b = (text or "").encode()
        for at in range(len(b) - width + 1):
            w = b[at:at + width]
            owner[w] = min(owner.get(w, 2**64), key[k])
    out = []
    for k, text in rows:
        b = (text or "").encode()
        mask = np.zeros(len(b), bool)
        for at in range(len(b) - width + 1):
            if owner[b[at:at + width]] < key[k]:
                mask[at:at + width] = True
        spans = int((np.diff(mask.astype(int), prepend=0) == 1).sum())
        out.append((str(k), len(b), int(mask.sum()), spans, hashlib.sha256(np.frombuffer(b, np.uint8)[~mask].tobytes()).hexdigest()))
    return sorted(out)


def passages(seed=8):
    rng = random.Random(seed)
    syllables = ["the ", "and ", "tion", "er", "ß", "ö ", "in", "of ", "\n", "es"]
    some = ["".join(rng.choice(syllables) for _ in range(rng.randint(5, 60))) for _ in range(12)]
    rows = []
    for k in range(120):
        text = "".join(rng.choice(some) if rng.random() < 0.4 else "".join(rng.choice(syllables) for _ in range(rng.randint(1, 40)))
                       for _ in range(rng.randint(0, 12)))
        rows.append((rng.randint(0, 90), text))
    line = "The same line that stands in very many documents, always alike in all its words. "
    rows += [(200 + k, line * (k % 4)) for k in range(40)]
    rows += [(3, None), (4, ""), (None, rows[0][1] + line), (None, rows[1][1] + line), (5, "ab" * 4000), (6, "ab" * 3000), (7, "a" * 49), (8, "a" * 50), (9, "a" * 51)]
    return rows


def test_repeats_against_all_windows(spark, monkeypatch):
    monkeypatch.setattr(repeats, "FLUSH", 3000)
    monkeypatch.setattr(repeats, "SLICE_BYTES", 20_000)
    rows = passages()
    df = spark.createDataFrame(rows, DOCS).withColumns({"id": F.lit("x"), "home": F.lit(0), "block": F.lit(1), "kept": F.lit(2)})
    found = repeats.remove_repeats(df, keep=("kept", "home"))
    assert found.columns == ["doc_id", "n_bytes", "n_removed", "n_spans", "spans", "kept", "kept", "home"]
    found = found.toDF("doc_id", "n_bytes", "n_removed", "n_spans", "spans", "left", "kept", "home")
    got = [(str(r["doc_id"]), r["n_bytes"], r["n_removed"], r["n_spans"], hashlib.sha256(r["left"]).hexdigest()) for r in found.collect()]
    assert sum(r[2] for r in got) > 5000
    assert sorted(got) == cut_by_hand(rows)


def test_repeats_of_texts_longer_than_one_array(spark, monkeypatch):
    monkeypatch.setattr(repeats, "_PLACE", np.uint64((1 << 12) - 1))
    rng = random.Random(1)
    base = "".join(rng.choice("abcdefgh ") for _ in range(15_000))
    texts = [base.encode(), (base[3000:9000] + base[:2000]).encode()]
    keys, records = zip(*(repeats.stretches([t], np.array([k])) for k, t in enumerate(texts)))
    for t, record in zip(texts, records):  # every window once
        assert sorted(w for r in record for w in range(r["first"], r["first"] + r["windows"])) == list(range(len(t) - repeats.WIDTH + 1))
    assert len(np.intersect1d(*keys)) > 100


def test_repeats_without_rows_and_decoding(spark):
    assert repeats.remove_repeats(spark.createDataFrame([], DOCS)).count() == 0
    cut = spark.createDataFrame([(bytearray("aéb".encode()[:2]),), (bytearray(b"ok"),), (None,)], "kept binary")
    assert [r[0] for r in cut.select(repeats.decoded(F.col("kept"))).collect()] == ["a", "ok", None]

"""The pipeline: every stage against brute force on the smallest data set."""

import numpy as np

import corpus_pipeline
from riskframe.llm import pieces
from riskframe.llm.common import table, written

from test_llm_duplicates import cut_by_hand, sets_by_hand, smallest_reachable


def test_stages_against_brute_force(spark, sf_dir):
    docs = table(spark, sf_dir, "documents").limit(120)
    columns, kept = docs.columns, {"": docs.collect()}
    for name, stage in corpus_pipeline.STAGES:
        docs = written(stage(spark, docs, sf_dir), name)
        kept[name] = docs.collect()
        assert name == "tokens" or docs.columns == columns
    lettered = {r["doc_id"] for r in kept[""] if any(c.isalpha() for c in r["text"] or "")}
    assert {r["doc_id"] for r in kept["language"]} == lettered

    rows = sorted(kept["language"], key=lambda r: r["doc_id"])
    sets = [sets_by_hand(r["text"], 5) for r in rows]
    links = [(a, b) for a in range(len(sets)) for b in range(a + 1, len(sets)) if 100 * len(sets[a] & sets[b]) >= 80 * len(sets[a] | sets[b])]
    root = smallest_reachable(len(sets), links)
    assert {r["doc_id"] for r in kept["near_duplicates"]} == {r["doc_id"] for k, r in enumerate(rows) if root[k] == k}

    before = {r["doc_id"]: r["text"] for r in kept["near_duplicates"]}
    want = {int(k): (n, cut) for k, n, cut, *_ in cut_by_hand(list(before.items()))}
    after = {r["doc_id"]: r for r in kept["repeated_passages"]}
    assert set(after) == {k for k, (n, cut) in want.items() if cut < n}
    for k, r in after.items():
        n, cut = want[k]
        assert n - cut - 6 * 50 <= len(r["text"].encode()) <= n - cut and r["n_chars"] == len(r["text"])

    times = {k: 0 for k in after}
    for r in kept["source_mix"]:
        assert r["text"] == after[r["doc_id"]]["text"]
        times[r["doc_id"]] += 1
    assert set(times.values()) <= {0, 1, 2}
    words = sum(times[k] * len(r["text"].split()) for k, r in after.items())
    assert abs(words / sum(len(r["text"].split()) for r in after.values()) - 1.5) < 0.25

    reader = pieces.Pieces(pieces.read_model(), 0.0, 0)
    assert len(kept["tokens"]) == len(kept["source_mix"])
    for r in kept["tokens"]:
        assert reader.decode(np.array(r["pieces"]).tolist()) == after[r["doc_id"]]["text"]


def test_run_is_all_stages(spark, sf_dir):
    got = corpus_pipeline.run(spark, sf_dir)
    assert got.columns == ["doc_id", "lang", "source", "n_chars", "pieces"] and got.count() > 0
    assert corpus_pipeline.ORACLE_SQL is None and len(corpus_pipeline.STAGES) == 5


def test_rows_with_missing_and_repeated_ids(spark):
    kind = "doc_id long, source string, lang string, text string, n_chars long, component_id long"
    copied, other = "one two three four five six seven eight", "nine ten eleven twelve thirteen fourteen"
    rows = [(1, copied), (1, copied), (None, copied), (None, copied), (2, copied), (2, other), (None, other + " x" * 40), (3, ""), (3, None)]
    docs = spark.createDataFrame([(k, "s", None, t, len(t or ""), 5) for k, t in rows], kind)
    got = sorted(((r["doc_id"], r["text"]) for r in corpus_pipeline.near_duplicates(spark, docs, "").collect()), key=str)
    assert got == sorted([(1, copied), (2, other), (None, other + " x" * 40), (3, ""), (3, None)], key=str)
    # nothing to learn from: clean documents stay
    kept = corpus_pipeline.language(spark, docs, "")
    assert kept.columns == docs.columns and kept.count() == 7
    for stage in (corpus_pipeline.language, corpus_pipeline.near_duplicates):
        assert stage(spark, docs.limit(0), "").count() == 0


def test_repeats_stage_with_odd_rows_and_clashing_columns(spark):
    shared = "é" * 40 + " a passage of more than fifty bytes that both have, to the letter"
    rows = [(1, shared, 1, "x", 5), (2, "ü" + shared, 2, "y", 6), (3, None, 3, "z", 7), (None, shared, 4, "w", 8)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, n_chars long, kept string, n_removed long")
    got = {r["kept"]: r for r in corpus_pipeline.repeated_passages(spark, docs, "").collect()}
    assert set(got) == {"x", "y", "z"}  # of the last nothing is left
    assert [got[k]["text"] for k in "xyz"] == [shared, "ü", ""] and [got[k]["n_removed"] for k in "xyz"] == [5, 6, 7]
    assert [got[k]["n_chars"] for k in "xyz"] == [len(shared), 1, 0]
    assert corpus_pipeline.repeated_passages(spark, docs.limit(0), "").count() == 0

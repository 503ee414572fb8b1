"""Source mixing and licence scan against brute force, with their edge cases."""

import itertools
import re
import textwrap
from collections import defaultdict

import pytest
from pyspark.sql import functions as F

from riskframe.llm import licences, mixing
from riskframe.llm.licence_texts import KNOWN

WORDS = re.compile(r"[^\x20\x09-\x0D]+")
DOCS = "doc_id long, text string, source string"


def water_fill(sizes, weights=(3.0, 1.0, 2.0), share=1.5, cap=2.0):
    """Targets by repeated resharing of the excess."""
    order = sorted(s for s in sizes if s is not None) + ([None] if None in sizes else [])
    weight = {s: weights[k % len(weights)] for k, s in enumerate(order)}
    left, open_, out = share * sum(sizes.values()), set(order), {}
    while open_:
        total = sum(weight[s] for s in open_)
        over = {s for s in open_ if left * weight[s] / total >= cap * sizes[s]}
        if not over:
            out.update({s: left * weight[s] / total for s in open_})
            break
        for s in over:
            out[s] = cap * sizes[s]
            left -= out[s]
        open_ -= over
    return out


@pytest.mark.parametrize("case", range(4))
def test_targets_match_repeated_resharing(spark, case):
    table = [
        {"a": 100, "b": 10, "c": 50, None: 30}, {"a": 5}, {"s1": 0, "s2": 0}, {f"s{k}": (k * 37) % 91 for k in range(23)},
    ][case]
    rows = spark.createDataFrame([(s, n) for s, n in table.items()], "source string, size long")
    got = {r["source"]: r["target"] for r in mixing.source_targets(rows).collect()}
    want = water_fill(table)
    assert got.keys() == want.keys()
    for source, target in want.items():
        assert got[source] == pytest.approx(target, abs=1e-6)


def test_mix_meets_targets_and_reruns_agree(spark):
    rows = [(k, "w " * (1 + k * 7919 % 60), "hot" if k % 3 == 0 else f"s{k % 5}") for k in range(900)]
    docs = spark.createDataFrame(rows, DOCS)
    got = mixing.mix_sources(docs, fanout=8).collect()
    again = mixing.mix_sources(docs.repartition(7), fanout=8).collect()
    assert {(r["doc_id"], r["taken"]) for r in got} == {(r["doc_id"], r["taken"]) for r in again}
    taken, target = defaultdict(int), {}
    for r in got:
        assert r["taken"] in (0, r["size"], 2 * r["size"])
        taken[r["source"]] += r["taken"]
        target[r["source"]] = r["target"]
    for source in target:
        assert abs(taken[source] - target[source]) <= 60  # within one document


def test_rounding_keeps_every_expectation(spark):
    """Over many seeds each document is taken as often as its rate says."""
    docs = spark.createDataFrame([(k, "w " * (k % 4 + 1), "a" if k < 30 else "b") for k in range(60)], DOCS)
    seen, rate = defaultdict(float), {}
    for seed in range(12):
        for r in mixing.mix_sources(docs, seed=seed, fanout=4).collect():
            seen[r["source"]] += r["copies"] / 12 / 30
            rate[r["source"]] = r["target"] / r["source_size"]
    for source in rate:
        assert seen[source] == pytest.approx(rate[source], abs=0.12)


def test_mix_edge_cases(spark):
    empty = spark.createDataFrame([], DOCS)
    assert mixing.mix_sources(empty).count() == 0
    rows = [(1, None, None), (1, None, None), (2, "", "x"), (3, "a b c", None), (3, "a b c", None), (None, "q", "x"), (4, "w " * 5000, "x")]
    docs = spark.createDataFrame(rows, DOCS).withColumns({"size": F.lit("clash"), "target": F.lit(1), "rank": F.lit(0), "copies": F.lit(9)})
    got = mixing.mix_sources(docs).collect()
    assert len(got) == len(rows)
    assert all(r["taken"] == r["copies"] * r["size"] <= 2 * r["size"] for r in got)
    again = mixing.take(docs, mixing.mix_sources(docs))
    assert again.columns == docs.columns
    assert again.count() == sum(r["copies"] for r in got)


def test_repeated_rows_share_the_extra_copies(spark):
    docs = spark.createDataFrame([(7, "a b", "s")] * 40 + [(8, "c", "t")] * 40 + [(9, "z " * 400, "u")], DOCS)
    got = mixing.mix_sources(docs).collect()
    by_source = defaultdict(int)
    for r in got:
        by_source[r["source"]] += r["taken"]
    for r in got:
        assert abs(by_source[r["source"]] - r["target"]) <= 2 * r["size"]


def test_licences_found_under_other_spellings(spark):
    mit = KNOWN["MIT"]
    rows = [
        (1, "Copyright (c) 2020 Someone\n\n" + mit), (2, mit.upper().replace(",", " ;")), (3, mit.replace("sublicense", "sub-licence")),
        (4, mit + " and more"), (5, None), (6, ""), (7, "...!"), (8, "hello\nReleased under the MIT License\nbye"), (8, "x"),
        (9, "word " * 50000), (1, "Copyright (c) 2020 Someone\n\n" + mit),
    ]
    docs = spark.createDataFrame(rows, "doc_id long, text string").withColumns({"digest": F.lit(1), "license": F.lit("own")})
    got = licences.scan_licences(docs).collect()
    assert len(got) == len(rows)
    whole = sorted((r["doc_id"], r["license"]) for r in got if r["whole_text"])
    assert whole == [(1, "MIT"), (1, "MIT"), (2, "MIT"), (3, "MIT")]
    assert {r["doc_id"]: r["line_licenses"] for r in got if r["line_licenses"]} == {8: "MIT-statement"}
    assert len({r["digest"] for r in got if r["doc_id"] in (5, 6, 7)}) == 1
    assert licences.scan_licences(spark.createDataFrame([], "doc_id long, text string")).count() == 0


def test_licence_oracle_agrees(spark, sf_dir):
    duckdb = pytest.importorskip("duckdb")
    con = duckdb.connect()
    con.execute(f"CREATE VIEW documents AS SELECT * FROM '{sf_dir}/documents.parquet'")
    want = sorted(map(str, con.execute(licences.oracle()).fetchall()))
    got = sorted(str(tuple(r)) for r in licences.scan_licences(spark.read.parquet(f"{sf_dir}/documents.parquet")).collect())
    assert got == want


def test_known_licences_differ_after_normalising(spark):
    table = spark.createDataFrame(sorted(KNOWN.items()), "name string, text string")
    digests = [r[0] for r in table.select(licences.digest(F.col("text"))).collect()]
    assert all(a != b for a, b in itertools.combinations(digests, 2))


def test_licences_found_under_any_wrapping(spark):
    rows = []
    for name, text in KNOWN.items():
        for width in (40, 60, 72, 79, 100, 10**6):
            wrapped = "\n\n".join(textwrap.fill(p, width) for p in text.split("\n\n"))
            rows += [(name, wrapped), (name, "Copyright (c) 2020, Some One\n\n" + wrapped), (name, "# (C) 1999 Some One\n" + wrapped)]
    isc = KNOWN["ISC"].replace("\n", " ").replace("above copyright", "above\ncopyright")
    mit = " ".join(KNOWN["MIT"].split())
    rows += [("ISC", isc), ("MIT", "Copyright (c) 2020 Some One. " + mit), ("MIT", "Copyright Some One\n" + mit), ("MIT", "© Some One\r\n" + mit)]
    rows += [(None, "(c) You must keep this.\n" + mit), (None, "copyright law applies\n" + mit)]
    docs = spark.createDataFrame([(k, text) for k, (_, text) in enumerate(rows)], "doc_id long, text string")
    for r in licences.scan_licences(docs).collect():
        assert r["license"] == rows[r["doc_id"]][0], rows[r["doc_id"]]

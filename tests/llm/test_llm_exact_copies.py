"""Exact duplicates by content sort against brute force."""

import hashlib
import re

import pytest
from pyspark.sql import functions as F

from riskframe.llm.exact_copies import exact_copies

BLANK = re.compile(r"[\x20\x09-\x0D]")


def brute(rows):
    """Sorted (doc_id, keep_id, group_size, kept, sha256) of (doc_id, text) rows."""
    groups = {}
    for doc_id, text in rows:
        groups.setdefault(BLANK.sub("", text or ""), []).append((-len(text or ""), doc_id is None, doc_id or 0, doc_id))
    out = []
    for squeezed, members in groups.items():
        members.sort(key=lambda m: m[:3])
        sha = hashlib.sha256(squeezed.encode()).hexdigest()
        out += [(m[3], members[0][3], len(members), k == 0, sha) for k, m in enumerate(members)]
    return sorted(out, key=repr)


def found(spark, rows, **settings):
    df = spark.createDataFrame(rows, "doc_id long, text string")
    return sorted((tuple(r) for r in exact_copies(df, **settings).collect()), key=repr)


ODD = [
    (5, "a b"), (3, "ab"), (4, " a\tb"), (9, "a b "), (None, "a b "), (7, None), (8, ""), (6, " \n\x0b\x0c\r"),
    (1, "A b"), (2, "a b"), (2, "a b"), (2, "a b"), (None, "x"), (None, "x"), (11, "ñ ñ"), (10, "ññ"),
    (12, "z" * 300_000), (13, "z" * 299_999 + " z"), (14, "z" * 299_999 + "y"), (15, "a\x00b"), (16, "a\x00 b"),
]


def test_odd_texts(spark):
    assert found(spark, ODD) == brute(ODD)


@pytest.mark.parametrize("parts", [1, 3, 50])
def test_large_groups_are_split_and_joined(spark, parts):
    hot = [(k, "same text" + " " * (k % 3)) for k in range(400)] + [(None, "one  key") for _ in range(300)]
    rows = hot + [(1000 + k, f"text {k // 2}") for k in range(300)]
    assert found(spark, rows, parts=parts) == brute(rows)


def test_equal_rows_keep_one(spark):
    rows = [(1, "twice")] * 40 + [(2, "twice")] * 5
    got = found(spark, rows, parts=20)
    assert got == brute(rows)
    assert sum(r[3] for r in got) == 1


def test_empty_table_and_clashing_columns(spark):
    assert found(spark, []) == []
    df = spark.createDataFrame([(1, "a", "m"), (2, "a ", "n")], "doc_id long, text string, mark string")
    df = df.withColumn("squeezed", F.lit(1)).withColumn("digest", F.lit(2)).withColumn("id", F.lit(3)).withColumn("keep", F.lit(0))
    got = {r["doc_id"]: (r["keep_id"], r["kept"]) for r in exact_copies(df).collect()}
    assert got == {1: (2, False), 2: (2, True)}


def test_sort_is_the_only_wide_step_of_texts(spark):
    df = spark.createDataFrame([(1, "a")], "doc_id long, text string")
    plans = exact_copies(df)._jdf.queryExecution().executedPlan().toString()
    assert "Python" not in plans and "Arrow" not in plans

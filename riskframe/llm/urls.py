"""URL filter: rules first, then naive Bayes over tokens of the segmented host and path.

Concatenated host names are cut into words by unigram Viterbi: the word counts are those of all page titles, a
label's candidate words are its substrings joined with that table, and the best cut is found per distinct
label. The Bayes model learns from all URLs under weak labels: those with a word of a seed list are examples of
blocked ones, all others of allowed ones, so words that keep company with the seeds count, too. Rules are policy:
they override the model and do not train it. Tokens are scored by joining them with the token table, so neither
vocabulary has to fit in one place.
"""

from __future__ import annotations

import math

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..session import local_frame
from .common import ascii_lower, written

#: Rules as (host, path, verdict).
RULES = (("net", "/", "block"), ("example.net", "/en/", "allow"), ("example.com", "/de/", "block"), ("org", "/fr/", "allow"))
# Words that mark a URL as an example of the blocked class.
SEEDS = (
    "ads", "adult", "bet", "bets", "betting", "bingo", "casino", "cheap", "crack", "escort", "gambling", "hack", "jackpot", "keygen",
    "loan", "loans", "lottery", "malware", "nude", "payday", "phishing", "pills", "poker", "porn", "prize", "replica",
    "sex", "slots", "spam", "torrent", "viagra", "warez", "win", "winner", "xxx",
)
#: Seed words are counted this share of the total more often in the unigram model, so that a corpus of any size cuts alike.
SEED_SHARE = 1e-4
#: Longest word of the unigram model, in characters; longer runs are cut or spelled out by single characters.
MAX_WORD = 24


def host_of(url: Column) -> Column:
    """From the first ``://`` up to ``/``, ``?``, ``#`` or the end, A-Z lower-cased; else empty."""
    rest = _rest(url)
    return ascii_lower(F.regexp_extract(rest, r"(?s)^([^/?#]*)", 1))


def path_of(url: Column) -> Column:
    """What follows the host up to ``?``, ``#`` or the end; empty without ``://``."""
    return F.regexp_extract(_rest(url), r"(?s)^[^/?#]*([^?#]*)", 1)


def _rest(url: Column) -> Column:
    at = F.locate("://", url)
    return F.when(at > 0, F.substring(url, at + F.lit(3), F.length(url))).otherwise(F.lit(""))


def judged_by_rules(df: DataFrame, rules=RULES) -> DataFrame:
    """Add rule and rule_verdict (null if none fits) to rows with host and path; the longest rule wins.

    ``rules`` is a parameter list: host, path and verdict each. Equally long rules that fit: the smaller text.
    """
    fits = []
    for host, path, verdict in rules:
        match = ((F.col("host") == host) | F.endswith("host", F.lit("." + host))) & F.startswith("path", F.lit(path))
        fits.append(F.when(match, F.struct(
            F.lit(-len(host + path)).alias("order"), F.lit(host + path).alias("rule"), F.lit(verdict).alias("verdict"))))
    best = F.array_min(F.array_compact(F.array(*fits)))
    return df.withColumn("best", best).select(
        *df.columns, F.col("best.rule").alias("rule"), F.col("best.verdict").alias("rule_verdict"))


def word_counts(df: DataFrame, html_col: str = "html") -> DataFrame:
    """word, n over the titles of all pages: lower-cased runs of letters of at most ``MAX_WORD`` characters."""
    title = F.regexp_extract(F.coalesce(F.col(f"`{html_col}`"), F.lit("")), r"(?is)<title[^>]*>(.*?)</title>", 1)
    words = df.select(F.explode(F.split(F.lower(title), r"\P{L}+")).alias("word"))
    return words.where((F.length("word") > 0) & (F.length("word") <= MAX_WORD)).groupBy("word").agg(F.count("*").alias("n"))


def best_cut(label: str, starts, lengths, logs, unknown: float) -> list[str]:
    """Viterbi over one label: known words at their log probability, any single character at ``unknown``."""
    n = len(label)
    score = np.full(n + 1, -np.inf)
    score[0], back = 0.0, [0] * (n + 1)
    by_end: dict[int, list[tuple[int, float]]] = {}
    for s, k, p in zip(starts, lengths, logs):
        by_end.setdefault(int(s) + int(k), []).append((int(s), float(p)))
    for end in range(1, n + 1):
        score[end], back[end] = score[end - 1] + unknown, end - 1
        for s, p in by_end.get(end, ()):
            if score[s] + p > score[end]:
                score[end], back[end] = score[s] + p, s
    cut, end = [], n
    while end:
        cut.append(label[back[end]:end])
        end = back[end]
    return cut[::-1]


def with_seeds(words: DataFrame, seeds) -> DataFrame:
    """``words(word, n)`` where every seed word has ``SEED_SHARE`` of the total count, or 1, on top of its own."""
    seed_words = local_frame(words.sparkSession, [(w,) for w in sorted(set(seeds))], "word string")
    more = math.ceil(SEED_SHARE * int(words.agg(F.sum("n")).first()[0] or 0)) or 1
    both = words.unionByName(seed_words.withColumn("n", F.lit(more).cast("long")))
    return both.groupBy("word").agg(F.sum("n").alias("n"))


def segmented(labels: DataFrame, words: DataFrame) -> DataFrame:
    """label, words (array) for the distinct ``labels(label)`` by the counts in ``words(word, n)``."""
    total, kinds = words.agg(F.sum("n"), F.count("*")).first()
    total, kinds = int(total or 0), int(kinds)
    unknown = -math.log(total + kinds + 1) - 2.0
    size = F.length("label")
    spans = labels.select("label", F.explode(F.sequence(F.lit(0), size - 1)).alias("start")).select(
        "label", "start", F.explode(F.sequence(F.lit(1), F.least(F.lit(MAX_WORD), size - F.col("start")))).alias("k"))
    spans = spans.withColumn("word", F.expr("substring(label, start + 1, k)"))
    scored = spans.join(words, "word").select(
        "label", F.struct("start", "k", (F.log(F.col("n") + 1.0) - F.lit(math.log(total + kinds + 1))).alias("p")).alias("w"))
    found = labels.join(scored.groupBy("label").agg(F.sort_array(F.collect_list("w")).alias("w")), "label", "left")

    @F.pandas_udf("array<string>")
    def cut(label: pd.Series, w: pd.Series) -> pd.Series:
        rows = []
        for text, spans_of in zip(label, w):
            spans_of = [] if spans_of is None else list(spans_of)
            rows.append(best_cut(text, *zip(*[(x["start"], x["k"], x["p"]) for x in spans_of]), unknown)
                        if spans_of else list(text))
        return pd.Series(rows)

    return found.select("label", cut("label", "w").alias("words"))


def filter_urls(
    df: DataFrame, id_col: str = "page_id", url_col: str = "url", html_col: str = "html", rules=RULES, seeds=SEEDS,
    smoothing: float = 1.0,
) -> DataFrame:
    """Per row: id, host, path, rule (null if none fits), verdict (allow or block) and the Bayes log odds of block.

    Null URLs and URLs without ``://`` have empty host and path and no tokens: the class prior decides. Ties
    and data without any seed word allow. Numbers in a path are one token whatever their value. Equal rows are
    judged alike. Seed words have a share of the unigram model, so that they can be cut out of a name.
    """
    url = F.coalesce(F.col(f"`{url_col}`"), F.lit(""))
    pages = written(
        judged_by_rules(df.select(F.col(f"`{id_col}`").alias("id"), host_of(url).alias("host"), path_of(url).alias("path")), rules),
        "urls")
    # one row per distinct host and shape of path: ids in a path and repeated hosts are judged once
    shape = F.regexp_replace(ascii_lower(F.col("path")), r"[0-9]+", "0")
    kinds = written(pages.groupBy("host", shape.alias("shape")).agg(F.count("*").alias("n")), "shapes")
    seed_words = local_frame(df.sparkSession, [(w,) for w in sorted(set(seeds))], "word string")
    words = written(with_seeds(written(word_counts(df, html_col), "title-words"), seeds), "words")
    parts = F.explode(F.split(F.concat_ws("/", "host", "shape"), r"[^\p{L}]+")).alias("label")
    labels = kinds.select(parts).where(F.length("label") > 0).distinct()
    names = written(segmented(labels, words), "names")

    def tokens_of(column: str, prefix: str) -> DataFrame:
        pieces = F.explode(F.split(column, r"[^\p{L}]+")).alias("label")
        cut = kinds.select(column).distinct().select(column, pieces).join(names, "label")
        cut = cut.select(column, F.explode("words").alias("word"))
        return kinds.join(cut, column).select("host", "shape", "n", "word", F.concat(F.lit(prefix), "word").alias("token"))

    tokens = written(tokens_of("host", "h:").unionByName(tokens_of("shape", "p:")), "tokens")
    marked = tokens.join(seed_words, "word", "left_semi").select("host", "shape").distinct().withColumn("seeded", F.lit(True))
    tokens = written(tokens.join(marked, ["host", "shape"], "left"), "labelled")
    seeded = F.col("seeded").isNotNull()
    counts = tokens.groupBy("token").agg(
        F.sum(F.when(seeded, F.col("n")).otherwise(0)).alias("b"), F.sum(F.when(~seeded, F.col("n")).otherwise(0)).alias("a"))
    counts = written(counts, "tokens-by-class")
    tb, ta, vocabulary = counts.agg(F.sum("b"), F.sum("a"), F.count("*")).first()
    nb, n = kinds.join(marked, ["host", "shape"], "left").agg(F.sum(F.when(seeded, F.col("n"))), F.sum("n")).first()
    nb, na = nb or 0, (n or 0) - (nb or 0)
    tb, ta = (tb or 0) + smoothing * (vocabulary + 1), (ta or 0) + smoothing * (vocabulary + 1)
    prior = math.log((nb + smoothing) / (na + smoothing))
    odds = F.log((F.col("b") + smoothing) / F.lit(tb)) - F.log((F.col("a") + smoothing) / F.lit(ta))
    per_kind = tokens.join(counts, "token").groupBy("host", "shape").agg(F.sum(odds).alias("odds"))
    scored = kinds.join(per_kind, ["host", "shape"], "left").select(
        "host", "shape", (F.coalesce("odds", F.lit(0.0)) + F.lit(prior)).alias("log_odds"))
    judged = pages.withColumn("shape", shape).join(written(scored, "scores"), ["host", "shape"])
    guess = F.when((F.col("log_odds") > 0) & F.lit(nb > 0), "block").otherwise("allow")
    return judged.select(
        F.col("id").alias(id_col), "host", "path", "rule", F.coalesce("rule_verdict", guess).alias("verdict"), "log_odds")

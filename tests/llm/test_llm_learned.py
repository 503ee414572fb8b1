"""Language, quality and URL models: their parts against brute force, held-out accuracy, edge cases."""

import math
import random
import re
import zlib

import numpy as np
import pytest
from pyspark.sql import functions as F

from riskframe.llm import language, quality, queries, urls


def phrases(text, sample):
    """Longest-match phrases of ``text`` in ``sample`` by search."""
    count, at = 0, 0
    while at < len(text):
        size = 1
        while at + size < len(text) and text[at:at + size + 1] in sample:
            size += 1
        count, at = count + 1, at + size
    return max(count, 1)


def test_automaton_cuts_the_longest_phrases():
    rng = random.Random(5)
    samples = tuple((name, "".join(rng.choice(letters) for _ in range(300)).encode()) for name, letters in (("x", "abc "), ("y", "abd ")))
    model = language.Automata(samples)
    texts = ["".join(rng.choice("abcd ") for _ in range(rng.randint(1, 200))) for _ in range(40)]
    texts = [re.sub(" +", " ", t) for t in texts]
    ends = np.cumsum([len(t) for t in texts])
    bits = model.bits_per_symbol(np.frombuffer("".join(texts).encode(), np.uint8), ends)
    for k, (_, sample) in enumerate(samples):
        for t, got in zip(texts, bits[k]):
            assert got * len(t) / model.bits[k] == pytest.approx(phrases(t, sample.decode()))


def test_blocks_of_a_long_text_add_up():
    model = language.Automata((("x", b"the quick brown fox jumps over the lazy dog "),))
    text = ("quick brown dog the fox " * 400).encode()
    whole = model.bits_per_symbol(np.frombuffer(text, np.uint8), np.array([len(text)]))[0, 0]
    parts = [model.bits_per_symbol(np.frombuffer(text[a:a + language.BLOCK], np.uint8), np.array([len(text[a:a + language.BLOCK])]))[0, 0]
             * len(text[a:a + language.BLOCK]) for a in range(0, len(text), language.BLOCK)]
    assert whole * len(text) == pytest.approx(sum(parts))


def test_languages_of_held_out_documents(spark, sf_dir):
    got = queries.op3_language_id(spark, sf_dir).join(spark.read.parquet(f"{sf_dir}/documents.parquet"), "doc_id").collect()
    held = [r for r in got if r["held_out"]]
    assert all(r["held_out"] == (zlib.crc32(str(r["doc_id"]).encode()) % 4 == 2) for r in got)
    assert sum(r["lang_pred"] == r["lang"] for r in held) >= 0.95 * len(held)
    assert all(0 <= r["score"] <= 1 for r in got)


def test_language_edge_cases(spark):
    rows = [(1, "the cat and the dog"), (2, None), (3, ""), (4, "123 ... !"), (5, "the " * 100000), (None, "der Hund und die Katze"), (1, "the cat and the dog")]
    docs = spark.createDataFrame(rows, "doc_id long, text string").withColumns({"lang": F.lit("zz"), "score": F.lit("x"), "lang_pred": F.lit(0)})
    samples = (("de", "der hund und die katze der der und und".encode()), ("en", b"the cat and the dog in the of and the"))
    got = language.identify_languages(docs, samples).collect()
    assert sorted((str(r["doc_id"]), r["lang_pred"]) for r in got) == sorted(
        [("1", "en"), ("1", "en"), ("2", "und"), ("3", "und"), ("4", "und"), ("5", "en"), ("None", "de")])
    assert {r["lang_pred"] for r in language.identify_languages(docs, ()).collect()} == {"und"}
    assert language.with_language(docs, samples).columns == ["doc_id", "text", "lang", "lang_pred", "score"]
    assert language.identify_languages(docs.limit(0), samples).count() == 0
    assert language.learning_sample(spark.createDataFrame([(None, "abc"), ("en", None), ("de", "12")], "lang string, text string")) == ()
    one = language.identify_languages(docs.where("doc_id = 1"), samples[:1]).first()
    assert (one["lang_pred"], one["score"]) == ("de", 1.0)


def test_isotonic_curve_rises_and_pools():
    x = np.array([0.0, 1.0, 2.0, 3.0, 4.0, 5.0])
    points, chances = quality._isotonic(x, np.array([0, 0, 1, 0, 1, 1]), 0.5)
    assert list(chances) == sorted(chances) and chances[0] == 0 and chances[-1] == 1
    assert chances[1] == pytest.approx(0.5) and points[1] == pytest.approx(2.5)


def test_quality_of_held_out_documents(spark, sf_dir):
    sf_dir = sf_dir.replace("sf0.001", "sf0.01")
    got = queries.op4_quality_classifier(spark, sf_dir).join(spark.read.parquet(f"{sf_dir}/labels.parquet"), "doc_id").collect()
    held = [r for r in got if r["held_out"] and r["quality"] is not None]
    assert all(r["held_out"] == (zlib.crc32(str(r["doc_id"]).encode()) % 5 == 0) for r in got)
    assert sum(r["predicted"] == r["quality"] for r in held) >= 0.9 * len(held)
    assert all(0 <= r["score"] <= 1 and r["predicted"] == int(r["score"] >= 0.3) for r in got)


def test_quality_edge_cases(spark):
    rows = [(1, "good words in good order " * 5), (2, None), (3, ""), (4, "# % # % # " * 30), (5, "x" * 300000), (None, "abc"), (1, "again")]
    docs = spark.createDataFrame(rows, "doc_id long, text string").withColumns({"score": F.lit("s"), "quality": F.lit(3), "id": F.lit(0)})
    labels = spark.createDataFrame([(1, 1), (4, 0), (9, 1), (None, 0), (2, None)], "doc_id long, quality int")
    model = quality.fit_quality(docs, labels)
    got = quality.score_quality(docs, model).collect()
    assert len(got) == len(rows) and all(0 <= r["score"] <= 1 for r in got)
    few = quality.fit_quality(docs.limit(0), labels.limit(0))
    assert {round(r["score"], 2) for r in quality.score_quality(docs, few).collect()} == {0.5}
    assert quality.score_quality(docs.limit(0), model).count() == 0


def test_difference_covers_the_whole_text():
    good, bad = (quality._compressor(x) for x in (b"alpha beta gamma " * 40, b"### %%% $$$ " * 40))
    text = "alpha beta gamma " * 500
    by_hand = sum(len(bad.compress(b)) - len(good.compress(b)) for b in (text.encode()[a:a + quality.BLOCK] for a in range(0, len(text), quality.BLOCK)))
    assert quality.difference(text, good, bad) == by_hand / len(text) > 0


def by_hand(url):
    """Host, path, rule and its verdict."""
    host = path = ""
    if url and "://" in url:
        rest = url.split("://", 1)[1]
        host = re.match(r"[^/?#]*", rest).group().translate({k: k + 32 for k in range(65, 91)})
        path = re.match(r"[^?#]*", rest[len(host):]).group()
    fits = [(len(h + p), h + p, v) for h, p, v in urls.RULES if (host == h or host.endswith("." + h)) and path.startswith(p)]
    return (host, path, *(max(fits)[1:] if fits else (None, None)))


def test_hosts_paths_and_rules(spark):
    samples = [
        None, "", "no scheme", "http://A.Example.NET/en/x?q=1#f", "https://net/", "http://net", "ftp://x.example.com/de/1", "x://example.com/de", "http://a.org/fr/2",
        "http://evilorg/fr/", "http://u:p@h.org:80/FR/", "a://b://c.net/d", "http://?q", "http://#", "//x.net/", "http://ex.net/a\nb?c", "http://Ä.net/",
    ]
    pages = spark.createDataFrame(list(enumerate(samples)), "page_id long, url string").withColumns({"html": F.lit(None).cast("string"), "host": F.lit(1), "verdict": F.lit(2)})
    got = urls.filter_urls(pages).collect()
    assert len(got) == len(samples)
    for r in got:
        host, path, rule, verdict = by_hand(samples[r["page_id"]])
        assert (r["host"], r["path"], r["rule"]) == (host, path, rule)
        assert r["verdict"] == (verdict or r["verdict"]) and r["verdict"] in ("allow", "block")
    assert urls.filter_urls(pages.limit(0)).count() == 0


def test_best_cut_against_all_cuts():
    words = {"casino": -3.0, "win": -2.0, "cas": -4.0, "in": -1.5, "ow": -5.0}
    unknown = -12.0

    def all_cuts(text):
        if not text:
            yield 0.0, []
        for k in range(1, len(text) + 1):
            p = words.get(text[:k], unknown if k == 1 else None)
            if p is not None:
                for score, rest in all_cuts(text[k:]):
                    yield score + p, [text[:k], *rest]

    for text in ("casinowin", "winow", "zzz", "casin", "w"):
        spans = [(a, b - a, words[text[a:b]]) for a in range(len(text)) for b in range(a + 1, len(text) + 1) if text[a:b] in words]
        cut = urls.best_cut(text, *(zip(*spans) if spans else ((), (), ())), unknown)
        score = sum(words.get(w, unknown) for w in cut)
        assert "".join(cut) == text and score == pytest.approx(max(all_cuts(text))[0])


def test_bayes_against_counts_by_hand(spark):
    """Log odds of a clean and a seeded URL from token counts."""
    pages = spark.createDataFrame(
        [(1, "http://casinowin.com/a", None), (2, "http://garden.com/b", None), (3, "http://garden.com/b", None)],
        "page_id long, url string, html string").withColumn(
        "html", F.lit("<title>garden com com casino win a b</title>"))
    got = {r["page_id"]: r["log_odds"] for r in urls.filter_urls(pages).collect()}
    block = {"h:casino": 1, "h:win": 1, "h:com": 1, "p:a": 1}
    allow = {"h:garden": 2, "h:com": 2, "p:b": 2}
    kinds = len({*block, *allow}) + 1

    def odds(tokens):
        return math.log(2 / 3) + sum(
            math.log((block.get(t, 0) + 1) / (4 + kinds)) - math.log((allow.get(t, 0) + 1) / (6 + kinds)) for t in tokens)

    assert got[1] == pytest.approx(odds(block)) and got[1] > 0
    assert got[2] == got[3] == pytest.approx(odds(allow)) and got[2] < 0


@pytest.mark.parametrize("times", [1, 1000])
def test_seed_words_stay_whole_in_titles_of_any_size(spark, times):
    title = ("be t w in lo an por n arez " + "filler words of a page " * 60) * times
    seeded = ["win", "bet", "loan", "porn", "warez"]
    names = [*seeded, "garden", "page", "words", "filler", "pages", "wordpage", "fillerpage"]
    pages = spark.createDataFrame(
        [(k, f"http://{name}.com/a", f"<title>{title if k == 0 else 'com'}</title>") for k, name in enumerate(names)], "page_id long, url string, html string")
    got = {names[r["page_id"]]: r["verdict"] for r in urls.filter_urls(pages).collect()}
    assert {name for name, verdict in got.items() if verdict == "block"} == set(seeded)


def test_language_sample_is_not_what_all_texts_open_with(spark):
    rng = random.Random(3)
    banner = "Home | About | Terms of use | All rights reserved to the holders. " * 8
    words = {"de": "der hund und die katze gehen heute nicht mehr nach hause weil es regnet".split(),
             "fr": "le chien et la chatte ne vont plus chez eux parce que cela mouille".split()}
    bodies = [(lang, " ".join(rng.choice(w) for _ in range(300))) for lang, w in words.items() for _ in range(200)]
    samples = language.learning_sample(spark.createDataFrame([(lang, banner + body) for lang, body in bodies], "lang string, text string"))
    assert [name for name, _ in samples] == ["de", "fr"]
    for name, sample in samples:
        pieces = sample.decode().split("\n")
        assert len(set(pieces)) == len(pieces) <= language.SAMPLE_TEXTS
        assert sum(piece not in banner * 2 for piece in pieces) > len(pieces) / 3
    docs = spark.createDataFrame([(k, body) for k, (_, body) in enumerate(bodies)], "doc_id long, text string")
    assert all(r["lang_pred"] == bodies[r["doc_id"]][0] for r in language.identify_languages(docs, samples).collect())
    late = spark.createDataFrame([("xx", "1 " * 5000 + "abc"), ("yy", "abc" + " 1" * 5000)], "lang string, text string")
    assert [name for name, _ in language.learning_sample(late)] == ["xx", "yy"]

"""Pieces: the library's own result without dropout, lossless round trips with it."""

import numpy as np
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

import corpus_pipeline
from riskframe.llm import pieces

sentencepiece = pytest.importorskip("sentencepiece")
MODEL = pieces.read_model()
PLAIN, VARIED = pieces.Pieces(MODEL, 0.0, 1), pieces.Pieces(MODEL, 0.3, 1)
LIBRARY = sentencepiece.SentencePieceProcessor(model_file=pieces.MODEL)


def ids(of, text, key="1"):
    return np.frombuffer(of.encode(text, key), np.int32).tolist()


def merged(of, unit, key):
    """The pieces of one unit under a key, by the operator."""
    return of.merged([unit], None if key is None else np.array([key], np.uint64))[0].tolist()


def hashed(key, number):
    """The keyed hash with Python's integers."""
    x = (key + (number + 1) * 0x9E3779B97F4A7C15) % 2**64
    x = (x ^ x >> 30) * 0xBF58476D1CE4E5B9 % 2**64
    x = (x ^ x >> 27) * 0x94D049BB133111EB % 2**64
    return x ^ x >> 31


def merged_by_hand(unit, key, chance):
    """Merge the best pair of neighbours again and again; a pair once skipped stays apart until one of it changes."""
    scores = {LIBRARY.id_to_piece(k).replace("▁", " "): LIBRARY.get_score(k) for k in range(len(LIBRARY)) if not
              (LIBRARY.is_byte(k) or LIBRARY.is_control(k) or LIBRARY.is_unknown(k))}
    parts, skipped, number = [(c, k) for k, c in enumerate(unit)], set(), 0
    while True:
        pairs = [(-scores[a + b], k) for k, ((a, m), (b, n)) in enumerate(zip(parts, parts[1:]))
                 if a + b in scores and a in scores and b in scores and (a, m, b, n) not in skipped]
        if not pairs:
            return [a for a, _ in parts], number
        at = min(pairs)[1]
        (a, m), (b, n) = parts[at:at + 2]
        number += 1
        if key is not None and hashed(key, number - 1) / 2**64 < chance:
            skipped.add((a, m, b, n))
        else:
            parts[at:at + 2] = [(a + b, m)]


@settings(max_examples=300, deadline=None)
@given(st.text(alphabet=st.one_of(st.sampled_from(" abcdeths.,\n\t12'éß»…▁²"), st.characters(exclude_categories=["Cs"])), max_size=60))
def test_round_trip_and_plain_merges(text):
    assert PLAIN.decode(ids(PLAIN, text)) == text
    assert VARIED.decode(ids(VARIED, text)) == text
    if "▁" not in text and "\0" not in text:
        assert ids(PLAIN, text) == LIBRARY.encode(text)


def test_dropout_varies_with_place_and_seed_and_reruns_agree():
    text = "international understanding " * 40
    assert ids(VARIED, text) == ids(pieces.Pieces(MODEL, 0.3, 1), text)
    assert ids(VARIED, text) != ids(pieces.Pieces(MODEL, 0.3, 2), text)
    words = {tuple(merged(VARIED, " understanding", v)) for v in range(4096)}
    assert len(words) > 1
    assert len(ids(VARIED, text)) > len(ids(PLAIN, text))


def test_encode_and_decode_tables(spark):
    rows = [(1, "Hello  world\n"), (2, None), (3, ""), (4, "word " * 20000), (None, "x▁y"), (1, "Hello  world\n"), (5, "q" * 3000)]
    docs = spark.createDataFrame(rows, "doc_id long, text string").withColumns({"pieces": F.lit("clash"), "id": F.lit(1), "decoded": F.lit(2)})
    encoded = pieces.encode_pieces(docs, keep=("id",))
    assert encoded.columns == ["doc_id", "text", "id", "pieces"]
    got = pieces.decode_pieces(encoded).collect()
    assert len(got) == len(rows)
    assert all(r["decoded"] == r["text"] for r in got)
    assert all((r["pieces"] is None) == (r["text"] is None) for r in got)
    assert len({str(r["pieces"]) for r in got if r["doc_id"] == 1}) == 1
    assert pieces.decode_pieces(pieces.encode_pieces(docs.limit(0))).count() == 0


def test_every_place_and_document_has_draws_of_its_own():
    word, times = " understanding", 4000
    plain = tuple(merged(PLAIN, word, None))

    def cuts(of, key):
        """The pieces of each occurrence."""
        out = [[]]
        for k in ids(of, (word * times)[1:], key):
            if len(b"".join(of.bytes_of[x] for x in out[-1])) == len(word):
                out.append([])
            out[-1].append(k)
        return [tuple(x) for x in out]

    of = pieces.Pieces(MODEL, 0.1, 17)
    first, second = cuts(of, "1"), cuts(of, "2")
    assert len(first) == times and len(set(first)) > 8
    assert first != second and first == cuts(pieces.Pieces(MODEL, 0.1, 17), "1")
    merges = int(of.merged([word], None)[2][0])
    whole = sum(x == plain for x in first) / times
    assert 0.9**merges < whole < 0.9  # none of its merges drops, or others make up for it


@pytest.mark.parametrize("chance", [0.1, 0.5, 1.0])
def test_draws_have_the_chance_of_dropout(chance):
    of = pieces.Pieces(MODEL, chance, 3)
    keys = np.arange(40000, dtype=np.uint64)
    draws = [of._skips(keys, np.full(len(keys), k)) for k in range(20)]
    assert np.mean(draws) == pytest.approx(chance, abs=0.003)
    if chance < 1:  # neighbouring keys and candidates are independent
        assert np.mean(draws[0] & draws[1]) == pytest.approx(chance**2, abs=0.008)
        assert np.mean(draws[0][1:] & draws[0][:-1]) == pytest.approx(chance**2, abs=0.008)


@pytest.mark.parametrize("chance", [0.0, 0.1, 0.5, 1.0])
def test_merges_against_brute_force(chance, monkeypatch):
    words = [" understanding", " internationalisations", "aaaaaaaaaaaaaaaaaaaa", "x", " ", "....", " the", "\n", "naïveté"] * 9
    of = pieces.Pieces(MODEL, chance, 3)
    keys = np.random.default_rng(2).integers(1 << 63, size=len(words)).astype(np.uint64)
    got, sizes, came = of.merged(words, keys if chance else None)
    want = [merged_by_hand(w, int(k) if chance else None, chance) for w, k in zip(words, keys)]
    ends = np.cumsum(sizes)
    text = [[of.bytes_of[k].decode() for k in got[b - n:b].tolist()] for b, n in zip(ends, sizes)]
    assert text == [x for x, _ in want] and came.tolist() == [n for _, n in want]
    # long units are merged by a heap instead
    monkeypatch.setattr(pieces, "SHORT", 0)
    assert of.merged(words, keys if chance else None)[0].tolist() == got.tolist()


def test_blocks_windows_and_the_table_change_nothing(monkeypatch):
    text = "".join(["international understanding, 12 governments\n", "q" * 90, " é▁ 漢字 ...   x "][k % 3] * (k % 5) for k in range(300))
    of = pieces.Pieces(MODEL, 0.2, 5)
    texts, keys = [text, None, "", text[7:], text], ["1", "2", "3", "4", "5"]
    whole, sizes = of.encode_all(texts, keys)
    assert sizes[1] == sizes[2] == 0 and sizes.sum() == len(whole)
    for k, end in enumerate(np.cumsum(sizes).tolist()):
        assert of.decode(whole[end - sizes[k]:end].tolist()) == (texts[k] or "")
    for name, value in (("BLOCK", 50), ("WINDOW", 7), ("KEEP_BYTES", 1000)):
        monkeypatch.setattr(pieces, name, value)
        again, counts = pieces.Pieces(MODEL, 0.2, 5).encode_all(texts, keys)
        assert again.tolist() == whole.tolist() and counts.tolist() == sizes.tolist()


def test_copies_of_a_document_differ(spark):
    text = "international understanding of governments " * 30
    docs = spark.createDataFrame([(1, text, "en", "s", 9)] * 2 + [(2, text, "en", "s", 9)], "doc_id long, text string, lang string, source string, n_chars long")
    got = corpus_pipeline.tokens(spark, docs, "").collect()
    assert len(got) == 3 and len({tuple(r["pieces"]) for r in got}) == 3
    assert sorted(map(str, got)) == sorted(map(str, corpus_pipeline.tokens(spark, docs.repartition(3), "").collect()))


@settings(max_examples=200, deadline=None)
@given(st.lists(st.text(alphabet=st.one_of(st.sampled_from(" abc.,\n\t12'éß»▁²_"), st.characters()), max_size=40), min_size=1, max_size=6))
def test_units_of_many_texts_are_cut_at_once_as_the_pattern_cuts_them(texts):
    """Cutting text by text with the pattern took a sixth of the operator's time."""
    texts = [" " + text for text in texts]
    units, counts = pieces._units_of(texts)
    assert units == [unit for text in texts for unit in pieces.UNIT.findall(text)]
    assert counts.tolist() == [len(pieces.UNIT.findall(text)) for text in texts]


def test_every_character_is_of_one_kind():
    everything = list(map(chr, range(0x110000)))
    assert pieces._kinds().tolist() == [
        2 if c == " " else 3 if c == "\n" else 0 if pieces.re.match(pieces._LETTER, c) else 1 for c in everything]
    assert all(pieces.re.match(pieces._MARK, c) for c, kind in zip(everything, pieces._kinds().tolist()) if kind == 1)


def test_candidates_are_found_in_one_probe_or_few():
    """Every pair of the merge table and no other, also from slots that several pairs share."""
    rng = np.random.default_rng(3)
    pairs = np.array([*PLAIN.merges, *rng.integers(0, 1 << 32, 50_000), -1, -65536], np.int64)
    found = PLAIN._found(pairs >> 16, pairs & 0xFFFF, np.full(len(pairs), 5))
    assert found.tolist() == [PLAIN.merges[p] | 5 << pieces._PLACE if p in PLAIN.merges else pieces._NONE for p in pairs.tolist()]
    slots, candidates, shift = pieces._slots({k: k + 1 for k in range(1000)})
    assert len(slots) >= 4000 and sorted(slots[slots != pieces._NONE].tolist()) == list(range(1000))


@pytest.mark.parametrize("window", [8, 40, pieces.WINDOW])
def test_texts_in_groups_and_in_windows_have_the_same_pieces(monkeypatch, window):
    texts = ["a short one", None, "", "  two  spaces \n and lines\n", "x" * 90 + " longer. " * 9, "\n", " ", "end, here!!"] * 3
    keys = [str(k) for k in range(len(texts))]
    alone = [ids(VARIED, text, key) if text else [] for text, key in zip(texts, keys)]
    monkeypatch.setattr(pieces, "WINDOW", window)
    together, sizes = VARIED.encode_all(texts, keys)
    assert sizes.tolist() == list(map(len, alone)) and together.tolist() == sum(alone, [])

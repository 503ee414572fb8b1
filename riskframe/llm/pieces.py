"""SentencePiece BPE with seeded merge-dropout, and its lossless inverse.

A text is cut into units no piece can cross: no piece of the vocabulary has a space after another character,
punctuation or digits after a letter, or a line feed among others. Each unit is merged by an agenda of candidate
pairs, best piece first, leftmost first. A candidate that comes up is skipped for good where its keyed hash, of the
seed, the document's id, the unit's place and the candidate's number in order of coming up, is below the chance of
dropout: every candidate of every place has a draw of its own, and reruns agree.

Agendas of many units go ahead together, one candidate a step, as numpy arrays. A unit of which no candidate is
skipped has the segmentation it has without dropout, which a Python worker keeps in a table of bounded bytes.

Decoding joins the pieces and drops the space in front that encoding adds. Characters without a piece, and a
literal U+2581, become byte pieces, so every text decodes to itself. Texts of any length are cut block by block.
"""

from __future__ import annotations

import hashlib
import heapq
import re
from functools import lru_cache
from typing import Iterator, Sequence

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import resident, slices, tidy

MODEL = "/opt/tokenizers/piece_bpe_32k.model"
DROPOUT, SEED = 0.1, 17
#: Bytes of segmentations without dropout that a worker keeps before it starts anew, and what one takes besides its ids.
KEEP_BYTES, ENTRY = 32 << 20, 180
#: Units that go through the agenda together, characters of a text that are cut at a time, and bytes of text a slice.
BLOCK, WINDOW, SLICE_BYTES = 1 << 15, 1 << 17, 1 << 20
_MARK, _LETTER = r"(?:[^\w \n]|[\d_¹²³])", r"[^\W\d_¹²³]"
UNIT = re.compile(rf" *{_MARK}*{_LETTER}+| *{_MARK}+| +|\n")
#: What a vocabulary must not have inside a piece for ``UNIT`` to hold; else the whole text is one unit.
CROSSING = re.compile(rf"[^ ] |{_LETTER}{_MARK}|\n.|.\n", re.S)
SPACE = "▁"
#: Symbol of a character without a piece, of one merged away, and an agenda place without candidate.
_OTHER, _GONE, _NONE = 0xFFFF, -1, 1 << 62
#: A candidate as a number: rank of the piece, place in the unit, piece; the least is the best.
_RANK, _PLACE, _PIECE = 46, 16, 0xFFFF
#: Units up to so many characters go through the common agenda, longer ones have a heap each.
SHORT = 32
#: Increments and multipliers of the keyed hash (splitmix64), and the bits of it that are compared.
_STEP, _MIX, _BITS = np.uint64(0x9E3779B97F4A7C15), (np.uint64(0xBF58476D1CE4E5B9), np.uint64(0x94D049BB133111EB)), 53


def _mixed(x: np.ndarray) -> np.ndarray:
    x = (x ^ (x >> np.uint64(30))) * _MIX[0]
    x = (x ^ (x >> np.uint64(27))) * _MIX[1]
    return x ^ (x >> np.uint64(31))


def _keyed(keys: np.ndarray, numbers: np.ndarray) -> np.ndarray:
    """A hash of each number under its key."""
    return _mixed(keys + (numbers.astype(np.uint64) + np.uint64(1)) * _STEP)


def _within(lengths: np.ndarray) -> np.ndarray:
    """0, 1, ... for each of the lengths."""
    return np.arange(lengths.sum()) - np.repeat(np.cumsum(lengths) - lengths, lengths)


@lru_cache(maxsize=1)
def _kinds() -> np.ndarray:
    """Code point -> letter (0), mark (1), space (2) or line feed (3), as in ``UNIT``."""
    kinds = np.ones(0x110000, np.uint8)
    for found in re.finditer(f"{_LETTER}+", "".join(map(chr, range(len(kinds))))):
        kinds[found.start():found.end()] = 0
    kinds[[ord(" "), ord("\n")]] = 2, 3
    return kinds


#: Whether a unit ends between neighbours, by the kind of the first and that of the second.
_ENDS = np.array([[0, 1, 1, 1], [0, 0, 1, 1], [0, 0, 0, 1], [1, 1, 1, 1]], bool).ravel()


def _units_of(texts: Sequence[str]) -> tuple[list[str], np.ndarray]:
    """The matches of ``UNIT`` in all texts, none of which is empty, and how many each text has."""
    joined = "\n".join(texts)
    kinds = _kinds()[np.frombuffer(joined.encode("utf-32-le", "surrogatepass"), np.uint32)]
    starts = np.append(0, np.flatnonzero(_ENDS[kinds[:-1] * 4 + kinds[1:]]) + 1)
    first = np.cumsum([0, *(len(text) + 1 for text in texts)])
    units = np.ones(len(starts), bool)
    units[np.searchsorted(starts, first[1:-1] - 1)] = False  # the line feeds that join the texts
    stops = np.append(starts[1:], len(joined))[units]
    starts = starts[units]
    return [joined[a:b] for a, b in zip(starts.tolist(), stops.tolist())], np.diff(np.searchsorted(starts, first))


def _vocabulary(model: bytes) -> list:
    from sentencepiece import sentencepiece_model_pb2

    proto = sentencepiece_model_pb2.ModelProto()
    proto.ParseFromString(model)
    return list(proto.pieces)


def _bytes_of(vocabulary: list) -> list[bytes]:
    """What each piece stands for; byte pieces are type 6, control pieces stand for nothing."""
    stands = {1: lambda piece: piece.replace(SPACE, " ").encode(), 6: lambda piece: bytes([int(piece[1:-1], 16)])}
    return [stands[p.type](p.piece) if p.type in stands else b"" for p in vocabulary]


def _joined(bytes_of: list[bytes], ids: list[int]) -> str:
    """The text of pieces, without the space in front that encoding adds."""
    whole = b"".join(map(bytes_of.__getitem__, ids))
    return whole[1:].decode() if whole else ""


def _slot(pairs: np.ndarray, shift: np.uint64) -> np.ndarray:
    return (pairs.view(np.uint64) * _STEP >> shift).view(np.int64)


def _slots(merges: dict[int, int]) -> tuple[np.ndarray, np.ndarray, np.uint64]:
    """A hash table of at least four slots a pair: the pairs (``_NONE``: empty), their candidates, the hash's shift.
    A pair lies in the first free slot at or behind its own."""
    left = np.fromiter(merges.keys(), np.int64, len(merges))
    of = np.fromiter(merges.values(), np.int64, len(merges))
    bits = (4 * len(left) + 1).bit_length()
    pairs, candidates = np.full(1 << bits, _NONE, np.int64), np.full(1 << bits, _NONE, np.int64)
    shift = np.uint64(64 - bits)
    at = _slot(left, shift)
    while len(left):
        free = np.flatnonzero(pairs[at] == _NONE)
        slots, first = np.unique(at[free], return_index=True)
        pairs[slots], candidates[slots] = left[free[first]], of[free[first]]
        stay = pairs[at] != left
        left, of, at = left[stay], of[stay], (at[stay] + 1) & (1 << bits) - 1
    return pairs, candidates, shift


class Pieces:
    """The vocabulary of one model file as merge table, with the segmentations found so far."""

    def __init__(self, model: bytes, dropout: float, seed: int):
        vocabulary = _vocabulary(model)
        normal = [(k, p.piece, p.score) for k, p in enumerate(vocabulary) if p.type == 1]
        self.id_of = {piece.replace(SPACE, " "): k for k, piece, _ in normal}
        self.bytes_of = _bytes_of(vocabulary)
        self.byte_ids = [0] * 256
        for k, p in enumerate(vocabulary):
            if p.type == 6:
                self.byte_ids[self.bytes_of[k][0]] = k
        #: left id and right id -> candidate, for every way to put a piece together from two; also as sorted arrays
        ranks = {score: k for k, score in enumerate(sorted({score for _, _, score in normal}, reverse=True))}
        self.merges = {}
        for k, piece, score in normal:
            text = piece.replace(SPACE, " ")
            for at in range(1, len(text)):
                left, right = self.id_of.get(text[:at]), self.id_of.get(text[at:])
                if left is not None and right is not None:
                    self.merges[left << 16 | right] = ranks[score] << _RANK | k
        self.pairs, self.candidates, self.shift = _slots(self.merges)
        #: code point -> its piece, or ``_OTHER``; a literal space mark has none
        self.characters = np.full(0x110000, _OTHER, np.uint16)
        for c, k in self.id_of.items():
            if len(c) == 1 and c != SPACE:
                self.characters[ord(c)] = k
        self.of_byte = np.array(self.byte_ids, np.int64)
        self.unit = re.compile("(?s).+") if any(map(CROSSING.search, self.id_of)) else UNIT
        self.below = np.uint64(round(dropout * 2**_BITS))
        self.seed = seed
        #: unit -> how many candidates come up and the piece ids without dropout, packed 16-bit integers
        self.plain, self.plain_bytes = {}, 0

    @staticmethod
    def of(model: bytes, dropout: float, seed: int) -> "Pieces":
        return resident(("pieces", model, dropout, seed), lambda: Pieces(model, dropout, seed))

    def _skips(self, keys: np.ndarray, numbers: np.ndarray) -> np.ndarray:
        """Whether the candidates of these numbers are skipped, in units of these keys."""
        return (_keyed(keys, numbers) >> np.uint64(64 - _BITS)) < self.below

    def _found(self, left: np.ndarray, right: np.ndarray, place: np.ndarray) -> np.ndarray:
        pairs = left << 16 | right
        at = _slot(pairs, self.shift)
        there = self.pairs[at]
        open_ = np.flatnonzero((there != pairs) & (there != _NONE))
        while len(open_):  # the slot is another pair's: the next one, up to an empty one
            at[open_] = (at[open_] + 1) & len(self.pairs) - 1
            there[open_] = self.pairs[at[open_]]
            open_ = open_[(there[open_] != pairs[open_]) & (there[open_] != _NONE)]
        return np.where(there == pairs, self.candidates[at] | place << _PLACE, _NONE)

    def merged(self, units: Sequence[str], keys: np.ndarray | None) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Piece ids of all units, how many each unit has, and how many of its candidates came up; no dropout without
        ``keys``."""
        lengths = np.fromiter(map(len, units), np.int64, len(units))
        text = "".join(units)
        points = np.frombuffer(text.encode("utf-32-le", "surrogatepass"), np.uint32)
        symbols = self.characters[points].astype(np.int64)
        came = np.zeros(len(units), np.int64)
        short = lengths <= SHORT
        cells = np.repeat(short, lengths)
        symbols[cells], came[short] = self._merge_short(symbols[cells], lengths[short], None if keys is None else keys[short])
        ends = np.cumsum(lengths)
        for row in np.flatnonzero(~short).tolist():
            part = slice(int(ends[row] - lengths[row]), int(ends[row]))
            skip = b"" if keys is None else self._skips(keys[row], np.arange(3 * lengths[row])).tobytes()
            symbols[part], came[row] = self._merge_long(symbols[part].tolist(), skip)
        # a cell has no piece, one, or, without a piece of its own, one for every byte
        other = np.flatnonzero(symbols == _OTHER)
        pieces = (symbols != _GONE).astype(np.int64)
        raw = [text[k].encode("utf-8", "surrogatepass") for k in other.tolist()]
        pieces[other] = list(map(len, raw))
        ids = np.repeat(symbols, pieces)
        ids[ids == _OTHER] = self.of_byte[np.frombuffer(b"".join(raw), np.uint8)]
        return ids, np.add.reduceat(pieces, ends - lengths), came

    def _merge_short(self, symbols: np.ndarray, lengths: np.ndarray, keys: np.ndarray | None) -> tuple[np.ndarray, np.ndarray]:
        """Every unit's agenda has one place per cell, for the pair of it and the next; a step takes the best of each.
        The cell behind the last one stands for what lies outside a unit. Finished units leave the arrays."""
        out, came = symbols.copy(), np.zeros(len(lengths), np.int64)
        n, rows, origin = len(symbols), np.arange(len(lengths)), np.arange(len(symbols))
        place = _within(lengths)
        starts = np.cumsum(lengths) - lengths
        cells = np.append(symbols, _OTHER)
        after, before = np.arange(1, n + 2), np.arange(-1, n)
        after[starts + lengths - 1] = n
        before[starts] = n
        after[n] = before[n] = n
        agenda = self._found(cells[:n], cells[after[:n]], place)
        agenda = np.append(agenda, _NONE)
        while len(rows):
            best = np.minimum.reduceat(agenda[:n], starts)
            live = best != _NONE
            if 4 * np.count_nonzero(live) < 3 * len(rows):
                done = np.repeat(~live, lengths)
                out[origin[done]] = cells[:n][done]
                stay = np.append(~done, True)
                moved = np.cumsum(stay) - 1
                after, before = moved[after[stay]], moved[before[stay]]
                cells, agenda, origin, place = cells[stay], agenda[stay], origin[stay[:n]], place[stay[:n]]
                rows, lengths, best, n = rows[live], lengths[live], best[live], len(origin)
                starts = np.cumsum(lengths) - lengths
                at, of = starts, rows
            else:
                at, of, best = starts[live], rows[live], best[live]
            if not len(best):
                continue
            at = at + (best >> _PLACE & (1 << _RANK - _PLACE) - 1)
            number = came[of]
            came[of] = number + 1
            if keys is not None:
                skip = self._skips(keys[of], number)
                agenda[at[skip]] = _NONE
                at, best = at[~skip], best[~skip]
            piece = best & _PIECE
            right, left = after[at], before[at]
            far = after[right]
            cells[at], cells[right], agenda[right] = piece, _GONE, _NONE
            after[at], before[far] = far, at
            agenda[at] = self._found(piece, cells[far], place[at])
            agenda[left] = self._found(cells[left], piece, place[at] - (at - left))
            agenda[n] = _NONE
        return out, came

    def _merge_long(self, symbols: list[int], skip: bytes) -> tuple[list[int], int]:
        """The same with the agenda as a heap, for units of any length. n characters have at most 3 (n - 1) candidates:
        n - 1 pairs and two more per merge."""
        n, find, came = len(symbols), self.merges.get, 0
        before, after = list(range(-1, n - 1)), list(range(1, n + 1))
        agenda = []

        def propose(left: int, right: int) -> None:
            found = find(symbols[left] << 16 | symbols[right], _NONE)
            if found != _NONE:
                heapq.heappush(agenda, (found, left, right, symbols[left], symbols[right]))

        for at in range(n - 1):
            propose(at, at + 1)
        while agenda:
            best, left, right, a, b = heapq.heappop(agenda)
            if symbols[left] != a or symbols[right] != b or after[left] != right:
                continue
            came += 1
            if skip and skip[came - 1]:
                continue
            symbols[left], symbols[right] = best & _PIECE, _GONE
            far = after[left] = after[right]
            if far < n:
                before[far] = left
                propose(left, far)
            if before[left] >= 0:
                propose(before[left], left)
        return symbols, came

    def _learn(self, units: Sequence[str]) -> None:
        """Keep the segmentations of these units without dropout."""
        if self.plain_bytes > KEEP_BYTES:
            self.plain.clear()
            self.plain_bytes = 0
        ids, sizes, came = self.merged(units, None)
        ends = 2 * np.cumsum(sizes + 1)
        packed = np.insert(ids, np.cumsum(sizes) - sizes, came).astype(np.uint16).tobytes()
        self.plain.update(zip(units, [packed[a:b] for a, b in zip([0, *ends[:-1].tolist()], ends.tolist())]))
        self.plain_bytes += len(packed) + ENTRY * len(units)

    def _encode_units(self, units: list[str], keys: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Piece ids of units with these keys, and how many each unit has."""
        sizes, long = np.zeros(len(units), np.int64), []
        found = list(map(self.plain.get, units))
        if None in found:
            none = [k for k, known in enumerate(found) if known is None]
            long = [k for k in none if len(units[k]) > SHORT]
            if len(long) < len(none):
                # all units of the block where the table starts anew
                anew = self.plain_bytes > KEEP_BYTES
                self._learn(list({u for u in (units if anew else map(units.__getitem__, none)) if len(u) <= SHORT}))
                for k in range(len(units)) if anew else none:
                    found[k] = self.plain.get(units[k])
            for k in long:
                found[k] = b"\0\0"
        packed = np.frombuffer(b"".join(found), np.uint16)
        widths = np.fromiter(map(len, found), np.int64, len(units)) // 2
        heads = np.cumsum(widths) - widths
        came = packed[heads].astype(np.int64)
        again = np.zeros(len(units), bool)
        again[long] = True
        if self.below:
            open_, number = np.flatnonzero(came), 0
            while len(open_):
                skips = self._skips(keys[open_], np.array([number]))
                again[open_[skips]] = True
                number += 1
                open_ = open_[~skips & (came[open_] > number)]
        kept = np.repeat(~again, widths)
        kept[heads] = False
        sizes[:] = widths - 1
        redone = np.flatnonzero(again)
        if not len(redone):
            return packed[kept].astype(np.int32), sizes
        new, sizes[redone], _ = self.merged([units[k] for k in redone.tolist()], keys[redone] if self.below else None)
        ids = np.empty(sizes.sum(), np.int32)
        of_new = np.repeat(again, sizes)
        ids[of_new], ids[~of_new] = new, packed[kept]
        return ids, sizes

    def _cut(self, text: str) -> Iterator[list[str]]:
        """The units of a text, some at a time. Only the last one before a cut may go on behind it."""
        at, window = 0, WINDOW
        while at < len(text):
            units = self.unit.findall(text, at, at + window)
            if at + window < len(text):
                last = units.pop()
                if not units:
                    window *= 2
                    continue
                at, window = at + window - len(last), WINDOW
            else:
                at = len(text)
            yield units

    def encode_all(self, texts: Sequence[str | None], keys: Sequence[str]) -> tuple[np.ndarray, np.ndarray]:
        """The ids of all texts, and how many each has; the keys are those of the documents' draws."""
        sizes = np.zeros(len(texts), np.int64)
        whole, units, key_parts, row_parts, group = [], [], [], [], []

        def flush() -> None:
            if units:
                ids, counts = self._encode_units(units, np.concatenate(key_parts))
                sizes[:] += np.bincount(np.concatenate(row_parts), counts, len(texts)).astype(np.int64)
                whole.append(ids)
                for part in (units, key_parts, row_parts):
                    part.clear()

        def cut_group() -> None:
            if group:
                rows, documents, of_group = zip(*group)
                cut, counts = _units_of(of_group)
                units.extend(cut)
                key_parts.append(_keyed(np.repeat(np.concatenate(documents), counts), _within(counts)))
                row_parts.append(np.repeat(rows, counts))
                group.clear()
                if len(units) >= BLOCK:
                    flush()

        in_group = 0
        for row, (text, key) in enumerate(zip(texts, keys)):
            if not text:
                continue
            digest = hashlib.blake2b(key.encode("utf-8", "surrogatepass"), digest_size=8, key=str(self.seed).encode()).digest()
            document, place = np.frombuffer(digest, np.uint64), 0
            if self.unit is UNIT and len(text) < WINDOW:
                in_group = in_group * bool(group) + len(text)
                group.append((row, document, " " + text))
                if in_group >= WINDOW:
                    cut_group()
                continue
            cut_group()
            for some in self._cut(" " + text):
                units.extend(some)
                key_parts.append(_keyed(document, np.arange(place, place + len(some))))
                row_parts.append(np.full(len(some), row))
                place += len(some)
                if len(units) >= BLOCK:
                    flush()
        cut_group()
        flush()
        return np.concatenate(whole) if whole else np.empty(0, np.int32), sizes

    def encode(self, text: str, key: str) -> bytes:
        """The ids of one text as packed 32-bit integers."""
        return self.encode_all([text], [key])[0].tobytes()

    def decode(self, ids) -> str:
        return _joined(self.bytes_of, ids)


def read_model(path: str = MODEL) -> bytes:
    with open(path, "rb") as file:
        return file.read()


def encode_pieces(
    df: DataFrame, id_col: str = "doc_id", text_col: str = "text", model: str = MODEL, dropout: float = DROPOUT, seed: int = SEED,
    keep: tuple[str, ...] = (), copy_col: str | None = None,
) -> DataFrame:
    """Per row: id, the text, the columns ``keep``, pieces (array<int>). Null text has null pieces, empty text none;
    equal rows agree. With ``copy_col``, a row's number among its copies, each copy has draws of its own.

    ``model`` is a path on the driver; the vocabulary (half a megabyte) is broadcast. ``dropout`` 0 is plain BPE.
    """
    shared = df.sparkSession.sparkContext.broadcast(read_model(model))

    @F.arrow_udf("array<int>")
    @tidy
    def encode(batches: Iterator[tuple[pa.Array, ...]]) -> Iterator[pa.Array]:
        pieces = Pieces.of(shared.value, dropout, seed)
        for text, *key in batches:
            lists = []
            columns = ["text", *(f"k{n}" for n in range(len(key)))]
            for part in slices([pa.RecordBatch.from_arrays([text, *key], columns)], "text", SLICE_BYTES):
                texts, *of = part.columns
                keys = [" ".join(map(str, k)) for k in zip(*(c.to_pylist() for c in of))]
                ids, sizes = pieces.encode_all(texts.to_pylist(), keys)
                offsets = pa.array(np.concatenate([[0], np.cumsum(sizes)]).astype(np.int32))
                lists.append(pa.ListArray.from_arrays(offsets, pa.array(ids, pa.int32()), mask=texts.is_null()))
            yield pa.concat_arrays(lists) if lists else pa.array([], pa.list_(pa.int32()))

    # only texts and keys go to Python, the other columns stay in the JVM
    key = [F.col(f"`{c}`") for c in (id_col, copy_col) if c is not None]
    kept = [F.col(f"`{c}`") for c in (id_col, text_col, *keep)]
    return df.select(*kept, encode(F.col(f"`{text_col}`"), *key)).toDF(id_col, text_col, *keep, "pieces")


def decode_pieces(df: DataFrame, pieces_col: str = "pieces", model: str = MODEL) -> DataFrame:
    """``df`` with a column decoded: the text of each array of pieces (null for null)."""
    shared = df.sparkSession.sparkContext.broadcast(read_model(model))

    @F.arrow_udf("string")
    @tidy
    def decode(columns: Iterator[pa.Array]) -> Iterator[pa.Array]:
        # not kept beyond the task: the worker may be the one that encodes next
        bytes_of = _bytes_of(_vocabulary(shared.value))
        for column in columns:
            ids, ends = column.values.to_numpy(zero_copy_only=False), column.offsets.to_numpy()
            texts = [None if not ok else _joined(bytes_of, ids[a:b].tolist())
                     for ok, a, b in zip(column.is_valid().to_pylist(), ends[:-1], ends[1:])]
            yield pa.array(texts, pa.string())

    return df.withColumn("decoded", decode(F.col(f"`{pieces_col}`")))

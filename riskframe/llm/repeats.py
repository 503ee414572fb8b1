"""Removal of byte strings that an earlier document has, by collection suffix arrays of column-wise construction.

Every window of ``WIDTH`` bytes belongs to one anchor, its smallest hashed string of ``ANCHOR`` bytes, so equal
windows lie the same way around equal anchors, and neighbouring windows with the same anchor form one stretch.

1. Anchors meet by hash. Of equal stretches around an anchor all but those of the smallest document are repeated as
   a whole. Where different stretches share an anchor, their windows have yet to be compared.
2. Those stretches are read from the texts in two parts, windows with more text before the anchor and windows with
   more after it. ``ANCHOR + SIDE`` bytes are common to all windows of a part; parts meet by the hash of these.
3. Parts that meet are the strings of a collection suffix array (see ``suffixes``), built block by block, one symbol
   of every string a round. Neighbouring suffixes with a common prefix of ``WIDTH`` are equal windows.
4. The repeated windows of a document are united into spans and cut from its text.

What moves between the steps are packed blocks of fixed-width records, dealt by hash. An anchor that several
documents of a task share is settled there and sent on once, so a common passage reaches its bucket once per task.
"""

from __future__ import annotations

import zlib
from typing import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import shuffle_parts, slices, tidy, tidy_cogroup, written
from .shingles import mixed, powers
from .suffixes import MARK, repeated_windows

# ANCHOR + 2 * SIDE is WIDTH: a window has SIDE bytes on one side of its anchor at least
WIDTH, ANCHOR, SIDE = 50, 24, 13
SLICE_BYTES = 1 << 20
#: Records a task holds before it sends them; strings of a suffix array.
FLUSH, STRINGS = 1 << 20, 1024
#: Document of a row without id: after all others.
_LAST = 2**63 - 1
_PLACE = np.uint64((1 << 23) - 1)

_STRETCH = np.dtype([("key", "<u4"), ("text", "<u8"), ("doc", "<i8"), ("tag", "<u4"), ("first", "<i4"), ("windows", "u1"),
                     ("anchor", "u1"), ("asked", "u1")])
_SPAN = np.dtype([("doc", "<i8"), ("tag", "<u4"), ("start", "<i4"), ("stop", "<i4")])
_ASK = np.dtype([("doc", "<i8"), ("tag", "<u4"), ("first", "<i4"), ("windows", "u1"), ("anchor", "u1")])
_PART = np.dtype([("key", "<u8"), ("doc", "<i8"), ("tag", "<u4"), ("first", "<i4"), ("size", "u1")])
_BLOCKS = "bucket int, kind int, block binary"
_SCHEMA = pa.schema([("bucket", pa.int32()), ("kind", pa.int32()), ("block", pa.binary())])
_STRETCHES, _SPANS, _ASKS, _PARTS = range(4)


def _values() -> np.ndarray:
    return mixed(np.arange(256, dtype=np.uint64), 21)


def prefix_sums(data: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Polynomial prefix sums of the bytes, and the factors that move a difference to place 0."""
    up, down = powers(1 << max(16, int(len(data)).bit_length()))
    sums = np.zeros(len(data) + 1, np.uint64)
    np.cumsum(_values()[data] * up[:len(data)], out=sums[1:])
    return sums, down


def stretches(texts: list[bytes], docs: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(anchor hashes, records) of all stretches of the texts, in order."""
    data = np.frombuffer(b"".join(texts), np.uint8)
    lengths = np.array([len(t) for t in texts], np.int64)
    ends = np.cumsum(lengths)
    begins = ends - lengths
    if len(data) < WIDTH:
        return np.empty(0, np.uint64), np.empty(0, _STRETCH)
    if len(data) >= int(_PLACE):
        return _stretches_of_long(texts, docs)
    sums, down = prefix_sums(data)
    hashes = mixed((sums[ANCHOR:] - sums[:-ANCHOR]) * down[:len(data) - ANCHOR + 1])
    ranked = (hashes & ~_PLACE) | np.arange(len(hashes), dtype=np.uint64)
    span, step = WIDTH - ANCHOR + 1, 1
    while 2 * step <= span:
        ranked = np.minimum(ranked[:-step], ranked[step:])
        step *= 2
    if span > step:
        ranked = np.minimum(ranked[:len(ranked) - (span - step)], ranked[span - step:])
    anchor = (ranked & _PLACE).astype(np.int64)  # by first byte of the window
    fits = np.zeros(len(anchor) + 1, np.int8)
    big = lengths >= WIDTH
    fits[begins[big]] += 1
    fits[ends[big] - WIDTH + 1] -= 1
    fits = np.cumsum(fits)[:-1] > 0
    new = np.ones(len(anchor), bool)
    new[1:] = (anchor[1:] != anchor[:-1]) | ~fits[:-1]
    new[begins[big]] = True
    first = np.flatnonzero(new & fits)
    doc = np.searchsorted(ends, first, side="right")
    stop = np.minimum(np.append(first[1:], len(anchor)), ends[doc] - WIDTH + 1)
    out = np.zeros(len(first), _STRETCH)
    at = anchor[first]
    out["text"] = mixed((sums[stop + WIDTH - 1] - sums[first]) * down[first] + (stop - first).astype(np.uint64), 5)
    out["doc"], out["first"], out["windows"], out["anchor"] = docs[doc], first - begins[doc], stop - first, at - first
    out["tag"] = np.array([zlib.crc32(t) for t in texts], np.uint32)[doc]  # tells texts under the same id apart
    return hashes[at], out


def _stretches_of_long(texts: list[bytes], docs: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """One text too long for one array: pieces that overlap by a window less one byte, so no window is lost or doubled."""
    (text,), size = texts, int(_PLACE) - 1
    keys, records = [], []
    for at in range(0, len(text) - WIDTH + 1, size - WIDTH + 1):
        key, record = stretches([text[at:at + size]], docs)
        record["first"] += at
        keys.append(key)
        records.append(record)
    keys, records = np.concatenate(keys), np.concatenate(records)
    records["tag"] = zlib.crc32(text)
    return keys, records


def settle(e: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """Records by key, stretch and document, with masks and groups.

    Returns the sorted records; whether a record is repeated as a whole; whether its key has several stretches, or
    one that was asked for elsewhere; whether its key is shared by documents; and the first record of its key.
    """
    e = e[np.lexsort((e["doc"], e["text"], e["key"]))]
    by_key = np.append(True, e["key"][1:] != e["key"][:-1])
    by_text = by_key | np.append(True, e["text"][1:] != e["text"][:-1])
    key_starts, text_starts = np.flatnonzero(by_key), np.flatnonzero(by_text)
    key_of, text_of = np.cumsum(by_key) - 1, np.cumsum(by_text) - 1
    whole = e["doc"] > e["doc"][text_starts][text_of]
    asked = np.logical_or.reduceat(e["asked"] > 0, key_starts)
    several = (np.bincount(key_of[text_starts]) > 1) | asked
    low, high = np.minimum.reduceat(e["doc"], key_starts), np.maximum.reduceat(e["doc"], key_starts)
    return e, whole, several[key_of], ((low < high) | asked)[key_of], by_key


def _spans(e: np.ndarray) -> np.ndarray:
    out = np.empty(len(e), _SPAN)
    out["doc"], out["tag"], out["start"] = e["doc"], e["tag"], e["first"]
    out["stop"] = e["first"] + e["windows"] + (WIDTH - 1)
    return out


def _asks(e: np.ndarray) -> np.ndarray:
    out = np.empty(len(e), _ASK)
    for name in _ASK.names:
        out[name] = e[name]
    return out


def _dealt(records: np.ndarray, bucket: np.ndarray, buckets: int, kind: int) -> list[tuple[int, int, bytes]]:
    order = np.argsort(bucket, kind="stable")
    records, cuts = records[order], np.searchsorted(bucket[order], np.arange(buckets + 1))
    return [(k, kind, packed(records[cuts[k]:cuts[k + 1]])) for k in range(buckets) if cuts[k] < cuts[k + 1]]


def packed(records: np.ndarray) -> bytes:
    """Records as a block: their first bytes, their second bytes and so on, compressed, as high bytes are mostly alike."""
    planes = np.ascontiguousarray(records.view(np.uint8).reshape(len(records), records.itemsize).T)
    return len(records).to_bytes(8, "little") + pa.compress(planes.tobytes(), codec="zstd", asbytes=True)


def unpacked(blocks: list[bytes], kind: np.dtype) -> np.ndarray:
    """The records of blocks."""
    out = [np.empty(0, kind)]
    for block in blocks:
        n = int.from_bytes(block[:8], "little")
        planes = np.frombuffer(pa.decompress(memoryview(block)[8:], n * kind.itemsize, codec="zstd", asbytes=True), np.uint8)
        out.append(np.ascontiguousarray(planes.reshape(kind.itemsize, n).T).reshape(-1).view(kind))
    return np.concatenate(out)


def _batch(rows: list[tuple]) -> Iterator[pa.RecordBatch]:
    if rows:
        yield pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(zip(*rows), _SCHEMA)], schema=_SCHEMA)


def _gathered(batches: Iterator[pa.RecordBatch]) -> dict[int, dict[int, list[bytes]]]:
    """bucket -> kind -> blocks."""
    out: dict[int, dict[int, list[bytes]]] = {}
    for batch in batches:
        for bucket, kind, block in zip(*(batch.column(c).to_pylist() for c in ("bucket", "kind", "block"))):
            out.setdefault(bucket, {}).setdefault(kind, []).append(block)
    return out


def _as_docs(ids: pa.Array) -> np.ndarray:
    return pa.compute.fill_null(ids.cast(pa.int64()), _LAST).to_numpy()


def _encoded(texts: pa.Array) -> list[bytes]:
    return [b"" if t is None else t.encode() for t in texts.to_pylist()]


def _meetings(docs: DataFrame, buckets: int, homes: int) -> DataFrame:
    """Step 1: spans repeated as a whole and stretches to read, dealt by document."""

    def sent(keys: np.ndarray, e: np.ndarray) -> Iterator[pa.RecordBatch]:
        e["key"] = keys >> np.uint64(32)
        order = np.argsort(keys)
        keys, e = keys[order], e[order]
        same = keys[1:] == keys[:-1]
        lone = ~(np.append(False, same) | np.append(same, False))
        go_on, spans, asks = [e[lone]], [np.empty(0, _SPAN)], [np.empty(0, _ASK)]
        bucket = [(keys[lone] & np.uint64(0xFFFFFFFF)) % np.uint64(buckets)]
        if not lone.all():
            # the low half of the hash tells keys apart that agree in the stored half
            low = keys[~lone] & np.uint64(0xFFFFFFFF)
            met = e[~lone]
            part = low % np.uint64(buckets)
            for k in np.unique(part):
                some, whole, several, shared, head = settle(met[part == k])
                ask = several & shared & ~whole
                spans.append(_spans(some[whole]))
                asks.append(_asks(some[ask]))
                some["asked"] = ask
                on = (~whole & ~ask) | _first_of(ask, head)
                go_on.append(some[on])
                bucket.append(np.full(int(on.sum()), k, np.uint64))
        rows = []
        for kind, parts in ((_SPANS, spans), (_ASKS, asks)):
            records = np.concatenate(parts)
            # buckets below zero are for documents
            rows += [(-1 - home, kind, block) for home, _, block in _dealt(records, records["doc"] % homes, homes, kind)]
        rows += _dealt(np.concatenate(go_on), np.concatenate(bucket).astype(np.int64), buckets, _STRETCHES)
        yield from _batch(rows)

    def send(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        keys, records, held = [], [], 0
        for part in slices(batches, "text", SLICE_BYTES):
            key, record = stretches(_encoded(part.column("text")), _as_docs(part.column("id")))
            keys.append(key)
            records.append(record)
            held += len(key)
            if held >= FLUSH:
                yield from sent(np.concatenate(keys), np.concatenate(records))
                keys, records, held = [], [], 0
        if held:
            yield from sent(np.concatenate(keys), np.concatenate(records))

    def meet(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for bucket, kinds in _gathered(batches).items():
            if bucket < 0:
                yield from _batch([(-1 - bucket, kind, block) for kind, blocks in kinds.items() for block in blocks])
                continue
            e = unpacked(kinds[_STRETCHES], _STRETCH)
            e = e[np.argsort(e["key"])]
            same = e["key"][1:] == e["key"][:-1]
            e = e[np.append(False, same) | np.append(same, False)]
            if len(e):
                e, whole, several, shared, _ = settle(e)
                ask = several & shared & ~whole & (e["asked"] == 0)
                yield from _batch(_dealt(_spans(e[whole]), e["doc"][whole] % homes, homes, _SPANS))
                yield from _batch(_dealt(_asks(e[ask]), e["doc"][ask] % homes, homes, _ASKS))

    sent_rows = docs.mapInArrow(tidy(send), _BLOCKS)
    return sent_rows.repartition(buckets, "bucket").mapInArrow(tidy(meet), _BLOCKS)


def _first_of(mask: np.ndarray, head: np.ndarray) -> np.ndarray:
    """The first masked record of each group that ``head`` begins."""
    group = np.cumsum(head)
    out = np.zeros(len(mask), bool)
    at = np.flatnonzero(mask)
    out[at[np.append(True, group[at][1:] != group[at][:-1])] if len(at) else at] = True
    return out


def read_parts(data: np.ndarray, begins: np.ndarray, asks: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Step 2: the two parts of every stretch as records, and their strings, one after the other.

    ``begins`` says where in ``data`` the text of each record begins.
    """
    # windows that begin at least SIDE bytes before the anchor
    before = np.clip(asks["anchor"].astype(np.int64) - SIDE + 1, 0, asks["windows"])
    values, (up, _) = _values(), powers(1 << 16)
    parts, starts = [], []
    for side, skip, windows in ((0, 0, before), (1, before, asks["windows"] - before)):
        some = windows > 0
        out = np.empty(len(asks), _PART)
        out["doc"], out["tag"], out["first"], out["size"] = asks["doc"], asks["tag"], asks["first"] + skip, windows + (WIDTH - 1)
        out, begin = out[some], begins[some]
        at = begin + asks["first"][some] + asks["anchor"][some] - (SIDE if side == 0 else 0)
        key = np.zeros(len(out), np.uint64)
        for place in range(ANCHOR + SIDE):
            key += values[data[at + place]] * up[place]
        out["key"] = mixed(key, 31 + side)
        parts.append(out)
        starts.append(begin + out["first"])
    parts, starts = np.concatenate(parts), np.concatenate(starts)
    return parts, _taken(data, starts, parts["size"].astype(np.int64))


def _taken(data: np.ndarray, starts: np.ndarray, sizes: np.ndarray) -> np.ndarray:
    """The pieces of ``data`` with these starts and sizes, joined."""
    return data[np.arange(int(sizes.sum())) + np.repeat(starts - (np.cumsum(sizes) - sizes), sizes)]


def _met(parts: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Of parts sorted by key: which share their key with another document, and the number of their key."""
    starts = np.flatnonzero(np.append(True, parts["key"][1:] != parts["key"][:-1]))
    counts = np.diff(np.append(starts, len(parts)))
    met = np.minimum.reduceat(parts["doc"], starts) < np.maximum.reduceat(parts["doc"], starts)
    return np.repeat(met, counts), np.repeat(np.arange(len(starts)), counts)


def compare_parts(parts: np.ndarray, text: np.ndarray) -> np.ndarray:
    """Step 3: spans of the windows of these parts that also occur in a smaller document's part.

    Parts that are equal strings count once: those of larger documents are repeated as a whole.
    """
    size = parts["size"].astype(np.int64)
    begin = np.cumsum(size) - size
    order = np.argsort(parts["key"], kind="stable")
    met, _ = _met(parts[order])
    order = order[met]
    parts, begin, size = parts[order], begin[order], size[order]
    if not len(parts):
        return np.empty(0, _SPAN)
    raw, names = text.tobytes(), {}
    name = np.fromiter((names.setdefault((k, raw[a:a + n]), len(names)) for k, a, n in zip(
        parts["key"].tolist(), begin.tolist(), size.tolist())), np.int64, len(parts))
    smallest = np.full(len(names), _LAST)
    np.minimum.at(smallest, name, parts["doc"])
    whole = parts["doc"] > smallest[name]
    equal = np.empty(int(whole.sum()), _SPAN)
    equal["doc"], equal["tag"], equal["start"] = parts["doc"][whole], parts["tag"][whole], parts["first"][whole]
    equal["stop"] = equal["start"] + size[whole]
    parts, begin, size = parts[~whole], begin[~whole], size[~whole]
    met, group = _met(parts)
    parts, begin, size, group = parts[met], begin[met], size[met], group[met]
    spans, at = [equal], 0
    while at < len(parts):  # whole groups up to about STRINGS strings
        stop = min(at + STRINGS, len(parts))
        stop = int(np.searchsorted(group, group[stop - 1], side="right"))
        some, n = parts[at:stop], size[at:stop]
        ends = np.cumsum(n + 1)
        block = np.full(int(ends[-1]), MARK, np.uint8)
        where = np.arange(int(n.sum())) + np.repeat(np.arange(len(n)) + 1, n)
        block[where] = _taken(text, begin[at:stop], n)
        string, offset = repeated_windows(block, ends, some["doc"], WIDTH)
        order = np.lexsort((offset, string))
        string, offset = string[order], offset[order].astype(np.int64)
        new = np.append(True, (string[1:] != string[:-1]) | (offset[1:] != offset[:-1] + 1)) if len(string) else np.empty(0, bool)
        firsts = np.flatnonzero(new)
        out = np.empty(len(firsts), _SPAN)
        of = string[firsts]
        out["doc"], out["tag"], out["start"] = some["doc"][of], some["tag"][of], some["first"][of] + offset[firsts]
        out["stop"] = out["start"] + np.diff(np.append(firsts, len(string))) + (WIDTH - 1)
        spans.append(out)
        at = stop
    return np.concatenate(spans)


def cut_spans(text: bytes, spans: np.ndarray) -> tuple[list[tuple[int, int]], bytes]:
    """Step 4: maximal removed runs of one text, and what is left."""
    if not len(spans):
        return [], text
    order = np.argsort(spans["start"], kind="stable")
    start, stop = spans["start"][order], np.maximum.accumulate(spans["stop"][order])
    new = np.append(True, start[1:] > stop[:-1])
    runs = list(zip(start[new].tolist(), stop[np.append(np.flatnonzero(new)[1:] - 1, len(stop) - 1)].tolist()))
    kept, at = [], 0
    for a, b in runs:
        kept.append(text[at:a])
        at = b
    return runs, b"".join([*kept, text[at:]])


class _ByText:
    """Records of a home by (document, tag)."""

    def __init__(self, blocks: list[bytes], kind: np.dtype):
        e = unpacked(blocks, kind)
        self.records = e[np.lexsort((e["tag"], e["doc"]))]
        e = self.records
        new = np.append(True, (e["doc"][1:] != e["doc"][:-1]) | (e["tag"][1:] != e["tag"][:-1])) if len(e) else np.empty(0, bool)
        starts = np.flatnonzero(new)
        stops = np.append(starts[1:], len(e))
        self.where = {(d, t): (a, b) for d, t, a, b in zip(
            e["doc"][starts].tolist(), e["tag"][starts].tolist(), starts.tolist(), stops.tolist())}

    def of(self, doc: int, text: bytes) -> np.ndarray:
        a, b = self.where.get((doc, zlib.crc32(text)), (0, 0))
        return self.records[a:b]


def remove_repeats(
    df: DataFrame, id_col: str = "doc_id", text_col: str = "text", keep: tuple[str, ...] = (), as_text: bool = False,
) -> DataFrame:
    """Per row: id, n_bytes, n_removed, n_spans, spans array<struct<start, stop>>, kept (binary: what is left), and
    the columns ``keep`` as they are. With ``as_text`` kept is a string, without characters of which only some bytes are left.

    Removed is every byte of a 50-byte string that also starts in a row with a smaller id; strings lie within one
    text and are judged on the input. Ids are integers. Null texts are empty; rows with equal ids, equal rows
    included, do not remove from each other; rows without id come after all others.
    """
    spark = df.sparkSession
    buckets = shuffle_parts(spark)
    homes = buckets
    docs = df.select(F.col(f"`{id_col}`").alias("id"), F.col(f"`{text_col}`").alias("text"))
    kind = docs.schema["id"].dataType.simpleString()
    home = F.pmod(F.coalesce(F.col("id").cast("long"), F.lit(_LAST)), F.lit(homes)).cast("int")
    extra = [f"k{n}" for n in range(len(keep))]
    texts = df.select(F.col(f"`{id_col}`").alias("id"), F.col(f"`{text_col}`").alias("text"),
                      *[F.col(f"`{c}`").alias(k) for c, k in zip(keep, extra)]).withColumn("home", home)
    met = written(_meetings(docs, buckets, homes), "met")

    def read(key, texts: pa.Table, blocks: pa.Table) -> pa.Table:
        asks, parts, strings = _ByText(blocks.column("block").to_pylist(), _ASK), [], []
        for batch in texts.to_batches():
            raw = _encoded(batch.column("text"))
            some = [asks.of(doc, text) for doc, text in zip(_as_docs(batch.column("id")).tolist(), raw)]
            begins = np.cumsum([0, *map(len, raw)])[:-1]
            part, string = read_parts(np.frombuffer(b"".join(raw), np.uint8), np.repeat(begins, [len(x) for x in some]), np.concatenate(some))
            parts.append(part)
            strings.append(string)
        return pa.Table.from_batches(_batch(_dealt_parts(np.concatenate(parts), np.concatenate(strings), buckets)), _SCHEMA)

    def compare(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for kinds in _gathered(batches).values():
            both = [_parts_and_strings(block) for block in kinds[_PARTS]]
            spans = compare_parts(*(np.concatenate(x) for x in zip(*both)))
            yield from _batch(_dealt(spans, spans["doc"] % homes, homes, _SPANS))

    by_home = texts.groupBy("home")
    asks = met.where(F.col("kind") == _ASKS).withColumnRenamed("bucket", "home")
    read_rows = by_home.cogroup(asks.groupBy("home")).applyInArrow(tidy_cogroup(read), _BLOCKS)
    compared = written(read_rows.repartition(buckets, "bucket").mapInArrow(tidy(compare), _BLOCKS), "compared")

    def cut(key, texts: pa.Table, blocks: pa.Table) -> pa.Table:
        spans, done, n_bytes = _ByText(blocks.column("block").to_pylist(), _SPAN), [], []
        for batch in texts.to_batches():
            for doc, text in zip(_as_docs(batch.column("id")).tolist(), _encoded(batch.column("text"))):
                done.append(cut_spans(text, spans.of(doc, text)))
                n_bytes.append(len(text))
        left = pa.string() if as_text else pa.binary()
        edges = pa.list_(pa.struct([("start", pa.int32()), ("stop", pa.int32())]))
        return pa.table({
            "id": texts.column("id"), "n_bytes": pa.array(n_bytes, pa.int64()),
            "n_removed": pa.array([sum(b - a for a, b in runs) for runs, _ in done], pa.int64()),
            "n_spans": pa.array([len(runs) for runs, _ in done], pa.int64()),
            "spans": pa.array([[{"start": a, "stop": b} for a, b in runs] for runs, _ in done], edges),
            "kept": pa.array([kept.decode("utf-8", "ignore") if as_text else kept for _, kept in done], left), **{k: texts.column(k) for k in extra}})

    spans = met.where(F.col("kind") == _SPANS).unionByName(compared).withColumnRenamed("bucket", "home")
    kinds = "".join(f", {k} {texts.schema[k].dataType.simpleString()}" for k in extra)
    out = by_home.cogroup(spans.groupBy("home")).applyInArrow(
        tidy_cogroup(cut), f"id {kind}, n_bytes long, n_removed long, n_spans long, spans array<struct<start:int,stop:int>>, "
        f"kept {'string' if as_text else 'binary'}{kinds}")
    return out.toDF(id_col, *out.columns[1:6], *keep)


def decoded(kept: Column) -> Column:
    """What is left as text; characters of which only some bytes are left go, too."""

    @F.arrow_udf("string")
    def decode(column: pa.Array) -> pa.Array:
        return pa.array([None if b is None else b.decode("utf-8", "ignore") for b in column.to_pylist()], pa.string())

    return decode(kept)


def _dealt_parts(parts: np.ndarray, strings: np.ndarray, buckets: int) -> list[tuple[int, int, bytes]]:
    """Parts with their strings by bucket of the key: the number of parts, their records, their strings."""
    bucket = (parts["key"] % np.uint64(buckets)).astype(np.int64)
    size = parts["size"].astype(np.int64)
    begin = np.cumsum(size) - size
    order = np.argsort(bucket, kind="stable")
    strings, parts = _taken(strings, begin[order], size[order]), parts[order]
    cuts = np.searchsorted(bucket[order], np.arange(buckets + 1))
    ends = np.append(0, np.cumsum(parts["size"], dtype=np.int64))
    return [(k, _PARTS, int(b - a).to_bytes(8, "little") + parts[a:b].tobytes() + strings[ends[a]:ends[b]].tobytes())
            for k, (a, b) in enumerate(zip(cuts[:-1], cuts[1:])) if a < b]


def _parts_and_strings(block: bytes) -> tuple[np.ndarray, np.ndarray]:
    n = int.from_bytes(block[:8], "little")
    return np.frombuffer(block, _PART, n, 8), np.frombuffer(block, np.uint8, -1, 8 + n * _PART.itemsize)

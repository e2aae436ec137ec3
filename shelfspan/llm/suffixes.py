"""Removal of byte strings that an earlier document holds, by sorted suffixes.

A byte goes if a string of 50 bytes covers it that also starts in a document of
smaller id. Of every 33 neighbouring 18-byte grams the one with the least hash
is an anchor, so equal strings of 50 bytes share an anchor at the same place
(winnowing), and only suffixes at anchors are sorted.

1. Anchors whose gram occurs in two documents are found by their hash.
2. Each such anchor becomes a suffix of 50 bytes with the 32 bytes before it.
   Splitters sampled from the texts deal suffixes to ranges by these bytes, so
   the suffixes of one very frequent gram spread over many ranges.
3. A range sorts its suffixes by a multikey quicksort over 8-byte words. From
   the common prefixes of neighbours follow, for every split of 50 bytes into
   left and right, the classes of equal strings and their smallest document.
4. A class whose common prefix a splitter of its range shares may go on in the
   range beyond. The suffixes of its smallest document here are compared across
   the boundary: they meet by their string, one row per range and place.
5. The covered bytes go back to the texts.

Anchors, suffixes and results travel as compressed blobs by hash, range or
document; within a task equal suffixes are reduced to their smallest document
first, so a passage of very many documents sends few of them.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import zstandard
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from shelfspan.llm.blobs import by_part, groups, pack, unpack
from shelfspan.llm.text import column_of, flat, slices
from shelfspan.operators.joins import attach
from shelfspan.operators.ordering import running_totals
from shelfspan.session import settle

LENGTH = 50
GRAM = 18
LEFT = LENGTH - GRAM
#: Bytes of text whose anchors a task reduces at once, and bytes of text per bucket and range.
REDUCE_BYTES = 24_000_000
BUCKET_BYTES, LEAST_BUCKETS = 8_000_000, 64
#: Rows of a partition that are sorted directly.
FEW = 48
#: Sampled suffixes per range, and the most that the driver gets; ranges hold more text where that binds.
SAMPLES, MOST_SAMPLES = 24, 400_000
BASE = 0x9E3779B97F4A7C15
RESULT = "doc_id long, n_bytes long, n_removed long, n_spans long, kept_sha256 string, kept binary"
ROWS = "kind int, part long, a binary, b binary, c binary, d binary"
HASHES, SHARED, COPIES, SPANS, TEXT, SUFFIXES, OPEN = range(7)


def row(kind: int, part: int, *blobs: bytes) -> tuple:
    return (kind, part, *blobs, *[None] * (4 - len(blobs)))


def batch_of(rows: list[tuple]) -> pa.RecordBatch:
    kinds = [pa.int32(), pa.int64(), *[pa.binary()] * 4]
    columns = zip(*rows, strict=True) if rows else [[]] * 6
    return pa.RecordBatch.from_arrays([pa.array(list(c), k) for c, k in zip(columns, kinds, strict=True)], ["kind", "part", "a", "b", "c", "d"])


def slide(op, values: np.ndarray, width: int) -> np.ndarray:
    """``op`` over every window of ``width`` values, by doubling."""
    n = 1
    while n * 2 <= width:
        values = op(values[:-n], values[n:])
        n *= 2
    return op(values[: len(values) - (width - n)], values[width - n :]) if n < width else values


def anchors(raw: np.ndarray, starts: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Document index, place in the whole array, and gram hash of the anchors of concatenated texts."""
    nothing = np.zeros(0, np.int64), np.zeros(0, np.int64), np.zeros(0, np.uint64)
    if len(raw) < LENGTH:
        return nothing
    hashed = raw.astype(np.uint64) + np.uint64(1)
    powers, n = {1: hashed}, 1
    while n * 2 <= GRAM:
        factor = np.uint64(pow(BASE, n, 1 << 64))
        powers[2 * n] = powers[n][:-n] * factor + powers[n][n:]
        n *= 2
    code, done = powers[n], n
    while done < GRAM:
        n = max(p for p in powers if p <= GRAM - done)
        code = code[: len(raw) - done - n + 1] * np.uint64(pow(BASE, n, 1 << 64)) + powers[n][done:]
        done += n
    code = (code ^ (code >> np.uint64(32))) * np.uint64(0xD6E8FEB86659FD93)
    code ^= code >> np.uint64(32)
    width = LENGTH - GRAM + 1
    low = slide(np.minimum, code, width)
    edge = np.zeros(width - 1, np.uint64)
    # A gram is least in one of its windows if the greatest of the windows' minima is its own hash.
    at = np.flatnonzero(slide(np.maximum, np.concatenate([edge, low, edge]), width) == code)
    of = np.searchsorted(starts, at, "right") - 1
    inside = at + GRAM <= starts[of + 1]
    return of[inside], at[inside], code[at[inside]]


def part_of_doc(docs: np.ndarray, parts: int) -> np.ndarray:
    mixed = docs.astype(np.int64).view(np.uint64) * np.uint64(BASE)
    return ((mixed >> np.uint64(33)) % np.uint64(parts)).astype(np.int64)


def doc_blobs(kind: int, parts: int, docs: np.ndarray, *columns: np.ndarray) -> list[tuple]:
    return [row(kind, part, pack(docs[at]), *[pack(c[at]) for c in columns]) for part, at in by_part(part_of_doc(docs, parts))]


def hash_rows(docs: np.ndarray, places: np.ndarray, codes: np.ndarray, parts: int, scale: int) -> list[tuple]:
    """Blobs of one task's anchors: by hash what other tasks may share, by document what is shared here already."""
    if not len(codes):
        return []
    order = np.lexsort((docs, codes))
    docs, places, codes = docs[order], places[order], codes[order]
    first = groups(codes)
    which = np.repeat(np.arange(len(first)), np.diff(np.append(first, len(codes))))
    owner = docs // scale
    last = np.append(first[1:], len(codes)) - 1
    many = owner[first] != owner[last]
    here = many[which]
    out = doc_blobs(SHARED, parts, docs[here], places[here].astype(np.uint32)) if here.any() else []
    # Of a hash met in several documents one row is enough for the others.
    send = ~here
    send[first[many]] = True
    docs, places, codes, here = docs[send], places[send], codes[send], here[send]
    for part, at in by_part((codes >> np.uint64(40)).astype(np.int64) % parts):
        delta = np.diff(codes[at], prepend=np.uint64(0))
        out.append(row(HASHES, part, pack(docs[at]), pack(places[at].astype(np.uint32)), pack(delta), pack(here[at].astype(np.uint8))))
    return out


def find_anchors(docs: DataFrame, parts: int, scale: int) -> DataFrame:
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[tuple] = []
        size = 0
        for batch in slices(batches):
            raw, starts = flat(column_of(batch, "text"))
            ids = column_of(batch, "id").to_numpy()
            of, at, code = anchors(raw, starts)
            held.append((ids[of], at - starts[of], code))
            size += len(raw)
            if size >= REDUCE_BYTES:
                yield batch_of(hash_rows(*map(np.concatenate, zip(*held, strict=True)), parts, scale))
                held, size = [], 0
        if held:
            yield batch_of(hash_rows(*map(np.concatenate, zip(*held, strict=True)), parts, scale))

    return docs.select("id", "text").mapInArrow(run, ROWS)


def dealt(rows: DataFrame, parts: int) -> DataFrame:
    """Rows of the same part together and in the order of their kinds."""
    return rows.repartition(parts, "part").sortWithinPartitions("part", "kind")


def part_rows(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple]:
    for batch in batches:
        yield from zip(*[c.to_pylist() for c in batch.columns], strict=True)


def share_anchors(rows: DataFrame, parts: int, scale: int) -> DataFrame:
    """By document, the anchors whose hash occurs in two documents."""

    def shared(held: list[tuple]) -> list[tuple]:
        docs = np.concatenate([unpack(a, np.int64) for a, _, _, _ in held])
        places = np.concatenate([unpack(b, np.uint32) for _, b, _, _ in held])
        codes = np.concatenate([np.cumsum(unpack(c, np.uint64), dtype=np.uint64) for _, _, c, _ in held])
        told = np.concatenate([unpack(d, np.uint8) for _, _, _, d in held]).astype(bool)
        order = np.lexsort((docs, codes))
        docs, places, codes, told = docs[order], places[order], codes[order], told[order]
        first = groups(codes)
        sizes = np.diff(np.append(first, len(codes)))
        owner = docs // scale
        many = (owner[first] != owner[first + sizes - 1]) | np.logical_or.reduceat(told, first)
        keep = np.repeat(many, sizes) & ~told
        return doc_blobs(SHARED, parts, docs[keep], places[keep]) if keep.any() else []

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held, now = [], None
        for kind, part, a, b, c, d in part_rows(batches):
            if part != now and held:
                yield batch_of(shared(held))
                held = []
            now = part
            if kind == HASHES:
                held.append((a, b, c, d))
            else:
                yield batch_of([(kind, part, a, b, c, d)])
        if held:
            yield batch_of(shared(held))

    return dealt(rows, parts).mapInArrow(run, ROWS)


def text_rows(docs: DataFrame, parts: int) -> DataFrame:
    """Compressed texts by document, each with its number and doc_id."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        press = zstandard.ZstdCompressor(level=3)
        for batch in slices(batches):
            raw, starts = flat(column_of(batch, "text"))
            ids = column_of(batch, "id").to_numpy()
            names = [b"" if n is None else n.to_bytes(8, "little", signed=True) for n in column_of(batch, "doc_id").to_pylist()]
            data = raw.tobytes()
            where = part_of_doc(ids, parts).tolist()
            yield batch_of([row(TEXT, w, i.tobytes(), press.compress(data[a:b]), n) for w, i, n, a, b in zip(where, ids, names, starts[:-1].tolist(), starts[1:].tolist(), strict=True)])

    return docs.select("id", "doc_id", "text").mapInArrow(run, ROWS)


def contexts(raw: np.ndarray, starts: np.ndarray, of: np.ndarray, at: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """The LEFT bytes before (nearest first) and the LENGTH bytes from each place, zeros outside the text; how many are real on either side."""
    left = np.minimum(LEFT, at - starts[of])
    right = np.minimum(LENGTH, starts[of + 1] - at)
    padded = np.concatenate([np.zeros(LEFT, np.uint8), raw, np.zeros(LENGTH, np.uint8)])
    view = np.lib.stride_tricks.sliding_window_view(padded, LEFT + LENGTH)[at]
    sides = np.concatenate([view[:, LEFT:], view[:, LEFT - 1 :: -1]], 1)
    span = np.concatenate([np.broadcast_to(np.arange(LENGTH), (len(at), LENGTH)), np.broadcast_to(np.arange(LEFT), (len(at), LEFT))], 1)
    real = np.concatenate([np.broadcast_to(right[:, None], (len(at), LENGTH)), np.broadcast_to(left[:, None], (len(at), LEFT))], 1)
    return np.where(span < real, sides, 0).astype(np.uint8), left.astype(np.uint8), right.astype(np.uint8)


def leads_of(sides: np.ndarray) -> np.ndarray:
    """Contexts as byte strings of the same order."""
    return np.ascontiguousarray(sides).view(f"S{LENGTH + LEFT}").ravel()


def words(table: np.ndarray) -> np.ndarray:
    """Rows of bytes as rows of 8-byte numbers of the same order."""
    wide = np.zeros((len(table), -(-table.shape[1] // 8) * 8), np.uint8)
    wide[:, : table.shape[1]] = table
    return wide.view(">u8").astype(np.uint64)


def within(start: np.ndarray, size: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """All places of the given runs, and the run of each."""
    run = np.repeat(np.arange(len(start)), size)
    return start[run] + np.arange(len(run)) - (np.cumsum(size) - size)[run], run


def multikey_order(table: np.ndarray) -> np.ndarray:
    """Places of the rows in sorted order, by multikey quicksort over 8-byte words.

    All partitions of a round are split at once: rows less than, equal to and
    greater than the median of three of their partition at its word. Equal rows
    go on with the next word. Partitions of up to FEW rows are sorted by the word
    at hand directly.
    """
    keys = words(table)
    order = np.arange(len(keys))
    start, size, level = (np.array([x]) for x in (0, len(keys), 0))
    while len(start):
        few = size <= FEW
        start, size, level = (np.concatenate(x) for x in zip(split_few(keys, order, start[few], size[few], level[few]), split_many(keys, order, start[~few], size[~few], level[~few]), strict=True))
        going = (size > 1) & (level < keys.shape[1])
        start, size, level = start[going], size[going], level[going]
    return order


def split_few(keys: np.ndarray, order: np.ndarray, start: np.ndarray, size: np.ndarray, level: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Sort small partitions by their word; what is equal there is a partition of the next word."""
    at, run = within(start, size)
    value = keys[order[at], level[run]]
    inner = np.lexsort((value, run))
    order[at] = order[at[inner]]
    value = value[inner]
    new = np.flatnonzero(np.r_[True, (value[1:] != value[:-1]) | (run[1:] != run[:-1])][: len(at)])
    return at[new], np.diff(np.append(new, len(at))), level[run[new]] + 1


def split_many(keys: np.ndarray, order: np.ndarray, start: np.ndarray, size: np.ndarray, level: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Three-way partition of each large partition; less, equal and greater rows become partitions."""
    at, run = within(start, size)
    rows = order[at]
    value = keys[rows, level[run]]
    first = np.cumsum(size) - size
    pivot = np.sort(np.stack([value[first], value[first + size // 2], value[first + size - 1]]), 0)[1]
    less, more = value < pivot[run], value > pivot[run]
    parts, done = [], start.copy()
    for side, deeper in ((less, 0), (~less & ~more, 1), (more, 0)):
        hit = np.flatnonzero(side)
        count = np.bincount(run[hit], minlength=len(start))
        order[within(done, count)[0]] = rows[hit]
        parts.append((done.copy(), count, level + deeper))
        done += count
    return tuple(np.concatenate(x) for x in zip(*parts, strict=True))


def common(table: np.ndarray, order: np.ndarray) -> np.ndarray:
    """Length of the common prefix of each sorted row with the one before; 0 for the first."""
    ordered = table[order]
    differs = ordered[1:] != ordered[:-1]
    found = np.where(differs.any(1), differs.argmax(1), table.shape[1])
    return np.r_[0, found]


def beyond(sides: np.ndarray, edges: list[bytes]) -> np.ndarray:
    """For each suffix, how many leading bytes it shares with a splitter of its range."""
    found = np.zeros(len(sides), np.int64)
    for edge in edges:
        table = np.frombuffer(edge.ljust(LENGTH + LEFT, b"\0"), np.uint8)[:LENGTH]
        differs = sides[:, :LENGTH] != table
        found = np.maximum(found, np.where(differs.any(1), differs.argmax(1), LENGTH))
    return found


def covered(sides: np.ndarray, left: np.ndarray, right: np.ndarray, owner: np.ndarray, reach: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """For each suffix, how many bytes before it and from it strings of smaller documents cover; (0, 0) if none.

    Then the strings that may also lie in the next range, ``reach`` being the
    bytes shared with a splitter: suffix and bytes before it, for the smallest
    document of each class only, as the others are covered already.
    """
    n = len(owner)
    order, turned = multikey_order(sides[:, :LENGTH]), multikey_order(sides[:, LENGTH:])
    prefix, suffix = common(sides[:, :LENGTH], order), common(sides[:, LENGTH:], turned)
    most, least = np.full(n, -1, np.int64), np.full(n, LENGTH, np.int64)
    one, other = np.empty(n, np.int64), np.empty(n, np.int64)
    going = [(np.zeros(0, np.int64), 0)]
    for before in range(LEFT + 1):
        after = LENGTH - before
        one[order] = np.cumsum(prefix < after)
        other[turned] = np.cumsum(suffix < before) if before else 0
        at = np.flatnonzero((left >= before) & (right >= after))
        if not len(at):
            continue
        key = one[at] * (n + 1) + other[at]
        inner = np.lexsort((owner[at], key))
        rows, key = at[inner], key[inner]
        first = groups(key)
        smallest = np.repeat(owner[rows[first]], np.diff(np.append(first, len(rows))))
        later = smallest < owner[rows]
        hit = rows[later]
        most[hit] = np.maximum(most[hit], before)
        least[hit] = np.minimum(least[hit], before)
        going.append((rows[~later & (reach[rows] >= after)], before))
    some = most >= 0
    open_rows = np.concatenate([r for r, _ in going])
    open_before = np.repeat([b for _, b in going], [len(r) for r, _ in going])
    return np.where(some, most, 0), np.where(some, LENGTH - least, 0), open_rows, open_before


def open_blobs(parts: int, docs: np.ndarray, places: np.ndarray, sides: np.ndarray, before: np.ndarray) -> list[tuple]:
    """Strings to compare across boundaries, dealt by their bytes: document, first byte, the 50 bytes."""
    if not len(docs):
        return []
    step = np.arange(LENGTH)
    place = np.where(step < before[:, None], LENGTH + before[:, None] - 1 - step, step - before[:, None])
    strings = np.take_along_axis(sides, place, 1)
    code = np.zeros(len(strings), np.uint64)
    for word in words(strings).T:
        code = (code ^ word) * np.uint64(BASE)
        code ^= code >> np.uint64(29)
    return [row(OPEN, part, pack(docs[at]), pack((places - before)[at].astype(np.uint32)), pack(strings[at])) for part, at in by_part((code >> np.uint64(33)).astype(np.int64) % parts)]


def across(rows: DataFrame, parts: int, scale: int) -> DataFrame:
    """Spans of the strings of a range that a smaller document has in another range."""

    def matched(held: list[tuple]) -> list[tuple]:
        docs = np.concatenate([unpack(a, np.int64) for a, _, _ in held])
        start = np.concatenate([unpack(b, np.uint32) for _, b, _ in held]).astype(np.int64)
        unpress = zstandard.ZstdDecompressor().decompress
        strings = np.concatenate([np.frombuffer(unpress(c), np.uint8).reshape(-1, LENGTH) for _, _, c in held])
        order = multikey_order(strings)
        first = np.flatnonzero(common(strings, order) < LENGTH)
        owner = docs[order] // scale
        smallest = np.repeat(np.minimum.reduceat(owner, first), np.diff(np.append(first, len(order))))
        later = order[smallest < owner]
        return span_blobs(parts, docs[later], start[later], start[later] + LENGTH)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held, now = [], None
        for _, part, a, b, c, _ in part_rows(batches):
            if part != now and held:
                yield batch_of(matched(held))
                held = []
            now = part
            held.append((a, b, c))
        if held:
            yield batch_of(matched(held))

    return dealt(rows, parts).mapInArrow(run, ROWS)


def reduce_suffixes(docs, places, sides, left, right, scale: int):
    """Equal suffixes with equal bytes before them: the rows of the smallest document, and the spans of the others."""
    order = multikey_order(sides)
    keys = np.concatenate([sides[order], left[order, None], right[order, None]], 1)
    new = np.r_[True, (keys[1:] != keys[:-1]).any(1)]
    group = np.empty(len(order), np.int64)
    group[order] = np.cumsum(new) - 1
    owner = docs // scale
    smallest = np.full(int(new.sum()), np.iinfo(np.int64).max)
    np.minimum.at(smallest, group, owner)
    later = owner > smallest[group]
    long_enough = later & (left.astype(int) + right >= LENGTH)
    spans = docs[long_enough], places[long_enough] - left[long_enough], places[long_enough].astype(np.int64) + right[long_enough]
    return np.flatnonzero(~later), spans


def span_blobs(parts: int, docs: np.ndarray, start: np.ndarray, end: np.ndarray) -> list[tuple]:
    """Covered spans by document; those that touch are joined first."""
    if not len(docs):
        return []
    docs, start, end = joined(docs, start.astype(np.int64), end.astype(np.int64))
    return doc_blobs(SPANS, parts, docs, start.astype(np.uint32), end.astype(np.uint32))


def joined(docs: np.ndarray, start: np.ndarray, end: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    order = np.lexsort((start, docs))
    docs, start, end = docs[order], start[order], end[order]
    # Running maximum of the ends within each document, made one sequence by an offset.
    step = int(end.max()) + 1
    number = np.repeat(np.arange(len(groups(docs))), np.diff(np.append(groups(docs), len(docs))))
    reach = np.maximum.accumulate(end + number * step)
    new = np.r_[True, (start[1:] + number[1:] * step > reach[:-1])]
    first = np.flatnonzero(new)
    last = np.append(first[1:], len(docs)) - 1
    return docs[first], start[first], reach[last] - number[last] * step


def cut_suffixes(rows: DataFrame, splitters: np.ndarray, parts: int, scale: int) -> DataFrame:
    """Suffixes at shared anchors, dealt to ranges, out of texts and anchors of the same part."""
    shared = rows.sparkSession.sparkContext.broadcast(splitters)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        splitters, unpress = shared.value, zstandard.ZstdDecompressor()

        def send(held: list[tuple]) -> list[tuple]:
            docs, places, sides, left, right = map(np.concatenate, zip(*held, strict=True))
            keep, spans = reduce_suffixes(docs, places, sides, left, right, scale)
            out = span_blobs(parts, *spans)
            docs, places, sides, left, right = docs[keep], places[keep], sides[keep], left[keep], right[keep]
            lead = leads_of(sides)
            for part, at in by_part(np.searchsorted(splitters, lead, "right")):
                at = at[np.argsort(lead[at], kind="stable")]
                sizes = np.stack([left[at], right[at]]).tobytes()
                out.append(row(SUFFIXES, part, pack(docs[at]), pack(places[at].astype(np.uint32)), pack(sides[at]), zstandard.ZstdCompressor(level=1).compress(sizes)))
            return out

        now, anchors_of, copies, ready = None, [], set(), None
        texts: list[tuple[int, bytes]] = []
        held: list[tuple] = []
        size = 0

        def cut() -> int:
            """Contexts of the texts at hand."""
            docs, places, starts_of, ids = ready
            raw = np.frombuffer(b"".join(t for _, t in texts), np.uint8)
            starts = np.cumsum([0, *[len(t) for _, t in texts]])
            which = np.array([i for i, _ in texts], np.int64)
            slot = np.searchsorted(ids, which)
            known = (slot < len(ids)) & (ids[np.minimum(slot, len(ids) - 1)] == which) if len(ids) else np.zeros(len(which), bool)
            ranges = [np.arange(starts_of[s], starts_of[s + 1]) if k else np.zeros(0, np.int64) for s, k in zip(slot, known, strict=True)]
            entry = np.concatenate(ranges) if ranges else np.zeros(0, np.int64)
            of = np.repeat(np.arange(len(texts)), [len(r) for r in ranges])
            at = places[entry].astype(np.int64) + starts[of]
            fits = at + GRAM <= starts[of + 1]
            of, at, entry = of[fits], at[fits], entry[fits]
            texts.clear()
            if len(at):
                held.append((docs[entry], places[entry].astype(np.int64), *contexts(raw, starts, of, at)))
            return len(at)

        for kind, part, a, b, _, _ in part_rows(batches):
            if part != now:
                if texts:
                    size += cut()
                now, anchors_of, copies, ready = part, [], set(), None
            if kind == SHARED:
                anchors_of.append((unpack(a, np.int64), unpack(b, np.uint32)))
            elif kind == COPIES:
                copies.add(int(np.frombuffer(a, np.int64)[0]))
            else:
                if ready is None:
                    docs = np.concatenate([x for x, _ in anchors_of]) if anchors_of else np.zeros(0, np.int64)
                    places = np.concatenate([x for _, x in anchors_of]) if anchors_of else np.zeros(0, np.uint32)
                    order = np.lexsort((places, docs))
                    docs, places = docs[order], places[order]
                    first = groups(docs)
                    ready = docs, places, np.append(first, len(docs)), docs[first]
                    anchors_of = []
                i = int(np.frombuffer(a, np.int64)[0])
                if i not in copies:
                    texts.append((i, unpress.decompress(b)))
                    if sum(len(t) for _, t in texts[-1:]) > 1_000_000 or len(texts) >= 400:
                        size += cut()
            if size >= 300_000:
                yield batch_of(send(held))
                held, size = [], 0
        if texts:
            cut()
        if held:
            yield batch_of(send(held))

    return dealt(rows, parts).mapInArrow(run, ROWS)


def match_suffixes(rows: DataFrame, splitters: np.ndarray, parts: int, scale: int) -> DataFrame:
    """Covered spans by document, out of the sorted suffixes of each range, and strings to compare across its boundaries."""
    shared = rows.sparkSession.sparkContext.broadcast(splitters)

    def matched(held: list[tuple], part: int) -> list[tuple]:
        edges = [bytes(x) for x in shared.value[max(part - 1, 0) : part + 1]]
        docs = np.concatenate([unpack(a, np.int64) for a, _, _, _ in held])
        places = np.concatenate([unpack(b, np.uint32) for _, b, _, _ in held]).astype(np.int64)
        unpress = zstandard.ZstdDecompressor().decompress
        sides = np.concatenate([np.frombuffer(unpress(c), np.uint8).reshape(-1, LENGTH + LEFT) for _, _, c, _ in held])
        sizes = [np.frombuffer(unpress(d), np.uint8).reshape(2, -1) for _, _, _, d in held]
        left, right = np.concatenate([s[0] for s in sizes]), np.concatenate([s[1] for s in sizes])
        keep, spans = reduce_suffixes(docs, places, sides, left, right, scale)
        docs, places, sides, left, right = docs[keep], places[keep], sides[keep], left[keep], right[keep]
        before, after, at, lead = covered(sides, left, right, docs // scale, beyond(sides, edges))
        some = after > 0
        all_docs, start, end = (np.concatenate(x) for x in zip(spans, (docs[some], (places - before)[some], (places + after)[some]), strict=True))
        return span_blobs(parts, all_docs, start, end) + open_blobs(parts, docs[at], places[at], sides[at], lead)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held, now = [], None
        for kind, part, a, b, c, d in part_rows(batches):
            if part != now and held:
                yield batch_of(matched(held, now))
                held = []
            now = part
            if kind == SUFFIXES:
                held.append((a, b, c, d))
            else:
                yield batch_of([(kind, part, a, b, c, d)])
        if held:
            yield batch_of(matched(held, now))

    return dealt(rows, len(splitters) + 1).mapInArrow(run, ROWS)


def strip(rows: DataFrame, parts: int) -> DataFrame:
    """``doc_id, n_bytes, n_removed, n_spans, kept_sha256, kept`` out of texts and spans of the same part."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        unpress = zstandard.ZstdDecompressor()
        now, spans, copies, ready, out, size = None, [], set(), {}, [], 0

        def flush() -> pa.RecordBatch:
            kinds = [pa.int64()] * 4 + [pa.string(), pa.binary()]
            return pa.RecordBatch.from_arrays([pa.array(list(c), k) for c, k in zip(zip(*out, strict=True), kinds, strict=True)], ["doc_id", "n_bytes", "n_removed", "n_spans", "kept_sha256", "kept"])

        for kind, part, a, b, c, _ in part_rows(batches):
            if part != now:
                now, spans, copies, ready = part, [], set(), None
            if kind == SPANS:
                spans.append((unpack(a, np.int64), unpack(b, np.uint32), unpack(c, np.uint32)))
                continue
            if kind == COPIES:
                copies.add(int(np.frombuffer(a, np.int64)[0]))
                continue
            if ready is None:
                ready = {}
                if spans:
                    docs, start, end = joined(*[np.concatenate(x).astype(np.int64) for x in zip(*spans, strict=True)])
                    first = groups(docs)
                    for s, e in zip(first, [*first[1:], len(docs)], strict=True):
                        ready[int(docs[s])] = list(zip(start[s:e].tolist(), end[s:e].tolist(), strict=True))
            i, text = int(np.frombuffer(a, np.int64)[0]), unpress.decompress(b)
            cut = [(0, len(text))] if i in copies and len(text) >= LENGTH else ready.get(i, [])
            kept = b"".join([text[s:e] for s, e in zip([0, *[e for _, e in cut]], [*[s for s, _ in cut], len(text)], strict=True)])
            out.append((int.from_bytes(c, "little", signed=True) if c else None, len(text), len(text) - len(kept), len(cut), hashlib.sha256(kept).hexdigest(), kept))
            size += len(kept)
            if size > 4_000_000 or len(out) > 2_000:
                yield flush()
                out, size = [], 0
        if out:
            yield flush()

    return dealt(rows, parts).mapInArrow(run, RESULT)


def sample_splitters(docs: DataFrame, total: int, ranges: int) -> np.ndarray:
    """Contexts that cut the suffixes of sampled texts into ranges; the driver gets SAMPLES of them per range, MOST_SAMPLES at most."""
    ranges = min(ranges, MOST_SAMPLES // SAMPLES)
    wanted = ranges * SAMPLES
    # About 17 bytes of text per anchor, of which a quarter are drawn; texts are drawn by a hash of their number.
    share, steps = min(1.0, max(2_000_000, wanted * 17 * 4) / max(total, 1)), 1 << 40

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches):
            raw, starts = flat(column_of(batch, "text"))
            of, at, code = anchors(raw, starts)
            drawn = np.flatnonzero((code * np.uint64(BASE) >> np.uint64(32)) % np.uint64(4) == 0)
            # One very long text counts like others: it moves splitters, never results.
            drawn = drawn[:: 1 + len(drawn) // 50_000]
            sides = contexts(raw, starts, of[drawn], at[drawn])[0]
            yield pa.RecordBatch.from_arrays([pa.array([s.tobytes() for s in sides], pa.binary())], ["lead"])

    drawn = docs.where(F.pmod(F.xxhash64("id"), F.lit(steps)) < int(share * steps)).select("id", "text")
    leads = drawn.mapInArrow(run, "lead binary").groupBy("lead").agg(F.count(F.lit(1)).alias("n")).toPandas()
    kind = f"S{LENGTH + LEFT}"
    found = np.sort(np.repeat(np.array([bytes(x) for x in leads["lead"]], kind), leads["n"].to_numpy(int)))
    if not len(found):
        return np.zeros(0, kind)
    return np.unique(found[np.linspace(0, len(found) - 1, ranges + 1).astype(int)[1:-1]])


def numbers(facts: DataFrame) -> tuple[DataFrame, int]:
    """``_none, _id, hash, id``: a number for each text of each doc_id, in the order of doc_id (null last), and numbers per doc_id.

    Ids are ranked over ranges of their order, so nothing is multiplied with an
    id and no id with very many texts meets in one window. Rank times places
    stays below 2^62 up to 2^32 different texts, whatever their ids.
    """
    texts = settle(facts.select("_none", "_id", "hash").distinct().withColumn("one", F.lit(1).cast("long")), "texts")
    ids = running_totals(texts.groupBy("_none", "_id").agg(F.sum("one").alias("n")).withColumn("one", F.lit(1).cast("long")), ["_none", "_id"], ["one", "n"])
    ids = settle(ids.select("_none", "_id", F.col("one_before").alias("rank"), F.col("n_before").alias("first"), "n"), "ids")
    scale = ids.agg(F.max("n")).first()[0]
    placed = attach(running_totals(texts, ["_none", "_id", "hash"], ["one"]), ids, ["_none", "_id"], spread_by=["hash"], settled=True)
    number = F.col("rank") * scale + F.col("one_before") - F.col("first")
    return settle(placed.select("_none", "_id", "hash", number.alias("id")), "numbers"), scale


def remove_repeats(docs: DataFrame) -> DataFrame:
    """``doc_id, n_bytes, n_removed, n_spans, kept_sha256, kept`` of every row.

    Null texts are empty. A null doc_id counts as greater than any; ids may be
    any 64-bit numbers. Rows that repeat a doc_id are one document and take
    nothing from each other, also if their texts differ. A later copy of a whole
    text goes as a whole, if it has 50 bytes. ``kept`` holds the bytes left.
    """
    keys = {"_none": F.col("doc_id").isNull().cast("int"), "_id": F.coalesce(F.col("doc_id").cast("long"), F.lit(0).cast("long"))}
    hashed = F.md5(F.col("text").cast("binary"))
    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.coalesce("text", F.lit("")).alias("text")).withColumns(keys)
    # Equal texts are found by hash first; only the smallest document goes on to the suffixes.
    facts = settle(rows.select("_none", "_id", F.octet_length("text").alias("size"), hashed.alias("hash")), "texts")
    total, top, nulls = facts.agg(F.sum("size"), F.max(F.when(F.col("_none") == 0, F.col("_id"))), F.max("_none")).first()
    if total is None:
        return rows.sparkSession.createDataFrame([], RESULT)
    several = facts.groupBy("_none", "_id").agg(F.min("hash").alias("low"), F.max("hash").alias("high")).where("low < high")
    top = -1 if top is None else top
    if (nulls and top == (1 << 63) - 1) or not several.isEmpty():
        # Documents of one id with different texts get numbers of their own.
        placed, scale = numbers(facts)
        known = ["_none", "_id", "hash"]
        rows = attach(rows.withColumn("hash", hashed), placed, known, settled=True)
        facts = attach(facts, placed, known, settled=True)
    else:
        scale, number = 1, F.when(F.col("_none") == 0, F.col("_id")).otherwise(F.lit(min(top + 1, (1 << 63) - 1)))
        rows, facts = rows.withColumn("id", number), facts.withColumn("id", number)
    parts = max(LEAST_BUCKETS, -(-total // BUCKET_BYTES))
    facts = facts.withColumn("owner", F.expr(f"id div {scale}"))
    least = facts.groupBy("hash").agg(F.min("owner").alias("first"), F.max("owner").alias("last")).where("first < last").select("hash", "first")
    later = attach(facts, least, ["hash"], "inner", spread_by=["id"]).where("owner > first").select("id").distinct()

    def copy_rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            ids = batch.column(0).to_numpy()
            yield batch_of([row(COPIES, w, i.tobytes()) for w, i in zip(part_of_doc(ids, parts).tolist(), ids, strict=True)])

    copies = settle(later.mapInArrow(copy_rows, ROWS), "copies")
    splitters = sample_splitters(rows, total, parts)
    shared = share_anchors(find_anchors(rows, parts, scale), parts, scale)
    texts = text_rows(rows, parts)
    suffixes = cut_suffixes(shared.unionByName(copies).unionByName(texts), splitters, parts, scale)
    matched = settle(match_suffixes(suffixes, splitters, parts, scale), "spans")
    spans = matched.where(F.col("kind") == SPANS).unionByName(across(matched.where(F.col("kind") == OPEN), parts, scale))
    return strip(spans.unionByName(copies).unionByName(texts), parts)

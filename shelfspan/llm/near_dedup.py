"""Near-duplicates: consistent weighted samples of TF-IDF shingles, banded and verified.

Shingles are five words in a row (a shorter text is one shingle). A shingle
weighs its count in the text times an inverse document frequency between 1 and
2; document frequencies are counted over all texts in hashed buckets. Improved
consistent weighted sampling draws SAMPLES shingles of each text, equal for two
texts with a chance of their weighted Jaccard similarity. Texts that agree in
all samples of a band are candidates; candidates are verified on whole texts.

Equal texts are one node, numbered apart from their ids, which may be null or
repeated. In a bucket every text is first compared with one pivot, then texts
of other classes with a few more, with new ones as long as that joins many
classes. Of what is still apart only those candidates are compared that share
one of their rarest shared shingles: two texts at the wanted similarity always
do, so no link between candidates is lost, and no bucket is expanded pair by pair.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from functools import lru_cache
from itertools import pairwise

import numpy as np
import pyarrow as pa
import xxhash
import zstandard
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql.types import MapType, VariantType

from shelfspan.llm.blobs import by_part, groups, pack, unpack
from shelfspan.llm.graph import components
from shelfspan.llm.text import column_of, flat, slices, strings
from shelfspan.operators.joins import attach
from shelfspan.session import settle

SHINGLE = 5
SIMILARITY = 0.8
#: Bands of rows: a pair at 0.8 is missed with a chance of (1 - 0.8^3)^12 = 0.00018.
BANDS, ROWS = 12, 3
FREQUENCY_BITS = 17
TABLE_BITS = 14
#: Expected pivots of a bucket in the second round; rows compared in one group.
PIVOTS, CHUNK = 16, 32
#: New pivots are drawn as long as the last ones left less than this share of the classes, in buckets of more texts than that.
STILL_JOINING, LARGE = 0.75, 8 * PIVOTS
#: Rarer shingles that a row of a shingle takes along, by which most pairs that met at one of them are known.
LOOKED_BACK = 4
HASH_BITS = 44
#: Shingles sampled at once, so that the work stays in the processor's cache.
AT_ONCE = 40_000
#: Packed texts that are unpacked at a time.
AT_A_TIME = 64
#: Shingles of several texts that a task holds before it tells the others of them.
HELD = 500_000
#: Bytes between words; those of WORD are all others.
SEPARATES = np.isin(np.arange(256), [32, 9, 10, 11, 12, 13])
# Odd multipliers of the hashes.
ODD = tuple(np.uint64(x) for x in (0x9E3779B97F4A7C15, 0xC2B2AE3D27D4EB4F, 0x165667B19E3779F9, 0xD6E8FEB86659FD93, 0xA0761D6478BD642F))


def _mix(x: np.ndarray) -> np.ndarray:
    x = (x ^ (x >> np.uint64(32))) * ODD[3]
    x = (x ^ (x >> np.uint64(29))) * ODD[4]
    return x ^ (x >> np.uint64(32))


def hashed_words(raw: np.ndarray, starts: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Hashes of the words of all texts, one after another, and the number of words of each text; of UTF-8 bytes as ``text.flat`` gives them."""
    inside = ~SEPARATES[raw]
    head, tail = inside.copy(), inside.copy()
    head[1:] &= ~inside[:-1]
    tail[:-1] &= ~inside[1:]
    some = starts[1:] > starts[:-1]
    first, last = starts[:-1][some], starts[1:][some] - 1
    head[first], tail[last] = inside[first], inside[last]
    at = np.flatnonzero(head)
    ends = np.append(0, np.cumsum(np.flatnonzero(tail) + 1 - at))
    letters = raw[inside]
    words = pa.Array.from_buffers(pa.large_binary(), len(at), [None, pa.py_buffer(ends), pa.py_buffer(letters)]).dictionary_encode()
    different = words.dictionary.to_pylist()
    hashes = np.fromiter(map(xxhash.xxh3_64_intdigest, different), np.uint64, len(different))
    return hashes[words.indices.to_numpy()], np.diff(np.searchsorted(at, starts))


class Shingler:
    """Hashed shingles of texts."""

    def __call__(self, texts: list[str] | list[bytes]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Different shingles of each text in rising order, their counts, and the n + 1 starts of texts."""
        coded = [t.encode() if isinstance(t, str) else t for t in texts]
        return self.of(np.frombuffer(b"".join(coded), np.uint8), np.append(0, np.cumsum([len(t) for t in coded], dtype=np.int64)))

    def of(self, raw: np.ndarray, starts: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """The same of texts one after another in UTF-8, from each of ``starts`` to the next."""
        words, number = hashed_words(raw, starts)
        texts = len(number)
        lengths = np.where(number > 0, np.maximum(number, SHINGLE), 0)
        if (lengths > number).any():
            # Texts of fewer words are filled up with zeros.
            filled = np.zeros(lengths.sum(), np.uint64)
            filled[np.arange(len(words)) + np.repeat(np.cumsum(lengths - number) - (lengths - number), number)] = words
            words = filled
        n = len(words) - SHINGLE + 1
        if n <= 0:
            return np.zeros(0, np.uint64), np.zeros(0, np.int64), np.zeros(texts + 1, np.int64)
        of = np.repeat(np.arange(texts), lengths)
        code = words[:n].copy()
        for k in range(1, SHINGLE):
            code *= ODD[0]
            code += words[k : n + k]
        inside = of[:n] == of[SHINGLE - 1 :]
        # The text's number and the hash in one sortable number.
        both = np.sort((of[:n][inside].astype(np.uint64) << np.uint64(HASH_BITS)) | (_mix(code[inside]) >> np.uint64(64 - HASH_BITS)))
        at = np.flatnonzero(np.r_[True, both[1:] != both[:-1]]) if len(both) else np.zeros(0, np.int64)
        counts = np.diff(np.append(at, len(both)))
        both = both[at]
        bounds = np.searchsorted(both, np.arange(texts + 1, dtype=np.uint64) << np.uint64(HASH_BITS))
        return both & np.uint64((1 << HASH_BITS) - 1), counts, bounds


def bucket_of(shingles: np.ndarray) -> np.ndarray:
    return (shingles >> np.uint64(HASH_BITS - FREQUENCY_BITS)).astype(np.int64)


def document_frequencies(docs: DataFrame) -> tuple[np.ndarray, int]:
    """In how many texts each bucket's shingles occur, and the number of texts with words; over all rows."""

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        shingler, sums = Shingler(), np.zeros((1 << FREQUENCY_BITS) + 1, np.int64)
        for batch in slices(batches):
            shingles, _, starts = shingler.of(*flat(column_of(batch, "text")))
            sums[:-1] += np.bincount(bucket_of(shingles), minlength=1 << FREQUENCY_BITS)
            sums[-1] += (np.diff(starts) > 0).sum()
        at = np.flatnonzero(sums)
        yield pa.RecordBatch.from_arrays([pa.array(at.astype(np.int32)), pa.array(sums[at])], ["bucket", "n"])

    summed = docs.select("text").mapInArrow(count, "bucket int, n long").groupBy("bucket").agg(F.sum("n").alias("n")).toPandas()
    counts = np.zeros((1 << FREQUENCY_BITS) + 1, np.int64)
    counts[summed["bucket"].to_numpy(int)] = summed["n"].to_numpy()
    return counts[:-1], int(counts[-1])


def inverse_frequencies(counts: np.ndarray, texts: int) -> np.ndarray:
    """1 for shingles of every text, 2 for those of none; buckets of fixed number."""
    return 1 + np.maximum(0, np.log((texts + 1) / (np.minimum(counts, texts) + 1))) / np.log(texts + 2)


@lru_cache(maxsize=1)
def draws() -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Tables of Gamma(2, 1) draws, logarithms of such draws, and uniform draws, from fixed seeds."""
    random = np.random.Generator(np.random.PCG64(20))
    size = 1 << TABLE_BITS
    return tuple(x.astype(np.float32) for x in (random.gamma(2, 1, size), np.log(random.gamma(2, 1, size)), random.random(size)))


def samples(shingles: np.ndarray, weights: np.ndarray, starts: np.ndarray, number: int) -> np.ndarray:
    """One 64-bit mark per text and draw: the chosen shingle with its quantised weight. Texts must have shingles."""
    scale, shift, offset = draws()
    n = len(starts) - 1
    out = np.zeros((n, number), np.uint64)
    mask = np.uint64((1 << TABLE_BITS) - 1)
    first = 0
    while first < n:
        last = max(first + 1, int(np.searchsorted(starts, starts[first] + AT_ONCE, "right")) - 1)
        part = slice(int(starts[first]), int(starts[last]))
        own, log_weight = shingles[part], np.log(weights[part]).astype(np.float32)
        begins = starts[first:last] - starts[first]
        of = np.repeat(np.arange(last - first), np.diff(starts[first : last + 1]))
        for k in range(number):
            hashed = (own + ODD[1]) * (ODD[2] * np.array([2 * k + 1], np.uint64)) >> np.uint64(64 - 3 * TABLE_BITS)
            r = scale[hashed & mask]
            beta = offset[(hashed >> np.uint64(TABLE_BITS)) & mask]
            level = np.floor(log_weight / r + beta)
            cost = shift[hashed >> np.uint64(2 * TABLE_BITS)] - r * (level - beta + np.float32(1))
            at = np.flatnonzero(cost == np.minimum.reduceat(cost, begins)[of])
            chosen = at[np.searchsorted(of[at], np.arange(last - first))]
            out[first:last, k] = _mix(own[chosen] + level[chosen].astype(np.int64).astype(np.uint64) * ODD[0])
        first = last
    return out


def signatures(docs: DataFrame, inverse: np.ndarray) -> DataFrame:
    """``doc_id, text_hash, weight, bands`` of every row; bands is empty for texts without words.

    ``weight`` is the sum of the weights of the text's shingles, ``text_hash``
    the MD5 of the text, null being empty.
    """
    shared = docs.sparkSession.sparkContext.broadcast(inverse)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        shingler = Shingler()
        for batch in slices(batches):
            raw, ends = flat(column_of(batch, "text"))
            shingles, counts, starts = shingler.of(raw, ends)
            some = np.flatnonzero(np.diff(starts) > 0)
            bands = np.zeros((len(some), BANDS), np.uint64)
            total = np.zeros(batch.num_rows)
            if len(some):
                weights = counts * shared.value[bucket_of(shingles)]
                marks = samples(shingles, weights, np.append(starts[some], starts[-1]), BANDS * ROWS).reshape(len(some), BANDS, ROWS)
                total[some] = np.add.reduceat(weights, starts[some])
                for row in range(ROWS):
                    bands = _mix(bands * ODD[0] + marks[:, :, row])
                bands = _mix(bands + np.arange(BANDS, dtype=np.uint64) * ODD[1])
            sizes = np.zeros(batch.num_rows + 1, np.int32)
            sizes[some + 1] = BANDS
            lists = pa.ListArray.from_arrays(pa.array(np.cumsum(sizes).astype(np.int32)), pa.array(bands.ravel().astype(np.int64)))
            hashes = pa.array([hashlib.md5(raw[a:b]).digest() for a, b in pairwise(ends.tolist())], pa.binary())
            yield pa.RecordBatch.from_arrays([column_of(batch, "doc_id"), hashes, pa.array(total), lists], ["doc_id", "text_hash", "weight", "bands"])

    return docs.select("doc_id", "text").mapInArrow(run, "doc_id long, text_hash binary, weight double, bands array<long>")


def packed(docs: DataFrame) -> DataFrame:
    """``node, packed``: texts, compressed."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        press = zstandard.ZstdCompressor(level=3)
        for batch in slices(batches):
            yield pa.RecordBatch.from_arrays([column_of(batch, "node"), pa.array([press.compress(t.encode()) for t in strings(batch)], pa.binary())], ["node", "packed"])

    return docs.mapInArrow(run, "node long, packed binary")


def weighed(texts: pa.Array, inverse: np.ndarray) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """Shingles and weights of each of the packed texts; a few are unpacked at a time."""
    shingler, unpack_text = Shingler(), zstandard.ZstdDecompressor()
    for at in range(0, len(texts), AT_A_TIME):
        codes, counts, starts = shingler([unpack_text.decompress(x) for x in texts.slice(at, AT_A_TIME).to_pylist()])
        weights = counts * inverse[bucket_of(codes)]
        for a, b in pairwise(starts.tolist()):
            yield codes[a:b], weights[a:b]


def weighted_jaccard(a: tuple[np.ndarray, np.ndarray], b: tuple[np.ndarray, np.ndarray]) -> float:
    """Sum of minima over sum of maxima of two sorted shingle sets with weights."""
    (x, u), (y, v) = a, b
    if not len(x) or not len(y):
        return 0.0
    at = np.minimum(np.searchsorted(x, y), len(x) - 1)
    both = x[at] == y
    shared = np.minimum(u[at[both]], v[both]).sum()
    return float(shared / (u.sum() + v.sum() - shared))


def verify(pairs: DataFrame, texts: DataFrame, inverse: np.ndarray, similarity: float) -> DataFrame:
    """``a, b, linked`` of the candidate pairs ``a, b``.

    Pairs are grouped by their second text in chunks, which gets one copy of
    that text each; a text with very many partners is spread over many chunks.
    """
    shared = texts.sparkSession.sparkContext.broadcast(inverse)
    sizes = pairs.groupBy("b").agg(F.ceil(F.count(F.lit(1)) / CHUNK).alias("chunks"))
    placed = settle(pairs.join(sizes, "b").select("a", "b", F.pmod(F.xxhash64("a"), F.col("chunks")).alias("chunk")), "pairs")
    left = attach(texts, placed.withColumnRenamed("a", "node"), ["node"], "inner", settled=False)
    heads = placed.select(F.col("b").alias("node"), "chunk").distinct()
    right = attach(texts, heads, ["node"], "inner")
    rows = left.select("b", "chunk", F.col("node").alias("a"), "packed").unionByName(right.select(F.col("node").alias("b"), "chunk", F.lit(None).cast("long").alias("a"), "packed"))

    def compare(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        # Rows come sorted by (b, chunk, a), so the head, which has no a, comes first.
        head, of = None, None
        for batch in batches:
            out = []
            rows = zip(*[batch.column(i).to_pylist() for i in range(3)], strict=True)
            for (b, chunk, a), text in zip(rows, weighed(batch.column(3), shared.value), strict=True):
                if a is None:
                    head, of = text, (b, chunk)
                elif of == (b, chunk):
                    out.append((a, b, weighted_jaccard(text, head) >= similarity))
            if out:
                yield pa.RecordBatch.from_arrays([pa.array(x) for x in zip(*out, strict=True)], ["a", "b", "linked"])

    dealt = rows.select("b", "chunk", "a", "packed").repartition("b", "chunk").sortWithinPartitions("b", "chunk", F.col("a").asc_nulls_first())
    return dealt.mapInArrow(compare, "a long, b long, linked boolean")


def shared_weights(texts: DataFrame, inverse: np.ndarray, parts: int) -> DataFrame:
    """``node, shared``: the weight of the shingles that another of these texts holds too; without a row it is 0.

    Shingles meet by hash in blobs. What several texts of one task share is
    added up there, and one entry tells the other tasks.
    """
    shared = texts.sparkSession.sparkContext.broadcast(inverse)
    schema = "part long, node long, shared double, codes binary, nodes binary, weights binary, told binary"
    names = [c.split()[0] for c in schema.split(", ")]
    kinds = [pa.int64(), pa.int64(), pa.float64(), *[pa.binary()] * 4]

    def out(rows: list[tuple]) -> pa.RecordBatch:
        columns = zip(*rows, strict=True) if rows else [[]] * len(names)
        return pa.RecordBatch.from_arrays([pa.array(list(c), k) for c, k in zip(columns, kinds, strict=True)], names)

    def sums(nodes: np.ndarray, weights: np.ndarray) -> list[tuple]:
        which, index = np.unique(nodes, return_inverse=True)
        return [(n % parts, n, w, None, None, None, None) for n, w in zip(which.tolist(), np.bincount(index, weights=weights).tolist(), strict=True)]

    def local(held: list[tuple]) -> list[tuple]:
        codes, nodes, weights = map(np.concatenate, zip(*held, strict=True))
        order = np.argsort(codes, kind="stable")
        codes, nodes, weights = codes[order], nodes[order], weights[order]
        first = groups(codes)
        sizes = np.diff(np.append(first, len(codes)))
        here = np.repeat(sizes > 1, sizes)
        rows = sums(nodes[here], weights[here])
        send = ~here
        send[first[sizes > 1]] = True
        codes, nodes, weights, here = codes[send], nodes[send], weights[send], here[send]
        for part, at in by_part((codes % np.uint64(parts)).astype(np.int64)):
            rows.append((part, None, None, pack(np.diff(codes[at], prepend=np.uint64(0))), pack(nodes[at]), pack(weights[at]), pack(here[at].astype(np.uint8))))
        return rows

    def send(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held, size = [], 0
        for batch in batches:
            for node, (codes, weights) in zip(batch.column(0).to_pylist(), weighed(batch.column(1), shared.value), strict=True):
                held.append((codes, np.full(len(codes), node, np.int64), weights))
                size += len(codes)
                if size > HELD:
                    yield out(local(held))
                    held, size = [], 0
        if held:
            yield out(local(held))

    def meet(held: list[tuple]) -> list[tuple]:
        codes = np.concatenate([np.cumsum(unpack(c, np.uint64), dtype=np.uint64) for c, _, _, _ in held])
        nodes, weights, told = (np.concatenate([unpack(x[i], k) for x in held]) for i, k in ((1, np.int64), (2, np.float64), (3, np.uint8)))
        order = np.argsort(codes, kind="stable")
        codes, nodes, weights, told = codes[order], nodes[order], weights[order], told[order].astype(bool)
        first = groups(codes)
        sizes = np.diff(np.append(first, len(codes)))
        many = np.repeat((sizes > 1) | np.logical_or.reduceat(told, first), sizes) & ~told
        return sums(nodes[many], weights[many])

    def add(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held, now = [], None
        for batch in batches:
            rows = []
            for part, node, weight, *blobs in zip(*[c.to_pylist() for c in batch.columns], strict=True):
                if part != now and held:
                    rows += meet(held)
                    held = []
                now = part
                if node is None:
                    held.append(tuple(blobs))
                else:
                    rows.append((part, node, weight, None, None, None, None))
            yield out(rows)
        if held:
            yield out(meet(held))

    sent = texts.select("node", "packed").mapInArrow(send, schema)
    met = sent.repartition(parts, "part").sortWithinPartitions("part").mapInArrow(add, schema)
    return met.groupBy("node").agg(F.sum("shared").alias("shared"))


def text_hash(text: Column) -> Column:
    return F.unhex(F.md5(F.coalesce(text, F.lit("")).cast("binary")))


def shingle_rows(texts: DataFrame, inverse: np.ndarray) -> DataFrame:
    """``node, code, w``: every shingle of every text with its weight."""
    shared = texts.sparkSession.sparkContext.broadcast(inverse)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        shingler, unpack_text = Shingler(), zstandard.ZstdDecompressor()
        for batch in batches:
            raw = batch.column(1)
            for at in range(0, batch.num_rows, AT_A_TIME):
                codes, counts, starts = shingler([unpack_text.decompress(x) for x in raw.slice(at, AT_A_TIME).to_pylist()])
                node = np.repeat(batch.column(0).slice(at, AT_A_TIME).to_numpy(), np.diff(starts))
                yield pa.RecordBatch.from_arrays([pa.array(node), pa.array(codes.astype(np.int64)), pa.array(counts * shared.value[bucket_of(codes)])], ["node", "code", "w"])

    return texts.select("node", "packed").mapInArrow(run, "node long, code long, w double")


def rare_meetings(apart: DataFrame, texts: DataFrame, inverse: np.ndarray, similarity: float) -> DataFrame:
    """``a, b``: texts of one bucket and different classes that may be similar, most pairs once and some a few times.

    Shingles that only one of the texts holds can't be shared. The others are
    sorted by the number of texts that hold them. Similar texts share at least
    ``similarity`` of either's weight; so their first common shingle has at
    least that much behind it in both, and it is enough to let texts meet by
    the shingles in front of that point. Two texts that share many of these meet
    where they share none of the LOOKED_BACK rarer ones of either: always at
    the first, and seldom again.
    """
    own = settle(apart.select("node", "weight", "class_id", "bands").dropDuplicates(["node"]), "own")
    rows = settle(shingle_rows(attach(texts, own.select("node"), ["node"], "left_semi", settled=True), inverse), "shingles")
    holders = rows.groupBy("code").agg(F.count(F.lit(1)).alias("n")).where("n > 1")
    held = rows.join(holders, "code").join(own.select("node", "weight"), "node")
    behind = Window.partitionBy("node").orderBy(F.desc("n"), F.desc("code")).rowsBetween(Window.unboundedPreceding, 0)
    front = held.withColumn("behind", F.sum("w").over(behind)).where(F.col("behind") >= (similarity - 1e-9) * F.col("weight"))
    # The rarest first, in the same order for all texts.
    lists = front.groupBy("node").agg(F.sort_array(F.collect_list(F.struct("n", "code", F.col("behind").alias("rest")))).alias("front"))
    lists = settle(lists.join(own, "node"), "fronts")
    # A row of each shingle takes nothing along that grows with the number of them.
    rarer = F.slice(F.col("front.code"), F.greatest(F.lit(1), F.col("_place") - (LOOKED_BACK - 1)), F.least(F.col("_place"), F.lit(LOOKED_BACK)))
    each = lists.select(F.posexplode("front").alias("_place", "_at"), "*").select("_at.code", "_at.rest", rarer.alias("rarer"), "node", "weight", "class_id", "bands")
    other = each.select("code", *[F.col(c).alias(f"o_{c}") for c in each.columns if c != "code"])
    same_bucket = F.exists(F.zip_with("bands", "o_bands", lambda x, y: x == y), lambda x: x)
    # All that two texts share lies at or behind their first common shingle, and it must be this much.
    # Behind a later one lies less, so a pair may pass at several shingles, but passes at the first if at any.
    enough = F.least("rest", "o_rest") >= (similarity / (1 + similarity) - 1e-9) * (F.col("weight") + F.col("o_weight"))
    new = ~F.arrays_overlap("rarer", "o_rarer")
    met = each.join(other, "code").where((F.col("node") > F.col("o_node")) & (F.col("class_id") != F.col("o_class_id")) & enough & new & same_bucket)
    return met.select(F.col("node").alias("a"), F.col("o_node").alias("b"))


def _apart(placed: DataFrame, classes: DataFrame | None) -> DataFrame:
    """``node, band, class_id`` of the buckets whose texts are of more than one class."""
    if classes is None:
        named = placed.withColumn("class_id", F.col("node"))
    else:
        named = placed.join(classes, "node", "left").withColumn("class_id", F.coalesce("class_id", "node"))
    split = named.groupBy("band").agg(F.min("class_id").alias("low"), F.max("class_id").alias("high"), F.count(F.lit(1)).alias("n")).where("low < high")
    return settle(named.join(split.select("band", "low", "n"), "band"), "apart")


def _bounded(apart: DataFrame, texts: DataFrame, inverse: np.ndarray, similarity: float) -> DataFrame:
    """``apart`` with ``shared``, the weight that other texts in question hold too, without texts that share too little to be similar to any."""
    # What no other text in question holds can't be shared with any of them.
    left = apart.select("node").distinct()
    parts = max(64, left.count() // 5_000)
    sums = shared_weights(attach(texts, left, ["node"], "left_semi"), inverse, parts)
    return settle(apart.join(sums, "node").where(F.col("shared") >= (similarity - 1e-9) * F.col("weight")), "bounded")


def _head_pairs(apart: DataFrame, similarity: float, round_: int) -> DataFrame:
    """``a, b``: texts of a bucket and its pivots, one in the first round and about PIVOTS others in each later one; there all of a bucket of up to PIVOTS."""
    seed = [F.lit(round_)] if round_ > 1 else []
    mark = F.pmod(F.xxhash64("node", "band", *seed), F.lit(1 << 30)) * F.col("n") < F.lit(PIVOTS * (1 << 30))
    if not round_:
        apart = apart.withColumn("shared", F.col("weight"))
    apart = apart.withColumn("leads", mark if round_ else F.col("node") == F.col("low"))
    heads = apart.where("leads").select("band", F.col("node").alias("b"), F.col("class_id").alias("other"), F.col("weight").alias("heavy"), F.col("shared").alias("most"), F.col("bands").alias("theirs"))
    # Weighted Jaccard is at most what may be shared over what then is in either text; the margin is for rounding.
    most = F.least("weight", "heavy", "shared", "most")
    near = most >= (similarity - 1e-9) * (F.col("weight") + F.col("heavy") - most)
    # Texts that meet in several buckets are compared in the first of them.
    first = F.array_position(F.zip_with("bands", "theirs", lambda x, y: x == y), True) == F.col("place") + 1
    met = apart.join(heads, "band").where((F.col("class_id") != F.col("other")) & near & first)
    # Of two heads the smaller stays one, so no pair comes twice and few texts have to be copied.
    swap = F.col("leads") & (F.col("b") > F.col("node"))
    return met.select(F.when(swap, F.col("b")).otherwise(F.col("node")).alias("a"), F.when(swap, F.col("node")).otherwise(F.col("b")).alias("b")).distinct()


def _left(apart: DataFrame) -> tuple[int, float]:
    """Of how many classes the texts are, and how many texts the bucket of a row has on average."""
    return tuple(apart.agg(F.count_distinct("class_id"), F.coalesce(F.avg("n"), F.lit(0.0))).first())


def _named(nodes: DataFrame, classes: DataFrame | None, links: DataFrame | None) -> DataFrame:
    """``text_hash, least_id, class_node, class_id, n_links`` of every different text."""
    if classes is None:
        known = nodes.withColumns({"class_node": F.col("node"), "n_links": F.lit(0).cast("long")})
    else:
        degree = links.select(F.explode(F.array("a", "b")).alias("node")).groupBy("node").agg(F.count(F.lit(1)).alias("n_links"))
        found = settle(classes.join(degree, "node").withColumnRenamed("class_id", "class_node"), "classes")
        known = nodes.join(found, "node", "left").withColumns({"class_node": F.coalesce("class_node", "node"), "n_links": F.coalesce("n_links", F.lit(0)).cast("long")})
    known = settle(known.select("text_hash", "least_id", "class_node", "n_links"), "known")
    names = settle(known.groupBy("class_node").agg(F.min("least_id").alias("name")), "names")
    shared = names.where("name is not null").groupBy("name").agg(F.count(F.lit(1)).alias("_n")).where("_n > 1")
    lowest = F.least(F.coalesce(nodes.agg(F.min("least_id")).scalar(), F.lit(0)), F.lit(0))
    own = F.col("name").isNotNull() & F.col("_n").isNull()
    names = attach(names, shared, ["name"]).select("class_node", F.when(own, F.col("name")).otherwise(F.coalesce(F.try_subtract(lowest, F.col("class_node") + 1), -1 - F.col("class_node"))).alias("class_id"))
    return settle(known.join(names, "class_node"), "named")


def _judge(docs: DataFrame, similarity: float) -> tuple[DataFrame, DataFrame]:
    """``doc_id, text_hash`` of every row, and what ``_named`` tells of every different text."""
    docs = docs.select("doc_id", "text")
    inverse = inverse_frequencies(*document_frequencies(docs))
    signed = settle(signatures(docs, inverse), "signatures")
    facts = [F.min("doc_id").alias("least_id"), F.first("weight").alias("weight"), *[F.first(F.get("bands", F.lit(i))).alias(f"b{i}") for i in range(BANDS)]]
    nodes = settle(signed.groupBy("text_hash").agg(*facts).withColumn("node", F.monotonically_increasing_id()), "nodes")
    bands = F.array(*[f"b{i}" for i in range(BANDS)])
    some = nodes.where("b0 is not null").select("node", "weight", bands.alias("bands"))
    banded = some.select("node", F.posexplode("bands").alias("place", "band"))
    # Buckets of one text are dropped before any join with texts; only what is left gets weights and all bands.
    full = banded.groupBy("band").agg(F.count(F.lit(1)).alias("n")).where("n > 1").select("band")
    placed = settle(settle(banded.join(full, "band"), "buckets").join(some, "node").select("band", "node", "weight", "bands", "place"), "placed")
    # A row of each text in question; more than one only where rows repeat id and text.
    one_id = F.coalesce("least_id", F.lit(0)).alias("_id")
    needed = nodes.join(placed.select("node").distinct(), "node").select(one_id, "text_hash", "node")
    rows = docs.select(F.coalesce("doc_id", F.lit(0)).alias("_id"), text_hash(F.col("text")).alias("text_hash"), "text")
    texts = settle(packed(attach(rows, needed, ["_id", "text_hash"], "inner").select("node", "text")).dropDuplicates(["node"]), "texts")
    links, tested, classes = None, None, None
    round_, last = 0, False
    while not last:
        apart = _apart(placed, classes)
        if round_ == 1:
            apart = _bounded(apart, texts, inverse, similarity)
            # Texts of smaller buckets are all compared now, and those left out can't be similar to any.
            large = apart.where(F.col("n") > PIVOTS)
            placed, (number, _) = large.select(*placed.columns, "shared"), _left(large)
        if round_ > 1:
            before, (number, size) = number, _left(apart)
            last = size <= LARGE or number >= STILL_JOINING * before
        pairs = rare_meetings(apart, texts, inverse, similarity).distinct() if last else _head_pairs(apart, similarity, round_)
        if tested is not None:
            known = tested.select(F.col("a").alias("x"), F.col("b").alias("y"))
            pairs = pairs.join(known, (F.greatest("a", "b") == F.col("x")) & (F.least("a", "b") == F.col("y")), "left_anti")
        pairs = settle(pairs, "candidates")
        if not pairs.isEmpty():
            judged = settle(verify(pairs, texts, inverse, similarity), "judged")
            found = judged.where("linked").select("a", "b")
            links = found if links is None else links.unionByName(found)
            done = judged.select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b"))
            tested = done if tested is None else tested.unionByName(done)
            classes = components(links)
        round_ += 1
    return signed.select("doc_id", "text_hash"), _named(nodes, classes, links)


def classes_of(docs: DataFrame, similarity: float = SIMILARITY) -> DataFrame:
    """``doc_id, class_id, n_links`` of every row; a class is named by its smallest doc_id.

    Texts are linked if they are equal or their weighted Jaccard similarity is
    ``similarity`` or more; classes are the connected texts. ``n_links`` counts
    the verified links of the row's text to different texts. Null and empty
    texts equal each other. Repeated rows come out as often as they come in. A
    null doc_id takes part; where a class has no other, or its smallest doc_id
    names another class too because rows repeat it with different texts, it is
    named by a number of its own, negative and, if there is room, below every doc_id.
    """
    rows, named = _judge(docs, similarity)
    return rows.join(named, "text_hash").select("doc_id", "class_id", "n_links")


def keep_one(docs: DataFrame, similarity: float = SIMILARITY) -> DataFrame:
    """One row of each class of ``docs``: that of the smallest doc_id, null being the greatest, and of the smallest MD5.

    Of rows that repeat both doc_id and text the first by all columns stays.
    """
    rows, named = _judge(docs, similarity)
    head = F.min(F.struct(F.col("least_id").isNull().alias("none"), "least_id", "text_hash"))
    heads = settle(named.groupBy("class_node").agg(head.alias("head")).select(F.col("head.least_id").alias("_head_id"), F.col("head.text_hash").alias("_head_hash")), "heads")
    # The texts needn't be sorted: the heads of a partition are small.
    kept = docs.join(heads.hint("shuffle_hash"), docs["doc_id"].eqNullSafe(heads["_head_id"]) & (text_hash(docs["text"]) == heads["_head_hash"]), "left_semi")
    again = rows.join(heads, rows["doc_id"].eqNullSafe(heads["_head_id"]) & (rows["text_hash"] == heads["_head_hash"]), "left_semi")
    again = settle(again.groupBy("doc_id", "text_hash").agg(F.count(F.lit(1)).alias("n")).where("n > 1"), "repeated")
    if again.isEmpty():
        return kept
    repeated = kept["doc_id"].eqNullSafe(again["doc_id"]) & (text_hash(kept["text"]) == again["text_hash"])
    sortable = [c for c in docs.columns if not isinstance(docs.schema[c].dataType, (MapType, VariantType))]
    order = Window.partitionBy(F.col("doc_id"), text_hash(F.col("text"))).orderBy(*sortable)
    several = kept.join(again, repeated, "left_semi").select(F.struct("*").alias("_row"), F.row_number().over(order).alias("_turn"))
    return kept.join(again, repeated, "left_anti").unionByName(several.where("_turn = 1").select("_row.*"))

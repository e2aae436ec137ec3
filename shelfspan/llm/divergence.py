"""How far the sources of a language lie apart in their use of terms.

A term is a run of ASCII letters and characters beyond ASCII, with ASCII
capitals lowered, so terms are found on bytes. Terms go to buckets by their
length: up to 8 bytes they are one 64-bit word, up to 16 bytes two, both sorted
by radix, 16 bits at a time; longer terms are sorted as bytes, one bucket for
each length. Equal terms then are runs, which are counted per group (language
and source). A task keeps its counts until there are HELD of them.

Distances between sources are summed in blocks of terms, each with the shares
of all sources of its language as a matrix of bounded size.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from shelfspan.llm.blobs import groups
from shelfspan.llm.neighbours import whole_groups
from shelfspan.llm.text import flat, slices, strings
from shelfspan.operators.joins import attach
from shelfspan.session import settle

#: Documents of a language that a kept term occurs in; added to every count; scale of the shares; ranks of terms.
LEAST_DOCS, PRIOR, SCALE, TOP = 30, 5, 1_000_000_000, 50
SLICE, HELD = 4_000_000, 1_000_000
#: Cells of a block's matrix, and terms of a block.
CELLS, BLOCK_TERMS = 1_000_000, 512
COUNTS = "lang string, source string, term string, n long, docs long"
_bytes = np.arange(256)
INSIDE = (_bytes >= 0x80) | ((_bytes >= 0x41) & (_bytes <= 0x5A)) | ((_bytes >= 0x61) & (_bytes <= 0x7A))
LOWER = np.where((_bytes >= 0x41) & (_bytes <= 0x5A), _bytes + 32, _bytes).astype(np.uint8)


def spans(raw: np.ndarray, starts: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Begin, length and document of every term; documents lie one after another in ``raw``."""
    inside = INSIDE[raw]
    cut = np.zeros(len(raw) + 1, bool)
    cut[starts] = True
    begins, ends = inside.copy(), inside.copy()
    begins[1:] &= ~inside[:-1] | cut[1:-1]
    ends[:-1] &= ~inside[1:] | cut[1:-1]
    first = np.flatnonzero(begins)
    return first, np.flatnonzero(ends) + 1 - first, np.searchsorted(starts, first, "right") - 1


def radix_order(words: list[np.ndarray], order: np.ndarray) -> np.ndarray:
    """``order`` sorted stably by words, the first being the most significant; 16 bits at a time."""
    for word in reversed(words):
        for shift in (0, 16, 32, 48):
            digits = ((word[order] >> np.uint64(shift)) & np.uint64(0xFFFF)).astype(np.uint16)
            if len(digits) and (digits != digits[0]).any():
                order = order[np.argsort(digits, kind="stable")]
    return order


def pack(padded: np.ndarray, first: np.ndarray, lengths: np.ndarray, words: int) -> list[np.ndarray]:
    """Terms of at most 8 * words bytes as big-endian words, filled up with zeros, which no term holds."""
    at = np.ndarray(len(padded) - 7, ">u8", padded.tobytes(), strides=(1,))
    out = []
    for k in range(words):
        left = np.clip(lengths - 8 * k, 0, 8)
        unused = ((8 - left) * 8).astype(np.uint64)
        word = at[np.where(left > 0, first + 8 * k, 0)].astype(np.uint64)
        half = unused // np.uint64(2)  # a shift by 64 in one step is undefined
        rest = unused - half
        out.append(word >> half >> rest << rest << half)
    return out


class Held:
    """Counts per group of the terms of one length bucket."""

    def __init__(self, words: int):
        self.words, self.parts, self.size = words, [], 0

    def add(self, words: list[np.ndarray], of: np.ndarray, n: np.ndarray, docs: np.ndarray) -> None:
        self.parts.append((*words, of, n, docs))
        self.size += len(of)

    def combine(self) -> tuple[np.ndarray, ...]:
        *words, of, n, docs = map(np.concatenate, zip(*self.parts, strict=True))
        order = radix_order(words, np.argsort(of, kind="stable"))
        words, of = [w[order] for w in words], of[order]
        new = np.zeros(len(of), bool)
        new[:1] = True
        for column in (*words, of):
            new[1:] |= column[1:] != column[:-1]
        at = np.flatnonzero(new)
        done = (*[w[at] for w in words], of[at], np.add.reduceat(n[order], at), np.add.reduceat(docs[order], at))
        self.parts, self.size = [done], len(at)
        return done

    def take(self) -> tuple[pa.Array, np.ndarray, np.ndarray, np.ndarray]:
        *words, of, n, docs = self.combine()
        self.parts, self.size = [], 0
        chars = np.stack(words, 1).astype(">u8").view(np.uint8).reshape(len(of), -1)
        used = chars != 0
        ends = np.concatenate([[0], np.cumsum(used.sum(1))]).astype(np.int32)
        terms = pa.StringArray.from_buffers(len(of), pa.py_buffer(ends.tobytes()), pa.py_buffer(chars[used].tobytes()))
        return terms, of, n, docs


def count_batches(batches: Iterator[pa.RecordBatch], held: int = HELD, limit: int = SLICE) -> Iterator[pa.RecordBatch]:
    """Partial counts of batches ``text, lang, source``."""
    codes: dict[tuple[str, str], int] = {}
    packed = {1: Held(1), 2: Held(2)}
    long: dict[tuple[int, bytes], list[int]] = {}
    weight = 0

    def out(terms: pa.Array, of: np.ndarray, n: np.ndarray, docs: np.ndarray) -> pa.RecordBatch:
        names = list(codes)
        at = pa.array(of)
        both = [pa.array([name[i] for name in names], pa.string()).take(at) for i in (0, 1)]
        return pa.RecordBatch.from_arrays([*both, terms, pa.array(n, pa.int64()), pa.array(docs, pa.int64())], ["lang", "source", "term", "n", "docs"])

    def out_long() -> pa.RecordBatch:
        of, terms = zip(*long, strict=True)
        n, docs = zip(*long.values(), strict=True)
        batch = out(pa.array([t.decode() for t in terms], pa.string()), np.array(of), np.array(n), np.array(docs))
        long.clear()
        return batch

    for batch in slices(batches, limit=limit):
        raw, starts = flat(batch.column(0))
        pairs = zip(strings(batch, "lang"), strings(batch, "source"), strict=True)
        group = np.fromiter((codes.setdefault(p, len(codes)) for p in pairs), np.int64, batch.num_rows)
        first, lengths, doc = spans(raw, starts)
        padded = np.concatenate([LOWER[raw], np.zeros(16, np.uint8)])
        # Terms in the order of groups, inside them of documents; all sorts behind keep it.
        order = np.argsort(group[doc], kind="stable")
        first, lengths, doc = first[order], lengths[order], doc[order]
        for words, low, high in ((1, 1, 8), (2, 9, 16)):
            some = (lengths >= low) & (lengths <= high)
            if not some.any():
                continue
            keys = pack(padded, first[some], lengths[some], words)
            at = radix_order(keys, np.arange(int(some.sum())))
            keys, docs = [k[at] for k in keys], doc[some][at]
            of = group[docs]
            runs = np.zeros(len(at), bool)
            runs[:1] = True
            for column in (*keys, of):
                runs[1:] |= column[1:] != column[:-1]
            new_doc = runs.copy()
            new_doc[1:] |= docs[1:] != docs[:-1]
            begin = np.flatnonzero(runs)
            packed[words].add([k[begin] for k in keys], of[begin], np.diff(np.append(begin, len(at))), np.add.reduceat(new_doc.astype(np.int64), begin))
            if packed[words].size > held:
                packed[words].combine()
                if packed[words].size > held // 2:
                    yield out(*packed[words].take())
        for length in np.unique(lengths[lengths > 16]):
            some = lengths == length
            chars = padded[first[some][:, None] + np.arange(length)].view(f"S{length}").ravel()
            at = np.argsort(chars, kind="stable")
            chars, docs = chars[at], doc[some][at]
            of = group[docs]
            runs = np.r_[True, (chars[1:] != chars[:-1]) | (of[1:] != of[:-1])]
            new_doc = runs | np.r_[True, docs[1:] != docs[:-1]]
            begin = np.flatnonzero(runs)
            counts, in_docs = np.diff(np.append(begin, len(at))), np.add.reduceat(new_doc.astype(np.int64), begin)
            for key, n, d in zip(zip(of[begin].tolist(), chars[begin].tolist(), strict=True), counts.tolist(), in_docs.tolist(), strict=True):
                if entry := long.get(key):
                    entry[0] += n
                    entry[1] += d
                else:
                    long[key] = [n, d]
                    weight += int(length) + 200
        if weight > 64 * held:
            yield out_long()
            weight = 0
    for bucket in packed.values():
        if bucket.size:
            yield out(*bucket.take())
    if long:
        yield out_long()


def term_counts(docs: DataFrame) -> DataFrame:
    """``lang, source, term, n, docs``: occurrences, and documents with at least one."""
    whole = docs.select("text", "lang", "source")
    found = whole.mapInArrow(lambda batches: count_batches(batches), COUNTS)
    return found.groupBy("lang", "source", "term").agg(F.sum("n").alias("n"), F.sum("docs").alias("docs"))


def share(n: Column, total: Column, v: Column) -> Column:
    """1 + floor(SCALE * (n + PRIOR) / (total + PRIOR * v)), exact for any counts."""
    wide = lambda c: c.cast("decimal(20,0)")
    above = F.lit(SCALE).cast("decimal(10,0)") * wide(n + PRIOR)
    return F.call_function("div", above, wide(total + PRIOR * v)) + 1


def distances(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Partial sums ``lang, a, b, value`` of blocks ``key, lang, block, term, source, p``; rows without a term name the sources."""
    for t in whole_groups(batches):
        t = t.combine_chunks()
        lang, block = t["lang"].to_pylist(), t["block"].to_numpy()
        key = np.array([hash((a, b)) for a, b in zip(lang, block.tolist(), strict=True)])
        cuts = [*groups(key).tolist(), len(key)]
        for low, high in zip(cuts, cuts[1:], strict=False):
            part = t.slice(low, high - low)
            n = part["term"].null_count
            names = part["source"].slice(0, n).to_pylist()
            p = part["p"].to_numpy()
            term = part["term"].slice(n).combine_chunks().dictionary_encode()
            if isinstance(term, pa.ChunkedArray):
                term = term.combine_chunks()
            row = term.indices.to_numpy(zero_copy_only=False) if len(term) else np.zeros(0, np.int64)
            place = {name: i for i, name in enumerate(names)}
            column = np.fromiter((place[s] for s in part["source"].slice(n).to_pylist()), np.int64, len(row))
            shares = np.repeat(p[:n, None], int(row.max()) + 1 if len(row) else 0, 1)
            shares[column, row] = p[n:]
            for i in range(n - 1):
                value = np.abs(shares[i + 1 :] - shares[i]).sum(1)
                yield pa.RecordBatch.from_arrays(
                    [pa.array([lang[low]] * len(value), pa.string()), pa.array([names[i]] * len(value), pa.string()), pa.array(names[i + 1 :], pa.string()), pa.array(value, pa.int64())],
                    ["lang", "a", "b", "value"],
                )


def audit(docs: DataFrame, least_docs: int = LEAST_DOCS, top: int = TOP) -> DataFrame:
    """``lang, source, part, item, value, rank``.

    Part ``pair``: the distance of a source to each other source of its
    language; part ``term``: the terms that a source has more of than its
    language, up to rank ``top``. Null text, language and source are the empty
    string; rows that repeat count each. A language without kept terms gives
    pairs of value 0; an empty table gives no rows. Ties go by item.
    """
    empty = F.lit("")
    docs = docs.select(*[F.coalesce(c, empty).alias(c) for c in ("text", "lang", "source")])
    counts = settle(term_counts(docs), "term_counts")
    per_term = counts.groupBy("lang", "term").agg(F.sum("docs").alias("docs"), F.sum("n").alias("lang_n"))
    kept = settle(per_term.where(F.col("docs") >= least_docs).drop("docs"), "kept_terms")
    found = settle(counts.join(kept, ["lang", "term"]).select("lang", "source", "term", "n", "lang_n"), "kept_counts")
    languages = kept.groupBy("lang").agg(F.count(F.lit(1)).alias("v"), F.sum("lang_n").alias("lang_total"))
    totals = found.groupBy("lang", "source").agg(F.sum("n").alias("total"))
    sources = docs.select("lang", "source").distinct().join(totals, ["lang", "source"], "left").join(languages, "lang", "left")
    zero = {c: F.coalesce(c, F.lit(0)) for c in ("total", "v", "lang_total")}
    size = Window.partitionBy("lang")
    sources = sources.withColumns(zero).withColumn("n_sources", F.count(F.lit(1)).over(size))
    by_cells = F.ceil(F.col("v") * F.col("n_sources") / CELLS)
    sources = sources.withColumn("blocks", F.greatest(by_cells, F.ceil(F.col("v") / BLOCK_TERMS), F.lit(1)).cast("long"))
    sources = settle(sources, "sources")
    placed = attach(found, sources, ["lang", "source"], "inner", spread_by=["term"], settled=True)
    shares = settle(placed.withColumn("p", share(F.col("n"), F.col("total"), F.col("v"))), "shares")

    q = share(F.col("lang_n"), F.col("lang_total"), F.col("v"))
    over = shares.withColumn("value", F.col("p") - q).where("value > 0")
    own = Window.partitionBy("lang", "source").orderBy(F.desc("value"), "term")
    terms = over.withColumn("rank", F.row_number().over(own)).where(F.col("rank") <= top)
    terms = terms.select("lang", "source", F.lit("term").alias("part"), F.col("term").alias("item"), "value", "rank")

    none = F.when(F.col("v") > 0, share(F.lit(0), F.col("total"), F.greatest("v", F.lit(1)))).otherwise(0)
    named = sources.select("lang", F.explode(F.sequence(F.lit(0).cast("long"), F.col("blocks") - 1)).alias("block"), F.lit(None).cast("string").alias("term"), "source", none.cast("long").alias("p"))
    block = F.pmod(F.xxhash64("term"), F.col("blocks"))
    rows = named.unionByName(shares.select("lang", block.alias("block"), "term", "source", F.col("p").cast("long").alias("p")))
    rows = rows.select(F.xxhash64("lang", "block").alias("key"), "lang", "block", "term", "source", "p")
    dealt = rows.repartition("key").sortWithinPartitions("key", "lang", "block", F.col("term").asc_nulls_first(), "source")
    sums = dealt.mapInArrow(distances, "lang string, a string, b string, value long").groupBy("lang", "a", "b").agg(F.sum("value").alias("value"))
    sides = F.explode(F.array(F.struct(F.col("a").alias("source"), F.col("b").alias("item")), F.struct(F.col("b").alias("source"), F.col("a").alias("item"))))
    pairs = sums.select("lang", sides.alias("side"), "value").select("lang", "side.source", F.lit("pair").alias("part"), "side.item", "value")
    pairs = pairs.withColumn("rank", F.row_number().over(Window.partitionBy("lang", "source").orderBy(F.desc("value"), "item")))
    return pairs.unionByName(terms.withColumn("value", F.col("value").cast("long")))

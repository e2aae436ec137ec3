"""Document fingerprints: bottom-k sketches of hashed word shingles.

A shingle is five words in a row (a shorter text with words is one shingle), a
hash is the first 16 hexadecimal digits of its MD5. A sketch holds the K least
different hashes of a text in rising order, so sketches of parts merge into the
sketch of the whole: the K least of their union. Below the smaller of the last
hashes of two full sketches both hold all their hashes, which is a sample of
the union: its share in both estimates the resemblance, its share of one the
containment. A sketch that isn't full holds all hashes, and all figures are
exact. DataFrame functions only.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

SHINGLE = 5
K = 128
#: Rows of a slice of the order by doc_id, as long as there are at most SLICE_BITS bits of slices; sampled rows of a slice.
SLICE_ROWS, SLICE_BITS, SAMPLED = 256, 17, 8
#: Bytes of text that a task gets.
TASK_BYTES = 32_000_000
# What separates words.
SPACES = " \t\n\x0b\x0c\r"


def words_of(text: Column) -> Column:
    """Words of a text; null has none."""
    bare = F.btrim(F.coalesce(text, F.lit("")), F.lit(SPACES))
    return F.when(F.length(bare) == 0, F.array().cast("array<string>")).otherwise(F.split(bare, r"[\x20\x09-\x0D]+"))


def hashes_of(words: str) -> Column:
    """Hashes of all shingles of the named column of words, in order, repeats included."""

    def one(i: Column) -> Column:
        return F.substring(F.md5(F.concat_ws(" ", *[F.get(F.col(words), i + j) for j in range(SHINGLE)])), 1, 16)

    starts = F.sequence(F.lit(0), F.greatest(F.size(words) - SHINGLE, F.lit(0)))
    return F.when(F.size(words) == 0, F.array().cast("array<string>")).otherwise(F.transform(starts, one))


def sketch_of(hashes: Column, k: int = K) -> Column:
    return F.slice(F.sort_array(F.array_distinct(hashes)), 1, k)


def add_sketch(docs: DataFrame, text: str, name: str, k: int = K) -> DataFrame:
    """Add the sketch of a text column; ``_words`` must not be a column of ``docs``."""
    return docs.withColumn("_words", words_of(F.col(text))).withColumn(name, sketch_of(hashes_of("_words"), k)).drop("_words")


def _known(a: Column, b: Column, k: int) -> Column:
    """The greatest hash below which both sketches hold all hashes; no hash is greater than a letter g."""
    return F.least(*[F.when(F.size(s) >= k, F.element_at(s, -1)).otherwise(F.lit("g")) for s in (a, b)])


def resemblance(a: Column, b: Column, k: int = K) -> Column:
    """Estimated Jaccard similarity of the shingles of two sketches; 1 if neither has any."""
    known = _known(a, b, k)
    both = F.size(F.filter(F.array_intersect(a, b), lambda x: x <= known))
    either = F.size(F.filter(F.array_union(a, b), lambda x: x <= known))
    return F.when(either == 0, F.lit(1.0)).otherwise(both / either)


def containment(a: Column, b: Column, k: int = K) -> Column:
    """Estimated share of the shingles of ``a`` that ``b`` has too; 1 if ``a`` has none."""
    known = _known(a, b, k)
    both = F.size(F.filter(F.array_intersect(a, b), lambda x: x <= known))
    own = F.size(F.filter(a, lambda x: x <= known))
    return F.when(own == 0, F.lit(1.0)).otherwise(both / own)


def distinct_count(sketch: Column, k: int = K) -> Column:
    """Estimated number of different shingles; exact for a sketch that isn't full."""
    last = F.conv(F.substring(F.element_at(sketch, -1), 1, 13), 16, 10).cast("double") / float(1 << 52)
    return F.when(F.size(sketch) < k, F.size(sketch).cast("double")).otherwise((k - 1) / last)


def merge(sketches: DataFrame, by: Sequence[str], column: str = "sketch", k: int = K) -> DataFrame:
    """``(*by, sketch)``: one sketch for each group of rows, null being a group, from any number of sketches.

    Hashes are made unique by (group, hash) and cut to the k least of a group in
    every task before they meet, so a group of a third of all rows costs no more.
    Groups without any hash have an empty sketch.
    """
    by = list(by)
    every = sketches.select(*by).distinct()
    hashes = sketches.select(*by, F.explode(column).alias("_hash")).groupBy(*by, "_hash").agg(F.lit(1).alias("_one"))
    least = hashes.withColumn("_place", F.row_number().over(Window.partitionBy(*by).orderBy("_hash"))).where(F.col("_place") <= k)
    merged = least.groupBy(*by).agg(F.sort_array(F.collect_list("_hash")).alias("sketch"))
    matched = [F.col(f"e.{c}").eqNullSafe(F.col(f"m.{c}")) for c in by]
    joined = every.alias("e").join(merged.alias("m"), matched, "left")
    return joined.select(*[F.col(f"e.{c}") for c in by], F.coalesce("m.sketch", F.array().cast("array<string>")).alias("sketch"))


def _cuts(values: Sequence[int]) -> Column:
    """A constant array, folded by the optimizer."""
    return F.split(F.lit(",".join(map(str, values))), ",").cast("array<bigint>") if len(values) else F.array().cast("array<bigint>")


def with_next(docs: DataFrame, columns: Sequence[str], prepare) -> DataFrame:
    """Rows ``doc_id, text`` with columns that ``prepare`` adds, and ``next_<column>`` of the next row by doc_id.

    The order is cut into slices at sampled keys; a slice also gets the first
    row of the one behind it, and the last slice the first row of all. So the
    texts are exchanged once. Equal doc_ids go by the hash of their text; null
    ids come last.
    """
    key = {"_id": F.coalesce("doc_id", F.lit((1 << 63) - 1)), "_hash": F.xxhash64("text")}
    keyed = docs.select("doc_id", F.coalesce("text", F.lit("")).alias("text")).withColumns(key)
    facts = keyed.agg(F.count(F.lit(1)).alias("n"), F.sum(F.octet_length("text")).alias("bytes"), F.min(F.struct("_id", "_hash")).alias("first")).first()
    rows = max(SLICE_ROWS, -(-facts["n"] // (1 << SLICE_BITS)))
    picked = F.pmod(F.xxhash64("_id", "_hash"), F.lit(max(1, rows // SAMPLED))) == 0
    sampled = sorted({tuple(r) for r in keyed.where(picked).select("_id", "_hash").toPandas().itertuples(index=False)}) if facts["n"] > rows else []
    cuts = sampled[SAMPLED - 1 :: SAMPLED]
    ids, hashes = _cuts([c[0] for c in cuts]), _cuts([c[1] for c in cuts])

    def behind(at: Column) -> Column:
        return (F.get(ids, at) < F.col("_id")) | ((F.get(ids, at) == F.col("_id")) & (F.get(hashes, at) <= F.col("_hash")))

    # Binary search: the number of cuts at or below the key.
    steps = F.array(*[F.lit(1 << b) for b in reversed(range(max(1, len(cuts).bit_length())))])
    place = F.aggregate(steps, F.lit(0), lambda low, step: F.when(behind(low + step - 1), low + step).otherwise(low))
    opens = (F.get(ids, F.col("_slice") - 1) == F.col("_id")) & (F.get(hashes, F.col("_slice") - 1) == F.col("_hash"))
    first = facts["first"] or (0, 0)
    is_first = (F.col("_id") == F.lit(first[0])) & (F.col("_hash") == F.lit(first[1]))

    def copy(where: Column, slice_: Column, last: bool, own: bool) -> Column:
        return F.when(where, F.struct(slice_.cast("int").alias("slice"), F.lit(last).alias("last"), F.lit(own).alias("own")))

    copies = F.array(
        copy(F.lit(True), F.col("_slice"), False, True),
        copy(F.coalesce(opens, F.lit(False)), F.col("_slice") - 1, False, False),
        copy(is_first, F.lit(len(cuts)), True, False),
    )
    dealt = keyed.withColumn("_slice", place).withColumn("_copy", F.explode(F.filter(copies, lambda c: c.isNotNull())))
    tasks = max(8, -(-(facts["bytes"] or 0) // TASK_BYTES))
    placed = dealt.select("doc_id", "text", "_id", "_hash", "_copy.*").repartition(tasks, "slice")
    order = Window.partitionBy("slice").orderBy("last", "_id", "_hash", F.col("doc_id").isNull(), "text")
    led = prepare(placed).withColumns({f"next_{c}": F.lead(c).over(order) for c in columns})
    return led.where("own").drop("_id", "_hash", "slice", "last", "own")


def fingerprints(docs: DataFrame, k: int = K) -> DataFrame:
    """``doc_id, n_chars, edited, sketch, edited_sketch, near_edited, near_next`` of every row.

    The edited text has its last quarter replaced by as much of the beginning
    of the next document. Null texts are empty; a text without words has an
    empty sketch, which resembles another empty one by 1 and others by 0. The
    next of the last document is the first, of a single one itself; repeated
    rows follow each other, each a document.
    """
    led = with_next(docs, ["text", "sketch"], lambda d: add_sketch(d, "text", "sketch", k))
    n = F.char_length("text").cast("long")
    quarter = F.floor(F.col("n_chars") / 4).cast("int")
    kept = F.substring(F.col("text"), F.lit(1), F.col("n_chars").cast("int") - quarter)
    edited = F.concat(kept, F.substring(F.col("next_text"), F.lit(1), quarter))
    changed = led.withColumn("n_chars", n).select("doc_id", "n_chars", edited.alias("edited"), "sketch", "next_sketch")
    both = add_sketch(changed, "edited", "edited_sketch", k)
    return both.select(
        "doc_id", "n_chars", "edited", "sketch", "edited_sketch",
        resemblance(F.col("sketch"), F.col("edited_sketch"), k).alias("near_edited"),
        resemblance(F.col("sketch"), F.col("next_sketch"), k).alias("near_next"),
    )


def digests(docs: DataFrame, k: int = K) -> DataFrame:
    """The result of ``fingerprints`` with the edited text as its SHA-256 and sketches as strings."""
    return fingerprints(docs, k).select(
        "doc_id", "n_chars", F.sha2("edited", 256).alias("edited_sha256"),
        F.array_join("sketch", "").alias("fingerprint"), F.array_join("edited_sketch", "").alias("edited_fingerprint"),
        "near_edited", "near_next", distinct_count(F.col("sketch"), k).alias("n_shingles"),
        containment(F.col("sketch"), F.col("edited_sketch"), k).alias("contained_in_edited"),
    )

"""Mixing sources to target weights by weighted sampling without replacement.

Sources weigh 5, 2, 1 in turn and share the budget; a source takes at most
``most`` times its size, and the excess goes to the others by weight. The water
level that solves this is found exactly from sorted prefix sums. A source is
read in whole epochs first. For the rest its documents are ordered by
exponential keys scaled by their quality weight, and taken while the middle of
the next one lies within the budget. DataFrame functions only.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from shelfspan.llm.text import WORD
from shelfspan.operators.ordering import running_totals
from shelfspan.session import settle

WEIGHTS = (5, 2, 1)
MOST = 3
#: Rows that a range of keys within one source holds on average.
ROWS_PER_RANGE = 4_000


def size_of(text: Column) -> Column:
    """Words of a text; null has none."""
    return F.coalesce(F.regexp_count(text, F.lit(WORD)), F.lit(0)).cast("long")


def uniform(*columns: str) -> Column:
    """A number strictly between 0 and 1 that depends on the values alone: 52 bits of their MD5."""
    text = F.concat_ws("|", *[F.coalesce(F.col(c).cast("string"), F.lit("")) for c in columns])
    return (F.conv(F.substring(F.md5(text.cast("binary")), 1, 13), 16, 10).cast("long") + 0.5) / F.lit(float(1 << 52))


def targets(sizes: DataFrame, weights: Sequence[int] = WEIGHTS, most: int = MOST) -> DataFrame:
    """Add ``target`` to one row per source ``(source, source_size, ...)``.

    Sorted by most * size / weight, sources reach their cap one after another.
    With the first k at their cap the level is (total - caps) / (weights left);
    the level that holds is the first that does not exceed the next source's ratio.
    """
    ranked = running_totals(sizes.withColumns({"one": F.lit(1).cast("long"), "_null": F.col("source").isNull().cast("int"), "_name": F.coalesce("source", F.lit(""))}), ["_null", "_name"], ["one"])
    turn = F.pmod(F.col("one_before"), F.lit(len(weights))).cast("int")
    weighed = ranked.drop("one").withColumn("weight", F.get(F.array(*[F.lit(int(w)) for w in weights]), turn).cast("long"))
    weighed = weighed.withColumns({"cap": F.col("source_size") * most, "ratio": F.col("source_size") * most / F.col("weight")})
    summed = settle(running_totals(weighed.withColumnRenamed("one_before", "_place"), ["ratio", "_place"], ["cap", "weight"]), "caps")
    total = summed.agg(F.sum("source_size").alias("size"), F.sum("weight").alias("weight")).first()
    if total["size"] is None:
        return sizes.withColumn("target", F.lit(0.0))
    level = (F.lit(total["size"]) - F.col("cap_before")) / (F.lit(total["weight"]) - F.col("weight_before"))
    found = summed.where(level <= F.col("ratio")).agg(F.min_by(level, F.struct("ratio", "_place")).alias("level")).first()["level"]
    return summed.select(*sizes.columns, F.least(F.col("cap").cast("double"), F.lit(found or 0.0) * F.col("weight")).alias("target"))


def mix(docs: DataFrame, quality: DataFrame, weights: Sequence[int] = WEIGHTS, most: int = MOST, seed: int = 0) -> DataFrame:
    """``doc_id, source, size, source_size, target, copies, taken`` of every row.

    ``quality`` holds ``doc_id, weight`` (1 where a document has none). Documents
    without words have size 0 and are never taken; sources of such documents have
    target 0. A null source is a source of its own, the last. Equal keys go by
    doc_id, size and the MD5 of the text (``tie``), which also gives the key of
    a document without id; rows equal in all share a key and are taken one after
    the other.
    """
    sized = docs.select("doc_id", "source", size_of(F.col("text")).alias("size"), F.md5(F.coalesce("text", F.lit("")).cast("binary")).alias("tie"))
    heavy = quality.groupBy("doc_id").agg(F.max("weight").alias("weight"))
    joined = sized.join(heavy, "doc_id", "left")
    joined = joined.withColumns({"_seed": F.lit(seed), "_name": F.coalesce(F.col("doc_id").cast("string"), "tie")})
    key = -F.ln(uniform("_name", "_seed")) / F.coalesce("weight", F.lit(1.0))
    rows = settle(joined.select("doc_id", "source", "size", "tie", key.alias("key")), "sizes")
    # Before the sum over a source, sums over many ranges of its keys.
    count = rows.count()
    ranges = max(8, -(-count // ROWS_PER_RANGE))
    # Keys of weight 1 are exponential; this spreads them evenly over the ranges.
    place = F.least(F.floor((1 - F.exp(-F.col("key"))) * ranges), F.lit(ranges - 1)).cast("int")
    rows = rows.withColumns({"_range": place, "_null": F.col("source").isNull(), "_name": F.coalesce("source", F.lit(""))})
    part = ["_null", "_name"]
    per_range = rows.groupBy("source", *part, "_range").agg(F.sum("size").alias("range_size"))
    per_range = settle(per_range, "ranges")
    sizes = targets(per_range.groupBy("source").agg(F.sum("range_size").alias("source_size")), weights, most)
    sizes = settle(sizes, "targets").withColumns({"_null": F.col("source").isNull(), "_name": F.coalesce("source", F.lit(""))}).drop("source")
    # A source has at most ``ranges`` rows here.
    earlier = Window.partitionBy(*part).orderBy("_range").rowsBetween(Window.unboundedPreceding, -1)
    offsets = per_range.drop("source").withColumn("range_before", F.coalesce(F.sum("range_size").over(earlier), F.lit(0)))
    offsets = offsets.join(sizes, part).drop("range_size")
    placed = rows.join(offsets, [*part, "_range"])
    inside = Window.partitionBy(*part, "_range").orderBy("key", "doc_id", "size", "tie").rowsBetween(Window.unboundedPreceding, 0)
    before = F.col("range_before") + F.sum("size").over(inside) - F.col("size")
    epochs = F.when(F.col("source_size") > 0, F.floor(F.col("target") / F.col("source_size"))).otherwise(0)
    placed = placed.withColumns({"_before": before, "_epochs": epochs})
    rest = F.col("target") - F.col("_epochs") * F.col("source_size")
    taken_too = (F.col("size") > 0) & (2 * F.col("_before") + F.col("size") <= 2 * rest)
    copies = F.when(F.col("size") > 0, F.col("_epochs") + taken_too.cast("long")).otherwise(0).cast("long")
    return placed.withColumn("copies", copies).select(
        "doc_id", "source", "size", "source_size", "target", "copies", (F.col("copies") * F.col("size")).alias("taken"), "tie"
    )


def quality_weights(labels: DataFrame) -> DataFrame:
    """``doc_id, weight``: good documents weigh 2, bad ones a half."""
    return labels.select("doc_id", F.when(F.col("quality") == 1, 2.0).when(F.col("quality") == 0, 0.5).otherwise(1.0).alias("weight"))


def draw(docs: DataFrame, quality: DataFrame, weights: Sequence[int] = WEIGHTS, most: int = MOST, seed: int = 0) -> DataFrame:
    """``docs`` with every row as often as the mix takes it; rows it takes none of go.

    Rows equal in doc_id, source and text share what the mix takes of them:
    each comes as often as the mix takes it on average, rounded by its turn.
    Columns of any name may come along.
    """
    counts = mix(docs, quality, weights, most, seed).groupBy("doc_id", "source", "tie").agg(F.sum("copies").alias("copies"), F.count(F.lit(1)).alias("rows"))
    counts = settle(counts.where("copies > 0"), "copies")
    tie = F.md5(F.coalesce("text", F.lit("")).cast("binary"))
    packed = docs.select(F.struct("*").alias("row"), F.col("doc_id").alias("id"), F.col("source").alias("from"), tie.alias("hash"))

    def join(some: DataFrame) -> DataFrame:
        same = F.col("id").eqNullSafe(F.col("doc_id")) & F.col("from").eqNullSafe(F.col("source")) & (F.col("hash") == F.col("tie"))
        return packed.join(some, same)

    times = join(counts.where("rows = 1")).select("row", F.col("copies").alias("n"))
    several = counts.where("rows > 1")
    if not several.isEmpty():
        turn = F.row_number().over(Window.partitionBy("id", "from", "hash").orderBy(F.to_json("row")))
        each = F.floor(F.col("copies") / F.col("rows")) + (turn <= F.pmod("copies", "rows")).cast("long")
        times = times.unionByName(join(several).select("row", each.alias("n")).where("n > 0"))
    return times.select("row", F.explode(F.sequence(F.lit(1).cast("long"), F.col("n")))).select("row.*")

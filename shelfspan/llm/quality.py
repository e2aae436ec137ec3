"""Quality rules: counts of every text, and a hashed n-gram log-likelihood ratio.

Two multinomials over hashed byte n-grams are counted: one over the trusted
documents, one over the raw corpus, both over every row. A text scores the mean
of log(p_target / p_raw) over its n-grams, so its length cancels. The threshold
is a low quantile of the scores of the trusted documents, read from a histogram
with fixed bins, so reruns give the same verdicts.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from shelfspan.llm.text import WORD, column_of, flat, slices, strings
from shelfspan.operators.joins import attach
from shelfspan.session import settle

BITS = 16
PRIOR = 1.0
#: Share of the trusted documents that may fall below the threshold.
QUANTILE = 0.001
#: Scores are counted in bins of this width between -LIMIT and LIMIT.
BIN, LIMIT = 0.001, 20.0
MIN_WORDS, MAX_REPEATED_PERCENT, WINDOW = 20, 30, 8
#: The characters that count as symbols.
SYMBOLS = "#*$%&|<>"
GRAM = 4


def grams(raw: np.ndarray, starts: np.ndarray, bits: int = BITS) -> tuple[np.ndarray, np.ndarray]:
    """Bucket of every n-gram of bytes within a text, and the text it is of."""
    n = len(raw) - GRAM + 1
    if n <= 0:
        return np.zeros(0, np.int64), np.zeros(0, np.int64)
    wide = raw.astype(np.uint32)
    code = wide[:n] | (wide[1 : n + 1] << 8) | (wide[2 : n + 2] << 16) | (wide[3 : n + 3] << 24)
    code ^= code >> np.uint32(15)
    bucket = (code * np.uint32(0x9E3779B1)) >> np.uint32(32 - bits)
    of = np.repeat(np.arange(len(starts) - 1), np.diff(starts))
    inside = of[:n] == of[GRAM - 1 :]
    return bucket[inside].astype(np.int64), of[:n][inside]


def count_grams(rows: DataFrame, bits: int = BITS) -> tuple[np.ndarray, np.ndarray]:
    """N-gram counts of all rows and of the rows with ``trusted``; the driver gets 2^bits numbers of each."""

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        every, target = np.zeros(1 << bits, np.int64), np.zeros(1 << bits, np.int64)
        for batch in slices(batches):
            bucket, of = grams(*flat(column_of(batch, "text")), bits)
            good = column_of(batch, "trusted").to_numpy(zero_copy_only=False).astype(bool)
            every += np.bincount(bucket, minlength=1 << bits)
            target += np.bincount(bucket[good[of]], minlength=1 << bits)
        at = np.flatnonzero(every)
        yield pa.RecordBatch.from_arrays([pa.array(at.astype(np.int32)), pa.array(every[at]), pa.array(target[at])], ["bucket", "n", "t"])

    sums = rows.select("text", "trusted").mapInArrow(count, "bucket int, n long, t long").groupBy("bucket").agg(F.sum("n").alias("n"), F.sum("t").alias("t")).toPandas()
    every, target = np.zeros(1 << bits), np.zeros(1 << bits)
    every[sums["bucket"].to_numpy(int)] = sums["n"].to_numpy()
    target[sums["bucket"].to_numpy(int)] = sums["t"].to_numpy()
    return every, target


def log_ratio(every: np.ndarray, target: np.ndarray, prior: float = PRIOR) -> np.ndarray:
    """log(p_target / p_raw) of each bucket, both smoothed by ``prior``."""
    p = (target + prior) / (target + prior).sum()
    q = (every + prior) / (every + prior).sum()
    return np.log(p / q)


def repeated_words(words: list[str], of: np.ndarray, texts: int, window: int = WINDOW) -> np.ndarray:
    """Words of each text that lie in a window found twice or more in that text.

    Windows get exact numbers by doubling: equal numbers of two halves give
    equal numbers of the whole.
    """
    n = len(words) - window + 1
    if n <= 0:
        return np.zeros(texts, np.int64)
    known: dict[str, int] = {}
    number = np.fromiter((known.setdefault(w, len(known)) for w in words), np.int64, len(words))
    width = 1
    while width < window:
        pair = number[:-width] * (int(number.max()) + 1) + number[width:]
        width *= 2
        number = np.unique(pair, return_inverse=True)[1] if width < window else pair
    inside = of[:n] == of[window - 1 :]
    where = np.flatnonzero(inside)
    if not len(where):
        return np.zeros(texts, np.int64)
    number = np.unique(number[where], return_inverse=True)[1].astype(np.int64)
    key = of[where] * (int(number.max()) + 1) + number
    _, back, counts = np.unique(key, return_inverse=True, return_counts=True)
    twice = where[counts[back] > 1]
    covered = np.zeros(len(words) + 1, np.int64)
    np.add.at(covered, twice, 1)
    np.add.at(covered, twice + window, -1)
    return np.bincount(of[np.cumsum(covered[:-1]) > 0], minlength=texts)


def text_counts(batch: pa.RecordBatch) -> dict[str, np.ndarray]:
    """The counts of the quality rules for each text of a batch."""
    import re

    texts = strings(batch)
    raw, starts = flat(column_of(batch, "text"))
    of = np.repeat(np.arange(len(texts)), np.diff(starts))
    space = (raw == 32) | ((raw >= 9) & (raw <= 13))
    symbol = np.isin(raw, np.frombuffer(SYMBOLS.encode(), np.uint8))
    find = re.compile(WORD).findall
    split = [find(t) for t in texts]
    n_words = np.fromiter(map(len, split), np.int64, len(split))
    duplicates = []
    for text in texts:
        lines = [line for line in text.split("\n") if find(line)] if "\n" in text else ()
        duplicates.append(len(lines) - len(set(lines)))
    words = [w for part in split for w in part]
    return {
        "n_words": n_words,
        "word_chars": np.bincount(of[~space & ((raw & 0xC0) != 0x80)], minlength=len(texts)),
        "n_symbols": np.bincount(of[symbol], minlength=len(texts)),
        "n_dup_lines": np.array(duplicates, np.int64),
        "n_repeat_words": repeated_words(words, np.repeat(np.arange(len(texts)), n_words), len(texts)),
    }


def score(rows: DataFrame, ratio: np.ndarray, bits: int = BITS) -> DataFrame:
    """``doc_id, trusted``, the counts, and ``score``, the mean log-ratio (0 without an n-gram)."""
    shared = rows.sparkSession.sparkContext.broadcast(ratio)
    counts = ("n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches):
            bucket, of = grams(*flat(column_of(batch, "text")), bits)
            total = np.bincount(of, weights=shared.value[bucket], minlength=batch.num_rows)
            number = np.bincount(of, minlength=batch.num_rows)
            stats = text_counts(batch)
            yield pa.RecordBatch.from_arrays(
                [column_of(batch, "doc_id"), column_of(batch, "trusted"), *[pa.array(stats[c].astype(np.int64)) for c in counts], pa.array(total / np.maximum(number, 1))],
                ["doc_id", "trusted", *counts, "score"],
            )

    schema = "doc_id long, trusted boolean, " + ", ".join(f"{c} long" for c in counts) + ", score double"
    return rows.select("doc_id", "text", "trusted").mapInArrow(run, schema)


def threshold(scored: DataFrame, quantile: float = QUANTILE) -> float:
    """The score below which ``quantile`` of the trusted rows lie; -LIMIT without trusted rows.

    At most 2 * LIMIT / BIN bins reach the driver, whatever the rows.
    """
    edge = F.floor(F.greatest(F.lit(-LIMIT), F.least(F.lit(LIMIT), F.col("score"))) / BIN)
    bins = sorted(scored.where("trusted").groupBy(edge.alias("bin")).count().collect())
    left = quantile * sum(n for _, n in bins)
    for at, n in bins:
        left -= n
        if left < 0:
            return at * BIN
    return -LIMIT


def judge(docs: DataFrame, labels: DataFrame, quantile: float = QUANTILE, bits: int = BITS) -> DataFrame:
    """Counts, ``base_failed``, ``score`` and ``kept`` of every row of ``docs``.

    Trusted are documents with ``labels.quality`` 1. Null and empty texts have
    no words, fail the base rules and score 0. Repeated rows count and come out
    as often as they come in.
    """
    trusted = labels.where("quality = 1").select("doc_id").distinct().withColumn("trusted", F.lit(True))
    rows = attach(docs.select("doc_id", "text"), trusted, ["doc_id"]).withColumn("trusted", F.coalesce("trusted", F.lit(False)))
    scored = settle(score(rows, log_ratio(*count_grams(rows, bits)), bits), "quality")
    least = threshold(scored, quantile)
    failed = (F.col("n_words") < MIN_WORDS) | (100 * F.col("n_repeat_words") > MAX_REPEATED_PERCENT * F.col("n_words"))
    return scored.drop("trusted").withColumn("base_failed", failed).withColumn("kept", ~failed & (F.col("score") >= least))

"""Language identification: multinomial naive Bayes over hashed character n-grams."""

from __future__ import annotations

from collections.abc import Iterator
from functools import cache

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from shelfspan.llm.text import code_points, column_of, fold, slices, strings

#: Buckets of hashed n-grams, orders of n-grams, pseudo-count of each bucket.
BITS = 15
ORDERS = (1, 2, 3)
PRIOR = 0.5
#: Odd multipliers of the hash.
FACTORS = (0x9E3779B97F4A7C15, 0xC2B2AE3D27D4EB4F, 0x165667B19E3779F9)


@cache
def letters() -> np.ndarray:
    """For each code point, whether it is a letter."""
    return np.fromiter((chr(c).isalpha() for c in range(0x110000)), bool, 0x110000)


def grams(texts: list[str], bits: int = BITS) -> tuple[list[np.ndarray], np.ndarray, np.ndarray]:
    """Buckets of each order at each character, the text each character is of, and whether a text has a letter.

    Texts are lower-cased, and whatever is no letter counts as a space. Each
    text has a space put before and behind it, so that no n-gram spans texts.
    """
    points, lengths = code_points([f" {t.lower()}  " for t in texts])
    is_letter = letters()[points]
    points = np.where(is_letter, points, 32).astype(np.uint64)
    of = np.repeat(np.arange(len(texts)), lengths)
    some = np.bincount(of, weights=is_letter, minlength=len(texts)) > 0
    n, out, mixed = len(points), [], np.zeros(len(points), np.uint64)
    for order in range(1, max(ORDERS) + 1):
        shifted = np.full(n, 32, np.uint64)
        shifted[: n - order + 1] = points[order - 1 :]
        mixed = (mixed + shifted) * np.uint64(FACTORS[order - 1])
        mixed ^= mixed >> np.uint64(29)
        if order in ORDERS:
            out.append(((mixed * np.uint64(FACTORS[0])) >> np.uint64(64 - bits)).astype(np.int32))
    # Where three characters are spaces nothing is told.
    blank = ~is_letter
    blank[:-1] &= ~is_letter[1:]
    blank[:-2] &= ~is_letter[2:]
    keep = ~blank
    return [g[keep] for g in out], of[keep], some


def learn(docs: DataFrame, bits: int = BITS) -> tuple[list[str], np.ndarray]:
    """Languages in code-point order and their log-probability matrix.

    Counts cover every given row with a language and a text. Tasks add up their
    rows first; the driver gets languages x buckets numbers.
    """

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        sums: dict[str, np.ndarray] = {}
        for batch in slices(batches):
            langs = np.array(column_of(batch, "lang").to_pylist(), object)
            names, index = np.unique(langs, return_inverse=True)
            buckets, of, _ = grams(strings(batch), bits)
            base = index[of] << bits
            total = sum(np.bincount(base + b, minlength=len(names) << bits) for b in buckets)
            for name, part in zip(names, total.reshape(len(names), -1), strict=True):
                sums[name] = sums[name] + part if name in sums else part
        for name, part in sums.items():
            at = np.flatnonzero(part)
            yield pa.RecordBatch.from_arrays(
                [pa.array([name] * len(at), pa.string()), pa.array(at.astype(np.int32)), pa.array(part[at].astype(np.int64))], ["lang", "bucket", "n"]
            )

    rows = docs.where("text is not null and lang is not null").select("text", "lang")
    counted = rows.mapInArrow(count, "lang string, bucket int, n long").groupBy("lang", "bucket").agg(F.sum("n").alias("n")).toPandas()
    langs = sorted(counted["lang"].unique().tolist())
    counts = np.full((len(langs), 1 << bits), PRIOR)
    counts[counted["lang"].map({k: i for i, k in enumerate(langs)}).to_numpy(int), counted["bucket"].to_numpy(int)] += counted["n"].to_numpy()
    return langs, np.log(counts / counts.sum(1, keepdims=True)) if langs else counts


def identify(docs: DataFrame, langs: list[str], logs: np.ndarray, bits: int = BITS) -> DataFrame:
    """``doc_id, lang_pred, score`` of every row, with equal priors.

    ``und`` with score 0 if the text is null or has no letter, or if nothing
    was learned; ties go to the first language in code-point order.
    """
    shared = docs.sparkSession.sparkContext.broadcast(np.ascontiguousarray(logs))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches):
            texts = strings(batch)
            buckets, of, some = grams(texts, bits)
            like = np.zeros((len(langs), len(texts)))
            for row, log in zip(like, shared.value, strict=True):
                row += np.bincount(of, weights=sum(log[b] for b in buckets), minlength=len(texts))
            if len(langs):
                best = like.argmax(0)
                score = 1 / np.exp(like - like.max(0)).sum(0)
            else:
                best, score, some = np.zeros(len(texts), int), np.zeros(len(texts)), np.zeros(len(texts), bool)
            yield pa.RecordBatch.from_arrays(
                [
                    column_of(batch, "doc_id"),
                    pa.array([langs[b] if s else "und" for b, s in zip(best.tolist(), some.tolist(), strict=True)], pa.string()),
                    pa.array(np.where(some, score, 0.0)),
                ],
                ["doc_id", "lang_pred", "score"],
            )

    return docs.select("doc_id", "text").mapInArrow(run, "doc_id long, lang_pred string, score double")


def held_out_languages(docs: DataFrame, bits: int = BITS) -> DataFrame:
    """Learn from the rows whose crc32(doc_id) modulo 5 is not 0 and score all rows.

    ``doc_id, held_out, lang_pred, score``; a null doc_id is not held out and not learned from.
    """
    docs = docs.select("doc_id", "text", "lang")
    langs, logs = learn(docs.where(fold("doc_id", 5) != 0), bits)
    scored = identify(docs, langs, logs, bits)
    return scored.select("doc_id", F.coalesce(fold("doc_id", 5) == 0, F.lit(False)).alias("held_out"), "lang_pred", "score")

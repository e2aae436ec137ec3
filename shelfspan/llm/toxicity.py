"""Toxicity: boosted trees over dense text features, with isotonic calibration.

A lexicon of words and word beginnings is learned from the labelled rows by
their odds in toxic documents. Features are densities of the lexicon, its
closeness to the second person, and rates of capitals, punctuation, symbols and
obfuscated words.
"""

from __future__ import annotations

import math
import re
from collections import Counter
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.ml.classification import GBTClassifier
from pyspark.ml.functions import array_to_vector, vector_to_array
from pyspark.ml.regression import IsotonicRegression
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from shelfspan.llm.text import column_of, flat, fold, slices, strings
from shelfspan.operators.joins import attach
from shelfspan.session import settle

#: The classifier is fitted on about this many labelled rows at most, chosen by a hash of doc_id.
SAMPLE_ROWS = 24_000
#: Of 100 sample rows these calibrate and the others train.
CALIBRATION_PERCENT = 30
#: A lexicon unit occurs in this many toxic sample documents at least, with these odds, and units are this many at most.
LEAST_TOXIC, LEAST_ODDS, MOST_UNITS = 3, 8.0, 20_000
STEMS = (4, 5, 6)
NEAR = 5
TREES, DEPTH, SEED = 20, 4, 7
THRESHOLD = 0.7
# Pronouns of the second person in English, German, French and Spanish.
SECOND_PERSON = frozenset("you your yours yourself u ur du dich dir dein deine deinen deiner euch euer ihr ihnen sie tu te toi ton ta tes vous votre vos tú ti tus usted ustedes vosotros vuestro os".split())
TOKEN = re.compile(r"[^\W\d_]+")
OBFUSCATED = re.compile(r"[^\W\d_][\d@$*!|]+[^\W\d_]|(?:\b[^\W\d_][.\-_*]){3,}")
FEATURES = (
    "log_words", "hits", "hit_rate", "odds_rate", "top_odds", "kinds", "stem_rate", "near_second", "second_rate",
    "capital_rate", "mark_rate", "exclamation_rate", "symbol_rate", "digit_rate", "obfuscated_rate", "word_length",
)


def units(words: set[str]) -> set[str]:
    """Words and their beginnings (with a star)."""
    out = set(words)
    for n in STEMS:
        out.update(w[:n] + "*" for w in words if len(w) > n)
    return out


def learn_lexicon(sample: DataFrame) -> dict[str, float]:
    """Log-odds of the units that mark toxic documents of a bounded sample ``text, toxic``."""

    def count(wanted: frozenset | None):
        def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            seen: Counter = Counter()
            for batch in slices(batches):
                for text in strings(batch):
                    found = units(set(TOKEN.findall(text.lower())))
                    seen.update(found if wanted is None else found & wanted)
            yield pa.RecordBatch.from_arrays([pa.array(list(seen), pa.string()), pa.array(list(seen.values()), pa.int64())], ["unit", "n"])

        return run

    def totals(rows: DataFrame, wanted: frozenset | None = None) -> DataFrame:
        return rows.select("text").mapInArrow(count(wanted), "unit string, n long").groupBy("unit").agg(F.sum("n").alias("n"))

    toxic = totals(sample.where("toxic = 1")).where(F.col("n") >= LEAST_TOXIC)
    often = {r.unit: r.n for r in toxic.orderBy(F.desc("n"), "unit").limit(MOST_UNITS).collect()}
    if not often:
        return {}
    sizes = sample.agg(F.sum(F.col("toxic")).alias("t"), F.sum(1 - F.col("toxic")).alias("c")).first()
    clean = {r.unit: r.n for r in totals(sample.where("toxic = 0"), frozenset(often)).collect()}
    odds = {u: (n + 0.5) / (clean.get(u, 0) + 0.5) * (sizes.c + 1) / (sizes.t + 1) for u, n in often.items()}
    return {u: math.log(o) for u, o in odds.items() if o >= LEAST_ODDS}


def features(rows: DataFrame, lexicon: dict[str, float], text: str = "text", keep_text: bool = False) -> DataFrame:
    """The given columns, without the text's unless ``keep_text``, and ``features`` as an array of doubles; null texts count as empty."""
    shared = rows.sparkSession.sparkContext.broadcast(lexicon)
    kept = [f for f in rows.schema.fields if keep_text or f.name != text]
    text_column = text

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        lexicon = shared.value
        cache: dict[str, tuple[float, bool]] = {}

        def weigh(word: str) -> tuple[float, bool]:
            """Best log-odds of the word or a beginning of it, and whether only a beginning has any."""
            whole = lexicon.get(word, 0.0)
            stem = max((lexicon.get(word[:n] + "*", 0.0) for n in STEMS if len(word) > n), default=0.0)
            return max(whole, stem), whole == 0.0 and stem > 0

        for batch in slices(batches, text_column):
            raw, starts = flat(column_of(batch, text_column))
            texts = strings(batch, text_column)
            n_texts = len(texts)
            of = np.repeat(np.arange(n_texts), np.diff(starts))
            share = lambda mask: np.bincount(of[mask], minlength=n_texts)  # noqa: E731, B023
            size = np.maximum(np.diff(starts), 1)
            capitals, digits = share((raw >= 65) & (raw <= 90)), share((raw >= 48) & (raw <= 57))
            small = share((raw >= 97) & (raw <= 122))
            marks = share(np.isin(raw, np.frombuffer(b".,;:?!'\"()-", np.uint8)))
            exclamations, symbols = share(raw == 33), share(np.isin(raw, np.frombuffer(b"#*$%&|<>@_", np.uint8)))
            out = np.zeros((n_texts, len(FEATURES)))
            for i, text in enumerate(texts):
                words = TOKEN.findall(text.lower())
                n = max(len(words), 1)
                hits, weights, stems, kinds = [], [], 0, set()
                for at, w in enumerate(words):
                    got = cache.get(w)
                    if got is None:
                        if len(cache) > 300_000:
                            cache.clear()
                        got = cache[w] = weigh(w)
                    if got[0]:
                        hits.append(at)
                        weights.append(got[0])
                        stems += got[1]
                        kinds.add(w)
                seconds = sum(map(SECOND_PERSON.__contains__, words))
                near = sum(any(words[k] in SECOND_PERSON for k in range(max(0, h - NEAR), min(len(words), h + NEAR + 1))) for h in hits)
                out[i] = (
                    math.log1p(len(words)), min(len(hits), 50), len(hits) / n, sum(weights) / n, max(weights, default=0.0), min(len(kinds), 50), stems / n, near / n,
                    seconds / n, capitals[i] / max(capitals[i] + small[i], 1), marks[i] / size[i], exclamations[i] / size[i], symbols[i] / size[i],
                    digits[i] / size[i], len(OBFUSCATED.findall(text)) / n, size[i] / n,
                )
            values = pa.ListArray.from_arrays(pa.array(np.arange(n_texts + 1) * len(FEATURES), pa.int32()), pa.array(out.ravel()))
            yield pa.RecordBatch.from_arrays([*[column_of(batch, f.name) for f in kept], values], [*[f.name for f in kept], "features"])

    schema = ", ".join([*[f"`{f.name}` {f.dataType.simpleString()}" for f in kept], "features array<double>"])
    return rows.select(*[f.name for f in kept if f.name != text], text).mapInArrow(run, schema)


class ToxicityModel:
    """A fitted lexicon, trees and calibration; without both classes in the labels, one constant score."""

    def __init__(self, lexicon: dict[str, float], trees=None, isotonic=None, constant: float = 0.0):
        self.lexicon, self.trees, self.isotonic, self.constant = lexicon, trees, isotonic, constant

    def score(self, docs: DataFrame) -> DataFrame:
        """``doc_id, score, predicted`` of every row, whatever its text."""
        if self.trees is None:
            scored = docs.select("doc_id", F.lit(float(self.constant)).alias("score"))
        else:
            rows = features(docs.select("doc_id", "text"), self.lexicon).withColumn("features", array_to_vector("features"))
            raw = self.trees.transform(rows).select("doc_id", vector_to_array("probability")[1].alias("raw"))
            calibrated = self.isotonic.transform(raw)
            scored = calibrated.select("doc_id", F.greatest(F.lit(0.0), F.least(F.lit(1.0), F.col("score"))).alias("score"))
        return scored.withColumn("predicted", (F.col("score") >= THRESHOLD).cast("int"))

    def keep(self, docs: DataFrame) -> DataFrame:
        """``docs`` without the rows whose text is predicted toxic; columns and other rows stay as they are."""
        if self.trees is None:
            return docs if self.constant < THRESHOLD else docs.limit(0)
        wide = [F.col(c).alias(f"_{i}") for i, c in enumerate(docs.columns)]
        # The text goes to Python and back once.
        rows = features(docs.select(*wide), self.lexicon, f"_{docs.columns.index('text')}", keep_text=True).withColumn("features", array_to_vector("features"))
        raw = self.trees.transform(rows).withColumn("raw", vector_to_array("probability")[1])
        scored = self.isotonic.transform(raw).where(F.col("score") < THRESHOLD)
        return scored.select(*[F.col(f"_{i}").alias(c) for i, c in enumerate(docs.columns)])


def fit(docs: DataFrame, labels: DataFrame, sample_rows: int = SAMPLE_ROWS) -> ToxicityModel:
    """Fit on the labelled rows whose crc32(doc_id) modulo 3 is not 1.

    A document with several labels counts as toxic if one of them says so; null
    labels and labels without a document are left out.
    """
    known = labels.where("toxic in (0, 1)").groupBy("doc_id").agg(F.max("toxic").cast("int").alias("toxic")).where(fold("doc_id", 3) != 1)
    n = known.count()
    million = 1_000_000
    share = million if n <= sample_rows else million * sample_rows // n
    spread = lambda salt: F.pmod(F.xxhash64("doc_id", F.lit(salt)), F.lit(million))
    chosen = known.where(spread("sample") < share)
    sample = settle(attach(docs.select("doc_id", "text"), chosen, ["doc_id"], "inner"), "labelled")
    counts = {r.toxic: r["count"] for r in sample.groupBy("toxic").count().collect()}
    if len(counts) < 2:
        return ToxicityModel({}, constant=1.0 if 1 in counts else 0.0)
    part = spread("calibration") < CALIBRATION_PERCENT * million // 100
    train, hold = sample.where(~part), sample.where(part)
    if train.groupBy("toxic").count().count() < 2 or hold.groupBy("toxic").count().count() < 2:
        train = hold = sample
    lexicon = learn_lexicon(train)
    ready = lambda rows: settle(features(rows.select("text", F.col("toxic").cast("double").alias("label")), lexicon), "features").withColumn("features", array_to_vector("features"))
    fitted = ready(train)
    trees = GBTClassifier(maxIter=TREES, maxDepth=DEPTH, seed=SEED, stepSize=0.2, maxBins=64, minInstancesPerNode=4, cacheNodeIds=False).fit(fitted)
    held = trees.transform(ready(hold)).select("label", vector_to_array("probability")[1].alias("raw"))
    isotonic = IsotonicRegression(featuresCol="raw", labelCol="label", predictionCol="score").fit(held)
    return ToxicityModel(lexicon, trees, isotonic)


def held_out_scores(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """``doc_id, held_out, score, predicted`` of every row of ``docs``."""
    scored = fit(docs, labels).score(docs)
    return scored.select("doc_id", F.coalesce(fold("doc_id", 3) == 1, F.lit(False)).alias("held_out"), "score", "predicted")

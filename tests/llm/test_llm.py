"""Small tables with nulls, empty and long texts, ties, repeats and clashing columns, against brute force."""

import collections
import hashlib
import zlib

import duckdb
import numpy as np
import pytest
from pyspark.sql import functions as F

from shelfspan.llm import graph, language, licences, mixing, near_dedup, neighbours, pieces, quality, secret_scan, suffixes, toxicity
from shelfspan.llm.queries import ORACLES, QUERIES
from shelfspan.llm.ship import ship

FOLDER = "/root/testdata/sf0.001"
SCHEMA = "doc_id long, text string, lang string, source string, n_chars long, score double, id long, size string"


@pytest.fixture(scope="module")
def docs(spark):
    ship(spark)
    base = " ".join(f"word{i} of the" for i in range(80))
    rows = [
        (1, base), (2, base), (3, base.replace("word7 ", "other ")), (4, None), (5, ""), (6, "   \n\t "), (7, "You are a stupid idiot"), (8, "ä" * 3000 + "\n" + "x " * 4000),
        (9, "Licensed under the\nApache License, Version 2.0."), (10, 'token = "681c09b8e90e7e8c9575180f595f646cf2969054" la'), (10, 'token = "681c09b8e90e7e8c9575180f595f646cf2969054" la'), (None, base),
    ]
    return spark.createDataFrame([(i, t, "en" if i != 4 else None, "s" if (i or 0) % 2 else None, len(t or ""), 0.5, 1, "z") for i, t in rows], SCHEMA)


@pytest.fixture(scope="module")
def labels(spark):
    return spark.createDataFrame([(1, 1, 0), (2, 1, 0), (3, None, None), (7, 0, 1), (7, 0, 1), (None, 1, 1), (99, 1, 1)], "doc_id long, quality int, toxic int")


def test_pieces_agree_with_the_library(docs):
    rows = pieces.encode(docs, keep_ids=True).collect()
    assert len(rows) == 12 and all(r["agrees"] for r in rows)
    assert {r["n_tokens"] for r in rows if r["doc_id"] in (4, 5)} == {2}
    coder = pieces.agenda(pieces.vocabulary_path("piece_bpe_32k.model"))
    for text in ("", " ", "  a  b\t\n c ", "▁▁ x", "日本語🎉", "a" * 500, " " * 900 + "end", "\x00\x01\n\n", "é" * 90):
        assert np.frombuffer(coder.encode([text])[0], "<u4").tolist() == coder.library.encode(text, add_bos=True, add_eos=True)


def brute_force_removal(rows):
    seen = collections.defaultdict(set)
    for i, b in rows:
        for k in range(len(b) - 49):
            seen[b[k : k + 50]].add(float("inf") if i is None else i)
    want = []
    for i, b in rows:
        cover = np.zeros(len(b) + 1, bool)
        for k in range(len(b) - 49):
            if min(seen[b[k : k + 50]]) < (float("inf") if i is None else i):
                cover[k : k + 50] = True
        kept = bytes(x for x, c in zip(b, cover, strict=False) if not c)
        want.append((i, len(b), len(b) - len(kept), int((np.diff(cover[:-1].astype(int), prepend=0) == 1).sum()), hashlib.sha256(kept).hexdigest()))
    return sorted(want, key=str)


def test_suffixes_match_brute_force(spark, docs):
    extra = docs.select("doc_id", "text").unionByName(spark.createDataFrame([(20, "q" * 49), (21, "q" * 49), (22, "q" * 60 + "r" * 60), (23, "z" + "q" * 60 + "s" + "r" * 60), (10, "another text of the same id " * 3)], "doc_id long, text string"))
    got = sorted((tuple(r) for r in extra_rows(suffixes.remove_repeats(extra))), key=str)
    assert got == brute_force_removal([(i, (t or "").encode()) for i, t in extra.collect()])


def test_suffixes_of_any_ids(spark):
    ship(spark)
    text = "the same passage of more than fifty bytes stands in all of these documents, "
    for ids in ([2**63 - 1, None, None, -(2**63)], [2**62 + 5, 2**62 + 5, 2**62 + 6, None], [2**63 - 1, 2**63 - 2, 7, -1]):
        rows = [(i, f"{n} starts here {text * (n + 1)} and ends {n * 'z'}") for n, i in enumerate(ids)]
        got = extra_rows(suffixes.remove_repeats(spark.createDataFrame(rows, "doc_id long, text string")))
        assert sorted(map(tuple, got), key=str) == brute_force_removal([(i, t.encode()) for i, t in rows])


def test_suffixes_of_a_frequent_gram_meet_across_ranges(spark, monkeypatch):
    """All texts hold one gram with other bytes around it; ranges so small that splitters part it."""
    ship(spark)
    monkeypatch.setattr(suffixes, "BUCKET_BYTES", 400)
    rng = np.random.default_rng(3)
    tails = ["".join(rng.choice(list("ab"), 8)) for _ in range(12)]
    rows = [(i, f"{tails[i % 5]}{tails[i % 7]} common words of all documents {tails[i % 11]}{tails[i % 12]} {'x' * (i % 40)}{i % 9}") for i in range(300)]
    frame = spark.createDataFrame(rows, "doc_id long, text string")
    found = []
    plain = suffixes.across
    monkeypatch.setattr(suffixes, "across", lambda rows, *more: found.append(rows.count()) or plain(rows, *more))
    got = sorted(map(tuple, extra_rows(suffixes.remove_repeats(frame))), key=str)
    assert found[0] > 0 and got == brute_force_removal([(i, t.encode()) for i, t in rows])


def extra_rows(df):
    return df.select("doc_id", "n_bytes", "n_removed", "n_spans", "kept_sha256").collect()


def test_multikey_order_sorts_bytes():
    table = np.random.default_rng(1).integers(0, 3, (500, 20)).astype(np.uint8)
    ordered = [table[i].tobytes() for i in suffixes.multikey_order(table)]
    assert ordered == sorted(ordered)
    assert suffixes.multikey_order(table[:0]).tolist() == [] and suffixes.multikey_order(table[:1]).tolist() == [0]


def test_near_copies_share_a_class(docs):
    rows = near_dedup.classes_of(docs).collect()
    assert len(rows) == 12
    classes = {r["doc_id"]: r["class_id"] for r in rows}
    assert classes[1] == classes[2] == classes[3] == classes[None] == 1 and classes[5] == classes[4] == 4 and classes[8] == 8
    assert near_dedup.keep_one(docs).columns == docs.columns
    assert sorted(r["doc_id"] for r in near_dedup.keep_one(docs).collect()) == [1, 4, 6, 7, 8, 9, 10]


def test_samples_estimate_weighted_jaccard():
    random = np.random.default_rng(3)
    x = np.unique(random.integers(0, 1 << 44, 300).astype(np.uint64))
    y = np.unique(np.concatenate([x[:250], random.integers(0, 1 << 44, 40).astype(np.uint64)]))
    u, v = np.linspace(1, 2, len(x)), np.linspace(1, 2, len(y))
    marks = near_dedup.samples(np.concatenate([x, y]), np.concatenate([u, v]), np.array([0, len(x), len(x) + len(y)]), 2000)
    assert abs((marks[0] == marks[1]).mean() - near_dedup.weighted_jaccard((x, u), (y, v))) < 0.05


def test_components(spark):
    edges = spark.createDataFrame([(1, 2), (2, 3), (5, 4), (7, 7), (9, 8), (8, 1)], "a long, b long")
    assert {r["node"]: r["class_id"] for r in graph.components(edges).collect()} == {1: 1, 2: 1, 3: 1, 8: 1, 9: 1, 4: 4, 5: 4}


def test_mix_meets_targets(docs, labels):
    rows = mixing.mix(docs, mixing.quality_weights(labels)).collect()
    assert len(rows) == 12 and all(r["taken"] <= 3 * r["size"] for r in rows)
    assert mixing.draw(docs, mixing.quality_weights(labels)).columns == docs.columns
    assert mixing.mix(docs.limit(0), mixing.quality_weights(labels)).count() == 0


def test_quality_counts(docs, labels):
    rows = {r["doc_id"]: r for r in quality.judge(docs, labels).collect()}
    assert rows[4]["n_words"] == rows[6]["n_words"] == 0 and rows[4]["base_failed"] and not rows[4]["kept"]
    assert rows[8]["n_repeat_words"] == 4000 and rows[8]["word_chars"] == 7000
    words = [f"w{i}" for i in range(8)] * 2 + ["x"]
    assert quality.repeated_words(words, np.zeros(17, int), 1).tolist() == [16]
    assert quality.judge(docs.limit(0), labels).count() == 0


def test_toxicity_and_language_edges(docs, labels):
    scored = toxicity.held_out_scores(docs, labels).collect()
    assert len(scored) == 12 and all(0 <= r["score"] <= 1 for r in scored)
    assert {r["doc_id"]: r["held_out"] for r in scored if r["doc_id"]} == {i: zlib.crc32(str(i).encode()) % 3 == 1 for i in range(1, 11)}
    assert toxicity.fit(docs, labels).keep(docs).columns == docs.columns
    told = {r["doc_id"]: r["lang_pred"] for r in language.held_out_languages(docs).collect()}
    assert told[4] == told[5] == told[6] == "und" and told[1] == "en"
    assert {r["lang_pred"] for r in language.held_out_languages(docs.withColumn("lang", F.lit(None).cast("string"))).collect()} == {"und"}


def test_secrets_and_licences(spark, docs):
    scanner = secret_scan.fit(secret_scan.labelled_findings(spark))
    found = {r["doc_id"]: r["n_secrets"] for r in secret_scan.summary(docs, scanner).collect()}
    assert found[10] == 1 and sum(found.values()) == 1
    fresh = secret_scan.redact(docs, scanner)
    assert fresh.columns == docs.columns and fresh.count() == 12
    assert [r["text"] for r in fresh.where("doc_id = 10").collect()] == ['token = "<SECRET>" la'] * 2
    told = {r["doc_id"]: r["rule_ids"] for r in licences.scan(docs).collect()}
    assert told[9] == ["apache-2.0-notice"] and told[4] == []


def commented(text: str, mark: str) -> str:
    return "\n".join(f"{mark} {line}".rstrip() for line in text.splitlines())


def test_every_licence_text_is_recognised_as_published(spark):
    """Whole, behind comment marks, in one line, and between other text; the texts hold what they should."""
    rows = []
    for rule, text in licences.TEXTS.items():
        header = "Copyright (c) 2024 Some Body\n\n"
        rows += [(rule, text), (rule, header + text), (rule, commented(text, "#")), (rule, commented(text, " *")), (rule, "Intro about it.\n\n" + text + "\nint main() { return 0; }\n"), (rule, text.upper())]
    docs = spark.createDataFrame([(n, t) for n, (_, t) in enumerate(rows)], "doc_id long, text string")
    told = {r["doc_id"]: r for r in licences.scan(docs).collect()}
    for n, (rule, _) in enumerate(rows):
        assert told[n]["rule_ids"] == [rule] and told[n]["licences"] == [licences.LICENCES[rule]], (n, rule, told[n])
    for rule, text in licences.TEXTS.items():
        cut = spark.createDataFrame([(text,)], "text string").select(F.filter(licences.sentences_of(F.col("text"), True), lambda s: F.length(s) > 0)).first()[0]
        assert cut == licences.cut_text(text), rule
    assert set(licences.LICENCES) == set(licences.TEXTS)


SECRETS = [
    ("password=hunter2secret99xyz", "hunter2secret99xyz"), ("GET /items?token=0123456789abcdef0123456789abcdef01234567&page=2", "0123456789abcdef0123456789abcdef01234567"),
    ('password = "hunter2pass"', "hunter2pass"), ("export GITHUB_TOKEN=ghp_Zk3bX9qLw2Tn7RvY5sHc8UdJ4mPfGa61eKo0\n", "ghp_Zk3bX9qLw2Tn7RvY5sHc8UdJ4mPfGa61eKo0"),
    ("AWS_SECRET_ACCESS_KEY=wJalrXUtnFEMIK7MDENGbPxRfiCYzTq9LmN2sVd8\n", "wJalrXUtnFEMIK7MDENGbPxRfiCYzTq9LmN2sVd8"), ('DB_PASSWORD="qVx81LmzTr"', "qVx81LmzTr"),
]


def test_secrets_behind_names(spark):
    """Only the value is masked; summary and redact agree, also on a null id; columns of own names come along."""
    scanner = secret_scan.fit(secret_scan.labelled_findings(spark))
    rows = [(n, f"Some words. {t} and more") for n, (t, _) in enumerate(SECRETS)] + [(None, "here " + SECRETS[0][0]), (50, "password: required"), (51, "commit 0123456789abcdef0123456789abcdef01234567"), (52, None), (53, "")]
    docs = spark.createDataFrame([(i, t, len(t or ""), "k", [1], 2) for i, t in rows], "doc_id long, text string, n_chars int, key string, _flags array<int>, row int")
    told = {r["doc_id"]: r["n_secrets"] for r in secret_scan.summary(docs, scanner).collect()}
    assert told == {**{n: 1 for n in range(len(SECRETS))}, None: 1, 50: 0, 51: 0, 52: 0, 53: 0}
    clean = {r["doc_id"]: r for r in secret_scan.redact(docs, scanner).collect()}
    for n, (text, value) in enumerate(SECRETS):
        assert clean[n]["text"] == f"Some words. {text.replace(value, secret_scan.MASK)} and more" and clean[n]["n_chars"] == len(clean[n]["text"])
    assert clean[None]["text"] == "here password=<SECRET>" and clean[50]["text"] == "password: required" and clean[52]["text"] is None and clean[53]["row"] == 2
    assert secret_scan.summary(docs.limit(0), scanner).count() == 0 == secret_scan.redact(docs.limit(0), scanner).count()


def test_secret_forest_on_held_out_findings(spark):
    """Precision and recall on findings made from other numbers than those it was fitted on."""
    scanner = secret_scan.fit(secret_scan.labelled_findings(spark))
    scored = scanner.score(secret_scan.labelled_findings(spark, 4_000, first=1_000_000)).select("label", "is_secret").collect()
    true = sum(r["is_secret"] and r["label"] == 1 for r in scored)
    assert true >= 0.95 * sum(r["label"] == 1 for r in scored) and true >= 0.95 * sum(r["is_secret"] for r in scored) and len(scored) > 3_000


def test_draw_with_ties_and_clashing_columns(spark):
    """Reruns and other partitionings agree, whatever repeats; columns of any name come along."""
    rows = [(i % 5 if i % 7 else None, "w " * (i % 4 + 1), "s" + str(i % 2), i, i) for i in range(120)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, source string, _id int, copies int")
    quality = spark.createDataFrame([(1, 2.0)], "doc_id long, weight double")
    runs = [sorted(map(str, mixing.draw(docs.repartition(n), quality).collect())) for n in (1, 3, 7)]
    assert runs[0] == runs[1] == runs[2]
    mixed = mixing.mix(docs, quality)
    sizes = {r["source"]: r["target"] for r in mixed.collect()}
    for r in mixed.groupBy("source").agg(F.sum("taken").alias("taken")).collect():
        assert abs(r["taken"] - sizes[r["source"]]) <= 4


def test_neighbours_match_brute_force(spark):
    ship(spark)
    x = np.random.default_rng(2).standard_normal((120, 8))
    rows = [(i, v.tolist()) for i, v in enumerate(x)] + [(200 + i, x[0].tolist()) for i in range(30)] + [(300, None), (301, [0.0] * 8), (302, [float("nan")] * 8), (303, [None] * 8), (304, [1.0])]
    got = collections.defaultdict(list)
    for r in neighbours.nearest(spark.createDataFrame(rows, "vec_id long, embedding array<double>"), F.col("vec_id") % 20 == 0).orderBy("query_id", "rank").collect():
        got[r["query_id"]].append(r["vec_id"])
    real = {i: np.array(v) for i, v in rows if i < 300}
    for q in [i for i in real if i % 20 == 0]:
        assert got[q] == sorted((i for i in real if i != q), key=lambda i: (-round(float(real[i] @ real[q]), 9), i))[:20]
    assert 300 not in got


def recall_of(spark, x, **parameters):
    """Share of the true 20 nearest of every 20th vector that are found; a query without answers counts as none found."""
    table = spark.createDataFrame([(i, v.tolist()) for i, v in enumerate(x)], "vec_id long, embedding array<double>")
    got = collections.defaultdict(set)
    for r in neighbours.nearest(table, F.col("vec_id") % 20 == 0, **parameters).collect():
        got[r["query_id"]].add(r["vec_id"])
    shares = []
    for q in range(0, len(x), 20):
        scores = x @ x[q]
        scores[q] = -np.inf
        shares.append(len(got[q] & set(np.argsort(-scores)[:20].tolist())) / 20)
    return float(np.mean(shares))


@pytest.mark.parametrize("kind", ["unit", "lognormal", "one very long", "tiny and huge"])
def test_neighbours_run_until_settled(spark, kind):
    """The default parameters must find 0.9 of the true neighbours whatever the norms; small blocks stand for larger tables."""
    ship(spark)
    random = np.random.default_rng(4)
    x = random.standard_normal((1500, 24))
    x /= np.linalg.norm(x, axis=1, keepdims=True)
    if kind == "lognormal":
        x *= random.lognormal(0, 1, (1500, 1))
    if kind == "one very long":
        x[17] *= 200
    if kind == "tiny and huge":
        x *= 10.0 ** random.integers(-3, 4, (1500, 1)) * 1e150
    assert recall_of(spark, x, block=64, trees=2) > 0.9


def test_neighbours_of_equal_vectors(spark):
    """Forty equal vectors are one node without neighbours: every query still gets its twenty answers."""
    ship(spark)
    rows = [(i, [0.5, 0.25]) for i in range(40)]
    got = neighbours.nearest(spark.createDataFrame(rows, "vec_id long, embedding array<float>"), F.col("vec_id") % 20 == 0).orderBy("query_id", "rank").collect()
    assert [(r["query_id"], r["rank"], r["vec_id"]) for r in got] == [(q, n + 1, v) for q in (0, 20) for n, v in enumerate([i for i in range(40) if i != q][:20])]
    assert {r["score"] for r in got} == {0.3125}
    alone = neighbours.nearest(spark.createDataFrame([(20, [1.0])], "vec_id long, embedding array<float>"), F.col("vec_id") % 20 == 0)
    assert alone.collect() == [] and neighbours.nearest(spark.createDataFrame([], "vec_id long, embedding array<float>"), F.col("vec_id") % 20 == 0).collect() == []


@pytest.mark.parametrize("name", sorted(ORACLES))
def test_oracles(spark, name):
    got = QUERIES[name](spark, FOLDER).toPandas()
    db = duckdb.connect()
    for table in ("documents", "labels"):
        db.execute(f"CREATE VIEW {table} AS SELECT * FROM '{FOLDER}/{table}.parquet'")
    want = db.execute(ORACLES[name]).fetchdf()[list(got.columns)]
    key = list(got.columns)
    assert got.sort_values(key).values.tolist() == want.sort_values(key).values.tolist()


def test_registry():
    """Queries without SQL are those that train, sample or search; their tests are in this folder."""
    without = {"op1_toxicity", "op3_secret_scan", "op4_quality_rules", "op5_sentencepiece", "op6_suffix_dedup", "op7_language_id", "op8_neighbours", "op10_near_dedup", "op13_conversation_repair"}
    assert set(QUERIES) - set(ORACLES) == without and len(QUERIES) == 13

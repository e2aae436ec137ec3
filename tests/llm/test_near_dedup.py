"""Near-duplicate classes against all pairs, and the pipeline's stages against what they must keep."""

import random
import re

import numpy as np
import pyarrow as pa
import pytest
import xxhash

from shelfspan.llm import near_dedup, pieces
from shelfspan.llm.ship import ship
from shelfspan.llm.text import WORD, flat

FOLDER = "/root/testdata/sf0.01"


def all_pairs(texts: list[str], similarity: float = 0.8) -> tuple[list[int], int]:
    """The least place of each text's class, from every pair of texts; and the number of linked pairs of different texts."""
    different = sorted(set(texts))
    shingler = near_dedup.Shingler()
    sets = []
    for text in different:
        codes, counts, _ = shingler([text])
        sets.append((codes, counts))
    sums = np.zeros(1 << near_dedup.FREQUENCY_BITS, np.int64)
    in_corpus = {t: texts.count(t) for t in different}
    for text, (codes, _) in zip(different, sets, strict=True):
        np.add.at(sums, near_dedup.bucket_of(codes), in_corpus[text])
    inverse = near_dedup.inverse_frequencies(sums, sum(n for t, n in in_corpus.items() if t.split()))
    weighed = [(codes, counts * inverse[near_dedup.bucket_of(codes)]) for codes, counts in sets]
    total = [w.sum() for _, w in weighed]
    top = list(range(len(different)))

    def root(i):
        while top[i] != i:
            i = top[i]
        return i

    links = 0
    for i in range(len(different)):
        for j in range(i):
            if min(total[i], total[j]) >= similarity * max(total[i], total[j]) and near_dedup.weighted_jaccard(weighed[i], weighed[j]) >= similarity:
                links += 1
                top[root(i)] = root(j)
    place = {t: root(i) for i, t in enumerate(different)}
    first: dict[int, int] = {}
    return [first.setdefault(place[t], at) for at, t in enumerate(texts)], links


def partition(keys) -> set[frozenset[int]]:
    groups: dict = {}
    for at, key in enumerate(keys):
        groups.setdefault(key, set()).add(at)
    return {frozenset(g) for g in groups.values()}


def test_classes_equal_all_pairs_on_a_whole_table(spark):
    ship(spark)
    docs = spark.read.parquet(f"{FOLDER}/documents.parquet")
    rows = docs.orderBy("doc_id").collect()
    got = {r["doc_id"]: r for r in near_dedup.classes_of(docs).collect()}
    want, links = all_pairs([r["text"] or "" for r in rows])
    assert partition([got[r["doc_id"]]["class_id"] for r in rows]) == partition(want)
    assert all(got[r["doc_id"]]["class_id"] == rows[at]["doc_id"] for r, at in zip(rows, want, strict=True))
    assert links > 0


def variants(dice, n: int, words: int, changed: float) -> list[str]:
    """Texts that replace up to a share of the words of one text, so that many pairs lie just around the similarity."""
    base = [f"w{dice.randrange(10_000)}" for _ in range(words)]
    shares = [dice.uniform(0, changed) for _ in range(n)]
    return [" ".join(f"x{dice.randrange(10_000)}" if dice.random() < share else w for w in base) for share in shares]


def test_large_buckets_of_texts_about_the_similarity(spark):
    """Texts of a bucket that aren't all connected go through the rarest shared shingles; no class is lost."""
    ship(spark)
    dice = random.Random(2)
    texts = variants(dice, 100, 200, 0.05) + variants(dice, 40, 60, 0.05)
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    got = {r["doc_id"]: r["class_id"] for r in near_dedup.classes_of(docs).collect()}
    want, links = all_pairs(texts)
    assert len(partition(want)) > 10 and links > 100
    assert partition([got[i] for i in range(len(texts))]) == partition(want)


def test_only_large_buckets_are_taken_apart_by_shingles(spark, monkeypatch):
    """Texts of small buckets are all compared before, and texts that share too little with any are left out; no class is lost."""
    ship(spark)
    dice = random.Random(5)
    near = [f"w{dice.randrange(10_000)}" for _ in range(200)]
    # Half of a text's words come again in each of these, so they meet in buckets, but no two are similar.
    halves = [" ".join(near[:120] + [f"y{n}x{i}" for i in range(80)]) for n in range(150)]
    texts = variants(dice, 14, 200, 0.05) + variants(dice, 10, 60, 0.06) + halves
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    taken, candidates = [], []
    rows, settled = near_dedup.shingle_rows, near_dedup.settle

    def counted(texts, inverse):
        taken.append(texts.count())
        return rows(texts, inverse)

    def seen(df, name="table"):
        if name == "candidates":
            candidates.append(df._jdf.queryExecution().optimizedPlan().toString())
        return settled(df, name)

    monkeypatch.setattr(near_dedup, "shingle_rows", counted)
    monkeypatch.setattr(near_dedup, "settle", seen)
    got = {r["doc_id"]: r["class_id"] for r in near_dedup.classes_of(docs).collect()}
    want, links = all_pairs(texts)
    assert partition([got[i] for i in range(len(texts))]) == partition(want) and links >= 10 and len(partition(want)) > 155
    assert taken == [0] and len(candidates) == 3
    assert "o_front" not in candidates[2]  # a row of a shingle doesn't take along all others of its text


def test_a_pair_meets_about_once_by_its_rarest_shingles(spark):
    """Similar texts share many shingles; they meet at the first and hardly again, and no similar pair is left out."""
    ship(spark)
    dice = random.Random(3)
    texts = sorted(set(variants(dice, 60, 200, 0.03)))
    inverse = np.ones(1 << near_dedup.FREQUENCY_BITS)
    sets = [near_dedup.Shingler()([t])[:2] for t in texts]
    packed = near_dedup.packed(spark.createDataFrame(list(enumerate(texts)), "node long, text string"))
    apart = spark.createDataFrame([(i, float(n.sum()), i, [7]) for i, (_, n) in enumerate(sets)], "node long, weight double, class_id long, bands array<long>")
    met = [(r["a"], r["b"]) for r in near_dedup.rare_meetings(apart, packed, inverse, 0.8).collect()]
    linked = {(i, j) for i in range(len(texts)) for j in range(i) if near_dedup.weighted_jaccard(sets[i], sets[j]) >= 0.8}
    assert len(linked) > 200 and linked <= set(met)
    assert len(met) <= 1.2 * len(set(met))


def test_pivots_go_on_while_they_join_classes(spark, monkeypatch):
    """Large classes of one bucket are joined by a few pivots, not by what lies between all of their texts."""
    ship(spark)
    dice = random.Random(4)
    texts = variants(dice, 500, 150, 0.08)
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    candidates, settled = [], near_dedup.settle

    def seen(df, name="table"):
        out = settled(df, name)
        if name == "candidates":
            candidates.append(out.count())
        return out

    monkeypatch.setattr(near_dedup, "settle", seen)
    monkeypatch.setattr(near_dedup, "PIVOTS", 8)
    monkeypatch.setattr(near_dedup, "LARGE", 32)
    got = {r["doc_id"]: r["class_id"] for r in near_dedup.classes_of(docs).collect()}
    want, links = all_pairs(texts)
    assert partition([got[i] for i in range(len(texts))]) == partition(want) and links > 1000
    assert len(candidates) > 3


def test_shingles_of_bytes(spark):
    """Words are those of the pattern, whatever bytes a character has, and texts don't run into each other."""
    dice = random.Random(6)
    texts = ["", " ", "a", "a b c d e f a b c d e", "\u00e9\x0b\u00fc\x0c\r", "\x1ca\x85b\u3000  c", *("".join(dice.choice(" ab\n\u00e9\x85\u3000") for _ in range(dice.randrange(60))) for _ in range(300))]
    column = pa.array(["left out", *texts, None])[1:]
    words, number = near_dedup.hashed_words(*flat(column))
    found = [re.findall(WORD, t) for t in texts] + [[]]
    assert number.tolist() == [len(w) for w in found] and words.tolist() == [xxhash.xxh3_64_intdigest(w.encode()) for text in found for w in text]
    codes, counts, starts = near_dedup.Shingler().of(*flat(column))
    for at, text in enumerate([*texts, ""]):
        one, times, _ = near_dedup.Shingler()([text])
        part = slice(starts[at], starts[at + 1])
        assert codes[part].tolist() == one.tolist() and counts[part].tolist() == times.tolist()
        assert counts[part].sum() == (max(len(found[at]) - 4, 1) if found[at] else 0)


def test_texts_are_not_sorted_to_keep_one(spark):
    ship(spark)
    docs = spark.createDataFrame([(1, "a b c"), (2, "a b c"), (3, "d")], "doc_id long, text string")
    kept = near_dedup.keep_one(docs)
    plan = kept._jdf.queryExecution().executedPlan().toString()
    assert "ShuffledHashJoin" in plan and "SortMergeJoin" not in plan
    assert sorted(r["doc_id"] for r in kept.collect()) == [1, 3]


def test_toxicity_sends_a_text_to_python_once(spark, monkeypatch):
    """The stage before: its workers and Arrow buffers are still there in this one."""
    from shelfspan.llm import toxicity

    sent, plain = [], toxicity.features

    def features(rows, *rest, **named):
        sent.append((rows.columns, plain(rows, *rest, **named)))
        raise InterruptedError

    monkeypatch.setattr(toxicity, "features", features)
    docs = spark.createDataFrame([(1, "en", "You fool", "s"), (2, None, None, "s")], "doc_id long, lang string, text string, source string")
    with pytest.raises(InterruptedError):
        toxicity.ToxicityModel({"fool": 2.0}, trees=object()).keep(docs)
    columns, out = sent[0]
    assert columns == out.columns[:-1] == ["_0", "_1", "_2", "_3"]
    assert sorted((r["_0"], r["_1"], r["_2"], r["_3"]) for r in out.collect()) == [(1, "en", "You fool", "s"), (2, None, None, "s")]


def test_null_and_repeated_ids(spark):
    """Different texts stay apart whatever their ids; one row of each class stays."""
    ship(spark)
    long = [" ".join(f"{name}{i}" for i in range(60)) for name in "abcdefg"]
    near_d = long[3].replace("d30 ", "other ")
    rows = [(None, long[0]), (None, long[1]), (None, long[2]), (1, long[3]), (1, long[4]), (2, near_d), (3, long[4]), (4, long[5]), (4, long[5]), (4, None), (4, ""), ((1 << 63) - 1, long[6]), (-(1 << 63), long[6])]
    docs = spark.createDataFrame([(i, t, f"s{n % 2}", n) for n, (i, t) in enumerate(rows)], "doc_id long, text string, _row string, class_id int")
    got = near_dedup.classes_of(docs).collect()
    assert len(got) == len(rows)
    by_id = {}
    for r in got:
        by_id.setdefault(r["doc_id"], set()).add(r["class_id"])
    assert len(by_id[None]) == 3 and len(by_id[1]) == 2 and by_id[2] < by_id[1] and by_id[3] < by_id[1] and by_id[2] != by_id[3]
    assert len(set().union(*by_id.values())) == 8 and by_id[-(1 << 63)] == by_id[(1 << 63) - 1] == {-(1 << 63)}
    kept = near_dedup.keep_one(docs)
    assert kept.columns == docs.columns
    left = [(r["doc_id"], r["text"] or "") for r in kept.collect()]
    assert sorted(left, key=str) == sorted([(None, long[0]), (None, long[1]), (None, long[2]), (1, long[3]), (1, long[4]), (4, long[5]), (4, ""), (-(1 << 63), long[6])], key=str)
    assert near_dedup.keep_one(docs.limit(0)).count() == 0 and near_dedup.classes_of(docs.limit(0)).count() == 0


@pytest.fixture(scope="module")
def stages(spark):
    """Every stage of the pipeline with its input and its written result."""
    import corpus_pipeline
    from shelfspan.session import settle

    docs = spark.read.parquet(f"{FOLDER}/documents.parquet")
    done = {}
    for name, stage in corpus_pipeline.STAGES:
        out = settle(stage(spark, docs, FOLDER), name)
        done[name] = (docs, out)
        docs = out
    return done


def test_pipeline_toxicity(spark, stages):
    """Labelled toxic documents go, others stay; kept rows are whole."""
    before, after = stages["toxicity"]
    labels = {r["doc_id"]: r["toxic"] for r in spark.read.parquet(f"{FOLDER}/labels.parquet").collect()}
    kept = {r["doc_id"] for r in after.select("doc_id").collect()}
    every = {r["doc_id"] for r in before.select("doc_id").collect()}
    bad = {i for i in every if labels.get(i) == 1}
    clean = {i for i in every if labels.get(i) == 0}
    assert len(bad & kept) <= 0.05 * len(bad) and len(clean - kept) <= 0.02 * len(clean)
    assert after.exceptAll(before).isEmpty()


def test_pipeline_near_dedup(stages):
    before, after = stages["near_dedup"]
    rows = before.orderBy("doc_id").collect()
    want, _ = all_pairs([r["text"] or "" for r in rows])
    heads = {rows[at]["doc_id"] for at in want}
    assert {r["doc_id"] for r in after.collect()} == heads and after.count() == len(heads)


def test_pipeline_secrets_and_mix(stages):
    before, after = stages["secret_scan"]
    was, now = ({r["doc_id"]: r["text"] for r in t.collect()} for t in (before, after))
    assert was.keys() == now.keys()
    changed = [i for i in was if was[i] != now[i]]
    assert changed and all("<SECRET>" in now[i] for i in changed)
    before, after = stages["source_mix"]
    assert {r["doc_id"] for r in after.collect()} <= now.keys() and after.columns == before.columns


def test_pipeline_pieces(stages):
    before, after = stages["sentencepiece"]
    assert after.count() == before.count()
    coder = pieces.agenda(pieces.vocabulary_path("piece_bpe_32k.model"))
    texts = {r["doc_id"]: r["text"] or "" for r in before.collect()}
    for r in after.collect():
        assert r["ids"] == coder.library.encode(texts[r["doc_id"]], add_bos=True, add_eos=True) and r["decoded"] == coder.library.decode(r["ids"])


def test_pipeline_run_is_its_stages(spark, stages):
    import corpus_pipeline

    out = corpus_pipeline.run(spark, FOLDER)
    assert sorted(r["ids_sha256"] for r in out.collect()) == sorted(r["ids_sha256"] for r in stages["sentencepiece"][1].collect())

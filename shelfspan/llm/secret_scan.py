"""Secret scans: candidates by pattern, false positives removed by a random forest.

Candidates are unbroken strings of 16 characters or more with letters and
digits, and any value of six behind a word that names a secret. An equals sign
ends a name and is part of a candidate as padding only. The forest sees their
length, character classes and transitions, the share that dictionary words
cover, signs of paths, hosts and identifiers, and the words around them. It is
fitted on labelled findings, rows of ``before, candidate, after, label``, which
the same search finds in whole labelled lines.
DataFrame functions and JVM model stages only.
"""

from __future__ import annotations

from pyspark.ml.classification import RandomForestClassifier
from pyspark.ml.feature import VectorAssembler
from pyspark.ml.functions import vector_to_array
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from shelfspan.session import settle

LETTERS = r"A-Za-z0-9_\-+/.~"
LONG = rf"(?<![{LETTERS}])(?=[A-Za-z_\-+/.~]*[0-9])(?=[0-9_\-+/.~]*[A-Za-z])[{LETTERS}]{{16,}}={{0,2}}"
NAME = r"""(?i:password|passwd|pwd|passphrase|secret|token|api[_\-]?key|access[_\-]?key)["']?[ \t]{0,2}[:=][ \t]{0,2}["']?"""
#: The shorter look back comes first and rules out nearly every place.
NAMED = rf"""(?<=[:= \t"'])(?<=[:=][ \t]{{0,2}}["']?)(?<={NAME})(?![\s"'])"""
CANDIDATE = rf"{NAMED}[^\s\"'`,;&<>()\[\]{{}}]{{6,}}|{LONG}"
BEFORE, AFTER = 48, 24
THRESHOLD = 0.5
TREES, DEPTH, SEED = 40, 8, 11
#: Labelled findings are this many at most, chosen by a hash of their values.
SAMPLE_ROWS = 20_000
MASK = "<SECRET>"
# Words that strings made by people contain.
DICTIONARY = (
    "example sample test dummy placeholder change your here token secret password key config version release build file image photo document chapter section index "
    "page static assets mail user admin host local server client data date time name value default public private http https www com org net html json text module "
    "package library system service account number order item report project international information the and for with from that this are was not have"
).split()
ASSIGNED = r"""(?i)(secret|token|passw(or)?d|passwd|pwd|api[_\-]?key|access[_\-]?key|auth\w*|credential\w*|private[_\-]?key|bearer|client[_\-]?secret)["'\s:=>]*$"""
HASHED = r"(?i)(commit|sha-?\d*|md5\w*|checksum|hash|digest|uuid|guid|revision|version|build|etag|integrity|file|image|href|src|path|page)\W*$"


def texts_around(text: Column) -> Column:
    """Candidates of a text in order, each with the text before and behind it."""
    parts = F.split(text, CANDIDATE)
    found = F.regexp_extract_all(text, F.lit(CANDIDATE), F.lit(0))
    return F.transform(
        found,
        lambda c, i: F.struct(
            F.right(F.get(parts, i), F.lit(BEFORE)).alias("before"), c.alias("candidate"), F.substring(F.get(parts, i + 1), 1, AFTER).alias("after")
        ),
    )


def candidates(docs: DataFrame) -> DataFrame:
    """``doc_id, text_key, place, before, candidate, after``: one row per candidate."""
    rows = docs.select("doc_id", "text").where(F.col("text").rlike(CANDIDATE))
    rows = rows.select("doc_id", F.xxhash64("text").alias("text_key"), F.posexplode(texts_around(F.col("text"))).alias("place", "found"))
    return rows.select("doc_id", "text_key", "place", "found.*")


def feature_columns() -> dict[str, Column]:
    """The features of one candidate; all are numbers, whatever the strings."""
    c, low = F.col("candidate"), F.lower("candidate")
    n = F.greatest(F.length(c), F.lit(1)).cast("double")
    count = lambda pattern, of=c: F.regexp_count(of, F.lit(pattern)).cast("double")
    flag = lambda pattern, of: F.coalesce(of.rlike(pattern), F.lit(False)).cast("double")
    chars = F.array_distinct(F.split(c, ""))
    share = lambda x: (F.length(c) - F.length(F.replace(c, x, F.lit("")))) / n
    entropy = F.aggregate(F.filter(chars, lambda x: F.length(x) > 0), F.lit(0.0), lambda total, x: total - share(x) * F.log2(share(x)))
    words = "|".join(sorted(DICTIONARY, key=lambda w: (-len(w), w)))
    return {
        "length": F.least(n, F.lit(200.0)),
        "digit_share": count("[0-9]") / n,
        "upper_share": count("[A-Z]") / n,
        "lower_share": count("[a-z]") / n,
        "mark_share": count(r"[_\-+/=.~]") / n,
        "class_changes": count("(?<=[A-Za-z])(?=[0-9])|(?<=[0-9])(?=[A-Za-z])|(?<=[a-z])(?=[A-Z])|(?<=[A-Z])(?=[a-z])") / n,
        "vowel_changes": count("(?<=[aeiou])(?=[b-df-hj-np-tv-z])|(?<=[b-df-hj-np-tv-z])(?=[aeiou])", low) / n,
        "rare_pairs": count("[bcdfghjklmnpqrstvwxz]{4,}", low) / n,
        "entropy": entropy,
        "distinct_share": F.size(chars) / n,
        "dictionary_share": (n - F.length(F.regexp_replace(low, f"({words})", ""))) / n,
        "hex": flag(r"^(0x)?[0-9A-Fa-f]+$", c),
        "known_prefix": flag(r"^(AKIA|ASIA|ghp_|gho_|ghs_|github_pat_|sk_live_|sk-|xox[abp]-|AIza|glpat-|eyJ)", c),
        "uuid": flag(r"^[0-9A-Fa-f]{8}-[0-9A-Fa-f]{4}-[0-9A-Fa-f]{4}-[0-9A-Fa-f]{4}-[0-9A-Fa-f]{12}$", c),
        "placeholder": flag(r"example|change|your|xxxx|dummy|sample|placeholder|1234|abcd", low),
        "slashes": count("/"),
        "points": count(r"\."),
        "hyphens": count(r"[\-_]"),
        "ending": flag(r"\.(com|org|net|io|html?|py|js|css|txt|json|xml|png|jpe?g|gif|zip|gz|pdf|md)$", low),
        "assigned": flag(ASSIGNED, F.col("before")),
        "hash_named": flag(HASHED, F.col("before")),
        "sign_before": flag(r"[:=]\s*[\"']?$", F.col("before")),
        "quote_before": flag(r"[\"'`]$", F.col("before")),
        "quote_after": flag(r"^[\"'`]", F.col("after")),
        "address_before": flag(r"[@/]$", F.col("before")),
    }


def labelled_findings(spark: SparkSession, rows_wanted: int = 6_000, first: int = 0) -> DataFrame:
    """Labelled findings in lines made from public key formats and from common false alarms.

    The lines are searched as texts are, so the forest learns what it will see.
    Every row is a function of its number, counted from ``first``, so reruns
    agree and other numbers give other values.
    """
    n = F.col("id")
    hashed = lambda salt, bits=256: F.sha2(F.concat(F.lit(salt), n.cast("string")), bits)
    hex40, hex64, hex32 = F.substring(hashed("a"), 1, 40), hashed("b"), F.md5(F.concat(F.lit("c"), n.cast("string")))
    base = F.regexp_replace(F.base64(F.unhex(hashed("d"))), "=+$", "")
    mixed = F.regexp_replace(F.base64(F.unhex(hashed("e", 512))), "[+/=]", "")
    uuid = F.concat_ws("-", *[F.substring(hex32, s, k) for s, k in ((1, 8), (9, 4), (13, 4), (17, 4), (21, 12))])
    num = lambda m: F.pmod(n, F.lit(m)).cast("string")
    text = lambda *parts: F.concat(*[F.lit(p) if isinstance(p, str) else p for p in parts])
    filler = F.element_at(F.array(*[F.lit(w) for w in ("and then of ", "| ", "the end.\n", "unter der ", "", "que la ", "IN THE!! ", "of### ")]), (F.pmod(F.xxhash64(n), F.lit(8)) + 1).cast("int"))
    word = lambda *words: F.element_at(F.array(*[F.lit(w) for w in words]), (F.pmod(F.xxhash64(n, F.lit("w")), F.lit(len(words))) + 1).cast("int"))
    letters = F.substring(F.regexp_replace(mixed, "[0-9]", ""), 1, 12)
    people = text(word("hunter", "dragon", "sommer", "monkey", "letmein", "qwerty"), num(97), word("!", "secret", "pass", "x", "xyz"))
    true = [
        ('token = "', hex40, '" of'), ('TOKEN = "', F.upper(hex40), '"!!'), ("api_key: ", hex32, "\n"), ('"client_secret": "', base, '",'),
        ("password=", F.substring(mixed, 1, 20), "\n"), ("aws_access_key_id = ", text("AKIA", F.upper(F.substring(hex40, 1, 16))), "\n"),
        ("export AWS_SECRET_ACCESS_KEY=", F.substring(mixed, 1, 40), "\n"), ("GITHUB_TOKEN=", text("ghp_", F.substring(mixed, 1, 36)), " "),
        ("Authorization: Bearer ", F.substring(mixed, 1, 48), "\n"), ("secret = '", hex64, "'"), ('auth_token="', hex64, '" '), ("the key is ", text("sk_live_", F.substring(mixed, 1, 24)), "."),
        ("GET https://api.example.com/v1/items?token=", hex40, " HTTP"), ("password=", people, "\n"), ('password = "', people, '"'), ("passwd: ", F.substring(mixed, 1, 9), "\n"),
        ('secret = "', letters, '"'), ("DB_PASSWORD=", F.substring(mixed, 1, 10), "\n"), ("token=", text(base, "="), " "),
    ]
    false = [
        ("commit ", hex40, "\n"), ("sha256: ", hex64, "\n"), ("md5sum ", hex32, "  file"), ("uuid=", uuid, "&"), ("request ", uuid, " was"), ("checksum=", hex64, "\n"), ("etag: ", hex32, "\n"),
        ('token = "', text("your_token_goes_here_", num(10)), '"'), ("password=", text("example_password_", num(1000)), "\n"), ("api_key: ", text("xxxxxxxxxxxxxxxx", num(10)), "\n"),
        ("write to user@", text("mail", num(10), ".example.com"), " or"), ('href="/', text("static/images/photo_", num(900), ".png"), '"'),
        ("see ", text("document_version_2.", num(10), ".1-release"), " for"), ("in ", text("chapter-", num(30), "-section-", num(7)), ","), ("word ", text("internationalization", num(100)), " and"),
        ("open ", text("https/www.example.org/page/", num(5000), ".html"), " now"), ("build ", text("build_2024_01_17_release", num(10)), " ok"), ("from ", text("mail", num(10), ".example.com"), " to"),
        ("password: ", word("required", "optional", "string", "invalid", "incorrect", "changeme", "undefined", "password", "expired"), "\n"), ("token = ", word("settings.token", "process.env.TOKEN", "request.headers", "self.token", "getenv", "config.token"), "\n"),
        ("secret: ", word("example", "not set", "secret", "hidden", "redacted", "********", "unknown"), " and"), ("api_key=", word("YOUR_API_KEY", "your-key-here", "xxxxxxxx", "$API_KEY"), "\n"),
    ]
    rules = [(b, c, a, 1.0) for b, c, a in true] + [(b, c, a, 0.0) for b, c, a in false]
    made = F.array(*[F.struct(text(filler, b, c, a).alias("line"), text(c).alias("value"), F.lit(y).alias("label")) for b, c, a, y in rules])
    lines = spark.range(first, first + max(1, rows_wanted // len(rules))).select(F.explode(made).alias("x")).select("x.*")
    found = lines.select("value", "label", F.explode(texts_around(F.col("line"))).alias("found")).select("value", "label", "found.*")
    # Of a line only the value itself is a secret, whole or with what it hangs on to.
    label = F.when(F.contains("candidate", "value"), F.col("label")).otherwise(0.0)
    return found.select("before", "candidate", "after", label.alias("label"))


class Scanner:
    """A fitted forest and its threshold."""

    def __init__(self, forest, threshold: float = THRESHOLD):
        self.forest, self.threshold = forest, threshold

    def score(self, rows: DataFrame) -> DataFrame:
        """``rows`` with ``score`` instead of the surrounding text, and ``is_secret``."""
        kept = [c for c in rows.columns if c not in ("before", "after")]
        columns = {f"f_{k}": v for k, v in feature_columns().items()}
        vectors = VectorAssembler(inputCols=list(columns), outputCol="f_vector", handleInvalid="keep").transform(rows.withColumns(columns))
        self.forest.setFeaturesCol("f_vector").setPredictionCol("f_prediction").setProbabilityCol("f_probability").setRawPredictionCol("f_raw")
        scored = self.forest.transform(vectors).withColumn("score", vector_to_array("f_probability")[1])
        return scored.select(*kept, "score").withColumn("is_secret", F.col("score") >= self.threshold)


def fit(findings: DataFrame, sample_rows: int = SAMPLE_ROWS, trees: int = TREES, depth: int = DEPTH, threshold: float = THRESHOLD) -> Scanner:
    """Fit the forest on labelled findings ``before, candidate, after, label``; null strings count as empty."""
    named = findings.select(*[F.coalesce(c, F.lit("")).alias(c) for c in ("before", "candidate", "after")], F.col("label").cast("double").alias("label")).where("label in (0, 1)")
    n = named.count()
    share = 1_000_000 if n <= sample_rows else 1_000_000 * sample_rows // n
    chosen = named.where(F.pmod(F.xxhash64("before", "candidate", "after"), F.lit(1_000_000)) < share)
    columns = {f"f_{k}": v for k, v in feature_columns().items()}
    ready = settle(chosen.select("label", *[v.alias(k) for k, v in columns.items()]), "findings")
    vectors = VectorAssembler(inputCols=list(columns), outputCol="f_vector", handleInvalid="keep").transform(ready)
    forest = RandomForestClassifier(featuresCol="f_vector", labelCol="label", numTrees=trees, maxDepth=depth, seed=SEED)
    return Scanner(forest.fit(vectors), threshold)


def scan(docs: DataFrame, scanner: Scanner) -> DataFrame:
    """One row per candidate of each different (doc_id, text): ``doc_id, text_key, place, candidate, score, is_secret``.

    Null and short texts have none. Repeated rows give their candidates once.
    """
    return scanner.score(candidates(docs)).dropDuplicates(["doc_id", "text_key", "place"])


def summary(docs: DataFrame, scanner: Scanner) -> DataFrame:
    """``doc_id, n_candidates, n_secrets, fingerprints`` of every row; fingerprints are SHA-256, sorted, without repeats. Null ids count like others."""
    found = scan(docs, scanner).groupBy("doc_id", "text_key").agg(
        F.count(F.lit(1)).alias("n_candidates"),
        F.sum(F.col("is_secret").cast("long")).alias("n_secrets"),
        F.array_sort(F.collect_set(F.when(F.col("is_secret"), F.sha2("candidate", 256)))).alias("fingerprints"),
    )
    keyed = docs.select("doc_id", F.xxhash64("text").alias("text_key"))
    found = found.withColumnsRenamed({"doc_id": "found_id", "text_key": "found_key"})
    joined = keyed.join(found, F.col("doc_id").eqNullSafe(F.col("found_id")) & (F.col("text_key") == F.col("found_key")), "left")
    zero = lambda c: F.coalesce(c, F.lit(0)).cast("long").alias(c)
    return joined.select("doc_id", zero("n_candidates"), zero("n_secrets"), F.coalesce("fingerprints", F.array().cast("array<string>")).alias("fingerprints"))


def redact(docs: DataFrame, scanner: Scanner, mask: str = MASK) -> DataFrame:
    """``docs`` with every secret replaced by ``mask``; all rows and columns stay, in any order.

    Only rows with a secret are joined, so only their texts move. ``n_chars``,
    where present, follows the new text.
    """
    flags = scan(docs, scanner).groupBy("doc_id", "text_key").agg(
        F.array_sort(F.collect_list(F.struct("place", "is_secret"))).alias("_flags"), F.max("is_secret").alias("_any")
    ).where("_any").drop("_any")
    has = F.coalesce(F.col("text").rlike(CANDIDATE), F.lit(False))
    # Rows travel as one column, so columns of any name may come along.
    some = docs.where(has).select(F.struct("*").alias("row"), F.col("doc_id").alias("id"), F.xxhash64("text").alias("key"), F.col("text").alias("whole"))
    joined = some.join(flags, F.col("id").eqNullSafe(F.col("doc_id")) & (F.col("key") == F.col("text_key")), "left")
    parts = F.split("whole", CANDIDATE)
    found = F.regexp_extract_all("whole", F.lit(CANDIDATE), F.lit(0))
    shown = F.transform(found, lambda c, i: F.concat(F.when(F.get(F.col("_flags"), i)["is_secret"], F.lit(mask)).otherwise(c), F.get(parts, i + 1)))
    clean = F.when(F.col("_flags").isNull(), F.col("whole")).otherwise(F.concat(F.get(parts, F.lit(0)), F.array_join(shown, "")))
    fresh = joined.withColumn("row", F.col("row").withField("text", clean))
    if "n_chars" in docs.columns:
        length = F.when(F.col("_flags").isNull(), F.col("row.n_chars")).otherwise(F.length("row.text")).cast(docs.schema["n_chars"].dataType)
        fresh = fresh.withColumn("row", F.col("row").withField("n_chars", length))
    return docs.where(~has).unionByName(fresh.select("row.*"))

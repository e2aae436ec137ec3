"""SQL that the queries of this subpackage must agree with."""

from __future__ import annotations

from shelfspan.llm import divergence, fingerprints, licences, mixing

WORDS = r"'[^\x20\x09-\x0D]+'"


def mix_sql() -> str:
    """The mix: water level over sources, then epochs and the fraction by exponential keys."""
    weights = " ".join(f"WHEN {i} THEN {w}" for i, w in enumerate(mixing.WEIGHTS))
    return f"""
WITH w AS (SELECT doc_id, max(CASE quality WHEN 1 THEN 2.0 WHEN 0 THEN 0.5 ELSE 1.0 END) AS weight FROM labels GROUP BY doc_id),
d AS (SELECT documents.doc_id, source, coalesce(len(regexp_extract_all(text, {WORDS})), 0)::BIGINT AS size,
        -ln((('0x' || substr(md5(coalesce(documents.doc_id::VARCHAR, md5(coalesce(text, ''))) || '|0'), 1, 13))::BIGINT + 0.5::DOUBLE) / 4503599627370496.0::DOUBLE) / coalesce(weight, 1.0)::DOUBLE AS key
      FROM documents LEFT JOIN w ON documents.doc_id = w.doc_id),
s AS (SELECT source, sum(size)::BIGINT AS source_size, row_number() OVER (ORDER BY source IS NULL, source) - 1 AS place FROM d GROUP BY source),
c AS (SELECT *, CASE place % {len(mixing.WEIGHTS)} {weights} END AS weight FROM s),
r AS (SELECT *, source_size * {mixing.MOST} AS cap, (source_size * {mixing.MOST})::DOUBLE / weight AS ratio FROM c),
p AS (SELECT *, coalesce(sum(cap) OVER before, 0) AS caps, coalesce(sum(weight) OVER before, 0) AS weights FROM r
      WINDOW before AS (ORDER BY ratio, place ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING)),
l AS (SELECT *, ((SELECT sum(source_size) FROM r) - caps)::DOUBLE / ((SELECT sum(weight) FROM r) - weights)::DOUBLE AS level FROM p),
t AS (SELECT source, source_size, least(cap::DOUBLE, coalesce((SELECT level FROM l WHERE level <= ratio ORDER BY ratio, place LIMIT 1), 0) * weight) AS target FROM l),
o AS (SELECT d.*, source_size, target, sum(size) OVER (PARTITION BY d.source ORDER BY key, doc_id ROWS UNBOUNDED PRECEDING) - size AS before,
        CASE WHEN source_size > 0 THEN floor(target / source_size) ELSE 0 END AS epochs
      FROM d JOIN t ON d.source IS NOT DISTINCT FROM t.source)
SELECT doc_id, size, source_size, target,
  (CASE WHEN size > 0 THEN epochs + CASE WHEN 2 * before + size <= 2 * (target - epochs * source_size) THEN 1 ELSE 0 END ELSE 0 END * size)::BIGINT AS taken
FROM o"""


def licence_sql() -> str:
    """Sentences by regular expressions, identifiers by a list of values, rules by positions in order."""
    values = ", ".join(f"('{s}', '{k}')" for k, s in licences.SENTENCES.items())
    rules = ", ".join(f"('{r}', '{lic}', {i}, {[*wanted]!r})" for i, (r, (lic, wanted)) in enumerate(licences.RULES.items()))
    covers = ", ".join(f"('{short}', '{longer}')" for short, held in licences.covering().items() for longer in held)
    cut = r"string_split(regexp_replace({0}, '\.+ ', chr(10), 'g'), chr(10))"
    drop = f"regexp_replace({{0}}, '{licences.DROP}', ' ', 'g')"
    norm = r"regexp_replace(regexp_replace(s, '^[ .\-]+|[ .\-]+$', '', 'g'), '[ .\-]* [ .\-]*', ' ', 'g')"
    stops = rf"regexp_replace(regexp_replace(regexp_replace(lower(text), '{licences.BARE}', chr(10) || chr(10), 'g'), '{licences.MARKS}', '\1', 'g'), '{licences.STOPS}', '. \1', 'g')"
    unwrapped = "regexp_replace(" + drop.format(f"regexp_replace(p, '{licences.BLANK}', '. ', 'g')") + ", ' ?' || chr(10) || ' ?', ' ', 'g')"
    # A rule of n sentences matches if, place by place, each next sentence is found behind the one before.
    return f"""
WITH RECURSIVE known(sentence, sid) AS (VALUES {values}), rules(rule_id, licence, rank, wanted) AS (VALUES {rules}), covers(shorter, longer) AS (VALUES {covers}),
rows AS (SELECT row_number() OVER () AS rid, doc_id, text FROM documents),
plain AS (SELECT rid, {stops} AS p FROM rows WHERE regexp_matches(text, '{licences.ANCHOR}')),
cuts AS (SELECT rid, 0 AS kind, {cut.format(drop.format('p'))} AS parts FROM plain
  UNION ALL SELECT rid, 1, {cut.format(unwrapped)} FROM plain),
each AS (SELECT rid, kind, generate_subscripts(parts, 1) AS place, unnest(parts) AS s FROM cuts),
hits AS (SELECT rid, kind, place, sid FROM (SELECT rid, kind, place, {norm} AS sentence FROM each) JOIN known USING (sentence)),
ids AS (SELECT rid, string_agg(sid, ',' ORDER BY kind, place) AS sentence_ids, count(*) AS n_sentences
  FROM (SELECT rid, sid, min(kind) AS kind, min_by(place, (kind, place)) AS place FROM hits GROUP BY rid, sid) GROUP BY rid),
walk(rid, kind, rule_id, step, place) AS (
  SELECT rid, kind, rule_id, 1, min(place) FROM hits JOIN rules ON sid = wanted[1] GROUP BY ALL
  UNION ALL
  SELECT h.rid, h.kind, w.rule_id, w.step + 1, h.place
  FROM walk w JOIN rules r ON w.rule_id = r.rule_id
  JOIN hits h ON h.rid = w.rid AND h.kind = w.kind AND h.place > w.place AND h.sid = wanted[w.step + 1]),
every AS (SELECT DISTINCT rid, rules.rule_id, licence, rank FROM walk JOIN rules ON walk.rule_id = rules.rule_id AND step = len(wanted)),
matched AS (SELECT * FROM every e WHERE NOT EXISTS (SELECT 1 FROM covers JOIN every o ON o.rule_id = longer WHERE shorter = e.rule_id AND o.rid = e.rid)),
named AS (SELECT rid, string_agg(rule_id, ',' ORDER BY rank) AS rule_ids, string_agg(DISTINCT licence, ',' ORDER BY licence) AS licences FROM matched GROUP BY rid)
SELECT doc_id, coalesce(n_sentences, 0)::BIGINT AS n_sentences, coalesce(sentence_ids, '') AS sentence_ids, coalesce(rule_ids, '') AS rule_ids, coalesce(licences, '') AS licences
FROM rows LEFT JOIN ids USING (rid) LEFT JOIN named USING (rid)"""


def fingerprint_sql() -> str:
    """Sketches as sorted lists; both lists hold all hashes up to ``known``."""
    k, n = fingerprints.K, fingerprints.SHINGLE

    def sketch(text: str, name: str) -> str:
        words = f"coalesce(regexp_extract_all({text}, {WORDS}), [])"
        hashes = f"list_transform(range(1, greatest(len(w) - {n}, 0) + 2), lambda i: substr(md5(array_to_string(w[i:i + {n - 1}], ' ')), 1, 16))"
        return f"(SELECT CASE WHEN len(w) = 0 THEN [] ELSE list_sort(list_distinct({hashes}))[1:{k}] END FROM (SELECT {words} AS w)) AS {name}"

    def alike(a: str, b: str) -> str:
        full = [f"CASE WHEN len({x}) >= {k} THEN {x}[-1] ELSE 'g' END" for x in (a, b)]
        known = f"least({full[0]}, {full[1]})"
        both = f"len(list_filter(list_intersect({a}, {b}), lambda x: x <= {known}))"
        either = f"len(list_filter(list_distinct(list_concat({a}, {b})), lambda x: x <= {known}))"
        return f"CASE WHEN {either} = 0 THEN 1.0::DOUBLE ELSE {both}::DOUBLE / {either} END"

    last = f"(('0x' || substr(sketch[-1], 1, 13))::BIGINT::DOUBLE / {1 << 52}::DOUBLE)"
    full = [f"CASE WHEN len({x}) >= {k} THEN {x}[-1] ELSE 'g' END" for x in ("sketch", "edited_sketch")]
    own = f"len(list_filter(sketch, lambda x: x <= least({full[0]}, {full[1]})))"
    shared = f"len(list_filter(list_intersect(sketch, edited_sketch), lambda x: x <= least({full[0]}, {full[1]})))"
    return f"""
WITH d AS (SELECT row_number() OVER (ORDER BY doc_id NULLS LAST) AS r, doc_id, coalesce(text, '') AS text, length(coalesce(text, '')) AS n FROM documents),
s AS (SELECT *, {sketch("text", "sketch")} FROM d),
p AS (SELECT s.*, x.text AS next_text, x.sketch AS next_sketch FROM s JOIN s x ON x.r = s.r % (SELECT count(*) FROM d) + 1),
e AS (SELECT *, substr(text, 1, n - n // 4) || substr(next_text, 1, n // 4) AS edited FROM p),
f AS (SELECT *, {sketch("edited", "edited_sketch")} FROM e)
SELECT doc_id, n::BIGINT AS n_chars, sha256(edited) AS edited_sha256, array_to_string(sketch, '') AS fingerprint, array_to_string(edited_sketch, '') AS edited_fingerprint,
  {alike("sketch", "edited_sketch")} AS near_edited, {alike("sketch", "next_sketch")} AS near_next,
  CASE WHEN len(sketch) < {k} THEN len(sketch)::DOUBLE ELSE {k - 1}::DOUBLE / {last} END AS n_shingles,
  CASE WHEN {own} = 0 THEN 1.0::DOUBLE ELSE {shared}::DOUBLE / {own} END AS contained_in_edited
FROM f"""


def divergence_sql() -> str:
    """Counts of terms by regular expression; exact arithmetic in HUGEINT."""
    upper = "ABCDEFGHIJKLMNOPQRSTUVWXYZ"
    share = f"(1 + {divergence.SCALE}::HUGEINT * (coalesce(n, 0) + {divergence.PRIOR}) // (total + {divergence.PRIOR}::HUGEINT * v))::BIGINT"
    return rf"""
WITH d AS (SELECT row_number() OVER () AS r, coalesce(text, '') AS text, coalesce(lang, '') AS lang, coalesce(source, '') AS source FROM documents),
t AS (SELECT r, lang, source, translate(unnest(regexp_extract_all(text, '[^\x00-\x40\x5B-\x60\x7B-\x7F]+')), '{upper}', '{upper.lower()}') AS term FROM d),
kept AS (SELECT lang, term FROM t GROUP BY ALL HAVING count(DISTINCT r) >= {divergence.LEAST_DOCS}),
c AS (SELECT lang, source, term, count(*) AS n FROM t JOIN kept USING (lang, term) GROUP BY ALL),
v AS (SELECT lang, count(term) AS v FROM (SELECT DISTINCT lang FROM d) LEFT JOIN kept USING (lang) GROUP BY lang),
g AS (SELECT lang, source, coalesce(sum(n), 0)::HUGEINT AS total, v FROM (SELECT DISTINCT lang, source FROM d) LEFT JOIN c USING (lang, source) JOIN v USING (lang) GROUP BY lang, source, v),
p AS (SELECT g.lang, g.source, kept.term, coalesce(n, 0) AS n, {share} AS p FROM g JOIN kept USING (lang) LEFT JOIN c ON (c.lang, c.source, c.term) = (g.lang, g.source, kept.term)),
lc AS (SELECT lang, term, sum(n) AS n FROM c GROUP BY ALL),
lp AS (SELECT lang, term, {share} AS q FROM lc JOIN (SELECT lang, sum(total)::HUGEINT AS total, any_value(v) AS v FROM g GROUP BY lang) USING (lang)),
pairs AS (SELECT a.lang, a.source, b.source AS item, coalesce(sum(abs(pa.p - pb.p)), 0)::BIGINT AS value
  FROM g a JOIN g b ON a.lang = b.lang AND a.source <> b.source
  LEFT JOIN p pa ON pa.lang = a.lang AND pa.source = a.source LEFT JOIN p pb ON pb.lang = a.lang AND pb.source = b.source AND pb.term = pa.term GROUP BY ALL),
terms AS (SELECT lang, source, term AS item, p - q AS value FROM p JOIN lp USING (lang, term) WHERE p.n > 0 AND p > q),
both_parts AS (SELECT *, 'pair' AS part FROM pairs UNION ALL BY NAME SELECT *, 'term' AS part FROM terms)
SELECT lang, source, part, item, value::BIGINT AS value, rank::INT AS rank
FROM (SELECT *, row_number() OVER (PARTITION BY lang, source, part ORDER BY value DESC, item) AS rank FROM both_parts)
WHERE part = 'pair' OR rank <= {divergence.TOP}"""


ORACLES = {
    "op2_source_mix": mix_sql(),
    "op9_licence_scan": licence_sql(),
    "op11_fingerprints": fingerprint_sql(),
    "op12_source_divergence": divergence_sql(),
}

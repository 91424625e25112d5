"""SQL for DuckDB that gives the rows of the queries which SQL can express."""

from __future__ import annotations

from churnlake.llm import decontamination, license_scan, mixing, placement, quality_rules

WORDS = r"regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+')"

MIXED = rf"""
WITH d AS (
  SELECT doc_id, source, CAST(len({WORDS}) AS BIGINT) AS size,
         md5('{mixing.SEED}:' || coalesce(CAST(doc_id AS VARCHAR), '')) AS pick
  FROM __docs__),
s AS (
  SELECT source, CAST(sum(size) AS HUGEINT) AS source_size,
         ([{', '.join(map(str, mixing.WEIGHTS))}])[(row_number() OVER (ORDER BY source NULLS LAST) - 1) % {len(mixing.WEIGHTS)} + 1] AS w,
         row_number() OVER (ORDER BY source NULLS LAST) AS rank
  FROM d GROUP BY source),
o AS (
  SELECT *, {mixing.MAX_EPOCHS} * source_size AS cap, sum(source_size) OVER () AS total,
         coalesce(sum({mixing.MAX_EPOCHS} * source_size) OVER (ORDER BY {mixing.MAX_EPOCHS} * source_size * 6 // w, rank
                  ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS stopped,
         sum(w) OVER (ORDER BY {mixing.MAX_EPOCHS} * source_size * 6 // w, rank
                  ROWS BETWEEN CURRENT ROW AND UNBOUNDED FOLLOWING) AS open_weight
  FROM s),
l AS (SELECT *, (total - stopped) * w > cap * open_weight AS above FROM o),
m AS (SELECT *, min(stopped) FILTER (NOT above) OVER () AS gone, max(open_weight) FILTER (NOT above) OVER () AS sharing FROM l),
t AS (
  SELECT source, CAST(source_size AS BIGINT) AS source_size,
         CASE WHEN above THEN CAST(cap AS DOUBLE)
              ELSE CAST(w * (total - gone) AS DOUBLE) / CAST(sharing AS DOUBLE) END AS target FROM m),
q AS (
  SELECT *, CASE WHEN source_size > 0 THEN CAST(floor(target / source_size) AS BIGINT) ELSE 0 END AS whole FROM t),
r AS (SELECT *, greatest(0, CAST(floor(target) AS BIGINT) - whole * source_size) AS rest FROM q),
j AS (
  SELECT d.doc_id, d.source, d.size, r.source_size, r.target, r.whole, r.rest - coalesce(sum(d.size) OVER (
           PARTITION BY d.source ORDER BY d.pick, d.doc_id NULLS FIRST, d.size
           ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS room
  FROM d JOIN r ON d.source IS NOT DISTINCT FROM r.source)
"""

OP9 = MIXED.replace("__docs__", "documents") + """
SELECT doc_id, size, source_size, target, source,
       CAST(whole * size + greatest(0, least(size, room)) AS BIGINT) AS taken
FROM j"""

_S = " || ".join(f"chr({ord(c)})" for c in " \t\n\x0b\x0c\r")
_RULES = quality_rules.RULES


def _per_mille(part: str, whole: str) -> str:
    return f"CASE WHEN {whole} > 0 THEN CAST(least(1000, {part} * 1000 // {whole}) AS INTEGER) ELSE 0 END"


QUALITY = rf"""
WITH d AS (
  SELECT row_number() OVER () AS rid, doc_id, coalesce(lang, '') AS stratum, coalesce(text, '') AS text, {WORDS} AS w
  FROM __docs__),
g AS (
  SELECT rid, i, array_to_string(w[i:i + 4], ' ') AS g
  FROM (SELECT rid, w, unnest(range(1, len(w) - 3)) AS i FROM d WHERE len(w) >= 5)),
c AS (SELECT rid, i FROM g QUALIFY count(*) OVER (PARTITION BY rid, g) > 1),
n AS (SELECT rid, sum(covered) AS n FROM (
  SELECT rid, least(5, coalesce(lead(i) OVER (PARTITION BY rid ORDER BY i) - i, 5)) AS covered FROM c) GROUP BY rid),
a AS (
  SELECT d.rid, doc_id, stratum, CAST(len(w) AS BIGINT) AS n_words, CAST(coalesce(n.n, 0) AS BIGINT) AS n_repeat_words,
         CAST(length(translate(text, {_S}, '')) AS BIGINT) AS word_chars,
         CAST(length(text) - length(translate(text, '{quality_rules.SYMBOLS}', '')) AS BIGINT) AS n_symbols,
         CAST(length(regexp_replace(text, '[^\p{{Lu}}]+', '', 'g')) AS BIGINT) AS n_capitals,
         list_filter(string_split(text, chr(10)), lambda x: regexp_matches(x, '[^\x20\x09-\x0D]')) AS ls
  FROM d LEFT JOIN n ON d.rid = n.rid),
b AS (
  SELECT *, CAST(len(ls) AS BIGINT) AS n_lines, CAST(len(ls) - len(list_distinct(ls)) AS BIGINT) AS n_dup_lines,
         n_words < {quality_rules.MIN_WORDS} OR 100 * n_repeat_words > {quality_rules.MAX_REPEAT_PERCENT} * n_words AS base_failed
  FROM a),
m AS (
  SELECT *, {_per_mille('n_symbols', 'n_words')} AS symbols, {_per_mille('n_dup_lines', 'n_lines')} AS lines,
         {_per_mille('n_repeat_words', 'n_words')} AS repeats, {_per_mille('n_capitals', 'word_chars')} AS capitals
  FROM b),
known AS (
  SELECT doc_id, max(quality) AS good FROM labels WHERE quality IN (0, 1) AND doc_id IS NOT NULL
  GROUP BY doc_id HAVING min(quality) = max(quality)),
e AS (
  SELECT stratum, good, unnest([{', '.join(f"{{'rule': '{r}', 'value': {r}}}" for r in _RULES)}]) AS x
  FROM m JOIN known ON m.doc_id = known.doc_id WHERE NOT base_failed),
v AS (
  SELECT stratum, x.rule AS rule, x.value AS value, sum(good) AS good, sum(1 - good) AS bad FROM e GROUP BY ALL),
tests AS (SELECT greatest(1, count(*)) AS tests FROM (SELECT DISTINCT stratum, rule FROM v)),
losses AS (
  SELECT stratum, rule, value, sum(good) OVER (PARTITION BY stratum, rule) AS n,
         sum(good) OVER (PARTITION BY stratum, rule ORDER BY value DESC) AS lost,
         sum(bad) OVER (PARTITION BY stratum, rule ORDER BY value DESC) AS caught FROM v),
tail AS (
  SELECT n, k, sum(exp(lgamma(n + 1) - lgamma(k + 1) - lgamma(n - k + 1) + k * ln({quality_rules.ALPHA})
                       + (n - k) * ln(1 - {quality_rules.ALPHA}))) OVER (PARTITION BY n ORDER BY k) AS p
  FROM (SELECT n, unnest(range(0, CAST(least(n - 1, ceil(n * {quality_rules.ALPHA})) AS BIGINT) + 1)) AS k
        FROM (SELECT DISTINCT n FROM losses WHERE n > 0))),
allowed AS (SELECT n, max(k) AS k FROM tail, tests WHERE p <= {quality_rules.DELTA} / tests GROUP BY n),
best AS (
  SELECT stratum, rule, max(value) AS cutoff FROM (
    SELECT stratum, rule, value, caught - {quality_rules.PENALTY} * lost AS gain,
           max(caught - {quality_rules.PENALTY} * lost) OVER (PARTITION BY stratum, rule) AS top
    FROM losses JOIN allowed ON losses.n = allowed.n AND lost <= allowed.k
    WHERE value > 0 AND caught - {quality_rules.PENALTY} * lost > 0) WHERE gain = top GROUP BY stratum, rule),
judged AS (
  SELECT m.*, NOT base_failed AND NOT EXISTS (
    SELECT 1 FROM best WHERE best.stratum = m.stratum AND (
      {' OR '.join(f"(rule = '{r}' AND m.{r} >= cutoff)" for r in _RULES)})) AS kept FROM m)
"""

OP7 = QUALITY.replace("__docs__", "documents") + f"""
SELECT doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, base_failed, kept, {', '.join(_RULES)} FROM judged"""

OP10 = f"""
WITH RECURSIVE shards AS (
  SELECT row_number() OVER (ORDER BY name) - 1 AS i,
         CAST('0x' || substr(md5('offset:' || name), 1, 12) AS BIGINT) % {placement.TABLE_SIZE} AS o,
         CAST('0x' || substr(md5('skip:' || name), 1, 12) AS BIGINT) % {placement.TABLE_SIZE - 1} + 1 AS k, name
  FROM (SELECT 'shard-' || lpad(CAST(i AS VARCHAR), 5, '0') AS name FROM range({placement.SHARDS}) r(i))),
prefs AS (SELECT i, list_transform(range({placement.TABLE_SIZE}), lambda j: (o + j * k) % {placement.TABLE_SIZE}) AS p FROM shards),
fill AS (
  SELECT CAST(0 AS BIGINT) AS turn, list_transform(range({placement.TABLE_SIZE}), lambda j: CAST(-1 AS BIGINT)) AS slots
  UNION ALL
  SELECT turn + 1, slots[1:s] || [i] || slots[s + 2:] FROM (
    SELECT turn, slots, prefs.i AS i, list_filter(p, lambda x: slots[x + 1] = -1)[1] AS s
    FROM fill JOIN prefs ON prefs.i = turn % {placement.SHARDS} WHERE turn < {placement.TABLE_SIZE})),
done AS (SELECT slots FROM fill WHERE turn = {placement.TABLE_SIZE}),
lookup AS (SELECT unnest(range({placement.TABLE_SIZE})) AS slot, unnest(slots) AS i FROM done),
keyed AS (
  SELECT doc_id, CAST('0x' || substr(md5(coalesce(CAST(doc_id AS VARCHAR), '')), 1, 12) AS BIGINT) % {placement.TABLE_SIZE} AS slot
  FROM documents)
SELECT doc_id, keyed.slot, name AS shard FROM keyed JOIN lookup ON keyed.slot = lookup.slot JOIN shards ON shards.i = lookup.i"""


def _rule_sql() -> str:
    parts = []
    for rule, name, wanted in license_scan.RULES:
        longer = [o for o, _, t in license_scan.RULES if o != rule and set(wanted) < set(t)]
        pattern = r"\|(.*)\|".join(wanted)
        parts.append(
            f"SELECT rid, doc_id, '{rule}' AS rule, '{name}' AS license, CAST({len(wanted)} AS INTEGER) AS n_sentences, "
            f"CAST([{', '.join(repr(o) for o in longer)}] AS VARCHAR[]) AS longer "
            rf"FROM ids WHERE regexp_matches(ids, '\|{pattern}\|')")
    return " UNION ".join(parts)


OP3 = rf"""
WITH t AS (
  SELECT row_number() OVER () AS rid, doc_id, coalesce(text, '') AS text FROM documents),
readings AS (
  SELECT rid, doc_id, 0 AS reading, text FROM t UNION ALL SELECT rid, doc_id, 1, replace(text, chr(10), ' ') FROM t),
parts AS (
  SELECT rid, doc_id, reading, unnest(s) AS raw, unnest(range(len(s))) AS pos FROM (
    SELECT *, string_split(regexp_replace(text, '([.!?:;])\s+', '\1' || chr(10), 'g'), chr(10)) AS s FROM readings)),
known(sentence_id, sentence) AS (VALUES {', '.join(f"('{k}', '{v}')" for k, v in license_scan.SENTENCES.items())}),
ids AS (
  SELECT rid, doc_id, reading, '|' || string_agg(sentence_id, '||' ORDER BY pos) || '|' AS ids
  FROM parts JOIN known ON sentence = replace(trim(regexp_replace(
    regexp_replace(replace(lower(raw), '{license_scan.DOT}', ' '), '([0-9])\.([0-9])', '\1{license_scan.DOT}\2', 'g'),
    '[^\p{{L}}\p{{N}}{license_scan.DOT}]+', ' ', 'g')), '{license_scan.DOT}', '.')
  GROUP BY ALL),
m AS ({_rule_sql()})
SELECT doc_id, rule, license, n_sentences FROM m
WHERE NOT EXISTS (SELECT 1 FROM m AS o WHERE o.rid = m.rid AND list_contains(m.longer, o.rule))"""

_LOWER = r"regexp_extract_all(lower(coalesce(text, '')), '[^\x20\x09-\x0D]+')"
_SHINGLES = "list_transform(range(1, len(w) - 3), lambda i: array_to_string(w[i:i + 4], ' '))"
_PRINT = f"""(SELECT sum(CASE WHEN 2 * votes > n THEN CAST(1 AS BIGINT) << bit ELSE 0 END) FROM (
    SELECT bit, count(*) AS n, sum((CAST('0x' || substr(md5(word), 1, 15) AS BIGINT) >> bit) & 1) AS votes
    FROM (SELECT unnest(x.w) AS word) AS u, range({decontamination.BLOCKS * decontamination.BLOCK_BITS}) AS r(bit)
    GROUP BY bit))"""

LEAKS = rf"""
WITH items AS (
  SELECT item_id, len(w) AS size, w, {_SHINGLES} AS s
  FROM (SELECT item_id, {_LOWER} AS w FROM benchmark) WHERE len(w) >= 5),
wanted AS (SELECT DISTINCT size, unnest(s) AS g, unnest(range(len(s))) AS at FROM items),
d AS (SELECT DISTINCT doc_id, text, {_LOWER} AS w FROM __docs__),
grams AS (SELECT doc_id, text, w, unnest({_SHINGLES}) AS g, unnest(range(len(w) - 4)) AS at FROM d WHERE len(w) >= 5),
windows AS (
  SELECT DISTINCT doc_id, text, size, greatest(0, least(grams.at - wanted.at, len(w) - size)) AS start, w
  FROM grams JOIN wanted USING (g)),
cut AS (SELECT doc_id, text, size, start, w[start + 1:start + size] AS w FROM windows),
a AS (SELECT x.*, {_PRINT} AS print, {_SHINGLES.replace('w[', 'x.w[').replace('len(w)', 'len(x.w)')} AS s FROM cut AS x),
b AS (SELECT x.*, {_PRINT} AS print FROM items AS x),
pairs AS (
  SELECT a.doc_id, a.text, b.item_id, a.start, a.size, bit_count(xor(CAST(a.print AS BIGINT), CAST(b.print AS BIGINT))) AS hamming,
         list_sum(list_transform(list_distinct(a.s), lambda g: least(
           len(list_filter(a.s, lambda y: y = g)), len(list_filter(b.s, lambda y: y = g))))) AS common,
         len(a.s) + len(b.s) AS n_both
  FROM a JOIN b USING (size)),
close AS (
  SELECT *, CAST(common AS DOUBLE) / CAST(n_both - common AS DOUBLE) AS similarity FROM pairs
  WHERE hamming <= {decontamination.RADIUS} AND 100 * common >= {decontamination.SIMILARITY_PERCENT} * (n_both - common)),
found AS (
  SELECT * FROM close
  QUALIFY row_number() OVER (PARTITION BY doc_id, text, item_id ORDER BY similarity DESC, hamming, start) = 1)
"""

OP1 = LEAKS.replace("__docs__", "documents") + """
SELECT doc_id, item_id, CAST(start AS INTEGER) AS start, CAST(size AS INTEGER) AS n_words,
       CAST(hamming AS INTEGER) AS hamming, similarity FROM found"""

ORACLES = {
    "op1_decontamination": OP1,
    "op3_license_scan": OP3,
    "op7_quality_rules": OP7,
    "op9_mixing": OP9,
    "op10_sharding": OP10,
}

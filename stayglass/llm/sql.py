"""DuckDB SQL that the queries must agree with."""

#: words of a text, and those of lower-cased text (A-Z alone)
LOWERED = "translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz')"
SPACED = r"[^\x20\x09-\x0D]+"
ALPHANUMERIC = r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+"

JACCARD = rf"""
WITH RECURSIVE words AS (
  SELECT doc_id, regexp_extract_all({LOWERED}, '{SPACED}') AS w FROM documents),
sets AS (
  SELECT doc_id, list_sort(list_distinct(CASE WHEN len(w) = 0 THEN [] WHEN len(w) < 5 THEN [list_aggregate(w, 'string_agg', ' ')]
    ELSE list_transform(range(1, len(w) - 3), lambda i: w[i] || ' ' || w[i+1] || ' ' || w[i+2] || ' ' || w[i+3] || ' ' || w[i+4]) END)) AS s
  FROM words),
classes AS (SELECT s, min(doc_id) AS class, len(s) AS n FROM sets WHERE len(s) > 0 GROUP BY s),
items AS (SELECT class, n, unnest(s) AS item FROM classes),
pairs AS (
  SELECT a.class AS x, b.class AS y, a.n AS n, b.n AS m, count(*) AS common
  FROM items a JOIN items b ON a.item = b.item AND a.class < b.class GROUP BY 1, 2, 3, 4),
links AS (
  SELECT x, y FROM pairs WHERE 100 * common >= 80 * (n + m - common)
  UNION SELECT y, x FROM pairs WHERE 100 * common >= 80 * (n + m - common)),
reach AS (
  SELECT class AS node, class AS seen FROM classes
  UNION SELECT reach.node, links.y FROM reach JOIN links ON reach.seen = links.x),
parts AS (SELECT node, min(seen) AS component FROM reach GROUP BY node)
SELECT sets.doc_id, CAST(len(sets.s) AS BIGINT) AS n_shingles, coalesce(parts.component, sets.doc_id) AS component_id
FROM sets LEFT JOIN classes ON sets.s = classes.s AND len(sets.s) > 0 LEFT JOIN parts ON parts.node = classes.class"""

DECONTAMINATION = rf"""
WITH d AS (SELECT doc_id, regexp_extract_all({LOWERED}, '{ALPHANUMERIC}') AS w FROM documents),
b AS (SELECT CAST(item_id AS VARCHAR) AS item, regexp_extract_all({LOWERED}, '{ALPHANUMERIC}') AS w FROM benchmark),
phrases AS (
  SELECT DISTINCT item, len(p) AS size, list_aggregate(p, 'string_agg', ' ') AS phrase FROM (
    SELECT item, unnest(list_transform(range(0, greatest(len(w) - 9, 1)), lambda i: w[i+1:i+10])) AS p FROM b WHERE len(w) > 0)),
sizes AS (SELECT DISTINCT size FROM phrases),
windows AS (
  SELECT doc_id, size, unnest(range(1, len(w) - size + 2)) AS i, w FROM d, sizes WHERE len(w) >= size),
found AS (
  SELECT doc_id, i, windows.size AS size, item FROM windows
  JOIN phrases ON phrases.size = windows.size AND phrases.phrase = list_aggregate(w[i:i+windows.size-1], 'string_agg', ' ')),
hits AS (SELECT doc_id, count(DISTINCT k) AS n FROM (SELECT doc_id, unnest(range(i, i + size)) AS k FROM found) GROUP BY doc_id),
items AS (SELECT doc_id, list_sort(list_distinct(list(item))) AS l FROM found GROUP BY doc_id)
SELECT d.doc_id, CAST(len(w) AS BIGINT) AS n_words, CAST(coalesce(n, 0) AS BIGINT) AS n_hit,
       CAST(coalesce(len(l), 0) AS BIGINT) AS n_items,
       sha256(coalesce(list_aggregate(l, 'string_agg', ','), '')) AS items_sha256, coalesce(n, 0) > 0 AS contaminated
FROM d LEFT JOIN hits USING (doc_id) LEFT JOIN items USING (doc_id)"""


LINE_DEDUP = rf"""
WITH l AS (
  SELECT doc_id, text, unnest(string_split(text, chr(10))) AS line, generate_subscripts(string_split(text, chr(10)), 1) AS i
  FROM documents WHERE text IS NOT NULL),
f AS (
  SELECT *, len(regexp_extract_all(line, '{SPACED}')) AS words,
         md5(coalesce(lag(md5(line)) OVER w, '') || md5(line)) AS rolling,
         coalesce(lead(len(regexp_extract_all(line, '{SPACED}'))) OVER w, 0) AS next_words, lead(i) OVER w IS NULL AS is_last
  FROM l WINDOW w AS (PARTITION BY doc_id, text ORDER BY i)),
e AS (SELECT *, is_last OR rolling[1] IN ('0', '1', '2', '3') OR words >= 20 OR next_words >= 20 AS cut FROM f),
c AS (
  SELECT *, coalesce(sum(CAST(cut AS INTEGER)) OVER (
    PARTITION BY doc_id, text ORDER BY i ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS chunk FROM e),
chunks AS (
  SELECT doc_id, text, chunk, string_agg(line, chr(10) ORDER BY i) AS body,
         count(*) FILTER (words > 0) >= 2 OR max(words) >= 20 AS counts
  FROM c GROUP BY doc_id, text, chunk),
marked AS (
  SELECT *, counts AND row_number() OVER (PARTITION BY body, counts ORDER BY doc_id, chunk) > 1 AS gone FROM chunks),
kept AS (
  SELECT doc_id, text, count(*) AS n_chunks, count(*) FILTER (gone) AS n_removed,
         coalesce(string_agg(body, chr(10) ORDER BY chunk) FILTER (NOT gone), '') AS left_over
  FROM marked GROUP BY doc_id, text)
SELECT doc_id, CAST(coalesce(n_chunks, 0) AS BIGINT) AS n_chunks, CAST(coalesce(n_removed, 0) AS BIGINT) AS n_removed,
       CAST(length(left_over) AS BIGINT) AS n_chars_left, sha256(coalesce(left_over, '')) AS text_sha256
FROM documents LEFT JOIN kept USING (doc_id, text)"""

# the line rules as SQL over a line `x`; the phrases are those of quality_rules
_LINE_FAILS = r"""(
    len(regexp_replace(regexp_replace(x, '[\x20\x09-\x0D]', '', 'g'), '[\p{L}\p{N}.,;:''\-]', '', 'g')) * 100
      >= len(regexp_replace(x, '[\x20\x09-\x0D]', '', 'g')) * 25
    OR (len(regexp_replace(x, '[^|>»]', '', 'g')) >= 2 AND n <= 8 * (len(regexp_replace(x, '[^|>»]', '', 'g')) + 1))
    OR (n <= 20 AND (PHRASES)))"""


def quality_rules(phrases) -> str:
    fails = _LINE_FAILS.replace("PHRASES", " OR ".join(f"contains(lower(x), '{p}')" for p in phrases))
    return rf"""
WITH d AS (SELECT doc_id, coalesce(text, '') AS t, regexp_extract_all(coalesce(text, ''), '{SPACED}') AS w FROM documents),
windows AS (
  SELECT doc_id, i, list_aggregate(w[i:i+7], 'string_agg', ' ') AS g FROM (SELECT doc_id, w, unnest(range(1, len(w) - 6)) AS i FROM d)),
twice AS (SELECT doc_id, i FROM windows QUALIFY count(*) OVER (PARTITION BY doc_id, g) > 1),
repeated AS (SELECT doc_id, count(DISTINCT k) AS r FROM (SELECT doc_id, unnest(range(i, i + 8)) AS k FROM twice) GROUP BY doc_id),
lines AS (
  SELECT doc_id, x, len(regexp_extract_all(x, '{SPACED}')) AS n
  FROM (SELECT doc_id, unnest(string_split(t, chr(10))) AS x FROM d) WHERE regexp_matches(x, '{SPACED}')),
judged AS (SELECT *, {fails} AS bad FROM lines),
by_line AS (SELECT doc_id, x, any_value(n) AS n, count(*) AS k, bool_or(bad) AS bad FROM judged GROUP BY doc_id, x),
lost AS (SELECT doc_id, sum(k - 1) AS dup, sum(CASE WHEN bad THEN k * n ELSE (k - 1) * n END) AS gone FROM by_line GROUP BY doc_id),
facts AS (
  SELECT doc_id, CAST(len(w) AS BIGINT) AS n_words,
         CAST(len(regexp_replace(t, '[\x20\x09-\x0D]', '', 'g')) AS BIGINT) AS word_chars,
         CAST(len(regexp_replace(t, '[^#*$%&|<>]', '', 'g')) AS BIGINT) AS n_symbols,
         CAST(coalesce(dup, 0) AS BIGINT) AS n_dup_lines, CAST(coalesce(r, 0) AS BIGINT) AS n_repeat_words,
         CAST(coalesce(gone, 0) AS BIGINT) AS n_lost_words
  FROM d LEFT JOIN repeated USING (doc_id) LEFT JOIN lost USING (doc_id))
SELECT *, n_words < 20 OR 100 * n_repeat_words > 30 * n_words AS base_failed,
       NOT (n_words < 20 OR 100 * n_repeat_words > 30 * n_words) AND 100 * n_lost_words <= 30 * n_words AS kept
FROM facts"""


def license_scan(templates: dict[str, str]) -> str:
    def shingles(w: str) -> str:
        return f"list_transform(range(1, len({w}) - 3), lambda i: {w}[i] || ' ' || {w}[i+1] || ' ' || {w}[i+2] || ' ' || {w}[i+3] || ' ' || {w}[i+4])"

    words = r"regexp_extract_all(lower(coalesce(text, '')), '[\p{L}\p{N}]+')"
    values = ", ".join("('{}', '{}')".format(k, v.replace("'", "''")) for k, v in templates.items())
    return f"""
WITH t AS (SELECT name, {words} AS w FROM (VALUES {values}) AS v(name, text)),
ts AS (SELECT name, list_distinct({shingles('w')}) AS s FROM t),
tl AS (SELECT name, s, len(s) AS m, CAST(pow(2, ceil(log2(len(s)))) AS BIGINT) AS scale FROM ts),
d AS (SELECT doc_id, {words} AS w FROM documents),
ds AS (SELECT doc_id, {shingles('w')} AS s FROM d),
scales AS (SELECT DISTINCT scale FROM tl),
every AS (SELECT list_distinct(flatten(list(s))) AS a FROM tl),
touched AS (SELECT doc_id, s FROM ds, every WHERE len(list_intersect(s, a)) > 0),
windows AS (
  SELECT doc_id, scale, s[k+1:k+2*scale] AS items
  FROM (SELECT doc_id, s, scale, unnest(range(0, len(s), scale)) AS k FROM touched, scales)),
found AS (
  SELECT doc_id, name, max(round(len(list_intersect(items, tl.s)) * 100.0 / m, 4)) AS best
  FROM windows JOIN tl ON windows.scale = tl.scale
  WHERE len(list_intersect(items, tl.s)) * 100 >= 80 * m GROUP BY doc_id, name),
per AS (SELECT doc_id, count(*) AS n, string_agg(name, ',' ORDER BY name) AS names, sum(CAST(round(best * 100) AS BIGINT)) AS total FROM found GROUP BY doc_id)
SELECT ds.doc_id, CAST(len(s) AS BIGINT) AS n_shingles, CAST(coalesce(n, 0) AS BIGINT) AS n_licenses,
       coalesce(names, '') AS licenses, CAST(coalesce(total, 0) AS BIGINT) AS percent_sum
FROM ds LEFT JOIN per USING (doc_id)"""


# crc32 of a decimal text, bit by bit: a number from 1000 on stands for a character, 0 for a step of one bit
_CRC32 = """xor(list_reduce(list_concat([CAST(4294967295 AS BIGINT)],
    flatten(list_transform(string_split(CAST(doc_id AS VARCHAR), ''), ch -> list_concat([CAST(1000 + ascii(ch) AS BIGINT)], [CAST(0 AS BIGINT) for z in range(8)])))),
  lambda c, x: CASE WHEN x >= 1000 THEN xor(c, x - 1000) WHEN c % 2 = 1 THEN xor(c >> 1, CAST(3988292384 AS BIGINT)) ELSE c >> 1 END), CAST(4294967295 AS BIGINT))""".replace(
    "ch -> ", "lambda ch: "
)


def _field(value: str) -> str:
    return f"CASE WHEN {value} IS NULL THEN '-' ELSE concat(octet_length(encode(CAST({value} AS VARCHAR))), ':', {value}) END"


def _leaf(n_chars: str) -> str:
    return "sha256(concat(" + ", ".join(_field(x) for x in ("doc_id", "source", "lang", n_chars, "text")) + "))"


_PARENTS = "list_transform(range(1, len(l) + 1, 2), lambda i: sha256(concat(l[i], coalesce(l[i + 1], ''))))"

MERKLE = f"""
WITH RECURSIVE leaves AS (
  SELECT doc_id, lang, {_leaf('n_chars')} AS leaf,
         CASE WHEN doc_id IS NOT NULL AND {_CRC32} % 7 = 0 THEN {_leaf('(n_chars + 1)')} ELSE {_leaf('n_chars')} END AS shown FROM documents),
placed AS (SELECT *, row_number() OVER (PARTITION BY lang ORDER BY doc_id NULLS FIRST, leaf) - 1 AS pos FROM leaves),
levels AS (
  SELECT lang, 0 AS level, list(leaf ORDER BY pos) AS l FROM placed GROUP BY lang
  UNION ALL SELECT lang, level + 1, {_PARENTS} FROM levels WHERE len(l) > 1),
subroots AS (SELECT lang, l[1] AS subroot, row_number() OVER (ORDER BY lang NULLS FIRST) - 1 AS place FROM levels WHERE len(l) = 1),
above AS (
  SELECT 0 AS level, list(subroot ORDER BY place) AS l FROM subroots
  UNION ALL SELECT level + 1, {_PARENTS} FROM above WHERE len(l) > 1),
height AS (SELECT lang, max(level) AS h FROM levels GROUP BY lang),
steps AS (
  SELECT p.doc_id, p.leaf, p.lang, p.pos, v.level AS step, (p.pos >> v.level) % 2 AS slot, v.l[xor(p.pos >> v.level, 1) + 1] AS mate
  FROM placed p JOIN levels v ON p.lang IS NOT DISTINCT FROM v.lang AND len(v.l) > 1
  UNION ALL
  SELECT p.doc_id, p.leaf, p.lang, p.pos, h.h + a.level, (s.place >> a.level) % 2, a.l[xor(s.place >> a.level, 1) + 1]
  FROM placed p JOIN subroots s ON p.lang IS NOT DISTINCT FROM s.lang JOIN height h ON p.lang IS NOT DISTINCT FROM h.lang JOIN above a ON len(a.l) > 1),
paths AS (
  SELECT lang, pos, list(CASE WHEN mate IS NULL THEN '' ELSE concat(slot, mate) END ORDER BY step) AS path,
         string_agg(coalesce(mate, ''), '' ORDER BY step) AS mates FROM steps GROUP BY lang, pos),
rows_ AS (
  SELECT p.doc_id, p.leaf, s.subroot, (SELECT l[1] FROM above WHERE len(l) = 1) AS root, sha256(coalesce(q.mates, '')) AS proof_sha256,
         list_reduce(list_concat([p.shown], coalesce(q.path, [])), lambda c, x: sha256(CASE
           WHEN x = '' THEN c WHEN x[1] = '0' THEN concat(c, x[2:]) ELSE concat(x[2:], c) END)) AS folded_root
  FROM placed p JOIN subroots s ON p.lang IS NOT DISTINCT FROM s.lang LEFT JOIN paths q ON p.lang IS NOT DISTINCT FROM q.lang AND p.pos = q.pos)
SELECT *, folded_root = root AS verified FROM rows_"""

COLLOCATIONS = rf"""
WITH pieces AS (
  SELECT coalesce(lang, 'und') AS lang, unnest(regexp_split_to_array({LOWERED}, '[.,;:!?
-]')) AS p FROM documents),
words AS (SELECT lang, regexp_extract_all(p, '[^ 	]+') AS w FROM pieces),
total AS (SELECT lang, CAST(sum(len(w)) AS BIGINT) AS n FROM words GROUP BY lang),
spans AS (SELECT lang, w, unnest(range(1, len(w) + 1)) AS i FROM words),
phrases AS (SELECT lang, w[i:i+k-1] AS w FROM spans, (SELECT unnest(range(1, 6)) AS k) WHERE i + k - 1 <= len(w)),
f AS (SELECT lang, w, count(*) AS a FROM phrases GROUP BY lang, w HAVING count(*) >= 100),
cand AS (SELECT * FROM f WHERE len(w) > 1),
inside AS (
  SELECT DISTINCT lang, w[i:i+k-1] AS w, a FROM (
    SELECT lang, w, a, k, unnest(range(1, len(w) - k + 2)) AS i FROM cand, (SELECT unnest(range(2, 5)) AS k) WHERE k < len(w))),
kept AS (SELECT * FROM cand WHERE NOT EXISTS (
  SELECT 1 FROM inside WHERE inside.lang = cand.lang AND inside.w = cand.w AND 100 * inside.a >= 100 * cand.a)),
cuts AS (
  SELECT kept.lang, kept.w, kept.a, k, x.a AS l, y.a AS r, n, CAST(1000 * CAST(kept.a AS HUGEINT) * n // (CAST(x.a AS HUGEINT) * y.a) AS BIGINT) AS score
  FROM (SELECT *, unnest(range(1, len(w))) AS k FROM kept) AS kept
  JOIN f x ON x.lang = kept.lang AND x.w = kept.w[1:k] JOIN f y ON y.lang = kept.lang AND y.w = kept.w[k+1:]
  JOIN total ON total.lang = kept.lang),
lowest AS (SELECT *, array_to_string(w, ' ') AS phrase FROM cuts QUALIFY row_number() OVER (PARTITION BY lang, w ORDER BY score, k) = 1)
SELECT lang, row_number() OVER (PARTITION BY lang ORDER BY score DESC, a DESC, phrase) AS rank, phrase, a, l, r, n, score
FROM lowest QUALIFY rank <= 2000"""

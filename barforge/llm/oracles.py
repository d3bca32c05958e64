"""Text queries as SQL over the same tables, written independently where SQL can express them.

Whole numbers that may be missing come as doubles, as missing numbers do in data frames.
"""

from barforge.llm.licenses import TEMPLATES
from barforge.llm.urls import REJECTED_WORDS

LOWER = "'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'"
# Shares of weight, none above three times its source: sources are filled up in the order of
# their ratio of cap to weight, until what is left, shared by weight, fits all others. The
# partial pass takes rows by rank up to the one at which its words come nearest to the aim.
MIXING = """WITH docs AS MATERIALIZED (SELECT doc_id, source, CASE WHEN trim(coalesce(text, ''), e' \\t\\n\\x0B\\f\\r') = '' THEN 0
    ELSE len(regexp_split_to_array(trim(text, e' \\t\\n\\x0B\\f\\r'), '[\\x20\\x09-\\x0D]+')) END AS size,
  CAST('0x' || substr(md5('20|' || coalesce(doc_id::VARCHAR, '') || '|' || coalesce(md5(text), '')), 1, 15) AS BIGINT) AS rank
  FROM documents),
sources AS (SELECT source, SUM(size)::BIGINT AS words FROM docs GROUP BY source),
weighed AS (SELECT *, [5, 2, 1][(row_number() OVER (ORDER BY source NULLS LAST) - 1) % 3 + 1] AS weight,
  (SELECT SUM(words) FROM sources) AS total FROM sources),
ranked AS (SELECT *, row_number() OVER (ORDER BY 3 * words / weight, source) AS k FROM weighed WHERE words > 0),
filled AS (SELECT *, (total - 3 * coalesce(SUM(words) OVER before, 0))::DOUBLE AS left_over,
  SUM(weight) OVER (ORDER BY k ROWS BETWEEN CURRENT ROW AND UNBOUNDED FOLLOWING) AS weights
  FROM ranked WINDOW before AS (ORDER BY k ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING)),
fits AS (SELECT k, left_over, weights FROM filled WHERE left_over * weight / weights <= 3 * words ORDER BY k LIMIT 1),
aimed AS (SELECT s.source, s.words, CASE WHEN s.words = 0 THEN 0.0 WHEN r.k < f.k THEN 3.0 * s.words
    ELSE f.left_over * s.weight / f.weights END::DOUBLE AS target
  FROM weighed s LEFT JOIN ranked r ON r.source IS NOT DISTINCT FROM s.source LEFT JOIN fits f ON TRUE),
passes AS (SELECT *, CASE WHEN words = 0 THEN 0 ELSE floor(target / words) END AS passes FROM aimed),
open AS (SELECT *, target - passes * words AS aim FROM passes),
summed AS (SELECT source, rank, SUM(size) AS own FROM docs GROUP BY source, rank),
upto AS (SELECT s.source, rank, aim, own, SUM(own) OVER (PARTITION BY s.source ORDER BY rank) AS upto
  FROM summed s JOIN open o ON o.source IS NOT DISTINCT FROM s.source),
cut AS (SELECT source, min(rank) AS rank, min_by(upto - aim < aim - (upto - own), rank) AS within
  FROM upto WHERE aim > 0 AND upto >= aim GROUP BY source)
SELECT doc_id, size, o.words AS source_size, target,
  (size * (passes + CASE WHEN d.rank < c.rank OR (d.rank = c.rank AND within) THEN 1 ELSE 0 END))::BIGINT AS taken
FROM docs d JOIN open o ON o.source IS NOT DISTINCT FROM d.source LEFT JOIN cut c ON c.source IS NOT DISTINCT FROM d.source"""

# The checksum is worked out byte by byte from the table of its polynomial; near words share
# a word with one letter cut out, at the same place where they have one length.
SPELLING = """WITH RECURSIVE bits(i, k, c) AS (SELECT i, 0, i::UBIGINT FROM range(256) t(i) UNION ALL
  SELECT i, k + 1, CASE WHEN c & 1 = 1 THEN xor(c >> 1, 3988292384::UBIGINT) ELSE c >> 1 END FROM bits WHERE k < 8),
crc AS MATERIALIZED (SELECT list(c ORDER BY i) AS t FROM bits WHERE k = 8),
runs AS (SELECT coalesce(doc_id::VARCHAR, '') AS id, unnest(regexp_extract_all(
  translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[A-Za-z\u00C0-\u00FF]+')) AS run FROM documents),
long AS (SELECT id, run, list_transform(string_split(id || ':' || run, ''), lambda x: unicode(x)) AS points FROM runs WHERE length(run) >= 7),
bytes AS (SELECT run, flatten(list_transform(points, lambda p: CASE WHEN p < 128 THEN [p] ELSE [192 + (p >> 6), 128 + (p & 63)] END)) AS b FROM long),
hashed AS (SELECT run, xor(list_reduce(b, lambda c, x: xor(c >> 8, t[xor(c & 255, x::UBIGINT)::BIGINT + 1]), 4294967295::UBIGINT),
  4294967295::UBIGINT) AS h FROM bytes, crc),
cut AS (SELECT CASE WHEN h % 31 = 0 THEN run[:(h % length(run))::BIGINT] || run[(h % length(run))::BIGINT + 2:] ELSE run END AS word FROM hashed),
words AS MATERIALIZED (SELECT word, COUNT(*) AS n FROM cut WHERE length(word) >= 7 GROUP BY word HAVING COUNT(*) >= 2),
holes AS MATERIALIZED (SELECT word, n, i, word[:i - 1] || word[i + 1:] AS rest FROM (SELECT word, n, unnest(range(1, length(word) + 1)) AS i FROM words) w),
pairs AS (SELECT a.word AS u, b.word AS v, b.n AS vn FROM holes a JOIN holes b ON a.rest = b.rest AND a.i = b.i AND a.word <> b.word
  UNION SELECT h.word, w.word, w.n FROM holes h JOIN words w ON h.rest = w.word
  UNION SELECT w.word, h.word, h.n FROM holes h JOIN words w ON h.rest = w.word),
near AS (SELECT u, COUNT(*) AS n_near, max(vn) AS best_n FROM pairs GROUP BY u),
first AS (SELECT u, min(v) AS best FROM pairs JOIN near USING (u) WHERE vn = best_n GROUP BY u),
told AS MATERIALIZED (SELECT word, n, coalesce(n_near, 0) AS n_near, CASE WHEN best_n >= 10 * n THEN best END AS form,
  CASE WHEN best_n >= 10 * n THEN best_n END AS form_n FROM words LEFT JOIN near ON u = word LEFT JOIN first USING (u)),
steps(word, spot, k) AS (SELECT word, word, 0 FROM told UNION ALL
  SELECT s.word, t.form, k + 1 FROM steps s JOIN told t ON t.word = s.spot WHERE t.form IS NOT NULL)
SELECT word, form, root, n, n_near, form_n::DOUBLE AS form_n FROM told JOIN (SELECT word, arg_max(spot, k) AS root FROM steps GROUP BY word) r USING (word)"""

RARE_WORDS, SHARE = 8, 0.7


def _licenses() -> str:
    """Every template's words joined with every document's, by position."""
    rows = ", ".join(
        f"({t}, {i}, '{word}', {i in template.key_positions()})"
        for t, template in enumerate(TEMPLATES) for i, word in enumerate(template.words))
    told = ", ".join(f"({t}, '{x.label}', {x.base})" for t, x in enumerate(TEMPLATES))
    return f"""WITH docs AS MATERIALIZED (SELECT doc_id, row_number() OVER () AS rid, list_filter(
  regexp_split_to_array(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
    '[\\x00-\\x2F\\x3A-\\x60\\x7B-\\x7F]+'), lambda x: x <> '') AS w FROM documents),
template(t, label, base) AS (VALUES {told}),
part(t, spot, word, in_key) AS (VALUES {rows}),
token AS MATERIALIZED (SELECT rid, pos, word FROM (
  SELECT rid, unnest(w) AS word, generate_subscripts(w, 1) - 1 AS pos FROM docs) u WHERE word IN (SELECT word FROM part)),
counts AS (SELECT word, COUNT(DISTINCT rid) AS n FROM token GROUP BY word),
rare AS (SELECT t, spot, word, COUNT(*) OVER (PARTITION BY t) AS size FROM (
  SELECT part.*, row_number() OVER (PARTITION BY t ORDER BY coalesce(n, 0), part.word, spot) AS k
  FROM part LEFT JOIN counts ON counts.word = part.word) r WHERE k <= {RARE_WORDS}),
keyed AS (SELECT t, COUNT(*) AS keys FROM part WHERE in_key GROUP BY t),
found AS (SELECT p.t, rid, pos - spot AS start FROM token JOIN part p ON p.word = token.word AND in_key JOIN keyed k ON k.t = p.t
  WHERE pos >= spot GROUP BY p.t, rid, pos - spot, keys HAVING COUNT(*) = keys),
scored AS (SELECT f.t, f.rid, f.start, COUNT(token.pos) AS hits, max(size) AS size FROM found f JOIN rare r ON r.t = f.t
  LEFT JOIN token ON token.rid = f.rid AND token.pos = f.start + r.spot AND token.word = r.word GROUP BY f.t, f.rid, f.start),
place AS (SELECT rid, start, label, base, hits / size AS score FROM scored JOIN template USING (t)
  WHERE hits >= ceil(size * {SHARE})),
summed AS (SELECT rid, COUNT(*) FILTER (base) AS n_base, min(start) FILTER (base)::DOUBLE AS first_word,
  max(start) FILTER (base)::DOUBLE AS last_word, string_agg(DISTINCT label, ',' ORDER BY label) FILTER (base) AS base_labels,
  string_agg(DISTINCT label, ',' ORDER BY label) AS labels, max(score) AS score FROM place GROUP BY rid)
SELECT doc_id, len(w) AS n_words, coalesce(n_base, 0) AS n_base, first_word, last_word,
  coalesce(base_labels, '') AS base_labels, coalesce(labels, '') AS labels, coalesce(score, 0.0)::DOUBLE AS score
FROM docs LEFT JOIN summed USING (rid)"""


# Item-sized windows, aligned by every fourth shingle of an item, against the items of their
# length, without fingerprints: they lose no passage that is similar enough.
def _plain_words(column: str) -> str:
    return f"""list_filter(regexp_split_to_array(translate(coalesce({column}, ''), {LOWER}),
  '[\\x00-\\x2F\\x3A-\\x60\\x7B-\\x7F]+'), lambda x: x <> '')"""


def _shingled(source: str, keys: str) -> str:
    return f"""SELECT {keys}, i, array_to_string(w[i + 1:i + 5], ' ') AS shingle
  FROM (SELECT *, unnest(range(0, len(w) - 4)) AS i FROM {source}) u"""


LEAKS = f"""WITH docs AS MATERIALIZED (SELECT rid, any_value(doc_id) AS doc_id, any_value(w) AS w FROM (
  SELECT dense_rank() OVER (ORDER BY doc_id, text) AS rid, doc_id, {_plain_words("text")} AS w FROM documents) d GROUP BY rid),
whole AS (SELECT item_id, w, ceil(len(w) / 128)::INT AS parts FROM (
  SELECT item_id, {_plain_words("text")} AS w FROM benchmark) b WHERE len(w) >= 5),
part AS MATERIALIZED (SELECT DISTINCT item_id, part, w[(part * len(w)) // parts + 1:((part + 1) * len(w)) // parts] AS w
  FROM (SELECT *, unnest(range(0, parts)) AS part FROM whole) p),
item AS MATERIALIZED (SELECT *, row_number() OVER () AS iid, len(w) AS length FROM part),
item_shingle AS MATERIALIZED ({_shingled("item", "iid, length")}),
doc_shingle AS MATERIALIZED (SELECT * FROM ({_shingled("docs", "rid")}) s WHERE shingle IN (SELECT shingle FROM item_shingle)),
win AS MATERIALIZED (SELECT DISTINCT rid, d.i - a.i AS start, a.length
  FROM doc_shingle d JOIN item_shingle a USING (shingle) WHERE a.i % 4 = 0),
sized AS (SELECT win.*, least(len(w), start + length) - greatest(start, 0) - 4 AS n FROM win JOIN docs USING (rid)),
in_win AS (SELECT s.rid, start, length, n, shingle, COUNT(*) AS have FROM sized s JOIN doc_shingle d ON d.rid = s.rid
  AND d.i BETWEEN greatest(start, 0) AND start + length - 5 WHERE n > 0 GROUP BY ALL),
in_item AS (SELECT iid, length, shingle, COUNT(*) AS want FROM item_shingle GROUP BY ALL),
shared AS (SELECT rid, iid, start, x.length, n, SUM(least(have, want)) AS common
  FROM in_win x JOIN in_item y ON y.shingle = x.shingle AND y.length = x.length GROUP BY ALL),
alike AS (SELECT *, common::DOUBLE / (n + length - 4 - common) AS similarity FROM shared)
SELECT doc_id, item_id, part, b.start, b.length, b.similarity FROM (
  SELECT rid, iid, max_by({{'start': start, 'length': length, 'similarity': similarity}}, [similarity, -start]) AS b
  FROM alike WHERE similarity >= 0.8 GROUP BY rid, iid) x JOIN docs USING (rid) JOIN item USING (iid)"""

# Secrets: matches and the pieces between them give the places; entropies are counted window by window.
def _either_case(word: str) -> str:
    return "".join(f"[{c.upper()}{c}]" if c.isalpha() else c for c in word)


ASSIGN = ("(" + "|".join(map(_either_case, ("password", "passwd", "secret", "token", "api_?key")))
          + """)["'']?\\x20*[:=]\\x20*["'']?([A-Za-z0-9+/_.=-]+)""")


def _placed(source: str, column: str, pattern: str, keys: str, group: int = 0) -> str:
    """(keys, hit, part, start) of each match in a column; ``part`` is a group of it."""
    return f"""SELECT {keys}, m[j] AS hit, g[j] AS part, (SUM(len(p[j]) + CASE WHEN j > 1 THEN len(m[j - 1]) ELSE 0 END) OVER (
    PARTITION BY {keys} ORDER BY j))::BIGINT AS start
  FROM (SELECT *, unnest(range(1, len(m) + 1)) AS j FROM (SELECT *, regexp_extract_all({column}, '{pattern}') AS m,
    regexp_extract_all({column}, '{pattern}', {group}) AS g, regexp_split_to_array({column}, '{pattern}') AS p FROM {source}) x) y"""


def _hot(runs: str, bits: float) -> str:
    """Stretches of hot windows in runs (rid, cand, spot, run), ``spot`` being the run's place in the text."""
    return f"""SELECT rid, cand, spot + min(i) AS start, spot + max(i) + 20 AS stop FROM (
  SELECT *, SUM(fresh) OVER (PARTITION BY rid, cand, spot ORDER BY i) AS stretch FROM (
    SELECT *, CASE WHEN i > lag(i) OVER (PARTITION BY rid, cand, spot ORDER BY i) + 20 THEN 1 ELSE 0 END AS fresh FROM (
      SELECT rid, cand, spot, i FROM (SELECT rid, cand, spot, i, c, COUNT(*) AS n FROM (
        SELECT rid, cand, spot, i, unnest(string_split(substr(run, i + 1, 20), '')) AS c FROM (
          SELECT *, unnest(range(0, len(run) - 19)) AS i FROM {runs}) w) l GROUP BY ALL) k
      GROUP BY rid, cand, spot, i HAVING SUM(n * log2(n)) <= (log2(20) - {bits}) * 20 + 1e-9) h) f) s GROUP BY rid, cand, spot, stretch"""


MIXED = "regexp_matches({0}, '[0-9]') AND regexp_matches({0}, '[A-Za-z]')"
ALLOWED = ("[0-9a-f]{8}(-[0-9a-f]{4}){3}-[0-9a-f]{12}", "0123456789|123456789[0a]|abcdefghij|qwertyuiop",
           "example|sample|placeholder|changeme|dummy|xxxx")
SECRETS = f"""WITH docs AS MATERIALIZED (SELECT row_number() OVER () AS rid, doc_id, coalesce(text, '') AS text FROM documents),
known AS MATERIALIZED (
  SELECT rid, 'assign' AS kind, 0 AS k, start, start + len(hit) AS stop FROM ({_placed("docs", "text", ASSIGN, "rid", 2)}) a WHERE len(part) >= 8
  UNION ALL SELECT rid, 'access', 1, start, start + len(hit) FROM ({_placed("docs", "text", "AKIA[A-Z0-9]+", "rid")}) b WHERE len(hit) >= 16
  UNION ALL SELECT rid, 'hex', 2, start, start + len(hit) FROM ({_placed("docs", "text", "[0-9a-f]{32,}", "rid")}) c),
candidate AS MATERIALIZED (SELECT rid, start AS cand, hit FROM ({_placed("docs", "text", "[A-Za-z0-9+/_=-]{20,}", "rid")}) c JOIN docs USING (rid)
  WHERE {MIXED.format("hit")} AND NOT regexp_matches(lower(substr(text, greatest(start - 24, 0) + 1, least(start, 24))),
    '(md5|sha-?1|sha-?256|sha-?512|commit|checksum|digest|integrity|etag)["'']?\\s*[:= -]\\s*["'']?$')),
lowered AS (SELECT rid, cand, lower(hit) AS hit FROM candidate),
cut AS (SELECT rid, cand, start AS s, start + len(hit) AS e FROM (
    {" UNION ALL ".join(f"({_placed('lowered', 'hit', allowed, 'rid, cand')})" for allowed in ALLOWED)}) a
  UNION ALL SELECT rid, cand, len(hit), len(hit) FROM candidate),
piece AS MATERIALIZED (SELECT rid, cand, skip, substr(hit, skip + 1, s - skip) AS piece FROM (
  SELECT rid, cand, s, coalesce(max(e) OVER (PARTITION BY rid, cand ORDER BY s, e ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS skip
  FROM cut) x JOIN candidate USING (rid, cand) WHERE s > skip),
hex_run AS (SELECT rid, cand, cand + skip + start AS spot, hit AS run FROM ({_placed("piece", "piece", "[0-9A-Fa-f]{20,}", "rid, cand, skip")}) h),
base_run AS (SELECT rid, cand, cand + skip AS spot, piece AS run FROM piece),
found AS (SELECT rid, 'entropy_hex' AS kind, 3 AS k, start, stop FROM ({_hot("hex_run", 2.9)}) h
  UNION ALL SELECT rid, 'entropy_base64', 4, start, stop FROM ({_hot("base_run", 3.75)}) b),
span AS MATERIALIZED (SELECT * FROM known UNION ALL SELECT f.* FROM found f JOIN docs USING (rid)
  WHERE {MIXED.format("substr(text, start + 1, stop - start)")} AND NOT EXISTS (
  SELECT 1 FROM known n WHERE n.rid = f.rid AND n.start <= f.start AND n.stop >= f.stop)),
summed AS (SELECT rid, COUNT(*) FILTER (k = 0) AS n_assign, COUNT(*) FILTER (k = 1) AS n_access, COUNT(*) FILTER (k = 2) AS n_hex,
  string_agg(kind || ':' || start || ':' || stop, ',' ORDER BY start, k) FILTER (k < 3) AS base,
  string_agg(kind || ':' || start || ':' || stop, ',' ORDER BY start, k) AS spans FROM span GROUP BY rid)
SELECT doc_id, coalesce(n_assign, 0) AS n_assign, coalesce(n_access, 0) AS n_access, coalesce(n_hex, 0) AS n_hex,
  sha256(coalesce(base, '')) AS base_sha256, coalesce(spans, '') AS spans FROM docs LEFT JOIN summed USING (rid)"""

BLOCK, ALLOW = ("net/", "example.com/de/"), ("example.net/en/", "org/fr/")
ORDER, BACK, UNIFORM = 4, 5, 1 / 256


def _fits(rule: str) -> str:
    host, path = rule.split("/", 1)
    return f"(host = '{host}' OR ends_with(host, '.{host}')) AND starts_with(path, '/{path}')"


def _urls() -> str:
    """Models as a chain of tables: the probability after k characters from that after k - 1."""
    rules = " ".join(f"WHEN {_fits(r)} THEN '{r}'" for r in sorted(BLOCK + ALLOW, key=len, reverse=True))
    words = " OR ".join(f"contains(host, '{w}')" for w in REJECTED_WORDS)
    seen = " UNION ALL ".join(f"SELECT right(gram, {k}) AS suffix, a, r FROM counted WHERE a + r > 0" for k in range(1, ORDER + 2))

    def step(k: int, c: str) -> str:
        below = f"b.p{c}" if k > 1 else f"{UNIFORM!r}::DOUBLE"
        return (f"CASE WHEN coalesce(n{c}, 0) = 0 THEN {below} ELSE "
                f"(coalesce(s.{c}, 0) + t{c} * {below}) / (n{c} + t{c}) END AS p{c}")

    levels = ",\n".join(f"""l{k} AS MATERIALIZED (SELECT x.suffix, {step(k, "a")}, {step(k, "r")}
  FROM (SELECT DISTINCT right(gram, {k}) AS suffix FROM counted) x LEFT JOIN seen s USING (suffix)
  LEFT JOIN context c ON c.context = left(x.suffix, {k - 1})
  {f"JOIN l{k - 1} b ON b.suffix = right(x.suffix, {k - 1})" if k > 1 else ""})""" for k in range(1, ORDER + 2))
    blocked = ", ".join(f"'{b}'" for b in BLOCK)
    return f"""WITH rest AS (SELECT page_id, CASE WHEN instr(url, '://') > 0 THEN substr(url, instr(url, '://') + 3) ELSE '' END AS rest FROM pages),
parted AS (SELECT page_id, rest, regexp_extract(rest, '^[^/?#]*') AS raw FROM rest),
page AS (SELECT page_id, translate(raw, {LOWER}) AS host, regexp_extract(substr(rest, length(raw) + 1), '^[^?#]*') AS path FROM parted),
judged AS MATERIALIZED (SELECT *, host || translate(path, {LOWER}) AS chars, CASE {rules} END AS rule,
  CAST('0x' || substr(md5('3|' || host), 1, 8) AS BIGINT) % {BACK} = 0 AS back FROM page),
told AS (SELECT *, coalesce(rule IN ({blocked}), FALSE) OR {words} AS rejected FROM judged),
url AS MATERIALIZED (SELECT chars, COUNT(*) FILTER (NOT rejected AND NOT back) AS a, COUNT(*) FILTER (rejected AND NOT back) AS r,
  COUNT(*) FILTER (NOT rejected AND back) AS back_a, COUNT(*) FILTER (rejected AND back) AS back_r FROM told GROUP BY chars),
gram AS MATERIALIZED (SELECT chars, a, r, substr(repeat(chr(2), {ORDER}) || chars || chr(3), i, {ORDER + 1}) AS gram
  FROM (SELECT *, unnest(range(1, length(chars) + 2)) AS i FROM url) u),
counted AS MATERIALIZED (SELECT gram, SUM(a) AS a, SUM(r) AS r FROM gram GROUP BY gram),
seen AS MATERIALIZED (SELECT suffix, SUM(a) AS a, SUM(r) AS r FROM ({seen}) x GROUP BY suffix),
context AS MATERIALIZED (SELECT left(suffix, length(suffix) - 1) AS context, SUM(a) AS na, SUM(r) AS nr,
  COUNT(*) FILTER (a > 0) AS ta, COUNT(*) FILTER (r > 0) AS tr FROM seen GROUP BY 1),
{levels},
score AS MATERIALIZED (SELECT chars, avg(ln(pa) - ln(pr)) AS score FROM gram JOIN l{ORDER + 1} l ON l.suffix = gram GROUP BY chars),
bin AS (SELECT floor((least(greatest(score, -10), 10) + 10) * 100) AS bin, SUM(back_a) AS a, SUM(back_r) AS r
  FROM score JOIN url USING (chars) GROUP BY 1),
border AS (SELECT b, SUM(CASE WHEN bin < b THEN a ELSE 0 END) / nullif(SUM(a), 0) + SUM(CASE WHEN bin >= b THEN r ELSE 0 END) / nullif(SUM(r), 0) AS e
  FROM bin, (SELECT unnest(range(0, 2002)) AS b) x GROUP BY b),
best AS (SELECT list(b ORDER BY b) AS good FROM border WHERE e <= (SELECT min(e) FROM border) + 1e-12),
threshold AS (SELECT coalesce(good[len(good) // 2 + 1] * 0.01 - 10, 0)::DOUBLE AS least FROM best)
SELECT page_id, host, path, rule, CASE WHEN rule IN ({blocked}) THEN 'block' WHEN rule IS NOT NULL THEN 'allow'
  WHEN score >= least THEN 'allow' ELSE 'block' END AS verdict, round(score, 6) AS score
FROM judged JOIN score USING (chars), threshold"""


ORACLES: dict[str, str] = {
    "op1_mixing": MIXING,
    "op3_decontamination": LEAKS,
    "op7_secrets": SECRETS,
    "op10_urls": _urls(),
    "op9_licenses": _licenses(),
    "op12_spelling": SPELLING,
}

"""DuckDB SQL of the queries that SQL can express."""

from __future__ import annotations

from docquarry.llm.licenses import PHRASES, TEMPLATES
from docquarry.llm.secrets import RULES


def _literal(text: str) -> str:
    return "'" + text.replace("'", "''") + "'"


def _secrets() -> str:
    kinds = " UNION ALL ".join(
        f"SELECT doc_id, {kind} AS k, '{rule.name}' AS kind, {rule.least} AS least,"
        f" regexp_extract_all(t, {_literal(rule.pattern)}, 0) AS m,"
        f" regexp_extract_all(t, {_literal(rule.pattern)}, {rule.group}) AS g,"
        f" string_split_regex(t, {_literal(rule.pattern)}) AS p FROM d"
        for kind, rule in enumerate(RULES)
    )
    return f"""
WITH d AS (SELECT doc_id, coalesce(text, '') AS t FROM documents),
found AS ({kinds}),
hits AS (SELECT *, unnest(range(1, len(m) + 1)) AS i FROM found),
spans AS (
  SELECT doc_id, k, kind, list_sum(list_transform(p[1:i], lambda x: length(x))) +
    coalesce(list_sum(list_transform(m[1:i - 1], lambda x: length(x))), 0) AS s, length(m[i]) AS n
  FROM hits WHERE length(g[i]) >= least
),
told AS (
  SELECT doc_id, count(*) FILTER (k = 0) AS n_assign, count(*) FILTER (k = 1) AS n_access,
    count(*) FILTER (k = 2) AS n_hex,
    string_agg(kind || ':' || s::BIGINT || ':' || (s + n)::BIGINT, ',' ORDER BY s, k) AS spans
  FROM spans GROUP BY doc_id
)
SELECT d.doc_id, coalesce(n_assign, 0) AS n_assign, coalesce(n_access, 0) AS n_access,
  coalesce(n_hex, 0) AS n_hex, sha256(coalesce(spans, '')) AS base_sha256,
  coalesce(spans, '') AS spans
FROM d LEFT JOIN told USING (doc_id)
"""


WARC = """
WITH p AS (
  SELECT page_id, strlen(coalesce(html, ''))::BIGINT AS payload_bytes,
    sha256(coalesce(html, '')) AS payload_digest FROM pages
),
f AS (SELECT payload_digest, min(page_id) AS first FROM p WHERE payload_bytes >= 100 GROUP BY 1)
SELECT page_id, payload_bytes, payload_digest,
  CASE WHEN page_id IS DISTINCT FROM first AND first IS NOT NULL THEN 'revisit'
    ELSE 'response' END AS record_type,
  CASE WHEN page_id IS DISTINCT FROM first THEN first END AS refers_to
FROM p LEFT JOIN f USING (payload_digest)
"""


WORDS = r"regexp_extract_all({text}, '[^\x20\x09-\x0D]+')"
UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"

REPEATS = f"""
WITH d AS (SELECT doc_id, {WORDS.format(text="coalesce(text, '')")} AS w FROM documents),
starts AS (
  SELECT doc_id, unnest(list_transform(range(1, len(w) - 18),
    lambda i: struct_pack(i := i, run := array_to_string(w[i:i + 19], ' '))), recursive := true) FROM d
),
runs AS (
  SELECT doc_id, i, row_number() OVER (PARTITION BY run ORDER BY doc_id, i) AS place FROM starts
),
gone AS (SELECT DISTINCT doc_id, unnest(range(i, i + 20)) AS pos FROM runs WHERE place > 1),
words AS (SELECT doc_id, unnest(w) AS word, generate_subscripts(w, 1) AS pos FROM d),
kept AS (
  SELECT doc_id, string_agg(word, ' ' ORDER BY pos) AS text
  FROM words ANTI JOIN gone USING (doc_id, pos) GROUP BY doc_id
)
SELECT doc_id, len(w) AS n_words, coalesce(n, 0) AS n_removed,
  sha256(coalesce(text, '')) AS kept_sha256
FROM d LEFT JOIN kept USING (doc_id)
LEFT JOIN (SELECT doc_id, count(*) AS n FROM gone GROUP BY doc_id) USING (doc_id)
"""

# {links} is (a, b) in both directions
REACHED = """reached AS (
  SELECT a AS id, a AS c FROM links UNION SELECT b, c FROM reached JOIN links ON id = a
),
classes AS (SELECT id, min(c) AS c FROM reached GROUP BY id)"""

NEAR_TEXTS = f"""
WITH RECURSIVE d AS (
  SELECT doc_id, {WORDS.format(text=f"translate(coalesce(text, ''), '{UPPER}', '{LOWER}')")} AS w
  FROM documents
),
s AS (
  SELECT DISTINCT doc_id, unnest(CASE
    WHEN len(w) >= 4 THEN list_transform(range(1, len(w) - 2), lambda i: array_to_string(w[i:i + 3], ' '))
    WHEN len(w) > 0 THEN [array_to_string(w, ' ')] ELSE [] END) AS s FROM d
),
n AS (SELECT doc_id, count(*) AS n FROM s GROUP BY doc_id),
both_ AS (
  SELECT x.doc_id AS a, y.doc_id AS b, count(*) AS m FROM s x JOIN s y USING (s)
  WHERE x.doc_id <> y.doc_id GROUP BY ALL
),
links AS (
  SELECT a, b FROM both_ JOIN n na ON na.doc_id = a JOIN n nb ON nb.doc_id = b
  WHERE 100 * m >= 80 * (na.n + nb.n - m)
),
{REACHED}
SELECT doc_id, coalesce(n, 0) AS n_shingles, coalesce(c, doc_id) AS component_id,
  doc_id = coalesce(c, doc_id) AS kept
FROM d LEFT JOIN n USING (doc_id) LEFT JOIN classes ON doc_id = id
"""

NEAR_VECTORS = f"""
WITH RECURSIVE e AS (
  SELECT vec_id, v, sqrt(list_inner_product(v, v)) AS l
  FROM (SELECT vec_id, embedding::DOUBLE[] AS v FROM embeddings)
  WHERE len(v) > 0 AND len(list_filter(v, lambda x: x IS NULL OR NOT isfinite(x))) = 0
    AND list_inner_product(v, v) > 0
),
links AS (
  SELECT x.vec_id AS a, y.vec_id AS b FROM e x JOIN e y
  ON x.vec_id <> y.vec_id AND len(x.v) = len(y.v)
  WHERE list_inner_product(x.v, y.v) / (x.l * y.l) >= 0.9
),
{REACHED}
SELECT vec_id, coalesce(n, 0) AS n_links, coalesce(c, vec_id) AS component_id,
  vec_id = coalesce(c, vec_id) AS kept
FROM embeddings LEFT JOIN classes ON vec_id = id
LEFT JOIN (SELECT a, count(*) AS n FROM links GROUP BY a) ON vec_id = a
"""


# CRC-32 byte by byte, with the table of its 256 remainders; letters are below U+0100
SPELLING = f"""
WITH RECURSIVE crc_table AS (
  SELECT list_transform(range(256), lambda c: list_reduce(list_prepend(c, [0, 0, 0, 0, 0, 0, 0, 0]),
    lambda a, x: CASE WHEN a & 1 = 1 THEN xor(a >> 1, 3988292384) ELSE a >> 1 END)) AS t
),
runs AS (
  SELECT doc_id, unnest(regexp_extract_all(translate(coalesce(text, ''), '{UPPER}', '{LOWER}'),
    '[A-Za-z\u00C0-\u00FF]+')) AS run FROM documents
),
keyed AS (
  SELECT run, count(*) AS n, flatten(list_transform(string_split(coalesce(doc_id::VARCHAR, '') || ':' || run, ''),
    lambda c: CASE WHEN ord(c) < 128 THEN [ord(c)] ELSE [192 + (ord(c) >> 6), 128 + (ord(c) & 63)] END)) AS bytes
  FROM runs WHERE length(run) >= 5 GROUP BY doc_id, run
),
hashed AS (
  SELECT run, n, xor(list_reduce(list_prepend(4294967295, list_transform(bytes, lambda b: b::BIGINT)),
    lambda a, b: xor(a >> 8, t[(xor(a, b) & 255) + 1])), 4294967295) AS h FROM keyed, crc_table
),
v AS (
  SELECT word, sum(n)::BIGINT AS n FROM (
    SELECT n, CASE WHEN h % 97 = 0 THEN run[:h % length(run)] || run[h % length(run) + 2:] ELSE run END AS word
    FROM hashed) WHERE length(word) >= 5 GROUP BY word HAVING sum(n) >= 3
),
cut AS (SELECT word, n, unnest(range(1, length(word) + 1)) AS i FROM v),
less AS (SELECT word, n, i, word[:i - 1] || word[i + 1:] AS d FROM cut),
near AS (
  SELECT less.word AS a, v.word AS b, v.n AS n FROM less JOIN v ON d = v.word
  UNION SELECT v.word, less.word, less.n FROM less JOIN v ON d = v.word
  UNION SELECT x.word, y.word, y.n FROM less x JOIN less y USING (i, d) WHERE x.word <> y.word
),
best AS (
  SELECT a, first(b ORDER BY n DESC, b) AS b, max(n) AS most, count(*) AS n_near FROM near GROUP BY a
),
told AS (
  SELECT word, n, coalesce(n_near, 0) AS n_near, CASE WHEN most >= 2 * n THEN b END AS form,
    CASE WHEN most >= 2 * n THEN most END AS form_n FROM v LEFT JOIN best ON a = word
),
chain AS (
  SELECT word, word AS root, 0 AS steps FROM told
  UNION ALL SELECT chain.word, form, steps + 1 FROM chain JOIN told ON told.word = root WHERE form IS NOT NULL
),
ends AS (SELECT word, arg_max(root, steps) AS root FROM chain GROUP BY word)
SELECT word, form, root, n, n_near, form_n FROM told JOIN ends USING (word)
"""

COLLOCATIONS = f"""
WITH pieces AS (
  SELECT coalesce(lang, 'und') AS lang, unnest(string_split_regex(
    translate(coalesce(text, ''), '{UPPER}', '{LOWER}'), '[.,;:!?\x0A-\x0D]')) AS piece FROM documents
),
worded AS (SELECT lang, regexp_extract_all(piece, '[^\x20\x09]+') AS w FROM pieces),
totals AS (SELECT lang, sum(len(w))::BIGINT AS n FROM worded GROUP BY lang),
runs AS (
  SELECT lang, k, unnest(list_transform(range(1, len(w) - k + 2),
    lambda i: array_to_string(w[i:i + k - 1], ' '))) AS phrase
  FROM worded, range(1, 6) sizes(k) WHERE len(w) >= k
),
f AS (SELECT lang, k, phrase, count(*) AS f FROM runs GROUP BY ALL HAVING count(*) >= 100),
cuts AS (
  SELECT lang, k, phrase, f AS a, string_split(phrase, ' ') AS w, unnest(range(1, k)) AS i FROM f WHERE k > 1
),
scored AS (
  SELECT c.lang, c.k, c.phrase, a, l.f AS l, r.f AS r, n, i,
    ((1000::HUGEINT * a * n) // (l.f::HUGEINT * r.f))::BIGINT AS score
  FROM cuts c JOIN totals USING (lang)
  JOIN f l ON l.lang = c.lang AND l.phrase = array_to_string(w[1:i], ' ')
  JOIN f r ON r.lang = c.lang AND r.phrase = array_to_string(w[i + 1:], ' ')
),
weakest AS (
  SELECT * FROM scored QUALIFY row_number() OVER (PARTITION BY lang, phrase ORDER BY score, i) = 1
),
kept AS (
  SELECT * FROM weakest s WHERE NOT EXISTS (
    SELECT 1 FROM f x WHERE x.lang = s.lang AND x.k > s.k AND 100 * x.f >= 100 * s.a
    AND contains(' ' || x.phrase || ' ', ' ' || s.phrase || ' '))
),
ranked AS (
  SELECT *, row_number() OVER (PARTITION BY lang ORDER BY score DESC, a DESC, phrase) AS rank FROM kept
)
SELECT lang, rank, phrase, a, l, r, n, score FROM ranked WHERE rank <= 2000
"""


def _licenses() -> str:
    def rows(values):
        return ", ".join("(" + ", ".join(_literal(v) if isinstance(v, str) else str(v) for v in row) + ")" for row in values)

    numbered = list(enumerate(TEMPLATES))
    words = [(t, p, w.decode()) for t, known in numbered for p, w in enumerate(known.words)]
    heads = [(t, known.label, len(known.words), known.percent, known.slack, len(known.keys)) for t, known in numbered]
    keys = [
        (t, k, p, w.decode(), len(key))
        for t, known in numbered
        for k, key in enumerate(known.key_words)
        for p, w in enumerate(key)
    ]
    base = len(PHRASES)
    return f"""
WITH words(t, p, word) AS (VALUES {rows(words)}),
heads(t, label, size, percent, slack, n_keys) AS (VALUES {rows(heads)}),
keys(t, k, p, word, size) AS (VALUES {rows(keys)}),
known AS (SELECT word FROM words UNION SELECT word FROM keys),
d AS (
  SELECT row_number() OVER () AS r, doc_id, regexp_extract_all(
    translate(coalesce(text, ''), '{UPPER}', '{LOWER}'), '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS w FROM documents
),
every AS (SELECT r, unnest(w) AS word, generate_subscripts(w, 1) - 1 AS pos FROM d),
occ AS (SELECT * FROM every SEMI JOIN known USING (word)),
rarity AS (
  SELECT word, 1 + floor(1000 * ln(((SELECT count(*) FROM d) + 1) / (count(DISTINCT r) + 1)))::BIGINT AS weight
  FROM known LEFT JOIN occ USING (word) GROUP BY word
),
weighed AS (SELECT words.*, weight FROM words JOIN rarity USING (word)),
needs AS (SELECT t, sum(weight) AS total FROM weighed GROUP BY t),
present AS (SELECT DISTINCT r, word FROM occ),
possible AS (
  SELECT r, t FROM present JOIN weighed USING (word) JOIN needs USING (t) JOIN heads USING (t)
  GROUP BY r, t, total, percent HAVING 100 * sum(weight) >= percent * total
),
there AS (
  SELECT DISTINCT r, t, p, weight, pos - p - unnest(range(-slack, slack + 1)) AS start
  FROM possible JOIN weighed USING (t) JOIN heads USING (t) JOIN occ USING (r, word)
),
supported AS (
  SELECT r, t, start, sum(weight) AS support FROM there GROUP BY r, t, start
),
enough AS (
  SELECT r, t, start, size, slack, n_keys, support / total AS score FROM supported JOIN needs USING (t)
  JOIN heads USING (t) WHERE 100 * support >= percent * total
),
key_places AS (
  SELECT r, t, k, pos - p AS at, size FROM occ JOIN keys USING (word) SEMI JOIN possible USING (r, t)
  GROUP BY r, t, k, pos - p, size HAVING count(*) = size
),
verified AS (
  SELECT r, t, start, any_value(score) AS score FROM enough e JOIN key_places k USING (r, t)
  WHERE k.at BETWEEN start - slack AND start + e.size - k.size + slack
  GROUP BY r, t, start, n_keys HAVING count(DISTINCT k.k) = n_keys
),
places AS (
  SELECT r, t, start, score FROM verified
  UNION ALL SELECT r, t, start, score FROM enough WHERE n_keys = 0
),
told AS (
  SELECT r, count(*) FILTER (t < {base}) AS n_base, min(start) FILTER (t < {base}) AS first_word,
    max(start) FILTER (t < {base}) AS last_word,
    array_to_string(list_sort(list_distinct(list(label) FILTER (t < {base}))), ',') AS base_labels,
    array_to_string(list_sort(list_distinct(list(label))), ',') AS labels, max(score) AS score
  FROM places JOIN heads USING (t) GROUP BY r
)
SELECT doc_id, len(w) AS n_words, coalesce(n_base, 0) AS n_base, first_word, last_word,
  coalesce(base_labels, '') AS base_labels, coalesce(labels, '') AS labels, coalesce(score, 0.0)::DOUBLE AS score
FROM d LEFT JOIN told USING (r)
"""


def oracle_sql() -> dict[str, str]:
    return {
        "op5_anchored_repeats": REPEATS,
        "op6_subspace_join": NEAR_VECTORS,
        "op7_warc_archive": WARC,
        "op9_minhash_join": NEAR_TEXTS,
        "op10_secret_scan": _secrets(),
        "op11_spelling_variants": SPELLING,
        "op12_collocations": COLLOCATIONS,
        "op13_license_scan": _licenses(),
    }

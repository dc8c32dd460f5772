"""The SQL that queries of this package must agree with, where SQL can say it.

Rules and constants are written out anew here. The queries without SQL learn
from the data, hash, or tokenize; tests hold them against brute force.
"""

from __future__ import annotations

WORDS = r"regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+')"
# Lower-case letters A-Z alone.
FOLDED = (
    "translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz')"
)

EXACT = f"""
WITH d AS (SELECT doc_id, {FOLDED} AS t FROM documents)
SELECT doc_id,
       max(doc_id) OVER (PARTITION BY t) AS keep_id,
       count(*) OVER (PARTITION BY t) AS group_size,
       doc_id = max(doc_id) OVER (PARTITION BY t) AS kept,
       sha256(t) AS text_sha256
FROM d
"""

SUBSTRING = f"""
WITH d AS (SELECT doc_id, {WORDS} AS ws FROM documents),
w AS (
  SELECT doc_id, i, array_to_string(ws[i:i + 49], ' ') AS win
  FROM d, unnest(generate_series(1, len(ws) - 49)) AS s(i)
),
m AS (SELECT win, min(doc_id) AS first_id FROM w GROUP BY win),
starts AS (
  SELECT w.doc_id, w.i FROM w JOIN m USING (win) WHERE m.first_id < w.doc_id
),
words AS (SELECT doc_id, p, ws[p] AS word FROM d, unnest(generate_series(1, len(ws))) AS s(p)),
marked AS (
  SELECT w.doc_id, w.p, w.word,
         max(s.i) OVER (PARTITION BY w.doc_id ORDER BY w.p) AS last_start
  FROM words w LEFT JOIN starts s ON s.doc_id = w.doc_id AND s.i = w.p
),
r AS (
  SELECT doc_id,
         count(*) FILTER (WHERE last_start IS NOT NULL AND p - last_start < 50) AS n_removed,
         string_agg(word, ' ' ORDER BY p)
           FILTER (WHERE last_start IS NULL OR p - last_start >= 50) AS kept
  FROM marked GROUP BY doc_id
)
SELECT d.doc_id, len(d.ws) AS n_words, coalesce(r.n_removed, 0) AS n_removed,
       sha256(coalesce(r.kept, '')) AS kept_sha256
FROM d LEFT JOIN r USING (doc_id)
"""

JACCARD = f"""
WITH RECURSIVE d AS (
  SELECT doc_id, regexp_extract_all({FOLDED}, '[^\\x20\\x09-\\x0D]+') AS ws FROM documents
),
s AS MATERIALIZED (
  SELECT DISTINCT doc_id, array_to_string(ws[i:i + 4], ' ') AS g
  FROM d, unnest(generate_series(1, greatest(len(ws) - 4, 1))) AS x(i)
  WHERE len(ws) > 0
),
n AS (SELECT doc_id, count(*) AS n FROM s GROUP BY doc_id),
pairs AS (
  SELECT a.doc_id AS a, b.doc_id AS b, count(*) AS shared
  FROM s a JOIN s b ON a.g = b.g AND a.doc_id < b.doc_id GROUP BY 1, 2
),
links AS MATERIALIZED (
  SELECT a, b FROM pairs JOIN n x ON x.doc_id = a JOIN n y ON y.doc_id = b
  WHERE 100 * shared >= 80 * (x.n + y.n - shared)
),
ways AS (SELECT a, b FROM links UNION ALL SELECT b, a FROM links),
reach(node, root) AS (
  SELECT doc_id, doc_id FROM d
  UNION
  SELECT w.b, r.root FROM reach r JOIN ways w ON w.a = r.node WHERE r.root < w.b
)
SELECT d.doc_id, coalesce(n.n, 0) AS n_shingles,
       least(d.doc_id, coalesce(c.root, d.doc_id)) AS component_id
FROM d LEFT JOIN n USING (doc_id)
LEFT JOIN (SELECT node, min(root) AS root FROM reach GROUP BY node) c ON c.node = d.doc_id
"""

SWEEPS = 20


def _mixing() -> str:
    """Sweeps of the raking spelled out one after another."""
    steps = [
        f"""
d AS MATERIALIZED (
  SELECT doc_id, coalesce(source, '(none)') AS source, coalesce(lang, '(none)') AS lang,
         CASE WHEN contains(t, ' | ') THEN 'table'
              WHEN regexp_matches(t, '[*#$%&]{{3}}') THEN 'markup'
              WHEN contains(t, '!! ') THEN 'shouting'
              WHEN contains(t, '@') OR regexp_matches(t, '[0-9]{{3}}-[0-9]{{4}}') THEN 'contact'
              ELSE 'prose' END AS topic,
         len({WORDS}) AS n_tokens
  FROM (SELECT *, coalesce(text, '') AS t FROM documents)
),
cells AS MATERIALIZED (
  SELECT source, lang, topic, sum(n_tokens)::DOUBLE AS tokens FROM d GROUP BY ALL
),
goals AS MATERIALIZED (
  SELECT *,
    pow(sum(tokens) OVER (PARTITION BY source), 0.95) AS gs,
    pow(sum(tokens) OVER (PARTITION BY lang), 0.95) AS gl,
    sum(tokens) OVER (PARTITION BY topic) AS gt
  FROM cells WHERE tokens > 0
),
w0 AS MATERIALIZED (
  SELECT source, lang, topic, tokens, tokens AS w,
    gs / (SELECT sum(DISTINCT_GS) FROM (SELECT any_value(gs) AS DISTINCT_GS FROM goals GROUP BY source)) AS ps,
    gl / (SELECT sum(x) FROM (SELECT any_value(gl) AS x FROM goals GROUP BY lang)) AS pl,
    gt / (SELECT sum(x) FROM (SELECT any_value(gt) AS x FROM goals GROUP BY topic)) AS pt
  FROM goals
)"""
    ]
    last = "w0"
    for i in range(SWEEPS):
        for column, share in (("source", "ps"), ("lang", "pl"), ("topic", "pt")):
            name = f"w{i}_{column}"
            steps.append(
                f"{name} AS MATERIALIZED (SELECT source, lang, topic, tokens, "
                f"w * {share} / sum(w) OVER (PARTITION BY {column}) AS w, ps, pl, pt FROM {last})"
            )
            last = name
    return (
        "WITH "
        + ",\n".join(steps)
        + f""",
p AS (SELECT source, lang, topic, (w / tokens) / max(w / tokens) OVER () AS p FROM {last}),
q AS (
  SELECT d.*, CASE WHEN n_tokens = 0 THEN 1.0 ELSE coalesce(p, 1.0) END AS probability
  FROM d LEFT JOIN p USING (source, lang, topic)
)
SELECT doc_id, source, lang, topic, n_tokens, round(probability, 6) AS probability,
       ('0x' || substr(md5('mix-1:' || doc_id), 1, 13))::BIGINT / 4503599627370496.0 < probability AS kept
FROM q
"""
    )


# CRC-32 of '<doc_id>:<run>', byte by byte over a table of 256 remainders.
SPELLING = rf"""
WITH RECURSIVE steps(i, k, c) AS (
  SELECT i, 0, i::BIGINT FROM generate_series(0, 255) AS s(i)
  UNION ALL
  SELECT i, k + 1, CASE WHEN c % 2 = 1 THEN xor(c >> 1, 3988292384) ELSE c >> 1 END
  FROM steps WHERE k < 8
),
tab AS MATERIALIZED (SELECT list(c ORDER BY i) AS t FROM steps WHERE k = 8),
runs AS (
  SELECT doc_id, unnest(regexp_extract_all({FOLDED}, '[A-Za-zÀ-ÿ]{{7,}}')) AS run FROM documents
),
counted AS MATERIALIZED (SELECT doc_id, run, count(*) AS n FROM runs GROUP BY ALL),
spelled AS (
  SELECT run, n, flatten(list_transform(
    string_split(coalesce(doc_id::VARCHAR, '') || ':' || run, ''),
    lambda x: CASE WHEN unicode(x) < 128 THEN [unicode(x)::BIGINT]
                   ELSE [192 + (unicode(x) >> 6)::BIGINT, 128 + (unicode(x) % 64)::BIGINT] END)) AS b
  FROM counted
),
hashed AS (
  SELECT run, n, xor(list_reduce(list_prepend(4294967295, b),
    lambda c, x: xor(c >> 8, t[xor(c % 256, x) + 1])), 4294967295) AS h
  FROM spelled, tab
),
cut AS (
  SELECT CASE WHEN h % 31 = 0 THEN left(run, h % length(run)) || substr(run, h % length(run) + 2)
              ELSE run END AS word, n
  FROM hashed
),
words AS MATERIALIZED (
  SELECT word, sum(n)::BIGINT AS n FROM cut WHERE length(word) >= 7 GROUP BY word HAVING sum(n) >= 2
),
less AS MATERIALIZED (
  SELECT word, n, i, left(word, i - 1) || substr(word, i + 1) AS rest
  FROM words, unnest(generate_series(1, length(word))) AS s(i)
),
near AS MATERIALIZED (
  SELECT a.word, b.word AS other, b.n FROM less a JOIN less b
    ON a.rest = b.rest AND a.i = b.i AND a.word <> b.word
  UNION SELECT l.word, w.word, w.n FROM less l JOIN words w ON l.rest = w.word
  UNION SELECT w.word, l.word, l.n FROM less l JOIN words w ON l.rest = w.word
),
best AS (
  SELECT word, count(*) AS n_near, first(other ORDER BY n DESC, other) AS other, max(n) AS top
  FROM near GROUP BY word
),
formed AS MATERIALIZED (
  SELECT w.word, w.n, coalesce(b.n_near, 0) AS n_near,
         CASE WHEN b.top >= 10 * w.n THEN b.other END AS form,
         CASE WHEN b.top >= 10 * w.n THEN b.top END AS form_n
  FROM words w LEFT JOIN best b USING (word)
),
follow(word, root, step) AS (
  SELECT word, form, 1 FROM formed WHERE form IS NOT NULL
  UNION ALL
  SELECT f.word, g.form, step + 1 FROM follow f JOIN formed g ON g.word = f.root WHERE g.form IS NOT NULL
)
SELECT f.word, f.form, coalesce(r.root, f.word) AS root, f.n, f.n_near, f.form_n
FROM formed f
LEFT JOIN (SELECT word, arg_max(root, step) AS root FROM follow GROUP BY word) r USING (word)
"""

DIVERGENCE = rf"""
WITH d AS (
  SELECT row_number() OVER () AS row, coalesce(lang, '') AS lang, coalesce(source, '') AS source,
         regexp_extract_all({FOLDED}, '[^\x00-\x40\x5B-\x60\x7B-\x7F]+') AS terms
  FROM documents
),
w AS MATERIALIZED (
  SELECT lang, source, row, term, count(*) AS n
  FROM (SELECT lang, source, row, unnest(terms) AS term FROM d) GROUP BY ALL
),
kept AS MATERIALIZED (SELECT lang, term FROM w GROUP BY ALL HAVING count(*) >= 10),
groups AS MATERIALIZED (SELECT DISTINCT lang, source FROM d),
c AS (SELECT lang, source, term, sum(n) AS n FROM w JOIN kept USING (lang, term) GROUP BY ALL),
every AS MATERIALIZED (
  SELECT lang, source, term, coalesce(n, 0)::HUGEINT AS n
  FROM groups JOIN kept USING (lang) LEFT JOIN c USING (lang, source, term)
),
own AS MATERIALIZED (
  SELECT lang, source, term, n,
    1 + 1000000000::HUGEINT * (n + 2) //
      (sum(n) OVER (PARTITION BY lang, source) + 2 * count(*) OVER (PARTITION BY lang, source)) AS p
  FROM every
),
whole AS (
  SELECT lang, term, 1 + 1000000000::HUGEINT * (n + 2) //
    (sum(n) OVER (PARTITION BY lang) + 2 * count(*) OVER (PARTITION BY lang)) AS q
  FROM (SELECT lang, term, sum(n)::HUGEINT AS n FROM every GROUP BY ALL)
),
sums AS (
  SELECT a.lang, a.source, b.source AS item, sum((a.p - b.p) * (a.p - b.p) // (a.p + b.p)) AS value
  FROM own a JOIN own b USING (lang, term) WHERE a.source <> b.source GROUP BY ALL
),
pairs AS (
  SELECT a.lang, a.source, 'pair' AS part, b.source AS item, coalesce(s.value, 0)::BIGINT AS value
  FROM groups a JOIN groups b ON a.lang = b.lang AND a.source <> b.source
  LEFT JOIN sums s ON s.lang = a.lang AND s.source = a.source AND s.item = b.source
),
tops AS (
  SELECT lang, source, 'term' AS part, term AS item, ((p - q) * (p - q) // (p + q))::BIGINT AS value
  FROM own JOIN whole USING (lang, term) WHERE n > 0 AND p > q
)
SELECT lang, source, part, item, value,
       (row_number() OVER (PARTITION BY lang, source, part ORDER BY value DESC, item))::INTEGER AS rank
FROM (SELECT * FROM pairs UNION ALL SELECT * FROM tops)
QUALIFY part = 'pair' OR rank <= 10
"""


def all_sql() -> dict[str, str]:
    return {
        "op3_exact_dedup": EXACT,
        "op4_substring_dedup": SUBSTRING,
        "op5_raked_mixing": _mixing(),
        "op9_jaccard_join": JACCARD,
        "op11_spelling_variants": SPELLING,
        "op13_source_divergence": DIVERGENCE,
    }

"""Queries: phrase collocations, secrets, whitened embeddings."""

from __future__ import annotations

from pyspark.sql import functions as F

from corpuskit.llm import credentials
from corpuskit.llm.collocations import collocations
from corpuskit.llm.common import table
from corpuskit.llm.registry import query
from corpuskit.llm.whitening import whitened_embeddings

PHRASES_SQL = r"""
WITH pieces AS (
       SELECT coalesce(lang, 'und') AS lang, unnest(regexp_split_to_array(translate(coalesce(text, ''),
              'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[.,;:!?\x0A-\x0D]')) AS p
       FROM documents),
     words AS (
       SELECT lang, list_filter(regexp_split_to_array(p, '[\x20\x09]+'), lambda x: x <> '') AS w FROM pieces),
     grams AS (
       SELECT lang, k, unnest([array_to_string(w[i:i + k - 1], ' ') FOR i IN range(1, len(w) - k + 2)]) AS phrase
       FROM words, range(1, 5) r(k)),
     counts AS (SELECT lang, k, phrase, count(*) AS n FROM grams GROUP BY ALL HAVING count(*) >= 30),
     totals AS (SELECT lang, sum(len(w))::BIGINT AS n FROM words GROUP BY lang),
     inside AS (
       SELECT lang, n, unnest(flatten([[array_to_string(w[i:i + m - 1], ' ') FOR i IN range(1, k - m + 2)]
                                       FOR m IN range(2, k)])) AS phrase
       FROM (SELECT lang, k, n, string_split(phrase, ' ') AS w FROM counts WHERE k > 2)),
     longer AS (SELECT lang, phrase, max(n) AS longer FROM inside GROUP BY ALL),
     cuts AS (
       SELECT c.lang, c.phrase, c.n AS a, j, array_to_string(string_split(c.phrase, ' ')[1:j], ' ') AS head,
              array_to_string(string_split(c.phrase, ' ')[j + 1:], ' ') AS rest
       FROM counts c LEFT JOIN longer l ON c.lang = l.lang AND c.phrase = l.phrase, range(1, 4) t(j)
       WHERE c.k >= 2 AND j < c.k AND (l.longer IS NULL OR 100::HUGEINT * l.longer < 80::HUGEINT * c.n)),
     scored AS (
       SELECT c.lang, c.phrase, a, j, f.n AS l, g.n AS r, ((2000000::HUGEINT * a) // (f.n + g.n))::BIGINT AS score
       FROM cuts c JOIN counts f ON c.lang = f.lang AND c.head = f.phrase
       JOIN counts g ON c.lang = g.lang AND c.rest = g.phrase),
     worst AS (SELECT * FROM scored QUALIFY row_number() OVER (PARTITION BY lang, phrase ORDER BY score, j) = 1),
     ranked AS (
       SELECT *, row_number() OVER (PARTITION BY lang ORDER BY score DESC, a DESC, phrase) AS rank FROM worst)
SELECT r.lang, rank, phrase, a, l, r.r, t.n, score FROM ranked r JOIN totals t ON r.lang = t.lang WHERE rank <= 2000
"""

_PATTERN = {k: p.replace("'", "''") for k, p in credentials.PATTERNS.items()}


def _marked(kind: str) -> str:
    """Rows (r, t, kind, i, piece): the text cut before each match, with a mark behind the match."""
    return f"""SELECT r, t, '{kind}' AS kind, unnest(cut) AS piece, generate_subscripts(cut, 1) AS i FROM (
        SELECT r, t, string_split(regexp_replace(t, '{_PATTERN[kind]}', chr(57344) || '\\0' || chr(57345), 'g'), chr(57344)) AS cut
        FROM texts)"""


_VALUE = "length(regexp_extract(m, '{}', {}))"
SECRETS_SQL = f"""
WITH texts AS (SELECT row_number() OVER () AS r, doc_id, coalesce(text, '') AS t FROM documents),
     cuts AS ({" UNION ALL ".join(_marked(k) for k in credentials.KINDS)}),
     places AS (
       SELECT r, t, kind, i, string_split(piece, chr(57345))[1] AS m,
              sum(length(piece) - CASE WHEN i > 1 THEN 1 ELSE 0 END) OVER (PARTITION BY r, kind ORDER BY i)
                - length(piece) + CASE WHEN i > 1 THEN 1 ELSE 0 END AS s
       FROM cuts),
     matches AS (
       SELECT r, kind, s::INT AS s, (s + length(m))::INT AS e, len(string_split(substr(t, 1, s::INT), chr(10) || chr(10))) AS scope
       FROM places WHERE i > 1 AND CASE kind
         WHEN 'assign' THEN {_VALUE.format(_PATTERN["assign"], 2)} >= 6
         WHEN 'access' THEN length(m) >= 20
         WHEN 'hex' THEN length(m) >= 24
         WHEN 'account' THEN {_VALUE.format(_PATTERN["account"], 2)} >= 3
         WHEN 'opaque' THEN length(m) >= 20 AND regexp_matches(m, '[a-z]') AND regexp_matches(m, '[A-Z]') AND regexp_matches(m, '[0-9]')
         ELSE contains(m, '://') OR {_VALUE.format(_PATTERN["endpoint"], 3)} >= 4 END),
     kinds(kind, place, role, strong) AS (VALUES
       ('assign', 1, 'secret', true), ('access', 2, 'identifier', true), ('hex', 3, 'secret', true),
       ('account', 4, 'identifier', false), ('opaque', 5, 'secret', false), ('endpoint', 6, 'endpoint', false)),
     named AS (SELECT * FROM matches JOIN kinds USING (kind)),
     whole AS (
       SELECT * FROM named a WHERE NOT EXISTS (
         SELECT 1 FROM named b WHERE a.r = b.r AND b.e > a.s AND b.s < a.e
         AND ((a.kind = 'account' AND b.strong) OR (a.kind = 'opaque' AND b.strong)))),
     parts AS (
       SELECT * FROM whole a WHERE NOT (a.kind = 'opaque' AND EXISTS (
         SELECT 1 FROM whole b WHERE a.r = b.r AND b.kind <> 'opaque' AND b.e > a.s AND b.s < a.e))),
     linked AS (
       SELECT a.r, a.kind, a.s, a.e FROM parts a JOIN parts b ON a.r = b.r AND a.scope = b.scope
         AND greatest(a.s, b.s) - least(a.e, b.e) <= {credentials.REACH}
       WHERE NOT a.strong GROUP BY ALL
       HAVING bool_or(b.role = 'secret') AND bool_or(b.role = 'identifier') AND (bool_or(b.strong) OR bool_or(b.role = 'endpoint'))),
     spans AS (
       SELECT r, kind, place, s, e, strong FROM parts WHERE strong
       UNION ALL SELECT l.r, l.kind, k.place, l.s, l.e, false FROM linked l JOIN kinds k USING (kind)),
     found AS (
       SELECT r, count(*) FILTER (kind = 'assign') AS n_assign, count(*) FILTER (kind = 'access') AS n_access,
              count(*) FILTER (kind = 'hex') AS n_hex,
              string_agg(kind || ':' || s || ':' || e, ',' ORDER BY s, place) FILTER (strong) AS base,
              string_agg(kind || ':' || s || ':' || e, ',' ORDER BY s, place) AS spans
       FROM spans GROUP BY r)
SELECT doc_id, coalesce(n_assign, 0) AS n_assign, coalesce(n_access, 0) AS n_access, coalesce(n_hex, 0) AS n_hex,
       sha256(coalesce(base, '')) AS base_sha256, coalesce(spans, '') AS spans
FROM texts LEFT JOIN found USING (r)
"""


@query("op11_linked_credentials", SECRETS_SQL)
def op11_linked_credentials(spark, sf_dir):
    """Every document with its numbers of strong parts and all reported spans."""
    found = credentials.find_secrets(table(spark, sf_dir, "documents").select("doc_id", "text"))

    def number(kind: str):
        return F.size(credentials.of_kinds(F.col("spans"), kind)).cast("long").alias("n_" + kind)

    base = credentials.joined(credentials.of_kinds(F.col("spans"), *credentials.STRONG))
    return found.select("doc_id", *[number(k) for k in credentials.STRONG], F.sha2(base.cast("binary"), 256).alias("base_sha256"),
                        credentials.joined(F.col("spans")).alias("spans"))


@query("op12_feast_whitening")
def op12_feast_whitening(spark, sf_dir):
    """Every finite vector on the eight leading components of all of them."""
    return whitened_embeddings(table(spark, sf_dir, "embeddings"))


@query("op13_de_bruijn", PHRASES_SQL)
def op13_de_bruijn(spark, sf_dir):
    """Each language's first 2,000 collocations."""
    return collocations(table(spark, sf_dir, "documents"))

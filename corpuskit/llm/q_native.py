"""Queries: mixing to target weights, sharding."""

from __future__ import annotations

from corpuskit.llm.common import table
from corpuskit.llm.hash_tree import children, even_tree, grown, shard_documents
from corpuskit.llm.poisson_mix import poisson_mix, rates_by_power
from corpuskit.llm.registry import query

SHARDS = 40
MIX_SEED = "mix"

# hash52(parts) / 2^52 as in common.unit
_UNIT = "(('0x' || substr(md5({}), 1, 13))::BIGINT::DOUBLE + 0.5) / 4503599627370496.0"

# a piece's mean is 32 at most: beyond 200 its masses are 0 in double precision
MIX_SQL = f"""
WITH sizes AS (SELECT source, sum(length(coalesce(text, ''))) AS size FROM documents
               GROUP BY source HAVING sum(length(coalesce(text, ''))) > 0),
     tot AS (SELECT sum(size)::DOUBLE AS t, sum(pow(size::DOUBLE, 0.5)) AS w FROM sizes),
     rates AS (SELECT source, t * (pow(size::DOUBLE, 0.5) / w) / size AS rate FROM sizes, tot),
     steps AS (SELECT source, rate, greatest(ceil(rate / 32.0)::INT, 1) AS pieces FROM rates),
     masses AS (SELECT source, k, exp(-(rate / pieces) + k * ln(rate / pieces) - lgamma(k + 1)) AS p
                FROM steps, range(0, 200) r(k)),
     cdf AS (SELECT source, sum(p) OVER (PARTITION BY source ORDER BY k) AS c FROM masses),
     draws AS (SELECT d.rowid AS r, d.source, {_UNIT.format("'mix:' || coalesce(d.doc_id::VARCHAR, '~') || ':' || md5(coalesce(d.text, '')) || ':' || i")} AS u
               FROM (SELECT row_number() OVER () AS rowid, * FROM documents) d
               JOIN steps s ON d.source IS NOT DISTINCT FROM s.source, unnest(range(1, pieces + 1)) i(i)),
     counts AS (SELECT r, sum((SELECT count(*) FROM cdf WHERE cdf.source IS NOT DISTINCT FROM draws.source AND cdf.c <= u))::INT AS n
                FROM draws GROUP BY r)
SELECT d.doc_id, d.text, d.lang, d.source, d.n_chars, round(s.rate, 6) AS rate, n AS n_copies, j::INT AS copy,
       ('0x' || substr(md5('mix/order:' || coalesce(d.doc_id::VARCHAR, '~') || ':' || md5(coalesce(d.text, '')) || ':' || j), 1, 13))::BIGINT AS shuffle_key
FROM (SELECT row_number() OVER () AS rowid, * FROM documents) d
JOIN counts ON r = rowid JOIN steps s ON d.source IS NOT DISTINCT FROM s.source, unnest(range(1, n + 1)) t(j)
"""


@query("op9_poisson_mix", MIX_SQL)
def op9_poisson_mix(spark, sf_dir):
    docs = table(spark, sf_dir, "documents")
    mixed = poisson_mix(docs, rates_by_power(docs), seed=MIX_SEED)
    from pyspark.sql import functions as F

    return mixed.withColumn("rate", F.round("rate", 6))


def tree_sql(tree) -> str:
    """The descent written level by level: of a parent's children the one with the smallest draw."""
    rows = [(level, parent, child, weight) for level in range(3)
            for parent, kids in children(tree, level).items() for child, weight in kids.items() if weight > 0]
    return ", ".join(f"({level}, '{parent}', '{child}', {weight}::DOUBLE)" for level, parent, child, weight in rows)


def _descent_sql(name: str, tree) -> str:
    levels = "".join(f""",
     {name}{level + 1} AS (SELECT a.k, arg_min(t.child, struct_pack(draw := -ln({_UNIT.format("a.k || ':' || t.child")}) / t.weight, c := t.child)) AS node
               FROM {name}{level} a JOIN {name} t ON t.level = {level} AND t.parent = a.node GROUP BY a.k)""" for level in range(3))
    return f"""{name}(level, parent, child, weight) AS (VALUES {tree_sql(tree)}),
     {name}0 AS (SELECT DISTINCT coalesce(doc_id::VARCHAR, '~') AS k, '' AS node FROM documents){levels}"""


# crc32 is a fold over a text's bytes with the table of the reversed polynomial
SHARD_SQL = f"""
WITH crcs AS (SELECT list(list_reduce(list_concat([i::BIGINT], range(8)),
                     lambda c, x: CASE WHEN c & 1 = 1 THEN xor(c >> 1, 3988292384) ELSE c >> 1 END) ORDER BY i) AS t
              FROM range(256) r(i)),
     texts AS (SELECT doc_id, hex(encode(coalesce(text, ''))) AS h FROM documents),
     rows_ AS (SELECT doc_id, (length(h) // 2 + 16)::BIGINT AS size,
                      xor(list_reduce(list_concat([4294967295::BIGINT],
                          list_transform(regexp_extract_all(h, '..'), lambda x: ('0x' || x)::BIGINT)),
                          lambda c, b: xor(c >> 8, t[(xor(c, b) & 255) + 1])), 4294967295) AS text_crc32
               FROM texts, crcs),
     each AS (SELECT *, row_number() OVER (PARTITION BY doc_id, size, text_crc32) AS copy_ FROM rows_),
     {_descent_sql("now_", even_tree(SHARDS))},
     {_descent_sql("later_", grown(even_tree(SHARDS)))},
     placed AS (SELECT e.*, split_part(n.node, '/', 3)::INT AS shard, split_part(l.node, '/', 3)::INT AS grown_shard,
                       {_UNIT.format("coalesce(doc_id::VARCHAR, '~') || ':' || size || ':' || text_crc32 || ':' || copy_")} AS u
                FROM each e JOIN now_3 n ON n.k = coalesce(doc_id::VARCHAR, '~') JOIN later_3 l ON l.k = n.k)
SELECT doc_id, size, text_crc32, 'key' AS law, shard,
       row_number() OVER (PARTITION BY shard ORDER BY u, doc_id, size, text_crc32, copy_) - 1 AS slot, grown_shard
FROM placed
"""


@query("op10_hash_tree", SHARD_SQL)
def op10_hash_tree(spark, sf_dir):
    return shard_documents(table(spark, sf_dir, "documents"), even_tree(SHARDS))

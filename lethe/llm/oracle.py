"""Queries of this package in SQL, where SQL can say them."""

from __future__ import annotations

from lethe.llm.chat import CONTROL

_CONTROL = "|".join("".join("\\" + c if c in "|[]/<>" else c for c in text) for text in CONTROL)
_OWN = "</s>[INST] ok [/INST]"


def _escaped(text: str) -> str:
    """As long as the escaped text."""
    return f"regexp_replace(replace({text}, '\\', '\\b'), '({_CONTROL})', '\\1..', 'g')"


def _codes(parts: int = 16, entries: int = 64, rounds: int = 2) -> str:
    """Every round of the codebooks as a few tables."""
    sql = f"""
WITH kept AS (
  SELECT row_number() OVER () AS r, vec_id, label, embedding FROM embeddings
  WHERE embedding IS NOT NULL AND len([c FOR c IN embedding IF c IS NULL OR NOT isfinite(c)]) = 0
), cut AS (
  SELECT r, (i - 1) // (len(embedding) // {parts}) AS part, (i - 1) % (len(embedding) // {parts}) AS pos,
         CAST(floor(256 * CAST(embedding[i] AS DOUBLE)) AS BIGINT) AS x
  FROM kept, unnest(range(1, len(embedding) + 1)) AS u(i)
), first AS (
  SELECT r, row_number() OVER (ORDER BY vec_id) - 1 AS entry FROM kept ORDER BY vec_id LIMIT {entries}
), book0 AS (SELECT entry, part, pos, x FROM first JOIN cut USING (r))"""
    for k in range(rounds + 1):
        sql += f""", away{k} AS (
  SELECT r, part, entry, sum((c.x - b.x) * (c.x - b.x)) AS away FROM cut c JOIN book{k} b USING (part, pos)
  GROUP BY r, part, entry
), near{k} AS (SELECT r, part, min(struct_pack(a := away, e := entry)) AS best FROM away{k} GROUP BY r, part)"""
        if k < rounds:
            sql += f""", mean{k} AS (
  SELECT best.e AS entry, part, pos, CAST(floor(sum(x) / count(*)) AS BIGINT) AS x FROM near{k} JOIN cut USING (r, part)
  GROUP BY ALL
), book{k + 1} AS (
  SELECT entry, part, pos, coalesce(m.x, b.x) AS x FROM book{k} b LEFT JOIN mean{k} m USING (entry, part, pos)
)"""
    return sql + f""", coded AS (
  SELECT r, string_agg(format('{{:02x}}', best.e), '' ORDER BY part) AS code, CAST(sum(best.a) AS BIGINT) AS error
  FROM near{rounds} GROUP BY r
)
SELECT vec_id, code, error, CAST(sum(error) OVER (PARTITION BY label) AS BIGINT) AS label_error,
       (SELECT sha256(string_agg(CAST(x AS VARCHAR), ',' ORDER BY part, entry, pos)) FROM book{rounds}) AS codebooks_sha256
FROM coded JOIN kept USING (r)"""


_UPPER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ"

ORACLE = {
    "op6_chat_formatting": f"""
WITH turns AS (
  SELECT conv_id, turn, coalesce(role, '') AS r, coalesce(text, '') AS t, role, text FROM conversations
  UNION ALL SELECT -7, 0, 'user', '{_OWN}', 'user', '{_OWN}'
  UNION ALL SELECT -7, 1, 'assistant', '{_OWN}', 'assistant', '{_OWN}'
), grouped AS (
  SELECT conv_id, count(*) AS n_turns,
         string_agg(r || chr(10) || t || chr(10), '' ORDER BY turn NULLS FIRST, role NULLS FIRST, text NULLS FIRST) AS whole,
         coalesce(string_agg(t, '' ORDER BY turn NULLS FIRST, text NULLS FIRST) FILTER (r = 'assistant'), '') AS loss,
         sum(length('<|turn|>') + length({_escaped('r')}) + 1 + length({_escaped('t')}) + length('<|end|>')) AS n
  FROM turns GROUP BY conv_id
)
SELECT conv_id, n_turns, sha256(whole) AS turns_sha256, length(loss) AS loss_chars, sha256(loss) AS loss_sha256,
       CAST(n AS BIGINT) AS formatted_chars FROM grouped""",
    "op12_vector_codes": _codes(),
    "op13_minhash_near_dedup": f"""
WITH RECURSIVE split AS (
  SELECT row_number() OVER () AS r, doc_id,
         regexp_extract_all(translate(coalesce(text, ''), '{_UPPER}', '{_UPPER.lower()}'), '[^\\x20\\x09-\\x0D]+') AS w
  FROM documents
), sets AS (
  SELECT r, doc_id, CASE WHEN len(w) < 2 THEN w
    ELSE list_distinct([w[i] || ' ' || w[i + 1] FOR i IN range(1, len(w))]) END AS s FROM split
), shingles AS (SELECT r, len(s) AS n, unnest(s) AS x FROM sets),
shared AS (
  SELECT a.r AS p, b.r AS q FROM shingles a JOIN shingles b ON a.x = b.x AND a.r < b.r
  GROUP BY a.r, b.r, a.n, b.n HAVING 100 * count(*) >= 80 * (a.n + b.n - count(*))
), links AS (SELECT p, q FROM shared UNION ALL SELECT q, p FROM shared),
reach AS (SELECT p, q FROM links UNION SELECT reach.p, links.q FROM reach JOIN links ON reach.q = links.p),
least AS (SELECT reach.p AS r, min(sets.doc_id) AS other FROM reach JOIN sets ON sets.r = reach.q GROUP BY reach.p)
SELECT doc_id, len(s) AS n_shingles, least(doc_id, coalesce(other, doc_id)) AS component_id,
       doc_id <= coalesce(other, doc_id) AS kept
FROM sets LEFT JOIN least USING (r)""",
}

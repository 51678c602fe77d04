"""Registered queries: spelling variants and the Merkle manifest."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, functions as F

from crmflow.llm.merkle import leaf_digest, manifest
from crmflow.llm.registry import query, table
from crmflow.llm.spelling import LOWER, UPPER, spelling_forms, vocabulary, word_runs
from crmflow.storage import materialize

#: CRC-32 of a list of byte values, bit by bit.
_CRC32 = """xor(list_reduce({bytes}, lambda a, b: list_reduce(
            [xor(a, b), 0, 0, 0, 0, 0, 0, 0, 0],
            lambda c, z: CASE WHEN c % 2 = 1 THEN xor(c >> 1, 3988292384) ELSE c >> 1 END), 4294967295), 4294967295)"""


def _crc32(text: str) -> str:
    hexed = f"hex(encode({text}))"
    values = f"list_transform(range(0, strlen({text})), lambda i: ('0x' || substr({hexed}, 2 * i + 1, 2))::BIGINT)"
    return _CRC32.format(bytes=values)


_OP12_SQL = rf"""
WITH RECURSIVE runs AS (
  SELECT coalesce(doc_id::VARCHAR, '') || ':' AS head,
         translate(unnest(regexp_extract_all(text, '[A-Za-zÀ-ÿ]+')), '{UPPER}', '{LOWER}') AS run FROM documents),
counted AS (SELECT head, run, count(*) AS k FROM runs WHERE length(run) >= 7 GROUP BY 1, 2),
hashed AS (SELECT run, k, {_crc32("head || run")} AS h FROM counted),
words AS (SELECT CASE WHEN h % 31 = 0 THEN run[:h % length(run)] || run[h % length(run) + 2:] ELSE run END AS word, k
          FROM hashed),
v AS MATERIALIZED (SELECT word, sum(k)::BIGINT AS n FROM words WHERE length(word) >= 7 GROUP BY 1 HAVING sum(k) >= 2),
places AS (SELECT word, unnest(range(1, length(word) + 1)) AS i FROM v),
cuts AS MATERIALIZED (SELECT word, i, word[:i - 1] || word[i + 1:] AS rest FROM places),
pairs AS (
  SELECT a.word AS a, b.word AS b FROM cuts a JOIN cuts b ON a.rest = b.rest AND a.i = b.i AND a.word <> b.word
  UNION SELECT c.word, v.word FROM cuts c JOIN v ON c.rest = v.word
  UNION SELECT v.word, c.word FROM cuts c JOIN v ON c.rest = v.word),
near AS (SELECT a AS word, count(*) AS n_near FROM pairs GROUP BY 1),
forms AS MATERIALIZED (
  SELECT a AS word, b AS form, vb.n AS form_n
  FROM pairs JOIN v va ON va.word = a JOIN v vb ON vb.word = b WHERE vb.n >= 10 * va.n
  QUALIFY row_number() OVER (PARTITION BY a ORDER BY vb.n DESC, b) = 1),
chain AS (
  SELECT word, form AS root FROM forms
  UNION ALL SELECT c.word, f.form FROM chain c JOIN forms f ON f.word = c.root),
roots AS (SELECT word, root FROM chain WHERE root NOT IN (SELECT word FROM forms))
SELECT v.word, form, coalesce(root, v.word) AS root, v.n, coalesce(n_near, 0) AS n_near, form_n
FROM v LEFT JOIN near USING (word) LEFT JOIN forms USING (word) LEFT JOIN roots USING (word)
"""


@query("op12_spelling_variants", _OP12_SQL)
def op12_spelling_variants(spark: SparkSession, sf_dir: str) -> DataFrame:
    words = materialize(vocabulary(word_runs(table(spark, sf_dir, "documents"))), "vocabulary")
    return spelling_forms(words)


def _field(column: str) -> str:
    return f"coalesce(strlen({column}::VARCHAR) || ':' || {column}::VARCHAR, '-')"


_HEAD = " || ".join(_field(c) for c in ("doc_id", "source", "lang", "n_chars"))
_OP13_SQL = f"""
WITH RECURSIVE docs AS MATERIALIZED (
  SELECT row_number() OVER () AS r, lang, doc_id, sha256({_HEAD} || {_field("text")}) AS leaf,
         CASE WHEN {_crc32("doc_id::VARCHAR")} % 3 = 0
              THEN sha256({_HEAD} || {_field(f"translate(text, '{UPPER}', '{LOWER}')")})
              ELSE sha256({_HEAD} || {_field("text")}) END AS shown FROM documents),
leaves AS MATERIALIZED (
  SELECT *, row_number() OVER (PARTITION BY lang ORDER BY doc_id NULLS FIRST, leaf) - 1 AS pos,
         count(*) OVER (PARTITION BY lang) AS nodes FROM docs),
tree AS (
  SELECT lang, 0 AS lv, pos, nodes, leaf AS dig FROM leaves
  UNION ALL
  SELECT lang, lv + 1, pos // 8, (nodes + 7) // 8, sha256(string_agg(dig, '' ORDER BY pos))
  FROM tree WHERE nodes > 1 GROUP BY lang, lv, pos // 8, nodes),
subroots AS MATERIALIZED (
  SELECT lang, dig AS subroot, lv AS top, row_number() OVER (ORDER BY lang NULLS FIRST) - 1 AS p, count(*) OVER () AS langs
  FROM tree WHERE nodes = 1),
crown AS (
  SELECT 0 AS lv, p AS pos, langs AS nodes, subroot AS dig FROM subroots
  UNION ALL
  SELECT lv + 1, pos // 8, (nodes + 7) // 8, sha256(string_agg(dig, '' ORDER BY pos))
  FROM crown WHERE nodes > 1 GROUP BY lv, pos // 8, nodes),
runs AS MATERIALIZED (
  SELECT lang, lv, pos // 8 AS run, list(dig ORDER BY pos) AS digs FROM tree WHERE nodes > 1 GROUP BY 1, 2, 3),
upper_runs AS MATERIALIZED (
  SELECT lv, pos // 8 AS run, list(dig ORDER BY pos) AS digs FROM crown WHERE nodes > 1 GROUP BY 1, 2),
walk AS (
  SELECT r, lang, 0 AS lv, pos, shown AS folded, '' AS proof FROM leaves
  UNION ALL
  SELECT w.r, w.lang, w.lv + 1, w.pos // 8,
         sha256(array_to_string(digs[:w.pos % 8] || [w.folded] || digs[w.pos % 8 + 2:], '')),
         w.proof || array_to_string(digs[:w.pos % 8] || digs[w.pos % 8 + 2:], '')
  FROM walk w JOIN runs r ON w.lang IS NOT DISTINCT FROM r.lang AND w.lv = r.lv AND w.pos // 8 = r.run),
climb AS (
  SELECT r, 0 AS lv, p AS pos, folded, proof FROM walk w JOIN subroots s ON w.lang IS NOT DISTINCT FROM s.lang AND w.lv = s.top
  UNION ALL
  SELECT w.r, w.lv + 1, w.pos // 8,
         sha256(array_to_string(digs[:w.pos % 8] || [w.folded] || digs[w.pos % 8 + 2:], '')),
         w.proof || array_to_string(digs[:w.pos % 8] || digs[w.pos % 8 + 2:], '')
  FROM climb w JOIN upper_runs r ON w.lv = r.lv AND w.pos // 8 = r.run),
ends AS (SELECT * FROM climb QUALIFY row_number() OVER (PARTITION BY r ORDER BY lv DESC) = 1),
root AS (SELECT dig AS root FROM crown WHERE nodes = 1)
SELECT l.doc_id, l.leaf, s.subroot, root, sha256(e.proof) AS proof_sha256, e.folded AS folded_root, e.folded = root AS verified
FROM leaves l JOIN ends e USING (r) JOIN subroots s ON l.lang IS NOT DISTINCT FROM s.lang, root
"""


@query("op13_merkle_manifest", _OP13_SQL)
def op13_merkle_manifest(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every third document by checksum of its id is shown in lower case, which its proof should notice."""
    docs = table(spark, sf_dir, "documents")
    head = [docs[c] for c in ("doc_id", "source", "lang", "n_chars")]
    leaf = leaf_digest([*head, docs["text"]])
    altered = leaf_digest([*head, F.translate(docs["text"], UPPER, LOWER)])
    tampered = F.pmod(F.crc32(docs["doc_id"].cast("string")), F.lit(3)) == 0
    return manifest(docs, leaf, F.when(tampered, altered).otherwise(leaf))

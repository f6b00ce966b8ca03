"""SQL that gives the rows of a query, where SQL can."""

from __future__ import annotations

from string import ascii_lowercase, ascii_uppercase

# The CRC-32 of bytes, a step for each by a table of 256 remainders.
_CRC_TABLE = """
crc_table AS (
  SELECT list(r ORDER BY b) AS t FROM (
    SELECT b, list_reduce(list_prepend(b, [0, 0, 0, 0, 0, 0, 0, 0]),
                          lambda x, _: xor(x >> 1, CASE WHEN x & 1 = 1 THEN 3988292384 ELSE 0 END)) AS r
    FROM (SELECT b::BIGINT AS b FROM range(256) AS x(b))))"""


def _crc32(text: str) -> str:
    """SQL of the CRC-32 of a text's UTF-8 bytes; ``t`` is the table."""
    byte = f"('0x' || substr(hex({text}), 2 * i::INT + 1, 2))::BIGINT"
    step = "xor(c >> 8, t[xor(c & 255, b) + 1])"
    return (
        f"xor(list_reduce(list_prepend(4294967295, list_transform(range(0, strlen({text})), lambda i: {byte})),"
        f" lambda c, b: {step}), 4294967295)"
    )


def _lowered(text: str) -> str:
    return f"translate({text}, '{ascii_uppercase}', '{ascii_lowercase}')"


def _field(column: str) -> str:
    return f"coalesce(strlen({column}::VARCHAR) || ':' || {column}::VARCHAR, '-')"


_HEADS = " || ".join(map(_field, ["doc_id", "source", "lang", "n_chars"]))

MERKLE = f"""
WITH RECURSIVE {_CRC_TABLE},
leaves AS (
  SELECT doc_id, lang, sha256({_HEADS} || {_field("text")}) AS leaf,
         CASE WHEN {_crc32("doc_id::VARCHAR")} % 3 = 0 THEN sha256({_HEADS} || {_field(_lowered("text"))}) END AS claim
  FROM documents, crc_table),
numbered AS (
  SELECT *, row_number() OVER (PARTITION BY lang ORDER BY doc_id NULLS FIRST, leaf) - 1 AS place,
         dense_rank() OVER (ORDER BY lang NULLS FIRST) - 1 AS tree
  FROM leaves),
forest AS (
  SELECT tree, 0 AS level, place, leaf AS node, count(*) OVER (PARTITION BY tree) AS n FROM numbered
  UNION ALL
  SELECT tree, level + 1, place // 8, sha256(string_agg(node, '' ORDER BY place)), (any_value(n) + 7) // 8
  FROM forest WHERE n > 1 GROUP BY tree, level, place // 8),
crown AS (
  SELECT 0 AS level, tree AS place, node, (SELECT count(DISTINCT tree) FROM numbered) AS n FROM forest WHERE n = 1
  UNION ALL
  SELECT level + 1, place // 8, sha256(string_agg(node, '' ORDER BY place)), (any_value(n) + 7) // 8
  FROM crown WHERE n > 1 GROUP BY level, place // 8),
forest_runs AS (
  SELECT tree, level, place // 8 AS run, string_agg(node, '' ORDER BY place) AS nodes FROM forest WHERE n > 1 GROUP BY ALL),
crown_runs AS (
  SELECT level, place // 8 AS run, string_agg(node, '' ORDER BY place) AS nodes FROM crown WHERE n > 1 GROUP BY ALL),
heights AS (SELECT tree, max(level) AS height FROM forest GROUP BY tree),
steps AS (
  SELECT numbered.tree, place, level AS step, nodes, place // (8 ** level)::BIGINT % 8 AS spot
  FROM numbered JOIN forest_runs ON forest_runs.tree = numbered.tree AND run = place // (8 ** (level + 1))::BIGINT
  UNION ALL
  SELECT numbered.tree, place, height + level, nodes, numbered.tree // (8 ** level)::BIGINT % 8
  FROM numbered JOIN heights ON heights.tree = numbered.tree JOIN crown_runs ON run = numbered.tree // (8 ** (level + 1))::BIGINT),
paths AS (
  SELECT tree, place, step, substr(nodes, 1, (64 * spot)::INT) AS before, substr(nodes, (64 * spot + 65)::INT) AS after FROM steps),
folds AS (
  SELECT tree, place, 0 AS step, coalesce(claim, leaf) AS node FROM numbered
  UNION ALL
  SELECT f.tree, f.place, f.step + 1, sha256(before || node || after)
  FROM folds f JOIN paths p ON p.tree = f.tree AND p.place = f.place AND p.step = f.step),
proofs AS (SELECT tree, place, sha256(string_agg(before || after, '' ORDER BY step)) AS proof FROM paths GROUP BY ALL),
ends AS (SELECT tree, place, arg_max(node, step) AS folded_root FROM folds GROUP BY ALL),
roots AS (SELECT tree, node AS subroot FROM forest WHERE n = 1)
SELECT doc_id, leaf, subroot, top.node AS root, coalesce(proof, sha256('')) AS proof_sha256, folded_root,
       folded_root = top.node AS verified
FROM numbered JOIN roots USING (tree) JOIN ends USING (tree, place) LEFT JOIN proofs USING (tree, place),
     (SELECT node FROM crown WHERE n = 1) AS top"""

_LETTERS = "[A-Za-zÀ-ÿ]+"

VARIANTS = f"""
WITH RECURSIVE {_CRC_TABLE},
runs AS (
  SELECT doc_id, {_lowered("run")} AS run, count(*) AS k
  FROM (SELECT doc_id, unnest(regexp_extract_all(text, '{_LETTERS}')) AS run FROM documents) GROUP BY ALL),
hashed AS (
  SELECT run, k, {_crc32("coalesce(doc_id::VARCHAR, '') || ':' || run")} AS h FROM runs, crc_table WHERE length(run) >= 6),
words AS (
  SELECT word, sum(k)::BIGINT AS n FROM (
    SELECT CASE WHEN h % 199 = 0 THEN left(run, (h % length(run))::INT) || substr(run, (h % length(run))::INT + 2) ELSE run END AS word, k
    FROM hashed)
  WHERE length(word) >= 6 GROUP BY word HAVING sum(k) >= 5),
shorter AS (
  SELECT word, spot, left(word, spot - 1) || substr(word, spot + 1) AS rest
  FROM (SELECT word, unnest(range(1, length(word) + 1))::INT AS spot FROM words)),
near AS (
  SELECT a.word, b.word AS other FROM shorter a JOIN shorter b ON a.spot = b.spot AND a.rest = b.rest AND a.word <> b.word
  UNION SELECT s.word, w.word FROM shorter s JOIN words w ON s.rest = w.word
  UNION SELECT w.word, s.word FROM shorter s JOIN words w ON s.rest = w.word),
best AS (
  SELECT near.word, count(*) AS n_near, max(w.n) AS top FROM near JOIN words w ON w.word = other GROUP BY near.word),
forms AS (
  SELECT b.word, min(near.other) AS form, any_value(b.top) AS form_n
  FROM best b JOIN words o ON o.word = b.word JOIN near ON near.word = b.word JOIN words w ON w.word = near.other AND w.n = b.top
  WHERE b.top >= 5 * o.n GROUP BY b.word),
paths AS (
  SELECT word, word AS root, 0 AS step FROM words
  UNION ALL SELECT p.word, f.form, step + 1 FROM paths p JOIN forms f ON f.word = p.root),
roots AS (SELECT word, arg_max(root, step) AS root FROM paths GROUP BY word)
SELECT words.word, n, coalesce(n_near, 0) AS n_near, form, form_n, root
FROM words JOIN roots ON roots.word = words.word LEFT JOIN best ON best.word = words.word LEFT JOIN forms ON forms.word = words.word"""

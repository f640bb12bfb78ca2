"""DuckDB statements for the queries of this subpackage that SQL can express."""

from __future__ import annotations

from quarry.llm.common import SHUFFLE_KEY_SQL

MIXING = f"""WITH sized AS (
  SELECT doc_id, source IS NULL AS src_null, coalesce(source, '') AS src,
         len(regexp_extract_all(coalesce(text, ''), '[^\\x20\\x09-\\x0D]+'))::BIGINT AS size,
         {SHUFFLE_KEY_SQL.format(seed=11)} AS rnd
  FROM documents),
per AS (SELECT src_null, src, sum(size)::BIGINT AS source_size FROM sized GROUP BY ALL),
ranked AS (SELECT *, row_number() OVER (ORDER BY src_null, src) AS rank FROM per),
weighed AS (SELECT *, CASE (rank - 1) % 3 WHEN 0 THEN 3 WHEN 1 THEN 1 ELSE 2 END AS w,
                   source_size * 2 AS cap, sum(source_size) OVER () * 1.5::DOUBLE AS budget FROM ranked),
filled AS (
  SELECT *, sum(cap) OVER (ORDER BY cap / w, src_null, src ROWS UNBOUNDED PRECEDING)
            + (cap / w) * coalesce(sum(w) OVER (ORDER BY cap / w, src_null, src
                                                ROWS BETWEEN 1 FOLLOWING AND UNBOUNDED FOLLOWING), 0) <= budget AS is_full
  FROM weighed),
levels AS (
  SELECT (any_value(budget) - coalesce(sum(cap) FILTER (is_full), 0)) / sum(w) FILTER (NOT is_full) AS lvl FROM filled),
targets AS (
  SELECT src_null, src, rank, source_size, budget,
         CASE WHEN is_full THEN cap::DOUBLE ELSE lvl * w END AS target FROM filled, levels),
times AS (
  SELECT doc_id, rnd, size, rank, source_size, budget, target,
         sum(size) OVER (PARTITION BY rank ORDER BY rnd, doc_id RANGE UNBOUNDED PRECEDING) AS upto
  FROM sized JOIN targets USING (src_null, src)),
copies AS (
  SELECT *, CASE WHEN target > 0 THEN (source_size * pass + upto)::DOUBLE / target ELSE 0 END AS finish
  FROM times, (VALUES (0), (1)) AS p(pass)),
served AS (
  SELECT *, sum(size) OVER (ORDER BY finish, rank RANGE UNBOUNDED PRECEDING) <= budget * (1 + 1e-12) + 1e-6 AS fits
  FROM (SELECT *, row_number() OVER () AS copy FROM copies)),
per_copy AS (SELECT doc_id, rnd, size, source_size, target, upto, rank, pass, fits FROM served),
numbered AS (SELECT *, row_number() OVER (PARTITION BY doc_id, rank, size, upto, pass) AS same FROM per_copy)
SELECT doc_id, size, source_size, target, sum(CASE WHEN fits THEN size ELSE 0 END)::BIGINT AS taken
FROM numbered GROUP BY doc_id, rank, size, upto, same, source_size, target"""

CHAT = r"""WITH all_turns AS (
  SELECT conv_id, turn, coalesce(role, '') AS role, coalesce(text, '') AS text FROM conversations
  UNION ALL SELECT -7, 0, 'user', '</s>[INST] ok [/INST]'
  UNION ALL SELECT -7, 1, 'assistant', '</s>[INST] ok [/INST]'),
numbered AS (
  SELECT *, row_number() OVER (PARTITION BY conv_id ORDER BY turn NULLS FIRST, role, text) AS k,
         count(*) OVER (PARTITION BY conv_id) AS n,
         length('<|turn|><|text|><|end|>') + length(regexp_replace(role, '([\\<\[])', '\1\\', 'g'))
           + length(regexp_replace(text, '([\\<\[])', '\1\\', 'g')) AS chars
  FROM all_turns),
written AS (
  SELECT *, sum(chars) OVER (PARTITION BY conv_id ORDER BY k ROWS UNBOUNDED PRECEDING) AS upto FROM numbered)
SELECT conv_id, count(*)::BIGINT AS n_turns,
       sha256(string_agg(role || chr(10) || text || chr(10), '' ORDER BY k)) AS turns_sha256,
       coalesce(sum(length(text)) FILTER (role = 'assistant'), 0)::BIGINT AS loss_chars,
       sha256(coalesce(string_agg(text, '' ORDER BY k) FILTER (role = 'assistant'), '')) AS loss_sha256,
       sum(CASE WHEN role = 'assistant' OR k = n THEN upto ELSE 0 END)::BIGINT AS formatted_chars
FROM written GROUP BY conv_id"""

AUDIT = r"""WITH RECURSIVE words AS (
  SELECT doc_id, coalesce(lang, '') AS part, coalesce(text, '') AS text,
         regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+') AS w FROM documents),
failed AS (
  SELECT doc_id, part,
         (len(w) < 100)::INT
         + 2 * (100 * len(list_distinct(w)) < 80 * len(w))::INT
         + 4 * (100 * length(regexp_replace(text, '[^A-Z]', '', 'g')) > 10 * length(text))::INT
         + 8 * regexp_matches(text, '[#$%&*|]')::INT
         + 16 * coalesce(doc_id > min(doc_id) OVER (PARTITION BY text), false)::INT AS mask FROM words),
marks AS (SELECT doc_id, max((quality = 1)::INT) AS good, max((toxic = 1)::INT) AS toxic FROM labels GROUP BY doc_id),
counts AS (
  SELECT part, mask, count(*) AS n, sum(coalesce(good, 0)) AS good, sum(coalesce(toxic, 0)) AS toxic
  FROM failed LEFT JOIN marks USING (doc_id) GROUP BY ALL),
letters(k) AS (VALUES (0), (1), (2), (3), (4)),
orders(filter_order, used, last, step) AS (
  SELECT '', 0, 0, 0
  UNION ALL SELECT filter_order || chr(65 + k), used + (1 << k), 1 << k, step + 1 FROM orders, letters WHERE used & (1 << k) = 0),
steps AS (
  SELECT o.filter_order, p.step, p.last AS own, p.used - p.last AS before
  FROM orders o JOIN orders p ON o.step = 5 AND p.step >= 1 AND starts_with(o.filter_order, p.filter_order)),
result AS (
  SELECT part, filter_order, step, own,
         coalesce(sum(n) FILTER (mask & (before + own) = 0), 0) AS kept,
         coalesce(sum(n) FILTER (mask & own <> 0 AND mask & before = 0), 0) AS removed,
         coalesce(sum(n) FILTER (mask & own <> 0 AND mask & before <> 0), 0) AS redundant,
         coalesce(sum(n) FILTER (mask = own), 0) AS unique_fails,
         coalesce(sum(good) FILTER (mask & own <> 0 AND mask & before = 0), 0) AS good_lost,
         coalesce(sum(toxic) FILTER (mask & own <> 0 AND mask & before = 0), 0) AS toxic_lost
  FROM counts, steps GROUP BY ALL)
SELECT part, filter_order, step::INT AS step, kept::BIGINT AS kept, removed::BIGINT AS removed, redundant::BIGINT AS redundant,
       unique_fails::BIGINT AS unique_fails, good_lost::BIGINT AS good_lost, toxic_lost::BIGINT AS toxic_lost,
       (sum(removed) OVER (PARTITION BY part, own))::BIGINT AS shapley FROM result"""

_FIELD = "coalesce(strlen({0}::VARCHAR) || ':' || {0}::VARCHAR, '-')"
_LEAF = "sha256(" + " || ".join(_FIELD.format(c) for c in ("doc_id", "source", "lang", "n_chars")) + " || {text})"
_CRC32 = """xor(list_reduce(list_transform(string_split(doc_id::VARCHAR, ''), lambda c: ascii(c)::BIGINT),
  lambda crc, b: list_reduce(range(8), lambda x, i: xor(x >> 1, 3988292384 * (x & 1)), xor(crc, b)), 4294967295::BIGINT), 4294967295::BIGINT)"""

MERKLE = f"""WITH RECURSIVE changed AS (
  SELECT doc_id, source, {_LEAF.format(text=_FIELD.format("text"))} AS leaf,
         {_LEAF.format(text=_FIELD.format("shown"))} AS now
  FROM (SELECT *, CASE WHEN {_CRC32} % 5 = 0 THEN translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz')
                       ELSE text END AS shown FROM documents)),
leaves AS (
  SELECT *, row_number() OVER () AS id, dense_rank() OVER (ORDER BY source NULLS FIRST) - 1 AS tree,
         row_number() OVER (PARTITION BY source ORDER BY doc_id NULLS FIRST, leaf) - 1 AS idx,
         count(*) OVER (PARTITION BY source) AS n FROM changed),
inner_nodes(tree, level, idx, n, digest) AS (
  SELECT tree, 0, idx, n, leaf FROM leaves
  UNION ALL SELECT tree, level + 1, idx // 16, (n + 15) // 16, sha256(string_agg(digest, '' ORDER BY idx))
  FROM inner_nodes WHERE n > 1 GROUP BY tree, level, idx // 16, n),
subroots AS (SELECT tree, digest FROM inner_nodes WHERE n = 1),
top_nodes(level, idx, n, digest) AS (
  SELECT 0, tree, count(*) OVER (), digest FROM subroots
  UNION ALL SELECT level + 1, idx // 16, (n + 15) // 16, sha256(string_agg(digest, '' ORDER BY idx))
  FROM top_nodes WHERE n > 1 GROUP BY level, idx // 16, n),
nodes AS (SELECT tree, level, idx, n, digest FROM inner_nodes UNION ALL SELECT -1, level, idx, n, digest FROM top_nodes),
steps AS (
  SELECT tree, level, idx,
         coalesce(string_agg(digest, '') OVER (PARTITION BY tree, level, idx // 16 ORDER BY idx ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), '') AS before,
         coalesce(string_agg(digest, '') OVER (PARTITION BY tree, level, idx // 16 ORDER BY idx ROWS BETWEEN 1 FOLLOWING AND UNBOUNDED FOLLOWING), '') AS after
  FROM nodes WHERE n > 1),
climb(id, tree, level, idx, n, folded, proof) AS (
  SELECT id, tree, 0, idx, n, now, '' FROM leaves
  UNION ALL SELECT id, tree, c.level + 1, idx // 16, (n + 15) // 16, sha256(before || folded || after), proof || before || after
  FROM climb c JOIN steps s USING (tree, level, idx) WHERE n > 1),
climb_top(id, tree, level, idx, n, folded, proof) AS (
  SELECT id, -1, 0, tree, (SELECT count(*) FROM subroots), folded, proof FROM climb WHERE n = 1
  UNION ALL SELECT id, tree, c.level + 1, idx // 16, (n + 15) // 16, sha256(before || folded || after), proof || before || after
  FROM climb_top c JOIN steps s USING (tree, level, idx) WHERE n > 1)
SELECT l.doc_id, l.leaf, s.digest AS subroot, r.digest AS root, sha256(c.proof) AS proof_sha256, c.folded AS folded_root,
       c.folded = r.digest AS verified
FROM leaves l JOIN climb_top c ON c.id = l.id AND c.n = 1 JOIN subroots s ON s.tree = l.tree
     JOIN top_nodes r ON r.n = 1"""

ORACLES = {"op2_mix_sources": MIXING, "op8_chat_prefix_targets": CHAT, "op12_filter_audit": AUDIT, "op13_merkle_manifest": MERKLE}

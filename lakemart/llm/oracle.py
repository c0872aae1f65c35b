"""DuckDB SQL of the operators that SQL can state: resampling, sharding, conversations.

Each takes another route than the operator: regular expressions for the words, window sums
over the sorted rows for the borders, a recursive walk over (cost, audit) for the repair.
"""

from __future__ import annotations

#: 256 entries of the CRC-32 table, each from eight steps over its number.
_CRC_TABLE = (
    "list_transform(range(256), lambda n: list_reduce("
    "list_concat([n::BIGINT], [0::BIGINT, 0, 0, 0, 0, 0, 0, 0]), "
    "lambda c, i: CASE WHEN c & 1 = 1 THEN xor(c >> 1, 3988292384) ELSE c >> 1 END))"
)


def crc32(text: str, table: str) -> str:
    """CRC-32 of an expression's UTF-8 bytes; ``table``: the column with the table."""
    octets = f"list_transform(regexp_extract_all(hex(encode({text})), '..'), lambda h: ('0x' || h)::BIGINT)"
    folded = (
        f"list_reduce(list_concat([4294967295::BIGINT], {octets}), "
        f"lambda c, b: xor(c >> 8, {table}[(xor(c, b) & 255) + 1]))"
    )
    return f"xor({folded}, 4294967295)"


def lowered(text: str) -> str:
    """An expression's text, A-Z in lower case; null: empty."""
    upper = "ABCDEFGHIJKLMNOPQRSTUVWXYZ"
    return f"translate(coalesce({text}, ''), '{upper}', '{upper.lower()}')"


RESAMPLE = rf"""
WITH tables AS (SELECT {_CRC_TABLE} AS tab),
docs AS (SELECT row_number() OVER () AS r, doc_id, {lowered("text")} AS text FROM documents),
doc_words AS (
  SELECT r, unnest(regexp_extract_all(text, '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+')) AS w FROM docs
),
target_words AS (
  SELECT unnest(regexp_extract_all({lowered("text")}, '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+')) AS w FROM benchmark
),
buckets AS (
  SELECT w, {crc32("w", "tab")} % 10000 AS b
  FROM (SELECT w FROM doc_words UNION SELECT w FROM target_words), tables
),
raw AS (SELECT b, count(*) AS n FROM doc_words JOIN buckets USING (w) GROUP BY b),
aim AS (SELECT b, count(*) AS n FROM target_words JOIN buckets USING (w) GROUP BY b),
sums AS (SELECT (SELECT coalesce(sum(n), 0) FROM raw) AS s, (SELECT coalesce(sum(n), 0) FROM aim) AS t),
gain AS (
  SELECT g.b, floor(1000 * ln(((coalesce(aim.n, 0) + 1)::DOUBLE * (s + 10000)::DOUBLE)
    / ((coalesce(raw.n, 0) + 1)::DOUBLE * (t + 10000)::DOUBLE)))::BIGINT AS gain
  FROM (SELECT unnest(range(10000)) AS b) g LEFT JOIN raw USING (b) LEFT JOIN aim USING (b), sums
),
weights AS (
  SELECT r, count(*) AS n, floor(sum(gain)::DOUBLE / count(*))::BIGINT AS weight
  FROM doc_words JOIN buckets USING (w) JOIN gain USING (b) GROUP BY r
),
scored AS (
  SELECT doc_id, coalesce(n, 0) AS n_features, coalesce(weight, 0) AS weight,
    coalesce(weight, 0) + floor(-1000 * ln(-ln((('0x' || sha256('2024:' || coalesce(doc_id::VARCHAR, ''))[1:8])::BIGINT
      + 0.5::DOUBLE) / 4294967296::DOUBLE)))::BIGINT AS score
  FROM docs LEFT JOIN weights USING (r)
),
ranked AS (
  SELECT *, row_number() OVER (PARTITION BY n_features >= 20 ORDER BY score DESC, doc_id NULLS LAST) AS place,
    count(*) OVER (PARTITION BY n_features >= 20) AS eligible FROM scored
)
SELECT doc_id, n_features, weight, score,
  CASE WHEN n_features >= 20 AND place <= eligible * 10 // 100 THEN place END AS rank
FROM ranked
"""

SHARDS = f"""
WITH tables AS (SELECT {_CRC_TABLE} AS tab),
sums AS (SELECT text, {crc32("text", "tab")} AS crc FROM (SELECT DISTINCT text FROM documents WHERE text <> ''), tables),
docs AS (
  SELECT doc_id, strlen(coalesce(d.text, '')) + 16 AS size, coalesce(crc, 0) AS crc,
    ('0x' || md5(coalesce(d.text, ''))[1:15])::BIGINT AS h
  FROM documents d LEFT JOIN sums ON d.text = sums.text
),
placed AS (
  SELECT *, row_number() OVER w AS place, sum(size) OVER w - size AS before, sum(size) OVER () AS total FROM docs
  WINDOW w AS (ORDER BY h, doc_id NULLS FIRST ROWS UNBOUNDED PRECEDING)
),
groups AS (SELECT h, min(before) AS low, max(before + size) AS high, any_value(total) AS total FROM placed GROUP BY h),
aims AS (SELECT low, high, total, k, k * total::DOUBLE / 40 AS aim
  FROM groups, (SELECT unnest(range(1, 40)) AS k) WHERE low * 40 < k * total AND k * total <= high * 40),
borders AS (
  SELECT k, CASE
    WHEN least(aim - low, high - aim) > 0.01 * total / 40
      THEN coalesce((SELECT min(before) FROM placed p WHERE p.before * 40 >= k * p.total), total)
    WHEN aim - low <= high - aim THEN low ELSE high END AS border
  FROM aims
),
sharded AS (SELECT *, (SELECT count(*) FROM borders b WHERE b.border <= placed.before)::INTEGER AS shard FROM placed)
SELECT doc_id, size, crc AS text_crc32, 'bytes' AS law, shard,
  row_number() OVER (PARTITION BY shard ORDER BY place) - 1 AS slot, NULL::INTEGER AS grown_shard
FROM sharded
"""

#: [^\x20\x09-\x0D] as the contract's characters that are not blank.
_INK = r"[^\x20\x09-\x0D]"

CONVERSATIONS = rf"""
WITH RECURSIVE tables AS (SELECT {_CRC_TABLE} AS tab),
keyed AS (
  SELECT conv_id, turn, coalesce(role, ' ') AS role, coalesce(text, ' ') AS text,
    coalesce(conv_id::VARCHAR, ' ') || ':' || coalesce(turn::VARCHAR, ' ') AS k
  FROM conversations
),
codes AS (SELECT k, {crc32("k", "tab")} % 20 AS code FROM (SELECT DISTINCT k FROM keyed), tables),
damaged AS (
  SELECT conv_id, turn, CASE code WHEN 4 THEN 'user' ELSE role END AS role,
    CASE code WHEN 1 THEN '' WHEN 2 THEN regexp_replace(text, '[.!?]', '', 'g') ELSE text END AS text,
    unnest(CASE code WHEN 0 THEN [] WHEN 3 THEN [0, 1] ELSE [0] END) AS copy
  FROM keyed JOIN codes USING (k)
),
ids AS (SELECT conv_id, row_number() OVER () AS c FROM (SELECT DISTINCT conv_id FROM conversations)),
ordered AS (
  SELECT c, turn, role, text, left(role, 1) AS initial,
    row_number() OVER (PARTITION BY c ORDER BY turn NULLS FIRST, role, text, copy) AS i
  FROM damaged JOIN ids ON damaged.conv_id IS NOT DISTINCT FROM ids.conv_id
),
faulty AS (
  SELECT *, CASE
      WHEN NOT regexp_matches(text, '{_INK}') THEN 'blank'
      WHEN row_number() OVER (PARTITION BY c, role, text ORDER BY i) > 1 THEN 'duplicate'
      WHEN regexp_extract(text, '({_INK})[\x20\x09-\x0D]*$', 1) NOT IN ('.', '!', '?') THEN 'truncated'
      ELSE 'fine' END AS fault,
    lag(initial) OVER (PARTITION BY c ORDER BY i) || initial AS pair
  FROM ordered
),
reach AS (
  SELECT * FROM (VALUES ('-', 's', 's'), ('-', 'u', 'u'), ('s', 'u', 'u'), ('T', 'u', 'u'), ('u', 'a', 'T')) v(a, symbol, b)
),
-- up to two turns inserted, from each top
inserted AS (
  SELECT * FROM (VALUES ('-', '-', ''), ('-', 'u', 'I'), ('-', 'T', 'II'), ('s', 's', ''), ('s', 'u', 'I'),
    ('s', 'T', 'II'), ('u', 'u', ''), ('u', 'T', 'I'), ('u', 'u', 'II'), ('T', 'T', ''), ('T', 'u', 'I'), ('T', 'T', 'II')) v(a, b, said)
),
steps AS (
  SELECT c, i, ins.a, ins.b, 2 * length(said) + 3 AS cost, said || 'D' AS said FROM faulty, inserted ins
  UNION ALL
  SELECT c, i, ins.a, r.b, 2 * length(said) + CASE WHEN fault = 'truncated' THEN 1 ELSE 0 END, said || 'K'
  FROM faulty JOIN inserted ins ON fault IN ('fine', 'truncated') JOIN reach r ON r.a = ins.b AND r.symbol = initial
  UNION ALL
  SELECT c, i, ins.a, r.b, 2 * length(said) + CASE WHEN fault = 'truncated' THEN 1 ELSE 0 END + 2, said || 'R'
  FROM faulty JOIN inserted ins ON fault IN ('fine', 'truncated') JOIN reach r ON r.a = ins.b AND r.symbol IN ('u', 'a')
),
walk AS (
  SELECT c, 0::BIGINT AS i, '-' AS top, {{'cost': 0::BIGINT, 'audit': ''}} AS best FROM ids
  UNION ALL
  SELECT walk.c, walk.i + 1, steps.b,
    min({{'cost': (best.cost + steps.cost)::BIGINT, 'audit': best.audit || steps.said}})
  FROM walk JOIN steps ON steps.c = walk.c AND steps.i = walk.i + 1 AND steps.a = walk.top
  GROUP BY walk.c, walk.i + 1, steps.b
),
sizes AS (SELECT ids.c, count(i) AS n FROM ids LEFT JOIN ordered USING (c) GROUP BY ids.c),
done AS (
  SELECT walk.c, min({{'cost': best.cost + CASE top WHEN 'u' THEN 2 WHEN 's' THEN 4 ELSE 0 END,
    'audit': best.audit || CASE top WHEN 'u' THEN 'I' WHEN 's' THEN 'II' ELSE '' END}}) AS best
  FROM walk JOIN sizes ON walk.c = sizes.c AND walk.i = sizes.n GROUP BY walk.c
),
letters AS (
  SELECT c, unnest(string_split(best.audit, '')) AS letter, unnest(range(length(best.audit))) AS p FROM done WHERE best.audit <> ''
),
numbered AS (
  SELECT *, count(*) FILTER (WHERE letter <> 'I') OVER w AS i, count(*) FILTER (WHERE letter <> 'D') OVER w AS place
  FROM letters WINDOW w AS (PARTITION BY c ORDER BY p)
),
kept AS (
  SELECT n.*, f.role, f.text, max(CASE WHEN letter = 'K' AND initial = 's' THEN 1 ELSE 0 END) OVER (PARTITION BY n.c) AS system
  FROM numbered n LEFT JOIN faulty f ON f.c = n.c AND f.i = n.i AND letter <> 'I' WHERE letter <> 'D'
),
lines AS (
  SELECT c, place, CASE WHEN letter = 'K' THEN role WHEN (place - system) % 2 = 1 THEN 'user' ELSE 'assistant' END
    || ':' || CASE WHEN letter = 'I' THEN '' ELSE text END AS line
  FROM kept
),
texts AS (SELECT c, string_agg(line, chr(10) ORDER BY place) AS whole FROM lines GROUP BY c),
counts AS (
  SELECT c, coalesce(max(turn) - min(turn) + 1 - count(DISTINCT turn), 0) AS gaps,
    count(*) FILTER (WHERE fault = 'blank') AS blank, count(*) FILTER (WHERE fault = 'duplicate') AS duplicate,
    count(*) FILTER (WHERE fault = 'truncated') AS truncated,
    count(*) FILTER (WHERE i > 1 AND pair NOT IN ('su', 'ua', 'au')) AS illegal
  FROM faulty GROUP BY c
)
SELECT conv_id, coalesce(gaps, 0) AS gaps, coalesce(blank, 0) AS blank, coalesce(duplicate, 0) AS duplicate,
  coalesce(truncated, 0) AS truncated, coalesce(illegal, 0) AS illegal, best.cost AS cost, best.audit AS audit,
  sha256(coalesce(whole, '')) AS repaired_sha256
FROM ids JOIN done USING (c) LEFT JOIN counts USING (c) LEFT JOIN texts USING (c)
"""

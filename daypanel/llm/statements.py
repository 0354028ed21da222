"""The numbered queries as DuckDB SQL, where SQL can say them."""

from __future__ import annotations

_WORDS = (r"regexp_split_to_array(trim(regexp_replace(translate({}, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', "
          r"'abcdefghijklmnopqrstuvwxyz'), '[\x00-\x2F\x3A-\x60\x7B-\x7F]+', ' ', 'g'), ' '), ' ')")

OP3 = rf"""
WITH d AS (SELECT doc_id, [x FOR x IN {_WORDS.format("coalesce(text, '')")} IF x <> ''] AS words FROM documents),
b AS (SELECT item_id, [x FOR x IN {_WORDS.format("coalesce(text, '')")} IF x <> ''] AS words FROM benchmark),
bw AS (SELECT DISTINCT item_id, least(13, len(words)) AS n,
              unnest([array_to_string(words[i:i + least(13, len(words)) - 1], ' ')
                      FOR i IN range(1, len(words) - least(13, len(words)) + 2)]) AS win
       FROM b WHERE len(words) > 0),
p AS (SELECT doc_id, words, unnest(range(1, len(words) + 1)) AS s FROM d),
dw AS (SELECT doc_id, s, n, array_to_string(words[s:s + n - 1], ' ') AS win
       FROM p, (SELECT DISTINCT n FROM bw) WHERE s + n - 1 <= len(words)),
h AS (SELECT dw.doc_id, dw.s, dw.n, bw.item_id FROM dw JOIN bw ON dw.win = bw.win AND dw.n = bw.n),
c AS (SELECT doc_id, count(DISTINCT w) AS n_hit
      FROM (SELECT doc_id, unnest(range(s, s + n)) AS w FROM (SELECT DISTINCT doc_id, s, n FROM h)) GROUP BY doc_id),
i AS (SELECT doc_id, count(*) AS n_items, string_agg(item, ',' ORDER BY item) AS items
      FROM (SELECT DISTINCT doc_id, item_id::VARCHAR AS item FROM h) GROUP BY doc_id)
SELECT d.doc_id, len(words)::BIGINT AS n_words, coalesce(n_hit, 0)::BIGINT AS n_hit,
       coalesce(n_items, 0)::BIGINT AS n_items, sha256(coalesce(items, '')) AS items_sha256,
       coalesce(n_hit, 0) > 0 AND 20 * coalesce(n_hit, 0) >= len(words) AS contaminated
FROM d LEFT JOIN c USING (doc_id) LEFT JOIN i USING (doc_id)"""

OP5 = """
WITH p AS (SELECT page_id, coalesce(html, '') AS payload, octet_length(encode(coalesce(html, ''))) AS n FROM pages),
h AS (SELECT *, CASE WHEN n >= 1000 THEN max(page_id) OVER (PARTITION BY payload) END AS holder,
             row_number() OVER (PARTITION BY payload ORDER BY page_id DESC NULLS LAST) > 1 AS later FROM p)
SELECT page_id, n::BIGINT AS payload_bytes, sha1(payload) AS payload_digest,
       CASE WHEN holder IS NOT NULL AND later THEN 'revisit' ELSE 'response' END AS record_type,
       CASE WHEN later THEN holder END AS refers_to FROM h"""

# Deletes [\x20\x09-\x0D].
NORMALISED = r"regexp_replace(coalesce(text, ''), '[\x20\x09-\x0D]', '', 'g')"

OP8 = rf"""
WITH d AS (SELECT doc_id, length(coalesce(text, '')) AS points, {NORMALISED} AS norm FROM documents),
w AS (SELECT *, first_value(doc_id) OVER (PARTITION BY norm ORDER BY points DESC, doc_id) AS keep_id,
             row_number() OVER (PARTITION BY norm ORDER BY points DESC, doc_id) AS place,
             count(*) OVER (PARTITION BY norm) AS group_size FROM d)
SELECT doc_id, keep_id, group_size, place = 1 AS kept, sha256(norm) AS text_sha256 FROM w"""

OP7 = """
WITH d AS (SELECT doc_id, hex(encode(coalesce(text, ''))) AS x, octet_length(encode(coalesce(text, ''))) AS n FROM documents),
q AS (SELECT doc_id, n, a, substr(x, 2 * a + 1, 2400) AS y FROM (SELECT *, unnest(range(0, n, 1000)) AS a FROM d)),
w AS (SELECT doc_id, a + j AS i, substr(y, 2 * j + 1, 2) AS byte,
             CASE WHEN a + j + 200 <= n THEN md5(substr(y, 2 * j + 1, 400)) END AS h
      FROM (SELECT *, unnest(range(0, least(1000, n - a))) AS j FROM q)),
r AS (SELECT doc_id, i, byte, CASE WHEN h IS NOT NULL AND count(*) OVER (PARTITION BY h) > 1 THEN i END AS start FROM w),
c AS (SELECT doc_id, i, byte, max(start) OVER (PARTITION BY doc_id ORDER BY i
                                               ROWS BETWEEN 199 PRECEDING AND CURRENT ROW) IS NOT NULL AS gone FROM r),
e AS (SELECT *, gone AND NOT lag(gone, 1, false) OVER (PARTITION BY doc_id ORDER BY i) AS opens FROM c),
k AS (SELECT doc_id, count(*) FILTER (gone) AS n_removed, count(*) FILTER (opens) AS n_spans,
             sha256(unhex(coalesce(string_agg(byte, '' ORDER BY i) FILTER (NOT gone), ''))) AS kept FROM e GROUP BY doc_id)
SELECT doc_id, n::BIGINT AS n_bytes, coalesce(n_removed, 0)::BIGINT AS n_removed, coalesce(n_spans, 0)::BIGINT AS n_spans,
       coalesce(kept, sha256('')) AS kept_sha256
FROM d LEFT JOIN k USING (doc_id)"""

_ESCAPED = r"regexp_replace({}, '<(\\*)\|', '<\\\1|', 'g')"
_ROLE = f"replace(replace({_ESCAPED.format('role')}, '\\', '\\\\'), chr(10), '\\n')"

OP10 = rf"""
WITH c AS (
  SELECT conv_id, turn, coalesce(role, '') AS role, coalesce(text, '') AS text FROM conversations
  UNION ALL SELECT -1, t, r, '<|im_end|><|im_start|>assistant ok' FROM (VALUES (0, 'user'), (1, 'assistant')) v(t, r))
SELECT conv_id, count(*) AS n_turns,
       sha256(string_agg(role || chr(10) || text || chr(10), '' ORDER BY turn NULLS FIRST, role, text)) AS turns_sha256,
       sum(CASE WHEN role = 'assistant' THEN length(text) ELSE 0 END)::BIGINT AS loss_chars,
       sha256(string_agg(CASE WHEN role = 'assistant' THEN text ELSE '' END, '' ORDER BY turn NULLS FIRST, role, text))
         AS loss_sha256,
       sum(length('<|im_start|>') + length({_ROLE}) + 1 + length({_ESCAPED.format('text')})
           + length('<|im_end|>') + 1)::BIGINT AS formatted_chars
FROM c GROUP BY conv_id"""

# Words of [^\x20\x09-\x0D]+.
_SPLIT = r"[x FOR x IN regexp_split_to_array(coalesce(text, ''), '[\x20\x09-\x0D]+') IF x <> '']"

# CRC-32, bit by bit: -1 shifts the register by one, any other entry is a byte
# that goes into it.
_CRC32 = """xor(4294967295, list_reduce(list_concat([4294967295::BIGINT], flatten([[ascii(c)::BIGINT, -1, -1, -1, -1, -1, -1, -1, -1]
  FOR c IN string_split(doc_id::VARCHAR, '')])),
  lambda r, x: CASE WHEN x >= 0 THEN xor(r, x) WHEN r & 1 = 1 THEN xor(r >> 1, 3988292384) ELSE r >> 1 END))"""


def _op11(levels: int) -> str:
    """Runs from the next occurrence of each stretch of 2, 4, 8, ... words, up to
    2 ** ``levels``: where it lies ``period`` words on for places in a row, these
    are one run. Stretches are numbered from the two halves they consist of."""
    steps = ["""g1 AS (SELECT doc_id, n, i, dense_rank() OVER (PARTITION BY doc_id ORDER BY word, after) AS r FROM
  (SELECT *, lead(word) OVER (PARTITION BY doc_id ORDER BY i) AS after FROM w) WHERE after IS NOT NULL),
m1 AS MATERIALIZED (SELECT * FROM (SELECT *, count(*) OVER (PARTITION BY doc_id, r) AS c FROM g1) WHERE c > 1)"""]
    for level in range(2, levels + 1):
        half = 1 << (level - 1)
        steps.append(f"""m{level} AS MATERIALIZED (SELECT doc_id, n, i, r FROM (
  SELECT *, count(*) OVER (PARTITION BY doc_id, r) AS c FROM (
    SELECT a.doc_id, a.n, a.i, dense_rank() OVER (PARTITION BY a.doc_id ORDER BY a.r, b.r) AS r
    FROM m{level - 1} a JOIN m{level - 1} b ON a.doc_id = b.doc_id AND b.i = a.i + {half} WHERE a.n >= {4 * half})) WHERE c > 1)""")
    found = " UNION ALL ".join(
        f"SELECT doc_id, {1 << level} AS b, i, lead(i) OVER (PARTITION BY doc_id, r ORDER BY i) - i AS p FROM m{level}"
        for level in range(1, levels + 1))
    return f"""
WITH o AS (SELECT doc_id, {_SPLIT} AS words, {_CRC32} AS h FROM documents),
q AS (SELECT *, len(words) AS n, h // 10 AS g FROM o),
s AS (SELECT *, g % greatest(n, 1) AS a FROM q),
t AS (SELECT doc_id, n, a, words, CASE WHEN h % 10 = 0 AND n > 0 THEN 1 + (n - a) // (3 + g % 8) END AS p FROM s),
w AS MATERIALIZED (SELECT doc_id, n, i, words[1 + CASE WHEN p IS NOT NULL AND i >= a THEN a + (i - a) % p ELSE i END] AS word
      FROM (SELECT *, unnest(range(0, n)) AS i FROM t)),
{", ".join(steps)},
f AS ({found}),
k AS (SELECT doc_id, b, p, i, i - row_number() OVER (PARTITION BY doc_id, b, p ORDER BY i) AS island
      FROM f WHERE 2 * p > b AND p <= b),
u AS (SELECT doc_id, p, min(i) AS start, max(i) - min(i) + p + b AS length FROM k GROUP BY doc_id, b, p, island),
r AS MATERIALIZED (SELECT * FROM u WHERE length >= greatest(6, 4 * p)
  UNION ALL SELECT doc_id, 1, x, y - x FROM (SELECT doc_id, min(i) AS x, max(i) + 1 AS y FROM (
    SELECT doc_id, i, sum(new) OVER (PARTITION BY doc_id ORDER BY i) AS island FROM (
      SELECT *, CASE WHEN word = lag(word) OVER (PARTITION BY doc_id ORDER BY i) THEN 0 ELSE 1 END AS new FROM w))
    GROUP BY doc_id, island) WHERE y - x >= 6),
l AS (SELECT doc_id, count(*) AS n_runs, max(struct_pack(length := length, start := -start, period := -p)) AS longest,
             string_agg(start || ',' || length || ',' || p || chr(10), '' ORDER BY start, p) AS lines FROM r GROUP BY doc_id),
e AS (SELECT doc_id, i, sum(d) AS d FROM (SELECT doc_id, start + p AS i, 1 AS d FROM r
      UNION ALL SELECT doc_id, start + length, -1 FROM r) GROUP BY doc_id, i),
c AS (SELECT doc_id, string_agg(word, ' ' ORDER BY i) AS collapsed FROM (
        SELECT w.doc_id, w.i, word, sum(coalesce(d, 0)) OVER (PARTITION BY w.doc_id ORDER BY w.i) AS gone
        FROM w LEFT JOIN e ON w.doc_id = e.doc_id AND w.i = e.i) WHERE gone = 0 GROUP BY doc_id)
SELECT doc_id, coalesce(n_runs, 0)::BIGINT AS n_runs, (-longest.start)::BIGINT AS start, longest.length::BIGINT AS length,
       (-longest.period)::BIGINT AS period, (1000 * longest.length // -longest.period)::BIGINT AS exponent_milli,
       sha256(coalesce(lines, '')) AS runs_sha256, sha256(coalesce(collapsed, '')) AS collapsed_sha256
FROM o LEFT JOIN l USING (doc_id) LEFT JOIN c USING (doc_id)"""


_TERMS = (r"[x FOR x IN regexp_split_to_array(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', "
          r"'abcdefghijklmnopqrstuvwxyz'), '[\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+') IF x <> '']")

OP12 = rf"""
WITH d AS (SELECT doc_id, {_TERMS} AS terms FROM documents), b AS (SELECT item_id, {_TERMS} AS terms FROM benchmark),
c AS (SELECT count(*)::BIGINT AS docs, sum(len(terms))::BIGINT AS total FROM d WHERE len(terms) > 0),
i AS (SELECT item_id, term, count(*) AS times FROM (SELECT item_id, unnest(terms) AS term FROM b) GROUP BY ALL),
t AS (SELECT doc_id, term, count(*) AS tf, any_value(n) AS n
      FROM (SELECT doc_id, len(terms)::BIGINT AS n, unnest(terms) AS term FROM d)
      WHERE term IN (SELECT term FROM i) GROUP BY doc_id, term),
w AS (SELECT term, floor(1000 * ln((2 * docs + 2)::DOUBLE / (2 * count(*) + 1)))::BIGINT AS w FROM t, c GROUP BY term, docs),
p AS (SELECT doc_id, term, w * ((1000000000 * tf) // (1000 * tf + 12 * (75 + (25 * n * docs) // total))) AS value
      FROM t JOIN w USING (term), c),
s AS (SELECT item_id, doc_id, sum(times * value)::BIGINT AS score FROM p JOIN i USING (term) GROUP BY item_id, doc_id)
SELECT item_id, rank::INTEGER AS rank, doc_id, score FROM (
  SELECT *, row_number() OVER (PARTITION BY item_id ORDER BY score DESC, doc_id) AS rank FROM s WHERE score > 0) WHERE rank <= 20"""

SQL = {"op3_decontaminate": OP3, "op5_warc": OP5, "op7_suffix_dedup": OP7, "op8_exact_dedup": OP8, "op10_chat_format": OP10,
       "op11_runs": _op11(16), "op12_search": OP12}

"""The registered queries of this subpackage as SQL, where SQL can express them."""

from __future__ import annotations

ORACLES: dict[str, str] = {}

_LOWER = "translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz')"
_ALNUM = r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+"
_WORD = r"[^\x20\x09-\x0D]+"

ORACLES["op1_minhash_near_dedup"] = f"""
WITH RECURSIVE d AS (SELECT doc_id, regexp_extract_all({_LOWER}, '{_WORD}') AS w FROM documents),
s AS (SELECT DISTINCT doc_id, unnest(
          CASE WHEN len(w) >= 3 THEN list_transform(range(len(w) - 2),
                                                    lambda k: array_to_string(w[k + 1:k + 3], ' '))
               WHEN len(w) > 0 THEN [array_to_string(w, ' ')] ELSE [] END) AS run FROM d),
n AS (SELECT doc_id, count(*) AS n FROM s GROUP BY doc_id),
shared AS (SELECT x.doc_id AS a, y.doc_id AS b, count(*) AS common
           FROM s x JOIN s y ON x.run = y.run AND x.doc_id <> y.doc_id GROUP BY ALL),
links AS (SELECT a, b FROM shared JOIN n na ON na.doc_id = a JOIN n nb ON nb.doc_id = b
          WHERE 100 * common >= 85 * (na.n + nb.n - common)),
reach(doc_id, other) AS (SELECT doc_id, doc_id FROM documents
                         UNION SELECT doc_id, b FROM reach JOIN links ON a = other)
SELECT doc_id, coalesce(any_value(n.n), 0) AS n_shingles, min(other) AS component_id,
       doc_id = min(other) AS kept
FROM reach LEFT JOIN n USING (doc_id) GROUP BY doc_id"""

_CONTROL = r"([<\[])(\\*)(\||/?s>|/?INST\]|<SYS>>|</SYS>>)"

ORACLES["op6_reply_trees"] = rf"""
WITH said AS (SELECT conv_id, turn, coalesce(role, '') AS role, coalesce(text, '') AS text
              FROM (SELECT conv_id, turn, role, text FROM conversations
                    UNION ALL VALUES (-7, 0, 'user', '</s>[INST] ok [/INST]'),
                                     (-7, 1, 'assistant', '</s>[INST] ok [/INST]')))
SELECT conv_id, count(*) AS n_turns,
       sha256(string_agg(role || chr(10) || text || chr(10), '' ORDER BY turn, role, text))
           AS turns_sha256,
       CAST(coalesce(sum(length(text)) FILTER (role = 'assistant'), 0) AS BIGINT) AS loss_chars,
       sha256(coalesce(string_agg(text, '' ORDER BY turn, role, text)
                       FILTER (role = 'assistant'), '')) AS loss_sha256,
       CAST(sum(length('<|' || url_encode(role) || '|>' || chr(10)) + length('<|end|>' || chr(10))
                + length(regexp_replace(text, '{_CONTROL}', '\1\\\2\3', 'g'))) AS BIGINT)
           AS formatted_chars
FROM said GROUP BY conv_id"""

ORACLES["op8_benchmark_decontamination"] = f"""
WITH d AS (SELECT doc_id, regexp_extract_all({_LOWER}, '{_ALNUM}') AS w FROM documents),
i AS (SELECT DISTINCT CAST(item_id AS VARCHAR) AS item_id,
             regexp_extract_all({_LOWER}, '{_ALNUM}') AS w FROM benchmark),
windows AS (SELECT DISTINCT item_id, size, array_to_string(w[k + 1:k + size], ' ') AS run
            FROM (SELECT *, unnest(range(len(w) - size + 1)) AS k
                  FROM (SELECT *, least(len(w), 10) AS size FROM i WHERE len(w) > 0))),
runs AS (SELECT doc_id, size, k, array_to_string(w[k + 1:k + size], ' ') AS run
         FROM (SELECT d.*, s.size, unnest(range(len(w) - size + 1)) AS k
               FROM d, (SELECT DISTINCT size FROM windows) s WHERE len(w) >= s.size)),
hits AS (SELECT doc_id, item_id, k, size FROM runs JOIN windows USING (size, run)),
words AS (SELECT doc_id, count(DISTINCT p) AS n
          FROM (SELECT doc_id, unnest(range(k, k + size)) AS p FROM hits) GROUP BY doc_id),
items AS (SELECT doc_id, count(*) AS n, string_agg(item_id, ',' ORDER BY item_id) AS ids
          FROM (SELECT DISTINCT doc_id, item_id FROM hits) GROUP BY doc_id)
SELECT doc_id, CAST(len(d.w) AS BIGINT) AS n_words, coalesce(words.n, 0) AS n_hit,
       coalesce(items.n, 0) AS n_items, sha256(coalesce(items.ids, '')) AS items_sha256,
       coalesce(words.n, 0) > 0 AS contaminated
FROM d LEFT JOIN words USING (doc_id) LEFT JOIN items USING (doc_id)"""

ORACLES["op10_temperature_mixing"] = f"""
WITH RECURSIVE t AS (
    SELECT doc_id AS id, source,
           CAST(sum(len(regexp_extract_all(coalesce(text, ''), '{_WORD}'))) AS BIGINT) AS tokens
    FROM documents GROUP BY ALL),
s AS (SELECT source, sum(tokens) AS tokens, sum(sum(tokens)) OVER () AS total,
             sum(tokens) / sum(sum(tokens)) OVER () AS share FROM t GROUP BY source),
halved(turn, low, high) AS (
    SELECT 0, CAST(0 AS DOUBLE), CAST(1 AS DOUBLE)
    UNION ALL
    SELECT turn + 1, CASE WHEN e >= 0.9 THEN (low + high) / 2 ELSE low END,
           CASE WHEN e >= 0.9 THEN high ELSE (low + high) / 2 END
    FROM (SELECT turn, low, high,
                 (ln(sum(r)) - sum(r * ln(r)) / sum(r)) / ln(count(*)) AS e
          FROM (SELECT turn, low, high, pow(share, (low + high) / 2) AS r
                FROM halved, s WHERE turn < 40 AND tokens > 0) GROUP BY turn, low, high)),
power AS (SELECT round(max(low), 6) AS power FROM halved WHERE turn = 40),
w AS (SELECT source, tokens AS length,
             CAST(round(pow(share, power) / sum(pow(share, power)) OVER () * total) AS BIGINT)
                 AS quota
      FROM s, power WHERE tokens > 0),
used AS (SELECT t.*, length, quota, epoch, md5(concat_ws(':', 0, epoch, id)) AS key
         FROM (SELECT t.*, w.length, w.quota, unnest(range(0, CAST((quota - 1) // length AS BIGINT) + 1)) AS epoch
               FROM t JOIN w ON t.source IS NOT DISTINCT FROM w.source) t),
placed AS (SELECT id, source, tokens, epoch, quota, key,
                  CAST(epoch * length + coalesce(sum(tokens) OVER (
                      PARTITION BY source, epoch ORDER BY key, id, tokens
                      ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS BIGINT) AS begins
           FROM used)
SELECT id, source, tokens, epoch, begins, begins * 16 // quota AS block,
       md5(concat_ws(':', begins * 16 // quota, key)) AS place
FROM placed WHERE begins < quota"""

#: crc32 of UTF-8 text, from the remainders of all single bytes.
_CRC_BYTES = """bytes AS (SELECT list(list_reduce(list_concat([i], range(8)), lambda c, k:
    CASE WHEN c & 1 = 1 THEN xor(c >> 1, 3988292384) ELSE c >> 1 END) ORDER BY i) AS t
    FROM range(256) r(i))"""


def _crc32(text: str) -> str:
    byte = f"CAST('0x' || substr(hex({text}), CAST(2 * i + 1 AS BIGINT), 2) AS BIGINT)"
    listed = f"list_transform(range(strlen({text})), lambda i: {byte})"
    return f"""xor(list_reduce(list_concat([CAST(4294967295 AS BIGINT)], {listed}), lambda c, b:
        xor(c >> 8, t[(xor(c, b) & 255) + 1])), 4294967295)"""


ORACLES["op11_spelling_variants"] = f"""
WITH RECURSIVE {_CRC_BYTES},
runs AS (SELECT doc_id, run, count(*) AS n
         FROM (SELECT doc_id, unnest(regexp_extract_all({_LOWER}, '[A-Za-zÀ-ÿ]+')) AS run
               FROM documents)
         WHERE length(run) >= 6 GROUP BY ALL),
drawn AS (SELECT run, n, {_crc32("(coalesce(CAST(doc_id AS VARCHAR), '') || ':' || run)")} AS h
          FROM runs, bytes),
results AS (SELECT CASE WHEN h % 199 = 0 THEN substr(run, 1, h % length(run))
                                              || substr(run, h % length(run) + 2)
                        ELSE run END AS word, n FROM drawn),
v AS (SELECT word, CAST(sum(n) AS BIGINT) AS n FROM results
      WHERE length(word) >= 6 GROUP BY word HAVING sum(n) >= 5),
cut AS (SELECT DISTINCT word, n, i, substr(word, 1, i) || substr(word, i + 2) AS rest
        FROM (SELECT word, n, unnest(range(length(word))) AS i FROM v)),
shorter AS (SELECT DISTINCT cut.word AS a, cut.n AS an, v.word AS b, v.n AS bn
            FROM cut JOIN v ON cut.rest = v.word),
near AS (SELECT a AS word, an AS n, b AS other, bn AS other_n FROM shorter
         UNION ALL SELECT b, bn, a, an FROM shorter
         UNION ALL SELECT x.word, x.n, y.word, y.n
                   FROM cut x JOIN cut y ON x.i = y.i AND x.rest = y.rest AND x.word <> y.word),
best AS (SELECT word, count(*) AS n_near,
                min(struct_pack(less := -other_n, form := other)) AS best
         FROM near GROUP BY word),
formed AS (SELECT v.word, v.n, coalesce(n_near, 0) AS n_near,
                  CASE WHEN -best.less >= 5 * v.n THEN best.form END AS form,
                  CASE WHEN -best.less >= 5 * v.n THEN -best.less END AS form_n
           FROM v LEFT JOIN best USING (word)),
walk(word, tip) AS (SELECT word, word FROM v
                   UNION ALL SELECT walk.word, formed.form
                   FROM walk JOIN formed ON walk.tip = formed.word WHERE formed.form IS NOT NULL)
SELECT formed.word, formed.form, walk.tip AS root, formed.n, formed.n_near, formed.form_n
FROM formed JOIN walk USING (word) JOIN formed ended ON ended.word = walk.tip
WHERE ended.form IS NULL"""


def _vector_codes(parts: int = 4, entries: int = 256, rounds: int = 4) -> str:
    """Rounds written out one after the other: nearest entries, then means."""
    steps = []
    for r in range(rounds + 1):
        steps.append(f"""
near{r} AS MATERIALIZED (
    SELECT row, x.part, x.c, min(struct_pack(d := list_sum(list_transform(list_zip(x.c, b.c),
               lambda z: (z[1] - z[2]) * (z[1] - z[2]))), entry := b.entry)) AS best
    FROM cut x JOIN book{r} b USING (part) GROUP BY row, x.part, x.c)""")
        if r < rounds:
            steps.append(f"""
mean{r} AS (SELECT part, entry, list(CAST(m AS BIGINT) ORDER BY place) AS c
            FROM (SELECT part, best.entry AS entry, place, floor(CAST(sum(c[place]) AS DOUBLE) / count(*)) AS m
                  FROM near{r}, places GROUP BY ALL) GROUP BY part, entry),
book{r + 1} AS MATERIALIZED (SELECT part, entry, coalesce(m.c, b.c) AS c
                             FROM book{r} b LEFT JOIN mean{r} m USING (part, entry))""")
    return f"""
WITH kept AS MATERIALIZED (
    SELECT row_number() OVER (ORDER BY vec_id NULLS LAST, embedding) - 1 AS row, vec_id, label,
           list_transform(embedding, lambda x: CAST(floor(1024 * CAST(x AS DOUBLE)) AS BIGINT)) AS c
    FROM embeddings
    WHERE embedding IS NOT NULL
      AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0),
cut AS MATERIALIZED (
    SELECT row, part, c[part * (len(c) // {parts}) + 1:(part + 1) * (len(c) // {parts})] AS c
    FROM kept, range({parts}) r(part)),
places AS (SELECT unnest(range(1, (SELECT any_value(len(c)) FROM cut) + 1)) AS place),
book0 AS MATERIALIZED (SELECT part, row AS entry, c FROM cut WHERE row < {entries}),{",".join(steps)},
coded AS (SELECT vec_id, label, string_agg(printf('%02x', best.entry), '' ORDER BY part) AS code,
                 CAST(sum(best.d) AS BIGINT) AS error
          FROM near{rounds} JOIN kept USING (row) GROUP BY row, vec_id, label)
SELECT vec_id, code, error, CAST(sum(error) OVER (PARTITION BY label) AS BIGINT) AS label_error,
       (SELECT sha256(string_agg(array_to_string(c, ','), ',' ORDER BY part, entry)) FROM book{rounds})
           AS codebooks_sha256
FROM coded"""


ORACLES["op12_vector_codes"] = _vector_codes()

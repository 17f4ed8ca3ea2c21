"""DuckDB SQL for the queries that SQL can express."""

from __future__ import annotations

WORDS = r"regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+')"

#: Levels at which groups are full, and the amount each group gets; as ``mixing.filled``.
_FILLED = """
{name}_listed AS (
  SELECT *, (total - coalesce(sum(room) OVER (PARTITION BY {within} ORDER BY room / weight, weight, room
                ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0.0))
            / sum(weight) OVER (PARTITION BY {within} ORDER BY room / weight, weight, room
                ROWS BETWEEN CURRENT ROW AND UNBOUNDED FOLLOWING) AS level
  FROM {name}),
{name}_held AS (
  SELECT *, max(CASE WHEN level <= room / weight THEN level END) OVER (PARTITION BY {within}) AS holds
  FROM {name}_listed),
{name}_filled AS (SELECT *, least(room, coalesce(holds * weight, room)) AS filled FROM {name}_held)"""

#: A round of taking in rank order: of the documents no longer than what is missing, all before the first that doesn't fit.
_ROUND = """
open_{k} AS (SELECT *, drawn AND NOT taken AND size <= gap AS open FROM taken_{k}),
summed_{k} AS (
  SELECT *, sum(CASE WHEN open THEN size END) OVER (PARTITION BY source ORDER BY rank, doc_id NULLS FIRST, size
              ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW) AS upto
  FROM open_{k}),
taken_{n} AS (
  SELECT * EXCLUDE (open, upto) REPLACE (
    taken OR (open AND upto <= gap) AS taken,
    gap - coalesce(max(CASE WHEN open AND upto <= gap THEN upto END) OVER (PARTITION BY source), 0) AS gap)
  FROM summed_{k})"""
FILLS = 3
_ROUNDS = ",".join(_ROUND.format(k=k, n=k + 1) for k in range(1 + FILLS))

OP1 = f"""
WITH sizes AS (
  SELECT doc_id, source, len({WORDS})::BIGINT AS size FROM documents),
classed AS (SELECT *, CASE WHEN size >= 50 THEN 2.0::DOUBLE ELSE 1.0::DOUBLE END AS w FROM sizes),
words AS (SELECT source, w, sum(size)::BIGINT AS words FROM classed GROUP BY source, w),
totals AS (SELECT source, sum(words)::BIGINT AS source_size FROM words GROUP BY source),
sources AS (
  SELECT source, source_size, 3 * source_size::DOUBLE AS room, sum(source_size) OVER ()::DOUBLE AS total,
         ((row_number() OVER (ORDER BY source NULLS LAST) - 1) % 3 + 1)::DOUBLE AS weight
  FROM totals),
{_FILLED.format(name="sources", within="1")},
classes AS (
  SELECT c.source, c.w, c.words, s.source_size, s.filled AS target, s.filled AS total,
         3 * c.words::DOUBLE AS room,
         CASE WHEN c.words > 0 THEN c.w * c.words::DOUBLE ELSE 1.0::DOUBLE END AS weight
  FROM words c JOIN sources_filled s ON c.source IS NOT DISTINCT FROM s.source),
{_FILLED.format(name="classes", within="source")},
expected AS (
  SELECT *, CASE WHEN words > 0 THEN filled / words::DOUBLE ELSE 0.0::DOUBLE END AS m FROM classes_filled),
plan AS (
  SELECT source, w, source_size, target, whole, CASE WHEN m - whole > 1e-9 THEN m - whole END AS chance,
         target - sum(whole * words) OVER (PARTITION BY source) AS rest
  FROM (SELECT *, floor(m + 1e-9)::BIGINT AS whole FROM expected)),
documented AS (
  SELECT c.doc_id, c.source, c.size, p.source_size, p.target, p.whole, p.chance, p.rest,
         (('0x' || substr(md5('mix:' || coalesce(c.doc_id::VARCHAR, 'null')), 1, 13))::BIGINT::DOUBLE + 0.5)
           / 4503599627370496.0::DOUBLE AS u
  FROM classed c JOIN plan p ON c.source IS NOT DISTINCT FROM p.source AND c.w = p.w),
ranked AS (
  SELECT *, (u / (1 - u)) * ((1 - chance) / chance) AS rank FROM documented),
taken_0 AS (
  SELECT *, chance IS NOT NULL AND size > 0 AS drawn, false AS taken, rest AS gap FROM ranked),
{_ROUNDS},
closing AS (
  SELECT source, arg_min(doc_id, ROW(abs(gap - size), rank, doc_id)) AS doc_id
  FROM taken_{FILLS + 1} WHERE drawn AND NOT taken AND abs(gap - size) < gap GROUP BY source)
SELECT o.doc_id, size, source_size, target,
       (size * (whole + CASE WHEN drawn AND (taken OR c.doc_id IS NOT NULL) THEN 1 ELSE 0 END))::BIGINT AS taken
FROM taken_{FILLS + 1} o LEFT JOIN closing c ON o.source IS NOT DISTINCT FROM c.source AND o.doc_id = c.doc_id"""

OP10 = r"""
WITH RECURSIVE listed AS (
  SELECT doc_id, regexp_extract_all(
    translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
    '[^\x20\x09-\x0D]+') AS w
  FROM documents),
shingled AS (
  SELECT DISTINCT doc_id, unnest(CASE
    WHEN len(w) >= 4 THEN list_transform(range(1, len(w) - 2), lambda i: array_to_string(w[i:i + 3], ' '))
    WHEN len(w) > 0 THEN [array_to_string(w, ' ')] ELSE [] END) AS shingle
  FROM listed),
sizes AS (SELECT doc_id, count(*) AS n FROM shingled GROUP BY doc_id),
common AS (
  SELECT a.doc_id AS a, b.doc_id AS b, count(*) AS n
  FROM shingled a JOIN shingled b ON a.shingle = b.shingle AND a.doc_id <> b.doc_id GROUP BY ALL),
links AS (
  SELECT c.a, c.b FROM common c JOIN sizes x ON x.doc_id = c.a JOIN sizes y ON y.doc_id = c.b
  WHERE 100 * c.n >= 80 * (x.n + y.n - c.n)),
reached(a, b) AS (
  SELECT doc_id, doc_id FROM documents
  UNION
  SELECT r.a, l.b FROM reached r JOIN links l ON r.b = l.a),
components AS (SELECT a AS doc_id, min(b) AS component_id FROM reached GROUP BY a)
SELECT d.doc_id, coalesce(s.n, 0)::BIGINT AS n_shingles, c.component_id, c.component_id = d.doc_id AS kept
FROM documents d LEFT JOIN sizes s USING (doc_id) JOIN components c USING (doc_id)"""


LOWERED = "translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz')"

OP11 = rf"""
WITH documented AS (
  SELECT row_number() OVER () AS row, doc_id,
         regexp_extract_all({LOWERED}, '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS w FROM documents),
itemed AS (
  SELECT item_id, regexp_extract_all({LOWERED}, '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS w FROM benchmark),
windows AS (
  SELECT DISTINCT item_id, least(len(w), 10) AS n,
         unnest(list_transform(range(1, greatest(len(w) - 8, 2)), lambda i: array_to_string(w[i:i + 9], ' '))) AS words
  FROM itemed WHERE len(w) > 0),
occurring AS (
  SELECT d.row, d.place, v.n, v.item_id
  FROM (SELECT row, n, unnest(range(1, len(w) - n + 2)) AS place,
               unnest(list_transform(range(1, len(w) - n + 2), lambda i: array_to_string(w[i:i + n - 1], ' '))) AS words
        FROM documented, (SELECT DISTINCT n FROM windows)) d
  JOIN windows v ON d.words = v.words AND d.n = v.n),
hits AS (
  SELECT row, count(DISTINCT place) AS n_hit
  FROM (SELECT row, unnest(range(place, place + n)) AS place FROM (SELECT DISTINCT row, place, n FROM occurring)) GROUP BY row),
found AS (
  SELECT row, count(DISTINCT item_id) AS n_items,
         sha256(coalesce(string_agg(DISTINCT item_id::VARCHAR, ',' ORDER BY item_id::VARCHAR), '')) AS items_sha256
  FROM occurring GROUP BY row)
SELECT doc_id, len(w)::BIGINT AS n_words, coalesce(n_hit, 0)::BIGINT AS n_hit, coalesce(n_items, 0)::BIGINT AS n_items,
       coalesce(items_sha256, sha256('')) AS items_sha256, coalesce(n_hit, 0) > 0 AS contaminated
FROM documented LEFT JOIN hits USING (row) LEFT JOIN found USING (row)"""

OP12 = rf"""
WITH listed AS (
  SELECT row_number() OVER () AS row, doc_id,
         regexp_extract_all({LOWERED}, '[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+') AS w FROM documents),
documented AS (SELECT row, doc_id, w, len(w)::BIGINT AS n FROM listed WHERE len(w) > 0),
totals AS (SELECT count(*)::BIGINT AS all_documents, sum(n)::BIGINT AS all_terms FROM documented),
posted AS (
  SELECT row, term, count(*)::BIGINT AS tf FROM (SELECT row, unnest(w) AS term FROM documented) GROUP BY row, term),
weighted AS (
  SELECT term, floor(1000 * ln((2 * all_documents + 2)::DOUBLE / (2 * count(*) + 1)::DOUBLE))::BIGINT AS weight
  FROM posted, totals GROUP BY term, all_documents),
queried AS (
  SELECT DISTINCT item_id,
         unnest(regexp_extract_all({LOWERED}, '[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+')) AS term
  FROM benchmark),
scored AS (
  SELECT q.item_id, d.row, d.doc_id,
         sum(weight * ((1000000000 * tf) // (1000 * tf + 8 * (10 + (90 * d.n * all_documents) // all_terms))))::BIGINT
           AS score
  FROM queried q JOIN posted p ON q.term = p.term JOIN weighted t ON t.term = p.term
  JOIN documented d ON d.row = p.row, totals
  GROUP BY q.item_id, d.row, d.doc_id)
SELECT item_id, rank, doc_id, score
FROM (SELECT item_id, doc_id, score, (row_number() OVER (PARTITION BY item_id ORDER BY score DESC, doc_id NULLS LAST))::INTEGER AS rank
      FROM scored WHERE score > 0)
WHERE rank <= 10"""

# The table of a byte's crc32 steps is built by its rule; a slip is a run whose crc32 199 divides.
OP13 = r"""
WITH RECURSIVE steps AS (
  SELECT list_transform(range(256), lambda b: list_reduce([b, 1, 1, 1, 1, 1, 1, 1, 1],
    lambda c, k: CASE WHEN c & 1 = 1 THEN xor(c >> 1, 3988292384) ELSE c >> 1 END)) AS t),
runs AS (
  SELECT doc_id, translate(run, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS run
  FROM (SELECT doc_id, unnest(regexp_extract_all(text, '[A-Za-z\x{C0}-\x{FF}]+')) AS run FROM documents)),
counted AS (SELECT doc_id, run, count(*) AS n FROM runs GROUP BY doc_id, run),
coded AS (
  SELECT doc_id, run, n, hex(encode(doc_id::VARCHAR || ':' || run)) AS code FROM counted WHERE len(run) >= 6),
hashed AS (
  SELECT run, n, xor(list_reduce(list_prepend(4294967295::BIGINT,
      list_transform(range(1, len(code), 2), lambda i: ('0x' || substr(code, i, 2))::BIGINT)),
      lambda c, b: xor(c >> 8, t[1 + (xor(c, b) & 255)])), 4294967295::BIGINT) AS h
  FROM coded, steps),
slipped AS (
  SELECT CASE WHEN h % 199 = 0 THEN substr(run, 1, (h % len(run))::INT) || substr(run, (h % len(run))::INT + 2)
              ELSE run END AS word, n FROM hashed),
words AS (
  SELECT word, sum(n)::BIGINT AS n FROM slipped WHERE len(word) >= 6 GROUP BY word HAVING sum(n) >= 5),
holed AS (
  SELECT word, n, i, len(word) AS size, substr(word, 1, i) AS head, substr(word, i + 2) AS tail
  FROM (SELECT word, n, unnest(range(len(word)))::INT AS i FROM words)),
near AS (
  SELECT a.word AS a, b.word AS b FROM holed a JOIN holed b
    ON a.i = b.i AND a.size = b.size AND a.head = b.head AND a.tail = b.tail AND a.word <> b.word
  UNION SELECT h.word, w.word FROM holed h JOIN words w ON w.word = h.head || h.tail
  UNION SELECT w.word, h.word FROM holed h JOIN words w ON w.word = h.head || h.tail),
best AS (
  SELECT a AS word, count(*) AS n_near, arg_min(b, ROW(-y.n, b)) AS form, max(y.n) AS form_n
  FROM near JOIN words y ON y.word = near.b GROUP BY a),
formed AS (
  SELECT w.word, w.n, coalesce(n_near, 0)::BIGINT AS n_near,
         CASE WHEN form_n >= 5 * w.n THEN form END AS form, CASE WHEN form_n >= 5 * w.n THEN form_n END AS form_n
  FROM words w LEFT JOIN best USING (word)),
led(word, root, depth) AS (
  SELECT word, word, 0 FROM formed
  UNION ALL SELECT l.word, f.form, depth + 1 FROM led l JOIN formed f ON f.word = l.root WHERE f.form IS NOT NULL),
ends AS (SELECT word, arg_max(root, depth) AS root FROM led GROUP BY word)
SELECT word, form, root, n, n_near, form_n::BIGINT AS form_n FROM formed JOIN ends USING (word)"""


def oracles() -> dict[str, str]:
    return {
        "op1_mix": OP1,
        "op10_minhash": OP10,
        "op11_decontamination": OP11,
        "op12_ranked_search": OP12,
        "op13_spelling": OP13,
    }

"""DuckDB SQL for the operators that SQL expresses over whole tables.

The others are tested against brute force in ``tests/llm``: packing (tokenizer),
line dedup (rolling hashes), the classifiers (trained), SimHash (XXH64 and
components), sharding (a heap) and the secret scan (span positions and window
counts would be quadratic there).
"""

# Every clause's place and normal form; all but the earliest of equal ones are repeats, and
# runs of them with 30 words or more go.
SUBSTRING = r"""
WITH parted AS (
  SELECT doc_id, text, regexp_extract_all(text,
    '[^\n.,;:!?。，、；：！？]+([\n.,;:!?。，、；：！？][\n.,;:!?。，、；：！？\x20\x09-\x0D]*)?|[\n.,;:!?。，、；：！？][\n.,;:!?。，、；：！？\x20\x09-\x0D]*') AS parts
  FROM documents
), placed AS (
  SELECT doc_id, i AS place, part, sum(length(part)) OVER (PARTITION BY doc_id ORDER BY i) AS end_at,
         trim(regexp_replace(translate(part, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
              '[\x20\x09-\x0D]+', ' ', 'g'), ' ') AS norm
  FROM (SELECT doc_id, unnest(parts) AS part, unnest(range(1, len(parts) + 1)) AS i FROM parted)
), counted AS (
  SELECT *, end_at - length(part) AS start_at, greatest(len(string_split(norm, ' ')), length(norm) // 6) AS words,
         row_number() OVER (PARTITION BY norm ORDER BY doc_id, place) > 1 AS repeat
  FROM placed WHERE norm <> ''
), runs AS (
  SELECT *, count(*) FILTER (NOT repeat) OVER (PARTITION BY doc_id ORDER BY place) AS run FROM counted
), gone AS (
  SELECT doc_id, min(start_at)::BIGINT AS a, max(end_at)::BIGINT AS b, count(*) AS n
  FROM runs WHERE repeat GROUP BY doc_id, run HAVING sum(words) >= 30
), totals AS (
  SELECT doc_id, count(*) AS n_units, count(*) FILTER (repeat) AS n_repeated FROM counted GROUP BY doc_id
), cut AS (
  SELECT doc_id, sum(n)::BIGINT AS n_removed, string_agg(a || ':' || b, ',' ORDER BY a) AS removed FROM gone GROUP BY doc_id
), left_over AS (
  SELECT p.doc_id, string_agg(part, '' ORDER BY place) AS text
  FROM placed p WHERE NOT EXISTS (SELECT 1 FROM gone g WHERE g.doc_id = p.doc_id AND p.end_at > g.a AND p.end_at <= g.b)
  GROUP BY p.doc_id
)
SELECT d.doc_id, CASE WHEN d.text IS NULL THEN NULL ELSE coalesce(l.text, '') END AS text,
       coalesce(t.n_units, 0) AS n_units, coalesce(t.n_repeated, 0) AS n_repeated, coalesce(c.n_removed, 0) AS n_removed,
       coalesce(c.removed, '') AS removed
FROM documents d LEFT JOIN totals t ON t.doc_id = d.doc_id LEFT JOIN cut c ON c.doc_id = d.doc_id
     LEFT JOIN left_over l ON l.doc_id = d.doc_id
"""

# Exact search: the operator's error bounds must lose nothing of it.
NEIGHBOURS = """
WITH usable AS (
  SELECT vec_id, embedding::DOUBLE[] AS e FROM embeddings
  WHERE vec_id IS NOT NULL AND embedding IS NOT NULL
    AND len(list_filter(embedding, lambda x: x IS NULL OR isnan(x) OR isinf(x))) = 0
    AND len(list_filter(embedding, lambda x: x <> 0)) > 0
), scored AS (
  SELECT q.vec_id AS query_id, c.vec_id AS vec_id,
         list_dot_product(q.e, c.e) / (sqrt(list_dot_product(q.e, q.e)) * sqrt(list_dot_product(c.e, c.e))) AS score
  FROM usable q, usable c WHERE q.vec_id % 50 = 0 AND c.vec_id <> q.vec_id
), ranked AS (
  SELECT query_id, row_number() OVER (PARTITION BY query_id ORDER BY score DESC, vec_id)::INTEGER AS rank, vec_id, score FROM scored
)
SELECT * FROM ranked WHERE rank <= 5
"""

# Every document window is looked up among the items' windows.
DECONTAMINATION = r"""
WITH items AS (
  SELECT item_id, regexp_extract_all(translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
                                     '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS w FROM benchmark
), item_windows AS (
  SELECT DISTINCT item_id, least(len(w), 10) AS n, array_to_string(w[i:i + least(len(w), 10) - 1], ' ') AS win
  FROM (SELECT item_id, w, unnest(range(1, greatest(1, len(w) - 9) + 1)) AS i FROM items WHERE len(w) > 0)
), lengths AS (
  SELECT DISTINCT n FROM item_windows
), docs AS (
  SELECT doc_id, coalesce(regexp_extract_all(translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
                                             '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+'), []) AS w FROM documents
), doc_windows AS (
  SELECT doc_id, n, i, array_to_string(w[i:i + n - 1], ' ') AS win
  FROM (SELECT doc_id, w, n, unnest(range(1, len(w) - n + 2)) AS i FROM docs, lengths WHERE len(w) >= n)
), found AS (
  SELECT doc_id, d.n, i, item_id FROM doc_windows d JOIN item_windows b USING (n, win)
), hit AS (
  SELECT doc_id, count(DISTINCT p) AS n_hit FROM (SELECT doc_id, unnest(range(i, i + n)) AS p FROM found) GROUP BY doc_id
), named AS (
  SELECT doc_id, count(*) AS n_items, string_agg(item_id::VARCHAR, ',' ORDER BY item_id::VARCHAR) AS names
  FROM (SELECT DISTINCT doc_id, item_id FROM found) GROUP BY doc_id
)
SELECT d.doc_id, len(d.w)::BIGINT AS n_words, coalesce(h.n_hit, 0)::BIGINT AS n_hit, coalesce(m.n_items, 0)::BIGINT AS n_items,
       sha256(coalesce(m.names, '')) AS items_sha256, coalesce(h.n_hit, 0) > 0 AS contaminated
FROM docs d LEFT JOIN hit h ON h.doc_id = d.doc_id LEFT JOIN named m ON m.doc_id = d.doc_id
"""

# All phrases are listed and counted; cuts and holders are joined by their words.
PHRASES = r"""
WITH pieces AS (
  SELECT coalesce(lang, 'und') AS lang, unnest(string_split_regex(
           translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[.,;:!?\x0A-\x0D]')) AS piece
  FROM documents
), worded AS (
  SELECT lang, regexp_extract_all(piece, '[^\x20\x09]+') AS w FROM pieces
), grams AS (
  SELECT lang, k, w[i:i + k - 1] AS p
  FROM (SELECT lang, w, unnest(range(1, len(w) + 1)) AS i FROM worded), (VALUES (1), (2), (3)) AS sizes(k)
  WHERE i + k - 1 <= len(w)
), f AS (
  SELECT lang, k, p, count(*) AS n FROM grams GROUP BY ALL
), totals AS (
  SELECT lang, sum(n)::BIGINT AS n FROM f WHERE k = 1 GROUP BY lang
), cand AS (
  SELECT lang, k, p, n AS a FROM f WHERE k > 1 AND n >= 10
), cuts AS (
  SELECT c.lang, c.k, c.p, c.a, j, x.n AS l, y.n AS r, (1000000::HUGEINT * c.a * c.a) // (x.n::HUGEINT * y.n) AS score
  FROM (SELECT *, unnest(range(1, k)) AS j FROM cand) c
  JOIN f x ON x.lang = c.lang AND x.p = c.p[1:j] JOIN f y ON y.lang = c.lang AND y.p = c.p[j + 1:]
), best AS (
  SELECT * FROM (SELECT *, row_number() OVER (PARTITION BY lang, p ORDER BY score, j) AS o FROM cuts) WHERE o = 1
), held AS (
  SELECT lang, part, max(a) AS longer
  FROM (SELECT lang, a, unnest([p[1:2], p[2:3]]) AS part FROM cand WHERE k = 3) GROUP BY ALL
), kept AS (
  SELECT b.lang, array_to_string(b.p, ' ') AS phrase, b.a, b.l, b.r, b.score::BIGINT AS score
  FROM best b LEFT JOIN held h ON h.lang = b.lang AND h.part = b.p
  WHERE h.longer IS NULL OR 100 * h.longer < 50 * b.a
)
SELECT k.lang, row_number() OVER (PARTITION BY k.lang ORDER BY score DESC, a DESC, phrase) AS rank, phrase, a, l, r, t.n, score
FROM kept k JOIN totals t ON t.lang = k.lang
QUALIFY rank <= 2000
"""

# Targets by the level that holds behind the last source at its limit; positions from the
# inverted integral of 5 (1.5 - t), 2 and 0.5 + t over each source's target.
MIXING = r"""
WITH sized AS (
  SELECT doc_id, source, coalesce(len(regexp_extract_all(text, '[^\x20\x09-\x0D]+')), 0)::BIGINT AS size,
         md5('curriculum:' || coalesce(doc_id::VARCHAR, 'null')) AS mark FROM documents
), sources AS (
  SELECT source, z, turn, CASE turn % 3 WHEN 0 THEN 5.0 WHEN 1 THEN 2.0 ELSE 1.0 END::DOUBLE AS w
  FROM (SELECT source, sum(size)::BIGINT AS z, row_number() OVER (ORDER BY source IS NULL, source) - 1 AS turn
        FROM sized GROUP BY source)
), levels AS (
  SELECT *, 2 * z / w AS limit_at,
         (sum(z) OVER () * 1.5::DOUBLE - 2 * coalesce(sum(z) OVER before, 0)) / (sum(w) OVER () - coalesce(sum(w) OVER before, 0)) AS level
  FROM sources WINDOW before AS (ORDER BY 2 * z / w, turn ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING)
), chosen AS (
  SELECT level FROM levels WHERE 2 * z > level * w ORDER BY limit_at, turn LIMIT 1
), aimed AS (
  SELECT source, z, turn, least((2 * z)::DOUBLE, w * (SELECT level FROM chosen)) AS target FROM sources
), supplied AS (
  SELECT s.*, a.z, a.turn, a.target, coalesce(sum(size) OVER (PARTITION BY turn ORDER BY mark, doc_id, size
           ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0)::BIGINT AS before, row_number() OVER () AS row
  FROM sized s JOIN aimed a ON a.source IS NOT DISTINCT FROM s.source
), copies AS (
  SELECT *, c * z + before AS start, greatest(least(size, floor(target + 0.5)::BIGINT - (c * z + before)), 0) AS words
  FROM supplied, (VALUES (0), (1)) AS passes(c)
), timed AS (
  SELECT *, start::DOUBLE / nullif(target, 0) AS share FROM copies WHERE words > 0
), placed AS (
  SELECT *, row_number() OVER (ORDER BY due, turn, start, doc_id, size, row) - 1 AS place
  FROM (SELECT *, share * 2.0::DOUBLE / CASE turn % 3
                    WHEN 0 THEN 1.5::DOUBLE + sqrt(greatest(2.25::DOUBLE - 2.0::DOUBLE * share, 0.0))
                    WHEN 1 THEN 2.0::DOUBLE ELSE 0.5::DOUBLE + sqrt(0.25::DOUBLE + 2.0::DOUBLE * share) END AS due FROM timed)
), taken AS (
  SELECT row, sum(words)::BIGINT AS taken, count(*) AS copies, min(place) AS first_place FROM placed GROUP BY row
)
SELECT s.doc_id, s.size, s.z AS source_size, s.target, coalesce(t.taken, 0)::BIGINT AS taken,
       coalesce(t.copies, 0)::BIGINT AS copies, coalesce(t.first_place, -1) AS first_place
FROM supplied s LEFT JOIN taken t ON t.row = s.row
"""

ORACLE = {
    "op3_one_bit_neighbours": NEIGHBOURS,
    "op4_substring_dedup": SUBSTRING,
    "op10_decontamination": DECONTAMINATION,
    "op11_phrase_mining": PHRASES,
    "op12_source_mixing": MIXING,
}

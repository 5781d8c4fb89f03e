"""DuckDB SQL for the queries of this package that SQL can express.

Not here: op2 (trained model), op4 (parsing of pages), op5 (the tree), op7 and op10 (merges of a vocabulary), op8 (trained model);
their tests compare them with plain versions.
"""

_WORDS = r"regexp_extract_all({}, '[^\x20\x09-\x0D]+')"

ORACLES = {
    "op1_near_duplicates": f"""
        WITH RECURSIVE words AS (
          SELECT doc_id, {_WORDS.format("translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz')")} AS w
          FROM documents
        ), shingles AS (
          SELECT DISTINCT doc_id, array_to_string(w[i:i + 3], ' ') AS s
          FROM (SELECT doc_id, w, unnest(range(1, greatest(len(w) - 3, 1) + 1)) AS i FROM words WHERE len(w) > 0)
        ), sizes AS (SELECT doc_id, count(*) AS n FROM shingles GROUP BY doc_id
        ), links AS (
          SELECT a, b FROM (
            SELECT x.doc_id AS a, y.doc_id AS b, count(*) AS c FROM shingles x JOIN shingles y ON x.s = y.s AND x.doc_id <> y.doc_id GROUP BY 1, 2
          ) JOIN sizes p ON p.doc_id = a JOIN sizes q ON q.doc_id = b
          WHERE 100 * c >= 80 * (p.n + q.n - c)
        ), reach AS (
          SELECT a, b FROM links UNION SELECT r.a, l.b FROM reach r JOIN links l ON l.a = r.b
        ), lowest AS (SELECT a, min(b) AS low FROM reach GROUP BY a)
        SELECT d.doc_id, coalesce(n, 0)::BIGINT AS n_shingles, least(d.doc_id, coalesce(low, d.doc_id)) AS component_id,
               least(d.doc_id, coalesce(low, d.doc_id)) = d.doc_id AS kept
        FROM documents d LEFT JOIN sizes s ON s.doc_id = d.doc_id LEFT JOIN lowest l ON l.a = d.doc_id
    """,
    "op3_repeated_passages": f"""
        WITH words AS (SELECT doc_id, {_WORDS.format("coalesce(text, '')")} AS w FROM documents
        ), places AS (
          SELECT doc_id, i, w[i] AS word, CASE WHEN i + 49 <= len(w) THEN md5(array_to_string(w[i:i + 49], ' ')) END AS win
          FROM (SELECT doc_id, w, unnest(range(1, len(w) + 1)) AS i FROM words)
        ), firsts AS (SELECT win, min(doc_id) AS low FROM places WHERE win IS NOT NULL GROUP BY win
        ), marked AS (
          SELECT p.doc_id, i, word,
                 max(CASE WHEN low < p.doc_id THEN i END) OVER (PARTITION BY p.doc_id ORDER BY i ROWS BETWEEN 49 PRECEDING AND CURRENT ROW) AS hit
          FROM places p LEFT JOIN firsts f ON f.win = p.win
        ), kept AS (
          SELECT doc_id, count(*) AS n, count(hit) AS gone, string_agg(CASE WHEN hit IS NULL THEN word END, ' ' ORDER BY i) AS t
          FROM marked GROUP BY doc_id
        )
        SELECT d.doc_id, coalesce(n, 0)::BIGINT AS n_words, coalesce(gone, 0)::BIGINT AS n_removed, sha256(coalesce(t, '')) AS kept_sha256
        FROM documents d LEFT JOIN kept k ON k.doc_id = d.doc_id
    """,
    "op6_mix": f"""
        WITH sized AS (
          SELECT doc_id, source, len({_WORDS.format("coalesce(text, '')")})::BIGINT AS size,
                 ('0x' || substr(md5('mix:' || doc_id), 1, 13))::BIGINT / 4503599627370496.0 AS u
          FROM documents
        ), sources AS (
          SELECT source, sum(size)::BIGINT AS ss, 2.0::DOUBLE * sum(size)::BIGINT AS cap,
                 [5, 2, 1][(row_number() OVER (ORDER BY source NULLS LAST) - 1) % 3 + 1] AS w
          FROM sized GROUP BY source
        ), tries AS (
          SELECT row_number() OVER o AS k,
                 (1.5::DOUBLE * (sum(ss) OVER ())::BIGINT - 2.0::DOUBLE * coalesce(sum(ss) OVER (o ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0)::BIGINT)
                 / (sum(w) OVER (o ROWS BETWEEN CURRENT ROW AND UNBOUNDED FOLLOWING))::BIGINT AS level
          FROM sources WINDOW o AS (ORDER BY cap / w, source)
        ), level AS (
          SELECT level FROM tries t WHERE (SELECT count(*) FROM sources s WHERE s.cap < s.w * t.level) = k - 1 ORDER BY k LIMIT 1
        ), goals AS (
          SELECT source, ss, least(cap, w * (SELECT level FROM level)) AS target FROM sources
        ), split AS (
          SELECT *, CASE WHEN ss > 0 THEN floor(target / ss)::BIGINT ELSE 0 END AS whole FROM goals
        ), rests AS (SELECT *, target - whole * ss AS rest FROM split
        ), by_size AS (
          SELECT g.source, s.size, count(*) AS n, any_value(rest) AS rest, sqrt(s.size::DOUBLE) AS w
          FROM sized s JOIN rests g ON g.source IS NOT DISTINCT FROM s.source GROUP BY g.source, s.size
        ), sure AS (
          SELECT *, rest > 0 AND size > 0
            AND (rest - coalesce(sum(n * size) OVER (PARTITION BY source ORDER BY size DESC ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0)) * w
                >= sum(n * size * w) OVER (PARTITION BY source ORDER BY size) AS sure
          FROM by_size
        ), chances AS (
          SELECT source, size, CASE WHEN sure THEN 1.0 ELSE
            (rest - coalesce(sum(CASE WHEN sure THEN n * size END) OVER (PARTITION BY source), 0))
            / nullif(sum(CASE WHEN NOT sure THEN n * size * w END) OVER (PARTITION BY source), 0) * w END AS p
          FROM sure
        ), ranked AS (
          SELECT s.doc_id, s.source, s.size, ss, target, whole, rest,
                 CASE WHEN p >= 1 OR u = 0 THEN 0.0 WHEN p > 0 THEN (u * (1.0 - p)) / ((1.0 - u) * p) END AS rnk
          FROM sized s JOIN rests g ON g.source IS NOT DISTINCT FROM s.source
          JOIN chances c ON c.source IS NOT DISTINCT FROM s.source AND c.size = s.size
        ), placed AS (
          SELECT *, sum(CASE WHEN rnk IS NOT NULL THEN size ELSE 0 END) OVER (PARTITION BY source ORDER BY rnk NULLS LAST, doc_id, size ROWS UNBOUNDED PRECEDING) AS upto FROM ranked
        )
        SELECT doc_id, size, ss AS source_size, target,
               (size * (whole + CASE WHEN rnk IS NOT NULL AND rest > 0 AND (upto <= rest OR (upto - size < rest AND upto - rest < rest - (upto - size))) THEN 1 ELSE 0 END))::BIGINT AS taken
        FROM placed
    """,
    "op9_exact_dedup": """
        SELECT doc_id, max(doc_id) OVER same AS keep_id, count(*) OVER same AS group_size,
               doc_id = max(doc_id) OVER same AS kept, sha256(coalesce(text, '')) AS text_sha256
        FROM documents WINDOW same AS (PARTITION BY coalesce(text, ''))
    """,
    "op11_ngram_join": f"""
        WITH RECURSIVE words AS (
          SELECT doc_id, {_WORDS.format("translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz')")} AS w
          FROM documents
        ), shingles AS (
          SELECT DISTINCT doc_id, array_to_string(w[i:i + 3], ' ') AS s
          FROM (SELECT doc_id, w, unnest(range(1, greatest(len(w) - 3, 1) + 1)) AS i FROM words WHERE len(w) > 0)
        ), sizes AS (SELECT doc_id, count(*) AS n FROM shingles GROUP BY doc_id
        ), links AS (
          SELECT a, b FROM (
            SELECT x.doc_id AS a, y.doc_id AS b, count(*) AS c FROM shingles x JOIN shingles y ON x.s = y.s AND x.doc_id <> y.doc_id GROUP BY 1, 2
          ) JOIN sizes p ON p.doc_id = a JOIN sizes q ON q.doc_id = b
          WHERE 100 * c >= 85 * (p.n + q.n - c)
        ), reach AS (
          SELECT a, b FROM links UNION SELECT r.a, l.b FROM reach r JOIN links l ON l.a = r.b
        ), lowest AS (SELECT a, min(b) AS low FROM reach GROUP BY a)
        SELECT d.doc_id, coalesce(n, 0)::BIGINT AS n_shingles, least(d.doc_id, coalesce(low, d.doc_id)) AS component_id
        FROM documents d LEFT JOIN sizes s ON s.doc_id = d.doc_id LEFT JOIN lowest l ON l.a = d.doc_id
    """,
    "op12_filter_audit": f"""
        WITH flags AS (
          SELECT d.doc_id, coalesce(source, '') AS part, coalesce(text, '') AS t, {_WORDS.format("coalesce(text, '')")} AS w,
                 EXISTS (SELECT 1 FROM labels l WHERE l.doc_id = d.doc_id AND quality = 1) AS good,
                 EXISTS (SELECT 1 FROM labels l WHERE l.doc_id = d.doc_id AND toxic = 1) AS toxic,
                 coalesce(d.doc_id > min(d.doc_id) OVER (PARTITION BY coalesce(text, '')), false) AS e
          FROM documents d
        ), docs AS (
          SELECT part, good, toxic, concat(CASE WHEN len(w) < 200 THEN 'A' END, CASE WHEN 100 * len(list_distinct(w)) < 50 * len(w) THEN 'B' END,
                 CASE WHEN 100 * length(regexp_replace(t, '[^A-Z]', '', 'g')) > 2 * length(t) THEN 'C' END,
                 CASE WHEN regexp_matches(t, '[#$%&*|]') THEN 'D' END, CASE WHEN e THEN 'E' END) AS fails
          FROM flags
        ), counted AS (
          SELECT part, fails, count(*) AS n, count(*) FILTER (good) AS good, count(*) FILTER (toxic) AS toxic FROM docs GROUP BY part, fails
        ), letters AS (SELECT unnest(['A', 'B', 'C', 'D', 'E']) AS f
        ), orders AS (
          SELECT a.f || b.f || c.f || d.f || e.f AS filter_order FROM letters a, letters b, letters c, letters d, letters e
          WHERE len(list_distinct([a.f, b.f, c.f, d.f, e.f])) = 5
        ), steps AS (
          SELECT filter_order, step, filter_order[step] AS f, filter_order[1:step - 1] AS before
          FROM orders, (SELECT unnest(range(1, 6))::INTEGER AS step)
        ), played AS (
          SELECT part, filter_order, step, f,
                 sum(CASE WHEN removed_at > step THEN n ELSE 0 END)::BIGINT AS kept,
                 sum(CASE WHEN removed_at = step THEN n ELSE 0 END)::BIGINT AS removed,
                 sum(CASE WHEN removed_at < step AND contains(fails, f) THEN n ELSE 0 END)::BIGINT AS redundant,
                 sum(CASE WHEN fails = f THEN n ELSE 0 END)::BIGINT AS unique_fails,
                 sum(CASE WHEN removed_at = step THEN good ELSE 0 END)::BIGINT AS good_lost,
                 sum(CASE WHEN removed_at = step THEN toxic ELSE 0 END)::BIGINT AS toxic_lost
          FROM (
            SELECT *, coalesce(list_min(list_transform(string_split(nullif(fails, ''), ''), lambda x: position(x IN filter_order))), 6) AS removed_at
            FROM counted, steps
          ) GROUP BY part, filter_order, step, f
        )
        SELECT part, filter_order, step, kept, removed, redundant, unique_fails, good_lost, toxic_lost,
               (sum(removed) OVER (PARTITION BY part, f))::BIGINT AS shapley
        FROM played
    """,
}

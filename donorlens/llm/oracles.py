"""DuckDB SQL for the queries that SQL can express. Fixed values are written out, not imported from the code under test."""

ORACLE_SQL: dict[str, str] = {}

ORACLE_SQL["op3_exact_dedup"] = r"""
WITH t AS (SELECT doc_id, translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS norm FROM documents)
SELECT doc_id, max(doc_id) OVER w AS keep_id, count(*) OVER w AS group_size, doc_id = max(doc_id) OVER w AS kept, sha256(norm) AS text_sha256
FROM t WINDOW w AS (PARTITION BY norm)
"""

ORACLE_SQL["op12_filter_audit"] = r"""
WITH docs AS (SELECT doc_id, coalesce(source, '') AS part, coalesce(text, '') AS text FROM documents),
worded AS (SELECT *, list_filter(string_split_regex(text, '[\x20\x09-\x0D]+'), lambda x: x <> '') AS w,
                  min(doc_id) OVER (PARTITION BY text) AS first_id FROM docs),
marked AS (SELECT doc_id, part, len(w) < 200 AS fa, 100 * len(list_distinct(w)) < 50 * len(w) AS fb,
                  100 * length(regexp_replace(text, '[^A-Z]', '', 'g')) > 2 * length(text) AS fc,
                  regexp_matches(text, '[#$%&*|]') AS fd, doc_id IS NOT NULL AND doc_id > first_id AS fe FROM worded),
labelled AS (SELECT doc_id, max((quality = 1)::INT) AS good, max((toxic = 1)::INT) AS toxic FROM labels GROUP BY doc_id),
masks AS (SELECT part, map(['A', 'B', 'C', 'D', 'E'], [fa, fb, fc, fd, fe]) AS f, fa::INT + fb::INT + fc::INT + fd::INT + fe::INT AS n_fails,
                 count(*) AS c, sum(coalesce(good, 0)) AS good, sum(coalesce(toxic, 0)) AS toxic
          FROM marked LEFT JOIN labelled USING (doc_id) GROUP BY ALL),
letters AS (SELECT unnest(['A', 'B', 'C', 'D', 'E']) AS x),
orders AS (SELECT a.x || b.x || c.x || d.x || e.x AS o FROM letters a, letters b, letters c, letters d, letters e
           WHERE len(list_distinct([a.x, b.x, c.x, d.x, e.x])) = 5),
gone AS (SELECT part, o, list_position(list_transform(string_split(o, ''), lambda x: f[x]), true) AS pos, f, n_fails, c, good, toxic FROM masks, orders),
steps AS (SELECT part, o, s, o[s] AS x, sum(CASE WHEN pos IS NULL OR pos = 0 OR pos > s THEN c ELSE 0 END) AS kept,
                 sum(CASE WHEN pos = s THEN c ELSE 0 END) AS removed, sum(CASE WHEN pos < s AND pos > 0 AND f[o[s]] THEN c ELSE 0 END) AS redundant,
                 sum(CASE WHEN n_fails = 1 AND f[o[s]] THEN c ELSE 0 END) AS unique_fails,
                 sum(CASE WHEN pos = s THEN good ELSE 0 END) AS good_lost, sum(CASE WHEN pos = s THEN toxic ELSE 0 END) AS toxic_lost
          FROM gone, range(1, 6) r(s) GROUP BY ALL)
SELECT part, o AS filter_order, s::INT AS step, kept::BIGINT AS kept, removed::BIGINT AS removed, redundant::BIGINT AS redundant,
       unique_fails::BIGINT AS unique_fails, good_lost::BIGINT AS good_lost, toxic_lost::BIGINT AS toxic_lost,
       (sum(removed) OVER (PARTITION BY part, x))::BIGINT AS shapley
FROM steps
"""

ORACLE_SQL["op13_collocations"] = r"""
WITH pieces AS (SELECT coalesce(lang, 'und') AS lang, unnest(string_split_regex(translate(coalesce(text, ''),
                    'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[.,;:!?\x0A-\x0D]')) AS piece FROM documents),
worded AS (SELECT lang, list_filter(string_split_regex(piece, '[\x20\x09]+'), lambda x: x <> '') AS w FROM pieces),
placed AS (SELECT lang, w, unnest(range(1, len(w) + 1)) AS i FROM worded),
phrases AS (SELECT lang, w[i:i + k - 1] AS p, k, count(*)::HUGEINT AS f FROM placed, range(1, 4) r(k) WHERE i + k - 1 <= len(w) GROUP BY ALL),
totals AS (SELECT lang, sum(f)::BIGINT AS n FROM phrases WHERE k = 1 GROUP BY lang),
cuts AS (SELECT c.lang, c.p, c.k, c.f AS a, j, x.f AS l, y.f AS r, (1000000 * c.f * c.f) // (x.f * y.f) AS score
         FROM phrases c, range(1, 3) q(j), phrases x, phrases y
         WHERE c.k BETWEEN 2 AND 3 AND c.f >= 10 AND j < c.k AND x.lang = c.lang AND x.p = c.p[1:j] AND y.lang = c.lang AND y.p = c.p[j + 1:]),
best AS (SELECT * FROM cuts QUALIFY row_number() OVER (PARTITION BY lang, p ORDER BY score, j) = 1),
free AS (SELECT * FROM best b WHERE NOT EXISTS (SELECT 1 FROM phrases z WHERE z.lang = b.lang AND z.k = 3 AND b.k = 2 AND z.f >= 10
             AND 100 * z.f >= 50 * b.a AND (z.p[1:2] = b.p OR z.p[2:3] = b.p))),
ranked AS (SELECT lang, row_number() OVER (PARTITION BY lang ORDER BY score DESC, a DESC, encode(array_to_string(p, ' '))) AS rank,
                  array_to_string(p, ' ') AS phrase, a, l, r, score FROM free)
SELECT lang, rank, phrase, a::BIGINT AS a, l::BIGINT AS l, r::BIGINT AS r, n, score::BIGINT AS score FROM ranked JOIN totals USING (lang) WHERE rank <= 2000
"""

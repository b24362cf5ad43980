"""DuckDB SQL for the queries that SQL can express on whole tables."""

_SPACE = "[\\x20\\x09-\\x0D]"


def _clustering(dims: int = 64, clusters: int = 8, rounds: int = 10) -> str:
    """Every round as two tables: the vectors' nearest centroids, and the floors of the means."""
    parts = [f"""
        WITH kept AS MATERIALIZED (
                 SELECT vec_id, row_number() OVER (ORDER BY vec_id) AS row, embedding FROM embeddings
                 WHERE len(embedding) = {dims} AND len(list_filter(embedding, lambda x: x IS NOT NULL AND isfinite(x))) = {dims}),
             v AS MATERIALIZED (
                 SELECT row, unnest(range(0, {dims})) AS d, floor(1024 * unnest(embedding)::DOUBLE)::BIGINT AS x FROM kept),
             starts AS (SELECT row, row_number() OVER (ORDER BY sha256('3:' || vec_id)) - 1 AS c FROM kept
                        ORDER BY sha256('3:' || vec_id) LIMIT {clusters}),
             c0 AS MATERIALIZED (SELECT c, d, x AS m FROM v JOIN starts ON v.row = starts.row)"""]
    for k in range(rounds + 1):
        parts.append(f"""
             a{k} AS MATERIALIZED (
                 SELECT row, c, distance FROM (SELECT row, c, sum((x - m) * (x - m))::BIGINT AS distance
                                               FROM v JOIN c{k} ON v.d = c{k}.d GROUP BY row, c)
                 QUALIFY row_number() OVER (PARTITION BY row ORDER BY distance, c) = 1)""")
        if k < rounds:
            parts.append(f"""
             c{k + 1} AS MATERIALIZED (
                 SELECT o.c, o.d, coalesce((s - ((s % n) + n) % n) // n, o.m) AS m FROM c{k} o
                 LEFT JOIN (SELECT c, d, sum(x) AS s, count(*) AS n FROM v JOIN a{k} ON v.row = a{k}.row GROUP BY c, d) t
                 ON o.c = t.c AND o.d = t.d)""")
    last = f"a{rounds}"
    return ",".join(parts) + f"""
        SELECT vec_id, {last}.c::INTEGER AS cluster, distance, (sum(distance) OVER (PARTITION BY {last}.c))::BIGINT AS cluster_inertia,
               (sum(distance) OVER ())::BIGINT AS inertia, h AS centroid_sha256
        FROM {last} JOIN kept ON {last}.row = kept.row
        JOIN (SELECT c, sha256(string_agg(m::BIGINT::VARCHAR, ',' ORDER BY d)) AS h FROM c{rounds} GROUP BY c) s ON {last}.c = s.c"""


def _mixing(block: int = 128, shard: int = 4096, unit: int = 1 << 20, rounds: int = 16) -> str:
    """Targets in closed form: sources by their bound over their weight, those at their bound first. A round of the
    permutation is a table of its own."""
    parts = [rf"""
        WITH docs AS MATERIALIZED (
                 SELECT doc_id, source, len(regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+'))::BIGINT AS size,
                        row_number() OVER () AS row FROM documents),
             counted AS (SELECT source, sum(size)::BIGINT AS size FROM docs GROUP BY source),
             numbered AS (SELECT *, row_number() OVER (ORDER BY source IS NULL, source) - 1 AS number FROM counted),
             weighed AS (SELECT *, [3, 1, 2][number % 3 + 1] AS w, (size + {block - 1}) // {block} AS blocks, (SELECT sum(size) FROM counted) AS whole
                         FROM numbered),
             stepped AS (SELECT *, coalesce(sum(2 * size) OVER (ORDER BY 2.0 * size / w, number ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS earlier,
                                sum(w) OVER (ORDER BY 2.0 * size / w, number ROWS BETWEEN CURRENT ROW AND UNBOUNDED FOLLOWING) AS open FROM weighed),
             bounded AS (SELECT *, 4 * size * open < w * (3 * whole - 2 * earlier) AS capped FROM stepped),
             level AS (SELECT coalesce(sum(2 * size) FILTER (WHERE capped), 0)::HUGEINT AS taken, coalesce(sum(w) FILTER (WHERE NOT capped), 1)::HUGEINT AS open FROM bounded),
             aimed AS (SELECT b.*, CASE WHEN capped THEN (2 * size)::DOUBLE
                                        ELSE (w * (3 * whole - 2 * level.taken))::DOUBLE / (2 * level.open)::DOUBLE END AS target,
                              CASE WHEN size = 0 THEN 0 WHEN capped THEN 2 * blocks * {unit}
                                   ELSE least(w * (3 * whole - 2 * level.taken) * blocks * {unit} // (size * 2 * level.open), 2 * blocks * {unit}) END::HUGEINT AS expected
                       FROM bounded b, level),
             k AS (SELECT greatest((sum(expected) + {shard * unit - 1}) // {shard * unit}, 1)::BIGINT AS shards, sum(expected) > 0 AS filled FROM aimed),
             given AS (SELECT a.*, shards, (expected // (shards * {unit}))::BIGINT AS given FROM aimed a, k),
             plan AS MATERIALIZED (SELECT *, ((expected - given::HUGEINT * shards * {unit}) // shards)::BIGINT AS tickets FROM given),
             leftover AS (SELECT (any_value(shards) * sum(tickets) + {unit // 2}) // {unit} AS left_over, sum(tickets) AS tickets, any_value(shards) AS shards FROM plan),
             draws AS (SELECT shard, unnest(range(1, ((shard + 1) * left_over // k.shards - shard * left_over // k.shards + 1)::BIGINT)) AS draw, tickets
                       FROM leftover, k, unnest(range(0, k.shards)) AS u(shard) WHERE filled),
             drawn AS (SELECT shard, draw, (('0x' || substr(md5('mix:draw:' || shard || ':' || draw), 1, 12))::BIGINT % tickets)::BIGINT AS ticket
                       FROM draws WHERE tickets > 0),
             ranges AS (SELECT number, sum(tickets) OVER (ORDER BY number) - tickets AS low, sum(tickets) OVER (ORDER BY number) AS high FROM plan WHERE tickets > 0),
             extra AS (SELECT number, count(*) AS n FROM drawn JOIN ranges ON ticket >= low AND ticket < high GROUP BY number),
             slots AS (SELECT p.number, p.blocks, unnest(range(0, least(given * p.shards + coalesce(n, 0), 2 * p.blocks)::BIGINT)) AS i
                       FROM plan p LEFT JOIN extra e ON p.number = e.number, k WHERE filled),
             x0 AS (SELECT number, blocks, i // blocks AS turn, i % blocks AS x FROM slots)"""]
    for r in range(1, rounds + 1):
        parts.append(f"""
             o{r} AS (SELECT *, ((('0x' || substr(md5('mix:' || number || ':' || turn || ':{r}'), 1, 12))::BIGINT % blocks - x) % blocks + blocks) % blocks AS o
                     FROM x{r - 1}),
             x{r} AS (SELECT number, blocks, turn, CASE WHEN substr(md5('mix:' || number || ':' || turn || ':{r}:' || greatest(x, o)), 1, 1) < '8'
                                                       THEN o ELSE x END AS x FROM o{r})""")
    return ",".join(parts) + f""",
             times AS MATERIALIZED (SELECT number, x AS block, count(*) AS times FROM x{rounds} GROUP BY ALL),
             places AS (SELECT d.*, p.number, p.target, p.size AS source_size,
                               sum(d.size) OVER (PARTITION BY p.number ORDER BY d.doc_id NULLS FIRST, d.size, d.row ROWS UNBOUNDED PRECEDING) - d.size AS pos
                        FROM docs d JOIN plan p ON d.source IS NOT DISTINCT FROM p.source),
             pieces AS (SELECT row, number, pos, size, unnest(range((pos // {block})::BIGINT, ((pos + size - 1) // {block} + 1)::BIGINT)) AS block FROM places WHERE size > 0),
             taken AS (SELECT row, sum((least(pos + size, (p.block + 1) * {block}) - greatest(pos, p.block * {block})) * times) AS taken
                       FROM pieces p JOIN times t ON p.number = t.number AND p.block = t.block GROUP BY row)
        SELECT doc_id, size, source_size, target, coalesce(taken, 0)::BIGINT AS taken FROM places LEFT JOIN taken ON places.row = taken.row"""


ORACLES = {
    "op7_exact_dedup": rf"""
        WITH t AS (SELECT doc_id, length(coalesce(text, '')) AS points,
                          sha256(regexp_replace(coalesce(text, ''), '{_SPACE}', '', 'g')) AS h FROM documents),
             k AS (SELECT doc_id, h, first_value(doc_id) OVER (PARTITION BY h ORDER BY points DESC, doc_id) AS keep_id,
                          count(*) OVER (PARTITION BY h) AS group_size FROM t)
        SELECT doc_id, keep_id, group_size, doc_id = keep_id AS kept, h AS text_sha256 FROM k""",
    "op8_line_dedup": rf"""
        WITH l AS (SELECT doc_id, unnest(string_split(coalesce(text, ''), chr(10))) AS line,
                          generate_subscripts(string_split(coalesce(text, ''), chr(10)), 1) AS i FROM documents),
             k AS (SELECT *, translate(regexp_replace(regexp_replace(line, '^{_SPACE}+', ''), '{_SPACE}+$', ''),
                          'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS key FROM l),
             c AS (SELECT key, max(doc_id) AS last_doc FROM k WHERE length(key) >= 20 GROUP BY key
                   HAVING count(DISTINCT doc_id) >= 3),
             d AS (SELECT k.doc_id, k.i, k.line, coalesce(k.doc_id < c.last_doc, false) AS gone
                   FROM k LEFT JOIN c ON k.key = c.key)
        SELECT doc_id, count(*) AS n_lines, count(*) FILTER (WHERE gone) AS n_dropped,
               sha256(coalesce(string_agg(line, chr(10) ORDER BY i) FILTER (WHERE NOT gone), '')) AS kept_sha256
        FROM d GROUP BY doc_id""",
    "op2_substring_dedup": rf"""
        WITH w AS (SELECT doc_id, list_filter(string_split_regex(coalesce(text, ''), '{_SPACE}+'), lambda x: x <> '') AS ws
                   FROM documents),
             g AS (SELECT doc_id, unnest(range(1, len(ws) - 48)) AS i, ws FROM w WHERE len(ws) >= 50),
             h AS (SELECT doc_id, i, hash(ws[i:i + 49]) AS h1, hash(ws[i + 1:i + 49]) AS h2 FROM g),
             f AS (SELECT h1, h2, min(doc_id) AS first FROM h GROUP BY h1, h2),
             r AS (SELECT DISTINCT h.doc_id, unnest(range(h.i, h.i + 50)) AS j FROM h JOIN f USING (h1, h2)
                   WHERE f.first < h.doc_id),
             a AS (SELECT doc_id, unnest(ws) AS word, generate_subscripts(ws, 1) AS j FROM w),
             k AS (SELECT a.doc_id, a.j, a.word, r.j IS NOT NULL AS gone FROM a LEFT JOIN r
                   ON a.doc_id = r.doc_id AND a.j = r.j),
             s AS (SELECT doc_id, count(*) FILTER (WHERE gone) AS n_removed,
                          string_agg(word, ' ' ORDER BY j) FILTER (WHERE NOT gone) AS kept FROM k GROUP BY doc_id)
        SELECT w.doc_id, len(w.ws) AS n_words, coalesce(s.n_removed, 0) AS n_removed,
               sha256(coalesce(s.kept, '')) AS kept_sha256 FROM w LEFT JOIN s ON w.doc_id = s.doc_id""",
    "op6_ngram_jaccard": rf"""
        WITH RECURSIVE w AS (
                 SELECT doc_id, list_filter(string_split_regex(translate(coalesce(text, ''),
                        'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '{_SPACE}+'), lambda x: x <> '') AS ws
                 FROM documents),
             s AS (SELECT doc_id, list_sort(list_distinct(CASE
                        WHEN len(ws) >= 3 THEN list_transform(range(1, len(ws) - 1),
                                                              lambda i: ws[i] || ' ' || ws[i + 1] || ' ' || ws[i + 2])
                        WHEN len(ws) > 0 THEN [array_to_string(ws, ' ')] ELSE [] END)) AS grams FROM w),
             e AS (SELECT doc_id, len(grams) AS n, min(doc_id) OVER (PARTITION BY grams) AS rep FROM s),
             g AS (SELECT s.doc_id, e.n, unnest(s.grams) AS gram FROM s JOIN e ON s.doc_id = e.doc_id
                   WHERE e.rep = s.doc_id),
             p AS (SELECT a.doc_id AS a, b.doc_id AS b FROM g a JOIN g b ON a.gram = b.gram AND a.doc_id < b.doc_id
                        AND 100 * least(a.n, b.n) >= 90 * greatest(a.n, b.n)
                   GROUP BY a.doc_id, b.doc_id, a.n, b.n HAVING 100 * count(*) >= 90 * (a.n + b.n - count(*))),
             l AS (SELECT a, b FROM p UNION ALL SELECT b, a FROM p),
             c(id, reached) AS (SELECT doc_id, doc_id FROM e WHERE rep = doc_id
                                UNION SELECT c.id, l.b FROM c JOIN l ON c.reached = l.a),
             m AS (SELECT id, min(reached) AS component FROM c GROUP BY id)
        SELECT e.doc_id, e.n AS n_shingles, CASE WHEN e.n = 0 THEN e.doc_id ELSE m.component END AS component_id
        FROM e JOIN m ON e.rep = m.id""",
    "op11_source_mixing": _mixing(),
    "op12_centroid_clustering": _clustering(),
    "op13_phrase_collocations": r"""
        WITH t AS (SELECT coalesce(lang, 'und') AS lang, string_split_regex(translate(coalesce(text, ''),
                          'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[.,;:!?\x0A-\x0D]') AS pieces
                   FROM documents),
             p AS (SELECT lang, list_filter(string_split_regex(piece, '[\x20\x09]+'), lambda x: x <> '') AS ws
                   FROM (SELECT lang, unnest(pieces) AS piece FROM t)),
             n AS (SELECT lang, sum(len(ws))::BIGINT AS n FROM p GROUP BY lang),
             g AS (SELECT lang, ws, k, unnest(range(1, len(ws) - k + 2)) AS i FROM p, range(1, 6) AS sizes(k)
                   WHERE len(ws) >= k),
             f AS (SELECT lang, array_to_string(ws[i:i + k - 1], ' ') AS phrase, k, count(*) AS f FROM g
                   GROUP BY ALL HAVING count(*) >= 100),
             c AS (SELECT *, string_split(phrase, ' ') AS ws FROM f WHERE k > 1),
             i AS (SELECT lang, array_to_string(ws[s:s + m - 1], ' ') AS phrase, max(f) AS longer
                   FROM (SELECT lang, ws, f, k, m, unnest(range(1, k - m + 2)) AS s FROM c, range(2, 5) AS lens(m) WHERE m < k)
                   GROUP BY ALL),
             d AS (SELECT c.* FROM c LEFT JOIN i ON c.lang = i.lang AND c.phrase = i.phrase
                   WHERE i.longer IS NULL OR 100 * i.longer < 100 * c.f),
             u AS (SELECT lang, phrase, f AS a, j, array_to_string(ws[1:j], ' ') AS head, array_to_string(ws[j + 1:k], ' ') AS tail
                   FROM (SELECT *, unnest(range(1, k)) AS j FROM d)),
             q AS (SELECT u.lang, u.phrase, u.a, x.f AS l, y.f AS r, n.n, j,
                          (1000::HUGEINT * u.a * n.n // (x.f::HUGEINT * y.f))::BIGINT AS score
                   FROM u JOIN f x ON u.lang = x.lang AND u.head = x.phrase JOIN f y ON u.lang = y.lang AND u.tail = y.phrase
                   JOIN n ON u.lang = n.lang),
             b AS (SELECT * FROM q QUALIFY row_number() OVER (PARTITION BY lang, phrase ORDER BY score, j) = 1),
             o AS (SELECT *, row_number() OVER (PARTITION BY lang ORDER BY score DESC, a DESC, phrase) AS rank FROM b)
        SELECT lang, rank, phrase, a, l, r, n, score FROM o WHERE rank <= 2000""",
}

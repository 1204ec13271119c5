"""DuckDB SQL of the corpus queries that SQL can express."""

LOWER = "translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz')"

WORDS = "[^\\x00-\\x2F\\x3A-\\x60\\x7B-\\x7F]+"

SQL: dict[str, str] = {
    "op2_decontamination": f"""
        WITH doc AS (SELECT doc_id, regexp_extract_all({LOWER}, '{WORDS}') AS w FROM documents),
        item AS (SELECT CAST(item_id AS VARCHAR) AS item_id, regexp_extract_all({LOWER}, '{WORDS}') AS w FROM benchmark),
        cut AS (SELECT item_id, least(len(w), 10) AS k, list_slice(w, i, i + least(len(w), 10) - 1) AS win
            FROM (SELECT item_id, w, unnest(range(1, greatest(len(w) - 9, 1) + 1)) AS i FROM item WHERE len(w) > 0)),
        sizes AS (SELECT DISTINCT k FROM cut),
        here AS (SELECT doc_id, i, k, list_slice(w, i, i + k - 1) AS win
            FROM (SELECT doc_id, w, k, unnest(range(1, len(w) - k + 2)) AS i FROM doc, sizes WHERE len(w) >= k)),
        hit AS (SELECT doc_id, i, here.k, item_id FROM here JOIN cut ON here.k = cut.k AND here.win = cut.win),
        covered AS (SELECT doc_id, count(DISTINCT p) AS n_hit
            FROM (SELECT doc_id, unnest(range(i, i + k)) AS p FROM (SELECT DISTINCT doc_id, i, k FROM hit)) GROUP BY doc_id),
        found AS (SELECT doc_id, count(*) AS n_items, string_agg(item_id, ',' ORDER BY item_id) AS ids
            FROM (SELECT DISTINCT doc_id, item_id FROM hit) GROUP BY doc_id)
        SELECT doc_id, CAST(len(w) AS BIGINT) AS n_words, coalesce(n_hit, 0) AS n_hit, coalesce(n_items, 0) AS n_items,
            sha256(coalesce(ids, '')) AS items_sha256, coalesce(n_hit, 0) > 0 AS contaminated
        FROM doc LEFT JOIN covered USING (doc_id) LEFT JOIN found USING (doc_id)""",
    "op3_warc": r"""
        WITH page AS (SELECT page_id, coalesce(url, '') AS url, coalesce(html, '') AS payload FROM pages),
        first AS (SELECT payload, min(page_id) AS first_id FROM page WHERE strlen(payload) >= 100 GROUP BY payload),
        part AS (SELECT *, lower(regexp_extract(url, '^[A-Za-z][A-Za-z0-9+.\-]*://(?:[^/?#@]*@)?(?:www\.)?([^/?#:]*)', 1)) AS host,
            regexp_extract(url, '^[A-Za-z][A-Za-z0-9+.\-]*://[^/?#]*([^#]*)', 1) AS rest FROM page)
        SELECT page_id, strlen(payload) AS payload_bytes, sha256(payload) AS payload_digest,
            CASE WHEN first_id <> page_id THEN 'revisit' ELSE 'response' END AS record_type,
            CASE WHEN first_id <> page_id THEN first_id END AS refers_to,
            CASE WHEN regexp_matches(url, '^[A-Za-z][A-Za-z0-9+.\-]*://')
                THEN array_to_string(list_reverse(string_split(host, '.')), ',') || ')' || CASE WHEN rest = '' THEN '/' ELSE rest END
                ELSE url END AS url_key,
            strftime(make_timestamp(1000000 * (1700000000 + page_id)), '%Y-%m-%dT%H:%M:%SZ') AS captured
        FROM part LEFT JOIN first USING (payload)""",
    "op8_exact_dedup": f"""
        WITH texts AS (SELECT doc_id, {LOWER} AS norm FROM documents),
        groups AS (SELECT norm, max(doc_id) AS keep_id, count(*) AS group_size FROM texts GROUP BY norm)
        SELECT doc_id, keep_id, group_size, doc_id IS NOT DISTINCT FROM keep_id AS kept, sha256(norm) AS text_sha256
        FROM texts JOIN groups USING (norm)""",
    "op12_periodic_runs": r"""
        WITH crc_table AS (SELECT list(e ORDER BY i) AS t FROM (SELECT i, list_reduce(list_prepend(i, [0, 0, 0, 0, 0, 0, 0, 0]),
            lambda c, x: CASE WHEN c & 1 = 1 THEN xor(c >> 1, 3988292384) ELSE c >> 1 END) AS e FROM range(256) AS r(i))),
        word AS (SELECT row_number() OVER () AS r, doc_id, regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+') AS w,
            CAST(doc_id AS VARCHAR) AS d FROM documents),
        hashed AS (SELECT r, doc_id, w, len(w) AS n, xor(list_reduce(list_prepend(4294967295, list_transform(range(1, len(d) + 1), lambda k: CAST(ascii(d[k]) AS BIGINT))),
            lambda c, x: xor(c >> 8, t[(xor(c, x) & 255) + 1])), 4294967295) AS h FROM word, crc_table),
        tail AS (SELECT *, CASE WHEN h % 10 = 0 AND n > 0 THEN (h // 10) % n END AS a FROM hashed),
        step AS (SELECT *, 1 + (n - a) // (3 + (h // 10) % 8) AS p FROM tail),
        seq AS (SELECT r, doc_id, n, CASE WHEN a IS NULL THEN w
            ELSE list_transform(range(0, n), lambda i: w[1 + CASE WHEN i < a THEN i ELSE a + (i - a) % p END]) END AS w FROM step),
        -- a run of period q holds a multiple of q among its first q words, where three equal periods start
        seed AS (SELECT DISTINCT r, q FROM (SELECT r, w, q, unnest(range(1, n - 3 * q + 2, q)) AS i FROM (SELECT r, w, n, unnest(range(1, n // 4 + 1)) AS q FROM seq))
            WHERE w[i] = w[i + q] AND w[i + q - 1] = w[i + 2 * q - 1] AND w[i] = w[i + 2 * q] AND w[i:i + 2 * q - 1] = w[i + q:i + 3 * q - 1]),
        agree AS (SELECT r, q, i, i - row_number() OVER (PARTITION BY r, q ORDER BY i) AS line
            FROM (SELECT r, q, w, unnest(range(1, n - q + 1)) AS i FROM seed JOIN seq USING (r)) WHERE w[i] = w[i + q]),
        stretch AS (SELECT r, q, min(i) - 1 AS start, count(*) + q AS length FROM agree GROUP BY r, q, line HAVING count(*) + q >= greatest(6, 4 * q)),
        run AS (SELECT r, start, length, min(q) AS period FROM stretch GROUP BY r, start, length),
        gone AS (SELECT DISTINCT r, unnest(range(start + period, start + length)) AS i FROM run),
        kept AS (SELECT r, string_agg(x, ' ' ORDER BY i) AS text FROM (SELECT r, unnest(w) AS x, unnest(range(0, n)) AS i FROM seq WHERE r IN (SELECT r FROM run))
            ANTI JOIN gone USING (r, i) GROUP BY r),
        told AS (SELECT r, count(*) AS n_runs, first(run ORDER BY length / period DESC, start, period) AS best,
            string_agg(start || ',' || length || ',' || period || chr(10), '' ORDER BY start, period) AS lines FROM run GROUP BY r)
        SELECT doc_id, coalesce(n_runs, 0) AS n_runs, best.start AS start, best.length AS length, best.period AS period,
            1000 * best.length // best.period AS exponent_milli, sha256(coalesce(lines, '')) AS runs_sha256,
            sha256(CASE WHEN n_runs IS NULL THEN array_to_string(w, ' ') ELSE coalesce(kept.text, '') END) AS collapsed_sha256, CAST(n AS BIGINT) AS n_words
        FROM seq LEFT JOIN told USING (r) LEFT JOIN kept USING (r)""",
    "op11_ranked_search": f"""
        WITH doc AS (SELECT row_number() OVER () AS r, doc_id, w, len(w) AS n
            FROM (SELECT doc_id, regexp_extract_all({LOWER}, '{WORDS}') AS w FROM documents) WHERE len(w) > 0),
        total AS (SELECT count(*) AS d, CAST(sum(n) AS BIGINT) AS l FROM doc),
        query AS (SELECT DISTINCT item_id, t FROM (SELECT item_id, unnest(regexp_extract_all({LOWER}, '{WORDS}')) AS t FROM benchmark)),
        posting AS (SELECT r, doc_id, n, t, count(*) AS tf FROM (SELECT r, doc_id, n, unnest(w) AS t FROM doc)
            WHERE t IN (SELECT t FROM query) GROUP BY ALL),
        term AS (SELECT t, CAST(floor(1000 * ln((2 * d + 2) / (2 * count(*) + 1))) AS BIGINT) AS w FROM posting, total GROUP BY t, d),
        scored AS (SELECT item_id, r, doc_id,
                CAST(sum(w * ((1000000000 * tf) // (1000 * tf + 8 * (10 + (90 * n * d) // l)))) AS BIGINT) AS score
            FROM query JOIN posting USING (t) JOIN term USING (t), total GROUP BY item_id, r, doc_id),
        ranked AS (SELECT *, row_number() OVER (PARTITION BY item_id ORDER BY score DESC, doc_id) AS rank FROM scored WHERE score > 0)
        SELECT item_id, CAST(rank AS INTEGER) AS rank, doc_id, score FROM ranked WHERE rank <= 10""",
    "op13_minhash_dedup": f"""
        WITH RECURSIVE doc AS (SELECT row_number() OVER () AS r, doc_id, regexp_extract_all({LOWER}, '[^\\x20\\x09-\\x0D]+') AS w FROM documents),
        shingle AS (SELECT DISTINCT r, array_to_string(w[i:i + 2], ' ') AS s
            FROM (SELECT r, w, unnest(range(1, greatest(len(w) - 2, 1) + 1)) AS i FROM doc WHERE len(w) > 0)),
        size AS (SELECT r, count(*) AS n FROM shingle GROUP BY r),
        common AS (SELECT x.r AS a, y.r AS b, count(*) AS c FROM shingle x JOIN shingle y ON x.s = y.s AND x.r < y.r GROUP BY ALL),
        link AS (SELECT a, b FROM common JOIN size x ON x.r = a JOIN size y ON y.r = b WHERE 100 * c >= 85 * (x.n + y.n - c)),
        edge AS (SELECT a, b FROM link UNION ALL SELECT b, a FROM link),
        reach AS (SELECT r AS a, r AS b FROM doc UNION SELECT reach.a, edge.b FROM reach JOIN edge ON reach.b = edge.a),
        least AS (SELECT reach.a AS r, min(doc.doc_id) AS component_id FROM reach JOIN doc ON doc.r = reach.b GROUP BY reach.a)
        SELECT doc_id, coalesce(n, 0) AS n_shingles, component_id, doc_id IS NOT DISTINCT FROM component_id AS kept
        FROM doc JOIN least USING (r) LEFT JOIN size USING (r)""",
}

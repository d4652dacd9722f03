"""SQL for those queries whose result another engine can compute."""

from __future__ import annotations

# Labels spread along links until nothing changes; {edges} has both directions.
_COMPONENTS = """
    reach(a, b) AS (
        SELECT a, b FROM {edges}
        UNION
        SELECT reach.a, e.b FROM reach JOIN {edges} e ON reach.b = e.a),
    roots AS (SELECT a, min(b) AS root FROM reach GROUP BY a)"""

_VECTORS = f"""
    WITH RECURSIVE v AS (
        SELECT vec_id, embedding::DOUBLE[] AS x FROM embeddings
        WHERE list_sum([abs(e) FOR e IN embedding]) > 0),
    edges AS MATERIALIZED (
        SELECT p.vec_id AS a, q.vec_id AS b FROM v p JOIN v q ON p.vec_id <> q.vec_id
        WHERE list_cosine_similarity(p.x, q.x) >= 0.9),
    counts AS (SELECT a, count(*) AS n FROM edges GROUP BY a),
    {_COMPONENTS.format(edges="edges")}
    SELECT vec_id, coalesce(n, 0) AS n_links,
           least(vec_id, coalesce(root, vec_id)) AS component_id,
           vec_id <= coalesce(root, vec_id) AS kept
    FROM embeddings LEFT JOIN counts ON vec_id = counts.a LEFT JOIN roots ON vec_id = roots.a"""

_QUALITY = r"""
    WITH base AS (
        SELECT row_number() OVER () AS r, doc_id, lang, source, coalesce(text, '') AS t
        FROM documents),
    words AS (
        SELECT r, regexp_extract_all(t, '[^\x20\x09-\x0D]+') AS w,
               regexp_extract_all(t, '[#*$%&|<>]') AS s
        FROM base),
    starts AS (SELECT r, w, unnest(range(1, len(w) - 3)) AS i FROM words WHERE len(w) >= 5),
    windows AS (SELECT r, i, w[i:i + 4] AS g FROM starts),
    again AS (SELECT r, g FROM windows GROUP BY r, g HAVING count(*) >= 2),
    covered AS (
        SELECT r, count(DISTINCT p) AS n FROM (
            SELECT r, unnest(range(i, i + 5)) AS p FROM windows JOIN again USING (r, g))
        GROUP BY r),
    lines AS (
        SELECT r, count(*) AS n_lines, count(*) - count(DISTINCT line) AS n_dup FROM (
            SELECT r, unnest(string_split(t, chr(10))) AS line FROM base)
        WHERE regexp_matches(line, '[^\x20\x09-\x0D]') GROUP BY r),
    counts AS (
        SELECT r, doc_id, lang, source, len(w) AS n_words,
               length(array_to_string(w, '')) AS word_chars, len(s) AS n_symbols,
               coalesce(n_dup, 0) AS n_dup_lines, coalesce(covered.n, 0) AS n_repeat_words,
               coalesce(n_lines, 0) AS n_lines
        FROM base JOIN words USING (r) LEFT JOIN lines USING (r) LEFT JOIN covered USING (r)),
    rates AS (
        SELECT *, n_words < 10 OR 100 * n_repeat_words > 20 * n_words AS base_failed,
               word_chars * 100 // greatest(n_words, 1) AS word_length,
               n_symbols * 1000 // greatest(n_words, 1) AS symbols,
               n_dup_lines * 1000 // greatest(n_lines, 1) AS dup_lines,
               n_repeat_words * 1000 // greatest(n_words, 1) AS repeat_words
        FROM counts),
    long AS (
        SELECT lang, source, rate, value FROM rates
        UNPIVOT (value FOR rate IN (word_length, symbols, dup_lines, repeat_words))
        WHERE NOT base_failed),
    leveled AS (
        SELECT 0 AS level, lang, source, rate, value FROM long
        UNION ALL SELECT 1, lang, NULL, rate, value FROM long
        UNION ALL SELECT 2, NULL, NULL, rate, value FROM long),
    sketch AS (
        SELECT level, lang, source, rate, count(*) AS n, max(value) AS value,
               CASE WHEN value <= 0 THEN 0 ELSE 1 + floor(ln(value) / ln(1.02)) END AS bucket
        FROM leveled
        GROUP BY level, lang, source, rate,
                 CASE WHEN value <= 0 THEN 0 ELSE 1 + floor(ln(value) / ln(1.02)) END),
    ranked AS (
        SELECT *, sum(n) OVER (PARTITION BY level, lang, source, rate) AS total,
               sum(n) OVER (PARTITION BY level, lang, source, rate ORDER BY bucket) AS upto
        FROM sketch),
    quartiles AS (
        SELECT level, lang, source, rate, max(total) AS n,
               min(CASE WHEN upto * 4 >= total THEN value END) AS q1,
               min(CASE WHEN upto * 4 >= total * 3 THEN value END) AS q3
        FROM ranked GROUP BY level, lang, source, rate),
    spreads AS (
        SELECT *, 3 * greatest(q3 - q1, CASE rate WHEN 'dup_lines' THEN 100
                                        WHEN 'repeat_words' THEN 60 ELSE 50 END) AS reach
        FROM quartiles),
    fences AS (
        SELECT level, lang, source, max(n) AS n,
               max(CASE WHEN rate = 'word_length' THEN q1 - reach END) AS wl_low,
               max(CASE WHEN rate = 'word_length' THEN q3 + reach END) AS wl_high,
               max(CASE WHEN rate = 'symbols' THEN q3 + reach END) AS s_high,
               max(CASE WHEN rate = 'dup_lines' THEN q3 + reach END) AS d_high,
               max(CASE WHEN rate = 'repeat_words' THEN q3 + reach END) AS r_high
        FROM spreads GROUP BY level, lang, source),
    chosen AS (
        SELECT r, arg_min(f, f.level) AS f
        FROM rates JOIN fences f ON
            (f.level = 0 AND f.n >= 50 AND f.lang IS NOT DISTINCT FROM rates.lang
                AND f.source IS NOT DISTINCT FROM rates.source)
            OR (f.level = 1 AND f.n >= 50 AND f.lang IS NOT DISTINCT FROM rates.lang)
            OR f.level = 2
        GROUP BY r)
    SELECT doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, base_failed,
           NOT base_failed AND coalesce(
               word_length BETWEEN f.wl_low AND f.wl_high AND symbols BETWEEN 0 AND f.s_high
               AND dup_lines BETWEEN 0 AND f.d_high
               AND repeat_words BETWEEN 0 AND f.r_high, true) AS kept
    FROM rates LEFT JOIN chosen USING (r)"""

_DOCUMENTS = rf"""
    WITH RECURSIVE words AS (
        SELECT doc_id, regexp_extract_all(
            translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
            '[^\x20\x09-\x0D]+') AS w
        FROM documents),
    shingles AS MATERIALIZED (
        SELECT DISTINCT doc_id, array_to_string(w[i:i + 2], ' ') AS s
        FROM (SELECT doc_id, w, unnest(range(1, greatest(len(w) - 1, 2))) AS i
              FROM words WHERE len(w) > 0)),
    sizes AS (SELECT doc_id, count(*) AS n FROM shingles GROUP BY doc_id),
    both_have AS (
        SELECT p.doc_id AS a, q.doc_id AS b, count(*) AS n
        FROM shingles p JOIN shingles q ON p.s = q.s AND p.doc_id <> q.doc_id
        GROUP BY p.doc_id, q.doc_id),
    edges AS MATERIALIZED (
        SELECT a, b FROM both_have JOIN sizes x ON a = x.doc_id JOIN sizes y ON b = y.doc_id
        WHERE 100 * both_have.n >= 85 * (x.n + y.n - both_have.n)),
    {_COMPONENTS.format(edges="edges")}
    SELECT words.doc_id, coalesce(n, 0) AS n_shingles,
           least(words.doc_id, coalesce(root, words.doc_id)) AS component_id,
           words.doc_id <= coalesce(root, words.doc_id) AS kept
    FROM words LEFT JOIN sizes USING (doc_id) LEFT JOIN roots ON words.doc_id = roots.a"""

# Terms of bytes from 0x80 on are those of all characters beyond ASCII.
_TERMS = r"[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+"
_LOW = "translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz')"

_SEARCH = rf"""
    WITH words AS (
        SELECT row_number() OVER () AS d, doc_id, regexp_extract_all({_LOW}, '{_TERMS}') AS w
        FROM documents),
    docs AS (SELECT d, doc_id, len(w) AS n FROM words WHERE len(w) > 0),
    totals AS (SELECT count(*) AS n_docs, sum(n)::BIGINT AS n_terms FROM docs),
    asked AS (
        SELECT item_id, t, count(*) AS times FROM (
            SELECT item_id, unnest(regexp_extract_all({_LOW}, '{_TERMS}')) AS t FROM benchmark)
        GROUP BY item_id, t),
    postings AS MATERIALIZED (
        SELECT d, t, count(*) AS tf FROM (SELECT d, unnest(w) AS t FROM words)
        WHERE t IN (SELECT t FROM asked) GROUP BY d, t),
    weights AS (
        SELECT t, floor(1000 * ln((2 * n_docs + 2) / (2 * count(*) + 1)))::BIGINT AS w
        FROM postings, totals GROUP BY t, n_docs),
    scores AS (
        SELECT item_id, doc_id, d, sum(
            times * w * ((1000000000 * tf) // (1000 * tf + 12 * (75 + 25 * n * n_docs // n_terms)))
            )::BIGINT AS score
        FROM asked JOIN postings USING (t) JOIN weights USING (t) JOIN docs USING (d), totals
        GROUP BY item_id, doc_id, d),
    ranked AS (
        SELECT *, row_number() OVER (
            PARTITION BY item_id ORDER BY score DESC, doc_id)::INTEGER AS rank
        FROM scores WHERE score > 0)
    SELECT item_id, rank, doc_id, score FROM ranked WHERE rank <= 20"""

# A checksum byte by byte over the 256 values that a byte's eight steps give.
_SPELLING = rf"""
    WITH RECURSIVE steps AS (
        SELECT list(c ORDER BY i) AS t FROM (
            SELECT i, list_reduce([i, 0, 0, 0, 0, 0, 0, 0, 0], lambda c, x:
                CASE WHEN c & 1 = 1 THEN xor(c >> 1, 3988292384) ELSE c >> 1 END) AS c
            FROM range(256) AS r(i))),
    runs AS (
        SELECT doc_id, run, count(*) AS n FROM (
            SELECT doc_id, unnest(regexp_extract_all({_LOW}, '[a-z\x{{00C0}}-\x{{00FF}}]+')) AS run
            FROM documents)
        WHERE length(run) >= 6 GROUP BY doc_id, run),
    hexed AS (
        SELECT run, n, hex(encode(coalesce(doc_id::VARCHAR, '') || ':' || run)) AS x FROM runs),
    hashed AS (
        SELECT run, n, xor(list_reduce(list_prepend(4294967295,
            [(instr('0123456789ABCDEF', x[2 * i + 1]) - 1) * 16
             + instr('0123456789ABCDEF', x[2 * i + 2]) - 1 FOR i IN range(length(x) // 2)]),
            lambda c, b: xor(c >> 8, t[(xor(c, b) & 255) + 1])), 4294967295) AS h
        FROM hexed, steps),
    words AS MATERIALIZED (
        SELECT word, sum(n)::BIGINT AS n FROM (
            SELECT n, CASE WHEN h % 199 = 0
                THEN left(run, (h % length(run))::INTEGER) || substr(run, (h % length(run))::INTEGER + 2)
                ELSE run END AS word
            FROM hashed)
        WHERE length(word) >= 6 GROUP BY word HAVING sum(n) >= 5),
    shorter AS MATERIALIZED (
        SELECT DISTINCT word, i, left(word, i - 1) || substr(word, i + 1) AS rest
        FROM (SELECT word, unnest(range(1, length(word) + 1)) AS i FROM words)),
    near AS (
        SELECT a.word, b.word AS near FROM shorter a JOIN shorter b
            ON a.rest = b.rest AND a.i = b.i AND length(a.word) = length(b.word) AND a.word <> b.word
        UNION SELECT a.word, b.word FROM shorter a JOIN words b ON a.rest = b.word
        UNION SELECT b.word, a.word FROM shorter a JOIN words b ON a.rest = b.word),
    best AS (
        SELECT near.word, count(*) AS n_near, max(m.n) AS top_n FROM near JOIN words m ON near = m.word
        GROUP BY near.word),
    forms AS MATERIALIZED (
        SELECT words.word, words.n, coalesce(n_near, 0) AS n_near,
               CASE WHEN top_n >= 5 * words.n THEN top_n END AS form_n,
               CASE WHEN top_n >= 5 * words.n THEN (
                   SELECT min(near) FROM near JOIN words m ON near = m.word
                   WHERE near.word = words.word AND m.n = top_n) END AS form
        FROM words LEFT JOIN best USING (word)),
    chain AS (
        SELECT word, word AS root, 0 AS depth FROM forms
        UNION ALL
        SELECT chain.word, f.form, depth + 1 FROM chain JOIN forms f ON chain.root = f.word
        WHERE f.form IS NOT NULL),
    roots AS (SELECT word, arg_max(root, depth) AS root FROM chain GROUP BY word)
    SELECT word, form, root, n, n_near, form_n FROM forms JOIN roots USING (word)"""

_URLS = r"""
    WITH cut AS (
        SELECT page_id, translate(regexp_extract(u, '^.*?://([^/?#]*)', 1, 's'),
                   'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS host,
               regexp_extract(u, '^.*?://[^/?#]*([^?#]*)', 1, 's') AS path,
               regexp_extract(u, '^.*?://[^?#]*(\?[^#]*)', 1, 's') AS query
        FROM (SELECT page_id, coalesce(url, '') AS u FROM pages)),
    rules(verdict, h, p) AS (
        VALUES ('allow', 'com', '/'), ('block', 'example.com', '/en/'),
               ('allow', 'www.example.com', '/en/'), ('block', 'net', '/es/'),
               ('block', 'net', '/fr/')),
    fits AS (
        SELECT c, arg_max(h || p, length(h || p)) AS rule,
               arg_max(verdict, length(h || p)) AS verdict
        FROM (SELECT DISTINCT {'host': host, 'path': path} AS c FROM cut), rules
        WHERE (c.host = h OR ends_with(c.host, '.' || h)) AND starts_with(c.path, p)
        GROUP BY c),
    seen AS (
        SELECT cut.*, fits.rule, fits.verdict AS said, CASE
            WHEN fits.rule IS NOT NULL THEN NULL
            WHEN regexp_matches(host || path || query, '^[^/?]*\.org/.*\.html$', 's')
                THEN '*.org/**.html'
            WHEN regexp_matches(host || path || query, '^m\.[^/?]*\.org/', 's') THEN 'm.*.org/**'
            WHEN contains(host || path || query, '?page=') THEN '**?page=**' END AS pattern
        FROM cut LEFT JOIN fits ON c.host = cut.host AND c.path = cut.path)
    SELECT page_id, host, path, rule, pattern, CASE
        WHEN rule IS NOT NULL THEN said
        WHEN pattern IN ('m.*.org/**', '**?page=**') THEN 'block' ELSE 'allow' END AS verdict
    FROM seen"""

ORACLE: dict[str, str] = {
    "op3_embedding_dedup": _VECTORS,
    "op4_quality_rules": _QUALITY,
    "op6_minhash_dedup": _DOCUMENTS,
    "op11_search": _SEARCH,
    "op12_spelling": _SPELLING,
    "op13_url_rules": _URLS,
}

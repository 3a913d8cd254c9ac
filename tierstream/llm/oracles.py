"""SQL with the same results, for the operators that SQL can express."""

_WORDS = r"regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+')"
_LOWER = "translate({}, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz')"

ORACLES = {
    "op1_substring_dedup": f"""
        WITH d AS (SELECT doc_id, {_WORDS} AS w FROM documents),
        p AS (SELECT doc_id, len(w) AS n, unnest(w) AS word, generate_subscripts(w, 1) AS i FROM d),
        q AS (SELECT *, string_agg(word, ' ') OVER (PARTITION BY doc_id ORDER BY i
              ROWS BETWEEN CURRENT ROW AND 19 FOLLOWING) AS win FROM p),
        f AS (SELECT *, i + 19 <= n AND row_number() OVER (PARTITION BY i + 19 <= n, win ORDER BY doc_id, i) > 1
              AS again FROM q),
        g AS (SELECT *, bool_or(again) OVER (PARTITION BY doc_id ORDER BY i
              ROWS BETWEEN 19 PRECEDING AND CURRENT ROW) AS gone FROM f),
        h AS (SELECT doc_id, count(*) FILTER (gone) AS n_removed,
              string_agg(word, ' ' ORDER BY i) FILTER (NOT gone) AS kept FROM g GROUP BY doc_id)
        SELECT d.doc_id, CAST(len(w) AS BIGINT) AS n_words, coalesce(n_removed, 0) AS n_removed,
               sha256(coalesce(kept, '')) AS kept_sha256
        FROM d LEFT JOIN h USING (doc_id)""",
    "op3_line_dedup": f"""
        WITH d AS (SELECT doc_id, string_split(coalesce(text, ''), chr(10)) AS l FROM documents),
        p AS (SELECT doc_id, unnest(l) AS line, generate_subscripts(l, 1) AS i FROM d),
        k AS (SELECT *, {_LOWER.format("trim(line, chr(32) || chr(9) || chr(10) || chr(11) || chr(12) || chr(13))")}
              AS key FROM p),
        c AS (SELECT key, max(doc_id) AS last FROM k WHERE length(key) >= 20
              GROUP BY key HAVING count(DISTINCT doc_id) >= 3),
        m AS (SELECT k.doc_id, line, i, c.key IS NOT NULL AND c.last <> k.doc_id AS gone
              FROM k LEFT JOIN c ON c.key = k.key)
        SELECT doc_id, count(*) AS n_lines, count(*) FILTER (gone) AS n_dropped,
               sha256(coalesce(string_agg(line, chr(10) ORDER BY i) FILTER (NOT gone), '')) AS kept_sha256
        FROM m GROUP BY doc_id""",
    "op8_superminhash": f"""
        WITH RECURSIVE d AS (SELECT doc_id, regexp_extract_all({_LOWER.format("coalesce(text, '')")},
              '[^\\x20\\x09-\\x0D]+') AS w FROM documents),
        s AS (SELECT DISTINCT doc_id, array_to_string(w[i : i + 4], ' ') AS shingle
              FROM (SELECT doc_id, w, unnest(range(1, greatest(len(w) - 4, 1) + 1)) AS i FROM d WHERE len(w) > 0)),
        n AS (SELECT doc_id, count(*) AS size FROM s GROUP BY doc_id),
        c AS (SELECT a.doc_id AS x, b.doc_id AS y, count(*) AS common FROM s a JOIN s b USING (shingle)
              WHERE a.doc_id <> b.doc_id GROUP BY ALL),
        e AS (SELECT x, y FROM c JOIN n a ON a.doc_id = x JOIN n b ON b.doc_id = y
              WHERE 100 * common >= 75 * (a.size + b.size - common)),
        r AS (SELECT doc_id, doc_id AS seen FROM d UNION SELECT r.doc_id, e.y FROM r JOIN e ON e.x = r.seen)
        SELECT d.doc_id, coalesce(any_value(n.size), 0) AS n_shingles, min(r.seen) AS component_id,
               min(r.seen) = d.doc_id AS kept
        FROM d JOIN r USING (doc_id) LEFT JOIN n USING (doc_id) GROUP BY d.doc_id""",
    "op12_infill": """
        WITH d AS (SELECT doc_id, coalesce(text, '') AS t, regexp_extract_all(coalesce(text, ''), '[A-Za-z]+|[^A-Za-z]') AS u,
              sha256('1:' || coalesce(CAST(doc_id AS VARCHAR), '')) AS h FROM documents),
        x AS (SELECT *, CAST(len(u) AS BIGINT) AS n, CAST('0x' || substr(h, 1, 8) AS BIGINT) AS h1,
              CAST('0x' || substr(h, 9, 8) AS BIGINT) AS h2, CAST('0x' || substr(h, 17, 8) AS BIGINT) AS h3,
              CAST('0x' || substr(h, 25, 8) AS BIGINT) AS h4 FROM d),
        c AS (SELECT *, least(h1 % (n + 1), h2 % (n + 1)) AS a, greatest(h1 % (n + 1), h2 % (n + 1)) AS b,
              CASE WHEN t = '' OR contains(t, '<P>') OR contains(t, '<S>') OR contains(t, '<M>') OR h3 % 100 >= 90
              THEN 'plain' WHEN h4 % 100 < 20 THEN 'spm' ELSE 'psm' END AS form FROM x),
        p AS (SELECT *, array_to_string(u[1 : a], '') AS pre, array_to_string(u[a + 1 : b], '') AS mid,
              array_to_string(u[b + 1 : n], '') AS suf FROM c)
        SELECT doc_id, n, form, CASE WHEN form <> 'plain' THEN length(pre) END AS prefix_chars,
               CASE WHEN form <> 'plain' THEN length(mid) END AS middle_chars,
               sha256(CASE form WHEN 'plain' THEN t WHEN 'psm' THEN '<P>' || pre || '<S>' || suf || '<M>' || mid
                      ELSE '<S>' || suf || '<P>' || pre || '<M>' || mid END) AS output_sha256,
               sha256(t) AS restored_sha256
        FROM p""",
    "op13_phrases": f"""
        WITH d AS (SELECT row_number() OVER () AS id, coalesce(lang, 'und') AS lang,
              string_split_regex({_LOWER.format("coalesce(text, '')")}, '[.,;:!?\\x0A-\\x0D]') AS p FROM documents),
        s AS (SELECT id, lang, unnest(p) AS piece, generate_subscripts(p, 1) AS k FROM d),
        w AS (SELECT id, lang, k, regexp_extract_all(piece, '[^\\x20\\x09]+') AS v FROM s),
        t AS (SELECT lang, v[i] AS x, v[i + 1] AS y, v[i + 2] AS z
              FROM (SELECT lang, v, unnest(range(1, len(v) + 1)) AS i FROM w)),
        f AS (SELECT lang, 1 AS size, x, NULL AS y, NULL AS z, count(*) AS a FROM t GROUP BY lang, x
              UNION ALL SELECT lang, 2, x, y, NULL, count(*) FROM t WHERE y IS NOT NULL GROUP BY lang, x, y
              UNION ALL SELECT lang, 3, x, y, z, count(*) FROM t WHERE z IS NOT NULL GROUP BY lang, x, y, z),
        o AS (SELECT * FROM f WHERE size = 1), b AS (SELECT * FROM f WHERE size = 2 AND a >= 10),
        r AS (SELECT * FROM f WHERE size = 3 AND a >= 10),
        totals AS (SELECT lang, CAST(sum(a) AS BIGINT) AS n FROM o GROUP BY lang),
        longer AS (SELECT lang, x, y, max(a) AS most FROM (SELECT lang, x, y, a FROM r UNION ALL SELECT lang, y, z, a FROM r)
              GROUP BY lang, x, y),
        two AS (SELECT b.lang, b.x || ' ' || b.y AS phrase, b.a, one.a AS l, other.a AS r,
              CAST(CAST(1000000 AS HUGEINT) * b.a * b.a // (CAST(one.a AS HUGEINT) * other.a) AS BIGINT) AS score
              FROM b JOIN o one ON one.lang = b.lang AND one.x = b.x JOIN o other ON other.lang = b.lang AND other.x = b.y
              LEFT JOIN longer g ON g.lang = b.lang AND g.x = b.x AND g.y = b.y
              WHERE g.most IS NULL OR 100 * g.most < 50 * b.a),
        cuts AS (SELECT r.lang, r.x || ' ' || r.y || ' ' || r.z AS phrase, r.a, first.a AS l1, rest.a AS r1, head.a AS l2,
              last.a AS r2, CAST(CAST(1000000 AS HUGEINT) * r.a * r.a // (CAST(first.a AS HUGEINT) * rest.a) AS BIGINT) AS s1,
              CAST(CAST(1000000 AS HUGEINT) * r.a * r.a // (CAST(head.a AS HUGEINT) * last.a) AS BIGINT) AS s2
              FROM r JOIN o first ON first.lang = r.lang AND first.x = r.x JOIN b rest ON rest.lang = r.lang AND rest.x = r.y AND rest.y = r.z
              JOIN b head ON head.lang = r.lang AND head.x = r.x AND head.y = r.y JOIN o last ON last.lang = r.lang AND last.x = r.z),
        every AS (SELECT * FROM two UNION ALL SELECT lang, phrase, a, CASE WHEN s1 <= s2 THEN l1 ELSE l2 END,
              CASE WHEN s1 <= s2 THEN r1 ELSE r2 END, least(s1, s2) FROM cuts),
        ranked AS (SELECT *, row_number() OVER (PARTITION BY lang ORDER BY score DESC, a DESC, phrase) AS rank FROM every)
        SELECT lang, rank, phrase, a, l, r, n, score FROM ranked JOIN totals USING (lang) WHERE rank <= 2000""",
}

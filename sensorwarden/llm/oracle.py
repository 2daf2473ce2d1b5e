"""The corpus queries as DuckDB SQL, where SQL can express them."""

from __future__ import annotations

def _words(text: str) -> str:
    """Lower-cased words of a text column as a list."""
    lower = f"translate(coalesce({text}, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz')"
    return f"regexp_extract_all({lower}, '[^\x20\x09-\x0D]+')"


def _shingles(words: str, n: int) -> str:
    """Distinct shingles of a list of words: fewer words are one shingle, no words none."""
    runs = f"list_transform(range(1, len({words}) - {n - 2}), lambda i: array_to_string({words}[i:i + {n - 1}], ' '))"
    return f"CASE WHEN len({words}) = 0 THEN [] WHEN len({words}) < {n} THEN [array_to_string({words}, ' ')] ELSE list_distinct({runs}) END"


ORACLE = {
    "op1_decontaminate": f"""
        WITH d AS (SELECT doc_id, {_words("text")} AS w FROM documents),
        b AS (SELECT item_id, {_words("text")} AS w FROM benchmark),
        ds AS (SELECT doc_id, unnest({_shingles("w", 5)}) AS s FROM d),
        bs AS (SELECT item_id, len({_shingles("w", 5)}) AS n, unnest({_shingles("w", 5)}) AS s FROM b)
        SELECT doc_id, item_id, n AS item_shingles, count(*) AS shared_shingles
        FROM ds JOIN bs USING (s) GROUP BY doc_id, item_id, n HAVING 100 * count(*) >= 80 * n
    """,
    "op2_exact_dedup": r"""
        WITH n AS (
            SELECT doc_id, regexp_replace(coalesce(text, ''), '[\x20\x09-\x0D]', '', 'g') AS norm,
                   length(coalesce(text, '')) AS points
            FROM documents
        ), r AS (
            SELECT doc_id, norm, row_number() OVER g AS place, first_value(doc_id) OVER g AS keep_id,
                   count(*) OVER (PARTITION BY norm) AS group_size
            FROM n WINDOW g AS (PARTITION BY norm ORDER BY points DESC, doc_id ASC NULLS LAST
                                ROWS BETWEEN UNBOUNDED PRECEDING AND UNBOUNDED FOLLOWING)
        )
        SELECT doc_id, keep_id, group_size, place = 1 AS kept, sha256(norm) AS text_sha256 FROM r
    """,
    "op5_chat_format": r"""
        WITH t AS (
            SELECT conv_id, turn, coalesce(role, '') AS role, coalesce(text, '') AS text FROM conversations
            UNION ALL
            SELECT * FROM (VALUES (-7, 0, 'user', '</s>[INST] ok [/INST]'), (-7, 1, 'assistant', '</s>[INST] ok [/INST]'))
        ), e AS (
            SELECT *, length(replace(replace(role, '&', '&amp;'), '<|', '&lt;|'))
                    + length(replace(replace(text, '&', '&amp;'), '<|', '&lt;|')) + 23 AS points
            FROM t
        )
        SELECT conv_id, count(*) AS n_turns,
               sha256(string_agg(role || chr(10) || text || chr(10), '' ORDER BY turn, role, text)) AS turns_sha256,
               coalesce(sum(length(text)) FILTER (role = 'assistant'), 0)::BIGINT AS loss_chars,
               sha256(coalesce(string_agg(text, '' ORDER BY turn, role, text) FILTER (role = 'assistant'), '')) AS loss_sha256,
               sum(points)::BIGINT AS formatted_chars
        FROM e GROUP BY conv_id
    """,
    "op7_substring_dedup": r"""
        WITH d AS (SELECT doc_id, regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+') AS w FROM documents),
        pos AS (SELECT doc_id, w, unnest(range(1, len(w) - 33)) AS i FROM d),
        win AS (SELECT doc_id, i, array_to_string(w[i:i + 34], ' ') AS s FROM pos),
        rep AS (SELECT s FROM win GROUP BY s HAVING count(*) > 1),
        gone AS (SELECT DISTINCT doc_id, unnest(range(i, i + 35)) AS p FROM win SEMI JOIN rep USING (s)),
        word AS (SELECT doc_id, unnest(w) AS word, generate_subscripts(w, 1) AS p FROM d),
        kept AS (
            SELECT word.doc_id, count(*) AS n_words, count(gone.p) AS n_removed,
                   string_agg(word, ' ' ORDER BY word.p) FILTER (gone.p IS NULL) AS kept
            FROM word LEFT JOIN gone ON word.doc_id = gone.doc_id AND word.p = gone.p GROUP BY word.doc_id
        )
        SELECT d.doc_id, coalesce(n_words, 0) AS n_words, coalesce(n_removed, 0) AS n_removed,
               sha256(coalesce(kept, '')) AS kept_sha256
        FROM d LEFT JOIN kept ON d.doc_id = kept.doc_id
    """,
    "op8_warc": r"""
        WITH p AS (
            SELECT page_id, coalesce(html, '') AS html, octet_length(encode(coalesce(html, ''))) AS payload_bytes,
                   sha1(coalesce(html, '')) AS hex
            FROM pages
        ), r AS (SELECT html, max(page_id) AS response_id FROM p GROUP BY html),
        d AS (
            SELECT p.*, response_id,
                   list_transform(range(0, 8), lambda g: ('0x' || substr(hex, 1 + 5 * g::INT, 5))::INT) AS groups
            FROM p JOIN r USING (html)
        )
        SELECT page_id, payload_bytes,
               array_to_string(flatten(list_transform(groups, lambda v: list_transform([32768, 1024, 32, 1],
                   lambda w: substr('ABCDEFGHIJKLMNOPQRSTUVWXYZ234567', 1 + (v // w) % 32, 1)))), '') AS payload_digest,
               CASE WHEN response_id <> page_id THEN 'revisit' ELSE 'response' END AS record_type,
               CASE WHEN response_id <> page_id THEN response_id END AS refers_to
        FROM d
    """,
    "op9_line_dedup": r"""
        WITH l AS (
            SELECT doc_id, unnest(string_split(coalesce(text, ''), chr(10))) AS line,
                   generate_subscripts(string_split(coalesce(text, ''), chr(10)), 1) AS pos
            FROM documents
        ), k AS (
            SELECT doc_id, line, pos, translate(trim(line, concat(' ', chr(9), chr(10), chr(11), chr(12), chr(13))),
                   'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS key
            FROM l
        ), f AS (
            SELECT key FROM k WHERE length(key) >= 1 GROUP BY key HAVING count(DISTINCT doc_id) >= 10
        ), m AS (
            SELECT k.doc_id, k.line, k.pos, f.key IS NOT NULL AS gone FROM k LEFT JOIN f ON k.key = f.key
        )
        SELECT doc_id, count(*) AS n_lines, count(*) FILTER (gone) AS n_dropped,
               sha256(coalesce(string_agg(line, chr(10) ORDER BY pos) FILTER (NOT gone), '')) AS kept_sha256
        FROM m GROUP BY doc_id
    """,
    "op10_jaccard_join": f"""
        WITH RECURSIVE d AS (SELECT doc_id, {_words("text")} AS w FROM documents),
        n AS (SELECT doc_id, len({_shingles("w", 4)}) AS n FROM d),
        s AS (SELECT doc_id, unnest({_shingles("w", 4)}) AS s FROM d),
        c AS (
            SELECT a.doc_id AS a, b.doc_id AS b, count(*) AS c
            FROM s a JOIN s b ON a.s = b.s AND a.doc_id < b.doc_id GROUP BY ALL
        ), l AS (
            SELECT a, b FROM c JOIN n x ON x.doc_id = a JOIN n y ON y.doc_id = b
            WHERE 100 * c.c >= 85 * (x.n + y.n - c.c)
        ), e AS (SELECT a, b FROM l UNION SELECT b, a FROM l),
        r AS (
            SELECT doc_id, doc_id AS other FROM d
            UNION
            SELECT r.doc_id, e.b FROM r JOIN e ON r.other = e.a
        )
        SELECT n.doc_id, n.n AS n_shingles, min(other) AS component_id FROM n JOIN r ON n.doc_id = r.doc_id GROUP BY ALL
    """,
    "op11_collocations": r"""
        WITH t AS (
            SELECT coalesce(lang, 'und') AS lang,
                   translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS t
            FROM documents
        ), p AS (SELECT lang, unnest(regexp_split_to_array(t, '[.,;:!?\x0A-\x0D]')) AS s FROM t),
        w AS (SELECT lang, regexp_extract_all(s, '[^\x20\x09]+') AS w FROM p),
        g AS (
            SELECT lang, k, unnest(list_transform(range(1, len(w) - k + 2), lambda i: array_to_string(w[i:i + k - 1], ' '))) AS g
            FROM w, (SELECT unnest([1, 2, 3, 4]) AS k)
        ), f AS (SELECT lang, k, g, count(*) AS f FROM g GROUP BY ALL),
        n AS (SELECT lang, sum(f)::BIGINT AS n FROM f WHERE k = 1 GROUP BY lang),
        c AS (SELECT lang, k, g, f, string_split(g, ' ') AS w FROM f WHERE k >= 2 AND f >= 30),
        inner_of AS (
            SELECT lang, f, m, unnest(list_transform(range(1, k - m + 2), lambda i: array_to_string(w[i:i + m - 1], ' '))) AS g
            FROM c, (SELECT unnest([2, 3]) AS m) WHERE m < k
        ), covered AS (
            SELECT DISTINCT c.lang, c.g FROM c JOIN inner_of o ON o.lang = c.lang AND o.g = c.g WHERE 100 * o.f >= 80 * c.f
        ), cut AS (
            SELECT c.*, j, array_to_string(w[1:j], ' ') AS head, array_to_string(w[j + 1:], ' ') AS tail
            FROM c ANTI JOIN covered ON covered.lang = c.lang AND covered.g = c.g, (SELECT unnest([1, 2, 3]) AS j) WHERE j < k
        ), scored AS (
            SELECT cut.lang, cut.g, cut.f AS a, j, x.f AS l, y.f AS r, (2000000::HUGEINT * cut.f) // (x.f + y.f) AS score
            FROM cut JOIN f x ON x.lang = cut.lang AND x.g = head JOIN f y ON y.lang = cut.lang AND y.g = tail
        ), best AS (
            SELECT * FROM scored QUALIFY row_number() OVER (PARTITION BY lang, g ORDER BY score, j) = 1
        ), ranked AS (
            SELECT *, row_number() OVER (PARTITION BY lang ORDER BY score DESC, a DESC, g) AS rank FROM best
        )
        SELECT ranked.lang, rank, g AS phrase, a, l, r, n, score::BIGINT AS score FROM ranked JOIN n ON n.lang = ranked.lang
        WHERE rank <= 2000
    """,
    "op13_fill_in_middle": r"""
        WITH d AS (
            SELECT doc_id, coalesce(text, '') AS t, length(coalesce(text, '')) AS n,
                   sha256('1:' || coalesce(doc_id::VARCHAR, '')) AS hex
            FROM documents
        ), h AS (
            SELECT doc_id, t, n, ('0x' || substr(hex, 1, 8))::BIGINT AS h1, ('0x' || substr(hex, 9, 8))::BIGINT AS h2,
                   ('0x' || substr(hex, 17, 8))::BIGINT AS h3, ('0x' || substr(hex, 25, 8))::BIGINT AS h4
            FROM d
        ), c AS (
            SELECT doc_id, t, n, least(h1 % (n + 1), h2 % (n + 1)) AS a, greatest(h1 % (n + 1), h2 % (n + 1)) AS b,
                   CASE WHEN n = 0 OR contains(t, '<P>') OR contains(t, '<S>') OR contains(t, '<M>') OR h3 % 100 >= 90 THEN 'plain'
                        WHEN h4 % 100 < 20 THEN 'spm' ELSE 'psm' END AS form
            FROM h
        ), p AS (
            SELECT *, substr(t, 1, a) AS pre, substr(t, a + 1, b - a) AS mid, substr(t, b + 1) AS suf FROM c
        )
        SELECT doc_id, n, form, CASE WHEN form <> 'plain' THEN a END AS prefix_chars,
               CASE WHEN form <> 'plain' THEN b - a END AS middle_chars,
               sha256(CASE form WHEN 'plain' THEN t WHEN 'psm' THEN '<P>' || pre || '<S>' || suf || '<M>' || mid
                      ELSE '<S>' || suf || '<P>' || pre || '<M>' || mid END) AS output_sha256,
               sha256(t) AS restored_sha256
        FROM p
    """,
}

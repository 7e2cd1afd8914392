"""DuckDB counterparts of the queries that SQL can express."""

_WORDS = r"list_filter(regexp_split_to_array(text, '[\x20\x09-\x0D]+'), lambda x: x <> '')"

ORACLES = {
    "op1_warc": """
        WITH p AS (SELECT page_id, coalesce(html, '') AS h, sha1(coalesce(html, '')) AS s FROM pages),
        f AS (SELECT h, min(page_id) AS first FROM p GROUP BY h)
        SELECT page_id, strlen(h) AS payload_bytes,
            array_to_string(list_transform(range(0, 32), lambda i: substr('ABCDEFGHIJKLMNOPQRSTUVWXYZ234567',
                (((('0x' || substr(s, ((i // 4) * 5 + 1)::INT, 5))::BIGINT >> (15 - 5 * (i % 4))::INT) & 31) + 1)::INT, 1)), '')
                AS payload_digest,
            CASE WHEN first = page_id THEN 'response' ELSE 'revisit' END AS record_type,
            CASE WHEN first <> page_id THEN first END AS refers_to
        FROM p JOIN f USING (h)""",
    "op3_chat_format": r"""
        WITH r AS (
            SELECT conv_id, turn, coalesce(role, '') AS role, coalesce(text, '') AS text FROM conversations
            UNION ALL SELECT -7, 0, 'user', '</s>[INST] ok [/INST]' UNION ALL SELECT -7, 1, 'assistant', '</s>[INST] ok [/INST]'),
        e AS (SELECT *, length(regexp_replace(text,
                '([<\[])(\\*)(\|im_(?:start|sep|end)\|>|/?s>|/?INST\]|</?SYS>>)', '\1\\\2\3', 'g')) AS n,
            lag(role) OVER (PARTITION BY conv_id ORDER BY turn, role, text) AS before FROM r)
        SELECT conv_id, count(*) AS n_turns,
            sha256(string_agg(role || chr(10) || text || chr(10), '' ORDER BY turn, role, text)) AS turns_sha256,
            coalesce(sum(length(text)) FILTER (role = 'assistant'), 0)::BIGINT AS loss_chars,
            sha256(coalesce(string_agg(text, '' ORDER BY turn, role, text) FILTER (role = 'assistant'), '')) AS loss_sha256,
            (sum(n + CASE WHEN before IS NULL THEN 13 + length(role) WHEN before = role THEN 10
                ELSE 11 + 13 + length(role) END) + 11)::BIGINT AS formatted_chars
        FROM e GROUP BY conv_id""",
    "op5_quality_rules": rf"""
        WITH d AS (SELECT doc_id, coalesce(text, '') AS text FROM documents),
        w AS (SELECT doc_id, text, {_WORDS} AS words,
            list_filter(string_split(text, chr(10)), lambda x: regexp_matches(x, '[^\x20\x09-\x0D]')) AS lines FROM d),
        i AS (SELECT doc_id, words, unnest(range(1, greatest(len(words) - 6, 1)::BIGINT)) AS i FROM w),
        g AS (SELECT doc_id, i, count(*) OVER (PARTITION BY doc_id, list_slice(words, i, i + 7)) AS n FROM i),
        c AS (SELECT doc_id, i + k AS at FROM g, range(0, 8) AS r(k) WHERE n > 1 GROUP BY 1, 2),
        rep AS (SELECT doc_id, count(*) AS n_repeat_words FROM c GROUP BY doc_id),
        m AS (SELECT doc_id, len(words)::BIGINT AS n_words,
            length(regexp_replace(text, '[\x20\x09-\x0D]', '', 'g')) AS word_chars,
            length(regexp_replace(text, '[^#*$%&|<>]', '', 'g')) AS n_symbols,
            (len(lines) - len(list_distinct(lines)))::BIGINT AS n_dup_lines, len(lines) AS n_lines,
            length(text) - length(regexp_replace(text, '\p{{Lu}}', '', 'g')) AS n_capitals,
            len(list_filter(range(2, len(words) + 1), lambda i: words[i] = words[i - 1])) AS n_stutters,
            coalesce(n_repeat_words, 0) AS n_repeat_words FROM w LEFT JOIN rep USING (doc_id)),
        b AS (SELECT *, n_words < 20 OR 100 * n_repeat_words > 30 * n_words AS base_failed FROM m)
        SELECT doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, base_failed,
            NOT (base_failed OR 10 * n_symbols > n_words OR word_chars < 3 * n_words OR word_chars > 15 * n_words
                OR (n_dup_lines >= 3 AND 10 * n_dup_lines > 3 * n_lines) OR 10 * n_stutters > 3 * n_words OR 10 * n_capitals > 4 * word_chars) AS kept
        FROM b""",
    "op10_top_k": """
        WITH v AS (SELECT vec_id, list_transform(embedding, lambda x: floor(1024 * x::DOUBLE)) AS e FROM embeddings
            WHERE embedding IS NOT NULL AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0),
        s AS (SELECT q.vec_id AS query_id, c.vec_id, list_dot_product(q.e, c.e)::BIGINT AS score
            FROM v q JOIN v c ON q.vec_id % 100 = 0 AND q.vec_id <> c.vec_id),
        r AS (SELECT *, row_number() OVER (PARTITION BY query_id ORDER BY score DESC, vec_id) AS rank FROM s)
        SELECT query_id, rank::INT AS rank, vec_id, score FROM r WHERE rank <= 10""",
    "op11_filter_audit": rf"""
        WITH d AS (SELECT doc_id, coalesce(lang, '') AS part, coalesce(text, '') AS text FROM documents),
        w AS (SELECT *, {_WORDS} AS words FROM d),
        f AS (SELECT doc_id, part,
            [len(words) < 200, 100 * len(list_distinct(words)) < 50 * len(words),
             100 * length(regexp_replace(text, '[^A-Z]', '', 'g')) > 3 * length(text), regexp_matches(text, '[#$%&*|]'),
             coalesce(doc_id > min(doc_id) OVER (PARTITION BY text), false)] AS fails FROM w),
        m AS (SELECT doc_id, bool_or(quality = 1) AS good, bool_or(toxic = 1) AS toxic FROM labels GROUP BY doc_id),
        c AS (SELECT part, fails, count(*) AS n, count(*) FILTER (good) AS good, count(*) FILTER (toxic) AS toxic
            FROM f LEFT JOIN m USING (doc_id) GROUP BY ALL),
        l AS (SELECT unnest([1, 2, 3, 4, 5]) AS i),
        o AS (SELECT [a.i, b.i, c.i, d.i, e.i] AS o FROM l a, l b, l c, l d, l e
            WHERE len(list_distinct([a.i, b.i, c.i, d.i, e.i])) = 5),
        s AS (SELECT o, l.i::INT AS step, o[l.i] AS f, o[1:l.i - 1] AS earlier FROM o, l),
        x AS (SELECT part, o, step, f, n, good, toxic, fails[f] AS hit,
            len(list_filter(earlier, lambda e: fails[e])) > 0 AS gone, len(list_filter(fails, lambda b: b)) = 1 AS alone FROM s, c),
        r AS (SELECT part, o, step, f, coalesce(sum(n) FILTER (NOT gone AND NOT hit), 0)::BIGINT AS kept,
            coalesce(sum(n) FILTER (NOT gone AND hit), 0)::BIGINT AS removed, coalesce(sum(n) FILTER (gone AND hit), 0)::BIGINT AS redundant,
            coalesce(sum(n) FILTER (alone AND hit), 0)::BIGINT AS unique_fails, coalesce(sum(good) FILTER (NOT gone AND hit), 0)::BIGINT AS good_lost,
            coalesce(sum(toxic) FILTER (NOT gone AND hit), 0)::BIGINT AS toxic_lost FROM x GROUP BY ALL)
        SELECT part, array_to_string(list_transform(o, lambda i: 'ABCDE'[i]), '') AS filter_order, step, 'ABCDE'[f] AS filter,
            kept, removed, redundant, unique_fails, good_lost, toxic_lost,
            (sum(removed) OVER (PARTITION BY part, f))::BIGINT AS shapley
        FROM r""",
}

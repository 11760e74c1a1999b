"""SQL for the queries whose results SQL can express.

The others are tested against brute force: positions of matches, tokens,
fingerprints, learnt scores, keyed hashes and linear programs have no SQL.
"""

from codeset.llm.quality_rules import ERROR, POOL, RISK, RULES

ORACLE_SQL: dict[str, str] = {}

ORACLE_SQL["op2_topk_search"] = """
WITH vectors AS (
    SELECT vec_id,
           list_transform(embedding, lambda x: CAST(floor(256 * CAST(x AS DOUBLE)) AS BIGINT)) AS ints
    FROM embeddings
    WHERE vec_id IS NOT NULL AND embedding IS NOT NULL
      AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0
), scored AS (
    SELECT q.vec_id AS query_id, c.vec_id,
           CAST(coalesce(list_sum(list_transform(
               range(1, least(len(q.ints), len(c.ints)) + 1), lambda i: q.ints[i] * c.ints[i]
           )), 0) AS BIGINT) AS score
    FROM vectors q JOIN vectors c ON c.vec_id <> q.vec_id
    WHERE q.vec_id % 50 = 0
), ranked AS (
    SELECT *, CAST(row_number() OVER (
        PARTITION BY query_id ORDER BY score DESC, vec_id
    ) AS INTEGER) AS rank
    FROM scored
)
SELECT query_id, rank, vec_id, score FROM ranked WHERE rank <= 5
"""

# Measures by joins of exploded words, not by hashes; binomial sums by lgamma.
_MEASURES = r"""
WITH documents_ AS (
    SELECT doc_id, coalesce(lang, '') AS stratum, coalesce(text, '') AS text FROM documents
), words AS (
    SELECT doc_id, stratum, text,
           list_filter(regexp_split_to_array(text, '[\x20\x09-\x0D]+'), lambda w: w <> '') AS words,
           list_filter(string_split(text, chr(10)),
                       lambda l: regexp_matches(l, '[^\x20\x09-\x0D]')) AS lines
    FROM documents_
), windows AS (
    SELECT doc_id, i, array_to_string(words[i:i + 7], ' ') AS window_
    FROM words, LATERAL (SELECT unnest(range(1, len(words) - 6)) AS i)
), twins AS (
    SELECT doc_id, i FROM windows
    QUALIFY count(*) OVER (PARTITION BY doc_id, window_) > 1
), covered AS (
    SELECT doc_id, count(DISTINCT i + step) AS n_repeat_words
    FROM twins, LATERAL (SELECT unnest(range(0, 8)) AS step)
    GROUP BY doc_id
), measured AS (
    SELECT doc_id, stratum,
           CAST(len(words) AS BIGINT) AS n_words,
           CAST(coalesce(list_sum(list_transform(words, lambda w: length(w))), 0) AS BIGINT) AS word_chars,
           CAST(length(text) - length(regexp_replace(text, '[#*$%&|<>]', '', 'g')) AS BIGINT) AS n_symbols,
           CAST(len(lines) - len(list_distinct(lines)) AS BIGINT) AS n_dup_lines,
           CAST(length(text) - length(regexp_replace(text, '[A-Z]', '', 'g')) AS BIGINT) AS n_upper,
           CAST(length(text) - length(regexp_replace(text, '!', '', 'g')) AS BIGINT) AS n_marks,
           CAST(coalesce(n_repeat_words, 0) AS BIGINT) AS n_repeat_words,
           len(words) < 20 OR 100 * coalesce(n_repeat_words, 0) > 30 * len(words) AS base_failed
    FROM words LEFT JOIN covered USING (doc_id)
), quality_ AS (
    SELECT doc_id, min(quality) AS good FROM labels WHERE quality IS NOT NULL GROUP BY doc_id
), held AS (
    SELECT * FROM measured JOIN quality_ USING (doc_id) WHERE NOT base_failed
)
"""


def _quality_sql() -> str:
    def over(level: int) -> str:
        return " OR ".join(
            f"coalesce({rule.measure} > CAST({float(rule.cutoffs[level])!r} AS DOUBLE), false)" for rule in RULES
        )

    levels = range(len(RULES[0].cutoffs))
    level = "CASE " + " ".join(f"WHEN {over(i)} THEN {i}" for i in levels) + " END"
    return _MEASURES + f"""
, levelled AS (
    SELECT *, {level} AS level FROM held
), strata AS (
    SELECT stratum, sum(good) AS n FROM levelled GROUP BY stratum
), pools AS (
    SELECT stratum, CASE WHEN n < ceil(ln({ERROR!r}::DOUBLE / (SELECT count(*) FROM strata)) / ln(1 - {RISK!r}::DOUBLE))
                    THEN '{POOL}' ELSE stratum END AS pool
    FROM strata
), counts AS (
    SELECT pool, place, sum(good) AS n,
           count(*) FILTER (WHERE good = 1 AND level <= place) AS k,
           count(*) FILTER (WHERE good = 0 AND level <= place) AS caught
    FROM levelled JOIN pools USING (stratum), range({len(levels)}) p(place) GROUP BY ALL
), tests AS (
    SELECT pool, place, caught,
           k <= n * {RISK!r}::DOUBLE AND coalesce(list_sum(list_transform(range(0, k + 1), lambda i: exp(
               lgamma(n + 1) - lgamma(i + 1) - lgamma(n - i + 1)
               + i * ln({RISK!r}::DOUBLE) + (n - i) * ln(1 - {RISK!r}::DOUBLE)
           ))), 0) <= {ERROR!r}::DOUBLE / (SELECT count(DISTINCT pool) FROM pools) AS passed
    FROM counts
), certified AS (
    SELECT * FROM tests QUALIFY bool_and(passed) OVER (PARTITION BY pool ORDER BY place)
), chosen AS (
    SELECT pool, place AS chosen FROM certified WHERE caught > 0
    QUALIFY row_number() OVER (PARTITION BY pool ORDER BY caught DESC, place) = 1
)
SELECT doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, base_failed,
       NOT base_failed AND NOT coalesce({level} <= chosen, false) AS kept
FROM measured LEFT JOIN pools USING (stratum) LEFT JOIN chosen USING (pool)
"""


ORACLE_SQL["op7_quality_rules"] = _quality_sql()

_LOWER = "translate({0}, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz')"

# Scores by joins of exploded terms, all documents for each item.
ORACLE_SQL["op11_lexical_search"] = r"""
WITH doc_terms AS (
    SELECT row, doc_id, unnest(regexp_extract_all(lowered, '[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+')) AS term
    FROM (SELECT row_number() OVER () AS row, doc_id, {lower} AS lowered FROM documents WHERE text IS NOT NULL)
), tfs AS (
    SELECT row, doc_id, term, count(*) AS tf FROM doc_terms GROUP BY ALL
), lengths AS (
    SELECT row, sum(tf)::BIGINT AS n FROM tfs GROUP BY row
), whole AS (
    SELECT count(*) AS docs, sum(n)::BIGINT AS total FROM lengths
), norms AS (
    SELECT row, 10 + (90 * n * docs) // total AS m FROM lengths, whole
), weights AS (
    SELECT term, floor(1000 * ln((2 * docs + 2)::DOUBLE / (2 * count(*) + 1)::DOUBLE))::BIGINT AS w
    FROM tfs, whole GROUP BY term, docs
), items AS (
    SELECT DISTINCT item_id, unnest(regexp_extract_all({lower}, '[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+')) AS term
    FROM benchmark WHERE text IS NOT NULL
), scored AS (
    SELECT item_id, row, doc_id, sum(w * ((1000000000 * tf) // (1000 * tf + 8 * m)))::BIGINT AS score
    FROM items JOIN weights USING (term) JOIN tfs USING (term) JOIN norms USING (row)
    GROUP BY ALL
), ranked AS (
    SELECT item_id, doc_id, score, row_number() OVER (
        PARTITION BY item_id ORDER BY score DESC, doc_id NULLS LAST
    )::INTEGER AS rank
    FROM scored WHERE score > 0
)
SELECT item_id, rank, doc_id, score FROM ranked WHERE rank <= 10
""".replace("{lower}", _LOWER.format("text"))

# Every group with every kept term of its language, in wide integers.
ORACLE_SQL["op12_source_divergence"] = r"""
WITH docs AS (
    SELECT row_number() OVER () AS row, coalesce(lang, '') AS lang, coalesce(source, '') AS source,
           coalesce(text, '') AS text
    FROM documents
), terms AS (
    SELECT row, lang, source, unnest(regexp_extract_all({lower}, '[^\x00-\x40\x5B-\x60\x7B-\x7F]+')) AS term
    FROM docs
), kept AS (
    SELECT lang, term, count(*) AS lang_times FROM terms
    GROUP BY ALL HAVING count(DISTINCT row) >= 3
), langs AS (
    SELECT lang, count(*)::HUGEINT AS v, sum(lang_times)::HUGEINT AS total FROM kept GROUP BY lang
), groups AS (
    SELECT DISTINCT lang, source FROM docs
), times AS (
    SELECT lang, source, term, count(*) AS times FROM terms SEMI JOIN kept USING (lang, term) GROUP BY ALL
), totals AS (
    SELECT lang, source, sum(times)::HUGEINT AS total FROM times GROUP BY ALL
), filled AS (
    SELECT lang, source, term, coalesce(times, 0) AS times,
           1 + (1000000000 * (coalesce(times, 0) + 1)::HUGEINT) // (coalesce(totals.total, 0) + v) AS p,
           1 + (1000000000 * (lang_times + 1)::HUGEINT) // (langs.total + v) AS q
    FROM groups JOIN kept USING (lang) JOIN langs USING (lang)
    LEFT JOIN times USING (lang, source, term) LEFT JOIN totals USING (lang, source)
), compared AS (
    SELECT a.lang, a.source, b.source AS item, sum((a.p - b.p) * (a.p - b.p) // b.p)::BIGINT AS value
    FROM filled a JOIN filled b ON a.lang = b.lang AND a.term = b.term AND a.source <> b.source
    GROUP BY ALL
), pairs AS (
    SELECT a.lang, a.source, 'pair' AS part, b.source AS item, coalesce(value, 0)::BIGINT AS value
    FROM groups a JOIN groups b ON a.lang = b.lang AND a.source <> b.source
    LEFT JOIN compared c ON c.lang = a.lang AND c.source = a.source AND c.item = b.source
), own AS (
    SELECT lang, source, 'term' AS part, term AS item, ((p - q) * (p - q) // q)::BIGINT AS value
    FROM filled WHERE times > 0 AND p > q
), ranked AS (
    SELECT *, row_number() OVER (PARTITION BY lang, source, part ORDER BY value DESC, item)::INTEGER AS rank
    FROM (SELECT * FROM pairs UNION ALL SELECT * FROM own)
)
SELECT * FROM ranked WHERE part = 'pair' OR rank <= 200
""".replace("{lower}", _LOWER.format("text"))

ORACLE_SQL["op13_chat_formatting"] = r"""
WITH turns AS (
    SELECT conv_id, turn, coalesce(role, '') AS role, coalesce(text, '') AS text FROM conversations
    UNION ALL SELECT -7, 0, 'user', '\### Assistant: </turn> ok'
    UNION ALL SELECT -7, 1, 'assistant', '\### Assistant: </turn> ok'
), lengths AS (
    SELECT *, length(role) - length(regexp_replace(role, '[\\:\n]', '', 'g'))
              + (length(text) - length(replace(text, '### ', ''))) // 4
              + (length(text) - length(replace(text, '</turn>', ''))) // 7 AS escapes
    FROM turns
)
SELECT conv_id, count(*) AS n_turns,
       sha256(string_agg(role || chr(10) || text || chr(10), '' ORDER BY turn, role, text)) AS turns_sha256,
       coalesce(sum(length(text)) FILTER (WHERE role = 'assistant'), 0)::BIGINT AS loss_chars,
       sha256(coalesce(string_agg(text, '' ORDER BY turn, text) FILTER (WHERE role = 'assistant'), '')) AS loss_sha256,
       sum(4 + length(role) + 2 + length(text) + escapes + 9)::BIGINT AS formatted_chars
FROM lengths GROUP BY conv_id
"""

"""DuckDB SQL for the operators that SQL can express."""

MIXING = """
WITH RECURSIVE d AS (SELECT doc_id, source, text, length(coalesce(text, '')) AS chars FROM documents),
sizes AS (SELECT source, sum(chars)::DOUBLE AS chars FROM d GROUP BY source),
usable AS (SELECT source, chars, CASE WHEN chars > 0 THEN 1.0::DOUBLE ELSE 0.0::DOUBLE END AS target FROM sizes),
totals AS (SELECT sum(chars) AS all_chars, sum(target) AS all_target FROM usable),
rates AS (SELECT source, CASE WHEN chars = 0 THEN 1.0::DOUBLE WHEN all_target = 0 THEN 0.0::DOUBLE
                 ELSE target / all_target * (all_chars * 1.0::DOUBLE) / chars END AS rate FROM usable, totals),
per_draw AS (SELECT source, greatest(1, ceil(rate / 64)::INT) AS draws, rate / greatest(1, ceil(rate / 64)::INT) AS lam FROM rates),
cdf AS (SELECT source, lam, 0 AS k, exp(-lam) AS p, exp(-lam) AS c FROM per_draw
        UNION ALL SELECT source, lam, k + 1, p * lam / (k + 1), c + p * lam / (k + 1) FROM cdf
        WHERE k < ceil(lam + 12 * sqrt(lam) + 24)),
draws AS (SELECT doc_id, d.source, text, j, ('0x' || substr(md5('17:' || coalesce(doc_id::VARCHAR, 'null') || ':' || j), 1, 13))::BIGINT::DOUBLE / 4503599627370496 AS u
          FROM d JOIN per_draw ON d.source IS NOT DISTINCT FROM per_draw.source, unnest(range(draws)) AS t(j)),
counts AS (SELECT doc_id, draws.source, any_value(text) AS text, sum((SELECT count(*) FROM cdf WHERE cdf.source IS NOT DISTINCT FROM draws.source AND cdf.c <= draws.u))::INT AS n_copies
           FROM draws GROUP BY doc_id, draws.source)
SELECT doc_id, source, text, n_copies, c::INT AS copy, md5('17-shuffle:' || coalesce(doc_id::VARCHAR, 'null') || ':' || c) AS shuffle_key
FROM counts, unnest(range(1, n_copies + 1)) AS t(c)
"""

SUBSTRING_DEDUP = r"""
WITH parts AS (SELECT doc_id, unnest(string_split(coalesce(text, ''), chr(10))) AS unit,
                      generate_subscripts(string_split(coalesce(text, ''), chr(10)), 1) - 1 AS pos FROM documents),
normal AS (SELECT doc_id, pos, unit, trim(regexp_replace(lower(unit), '[\x20\x09-\x0D]+', ' ', 'g')) AS n,
                  coalesce(sum(length(unit) + 1) OVER (PARTITION BY doc_id ORDER BY pos ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0)::BIGINT AS start
           FROM parts),
ranked AS (SELECT *, n <> '' AND row_number() OVER (PARTITION BY n ORDER BY doc_id, pos) > 1 AS gone FROM normal)
SELECT doc_id, count(*) AS n_units, count(*) FILTER (gone) AS n_removed,
       coalesce(sum(length(unit)) FILTER (gone), 0)::BIGINT AS removed_chars,
       coalesce(string_agg(start || ':' || (start + length(unit)), ',' ORDER BY pos) FILTER (gone), '') AS removed_spans,
       coalesce(string_agg(start || ':' || (start + length(unit)), ',' ORDER BY pos) FILTER (NOT gone), '') AS kept_spans,
       coalesce(string_agg(unit, chr(10) ORDER BY pos) FILTER (NOT gone), '') AS kept_text
FROM ranked GROUP BY doc_id
"""

EXACT_DEDUP = r"""
WITH n AS (SELECT doc_id, regexp_replace(coalesce(text, ''), '[\x20\x09-\x0D]+', ' ', 'g') AS t FROM documents),
g AS (SELECT doc_id, t, min(doc_id) OVER (PARTITION BY t) AS keep_id, count(*) OVER (PARTITION BY t) AS group_size FROM n)
SELECT doc_id, keep_id, group_size, doc_id = keep_id AS kept, sha256(t) AS text_sha256 FROM g
"""

# Escaping: backslashes doubled, then one after the first character of every control string of the template.
CHAT_FORMAT = r"""
WITH c AS (SELECT conv_id, turn, role, coalesce(text, '') AS text FROM conversations
           UNION ALL SELECT -7, 0, 'user', '</s>[INST] ok [/INST]' UNION ALL SELECT -7, 1, 'assistant', '</s>[INST] ok [/INST]'),
e AS (SELECT *, regexp_replace(replace(text, '\', '\\'),
             '(<)(s>|/s>)|(\[)(SYS\]|/SYS\]|INST\]|/INST\]|BOT\]|ROLE\]|:\]|/ROLE\]|IMG\]|AUDIO\]|DOC\]|PART\])', '\1\3\\\2\4', 'g') AS escaped FROM c)
SELECT conv_id, count(*) AS n_turns,
       sha256(string_agg(role || chr(10) || text || chr(10), '' ORDER BY turn)) AS turns_sha256,
       coalesce(sum(length(text)) FILTER (role = 'assistant'), 0)::BIGINT AS loss_chars,
       sha256(coalesce(string_agg(text, '' ORDER BY turn) FILTER (role = 'assistant'), '')) AS loss_sha256,
       (3 + sum(length(escaped) + CASE role WHEN 'system' THEN 11 WHEN 'user' THEN 13 WHEN 'assistant' THEN 9
                                  ELSE 16 + length(role) END))::BIGINT AS formatted_chars
FROM e GROUP BY conv_id
"""

COLLOCATIONS = r"""
WITH pieces AS (SELECT coalesce(lang, 'und') AS lang, unnest(string_split_regex(
         translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[.,;:!?\x0A-\x0D]')) AS piece FROM documents),
w AS (SELECT lang, regexp_extract_all(piece, '[^\x20\x09]+') AS words FROM pieces),
grams AS (SELECT lang, 1 AS k, unnest(words) AS phrase FROM w
""" + "".join(f"""          UNION ALL SELECT lang, {k}, unnest([array_to_string(words[s:s + {k - 1}], ' ') FOR s IN range(1, len(words) - {k - 2})]) FROM w WHERE len(words) >= {k}
""" for k in range(2, 6)) + r"""),
f AS MATERIALIZED (SELECT lang, k, phrase, count(*) AS a FROM grams GROUP BY ALL HAVING k = 1 OR count(*) >= 100),
totals AS (SELECT lang, sum(a)::HUGEINT AS n FROM f WHERE k = 1 GROUP BY lang),
cand AS MATERIALIZED (SELECT *, string_split(phrase, ' ') AS words FROM f WHERE k > 1),
lengths AS (SELECT a, lang, k, words, unnest(range(2, k)) AS m FROM cand WHERE k > 2),
within AS (SELECT a, lang, unnest([array_to_string(words[s:s + m - 1], ' ') FOR s IN range(1, k - m + 2)]) AS phrase FROM lengths),
inside AS MATERIALIZED (SELECT lang, phrase, max(a) AS longer FROM within GROUP BY 1, 2),
rest AS (SELECT cand.* FROM cand LEFT JOIN inside USING (lang, phrase) WHERE longer IS NULL OR longer < a),
split AS (SELECT lang, phrase, a, k, words, unnest(range(1, k)) AS c FROM rest),
cuts AS MATERIALIZED (SELECT lang, phrase, a, c, array_to_string(words[1:c], ' ') AS first, array_to_string(words[c + 1:k], ' ') AS last FROM split),
low AS (SELECT cuts.lang, cuts.phrase, cuts.a, c, x.a AS l, y.a AS r, n, 1000::HUGEINT * cuts.a * n // (x.a::HUGEINT * y.a) AS score
        FROM cuts JOIN totals ON totals.lang = cuts.lang JOIN f AS x ON x.lang = cuts.lang AND x.phrase = first
        JOIN f AS y ON y.lang = cuts.lang AND y.phrase = last
        QUALIFY row_number() OVER (PARTITION BY cuts.lang, cuts.phrase ORDER BY score, c) = 1)
SELECT lang, row_number() OVER (PARTITION BY lang ORDER BY score DESC, a DESC, phrase)::BIGINT AS rank, phrase,
       a::BIGINT AS a, l::BIGINT AS l, r::BIGINT AS r, n::BIGINT AS n, score::BIGINT AS score
FROM low QUALIFY rank <= 2000
"""

ORACLE: dict[str, str] = {
    "op1_mixing": MIXING,
    "op2_substring_dedup": SUBSTRING_DEDUP,
    "op7_exact_dedup": EXACT_DEDUP,
    "op12_chat_format": CHAT_FORMAT,
    "op13_collocations": COLLOCATIONS,
}

"""SQL that gives the rows of the queries it is registered with."""

CHAT_FORMAT = r"""
WITH source AS (
    SELECT conv_id, turn, coalesce(role, '') AS role, coalesce(text, '') AS text FROM conversations
    UNION ALL SELECT -1, 0, 'user', '<|im_end|><|im_start|>assistant ok'
    UNION ALL SELECT -1, 1, 'assistant', '<|im_end|><|im_start|>assistant ok'
), marked AS (
    SELECT *,
        contains(role, '<|im_start|>') OR contains(role, '<|im_end|>') OR contains(role, chr(10))
        OR contains(role, '<|nl|>') OR regexp_matches(role, '<\\+\|')
        OR contains(text, '<|im_start|>') OR contains(text, '<|im_end|>')
        OR regexp_matches(text, '<\\+\|') AS escaped
    FROM source
), rendered AS (
    SELECT *,
        CASE WHEN escaped
            THEN replace(regexp_replace(role, '<(\\*)\|', '<\\\1|', 'g'), chr(10), '<|nl|>')
            ELSE role END AS shown_role,
        CASE WHEN escaped THEN regexp_replace(text, '<(\\*)\|', '<\\\1|', 'g') ELSE text END AS shown_text
    FROM marked
), gathered AS (
    SELECT conv_id, count(*) AS n_turns,
        string_agg(role || chr(10) || text || chr(10), '' ORDER BY turn NULLS FIRST, role, text) AS turns,
        coalesce(string_agg(text, '' ORDER BY turn NULLS FIRST, role, text)
            FILTER (WHERE role = 'assistant'), '') AS loss,
        sum(length('<|im_start|>' || shown_role || chr(10) || shown_text || '<|im_end|>' || chr(10))) AS chars,
        sum(escaped::INT) AS n_escaped
    FROM rendered GROUP BY conv_id
)
SELECT conv_id, n_turns, sha256(turns) AS turns_sha256, length(loss)::BIGINT AS loss_chars,
    sha256(loss) AS loss_sha256, chars::BIGINT AS formatted_chars, n_escaped::BIGINT AS n_escaped,
    true AS round_trips
FROM gathered
"""

LINE_DEDUP = r"""
WITH split AS (
    SELECT doc_id, string_split(coalesce(text, ''), chr(10)) AS lines FROM documents
), numbered AS (
    SELECT doc_id, unnest(lines) AS line, generate_subscripts(lines, 1) AS pos FROM split
), keyed AS (
    SELECT *, translate(regexp_replace(line, '^[\x20\x09-\x0D]+|[\x20\x09-\x0D]+$', '', 'g'),
        'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS key
    FROM numbered
), common AS (
    SELECT key, max(doc_id) AS keeper FROM keyed WHERE length(key) >= 20
    GROUP BY key HAVING count(DISTINCT doc_id) >= 3
), marked AS (
    SELECT k.*, c.key IS NOT NULL AND k.doc_id <> c.keeper AS dropped
    FROM keyed k LEFT JOIN common c USING (key)
)
SELECT doc_id, count(*) AS n_lines, count(*) FILTER (WHERE dropped) AS n_dropped,
    sha256(coalesce(string_agg(line, chr(10) ORDER BY pos) FILTER (WHERE NOT dropped), '')) AS kept_sha256
FROM marked GROUP BY doc_id
"""

# Sainte-Laguë by its definition: all quotients, and the highest as many as there are blocks.
MIXING = r"""
WITH rows AS (
    SELECT doc_id, source, len(regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+'))::BIGINT AS size,
        md5(concat_ws('|', '20260101', coalesce(doc_id::VARCHAR, ''), coalesce(source, ''), coalesce(text, ''))) AS ticket
    FROM documents
), totals AS (
    SELECT source, sum(size)::BIGINT AS source_size, count(*) AS n_docs FROM rows GROUP BY source
), parties AS (
    SELECT *, row_number() OVER (ORDER BY source NULLS LAST) AS sid,
        (row_number() OVER (ORDER BY source NULLS LAST) - 1) % 3 + 1 AS weight FROM totals
), before AS (
    SELECT *, (sum(source_size) OVER ())::BIGINT AS total, (sum(weight) OVER ())::BIGINT AS weights,
        coalesce(sum(3 * source_size) OVER w, 0)::BIGINT AS cap_before, coalesce(sum(weight) OVER w, 0)::BIGINT AS weight_before
    FROM parties
    WINDOW w AS (ORDER BY 3 * source_size / weight, sid ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING)
), capped AS (
    SELECT *, weight * (total - cap_before) / (weights - weight_before) > 3 * source_size AS is_capped FROM before
), targets AS (
    SELECT sid, source, source_size, n_docs, total,
        CASE WHEN is_capped THEN (3 * source_size)::DOUBLE
            ELSE weight * (total - (sum(CASE WHEN is_capped THEN 3 * source_size ELSE 0 END) OVER ())::BIGINT)
                / (sum(CASE WHEN is_capped THEN 0 ELSE weight END) OVER ())::BIGINT END AS target
    FROM capped
), dealt AS (
    SELECT r.*, t.sid, t.source_size, t.target,
        ('0x' || left(ticket, 15))::BIGINT % ceil(sqrt(t.n_docs))::BIGINT AS shard
    FROM rows r JOIN targets t ON r.source IS NOT DISTINCT FROM t.source
), shards AS (
    SELECT sid, shard, sum(size)::BIGINT AS shard_words,
        CASE WHEN sum(size) > 0 THEN greatest(round(sum(size) / 16), 1) ELSE 0 END::BIGINT AS blocks
    FROM dealt GROUP BY sid, shard
), source_quotas AS (
    SELECT sid, count(*) AS quota FROM (
        SELECT sid FROM (
            SELECT sid, target / (2 * k + 1) AS quotient, round(total / 16)::BIGINT AS seats
            FROM targets, range(0, (SELECT round(max(total) / 16)::BIGINT FROM targets)) ks(k)
            WHERE target > 0 AND k <= target / 16 + 30
        ) QUALIFY row_number() OVER (ORDER BY quotient DESC, sid) <= seats)
    GROUP BY sid
), source_seats AS (
    SELECT s.sid, least(coalesce(any_value(q.quota), 0), 3 * sum(s.blocks))::BIGINT AS seats
    FROM shards s LEFT JOIN source_quotas q USING (sid) GROUP BY s.sid
), shard_quotas AS (
    SELECT sid, shard, count(*) AS quota FROM (
        SELECT sid, shard FROM (
            SELECT s.sid, s.shard, s.blocks / (2 * k + 1) AS quotient, n.seats
            FROM shards s JOIN source_seats n USING (sid), range(0, (SELECT 3 * max(blocks) + 1 FROM shards)) ks(k)
            WHERE s.blocks > 0 AND k <= 3 * s.blocks
        ) QUALIFY row_number() OVER (PARTITION BY sid ORDER BY quotient DESC, shard) <= seats)
    GROUP BY sid, shard
), drawn AS (
    SELECT s.sid, s.shard, s.shard_words, coalesce(q.quota, 0) AS quota, greatest(s.blocks, 1) AS n,
        ('0x' || left(md5(concat_ws('|', '20260101', s.sid::VARCHAR, s.shard::VARCHAR)), 15))::BIGINT
            % greatest(s.blocks, 1) AS first_block
    FROM shards s LEFT JOIN shard_quotas q USING (sid, shard)
), ranges AS (
    SELECT sid, shard, quota // n AS epochs,
        floor(first_block * (shard_words / n))::BIGINT AS from1,
        CASE WHEN first_block + quota % n >= n THEN shard_words
            ELSE floor((first_block + quota % n) * (shard_words / n))::BIGINT END AS to1,
        floor(greatest(first_block + quota % n - n, 0) * (shard_words / n))::BIGINT AS to2
    FROM drawn
), placed AS (
    SELECT *, (sum(size) OVER (PARTITION BY sid, shard ORDER BY ticket, doc_id, size
        ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW))::BIGINT AS e
    FROM dealt
)
SELECT doc_id, size, source_size, target, (epochs * size
    + greatest(least(e, to2) - (e - size), 0)
    + greatest(least(e, to1) - greatest(e - size, from1), 0))::BIGINT AS taken
FROM placed JOIN ranges USING (sid, shard)
"""

QUALITY_RULES = r"""
WITH split AS (
    SELECT doc_id, lang AS stratum, coalesce(text, '') AS text,
        regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+') AS words,
        [x FOR x IN string_split(coalesce(text, ''), chr(10)) IF regexp_matches(x, '[^\x20\x09-\x0D]')] AS lines
    FROM documents
), placed AS (
    SELECT doc_id, unnest(words) AS w, generate_subscripts(words, 1) AS i FROM split
), windows AS (
    SELECT doc_id, i, w || ' ' || lead(w, 1) OVER o || ' ' || lead(w, 2) OVER o || ' ' || lead(w, 3) OVER o || ' '
        || lead(w, 4) OVER o || ' ' || lead(w, 5) OVER o || ' ' || lead(w, 6) OVER o || ' ' || lead(w, 7) OVER o AS key
    FROM placed WINDOW o AS (PARTITION BY doc_id ORDER BY i)
), often AS (
    SELECT doc_id, key FROM windows WHERE key IS NOT NULL GROUP BY doc_id, key HAVING count(*) > 1
), keyed AS (
    SELECT doc_id, i, 2 AS n FROM windows JOIN often USING (doc_id, key)
), repeated AS (
    SELECT doc_id, count(DISTINCT p) AS n_repeat_words
    FROM (SELECT doc_id, unnest(range(i, i + 8)) AS p FROM keyed WHERE n > 1) GROUP BY doc_id
), counts AS (
    SELECT doc_id, stratum, len(words)::BIGINT AS n_words, length(regexp_replace(text, '[\x20\x09-\x0D]', '', 'g'))::BIGINT AS word_chars,
        length(regexp_replace(text, '[^#*$%&|<>]', '', 'g'))::BIGINT AS n_symbols,
        len(lines)::BIGINT AS n_lines, (len(lines) - len(list_distinct(lines)))::BIGINT AS n_dup_lines,
        coalesce(n_repeat_words, 0)::BIGINT AS n_repeat_words,
        length(regexp_replace(text, '[^A-Za-z]', '', 'g'))::BIGINT AS n_letters,
        length(regexp_replace(text, '[^A-Z]', '', 'g'))::BIGINT AS n_upper,
        length(regexp_replace(text, '[^!]', '', 'g'))::BIGINT AS n_exclaims
    FROM split LEFT JOIN repeated USING (doc_id)
), judged AS (
    SELECT *, n_words < 20 OR 100 * n_repeat_words > 30 * n_words AS base_failed FROM counts
), rules AS (
    SELECT * FROM (VALUES
        (0, 'symbols', [0.05, 0.1, 0.2, 0.3, 0.5, 0.75, 1.0, 1.5, 2.0, 3.0]::DOUBLE[]),
        (1, 'exclaims', [0.05, 0.1, 0.2, 0.3, 0.5, 0.75, 1.0, 1.5, 2.0, 3.0]::DOUBLE[]),
        (2, 'upper_case', [0.05, 0.1, 0.15, 0.2, 0.25, 0.3, 0.35, 0.4, 0.5, 0.6, 0.7, 0.8, 0.9]::DOUBLE[]),
        (3, 'repeated_lines', [0.05, 0.1, 0.15, 0.2, 0.25, 0.3, 0.35, 0.4, 0.5, 0.6, 0.7, 0.8, 0.9]::DOUBLE[]),
        (4, 'repeated_words', [0.05, 0.1, 0.15, 0.2, 0.25, 0.3, 0.35, 0.4, 0.5, 0.6, 0.7, 0.8, 0.9]::DOUBLE[]),
        (5, 'long_words', [8, 9, 10, 11, 12, 14, 16, 20, 30, 50]::DOUBLE[])
    ) v(rule, name, cutoffs)
), figures AS (
    SELECT doc_id, stratum, base_failed, unnest([0, 1, 2, 3, 4, 5]) AS rule,
        unnest([n_symbols / greatest(n_words, 1), n_exclaims / greatest(n_words, 1), n_upper / greatest(n_letters, 1),
            n_dup_lines / greatest(n_lines, 1), n_repeat_words / greatest(n_words, 1), word_chars / greatest(n_words, 1)]) AS v
    FROM judged
), marked AS (
    SELECT doc_id, max((quality > 0)::INT) AS good,
        ('0x' || left(md5('fold|' || doc_id::VARCHAR), 15))::BIGINT % 2 AS fold
    FROM labels WHERE doc_id IS NOT NULL AND quality IS NOT NULL GROUP BY doc_id
), tried AS (
    SELECT f.stratum, f.rule, c.j, c.cutoff,
        count(*) FILTER (fold = 0 AND good = 0) AS bad, count(*) FILTER (fold = 0 AND good = 0 AND v > cutoff) AS bad_above,
        count(*) FILTER (fold = 0 AND good = 1) AS good, count(*) FILTER (fold = 0 AND good = 1 AND v > cutoff) AS good_above,
        count(*) FILTER (fold = 1 AND good = 1) AS held, count(*) FILTER (fold = 1 AND good = 1 AND v > cutoff) AS held_above
    FROM figures f JOIN marked USING (doc_id)
    JOIN (SELECT rule, unnest(range(len(cutoffs))) AS j, unnest(cutoffs) AS cutoff FROM rules) c ON c.rule = f.rule
    WHERE NOT f.base_failed GROUP BY ALL
), gains AS (
    SELECT *, bad_above / greatest(bad, 1) - 10.0::DOUBLE * (good_above / greatest(good, 1)) AS gain FROM tried
), proposals AS (
    SELECT stratum, rule, j AS best FROM gains
    QUALIFY row_number() OVER (PARTITION BY stratum, rule ORDER BY gain DESC, j DESC) = 1 AND gain > 0
), tails AS (
    SELECT g.stratum, g.rule, g.cutoff, list_sum([
        exp(lgamma(held + 1) - lgamma(i + 1) - lgamma(held - i + 1) + i * ln(0.02) + (held - i) * ln(0.98))
        FOR i IN range(0, held_above + 1)]) AS tail
    FROM gains g JOIN proposals p ON g.stratum IS NOT DISTINCT FROM p.stratum AND g.rule = p.rule AND g.j >= p.best
    WHERE g.held > 0
), cutoffs AS (
    SELECT stratum, rule, min(cutoff) AS cutoff FROM tails
    WHERE tail <= 0.05 / (SELECT count(*) FROM proposals) GROUP BY stratum, rule
), broken AS (
    SELECT f.doc_id, string_agg(r.name, ',' ORDER BY f.rule) AS names
    FROM figures f JOIN cutoffs c ON f.stratum IS NOT DISTINCT FROM c.stratum AND f.rule = c.rule JOIN rules r ON r.rule = f.rule
    WHERE f.v > c.cutoff GROUP BY f.doc_id
)
SELECT doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, base_failed,
    NOT base_failed AND names IS NULL AS kept,
    CASE WHEN base_failed THEN 'base' ELSE coalesce(names, '') END AS failed_rules
FROM judged LEFT JOIN broken USING (doc_id)
"""


def _word_table(name: str, key: str, table: str) -> str:
    """Words by place, with the seven that follow, and the seeds of all masks."""
    seeds = {0: (0, 1, 3, 4, 5), 1: (0, 1, 3, 5, 6), 2: (0, 1, 2, 5, 7)}
    parts = " UNION ALL ".join(
        f"SELECT {key}, i, {mask} AS mask, {" || '|' || ".join(f'w{p}' for p in places)} AS seed "
        f"FROM {name} WHERE w{places[-1]} IS NOT NULL"
        for mask, places in seeds.items()
    )
    following = ", ".join(f"lead(w0, {p}) OVER o AS w{p}" for p in range(1, 8))
    return rf"""
{name} AS (
    SELECT {key}, i, w0, {following} FROM (
        SELECT {key}, unnest(words) AS w0, generate_subscripts(words, 1) - 1 AS i FROM (
            SELECT {key}, regexp_extract_all(lower(coalesce(text, '')), '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS words
            FROM {table}))
    WINDOW o AS (PARTITION BY {key} ORDER BY i)
), {name}_seeds AS ({parts})"""


DECONTAMINATION = rf"""
WITH {_word_table("doc", "doc_id", "documents")}, {_word_table("item", "item_id", "benchmark")},
hits AS (
    SELECT DISTINCT doc_id, item_id, d.i - m.i AS diagonal FROM doc_seeds d JOIN item_seeds m USING (mask, seed)
), laid AS (
    SELECT h.doc_id, h.item_id, h.diagonal, list((d.w0 = m.w0)::INT ORDER BY m.i) AS equal
    FROM hits h JOIN item m ON m.item_id = h.item_id
    JOIN doc d ON d.doc_id = h.doc_id AND d.i = m.i + h.diagonal
    GROUP BY ALL
), sized AS (
    SELECT l.*, n AS n_item_words, least(n, 13) AS width
    FROM laid l JOIN (SELECT item_id, count(*) AS n FROM item GROUP BY item_id) USING (item_id)
), best AS (
    SELECT *, list_max([list_sum(equal[s:s + width - 1]) FOR s IN range(1, len(equal) - width + 2)]) / width AS best_window
    FROM sized WHERE len(equal) >= width
)
SELECT doc_id, item_id, greatest(diagonal, 0)::BIGINT AS first_word, list_sum(equal)::BIGINT AS n_equal,
    n_item_words::BIGINT AS n_item_words, best_window::DOUBLE AS best_window
FROM best WHERE best_window >= 0.8
QUALIFY row_number() OVER (PARTITION BY doc_id, item_id ORDER BY n_equal DESC, best_window DESC, first_word) = 1
"""

# crc32 by its definition, from a table made by rule.
TARGET_RESAMPLING = r"""
WITH crc_table AS (
    SELECT list(v ORDER BY i) AS t FROM (
        SELECT i, list_reduce(list_prepend(i, range(8)),
            lambda c, k: CASE WHEN c % 2 = 1 THEN xor(3988292384, c // 2) ELSE c // 2 END) AS v
        FROM range(256) AS r(i))
), words AS (
    SELECT 0 AS side, doc_id AS id, row_number() OVER () AS row_id, regexp_extract_all(translate(coalesce(text, ''),
        'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
        '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS w FROM documents
    UNION ALL
    SELECT 1, NULL, NULL, regexp_extract_all(translate(coalesce(text, ''),
        'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
        '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') FROM benchmark
), features AS (
    SELECT side, id, row_id, unnest(list_concat(w, list_transform(range(1, len(w)), lambda i: w[i] || ' ' || w[i + 1]))) AS f
    FROM words
), hashed AS (
    SELECT f, xor(list_reduce(list_prepend(4294967295::BIGINT,
            list_transform(range(1, octet_length(encode(f)) * 2, 2),
                lambda i: (16 * (strpos('0123456789ABCDEF', hex(encode(f))[i]) - 1)
                    + strpos('0123456789ABCDEF', hex(encode(f))[i + 1]) - 1)::BIGINT)),
            lambda c, b: xor(t[xor(c, b) % 256 + 1], c // 256)), 4294967295) % 10000 AS bucket
    FROM (SELECT DISTINCT f FROM features), crc_table
), counted AS (
    SELECT bucket, count(*) FILTER (WHERE side = 0) AS s, count(*) FILTER (WHERE side = 1) AS t
    FROM features JOIN hashed USING (f) GROUP BY bucket
), gains AS (
    SELECT bucket, floor(1000 * ln((t + 1)::DOUBLE * ((SELECT sum(s) FROM counted) + 10000)::DOUBLE
        / ((s + 1)::DOUBLE * ((SELECT sum(t) FROM counted) + 10000)::DOUBLE)))::BIGINT AS gain
    FROM counted
), sums AS (
    SELECT row_id, count(*) AS n_features, sum(gain)::BIGINT AS total
    FROM features JOIN hashed USING (f) JOIN gains USING (bucket) WHERE side = 0 GROUP BY row_id
), scored AS (
    SELECT w.id AS doc_id, len(w.w) AS n_words, coalesce(n_features, 0) AS n_features,
        coalesce(floor(total / n_features), 0)::BIGINT AS weight,
        floor(-1000 * ln(-ln((('0x' || sha256('7:' || coalesce(w.id::VARCHAR, ''))[1:8])::BIGINT + 0.5::DOUBLE)
            / 4294967296::DOUBLE)))::BIGINT AS noise
    FROM words w LEFT JOIN sums USING (row_id) WHERE side = 0
), ranked AS (
    SELECT doc_id, weight + noise AS score, row_number() OVER (ORDER BY weight + noise DESC, doc_id) AS rank
    FROM scored WHERE n_words >= 20
)
SELECT s.doc_id, s.n_features, s.weight, s.weight + s.noise AS score, r.rank
FROM scored s LEFT JOIN (
    SELECT * FROM ranked WHERE rank <= 25 * (SELECT count(*) FROM ranked) // 100
) r ON s.doc_id IS NOT DISTINCT FROM r.doc_id
"""

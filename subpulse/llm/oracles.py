"""DuckDB SQL for the text queries that SQL can express."""

MIX = r"""
WITH docs AS (
  SELECT doc_id, source, coalesce(len(regexp_extract_all(text, '[^\x20\x09-\x0D]+')), 0)::BIGINT AS size,
         ('0x' || substr(md5('mix:' || coalesce(doc_id::VARCHAR, '')), 1, 15))::BIGINT AS place
  FROM documents),
sizes AS (SELECT source, sum(size)::BIGINT AS source_size FROM docs GROUP BY source),
ranked AS (
  SELECT *, source_size * 2.0::DOUBLE AS cap, sum(source_size) OVER () * 1.5::DOUBLE AS budget,
         [5, 2, 1][(row_number() OVER (ORDER BY source NULLS LAST) - 1) % 3 + 1] AS weight
  FROM sizes),
filled AS (
  SELECT *, cap * sum(weight) OVER (ORDER BY cap / weight, source NULLS LAST
                                    ROWS BETWEEN CURRENT ROW AND UNBOUNDED FOLLOWING)
            <= weight * (budget - coalesce(sum(cap) OVER (ORDER BY cap / weight, source NULLS LAST
                                    ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0)) AS is_full
  FROM ranked),
targets AS (
  SELECT source, source_size,
         CASE WHEN is_full THEN cap
              ELSE weight * ((budget - sum(CASE WHEN is_full THEN cap ELSE 0 END) OVER ())
                             / sum(CASE WHEN is_full THEN 0 ELSE weight END) OVER ())::DOUBLE END AS target
  FROM filled),
plan AS (
  SELECT *, CASE WHEN source_size = 0 THEN 0 ELSE floor(target / source_size)::BIGINT END AS whole FROM targets),
budgets AS (SELECT *, target - whole * source_size AS rest FROM plan),
places AS (SELECT source, place, sum(size) AS words FROM docs GROUP BY source, place),
upto AS (SELECT *, sum(words) OVER (PARTITION BY source ORDER BY place) AS upto FROM places),
ends AS (
  SELECT u.source, u.place AS threshold, 2 * (b.rest - (u.upto - u.words)) >= u.words AS with_last
  FROM upto u JOIN budgets b ON u.source IS NOT DISTINCT FROM b.source
  WHERE b.rest > 0 AND u.upto >= b.rest AND u.upto - u.words < b.rest)
SELECT d.doc_id, d.size, b.source_size, b.target::DOUBLE AS target,
       (d.size * (b.whole + CASE WHEN d.place < e.threshold OR (d.place = e.threshold AND e.with_last)
                                 THEN 1 ELSE 0 END))::BIGINT AS taken
FROM docs d JOIN budgets b ON d.source IS NOT DISTINCT FROM b.source
LEFT JOIN ends e ON d.source IS NOT DISTINCT FROM e.source
"""

DEDUP = r"""
WITH docs AS (
  SELECT doc_id, sha256(regexp_replace(coalesce(text, ''), '[\x20\x09-\x0D]+', ' ', 'g')) AS text_sha256,
         row_number() OVER (ORDER BY doc_id) AS row_id
  FROM documents)
SELECT doc_id, min(doc_id) OVER same AS keep_id, count(*) OVER same AS group_size,
       row_number() OVER (PARTITION BY text_sha256 ORDER BY doc_id NULLS LAST, row_id) = 1 AS kept, text_sha256
FROM docs WINDOW same AS (PARTITION BY text_sha256)
"""

QUALITY = r"""
WITH docs AS (
  SELECT doc_id, coalesce(text, '') AS text FROM documents),
parts AS (
  SELECT doc_id, text, regexp_extract_all(text, '[^\x20\x09-\x0D]+') AS words,
         [l FOR l IN string_split(text, chr(10)) IF regexp_matches(l, '[^\x20\x09-\x0D]')] AS lines
  FROM docs),
wins AS (
  SELECT doc_id, i, words[i:i + 7] AS win FROM (SELECT doc_id, words, unnest(range(1, len(words) - 6)) AS i FROM parts)),
twins AS (SELECT doc_id, i FROM wins QUALIFY count(*) OVER (PARTITION BY doc_id, win) > 1),
covered AS (
  SELECT doc_id, count(DISTINCT i + j)::BIGINT AS n FROM twins, (SELECT unnest(range(0, 8)) AS j) GROUP BY doc_id),
counts AS (
  SELECT p.doc_id, p.text, len(words)::BIGINT AS n_words,
         length(regexp_replace(text, '[\x20\x09-\x0D]+', '', 'g'))::BIGINT AS word_chars,
         length(regexp_replace(text, '[^#*$%&|<>]+', '', 'g'))::BIGINT AS n_symbols,
         (len(lines) - len(list_distinct(lines)))::BIGINT AS n_dup_lines, coalesce(c.n, 0) AS n_repeat_words,
         len(regexp_extract_all(text, '[^\n]+')) AS n_lines,
         length(regexp_replace(text, '[^\p{Lu}]+', '', 'g')) AS capitals,
         length(regexp_replace(text, '[^\p{L}]+', '', 'g')) AS letters,
         length(regexp_replace(text, '[^\p{L}\p{M}]+', '', 'g')) AS marked_letters,
         len(regexp_extract_all(text, '(?m)^[ \t]*[-*•>|]')) AS marked_lines
  FROM parts p LEFT JOIN covered c ON p.doc_id = c.doc_id),
base AS (
  SELECT *, n_words < 20 OR 100 * n_repeat_words > 30 * n_words AS base_failed FROM counts)
SELECT doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, base_failed,
       NOT (base_failed OR word_chars < n_words * 2.0 OR word_chars > n_words * 16.0
            OR n_symbols > 0.1::DOUBLE * word_chars OR n_dup_lines / n_lines > 0.3::DOUBLE
            OR capitals / greatest(letters, 1) > 0.7::DOUBLE OR marked_letters / greatest(word_chars, 1) < 0.6::DOUBLE
            OR marked_lines / n_lines > 0.9::DOUBLE) AS kept
FROM base
"""

# crc32 of the UTF-8 bytes: the table by its rule, one lookup a byte
CRC_TABLE = r"""
crc_table AS (
  SELECT list(list_reduce(list_prepend(i::BIGINT, range(8)),
                          lambda c, _: CASE WHEN c & 1 = 1 THEN xor(c >> 1, 3988292384) ELSE c >> 1 END) ORDER BY i) AS crcs
  FROM range(256) AS t(i))"""


def crc_of(text: str) -> str:
    """SQL for the crc32 of ``text``; ``crcs`` is in scope."""
    codes = f"[('0x' || hex(encode({text}))[2 * k + 1:2 * k + 2])::BIGINT FOR k IN range(length(hex(encode({text}))) // 2)]"
    return (f"xor(4294967295, list_reduce(list_prepend(4294967295::BIGINT, {codes}), "
            "lambda c, b: xor(c >> 8, crcs[(xor(c, b) & 255) + 1])))")


LOWER = "translate({}, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz')"
PLAIN_WORDS = f"regexp_extract_all({LOWER.format('text')}, '[^\\x00-\\x2F\\x3A-\\x60\\x7B-\\x7F]+')"

IMPORTANCE = rf"""
WITH {CRC_TABLE.strip()},
texts AS (
  SELECT row_number() OVER () AS row_id, doc_id, coalesce({PLAIN_WORDS}, []) AS words FROM documents),
item_words AS (SELECT unnest({PLAIN_WORDS}) AS word FROM benchmark),
doc_words AS (SELECT row_id, unnest(words) AS word FROM texts),
known AS (SELECT word, {crc_of("word")} % 10000 AS bucket
          FROM (SELECT word FROM doc_words UNION SELECT word FROM item_words), crc_table),
s AS (SELECT bucket, count(*) AS n FROM doc_words JOIN known USING (word) GROUP BY bucket),
t AS (SELECT bucket, count(*) AS n FROM item_words JOIN known USING (word) GROUP BY bucket),
gains AS (
  SELECT b AS bucket,
         floor(1000 * ln((coalesce(t.n, 0) + 1.0::DOUBLE) * ((SELECT count(*) FROM doc_words) + 10000.0::DOUBLE)
               / ((coalesce(s.n, 0) + 1.0::DOUBLE) * ((SELECT count(*) FROM item_words) + 10000.0::DOUBLE))))::BIGINT AS gain
  FROM range(10000) AS r(b) LEFT JOIN s ON s.bucket = b LEFT JOIN t ON t.bucket = b),
weights AS (
  SELECT row_id, floor(sum(gain) / count(*))::BIGINT AS weight
  FROM doc_words JOIN known USING (word) JOIN gains USING (bucket) GROUP BY row_id),
scores AS (
  SELECT row_id, doc_id, len(words)::BIGINT AS n_features, coalesce(weight, 0) AS weight,
         coalesce(weight, 0) + floor(-1000 * ln(-ln(
           (('0x' || substr(sha256('2024:' || coalesce(doc_id::VARCHAR, '')), 1, 8))::BIGINT + 0.5::DOUBLE)
           / 4294967296.0::DOUBLE)))::BIGINT AS score
  FROM texts LEFT JOIN weights USING (row_id)),
places AS (
  SELECT row_id, row_number() OVER (ORDER BY score DESC, doc_id NULLS LAST, n_features) AS place, count(*) OVER () AS n
  FROM scores WHERE n_features >= 20)
SELECT doc_id, n_features, weight, score, CASE WHEN place <= 10 * n // 100 THEN place END AS rank
FROM scores LEFT JOIN places USING (row_id)
"""

CLEAN = rf"""
WITH texts AS (
  SELECT row_number() OVER () AS row_id, doc_id, coalesce({PLAIN_WORDS}, []) AS words FROM documents),
items AS (SELECT coalesce(item_id::VARCHAR, '') AS item, {PLAIN_WORDS} AS words FROM benchmark),
windows AS (
  SELECT DISTINCT item, least(len(words), 10) AS size, unnest([array_to_string(words[k:k + least(len(words), 10) - 1], ' ')
         FOR k IN range(1, greatest(len(words) - 9, 1) + 1)]) AS win
  FROM items WHERE len(words) > 0),
sizes AS (SELECT DISTINCT size FROM windows),
starts AS (
  SELECT row_id, size, unnest(range(1, len(words) - size + 2)) AS k, words FROM texts, sizes WHERE len(words) >= size),
hits AS (
  SELECT row_id, k, s.size, item
  FROM (SELECT row_id, size, k, array_to_string(words[k:k + size - 1], ' ') AS win FROM starts) s
  JOIN windows w ON s.win = w.win AND s.size = w.size),
covered AS (
  SELECT row_id, count(DISTINCT place)::BIGINT AS n_hit
  FROM (SELECT row_id, unnest(range(k, k + size)) AS place FROM hits) GROUP BY row_id),
met AS (
  SELECT row_id, count(*)::BIGINT AS n_items, string_agg(item, ',' ORDER BY item) AS items
  FROM (SELECT DISTINCT row_id, item FROM hits) GROUP BY row_id)
SELECT doc_id, len(words)::BIGINT AS n_words, coalesce(n_hit, 0) AS n_hit, coalesce(n_items, 0) AS n_items,
       sha256(coalesce(items, '')) AS items_sha256, coalesce(n_hit, 0) > 0 AS contaminated
FROM texts LEFT JOIN covered USING (row_id) LEFT JOIN met USING (row_id)
"""


def _leaf(text: str) -> str:
    return "sha256(" + " || ".join(
        f"coalesce(octet_length(encode({c}::VARCHAR)) || ':' || {c}::VARCHAR, '-')"
        for c in ("doc_id", "source", "lang", "n_chars", text)) + ")"


MANIFEST = rf"""
WITH RECURSIVE {CRC_TABLE.strip()},
raw AS (
  SELECT doc_id, lang, {_leaf("text")} AS leaf, {_leaf(LOWER.format("text"))} AS changed,
         {crc_of("coalesce(doc_id::VARCHAR, '')")} % 3 = 0 AS tampered
  FROM documents, crc_table),
leaves AS (
  SELECT *, dense_rank() OVER (ORDER BY lang NULLS FIRST) - 1 AS tree,
         row_number() OVER (PARTITION BY lang ORDER BY doc_id NULLS FIRST, leaf) - 1 AS spot,
         count(*) OVER (PARTITION BY lang) AS width
  FROM raw),
nodes(tree, level, spot, width, digest) AS (
  SELECT tree, 0, spot, width, leaf FROM leaves
  UNION ALL
  SELECT tree, any_value(level) + 1, spot // 8, (any_value(width) + 7) // 8, sha256(string_agg(digest, '' ORDER BY spot))
  FROM nodes WHERE width > 1 GROUP BY tree, spot // 8),
subroots AS (SELECT tree, level AS height, digest FROM nodes WHERE width = 1),
tops(level, spot, width, digest) AS (
  SELECT 0, tree, count(*) OVER (), digest FROM subroots
  UNION ALL
  SELECT any_value(level) + 1, spot // 8, (any_value(width) + 7) // 8, sha256(string_agg(digest, '' ORDER BY spot))
  FROM tops WHERE width > 1 GROUP BY spot // 8),
root AS (SELECT digest AS root FROM tops WHERE width = 1),
beside AS (
  SELECT n.tree, n.level, n.spot, coalesce(string_agg(o.digest, '' ORDER BY o.spot) FILTER (o.spot < n.spot), '') AS lefts,
         coalesce(string_agg(o.digest, '' ORDER BY o.spot) FILTER (o.spot > n.spot), '') AS rights
  FROM nodes n JOIN nodes o ON n.tree = o.tree AND n.level = o.level AND n.spot // 8 = o.spot // 8
  WHERE n.width > 1 GROUP BY n.tree, n.level, n.spot),
top_beside AS (
  SELECT n.level, n.spot, coalesce(string_agg(o.digest, '' ORDER BY o.spot) FILTER (o.spot < n.spot), '') AS lefts,
         coalesce(string_agg(o.digest, '' ORDER BY o.spot) FILTER (o.spot > n.spot), '') AS rights
  FROM tops n JOIN tops o ON n.level = o.level AND n.spot // 8 = o.spot // 8
  WHERE n.width > 1 GROUP BY n.level, n.spot),
ways AS (
  SELECT l.tree, l.spot AS leaf_at, b.level AS step, b.lefts, b.rights
  FROM leaves l JOIN beside b ON l.tree = b.tree AND b.spot = l.spot // (8 ** b.level)::BIGINT
  UNION ALL
  SELECT l.tree, l.spot, s.height + b.level, b.lefts, b.rights
  FROM leaves l JOIN subroots s ON l.tree = s.tree JOIN top_beside b ON b.spot = l.tree // (8 ** b.level)::BIGINT),
proofs AS (
  SELECT tree, leaf_at, list(lefts ORDER BY step) AS lefts, list(rights ORDER BY step) AS rights,
         string_agg(lefts || rights, '' ORDER BY step) AS siblings
  FROM ways GROUP BY tree, leaf_at),
fold(tree, spot, step, digest, lefts, rights) AS (
  SELECT l.tree, l.spot, 0, CASE WHEN tampered THEN changed ELSE leaf END, coalesce(lefts, []), coalesce(rights, [])
  FROM leaves l LEFT JOIN proofs p ON l.tree = p.tree AND l.spot = p.leaf_at
  UNION ALL
  SELECT tree, spot, step + 1, sha256(lefts[step + 1] || digest || rights[step + 1]), lefts, rights
  FROM fold WHERE step < len(lefts))
SELECT l.doc_id, l.leaf, s.digest AS subroot, root, sha256(coalesce(p.siblings, '')) AS proof_sha256,
       f.digest AS folded_root, f.digest = root AS verified
FROM leaves l JOIN subroots s ON l.tree = s.tree JOIN fold f ON f.tree = l.tree AND f.spot = l.spot AND f.step = len(f.lefts)
LEFT JOIN proofs p ON p.tree = l.tree AND p.leaf_at = l.spot, root
"""

ORACLES = {"op1_mix_sources": MIX, "op4_exact_dedup": DEDUP, "op5_quality_rules": QUALITY,
           "op11_importance_resampling": IMPORTANCE, "op12_decontamination": CLEAN, "op13_merkle_manifest": MANIFEST}

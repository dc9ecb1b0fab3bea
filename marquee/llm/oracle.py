"""SQL for the queries of this package that SQL can express."""

ORACLE_SQL: dict[str, str] = {}

_WORDS = r"[^\x20\x09-\x0D]+"

#: Targets in closed form: the sources by how soon they are full; the first so many are, and the rest share what is left.
ORACLE_SQL["op6_mixing"] = rf"""
WITH docs AS (
  SELECT doc_id, CASE WHEN source IS NULL THEN 'b' ELSE 'a' || source END AS k, md5(coalesce(CAST(doc_id AS VARCHAR), '')) AS h,
         CAST(coalesce(len(regexp_extract_all(text, '{_WORDS}')), 0) AS BIGINT) AS size
  FROM documents
), totals AS (
  SELECT k, CAST(sum(size) AS BIGINT) AS s, row_number() OVER (ORDER BY encode(k)) AS r FROM docs GROUP BY k
), weighted AS (
  SELECT k, s, r, CASE (r - 1) % 3 WHEN 0 THEN 5 WHEN 1 THEN 2 ELSE 1 END AS w, sum(s) OVER () * 1.5 AS wanted FROM totals
), filled AS (
  SELECT *, 2.0 * s / w AS level, row_number() OVER (ORDER BY 2.0 * s / w, r) AS n,
         CAST(wanted AS DOUBLE) - CAST(coalesce(sum(2 * s) OVER (ORDER BY 2.0 * s / w, r ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS DOUBLE) AS left_over,
         sum(w) OVER (ORDER BY 2.0 * s / w DESC, r DESC ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW) AS weight_left
  FROM weighted
), share AS (
  SELECT arg_min(left_over / weight_left, n) AS share FROM filled WHERE left_over / weight_left <= level
), goals AS (
  SELECT k, s, r, least(share * w, 2.0 * s) AS target, CAST(floor(least(share * w, 2.0 * s) + 0.5) AS BIGINT) AS aim
  FROM filled, share
), placed AS (
  SELECT doc_id, size, s, target, aim,
         coalesce(sum(size) OVER (PARTITION BY k ORDER BY h, size ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS start
  FROM docs JOIN goals USING (k)
)
SELECT doc_id, size, s AS source_size, target,
       CAST(greatest(0, least(size, aim - start)) + greatest(0, least(size, aim - start - s)) AS BIGINT) AS taken
FROM placed
"""

ORACLE_SQL["op5_warc"] = """
WITH p AS (
  SELECT page_id, encode(coalesce(html, '')) AS body FROM pages
), sized AS (
  SELECT page_id, octet_length(body) AS payload_bytes, sha256(body) AS payload_digest FROM p
), firsts AS (
  SELECT payload_digest, min(page_id) AS first FROM sized GROUP BY payload_digest
)
SELECT page_id, CAST(payload_bytes AS BIGINT) AS payload_bytes, payload_digest,
       CASE WHEN payload_bytes >= 100 AND page_id > first THEN 'revisit' ELSE 'response' END AS record_type,
       CASE WHEN payload_bytes >= 100 AND page_id > first THEN first END AS refers_to
FROM sized JOIN firsts USING (payload_digest)
"""

_LENGTHS = {5: 0.30, 6: 0.28, 7: 0.26, 8: 0.24, 9: 0.22, 10: 0.20}


def _grams() -> str:
    """Characters of the words in n-grams that come twice in a text, and for n = 8 the words."""
    gram = {n: " || ' ' || ".join(["word", *(f"lead(word, {k}) OVER d" for k in range(1, n))]) for n in _LENGTHS}
    starts = ", ".join(f"{text} AS g{n}" for n, text in gram.items())
    twice = ", ".join(f"CASE WHEN g{n} IS NOT NULL AND count(*) OVER (PARTITION BY doc_id, g{n}) > 1 THEN 1 ELSE 0 END AS t{n}"
                      for n in _LENGTHS)
    inside = ", ".join(f"max(t{n}) OVER (PARTITION BY doc_id ORDER BY pos ROWS BETWEEN {n - 1} PRECEDING AND CURRENT ROW) AS i{n}"
                       for n in _LENGTHS)
    sums = ", ".join(f"sum(i{n} * len(word)) AS c{n}" for n in _LENGTHS)
    return f"""
grams AS (SELECT doc_id, pos, word, {starts} FROM words WINDOW d AS (PARTITION BY doc_id ORDER BY pos)),
twice AS (SELECT doc_id, pos, word, {twice} FROM grams),
inside AS (SELECT doc_id, word, {inside} FROM twice),
counted AS (SELECT doc_id, count(*) AS n_words, sum(len(word)) AS word_chars, sum(i8) AS n_repeat_words, {sums}
            FROM inside GROUP BY doc_id)"""


ORACLE_SQL["op3_quality"] = rf"""
WITH docs AS (SELECT doc_id, coalesce(text, '') AS text FROM documents),
listed AS (SELECT doc_id, regexp_extract_all(text, '{_WORDS}') AS all_words FROM docs),
words AS (SELECT doc_id, unnest(all_words) AS word, generate_subscripts(all_words, 1) AS pos FROM listed),{_grams()},
lines AS (
  SELECT doc_id, line, count(*) AS n, len(regexp_replace(line, '[\x20\x09-\x0D]', '', 'g')) AS chars
  FROM (SELECT doc_id, unnest(string_split(text, chr(10))) AS line FROM docs)
  WHERE regexp_matches(line, '{_WORDS}') GROUP BY doc_id, line
), by_line AS (
  SELECT doc_id, sum(n) AS n_lines, sum(n - 1) AS n_dup_lines, sum((n - 1) * chars) AS dup_chars FROM lines GROUP BY doc_id
), joined AS (
  SELECT doc_id, CAST(coalesce(n_words, 0) AS BIGINT) AS n_words, CAST(coalesce(word_chars, 0) AS BIGINT) AS word_chars,
         CAST(len(regexp_replace(text, '[^#*$%&|<>]', '', 'g')) AS BIGINT) AS n_symbols,
         CAST(coalesce(n_dup_lines, 0) AS BIGINT) AS n_dup_lines, CAST(coalesce(n_repeat_words, 0) AS BIGINT) AS n_repeat_words,
         coalesce(n_lines, 0) AS n_lines, coalesce(dup_chars, 0) AS dup_chars,
         {", ".join(f"coalesce(c{n}, 0) > {limit} * word_chars AS over{n}" for n, limit in _LENGTHS.items())}
  FROM docs LEFT JOIN counted USING (doc_id) LEFT JOIN by_line USING (doc_id)
)
SELECT doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words,
       n_words < 20 OR 100 * n_repeat_words > 30 * n_words AS base_failed,
       NOT (n_words < 20 OR 100 * n_repeat_words > 30 * n_words) AND NOT (
         n_dup_lines > 0.30 * n_lines OR dup_chars > 0.20 * word_chars OR n_symbols > 0.2 * n_words
         OR {" OR ".join(f"over{n}" for n in _LENGTHS)}) AS kept
FROM joined
"""

#: Turns in order, then digests of what was to be read back; every turn is written with 14 characters around it.
ORACLE_SQL["op11_chat"] = r"""
WITH given AS (
  SELECT conv_id, turn, coalesce(role, '') AS role, coalesce(text, '') AS text FROM conversations
  UNION ALL SELECT -7, 0, 'user', '\### Assistant: </turn> ok'
  UNION ALL SELECT -7, 1, 'assistant', '\### Assistant: </turn> ok'
), told AS (
  SELECT conv_id, count(*) AS n_turns, string_agg(role || chr(10) || text || chr(10), '' ORDER BY turn NULLS FIRST, role, text) AS turns,
         coalesce(string_agg(text, '' ORDER BY turn NULLS FIRST, text) FILTER (role = 'assistant'), '') AS loss,
         sum(14 + length(regexp_replace(role, '(\\|###|</turn>|<\||:)', '\\\1', 'g'))
             + length(regexp_replace(text, '(\\|###|</turn>|<\|)', '\\\1', 'g'))) AS formatted_chars
  FROM given GROUP BY conv_id
)
SELECT conv_id, n_turns, sha256(turns) AS turns_sha256, CAST(length(loss) AS BIGINT) AS loss_chars, sha256(loss) AS loss_sha256,
       CAST(formatted_chars AS BIGINT) AS formatted_chars, CAST(0 AS BIGINT) AS n_attachments, CAST(0 AS BIGINT) AS expanded_tokens
FROM told
"""

ORACLE_SQL["op12_hard_negatives"] = """
WITH rows AS (
  SELECT DISTINCT vec_id, CASE WHEN vec_id % 7 = 0 THEN (label + 1) % 10 ELSE label END AS label,
         list_transform(embedding, lambda x: floor(256 * CAST(x AS DOUBLE))) AS q
  FROM embeddings
  WHERE vec_id IS NOT NULL AND label IS NOT NULL AND embedding IS NOT NULL
    AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0
), scored AS (
  SELECT a.vec_id AS anchor, b.vec_id AS other, a.label = b.label AS same, CAST(list_dot_product(a.q, b.q) AS BIGINT) AS score
  FROM rows a JOIN rows b ON a.vec_id % 50 = 0 AND a.vec_id <> b.vec_id
), positives AS (
  SELECT anchor, other, score FROM scored WHERE same
  QUALIFY row_number() OVER (PARTITION BY anchor ORDER BY score DESC, other) <= 5
)
SELECT p.anchor AS anchor_id, p.other AS positive_id,
       CAST(row_number() OVER (PARTITION BY p.anchor, p.other ORDER BY s.score DESC, s.other) AS INTEGER) AS rank,
       s.other AS negative_id, p.score AS positive_score, s.score AS negative_score
FROM positives p JOIN scored s ON s.anchor = p.anchor AND NOT s.same AND 100 * s.score BETWEEN 50 * p.score AND 95 * p.score
QUALIFY rank <= 3
"""

#: A checksum of the decimal number, bit by bit.
_CRC32 = """xor(4294967295, list_reduce(
  list_prepend(CAST(4294967295 AS BIGINT), list_transform(string_split(CAST({0} AS VARCHAR), ''), lambda x: CAST(ascii(x) AS BIGINT))),
  lambda a, b: list_reduce([xor(a, b), 0, 0, 0, 0, 0, 0, 0, 0], lambda c, d: xor(c >> 1, 3988292384 * (c & 1)))))"""

#: A node is the digests of its turns end to end; the nodes above it are those on the path of its smallest member.
ORACLE_SQL["op13_prefix_trie"] = rf"""
WITH told AS (
  SELECT conv_id AS c, turn, md5(length(coalesce(role, '')) || ':' || coalesce(role, '') || coalesce(text, '')) AS digest,
         coalesce(len(regexp_extract_all(text, '{_WORDS}')), 0) AS words
  FROM conversations WHERE conv_id IS NOT NULL
), numbered AS (
  SELECT c, digest, words, row_number() OVER (PARTITION BY c ORDER BY turn NULLS FIRST, digest) AS pos FROM told
), convs AS (
  SELECT c, c - c % 20 AS base, {_CRC32.format("c")} % 4 AS h FROM (SELECT DISTINCT c FROM told)
), rebuilt AS (
  SELECT c, -1 AS part, 0 AS pos, '' AS digest, 0 AS words FROM convs
  UNION ALL SELECT v.c, 0, n.pos, n.digest, n.words FROM convs v JOIN numbered n ON n.c = v.base AND n.pos <= v.h
  UNION ALL SELECT v.c, 1, n.pos, n.digest, n.words FROM convs v JOIN numbered n ON n.c = v.c AND n.pos > v.h
), paths AS (
  SELECT c, words, row_number() OVER o - 1 AS depth, string_agg(digest, '') OVER o AS key,
         lead(c) OVER o IS NULL AS last
  FROM rebuilt WINDOW o AS (PARTITION BY c ORDER BY part, pos)
), nodes AS (
  SELECT key, depth, min(c) AS conv_id, count(*) AS n, any_value(words) AS words,
         coalesce(string_agg(CAST(c AS VARCHAR), ',' ORDER BY c) FILTER (last), '') AS ended
  FROM paths GROUP BY key, depth
), children AS (
  SELECT left(key, length(key) - 32) AS key, count(*) AS n FROM nodes WHERE depth > 0 GROUP BY 1
), sums AS (
  SELECT a.key, sum((v.n - 1) * v.words) AS saved, count_if(k.n IS NULL) AS leaves
  FROM nodes v JOIN paths a ON a.c = v.conv_id AND a.depth <= v.depth LEFT JOIN children k ON k.key = v.key GROUP BY a.key
)
SELECT v.conv_id, v.depth, p.conv_id AS parent_conv_id, v.n AS n_convs, coalesce(k.n, 0) AS n_children,
       CAST(s.leaves AS BIGINT) AS n_leaves, CAST(s.saved AS BIGINT) AS saved_tokens, sha256(v.ended) AS ends_sha256
FROM nodes v JOIN sums s USING (key) LEFT JOIN children k USING (key)
LEFT JOIN nodes p ON v.depth > 0 AND p.key = left(v.key, length(v.key) - 32)
"""

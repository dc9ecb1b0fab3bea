"""The SQL that states each query of ``queries.py`` on the same tables."""

from __future__ import annotations

_ACTING = "l_returnflag IN ('A', 'R')"

_BEST = f"""
best AS (
  SELECT l_suppkey AS person_id, p_name AS original_title, max(CAST(p_size AS DOUBLE)) AS rating
  FROM lineitem JOIN part ON l_partkey = p_partkey
  WHERE {_ACTING} AND p_name <> '' AND p_size <> 0
  GROUP BY 1, 2),
ranked AS (
  SELECT *, CAST(row_number() OVER (PARTITION BY person_id ORDER BY rating DESC, original_title) AS INTEGER) AS rank
  FROM best),
summary AS (
  SELECT person_id, count(*) AS total,
         max(CASE WHEN rank = 1 THEN original_title END) AS top1,
         max(CASE WHEN rank = 2 THEN original_title END) AS top2,
         max(CASE WHEN rank = 3 THEN original_title END) AS top3
  FROM ranked GROUP BY 1),
pages AS (
  SELECT coalesce(s_suppkey, person_id) AS person_id, s_name AS name, s_nationkey AS birth,
         nullif(s_nationkey, 0) AS death, coalesce(total, 0) AS total, top1, top2, top3
  FROM supplier FULL JOIN summary ON s_suppkey = person_id)
"""

_LINES = """
placed AS (
  SELECT person_id, 1 AS place, 'Name: ' || coalesce(name, '') AS line FROM pages
  UNION ALL SELECT person_id, 2, 'Birth: ' || coalesce(CAST(birth AS VARCHAR), '----') FROM pages
  UNION ALL SELECT person_id, 3, 'Death: ' || coalesce(CAST(death AS VARCHAR), '----') FROM pages
  UNION ALL SELECT person_id, 4, 'Number of movies: ' || total FROM pages
  UNION ALL SELECT person_id, 5, '#1 => ' || top1 FROM pages WHERE top1 IS NOT NULL
  UNION ALL SELECT person_id, 6, '#2 => ' || top2 FROM pages WHERE top2 IS NOT NULL
  UNION ALL SELECT person_id, 7, '#3 => ' || top3 FROM pages WHERE top3 IS NOT NULL),
lines AS (
  SELECT person_id, CAST(row_number() OVER (PARTITION BY person_id ORDER BY place) - 1 AS INTEGER) AS line_no, line
  FROM placed)
"""

_TOP10 = """
WITH counts AS (
  SELECT l_suppkey AS person_id, {count} AS n FROM lineitem WHERE {acting} GROUP BY 1),
top AS (
  SELECT CAST(row_number() OVER (ORDER BY n DESC, person_id) AS INTEGER) AS rank, person_id, n
  FROM counts ORDER BY n DESC, person_id LIMIT 10)
SELECT rank, person_id, s_name AS name, n FROM top LEFT JOIN supplier ON s_suppkey = person_id
"""

_PAIRS = f"""
casting AS (SELECT DISTINCT l_orderkey AS title_id, l_suppkey AS person_id FROM lineitem WHERE {_ACTING}),
strength AS (
  SELECT a.person_id, b.person_id AS other_id, count(*) AS shared_titles
  FROM casting a JOIN casting b ON a.title_id = b.title_id AND a.person_id <> b.person_id
  GROUP BY 1, 2)
"""

_MERGED = """
stored AS (
  SELECT l_partkey AS title_id, CAST(sum(CAST(l_quantity AS BIGINT)) AS BIGINT) AS s, count(*) AS n
  FROM lineitem WHERE l_linestatus = 'F' GROUP BY 1),
added AS (
  SELECT l_partkey AS title_id, CAST(sum(CAST(l_quantity AS BIGINT)) AS BIGINT) AS vote_sum, count(*) AS vote_count
  FROM lineitem WHERE l_linestatus = 'O' GROUP BY 1)
"""

_VOTES = """
votes AS (
  SELECT user_id AS title_id, CAST(round(value * 100) AS BIGINT) AS rating, ts FROM events),
finished AS (SELECT max(ts) - INTERVAL 10 MINUTE AS up_to FROM votes)
"""

_MEANS = f"""
{_VOTES},
means AS (
  SELECT w AS window_start, w + INTERVAL 10 HOUR AS window_end, title_id,
         CAST(sum(rating) AS BIGINT) / count(*) AS mean_vote, count(*) AS n_votes
  FROM (SELECT title_id, rating, date_trunc('hour', ts) - to_hours(CAST(i AS INTEGER)) AS w
        FROM votes CROSS JOIN range(10) AS r(i))
  GROUP BY 1, 2, 3)
"""
_TOP3 = f"""
{_MEANS},
ranked AS (
  SELECT window_start, window_end, title_id, c_name AS original_title, mean_vote,
         CAST(row_number() OVER (PARTITION BY window_end ORDER BY mean_vote DESC, title_id) AS INTEGER) AS rank
  FROM means JOIN customer ON c_custkey = title_id)
"""
_FINISHED = "window_end <= (SELECT up_to FROM finished)"

_PERIODS = f"""
{_VOTES},
counts AS (
  SELECT date_trunc('day', ts) AS period_start, date_trunc('day', ts) + INTERVAL 1 DAY AS period_end,
         title_id, count(*) AS n_votes
  FROM votes GROUP BY 1, 2, 3),
rising AS (
  SELECT c.*, coalesce(p.n_votes, 0) AS previous_votes
  FROM counts c LEFT JOIN counts p ON p.title_id = c.title_id AND p.period_end = c.period_start
  WHERE c.n_votes > coalesce(p.n_votes, 0))
"""

_MINUTE = "strftime(ts, '%d-%m-%Y %H-%M')"
_LOT = "strftime(date_trunc('day', ts), '%Y-%m-%d %H-%M')"


def _hashed(text: str) -> str:
    return f"CAST('0x' || substr(md5({text}), 1, 15) AS BIGINT)"


_COUNTS_FINISHED = f"WITH {_PERIODS} SELECT * FROM counts WHERE period_end <= (SELECT up_to FROM finished)"
_CREDITED = f"""
SELECT l_partkey AS title_id, l_suppkey AS person_id, p_name AS original_title, CAST(p_size AS DOUBLE) AS rating
FROM lineitem JOIN part ON l_partkey = p_partkey
WHERE {_ACTING} AND p_name <> '' AND p_size <> 0"""
_STORED_PAGES = f"""
WITH {_BEST}
SELECT CAST(person_id AS VARCHAR) AS person_id, name, birth, death, total, top1, top2, top3 FROM pages"""
_TOP3_FINISHED = f"WITH {_TOP3} SELECT * FROM ranked WHERE rank <= 3 AND {_FINISHED}"
_TRENDING_FINISHED = f"""
WITH {_PERIODS}
SELECT rising.*, c_name AS original_title FROM rising JOIN customer ON c_custkey = title_id
WHERE period_end <= (SELECT up_to FROM finished)"""


ORACLE_SQL = {
    "acting_credits": f"SELECT l_orderkey AS title_id, l_suppkey AS person_id FROM lineitem WHERE {_ACTING}",
    "title_details": """
SELECT p_partkey AS title_id, p_name AS original_title,
       CAST(unnest(range(1, len(string_split(p_name, ' ')) + 1)) AS INTEGER) AS genre_no,
       unnest(string_split(p_name, ' ')) AS genre
FROM part""",
    "person_details": """
SELECT s_suppkey AS person_id, s_name AS name, s_nationkey AS birth,
       coalesce(CAST(nullif(s_nationkey, 0) AS VARCHAR), '----') AS death
FROM supplier""",
    "credited_rated_titles": _CREDITED,
    "stored_rated_titles": _CREDITED,
    "person_title_best": f"WITH {_BEST} SELECT * FROM best",
    "person_top3_titles": f"WITH {_BEST} SELECT * FROM ranked WHERE rank <= 3",
    "person_title_total": f"WITH {_BEST} SELECT person_id, total FROM summary",
    "person_pages": f"WITH {_BEST} SELECT * FROM pages",
    "person_page_lines": f"WITH {_BEST}, {_LINES} SELECT * FROM lines",
    "person_page_lookup": f"WITH {_BEST}, {_LINES} SELECT * FROM lines WHERE person_id = 7",
    "top10_people_by_titles": _TOP10.format(count="count(DISTINCT l_orderkey)", acting=_ACTING),
    "top10_people_by_credits": _TOP10.format(count="count(*)", acting=_ACTING),
    "collaborator_pairs": f"WITH {_PAIRS} SELECT person_id, other_id FROM strength",
    "collaborator_sets": f"""
WITH {_PAIRS},
parts AS (
  SELECT person_id, other_id, {_hashed("CAST(other_id AS VARCHAR)")} % 16 AS part FROM strength)
SELECT person_id, part, string_agg(CAST(other_id AS VARCHAR), ',' ORDER BY other_id) AS others
FROM parts GROUP BY 1, 2""",
    "collaborator_strength": f"WITH {_PAIRS} SELECT * FROM strength",
    "new_vote_totals": f"WITH {_MERGED} SELECT * FROM added",
    "ratings_merge": f"""
WITH {_MERGED}
SELECT title_id,
       CASE WHEN vote_count IS NULL THEN s / n ELSE (s / n * n + vote_sum) / (n + vote_count) END AS mean,
       n + coalesce(vote_count, 0) AS votes
FROM stored LEFT JOIN added USING (title_id)""",
    "ratings_merge_tsv": f"""
WITH {_MERGED},
whole AS (
  SELECT title_id, s + coalesce(vote_sum, 0) AS total, n + coalesce(vote_count, 0) AS votes
  FROM stored LEFT JOIN added USING (title_id)),
tenths AS (SELECT title_id, votes, (20 * total + votes) // (2 * votes) AS t FROM whole),
shown AS (
  SELECT CAST(title_id AS VARCHAR) AS tconst, (t // 10) || '.' || (t % 10) AS averageRating,
         CAST(votes AS VARCHAR) AS numVotes
  FROM tenths)
SELECT *, tconst || chr(9) || averageRating || chr(9) || numVotes AS line FROM shown""",
    "vote_minutes": f"WITH {_VOTES} SELECT title_id, rating, {_MINUTE} AS minute FROM votes",
    "vote_log_lines": f"""
WITH {_VOTES}
SELECT epoch_us(ts) // 1000 AS millis, title_id || chr(9) || rating || chr(9) || {_MINUTE} AS line FROM votes""",
    "vote_lots": f"""
WITH {_VOTES}
SELECT {_LOT} AS lot, count(*) AS n_votes, CAST(sum(rating) AS BIGINT) AS vote_sum FROM votes GROUP BY 1""",
    "lots_union": f"WITH {_VOTES} SELECT title_id, rating, {_MINUTE} AS minute, {_LOT} AS lot FROM votes",
    "ratings_folded": f"""
WITH {_MERGED}, {_VOTES},
folded AS (SELECT title_id, CAST(sum(rating) AS BIGINT) AS vote_sum, count(*) AS vote_count FROM votes GROUP BY 1)
SELECT title_id,
       CASE WHEN vote_count IS NULL THEN s / n ELSE (s / n * n + vote_sum) / (n + vote_count) END AS mean,
       n + coalesce(vote_count, 0) AS votes
FROM stored LEFT JOIN folded USING (title_id)""",
    "window_vote_means": f"WITH {_MEANS} SELECT * FROM means WHERE {_FINISHED}",
    "window_vote_means_batch": f"WITH {_MEANS} SELECT * FROM means",
    "window_vote_means_by_change": f"WITH {_MEANS} SELECT * FROM means",
    "window_vote_runs": f"""
WITH {_MEANS},
sums AS (
  SELECT w AS start, title_id, CAST(sum(rating) AS BIGINT) AS s, count(*) AS n
  FROM (SELECT title_id, rating, date_trunc('hour', ts) - to_hours(CAST(i AS INTEGER)) AS w
        FROM votes CROSS JOIN range(10) AS r(i))
  GROUP BY 1, 2),
entering AS (SELECT DISTINCT title_id, date_trunc('hour', ts) - INTERVAL 9 HOUR AS at FROM votes),
leaving AS (SELECT DISTINCT title_id, date_trunc('hour', ts) + INTERVAL 1 HOUR AS at FROM votes),
changes AS (SELECT * FROM entering UNION SELECT * FROM leaving),
numbered AS (
  SELECT sums.*, count(changes.at) OVER (PARTITION BY sums.title_id ORDER BY start) AS run
  FROM sums LEFT JOIN changes ON changes.title_id = sums.title_id AND changes.at = start)
SELECT title_id, min(start) AS first_start, max(start) AS last_start, any_value(s) AS vote_sum, any_value(n) AS n_votes,
       any_value(s) / any_value(n) AS mean_vote
FROM numbered GROUP BY title_id, run""",
    "top3_window_titles": _TOP3_FINISHED,
    "top3_window_titles_by_parts": _TOP3_FINISHED,
    "top3_window_titles_batch": f"WITH {_TOP3} SELECT * FROM ranked WHERE rank <= 3",
    "period_vote_counts": _COUNTS_FINISHED,
    "rescaled_vote_counts": _COUNTS_FINISHED,
    "trending_titles": _TRENDING_FINISHED,
    "trending_titles_by_state": _TRENDING_FINISHED,
    "vote_line_stream": f"WITH {_VOTES} SELECT title_id, rating, date_trunc('millisecond', ts) AS ts FROM votes",
    "late_votes": """
WITH votes AS (SELECT user_id AS title_id, ts, event_id % 4 AS batch, date_trunc('day', ts) AS period_start FROM events),
newest AS (SELECT batch, max(max(ts)) OVER (ORDER BY batch) - INTERVAL 10 MINUTE AS watermark FROM votes GROUP BY batch),
judged AS (
  SELECT v.*, period_start + INTERVAL 1 DAY AS period_end, coalesce(period_start + INTERVAL 1 DAY <= n.watermark, false) AS late,
         period_start + INTERVAL 1 DAY > (SELECT max(watermark) FROM newest) AS open
  FROM votes v LEFT JOIN newest n ON n.batch = v.batch - 2)
SELECT period_start, period_end, title_id, count(*) AS n_votes, count_if(NOT late AND NOT open) AS n_reported,
       count_if(late) AS n_late, count_if(open) AS n_open
FROM judged GROUP BY ALL""",
    "trending_batch": f"""
WITH {_PERIODS}
SELECT rising.*, c_name AS original_title FROM rising JOIN customer ON c_custkey = title_id""",
    "running_votes": """
SELECT p_partkey AS title_id, CAST(p_size AS BIGINT) AS votes,
       CAST(sum(p_size) OVER (ORDER BY p_partkey) AS BIGINT) AS running_votes
FROM part""",
    "vote_holders": """
WITH bounds AS (
  SELECT p_partkey AS title_id, CAST(sum(p_size) OVER (ORDER BY p_partkey) AS BIGINT) AS hi,
         CAST(sum(p_size) OVER (ORDER BY p_partkey) AS BIGINT) - p_size AS lo
  FROM part),
points AS (SELECT event_id, CAST(round(value * 100) AS BIGINT) AS point FROM events)
SELECT event_id, point, title_id FROM points JOIN bounds ON point >= lo AND point < hi""",
    "table_upsert": _STORED_PAGES,
    "table_puts": _STORED_PAGES,
    "person_pages_get": f"WITH {_BEST}, {_LINES} SELECT * FROM lines WHERE person_id BETWEEN 1 AND 39",
    "catalog_ddl": """
SELECT CAST(p_partkey AS VARCHAR) AS title_id, p_name AS original_title,
       array_to_string(string_split(p_name, ' '), ',') AS genres,
       true AS created_1, false AS created_2, true AS dropped_1, false AS dropped_2
FROM part""",
    "tsv_roundtrip": """
SELECT CAST(p_partkey AS VARCHAR) AS tconst, CAST(p_size AS DOUBLE) AS "averageRating", p_size AS "numVotes", codec
FROM part CROSS JOIN (VALUES ('plain'), ('gzip'), ('bzip2')) AS c(codec)""",
    "titles_tsv": """
SELECT CAST(p_partkey AS VARCHAR) AS tconst, 'movie' AS "titleType", p_name AS "primaryTitle", p_name AS "originalTitle",
       0 AS "isAdult", CAST(1900 + p_size AS INTEGER) AS "startYear", CAST(nullif(p_size, 1) AS INTEGER) AS "endYear",
       CAST(p_size AS INTEGER) AS "runtimeMinutes", replace(p_name, ' ', ',') AS genres
FROM part""",
    "title_names_tsv": "SELECT CAST(p_partkey AS VARCHAR) AS title_id, upper(p_name) AS original_title FROM part",
    "people_tsv": """
SELECT CAST(s_suppkey AS VARCHAR) AS nconst, s_name AS "primaryName", CAST(s_nationkey AS INTEGER) AS "birthYear",
       CAST(nullif(s_nationkey, 0) AS INTEGER) AS "deathYear", 'actor' AS "primaryProfession",
       CAST(NULL AS VARCHAR) AS "knownForTitles"
FROM supplier""",
    "credits_tsv": """
SELECT CAST(l_orderkey AS VARCHAR) AS tconst, CAST(l_linenumber AS INTEGER) AS ordering,
       CAST(l_suppkey AS VARCHAR) AS nconst, l_returnflag AS category, CAST(NULL AS VARCHAR) AS job,
       l_linestatus AS characters
FROM lineitem""",
}

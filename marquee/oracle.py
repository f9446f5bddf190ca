"""The same queries as plain SQL for an independent engine, over the test tables as views."""

from __future__ import annotations

SOURCES = """
ratings_src AS (
  SELECT event_id AS rating_id, user_id, CAST(props->>'$.k' AS BIGINT) AS movie_id, ts,
    CASE WHEN event_type = 'error' THEN NULL ELSE CAST(event_id % 5 + 1 AS INT) END AS rating_score,
    CASE event_type WHEN 'signup' THEN TRUE WHEN 'error' THEN NULL ELSE FALSE END AS f1,
    CASE WHEN value >= 50 THEN TRUE WHEN value < 5 THEN NULL ELSE FALSE END AS f2,
    CASE event_type WHEN 'purchase' THEN TRUE WHEN 'view' THEN NULL ELSE FALSE END AS f3,
    CASE event_type WHEN 'click' THEN TRUE WHEN 'signup' THEN NULL ELSE FALSE END AS f4
  FROM events),
movies_src AS (
  SELECT p_partkey AS movie_id, p_name AS movie_title,
    CASE WHEN p_type = 'PROMO' THEN NULL ELSE 1900 + p_size END AS movie_release_year,
    CASE WHEN p_size % 2 = 0 THEN 'en' END AS movie_title_language
  FROM part)"""

#: The same sources with every fifth movie listed twice, under another title and year.
REPEATED = SOURCES + """,
movies_twice AS (
  SELECT * FROM movies_src UNION ALL
  SELECT movie_id, movie_title || ' again', movie_release_year + 1, movie_title_language FROM movies_src
  WHERE movie_id % 5 = 0)"""

FLAGS = """CAST(coalesce(f1, FALSE) AS BIGINT) AS user_eligible_for_trial,
    CAST(coalesce(f2, FALSE) AS BIGINT) AS user_has_payment_method,
    CAST(coalesce(f3, FALSE) AS BIGINT) AS user_subscriber,
    CAST(coalesce(f4, FALSE) AS BIGINT) AS user_trialist"""


def base(unrated: bool = False, repeated: bool = False) -> str:
    sources, movies = (REPEATED, "movies_twice") if repeated else (SOURCES, "movies_src")
    value = "rating_score"
    if unrated:
        value = "coalesce(rating_score, quantile_disc(rating_score, 0.5) OVER (PARTITION BY r.movie_id))"
    return sources + f""",
base AS (
  SELECT r.rating_id, r.user_id, r.movie_id, r.ts, r.rating_score, {FLAGS},
    m.movie_title, CAST({value} AS BIGINT) AS rating_value,
    CAST(coalesce(m.movie_release_year, 0) AS BIGINT) AS movie_release_year, m.movie_title_language
  FROM ratings_src r JOIN {movies} m ON r.movie_id = m.movie_id
  WHERE {'TRUE' if unrated else 'r.rating_score IS NOT NULL'})"""


#: A rating's place among its user's: a movie listed twice repeats its ratings.
PLACE = "ts, rating_id, movie_release_year, movie_title NULLS FIRST"


def gaps(
    unrated: bool = False, unit: str = "calendar", order: str = f"gap DESC, {PLACE}", repeated: bool = False
) -> str:
    diff = "date_diff" if unit == "calendar" else "date_sub"
    return base(unrated, repeated) + f""",
gaps AS (
  SELECT *, coalesce({diff}('day', lag(ts) OVER (PARTITION BY user_id ORDER BY {PLACE}), ts), -1) AS gap,
    max(ts) OVER (PARTITION BY user_id) AS last_ts, row_number() OVER (PARTITION BY user_id ORDER BY {PLACE}) AS place
  FROM base),
shifted AS (
  SELECT user_id, movie_id, rating_id AS matched_rating_id, movie_release_year AS matched_year,
    movie_title AS matched_title, place AS matched_place, coalesce(
    lag(gap) OVER (PARTITION BY user_id ORDER BY {order}), 0) AS shifted_days
  FROM gaps)"""


def pairs(unrated: bool = False, rerate: str = "fanout", repeated: bool = False) -> str:
    on = "g.user_id = s.user_id AND g.movie_id = s.movie_id"
    if rerate == "by_rating":
        on = "g.user_id = s.user_id AND g.place = s.matched_place"
    return gaps(unrated, repeated=repeated) + f""",
pairs AS (
  SELECT g.*, s.matched_rating_id, s.matched_year, s.matched_title, s.shifted_days FROM gaps g JOIN shifted s ON {on})"""


def histories(frame: str, unrated: bool = False, rerate: str = "fanout", repeated: bool = False) -> str:
    rows = "10 PRECEDING AND 1 PRECEDING" if frame == "train" else "9 PRECEDING AND CURRENT ROW"
    return pairs(unrated, rerate, repeated) + f""",
hist AS (
  SELECT *, coalesce(list(movie_id) OVER w, []) AS h_ids, coalesce(list(movie_release_year) OVER w, []) AS h_years,
    coalesce(list(rating_value) OVER w, []) AS h_scores, coalesce(list(shifted_days) OVER w, []) AS h_gaps,
    ('0x' || substr(md5(strftime(ts, '%Y-%m-%d %H:%M:%S.%f')), 1, 8))::BIGINT % 100 AS bucket
  FROM pairs
  WINDOW w AS (
    PARTITION BY user_id ORDER BY {PLACE}, matched_rating_id, matched_year, matched_title NULLS FIRST
    ROWS BETWEEN {rows}))"""


SHOW_HISTORY = """SELECT rating_id, matched_rating_id, user_id, movie_id, len(h_ids) AS history_len,
  array_to_string(h_ids, ',') AS ids, array_to_string(h_years, ',') AS years,
  array_to_string(h_scores, ',') AS scores, array_to_string(h_gaps, ',') AS gaps FROM hist"""


def padding(column: str, fill: str, kind: str, side: str, n: int = 10) -> str:
    kept = f"{column}[greatest(1, len({column}) - {n - 1}):]"
    fills = f"list_transform(range({n} - least(len({column}), {n})), lambda i: {fill}::{kind})"
    parts = [f"{kept}::{kind}[]", fills]
    return f"array_to_string(list_concat({', '.join(parts if side == 'post' else parts[::-1])}), ',')"


def show_dataset(ids: str, side: str) -> str:
    return f"""SELECT rating_id, matched_rating_id, {ids}, user_eligible_for_trial, user_has_payment_method,
  user_subscriber, user_trialist,
  {padding('h_ids', '0', 'INTEGER', side)} AS previous_movie_ids,
  {padding('h_years', '1980.0', 'FLOAT', side)} AS previous_movie_years,
  {padding('h_scores', '2.5', 'FLOAT', side)} AS previous_score,
  {padding('h_gaps', '0', 'FLOAT', side)} AS previous_days_since_last_rating,
  len(h_ids) AS history_len FROM hist"""


CATALOGUE = "catalogue AS (SELECT DISTINCT r.movie_id, m.movie_title FROM ratings_src r JOIN movies_src m USING (movie_id))"
VOCABULARY = CATALOGUE + """,
vocab AS (SELECT movie_id, row_number() OVER (ORDER BY movie_id) AS index FROM catalogue)"""
TRAIN = histories("train") + ", train AS (SELECT * FROM hist WHERE len(h_ids) > 2)"
HASHED = TRAIN + """,
hashed AS (
  SELECT *, ('0x' || substr(md5(concat_ws(':', rating_id, matched_rating_id, '42')), 1, 12))::BIGINT AS h FROM train),
placed AS (
  SELECT *, row_number() OVER (ORDER BY h, rating_id, matched_rating_id) - 1 AS position FROM hashed)"""
ITEMS = "items AS (SELECT vec_id AS movie_id, embedding::DOUBLE[] AS v FROM embeddings)"


def encoded(rows: str, weight: str = "1.0") -> str:
    """Weighted mean of the item vectors of each history in ``rows``."""
    return f"""{ITEMS},
entries AS (
  SELECT rating_id, matched_rating_id, unnest(h_ids) AS movie_id, unnest(range(len(h_ids))) AS nth, len(h_ids) AS n
  FROM {rows}),
terms AS (
  SELECT rating_id, matched_rating_id, list(i.v ORDER BY nth) AS vs, list({weight} ORDER BY nth) AS ws
  FROM entries e JOIN items i USING (movie_id) GROUP BY ALL),
means AS (
  SELECT rating_id, matched_rating_id, list_transform(range(1, 65), lambda d:
    list_sum(list_transform(range(1, len(vs) + 1), lambda j: vs[j][d] * ws[j])) / list_sum(ws)) AS v
  FROM terms)"""


PAIRS = HASHED + ", " + encoded("train") + """,
scored AS (
  SELECT p.rating_id, p.matched_rating_id, p.movie_id, p.position, i.v AS q, m.v,
    round(list_dot_product(i.v, m.v), 6) AS score
  FROM placed p JOIN means m USING (rating_id, matched_rating_id) JOIN items i ON i.movie_id = p.movie_id)"""
RANKS = PAIRS + """,
held AS (SELECT * FROM scored WHERE position < 1000),
by_movie AS (
  SELECT h.movie_id, round(list_dot_product(h.q, c.v), 6) AS score
  FROM (SELECT DISTINCT movie_id, q FROM held) h CROSS JOIN scored c),
ranks AS (
  SELECT h.rating_id, h.matched_rating_id, 1 + count(b.score) AS rank
  FROM held h LEFT JOIN by_movie b ON b.movie_id = h.movie_id AND b.score > h.score GROUP BY ALL)"""

LATEST = histories("inference") + ", latest AS (SELECT * FROM hist WHERE len(h_ids) > 2 AND ts = last_ts)"
TOP_K = f"""WITH {LATEST}, {CATALOGUE}, {encoded('latest')},
scores AS (
  SELECT c.movie_id, l.user_id, round(list_dot_product(i.v, m.v), 6) AS score
  FROM catalogue c JOIN items i USING (movie_id)
  CROSS JOIN (latest l JOIN means m USING (rating_id, matched_rating_id)))
SELECT * FROM (
  SELECT movie_id, row_number() OVER (PARTITION BY movie_id ORDER BY score DESC, user_id) AS rank, user_id, score
  FROM scores) WHERE rank <= 10"""

SHOW_VECTOR = """SELECT rating_id, matched_rating_id,
  array_to_string(list_transform(v, lambda x: CAST(round(x * 1e6) AS BIGINT)), ',') AS vector FROM means"""
REPORT = """SELECT CAST(sum(n) AS BIGINT) AS ratings, count(*) AS pairs, max(n) AS largest_pair,
  CAST(sum(n * n) AS BIGINT) AS fanout_rows
  FROM (SELECT count(*) AS n FROM base WHERE user_id IS NOT NULL GROUP BY user_id, movie_id)"""
IDS = "rating_id, matched_rating_id"
BOTH = "movie_id, user_id"
#: Training rows in the order of their keys, from 0.
IN_ORDER = HASHED + f""",
ordered AS (SELECT {IDS}, h, row_number() OVER (ORDER BY {IDS}) - 1 AS place FROM hashed)"""



def losses(batch: int) -> str:
    return f"""WITH {PAIRS},
held AS (SELECT *, position // {batch} AS batch_id FROM scored WHERE position < 1000),
logits AS (
  SELECT a.batch_id, a.position, list_dot_product(a.q, b.v) AS s,
    CASE WHEN a.position = b.position THEN list_dot_product(a.q, b.v) END AS true_s
  FROM held a JOIN held b ON a.batch_id = b.batch_id),
row_loss AS (
  SELECT batch_id, position, ln(sum(exp(s))) - max(true_s) AS loss FROM logits GROUP BY ALL)
  SELECT batch_id, count(*) AS rows, round(sum(loss), 6) AS loss FROM row_loss GROUP BY batch_id"""


ORACLE: dict[str, str] = {
    "ratings_base": f"""WITH {base()} SELECT rating_id, user_id, movie_id, ts AS rating_timestamp_utc,
  CAST(rating_score AS BIGINT) AS rating_score, user_eligible_for_trial, user_has_payment_method, user_subscriber,
  user_trialist, movie_title, rating_value, movie_release_year, movie_title_language FROM base""",
    "movie_median": f"""WITH {SOURCES} SELECT movie_id, CAST(quantile_disc(rating_score, 0.5) AS BIGINT) AS median_score
  FROM ratings_src WHERE rating_score IS NOT NULL GROUP BY movie_id""",
    "median_impute": f"WITH {base(True)} SELECT rating_id, movie_id, rating_value FROM base",
    "rating_gaps": f"WITH {gaps()} SELECT rating_id, user_id, gap AS days_since_last_rating FROM gaps",
    "rating_gaps_elapsed": f"""WITH {gaps(unit='elapsed')}
  SELECT rating_id, user_id, gap AS days_since_last_rating FROM gaps""",
    "last_rating": f"WITH {gaps()} SELECT rating_id, user_id, last_ts AS last_rating_timestamp FROM gaps",
    "shifted_gaps": f"WITH {gaps()} SELECT matched_rating_id AS rating_id, user_id, shifted_days FROM shifted",
    "shifted_gaps_by_time": f"""WITH {gaps(order=PLACE)}
  SELECT matched_rating_id AS rating_id, user_id, shifted_days FROM shifted""",
    "repeated_movies_gaps": f"""WITH {gaps(repeated=True)}
  SELECT matched_rating_id AS rating_id, user_id, shifted_days FROM shifted""",
    "repeated_movies_train": f"WITH {histories('train', repeated=True)} {SHOW_HISTORY}",
    "repeated_movies_by_rating": f"""WITH {histories('train', rerate='by_rating', repeated=True)} {SHOW_HISTORY}""",
    "repeated_movies_inference": f"WITH {histories('inference', repeated=True)} {SHOW_HISTORY} WHERE ts = last_ts",
    "gap_join": f"WITH {pairs()} SELECT {IDS}, user_id, movie_id, shifted_days FROM pairs",
    "gap_join_by_rating": f"""WITH {pairs(rerate='by_rating')}
  SELECT {IDS}, user_id, movie_id, shifted_days FROM pairs""",
    "fanout_report": f"WITH {base()} {REPORT}",
    "history_train": f"WITH {histories('train')} {SHOW_HISTORY}",
    "history_inference": f"WITH {histories('inference')} {SHOW_HISTORY}",
    "history_min": f"WITH {histories('train')} {SHOW_HISTORY} WHERE len(h_ids) > 2",
    "history_latest": f"WITH {histories('inference')} {SHOW_HISTORY} WHERE ts = last_ts",
    "pad_post": f"""WITH {histories('train')}
  SELECT {IDS}, {padding('h_ids', '0', 'INTEGER', 'post')} AS ids FROM hist""",
    "pad_pre": f"""WITH {histories('train')}
  SELECT {IDS}, {padding('h_ids', '0', 'INTEGER', 'pre')} AS ids FROM hist""",
    "truncate_newest": f"""WITH {histories('train')}
  SELECT {IDS}, {padding('h_ids', '0', 'INTEGER', 'post', 4)} AS ids FROM hist""",
    "train_dataset": f"WITH {histories('train')} {show_dataset(BOTH, 'post')} WHERE len(h_ids) > 2",
    "train_dataset_by_rating": f"""WITH {histories('train', rerate='by_rating')}
  {show_dataset(BOTH, 'post')} WHERE len(h_ids) > 2""",
    "train_dataset_unrated": f"WITH {histories('train', True)} {show_dataset(BOTH, 'post')} WHERE len(h_ids) > 2",
    "sampled_train_dataset": f"""WITH {histories('train')}
  {show_dataset('movie_id', 'pre')} WHERE bucket IN (10, 20, 30, 40)""",
    "inference_dataset": f"""WITH {histories('inference')}
  {show_dataset('user_id', 'post')} WHERE len(h_ids) > 2 AND ts = last_ts""",
    "inference_dataset_front_padded": f"""WITH {histories('inference')}
  {show_dataset('user_id', 'pre')} WHERE len(h_ids) > 2 AND ts = last_ts""",
    "inference_one_per_user": f"""WITH {histories('inference')}
  {show_dataset('user_id', 'post')} WHERE len(h_ids) > 2 AND ts = last_ts
  QUALIFY row_number() OVER (PARTITION BY user_id ORDER BY ts DESC, rating_id DESC, matched_rating_id DESC) = 1""",
    "movie_catalogue": f"WITH {SOURCES}, {CATALOGUE} SELECT movie_id, movie_title FROM catalogue",
    "hash_sample": f"""WITH {base()}, buckets AS (
  SELECT rating_id, user_id,
    ('0x' || substr(md5(strftime(ts, '%Y-%m-%d %H:%M:%S.%f')), 1, 8))::BIGINT % 100 AS bucket FROM base)
  SELECT * FROM buckets WHERE bucket IN (10, 20, 30, 40)""",
    "seeded_shuffle": f"WITH {HASHED} SELECT {IDS}, position AS shuffle_position FROM placed",
    "holdout": f"WITH {HASHED} SELECT {IDS}, movie_id, user_id FROM placed WHERE position < 1000",
    "train_rest": f"WITH {HASHED} SELECT {IDS}, movie_id, user_id FROM placed WHERE position >= 1000",
    "dataset_counts": f"""WITH {TRAIN}, {CATALOGUE}, last_rows AS (
  SELECT rating_id, row_number() OVER (PARTITION BY user_id ORDER BY ts, rating_id, matched_rating_id) AS nth
  FROM pairs WHERE TRUE QUALIFY ts = last_ts)
  SELECT 'train' AS dataset, count(*) AS n FROM train
  UNION ALL SELECT 'inference', count(*) FROM last_rows WHERE nth > 2
  UNION ALL SELECT 'movies', count(*) FROM catalogue""",
    "vocabulary": f"WITH {SOURCES}, {VOCABULARY} SELECT movie_id, index FROM vocab",
    "encode_ids": f"""WITH {SOURCES}, {VOCABULARY}
  SELECT m.movie_id, coalesce(v.index, 0) AS index FROM movies_src m LEFT JOIN vocab v USING (movie_id)""",
    "encode_history_repeated_rows": f"""WITH {TRAIN}, {VOCABULARY}, twice AS (SELECT unnest([1, 2]) AS time),
known AS (SELECT list(movie_id ORDER BY index) AS ids FROM vocab)
  SELECT {IDS}, array_to_string(list_concat(
    list_transform(h_ids, lambda id: coalesce(list_position(known.ids, id), 0)),
    list_transform(range(10 - len(h_ids)), lambda i: coalesce(list_position(known.ids, 0), 0))), ',') AS indices
  FROM train, twice, known""",
    "encode_history": f"""WITH {TRAIN}, {VOCABULARY},
filled AS (
  SELECT {IDS}, list_concat(h_ids, list_transform(range(10 - len(h_ids)), lambda i: 0::BIGINT)) AS ids FROM train),
entries AS (SELECT {IDS}, unnest(ids) AS movie_id, unnest(range(10)) AS nth FROM filled)
  SELECT {IDS}, array_to_string(list(coalesce(v.index, 0) ORDER BY nth), ',') AS indices
  FROM entries e LEFT JOIN vocab v USING (movie_id) GROUP BY ALL""",
    "embedding_lookup": f"""WITH {base()}, {ITEMS} SELECT b.rating_id, b.movie_id,
  array_to_string(list_transform(i.v, lambda x: CAST(round(x * 1e6) AS BIGINT)), ',') AS vector
  FROM base b JOIN items i USING (movie_id)""",
    "history_vector": f"WITH {TRAIN}, {encoded('train')} {SHOW_VECTOR}",
    "history_vector_recency": f"WITH {TRAIN}, {encoded('train', 'pow(0.5, n - 1 - nth)')} {SHOW_VECTOR}",
    "dot_scores": f"WITH {PAIRS} SELECT {IDS}, movie_id, score FROM scored",
    "topk_users": TOP_K,
    "topk_accuracy": f"""WITH {RANKS} SELECT round(avg(CASE WHEN rank <= 100 THEN 1.0 ELSE 0.0 END), 6) AS accuracy,
  count(*) AS rows FROM ranks""",
    "pair_ranks": f"WITH {RANKS} SELECT {IDS}, rank FROM ranks",
    "softmax_loss": losses(250),
    "softmax_loss_whole": losses(1000),
    "index_roundtrip": f"""WITH {LATEST}, {encoded('latest')} SELECT user_id, {IDS}, 64::BIGINT AS width,
  array_to_string(list_transform(v, lambda x: CAST(round(CAST(CAST(x AS FLOAT) AS DOUBLE) * 1e6) AS BIGINT)), ',') AS vector
  FROM latest JOIN means USING ({IDS})""",
    "als_item_vectors": f"""WITH {base()}
  SELECT DISTINCT movie_id, 32::BIGINT AS width, TRUE AS usable FROM base WHERE user_id IS NOT NULL""",
    "audience_index": f"WITH {LATEST} SELECT user_id, {IDS}, TRUE AS agrees FROM latest",
    "best_users": f"""WITH {LATEST}, {CATALOGUE}, places AS (SELECT row_number() OVER () AS rank FROM latest)
  SELECT movie_id, rank, TRUE AS agrees FROM catalogue, places
  WHERE rank <= 10 AND movie_id IN (SELECT movie_id FROM base WHERE user_id IS NOT NULL)""",
    "evaluation": """SELECT unnest(['top_100_accuracy', 'rows', 'loss', 'batches']) AS metric, TRUE AS agrees""",
    "trained_snapshot": f"""WITH {LATEST} SELECT 'index' AS part, CAST(user_id AS VARCHAR) AS entry, TRUE AS agrees
  FROM latest UNION ALL SELECT 'metric', unnest(['top_100_accuracy', 'rows', 'loss', 'batches']), TRUE""",
    "source_tables": f"""WITH {SOURCES} SELECT rating_id, user_id, movie_id, ts AS rating_timestamp_utc,
  CAST(rating_score AS BIGINT) AS rating_score FROM ratings_src WHERE movie_id IN (SELECT movie_id FROM movies_src)""",
    "refused_overwrite": f"WITH {SOURCES}, {CATALOGUE} SELECT movie_id, movie_title, TRUE AS refused FROM catalogue",
    "snapshot_roundtrip": f"WITH {SOURCES}, {CATALOGUE} SELECT movie_id, movie_title FROM catalogue",
    "prepared_snapshot": f"""WITH {TRAIN},
latest AS (
  SELECT *, list(movie_id) OVER (PARTITION BY user_id ORDER BY ts, rating_id, matched_rating_id
    ROWS BETWEEN 9 PRECEDING AND CURRENT ROW) AS now_ids FROM pairs)
  SELECT 'train' AS dataset, {IDS}, user_id, {padding('h_ids', '0', 'INTEGER', 'post')} AS ids FROM train
  UNION ALL
  SELECT 'inference', {IDS}, user_id, {padding('now_ids', '0', 'INTEGER', 'post')} FROM latest
  WHERE ts = last_ts AND len(now_ids) > 2""",
    "metrics_roundtrip": f"""WITH {base()}, report AS ({REPORT})
  SELECT unnest(['ratings', 'pairs', 'largest_pair', 'fanout_rows']) AS metric,
    unnest([ratings, pairs, largest_pair, fanout_rows])::DOUBLE AS value FROM report""",
    "all_batches": f"WITH {IN_ORDER} SELECT {IDS}, place, place // 250 AS batch_id FROM ordered",
    "taken_batches": f"WITH {IN_ORDER} SELECT {IDS}, place, place // 250 AS batch_id FROM ordered WHERE place < 750",
    "one_batch": f"WITH {IN_ORDER} SELECT {IDS}, place, 2 AS batch_id FROM ordered WHERE place >= 500 AND place < 750",
    "buffer_shuffle": f"""WITH {IN_ORDER} SELECT {IDS}, place // 1000 * 1000 + row_number() OVER (
    PARTITION BY place // 1000 ORDER BY h, {IDS}) - 1 AS shuffle_position FROM ordered""",
    "batched_read": f"WITH {TRAIN} SELECT {IDS}, h_ids[-1] AS newest_id FROM train",
}

# Other roads to the same rows.
for road, query in {
    "shifted_gaps_segmented": "shifted_gaps",
    "repeated_movies_gaps_segmented": "repeated_movies_gaps",
    "repeated_movies_train_segmented": "repeated_movies_train",
    "repeated_movies_by_rating_segmented": "repeated_movies_by_rating",
    "repeated_movies_inference_segmented": "repeated_movies_inference",
    "inference_one_per_user_segmented": "inference_one_per_user",
    "encode_history_repeated_rows_joined": "encode_history_repeated_rows",
    "train_dataset_segmented": "train_dataset",
    "inference_dataset_segmented": "inference_dataset",
    "encode_history_joined": "encode_history",
    "history_vector_joined": "history_vector",
    "topk_users_blocked": "topk_users",
    "topk_users_pruned": "topk_users",
    "updated_snapshot": "prepared_snapshot",
    "updated_train_unrated": "train_dataset_unrated",
    "updated_inference": "inference_dataset",
    "updated_catalogue": "movie_catalogue",
    "pair_ranks_blocked": "pair_ranks",
}.items():
    ORACLE[road] = ORACLE[query]

"""DuckDB oracle SQL for the registered queries.

Each statement is self-contained over the driver's pre-registered views
(lineitem, orders, part, events, ...).  The fixture views and the prepared
split table are shared CTE blocks; numeric parameters are formatted from the
same Config as the Spark side.
"""

from __future__ import annotations

from affinity.config import FIXTURE, SAMPLED, Config
from affinity.functions.hashing import hex_threshold
from affinity.sources.fixtures import (
    ITEM_MAP_OFFSET, RATED_DISCOUNT_BELOW, READ_FLAGS, READER_EVENTS, REVIEWED_TAX_FROM,
)


def _in(values) -> str:
    return ", ".join(f"'{v}'" for v in values)


def fx_cte() -> str:
    return f"""fx AS (
  SELECT CAST(o_custkey AS INT) AS user_id, CAST(l_partkey AS INT) AS book_id,
         CAST(MAX(CASE WHEN l_returnflag IN ({_in(READ_FLAGS)}) THEN 1 ELSE 0 END) AS INT) AS is_read,
         CAST(MAX(CASE WHEN l_returnflag IN ({_in(READ_FLAGS)}) AND l_discount < {RATED_DISCOUNT_BELOW}
                       THEN 1 + (l_linenumber - 1) % 5 ELSE 0 END) AS INT) AS rating,
         CAST(MAX(CASE WHEN l_tax >= {REVIEWED_TAX_FROM} THEN 1 ELSE 0 END) AS INT) AS is_reviewed
  FROM lineitem JOIN orders ON l_orderkey = o_orderkey
  GROUP BY 1, 2)"""


def readers_cte() -> str:
    return f"""rd AS (
  SELECT CAST(user_id AS INT) AS user_id, CAST(json_extract_string(props, '$.k') AS INT) AS book_id,
         CAST(MAX(CASE WHEN event_type IN ({_in(READER_EVENTS)}) THEN 1 ELSE 0 END) AS INT) AS is_read
  FROM events GROUP BY 1, 2)"""


def item_map_cte() -> str:
    return f"""im AS (
  SELECT CAST(p_partkey AS INT) AS book_id_csv, CAST(p_partkey + {ITEM_MAP_OFFSET} AS INT) AS book_id FROM part)"""


def split_case(cfg: Config, col: str = "user_id") -> str:
    w = cfg.split_weights
    total = float(sum(w))
    c1 = hex_threshold(w[0] / total)
    c2 = hex_threshold(w[0] / total + w[1] / total)
    key = f"substr(md5(concat_ws('|', 'split', {cfg.split_seed}, {col})), 1, 8)"
    return f"CASE WHEN {key} < '{c1}' THEN 'train' WHEN {key} < '{c2}' THEN 'tuning' ELSE 'test' END"


def prepared_ctes(cfg: Config = FIXTURE) -> str:
    """fx + prepared(user_id, book_id, is_read, rating, is_reviewed, split, role)."""
    cut = hex_threshold(cfg.sample_fraction)
    return f"""{fx_cte()},
ucnt AS (SELECT user_id, count(*) AS n FROM fx GROUP BY user_id),
samp AS (
  SELECT fx.*, ucnt.n, {split_case(cfg, 'fx.user_id')} AS split
  FROM fx JOIN ucnt ON fx.user_id = ucnt.user_id
  WHERE ucnt.n >= {cfg.min_interactions}
    AND substr(md5(concat_ws('|', 'sample', {cfg.sample_seed}, fx.user_id)), 1, 8) < '{cut}'),
ranked AS (
  SELECT *, row_number() OVER (
           PARTITION BY user_id
           ORDER BY md5(concat_ws('|', 'order',
                      CASE WHEN split = 'tuning' THEN {cfg.seed_tuning} ELSE {cfg.seed_test} END,
                      user_id, book_id)), book_id) AS rn
  FROM samp),
prepared AS (
  SELECT user_id, book_id, is_read, rating, is_reviewed, split,
         CASE WHEN split = 'train' THEN 'train'
              WHEN rn > n - {cfg.holdout_size} THEN 'holdout'
              WHEN rn > n - {cfg.reserved} THEN 'history'
              ELSE 'train' END AS role
  FROM ranked)"""


# ---------------------------------------------------------------- statements
def _with(*blocks: str) -> str:
    return "WITH " + ",\n".join(blocks) + "\n"


TRAIN = "train AS (SELECT user_id, book_id, is_read, rating, is_reviewed FROM prepared WHERE role = 'train')"


def _active_cte(cfg: Config) -> str:
    return (f"active AS (SELECT * FROM fx WHERE user_id IN "
            f"(SELECT user_id FROM fx GROUP BY user_id HAVING count(*) >= {cfg.min_interactions}))")


def _sampled_cte(cfg: Config) -> str:
    return (f"sampled AS (SELECT * FROM active WHERE "
            f"substr(md5(concat_ws('|', 'sample', {cfg.sample_seed}, user_id)), 1, 8) < '{hex_threshold(cfg.sample_fraction)}')")


def _pct(num: str, den: str) -> str:
    return f"round(100.0::DOUBLE * ({num}) / NULLIF({den}, 0), 6)"


def _coverage_select(name: str, src: str) -> str:
    cols = {"rated": "rating > 0", "read": "is_read = 1", "reviewed": "is_reviewed = 1",
            "rated_and_read": "rating > 0 AND is_read = 1"}
    counts = ", ".join(f"count(*) FILTER (WHERE {c}) AS n_{k}" for k, c in cols.items())
    pcts = ", ".join(f"{_pct('n_' + k, 'n_rows')} AS pct_{k}" for k in cols)
    return (f"SELECT '{name}' AS dataset, n_rows, {', '.join('n_' + k for k in cols)}, {pcts} "
            f"FROM (SELECT count(*) AS n_rows, {counts} FROM {src})")


def _table_name() -> str:
    return "CASE WHEN role = 'train' THEN 'train' ELSE split || '_' || role END"


def _scores_cte(name: str = "scores", src: str = "train", variant: str = "product") -> str:
    score = {"product": "avg_rating * ln(read_count)", "read_count": "CAST(read_count AS DOUBLE)",
             "avg_rating": "avg_rating"}[variant]
    return f"""{name} AS (
  SELECT book_id, read_count, avg_rating, {score} AS popularity_score FROM (
    SELECT book_id, count(*) FILTER (WHERE is_read = 1) AS read_count,
           avg(CASE WHEN rating > 0 THEN rating END) AS avg_rating
    FROM {src} GROUP BY book_id)
  WHERE read_count > 0 AND avg_rating IS NOT NULL)"""


def _top_cte(name: str, scores: str, k: int) -> str:
    return f"""{name} AS (
  SELECT * FROM (SELECT *, CAST(row_number() OVER (ORDER BY round(popularity_score, 9) DESC, book_id ASC) AS INTEGER) AS rank
                 FROM {scores}) WHERE rank <= {k})"""


def _per_user_cte(name: str, top: str, holdout_filter: str = "TRUE") -> str:
    return f"""{name} AS (
  SELECT h.split, h.user_id, count(*) AS n_holdout, count(t.rank) AS n_hits, min(t.rank) AS best_rank,
         CASE WHEN min(t.rank) IS NOT NULL THEN 1.0::DOUBLE / min(t.rank) ELSE 0.0::DOUBLE END AS ap,
         CASE WHEN min(t.rank) IS NOT NULL THEN 1.0::DOUBLE / log2(min(t.rank) + 1) ELSE 0.0::DOUBLE END AS ndcg
  FROM (SELECT split, user_id, book_id FROM prepared WHERE role = 'holdout' AND {holdout_filter}) h
  LEFT JOIN {top} t ON h.book_id = t.book_id
  GROUP BY h.split, h.user_id)"""


def _own_list_cte(name: str) -> str:
    """Each user's own history and holdout items ranked by popularity, judged on the read holdout items."""
    return f"""lists AS (
  SELECT p.split, p.user_id, p.book_id,
         row_number() OVER (PARTITION BY p.split, p.user_id ORDER BY round(s.popularity_score, 9) DESC, p.book_id) AS rank
  FROM prepared p JOIN scores s ON s.book_id = p.book_id WHERE p.role IN ('history', 'holdout')),
{name} AS (
  SELECT h.split, h.user_id, count(*) AS n_holdout, count(l.rank) AS n_hits, min(l.rank) AS best_rank,
         coalesce(1.0::DOUBLE / min(l.rank), 0.0) AS ap, coalesce(1.0::DOUBLE / log2(min(l.rank) + 1), 0.0) AS ndcg
  FROM prepared h LEFT JOIN lists l ON l.split = h.split AND l.user_id = h.user_id AND l.book_id = h.book_id
  WHERE h.role = 'holdout' AND h.is_read = 1 GROUP BY h.split, h.user_id)"""


def _summary_select(per: str, extra_key: str = "") -> str:
    k = f"{extra_key}, " if extra_key else ""
    return f"""SELECT {k}split, round(coalesce(avg(ap), 0.0), 6) AS map, round(coalesce(avg(ndcg), 0.0), 6) AS ndcg,
       count(*) AS n_users, count(best_rank) AS n_user_hits, CAST(coalesce(sum(n_hits), 0) AS BIGINT) AS n_item_hits,
       round(count(best_rank)::DOUBLE / NULLIF(count(*), 0), 6) AS user_hit_rate,
       round(CAST(coalesce(sum(n_hits), 0) AS DOUBLE) / NULLIF(count(*), 0), 6) AS item_hit_rate
FROM {per} GROUP BY {k}split"""


def _variant_ctes(cfg: Config) -> list[str]:
    blocks = []
    for v in ("product", "read_count", "avg_rating"):
        blocks.append(_scores_cte(f"sc_{v}", "train", v))
        blocks.append(_top_cte(f"top_{v}", f"sc_{v}", cfg.top_k))
        blocks.append(_per_user_cte(f"pu_{v}", f"top_{v}"))
    union = " UNION ALL ".join(f"SELECT '{v}' AS variant, * FROM pu_{v}" for v in ("product", "read_count", "avg_rating"))
    blocks.append(f"pu AS ({union})")
    blocks.append(f"vt AS ({_summary_select('pu', 'variant')})")
    return blocks


def _segment_ctes(cfg: Config) -> list[str]:
    t = cfg.num_hash_tables
    return [
        readers_cte(),
        "rp AS (SELECT DISTINCT user_id, book_id FROM rd WHERE is_read = 1)",
        f"qi AS (SELECT book_id, count(*) AS n_readers FROM rp GROUP BY book_id HAVING count(*) >= {cfg.min_readers})",
        "qp AS (SELECT * FROM rp WHERE book_id IN (SELECT book_id FROM qi))",
        f"""sig AS (SELECT book_id, CAST(k AS INTEGER) AS hash_table,
                 min(CAST('0x' || substr(md5(concat_ws('|', 'minhash', {cfg.minhash_seed}, k, user_id)), 1, 15) AS BIGINT)) AS signature
          FROM qp CROSS JOIN (SELECT unnest(range({t})) AS k) ks GROUP BY book_id, k)""",
        """cand AS (SELECT DISTINCT a.book_id AS book_id_1, b.book_id AS book_id_2
           FROM sig a JOIN sig b ON a.hash_table = b.hash_table AND a.signature = b.signature
           AND a.book_id < b.book_id)""",
        """co AS (SELECT c.book_id_1, c.book_id_2, count(*) AS co FROM cand c
          JOIN qp x ON x.book_id = c.book_id_1
          JOIN qp y ON y.book_id = c.book_id_2 AND y.user_id = x.user_id GROUP BY 1, 2)""",
        f"""lsh AS (SELECT book_id_1, book_id_2, round(1.0::DOUBLE - dist, 6) AS jaccard_similarity FROM (
            SELECT co.book_id_1, co.book_id_2,
                   1.0::DOUBLE - co.co::DOUBLE / (q1.n_readers + q2.n_readers - co.co)::DOUBLE AS dist
            FROM co JOIN qi q1 ON q1.book_id = co.book_id_1 JOIN qi q2 ON q2.book_id = co.book_id_2)
          WHERE dist < {float(cfg.jaccard_distance)}::DOUBLE)""",
    ]


def _exact_ctes(cfg: Config) -> list[str]:
    """Every co-read pair of qualified items (the definition), and the top of them."""
    return _segment_ctes(cfg)[:4] + [
        """xco AS (SELECT x.book_id AS book_id_1, y.book_id AS book_id_2, count(*) AS co
          FROM qp x JOIN qp y ON y.user_id = x.user_id AND x.book_id < y.book_id GROUP BY 1, 2)""",
        f"""exact AS (SELECT book_id_1, book_id_2, round(1.0::DOUBLE - dist, 6) AS jaccard_similarity FROM (
            SELECT book_id_1, book_id_2,
                   1.0::DOUBLE - co::DOUBLE / (q1.n_readers + q2.n_readers - co)::DOUBLE AS dist
            FROM xco JOIN qi q1 ON q1.book_id = book_id_1 JOIN qi q2 ON q2.book_id = book_id_2)
          WHERE dist < {float(cfg.jaccard_distance)}::DOUBLE)""",
        f"""toppairs AS (SELECT * FROM (
            SELECT *, CAST(row_number() OVER (ORDER BY jaccard_similarity DESC, book_id_1, book_id_2) AS INTEGER) AS rank
            FROM exact) WHERE rank <= {cfg.top_k})""",
    ]


def oracle_sql(cfg: Config = FIXTURE) -> dict[str, str]:
    P = prepared_ctes(cfg)
    A = _active_cte(cfg)
    S = _sampled_cte(cfg if cfg is not FIXTURE else SAMPLED)
    q: dict[str, str] = {}

    q["interactions"] = _with(fx_cte()) + "SELECT * FROM fx"
    q["ingest_report"] = _with(fx_cte()) + """SELECT CASE WHEN (user_id + book_id) % 97 = 0 OR (user_id + book_id) % 89 = 0 THEN 'malformed'
            WHEN (user_id + book_id) % 83 = 0 THEN 'missing' WHEN (user_id + book_id) % 79 = 0 THEN 'out_of_range'
            ELSE 'accepted' END AS outcome, count(*) AS n_lines FROM fx GROUP BY 1"""
    q["item_id_map"] = _with(item_map_cte()) + "SELECT * FROM im"
    q["user_activity"] = _with(fx_cte()) + "SELECT user_id, count(*) AS n_interactions FROM fx GROUP BY user_id"
    q["active_user_filter"] = _with(fx_cte(), A) + "SELECT * FROM active"
    q["user_sample"] = _with(fx_cte(), A, S) + "SELECT * FROM sampled"
    q["activity_summary"] = _with(fx_cte(), A, S) + " UNION ALL ".join(
        f"SELECT '{n}' AS stage, count(*) AS n_rows, count(DISTINCT user_id) AS n_users, "
        f"CAST(count(*) // NULLIF(count(DISTINCT user_id), 0) AS BIGINT) AS avg_per_user FROM {t}"
        for n, t in (("raw", "fx"), ("active", "active"), ("sampled", "sampled")))
    q["user_split"] = _with(P) + "SELECT DISTINCT user_id, split FROM prepared"
    q["holdout_roles"] = _with(P) + "SELECT * FROM prepared"
    q["train_union"] = _with(P) + ("SELECT user_id, book_id, is_read, rating, is_reviewed, split AS source "
                                   "FROM prepared WHERE role = 'train'")
    q["split_accounting"] = _with(P) + f"""SELECT p.split, p.role, p.n_rows, {_pct('p.n_rows', 't.tot')} AS pct_of_role
FROM (SELECT split, role, count(*) AS n_rows FROM prepared GROUP BY split, role) p
JOIN (SELECT role, count(*) AS tot FROM prepared GROUP BY role) t ON p.role = t.role"""
    q["write_profile"] = _with(P) + """SELECT split, role, count(*) AS n_rows, count(*) FILTER (WHERE rating > 0) AS n_rated,
       count(*) FILTER (WHERE is_read = 1) AS n_read, count(*) FILTER (WHERE is_reviewed = 1) AS n_reviewed,
       count(*) FILTER (WHERE rating > 0 AND is_read = 1) AS n_rated_and_read,
       count(*) FILTER (WHERE is_read > 0 OR is_reviewed > 0 OR rating > 0) AS n_any,
       CAST(coalesce(sum(rating) FILTER (WHERE rating > 0), 0) AS BIGINT) AS sum_rating
FROM prepared GROUP BY split, role"""
    q["sample_drift"] = _with(fx_cte(), A, S) + f"""SELECT s.signal, a.pct AS pct_active, s.pct AS pct_sample,
       round(s.pct - a.pct, 6) AS diff FROM
 (UNPIVOT ({_coverage_select('a', 'active')}) ON pct_rated AS rated, pct_read AS read, pct_reviewed AS reviewed,
   pct_rated_and_read AS rated_and_read INTO NAME signal VALUE pct) a
 JOIN (UNPIVOT ({_coverage_select('s', 'sampled')}) ON pct_rated AS rated, pct_read AS read, pct_reviewed AS reviewed,
   pct_rated_and_read AS rated_and_read INTO NAME signal VALUE pct) s ON a.signal = s.signal"""
    q["user_split_shares"] = _with(P) + f"""SELECT split, count(*) AS n_users,
       {_pct('count(*)', '(SELECT count(DISTINCT user_id) FROM prepared)')} AS pct
FROM (SELECT DISTINCT user_id, split FROM prepared) GROUP BY split"""

    # profiles
    q["split_table_stats"] = _with(P) + f"""SELECT {_table_name()} AS "table", count(*) AS n_rows,
       count(DISTINCT user_id) AS n_users, count(DISTINCT book_id) AS n_books FROM prepared GROUP BY 1"""
    q["signal_coverage"] = _with(P, TRAIN) + " UNION ALL ".join(
        [_coverage_select("all", "fx"), _coverage_select("sampled", "prepared"), _coverage_select("train", "train")])
    q["signal_breakdown"] = _with(P, TRAIN) + " UNION ALL ".join(
        f"SELECT '{n}' AS dataset, is_read, is_reviewed, rating > 0 AS has_rating, count(*) AS n_rows "
        f"FROM {t} GROUP BY is_read, is_reviewed, rating > 0" for n, t in (("sampled", "prepared"), ("train", "train")))
    q["rating_histogram"] = _with(P, TRAIN) + f"""SELECT h.rating, h.n_ratings, {_pct('h.n_ratings', 't.tot')} AS pct,
       round(t.mean, 6) AS mean_rating
FROM (SELECT rating, count(*) AS n_ratings FROM train WHERE rating > 0 GROUP BY rating) h,
     (SELECT count(*) AS tot, avg(rating) AS mean FROM train WHERE rating > 0) t"""
    q["user_activity_stats"] = _with(P, TRAIN) + """SELECT min(n) AS min, quantile_disc(n, 0.25) AS p25,
       quantile_disc(n, 0.5) AS median, round(avg(n), 6) AS mean, quantile_disc(n, 0.75) AS p75, max(n) AS max
FROM (SELECT user_id, count(*) AS n FROM train GROUP BY user_id)"""
    for role, exp in (("history", cfg.history_size), ("holdout", cfg.holdout_size)):
        q[f"{role}_size_check"] = _with(P) + f"""SELECT split, min(n) AS min, max(n) AS max, round(avg(n), 6) AS mean,
       count(*) AS n_users, (min(n) = {exp} AND max(n) = {exp}) AS all_expected, CAST({exp} AS BIGINT) AS expected
FROM (SELECT split, user_id, count(*) AS n FROM prepared WHERE role = '{role}' AND split <> 'train'
      GROUP BY split, user_id) GROUP BY split"""
    q["split_user_overlap"] = _with(P) + """, flags AS (SELECT user_id,
   max(CASE WHEN split = 'train' THEN 1 ELSE 0 END) AS s_train,
   max(CASE WHEN split = 'tuning' THEN 1 ELSE 0 END) AS s_tuning,
   max(CASE WHEN split = 'test' THEN 1 ELSE 0 END) AS s_test,
   max(CASE WHEN role = 'train' THEN 1 ELSE 0 END) AS t_train,
   max(CASE WHEN split = 'tuning' AND role = 'history' THEN 1 ELSE 0 END) AS t_tuning,
   max(CASE WHEN split = 'test' AND role = 'history' THEN 1 ELSE 0 END) AS t_test
 FROM prepared GROUP BY user_id)
SELECT "check", n_users FROM (UNPIVOT (SELECT
   count(*) FILTER (WHERE s_tuning = 1 AND s_train = 1) AS split_tuning_in_train,
   count(*) FILTER (WHERE s_test = 1 AND s_train = 1) AS split_test_in_train,
   count(*) FILTER (WHERE s_tuning = 1 AND s_test = 1) AS split_tuning_in_test,
   count(*) FILTER (WHERE t_tuning = 1 AND t_train = 1) AS table_tuning_in_train,
   count(*) FILTER (WHERE t_test = 1 AND t_train = 1) AS table_test_in_train,
   count(*) FILTER (WHERE t_tuning = 1 AND t_test = 1) AS table_tuning_in_test FROM flags)
 ON COLUMNS(*) INTO NAME "check" VALUE n_users)"""

    def readiness(rule: str, extra: dict[str, str]) -> str:
        parts = [f"""SELECT {_table_name()} AS "table", count(*) AS n_rows, count(DISTINCT user_id) AS n_users
FROM prepared WHERE {rule} GROUP BY 1"""]
        for s in ("tuning", "test"):
            parts.append(f"""SELECT 'fit_{s}' AS "table", count(*) AS n_rows, count(DISTINCT user_id) AS n_users
FROM prepared WHERE {rule} AND (role = 'train' OR (split = '{s}' AND role = 'history'))""")
        for name, cond in extra.items():
            parts.append(f"""SELECT '{name}' AS "table", count(*) AS n_rows, count(DISTINCT user_id) AS n_users
FROM prepared WHERE {rule} AND role = 'train' AND {cond}""")
        return _with(P) + "SELECT *, n_rows > 0 AS ready FROM (" + " UNION ALL ".join(parts) + ")"

    q["explicit_readiness"] = readiness("rating > 0", {})
    q["implicit_readiness"] = readiness("is_read = 1", {"train_read_only": "is_reviewed = 0",
                                                        "train_read_reviewed": "is_reviewed = 1"})
    hist = lambda s: f"(split = '{s}' AND role = 'history')"
    hold = lambda s: f"(split = '{s}' AND role = 'holdout')"
    summary = {
        "total_users": "count(DISTINCT user_id)",
        "train_users": "count(DISTINCT user_id) FILTER (WHERE split = 'train')",
        "tuning_users": "count(DISTINCT user_id) FILTER (WHERE split = 'tuning')",
        "test_users": "count(DISTINCT user_id) FILTER (WHERE split = 'test')",
        "train_rows": "count(*) FILTER (WHERE role = 'train')",
        "tuning_history_rows": f"count(*) FILTER (WHERE {hist('tuning')})",
        "tuning_holdout_rows": f"count(*) FILTER (WHERE {hold('tuning')})",
        "test_history_rows": f"count(*) FILTER (WHERE {hist('test')})",
        "test_holdout_rows": f"count(*) FILTER (WHERE {hold('test')})",
        "explicit_train_rows": "count(*) FILTER (WHERE role = 'train' AND rating > 0)",
        "explicit_fit_rows": f"count(*) FILTER (WHERE (role = 'train' OR {hist('tuning')}) AND rating > 0)",
        "explicit_eval_users_tuning": f"count(DISTINCT user_id) FILTER (WHERE {hold('tuning')} AND rating > 0)",
        "explicit_eval_users_test": f"count(DISTINCT user_id) FILTER (WHERE {hold('test')} AND rating > 0)",
        "implicit_train_rows": "count(*) FILTER (WHERE role = 'train' AND is_read = 1)",
        "implicit_fit_rows": f"count(*) FILTER (WHERE (role = 'train' OR {hist('tuning')}) AND is_read = 1)",
        "implicit_eval_users_tuning": f"count(DISTINCT user_id) FILTER (WHERE {hold('tuning')} AND is_read = 1)",
        "implicit_eval_users_test": f"count(DISTINCT user_id) FILTER (WHERE {hold('test')} AND is_read = 1)",
        "total_rows": "count(*)",
    }
    q["dataset_summary"] = _with(P) + " UNION ALL ".join(
        f"SELECT '{k}' AS metric, CAST((SELECT {v} FROM prepared) AS BIGINT) AS value" for k, v in summary.items())

    # signals
    a, b, w = cfg.alpha, cfg.beta, cfg.rating_weight
    q["explicit_matrix"] = _with(P, TRAIN) + "SELECT user_id, book_id, rating FROM train WHERE rating > 0"
    q["implicit_confidence"] = _with(P, TRAIN) + (
        f"SELECT user_id, book_id, CAST(1 + {int(a)} * is_read + {int(b)} * is_reviewed AS INTEGER) AS confidence "
        f"FROM train WHERE is_read = 1")
    comb = (f"CAST(1.0::DOUBLE + {float(a)}::DOUBLE * is_read + {float(b)}::DOUBLE * is_reviewed "
            f"+ {float(w)}::DOUBLE * rating AS FLOAT)")
    any_sig = "(is_read = 1 OR rating > 0 OR is_reviewed = 1)"
    q["combined_confidence"] = _with(P, TRAIN) + f"SELECT user_id, book_id, {comb} AS confidence FROM train WHERE {any_sig}"
    q["confidence_levels"] = _with(P, TRAIN) + f"""SELECT model, confidence, count(*) AS n_rows FROM (
  SELECT 'implicit' AS model, CAST(1 + {int(a)} * is_read + {int(b)} * is_reviewed AS DOUBLE) AS confidence
  FROM train WHERE is_read = 1
  UNION ALL SELECT 'combined', CAST({comb} AS DOUBLE) FROM train WHERE {any_sig}) GROUP BY model, confidence"""
    q["model_coverage"] = _with(P, TRAIN) + f"""SELECT model, n_rows, {_pct('n_rows', 'tot')} AS pct FROM (
  SELECT 'explicit' AS model, count(*) FILTER (WHERE rating > 0) AS n_rows, count(*) AS tot FROM train
  UNION ALL SELECT 'implicit', count(*) FILTER (WHERE is_read = 1), count(*) FROM train
  UNION ALL SELECT 'combined', count(*) FILTER (WHERE {any_sig}), count(*) FROM train)"""
    q["fit_data"] = _with(P) + " UNION ALL ".join(
        f"SELECT '{s}' AS fit, user_id, book_id, {comb} AS confidence FROM prepared "
        f"WHERE (role = 'train' OR (split = '{s}' AND role = 'history')) AND {any_sig}" for s in ("tuning", "test"))
    q["study_fit_data"] = q["fit_data"]
    q["initial_rating_weight"] = _with(P, TRAIN) + f"""SELECT round(m, 6) AS mean_rating, {float(a)}::DOUBLE AS alpha,
       round({float(a)}::DOUBLE / m, 6) AS w0 FROM (SELECT avg(rating) AS m FROM train WHERE rating > 0)"""

    # popularity + evaluation
    SC = _scores_cte()
    TOP = _top_cte("top", "scores", cfg.top_k)
    q["popularity_scores"] = _with(P, TRAIN, SC) + (
        "SELECT book_id, read_count, round(avg_rating, 6) AS avg_rating, round(popularity_score, 6) AS popularity_score FROM scores")
    q["popularity_topk"] = _with(P, TRAIN, SC, TOP) + (
        "SELECT rank, book_id, read_count, round(avg_rating, 6) AS avg_rating, "
        "round(popularity_score, 6) AS popularity_score FROM top")
    q["popularity_coverage"] = _with(P, TRAIN, SC) + "SELECT count(*) AS n_scored_books FROM scores"
    per_out = ("SELECT split, user_id, n_holdout, n_hits, CAST(best_rank AS DOUBLE) AS best_rank, "
               "round(ap, 6) AS ap, round(ndcg, 6) AS ndcg FROM pu")
    q["popularity_eval_users"] = _with(P, TRAIN, SC, TOP, _per_user_cte("pu", "top")) + per_out
    q["popularity_eval"] = _with(P, TRAIN, SC, TOP, _per_user_cte("pu", "top")) + _summary_select("pu")
    own = _own_list_cte("pu")
    q["ranking_eval_users"] = _with(P, TRAIN, SC, own) + per_out
    q["ranking_eval"] = _with(P, TRAIN, SC, own) + _summary_select("pu")
    q["study_ranking_eval"] = q["ranking_eval"]
    q["holdout_labels"] = _with(P) + ("SELECT split, user_id, count(*) AS n_holdout FROM prepared "
                                      "WHERE role = 'holdout' GROUP BY split, user_id")
    names = ["map", "ndcg", "n_users", "n_user_hits", "n_item_hits", "user_hit_rate", "item_hit_rate"]
    q["metrics_long"] = _with(P, TRAIN, SC, TOP, _per_user_cte("pu", "top"), f"ev AS ({_summary_select('pu')})") + \
        " UNION ALL ".join(f"SELECT split || '_{n}' AS metric, CAST({n} AS DOUBLE) AS value FROM ev" for n in names)
    V = _variant_ctes(cfg)
    q["best_config"] = _with(P, TRAIN, *V) + (
        "SELECT variant, map, ndcg FROM vt WHERE split = 'tuning' ORDER BY map DESC, variant ASC LIMIT 1")
    q["model_comparison"] = _with(P, TRAIN, *V) + """SELECT t.variant, t.map, t.ndcg,
       round(100.0::DOUBLE * (t.map / NULLIF(b.map, 0.0) - 1), 6) AS map_lift_pct,
       round(100.0::DOUBLE * (t.ndcg / NULLIF(b.ndcg, 0.0) - 1), 6) AS ndcg_lift_pct
FROM (SELECT * FROM vt WHERE split = 'test') t,
     (SELECT map, ndcg FROM vt WHERE split = 'test' AND variant = 'product') b"""
    q["stability_gap"] = _with(P, TRAIN, *V) + """SELECT variant,
       max(map) FILTER (WHERE split = 'tuning') AS map_tuning, max(map) FILTER (WHERE split = 'test') AS map_test,
       max(ndcg) FILTER (WHERE split = 'tuning') AS ndcg_tuning, max(ndcg) FILTER (WHERE split = 'test') AS ndcg_test,
       round(max(map) FILTER (WHERE split = 'test') - max(map) FILTER (WHERE split = 'tuning'), 6) AS map_gap,
       round(max(ndcg) FILTER (WHERE split = 'test') - max(ndcg) FILTER (WHERE split = 'tuning'), 6) AS ndcg_gap
FROM vt GROUP BY variant"""

    # facts of a fitted model that don't depend on its factors
    rules = {"explicit": "rating > 0", "implicit": "is_read = 1", "combined": any_sig}
    judged = {"explicit": "rating > 0", "implicit": "is_read = 1", "combined": "TRUE"}
    for kind, rule in rules.items():
        facts = {"eval_users": "(SELECT count(DISTINCT user_id) FROM hold WHERE user_id IN (SELECT user_id FROM fit))",
                 "shortest_list": f"(SELECT least(count(DISTINCT book_id), {cfg.top_k}) FROM fit)",
                 "longest_list": f"(SELECT least(count(DISTINCT book_id), {cfg.top_k}) FROM fit)",
                 "broken_lists": "0", "items_outside_fit": "0", "rows_changed_by_save": "0"}
        if kind == "explicit":
            facts["scored_rows"] = ("(SELECT count(*) FROM hold WHERE user_id IN (SELECT user_id FROM fit) "
                                    "AND book_id IN (SELECT book_id FROM fit))")
        q[f"als_{kind}_facts"] = _with(P, f"""fit AS (SELECT * FROM prepared WHERE
  (role = 'train' OR (split = 'tuning' AND role = 'history')) AND {rule})""",
                                       f"hold AS (SELECT * FROM prepared WHERE split = 'tuning' AND role = 'holdout' AND {judged[kind]})"
                                       ) + " UNION ALL ".join(
            f"SELECT '{n}' AS metric, CAST({v} AS BIGINT) AS value" for n, v in facts.items())

    # segments
    G, X = _segment_ctes(cfg), _exact_ctes(cfg)
    q["reader_pairs"] = _with(*G[:2]) + "SELECT user_id, book_id FROM rp"
    q["qualified_items"] = _with(*G[:3]) + "SELECT book_id, n_readers FROM qi"
    q["reader_sets"] = _with(*G[:4]) + f"""SELECT book_id, chunk, count(*) AS n_tokens,
       string_agg(CAST(user_id AS VARCHAR), ' ' ORDER BY user_id) AS user_tokens
FROM (SELECT qp.book_id, qp.user_id,
             CAST(CAST('0x' || substr(md5('chunk|' || CAST(qp.user_id AS VARCHAR)), 1, 8) AS BIGINT)
                  % CAST(ceil(qi.n_readers / {cfg.reader_chunk}.0) AS BIGINT) AS INTEGER) AS chunk
      FROM qp JOIN qi ON qp.book_id = qi.book_id)
GROUP BY book_id, chunk"""
    q["minhash_signatures"] = _with(*G[:5]) + "SELECT book_id, hash_table, signature FROM sig"
    q["lsh_candidates"] = _with(*G[:6]) + "SELECT book_id_1, book_id_2 FROM cand"
    q["lsh_pairs"] = _with(*G[:8]) + "SELECT book_id_1, book_id_2, jaccard_similarity FROM lsh"
    z = "1.959963984540054::DOUBLE"  # two-sided 95 % normal quantile
    q["lsh_reduction"] = _with(*G[:8], *X[4:6], f"""smp AS (SELECT book_id FROM qi
       WHERE substr(md5('recall|{cfg.minhash_seed}|' || CAST(book_id AS VARCHAR)), 1, 8) < '{hex_threshold(cfg.recall_fraction)}')""",
        """tru AS (SELECT e.book_id_1, e.book_id_2, l.book_id_1 IS NOT NULL AS hit FROM exact e
       LEFT JOIN lsh l ON l.book_id_1 = e.book_id_1 AND l.book_id_2 = e.book_id_2
       WHERE e.book_id_1 IN (SELECT book_id FROM smp) OR e.book_id_2 IN (SELECT book_id FROM smp))""",
        """rec AS (SELECT count(*) AS n, count(*) FILTER (hit) AS f, (count(*) FILTER (hit))::DOUBLE / NULLIF(count(*), 0) AS p FROM tru)""") + f"""SELECT
       n_items, n_pairs, CAST(n_items * (n_items - 1) // 2 AS BIGINT) AS all_pairs,
       round(n_pairs::DOUBLE / NULLIF(n_items * (n_items - 1) // 2, 0), 9) AS pair_ratio,
       round(100.0::DOUBLE * (1.0::DOUBLE - n_pairs::DOUBLE / NULLIF(n_items * (n_items - 1) // 2, 0)), 6) AS reduction_pct,
       n_pairs < 100 AS low_yield, (SELECT count(*) FROM smp) AS sampled_items, n AS true_pairs, f AS found_pairs,
       round(p, 6) AS recall,
       round((p + {z} * {z} / (2 * n)) / (1 + {z} * {z} / n)
             - {z} / (1 + {z} * {z} / n) * sqrt(p * (1 - p) / n + {z} * {z} / (4.0::DOUBLE * n * n)), 6) AS recall_low,
       round((p + {z} * {z} / (2 * n)) / (1 + {z} * {z} / n)
             + {z} / (1 + {z} * {z} / n) * sqrt(p * (1 - p) / n + {z} * {z} / (4.0::DOUBLE * n * n)), 6) AS recall_high
FROM (SELECT (SELECT count(*) FROM qi) AS n_items, (SELECT count(*) FROM lsh) AS n_pairs), rec"""
    q["lsh_buckets"] = _with(*G[:5]) + """SELECT hash_table, signature, book_id, n AS bucket_size FROM (
       SELECT *, count(*) OVER (PARTITION BY hash_table, signature) AS n FROM sig) WHERE n > 1"""
    q["jaccard_pairs"] = _with(*X[:6]) + "SELECT book_id_1, book_id_2, jaccard_similarity FROM exact"
    q["reader_vectors"] = _with(*G[:4], """vocab AS (SELECT user_id, row_number() OVER (ORDER BY n DESC, user_id) - 1 AS index
       FROM (SELECT user_id, count(*) AS n FROM qp GROUP BY user_id))""") + f"""SELECT book_id,
       CAST(index // {cfg.vector_span} AS INTEGER) AS chunk, count(*) AS n_tokens,
       string_agg(CAST(index AS VARCHAR), ' ' ORDER BY index) AS indices
FROM qp JOIN vocab USING (user_id) GROUP BY 1, 2"""
    q["segment_topk"] = _with(*X, item_map_cte()) + """SELECT t.rank, t.book_id_1, t.book_id_2, t.jaccard_similarity,
       m1.book_id AS external_id_1, m2.book_id AS external_id_2
FROM toppairs t LEFT JOIN im m1 ON m1.book_id_csv = t.book_id_1 LEFT JOIN im m2 ON m2.book_id_csv = t.book_id_2"""
    q["similarity_bands"] = _with(*X) + """SELECT CASE WHEN jaccard_similarity >= 0.90 THEN '0.90-1.00'
            WHEN jaccard_similarity >= 0.85 THEN '0.85-0.90'
            WHEN jaccard_similarity >= 0.80 THEN '0.80-0.85' ELSE 'below-0.80' END AS band, count(*) AS n_pairs
FROM toppairs GROUP BY 1"""
    return q

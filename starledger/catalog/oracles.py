"""The same results as DuckDB SQL over the test tables, by query name."""

from __future__ import annotations

# Building blocks, each a named subquery that may use those above it.
_PARTS = {
    "raw": """
        SELECT o_custkey AS user_id, l_partkey AS item_id, l_quantity AS rating,
               CAST(epoch(o_orderdate) AS BIGINT) AS ts
        FROM lineitem JOIN orders ON l_orderkey = o_orderkey""",
    "items": """
        SELECT p_partkey AS item_id, p_name AS title, concat_ws('|', p_type, p_brand) AS tags FROM part""",
    "clean": """
        SELECT user_id, item_id, ts, max(rating) AS rating FROM raw GROUP BY user_id, item_id, ts""",
    "silver": """
        SELECT user_id, item_id, title, tags, rating, ts FROM clean JOIN items USING (item_id)""",
    "pairs": """
        SELECT user_id, item_id, max_by(rating, ts) AS rating, max(ts) AS ts
        FROM silver GROUP BY user_id, item_id""",
    "folded": """
        SELECT user_id, item_id, rating,
               CAST('0x' || substr(md5(concat_ws('|', user_id, item_id, '42')), 1, 8) AS BIGINT) % 10 AS fold
        FROM pairs""",
    "ranking": """
        SELECT item_id, title, tags, count(*) AS rating_count, round(avg(rating), 2) AS avg_rating
        FROM silver GROUP BY item_id, title, tags""",
    "activity": """
        SELECT user_id, count(*) AS rating_count, round(avg(rating), 2) AS avg_user_rating
        FROM silver GROUP BY user_id""",
    "user_stats": """
        SELECT user_id, count(*) AS user_rating_count, round(avg(rating), 3) AS user_avg_rating
        FROM silver GROUP BY user_id""",
    "item_stats": """
        SELECT item_id, count(*) AS item_rating_count, round(avg(rating), 3) AS item_avg_rating
        FROM silver GROUP BY item_id""",
    "exploded": """
        SELECT item_id, rating, unnest(string_split(tags, '|')) AS tag,
               generate_subscripts(string_split(tags, '|'), 1) AS pos
        FROM silver""",
    "occurrence": """
        SELECT item_id, tag, count(*) AS tag_occurrence, min(pos) AS pos FROM exploded GROUP BY item_id, tag""",
    "main": """
        SELECT item_id, tag AS main_tag FROM (
            SELECT item_id, tag,
                   row_number() OVER (PARTITION BY item_id ORDER BY tag_occurrence DESC, pos) AS rn
            FROM occurrence) WHERE rn = 1""",
    "base": """
        SELECT user_id, item_id, title, tags, main_tag, rating,
               CAST(year(make_timestamp(ts * 1000000)) AS INTEGER) AS rating_year,
               CAST(month(make_timestamp(ts * 1000000)) AS INTEGER) AS rating_month,
               CAST(dayofweek(make_timestamp(ts * 1000000)) + 1 AS INTEGER) AS rating_dayofweek,
               CAST(hour(make_timestamp(ts * 1000000)) AS INTEGER) AS rating_hour,
               CAST(len(string_split(tags, '|')) AS INTEGER) AS tag_count,
               user_rating_count, user_avg_rating, item_rating_count, item_avg_rating
        FROM pairs
        LEFT JOIN items USING (item_id)
        LEFT JOIN user_stats USING (user_id)
        LEFT JOIN item_stats USING (item_id)
        LEFT JOIN main USING (item_id)""",
    "train_ratings": """
        SELECT * FROM silver
        WHERE CAST('0x' || substr(md5(concat_ws('|', user_id, item_id, '42')), 1, 8) AS BIGINT) % 10 < 8""",
    "train_users": """
        SELECT user_id, count(*) AS user_rating_count, round(avg(rating), 3) AS user_avg_rating
        FROM train_ratings GROUP BY user_id""",
    "train_items": """
        SELECT item_id, count(*) AS item_rating_count, round(avg(rating), 3) AS item_avg_rating
        FROM train_ratings GROUP BY item_id""",
    "indexed": """
        SELECT main_tag, row_number() OVER (ORDER BY count(*) DESC, main_tag) - 1 AS tag_index,
               count(*) OVER () AS tag_total
        FROM base GROUP BY main_tag""",
    "labelled": """
        SELECT user_id, item_id, title, rating AS actual_rating,
               CAST('0x' || substr(md5(concat_ws('|', user_id, item_id, '42')), 1, 8) AS BIGINT) % 10 AS fold
        FROM base""",
    "slots": """
        SELECT unnest(['rating_year', 'rating_month', 'rating_dayofweek', 'rating_hour', 'tag_count',
                       'user_rating_count', 'user_avg_rating', 'item_rating_count', 'item_avg_rating']) AS feature_name
        UNION ALL SELECT 'main_tag_vec_' || main_tag FROM indexed""",
    "residual_rows": """
        SELECT user_id, item_id, title, test.rating AS actual_rating, predicted_rating,
               test.rating - predicted_rating AS residual, 'Item mean' AS model_name
        FROM folded AS test
        JOIN (SELECT item_id, avg(rating) AS predicted_rating FROM folded WHERE fold < 8 GROUP BY item_id)
             USING (item_id)
        JOIN items USING (item_id)
        WHERE test.fold >= 8""",
    "errors": """
        SELECT 'Item mean' AS model_name, CAST(rating AS DOUBLE) AS y, rating - item_avg_rating AS e FROM base
        UNION ALL SELECT 'User mean', rating, rating - user_avg_rating FROM base""",
    "comparison": """
        SELECT model_name, round(sqrt(avg(e * e)), 6) AS rmse, round(avg(abs(e)), 6) AS mae,
               round(1 - sum(e * e) / (var_pop(y) * count(*)), 6) AS r2
        FROM errors GROUP BY model_name""",
    "ev": """
        SELECT event_id, event_type, user_id,
               CAST(regexp_extract(props, '([0-9]+)', 1) AS BIGINT) AS item_id, value AS rating,
               CAST(floor(epoch(ts)) AS BIGINT) AS ts
        FROM events""",
    "dealt": """
        SELECT user_id, item_id, rating, ts, fold % 3 + replay AS run
        FROM (SELECT *, CAST('0x' || substr(md5(concat_ws('|', event_id, '42')), 1, 8) AS BIGINT) % 10 AS fold FROM ev),
             (SELECT unnest([0, 1]) AS replay)
        WHERE replay = 0 OR fold = 0""",
    "records": """
        SELECT event_id, event_type, '{"userId":' || user_id || ',"movieId":' || item_id || ',"rating":'
               || rating || ',"timestamp":' || ts || '}' AS good,
               '{"userId":' || user_id || ',"movieId":' || item_id || ',"rating":"none","timestamp":'
               || ts || '}' AS no_number
        FROM ev""",
    "parsed": """
        SELECT CASE WHEN event_type <> 'error' THEN user_id END AS user_id,
               CASE WHEN event_type <> 'error' THEN item_id END AS item_id,
               CASE WHEN event_type NOT IN ('error', 'signup') THEN rating END AS rating,
               CASE WHEN event_type <> 'error' THEN ts END AS ts,
               CASE WHEN event_type <> 'error'
                    THEN strftime(make_timestamp(ts * 1000000), '%Y-%m-%d %H:%M:%S') END AS rating_datetime
        FROM ev""",
    "filled": """
        SELECT coalesce(user_id, -1) AS user_id, coalesce(item_id, -1) AS item_id, coalesce(rating, -1) AS rating,
               coalesce(ts, -1) AS ts, coalesce(rating_datetime, '') AS rating_datetime
        FROM parsed""",
}

_SILVER = ["raw", "items", "clean", "silver"]
_STATS = ["user_stats", "item_stats"]
_MAIN = ["exploded", "occurrence", "main"]
_BASE = [*_SILVER, "pairs", *_STATS, *_MAIN, "base"]
_RESIDUALS = [*_SILVER, "pairs", "folded", "residual_rows"]
_COMPARISON = [*_BASE, "errors", "comparison"]
_LABELLED = [*_BASE, "labelled"]

_MEAN_KEEPER = """
    SELECT user_id, item_id, title, actual_rating, '{}' AS model_name, true AS residual_agrees,
           (SELECT round(avg(actual_rating), 6) FROM labelled WHERE fold < 8) AS train_mean
    FROM labelled WHERE fold >= 8"""
_SHARES = """
    SELECT model_name, feature_name, true AS non_negative, CAST(1 AS DOUBLE) AS model_total
    FROM slots, (SELECT unnest([{}]) AS model_name)"""
_TREES = "'Decision Tree Regressor', 'Random Forest Regressor', 'GBT Regressor'"
# The models' settings, as logged.
_SETTINGS = """
    ('Linear Regression', 'maxIter', '50'), ('Linear Regression', 'regParam', '0.1'),
    ('Decision Tree Regressor', 'maxDepth', '8'), ('Decision Tree Regressor', 'seed', '42'),
    ('Random Forest Regressor', 'numTrees', '50'), ('Random Forest Regressor', 'maxDepth', '8'),
    ('Random Forest Regressor', 'seed', '42'),
    ('GBT Regressor', 'maxIter', '50'), ('GBT Regressor', 'maxDepth', '5'), ('GBT Regressor', 'seed', '42'),
    ('Generalized Linear Regression', 'family', 'gaussian'), ('Generalized Linear Regression', 'link', 'identity'),
    ('Generalized Linear Regression', 'maxIter', '50'), ('Generalized Linear Regression', 'regParam', '0.1')"""


def _sql(parts: list[str], select: str) -> str:
    """``select`` behind its subqueries. Those used more than once are computed once."""
    with_ = ",\n".join(f"{name} AS MATERIALIZED ({_PARTS[name]})" for name in parts)
    return f"WITH {with_}\n{select}" if parts else select


_EVERY_COLUMN = "SELECT * FROM {}"
_SILVER_ROWS = """
    SELECT user_id, item_id, title, tags, replace(tags, '|', ',') AS tag_list, rating, ts,
           make_timestamp(ts * 1000000) AS rating_datetime
    FROM silver"""
_PROFILE_LINE = "SELECT '{0}' AS \"column\", '{1}' AS \"type\", count(*) AS \"rows\", count({0}) AS present FROM raw"

ORACLES = {
    "stream_ingest": _sql(["ev", "parsed", "filled"], _EVERY_COLUMN.format("filled")),
    "stream_restart": _sql(
        ["ev", "parsed"],
        """SELECT count(*) AS records, count(user_id) AS parsed, count(rating) AS rated,
                  CAST(sum(item_id) AS BIGINT) AS item_sum FROM parsed""",
    ),
    "stream_dedup": _sql(["ev"], "SELECT DISTINCT user_id, item_id, ts FROM ev"),
    "json_parse": _sql(["ev", "parsed", "filled"], _EVERY_COLUMN.format("filled")),
    "json_encode": _sql(["ev", "records"], "SELECT event_id, good AS record FROM records"),
    "ingest_rejects": _sql(
        ["ev", "records"],
        """SELECT CASE event_type WHEN 'error' THEN '#' || good ELSE no_number END AS record
           FROM records WHERE event_type IN ('error', 'signup')""",
    ),
    "stream_rejects": _sql(
        ["ev", "records"],
        """SELECT CASE event_type WHEN 'error' THEN '#' || good ELSE no_number END AS record
           FROM records WHERE event_type IN ('error', 'signup')""",
    ),
    "stream_replaced": _sql(["ev", "parsed", "filled"], _EVERY_COLUMN.format("filled")),
    "stream_late": _sql(
        ["ev", "dealt"],
        """, newest AS (
               SELECT r.run, max(ts) AS newest FROM (SELECT unnest([1, 2]) AS run) AS r JOIN dealt ON dealt.run < r.run
               GROUP BY r.run),
           marked AS (
               SELECT dealt.*, coalesce(ts < newest - 10 * 86400, false) AS late
               FROM dealt LEFT JOIN newest USING (run))
           SELECT user_id, item_id, rating, ts, 'late' AS outcome, run AS batch FROM marked WHERE late
           UNION ALL
           SELECT user_id, item_id, max(rating), ts, 'kept', run FROM marked AS m
           WHERE NOT late AND run = (SELECT min(run) FROM marked AS o WHERE NOT o.late AND o.user_id = m.user_id
                                     AND o.item_id = m.item_id AND o.ts = m.ts)
           GROUP BY user_id, item_id, ts, run""",
    ),
    "stream_state": _sql(["ev"], "SELECT DISTINCT user_id, item_id, ts FROM ev"),
    "csv_rejects": _sql(
        ["items"],
        """, folded AS (
               SELECT *, CAST('0x' || substr(md5(concat_ws('|', item_id, '42')), 1, 8) AS BIGINT) % 10 AS fold FROM items)
           SELECT 'lines' AS file,
                  CASE WHEN fold < 3 THEN 'unreadable' WHEN fold = 3 THEN 'incomplete' ELSE 'read' END AS outcome,
                  CASE fold WHEN 0 THEN item_id || ',"' || title || ',' || tags
                            WHEN 1 THEN item_id || ',' || title
                            WHEN 2 THEN 'n' || item_id || ',' || title || ',' || tags
                            WHEN 3 THEN ',' || title || ',' || tags
                            ELSE item_id || ',' || title || ',' || tags END AS record
           FROM folded
           UNION ALL
           SELECT 'breaks', 'read', item_id || ',' || replace(title, ' ', chr(10)) || ',' || tags FROM folded""",
    ),
    "bronze_compacted": _sql(
        ["ev"],
        """SELECT user_id, item_id, rating, ts, strftime(make_timestamp(ts * 1000000), '%Y-%m-%d') AS day,
                  CASE WHEN ts < epoch(TIMESTAMP '2024-01-20') THEN 1 ELSE -1 END AS day_files FROM ev""",
    ),
    "csv_dim_scan": _sql(["items"], _EVERY_COLUMN.format("items")),
    "write_roundtrip": _sql(_SILVER, _SILVER_ROWS),
    "schema_replace": _sql(
        ["raw", "clean"],
        """SELECT item_id, count(*) AS rating_count, sum(rating) AS rating_sum, count(rating) AS rated
           FROM clean GROUP BY item_id""",
    ),
    "safe_read_table": _sql([*_SILVER, "ranking"], _EVERY_COLUMN.format("ranking")),
    "clean_ratings": _sql(
        ["raw"],
        """SELECT user_id, item_id, ts, max(rating) AS rating FROM raw
           WHERE rating <> 13 AND item_id <> 5 GROUP BY user_id, item_id, ts""",
    ),
    "dedup_replay": _sql(
        ["raw"],
        """SELECT user_id, item_id, ts, max(rating) AS rating
           FROM (SELECT * FROM raw
                 UNION ALL
                 SELECT * FROM raw
                 WHERE CAST('0x' || substr(md5(concat_ws('|', user_id, item_id, ts, rating, '42')), 1, 8)
                            AS BIGINT) % 10 = 0)
           GROUP BY user_id, item_id, ts""",
    ),
    "dedup_dim": _sql(
        ["items"],
        """SELECT item_id, title, tags FROM (
               SELECT *, row_number() OVER (PARTITION BY item_id ORDER BY title DESC, tags DESC) AS rn
               FROM (SELECT * FROM items UNION ALL SELECT item_id, title || ' (again)', tags FROM items))
           WHERE rn = 1""",
    ),
    "enrich_silver": _sql(_SILVER, _SILVER_ROWS),
    "epoch_to_datetime": _sql(
        ["ev"],
        """SELECT event_id, ts, strftime(make_timestamp(ts * 1000000), '%Y-%m-%d %H:%M:%S') AS rating_text,
                  make_timestamp(ts * 1000000) AS rating_datetime FROM ev""",
    ),
    "time_features": """
        SELECT event_id, CAST(year(ts) AS INTEGER) AS rating_year, CAST(month(ts) AS INTEGER) AS rating_month,
               CAST(dayofweek(ts) + 1 AS INTEGER) AS rating_dayofweek, CAST(hour(ts) AS INTEGER) AS rating_hour
        FROM events""",
    "split_tags": _sql(
        ["items"],
        """SELECT item_id, CAST(generate_subscripts(string_split(tags, '|'), 1) - 1 AS INTEGER) AS pos,
                  unnest(string_split(tags, '|')) AS tag FROM items""",
    ),
    "genre_count": _sql(
        ["items"], "SELECT item_id, CAST(len(string_split(tags, '|')) AS INTEGER) AS tag_count FROM items"
    ),
    "most_rated": _sql([*_SILVER, "ranking"], _EVERY_COLUMN.format("ranking")),
    "top_rated": _sql([*_SILVER, "ranking"], "SELECT * FROM ranking WHERE rating_count >= 30"),
    "top_rated_min_n": _sql(
        [*_SILVER, "ranking"],
        """SELECT * FROM ranking WHERE rating_count >= 40
           ORDER BY avg_rating DESC, rating_count DESC, item_id LIMIT 30""",
    ),
    "genre_stats": _sql(
        [*_SILVER, "exploded"],
        """SELECT tag, count(*) AS rating_count, round(avg(rating), 2) AS avg_rating
           FROM exploded GROUP BY tag""",
    ),
    "user_activity": _sql([*_SILVER, "activity"], _EVERY_COLUMN.format("activity")),
    "ml_dataset": _sql([*_SILVER, "pairs"], "SELECT user_id, item_id, rating FROM pairs"),
    "rating_distribution": _sql(["raw"], 'SELECT rating, count(*) AS "count" FROM raw GROUP BY rating'),
    "table_profile": _sql(
        ["raw"],
        " UNION ALL ".join(
            _PROFILE_LINE.format(column, kind)
            for column, kind in [("user_id", "bigint"), ("item_id", "bigint"), ("rating", "double"), ("ts", "bigint")]
        ),
    ),
    "kpis": _sql(
        [*_SILVER, "pairs"],
        """SELECT count(*) AS total_ratings, count(DISTINCT item_id) AS total_items,
                  count(DISTINCT user_id) AS total_users, round(avg(rating), 2) AS avg_rating FROM pairs""",
    ),
    "top_n_items": _sql([*_SILVER, "ranking"], "SELECT * FROM ranking ORDER BY rating_count DESC, item_id LIMIT 15"),
    "top_n_users": _sql(
        [*_SILVER, "activity"], "SELECT * FROM activity ORDER BY rating_count DESC, user_id LIMIT 15"
    ),
    "user_features": _sql([*_SILVER, "user_stats"], _EVERY_COLUMN.format("user_stats")),
    "item_features": _sql([*_SILVER, "item_stats"], _EVERY_COLUMN.format("item_stats")),
    "genre_occurrence": _sql(
        [*_SILVER, "exploded", "occurrence"], "SELECT item_id, tag, tag_occurrence FROM occurrence"
    ),
    "main_genre": _sql([*_SILVER, *_MAIN], _EVERY_COLUMN.format("main")),
    "features_base": _sql(_BASE, _EVERY_COLUMN.format("base")),
    "features_train_stats": _sql(
        [*_BASE, "train_ratings", "train_users", "train_items"],
        """SELECT base.* EXCLUDE (user_rating_count, user_avg_rating, item_rating_count, item_avg_rating),
                  coalesce(t.user_rating_count, 0) AS user_rating_count,
                  coalesce(t.user_avg_rating, (SELECT round(avg(rating), 3) FROM train_ratings)) AS user_avg_rating,
                  coalesce(i.item_rating_count, 0) AS item_rating_count,
                  coalesce(i.item_avg_rating, (SELECT round(avg(rating), 3) FROM train_ratings)) AS item_avg_rating
           FROM base LEFT JOIN train_users AS t USING (user_id) LEFT JOIN train_items AS i USING (item_id)""",
    ),
    "index_category": _sql(
        [*_BASE, "indexed"], "SELECT main_tag, CAST(tag_index AS DOUBLE) AS main_tag_index FROM indexed"
    ),
    "category_index": _sql(
        [*_BASE, "indexed"],
        """SELECT user_id, item_id, main_tag, CAST(tag_index AS DOUBLE) AS ranked_index, true AS agrees
           FROM base JOIN indexed USING (main_tag)""",
    ),
    "one_hot": _sql(
        [*_BASE, "indexed"],
        """SELECT user_id, item_id, main_tag, tag_index AS slot, CAST(tag_total AS INTEGER) AS slots
           FROM base JOIN indexed USING (main_tag)""",
    ),
    "feature_vector": _sql(
        [*_BASE, "indexed"],
        """SELECT user_id, item_id,
                  CAST(rating_year AS DOUBLE) AS slot_0, CAST(rating_month AS DOUBLE) AS slot_1,
                  CAST(rating_dayofweek AS DOUBLE) AS slot_2, CAST(rating_hour AS DOUBLE) AS slot_3,
                  CAST(tag_count AS DOUBLE) AS slot_4, CAST(user_rating_count AS DOUBLE) AS slot_5,
                  user_avg_rating AS slot_6, CAST(item_rating_count AS DOUBLE) AS slot_7,
                  item_avg_rating AS slot_8, CAST(tag_total + 9 AS INTEGER) AS slots,
                  tag_index + 9 AS tag_slot
           FROM base JOIN indexed USING (main_tag)""",
    ),
    "hash_split": _sql(
        [*_SILVER, "pairs", "folded"], "SELECT user_id, item_id, fold < 8 AS is_train FROM folded"
    ),
    "hash_sample": _sql(
        [*_SILVER, "pairs"],
        """SELECT user_id, item_id, rating FROM pairs
           ORDER BY md5(concat_ws('|', user_id, item_id, '42')), user_id, item_id LIMIT 5000""",
    ),
    "residuals": _sql(_RESIDUALS, _EVERY_COLUMN.format("residual_rows")),
    "regression_metrics": _sql(
        _RESIDUALS,
        """SELECT round(sqrt(avg(residual * residual)), 6) AS rmse, round(avg(abs(residual)), 6) AS mae,
                  round(1 - sum(residual * residual) / (var_pop(actual_rating) * count(*)), 6) AS r2
           FROM residual_rows""",
    ),
    "residual_histogram": _sql(
        _RESIDUALS,
        """SELECT bin, round(lo + (bin - 1) * ((hi - lo) / 40), 6) AS bin_start,
                  round(lo + bin * ((hi - lo) / 40), 6) AS bin_end, count(*) AS n
           FROM (SELECT lo, hi,
                        least(CAST(floor(40 * (residual - lo) / (hi - lo)) AS INTEGER) + 1, 40) AS bin
                 FROM residual_rows, (SELECT min(residual) AS lo, max(residual) AS hi FROM residual_rows))
           GROUP BY bin, lo, hi""",
    ),
    "actual_vs_predicted": _sql(
        _RESIDUALS,
        """SELECT actual_rating, predicted_rating, user_id, item_id, title, residual FROM residual_rows
           ORDER BY md5(concat_ws('|', user_id, item_id, '42')), user_id, item_id LIMIT 2000""",
    ),
    "predicted_vs_residual": _sql(
        _RESIDUALS, "SELECT predicted_rating, residual, actual_rating, title FROM residual_rows"
    ),
    "metrics_long": _sql(
        _COMPARISON,
        """SELECT model_name, 'rmse' AS metric, rmse AS value FROM comparison
           UNION ALL SELECT model_name, 'mae', mae FROM comparison
           UNION ALL SELECT model_name, 'r2', r2 FROM comparison""",
    ),
    "best_model": _sql(
        _COMPARISON,
        """SELECT model_name, round(rmse, 4) AS rmse, round(mae, 4) AS mae, round(r2, 4) AS r2
           FROM comparison ORDER BY comparison.rmse, model_name LIMIT 1""",
    ),
    "model_names": _sql(_COMPARISON, "SELECT DISTINCT model_name FROM comparison"),
    "als_predict": _sql(
        [*_SILVER, "pairs", "folded"],
        """SELECT user_id, item_id, rating, true AS non_negative FROM folded
           WHERE fold >= 8 AND user_id IN (SELECT user_id FROM folded WHERE fold < 8)
             AND item_id IN (SELECT item_id FROM folded WHERE fold < 8)""",
    ),
    "als_wide_ids": _sql(
        [*_SILVER, "pairs", "folded"],
        """SELECT user_id * 8589934592 + 7 AS user_id, item_id - 1099511627776 AS item_id, rating, true AS non_negative
           FROM folded
           WHERE fold >= 8 AND user_id IN (SELECT user_id FROM folded WHERE fold < 8)
             AND item_id IN (SELECT item_id FROM folded WHERE fold < 8)""",
    ),
    "als_optimality": _sql(
        [*_SILVER, "pairs", "folded"],
        "SELECT user_id, count(*) AS ratings, true AS optimal FROM folded WHERE fold < 8 GROUP BY user_id",
    ),
    "ridge_fit": _sql(
        [*_BASE, "indexed", "slots"],
        """SELECT model_name, feature_name, true AS agrees
           FROM (SELECT feature_name FROM slots UNION ALL SELECT 'intercept'),
                (SELECT unnest(['Linear Regression', 'Generalized Linear Regression']) AS model_name)""",
    ),
    "tree_routes": _sql(
        _LABELLED,
        f"""SELECT user_id, item_id, model_name, true AS agrees
           FROM labelled, (SELECT unnest([{_TREES}]) AS model_name) WHERE fold >= 8""",
    ),
    "tree_leaf_means": _sql(_LABELLED, "SELECT user_id, item_id, true AS agrees FROM labelled WHERE fold < 8"),
    "tree_importances": _sql(
        [*_BASE, "indexed", "slots"],
        f"SELECT model_name, feature_name, true AS agrees FROM slots, (SELECT unnest([{_TREES}]) AS model_name)",
    ),
    "reg_linear": _sql(_LABELLED, _MEAN_KEEPER.format("Linear Regression")),
    "reg_tree": _sql(_LABELLED, _MEAN_KEEPER.format("Decision Tree Regressor")),
    "reg_forest": _sql(
        _LABELLED,
        """SELECT user_id, item_id, title, actual_rating, 'Random Forest Regressor' AS model_name,
                  true AS residual_agrees, true AS in_range FROM labelled WHERE fold >= 8""",
    ),
    "reg_gbt": _sql(_LABELLED, _MEAN_KEEPER.format("GBT Regressor")),
    "reg_glr": _sql(_LABELLED, _MEAN_KEEPER.format("Generalized Linear Regression")),
    "model_comparison": _sql(
        _LABELLED,
        f"""SELECT DISTINCT model_name, (SELECT count(*) FROM labelled WHERE fold >= 8) AS test_rows,
                   true AS rmse_agrees, true AS mae_agrees, true AS r2_agrees
            FROM (VALUES {_SETTINGS}) AS s(model_name, key, value)""",
    ),
    "feature_importance": _sql(
        [*_BASE, "indexed", "slots"],
        _SHARES.format(_TREES),
    ),
    "importance_for_model": _sql([*_BASE, "indexed", "slots"], _SHARES.format("'GBT Regressor'")),
    "best_predictions": _sql(
        _LABELLED,
        """SELECT user_id, item_id, title, actual_rating, true AS residual_agrees, true AS of_best
           FROM labelled WHERE fold >= 8
           ORDER BY md5(concat_ws('|', user_id, item_id, '42')), user_id, item_id LIMIT 5000""",
    ),
    "run_log": f"""
        WITH s AS (SELECT * FROM (VALUES {_SETTINGS}) AS s(run_name, key, setting))
        SELECT run_name, 'param' AS kind, key, setting, true AS agrees FROM s
        UNION ALL SELECT DISTINCT run_name, 'metric', unnest(['rmse', 'mae', 'r2']), '', true FROM s
        UNION ALL SELECT DISTINCT run_name, 'artifact', 'model', '', true FROM s""",
}

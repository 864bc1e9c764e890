"""The same results in plain DuckDB SQL: distinct counts, unions and joins as a
warehouse user would write them, without any of the rewrites of the Spark side."""

from __future__ import annotations

NOW = "TIMESTAMP '2024-01-24 00:00:00'"
TODAY = "DATE '2024-01-24'"
FIRST_LOAD = "TIMESTAMP '2024-01-20 00:00:00'"

PLANS_6 = "('bundle_all','bundle_3','news_only','games_only','cooking_only','athletic_only')"
PLANS_7 = "('bundle_all','bundle_3','news_only','games_only','cooking_only','athletic_only','wirecutter_only')"
TYPES = {
    "news": "('article_view','article_complete','share','save','comment')",
    "cooking": "('view','save','cook_mode_start','cook_mode_complete','rating_submit','share')",
    "athletic": "('article_view','liveblog_view','podcast_play','video_play','comment')",
}
GAMES = "('wordle','crossword','spelling_bee','connections','strands')"
PRODUCTS = ["news", "games", "cooking", "athletic"]
THRESHOLDS = {"news": 2, "games": 4, "cooking": 4, "athletic": 3}

CTES = {
    "raw_subscribers": """
SELECT CAST(c_custkey AS STRING) AS subscriber_id,
  CASE c_custkey % 3 WHEN 0 THEN 'gmail.com' WHEN 1 THEN 'icloud.com' ELSE 'edu' END AS email_domain,
  CASE WHEN c_custkey % 307 = 11 THEN NULL WHEN c_custkey % 211 = 5 THEN 'audio_only'
       WHEN c_custkey % 223 = 7 THEN 'wirecutter_only' WHEN c_custkey % 7 < 2 THEN 'bundle_all'
       WHEN c_custkey % 7 = 2 THEN 'bundle_3' WHEN c_custkey % 7 = 3 THEN 'news_only'
       WHEN c_custkey % 7 = 4 THEN 'games_only' WHEN c_custkey % 7 = 5 THEN 'cooking_only'
       ELSE 'athletic_only' END AS plan_type,
  CAST(CAST(DATE '2023-01-01' + (c_custkey * 37 % 380) * INTERVAL '1' DAY AS DATE) AS STRING) AS subscription_start_date,
  CASE WHEN c_custkey % 9 = 0 THEN CAST(CAST(DATE '2023-01-01' + (c_custkey * 37 % 380 + 7) * INTERVAL '1' DAY AS DATE) AS STRING) END AS subscription_end_date,
  c_custkey % 9 = 0 AS is_churned,
  lower(c_mktsegment) AS acquisition_channel,
  CASE c_nationkey % 5 WHEN 0 THEN 'US' WHEN 1 THEN 'GB' WHEN 2 THEN 'CA' WHEN 3 THEN 'AU' ELSE 'IN' END AS country,
  CASE c_custkey % 2 WHEN 0 THEN 'mobile' ELSE 'desktop' END AS device_primary,
  CASE WHEN c_custkey % 401 = 13 THEN 'not-a-date' WHEN dup = 0 THEN '2023-12-01T00:00:00' ELSE '2024-01-15T06:30:00' END AS created_at
FROM (SELECT *, 0 AS dup FROM customer UNION ALL SELECT *, 1 AS dup FROM customer WHERE c_custkey % 100 = 0) x""",
    "ev": """
SELECT *, ts + (CASE
    WHEN (product = 'cooking' AND EXTRACT(DAY FROM ts) % 10 <> 1)
      OR (product <> 'cooking' AND EXTRACT(DAY FROM ts) % 3 = 0)
      OR event_id % 3 = 0 THEN (event_id * 7919) % 12
    WHEN event_id % 3 = 1 THEN (event_id * 7919) % 270
    ELSE (event_id * 7919) % 900 END) * INTERVAL '1' MINUTE AS arrival_ts
FROM (SELECT event_id, ts, value, event_type AS et, user_id,
    CASE WHEN user_id % 10 = 3 THEN 'news'
         WHEN user_id % 10 = 4 THEN CASE WHEN event_id % 2 = 0 THEN 'news' ELSE 'games' END
         WHEN user_id % 10 = 6 THEN CASE WHEN event_id % 2 = 0 THEN 'news' ELSE 'athletic' END
         WHEN event_id % 4 = 0 THEN 'news' WHEN event_id % 4 = 1 THEN 'games'
         WHEN event_id % 4 = 2 THEN 'cooking' ELSE 'athletic' END AS product,
    CASE WHEN event_id % 50 = 0 THEN NULL WHEN event_id % 97 = 0 THEN 'ghost' ELSE CAST(CASE WHEN user_id % 5 = 0 AND ts >= TIMESTAMP '2024-01-08 00:00:00' THEN user_id + 1 ELSE user_id END AS STRING) END AS subscriber_id,
    CASE event_id % 3 WHEN 0 THEN 'web' WHEN 1 THEN 'ios' ELSE 'android' END AS platform,
    CASE WHEN event_id % 10 = 0 THEN NULL ELSE value * 10 END AS time_on_page_sec
  FROM events) b""",
    "events_news": """
SELECT event_id, subscriber_id,
  CASE et WHEN 'view' THEN 'article_view' WHEN 'click' THEN 'article_complete' WHEN 'signup' THEN 'save' WHEN 'purchase' THEN 'share' ELSE 'comment' END AS event_type,
  concat('art_', CAST(event_id % 9000 AS STRING)) AS article_id,
  CASE event_id % 7 WHEN 0 THEN 'politics' WHEN 1 THEN 'technology' WHEN 2 THEN 'arts' WHEN 3 THEN 'sports' WHEN 4 THEN 'science' WHEN 5 THEN 'opinion' ELSE 'world' END AS section,
  time_on_page_sec, ts AS event_timestamp, platform,
  CASE event_id % 5 WHEN 0 THEN 'direct' WHEN 1 THEN 'search' WHEN 2 THEN 'social' WHEN 3 THEN 'newsletter' ELSE 'push_notif' END AS referrer,
  arrival_ts
FROM ev WHERE product = 'news'""",
    "events_games": """
SELECT event_id, subscriber_id,
  CASE event_id % 5 WHEN 0 THEN 'wordle' WHEN 1 THEN 'crossword' WHEN 2 THEN 'spelling_bee' WHEN 3 THEN 'connections' ELSE 'strands' END AS game_name,
  CASE et WHEN 'click' THEN 'game_complete' WHEN 'purchase' THEN 'game_complete' WHEN 'view' THEN 'game_start' WHEN 'signup' THEN 'game_share' ELSE 'streak_milestone' END AS event_type,
  event_id % 101 AS score, event_id % 121 AS streak_days, value AS duration_sec,
  ts AS event_timestamp, platform, arrival_ts
FROM ev WHERE product = 'games'""",
    "events_cooking": """
SELECT event_id, subscriber_id, concat('rec_', CAST(event_id % 3000 AS STRING)) AS recipe_id,
  CASE event_id % 3 WHEN 0 THEN 'baking' WHEN 1 THEN 'desserts' ELSE 'drinks' END AS recipe_category,
  CASE et WHEN 'click' THEN 'cook_mode_start' WHEN 'purchase' THEN 'cook_mode_complete' WHEN 'view' THEN 'view' WHEN 'signup' THEN 'save' ELSE 'rating_submit' END AS event_type,
  CASE WHEN event_id % 10 < 3 THEN CAST(event_id % 5 + 1 AS DOUBLE) END AS rating,
  ts AS event_timestamp, platform, arrival_ts
FROM ev WHERE product = 'cooking'""",
    "events_athletic": """
SELECT event_id, subscriber_id,
  CASE event_id % 3 WHEN 0 THEN 'nfl' WHEN 1 THEN 'nba' ELSE 'soccer' END AS sport,
  concat('ath_', CAST(event_id % 7000 AS STRING)) AS article_id,
  CASE et WHEN 'click' THEN 'article_view' WHEN 'view' THEN 'article_view' WHEN 'signup' THEN 'liveblog_view' WHEN 'purchase' THEN 'podcast_play' ELSE 'video_play' END AS event_type,
  time_on_page_sec, ts AS event_timestamp, platform, arrival_ts
FROM ev WHERE product = 'athletic'""",
    "all_events": " UNION ALL ".join(
        f"SELECT '{p}' AS product, event_id, subscriber_id, event_type, event_timestamp, arrival_ts, platform "
        f"FROM events_{p}" for p in PRODUCTS),
    "stg_subscribers": f"""
SELECT subscriber_id, email_domain, plan_type,
  TRY_CAST(subscription_start_date AS DATE) AS subscription_start_date,
  TRY_CAST(subscription_end_date AS DATE) AS subscription_end_date,
  is_churned, acquisition_channel, country, device_primary,
  TRY_CAST(created_at AS TIMESTAMP) AS created_at,
  CASE WHEN plan_type IN ('bundle_all','bundle_3','news_only') THEN TRUE ELSE FALSE END AS has_news_access,
  CASE WHEN plan_type IN ('bundle_all','bundle_3','games_only') THEN TRUE ELSE FALSE END AS has_games_access,
  CASE WHEN plan_type IN ('bundle_all','bundle_3','cooking_only') THEN TRUE ELSE FALSE END AS has_cooking_access,
  CASE WHEN plan_type IN ('bundle_all','athletic_only') THEN TRUE ELSE FALSE END AS has_athletic_access,
  CASE WHEN plan_type = 'bundle_all' THEN TRUE ELSE FALSE END AS has_wirecutter_access,
  CASE WHEN plan_type = 'bundle_all' THEN 'full_bundle' WHEN plan_type = 'bundle_3' THEN 'partial_bundle'
       ELSE 'single_product' END AS bundle_tier,
  CAST(date_diff('day', TRY_CAST(subscription_start_date AS DATE),
       COALESCE(TRY_CAST(subscription_end_date AS DATE), {TODAY})) AS INTEGER) AS tenure_days
FROM (SELECT *, row_number() OVER (PARTITION BY subscriber_id ORDER BY created_at ASC NULLS FIRST) AS rn
      FROM raw_subscribers) d WHERE rn = 1""",
}


def with_ctes(body: str, extra: dict[str, str] | None = None) -> str:
    parts = ",\n".join(f"{name} AS ({text})" for name, text in {**CTES, **(extra or {})}.items())
    return f"WITH {parts}\n{body}"


def staged(product: str, where: str = "subscriber_id IS NOT NULL") -> str:
    own = {
        "news": "article_id, section, referrer,", "games": "game_name, score, streak_days, duration_sec,",
        "cooking": "recipe_id, recipe_category, rating,", "athletic": "sport, article_id,",
    }[product]
    dwell = ("CASE WHEN time_on_page_sec IS NOT NULL THEN LEAST(time_on_page_sec, 1800.0::DOUBLE) END "
             "AS time_on_page_sec, time_on_page_sec IS NULL AS is_missing_dwell_time,"
             if product in ("news", "athletic") else "")
    return f"""SELECT event_id, subscriber_id, event_type, {own} {dwell}
  event_timestamp, CASE WHEN event_timestamp > {NOW} THEN {NOW} ELSE event_timestamp END AS event_timestamp_clean,
  CAST(event_timestamp AS DATE) AS event_date, platform,
  subscriber_id IS NULL AS is_orphaned_event, event_timestamp > {NOW} AS has_future_timestamp
FROM events_{product} WHERE {where}"""


def qualifying(lookback: int = 90, where: str = "TRUE") -> str:
    rule = {
        "news": ("event_type = 'article_complete' AND subscriber_id IS NOT NULL", "article_complete"),
        "games": ("event_type = 'game_complete'", "game_complete"),
        "cooking": ("event_type = 'cook_mode_start'", "cook_mode_start"),
        "athletic": ("event_type = 'article_view' AND time_on_page_sec > 60", "article_view_60s"),
    }
    return " UNION ALL ".join(
        f"""SELECT CAST(event_timestamp AS DATE) AS event_date, subscriber_id, '{p}' AS product, platform,
  '{label}' AS qualifying_event FROM events_{p}
WHERE {test} AND CAST(event_timestamp AS DATE) >= {TODAY} - {lookback} AND ({where.replace('{p}', p)})"""
        for p, (test, label) in rule.items())


def daily_active(active: str = "active", updated: str = NOW) -> str:
    counts = """COUNT(DISTINCT a.subscriber_id) AS daily_active_subscribers,
  COUNT(DISTINCT CASE WHEN s.bundle_tier = 'full_bundle' THEN a.subscriber_id END) AS daily_active_full_bundle,
  COUNT(DISTINCT CASE WHEN s.bundle_tier = 'partial_bundle' THEN a.subscriber_id END) AS daily_active_partial_bundle,
  COUNT(DISTINCT CASE WHEN s.bundle_tier = 'single_product' THEN a.subscriber_id END) AS daily_active_single_product"""
    stamp = f"{updated} AS _model_updated_at, '2024.Q1' AS _metric_version"
    return f"""SELECT *, {stamp} FROM (
SELECT a.event_date, a.product, a.platform, s.bundle_tier, s.country, {counts}
FROM {active} a LEFT JOIN stg_subscribers s ON a.subscriber_id = s.subscriber_id GROUP BY 1,2,3,4,5
UNION ALL
SELECT a.event_date, 'ALL_PRODUCTS', NULL, NULL, NULL, {counts}
FROM {active} a LEFT JOIN stg_subscribers s ON a.subscriber_id = s.subscriber_id GROUP BY 1)"""


def engagement(product: str, lookback: int = 90) -> str:
    days = f"COUNT(DISTINCT event_date) AS {product}_active_days"
    last = f"MAX(event_date) AS {product}_last_active_date"
    own = {
        "news": """COUNT(CASE WHEN event_type = 'article_view' THEN 1 END) AS news_article_views,
  COUNT(CASE WHEN event_type = 'article_complete' THEN 1 END) AS news_articles_completed,
  round(COUNT(CASE WHEN event_type = 'article_complete' THEN 1 END)::DOUBLE
    / NULLIF(COUNT(CASE WHEN event_type = 'article_view' THEN 1 END), 0), 6) AS news_completion_rate,
  round(AVG(time_on_page_sec), 6) AS news_avg_dwell_sec""",
        "games": """COUNT(CASE WHEN event_type = 'game_complete' THEN 1 END) AS games_completed,
  COUNT(DISTINCT game_name) AS games_distinct_played, MAX(streak_days) AS games_max_streak""",
        "cooking": """COUNT(CASE WHEN event_type = 'cook_mode_complete' THEN 1 END) AS recipes_cooked,
  COUNT(CASE WHEN event_type = 'save' THEN 1 END) AS recipes_saved""",
        "athletic": "COUNT(CASE WHEN event_type = 'article_view' THEN 1 END) AS athletic_article_views",
    }[product]
    source = (f"({staged('news')})" if product == "news"
              else f"(SELECT *, CAST(event_timestamp AS DATE) AS event_date FROM events_{product})")
    return f"""SELECT subscriber_id, {days}, {own}, {last} FROM {source} e
WHERE event_date >= {TODAY} - {lookback} GROUP BY subscriber_id"""


def subscriber_health(lookback: int = 90, today: str = TODAY) -> str:
    idle = ", ".join(
        f"date_diff('day', COALESCE({a}.{p}_last_active_date, DATE '1970-01-01'), {today})"
        for a, p in zip("ngca", PRODUCTS))
    breadth = " + ".join(
        f"CASE WHEN COALESCE({a}.{p}_active_days, 0) > 0 THEN 1 ELSE 0 END" for a, p in zip("ngca", PRODUCTS))
    return f"""SELECT *,
  CASE WHEN days_since_last_activity >= 30 AND bundle_tier = 'single_product' THEN 'high'
       WHEN days_since_last_activity >= 30 AND bundle_tier = 'partial_bundle' THEN 'high'
       WHEN days_since_last_activity BETWEEN 14 AND 29 THEN 'medium'
       WHEN products_engaged_count = 1 AND bundle_tier IN ('full_bundle','partial_bundle') THEN 'medium'
       ELSE 'low' END AS churn_risk_tier,
  CASE bundle_tier WHEN 'full_bundle' THEN 20.0::DOUBLE WHEN 'partial_bundle' THEN 14.0::DOUBLE
       ELSE 5.0::DOUBLE END AS mrr_estimate_usd
FROM (SELECT s.*,
  COALESCE(n.news_active_days, 0) AS news_active_days, COALESCE(n.news_article_views, 0) AS news_article_views,
  COALESCE(n.news_articles_completed, 0) AS news_articles_completed,
  COALESCE(n.news_completion_rate, 0) AS news_completion_rate, n.news_avg_dwell_sec, n.news_last_active_date,
  COALESCE(g.games_active_days, 0) AS games_active_days, COALESCE(g.games_completed, 0) AS games_completed,
  COALESCE(g.games_distinct_played, 0) AS games_distinct_played, COALESCE(g.games_max_streak, 0) AS games_max_streak,
  g.games_last_active_date,
  COALESCE(c.cooking_active_days, 0) AS cooking_active_days, COALESCE(c.recipes_cooked, 0) AS recipes_cooked,
  COALESCE(c.recipes_saved, 0) AS recipes_saved, c.cooking_last_active_date,
  COALESCE(a.athletic_active_days, 0) AS athletic_active_days,
  COALESCE(a.athletic_article_views, 0) AS athletic_article_views, a.athletic_last_active_date,
  CAST({breadth} AS INTEGER) AS products_engaged_count,
  CAST(LEAST({idle}) AS INTEGER) AS days_since_last_activity
FROM stg_subscribers s
LEFT JOIN ({engagement('news', lookback)}) n USING (subscriber_id)
LEFT JOIN ({engagement('games', lookback)}) g USING (subscriber_id)
LEFT JOIN ({engagement('cooking', lookback)}) c USING (subscriber_id)
LEFT JOIN ({engagement('athletic', lookback)}) a USING (subscriber_id))"""


# --- quality -----------------------------------------------------------------

def label(score: str) -> str:
    return f"CASE WHEN {score} >= 0.95 THEN 'PASS' WHEN {score} >= 0.85 THEN 'WARN' ELSE 'FAIL' END"


def joined(texts: list[str]) -> str:
    return "concat_ws(' ', " + ", ".join(texts or ["NULL"]) + ")"


def check_row(dataset: str, dimension: str, score: str, issues: list[str], source: str) -> str:
    return (f"SELECT '{dataset}' AS dataset, '{dimension}' AS dimension, round(s, 6) AS score, {label('s')} AS label, "
            f"i AS issues FROM (SELECT {score} AS s, {joined(issues)} AS i FROM {source})")


def when(cond: str, text: str) -> str:
    return f"CASE WHEN {cond} THEN {text} END"


def missing(col: str) -> str:
    return when(f"{nulls(col)}::DOUBLE / COUNT(*) > 0.01",
                f"'Column ''{col}'': ' || {nulls(col)} || ' of ' || COUNT(*) || ' values are missing.'")


def absent(col: str) -> str:
    return f"'Column ''{col}'' is absent.'"


def repeated(col: str) -> str:
    n = f"(COUNT(*) - COUNT(DISTINCT {col}))"
    return when(f"{n} > 0", f"'Key ''{col}'': ' || {n} || ' rows repeat a value or have none.'")


def untimely(ts: str, now: str) -> list[str]:
    future = f"COUNT(*) FILTER (WHERE {ts} > {now})"
    return [when(f"{future} > 0", f"{future} || ' timestamps lie in the future.'"),
            when(f"{nulls(ts)} > 0", f"{nulls(ts)} || ' timestamps cannot be read.'")]


def unlinked(fk: str, ref: str, ref_col: str) -> list[str]:
    orphans = f"COUNT(*) FILTER (WHERE {fk} IS NOT NULL AND {fk} NOT IN (SELECT {ref_col} FROM {ref}))"
    return [when(f"{orphans} > 0", f"{orphans} || ' rows refer to an unknown ''{fk}''.'"),
            when(f"{nulls(fk)} > 0", f"{nulls(fk)} || ' rows have no ''{fk}''.'")]


def not_allowed(col: str, allowed: str, table: str) -> str:
    n = f"COUNT(*) FILTER (WHERE {col} NOT IN {allowed})"
    worst = (f"(SELECT string_agg('''' || v || ''': ' || n, ', ' ORDER BY n DESC, v) FROM (SELECT {col} AS v, "
             f"COUNT(*) AS n FROM {table} WHERE {col} NOT IN {allowed} GROUP BY 1 ORDER BY n DESC, v LIMIT 5))")
    return when(f"{n} > 0",
                f"'Column ''{col}'': ' || {n} || ' values are not allowed, most often {{' || {worst} || '}}.'")


def nulls(col: str) -> str:
    return f"COUNT(*) FILTER (WHERE {col} IS NULL)"


def share(col: str) -> str:
    return f"(1.0::DOUBLE - {nulls(col)}::DOUBLE / COUNT(*))"


def flag(cond: str) -> str:
    return f"(CASE WHEN {cond} THEN 1 ELSE 0 END)"


PROFILES = {
    "subscribers": ("subscriber_domain", "raw_subscribers",
                    ["subscriber_id", "plan_type", "subscription_start_date", "is_churned"], "subscriber_id",
                    "TRY_CAST(created_at AS TIMESTAMP)", False, "plan_type", PLANS_7),
    "events_news": ("news_domain", "events_news", ["event_id", "event_type", "event_timestamp"], "event_id",
                    "event_timestamp", True, "event_type", TYPES["news"]),
    "events_games": ("games_domain", "events_games", ["event_id", "game_name", "event_timestamp"], "event_id",
                     "event_timestamp", True, "game_name", GAMES),
    "events_cooking": ("cooking_domain", "events_cooking", ["event_id", "recipe_id", "event_timestamp"], "event_id",
                       "event_timestamp", True, "event_type", TYPES["cooking"]),
    "events_athletic": ("athletic_domain", "events_athletic", ["event_id", "sport", "event_timestamp"], "event_id",
                        "event_timestamp", True, "event_type", TYPES["athletic"]),
}


def _dq_counts() -> str:
    parts = []
    for name, (domain, table, keys, pk, ts, has_fk, valid, allowed) in PROFILES.items():
        completeness = "(" + " + ".join(share(k) for k in keys) + f") / {len(keys)}.0::DOUBLE"
        orphans = "COUNT(*) FILTER (WHERE subscriber_id IS NOT NULL AND subscriber_id NOT IN (SELECT subscriber_id FROM raw_subscribers))"
        no_fk = nulls("subscriber_id")
        referential = f"1.0::DOUBLE - ({orphans} + {no_fk})::DOUBLE / COUNT(*)" if has_fk else "1.0::DOUBLE"
        future, unparsed = f"COUNT(*) FILTER (WHERE {ts} > {NOW})", nulls(ts)
        invalid = f"COUNT(*) FILTER (WHERE {valid} IS NOT NULL AND {valid} NOT IN {allowed})"
        parts.append(f"""SELECT '{name}' AS dataset_name, '{domain}' AS domain, COUNT(*) AS total_records,
  {completeness} AS completeness, {joined([missing(k) for k in keys])} AS completeness_i,
  COUNT(DISTINCT {pk})::DOUBLE / COUNT(*) AS uniqueness, {joined([repeated(pk)])} AS uniqueness_i,
  1.0::DOUBLE - ({future} + {unparsed})::DOUBLE / COUNT(*) AS timeliness, {joined(untimely(ts, NOW))} AS timeliness_i,
  {referential} AS referential,
  {joined(unlinked('subscriber_id', 'raw_subscribers', 'subscriber_id') if has_fk else [])} AS referential_i,
  1.0::DOUBLE - {invalid}::DOUBLE / COUNT(*) AS validity, {joined([not_allowed(valid, allowed, table)])} AS validity_i
FROM {table}""")
    return " UNION ALL ".join(parts)


DIMS = ["completeness", "uniqueness", "timeliness", "referential", "validity"]
COMPOSITE = ("round(completeness * 0.30::DOUBLE + uniqueness * 0.20::DOUBLE + timeliness * 0.15::DOUBLE "
             "+ referential * 0.20::DOUBLE + validity * 0.15::DOUBLE, 4)")
DQ = {
    "dq_counts": _dq_counts(),
    "dq_scored": f"SELECT *, {COMPOSITE} AS composite FROM dq_counts",
    "dq_rows": f"""SELECT dataset_name, domain, {NOW} AS run_at, total_records,
  round(composite * 100, 2) AS composite_score, {label('composite')} AS status,
  {', '.join(f"round({d} * 100, 2) AS {d}_score, {label(d)} AS {d}_label, {d}_i AS {d}_issues" for d in DIMS)}
FROM dq_scored""",
}


def scorecard() -> str:
    def part(name, domain, table, keys, unique, on_time, valid, linked):
        ratios = ", ".join(f"COUNT(*) FILTER (WHERE {k} IS NOT NULL)::DOUBLE / NULLIF(COUNT(*), 0) AS {alias}"
                           for k, alias in zip(keys, ("completeness_subscriber_id", "completeness_plan_type",
                                                      "completeness_start_date")))
        return f"""SELECT '{name}' AS dataset_name, '{domain}' AS data_domain, {TODAY} AS run_date,
  COUNT(*) AS total_records, {ratios}, COUNT(DISTINCT {unique})::DOUBLE / NULLIF(COUNT(*), 0) AS uniqueness_score,
  COUNT(*) FILTER (WHERE {on_time})::DOUBLE / NULLIF(COUNT(*), 0) AS timeliness_score,
  COUNT(*) FILTER (WHERE {valid})::DOUBLE / NULLIF(COUNT(*), 0) AS validity_score,
  {linked} AS referential_integrity_score FROM {table}"""

    both = part("subscribers", "subscriber_domain", "raw_subscribers",
                ["subscriber_id", "plan_type", "subscription_start_date"], "subscriber_id",
                f"CAST(subscription_start_date AS DATE) <= {TODAY}", f"plan_type IN {PLANS_6}", "1.0::DOUBLE")
    both += " UNION ALL " + part(
        "events_news", "news_domain", "events_news", ["event_id", "event_type", "event_timestamp"], "event_id",
        f"event_timestamp <= {NOW}", f"event_type IN {TYPES['news']}",
        "(SELECT COUNT(*) FROM events_news n JOIN (SELECT DISTINCT subscriber_id FROM stg_subscribers) s "
        "ON n.subscriber_id = s.subscriber_id)::DOUBLE / NULLIF(COUNT(*), 0)")
    weights = [("completeness_subscriber_id", "0.10"), ("completeness_plan_type", "0.10"),
               ("completeness_start_date", "0.10"), ("uniqueness_score", "0.20"), ("timeliness_score", "0.15"),
               ("referential_integrity_score", "0.20"), ("validity_score", "0.15")]
    total = "(" + " + ".join(f"{c} * {w}::DOUBLE" for c, w in weights) + ")"
    return f"""SELECT dataset_name, data_domain, run_date, total_records,
  {', '.join(f'round({c}, 6) AS {c}' for c, _ in weights)},
  round({total} * 100, 2) AS dq_score, {label(total)} AS dq_status FROM ({both})"""


# --- lateness ----------------------------------------------------------------

LATE_AFTER = "CASE domain " + " ".join(f"WHEN 'events_{p}' THEN {h}" for p, h in THRESHOLDS.items()) + " ELSE 2 END"
LATE = {
    "lagged": f"""SELECT *, lag_hours > {LATE_AFTER} AS is_late,
  CASE WHEN lag_hours > 0 AND lag_hours <= 0.5 THEN '<30min' WHEN lag_hours > 0.5 AND lag_hours <= 2 THEN '30min-2h'
       WHEN lag_hours > 2 AND lag_hours <= 6 THEN '2-6h' WHEN lag_hours > 6 AND lag_hours <= 12 THEN '6-12h'
       WHEN lag_hours > 12 THEN '>12h' END AS lag_bucket
FROM (SELECT event_id, concat('events_', product) AS domain, platform, CAST(event_timestamp AS DATE) AS event_date,
  (epoch_us(arrival_ts) - epoch_us(event_timestamp))::DOUBLE / 3600000000.0::DOUBLE AS lag_hours FROM all_events)""",
    "days": """SELECT domain, event_date, COUNT(event_id) AS total_events, COUNT(*) FILTER (WHERE is_late) AS late_events,
  round(COUNT(*) FILTER (WHERE is_late)::DOUBLE / COUNT(event_id) * 100.0::DOUBLE, 2) AS late_pct
FROM lagged GROUP BY domain, event_date""",
    "domains": """SELECT domain, COUNT(*) AS total_events, COUNT(*) FILTER (WHERE is_late) AS late_events,
  round(COUNT(*) FILTER (WHERE is_late)::DOUBLE / COUNT(*) * 100.0::DOUBLE, 2) AS late_pct
FROM lagged GROUP BY domain""",
    "manifest": """SELECT d.domain, d.event_date, d.late_pct, CASE WHEN t.late_pct > 10 THEN 'high' ELSE 'normal' END AS priority
FROM days d JOIN domains t ON d.domain = t.domain WHERE d.late_pct > 5.0""",
}
HALF_A_DAY = {name: text.replace(LATE_AFTER, "12") for name, text in LATE.items()}
LABELS = ["<30min", "30min-2h", "2-6h", "6-12h", ">12h"]


def late(body: str) -> str:
    return with_ctes(body, LATE)


# --- drift -------------------------------------------------------------------

# fixed values: dataset, column, type, breaking
REGISTRY_ROWS = [
    ("subscribers", "subscriber_id", "string", True),
    ("subscribers", "email_domain", "string", False),
    ("subscribers", "plan_type", "string", True),
    ("subscribers", "subscription_start_date", "string", True),
    ("subscribers", "subscription_end_date", "string", False),
    ("subscribers", "is_churned", "boolean", True),
    ("subscribers", "acquisition_channel", "string", False),
    ("subscribers", "country", "string", False),
    ("subscribers", "device_primary", "string", False),
    ("subscribers", "created_at", "string", False),
    ("events_games", "event_id", "string", True),
    ("events_games", "subscriber_id", "string", False),
    ("events_games", "game_name", "string", True),
    ("events_games", "event_type", "string", True),
    ("events_games", "score", "bigint", False),
    ("events_games", "streak_days", "bigint", False),
    ("events_games", "duration_sec", "double", False),
    ("events_games", "event_timestamp", "string", True),
    ("events_games", "platform", "string", False),
    ("events_news", "event_id", "string", True),
    ("events_news", "subscriber_id", "string", False),
    ("events_news", "event_type", "string", True),
    ("events_news", "article_id", "string", True),
    ("events_news", "section", "string", False),
    ("events_news", "time_on_page_sec", "double", False),
    ("events_news", "event_timestamp", "string", True),
    ("events_news", "platform", "string", False),
    ("events_news", "referrer", "string", False),
    ("events_cooking", "event_id", "string", True),
    ("events_cooking", "subscriber_id", "string", False),
    ("events_cooking", "recipe_id", "string", True),
    ("events_cooking", "recipe_category", "string", False),
    ("events_cooking", "event_type", "string", True),
    ("events_cooking", "rating", "double", False),
    ("events_cooking", "event_timestamp", "string", True),
    ("events_cooking", "platform", "string", False),
    ("events_athletic", "event_id", "string", True),
    ("events_athletic", "subscriber_id", "string", False),
    ("events_athletic", "sport", "string", True),
    ("events_athletic", "article_id", "string", True),
    ("events_athletic", "event_type", "string", True),
    ("events_athletic", "time_on_page_sec", "double", False),
    ("events_athletic", "event_timestamp", "string", True),
    ("events_athletic", "platform", "string", False),
]


SPARK_TYPES = ("CASE column_type WHEN 'VARCHAR' THEN 'string' WHEN 'TIMESTAMP' THEN 'timestamp_ntz' "
               "WHEN 'INTEGER' THEN 'int' ELSE lower(column_type) END")


def described(dataset: str, query: str) -> str:
    """(dataset, column_name, actual) of a query's own columns."""
    return (f"SELECT '{dataset}' AS dataset, column_name, {SPARK_TYPES} AS actual FROM (DESCRIBE {query})")


def live_rows(drifted: bool) -> str:
    changed = {
        "events_games": "SELECT * RENAME (game_name AS game_title) FROM events_games",
        "events_athletic": "SELECT * REPLACE (CAST(time_on_page_sec AS BIGINT) AS time_on_page_sec) FROM events_athletic",
        "events_news": "SELECT *, 50.0::DOUBLE AS scroll_depth_pct FROM events_news",
    } if drifted else {}
    tables = {"subscribers": "SELECT * FROM raw_subscribers"} | {
        f"events_{p}": changed.get(f"events_{p}", f"SELECT * FROM events_{p}") for p in PRODUCTS}
    return " UNION ALL ".join(described(name, with_ctes(query)) for name, query in tables.items())


def drift_ctes(drifted: bool = True) -> dict[str, str]:
    registry = "SELECT * FROM (VALUES " + ", ".join(
        f"('{t}','{c}','{d}',{b})" for t, c, d, b in REGISTRY_ROWS) + ") v(dataset, column_name, expected, breaking)"
    return {
        "registry": registry,
        "live": live_rows(drifted),
        "column_events": """SELECT r.dataset, r.column_name, 'MISSING_COLUMN' AS drift_type,
  CASE WHEN r.breaking THEN 'BREAKING' ELSE 'WARNING' END AS severity, r.expected, CAST(NULL AS VARCHAR) AS actual,
  'Column ''' || r.column_name || ''' is no longer delivered; it may have been renamed.' AS detail
FROM registry r WHERE NOT EXISTS (SELECT 1 FROM live l WHERE l.dataset = r.dataset AND l.column_name = r.column_name)
UNION ALL
SELECT r.dataset, r.column_name, 'TYPE_CHANGE', CASE WHEN (r.expected = 'bigint' AND l.actual = 'double')
  OR (r.expected = 'double' AND l.actual = 'float') THEN 'WARNING' ELSE 'BREAKING' END, r.expected, l.actual,
  'Type of ''' || r.column_name || ''' changed from ' || r.expected || ' to ' || l.actual || '.'
FROM registry r JOIN live l ON l.dataset = r.dataset AND l.column_name = r.column_name WHERE r.expected <> l.actual
UNION ALL
SELECT l.dataset, l.column_name, 'NEW_COLUMN', 'WARNING', NULL, l.actual,
  'Column ''' || l.column_name || ''' is not in the registry; review and register it.'
FROM live l WHERE NOT EXISTS (SELECT 1 FROM registry r WHERE l.dataset = r.dataset AND l.column_name = r.column_name)""",
        "enum_values": f"""SELECT 'subscribers' AS dataset, 'plan_type' AS column_name, 'BREAKING' AS severity,
  plan_type AS value, COUNT(*) AS n FROM raw_subscribers WHERE plan_type NOT IN {PLANS_6} GROUP BY plan_type
UNION ALL SELECT 'events_games', 'game_name', 'WARNING', game_name, COUNT(*) FROM events_games
WHERE game_name NOT IN {GAMES} GROUP BY game_name""",
        "drift_rows": """SELECT * FROM column_events UNION ALL
SELECT dataset, column_name, 'ENUM_VIOLATION', severity, CAST(NULL AS VARCHAR), CAST(NULL AS VARCHAR),
  'Unknown values of ''' || column_name || ''': ' || COUNT(*) || ', in ' || CAST(SUM(n) AS BIGINT)
  || ' rows; the table of unknown values has them all.'
FROM enum_values WHERE dataset = 'subscribers' GROUP BY dataset, column_name, severity""",
        "statuses": """SELECT d.dataset, CASE WHEN bool_or(e.severity = 'BREAKING') THEN 'BREAKING'
  WHEN bool_or(e.severity = 'WARNING') THEN 'WARNING' WHEN COUNT(e.severity) > 0 THEN 'INFO' ELSE 'CLEAN' END AS status,
  COUNT(e.severity) AS events
FROM (SELECT DISTINCT dataset FROM registry) d LEFT JOIN drift_rows e ON d.dataset = e.dataset GROUP BY d.dataset""",
    }


DRIFTED = drift_ctes()


# --- all queries -------------------------------------------------------------

O: dict[str, str] = {}

O["csv_scan"] = with_ctes("SELECT * FROM raw_subscribers")
O["parquet_scan"] = ("SELECT o_orderkey, o_custkey, o_totalprice, 'orders' AS source FROM orders "
                     "WHERE o_orderstatus = 'F'")
O["source_registry"] = with_ctes(" UNION ALL ".join(
    f"SELECT 'raw_{n}' AS source, COUNT(*) AS row_count FROM {t}"
    for n, t in [("subscribers", "raw_subscribers")] + [(f"events_{p}", f"events_{p}") for p in PRODUCTS]))
O["source_variants"] = with_ctes(f"""
SELECT 'subscribers' AS dataset, 'clean' AS variant, COUNT(DISTINCT subscriber_id) AS row_count FROM raw_subscribers
UNION ALL SELECT 'subscribers', 'dirty', COUNT(*) FROM raw_subscribers
UNION ALL SELECT 'events_news', 'clean', COUNT(subscriber_id) FROM events_news
UNION ALL SELECT 'events_news', 'dirty', COUNT(*) FROM events_news
UNION ALL SELECT 'events_games', 'clean', COUNT(*) FROM events_games WHERE event_timestamp <= {NOW}
UNION ALL SELECT 'events_games', 'dirty', COUNT(*) FROM events_games
UNION ALL SELECT 'events_cooking', v, COUNT(*) FROM events_cooking, (VALUES ('clean'), ('dirty')) x(v) GROUP BY v
UNION ALL SELECT 'events_athletic', v, COUNT(*) FROM events_athletic, (VALUES ('clean'), ('dirty')) x(v) GROUP BY v""")
O["full_refresh_load"] = with_ctes(" UNION ALL ".join(
    f"SELECT 'raw_{n}' AS table_name, 'loaded' AS status, COUNT(*) AS rows FROM {t}"
    for n, t in [("subscribers", "raw_subscribers")] + [(f"events_{p}", f"events_{p}") for p in PRODUCTS])
    + " UNION ALL SELECT 'raw_absent', 'skipped', 0")
O["view_materialization"] = with_ctes(
    "SELECT bundle_tier, country, COUNT(*) AS subscribers FROM stg_subscribers GROUP BY 1, 2")
O["asset_metadata"] = with_ctes("""
SELECT 'raw_subscribers' AS asset, COUNT(*) AS row_count, MAX(TRY_CAST(created_at AS TIMESTAMP)) AS freshest FROM raw_subscribers
""" + "".join(f"UNION ALL SELECT 'raw_events_{p}', COUNT(*), MAX(event_timestamp) FROM events_{p} " for p in PRODUCTS)
    + "UNION ALL SELECT 'orders', COUNT(*), MAX(o_orderdate) FROM orders "
      "UNION ALL SELECT 'region', COUNT(*), NULL FROM region")

O["stored_metadata"] = with_ctes(f"""
SELECT 'orders' AS asset, COUNT(*) AS row_count, MAX(o_orderdate) AS freshest, true AS is_known FROM orders
UNION ALL SELECT 'events', COUNT(*), MAX(ts), true FROM events UNION ALL SELECT 'region', COUNT(*), NULL, false FROM region
UNION ALL SELECT 'stg_events_news', COUNT(*), MAX(event_timestamp_clean), true FROM ({staged('news')})""")
O["stg_subscribers"] = with_ctes("SELECT * FROM stg_subscribers")
for _p in PRODUCTS:
    O[f"stg_events_{_p}"] = with_ctes(staged(_p))
O["quarantine_events"] = with_ctes(" UNION ALL ".join(
    f"SELECT '{p}' AS product, event_id, event_type, event_timestamp, event_timestamp_clean, event_date, platform, "
    f"has_future_timestamp FROM ({staged(p, 'subscriber_id IS NULL')})" for p in PRODUCTS))
O["first_order_per_customer"] = """SELECT o_orderkey, o_custkey, o_orderstatus, o_totalprice, o_orderdate, o_orderpriority
FROM (SELECT *, row_number() OVER (PARTITION BY o_custkey ORDER BY o_orderdate, o_orderkey) AS rn FROM orders)
WHERE rn = 1"""

ACTIVE = {"active": qualifying()}
O["qualifying_activity"] = with_ctes("SELECT * FROM active", ACTIVE)
O["enriched_activity"] = with_ctes(
    "SELECT a.*, s.plan_type, s.bundle_tier, s.country, s.acquisition_channel FROM active a "
    "LEFT JOIN stg_subscribers s ON a.subscriber_id = s.subscriber_id", ACTIVE)
O["daily_active"] = with_ctes(daily_active(), ACTIVE)
O["daily_active_14_days"] = with_ctes(daily_active(), {"active": qualifying(14)})
O["daily_active_grouping_sets"] = O["daily_active"]
O["daily_active_latest_first"] = O["daily_active"]
_first = qualifying(where=f"arrival_ts < {FIRST_LOAD}").replace(f"{TODAY} - 90", "DATE '2024-01-20' - 90")
O["daily_active_incremental"] = with_ctes(
    f"""SELECT * FROM ({daily_active('first_active', FIRST_LOAD)}) f WHERE event_date < (SELECT MAX(event_date) FROM first_active)
UNION ALL
SELECT * FROM ({daily_active('then_active', NOW)}) t WHERE event_date >= (SELECT MAX(event_date) FROM first_active)""",
    {"first_active": _first, "then_active": qualifying(where=f"arrival_ts < {NOW}")})
_on_time = ("(epoch_us(arrival_ts) - epoch_us(event_timestamp))::DOUBLE / 3600000000.0::DOUBLE <= "
            "CASE '{p}' WHEN 'news' THEN 2 WHEN 'games' THEN 4 WHEN 'cooking' THEN 4 ELSE 3 END")
O["reprocess_partitions"] = with_ctes(
    f"""SELECT * FROM ({daily_active('punctual', FIRST_LOAD)}) f
WHERE event_date NOT IN (SELECT event_date FROM manifest)
UNION ALL
SELECT * FROM ({daily_active('active', NOW)}) t WHERE event_date IN (SELECT event_date FROM manifest)""",
    {**LATE, "punctual": qualifying(where=_on_time).replace(f"{TODAY} - 90", "DATE '2024-01-20' - 90"), **ACTIVE})

for _p in PRODUCTS:
    O[f"engagement_{_p}"] = with_ctes(engagement(_p))
O["subscriber_health"] = with_ctes(subscriber_health())
O["subscriber_health_14_days"] = with_ctes(subscriber_health(14))
O["churn_risk_summary"] = with_ctes(
    "SELECT bundle_tier, churn_risk_tier, COUNT(*) AS subscribers, SUM(mrr_estimate_usd) AS mrr_usd "
    f"FROM ({subscriber_health()}) GROUP BY 1, 2")
O["health_snapshots"] = with_ctes(" UNION ALL ".join(
    f"SELECT {day} AS snapshot_date, churn_risk_tier, COUNT(*) AS subscribers, "
    f"CAST(SUM(products_engaged_count) AS BIGINT) AS products_engaged "
    f"FROM ({subscriber_health(today=day).replace(f'{TODAY} - 90', f'{day} - 90')}) GROUP BY 2"
    for day in ("DATE '2024-01-20'", TODAY)))
O["engagement_velocity"] = with_ctes(f"""
SELECT subscriber_id, COUNT(*) FILTER (WHERE CAST(event_timestamp AS DATE) >= {TODAY} - 7) AS events_short,
  COUNT(*) AS events_long,
  round((COUNT(*) FILTER (WHERE CAST(event_timestamp AS DATE) >= {TODAY} - 7) / 7.0::DOUBLE) / (COUNT(*) / 30.0::DOUBLE), 6) AS velocity
FROM all_events WHERE CAST(event_timestamp AS DATE) >= {TODAY} - 30 AND event_timestamp <= {NOW}
  AND subscriber_id IS NOT NULL GROUP BY subscriber_id""")

O["dq_completeness"] = with_ctes(" UNION ALL ".join([
    check_row("subscribers", "completeness",
              "(" + " + ".join(share(k) for k in PROFILES["subscribers"][2]) + ") / 4.0::DOUBLE",
              [missing(k) for k in PROFILES["subscribers"][2]], "raw_subscribers"),
    check_row("events_news", "completeness", f"({share('event_id')} + {share('subscriber_id')}) / 3.0::DOUBLE",
              [missing("event_id"), missing("subscriber_id"), absent("gone")], "events_news"),
    check_row("orders", "completeness", f"({share('o_orderkey')} + {share('o_orderdate')}) / 2.0::DOUBLE",
              [missing("o_orderkey"), missing("o_orderdate")], "orders"),
]))
O["dq_uniqueness"] = with_ctes(" UNION ALL ".join(
    check_row(d, "uniqueness", f"COUNT(DISTINCT {c})::DOUBLE / COUNT(*)", [repeated(c)], t)
    for d, c, t in [("subscribers", "subscriber_id", "raw_subscribers"), ("events_news", "subscriber_id", "events_news"),
                    ("lineitem", "l_orderkey", "lineitem")]))
O["dq_timeliness"] = with_ctes(" UNION ALL ".join(
    check_row(d, "timeliness", f"1.0::DOUBLE - COUNT(*) FILTER (WHERE {c} > {now} OR {c} IS NULL)::DOUBLE / COUNT(*)",
              untimely(c, now), t)
    for d, c, t, now in [
        ("subscribers", "TRY_CAST(created_at AS TIMESTAMP)", "raw_subscribers", NOW),
        ("events_games", "event_timestamp", "events_games", NOW),
        ("orders", "o_orderdate", "orders", "TIMESTAMP '1998-01-01 00:00:00'")]))
O["dq_referential"] = with_ctes(" UNION ALL ".join(
    check_row(d, "referential",
              f"1.0::DOUBLE - COUNT(*) FILTER (WHERE {fk} IS NULL OR {fk} NOT IN (SELECT {rc} FROM {ref}))::DOUBLE / COUNT(*)",
              unlinked(fk, ref, rc), t)
    for d, fk, t, ref, rc in [("events_news", "subscriber_id", "events_news", "raw_subscribers", "subscriber_id"),
                              ("orders", "o_custkey", "orders", "customer", "c_custkey"),
                              ("customer", "c_custkey", "customer", "events", "user_id")]))
O["dq_validity"] = with_ctes(" UNION ALL ".join(
    check_row(d, "validity", f"1.0::DOUBLE - COUNT(*) FILTER (WHERE {c} NOT IN {ok})::DOUBLE / COUNT(*)",
              [not_allowed(c, ok, t)], t)
    for d, c, ok, t in [("subscribers_6", "plan_type", PLANS_6, "raw_subscribers"),
                        ("subscribers_7", "plan_type", PLANS_7, "raw_subscribers"),
                        ("orders", "o_orderstatus", "('F','O')", "orders")]))
O["dq_composite"] = f"""SELECT 'orders' AS dataset, composite, {label('composite')} AS status FROM (
SELECT {COMPOSITE} AS composite FROM (SELECT
  ({share('o_orderkey')} + {share('o_custkey')}) / 2.0::DOUBLE AS completeness,
  COUNT(DISTINCT o_custkey)::DOUBLE / COUNT(*) AS uniqueness,
  1.0::DOUBLE - COUNT(*) FILTER (WHERE o_orderdate > TIMESTAMP '1998-01-01 00:00:00')::DOUBLE / COUNT(*) AS timeliness,
  1.0::DOUBLE - COUNT(*) FILTER (WHERE o_custkey NOT IN (SELECT c_custkey FROM customer))::DOUBLE / COUNT(*) AS referential,
  1.0::DOUBLE - COUNT(*) FILTER (WHERE o_orderstatus NOT IN ('F','O'))::DOUBLE / COUNT(*) AS validity FROM orders))"""
O["dq_report"] = with_ctes("SELECT * FROM dq_rows", DQ)
O["dq_dimensions"] = with_ctes(" UNION ALL ".join(
    f"SELECT dataset_name, '{d}' AS dimension, {d}_score AS score, {d}_label AS label FROM dq_rows" for d in DIMS), DQ)
O["dq_summary"] = with_ctes("""SELECT COUNT(*) AS total_datasets, COUNT(*) FILTER (WHERE status = 'PASS') AS pass,
  COUNT(*) FILTER (WHERE status = 'WARN') AS warn, COUNT(*) FILTER (WHERE status = 'FAIL') AS fail,
  MIN(composite_score) AS min_score, round(AVG(composite_score), 2) AS avg_score FROM dq_rows""", DQ)
O["dq_gates"] = with_ctes(
    "SELECT dataset_name, status, status = 'FAIL' AS halts, status = 'WARN' AS warns FROM dq_rows", DQ)
O["dq_scorecard"] = with_ctes(scorecard())

_STG_NEWS = {"stg_events_news": staged("news")}
_TESTS = [
    ("raw.subscribers", "raw_subscribers", "subscriber_id", "not_null", ""),
    ("raw.subscribers", "raw_subscribers", "plan_type", "not_null", ""),
    ("raw.subscribers", "raw_subscribers", "plan_type", "accepted_values", f"plan_type NOT IN {PLANS_7}"),
    ("raw.subscribers", "raw_subscribers", "subscription_start_date", "not_null", ""),
    ("raw.subscribers", "raw_subscribers", "is_churned", "not_null", ""),
    ("raw.events_news", "events_news", "event_id", "not_null", ""),
    ("raw.events_news", "events_news", "event_id", "unique", ""),
    ("raw.events_news", "events_news", "event_type", "accepted_values", f"event_type NOT IN {TYPES['news']}"),
    ("raw.events_news", "events_news", "event_timestamp", "not_null", ""),
    ("raw.events_games", "events_games", "event_id", "not_null", ""),
    ("raw.events_games", "events_games", "event_id", "unique", ""),
    ("raw.events_games", "events_games", "game_name", "accepted_values", f"game_name NOT IN {GAMES}"),
    ("raw.events_cooking", "events_cooking", "event_id", "not_null", ""),
    ("raw.events_cooking", "events_cooking", "event_id", "unique", ""),
    ("raw.events_athletic", "events_athletic", "event_id", "not_null", ""),
    ("raw.events_athletic", "events_athletic", "event_id", "unique", ""),
    ("stg.subscribers", "stg_subscribers", "subscriber_id", "not_null", ""),
    ("stg.subscribers", "stg_subscribers", "subscriber_id", "unique", ""),
    ("stg.subscribers", "stg_subscribers", "plan_type", "not_null", ""),
    ("stg.subscribers", "stg_subscribers", "bundle_tier", "accepted_values",
     "bundle_tier NOT IN ('full_bundle','partial_bundle','single_product')"),
    ("stg.subscribers", "stg_subscribers", "tenure_days", "not_null", ""),
    ("stg.subscribers", "stg_subscribers", "tenure_days", "accepted_range", "NOT tenure_days BETWEEN 0 AND 3650"),
    ("stg.events_news", "stg_events_news", "event_id", "not_null", ""),
    ("stg.events_news", "stg_events_news", "event_id", "unique", ""),
    ("stg.events_news", "stg_events_news", "event_date", "not_null", ""),
    ("stg.events_news", "stg_events_news", "subscriber_id", "not_null", ""),
    ("stg.events_news", "stg_events_news", "time_on_page_sec", "accepted_range",
     "NOT time_on_page_sec BETWEEN 0 AND 1800"),
]
O["column_tests"] = with_ctes(" UNION ALL ".join(
    f"SELECT '{rel}' AS relation, '{col}' AS column_name, '{test}' AS test, COUNT(*) AS failures FROM "
    + (f"(SELECT {col} FROM {t} WHERE {col} IS NOT NULL GROUP BY {col} HAVING COUNT(*) > 1)" if test == "unique"
       else f"{t} WHERE " + (cond or f"{col} IS NULL"))
    for rel, t, col, test, cond in _TESTS), _STG_NEWS)
O["test_not_null"] = with_ctes("SELECT subscriber_id, created_at FROM raw_subscribers WHERE plan_type IS NULL")
O["test_unique"] = with_ctes("SELECT subscriber_id, COUNT(*) AS n FROM raw_subscribers WHERE subscriber_id IS NOT NULL "
                             "GROUP BY 1 HAVING COUNT(*) > 1")
O["test_unique_orders"] = "SELECT o_custkey, COUNT(*) AS n FROM orders GROUP BY 1 HAVING COUNT(*) > 1"
O["test_accepted_values"] = with_ctes(
    f"SELECT plan_type, COUNT(*) AS n FROM raw_subscribers WHERE plan_type NOT IN {PLANS_7} GROUP BY 1")
O["test_accepted_values_orders"] = ("SELECT o_orderpriority, COUNT(*) AS n FROM orders "
                                    "WHERE o_orderpriority NOT IN ('1-URGENT','2-HIGH') GROUP BY 1")
O["test_accepted_range"] = with_ctes("SELECT event_id, round(time_on_page_sec, 6) AS dwell FROM events_news "
                                     "WHERE NOT time_on_page_sec BETWEEN 0 AND 1800")
O["top_invalid_values"] = with_ctes(
    f"SELECT plan_type, COUNT(*) AS n FROM raw_subscribers WHERE plan_type NOT IN {PLANS_6} "
    "GROUP BY 1 ORDER BY n DESC, plan_type LIMIT 5")

O["drift_events"] = with_ctes("SELECT * FROM drift_rows", DRIFTED)
FILES = {
    "orders": [("o_orderkey", "bigint", True), ("o_custkey", "int", True), ("o_orderstatus", "string", False),
               ("o_totalprice", "decimal(15,2)", True), ("o_orderdate", "timestamp_ntz", True),
               ("o_clerk", "string", False)],
    "customer": [("c_custkey", "bigint", True), ("c_name", "string", False), ("c_segment", "string", True)],
    "events": [("event_id", "bigint", True), ("ts", "timestamp_ntz", True), ("user_id", "bigint", True),
               ("event_type", "string", False), ("value", "double", False), ("props", "string", False)],
}
_FILE_COLUMNS = {"orders": "o_orderkey o_custkey o_orderstatus o_totalprice o_orderdate o_orderpriority",
                 "customer": "c_custkey c_name c_nationkey c_acctbal c_mktsegment",
                 "events": "event_id ts user_id event_type value props"}
O["drift_columns"] = ("WITH registry AS (SELECT * FROM (VALUES " + ", ".join(
    f"('{t}','{c}','{d}',{b})" for t, cols in FILES.items() for c, d, b in cols)
    + ") v(dataset, column_name, expected, breaking)), live AS (" + " UNION ALL ".join(
    described(t, f"SELECT * FROM {t}") for t in FILES) + "), column_events AS (" + DRIFTED["column_events"]
    + "), filled AS (" + " UNION ALL ".join(
    f"SELECT '{t}' AS dataset, '{c}' AS column_name, COUNT(*) AS n_rows, COUNT({c}) AS n_filled FROM {t}"
    for t, cols in _FILE_COLUMNS.items() for c in cols.split())
    + ") SELECT e.*, f.n_rows, f.n_filled FROM column_events e LEFT JOIN filled f USING (dataset, column_name)")
# the files' own footers; all scale factors have the same columns and types
FOOTER_FILES = ("customer", "events", "lineitem", "nation", "orders", "part", "region", "supplier")


def footer(name: str) -> str:
    return f"""SELECT '{name}.parquet' AS file, name AS column_name,
  CASE WHEN type = 'INT64' AND logical_type::VARCHAR LIKE 'TimestampType%' THEN 'timestamp_ntz'
       WHEN converted_type = 'DECIMAL' THEN 'decimal(' || "precision" || ',' || scale || ')'
       WHEN converted_type = 'DATE' THEN 'date' WHEN converted_type = 'UTF8' THEN 'string'
       WHEN type = 'INT64' THEN 'bigint' WHEN type = 'INT32' THEN 'int' ELSE lower(type) END AS dtype
FROM parquet_schema('/root/testdata/sf0.01/{name}.parquet') WHERE num_children IS NULL"""


O["file_schemas"] = " UNION ALL ".join(map(footer, FOOTER_FILES))
O["drift_files"] = ("WITH registry AS (SELECT * FROM (VALUES " + ", ".join(
    f"('{t}','{c}','{d}',{b})" for t, cols in FILES.items() for c, d, b in cols)
    + ") v(dataset, column_name, expected, breaking)), live AS (" + " UNION ALL ".join(
    f"SELECT '{t}' AS dataset, * FROM ({footer(t)})" for t in FILES) + """)
SELECT coalesce(l.file, r.dataset || '.parquet') AS file, column_name, dataset,
       CASE WHEN l.dtype IS NULL THEN 'MISSING_COLUMN' WHEN r.expected IS NULL THEN 'NEW_COLUMN' ELSE 'TYPE_CHANGE' END
         AS drift_type,
       CASE WHEN l.dtype IS NULL AND breaking THEN 'BREAKING' WHEN l.dtype IS NULL OR r.expected IS NULL THEN 'WARNING'
            ELSE 'BREAKING' END AS severity, r.expected, l.dtype AS actual
FROM registry r FULL JOIN live l USING (dataset, column_name) WHERE l.dtype IS DISTINCT FROM r.expected""")
_PRESENT = {"news": "subscriber_id section time_on_page_sec", "games": "subscriber_id game_name score",
            "cooking": "subscriber_id rating", "athletic": "subscriber_id time_on_page_sec sport"}
_DTYPES = {"subscriber_id": "string", "section": "string", "time_on_page_sec": "double", "game_name": "string",
           "score": "bigint", "rating": "double", "sport": "string"}
O["drift_partitions"] = with_ctes(" UNION ALL ".join(
    f"SELECT '{p}' AS product, CAST(event_timestamp AS DATE) AS event_date, '{c}' AS column_name, '{d}' AS dtype, "
    f"COUNT(*) AS n_rows, {f'COUNT({c})' if c in _PRESENT[p].split() else '0::BIGINT'} AS n_filled "
    f"FROM events_{p} GROUP BY 2" for p in PRODUCTS for c, d in _DTYPES.items()))
O["drift_gates"] = with_ctes("SELECT dataset, status, status = 'BREAKING' AS halts FROM statuses", DRIFTED)
O["drift_enum"] = with_ctes("SELECT * FROM enum_values", drift_ctes(False))
O["drift_status"] = with_ctes("SELECT * FROM statuses", DRIFTED)
O["drift_summary"] = with_ctes("""SELECT COUNT(*) AS total_datasets, COUNT(*) FILTER (WHERE status = 'CLEAN') AS clean,
  COUNT(*) FILTER (WHERE status = 'INFO') AS info, COUNT(*) FILTER (WHERE status = 'WARNING') AS warning,
  COUNT(*) FILTER (WHERE status = 'BREAKING') AS breaking, CAST(SUM(events) AS BIGINT) AS total_events FROM statuses""",
                               DRIFTED)
O["drift_latest_day"] = with_ctes("""
SELECT 'events_games' AS dataset, 'game_name' AS column_name, 'WARNING' AS severity, game_name AS value,
  CAST(event_timestamp AS DATE) AS event_date, COUNT(*) AS n FROM events_games
WHERE game_name NOT IN ('wordle','crossword','strands')
  AND CAST(event_timestamp AS DATE) = (SELECT MAX(CAST(event_timestamp AS DATE)) FROM events_games)
GROUP BY game_name, CAST(event_timestamp AS DATE)""")

O["late_events"] = late("SELECT event_id, domain, event_date, round(lag_hours, 6) AS lag_hours, is_late, lag_bucket FROM lagged")
O["late_shares"] = late("SELECT * FROM domains")
O["late_domain_stats"] = late(f"""
SELECT l.domain, CAST({LATE_AFTER.replace('domain', 'l.domain')} AS INTEGER) AS threshold_hours, COUNT(*) AS total_events,
  COUNT(*) FILTER (WHERE is_late) AS late_events,
  round(COUNT(*) FILTER (WHERE is_late)::DOUBLE / COUNT(*) * 100.0::DOUBLE, 2) AS late_pct,
  round(AVG(lag_hours), 3) AS avg_lag_hours, round(quantile_cont(lag_hours, 0.5), 3) AS p50_lag_hours,
  round(quantile_cont(lag_hours, 0.95), 3) AS p95_lag_hours, round(MAX(lag_hours), 3) AS max_lag_hours,
  (SELECT COUNT(*) FROM days d WHERE d.domain = l.domain AND d.late_pct > 5.0) AS reprocess_day_count
FROM lagged l GROUP BY l.domain""")
O["late_platform"] = late("""
SELECT domain, platform, COUNT(event_id) AS total_events, COUNT(*) FILTER (WHERE is_late) AS late_events,
  round(AVG(lag_hours), 2) AS avg_lag_hours, round(quantile_cont(lag_hours, 0.95), 2) AS p95_lag_hours
FROM lagged WHERE platform IS NOT NULL GROUP BY 1, 2""")
O["late_days"] = late("SELECT *, late_pct > 5.0 AS needs_reprocessing FROM days")
O["late_buckets"] = late(f"""
SELECT d.domain, b.lag_bucket, COUNT(l.event_id) AS events
FROM (VALUES {', '.join(f"('events_{p}')" for p in PRODUCTS)}) d(domain)
CROSS JOIN (VALUES {', '.join(f"('{b}')" for b in LABELS)}) b(lag_bucket)
LEFT JOIN lagged l ON l.domain = d.domain AND l.lag_bucket = b.lag_bucket GROUP BY 1, 2""")
O["late_manifest"] = late("SELECT * FROM manifest")
O["late_summary"] = late("""
SELECT COUNT(*) AS total_events, COUNT(*) FILTER (WHERE is_late) AS total_late,
  round(COUNT(*) FILTER (WHERE is_late)::DOUBLE / COUNT(*) * 100.0::DOUBLE, 2) AS overall_late_pct,
  (SELECT COUNT(DISTINCT domain) FROM days WHERE late_pct > 5.0) AS domains_with_reprocessing,
  (SELECT COUNT(*) FROM days WHERE late_pct > 5.0) AS total_reprocess_jobs,
  (SELECT COUNT(*) FROM domains WHERE late_pct > 2) AS domains_warned FROM lagged""")

O["plan_distribution"] = with_ctes("SELECT plan_type, COUNT(*) AS subscribers FROM raw_subscribers "
                                   "WHERE plan_type IS NOT NULL GROUP BY 1")
O["table_materialization"] = O["plan_distribution"]
O["acquisition_distribution"] = with_ctes(
    "SELECT acquisition_channel, COUNT(*) AS subscribers FROM raw_subscribers "
    "WHERE acquisition_channel IS NOT NULL GROUP BY 1")
O["tier_distribution"] = with_ctes("""
SELECT CASE WHEN plan_type = 'bundle_all' THEN 'Full Bundle' WHEN plan_type = 'bundle_3' THEN 'Partial Bundle'
  ELSE 'Single Product' END AS tier, COUNT(*) AS subscribers FROM raw_subscribers GROUP BY 1""")
O["churn_by_plan"] = with_ctes("""
SELECT plan_type, COUNT(*) FILTER (WHERE is_churned) AS churned,
  round(COUNT(*) FILTER (WHERE is_churned)::DOUBLE / COUNT(*) * 100.0::DOUBLE, 1) AS rate
FROM raw_subscribers WHERE plan_type IS NOT NULL GROUP BY 1""")
O["weekly_active"] = with_ctes("""
SELECT product, COUNT(DISTINCT subscriber_id) AS active_subscribers FROM all_events
WHERE CAST(event_timestamp AS DATE) >= (SELECT MAX(CAST(event_timestamp AS DATE)) - 7 FROM all_events
                                        WHERE product IN ('news','games')) GROUP BY 1""")
O["game_completions"] = with_ctes("SELECT game_name, COUNT(*) AS completions FROM events_games "
                                  "WHERE event_type = 'game_complete' GROUP BY 1")
O["daily_readers"] = with_ctes("""
SELECT CAST(event_timestamp AS DATE) AS event_date, COUNT(DISTINCT subscriber_id) AS readers FROM events_news
WHERE CAST(event_timestamp AS DATE) >= (SELECT MAX(CAST(event_timestamp AS DATE)) - 30 FROM events_news) GROUP BY 1""")
_SETS = {f"{p[0]}u": f"SELECT DISTINCT subscriber_id FROM events_{p} WHERE subscriber_id IS NOT NULL" for p in PRODUCTS}


def _both(*names: str) -> str:
    return "(" + " INTERSECT ".join(f"SELECT * FROM {n}" for n in names) + ")"


_PAIRS = [("nu", "gu"), ("nu", "cu"), ("nu", "au"), ("gu", "cu"), ("gu", "au"), ("cu", "au")]
O["multi_product"] = with_ctes(f"""
SELECT '1 Product' AS bucket, COUNT(*) AS subscribers FROM (
  (SELECT * FROM nu UNION SELECT * FROM gu UNION SELECT * FROM cu UNION SELECT * FROM au)
  EXCEPT ({' UNION '.join(_both(*p) for p in _PAIRS)}))
UNION ALL SELECT '2 Products', (SELECT COUNT(*) FROM ({' UNION '.join(_both(*p) for p in [_PAIRS[0], _PAIRS[1], _PAIRS[3]])}))
  - (SELECT COUNT(*) FROM {_both('nu', 'gu', 'cu')})
UNION ALL SELECT '3 Products', (SELECT COUNT(*) FROM {_both('nu', 'gu', 'cu')})
  - (SELECT COUNT(*) FROM {_both('nu', 'gu', 'cu', 'au')})
UNION ALL SELECT '4 Products', (SELECT COUNT(*) FROM {_both('nu', 'gu', 'cu', 'au')})""", _SETS)
O["product_breadth"] = with_ctes("""
SELECT CAST(products AS INTEGER) AS products, COUNT(*) AS subscribers FROM (
  SELECT subscriber_id, COUNT(DISTINCT product) AS products FROM all_events WHERE subscriber_id IS NOT NULL GROUP BY 1)
GROUP BY 1""")
_TENURE = f"GREATEST(date_diff('day', CAST(subscription_start_date AS DATE), {TODAY}), 0)"
O["risk_buckets"] = with_ctes(f"""
SELECT CASE WHEN is_churned THEN 'Churned' WHEN {_TENURE} < 30 THEN 'New (<30d)'
  WHEN plan_type IN ('bundle_all','bundle_3') THEN 'Low Risk' ELSE 'Medium Risk' END AS risk, COUNT(*) AS subscribers
FROM raw_subscribers GROUP BY 1""")
O["section_readers"] = with_ctes("SELECT section, COUNT(DISTINCT subscriber_id) AS readers FROM events_news GROUP BY 1")
O["kpis"] = with_ctes(f"""
SELECT COUNT(*) AS total_subs, COUNT(*) FILTER (WHERE is_churned) AS churned,
  round(AVG({_TENURE}) FILTER (WHERE NOT is_churned), 1) AS avg_tenure,
  round(AVG(CASE WHEN plan_type IN ('bundle_all','bundle_3') THEN 1.0::DOUBLE ELSE 0.0::DOUBLE END) * 100, 1) AS bundle_pct,
  round(SUM(CASE WHEN plan_type = 'bundle_all' THEN 20.0::DOUBLE WHEN plan_type = 'bundle_3' THEN 14.0::DOUBLE
            ELSE 5.0::DOUBLE END) FILTER (WHERE NOT is_churned), 0) AS mrr_estimate,
  (SELECT COUNT(*) FROM all_events) AS total_events
FROM raw_subscribers""")

O["bundle_metrics"] = with_ctes(f"""
SELECT s.plan_type, week_start, COUNT(*) AS active_subscribers, CAST(SUM(n) AS BIGINT) AS events,
  SUM(CASE bundle_tier WHEN 'full_bundle' THEN 20.0::DOUBLE WHEN 'partial_bundle' THEN 14.0::DOUBLE ELSE 5.0::DOUBLE END) AS mrr_usd
FROM (SELECT subscriber_id, CAST(date_trunc('week', event_timestamp) AS DATE) AS week_start, COUNT(*) AS n FROM all_events
      WHERE CAST(event_timestamp AS DATE) >= {TODAY} - 90 GROUP BY 1, 2) w
JOIN stg_subscribers s ON s.subscriber_id = w.subscriber_id GROUP BY 1, 2""")
O["churn_rate"] = with_ctes(f"""
SELECT plan_type, COUNT(*) FILTER (WHERE a) AS active_at_start, COUNT(*) FILTER (WHERE a AND e <= {TODAY}) AS churned,
  round(COUNT(*) FILTER (WHERE a AND e <= {TODAY})::DOUBLE / NULLIF(COUNT(*) FILTER (WHERE a), 0) * 100, 2) AS churn_pct
FROM (SELECT plan_type, subscription_end_date AS e, subscription_start_date < {TODAY} - 90
  AND (subscription_end_date IS NULL OR subscription_end_date >= {TODAY} - 90) AS a FROM stg_subscribers) GROUP BY 1""")
O["bundle_ltv"] = with_ctes("""
SELECT *, round(mrr_usd * avg_tenure_days / 30.0::DOUBLE, 2) AS ltv_usd FROM (
SELECT bundle_tier, COUNT(*) AS subscribers, round(AVG(tenure_days), 6) AS avg_tenure_days,
  CASE bundle_tier WHEN 'full_bundle' THEN 20.0::DOUBLE WHEN 'partial_bundle' THEN 14.0::DOUBLE ELSE 5.0::DOUBLE END AS mrr_usd
FROM stg_subscribers GROUP BY bundle_tier)""")

O["membership_by_event_type"] = """
SELECT event_type, COUNT(*) AS total, COUNT(*) FILTER (WHERE user_id IN (SELECT o_custkey FROM orders)) AS matched,
  COUNT(*) FILTER (WHERE user_id IS NOT NULL AND user_id NOT IN (SELECT o_custkey FROM orders)) AS orphans,
  COUNT(*) FILTER (WHERE user_id IS NULL) AS nulls FROM events GROUP BY 1"""
O["customers_with_orders"] = ("SELECT c_custkey, c_mktsegment FROM customer c "
                              "WHERE EXISTS (SELECT 1 FROM orders o WHERE o.o_custkey = c.c_custkey)")
O["customers_without_events"] = ("SELECT c_custkey, c_mktsegment FROM customer c "
                                 "WHERE NOT EXISTS (SELECT 1 FROM events e WHERE e.user_id = c.c_custkey)")
O["priority_counts"] = "SELECT o_orderpriority, COUNT(*) AS n FROM orders WHERE o_orderpriority IS NOT NULL GROUP BY 1"
O["open_rate_by_priority"] = """
SELECT o_orderpriority, COUNT(*) AS n, COUNT(*) FILTER (WHERE o_orderstatus = 'O') AS flagged,
  round(COUNT(*) FILTER (WHERE o_orderstatus = 'O')::DOUBLE / COUNT(*) * 100.0::DOUBLE, 1) AS rate
FROM orders WHERE o_orderpriority IS NOT NULL GROUP BY 1"""
O["busiest_customers"] = "SELECT o_custkey, COUNT(*) AS n FROM orders GROUP BY 1 ORDER BY n DESC, o_custkey LIMIT 20"
O["trailing_month_orders"] = """
SELECT CAST(o_orderdate AS DATE) AS order_date, COUNT(*) AS orders FROM orders
WHERE CAST(o_orderdate AS DATE) >= (SELECT MAX(CAST(o_orderdate AS DATE)) - 30 FROM orders) GROUP BY 1"""
O["price_percentiles"] = """
SELECT o_orderstatus, round(quantile_cont(c, 0.5), 3) AS p50, round(quantile_cont(c, 0.95), 3) AS p95,
  round(quantile_cont(c, 0.99), 3) AS p99
FROM (SELECT o_orderstatus, CAST(round(o_totalprice * 100) AS DOUBLE) AS c FROM orders) GROUP BY 1"""

O["stg_news_by_date"] = O["stg_events_news"]
O["late_manifest_12_hours"] = with_ctes("SELECT * FROM manifest", HALF_A_DAY)
O["late_summary_12_hours"] = O["late_summary"].replace(LATE_AFTER, "12")


def report(parts: dict[str, str]) -> str:
    """Every row of every part: its name=value pairs as text, in text order; NULLs left out."""
    return " UNION ALL ".join(
        f"SELECT '{section}' AS section, "
        f"array_to_string(list_sort([k || '=' || (j ->> ('$.\"' || k || '\"')) FOR k IN json_keys(j) "
        f"IF (j ->> ('$.\"' || k || '\"')) IS NOT NULL]), '|') AS line FROM (SELECT to_json(t) AS j FROM ({query}) t)"
        for section, query in parts.items())


O["csv_unparsed"] = """
WITH cells AS (
  SELECT 'half=' || o_orderkey % 2 AS folder, 'o_totalprice' AS column_name,
         CASE WHEN o_orderkey % 97 = 0 THEN 'n/a' WHEN o_orderkey % 89 = 0 THEN '1,250.00' END AS cell FROM orders
  UNION ALL
  SELECT 'half=' || o_orderkey % 2, 'o_orderdate', CASE WHEN o_orderkey % 83 = 0 THEN 'day ' || o_orderkey % 5 END FROM orders)
SELECT folder, column_name, cell, COUNT(*) AS n_rows FROM cells WHERE cell IS NOT NULL GROUP BY ALL"""
for _name in ("daily_active", "weekly_active", "daily_readers"):
    O[f"{_name}_from_state"] = O[_name]
O["active_between"] = with_ctes("""
SELECT COUNT(DISTINCT subscriber_id) AS active_subscribers FROM (
  SELECT subscriber_id, event_timestamp FROM events_news UNION ALL
  SELECT subscriber_id, event_timestamp FROM events_games)
WHERE CAST(event_timestamp AS DATE) BETWEEN DATE '2024-01-05' AND DATE '2024-01-18'""")
_LIMITS = [*((f"late after hours: events_{p}", h) for p, h in THRESHOLDS.items()), ("late after hours: other", 2),
           ("recompute a date above percent", 5), ("high priority above percent", 10), ("warning above percent", 2)]
O["late_report"] = report({
    "summary": O["late_summary"], "domain": O["late_domain_stats"], "platform": O["late_platform"],
    "bucket": O["late_buckets"], "manifest": O["late_manifest"],
    "limits": "SELECT * FROM (VALUES " + ", ".join(f"('{n}', {v}::DOUBLE)" for n, v in _LIMITS) + ") v(name, value)"})
O["dashboard_report"] = report({
    "kpis": O["kpis"], "plan": O["plan_distribution"], "churn": O["churn_by_plan"],
    "acquisition": O["acquisition_distribution"], "tier": O["tier_distribution"], "weekly_active": O["weekly_active"],
    "game": O["game_completions"], "daily_readers": O["daily_readers"], "multi_product": O["multi_product"],
    "risk": O["risk_buckets"], "section": O["section_readers"]})
O["drift_report"] = report({
    "registry": "SELECT '2024.Q1.3' AS version", "summary": O["drift_summary"], "dataset": O["drift_status"],
    "event": O["drift_events"], "gate": O["drift_gates"],
    "columns": with_ctes("""SELECT dataset, (SELECT COUNT(*) FROM registry r WHERE r.dataset = l.dataset) AS columns_expected,
  COUNT(*) AS columns_found FROM live l GROUP BY dataset""", DRIFTED),
    "unknown_value": with_ctes("SELECT * FROM enum_values WHERE dataset = 'subscribers'", DRIFTED)})
O["json_report"] = report({
    "summary": O["dq_summary"], "gate": O["dq_gates"],
    "dataset": with_ctes("SELECT dataset_name, domain, run_at, total_records, composite_score, status FROM dq_rows", DQ),
    "dimension": with_ctes(" UNION ALL ".join(
        f"SELECT dataset_name, '{d}' AS dimension, {d}_score AS score, {d}_label AS label, {d}_issues AS issues FROM dq_rows"
        for d in DIMS), DQ)})

ORACLES = O

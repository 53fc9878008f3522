"""SQL statements of the expected results, for DuckDB over the ``events`` table.

Written on their own from the definitions: set logic with EXISTS, FILTER and plain distinct counts,
where the Spark side folds rows per player first.
"""

from __future__ import annotations

from checks.telemetry import (
    ALL_LEVELS, CORRECTION, EARLY, EXPERIMENT, FAR_EAST, FAR_WEST_REPORT, MILESTONE, OTHER_HORIZONS, RANGE,
    UTC_REPORT,
)
from levelscope.config import ReportConfig

BUCKETS = [f"{low}-{low + 10}" for low in range(0, 100, 10)]


def text_in(values) -> str:
    return "(" + ", ".join(f"'{v}'" for v in values) + ")"


RAW = """
ids AS (
  SELECT event_id, ts AS event_ts, user_id AS u, CAST(json_extract_string(props, '$.k') AS INT) AS k,
         event_id // 20 AS q, event_id % 20 AS r,
         date_diff('day', DATE '2024-01-01', CAST(ts + INTERVAL 7 HOURS AS DATE)) AS d
  FROM events
), game AS (
  SELECT *,
    CASE WHEN r < 5 THEN 'level_start' WHEN r < 7 THEN 'level_start_turn'
         WHEN r < 9 THEN 'level_end' WHEN r < 12 THEN 'level_end_turn'
         WHEN r < 14 THEN 'spend_virtual_currency' WHEN r < 16 THEN 'paid_ad_impression'
         WHEN r = 16 THEN 'in_app_purchase' WHEN r = 17 THEN 'session_start'
         WHEN r = 18 THEN 'screen_view'
         ELSE CASE q % 3 WHEN 0 THEN 'app_remove' WHEN 1 THEN 'earn_virtual_currency'
              ELSE 'app_loading' END END AS event_name,
    1 + (d + u % 5) // 5 AS whole_level,
    CASE WHEN k % 10 = 9 THEN '"sl"' WHEN k % 17 = 16 THEN 'null'
         WHEN k % 13 = 12 THEN '"bonus"' ELSE '"classic"' END AS mode_json
  FROM ids
), raw AS (
  SELECT event_id, event_ts, event_name,
    CASE WHEN event_id % 50 = 49 THEN 'app_other' ELSE 'app_main' END AS app_id,
    CASE WHEN event_id % 97 <> 0 THEN concat('u', u) END AS user_pseudo_id,
    CASE WHEN event_id % 103 = 0 THEN NULL WHEN event_id % 107 = 0 THEN '{bad' ELSE concat(
      '{"level":', whole_level,
      CASE WHEN event_id % 29 = 0 THEN '.1' WHEN event_id % 31 = 0 THEN '.2' ELSE '' END,
      ',"mode":', mode_json,
      ',"phase":', CASE WHEN event_id % 7 = 0 THEN 'null' WHEN event_id % 13 = 0 THEN '2'
                        WHEN event_id % 59 = 0 THEN '1.6' ELSE '1' END,
      ',"success":', CASE WHEN q % 2 = 0 THEN 'true' ELSE 'false' END,
      ',"start_count":', CASE WHEN event_id % 19 = 0 THEN 'null' WHEN event_id % 61 = 0 THEN '1.5'
                              ELSE concat('', 1 + k % 4) END,
      ',"continue_times":', CASE WHEN event_id % 5 = 0 THEN 'null' ELSE concat('', k % 3) END,
      ',"completion":', CASE WHEN event_id % 23 = 0 THEN 'null' WHEN event_id % 37 = 0 THEN '110'
                             ELSE concat('', k) END,
      ',"coin":', CASE WHEN event_id % 101 = 0 THEN '2000000' WHEN event_id % 41 = 0 THEN '-5'
                       ELSE concat('', 10 * k) END,
      ',"ticket":', k % 5, ',"booster_x":', k % 3, ',"use_booster_count":', k % 4,
      ',"value":', CASE WHEN event_id % 53 = 0 THEN '400000000' ELSE concat('', k) END,
      ',"currency":"', CASE k % 3 WHEN 0 THEN 'USD' WHEN 1 THEN 'ILS' ELSE 'EUR' END,
      '","value_game_currency":', CASE WHEN event_id % 43 = 0 THEN '-1' ELSE concat('', 5 * k) END,
      ',"virtual_currency_name":"', CASE k % 4 WHEN 0 THEN 'Coin' WHEN 1 THEN 'ticket'
                                               WHEN 2 THEN 'booster_x' ELSE '' END,
      '","virtual_currency_type":"', CASE WHEN k % 4 >= 2 THEN 'booster' ELSE 'currency' END,
      '","ad_format":"', CASE q % 5 WHEN 0 THEN 'interstitial' WHEN 1 THEN 'Rewarded'
                                    WHEN 2 THEN 'banner' WHEN 3 THEN 'native_advanced'
                                    ELSE 'rewarded_interstitial' END, '"}') END AS event_params,
    CASE WHEN event_id % 109 <> 0 THEN concat(
      '{"level":', whole_level + CASE WHEN event_id % 11 = 0 THEN 1 ELSE 0 END,
      ',"mode":', mode_json,
      ',"phase":', CASE WHEN event_id % 17 = 0 THEN '2' ELSE '1' END,
      ',"exp_group":"', u % 4, '"}') END AS user_properties,
    concat('1.', u % 3) AS app_version,
    CASE u % 10 WHEN 0 THEN 'China' WHEN 1 THEN NULL ELSE 'VN' END AS country,
    CASE WHEN u % 20 = 10 THEN NULL WHEN u % 2 = 0 THEN 'android' ELSE 'ios' END AS platform
  FROM game
), decoded AS (
  SELECT *, TRY_CAST(event_params AS JSON) AS ep, TRY_CAST(user_properties AS JSON) AS up FROM raw
)"""


def at(payload: str, key: str) -> str:
    return f"json_extract_string({payload}, '$.{key}')"


def dbl(payload: str, key: str) -> str:
    return f"TRY_CAST({at(payload, key)} AS DOUBLE)"


def whole(payload: str, key: str, rounded: bool = False) -> str:
    return f"TRY_CAST({'round' if rounded else 'trunc'}({dbl(payload, key)}) AS BIGINT)"


START, STOP = CORRECTION.utc_bounds()
CORRECTED = f"""{RAW}, history AS (
  SELECT * FROM decoded WHERE app_id = '{CORRECTION.app_id}'
  AND event_ts >= TIMESTAMP '{START}' AND event_ts < TIMESTAMP '{STOP}'
), cutoffs AS (
  SELECT user_pseudo_id, min(event_ts) AS first_clear_650_ts FROM history
  WHERE user_pseudo_id IS NOT NULL AND event_name = 'level_end' AND {at('ep', 'mode')} = 'classic'
    AND lower({at('ep', 'success')}) = 'true' AND {dbl('ep', 'level')} = {MILESTONE}
    AND {dbl('up', 'level')} = {MILESTONE}
  GROUP BY ALL
), marked AS (
  SELECT h.*, c.first_clear_650_ts, {at('ep', 'mode')} AS mode_original,
    coalesce({at('ep', 'mode')} = 'classic' AND h.event_ts > c.first_clear_650_ts, false)
      AS is_mode_fixed
  FROM history h LEFT JOIN cutoffs c USING (user_pseudo_id)
), corrected AS (
  SELECT *, if(is_mode_fixed, 'sl', mode_original) AS mode_fixed,
    CASE WHEN is_mode_fixed THEN 'classic_after_clear650'
         WHEN mode_original = 'sl' THEN 'existing_sl'
         WHEN first_clear_650_ts IS NULL THEN 'no_clear650_in_history'
         ELSE 'unchanged' END AS fix_reason,
    CAST(event_ts + INTERVAL 7 HOURS AS DATE) AS analysis_date_utc7,
    {at('up', EXPERIMENT)} AS ab_group
  FROM marked
)"""


def level_of(payload: str, rounded: bool) -> str:
    text, phase = at(payload, "level"), whole(payload, "phase", rounded)
    return f"""TRY_CAST(CASE WHEN instr({text}, '.') > 1 THEN replace({text}, '.1', '')
      WHEN {phase} > 1 THEN concat({whole(payload, 'level')}, '.', {phase})
      ELSE {text} END AS DOUBLE)"""


def relations(cfg: ReportConfig) -> str:
    """CTEs from corrected events to the relations the reports are made of."""
    own = f"event_name IN {text_in(cfg.property_events)}"
    versions = f"app_version IN {text_in(cfg.versions)}" if cfg.versions else "true"
    in_range = (
        f"level >= {cfg.level_min} AND level <= {cfg.level_max}"
        if cfg.level_min is not None
        else "level IS NOT NULL"
    )
    start_range = (
        f"level >= {cfg.level_min} AND level <= {cfg.level_max} + 1"
        if cfg.level_min is not None
        else "level IS NOT NULL"
    )
    report = f"local_date >= DATE '{cfg.report_start}' AND local_date <= DATE '{cfg.report_end}'"
    horizons = ", ".join(str(n) for n in cfg.day_horizons)
    lo, hi = cfg.window_utc()

    def number(payload: str, key: str) -> str:
        return whole(payload, key, cfg.round_whole)

    return f"""{CORRECTED}, win AS (
  SELECT * FROM corrected WHERE event_ts >= TIMESTAMP '{lo}' AND event_ts < TIMESTAMP '{hi}'
), typed AS (
  SELECT event_id, user_pseudo_id, event_name, app_version, country, platform, mode_fixed, ep, up,
    event_ts, first_clear_650_ts, analysis_date_utc7 AS local_date, {at('up', EXPERIMENT)} AS variant,
    {at('up', 'level')} AS property_level_text,
    {dbl('ep', 'level')} AS raw_level, {dbl('up', 'level')} AS property_level,
    CAST({number('ep', 'phase')} AS INT) AS event_phase,
    CAST({number('up', 'phase')} AS INT) AS property_phase,
    {at('up', 'mode')} AS property_mode, lower({at('ep', 'success')}) AS success,
    CAST({number('ep', 'start_count')} AS INT) AS attempt,
    CAST({number('ep', 'continue_times')} AS INT) AS continues,
    {dbl('ep', 'completion')} AS completion, {dbl('ep', 'use_booster_count')} AS used_boosters,
    {dbl('ep', 'value')} AS currency_value, {number('ep', 'value_game_currency')} AS game_currency_value,
    lower({at('ep', 'virtual_currency_name')}) AS currency_name,
    lower({at('ep', 'virtual_currency_type')}) AS currency_type,
    lower(ifnull({at('ep', 'ad_format')}, '')) AS ad_format,
    {dbl('ep', 'coin')} AS start_coin, {at('ep', 'currency')} AS purchase_currency,
    {level_of('ep', cfg.round_whole)} AS event_level,
    {level_of('up', cfg.round_whole)} AS property_bi_level
  FROM win
), normalized AS (
  SELECT * EXCLUDE (event_level), if({own}, property_bi_level, event_level) AS level,
    property_mode_fixed, if({own}, property_mode_fixed, mode_fixed) AS metric_mode
  FROM (SELECT *, CASE WHEN property_mode = 'classic' AND event_ts > first_clear_650_ts THEN 'sl'
                  ELSE property_mode END AS property_mode_fixed FROM typed)
), clean AS (
  SELECT * FROM normalized
  WHERE (country IS NULL OR NOT (country = '{cfg.excluded_country}'
         AND platform = '{cfg.excluded_platform}'))
    AND (event_name <> 'level_start_turn' OR ifnull(start_coin, 0) <= {cfg.balance_limit})
    AND (event_name <> 'in_app_purchase' OR ifnull(currency_value, 0) * (CASE purchase_currency
         WHEN 'USD' THEN 1.0 WHEN 'ILS' THEN 0.33 ELSE 0 END) < {cfg.purchase_limit})
    AND (event_name <> 'earn_virtual_currency' OR game_currency_value >= 0)
), dated AS (
  SELECT * FROM clean WHERE {report} AND {versions} AND variant IN {text_in(cfg.variants)}
), cohort AS (
  SELECT * FROM dated WHERE metric_mode = 'classic'
), metric AS (
  SELECT * FROM cohort WHERE {in_range} AND (event_name = 'paid_ad_impression' OR
    ifnull(if({own}, property_phase, event_phase), 1) <= 1)
), starters AS (
  SELECT DISTINCT variant, level, user_pseudo_id FROM cohort
  WHERE event_name = 'level_start' AND {start_range} AND ifnull(event_phase, 1) <= 1
), shown_starters AS (
  SELECT * FROM starters WHERE {in_range}
), removers AS (
  SELECT DISTINCT variant, property_bi_level AS level, user_pseudo_id FROM dated
  WHERE event_name = 'app_remove'
    AND (instr(property_level_text, '.') = 0 OR ifnull(property_phase, 1) <= 1)
), ads_base AS (
  SELECT variant, property_bi_level AS level, count(DISTINCT user_pseudo_id) AS users FROM dated
  WHERE event_name = 'level_start' AND property_mode_fixed = 'classic'
    AND {in_range.replace('level', 'property_bi_level') if cfg.level_min is not None else 'true'}
    AND {'ifnull(event_phase, 1) <= 1' if cfg.ads_phase_filter else 'true'}
  GROUP BY ALL
), windows AS (
  SELECT n, least(DATE '{cfg.report_end}', DATE '{cfg.as_of_date}' - (n + 1),
    DATE '{cfg.observation_end}' - n) AS eligible_end
  FROM (SELECT unnest([{horizons}]) AS n)
), mature AS (
  SELECT DISTINCT n, variant, level, user_pseudo_id, local_date
  FROM metric JOIN windows ON local_date <= eligible_end WHERE event_name = 'level_start'
), sessions AS (
  SELECT DISTINCT user_pseudo_id, local_date FROM clean
  WHERE event_name IN ('session_start', 'screen_view') AND {versions}
    AND local_date >= DATE '{cfg.report_start}' AND local_date <= DATE '{cfg.observation_end}'
    AND ifnull(property_phase, 1) <= 1
), day_levels AS (
  SELECT variant, user_pseudo_id, local_date, max(level) AS level FROM metric
  WHERE event_name = 'level_start' GROUP BY ALL
), non_return AS (
  SELECT n, variant, level, total_users, ifnull(users_churned, 0) AS users_churned,
    ifnull(users_churned, 0) * 100.0 / nullif(total_users, 0) AS rate
  FROM (SELECT n, variant, level, count(DISTINCT user_pseudo_id) AS total_users FROM mature
        GROUP BY ALL)
  LEFT JOIN (
    SELECT n, variant, level, count(DISTINCT user_pseudo_id) AS users_churned
    FROM day_levels p JOIN windows w ON p.local_date <= w.eligible_end
    WHERE NOT EXISTS (FROM sessions s WHERE s.user_pseudo_id = p.user_pseudo_id
      AND s.local_date > p.local_date AND s.local_date <= p.local_date + CAST(w.n AS INT))
    GROUP BY ALL) USING (n, variant, level)
)"""


def losses(cfg: ReportConfig) -> str:
    source = (
        "SELECT * FROM cohort WHERE level IS NOT NULL" if cfg.loss_keep_phase else "FROM metric"
    )
    shares = ",\n".join(
        f"""    count(DISTINCT user_pseudo_id) FILTER (bucket = {i}) * 100.0
      / nullif(count(DISTINCT user_pseudo_id), 0) AS "{name}\""""
        for i, name in enumerate(BUCKETS)
    )
    return f""", lost AS (
  SELECT *, CASE WHEN completion < 90 THEN CAST(greatest(floor(completion / 10), 0) AS INT) ELSE 9 END
    AS bucket
  FROM ({source}) WHERE event_name = 'level_end_turn' AND success = 'false' AND completion IS NOT NULL
), kinds AS (
  SELECT 'all' AS loss_kind, * FROM lost UNION ALL SELECT 'first', * FROM lost WHERE attempt = 1
), distribution AS (
  SELECT loss_kind, variant AS ab_group, level, count(DISTINCT user_pseudo_id) AS user_count,
    count(*) AS lose_count,
{shares}
  FROM kinds GROUP BY loss_kind, variant, level
)"""


def incomplete(cfg: ReportConfig) -> str:
    if cfg.loss_churn == "last_start":
        gone = f"""
    SELECT variant, last_level AS level, count(DISTINCT user_pseudo_id) AS users_churned
    FROM (SELECT variant, user_pseudo_id, max(local_date) AS last_day,
            arg_max(level, local_date) AS last_level FROM day_levels GROUP BY ALL) p
    WHERE last_day <= (SELECT eligible_end FROM windows WHERE n = 3)
      AND NOT EXISTS (FROM clean e WHERE e.event_name = 'level_end' AND e.level = p.last_level
        AND e.user_pseudo_id = p.user_pseudo_id AND e.app_version IN {text_in(cfg.versions)}
        AND e.local_date BETWEEN DATE '{cfg.report_start}' AND DATE '{cfg.report_end}')
      AND NOT EXISTS (FROM sessions s WHERE s.user_pseudo_id = p.user_pseudo_id
        AND s.local_date > p.last_day AND s.local_date <= DATE '{cfg.report_end}')
    GROUP BY ALL"""
    else:
        gone = """
    SELECT variant, level, count(DISTINCT user_pseudo_id) AS users_churned FROM day_levels p
    WHERE local_date <= (SELECT eligible_end FROM windows WHERE n = 3)
      AND NOT EXISTS (FROM metric e WHERE e.event_name = 'level_end' AND e.variant = p.variant
        AND e.level = p.level AND e.user_pseudo_id = p.user_pseudo_id)
      AND NOT EXISTS (FROM sessions s WHERE s.user_pseudo_id = p.user_pseudo_id
        AND s.local_date > p.local_date)
    GROUP BY ALL"""
    return f""", incomplete AS (
  SELECT variant, level, total_users, ifnull(users_churned, 0) AS users_churned,
    ifnull(users_churned, 0) * 100.0 / nullif(total_users, 0) AS rate
  FROM (SELECT variant, level, count(DISTINCT user_pseudo_id) AS total_users FROM mature
        WHERE n = 3 GROUP BY ALL)
  LEFT JOIN ({gone}) USING (variant, level)
)"""


LEVEL_STATS = """
  SELECT variant, level,
    count(DISTINCT user_pseudo_id) FILTER (event_name = 'level_end_turn' AND used_boosters > 0)
      AS booster_users,
    CAST(sum(if(event_name = 'spend_virtual_currency' AND currency_name = 'coin',
      game_currency_value, 0)) AS BIGINT) AS coin_spend,
    CAST(sum(if(event_name = 'spend_virtual_currency', game_currency_value, 0)) AS BIGINT)
      AS total_coin_spend,
    sum(if(event_name = 'spend_virtual_currency' AND currency_type = 'booster'
      AND currency_name <> '', currency_value, 0)) AS booster_count,
    count(*) FILTER (event_name = 'paid_ad_impression' AND (contains(ad_format, 'inter')
      OR contains(ad_format, 'reward') OR contains(ad_format, 'video'))) AS impressions,
    {none_as}(count(*) FILTER (event_name = 'paid_ad_impression' AND contains(ad_format, 'inter')), {zero})
      AS inter_impressions,
    {none_as}(count(*) FILTER (event_name = 'paid_ad_impression' AND NOT contains(ad_format, 'inter')
      AND (contains(ad_format, 'reward') OR contains(ad_format, 'video'))), {zero}) AS reward_impressions,
    avg(completion) FILTER (event_name = 'level_end' AND ifnull(continues, 0) = 0) AS avg_completion
  FROM metric GROUP BY ALL"""


def level_stats(cfg: ReportConfig) -> str:
    shape = dict(none_as="nullif", zero="0") if cfg.null_missing_ads else dict(none_as="ifnull", zero="0")
    return LEVEL_STATS.format(**shape)


DROPS = """
  SELECT variant, level, count(DISTINCT user_pseudo_id) FILTER (NOT EXISTS (
    FROM starters y WHERE y.variant = x.variant AND y.user_pseudo_id = x.user_pseudo_id
      AND y.level = x.level + 1)) AS dropped_users
  FROM shown_starters x GROUP BY ALL"""
PAYERS = """
  SELECT m.variant, m.level, count(DISTINCT m.user_pseudo_id) AS payers FROM metric m
  JOIN starters USING (variant, level, user_pseudo_id) WHERE event_name = 'in_app_purchase'
  GROUP BY ALL"""
APS = """
  SELECT variant, level, sum(attempt * users) * 1.0 / nullif(sum(users), 0) AS aps_avg FROM (
    SELECT variant, level, attempt, count(DISTINCT user_pseudo_id) AS users FROM metric
    WHERE event_name = 'level_end' AND success = 'true' AND attempt > 0 GROUP BY ALL) GROUP BY ALL"""
BALANCE_USERS = """
  SELECT variant, level, count(DISTINCT user_pseudo_id) AS users FROM metric
  WHERE event_name = 'level_start_turn' GROUP BY ALL"""
RESOURCES = """
  SELECT variant, level, user_pseudo_id, key AS k, json_extract_string(value, '$') AS v
  FROM (SELECT variant, level, user_pseudo_id, ep FROM metric
        WHERE event_name = 'level_start_turn' AND attempt = 1) t, json_each(t.ep)"""


def balance_sums(cfg: ReportConfig) -> str:
    return f"""
  SELECT variant, level, sum(if(k IN {text_in(cfg.balance_resources)}, amount, 0.0)) AS selected_balance,
    sum(amount) AS total_balance
  FROM (SELECT *, TRY_CAST(v AS DOUBLE) AS amount FROM ({RESOURCES}))
  WHERE amount >= 0 AND (k = 'coin' OR k = 'ticket' OR contains(k, 'booster'))
    AND k <> 'use_booster_count' GROUP BY variant, level"""


def levelplay(cfg: ReportConfig) -> str:
    viewers = "ads.users" if cfg.ads_denominator == "property" else "c.user_start_count"
    inter = f"s.inter_impressions * 1.0 / nullif({viewers}, 0) AS inter_imp_per_lau,"
    rewarded = f"s.reward_impressions * 1.0 / nullif({viewers}, 0)"
    n = "nullif(c.user_start_count, 0)"
    rates = "".join(f"d{h}.rate AS churn_rate_d{h}_pct, " for h in cfg.report_horizons)
    horizons = "\n".join(
        f"LEFT JOIN (FROM non_return WHERE n = {h}) d{h} USING (variant, level)"
        for h in cfg.report_horizons
    )
    return f"""{relations(cfg)}
SELECT c.variant AS ab_group, c.level, c.user_start_count,
  ifnull(d.dropped_users, 0) * 100.0 / {n} AS churn_rate_pct,
  {rates} ifnull(a.aps_avg, 0) AS aps_avg,
  ifnull(s.avg_completion, 0) AS completion_rate_first_attempt_pct,
  ifnull(s.coin_spend, 0) * 1.0 / {n} AS coin_spend_per_user,
  ifnull(s.total_coin_spend, 0) * 1.0 / {n} AS total_coin_spend_per_user,
  ifnull(b.selected_balance / nullif(bu.users, 0), 0) AS coin_balance_per_user,
  ifnull(b.total_balance / nullif(bu.users, 0), 0) AS total_coin_balance_per_user,
  ifnull(s.booster_count, 0) * 1.0 / {n} AS avg_booster_per_user,
  ifnull(s.booster_users, 0) * 100.0 / {n} AS booster_usage_rate_pct,
  ifnull(p.payers, 0) * 100.0 / {n} AS pay_rate_pct,
  ifnull(s.impressions * 1.0 / nullif({viewers}, 0), 0) AS imp_per_lau,
  {inter if cfg.interstitial_column else ''}
  {rewarded if cfg.null_missing_ads else f'ifnull({rewarded}, 0)'} AS rwd_per_lau
FROM (SELECT variant, level, count(DISTINCT user_pseudo_id) AS user_start_count FROM shown_starters
      GROUP BY ALL) c
LEFT JOIN ({DROPS}) d USING (variant, level)
LEFT JOIN ({level_stats(cfg)}) s USING (variant, level)
LEFT JOIN ({APS}) a USING (variant, level)
LEFT JOIN ({PAYERS}) p USING (variant, level)
LEFT JOIN ads_base ads USING (variant, level)
LEFT JOIN ({BALANCE_USERS}) bu USING (variant, level)
LEFT JOIN ({balance_sums(cfg)}) b USING (variant, level)
{horizons}"""


def loss_report(cfg: ReportConfig, kind: str | None) -> str:
    churned = "i.users_churned" if cfg.null_missing_loss_churn else "ifnull(i.users_churned, 0)"
    buckets = ", ".join(f'"{name}"' for name in BUCKETS)
    return f"""{relations(cfg)}{losses(cfg)}{incomplete(cfg)}
SELECT {'loss_kind, ' if kind is None else ''}ab_group, l.level, user_count, lose_count,
  {churned} AS churn_users_d3, i.rate AS churn_rate_d3_pct, {buckets}
FROM distribution l LEFT JOIN incomplete i ON i.variant = l.ab_group AND i.level = l.level
{'' if kind is None else f"WHERE loss_kind = '{kind}'"}"""


TYPED_COLUMNS = """event_name, user_pseudo_id, variant, raw_level, property_level, event_phase,
  property_phase, property_mode, success, attempt, continues, completion, used_boosters,
  currency_value, game_currency_value, currency_name, currency_type, ad_format, start_coin,
  purchase_currency"""


def statements() -> dict[str, str]:
    a, c = RANGE, ALL_LEVELS

    def on(cfg: ReportConfig, body: str) -> str:
        return f"WITH {relations(cfg)}\n{body}"

    def stage1(body: str) -> str:
        return f"WITH {CORRECTED}\n{body}"

    def non_return(n: int) -> str:
        return on(a, f"SELECT variant, level, total_users, users_churned, rate FROM non_return WHERE n = {n}")

    lo, hi = c.window_utc()
    bad_mode = """count(*) FILTER (mode_fixed IS DISTINCT FROM 'sl' AND event_ts > first_clear_650_ts
      AND mode_original = 'classic') AS inconsistent_mode"""
    return {
        # stage 1
        "mode_cutoffs": stage1("SELECT * FROM cutoffs"),
        "mode_correction": stage1(
            "SELECT event_id, user_pseudo_id, event_name, event_ts, mode_original, mode_fixed, "
            "is_mode_fixed, first_clear_650_ts, fix_reason, analysis_date_utc7, ab_group FROM corrected"
        ),
        "mode_correction_increments": stage1(
            "SELECT event_id, user_pseudo_id, event_name, event_ts, mode_original, mode_fixed, "
            "is_mode_fixed, first_clear_650_ts, fix_reason, analysis_date_utc7, ab_group FROM corrected"
        ),
        "mode_correction_shuffled": stage1(
            "SELECT event_id, user_pseudo_id, event_name, event_ts, mode_fixed, first_clear_650_ts "
            "FROM corrected"
        ),
        "fix_reason_counts": stage1(
            "SELECT fix_reason, analysis_date_utc7, count(*) AS events, "
            "count(DISTINCT user_pseudo_id) AS users FROM corrected GROUP BY ALL"
        ),
        **{
            f"raw_from_{fmt}": f"WITH {RAW}\nSELECT event_id, user_pseudo_id, event_name, "
            "event_params, user_properties, country FROM raw"
            for fmt in ("csv", "json", "orc")
        },
        **{
            name: stage1("SELECT * FROM cutoffs")
            for name in (
                "cutoffs_of_text_time", "cutoffs_of_maps", "cutoffs_of_structs",
                "cutoffs_of_unified_text", "cutoffs_of_variants", "cutoff_table",
            )
        },
        "corrected_union_by_name": stage1(
            "SELECT event_id, event_name, if(event_id % 2 = 1, country, NULL) AS country FROM corrected"
        ),
        "levelplay_report_csv": "WITH " + levelplay(c),
        "both_reports": f"""SELECT 'level' AS report, ab_group, level, user_start_count AS users,
  churn_rate_d3_pct AS rate FROM (WITH {levelplay(c)})
UNION ALL SELECT loss_kind, ab_group, level, user_count, churn_rate_d3_pct
FROM (WITH {loss_report(c, None)})""",
        "window_other_offset": f"""WITH {CORRECTED}
SELECT event_id, event_ts FROM corrected
WHERE event_ts >= TIMESTAMP '{UTC_REPORT.window_utc()[0]}'
  AND event_ts < TIMESTAMP '{UTC_REPORT.window_utc()[1]}'""",
        "window_far_offset": f"""WITH {RAW}
SELECT event_id, event_ts FROM raw
WHERE app_id = '{CORRECTION.app_id}'
  AND event_ts >= TIMESTAMP '{max(FAR_EAST.utc_bounds()[0], FAR_WEST_REPORT.window_utc()[0])}'
  AND event_ts < TIMESTAMP '{min(FAR_EAST.utc_bounds()[1], FAR_WEST_REPORT.window_utc()[1])}'""",
        # normalisation and filters
        "parse_fields_cut": on(a, f"SELECT {TYPED_COLUMNS} FROM typed"),
        "parse_fields": on(c, f"SELECT {TYPED_COLUMNS} FROM typed"),
        "level_normalize": on(
            c,
            "SELECT event_name, raw_level, event_phase, property_level, property_phase, "
            "property_bi_level, level, count(*) AS events FROM normalized GROUP BY ALL",
        ),
        "source_level_mode": on(
            a,
            "SELECT event_name, local_date, level, property_mode_fixed, metric_mode, count(*) AS events "
            "FROM normalized GROUP BY ALL",
        ),
        "system_filters": on(
            c,
            "SELECT event_name, local_date, count(*) AS events, count(DISTINCT user_pseudo_id) AS users "
            "FROM clean GROUP BY ALL",
        ),
        "cohort_filter": on(
            a,
            "SELECT variant, event_name, local_date, count(*) AS events, "
            "count(DISTINCT user_pseudo_id) AS users FROM cohort GROUP BY ALL",
        ),
        "metric_filter": on(
            a,
            "SELECT variant, level, event_name, count(*) AS events, "
            "count(DISTINCT user_pseudo_id) AS users FROM metric GROUP BY ALL",
        ),
        # funnel
        "level_starters": on(a, "SELECT * FROM starters"),
        "start_counts": on(
            a,
            "SELECT variant, level, count(DISTINCT user_pseudo_id) AS user_start_count "
            "FROM shown_starters GROUP BY ALL",
        ),
        "next_level_drop": on(a, DROPS),
        "remove_counts": on(
            a,
            "SELECT variant, level, count(DISTINCT user_pseudo_id) AS user_remove_count "
            "FROM shown_starters JOIN removers USING (variant, level, user_pseudo_id) GROUP BY ALL",
        ),
        "churn_components": on(
            a,
            f"""SELECT variant, level, count(DISTINCT s.user_pseudo_id) AS user_start_count,
  ifnull(any_value(dropped_users), 0) AS user_dropped_count,
  count(DISTINCT r.user_pseudo_id) AS user_remove_count
FROM shown_starters s LEFT JOIN ({DROPS}) USING (variant, level)
LEFT JOIN removers r USING (variant, level, user_pseudo_id) GROUP BY variant, level""",
        ),
        "ads_denominator_property": on(a, "SELECT * FROM ads_base"),
        "ads_denominator_phase": on(c, "SELECT * FROM ads_base"),
        # economy
        "level_stats": on(a, level_stats(a)),
        "ad_formats": on(
            c,
            """SELECT ad_format, contains(ad_format, 'inter') AS interstitial,
  NOT contains(ad_format, 'inter') AND (contains(ad_format, 'reward') OR contains(ad_format, 'video'))
    AS rewarded, count(*) AS impressions, count(DISTINCT user_pseudo_id) AS users
FROM metric WHERE event_name = 'paid_ad_impression' GROUP BY ALL""",
        ),
        "payers": on(a, PAYERS),
        "attempts_per_success": on(a, APS),
        "balance_starters": on(a, BALANCE_USERS),
        "resource_unpivot": on(a, RESOURCES),
        "balance_sums": on(a, balance_sums(a)),
        # retention
        "maturity_windows": stage1(
            f"""SELECT n, DATE '{a.report_start}' AS report_start, least(DATE '{a.report_end}',
  DATE '{a.as_of_date}' - (n + 1), last_day - n) AS eligible_end
FROM (SELECT max(analysis_date_utc7) AS last_day FROM corrected),
  (SELECT unnest([{', '.join(map(str, a.day_horizons))}]) AS n)"""
        ),
        "mature_cohort": on(a, "SELECT * FROM mature"),
        "daily_sessions": on(a, "SELECT * FROM sessions"),
        "last_level_per_day": on(a, "SELECT * FROM day_levels"),
        "non_return_d3": non_return(3),
        "non_return_d7": non_return(7),
        "non_return_censored": non_return(14),
        "non_return_d14": on(
            EARLY, "SELECT variant, level, total_users, users_churned, rate FROM non_return WHERE n = 14"
        ),
        "play_days": on(
            a,
            """SELECT *, (SELECT min(s.local_date) FROM sessions s WHERE s.local_date > p.local_date
    AND s.user_pseudo_id = p.user_pseudo_id) AS next_session
FROM day_levels p WHERE user_pseudo_id IS NOT NULL""",
        ),
        "latest_start": on(
            a,
            "SELECT variant, user_pseudo_id, max(local_date) AS local_date, arg_max(level, local_date) "
            "AS level FROM day_levels WHERE user_pseudo_id IS NOT NULL GROUP BY ALL",
        ),
        "incomplete_churn_last_start": on(a, "").rstrip() + incomplete(a) + "\nSELECT * FROM incomplete",
        "incomplete_churn_every_day": on(c, "").rstrip() + incomplete(c) + "\nSELECT * FROM incomplete",
        # losses
        "loss_first": on(a, "").rstrip() + losses(a)
        + "\nSELECT variant, level, bucket, count(*) AS events, count(DISTINCT user_pseudo_id) AS users "
        "FROM lost WHERE attempt = 1 GROUP BY ALL",
        "loss_all": on(c, "").rstrip() + losses(c)
        + "\nSELECT loss_kind, variant, level, bucket, count(*) AS events, "
        "count(DISTINCT user_pseudo_id) AS users FROM kinds GROUP BY ALL",
        "loss_distribution": on(c, "").rstrip() + losses(c) + "\nSELECT * FROM distribution",
        # reports
        "loss_report_first": "WITH " + loss_report(a, "first"),
        "loss_report_all": "WITH " + loss_report(a, "all"),
        "loss_report_all_levels": "WITH " + loss_report(c, None),
        "levelplay_report_range": "WITH " + levelplay(a),
        "levelplay_report_all_levels": "WITH " + levelplay(c),
        "levelplay_report_of_variants": "WITH " + levelplay(c),
        "levelplay_report_from_facts": "WITH " + levelplay(c),
        "levelplay_range_from_facts": "WITH " + levelplay(a),
        "loss_report_from_facts": "WITH " + loss_report(c, None),
        "loss_report_first_from_facts": "WITH " + loss_report(a, "first"),
        "levelplay_report_other_horizons": "WITH " + levelplay(OTHER_HORIZONS),
        "levelplay_report_event_base": "WITH " + levelplay(c.with_(ads_denominator="event")),
        # audits
        "qa_timestamps": f"WITH {RAW}\nSELECT count(*) AS rows, "
        "count(*) FILTER (event_ts IS NULL) AS invalid_timestamps FROM raw WHERE app_id = 'app_main'",
        "qa_text_timestamps": f"""WITH {RAW}
SELECT count(*) AS rows, count(*) FILTER (event_id % 71 = 0) AS invalid_timestamps
FROM raw WHERE app_id = 'app_main'""",
        "qa_coverage": stage1(
            "SELECT min(analysis_date_utc7) AS min_date, max(analysis_date_utc7) AS observation_end "
            "FROM corrected"
        ),
        "qa_mode_consistency": stage1(f"SELECT {bad_mode} FROM corrected"),
        "qa_kept_modes": stage1(
            """SELECT count(*) AS inconsistent_mode FROM corrected
WHERE minute(event_ts) >= 30 AND event_ts > first_clear_650_ts AND mode_original = 'classic'"""
        ),
        "qa_missing_cutoff": on(
            a,
            f"""SELECT event_name, count(*) AS classic_events_with_missing_clear650,
  count(DISTINCT user_pseudo_id) AS affected_users FROM cohort
WHERE property_level > {MILESTONE} AND first_clear_650_ts IS NULL GROUP BY ALL""",
        ),
        "input_profile": on(
            c,
            f"""SELECT count(*) AS rows, count(*) FILTER (event_ts IS NULL) AS invalid_timestamps,
  min(analysis_date_utc7) AS min_date, max(analysis_date_utc7) AS max_date, {bad_mode},
  '{lo}' AS utc_start, '{hi}' AS utc_end_exclusive FROM win""",
        ),
    }

"""Shared tables of the comparison SQL (DuckDB dialect), in dependency order."""

from clickloom.plans.sample_events import CUT_DAY, RAW_ONCE_SQL

_HOST = "lower(nullif(regexp_extract(coalesce(referrer, ''), 'https?://([^/]+)', 1), ''))"


def _utm(name: str) -> str:
    return f"lower(nullif(regexp_extract(page_url, '[?&]utm_{name}=([^&]+)', 1), '')) AS utm_{name}"


def json_text(key: str, column: str = "event_data") -> str:
    return f"CASE WHEN json_valid({column}) THEN json_extract_string({column}, '$.{key}') END"


def json_number(key: str) -> str:
    return f"TRY_CAST({json_text(key)} AS DOUBLE)"


def first_nonzero(*keys: str) -> str:
    return "coalesce(" + ", ".join(f"nullif({json_number(k)}, 0)" for k in keys) + ")"


_STAGED = f"""
  "timestamp" AS event_ts, event_name, page_url, referrer, {_HOST} AS referrer_host,
  {json_text("transaction_id")} AS transaction_id,
  {_utm("source")}, {_utm("medium")}, {_utm("campaign")}, event_date, event_id AS event_key
"""

CHANNEL_A = """
  CASE WHEN utm_medium IN ('cpc', 'ppc', 'paidsearch', 'paid_search', 'paid') THEN 'Paid Search'
    WHEN utm_medium IN ('social', 'social-paid', 'paidsocial') THEN 'Paid Social'
    WHEN utm_medium IN ('email', 'klaviyo') THEN 'Email'
    WHEN utm_medium IN ('display', 'banner') THEN 'Display'
    WHEN utm_medium = 'affiliate' THEN 'Affiliate'
    WHEN regexp_matches(referrer_host, 'google|bing') THEN 'Organic Search'
    WHEN regexp_matches(referrer_host, 'facebook|t[.]co|instagram') THEN 'Organic Social'
    WHEN coalesce(referrer_host, '') = '' THEN 'Direct' ELSE 'Referral' END
"""

CHANNEL_B = """
  CASE WHEN regexp_matches(lower(page_url), 'utm_medium=(cpc|paid)') THEN 'Paid Search'
    WHEN regexp_matches(lower(page_url), 'utm_source=(facebook|instagram)') THEN 'Paid Social'
    WHEN contains(lower(page_url), 'utm_medium=email') THEN 'Email'
    WHEN contains(lower(referrer), 'google.') THEN 'Organic Search'
    WHEN regexp_matches(lower(referrer), 'facebook[.]|t[.]co') THEN 'Organic Social'
    WHEN lower(coalesce(referrer, '')) IN ('', 'nan') THEN 'Direct' ELSE 'Referral' END
"""


def numbered(source: str, late: str) -> str:
    """Events with predecessor, flag and running session number, by plain windows."""
    return f"""
      SELECT *, CAST(sum(opens) OVER (PARTITION BY user_id ORDER BY event_ts, event_key
                                      ROWS UNBOUNDED PRECEDING) AS BIGINT) AS session_seq
      FROM (SELECT *, CASE WHEN prev_ts IS NULL OR {late} THEN 1 ELSE 0 END AS opens
            FROM (SELECT *, lag(event_ts) OVER (PARTITION BY user_id ORDER BY event_ts, event_key) AS prev_ts
                  FROM {source}))
    """


def facts(source: str, sep: str, counted: str) -> str:
    return f"""
      SELECT user_id || '{sep}' || CAST(session_seq AS VARCHAR) AS session_id, user_id, session_seq,
        min(event_ts) AS session_start_ts, max(event_ts) AS session_end_ts, count({counted}) AS events,
        first(derived_channel ORDER BY event_ts, event_key) AS session_first_channel,
        last(derived_channel ORDER BY event_ts, event_key) AS session_last_channel,
        first(utm_campaign ORDER BY event_ts, event_key) AS session_campaign
      FROM {source} GROUP BY user_id, session_seq
    """


def credited(conversions: str, sessions: str, upper: str, last: str, fallback: str) -> str:
    """Attribution by joining every session in the window; fine for a small comparison."""
    return f"""
      SELECT c.transaction_id, c.user_id, c.revenue, c.conversion_ts AS conversion_time,
        coalesce(arg_min(s.session_first_channel, s.session_start_ts), '{fallback}') AS first_click_channel,
        coalesce(arg_max(s.{last}, s.session_start_ts), '{fallback}') AS last_click_channel,
        min(s.session_start_ts) AS first_start, max(s.session_start_ts) AS last_start, count(s.session_id) AS touches
      FROM {conversions} c LEFT JOIN {sessions} s
        ON s.user_id = c.user_id AND s.session_start_ts >= c.conversion_ts - INTERVAL 7 DAY
       AND s.session_start_ts {upper} c.conversion_ts
      GROUP BY ALL
    """


BUYS = "event_name IN ('purchase', 'checkout_completed')"

COMMON_TABLES = {
    "base": "SELECT *, CAST(ts AS DATE) AS d, 'u' || CAST(user_id AS VARCHAR) AS u FROM events",
    "once": RAW_ONCE_SQL,
    "raw": "SELECT * FROM once UNION ALL SELECT * FROM once WHERE event_id % 97 = 0",
    "mended": f"""
      SELECT * REPLACE (CASE WHEN event_data LIKE '{{"order_id"%' AND NOT event_data LIKE '%}}' AND event_date <> DATE '{CUT_DAY}'
        THEN event_data || '}}' ELSE event_data END AS event_data) FROM raw""",
    "staged": f"""
      SELECT coalesce(cid_old, cid_new) AS user_id, {json_number("value")} AS revenue, {_STAGED}
      FROM raw WHERE coalesce(cid_old, cid_new) IS NOT NULL""",
    "staged_b": f"""
      SELECT coalesce(cid_old, cid_new) AS user_id, coalesce({first_nonzero("value", "revenue")}, 0) AS revenue, {_STAGED}
      FROM (SELECT DISTINCT * FROM raw) WHERE coalesce(cid_old, cid_new) IS NOT NULL""",
    "chan": f"SELECT *, {CHANNEL_A} AS derived_channel FROM staged",
    "chan_b": f"SELECT *, {CHANNEL_B} AS derived_channel FROM staged_b",
    "numbered": numbered("chan", "event_ts - prev_ts >= INTERVAL 30 MINUTE"),
    "numbered_b": numbered("chan_b", "event_ts - prev_ts > INTERVAL 30 MINUTE"),
    "ses": facts("numbered", "-S", "*"),
    "ses_b": facts("numbered_b", "_S", "event_name"),
    "conv": f"""
      SELECT transaction_id, user_id, max(event_ts) AS conversion_ts, max(revenue) AS revenue
      FROM staged WHERE {BUYS} AND transaction_id IS NOT NULL GROUP BY transaction_id, user_id""",
    "conv_b": f"""
      SELECT transaction_id, user_id, event_ts AS conversion_ts, revenue
      FROM staged_b WHERE {BUYS} AND revenue > 0
      QUALIFY row_number() OVER (PARTITION BY transaction_id ORDER BY event_ts, event_key) = 1""",
    "gold": credited("conv", "ses", "<=", "session_last_channel", "Direct"),
    "gold_b": credited("conv_b", "ses_b", "<", "session_first_channel", "Unattributed"),
}

"""SQL twins of the queries, for DuckDB on the same tables."""

from __future__ import annotations

from shelfmark.checks.adapters import EVENT_STORES, HTML_PARTS, TODAY, YESTERDAY
from shelfmark.operators.quality import MART_NOT_NULL, SOLD_NOT_NULL, STAGING_NOT_NULL
from shelfmark.stores import HTML_ATTRIBUTES


def body_html(n: str) -> str:
    """Listing HTML for a number."""
    lists = ["[" + ", ".join(f"'{t}'" for t in texts) + "]" for texts in HTML_PARTS]
    return " || ".join(f"list_extract({t}, {n} % {len(texts)} + 1)" for t, texts in zip(lists, HTML_PARTS))


_K = "CAST(json_extract_string(props, '$.k') AS INTEGER)"

LISTINGS = f"""listings AS (
  SELECT event_id, user_id AS id,
    CASE WHEN k % 17 <> 0 THEN 'Item ' || user_id || ' Chloé' END AS title,
    event_type || '-' || user_id AS handle,
    {body_html('(user_id + k)')} AS body_html,
    CASE WHEN k % 23 <> 0 THEN 'Brand#' || (user_id % 30) END AS vendor,
    'Type ' || (user_id % 6) AS product_type,
    strftime(CAST(ts AS DATE) - k, '%Y-%m-%d') || 'T23:30:00-05:00' AS published_at,
    strftime(ts, '%Y-%m-%dT%H:%M:%S.%f') || '+00:00' AS updated_at,
    CASE WHEN k % 50 = 0 THEN NULL ELSE CAST(CAST(value AS DECIMAL(12,3)) AS VARCHAR) END AS first_price,
    event_type AS store,
    strftime(ts, '%Y-%m-%d') AS ingestion_date
  FROM (SELECT *, {_K} AS k FROM events)
)"""

_URL = "CASE store " + " ".join(f"WHEN '{s.name}' THEN '{s.url_base}' || handle" for s in EVENT_STORES) + " END"


def _attribute(pattern: str, group: int) -> str:
    return f"nullif(regexp_extract(body_html, '{pattern}', {group}), '')"


ATTRIBUTES = ", ".join(f"{_attribute(p, g)} AS {name}" for name, (p, g) in HTML_ATTRIBUTES.items())


def _age(as_of: str) -> str:
    return f"CAST(date_diff('day', CAST(substr(published_at, 1, 10) AS DATE), DATE '{as_of}') AS INTEGER)"


def staged(as_of: str = TODAY, source: str = "listings") -> str:
    """Enriched rows of all shops; attributes only for the shop that has them."""
    own = [s.name for s in EVENT_STORES if s.attributes][0]
    attributes = ", ".join(
        f"CASE WHEN store = '{own}' THEN {_attribute(p, g)} END AS {name}" for name, (p, g) in HTML_ATTRIBUTES.items()
    )
    return (
        f"staged AS (SELECT *, CAST(first_price AS DECIMAL(10,2)) AS price, {_URL} AS url, "
        f"{_age(as_of)} AS days_on_market, {attributes} FROM {source})"
    )


def latest(source: str, keys: str, name: str = "latest") -> str:
    return (
        f"{name} AS (SELECT * FROM {source} QUALIFY row_number() OVER "
        f"(PARTITION BY {keys} ORDER BY updated_at DESC, ingestion_date DESC, event_id DESC) = 1)"
    )


SOLD = """sold AS (
  SELECT l_orderkey * 10 + l_linenumber AS id, l_linestatus AS store, p_brand AS vendor, p_name AS title,
    p_type AS product_type,
    CASE WHEN l_quantity <> 13 THEN split_part(p_name, ' ', 1) END AS exterior_color,
    CASE WHEN l_quantity <> 7 THEN l_returnflag END AS condition,
    CAST(l_extendedprice AS DECIMAL(10,2)) AS price,
    CAST(date_diff('day', CAST(o_orderdate AS DATE), CAST(l_shipdate AS DATE)) AS INTEGER) AS days_on_market,
    strftime(l_shipdate, '%Y-%m-%d') AS sold_date
  FROM lineitem LEFT JOIN part ON l_partkey = p_partkey LEFT JOIN orders ON l_orderkey = o_orderkey
)"""

# Reports work on whole prices and dates.
REPORT = SOLD + """, report AS (
  SELECT vendor, title, product_type, exterior_color, condition, CAST(trunc(price) AS INTEGER) AS price,
    days_on_market, CAST(sold_date AS DATE) AS sold_date
  FROM sold
)"""

WEEKDAY_SPINE = """(VALUES (1, 'Monday'), (2, 'Tuesday'), (3, 'Wednesday'), (4, 'Thursday'), (5, 'Friday'),
  (6, 'Saturday'), (7, 'Sunday')) AS spine(ord, day_of_week)"""


def with_(*ctes: str, select: str) -> str:
    return "WITH " + ", ".join(ctes) + " " + select


def not_null(source: str, model: str, columns) -> str:
    return " UNION ALL ".join(
        f"SELECT '{model}' AS model, 'not_null' AS \"check\", '{c}' AS \"column\", "
        f"count(*) FILTER (WHERE {c} IS NULL) AS failures FROM {source}"
        for c in columns
    )


def box(column: str, source: str = "report") -> str:
    return (
        f"box AS (SELECT min({column}) AS least, quantile_cont({column}, 0.25) AS q1, "
        f"quantile_cont({column}, 0.5) AS median, quantile_cont({column}, 0.75) AS q3 FROM {source})"
    )


def box_select(prefix: str = "") -> str:
    return (
        "SELECT CAST(CASE WHEN q1 - 1.5 * (q3 - q1) < 0 THEN least ELSE q1 - 1.5 * (q3 - q1) END AS DOUBLE) AS box_min, "
        "q1, median, q3, q3 + 1.5 * (q3 - q1) AS box_max, q3 - q1 AS iqr, q1 - 1.5 * (q3 - q1) AS lower_fence FROM box"
    )


def diff(today: str = TODAY, yesterday: str = YESTERDAY) -> tuple[str, ...]:
    """Yesterday's latest row per listing, absent today (CTE ``gone``)."""
    return (
        LISTINGS,
        f"y AS (SELECT * FROM listings WHERE ingestion_date = '{yesterday}')",
        latest("y", "store, id", "yl"),
        f"t AS (SELECT store, id FROM listings WHERE ingestion_date = '{today}')",
        f"gone AS (SELECT yl.*, '{today}' AS sold_date FROM yl LEFT JOIN (SELECT DISTINCT * FROM t) t "
        "ON yl.store = t.store AND yl.id = t.id WHERE t.id IS NULL)",
    )


STAGING_COLUMNS, SOLD_CHECKS, MART_CHECKS = STAGING_NOT_NULL, SOLD_NOT_NULL, MART_NOT_NULL

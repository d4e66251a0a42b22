"""SQL of the general problems that needs more than a line: instants, counted amounts, points and regions.

These state the results in DuckDB's own terms (its date formats, its zones, plain joins of all points with all places), not
the operators' way to get them.
"""

from __future__ import annotations


def identifier(c: str) -> str:
    return f"nullif(lower(regexp_replace({c}, '[^\\p{{L}}\\p{{N}}]', '', 'g')), '')"


READABLE = "[ \\t]*[+-]?[0-9]{1,16}(\\.[0-9]{1,2})?[ \\t]*"
_DAY = "['%Y-%m-%d', '%Y/%m/%d', '%d/%m/%Y', '%d.%m.%Y', '%d %b %Y', '%d-%b-%Y', '%b %d, %Y']"
_CLOCK = "['%H:%M:%S', '%H:%M:%S.%f', '%H:%M', '%H%M%S', '%I:%M:%S %p']"
_LOCAL = "Africa/Johannesburg"


def _day(s: str) -> str:
    """The date of a text that is only a date."""
    return f"CAST(CASE WHEN regexp_full_match({s}, '[0-9]{{8}}') THEN try_strptime({s}, '%Y%m%d') WHEN regexp_matches({s}, '^[0-9]{{1,4}}[-/.][0-9]{{1,2}}[-/.][0-9]{{1,4}}$|[A-Za-z]') THEN try_strptime({s}, {_DAY}) END AS DATE)"


def _clock(s: str) -> str:
    """The time of day of a text without a zone, as an interval."""
    at = f"try_strptime({s}, {_CLOCK})"
    return f"({at} - date_trunc('day', {at}))"


def instants(rows: str) -> str:
    """CTEs that end in ``i(src, row_id, col, d, t, moment, day)``: UTC instant and local date of ``rows(src, row_id, col, d, t)``."""
    return f"""r AS ({rows}),
w AS (SELECT src, row_id, col, d, t, trim(d) AS s, nullif(trim(coalesce(t, '')), '') AS c FROM r WHERE d IS NOT NULL),
x AS (SELECT *, {_day('s')} AS plain, regexp_extract(s, '^([0-9]{{4}}-[0-9]{{2}}-[0-9]{{2}}|[0-9]{{8}})[T ](.+)$', ['a', 'b']) AS j FROM w),
y AS (SELECT *, coalesce(plain, CASE WHEN j.a <> '' THEN {_day('j.a')} END) AS day0, CASE WHEN plain IS NULL THEN nullif(j.b, '') ELSE c END AS clock FROM x),
z AS (SELECT *, coalesce(nullif(regexp_extract(clock, '^.*[0-9A-Za-z] +([A-Z][A-Za-z_]+/[A-Za-z_]+)$', 1), ''), '{_LOCAL}') AS zone, regexp_extract(clock, '^.*[0-9](Z|[+-][0-9]{{2}}:?[0-9]{{2}})$', 1) AS shift,
  regexp_replace(regexp_replace(clock, ' +[A-Z][A-Za-z_]+/[A-Za-z_]+$', ''), '([0-9]) ?(Z|[+-][0-9]{{2}}:?[0-9]{{2}})$', '\\1') AS bare FROM y),
l AS (SELECT *, CAST(day0 AS TIMESTAMP) + CASE WHEN clock IS NULL THEN INTERVAL 0 SECOND ELSE {_clock('bare')} END AS wall FROM z),
o AS (SELECT *, CASE WHEN shift NOT IN ('', 'Z') THEN (CASE WHEN shift[1] = '-' THEN -1 ELSE 1 END) * (TRY_CAST(shift[2:3] AS INT) * 60 + TRY_CAST(right(shift, 2) AS INT)) ELSE 0 END AS minutes,
  CASE WHEN zone IN (SELECT name FROM pg_timezone_names()) THEN wall AT TIME ZONE zone END AS there FROM l),
i AS (SELECT *, CASE WHEN regexp_full_match(s, '[0-9]{{10}}|[0-9]{{13}}|[0-9]{{16}}') THEN make_timestamp(TRY_CAST(rpad(s, 16, '0') AS BIGINT))
  WHEN shift <> '' THEN wall - to_minutes(minutes)
  WHEN (there - INTERVAL 1 HOUR) AT TIME ZONE zone = wall THEN (there - INTERVAL 1 HOUR) AT TIME ZONE 'UTC' ELSE there AT TIME ZONE 'UTC' END AS moment FROM o),
n AS (SELECT *, CAST((moment AT TIME ZONE 'UTC') AT TIME ZONE '{_LOCAL}' AS DATE) AS day FROM i)"""


_STAMPS = "SELECT 'transactions' AS src, row_id, 'transaction_ts' AS col, transaction_date AS d, transaction_time AS t FROM transactions"
_DATES = " UNION ALL ".join(f"SELECT 'accounts', row_id, '{c}', {c}, NULL FROM accounts" for c in ("open_date", "last_activity_date"))

P7 = f"""WITH {instants(f'{_STAMPS} UNION ALL {_DATES}')}
SELECT src AS src_table, row_id, col AS col_name, CASE WHEN src = 'accounts' THEN strftime(day, '%Y-%m-%d') ELSE strftime(moment, '%Y-%m-%dT%H:%M:%S.%fZ') END AS norm_text
FROM n WHERE moment IS NOT NULL AND NOT (regexp_full_match(d, '[0-9]{{4}}-[0-9]{{2}}-[0-9]{{2}}') AND (src = 'accounts' OR regexp_full_match(coalesce(t, ''), '[0-9]{{2}}:[0-9]{{2}}:[0-9]{{2}}')))"""

_COUNTED = f"""{instants(_STAMPS)},
q AS (SELECT t.row_id, {identifier('t.account_id')} AS k, CASE WHEN regexp_full_match(t.amount, '{READABLE}') THEN CAST(trim(translate(t.amount, chr(9), ' ')) AS DECIMAL(18,2)) END AS amount,
  CASE WHEN {identifier('t.transaction_id')} IS NULL THEN 1 ELSE row_number() OVER (PARTITION BY {identifier('t.transaction_id')} ORDER BY ingested_at, t.row_id) END AS nth FROM transactions t),
known AS (SELECT {identifier('account_id')} AS k, min(account_id) AS account_id FROM accounts WHERE {identifier('account_id')} IS NOT NULL GROUP BY 1),
daily AS (SELECT known.account_id, n.day, sum(q.amount) AS total, count(*) AS n FROM q JOIN n USING (row_id) JOIN known USING (k) WHERE q.nth = 1 AND q.amount IS NOT NULL AND n.moment IS NOT NULL GROUP BY 1, 2),
spans AS (SELECT account_id, min(day) AS a, max(day) AS b FROM daily GROUP BY 1),
dense AS (SELECT account_id, a, CAST(unnest(generate_series(a, b, INTERVAL 1 DAY)) AS DATE) AS day FROM spans),
sums AS (SELECT account_id, a, day, sum(coalesce(total, 0)) OVER (w ROWS 6 PRECEDING) AS t7, sum(coalesce(total, 0)) OVER (w ROWS 29 PRECEDING) AS t30, sum(coalesce(n, 0)) OVER (w ROWS 6 PRECEDING) AS n7
  FROM dense LEFT JOIN daily USING (account_id, day) WINDOW w AS (PARTITION BY account_id ORDER BY day))"""

P2 = f"""WITH {_COUNTED}
SELECT account_id, strftime(day, '%Y-%m-%d') AS on_day, CASE WHEN n7 = 0 THEN 'lull' ELSE 'surge' END AS pattern FROM sums
WHERE day >= a + 29 AND ((t7 >= 25000 AND t7 >= t30 * 0.7) OR (n7 = 0 AND t30 >= 25000))"""

P2_TOTALS = f"""WITH {_COUNTED}
SELECT account_id, strftime(day, '%Y-%m-%d') AS on_day, CAST(t7 AS DECIMAL(38,2)) AS total_7, CAST(t7 AS DOUBLE) / 7 AS mean_7, CAST(t30 AS DECIMAL(38,2)) AS total_30, CAST(t30 AS DOUBLE) / 30 AS mean_30 FROM sums"""

_NUMBER = "[+-]?[0-9]+(?:\\.[0-9]+)?"
_DMS = "([0-9]+)°([0-9]+)''([0-9.]+)\"([NSEW])"


def _side(p: str) -> str:
    """``{v, h}``: signed degrees and hemisphere letter of one of two numbers; null if it is badly formed."""
    dms = f"regexp_extract({p}, '{_DMS}', ['d', 'm', 's', 'h'])"
    one = f"regexp_extract({p}, '^([NSEW]?)([0-9]+(?:\\.[0-9]+)?)([NSEW]?)$', ['x', 'v', 'y'])"
    sign = "CASE WHEN {0} IN ('S', 'W') THEN -1 ELSE 1 END"
    return f"""CASE WHEN regexp_full_match({p}, '{_DMS}') THEN {{'v': ({sign.format(f'{dms}.h')}) * (TRY_CAST({dms}.d AS DOUBLE) + TRY_CAST({dms}.m AS DOUBLE) / 60 + TRY_CAST({dms}.s AS DOUBLE) / 3600), 'h': {dms}.h}}
  WHEN regexp_full_match({p}, '[NSEW]?[0-9]+(?:\\.[0-9]+)?[NSEW]?') THEN {{'v': ({sign.format(f'({one}.x || {one}.y)')}) * TRY_CAST({one}.v AS DOUBLE), 'h': {one}.x || {one}.y}}
  WHEN regexp_full_match({p}, '{_NUMBER}') THEN {{'v': TRY_CAST({p} AS DOUBLE), 'h': ''}} END"""


P1 = f"""WITH raw AS (SELECT row_id, nullif(lower(regexp_replace(location.province, '[^\\p{{L}}]', '', 'g')), '') AS stated, trim(location.coordinates) AS s FROM transactions WHERE location.coordinates IS NOT NULL),
bare AS (SELECT *, regexp_extract(upper(s), '^POINT\\s*\\(({_NUMBER}) ({_NUMBER})\\)$', ['x', 'y']) AS wkt, trim(regexp_replace(s, '^\\((.*)\\)$', '\\1')) AS b FROM raw),
parts AS (SELECT *, list_transform(CASE WHEN contains(b, ';') THEN string_split(replace(b, ',', '.'), ';') WHEN contains(b, ',') THEN string_split(b, ',') ELSE string_split_regex(b, '\\s+') END, lambda p: upper(trim(p))) AS p FROM bare),
sides AS (SELECT *, CASE WHEN len(p) = 2 THEN {_side('p[1]')} END AS one, CASE WHEN len(p) = 2 THEN {_side('p[2]')} END AS two FROM parts),
points AS (SELECT row_id, stated, CASE WHEN wkt.x <> '' THEN TRY_CAST(wkt.y AS DOUBLE) WHEN one.h IN ('E', 'W') THEN two.v ELSE one.v END AS lat, CASE WHEN wkt.x <> '' THEN TRY_CAST(wkt.x AS DOUBLE) WHEN one.h IN ('E', 'W') THEN one.v ELSE two.v END AS lon
  FROM sides WHERE wkt.x <> '' OR (one IS NOT NULL AND two IS NOT NULL)),
usable AS (SELECT * FROM points WHERE lat BETWEEN -35 AND -22 AND lon BETWEEN 16 AND 33),
near AS (SELECT row_id, place_id FROM usable u JOIN places s ON s.place_kind = 'site' AND u.lat BETWEEN s.lat - s.radius_m / 100000 AND s.lat + s.radius_m / 100000
  WHERE 2 * 6371000 * asin(sqrt(power(sin(radians(u.lat - s.lat) / 2), 2) + cos(radians(u.lat)) * cos(radians(s.lat)) * power(sin(radians(u.lon - s.lon) / 2), 2))) <= s.radius_m),
edges AS (SELECT place_id, boundary[k].lat AS y1, boundary[k].lon AS x1, boundary[k % len(boundary) + 1].lat AS y2, boundary[k % len(boundary) + 1].lon AS x2 FROM (SELECT place_id, boundary, unnest(range(1, len(boundary) + 1)) AS k FROM places WHERE place_kind <> 'site')),
inside AS (SELECT row_id, stated, place_id FROM usable JOIN edges ON (y1 <= lat) <> (y2 <= lat) AND lon < x1 + (lat - y1) / (y2 - y1) * (x2 - x1) GROUP BY ALL HAVING count(*) % 2 = 1)
SELECT row_id, place_id FROM near UNION
SELECT row_id, place_id FROM inside JOIN places USING (place_id) WHERE place_kind = 'zone' OR stated IS DISTINCT FROM lower(regexp_replace(place_label, '[^\\p{{L}}]', '', 'g'))"""

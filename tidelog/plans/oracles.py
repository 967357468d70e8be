"""DuckDB oracles, one per registered query (same column names and types).

Each string runs against the driver's pre-registered views and repeats the
input derivation of ``tidelog.plans.bindings`` step for step.
"""

from __future__ import annotations

from tidelog.functions.geo import geohash_sql
from tidelog.operators.keywords import STOP_WORDS
from tidelog.operators.lattice import UNKNOWN
from tidelog.plans.bindings import DICTIONARY_LETTERS, DICTIONARY_WORDS, FIRST_UNTIL, MEMBERS_PER_PAGE, SECOND_UNTIL, SYLLABLES

_ZIPPER = """
d AS (
  SELECT DISTINCT user_id, CAST(ts AS DATE) AS day
  FROM events WHERE user_id IS NOT NULL AND ts IS NOT NULL),
r AS (
  SELECT user_id, day,
         day - CAST(row_number() OVER (PARTITION BY user_id ORDER BY day) AS INTEGER) AS grp
  FROM d),
runs AS (
  SELECT user_id, min(day) AS start_dt, max(day) AS end_dt FROM r GROUP BY user_id, grp),
z AS (
  SELECT user_id, min(start_dt) OVER (PARTITION BY user_id) AS first_lg, start_dt,
         CASE WHEN end_dt >= DATE '2024-01-30' THEN DATE '9999-12-31' ELSE end_dt END AS end_dt
  FROM runs),
c AS (
  SELECT user_id, start_dt,
         CASE WHEN end_dt = DATE '9999-12-31' THEN DATE '2024-01-31' ELSE end_dt END AS end_dt
  FROM z)"""

_HISTOGRAM_ROWS = """
l AS (
  SELECT *, lead(start_dt) OVER (PARTITION BY user_id ORDER BY start_dt, end_dt) AS next_start FROM c),
u AS (
  SELECT user_id, 1 AS gap_days, CAST(datediff('day', start_dt, end_dt) AS BIGINT) AS days FROM l
  UNION ALL
  SELECT user_id, CAST(datediff('day', end_dt, next_start) AS INTEGER), CAST(1 AS BIGINT)
  FROM l WHERE next_start IS NOT NULL)"""

_WORDS = """
w AS (
  SELECT unnest(string_split_regex(text, '[ \\t\\n\\r]+')) AS word FROM documents),
cnt AS (
  SELECT word, count(*) AS n FROM w WHERE length(word) > 0 GROUP BY word)"""

ORACLES: dict[str, str] = {
    "activity_zipper": f"WITH {_ZIPPER} SELECT user_id, first_lg, start_dt, end_dt FROM z",
    "open_interval_close": f"WITH {_ZIPPER} SELECT user_id, start_dt, end_dt FROM c",
    "activity_intervals_all": f"""WITH {_ZIPPER}, {_HISTOGRAM_ROWS}
SELECT '隔' || gap_days || '天' AS interval, gap_days, CAST(sum(days) AS BIGINT) AS days
FROM u GROUP BY gap_days""",
    "activity_intervals_per_user": f"""WITH {_ZIPPER}, {_HISTOGRAM_ROWS}
SELECT user_id, '隔' || gap_days || '天' AS interval, gap_days, CAST(sum(days) AS BIGINT) AS days
FROM u GROUP BY user_id, gap_days""",
    "version_upgrades": """
WITH t AS (
  SELECT DISTINCT o_custkey AS app_name, CAST(o_orderdate AS DATE) AS app_date, o_orderpriority AS app_ver
  FROM orders),
o AS (
  SELECT *, lead(app_ver) OVER (PARTITION BY app_name ORDER BY app_ver, app_date) AS next_ver FROM t)
SELECT app_name, app_date, app_ver, next_ver FROM o WHERE next_ver IS NOT NULL""",
    "activity_intervals_csv": f"""WITH {_ZIPPER}, {_HISTOGRAM_ROWS}
SELECT CAST(user_id AS VARCHAR) AS "user", '隔' || gap_days || '天' AS interval, gap_days,
       CAST(sum(days) AS BIGINT) AS days
FROM u GROUP BY user_id, gap_days""",
    "version_upgrades_csv": """
WITH t AS (
  SELECT DISTINCT CAST(o_custkey AS VARCHAR) AS app_name, CAST(CAST(o_orderdate AS DATE) AS VARCHAR) AS app_date,
         o_orderpriority AS app_ver
  FROM orders),
o AS (
  SELECT *, lead(app_ver) OVER (PARTITION BY app_name ORDER BY app_ver, app_date) AS next_ver FROM t)
SELECT app_name, app_date, app_ver, next_ver FROM o WHERE next_ver IS NOT NULL""",
    "word_count": f"WITH {_WORDS} SELECT word, n FROM cnt ORDER BY word",
    "word_count_top10": f"WITH {_WORDS} SELECT word, n FROM cnt ORDER BY n DESC, word LIMIT 10",
    "word_count_first10": f"WITH {_WORDS} SELECT word, n FROM cnt ORDER BY word LIMIT 10",
}

__all__ = ["ORACLES", "geohash_sql"]


# --- shared SQL pieces for the derived inputs ---------------------------------


def _lng(u: str, e: str) -> str:
    return f"(100.0 + CAST(({u}) % 40 AS DOUBLE) * 0.25 + CAST(({e}) % 16 AS DOUBLE) / 64.0)"


def _lat(u: str, e: str) -> str:
    return f"(20.0 + CAST(({u}) % 20 AS DOUBLE) * 0.25 + CAST(({e}) % 8 AS DOUBLE) / 32.0)"


def _gh(u: str, e: str, p: int) -> str:
    return geohash_sql(_lat(u, e), _lng(u, e), p)


_STOP_SQL = "[" + ", ".join(f"'{w}'" for w in STOP_WORDS) + "]"
_SYLLABLES_SQL = "|".join(sorted(SYLLABLES, key=lambda w: (-len(w), w)))

_RECS = f"""
pg AS (
  SELECT page_id, url, regexp_extract(html, '<title>(.*?)</title>', 1) AS title FROM pages),
ev AS (
  SELECT e.event_id, e.ts, e.user_id, e.event_type, e.value,
         json_extract_string(e.props, '$.k') AS k, pg.url AS page_url, pg.title,
         coalesce(e.event_type = 'error' AND e.value < 10, false) AS anon,
         coalesce((e.event_type = 'error' AND e.value >= 150) OR (e.event_type = 'signup' AND e.value >= 150), false) AS bad
  FROM events e LEFT JOIN pg ON pg.page_id = TRY_CAST(json_extract_string(e.props, '$.k') AS BIGINT)),
recs AS (
  SELECT CASE WHEN NOT anon THEN 'ck' || CAST(user_id AS VARCHAR)
              WHEN event_id % 4 = 1 THEN '' WHEN event_id % 4 = 2 THEN ' ' WHEN event_id % 4 = 3 THEN 'null' END AS cookieid,
         CASE WHEN anon THEN 'null' ELSE 'acct' || CAST(user_id AS VARCHAR) END AS account,
         CASE WHEN anon THEN NULL ELSE 'im' || CAST(user_id AS VARCHAR) END AS imei,
         CASE WHEN user_id % 2 = 0 THEN 'android' ELSE 'ios' END AS osName,
         CAST(user_id % 5 + 8 AS VARCHAR) || '.0' AS osVer,
         '1080*1920' AS resolution,
         CASE WHEN anon THEN 'null' ELSE 'ad' || CAST(user_id AS VARCHAR) END AS androidId,
         'mf' || CAST(user_id % 7 AS VARCHAR) AS manufacture,
         CASE WHEN anon THEN '' ELSE 'dv' || CAST(user_id AS VARCHAR) END AS deviceId,
         'app.shop' AS appid,
         '2.' || CAST(user_id % 4 AS VARCHAR) AS appVer,
         'ch' || CAST(user_id % 3 AS VARCHAR) AS release_ch,
         'pr' || CAST(event_id % 5 AS VARCHAR) AS promotion_ch,
         CAST(user_id % 100 + 110000 AS VARCHAR) AS areacode,
         {_lng('user_id', 'event_id')} AS longtitude,
         {_lat('user_id', 'event_id')} AS latitude,
         CASE WHEN event_id % 2 = 0 THEN 'cm' ELSE 'cu' END AS carrier,
         CASE WHEN user_id % 3 = 0 THEN 'wifi' ELSE '4g' END AS netType,
         CASE WHEN anon THEN ' ' ELSE CAST(user_id AS VARCHAR) || '-' || CAST(CAST(ts AS DATE) AS VARCHAR) END AS sessionId,
         CASE WHEN event_type = 'view' THEN 'pg_view' ELSE event_type END AS logType,
         CAST(epoch_us(ts) // 1000 AS BIGINT) AS commit_time,
         event_id, event_type, CASE WHEN event_id % 3 = 0 THEN CAST(event_id * 7 AS VARCHAR) END AS event_value,
         k AS event_k,
         CASE WHEN value >= 100 THEN 'https://cdn.example.org/' || k ELSE page_url END AS event_url,
         title AS event_title
  FROM ev WHERE NOT bad),
ids AS (
  SELECT * FROM recs
  WHERE regexp_matches(replace(concat_ws('', account, cookieid, sessionId, imei, deviceId, androidId), 'null', ''), '\\S'))"""



def _named(name: str, key: str) -> str:
    return f"CASE {key} % 6 WHEN 1 THEN {name} || ', Nord (old)' WHEN 2 THEN {name} || ', ' || chr(39) || 'O\\Quay' || chr(39) ELSE {name} END"


_GEO = """
sg AS (
  SELECT s.s_suppkey AS sk, s.s_name, s.s_acctbal, s.s_nationkey, n.n_name, n.n_regionkey, r.r_name
  FROM supplier s JOIN nation n ON s.s_nationkey = n.n_nationkey JOIN region r ON n.n_regionkey = r.r_regionkey),
bizraw AS (
  SELECT CASE WHEN sk % 5 <> 2 THEN {gh6} END AS geohash,
         CASE WHEN s_acctbal < 0 THEN '' ELSE r_name END AS province,
         n_name AS city, n_name || '-d' || CAST(sk % 3 AS VARCHAR) AS district, {biz_name} AS biz
  FROM sg),
biz1 AS (
  SELECT geohash, province, city, district, biz FROM (
    SELECT *, row_number() OVER (PARTITION BY geohash ORDER BY province, city, district, biz) AS rn
    FROM bizraw WHERE geohash IS NOT NULL) WHERE rn = 1),
arearaw AS (
  SELECT {gh5} AS geohash, r_name AS province, n_name AS city, {area_name} AS district FROM sg
  WHERE sk % 4 <> 3),
area1 AS (
  SELECT geohash, province, city, district FROM (
    SELECT *, row_number() OVER (PARTITION BY geohash ORDER BY province, city, district) AS rn
    FROM arearaw WHERE geohash IS NOT NULL) WHERE rn = 1),
en AS (
  SELECT ids.*, b.province AS b_province, b.city AS b_city, b.district AS b_district, b.biz AS b_biz,
         a.province AS a_province, a.city AS a_city, a.district AS a_district
  FROM ids
  LEFT JOIN biz1 b ON b.geohash = {rec_gh6}
  LEFT JOIN area1 a ON a.geohash = {rec_gh5}),
en2 AS (
  SELECT *,
    CASE WHEN coalesce(b_province, '') <> '' THEN coalesce(b_province, '') ELSE coalesce(a_province, '') END AS province,
    CASE WHEN coalesce(b_province, '') <> '' THEN coalesce(b_city, '') ELSE coalesce(a_city, '') END AS city,
    CASE WHEN coalesce(b_province, '') <> '' THEN coalesce(b_district, '') ELSE coalesce(a_district, '') END AS district,
    coalesce(b_biz, '') AS biz
  FROM en)""".format(
    gh6=_gh("sk", "sk", 6),
    gh5=_gh("sk + 1", "sk", 5),
    biz_name=_named("s_name", "sk"),
    area_name=_named("'area-' || CAST(sk AS VARCHAR)", "sk"),
    rec_gh6=geohash_sql("ids.latitude", "ids.longtitude", 6),
    rec_gh5=geohash_sql("ids.latitude", "ids.longtitude", 5),
)

_URL_DIM = """
dimraw AS (
  SELECT regexp_extract(url, '^(https?://[^/?#]+)', 1) AS prefix,
         'site' || CAST(page_id % 3 AS VARCHAR) AS category FROM pages
  UNION ALL
  SELECT regexp_extract(url, '^(https?://[^/?#]+)', 1) || '/' || regexp_extract(url, '^https?://[^/?#]+/([a-z]{2})/', 1),
         regexp_extract(url, '^https?://[^/?#]+/([a-z]{2})/', 1) || '专栏'
  FROM pages WHERE regexp_extract(url, '^https?://[^/?#]+/([a-z]{2})/', 1) <> ''),
dim AS (
  SELECT prefix, min(category) AS category FROM dimraw WHERE prefix <> '' GROUP BY prefix)"""

_REC_COLS = (
    "cookieid, account, imei, osName, osVer, resolution, androidId, manufacture, deviceId, appid, appVer, "
    "release_ch, promotion_ch, areacode, longtitude, latitude, carrier, netType, sessionId"
)



def _cc(name: str = "cc", where: str = "true") -> str:
    """Components of the identity rows of some days as CTEs; tables end in ``name``."""
    return f"""
r_{name} AS (
  SELECT 'o' || CAST(l_orderkey AS VARCHAR) AS a,
         'ps' || CAST(l_suppkey AS VARCHAR) || '-' || CAST(l_partkey AS VARCHAR) AS b,
         CASE WHEN l_linenumber % 4 = 0 THEN 'pt' || CAST(l_partkey AS VARCHAR) END AS c FROM lineitem WHERE {where}),
e_{name} AS (SELECT a AS x, b AS y FROM r_{name} UNION SELECT b, a FROM r_{name}
      UNION SELECT a, c FROM r_{name} WHERE c IS NOT NULL UNION SELECT c, a FROM r_{name} WHERE c IS NOT NULL),
v_{name} AS (SELECT DISTINCT x AS id FROM e_{name}),
{name}(id, comp) USING KEY (id) AS (
  SELECT id, id FROM v_{name}
  UNION
  SELECT e.y AS id, min({name}.comp) AS comp
  FROM {name} JOIN e_{name} AS e ON e.x = {name}.id JOIN recurring.{name} AS cur ON cur.id = e.y
  GROUP BY e.y, cur.comp
  HAVING min({name}.comp) < cur.comp)"""


_CC = _cc()
_UNTIL_SECOND = _cc("cc2", f"CAST(l_shipdate AS DATE) <= DATE '{SECOND_UNTIL}'")

ORACLES.update({
    "log_flatten": f"""WITH {_RECS}
SELECT {_REC_COLS}, logType, commit_time,
       array_to_string(list_sort(list_filter(['k=' || event_k, 'url=' || event_url, 'title=' || event_title, 'value=' || event_value, 'x' || CAST(event_id % 13 AS VARCHAR) || '=' || event_type],
                                 lambda x: x IS NOT NULL)), chr(10)) AS event FROM recs""",
    "log_rejects": f"""WITH {_RECS}
SELECT strftime(ts, '%Y-%m-%d %H:%M:%S.%g') || CASE WHEN event_type = 'error' THEN ' -->' ELSE '' END
       || ' {{"u":{{"cookieid":"ck' || CAST(user_id AS VARCHAR)
       || CASE WHEN event_type = 'error' THEN '' ELSE '"}}}}' END AS line
FROM ev WHERE bad""",
    "identity_filter": f"""WITH {_RECS}
SELECT commit_time, account, cookieid, sessionId, imei, deviceId, androidId FROM ids""",
    "geohash_points": f"""SELECT c_custkey, {_gh('c_custkey', 'c_custkey * 3', 5)} AS geohash5,
       {_gh('c_custkey', 'c_custkey * 3', 6)} AS geohash6 FROM customer""",
    "area_dump_parse": f"""
SELECT CAST(r_regionkey + 100000 AS VARCHAR) AS code, r_name AS name, '0' AS parent_code, '1' AS level,
       '0.0' AS lng, '0.0' AS lat FROM region
UNION ALL
SELECT CAST(n_nationkey + 200000 AS VARCHAR), n_name, CAST(n_regionkey + 100000 AS VARCHAR), '2', '0.0', '0.0' FROM nation
UNION ALL
SELECT CAST(s_suppkey + 300000 AS VARCHAR), {_named("'area-' || CAST(s_suppkey AS VARCHAR)", "s_suppkey")}, CAST(s_nationkey + 200000 AS VARCHAR), '3',
       CASE WHEN s_suppkey % 4 = 3 THEN 'n/a' ELSE CAST({_lng('s_suppkey + 1', 's_suppkey')} AS VARCHAR) END, CAST({_lat('s_suppkey + 1', 's_suppkey')} AS VARCHAR)
FROM supplier""",
    "biz_dump_parse": f"""WITH {_GEO}
SELECT CASE WHEN s_acctbal < 0 THEN '' ELSE r_name END AS province, n_name AS city,
       n_name || '-d' || CAST(sk % 3 AS VARCHAR) AS district, {_named("s_name", "sk")} AS biz,
       CASE WHEN sk % 5 = 2 THEN 'n/a' ELSE CAST({_lng('sk', 'sk')} AS VARCHAR) END AS lng, CAST({_lat('sk', 'sk')} AS VARCHAR) AS lat FROM sg""",
    "area_hierarchy": f"""WITH {_GEO}
SELECT r_name AS province, n_name AS city, {_named("'area-' || CAST(sk AS VARCHAR)", "sk")} AS district,
       CASE WHEN sk % 4 = 3 THEN 'n/a' ELSE CAST({_lng('sk + 1', 'sk')} AS VARCHAR) END AS lng, CAST({_lat('sk + 1', 'sk')} AS VARCHAR) AS lat FROM sg""",
    "area_dictionary": f"WITH {_GEO} SELECT geohash, province, city, district FROM arearaw",
    "biz_dictionary": f"WITH {_GEO} SELECT geohash, province, city, district, biz FROM bizraw",
    "biz_dictionary_dedup": f"WITH {_GEO} SELECT geohash, province, city, district, biz FROM biz1",
    "geo_enrich": f"WITH {_RECS}, {_GEO} SELECT commit_time, cookieid, province, city, district, biz FROM en2",
    "unmatched_coordinates": f"""WITH {_RECS}, {_GEO}
SELECT CAST(longtitude AS VARCHAR) || ',' || CAST(latitude AS VARCHAR) AS value FROM en2 WHERE province = ''""",
    "title_keywords": f"""WITH {_RECS}, {_GEO}
SELECT commit_time, cookieid,
       array_to_string(list_filter(string_split_regex(coalesce(event_title, ''), '[^\\p{{L}}\\p{{N}}]+'),
                                   lambda x: length(x) >= 2 AND NOT list_contains({_STOP_SQL}, x)), ' ') AS keyword
FROM ids""",
    "url_category": f"""WITH {_URL_DIM}, u AS (SELECT DISTINCT url FROM pages WHERE url IS NOT NULL)
SELECT url, coalesce((SELECT d.category FROM dim d WHERE starts_with(u.url, d.prefix)
                      ORDER BY length(d.prefix) DESC LIMIT 1), '其他') AS ct FROM u""",
    "traffic_detail": f"""WITH {_RECS}, {_GEO}, {_URL_DIM},
views AS (SELECT * FROM en2 WHERE logType = 'pg_view' AND event_url IS NOT NULL)
SELECT {_REC_COLS}, logType AS eventType, commit_time, province, city, district, biz,
       coalesce((SELECT d.category FROM dim d WHERE starts_with(views.event_url, d.prefix)
                 ORDER BY length(d.prefix) DESC LIMIT 1), '其他') AS ct,
       strftime(epoch_ms(commit_time), '%Y-%m-%d') AS dateStr
FROM views""",
    "geocode_parse": f"""WITH {_GEO},
areas AS (SELECT sk, s_name, n_name, r_name, unnest(generate_series(1, sk % 4)) AS i FROM sg WHERE sk % 10 <> 0)
SELECT {_gh('sk', 'sk + 1', 6)} AS geohash, '' AS province, '' AS city, '' AS district, '' AS biz FROM sg WHERE sk % 10 = 0
UNION ALL
SELECT {_gh('sk', 'sk + 1', 6)}, r_name, n_name, n_name || '-d', '' FROM sg WHERE sk % 10 <> 0 AND sk % 4 = 0
UNION ALL
SELECT {_gh('sk + i', 'sk * i', 6)}, r_name, n_name, n_name || '-d', s_name || '-' || CAST(i AS VARCHAR) FROM areas""",
    "identity_components": f"WITH RECURSIVE {_CC} SELECT id, comp AS component FROM cc",
    "component_sizes": f"WITH RECURSIVE {_CC} SELECT comp AS component, count(*) AS n_members FROM cc GROUP BY comp",
    "stopword_anti": f"""WITH w AS (SELECT unnest(string_split_regex(text, '[^\\p{{L}}\\p{{N}}]+')) AS word FROM documents)
SELECT word, count(*) AS n FROM w WHERE length(word) > 0 AND NOT list_contains({_STOP_SQL}, word) GROUP BY word""",
    "unmatched_roundtrip": f"""WITH {_RECS}, {_GEO}
SELECT CAST(longtitude AS VARCHAR) || ',' || CAST(latitude AS VARCHAR) AS value,
       {geohash_sql('latitude', 'longtitude', 6)} AS geohash
FROM en2 WHERE province = ''""",
    "roundtrip_parquet": """
SELECT CAST(c_custkey AS INTEGER) AS id,
       CASE c_custkey % 5 WHEN 0 THEN c_name || ', "x"' WHEN 1 THEN '' ELSE c_name END AS name,
       CASE WHEN c_custkey % 7 <> 0 THEN c_mktsegment END AS segment
FROM customer""",
    "title_keywords_dictionary": f"""
SELECT doc_id, array_to_string(list_filter(regexp_extract_all(text, '{_SYLLABLES_SQL}|[\\p{{L}}\\p{{N}}]'),
                                           lambda x: length(x) >= 2 AND NOT list_contains({_STOP_SQL}, x)), ' ') AS keyword
FROM documents""",
    "area_dic_file": f"""
SELECT {_gh('s_suppkey', 's_suppkey + 2', 5)} AS geohash, 'P' AS province, CAST(s_nationkey AS VARCHAR) AS city, s_name AS district
FROM supplier""",
})
ORACLES["traffic_detail_by_day"] = ORACLES["traffic_detail"]
ORACLES["url_category_files"] = ORACLES["url_category"]
ORACLES["traffic_detail_rerun"] = ORACLES["traffic_detail"]
ORACLES["activity_zipper_daily"] = ORACLES["activity_zipper"]
ORACLES["geo_backfill"] = f"""WITH {_RECS}, {_GEO},
asked AS (SELECT *, province = '' AND CAST(floor(latitude * 32) AS BIGINT) % 4 <> 0 AS placed FROM en2)
SELECT commit_time, cookieid, CASE WHEN placed THEN 'B' || CAST(CAST(floor(latitude) AS BIGINT) AS VARCHAR) ELSE province END AS province,
       CASE WHEN placed THEN 'C' ELSE city END AS city, CASE WHEN placed THEN 'D' ELSE district END AS district,
       CASE WHEN placed THEN '' ELSE biz END AS biz FROM asked"""
ORACLES["component_pages"] = f"""WITH RECURSIVE {_CC},
placed AS (SELECT comp, id, (row_number() OVER (PARTITION BY comp ORDER BY id) - 1) // {MEMBERS_PER_PAGE} AS page FROM cc)
SELECT comp AS component, CAST(page AS BIGINT) AS page, CAST(count(*) AS INTEGER) AS n_members, string_agg(id, ',' ORDER BY id) AS members
FROM placed GROUP BY comp, page"""

# After the second batch a component has the smallest name of the first, if it has one.
ORACLES["identity_daily"] = f"""WITH RECURSIVE {_CC}, {_UNTIL_SECOND},
seen AS (SELECT DISTINCT unnest([a, b, c]) AS id FROM (
  SELECT 'o' || CAST(l_orderkey AS VARCHAR) AS a, 'ps' || CAST(l_suppkey AS VARCHAR) || '-' || CAST(l_partkey AS VARCHAR) AS b,
         CASE WHEN l_linenumber % 4 = 0 THEN 'pt' || CAST(l_partkey AS VARCHAR) END AS c
  FROM lineitem WHERE CAST(l_shipdate AS DATE) <= DATE '{FIRST_UNTIL}')),
second AS (SELECT cc2.comp, coalesce(min(seen.id), cc2.comp) AS name FROM cc2 LEFT JOIN seen ON seen.id = cc2.id GROUP BY cc2.comp),
named AS (SELECT cc2.id, second.name FROM cc2 JOIN second ON second.comp = cc2.comp),
third AS (SELECT cc.comp, coalesce(min(named.name), cc.comp) AS name FROM cc LEFT JOIN named ON named.id = cc.id GROUP BY cc.comp)
SELECT cc.id, third.name AS component, cc.comp AS smallest FROM cc JOIN third ON third.comp = cc.comp"""
ORACLES["identity_merges"] = f"""WITH RECURSIVE {_CC}, {_UNTIL_SECOND},
names AS (SELECT DISTINCT cc.comp, cc2.comp AS name FROM cc JOIN cc2 ON cc2.id = cc.id),
last AS (SELECT name AS old_component, min(name) OVER (PARTITION BY comp) AS component FROM names)
SELECT old_component, component FROM last WHERE old_component <> component"""
# The cheapest path to each place of a distinct word, one letter a step; letters that
# no word covers are not set apart by blanks, so neighbours grow together.
ORACLES["title_keywords_lattice"] = f"""WITH RECURSIVE
texts AS (SELECT row_number() OVER () AS t, doc_id, regexp_extract_all(text, '[\\p{{L}}\\p{{N}}]+') AS rs FROM documents),
tok AS (SELECT t, unnest(rs) AS r, unnest(range(1, len(rs) + 1)) AS i FROM texts),
dic AS (SELECT r AS word, count(*) AS n FROM tok WHERE length(r) BETWEEN 2 AND {DICTIONARY_LETTERS} GROUP BY r ORDER BY n DESC, r LIMIT {DICTIONARY_WORDS}),
total AS (SELECT CAST(sum(n) AS DOUBLE) AS n FROM dic),
cost AS (SELECT word, CAST(floor(1000 * ln(total.n / dic.n) + 0.5) AS BIGINT) AS c FROM dic, total),
runs AS (SELECT DISTINCT r FROM tok),
places AS (SELECT r, unnest(range(1, length(r) + 1)) AS e FROM runs),
pieces AS (SELECT r, e, unnest(range(1, least(e, {DICTIONARY_LETTERS}) + 1)) AS l FROM places),
edges AS (
  SELECT r, e, l, c, false AS u FROM pieces JOIN cost ON word = substr(r, CAST(e - l + 1 AS BIGINT), CAST(l AS BIGINT))
  UNION ALL
  SELECT r, e, 1, CAST(floor(1000 * ln(total.n) + 0.5) AS BIGINT) + {UNKNOWN}, true FROM places, total),
ways AS (SELECT r, e, list({{'l': l, 'c': c, 'u': u}}) AS ways FROM edges GROUP BY r, e),
path(r, e, costs, paths) AS (
  SELECT r, CAST(0 AS BIGINT), [CAST(0 AS BIGINT)], [''] FROM runs
  UNION ALL
  SELECT r, e, list_append(costs, best.c), list_append(paths, paths[e + best.l + 1] || CASE WHEN best.u THEN substr(r, e, 1) ELSE ' ' || substr(r, CAST(e + best.l + 1 AS BIGINT), CAST(-best.l AS BIGINT)) || ' ' END)
  FROM (SELECT p.r, w.e, p.costs, p.paths, list_min(list_transform(w.ways, lambda x: {{'c': p.costs[w.e - x.l + 1] + x.c, 'l': -x.l, 'u': x.u}})) AS best
        FROM path p JOIN ways w ON w.r = p.r AND w.e = p.e + 1)),
cut AS (SELECT r, string_split(trim(regexp_replace(paths[e + 1], ' +', ' ', 'g')), ' ') AS ws FROM path WHERE e = length(r)),
words AS (SELECT t, i, array_to_string(list_filter(ws, lambda x: length(x) >= 2 AND NOT list_contains({_STOP_SQL}, x)), ' ') AS k FROM tok JOIN cut USING (r)),
joined AS (SELECT t, string_agg(k, ' ' ORDER BY i) AS keyword FROM words WHERE k <> '' GROUP BY t)
SELECT doc_id, CASE WHEN rs IS NOT NULL THEN coalesce(keyword, '') END AS keyword FROM texts LEFT JOIN joined USING (t)"""

"""The registered queries as DuckDB SQL over the raw driver tables.

The driver runs each Spark query and the SQL of the same name and compares
row count, column names and values.  The SQL is written independently of
the DataFrame code (joins as plain SQL joins, running sets as window
lists); it shares only the fixed values (bands, weights, adapter rules).
"""

from __future__ import annotations

from decimal import ROUND_HALF_UP, Decimal

from portrait.functions import scalars as S
from portrait.functions import weights as W
from portrait.sources import adapters as A

DAY = 86_400_000
HOUR = 3_600_000


def q(s: str) -> str:
    return "'" + s.replace("'", "''") + "'"


# ---- scalar rules as SQL text -----------------------------------------------------
def age_band_sql(age: str) -> str:
    whens = " ".join(f"WHEN {age} <= {u} THEN {q(b)}" for b, u in zip(S.AGE_BANDS, S.AGE_BAND_UPPER))
    return f"CASE WHEN {age} IS NULL THEN NULL {whens} ELSE {q(S.AGE_BANDS[-1])} END"


def price_band_sql(a: str) -> str:
    return (f"CASE WHEN {a} IS NULL THEN NULL WHEN {a} <= 1000 THEN 'low' "
            f"WHEN {a} <= 4000 THEN 'mid' ELSE 'high' END")


def zodiac_sql(md: str) -> str:
    """From month * 100 + day."""
    whens = " ".join(f"WHEN {md} > {m * 100 + dd} THEN {q(sign)}" for m, dd, sign in S.ZODIAC_STARTS)
    return f"CASE WHEN {md} IS NULL THEN NULL {whens} ELSE {q(S.ZODIAC_DEFAULT)} END"


def day_period_sql(h: str) -> str:
    whens = " ".join(f"WHEN {h} < {u} THEN {q(n)}" for u, n in S.DAY_PERIODS)
    return f"CASE WHEN {h} IS NULL THEN NULL {whens} ELSE {q(S.DAY_PERIOD_LAST)} END"


def label_sql(r: str) -> str:
    whens = " ".join(f"WHEN {r} >= {t} THEN {q(b)}" for t, b in S.LABEL_THRESHOLDS)
    return f"CASE WHEN {r} IS NULL THEN NULL {whens} ELSE {q(S.LABEL_FLOOR)} END"


def dominant_os_sql(os: str) -> str:
    whens = " ".join(f"WHEN list_contains(string_split({os}, ','), {q(o)}) THEN {q(o)}" for o in S.OS_PRIORITY)
    return f"CASE WHEN {os} IS NULL THEN NULL {whens} ELSE string_split({os}, ',')[1] END"


def long_values(table: dict, key: str = "key") -> str:
    rows = ", ".join(f"({q(k)}, {q(b)}, CAST('{w}' AS DECIMAL(4,2)))"
                     for k, ws in table.items() for b, w in zip(W.SCORED_BANDS, ws))
    return f"(SELECT * FROM (VALUES {rows}) t({key}, age_group, weight))"


def scaled(w: str, rate: str) -> str:
    return str((Decimal(w) * Decimal(rate)).quantize(Decimal("0.001"), ROUND_HALF_UP))


def wide_case(table: dict, key: str, rate: str, suffix_idx: int, default: str | None) -> str:
    whens = " ".join(f"WHEN {key} = {q(k)} THEN CAST('{scaled(ws[suffix_idx], rate)}' AS DECIMAL(10,3))"
                     for k, ws in table.items())
    d = "NULL" if default is None else f"CAST('{default}' AS DECIMAL(10,3))"
    return f"CASE {whens} ELSE {d} END"


# ---- common table expressions --------------------------------------------------------
AD = A.SQL
AS_OF_Y, AS_OF_M, AS_OF_D = map(int, A.AS_OF.split("-"))
ENRICHED = f"""
  ue_days AS (SELECT *, CASE WHEN regexp_full_match(birthday, '[+-]?[0-9]+')
                             THEN TRY_CAST(birthday AS BIGINT) END AS n
              FROM ({AD['user_info']})),
  ue_cycle AS (SELECT *, DATE '1970-01-01' + CAST(rest AS INTEGER) AS cd,
                      birthday IS NOT NULL AND rest IS NULL AS bad FROM (
      SELECT *, CASE WHEN n BETWEEN {S.EPOCH_DAY_MIN} AND {S.EPOCH_DAY_MAX}
                     THEN ((n % 146097) + 146097) % 146097 END AS rest FROM ue_days)),
  ue_raw AS (SELECT *, year(cd) + 400 * ((n - rest) // 146097) AS y, month(cd) AS m, day(cd) AS d, month(cd) * 100 + day(cd) AS md
             FROM ue_cycle),
  ue AS (SELECT
      CASE WHEN bad THEN 'invalid_date' WHEN birthday IS NOT NULL THEN
           CASE WHEN y < 0 THEN '-' WHEN y > 9999 THEN '+' ELSE '' END
           || CASE WHEN abs(y) < 1000 THEN lpad(CAST(abs(y) AS VARCHAR), 4, '0') ELSE CAST(abs(y) AS VARCHAR) END
           || '-' || lpad(CAST(m AS VARCHAR), 2, '0') || '-' || lpad(CAST(d AS VARCHAR), 2, '0') END AS birthday,
      CASE WHEN bad THEN '-1' ELSE CAST(y AS VARCHAR) END AS birth_year,
      name, ts_ms,
      CASE WHEN bad THEN 'unknown' ELSE {zodiac_sql('md')} END AS zodiac_sign,
      id, user_level, gender,
      CAST(CASE WHEN bad THEN -1 ELSE trunc((({AS_OF_Y} * 12 + {AS_OF_M}) * 32 + {AS_OF_D} - ((y * 12 + m) * 32 + d)) / 384.0) END AS INTEGER) AS age,
      create_time, login_name
    FROM ue_raw),
  users AS (SELECT *, {age_band_sql('age')} AS age_group FROM ue)"""

USER_PROFILE = f"""
  uprof AS (SELECT b.uid, b.height, b.unit_height, b.weight, b.unit_weight, b.ts_ms,
       u.birthday, u.birth_year, u.name, u.zodiac_sign, u.id, u.user_level, u.gender, u.age,
       u.create_time, u.login_name, u.age_group, greatest(u.ts_ms, b.ts_ms) AS event_ms
    FROM users u JOIN ({AD['user_sup_msg']}) b
      ON u.id = b.uid AND b.ts_ms BETWEEN u.ts_ms - {DAY} AND u.ts_ms + {DAY})"""

ORDER_LINES = f"""
  olines AS (SELECT d.id, d.order_id, d.sku_id, d.sku_name, d.sku_num, i.create_time, i.user_id,
       i.total_amount, i.original_total_amount, i.ts_ms, greatest(d.ts_ms, i.ts_ms) AS event_ms
    FROM ({AD['order_detail']}) d JOIN ({AD['order_info']}) i
      ON d.order_id = i.id AND i.ts_ms BETWEEN d.ts_ms - {DAY} AND d.ts_ms + {DAY})"""

CHAIN = f"""
  chain AS (SELECT l.id, l.order_id, l.sku_id, s.sku_name, l.sku_num, l.create_time, l.user_id,
       l.total_amount, l.original_total_amount, l.ts_ms, l.event_ms,
       s.tm_id, s.category3_id, t.tm_name, c3.name AS category3_name, c3.category2_id,
       c2.name AS category2_name, c2.category1_id, c1.name AS category1_name
    FROM olines l
    LEFT JOIN ({AD['dim_sku']}) s ON CAST(l.sku_id AS VARCHAR) = s.id
    LEFT JOIN ({AD['dim_trademark']}) t ON s.tm_id = t.id
    LEFT JOIN ({AD['dim_category3']}) c3 ON s.category3_id = c3.id
    LEFT JOIN ({AD['dim_category2']}) c2 ON c3.category2_id = c2.id
    LEFT JOIN ({AD['dim_category1']}) c1 ON c2.category1_id = c1.id)"""

WIDE = f"""
  wide AS (SELECT o.id, o.order_id, o.sku_id, o.sku_name, o.sku_num, o.create_time, o.user_id,
       o.total_amount, o.original_total_amount, o.ts_ms, o.tm_id, o.category3_id, o.tm_name,
       o.category3_name, o.category2_id, o.category2_name, o.category1_id, o.category1_name,
       {price_band_sql('o.total_amount')} AS price_interval,
       u.uid, u.height, u.unit_height, u.weight, u.unit_weight, u.birthday, u.birth_year, u.name,
       u.zodiac_sign, u.user_level, u.gender, u.age, u.login_name, u.age_group,
       greatest(o.event_ms, u.event_ms) AS event_ms
    FROM chain o JOIN uprof u
      ON o.user_id = u.uid AND u.event_ms BETWEEN o.event_ms - {DAY} AND o.event_ms + {DAY})"""

CATS = f"""
  cats AS (SELECT c3.id, c3.name AS b3name, c2.name AS b2name, c1.name AS b1name
    FROM ({AD['dim_category3']}) c3 JOIN ({AD['dim_category2']}) c2 ON c3.category2_id = c2.id
    JOIN ({AD['dim_category1']}) c1 ON c2.category1_id = c1.id)"""

FLAT = f"""
  plog AS ({AD['page_log']}),
  flat AS (SELECT seq, coalesce(uid, '-1') AS uid, ts, split_part(os, ' ', 1) AS os, ch, md, ba, ar, vc,
       CASE WHEN item_type = 'keyword' THEN item END AS search_item
    FROM plog WHERE has_common AND coalesce(uid, '-1') <> '')"""

DEDUP = """
  replayed AS (SELECT * FROM flat UNION ALL SELECT * FROM flat WHERE seq % 10 = 0),
  dedup AS (SELECT min(seq) AS seq, uid, ts, os, ch, md, ba, ar, vc, search_item
    FROM replayed GROUP BY uid, ts, os, ch, md, ba, ar, vc, search_item)"""


def _set(col: str) -> str:
    return f"array_to_string(list_sort(list_distinct(list({col}) OVER w)), ',') AS {col}"


RUNNING = f"""
  running AS (SELECT uid, ts, seq, count(*) OVER w AS pv, {_set('os')}, {_set('ch')}, {_set('md')},
       {_set('ba')}, {_set('search_item')}
    FROM dedup WINDOW w AS (PARTITION BY uid ORDER BY ts, seq ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW))"""

LAST = """
  lastw AS (SELECT uid, window_start, ts, seq, pv, os, ch, md, ba, search_item FROM (
      SELECT *, (ts // 120000) * 120000 AS window_start,
             row_number() OVER (PARTITION BY uid, ts // 120000 ORDER BY ts DESC, seq DESC) AS rn
      FROM running) WHERE rn = 1)"""

DEV_COLS = ", ".join(
    f"{wide_case(W.DEVICE, 'judge_os', W.DEVICE_RATE, i, None)} AS device_{s}" for i, s in enumerate(W.BAND_SUFFIX))
SEARCH_COLS = ", ".join(
    f"{wide_case(W.SEARCH, 'searchCategory', W.SEARCH_RATE, i, '0')} AS search_{s}" for i, s in enumerate(W.BAND_SUFFIX))

def scores(search: str = "search_item") -> str:
    return f"""
  dev AS (SELECT *, {dominant_os_sql('os')} AS judge_os FROM lastw),
  b3 AS (SELECT b3name, arg_max(b1name, CAST(id AS BIGINT)) AS b1_category FROM cats GROUP BY b3name),
  sc AS (SELECT category_name, arg_min(search_category, id) AS searchCategory
    FROM ({AD['category_compare_dic']}) GROUP BY category_name),
  pscore AS (SELECT d.*, {DEV_COLS}, b3.b1_category, sc.searchCategory
    FROM dev d LEFT JOIN b3 ON d.{search} = b3.b3name LEFT JOIN sc ON b3.b1_category = sc.category_name),
  pages AS (SELECT *, {SEARCH_COLS} FROM pscore)"""


SCORES = scores()
# the most recent single search term that is a level-3 name (repaired mode)
TERMS = """
  known AS (SELECT d.*, CASE WHEN c.b3name IS NOT NULL THEN d.search_item END AS term
    FROM dedup d LEFT JOIN (SELECT DISTINCT b3name FROM cats) c ON d.search_item = c.b3name),
  terms AS (SELECT uid, ts, seq, last_value(term IGNORE NULLS) OVER (PARTITION BY uid ORDER BY ts, seq
      ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW) AS search_term FROM known)"""
LAST_TERM = LAST.replace("FROM running)", "FROM running JOIN terms USING (uid, ts, seq))").replace("ba, search_item FROM", "ba, search_item, search_term FROM")


def with_(*ctes: str) -> str:
    return "WITH " + ",".join(ctes)


def _dbl(*cols):
    return ", ".join(f"CAST({c} AS DOUBLE) AS {c.split('.')[-1]}" for c in cols)


DEVICE_NAMES = [f"device_{s}" for s in W.BAND_SUFFIX]
SEARCH_NAMES = [f"search_{s}" for s in W.BAND_SUFFIX]


def _order_scores(mode: str) -> str:
    tables = W.order_weight_tables(mode)

    def lookup(table: dict, key: str, alias: str) -> str:
        if not table:
            return f"CAST('{W.DEFAULT_WEIGHT}' AS DECIMAL(4,2))"
        return (f"coalesce((SELECT weight FROM {long_values(table)} lv WHERE lv.key = {key} "
                f"AND lv.age_group = s.age_group), CAST('{W.DEFAULT_WEIGHT}' AS DECIMAL(4,2)))")
    local = f"(make_timestamp(CAST(create_time AS BIGINT) * 1000) + INTERVAL 8 HOUR)"
    return f"""
  scored0 AS (SELECT *, {day_period_sql(f'hour({local})')} AS time_period,
       strftime({local}, '%H:%M:%S') AS parsed_time
    FROM wide WHERE age_group IS NOT NULL AND category1_name IS NOT NULL AND tm_name IS NOT NULL
      AND price_interval IS NOT NULL AND create_time IS NOT NULL),
  scored AS (SELECT s.*,
       CAST({lookup(tables['category'], 's.category1_name', 'c')} * CAST('{W.CATEGORY_COEF}' AS DECIMAL(4,2)) AS DECIMAL(18,4)) AS combined_score,
       CAST({lookup(tables['brand'], 's.tm_name', 'b')} * CAST('{W.BRAND_COEF}' AS DECIMAL(4,2)) AS DECIMAL(18,4)) AS pinpai,
       CAST({lookup(tables['price'], 's.price_interval', 'p')} * CAST('{W.PRICE_COEF}' AS DECIMAL(4,2)) AS DECIMAL(18,4)) AS jiage,
       CAST({lookup(tables['time'], 's.time_period', 't')} * CAST('{W.TIME_COEF}' AS DECIMAL(4,2)) AS DECIMAL(18,4)) AS shijian
    FROM scored0 s)"""


def _band_pick(prefix: str, ag: str) -> str:
    whens = " ".join(f"WHEN {ag} = {q(b)} THEN p.{prefix}_{s}" for b, s in zip(W.SCORED_BANDS, W.BAND_SUFFIX))
    return f"coalesce(CAST(CASE {whens} END AS DECIMAL(18,4)), CAST(0 AS DECIMAL(18,4)))"


def age_label_sql(mode: str) -> str:
    if mode == "as_run":
        dev = srch = "CAST(0 AS DECIMAL(18,4))"
    else:
        dev, srch = _band_pick("device", "o.age_group"), _band_pick("search", "o.age_group")
    profile = (LAST, SCORES) if mode == "as_run" else (TERMS, LAST_TERM, scores("search_term"))
    return with_(ENRICHED, USER_PROFILE, ORDER_LINES, CHAIN, WIDE, CATS, FLAT, DEDUP, RUNNING, *profile,
                 _order_scores(mode), f"""
  lab AS (SELECT (o.event_ms // {HOUR}) * {HOUR} AS window_start, p.uid AS key, o.id, o.order_id,
       o.age_group, o.price_interval, o.time_period, o.parsed_time, o.combined_score, o.pinpai,
       o.jiage, o.shijian, p.ts AS log_ts, p.judge_os, {dev} AS device, {srch} AS search
    FROM scored o JOIN pages p
      ON CAST(o.user_id // {A.USER_DIV} AS VARCHAR) = p.uid AND o.event_ms // {HOUR} = p.ts // {HOUR})""") + f"""
SELECT window_start, key, id, order_id, age_group, price_interval, time_period, parsed_time,
       {_dbl('combined_score', 'pinpai', 'jiage', 'shijian')}, log_ts, judge_os,
       CAST(device AS DOUBLE) AS device, CAST(search AS DOUBLE) AS search,
       CAST(combined_score + pinpai + jiage + shijian + device + search AS DOUBLE) AS sum,
       {label_sql('round(combined_score + pinpai + jiage + shijian + device + search, 3)')} AS new_ageGroup
FROM lab"""


PRICE_W = long_values(W.PRICE, "price_interval")

SQL: dict[str, str] = {
    "price_preference": with_(ENRICHED) + f"""
SELECT p.age_group, p.price_interval, CAST(w.weight AS DOUBLE) AS weight, count(*) AS n FROM (
  SELECT u.age_group, {price_band_sql('o.total_amount')} AS price_interval
  FROM users u JOIN ({AD['order_info']}) o
    ON o.user_id = u.id AND o.ts_ms BETWEEN u.ts_ms - {DAY} AND u.ts_ms + 60000
  WHERE o.total_amount IS NOT NULL) p
JOIN {PRICE_W} w ON w.price_interval = p.price_interval AND w.age_group = p.age_group
GROUP BY p.age_group, p.price_interval, w.weight""",
    "user_enrich": with_(ENRICHED) + """
SELECT id, birthday, birth_year, age, zodiac_sign, age_group, gender, name, login_name, user_level,
       create_time, ts_ms FROM users""",
    "zodiac": with_(ENRICHED) + "\nSELECT zodiac_sign, age_group, count(*) AS n FROM users GROUP BY ALL",
    "user_body_join": with_(ENRICHED, USER_PROFILE) + "\nSELECT * FROM uprof",
    "order_detail_join": with_(ORDER_LINES) + "\nSELECT * FROM olines",
    "sku_dim_chain": with_(ORDER_LINES, CHAIN) + "\nSELECT * FROM chain",
    "order_user_join": with_(ENRICHED, USER_PROFILE, ORDER_LINES, CHAIN, WIDE) + "\nSELECT * FROM wide",
    "dim_left_join": f"""
SELECT o.id, o.province_id, n.n_name AS province_name
FROM ({AD['order_info']}) o LEFT JOIN nation n ON CAST(o.province_id AS VARCHAR) = CAST(n.n_nationkey AS VARCHAR)""",
    "category_tree": with_(CATS) + "\nSELECT * FROM cats",
    "last_name_lookup": with_(CATS, FLAT) + """,
  b3 AS (SELECT b3name, arg_max(b1name, CAST(id AS BIGINT)) AS b1_category FROM cats GROUP BY b3name)
SELECT f.seq, f.search_item, b3.b1_category FROM flat f LEFT JOIN b3 ON f.search_item = b3.b3name
WHERE f.search_item IS NOT NULL""",
    "first_match_lookup": with_(CATS) + f""",
  sc AS (SELECT category_name, arg_min(search_category, id) AS searchCategory
         FROM ({AD['category_compare_dic']}) GROUP BY category_name)
SELECT c.id, c.b1name, sc.searchCategory FROM cats c LEFT JOIN sc ON c.b1name = sc.category_name""",
    "dict_lookup": f"""
SELECT o.o_orderkey AS id, substr(o.o_orderpriority, 1, 1) AS dic_code, d.dic_name
FROM orders o LEFT JOIN ({AD['base_dic']}) d ON substr(o.o_orderpriority, 1, 1) = d.dic_code""",
    "page_flatten": with_(FLAT) + "\nSELECT * FROM flat",
    "page_dedup": with_(FLAT, DEDUP) + "\nSELECT * FROM dedup",
    "running_profile": with_(FLAT, DEDUP, RUNNING) + "\nSELECT * FROM running",
    "window_last_profile": with_(FLAT, DEDUP, RUNNING, LAST) + "\nSELECT * FROM lastw",
    "device_score": with_(FLAT, DEDUP, RUNNING, LAST, CATS, SCORES) + f"""
SELECT uid, window_start, os, judge_os, {_dbl(*DEVICE_NAMES)} FROM pages""",
    "search_score": with_(FLAT, DEDUP, RUNNING, LAST, CATS, SCORES) + f"""
SELECT uid, window_start, search_item, b1_category, searchCategory, {_dbl(*SEARCH_NAMES)} FROM pages""",
    "window_join_minute": with_(ENRICHED, USER_PROFILE, ORDER_LINES, CHAIN, WIDE, FLAT, DEDUP, RUNNING, LAST) + f"""
SELECT (o.event_ms // 60000) * 60000 AS window_start, p.uid AS key, o.id, p.ts AS log_ts, p.pv AS log_pv
FROM wide o JOIN lastw p
  ON CAST(o.user_id // {A.USER_DIV} AS VARCHAR) = p.uid AND o.event_ms // 60000 = p.ts // 60000""",
    "window_join": with_(ENRICHED, USER_PROFILE, ORDER_LINES, CHAIN, WIDE, FLAT, DEDUP, RUNNING, LAST) + f"""
SELECT (o.event_ms // {HOUR}) * {HOUR} AS window_start, p.uid AS key, o.id, p.ts AS log_ts, p.pv AS log_pv
FROM wide o JOIN lastw p
  ON CAST(o.user_id // {A.USER_DIV} AS VARCHAR) = p.uid AND o.event_ms // {HOUR} = p.ts // {HOUR}""",
    "age_label_as_run": age_label_sql("as_run"),
    "age_label_repaired": age_label_sql("repaired"),
}


# ---- scalar groups, change records, metrics --------------------------------------
LOCAL = "(make_timestamp(CAST({ms} AS BIGINT) * 1000) + INTERVAL 8 HOUR)"


def _local(ms: str) -> str:
    return LOCAL.format(ms=ms)


def _frac(lt: str) -> str:
    us = f"(microsecond({lt}) % 1000000)"
    return (f"CASE WHEN {us} = 0 THEN '' ELSE '.' || rtrim(lpad(CAST({us} AS VARCHAR), 6, '0'), '0') END")


def _day(ms: str) -> str:
    stt = f"(({ms}) // {DAY}) * {DAY}"
    return f"{stt} AS stt, {stt} + {DAY} AS edt, strftime(make_timestamp({stt} * 1000), '%Y-%m-%d') AS cur_date"


PAGE_BASE = f"""
  plog AS ({AD['page_log']}),
  pbase AS (SELECT {_day('ts')}, coalesce(uid, '-1') AS uid, vc, ch, ar, is_new, sid, page_id, item_type,
                   during_time FROM plog WHERE has_common)"""

USER_FIELDS = 7
BODY_FIELDS = 5
ORDER_FIELDS = 8
DETAIL_FIELDS = 8

SQL.update({
    "time_period": f"""
WITH t AS (SELECT id, CASE WHEN id % 101 = 0 THEN 'garbage'
                   WHEN id % 3 = 0 THEN CAST(create_time + id % 1000 AS VARCHAR)
                   WHEN id % 3 = 1 THEN strftime({_local('create_time')}, '%Y-%m-%d %H:%M:%S')
                   ELSE strftime({_local('create_time')}, '%H:%M:%S') END AS text
           FROM ({AD['order_info']})),
     p AS (SELECT id, text, CASE WHEN regexp_full_match(text, '[+-]?[0-9]+') THEN {_local('text')}
                  ELSE coalesce(try_strptime(text, '%Y-%m-%d %H:%M:%S'),
                                try_strptime('1970-01-01 ' || text, '%Y-%m-%d %H:%M:%S')) END AS lt FROM t)
SELECT id, text, CASE WHEN lt IS NULL THEN NULL ELSE strftime(lt, '%H:%M:%S') || {_frac('lt')} END AS parsed_time,
       {day_period_sql('hour(lt)')} AS time_period, CAST(hour(lt) AS INTEGER) AS hour FROM p""",
    "date_formats": f"""
WITH l AS (SELECT id, ts_ms, {_local('ts_ms')} AS lt FROM ({AD['order_info']}))
SELECT id, ts_ms, strftime(lt, '%Y-%m-%d %H:%M:%S') AS dt, strftime(lt, '%Y-%m-%d') AS d,
       strftime(lt, '%Y%m%d') AS ymd,
       epoch_us(strptime(strftime(lt, '%Y-%m-%d %H:%M:%S'), '%Y-%m-%d %H:%M:%S')) // 1000 - 28800000 AS back_ms,
       epoch_us(CAST(CAST(lt AS DATE) AS TIMESTAMP)) // 1000 - 28800000 AS day_ms
FROM l""",
    "cdc_parse": f"""
SELECT 'user_info' AS tbl, 'r' AS op, ts_ms, id, {USER_FIELDS} AS n_fields, false AS is_bad FROM ({AD['user_info']})
UNION ALL SELECT 'user_info_sup_msg', 'r', ts_ms, uid, {BODY_FIELDS}, false FROM ({AD['user_sup_msg']})
UNION ALL SELECT 'order_info', 'r', ts_ms, id, {ORDER_FIELDS}, false FROM ({AD['order_info']})
UNION ALL SELECT 'order_detail', 'r', ts_ms, id, {DETAIL_FIELDS}, false FROM ({AD['order_detail']})
UNION ALL SELECT 'user_info', 'd', ts_ms, id, NULL, false FROM ({AD['user_info']}) WHERE id % 61 = 0
UNION ALL SELECT NULL, NULL, NULL, NULL, NULL, true FROM customer WHERE c_custkey % {A.BAD_EVERY} = 0""",
    "cdc_route": with_(ENRICHED) + f"""
SELECT 'user_info' AS tbl, id, age_group AS v FROM users
UNION ALL SELECT 'user_info_sup_msg', uid, CAST(height AS VARCHAR) FROM ({AD['user_sup_msg']})
UNION ALL SELECT 'order_info', id, {price_band_sql('total_amount')} FROM ({AD['order_info']})
UNION ALL SELECT 'order_detail', id, CAST(sku_num AS VARCHAR) FROM ({AD['order_detail']})""",
    "cdc_snapshot": f"""
WITH o AS (SELECT id, CAST(user_id AS VARCHAR) AS user_id, order_status, CAST(total_amount AS VARCHAR) AS total_amount,
                  'c' || CAST(user_id AS VARCHAR) AS consignee, CAST(province_id AS VARCHAR) AS province_id, ts_ms
           FROM ({AD['order_info']})),
h AS (SELECT id, 'c' AS op, ts_ms * 100 + 1 AS w, user_id, order_status, total_amount, consignee, province_id FROM o
      UNION ALL SELECT id, 'u', (ts_ms + {HOUR}) * 100 + 2, user_id, '1002', total_amount, '', province_id FROM o WHERE id % 3 = 0
      UNION ALL SELECT id, 'd', (ts_ms + {2 * HOUR}) * 100 + 3, NULL, NULL, NULL, NULL, NULL FROM o WHERE id % 10 = 3
      UNION ALL SELECT id, 'c', (ts_ms + {3 * HOUR}) * 100 + 4, user_id, 'R', NULL, NULL, NULL FROM o WHERE id % 20 = 3
      UNION ALL SELECT id, 'd', (ts_ms + {4 * HOUR}) * 100 + 5, NULL, NULL, NULL, NULL, NULL FROM o WHERE id % 20 = 7
      UNION ALL SELECT id, 'c', (ts_ms + {4 * HOUR}) * 100 + 6, user_id, 'Q', NULL, NULL, NULL FROM o WHERE id % 20 = 7
      UNION ALL SELECT id, 'u', (ts_ms + {5 * HOUR}) * 100 + 7, user_id, 'zzz', NULL, 'zzz', NULL FROM o WHERE id % 15 = 4
      UNION ALL SELECT id, 'u', (ts_ms + {5 * HOUR}) * 100 + 8, user_id, 'aaa', NULL, 'aaa', NULL FROM o WHERE id % 15 = 4
      UNION ALL SELECT id, 'c', ts_ms * 100 + 1, user_id, order_status, total_amount, consignee, province_id FROM o WHERE id % 7 = 0),
k AS (SELECT id, max(w) FILTER (WHERE op = 'd') AS last_del, arg_max(op, w) AS last_op FROM h GROUP BY id),
live AS (SELECT h.* FROM h JOIN k USING (id) WHERE k.last_op <> 'd' AND h.op <> 'd'
         AND h.w > coalesce(k.last_del, -1))
SELECT id,
  arg_max(user_id, w) FILTER (WHERE user_id <> '') AS user_id,
  arg_max(order_status, w) FILTER (WHERE order_status <> '') AS order_status,
  arg_max(total_amount, w) FILTER (WHERE total_amount <> '') AS total_amount,
  arg_max(consignee, w) FILTER (WHERE consignee <> '') AS consignee,
  arg_max(province_id, w) FILTER (WHERE province_id <> '') AS province_id
FROM live GROUP BY id""",
    "dim_routing": f"""
SELECT 'dim_user' AS topic, CAST(id AS VARCHAR) AS row_key,
       'gender=' || coalesce(gender, 'null') || ';id=' || CAST(id AS VARCHAR) || ';name=' || coalesce(name, 'null')
       || ';user_level=' || coalesce(CAST(user_level AS VARCHAR), 'null') AS fields, 'r' AS op FROM ({AD['user_info']})
UNION ALL SELECT 'dim_order', CAST(id AS VARCHAR), 'id=' || CAST(id AS VARCHAR) || ';order_status=' || order_status
       || ';user_id=' || CAST(user_id AS VARCHAR), 'r' FROM ({AD['order_info']})
UNION ALL SELECT 'dim_user_body', CAST(uid AS VARCHAR), 'height=' || CAST(height AS VARCHAR) || ';uid=' || CAST(uid AS VARCHAR)
       || ';weight=' || CAST(weight AS VARCHAR), 'r' FROM ({AD['user_sup_msg']})
UNION ALL SELECT 'dim_user', CAST(id AS VARCHAR), NULL, 'd' FROM ({AD['user_info']}) WHERE id % 61 = 0""",
    "camel_columns": with_(ENRICHED) + """
SELECT id, birthday, birth_year AS birthYear, age, zodiac_sign AS zodiacSign, age_group AS ageGroup, gender,
       name, login_name AS loginName, user_level AS userLevel, create_time AS createTime, ts_ms AS tsMs FROM users""",
    "sql_template": f"""
SELECT o.id, o.order_status, d.dic_name, o.ts_ms AS et_ms
FROM ({AD['order_info']}) o LEFT JOIN ({AD['base_dic']}) d ON substr(o.order_priority, 1, 1) = d.dic_code""",
    "metric_traffic": with_(PAGE_BASE) + """
SELECT stt, edt, cur_date, vc, ch, ar, is_new, count(DISTINCT uid) AS uv_ct, count(DISTINCT sid) AS sv_ct,
       count(*) AS pv_ct, CAST(sum(during_time) AS BIGINT) AS dur_sum
FROM pbase GROUP BY stt, edt, cur_date, vc, ch, ar, is_new""",
    "metric_home_detail": with_(PAGE_BASE) + """
SELECT stt, edt, cur_date, count(DISTINCT CASE WHEN page_id = 'home' THEN uid END) AS home_uv_ct,
       count(DISTINCT CASE WHEN page_id = 'good_detail' THEN uid END) AS good_detail_uv_ct
FROM pbase WHERE page_id IN ('home', 'good_detail') AND uid <> '' GROUP BY stt, edt, cur_date""",
    "metric_login": with_(PAGE_BASE) + f""",
  days AS (SELECT DISTINCT uid, stt, edt, cur_date FROM pbase WHERE uid <> ''),
  lagged AS (SELECT *, lag(stt) OVER (PARTITION BY uid ORDER BY stt) AS prev FROM days)
SELECT stt, edt, cur_date, count(*) AS uu_ct,
       CAST(sum(CASE WHEN prev IS NOT NULL AND stt - prev >= {3 * DAY} THEN 1 ELSE 0 END) AS BIGINT) AS back_ct
FROM lagged GROUP BY stt, edt, cur_date""",
    "metric_cart": with_(PAGE_BASE) + """
SELECT stt, edt, cur_date, count(DISTINCT uid) AS cart_add_uu_ct FROM pbase
WHERE item_type = 'sku_id' AND uid <> '' GROUP BY stt, edt, cur_date""",
    "metric_payment": f"""
WITH days AS (SELECT DISTINCT user_id, {_day('ts_ms')} FROM ({AD['order_info']})),
     f AS (SELECT *, min(stt) OVER (PARTITION BY user_id) AS first FROM days)
SELECT stt, edt, cur_date, count(*) AS payment_uu_ct, CAST(sum(CASE WHEN stt = first THEN 1 ELSE 0 END) AS BIGINT) AS new_payer_ct
FROM f GROUP BY stt, edt, cur_date""",
    "metric_province": f"""
WITH a AS (SELECT {_day('ts_ms')}, province_id, count(DISTINCT id) AS order_count,
                  sum(CAST(round(total_amount * 100) AS BIGINT)) AS cents
           FROM ({AD['order_info']}) GROUP BY ALL)
SELECT a.stt, a.edt, a.cur_date, a.province_id, coalesce(n.n_name, '') AS province_name, a.order_count,
       CAST(a.cents AS DOUBLE) / 100 AS order_amount
FROM a LEFT JOIN nation n ON CAST(a.province_id AS VARCHAR) = CAST(n.n_nationkey AS VARCHAR)""",
    "metric_sku": f"""
WITH l AS (SELECT DISTINCT * FROM ({AD['order_detail']})),
a AS (SELECT {_day('ts_ms')}, sku_id, sum(original_cents) AS o, sum(activity_cents) AS a, sum(coupon_cents) AS c
      FROM l GROUP BY ALL)
SELECT a.stt, a.edt, a.cur_date, a.sku_id, CAST(a.o AS DOUBLE) / 100 AS original_amount,
       CAST(a.a AS DOUBLE) / 100 AS activity_amount, CAST(a.c AS DOUBLE) / 100 AS coupon_amount,
       CAST(a.o - a.a - a.c AS DOUBLE) / 100 AS order_amount,
       s.sku_name, s.tm_id, s.category3_id, t.tm_name, c3.name AS category3_name, c3.category2_id,
       c2.name AS category2_name, c2.category1_id, c1.name AS category1_name
FROM a
LEFT JOIN ({AD['dim_sku']}) s ON CAST(a.sku_id AS VARCHAR) = s.id
LEFT JOIN ({AD['dim_trademark']}) t ON s.tm_id = t.id
LEFT JOIN ({AD['dim_category3']}) c3 ON s.category3_id = c3.id
LEFT JOIN ({AD['dim_category2']}) c2 ON c3.category2_id = c2.id
LEFT JOIN ({AD['dim_category1']}) c1 ON c2.category1_id = c1.id""",
})

SQL["bean_json"] = f"""
WITH m AS ({SQL['metric_province']})
SELECT json_object('stt', stt, 'edt', edt, 'cur_date', cur_date, 'province_id', province_id,
                   'province_name', province_name, 'order_count', order_count,
                   'order_amount', CAST(order_amount AS DECIMAL(18,2)))::VARCHAR AS json FROM m"""


# Streams whose rows equal a batch query's rows share its SQL.
SQL["stream_profile"] = SQL["running_profile"]
SQL["stream_page_profile"] = SQL["device_score"]
SQL["stream_dedup"] = SQL["page_dedup"]
SQL["stream_interval_join"] = SQL["user_body_join"]
SQL["stream_upsert"] = SQL["cdc_snapshot"]
SQL["stream_topic_sink"] = SQL["dim_routing"]
SQL["stream_wide_orders"] = SQL["order_user_join"]
SQL["stream_price_pairs"] = with_(ENRICHED) + f"""
SELECT p.age_group, p.price_interval, CAST(w.weight AS DOUBLE) AS weight FROM (
  SELECT u.age_group, {price_band_sql('o.total_amount')} AS price_interval
  FROM users u JOIN ({AD['order_info']}) o
    ON o.user_id = u.id AND o.ts_ms BETWEEN u.ts_ms - {DAY} AND u.ts_ms + 60000
  WHERE o.total_amount IS NOT NULL) p
JOIN {PRICE_W} w ON w.price_interval = p.price_interval AND w.age_group = p.age_group"""
SQL["stream_age_label"] = SQL["age_label_as_run"]
SQL["stream_watermark_join"] = SQL["user_body_join"]
SQL["stream_olap_sink"] = f"SELECT id, user_id, total_amount FROM ({AD['order_info']})"
SQL["stream_text_sink"] = SQL["stream_olap_sink"]
SQL["stream_dim_enrich"] = SQL["dim_left_join"]
SQL["query_rows"] = "SELECT CAST(n_nationkey AS VARCHAR) AS dimId, n_name AS dimName, n_regionkey AS parentId FROM nation"
SQL["stream_metric_traffic"] = SQL["metric_traffic"]
SQL["stream_metric_home_detail"] = SQL["metric_home_detail"]
SQL["stream_metric_cart"] = SQL["metric_cart"]
SQL["stream_metric_sku"] = SQL["metric_sku"]
SQL["stream_snapshot_log"] = """
SELECT o_orderkey AS id, CASE WHEN o_orderkey % 10 = 0 THEN 'Z' ELSE o_orderstatus END AS status, CAST(o_custkey AS BIGINT) AS user_id
FROM orders WHERE o_orderkey % 25 <> 0"""
SQL["stream_metric_login"] = SQL["metric_login"]
SQL["stream_metric_payment"] = SQL["metric_payment"]
SQL["stream_memory_sink"] = f"SELECT province_id, count(*) AS n FROM ({AD['order_info']}) GROUP BY province_id"
SQL["stream_wide_watermark"] = SQL["order_user_join"]
SQL["stream_search_score"] = SQL["search_score"]
SQL["stream_label_chain"] = SQL["age_label_as_run"]
SQL["stream_profile_slices"] = SQL["running_profile"]

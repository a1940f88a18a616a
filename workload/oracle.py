"""The registered queries as SQL over the same tables.

Written independently of the Spark plans; the tables of names below are its own, so that a wrong entry of the library shows.
"""

from __future__ import annotations

import ipaddress

from . import standins as t

ORACLE: dict[str, str] = {}

# What the results have to hold, as text. Provinces and banks are in the order of their rules.
PROVINCES = """河北 山西 辽宁 吉林 黑龙江 江苏 浙江 安徽 福建 江西 山东 河南 湖北 湖南 广东 海南
四川 贵州 云南 陕西 甘肃 青海 台湾 内蒙古 广西 西藏 宁夏 新疆 北京 天津 上海 重庆 香港 澳门""".split()
BANKS = [line.split() for line in """招 招商银行
工 工商银行
农 农业银行
建 建设银行
交 交通银行
民 民生银行
光 光大银行
兴 兴业银行
浦 上海浦东发展银行
广 广东发展银行
圳 深圳发展银行
平 平安银行
邮 中国邮政储蓄银行
夏 华夏银行
中信 中信银行
信 农村信用社
中国 中国银行
比 比特币
BTC 比特币
btc 比特币
CMB 招商银行
ABC 农业银行
CCB 建设银行
BOCOM 交通银行
渤海银行 渤海银行
ICBC 工商银行""".splitlines()]
PROVINCE_NAMES = [line.split() for line in """北京市 北京 京
天津市 天津 津
上海市 上海 沪
重庆市 重庆 渝
河北省 河北 冀
河南省 河南 豫
湖北省 湖北 鄂
湖南省 湖南 湘
江苏省 江苏 苏
江西省 江西 赣
辽宁省 辽宁 辽
吉林省 吉林 吉
黑龙江省 黑龙江 黑
陕西省 陕西 陕 秦
山西省 山西 晋
山东省 山东 鲁
四川省 四川 川 蜀
青海省 青海 青
安徽省 安徽 皖
海南省 海南 琼
广东省 广东 粤
贵州省 贵州 贵 黔
浙江省 浙江 浙
福建省 福建 闽
台湾省 台湾 台
甘肃省 甘肃 甘 陇
云南省 云南 云 滇
西藏自治区 西藏 藏
宁夏回族自治区 宁夏 宁
广西壮族自治区 广西 桂
新疆维吾尔自治区 新疆 新
内蒙古自治区 内蒙古 蒙
香港特别行政区 香港 港
澳门特别行政区 澳门 澳""".splitlines()]


def lit(value: object) -> str:
    if value is None:
        return "NULL"
    return "'" + value.replace("'", "''") + "'" if isinstance(value, str) else str(value)


def values(rows: list[tuple], alias: str) -> str:
    body = ", ".join("(" + ", ".join(lit(v) for v in row) + ")" for row in rows)
    return f"(VALUES {body}) AS {alias}"


def texts(items: tuple[str, ...] | list[str]) -> str:
    return "[" + ", ".join(lit(i) for i in items) + "]"


LOAD = lit(t.LOAD_TIME)
EVENTS = """(SELECT *, CAST(json_extract_string(props, '$.k') AS INTEGER) AS k,
    strftime(ts, '%Y-%m-%d') AS dt, strftime(ts, '%Y-%m-%dT%H:%M:%S.%g') || '+08:00' AS iso,
    CAST(strftime(ts, '%Y%m%d%H') AS BIGINT) AS hour_fk FROM events)"""


def money(x: str) -> str:
    """Through the shortest text of a number, as its binary value has more digits than were written."""
    return f"CAST(CAST({x} AS VARCHAR) AS DECIMAL(38,18))"


def double(x: str) -> str:
    """A decimal as the nearest double; the direct cast divides, and so may be off by one bit."""
    return f"CAST(CAST({x} AS VARCHAR) AS DOUBLE)"


def total(x: str) -> str:
    return double(f"sum({money(x)})")


# --- scans and filters -------------------------------------------------------------------------

ORACLE["scan_day"] = """
SELECT event_id, user_id, event_type, value FROM events
WHERE ts >= TIMESTAMP '2024-01-15' AND ts < TIMESTAMP '2024-01-16'"""

ORACLE["scan_range"] = """
SELECT event_id, user_id, event_type, value FROM events
WHERE ts >= TIMESTAMP '2024-01-05' AND ts < TIMESTAMP '2024-01-26'
  AND event_type IN ('click', 'purchase')"""

ORACLE["time_window_filter"] = f"""
SELECT event_id, split_part(iso, '+', 1) AS local_time FROM {EVENTS}
WHERE split_part(iso, '+', 1) >= '2024-01-10T00:00:00.000'
  AND split_part(iso, '+', 1) <= '2024-01-12T23:59:59.999'"""

ORACLE["hour_key"] = """
SELECT strftime(ts, '%Y-%m-%d-%H') AS full_date_hour, count(*) AS n FROM events GROUP BY 1"""

# --- scalar functions --------------------------------------------------------------------------

ORACLE["scalar_text"] = """
SELECT p_partkey, split_part(p_name, ' ', 1) AS first_word,
  CASE WHEN len(string_split(p_name, ' ')) > 3 THEN string_split(p_name, ' ')[4] END AS fourth_word,
  replace(p_brand, '#', '') AS brand, contains(p_name, 'bolt') AS is_bolt,
  substr(p_type, 1, 3) AS type_code,
  base64(encode(p_name || ' / ' || p_type || ' / ' || p_brand || ' / ' || p_name || ' / ' || p_name
    || ' / ' || p_name)) AS label,
  coalesce(TRY_CAST(split_part(p_brand, '#', 2) AS INTEGER), -1) AS brand_number,
  coalesce(TRY_CAST(p_type AS INTEGER), -1) AS type_number
FROM part"""

ORACLE["scalar_time"] = """
SELECT event_id,
  (epoch_ms(date_trunc('milliseconds', ts)) - epoch_ms(date_trunc('day', ts))) / 1000.0::DOUBLE AS seconds_of_day,
  CAST(12 * hour(ts) + minute(ts) // 5 + 1 AS INTEGER) AS bucket,
  ['子','丑','寅','卯','辰','巳','午','未','申','酉','戌','亥'][((hour(ts) + 1) // 2) % 12 + 1] AS two_hours,
  strftime(ts, '%Y-%m-%dT%H:%M:%S') || '.000+08:00' AS iso_seconds,
  strftime(ts - INTERVAL 7 DAY, '%Y-%m-%d') AS week_before,
  CAST(DATE '2024-02-01' - CAST(ts AS DATE) AS INTEGER) AS age
FROM events"""

ORACLE["scalar_json"] = f"""
SELECT event_id, k, '{{"k":' || k || ',"event_type":"' || event_type || '"}}' AS props_out FROM {EVENTS}"""

_SHORT = [short for _, *names in PROVINCE_NAMES for short in names] + ["abroad"]
_FULL = [full for full, *names in PROVINCE_NAMES for _ in names] + ["abroad"]
ORDER_LOG = f"""(SELECT 'A0' || (o_custkey % 3 + 1) AS product_id, o_custkey AS customer_id,
    strftime(o_orderdate, '%Y-%m-%d') AS dt,
    CAST(strftime(o_orderdate, '%Y%m%d') AS BIGINT) * 100 + o_orderkey % 24 AS hour_fk,
    CASE o_orderstatus WHEN 'O' THEN 1 WHEN 'F' THEN 2 ELSE 3 END AS currency,
    CASE o_orderpriority WHEN '1-URGENT' THEN '111101' WHEN '2-HIGH' THEN '111106'
      WHEN '5-LOW' THEN '999999' ELSE '111105' END AS code,
    {texts(t.SUB_TYPES)}[o_orderkey % 7 + 1] AS sub, CAST(CAST(o_totalprice AS DECIMAL(18,2)) AS VARCHAR) || lpad(CAST(o_orderkey % 1000000 AS VARCHAR), 6, '0') AS amount
    FROM orders)"""
CHANNEL = """CASE code WHEN '111101' THEN 1 WHEN '111106' THEN 2 ELSE
    CASE sub WHEN 'bitcoin' THEN 3 WHEN 'cubitpay' THEN 3 WHEN 'card' THEN 4 WHEN 'mobile' THEN 5
      WHEN 'qrcode' THEN 6 WHEN 'pay' THEN 7 ELSE 8 END END"""
ORACLE["scalar_codes"] = f"""
SELECT {texts(_FULL)}[o_orderkey % {len(_SHORT)} + 1] AS label, count(*) AS n, 'province' AS kind
FROM orders GROUP BY 1
UNION ALL
SELECT CAST({CHANNEL} AS VARCHAR), count(*), 'channel' FROM {ORDER_LOG} GROUP BY 1
UNION ALL
SELECT CAST((1 + CAST(trunc(greatest(CAST(amount AS DOUBLE) - 100000, 0) / 100) AS BIGINT)) * 100 AS VARCHAR), count(*), 'hundred'
FROM {ORDER_LOG} GROUP BY 1"""

# --- hourly facts ------------------------------------------------------------------------------

_USER = "'A0' || (user_id % 3 + 1) || '_u' || user_id"

ORACLE["login_hourly"] = f"""
SELECT hour_fk AS date_hour_fk, {_USER} AS user_fk, count(*) AS login_count, {LOAD} AS load_time, dt
FROM {EVENTS} WHERE event_type <> 'click' GROUP BY 1, 2, 5"""

ORACLE["login_device_hourly"] = f"""
SELECT hour_fk AS date_hour_fk, {_USER} AS user_fk,
  CASE WHEN k BETWEEN 0 AND 17 THEN CAST(k AS VARCHAR) ELSE '-1' END AS login_device,
  count(*) AS login_count, {LOAD} AS load_time, dt
FROM {EVENTS} WHERE event_type <> 'click' GROUP BY 1, 2, 3, 6"""

ORACLE["login_domain_hourly"] = f"""
SELECT CAST(strftime(login_at, '%Y%m%d%H') AS BIGINT) AS date_hour_fk,
  'A0' || (page_id % 3 + 1) || '_p' || (page_id % 50) AS user_fk,
  CASE WHEN contains(url, 'spam-farm.example.org') THEN 'spam-farm.example.org'
    WHEN contains(url, 'example.net') THEN 'example.net'
    WHEN url LIKE 'http%' THEN split_part(regexp_replace(url, '^https?://', ''), '/', 1)
    ELSE url END AS login_domain,
  count(*) AS login_count, {LOAD} AS load_time, strftime(login_at, '%Y-%m-%d') AS dt
FROM (SELECT *, TIMESTAMP '2024-01-01' + to_seconds(page_id * 7919 % 2592000) AS login_at FROM pages)
GROUP BY 1, 2, 3, 6"""

ORACLE["login_platform_hourly"] = f"""
SELECT hour_fk AS date_hour_fk, {_USER} AS user_fk,
  CASE event_type WHEN 'signup' THEN 'Agin' WHEN 'purchase' THEN 'Playtech' ELSE 'other' END AS platform,
  count(*) AS login_count, {LOAD} AS load_time, dt
FROM {EVENTS} WHERE event_type NOT IN ('view', 'click') GROUP BY 1, 2, 3, 6"""

ORACLE["deposit_hourly"] = f"""
SELECT hour_fk AS date_hour_fk,
  product_id || '_' || CASE WHEN c_custkey IS NULL THEN 'null' ELSE 'c' || c_custkey END AS user_fk,
  CAST({CHANNEL} AS INTEGER) AS deposit_channel_fk, CAST(currency AS INTEGER) AS currency,
  count(*) AS deposit_count, {total('amount')} AS deposit_amount, {LOAD} AS load_time, dt
FROM {ORDER_LOG} LEFT JOIN (SELECT * FROM customer WHERE c_acctbal > 0) ON customer_id = c_custkey
WHERE code <> '999999' GROUP BY 1, 2, 3, 4, 8"""

LINE_LOG = """(SELECT 'A0' || (l_suppkey % 3 + 1) || '_'
      || CASE WHEN s_suppkey IS NULL THEN 'null' ELSE 's' || s_suppkey END AS user_fk,
    strftime(l_shipdate, '%Y-%m-%d') AS dt,
    CAST(strftime(l_shipdate, '%Y%m%d') AS BIGINT) * 100 + l_orderkey % 24 AS hour_fk,
    CASE l_linestatus WHEN 'O' THEN 1 ELSE 2 END AS currency, l_returnflag AS flag,
    CAST(l_extendedprice AS DECIMAL(18,2)) AS amount,
    CASE l_returnflag WHEN 'N' THEN 1 ELSE -1 END AS sign
  FROM lineitem LEFT JOIN (SELECT * FROM supplier WHERE s_acctbal > 0) ON l_suppkey = s_suppkey)"""

ORACLE["withdraw_hourly"] = f"""
SELECT hour_fk AS date_hour_fk, user_fk, CAST(currency AS INTEGER) AS currency,
  CAST(sum(sign) AS INTEGER) AS withdraw_count, CAST(sum(sign * amount) AS DOUBLE) AS withdraw_amount,
  greatest(CAST(max(sign * amount) AS DOUBLE), 0.0::DOUBLE) AS withdraw_max,
  greatest(CAST(min(sign * amount) AS DOUBLE), 0.0::DOUBLE) AS withdraw_min, {LOAD} AS load_time, dt
FROM {LINE_LOG} GROUP BY 1, 2, 3, 9"""

ORACLE["rebate_hourly"] = f"""
SELECT hour_fk AS date_hour_fk, user_fk, CAST(currency AS INTEGER) AS currency,
  CAST(count(*) AS INTEGER) AS xima_count, CAST(sum(amount) AS DOUBLE) AS xima_amount,
  CAST(max(amount) AS DOUBLE) AS xima_max, CAST(min(amount) AS DOUBLE) AS xima_min,
  {LOAD} AS load_time, dt
FROM {LINE_LOG} WHERE flag IN ('R', 'A') GROUP BY 1, 2, 3, 9"""

ORACLE["dim_lookup_strict"] = """
SELECT n_name AS nation, count(*) AS orders,
  (SELECT count(*) FROM customer WHERE c_nationkey NOT IN (SELECT n_nationkey FROM nation)) AS misses
FROM orders JOIN customer ON o_custkey = c_custkey JOIN nation ON c_nationkey = n_nationkey GROUP BY 1"""

# --- rates and statistics ----------------------------------------------------------------------

_WON = ("(CAST(l_quantity AS DECIMAL(18,2)) * (CAST(l_discount AS DECIMAL(4,2)) - 0.05)"
        " + CAST(l_orderkey % 1000 AS DECIMAL(10,0)) * 0.00000001)")
_VALID = "CASE WHEN l_discount > 0.02 THEN l_extendedprice ELSE 0 END"


def rate(num: str, den: str) -> str:
    return f"({num}) / nullif({den}, 0)"


ORACLE["user_return_rate"] = f"""
SELECT 'A0' || (l_suppkey % 3 + 1) AS product_id, 'A0' || (l_suppkey % 3 + 1) || '_u' || l_suppkey AS user_id,
  'G' || (l_partkey % 25) AS game_platform_fk,
  round({rate(total(_WON), total(_VALID))}, 9) AS return_rate, {LOAD} AS load_time,
  '2024-01-31' AS snapshot_date
FROM lineitem GROUP BY 1, 2, 3"""

ORACLE["zodiac_return"] = f"""
SELECT product_platform_sk, game_platform_sk, zodiac, chinese_zodiac, CAST(month AS INTEGER) AS month,
  ['子','丑','寅','卯','辰','巳','午','未','申','酉','戌','亥'][((h + 1) // 2) % 12 + 1] AS ancient_chinese_hour,
  round({rate(total('value - 50'), total("CASE event_type WHEN 'error' THEN 0 ELSE value END"))}, 6) AS return_rate,
  split_part(product_platform_sk, '_', 1) AS product_id, {LOAD} AS load_time, '2024-01-31' AS snapshot_date
FROM (
  SELECT *, 'A0' || (user_id % 3 + 1) || '_P' || (k % 4) AS product_platform_sk,
    event_type AS game_platform_sk, 'N' || c_nationkey AS zodiac, c_mktsegment AS chinese_zodiac,
    month(ts) AS month, hour(ts) AS h
  FROM {EVENTS} LEFT JOIN (SELECT * FROM customer WHERE c_acctbal > 0) ON user_id = c_custkey)
GROUP BY product_platform_sk, game_platform_sk, zodiac, chinese_zodiac, month, h"""

ORACLE["game_daily_stats"] = f"""
WITH bets AS (
  SELECT 'G' || (l_partkey % 25) AS gametype, l_returnflag AS product_id, l_linestatus AS platform, o_custkey,
    {money('l_extendedprice')} AS account, {money(_VALID)} AS valid, {money(_WON)} AS won
  FROM lineitem JOIN orders ON l_orderkey = o_orderkey),
users AS (
  SELECT gametype, product_id, platform, o_custkey, sum(account) AS account, sum(valid) AS valid,
    sum(won) AS won, count(*) AS n,
    {rate('-' + double('sum(won)'), double('sum(valid)'))} AS rate
  FROM bets GROUP BY 1, 2, 3, 4),
rated AS (
  SELECT gametype, product_id, platform, avg(rate) AS rate_mean, median(rate) AS rate_median,
    stddev_samp(rate) AS rate_std, max(rate) AS rate_max, min(rate) AS rate_min,
    {double('sum(account)')} / count(*) AS money_mean, stddev_samp({double('account')}) AS money_std,
    median({double('account')}) AS money_median, avg(CAST(n AS DOUBLE)) AS cnt_mean,
    median(CAST(n AS DOUBLE)) AS cnt_median, stddev_samp(CAST(n AS DOUBLE)) AS cnt_std
  FROM users WHERE rate IS NOT NULL GROUP BY 1, 2, 3),
groups AS (
  SELECT gametype, product_id, platform, count(DISTINCT o_custkey) AS member_cnt, sum(account) AS account,
    sum(valid) AS valid, sum(won) AS won, max(won) AS won_max, min(won) AS won_min,
    max(account) AS bet_max, count(*) AS n
  FROM bets GROUP BY 1, 2, 3),
games AS (
  SELECT DISTINCT 'G' || (p_partkey % 25) AS gametype, s AS platform
  FROM part, (VALUES ('O'), ('F')) AS v(s) WHERE p_size < 40)
SELECT CASE WHEN games.gametype IS NOT NULL THEN 'GP_' || games.gametype || '_' || games.platform END
    AS game_platform_sk,
  CASE WHEN product_id IN ('N', 'R') THEN product_id || '_' || groups.platform END AS product_platform_sk,
  member_cnt, {double('account')} AS monetary, {double('valid')} AS valid_monetary,
  round({rate('-' + double('won'), double('valid'))}, 9) AS return_rate,
  round(rate_mean, 9) AS return_rate_mean, round(rate_median, 9) AS return_rate_median,
  round(rate_std, 9) AS return_rate_std, round(rate_max, 9) AS return_rate_max,
  round(rate_min, 9) AS return_rate_min, {double('won_max')} AS return_max,
  {double('won_min')} AS return_min, {double('bet_max')} AS bet_max,
  round({double('account')} / n, 4) AS bet_avg, round(money_mean, 4) AS monetary_mean,
  round(money_std, 4) AS monetary_std, round(money_median, 4) AS monetary_median,
  round(cnt_mean, 4) AS cnt_mean, round(cnt_median, 4) AS cnt_median, round(cnt_std, 4) AS cnt_std,
  {LOAD} AS load_time, '2024-01-31' AS snapshot_date
FROM groups LEFT JOIN rated USING (gametype, product_id, platform)
LEFT JOIN games ON groups.gametype = games.gametype AND groups.platform = games.platform"""

ORACLE["game_daily_stats_large"] = ORACLE["game_daily_stats"]

INTRADAY = f"""(
  SELECT *, CAST(sum(stake) OVER w AS DOUBLE) AS monetary, CAST(sum(back) OVER w AS DOUBLE) AS "return"
  FROM (
    SELECT 'A0' || (user_id % 3 + 1) AS product_id, 'AGQJ' AS platform, event_type AS gametype, dt AS exec_date,
      CAST(12 * hour(ts) + minute(ts) // 5 + 1 AS INTEGER) AS plot_time_label,
      sum({money('value')}) AS stake,
      sum({money('value')} + {money('CASE WHEN k % 2 = 0 THEN value ELSE -value END')}) AS back
    FROM {EVENTS} GROUP BY 1, 2, 3, 4, 5)
  WINDOW w AS (PARTITION BY product_id, platform, gametype, exec_date ORDER BY plot_time_label))"""

ORACLE["intraday_return"] = f"""
SELECT product_id, platform, gametype, exec_date, plot_time_label, monetary, "return",
  round("return" / nullif(monetary, 0), 9) AS rate FROM {INTRADAY}"""

ORACLE["return_stats"] = f"""
SELECT product_id, platform, gametype, exec_date, round(max(r), 6) AS "max", round(min(r), 6) AS "min",
  round(stddev_samp(r), 6) AS std, round(avg(r), 6) AS "avg", round(quantile_cont(r, 0.5), 6) AS median,
  round(quantile_cont(r, 0.25), 6) AS q1, round(quantile_cont(r, 0.95), 6) AS p95
FROM (SELECT *, "return" / nullif(monetary, 0) AS r FROM {INTRADAY}) GROUP BY 1, 2, 3, 4"""

ORACLE["active_days"] = f"""
SELECT 'A01_r' || user_id AS user_fk, count(DISTINCT dt) AS cnt_30,
  count(DISTINCT CASE WHEN dt >= '2024-01-24' THEN dt END) AS cnt_7
FROM {EVENTS} WHERE dt BETWEEN '2024-01-01' AND '2024-01-30' GROUP BY 1"""

ORACLE["net_profit_rate"] = f"""
SELECT 'A01_r' || l_suppkey AS user_fk, {total('l_extendedprice')} AS dep_sum,
  CAST(coalesce(any_value(out), 0) AS DOUBLE) AS withdraw_sum,
  round(CAST(sum({money('l_extendedprice')}) - coalesce(any_value(out), 0) AS DOUBLE)
    / nullif({total('l_extendedprice')}, 0), 9) AS net_profit_rate
FROM lineitem LEFT JOIN (SELECT l_suppkey AS s, sum({money('l_extendedprice')}) AS out FROM lineitem
  WHERE l_returnflag <> 'N' GROUP BY 1) ON l_suppkey = s
WHERE l_returnflag = 'N' GROUP BY l_suppkey"""

GAMMA = """
daily AS (
  SELECT 'A01_r' || o_custkey AS user_fk, o_orderdate, CAST(sum(CAST(o_totalprice AS DECIMAL(18,2))) AS DOUBLE) AS dep
  FROM orders GROUP BY 1, 2),
moments AS (
  SELECT user_fk, count(*) AS cnt, avg(dep) AS m, var_samp(dep) AS v, median(dep) AS dep_median
  FROM daily GROUP BY 1 HAVING count(*) > 1 AND var_samp(dep) <> 0),
params AS (SELECT *, m * m / v AS alpha, m / v AS beta FROM moments),
shape AS (SELECT *, (alpha - 1) / beta AS mode, alpha * (15 * alpha - 4) / (beta * (15 * alpha + 1)) AS med FROM params),
border AS (
  SELECT *, CASE WHEN alpha > 1 THEN mode + sqrt(alpha - 1) / beta WHEN med > 0 THEN med ELSE alpha / beta END AS b
  FROM shape),
fit AS (
  SELECT *, (1 + CAST(trunc(b / 100) AS BIGINT)) * 100 AS bdry,
    (1 + CAST(trunc((b + b / (beta * b - alpha + 1)) / 100) AS BIGINT)) * 100 AS next_bdry
  FROM border)"""

ORACLE["gamma_segments"] = f"""
WITH {GAMMA}
SELECT user_fk, cnt, round(dep_median, 6) AS dep_median, round(alpha, 6) AS alpha, round(beta, 12) AS beta,
  round(mode, 6) AS mode, round(med, 6) AS median, bdry, next_bdry
FROM fit WHERE bdry < next_bdry"""

ORACLE["mission_ladder"] = f"""
WITH RECURSIVE {GAMMA},
net AS (
  SELECT 'A01_r' || o_custkey AS user_fk, {total('o_totalprice')} AS dep_sum,
    {double(f"coalesce(sum({money('o_totalprice')}) FILTER (WHERE o_orderstatus = 'P'), 0)")} AS withdraw_sum,
    CAST(sum({money('o_totalprice')})
      - coalesce(sum({money('o_totalprice')}) FILTER (WHERE o_orderstatus = 'P'), 0) AS DOUBLE)
      / nullif({total('o_totalprice')}, 0) AS rate
  FROM orders GROUP BY 1),
ages AS (
  SELECT 'A01_r' || c_custkey AS user_fk, DATE '2001-08-02' - (DATE '2001-06-01' + CAST(c_custkey % 60 AS INTEGER)) AS age
  FROM customer WHERE c_acctbal > 0),
active AS (
  SELECT 'A01_r' || o_custkey AS user_fk, count(DISTINCT o_orderdate) AS d30,
    count(DISTINCT CASE WHEN o_orderdate >= TIMESTAMP '2001-07-26' THEN o_orderdate END) AS d7
  FROM orders WHERE o_orderdate BETWEEN TIMESTAMP '2001-07-03' AND TIMESTAMP '2001-08-01' GROUP BY 1),
people AS (
  SELECT fit.*, coalesce(age, 0) AS age, coalesce(d30, 0) AS d30, coalesce(d7, 0) AS d7, dep_sum, withdraw_sum, rate,
    length(CAST(next_bdry AS VARCHAR)) - 1 AS steps
  FROM fit LEFT JOIN ages USING (user_fk) LEFT JOIN active USING (user_fk) LEFT JOIN net USING (user_fk)
  WHERE bdry < next_bdry AND (cnt > 10 OR coalesce(age, 0) < 30)),
targets AS (
  SELECT user_fk, steps, rate, j, (1 + CAST(trunc((j * next_bdry + (steps - j) * bdry) / CAST(steps AS DOUBLE) / 100)
    AS BIGINT)) * 100 AS target
  FROM (SELECT *, unnest(range(0, steps + 1)) AS j FROM people)),
ladder AS (
  SELECT user_fk, j, target, least(0.05::DOUBLE, (0.5::DOUBLE - 0.001::DOUBLE) * rate) AS r FROM targets WHERE j = 0
  UNION ALL
  SELECT t.user_fk, t.j, t.target, l.r * l.target * (1 + 0.15::DOUBLE) / t.target
  FROM ladder l JOIN targets t ON t.user_fk = l.user_fk AND t.j = l.j + 1),
bonuses AS (
  SELECT *, CAST(trunc(target * r / 50) AS BIGINT) * 10 + 8 AS raw,
    CAST(trunc(target * 0.001::DOUBLE) AS BIGINT) * 10 + 8 AS low FROM ladder),
sums AS (
  SELECT user_fk, '{{' || string_agg('"' || j || '":{{"deposit":' || target || ',"bonus":'
      || (CASE WHEN raw <= 0 THEN low ELSE raw END) || '}}', ',' ORDER BY j) || '}}' AS missions,
    CAST(sum(CASE WHEN raw <= 0 THEN low ELSE raw END) AS BIGINT) AS budget, CAST(sum(target) AS DOUBLE) AS deposits
  FROM bonuses GROUP BY 1)
SELECT user_fk AS user_id, round(beta, 12) AS beta, round(alpha, 6) AS alpha, round(mode, 6) AS mode,
  round(med, 6) AS median, bdry, next_bdry, missions, budget, cnt AS dep_cnt, CAST(age AS INTEGER) AS reg_act_days,
  d30 AS active_30_days, d7 AS active_7_days, round(dep_median, 6) AS dep_median, dep_sum, withdraw_sum,
  round(rate, 6) AS net_profit_rate, round(deposits * rate - budget, 4) AS expected_earn, 'A01' AS product_id,
  '{t.MISSION_RUN}' AS dt, CAST({t.MISSION_DAYS} AS INTEGER) AS renewal_period
FROM people JOIN sums USING (user_fk)"""

# --- sequences ---------------------------------------------------------------------------------

_HEDGED = """hedged AS (
  SELECT user_id, user_id || '_' || strftime(ts, '%Y%m%d%H') AS gmcode FROM events GROUP BY 1, 2
  HAVING bool_or(event_type = 'click') AND bool_or(event_type = 'purchase'))"""

ORACLE["hedged_rounds"] = f"WITH {_HEDGED} SELECT user_id, gmcode FROM hedged"

ORACLE["win_streak"] = f"""
WITH {_HEDGED},
rows AS (
  SELECT e.user_id, ts, event_id, event_type = 'error' OR h.user_id IS NOT NULL AS reset,
    event_type <> 'view' AND k >= 5 AND value <> 0 AS hit
  FROM {EVENTS} e LEFT JOIN hedged h ON e.user_id = h.user_id
    AND h.gmcode = e.user_id || '_' || strftime(ts, '%Y%m%d%H')),
runs AS (
  SELECT *, sum(CAST(reset AS INTEGER)) OVER (PARTITION BY user_id ORDER BY ts, event_id) AS run FROM rows),
best AS (
  SELECT user_id, max(hits) AS streak FROM (
    SELECT user_id, run, count(*) FILTER (WHERE hit AND NOT reset) AS hits FROM runs GROUP BY 1, 2) GROUP BY 1)
SELECT user_id, CAST(unnest(range(5, least(streak, 18) + 1)) AS INTEGER) AS streak FROM best WHERE streak >= 5"""

GAP = """
SELECT event_id, user_id, ms, ms - lag(ms) OVER (PARTITION BY user_id ORDER BY ms, event_id) AS gap
FROM (SELECT *, epoch_us(ts) // 1000 AS ms FROM events)"""
ORACLE["event_gap"] = GAP
ORACLE["stream_gap"] = GAP

ORACLE["stream_gap_restart"] = f"SELECT * REPLACE (CASE WHEN gap <= {t.STREAM_IDLE} THEN gap END AS gap) FROM ({GAP})"

ORACLE["stream_window"] = """
SELECT strftime(time_bucket(INTERVAL 20 SECONDS, ts), '%Y-%m-%d %H:%M:%S') AS window_start, event_type, count(*) AS n
FROM events GROUP BY 1, 2"""

ORACLE["stream_window_late"] = ORACLE["stream_window"]

# --- funnel, process monitoring, cleansing -----------------------------------------------------

ORACLE["funnel_tags"] = f"""
WITH config AS (SELECT * FROM {values(t.TAG_CONFIG, 'c(product_id, version, tag_name, tag)')}),
clicks AS (
  SELECT event_type AS tag, 'A0' || (user_id % 2 + 1) AS product_id, dt, 'T' || (k % 3) AS game_type,
    user_id || '-' || dt AS session, user_id % 3 = 0 AS visitor, user_id FROM {EVENTS}),
counts AS (
  SELECT product_id, dt, tag, game_type, count(*) FILTER (WHERE visitor) AS a,
    count(DISTINCT CASE WHEN visitor THEN session END) AS b, count(*) FILTER (WHERE NOT visitor) AS c,
    count(DISTINCT CASE WHEN NOT visitor THEN user_id END) AS d,
    count(DISTINCT CASE WHEN NOT visitor THEN session END) AS e
  FROM clicks GROUP BY 1, 2, 3, 4),
chosen AS (
  SELECT r.product_id, r.dt, max(version) AS version
  FROM (SELECT DISTINCT product_id, dt FROM clicks) r
  JOIN config c ON c.product_id = r.product_id AND c.version <= CAST(replace(r.dt, '-', '') AS INTEGER)
  GROUP BY 1, 2),
tags AS (SELECT DISTINCT product_id, dt, tag, tag_name FROM chosen JOIN config USING (product_id, version)),
joined AS (
  SELECT coalesce(tag_name, '其他') AS label, product_id, dt, coalesce(game_type, '0') AS game_type,
    coalesce(a, 0) AS a, coalesce(b, 0) AS b, coalesce(c, 0) AS c, coalesce(d, 0) AS d, coalesce(e, 0) AS e
  FROM counts FULL JOIN tags USING (product_id, dt, tag))
SELECT base64(encode(split_part(label, '_', 1))) AS tag_name,
  coalesce(TRY_CAST(trim(replace(split_part(label, '_', 2), 'step', '')) AS INTEGER), 0) AS tag_step,
  CASE WHEN len(string_split(label, '_')) > 2 THEN base64(encode(split_part(label, '_', 3))) ELSE '' END AS tag_detail,
  CAST(sum(a) AS BIGINT) AS visitors_count, CAST(sum(b) AS BIGINT) AS session_count,
  CAST(sum(c) AS BIGINT) AS member_count, CAST(sum(d) AS BIGINT) AS member_unique_count,
  CAST(sum(e) AS BIGINT) AS unique_session_member_count, game_type, product_id, dt AS full_date
FROM joined GROUP BY label, game_type, product_id, dt"""

ORACLE["config_kv"] = """
SELECT DISTINCT p_name AS tag_name, unnest([p_type, p_brand]) AS tag FROM part"""

ORACLE["asof_config"] = f"""
WITH daily AS (SELECT event_type, dt, count(*) AS n FROM {EVENTS} GROUP BY 1, 2),
versions AS (SELECT DISTINCT event_type, CAST(replace(dt, '-', '') AS INTEGER) AS version FROM {EVENTS} WHERE value > 200)
SELECT daily.event_type, dt, any_value(n) AS n, CAST(coalesce(max(version), 0) AS INTEGER) AS version
FROM daily LEFT JOIN versions ON daily.event_type = versions.event_type
  AND version <= CAST(replace(dt, '-', '') AS INTEGER)
GROUP BY 1, 2"""

ORACLE["asof_files"] = f"""
WITH weeks AS (
  SELECT event_type, CAST(strftime(date_trunc('week', ts), '%Y%m%d') AS INTEGER) AS version,
    'n' || (user_id % 7) AS tag_name, CAST(event_id % 11 AS VARCHAR) AS tag
  FROM events WHERE weekofyear(date_trunc('week', ts)) % 2 = 0 GROUP BY ALL),
days AS (SELECT DISTINCT event_type, dt FROM {EVENTS}),
chosen AS (
  SELECT days.event_type, dt, max(version) AS version FROM days JOIN weeks
  ON days.event_type = weeks.event_type AND version <= CAST(replace(dt, '-', '') AS INTEGER) GROUP BY 1, 2)
SELECT event_type AS product_id, version, dt AS day, tag_name, tag FROM chosen JOIN weeks USING (event_type, version)"""

IP = """CASE WHEN k = 0 THEN '' WHEN k = 1 THEN '36.' || (user_id % 64) || '.' || (event_id % 256) || '.7,10.0.0.1'
    WHEN k = 2 THEN 'fe80::' || printf('%x', event_id % 256) ELSE '36.' || (user_id % 64) || '.' || (event_id % 256) || '.' || k END"""


def ip_digits(text: str) -> str:
    """32 hexadecimal digits of an address, IPv4 as mapped into IPv6."""
    return f"{int(ipaddress.IPv6Address(f'::ffff:{text}' if '.' in text else text)):032x}"


RANGES = values(
    [(ip_digits(a), ip_digits(b), *names) for a, b, *names in t.IP_RANGES],
    "r(ip_from, ip_to, country, province, city)",
)


def ip_value(text: str) -> str:
    first = f"split_part({text}, ',', 1)"
    parts = [f"TRY_CAST(split_part({first}, '.', {i}) AS BIGINT)" for i in range(1, 5)]
    four = f"(({parts[0]} * 256 + {parts[1]}) * 256 + {parts[2]}) * 256 + {parts[3]}"
    return f"""CASE WHEN {first} LIKE 'fe80::%' THEN 'fe80' || repeat('0', 24) || lpad(split_part({first}, '::', 2), 4, '0')
      ELSE repeat('0', 20) || 'ffff' || printf('%08x', {four}) END"""


_PROVINCE = (
    "CASE province WHEN '北京' THEN '北京市' WHEN '广东' THEN '广东省' WHEN '内蒙古' THEN '内蒙古自治区'"
    " WHEN '浙江' THEN '浙江省' WHEN '沪' THEN '上海市' ELSE province END"
)
PLACES = f"""places AS (
  SELECT ip_from, ip_to, coalesce(country, '未知') AS country, coalesce({_PROVINCE}, '未知') AS province,
    coalesce(CASE WHEN contains(city, '市') THEN city ELSE city || '市' END, '未知') AS city FROM {RANGES})"""

ORACLE["ip_enrich"] = f"""
WITH {PLACES}, points AS (SELECT event_id, {IP} AS ip FROM {EVENTS})
SELECT event_id, ip, coalesce(country, '未知') AS country, coalesce(province, '未知') AS province,
  coalesce(city, '未知') AS city
FROM points LEFT JOIN places ON {ip_value('ip')} BETWEEN ip_from AND ip_to"""

_STEP_ROWS = []
for _key, _value in t.STEP_LINES:
    _name, _step, _detail = _value.split(",")
    _good = _step.isdigit()
    _STEP_ROWS.append((*_key.split(","), _name, int(_step) if _good else None, _detail if _good else None))

STEPS = f"""{PLACES},
config AS (SELECT * FROM {values(_STEP_ROWS, 's(tag_id, hierarchy, referer, tag_name, tag_step, tag_detail)')}),
staged AS (
  SELECT event_id, epoch_us(ts) // 1000 AS ms, hour_fk, 'A04' AS product_id, 'web' AS platform, 's' || user_id AS session_id,
    dt AS procedure_id, CASE WHEN user_id % 3 = 0 THEN 'null' ELSE 'u' || user_id END AS user_id,
    CAST(k % 4 AS INTEGER) AS star_level, 'h' || (k % 2) AS hierarchy, event_type AS tag_id,
    '/' || event_type AS page_url, 'r' || (k % 5) AS referer, iso AS click_time, {IP} AS ip,
    CASE WHEN k % 3 = 0 THEN '36.' || (k % 64) || '.9.9' ELSE {IP} END AS server_ip,
    CAST(CASE event_type WHEN 'error' THEN 1 ELSE 0 END AS INTEGER) AS errCode, dt AS snapshot_date
  FROM {EVENTS}),
named AS (
  SELECT staged.*, coalesce(tag_name, '未知') AS tag_name, CAST(coalesce(tag_step, -1) AS INTEGER) AS tag_step,
    coalesce(tag_detail, '未知') AS tag_detail
  FROM staged LEFT JOIN config USING (tag_id, hierarchy, referer)),
timed AS (
  SELECT *, coalesce((lead(ms) OVER (PARTITION BY session_id, procedure_id, tag_name ORDER BY tag_step, ms) - ms)
    / 1000.0::DOUBLE, 0.0::DOUBLE) AS t_action FROM named),
placed AS (
  SELECT timed.*, coalesce(a.country, '未知') AS country, coalesce(a.province, '未知') AS province,
    coalesce(a.city, '未知') AS city, coalesce(b.country, '未知') AS server_country,
    coalesce(b.province, '未知') AS server_province, coalesce(b.city, '未知') AS server_city
  FROM timed LEFT JOIN places a ON {ip_value('ip')} BETWEEN a.ip_from AND a.ip_to
    LEFT JOIN places b ON {ip_value('server_ip')} BETWEEN b.ip_from AND b.ip_to)"""

ORACLE["process_steps"] = f"""
WITH {STEPS}
SELECT product_id, platform, session_id, procedure_id, user_id, star_level, hierarchy, tag_id, page_url, referer,
  tag_name, tag_step, tag_detail, click_time, t_action, 'app1' AS app_id, '1.0' AS app_version,
  'phone' AS device_type, 'brand' AS device_brand, 'os' AS os_type, '9' AS os_version, 'pal' AS palcode,
  'isp' AS isp, 'mac' AS mac, 'wifi' AS network, ip, country, province, city, server_ip, server_country,
  server_province, server_city, errCode, {LOAD} AS load_time, snapshot_date
FROM placed"""

ORACLE["process_hourly"] = f"""
WITH {STEPS}
SELECT product_id, platform, star_level, hierarchy, tag_name, tag_step, tag_detail, tag_id, page_url, referer,
  'app1' AS app_id, '1.0' AS app_version, 'pal' AS palcode, 'os' AS os_type, '9' AS os_version,
  server_country AS country, server_province AS province, server_city AS city,
  CAST(hour_fk AS INTEGER) AS date_hour_sk,
  count(*) FILTER (WHERE user_id = 'null') AS guest_pv,
  count(DISTINCT CASE WHEN user_id = 'null' THEN session_id END) AS guest_uv,
  count(*) FILTER (WHERE user_id <> 'null') AS mpv,
  count(DISTINCT CASE WHEN user_id <> 'null' THEN user_id END) AS muv,
  count(*) FILTER (WHERE errCode = 1) AS err_pv,
  count(DISTINCT CASE WHEN errCode = 1 THEN session_id END) AS err_uv,
  count(*) FILTER (WHERE errCode = 0 AND t_action = 0) AS terminate_pv,
  count(DISTINCT CASE WHEN errCode = 0 AND t_action = 0 THEN session_id END) AS terminate_uv,
  CAST(sum(CAST(t_action AS DECIMAL(18,3))) AS DOUBLE) AS total_action_time,
  CAST(hour_fk % 100 AS INTEGER) AS hour_num, {LOAD} AS load_time, snapshot_date
FROM placed
GROUP BY product_id, platform, star_level, hierarchy, tag_name, tag_step, tag_detail, tag_id, page_url, referer,
  server_country, server_province, server_city, hour_fk, snapshot_date"""

_CANON = " ".join(f"WHEN contains(name, {lit(k)}) THEN {lit(v)}" for k, v in t.KEYWORDS)
ORACLE["keyword_canon"] = f"""
SELECT p_partkey, CASE {_CANON} ELSE name END AS by_list, CASE {_CANON} ELSE name END AS by_table
FROM (SELECT p_partkey, p_name || ' ' || p_type AS name FROM part)"""

_FIRST_PROVINCE = " ".join(f"WHEN contains(p1, {lit(p)}) THEN {lit(p)}" for p in PROVINCES)
_BANK = " ".join(f"WHEN contains(bank, {lit(k)}) THEN {lit(v)}" for k, v in BANKS)
_ANY_PROVINCE = " OR ".join(f"contains(country, {lit(p)})" for p in PROVINCES)
_CITY_ROWS = values(t.CITIES, "c(city, city_province)")


def _city(column: str, text: str) -> str:
    return (
        f"(SELECT {column} FROM {_CITY_ROWS} WHERE contains({text}, city)"
        " ORDER BY length(city) DESC, city LIMIT 1)"
    )


_TEXTS = {"country": (t.COUNTRIES, 3), "raw": (t.AREAS, 7), "bank": (t.BANK_TEXTS, 5)}
_PICKS = ", ".join(
    f"{texts(items)}[o_orderkey * {step} % {len(items)} + 1] AS {name}" for name, (items, step) in _TEXTS.items()
)
_STRIP = "a4"
for _noise in ("其他城市:", "其他城市", "省", "市", ":", ",", "：", " ", "，"):
    _STRIP = f"replace({_STRIP}, '{_noise}', '')"

ORACLE["bank_cleanse"] = f"""
WITH cards AS (
  SELECT CASE WHEN o_custkey % 5 = 0 THEN 'C07' ELSE 'A0' || (o_custkey % 3 + 1) END AS product_id, o_custkey,
    {_PICKS}, 'branch ' || o_orderkey AS branch, strftime(o_orderdate, '%Y-%m-%d') AS dt
  FROM orders WHERE o_orderpriority <> '5-LOW'),
s1 AS (
  SELECT *, CASE WHEN contains(country, '台湾') THEN '台湾' WHEN {_ANY_PROVINCE} THEN '中国' ELSE country END AS c1 FROM cards),
s2 AS (SELECT *, CASE WHEN contains(c1, 'CHINA') THEN '中国' ELSE c1 END AS c2 FROM s1),
s3 AS (
  SELECT *, CASE WHEN product_id = 'C07' THEN '越南' ELSE c2 END AS c3,
    CASE WHEN product_id = 'C07' OR contains(c2, '越南') THEN '越南地区' ELSE raw END AS p1 FROM s2),
s4 AS (SELECT *, CASE {_FIRST_PROVINCE} ELSE p1 END AS p2 FROM s3),
s5 AS (SELECT *, coalesce({_city('city_province', 'p2')}, p2) AS p3 FROM s4),
s6 AS (
  SELECT *, CASE WHEN contains(raw, ',') THEN substr(raw, strpos(raw, ',') + 1)
    WHEN contains(raw, '，') THEN substr(raw, strpos(raw, '，') + 1) ELSE raw END AS a1 FROM s5),
s7 AS (SELECT *, CASE WHEN p3 IN ('北京', '天津', '上海', '重庆', '香港', '澳门') THEN p3 ELSE a1 END AS a2 FROM s6),
s8 AS (SELECT *, coalesce({_city('city', 'a2')}, a2) AS a4 FROM s7)
SELECT product_id || '_' || CASE WHEN c_custkey IS NULL THEN 'null' ELSE 'c' || c_custkey END AS user_fk, product_id,
  CASE {_BANK} ELSE bank END AS bank, c3 AS country, p3 AS province, {_STRIP} AS area, branch,
  CAST(1 AS INTEGER) AS priority_order, {LOAD} AS load_time, dt
FROM s8 LEFT JOIN (SELECT * FROM customer WHERE c_acctbal > 0) ON o_custkey = c_custkey"""

# --- snapshots, text sources, generators, sinks -------------------------------------------------

ORACLE["snapshot_copy"] = """
SELECT o_orderkey, o_custkey, o_orderstatus, o_totalprice,
  strftime(o_orderdate, '%Y-%m-%dT%H:%M:%S') || '.000+08:00' AS o_orderdate, '2024-01-31' AS snapshot_date
FROM orders"""

ORACLE["csv_nullable"] = """
SELECT c_name AS name, CASE WHEN c_acctbal > 1 THEN c_acctbal END AS balance FROM customer"""

ORACLE["explode_const"] = """
SELECT c_mktsegment, 'const' AS name, CAST(unnest([2, 5, 8]) AS INTEGER) AS age
FROM (SELECT DISTINCT c_mktsegment FROM customer)"""

ORACLE["sink_dynamic_overwrite"] = f"""
SELECT event_id, CASE WHEN dt >= '2024-01-24' THEN value * 2 ELSE value END AS value, dt FROM {EVENTS}"""

ORACLE["sink_replace_key"] = """
SELECT strftime(o_orderdate, '%Y-%m-%d') AS day,
  count(*) * CASE o_orderstatus WHEN 'F' THEN 10 ELSE 1 END AS n, o_orderstatus AS product_id, '2001-08-02' AS dt,
  CAST(7 AS INTEGER) AS renewal_period
FROM orders GROUP BY 1, o_orderstatus"""

ORACLE["sink_roundtrip"] = f"""
SELECT product_id, platform, gametype, exec_date, plot_time_label, monetary, "return", CAST(2 AS BIGINT) AS copies
FROM {INTRADAY}"""

# --- variants that reach more of the library ---------------------------------------------------

ORACLE["deposit_hourly_large"] = ORACLE["deposit_hourly"]

ORACLE["deposit_hourly_days"] = f"SELECT * FROM ({ORACLE['deposit_hourly']}) WHERE dt BETWEEN '1997-01-01' AND '1998-06-30'"

ORACLE["streak_report"] = f"""
WITH bets AS (
  SELECT dt, user_id, ts, event_id, event_type, k, value, strftime(ts, '%Y%m%d%H') AS hour FROM {EVENTS}
  WHERE event_type IN ('click', 'purchase')),
hedged AS (SELECT user_id, hour FROM bets GROUP BY 1, 2 HAVING count(DISTINCT event_type) = 2),
rows AS (
  SELECT dt, bets.user_id, ts, event_id, h.user_id IS NOT NULL AS reset, k >= 5 AND value <> 0 AS hit
  FROM bets LEFT JOIN hedged h ON bets.user_id = h.user_id AND bets.hour = h.hour),
runs AS (
  SELECT *, sum(CAST(reset AS INTEGER)) OVER (PARTITION BY dt, user_id ORDER BY ts, event_id) AS run FROM rows),
best AS (
  SELECT dt, user_id, max(hits) AS streak FROM (
    SELECT dt, user_id, run, count(*) FILTER (WHERE hit AND NOT reset) AS hits FROM runs GROUP BY 1, 2, 3) GROUP BY 1, 2)
SELECT dt, CAST(unnest(range(1, least(streak, 18) + 1)) AS INTEGER) AS streak, user_id FROM best WHERE streak >= 1"""

ORACLE["stream_lines"] = """
SELECT strftime(date_trunc('minute', ts), '%Y-%m-%d %H:%M:%S') AS window_start, event_type AS value, count(*) AS n
FROM events GROUP BY 1, 2"""

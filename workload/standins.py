"""Driver tables in the shape the jobs read: logs, facts and dimensions derived row by row."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidemart.functions.network import address_key
from tidemart.sources.tables import inline_table, read_table

LOAD_TIME = "2024-02-01T00:00:00.000+08:00"
EVENT_DAYS = ("2023-12-01", "2024-12-31")
# Days at which the streamed events are cut into parts, and the longest gap in milliseconds.
STREAM_BORDERS = ("2024-01-11", "2024-01-21")
STREAM_IDLE = 2 * 60 * 60 * 1000
ORDER_DAYS = ("1994-01-01", "2004-12-31")

CURRENCIES = [(1, "CNY"), (2, "USD"), (3, "VND")]
PLATFORMS = [("AG_QJ", "A01", "Agin"), ("PT_01", "A01", "Playtech")]
GATEWAYS = ("spam-farm.example.org", "example.net")
SUB_TYPES = ("bitcoin", "cubitpay", "card", "mobile", "qrcode", "pay", "voucher")

TAG_CONFIG = [
    ("A01", 20231201, "landing_step1_home", "view"),
    ("A01", 20231201, "landing_step1_home", "click"),
    ("A01", 20231201, "注册_step2", "signup"),
    ("A01", 20240116, "landing_stepX_home page with a long detail text that does not fit into one "
     "line of seventy-six characters", "view"),
    ("A01", 20240116, "pay", "purchase"),
    ("A01", 20240116, "money", "purchase"),
    ("A01", 20240116, "pay", "unseen"),
    ("A02", 20240110, "join_step 3_form", "signup"),
    ("A02", 20240110, "join_step 3_form", "view"),
    ("A02", 20300101, "future", "view"),
]

STEP_LINES = [
    (f"{tag},h{h},r{r}", f"{tag}-flow,{step},part {r}")
    for i, tag in enumerate(("view", "click", "signup", "purchase"))
    for h in range(2)
    for r in range(5)
    for step in [("bad" if (i, h, r) == (1, 1, 3) else str(r))]
    if (i, h, r) != (2, 0, 4)
]

IP_RANGES = [
    ("36.0.0.0", "36.7.255.255", "中国", "北京", "北京"),
    ("36.8.0.0", "36.31.255.255", "中国", "广东", "深圳"),
    ("36.32.0.0", "36.32.127.255", "中国", "内蒙古", None),
    ("36.40.0.0", "36.55.255.255", "美国", "California", "San Jose"),
    ("36.56.0.0", "36.56.3.255", "中国", "浙江", "杭州市"),
    ("36.56.4.0", "36.56.4.127", None, "沪", "上海"),
    ("fe80::", "fe80::7f", "越南", "Hanoi", None),
    ("fe80::80", "fe80::ffff", "中国", "广东", "广州"),
]

KEYWORDS = [("ring", "Ring"), ("red", "Red things"), ("bolt", "Bolt"), ("old", "Old things"), ("widget", "Widget")]

COUNTRIES = ("中国", "CHINA", "台湾省", "广东省", "越南", "美国", "CHINA TAIWAN", "河北 CHINA")
AREAS = (
    "广东省,深圳市", "北京", "其他城市:", "河北石家庄", "杭州市", "胡志明", "上海，浦东", "新疆 乌鲁木齐",
    "内蒙古", "台湾省", "未知地", "湖北省，武汉市,江岸", "浙江省,其他城市", "重庆市：渝中", "",
)
BANK_TEXTS = (
    "招商银行", "农村信用社", "中信", "中国银行", "渤海银行", "ICBC", "BTC wallet", "btc", "other bank",
    "中国工商银行", "平安", "比特", "CMB", "信合",
)
CITIES = [
    ("深圳", "广东"), ("石家庄", "河北"), ("杭州", "浙江"), ("武汉", "湖北"), ("江岸", "湖北"),
    ("北京", "北京"), ("乌鲁木齐", "新疆"), ("胡志明", "越南地区"), ("木齐", "测试"), ("渝中", "重庆"),
]

MISSION_RUN = "2001-08-02"
MISSION_DAYS = 2500


def table(spark: SparkSession, sf: str, name: str) -> DataFrame:
    return read_table(spark, name, sf)


def events(spark: SparkSession, sf: str) -> DataFrame:
    """Events with the number of ``props`` as ``k`` and the day as ``dt``."""
    return table(spark, sf, "events").withColumns({
        "k": F.from_json("props", "k int")["k"],
        "dt": F.col("ts").cast("date").cast("string"),
        "iso": F.concat(F.date_format("ts", "yyyy-MM-dd'T'HH:mm:ss.SSS"), F.lit("+08:00")),
    })


def currencies(spark: SparkSession) -> DataFrame:
    return inline_table(spark, ["currency_id", "currency_code"], CURRENCIES)


def logins(spark: SparkSession, sf: str, kind: str) -> DataFrame:
    """Login items from events; ``kind`` is the SQL text of the login kind."""
    return events(spark, sf).selectExpr(
        "concat('A0', user_id % 3 + 1) as product_id",
        "concat('u', user_id) as login_name",
        "iso as login_time",
        "cast(k as string) as device",
        f"{kind} as login_game",
        "dt as snapshot_date",
    )


def page_logins(spark: SparkSession, sf: str) -> DataFrame:
    """Login items from pages: the address is the domain text."""
    at = "timestamp_seconds(1704067200 + page_id * 7919 % 2592000)"
    return table(spark, sf, "pages").selectExpr(
        "concat('A0', page_id % 3 + 1) as product_id",
        "concat('p', page_id % 50) as login_name",
        "url as domain",
        f"concat(date_format({at}, \"yyyy-MM-dd'T'HH:mm:ss\"), '.000+08:00') as login_time",
        "'web' as login_game",
        f"date_format({at}, 'yyyy-MM-dd') as snapshot_date",
    )


def order_credits(spark: SparkSession, sf: str) -> DataFrame:
    """Credit log from orders: priority gives the code, status the currency."""
    subs = ", ".join(f"'{s}'" for s in SUB_TYPES)
    return table(spark, sf, "orders").selectExpr(
        "concat('A0', o_custkey % 3 + 1) as product_id",
        "cast(o_custkey as string) as customer_id",
        "concat(cast(cast(o_orderdate as date) as string), 'T', lpad(o_orderkey % 24, 2, '0'),"
        " ':30:00.000+08:00') as created_date",
        "case o_orderstatus when 'O' then 'CNY' when 'F' then 'USD' else 'VND' end as currency",
        "case o_orderpriority when '1-URGENT' then '111101' when '2-HIGH' then '111106'"
        " when '5-LOW' then '999999' else '111105' end as trans_code",
        f"element_at(array({subs}), cast(o_orderkey % 7 + 1 as int)) as sub_type",
        "concat(cast(o_totalprice as decimal(18,2)), lpad(o_orderkey % 1000000, 6, '0')) as amount",
        "cast(cast(o_orderdate as date) as string) as snapshot_date",
    )


def customers(spark: SparkSession, sf: str) -> DataFrame:
    """All customers; those without a positive balance under another number, so that some log lines stay unmatched."""
    return table(spark, sf, "customer").selectExpr(
        "concat('A0', c_custkey % 3 + 1) as product_id",
        "cast(if(c_acctbal > 0, c_custkey, -c_custkey) as string) as customer_id",
        "concat('c', c_custkey) as login_name",
    )


def line_credits(spark: SparkSession, sf: str, codes: dict[str, str]) -> DataFrame:
    """Credit log from line items; ``codes`` maps the return flag to a transaction code."""
    whens = " ".join(f"when '{flag}' then '{code}'" for flag, code in codes.items())
    return table(spark, sf, "lineitem").selectExpr(
        "concat('A0', l_suppkey % 3 + 1) as product_id",
        "cast(l_suppkey as string) as customer_id",
        "concat(cast(cast(l_shipdate as date) as string), 'T', lpad(l_orderkey % 24, 2, '0'),"
        " ':15:00.000+08:00') as created_date",
        "case l_linestatus when 'O' then 'CNY' else 'USD' end as currency",
        f"case l_returnflag {whens} end as trans_code",
        "l_extendedprice as amount",
        "l_extendedprice as game_amount",
        "cast(cast(l_shipdate as date) as string) as snapshot_date",
    )


def suppliers(spark: SparkSession, sf: str) -> DataFrame:
    return table(spark, sf, "supplier").selectExpr(
        "concat('A0', s_suppkey % 3 + 1) as product_id",
        "cast(if(s_acctbal > 0, s_suppkey, -s_suppkey) as string) as customer_id",
        "concat('s', s_suppkey) as login_name",
    )


def line_bets(spark: SparkSession, sf: str) -> DataFrame:
    """Bets from line items: supplier as user, part group as game."""
    return table(spark, sf, "lineitem").selectExpr(
        "concat('A0', l_suppkey % 3 + 1, '_u', l_suppkey) as user_fk",
        "concat('A0', l_suppkey % 3 + 1, '_', l_linestatus) as product_platform_fk",
        "concat('G', l_partkey % 25) as game_platform_fk",
        "cast(l_quantity as decimal(18,2)) * (cast(l_discount as decimal(4,2)) - 0.05)"
        " + cast(l_orderkey % 1000 as decimal(10,0)) * 0.00000001 as profit",
        "case when l_discount > 0.02 then l_extendedprice else 0 end as valid_monetary",
        "case l_returnflag when 'N' then 5 else 8 end as game_kind_fk",
        "cast(cast(l_shipdate as date) as string) as dt",
    )


def event_bets(spark: SparkSession, sf: str) -> DataFrame:
    """Hourly bets from events: event type as game."""
    return events(spark, sf).selectExpr(
        "cast(date_format(ts, 'yyyyMMddHH') as int) as date_hour_fk",
        "concat('A0', user_id % 3 + 1, '_u', user_id) as user_fk",
        "concat('A0', user_id % 3 + 1, '_P', k % 4) as product_platform_fk",
        "event_type as game_platform_fk",
        "value - 50 as profit",
        "case event_type when 'error' then 0 else value end as valid_monetary",
        "case event_type when 'click' then 8 else 5 end as game_kind_fk",
        "dt",
    )


def sign_users(spark: SparkSession, sf: str) -> DataFrame:
    return table(spark, sf, "customer").selectExpr(
        "concat('A0', c_custkey % 3 + 1, '_u', if(c_acctbal > 0, c_custkey, -c_custkey)) as user_id",
        "c_mktsegment as chinese_zodiac",
        "concat('N', c_nationkey) as zodiac",
    )


def game_orders(spark: SparkSession, sf: str) -> DataFrame:
    """Game orders from line items and their orders: the customer is the player."""
    lines = table(spark, sf, "lineitem").select(
        "l_orderkey", "l_partkey", "l_returnflag", "l_linestatus", "l_extendedprice", "l_quantity", "l_discount"
    )
    owners = table(spark, sf, "orders").select(F.col("o_orderkey").alias("l_orderkey"), "o_custkey")
    return lines.join(owners, "l_orderkey").selectExpr(
        "concat('G', l_partkey % 25) as gametype",
        "l_returnflag as product_id",
        "l_linestatus as platform",
        "concat('c', o_custkey) as loginname",
        "l_extendedprice as account",
        "case when l_discount > 0.02 then l_extendedprice else 0 end as valid_account",
        "cast(l_quantity as decimal(18,2)) * (cast(l_discount as decimal(4,2)) - 0.05)"
        " + cast(l_orderkey % 1000 as decimal(10,0)) * 0.00000001 as cus_account",
        "5 as game_kind",
    )


def game_platforms(spark: SparkSession, sf: str) -> DataFrame:
    """Game keys for the brands of the part table (some games stay unknown)."""
    return (
        table(spark, sf, "part")
        .selectExpr("concat(if(p_size < 40, 'G', 'H'), p_partkey % 25) as gametype", "explode(array('O', 'F')) as platform")
        .distinct()
        .selectExpr("concat('GP_', gametype, '_', platform) as id_sk", "gametype", "platform")
    )


def product_platforms(spark: SparkSession) -> DataFrame:
    rows = [(f"{p}_{s}", p, s) for p in ("N", "R") for s in ("O", "F")]
    return inline_table(spark, ["id_sk", "product_id", "platform"], rows)


def day_orders(spark: SparkSession, sf: str) -> DataFrame:
    """Bill lines from events: even ``k`` wins the stake, odd ``k`` loses it."""
    return events(spark, sf).selectExpr(
        "concat('A0', user_id % 3 + 1) as product_id",
        "'AGQJ' as platform",
        "event_type as gametype",
        "date_format(ts, 'yyyy-MM-dd HH:mm:ss') as billtime",
        "value as account",
        "case when k % 2 = 0 then value else -value end as cus_account",
        "'5' as game_kind",
    )


def streak_bets(spark: SparkSession, sf: str) -> DataFrame:
    """Bets from events: an error is a loss, a view is neutral; a round is a user's hour."""
    return events(spark, sf).selectExpr(
        "user_id",
        "ts",
        "event_id",
        "concat(user_id, '_', date_format(ts, 'yyyyMMddHH')) as gmcode",
        "case event_type when 'click' then 1 when 'purchase' then 2 else 0 end as playtype",
        "case when k < 5 then 100 else 500 end as account",
        "case event_type when 'error' then -value when 'view' then 0 else value end as cus_account",
    )


def clicks(spark: SparkSession, sf: str) -> DataFrame:
    return events(spark, sf).selectExpr(
        "iso as click_time",
        "event_type as tag_id",
        "concat('s', user_id, '-', date_format(ts, 'yyyyMMdd')) as session_id",
        "case when user_id % 3 = 0 then '' else concat('u', user_id) end as user_id",
        "concat('A0', user_id % 2 + 1) as p_id",
        "concat('T', k % 3) as game_type_sk",
        "dt",
    )


def tag_config(spark: SparkSession) -> DataFrame:
    return inline_table(spark, ["product_id", "version", "tag_name", "tag"], TAG_CONFIG)


def step_lines(spark: SparkSession) -> DataFrame:
    return inline_table(spark, ["key", "value"], STEP_LINES)


def ip_ranges(spark: SparkSession) -> DataFrame:
    rows = inline_table(spark, ["ip_from", "ip_to", "country", "province", "city"], IP_RANGES)
    return rows.withColumns({c: address_key(c) for c in ("ip_from", "ip_to")})


IP_EXPR = (
    "case when k = 0 then '' when k = 1 then concat('36.', user_id % 64, '.', event_id % 256, '.7,10.0.0.1')"
    " when k = 2 then concat('fe80::', lower(hex(event_id % 256))) else concat('36.', user_id % 64, '.', event_id % 256, '.', k) end"
)


def staging(spark: SparkSession, sf: str) -> DataFrame:
    """Process-monitoring events: day as procedure, ``k`` decides referer, level and server address."""
    data = F.to_json(F.struct(
        F.lit("web").alias("platform"),
        F.col("dt").alias("procedure_id"),
        F.expr("k % 4").alias("customer_level"),
        F.expr("concat('h', k % 2)").alias("hierarchy"),
        F.expr("case when k % 3 = 0 then concat('36.', k % 64, '.9.9') end").alias("server_ip"),
        F.expr("case event_type when 'error' then 1 else 0 end").alias("errCode"),
    ))
    constant = {
        "agent": "agent", "app_id": "app1", "app_version": "1.0", "depth": "1", "device_brand": "brand",
        "device_type": "phone", "isp": "isp", "mac": "mac", "network": "wifi", "os_type": "os",
        "os_version": "9", "palcode": "pal", "product_id": "A04",
    }
    rows = events(spark, sf).select(
        data.alias("data"),
        F.col("iso").alias("event_time"),
        F.expr(IP_EXPR).alias("ip"),
        F.expr("concat('/', event_type)").alias("page_url"),
        F.expr("concat('r', k % 5)").alias("referer"),
        F.expr("concat('s', user_id)").alias("session_id"),
        F.col("event_type").alias("tag_id"),
        F.expr("case when user_id % 3 = 0 then 'null' else concat('u', user_id) end").alias("user_id"),
        F.col("dt").alias("snapshot_date"),
    )
    return rows.withColumns({name: F.lit(value) for name, value in constant.items()})


def bank_cards(spark: SparkSession, sf: str) -> DataFrame:
    """Bank cards from orders: keys pick the country, area and bank texts."""

    def pick(texts: tuple[str, ...], step: int) -> str:
        items = ", ".join(f"'{t}'" for t in texts)
        return f"element_at(array({items}), cast(o_orderkey * {step} % {len(texts)} + 1 as int))"

    return table(spark, sf, "orders").selectExpr(
        "case when o_custkey % 5 = 0 then 'C07' else concat('A0', o_custkey % 3 + 1) end as product_id",
        "cast(o_custkey as string) as customer_id",
        f"{pick(COUNTRIES, 3)} as country",
        f"{pick(AREAS, 7)} as province",
        f"{pick(BANK_TEXTS, 5)} as bank",
        "concat('branch ', o_orderkey) as branch",
        "case o_orderpriority when '5-LOW' then 2 else 1 end as priority_order",
        "cast(cast(o_orderdate as date) as string) as dt",
    )


def bank_customers(spark: SparkSession, sf: str) -> DataFrame:
    return table(spark, sf, "customer").selectExpr(
        "case when c_custkey % 5 = 0 then 'C07' else concat('A0', c_custkey % 3 + 1) end as product_id",
        "cast(if(c_acctbal > 0, c_custkey, -c_custkey) as string) as customer_id",
        "concat('c', c_custkey) as login_name",
    )


def cities(spark: SparkSession) -> DataFrame:
    return inline_table(spark, ["city", "province"], CITIES)


def order_deposits(spark: SparkSession, sf: str) -> DataFrame:
    return table(spark, sf, "orders").selectExpr(
        "concat('A01_r', o_custkey) as user_fk",
        "cast(cast(o_orderdate as date) as string) as dt",
        "o_totalprice as deposit_amount",
        "o_orderstatus",
    )


def mission_users(spark: SparkSession, sf: str) -> DataFrame:
    return table(spark, sf, "customer").selectExpr(
        "concat('A01_r', if(c_acctbal > 0, c_custkey, -c_custkey)) as user_id",
        "concat(date_format(date_add(date'2001-06-01', cast(c_custkey % 60 as int)), 'yyyy-MM-dd'),"
        " 'T08:00:00.000+08:00') as register_time",
        "'A01' as product_id",
        "1 as customer_type",
        "'2001-08-01' as dt",
    )


def line_deposits(spark: SparkSession, sf: str, flags: tuple[str, ...], amount: str) -> DataFrame:
    """Line items of some return flags as deposits or withdrawals of the supplier."""
    return table(spark, sf, "lineitem").where(F.col("l_returnflag").isin(*flags)).selectExpr(
        "concat('A01_r', l_suppkey) as user_fk", f"l_extendedprice as {amount}"
    )

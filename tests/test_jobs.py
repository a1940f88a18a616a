"""The jobs on hand-made rows: every rule and every quirk has a row."""

import math
import random
import statistics

import pytest
from pyspark.errors import PySparkException
from pyspark.sql import functions as F

from tidemart.functions.times import hour_dim
from tidemart.functions.network import address_key
from tidemart.plans import banks, funnel, games, logins, missions, money, returns, steps, streaks
from tidemart.sources.text import key_values, step_config

DAY = "2018-04-15"
LOAD = "2018-04-16T01:00:00.000+08:00"
NARROW = {"width": 1, "tie_width": 1}


def at(time, day=DAY):
    return f"{day}T{time}.000+08:00"


@pytest.fixture(scope="module")
def hours(spark):
    return hour_dim(spark, DAY, "2018-04-16")


@pytest.fixture(scope="module")
def currencies(spark):
    return spark.createDataFrame([(1, "CNY"), (2, "USD")], "currency_id int, currency_code string")


@pytest.fixture(scope="module")
def customers(spark):
    return spark.createDataFrame(
        [("A01", "1", "rbob"), ("A01", "2", "rbob"), ("A02", "1", "ann")], "product_id string, customer_id string, login_name string"
    )


LOGIN = "product_id string, login_name string, domain string, login_time string, device string, login_game string, snapshot_date string"


@pytest.fixture(scope="module")
def login_items(spark):
    return spark.createDataFrame(
        [
            ("A01", "bob", "http://a.com/x", at("07:00:00"), "17", "web", DAY),
            ("A01", "bob", "https://a.com/y", at("07:59:59"), "18", "web", DAY),
            ("A01", None, "", at("08:00:00"), None, "web", DAY),
            ("A01", "bob", "a.com", at("00:00:00", "2018-04-16"), "1", "web", DAY),
            ("A01", "bob", "b.com", at("23:00:00", "2018-04-16"), "1", "web", "2018-04-16"),
            ("A01", "bob", "a.com", at("09:00:00"), "1", "vipMember", DAY),
            ("A01", "bob", "a.com", at("09:00:00"), "1", None, DAY),
            ("A01", "bob", "a.com", at("09:00:00"), "1", "AGQJ", DAY),
            ("A01", "bob", "a.com", at("09:30:00"), "1", "ZZ", DAY),
        ],
        LOGIN,
    )


def test_login_counts(spark, rows, hours, login_items):
    found = logins.login_hourly(login_items, hours, LOAD, (DAY, DAY))
    assert rows(found) == [
        (2018041507, "A01_bob", 2, LOAD, DAY), (2018041508, "A01_null", 1, LOAD, DAY),
    ]
    both = logins.login_hourly(login_items, hours, LOAD)
    assert both.count() == 3
    device = logins.login_device_hourly(login_items, hours, LOAD, (DAY, DAY))
    assert rows(device, "user_fk", "login_device", "login_count") == [("A01_bob", "-1", 1), ("A01_bob", "17", 1), ("A01_null", "-1", 1)]
    domain = logins.login_domain_hourly(login_items, hours, LOAD, (DAY, DAY))
    assert rows(domain, "login_domain", "login_count") == [("", 1), ("a.com", 2)]


def test_login_platforms(spark, rows, hours, login_items):
    dim = spark.createDataFrame([("AG_QJ", "Agin"), ("AG_QJ", "Agin2")], "id_sk string, platform string")
    found = logins.login_platform_hourly(login_items, hours, dim, LOAD, (DAY, DAY))
    assert rows(found, "platform", "login_count") == [("Agin", 1), ("Agin2", 1), ("ZZ", 1)]


CREDIT = (
    "product_id string, customer_id string, created_date string, currency string, trans_code string, "
    "sub_type string, amount double, game_amount double, snapshot_date string"
)


def credit(spark, *entries):
    full = [(p, c, t, cur, code, sub, float(a), float(a), DAY) for p, c, t, cur, code, sub, a in entries]
    return spark.createDataFrame(full, CREDIT)


@pytest.mark.parametrize("limit", [32 << 20, 0])
def test_deposits(spark, rows, hours, currencies, customers, limit):
    logs = credit(
        spark,
        ("A01", "1", at("07:00:00"), "CNY", "111101", None, 0.1),
        ("A01", "2", at("07:30:00"), "CNY", "111101", "x", 0.2),
        ("A01", "1", at("07:30:00"), "USD", "111105", "card", 5),
        ("A01", "9", at("07:30:00"), "CNY", "111106", None, 7),
        ("A01", "1", at("07:30:00"), "CNY", "999999", None, 7),
        ("A01", "1", at("07:30:00", "2018-04-14"), "CNY", "111101", None, 7),
    )
    found = money.deposit_hourly(logs, customers, hours, currencies, LOAD, (DAY, DAY), limit)
    assert rows(found) == [
        (2018041507, "A01_null", 2, 1, 1, 7.0, LOAD, DAY),
        (2018041507, "A01_rbob", 1, 1, 2, 0.3, LOAD, DAY),
        (2018041507, "A01_rbob", 4, 2, 1, 5.0, LOAD, DAY),
    ]


def test_a_missing_dimension_key_stops_the_job(spark, hours, currencies, customers):
    bad_currency = credit(spark, ("A01", "1", at("07:00:00"), "XXX", "111101", None, 1))
    with pytest.raises(PySparkException, match="XXX"):
        money.deposit_hourly(bad_currency, customers, hours, currencies, LOAD).collect()
    no_hours = hours.where("date_hour_sk < 0")
    good = credit(spark, ("A01", "1", at("07:00:00"), "CNY", "111101", None, 1))
    with pytest.raises(PySparkException, match="2018-04-15-07"):
        money.deposit_hourly(good, customers, no_hours, currencies, LOAD).collect()
    ignored = credit(spark, ("A01", "1", at("07:00:00"), "XXX", "000000", None, 1))
    assert money.deposit_hourly(ignored, customers, hours, currencies, LOAD).count() == 0


@pytest.mark.parametrize("limit", [32 << 20, 0])
def test_withdrawals_and_rebates(spark, rows, hours, currencies, customers, limit):
    logs = credit(
        spark,
        ("A01", "1", at("07:00:00"), "CNY", "111200", None, 10),
        ("A01", "2", at("07:10:00"), "CNY", "111202", None, 30),
        ("A02", "1", at("07:00:00"), "CNY", "111205", None, 4),
        ("A02", "1", at("08:00:00"), "CNY", "111203", None, 4),
        ("A02", "1", at("08:00:00"), "CNY", "111200", None, 9),
        ("A02", "1", at("08:00:00"), "CNY", "112501", None, 2.5),
        ("A02", "1", at("08:01:00"), "CNY", "112501", None, 1),
    )
    found = money.withdraw_hourly(logs, customers, hours, currencies, LOAD, broadcast_bytes=limit)
    assert rows(found, "date_hour_fk", "user_fk", "withdraw_count", "withdraw_amount", "withdraw_max", "withdraw_min") == [
        (2018041507, "A01_rbob", 0, -20.0, 10.0, 0.0),
        (2018041507, "A02_ann", -1, -4.0, 0.0, 0.0),
        (2018041508, "A02_ann", 0, 5.0, 9.0, 0.0),
    ]
    rebates = money.rebate_hourly(logs, customers, hours, currencies, LOAD, broadcast_bytes=limit)
    assert rows(rebates, "user_fk", "xima_count", "xima_amount", "xima_max", "xima_min") == [("A02_ann", 2, 3.5, 2.5, 1.0)]


def test_customers_of_the_same_day(spark, rows, hours, currencies, customers):
    daily = customers.withColumn("snapshot_date", F.lit("2018-04-14"))
    logs = credit(spark, ("A01", "1", at("07:00:00"), "CNY", "111101", None, 1))
    found = money.deposit_hourly(logs, daily, hours, currencies, LOAD)
    assert rows(found, "user_fk") == [("A01_null",)]


def bank_by_rules(card, cities):
    """The eleven rules, one after another, on one card."""
    product, country, raw, bank = card
    province = area = raw
    if "台湾" in country:
        country = "台湾"
    elif any(p in country for p in banks.PROVINCES):
        country = "中国"
    if "CHINA" in country:
        country = "中国"
    if "越南" in country:
        province = "越南地区"
    if product == "C07":
        country, province = "越南", "越南地区"
    province = next((p for p in banks.PROVINCES if p in province), province)

    def city_in(text):
        return next((c for c in sorted(cities, key=lambda c: (-len(c), c)) if c in text), None)

    province = cities.get(city_in(province), province)
    for comma in (",", "，"):
        if comma in area:
            area = area.split(comma, 1)[1]
            break
    if province in banks.MUNICIPALITIES:
        area = province
    area = city_in(area) or area
    for noise in ("其他城市:", "其他城市", "省", "市", ":", ",", "：", " ", "，"):
        area = area.replace(noise, "")
    bank = next((v for k, v in banks.BANKS if k in bank), bank)
    return bank, country, province, area


def test_bank_rules(spark, rows, customers):
    cities = {"深圳": "广东", "杭州": "浙江", "南山": "广东", "乌鲁木齐": "新疆", "木齐": "x", "江岸": "湖北", "北京": "北京"}
    countries = ["中国", "CHINA", "台湾", "台湾 CHINA", "广东省", "越南", "美国", ""]
    areas = ["广东省,深圳市", "上海，浦东", "深圳南山", "北京", "杭州市", "内蒙古,其他城市:", "重庆：渝中", "浙江省 其他城市", "a,b,c", "a，b,c", "乌鲁木齐", ""]
    names = ["农村信用社", "中信", "中国银行", "ICBC", "x"]
    rnd = random.Random(2)
    cards = [(rnd.choice(["A01", "C07", "A02"]), rnd.choice(countries), a, rnd.choice(names)) for a in areas * 12]
    df = spark.createDataFrame(
        [(p, str(i % 3), c, a, b, f"br{i}", 1 if i % 7 else 2, DAY) for i, (p, c, a, b) in enumerate(cards)],
        "product_id string, customer_id string, country string, province string, bank string, branch string, priority_order int, dt string",
    )
    dim = spark.createDataFrame(list(cities.items()), "city string, province string")
    found = banks.bank_cleanse(df, customers, dim, LOAD)
    want = [(f"br{i}", *bank_by_rules(card, cities)) for i, card in enumerate(cards) if i % 7]
    assert rows(found, "branch", "bank", "country", "province", "area") == sorted(want, key=repr)
    assert rows(found.select("user_fk").distinct())[0] == ("A01_null",)


CLICK = "click_time string, tag_id string, session_id string, user_id string, p_id string, game_type_sk string, dt string"


def test_funnel(spark, rows):
    clicks = spark.createDataFrame(
        [
            (at("01:00:00"), "t1", "s1", "", "A01", "g", DAY),
            (at("01:00:01"), "t1", "s1", "", "A01", "g", DAY),
            (at("01:00:02"), "t1", "s2", "u1", "A01", "g", DAY),
            (at("01:00:03"), "t1", "s3", "u1", "A01", "g", DAY),
            (at("01:00:04"), "t1", "s3", None, "A01", "g", DAY),
            (at("01:00:05"), "t2", "s1", "", "A01", "g", DAY),
            (at("01:00:06"), "zz", "s9", "u9", "A01", "h", DAY),
            (at("01:00:00", "2018-04-16"), "t1", "s1", "", "A01", "g", "2018-04-16"),
        ],
        CLICK,
    )
    config = spark.createDataFrame(
        [
            ("A01", 20180401, "a_step2_d", "t1"), ("A01", 20180401, "a_step2_d", "t2"),
            ("A01", 20180401, "b", "t1"), ("A01", 20180401, "b", "unseen"),
            ("A01", 20180416, "c", "t1"), ("A02", 20180401, "other", "t1"),
        ],
        "product_id string, version int, tag_name string, tag string",
    )
    found = funnel.funnel_tags(clicks, config).withColumn("name", F.unbase64("tag_name").cast("string"))
    assert rows(found, "full_date", "name", "tag_step", *funnel.COUNTS, "game_type") == [
        (DAY, "a", 2, 3, 2, 3, 2, 2, "g"),
        (DAY, "b", 0, 0, 0, 0, 0, 0, "0"),
        (DAY, "b", 0, 2, 1, 3, 2, 2, "g"),
        (DAY, "其他", 0, 0, 0, 1, 1, 1, "h"),
        ("2018-04-16", "c", 0, 1, 1, 0, 0, 0, "g"),
    ]
    once = funnel.funnel_tags(clicks, config, unique_per_name=True).withColumn("name", F.unbase64("tag_name").cast("string"))
    assert rows(once.where(F.col("full_date") == DAY), "name", *funnel.COUNTS, "game_type") == [
        ("a", 3, 1, 3, 2, 2, "g"), ("b", 0, 0, 0, 0, 0, "0"), ("b", 2, 1, 3, 2, 2, "g"), ("其他", 0, 0, 1, 1, 1, "h"),
    ]
    runs = spark.createDataFrame([("A01", "2018-04-17"), ("A01", "2018-04-16")], "product_id string, dt string")
    chosen = funnel.funnel_tags(clicks, config, runs)
    assert rows(chosen, "full_date", "visitors_count", "game_type") == [("2018-04-16", 1, "g"), ("2018-04-17", 0, "0")]


STAGED = ["app_id", "app_version", "device_brand", "device_type", "isp", "mac", "network", "os_type", "os_version", "palcode", "page_url", "product_id"]


def staged(spark, entries):
    data = [(d, t, ip, ref, s, tag, u, DAY) for d, t, ip, ref, s, tag, u in entries]
    df = spark.createDataFrame(
        data, "data string, event_time string, ip string, referer string, session_id string, tag_id string, user_id string, snapshot_date string"
    )
    return df.withColumns({c: F.lit(c) for c in [*STAGED, "agent", "depth"]})


def body(level="1", err="0", server=None, hierarchy="h"):
    extra = f', "server_ip": "{server}"' if server else ""
    return f'{{"platform": "web", "procedure_id": "p", "customer_level": {level}, "hierarchy": "{hierarchy}", "errCode": "{err}"{extra}}}'


@pytest.fixture(scope="module")
def places(spark):
    return spark.createDataFrame(
        [("1.0.0.0", "1.255.255.255", "中国", "粤", "深圳"), ("3.0.0.0", "3.0.0.10", None, None, "北京市")],
        "ip_from string, ip_to string, country string, province string, city string",
    ).withColumns({c: address_key(c) for c in ("ip_from", "ip_to")})


@pytest.mark.parametrize("way", [{}, NARROW])
def test_process_steps(spark, rows, places, hours, way):
    lines = spark.createDataFrame(
        [("t1,h,r=login,1,first",), ("t2,h,r=login,2,second=x",), ("t3,h,r=login,bad,third",), ("t4,h,r=short",), ("no line",)],
        "value string",
    )
    config = step_config(key_values(lines))
    entries = [
        (body(), at("01:00:00"), "1.2.3.4", "r", "s1", "t1", "u1"),
        (body(server="3.0.0.5"), at("01:00:02").replace(".000", ".500"), "1.2.3.4,3.0.0.1", "r", "s1", "t2", "u1"),
        (body(err="1"), at("01:00:01"), "10.0.0.1", "r", "s1", "t2", "u1"),
        (body(), at("01:00:09"), "", "r", "s1", "t3", "null"),
        (body(), at("01:00:10"), None, "r", "s1", "t4", "null"),
        (body(), at("01:00:11"), "::1", "other", "s1", "t1", None),
    ]
    found = steps.process_steps(staged(spark, entries), config, places, LOAD, **way)
    assert found.columns == list(steps.STEP_COLUMNS) and len(found.columns) == 36
    assert rows(found, "tag_id", "click_time", "tag_name", "tag_step", "tag_detail", "t_action") == sorted([
        ("t1", at("01:00:00"), "login", 1, "first", 1.0),
        ("t2", at("01:00:01"), "login", 2, "second=x", 1.5),
        ("t2", at("01:00:02").replace(".000", ".500"), "login", 2, "second=x", 0.0),
        ("t3", at("01:00:09"), "login", -1, "未知", -9.0),
        ("t4", at("01:00:10"), "short", -1, "未知", 0.0),
        ("t1", at("01:00:11"), "未知", -1, "未知", 0.0),
    ], key=repr)
    place = rows(found, "click_time", "country", "province", "city", "server_country", "server_city")
    assert place[0][1:] == ("中国", "广东省", "深圳市", "中国", "深圳市")
    assert place[1][1:] == ("未知",) * 5
    assert place[2][1:] == ("中国", "广东省", "深圳市", "未知", "北京市")
    assert all(p[1:] == ("未知",) * 5 for p in place[3:])

    fact = steps.process_hourly(found, hours, LOAD, DAY)
    sums = fact.agg(*[F.sum(c) for c in ("guest_pv", "guest_uv", "mpv", "muv", "err_pv", "err_uv", "terminate_pv", "terminate_uv")]).first()
    assert tuple(sums) == (2, 2, 4, 4, 1, 1, 3, 3)
    assert {r[0] for r in fact.select("date_hour_sk").collect()} == {2018041501}


def test_a_step_key_is_a_whole_text(spark, rows, places):
    lines = spark.createDataFrame([("t5,h,http://x/a,b=comma,5,whole",), ("t5,h,http://x/a,c=other,6,whole",)], "value string")
    entries = [
        (body(), at("01:00:12"), "", "http://x/a,b", "s1", "t5", "u1"),
        (body(), at("01:00:13"), "", "http://x/a", "s1", "t5", "u1"),
        (body(), at("01:00:14"), "", None, "s1", "t5", "u1"),
    ]
    found = steps.process_steps(staged(spark, entries), step_config(key_values(lines)), places, LOAD)
    assert rows(found, "click_time", "tag_name", "tag_step") == [
        (at("01:00:12"), "comma", 5), (at("01:00:13"), "未知", -1), (at("01:00:14"), "未知", -1)]


def test_process_hourly_counts_people_once(spark, rows, hours):
    base = {c: "x" for c in steps.STEP_COLUMNS} | {"star_level": 1, "tag_step": 1, "snapshot_date": DAY}

    def event(user, session, action, err, time=at("01:00:00")):
        return base | {"user_id": user, "session_id": session, "t_action": action, "errCode": err, "click_time": time}

    events = [
        event("null", "s1", 1.5, 0), event("null", "s1", 0.0, 0), event("u1", "s2", 0.0, 0), event("u1", "s3", 2.0, 1),
        event(None, "s4", 0.25, 0), event(None, "s5", 0.0, 1), event("u1", "s2", 1.0, 0, at("01:00:00", "2020-01-01")),
    ]
    kinds = {"star_level": "int", "tag_step": "int", "errCode": "int", "t_action": "double"}
    df = spark.createDataFrame(
        [tuple(e[c] for c in steps.STEP_COLUMNS) for e in events],
        ", ".join(f"{c} {kinds.get(c, 'string')}" for c in steps.STEP_COLUMNS),
    )
    fact = steps.process_hourly(df, hours, LOAD)
    assert rows(fact, "date_hour_sk", "guest_pv", "guest_uv", "mpv", "muv", "err_pv", "err_uv", "terminate_pv", "terminate_uv", "total_action_time", "hour_num") == [
        (2018041501, 2, 1, 4, 2, 2, 2, 2, 2, 3.75, 1), (None, 0, 0, 1, 1, 0, 0, 0, 0, 1.0, None),
    ]


def test_return_rates(spark, rows):
    bets = spark.createDataFrame(
        [
            ("A01_x", "A01_u", "g", 1.0, 4.0, 5, DAY, 2018041523), ("A01_x", "A01_u", "g", 1.0, 0.0, 8, "2018-04-10", 2018041500),
            ("A01_x", "A01_v", "g", 1.0, 0.0, 5, DAY, 2018041501), ("A01_x", "A01_v", "g", 9.0, 9.0, 3, DAY, 2018041501),
            ("A01_x", "A01_u", "g", 9.0, 1.0, 5, "2018-04-01", 2018041502),
        ],
        "product_platform_fk string, user_fk string, game_platform_fk string, profit double, valid_monetary double, game_kind_fk int, dt string, date_hour_fk int",
    )
    found = returns.user_return_rate(bets, LOAD, DAY, 7)
    assert rows(found, "product_id", "user_id", "return_rate") == [("A01", "A01_u", 0.5), ("A01", "A01_v", None)]
    users = spark.createDataFrame([("A01_u", "rat", "leo")], "user_id string, chinese_zodiac string, zodiac string")
    signs = returns.zodiac_return(bets, hour_dim(spark, DAY, DAY), users, LOAD, DAY, 7)
    assert rows(signs, "zodiac", "ancient_chinese_hour", "return_rate") == [
        ("leo", "子", 0.25), ("leo", "子", None), (None, "丑", None),
    ]


def test_intraday(spark, rows):
    orders = spark.createDataFrame(
        [
            ("A04", "p", "g", f"{DAY} 00:01:00", 10.0, 5.0, "5"), ("A04", "p", "g", f"{DAY} 00:04:59", 10.0, -10.0, "8"),
            ("A04", "p", "g", f"{DAY} 23:59:00", 20.0, 0.0, "5"), ("A04", "p", "g", f"{DAY} 12:00:00", 0.0, 1.0, "3"),
            ("A04", "p", "z", f"{DAY} 12:00:00", 0.0, 1.0, "5"),
        ],
        "product_id string, platform string, gametype string, billtime string, account double, cus_account double, game_kind string",
    )
    found = returns.intraday_return(orders)
    assert rows(found, "gametype", "plot_time_label", "monetary", "return", "rate") == [
        ("g", 1, 20.0, 15.0, 0.75), ("g", 288, 40.0, 35.0, 0.875), ("z", 145, 0.0, 1.0, None),
    ]
    stats = returns.return_stats(found, {"p95": 0.95})
    g = [r for r in stats.collect() if r["gametype"] == "g"][0]
    assert (g["max"], g["min"], g["avg"], g["median"]) == (0.875, 0.75, 0.8125, 0.8125)
    assert g["std"] == pytest.approx(statistics.stdev([0.75, 0.875])) and g["p95"] == pytest.approx(0.86875)


ORDER = "gametype string, product_id string, platform string, loginname string, account double, valid_account double, cus_account double, game_kind int"


@pytest.mark.parametrize("most_users", [games.MEDIAN_USERS, 0, 10])
def test_game_stats(spark, rows, most_users):
    rnd = random.Random(8)
    orders = [
        ("hot" if rnd.random() < 0.5 else rnd.choice(["a", None]), "A01", "p", rnd.choice([None, *"uvwxyz"]) if i % 3 else f"n{i}",
         rnd.choice([None, float(rnd.randrange(1000)) / 4]), rnd.choice([0.0, 10.0, 25.0]), rnd.randrange(-400, 400) / 4, rnd.choice([5, 8]))
        for i in range(400)
    ] + [("one", "A01", "p", "u", 5.0, 0.0, 1.0, 5), ("two", "A01", "p", "u", 5.0, 10.0, 1.0, 5), ("two", "A01", "p", "u", 5.0, 10.0, 1.0, 3)]
    df = spark.createDataFrame(orders, ORDER)
    found = {r["gametype"]: r for r in games.game_group_stats(df, most_users).collect()}
    assert found.keys() == {"hot", "a", None, "one", "two"}
    for game, row in found.items():
        mine = [(o[3], o[4] or 0.0, o[5], o[6]) for o in orders if o[0] == game and o[7] in (5, 8)]
        users = {}
        for user, account, valid, won in mine:
            u = users.setdefault(user, [0.0, 0.0, 0.0, 0])
            u[0] += account
            u[1] += valid
            u[2] += won
            u[3] += 1
        rated = [(-u[2] / u[1], u[0], u[3]) for u in users.values() if u[1]]
        assert row["member_cnt"] == len(users)
        assert row["monetary"] == sum(m[1] for m in mine)
        assert row["bet_avg"] == pytest.approx(sum(m[1] for m in mine) / len(mine))
        assert (row["return_max"], row["return_min"], row["bet_max"]) == (max(m[3] for m in mine), min(m[3] for m in mine), max(m[1] for m in mine))
        for i, (name, spread) in enumerate([("return_rate", "return_rate_std"), ("monetary", "monetary_std"), ("cnt", "cnt_std")]):
            values = [r[i] for r in rated]
            assert row[f"{name}_median"] == (pytest.approx(statistics.median(values)) if values else None)
            assert row[f"{name}_mean"] == (pytest.approx(statistics.mean(values)) if values else None)
            assert row[spread] == (pytest.approx(statistics.stdev(values)) if len(values) > 1 else None)


def test_game_keys(spark, rows):
    df = spark.createDataFrame([("g", "A01", "p", "u", 1.0, 1.0, 1.0, 5), ("x", "A01", "p", "u", 1.0, 1.0, 1.0, 5)], ORDER)
    gp = spark.createDataFrame([("gp", "g", "p")], "id_sk string, gametype string, platform string")
    pp = spark.createDataFrame([("pp", "A01", "p")], "id_sk string, product_id string, platform string")
    found = games.game_daily_stats(df, gp, pp, LOAD, DAY)
    assert found.columns == list(games.OUTPUT)
    assert rows(found, "game_platform_sk", "product_platform_sk") == [("gp", "pp"), (None, "pp")]


def streak_by_loop(bets):
    sides = {}
    for b in bets:
        sides.setdefault(b["gmcode"], set()).add(b["playtype"])
    hedged = {g for g, s in sides.items() if {1, 2} <= s}
    best = now = 0
    for b in sorted(bets, key=lambda b: (b["billtime"], b["id"])):
        if b["cus_account"] < 0 or b["gmcode"] in hedged:
            now = 0
        elif b["account"] >= 200 and b["cus_account"] != 0:
            now += 1
            best = max(best, now)
    return min(best, 18)


@pytest.mark.parametrize("way", [{}, NARROW, {"width": 300}])
def test_win_streaks(spark, rows, way):
    rnd = random.Random(9)
    bets = []
    for i in range(900):
        user = 0 if rnd.random() < 0.4 else rnd.randrange(1, 12)
        bets.append({
            "id": i, "user_id": user, "billtime": rnd.randrange(10_000), "gmcode": rnd.choice([None, f"{rnd.randrange(400)}"]) if user % 3 else f"{i // 2}",
            "playtype": rnd.choice([1, 1, 1, 2]) if user % 3 else 1, "account": rnd.choice([100.0, 200.0, 500.0, 900.0]),
            "cus_account": rnd.choices([-5.0, 0.0, 5.0], [1, 2, 12])[0],
        })
    df = spark.createDataFrame(bets, "id long, user_id long, billtime long, gmcode string, playtype int, account double, cus_account double")
    want = [(u, streak_by_loop([b for b in bets if b["user_id"] == u])) for u in {b["user_id"] for b in bets}]
    found = streaks.win_streak(df, ["user_id"], ["billtime", "id"], **way)
    assert rows(found, "user_id", "streak") == sorted((w for w in want if w[1] >= 5), key=repr)
    assert max(w[1] for w in want) == 18
    levels = streaks.streak_levels(found)
    assert levels.count() == sum(w[1] - 4 for w in want if w[1] >= 5)


def test_round_bets(spark, rows):
    schema = "product_id string, platform string, gametype string, game_kind int, playtype int, dt string"
    good = ("A02", "AGQJ", "BAC", 3, 1, "2018-04-01")
    others = [good[:i] + (bad,) + good[i + 1:] for i, bad in enumerate(["A01", "PT", "SL", 5, 3, "2018-05-01"])]
    logs = spark.createDataFrame([good, good[:4] + (2, "2018-04-30"), *others], schema)
    found = streaks.round_bets(logs, "A02", "AGQJ", "BAC", 3, "2018-04-01", "2018-04-30")
    assert rows(found, "playtype", "dt") == [(1, "2018-04-01"), (2, "2018-04-30")]


def test_streak_report(spark, tmp_path):
    found = spark.createDataFrame([("2018-04-01", "u", 6)], "dt string, user_id string, streak int")
    path = str(tmp_path / "report")
    streaks.write_streak_report(streaks.streak_levels(found), path)
    back = spark.read.option("header", True).csv(path)
    assert back.columns == list(streaks.REPORT_COLUMNS) and back.count() == 2


def next100(x):
    return (1 + math.trunc(x / 100)) * 100


def ladder_by_loop(low, high, net):
    last = len(str(high)) - 1
    out, rate = [], None
    for j in range(last + 1):
        target = next100((j * high + (last - j) * low) / float(last))
        rate = min(0.05, (0.5 - 0.001) * net) if j == 0 else rate * out[-1][1] * (1 + 0.15) / target
        bonus = math.trunc(target * rate / 50) * 10 + 8
        if bonus <= 0:
            bonus = math.trunc(target * 0.001) * 10 + 8
        out.append((j, target, bonus))
    return out


def test_ladder_equals_the_loop(spark):
    rnd = random.Random(5)
    cases = []
    for i in range(400):
        low = rnd.randrange(1, 900) * 100
        cases.append((str(i), low, low + rnd.randrange(1, 20_000) * 100, rnd.choice([1.0, 0.0, rnd.random(), -rnd.random() * 3])))
    df = spark.createDataFrame(cases, "user_fk string, bdry long, next_bdry long, net_profit_rate double")
    found = {r["user_fk"]: r for r in missions.with_ladder(df).collect()}
    for user, low, high, net in cases:
        want = ladder_by_loop(low, high, net)
        row = found[user]
        assert [tuple(s) for s in row["steps"]] == want
        assert row["budget"] == sum(w[2] for w in want)
        assert row["expected_earn"] == pytest.approx(sum(w[1] for w in want) * net - row["budget"])
    assert missions.with_ladder(df.limit(1)).first()["missions"].startswith('{"0":{"deposit":')


def test_mission_segments(spark, rows):
    facts = []
    users = {
        "A01_rsteady": [1000.0] * 12, "A01_rvaries": [900.0 + 10 * i for i in range(12)], "A01_rwild": [10.0] * 11 + [9000.0],
        "A01_ronce": [500.0], "A01_rfew": [100.0, 300.0, 900.0], "A01_rold": [100.0, 300.0, 900.0], "A01_tother": [1.0, 2.0], "B01_rother": [1.0, 2.0],
    }
    for user, amounts in users.items():
        facts += [(user, f"2018-04-{i + 1:02d}", a) for i, a in enumerate(amounts)]
    deposits = spark.createDataFrame(facts, "user_fk string, dt string, deposit_amount double")
    taken = spark.createDataFrame([("A01_rwild", "2018-04-02", 90000.0)], "user_fk string, dt string, withdraw_amount double")
    people = spark.createDataFrame(
        [(u, at("00:00:00", "2017-01-01"), "A01", 1, "2018-04-14") for u in users if u not in ("A01_rfew",)],
        "user_id string, register_time string, product_id string, customer_type int, dt string",
    )
    found = {r["user_id"]: r for r in missions.mission_ladder(deposits, deposits, taken, people, "A01", DAY, 30).collect()}
    assert found.keys() == {"A01_rvaries", "A01_rwild", "A01_rfew"}
    varies, wild, few = found["A01_rvaries"], found["A01_rwild"], found["A01_rfew"]
    mean, var = statistics.mean(users["A01_rvaries"]), statistics.variance(users["A01_rvaries"])
    assert varies["alpha"] == pytest.approx(mean * mean / var) and varies["beta"] == pytest.approx(mean / var)
    assert varies["alpha"] > 1 and varies["net_profit_rate"] == 1.0
    border = varies["mode"] + math.sqrt(varies["alpha"] - 1) / varies["beta"]
    assert varies["bdry"] == next100(border)
    assert varies["next_bdry"] == next100(border + border / (varies["beta"] * border - varies["alpha"] + 1))
    assert wild["alpha"] <= 1 and wild["net_profit_rate"] < 0
    assert (few["reg_act_days"], few["dep_cnt"]) == (0, 3)
    assert (varies["active_30_days"], varies["active_7_days"]) == (12, 5)


def test_store_missions_twice(spark, rows, tmp_path):
    from tidemart.sinks.tables import create_partitioned_table

    key = ["product_id", "dt", "renewal_period"]
    one = spark.createDataFrame([("u1", 5, "A01", DAY, 7), ("u2", 6, "A01", DAY, 7)], "user_id string, budget int, product_id string, dt string, renewal_period int")
    create_partitioned_table(spark, "missions_t", one, key, str(tmp_path / "missions"))
    other = one.withColumn("product_id", F.lit("A02")).limit(1)
    missions.store_missions(other, "missions_t", "A02", DAY, 7)
    for _ in range(2):
        missions.store_missions(one, "missions_t", "A01", DAY, 7)
    assert spark.table("missions_t").count() == 3
    missions.store_missions(one.where("false"), "missions_t", "A01", DAY, 7)
    assert rows(spark.table("missions_t"), "product_id") == [("A02",)]
    spark.sql("drop table missions_t")

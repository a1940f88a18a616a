"""Column expressions on hand-made values, each quirk with its own row."""

import base64

import pytest
from pyspark.sql import functions as F

from tidemart.functions import codes, keys, network, times
from tidemart.plans.funnel import split_label


def values(spark, expression, *inputs, name="x", kind="string"):
    df = spark.createDataFrame([(i, v) for i, v in enumerate(inputs)], f"i int, {name} {kind}")
    return [r[0] for r in df.orderBy("i").select(expression).collect()]


def test_user_key_writes_null_as_text(spark):
    df = spark.createDataFrame([("A01", "bob"), ("A01", None), (None, "bob")], "p string, l string")
    assert [r[0] for r in df.select(keys.user_key("p", "l")).collect()] == ["A01_bob", "A01_null", "null_bob"]


def test_key_parts(spark):
    assert values(spark, keys.key_prefix("x"), "A01_r1_x", "A01") == ["A01", "A01"]
    assert values(spark, keys.is_regular_user("x"), "A01_rbob", "A01_tbob", "A01_") == [True, False, False]


def test_iso_parts(spark):
    t = "2018-04-15T07:08:09.123+08:00"
    assert values(spark, times.iso_hour("x"), t) == ["2018-04-15-07"]
    assert values(spark, times.iso_day("x"), t) == ["2018-04-15"]
    assert values(spark, times.iso_millis("x"), t, "2018-04-15T07:08:10.000+08:00", "nonsense") == [
        1523747289123, 1523747290000, None,
    ]


@pytest.mark.parametrize(
    ("text", "inside"),
    [
        ("2018-04-15T00:00:00.000+08:00", True),
        ("2018-04-15T23:59:59.999+08:00", True),
        ("2018-04-14T23:59:59.999+08:00", False),
        ("2018-04-16T00:00:00.000+08:00", False),
        ("2018-04-15T00:00:00+08:00", False),
        ("2018-04-15T23:59:59+08:00", True),
        ("2018-04-15T23:59:59.9991+08:00", False),
        ("2018-04-15T12:00:00.000", True),
    ],
)
def test_iso_between_equals_the_comparison_without_offset(spark, text, inside):
    stripped = text.split("+")[0]
    assert inside == ("2018-04-15T00:00:00.000" <= stripped <= "2018-04-15T23:59:59.999")
    assert values(spark, times.iso_between("x", "2018-04-15", "2018-04-15"), text) == [inside]


def test_two_hour_names(spark):
    found = values(spark, times.two_hour_name("x"), *range(24), 24, -1, kind="int")
    assert found[:3] == ["子", "丑", "丑"] and found[21:] == ["亥", "亥", "子", "其他", "其他"]
    assert len(set(found[:24])) == 12


def test_five_minute_bucket(spark):
    stamps = ["2018-01-01 00:00:00", "2018-01-01 00:04:59", "2018-01-01 00:05:00", "2018-01-01 23:59:59"]
    assert values(spark, times.five_minute_bucket(F.to_timestamp("x")), *stamps) == [1, 1, 2, 288]


def test_hour_dim(spark):
    dim = times.hour_dim(spark, "2024-02-28", "2024-03-01").collect()
    assert len(dim) == 72
    assert tuple(dim[25]) == ("2024-02-29-01", 2024022901, 1, 2)


def test_deposit_channels(spark):
    cases = [
        ("111101", "card", 1), ("111106", None, 2), ("111105", "bitcoin", 3), ("111105", "cubitpay", 3),
        ("111105", "card", 4), ("111105", "mobile", 5), ("111105", "qrcode", 6), ("111105", "pay", 7),
        ("111105", "voucher", 8), ("111105", None, 8),
    ]
    df = spark.createDataFrame(cases, "code string, sub string, want int")
    assert all(r[0] == r[1] for r in df.select(codes.deposit_channel("code", "sub"), "want").collect())


def test_devices(spark):
    assert values(spark, codes.known_device("x"), "0", "17", "18", "", None) == ["0", "17", "-1", "-1", "-1"]


def test_domains(spark):
    urls = [
        "https://gateway.fastgoapi.com/x", "a.gateway.quickgoapi.com", "http://gateway.bawinx.com:80",
        "http://www.a.com/b/c", "https://www.a.com/b", "www.a.com/b", "",
    ]
    assert values(spark, codes.login_domain("x"), *urls) == [
        "gateway.fastgoapi.com", "gateway.quickgoapi.com", "gateway.bawinx.com", "www.a.com", "www.a.com",
        "www.a.com/b", "",
    ]
    assert values(spark, codes.login_domain("x", strip_https=False), urls[4]) == ["https:"]


def test_provinces(spark):
    assert values(spark, codes.full_province("x"), "京", "鄂", "内蒙古", "加州", None) == [
        "北京市", "湖北省", "内蒙古自治区", "加州", None,
    ]
    assert sum(len(names) for names in codes.PROVINCE_ALIASES.values()) == 73


def test_numbers(spark):
    assert values(spark, codes.int_or("x", -1), "3", " 4 ", "x", "", None) == [3, 4, -1, -1, -1]
    assert values(spark, codes.next_hundred("x"), 0.0, 99.9, 100.0, 250.0, -50.0, 1e300, kind="double") == [
        100, 100, 200, 300, 100, None,
    ]


def test_base64_stays_on_one_line(spark):
    long = "标签" * 50
    assert values(spark, codes.base64_text("x"), long) == [base64.b64encode(long.encode()).decode()]


def test_labels(spark):
    labels = ["landing_step2_home", "pay", "pay_stepX_a", "pay_step 3", "a__b"]
    df = spark.createDataFrame([(i, s) for i, s in enumerate(labels)], "i int, x string")
    parts = split_label("x")
    found = [tuple(r) for r in df.orderBy("i").select(parts["tag_name"], parts["tag_step"], parts["tag_detail"]).collect()]

    def b(s):
        return base64.b64encode(s.encode()).decode()

    assert found == [
        (b("landing"), 2, b("home")), (b("pay"), 0, ""), (b("pay"), 0, b("a")), (b("pay"), 3, ""),
        (b("a"), 0, b("b")),
    ]


def test_addresses(spark):
    ips = ["1.2.3.4", "255.255.255.255", "1.2.3.4,5.6.7.8", "256.1.1.1", "1.2.3", "", "fe80::1", "a.b.c.d", None]
    assert values(spark, network.ipv4_number("x"), *ips) == [
        16909060, 4294967295, 16909060, None, None, None, None, None, None,
    ]


def test_first_match_wins(spark):
    from tidemart.plans.banks import BANKS

    names = ["农村信用社", "中信银行", "信用社", "渤海银行", "中国银行", "ICBC", "btc1", "外资", "中国建设银行"]
    assert values(spark, codes.replace_first_match("x", BANKS), *names) == [
        "农业银行", "中信银行", "农村信用社", "渤海银行", "中国银行", "工商银行", "比特币", "外资", "建设银行",
    ]


def test_address_keys(spark):
    import ipaddress

    good = ["::", "::1", "fe80::1", "2001:db8::ff00:42:8329", "1:2:3:4:5:6:7:8", "2001:DB8::", "::ffff:1.2.3.4", "1::8", "::2:3:4:5:6:7:8"]
    mapped = {"10.0.0.1": "::ffff:10.0.0.1", "1.2.3.4, 5.6.7.8": "::ffff:1.2.3.4"}
    bad = ["", None, "x", ":", ":::", "1:2:3", "1::2::3", "12345::", "1:2:3:4:5:6:7:8:9", ":1:2:3:4:5:6:7:8", "1:2:3:4:5:6:7::8:9", "300.1.1.1", "g::1", "1:2:3:4:5:6:7:"]
    want = [f"{int(ipaddress.IPv6Address(a)):032x}" for a in [*good, *mapped.values()]]
    assert values(spark, network.address_key("x"), *good, *mapped) == want
    assert values(spark, network.address_key("x"), *bad) == [None] * len(bad)

"""Code tables and normalisers that turn raw values into dimension values."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column
from pyspark.sql import functions as F

from .columns import col

# Transaction codes, channels, devices, gateways and login kinds of the staging logs.
DEPOSIT_CODES = ("111101", "111105", "111106")
WITHDRAW_CODE = "111200"
WITHDRAW_REVERSALS = ("111202", "111203", "111205")
REBATE_CODE = "112501"
CHANNEL_OF_CODE = {"111101": 1, "111106": 2}
CHANNEL_OF_SUBTYPE = {"bitcoin": 3, "cubitpay": 3, "card": 4, "mobile": 5, "qrcode": 6, "pay": 7}
OTHER_CHANNEL = 8
KNOWN_DEVICES = tuple(str(n) for n in range(18))
UNKNOWN_DEVICE = "-1"
GATEWAY_HOSTS = ("gateway.fastgoapi.com", "gateway.quickgoapi.com", "gateway.bawinx.com")
WEB_LOGIN = "web"
NON_PLATFORM_LOGINS = ("web", "vipMember")

# Full province names by their short forms.
PROVINCE_ALIASES = {
    "北京市": ("北京", "京"),
    "天津市": ("天津", "津"),
    "上海市": ("上海", "沪"),
    "重庆市": ("重庆", "渝"),
    "河北省": ("河北", "冀"),
    "河南省": ("河南", "豫"),
    "湖北省": ("湖北", "鄂"),
    "湖南省": ("湖南", "湘"),
    "江苏省": ("江苏", "苏"),
    "江西省": ("江西", "赣"),
    "辽宁省": ("辽宁", "辽"),
    "吉林省": ("吉林", "吉"),
    "黑龙江省": ("黑龙江", "黑"),
    "陕西省": ("陕西", "陕", "秦"),
    "山西省": ("山西", "晋"),
    "山东省": ("山东", "鲁"),
    "四川省": ("四川", "川", "蜀"),
    "青海省": ("青海", "青"),
    "安徽省": ("安徽", "皖"),
    "海南省": ("海南", "琼"),
    "广东省": ("广东", "粤"),
    "贵州省": ("贵州", "贵", "黔"),
    "浙江省": ("浙江", "浙"),
    "福建省": ("福建", "闽"),
    "台湾省": ("台湾", "台"),
    "甘肃省": ("甘肃", "甘", "陇"),
    "云南省": ("云南", "云", "滇"),
    "西藏自治区": ("西藏", "藏"),
    "宁夏回族自治区": ("宁夏", "宁"),
    "广西壮族自治区": ("广西", "桂"),
    "新疆维吾尔自治区": ("新疆", "新"),
    "内蒙古自治区": ("内蒙古", "蒙"),
    "香港特别行政区": ("香港", "港"),
    "澳门特别行政区": ("澳门", "澳"),
}


def deposit_channel(code: Column | str, subtype: Column | str) -> Column:
    """Channel number; a code with its own channel wins over the sub-type."""
    code, subtype = col(code), col(subtype)
    channel = F.lit(OTHER_CHANNEL)
    for value, number in CHANNEL_OF_SUBTYPE.items():
        channel = F.when(subtype == value, number).otherwise(channel)
    for value, number in CHANNEL_OF_CODE.items():
        channel = F.when(code == value, number).otherwise(channel)
    return channel


def known_device(device: Column | str) -> Column:
    return F.when(col(device).isin(*KNOWN_DEVICES), col(device)).otherwise(UNKNOWN_DEVICE)


def login_domain(
    url: Column | str, gateways: Sequence[str] = GATEWAY_HOSTS, strip_https: bool = True
) -> Column:
    """Host of a login address: a known gateway if contained, else the host of an ``http…`` address.

    ``strip_https=False`` removes only ``http://``, so that an https address gives ``https:``.
    """
    url = col(url)
    scheme = "^https?://" if strip_https else "http://"
    host = F.substring_index(F.regexp_replace(url, scheme, ""), "/", 1)
    result = F.when(url.startswith("http"), host).otherwise(url)
    for gateway in reversed(gateways):
        result = F.when(url.contains(gateway), gateway).otherwise(result)
    return result


def full_province(name: Column | str) -> Column:
    """Short province name → full name; unknown names stay."""
    pairs = [F.lit(x) for full, shorts in PROVINCE_ALIASES.items() for s in shorts for x in (s, full)]
    return F.coalesce(F.create_map(*pairs)[col(name)], col(name))


def int_or(text: Column | str, default: int) -> Column:
    """Whole number in a text, or ``default`` when it is missing or not a number."""
    return F.coalesce(col(text).try_cast("int"), F.lit(default))


def next_hundred(x: Column | str) -> Column:
    """The next multiple of 100 above the whole part of ``x / 100`` (an exact multiple moves up).

    Null when the number is beyond the whole numbers.
    """
    return (1 + (col(x) / 100).try_cast("bigint")) * 100


def base64_text(text: Column | str) -> Column:
    """Base64 of the UTF-8 bytes on one line (Spark wraps long results)."""
    return F.regexp_replace(F.base64(F.encode(col(text), "UTF-8")), "[\r\n]", "")


def replace_first_match(text: Column | str, names: Sequence[tuple[str, str]]) -> Column:
    """Canonical name of the first keyword contained in ``text``; otherwise ``text`` itself."""
    text = col(text)
    return F.coalesce(*[F.when(text.contains(k), F.lit(v)) for k, v in names], text)

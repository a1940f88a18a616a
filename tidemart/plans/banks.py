"""Bank-card cleansing: country, province, area and bank names by ordered rules."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.codes import replace_first_match
from ..functions.keys import user_key
from ..operators.matching import contained_names, longest_name_first
from ..sources.tables import inline_table
from .runs import with_login_name

# Names the rules look for, in the order in which they are tried.
PROVINCES = (
    "河北", "山西", "辽宁", "吉林", "黑龙江", "江苏", "浙江", "安徽", "福建", "江西", "山东", "河南",
    "湖北", "湖南", "广东", "海南", "四川", "贵州", "云南", "陕西", "甘肃", "青海", "台湾", "内蒙古",
    "广西", "西藏", "宁夏", "新疆", "北京", "天津", "上海", "重庆", "香港", "澳门",
)
CHINA, TAIWAN, VIETNAM = "中国", "台湾", "越南"
MUNICIPALITIES = ("北京", "天津", "上海", "重庆", "香港", "澳门")
VIETNAM_PRODUCT, VIETNAM_PROVINCE = "C07", "越南地区"
BANKS = (
    ("招", "招商银行"), ("工", "工商银行"), ("农", "农业银行"), ("建", "建设银行"),
    ("交", "交通银行"), ("民", "民生银行"), ("光", "光大银行"), ("兴", "兴业银行"),
    ("浦", "上海浦东发展银行"), ("广", "广东发展银行"), ("圳", "深圳发展银行"), ("平", "平安银行"),
    ("邮", "中国邮政储蓄银行"), ("夏", "华夏银行"), ("中信", "中信银行"), ("信", "农村信用社"),
    ("中国", "中国银行"), ("比", "比特币"), ("BTC", "比特币"), ("btc", "比特币"),
    ("CMB", "招商银行"), ("ABC", "农业银行"), ("CCB", "建设银行"), ("BOCOM", "交通银行"),
    ("渤海银行", "渤海银行"), ("ICBC", "工商银行"),
)
AREA_NOISE = "其他城市:|其他城市|省|市|:|,|：| |，"


def _contains_any(text: Column, names: tuple[str, ...]) -> Column:
    return text.rlike("|".join(names))


def _after_comma(text: Column) -> Column:
    """What follows the first comma, else the first full-width comma, else the text."""
    rest = text
    for comma in ("，", ","):
        cut = F.get(F.split(text, comma, 2), F.lit(1))
        rest = F.when(text.contains(comma), cut).otherwise(rest)
    return rest


def _country(country: Column, product: Column) -> Column:
    is_china = _contains_any(country, PROVINCES) | country.contains("CHINA")
    named = F.when(country.contains(TAIWAN), TAIWAN).when(is_china, CHINA).otherwise(country)
    return F.when(product == VIETNAM_PRODUCT, VIETNAM).otherwise(named)


def _province(province: Column, country: Column) -> Column:
    moved = F.when(country.contains(VIETNAM), VIETNAM_PROVINCE).otherwise(province)
    return replace_first_match(moved, [(p, p) for p in PROVINCES])


def bank_cleanse(
    customer_banks: DataFrame, customers: DataFrame, cities: DataFrame, load_time: str
) -> DataFrame:
    """First-priority bank cards with cleansed names.

    ``cities`` has (city, province). The two city rules look at every distinct text once; a text that
    very many cards share is one row there, and is split at run time when joined back.
    """
    cards = (
        customer_banks.where(F.col("priority_order") == 1)
        .withColumn("_area", _after_comma(F.col("province")))
        .withColumn("country", _country(F.col("country"), F.col("product_id")))
        .withColumn("province", _province(F.col("province"), F.col("country")))
    )
    # the union covers rule 8, where the area text becomes the name of a municipality
    texts = cards.select(F.explode(F.array("province", "_area")).alias("_text")).union(
        inline_table(cities.sparkSession, ["_text"], [[m] for m in MUNICIPALITIES])
    )
    found = contained_names(
        texts, "_text", cities.select("city", F.col("province").alias("city_province")),
        "city", [*longest_name_first("city"), F.col("city_province")],
    )
    by_province = found.select(F.col("_text").alias("province"), "city_province")
    by_area = found.select(F.col("_text").alias("_area"), F.col("city").alias("_city"))
    province = F.coalesce("city_province", "province")
    matched = cards.join(by_province, "province", "left").withColumn("province", province)
    is_municipality = F.col("province").isin(*MUNICIPALITIES)
    placed = matched.withColumn("_area", F.when(is_municipality, F.col("province")).otherwise(F.col("_area")))
    named = with_login_name(placed.join(by_area, "_area", "left"), customers)
    area = F.regexp_replace(F.coalesce("_city", "_area"), AREA_NOISE, "")
    return named.select(
        user_key("product_id", "login_name").alias("user_fk"),
        "product_id",
        replace_first_match("bank", BANKS).alias("bank"),
        "country",
        "province",
        area.alias("area"),
        "branch",
        "priority_order",
        F.lit(load_time).alias("load_time"),
        "dt",
    )

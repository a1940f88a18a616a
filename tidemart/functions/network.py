"""Addresses as sortable keys."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from .columns import col

IPV4 = r"^(\d{1,3})\.(\d{1,3})\.(\d{1,3})\.(\d{1,3})$"


def first_address(ip: Column | str) -> Column:
    """The first of several comma-separated addresses."""
    return F.trim(F.substring_index(col(ip), ",", 1))


def ipv4_number(ip: Column | str) -> Column:
    """IPv4 text → 0..2^32-1; null for blanks, IPv6 and anything that is not an address."""
    ip = first_address(ip)
    parts = F.split(ip, r"\.")
    octets = [F.get(parts, F.lit(i)).try_cast("bigint") for i in range(4)]
    number = F.lit(0).cast("bigint")
    for octet in octets:
        number = number * 256 + octet
    return F.when(ip.rlike(IPV4) & (F.greatest(*octets) <= 255), number)


MAPPED = "0" * 20 + "ffff"  # the place of IPv4 in the IPv6 space


def address_key(ip: Column | str) -> Column:
    """IPv4 or IPv6 text → 32 hexadecimal digits that sort like the addresses; null for anything else."""
    ip = F.lower(first_address(ip))
    number = ipv4_number(F.regexp_replace(ip, "^::ffff:(?=[0-9.]+$)", ""))
    halves = F.split(ip, "::")
    sides = [F.filter(F.split(F.coalesce(F.get(halves, F.lit(i)), F.lit("")), ":"), lambda g: g != "") for i in (0, 1)]
    given = F.size(sides[0]) + F.size(sides[1])
    gap = F.size(halves) == 2
    zeros = F.array_repeat(F.lit("0"), F.when(gap, 8 - given).otherwise(0))
    groups = F.concat(sides[0], zeros, sides[1])
    valid = ip.rlike("^[0-9a-f:]*:[0-9a-f:]*$") & ~ip.rlike("[0-9a-f]{5}|^:[^:]|[^:]:$|:::|^:$")
    valid = valid & (F.size(halves) <= 2) & F.when(gap, given <= 7).otherwise(given == 8)
    six = F.array_join(F.transform(groups, lambda g: F.lpad(g, 4, "0")), "")
    four = F.concat(F.lit(MAPPED), F.lpad(F.lower(F.hex(number)), 8, "0"))
    return F.coalesce(four, F.when(valid, six))

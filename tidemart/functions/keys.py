"""Composite keys: user keys, their product prefix and their class letter."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from .columns import col


def user_key(product: Column | str, login: Column | str) -> Column:
    """``product_login``; a missing part is written as the text ``null``."""
    null_text = F.lit("null")
    return F.concat(
        F.coalesce(col(product), null_text), F.lit("_"), F.coalesce(col(login), null_text)
    )


def key_prefix(key: Column | str) -> Column:
    """The part before the first underscore (the product of a composite key)."""
    return F.substring_index(col(key), "_", 1)


def is_regular_user(user: Column | str) -> Column:
    """The fifth character of a user key marks the class; ``r`` is a regular player."""
    return F.substring(col(user), 5, 1) == "r"

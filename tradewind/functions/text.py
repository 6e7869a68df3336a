"""Text clean-up and text-derived columns."""

from __future__ import annotations

from pyspark.sql import Column, functions as F

# Fixed values.
EMAIL_PATTERN = r"^[a-zA-Z0-9._%+\-]+@[a-zA-Z0-9.\-]+\.[a-zA-Z]{2,}$"
UUID_PATTERN = r"^[0-9a-f]{8}-[0-9a-f]{4}-[0-9a-f]{4}-[0-9a-f]{4}-[0-9a-f]{12}$"
ANONYMOUS_USERS = ("null", "guest", "")


def trimmed(name: str) -> Column:
    return F.trim(F.col(name)).alias(name)


def lowered(name: str) -> Column:
    return F.lower(F.trim(F.col(name))).alias(name)


def uppered(name: str) -> Column:
    return F.upper(F.trim(F.col(name))).alias(name)


def full_name(first: str, last: str) -> Column:
    """Both parts trimmed, joined by one blank; a missing part leaves the blank in place."""
    part = lambda name: F.coalesce(F.trim(F.col(name)), F.lit(""))
    return F.concat(part(first), F.lit(" "), part(last))


def is_anonymous(user: str) -> Column:
    value = F.lower(F.trim(F.col(user)))
    return F.col(user).isNull() | value.isin(*ANONYMOUS_USERS)


def city_of(address: str) -> Column:
    """Second comma-separated part, or 'Unknown' when there is none; at most 50 characters."""
    parts = F.split(F.coalesce(F.col(address), F.lit("")), ",")
    city = F.when(F.size(parts) > 1, F.trim(F.try_element_at(parts, F.lit(2)))).otherwise("Unknown")
    return F.substring(city, 1, 50)


def country_of(address: str) -> Column:
    """Last comma-separated part, or 'US' with fewer than three parts; at most 50 characters."""
    parts = F.split(F.coalesce(F.col(address), F.lit("")), ",")
    country = F.when(F.size(parts) > 2, F.trim(F.try_element_at(parts, F.lit(-1)))).otherwise("US")
    return F.substring(country, 1, 50)


def fill_template(template: Column, value: Column) -> Column:
    """Put ``value`` (or 'unknown') where the template says ``{id}``."""
    return F.replace(template, F.lit("{id}"), F.coalesce(value, F.lit("unknown")))


def sku_prefix(category: Column, index: Column) -> Column:
    """Upper-case initials of the category words and the index padded to five digits."""
    words = F.filter(F.split(category, r"\s+"), lambda word: word != "")
    initials = F.upper(F.array_join(F.transform(words, lambda word: F.substring(word, 1, 1)), ""))
    digits = index.cast("string")
    padded = F.when(F.length(digits) >= 5, digits).otherwise(F.lpad(digits, 5, "0"))
    return F.concat_ws("-", initials, padded)


def colon_offset(text: Column) -> Column:
    """Rewrite a trailing ``+HHMM`` zone offset as ``+HH:MM``."""
    return F.regexp_replace(text, r"([+-]\d{2})(\d{2})$", "$1:$2")

"""URL and keyword expressions."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, functions as F

# URL patterns of the event log.
SHOP_PATH = r"^/shop/.+"
SHOP_ID = r"^/shop/([0-9]+)"
PHOTO_PATH = r"^/shop/[0-9]+/photos"
SEARCH_PATH = r"/search/keyword/[0-9]+/0_"
SEARCH_WORD = r"/search/keyword/[0-9]+/0_(.+)"
SEARCH_CITY = r"/search/keyword/([0-9]+)/"
SEARCH_DEEPER = r"/search/keyword/[0-9]+/.+/"
ZERO_DEVICE = r"^[0]+$"
ASCII_WORDS = r"^[\w\s]+$"


def url_match(url: str, include: str, exclude: str) -> Column:
    low = F.lower(F.col(url))
    return low.rlike(include) & ~low.rlike(exclude)


def url_part(url: str, pattern: str) -> Column:
    return F.regexp_extract(F.lower(F.col(url)), pattern, 1)


def url_number(url: str, pattern: str, kind: str = "bigint") -> Column:
    """A number from a URL; null where the URL has none."""
    return url_part(url, pattern).try_cast(kind)


def clean_keyword(word: str) -> Column:
    """Percent-decoded, trimmed, lower case; null where the text is not valid percent-encoding."""
    return F.lower(F.trim(F.try_url_decode(F.col(word))))


def has_text(word: str) -> Column:
    return F.col(word).isNotNull() & (F.col(word) != "")


def readable(word: str, max_len: int) -> Column:
    return (F.length(word) <= max_len) | F.col(word).rlike(ASCII_WORDS)


def once(value: Column, body: Callable[[Column], Column]) -> Column:
    """``body(value)`` with the value computed once per row, also where lambdas inside use it."""
    return F.transform(F.array(value), body)[0]

"""What the steps count in the event log, so that it can be counted day by day."""

from __future__ import annotations

import zlib
from collections.abc import Callable
from dataclasses import dataclass

from pyspark.sql import DataFrame, functions as F, types as T

from footfall.params import Params
from footfall.plans import identity, keywords, region, tags, trending


@dataclass(frozen=True)
class Events:
    """Events with keys, day ``dt`` and count ``n``: counts of days add up to those of a window."""

    columns: str  # of the log
    keys: str  # a DDL schema
    rows: Callable[[DataFrame, Params], DataFrame]
    params: tuple[str, ...] = ()  # that decide on the rows

    @property
    def schema(self) -> T.StructType:
        return T.StructType.fromDDL(f"{self.keys}, n bigint, dt date")

    def per_day(self, log: DataFrame, p: Params) -> DataFrame:
        keys = [f.name for f in self.schema if f.name != "n"]
        return self.rows(log, p).groupBy(*keys).agg(F.sum("n").alias("n"))

    def folder(self, name: str, p: Params) -> str:
        """Counts made with other parameters lie in another folder."""
        values = [getattr(p, name) for name in self.params]
        return f"{name}-{zlib.crc32(repr(values).encode()):08x}" if values else name


EVENTS = {
    "page-views": Events(
        "guid_str user_id hp_log_type hp_stat_time", "guid string, userid bigint",
        lambda log, p: identity.page_views(log),
    ),
    "app-visits": Events(
        "deviceid user_id shop_id hp_log_type hp_stat_time", "deviceid string, userid bigint, shopid bigint",
        lambda log, p: region.app_visits(log),
    ),
    "shop-pages": Events(
        "guid_str page_id hp_log_type hp_stat_time path", "guid string, shopid bigint",
        lambda log, p: tags.shop_pages(log, p.page_type), ("page_type",),
    ),
    "searches": Events(
        "guid_str city_id hp_log_type hp_stat_time path", "guid string, cityid int, keyword string",
        lambda log, p: keywords.searches(log),
    ),
    "shop-clicks": Events(
        "city_id hp_log_type hp_stat_time path referer", "cityid int, shopid bigint, keyword string",
        lambda log, p: keywords.shop_clicks(log),
    ),
    "search-clicks": Events(
        "guid_str user_id city_id shop_id hp_log_type hp_stat_time path referer", "cityid int, keyword string",
        lambda log, p: trending.keyword_clicks(trending.clean_clicks(trending.search_clicks(log, p), p)),
        ("seed", "click_drop", "blocked"),
    ),
}

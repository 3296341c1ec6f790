"""The event log, shop dimension and other inputs, derived from the given star-schema tables.

Every view scans only the columns it needs and joins only the tables those columns come from.
"""

from __future__ import annotations

from collections.abc import Callable
from functools import cached_property
from threading import Lock

from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from footfall.operators.joins import restrict
from footfall.sources.state import shifted
from footfall.sources.storage import materialise

_TRAFFIC_SHOP = {"shop_id", "city_id", "path", "referer"}
_TRAFFIC_CITY = {"city_id", "path", "referer"}
_TRAFFIC_PART = {"path", "referer"}
_SHOP_REGION = {"district_id", "district_name"}


class Warehouse:
    def __init__(
        self, spark: SparkSession, sf_dir: str, as_of: str, cut: Callable[[DataFrame, str], DataFrame] = materialise
    ):
        self.spark, self.sf_dir, self.as_of, self._cut = spark, sf_dir, as_of, cut
        self._tables: dict[str, DataFrame] = {}
        self._lock = Lock()

    def table(self, name: str) -> DataFrame:
        if name not in self._tables:
            self._tables[name] = self.spark.read.parquet(f"{self.sf_dir}/{name}.parquet")
        return self._tables[name]

    @cached_property
    def _n_shops(self) -> Column:
        """One number, counted once per job: as a literal it keeps the plans small."""
        return F.lit(self.table("supplier").count())

    def _within(
        self, orders: DataFrame, since: str | None, before: str | None, periods: tuple[str, str] | None = None,
        until: str | None = None,
    ) -> DataFrame:
        if periods is not None:
            day = F.col("o_orderdate")
            orders = orders.filter((day >= _midnight(periods[0])) | (day < _midnight(periods[1])))
        if since is not None:
            orders = orders.filter(F.col("o_orderdate") >= _midnight(since))
        if before is not None:
            orders = orders.filter(F.col("o_orderdate") < _midnight(before))
        end = min(until or self.as_of, self.as_of)
        return orders.filter(F.col("o_orderdate") < _midnight(shifted(end, 1)))

    def _shop_city(self) -> DataFrame:
        """Stored, as Spark takes the size of a join for the product of its inputs: read from a table of its size it
        is broadcast where it is small, before the rows that meet it are shuffled."""
        with self._lock:
            if "shop-city" not in self._tables:
                self._tables["shop-city"] = self._cut(self._join_shop_city(), "shop-city")
            return self._tables["shop-city"]

    def _join_shop_city(self) -> DataFrame:
        supplier = self.table("supplier").select("s_suppkey", "s_nationkey")
        nation = self.table("nation").select("n_nationkey", "n_regionkey")
        joined = supplier.join(nation, F.col("s_nationkey") == F.col("n_nationkey"))
        return joined.select(F.col("s_suppkey").alias("shop_id"), "n_regionkey")

    def _joined_log(self) -> DataFrame:
        lines = self.table("lineitem").select(
            "l_orderkey", "l_partkey", "l_suppkey", "l_linenumber", "l_quantity", "l_discount"
        )
        orders = self.table("orders").select("o_orderkey", "o_custkey", "o_orderdate")
        return lines.join(orders, F.col("l_orderkey") == F.col("o_orderkey")).drop("o_orderkey")

    def store_log(self) -> None:
        """Store the lines joined to their orders, where several views of a job need them: the two large tables are
        shuffled once, and the views read the stored rows."""
        with self._lock:
            if "log" not in self._tables:
                self._tables["log"] = self._cut(self._joined_log(), "log")

    @property
    def stored(self) -> bool:
        return "log" in self._tables

    def _lines_of(self, orders: Callable[[DataFrame], DataFrame], *cols: str) -> DataFrame:
        """Lines with the customer and day of their orders, those that ``orders`` keeps."""
        if self.stored:
            return orders(self._tables["log"]).select("l_orderkey", *cols, "o_custkey", "o_orderdate")
        lines = self.table("lineitem").select("l_orderkey", *cols)
        of = orders(self.table("orders").select("o_orderkey", "o_custkey", "o_orderdate"))
        return lines.join(of, F.col("l_orderkey") == F.col("o_orderkey"))

    def traffic(
        self, *cols: str, since: str | None = None, before: str | None = None,
        periods: tuple[str, str] | None = None, until: str | None = None,
    ) -> DataFrame:
        """The event log: one event per line item. The date window, from ``since`` on, before ``before``
        or up to ``until``, never beyond as_of, reaches the orders scan; ``periods`` are two windows:
        from its first day on, and before its second."""
        log = self._lines_of(
            lambda orders: self._within(orders, since, before, periods, until), "l_partkey", "l_suppkey", "l_linenumber"
        )
        if _TRAFFIC_SHOP & set(cols):
            log = log.withColumn("shop_id", _visited_shop(self._n_shops))
        if _TRAFFIC_CITY & set(cols):
            log = log.join(self._shop_city(), "shop_id")
        if _TRAFFIC_PART & set(cols):
            part = self.table("part").select("p_partkey", "p_name")
            log = log.join(part, F.col("l_partkey") == F.col("p_partkey"))
        return log.select(*[_TRAFFIC[c]().alias(c) for c in cols])

    def _supplier_geo(self, cols: tuple[str, ...]) -> DataFrame:
        nation = self.table("nation")
        geo = self.table("supplier").join(nation, F.col("s_nationkey") == F.col("n_nationkey"))
        if _SHOP_REGION & set(cols):
            region = self.table("region")
            geo = geo.join(region, F.col("n_regionkey") == F.col("r_regionkey"))
        if "shop_tags" in cols:
            tagged = F.col("s_suppkey") == F.col("tag_shop")
            geo = geo.join(self._packed_tags(), tagged, "left")
        return geo

    def shops(self, *cols: str) -> DataFrame:
        """The shop dimension with history: the current version and one expired copy of each shop,
        told apart by ``hp_valid_end_dt``; the expired copy was in another city."""
        versions = F.explode(F.array(
            F.struct(
                F.col("n_regionkey").alias("city_id"),
                F.lit("3000-12-31").alias("hp_valid_end_dt"),
            ),
            F.struct(
                ((F.col("n_regionkey") + 1) % 5).alias("city_id"),
                F.lit("2000-01-01").alias("hp_valid_end_dt"),
            ),
        ))
        named = [_SHOP[c]().alias(c) for c in cols]
        both = self._supplier_geo(cols).select(*named, versions.alias("_v"))
        return both.select(*cols, "_v.city_id", "_v.hp_valid_end_dt")

    def current_shops(self, *cols: str) -> DataFrame:
        """The shop snapshot: current versions only."""
        return self._supplier_geo(cols).select(*[_SHOP[c]().alias(c) for c in cols])

    def _packed_tags(self) -> DataFrame:
        """The words of the part names and types a shop sells, counted and packed: at most one entry
        per word of the part vocabulary, so the collected list is short."""
        lines = self.table("lineitem").select("l_suppkey", "l_partkey")
        part = self.table("part").select("p_partkey", "p_name", "p_type", "p_size")
        sold = (
            lines.groupBy("l_suppkey", "l_partkey").agg(F.count(F.lit(1)).alias("n"))
            .join(part, F.col("l_partkey") == F.col("p_partkey"))
        )
        names = sold.select("l_suppkey", "n", F.explode(_part_words()).alias("word"))
        words = names.groupBy("l_suppkey", "word").agg(F.sum("n").alias("n"))
        pair = F.concat("word", F.lit(":"), F.col("n").cast("string"))
        return words.groupBy(F.col("l_suppkey").alias("tag_shop")).agg(
            F.array_join(F.array_sort(F.collect_list(pair)), ",").alias("shop_tags")
        )

    def tag_vocabulary(self) -> DataFrame:
        """(tag, tagtype): first words of part names, second words, and sized types are a type each."""
        words = _part_words()
        kinds = ("character", "atmosphere", "cuisine")
        typed = F.array(*[
            F.struct(F.get(words, F.lit(k)).alias("tag"), F.lit(kind).alias("tagtype"))
            for k, kind in enumerate(kinds)
        ])
        return self.table("part").select(F.inline(typed)).distinct()

    def reviews(self) -> DataFrame:
        lines = self._lines_of(lambda orders: orders, "l_partkey", "l_suppkey", "l_quantity")
        city = self._shop_city().withColumnRenamed("shop_id", "l_suppkey")
        return (
            lines.join(city, "l_suppkey")
            .select(
                F.col("o_custkey").alias("userid"),
                F.col("n_regionkey").alias("cityid"),
                F.col("l_partkey").alias("shopid"),
                (F.floor(F.col("l_quantity") / 10) * 10).cast("double").alias("star"),
                F.lit("3000-12-31").alias("hp_valid_end_dt"),
            )
        )

    def _reviewed(self) -> Column:
        return F.regexp_extract("source", "([0-9]+)$", 1).try_cast("bigint")

    def review_heads(self) -> DataFrame:
        return self.table("documents").select(
            F.col("doc_id").alias("reviewid"),
            (self._reviewed() % 5).cast("int").alias("cityid"),
            self._reviewed().alias("shopid"),
        )

    def review_bodies(self) -> DataFrame:
        day = F.date_add(F.lit("2024-01-01").cast("date"), (F.col("doc_id") % 30).cast("int"))
        return self.table("documents").select(
            F.col("doc_id").alias("reviewid"),
            F.col("text").alias("reviewbody"),
            day.alias("hp_statdate"),
        )

    def item_edges(self) -> DataFrame:
        """Shop to shop similarity: shops bought next to each other, in both directions. One line
        item gives two edge rows, so the table grows with the lines, not with their square."""
        next_shop = _neighbour_shop(F.col("l_suppkey"), self._n_shops)
        lines = self.table("lineitem").select(
            F.col("l_suppkey").alias("a"), next_shop.alias("b")
        )
        both = F.array(
            F.struct(F.col("a").alias("sid1"), F.col("b").alias("sid2")),
            F.struct(F.col("b").alias("sid1"), F.col("a").alias("sid2")),
        )
        pairs = lines.groupBy("a", "b").agg(F.count(F.lit(1)).alias("n"))
        edges = pairs.select(F.inline(both), "n").filter(F.col("sid1") != F.col("sid2"))
        return edges.groupBy("sid1", "sid2").agg((F.sum("n") / 100.0).alias("rank"))

    def feedback(self) -> DataFrame:
        """Explicit feedback of a device on a shop."""
        k = F.get_json_object("props", "$.k").cast("bigint")
        rows = self.table("events").filter(F.col("event_type").isin("error", "click")).select(
            F.col("user_id").cast("string").alias("deviceid"),
            ((F.col("user_id") * 31 + k) % self._n_shops).alias("shop_id"),
            (F.col("value") - 50).alias("score"),
            F.col("ts").cast("date").alias("updatetime"),
        )
        return rows.join(self._shop_city(), "shop_id").select(
            "deviceid", F.col("n_regionkey").alias("cityid"), F.col("shop_id").alias("shopid"),
            "score", "updatetime",
        )

    def promo(self) -> DataFrame:
        return self.table("supplier").select(
            F.col("s_suppkey").alias("shop_id"),
            (F.col("s_suppkey") % 5 + 1).cast("double").alias("score"),
        )

    def accumulated_recs(
        self, before: str, above: float | None = None, devices: DataFrame | None = None
    ) -> DataFrame:
        """Recommendations kept from earlier days: neighbours of the shops a device bought from; only those whose
        rank, the largest of some lines, is ``above`` a floor, and those of ``devices``: no other line need be shuffled."""
        lines = self._lines_of(lambda orders: self._within(orders, None, before), "l_suppkey", "l_quantity", "l_discount")
        if above is not None:
            lines = lines.filter(F.col("l_discount") > above)
        rows = lines.select(
            F.col("o_custkey").cast("string").alias("deviceid"),
            _neighbour_shop(F.col("l_suppkey"), self._n_shops).alias("shop_id"),
            "l_discount",
        )
        rows = rows if devices is None else restrict(rows, devices, ["deviceid"])
        best = rows.groupBy("deviceid", "shop_id").agg(F.max("l_discount").alias("rank"))
        return best.join(self._shop_city(), "shop_id").select(
            "deviceid", F.col("n_regionkey").alias("cityid"), F.col("shop_id").alias("shopid"), "rank"
        )


def _part_words() -> Column:
    """The two words of a part's name, and its type with its size: some shops sell it, others not."""
    sized = F.concat_ws("-", F.lower("p_type"), F.col("p_size").cast("string"))
    return F.concat(F.split("p_name", " "), F.array(sized))


def _midnight(day: str) -> Column:
    return F.lit(day).cast("timestamp_ntz")


def _visited_shop(n_shops: Column) -> Column:
    """Lines 1 to 3 go to one of the three shops a customer visits again and again."""
    regular = (F.col("o_custkey") * 31 + F.col("l_linenumber")) % n_shops
    return F.when(F.col("l_linenumber") <= 3, regular).otherwise(F.col("l_suppkey"))


def _neighbour_shop(shop: Column, n_shops: Column) -> Column:
    return (shop + 1 + F.floor(F.col("l_quantity") / 4)) % n_shops


def _search_url(city: Column, root: str = "/search") -> Column:
    word = F.replace(F.col("p_name"), F.lit(" "), F.lit("%20"))
    return F.concat(F.lit(f"{root}/keyword/"), city.cast("string"), F.lit("/0_"), word)


def _path() -> Column:
    photos = F.when(F.col("l_partkey") % 10 == 0, "/photos").otherwise("")
    shop = F.concat(F.lit("/shop/"), F.col("shop_id").cast("string"), photos)
    search = _search_url(F.col("n_regionkey"), "/Search")
    return F.when(F.col("l_orderkey") % 3 == 0, search).otherwise(shop)


def _referer() -> Column:
    part, city = F.col("l_partkey"), F.col("n_regionkey")
    searched = F.when(part % 10 == 1, (city + 1) % 5).otherwise(city)
    return F.when(part % 3 > 0, _search_url(searched)).otherwise("")


def _log_type() -> Column:
    line = F.col("l_linenumber")
    return F.when(line <= 5, line + 99).otherwise(line - 6)


def _user() -> Column:
    return F.when(F.col("o_custkey") % 7 == 0, F.lit(0)).otherwise(F.col("o_custkey"))


def _dish_tags() -> Column:
    kind = F.col("s_suppkey") % 3
    return (
        F.when(kind == 0, "the:3,and:2,für:1,of the:2").when(kind == 1, "of:1,is:4,none:1,à:2,红烧肉:1")
        .otherwise("the:1,is:1,de la:2,ó:1")
    )


def _shop_name() -> Column:
    """Names of several lengths."""
    key = F.col("s_suppkey").cast("string")
    return (
        F.when(F.col("s_suppkey") % 3 == 0, F.concat(F.lit("Bar "), key))
        .when(F.col("s_suppkey") % 3 == 1, F.concat(F.lit("Kitchen "), key)).otherwise(F.col("s_name"))
    )


_SHOP = {
    "shop_id": lambda: F.col("s_suppkey"),
    "shop_name": _shop_name,
    "city_id": lambda: F.col("n_regionkey"),
    "region_id": lambda: F.col("n_nationkey"),
    "region_name": lambda: F.col("n_name"),
    "district_id": lambda: F.col("r_regionkey"),
    "district_name": lambda: F.col("r_name"),
    "cat0_id": lambda: F.lit(10),
    "cat1_id": lambda: (F.col("s_suppkey") % 6).cast("int"),
    "star": lambda: ((F.col("s_suppkey") % 5 + 1) * 10).cast("int"),
    "power": lambda: ((F.col("s_suppkey") % 3) * 5).cast("int"),
    "avg_price": lambda: (F.col("s_acctbal") / 25).cast("int"),
    "shop_tags": lambda: F.coalesce("shop_tags", F.lit("")),
    "dish_tags": _dish_tags,
}

_TRAFFIC = {
    "guid_str": lambda: F.concat(F.lit("g"), F.floor(F.col("o_custkey") / 3).cast("string")),
    "user_id": _user,
    "deviceid": lambda: F.col("o_custkey").cast("string"),
    "shop_id": lambda: F.col("shop_id"),
    "city_id": lambda: F.col("n_regionkey"),
    "page_id": lambda: F.when(F.col("l_partkey") % 5 < 4, 12).otherwise(7),
    "hp_log_type": _log_type,
    "hp_stat_time": lambda: F.col("o_orderdate").cast("date"),
    "path": _path,
    "referer": _referer,
}

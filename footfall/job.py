"""All steps over one warehouse, each built once.

A step is a DataFrame property. Steps that feed several others are written to the job's folder below
the shared folder (``_cut``), so they run once per job and survive lost executors: reading such a
property runs the steps before it.

A job may have a state folder. Then what earlier days left there takes the place of what is otherwise
derived from the older part of the log, events are counted once per day, and ``run`` publishes today's
version of all state tables together.
"""

from __future__ import annotations

from collections import defaultdict
from concurrent.futures import ThreadPoolExecutor
from threading import Lock, RLock

from pyspark.sql import DataFrame, SparkSession, functions as F

from footfall import schemas
from footfall.functions.sampling import hash_uniform
from footfall.operators import joins, merging
from footfall.operators.groups import tf_idf
from footfall.operators.joins import exclude, in_periods, period_delta, restrict, trend_delta
from footfall.operators.ranking import argmax_per_group, top_k_per_group
from footfall.params import Params
from footfall.plans import (
    device_recs as dr, dishes as di, identity as idn, keywords as kw, kpi, ratings as rt,
    region as rg, tags as tg, trending as tr,
)
from footfall.plans.events import EVENTS
from footfall.plans.shops import eligible, searchable
from footfall.session import new_path, release
from footfall.sources import storage
from footfall.sources.state import DailyCounts, Day, StateStore, by_range, shifted
from footfall.sources.warehouse import Warehouse

APP = ("deviceid", "user_id", "shop_id", "hp_log_type", "hp_stat_time")

#: What a day leaves for the next: step and schema by the name of the stored table.
STATE = {
    "identity-counts": ("_compact", schemas.PAIR_COUNTS),
    "main-user": ("identity_main_user", schemas.MAIN_USER),
    "region-scores": ("region_hot_smoothed", schemas.REGION_SCORES),
    "keyword-shares": ("keyword_city_share", schemas.KEYWORD_SCORES),
    "accumulated": ("state_replace_groups", schemas.DEVICE_RECS),
    "recommendations": ("_top50", schemas.DEVICE_RECS),
    "keyword-hot": ("keyword_hot_top15", schemas.KEYWORD_SCORES),
}
SCHEMAS = {name: schema for name, (_, schema) in STATE.items()}


class step:  # noqa: N801
    """A property that is built once per job, also when several threads ask for it at a time."""

    def __init__(self, build):
        self.build, self.name = build, build.__name__
        self.__doc__ = build.__doc__

    def __get__(self, job, _owner=None):
        if job is None:
            return self
        with job.lock(self.name):
            if self.name not in job.__dict__:
                job.__dict__[self.name] = self.build(job)
            return job.__dict__[self.name]


class Job:
    def __init__(
        self, spark: SparkSession, sf_dir: str, params: Params | None = None,
        state_root: str | None = None,
    ):
        self.spark, self.p, self.state_root = spark, params or Params(), state_root
        self.wh = Warehouse(spark, sf_dir, self.p.as_of, self._cut)
        self.folder = new_path(spark, "job")
        self._locks: dict[str, RLock] = defaultdict(RLock)
        self._guard = Lock()

    def lock(self, name: str) -> RLock:
        with self._guard:
            return self._locks[name]

    def __enter__(self) -> Job:
        return self

    def __exit__(self, *_) -> None:
        self.close()

    def close(self) -> None:
        """Delete the job's intermediate tables: frames read from them cannot be used any more."""
        release(self.spark, self.folder)

    def _cut(self, df: DataFrame, name: str) -> DataFrame:
        return storage.materialise(df, name, self.folder)

    def _together(self, *names: str) -> None:
        """Run the jobs behind independent steps side by side: most are too small to fill a cluster."""
        with ThreadPoolExecutor(len(names)) as pool:
            list(pool.map(lambda name: getattr(self, name), names))

    def _path(self, name: str) -> str:
        return new_path(self.spark, name, self.folder)

    # -- state between days -----------------------------------------------------------------------

    @step
    def store(self) -> StateStore | None:
        return StateStore(self.spark, self.state_root, SCHEMAS) if self.state_root else None

    @step
    def _day_before(self) -> Day | None:
        """The latest committed day before today: all that the job reads of the state is of this one."""
        return self.store.before(self.p.as_of) if self.store else None

    def _before(self, name: str) -> DataFrame | None:
        return self._day_before.read(name) if self._day_before else None

    def run(self) -> None:
        """Publish today's version of all state tables. Versions of today are never read, so a run
        that failed half-way is repeated as a whole, and one that is repeated gives the same."""
        self.store.publish(self.p.as_of, {
            name: lambda made=made: getattr(self, made) for name, (made, _) in STATE.items()
        })

    # -- events -----------------------------------------------------------------------------------

    @step
    def _since(self) -> dict[str, str]:
        """The first day that is needed of each kind of events; the last is as_of."""
        day = self._day_before
        views = min(self.p.visit_since, self.p.active_since)
        return {name: self.p.visit_since for name in EVENTS} | {
            "page-views": shifted(day.dt, 1) if day else self.p.identity_batch_since,
            "app-visits": views, "shop-pages": views,
        }

    @step
    def _counted(self) -> DailyCounts:
        """Counts of the days up to as_of: those not counted yet are counted now, all kinds of events
        from one scan of these days."""
        counts = DailyCounts(self.spark, f"{self.state_root}/_events")
        folders = {name: e.folder(name, self.p) for name, e in EVENTS.items()}
        missing = [(name, gap) for name in EVENTS for gap in counts.missing(folders[name], self._since[name], self.p.as_of)]
        for (first, last), names in by_range(missing).items():
            columns = {c for name in names for c in EVENTS[name].columns.split()}
            log = self.wh.traffic(*sorted(columns), since=first, until=last)
            log = self._cut(log, "new-events") if len(names) > 1 else log
            for name in names:
                counts.write(folders[name], EVENTS[name].per_day(log, self.p), first, last)
        return counts

    def _events(self, name: str, since: str) -> DataFrame:
        """Events from ``since`` to as_of: counted per day where there is a state folder."""
        events = EVENTS[name]
        if self.store is None:
            return events.rows(self.wh.traffic(*events.columns.split(), since=since), self.p)
        return self._counted.read(events.folder(name, self.p), events.schema, since, self.p.as_of)

    # -- identity ---------------------------------------------------------------------------------

    @step
    def identity_pair_counts(self) -> DataFrame:
        """The batch: what came after the stored counts, up to as_of."""
        return idn.pair_counts(self._events("page-views", self._since["page-views"]))

    @step
    def identity_state(self) -> DataFrame:
        stored = self._before("identity-counts")
        if stored is not None:
            return stored
        log = self.wh.traffic("guid_str", "user_id", "hp_log_type", "hp_stat_time", before=self.p.identity_batch_since)
        return idn.pair_counts(idn.page_views(log)).filter(F.col("cnt") > self.p.min_pair_count)

    @step
    def identity_compact(self) -> DataFrame:
        keys = ["guid", "userid"]
        return merging.compact_counts(
            self.identity_state, self.identity_pair_counts, keys, "cnt", self.p.min_pair_count
        )

    @step
    def _compact(self) -> DataFrame:
        return self._cut(self.identity_compact, "identity-counts")

    @step
    def identity_main_user(self) -> DataFrame:
        counts = self._compact if self.store else self.identity_compact  # the run stores them too
        return argmax_per_group(counts, "guid", "userid", "cnt")

    @step
    def _main_user(self) -> DataFrame:
        return self._cut(self.identity_main_user, "main-user")

    @step
    def identity_old_main_user(self) -> DataFrame:
        stored = self._before("main-user")
        if stored is not None:
            return stored
        return argmax_per_group(self.identity_state, "guid", "userid", "cnt")

    @step
    def identity_delta(self) -> DataFrame:
        return joins.snapshot_delta(
            self.identity_main_user, self.identity_old_main_user, "guid", "userid"
        )

    @step
    def state_rotation(self) -> DataFrame:
        """The delta feed again, through two stored days."""
        store = StateStore(self.spark, self._path("main-user-days"), SCHEMAS)
        store.publish(self.p.identity_batch_since, {"main-user": lambda: self.identity_old_main_user})
        today = store.publish(self.p.as_of, {"main-user": lambda: self.identity_main_user})
        before = store.before(today.dt)
        return joins.snapshot_delta(today.read("main-user"), before.read("main-user"), "guid", "userid")

    # -- shops ------------------------------------------------------------------------------------

    def _eligible(self, *cols: str) -> DataFrame:
        return eligible(self.wh.shops("shop_id", "star", "power", *cols), self.p)

    def _searchable(self) -> DataFrame:
        return searchable(self.wh.shops("shop_id", "shop_name", "star", "power"), self.p)

    # -- device region ----------------------------------------------------------------------------

    @step
    def _app_visits(self) -> DataFrame:
        """Visits in the windows of all device steps, from one scan of the log."""
        visits = self._events("app-visits", self._since["app-visits"])
        return visits if self.wh.stored else self._cut(visits, "app-visits")

    @step
    def _stored_log(self) -> None:
        """For chains that read the log for visits and for ratings. Visits counted per day do not need it."""
        if self.store is None:
            self.wh.store_log()

    def _visits_since(self, since: str) -> DataFrame:
        return self._app_visits.filter(F.col("dt") >= F.lit(since).cast("date"))

    @step
    def device_visits(self) -> DataFrame:
        return rg.device_visits(self._visits_since(self.p.visit_since))

    def _affinity_of(self, visits: DataFrame) -> DataFrame:
        shops = self.wh.shops("shop_id", "region_id").filter(
            F.col("hp_valid_end_dt") == self.p.current_version
        )
        return rg.region_affinity(visits, shops)

    @step
    def device_region_affinity(self) -> DataFrame:
        return self._affinity_of(self.device_visits)

    @step
    def _affinity(self) -> DataFrame:
        return self._cut(self.device_region_affinity, "affinity")

    @step
    def _region_stats(self) -> DataFrame:
        return rg.region_stats(self._affinity)

    @step
    def device_region_entropy(self) -> DataFrame:
        return self._region_stats.select("deviceid", "cityid", "entropy")

    @step
    def device_region_weighted(self) -> DataFrame:
        return rg.concentration(self.device_region_affinity)

    @step
    def device_region_breadth(self) -> DataFrame:
        return rg.breadth(self.device_region_weighted)

    # -- ratings ----------------------------------------------------------------------------------

    @step
    def ratings_load(self) -> DataFrame:
        return rt.ratings(self.wh.reviews(), self.p)

    @step
    def _rated(self) -> DataFrame:
        return self.ratings_load if self.wh.stored else self._cut(self.ratings_load, "rated")

    @step
    def ratings_normalised(self) -> DataFrame:
        return rt.normalised(self._rated)

    @step
    def ratings_centred(self) -> DataFrame:
        """Straight from the ratings: dividing by the user's count cancels in the ratio to the mean."""
        return rt.centred(self._rated)

    @step
    def _members(self) -> DataFrame:
        """The centred ratings, summed per user, city and shop."""
        return self._cut(rt.centred_members(self._rated, self.p), "members")

    @step
    def _marked_members(self) -> DataFrame:
        """``_members`` with a mark on the users of the active devices."""
        return self._cut(rt.centred_members(self._rated, self.p, self._active.select("userid")), "marked-members")

    @step
    def _asked_members(self) -> DataFrame:
        """``_members`` with marks on the users and cities that have a recommendation to agree with."""
        return self._cut(rt.centred_members(self._rated, self.p, self._wanted), "asked-members")

    @step
    def user_similarity(self) -> DataFrame:
        return rt.user_similarity(self._members, self.p, self._cut)

    @step
    def cf_recommend(self) -> DataFrame:
        return rt.recommend(self.user_similarity, self._members, self.p)

    # -- device recommendations -------------------------------------------------------------------

    @step
    def visits_decayed_topk(self) -> DataFrame:
        return dr.decayed_visits(self._visits_since(self.p.visit_since), self.p)

    @step
    def visits_active(self) -> DataFrame:
        return dr.active_visits(self._events("app-visits", self.p.active_since))

    @step
    def _active(self) -> DataFrame:
        return self._cut(dr.active_visits(self._visits_since(self.p.active_since)), "active")

    @step
    def _active_devices(self) -> DataFrame:
        """Stored, as is ``Warehouse._shop_city``: where they are few, they reach the visits before these are shuffled."""
        return self._cut(self._active.select("deviceid").distinct(), "active-devices")

    def _visits_of_active(self) -> DataFrame:
        return restrict(self._visits_since(self.p.visit_since), self._active_devices, ["deviceid"])

    @step
    def visits_of_active(self) -> DataFrame:
        """``visits_decayed_topk`` of the active devices: the others are left out first, as each device stands alone."""
        return dr.decayed_visits(self._visits_of_active(), self.p)

    @step
    def _visits(self) -> DataFrame:
        return self._cut(self.visits_of_active, "visits")

    @step
    def _item_edges(self) -> DataFrame:
        return self._cut(self.wh.item_edges(), "item-edges")

    @step
    def _edges(self) -> DataFrame:
        return self._cut(dr.edges_to(self._item_edges, self._eligible()), "edges")

    @step
    def rec_hop1(self) -> DataFrame:
        self._together("_visits", "_edges")
        repeated = self._visits.filter(F.col("cnt") > 1)
        return dr.expand_items(
            repeated, F.log10(1 + F.col("cnt")), ["deviceid", "userid", "shopid"], self._edges,
            self.p.hop1_k, self.p, "hop1",
        )

    @step
    def rec_hop2(self) -> DataFrame:
        return dr.expand_items(
            self.rec_hop1, F.col("rank"), ["deviceid", "shopid"], self._edges, self.p.hop2_k,
            self.p, "hop2",
        )

    @step
    def rec_popularity_damped(self) -> DataFrame:
        hop2 = self._cut(self.rec_hop2, "hop2")
        return dr.damped_by_popularity(hop2)

    @step
    def dislike_expand(self) -> DataFrame:
        return dr.expand_dislikes(self.wh.feedback(), self._item_edges, self.p)

    @step
    def dislike_union(self) -> DataFrame:
        return dr.exclusions(self.dislike_expand, self.wh.feedback(), self.p)

    @step
    def rec_exclude_disliked(self) -> DataFrame:
        return exclude(self.rec_popularity_damped, self.dislike_union, dr.REC)

    @step
    def _recs(self) -> DataFrame:
        return self._cut(self.rec_exclude_disliked, "recs")

    @step
    def accumulated(self) -> DataFrame:
        stored = self._before("accumulated")
        if stored is not None:
            return stored
        return self.wh.accumulated_recs(before=self.p.active_since)

    @step
    def state_exclude_feedback(self) -> DataFrame:
        return exclude(self.accumulated, self.wh.feedback(), dr.REC)

    @step
    def rec_promo_boost(self) -> DataFrame:
        return dr.with_promo_boost(self._recs, self.wh.promo())

    @step
    def rec_from_reviews(self) -> DataFrame:
        """Like ``cf_recommend``, for the users of the active devices only: the others are left out
        before the pairs are formed."""
        return self._from_reviews(self._marked_members)

    def _from_reviews(self, members: DataFrame, wanted: DataFrame | None = None) -> DataFrame:
        """All rows, or those of the (user, city, shop) in ``wanted``."""
        similar = rt.user_similarity(members, self.p, self._cut)
        recs = rt.recommend(similar, members, self.p, wanted)
        return dr.user_recs_to_device(self._active, recs)

    @step
    def _wanted(self) -> DataFrame:
        return self._cut(dr.wanted_of_users(self._active, self._recs).distinct(), "wanted")

    @step
    def rec_agreement_boost(self) -> DataFrame:
        """Only rows that both sources have are boosted: users are compared in the cities where a device of theirs has a
        recommendation, and of what reviews recommend the rows that no device has are not shuffled."""
        self._stored_log
        agreeing = self._from_reviews(self._asked_members, self._wanted)
        return dr.with_agreement_boost(self.rec_promo_boost, agreeing, self.p.agreement_weight)

    @step
    def rec_merge_sum(self) -> DataFrame:
        return merging.merge_scores(self.rec_agreement_boost, dr.REC, "rank", "sum")

    @step
    def rec_unseen(self) -> DataFrame:
        return dr.unseen(self.rec_merge_sum, self._visits)

    @step
    def rec_seen_negated(self) -> DataFrame:
        return dr.seen_negated(self.rec_merge_sum, self._visits)

    @step
    def rec_top200(self) -> DataFrame:
        signed = dr.mark_seen(self.rec_merge_sum, self._visits)
        return top_k_per_group(signed, dr.DEVICE_CITY, self.p.merged_k, "rank", ["shopid"])

    @step
    def _top200(self) -> DataFrame:
        return self._cut(self.rec_top200, "top200")

    @step
    def region_hot_shops(self) -> DataFrame:
        return dr.region_hot_shops(self._active, self._eligible("region_id"))

    @step
    def region_hot_smoothed(self) -> DataFrame:
        return dr.region_tf(self.region_hot_shops, self.p, f"{self.p.seed}-region")

    def _region_moved(self) -> DataFrame:
        """Scores against those of the day before; without a stored day against those of an earlier
        period, both periods from one scan of the log."""
        stored = self._before("region-scores")
        if stored is not None:
            return trend_delta(self.region_hot_smoothed, stored, dr.REGION_SHOP, "score")
        salt = F.when(F.col("period") == 1, f"{self.p.seed}-region").otherwise(
            f"{self.p.seed}-region-prev"
        )
        scored = dr.region_tf(self._period_hot, self.p, salt, "period")
        return period_delta(scored, dr.REGION_SHOP, "score")

    @step
    def _period_hot(self) -> DataFrame:
        bounds = (self.p.active_since, self.p.region_prev_before)
        visits = in_periods(rg.app_visits(self.wh.traffic(*APP, periods=bounds)), "dt", *bounds)
        hot = dr.region_hot_shops(
            dr.active_visits(visits, "period"), self._eligible("region_id"), "period"
        )
        return self._cut(hot, "region-hot")

    @step
    def region_trend(self) -> DataFrame:
        return top_k_per_group(
            self._region_moved(), ["cityid", "regionid"], self.p.region_trend_k, "score",
            ["shopid"],
        )

    @step
    def rec_by_region(self) -> DataFrame:
        """With ``device_region_breadth`` of the active devices: no other has recommendations."""
        self._stored_log
        affinity = self._affinity_of(rg.device_visits(self._visits_of_active()))
        liked = rg.breadth(rg.concentration(affinity))
        return dr.region_recs(self._top200, liked, self.region_trend, self.p)

    @step
    def state_decay(self) -> DataFrame:
        return merging.decay_state(
            self.state_exclude_feedback, "rank", self.p.state_factor, self.p.state_floor
        )

    @step
    def _decayed(self) -> DataFrame:
        """``state_decay``, where nothing is stored from the lines above the floor only."""
        if self._before("accumulated") is not None:
            return self._cut(self.state_decay, "decayed")
        return self._cut(self._decayed_of(), "decayed")

    def _decayed_of(self, devices: DataFrame | None = None) -> DataFrame:
        strong = self.wh.accumulated_recs(before=self.p.active_since, above=self.p.state_floor, devices=devices)
        left = exclude(strong, self.wh.feedback(), dr.REC)
        return merging.decay_state(left, "rank", self.p.state_factor, self.p.state_floor)

    @step
    def state_carry_over(self) -> DataFrame:
        """Where no other step of the job has decayed the whole state, that of the active devices: no other has
        recommendations."""
        self._stored_log
        whole = "_decayed" in self.__dict__ or self._before("accumulated") is not None
        state = self._decayed if whole else self._decayed_of(self._active_devices)
        return dr.carry_over(state, self._top200, self.p)

    @step
    def rec_backfill(self) -> DataFrame:
        first_day = self._before("region-scores") is None
        self._stored_log
        self._together("_top200", *["_period_hot"] * first_day)
        return dr.backfill(self._top200, self.state_carry_over, self.rec_by_region, self.p)

    @step
    def rec_merge_min(self) -> DataFrame:
        return dr.merge_min(self.rec_backfill)

    @step
    def rec_category_cap(self) -> DataFrame:
        return dr.category_cap(self.rec_merge_min, self._eligible("cat1_id"), self.p)

    @step
    def rec_top50(self) -> DataFrame:
        top = top_k_per_group(
            self.rec_category_cap, dr.DEVICE_CITY, self.p.final_k, "rank", ["shopid"]
        )
        return top.select(*dr.REC, "rank")

    @step
    def _top50(self) -> DataFrame:
        return self._cut(self.rec_top50, "top50")

    @step
    def state_replace_groups(self) -> DataFrame:
        self._stored_log
        state = self._decayed  # before the steps that would else decay a part of it
        return joins.replace_groups(state, self._top50, dr.DEVICE_CITY)

    # -- KPIs: of the recommendations that were on show, those of the version before today's --------

    @step
    def _shown(self) -> DataFrame:
        stored = self._before("recommendations")
        return self._cut(self.accumulated, "shown") if stored is None else stored

    @step
    def kpi_coverage(self) -> DataFrame:
        return kpi.coverage(self._shown, self._eligible(), self.p.as_of)

    @step
    def kpi_popularity(self) -> DataFrame:
        return kpi.popularity(self._shown)

    @step
    def kpi_entropy(self) -> DataFrame:
        return kpi.popularity_entropy(self.kpi_popularity, self.p.as_of)

    @step
    def kpi_hit_rate(self) -> DataFrame:
        """How many of them today's visits took up."""
        return kpi.hit_rate(self._shown, self.visits_active, self.p.as_of)

    # -- user tags --------------------------------------------------------------------------------

    @step
    def url_entity_visits(self) -> DataFrame:
        return tg.path_visits(self._events("shop-pages", self.p.visit_since))

    @step
    def user_visits(self) -> DataFrame:
        return tg.resolve_users(self.url_entity_visits, self.identity_main_user)

    @step
    def _user_visits(self) -> DataFrame:
        return self._cut(self.user_visits, "user-visits")

    @step
    def tag_region(self) -> DataFrame:
        shops = self.wh.current_shops("shop_id", "city_id", "region_id", "region_name")
        return tg.location_tags(
            self._user_visits, shops, "region", self.p.region_k, ["userid", "cityid"], True
        )

    def _districts(self, visits: DataFrame) -> DataFrame:
        shops = self.wh.current_shops("shop_id", "city_id", "district_id", "district_name")
        return tg.location_tags(visits, shops, "district", self.p.district_k, ["userid"], False)

    @step
    def tag_district(self) -> DataFrame:
        return self._districts(self._user_visits)

    @step
    def shop_attributes(self) -> DataFrame:
        shops = self.wh.current_shops("shop_id", "city_id", "cat0_id", "shop_tags", "avg_price")
        return tg.shop_attributes(shops, self.p.top_category)

    @step
    def _shop_attributes(self) -> DataFrame:
        return self._cut(self.shop_attributes, "shop-attributes")

    @step
    def shop_tags_exploded(self) -> DataFrame:
        return tg.shop_tags(self._shop_attributes, self.wh.tag_vocabulary())

    @step
    def shop_tags_by_type(self) -> DataFrame:
        """Both families in one table, told apart by type: later steps handle them in one pass."""
        return self.shop_tags_exploded.filter(F.col("tagtype").isin(*self.p.tag_types))

    @step
    def shop_tag_tf(self) -> DataFrame:
        return tg.term_frequency(self.shop_tags_by_type)

    @step
    def shop_tag_tfidf(self) -> DataFrame:
        return tf_idf(self.shop_tag_tf, "tagtype", "shopid", "tag", "score", self.p.idf_docs)

    @step
    def tag_user_tfidf(self) -> DataFrame:
        return tg.user_tags(self.shop_tag_tfidf, self._user_visits)

    @step
    def tag_price_bucket(self) -> DataFrame:
        return tg.price_tags(self._shop_attributes, self._user_visits, self.p.price_k)

    @step
    def tag_union(self) -> DataFrame:
        self._together("_user_visits", "_shop_attributes")
        return merging.union_weighted([
            (self.tag_region, 1.0), (self.tag_district, 1.0),
            (self.tag_user_tfidf, self.p.tfidf_weight), (self.tag_price_bucket, 1.0),
        ], "score")

    @step
    def visits_sliced_distinct(self) -> DataFrame:
        bounds = self.p.slice_bounds
        log = self.wh.traffic("user_id", "shop_id", "hp_log_type", "hp_stat_time", since=bounds[0])
        return tg.sliced_distinct_visits(log, bounds)

    @step
    def _sliced(self) -> DataFrame:
        return self._cut(self.visits_sliced_distinct, "sliced")

    @step
    def tag_region_raw(self) -> DataFrame:
        shops = self.wh.current_shops("shop_id", "city_id", "region_id", "region_name")
        return tg.location_tags(
            self._sliced, shops, "region", self.p.region_k, ["userid"], False
        )

    @step
    def tag_union_mobile(self) -> DataFrame:
        self._together("_sliced", "_shop_attributes")
        visits = self._sliced
        return merging.union_weighted([
            (self.tag_region_raw, 1.0), (self._districts(visits), 1.0),
            (tg.user_tags(self.shop_tag_tfidf, visits), self.p.tfidf_weight),
            (tg.price_tags(self._shop_attributes, visits, self.p.price_k), 1.0),
        ], "score")

    @step
    def tag_region_export(self) -> DataFrame:
        """The best region tags, written as text and read back."""
        top = top_k_per_group(
            self.tag_region, ["userid", "cityid"], self.p.export_k, "score", ["tag"]
        )
        path = self._path("region-tags")
        storage.export_text(top.select(*schemas.USER_TAGS.names), path)
        return storage.import_text(self.spark, path, schemas.USER_TAGS)

    @step
    def tag_serving(self) -> DataFrame:
        tags = schemas.conform(self.tag_union, schemas.USER_TAGS)
        return storage.serving_extract(tags, self.p.as_of)

    @step
    def clustered_output(self) -> DataFrame:
        path = self._path("user-tags")
        order = [F.col("userid"), F.col("cityid"), F.col("score").desc()]
        storage.save_clustered(self.tag_user_tfidf, path, ["userid"], order)
        return self.spark.read.schema(schemas.USER_TAGS).parquet(path)

    # -- dishes -----------------------------------------------------------------------------------

    @step
    def reviews_with_text(self) -> DataFrame:
        return di.reviews_with_text(
            self.wh.review_heads(), self.wh.review_bodies(), self.p.review_text_after
        )

    @step
    def shop_info(self) -> DataFrame:
        shops = self.wh.shops("shop_id", "star", "power", "cat0_id", "shop_tags", "dish_tags")
        return di.shop_info(shops, self.p)

    @step
    def _dish_info(self) -> DataFrame:
        """Shop info for the dish steps, which do not read the packed shop tags."""
        shops = self._eligible("cat0_id", "dish_tags")
        return shops.filter(F.col("cat0_id") == self.p.top_category).select(
            F.col("city_id").alias("cityid"), F.col("shop_id").alias("shopid"), "dish_tags"
        )

    @step
    def reviews_of_tagged_shops(self) -> DataFrame:
        heads = restrict(self.wh.review_heads(), di.with_dishes(self._dish_info), ["shopid"])
        return di.reviews_with_text(heads, self.wh.review_bodies(), self.p.review_text_after)

    @step
    def shop_dishes(self) -> DataFrame:
        return di.shop_dishes(self._dish_info)

    @step
    def shop_dishes_clean(self) -> DataFrame:
        return self.shop_dishes.filter(F.col("tag") != self.p.dish_sentinel)

    @step
    def dish_dictionary(self) -> DataFrame:
        path = self._path("dish-dictionary")
        storage.export_text(di.build_dictionary(self.shop_dishes_clean), path)
        return storage.import_text(self.spark, path, schemas.DICTIONARY)

    def _reviews_with_dishes(self, *keep: str) -> DataFrame:
        heads = di.heads_with_dishes(self.wh.review_heads(), self.shop_dishes_clean)
        return di.reviews_with_text(
            heads, self.wh.review_bodies(), self.p.review_text_after, "dishes", *keep
        )

    @step
    def dish_mentions(self) -> DataFrame:
        return di.mention_counts(self._reviews_with_dishes())

    @step
    def dish_mentions_merged(self) -> DataFrame:
        """Two extracts, by date of the text, written as text files in one pass, loaded together and
        summed."""
        late = F.col("hp_statdate") > F.lit(self.p.extract_split).cast("date")
        reviews = self._reviews_with_dishes("hp_statdate").withColumn("late", late.cast("int"))
        path = self._path("dish-mentions")
        storage.export_text(di.mention_counts(reviews, "late"), path, by=["late"])
        return di.merge_extracts(storage.import_text(self.spark, path, schemas.MENTIONS))

    # -- keyword recommendation -------------------------------------------------------------------

    @step
    def user_searches(self) -> DataFrame:
        return kw.user_searches(self._events("searches", self.p.visit_since), self._main_user)

    @step
    def user_searches_clean(self) -> DataFrame:
        return kw.clean_searches(self.user_searches)

    @step
    def search_profile(self) -> DataFrame:
        return kw.search_profile(self.user_searches_clean, self.p)

    @step
    def search_profile_frequent(self) -> DataFrame:
        return kw.frequent(self.search_profile, self.p)

    @step
    def _profile(self) -> DataFrame:
        return self._cut(self.search_profile_frequent, "profile")

    @step
    def search_tf_decayed(self) -> DataFrame:
        return kw.tf_decay(self._profile, self.p)

    @step
    def keyword_cooccurrence(self) -> DataFrame:
        return kw.keyword_edges(self._profile, self.p)

    @step
    def keyword_edges_damped(self) -> DataFrame:
        return kw.damped_edges(self.keyword_cooccurrence, self.p)

    @step
    def _keyword_edges(self) -> DataFrame:
        return self._cut(self.keyword_edges_damped, "keyword-edges")

    @step
    def keyword_rec_hop1(self) -> DataFrame:
        return kw.expand_keywords(
            self.search_tf_decayed, "weight", self._keyword_edges, self.p, "kw1",
            kw.hop_tasks(self._profile, self.p),
        )

    @step
    def keyword_rec_hop2(self) -> DataFrame:
        return kw.expand_keywords(
            self.keyword_rec_hop1, "score", self._keyword_edges, self.p, "kw2"
        )

    @step
    def keyword_shop_counts(self) -> DataFrame:
        clicks = self._events("shop-clicks", self.p.visit_since)
        return kw.keyword_shop_counts(clicks, self._searchable())

    @step
    def keyword_shop_share(self) -> DataFrame:
        return kw.keyword_shop_share(self._cut(self.keyword_shop_counts, "shop-counts"))

    @step
    def _dominant(self) -> DataFrame:
        named = self.keyword_shop_share.filter(F.col("score") > self.p.dominant_share)
        return self._cut(named, "dominant")

    @step
    def keyword_rec_canonical(self) -> DataFrame:
        self._together("_profile", "_dominant")
        return joins.canonicalise(
            self.keyword_rec_hop2, self._dominant, ["cityid", "keyword"], "keyword", "shopname"
        )

    @step
    def keyword_rec_top25(self) -> DataFrame:
        return kw.top_keywords(self.keyword_rec_canonical, self.p)

    @step
    def keyword_rec_readable(self) -> DataFrame:
        return kw.readable_keywords(self.keyword_rec_top25, self.p)

    @step
    def recent_views(self) -> DataFrame:
        return kw.recent_views(self._events("shop-pages", self.p.active_since), self._main_user)

    @step
    def _views(self) -> DataFrame:
        return self._cut(self.recent_views, "views")

    @step
    def _named_shops(self) -> DataFrame:
        return kw.short_named(self._searchable(), self.p)

    @step
    def shopname_rec(self) -> DataFrame:
        return kw.shop_name_recs(self._views, self._item_edges, self._named_shops)

    @step
    def shopname_rec_damped(self) -> DataFrame:
        return kw.damped_names(self.shopname_rec)

    @step
    def shopname_rec_unseen(self) -> DataFrame:
        return kw.unseen_names(self.shopname_rec_damped, self._views, self._named_shops)

    @step
    def shopname_rec_top5(self) -> DataFrame:
        return kw.top_names(self.shopname_rec_unseen, self.p)

    @step
    def keyword_rec_final(self) -> DataFrame:
        self._together("_main_user", "_item_edges")
        self._together("keyword_rec_canonical", "_views")
        return kw.final_keywords(self.keyword_rec_readable, self.shopname_rec_top5, self.p)

    # -- trending keywords ------------------------------------------------------------------------

    def _search_clicks(self, **window) -> DataFrame:
        log = self.wh.traffic(
            "guid_str", "user_id", "city_id", "shop_id", "hp_log_type", "hp_stat_time", "path",
            "referer", **window,
        )
        return tr.search_clicks(log, self.p)

    @step
    def search_clicks(self) -> DataFrame:
        return self._search_clicks(since=self.p.visit_since)

    @step
    def search_clicks_clean(self) -> DataFrame:
        return tr.clean_clicks(self.search_clicks, self.p)

    @step
    def keyword_city_counts(self) -> DataFrame:
        if self.store is None:
            return tr.keyword_counts(tr.keyword_clicks(self.search_clicks_clean))
        return tr.keyword_counts(self._events("search-clicks", self.p.visit_since))

    @step
    def keyword_city_share(self) -> DataFrame:
        counts = self._cut(self.keyword_city_counts, "keyword-counts")
        return tr.keyword_share(counts, self.p)

    @step
    def _period_shares(self) -> DataFrame:
        """The shares of the current and of an earlier period, from one scan of the log."""
        bounds = (self.p.visit_since, self.p.trend_prev_before)
        clicks = tr.clean_clicks(self._search_clicks(periods=bounds), self.p)
        counts = tr.keyword_counts(tr.keyword_clicks(in_periods(clicks, "dt", *bounds), "period"), "period")
        return tr.keyword_share(self._cut(counts, "period-counts"), self.p, "period")

    @step
    def keyword_trend(self) -> DataFrame:
        """Shares against those of the day before; without a stored day those of an earlier period."""
        keys = ["cityid", "keyword"]
        stored = self._before("keyword-shares")
        if stored is not None:
            return trend_delta(self.keyword_city_share, stored, keys, "score")
        return period_delta(self._period_shares, keys, "score")

    @step
    def keyword_trend_top25(self) -> DataFrame:
        return tr.rising(self.keyword_trend, self.p)

    def _hot_names(self, rising: DataFrame) -> DataFrame:
        return joins.canonicalise(
            rising, self._dominant, ["cityid", "keyword"], "keyword", "shopname"
        )

    @step
    def keyword_canonical(self) -> DataFrame:
        if self._before("keyword-shares") is None:
            self._together("_dominant", "_period_shares")
        return self._hot_names(self.keyword_trend_top25)

    @step
    def keyword_hot_top15(self) -> DataFrame:
        return tr.finalise(self.keyword_canonical, self.p)

    @step
    def keyword_hot_history(self) -> DataFrame:
        """The lists of two runs: of the earlier period, which has nothing before it, and of today."""
        store = StateStore(self.spark, self._path("hot-history"), SCHEMAS)
        first = tr.rising(self._period_shares.filter("period = 0").drop("period"), self.p)
        store.publish(self.p.trend_prev_before, {"keyword-hot": lambda: tr.finalise(self._hot_names(first), self.p)})
        store.publish(self.p.as_of, {"keyword-hot": lambda: self.keyword_hot_top15})
        return store.history("keyword-hot")

    # -- sampling ---------------------------------------------------------------------------------

    @step
    def hash_sample(self) -> DataFrame:
        """The sampled ratings with their random number."""
        cols = ["userid", "cityid", "shopid"]
        u = hash_uniform(*cols, salt=f"{self.p.seed}-sample")
        sampled = self.ratings_load.withColumn("u", u)
        return sampled.filter(F.col("u") > self.p.sample_drop) if self.p.sample_drop else sampled

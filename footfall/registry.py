"""Output columns of every registered query: one key per step of ``Job``."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession, functions as F, types as T

from footfall import oracles
from footfall.job import Job
from footfall.session import tune


@dataclass(frozen=True)
class Output:
    keys: str
    doubles: str = ""
    digits: int = 6


_REC = Output("deviceid cityid shopid", "rank")
# Scores divided by a near-zero count reach 1e6 and more: fewer places are stable there.
_BIG = Output("deviceid cityid shopid", "rank", 3)
_TAG = Output("userid cityid tagtype tag", "score")
_RATING = Output("userid cityid shopid", "score")
_REGION = Output("deviceid cityid regionid", "score")
_SHOP_TAG = Output("cityid shopid tagtype tag", "score")
_DELTA = Output("guid userid")
_METRIC = Output("metric dt", "value")
_HOT = Output("cityid regionid shopid", "score")
_USER_WORD = Output("userid cityid keyword", "score")
_WORD = Output("cityid keyword", "score")
_EDGE = Output("cityid sid1 sid2", "score")
_CLICK = Output("guid cityid shopid keyword dt")

OUTPUTS: dict[str, Output] = {
    "identity_pair_counts": Output("guid userid cnt"),
    "identity_compact": Output("guid userid cnt"),
    "identity_main_user": _DELTA,
    "identity_delta": _DELTA,
    "device_visits": Output("deviceid shopid"),
    "device_region_affinity": _REGION,
    "device_region_entropy": Output("deviceid cityid", "entropy"),
    "device_region_weighted": _REGION,
    "device_region_breadth": _REGION,
    "kpi_coverage": _METRIC,
    "kpi_popularity": Output("shopid", "p"),
    "kpi_entropy": _METRIC,
    "kpi_hit_rate": _METRIC,
    "visits_decayed_topk": Output("deviceid userid shopid cnt"),
    "visits_active": Output("deviceid userid shopid"),
    "visits_of_active": Output("deviceid userid shopid cnt"),
    "rec_hop1": _REC,
    "rec_hop2": _REC,
    "rec_popularity_damped": _BIG,
    "dislike_expand": Output("deviceid cityid shopid dt"),
    "dislike_union": Output("deviceid cityid shopid dt"),
    "rec_exclude_disliked": _BIG,
    "state_exclude_feedback": _REC,
    "rec_promo_boost": _BIG,
    "rec_from_reviews": Output("deviceid cityid shopid", "score"),
    "rec_agreement_boost": _BIG,
    "rec_merge_sum": _BIG,
    "rec_unseen": _BIG,
    "rec_seen_negated": _BIG,
    "rec_top200": _BIG,
    "region_hot_shops": Output("cityid regionid shopid cnt"),
    "region_hot_smoothed": _HOT,
    "region_trend": _HOT,
    "rec_by_region": Output("deviceid cityid shopid", "score"),
    "state_decay": _REC,
    "state_carry_over": _REC,
    "rec_backfill": _BIG,
    "rec_merge_min": _BIG,
    "rec_category_cap": Output("deviceid cityid shopid cat1id", "rank", 3),
    "rec_top50": _BIG,
    "state_replace_groups": _BIG,
    "url_entity_visits": Output("guid shopid"),
    "user_visits": Output("userid shopid"),
    "tag_region": _TAG,
    "tag_district": _TAG,
    "shop_attributes": Output("cityid shopid tags avgprice"),
    "shop_tags_exploded": _SHOP_TAG,
    "shop_tags_by_type": _SHOP_TAG,
    "shop_tag_tf": _SHOP_TAG,
    "shop_tag_tfidf": _SHOP_TAG,
    "tag_user_tfidf": _TAG,
    "tag_price_bucket": _TAG,
    "tag_union": _TAG,
    "visits_sliced_distinct": Output("userid shopid"),
    "tag_region_raw": _TAG,
    "tag_union_mobile": _TAG,
    "tag_region_export": _TAG,
    "tag_serving": Output("userid cityid tagtype tag update_time", "score"),
    "ratings_load": _RATING,
    "ratings_normalised": _RATING,
    "ratings_centred": _RATING,
    "user_similarity": _EDGE,
    "cf_recommend": _RATING,
    "reviews_with_text": Output("reviewid cityid shopid reviewbody"),
    "shop_info": Output("cityid shopid shop_tags dish_tags"),
    "reviews_of_tagged_shops": Output("reviewid cityid shopid reviewbody"),
    "shop_dishes": Output("cityid shopid tagtype tag", "rank"),
    "shop_dishes_clean": Output("cityid shopid tagtype tag", "rank"),
    "dish_dictionary": Output("entry"),
    "dish_mentions": Output("shopid dish c"),
    "dish_mentions_merged": Output("shopid dish c"),
    "search_clicks": _CLICK,
    "search_clicks_clean": _CLICK,
    "keyword_city_counts": Output("cityid keyword cnt"),
    "keyword_city_share": _WORD,
    "keyword_trend": _WORD,
    "keyword_trend_top25": _WORD,
    "keyword_canonical": _WORD,
    "keyword_hot_top15": _WORD,
    "keyword_hot_history": Output("cityid keyword dt", "score"),
    "user_searches": Output("userid cityid keyword cnt dt"),
    "user_searches_clean": Output("userid cityid keyword cnt dt"),
    "search_profile": Output("userid cityid keyword cnt dt"),
    "search_profile_frequent": Output("userid cityid keyword cnt dt"),
    "search_tf_decayed": Output("userid cityid keyword dt", "weight"),
    "keyword_cooccurrence": _EDGE,
    "keyword_edges_damped": _EDGE,
    "keyword_rec_hop1": _USER_WORD,
    "keyword_rec_hop2": _USER_WORD,
    "keyword_shop_counts": Output("cityid keyword shopname cnt"),
    "keyword_shop_share": Output("cityid keyword shopname", "score"),
    "keyword_rec_canonical": _USER_WORD,
    "keyword_rec_top25": _USER_WORD,
    "keyword_rec_readable": _USER_WORD,
    "recent_views": Output("userid shopid cnt"),
    "shopname_rec": _USER_WORD,
    "shopname_rec_damped": _USER_WORD,
    "shopname_rec_unseen": _USER_WORD,
    "shopname_rec_top5": _USER_WORD,
    "keyword_rec_final": _USER_WORD,
    "state_rotation": _DELTA,
    "clustered_output": _TAG,
    "hash_sample": Output("userid cityid shopid", "score u"),
}


def present(df: DataFrame, out: Output) -> DataFrame:
    """The step's columns, dates and times as text, doubles rounded and without negative zeros."""
    dates = {f.name for f in df.schema if isinstance(f.dataType, (T.DateType, T.TimestampNTZType))}
    keys = [F.col(c).cast("string") if c in dates else F.col(c) for c in out.keys.split()]
    doubles = [(F.round(c, out.digits) + 0.0).alias(c) for c in out.doubles.split()]
    return df.select(*keys, *doubles)


def run(spark: SparkSession, sf_dir: str, key: str) -> DataFrame:
    return present(getattr(Job(tune(spark, sf_dir), sf_dir), key), OUTPUTS[key])


def oracle(key: str) -> str:
    out = OUTPUTS[key]
    doubles = [f"round({c}, {out.digits}) + 0::double AS {c}" for c in out.doubles.split()]
    return oracles.sql(key, [*out.keys.split(), *doubles])

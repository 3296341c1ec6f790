"""Job parameters. The defaults fit the test tables; README lists the production values."""

from __future__ import annotations

from dataclasses import dataclass
from datetime import date, timedelta


@dataclass(frozen=True)
class Params:
    # clock and windows (ISO dates)
    as_of: str = "2001-08-02"
    visit_since: str = "1995-01-01"
    active_since: str = "2001-05-01"
    identity_batch_since: str = "2000-01-01"  # where no earlier day is stored
    trend_prev_before: str = "1996-07-01"
    region_prev_before: str = "1995-04-01"
    review_text_after: str = "2024-01-03"
    extract_split: str = "2024-01-15"
    slice_bounds: tuple[str, ...] = (
        "2001-01-01", "2001-02-01", "2001-03-01", "2001-04-01", "2001-05-01",
    )

    # random factors: the lowest factor, 1 means none
    seed: str = "footfall"
    hop_jitter: float = 0.5
    region_jitter: float = 0.6
    backfill_jitter: float = 0.6
    keyword_jitter: float = 0.2

    # row sampling: the share of rows to drop, 0 means every row
    hop_drop: float = 0.5
    dislike_drop: float = 0.5
    carry_drop: float = 0.5
    cf_drop: float = 0.3
    click_drop: float = 0.7
    sample_drop: float = 0.3

    # identity
    min_pair_count: int = 1

    # shop eligibility
    current_version: str = "3000-12-31"
    min_star: int = 30
    powers: tuple[int, ...] = (5, 10)
    min_power: int = 3
    top_category: int = 10

    # device recommendations
    min_visits: int = 2
    recent_visits: int = 30
    hop1_k: int = 500
    hop2_k: int = 300
    dislike_k: int = 20
    feedback_max: float = 10.0
    agreement_weight: float = 5.0
    merged_k: int = 200
    hot_min_count: int = 10
    region_trend_k: int = 50
    region_rec_k: int = 10
    state_factor: float = 0.7
    state_floor: float = 0.05
    category_cap: int = 5
    final_k: int = 50

    # user tags
    region_k: int = 10
    district_k: int = 10
    price_k: int = 20
    export_k: int = 3
    tfidf_weight: float = 10.0
    page_type: int = 12
    tag_types: tuple[str, ...] = ("character", "atmosphere")
    idf_docs: int | None = None  # documents of a tag type; None counts them

    # ratings
    min_rating: int = 10
    similar_k: int = 25
    crowded_item: int = 1000  # items of more raters: pairs by bounds
    rating_floor: float = 0.1
    cf_k: int = 500

    # dishes
    dish_sentinel: str = "none"

    # keywords
    blocked: tuple[str, ...] = ("hot rod",)
    min_users: int = 3
    edge_days: int = 1
    edge_k: int = 100
    edge_keep: int = 20
    keyword_k: int = 80
    hop_rows: int = 4_000_000  # of a task
    keyword_final_k: int = 25
    dominant_share: float = 0.5
    max_keyword_len: int = 9
    max_shop_name_len: int = 12
    shop_name_k: int = 5
    hot_min_clicks: int = 5
    hot_max_trend: float = 0.5
    hot_k: int = 25
    hot_final_k: int = 15

    @classmethod
    def daily(cls, as_of: str, visit_days: int = 5, active_days: int = 1, **others) -> Params:
        """Windows that end with as_of: visits and searches of the last ``visit_days``, active devices of
        the last ``active_days``, a slice per visit day. A first day, before which nothing is stored,
        compares with what came before these windows."""

        def back(days: int) -> str:
            return (date.fromisoformat(as_of) - timedelta(days)).isoformat()

        visit, active = back(visit_days - 1), back(active_days - 1)
        windows = {
            "visit_since": visit, "active_since": active, "identity_batch_since": active,
            "trend_prev_before": visit, "region_prev_before": active,
            "slice_bounds": tuple(back(d) for d in range(visit_days, 0, -1)),
        }
        return cls(as_of=as_of, **windows | others)

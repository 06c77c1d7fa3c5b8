from silverloom.plans.analytics import (
    actor_topk,
    career_history,
    genre_revenue,
    team_consistency,
    year_revenue,
)
from silverloom.plans.silver import build_movies, build_objects, build_silver, write_silver
from silverloom.plans.targets import check_targets

__all__ = [
    "actor_topk",
    "build_movies",
    "build_objects",
    "build_silver",
    "career_history",
    "check_targets",
    "genre_revenue",
    "team_consistency",
    "write_silver",
    "year_revenue",
]

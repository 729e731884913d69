"""The career relations as named SQL views (SRC-5), for users who query with ``spark.sql``.

The relations are the same DataFrames as in ``operators.careers``; the views
only name them.  Global temporary views live in ``global_temp``.
"""

from __future__ import annotations

from pyspark.sql import DataFrame

from stintwise.operators import careers

# The view names under which the relations are queried.
VIEW_NAMES = {
    "appearances": "driversAllYears",
    "debut_years": "debut",
    "debuts": "debuts",
    "last_seen_before_max": "retirement",
    "retirements": "retirements",
    "retirements_announced": "retirementsAnnounced",
    "transfers": "transfer",
    "gap_pairs": "gapBreak",
    "gaps_unexplained": "filteredGap",
    "breaks_nearest_return": "nearestReturn",
    "breaks": "breaks",
}


def career_relations(a: DataFrame, midseason: bool = False) -> dict[str, DataFrame]:
    """All career relations over one appearance table, spans materialised once."""
    e = careers.yearly_entries(a)
    s = careers.shared_spans(e)
    transfers = (careers.transfers_with_midseason(a, s) if midseason
                 else careers.transfers_consecutive(a, s))
    return {
        "appearances": a,
        "debut_years": careers.debut_years(e),
        "debuts": careers.debuts(e, s),
        "last_seen_before_max": careers.last_seen_before_max(a, e),
        "retirements": careers.retirements(a, e),
        "retirements_announced": careers.retirements_announced(a, e),
        "transfers": transfers,
        "gap_pairs": careers.gap_pairs(a, s),
        "gaps_unexplained": careers.gaps_unexplained(a, midseason, s),
        "breaks_nearest_return": careers.breaks_nearest_return(a, midseason, s),
        "breaks": careers.breaks(a, midseason, s),
    }


def register_career_views(a: DataFrame, midseason: bool = False,
                          global_views: bool = True) -> dict[str, str]:
    """Create or replace one view per relation; returns relation -> qualified view name."""
    out = {}
    for key, df in career_relations(a, midseason).items():
        name = VIEW_NAMES[key]
        if global_views:
            df.createOrReplaceGlobalTempView(name)
            out[key] = f"global_temp.{name}"
        else:
            df.createOrReplaceTempView(name)
            out[key] = name
    return out

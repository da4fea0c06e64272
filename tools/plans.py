"""Summarise the physical plans of the query keys into PLANS.md.

    python tools/plans.py [sf_dir]

For each key: shuffle exchanges, broadcast exchanges, single-partition
exchanges (each must sit on a bounded input), and the parquet ReadSchemas.
Plans are taken before execution (AQE may still coalesce or switch joins).
"""

from __future__ import annotations

import os
import re
import sys

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

from tunefold.plans.queries import all_queries  # noqa: E402
from tunefold.session import local_session  # noqa: E402

KEYS = (
    "most_popular_tracks_with_duration", "top_5_most_popular_artists_contribution",
    "track_popularity_trend_by_release_year_month", "album_track_popularity_comparison",
    "genre_track_and_artist_details", "dense_rank_global", "catalog_tracks", "catalog_artists",
)


def summarise(plan: str) -> dict:
    return {
        "shuffles": len(re.findall(r"Exchange (hashpartitioning|rangepartitioning|RoundRobin)", plan)),
        "range": len(re.findall(r"Exchange rangepartitioning", plan)),
        "broadcasts": len(re.findall(r"BroadcastExchange", plan)),
        "single": len(re.findall(r"Exchange SinglePartition", plan)),
        "reads": sorted(set(r if len(r) <= 140 else r[:137] + "..."
                            for r in re.findall(r"ReadSchema: (\S+)", plan))),
        "filters": sorted(set(f for f in re.findall(r"PushedFilters: \[([^\]]*)\]", plan) if f)),
    }


def main() -> None:
    sf_dir = sys.argv[1] if len(sys.argv) > 1 else "/root/testdata/sf0.1"
    spark = local_session(8)
    qs = all_queries()
    out = ["# Physical plans (summary)", "",
           f"Generated by `tools/plans.py` on `{sf_dir}`, local[8], before execution.",
           "Single-partition exchanges only take a partial aggregate (one row per task),",
           "the sizes of the rank ranges (one row each) or at most k top values.", ""]
    for key in KEYS:
        df = qs[key](spark, sf_dir)
        plan = df._jdf.queryExecution().executedPlan().toString()
        s = summarise(plan)
        out += [f"## {key}", "",
                f"- shuffle exchanges: {s['shuffles']} (range: {s['range']}), broadcast exchanges: "
                f"{s['broadcasts']}, single-partition exchanges: {s['single']}"]
        for r in s["reads"]:
            out.append(f"- reads `{r}`")
        for f in s["filters"]:
            out.append(f"- pushed filters `[{f}]`")
        singles = plan.split("Exchange SinglePartition")[1:]
        for block in singles:
            child = block.split("\n")[1].strip() if "\n" in block else ""
            out.append(f"- single-partition input: `{child[:110]}`")
        out.append("")
    path = os.path.join(os.path.dirname(os.path.dirname(os.path.abspath(__file__))), "PLANS.md")
    with open(path, "w") as fh:
        fh.write("\n".join(out))
    print(path)


if __name__ == "__main__":
    main()

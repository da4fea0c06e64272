"""Benchmark: time the query keys at ``$BENCH_SF_DIR`` on ``local[$BENCH_CPUS]``.

Each query is built and run to completion through Spark's ``noop`` sink (the
whole plan executes; no rows travel to Python). ``catalog_build`` derives the
catalogue from the raw tables and writes it (the load step every view reads);
every other key is timed as the best of ``$BENCH_REPEAT`` runs (default 2). The JVM is
warmed up first by running every step once on the smallest tables (JIT and
code generation), so the timings are steady-state.
Prints one JSON line on stdout.
"""

from __future__ import annotations

import json
import os
import sys
import time

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

from tunefold.plans.queries import all_queries  # noqa: E402
from tunefold.session import local_session  # noqa: E402
from tunefold.sources import fixtures  # noqa: E402

HEADLINE = (
    "most_popular_tracks_with_duration",
    "top_5_most_popular_artists_contribution",
    "track_popularity_trend_by_release_year_month",
    "album_track_popularity_comparison",
    "genre_track_and_artist_details",
    "dense_rank_global",
    "catalog_tracks",
    "catalog_albums",
    "catalog_artists",
    "load_upsert",
    "stream_upsert",
    "run_log_next_id",
)


def _run(fn, spark, sf_dir) -> float:
    t0 = time.perf_counter()
    fn(spark, sf_dir).write.format("noop").mode("overwrite").save()
    return time.perf_counter() - t0


def main() -> None:
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1").rstrip("/")
    cpus = os.environ.get("BENCH_CPUS", "8")
    repeat = int(os.environ.get("BENCH_REPEAT", "2"))
    only = [a for a in sys.argv[1:]]
    spark = local_session(cpus, shuffle_partitions=int(os.environ.get("BENCH_SHUFFLE_PARTITIONS", "8")),
                          app="tunefold-bench")
    # Warm-up: every timed step once on the smallest tables (a different data
    # set, so nothing is reused), so the timings below are steady-state JVM
    # (JIT, code generation, JSON/parquet writer classes).
    warm_dir = os.environ.get("BENCH_WARMUP_DIR", "/root/testdata/sf0.001")
    if os.path.isdir(warm_dir) and os.path.abspath(warm_dir) != os.path.abspath(sf_dir):
        wq = all_queries()
        fixtures.materialized_catalog(spark, warm_dir)
        from tunefold.plans.queries import landing as _landing

        _landing(spark, warm_dir)
        for name in HEADLINE:
            _run(wq[name], spark, warm_dir)
    spark.range(1).collect()

    times: dict[str, float] = {}
    t0 = time.perf_counter()
    fixtures.materialized_catalog(spark, sf_dir)
    times["catalog_build"] = time.perf_counter() - t0

    qs = all_queries()
    # Landing the pages once (derived from the catalogue) is part of the ingest cost.
    from tunefold.plans.queries import landing

    t0 = time.perf_counter()
    landing(spark, sf_dir)
    times["land_pages"] = time.perf_counter() - t0

    for name in HEADLINE:
        if only and name not in only:
            continue
        times[name] = round(min(_run(qs[name], spark, sf_dir) for _ in range(repeat)), 3)
    times = {k: round(v, 3) for k, v in times.items()}
    sf = os.path.basename(sf_dir).replace("sf", "")
    print(json.dumps({"metric": "total_query_sec", "value": round(sum(times.values()), 3), "unit": "sec",
                      "queries": times, "sf": sf, "cpus": cpus}))


if __name__ == "__main__":
    main()

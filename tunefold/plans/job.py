"""The end-to-end catalogue job: landed pages -> catalogue tables -> views.

    read pages + artist documents
      -> build_catalog (flatten, enrich, reject NULL tracks / albums)
      -> load each table (insert | upsert | overwrite)
      -> create the views of the SQL folder (if missing)

wrapped in the run log (start / success / fail).
"""

from __future__ import annotations

import logging
from dataclasses import dataclass

from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F

from ..operators.catalog import build_from_items
from ..operators.load import TableStore
from ..operators.nested import flatten_items
from ..operators.runlog import RunLog, run_job
from ..schemas import CATALOG_SCHEMAS
from ..session import written
from ..sources.pages import check_pages_complete, read_artist_docs, read_playlist_pages
from .views import SQL_FOLDER, publish_views

log = logging.getLogger("tunefold.job")


@dataclass
class JobConfig:
    pages_path: str
    artist_docs_path: str
    load_method: str = "upsert"
    job_name: str = "catalog"
    publish_views: bool = True
    replace_views: bool = False
    sql_folder: str | None = None  # the views' SQL files; default: the five that come with the package


def load_items(store: TableStore, items: DataFrame, artist_docs: DataFrame, method: str) -> dict[str, int]:
    """Loads the three tables from flattened items; returns the rejected-item count per reason."""
    # the landing is parsed once, for all that follows, and its figures come with that write
    seen = Observation("items")
    no_track = F.col("track_id").isNull()
    items = written(items.observe(
        seen, F.count(F.lit(1)).alias("items"), F.count_if(no_track).alias("null track"),
        F.count_if(~no_track & F.col("track_album_id").isNull()).alias("null album")), "items")
    found = seen.get
    rejected = {reason: found[reason] for reason in ("null track", "null album") if found.get(reason)}
    log.info("read %s items, rejected items: %s", found.get("items", 0), rejected or "none")
    built = build_from_items(items, artist_docs)
    store.create_tables(CATALOG_SCHEMAS)
    latest = {"on_duplicate": "keep_latest", "order_by": "track_added_at"} if method == "upsert" else {}
    rows = store.load({"tracks": built.tracks}, CATALOG_SCHEMAS, method, **latest)
    rows |= store.load({"albums": built.albums, "artists": built.artists}, CATALOG_SCHEMAS, method)
    log.info("loaded by %s into %s: %s", method, store.root, ", ".join(f"{n} {t}" for t, n in rows.items()))
    return rejected


def load_catalog(spark: SparkSession, store: TableStore, cfg: JobConfig) -> dict[str, int]:
    """One run without the log: returns the rejected-item count per reason."""
    log.info("reading pages from %s", cfg.pages_path)
    pages = read_playlist_pages(spark, cfg.pages_path)
    check_pages_complete(pages)
    log.info("building the catalogue")
    rejected = load_items(store, flatten_items(pages), read_artist_docs(spark, cfg.artist_docs_path), cfg.load_method)
    if cfg.publish_views:
        created = publish_views(spark, store, cfg.replace_views, cfg.sql_folder or SQL_FOLDER)
        log.info("views created: %s", ", ".join(created) or "none (already present)")
    return rejected


def run_catalog_job(spark: SparkSession, store: TableStore, cfg: JobConfig, raise_on_error: bool = True):
    log = RunLog(store)
    return run_job(log, cfg.job_name, lambda: load_catalog(spark, store, cfg),
                   config={"pages": cfg.pages_path, "artists": cfg.artist_docs_path, "load": cfg.load_method},
                   raise_on_error=raise_on_error)

"""Independent SQL statements of every query key, for a DuckDB cross-check.

Only the driver's raw tables exist on the SQL side, so each statement inlines
the catalogue derivation (FIXTURES.md §2) as CTEs. Warehouse rules are spelled
out the DuckDB way: ``desc nulls first`` in ranks, ``//`` for integer division,
``nullif(x, '')`` before ``string_to_array``, ordered ``string_agg``.
"""

from __future__ import annotations

CATALOG_CTES = """
tracks as (
  select cast(o.o_orderkey as varchar) as track_id,
         concat('Order ', cast(o.o_orderkey as varchar)) as track_name,
         case when o.o_orderkey % 97 = 0 then null
              else cast(floor(o.o_totalprice / 5000) as integer) end as track_popularity,
         case when o.o_orderkey % 89 = 0 then null
              else cast(floor(o.o_totalprice) as integer) end as track_duration_ms,
         strftime(o.o_orderdate, '%Y-%m-%d') as track_added_at,
         case when o.o_custkey % 10 = 0 then null else cast(o.o_custkey as varchar) end as album_id,
         l.artist_id,
         o.o_orderpriority as playlist_id,
         o.o_orderpriority as playlist_name,
         concat('snap-', o.o_orderpriority) as snapshot_id
  from orders o
  left join (select l_orderkey,
                    string_agg(distinct cast(l_suppkey as varchar), ', ' order by cast(l_suppkey as varchar)) as artist_id
             from lineitem group by l_orderkey) l
    on o.o_orderkey = l.l_orderkey
),
albums as (
  select cast(c.c_custkey as varchar) as album_id, c.c_name as album_name,
         strftime(min(o.o_orderdate), '%Y-%m-%d') as album_release_date,
         cast(count(o.o_orderkey) as integer) as album_total_tracks
  from customer c left join orders o on c.c_custkey = o.o_custkey
  group by c.c_custkey, c.c_name
),
artists as (
  select cast(s.s_suppkey as varchar) as artist_id, s.s_name as artist_name,
         case when s.s_suppkey % 11 = 0 then '{}'
              else concat('{"', n.n_name, '",', r.r_name, '}') end as artist_genres,
         case when s.s_suppkey % 37 = 0 then null
              else cast(floor(s.s_acctbal / 100) as integer) end as artist_popularity
  from supplier s join nation n on s.s_nationkey = n.n_nationkey
                  join region r on n.n_regionkey = r.r_regionkey
)"""

DURATION = ("concat(track_duration_ms // 60000, ':', "
            "lpad(cast((track_duration_ms % 60000) // 1000 as varchar), 2, '0'))")


def with_catalog(body: str, extra_ctes: str = "") -> str:
    ctes = CATALOG_CTES + ("," + extra_ctes if extra_ctes else "")
    return f"with {ctes}\n{body}"


# windows where the definition has windows, aggregates where it has groups.
PAIRS_CTE = """
pairs as (
  select t.track_id, t.track_name, x.artist_id
  from tracks t, unnest(string_to_array(nullif(t.artist_id, ''), ', ')) as x(artist_id)
)"""
GENRES_CTE = """,
genres as (
  select a.artist_id, a.artist_name, x.genre
  from artists a,
       unnest(string_to_array(nullif(regexp_replace(a.artist_genres, '[{}"]', '', 'g'), ''), ',')) as x(genre)
)"""

VIEWS = {
    "most_popular_tracks_with_duration": with_catalog(f"""
select track_id, track_name, track_popularity,
       {DURATION} as track_duration_min,
       dense_rank() over (order by track_popularity desc nulls first) as popularity_rnk
from tracks
order by popularity_rnk, track_id"""),

    "top_5_most_popular_artists_contribution": with_catalog("""
select r.artist_name, r.artist_popularity, r.artist_popularity_rnk,
       count(distinct p.track_id) as total_tracks_contributed
from pairs p
join ranked r on r.artist_id = p.artist_id
where r.artist_popularity_rnk <= 5
group by r.artist_name, r.artist_popularity, r.artist_popularity_rnk
order by r.artist_popularity_rnk, r.artist_name""", PAIRS_CTE + """,
ranked as (
  select artist_id, artist_name, artist_popularity,
         dense_rank() over (order by artist_popularity desc nulls first) as artist_popularity_rnk
  from artists
)"""),

    "track_popularity_trend_by_release_year_month": with_catalog("""
select a.album_name,
       left(a.album_release_date, 7) as album_release_year_month,
       cast(round(avg(t.track_popularity) over ym, 0) as integer) as avg_release_year_month_track_popularity,
       count(t.track_id) over ym as num_tracks_per_release_year_month
from tracks t
left join albums a on a.album_id = t.album_id
window ym as (partition by left(a.album_release_date, 7))
order by album_release_year_month desc nulls first"""),

    "album_track_popularity_comparison": with_catalog("""
select album_name, album_release_date, album_total_tracks, num_tracks_in_playlist,
       avg_album_track_popularity,
       dense_rank() over (order by avg_album_track_popularity desc nulls first) as album_track_popularity_rnk,
       avg_playlist_track_popularity,
       case when avg_album_track_popularity > avg_playlist_track_popularity then 1 else 0 end
         as is_more_popular_than_playlist_overall
from (select distinct p.album_name, p.album_release_date, p.album_total_tracks, p.num_tracks_in_playlist,
                      p.avg_album_track_popularity, o.avg_playlist_track_popularity
      from per_album p cross join overall o) d
order by album_track_popularity_rnk""", """
per_album as (
  select a.album_id, a.album_name, a.album_release_date, a.album_total_tracks,
         count(t.track_id) as num_tracks_in_playlist,
         cast(round(avg(t.track_popularity), 0) as integer) as avg_album_track_popularity
  from albums a left join tracks t on t.album_id = a.album_id
  group by a.album_id, a.album_name, a.album_release_date, a.album_total_tracks
),
overall as (
  select cast(round(avg(t.track_popularity), 0) as integer) as avg_playlist_track_popularity
  from albums a join tracks t on t.album_id = a.album_id
)"""),

    "genre_track_and_artist_details": with_catalog("""
select g.genre,
       count(distinct p.track_id) as num_tracks,
       count(distinct g.artist_id) as num_artists,
       string_agg(distinct p.track_name, ', ' order by p.track_name) as track_names,
       string_agg(distinct g.artist_name, ', ' order by g.artist_name) as artist_names
from pairs p
join genres g on g.artist_id = p.artist_id
group by g.genre
order by num_tracks desc, num_artists desc""", PAIRS_CTE + GENRES_CTE),
}


ARTIST_DOCS_CTE = """
artist_docs as (
  select cast(s.s_suppkey as varchar) as id, s.s_name as name,
         case when s.s_suppkey % 11 = 0 then []::varchar[] else [n.n_name, r.r_name] end as genres,
         case when s.s_suppkey % 37 = 0 then null
              else cast(floor(s.s_acctbal / 100) as integer) end as popularity
  from supplier s join nation n on s.s_nationkey = n.n_nationkey
                  join region r on n.n_regionkey = r.r_regionkey
),
track_artist_ids as (
  select distinct unnest(string_to_array(artist_id, ', ')) as artist_id from tracks where artist_id is not null
)"""

# Array text: quote an element that is empty, spells NULL, or holds { } , " \ or white space.
ARRAY_TEXT = (r"""'{' || array_to_string(list_transform(d.genres, lambda g: case when g is null then 'NULL' """
              r"""when g = '' or upper(g) = 'NULL' or regexp_matches(g, '[{},"\\\s]') """
              r"""then '"' || regexp_replace(g, '(["\\])', '\\\1', 'g') || '"' else g end), ',') || '}'""")

ENRICHED_ARTISTS = with_catalog(f"""
select d.id as artist_id, d.name as artist_name, {ARRAY_TEXT} as artist_genres, d.popularity as artist_popularity
from track_artist_ids i join artist_docs d on i.artist_id = d.id""", ARTIST_DOCS_CTE)

RUN_HISTORY_CTE = """
history as (
  select event_type as pipeline_name, cast(user_id + 1 as integer) as run_id,
         strftime(ts, '%Y-%m-%d %H:%M:%S') as timestamp,
         (['start', 'success', 'fail'])[event_id % 3 + 1] as status,
         props as config, concat('event ', cast(event_id as varchar)) as logs
  from events
)"""

TRACK_COLS = ("track_id, track_name, track_popularity, track_duration_ms, track_added_at, album_id, "
              "artist_id, playlist_id, playlist_name, snapshot_id")

# The tracks on an album, then those with a popularity upserted with one more.
UPSERTED = """
select track_id, track_name, track_popularity + 1 as track_popularity, track_duration_ms, track_added_at,
       album_id, artist_id, playlist_id, playlist_name, snapshot_id
from tracks where album_id is not null or track_popularity is not null"""

OTHERS = {
    "genre_names": with_catalog("""
select genre, kind, count(distinct name) as num_names, min(name) as first_name, max(name) as last_name,
       cast(length(string_agg(distinct name, ', ')) as bigint) as num_chars
from (select g.genre, 't' as kind, p.track_name as name from pairs p join genres g on g.artist_id = p.artist_id
      union all
      select g.genre, 'a', g.artist_name from pairs p join genres g on g.artist_id = p.artist_id)
where name is not null
group by genre, kind""", PAIRS_CTE + GENRES_CTE),
    "read_playlist_pages": with_catalog("""
select playlist_id as id, playlist_name as name, snapshot_id, count(*) as n_items,
       cast(sum(count(*)) over (partition by playlist_id, snapshot_id) as bigint) as total,
       case when page_no < max(page_no) over (partition by playlist_id)
            then concat('playlists/', playlist_id, '/tracks?after=', cast(page_no as varchar)) end as next_page
from (select *, cast(track_id as bigint) // 100 as page_no from tracks) p
group by playlist_id, playlist_name, snapshot_id, page_no"""),

    "flatten_items": with_catalog("""
select t.playlist_id, t.playlist_name, t.snapshot_id, t.track_added_at as added_at,
       t.track_id, t.track_name, t.track_popularity, t.track_duration_ms,
       a.album_id as track_album_id, a.album_name as track_album_name,
       a.album_release_date as track_album_release_date, a.album_total_tracks as track_album_total_tracks
from tracks t left join albums a on t.album_id = a.album_id"""),

    "collect_artist_ids": with_catalog("select track_id, artist_id from tracks"),

    "distinct_artist_ids": with_catalog(
        "select distinct artist_id from (select unnest(string_to_array(artist_id, ', ')) as artist_id "
        "from tracks where artist_id is not null) x"),

    "artist_enrichment": ENRICHED_ARTISTS,
    "catalog_artists": ENRICHED_ARTISTS,

    "catalog_tracks": with_catalog(f"select {TRACK_COLS} from tracks"),

    "catalog_albums": with_catalog("""
select distinct a.album_id, a.album_name, a.album_release_date, a.album_total_tracks
from tracks t join albums a on t.album_id = a.album_id"""),

    "unnest_track_artists": with_catalog("select track_id, artist_id from pairs", PAIRS_CTE),

    "unnest_artist_genres": with_catalog(
        """select artist_id, unnest(string_to_array(nullif(regexp_replace(artist_genres, '[{}"]', '', 'g'), ''), ','))
 as genre from artists"""),

    "format_duration": with_catalog(f"select track_id, track_duration_ms, {DURATION} as track_duration_min from tracks"),

    "top_k_with_ties": with_catalog("""
select artist_id, artist_name, artist_popularity, artist_popularity_rnk
from (select a.*, dense_rank() over (order by artist_popularity desc nulls first) as artist_popularity_rnk
      from artists a) r
where artist_popularity_rnk <= 5"""),

    "dense_rank_global": with_catalog("""
select track_id, track_popularity,
       dense_rank() over (order by track_popularity desc nulls first) as popularity_rnk
from tracks"""),

    "load_insert": with_catalog(f"select {TRACK_COLS} from tracks"),

    "load_overwrite": with_catalog(f"select {TRACK_COLS} from tracks where album_id is not null"),

    "load_upsert": with_catalog(UPSERTED),
    "stream_upsert": with_catalog(UPSERTED),

    "stream_albums": with_catalog("""
select a.album_id, a.album_name, a.album_release_date, a.album_total_tracks from albums a
where exists (select 1 from tracks t where t.album_id = a.album_id)"""),

    "stream_artists": with_catalog(f"""
select d.id as artist_id, d.name as artist_name, {ARRAY_TEXT} as artist_genres, d.popularity as artist_popularity
from artist_docs d
where d.id in (select unnest(string_to_array(t.artist_id, ', ')) from tracks t
               where t.album_id is not null or t.track_popularity is not null)""", ARTIST_DOCS_CTE),

    "select_all": with_catalog(f"select {TRACK_COLS} from tracks"),

    "run_log_next_id": f"""with {RUN_HISTORY_CTE}
select pipeline_name, cast(max(run_id) + 1 as integer) as next_run_id from history group by pipeline_name""",

    "run_log_next_id_of_job": f"""with {RUN_HISTORY_CTE}
select pipeline_name, cast(max(run_id) + 1 as integer) as next_run_id from history
where pipeline_name = (select min(pipeline_name) from history) group by pipeline_name
union all select 'never ran' as pipeline_name, cast(1 as integer) as next_run_id""",

    "run_log_append": f"""with {RUN_HISTORY_CTE}
select * from history
union all
select pipeline_name, cast(max(run_id) + 1 as integer) as run_id, '2024-02-01 00:00:00' as timestamp,
       'start' as status, '{{"source": "events"}}' as config, cast(null as varchar) as logs
from history group by pipeline_name""",
}


PLAYLISTS = with_catalog("""
select playlist_id, count(*) as num_tracks, count(distinct album_id) as num_albums,
       cast(sum(track_duration_ms) // count(track_duration_ms) as bigint) as mean_duration_ms
from tracks group by playlist_id""")

PAGED_CTE = """
paged as (
  select cast(dense_rank() over (order by playlist_id) - 1 as bigint) as pull,
         cast(row_number() over (partition by playlist_id order by page_no) - 1 as bigint) as page,
         playlist_id as id, count(*) as n_items,
         cast(sum(count(*)) over (partition by playlist_id) as bigint) as total,
         case when page_no < max(page_no) over (partition by playlist_id)
              then concat('playlists/', playlist_id, '/tracks?after=', cast(page_no as varchar)) end as next_page
  from (select *, cast(track_id as bigint) // 100 as page_no from tracks) p
  group by playlist_id, page_no)"""

FOLDER = {
    "read_paged_source": with_catalog("select * from paged", PAGED_CTE),
    "stream_paged_source": with_catalog(
        "select case when pull = 0 or (pull = 1 and page = 0) then 1 else 2 end as step, * from paged", PAGED_CTE),
    "load_drop_recreate": OTHERS["load_overwrite"],
    "stream_half_landed_pull": with_catalog("""
select 1 as step, track_id, track_popularity, playlist_id from tracks
where playlist_id > (select min(playlist_id) from tracks)
union all select 2 as step, track_id, track_popularity, playlist_id from tracks"""),
    "run_job_log": f"""with {RUN_HISTORY_CTE},
job as (select pipeline_name, max(run_id) as last from history
        where pipeline_name = (select min(pipeline_name) from history) group by pipeline_name),
later as (select * from (values (1, 'start', '', false), (1, 'success', (select count(*) from orders) || ' tracks', false),
                                (2, 'start', '', false), (2, 'fail', '', true)) v(k, status, said, names_error))
select pipeline_name, run_id, status, true as is_time, config, '' as said, false as names_error from history
union all
select j.pipeline_name, cast(j.last + l.k as integer) as run_id, l.status, true as is_time,
       case when l.k = 1 then '{{"source": "events"}}' end as config,
       case when l.status = 'start' then null else l.said end as said,
       case when l.status = 'start' then null else l.names_error end as names_error
from job j cross join later l""",
    "sql_playlists": PLAYLISTS,
    "sql_folder_views": "\nunion all\n".join(
        f"select '{name}' as view_name, count(*) as num_rows from ({query}) q"
        for name, query in {**VIEWS, "playlists": PLAYLISTS}.items()),
}


def oracle_statements() -> dict[str, str]:
    return {**OTHERS, **VIEWS, **FOLDER, **{f"sql_{name}": query for name, query in VIEWS.items()}}

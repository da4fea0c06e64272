-- Albums by the mean popularity of their tracks, beside the mean over the whole playlist.
WITH per_album AS (
  SELECT a.album_name, a.album_release_date, a.album_total_tracks, coalesce(p.n, 0) AS num_tracks_in_playlist, p.s, p.c
  FROM IDENTIFIER(:albums) a LEFT JOIN (
    SELECT album_id, count(track_id) AS n, sum(track_popularity) AS s, count(track_popularity) AS c
    FROM IDENTIFIER(:tracks) GROUP BY album_id
  ) p ON a.album_id = p.album_id
),
rows AS (
  SELECT DISTINCT album_name, album_release_date, album_total_tracks, num_tracks_in_playlist,
         CAST(round(try_divide(CAST(s AS decimal(20, 0)), c)) AS int) AS mean
  FROM per_album
),
overall AS (
  SELECT CAST(round(try_divide(CAST(sum(s) AS decimal(20, 0)), sum(c))) AS int) AS mean FROM per_album
),
ranks AS (
  SELECT mean, dense_rank() OVER (ORDER BY mean DESC NULLS FIRST) AS rnk FROM (SELECT DISTINCT mean FROM rows)
)
SELECT r.album_name, r.album_release_date, r.album_total_tracks, r.num_tracks_in_playlist,
       r.mean AS avg_album_track_popularity, CAST(k.rnk AS bigint) AS album_track_popularity_rnk,
       (SELECT mean FROM overall) AS avg_playlist_track_popularity,
       CASE WHEN r.mean > (SELECT mean FROM overall) THEN 1 ELSE 0 END AS is_more_popular_than_playlist_overall
FROM rows r JOIN ranks k ON r.mean <=> k.mean
ORDER BY album_track_popularity_rnk, album_name, album_release_date, album_total_tracks, num_tracks_in_playlist

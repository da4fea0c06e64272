-- Every track's album and release month, with the month's mean popularity and number of tracks.
WITH per_album AS (
  SELECT album_id, sum(track_popularity) AS s, count(track_popularity) AS c, count(track_id) AS n
  FROM IDENTIFIER(:tracks) GROUP BY album_id
),
months AS (
  SELECT album_id, album_name, left(album_release_date, 7) AS ym FROM IDENTIFIER(:albums)
),
per_month AS (
  SELECT m.ym, CAST(round(try_divide(CAST(sum(p.s) AS decimal(20, 0)), sum(p.c))) AS int) AS mean, sum(p.n) AS n
  FROM per_album p LEFT JOIN months m ON p.album_id = m.album_id GROUP BY m.ym
),
tracks_of AS (
  SELECT t.track_id, m.album_name, m.ym FROM IDENTIFIER(:tracks) t LEFT JOIN months m ON t.album_id = m.album_id
)
SELECT t.album_name, t.ym AS album_release_year_month, p.mean AS avg_release_year_month_track_popularity,
       p.n AS num_tracks_per_release_year_month
FROM tracks_of t JOIN per_month p ON t.ym <=> p.ym
ORDER BY t.ym DESC NULLS FIRST, t.track_id

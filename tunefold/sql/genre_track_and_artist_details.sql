-- Tracks and artists of every genre: numbers, and names as sorted lists.
WITH genres AS (
  SELECT artist_id, artist_name, explode(split(nullif(regexp_replace(artist_genres, '[{}"]', ''), ''), ',')) AS genre
  FROM IDENTIFIER(:artists)
),
pairs AS (
  SELECT track_id, track_name, explode(split(nullif(artist_id, ''), ', ')) AS artist_id FROM IDENTIFIER(:tracks)
)
SELECT g.genre, count(DISTINCT p.track_id) AS num_tracks, count(DISTINCT g.artist_id) AS num_artists,
       nullif(array_join(array_sort(collect_set(p.track_name)), ', '), '') AS track_names,
       nullif(array_join(array_sort(collect_set(g.artist_name)), ', '), '') AS artist_names
FROM pairs p JOIN genres g ON p.artist_id = g.artist_id
GROUP BY g.genre
ORDER BY num_tracks DESC, num_artists DESC, genre

-- How many tracks the artists of the five highest popularities have; ties all count.
WITH best AS (
  SELECT artist_popularity, dense_rank() OVER (ORDER BY artist_popularity DESC NULLS FIRST) AS artist_popularity_rnk
  FROM (SELECT DISTINCT artist_popularity FROM IDENTIFIER(:artists) ORDER BY artist_popularity DESC NULLS FIRST LIMIT 5)
),
named AS (
  SELECT a.artist_id, a.artist_name, a.artist_popularity, b.artist_popularity_rnk
  FROM IDENTIFIER(:artists) a JOIN best b ON a.artist_popularity <=> b.artist_popularity
),
pairs AS (
  SELECT track_id, explode(split(nullif(artist_id, ''), ', ')) AS artist_id FROM IDENTIFIER(:tracks)
)
SELECT n.artist_name, n.artist_popularity, CAST(n.artist_popularity_rnk AS bigint) AS artist_popularity_rnk,
       count(DISTINCT p.track_id) AS total_tracks_contributed
FROM pairs p JOIN named n ON p.artist_id = n.artist_id
GROUP BY n.artist_name, n.artist_popularity, n.artist_popularity_rnk
ORDER BY artist_popularity_rnk, artist_name, artist_popularity

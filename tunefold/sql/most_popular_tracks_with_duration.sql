-- Every track with its duration as m:ss and its rank by popularity. Ranks are made of the
-- distinct popularities (0 to 100), so the window is over those rows only.
WITH ranks AS (
  SELECT track_popularity, dense_rank() OVER (ORDER BY track_popularity DESC NULLS FIRST) AS popularity_rnk
  FROM (SELECT DISTINCT track_popularity FROM IDENTIFIER(:tracks))
)
SELECT t.track_id, t.track_name, t.track_popularity,
       concat_ws('', CAST(t.track_duration_ms DIV 60000 AS string), ':', lpad(CAST(t.track_duration_ms DIV 1000 % 60 AS string), 2, '0'))
         AS track_duration_min,
       CAST(r.popularity_rnk AS bigint) AS popularity_rnk
FROM IDENTIFIER(:tracks) t JOIN ranks r ON t.track_popularity <=> r.track_popularity
ORDER BY popularity_rnk, track_id

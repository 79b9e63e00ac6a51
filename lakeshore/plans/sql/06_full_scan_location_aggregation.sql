SELECT
  pu_location_id,
  do_location_id,
  COUNT(*) AS trip_count,
  COALESCE(CASE WHEN COUNT_IF(total_amount IS NOT NULL AND NOT COALESCE(TRY_CAST(RINT(total_amount * 1000000D) AS BIGINT) BETWEEN -9007199254740991 AND 9007199254740991 AND TRY_CAST(RINT(total_amount * 1000000D) AS BIGINT) / 1000000D = total_amount, FALSE)) = 0 THEN CAST(TRY_SUM(TRY_CAST(RINT(total_amount * 1000000D) AS BIGINT)) * 0.000001BD AS DOUBLE) END, SUM(total_amount)) AS total_revenue,
  COALESCE(CASE WHEN COUNT_IF(trip_distance IS NOT NULL AND NOT COALESCE(TRY_CAST(RINT(trip_distance * 1000000D) AS BIGINT) BETWEEN -9007199254740991 AND 9007199254740991 AND TRY_CAST(RINT(trip_distance * 1000000D) AS BIGINT) / 1000000D = trip_distance, FALSE)) = 0 THEN CAST(TRY_SUM(TRY_CAST(RINT(trip_distance * 1000000D) AS BIGINT)) * 0.000001BD AS DOUBLE) END, SUM(trip_distance)) / COUNT(trip_distance) AS avg_trip_distance
FROM silver_trips
GROUP BY pu_location_id, do_location_id
ORDER BY trip_count DESC, pu_location_id, do_location_id
LIMIT 20

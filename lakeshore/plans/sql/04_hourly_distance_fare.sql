SELECT
  HOUR(pickup_datetime) AS pickup_hour,
  COUNT(*) AS trip_count,
  COALESCE(CASE WHEN COUNT_IF(trip_distance IS NOT NULL AND NOT COALESCE(TRY_CAST(RINT(trip_distance * 1000000D) AS BIGINT) BETWEEN -9007199254740991 AND 9007199254740991 AND TRY_CAST(RINT(trip_distance * 1000000D) AS BIGINT) / 1000000D = trip_distance, FALSE)) = 0 THEN CAST(TRY_SUM(TRY_CAST(RINT(trip_distance * 1000000D) AS BIGINT)) * 0.000001BD AS DOUBLE) END, SUM(trip_distance)) / COUNT(trip_distance) AS avg_trip_distance,
  COALESCE(CASE WHEN COUNT_IF(fare_amount IS NOT NULL AND NOT COALESCE(TRY_CAST(RINT(fare_amount * 1000000D) AS BIGINT) BETWEEN -9007199254740991 AND 9007199254740991 AND TRY_CAST(RINT(fare_amount * 1000000D) AS BIGINT) / 1000000D = fare_amount, FALSE)) = 0 THEN CAST(TRY_SUM(TRY_CAST(RINT(fare_amount * 1000000D) AS BIGINT)) * 0.000001BD AS DOUBLE) END, SUM(fare_amount)) / COUNT(fare_amount) AS avg_fare_amount,
  COALESCE(CASE WHEN COUNT_IF(total_amount IS NOT NULL AND NOT COALESCE(TRY_CAST(RINT(total_amount * 1000000D) AS BIGINT) BETWEEN -9007199254740991 AND 9007199254740991 AND TRY_CAST(RINT(total_amount * 1000000D) AS BIGINT) / 1000000D = total_amount, FALSE)) = 0 THEN CAST(TRY_SUM(TRY_CAST(RINT(total_amount * 1000000D) AS BIGINT)) * 0.000001BD AS DOUBLE) END, SUM(total_amount)) / COUNT(total_amount) AS avg_total_amount
FROM silver_trips
GROUP BY HOUR(pickup_datetime)
ORDER BY pickup_hour

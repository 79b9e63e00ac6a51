SELECT
  payment_type,
  SUM(trip_count) AS trip_count,
  ROUND(COALESCE(CASE WHEN COUNT_IF(total_tip IS NOT NULL AND NOT COALESCE(TRY_CAST(RINT(total_tip * 1000000D) AS BIGINT) BETWEEN -9007199254740991 AND 9007199254740991 AND TRY_CAST(RINT(total_tip * 1000000D) AS BIGINT) / 1000000D = total_tip, FALSE)) = 0 THEN CAST(TRY_SUM(TRY_CAST(RINT(total_tip * 1000000D) AS BIGINT)) * 0.000001BD AS DOUBLE) END, SUM(total_tip)) / SUM(trip_count), 2) AS avg_tip_per_trip
FROM payment_metrics
GROUP BY payment_type
ORDER BY payment_type

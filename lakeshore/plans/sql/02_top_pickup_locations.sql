SELECT
  pickup_date,
  pu_location_id,
  SUM(trip_count) AS trip_count,
  COALESCE(CASE WHEN COUNT_IF(total_revenue IS NOT NULL AND NOT COALESCE(TRY_CAST(RINT(total_revenue * 1000000D) AS BIGINT) BETWEEN -9007199254740991 AND 9007199254740991 AND TRY_CAST(RINT(total_revenue * 1000000D) AS BIGINT) / 1000000D = total_revenue, FALSE)) = 0 THEN CAST(TRY_SUM(TRY_CAST(RINT(total_revenue * 1000000D) AS BIGINT)) * 0.000001BD AS DOUBLE) END, SUM(total_revenue)) AS total_revenue
FROM location_metrics
WHERE pickup_date BETWEEN :start_date AND :end_date
GROUP BY pickup_date, pu_location_id
ORDER BY trip_count DESC, pickup_date, pu_location_id
LIMIT 10

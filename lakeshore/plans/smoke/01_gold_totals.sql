SELECT
  COUNT(*) AS daily_rows,
  SUM(trip_count) AS total_trips,
  ROUND(COALESCE(CASE WHEN COUNT_IF(total_revenue IS NOT NULL AND NOT COALESCE(TRY_CAST(RINT(total_revenue * 1000000D) AS BIGINT) BETWEEN -9007199254740991 AND 9007199254740991 AND TRY_CAST(RINT(total_revenue * 1000000D) AS BIGINT) / 1000000D = total_revenue, FALSE)) = 0 THEN CAST(TRY_SUM(TRY_CAST(RINT(total_revenue * 1000000D) AS BIGINT)) * 0.000001BD AS DOUBLE) END, SUM(total_revenue)), 2) AS total_revenue
FROM daily_trip_metrics

SELECT
  pickup_date,
  trip_count,
  total_revenue,
  fare_revenue,
  total_tip
FROM daily_trip_metrics
ORDER BY pickup_date

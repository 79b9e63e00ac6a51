SELECT
  pickup_date,
  trip_count,
  ROUND(total_revenue, 2) AS total_revenue
FROM daily_trip_metrics
ORDER BY pickup_date
LIMIT 10

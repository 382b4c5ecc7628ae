select customer_id, full_name, country_code, total_transactions, flagged_count, avg_risk_score, overall_risk_level,
  rank() over (order by avg_risk_score desc) as risk_rank, dense_rank() over (order by flagged_count desc) as flagged_rank
from profile

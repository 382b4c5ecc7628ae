select transaction_id, customer_id, daily_volume, recent_count, risk_score from scored

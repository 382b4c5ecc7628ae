select transaction_id, risk_score, status from verdicts

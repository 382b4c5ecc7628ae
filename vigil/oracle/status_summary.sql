select status, count(*) as count,
  cast(cast((200 * sum(risk_score) + count(*)) // (2 * count(*)) as decimal(7,0)) * cast(0.01 as decimal(3,2)) as decimal(5,2)) as avg_risk
from bank_transactions_scored group by status

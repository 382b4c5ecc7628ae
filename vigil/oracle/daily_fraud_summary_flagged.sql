select * from summary where flagged_transactions > 0

select count(*) as approved_count from bulk where not overdraft

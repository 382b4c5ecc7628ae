select * from summary

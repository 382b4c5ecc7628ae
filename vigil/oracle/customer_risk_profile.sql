select * from profile

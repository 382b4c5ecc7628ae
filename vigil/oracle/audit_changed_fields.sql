select 'accounts' as table_name, case when is_new then 'INSERT' when is_gone then 'DELETE' else 'UPDATE' end as operation, column_name,
  json_extract_string(before, path) as old_text, json_extract_string(after, path) as new_text, count(*) as n
from (select is_new, is_gone, if(is_new, null, old_text)::json as before, if(is_gone, null, new_text)::json as after from change_texts)
cross join (values ('currency', '$.currency'), ('status', '$.status')) as c(column_name, path)
where coalesce(json_exists(before, path), false) or coalesce(json_exists(after, path), false)
group by all

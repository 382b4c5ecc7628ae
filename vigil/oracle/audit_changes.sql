select 'accounts' as table_name, row_key, customer_id,
  case when is_new then 'INSERT' when is_gone then 'DELETE' else 'UPDATE' end as operation,
  if(is_new, null, old_text) as old_value, if(is_gone, null, new_text) as new_value, timestamp '2024-02-10 00:00:00' as changed_at
from change_texts

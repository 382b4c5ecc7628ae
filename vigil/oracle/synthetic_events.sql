, sizes as (
  select (select count(*) from customer) as customers, (select count(*) from part) as products
)
, event_salts(name, salt) as (
  values ('event_customer', 1066335848), ('event_type', 1432183109), ('event_time', 907521578), ('source', 92358358), ('campaign', 944593842), ('device', 1394904873), ('browser', 1702626015), ('os', 1356435267), ('ip_0', 1111941539), ('ip_1', 893505845), ('ip_2', 742949006), ('ip_3', 1531949080), ('page_url', 529597524), ('referrer', 1245457419), ('utm_source', 1758870609), ('utm_medium', 1898907284), ('utm_campaign', 1315553994), ('attr_01', 997043008), ('attr_02', 577043195), ('attr_03', 1432603245), ('attr_04', 1258774479), ('attr_05', 1006661465), ('attr_06', 621362916), ('attr_07', 1376652918), ('attr_08', 1118901220), ('attr_09', 901129074), ('attr_10', 1433512599)
), event_first as (
  select id, name, salt, (id + salt) % 2147483647 as x from (select event_id + 1 as id from events) as ids, event_salts
), event_second as (
  select id, name, salt, (x * x + id // 2147483647 + salt) % 2147483647 as y from event_first
), event_third as (
  select id, name, y * 2147483647 + (y * y + salt) % 2147483647 as third from event_second
), event_drawn as (
  select id,
    max(third) filter (name = 'event_customer') as event_customer_drawn,
    max(third) filter (name = 'event_type') as event_type_drawn,
    max(third) filter (name = 'event_time') as event_time_drawn,
    max(third) filter (name = 'source') as source_drawn,
    max(third) filter (name = 'campaign') as campaign_drawn,
    max(third) filter (name = 'device') as device_drawn,
    max(third) filter (name = 'browser') as browser_drawn,
    max(third) filter (name = 'os') as os_drawn,
    max(third) filter (name = 'ip_0') as ip_0_drawn,
    max(third) filter (name = 'ip_1') as ip_1_drawn,
    max(third) filter (name = 'ip_2') as ip_2_drawn,
    max(third) filter (name = 'ip_3') as ip_3_drawn,
    max(third) filter (name = 'page_url') as page_url_drawn,
    max(third) filter (name = 'referrer') as referrer_drawn,
    max(third) filter (name = 'utm_source') as utm_source_drawn,
    max(third) filter (name = 'utm_medium') as utm_medium_drawn,
    max(third) filter (name = 'utm_campaign') as utm_campaign_drawn,
    max(third) filter (name = 'attr_01') as attr_01_drawn,
    max(third) filter (name = 'attr_02') as attr_02_drawn,
    max(third) filter (name = 'attr_03') as attr_03_drawn,
    max(third) filter (name = 'attr_04') as attr_04_drawn,
    max(third) filter (name = 'attr_05') as attr_05_drawn,
    max(third) filter (name = 'attr_06') as attr_06_drawn,
    max(third) filter (name = 'attr_07') as attr_07_drawn,
    max(third) filter (name = 'attr_08') as attr_08_drawn,
    max(third) filter (name = 'attr_09') as attr_09_drawn,
    max(third) filter (name = 'attr_10') as attr_10_drawn
  from event_third group by id
)
select
  id as event_id,
  event_customer_drawn % customers + 1 as customer_id,
  list_extract(['page_view', 'click', 'purchase', 'login', 'logout'], cast(event_type_drawn % 5 as int) + 1) as event_type,
  timestamp '2024-02-10' - to_seconds(event_time_drawn % 31536000) as event_time,
  list_extract(['google', 'facebook', 'email', 'direct', 'tiktok'], cast(source_drawn % 5 as int) + 1) as source,
  'campaign ' || (campaign_drawn % 1000) as campaign,
  list_extract(['mobile', 'desktop', 'tablet'], cast(device_drawn % 3 as int) + 1) as device,
  list_extract(['chrome', 'safari', 'firefox', 'edge'], cast(browser_drawn % 4 as int) + 1) as browser,
  list_extract(['ios', 'android', 'windows', 'macos', 'linux'], cast(os_drawn % 5 as int) + 1) as os,
  (ip_0_drawn % 256) || '.' || (ip_1_drawn % 256) || '.' || (ip_2_drawn % 256) || '.' || (ip_3_drawn % 256) as ip_address,
  'https://example.com/' || (page_url_drawn % 1000) as page_url,
  'https://example.org/' || (referrer_drawn % 1000) as referrer,
  'word ' || (utm_source_drawn % 1000) as utm_source,
  'word ' || (utm_medium_drawn % 1000) as utm_medium,
  'word ' || (utm_campaign_drawn % 1000) as utm_campaign,
  'text ' || (attr_01_drawn % 1000) as attr_01,
  'text ' || (attr_02_drawn % 1000) as attr_02,
  'text ' || (attr_03_drawn % 1000) as attr_03,
  'text ' || (attr_04_drawn % 1000) as attr_04,
  'text ' || (attr_05_drawn % 1000) as attr_05,
  'text ' || (attr_06_drawn % 1000) as attr_06,
  'text ' || (attr_07_drawn % 1000) as attr_07,
  'text ' || (attr_08_drawn % 1000) as attr_08,
  'text ' || (attr_09_drawn % 1000) as attr_09,
  'text ' || (attr_10_drawn % 1000) as attr_10
from event_drawn, sizes

select event_id, customer_id, event_type, event_time, source, campaign, device, browser, os, ip_address, page_url, referrer from crm_events_wide

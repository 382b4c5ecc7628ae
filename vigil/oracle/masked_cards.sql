select card_id, case when length(card_number) >= 4 then '****-****-****-' || right(card_number, 4) else '****' end as masked_card
from bank_cards

"""Oracle fragments several statements share: lookup tables in SQL."""

from __future__ import annotations

# Status, stage it shows progress to, funnel label.
KINDS = """
    kinds(kind, progress, funnel) AS (VALUES
        ('new', 'оформлено', 'создано'),
        ('pending_approve', 'оформлено', 'анкета не заполнена'),
        ('approved_not_filled', 'оформлено', 'анкета не заполнена'),
        ('awaiting_loan_approve', 'оформлено', 'анкета заполнена'),
        ('filled_not_approved', 'оформлено', 'анкета заполнена'),
        ('pending_pickup', 'принято', 'договор подписан'),
        ('on_delivery', 'принято', 'договор подписан'),
        ('awaiting_parcel_ready', 'принято', 'договор подписан'),
        ('sync_with_delivery', 'принято', 'договор подписан'),
        ('courier_delivery', 'принято', 'договор подписан'),
        ('awaiting_courier_pickup', 'принято', 'договор подписан'),
        ('taken', 'завершено', 'завершен'),
        ('delivered', 'завершено', 'завершен'),
        ('returned', 'возврат', 'возврат'))
"""

STAGE = """
    CASE WHEN NOT paid AND (status = 'new' OR (status = 'pending_approve' AND pay_types = 'COD')) THEN 'создано'
        ELSE coalesce(progress, 'отменено') END
"""

# Reason of a cancelled row.
REASON = """
    coalesce(
        CASE WHEN cancelled_reason = 'active' THEN 'активная заявка' END,
        CASE WHEN bank_status = 'cancel' THEN 'отказ: скоринг' END,
        CASE cancelled_reason WHEN 'CLIENT.DECLINE' THEN 'отменено клиентом' WHEN 'error' THEN 'общие ошибки'
            WHEN 'Таймаут на решении клиента' THEN 'отменено по timeout' END,
        CASE WHEN bank_status = 'rejected' THEN 'отказ: вн. проверки банка' END,
        CASE regexp_extract(status, 'cancelledby(.*)', 1) WHEN 'bank' THEN 'отменено банком'
            WHEN 'client' THEN 'отменено клиентом' WHEN 'merchant' THEN 'отменено партнером'
            WHEN 'timeout' THEN 'отменено по timeout' ELSE 'отменено' END)
"""

# What a second or third status says about where the order is;
# the lowest rank that applies counts.
WHEREABOUTS = """
    whereabouts(place, kind, then_kind, rank, text) AS (VALUES
        (3, 'courier_delivery', NULL, 1, 'казпочта: на доставке курьером'),
        (3, 'awaiting_parcel_ready', 'delivered', 1, 'казпочта: на доставке курьером'),
        (3, 'sync_with_delivery', 'delivered', 1, 'казпочта: на доставке курьером'),
        (3, 'awaiting_courier_pickup', 'delivered', 1, 'казпочта: на доставке курьером'),
        (3, 'awaiting_parcel_ready', NULL, 2, 'казпочта: ожидает готовности посылки'),
        (3, 'awaiting_courier_pickup', NULL, 3, 'казпочта: ожидает курьера'),
        (3, 'sync_with_delivery', NULL, 3, 'казпочта: ожидает курьера'),
        (2, 'pending_pickup', NULL, 4, 'на выдаче'),
        (3, 'pending_pickup', NULL, 4, 'на выдаче'),
        (3, 'taken', NULL, 4, 'на выдаче'),
        (2, 'on_delivery', NULL, 5, 'на доставке'),
        (3, 'on_delivery', NULL, 5, 'на доставке'),
        (3, 'delivered', NULL, 5, 'на доставке'),
        (2, 'awaiting_loan_approve', NULL, 6, 'на подписании'),
        (2, 'approved_not_filled', NULL, 7, 'ожидаем анкету'),
        (2, 'filled_not_approved', NULL, 8, 'на партнере'))
"""
# Needs s2, s3 and s4 in scope.
PLACE = """
    (SELECT arg_min(text, rank) FROM whereabouts
     WHERE ((place = 2 AND kind = s2) OR (place = 3 AND kind = s3)) AND (then_kind IS NULL OR then_kind = s4))
"""

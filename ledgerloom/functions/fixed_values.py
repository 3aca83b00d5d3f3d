"""Codes, labels and patterns the marts must reproduce exactly.

Names of a particular lender, sender or merchant are not here; they are
arguments of the functions that need them.
"""

from __future__ import annotations

# Order statuses per stage.
SUBMITTED_STATUSES = (
    "new",
    "pending_approve",
    "awaiting_loan_approve",
    "filled_not_approved",
    "approved_not_filled",
)
ACCEPTED_STATUSES = (
    "pending_pickup",
    "on_delivery",
    "awaiting_parcel_ready",
    "sync_with_delivery",
    "courier_delivery",
    "awaiting_courier_pickup",
)
COMPLETED_STATUSES = ("taken", "delivered")
RETURNED_STATUSES = ("returned",)
CANCEL_PATTERN = "%cancel%"

# Statuses that show the merchant approved, the contract signed.
MERCHANT_APPROVED_STATUSES = (
    "returned",
    "delivered",
    "taken",
    "approved_not_filled",
    "awaiting_loan_approve",
    "awaiting_parcel_ready",
    "sync_with_delivery",
    "courier_delivery",
    "pending_pickup",
    "on_delivery",
    "awaiting_courier_pickup",
)
CONTRACT_SIGNED_STATUSES = ("on_delivery", "pending_pickup", "delivered", "taken", "returned")

# Stage labels and numbers.
CREATED = "создано"
SUBMITTED = "оформлено"
ACCEPTED = "принято"
COMPLETED = "завершено"
RETURNED = "возврат"
CANCELLED = "отменено"
STAGE_NUMBERS = {
    CREATED: 1,
    SUBMITTED: 2,
    ACCEPTED: 3,
    COMPLETED: 4,
    RETURNED: 5,
    CANCELLED: 6,
}

# Labels of the credit funnel.
FUNNEL_NEW = "создано"
FUNNEL_FORM_OPEN = "анкета не заполнена"
FUNNEL_FORM_FILLED = "анкета заполнена"
FUNNEL_SIGNED = "договор подписан"
FUNNEL_COMPLETED = "завершен"
FUNNEL_RETURNED = "возврат"
FUNNEL_CANCELLED = "отменен"
FUNNEL_STATUSES = {
    FUNNEL_NEW: ("new",),
    FUNNEL_FORM_OPEN: ("pending_approve", "approved_not_filled"),
    FUNNEL_FORM_FILLED: ("awaiting_loan_approve", "filled_not_approved"),
    FUNNEL_SIGNED: ACCEPTED_STATUSES,
    FUNNEL_COMPLETED: COMPLETED_STATUSES,
    FUNNEL_RETURNED: RETURNED_STATUSES,
}
EXCLUDED_SECOND_STATUSES = ("cancelled", "cancelledbytimeout", "cancelledbyclient")

# Cancel reasons.
REASON_ACTIVE = "активная заявка"
REASON_SCORING = "отказ: скоринг"
REASON_CLIENT = "отменено клиентом"
REASON_ERROR = "общие ошибки"
REASON_TIMEOUT = "отменено по timeout"
REASON_BANK_CHECK = "отказ: вн. проверки банка"
REASON_BANK = "отменено банком"
REASON_MERCHANT = "отменено партнером"
REASON_PLAIN = "отменено"
CLIENT_TIMEOUT_CODE = "Таймаут на решении клиента"
REASON_RULES = (
    ("cancelled_reason", "active", REASON_ACTIVE),
    ("bank_status", "cancel", REASON_SCORING),
    ("cancelled_reason", "CLIENT.DECLINE", REASON_CLIENT),
    ("cancelled_reason", "error", REASON_ERROR),
    ("cancelled_reason", CLIENT_TIMEOUT_CODE, REASON_TIMEOUT),
    ("bank_status", "rejected", REASON_BANK_CHECK),
)
STATUS_REASONS = (
    ("%cancelledbybank%", REASON_BANK),
    ("%cancelledbyclient%", REASON_CLIENT),
    ("%cancelledbymerchant%", REASON_MERCHANT),
    ("%cancelledbytimeout%", REASON_TIMEOUT),
    (CANCEL_PATTERN, REASON_PLAIN),
)
KEPT_REASON_PATTERNS = ("%отменено%", "%отказ%", "%общие ошибки%", "%активная заявка%")

# Delivery labels.
DELIVERY_COURIER = "доставка"
DELIVERY_POST = "казпочта"
DELIVERY_PICKUP = "самовывоз"

# Final state descriptions.
POST_WITH_COURIER = "казпочта: на доставке курьером"
POST_WAITS_PARCEL = "казпочта: ожидает готовности посылки"
POST_WAITS_COURIER = "казпочта: ожидает курьера"
AT_PICKUP = "на выдаче"
ON_DELIVERY = "на доставке"
AT_SIGNING = "на подписании"
WAITS_FORM = "ожидаем анкету"
AT_MERCHANT = "на партнере"
APPROVED = "одобрено"
HANDED_OVER = "выдан"
DELIVERED = "доставлен"
GIVEN_BACK = "возвращен"
POST_STATUSES = ("awaiting_parcel_ready", "sync_with_delivery", "awaiting_courier_pickup")
ENDINGS = ((HANDED_OVER, "taken"), (DELIVERED, "delivered"))

# Payment products.
CREDIT_CARD = "Кредитная карта"
CARD_4 = "Кредитная карта на 4 месяца"
CARD_6 = "Кредитная карта на 6 месяцев"
CARD_12 = "Кредитная карта на 12 месяцев"
INSTALMENT_4 = "Рассрочка на 4 месяца"
INSTALMENT_12 = "Рассрочка на 12 месяцев"
INSTALMENT_24 = "Рассрочка на 24 месяца"
CREDIT_6 = "Кредит на 6 месяцев"
CREDIT_12 = "Кредит на 12 месяцев"
CREDIT_24 = "Кредит на 24 месяца"
BANK_CARD = "Банковская карта"
BUY_IN_PARTS = "В рассрочку"
CASH = "Оплата наличными"

# Tariff codes and wordings per payment product. {code} and {title}
# stand for the lender's product code and wording.
CARD_CODES = {
    CARD_4: ("ACQUIRING_0_4",),
    CARD_6: ("ACQUIRING_0_6",),
    CARD_12: ("ACQUIRING_0_12",),
}
CARD_TITLES = {
    CARD_4: ("Кредитная карта в рассрочку на 4 месяца", "Кредитная карта на 4 месяца"),
    CARD_6: ("Кредитная карта в рассрочку на 6 месяцев", "Кредитная карта на 6 месяцев"),
    CARD_12: ("Кредитная карта в рассрочку на 12 месяцев", "Кредитная карта на 12 месяцев"),
    CREDIT_CARD: (
        "В рассрочку",
        "Кредитная карта в рассрочку на undefined месяцев",
        "Кредитная карта в рассрочку на 24 месяцев",
        "В рассрочку по кред. карте",
    ),
}
EXPRESS_CODES = {
    INSTALMENT_4: ("{code}_0_4",),
    INSTALMENT_12: ("{code}_0_12",),
    INSTALMENT_24: ("{code}_0_24",),
    CREDIT_6: ("{code}_18_6",),
    CREDIT_12: ("{code}_18_12",),
    CREDIT_24: ("{code}_18_24",),
}
LOAN_TITLES = {
    CREDIT_12: ("Кредит на 12 месяцев",),
    CREDIT_24: (
        "{title} на 24 месяцев",
        "{title} на 24 месяцa",
        "Кредит на 24 месяца",
    ),
    CREDIT_6: (
        "{title} на 6 месяцев",
        "В рассрочку на 6 месяцев",
        "Кредит на 6 месяцев",
    ),
    INSTALMENT_12: ("В рассрочку на 12 месяцев", "Рассрочка на 12 месяцев"),
    INSTALMENT_24: ("В рассрочку на 24 месяцев", "Рассрочка на 24 месяца"),
    INSTALMENT_4: (
        "В рассрочку на 4 месяца",
        "В рассрочку на 4 месяцев",
        "Рассрочка на 4 месяца",
    ),
}
# Tariff columns besides the lender's, and the whole list in order.
CARD_RATE = {BANK_CARD: ("CARD_0_0",)}
RATE_CODES = (
    "{code}_0_4",
    "{code}_0_12",
    "{code}_0_24",
    "{code}_18_6",
    "{code}_18_12",
    "{code}_18_24",
    "CARD_0_0",
    "ACQUIRING_0_4",
    "ACQUIRING_0_6",
    "ACQUIRING_0_12",
)

# Payment wordings left out of the order marts.
SKIPPED_PAY_TITLES = ("Оплата в рассрочку", "Оплата онлайн")
SKIPPED_PAY_TYPE = "CREDIT"

# Loan product codes.
LOAN_PRODUCTS = {
    INSTALMENT_4: ("FM 4-1",),
    CREDIT_6: ("FM 6-01",),
    CREDIT_12: ("FM 12-01",),
    CREDIT_24: ("FM 24-01",),
    INSTALMENT_12: ("FM 12-1-1",),
    INSTALMENT_24: ("FM 24-1-1",),
}

# Region code patterns of the city identifiers.
CITY_PATTERNS = (
    ("%KZ-AKM-111010000%", "Кокшетау"),
    ("%KZ-AKT-151010000%", "Актобе"),
    ("%KZ-ALA%", "Алматы"),
    ("%KZ-ALM-191010000%", "Талдыкорган"),
    ("%KZ-ALM-195220100%", "Каскелен"),
    ("%KZ-AST%", "Нур-Султан"),
    ("%KZ-ATY-231010000%", "Атырау"),
    ("%KZ-KAR-351010000%", "Караганда"),
    ("%KZ-KUS-391010000%", "Костанай"),
    ("%KZ-KZY-431010000%", "Кызылорда"),
    ("%KZ-MAN-471010000%", "Актау"),
    ("%KZ-PAV-551010000%", "Павлодар"),
    ("%KZ-PAV-552210000%", "Экибастуз"),
    ("%KZ-SEV-591010000%", "Петропавловск"),
    ("%KZ-SHY%", "Шымкент"),
    ("%KZ-TUR-611010000%", "Туркестан"),
    ("%KZ-VOS-631010000%", "Усть-Каменогорск"),
    ("%KZ-VOS-632810000%", "Семей"),
    ("%KZ-ZAP-271010000%", "Уральск"),
    ("%KZ-ZHA-311010000%", "Тараз"),
)

# Customer segments (upper bounds, labels, label above the last).
INCOME_SEGMENTS = (
    (200000, "до 200 000"),
    (400000, "до 400 000"),
    (600000, "до 600 000"),
)
INCOME_ABOVE = "более 600 000"
PRICE_SEGMENTS = (
    (50000, "до 50 000"),
    (200000, "до 200 000"),
    (500000, "до 500 000"),
    (600000, "до 600 000"),
)
AGE_SEGMENTS = (
    (25, "до 25"),
    (35, "до 35"),
    (45, "до 45"),
    (55, "до 55"),
)
AGE_ABOVE = "старше 55"
LOAN_TYPES = {"Кредит": ("credit",), "Рассрочка": ("installment",)}

# Catalogue count labels and price remarks.
SAME_PRICES = "Цены одинаковые"
SEVERAL_SELLERS = "Несколько партнеров, см. реестр"
ENABLED = "опубликовано"
DISABLED = "снято"
ARCHIVE = "Архив"

# Shortened category labels.
SHORT_CATEGORIES = {
    "Смартфоны, ТВ и эл.": ("Смартфоны, ТВ и электроника",),
    "Ак. для телефонов": ("Аксессуары для телефонов",),
    "Товары для дома": (" Товары для дома и сада",),
    "Ноутбуки и комп.": ("Ноутбуки и компьютеры",),
    "Одежда и ак.": ("Одежда и аксессуары",),
}

# Purchase report labels per payment segment (status/paid).
PURCHASES_ANY = {
    "oformleno": ("new/false",),
    "postupilo": ("pending_approve/false",),
    "priniyat": ("pending_pickup/false", "on_delivery/false"),
    "zaverweno": ("taken/true", "delivered/true"),
    "vozvrat": ("returned/true",),
    "otmeneno": ("cancelled/true", "cancelled/false"),
}
PURCHASES_PREPAID = {
    "oformleno": ("new/false",),
    "postupilo": ("pending_approve/true", "new/true"),
    "priniyat": ("pending_pickup/true", "on_delivery/true"),
    "zaverweno": ("taken/true", "delivered/true"),
    "vozvrat": ("returned/true",),
    "otmeneno": ("cancelled/true", "cancelled/false"),
}
PURCHASES_CASH = {
    "oformleno": ("pending_approve/false", "new/false"),
    "priniyat": ("pending_pickup/false", "on_delivery/false"),
    "zaverweno": ("taken/true", "delivered/true"),
    "vozvrat": ("returned/true",),
    "otmeneno": ("cancelled/true", "cancelled/false"),
}

# Process states, test names of the call-centre report.
PROCESS_STATES = {"COMPLETED": ("true",), "ACTIVE": ("false",)}
TEST_NAMES = ("test", "тест", "ascsdbfdn")

# Time zone and the hour from which a bank row counts for the next day.
LOCAL_ZONE = "Asia/Almaty"
CUTOFF_HOUR = 8

# Earliest catalogue date, earliest ledger date, root category key.
CATALOGUE_SINCE = "2018-10-01"
LEDGER_SINCE = "2020-09-01"
ROOT_CATEGORY = "root"

# Report headers.
ABANDONED_HEADERS = (
    "ФИО клиента",
    "Номер телефона",
    "Номер заказа",
    "Способ оплаты",
    "Дата заказа",
    "Использованный промокод",
    "Сумма скидки по промокоду",
    "Город",
    "Продавец",
    "Товар",
    "Цена товара (без промокода)",
)
PURCHASES_HEADERS = (
    "UID",
    "Статус оплаты",
    "Тип оплаты",
    "Дата создания",
    "Дата обновления",
    "Имя",
    "Фамилия",
    "Телефон",
    "Город",
    "Адрес",
    "Номер дома",
    "Номер квартиры",
    "Партнер",
    "Наименование продукта",
    "Сумма",
    "Доставка",
    "Статус расшифровки",
    "Комментарий отмены",
    "Категория 1",
    "Категория 2",
    "Категория 3",
    "Категория 4",
    "ИИН",
    "Статус1",
    "Статус2",
    "Название промокода",
    "Промокод",
    "Активирован",
    "Скидка",
)
PROCESS_FLOW_HEADERS = (
    "№ заявки",
    "Дата старта процесса",
    "Наименование процесса",
    "Уникальный идентификатор заявки",
    "Название шага, на котором находится заявка",
    "Срок исполнения заявки на шаге, на котором находится заявка",
    "Дата и время поступления заявки на шаг, на котором находится заявка",
    "Дата завершения",
    "ID сотрудника исполнителя",
    "Логин пользователя, на шаге которого находится заявка",
    "ФИО пользователя, на шаге которого находится заявка",
    "ID должности сотрудника, на шаге которого находится заявка",
    "Звание пользователя, на шаге которого находится заявка",
    "ID специализации сотрудника, на шаге которого находится заявка",
    "Направление пользователя, на шаге которого находится заявка",
    "ID подразделения сотрудника, на шаге которого находится заявка",
    "Департамент пользователя, на шаге которого находится заявка",
    "ID сотрудника инициатора",
    "Логин автора заявки",
    "ФИО автора заявки",
    "ID должности сотрудника инициатора",
    "Звание автора заявки",
    "ID специализации сотрудника инициатора",
    "Направление автора заявки",
    "ID подразделения сотрудника инициатора",
    "Департамент автора заявки",
    "ID ГБ/Филиал",
    "ГБ/Филиал",
    "Статус",
    "Последний шаг заявки",
    "Текст  ошибки (Message)",
    "Дата и время ошибки",
)

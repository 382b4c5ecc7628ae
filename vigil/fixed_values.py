"""Values that results depend on.  Everything here is fixed by the data contract."""

# Risk countries and risk categories (matched case-sensitively).
RISK_COUNTRIES = ["KP", "IR", "SY", "CU", "VE", "MM", "AF"]
RISK_CATEGORIES = ["GAMBLING", "CRYPTO", "ADULT_CONTENT", "WEAPONS"]

# Score points.  Steps are (exclusive lower bound, points), highest first.
AMOUNT_STEPS = [(10000, 25), (5000, 15), (1000, 5)]
DAILY_VOLUME_STEPS = [(50000, 20), (20000, 10)]
# Steps of the other transactions within the past hour are (inclusive lower bound, points).
RECENT_COUNT_STEPS = [(5, 20), (3, 10)]
COUNTRY_POINTS = 25
CATEGORY_POINTS = 20
NIGHT_POINTS = 10
NIGHT_LAST_HOUR = 4
MAX_SCORE = 100

# Decision and label limits.
FLAG_FROM = 60
APPROVE_UP_TO = 30
LABEL_STEPS = [(60, "HIGH"), (30, "MEDIUM")]
LABEL_OTHERWISE = "LOW"

# Texts that matching alerts to rule types looks for, without regard to case.
RULE_TEXTS = {
    "AMOUNT": ["amount"],
    "COUNTRY": ["country"],
    "VELOCITY": ["velocit"],
    "BEHAVIOR": ["merchant", "gambling", "crypto"],
    "TIME": ["time"],
}

# Texts written into rows.
PROCESS_REASON = "process_transaction: risk score = "
ARRIVAL_REASON = "Auto-flagged: risk score "
AUTO_ACTOR = "SYSTEM_AUTO"
USER_ACTOR = "app_user"
CARD_MASK_SHORT = "****"
CARD_MASK_PREFIX = "****-****-****-"
UPDATE_PREFIX = "updated_"
UPDATE_TEXT = "changed"
PHONE_PREFIX = "changed_"

# Enumerations.
CURRENCIES = ["UAH", "USD", "EUR"]
ACCOUNT_STATUSES = ["ACTIVE", "FROZEN", "CLOSED"]
CARD_TYPES = ["DEBIT", "CREDIT", "PREPAID"]
CARD_STATUSES = ["ACTIVE", "BLOCKED", "EXPIRED"]
TRANSACTION_STATUSES = ["PENDING", "APPROVED", "DECLINED", "FLAGGED"]
RULE_TYPES = ["AMOUNT", "VELOCITY", "COUNTRY", "BEHAVIOR", "TIME"]
ALERT_STATUSES = ["OPEN", "REVIEWED", "CLOSED", "FALSE_POSITIVE"]
AUDIT_OPERATIONS = ["INSERT", "UPDATE", "DELETE"]

# Fixed value: e-mail format, matched without regard to case over the whole text.
EMAIL_PATTERN = r"^[A-Za-z0-9._%+-]+@[A-Za-z0-9.-]+\.[A-Za-z]{2,}$"

# Domains of generated commerce rows.
CUSTOMER_STATUSES = ["active", "inactive", "blocked"]
PRODUCT_CATEGORIES = ["electronics", "food", "clothes", "books", "home"]
ORDER_STATUSES = ["new", "paid", "shipped", "cancelled", "returned"]
PAYMENT_METHODS = ["card", "cash", "bank_transfer"]
EVENT_TYPES = ["page_view", "click", "purchase", "login", "logout"]
EVENT_SOURCES = ["google", "facebook", "email", "direct", "tiktok"]
DEVICES = ["mobile", "desktop", "tablet"]
BROWSERS = ["chrome", "safari", "firefox", "edge"]
SYSTEMS = ["ios", "android", "windows", "macos", "linux"]
PRICE_RANGE = (5, 1000)
ORDER_TOTAL_RANGE = (10, 3000)
ITEMS_PER_ORDER = (1, 5)
QUANTITY_RANGE = (1, 10)
CUSTOMER_AGE_DAYS = 3 * 365
PRODUCT_AGE_DAYS = 3 * 365
ORDER_AGE_DAYS = 2 * 365
EVENT_AGE_DAYS = 365

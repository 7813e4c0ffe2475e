"""Literals the source tables hold, which must be matched exactly for right results."""

# Programme: combined name, card brand names, contact brand ids, names used for charge-off balances.
PROGRAM_COMB_NAME = "CBH"
PROGRAM_BRAND_NAMES = ("Crate & Barrel", "CB2")
PROGRAM_BRAND_IDS = ("40954903794580", "36869591739412", "42879080717716")
PROGRAM_CHARGE_OFF_NAMES = ("Crate & Barrel", "CBH")
OTHER_PROGRAM_IN_CALLS = "Not CBH"
OTHER_PROGRAM_IN_CASES = "not CBH"
CANVAS_NAME_PATTERN = "%CBH%"
SUPPORT_SIGNATURE_PATTERN = "%Imprint%"
CUTOVER = "2025-10-10"
LOCAL_ZONE = "America/New_York"

# Account statuses.
STATUS_CHARGE_OFF = "CHARGE_OFF"
CODE_ID_THEFT = "ID_THEFT"
REASON_BANKRUPTCY = "BANKRUPTCY"
REASONS_COLLECTIONS = ("CCCS", "DECEASED")
REASONS_SCRA = ("SCRA", "CONVERTED_SCRA")
STATUS_DELINQUENT = "DELINQUENT"

# Calls and tickets.
REASON_TESTING = "general__testing"
REASON_BULK_REQUEST = "fraud__bulk_document_request"
GROUP_DISPUTES = "Disputes"
GROUP_FRAUD = "Fraud Ops"
TAG_MERGED = "closed_by_merge"
IVR_GROUP = "group"
ABANDONED_IN_IVR = "abandoned_in_ivr"
HANDLED_STATUSES = ("abandoned_on_hold", "completed")
ABANDONED_STATUSES = ("abandoned_in_voicemail", "not_answered", "abandoned_in_queue")
CHANNELS_CHAT = ("native_messaging", "chat")
CHANNELS_EMAIL = ("web", "answer_bot_for_web_widget")
NO_ACCOUNT_NEEDED = "no_uuid_needed"
ISSUE_TEST = "Test"
TIER_1 = ("tier_1",)
TIERS_2_3 = ("tier_2", "tier_3")
STAFF_ROLES = ("agent", "admin")

# Statistic labels.
CALLS_OFFERED = "calls offered"
CALLS_HANDLED = "calls handled"
CALLS_ABANDONED = "calls abandoned"
CALLS_OUTBOUND = "calls outbound"
AVG_SPEED_OF_ANSWER = "avg speed of answer in seconds"
AVG_HANDLE_TIME = "average handle time in seconds"
CALL_RESPONSE_IN_TIME = "Call Center Response Time within 120 seconds"
# Service levels entered by hand each month: label, value.
MANUAL_SERVICE_LEVELS = (
    ("Chat Response Time", None),
    ("Email Response Time", None),
    ("Application System Uptime", 0.99918),
    ("Payment Processing", 0.9903),
    ("Authorization Availability Linked", 1.0),
)

# Correspondence and opt-outs.
SUPPORT_EMAIL = "customer support email"
MARKETING_EMAIL = "marketing email"
EVENT_EMAIL_SEND = "users.messages.email.Send"
EVENT_EMAIL_UNSUBSCRIBE = "USERS.MESSAGES.EMAIL.UNSUBSCRIBE"
SUBSCRIPTION_UNSUBSCRIBED = "UNSUBSCRIBED"

# Transactions.
TYPE_CREDIT_RETURN = "CREDIT_RETURN"
TYPE_DISPUTE = "DISPUTE"
TYPE_AUTH = "AUTH"
REFUND_MERCHANT = "Credit balance refunded"
STATUS_CONFIRMED = "CONFIRMED"
OPEN_END = "9999-12-31 00:00:00"

# Ageing buckets: label, first day, last day (None = no upper end).
BUCKET_CURRENT = "A. current"
AGEING_BUCKETS = (
    ("B. 1-29", 1, 29),
    ("C. 30-59", 30, 59),
    ("D. 60-89", 60, 89),
    ("E. 90-119", 90, 119),
    ("F. 120-149", 120, 149),
    ("G. 150-179", 150, 179),
    ("H. 180+", 180, None),
)
BUCKET_ERROR = "error"
LINE_CHARGE_OFF = "charge off"
LINE_DISPUTES = "disputes"
LINE_FRAUD = "fraud"

# Fraud signals.
CARD_CANCELED = "CANCELED"
CANCEL_REASONS_FRAUD = ("STOLEN", "FRAUD", "LOST")
REJECTIONS_BY_FRAUD_RULES = ("blocked_by_feedzai_rules", "blocked_by_sardine_rules")
DISPUTE_FRAUDULENT = "FRAUDULENT"
REASON_UNAUTHORIZED_PATTERN = "%UNAUTHORIZED%"
STAGE_RESOLUTION = "Resolution"
RESOLVED_FOR_BORROWER = "Borrower favor"
STATUS_CODES_FRAUD = ("THIRD_PARTY_FRAUD", "ID_THEFT", "FIRST_PARTY_FRAUD")
FRAUD_LINE_STATUSES = ("CONFIRMED", "PENDING", "CANCELLED")

# SMS flow: the flow, its first day, and the flow steps a reply can leave from.
SMS_FLOW_ID = "FWb8dc994e196fb45768d303a02db132e1"
SMS_SINCE = "2024-10-01"
SMS_STATUS_ENDED = "ended"
SMS_STEPS_ALLOW = (
    "sardine_AllowListTransaction",
    "es_Sardine_AllowListTransaction",
    "allowListTransaction",
    "es_allowListTransaction",
)
SMS_STEPS_LOCK_BY_RULE = ("lockCardSardine", "es_lockCardSardine")
SMS_STEPS_LOCK = ("lockCard", "es_lockCard")
SMS_STEPS_CONFIRMED_FRAUD = ("confirmedFraud", "es_confirmedFraud")
SMS_STEPS_UNRECOGNIZED = ("unrecognizedReply", "es_unrecognizedReply")

"""Names, codes and labels that readers and writers of the data share."""

# --- fixed values: record markers -------------------------------------------
TYPE_STARTUP = "startup"
EVENT_COUPON = "coupon"
EVENT_CLICK_ITEM = "clickItem"
ENTRY_ROW_DATA = "ROWDATA"
PHONE_MASK = "*******"

# --- fixed values: topics (a deployment may put its own prefix in front) -----
TOPIC_START = "start"
TOPIC_EVENT = "event"
TOPIC_ORDER = "order"
TOPIC_ORDER_DETAIL = "order_detail"
TOPIC_USER_INFO = "user_info"

# --- fixed values: which table changes are forwarded, and where to -----------
CHANGE_ROUTES = {
    ("INSERT", "order_info"): TOPIC_ORDER,
    ("INSERT", "order_detail"): TOPIC_ORDER_DETAIL,
    ("INSERT", "user_info"): TOPIC_USER_INFO,
    ("UPDATE", "user_info"): TOPIC_USER_INFO,
}

# --- fixed values: columns of the two serving tables, by record field --------
DAU_COLUMNS = {
    "mid": "MID", "uid": "UID", "appid": "APP_ID", "area": "AREA", "os": "OS",
    "ch": "CH", "log_type": "LOG_TYPE", "vs": "VS", "log_date": "LOG_DATE",
    "log_hour": "LOG_HOUR", "ts": "TS",
}
ORDER_COLUMNS = {
    "id": "ID", "province_id": "PROVINCE_ID", "consignee": "CONSIGNEE",
    "order_comment": "ORDER_COMMENT", "consignee_tel": "CONSIGNEE_TEL",
    "order_status": "ORDER_STATUS", "payment_way": "PAYMENT_WAY",
    "user_id": "USER_ID", "img_url": "IMG_URL", "total_amount": "TOTAL_AMOUNT",
    "expire_time": "EXPIRE_TIME", "delivery_address": "DELIVERY_ADDRESS",
    "create_time": "CREATE_TIME", "operate_time": "OPERATE_TIME",
    "tracking_no": "TRACKING_NO", "parent_order_id": "PARENT_ORDER_ID",
    "out_trade_no": "OUT_TRADE_NO", "trade_body": "TRADE_BODY",
    "create_date": "CREATE_DATE", "create_hour": "CREATE_HOUR",
}

# --- fixed values: metric ids and the labels of the query results ------------
METRIC_DAU = "dau"
METRIC_ORDER_AMOUNT = "order_amount"
METRIC_NAMES = {METRIC_DAU: "新增日活", METRIC_ORDER_AMOUNT: "新增交易额"}

GENDER_TITLE = "性别占比"
GENDER_LABELS = {"M": "男", "F": "女"}
AGE_TITLE = "年龄段占比"
AGE_UNDER_20 = "20岁以下"
AGE_20_TO_30 = "20岁到30岁"
AGE_OVER_30 = "30岁以上"

# --- fixed values: limits and periods ----------------------------------------
TRIGGER_INTERVAL = "5 seconds"
ALERT_WINDOW = "5 minutes"
ALERT_SLIDE = "5 seconds"
ALERT_MIN_ACCOUNTS = 3
JOIN_WAIT = "1 hour"
GENDER_FACET_SIZE = 2
AGE_FACET_SIZE = 100
REGION_BAND_WIDTH = 100
REGION_BAND_TOP = 600

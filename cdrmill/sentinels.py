"""Fixed values of the data model: what stands in for a missing value, and where.

These literals appear in the outputs and in the tests on them, so they are
stated once, here.
"""

MISSING_ID = "-99"
NOT_QUALIFIED = "NQ"
UNKNOWN = "UNKNOWN"
BLANK = ""
ZERO = "0"

# Location flags: where a location came from.
FLAG_DIRECT = "0"
FLAG_MTD = "1"
FLAG_MM = "2"
FLAG_NONE = "-1"

# Packed "flag#id" written when a payment's location stays unresolved. The
# trailing blank is part of the fixed value.
PACKED_UNRESOLVED = "-1#-99 "

OPEN_ENDED_EXPIRY = "2999-12-31 23:59:59"
NO_OLD_EXPIRY = "00000000000000"
NO_CASE = "U"

# Network indicator codes.
CODES_ECI = ("129", "130")
CODES_CGI = ("128", "131")

BRAND = "byU"
SITE = "JKT"
PRE_POST = "1"

EVENT_TIME_FORMAT = "yyyyMMddHHmmss"

# Value each column must not have for a record to count as complete.
LOCATION_SENTINELS = {
    "lacci_id": MISSING_ID,
    "lacci_closing_flag": FLAG_NONE,
    "lac": NOT_QUALIFIED,
    "ci": NOT_QUALIFIED,
    "node_type": NOT_QUALIFIED,
    "area_sales": NOT_QUALIFIED,
    "region_sales": NOT_QUALIFIED,
    "branch": NOT_QUALIFIED,
    "subbranch": NOT_QUALIFIED,
    "cluster_sales": NOT_QUALIFIED,
    "provinsi": NOT_QUALIFIED,
    "kabupaten": NOT_QUALIFIED,
    "kecamatan": NOT_QUALIFIED,
    "kelurahan": NOT_QUALIFIED,
}
SUBSCRIBER_SENTINELS = {"subs_id": MISSING_ID, "cust_type_desc": MISSING_ID}
PRODUCT_SENTINELS = {c: NOT_QUALIFIED for c in ("l4_name", "l3_name", "l2_name", "l1_name")}

RECHARGE_SENTINELS = {**SUBSCRIBER_SENTINELS, **LOCATION_SENTINELS}
# A usage record needs its taxonomy as well.
USAGE_SENTINELS = {**RECHARGE_SENTINELS, **PRODUCT_SENTINELS}

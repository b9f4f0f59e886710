"""Log layout, identity specs, tag codes and funnel measure names.

Everything in the "fixed values" blocks must stay exactly as written: it is
the data contract of the ad-request log format and of the tag vocabulary that
downstream profile consumers rely on.
"""

from __future__ import annotations

from pyspark.sql import types as T

# --- fixed values: the 85 fields of one log line, in line order ----------------
LOG_FIELDS: list[tuple[str, str]] = [
    ("sessionid", "string"), ("advertisersid", "int"), ("adorderid", "int"),
    ("adcreativeid", "int"), ("adplatformproviderid", "int"), ("sdkversion", "string"),
    ("adplatformkey", "string"), ("putinmodeltype", "int"), ("requestmode", "int"),
    ("adprice", "double"), ("adppprice", "double"), ("requestdate", "string"),
    ("ip", "string"), ("appid", "string"), ("appname", "string"),
    ("uuid", "string"), ("device", "string"), ("client", "int"),
    ("osversion", "string"), ("density", "string"), ("pw", "int"),
    ("ph", "int"), ("long", "string"), ("lat", "string"),
    ("provincename", "string"), ("cityname", "string"), ("ispid", "int"),
    ("ispname", "string"), ("networkmannerid", "int"), ("networkmannername", "string"),
    ("iseffective", "int"), ("isbilling", "int"), ("adspacetype", "int"),
    ("adspacetypename", "string"), ("devicetype", "int"), ("processnode", "int"),
    ("apptype", "int"), ("district", "string"), ("paymode", "int"),
    ("isbid", "int"), ("bidprice", "double"), ("winprice", "double"),
    ("iswin", "int"), ("cur", "string"), ("rate", "double"),
    ("cnywinprice", "double"), ("imei", "string"), ("mac", "string"),
    ("idfa", "string"), ("openudid", "string"), ("androidid", "string"),
    ("rtbprovince", "string"), ("rtbcity", "string"), ("rtbdistrict", "string"),
    ("rtbstreet", "string"), ("storeurl", "string"), ("realip", "string"),
    ("isqualityapp", "int"), ("bidfloor", "double"), ("aw", "int"),
    ("ah", "int"), ("imeimd5", "string"), ("macmd5", "string"),
    ("idfamd5", "string"), ("openudidmd5", "string"), ("androididmd5", "string"),
    ("imeisha1", "string"), ("macsha1", "string"), ("idfasha1", "string"),
    ("openudidsha1", "string"), ("androididsha1", "string"), ("uuidunknow", "string"),
    ("userid", "string"), ("iptype", "int"), ("initbidprice", "double"),
    ("adpayment", "double"), ("agentrate", "double"), ("lomarkrate", "double"),
    ("adxrate", "double"), ("title", "string"), ("keywords", "string"),
    ("tagid", "string"), ("callbackdate", "string"), ("channelid", "string"),
    ("mediatype", "int"),
]
# -------------------------------------------------------------------------------

_TYPES = {"string": T.StringType(), "int": T.IntegerType(), "double": T.DoubleType()}

LOG_SCHEMA = T.StructType(
    [T.StructField(name, _TYPES[kind], True) for name, kind in LOG_FIELDS]
)
LOG_COLUMNS = [name for name, _ in LOG_FIELDS]
LOG_TYPES = dict(LOG_FIELDS)

# --- fixed values: device id columns and their prefixes ------------------------
# "first id" of a row: first non-blank column in this order, prefix glued on.
FIRST_ID_SPEC: list[tuple[str, str]] = [
    ("imei", "IM"), ("mac", "MC"), ("idfa", "ID"), ("openudid", "OD"),
    ("androidid", "AOD"), ("imeimd5", "MD5IM"), ("macmd5", "MD5MC"),
    ("openudidmd5", "MD5OD"), ("androididmd5", "MD5AOD"), ("idfamd5", "MD5ID"),
    ("imeisha1", "SHIM"), ("macsha1", "SHMC"), ("idfasha1", "SHID"),
    ("openudidsha1", "SHOD"), ("androididsha1", "SHAOD"),
]
# "all ids" of a row: every non-blank column in this order, prefix + ":".
ALL_ID_SPEC: list[tuple[str, str]] = [
    ("imei", "IM:"), ("mac", "MC:"), ("idfa", "ID:"), ("openudid", "OD:"),
    ("androidid", "AOD:"), ("imeimd5", "IMM:"), ("macmd5", "MCM:"),
    ("idfamd5", "IDM:"), ("openudidmd5", "ODM:"), ("androididmd5", "AODM:"),
    ("imeisha1", "IMS:"), ("macsha1", "MCS:"), ("idfasha1", "IDS:"),
    ("openudidsha1", "ODS:"), ("androididsha1", "AODS:"),
]
# -------------------------------------------------------------------------------

ID_COLUMNS = [c for c, _ in FIRST_ID_SPEC]

# --- fixed values: tag vocabulary ----------------------------------------------
TAG_AD_SLOT = "LC"          # + slot type; one-digit types get a leading zero
TAG_AD_SLOT_NAME = "LN"
TAG_CHANNEL = "CN"
TAG_APP = "APP"
TAG_KEYWORD = "K"
TAG_PROVINCE = "ZP"
TAG_CITY = "ZC"
OS_CODES = {1: "D00010001", 2: "D00010002", 3: "D00010003"}
OS_OTHER = "D00010004"
NETWORK_CODES = {"WIFI": "D00020001", "4G": "D00020002", "3G": "D00020003", "2G": "D00020004"}
NETWORK_OTHER = "D00020005"
CARRIER_CODES = {"移动": "D00030001", "联通": "D00030002", "电信": "D00030003"}
CARRIER_OTHER = "D00030004"
KEYWORD_MIN_LEN = 3
KEYWORD_MAX_LEN = 8
UNKNOWN_APP = "unknow"
# Business-area box (inclusive): lng 73.66..135.05, lat 3.86..53.55
BUSINESS_BBOX = (73.66, 135.05, 3.86, 53.55)
# Coarse box used together with the id predicate: lng 73..136, lat 3..54
COARSE_BBOX = (73.0, 136.0, 3.0, 54.0)
GEOHASH_BASE32 = "0123456789bcdefghjkmnpqrstuvwxyz"
JSONP_PREFIX = "renderReverse&&renderReverse("
# -------------------------------------------------------------------------------

# Funnel measures, in report order (counts first, then the two money sums).
FUNNEL_MEASURES = [
    "ysrequest", "yxrequest", "adrequest", "cyrequest", "cybidsuccess",
    "shows", "clicks", "dspcost", "dspapy",
]
FUNNEL_COUNTS = FUNNEL_MEASURES[:7]
FUNNEL_MONEY = FUNNEL_MEASURES[7:]
# Column order of the legacy vector report text (money before shows/clicks).
FUNNEL_LEGACY_ORDER = [
    "ysrequest", "yxrequest", "adrequest", "cyrequest", "cybidsuccess",
    "dspcost", "dspapy", "shows", "clicks",
]

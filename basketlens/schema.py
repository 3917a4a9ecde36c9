"""Fixed schemas and column names of the retail tables."""

from pyspark.sql import types as T

# The transaction file layout, in file order.
_TRANSACTION_COLUMNS = """
SHOP_WEEK int, SHOP_DATE int, SHOP_WEEKDAY int, SHOP_HOUR int, QUANTITY int, SPEND float,
PROD_CODE string, PROD_CODE_10 string, PROD_CODE_20 string, PROD_CODE_30 string, PROD_CODE_40 string,
CUST_CODE string, CUST_PRICE_SENSITIVITY string, CUST_LIFESTAGE string,
BASKET_ID string, BASKET_SIZE string, BASKET_PRICE_SENSITIVITY string, BASKET_TYPE string,
BASKET_DOMINANT_MISSION string, STORE_CODE string, STORE_FORMAT string, STORE_REGION string
"""
_CALENDAR_COLUMNS = "SHOP_WEEK int, DATE_FROM int, DATE_TO int"
_TYPES = {"int": T.IntegerType(), "float": T.FloatType(), "string": T.StringType()}


def _schema(columns: str) -> T.StructType:
    """A schema from 'name type' pairs, usable before a session exists."""
    pairs = (column.split() for column in columns.split(","))
    return T.StructType([T.StructField(name, _TYPES[kind], True) for name, kind in pairs])


TRANSACTIONS = _schema(_TRANSACTION_COLUMNS)
CALENDAR = _schema(_CALENDAR_COLUMNS)

CUSTOMER = "CUST_CODE"
PRODUCT = "PROD_CODE"
BASKET = "BASKET_ID"
SEGMENT = "CLUSTER_NUM"

# Fixed values, the shopping habits: columns that describe a basket, so a customer has one value per basket.
HABITS = (
    "BASKET_TYPE",
    "BASKET_SIZE",
    "BASKET_DOMINANT_MISSION",
    "STORE_CODE",
    "STORE_FORMAT",
    "STORE_REGION",
    "SHOP_WEEKDAY",
    "SHOP_HOUR",
)

HABIT_PREFIX = "DOM_CUST_"

# Fixed values, the nine variables of the standard segment report.
REPORT_VARIABLES = (
    "DOM_CUST_BASKET_DOMINANT_MISSION",
    "DOM_CUST_BASKET_SIZE",
    "DOM_CUST_BASKET_TYPE",
    "DOM_CUST_STORE_FORMAT",
    "CUST_PRICE_SENSITIVITY",
    "DOM_CUST_SHOP_WEEKDAY",
    "DOM_CUST_SHOP_HOUR",
    "PROD_CODE_40",
    "PROD_CODE_30",
)

"""Fixed record schemas of the reference's log formats (headerless CSV)."""

from pyspark.sql import types as T

CORRUPT = "_corrupt"


def _s(*fields):
    return T.StructType([T.StructField(n, t, True) for n, t in fields])


USER_BEHAVIOR = _s(("user_id", T.LongType()), ("item_id", T.LongType()), ("category_id", T.IntegerType()),
                   ("behavior", T.StringType()), ("ts_s", T.LongType()))
LOGIN = _s(("user_id", T.LongType()), ("ip", T.StringType()), ("event_type", T.StringType()),
           ("ts_s", T.LongType()))
POINTS = _s(("user_id", T.LongType()), ("points", T.IntegerType()), ("event_type", T.StringType()),
            ("ts_s", T.LongType()))
ORDER = _s(("order_id", T.LongType()), ("event_type", T.StringType()), ("tx_id", T.StringType()),
           ("ts_s", T.LongType()))
RECEIPT = _s(("tx_id", T.StringType()), ("pay_channel", T.StringType()), ("ts_s", T.LongType()))
AD_CLICK = _s(("user_id", T.LongType()), ("ad_id", T.LongType()), ("province", T.StringType()),
              ("city", T.StringType()), ("ts_s", T.LongType()))
# Marketing events carry epoch milliseconds.
MARKETING = _s(("user_id", T.StringType()), ("behavior", T.StringType()), ("channel", T.StringType()),
               ("ts_ms", T.LongType()))

LOG_SCHEMAS = {
    "user_behavior": USER_BEHAVIOR, "login": LOGIN, "points": POINTS, "order": ORDER,
    "receipt": RECEIPT, "ad_click": AD_CLICK, "marketing": MARKETING,
}

"""Text building for reports and alerts."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# The exact strings printed by the reference jobs.
REPORT_HEADER = "时间: "                      # followed by the window end text and "\n"
ITEM_LINE_PREFIX = "no"                       # "no<i>: 商品ID=<item>浏览量=<count>\n"
ITEM_ID_LABEL = "商品ID="
ITEM_COUNT_LABEL = "浏览量="
URL_LINE_PREFIX = "NO"                        # "NO<i>: URL=<url> count=<count>\n"
URL_LABEL = " URL="
URL_COUNT_LABEL = " count="
URL_REPORT_TRAILER = "+" * 36
LOGIN_FAIL_MESSAGE = "连续登陆失败两次"         # appended to the user id
ORDER_PAID_MESSAGE = "payed successfully"
ORDER_TIMEOUT_MESSAGE = "timeout"


def _s(c: Column) -> Column:
    return c.cast("string")


def item_report_line(rank: Column, key: Column, count: Column) -> Column:
    return F.concat(F.lit(ITEM_LINE_PREFIX), _s(rank), F.lit(": "), F.lit(ITEM_ID_LABEL),
                    _s(key), F.lit(ITEM_COUNT_LABEL), _s(count), F.lit("\n"))


def url_report_line(rank: Column, key: Column, count: Column) -> Column:
    return F.concat(F.lit(URL_LINE_PREFIX), _s(rank), F.lit(":"), F.lit(URL_LABEL),
                    _s(key), F.lit(URL_COUNT_LABEL), _s(count), F.lit("\n"))


def login_fail_message(user_id: Column) -> Column:
    return F.concat(_s(user_id), F.lit(LOGIN_FAIL_MESSAGE))

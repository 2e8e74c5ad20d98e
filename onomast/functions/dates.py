"""Dates: historical years, partial and negative dates stay text."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column
from pyspark.sql import functions as F

from .text import folded

# Month names as they appear in folded labels, January first.
MONTHS = "janvier fevrier mars avril mai juin juillet aout septembre octobre novembre decembre".split()
_TIME = r"^([+-]?)0*(\d+)-(\d\d)-(\d\d)"


def format_time(c: Column) -> Column:
    """F21. A knowledge-base time as [-]Y[-MM[-DD]]; month or day 00 is left out."""
    sign, year, month, day = (F.regexp_extract(c, _TIME, i) for i in range(1, 5))
    head = F.concat(F.when(sign == "-", "-").otherwise(""), year)
    return F.when(year == "", None).when(month == "00", head).when(day == "00", F.concat_ws("-", head, month)).otherwise(F.concat_ws("-", head, month, day))


def time_year(c: Column) -> Column:
    """F22, F23. The signed year of a knowledge-base time."""
    sign, year = F.regexp_extract(c, _TIME, 1), F.regexp_extract(c, _TIME, 2)
    return F.when(year != "", F.concat(F.when(sign == "-", "-").otherwise(""), year).cast("int"))


def pad_year(c: Column) -> Column:
    """F24. The year padded to four digits or more, sign and rest kept; null if there is no year."""
    sign, year, rest = (F.regexp_extract(c, r"^(-?)(\d+)(.*)$", i) for i in range(1, 4))
    return F.when(year != "", F.concat(sign, F.lpad(year, F.greatest(F.lit(4), F.length(year)), F.lit("0")), rest))


def label_year(c: Column) -> Column:
    """F25. The first year from 1400 to 1799 that stands alone in a label; null if none."""
    y = F.regexp_extract(folded(c), r"\b(1[4-7][0-9]{2})\b", 1)
    return F.when(y != "", y)


def label_month(c: Column) -> Column:
    """F25. The number of the first month, in calendar order, whose name the label holds anywhere; null if none."""
    x = folded(c)
    return reduce(lambda acc, im: F.when(x.contains(im[1]), im[0]).otherwise(acc), reversed(list(enumerate(MONTHS, 1))), F.lit(None).cast("int"))


def date_attribute(c: Column) -> Column:
    """F26. YYYY or YYYY-MM of a label; null without a year."""
    year, month = label_year(c), label_month(c)
    return F.when(year.isNotNull(), F.concat_ws("-", year, F.lpad(month.cast("string"), 2, "0")))

"""Buddhist-era and Gregorian dates: BE = CE + 543, Thai digits, Thai months, partial dates."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# Fixed values.
ERA_GAP = 543
FIRST_BE_YEAR = 2400  # an unmarked year from here on is Buddhist era
THAI_DIGITS = "๐๑๒๓๔๕๖๗๘๙"
MONTHS = ("มกราคม", "กุมภาพันธ์", "มีนาคม", "เมษายน", "พฤษภาคม", "มิถุนายน", "กรกฎาคม", "สิงหาคม", "กันยายน", "ตุลาคม",
          "พฤศจิกายน", "ธันวาคม")
SHORT_MONTHS = ("ม.ค.", "ก.พ.", "มี.ค.", "เม.ย.", "พ.ค.", "มิ.ย.", "ก.ค.", "ส.ค.", "ก.ย.", "ต.ค.", "พ.ย.", "ธ.ค.")
BE_MARK = r"พ\.ศ\.|พุทธศักราช"
CE_MARK = r"ค\.ศ\.|คริสต์ศักราช"
YEAR = r"(?:^|[^0-9])([0-9]{4})(?:[^0-9]|$)"


def arabic_digits(text: Column) -> Column:
    return F.translate(text, THAI_DIGITS, "0123456789")


def thai_digits(text: Column) -> Column:
    return F.translate(text, "0123456789", THAI_DIGITS)


def _number(text: Column, pattern: str) -> Column:
    return F.regexp_extract(text, pattern, 1).try_cast("int")


def parse_date(text: Column) -> Column:
    """Struct ``ce_date, precision`` (``day``, ``month``, ``year``); null where the text does not settle the date.

    A written era wins over the size of the year. Two-digit years, both eras at once and dates
    that do not exist give null rather than a guess.
    """
    s = F.trim(arabic_digits(text))
    year = _number(s, YEAR)
    marked_be, marked_ce = F.regexp_like(s, F.lit(BE_MARK)), F.regexp_like(s, F.lit(CE_MARK))
    be = marked_be | (~marked_ce & (year >= FIRST_BE_YEAR))
    ce_year = F.when(marked_be & marked_ce, None).when(be, year - ERA_GAP).otherwise(year)
    named = F.lit(None).cast("int")
    for i in range(12, 0, -1):
        named = F.when(F.contains(s, F.lit(MONTHS[i - 1])) | F.contains(s, F.lit(SHORT_MONTHS[i - 1])), i).otherwise(named)
    month = F.coalesce(named, _number(s, r"^[0-9]{4}-([0-9]{1,2})(?:-|$)"), _number(s, r"^[0-9]{1,2}/([0-9]{1,2})/[0-9]{4}$"))
    day = F.coalesce(_number(s, r"^[0-9]{4}-[0-9]{1,2}-([0-9]{1,2})$"), _number(s, r"^([0-9]{1,2})/[0-9]{1,2}/[0-9]{4}$"),
                     F.when(named.isNotNull(), _number(s, r"(?:^|[^0-9])([0-9]{1,2}) ?[^0-9 ]")))
    precision = F.when(month.isNull(), "year").when(day.isNull(), "month").otherwise("day")
    iso = F.format_string("%04d-%02d-%02d", ce_year, F.coalesce(month, F.lit(1)), F.coalesce(day, F.lit(1)))
    date = F.when(ce_year.isNotNull(), F.try_to_date(iso, "yyyy-MM-dd"))
    return F.struct(date.alias("ce_date"), F.when(date.isNotNull(), precision).alias("precision"))


def format_be(date: Column, precision: Column) -> Column:
    """Thai text of a date in the Buddhist era, with Thai digits."""
    month = F.element_at(F.array(*[F.lit(m) for m in MONTHS]), F.month(date))
    year = (F.year(date) + ERA_GAP).cast("string")
    text = (F.when(precision == "day", F.concat_ws(" ", F.dayofmonth(date).cast("string"), month, year))
            .when(precision == "month", F.concat_ws(" ", month, year)).otherwise(F.concat(F.lit("พ.ศ. "), year)))
    return thai_digits(text)

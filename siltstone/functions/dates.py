"""Date expressions and the fixed time values of the warehouse layers."""

from __future__ import annotations

from datetime import date, datetime

from pyspark.sql import Column
from pyspark.sql import functions as F

# Open ends of a version, and the mark of a table never loaded.
OPEN_START = "1900-01-01 00:00:00"
OPEN_END = "2199-01-01 00:00:00"
CHANGE_FLOOR = "1900-01-01 00:00:00"

# Month and weekday names by locale, January and Monday first.
MONTH_NAMES = {
    "ru": ["Январь", "Февраль", "Март", "Апрель", "Май", "Июнь", "Июль", "Август", "Сентябрь", "Октябрь",
           "Ноябрь", "Декабрь"],
    "en": ["January", "February", "March", "April", "May", "June", "July", "August", "September", "October",
           "November", "December"],
}
DAY_NAMES = {
    "ru": ["Понедельник", "Вторник", "Среда", "Четверг", "Пятница", "Суббота", "Воскресенье"],
    "en": ["Monday", "Tuesday", "Wednesday", "Thursday", "Friday", "Saturday", "Sunday"],
}


def timestamp(value: str | date | datetime) -> Column:
    """A zone-free timestamp literal, whatever the session's timestamp type."""
    return F.lit(str(value)).cast("timestamp_ntz")


def date_key(day: Column) -> Column:
    """yyyymmdd as an integer, by arithmetic (no text formatting)."""
    return (F.year(day) * 10000 + F.month(day) * 100 + F.dayofmonth(day)).cast("int")


def iso_weekday(day: Column) -> Column:
    return (F.weekday(day) + 1).cast("int")


def month_name(day: Column, locale: str = "ru", names: list[str] | None = None) -> Column:
    """Localised month name; `names` replaces the built-in list."""
    return F.element_at(F.array(*[F.lit(n) for n in names or MONTH_NAMES[locale]]), F.month(day))


def day_name(day: Column, locale: str = "ru", names: list[str] | None = None) -> Column:
    return F.element_at(F.array(*[F.lit(n) for n in names or DAY_NAMES[locale]]), iso_weekday(day))

"""Cleaning, coercion and text columns."""

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

ColumnLike = Column | str


def as_col(c: ColumnLike) -> Column:
    return F.col(c) if isinstance(c, str) else c


def trim_headers(df: DataFrame) -> DataFrame:
    """Strip blanks around column names, as lenient CSV input needs."""
    return df.toDF(*[name.strip() for name in df.columns])


def lenient_id(c: ColumnLike, dtype: str = "int") -> Column:
    """Text to nullable integer: ``'3.0'`` is 3, ``'abc'`` and ``'3.5'`` are null."""
    number = F.trim(as_col(c).cast("string")).try_cast("double")
    return F.when(number == F.floor(number), number).try_cast(dtype)


def on_rating_scale(c: ColumnLike) -> Column:
    """True for 0.5, 1.0 … 5.0; false for everything else, null included."""
    r = as_col(c).cast("double")
    return F.coalesce(r.between(0.5, 5.0) & (r * 2 == F.floor(r * 2)), F.lit(False))


def genre_array(c: ColumnLike) -> Column:
    """``'Comedy|Drama'`` as an array; null or blank text is an empty array."""
    text = F.trim(as_col(c))
    parts = F.filter(F.split(text, r"\|"), lambda g: g != "")
    return F.coalesce(parts, F.array().cast("array<string>"))


def title_year(c: ColumnLike) -> Column:
    """The year in the parentheses that end a title, else null."""
    digits = F.regexp_extract(as_col(c), r"\((\d{4})\)\s*$", 1)
    return F.when(digits != "", digits.cast("int"))


def user_tag(user: ColumnLike) -> Column:
    return F.concat(F.lit("user:"), as_col(user).cast("string"))


def mode_tag(name: ColumnLike) -> Column:
    return F.concat(F.lit("mode:"), as_col(name).cast("string"))


def tag_user(tag: ColumnLike, dtype: str = "int") -> Column:
    """User id of a ``user:<id>`` tag; null for ``mode:<name>`` tags and malformed ids."""
    digits = F.regexp_extract(as_col(tag), r"^user:(-?\d+)$", 1)
    return F.when(digits != "", digits).try_cast(dtype)


def tag_mode(tag: ColumnLike) -> Column:
    """Name of a ``mode:<name>`` tag, else null."""
    name = F.regexp_extract(as_col(tag), r"^mode:(.*)$", 1)
    return F.when(as_col(tag).startswith("mode:"), name)


def epoch_seconds_now() -> Column:
    return F.unix_timestamp(F.current_timestamp())


def iso_utc(ts: ColumnLike | None = None) -> Column:
    """``2025-09-19T09:23:53Z`` whatever the session time zone."""
    moment = F.current_timestamp() if ts is None else as_col(ts)
    utc = F.to_utc_timestamp(moment, F.current_timezone())
    return F.date_format(utc, "yyyy-MM-dd'T'HH:mm:ss'Z'")


def iso_epoch(text: ColumnLike) -> Column:
    """Epoch seconds of an ISO-8601 instant; null when it does not parse."""
    return F.unix_timestamp(F.try_to_timestamp(as_col(text)))


def wall_clock_epoch(ts: ColumnLike) -> Column:
    """Epoch seconds of a zone-less timestamp read as UTC, whatever the session time zone."""
    t = as_col(ts)
    seconds = F.hour(t) * 3600 + F.minute(t) * 60 + F.floor(F.second(t))
    return F.unix_date(F.to_date(t)).cast("bigint") * 86400 + seconds


def fixed_score(c: ColumnLike, digits: int = 4) -> Column:
    """Fixed-point text of a score, such as ``0.9487``."""
    return F.format_string(f"%.{digits}f", as_col(c).cast("double"))

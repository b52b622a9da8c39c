"""Text cleaning, timestamp parsing, flags and bins."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from wardscope.schema import quoted

# The two timestamp texts found in the raw data.
TIMESTAMP_FORMATS = ("MM/dd/yyyy hh:mm:ss a", "yyyy-MM-dd HH:mm:ss")


def drop_columns(df: DataFrame, names: Sequence[str]) -> DataFrame:
    """Drop the named columns; names that do not occur are ignored."""
    return df.drop(*names)


def dedup(df: DataFrame) -> DataFrame:
    """Keep one of each set of rows that are equal in all columns."""
    return df.dropDuplicates()


def normalize_text(text: Column) -> Column:
    """Upper case without blanks at the ends."""
    return F.upper(F.trim(text))


def parse_timestamp(text: Column, formats: Sequence[str] = TIMESTAMP_FORMATS) -> Column:
    """Value of the first format that fits, null when none does."""
    return F.coalesce(*(F.try_to_timestamp(text, F.lit(pattern)) for pattern in formats))


def with_timestamp(df: DataFrame, source: str, target: str, formats: Sequence[str] = TIMESTAMP_FORMATS) -> DataFrame:
    """Add the parsed timestamp and drop the rows whose text fits no format."""
    if isinstance(df.schema[source].dataType, T.StringType):
        parsed = parse_timestamp(quoted(source), formats)
    else:
        parsed = quoted(source)
    return df.withColumn(target, parsed).filter(F.col(target).isNotNull())


def flag_text(df: DataFrame, source: str) -> Column:
    """Text in upper case in which TRUE is written 1 and FALSE 0."""
    text = normalize_text(quoted(source).cast("string"))
    return F.regexp_replace(F.regexp_replace(text, "TRUE", "1"), "FALSE", "0")


def bool_flag(df: DataFrame, source: str) -> Column:
    """1 or 0 for TRUE or FALSE text (or a boolean), null for other text, 0 when the column is absent."""
    return flag_text(df, source).try_cast("int") if source in df.columns else F.lit(0)


def composite_key(separator: str, *parts: Column) -> Column:
    """Parts joined by a separator; null parts are left out."""
    return F.concat_ws(separator, *parts)


def geo_bin(df: DataFrame, lat: str = "Latitude", lng: str = "Longitude", digits: int = 2,
            out: tuple[str, str] = ("Lat_Bin", "Lng_Bin")) -> DataFrame:
    """Round the coordinates to a grid and drop rows without them; null bins when the columns are absent."""
    if not {lat, lng} <= set(df.columns):
        return df.withColumns({name: F.lit(None).cast("double") for name in out})
    located = df.filter(F.col(lat).isNotNull() & F.col(lng).isNotNull())
    return located.withColumns({out[0]: F.round(lat, digits), out[1]: F.round(lng, digits)})


def fill_nulls(df: DataFrame, names: Sequence[str], value: float = 0) -> DataFrame:
    """Replace null in those of the named columns that exist."""
    present = [name for name in names if name in df.columns]
    return df.fillna(value, subset=present) if present else df


def to_number_or_zero(df: DataFrame, names: Sequence[str]) -> DataFrame:
    """Numbers as double; whatever is no number becomes 0."""
    kinds = dict(df.dtypes)

    def number(name: str) -> Column:
        column = quoted(name)
        if kinds[name] in ("date", "timestamp", "timestamp_ntz"):
            return F.lit(0.0)
        value = column.try_cast("double") if kinds[name] == "string" else column.cast("double")
        return F.coalesce(F.nanvl(value, F.lit(0.0)), F.lit(0.0))

    return df.withColumns({name: number(name) for name in names})

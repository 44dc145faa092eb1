"""Names derived from destinations, hosts, servers and schedules."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from covenant.functions.text import (
    base_name,
    bind,
    blank_to_null,
    directory_part,
    extension,
    file_part,
    is_blank,
    trim_all,
    without_extension,
)

# Fallbacks and limits of feed definitions.
DEFAULT_SERVER = "Producer"
DEFAULT_SCHEDULE_TYPE = "interval"
DEFAULT_SCHEDULE = "PT1H"
DEFAULT_PRODUCT_KEY = "default"

# An ISO-8601 duration of days, hours, minutes and seconds.
_DURATION = (
    r"(?i)^[-+]?P(?=.)(?:[-+]?\d+D)?(?:T(?=.)(?:[-+]?\d+H)?(?:[-+]?\d+M)?(?:[-+]?\d+(?:[.,]\d{0,9})?S)?)?$"
)


def _cron_field(value: str) -> str:
    item = rf"(?:\*|\?|{value}(?:-{value})?)(?:/\d+)?"
    return rf"{item}(?:,{item})*"


# Five cron fields (minute, hour, day, month, weekday), optionally led by seconds.
_SIXTY = _cron_field("[0-5]?[0-9]")
_HOUR = _cron_field("(?:[01]?[0-9]|2[0-3])")
_DAY = rf"(?:L|{_cron_field('(?:0?[1-9]|[12][0-9]|3[01])')})"
_MONTH = _cron_field("(?:0?[1-9]|1[0-2]|JAN|FEB|MAR|APR|MAY|JUN|JUL|AUG|SEP|OCT|NOV|DEC)")
_WEEKDAY = _cron_field("(?:[0-7]|SUN|MON|TUE|WED|THU|FRI|SAT)L?")
_CRON = rf"(?i)^\s*(?:{_SIXTY}\s+)?{_SIXTY}\s+{_HOUR}\s+{_DAY}\s+{_MONTH}\s+{_WEEKDAY}\s*$"


def destination_metadata(path: Column) -> Column:
    """``schema-org-product[-more][.ext]`` as ``struct(schema, org, product)``, or null when a part is missing."""

    def from_parts(parts: Column) -> Column:
        part = [trim_all(blank_to_null(F.get(parts, F.lit(i)))) for i in range(3)]
        complete = part[0].isNotNull() & part[1].isNotNull() & part[2].isNotNull()
        return F.when(complete, F.struct(part[0].alias("schema"), part[1].alias("org"), part[2].alias("product")))

    return bind(F.split(without_extension(file_part(path)), "-"), from_parts)


def _convention_name(metadata: Column) -> Column:
    return F.concat_ws("-", metadata["schema"], metadata["org"], metadata["product"])


def _with_version(name: Column, version: Column) -> Column:
    return F.concat(without_extension(name), F.lit("-v"), version.cast("string"), extension(name))


def unversioned_destination(destination: Column, source_name: Column) -> Column:
    """Where a lone file lands: the destination with extra name parts dropped, or the source's own name."""
    where = trim_all(destination)
    name = file_part(where)
    metadata = destination_metadata(name)
    return (
        F.when(is_blank(destination), base_name(source_name))
        .when(where.endswith("/"), F.concat(where, base_name(source_name)))
        .when(metadata.isNotNull(), F.concat(directory_part(where), _convention_name(metadata), extension(name)))
        .otherwise(where)
    )


def versioned_destination(destination: Column, source_name: Column, version: Column) -> Column:
    """As :func:`unversioned_destination`, with ``-vN`` before the extension."""
    where = trim_all(destination)
    name = file_part(where)
    metadata = destination_metadata(name)
    named = F.when(metadata.isNotNull(), F.concat(_convention_name(metadata), extension(name))).otherwise(name)
    tagged = F.concat(F.lit("-v"), version.cast("string"))
    by_convention = F.concat(directory_part(where), _convention_name(metadata), tagged, extension(name))
    return (
        F.when(is_blank(destination), _with_version(base_name(source_name), version))
        .when(where.endswith("/"), F.concat(where, _with_version(base_name(source_name), version)))
        .when(metadata.isNotNull(), by_convention)
        .otherwise(F.concat(directory_part(where), _with_version(named, version)))
    )


def product_key(destination: Column) -> Column:
    """Key of the version counter a destination shares."""
    name = file_part(F.regexp_replace(trim_all(destination), "/$", ""))
    metadata = destination_metadata(name)
    return (
        F.when(is_blank(destination), DEFAULT_PRODUCT_KEY)
        .when(metadata.isNotNull(), _convention_name(metadata))
        .otherwise(without_extension(name))
    )


def storage_key(destination: Column, source_name: Column) -> Column:
    """Object key of a landed file: no leading slash; a directory destination takes the source's own name."""
    where = trim_all(destination)
    name = file_part(source_name)
    return (
        F.when(is_blank(destination), name)
        .when(where.endswith("/"), F.concat(F.regexp_replace(where, "^/", ""), name))
        .otherwise(F.regexp_replace(where, "^/+", ""))
    )


def local_target(destination: Column, root: str) -> Column:
    """Local path of a destination: absolute as given, relative below ``root``; dot steps are resolved."""
    path = F.when(destination.startswith("/"), destination).otherwise(
        F.concat(F.lit(root.rstrip("/") + "/"), destination)
    )

    def climb(done: Column, step: Column) -> Column:
        return (
            F.when(step.isin("", "."), done)
            .when(step == "..", F.slice(done, F.lit(1), F.greatest(F.size(done) - 1, F.lit(0))))
            .otherwise(F.concat(done, F.array(step)))
        )

    steps = F.aggregate(F.split(path, "/"), F.array().cast("array<string>"), climb)
    return F.concat(F.lit("/"), F.array_join(steps, "/"))


def clean_server_name(name: Column) -> Column:
    """Letters and digits only; a name with none becomes the default."""
    letters = F.regexp_replace(name, "[^a-zA-Z0-9]", "")
    return F.coalesce(F.when(letters != "", letters), F.lit(DEFAULT_SERVER))


def clean_host(host: Column) -> Column:
    return F.regexp_replace(host, "^https?://", "")


def normalise_schedule(kind: Column, expression: Column) -> Column:
    """``struct(schedule_type, schedule_expression)``; anything missing, unknown or invalid runs every hour."""
    interval = (F.lower(kind) == "interval") & expression.rlike(_DURATION)
    cron = (F.lower(kind) == "cron") & expression.rlike(_CRON)
    valid_kind = F.when(interval, "interval").when(cron, "cron")
    return F.struct(
        F.coalesce(valid_kind, F.lit(DEFAULT_SCHEDULE_TYPE)).alias("schedule_type"),
        F.when(valid_kind.isNotNull(), expression).otherwise(DEFAULT_SCHEDULE).alias("schedule_expression"),
    )

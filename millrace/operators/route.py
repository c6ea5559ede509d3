"""Destinations: table names, custom mappers, heartbeats."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from millrace.options import Options

Mapper = Callable[[Column, Options], Column]
_MAPPERS: dict[str, Mapper] = {}


def register_mapper(name: str) -> Callable[[Mapper], Mapper]:
    """Make a Column -> Column mapper known by name; a second one of that name is an error."""

    def add(mapper: Mapper) -> Mapper:
        if name in _MAPPERS:
            raise ValueError(f"there are two mappers named {name}")
        _MAPPERS[name] = mapper
        return mapper

    return add


@register_mapper("default-mapper")
def default_mapper(destination: Column, options: Options) -> Column:
    """prefix + the destination, rewritten by the pattern, with dots as underscores; then the case."""
    name = destination
    if options.destination_regexp:
        name = F.regexp_replace(name, options.destination_regexp, options.destination_regexp_replace)
    name = F.concat(F.lit(options.table_prefix), F.replace(name, F.lit("."), F.lit("_")))
    if options.destination_uppercase_table_names:
        return F.upper(name)
    return F.lower(name) if options.destination_lowercase_table_names else name


def table_name(destination: Column, options: Options) -> Column:
    if options.table_mapper not in _MAPPERS:
        raise ValueError(f"no table mapper named {options.table_mapper}")
    return _MAPPERS[options.table_mapper](destination, options)


def is_heartbeat(destination: Column, options: Options) -> Column:
    return destination.rlike(f"^(?:{options.heartbeat_pattern})$")


def without_heartbeats(events: DataFrame, options: Options, column: str = "destination") -> DataFrame:
    return events.where(~is_heartbeat(F.col(column), options)) if options.heartbeat_skip_consuming else events

"""The chain of named transforms that raw events pass before they are decoded."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from millrace.options import Options

Transform = Callable[[DataFrame, dict], DataFrame]
_TRANSFORMS: dict[str, Transform] = {}


def register_transform(kind: str) -> Callable[[Transform], Transform]:
    """Make a (events, config) -> events function known by its type's name; a second one of that name is an error."""

    def add(f: Transform) -> Transform:
        if kind in _TRANSFORMS:
            raise ValueError(f"there are two transforms named {kind}")
        _TRANSFORMS[kind] = f
        return f

    return add


def chain(events: DataFrame, options: Options) -> DataFrame:
    """``events`` after each transform that the options list, in that order.

    A transform's config holds its own entries, with its type; ``unwrap`` is done where
    rows are projected, as it changes their schema.
    """
    for name in options.transforms:
        config = options.transform_config.get(name, {})
        kind = config.get("type", name).rsplit(".", 1)[-1]
        if kind in ("ExtractNewRecordState", "ExtractNewDocumentState", "unwrap"):
            continue
        if kind not in _TRANSFORMS:
            raise ValueError(f"no transform named {kind}")
        events = _TRANSFORMS[kind](events, config)
    return events


@register_transform("RegexRouter")
def regex_router(events: DataFrame, config: dict) -> DataFrame:
    """Destinations that match the pattern as a whole are rewritten."""
    whole = F.col("destination").rlike(f"^(?:{config['regex']})$")
    new = F.regexp_replace("destination", f"^(?:{config['regex']})$", config["replacement"])
    return events.withColumn("destination", F.when(whole, new).otherwise(F.col("destination")))


@register_transform("Filter")
def keep_where(events: DataFrame, config: dict) -> DataFrame:
    """Events for which a SQL condition over destination, key and value holds."""
    return events.where(config["condition"])

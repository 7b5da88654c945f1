"""The data checks run after a build: unique + not_null on the model keys."""

from __future__ import annotations

from pyspark.sql import DataFrame

from ..operators.quality import assert_quality, quality_report, quality_report_written

# The checked key of each model.
MODEL_KEYS = {
    "stg_bands": "band_id",
    "stg_albums": "album_id",
    "stg_setlists": "setlist_id",
    "stg_songs": "song_id",
    "stg_band_mapping": "ma_band_id",
    "fct_concerts": "concert_id",
    "dim_bands": "ma_band_id",
    "dim_venues": "venue_id",
}


def report(models) -> DataFrame:
    """(table_name, column_name, check_name, failures) for the 16 checks.

    ``models`` is anything with the model names as attributes or keys.
    """
    get = (models.__getitem__ if isinstance(models, dict)
           else lambda name: getattr(models, name))
    return quality_report({name: (get(name), [key]) for name, key in MODEL_KEYS.items()})


def check(models, nulls: dict[str, int] | None = None) -> DataFrame:
    """Run the checks; raise if any fails (the flow stops on failure).

    ``nulls``: null keys per model, if they were counted while it was written.
    """
    if nulls is None:
        return assert_quality(report(models))
    return assert_quality(quality_report_written(
        {name: (models[name], key, nulls[name]) for name, key in MODEL_KEYS.items()}))

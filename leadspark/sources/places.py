"""Places API answers (JSON text) to candidates."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions.text import blank_to_null, province_from_address, truthy
from ..schemas import PLACES_SCHEMA


def places_candidates(answers: DataFrame, column: str = "body") -> DataFrame:
    """One candidate per named place of every OK answer; other columns are kept."""
    rest = [c for c in answers.columns if c != column]
    parsed = answers.select(*rest, F.from_json(column, PLACES_SCHEMA).alias("j")).filter("j.status = 'OK'")
    places = parsed.select(*rest, F.posexplode("j.results").alias("pos", "p")).filter(truthy("p.name"))
    return places.select(
        *rest, "pos", F.col("p.name").alias("nombre"), blank_to_null("p.website").alias("sitio_web"),
        F.lit(None).cast("string").alias("partido"),
        blank_to_null(province_from_address("p.formatted_address")).alias("provincia"),
        F.lit(None).cast("string").alias("localidad"), F.lit("google_places").alias("fuente"),
        F.create_map(
            F.lit("place_id"), F.col("p.place_id"), F.lit("address"), F.col("p.formatted_address"),
            F.lit("rating"), F.col("p.rating").cast("string"),
        ).alias("raw_data"),
    )

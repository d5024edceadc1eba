"""Numbers, arrays, dates and nested payloads as column expressions."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# Sizes of an image in order of preference.
SIZE_PREFERENCE = ("Original", "Large 2048", "Large 1600", "Large", "Medium 800", "Medium 640", "Medium")

INFO_SCHEMA = "id string, title struct<_content: string>, description struct<_content: string>, tags struct<tag: array<struct<_content: string>>>, dates struct<taken: string>"


def not_finite(vector: Column) -> Column:
    """Whether an array holds NaN or an infinity."""
    return F.exists(vector, lambda x: F.isnan(x) | (F.abs(x) == float("inf")))


def largest_is_zero(vector: Column) -> Column:
    return F.array_max(vector) == 0


def norm(vector: Column) -> Column:
    return F.sqrt(F.aggregate(vector, F.lit(0.0), lambda s, x: s + x.cast("double") * x))


def cosine(a: Column, b: Column) -> Column:
    """Null, not NaN, if a vector is zero."""
    dot = F.aggregate(F.zip_with(a, b, lambda x, y: x.cast("double") * y), F.lit(0.0), lambda s, x: s + x)
    return F.try_divide(dot, norm(a) * norm(b))


def as_vector(values: Column, dim: int) -> Column:
    """Floats of exactly this length; another length is an error."""
    wrong = F.raise_error(F.concat(F.lit(f"not {dim} components: "), F.size(values).cast("string"))).cast("array<float>")
    return F.when(values.isNull() | (F.size(values) == dim), values.cast("array<float>")).otherwise(wrong)


def timestamp(text: Column) -> Column:
    """Empty text is null; malformed text is an error."""
    return F.nullif(text, F.lit("")).cast("timestamp_ntz")


def half_even(value: Column, places: int = 2) -> Column:
    return F.bround(value, places)


def rank_of(value: Column, ranks: dict[str, int], default: int) -> Column:
    known = F.create_map(*(F.lit(x) for pair in ranks.items() for x in pair))
    return F.coalesce(F.try_element_at(known, value), F.lit(default))


def pick_preferred(sizes: Column, preference: tuple[str, ...] = SIZE_PREFERENCE) -> Column:
    """Source of the first preferred label that an array of (label, source) has, its last if repeated; else of the last entry. Empty is an error."""

    def last_of(label: str) -> Column:
        return F.try_element_at(F.filter(sizes, lambda s: s["label"] == label), F.lit(-1))["source"]

    found = [last_of(label) for label in preference]
    none = F.raise_error(F.lit("no sizes")).cast("string")
    return F.when(F.size(sizes) > 0, F.coalesce(*found, F.try_element_at(sizes, F.lit(-1))["source"])).otherwise(none)


def photo_info(payload: Column) -> Column:
    """photo_id, title, description, tags and date_taken of a metadata payload."""
    p = F.from_json(payload, INFO_SCHEMA)
    tags = F.coalesce(F.transform(p["tags"]["tag"], lambda t: t["_content"]), F.array().cast("array<string>"))
    return F.struct(p["id"].alias("photo_id"), p["title"]["_content"].alias("title"), p["description"]["_content"].alias("description"), tags.alias("tags"), timestamp(p["dates"]["taken"]).alias("date_taken"))

"""Schema adaptation, cleaning casts and hand-made listing features."""

from __future__ import annotations

import re
from collections.abc import Iterable, Mapping, Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import (ByteType, DecimalType, DoubleType, FloatType, IntegerType,
                               LongType, ShortType, StringType)

# Fixed mapping from local listing names to the global model's names (copies; originals kept).
LOCAL_TO_GLOBAL = {
    "lat": "latitude",
    "long": "longitude",
    "guests": "accommodates",
    "num_beds": "beds",
    "neighbourhood": "neighbourhood_cleansed",
    "property_number_of_reviews": "number_of_reviews",
    "num_baths": "bathrooms",
    "ratings": "review_scores_rating",
    "rating_Accuracy": "review_scores_accuracy",
    "rating_Cleanliness": "review_scores_cleanliness",
    "rating_Check-in": "review_scores_checkin",
    "rating_Communication": "review_scores_communication",
    "rating_Location": "review_scores_location",
    "rating_Value": "review_scores_value",
    "hosts_year": "host_since",
    "is_supperhost": "host_is_superhost",
    "amenities_count_raw": "amenities_count",
}

# Fixed literals for the local source's location columns.
LOCAL_LOCATION = {"country": "france", "city": "paris", "region": "ile-de-france"}

# Fixed feature lists of the global model.
GLOBAL_NUMERIC = ["amenities_count_raw", "is_supperhost", "ratings", "lat", "long", "guests",
                  "availability_365", "hosts_year", "property_number_of_reviews",
                  "rating_Accuracy", "rating_Cleanliness", "rating_Location", "rating_Value",
                  "rating_Check-in", "rating_Communication", "num_beds", "num_baths",
                  "has_dishwasher", "has_washer"]
GLOBAL_CATEGORICAL = ["country", "city", "region", "listing_type"]

# Fixed list of amenity names both sources share.
SHARED_AMENITIES = ["Baking sheet", "Bathtub", "Coffee maker", "Dining table", "Dishwasher",
                    "First aid kit", "Hair dryer", "Hangers", "Hot water", "Iron", "Microwave",
                    "Oven", "Refrigerator", "Shampoo", "Stove", "TV", "Toaster", "Washer", "Wifi"]

_NUMERIC_TYPES = (DoubleType, FloatType, IntegerType, LongType, ShortType, ByteType, DecimalType)


def missing_columns(df: DataFrame, required: Iterable[str]) -> list[str]:
    return sorted(set(required) - set(df.columns))


def require_columns(df: DataFrame, required: Iterable[str], what: str = "input") -> None:
    """Schema gate (P19): raise naming every absent column."""
    miss = missing_columns(df, required)
    if miss:
        raise ValueError(f"{what} is missing columns: {miss}")


def adapt_to_global(local: DataFrame, mapping: Mapping[str, str] = LOCAL_TO_GLOBAL,
                    literals: Mapping[str, str] = LOCAL_LOCATION) -> DataFrame:
    """Copy local columns into the global model's names (originals kept) and add the
    location literals, in one projection. An absent source column is an error (P19)."""
    require_columns(local, mapping.values(), "local table")
    cols = {dst: F.col(src) for dst, src in mapping.items()}
    cols.update({k: F.lit(v) for k, v in literals.items()})
    return local.withColumns(cols)


def clean_cast(df: DataFrame, numeric: Sequence[str] = GLOBAL_NUMERIC,
               categorical: Sequence[str] = GLOBAL_CATEGORICAL, target: str = "log_price",
               key: str = "id", select: bool = True, fill: str = "other") -> DataFrame:
    """Every numeric feature to double, categories lower-cased with nulls -> ``fill``,
    optionally projected to features + target + key. An absent feature is an error (P19)."""
    require_columns(df, [*numeric, *categorical, *([target, key] if select else [])], "feature table")
    num, cat = list(numeric), list(categorical)
    out = df.withColumns({**{c: F.col(c).try_cast("double") for c in num},
                          **{c: F.lower(F.col(c).cast("string")) for c in cat}})
    out = out.fillna(fill, subset=cat) if cat else out
    return out.select(*num, *cat, target, key) if select else out


def columns_of_type(df: DataFrame, numeric: bool = True, exclude: Sequence[str] = ()) -> list[str]:
    """Feature columns by type (P6); every numeric width counts, unlike int/double only."""
    want = _NUMERIC_TYPES if numeric else (StringType,)
    return [f.name for f in df.schema.fields
            if isinstance(f.dataType, want) and f.name not in set(exclude)]


def columns_with_prefix(df: DataFrame, prefix: str) -> list[str]:
    return [c for c in df.columns if c.startswith(prefix)]


def amenity_column(name: str) -> str:
    return "has_" + re.sub(r"[^a-z]", "", name.lower())


def amenity_features(df: DataFrame, text_col: str = "amenities",
                     names: Sequence[str] = SHARED_AMENITIES, count_col: str = "amenities_count"
                     ) -> DataFrame:
    """H1/H2: parse the JSON list once; count it and add one 0/1 column per amenity."""
    arr = F.from_json(F.col(text_col), "array<string>")
    out = df.withColumn("_am", arr)
    cols = {count_col: F.size(F.col("_am"))}
    cols.update({amenity_column(n): F.coalesce(F.array_contains("_am", n).cast("int"), F.lit(0))
                 for n in names})
    return out.withColumns(cols).drop("_am")


# Fixed column list of the gold listing table (v4).
GOLD_COLUMNS = ["id", "log_price", "latitude", "longitude", "accommodates", "beds", "bedrooms",
                "bathrooms", "number_of_reviews", "reviews_per_month", "availability_365",
                "amenities_count", "has_dishwasher", "has_washer", "host_is_superhost", "host_since",
                "review_scores_rating", "review_scores_accuracy", "review_scores_cleanliness",
                "review_scores_checkin", "review_scores_communication", "review_scores_location",
                "review_scores_value", "neighbourhood_cleansed", "listing_type",
                "host_response_time"]


def gold_select(df: DataFrame) -> DataFrame:
    """H5: the 26 gold columns, after the schema gate."""
    require_columns(df, GOLD_COLUMNS, "gold table")
    return df.select(*GOLD_COLUMNS)


def superhost_flag(col: str) -> F.Column:
    """H3: 't'/'true' -> 1.0, 'f'/'false' -> 0.0, anything else null."""
    c = F.lower(F.trim(F.col(col).cast("string")))
    return F.when(c.isin("t", "true", "1"), F.lit(1.0)).when(c.isin("f", "false", "0"), F.lit(0.0))


def host_year(col: str) -> F.Column:
    """H4: host start date -> calendar year as a number."""
    return F.year(F.to_date(F.col(col))).cast("double")

"""The location dimension: states, cleaning rules, grant-funded sites, gaps."""

from __future__ import annotations

from collections.abc import Callable, Mapping, Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from portpulse.functions.scale import settle
from portpulse.functions.text import program_label, share_a_word
from portpulse.schema import (
    ACT_LOCALITIES,
    NOT_FUNDED,
    STATE_POSTCODES,
    UNINCORPORATED_ACT,
)

EARTH_RADIUS_KM = 6371
# Parts a match group is spread over before its nearest ports are known.
_SPREAD = 32
MATCH_KEYS = ["state", "postcode", "cpo_name", "suburb"]


def state_of_postcode(postcode: Column) -> Column:
    """State whose range holds the postcode; null when none does."""
    state = F.lit(None).cast("string")
    for name, lo, hi in STATE_POSTCODES:
        state = F.when(postcode.between(lo, hi), F.lit(name)).otherwise(state)
    return state


def with_postcode_state(location: DataFrame) -> DataFrame:
    """Overwrite ``state`` with the state of the postcode."""
    postcode = F.col("postcode").cast("int")
    return location.withColumn("postcode", postcode).withColumn(
        "state", state_of_postcode(postcode)
    )


def in_required_states(location: DataFrame, required: DataFrame | Sequence[str]) -> DataFrame:
    if isinstance(required, DataFrame):
        return location.join(required.select("state"), "state", "left_semi")
    return location.where(F.col("state").isin(list(required)))


# --- per-operator cleaning -------------------------------------------------
def id_before_dash(df: DataFrame) -> dict[str, Column]:
    """``evse_id`` is the text before the first ``" - "``."""
    return {"evse_id": F.split(F.col("evse_id"), " - ")[0]}


def needs_postcode(df: DataFrame) -> Column:
    """Keep only rows with a postcode."""
    return F.col("postcode").isNotNull()


# The operator whose identifiers carry a suffix.
COLUMN_RULES: Mapping[str, Callable[[DataFrame], dict[str, Column]]] = {
    "Wevolt": id_before_dash,
}
# A row rule exists too (``needs_postcode``) but none is on by default.
ROW_RULES: Mapping[str, Callable[[DataFrame], Column]] = {}


def apply_cpo_cleaning(
    df: DataFrame,
    column_rules: Mapping[str, Callable[[DataFrame], dict[str, Column]]] = COLUMN_RULES,
    row_rules: Mapping[str, Callable[[DataFrame], Column]] = ROW_RULES,
) -> DataFrame:
    """Apply each operator's rules in one pass. Rows without an operator drop out."""
    cpo = F.col("cpo_name")
    keep = cpo.isNotNull()
    for name, rule in row_rules.items():
        keep = keep & ((cpo != name) | rule(df))
    columns: dict[str, Column] = {}
    for name, rule in column_rules.items():
        for target, value in rule(df).items():
            columns[target] = F.when(cpo == name, value).otherwise(
                columns.get(target, F.col(target))
            )
    return df.where(keep).withColumns(columns) if columns else df.where(keep)


# --- grant-funded sites ----------------------------------------------------
def first_per_key(df: DataFrame, keys: Sequence[str], order: Sequence[str]) -> DataFrame:
    """One row per key, the first in ``order``.

    A minimum over structs, so duplicates are folded before the shuffle.
    """
    rest = [c for c in df.columns if c not in [*keys, *order]]
    packed = F.min(F.struct(*order, *rest)).alias("_r")
    return df.groupBy(*keys).agg(packed).select(*keys, "_r.*").select(*df.columns)


def planar_km(lat1: Column, lon1: Column, lat2: Column, lon2: Column) -> Column:
    """Euclidean distance of coordinates in radians, in earth radii; not great-circle."""
    dlat = F.radians(lat1) - F.radians(lat2)
    dlon = F.radians(lon1) - F.radians(lon2)
    return F.sqrt(dlat * dlat + dlon * dlon) * EARTH_RADIUS_KM


def funded_candidates(
    location: DataFrame, funded: DataFrame, trim_keys: bool = False
) -> DataFrame:
    """Ports that share the match keys with a funded site, with their distance.

    A crowded match group is spread over ``_SPREAD`` parts, each of which meets a copy
    of the group's one funded site.
    """

    def key(name: str) -> Column:
        text = F.coalesce(F.col(name).cast("string"), F.lit("nan"))
        return F.trim(text) if trim_keys else text

    sites = first_per_key(
        funded.select(
            *[key(k).alias(k) for k in MATCH_KEYS],
            F.col("address").alias("_f_address"),
            F.col("lga_name").alias("_f_lga"),
            F.col("latitude").alias("_f_lat"),
            F.col("longitude").alias("_f_lon"),
            "program",
            "round",
        ),
        MATCH_KEYS,
        ["_f_address", "_f_lga", "_f_lat", "_f_lon"],
    ).withColumn("_part", F.explode(F.sequence(F.lit(0), F.lit(_SPREAD - 1))))
    ports = location.select(
        "evse_id",
        "evse_port_id",
        "address",
        "lga_name",
        "latitude",
        "longitude",
        *[key(k).alias(k) for k in MATCH_KEYS],
        F.pmod(F.xxhash64("evse_id", "evse_port_id"), F.lit(_SPREAD)).cast("int").alias("_part"),
    )
    # Settled, because the copies are not in Spark's estimate of the table's size.
    return ports.join(settle(sites), [*MATCH_KEYS, "_part"]).withColumn(
        "distance_km",
        planar_km(F.col("latitude"), F.col("longitude"), F.col("_f_lat"), F.col("_f_lon")),
    )


def match_funded_sites(
    location: DataFrame, funded: DataFrame, trim_keys: bool = False
) -> DataFrame:
    """Add ``government_funded``: the program label of the matched site or ``not_funded``.

    A port is funded if it is one of the two ports nearest to the funded site among
    those with the same match keys, and shares a word with it in area or address.
    The two nearest are taken in each part of a group first, then among those.
    """
    order = ["distance_km", "evse_id", "evse_port_id"]
    candidates = funded_candidates(location, funded, trim_keys)
    for group in ([*MATCH_KEYS, "_part"], MATCH_KEYS):
        nth = F.row_number().over(Window.partitionBy(*group).orderBy(*order))
        candidates = candidates.withColumn("_n", nth).where(F.col("_n") <= 2)
    nearest = candidates.where(
        share_a_word(F.col("lga_name"), F.col("_f_lga"))
        | share_a_word(F.col("address"), F.col("_f_address"))
    ).select(
        "evse_id",
        "evse_port_id",
        program_label(F.col("program"), F.col("round")).alias("_label"),
    )
    return (
        location.join(nearest, ["evse_id", "evse_port_id"], "left")
        .withColumn("government_funded", F.coalesce("_label", F.lit(NOT_FUNDED)))
        .drop("_label")
    )


# --- gaps filled from stored geocoder responses ----------------------------
_RESPONSE = T.StructType(
    [
        T.StructField(
            "results",
            T.ArrayType(
                T.StructType(
                    [
                        T.StructField("formatted_address", T.StringType()),
                        T.StructField(
                            "address_components",
                            T.ArrayType(
                                T.StructType(
                                    [
                                        T.StructField("long_name", T.StringType()),
                                        T.StructField("short_name", T.StringType()),
                                        T.StructField("types", T.ArrayType(T.StringType())),
                                    ]
                                )
                            ),
                        ),
                    ]
                )
            ),
        )
    ]
)


def geocode_parts(responses: DataFrame) -> DataFrame:
    """Area, state and address of each stored geocoder response.

    The area is the first level-2 administrative area over all results; without one,
    a locality of the capital territory gives the unincorporated area. The state is
    the first level-1 short name, the address the first formatted one.
    """
    results = F.from_json("response", _RESPONSE)["results"]
    parsed = responses.withColumn("_results", F.coalesce(results, F.array().cast(_RESPONSE[0].dataType)))
    components = F.flatten(
        F.transform(
            "_results",
            lambda r: F.coalesce(
                r["address_components"],
                F.array().cast(_RESPONSE[0].dataType.elementType["address_components"].dataType),
            ),
        )
    )
    parsed = parsed.withColumn("_components", components)

    def of_type(kind: str) -> Column:
        return F.filter(
            "_components",
            lambda c: F.coalesce(F.array_contains(c["types"], kind), F.lit(False)),
        )

    act = F.exists(of_type("locality"), lambda c: c["short_name"].isin(ACT_LOCALITIES))
    level2 = of_type("administrative_area_level_2")
    return parsed.select(
        "latitude",
        "longitude",
        F.when(F.size(level2) > 0, F.get(level2, F.lit(0))["long_name"])
        .when(F.coalesce(act, F.lit(False)), F.lit(UNINCORPORATED_ACT))
        .alias("geo_lga"),
        F.get(of_type("administrative_area_level_1"), F.lit(0))["short_name"].alias("geo_state"),
        F.get("_results", F.lit(0))["formatted_address"].alias("geo_address"),
    )


def fill_missing(location: DataFrame, geocoded: DataFrame, lookup: DataFrame) -> DataFrame:
    """Fill null areas and addresses, and correct states, from geocoded coordinates.

    A geocoded area counts only if the lookup has a canonical name for it. A state
    that disagrees with the geocoded one is replaced by it.
    """
    names = first_per_key(
        lookup.select(F.col("google_lga_name").alias("geo_lga"), F.col("lga_name").alias("_canon")),
        ["geo_lga"],
        ["_canon"],
    )
    parts = first_per_key(
        geocoded, ["latitude", "longitude"], ["geo_lga", "geo_state", "geo_address"]
    ).join(names, "geo_lga", "left")
    state = F.col("state")
    agrees = F.coalesce(state == F.col("geo_state"), F.lit(False))
    return location.join(parts, ["latitude", "longitude"], "left").select(
        *[
            {
                "lga_name": F.coalesce("lga_name", "_canon"),
                "address": F.coalesce("address", "geo_address"),
                "state": F.when(agrees, state).otherwise(F.col("geo_state")),
            }
            .get(c, F.col(c))
            .alias(c)
            for c in location.columns
        ]
    )

"""The entity pattern: one wide row per member of a root node, from a triples table."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from strata.functions.text import text_after
from strata.operators.graph import (
    best_label, complete, latest_statement, members, optionals, point_latitude, point_longitude,
)
from strata.workspace import materialize

# Predicates of the pattern and the order of label languages.
MEMBER = "wdt:P150"
LABEL = "rdfs:label"
ISO_CODE = "wdt:P300"
AREA = "wdt:P2046"
CAPITAL = "wdt:P36"
COORDINATES = "wdt:P625"
INCEPTION = "wdt:P571"
POPULATION_STATEMENT = "p:P1082"
POPULATION_VALUE = "ps:P1082"
POINT_IN_TIME = "pq:P585"
LANGUAGES = ("id", "en")


def entity_rows(triples: DataFrame, root: str, entity_prefix: str) -> DataFrame:
    """Members of ``root`` with labels, iso code, area, capital, coordinates, inception and the
    latest population; sorted by iso code, missing codes first.

    A property with several values gives several rows. All parts join on the subject.
    """
    subjects = materialize(members(triples, root, MEMBER).distinct(), "members")
    rows = optionals(subjects, triples, {
        "province_name_id": (LABEL, "id"), "province_name_en": (LABEL, "en"), "iso_code": (ISO_CODE, None),
        "area_km2": (AREA, None), "capital": (CAPITAL, None), "coords": (COORDINATES, None),
        "inception_date": (INCEPTION, None),
    })
    latest = latest_statement(
        triples, POPULATION_STATEMENT, POPULATION_VALUE, POINT_IN_TIME, "population", "population_date", subjects
    )
    rows = rows.join(complete(subjects, latest), "s")
    rows = best_label(
        rows, triples, "capital", "capital_city", text_after(F.col("capital"), entity_prefix), LABEL, LANGUAGES
    )
    wide = rows.select(
        F.col("s").alias("province"),
        text_after(F.col("s"), entity_prefix).alias("wikidata_qid"),
        "province_name_id", "province_name_en", "iso_code", "population", "population_date", "area_km2",
        "capital_city", point_latitude(F.col("coords")).alias("latitude"),
        point_longitude(F.col("coords")).alias("longitude"), "inception_date",
    )
    # every column breaks ties, so that rows without a code spread over the tasks of the sort
    ties = [F.asc_nulls_first(c) for c in wide.columns if c != "iso_code"]
    return wide.orderBy(F.asc_nulls_first("iso_code"), *ties)

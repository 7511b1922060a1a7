"""The thirteen datasets of the public motor-racing results API.

Field names, JSON names, types, record paths and URL patterns below are fixed values: they are the
API's format and the Silver column names a user queries.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from smeltery.sources.models import (
    Dataset,
    Field,
    Level,
    Model,
    listed,
    nested,
    real,
    text,
    titled,
    whole,
)

SOURCE = "ergast"
DEFAULT_LIMIT = 100
FIRST_SEASON = 1950

LOCATION = Model((real("lat"), real("long"), text("locality"), titled("country")))
CIRCUIT = Model(
    (
        text("circuit_id", "circuitId"),
        text("name", "circuitName"),
        text("url"),
        nested("location", "Location", LOCATION),
    )
)
DRIVER = Model(
    (
        text("driver_id", "driverId"),
        whole("permanent_number", "permanentNumber", optional=True),
        text("code", optional=True),
        text("given_name", "givenName"),
        text("family_name", "familyName"),
        text("date_of_birth", "dateOfBirth"),
        titled("nationality"),
        text("url"),
    )
)
CONSTRUCTOR = Model(
    (text("constructor_id", "constructorId"), text("name"), titled("nationality"), text("url"))
)
TIME = Model((text("time"), whole("millis", optional=True)))
AVERAGE_SPEED = Model((text("units"), real("speed")))
FASTEST_LAP = Model(
    (
        whole("rank"),
        whole("lap"),
        nested("time", "Time", TIME),
        nested("average_speed", "AverageSpeed", AVERAGE_SPEED, optional=True),
    )
)
SEASON = Model((whole("season"), text("url")))
STATUS = Model((whole("status_id", "statusId"), text("status"), whole("count")))
RACE = Model(
    (
        whole("season"),
        whole("round"),
        text("url"),
        text("race_name", "raceName"),
        nested("circuit", "Circuit", CIRCUIT),
        text("date"),
        text("time", optional=True),
    )
)
RESULT = Model(
    (
        whole("number", optional=True),
        whole("position", optional=True),
        real("points", optional=True),
        whole("grid", optional=True),
        whole("laps", optional=True),
        nested("driver", "Driver", DRIVER),
        nested("constructor", "Constructor", CONSTRUCTOR),
        text("status"),
        nested("time", "Time", TIME, optional=True),
        nested("fastest_lap", "FastestLap", FASTEST_LAP, optional=True),
    )
)
QUALIFYING = Model(
    (
        whole("number"),
        whole("position"),
        nested("driver", "Driver", DRIVER),
        nested("constructor", "Constructor", CONSTRUCTOR),
        text("q1", "Q1", optional=True),
        text("q2", "Q2", optional=True),
        text("q3", "Q3", optional=True),
    )
)
SPRINT = Model(
    (
        whole("number"),
        whole("position"),
        real("points"),
        whole("grid"),
        whole("laps"),
        nested("driver", "Driver", DRIVER),
        nested("constructor", "Constructor", CONSTRUCTOR),
        text("status"),
        nested("time", "Time", TIME, optional=True),
    )
)
PIT_STOP = Model(
    (text("driver_id", "driverId"), whole("lap"), whole("stop"), text("time"), text("duration"))
)
TIMING = Model((text("driver_id", "driverId"), whole("position"), text("time")))
LAP = Model((whole("number"), listed("timings", "Timings", TIMING)))
DRIVER_STANDING = Model(
    (
        whole("position"),
        real("points"),
        whole("wins"),
        nested("driver", "Driver", DRIVER),
        listed("constructors", "Constructors", CONSTRUCTOR),
    )
)
CONSTRUCTOR_STANDING = Model(
    (
        whole("position"),
        real("points"),
        whole("wins"),
        nested("constructor", "Constructor", CONSTRUCTOR),
    )
)

_ROUND_KEYS: tuple[Field, ...] = (
    whole("season", optional=True),
    whole("round", optional=True),
)


def _per_round(
    name: str, model: Model, lists: tuple[str, str], key: tuple[str, ...], url: str | None = None
) -> Dataset:
    outer, inner = lists
    return Dataset(
        name,
        model,
        (Level(outer, _ROUND_KEYS), Level(inner)),
        ("season", "round", *key),
        group="race",
        url_pattern="{season}/{round}/" + (url or name) + ".json",
        has_season=True,
        has_round=True,
        phase=4,
    )


def _per_season(
    name: str, model: Model, path: str, key: tuple[str, ...], group: str, phase: int, url: str, paginated: bool = True
) -> Dataset:
    return Dataset(
        name, model, (Level(path),), key, group=group, url_pattern=url, has_season=True,
        paginated=paginated, phase=phase,
    )


# A driver may have two results in one race, in shared cars: number and position tell them apart.
_ENTRY = ("driver_driver_id", "number", "position")

RACES = "RaceTable.Races"
STANDINGS = "StandingsTable.StandingsLists"

DATASETS: dict[str, Dataset] = {
    d.name: d
    for d in (
        Dataset("seasons", SEASON, (Level("SeasonTable.Seasons"),), ("season",), url_pattern="seasons.json"),
        _per_season("circuits", CIRCUIT, "CircuitTable.Circuits", ("season", "circuit_id"), "reference", 1, "{season}/circuits.json"),
        Dataset("status", STATUS, (Level("StatusTable.Status"),), ("status_id",), url_pattern="status.json"),
        _per_season("constructors", CONSTRUCTOR, "ConstructorTable.Constructors", ("season", "constructor_id"), "season", 2, "{season}/constructors.json"),
        _per_season("drivers", DRIVER, "DriverTable.Drivers", ("season", "driver_id"), "season", 2, "{season}/drivers.json"),
        _per_season("races", RACE, RACES, ("season", "round"), "season", 2, "{season}.json", paginated=False),
        _per_round("results", RESULT, (RACES, "Results"), _ENTRY),
        _per_round("qualifying", QUALIFYING, (RACES, "QualifyingResults"), _ENTRY),
        _per_round("laps", LAP, (RACES, "Laps"), ("number", "timings_driver_id")),
        _per_round("pitstops", PIT_STOP, (RACES, "PitStops"), ("driver_id", "stop")),
        _per_round("sprint", SPRINT, (RACES, "SprintResults"), _ENTRY),
        _per_round("driverstandings", DRIVER_STANDING, (STANDINGS, "DriverStandings"), ("driver_driver_id", "constructors_constructor_id"), url="driverStandings"),
        _per_round("constructorstandings", CONSTRUCTOR_STANDING, (STANDINGS, "ConstructorStandings"), ("constructor_constructor_id",), url="constructorStandings"),
    )
}


def dataset(name: str) -> Dataset:
    found = DATASETS.get(name.lower())
    if found is None:
        raise ValueError(f"no dataset named {name!r}; known: {', '.join(DATASETS)}")
    return found


def catalog(spark: SparkSession) -> DataFrame:
    """The registry as a table, one row per dataset."""
    rows = [
        (d.name, d.group, d.url_pattern, d.has_season, d.has_round, d.paginated, d.phase)
        for d in DATASETS.values()
    ]
    return spark.createDataFrame(
        rows,
        "endpoint string, group string, url_pattern string, has_season boolean, "
        "has_round boolean, paginated boolean, phase int",
    )

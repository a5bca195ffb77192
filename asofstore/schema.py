"""Schemas and generated column lists.

Column names follow the session-results data model: one row per driver per
session, keyed by season (``year``), round inside the season
(``roundnumber``) and session type (``mode``). All names are lower case;
Spark resolves identifiers case-insensitively by default.
"""

from __future__ import annotations

from pyspark.sql import types as T

# Bronze table: one row per driver per session.
SESSION_RESULTS = T.StructType([
    T.StructField("driverid", T.StringType()),
    T.StructField("year", T.IntegerType()),
    T.StructField("roundnumber", T.IntegerType()),
    T.StructField("mode", T.StringType()),
    T.StructField("date", T.TimestampType()),
    T.StructField("position", T.DoubleType()),
    T.StructField("gridposition", T.DoubleType()),
    T.StructField("points", T.DoubleType()),
    T.StructField("status", T.StringType()),
    T.StructField("fullname", T.StringType()),
    T.StructField("teamname", T.StringType()),
    T.StructField("teamcolor", T.StringType()),
])

# Session-type names used by the feature definitions.
RACE = "Race"
SPRINT = "Sprint"
MODE_SUFFIX = {None: "", RACE: "_race", SPRINT: "_sprint"}

# Window names of the consolidated store and their round counts
# (None = whole career).
WINDOWS = {"life": None, "last_10": 10, "last_20": 20, "last_40": 40}

# Descriptive attributes carried by the consolidated store.
ATTRIBUTES = ["fullname", "teamname", "teamcolor"]

KEYS = ["dt_ref", "driverid"]

"""Scored reporting tables: names, colours, top-3, filters and the probability pivot.

Every operator works on the scored store (feature rows with ``year`` and
``prob_win``). "Keep first" operations are aggregates with a total order
(``min``/``max`` of a struct), so they combine map-side instead of sorting a
whole driver's rows in one task, and ties resolve deterministically.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from pyspark.sql import types as T

from ..functions.scalar import response, team_color


def canonical_names(scored: DataFrame) -> DataFrame:
    """``(driverid, fullname_correct)``: the name on the driver's earliest date.

    Rows without a name are dropped first; on the earliest date the smallest
    name wins.
    """
    named = scored.where(F.col("fullname").isNotNull() & F.col("driverid").isNotNull()
                         & F.col("dt_ref").isNotNull())
    first = F.min(F.struct("dt_ref", "fullname"))
    return named.groupBy("driverid").agg(first["fullname"].alias("fullname_correct"))


def attach_names(scored: DataFrame) -> DataFrame:
    """Inner join of the canonical name (J8): drivers never named drop out."""
    return scored.join(canonical_names(scored), "driverid")


def driver_list(named: DataFrame) -> DataFrame:
    """One ``(driverid, fullname_correct)`` per driver, smallest name first."""
    return (named.where(F.col("fullname_correct").isNotNull())
            .groupBy("driverid").agg(F.min("fullname_correct").alias("fullname_correct")))


def season_list(scored: DataFrame) -> DataFrame:
    """Distinct seasons."""
    return scored.select("year").distinct()


def top3_latest(named: DataFrame, k: int = 3) -> DataFrame:
    """The ``k`` rows with highest ``prob_win`` on the latest date.

    The latest date is a one-row aggregate joined back (broadcast); ``limit``
    after ``orderBy`` plans as a per-task top-k (TakeOrderedAndProject).
    """
    latest = F.broadcast(named.agg(F.max("dt_ref").alias("_mx")))
    rows = named.join(latest, F.col("dt_ref") == F.col("_mx")).drop("_mx")
    return (rows.orderBy(F.col("prob_win").desc(), F.col("driverid"))
            .limit(k).select("dt_ref", "driverid", "fullname_correct", "prob_win"))


def default_drivers(named: DataFrame, k: int = 3) -> DataFrame:
    """Driver-list entries among the top ``k`` of the latest date (L3)."""
    return driver_list(named).join(top3_latest(named, k).select("driverid"), "driverid", "left_semi")


def report_filter(named: DataFrame, drivers: DataFrame, seasons: DataFrame) -> DataFrame:
    """Rows of the chosen drivers and seasons (P13); both lists are semi joins."""
    return (named.join(drivers.select("driverid"), "driverid", "left_semi")
            .join(seasons.select("year"), "year", "left_semi"))


def driver_colors(filtered: DataFrame) -> DataFrame:
    """``(fullname_correct, color)``: normalised team colour on the latest date."""
    c = filtered.withColumn("color", team_color(F.col("teamcolor")))
    last = F.max(F.struct("dt_ref", "color"))
    return c.groupBy("fullname_correct").agg(last["color"].alias("color"))


def driver_slots(drivers: DataFrame) -> DataFrame:
    """``(driverid, slot)``: chosen drivers numbered from 1 by name, then id.

    The chosen drivers of a report are a handful (the top ``k``).
    """
    w = Window.orderBy("fullname_correct", "driverid")
    return drivers.select("driverid", F.row_number().over(w).alias("slot"))


def prob_pivot(filtered: DataFrame, names: list | None = None, by: str = "fullname_correct") -> DataFrame:
    """Rows ``dt_ref``, one column per driver, mean ``prob_win``.

    Pass ``names`` to fix the columns (no extra job to find them).
    """
    g = filtered.groupBy("dt_ref")
    return (g.pivot(by, names) if names is not None else g.pivot(by)).agg(F.avg("prob_win"))


def attach_scores(rows: DataFrame, scores: DataFrame, key: str = "id") -> DataFrame:
    """Score lookup by id; a missing id gives NULL."""
    return rows.join(scores, key, "left")


def require_rows(df: DataFrame) -> DataFrame:
    """Empty-input guard (P20): scoring an empty request is an error."""
    if df.isEmpty():
        raise ValueError("No features provided")
    return df


def require_unique(df: DataFrame, key: str = "id") -> DataFrame:
    """Payload ids must be unique to be keyed (T24); one small probe job."""
    dup = df.groupBy(key).count().where(F.col("count") > 1).limit(1).collect()
    if dup:
        raise ValueError(f"duplicate {key}: {dup[0][key]}")
    return df


def responses(rows: DataFrame, by: str, key: str, prob: str, per: int = 1000) -> DataFrame:
    """``(by, chunk, payload)``: response texts (F14) of about ``per`` ids, so no text grows with its group.

    An id always falls in one chunk of its group; an id that comes twice there is an error.
    """
    sizes = rows.groupBy(F.col(by).alias("_by")).agg(F.ceil(F.count("*") / per).alias("_chunks"))
    dealt = rows.join(sizes, rows[by].eqNullSafe(sizes["_by"]))
    chunk = F.pmod(F.xxhash64(key), F.col("_chunks")).alias("chunk")
    return dealt.groupBy(by, chunk).agg(response(F.col(key), F.col(prob)).alias("payload"))


def checked_records(requests: DataFrame, shape: T.StructType, payload: str = "payload") -> DataFrame:
    """The records of ``{"values": [record, ...]}`` texts (F15), one row each, nothing dropped.

    Adds ``record`` (of ``shape``) and ``reason`` to the other columns; one of them is null. A text that is
    no JSON object, has no values or a value that does not fit its type is a row with a reason; a field that
    is absent or null is null. An empty list is 'No features provided'.
    """
    loose = T.StructType([T.StructField("values", T.ArrayType(T.MapType(T.StringType(), T.StringType()))),
                          T.StructField("_corrupt", T.StringType())])
    kind = "struct<whole: string, r: map<string, string>>"

    def records(text, body):
        whole = (F.when(text.isNull() | body.isNull() | (body["_corrupt"].isNotNull() & F.get_json_object(text, "$").isNull()),
                        "not a JSON object")
                 .when(body["_corrupt"].isNotNull() | body["values"].isNull(), "no values")
                 .when(F.size(body["values"]) == 0, "No features provided"))
        opened = F.transform(body["values"], lambda r: F.struct(F.lit(None).cast("string").alias("whole"), r.alias("r")).cast(kind))
        # the reason is made once, too
        return F.transform(F.array(whole), lambda w: F.when(w.isNull(), opened).otherwise(
            F.array(F.struct(w.alias("whole"), F.lit(None).cast("map<string, string>").alias("r")).cast(kind))))[0]

    # arrays of one name a text and its parse, so a text is made and parsed once, however often these are read
    found = F.transform(F.array(payload), lambda text: F.transform(
        F.array(F.from_json(text, loose, {"columnNameOfCorruptRecord": "_corrupt"})), lambda body: records(text, body))[0])[0]
    rest = [c for c in requests.columns if c != payload]
    opened = requests.select(*rest, F.explode(found).alias("_f")).select(
        *rest, F.col("_f.whole").alias("_whole"), F.col("_f.r").alias("_r"))
    value = lambda f: F.col("_r")[f.name].try_cast(f.dataType)
    misfit = [F.when(F.col("_r")[f.name].isNotNull() & value(f).isNull(), F.lit(f"{f.name} is no {f.dataType.simpleString()}"))
              for f in shape]
    reason = F.coalesce(F.col("_whole"), F.when(F.col("_r").isNull(), "a record is no object"), *misfit)
    return opened.withColumn("reason", reason).select(*rest, "reason", F.when(F.col("reason").isNull(), F.struct(
        *[value(f).alias(f.name) for f in shape])).alias("record"))

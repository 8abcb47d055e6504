"""Stations and point classification (C-1..C-5, D-2, D-3, D-8)."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from voltrail.params import patterns_df


def managed_stations(lines: DataFrame, stations: DataFrame) -> DataFrame:
    """Energy-managed stations on energy-managed lines (D-2 as one join).

    Returns (line_name, line_abbr, station_name, station_abbr, area).
    """
    l = lines.filter(F.col("energy_mgr") == 1).select("line_name", "line_abbr")
    s = stations.filter(F.col("energy_mgr") == 1).select("line_name", "station_name", "station_abbr", "area")
    # Both sides are dimensions; Catalyst broadcasts the smaller by its size estimate.
    return s.join(l, "line_name").select("line_name", "line_abbr", "station_name", "station_abbr", "area")


def classify_points(points: DataFrame, stations: DataFrame) -> DataFrame:
    """Every (point, class) pair whose point name is LIKE the class pattern (C-5, D-3).

    ``points`` carries (line_name, station_name, point_name, type, control_id);
    the station abbreviation comes from the station dimension on
    (line_name, station_name).  The 26-row pattern table is broadcast (fixed
    size); the LIKE condition runs as a broadcast nested-loop join streaming
    the point dimension.
    Returns (line_name, station_name, station_abbr, point_name, type, control_id, cls).
    """
    pats = F.broadcast(patterns_df(points.sparkSession))
    st = stations.select("line_name", "station_name", "station_abbr")
    p = points.select("line_name", "station_name", "point_name", "type", "control_id").join(
        st, ["line_name", "station_name"])
    return p.join(pats, F.expr("point_name LIKE pattern")).select(
        "line_name", "station_name", "station_abbr", "point_name", "type", "control_id", "cls")


def class_sizes(classified: DataFrame, classes: tuple[str, ...]) -> DataFrame:
    """|C| per station for the given classes: (station_abbr, n_<C> ...)."""
    return classified.groupBy("station_abbr").agg(
        *[F.count(F.when(F.col("cls") == c, 1)).alias(f"n_{c}") for c in classes])


def id_list(classified: DataFrame) -> DataFrame:
    """Comma-joined sorted control ids per (station, class) (E-11)."""
    return classified.groupBy("station_abbr", "cls").agg(
        F.concat_ws(",", F.sort_array(F.collect_list(F.col("control_id"))).cast("array<string>")).alias("ids"),
        F.count("*").alias("n_points"),
    )

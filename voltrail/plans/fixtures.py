"""Station telemetry derived from the driver tables (FIXTURES.md §5, adapted).

* lines    = ``region``      (5; one line not energy-managed)
* stations = ``nation``      (25; three not energy-managed)
* points   = a 32-point catalogue per station, generated per station row
* YC       = ``events`` read as uploads: station = user_id % 25, tick = the
             event's 20-minute bucket; several events of one (station, tick)
             collapse to the last write (highest event_id), like a keyed put.
             Each upload carries one value per YC point of its station.
* YX       = ``events`` read as status changes: id = event_id % 8.

Everything grows linearly with ``events``; no cross products.  Values use
integer arithmetic only, so Spark and the DuckDB oracle agree bit for bit.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from voltrail.functions.codec import NULL_MARKER
from voltrail.functions.ticks import seq_to_tick, tick_seq
from voltrail.plans.joins import join_dimension

N_STATIONS = 25

# --- fixed values: the per-station point catalogue ------------------------------
# (control_id, point_name, type, value family).  Each name matches exactly one
# classification pattern, except that meters also match the all-meters pattern.
CATALOG: tuple[tuple[int, str, str, int], ...] = (
    (0, "LSJZ01_i1Run_St", "YX", 0),
    (1, "LSJZ02_i1Run_St", "YX", 0),
    (2, "LDB01_iRun_St", "YX", 1),
    (3, "LQB01_iRun_St", "YX", 2),
    (4, "LQT01_i1Run_St", "YX", 3),
    (5, "KT_01_iRun_St", "YX", 4),
    (6, "KT_02_iRun_St", "YX", 4),
    (7, "HPF_01_iRun_St", "YX", 5),
    (8, "ZNDB_LS01_Wp_Tm", "YC", 6),
    (9, "ZNDB_LS02_Wp_Tm", "YC", 6),
    (10, "ZNDB_LD01_Wp_Tm", "YC", 6),
    (11, "ZNDB_LQ01_Wp_Tm", "YC", 6),
    (12, "ZNDB_LT01_Wp_Tm", "YC", 6),
    (13, "ZNDB_KT_01_Wp_Tm", "YC", 6),
    (14, "ZNDB_KT_02_Wp_Tm", "YC", 6),
    (15, "ZNDB_HPF_01_Wp_Tm", "YC", 6),
    (16, "KT_01_FreqFB_Hz", "YC", 7),
    (17, "KT_02_FreqFB_Hz", "YC", 7),
    (18, "HPF_01_FreqFB_Hz", "YC", 7),
    (19, "TH_HFD_01_Temp_Tm", "YC", 8),
    (20, "TH_SFD_01_Temp_Tm", "YC", 9),
    (21, "TH_SFD_02_Temp_Tm", "YC", 9),
    (22, "TH_SWD_01_Temp_Tm", "YC", 10),
    (23, "TH_ZTX_A01_Temp_Tm", "YC", 8),
    (24, "TH_ZTS_A01_Temp_Tm", "YC", 8),
    (25, "TH_ZTS_A02_Temp_Tm", "YC", 8),
    (26, "FT_LDD_01_Ft_Tm", "YC", 11),
    (27, "TE_LDJD_01_Temp_Tm", "YC", 12),
    (28, "TE_LDCD_01_Temp_Tm", "YC", 13),
    (29, "FT_LQD_01_Ft_Tm", "YC", 11),
    (30, "TE_LQJD_01_Temp_Tm", "YC", 12),
    (31, "TE_LQCD_01_Temp_Tm", "YC", 13),
)
# -------------------------------------------------------------------------------


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """A driver table; its zone-less timestamps are read in the session's zone, which must be UTC (``utc_session``)."""
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


def fx_line(spark: SparkSession, sf_dir: str) -> DataFrame:
    r = table(spark, sf_dir, "region")
    return r.select(
        F.col("r_name").alias("line_name"),
        F.concat(F.lit("l"), F.expr("chr(97 + r_regionkey)")).alias("line_abbr"),
        F.lit("P").alias("project_name"),
        F.lit("metro").alias("description"),
        F.when(F.col("r_regionkey") == 4, 0).otherwise(1).cast("int").alias("energy_mgr"),
    )


def fx_station(spark: SparkSession, sf_dir: str) -> DataFrame:
    n = table(spark, sf_dir, "nation")
    r = table(spark, sf_dir, "region")
    return n.join(r, n.n_regionkey == r.r_regionkey).select(
        F.col("n_nationkey").cast("int").alias("k"),
        F.col("n_name").alias("station_name"),
        F.concat(F.lit("s"), F.expr("chr(97 + n_nationkey)")).alias("station_abbr"),
        F.col("r_name").alias("line_name"),
        F.lit("metro").alias("description"),
        (F.lit(500) + F.lit(20) * F.col("n_nationkey")).cast("double").alias("area"),
        F.when(F.col("n_nationkey") % 7 == 3, 0).otherwise(1).cast("int").alias("energy_mgr"),
        F.when(F.col("n_nationkey") % 5 == 0, 1).otherwise(0).cast("int").alias("transfer"),
    )


def _catalog_array() -> Column:
    # One SQL literal expression: a single call builds the 32-element array.
    items = ", ".join(
        f"named_struct('control_id', {cid}, 'point_name', '{name}', 'type', '{typ}', 'fam', {fam})"
        for cid, name, typ, fam in CATALOG)
    return F.expr(f"array({items})")


def fx_point(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Point dimension with the 14 delivered fields, plus ``k`` and ``fam`` for generation."""
    s = fx_station(spark, sf_dir)
    p = s.select("k", "line_name", "station_name", "station_abbr", F.inline(_catalog_array()))
    return p.select(
        "k", "line_name", "station_name", "station_abbr", "point_name", "type", "control_id",
        F.concat(F.lit("E"), F.col("control_id").cast("string")).alias("equipment_id"),
        F.regexp_extract("point_name", r"^([A-Z]+)", 1).alias("equipment_name"),
        F.when(F.col("type") == "YX", F.lit("int")).otherwise(F.lit("float")).alias("data_type"),
        F.lit(0).alias("statics"),
        F.when(F.col("type") == "YX", F.lit("-")).otherwise(F.lit("kWh")).alias("unit"),
        F.lit(1).alias("quantity"),
        F.lit(0.0).alias("lower_limit"),
        F.lit(100.0).alias("upper_limit"),
        # Only status points carry the optional 14th field.
        F.when(F.col("type") == "YX", F.lit("run status")).alias("description"),
        "fam",
    )


def fx_upload(spark: SparkSession, sf_dir: str) -> DataFrame:
    """(k, seq, e): last event id per (station, tick) — partial-aggregated max."""
    ev = table(spark, sf_dir, "events")
    return (
        ev.select((F.col("user_id") % N_STATIONS).cast("int").alias("k"), tick_seq("ts").alias("seq"), "event_id")
        .groupBy("k", "seq").agg(F.max("event_id").alias("e"))
    )


def _value(k: Column, cid: Column, fam: Column, seq: Column, e: Column) -> Column:
    def txt(c: Column) -> Column:
        return c.cast("bigint").cast("string")
    null_mod = F.when(fam == 6, F.lit(211)).otherwise(F.lit(23))
    return (
        F.when((k * 5 + cid * 3 + e) % null_mod == 0, F.lit(NULL_MARKER))
        .when(fam == 6, txt((seq - 1420000) * (F.lit(10) + k % 5 + cid % 3) + e % 7))
        .when(fam == 7, txt(F.lit(30) + (k + e + cid) % 20))
        .when(fam == 8, txt(F.lit(24) + (k + e) % 9))
        .when(fam == 9, txt(F.lit(16) + (k + e) % 5))
        .when(fam == 10, txt(F.lit(18) + (k + e) % 8))
        .when(fam == 11, txt(F.lit(20) + (k + e) % 40))
        .when(fam == 12, txt(F.lit(7) + (k + e) % 3))
        .otherwise(txt(F.lit(11) + (k + e) % 4))
    )


def fx_reading(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Long YC readings (station_abbr, tick, control_id, value) + seq."""
    up = fx_upload(spark, sf_dir)
    yc = fx_point(spark, sf_dir).filter(F.col("type") == "YC").select("k", "station_abbr", "control_id", "fam")
    j = join_dimension(up, yc, "k")
    return j.select(
        "station_abbr",
        seq_to_tick("seq").alias("tick"),
        "control_id",
        _value(F.col("k"), F.col("control_id"), F.col("fam"), F.col("seq"), F.col("e")).alias("value"),
        "seq",
    )


def fx_status(spark: SparkSession, sf_dir: str) -> DataFrame:
    return status_from_events(table(spark, sf_dir, "events"))


def status_from_events(ev: DataFrame) -> DataFrame:
    """Status changes from event rows (batch or streaming)."""
    return ev.select(
        F.concat(F.lit("s"), F.expr(f"chr(97 + CAST(user_id % {N_STATIONS} AS INT))")).alias("station_abbr"),
        (F.col("event_id") % 8).cast("int").alias("id"),
        F.col("ts").cast("timestamp").alias("ts"),
        F.when((F.col("event_id") % 7 + F.col("user_id")) % 3 == 0, F.lit("0")).otherwise(F.lit("1")).alias("value"),
    )


def points_dim(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The point dimension as delivered (no generation helpers)."""
    return fx_point(spark, sf_dir).drop("k", "fam", "station_abbr")

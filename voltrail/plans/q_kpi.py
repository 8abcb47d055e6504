"""Registered KPI queries: readings, status, formulas and the KPI tables."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from voltrail.functions.ticks import tick_seq
from voltrail.operators import job as JOB
from voltrail.operators.basics import seq_text
from voltrail.operators import kpi as K
from voltrail.operators import points as P
from voltrail.operators import readings as R
from voltrail.params import (DAY_COLUMNS, FIXTURE_PARAMS, KPI_COLUMNS, MEAN_CLASSES, METER_CLASSES,
                             RUN_CLASSES, ParamColumns, params_at)
from voltrail.plans import fixtures as fx
from voltrail.plans.oracle_core import (CTES, R4, TICK_TEXT, kpi_rs_cte, present, sql_formulas, with_ctes)
from voltrail.plans.joins import join_dimension
from voltrail.plans.registry import register
from voltrail.session import file_system, scratch_path
from voltrail.sources import dropfolder as DF
from voltrail.sources import runs as RN
from voltrail.sources import store as ST
from voltrail.streaming import jobs as J

P0 = FIXTURE_PARAMS


def _signature(spark: SparkSession, sf_dir: str) -> tuple:
    """Bytes, files and time of the tables that the telemetry is derived from: other tables under a path are seen."""
    found = []
    for name in ("events", "nation", "region"):
        system, where = file_system(spark, f"{sf_dir.rstrip('/')}/{name}.parquet")
        summary = system.getContentSummary(where)
        found.append((summary.getLength(), summary.getFileCount(), system.getFileStatus(where).getModificationTime()))
    return tuple(found)


def _memo(spark: SparkSession, key: tuple, make):
    """DataFrames are immutable lazy plans: several queries over the same tables build theirs once.
    They are kept on the session, so they end with it, and made anew where the tables have changed."""
    plans = spark.__dict__.setdefault("_voltrail_plans", {})
    now = _signature(spark, key[0])
    if key not in plans or plans[key][0] != now:
        old = plans.pop(key, (None, None))[1]
        if isinstance(old, DataFrame):
            old.unpersist()
        elif isinstance(old, K.Job):
            old.release()
        plans[key] = (now, make())
    return plans[key][1]


def world(spark: SparkSession, sf_dir: str) -> dict[str, DataFrame]:
    return _memo(spark, (sf_dir, "world"), lambda: _world(spark, sf_dir))


def _world(spark: SparkSession, sf_dir: str) -> dict[str, DataFrame]:
    return {
        "lines": fx.fx_line(spark, sf_dir),
        "stations": fx.fx_station(spark, sf_dir),
        "points": fx.points_dim(spark, sf_dir),
        "readings": fx.fx_reading(spark, sf_dir),
        "status": fx.fx_status(spark, sf_dir),
    }


def _job(spark, sf_dir) -> K.Job:
    return _memo(spark, (sf_dir, "job"), lambda: K.Job(**world(spark, sf_dir)))


def _analog(spark, sf_dir) -> DataFrame:
    return _memo(spark, (sf_dir, "analog"), lambda: _job(spark, sf_dir).analog())


def _inputs(spark, sf_dir) -> DataFrame:
    """The formulas' inputs, a row per station and tick: computed once for all queries that start from them."""
    return _memo(spark, (sf_dir, "inputs"), lambda: _job(spark, sf_dir).inputs().persist())


def _rs(spark, sf_dir) -> DataFrame:
    return _memo(spark, (sf_dir, "rs"), lambda: K.kpi_real_status(_inputs(spark, sf_dir), P0))


def _day(spark, sf_dir) -> DataFrame:
    """The day table, which the rollups read as well."""
    return _memo(spark, (sf_dir, "day"), lambda: K.kpi_day(_rs(spark, sf_dir)).persist())


RS = kpi_rs_cte(P0)
F_SQL = sql_formulas(P0)


# ------------------------------------------------------------------ dimensions

@register("managed_stations", with_ctes(
    "SELECT line_name, line_abbr, station_name, station_abbr, area FROM managed", ("managed",)),
    "C-1", "C-3", "C-4", "D-2", "D-8")
def q_managed_stations(spark, sf_dir):
    w = world(spark, sf_dir)
    return P.managed_stations(w["lines"], w["stations"])


@register("point_classify", with_ctes(
    "SELECT line_name, station_name, station_abbr, point_name, type, control_id, cls FROM classified",
    ("classified",)), "C-5", "D-3")
def q_point_classify(spark, sf_dir):
    w = world(spark, sf_dir)
    return P.classify_points(w["points"], w["stations"])


@register("id_list", with_ctes(
    "SELECT station_abbr, cls, string_agg(CAST(control_id AS VARCHAR), ',' ORDER BY control_id) AS ids, "
    "COUNT(*) AS n_points FROM classified GROUP BY station_abbr, cls", ("classified",)), "E-11")
def q_id_list(spark, sf_dir):
    w = world(spark, sf_dir)
    return P.id_list(P.classify_points(w["points"], w["stations"]))


# ------------------------------------------------------------------ readings

@register("class_mean", with_ctes(present("x", [f"m_{c}" for c in MEAN_CLASSES]), ("x",)), "E-5", "D-4")
def q_class_mean(spark, sf_dir):
    return K.present(_analog(spark, sf_dir), [f"m_{c}" for c in MEAN_CLASSES])


@register("meter_delta_20m", with_ctes(present("x", [f"c_{c}" for c in METER_CLASSES]), ("x",)),
          "E-4", "D-6", "C-9", "F-2")
def q_meter_delta_20m(spark, sf_dir):
    return K.present(_analog(spark, sf_dir), [f"c_{c}" for c in METER_CLASSES])


@register("meter_delta_24h", with_ctes(present("x", [f"e_{c}" for c in METER_CLASSES]), ("x",)), "E-4", "F-2")
def q_meter_delta_24h(spark, sf_dir):
    return K.present(R.meter_deltas(_analog(spark, sf_dir), 72, "e"), [f"e_{c}" for c in METER_CLASSES])


@register("run_status", with_ctes(present("xin", [f"on_{c}" for c in RUN_CLASSES]), ("xin",)), "E-3", "F-3")
def q_run_status(spark, sf_dir):
    return K.present(_inputs(spark, sf_dir), [f"on_{c}" for c in RUN_CLASSES])


# ------------------------------------------------------------------ formulas

def _formula_query(col_sql: str, name: str):
    return with_ctes(f"SELECT station_abbr, {TICK_TEXT('seq')} AS kpi_time, {R4(col_sql)} AS {name} FROM xin",
                     ("xin",))


@register("air_yield", _formula_query(F_SQL["air"], "air_yield"), "J-2")
def q_air_yield(spark, sf_dir):
    x = _analog(spark, sf_dir).withColumn("air_yield", K.air_yield(P0))
    return K.present(x, ["air_yield"])


@register("cooling_output", _formula_query(F_SQL["ll"], "cooling_kw"), "J-3")
def q_cooling_output(spark, sf_dir):
    x = _inputs(spark, sf_dir).withColumn("cooling_kw", K.cooling_output(P0))
    return K.present(x, ["cooling_kw"])


@register("water_indicator", _formula_query(F_SQL["water_ld"], "water_ld"), "J-8")
def q_water_indicator(spark, sf_dir):
    cons = F.col("c_LSJZ_ZNDB")
    w = K.water_indicator(P0, cons, F.col("m_LD_yield"), F.col("m_LD_OT"), F.col("m_LD_IT"))
    x = _analog(spark, sf_dir).withColumn("water_ld", F.when(cons == 0, F.lit(0.0)).otherwise(w))
    return K.present(x, ["water_ld"])


def _score_query(key: str, col: str, *ids: str):
    @register(key, _formula_query(F_SQL[col], col), *ids)
    def q(spark, sf_dir):
        x = _analog(spark, sf_dir) if col in K.ANALOG_SCORES else _inputs(spark, sf_dir)
        return K.present(K.scores(x, P0, (col,)), [col])
    q.__name__ = f"q_{key}"
    return q


_score_query("kpi_d1_power", "d1", "J-1")
_score_query("kpi_d2_efficiency", "d2", "J-4")
_score_query("kpi_d3_cooling", "d3", "J-5")
_score_query("kpi_d4_room_temp", "d4", "J-7")
_score_query("kpi_d5_chiller", "d5", "J-9")
_score_query("kpi_d10_chilled_pump", "d10", "J-9")
_score_query("kpi_d15_cooling_pump", "d15", "J-10")
_score_query("kpi_d20_tower", "d20", "J-10")
_score_query("kpi_d24_ventilation", "d24", "J-6")


# ------------------------------------------------------------------ KPI tables

@register("kpi_real", with_ctes(present("kpi_rs", KPI_COLUMNS), ("kpi_rs",), RS), "J-12")
def q_kpi_real(spark, sf_dir):
    return K.present(_rs(spark, sf_dir), KPI_COLUMNS)


# Standards that change within days: settings come with one event in 400, defaults with the regions.
_STANDARDS = ("LL_standard", "XL_standard", "HFT_standard", "KT_F")
_SETTINGS_SQL = """SELECT ['LL_standard', 'XL_standard', 'HFT_standard', 'KT_F'][1 + (event_id // 400) % 4] AS key,
 [200 + event_id % 7, 1 + event_id % 3, 24 + (event_id // 1600) % 6, 50000 + event_id][1 + (event_id // 400) % 4] AS v, epoch_us(ts) AS us FROM events WHERE event_id % 400 = 0"""


class _SqlParams:
    """The parameters of the oracle's formulas: columns where they change, else constants."""

    def __getattr__(self, name):
        return f"p_{name}" if name in _STANDARDS else getattr(P0, name)


_LAYERED = {
    "changes_of": (f"SELECT key, us, max(v) AS v FROM ({_SETTINGS_SQL}) GROUP BY key, us", ()),
    "xp": ("SELECT x.*, " + ", ".join(f"COALESCE(CAST(c{i}.v AS DOUBLE), {27.0 if n == 'HFT_standard' else float(getattr(P0, n))!r}::DOUBLE) AS p_{n}" for i, n in enumerate(_STANDARDS))
           + " FROM xin x" + "".join(f" ASOF LEFT JOIN (SELECT * FROM changes_of WHERE key = '{n}') c{i} ON c{i}.us <= x.seq * 1200000000" for i, n in enumerate(_STANDARDS)),
           ("xin", "changes_of")),
    "layered": ("SELECT station_abbr, seq, " + ", ".join(f"{sql_formulas(_SqlParams())[n]} AS {n}" for n in KPI_COLUMNS) + " FROM xp", ("xp",)),
}


def parameter_layers(spark, sf_dir) -> tuple[DataFrame, DataFrame]:
    """(key, value, valid_from) of defaults and settings."""
    ev = fx.table(spark, sf_dir, "events").where(F.col("event_id") % 400 == 0)
    turn, e = (F.floor(F.col("event_id") / 400) % 4).cast("int"), F.col("event_id")
    value = F.when(turn == 0, 200 + e % 7).when(turn == 1, 1 + e % 3).when(turn == 2, 24 + F.floor(e / 1600) % 6).otherwise(50000 + e)
    settings = ev.select(F.element_at(F.array(*[F.lit(n) for n in _STANDARDS]), turn + 1).alias("key"), value.cast("string").alias("value"), F.col("ts").alias("valid_from"))
    r = F.col("r_regionkey")
    key = F.when(r == 0, "HFT_standard").when(r == 1, "run_time").when(r == 2, "no_such_key").otherwise("XL_standard")
    value = F.when(r == 0, "27").when(r == 1, "20").when(r == 2, "1").otherwise("none")  # the last is no number
    defaults = fx.table(spark, sf_dir, "region").select(key.alias("key"), value.alias("value"), F.timestamp_seconds(F.lit(0)).alias("valid_from"))
    return defaults, settings


@register("kpi_real_layers", with_ctes(present("layered", KPI_COLUMNS), ("layered",), _LAYERED), "A-16", "J-12")
def q_kpi_real_layers(spark, sf_dir):
    ticks = _job(spark, sf_dir).grid.select("seq").distinct()
    held = params_at(ticks, *parameter_layers(spark, sf_dir), P0)
    x = join_dimension(_inputs(spark, sf_dir), held, "seq")
    return K.present(K.scores(x, ParamColumns(), KPI_COLUMNS), KPI_COLUMNS)


@register("kpi_status", with_ctes(
    f"SELECT station_abbr, {TICK_TEXT('seq')} AS kpi_time, "
    + ", ".join(f"{R4('st_' + n)} AS {n}" for n in KPI_COLUMNS) + " FROM kpi_rs", ("kpi_rs",), RS), "J-11")
def q_kpi_status(spark, sf_dir):
    rs = _rs(spark, sf_dir).select("station_abbr", "seq", *[F.col(f"st_{n}").alias(n) for n in KPI_COLUMNS])
    return K.present(rs, KPI_COLUMNS)


@register("kpi_day", with_ctes(present("kpi_dayt", DAY_COLUMNS), ("kpi_dayt",), RS), "J-13", "J-14", "F-1")
def q_kpi_day(spark, sf_dir):
    return K.present(_day(spark, sf_dir), DAY_COLUMNS)


_TRAIL = "OVER (PARTITION BY station_abbr ORDER BY seq RANGE BETWEEN 71 PRECEDING AND 1 PRECEDING)"


@register("kpi_trailing_sum", with_ctes(
    f"SELECT station_abbr, {TICK_TEXT('seq')} AS kpi_time, "
    + ", ".join(f"{R4(f'COALESCE(SUM({n}) {_TRAIL}, CAST(0 AS DOUBLE))')} AS sum_{n}" for n in KPI_COLUMNS)
    + ", " + ", ".join(f"{R4(f'COALESCE(SUM(st_{n}) {_TRAIL}, CAST(0 AS DOUBLE))')} AS sum_st_{n}" for n in KPI_COLUMNS)
    + " FROM kpi_rs", ("kpi_rs",), RS), "E-2", "D-7")
def q_kpi_trailing_sum(spark, sf_dir):
    t = K.trailing_sums(_rs(spark, sf_dir))
    return K.present(t, [f"sum_{n}" for n in KPI_COLUMNS] + [f"sum_st_{n}" for n in KPI_COLUMNS])


_LAST = "(SELECT max(seq) FROM kpi_rs)"


@register("scan_kpi_window", with_ctes(
    present("kpi_rs", KPI_COLUMNS, f"WHERE seq > {_LAST} - 72 AND seq <= {_LAST}"), ("kpi_rs",), RS),
    "A-10", "B-2", "C-10")
def q_scan_kpi_window(spark, sf_dir):
    # All rows go through the KPI sink; the window is read back from the stored table.
    root = scratch_path(spark, "kpi-tables")
    rs = _rs(spark, sf_dir)
    JOB.store_real(spark, root, rs)
    end = K.last_seq(RN.read_runs(spark, f"{root}/kpi_real").select(tick_seq("tick").alias("seq")))
    return K.present(JOB.scan_kpi(spark, root, "kpi_real", end - 71, end).withColumn("seq", tick_seq("tick")), KPI_COLUMNS)


_LAST_UP = "(SELECT max(seq) FROM sums)"
_REH = f"{_LAST_UP} - 72"


def last_upload(spark, sf_dir) -> int:
    """Newest tick at which a managed station uploaded."""
    w = world(spark, sf_dir)
    managed = P.managed_stations(w["lines"], w["stations"]).select("station_abbr")
    return K.last_seq(join_dimension(_job(spark, sf_dir).sums, managed, "station_abbr", "left_semi"))  # the job's persisted sums


@register("rehandle_tick", with_ctes(
    present("kpi_dayt", DAY_COLUMNS, f"WHERE seq = {_REH}"), ("kpi_dayt",), RS), "J-15", "I-3")
def q_rehandle_tick(spark, sf_dir):
    # The tick to run again: one day before the newest upload of a managed station.
    return K.present(K.rehandle(world(spark, sf_dir), P0, seq_text(last_upload(spark, sf_dir) - 72)), DAY_COLUMNS)


# A correction: at one past tick every analog reading is its control id times three.
_CORRECTED = RS | {"fx_delivered": (CTES["fx_reading"][0], CTES["fx_reading"][1]),
                   "fx_reading": (f"""SELECT station_abbr, seq, control_id,
 CASE WHEN seq = (SELECT max(seq) FROM fx_delivered WHERE station_abbr IN (SELECT station_abbr FROM managed)) - 216 THEN CAST(control_id * 3 AS VARCHAR) ELSE value END AS value
FROM fx_delivered""", ("fx_delivered", "managed"))}


def correction(spark, sf_dir, w: dict[str, DataFrame]) -> tuple[int, dict[str, DataFrame]]:
    """The corrected tick, three days before the newest upload, and the world with its readings as corrected."""
    managed = P.managed_stations(w["lines"], w["stations"]).select("station_abbr")
    t = K.last_seq(join_dimension(w["readings"].select("station_abbr", "seq"), managed, "station_abbr", "left_semi")) - 216
    fixed = F.when(F.col("seq") == t, (F.col("control_id") * 3).cast("string")).otherwise(F.col("value"))
    return t, w | {"readings": w["readings"].withColumn("value", fixed)}


@register("rehandle_dependents", with_ctes(present("kpi_dayt", DAY_COLUMNS), ("kpi_dayt",), _CORRECTED), "J-15", "B-1")
def q_rehandle_dependents(spark, sf_dir):
    # All scores are stored; then a past tick is corrected and what depends on it is run again, for the stations that
    # uploaded at it.  The stored table equals that of all ticks computed from the corrected readings.
    # The station tables are stored first, as a job finds them: plans start from their scans.
    root, w = scratch_path(spark, "rehandled"), {n: ST.written(df, f"rehandled-{n}") for n, df in world(spark, sf_dir).items()}
    job = K.Job(**w)
    rs = ST.written(K.kpi_real_status(job.inputs(), P0), "rehandled-rows")
    job.release()
    JOB.store_real(spark, root, rs)
    RN.upsert_into(spark, f"{root}/kpi_day", JOB.dated(K.kpi_day(rs), *DAY_COLUMNS), JOB.KEYS, "date")
    t, corrected = correction(spark, sf_dir, w)
    uploaded = JOB.at_ticks(corrected["readings"], [t]).select("station_abbr").distinct()
    JOB.rehandle_from(spark, root, P0, seq_text(t), corrected, uploaded)
    return K.present(RN.read_runs(spark, f"{root}/kpi_day").withColumn("seq", tick_seq("tick")), DAY_COLUMNS)


_JOB_TICKS = 3
_TICKS_DAY = with_ctes(present("kpi_dayt", DAY_COLUMNS, f"WHERE seq > {_LAST_UP} - {_JOB_TICKS} AND seq <= {_LAST_UP}"), ("kpi_dayt",), RS)


@register("kpi_tick_job", _TICKS_DAY, "J-14", "B-2")
def q_kpi_tick_job(spark, sf_dir):
    # The tables as ingested and the scores of all earlier ticks, then the job of the last ticks one by one, each
    # reading what the ones before stored; the last is run twice.
    root = scratch_path(spark, "tick-job")
    w, end = world(spark, sf_dir), last_upload(spark, sf_dir)
    JOB.store_real(spark, root, _rs(spark, sf_dir).filter(F.col("seq") <= end - _JOB_TICKS))
    for seq in [*range(end - _JOB_TICKS + 1, end + 1), end]:
        JOB.score_tick(spark, root, P0, seq_text(seq), w)
    return K.present(RN.read_runs(spark, f"{root}/kpi_day").withColumn("seq", tick_seq("tick")), DAY_COLUMNS)


@register("kpi_tick_job_24h", _TICKS_DAY, "J-14", "A-8", "B-2")
def q_kpi_tick_job_24h(spark, sf_dir):
    # The whole job: the store holds all that came before, and the files of each of the last ticks are
    # ingested and scored, the last tick's twice.
    root, folder = scratch_path(spark, "tick-job-24h"), scratch_path(spark, "tick-drop")
    w, end = world(spark, sf_dir), last_upload(spark, sf_dir)
    first = end - _JOB_TICKS + 1
    points = fx.fx_point(spark, sf_dir)
    known_at = F.floor(F.unix_seconds("ts") / 1200) + 1  # the tick whose files bring a status change

    def lines(readings, status, per_tick):
        return DF.export_lines(w["lines"], w["stations"], points, w["readings"].filter(readings), w["status"].filter(status), per_tick)
    before = lines(F.col("seq") < first, known_at < first, False)
    # Made once, as files are: every table that they go to is a pass over them.
    before = J.with_targets(DF.route(before.withColumn("modified", F.timestamp_seconds(F.lit(0)))))
    J.merge_drop(spark, ST.written(before, "drop-before"), root, 0)
    JOB.store_real(spark, root, _rs(spark, sf_dir).filter(F.col("seq") < first))
    DF.write_files(lines(F.col("seq").between(first, end), known_at.between(first, end), True), folder)
    for seq in [*range(first, end + 1), end]:
        JOB.run_tick(spark, folder, root, P0, seq_text(seq))
    return K.present(RN.read_runs(spark, f"{root}/kpi_day").withColumn("seq", tick_seq("tick")), DAY_COLUMNS)

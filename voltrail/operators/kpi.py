"""KPI formulas (J-1 .. J-13) as Column expressions, and the whole job.

Inputs of the formulas, per (station, tick):
  m_<C>     class means at t                  (readings.class_means)
  c_<C>     meter deltas over 20 minutes      (readings.meter_deltas lag 1)
  e_ALL_ZNDB  all-meter delta over 24 hours   (readings.meter_deltas lag 72)
  on_<C>    run status                        (status.run_flags)
  area      station floor area
All arithmetic is DOUBLE; divisions are guarded by the same branches the
original job uses, and ``try_divide`` where it had none (area = 0 → NULL).
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from voltrail.functions.ticks import seq_to_tick, tick_number, tick_text
from voltrail.operators import points as P
from voltrail.operators import readings as R
from voltrail.operators import status as S
from voltrail.params import DAY_COLUMNS, DAY_TICKS, KPI_COLUMNS, MEAN_CLASSES, Params


def c(name: str) -> Column:
    return F.col(name)


def lit(x: float | Column) -> Column:
    """A parameter: a constant, or a column of the row (``params.ParamColumns``)."""
    return x if isinstance(x, Column) else F.lit(float(x))


def score(r: Column, std: float) -> Column:
    """r > std → 100, else r / std * 100 (no lower clamp)."""
    return F.when(r > lit(std), lit(100.0)).otherwise(r / lit(std) * lit(100.0))


def room_temp() -> Column:
    return (c("m_ZTX_T") + c("m_ZTS_T")) / lit(2.0)


def ventilation(sf: Column) -> Column:
    return F.when(sf == 1, lit(1.0)).otherwise(c("on_HPF_Run"))


def air_yield(p: Params) -> Column:
    """J-2: KT_Hz / 50 * KT_F + HPF_Hz / 50 * HPF_F."""
    return c("m_KT_Hz") / lit(50.0) * lit(p.KT_F) + c("m_HPF_Hz") / lit(50.0) * lit(p.HPF_F)


def temp_diff(sf: Column, zt: Column) -> Column:
    return F.when(sf == 0, zt - c("m_XF_T")).otherwise(zt - c("m_SF_T"))


def cooling_output(p: Params, air: Column | None = None, dt: Column | None = None) -> Column:
    """J-3: LL = air_c * air_rho * air * dT / 3600000 (kW)."""
    air = air_yield(p) if air is None else air
    dt = temp_diff(c("on_KT_Run"), room_temp()) if dt is None else dt
    return lit(p.air_specificHeat) * lit(p.air_density) * air * dt / lit(3600000.0)


def water_indicator(p: Params, consumption: Column, yld: Column, ot: Column, it: Column) -> Column:
    """J-8: water_c * water_rho * yield * (OT − IT) * run_time / (216000000 * consumption)."""
    return (lit(p.water_specificHeat) * lit(p.water_density) * yld * (ot - it) * lit(p.run_time)) / (
        lit(216000000.0) * consumption)


def with_intermediates(x: DataFrame, p: Params) -> DataFrame:
    """Adds the shared terms once (zt, vent, air, dT, LL) so each score refers to
    columns instead of re-expanding the same expression trees."""
    x = x.withColumns({"zt": room_temp(), "vent": ventilation(c("on_KT_Run")), "air": air_yield(p)})
    x = x.withColumn("dT", temp_diff(c("on_KT_Run"), c("zt")))
    return x.withColumn("LL", cooling_output(p, c("air"), c("dT")))


def power_indicator(p: Params) -> Column:
    """J-1 inner: 24-hour energy per square metre per hour."""
    return F.try_divide(c("e_ALL_ZNDB"), c("area") * lit(24.0))


def d1(p: Params) -> Column:
    e = power_indicator(p)
    return F.when((lit(p.power_standard) > e) | (e == 0), lit(100.0)).otherwise(
        lit(100.0) - (e - lit(p.power_standard)) / e * lit(100.0))


def d2(p: Params) -> Column:
    vent = c("vent")
    cons = c("c_ALL_ZNDB")
    return (F.when(vent == 0, lit(0.0))
            .when(cons == 0, lit(100.0))
            .otherwise(score(c("LL") / (cons * lit(3.0)), p.XL_standard)))


def d3(p: Params) -> Column:
    vent = c("vent")
    ll = c("LL")
    return (F.when(vent == 0, lit(0.0))
            .when(ll > lit(p.LL_standard), lit(p.LL_standard) / ll * lit(100.0))
            .otherwise(lit(100.0)))


def d24(p: Params) -> Column:
    vent = c("vent")
    cons = c("c_KT_ZNDB") + c("c_HPF_ZNDB")
    r = (lit(p.air_specificHeat) * lit(p.air_density) * c("air") * c("dT") * lit(p.run_time)) / (
        lit(216000000.0) * cons)
    return (F.when(vent == 0, lit(0.0))
            .when(cons == 0, lit(0.0))
            .otherwise(score(r, p.DKT_standard)))


def d4(p: Params) -> Column:
    gap = lit(p.HFT_standard) - c("zt")
    return F.when(gap > lit(6.0), lit(0.0)).otherwise(lit(100.0) - F.abs(gap) / lit(6.0) * lit(100.0))


def _water_score(p: Params, run: str, meter: str, water: str, std: float) -> Column:
    cons = c(f"c_{meter}")
    r = water_indicator(p, cons, c(f"m_{water}_yield"), c(f"m_{water}_OT"), c(f"m_{water}_IT"))
    return (F.when(c(f"on_{run}") == 0, lit(0.0))
            .when(cons == 0, lit(0.0))
            .otherwise(score(r, std)))


def d5(p: Params) -> Column:
    return _water_score(p, "LSJZ_Run", "LSJZ_ZNDB", "LD", p.LSJZ_standard)


def d10(p: Params) -> Column:
    return _water_score(p, "LDB_Run", "LDB_ZNDB", "LD", p.LD_standard)


def d15(p: Params) -> Column:
    return _water_score(p, "LQB_Run", "LQB_ZNDB", "LQ", p.LQ_standard)


def d20(p: Params) -> Column:
    return _water_score(p, "LT_Run", "LT_ZNDB", "LQ", p.LT_standard)


SCORES = {"d1": d1, "d2": d2, "d3": d3, "d4": d4, "d5": d5, "d10": d10, "d15": d15, "d20": d20, "d24": d24}


def status_columns() -> dict[str, Column]:
    """J-11: d2 = d3 = d24 = ventilation; d4 always 1; d5/d10/d15/d20 own class."""
    vent = c("vent")
    return {
        "d2": vent, "d3": vent, "d4": lit(1.0), "d5": c("on_LSJZ_Run"), "d10": c("on_LDB_Run"),
        "d15": c("on_LQB_Run"), "d20": c("on_LT_Run"), "d24": vent,
    }


def round4(col: Column) -> Column:
    """Round for stable comparison; ``+ 0.0`` folds −0.0 into 0.0."""
    return F.round(col, 4) + lit(0.0)


# ----------------------------------------------------------------------------- job

class Job:
    """What the formulas of one job read, over managed stations and active ticks (within lo..hi).

    ``grid`` (its rows), ``classified`` (points by class) and ``sums`` (class sums of the readings)
    are read several times and are small beside the readings: they are persisted, so each table is
    scanned once.  Nothing runs before a result is asked for.  A job that has written its rows releases them.
    """

    def __init__(self, lines: DataFrame, stations: DataFrame, points: DataFrame, readings: DataFrame,
                 status: DataFrame | None = None, lo: int | None = None, hi: int | None = None, active: DataFrame | None = None):
        managed = P.managed_stations(lines, stations).select("station_abbr", "area")
        self.status = status
        self.classified = P.classify_points(points, stations).persist()
        self.sums = R.tick_sums(readings, self.classified).persist()
        self.grid = R.tick_grid(managed, self.sums, lo, hi, active).persist()

    def release(self) -> None:
        for df in (self.grid, self.sums, self.classified):
            df.unpersist()

    def analog(self) -> DataFrame:
        """station_abbr, seq, area, has, m_*, c_*, e_ALL_ZNDB: every input but the run status."""
        x = R.on_grid(self.grid, self.sums)
        x = R.class_means(x, P.class_sizes(self.classified, MEAN_CLASSES))
        x = R.meter_deltas(x, 1, "c")
        return R.meter_deltas(x, DAY_TICKS, "e", classes=("ALL_ZNDB",))

    def inputs(self) -> DataFrame:
        """Every formula input: ``analog`` and on_*."""
        return S.with_flags(self.analog(), S.run_flags(self.status, self.classified, self.grid))


def inputs(lines: DataFrame, stations: DataFrame, points: DataFrame, readings: DataFrame, status: DataFrame,
           lo: int | None = None, hi: int | None = None) -> DataFrame:
    """Per managed station and active tick: every formula input."""
    return Job(lines, stations, points, readings, status, lo, hi).inputs()


#: Scores that need no run status.
ANALOG_SCORES = ("d1", "d4")


def scores(x: DataFrame, p: Params, names=DAY_COLUMNS) -> DataFrame:
    """(station_abbr, seq, <score>...) unrounded."""
    x = x.withColumn("zt", room_temp()) if set(names) <= set(ANALOG_SCORES) else with_intermediates(x, p)
    return x.select("station_abbr", "seq", *[SCORES[n](p).alias(n) for n in names])


def kpi_real_status(x: DataFrame, p: Params) -> DataFrame:
    """(station_abbr, seq, d1, d2..d24, st_d2..st_d24) unrounded — KPI_real + hisstatus + d1."""
    st = status_columns()
    x = with_intermediates(x, p)
    return x.select("station_abbr", "seq", *[SCORES[n](p).alias(n) for n in DAY_COLUMNS],
                    *[st[n].alias(f"st_{n}") for n in KPI_COLUMNS])


def kpi_day(real_status: DataFrame) -> DataFrame:
    """J-13: Σ over the 72 ticks ending at t of d_k / Σ of its status; 0 when that is 0.

    A range frame on the integer tick number, so missing ticks shrink the
    window instead of stretching it.  d1 is taken as is.
    """
    w = Window.partitionBy("station_abbr").orderBy("seq").rangeBetween(-(DAY_TICKS - 1), 0)
    cols = [F.col("d1").alias("d1")]
    for n in KPI_COLUMNS:
        den = F.sum(f"st_{n}").over(w)
        cols.append(F.when(den == 0, lit(0.0)).otherwise(F.sum(n).over(w) / den).alias(n))
    return real_status.select("station_abbr", "seq", *cols)


def present(df: DataFrame, cols) -> DataFrame:
    """Output form: station_abbr, kpi_time (14-digit text), rounded doubles."""
    return df.select("station_abbr", tick_text(seq_to_tick("seq")).alias("kpi_time"),
                     *[round4(F.col(x)).alias(x) for x in cols])


def trailing_sums(real_status: DataFrame) -> DataFrame:
    """E-2 / D-7: per (station, tick) the sums of the stored rows of the previous
    71 ticks (the history part of the day score); absent → 0."""
    w = Window.partitionBy("station_abbr").orderBy("seq").rangeBetween(-(DAY_TICKS - 1), -1)
    cols = [F.coalesce(F.sum(n).over(w), lit(0.0)).alias(f"sum_{n}") for n in KPI_COLUMNS]
    cols += [F.coalesce(F.sum(f"st_{n}").over(w), lit(0.0)).alias(f"sum_st_{n}") for n in KPI_COLUMNS]
    return real_status.select("station_abbr", "seq", *cols)


def last_seq(df: DataFrame) -> int:
    """Newest tick number present (one small aggregate job)."""
    return int(df.agg(F.max("seq")).first()[0])


def rehandle(world: dict[str, DataFrame], p: Params, tick: str) -> DataFrame:
    """J-15: the day scores of one past tick (14 digits), reading only the ticks it depends on.

    The day score at t averages ticks t-71..t; each of those needs uploads at s, s-1 and s-72 and
    status rows after s-72, so ticks t-143..t are read, named as literals on date and tick.
    """
    from voltrail.operators.job import between_ticks, status_before
    target = tick_number(tick)
    lo = target - 2 * DAY_TICKS + 1
    x = inputs(world["lines"], world["stations"], world["points"], between_ticks(world["readings"], lo, target),
               status_before(world["status"], lo, target), lo=lo, hi=target)
    rows = kpi_real_status(x, p).filter(F.col("seq") > target - DAY_TICKS)
    return kpi_day(rows).filter(F.col("seq") == target)

"""Job parameters and the point-name classification patterns.

Parameters are a frozen dataclass; the layered ``settings`` over ``defaults``
lookup of the original job (A-16) is available both as a pure-Python helper
(``Params.from_layers``) and as a DataFrame operator (``params_overlay``) for
parameter tables that live in storage.
"""

from __future__ import annotations

from dataclasses import dataclass, fields, replace

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

# --- fixed values: point-name LIKE patterns, in their configured order --------
# (class name, LIKE pattern).  `_` matches exactly one character, `%` any run;
# `_` is deliberately never escaped.
PATTERNS: tuple[tuple[str, str], ...] = (
    ("LSJZ_Run", "LSJZ___i%Run_St"),
    ("LSJZ_ZNDB", "ZNDB_LS___Wp_Tm"),
    ("LDB_Run", "LDB___i%Run_St"),
    ("LDB_ZNDB", "ZNDB_LD___Wp_Tm"),
    ("LQB_Run", "LQB___i%Run_St"),
    ("LQB_ZNDB", "ZNDB_LQ___Wp_Tm"),
    ("LT_Run", "LQT___i%Run_St"),
    ("LT_ZNDB", "ZNDB_LT___Wp_Tm"),
    ("KT_Run", "KT____iRun_St"),
    ("KT_ZNDB", "ZNDB_KT____Wp_Tm"),
    ("KT_Hz", "KT____FreqFB_Hz"),
    ("HPF_Run", "HPF____iRun_St"),
    ("HPF_ZNDB", "ZNDB_HPF____Wp_Tm"),
    ("HPF_Hz", "HPF____FreqFB_Hz"),
    ("HF_T", "TH_HFD____Temp_Tm"),
    ("SF_T", "TH_SFD____Temp_Tm"),
    ("XF_T", "TH_SWD____Temp_Tm"),
    ("ZTX_T", "TH_ZTX_____Temp_Tm"),
    ("ZTS_T", "TH_ZTS_____Temp_Tm"),
    ("LD_yield", "FT_LDD_0__Ft_Tm"),
    ("LD_IT", "TE_LDJD_01_Temp_Tm"),
    ("LD_OT", "TE_LDCD_01_Temp_Tm"),
    ("LQ_yield", "FT_LQD_0__Ft_Tm"),
    ("LQ_IT", "TE_LQJD_01_Temp_Tm"),
    ("LQ_OT", "TE_LQCD_01_Temp_Tm"),
    ("ALL_ZNDB", "ZNDB%Wp_Tm"),
)
# ------------------------------------------------------------------------------

CLASS_NAMES: tuple[str, ...] = tuple(name for name, _ in PATTERNS)

# Classes read as run status (YX, "any latest value is '1'").
RUN_CLASSES = ("LSJZ_Run", "LDB_Run", "LQB_Run", "LT_Run", "KT_Run", "HPF_Run")
# Classes read as meters (difference of two instants).
METER_CLASSES = ("LSJZ_ZNDB", "LDB_ZNDB", "LQB_ZNDB", "LT_ZNDB", "KT_ZNDB", "HPF_ZNDB", "ALL_ZNDB")
# Classes read as instant means (HF_T is read by the original job but never used).
MEAN_CLASSES = (
    "KT_Hz", "HPF_Hz", "SF_T", "XF_T", "ZTX_T", "ZTS_T",
    "LD_yield", "LD_IT", "LD_OT", "LQ_yield", "LQ_IT", "LQ_OT",
)
# Classes whose readings feed the per-(station, tick) aggregate.
READING_CLASSES = METER_CLASSES + MEAN_CLASSES

# KPI columns of the real-time and status tables, in stored order; the day
# table adds d1 in front.
KPI_COLUMNS = ("d2", "d3", "d4", "d5", "d10", "d15", "d20", "d24")
DAY_COLUMNS = ("d1",) + KPI_COLUMNS

TICK_SECONDS = 1200          # one tick = 20 minutes
DAY_TICKS = 72               # 24 hours = 72 ticks


@dataclass(frozen=True)
class Params:
    """Scoring parameters.  Defaults are the shipped configuration values."""

    # fixed values: shipped setup / standard / physical constants
    KT_F: float = 0.0                # supply fans, total 50 Hz air volume
    HPF_F: float = 0.0               # exhaust fans, total 50 Hz air volume
    run_time: float = 20.0           # minutes per tick
    LSJZ_standard: float = 5.0       # chiller COP
    LD_standard: float = 5.0         # chilled-water transport
    LQ_standard: float = 5.0         # cooling-water transport
    LT_standard: float = 5.0         # cooling tower
    DKT_standard: float = 5.0        # air-side terminal
    LL_standard: float = 300.0       # cooling amount
    power_standard: float = 0.0      # energy per square metre
    XL_standard: float = 0.7         # efficiency
    HFT_standard: float = 28.0       # return-air temperature
    water_specificHeat: float = 4182.0
    water_density: float = 1000.0
    air_specificHeat: float = 1004.0
    air_density: float = 1.205

    @classmethod
    def from_layers(cls, defaults: dict[str, str], settings: dict[str, str] | None = None) -> "Params":
        """``settings`` value if present, else ``defaults`` value, else the field default."""
        settings = settings or {}
        kw = {}
        for f in fields(cls):
            raw = settings.get(f.name, defaults.get(f.name))
            if raw is not None:
                kw[f.name] = float(raw)
        return cls(**kw)

    def with_overrides(self, **kw: float) -> "Params":
        return replace(self, **kw)

    def as_dict(self) -> dict[str, float]:
        return {f.name: float(getattr(self, f.name)) for f in fields(self)}


# The shipped fan volumes and energy standard are zero, which makes d1/d2/d3/d24
# degenerate; fixtures use these non-zero values instead.
FIXTURE_PARAMS = Params(KT_F=100000.0, HPF_F=80000.0, power_standard=0.05)


def patterns_df(spark: SparkSession) -> DataFrame:
    """The 26 classification patterns as a tiny DataFrame (cls, pattern, cls_idx)."""
    # Built from literals on the JVM side (no Python rows to ship).
    items = ", ".join(f"named_struct('cls', '{name}', 'pattern', '{pat}', 'cls_idx', {i})"
                      for i, (name, pat) in enumerate(PATTERNS))
    return spark.range(1).select(F.inline(F.expr(f"array({items})")))


def params_overlay(defaults: DataFrame, settings: DataFrame) -> DataFrame:
    """A-16 on tables: (key, value) defaults overlaid by (key, value) settings.

    Returns (key, value, source) with the settings value where present.  Both
    inputs are key/value property tables; the result keeps every default key
    plus settings-only keys.
    """
    d = defaults.select(F.col("key"), F.col("value").alias("d_value"))
    s = settings.select(F.col("key"), F.col("value").alias("s_value"))
    return (
        d.join(s, "key", "full_outer")
        .select(
            "key",
            F.coalesce("s_value", "d_value").alias("value"),
            F.when(F.col("s_value").isNotNull(), F.lit("settings"))
            .otherwise(F.lit("defaults")).alias("source"),
        )
    )


# ------------------------------------------------------------------ parameters that change over time

class ParamColumns:
    """Stands for ``Params`` in the formulas: each parameter is the row's column ``p_<name>``."""

    def __getattr__(self, name: str) -> Column:
        if name not in {f.name for f in fields(Params)}:
            raise AttributeError(name)
        return F.col(f"p_{name}")


def params_at(ticks: DataFrame, defaults: DataFrame, settings: DataFrame, base: Params | None = None) -> DataFrame:
    """A-16 over time: (seq, p_<name> ...), the parameters that hold at each of the distinct tick numbers ``seq``.

    Both layers are (key, value, valid_from).  A row counts from the first tick at its time or after until the next of its key;
    settings go before defaults, and ``base`` holds where neither has a value.  Of rows of one key that count from the
    same tick the newest is taken, of equal ones the greater value; a value that is no number, and a key that names
    no parameter, count as none.  The window runs over ticks and changes, not over readings.
    """
    base = (base or Params()).as_dict()

    def changes(layer: DataFrame, mark: str) -> DataFrame:
        micros = F.unix_micros(F.col("valid_from").cast("timestamp"))
        rows = layer.select("key", F.col("value").try_cast("double").alias("v"), micros.alias("us")).where(F.col("key").isin(*base) & F.col("v").isNotNull())
        rows = rows.withColumn("seq", F.ceil(F.col("us") / F.lit(TICK_SECONDS * 1_000_000)).cast("bigint"))
        return rows.groupBy("seq").agg(*[F.max(F.when(F.col("key") == n, F.struct("us", "v")))["v"].alias(f"{mark}_{n}") for n in base])

    asked = ticks.select("seq", F.lit(1).alias("ask"))
    rows = asked.unionByName(changes(defaults, "d"), allowMissingColumns=True).unionByName(changes(settings, "s"), allowMissingColumns=True)
    w = Window.orderBy("seq", F.coalesce("ask", F.lit(0))).rowsBetween(Window.unboundedPreceding, Window.currentRow)

    def last(c: str) -> Column:
        return F.last(c, ignorenulls=True).over(w)
    held = rows.select("seq", "ask", *[F.coalesce(last(f"s_{n}"), last(f"d_{n}"), F.lit(v)).alias(f"p_{n}") for n, v in base.items()])
    return held.where(F.col("ask") == 1).drop("ask")

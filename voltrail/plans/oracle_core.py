"""DuckDB oracle SQL: fixture views and the KPI pipeline, written independently.

The oracle uses other formulations than the Spark plan (self-joins on tick − 1 / − 72, an as-of join
for the 24-hour status look-back), so agreement checks the plan against the definition.  Parts that
are read more than once are MATERIALIZED.
Every numeric literal is a DOUBLE cast, so DuckDB does not fall back to
DECIMAL arithmetic.
"""

from __future__ import annotations

import re

from voltrail.params import (DAY_COLUMNS, FIXTURE_PARAMS, KPI_COLUMNS, MEAN_CLASSES, METER_CLASSES,
                             PATTERNS, READING_CLASSES, RUN_CLASSES, Params)
from voltrail.plans.fixtures import CATALOG, N_STATIONS


def D(x: float | str) -> str:
    """A double literal; a text is a column's name."""
    return x if isinstance(x, str) else f"CAST({float(x)!r} AS DOUBLE)"


def R4(expr: str) -> str:
    """Round half-up on the shortest decimal form of the double — what Spark's
    ``round`` does — rather than on the scaled binary value."""
    return f"(CAST(round(CAST(CAST({expr} AS VARCHAR) AS DECIMAL(38,18)), 4) AS DOUBLE) + {D(0)})"


def TICK_TEXT(seq: str) -> str:
    return f"strftime(make_timestamp(({seq}) * 1200 * 1000000), '%Y%m%d%H%M%S')"


def _catalog_sql() -> str:
    items = ", ".join(
        f"{{'control_id': {cid}, 'point_name': '{name}', 'type': '{typ}', 'fam': {fam}}}"
        for cid, name, typ, fam in CATALOG)
    return f"[{items}]"


def _patterns_sql() -> str:
    rows = ", ".join(f"('{n}', '{p}')" for n, p in PATTERNS)
    return f"SELECT * FROM (VALUES {rows}) AS t(cls, pattern)"


_VALUE = f"""CASE WHEN (u.k * 5 + p.control_id * 3 + u.e) % (CASE WHEN p.fam = 6 THEN 211 ELSE 23 END) = 0 THEN '\\N'
 WHEN p.fam = 6 THEN CAST((u.seq - 1420000) * (10 + u.k % 5 + p.control_id % 3) + u.e % 7 AS VARCHAR)
 WHEN p.fam = 7 THEN CAST(30 + (u.k + u.e + p.control_id) % 20 AS VARCHAR)
 WHEN p.fam = 8 THEN CAST(24 + (u.k + u.e) % 9 AS VARCHAR)
 WHEN p.fam = 9 THEN CAST(16 + (u.k + u.e) % 5 AS VARCHAR)
 WHEN p.fam = 10 THEN CAST(18 + (u.k + u.e) % 8 AS VARCHAR)
 WHEN p.fam = 11 THEN CAST(20 + (u.k + u.e) % 40 AS VARCHAR)
 WHEN p.fam = 12 THEN CAST(7 + (u.k + u.e) % 3 AS VARCHAR)
 ELSE CAST(11 + (u.k + u.e) % 4 AS VARCHAR) END"""


def _sums_sql() -> str:
    cols = ",\n ".join(
        f"COALESCE(SUM(CASE WHEN c.cls = '{cl}' THEN COALESCE(TRY_CAST(r.value AS DOUBLE), {D(0)}) END), {D(0)}) AS s_{cl}"
        for cl in READING_CLASSES)
    return f"""SELECT r.station_abbr, r.seq,
 {cols}
FROM fx_reading r LEFT JOIN classified c ON c.station_abbr = r.station_abbr AND c.control_id = r.control_id
WHERE r.station_abbr IN (SELECT station_abbr FROM managed)
GROUP BY r.station_abbr, r.seq"""


def _x_sql() -> str:
    both = "s.seq IS NOT NULL AND {p}.seq IS NOT NULL"
    means = ",\n ".join(
        f"CASE WHEN COALESCE(z.n_{cl}, 0) > 0 AND s.seq IS NOT NULL THEN s.s_{cl} / z.n_{cl} ELSE {D(0)} END AS m_{cl}" for cl in MEAN_CLASSES)
    d20 = ",\n ".join(
        f"CASE WHEN {both.format(p='p1')} THEN s.s_{cl} - p1.s_{cl} ELSE {D(0)} END AS c_{cl}" for cl in METER_CLASSES)
    d24 = ",\n ".join(
        f"CASE WHEN {both.format(p='p72')} THEN s.s_{cl} - p72.s_{cl} ELSE {D(0)} END AS e_{cl}" for cl in METER_CLASSES)
    return f"""SELECT g.station_abbr, g.seq, g.area,
 {means},
 {d20},
 {d24}
FROM grid g LEFT JOIN sums s ON s.station_abbr = g.station_abbr AND s.seq = g.seq
LEFT JOIN sizes z ON z.station_abbr = g.station_abbr
LEFT JOIN sums p1 ON p1.station_abbr = g.station_abbr AND p1.seq = g.seq - 1
LEFT JOIN sums p72 ON p72.station_abbr = g.station_abbr AND p72.seq = g.seq - 72"""


def _flags_sql() -> str:
    cols = ",\n ".join(
        f"COALESCE(MAX(CASE WHEN r.cls = '{cl}' THEN p.on_ END), 0) AS on_{cl}" for cl in RUN_CLASSES)
    return f"""SELECT p.station_abbr, p.seq,
 {cols}
FROM pon p JOIN runp r ON r.station_abbr = p.station_abbr AND r.id = p.id
GROUP BY p.station_abbr, p.seq"""


def _xin_sql() -> str:
    cols = ", ".join(f"CAST(COALESCE(f.on_{cl}, 0) AS DOUBLE) AS on_{cl}" for cl in RUN_CLASSES)
    return f"""SELECT x.*, {cols}
FROM x LEFT JOIN flags f ON f.station_abbr = x.station_abbr AND f.seq = x.seq"""


def _sizes_sql() -> str:
    cols = ", ".join(f"COUNT(CASE WHEN cls = '{cl}' THEN 1 END) AS n_{cl}" for cl in MEAN_CLASSES)
    return f"SELECT station_abbr, {cols} FROM classified GROUP BY station_abbr"


# name -> (sql, deps)
CTES: dict[str, tuple[str, tuple[str, ...]]] = {
    "fx_line": ("""SELECT r_name AS line_name, 'l' || chr(CAST(97 + r_regionkey AS INTEGER)) AS line_abbr,
 'P' AS project_name, 'metro' AS description,
 CAST(CASE WHEN r_regionkey = 4 THEN 0 ELSE 1 END AS INTEGER) AS energy_mgr FROM region""", ()),
    "fx_station": ("""SELECT CAST(n_nationkey AS INTEGER) AS k, n_name AS station_name,
 's' || chr(CAST(97 + n_nationkey AS INTEGER)) AS station_abbr, r_name AS line_name, 'metro' AS description,
 CAST(500 + 20 * n_nationkey AS DOUBLE) AS area,
 CAST(CASE WHEN n_nationkey % 7 = 3 THEN 0 ELSE 1 END AS INTEGER) AS energy_mgr,
 CAST(CASE WHEN n_nationkey % 5 = 0 THEN 1 ELSE 0 END AS INTEGER) AS transfer
FROM nation JOIN region ON n_regionkey = r_regionkey""", ()),
    "fx_point": (f"""SELECT k, line_name, station_name, station_abbr,
 unnest({_catalog_sql()}, recursive := true) FROM fx_station""", ("fx_station",)),
    "fx_upload": (f"""SELECT CAST(user_id % {N_STATIONS} AS INTEGER) AS k, CAST(floor(epoch_us(ts) / 1200000000) AS BIGINT) AS seq,
 max(event_id) AS e FROM events GROUP BY 1, 2""", ()),
    "fx_reading": (f"""SELECT p.station_abbr, u.seq, p.control_id, {_VALUE} AS value
FROM fx_upload u JOIN fx_point p ON p.k = u.k WHERE p.type = 'YC'""", ("fx_upload", "fx_point")),
    "fx_status": (f"""SELECT 's' || chr(CAST(97 + user_id % {N_STATIONS} AS INTEGER)) AS station_abbr,
 CAST(event_id % 8 AS INTEGER) AS id, ts,
 CASE WHEN (event_id % 7 + user_id) % 3 = 0 THEN '0' ELSE '1' END AS value FROM events""", ()),
    "managed": ("""SELECT s.line_name, l.line_abbr, s.station_name, s.station_abbr, s.area
FROM fx_station s JOIN fx_line l ON s.line_name = l.line_name
WHERE s.energy_mgr = 1 AND l.energy_mgr = 1""", ("fx_station", "fx_line")),
    "pat": (_patterns_sql(), ()),
    "classified": ("""SELECT p.line_name, p.station_name, s.station_abbr, p.point_name, p.type, p.control_id, pat.cls
FROM fx_point p JOIN fx_station s ON p.line_name = s.line_name AND p.station_name = s.station_name
JOIN pat ON p.point_name LIKE pat.pattern""", ("fx_point", "fx_station", "pat")),
    "sums": (_sums_sql(), ("fx_reading", "classified", "managed")),
    "sizes": (_sizes_sql(), ("classified",)),
    "active": ("""SELECT DISTINCT seq + k AS seq FROM (SELECT DISTINCT seq FROM fx_reading), (VALUES (0), (1), (72)) AS o(k)""",
               ("fx_reading",)),
    "grid": ("SELECT m.station_abbr, m.area, a.seq FROM managed m, active a", ("managed", "active")),
    "x": (_x_sql(), ("sums", "grid", "sizes")),
    "runp": (f"""SELECT station_abbr, control_id AS id, cls FROM classified
WHERE cls IN ({", ".join(repr(c) for c in RUN_CLASSES)})""", ("classified",)),
    "changes": ("""SELECT st.station_abbr, st.id, epoch_us(st.ts) AS us, max(CASE WHEN st.value = '1' THEN 1 ELSE 0 END) AS on_
FROM fx_status st GROUP BY 1, 2, 3""", ("fx_status",)),
    "asked": ("""SELECT g.station_abbr, g.seq, r.id, g.seq * 1200000000 AS us
FROM grid g JOIN (SELECT DISTINCT station_abbr, id FROM runp) r ON r.station_abbr = g.station_abbr""", ("grid", "runp")),
    "pon": ("""SELECT a.station_abbr, a.seq, a.id, CASE WHEN c.us > (a.seq - 72) * 1200000000 THEN c.on_ ELSE 0 END AS on_
FROM asked a ASOF JOIN changes c ON c.station_abbr = a.station_abbr AND c.id = a.id AND c.us < a.us""", ("asked", "changes")),
    "flags": (_flags_sql(), ("pon", "runp")),
    "xin": (_xin_sql(), ("x", "flags")),
}


def with_ctes(final: str, needs: tuple[str, ...], extra: dict[str, tuple[str, tuple[str, ...]]] | None = None) -> str:
    """``WITH`` the transitive closure of ``needs`` (in dependency order) + ``final``."""
    defs = dict(CTES)
    if extra:
        defs.update(extra)
    order: list[str] = []

    def visit(n: str) -> None:
        if n in order:
            return
        for d in defs[n][1]:
            visit(d)
        order.append(n)

    for n in needs:
        visit(n)
    texts = [defs[n][0] for n in order] + [final]
    read = {n: sum(len(re.findall(rf"\b{n}\b", t)) for t in texts) for n in order}
    body = ",\n".join(f"{n} AS {'MATERIALIZED ' if read[n] > 1 else ''}(\n{defs[n][0]}\n)" for n in order)
    return f"WITH {body}\n{final}"


# ------------------------------------------------------------------ formulas (SQL)

def sql_formulas(p: Params = FIXTURE_PARAMS) -> dict[str, str]:
    zt = "((m_ZTX_T + m_ZTS_T) / CAST(2.0 AS DOUBLE))"
    vent = "(CASE WHEN on_KT_Run = 1 THEN CAST(1.0 AS DOUBLE) ELSE on_HPF_Run END)"
    air = f"(m_KT_Hz / {D(50)} * {D(p.KT_F)} + m_HPF_Hz / {D(50)} * {D(p.HPF_F)})"
    dt = f"(CASE WHEN on_KT_Run = 0 THEN {zt} - m_XF_T ELSE {zt} - m_SF_T END)"
    ll = f"({D(p.air_specificHeat)} * {D(p.air_density)} * {air} * {dt} / {D(3600000)})"

    def score(r: str, std: float) -> str:
        return f"(CASE WHEN {r} > {D(std)} THEN {D(100)} ELSE {r} / {D(std)} * {D(100)} END)"

    def water(run: str, meter: str, w: str, std: float) -> str:
        cons = f"c_{meter}"
        r = (f"(({D(p.water_specificHeat)} * {D(p.water_density)} * m_{w}_yield * (m_{w}_OT - m_{w}_IT) * {D(p.run_time)})"
             f" / ({D(216000000)} * {cons}))")
        return (f"(CASE WHEN on_{run} = 0 THEN {D(0)} WHEN {cons} = 0 THEN {D(0)} ELSE {score(r, std)} END)")

    e = f"(CASE WHEN area * {D(24)} = 0 THEN NULL ELSE e_ALL_ZNDB / (area * {D(24)}) END)"
    d1 = (f"(CASE WHEN {D(p.power_standard)} > {e} OR {e} = 0 THEN {D(100)} "
          f"ELSE {D(100)} - ({e} - {D(p.power_standard)}) / {e} * {D(100)} END)")
    d2 = (f"(CASE WHEN {vent} = 0 THEN {D(0)} WHEN c_ALL_ZNDB = 0 THEN {D(100)} "
          f"ELSE {score(f'({ll} / (c_ALL_ZNDB * {D(3)}))', p.XL_standard)} END)")
    d3 = (f"(CASE WHEN {vent} = 0 THEN {D(0)} WHEN {ll} > {D(p.LL_standard)} THEN {D(p.LL_standard)} / {ll} * {D(100)} "
          f"ELSE {D(100)} END)")
    cons24 = "(c_KT_ZNDB + c_HPF_ZNDB)"
    r24 = (f"(({D(p.air_specificHeat)} * {D(p.air_density)} * {air} * {dt} * {D(p.run_time)}) / "
           f"({D(216000000)} * {cons24}))")
    d24 = (f"(CASE WHEN {vent} = 0 THEN {D(0)} WHEN {cons24} = 0 THEN {D(0)} ELSE {score(r24, p.DKT_standard)} END)")
    gap = f"({D(p.HFT_standard)} - {zt})"
    d4 = f"(CASE WHEN {gap} > {D(6)} THEN {D(0)} ELSE {D(100)} - abs({gap}) / {D(6)} * {D(100)} END)"
    return {
        "zt": zt, "vent": vent, "air": air, "dt": dt, "ll": ll,
        "d1": d1, "d2": d2, "d3": d3, "d4": d4,
        "d5": water("LSJZ_Run", "LSJZ_ZNDB", "LD", p.LSJZ_standard),
        "d10": water("LDB_Run", "LDB_ZNDB", "LD", p.LD_standard),
        "d15": water("LQB_Run", "LQB_ZNDB", "LQ", p.LQ_standard),
        "d20": water("LT_Run", "LT_ZNDB", "LQ", p.LT_standard),
        "d24": d24,
        "water_ld": (f"(CASE WHEN c_LSJZ_ZNDB = 0 THEN {D(0)} ELSE ({D(p.water_specificHeat)} * {D(p.water_density)}"
                     f" * m_LD_yield * (m_LD_OT - m_LD_IT) * {D(p.run_time)}) / ({D(216000000)} * c_LSJZ_ZNDB) END)"),
    }


def sql_status() -> dict[str, str]:
    vent = "(CASE WHEN on_KT_Run = 1 THEN CAST(1.0 AS DOUBLE) ELSE on_HPF_Run END)"
    return {"d2": vent, "d3": vent, "d4": D(1), "d5": "on_LSJZ_Run", "d10": "on_LDB_Run",
            "d15": "on_LQB_Run", "d20": "on_LT_Run", "d24": vent}


def kpi_rs_cte(p: Params = FIXTURE_PARAMS) -> dict[str, tuple[str, tuple[str, ...]]]:
    f = sql_formulas(p)
    st = sql_status()
    cols = ",\n ".join([f"{f[n]} AS {n}" for n in DAY_COLUMNS] + [f"{st[n]} AS st_{n}" for n in KPI_COLUMNS])
    rs = f"SELECT station_abbr, seq,\n {cols}\nFROM xin"
    win = "OVER (PARTITION BY station_abbr ORDER BY seq RANGE BETWEEN 71 PRECEDING AND CURRENT ROW)"
    day_cols = ",\n ".join(
        ["d1"] + [f"CASE WHEN SUM(st_{n}) {win} = 0 THEN {D(0)} ELSE SUM({n}) {win} / SUM(st_{n}) {win} END AS {n}"
                  for n in KPI_COLUMNS])
    day = f"SELECT station_abbr, seq,\n {day_cols}\nFROM kpi_rs"
    return {"kpi_rs": (rs, ("xin",)), "kpi_dayt": (day, ("kpi_rs",))}


def present(src: str, cols, where: str = "") -> str:
    sel = ", ".join(f"{R4(c)} AS {c}" for c in cols)
    return f"SELECT station_abbr, {TICK_TEXT('seq')} AS kpi_time, {sel} FROM {src} {where}"

"""Registered queries: status/reading scans, codec, predicates and small SQL surface."""

from __future__ import annotations

from pyspark.sql import functions as F

from voltrail.functions import codec as C
from voltrail.functions.ticks import seq_to_tick, shift_ticks, tick_floor, tick_seq, tick_text
from voltrail.operators import basics as B
from voltrail.operators import job as JOB
from voltrail.operators import keyfilter as KF
from voltrail.operators import points as P
from voltrail.operators import status as S
from voltrail.params import DAY_TICKS
from voltrail.plans import fixtures as fx
from voltrail.plans.oracle_core import R4, TICK_TEXT, with_ctes
from voltrail.plans.q_kpi import world
from voltrail.plans.registry import register
from voltrail.session import scratch_path

TS_FMT_SPARK = "yyyy-MM-dd HH:mm:ss.SSSSSS"
TS_FMT_DUCK = "%Y-%m-%d %H:%M:%S.%f"


def _ts_text(col):
    return F.date_format(col, TS_FMT_SPARK)


# ------------------------------------------------------------------ status log

@register("latest_state", with_ctes(
    f"""SELECT s.station_abbr, s.id, strftime(s.ts, '{TS_FMT_DUCK}') AS ts, s.value
FROM fx_status s JOIN (SELECT station_abbr, id, max(ts) AS mt FROM fx_status GROUP BY station_abbr, id) m
 ON s.station_abbr = m.station_abbr AND s.id = m.id AND s.ts = m.mt""", ("fx_status",)), "D-1", "E-1", "F-3")
def q_latest_state(spark, sf_dir):
    st = world(spark, sf_dir)["status"]
    return S.latest_state(st).select("station_abbr", "id", _ts_text("ts").alias("ts"), "value")


_END_TICK_SQL = "(SELECT max(floor(epoch_us(ts) / 1200000000)) FROM fx_status)"


@register("scan_status_window", with_ctes(
    f"""SELECT station_abbr, id, strftime(ts, '{TS_FMT_DUCK}') AS ts, value FROM fx_status
WHERE epoch_us(ts) > ({_END_TICK_SQL} - 72) * 1200000000 AND epoch_us(ts) < {_END_TICK_SQL} * 1200000000""",
    ("fx_status",)), "A-9", "C-10")
def q_scan_status_window(spark, sf_dir):
    st = world(spark, sf_dir)["status"]
    # endTime = the newest tick of the log; the window is (endTime − 24 h, endTime).
    end = st.agg(F.max(tick_seq("ts"))).first()[0]
    hi, lo = seq_to_tick(F.lit(end)), seq_to_tick(F.lit(end - DAY_TICKS))
    return (st.filter((F.col("ts") > lo) & (F.col("ts") < hi))
            .select("station_abbr", "id", _ts_text("ts").alias("ts"), "value"))


@register("status_by_class", with_ctes(
    f"""SELECT r.station_abbr, r.cls, s.id, strftime(s.ts, '{TS_FMT_DUCK}') AS ts, s.value
FROM fx_status s JOIN runp r ON r.station_abbr = s.station_abbr AND r.id = s.id""",
    ("fx_status", "runp")), "D-5", "C-7")
def q_status_by_class(spark, sf_dir):
    w = world(spark, sf_dir)
    rp = S.run_points(P.classify_points(w["points"], w["stations"]))
    return S.status_of_class(w["status"], rp).select(
        "station_abbr", "cls", "id", _ts_text("ts").alias("ts"), "value")


# ------------------------------------------------------------------ readings

_MAX_SEQ_SQL = "(SELECT max(seq) FROM fx_reading)"


@register("scan_analog_instants", with_ctes(
    f"""SELECT station_abbr, {TICK_TEXT('seq')} AS kpi_time, control_id,
 COALESCE(TRY_CAST(value AS DOUBLE), CAST(0 AS DOUBLE)) AS v FROM fx_reading
WHERE seq IN ({_MAX_SEQ_SQL}, {_MAX_SEQ_SQL} - 1, {_MAX_SEQ_SQL} - 72)""", ("fx_reading",)), "A-8", "C-8", "I-8")
def q_scan_analog_instants(spark, sf_dir):
    rd = world(spark, sf_dir)["readings"]
    end = rd.agg(F.max("seq")).first()[0]
    return (JOB.at_ticks(rd, [end - DAY_TICKS, end - 1, end])
            .select("station_abbr", tick_text("tick").alias("kpi_time"), "control_id",
                    C.clean_value("value").alias("v")))


_METER_IDS = tuple(cid for cid, name, typ, _ in fx.CATALOG if name.startswith("ZNDB"))


@register("dynamic_projection", with_ctes(
    f"SELECT r.station_abbr, {TICK_TEXT('r.seq')} AS kpi_time, "
    + ", ".join(f"COALESCE(MAX(CASE WHEN r.control_id = {i} THEN r.value END), '0') AS id_{i}" for i in _METER_IDS)
    + """ FROM fx_reading r JOIN (SELECT station_abbr, control_id FROM classified WHERE cls = 'ALL_ZNDB') c
 ON c.station_abbr = r.station_abbr AND c.control_id = r.control_id GROUP BY r.station_abbr, r.seq""",
    ("fx_reading", "classified")), "C-2", "D-4")
def q_dynamic_projection(spark, sf_dir):
    w = world(spark, sf_dir)
    cl = P.classify_points(w["points"], w["stations"]).filter(F.col("cls") == "ALL_ZNDB")
    wide = B.wide_view(w["readings"], cl)
    return wide.select("station_abbr", tick_text(seq_to_tick("seq")).alias("kpi_time"),
                       *[c for c in wide.columns if c.startswith("id_")])


@register("key_regex_filter", with_ctes(
    f"""SELECT k.key, k.control_id, k.value FROM (
 SELECT station_abbr || {TICK_TEXT('seq')} AS key, control_id, value FROM fx_reading) k,
 (SELECT '.*(' || {TICK_TEXT('m - 72')} || '|' || {TICK_TEXT('m - 1')} || '|' || {TICK_TEXT('m')} || '){{1}}' AS rx
  FROM (SELECT max(seq) AS m FROM fx_reading)) q
WHERE regexp_matches(k.key, q.rx)""", ("fx_reading",)), "C-14", "I-4")
def q_key_regex_filter(spark, sf_dir):
    rd = world(spark, sf_dir)["readings"]
    end = rd.agg(F.max("seq")).first()[0]
    found = KF.key_filter(rd, B.instants_expression([B.seq_text(end - DAY_TICKS), B.seq_text(end - 1), B.seq_text(end)]))
    return found.select(C.key_encode("station_abbr", tick_text("tick")).alias("key"), "control_id", "value")


# Mornings of the newest two days at some stations, of a table of uploads partitioned by day.
@register("key_expression_scan", with_ctes(
    f"""SELECT k.station_abbr, k.kpi_time, k.n_values FROM
 (SELECT station_abbr, {TICK_TEXT('seq')} AS kpi_time, COUNT(*) AS n_values FROM fx_reading GROUP BY station_abbr, seq) k,
 (SELECT '^s[b-k](' || substring({TICK_TEXT('m - 72')}, 1, 8) || '|' || substring({TICK_TEXT('m')}, 1, 8) || ')(0[0-9]|1[01])[0-9]{{4}}$' AS rx
  FROM (SELECT max(seq) AS m FROM fx_reading)) q
WHERE regexp_matches(k.station_abbr || k.kpi_time, q.rx)""", ("fx_reading",)), "C-14", "A-8", "I-4")
def q_key_expression_scan(spark, sf_dir):
    rd = world(spark, sf_dir)["readings"]
    uploads = rd.groupBy("station_abbr", "tick").agg(F.count(F.lit(1)).alias("n_values")).withColumn("date", F.to_date("tick"))
    path = scratch_path(spark, "uploads")
    uploads.repartition("date").write.partitionBy("date").parquet(path)
    stored = spark.read.schema(uploads.schema).parquet(path)
    end = stored.agg(F.max(tick_seq("tick"))).first()[0]
    days = "|".join(B.seq_text(s)[:8] for s in (end - DAY_TICKS, end))
    found = KF.key_filter(stored, f"^s[b-k]({days})(0[0-9]|1[01])[0-9]{{4}}$")
    return found.select("station_abbr", tick_text("tick").alias("kpi_time"), "n_values")


@register("clean_reading", with_ctes(
    f"""SELECT station_abbr, {TICK_TEXT('seq')} AS kpi_time, control_id, value,
 COALESCE(TRY_CAST(value AS DOUBLE), CAST(0 AS DOUBLE)) AS v FROM fx_reading""", ("fx_reading",)), "I-8")
def q_clean_reading(spark, sf_dir):
    rd = world(spark, sf_dir)["readings"]
    return rd.select("station_abbr", tick_text("tick").alias("kpi_time"), "control_id", "value",
                     C.clean_value("value").alias("v"))


# ------------------------------------------------------------------ time and codec

@register("tick_floor", """SELECT event_id,
 strftime(ts, '%Y%m%d%H%M%S') AS ts_text,
 strftime(time_bucket(INTERVAL 20 MINUTES, ts), '%Y%m%d%H%M%S') AS end_time,
 strftime(time_bucket(INTERVAL 20 MINUTES, ts) - INTERVAL 20 MINUTES, '%Y%m%d%H%M%S') AS start_time,
 strftime(time_bucket(INTERVAL 20 MINUTES, ts) - INTERVAL 24 HOURS, '%Y%m%d%H%M%S') AS last_day
FROM events""", "I-1", "I-2", "F-4")
def q_tick_floor(spark, sf_dir):
    ev = fx.table(spark, sf_dir, "events")
    t = tick_floor("ts")
    return ev.select("event_id", tick_text("ts").alias("ts_text"), tick_text(t).alias("end_time"),
                     tick_text(shift_ticks(t, -1)).alias("start_time"),
                     tick_text(shift_ticks(t, -DAY_TICKS)).alias("last_day"))


@register("key_codec", with_ctes(
    """SELECT key, left(key, length(key) - 14) AS head, right(key, 14) AS tail,
 regexp_replace(key, '[0-9]', '', 'g') AS letters
FROM (SELECT station_abbr || lpad(CAST(id AS VARCHAR), 3, '0')
  || regexp_replace(strftime(ts, '%Y-%m-%d %H:%M:%S'), '[^0-9]', '', 'g') AS key FROM fx_status)""",
    ("fx_status",)), "I-4", "I-5", "I-12")
def q_key_codec(spark, sf_dir):
    st = world(spark, sf_dir)["status"]
    key = C.key_encode("station_abbr", C.pad3("id"), C.digits_only(F.date_format("ts", "yyyy-MM-dd HH:mm:ss")))
    k = st.select(key.alias("key"))
    return k.select("key", C.key_head("key").alias("head"), C.key_tail("key").alias("tail"),
                    C.letters_only("key").alias("letters"))


# ------------------------------------------------------------------ predicates and basics

@register("predicate_mix", """SELECT COUNT(*) AS n_all,
 COUNT(*) FILTER (WHERE c_acctbal > 2600) AS n_gt,
 COUNT(*) FILTER (WHERE c_acctbal BETWEEN 2600 AND 4000) AS n_between,
 COUNT(*) FILTER (WHERE c_mktsegment = 'BUILDING' OR c_mktsegment = 'MACHINERY') AS n_or,
 COUNT(*) FILTER (WHERE 5000 >= c_acctbal) AS n_expr,
 round(SUM(c_acctbal), 2) AS sum_bal,
 SUM(c_acctbal) FILTER (WHERE c_acctbal > 1e12) AS sum_empty
FROM customer""", "C-11", "E-6", "E-7")
def q_predicate_mix(spark, sf_dir):
    return B.predicate_mix(fx.table(spark, sf_dir, "customer"))


@register("group_count", f"""SELECT c_mktsegment, COUNT(*) AS n, {R4('AVG(c_acctbal)')} AS avg_bal,
 MIN(c_acctbal) AS min_bal, MAX(c_acctbal) AS max_bal FROM customer GROUP BY c_mktsegment""", "2.M")
def q_group_count(spark, sf_dir):
    return B.group_count(fx.table(spark, sf_dir, "customer"), "c_mktsegment", "c_acctbal")


@register("key_range", """SELECT o_orderkey, o_custkey FROM orders
WHERE lpad(CAST(o_orderkey AS VARCHAR), 9, '0') >= '000000100' AND lpad(CAST(o_orderkey AS VARCHAR), 9, '0') < '000000500'""", "2.M")
def q_key_range(spark, sf_dir):
    o = fx.table(spark, sf_dir, "orders").withColumn("key", F.lpad(F.col("o_orderkey").cast("string"), 9, "0"))
    return B.key_range(o, "key", "000000100", "000000500").select("o_orderkey", "o_custkey")


def _hash_sql(key: str, seed: int) -> str:
    return f"CAST('0x' || substr(md5('{seed}|' || CAST({key} AS VARCHAR)), 1, {B.HASH_DIGITS}) AS BIGINT)"


@register("sample_fraction", f"SELECT o_orderkey, o_custkey FROM orders WHERE {_hash_sql('o_custkey', 7)} < {int(0.5 * 16 ** B.HASH_DIGITS)}", "2.M")
def q_sample_fraction(spark, sf_dir):
    # Half of the customers, with all their orders.
    return B.sample_fraction(fx.table(spark, sf_dir, "orders").select("o_orderkey", "o_custkey"), ["o_custkey"], 0.5, 7)


@register("sample_rows", f"""SELECT o_orderkey, o_custkey FROM orders ORDER BY {_hash_sql('o_orderkey', 7)}, o_orderkey
LIMIT (SELECT COUNT(*) // 10 FROM orders)""", "2.M")
def q_sample_rows(spark, sf_dir):
    # Exactly a tenth of the orders.
    o = fx.table(spark, sf_dir, "orders").select("o_orderkey", "o_custkey")
    return B.sample_rows(o, ["o_orderkey"], o.count() // 10, 7)


@register("take_ordered", """SELECT o_orderkey, o_custkey, o_totalprice FROM orders
ORDER BY o_totalprice DESC, o_orderkey LIMIT 10""", "G-1")
def q_take_ordered(spark, sf_dir):
    o = fx.table(spark, sf_dir, "orders")
    return B.take_ordered(o.select("o_orderkey", "o_custkey", "o_totalprice"),
                          [F.col("o_totalprice").desc(), F.col("o_orderkey")], 10)


@register("like_escape", with_ctes(
    r"""SELECT station_abbr, point_name, equipment_name,
 equipment_name LIKE '___' AS name3,
 substring(point_name, 2, 3) LIKE '_\__' ESCAPE '\' AS us2,
 point_name LIKE 'KT\_%' ESCAPE '\' AS kt_literal,
 point_name LIKE 'KT_%' AS kt_wild
FROM (SELECT station_abbr, point_name,
 regexp_extract(point_name, '^([A-Z]+)', 1) AS equipment_name FROM fx_point)""", ("fx_point",)), "C-6")
def q_like_escape(spark, sf_dir):
    p = fx.fx_point(spark, sf_dir)
    return p.select(
        "station_abbr", "point_name", "equipment_name",
        F.col("equipment_name").like("___").alias("name3"),
        F.substring("point_name", 2, 3).like("_\\__").alias("us2"),
        F.col("point_name").like("KT\\_%").alias("kt_literal"),
        F.col("point_name").like("KT_%").alias("kt_wild"),
    )


@register("sql_view", with_ctes(
    """SELECT station_abbr, COUNT(*) AS n_rows, COUNT(DISTINCT seq) AS n_ticks,
 COUNT(DISTINCT control_id) AS n_ids FROM fx_reading GROUP BY station_abbr""", ("fx_reading",)), "L-2")
def q_sql_view(spark, sf_dir):
    return spark.sql("""SELECT station_abbr, COUNT(*) AS n_rows, COUNT(DISTINCT seq) AS n_ticks,
        COUNT(DISTINCT control_id) AS n_ids FROM {readings} GROUP BY station_abbr""", readings=world(spark, sf_dir)["readings"])

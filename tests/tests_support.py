"""Small KPI worlds for tests."""
import datetime as dt

from voltrail import schemas as SC

T = 1_420_100  # a tick number
EPOCH = dt.datetime(1970, 1, 1)


def at(seq, seconds=0):
    return EPOCH + dt.timedelta(seconds=seq * 1200 + seconds)


def world_of(spark, readings, status):
    """Two managed stations (sa, sb) and one that isn't (un) on one line, with the given rows."""
    pts = [(0, "LSJZ01_i1Run_St", "YX"), (5, "KT_01_iRun_St", "YX"), (8, "ZNDB_LS01_Wp_Tm", "YC"), (9, "ZNDB_LS02_Wp_Tm", "YC"),
           (23, "TH_ZTX_A01_Temp_Tm", "YC"), (24, "TH_ZTS_A01_Temp_Tm", "YC")]
    return {
        "lines": spark.createDataFrame([("L1", "la", "P", "d", 1)], SC.LINE_FILE),
        "stations": spark.createDataFrame([("S1", "sa", "L1", "d", 500.0, 1, 0), ("S2", "sb", "L1", "d", 500.0, 1, 0), ("S3", "un", "L1", "d", 500.0, 0, 0)], SC.STATION_FILE),
        "points": spark.createDataFrame([("L1", s, n, k, c) for s in ("S1", "S2", "S3") for c, n, k in pts], "line_name string, station_name string, point_name string, type string, control_id int"),
        "readings": spark.createDataFrame(readings, SC.READING),
        "status": spark.createDataFrame(status, SC.STATUS),
    }

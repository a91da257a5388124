import datetime as dt
import json
import os
from decimal import Decimal as D

import pytest

from isobar import config
from isobar.operators import ingest, official
from isobar.sources import files

HEADER = "\t".join(["No.", "Time", "Indoor Temperature(°C)", "Indoor Humidity(%)",
                    "Outdoor Temperature(°C)", "Outdoor Humidity(%)", "Wind(km/h)", "Gust(km/h)",
                    "Dew Point(°C)", "Wind Chill(°C)", "Wind Direction(°)", "ABS Barometer(hpa)",
                    "REL Barometer(hpa)", "Rain Rate(mm/h)", "Daily Rain(mm)", "Weekly Rain(mm)",
                    "Monthly Rain(mm)", "Yearly Rain(mm)", "Solar Rad.(w/m2)", "Heat Index(°C)",
                    "UV(uW/cm2)", "UVI"])


def _line(no, time, temp, hum, wind, gust, dew, rel, rain):
    return "\t".join([str(no), time, "25.9", "48", temp, hum, wind, gust, dew, "19.5", "158",
                      "1006.5", rel, "0.0", rain, "0.0", "0.0", "0.0", "408.9", "0.0", "--", "0"])


def test_console_utf16_sentinels_and_runs(spark, tmpdir_path):
    lines = [
        _line(1, "2019-09-01 00:00", "19.5", "71", "0.0", "0.0", "14.1", "1012.9", "0.0"),
        _line(2, "12:30 2019-09-01", "--.-", "--", "--.-", "--", "--.-", "--.-", "--"),
        _line(3, "2019-09-01 23:56", "21.5", "69", "3.0", "7.2", "14.9", "1013.5", "2.5"),
        _line(4, "2019-09-02 00:00", "18.0", "80", "1.0", "2.0", "13.0", "1011.0", "0.3"),
        _line(5, "2019-09-01 23:59", "20.0", "70", "1.0", "2.0", "13.0", "1011.0", "2.6"),
        _line(6, "2019-09-03 00:00", "--", "--", "--", "--", "--", "--", "--"),
    ]
    path = os.path.join(tmpdir_path, "export.txt")
    with open(path, "w", encoding="utf-16") as fh:
        fh.write(HEADER + "\n" + "\n".join(lines) + "\n")
    raw = files.read_console_export(spark, path)
    parsed = ingest.parse_console(raw)
    assert parsed.count() == 6
    by_date = {r.date: r for r in ingest.console_daily(parsed, by="date").collect()}
    d1 = by_date[dt.date(2019, 9, 1)]
    assert d1.temp_max == 21.5 and d1.temp_min == 19.5 and d1.temp_avg == 20.3
    assert d1.rain_cm == 0.26
    assert d1.line.startswith("01/09/2019;21,5;20,3;19,5;")
    assert by_date[dt.date(2019, 9, 3)].temp_max is None  # a whole day of sentinels
    runs = sorted((r.run, r.date) for r in ingest.console_daily(parsed, by="run").collect())
    assert runs == [(1, dt.date(2019, 9, 1)), (2, dt.date(2019, 9, 2)), (3, dt.date(2019, 9, 1)),
                    (4, dt.date(2019, 9, 3))]
    out = os.path.join(tmpdir_path, "stats")
    ingest.write_console_stats(ingest.console_daily(parsed), out)
    text = spark.read.text(out).collect()
    assert len(text) == 3


def test_observation_json_first_element_only(spark, tmpdir_path):
    ob = {"stationID": "X", "obsTimeLocal": "2024-01-01 10:00:00", "humidity": 56.0,
          "winddir": 10, "metric": {"temp": 3.2, "windSpeed": 2.0, "windGust": 3.3}}
    msgs = [{"observations": [ob]},
            {"observations": [dict(ob, obsTimeLocal="2024-01-01 10:05:00"),
                              dict(ob, obsTimeLocal="2024-01-01 11:00:00")]},
            {"observations": []}, {}]
    p = os.path.join(tmpdir_path, "obs.json")
    with open(p, "w") as fh:
        fh.write("\n".join(json.dumps(m) for m in msgs))
    rows = ingest.flatten_observations(files.read_observation_messages(spark, p)).collect()
    assert sorted(r.obs_ts.minute for r in rows) == [0, 5]
    r = rows[0]
    # 3.3 * 1.5 is 4.949999... in binary floating point, stored as 4.9 (as the
    # feed's float value would be by the database)
    assert r.wind_speed == D("3.0") and r.wind_gust == D("4.9") and r.humidity == 56


def test_history_date_from_file_name(spark, tmpdir_path):
    msg = {"observations": [{"humidityHigh": 90.0, "humidityAvg": 70.4, "humidityLow": 50.0,
                             "metric": {"tempHigh": 12.3, "tempAvg": 8.1, "tempLow": 2.0,
                                        "pressureMax": 1015.6, "precipTotal": 12.7}}]}
    p = os.path.join(tmpdir_path, "hist_20240105.json")
    with open(p, "w") as fh:
        json.dump(msg, fh)
    h = ingest.map_history(files.read_history_messages(spark, p), station="X").first()
    assert h.date == dt.date(2024, 1, 5)
    assert h.pressure_max_hpa == 1016 and h.humidity_avg == 70
    assert h.precipitation_sum_cm == D("1.27")


def test_official_combined_file(spark, tmpdir_path):
    from isobar import schemas
    rr_cols = [c for c in schemas.OFFICIAL_RR_COLUMNS]
    block2 = ["NUM_POSTE", "NOM_USUEL", "LAT", "LON", "ALTI", "PMERM", "QPMERM", "PMERMIN",
              "QPMERMIN", "UN", "QUN", "UX", "QUX", "UM", "QUM"]
    header = ["AAAAMMJJ"] + [c for c in rr_cols if c != "AAAAMMJJ"] + block2

    def row(date, tn, tx, tm, fxy, pm, pmin, name="LILLE"):
        v = {c: "" for c in header}
        v.update({"AAAAMMJJ": date, "NUM_POSTE": "59343001", "NOM_USUEL": name, "TN": tn, "TX": tx,
                  "TM": tm, "FXY": fxy, "FXI": "10.1", "RR": "0.4"})
        out = [v[c] for c in header[:len(header) - len(block2)]]
        out += ["59343001", name, "50.5", "3.1", "47", pm, "1", pmin, "1", "40", "1", "95", "1", "70", "1"]
        return ";".join(out)
    lines = [";".join(header),
             row("20200101", "-1.0", "0.4", "", "5", "1015.0", "1010.0"),    # mean (-0.3) cut toward zero
             row("20200102", "0.1", "0.8", "", "5.3", "", "1010.0"),        # 0.45 -> 0.4; PMERM missing
             row("20200103", "", "3.0", "", "", "1015.0", "1010.2"),        # TN missing: no fallback
             row("20200104", "1.0", "2.0", "1.7", "1.0", "1015.0", "1010.0", name="OTHER"),
             row("20210101", "1.0", "2.0", "1.7", "1.0", "1015.0", "1010.0")]
    p = os.path.join(tmpdir_path, "mf.csv")
    with open(p, "w") as fh:
        fh.write("\n".join(lines) + "\n")
    rr, other = files.read_official_combined(spark, p)
    got = {r.date: r for r in official.import_official(rr, other, ["LILLE"], (2020, 2020)).collect()}
    assert set(got) == {dt.date(2020, 1, d) for d in (1, 2, 3)}
    assert got[dt.date(2020, 1, 1)].temp_avg == D("-0.3")
    assert got[dt.date(2020, 1, 1)].wind_speed_max == D("18.0")
    assert got[dt.date(2020, 1, 1)].pressure_high == D("1020.0")
    assert got[dt.date(2020, 1, 2)].temp_avg == D("0.4")
    assert got[dt.date(2020, 1, 2)].wind_speed_max == D("19.0")   # 5.3 * 3.6 = 19.08 -> 19.0
    assert got[dt.date(2020, 1, 2)].pressure_high is None
    assert got[dt.date(2020, 1, 3)].temp_avg is None
    assert got[dt.date(2020, 1, 1)].humidity_avg == 70
    rounded = official.import_official(rr, other, ["LILLE"], (2020, 2020), mean_fallback="round")
    assert {r.date: r.temp_avg for r in rounded.collect()}[dt.date(2020, 1, 2)] == D("0.5")


def test_config_loaders(tmpdir_path):
    job = config.load_normals_config()
    assert len(job.crossref) == 53
    assert job.target_name(config.Period(1991, 2020)) == "climate_normals_1991_2020"
    with pytest.raises(FileNotFoundError):
        config.load_normals_config(os.path.join(tmpdir_path, "missing.json"))
    p = os.path.join(tmpdir_path, "st.json")
    with open(p, "w") as fh:
        json.dump({"db1": {"latitude": 48.7}}, fh)
    assert config.load_station_config(p, "db1")["latitude"] == 48.7
    with pytest.raises(ValueError):
        config.load_station_config(p, "db9")
    with pytest.raises(ValueError):
        config.Period(2001, 2000)


def _official(path, names, rows):
    os.makedirs(os.path.dirname(path), exist_ok=True)
    with open(path, "w") as fh:
        fh.write("\n".join([";".join(names)] + [";".join(r.get(n, "") for n in names) for r in rows]) + "\n")


def test_official_files_of_several_column_orders(spark, tmpdir_path):
    from isobar import schemas
    names = list(schemas.OFFICIAL_RR_COLUMNS)
    swapped = [{"TN": "TX", "TX": "TN"}.get(n, n) for n in names]
    a = {"NUM_POSTE": "1", "NOM_USUEL": "A", "AAAAMMJJ": "20200101", "TN": "2.5", "TX": "9.5"}
    b = dict(a, AAAAMMJJ="20200102", TN="1.5", TX="8.5")
    c = dict(a, AAAAMMJJ="20200103", EXTRA="x", UM_POSTE="2")
    _official(f"{tmpdir_path}/rr/a.csv", names, [a])
    _official(f"{tmpdir_path}/rr/b.csv", swapped, [b])
    # reversed, with a column more and the printed name of the station number, behind a byte-order mark
    _official(f"{tmpdir_path}/rr/c.csv", ["﻿EXTRA", *["UM_POSTE" if n == "NUM_POSTE" else n for n in reversed(names)]], [c])
    got = {r.AAAAMMJJ: (r.NUM_POSTE, r.TN, r.TX, r.RR) for r in files.read_official_daily(spark, f"{tmpdir_path}/rr").collect()}
    assert got == {"20200101": ("1", "2.5", "9.5", None), "20200102": ("1", "1.5", "8.5", None), "20200103": ("2", "2.5", "9.5", None)}
    other = list(schemas.OFFICIAL_OTHER_COLUMNS)
    _official(f"{tmpdir_path}/o/a.csv", other, [{"NUM_POSTE": "1", "AAAAMMJJ": "20200101", "PMERM": "1015.0"}])
    _official(f"{tmpdir_path}/o/b.csv", other[::-1], [{"NUM_POSTE": "1", "AAAAMMJJ": "20200102", "PMERM": "1013.0"}])
    assert {r.AAAAMMJJ: r.PMERM for r in files.read_official_other(spark, f"{tmpdir_path}/o").collect()} == \
        {"20200101": "1015.0", "20200102": "1013.0"}


def test_official_file_without_a_column_or_header_raises(spark, tmpdir_path):
    from isobar import schemas
    other = list(schemas.OFFICIAL_OTHER_COLUMNS)
    _official(f"{tmpdir_path}/o/a.csv", other, [{"NUM_POSTE": "1", "AAAAMMJJ": "20200101"}])
    _official(f"{tmpdir_path}/o/b.csv", [n for n in other if n != "UM"], [{"NUM_POSTE": "1", "AAAAMMJJ": "20200101"}])
    with pytest.raises(Exception, match="lacks columns: UM in .*b.csv"):
        # whatever columns are asked for
        files.read_official_other(spark, f"{tmpdir_path}/o").select("NUM_POSTE").collect()
    with open(f"{tmpdir_path}/bare.csv", "w") as fh:
        fh.write("1;20200101;;;;;\n")
    with pytest.raises(Exception, match="without a header"):
        files.read_official_other(spark, f"{tmpdir_path}/bare.csv").collect()


@pytest.mark.parametrize("order, mark, end", [("UTF-16LE", b"\xff\xfe", "\r\n"), ("UTF-16LE", b"", "\n"), ("UTF-16BE", b"\xfe\xff", "\n")])
def test_console_file_read_by_several_tasks(spark, tmpdir_path, order, mark, end):
    from isobar import schemas
    n, names = 4000, schemas.CONSOLE_COLUMNS
    for f in range(2):
        with open(f"{tmpdir_path}/export{f}.txt", "wb") as fh:
            lines = ["\t".join(names)] + ["\t".join([str(i), f"2024-01-{1 + i % 28:02d} 12:30", *[f"v{f}.{i}é"] * (len(names) - 2)]) for i in range(n)]
            fh.write(mark + (end.join(lines) + end).encode(order))
    old = spark.conf.get("spark.sql.files.maxPartitionBytes")
    spark.conf.set("spark.sql.files.maxPartitionBytes", "50001")     # an odd number of bytes cuts characters too
    try:
        split = files.read_console_export(spark, tmpdir_path, order)
        assert split.rdd.getNumPartitions() > 10
        got = sorted(map(tuple, split.collect()))
    finally:
        spark.conf.set("spark.sql.files.maxPartitionBytes", old)
    assert len(got) == 2 * n and len({r[:2] + r[-1:] for r in got}) == 2 * n
    assert all(x == r[2] for r in got for x in r[3:len(names)]) and got[0][2].endswith("é")
    if mark:       # the same rows as by the mark
        assert got == sorted(map(tuple, files.read_console_export(spark, tmpdir_path).collect()))
    with pytest.raises(ValueError, match="byte order"):
        files.read_console_export(spark, tmpdir_path, "UTF-8")

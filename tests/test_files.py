import gzip

import pytest
from pyspark.sql import functions as F

from terrella import session
from terrella.sinks import writers
from terrella.plans import classifier, rainfall, trips
from terrella.sources import datasets, readers


def test_fixed_width_short_and_quoted_lines(spark, tmp_path):
    lines = ['ACW00011604  17.1167  -61.7833   10.1    ST "JOHNS', "AB1         1.5     ", ""]
    (tmp_path / "stations.txt").write_text("\n".join(lines) + "\n")
    got = readers.read_fixed_width(spark, str(tmp_path), datasets.STATION_FILE).collect()
    assert [tuple(r) for r in got] == [("ACW00011604", "17.1167", "-61.7833"), ("AB1", "1.5", ""), ("", "", "")]


def test_headerless_gzip_keeps_the_first_row(spark, tmp_path):
    with gzip.open(tmp_path / "2000.csv.gz", "wt") as out:
        out.write("S1,20000101,PRCP,13,,,X,0700\nS2,20000102,TMAX,250,,,X,\n")
    got = readers.read_csv_headerless(
        spark, f"{tmp_path}/*.csv.gz", datasets.OBSERVATION_FILE, ["station_id", "date", "type", "val"], 3
    )
    assert sorted(tuple(r) for r in got.collect()) == [("S1", "20000101", "PRCP", 13.0), ("S2", "20000102", "TMAX", 250.0)]
    assert got.rdd.getNumPartitions() == 3


def test_positional_names(spark, tmp_path):
    (tmp_path / "rows.csv").write_text("1.0,0.5\n0.0,0.25\n")
    got = readers.read_csv_positional(spark, str(tmp_path), ["DOUBLE", "FLOAT"], ["process", "pt"])
    assert sorted(tuple(r) for r in got.collect()) == [(0.0, 0.25), (1.0, 0.5)]


def test_typed_trip_files(spark, tmp_path):
    names = [part.split()[0] for part in datasets.TRIP_FILE.split(", ")]
    row = "1,2014-01-09 20:45:25,2014-01-09 20:52:31,1,0.7,-73.99,40.73,1,0,-73.98,40.73,1,6.5,0.5,0.5,1.4,8.9,0,0"
    for month in (1, 2):
        (tmp_path / f"yellow_{month}.csv").write_text(",".join(names) + "\n" + row + "\n")
    got = readers.read_csv_typed(spark, f"{tmp_path}/yellow_*.csv", datasets.TRIP_FILE)
    assert got.count() == 2 and got.first()["tpep_dropoff_datetime"].minute == 52


def test_runs_are_appended(spark, tmp_path):
    path = str(tmp_path / "runs")
    one = spark.createDataFrame([(4, 1.25)], "workers INT, seconds DOUBLE")
    for expected in (1, 2, 3):
        writers.append_runs(one, path)
        assert spark.read.text(path).count() == expected
    assert spark.read.text(path).first()["value"] == "4 1.25"


def test_head_is_one_file(spark, tmp_path):
    path = tmp_path / "head"
    writers.write_head(spark.range(100).repartition(4), str(path), [F.desc("id")], 20)
    parts = list(path.glob("part-*.csv"))
    assert len(parts) == 1 and parts[0].read_text().splitlines()[:2] == ["id", "99"]


def test_scratch_is_in_the_shared_folder(spark):
    shared = spark.conf.get("spark.checkpoint.dir")
    a, b = session.scratch_path(spark, "x"), session.scratch_path(spark, "x")
    assert a != b and a.startswith(shared + "/")


def test_no_shared_folder_on_a_cluster():
    class Context:
        master = "spark://somewhere"

    class Conf:
        def get(self, key, default=None):
            return default

    class Session:
        conf, sparkContext = Conf(), Context()

    with pytest.raises(ValueError):
        session.shared_dir(Session())


def test_rain_from_files(spark, tmp_path):
    """Two stations near one city, one far away; one near station never reports rain."""
    station = "{:<11} {:>8} {:>9} 10.0 NAME\n"
    (tmp_path / "stations.txt").write_text(
        station.format("NEAR1", "33.7500", "-84.3900") + station.format("NEAR2", "33.8000", "-84.4000")
        + station.format("FAR", "10.0000", "10.0000")
    )
    for year, lines in {
        2000: ["NEAR1,20000101,PRCP,100,,,X,", "NEAR1,20001231,PRCP,54,,,X,", "NEAR1,20000101,TMAX,9,,,X,", "FAR,20000101,PRCP,999,,,X,"],
        2001: ["NEAR1,20010615,PRCP,254,,,X,"],
    }.items():
        with gzip.open(tmp_path / f"{year}.csv.gz", "wt") as out:
            out.write("\n".join(lines) + "\n")
    observed = datasets.observations(spark, f"{tmp_path}/*.csv.gz", 2)
    placed = datasets.stations(spark, str(tmp_path / "stations.txt"))
    got = {(r["city"], r["year"]): r["rain"] for r in rainfall.rainfall_by_city_year(observed, placed).collect()}
    assert got == {
        ("Atlanta", 2000): pytest.approx(15.4 * 0.0393701 / 2),
        ("Atlanta", 2001): pytest.approx(25.4 * 0.0393701 / 2),
    }


def test_trips_from_files(spark, tmp_path):
    names = [part.split()[0] for part in datasets.TRIP_FILE.split(", ")]
    good = "1,2014-01-09 20:45:25,2014-01-09 20:52:31,1,0.7,-73.99,40.73,1,0,-73.98,40.73,1,6.5,0.5,0.5,1.4,8.9,0,0"
    backward = good.replace("20:52:31", "20:40:00")
    (tmp_path / "yellow_1.csv").write_text("\n".join([",".join(names), good, backward, ""]))
    got = trips.trip_features(datasets.trips(spark, f"{tmp_path}/yellow_*.csv")).collect()
    assert [(r["diff"], r["hour"], r["day_of_week"]) for r in got] == [(426, 20, 3)]


def test_collisions_from_files(spark, tmp_path):
    lines = [f"{float(i % 2)}," + ",".join(str(((i * 37 + j * 11) % 19) / 19 + (i % 2) * (j == 3)) for j in range(28)) for i in range(200)]
    (tmp_path / "c.csv").write_text("\n".join(lines) + "\n")
    rows = datasets.collisions(spark, str(tmp_path / "c.csv")).withColumn("row", F.xxhash64("*"))
    assert len(rows.columns) == 30 and rows.count() == 200
    scored = classifier.scored_validation(rows, "process", ["row"], max_rounds=3, first_rounds=3)
    report = classifier.full_report(scored, "process")
    quality = {r["metric"]: r["value"] for r in report["quality"].collect()}
    assert quality["accuracy"] > 0.9 and quality["roc_auc"] > 0.9
    assert sum(r["n"] for r in report["confusion"].collect()) == scored.count()


def test_csv_columns_are_bound_by_name(spark, tmp_path):
    (tmp_path / "a.csv").write_text("lon,lat,n\n-73.9,40.7,1\n")
    (tmp_path / "b.csv").write_text("\ufeff Latitude ,n,extra,LON\n40.8,2,x,-74.0\n", encoding="utf-8")
    (tmp_path / "c.csv").write_text("n\n3\n")
    (tmp_path / "d.csv").write_text("")
    schema = "lon DOUBLE, lat DOUBLE, n INT"
    got = readers.read_csv_typed(spark, str(tmp_path), schema, {"latitude": "lat"})
    assert sorted(map(tuple, got.collect()), key=lambda r: r[2]) == [(-73.9, 40.7, 1), (-74.0, 40.8, 2), (None, None, 3)]
    assert got.dtypes == [("lon", "double"), ("lat", "double"), ("n", "int")]


def test_csv_rows_that_do_not_parse_are_reported(spark, tmp_path):
    (tmp_path / "a.csv").write_text("n,x\n1,0.5\ntwo,0.25\n")
    got = readers.read_csv_typed(spark, str(tmp_path), "x DOUBLE, n INT", malformed="broken")
    assert sorted(map(tuple, got.collect()), key=repr) == [(0.25, None, "two,0.25"), (0.5, 1, None)]


def test_csv_of_an_unknown_layout_is_refused(spark, tmp_path):
    (tmp_path / "a.csv").write_text("p,q\n1,2\n")
    with pytest.raises(ValueError, match="no declared column"):
        readers.read_csv_typed(spark, str(tmp_path), "n INT")

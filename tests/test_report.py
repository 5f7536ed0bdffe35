from __future__ import annotations

import re
from pathlib import Path
from types import SimpleNamespace

import pytest
from conftest import days, rows
from test_sources import CASE_HEADER, COUNTER_HEADER, write

from tidegauge import (
    counter_to_increments,
    percent_change,
    rank_within,
    read_raw,
    read_report,
    read_series,
    rolling_average,
    run_report,
    work_dir,
    write_report,
)


@pytest.fixture
def case_file(tmp_path):
    lines = []
    for n, d in enumerate(days("2021-01-01", 20)):
        year, month, date = d.split("-")
        for k, country in enumerate(("Italy", "Spain", "Germany")):
            lines.append(f"{date}/{month}/{year},,,,{(n * (k + 3)) % 7 - 1},0,{country},,,,,")
    return write(tmp_path, "cases.csv", CASE_HEADER, *lines)


def part_texts(path):
    return [p.read_text() for p in sorted(Path(path).glob("part-*.csv"))]


def test_report_of_case_files(spark, case_file, tmp_path):
    cached = len(spark.sparkContext._jsc.getPersistentRDDs())
    avg, rank = run_report(spark, case_file, out_dir=str(tmp_path / "out"), rank_limit=2)
    changes = percent_change(rolling_average(read_series(spark, case_file)))
    ranks = rank_within(changes, limit=2)
    assert rows(read_report(spark, avg, changes.schema)) == rows(changes)
    assert rows(read_report(spark, rank, ranks.schema)) == rows(ranks)
    assert len(spark.sparkContext._jsc.getPersistentRDDs()) == cached
    for text in part_texts(avg):
        header, *lines = text.splitlines()
        assert header == "start_date,end_date,country,avg,avg_increase"
        assert all(re.match(r"\d\d/\d\d/\d{4},\d\d/\d\d/\d{4},\w+,", line) for line in lines)


def test_report_of_counter_files(spark, tmp_path):
    lines = [f"{d},{c},0,{(d * c * 5) % 11},0" for d in range(15) for c in (1, 2, 3)]
    path = write(tmp_path, "n.csv", COUNTER_HEADER, *lines)
    window = {"window_days": 4, "slide_days": 2}
    avg, rank = run_report(
        spark, path, "COUNTER", str(tmp_path / "out"), rank_limit=1, sort_output=True, **window
    )
    series = counter_to_increments(read_raw(spark, path, "counter"))
    changes = percent_change(rolling_average(series, **window))
    assert rows(read_report(spark, avg, changes.schema)) == rows(changes)
    ranks = rank_within(changes, limit=1)
    assert rows(read_report(spark, rank, ranks.schema)) == rows(ranks)


def test_report_replaces_the_last_one(spark, case_file, tmp_path):
    for limit in (3, 1):
        _, rank = run_report(spark, case_file, out_dir=str(tmp_path / "out"), rank_limit=limit)
    ranks = rank_within(percent_change(rolling_average(read_series(spark, case_file))), limit=1)
    assert rows(read_report(spark, rank, ranks.schema)) == rows(ranks)


def test_failed_report_releases_its_cache(spark, case_file, tmp_path):
    cached = len(spark.sparkContext._jsc.getPersistentRDDs())
    (tmp_path / "out").write_text("in the way")
    with pytest.raises(Exception):
        run_report(spark, case_file, out_dir=str(tmp_path / "out"))
    assert len(spark.sparkContext._jsc.getPersistentRDDs()) == cached


def test_arguments_are_checked_before_anything_is_written(spark, case_file, tmp_path):
    with pytest.raises(ValueError):
        run_report(spark, case_file, out_dir=str(tmp_path / "out"), window_days=0)
    assert not (tmp_path / "out").exists()


def test_null_is_written_as_an_empty_field(spark, series, tmp_path):
    write_report(series([("2021-01-05", "A", None)]), str(tmp_path / "r"))
    assert part_texts(tmp_path / "r")[-1] == "date,cases,country\n05/01/2021,,A\n"


def test_sorted_report_reads_in_order(spark, series, tmp_path):
    data = [(d, str(n), n) for d in days("2021-01-01", 40) for n in range(30)]
    write_report(
        series(data).repartition(8), str(tmp_path / "r"), sort_by=["date", "country"]
    )
    lines = [line for text in part_texts(tmp_path / "r") for line in text.splitlines()[1:]]
    found = [(line.split(",")[0].split("/")[::-1], line.split(",")[2]) for line in lines]
    assert len(found) == len(data) and found == sorted(found)


def test_work_dir_lies_in_the_shared_folder(spark):
    shared = spark.conf.get("spark.checkpoint.dir")
    first, second = work_dir(spark, "x"), work_dir(spark, "x")
    assert first.startswith(f"{shared}/x-") and first != second


@pytest.mark.parametrize(
    ("master", "settings", "wanted"),
    [
        ("spark://host:7077", {"spark.sql.warehouse.dir": "file:/data/warehouse"}, None),
        ("spark://host:7077", {"spark.sql.warehouse.dir": "/data/warehouse"}, None),
        ("spark://host:7077", {"spark.sql.warehouse.dir": "hdfs://host/warehouse"}, "hdfs://host/warehouse/x-"),
        ("spark://host:7077", {"spark.checkpoint.dir": "/shared", "spark.sql.warehouse.dir": "/data"}, "/shared/x-"),
        ("local[4]", {"spark.sql.warehouse.dir": "file:/data/warehouse"}, "file:/data/warehouse/x-"),
        ("local[4]", {}, None),
    ],
)
def test_a_local_warehouse_is_no_shared_folder_of_a_cluster(master, settings, wanted):
    context = SimpleNamespace(master=master, getConf=lambda: {})
    session = SimpleNamespace(conf=SimpleNamespace(get=lambda name, other: settings.get(name)), sparkContext=context)
    if wanted is None:
        with pytest.raises(ValueError, match="spark.checkpoint.dir"):
            work_dir(session, "x")
    else:
        assert work_dir(session, "x").startswith(wanted)


def test_a_failed_run_leaves_the_last_version_whole(spark, tmp_path, monkeypatch):
    from tidegauge import current_report
    from tidegauge.plans import report

    source, out = str(tmp_path / "in"), str(tmp_path / "out")
    (tmp_path / "in").mkdir()
    write(tmp_path / "in", "a.csv", CASE_HEADER, "1/1/2021,1,1,2021,5,0,Italy,,,,,", "2/1/2021,2,1,2021,9,0,Italy,,,,,")
    paths = run_report(spark, source, out_dir=out, versioned=True)
    assert current_report(spark, out) == paths
    before = [spark.read.option("header", True).csv(p).collect() for p in paths]

    write_report, calls = report.write_report, []

    def fails_second(*args):
        calls.append(args)
        if len(calls) == 2:
            raise OSError("no space left")
        write_report(*args)

    write(tmp_path / "in", "b.csv", CASE_HEADER, "3/1/2021,3,1,2021,7,0,Spain,,,,,")
    monkeypatch.setattr(report, "write_report", fails_second)
    with pytest.raises(OSError, match="no space left"):
        run_report(spark, source, out_dir=out, versioned=True)
    assert current_report(spark, out) == paths
    assert [spark.read.option("header", True).csv(p).collect() for p in paths] == before

    # The next run's report takes its place, and the old one can still be read.
    newer = run_report(spark, source, out_dir=out, versioned=True)
    assert current_report(spark, out) == newer != paths
    assert [spark.read.option("header", True).csv(p).collect() for p in paths] == before
    assert "Spain" in {r.country for r in spark.read.option("header", True).csv(newer[0]).collect()}


def test_a_compressed_report_reads_the_same(spark, case_file, tmp_path):
    plain = run_report(spark, case_file, out_dir=str(tmp_path / "plain"))
    packed = run_report(spark, case_file, out_dir=str(tmp_path / "packed"), compression="gzip")
    changes = percent_change(rolling_average(read_series(spark, case_file)))
    for one, other, schema in zip(plain, packed, (changes.schema, rank_within(changes).schema)):
        assert not list(Path(other).glob("*.csv"))
        assert list(Path(other).glob("*.csv.gz"))
        assert rows(read_report(spark, other, schema)) == rows(read_report(spark, one, schema))

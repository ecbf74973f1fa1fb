"""Log files, stage tables and the whole job, over generated files."""

from __future__ import annotations

import datetime as dt
import gzip
import json
import zipfile

import pyarrow as pa
import pytest
from pyspark.sql import functions as F
from pyspark.sql import types as T

from logweir import CountryRule, Layout, from_table, load_ip_ranges, run
from logweir.__main__ import main
from logweir.operators.columns import union_of
from logweir.operators.counters import counted
from logweir.sources import commits, folders, logs, tables
from logweir.sources.archives import write_logs
from logweir.sources.commits import committed
from logweir.sources.learned import read_answers
from logweir.plans.daily import location_table_of
from logweir.schemas import COUNTRY_MAPPING, LOCATIONS, RAW_LOG, log_schema
from logweir.sources.logs import raw_files, read_csv_logs, read_zip_logs
from logweir.sources.tables import (
    DAY_SCHEMA,
    present_days,
    read_days,
    read_latest,
    whole_days,
    write_days,
    write_next,
)

HEADER = "ip,date,time,zone,cik,accession,code,size,idx,crawler,note"
ONE, TWO, THREE = (dt.date(2024, 3, day) for day in (19, 20, 21))
RULES = [CountryRule(1, "^united states", "United States")]


def line(ip, day, time="10:00:00", cik=1.0, code=200.0, note="plain"):
    return f'{ip},{day},{time},0.0,{cik},a-1,{code},12.0,0.0,0.0,"{note}"'


def human(day):
    return [line("10.0.0.abc", day), line("10.0.1.abc", day, note="two\nlines, one comma")]


def bot(day):
    return [line("10.9.9.bot", day, f"10:00:{i:02d}") for i in range(30)]


def write_zip(folder, day, lines, members=None):
    folder.mkdir(parents=True, exist_ok=True)
    path = folder / f"log{day:%Y%m%d}.zip"
    with zipfile.ZipFile(path, "w", zipfile.ZIP_DEFLATED) as archive:
        archive.writestr("readme.txt", "about")
        archive.writestr(f"log{day:%Y%m%d}.csv", "\n".join([HEADER, *lines]) + "\n")
        archive.writestr("other.csv", "not,a,log\n1,2,3\n")
        for name, text in (members or {}).items():
            archive.writestr(name, text)
    return str(path)


def write_csv(folder, day, lines):
    folder.mkdir(parents=True, exist_ok=True)
    path = folder / f"log{day:%Y%m%d}.csv"
    path.write_text("\n".join([HEADER, *lines]) + "\n")
    return str(path)


def test_zip_equals_csv(spark, tmp_path):
    # A line break within quotes needs a reader of its own in CSV, so none here.
    lines = [line("10.0.0.abc", ONE), line("", ONE, note=""), line("10.0.1.abc", ONE, note="a,b")]
    zipped = read_zip_logs(spark, write_zip(tmp_path / "z", ONE, lines))
    plain = read_csv_logs(spark, write_csv(tmp_path / "c", ONE, lines))
    assert zipped.schema == plain.schema
    assert zipped.schema["cik"].dataType == T.DoubleType()
    assert zipped.schema["size"].dataType == T.StringType()
    assert sorted(map(str, zipped.collect())) == sorted(map(str, plain.collect()))
    assert {row.log_date for row in zipped.collect()} == {ONE}
    assert zipped.where("ip IS NULL").count() == 1


def test_other_types_can_be_asked_for(spark, tmp_path):
    path = write_zip(tmp_path, ONE, human(ONE))
    assert read_zip_logs(spark, path, types={"size": T.DoubleType()}).first()["size"] == 12.0


def test_archives_are_read_side_by_side(spark, tmp_path):
    paths = [write_zip(tmp_path, day, human(day)) for day in (ONE, TWO, THREE)]
    rows = read_zip_logs(spark, paths)
    tasks = rows.select(F.spark_partition_id().alias("task"), "log_date").distinct().collect()
    assert len({row.task for row in tasks}) == len(tasks) == 3
    folder = read_zip_logs(spark, str(tmp_path))
    assert sorted(map(str, folder.collect())) == sorted(map(str, rows.collect()))
    assert rows.groupBy("log_date").count().collect() and rows.count() == 6
    assert rows.where(F.col("note").contains("\n")).count() == 3


def test_archive_without_csv_is_an_error(spark, tmp_path):
    path = tmp_path / "log20240319.zip"
    with zipfile.ZipFile(path, "w") as archive:
        archive.writestr("readme.txt", "about")
    with pytest.raises(Exception, match="no CSV file"):
        read_zip_logs(spark, str(path), log_schema(RAW_LOG.names)).collect()


@pytest.mark.parametrize("kind", ["zip", "csv"])
def test_wrong_value_fails_the_load(spark, tmp_path, kind):
    lines = [line("10.0.0.abc", ONE, code="two hundred")]
    if kind == "zip":
        rows = read_zip_logs(spark, write_zip(tmp_path, ONE, lines))
    else:
        rows = read_csv_logs(spark, write_csv(tmp_path, ONE, lines))
    with pytest.raises(Exception):
        rows.collect()


@pytest.mark.parametrize("kind", ["zip", "csv"])
def test_another_header_is_an_error(spark, tmp_path, kind):
    write, read = (write_zip, read_zip_logs) if kind == "zip" else (write_csv, read_csv_logs)
    path = write(tmp_path, ONE, [line("10.0.0.abc", ONE)])
    names = [name for name in HEADER.split(",") if name != "note"]
    with pytest.raises(Exception, match="(?i)header"):
        read(spark, path, log_schema(names)).collect()


def test_header_must_hold_the_columns():
    with pytest.raises(ValueError, match="crawler"):
        log_schema(name for name in RAW_LOG.names if name != "crawler")


def test_listing_does_not_read_contents(spark, tmp_path):
    write_zip(tmp_path, ONE, human(ONE))
    files = raw_files(spark, str(tmp_path))
    assert files.columns == ["link", "pos"] and files.count() == 1
    plan = files._jdf.queryExecution().executedPlan().toString()
    assert "content" not in plan


def day_table(spark, *rows):
    schema = T.StructType([T.StructField("n", T.IntegerType()), *DAY_SCHEMA.fields])
    return spark.createDataFrame(list(rows), schema)


def stored(spark, path):
    return sorted((row.n, row.log_date) for row in spark.read.parquet(path).collect())


def test_days_are_replaced_one_by_one(spark, tmp_path):
    path = str(tmp_path / "t")
    counts = write_days(day_table(spark, (1, ONE), (2, TWO)), path, [ONE, TWO, THREE])
    assert counts == {"days": 3, "rows": 2}
    assert {row.log_date for row in present_days(spark, path).collect()} == {ONE, TWO, THREE}
    # ONE is written anew, TWO loses its rows, THREE is left alone.
    write_days(day_table(spark, (9, ONE)), path, [ONE, TWO])
    assert stored(spark, path) == [(9, ONE)]
    assert {row.log_date for row in present_days(spark, path).collect()} == {ONE, TWO, THREE}
    assert read_days(spark, path, [TWO]).isEmpty()


def test_files_without_a_commit_do_not_count(spark, tmp_path, monkeypatch):
    path = tmp_path / "t"
    write_days(day_table(spark, (1, ONE), (2, TWO)), str(path), [ONE, TWO])
    one = path / f"log_date={ONE}"
    (good,) = one.glob("*.parquet")
    # An empty folder, and a folder somebody copied.
    (path / f"log_date={THREE}").mkdir()
    (path / "log_date=2024-03-22").mkdir()
    (path / "log_date=2024-03-22" / good.name).write_bytes(good.read_bytes())
    days = [ONE, TWO, THREE, dt.date(2024, 3, 22)]
    assert {row.log_date for row in whole_days(spark, str(path), days).collect()} == {ONE, TWO}
    assert read_days(spark, str(path), days).count() == 2

    # A run that ends between the files and the record.
    def broken(*_):
        raise RuntimeError("lost")

    with monkeypatch.context() as patch:
        patch.setattr(tables, "commit", broken)
        with pytest.raises(RuntimeError):
            write_days(day_table(spark, (7, ONE), (7, THREE)), str(path), [ONE, THREE])
    assert len(list(one.glob("*.parquet"))) == 2
    assert sorted(r.n for r in read_days(spark, str(path), days).collect()) == [1, 2]
    assert THREE not in committed(spark, str(path))
    write_days(day_table(spark, (8, ONE), (9, THREE)), str(path), [ONE, THREE])
    assert sorted(r.n for r in read_days(spark, str(path), days).collect()) == [2, 8, 9]
    assert len(list(one.glob("*.parquet"))) == 1
    assert committed(spark, str(path))[THREE].rows == 1

    # A file that is cut short or gone.
    (now,) = one.glob("*.parquet")
    now.write_bytes(now.read_bytes()[:-9])
    assert {row.log_date for row in whole_days(spark, str(path), days).collect()} == {TWO, THREE}


def test_log_of_many_commits(spark, tmp_path, monkeypatch):
    monkeypatch.setattr(commits, "_SUMMARY", 3)
    expected = {}
    for i in range(11):
        day = ONE + dt.timedelta(i % 5)
        expected[day] = commits.Commit(i, {f"f{i}": i})
        commits.commit(spark, str(tmp_path), {day: expected[day]})
        assert commits.committed(spark, str(tmp_path)) == expected
    names = sorted(p.name for p in (tmp_path / "_commits").iterdir() if not p.name.startswith("."))
    assert [n for n in names if "all" in n] == ["000000000004.all.json", "000000000008.all.json"]
    with pytest.raises(FileExistsError):
        folders.write_text(spark, str(tmp_path / "_commits" / names[0]), "x", str(tmp_path / "aside"))


def test_half_copied_day_is_done_again(spark, site, tmp_path):
    run(spark, site.root, ONE, TWO, rules=RULES)
    for stage in ("converted", "no_bots", "ip_enriched"):
        folder = tmp_path / stage / f"log_date={ONE}"
        for file in [*folder.glob("*.parquet")]:
            file.unlink()
    stages = {}
    output = run(spark, site.root, ONE, TWO, rules=RULES, report=stages.__setitem__)
    assert stages["converted"] == {"days": 1, "rows": 32}
    assert stages["no_bots"] == stages["ip_enriched"] == {"days": 1, "rows": 2}
    assert len(summary(output)) == 3


def test_only_days_without_rows(spark, tmp_path):
    path = str(tmp_path / "t")
    empty = day_table(spark)
    assert write_days(empty, path, [ONE]) == {"days": 1, "rows": 0}
    assert present_days(spark, path).first().log_date == ONE
    assert read_days(spark, path, [ONE], empty.schema).isEmpty()


def test_partitions_of_other_days_are_not_read(spark, tmp_path):
    path = str(tmp_path / "t")
    write_days(day_table(spark, (1, ONE), (2, TWO)), path, [ONE, TWO])
    plan = read_days(spark, path, [ONE])._jdf.queryExecution().toString()
    assert "PartitionFilters: [isnotnull(log_date" in plan
    files = read_days(spark, path, [ONE]).inputFiles()
    assert files and all(name.endswith(".gz.parquet") for name in files)


def test_versions(spark, tmp_path):
    folder = str(tmp_path / "v")
    assert read_latest(spark, folder, DAY_SCHEMA).isEmpty()
    with pytest.raises(FileNotFoundError):
        read_latest(spark, folder)
    first = write_next(spark.range(2), folder)
    # The table that is read may be the one that is written next.
    write_next(first.unionByName(first), folder)
    assert read_latest(spark, folder).count() == 4
    # A version that was not finished is passed over, and its number used again.
    (tmp_path / "v" / "v=3").mkdir()
    assert read_latest(spark, folder).count() == 4
    write_next(spark.range(7), folder)
    assert read_latest(spark, folder).count() == 7


def test_counter(spark):
    watched, count = counted(spark.range(10).where("id < 4"))
    watched.write.format("noop").mode("overwrite").save()
    assert count() == 4


@pytest.fixture()
def site(spark, tmp_path):
    layout = Layout(str(tmp_path))
    downloads = tmp_path / "downloads"
    write_zip(downloads, ONE, human(ONE) + bot(ONE))
    write_csv(downloads, TWO, [line("10.0.0.abc", TWO), *bot(TWO)])
    write_zip(downloads, THREE, bot(THREE))
    source = tmp_path / "ranges.csv"
    source.write_text(
        '"167772160","167772415","US","United States of America","-","-","1.5","2.5","1","-05:00"\n'
    )
    load_ip_ranges(spark, str(source), layout.ip_ranges)
    return layout


def resolver(spark):
    hit = json.dumps({"country_code": "AT", "country_name": "Atlantis"})
    table = spark.createDataFrame([(167772416, hit)], "cleaned_ip_int bigint, payload string")
    return from_table(table)


def summary(df):
    return sorted((row.log_date, row.cleaned_ip, row.country_name) for row in df.collect())


EXPECTED = [
    (ONE, "10.0.0.0", "United States"), (ONE, "10.0.1.0", "not found"),
    (TWO, "10.0.0.0", "United States"),
]


def test_whole_job(spark, site):
    stages = {}
    output = run(spark, site.root, ONE, THREE, rules=RULES, resolver=resolver(spark),
                 report=stages.__setitem__)
    assert summary(output) == EXPECTED
    assert stages == {
        "converted": {"days": 3, "rows": 93},
        "no_bots": {"days": 3, "rows": 3},
        "ip_enriched": {"days": 3, "rows": 3},
        "output": {"days": 3, "rows": 3},
    }
    header = HEADER.split(",")
    added = ["datetime", "cleaned_ip", "cleaned_ip_int", *LOCATIONS.names[1:], "log_date"]
    assert output.columns == header + added
    assert output.where("note LIKE 'two\nlines%'").count() == 1
    assert location_table_of(spark, site).count() == 2
    assert read_answers(spark, site.locations).count() == 1
    assert read_latest(spark, site.country_mapping).count() == 2


def test_some_days_at_a_time(spark, site):
    stages = []
    output = run(spark, site.root, ONE, THREE, rules=RULES, resolver=resolver(spark),
                 days_per_job=2, report=lambda stage, counts: stages.append((stage, counts["days"])))
    assert summary(output) == EXPECTED
    assert stages == [(name, n) for name in ("converted", "no_bots", "ip_enriched", "output")
                      for n in (2, 1)]


def test_second_run_does_the_countries_only(spark, site):
    run(spark, site.root, ONE, TWO, rules=RULES, resolver=resolver(spark))
    # An edit of the mapping takes effect.
    edited = read_latest(spark, site.country_mapping, COUNTRY_MAPPING).withColumn(
        "cleaned_country_name",
        F.when(F.col("raw_country_name") == "Atlantis", "Sunk").otherwise(F.col("cleaned_country_name")),
    )
    write_next(edited, site.country_mapping)
    stages = {}
    output = run(spark, site.root, ONE, THREE, rules=RULES, report=stages.__setitem__)
    assert stages == {
        "converted": {"days": 1, "rows": 30},
        "no_bots": {"days": 1, "rows": 0},
        "ip_enriched": {"days": 1, "rows": 0},
        "output": {"days": 3, "rows": 3},
    }
    assert summary(output)[1] == (ONE, "10.0.1.0", "Sunk")


def test_force_does_all_again(spark, site, tmp_path):
    run(spark, site.root, ONE, TWO, rules=RULES)
    write_zip(tmp_path / "downloads", ONE, bot(ONE))
    assert len(summary(run(spark, site.root, ONE, TWO, rules=RULES))) == 3
    forced = run(spark, site.root, ONE, TWO, force=True, rules=RULES)
    assert summary(forced) == [(TWO, "10.0.0.0", "United States")]


def test_day_without_rows_alone(spark, site):
    assert run(spark, site.root, THREE).count() == 0
    assert run(spark, site.root).count() == 0  # the latest day


def test_missing_files_are_named(spark, site):
    with pytest.raises(ValueError, match="no log file for 2024-03-22, 2024-03-23"):
        run(spark, site.root, THREE, dt.date(2024, 3, 23))


def test_gzip_logs(spark, tmp_path):
    folder = tmp_path / "downloads"
    folder.mkdir()
    with gzip.open(folder / "log20240319.csv.gz", "wt") as file:
        file.write("\n".join([HEADER, line("10.0.0.abc", ONE)]) + "\n")
    output = run(spark, str(tmp_path), ONE)
    assert summary(output) == [(ONE, "10.0.0.0", None)]


def test_command_line(spark, site, tmp_path):
    rules = tmp_path / "rules.csv"
    rules.write_text("priority,pattern,standard_name\n1,^united states,USA\n")
    arguments = ["--root", site.root, "--start-date", "2024-03-19", "--end-date", "2024-03-20"]
    main([*arguments, "--rules", str(rules)])
    output = spark.read.parquet(site.output)
    assert {row.country_name for row in output.collect()} == {"USA", None}


NARROW = "ip,date,time,cik,accession,code,idx,crawler"
WIDE = NARROW + ",size,referrer"


def write_log(folder, day, header, kind, value="7"):
    """One request in a file of its own header."""
    values = dict(zip(NARROW.split(","), [f"10.0.{day.day}.abc", day, "10:00:00", 1.0, "a", 200.0, 0.0, 0.0]))
    text = f"{header}\n" + ",".join(str(values.get(name, value)) for name in header.split(",")) + "\n"
    folder.mkdir(parents=True, exist_ok=True)
    path = folder / f"log{day:%Y%m%d}.{kind}"
    if kind == "zip":
        with zipfile.ZipFile(path, "w") as archive:
            archive.writestr("log.csv", text)
    elif kind == "csv.gz":
        path.write_bytes(gzip.compress(text.encode()))
    else:
        path.write_text(text)
    return str(path)


def notes(df):
    return sorted((row.log_date.day, row["size"], row.referrer) for row in df.collect())


# The names of the columns in another order as well.
HEADERS = [NARROW, WIDE, "referrer,size," + NARROW, NARROW.replace("code,idx", "code,size,idx")]
BY_HEADER = [(18, None, None), (19, "7", "7"), (20, "7", "7"), (21, "7", None)]


@pytest.mark.parametrize("kind", ["csv", "csv.gz", "zip"])
@pytest.mark.parametrize("turned", [False, True])
def test_files_with_headers_of_their_own(spark, tmp_path, kind, turned):
    days = [dt.date(2024, 3, d) for d in range(18, 22)]
    paths = [write_log(tmp_path, day, header, kind) for day, header in zip(days, HEADERS)]
    read = read_zip_logs if kind == "zip" else read_csv_logs
    rows = read(spark, paths[::-1] if turned else paths)
    assert notes(rows) == BY_HEADER
    assert set(rows.columns) == {*WIDE.split(","), "log_date"}
    assert notes(read(spark, str(tmp_path))) == BY_HEADER


@pytest.mark.parametrize("turned, runs", [(False, 1), (True, 2)])
def test_days_with_headers_of_their_own(spark, tmp_path, turned, runs):
    days = [dt.date(2024, 3, d) for d in range(18, 22)]
    kinds = ["csv", "zip", "csv.gz", "csv"]
    for day, header, kind in zip(days, HEADERS, kinds):
        write_log(tmp_path / "downloads", day, header, kind)
    parts = [days] if runs == 1 else [days[:2], days[2:]]
    for part in parts[::-1] if turned else parts:
        run(spark, str(tmp_path), part[0], part[-1])
    assert notes(run(spark, str(tmp_path), days[0], days[-1])) == BY_HEADER


def test_column_of_two_types_is_an_error(spark, tmp_path):
    for day in (ONE, TWO):
        write_log(tmp_path / "downloads", day, WIDE, "csv")
    run(spark, str(tmp_path), ONE, types={"size": T.DoubleType()})
    run(spark, str(tmp_path), TWO)
    with pytest.raises(Exception, match="(?i)merge"):
        run(spark, str(tmp_path), ONE, TWO)
    frames = [spark.range(1).selectExpr(f"cast(1 as {kind}) as n") for kind in ("string", "double")]
    with pytest.raises(ValueError, match="n has two types: string and double"):
        union_of(frames)
    with pytest.raises(ValueError, match="differ in case only"):
        union_of([frames[0], frames[0].withColumnRenamed("n", "N")])


@pytest.mark.parametrize("kind", ["csv", "zip"])
def test_bad_headers_are_named(spark, tmp_path, kind):
    read = read_zip_logs if kind == "zip" else read_csv_logs
    good = write_log(tmp_path, ONE, WIDE, kind)
    for header, message in ((WIDE + ",size", "twice"), (NARROW.replace(",idx", ""), "idx")):
        bad = write_log(tmp_path, TWO, header, kind)
        with pytest.raises(ValueError, match=message):
            read(spark, [good, bad])


@pytest.mark.parametrize("kind", ["csv", "csv.gz", "zip"])
def test_written_logs_are_read_back(spark, tmp_path, kind):
    texts = ["plain", "", None, 'a "quoted" one', "comma, here", "back\\slash", "ünï"]
    rows = [
        ("1.2.3.a", "2024-03-19", "10:00:00", float(i), text, 200.0, 0.0, None, day)
        for i, text in enumerate(texts) for day in (ONE, TWO)
    ]
    log = spark.createDataFrame(rows, T.StructType([*RAW_LOG.fields, *DAY_SCHEMA.fields]))
    files = write_logs(log.repartition(3), str(tmp_path), kind).orderBy("log_date").collect()
    paths = [tmp_path / f"log{day:%Y%m%d}.{kind}" for day in (ONE, TWO)]
    assert [(f.log_date, f.path, f.rows, f.bytes) for f in files] == [
        (day, str(path), len(texts), path.stat().st_size) for day, path in zip((ONE, TWO), paths)
    ]
    # Nothing is left aside, and writing again replaces the files.
    assert sorted(tmp_path.iterdir()) == paths
    write_logs(log.where(F.col("log_date") == ONE).limit(1), str(tmp_path), kind)
    write_logs(log.where(F.col("log_date") == ONE), str(tmp_path), kind)
    read = read_zip_logs if kind == "zip" else read_csv_logs
    back = read(spark, [str(path) for path in paths])
    assert sorted(map(str, back.select(log.columns).collect())) == sorted(map(str, log.collect()))


def test_rows_without_a_day_are_not_written(spark, tmp_path):
    with pytest.raises(Exception, match="no log_date"):
        write_logs(day_table(spark, (1, None)), str(tmp_path))
    with pytest.raises(ValueError, match="kind"):
        write_logs(day_table(spark, (1, ONE)), str(tmp_path), "tar")
    assert write_logs(day_table(spark), str(tmp_path)).isEmpty()


def test_large_archives_come_first(spark, tmp_path):
    for day, n in ((ONE, 1), (TWO, 400), (THREE, 50)):
        write_zip(tmp_path, day, [line(f"10.{i}.0.a{i}", day, note=str(i * 7919)) for i in range(n)])
    rows = read_zip_logs(spark, str(tmp_path))
    order = rows.select("log_date", F.spark_partition_id().alias("task")).distinct().orderBy("task").collect()
    assert [row.log_date for row in order] == [TWO, THREE, ONE]


def test_archives_are_decoded_in_small_blocks(tmp_path):
    """Memory of a task does not follow the archive; a row over one block still comes, once and in its place."""
    schema = pa.schema([("a", pa.string()), ("b", pa.string())])
    rows = [(str(i), "x" * 90) for i in range(60_000)]
    held = []
    for name, more in (("plain", []), ("long", [("long", "y" * 3_000_000), *rows[:3]])):
        path = str(tmp_path / f"{name}.zip")
        with zipfile.ZipFile(path, "w", zipfile.ZIP_DEFLATED) as archive:
            archive.writestr("log.csv", "a,b\n" + "".join(f"{a},{b}\n" for a, b in rows + more))
        batches = list(logs._batches_of(path, schema, logs.open_path, True))
        held.append(max(batch.get_total_buffer_size() for batch in batches))
        got = pa.Table.from_batches(batches)
        assert list(zip(got["a"].to_pylist(), got["b"].to_pylist())) == rows + more
    assert held[0] < 4_000_000

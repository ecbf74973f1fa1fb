"""The log of learned locations, and the journal of lookups."""

from __future__ import annotations

import json
import os
import subprocess
import sys
from collections import Counter

import pytest

from logweir import calling, learn_locations
from logweir.schemas import LOCATIONS
from logweir.sources import journal, learned
from tests.test_locations import A, B, C, D, E, HIT, as_dict, cache, distinct_addresses, location, log_of, number
from tests.test_workers import REPO


def rows(spark, *places):
    return spark.createDataFrame(list(places), LOCATIONS)


def files(folder):
    return {p: p.stat().st_mtime_ns for p in folder.rglob("*.parquet")}


def test_answers_shadow_the_base(spark, tmp_path):
    folder, base = str(tmp_path / "l"), cache(spark)
    assert as_dict(learned.read_learned(spark, folder, base)) == as_dict(base)
    learned.append_answers(rows(spark, location(E, "DE", True), location(B, None, True)), folder)
    first = files(tmp_path / "l")
    learned.append_answers(rows(spark, location(B, "FR", True), location(A, "GB", True)), folder)
    assert first.items() <= files(tmp_path / "l").items()
    expected = {A: ("GB", True), B: ("FR", True), D: (None, True), E: ("DE", True)}
    table = learned.read_learned(spark, folder, base)
    assert as_dict(table) == expected and table.count() == 4 and table.columns == LOCATIONS.names

    # A round that was not finished does not count, and its number is used again.
    (tmp_path / "l" / "answers" / "v=0" / "round=3").mkdir()
    assert as_dict(learned.read_learned(spark, folder, base)) == expected
    learned.append_answers(rows(spark, location(C, None, True)), folder)
    expected[C] = (None, True)
    assert as_dict(learned.read_learned(spark, folder, base)) == expected


def test_compaction(spark, tmp_path):
    folder, base = str(tmp_path / "l"), cache(spark)
    learned.append_answers(rows(spark, location(B, "FR", True)), folder)
    assert not learned.compact(spark, folder, base, rounds=2)
    learned.append_answers(rows(spark, location(B, "DE", True)), folder)
    before = as_dict(learned.read_learned(spark, folder, base))
    assert learned.compact(spark, folder, base, rounds=2)
    assert learned.read_answers(spark, folder) is None
    # From here on the plain ranges do not matter.
    assert as_dict(learned.read_learned(spark, folder, rows(spark))) == before
    learned.append_answers(rows(spark, location(B, "IT", True)), folder)
    assert as_dict(learned.read_learned(spark, folder, rows(spark))) == {**before, B: ("IT", True)}


def test_run_after_one_that_broke_off(spark, tmp_path):
    folder, marks = str(tmp_path / "journal"), tmp_path / "asked"
    marks.mkdir()
    ips = [f"10.3.{n}.0" for n in range(60)]
    addresses = distinct_addresses(log_of(spark, ips))

    def fetch(ip, broken):
        if broken and ip == "10.3.40.0":
            raise SystemExit("worker gone")
        with open(marks / ip, "a") as file:
            file.write("x")
        return None if ip == "10.3.7.0" else HIT

    def learn(broken):
        resolver = calling(lambda ip: fetch(ip, broken), workers=1, pause=0.0, batch=5)
        return learn_locations(addresses, cache(spark), resolver, journal=folder)

    with pytest.raises(Exception):
        learn(True)
    first = {p.name for p in marks.iterdir()}
    kept = {r.cleaned_ip_int for r in journal.read_journal(spark, folder).collect()}
    assert len(first) - 5 < len(kept) <= len(first)
    # The end of a file that was cut short.
    broken = next((tmp_path / "journal").rglob("*.json"))
    broken.write_text(broken.read_text() + '{"cleaned_ip_int": 16')
    table = as_dict(learn(False))
    assert {ip: table[ip] for ip in ips} == {ip: (None, True) if ip == "10.3.7.0" else ("DE", True) for ip in ips}
    twice = {p.name for p in marks.iterdir() if p.read_text() != "x"}
    assert len(twice) < 5 and not {number(ip) for ip in twice} & kept
    assert journal.read_journal(spark, folder) is None


SCRIPT = """
import os, sys
sys.path.insert(0, {repo!r})
from pyspark.sql import SparkSession
from logweir import calling, learn_locations
from logweir.schemas import LOCATIONS
spark = (SparkSession.builder.master("local[2,3]").config("spark.ui.enabled", "false")
         .config("spark.sql.shuffle.partitions", "2").getOrCreate())
def fetch(ip):
    with open("asked", "a") as file:
        file.write(ip + "\\n")
    if ip == "10.4.33.0" and not os.path.exists("killed"):
        open("killed", "w").close()
        os._exit(1)
    return None
rows = [(f"10.4.{{n}}.0", 10 * 2**24 + 4 * 2**16 + n * 256) for n in range(80)]
addresses = spark.createDataFrame(rows, "cleaned_ip string, cleaned_ip_int bigint")
resolver = calling(fetch, workers=2, pause=0.0, batch=4)
table = learn_locations(addresses, spark.createDataFrame([], LOCATIONS), resolver, journal="file:" + os.getcwd() + "/journal")
print("learned", table.where("geolocation_db_attempted").count(), os.path.exists("journal"))
"""


def test_task_that_runs_again_asks_for_the_open_batch_only(tmp_path):
    done = subprocess.run(
        [sys.executable, "-c", SCRIPT.format(repo=REPO)], cwd=tmp_path, capture_output=True, text=True, timeout=300
    )
    assert "learned 80 False" in done.stdout, done.stderr[-3000:]
    asked = Counter((tmp_path / "asked").read_text().split())
    assert len(asked) == 80 and (tmp_path / "killed").exists()
    again = [ip for ip, n in asked.items() if n > 1]
    assert "10.4.33.0" in again and len(again) <= 4 and max(asked.values()) == 2


def test_journal_of_one_task(tmp_path):
    folder = f"file:{tmp_path}/j"
    assert journal.recorded(folder, 3) == {}
    journal.record(folder, 3, [(1, "x"), (2, None)])
    journal.record(folder, 3, [(3, json.dumps({"a": "é"}))])
    journal.record(folder, 4, [(9, "y")])
    assert journal.recorded(folder, 3) == {1: "x", 2: None, 3: '{"a": "\\u00e9"}'}
    assert os.path.isdir(tmp_path / "j" / "task=4")

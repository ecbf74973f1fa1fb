"""Boundaries of the rules and of address cleaning, with the default thresholds."""

from __future__ import annotations

import datetime as dt
import ipaddress
import random

import pytest
from pyspark.sql import functions as F
from pyspark.sql import types as T

from logweir import clean_log
from logweir.functions import bucket_start, clean_ip, clean_ip_to_long, ipv4_to_long, parse_datetime
from logweir.operators import rules
from logweir.operators.rules import (
    bots_by_entities,
    bots_by_rate,
    bots_by_volume,
    drop_bots,
    find_bots,
    rule_base,
    successful_requests,
    traffic_profile,
    union_of_bots,
)
from logweir.operators.lookup import spread_nulls
from logweir.schemas import RAW_LOG
from logweir.sources.workspace import written

DAY = dt.date(2024, 3, 20)
NEXT = dt.date(2024, 3, 21)
SCHEMA = T.StructType([*RAW_LOG.fields, T.StructField("log_date", T.DateType())])


def rows(ip, n, cik=1.0, minute=0, hour=10, day=DAY, code=200.0, idx=0.0, crawler=0.0, spread=False):
    """n rows of one address; ``spread`` puts each into a minute of its own."""
    made = []
    for i in range(n):
        at = minute + i if spread else minute
        time = f"{hour + at // 60:02d}:{at % 60:02d}:{i % 60 if not spread else 0:02d}"
        entity = cik[i % len(cik)] if isinstance(cik, list) else cik
        made.append((ip, day.isoformat(), time, entity, f"a{i}", code, idx, crawler, day))
    return made


def kept(spark, data, **options):
    log = spark.createDataFrame(data, SCHEMA)
    counted = clean_log(log, **options).groupBy("ip").count()
    return {row["ip"]: row["count"] for row in counted.collect()}


def test_rate_rule_needs_more_than_the_threshold(spark):
    data = rows("25.0.0.a", 25) + rows("26.0.0.a", 26)
    assert kept(spark, data) == {"25.0.0.a": 25}


def test_rate_rule_counts_within_calendar_minutes(spark):
    data = rows("1.0.0.a", 13, minute=0) + rows("1.0.0.a", 13, minute=1)
    assert kept(spark, data) == {"1.0.0.a": 26}


def test_rules_see_only_successful_requests(spark):
    data = rows("1.0.0.a", 25) + rows("1.0.0.a", 5, code=404.0)
    assert kept(spark, data) == {"1.0.0.a": 25}


def test_all_rows_of_a_bot_go(spark):
    data = rows("1.0.0.a", 26) + rows("1.0.0.a", 1, hour=11)
    assert kept(spark, data) == {}


def test_entity_rule(spark):
    data = (
        rows("3.0.0.a", 3, cik=[1.0, 2.0, 3.0])
        + rows("4.0.0.a", 4, cik=[1.0, 2.0, 3.0, 4.0])
        + rows("5.0.0.a", 4, cik=[1.0, 2.0, 3.0, 4.0], spread=True)
        + rows("6.0.0.a", 4, cik=[1.0, 2.0, 3.0, None])
    )
    assert kept(spark, data) == {"3.0.0.a": 3, "5.0.0.a": 4}


def test_null_entity_counts_in_both_forms(spark):
    log = spark.createDataFrame(rows("6.0.0.a", 8, cik=[1.0, 2.0, 3.0, None]), SCHEMA)
    base = rule_base(log)
    assert bots_by_entities(base).count() == 1
    assert traffic_profile(base).first()["max_entities"] == 4


def test_volume_rule(spark):
    v500 = [row for m in range(20) for row in rows("1.0.0.a", 25, minute=m)]
    v501 = [row for m in range(20) for row in rows("2.0.0.a", 25, minute=m)]
    v501 += rows("2.0.0.a", 1, minute=20)
    assert kept(spark, v500 + v501) == {"1.0.0.a": 500}


def test_volume_rule_is_per_day(spark):
    data = [
        row for day in (DAY, NEXT) for m in range(12) for row in rows("1.0.0.a", 25, minute=m, day=day)
    ]
    assert kept(spark, data) == {"1.0.0.a": 600}


def test_a_bot_of_one_day_is_kept_on_the_next(spark):
    data = rows("1.0.0.a", 26) + rows("1.0.0.a", 5, day=NEXT)
    assert kept(spark, data) == {"1.0.0.a": 5}


def test_log_without_day_column_is_one_day(spark):
    log = spark.createDataFrame(rows("1.0.0.a", 26) + rows("2.0.0.a", 2), SCHEMA).drop("log_date")
    result = clean_log(log)
    assert result.count() == 2
    assert "log_date" not in result.columns


def test_null_address_is_no_bot(spark):
    assert kept(spark, rows(None, 600)) == {None: 600}


def test_base_filter_drops_nulls(spark):
    data = [
        *rows("1.0.0.a", 1, code=404.0),
        *rows("1.0.0.a", 1, idx=1.0),
        *rows("1.0.0.a", 1, crawler=1.0),
        *rows("1.0.0.a", 1, code=None),
        *rows("1.0.0.a", 1, idx=None),
        *rows("1.0.0.a", 1, crawler=None),
    ]
    assert kept(spark, data) == {}


def test_rules_use_the_raw_address(spark):
    data = rows("1.0.0.abc", 13) + rows("1.0.0.xyz", 13)
    assert kept(spark, data) == {"1.0.0.abc": 13, "1.0.0.xyz": 13}


def _random_log(spark, seed=7, n=6000):
    pick = random.Random(seed)
    data = []
    for i in range(n):
        ip = None if pick.random() < 0.05 else f"10.0.{min(int(pick.expovariate(0.1)), 60)}.x"
        minute, day = pick.randrange(30), pick.choice((DAY, NEXT))
        cik = None if pick.random() < 0.1 else float(pick.randrange(5))
        data.append(
            (ip, day.isoformat(), f"09:{minute:02d}:{pick.randrange(60):02d}", cik, f"a{i}",
             200.0, 0.0, 0.0, day)
        )
    return spark.createDataFrame(data, SCHEMA)


THRESHOLDS = dict(r=6, p=3, v=120)


def test_one_pass_equals_three_rules(spark):
    base = rule_base(successful_requests(_random_log(spark))).cache()
    fused = find_bots(base, **THRESHOLDS).select("log_date", "ip")
    separate = union_of_bots(
        bots_by_rate(base, THRESHOLDS["r"]),
        bots_by_entities(base, THRESHOLDS["p"]),
        bots_by_volume(base, THRESHOLDS["v"]),
    )
    found = {tuple(row) for row in fused.collect()}
    assert found == {tuple(row) for row in separate.collect()}
    assert found


def test_kept_rows_break_no_rule(spark):
    log = _random_log(spark)
    result = clean_log(log, **THRESHOLDS).cache()
    assert find_bots(rule_base(result), **THRESHOLDS).isEmpty()
    assert result.select(log.columns).exceptAll(log).isEmpty()
    assert 0 < result.count() < log.count()


@pytest.mark.parametrize("limit", [0, 900, 2500, 10**9])
def test_every_way_to_drop_bots_gives_the_same(spark, limit):
    log = _random_log(spark)
    bots = written(find_bots(rule_base(log), **THRESHOLDS), "bots")
    expected = log.join(bots, ["log_date", "ip"], "left_anti").select(log.columns)
    result = drop_bots(log, bots, limit)
    assert result.columns == log.columns
    assert result.exceptAll(expected).isEmpty()
    assert expected.exceptAll(result).isEmpty()


def test_null_addresses_are_spread_when_the_log_is_shuffled(spark):
    log = _random_log(spark)
    bots = written(find_bots(rule_base(log), **THRESHOLDS), "bots")
    before = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        plan = drop_bots(log, bots, limit=0)._jdf.queryExecution().executedPlan().toString()
        assert "SortMergeJoin" in plan and "hashpartitioning(log_date" in plan and "_ip#" in plan
        nulls = log.where("ip IS NULL")
        keys = nulls.select(spread_nulls(nulls, "ip").alias("k")).distinct().count()
        assert keys > nulls.count() * 0.9
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", before)


def test_part_of_the_bots_can_be_broadcast(spark):
    bots = written(find_bots(rule_base(_random_log(spark)), **THRESHOLDS), "bots")
    threshold, all_fit = rules._busiest_that_fit(rules.bytes_by_level(bots), 900)
    assert threshold is not None and not all_fit
    assert rules._busiest_that_fit(rules.bytes_by_level(bots), 0) == (None, False)
    assert rules._busiest_that_fit(rules.bytes_by_level(bots), 10**9)[1]


def test_no_python_in_the_plan_and_filters_reach_the_scan(spark, tmp_path):
    _random_log(spark).write.parquet(str(tmp_path / "log"))
    log = spark.read.parquet(str(tmp_path / "log"))
    plan = clean_log(log)._jdf.queryExecution().toString()
    assert "EvalPython" not in plan
    for column in ("code", "idx", "crawler"):
        assert f"EqualTo({column}" in plan
    profile = traffic_profile(rule_base(successful_requests(log)))._jdf.queryExecution().toString()
    assert "accession" not in profile[profile.index("== Physical Plan ==") :]


CLEANED = [
    ("101.81.133.jja", "101.81.133.0", 1699841280),
    ("1.2.3.4", "1.2.3.0", 16909056),
    ("255.255.255.z", "255.255.255.0", 4294967040),
    ("0.0.0.z", "0.0.0.0", 0),
    ("1.2.3", None, None),
    ("1.2.3.", None, None),
    ("1.2.3.4.5", None, None),
    ("1.2.3.a b", None, None),
    ("1.2.3.ab\n", None, None),
    ("1.2.3.a\u00a0b", None, None),
    (" 1.2.3.ab", None, None),
    ("", None, None),
    (None, None, None),
    ("999.1.1.abc", "999.1.1.0", None),
    ("256.1.1.abc", "256.1.1.0", None),
    ("01.2.3.abc", "01.2.3.0", None),
    ("1.2.00.abc", "1.2.00.0", None),
    ("1234.2.3.abc", None, None),
]


def test_clean_ip(spark):
    data = spark.createDataFrame(CLEANED, "ip string, text string, number bigint")
    ip = F.col("ip")
    result = data.select(
        "ip", "text", "number",
        clean_ip(ip).alias("got_text"),
        clean_ip_to_long(ip).alias("got_number"),
        ipv4_to_long(clean_ip(ip)).alias("in_two_steps"),
    )
    for row in result.collect():
        assert (row.got_text, row.got_number, row.in_two_steps) == (row.text, row.number, row.number)


def _python_number(text):
    try:
        return int(ipaddress.IPv4Address(text))
    except ValueError:
        return None


def test_ipv4_to_long_equals_the_standard_library(spark):
    pick = random.Random(3)
    texts = [".".join(str(pick.randrange(300)) for _ in range(4)) for _ in range(500)]
    texts += ["1.2.3.04", "1.2.3", "1.2.3.4.5", "a.b.c.d", "1.2.3.4 ", "+1.2.3.4", "0.0.0.0"]
    data = spark.createDataFrame([(t, _python_number(t)) for t in texts], "t string, n bigint")
    wrong = data.where(~ipv4_to_long(F.col("t")).eqNullSafe(F.col("n")))
    assert wrong.collect() == []


def test_strict_addresses_raise(spark):
    one = spark.createDataFrame([("999.1.1.abc",)], "ip string")
    with pytest.raises(Exception, match="not an IPv4 address: 999.1.1.0"):
        one.select(clean_ip_to_long(F.col("ip"), strict=True)).collect()
    odd = spark.createDataFrame([("unknown",), (None,)], "ip string")
    found = odd.select(clean_ip_to_long(F.col("ip"), strict=True).alias("n")).collect()
    assert [row.n for row in found] == [None, None]


def test_datetime(spark):
    data = spark.createDataFrame(
        [("2024-03-20", "01:02:03"), (None, "01:02:03"), ("2024-03-20", None)], "d string, t string"
    )
    result = data.select(parse_datetime(F.col("d"), F.col("t")).alias("at"))
    assert result.schema["at"].dataType == T.TimestampNTZType()
    assert [row.at for row in result.collect()] == [dt.datetime(2024, 3, 20, 1, 2, 3), None, None]


@pytest.mark.parametrize(
    "date, time",
    [
        ("2024-03-20", "25:00:00"), ("2024-03-20", "24:00:00"), ("2024-02-30", "01:00:00"),
        ("2024-03-20", "1:02:03"), ("2024-3-20", "01:02:03"), ("+2024-3-20", "01:02:03"),
        ("02024-3-20", "01:02:03"), ("2024-03-20", "1:2:3.45"), ("2024-03-20", "01:02:3Z"), ("2024-03-20", "01:02:+1"), ("2024-03-20", "01:02:.5"),
        ("2024-03-20", "+1:02:03"), ("2024-03-20", "01:-2:03"),
        ("2024-03-20", "01:02:03 "), ("2024-03-20T", "01:02:03"), ("2024/03/20", "01:02:03"),
        ("2024-03-20", "01:02"), ("", ""), ("+202-03-20", "01:02:03"), ("2024-03-20", " 1:02:03"),
    ],
)
def test_other_forms_of_datetime_are_errors(spark, date, time):
    bad = spark.createDataFrame([(date, time)], "d string, t string")
    with pytest.raises(Exception):
        bad.select(parse_datetime(F.col("d"), F.col("t"))).collect()


def test_buckets_do_not_depend_on_the_session_zone(spark):
    moments = [dt.datetime(2024, 3, 31, 2, 30, 59), dt.datetime(2024, 10, 27, 2, 59, 1, 500000)]
    data = spark.createDataFrame([(m,) for m in moments], "m timestamp_ntz")
    before = spark.conf.get("spark.sql.session.timeZone")
    spark.conf.set("spark.sql.session.timeZone", "Europe/Berlin")
    try:
        result = data.select(
            *(bucket_start(F.col("m"), b).alias(b) for b in ("minute", "hour", "day"))
        )
        assert {f.dataType for f in result.schema} == {T.TimestampNTZType()}
        for moment, row in zip(moments, result.collect()):
            whole = moment.replace(second=0, microsecond=0)
            assert row.minute == whole
            assert row.hour == whole.replace(minute=0)
            assert row.day == whole.replace(minute=0, hour=0)
    finally:
        spark.conf.set("spark.sql.session.timeZone", before)
    with pytest.raises(ValueError):
        bucket_start(F.col("m"), "week")

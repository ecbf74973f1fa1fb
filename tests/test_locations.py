"""Location lookup, the cache of answers, and joins to lookup tables."""

from __future__ import annotations

import ipaddress
import json
import random
from collections import Counter

import pytest
from pyspark.sql import functions as F

from logweir import (
    Unavailable,
    attach_locations,
    calling,
    enrich_ip,
    from_table,
    learn_locations,
    load_ip_ranges,
)
from logweir.functions import location_from_payload, zone_offset
from logweir.operators.addresses import (
    distinct_addresses,
    location_table,
    locate,
    match_range,
    needs_lookup,
    repeated_starts,
    updated_locations,
)
from logweir.operators.columns import add_missing_column, conform, drop_columns, require_columns
from logweir.operators.lookup import fits_in_memory, lookup_join, row_bytes
from logweir.operators.ranges import range_conflicts
from logweir.operators.resolving import point_locations
from logweir.schemas import IP_RANGES, LOCATIONS
from logweir.sources.tables import read_latest
from logweir.sources.workspace import measured


def number(text):
    return int(ipaddress.IPv4Address(text))


A, B, C, D, E, F_, G = (f"10.0.{n}.0" for n in range(7))


def location(text, country=None, attempted=False, end=None):
    start = number(text)
    name = f"Land {country}" if country else None
    return (start, end or start, country, name, None, None, None, None, None, None, attempted)


def log_of(spark, texts):
    data = [(i, text, number(text) if text else None) for i, text in enumerate(texts)]
    return spark.createDataFrame(data, "event_id int, cleaned_ip string, cleaned_ip_int bigint")


def cache(spark):
    return spark.createDataFrame(
        [
            location(A, "US"),
            location(D, None, True),
            location(E, None, False),
            location(F_, None, False),
        ],
        LOCATIONS,
    )


def answers(spark, found):
    data = [(number(ip), payload) for ip, payload in found.items()]
    return spark.createDataFrame(data, "cleaned_ip_int bigint, payload string")


HIT = json.dumps({"country_code": "DE", "country_name": "Germany", "state": "Not found"})


def as_dict(table):
    return {
        str(ipaddress.IPv4Address(row.ip_from)): (row.country_code, row.geolocation_db_attempted)
        for row in table.collect()
    }


def test_cache_after_lookups(spark):
    log = log_of(spark, [A, B, C, D, E, None])
    resolver = from_table(answers(spark, {B: HIT, C: None, E: HIT}))
    enriched, table = enrich_ip(log, cache(spark), resolver)
    # F_ was never tried and has no country: it goes although it is not in the log.
    assert as_dict(table) == {
        A: ("US", False), B: ("DE", True), C: (None, True), D: (None, True), E: ("DE", True)
    }
    assert table.columns == LOCATIONS.names
    found = {row.cleaned_ip: row.country_code for row in enriched.collect()}
    assert found == {A: "US", B: "DE", C: None, D: None, E: "DE", None: None}
    assert "ip_from" not in enriched.columns and "ip_to" in enriched.columns


def test_nothing_missing_leaves_the_cache_alone(spark):
    asked = []

    def resolver(missing):
        asked.append(missing)
        return answers(spark, {})

    saved = []
    _, table = enrich_ip(
        log_of(spark, [A, D]), cache(spark), resolver, save=lambda t: saved.append(t) or t
    )
    assert not asked and not saved
    assert as_dict(table)[F_] == (None, False)


def test_second_run_asks_for_nothing(spark):
    log = log_of(spark, [A, B, C, E])
    resolver = from_table(answers(spark, {B: HIT, C: None, E: HIT}))
    _, first = enrich_ip(log, cache(spark), resolver)
    again = needs_lookup(locate(distinct_addresses(log), first))
    assert again.isEmpty()
    _, second = enrich_ip(log, first, resolver)
    assert as_dict(second) == as_dict(first)


def test_text_without_a_number_is_not_asked_for(spark):
    rows = [("999.1.1.0", None), (B, number(B)), (None, None)]
    addresses = spark.createDataFrame(rows, "cleaned_ip string, cleaned_ip_int bigint")
    missing = needs_lookup(locate(addresses, cache(spark)))
    assert [row.cleaned_ip for row in missing.collect()] == [B]


def test_repeated_starts_give_one_row(spark):
    twice = cache(spark).unionByName(cache(spark))
    log = log_of(spark, [A, B])
    attached = attach_locations(log, distinct_addresses(log), twice)
    assert sorted(row.event_id for row in attached.collect()) == [0, 1]
    assert repeated_starts(twice).count() == 4 and repeated_starts(cache(spark)).isEmpty()


@pytest.mark.parametrize("match", ["exact", "range"])
def test_one_row_for_an_address_after_lookups(spark, match):
    # A network with a country starts at the address; a narrower one, without, lies around it.
    end = number(A) + 255
    table = spark.createDataFrame(
        [location(A, "US", end=end), (number(A) - 1, number(A) + 1, *location(A)[2:])], LOCATIONS
    )
    log = log_of(spark, [A, A])
    _, learned = enrich_ip(log, table, from_table(answers(spark, {A: HIT})), match="range")
    # The network stays for the other addresses in it.
    assert {(row.ip_from, row.ip_to, row.country_code) for row in learned.collect()} == {
        (number(A), end, "US"), (number(A), number(A), "DE")
    }
    enriched, _ = enrich_ip(log, learned, match=match)
    assert [(row.event_id, row.country_code) for row in enriched.orderBy("event_id").collect()] == [(0, "DE"), (1, "DE")]


def test_rounds_store_their_answers_only(spark):
    addresses = distinct_addresses(log_of(spark, [f"10.2.{n}.0" for n in range(40)] + [A, E]))
    asked, saved = [], []

    def resolver(missing):
        asked.extend(row.cleaned_ip for row in missing.collect())
        return missing.select("cleaned_ip_int", F.lit(HIT).alias("payload"))

    def save(answers):
        saved.append(answers.count())
        return answers

    table = learn_locations(addresses, cache(spark), resolver, save=save, round_size=10)
    assert len(saved) == 5 and sum(saved) == 41
    assert len(asked) == len(set(asked)) == 41
    assert table.count() == 43 and as_dict(table)[E] == ("DE", True)


def test_addresses_that_got_no_answer_are_asked_again(spark):
    log = log_of(spark, [B, C])
    _, table = enrich_ip(log, cache(spark), from_table(answers(spark, {B: HIT})))
    assert C not in as_dict(table)
    missing = needs_lookup(locate(distinct_addresses(log), table))
    assert [row.cleaned_ip for row in missing.collect()] == [C]


def test_answer_that_is_no_json_is_not_remembered(spark):
    found = point_locations(answers(spark, {A: "{oops", B: HIT, C: None}))
    assert set(as_dict(found)) == {B, C}


def test_calling_retries_and_remembers_failures(spark):
    def fetch(ip):
        tries = fetch.tries = getattr(fetch, "tries", 0) + 1
        if ip == A:
            return HIT
        if ip == B:
            raise ConnectionError("down")
        if ip == C:
            return None
        if tries % 2:
            raise Unavailable
        return HIT

    log = log_of(spark, [A, B, C, D])
    resolver = calling(fetch, workers=2, tries=3, pause=0.0)
    found = as_dict(point_locations(resolver(log.select("cleaned_ip", "cleaned_ip_int"))))
    assert found == {A: ("DE", True), B: (None, True), C: (None, True), D: ("DE", True)}


def test_lookups_run_once_in_so_many_tasks(spark):
    log = log_of(spark, [f"10.1.{n}.0" for n in range(200)])
    asked = calling(lambda ip: HIT, workers=5)(log)
    assert asked.rdd.getNumPartitions() == 5
    assert asked.count() == 200


def test_table_without_mark_gets_one(spark):
    plain = spark.createDataFrame([location(A, "US")[:-1]], IP_RANGES)
    assert as_dict(location_table(plain)) == {A: ("US", False)}


def test_postcodes_stay_text(spark):
    numbers = spark.createDataFrame([(1, 1, 99999)], "ip_from bigint, ip_to bigint, zip_code bigint")
    texts = conform(
        spark.createDataFrame([(2, 2, "AB1 2CD")], "ip_from bigint, ip_to bigint, zip_code string"),
        LOCATIONS,
    ).withColumn("country_code", F.lit("GB"))
    table = updated_locations(numbers.withColumn("country_code", F.lit("US")), texts)
    assert sorted(row.zip_code for row in table.collect()) == ["99999", "AB1 2CD"]


def test_exact_match_looks_at_the_start_only(spark):
    start = number(A)
    table = spark.createDataFrame([location(A, "US", end=start + 1023)], LOCATIONS)
    addresses = distinct_addresses(log_of(spark, [A, B]))
    exact = {r.cleaned_ip: r.country_code for r in locate(addresses, table, "exact").collect()}
    ranged = {r.cleaned_ip: r.country_code for r in locate(addresses, table, "range").collect()}
    assert exact == {A: "US", B: None}
    assert ranged == {A: "US", B: "US"}
    with pytest.raises(ValueError):
        locate(addresses, table, "nearest")


def narrowest(x, ranges):
    holding = [(end - start, start, end) for start, end in ranges if start <= x <= end]
    return min(holding)[1:] if holding else None


def check_ranges(spark, ranges, probes):
    table = conform(
        spark.createDataFrame(
            [(a, b, f"{a}-{b}") for a, b in ranges],
            "ip_from bigint, ip_to bigint, country_code string",
        ),
        LOCATIONS,
    )
    addresses = spark.createDataFrame([(x,) for x in [*probes, None]], "cleaned_ip_int bigint")
    found = match_range(addresses, table)
    got = {row.cleaned_ip_int: row.country_code for row in found.collect()}
    want = {x: narrowest(x, ranges) for x in probes}
    assert got == {x: f"{r[0]}-{r[1]}" if r else None for x, r in want.items()} | {None: None}
    inner = match_range(addresses, table, "inner")
    assert inner.count() == sum(r is not None for r in want.values())


def test_range_edges(spark):
    ranges = [
        (256, 511), (512, 512), (1000, 70000), (70001, 400000), (2**32 - 256, 2**32 - 1), (9, 5)
    ]
    edges = {x + d for pair in ranges for x in pair for d in (-1, 0, 1)}
    check_ranges(spark, ranges, sorted(x for x in edges if 0 <= x < 2**32))


@pytest.mark.parametrize("overlap", [False, True])
def test_range_equals_brute_force(spark, overlap):
    pick = random.Random(11)
    if overlap:
        ranges = set()
        while len(ranges) < 300:
            start = pick.randrange(2**24)
            ranges.add((start, start + int(2 ** pick.uniform(0, 21))))
    else:
        cuts = sorted(pick.sample(range(2**22), 800))
        ranges = {(a, b - 1) for a, b in zip(cuts[::2], cuts[1::2])}
    probes = {pick.randrange(2**24 if overlap else 2**22) for _ in range(2500)}
    probes |= {a for a, _ in ranges} | {b for _, b in ranges} | {b + 1 for _, b in ranges}
    check_ranges(spark, sorted(ranges), sorted(probes))


def test_whole_address_space_is_one_range(spark):
    check_ranges(spark, [(0, 2**32 - 1)], [0, 1, 2**31, 2**32 - 1])


def test_range_plan_has_no_nested_loop(spark, tmp_path):
    cache(spark).write.parquet(str(tmp_path / "cache"))
    table = spark.read.parquet(str(tmp_path / "cache"))
    plan = match_range(distinct_addresses(log_of(spark, [A])), table)
    text = plan._jdf.queryExecution().toString()
    assert "NestedLoop" not in text and "CartesianProduct" not in text


@pytest.mark.parametrize("limit", [0, 10**9])
def test_both_ways_to_join_a_lookup_table(spark, limit):
    facts = spark.createDataFrame(
        [(i, None if i % 3 == 0 else i % 7) for i in range(200)], "id int, k int"
    )
    table = spark.createDataFrame([(n, f"v{n}") for n in range(5)], "n int, v string")
    expected = facts.join(table, facts.k == table.n, "left").drop("n")
    result = lookup_join(facts, table, "k", "n", limit)
    assert result.columns == ["id", "k", "v"]
    assert sorted(map(str, result.collect())) == sorted(map(str, expected.collect()))
    plan = result._jdf.queryExecution().toString()
    assert ("ResolvedHint (strategy=broadcast)" in plan) == (limit > 0)


def test_hot_keys_are_split_when_both_sides_are_shuffled(spark):
    settings = {
        "spark.sql.autoBroadcastJoinThreshold": "-1",
        "spark.sql.adaptive.autoBroadcastJoinThreshold": "-1",
        "spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes": "100KB",
        "spark.sql.adaptive.advisoryPartitionSizeInBytes": "50KB",
        "spark.sql.shuffle.partitions": "16",
    }
    before = {name: spark.conf.get(name, None) for name in settings}
    for name, value in settings.items():
        spark.conf.set(name, value)
    try:
        # Two thirds of the rows: one key, and no key at all.
        n = 300_000
        key = F.when(F.col("id") % 3 == 0, 1).when(F.col("id") % 3 == 1, None).otherwise(F.col("id") % 997)
        facts = spark.range(0, n, 1, 8).select("id", key.alias("k"), F.sha2(F.col("id").cast("string"), 256).alias("s"))
        table = spark.range(997).select(F.col("id").alias("n"), F.col("id").alias("v"))
        result = lookup_join(facts, table, "k", "n", limit=0)
        by_task = result.groupBy(F.spark_partition_id().alias("p"))
        sizes = by_task.agg(F.count(F.lit(1)).alias("n"), F.max("s"), F.count("v").alias("v"))
        tasks = sizes.collect()
        assert sum(row.n for row in tasks) == n and sum(row.v for row in tasks) == n * 2 // 3
        assert max(row.n for row in tasks) < n // 6
        plan = sizes._jdf.queryExecution().executedPlan().toString()
        assert "SortMergeJoin(skew=true)" in plan and "hashpartitioning(_key" in plan
    finally:
        for name, value in before.items():
            spark.conf.set(name, value) if value is not None else spark.conf.unset(name)


def test_size_check(spark):
    small = spark.range(10)
    assert fits_in_memory(small, 10 * 32)
    assert not fits_in_memory(small, 10 * 32 - 1)
    assert fits_in_memory(small.where("id < 0"), 0)


@pytest.mark.parametrize("limit", [0, 10**9])
def test_locations_reach_every_row(spark, limit):
    log = log_of(spark, [A, A, B, None, None, D])
    attached = attach_locations(log, distinct_addresses(log), cache(spark), limit=limit)
    got = sorted((r.event_id, r.country_code, r.geolocation_db_attempted) for r in attached.collect())
    assert got == [
        (0, "US", False), (1, "US", False), (2, None, None), (3, None, None), (4, None, None),
        (5, None, True),
    ]


PAYLOAD = {
    "country_code": "IN", "country_name": "India", "state": "Not found", "city": "Pune",
    "postal": "411001", "latitude": 18.5, "longitude": "73.9", "zone": "Asia/Kolkata",
}


def test_payload(spark):
    cases = [
        json.dumps(PAYLOAD),
        json.dumps(dict.fromkeys(PAYLOAD, "Not found")),
        json.dumps(PAYLOAD | {"latitude": "Not found"}),
        json.dumps(PAYLOAD | {"latitude": "north"}),
        "{}",
        None,
        "no json",
    ]
    data = spark.createDataFrame([(i, c) for i, c in enumerate(cases)], "i int, p string")
    at = F.lit("2024-01-01T00:00:00Z").cast("timestamp")
    place = location_from_payload(F.col("p"), at)
    rows = [row.place for row in data.select("i", place.alias("place")).orderBy("i").collect()]
    assert tuple(rows[0]) == ("IN", "India", None, "Pune", 18.5, 73.9, "411001", "+05:30")
    assert all(value is None for value in rows[1])
    for row in rows[2:4]:
        assert (row.latitude, row.longitude, row.timezone, row.city_name) == (None, 73.9, None, "Pune")
    assert all(value is None for value in rows[4])
    assert all(value is None for value in rows[5])
    assert rows[6] is None


def test_offsets_follow_daylight_saving(spark):
    data = spark.createDataFrame(
        [("2024-01-01T00:00:00Z",), ("2024-07-01T00:00:00Z",)], "at string"
    )
    zones = ["America/New_York", "Asia/Kolkata", "America/St_Johns", "Etc/UTC"]
    at = F.col("at").cast("timestamp")
    rows = data.orderBy("at").select(*(zone_offset(F.lit(z), at).alias(z) for z in zones)).collect()
    assert list(rows[0]) == ["-05:00", "+05:30", "-03:30", "+00:00"]
    assert list(rows[1]) == ["-04:00", "+05:30", "-02:30", "+00:00"]


def test_load_ip_ranges(spark, tmp_path):
    source = tmp_path / "ranges.csv"
    source.write_text(
        '"0","16777215","-","-","-","-","0.0","0.0","-","-"\n'
        '"16777216","16777471","US","United States","California","Los Angeles",'
        '"34.05","-118.24","90001","-07:00"\n'
    )
    table = load_ip_ranges(spark, str(source), str(tmp_path / "ranges"))
    assert table.schema == IP_RANGES
    assert table.where("ip_from = 16777216").first().zip_code == "90001"
    good = source.read_text()
    faulty = {
        "more than once: 2 times, the first at 0": good * 2,
        "before they start": good.replace("16777471", "16777000"),
        "IPv4": good.replace("16777471", "99999999999"),
    }
    for message, text in faulty.items():
        source.write_text(text)
        with pytest.raises(ValueError, match=message):
            load_ip_ranges(spark, str(source), str(tmp_path / "ranges"))
    # The good table is still there.
    assert read_latest(spark, str(tmp_path / "ranges")).count() == 2


def test_column_steps(spark):
    one = spark.range(1)
    assert add_missing_column(one, "x", False).columns == ["id", "x"]
    assert add_missing_column(one, "id", False).schema == one.schema
    assert drop_columns(one.withColumn("x", F.lit(1)), "x", "absent").columns == ["id"]
    assert require_columns(one, ["id"]) is one
    with pytest.raises(ValueError, match="missing required columns"):
        require_columns(one, ["id", "name"])


def test_measured_while_writing(spark):
    rows = spark.createDataFrame([("a" * n, n) for n in (0, 1, 2, 3, 8, 900)], "name string, n long")
    found = measured(rows, "t")
    assert found.rows == found.table.count() == 6
    assert found.bytes == rows.agg(F.sum(row_bytes(rows))).first()[0]


@pytest.mark.parametrize("condition", ["n > 1000", "false"])
def test_measured_without_rows(spark, condition):
    rows = spark.createDataFrame([("a", 1)], "name string, n long").where(condition)
    found = measured(rows, "t")
    assert (found.rows, found.bytes) == (0, 0)
    assert found.table.isEmpty() and found.table.schema == rows.schema


def _plain_conflicts(ranges):
    out = Counter()
    starts = {}
    for a, b in ranges:
        if a is None or b is None or not (0 <= a < 2**32 and 0 <= b < 2**32):
            out[a, b, "outside"] += 1
        elif b < a:
            out[a, b, "reversed"] += 1
        else:
            starts.setdefault(a, []).append(b)
    rows = [(a, b, kind, n, None) for (a, b, kind), n in out.items()]
    reach = -1
    for a in sorted(starts):
        end, n = max(starts[a]), len(starts[a])
        if n > 1:
            rows.append((a, end, "repeated", n, None))
        if reach >= a:
            rows.append((a, end, "overlapping", n, reach))
        reach = max(reach, end)
    return sorted(rows, key=str)


def test_range_conflicts(spark):
    rng = random.Random(5)
    # Ranges across the edges of the sweep's blocks, and one over all of them.
    for wide in (False, True):
        ranges = [(a := rng.randrange(40) * 2**18 + rng.randrange(3), a + rng.choice([-1, 0, 5, 2**18, 2**21])) for _ in range(80)]
        ranges += [(None, 5), (5, None), (-1, 4), (4, 2**32), (2**32 - 1, 2**32 - 1)] + [(7, 7)] * 20
        if wide:
            ranges += [(0, 2**32 - 1)]
        table = spark.createDataFrame(ranges, "ip_from long, ip_to long")
        assert sorted(map(tuple, range_conflicts(table).collect()), key=str) == _plain_conflicts(ranges)
    assert range_conflicts(table.limit(0)).isEmpty()

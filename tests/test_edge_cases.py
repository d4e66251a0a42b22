"""Nulls, empty tables, long texts, ties, repeated rows, clashing names and hot keys for the general problems' operators."""

from __future__ import annotations

from datetime import UTC, date, datetime
from decimal import Decimal

import pytest
from pyspark.sql import functions as F

from lodestrom.functions.coordinates import point_of
from lodestrom.functions.repair import EMPTY, csv_fields, csv_parse, json_object, json_parse, number_fault, number_state
from lodestrom.functions.stamps import read_date, read_time
from lodestrom.operators import delivery, instants, joins, lateness, lines, proximity, references, rolling


def rows(df, *columns):
    return sorted(tuple(r) for r in (df.select(*columns) if columns else df).collect())


def ts(text):
    return datetime.fromisoformat(text).replace(tzinfo=UTC)


@pytest.fixture
def tiny_limits(monkeypatch):
    """No side is small enough to be broadcast, and two rows make a key hot."""
    monkeypatch.setattr(joins, "BROADCAST_BYTES", 0)
    monkeypatch.setattr(joins.skew_safe_join, "__defaults__", ("inner", 0.01, 1))


# --- joins
@pytest.mark.parametrize("how", ["inner", "left", "left_semi", "left_anti"])
def test_skew_safe_join_equals_join(spark, tiny_limits, how):
    left = spark.createDataFrame([(k, i) for i, k in enumerate(["a"] * 50 + ["b", "c", None, None, "d", "d"])], "k string, i int")
    right = spark.createDataFrame([("a", 1), ("a", 2), ("b", 3), (None, 4), ("z", 5)], "k string, v int")
    assert rows(joins.skew_safe_join(left, right, "k", how).withColumn("k", F.coalesce("k", F.lit("-"))).na.fill(-1)) == rows(left.join(right, "k", how).withColumn("k", F.coalesce("k", F.lit("-"))).na.fill(-1))


def test_hot_keys_are_few_and_never_null(spark):
    df = spark.createDataFrame([("a",)] * 60 + [(None,)] * 30 + [("b",)] * 10, "k string")
    assert joins.hot_keys(df, "k", 0.5, 1) == ["a"] and joins.hot_keys(df, "k", 0.5) == []
    assert joins.hot_keys(df.where("k is null"), "k", 0.5, 1) == []


# --- 1: places
RING = [(0.0, 0.0), (0.0, 4.0), (4.0, 4.0), (4.0, 0.0)]
HOLLOW = [(0.0, 0.0), (0.0, 6.0), (6.0, 6.0), (6.0, 0.0), (4.0, 0.0), (2.0, 3.0)]


def regions(spark, *named):
    return spark.createDataFrame([(i, [{"lat": a, "lon": b} for a, b in r] if r is not None else None) for i, r in named], "place_id string, ring array<struct<lat: double, lon: double>>")


def points(spark, *named):
    return spark.createDataFrame(list(named), "point_id string, lat double, lon double")


def test_regions_with_boundaries_and_useless_rings(spark):
    area = regions(spark, ("square", RING), ("square", RING), ("closed", [*RING, RING[0]]), ("line", RING[:2]), ("none", None), ("flat", [(1.0, 1.0)] * 3))
    at = points(spark, ("in", 1.0, 1.0), ("edge", 0.0, 2.0), ("corner", 4.0, 4.0), ("out", 5.0, 1.0), ("beside", 2.0, 4.5), ("nowhere", None, 1.0), ("nan", float("nan"), 1.0), ("in", 1.0, 1.0))
    found = rows(proximity.points_in_regions(at, area), "point_id", "place_id")
    assert found == sorted([(p, r) for p in ("in", "in", "edge", "corner") for r in ("square", "closed")])


def test_rays_through_corners_count_once(spark):
    area = regions(spark, ("hollow", HOLLOW))
    at = points(spark, *[(f"{y},{x}", y, x) for y in (1.0, 2.0, 3.0, 4.0, 5.0) for x in (0.5, 2.5, 3.5, 5.5)])
    found = {p for p, in rows(proximity.points_in_regions(at, area), "point_id")}
    for y in (1.0, 2.0, 3.0, 4.0, 5.0):
        for x in (0.5, 2.5, 3.5, 5.5):
            notch = 1.5 * y if y <= 2 else 3 - 1.5 * (y - 2) if y <= 4 else 0  # the bite from the left side
            assert (f"{y},{x}" in found) == (x >= notch if y < 4 else True), (y, x)


def test_regions_beyond_the_broadcast_limit(spark, monkeypatch):
    at, area = points(spark, ("in", 1.0, 1.0), ("out", 9.0, 9.0)), regions(spark, ("square", RING))
    monkeypatch.setattr(proximity, "broadcast_if_small", lambda df, *_: df)
    assert rows(proximity.points_in_regions(at, area), "point_id") == [("in",)]


def test_slanted_edges_and_detailed_borders(spark, monkeypatch):
    slanted = regions(spark, ("slanted", [(0.1, 0.1), (0.7, 2.2), (3.1, 0.3)]))
    on = [(0.1 + 0.6 * k / 7, 0.1 + 2.1 * k / 7) for k in range(8)]
    at = points(spark, *[(f"on{i}", y, x) for i, (y, x) in enumerate(on)], *[(f"off{i}", y - 1e-6, x + 1e-6) for i, (y, x) in enumerate(on)])
    assert {p for p, in rows(proximity.points_in_regions(at, slanted), "point_id")} == {f"on{i}" for i in range(8)}
    monkeypatch.setattr(proximity, "STRIP_EDGES", 3)
    assert {p for p, in rows(proximity.points_in_regions(at, slanted), "point_id")} == {f"on{i}" for i in range(8)}
    fine = regions(spark, ("fine", [(k / 500, 1.0 + (k % 2) / 1000) for k in range(500)] + [(1.0, 0.0), (0.0, 0.0)]))
    strips, height = proximity.fitting_strips(fine)
    assert height < proximity.STRIP_DEG and strips.agg(F.max(F.size("edges"))).first()[0] <= 6
    inside = rows(proximity.points_in_regions(points(spark, ("in", 0.5, 0.5), ("out", 0.5, 1.5), ("west", 0.5, -0.5)), fine), "point_id")
    assert inside == [("in",)]


def test_near_points_at_all_radii(spark):
    centres = spark.createDataFrame([("tiny", -30.0, 25.0, 0.0), ("near", -30.0, 25.0, 1500.0), ("wide", -29.0, 25.0, 200_000.0), ("bad", -30.0, 25.0, float("nan")), ("none", None, 25.0, 5.0), ("near", -30.0, 25.0, 1500.0)], "place_id string, c_lat double, c_lon double, radius_m double")
    at = points(spark, ("same", -30.0, 25.0), ("1km", -30.0089, 25.0), ("2km", -30.018, 25.0), ("100km", -30.0, 26.0), ("far", -35.0, 25.0))
    assert rows(proximity.points_near(at, centres), "point_id", "place_id") == sorted([("same", "tiny"), ("same", "near"), ("same", "wide"), ("1km", "near"), ("1km", "wide"), ("2km", "wide"), ("100km", "wide")])


def test_clashing_names_of_points(spark):
    at = points(spark, ("in", 1.0, 1.0)).selectExpr("*", "'x' as edges", "'y' as strip", "'z' as level", "1 as c_lat", "'old' as place_id", "2 as `a.b`")
    found = proximity.points_in_regions(at, regions(spark, ("square", RING)))
    assert found.first().asDict() == {"point_id": "in", "lat": 1.0, "lon": 1.0, "edges": "x", "strip": "y", "level": "z", "c_lat": 1, "a.b": 2, "place_id": "square"}
    centre = spark.createDataFrame([("c", 1.0, 1.0, 5.0)], "place_id string, c_lat double, c_lon double, radius_m double")
    assert proximity.points_near(at, centre).first().asDict() == found.first().asDict() | {"place_id": "c"}


def test_places_of_empty_tables(spark):
    none = points(spark)
    centres = spark.createDataFrame([], "place_id string, c_lat double, c_lon double, radius_m double")
    assert rows(proximity.points_in_regions(none, regions(spark, ("a", RING)))) == rows(proximity.points_in_regions(points(spark, ("p", 1.0, 1.0)), regions(spark))) == []
    assert rows(proximity.points_near(points(spark, ("p", 1.0, 1.0)), centres)) == []


COORDINATES = {
    "-26.2041,28.0473": (-26.2041, 28.0473), " ( -26.5 , 28.5 ) ": (-26.5, 28.5), "-28,559;24,065": (-28.559, 24.065), "-28.5 24.1": (-28.5, 24.1),
    "S24.5 E19.25": (-24.5, 19.25), "27.5S, 29.5E": (-27.5, 29.5), "19.25E,24.5S": (-24.5, 19.25), "e31.5 s27.5": (-27.5, 31.5), "POINT (30.5 -31.5)": (-31.5, 30.5), "point(30.5 -31.5)": (-31.5, 30.5),
    "27°30'00.0\"S 25°45'00.0\"E": (-27.5, 25.75), "-35,16": (-35.0, 16.0), "-22,33": (-22.0, 33.0),
    "28.0,-26.2": None, "0,0": None, "": None, None: None, "NaN,NaN": None, "-26.2": None, "-26.2,": None, "1,2,3": None, "unknown": None, "-28,559,24,065": None, "S24.5 S19.2": None, "S-24.5 E19.2": None,
    "24.5S 19.2": None, "27°75'00\"S 25°45'00\"E": None, "-36,20": None, "POINT (30.5)": None, "x" * 100_000: None,
}


def test_coordinate_notations(spark):
    df = spark.createDataFrame([(k,) for k in COORDINATES], "t string").select("t", point_of(F.col("t")).alias("p"))
    for t, p in df.collect():
        want = COORDINATES[t]
        assert (p is None) == (want is None) and (p is None or (pytest.approx(want[0]), pytest.approx(want[1])) == (p.lat, p.lon)), t


# --- 2: trailing totals
def test_trailing_totals_fill_idle_days(spark):
    data = [("a", "2024-01-01", "10.00", 1), ("a", "2024-01-01", "5.00", 1), ("a", "2024-01-10", "-1.50", 1), ("b", "2024-02-29", "9999999999999999.99", 1), (None, "2024-01-01", "1", 1), ("a", None, "1", 1), ("a", "2024-01-05", None, 1)]
    df = spark.createDataFrame(data, "entity string, day string, amount string, n int")
    daily = rolling.daily_totals(df, "entity", "day", "amount")
    got = {(r.entity, r.day.isoformat()): r for r in rolling.trailing_totals(daily, (3, 7)).collect()}
    assert len(got) == 11
    assert [got["a", f"2024-01-{d:02}"].total_7 for d in range(1, 11)] == [Decimal("15.00")] * 7 + [Decimal("0.00")] * 2 + [Decimal("-1.50")]
    assert [got["a", f"2024-01-{d:02}"].active_3 for d in range(1, 11)] == [2, 2, 2, 0, 0, 0, 0, 0, 0, 1]
    assert got["a", "2024-01-07"].mean_7 == pytest.approx(15 / 7) and got["b", "2024-02-29"].total_3 == Decimal("9999999999999999.99")


def test_surges_and_lulls(spark):
    data = [("a", "2024-01-01", "1"), ("a", "2024-01-30", "25000"), ("a", "2024-02-10", "1"), ("b", "2024-01-01", "1"), ("b", "2024-01-29", "30000"), ("b", "2024-02-20", "1")]
    daily = rolling.daily_totals(spark.createDataFrame(data, "e string, d string, x string"), "e", "d", "x")
    got = rows(rolling.surges_and_lulls(rolling.trailing_totals(daily)))
    assert [(e, d.isoformat(), p) for e, d, p in got if e == "a"] == [("a", f"2024-{d}", "surge") for d in ("01-30", "01-31", "02-01", "02-02", "02-03", "02-04", "02-05")] + [("a", f"2024-{d}", "lull") for d in ("02-06", "02-07", "02-08", "02-09")]
    assert rows(rolling.surges_and_lulls(rolling.trailing_totals(daily.where("false")))) == []


# --- 3: references
def orphans(spark, refs, parents):
    r = spark.createDataFrame(refs, "row_id long, ref string, at timestamp, maybe int, key string")
    p = spark.createDataFrame(parents, "id string, loaded_at timestamp, removed_at timestamp, at int")
    return rows(references.find_orphans(r, p, "ref", "at", "row_id", "id"), "row_id", "orphan_type")


def test_orphans_by_kind(spark, tiny_limits):
    t = [ts(f"2024-0{m}-01") for m in range(1, 7)]
    parents = [("a", t[0], None, 1), ("A-", t[0], None, 1), ("b", t[1], t[2], 1), ("b", t[3], None, 1), ("c", t[4], None, 1), (None, t[0], None, 1), ("d", None, None, 1), ("e", t[1], t[1], 1)]
    refs = [(1, "A", t[0], 0, ""), (2, "b", t[0], 0, ""), (3, "b", t[1], 0, ""), (4, "b", t[2], 0, ""), (5, "B", t[3], 0, ""), (6, "c", t[3], 0, ""), (7, "x", t[3], 0, ""), (8, None, t[0], 0, ""), (9, " - ", t[0], 0, ""), (10, "a", None, 0, ""), (11, "d", t[1], 0, ""), (12, "e", t[1], 0, ""), (7, "x", t[3], 0, "")]
    assert orphans(spark, refs, parents) == [(2, "late"), (4, "deleted"), (6, "late"), (7, "missing"), (7, "missing"), (10, "deleted"), (11, "deleted"), (12, "deleted")]


def test_orphans_of_empty_tables(spark):
    t = ts("2024-01-01")
    assert orphans(spark, [(1, "a", t, 0, "")], []) == [(1, "missing")]
    assert orphans(spark, [], [("a", t, None, 1)]) == []


def test_parent_with_very_many_lives(spark, monkeypatch):
    """More periods than an array may hold: matched by key and month instead, with the same result."""
    days = [ts(f"2024-{m:02}-{d:02}") for m in (1, 2, 3) for d in range(1, 29)]
    parents = [("hot", days[i], days[i + 1], 1) for i in range(0, len(days) - 1, 2)]
    refs = [(i, "hot", d, 0, "") for i, d in enumerate(days)]
    whole = orphans(spark, refs, parents)
    monkeypatch.setattr(references, "MANY_PERIODS", 3)
    assert orphans(spark, refs, parents) == whole == [(i, "deleted") for i in range(1, len(days), 2)]


def test_bloom_filter_has_no_false_negatives(spark):
    keys = spark.range(5000).select(F.col("id").cast("string").alias("key"))
    bloom, blocks = references.build_bloom(keys, "key", 5000)
    probe = lambda a, b: references.probe_bloom(spark.range(a, b).select(F.col("id").cast("string").alias("key")), "key", bloom, blocks).where("maybe").count()
    assert probe(0, 5000) == 5000 and probe(5000, 25000) < 600


# --- 4: lines
GOOD = "a,b,SAVINGS,ACTIVE,2024-01-01,BASIC,,APP,{},{},2024-02-01"
CSV = {
    GOOD.format("", "1.00"): None, GOOD.format("5", " +1.5 "): None, GOOD.format("", '"1.00"'): None, GOOD.format("", ""): "missing_value", GOOD.format("x", ""): "missing_value", GOOD.format("x", "1"): "bad_number",
    GOOD.format("", "1,00"): "column_count", GOOD.format("", '"1,00"'): "bad_number", GOOD.format("", "1.234"): "bad_number", GOOD.format("", "12345678901234567"): "bad_number", GOOD.format("", "٣٤.٥٠"): "bad_number",
    GOOD.format("", '"1'): "bad_quoting", GOOD.format("", '1"'): "bad_quoting", GOOD.format("", '"1"2'): "bad_quoting", "": "column_count", None: "column_count", '"': "bad_quoting", "a;b": "column_count",
    GOOD.format("", "1") + "\n": "bad_quoting", "x" * 300_000: "column_count", '"' * 5001: "bad_quoting", "," * 6000: "column_count",
}
JSON = {
    '{"amount": 1.5}': None, '{"amount": "1.50 "}': None, ' {"amount": 12, "a": [1, {"b": null}]} ': None, '{"amount": 1e2}': "bad_number", '{"amount": true}': "bad_number", '{"amount": {"v": 1}}': "bad_number", '{"amount": null}': "missing_value",
    '{"amount": "  "}': "missing_value", "{}": "missing_value", '{"amount": 1, "amount": "x"}': "bad_number", '{"amount": 1,}': "bad_json", '{"amount": NaN}': "bad_json", '{"amount": 01}': "bad_json", "[1]": "bad_json", "": "bad_json", None: "bad_json",
    '{"amount": 1} {"amount": 2}': "bad_json", '{"a": "AP"P"}': "bad_json", '{amount: 1}': "bad_json", '"amount": 1}': "bad_json", "{'amount': 1}": "bad_json", '{"a": "\t"}': "bad_json", "[" * 100_000: "bad_json", '{"amount": ' + "9" * 5000 + "}": "bad_number",
}


@pytest.mark.parametrize(("name", "cases"), [("accounts.csv", CSV), ("x/TRANSACTIONS.JSONL", JSON)])
def test_line_faults(spark, name, cases):
    texts = list(cases)
    df = spark.createDataFrame([(i, name, t, "clash") for i, t in enumerate(texts)], "line_id long, file_name string, line_text string, fault string")
    loaded, rejected = lines.split_lines(lines.parse_lines(df))
    got = {r.line_id: r.fault for r in rejected.collect()} | {r.line_id: None for r in loaded.collect()}
    assert {texts[i]: f for i, f in got.items()} == cases


def test_other_files_are_ignored_and_empty_tables_load(spark):
    df = spark.createDataFrame([(1, "notes.txt", "x"), (2, None, "x")], "line_id long, file_name string, line_text string")
    assert rows(lines.parse_lines(df)) == [] == rows(lines.parse_lines(df.where("false")))


def cheapest_by_search(line, columns, typed):
    """Fewest insertions and deletions of quotes, commas and line breaks, and unreadable values, by trying all of them."""
    def left(text):
        fields = csv_fields(text)
        if fields is None or len(fields) != columns:
            return None
        return sum(number_fault(number_state(EMPTY, fields[k]), need) is not None for k, need in typed.items())

    best, level, seen = None, {line}, {line}
    for cost in range(9):
        for text in level:
            wrong = left(text)
            if wrong is not None and (best is None or cost + wrong < best):
                best = cost + wrong
        if best is not None and best <= cost + 1:
            return best
        edited = {t[:i] + m + t[i:] for t in level for i in range(len(t) + 1) for m in '",'} | {t[:i] + t[i + 1 :] for t in level for i in range(len(t)) if t[i] in '",\n'}
        level = edited - seen
        seen |= level
    return best


def test_csv_edits_are_the_fewest():
    import random

    rng = random.Random(5)
    for _ in range(60):
        line = ""
        for _ in range(rng.randrange(7)):
            line += rng.choice('1a",\n' if line[-1:] not in ("1", "a") else '",\n')  # runs of one character: edits are made between runs
        for typed in ({}, {1: True}):
            p = csv_parse(line, 2, typed)
            assert p.cost == len(p.edits) == cheapest_by_search(line, 2, typed), (line, typed, p)
            assert p.valid == (csv_fields(line) is not None) and (p.cost > 0 or len(p.value) == 2)


def test_many_errors_and_long_lines_are_parsed():
    for line, cost in (('"' * 3001, None), ("," * 3000, 3), ("x" * 300_000, 11)):
        p = csv_parse(line, 11, {9: True})
        assert p.cost == len(p.edits) > 0 and cost in (None, p.cost)


DEEP = '{"a":' * 20_000 + '{"amount":1}' + "}" * 20_000


def test_json_edits():
    cases = {
        '{"amount": 1}': 0, '{"amount": 1': 1, '"amount": 1}': 1, '{"amount": 1,}': 1, '{"amount" 1}': 1, "{amount: 1}": 2, '{"amount": 1, "a": [1, 2}': 1, '{"amount": "x"}': 1, "{}": 1, '{"amount": [1]}': 1,
        '{"amount": 1, "a": "x\ty"}': 1, '{"amount": 1} {"amount": 2}': 3, "{'amount': 1}": 3, '{"amount": 1, "a": ' + '{"a":' * 10 + "1" + "}" * 10: 1,
    }
    for line, cost in cases.items():
        p = json_parse(line)
        assert (p.cost, p.least) == (cost, True) and len(p.edits) <= cost, line
        assert p.valid == (json_object(line) is not None)


def test_json_of_any_depth_and_any_damage():
    assert json_object(DEEP) is not None and json_parse(DEEP).valid and json_parse(DEEP).cost == 1
    cut = json_parse(DEEP[:-1])
    assert not cut.valid and cut.cost >= 1
    wild = json_parse('"' * 5001)
    assert not wild.valid and not wild.least and wild.cost == len(wild.edits)


def test_edits_of_much_damaged_json_are_the_fewest():
    import random

    from lodestrom.functions.repair import _JSON_SYMBOLS, _json_edits, _json_edits_by_level
    from lodestrom.operators.lines import _json

    for line, cost in (('"' * 5001, 2503), ('{"amount":1,"b":' + '{"a":' * 300, 302), ('["a",' * 30, 36)):
        said = _json(line)
        assert (said["fault"], said["cost"], said["least"]) == ("bad_json", cost, True)
        assert 0 < len(said["edits"].split("; ")) <= cost
    rng, compared = random.Random(7), 0
    parts = ["{", "}", "[", "]", ":", ",", '"', '"amount"', "1", '"a"', "x", "\\n", " ", "\t", '"amount":', '"b":2']
    for _ in range(80):
        symbols = _JSON_SYMBOLS.findall("".join(rng.choice(parts) for _ in range(rng.randint(0, 10))))
        if found := _json_edits(symbols, "amount"):
            compared += 1
            assert found[0] == _json_edits_by_level(symbols, "amount")[0], symbols
    assert compared > 60


def test_json_reader_agrees_with_the_standard_one():
    import json
    import random

    rng = random.Random(11)
    atoms = ['"a"', "1", "-2.50", "true", "null", '"x\\n"', "1e5", '"\\ud83d"', "[]", "{}"]
    parts = ["{", "}", "[", "]", ":", ",", "01", "nul", '"\\q"', '"\t"', "NaN", '"', *atoms]

    def some(depth=0):
        kind = rng.randrange(4 if depth < 3 else 1)
        if kind == 2:
            return ["[", *(t for i in range(rng.randrange(1, 3)) for t in ([","] if i else []) + some(depth + 1)), "]"]
        if kind == 3 or depth == 0:
            return ["{", *(t for i in range(rng.randrange(1, 4)) for t in ([","] if i else []) + [rng.choice(('"a"', '"amount"', '"b"')), ":", *some(depth + 1)]), "}"]
        return [rng.choice(atoms)]

    def refuse(_):
        raise ValueError

    good = 0
    for _ in range(3000):
        tokens = some()
        for _ in range(rng.randrange(3)):
            at = rng.randrange(len(tokens) + 1)
            tokens[at : at + rng.randrange(2)] = [rng.choice(parts)] if rng.randrange(2) else []
        line = rng.choice(("", " ")).join(tokens)
        try:
            value = json.loads(line, parse_constant=refuse, parse_float=str, parse_int=str)
        except ValueError:
            value = None
        value = value if isinstance(value, dict) else None
        assert json_object(line) == value, line
        good += value is not None
    assert 1000 < good < 2900


def test_plain_lines_are_read_as_the_parser_reads_them(spark, tables):
    """The JVM's free parse of plain lines against the parser, over all lines of the small table and odd ones."""
    odd = ['{"amount": "1", "location": {"amount": 5}}', '{"location": {"amount": 5}}', '{"amount": 1, "amount": 2}', '{"amount": 12345678901234567890}', '{"amount": 1.50}', '{"amount": 1.500}', '{"amount": "1", "province": "top", "location": {"city": "x"}}',
           '{"amount": "1", "location": {"province": "p"}, "metadata": {"retry_flag": true}}', '{"amount": "1", "metadata": {"retry_flag": "yes"}}', '{"amount": "1", "channel": 5}', '{"amount": "1", "channel": {"a": 1}}', '{"amount": "1", "metadata": {"province": "q"}}']
    texts = [(r.file_name, r.line_text) for r in tables["raw_lines"].itertuples()] + [("transactions.jsonl", t) for t in odd]
    df = spark.createDataFrame([(i, n, t) for i, (n, t) in enumerate(texts)], "line_id long, file_name string, line_text string")
    got = {r.line_id: r.asDict() for r in lines.parse_lines(df).collect()}
    for i, (name, text) in enumerate(texts):
        want = (lines._csv if name.endswith("csv") else lines._json)(text)
        if want["fault"] is None and want["cost"] == 0:
            assert {k: v for k, v in got[i].items() if k in (*lines.LOADED, "retry_flag")} == {k: want.get(k) for k in (*lines.LOADED, "retry_flag")}, text
        assert (got[i]["fault"], got[i]["cost"]) == (want["fault"], want["cost"]), text


# --- 5: deliveries
def test_deliveries_keep_the_earliest(spark):
    t = [ts(f"2024-01-0{d}") for d in range(1, 8)]
    data = [(1, "A-1", t[3], 1), (2, "a1", t[1], 1), (3, " a1 ", t[1], 1), (4, None, t[0], 1), (5, None, t[0], 1), (6, " - ", t[0], 1), (7, "b", None, 1), (8, "B", t[6], 1), (9, "c", None, 1), (9, "c", None, 1)]
    df = spark.createDataFrame(data, "row_id long, transaction_id string, ingested_at timestamp, row_key int")
    for batches in (1, 2, 5):
        assert rows(delivery.surplus_deliveries(df, batches=batches, merge_every=2)) == [(1,), (3,), (7,)]
    assert sorted(r.row_id for r in delivery.deliver_once(df).collect()) == [2, 4, 5, 6, 8, 9, 9]
    assert rows(delivery.surplus_deliveries(df.where("false"))) == []


def test_one_identifier_in_most_rows(spark):
    df = spark.range(3000).select(F.col("id").alias("row_id"), F.when(F.col("id") % 3 > 0, "hot").otherwise(F.col("id").cast("string")).alias("transaction_id"), F.timestamp_seconds(F.col("id") % 50).alias("ingested_at"))
    gone = {k for k, in rows(delivery.surplus_deliveries(df, batches=4, per_prefix=100))}
    assert len(gone) == 1999 and 50 not in gone and 100 in gone  # row 50 is the first of the earliest second


def arrivals(spark, b):
    """Identities 10b to 10b + 19, so that each batch repeats half of the one before; hashes are spread over all prefixes."""
    return spark.range(b * 10, b * 10 + 20).select(F.xxhash64("id").alias("hi"), F.col("id").alias("lo"), (F.col("id") + 1000 * b).alias("row_key"), F.lit(b).alias("at"))


def test_index_is_opened_again_between_batches(spark, tmp_path):
    root = str(tmp_path / "index")
    for b in range(6):
        index = delivery.DeliveryIndex(spark, root, per_prefix=4, merge_every=2)  # a new process knows only the folder
        index.admit(arrivals(spark, b))
        index.admit(arrivals(spark, b))  # delivered again
    again = delivery.DeliveryIndex(spark, root)
    assert again.identities == again.kept().distinct().count() == again.kept().count() == 70
    assert sorted(k % 1000 for k, in rows(again.kept())) == list(range(70))
    assert {r["tier"] for r in again.runs} != {0} and len(again.runs) <= 5 and max(r["bits"] for r in again.runs) > 2
    largest = max(len(r.kept) for run in again.runs for r in again.read([run], run["bits"]).collect())
    assert largest <= 20
    assert sorted(p.name for p in (tmp_path / "index").glob("run=*")) == sorted(r["path"] for r in again.runs)


def test_index_survives_a_crash_between_writing_and_listing(spark, tmp_path):
    index = delivery.DeliveryIndex(spark, str(tmp_path / "index"))
    index.admit(arrivals(spark, 0))
    index._write(index.read(index.runs, 2), 2, 0)  # written, but the process dies before the manifest names it
    again = delivery.DeliveryIndex(spark, str(tmp_path / "index"))
    again.admit(arrivals(spark, 1))
    assert again.identities == again.kept().count() == 30


def test_equal_first_halves_are_told_apart():
    import numpy as np

    run = np.array([1, 5, 5, 5, 9]), np.array([1, 2, 4, 6, 1])
    assert list(delivery._known(np.array([5, 5, 5, 9, 0]), np.array([4, 5, 7, 1, 0]), *run)) == [True, False, False, True, False]


# --- 6: late events
def test_lateness_verdicts_and_corrections(spark):
    data = [("1", "k", "2024-01-01T10:00", "2024-01-01T23:59:59", 1), ("2", "k", "2024-01-01T10:00", "2024-01-02T00:00", 2), ("3", "k", "2024-01-01T10:00", "2024-01-04T00:00", 4), ("4", "k", "2024-01-01T10:00", "2024-01-04T00:00:01", 8), ("5", "k", "2024-01-05T10:00", "2024-01-01T10:00", 16), ("1", "k", "2024-01-01T10:00", "2024-01-09T00:00", 1)]
    made = [(i, k, ts(e), ts(a), Decimal(v)) for i, k, e, a, v in data] + [("6", "k", None, ts("2024-01-01"), Decimal(1)), (None, "k", ts("2024-01-01"), ts("2024-01-01"), Decimal(32)), (None, "k", ts("2024-01-01"), ts("2024-01-01"), Decimal(32))]
    df = spark.createDataFrame(made, "id string, k string, event timestamp, arrival timestamp, v decimal(18,2)")
    judged = lateness.judge_lateness(lateness.first_arrivals(df, "id", "event", "arrival", "k", "v"))
    assert rows(judged.where("record is not null"), "record", "verdict") == [("1", "on_time"), ("2", "late"), ("3", "late"), ("4", "too_late"), ("5", "on_time"), ("6", "untimed")]
    states = {(r.period_start.day): (r.revision, r.n, r.total) for r in lateness.corrected(lateness.upserts(judged, "c_k", "c_v")).collect()}
    assert states == {1: (3, 5, Decimal(71)), 5: (1, 1, Decimal(16))}
    assert rows(lateness.diverted(judged), "record") == [("4",), ("6",)]
    assert rows(lateness.upserts(judged.where("false"), "c_k", "c_v")) == []


def test_stale_states(spark, tiny_limits):
    e = [ts(f"2024-01-0{d}") for d in range(1, 6)]
    events = spark.createDataFrame([("a", e[0], e[0]), ("a", e[2], e[4]), ("b", e[0], e[0]), ("b", e[1], e[1]), ("c", e[3], e[4]), (None, e[0], e[0])], "k string, event timestamp, arrival timestamp")
    states = spark.createDataFrame([("a", e[0], e[1]), ("b", e[0], e[1]), ("b", e[0], e[1]), ("c", None, e[1]), ("d", e[0], e[1]), (None, e[0], e[1])], "k string, last timestamp, upd timestamp")
    assert rows(lateness.stale_states(states, events, "k", "last", "upd", "event", "arrival")) == [("b",)]


# --- 7: stamps
STAMPS = [
    ("2024-01-05", "10:00:00", "2024-01-05T08:00"), (" 2024-01-05 ", None, "2024-01-04T22:00"), ("05/01/2024", " ", "2024-01-04T22:00"), ("05.01.2024", "10:00", "2024-01-05T08:00"), ("5-JAN-2024", "1:00:00 PM", "2024-01-05T11:00"),
    ("5 Jan 2024", "12:00:00 AM", "2024-01-04T22:00"), ("Jan 5, 2024", "100000", "2024-01-05T08:00"), ("20240105", "10:00:00.123456", "2024-01-05T08:00:00.123456"), ("1704441600", "junk", "2024-01-05T08:00"), ("1704441600123", None, "2024-01-05T08:00:00.123"),
    ("1704441600123456", None, "2024-01-05T08:00:00.123456"), ("2024-01-05T10:00:00+02:00", "23:00:00", "2024-01-05T08:00"), ("2024-01-05T08:00:00Z", None, "2024-01-05T08:00"), ("2024-01-05 10:00:00", "junk", "2024-01-05T08:00"),
    ("2024-01-05", "10:00:00+0530", "2024-01-05T04:30"), ("2024-01-05", "10:00:00 Europe/Berlin", "2024-01-05T09:00"), ("2024-07-05", "10:00:00 Europe/Berlin", "2024-07-05T08:00"), ("2024-10-27", "02:30:00 Europe/Berlin", "2024-10-27T00:30"),
    ("2024-03-31", "02:30:00 Europe/Berlin", "2024-03-31T01:30"), ("2024-01-05", "10:00:00 Mars/Base", None), ("2024-02-30", "10:00:00", None), ("2023-02-29", None, None), ("2024-13-01", None, None), ("2024-01-05", "25:61:00", None), ("2024-01-05", "noon", None),
    ("2024-01-05", "13:00:00 PM", None), ("unknown", "10:00:00", None), ("", "10:00:00", None), (None, "10:00:00", None), ("123456789", None, None), ("17044416001", None, None), ("2024-05-", None, None), ("9" * 16, None, "2286-11-20T17:46:39.999999"), ("x" * 50_000, "y" * 50_000, None),
]


def test_stamps(spark):
    df = spark.createDataFrame([(i, d, t, "clash") for i, (d, t, _) in enumerate(STAMPS)], "i int, d string, t string, kind string")
    got = {r.i: r.instant for r in instants.normalise_instants(df, "d", "t").select("i", F.col("instant").cast("timestamp_ntz").alias("instant")).collect()}
    for i, (d, t, want) in enumerate(STAMPS):
        assert got[i] == (datetime.fromisoformat(want) if want else None), (d, t)


def test_local_dates(spark):
    cases = {"2024-01-05": date(2024, 1, 5), "2024-01-05 23:30:00": date(2024, 1, 5), "2024-01-05T23:30:00Z": date(2024, 1, 6), "2024-01-05T01:00:00+05:00": date(2024, 1, 4), "1704441600": date(2024, 1, 5), "31/04/2025": None, "2024-01-05 25:00:00": None, None: None}
    df = spark.createDataFrame([(k,) for k in cases], "d string")
    assert {r.d: r.instant_date for r in instants.normalise_instants(df, "d").collect()} == cases


def test_dictionary_learns_only_what_is_new(spark, tiny_limits):
    book = instants.StampDictionary(spark)
    df = spark.createDataFrame([("2024-01-05", "10:00:00")] * 40 + [("05/01/2024", "10:00:00")], "d string, t string")
    assert instants.normalise_instants(df, "d", "t", dictionary=book).where("instant = timestamp'2024-01-05 08:00:00'").count() == 41
    more = df.unionByName(spark.createDataFrame([("06/01/2024", None)], "d string, t string"))
    assert instants.normalise_instants(more, "d", "t", dictionary=book).count() == 42
    assert book.table().count() == 4 and book.table().distinct().count() == 4
    assert rows(instants.normalise_instants(df.where("false"), "d", "t")) == []


def test_result_columns_must_be_new(spark):
    with pytest.raises(ValueError, match="exist already"):
        instants.normalise_instants(spark.createDataFrame([("a", 1)], "d string, instant int"), "d")


def test_readers_never_raise():
    for s in (None, "", " ", "0000-00-00", "9999-99-99", "::", "Z", "+02:00", "AM", "١٢", "1" * 400, "2024-01-05T"):
        read_date(s)
        read_time(s)

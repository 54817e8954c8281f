from __future__ import annotations

from collections import Counter

import pytest
from conftest import executed_plan, found

from lanebeacon import operators as ops
from lanebeacon.operators.lanes import cars_per_lane
from lanebeacon.schemas import FCD_RAW, FLOAT, PERSON, POINTS, STRING, VEHICLE, columns

SEEN = columns(timestep_time=FLOAT, vehicle_id=STRING, vehicle_lane=STRING)

# lane, then edge, lane index and direction with the last two characters taken as the index
FIXED = [
    ("-123_0", "123", "0", 0),
    ("123_1", "123", "1", 1),
    (":77_1_0", ":77_1", "0", 1),
    ("12_10", "12_", "10", 1),
    ("-a-b_0", "a", "0", 0),
    ("--c_1", "", "1", 0),
    ("x", "", "x", 1),
    ("", "", "", 1),
    (None, None, None, 1),
]
LAST = [
    ("-123_0", "123", "0", 0),
    (":77_1_0", ":77_1", "0", 1),
    ("12_10", "12", "10", 1),
    ("-a-b_0", "a-b", "0", 0),
    ("--c_1", "-c", "1", 0),
    ("x", "x", "x", 1),
    ("", "", "", 1),
    (None, None, None, 1),
]


@pytest.fixture
def seen(table):
    """One sighting per lane given."""
    return lambda *lanes: table(SEEN, *[(float(i), f"v{i}", lane) for i, lane in enumerate(lanes)])


@pytest.mark.parametrize("mode, expected", [("fixed2", FIXED), ("last_underscore", LAST)])
def test_parse_lanes(seen, mode, expected):
    parsed = ops.parse_lanes(seen(*[row[0] for row in expected]), edge_id_mode=mode)
    assert found(parsed, "vehicle_lane", "edge_id", "lane_index", "direction") == sorted(expected, key=repr)


def test_parse_lanes_modes_agree_on_one_digit_lanes(seen):
    lanes = seen("-1_0", "1_1", ":2_1_0", "edge_9")
    assert found(ops.parse_lanes(lanes)) == found(ops.parse_lanes(lanes, edge_id_mode="last_underscore"))


@pytest.mark.parametrize("lane, edge", [(":18_1_0", ":18_1"), ("7_0", "7_0"), ("x", "x"), ("", ""), (None, None)])
def test_junction_edge(seen, lane, edge):
    assert found(ops.parse_lanes(seen(lane)), "junction_edge") == [(edge,)]


def test_unknown_mode(seen):
    with pytest.raises(ValueError):
        ops.parse_lanes(seen("1_0"), edge_id_mode="guess")


def test_edge_traffic(seen):
    traffic = ops.edge_traffic(seen("-1_0", "1_0", "1_1", "1_1", "2_0", "0_0", None))
    assert [tuple(row) for row in traffic.collect()] == [("1", 4), ("0", 1), ("2", 1), (None, 0)]


def test_edge_traffic_counts_every_sighting_with_a_lane(spark):
    sightings = spark.range(5000).selectExpr("if(id % 3 = 0, 'hot_0', concat(id % 50, '_', id % 4)) as vehicle_lane")
    assert ops.edge_traffic(sightings).agg({"sightings": "sum"}).first()[0] == 5000


def test_lane_zipper(seen):
    two, three, both_ways = ["20_0", "20_1"], ["30_0", "30_1", "30_2"], ["-40_0", "40_0", "40_1"]
    zipper = ops.lane_zipper(seen(*two, *three, "30_2", *both_ways, None, None, None))
    assert found(zipper) == sorted(
        [
            ("30_0", 1, "30", "0", 1, 3),
            ("30_1", 1, "30", "1", 1, 3),
            ("30_2", 2, "30", "2", 1, 3),
            ("-40_0", 1, "40", "0", 0, 3),
            ("40_0", 1, "40", "0", 1, 3),
            ("40_1", 1, "40", "1", 1, 3),
        ],
        key=repr,
    )


def test_lane_zipper_options(seen):
    lanes = seen("-40_0", "40_0", "40_1", "50_0")
    assert found(ops.lane_zipper(lanes, min_lanes=2, per_direction=True), "vehicle_lane", "nb_lanes") == [("40_0", 2), ("40_1", 2)]
    assert ops.lane_zipper(lanes, min_lanes=1).count() == 4
    assert found(ops.lane_zipper(seen("9_8", "9_9", "9_10"), edge_id_mode="last_underscore"), "edge_id") == [("9",)] * 3
    assert found(ops.lane_zipper(seen("9_8", "9_9", "9_10"))) == []


def test_lane_zipper_rows_per_edge(spark):
    sightings = spark.range(20_000).selectExpr("if(id % 3 = 0, 'hot_1', concat(id % 97, '_', id % 9)) as vehicle_lane")
    zipper = ops.lane_zipper(sightings).collect()
    per_edge = Counter(row.edge_id for row in zipper)
    assert zipper and all(row.nb_lanes == per_edge[row.edge_id] >= 3 for row in zipper)


def test_lane_zipper_scans_and_shuffles_the_sightings_once(spark, conf, tmp_path):
    path = str(tmp_path / "vehicle")
    spark.range(100).selectExpr("concat(id % 7, '_', id % 5) as vehicle_lane").write.parquet(path)
    conf(spark__sql__autoBroadcastJoinThreshold="-1", spark__sql__adaptive__enabled="false")
    zipper = ops.lane_zipper(spark.read.parquet(path))
    plan = executed_plan(zipper)
    assert plan.count("ReusedExchange [Reuses") == 1 and plan.count("\n(1) Scan parquet") == 1
    assert "PushedFilters: [IsNotNull(vehicle_lane)]" in plan and "Window" not in plan
    before_shuffle = plan[plan.index("(1) Scan") : plan.index(") Exchange")]
    assert "StartsWith" not in before_shuffle
    assert zipper.count() == 35


def test_hot_edge_with_many_lanes(spark):
    sightings = spark.range(3000).selectExpr("concat('-hot-', id, '_0') as vehicle_lane")
    assert found(ops.lane_zipper(sightings).select("edge_id", "nb_lanes").distinct()) == [("hot", 3000)]


def test_vehicles_per_timestep(table):
    rows = [(2.0, "a", "1_0"), (1.0, "a", "1_0"), (1.0, "a", "1_1"), (1.0, "b", "1_0"), (1.5, None, "1_0")]
    per_step = ops.vehicles_per_timestep(table(SEEN, *rows))
    assert [tuple(row) for row in per_step.collect()] == [(1.0, 2), (1.5, 0), (2.0, 1)]


def test_vehicles_per_lane(table):
    rows = [(1.0, "a", "b_0"), (2.0, "a", "b_0"), (1.0, "b", "c_0"), (1.0, "c", "a_0"), (1.0, "d", "a_0")]
    lanes = table(SEEN, *rows)
    assert [tuple(row) for row in ops.vehicles_per_lane(lanes, 2).collect()] == [("a_0", 2), ("b_0", 1)]
    assert ops.vehicles_per_lane(lanes, None).count() == 3
    assert "TakeOrderedAndProject" in executed_plan(ops.vehicles_per_lane(lanes, 100))
    assert ops.vehicles_per_lane(lanes).count() == 3


def test_timestep_count(table):
    rows = [(1.0, "a", "x"), (1.0, "b", "x"), (2.0, "a", "x"), (None, "a", "x")]
    assert found(ops.timestep_count(table(SEEN, *rows))) == [(2,)]


def test_approximate_counts(spark):
    sightings = spark.range(3000).selectExpr("cast(id % 3 as float) as timestep_time", "string(id) as vehicle_id", "'1_0' as vehicle_lane")
    for view, column in [
        (ops.vehicles_per_timestep(sightings, approx=True), "vehicles"),
        (ops.vehicles_per_lane(sightings, approx=True), "vehicles"),
    ]:
        assert all(row[column] > 800 for row in view.collect())
    assert found(ops.timestep_count(sightings, approx=True)) == [(3,)]


def wide(half, **values):
    row = dict.fromkeys(FCD_RAW.names)
    row.update({f"{half}_{name}": value for name, value in values.items()}, timestep_time=1.0)
    return tuple(row.values())


def test_split_traces(table):
    fcd = table(
        FCD_RAW,
        wide("vehicle", id="v1", x="1.5", y="bad", z="0", angle="90", type="car", speed="3", pos="7.25", lane="1_0", slope="0"),
        wide("person", id="p1", x="2", y="3", z="0", angle="4", speed="5", pos="6", edge="1", slope="0"),
        wide("vehicle", x="9"),
    )
    vehicle = ("v1", 1.5, None, 90.0, "car", 3.0, 7.25, "1_0")
    person = ("p1", 2.0, 3.0, 4.0, 5.0, 6.0, "1")
    assert found(ops.split_vehicles(fcd)) == [(1.0, *vehicle)]
    assert found(ops.split_persons(fcd)) == [(1.0, *person)]
    both = ops.split_traces(fcd)
    assert found(both.where("kind = 'vehicle'").select("vehicle.*")) == [(1.0, *vehicle)]
    assert found(both.where("kind = 'person'").select("person.*")) == [(1.0, *person)]
    assert both.count() == 2
    assert ops.split_vehicles(fcd).schema.simpleString() == VEHICLE.simpleString()
    assert ops.split_persons(fcd).schema.simpleString() == PERSON.simpleString()


def test_a_row_with_both_halves_goes_to_both_tables(table):
    row = [*wide("vehicle", id="v1")]
    row[FCD_RAW.names.index("person_id")] = "p1"
    fcd = table(FCD_RAW, tuple(row))
    assert ops.split_vehicles(fcd).count() == ops.split_persons(fcd).count() == 1
    assert found(ops.split_traces(fcd), "kind", "vehicle.vehicle_id", "person.person_id") == [("both", "v1", "p1")]


def test_heatmap(table):
    points = table(POINTS, (55.64, 12.61), (55.64, 12.61), (55.66, 12.69), (-0.01, 0.01))
    assert found(ops.heatmap_density(points)) == [(-0.01, 0.01, 1), (55.64, 12.61, 2), (55.66, 12.69, 1)]
    assert found(ops.heatmap_density(points, cell=0.5)) == [(-1, 0, 1), (111, 25, 3)]


def test_counting_merges_before_the_shuffle(spark):
    lanes = spark.range(10).selectExpr("'1_0' as vehicle_lane")
    plan = executed_plan(cars_per_lane(lanes))
    assert plan.index("partial_count") < plan.index("Exchange\nInput")


@pytest.mark.parametrize(
    "view",
    [ops.edge_traffic, ops.lane_zipper, ops.vehicles_per_timestep, ops.vehicles_per_lane, ops.parse_lanes],
)
def test_views_stay_on_the_jvm_and_distributed(view, seen):
    plan = executed_plan(view(seen("1_0", "1_1")))
    for unwanted in ("NestedLoop", "Cartesian", "EvalPython", "SinglePartition", "Window"):
        assert unwanted not in plan

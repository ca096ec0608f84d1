import math
import random

import pytest
from pyspark.sql import functions as F

from muster.config import MailingConfig
from muster.functions import geo
from muster.operators.skew import join_crowds
from muster.operators import spatial
from muster.operators.spatial import within_radius
from muster.plans import matching, scheduling
from muster.plans.events import event_features, score_events
from muster.plans.people import build_constituents
from muster.sources.sample import INVITE
from tests.helpers import DS, at, plan_of, rows, table, world

CFG = MailingConfig(ds=DS, mailing_name="event_invite", max_recipients_per_spot=25)


def miles(a, b):
    (lat1, lon1), (lat2, lon2) = a, b
    s = (math.sin(math.radians((lat2 - lat1) / 2)) ** 2
         + math.cos(math.radians(lat1)) * math.cos(math.radians(lat2))
         * math.sin(math.radians((lon2 - lon1) / 2)) ** 2)
    return 2 * 3961 * math.asin(math.sqrt(min(1.0, s)))


def scattered(spark, seed, boxes, n=120):
    """People and venues in boxes, with every third person at one place."""
    rng = random.Random(seed)
    def point():
        lat0, lat1, lon0, lon1 = rng.choice(boxes)
        return rng.uniform(lat0, lat1), rng.uniform(lon0, lon1)
    crowded = point()
    people = [(i, rng.choice("AB"), *(crowded if i % 3 == 0 else point())) for i in range(n)]
    people.append((n, "A", None, 1.0))
    venues = [(i, rng.choice("AB"), *point()) for i in range(n)]
    return (
        people, venues,
        spark.createDataFrame(people, "cons_id int, state_cd string, latitude double, longitude double"),
        spark.createDataFrame(
            venues, "event_id int, event_state string, event_latitude double, event_longitude double"),
    )


BOXES = {
    "mid-latitude": [(30, 31, -100, -99)],
    "date line": [(10, 11, 179.5, 180), (10, 11, -180, -179.5)],
    "pole": [(89.3, 90, -180, 180)],
    "beyond the poles": [(89.5, 91, 0, 360)],
}


@pytest.mark.parametrize("place", BOXES)
@pytest.mark.parametrize("radius", [3.0, 25.0])
def test_joins_equal_brute_force(spark, place, radius):
    people, venues, left, right = scattered(spark, radius, BOXES[place])
    want = sorted((p[0], v[0]) for p in people for v in venues
                  if p[2] is not None and p[1] == v[1] and miles(p[2:], v[2:]) < radius)
    assert want
    for options in ({}, dict(max_broadcast_bytes=0), dict(max_broadcast_bytes=0, pairs_per_task=5)):
        got = within_radius(left, right, radius, **options)
        assert sorted(map(tuple, got.select("cons_id", "event_id").collect())) == want, options


def test_very_large_and_very_small_radius(spark):
    people, venues, left, right = scattered(spark, 1, BOXES["mid-latitude"], 20)
    same_state = sum(p[1] == v[1] for p in people[:-1] for v in venues)
    assert within_radius(left, right, 20_000).count() == same_state
    spot = right.selectExpr("1 AS cons_id", "event_state AS state_cd", "event_latitude AS latitude",
                            "event_longitude AS longitude")
    assert within_radius(spot, right, 1e-6).count() >= 20


def test_opposite_points_have_a_distance(spark):
    frame = spark.createDataFrame([(0.0, 0.0, 0.0, 180.0), (45.0, 10.0, -45.0, -170.0)],
                                  "a double, b double, c double, d double")
    for (d,) in rows(frame, geo.haversine_miles(*[F.col(c) for c in "abcd"])):
        assert d == pytest.approx(math.pi * 3961)


def test_places_give_the_same_best_events_as_pairs(spark, sample):
    people = build_constituents(INVITE, sample)
    events = score_events(event_features(INVITE, sample))
    by_pairs = matching.score_pairs(matching.capacity_filter(people, events, INVITE))
    best = {}
    for r in by_pairs.select("cons_id", "event_id", "score_event_cons").collect():
        key = (-r.score_event_cons, r.event_id)
        best[r.cons_id] = min(best.get(r.cons_id, key), key)
    for options in ({}, dict(max_broadcast_bytes=0)):
        got = matching.best_events(people, events, INVITE, **options)
        assert {r.cons_id: r.event_id for r in got.select("cons_id", "event_id").collect()} == {
            person: event for person, (_, event) in best.items()}


def test_crowded_keys_are_joined_by_broadcast(spark):
    people = spark.range(300).selectExpr("id", "CASE WHEN id % 3 = 0 THEN 0 ELSE id % 7 END AS k")
    lookup = people.groupBy("k").agg(F.count("*").alias("n")).withColumn("v", F.col("k") * 10)
    want = rows(people.join(lookup, "k"), "id", "k", "n", "v")
    assert rows(join_crowds(people, lookup, ["k"], "n", 50), "id", "k", "n", "v") == want
    assert rows(join_crowds(people, lookup, ["k"], "n"), "id", "k", "n", "v") == want


def candidates(spark, events, slots, participations=(), cfg=CFG, **people):
    tables = world(spark, events, slots, participations, **people)
    return scheduling.invite_candidates(cfg, tables)


def test_ties_go_to_the_lower_event_id(spark):
    slots = [dict(id=i, event_id=i, start_date=at(15, 20)) for i in (7, 3)]
    assert rows(candidates(spark, [dict(id=7), dict(id=3)], slots), "event_id") == [(3,)]


def test_near_events_and_room(spark):
    near, far = dict(id=1, location__lat=28.05), dict(id=2, location__lat=28.2)
    slots = [dict(id=i, event_id=i, start_date=at(15, 20), max_attendees=m) for i, m in ((1, 1), (2, None))]
    assert rows(candidates(spark, [near, far], slots, people=3), "event_id") == [(1,)] * 3
    # One spot for thirty people is too little; an unknown number is not.
    assert rows(candidates(spark, [near, far], slots, people=30), "event_id") == [(2,)] * 30


def test_full_and_overbooked_events(spark):
    slots = [dict(id=i, event_id=i, start_date=at(15, 20), max_attendees=1) for i in (1, 2)]
    rsvps = [dict(timeslot_id=1, status="CONFIRMED")] + 2 * [dict(timeslot_id=2, status="CONFIRMED")]
    assert rows(candidates(spark, [dict(id=1), dict(id=2)], slots, rsvps), "event_id") == [(2,)]


def test_person_with_two_addresses_gets_one_event(spark):
    tables = world(spark, [dict(id=1), dict(id=2, location__lat=30.0)],
                   [dict(id=i, event_id=i, start_date=at(15, 20)) for i in (1, 2)])
    tables["cons_addr"] = table(spark, "cons_addr", dict(latitude=28.0), dict(latitude=30.01),
                                cons_id=1, is_primary=1, state_cd="FL", longitude=-81.0)
    assert rows(scheduling.invite_candidates(CFG, tables), "cons_id", "event_id") == [(1, 1)]


def test_plans(spark, sample):
    best = scheduling.invite_candidates(INVITE, sample)
    assert "WindowGroupLimit" in plan_of(best)
    pairs = matching.nearby_pairs(
        build_constituents(INVITE, sample), score_events(event_features(INVITE, sample)), 25.0)
    for plan in (plan_of(pairs), plan_of(best)):
        assert "REPARTITION_BY_NUM" not in plan
        assert "CartesianProduct" not in plan and "BroadcastNestedLoopJoin" not in plan


def test_zero_and_null_coordinates_fall_back_to_the_zip_area(spark):
    tables = world(spark, [], [], people=4, zips=[dict(zip="1", latitude=27.0, longitude=-80.0)])
    tables["cons_addr"] = table(
        spark, "cons_addr",
        dict(cons_id=1, zip="1"), dict(cons_id=2, zip="1", latitude=0.0, longitude=0.0),
        dict(cons_id=3, zip="2"), dict(cons_id=4, zip="2", latitude=0.0, longitude=0.0),
        is_primary=1, state_cd="FL")
    assert rows(build_constituents(CFG, tables), "cons_id", "latitude", "longitude") == [
        (1, 27.0, -80.0), (2, 27.0, -80.0), (4, None, None)]


def test_who_is_left_out(spark):
    tables = world(spark, [], [], people=6)
    tables["cons_sub"] = table(
        spark, "cons_sub", *[dict(cons_id=i, cons_email_id=i, isunsub=int(i == 1)) for i in range(1, 7)],
        chapter_id=1)
    for i, name in ((2, "suppressed_isp"), (3, "suppressed_inactive"), (4, "suppressed_seed")):
        tables[name] = table(spark, name, dict(cons_id=i), dict(cons_id=i))
    people = build_constituents(CFG, tables)
    assert rows(people, "cons_id") == [(5,), (6,)]
    assert "LeftAnti" in plan_of(people)


def test_crowded_cells_copy_neither_side_to_all_tasks(spark):
    def places(names, n):
        return spark.range(n).selectExpr(
            "id", f"'FL' AS {names.state}", f"28.0D AS {names.latitude}", f"-81.0D + id / 1e6 AS {names.longitude}")

    left, right = (places(p, 100).withColumn("_cell", F.lit(1)) for p in (spatial.PERSON, spatial.VENUE))
    left, right = spatial._split_crowded_cells(left, right, spatial.PERSON, spatial.VENUE, 100)
    # A hundred tasks: copied to all of them, the venues alone would be 10,000 rows.
    assert left.count() == right.count() == 1000
    pairs = left.alias("l").join(right.alias("r"), ["_cell", "_salt"]).select("l.id", F.col("r.id").alias("venue"))
    assert pairs.count() == pairs.distinct().count() == 10_000


def test_only_listings_in_cells_with_people_are_moved(spark, monkeypatch):
    moved, split = [], spatial._split_crowded_cells

    def watched(left, right, *others):
        moved.append((left, right, *split(left, right, *others)))
        return moved[-1][2:]

    monkeypatch.setattr(spatial, "_split_crowded_cells", watched)
    people = spark.createDataFrame(
        [(1, "A", 30.0, -100.0), (2, "A", 30.0, -90.0)],
        "cons_id int, state_cd string, latitude double, longitude double")
    venues = spark.createDataFrame(
        [(1, "A", 30.0, -100.0), (2, "B", 30.0, -100.0), (3, "A", 40.0, -100.0)],
        "event_id int, event_state string, event_latitude double, event_longitude double")
    pairs = within_radius(people, venues, 25.0, max_broadcast_bytes=0)
    assert rows(pairs, "cons_id", "event_id") == [(1, 1)]
    ((_, listed, left, right),) = moved
    # Of the 27 listings of each venue, one is where somebody is; nobody else has a venue.
    assert (listed.count(), left.count(), right.count()) == (81, 1, 1)
    assert not {"_x", "_y", "_z"} & {*left.columns, *right.columns}


@pytest.mark.parametrize("cells", [0, 1 << 40])
def test_joins_equal_brute_force_however_many_cells_there_are(spark, monkeypatch, cells):
    monkeypatch.setattr(spatial, "MAX_BROADCAST_BYTES", cells)
    people, venues, left, right = scattered(spark, 7, BOXES["mid-latitude"])
    want = sorted(((p[0], v[0]) for p in people for v in venues
                   if p[2] is not None and p[1] == v[1] and miles(p[2:], v[2:]) < 25), key=repr)
    for pairs_per_task in (5, 10**9):
        got = within_radius(left, right, 25.0, max_broadcast_bytes=0, pairs_per_task=pairs_per_task)
        assert rows(got, "cons_id", "event_id") == want


def test_shuffled_sides_of_a_kind_move_once(spark):
    _, _, left, right = scattered(spark, 3, BOXES["mid-latitude"], 30)
    right = right.withColumn("kind", F.col("event_id") % 2)
    plan = plan_of(spatial._pairs(
        left.withColumn("_kind", F.lit(1)), right, 25.0, same=[("_kind", "kind")], max_broadcast_bytes=0))
    assert plan.count("REPARTITION_BY_NUM") == 2 and "ENSURE_REQUIREMENTS" not in plan.split("BroadcastExchange")[0]


def test_texts_of_events_with_room_are_not_stored(spark, sample, monkeypatch):
    stored, cut = [], matching.cut
    monkeypatch.setattr(matching, "cut", lambda df: stored.append(df.columns) or cut(df))
    people = build_constituents(INVITE, sample)
    events = score_events(event_features(INVITE, sample))
    pairs = matching.capacity_filter(people, events, INVITE)
    assert stored and {"event_id", "score_event", "cons_count"} <= {*stored[-1]} <= {*pairs.columns}

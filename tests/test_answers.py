"""Hand-computed cases of the thirteen answers, and their equality with a record-at-a-time fold."""

import pytest
from logs import START, one_by_one, random_logs, route, routes_df, trip, trips_df

from wayfare.operators import results as R
from wayfare.plans import answers as A


def rows(df):
    return [tuple(r) for r in df.collect()]


@pytest.mark.parametrize("seed", range(6))
def test_answers_equal_a_fold_over_single_records(spark, seed):
    t, r = random_logs(seed)
    trips, routes = trips_df(spark, t), routes_df(spark, r)
    want = one_by_one(t, r)
    assert {x[0]: x[2] for x in rows(A.q04_passengers_per_route(trips))} == want[4]
    assert dict(rows(A.q05_seats_per_route(routes))) == want[5]
    assert {x[0]: x[1:] for x in rows(A.q06_occupancy_per_route(trips, routes))} == want[6]
    assert rows(A.q07_total_passengers(trips)) == [(want[7],)]
    assert rows(A.q08_total_seats(routes)) == [(want[8],)]
    assert rows(A.q09_total_occupancy(trips, routes)) == [(want[7], want[8], want[7] / want[8] * 100)]
    assert rows(A.q11_top_type(trips)) == [want[11]]
    assert {x[0]: x[1:] for x in rows(A.q12_least_occupied_route_changelog(trips, routes))} == want[12]
    assert rows(A.q13_top_hourly_type(trips)) == [want[13]]
    assert rows(A.q14_least_occupied_type_changelog(trips, routes)) == [want[14]]
    assert rows(A.q15_top_operator(trips, routes)) == [want[15]]
    assert rows(A.q16_top_passenger(trips)) == [want[16]]
    final = min(want["sums"].values())
    hour, rtype, occ = rows(A.q14_least_occupied_type(trips, routes))[0]
    assert occ == pytest.approx(final, abs=1e-6) and want["sums"][(hour, rtype)] == pytest.approx(final)
    last_hour = max(h for h, _ in want["sums"])
    hour, rtype, occ = rows(A.q14_least_occupied_type(trips, routes, "latest"))[0]
    assert hour == last_hour
    assert occ == pytest.approx(min(v for (h, _), v in want["sums"].items() if h == last_hour), abs=1e-6)


def test_tie_goes_to_the_first_to_reach_the_count(spark):
    trips = trips_df(spark, [
        trip(0, 1, "a", "Bus"), trip(1, 1, "b", "Taxi"), trip(2, 1, "b", "Taxi"), trip(3, 1, "a", "Bus"),
    ])
    assert rows(A.q11_top_type(trips)) == [("Taxi", 2)]
    assert rows(A.q16_top_passenger(trips)) == [("b", 2)]
    assert rows(A.q13_top_hourly_type(trips)) == [(START, "Taxi", 2)]


def test_republished_route_adds_seats_but_replaces_capacity(spark):
    trips = trips_df(spark, [trip(i, 1) for i in range(5)])
    routes = routes_df(spark, [route(0, 1, 4), route(1, 1, 6)])
    assert rows(A.q05_seats_per_route(routes)) == [(1, 10)]
    assert rows(A.q06_occupancy_per_route(trips, routes)) == [(1, 5, 10, 50.0)]
    assert rows(A.q15_top_operator(trips, routes)) == [("OperatorA", 1, 5 / 6)]


def test_zero_capacity(spark):
    trips = trips_df(spark, [trip(0, 2), trip(1, 1), trip(2, 2)])
    routes = routes_df(spark, [route(0, 1, 4), route(1, 2, 0, operator="OperatorB")])
    assert sorted(rows(A.q06_occupancy_per_route(trips, routes))) == [(1, 1, 4, 25.0), (2, 2, 0, 0.0)]
    assert rows(A.q15_top_operator(trips, routes)) == [("OperatorB", 2, float("inf"))]
    assert rows(A.q12_least_occupied_route(trips, routes)) == [("Metro", 1, 0.25)]
    assert rows(A.q12_least_occupied_route_changelog(trips, routes)) == [("Metro", 1, 0.25)]
    # the hour holds an unseated route, so its total is infinite from the first update on
    assert rows(A.q14_least_occupied_type(trips, routes)) == [(START, "Metro", float("inf"))]
    assert rows(A.q14_least_occupied_type_changelog(trips, routes)) == [(START, "Metro", float("inf"))]


def test_two_unseated_routes_tie_on_the_first_trip(spark):
    trips = trips_df(spark, [trip(0, 1), trip(1, 2), trip(2, 2), trip(3, 1)])
    routes = routes_df(spark, [route(0, 1, 0, operator="OperatorB"), route(1, 2, 0, operator="OperatorC")])
    assert rows(A.q15_top_operator(trips, routes)) == [("OperatorB", 1, float("inf"))]


def test_trip_before_its_route(spark):
    trips = trips_df(spark, [trip(0, 1), trip(10, 1)])
    routes = routes_df(spark, [route(5, 1, 4, minute=0)])
    assert rows(A.q12_least_occupied_route_asof(trips, routes)) == [("Metro", 1, 0.5)]
    assert rows(A.q12_least_occupied_route_changelog(trips, routes)) == [("Metro", 1, 0.25)]


def test_route_at_the_time_of_the_trip_is_valid(spark):
    trips = trips_df(spark, [trip(5, 1)])
    routes = routes_df(spark, [route(5, 1, 4, minute=0)])
    assert rows(A.q12_least_occupied_route_asof(trips, routes)) == [("Metro", 1, 0.25)]


def test_trip_type_and_route_type_are_kept_apart(spark):
    trips = trips_df(spark, [trip(0, 1, transport_type="Bus")])
    routes = routes_df(spark, [route(0, 1, 2, type="Metro")])
    assert rows(A.q11_top_type(trips)) == [("Bus", 1)]
    assert rows(A.q12_least_occupied_route(trips, routes)) == [("Metro", 1, 0.5)]
    assert rows(A.q10_avg_passengers_per_type(trips)) == [("Bus", 1, 1, 1.0)]


def test_running_sum_of_an_hour(spark):
    trips = trips_df(spark, [trip(i, 1) for i in range(3)])
    routes = routes_df(spark, [route(0, 1, 10)])
    assert rows(A.q14_least_occupied_type(trips, routes)) == [(START, "Metro", 0.6)]
    assert rows(A.q14_least_occupied_type_changelog(trips, routes)) == [(START, "Metro", 0.1)]


def test_null_groups_and_texts_with_separators(spark):
    trips = trips_df(spark, [trip(0, 1, "a->b", None), trip(1, 1, None, "Bus"), trip(2, 1, "a->b", "Bus")])
    routes = routes_df(spark, [route(0, 1, 1, operator="Op X", type="Night Bus")])
    assert rows(A.q16_top_passenger(trips)) == [("a->b", 2)]
    assert rows(A.q10_avg_passengers_per_type(trips)) == [("Bus", 2, 2, 1.0)]
    assert rows(A.q07_total_passengers(trips)) == [(3,)]
    assert rows(R.result_rows(A.q15_top_operator(trips, routes), 15)) == [("MostOccupiedOperator", 0, "Op X -> 3.0")]
    assert rows(R.result_rows(A.q12_least_occupied_route(trips, routes), 12)) == [
        ("Night Bus", 0, "RouteId: 1 -> Occupancy: 3.0")
    ]


def test_empty_logs_give_no_rows(spark):
    trips, routes = trips_df(spark, []), routes_df(spark, [])
    some = routes_df(spark, [route(0, 1, 2)])
    for answer in (
        A.q04_passengers_per_route(trips), A.q05_seats_per_route(routes), A.q06_occupancy_per_route(trips, some),
        A.q07_total_passengers(trips), A.q08_total_seats(routes), A.q09_total_occupancy(trips, some),
        A.q11_top_type(trips), A.q12_least_occupied_route(trips, some), A.q12_least_occupied_route_asof(trips, some),
        A.q13_top_hourly_type(trips), A.q14_least_occupied_type(trips, some), A.q15_top_operator(trips, some),
        A.q16_top_passenger(trips),
    ):
        assert rows(answer) == []


def test_scope_is_checked(spark):
    with pytest.raises(ValueError):
        A.q13_top_hourly_type(trips_df(spark, []), "last")


def test_ties_of_a_log_ordered_by_several_columns(spark):
    """Two operators' routes are equally full and two routes of one of them too; who came first wins."""
    routes = [route(0, 1, 2, operator="OperatorA"), route(1, 2, 2, operator="OperatorB"), route(2, 3, 4)]
    trips = [trip(0, 1, minute=5), trip(1, 2, minute=1), trip(2, 2, minute=2), trip(3, 1, minute=3), trip(4, 3)]
    for made in (trips, trips[:3], trips[:1], []):
        args = trips_df(spark, made), routes_df(spark, routes)
        got = A.q15_top_operator(*args, order=["ts", "event_id"]).collect()
        by_time = sorted(made, key=lambda t: (t[5], t[6]))
        counts, best = {}, None
        for t in by_time:
            counts[t[0]] = counts.get(t[0], 0) + 1
            r = routes[t[0] - 1]
            if best is None or counts[t[0]] / r[5] > best[2]:
                best = (r[4], t[0], counts[t[0]] / r[5])
        assert [tuple(x) for x in got] == ([best] if best else [])


@pytest.mark.parametrize("seed", range(3))
def test_versions_are_found_by_halving(spark, seed):
    t, r = random_logs(seed, n_trips=200, n_versions=60, n_routes=5)
    r += [route(100 + i, 1, 3 + i, minute=-100 - i) for i in range(20)]
    args = trips_df(spark, t), routes_df(spark, r)
    halved = A.q12_least_occupied_route_asof(*args).collect()
    merged = A.q12_least_occupied_route_asof(*args, broadcast_bytes=0).collect()
    assert halved and sorted(map(tuple, halved)) == sorted(map(tuple, merged))

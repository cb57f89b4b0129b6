"""Small logs for tests, and the record-at-a-time rules they are checked against."""

from __future__ import annotations

import random
from datetime import datetime, timedelta

from wayfare.schemas import ROUTE, TRIP

START = datetime(2024, 1, 1)


def trip(event_id, route_id, name="Alice", transport_type="Bus", minute=None):
    ts = START + timedelta(minutes=event_id if minute is None else minute)
    return (route_id, name, "A", "B", transport_type, ts, event_id)


def route(seq, route_id, capacity, type="Metro", operator="OperatorA", minute=-100):
    return (route_id, "A", "B", type, operator, capacity, START + timedelta(minutes=minute + seq), seq)


def trips_df(spark, rows):
    return spark.createDataFrame(rows, TRIP)


def routes_df(spark, rows):
    return spark.createDataFrame(rows, ROUTE)


def random_logs(seed, n_trips=400, n_versions=30, n_routes=8, hot=0.4):
    """Trips of which one route holds a large share, and routes published again and again."""
    rnd = random.Random(seed)
    types = ["Bus", "Taxi", "Train", "Metro", "Scooter"]
    trips = []
    minute = 0
    for i in range(n_trips):
        minute += rnd.randint(0, 7)
        r = 1 if rnd.random() < hot else rnd.randint(1, n_routes + 1)
        trips.append(trip(i, r, rnd.choice(["Ann", "Bob", "Cy", "Di"]), rnd.choice(types), minute))
    routes = [
        route(s, rnd.randint(1, n_routes), rnd.randint(1, 12), rnd.choice(types),
              rnd.choice(["OperatorA", "OperatorB", "OperatorC"]), minute=rnd.randint(-50, minute))
        for s in range(n_versions)
    ]
    return trips, routes


def one_by_one(trips, routes):
    """Every answer as a fold over single records, each update passed on at once."""
    seats, latest = {}, {}
    for r in routes:
        seats[r[0]] = seats.get(r[0], 0) + r[5]
        if r[0] not in latest or latest[r[0]][7] < r[7]:
            latest[r[0]] = r
    names, counts, types, people, windows, sums = {}, {}, {}, {}, {}, {}
    top_type = top_person = top_hour = least_hour = top_operator = None
    per_type, per_operator = {}, {}
    for rid, name, _, _, ttype, ts, _ in sorted(trips, key=lambda t: t[6]):
        hour = ts.replace(minute=0, second=0)
        names[rid] = name if not names.get(rid) else names[rid] + ", " + name
        for table, key in ((counts, rid), (types, ttype), (people, name), (windows, (hour, ttype))):
            table[key] = table.get(key, 0) + 1
        if top_type is None or not top_type[1] >= types[ttype]:
            top_type = (ttype, types[ttype])
        if top_person is None or not top_person[1] >= people[name]:
            top_person = (name, people[name])
        if top_hour is None or not top_hour[2] >= windows[(hour, ttype)]:
            top_hour = (hour, ttype, windows[(hour, ttype)])
        if rid not in latest:
            continue
        r = latest[rid]
        rtype, operator, capacity = r[3], r[4], r[5]
        occ = counts[rid] / capacity if capacity else float("inf")
        if occ < per_type.get(rtype, (None, float("inf")))[1]:
            per_type[rtype] = (rid, occ)
        sums[(hour, rtype)] = sums.get((hour, rtype), 0.0) + occ
        if least_hour is None or sums[(hour, rtype)] < least_hour[2]:
            least_hour = (hour, rtype, sums[(hour, rtype)])
        if operator not in per_operator or occ > per_operator[operator][2]:
            per_operator[operator] = (operator, rid, occ)
            if top_operator is None or occ > top_operator[2]:
                top_operator = (operator, rid, occ)
    return {
        4: names, 5: seats, 7: len(trips), 8: sum(seats.values()),
        6: {r: (counts[r], s, counts[r] / s * 100 if s else 0.0) for r, s in seats.items() if r in counts},
        11: top_type, 12: per_type, 13: top_hour, 14: least_hour, 15: top_operator, 16: top_person,
        "counts": counts, "sums": sums,
    }

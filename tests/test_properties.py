"""Property tests: trips are conserved between the fact and the marts once
each mart's documented drops are accounted for, and the one-pass date marts
equal the separately built ones."""

from __future__ import annotations

import datetime as dt

from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st

from tests.test_edge_cases import raw_df, trip, zones
from tripmart.operators import core, marts
from tripmart.operators.staging import stage_trips
from tripmart.sources import seeds

trips = st.lists(
    st.builds(
        lambda day, minute, dur, pu, do, miles, flag, fee: trip(
            dt.datetime(2025, 6, 1) + dt.timedelta(days=day, minutes=minute), minutes=dur,
            PULocationID=pu, DOLocationID=do, trip_miles=miles, trip_time=dur * 60,
            access_a_ride_flag=flag, cbd_congestion_fee=fee, shared_match_flag=bool(minute % 3 == 0)),
        day=st.integers(0, 3), minute=st.integers(0, 1439), dur=st.integers(0, 90),
        pu=st.integers(1, 5), do=st.integers(1, 5),
        miles=st.sampled_from([0.0, 0.25, 1.5, 7.75]),
        flag=st.sampled_from([True, False, None]), fee=st.sampled_from([1.5, None])),
    min_size=1, max_size=40)


@settings(max_examples=6, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture])
@given(rows=trips)
def test_trip_conservation(spark, rows):
    stg = stage_trips(raw_df(spark, rows))
    fact = core.build_fact(stg)
    dd = core.build_dim_datetime(stg, seeds.holidays(spark))
    flags = core.build_dim_trip_flags(spark)
    loc = core.build_dim_location(zones(spark))

    known_flags = [r for r in rows if r["access_a_ride_flag"] is not None]
    positive = [r for r in known_flags if r["trip_miles"] > 0 and r["trip_time"] > 0]
    known_zones = [r for r in rows if r["PULocationID"] <= 4 and r["DOLocationID"] <= 4]

    daily = marts.build_daily(fact, dd, flags).collect()
    flag = marts.build_flag(fact, dd, flags).collect()
    geo = marts.build_geo(fact, dd, loc).collect()
    assert fact.count() == len(rows)
    assert sum(r.total_trips for r in daily) == len(known_flags)
    assert sum(r.total_trips for r in flag) == len(positive)
    assert sum(r.trip_count for r in geo) == len(known_zones)

    one_pass = marts.build_date_marts(fact, dd, flags)
    one_pass.pop("_cache").unpersist()
    for name, build in [("bi_daily_metrics", marts.build_daily), ("bi_driver_metrics", marts.build_driver),
                        ("bi_flag_metrics", marts.build_flag)]:
        assert sorted(one_pass[name].collect()) == sorted(build(fact, dd, flags).collect()), name

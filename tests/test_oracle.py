"""Every registered query against its DuckDB twin (the driver's correctness gate)."""

from __future__ import annotations

import pytest

from pitwall.plans.catalog import oracle_sql, queries
from pitwall.plans.compare import compare

from .conftest import SF_ORACLE, SF_SMALL

# The two largest outputs (over a million rows at sf0.01) and streams that are run once for each of
# several deliveries are checked at sf0.001.
HEAVY = {"lap_trace", "lap_trace_vs_ghost", "stream_ghost", "stream_lap_close", "stream_rate_gate", "stream_sensor_fusion"}


@pytest.mark.parametrize("name", sorted(oracle_sql()))
def test_query_matches_oracle(spark, duck, name):
    if name in HEAVY:
        from pitwall.plans.compare import duckdb_connect

        con, sf = duckdb_connect(SF_SMALL), SF_SMALL
    else:
        con, sf = duck, SF_ORACLE
    rep = compare(queries()[name](spark, sf), con, oracle_sql()[name])
    assert rep["ok"], rep


def test_every_query_has_an_oracle_or_is_listed():
    without = set(queries()) - set(oracle_sql())
    assert not without, without


def test_entry_runs(spark):
    import importlib.util
    import os

    path = os.path.join(os.path.dirname(os.path.dirname(__file__)), "__spark_entry__.py")
    spec = importlib.util.spec_from_file_location("spark_entry", path)
    mod = importlib.util.module_from_spec(spec)
    spec.loader.exec_module(mod)
    df = mod.entry(spark)
    assert df.count() > 0
    assert "avg_speed_kmh" in df.columns


def test_lap_json_round_trips(spark):
    from pitwall.operators.clean import decode_lap_json, lap_json
    from pitwall.operators.laps import lap_summary
    from pitwall.sources.fixtures import telemetry

    laps = lap_summary(telemetry(spark, SF_SMALL))
    back = decode_lap_json(lap_json(laps))
    assert back.exceptAll(laps.select(*back.columns)).count() == 0
    assert laps.count() == back.count()

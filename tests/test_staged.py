"""Staged bodies give what parsing the text gives, without a JSON parser."""

from __future__ import annotations

from obslake import specs
from obslake.operators import parse, staged
from obslake.plans import catalog

from conftest import SF_SMALL
from helpers import air, envelope_df

BODIES = [air('{"aqi":3,"iaqi":{"co":{"v":0.1}},"city":{"geo":[1.5],"name":"x"}}'), air('{"aqi":"-","iaqi":{"co":{"v":2}}}'),
          air('{"aqi":3}')[:-4], air('{"aqi":3}')[:10], "", None, "[1]", "null", "ERROR", "{}", air('{"aqi":7}', "error"),
          air('{"time":{"v":1700000000,"iso":"2024-01-01T00:00:00+02:00"},"forecast":{"daily":{"o3":[{"day":"2024-01-01","avg":1}]}}}'),
          air('{"iaqi":5,"city":null}')]


def rows_of(df):
    return sorted(map(str, df.collect()))


def test_equal_to_parsed_text(spark, scratch):
    env = envelope_df(spark, [{"request_id": i, "payload": b, "ok": i != 8} for i, b in enumerate(BODIES)])
    spec = specs.AIR_QUALITY
    root = scratch("staged")
    staged.stage(env).write.parquet(root)
    back = spark.read.parquet(root)
    assert rows_of(parse.validate(staged.parse_staged(back, spec), spec)) == rows_of(
        parse.validate(parse.parse_payload(env, spec, persisted=True), spec))
    kept = {r.request_id: r.payload for r in back.select("request_id", "payload").collect()}
    assert kept[2] == BODIES[2] and kept[8] == "ERROR" and kept[0] is None


def test_no_json_is_parsed_after_landing(spark):
    plan = catalog.fact_staged_a(spark, SF_SMALL)._jdf.queryExecution().executedPlan().toString()
    assert "from_json" not in plan and "parse_json" not in plan and "get_json" not in plan

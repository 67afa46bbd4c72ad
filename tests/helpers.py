from __future__ import annotations

from obslake import schemas


def envelope_df(spark, rows):
    """rows: dicts with at least place_name and payload; defaults fill the
    rest of the envelope (ok response, one fetch stamp)."""
    full = []
    for i, r in enumerate(rows):
        full.append((
            r.get("request_id", i), r.get("feed", "air_quality"), r.get("place_name", "Paris"),
            r.get("url", "https://api.waqi.info/feed/x/?token=***"), r.get("http_status", 200),
            r.get("ok", True), r.get("error"), r.get("fetched_at_utc", "2024-10-27T01:00:00.000Z"),
            r.get("payload"), r.get("country"),
        ))
    return spark.createDataFrame(full, schemas.ENVELOPE)


def air(data: str = "", status: str = "ok") -> str:
    body = f'"status":"{status}"'
    return "{" + body + (f',"data":{data}' if data else "") + "}"

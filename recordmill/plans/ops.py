"""Queries of gates, progress and time, and of streams, and their SQL."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..operators import corpus, gates, relational, timing
from ..streaming import status
from .tables import table


def gate_decisions(s, d):  # noqa: ANN001, ANN201
    """Each suite's extraction against limits and against the whole corpus as baseline."""
    records, events = table(s, d, "tool_records"), corpus.delivered_once(table(s, d, "container_events"))
    m = gates.extraction_metrics(records, events, "suite_id")
    base = gates.extraction_metrics(records.withColumn("all", F.lit("all")), events, "all").select(F.col("help_rate").alias("base_help_rate"), F.col("missing_rate").alias("base_missing_rate"))
    rules = [gates.Gate("documented_rate", least=0.85), gates.Gate("help_rate", least=0.5, tolerance=0.2), gates.Gate("missing_rate", most=0.25, tolerance=0.2)]
    return gates.decided(m.crossJoin(F.broadcast(base)), rules).select("suite_id", "records", F.array_join("reasons", "; ").alias("reasons"), "passed")  # one row is broadcast


def safe_rates(s, d):  # noqa: ANN001, ANN201
    return gates.extraction_metrics(table(s, d, "tool_records"), corpus.delivered_once(table(s, d, "container_events")), "shed_owner")


def job_states(s, d):  # noqa: ANN001, ANN201
    """Each record as a job whose events are its tasks."""
    e = corpus.delivered_once(table(s, d, "container_events")).where("pos IS NOT NULL")
    e = e.withColumn("task", F.when(F.col("status") == "help", "completed").when(F.col("status") == "failed", "failed").otherwise("running"))
    return e.groupBy("pos").agg(relational.job_state("task").alias("state"), F.count_if(F.col("task") == "completed").alias("done"), F.count("*").alias("tasks"))


_NOW = "2024-01-10 00:00:00"


def job_progress(s, d):  # noqa: ANN001, ANN201
    """Each customer's orders as a job: finished ones of all, at the time of the last order."""
    o = table(s, d, "orders")
    j = o.groupBy("o_custkey").agg(F.min("o_orderdate").alias("began"), F.max("o_orderdate").alias("now"), F.count_if(F.col("o_orderstatus") == "F").alias("done"), F.count("*").alias("total"))
    return timing.progress(j, "began", "now", "done", "total").select("o_custkey", "done", "total", "elapsed", "speed", "remaining")


def lease_claims(s, d):  # noqa: ANN001, ANN201
    """Each user's first event that could be claimed: a view is pending, the others run for an hour."""
    e = table(s, d, "events").withColumns({"status": F.when(F.col("event_type") == "view", "pending").otherwise("running"), "lease_until": F.timestamp_add("SECOND", F.lit(3600), F.col("ts"))})
    end = table(s, d, "events").agg(F.max("ts").alias("now"))
    open_ = timing.claimable(e.crossJoin(F.broadcast(end)), F.timestamp_add("SECOND", F.lit(-86400), F.col("now")))  # one row is broadcast
    return open_.groupBy("user_id").agg(F.min("event_id").alias("event_id"), F.count("*").alias("claimable"))


def live_entries(s, d):  # noqa: ANN001, ANN201
    """Errors that are still in force: each for as many hours as its value says."""
    e = table(s, d, "events").where("event_type = 'error'")
    end = table(s, d, "events").agg(F.max("ts").alias("now"))
    ttl = F.floor(F.abs(F.coalesce("value", F.lit(0.0))) * 3600).cast("long")
    return timing.alive(e.crossJoin(F.broadcast(end)), F.col("now"), "ts", ttl).select("event_id", "user_id")  # one row is broadcast


def sessions(s, d):  # noqa: ANN001, ANN201
    """Events of a user less than half an hour apart make a session."""
    return status.sessions(table(s, d, "events"), "user_id", "ts", "event_id", 1800).groupBy("user_id").agg(F.count("*").alias("sessions"), F.max("events").alias("largest"))


def stream_latest_status(s, d):  # noqa: ANN001, ANN201
    """The latest event of each user, as a file stream gives it when all files are read."""
    return status.latest_by_stream(s, f"{d}/events.parquet", "user_id", "ts", "event_id", ["event_type"]).select("user_id", "event_type", "event_id")


def stream_hourly_counts(s, d):  # noqa: ANN001, ANN201
    """Events of each day and type by a windowed stream with a watermark."""
    return status.windowed_by_stream(s, f"{d}/events.parquet", "ts", "event_type", "1 day")


QUERIES = {f.__name__: f for f in (gate_decisions, safe_rates, job_states, job_progress, lease_claims, live_entries, sessions, stream_latest_status, stream_hourly_counts)}

_EV = "(SELECT DISTINCT * FROM container_events)"
_METRICS = f"""e AS (SELECT pos, bool_or(status = 'help') AS h, bool_or(status = 'container-command-missing') AS m FROM {_EV} GROUP BY pos),
    j AS (SELECT r.*, help_text IS NOT NULL AS doc, h, m FROM tool_records r LEFT JOIN e USING (pos))"""
_RATES = "count(*) AS records, (count(*) FILTER (doc))::DOUBLE / count(*) AS documented_rate, (count(*) FILTER (h))::DOUBLE / count(*) AS help_rate, (count(*) FILTER (m))::DOUBLE / count(*) AS missing_rate"

ORACLES = {
    "gate_decisions": f"""WITH {_METRICS}, g AS (SELECT suite_id, {_RATES} FROM j GROUP BY suite_id), b AS (SELECT {_RATES} FROM j),
        r AS (SELECT suite_id, g.records AS records, list_filter([CASE WHEN g.documented_rate < 0.85 THEN 'documented_rate is under its limit' END, CASE WHEN g.help_rate < 0.5 THEN 'help_rate is under its limit' END,
            CASE WHEN g.help_rate + 0.2 < b.help_rate THEN 'help_rate fell behind the baseline' END, CASE WHEN g.missing_rate > 0.25 THEN 'missing_rate is over its limit' END,
            CASE WHEN g.missing_rate - 0.2 > b.missing_rate THEN 'missing_rate fell behind the baseline' END], lambda x: x IS NOT NULL) AS rs FROM g, b)
        SELECT suite_id, records, array_to_string(rs, '; ') AS reasons, len(rs) = 0 AS passed FROM r""",
    "safe_rates": f"WITH {_METRICS} SELECT shed_owner, {_RATES} FROM j GROUP BY shed_owner",
    "job_states": f"""WITH t AS (SELECT pos, CASE status WHEN 'help' THEN 'completed' WHEN 'failed' THEN 'failed' ELSE 'running' END AS task FROM {_EV} WHERE pos IS NOT NULL)
        SELECT pos, CASE WHEN bool_or(task = 'failed') THEN 'failed' WHEN bool_and(task = 'completed') THEN 'completed' ELSE 'running' END AS state, count(*) FILTER (task = 'completed') AS done, count(*) AS tasks FROM t GROUP BY pos""",
    "job_progress": """WITH j AS (SELECT o_custkey, min(o_orderdate) AS b, max(o_orderdate) AS n, count(*) FILTER (o_orderstatus = 'F') AS done, count(*) AS total FROM orders GROUP BY o_custkey),
        p AS (SELECT *, greatest(0.0, date_diff('microsecond', b, n) / 1000000.0::DOUBLE)::DOUBLE AS elapsed FROM j), q AS (SELECT *, CASE WHEN elapsed > 0 THEN done / elapsed ELSE 0.0 END::DOUBLE AS speed FROM p)
        SELECT o_custkey, done, total, elapsed, speed, CASE WHEN done < total AND speed > 0 THEN (total - done) / speed END AS remaining FROM q""",
    "lease_claims": """WITH n AS (SELECT max(ts) AS now FROM events)
        SELECT user_id, min(event_id) AS event_id, count(*) AS claimable FROM events, n WHERE event_type = 'view' OR ts + INTERVAL 1 HOUR <= now - INTERVAL 1 DAY GROUP BY user_id""",
    "live_entries": """WITH n AS (SELECT max(ts) AS now FROM events) SELECT event_id, user_id FROM events, n WHERE event_type = 'error' AND ts + to_seconds(floor(abs(coalesce(value, 0.0)) * 3600)::BIGINT) > now""",
    "sessions": """WITH g AS (SELECT user_id, CASE WHEN date_diff('microsecond', lag(ts) OVER w, ts) < 1800000000 THEN 0 ELSE 1 END AS fresh, ts, event_id FROM events WINDOW w AS (PARTITION BY user_id ORDER BY ts, event_id)),
        s AS (SELECT user_id, sum(fresh) OVER (PARTITION BY user_id ORDER BY ts, event_id) AS k FROM g), c AS (SELECT user_id, k, count(*) AS n FROM s GROUP BY ALL) SELECT user_id, count(*) AS sessions, max(n) AS largest FROM c GROUP BY user_id""",
    "stream_latest_status": "SELECT user_id, event_type, event_id FROM events QUALIFY row_number() OVER (PARTITION BY user_id ORDER BY ts DESC, event_id DESC) = 1",
    "stream_hourly_counts": "SELECT date_trunc('day', ts)::TIMESTAMP AS began, event_type, count(*) AS n FROM events GROUP BY ALL",
}

"""Queries on progress, retries and key health.  Events are calls; a user is a key."""

from __future__ import annotations

from pyspark.sql import functions as F

from leafmill.catalog import query
from leafmill.functions import text as T
from leafmill.operators import progress, recover
from leafmill.sources import files
from leafmill.sources.tables import table

_CALLS = "SELECT user_id AS key, event_id AS call, ts, event_type <> 'error' AS ok, value AS latency FROM events"


def _calls(spark, sf_dir):
    return table(spark, sf_dir, "events").select(F.col("user_id").alias("key"), F.col("event_id").alias("call"), F.col("ts").cast("timestamp").alias("ts"), (F.col("event_type") != "error").alias("ok"), F.col("value").alias("latency"))


_STATUS = "CASE event_type WHEN 'error' THEN 'failed' WHEN 'purchase' THEN 'completed' ELSE 'pending' END"
_STATE = f"SELECT step, pdf, status FROM (SELECT event_type_step AS step, user_id AS pdf, status, row_number() OVER (PARTITION BY event_type_step, user_id ORDER BY ts DESC, event_id DESC) AS place FROM (SELECT *, event_id % 4 AS event_type_step, {_STATUS} AS status FROM events)) WHERE place = 1"


def _state(spark, sf_dir):
    status = F.when(F.col("event_type") == "error", "failed").when(F.col("event_type") == "purchase", "completed").otherwise("pending")
    e = table(spark, sf_dir, "events").select((F.col("event_id") % 4).alias("step"), F.col("user_id").alias("pdf"), "ts", "event_id", status.alias("status"))
    return progress.latest(e, ["step", "pdf"], ["ts", "event_id"], ["status"])


@query("latest_state", _STATE)
def latest_state(spark, sf_dir):
    return _state(spark, sf_dir)


@query("progress_summary", f"SELECT *, completed * 100.0::DOUBLE / total AS percent, CASE WHEN completed = total THEN 'completed' ELSE 'in_progress' END AS step_status FROM (SELECT step, count(*) AS total, count_if(status = 'completed') AS completed, count_if(status = 'failed') AS failed, count_if(status = 'pending') AS pending FROM ({_STATE}) GROUP BY step)")
def progress_summary(spark, sf_dir):
    return progress.progress_summary(_state(spark, sf_dir), "step")


@query("resumed_pages", """SELECT conv_id AS pdf, turn AS page_num, CASE WHEN turn % 2 = 0 THEN role ELSE 'stored' END AS section, CASE WHEN turn % 2 = 0 THEN len(text) ELSE -1 END AS tokens, turn % 2 = 1 AS skipped FROM conversations""")
def resumed_pages(spark, sf_dir):
    c = table(spark, sf_dir, "conversations").select(F.col("conv_id").alias("pdf"), F.col("turn").alias("page_num"), "role", F.length("text").cast("long").alias("tokens"))
    stored = c.select("pdf", "page_num", F.lit("stored").alias("section"))
    fresh = c.where("page_num % 2 = 0").select("pdf", "page_num", F.col("role").alias("section"), "tokens")
    return progress.all_results(stored, fresh, ["pdf", "page_num"]).fillna(-1, ["tokens"])


@query("pending_anti", f"SELECT DISTINCT user_id AS pdf FROM events WHERE user_id NOT IN (SELECT pdf FROM ({_STATE}) WHERE step = 0 AND status = 'failed')")
def pending_anti(spark, sf_dir):
    wanted = table(spark, sf_dir, "events").select(F.col("user_id").alias("pdf")).distinct()
    return progress.pending(wanted, _state(spark, sf_dir).where("step = 0 AND status = 'failed'").select("pdf"), ["pdf"])


@query("resume_validation", """SELECT o_orderkey, CASE WHEN o_orderkey % 11 = 0 THEN 'not_listed' WHEN o_orderkey % 7 = 0 THEN 'no_output' WHEN o_orderkey % 1000 < 500 THEN 'too_small' WHEN o_custkey % 20 > 0 AND o_orderkey % 20 / greatest(o_custkey % 20, 1) < 0.9 THEN 'incomplete' ELSE 'ok' END AS reason FROM orders""")
def resume_validation(spark, sf_dir):
    k = F.col("o_orderkey")
    rows = table(spark, sf_dir, "orders").select("o_orderkey", (k % 11 != 0).alias("listed"), F.when(k % 7 != 0, k % 1000).alias("md_bytes"), (F.col("o_custkey") % 20).alias("total_pages"), (k % 20).alias("completed_pages"))
    return progress.resume_check(rows).select("o_orderkey", "reason")


@query("retry_schedule", "SELECT event_id, event_id % 7 AS attempt, least(pow(2, event_id % 7), 30)::DOUBLE AS seconds FROM events")
def retry_schedule(spark, sf_dir):
    attempt = F.col("event_id") % 7
    return table(spark, sf_dir, "events").select("event_id", attempt.alias("attempt"), T.backoff_seconds(attempt).alias("seconds"))


_ERROR = "CASE event_id % 4 WHEN 0 THEN 'TimeoutError: read' WHEN 1 THEN 'ValueError' WHEN 2 THEN 'DataInspectionFailed: inappropriate content' END"


def _errors(spark, sf_dir):
    k = F.col("event_id") % 4
    error = F.when(k == 0, "TimeoutError: read").when(k == 1, "ValueError").when(k == 2, "DataInspectionFailed: inappropriate content")
    return table(spark, sf_dir, "events").select("event_id", "user_id", error.alias("error"), (F.lit(400) + F.col("event_id") % 110).cast("int").alias("status"))


@query("retryable_errors", f"SELECT event_id, coalesce(error LIKE '%TimeoutError%', false) OR ((status IN (429, 500, 502, 503, 504) OR status >= 500) AND NOT coalesce(contains(error, 'DataInspectionFailed'), false)) AS retryable, coalesce(contains(error, 'DataInspectionFailed') AND contains(error, 'inappropriate'), false) AS blocked FROM (SELECT event_id, {_ERROR} AS error, 400 + event_id % 110 AS status FROM events)")
def retryable_errors(spark, sf_dir):
    return _errors(spark, sf_dir).select("event_id", progress.retryable(F.col("error"), F.col("status")).alias("retryable"), progress.blocked(F.col("error")).alias("blocked"))


@query("blocked_pages", "SELECT user_id AS pdf, event_id AS page_num FROM events WHERE event_id % 4 = 2")
def blocked_pages(spark, sf_dir):
    rows = _errors(spark, sf_dir)
    return rows.where(progress.blocked(F.col("error"))).select(F.col("user_id").alias("pdf"), F.col("event_id").alias("page_num"))


@query("key_health", "SELECT key, calls, successes, failures, success_rate, coalesce(floor(1000.0::DOUBLE * latency / greatest(successes, 1) + 0.5::DOUBLE) / 1000.0::DOUBLE, 0) AS avg_latency, calls = successes + failures AS balanced FROM (SELECT key, count(*) AS calls, count_if(ok) AS successes, count_if(NOT ok) AS failures, sum(CASE WHEN ok THEN latency END) AS latency, count(CASE WHEN ok THEN 1 END) / greatest(count(*), 1) AS success_rate FROM (" + _CALLS + ") GROUP BY key)")
def key_health(spark, sf_dir):
    return progress.key_health(_calls(spark, sf_dir)).select("key", "calls", "successes", "failures", "success_rate", T.rounded(F.col("avg_latency"), 3).alias("avg_latency"), (F.col("calls") == F.col("successes") + F.col("failures")).alias("balanced"))


_CONSECUTIVE = f"SELECT key, call, ok, CAST(sum(CASE WHEN ok THEN 0 ELSE 1 END) OVER (PARTITION BY key, run ORDER BY ts, call) AS BIGINT) AS consecutive FROM (SELECT *, sum(CASE WHEN ok THEN 1 ELSE 0 END) OVER (PARTITION BY key ORDER BY ts, call) AS run FROM ({_CALLS}))"


@query("consecutive_failures", _CONSECUTIVE)
def consecutive_failures(spark, sf_dir):
    return progress.consecutive_failures(_calls(spark, sf_dir)).select("key", "call", "ok", "consecutive")


@query("healthy_key_rank", f"SELECT key, row_number() OVER (ORDER BY success_rate DESC, consecutive, key) AS place FROM (SELECT key, count(CASE WHEN ok THEN 1 END) / count(*) AS success_rate, max(consecutive) AS consecutive FROM ({_CONSECUTIVE}) GROUP BY key)")
def healthy_key_rank(spark, sf_dir):
    calls = _calls(spark, sf_dir)
    worst = progress.consecutive_failures(calls).groupBy("key").agg(F.max("consecutive").alias("consecutive"))
    return progress.key_ranks(progress.key_health(calls).join(worst, "key"))


_BREAKER = f"""WITH RECURSIVE c AS (SELECT key, call, ts, ok, row_number() OVER (PARTITION BY key ORDER BY ts, call) AS n FROM ({_CALLS})),
 s AS (SELECT key, call, ts, n, CASE WHEN ok THEN 0 ELSE 1 END AS consecutive, CAST(NULL AS TIMESTAMP) AS until, false AS banned FROM c WHERE n = 1
 UNION ALL SELECT key, call, ts, n, CASE WHEN ok THEN 0 ELSE before + 1 END, CASE WHEN ok THEN NULL WHEN before + 1 >= 5 THEN ts + INTERVAL 300 SECOND ELSE running END, running IS NOT NULL
 FROM (SELECT c.key, c.call, c.ts, c.n, c.ok, CASE WHEN s.until IS NOT NULL AND c.ts > s.until THEN 0 ELSE s.consecutive END AS before, CASE WHEN s.until IS NOT NULL AND c.ts > s.until THEN NULL ELSE s.until END AS running FROM s JOIN c ON c.key = s.key AND c.n = s.n + 1))
 SELECT key, call, ts, CAST(consecutive AS INTEGER) AS consecutive, until IS NOT NULL AS disabled, until AS disabled_until, banned FROM s"""
# calls a few seconds apart, most of them failures, so that bans begin, run on, are lifted and expire
_CALLS_OFTEN = "SELECT user_id % 5 AS key, event_id AS call, TIMESTAMP '2024-01-01' + to_seconds(event_id * 7 + (event_id // 100) * 400) AS ts, event_type = 'purchase' AND event_id % 3 = 0 AS ok, value AS latency FROM events"


def _calls_often(spark, sf_dir):
    i = F.col("event_id")
    at = F.timestamp_add("SECOND", i * 7 + F.floor(i / 100) * 400, F.lit("2024-01-01").cast("timestamp"))
    return table(spark, sf_dir, "events").select((F.col("user_id") % 5).alias("key"), i.alias("call"), at.alias("ts"), ((F.col("event_type") == "purchase") & (i % 3 == 0)).alias("ok"), F.col("value").alias("latency"))


@query("circuit_breaker_bans", _BREAKER.replace(_CALLS, _CALLS_OFTEN))
def circuit_breaker_bans(spark, sf_dir):
    return progress.circuit_breaker(_calls_often(spark, sf_dir))


_NOW = "TIMESTAMP '2024-01-01' + to_seconds(1000)"


@query("chosen_key", f"""WITH b AS ({_BREAKER.replace(_CALLS, _CALLS_OFTEN)}), h AS (SELECT key, avg(CASE WHEN ok THEN 1.0 ELSE 0.0 END) AS rate FROM ({_CALLS_OFTEN}) GROUP BY key), l AS (SELECT key, max(CASE WHEN call = last THEN consecutive END) AS consecutive, max(CASE WHEN call = last THEN disabled_until END) AS until FROM (SELECT *, max(call) OVER (PARTITION BY key) AS last FROM b) GROUP BY key),
 r AS (SELECT key, coalesce(until < {_NOW}, true) AS free, rate, consecutive, until FROM h JOIN l USING (key))
 SELECT coalesce((SELECT key FROM r WHERE free ORDER BY rate DESC, consecutive, key LIMIT 1), (SELECT key FROM r ORDER BY until, key LIMIT 1)) AS key, NOT EXISTS (SELECT 1 FROM r WHERE free) AS forced""")
def chosen_key(spark, sf_dir):
    calls = _calls_often(spark, sf_dir)
    last = progress.latest(progress.circuit_breaker(calls), ["key"], ["call"], ["consecutive", "disabled_until"])
    return progress.chosen_key(progress.key_health(calls).join(last, "key"), F.timestamp_add("SECOND", F.lit(1000), F.lit("2024-01-01").cast("timestamp")))


@query("invalidated_documents", """SELECT o_orderkey AS pdf, 'pending' AS status, CASE WHEN o_orderkey % 7 = 0 THEN 'no_output' ELSE 'too_small' END AS error FROM orders WHERE o_orderstatus = 'F' AND (o_orderkey % 7 = 0 OR o_orderkey % 1000 < 500)""")
def invalidated_documents(spark, sf_dir):
    k = F.col("o_orderkey")
    o = table(spark, sf_dir, "orders")
    state = o.select(k.alias("pdf"), F.when(F.col("o_orderstatus") == "F", "completed").otherwise("pending").alias("status"))
    check = progress.resume_check(o.select(k.alias("pdf"), F.lit(True).alias("listed"), F.when(k % 7 != 0, k % 1000).alias("md_bytes"), F.lit(0).alias("total_pages"), F.lit(0).alias("completed_pages")))
    return progress.invalidations(state, check, ["pdf"])


@query("pages_after_invalidation", """SELECT l_orderkey AS pdf, count(*) AS pages FROM lineitem WHERE l_orderkey NOT IN (SELECT o_orderkey FROM orders WHERE o_orderstatus = 'F' AND (o_orderkey % 7 = 0 OR o_orderkey % 1000 < 500)) GROUP BY l_orderkey""")
def pages_after_invalidation(spark, sf_dir):
    pages = table(spark, sf_dir, "lineitem").select(F.col("l_orderkey").alias("pdf"))
    return progress.after_invalidation(pages, invalidated_documents(spark, sf_dir), ["pdf"]).groupBy("pdf").agg(F.count(F.lit(1)).alias("pages"))


@query("overall_status", f"SELECT count(*) AS steps, count_if(s = 'completed') AS completed, CASE WHEN count(CASE WHEN s = 'failed' THEN 1 END) > 0 THEN 'failed' WHEN count(CASE WHEN s = 'completed' THEN 1 END) = count(*) AND count(*) > 0 THEN 'completed' WHEN count(CASE WHEN s = 'completed' THEN 1 END) > 0 THEN 'in_progress' ELSE 'pending' END AS status FROM (SELECT step, arg_max(status, pdf) AS s FROM ({_STATE}) GROUP BY step)")
def overall_status(spark, sf_dir):
    return progress.overall_status(_state(spark, sf_dir).groupBy("step").agg(F.max_by("status", "pdf").alias("status")))


@query("completion_rates", """SELECT *, CASE WHEN rate > 0 THEN (50 - done) / rate END AS seconds_left FROM (SELECT *, CASE WHEN elapsed > 0 THEN done / elapsed ELSE 0 END AS rate FROM (SELECT o_custkey, item, done_at, row_number() OVER (PARTITION BY o_custkey ORDER BY done_at, item) AS done, done_at - min(done_at) OVER (PARTITION BY o_custkey) AS elapsed, 50 AS total
 FROM (SELECT o_custkey, o_orderkey AS item, CAST(o_orderkey % 5000 AS DOUBLE) AS done_at FROM orders)))""")
def completion_rates(spark, sf_dir):
    done = table(spark, sf_dir, "orders").select("o_custkey", F.col("o_orderkey").alias("item"), (F.col("o_orderkey") % 5000).cast("double").alias("done_at"))
    return progress.completion_rates(done, "o_custkey", "done_at", F.lit(50)).withColumn("done", F.col("done").cast("long"))


@query("recorded_calls", f"SELECT key, count(*) AS calls FROM ({_CALLS}) WHERE key IN (SELECT c_custkey FROM customer WHERE c_acctbal > 0) GROUP BY key")
def recorded_calls(spark, sf_dir):
    known = table(spark, sf_dir, "customer").where("c_acctbal > 0").select(F.col("c_custkey").alias("key"))
    return progress.recorded(_calls(spark, sf_dir), known).groupBy("key").agg(F.count(F.lit(1)).alias("calls"))


@query("retry_jitter", "SELECT event_id, greatest(w + w * 0.25::DOUBLE * (chance * 2 - 1), 0.1::DOUBLE) AS seconds FROM (SELECT event_id, least(pow(2, event_id % 7), 30)::DOUBLE AS w, (event_id % 101) / 100.0::DOUBLE AS chance FROM events)")
def retry_jitter(spark, sf_dir):
    return table(spark, sf_dir, "events").select("event_id", T.backoff_seconds(F.col("event_id") % 7, chance=F.col("event_id") % 101 / 100.0).alias("seconds"))


@query("circuit_breaker", _BREAKER)
def circuit_breaker(spark, sf_dir):
    return progress.circuit_breaker(_calls(spark, sf_dir))


@query("step_states", f"SELECT step, min(CASE WHEN status = 'pending' THEN call END) IS NOT NULL AS seen_pending, arg_max(status, call) AS status FROM (SELECT event_id % 4 AS step, event_id AS call, {_STATUS} AS status FROM events) GROUP BY step")
def step_states(spark, sf_dir):
    status = F.when(F.col("event_type") == "error", "failed").when(F.col("event_type") == "purchase", "completed").otherwise("pending")
    e = table(spark, sf_dir, "events").select((F.col("event_id") % 4).alias("step"), F.col("event_id").alias("ts"), F.col("event_id").alias("event"), status.alias("status"))
    seen = e.groupBy("step").agg(F.count_if(F.col("status") == "pending").alias("n"))
    return progress.step_states(e).join(seen, "step").select("step", (F.col("n") > 0).alias("seen_pending"), "status")


# every document is a page; which failed, and how its two recoveries ended, depends on its length
_STATES = "SELECT source AS pdf, doc_id AS page_num, CASE WHEN n_chars % 3 = 0 THEN 'failed' ELSE 'ok' END AS status, CASE n_chars % 9 WHEN 0 THEN 'TimeoutError: read' WHEN 3 THEN 'DataInspectionFailed: inappropriate content' WHEN 6 THEN 'DataInspectionFailed: other' END AS error, 'old ' || doc_id AS section, n_chars FROM documents"
_RECOVERED = f"SELECT pdf, page_num, attempt, (n_chars + attempt) % 4 < 2 AS success, 'new ' || page_num || '/' || attempt AS section, n_chars AS tokens, CAST(n_chars % 9 AS DOUBLE) AS seconds, CASE WHEN (n_chars + attempt) % 4 >= 2 THEN CASE WHEN n_chars % 2 = 0 THEN 'refused' ELSE 'no answer' END END AS error FROM (SELECT *, unnest([1, 2]) AS attempt FROM ({_STATES}) WHERE status = 'failed')"


def _states(spark, sf_dir):
    n, i = F.col("n_chars"), F.col("doc_id")
    error = F.when(n % 9 == 0, "TimeoutError: read").when(n % 9 == 3, "DataInspectionFailed: inappropriate content").when(n % 9 == 6, "DataInspectionFailed: other")
    return table(spark, sf_dir, "documents").select(F.col("source").alias("pdf"), i.alias("page_num"), F.when(n % 3 == 0, "failed").otherwise("ok").alias("status"), error.alias("error"), F.concat(F.lit("old "), i.cast("string")).alias("section"), "n_chars")


def _recovered(spark, sf_dir):
    n = F.col("n_chars")
    rows = _states(spark, sf_dir).where("status = 'failed'").withColumn("attempt", F.explode(F.array(F.lit(1), F.lit(2))))
    success = (n + F.col("attempt")) % 4 < 2
    section = F.concat(F.lit("new "), F.col("page_num").cast("string"), F.lit("/"), F.col("attempt").cast("string"))
    return rows.select("pdf", "page_num", "attempt", success.alias("success"), section.alias("section"), n.alias("tokens"), (n % 9).cast("double").alias("seconds"), F.when(~success, F.when(n % 2 == 0, "refused").otherwise("no answer")).alias("error"))


@query("recover_merge", f"SELECT pdf, page_num, coalesce(r.section, o.section) AS section, r.section IS NOT NULL AS recovered FROM (SELECT pdf, page_num, section FROM ({_STATES}) WHERE status = 'ok' OR n_chars % 2 = 0) o FULL JOIN (SELECT pdf, page_num, arg_min(section, attempt) AS section FROM ({_RECOVERED}) WHERE success GROUP BY ALL) r USING (pdf, page_num)")
def recover_merge(spark, sf_dir):
    there = _states(spark, sf_dir).where("status = 'ok' OR n_chars % 2 = 0").select("pdf", "page_num", "section")
    return recover.recovered_pages(there, _recovered(spark, sf_dir), "attempt")


@query("recover_failed_pages", f"SELECT pdf, count(*) AS failed, count(r.page_num) AS recovered FROM (SELECT pdf, page_num FROM ({_STATES}) WHERE status = 'failed') f LEFT JOIN (SELECT DISTINCT pdf, page_num FROM ({_RECOVERED}) WHERE success) r USING (pdf, page_num) GROUP BY pdf")
def recover_failed_pages(spark, sf_dir):
    failed = _states(spark, sf_dir).where("status = 'failed'").select("pdf", "page_num")
    return recover.still_failed(failed, _recovered(spark, sf_dir))


@query("failed_details", f"SELECT pdf, page_num, error FROM ({_STATES}) s WHERE status = 'failed' AND NOT EXISTS (SELECT 1 FROM ({_RECOVERED}) r WHERE success AND r.pdf = s.pdf AND r.page_num = s.page_num)")
def failed_details(spark, sf_dir):
    failed = _states(spark, sf_dir).where("status = 'failed'").select("pdf", "page_num", "error")
    return recover.failed_details(failed, _recovered(spark, sf_dir))


@query("recovery_stats", f"SELECT *, total / seconds AS pages_per_second FROM (SELECT count(*) AS total, count_if(success) AS succeeded, count_if(NOT success) AS failed, CAST(sum(tokens) AS BIGINT) AS tokens, sum(seconds) AS seconds FROM ({_RECOVERED}))")
def recovery_stats(spark, sf_dir):
    return recover.recovery_statistics(_recovered(spark, sf_dir))


@query("recovery_errors", f"SELECT error, count(*) AS failures, string_agg(CASE WHEN place <= 10 THEN pdf || ' page ' || page_num END, ', ' ORDER BY place) AS pages FROM (SELECT *, row_number() OVER (PARTITION BY error ORDER BY pdf, page_num, attempt) AS place FROM ({_RECOVERED}) WHERE NOT success) GROUP BY error")
def recovery_errors(spark, sf_dir):
    return recover.recovery_errors(_recovered(spark, sf_dir), ["pdf", "page_num", "attempt"])


@query("recovery_report", f"""WITH e AS (SELECT *, row_number() OVER (ORDER BY pdf, page_num, attempt) AS i, count(*) OVER () AS n FROM ({_RECOVERED}) WHERE NOT success)
 SELECT row_number() OVER (ORDER BY section, i) AS place, line FROM (SELECT 1 AS section, i, '{{"pdf":"' || pdf || '","page_num":' || page_num || ',"attempt":' || attempt || ',"error":"' || error || '"}}' || CASE WHEN i < n THEN ',' ELSE '' END AS line FROM e UNION ALL SELECT 0, 0, '{{' UNION ALL SELECT 0, 1, '"errors":[' UNION ALL SELECT 2, 0, '],'
 UNION ALL SELECT 3, 0, '"stats":{{"total":' || total || ',"succeeded":' || succeeded || ',"failed":' || failed || ',"tokens":' || tokens || ',"seconds":' || seconds || ',"pages_per_second":' || pages_per_second || '}},' FROM (SELECT *, total / seconds AS pages_per_second FROM (SELECT count(*) AS total, count(CASE WHEN success THEN 1 END) AS succeeded, count(CASE WHEN NOT success THEN 1 END) AS failed, CAST(sum(tokens) AS BIGINT) AS tokens, sum(seconds) AS seconds FROM ({_RECOVERED})))
 UNION ALL SELECT 4, 0, '"run":{{"timestamp":"2024-01-01","model":"m","concurrency":10}}' UNION ALL SELECT 5, 0, '}}')""")
def recovery_report(spark, sf_dir):
    return recover.recovery_report(_recovered(spark, sf_dir), "m", 10, "2024-01-01", ["pdf", "page_num", "attempt"])


@query("content_blocked", f"SELECT pdf, page_num FROM ({_STATES}) WHERE status = 'failed' AND contains(error, 'DataInspectionFailed') AND contains(error, 'inappropriate') ORDER BY pdf, page_num LIMIT 50")
def content_blocked(spark, sf_dir):
    return recover.limited(recover.blocked_pages(_states(spark, sf_dir)).select("pdf", "page_num"), 50, ["pdf", "page_num"])


@query("log_tail", "SELECT user_id, event_id FROM (SELECT *, row_number() OVER (PARTITION BY user_id ORDER BY event_id DESC) AS place FROM events) WHERE place <= 10")
def log_tail(spark, sf_dir):
    return files.log_tail(table(spark, sf_dir, "events").select("user_id", "event_id"), "user_id", "event_id", 10)

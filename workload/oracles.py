"""SQL with the same rows as the queries, written from the definitions of the operators."""

from __future__ import annotations

from onlinecast.operators.models import mlp_model

ORACLES: dict[str, str] = {}

TICK = 21600
HOUR = 3600
PER_TICK = 1 << 31

READINGS = """r AS (
  SELECT user_id AS stream_id, ts, event_id, value,
         row_number() OVER (PARTITION BY user_id ORDER BY ts, event_id) - 1 AS pos,
         count(*) OVER (PARTITION BY user_id) AS n
  FROM events)"""

LINES = """r AS (
  SELECT l_suppkey AS stream_id, l_shipdate AS ts, l_quantity AS value,
         row_number() OVER (PARTITION BY l_suppkey ORDER BY l_shipdate, l_orderkey * 8 + l_linenumber) - 1 AS pos,
         count(*) OVER (PARTITION BY l_suppkey) AS n
  FROM lineitem)"""


def lookback(size: int, shift: int, name: str = "w", value: str = "b.value") -> str:
    return f"""{name} AS (
  SELECT a.stream_id, a.pos // {shift} AS k, max(b.ts) AS t_end, list({value} ORDER BY b.pos) AS x
  FROM r a JOIN r b ON a.stream_id = b.stream_id AND b.pos >= a.pos AND b.pos < a.pos + {size}
  WHERE a.pos % {shift} = 0 AND a.pos + {size} <= a.n
  GROUP BY a.stream_id, a.pos)"""


def training(size: int, shift: int, step: int, ahead: int, value: str = "b.value") -> str:
    first = size + step - 1
    need = size + step + ahead
    return f"""w AS (
  SELECT a.stream_id, a.pos // {shift} AS k, max(b.ts) AS t_end,
         list({value} ORDER BY b.pos) FILTER (WHERE b.pos < a.pos + {size}) AS x,
         list({value} ORDER BY b.pos) FILTER (WHERE b.pos >= a.pos + {first} AND b.pos < a.pos + {first + ahead}) AS y
  FROM r a JOIN r b ON a.stream_id = b.stream_id AND b.pos >= a.pos AND b.pos < a.pos + {need}
  WHERE a.pos % {shift} = 0 AND a.pos + {need} <= a.n
  GROUP BY a.stream_id, a.pos)"""


def values(keys: str, source: str = "w", array: str = "x") -> str:
    return f"SELECT {keys}, unnest({array}) AS v, generate_subscripts({array}, 1) - 1 AS i FROM {source}"


INFERENCE = f"{READINGS}, {lookback(3, 1)}"

ADAPTIVE = f"""b AS (
  SELECT *, (place - 1) // 3 + tick * {PER_TICK} AS batch_id, (place - 1) % 3 AS pos FROM (
    SELECT *, row_number() OVER (PARTITION BY model_id, tick ORDER BY t_end, stream_id, k) AS place FROM (
      SELECT *, stream_id % 10 AS model_id, CAST(epoch_us(t_end) // 1000000 // {TICK} AS BIGINT) AS tick FROM w)))"""

SCORED = f"""{INFERENCE}, {ADAPTIVE}, s AS (
  SELECT *, (x[1] + x[2] + x[3]) / 3 AS pred, x[3] AS "true" FROM b)"""


def errors(order: str, keys: str) -> str:
    return f"""e AS (SELECT *, lag(pred) OVER (PARTITION BY {keys} ORDER BY {order}) AS before FROM s),
d AS (SELECT model_id, batch_id, stream_id, max(t_end) AS ts, count(*) AS n,
             sqrt(avg((before - "true") * (before - "true"))) AS loss,
             list(pred ORDER BY pos) AS preds, list("true" ORDER BY pos) AS trues
      FROM e GROUP BY model_id, batch_id, stream_id)"""


DOCUMENTS = f"{SCORED}, {errors('k', 'model_id, stream_id')}"

ROLLED = f"""{DOCUMENTS}, a AS (
  SELECT d.*, CASE WHEN loss IS NOT NULL THEN avg(loss) OVER (
    PARTITION BY model_id, stream_id, loss IS NULL ORDER BY batch_id ROWS BETWEEN 2 PRECEDING AND CURRENT ROW)
  END AS average_loss FROM d)"""

REGISTRY = """g AS (
  SELECT user_id % 10 AS model_id, ts AS update_time, value AS loss, floor(value / 50) / 10 AS bias,
         row_number() OVER (PARTITION BY user_id % 10 ORDER BY ts, event_id) AS version
  FROM events),
c AS (SELECT *, (bias - lag(bias) OVER (PARTITION BY model_id ORDER BY version)) ** 2 AS distance FROM g)"""

RESULTS = f"""{ROLLED}, {REGISTRY}, z AS (
  SELECT *, row_number() OVER (
    PARTITION BY model_id ORDER BY batch_id, stream_id NULLS FIRST, updated_at NULLS FIRST) - 1 AS seq
  FROM (
    SELECT model_id, batch_id, stream_id, ts, loss, average_loss, preds, trues, NULL AS updated_at FROM a
    UNION ALL
    SELECT model_id, CAST(epoch_us(update_time) // 1000000 // {TICK} AS BIGINT) * {PER_TICK} + {PER_TICK - 1}, NULL, NULL, NULL,
           NULL, NULL, NULL, update_time FROM c WHERE distance > 0))"""

MODELS = """m AS (
  SELECT s_suppkey AS model_id, s_name AS name, s_suppkey AS s, 2 + s_suppkey % 3 AS look_back,
         1 + s_suppkey % 2 AS shift, 1 + s_suppkey % 2 AS forward_step, 1 + s_suppkey % 4 AS forward_size,
         s_suppkey % 3 <> 0 AS online
  FROM supplier),
subs AS (
  SELECT model_id, s + i AS stream_id, 'infer' AS mode, look_back, shift, look_back AS need, 0 AS f, 0 AS ahead
  FROM m, range(3) t(i)
  UNION ALL
  SELECT model_id, s + i, 'train', look_back, shift, look_back + forward_step + forward_size, forward_step, forward_size
  FROM m, range(3) t(i) WHERE online)"""

LEARNING = f"{READINGS}, {training(2, 1, 1, 1, 'b.value / 100')}, l AS (SELECT *, stream_id % 10 AS model_id FROM w)"

LEARNING_BATCHES = f"""{LEARNING}, lb AS (
  SELECT *, (row_number() OVER (PARTITION BY model_id ORDER BY t_end, stream_id, k) - 1) // 30 AS batch_id FROM l)"""


def gradients(source: str, keys: str, name: str) -> str:
    miss = "2 * (0.5 * x[1] + 0.25 * x[2] + 0.1 - y[1])"
    return f"""{name} AS (
  SELECT {keys}, p, avg({miss} * CASE p WHEN 0 THEN x[1] WHEN 1 THEN x[2] ELSE 1 END) AS g
  FROM {source}, range(3) t(p) GROUP BY {keys}, p)"""


CURRENT = f"""{LEARNING},
aged AS (SELECT *, row_number() OVER (PARTITION BY model_id, stream_id ORDER BY t_end DESC, k DESC) AS age FROM l),
others AS (SELECT * FROM aged WHERE age > 7),
{gradients("others", "model_id", "cur")},
mem AS (SELECT * FROM aged WHERE age <= 7),
{gradients("mem", "model_id, stream_id", "mg")}"""

SIMILAR = """sim AS (
  SELECT label AS stream_id, vec_id AS k, v, list_sum(v) / (sqrt(list_sum(list_transform(v, lambda q: q * q))) * sqrt(64)) AS s
  FROM (SELECT label, vec_id, CAST(embedding AS DOUBLE[]) AS v FROM embeddings)),
ends AS (SELECT *, min(s) OVER (PARTITION BY stream_id) AS lo, max(s) OVER (PARTITION BY stream_id) AS hi FROM sim)"""


def similar(capacity: int) -> str:
    return f"""{SIMILAR},
binned AS (SELECT *, CASE WHEN s = lo THEN 0 WHEN s = hi THEN {capacity} ELSE floor((s - lo) / ((hi - lo) / {capacity})) END AS bin,
                  s = lo OR s = hi AS is_end FROM ends),
kept AS (SELECT * FROM binned WHERE is_end OR (bin >= 1 AND bin <= {capacity - 2})
         QUALIFY row_number() OVER (PARTITION BY stream_id, bin ORDER BY k) = 1)"""


TICKS = f"""arrivals AS (
  SELECT user_id % 10 AS model_id, CAST(epoch_us(ts) // 1000000 // {HOUR} AS BIGINT) AS tick, count(*) AS arrivals
  FROM events GROUP BY 1, 2),
rates AS (
  SELECT *, CAST(coalesce(tick - lag(tick) OVER (PARTITION BY model_id ORDER BY tick), 1) * {HOUR} AS DOUBLE) AS elapsed
  FROM arrivals)"""

COSTS = """costs AS (
  SELECT l_suppkey % 10 AS model_id, regr_slope(seconds, l_quantity) AS slope, regr_intercept(seconds, l_quantity) AS intercept
  FROM (SELECT *, 20 * l_quantity + 100 * l_tax + l_linenumber AS seconds FROM lineitem) GROUP BY 1)"""

PAYLOAD = "CASE WHEN event_type = 'error' THEN props ELSE CAST(value AS VARCHAR) END"

ORACLES["source_readings"] = """
SELECT 'sensor.ami' || user_id AS topic, user_id AS stream_id, epoch_us(ts) AS ts, event_id, CAST(value AS VARCHAR) AS payload
FROM events"""

ORACLES["sink_source_windows"] = f"""
WITH {READINGS}, {training(3, 1, 2, 2)}
{values("stream_id, epoch_us(t_end) AS t_end", "(SELECT *, x || y AS xy FROM w)", "xy")}"""

ORACLES["sink_source_results"] = f"""
WITH {ROLLED}
SELECT model_id, row_number() OVER (PARTITION BY model_id ORDER BY batch_id, stream_id) - 1 AS seq, batch_id, stream_id, n,
       epoch_us(ts) AS ts, round(loss, 6) AS loss, round(average_loss, 6) AS average_loss
FROM a"""

ORACLES["decoded_readings"] = """
SELECT user_id AS stream_id, epoch_us(ts) AS ts, event_id, value FROM events WHERE event_type <> 'error'"""

ORACLES["quarantined_readings"] = """
SELECT 'sensor.ami' || user_id AS topic, event_id, props AS payload, 'payload' AS reason
FROM events WHERE event_type = 'error'"""

ORACLES["window_records"] = f"""
WITH {INFERENCE}
SELECT stream_id, k, CAST(x[1] AS VARCHAR) || ',' || CAST(x[2] AS VARCHAR) || ',' || CAST(x[3] AS VARCHAR)
       || ',sensor.ami' || stream_id || ',' AS record
FROM w"""

ORACLES["parsed_records"] = f"""
WITH {READINGS}, {training(3, 2, 1, 2)}
{values("stream_id, k", "(SELECT *, x || y AS xy FROM w)", "xy")}"""

ORACLES["stream_ids"] = "SELECT event_id, user_id AS stream_id FROM events"

ORACLES["stream_catalog"] = """
SELECT 'sensor.ami' || user_id AS topic, 'sensor' AS namespace, 'ami' || user_id AS name, count(*) AS readings,
       epoch_us(min(ts)) AS first_ts, epoch_us(max(ts)) AS last_ts
FROM events GROUP BY user_id"""

ORACLES["observed_values"] = f"""
WITH {READINGS}
SELECT stream_id, (pos - 2) // 2 AS k, value AS observed FROM r WHERE pos >= 2 AND (pos - 2) % 2 = 0"""

ORACLES["results_for_model"] = f"""
WITH {RESULTS}, {MODELS}
SELECT z.model_id, seq, z.stream_id, round(loss, 6) AS loss, epoch_us(updated_at) AS updated_at
FROM z WHERE z.stream_id IS NULL OR (z.model_id, z.stream_id) IN (SELECT (model_id, stream_id) FROM subs)"""

ORACLES["lookback_windows"] = f"""
WITH {READINGS}, {lookback(5, 2)}
{values("stream_id, k, epoch_us(t_end) AS t_end")}"""

ORACLES["lookback_windows_lineitem"] = f"""
WITH {LINES}
SELECT * FROM (
  SELECT stream_id, pos - 35 AS k, epoch_us(ts) AS t_end,
         sum(value) OVER (PARTITION BY stream_id ORDER BY pos ROWS BETWEEN 35 PRECEDING AND CURRENT ROW) AS total
  FROM r)
WHERE k >= 0"""

ORACLES["lookback_windows_cut"] = ORACLES["lookback_windows_lineitem"].replace(
    "ORDER BY l_shipdate, l_orderkey * 8 + l_linenumber", "ORDER BY l_shipdate, -(l_orderkey * 8 + l_linenumber)"
)

def hidden_layer(weights: list[str]) -> tuple[list[str], str]:
    """The four hidden values and the output of a tanh network on two inputs."""
    hidden = [f"tanh(x[1] * ({weights[j]}) + x[2] * ({weights[4 + j]}) + ({weights[8 + j]}))" for j in range(4)]
    return hidden, " + ".join(f"({h}) * ({weights[12 + j]})" for j, h in enumerate(hidden)) + f" + ({weights[16]})"


def network_step() -> str:
    """Loss of the network after one step of 0.05 along its mean gradient."""
    start = [repr(float(v)) for v in mlp_model(2, 4).init]
    hidden, output = hidden_layer(start)
    back = [f"2 * miss * ({start[12 + j]}) * (1 - a{j} * a{j})" for j in range(4)]
    slopes = [f"{back[j]} * x[1]" for j in range(4)] + [f"{back[j]} * x[2]" for j in range(4)] + back
    slopes += [f"2 * miss * a{j}" for j in range(4)] + ["2 * miss"]
    moved = ", ".join(f"({w}) - 0.05 * avg({slope}) AS w{k}" for k, (w, slope) in enumerate(zip(start, slopes, strict=True)))
    inner = ", ".join(f"{h} AS a{j}" for j, h in enumerate(hidden))
    return f"""
WITH {LEARNING},
f AS (SELECT *, {inner}, {output} - y[1] AS miss FROM l),
n AS (SELECT model_id, {moved} FROM f GROUP BY model_id)
SELECT model_id, round(avg(({hidden_layer([f"w{k}" for k in range(17)])[1]} - y[1]) ** 2), 6) AS loss
FROM l JOIN n USING (model_id) GROUP BY model_id"""


ORACLES["user_model"] = network_step()

ORACLES["training_windows"] = f"""
WITH {READINGS}, {training(4, 3, 2, 3)}
{values("stream_id, k, epoch_us(t_end) AS t_end", "(SELECT *, x || y AS xy FROM w)", "xy")}"""

ORACLES["multi_stream_windows"] = f"""
WITH {READINGS}, c AS (
  SELECT a.stream_id // 3 AS group_id, a.pos // 2 AS k, a.stream_id, a.pos AS start, b.pos, b.value, e.ts
  FROM r a JOIN r b ON a.stream_id = b.stream_id AND b.pos >= a.pos AND b.pos < a.pos + 3
  JOIN r e ON e.stream_id = a.stream_id AND e.pos = a.pos + 3
  WHERE a.pos % 2 = 0),
members AS (SELECT user_id // 3 AS group_id, count(DISTINCT user_id) AS expected FROM events GROUP BY 1),
full_groups AS (
  SELECT group_id, k, max(ts) AS t_end FROM c JOIN members USING (group_id)
  GROUP BY group_id, k, expected HAVING count(*) = 3 * expected)
SELECT group_id, k, epoch_us(t_end) AS t_end, value AS v,
       row_number() OVER (PARTITION BY group_id, k ORDER BY stream_id, pos) - 1 AS i
FROM c JOIN full_groups USING (group_id, k)"""

ORACLES["model_windows"] = f"""
WITH {READINGS}, {MODELS}
SELECT s.model_id, s.stream_id, s.mode, a.pos // s.shift AS k, epoch_us(e.ts) AS t_end, b.value AS v,
       CASE WHEN b.pos - a.pos < s.look_back THEN b.pos - a.pos ELSE b.pos - a.pos - s.f + 1 END AS i
FROM subs s
JOIN r a ON a.stream_id = s.stream_id AND a.pos % s.shift = 0 AND a.pos + s.need <= a.n
JOIN r e ON e.stream_id = s.stream_id AND e.pos = a.pos + s.need - 1
JOIN r b ON b.stream_id = s.stream_id AND b.pos >= a.pos AND (
  b.pos < a.pos + s.look_back
  OR (s.mode = 'train' AND b.pos >= a.pos + s.look_back + s.f - 1 AND b.pos < a.pos + s.look_back + s.f - 1 + s.ahead))"""

ORACLES["fixed_batches"] = f"""
WITH {INFERENCE}, o AS (
  SELECT *, stream_id % 10 AS model_id, row_number() OVER (PARTITION BY stream_id % 10 ORDER BY t_end, stream_id, k) - 1 AS place,
         count(*) OVER (PARTITION BY stream_id % 10) AS held
  FROM w)
SELECT model_id, place // 32 AS batch_id, place % 32 AS pos, stream_id, k FROM o WHERE place < held - held % 32"""

ORACLES["batches_cut"] = ORACLES["fixed_batches"]

ORACLES["running_cut"] = """
SELECT user_id % 10 AS model_id, event_id, sum(event_id) OVER (
  PARTITION BY user_id % 10 ORDER BY value > 50,
    CASE WHEN event_id % 2 = 0 THEN 9223372036854775000 - event_id ELSE event_id - 9223372036854775000 END
  ROWS UNBOUNDED PRECEDING)::BIGINT AS total
FROM events"""

ORACLES["adaptive_batches"] = f"""
WITH {INFERENCE}, {ADAPTIVE}
SELECT model_id, tick, batch_id, pos, stream_id, k FROM b"""

ORACLES["arrival_rate"] = f"""
WITH {TICKS}
SELECT model_id, tick, arrivals, elapsed, round(arrivals / elapsed, 6) AS rate FROM rates"""

ORACLES["fit_cost_model"] = f"""
WITH {COSTS}
SELECT model_id, round(slope, 6) AS slope, round(intercept, 6) AS intercept FROM costs"""

ORACLES["recent_error"] = """
SELECT user_id % 10 AS model_id, event_id AS batch_id,
       round((coalesce(sum(value) OVER past, 0) + 0.3 * (5 - count(value) OVER past)) / 5, 6) AS recent_error
FROM events
WINDOW past AS (PARTITION BY user_id % 10 ORDER BY event_id ROWS BETWEEN 5 PRECEDING AND 1 PRECEDING)"""

WHOLE_EPOCHS = """unnest(list_concat(CASE WHEN top < 1 THEN [1.0::DOUBLE] ELSE [top] END,
    list_transform(range(1, CAST(floor(greatest(top, 0)) AS BIGINT) + 1), lambda v: CAST(v AS DOUBLE))))"""
REAL_EPOCHS = """greatest(least(CASE WHEN intercept > 0 THEN sqrt(60000 * ratio / slope) / (intercept * ld) ELSE top END, top), 1.0)"""


def budgets(epochs: str) -> str:
    return f"""
WITH {TICKS}, {COSTS},
q AS (
  SELECT model_id, tick, arrivals, arrivals / elapsed AS ld, slope, intercept, (1 + tick % 7) / 10.0 / 0.3 AS ratio,
         greatest(elapsed, CASE WHEN 1 - slope * arrivals / elapsed <> 0 THEN intercept / (1 - slope * arrivals / elapsed) END) AS t
  FROM rates JOIN costs USING (model_id)),
tm AS (SELECT *, (t - intercept) / (slope * ld * t) AS top FROM q),
choices AS (SELECT *, {epochs} AS e FROM tm),
cubic AS (SELECT *, ld * (slope * e - intercept) AS b, ld * 60000 * ratio / e AS c FROM choices),
sized AS (
  -- Newton's steps from a point right of the positive root of d^3 + b d^2 - c, which they never cross
  SELECT *, list_reduce(list_prepend(abs(b) + cbrt(c), list_transform(range(300), lambda i: 0.0::DOUBLE)),
    lambda d, _: d - (d * d * (d + b) - c) / (3 * d * d + 2 * b * d)) AS d FROM cubic),
weighed AS (SELECT *, d * d / (2 * ld) + slope * d * e - intercept * d + 60000 * ratio / (e * d) AS cost FROM sized),
best AS (SELECT * FROM weighed QUALIFY row_number() OVER (PARTITION BY model_id, tick ORDER BY cost, e) = 1)
SELECT model_id, tick, CAST(greatest(floor(e), 1) AS BIGINT) AS epochs, CAST(greatest(floor(d), 1) AS BIGINT) AS batch_size,
       round(greatest((greatest(floor(d), 1) - arrivals) / ld, 0), 6) AS wait_seconds
FROM best"""


ORACLES["training_budget"] = budgets(WHOLE_EPOCHS)

# The least cost over real epochs; the key is from an earlier form of the search.
ORACLES["training_budget_descent"] = budgets(REAL_EPOCHS)

ORACLES["subscribe"] = f"""
WITH {MODELS}
SELECT model_id, mode, stream_id, event_id, value FROM events JOIN subs ON user_id = stream_id"""

ORACLES["merge_streams"] = """
SELECT user_id AS stream_id, epoch_us(ts) AS ts, event_id, value FROM events
UNION ALL
SELECT l_suppkey, epoch_us(l_shipdate), l_orderkey * 8 + l_linenumber, l_quantity FROM lineitem"""

ASOF = f"""{SCORED}, {REGISTRY},
t AS (SELECT model_id, batch_id, max(t_end) AS ts FROM s GROUP BY 1, 2),
v AS (SELECT t.model_id, t.batch_id, g.version, g.bias
      FROM t ASOF LEFT JOIN g ON t.model_id = g.model_id AND t.ts >= g.update_time)"""

ORACLES["asof_model"] = f"WITH {ASOF} SELECT model_id, batch_id, version FROM v"

ORACLES["loss_gated_lookup"] = f"""
WITH {REGISTRY}, newest AS (SELECT * FROM g QUALIFY row_number() OVER (PARTITION BY model_id ORDER BY version DESC) = 1),
q AS (SELECT event_id, user_id % 12 AS model_id, value AS asked FROM events)
SELECT event_id, q.model_id,
       CASE WHEN version IS NULL THEN 'unknown' WHEN asked < loss THEN 'refused' ELSE 'found' END AS status,
       CASE WHEN asked >= loss THEN version END AS version
FROM q LEFT JOIN newest ON q.model_id = newest.model_id"""

ORACLES["reject_duplicates"] = """
WITH q AS (SELECT event_id AS request_id, 'Supplier#' || lpad(CAST(user_id * 2 AS VARCHAR), 9, '0') AS name FROM events)
SELECT request_id, name, row_number() OVER (PARTITION BY name ORDER BY request_id) = 1
       AND name NOT IN (SELECT s_name FROM supplier) AS accepted
FROM q"""

NAMES = "q AS (SELECT event_id, 'Supplier#' || lpad(CAST(user_id * 3 AS VARCHAR), 9, '0') AS name FROM events)"

ORACLES["withdraw"] = f"""
WITH {NAMES} SELECT s_suppkey AS model_id, s_name AS name FROM supplier WHERE s_name NOT IN (SELECT name FROM q)"""

ORACLES["withdraw_status"] = f"""
WITH {NAMES} SELECT event_id, name, name IN (SELECT s_name FROM supplier) AS status FROM q"""

ORACLES["publish"] = f"""
WITH {REGISTRY}, newest AS (SELECT model_id, max(version) AS version FROM g GROUP BY 1)
SELECT model_id, version, epoch_us(update_time) AS update_time, loss, 4 AS n FROM g
UNION ALL
SELECT user_id % 12, coalesce(version, 0) + row_number() OVER (PARTITION BY user_id % 12 ORDER BY ts, value), epoch_us(ts), value, 1
FROM events LEFT JOIN newest ON user_id % 12 = model_id"""

ORACLES["current_models"] = f"""
WITH {REGISTRY}
SELECT model_id, max(version) AS version, count(*) AS num_push, epoch_us(arg_max(update_time, version)) AS update_time,
       arg_max(loss, version) AS loss
FROM g GROUP BY model_id"""

ORACLES["weight_change"] = f"""
WITH {REGISTRY}
SELECT model_id, version, round(distance, 6) AS distance, coalesce(distance > 0, false) AS changed FROM c"""

ORACLES["list_models"] = f"""
WITH {REGISTRY}, newest AS (SELECT * FROM g QUALIFY row_number() OVER (PARTITION BY model_id ORDER BY version DESC) = 1),
q AS (SELECT *, make_timestamp((1704067200 + s_suppkey * 3600) * 1000000) AS created FROM supplier)
SELECT s_name AS name, 'ami' || s_suppkey || ',ami' || (s_suppkey + 1) || ',ami' || (s_suppkey + 2) AS streams,
       s_suppkey % 3 <> 0 AS train, strftime(created, '%Y-%m-%d %H:%M') AS deployed_at,
       strftime(coalesce(update_time, created), '%Y-%m-%d %H:%M') AS updated_at, coalesce(loss, 100.0) AS loss
FROM q LEFT JOIN newest ON s_suppkey = model_id"""

ORACLES["count_by_state"] = """
SELECT 'pause' AS state, count(*) FILTER (WHERE s_suppkey % 5 = 0) AS models FROM supplier
UNION ALL SELECT 'deploy', count(*) FILTER (WHERE s_suppkey % 5 <> 0) FROM supplier"""

ORACLES["score"] = f"""
WITH {SCORED} SELECT model_id, batch_id, stream_id, k, round(pred, 6) AS pred, "true" FROM s"""

ORACLES["score_two_outputs"] = f"""
WITH {LINES}, {lookback(4, 2)}
SELECT stream_id, k, round(0.1 * x[1] + 0.2 * x[2] + 0.3 * x[3] + 0.4 * x[4] + 1, 6) AS pred0,
       round(0.4 * x[1] + 0.3 * x[2] + 0.2 * x[3] + 0.1 * x[4] - 1, 6) AS pred1
FROM w"""

ORACLES["score_versions"] = f"""
WITH {ASOF}
SELECT model_id, batch_id, stream_id, k, version, round((x[1] + x[2] + x[3]) / 3 + bias, 6) AS pred
FROM s JOIN v USING (model_id, batch_id) WHERE version IS NOT NULL"""

ORACLES["one_step_rmse"] = f"""
WITH {DOCUMENTS} SELECT model_id, batch_id, stream_id, round(loss, 6) AS loss FROM d"""

ORACLES["one_step_rmse_model"] = f"""
WITH {SCORED}, {errors("batch_id, stream_id, pos", "model_id")}
SELECT model_id, batch_id, stream_id, round(loss, 6) AS loss FROM d"""

ORACLES["rolling_loss"] = f"""
WITH {ROLLED}
SELECT model_id, batch_id, stream_id, round(loss, 6) AS loss, round(average_loss, 6) AS average_loss FROM a"""

ORACLES["result_documents"] = f"""
WITH {DOCUMENTS}
SELECT model_id, batch_id, stream_id, epoch_us(ts) AS ts, round(loss, 6) AS loss, generate_subscripts(preds, 1) - 1 AS i,
       round(unnest(preds), 6) AS pred, unnest(trues) AS "true"
FROM d"""

ORACLES["losses"] = f"""
WITH {LEARNING}, q AS (SELECT model_id, 0.5 * x[1] + 0.25 * x[2] + 0.1 - y[1] AS miss FROM l)
SELECT model_id, round(avg(miss * miss), 6) AS mse, round(avg(abs(miss)), 6) AS mae FROM q GROUP BY model_id"""

ORACLES["gradient"] = f"""
WITH {LEARNING_BATCHES}, {gradients("lb", "model_id, batch_id", "q")}
SELECT model_id, batch_id, p, round(g, 6) AS g FROM q"""

ORACLES["fit_epochs"] = f"""
WITH {LEARNING},
st AS (
  SELECT model_id, avg(x[1] * x[1]) AS a11, avg(x[1] * x[2]) AS a12, avg(x[1]) AS a13, avg(x[2] * x[2]) AS a22,
         avg(x[2]) AS a23, avg(x[1] * y[1]) AS b1, avg(x[2] * y[1]) AS b2, avg(y[1]) AS b3, avg(y[1] * y[1]) AS yy
  FROM l GROUP BY model_id),
e1 AS (
  SELECT *, 0.5 - 0.1 * (0.5 * a11 + 0.25 * a12 + 0.1 * a13 - b1) AS w1, 0.25 - 0.1 * (0.5 * a12 + 0.25 * a22 + 0.1 * a23 - b2) AS w2,
         0.1 - 0.1 * (0.5 * a13 + 0.25 * a23 + 0.1 - b3) AS w3
  FROM st),
e2 AS (
  SELECT model_id, w1 - 0.1 * (w1 * a11 + w2 * a12 + w3 * a13 - b1) AS v1, w2 - 0.1 * (w1 * a12 + w2 * a22 + w3 * a23 - b2) AS v2,
         w3 - 0.1 * (w1 * a13 + w2 * a23 + w3 - b3) AS v3,
         w1 * w1 * a11 + w2 * w2 * a22 + w3 * w3 + 2 * w1 * w2 * a12 + 2 * w1 * w3 * a13 + 2 * w2 * w3 * a23
         - 2 * (w1 * b1 + w2 * b2 + w3 * b3) + yy AS loss
  FROM e1)
SELECT model_id, round(loss, 6) AS loss, p, round(CASE p WHEN 0 THEN v1 WHEN 1 THEN v2 ELSE v3 END, 6) AS w
FROM e2, range(3) t(p)"""

ORACLES["ring_memory"] = f"""
WITH {LEARNING}
SELECT model_id, stream_id, k FROM l
QUALIFY row_number() OVER (PARTITION BY model_id, stream_id ORDER BY t_end DESC, k DESC) <= 10"""

ORACLES["ring_memory_reset"] = f"""
WITH RECURSIVE {LEARNING_BATCHES},
sizes AS (
  SELECT model_id, stream_id, batch_id, count(*) AS size,
         row_number() OVER (PARTITION BY model_id, stream_id ORDER BY batch_id) AS i
  FROM lb GROUP BY 1, 2, 3),
steps AS (
  SELECT model_id, stream_id, i, CASE WHEN size >= 50 THEN 0 ELSE size END AS filled, CASE WHEN size >= 50 THEN batch_id ELSE -1 END AS reset
  FROM sizes WHERE i = 1
  UNION ALL
  SELECT s.model_id, s.stream_id, s.i, CASE WHEN p.filled + s.size >= 50 THEN 0 ELSE p.filled + s.size END,
         CASE WHEN p.filled + s.size >= 50 THEN s.batch_id ELSE p.reset END
  FROM steps p JOIN sizes s ON s.model_id = p.model_id AND s.stream_id = p.stream_id AND s.i = p.i + 1),
final AS (SELECT * FROM steps QUALIFY row_number() OVER (PARTITION BY model_id, stream_id ORDER BY i DESC) = 1)
SELECT lb.model_id, lb.stream_id, lb.k
FROM lb JOIN final ON lb.model_id = final.model_id AND lb.stream_id = final.stream_id AND lb.batch_id > final.reset"""

ORACLES["similarity_memory"] = f"WITH {similar(10)} SELECT stream_id, k FROM kept"

ORACLES["variance_gate"] = f"""
WITH {similar(20)},
old AS (SELECT stream_id, v FROM sim QUALIFY row_number() OVER (PARTITION BY stream_id ORDER BY k DESC) <= 20),
a AS (SELECT stream_id, var_pop(q) AS memory_variance FROM (SELECT stream_id, unnest(v) AS q FROM old) GROUP BY 1),
b AS (SELECT stream_id, var_pop(q) AS candidate_variance FROM (SELECT stream_id, unnest(v) AS q FROM kept) GROUP BY 1)
SELECT stream_id, round(memory_variance, 6) AS memory_variance, round(candidate_variance, 6) AS candidate_variance,
       memory_variance < candidate_variance AS accepted
FROM a JOIN b USING (stream_id)"""

ORACLES["memory_gradients"] = f"""
WITH {CURRENT} SELECT model_id, stream_id, p, round(g, 6) AS g FROM mg"""

ORACLES["conflicts"] = f"""
WITH {CURRENT}
SELECT mg.model_id, mg.stream_id, round(sum(mg.g * cur.g), 6) AS dot, sum(mg.g * cur.g) < 0 AS conflict
FROM mg JOIN cur ON mg.model_id = cur.model_id AND mg.p = cur.p GROUP BY 1, 2"""

ORACLES["project_gradient_average"] = f"""
WITH {CURRENT}, av AS (SELECT model_id, p, avg(g) AS m FROM mg GROUP BY 1, 2),
q AS (SELECT model_id, p, g, m, sum(g * m) OVER (PARTITION BY model_id) AS gm, sum(m * m) OVER (PARTITION BY model_id) AS mm
      FROM cur JOIN av USING (model_id, p))
SELECT model_id, p, round(CASE WHEN gm < 0 THEN g - gm / mm * m ELSE g END, 6) AS g FROM q"""

# Newton's method for the shift u = sum of v * (a, b, c) over the streams, where v is the larger of the margin and -slope / ridge.
ORACLES["project_gradient_exact"] = f"""
WITH RECURSIVE {CURRENT},
now AS (SELECT model_id, max(g) FILTER (WHERE p = 0) AS g1, max(g) FILTER (WHERE p = 1) AS g2, max(g) FILTER (WHERE p = 2) AS g3 FROM cur GROUP BY 1),
past AS (
  SELECT model_id, stream_id, max(g) FILTER (WHERE p = 0) AS a, max(g) FILTER (WHERE p = 1) AS b, max(g) FILTER (WHERE p = 2) AS c
  FROM mg GROUP BY 1, 2),
turned AS (SELECT DISTINCT model_id FROM past JOIN now USING (model_id) WHERE a * g1 + b * g2 + c * g3 < 0),
step AS (
  SELECT model_id, 0 AS i, CAST(0 AS DOUBLE) AS u1, CAST(0 AS DOUBLE) AS u2, CAST(0 AS DOUBLE) AS u3 FROM turned
  UNION ALL
  SELECT model_id, i + 1,
         u1 - ((h22 * h33 - h23 * h23) * r1 + (h13 * h23 - h12 * h33) * r2 + (h12 * h23 - h13 * h22) * r3) / det,
         u2 - ((h13 * h23 - h12 * h33) * r1 + (h11 * h33 - h13 * h13) * r2 + (h12 * h13 - h11 * h23) * r3) / det,
         u3 - ((h12 * h23 - h13 * h22) * r1 + (h12 * h13 - h11 * h23) * r2 + (h11 * h22 - h12 * h12) * r3) / det
  FROM (SELECT *, h11 * (h22 * h33 - h23 * h23) - h12 * (h12 * h33 - h13 * h23) + h13 * (h12 * h23 - h13 * h22) AS det FROM (
    SELECT model_id, i, u1, u2, u3, u1 - sum(v * a) AS r1, u2 - sum(v * b) AS r2, u3 - sum(v * c) AS r3,
           1 + sum(f * a * a) AS h11, sum(f * a * b) AS h12, sum(f * a * c) AS h13, 1 + sum(f * b * b) AS h22, sum(f * b * c) AS h23,
           1 + sum(f * c * c) AS h33
    FROM (
      SELECT *, greatest(0.5, slope / -0.001) AS v, CASE WHEN slope / -0.001 > 0.5 THEN 1000.0::DOUBLE ELSE 0 END AS f FROM (
        SELECT step.*, a, b, c, a * (g1 + u1) + b * (g2 + u2) + c * (g3 + u3) AS slope
        FROM step JOIN past USING (model_id) JOIN now USING (model_id)))
    GROUP BY model_id, i, u1, u2, u3))
  WHERE i < 50),
shift AS (SELECT model_id, u1, u2, u3 FROM step WHERE i = 50)
SELECT model_id, p, round(g + coalesce(CASE p WHEN 0 THEN u1 WHEN 1 THEN u2 ELSE u3 END, 0), 6) AS g
FROM cur LEFT JOIN shift USING (model_id)"""

ORACLES["apply_update"] = f"""
WITH {CURRENT}
SELECT model_id, p, round(CASE p WHEN 0 THEN 0.5 WHEN 1 THEN 0.25 ELSE 0.1 END - 0.05 * g, 6) AS w FROM cur"""

ORACLES["promotion_gate"] = """
WITH q AS (
  SELECT user_id % 10 AS model_id, event_id AS batch_id,
         CASE WHEN count(*) OVER latest = 9 THEN avg(value) OVER latest END AS mean_loss
  FROM events
  WINDOW latest AS (PARTITION BY user_id % 10 ORDER BY event_id ROWS BETWEEN 8 PRECEDING AND CURRENT ROW)),
b AS (SELECT *, min(mean_loss) OVER (PARTITION BY model_id ORDER BY batch_id ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING) AS best FROM q)
SELECT model_id, batch_id, round(mean_loss, 6) AS mean_loss, coalesce(mean_loss < least(10000, best), false) AS publish FROM b"""

ORACLES["promotion_gate_varying"] = """
WITH RECURSIVE q AS (
  SELECT user_id % 10 AS model_id, event_id AS batch_id, row_number() OVER w AS i,
         sum(1 + event_id % 50) OVER w AS rows_seen, sum(value) OVER w AS loss_seen
  FROM events WINDOW w AS (PARTITION BY user_id % 10 ORDER BY event_id)),
q0 AS (SELECT model_id, i, rows_seen, loss_seen FROM q UNION ALL SELECT DISTINCT model_id, 0, 0, 0 FROM q),
steps AS (
  SELECT model_id, CAST(0 AS BIGINT) AS i, CAST(0 AS BIGINT) AS dropped, CAST(NULL AS DOUBLE) AS mean_loss FROM q WHERE i = 1
  UNION ALL
  SELECT p.model_id, n.i, CASE WHEN n.rows_seen - o.rows_seen >= 288 THEN p.dropped + 1 ELSE p.dropped END,
         CASE WHEN n.rows_seen - o.rows_seen >= 288 THEN (n.loss_seen - o.loss_seen) / (n.i - p.dropped) END
  FROM steps p JOIN q0 n ON n.model_id = p.model_id AND n.i = p.i + 1
  JOIN q0 o ON o.model_id = p.model_id AND o.i = p.dropped),
b AS (SELECT *, min(mean_loss) OVER (PARTITION BY model_id ORDER BY i ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING) AS best FROM steps)
SELECT q.model_id, q.batch_id, round(mean_loss, 6) AS mean_loss, coalesce(mean_loss < least(10000, best), false) AS publish
FROM q JOIN b USING (model_id, i)"""

ORACLES["series"] = f"""
WITH {RESULTS}
SELECT model_id, stream_id, seq, generate_subscripts(preds, 1) - 1 AS pos, round(unnest(preds), 6) AS pred, unnest(trues) AS "true",
       round(loss, 6) AS loss, round(average_loss, 6) AS average_loss, epoch_us(ts) AS ts
FROM z WHERE preds IS NOT NULL"""

ORACLES["update_markers"] = f"""
WITH {RESULTS}
SELECT model_id, stream_id, seq, generate_subscripts(preds, 1) - 1 AS pos, round(unnest(preds), 6) AS pred,
       round(loss, 6) AS loss, epoch_us(ts) AS ts, false AS is_update
FROM z WHERE preds IS NOT NULL
UNION ALL
SELECT z.model_id, u.stream_id, seq, 0, -1, -1, epoch_us(updated_at), true
FROM z JOIN (SELECT DISTINCT user_id AS stream_id FROM events) u ON u.stream_id % 10 = z.model_id WHERE updated_at IS NOT NULL"""

MAXIMA = """round(greatest(0, max(greatest(list_max(preds), list_max(trues)))), 6) AS max_value,
       round(greatest(0, max(loss)), 6) AS max_loss, round(greatest(0, max(average_loss)), 6) AS max_average_loss"""

ORACLES["axis_maxima"] = f"""
WITH {RESULTS} SELECT model_id, count(*) AS documents, {MAXIMA} FROM z GROUP BY model_id"""

ORACLES["new_since"] = f"""
WITH {RESULTS}
SELECT model_id, seq, stream_id, round(loss, 6) AS loss
FROM (SELECT *, count(*) OVER (PARTITION BY model_id) // 2 AS origin FROM z) WHERE seq >= origin"""

ORACLES["new_counts"] = f"""
WITH {RESULTS}
SELECT model_id, 100 AS origin_count, count(*) FILTER (WHERE seq >= 100) AS new_count, count(*) AS all_count
FROM z GROUP BY model_id"""

ORACLES["merge_maxima"] = ORACLES["axis_maxima"]

ORACLES["latest_points"] = f"""
WITH {RESULTS}, p AS (
  SELECT model_id, stream_id, seq, generate_subscripts(preds, 1) - 1 AS pos, unnest(preds) AS pred, unnest(trues) AS "true"
  FROM z WHERE preds IS NOT NULL)
SELECT model_id, stream_id, seq, pos, round(pred, 6) AS pred, "true" FROM p
QUALIFY row_number() OVER (PARTITION BY model_id, stream_id ORDER BY seq DESC, pos DESC) <= 20"""


SLICED = """span AS (SELECT min(epoch_us(ts)) AS lo, max(epoch_us(ts)) AS hi FROM events)"""


def slice_of(column: str) -> str:
    return f"CAST((epoch_us({column}) - lo) * 3 // (hi - lo + 1) AS BIGINT)"


ORACLES["lookback_windows_stream"] = ORACLES["lookback_windows"]
ORACLES["training_windows_stream"] = ORACLES["sink_source_windows"]
ORACLES["windows_job"] = ORACLES["training_windows"]

def inference(size: int, shift: int, models: str) -> str:
    """Documents of the job for the models of one window shape."""
    mean = " + ".join(f"x[{i + 1}]" for i in range(size))
    return f"""
WITH {READINGS}, {lookback(size, shift)}, {SLICED}, b AS (
  SELECT *, (place - 1) // 3 + run * {PER_TICK} AS batch_id, (place - 1) % 3 AS pos FROM (
    SELECT *, row_number() OVER (PARTITION BY model_id, run ORDER BY t_end, stream_id, k) AS place FROM (
      SELECT w.*, stream_id % 10 AS model_id, {slice_of("t_end")} AS run FROM w, span) WHERE {models})),
s AS (SELECT *, ({mean}) / {size} AS pred, x[{size}] AS "true" FROM b), {errors('k', 'model_id, stream_id')}, a AS (
  SELECT d.*, CASE WHEN loss IS NOT NULL THEN avg(loss) OVER (
    PARTITION BY model_id, stream_id, loss IS NULL ORDER BY batch_id ROWS BETWEEN 2 PRECEDING AND CURRENT ROW)
  END AS average_loss FROM d)
SELECT model_id, row_number() OVER (PARTITION BY model_id ORDER BY batch_id, stream_id) - 1 AS seq, batch_id, stream_id, n,
       epoch_us(ts) AS ts, round(loss, 6) AS loss, round(average_loss, 6) AS average_loss
FROM a"""


ORACLES["inference_job"] = inference(3, 1, "true")

ORACLES["inference_job_shapes"] = f"""
SELECT * FROM ({inference(3, 1, "model_id % 2 = 0")}) UNION ALL SELECT * FROM ({inference(2, 2, "model_id % 2 = 1")})"""


def training_step(b: int) -> str:
    """Parameters after micro-batch ``b``: a gradient step, turned away from the mean memory gradient."""

    def grads(source: str, keys: str, name: str) -> str:
        return f"""{name} AS (
  SELECT {keys}, q, avg(2 * (w1 * x[1] + w2 * x[2] + w3 - y[1]) * CASE q WHEN 1 THEN x[1] WHEN 2 THEN x[2] ELSE 1 END) AS g
  FROM {source} JOIN p{b} USING (model_id), (SELECT unnest([1, 2, 3]) AS q) GROUP BY {keys}, q)"""

    return f"""now{b} AS (SELECT * FROM arrived WHERE run = {b}),
{grads(f"now{b}", "model_id", f"g{b}")},
held{b} AS (SELECT * FROM arrived WHERE run < {b}
  QUALIFY row_number() OVER (PARTITION BY model_id, stream_id ORDER BY t_end DESC, k DESC) <= 4),
{grads(f"held{b}", "model_id, stream_id", f"h{b}")},
m{b} AS (SELECT model_id, q, avg(g) AS m FROM h{b} GROUP BY 1, 2),
d{b} AS (SELECT model_id, q, g, m, sum(g * m) OVER (PARTITION BY model_id) AS gm, sum(m * m) OVER (PARTITION BY model_id) AS mm
  FROM g{b} LEFT JOIN m{b} USING (model_id, q)),
t{b} AS (SELECT model_id, q, 0.05 * CASE WHEN gm < 0 THEN g - gm / mm * m ELSE g END AS move FROM d{b}),
p{b + 1} AS (
  SELECT model_id, w1 - max(move) FILTER (WHERE q = 1) AS w1, w2 - max(move) FILTER (WHERE q = 2) AS w2,
         w3 - max(move) FILTER (WHERE q = 3) AS w3
  FROM p{b} JOIN t{b} USING (model_id) GROUP BY model_id, w1, w2, w3),
l{b} AS (SELECT model_id, avg((w1 * x[1] + w2 * x[2] + w3 - y[1]) ** 2) AS loss, count(*) AS held
  FROM now{b} JOIN p{b + 1} USING (model_id) GROUP BY 1),
o{b} AS (
  SELECT model_id, CAST({b} AS BIGINT) AS batch_id, stream_id, count(*) AS n, max(w1 * x[1] + w2 * x[2] + w3) AS top
  FROM now{b} JOIN p{b} USING (model_id) GROUP BY model_id, stream_id)"""


ORACLES["continual_job"] = f"""
WITH RECURSIVE {LEARNING}, {SLICED},
arrived AS (SELECT l.*, {slice_of("t_end")} AS run FROM l, span),
p0 AS (SELECT DISTINCT model_id, CAST(0.5 AS DOUBLE) AS w1, CAST(0.25 AS DOUBLE) AS w2, CAST(0.1 AS DOUBLE) AS w3 FROM l),
{training_step(0)},
{training_step(1)},
{training_step(2)},
spent AS (
  SELECT *, sum(held) OVER (PARTITION BY model_id ORDER BY i) AS rows_seen, sum(loss) OVER (PARTITION BY model_id ORDER BY i) AS loss_seen
  FROM (SELECT model_id, 0 AS i, 0 AS held, 0 AS loss FROM p0 UNION ALL SELECT model_id, 1, held, loss FROM l0
        UNION ALL SELECT model_id, 2, held, loss FROM l1 UNION ALL SELECT model_id, 3, held, loss FROM l2)),
steps AS (
  SELECT model_id, 0 AS i, 0 AS dropped, CAST(NULL AS DOUBLE) AS mean_loss FROM p0
  UNION ALL
  SELECT s.model_id, n.i, CASE WHEN n.rows_seen - o.rows_seen >= 288 THEN s.dropped + 1 ELSE s.dropped END,
         CASE WHEN n.rows_seen - o.rows_seen >= 288 THEN (n.loss_seen - o.loss_seen) / (n.i - s.dropped) END
  FROM steps s JOIN spent n ON n.model_id = s.model_id AND n.i = s.i + 1
  JOIN spent o ON o.model_id = s.model_id AND o.i = s.dropped),
published AS (
  SELECT model_id, i - 1 AS batch_id FROM (
    SELECT *, min(mean_loss) OVER (PARTITION BY model_id ORDER BY i ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING) AS best FROM steps)
  WHERE mean_loss < least(10000, best)),
written AS (
  SELECT o0.*, loss FROM o0 JOIN l0 USING (model_id) UNION ALL SELECT o1.*, loss FROM o1 JOIN l1 USING (model_id)
  UNION ALL SELECT o2.*, loss FROM o2 JOIN l2 USING (model_id)
  UNION ALL SELECT model_id, batch_id, NULL, NULL, NULL, NULL FROM published)
SELECT model_id, row_number() OVER (PARTITION BY model_id ORDER BY batch_id, stream_id NULLS LAST) - 1 AS seq, batch_id, stream_id, n,
       round(top, 6) AS top, round(loss, 6) AS loss
FROM written"""


def slopes(name: str) -> str:
    """Means of the derivatives of the squared error by the three parameters."""
    miss = "2 * (w1 * x[1] + w2 * x[2] + w3 - y[1])"
    return f"avg({miss} * x[1]) AS {name}1, avg({miss} * x[2]) AS {name}2, avg({miss}) AS {name}3"


ORACLES["continual_job_batches"] = f"""
WITH RECURSIVE {LEARNING},
placed AS (
  SELECT *, (row_number() OVER (PARTITION BY model_id ORDER BY t_end, stream_id, k) - 1) // 80 AS b,
         count(*) OVER (PARTITION BY model_id) // 80 AS whole FROM l),
filled AS (SELECT * FROM placed WHERE b < whole),
held AS (
  SELECT n.b AS turn, f.* FROM (SELECT DISTINCT model_id, b FROM filled) n JOIN filled f ON f.model_id = n.model_id AND f.b < n.b
  QUALIFY row_number() OVER (PARTITION BY f.model_id, n.b, f.stream_id ORDER BY f.t_end DESC, f.k DESC) <= 4),
p AS (
  SELECT DISTINCT model_id, CAST(0 AS BIGINT) AS b, CAST(0.5 AS DOUBLE) AS w1, CAST(0.25 AS DOUBLE) AS w2, CAST(0.1 AS DOUBLE) AS w3
  FROM filled
  UNION ALL
  SELECT model_id, b + 1, w1 - 0.05 * (g1 - part * m1), w2 - 0.05 * (g2 - part * m2), w3 - 0.05 * (g3 - part * m3)
  FROM (
    SELECT model_id, b, w1, w2, w3, g1, g2, g3, coalesce(m1, 0) AS m1, coalesce(m2, 0) AS m2, coalesce(m3, 0) AS m3,
           CASE WHEN g1 * m1 + g2 * m2 + g3 * m3 < 0
             THEN (g1 * m1 + g2 * m2 + g3 * m3) / (m1 * m1 + m2 * m2 + m3 * m3) ELSE 0 END AS part
    FROM (SELECT p.model_id, p.b, w1, w2, w3, {slopes("g")} FROM p JOIN filled f ON f.model_id = p.model_id AND f.b = p.b GROUP BY ALL)
    LEFT JOIN (
      SELECT model_id, b, avg(h1) AS m1, avg(h2) AS m2, avg(h3) AS m3 FROM (
        SELECT p.model_id, p.b, stream_id, {slopes("h")} FROM p JOIN held h ON h.model_id = p.model_id AND h.turn = p.b
        GROUP BY p.model_id, p.b, stream_id) GROUP BY model_id, b) USING (model_id, b))),
losses AS (
  SELECT f.model_id, f.b, avg((w1 * x[1] + w2 * x[2] + w3 - y[1]) ** 2) AS loss
  FROM filled f JOIN p ON p.model_id = f.model_id AND p.b = f.b + 1 GROUP BY ALL),
-- batches of equal size: after the fourth one (320 windows) every batch looks at the mean of the last four
looked AS (
  SELECT *, CASE WHEN b >= 3 THEN avg(loss) OVER (PARTITION BY model_id ORDER BY b ROWS BETWEEN 3 PRECEDING AND CURRENT ROW) END AS mean_loss
  FROM losses),
published AS (
  SELECT model_id, b FROM (
    SELECT *, min(mean_loss) OVER (PARTITION BY model_id ORDER BY b ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING) AS best FROM looked)
  WHERE mean_loss < least(10000, best)),
written AS (
  SELECT f.model_id, f.b AS batch_id, stream_id, count(*) AS n, max(w1 * x[1] + w2 * x[2] + w3) AS top, any_value(loss) AS loss
  FROM filled f JOIN p USING (model_id, b) JOIN losses USING (model_id, b) GROUP BY ALL
  UNION ALL SELECT model_id, b, NULL, NULL, NULL, NULL FROM published)
SELECT model_id, row_number() OVER (PARTITION BY model_id ORDER BY batch_id, stream_id NULLS LAST) - 1 AS seq, batch_id, stream_id, n,
       round(top, 6) AS top, round(loss, 6) AS loss
FROM written"""

ORACLES["summary_job"] = ORACLES["axis_maxima"]

"""The same results in SQL, for DuckDB over the same files."""

from __future__ import annotations

from flowsight.checks import views as V
from flowsight.checks.jobs import VERSION_FACTOR, VERSION_FROM
from flowsight.checks.queries import (
    FEATURE_BYTES,
    FEATURE_SHARDS,
    REQUEST_BYTES,
    REQUEST_WINDOW,
    SHARDS,
    TOKEN_KEY,
)
from flowsight.schemas import FLOW_LOG, TRANSACTION, VECTOR_COLUMNS

FLOW = V.duck(V.FLOW, "events")
INJECTED = V.duck(V.FLOW_INJECTED, "events")
LINES = f"WITH f AS ({FLOW}) {V.duck(V.LINES, 'f')}"
TRANSACTIONS = V.duck(V.TRANSACTIONS, "orders")

FLOW_NAMES = ", ".join(FLOW_LOG.fieldNames())
KEYS = "subscriber_id, dst_subnet, transaction_time"
VECTOR = ", ".join(VECTOR_COLUMNS)
MODEL = "step, type, amount, oldbalanceOrg, newbalanceOrig, oldbalanceDest, newbalanceDest, transactionId"

_OCTET = "(25[0-5]|2[0-4][0-9]|1[0-9][0-9]|[1-9]?[0-9])"
IPV4 = rf"{_OCTET}\.{_OCTET}\.{_OCTET}\.{_OCTET}"


def _ok(ip: str) -> str:
    return f"coalesce(regexp_full_match({ip}, '{IPV4}'), false)"


def _ip_number(ip: str) -> str:
    parts = [f"CAST(split_part({ip}, '.', {i}) AS BIGINT)" for i in range(1, 5)]
    return " + ".join(f"{p} * {m}" for p, m in zip(parts, (16777216, 65536, 256, 1)))


def _network(ip: str, bits: int) -> str:
    block = 1 << (32 - bits)
    base = f"((({_ip_number(ip)}) // {block}) * {block})"
    text = " || '.' || ".join(
        f"CAST(({base} // {d}) % 256 AS VARCHAR)" for d in (16777216, 65536, 256, 1)
    )
    return f"{text} || '/{bits}'"


_FIELD = "json_extract_string(line, '$.{}')".format


def _safe(lines: str) -> str:
    whole = (
        "CASE WHEN json_type(line) = 'OBJECT' AND NOT (json_extract_string(line, '$.srcPort') IS NOT NULL "
        "AND TRY_CAST(json_extract_string(line, '$.srcPort') AS INT) IS NULL) THEN line END"
    )
    return f"SELECT *, CASE WHEN json_valid(line) THEN {whole} END AS good FROM ({lines})"


_SAFE = _safe(LINES)
_STATUS = (
    "CASE WHEN good IS NULL THEN 'bad_json' "
    "WHEN json_extract_string(good, '$.srcIP') IS NULL OR json_extract_string(good, '$.dstIP') IS NULL THEN 'missing_ip' "
    f"WHEN NOT ({_ok(_FIELD('srcIP').replace('line', 'good'))} AND {_ok(_FIELD('dstIP').replace('line', 'good'))}) "
    "THEN 'bad_ip' ELSE 'ok' END"
)
STATUS = f"SELECT *, {_STATUS} AS status FROM ({_SAFE})"


def _typed_fields() -> str:
    kinds = {"int": "INTEGER", "bigint": "BIGINT", "string": "VARCHAR"}
    return ", ".join(
        f"CAST({_FIELD(f.name)} AS {kinds[f.dataType.simpleString()]}) AS {f.name}"
        for f in FLOW_LOG
    )


GEO = (
    f"SELECT f.event_id, f.srcIP, g.geoCountry, g.geoCity, g.latitude, g.longitude FROM ({FLOW}) f "
    f"LEFT JOIN ({V.duck(V.GEO, 'nation JOIN region ON n_regionkey = r_regionkey')}) g "
    f"ON {_ip_number('f.srcIP')} BETWEEN g.start_ip AND g.end_ip"
)

_INJECTED_FEATURES = V.features_sql(INJECTED)


def _valid_flows(source: str) -> str:
    lines = f"WITH f AS ({source}) {V.duck(V.LINES, 'f')}"
    return (
        f"SELECT event_id, event_ts, {_typed_fields()} FROM "
        f"(SELECT *, {_STATUS} AS status FROM ({_safe(lines)})) WHERE status = 'ok'"
    )


# the job sees the injected lines, without the rejected ones
_JOB_FEATURES = V.features_sql(_valid_flows(INJECTED))
_COUNTS = "number_of_records, number_of_unique_ips, number_of_unique_ports"


def _scored(select: str, **kwargs: object) -> str:
    return f"WITH {V.scored_sql(_INJECTED_FEATURES, **kwargs)} {select}"


_OUTLIER_TAIL = (
    "max_tx_bytes, min_tx_bytes, avg_tx_bytes, max_rx_bytes, min_rx_bytes, avg_rx_bytes, "
    "max_duration, min_duration, avg_duration, centroid_id FROM scored WHERE spread > 2.0 * normalized_dest"
)


def _step(name: str, rows: str, centres: str) -> str:
    """CTEs of one assign-and-update step: <name>_near and <name>."""
    squares = " + ".join(f"power(f.{c} - c.{c}, 2)" for c in VECTOR_COLUMNS)
    means = ", ".join(f"avg({c}) AS {c}" for c in VECTOR_COLUMNS)
    return (
        f"{name}_near AS (SELECT f.*, c.centroid_id, sqrt({squares}) AS distance FROM {rows} f CROSS JOIN {centres} c "
        f"QUALIFY row_number() OVER (PARTITION BY {', '.join('f.' + k for k in KEYS.split(', '))} "
        "ORDER BY distance, c.centroid_id) = 1), "
        f"{name} AS (SELECT centroid_id, {means} FROM {name}_near GROUP BY 1)"
    )


def hash32_sql(key: str, seed: int | str) -> str:
    return f"CAST('0x' || substr(md5('{seed}:' || {key}), 1, 8) AS BIGINT)"


_JSON = f"to_json(struct_pack({', '.join(f'{c} := {c}' for c in MODEL.split(', '))}))"
_REQUESTS = f"""WITH RECURSIVE t AS ({TRANSACTIONS}),
sized AS (SELECT transactionId, o_orderkey, o_orderkey % {SHARDS} AS shard,
  (epoch_us(event_ts) // {REQUEST_WINDOW * 1_000_000}) * {REQUEST_WINDOW * 1_000_000} AS window_start,
  strlen(CAST({_JSON} AS VARCHAR)) AS size FROM t),
ranked AS (SELECT *, row_number() OVER (PARTITION BY window_start, shard ORDER BY o_orderkey) AS rn FROM sized),
packed AS (
  SELECT transactionId, shard, window_start, rn, size, size AS filled, CAST(0 AS BIGINT) AS batch_id FROM ranked WHERE rn = 1
  UNION ALL
  SELECT r.transactionId, r.shard, r.window_start, r.rn, r.size,
    CASE WHEN p.filled > 0 AND p.filled + r.size > {REQUEST_BYTES} THEN r.size ELSE p.filled + r.size END,
    p.batch_id + CASE WHEN p.filled > 0 AND p.filled + r.size > {REQUEST_BYTES} THEN 1 ELSE 0 END
  FROM packed p JOIN ranked r ON r.window_start = p.window_start AND r.shard = p.shard AND r.rn = p.rn + 1)
"""

_FEATURE_BATCHES = f"""WITH RECURSIVE f AS ({V.features_sql(FLOW)}),
sized AS (SELECT {KEYS}, {hash32_sql("subscriber_id || '|' || dst_subnet || '|' || transaction_time", 0)} % {FEATURE_SHARDS} AS shard,
  strlen(subscriber_id) + strlen(dst_subnet) + strlen(transaction_time) + strlen(CAST(number_of_records AS VARCHAR)) AS size FROM f),
ranked AS (SELECT *, row_number() OVER (PARTITION BY transaction_time, shard ORDER BY subscriber_id, dst_subnet) AS rn FROM sized),
packed AS (
  SELECT *, size AS filled, CAST(0 AS BIGINT) AS batch_id FROM ranked WHERE rn = 1
  UNION ALL
  SELECT r.*, CASE WHEN p.filled + r.size > {FEATURE_BYTES} THEN r.size ELSE p.filled + r.size END,
    p.batch_id + CASE WHEN p.filled + r.size > {FEATURE_BYTES} THEN 1 ELSE 0 END
  FROM packed p JOIN ranked r ON r.transaction_time = p.transaction_time AND r.shard = p.shard AND r.rn = p.rn + 1)
SELECT {KEYS}, shard, batch_id FROM packed"""

_LOGISTIC = "1.0 / (1.0 + exp(-((amount - 300000.0) / 10000.0 - CASE WHEN newbalanceOrig = 0 THEN 0.0 ELSE 20.0 END)))"
RULE = f"SELECT *, {_LOGISTIC} AS logistic FROM ({TRANSACTIONS})"
_CALL = "CAST(round_even(logistic, 0) AS INT)"


def _digest_number(slot: int) -> str:
    return f"CAST('0x' || substr(d, {1 + 8 * slot}, 8) AS BIGINT)"


def _between(slot: int, low: int, high: int) -> str:
    return f"{low} + {_digest_number(slot)} % {high - low + 1}"


def _ip_text(number: str) -> str:
    return " || '.' || ".join(
        f"CAST((({number}) // {d}) % 256 AS VARCHAR)" for d in (16777216, 65536, 256, 1)
    )


_DIGEST = (
    "SELECT event_id AS id, sha256('7:' || event_id || ':a') || sha256('7:' || event_id || ':b') AS d FROM events"
)
_MONEY = {
    name: f"({_between(slot, 100, 99999900)}) / 100.0::DOUBLE AS {name}"
    for name, slot in (
        ("amount", 6),
        ("oldbalanceOrg", 7),
        ("newbalanceOrig", 8),
        ("oldbalanceDest", 9),
        ("newbalanceDest", 14),
    )
}

_DATED = f"SELECT *, CAST(substr(transaction_time, 1, 10) AS DATE) AS dt FROM ({V.features_sql(FLOW)})"

DAY_FEATURES = V.features_sql(FLOW)

_JOB_OUTLIERS = f"WITH {V.scored_sql(_JOB_FEATURES)} SELECT {KEYS}, {_COUNTS}, {_OUTLIER_TAIL}"
_ALERTS = f"SELECT transactionId, round(logistic, 9) AS logistic FROM ({RULE}) WHERE logistic >= 0.99"

ORACLES: dict[str, str] = {
    "flow_features": DAY_FEATURES,
    "flow_features_minute": V.features_sql(FLOW, 60),
    "flow_features_network_subnet": V.features_sql(FLOW, subnet=_network("dstIP", 22)),
    "flow_features_sketch": DAY_FEATURES,
    "flow_features_sketch_salted": DAY_FEATURES,
    "json_validate_status": f"SELECT event_id, status FROM ({STATUS})",
    "json_rejects": "SELECT line, status, CASE WHEN status = 'bad_json' THEN 'Not a valid JSON record ' "
    f"ELSE 'Not a valid IP address ' END || line AS error FROM ({STATUS}) WHERE status <> 'ok'",
    "json_valid_rows": f"SELECT event_id, {_typed_fields()} FROM ({STATUS}) WHERE status = 'ok'",
    "transaction_status": "SELECT o_orderkey, CASE WHEN NOT json_valid(line) THEN 'bad_json' "
    "WHEN json_type(line) <> 'OBJECT' OR json_extract_string(line, '$.step') = 'x' THEN 'bad_json' ELSE 'ok' END AS status "
    f"FROM (WITH t AS ({TRANSACTIONS}) {V.duck(V.PAYMENT_LINES, 't')})",
    "two_loads_append": "SELECT f.* EXCLUDE (event_id, event_ts), g.geoCountry, g.geoCity, g.latitude, g.longitude "
    f"FROM ({_valid_flows(INJECTED)}) f LEFT JOIN ({V.duck(V.GEO, 'nation JOIN region ON n_regionkey = r_regionkey')}) g "
    f"ON {_ip_number('f.srcIP')} BETWEEN g.start_ip AND g.end_ip",
    "transaction_json_rows": f"SELECT {', '.join(TRANSACTION.fieldNames())} FROM ({TRANSACTIONS})",
    "flow_restamped": f"SELECT event_id, {FLOW_NAMES.replace('startTime, endTime, ', '')}, true AS restamped FROM ({FLOW})",
    "ipv4_predicate": f"SELECT event_id, {_ok(_FIELD('srcIP').replace('line', 'good'))} AS src_ok, "
    f"{_ok(_FIELD('dstIP').replace('line', 'good'))} AS dst_ok FROM ({_SAFE})",
    "ip_to_int": f"SELECT event_id, {_ip_number('srcIP')} AS ip FROM ({FLOW})",
    "subnet_cidr": f"SELECT event_id, dstIP || '/22' AS signature, {_network('dstIP', 22)} AS network, "
    f"{_network('srcIP', 20)} AS src_network FROM ({FLOW})",
    "flow_duration": f"SELECT event_id, CAST(abs(endTime - startTime) AS INT) AS duration FROM ({FLOW})",
    "union_file_and_bus": f"SELECT event_id, {FLOW_NAMES} FROM ({FLOW}) UNION ALL "
    f"SELECT event_id, {FLOW_NAMES} FROM ({INJECTED})",
    "geo_enrich_broadcast": GEO,
    "geo_enrich_bucketed": GEO,
    "feature_vector": f"SELECT {KEYS}, "
    + ", ".join(f"CAST({c} AS DOUBLE) AS v{i}" for i, c in enumerate(VECTOR_COLUMNS))
    + f" FROM ({DAY_FEATURES})",
    "nearest_centroid": _scored(
        f"SELECT {KEYS}, centroid_id, round(distance, 6) AS distance FROM scored"
    ),
    "nearest_centroid_in_code": _scored(
        f"SELECT {KEYS}, centroid_id, round(distance, 6) AS distance FROM scored"
    ),
    "nearest_of_many": f"WITH {V.normalized_sql()}, many AS (SELECT {V.CLUSTER_OF_MANY} AS centroid_id, "
    + ", ".join(f"avg({c}) AS {c}" for c in VECTOR_COLUMNS)
    + " FROM clean GROUP BY 1), near AS (SELECT f.*, c.centroid_id, sqrt("
    + " + ".join(f"power(f.{c} - c.{c}, 2)" for c in VECTOR_COLUMNS)
    + f") AS distance FROM clean f CROSS JOIN many c QUALIFY row_number() OVER (PARTITION BY {', '.join('f.' + k for k in KEYS.split(', '))} "
    f"ORDER BY distance, c.centroid_id) = 1) SELECT {KEYS}, centroid_id, round(distance, 5) AS distance FROM near",
    "centroid_distance": f"WITH {V.normalized_sql()}, d AS (SELECT {KEYS.replace('s', 's', 1)}, c.centroid_id, sqrt("
    + " + ".join(f"power(f.{c} - c.{c}, 2)" for c in VECTOR_COLUMNS)
    + f") AS x FROM clean f CROSS JOIN normalized c) SELECT {KEYS}, "
    + ", ".join(
        f"round(max(x) FILTER (centroid_id = {i}), 6) AS distance_{i}" for i in range(1, 5)
    )
    + " FROM d GROUP BY 1, 2, 3",
    "row_spread": _scored(
        f"SELECT {KEYS}, centroid_id, round(normalized_dest, 5) AS normalized_dest, round(spread, 5) AS spread FROM scored"
    ),
    "outliers": _scored(
        f"SELECT {KEYS}, number_of_records, number_of_unique_ips, number_of_unique_ports, {_OUTLIER_TAIL}"
    ),
    "outliers_rotated_counts": _scored(
        f"SELECT {KEYS}, number_of_unique_ips AS number_of_records, number_of_unique_ports AS number_of_unique_ips, "
        f"number_of_records AS number_of_unique_ports, {_OUTLIER_TAIL}",
        records_for_spread="number_of_unique_ips",
    ),
    "centroid_pivot": f"WITH {V.normalized_sql()} SELECT centroid_id, {VECTOR} FROM centroids",
    "centroid_spread": f"WITH {V.normalized_sql()} SELECT centroid_id, round(normalized_dest, 5) AS normalized_dest, {VECTOR} FROM normalized",
    "centroid_spread_compat": f"WITH {V.normalized_sql(True)} SELECT centroid_id, round(normalized_dest, 5) AS normalized_dest, {VECTOR} FROM normalized",
    "kmeans_one_step": f"WITH {V.normalized_sql()}, {_step('step1', 'clean', 'centroids')} SELECT centroid_id, "
    + ", ".join(f"round({c}, 6) AS {c}" for c in VECTOR_COLUMNS)
    + " FROM step1",
    "cluster_report": f"WITH {V.normalized_sql()}, {_step('step1', 'clean', 'centroids')}, {_step('step2', 'clean', 'step1')}, "
    "info AS (SELECT 1 AS iteration, centroid_id, sqrt(avg(distance * distance)) AS cluster_radius FROM step1_near GROUP BY 2 "
    "UNION ALL SELECT 2, centroid_id, sqrt(avg(distance * distance)) FROM step2_near GROUP BY 2) "
    "SELECT c.centroid_id, round(i.cluster_radius, 4) AS cluster_radius, "
    + ", ".join(f"round(c.{c}, 4) AS {c}" for c in VECTOR_COLUMNS)
    + " FROM step2 c LEFT JOIN info i ON i.centroid_id = c.centroid_id "
    "WHERE i.iteration = (SELECT max(iteration) FROM info)",
    "train_rows_filtered": "SELECT * EXCLUDE (subscriber_id, dst_subnet, transaction_time, number_of_unique_ips, "
    f"number_of_unique_ports, dt) FROM ({_DATED}) WHERE dt BETWEEN DATE '2024-01-05' AND DATE '2024-01-20' "
    "AND avg_tx_bytes IS NOT NULL AND avg_rx_bytes IS NOT NULL AND avg_duration IS NOT NULL",
    "train_rows_limited": f"WITH k AS (SELECT *, subscriber_id || '|' || dst_subnet || '|' || transaction_time AS k FROM ({_DATED}) "
    "WHERE dt BETWEEN DATE '2024-01-01' AND DATE '2024-01-31') "
    f"SELECT {KEYS} FROM k QUALIFY row_number() OVER (ORDER BY {hash32_sql('k', 0)}, k) <= 300",
    "tokenize_hash": "SELECT event_id, 'IMSI_TOKEN(64):' || "
    f"sha256('{TOKEN_KEY.decode()}:' || subscriberId) AS token FROM ({FLOW})",
    "tokenize_aes_roundtrip": f"SELECT {KEYS}, true AS is_token FROM ({DAY_FEATURES})",
    "tokenize_groups": f"SELECT count(*) AS n, CAST(sum(txBytes) AS BIGINT) AS tx FROM ({FLOW}) GROUP BY subscriberId",
    "feature_batches": _FEATURE_BATCHES,
    "tokenize_service": f"SELECT sha256(subscriber_id) AS subscriber_id, dst_subnet, transaction_time FROM ({DAY_FEATURES})",
    "inspect_sensitive": r"SELECT doc_id, CAST(len(regexp_extract_all(text, '\b[0-9]{14,15}\b')) AS INT) AS text_imsi_count, "
    r"CAST(len(regexp_extract_all(text, '[A-Za-z0-9._%+-]+@[A-Za-z0-9.-]+\.[A-Za-z]{2,}')) AS INT) AS text_email_count, "
    r"CAST(len(regexp_extract_all(text, '\b[0-9]{1,3}\.[0-9]{1,3}\.[0-9]{1,3}\.[0-9]{1,3}\b')) AS INT) AS text_ipv4_count FROM documents",
    "model_input": f"SELECT {MODEL} FROM ({TRANSACTIONS})",
    "request_batches": f"{_REQUESTS} SELECT transactionId, shard, batch_id FROM packed",
    "request_documents": f"{_REQUESTS} SELECT window_start, shard, batch_id, count(*) AS n_rows, "
    "CAST(sum(size) AS BIGINT) AS n_bytes FROM packed GROUP BY 1, 2, 3",
    "request_instances": f"SELECT transactionId, type, amount FROM ({TRANSACTIONS})",
    "parse_predictions": f"SELECT transactionId, round(logistic, 9) AS logistic FROM ({RULE})",
    "scorer_alerts": f"SELECT transactionId, round(logistic, 9) AS logistic FROM ({RULE}) WHERE logistic >= 0.99",
    "prediction_join": "SELECT transactionId, round(logistic, 9) AS logistic, nameOrig, nameDest, amount, isFraud "
    f"FROM ({RULE}) WHERE logistic >= 0.5",
    "fraud_downsample": f"WITH t AS ({TRANSACTIONS}), neg AS (SELECT *, row_number() OVER (ORDER BY {hash32_sql('transactionId', 2)}, transactionId) AS rn, "
    "count(*) OVER () AS n FROM t WHERE isFraud = 0) "
    "SELECT transactionId, type, amount, isFraud FROM neg WHERE rn <= round_even(0.005::DOUBLE * n, 0) "
    "UNION ALL SELECT transactionId, type, amount, isFraud FROM t WHERE isFraud = 1",
    "fraud_split": f"SELECT transactionId, isFraud, row_number() OVER (ORDER BY {hash32_sql('transactionId', 2)}, transactionId) "
    f"<= floor(0.8::DOUBLE * count(*) OVER ()) AS in_train FROM ({TRANSACTIONS})",
    "known_frauds": f"SELECT transactionId, type, amount, nameOrig FROM ({TRANSACTIONS}) WHERE isFraud = 1 ORDER BY transactionId LIMIT 10",
    "one_hot_type": f"WITH t AS ({TRANSACTIONS}), v AS (SELECT list_sort(list(DISTINCT type)) AS values FROM t) "
    "SELECT transactionId, type, array_to_string(list_transform(values, lambda x: CASE WHEN x = type THEN '1' ELSE '0' END), ',') AS type_onehot, "
    "step, amount, oldbalanceOrg, newbalanceOrig, oldbalanceDest, newbalanceDest FROM t, v",
    "type_vocabulary": f"SELECT DISTINCT type FROM ({TRANSACTIONS})",
    "transaction_keys": f"SELECT transactionId AS original, sha256(transactionId) AS transactionId FROM ({TRANSACTIONS})",
    "confusion_counts": f"SELECT isFraud AS actual, {_CALL} AS predicted, count(*) AS n FROM ({RULE}) GROUP BY 1, 2",
    "model_evaluation": f"WITH s AS (SELECT isFraud = 1 AS a, {_CALL} = 1 AS p FROM ({RULE})) SELECT count(*) AS n, "
    "count(*) FILTER (a AND p) AS true_positives, round(count(*) FILTER (a = p) / count(*)::DOUBLE, 9) AS accuracy, "
    "round(count(*) FILTER (a AND p) / nullif(count(*) FILTER (p), 0)::DOUBLE, 9) AS precision, "
    "round(count(*) FILTER (a AND p) / nullif(count(*) FILTER (a), 0)::DOUBLE, 9) AS recall FROM s",
    "generate_flow_logs": f"SELECT CAST({_between(0, 0, 99999)} AS VARCHAR) AS subscriberId, "
    f"{_ip_text(_digest_number(1))} AS srcIP, {_ip_text(f'201326592 + {_digest_number(2)} % 65536')} AS dstIP, "
    f"CAST({_between(3, 1000, 5000)} AS INT) AS srcPort, CAST({_between(4, 1000, 5000)} AS INT) AS dstPort, "
    f"CAST({_between(5, 10, 1000)} AS INT) AS txBytes, CAST({_between(6, 10, 1000)} AS INT) AS rxBytes, "
    f"1570276550000 + id AS startTime, 1570276550000 + id + {_digest_number(7)} % 60 AS endTime, "
    f"CAST({_between(8, 0, 65)} AS INT) AS tcpFlag, ['tcp', 'udp', 'http'][1 + {_digest_number(9)} % 3] AS protocolName, "
    f"CAST({_between(10, 0, 1)} AS INT) AS protocolNumber FROM ({_DIGEST})",
    "generate_transactions": f"SELECT CAST({_between(0, 111, 555)} AS INT) AS step, 'C' || {_digest_number(1)} AS nameOrig, "
    f"'C' || {_digest_number(2)} AS nameDest, CAST({_between(3, 0, 1)} AS INT) AS isFlaggedFraud, "
    f"CAST({_between(4, 0, 1)} AS INT) AS isFraud, ['CASH_IN', 'CASH_OUT', 'TRANSFER', 'PAYMENT'][1 + {_digest_number(5)} % 4] AS type, "
    + ", ".join(_MONEY.values())
    + ", substr(d, 81, 8) || '-' || substr(d, 89, 4) || '-' || substr(d, 93, 4) || '-' || substr(d, 97, 4) || '-' || substr(d, 101, 12) AS transactionId "
    f"FROM ({_DIGEST})",
    "publish_messages": f"SELECT CAST(to_json(struct_pack(event_id := event_id, {', '.join(f'{c} := {c}' for c in FLOW_LOG.fieldNames())})) AS VARCHAR) AS value, "
    f"'event_type' AS header, 'netflow' AS event_type FROM ({FLOW})",
    "load_features_table": f"SELECT * EXCLUDE (dt) FROM ({_DATED}) WHERE dt BETWEEN DATE '2024-01-05' AND DATE '2024-01-20'",
    "flow_job_features": _JOB_FEATURES,
    "flow_job_outliers": _JOB_OUTLIERS,
    "flow_job_raw": "SELECT f.* EXCLUDE (event_id, event_ts), g.geoCountry, g.geoCity, g.latitude, g.longitude "
    f"FROM ({_valid_flows(INJECTED)}) f LEFT JOIN ({V.duck(V.GEO, 'nation JOIN region ON n_regionkey = r_regionkey')}) g "
    f"ON {_ip_number('f.srcIP')} BETWEEN g.start_ip AND g.end_ip",
    "flow_job_inspected": f"SELECT {KEYS}, CAST(0 AS INT) AS dst_subnet_imsi_count, CAST(0 AS INT) AS dst_subnet_email_count, "
    f"CAST(1 AS INT) AS dst_subnet_ipv4_count FROM ({_JOB_FEATURES})",
    "flow_job_text_files": V.features_sql(
        f"SELECT * EXCLUDE (event_ts), make_timestamp(startTime * 1000) AS event_ts FROM ({_valid_flows(INJECTED)})"
    ),
    "fraud_job_rejects": "SELECT CASE WHEN o_orderkey % 10 <> 3 THEN transactionId END AS transactionId, amount, "
    f"o_orderkey % 10 = 3 AS rejected FROM ({TRANSACTIONS})",
    "fraud_job_alerts": _ALERTS,
    "stream_features": V.features_sql(_valid_flows(FLOW)),
    "stream_late_rows": V.features_sql(
        f"WITH v AS ({_valid_flows(FLOW)}) SELECT * FROM v UNION ALL SELECT * FROM v "
        f"WHERE {V.window_end_sql(V.DAY)} > (SELECT max(ts) FROM events)"
    ),
    "stream_outliers": _JOB_OUTLIERS,
    "stream_bus_features": V.features_sql(
        f"SELECT * EXCLUDE (event_ts), make_timestamp(startTime * 1000) AS event_ts FROM ({FLOW})"
    ),
    "stream_versioned_outliers": _JOB_OUTLIERS.replace(
        "> 2.0 * normalized_dest",
        f"> 2.0 * normalized_dest * CASE WHEN transaction_time >= '{VERSION_FROM}' THEN {VERSION_FACTOR}::DOUBLE ELSE 1 END",
    ),
    "stream_counters": f"WITH f AS ({_JOB_FEATURES}), o AS ({_JOB_OUTLIERS}) SELECT 'features' AS name, count(*) AS total FROM f "
    "UNION ALL SELECT 'records', CAST(sum(number_of_records) AS BIGINT) FROM f UNION ALL SELECT 'outliers', count(*) FROM o",
    "stream_request_instances": f"SELECT transactionId, type, amount FROM ({TRANSACTIONS})",
    "stream_alerts": _ALERTS,
    "csv_labelled_scan": f"SELECT step, isFraud, type, amount, oldbalanceOrg, newbalanceOrig, oldbalanceDest, newbalanceDest, transactionId FROM ({TRANSACTIONS}) WHERE isFraud = 1",
    "kmeans_facts": f"SELECT CAST(4 AS BIGINT) AS clusters, count(*) AS n, true AS nearest, true AS not_above_start FROM ({DAY_FEATURES})",
    "tokens_without_key": f"SELECT {KEYS} FROM ({DAY_FEATURES})",
    "gbt_facts": "SELECT count(*) AS n, true AS probabilities, true AS accurate, true AS recalled, "
    f"true AS same_when_reloaded FROM ({TRANSACTIONS})",
    "append_twice": DAY_FEATURES,
    "create_or_replace": f"WITH {V.normalized_sql()} SELECT centroid_id, {VECTOR} FROM centroids",
    "stored_query_centroids": f"WITH {V.normalized_sql()} SELECT centroid_id, round(normalized_dest, 5) AS normalized_dest, {VECTOR} FROM normalized",
    "centroids_json_load": f"WITH {V.normalized_sql()} SELECT centroid_id, round(normalized_dest, 5) AS normalized_dest, {VECTOR} FROM normalized",
}

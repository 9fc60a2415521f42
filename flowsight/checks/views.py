"""Input tables of the registered queries, derived from the star-schema test tables.

Each view is a list of column expressions that Spark and DuckDB both read, so the
two sides of a check start from the same rows.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from flowsight.operators import clustering
from flowsight.operators.features import window_features
from flowsight.schemas import VECTOR_COLUMNS

DAY = 86_400

_SPARK = {
    "S": "STRING",
    "MS": "(unix_micros(CAST(ts AS TIMESTAMP)) div 1000)",
    "TS": "CAST(ts AS TIMESTAMP)",
    "ORDER_TS": "CAST(o_orderdate AS TIMESTAMP)",
}
_DUCK = {
    "S": "VARCHAR",
    "MS": "(epoch_us(ts) // 1000)",
    "TS": "ts",
    "ORDER_TS": "o_orderdate",
}

_BOOST = "CASE WHEN event_id % 97 = 11 THEN 50 ELSE 1 END"

FLOW = {
    "event_id": "event_id",
    "subscriberId": "CAST(user_id % 20 AS {S})",
    "srcIP": "concat('12.0.', CAST(event_id % 8 AS {S}), '.', CAST(event_id % 251 AS {S}))",
    "dstIP": "concat('12.0.', CAST(user_id % 16 AS {S}), '.', CAST(user_id % 4 AS {S}))",
    "srcPort": "CAST(1000 + (event_id * 7) % 4001 AS INT)",
    "dstPort": "CAST(1000 + (event_id * 13) % 4001 AS INT)",
    "txBytes": "CAST(round(value * 100) AS INT)",
    "rxBytes": "CAST(10 + (event_id * 31) % 991 AS INT)",
    "startTime": "{MS}",
    "endTime": "{MS} + event_id % 60",
    "tcpFlag": "CAST(event_id % 66 AS INT)",
    "protocolName": "CASE event_id % 3 WHEN 0 THEN 'tcp' WHEN 1 THEN 'udp' ELSE 'http' END",
    "protocolNumber": "CAST(event_id % 2 AS INT)",
    "event_ts": "{TS}",
}

# outlier traffic: one row in 97 carries fifty times the bytes
FLOW_INJECTED = {
    **FLOW,
    "txBytes": f"CAST(round(value * 100) * {_BOOST} AS INT)",
    "rxBytes": f"CAST((10 + (event_id * 31) % 991) * {_BOOST} AS INT)",
}

_TEXT_FIELDS = ("subscriberId", "srcIP", "dstIP", "protocolName")


def _json_object() -> str:
    parts = []
    for name in FLOW:
        if name in ("event_id", "event_ts"):
            continue
        head = "{{" if not parts else ","
        quote = '"' if name in _TEXT_FIELDS else ""
        parts.append(f"'{head}\"{name}\":{quote}'")
        parts.append(f"CAST({name} AS {{S}})")
        if quote:
            parts.append("'\"'")
    return f"concat({', '.join(parts)}, '}}}}')"


# lines that are no JSON object of the schema, and two that are one despite white space
_OTHER_LINES = {
    9: "concat({object}, '{{{{}}}}')",
    19: "concat({object}, ' junk}}}}')",
    29: "concat({object}, chr(9))",
    39: "concat({object}, chr(13))",
    49: "concat('[', {object}, ']')",
    59: "''",
    69: "concat('{{{{\"subscriberId\":\"1\",\"srcPort\":\"x\",\"srcIP\":\"', srcIP, '\",\"dstIP\":\"', dstIP, '\"}}}}')",
}


def _other_lines(number: str, text: str) -> str:
    return " ".join(
        f"WHEN {number} % 154 = {k} THEN {line.format(object=text)}" for k, line in _OTHER_LINES.items()
    )


# raw text over FLOW: some lines are cut off, some hold an address that is none
LINES = {
    "event_id": "event_id",
    "line": "CASE WHEN event_id % 77 = 5 THEN '{{\"subscriberId\":' "
    "WHEN event_id % 50 = 3 THEN concat('{{\"subscriberId\":\"', subscriberId, "
    "'\",\"srcIP\":\"12.0.9.400\",\"dstIP\":\"', dstIP, '\"}}') "
    f"{_other_lines('event_id', _json_object())} ELSE {_json_object()} END",
    "event_ts": "event_ts",
}

TRANSACTIONS = {
    "step": "CAST(111 + o_orderkey % 445 AS INT)",
    "nameOrig": "concat('C', CAST(o_custkey AS {S}))",
    "nameDest": "concat('C', CAST((o_custkey * 7919) % 1009 AS {S}))",
    "isFlaggedFraud": "CAST(CASE WHEN o_totalprice > 400000 THEN 1 ELSE 0 END AS INT)",
    "isFraud": "CAST(CASE WHEN o_totalprice > 300000 AND o_orderkey % 5 = 0 THEN 1 ELSE 0 END AS INT)",
    "type": "CASE o_orderpriority WHEN '1-URGENT' THEN 'TRANSFER' WHEN '2-HIGH' THEN 'CASH_OUT' "
    "WHEN '3-MEDIUM' THEN 'CASH_IN' WHEN '4-NOT SPECIFIED' THEN 'PAYMENT' ELSE 'DEBIT' END",
    "amount": "o_totalprice",
    "oldbalanceOrg": "o_totalprice * (1 + o_orderkey % 5)",
    "newbalanceOrig": "o_totalprice * (o_orderkey % 5)",
    "oldbalanceDest": "o_totalprice * (o_orderkey % 3)",
    "newbalanceDest": "o_totalprice * (1 + o_orderkey % 3)",
    "transactionId": "concat('T', CAST(o_orderkey AS {S}))",
    "event_ts": "{ORDER_TS}",
    "o_orderkey": "o_orderkey",
}

# raw payment text over TRANSACTIONS, with the same kinds of bad lines
_PAYMENT = "concat('{{\"transactionId\":\"', transactionId, '\"}}')"
PAYMENT_LINES = {
    "o_orderkey": "o_orderkey",
    "line": f"CASE {' '.join(f'WHEN o_orderkey % 80 = {k} THEN {line.format(object=_PAYMENT)}' for k, line in _OTHER_LINES.items() if k != 69)} "
    "WHEN o_orderkey % 80 = 69 THEN '{{\"step\":\"x\"}}' WHEN o_orderkey % 80 = 70 THEN '{{\"step\":' "
    f"ELSE {_PAYMENT} END",
}

GEO = {
    "start_ip": "CAST(201326592 + n_nationkey * 128 AS BIGINT)",
    "end_ip": "CAST(201326592 + n_nationkey * 128 + 99 AS BIGINT)",
    "geoCountry": "r_name",
    "geoCity": "n_name",
    "latitude": "CAST(n_nationkey * 3 - 36 AS DOUBLE)",
    "longitude": "CAST(n_nationkey * 7 - 80 AS DOUBLE)",
}

# the fixed model: four clusters by peak upload
CLUSTER_OF = (
    "CASE WHEN max_tx_bytes < 1000 THEN 1 WHEN max_tx_bytes < 5000 THEN 2 "
    "WHEN max_tx_bytes < 20000 THEN 3 ELSE 4 END"
)
N_CLUSTERS = 4
CLUSTER_OF_MANY = f"CAST(({CLUSTER_OF}) * 3 + number_of_records % 3 AS INT)"


_SCHEMAS: dict[str, StructType] = {}


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    # the files hold timestamps without zone, which the checks read as UTC
    spark.conf.set("spark.sql.session.timeZone", "UTC")
    path = f"{sf_dir}/{name}.parquet"
    if path not in _SCHEMAS:
        _SCHEMAS[path] = spark.read.parquet(path).schema
    return spark.read.schema(_SCHEMAS[path]).parquet(path)


def project(df: DataFrame, view: dict[str, str]) -> DataFrame:
    return df.selectExpr(*[f"{e.format(**_SPARK)} AS {n}" for n, e in view.items()])


def duck(view: dict[str, str], source: str) -> str:
    columns = ", ".join(f"{e.format(**_DUCK)} AS {n}" for n, e in view.items())
    return f"SELECT {columns} FROM {source}"


def flow_logs(spark: SparkSession, sf_dir: str) -> DataFrame:
    return project(table(spark, sf_dir, "events"), FLOW)


def flow_logs_injected(spark: SparkSession, sf_dir: str) -> DataFrame:
    return project(table(spark, sf_dir, "events"), FLOW_INJECTED)


def flow_lines(spark: SparkSession, sf_dir: str) -> DataFrame:
    return project(flow_logs(spark, sf_dir), LINES)


def transactions(spark: SparkSession, sf_dir: str) -> DataFrame:
    return project(table(spark, sf_dir, "orders"), TRANSACTIONS)


def geo_ranges(spark: SparkSession, sf_dir: str) -> DataFrame:
    nation = table(spark, sf_dir, "nation")
    region = table(spark, sf_dir, "region")
    return project(nation.join(region, nation.n_regionkey == region.r_regionkey), GEO)


def features(spark: SparkSession, sf_dir: str, injected: bool = False) -> DataFrame:
    """Day features of the clean or the injected flow logs."""
    flows = (flow_logs_injected if injected else flow_logs)(spark, sf_dir)
    return window_features(flows, DAY)


def assigned(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Clean features with their cluster in the fixed model."""
    return features(spark, sf_dir).withColumn("centroid_id", F.expr(CLUSTER_OF))


def centroids(spark: SparkSession, sf_dir: str) -> DataFrame:
    return clustering.pivot_centroids(clustering.centroid_rows(assigned(spark, sf_dir)))


def normalized_centroids(
    spark: SparkSession, sf_dir: str, compat: bool = False
) -> DataFrame:
    rows = assigned(spark, sf_dir)
    centres = clustering.pivot_centroids(clustering.centroid_rows(rows))
    return clustering.centroid_spread(rows, centres, compat)


# ---- the same in SQL ----


def window_end_sql(seconds: int) -> str:
    micros = seconds * 1_000_000
    return f"make_timestamp(((epoch_us(event_ts) // {micros}) + 1) * {micros})"


def features_sql(source: str, seconds: int = DAY, subnet: str = "concat(dstIP, '/22')") -> str:
    stats = ", ".join(
        f"max({c}) AS max_{n}, min({c}) AS min_{n}, avg({c}) AS avg_{n}"
        for n, c in (
            ("tx_bytes", "txBytes"),
            ("rx_bytes", "rxBytes"),
            ("duration", "CAST(abs(endTime - startTime) AS INT)"),
        )
    )
    return (
        f"SELECT subscriberId AS subscriber_id, {subnet} AS dst_subnet, "
        f"strftime({window_end_sql(seconds)}, '%Y-%m-%d %H:%M:%S.%f') AS transaction_time, "
        "CAST(count(*) AS INT) AS number_of_records, "
        "CAST(count(DISTINCT srcIP) AS INT) AS number_of_unique_ips, "
        "CAST(count(DISTINCT srcPort) AS INT) AS number_of_unique_ports, "
        f"{stats} FROM ({source}) GROUP BY 1, 2, 3"
    )


def normalized_sql(compat: bool = False) -> str:
    """CTE list up to `normalized`, over the clean features."""
    rounded = ", ".join(f"round(avg({c}), 1) AS {c}" for c in VECTOR_COLUMNS)
    terms, out = [], []
    for c in VECTOR_COLUMNS:
        swap = compat and c in ("avg_tx_bytes", "avg_rx_bytes")
        terms.append(f"(p.{c} - c.{c.replace('avg', 'min') if swap else c})")
        source = "min_tx_bytes" if compat and c == "min_rx_bytes" else c
        out.append(f"any_value(c.{source}) AS {c}")
    return (
        f"clean AS ({features_sql(duck(FLOW, 'events'))}), "
        f"assigned AS (SELECT *, {CLUSTER_OF} AS centroid_id FROM clean), "
        f"centroids AS (SELECT centroid_id, {rounded} FROM assigned GROUP BY 1), "
        f"normalized AS (SELECT c.centroid_id, stddev_samp({' + '.join(terms)}) AS normalized_dest, "
        f"{', '.join(out)} FROM assigned p JOIN centroids c ON c.centroid_id = p.centroid_id "
        "GROUP BY c.centroid_id)"
    )


def scored_sql(
    features_cte: str, records_for_spread: str = "number_of_records", compat: bool = False
) -> str:
    """CTE list up to `scored`: the features with distance, nearest centroid, spread."""
    squares = " + ".join(f"power(f.{c} - c.{c}, 2)" for c in VECTOR_COLUMNS)
    diffs = [
        f"(n.{records_for_spread if c == 'number_of_records' else c} - c.{c})"
        for c in VECTOR_COLUMNS
    ]
    mean = f"(({' + '.join(diffs)}) / 10)"
    variance = " + ".join(f"power({d} - {mean}, 2)" for d in diffs)
    return (
        f"{normalized_sql(compat)}, scored_side AS ({features_cte}), "
        f"pairs AS (SELECT f.*, c.centroid_id, sqrt({squares}) AS distance FROM scored_side f CROSS JOIN normalized c), "
        "nearest AS (SELECT * FROM pairs QUALIFY row_number() OVER "
        "(PARTITION BY subscriber_id, dst_subnet, transaction_time ORDER BY distance, centroid_id) = 1), "
        f"scored AS (SELECT n.*, c.normalized_dest, sqrt(({variance}) / 9) AS spread "
        "FROM nearest n JOIN normalized c ON c.centroid_id = n.centroid_id)"
    )

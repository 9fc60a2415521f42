"""JSON validation and typing of raw lines, with rejects kept."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import StringType, StructField, StructType

from flowsight.functions.netaddr import is_ipv4
from flowsight.schemas import FLOW_LOG, TRANSACTION

_CORRUPT = "_corrupt"

OK = "ok"
BAD_JSON = "bad_json"
MISSING_IP = "missing_ip"
BAD_IP = "bad_ip"


def _parse(lines: DataFrame, schema: StructType) -> DataFrame:
    """Adds `record` (the typed fields) and `_bad` (not a JSON object of the schema)."""
    with_corrupt = StructType(
        schema.fields + [StructField(_CORRUPT, StringType(), True)]
    )
    record = F.from_json(
        "line",
        with_corrupt,
        {
            "mode": "PERMISSIVE",
            "columnNameOfCorruptRecord": _CORRUPT,
            "allowSingleQuotes": "false",
        },
    )
    # Exploding the one record keeps filters on it from being pushed below, where
    # the line would be parsed again for every field they use.
    parsed = lines.select("*", F.explode(F.array(record)).alias("record"))
    # the parser stops behind the first object: the whole line has to be one element
    listed = F.concat(F.lit("["), F.col("line"), F.lit(",0]"))
    whole = F.json_array_length(listed) == 2
    return parsed.withColumn(
        "_bad",
        F.col("record").isNull()
        | F.col(f"record.{_CORRUPT}").isNotNull()
        | ~F.coalesce(whole, F.lit(False)),
    )


# How the text of a rejected line begins.
BAD_JSON_TEXT = "Not a valid JSON record "
BAD_IP_TEXT = "Not a valid IP address "


def _error_text(status: Column) -> Column:
    return F.when(
        status == BAD_JSON, F.concat(F.lit(BAD_JSON_TEXT), F.col("line"))
    ).when(
        status != OK, F.concat(F.lit(BAD_IP_TEXT), F.col("line"))
    )


def parse_flow_lines(lines: DataFrame) -> DataFrame:
    """`status`, `error` and the twelve typed flow columns for every line.

    The other columns of the input, `event_ts` among them, stay.
    """
    src, dst = F.col("record.srcIP"), F.col("record.dstIP")
    status = (
        F.when(F.col("_bad"), BAD_JSON)
        .when(src.isNull() | dst.isNull(), MISSING_IP)
        .when(~(is_ipv4(dst) & is_ipv4(src)), BAD_IP)
        .otherwise(OK)
    )
    parsed = _parse(lines, FLOW_LOG).withColumn("status", status)
    return _flatten(parsed, FLOW_LOG)


def parse_transaction_lines(lines: DataFrame) -> DataFrame:
    """As `parse_flow_lines` for payments: the syntax is checked, no field is."""
    status = F.when(F.col("_bad"), BAD_JSON).otherwise(OK)
    return _flatten(_parse(lines, TRANSACTION).withColumn("status", status), TRANSACTION)


def _flatten(parsed: DataFrame, schema: StructType) -> DataFrame:
    keep = [c for c in parsed.columns if c not in ("record", "_bad", "status")]
    return parsed.select(
        *keep,
        "status",
        _error_text(F.col("status")).alias("error"),
        *[F.col(f"record.{f.name}").alias(f.name) for f in schema],
    )


def valid_rows(parsed: DataFrame) -> DataFrame:
    return parsed.where(F.col("status") == OK).drop("line", "status", "error")


def rejected_rows(parsed: DataFrame) -> DataFrame:
    """`line, status, error` of the lines that failed, plus `event_ts` if there is one."""
    extra = ["event_ts"] if "event_ts" in parsed.columns else []
    return parsed.where(F.col("status") != OK).select(
        "line", "status", "error", *extra
    )


def restamp(flows: DataFrame, seed: int | None = None) -> DataFrame:
    """Compat: overwrite startTime with now and endTime with now + 0..59 ms."""
    now = F.unix_millis(F.current_timestamp())
    jitter = F.floor(F.rand(seed) * 60).cast("bigint")
    return flows.withColumns({"startTime": now, "endTime": now + jitter})

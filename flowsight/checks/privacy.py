"""Sealed tokens and findings, and the same in SQL."""

from __future__ import annotations

from pyspark.sql import functions as F

from flowsight.checks import views as V
from flowsight.checks.oracles import DAY_FEATURES, KEYS
from flowsight.checks.queries import KEYS as KEY_COLUMNS
from flowsight.checks.queries import TOKEN_KEY, Query
from flowsight.functions import privacy


def sealed_tokens(spark, sf):
    """Tokens open with their key and context, and with nothing else or when changed."""
    context = F.col("dst_subnet")
    rows = V.features(spark, sf).select(*KEY_COLUMNS)
    rows = rows.withColumn("token", privacy.seal(F.col("subscriber_id"), TOKEN_KEY, context))
    middle = F.substring("token", 24, 1)
    changed = F.overlay("token", F.when(middle == "A", "B").otherwise("A"), F.lit(24))
    opened = privacy.unseal(F.col("token"), TOKEN_KEY, context)
    return rows.select(
        opened.alias("subscriber_id"),
        *KEY_COLUMNS[1:],
        F.col("token").startswith(privacy.TOKEN_PREFIX).alias("is_token"),
        privacy.unseal(changed, TOKEN_KEY, context).isNull().alias("changed_refused"),
        privacy.unseal(F.col("token"), TOKEN_KEY, F.concat(context, F.lit("x"))).isNull().alias("moved_refused"),
        privacy.unseal(F.col("token"), TOKEN_KEY[::-1], context).isNull().alias("other_key_refused"),
    )


def sealed_groups(spark, sf):
    """Equal identifiers get equal tokens: group sizes survive sealing."""
    rows = V.flow_logs(spark, sf).select("subscriberId", "txBytes")
    rows = privacy.tokenize_columns(rows, ["subscriberId"], TOKEN_KEY, sealed=True)
    return rows.groupBy("subscriberId").agg(
        F.count(F.lit(1)).alias("n"), F.sum("txBytes").alias("tx")
    ).select("n", "tx")


def sensitive_findings(spark, sf):
    docs = V.table(spark, sf, "documents").select("doc_id", "text")
    return privacy.find_sensitive(docs, "text")


_PATTERNS = {
    "email": r"[A-Za-z0-9._%+-]+@[A-Za-z0-9.-]+\.[A-Za-z]{2,}",
    "imsi": r"\b[0-9]{14,15}\b",
    "ipv4": r"\b[0-9]{1,3}\.[0-9]{1,3}\.[0-9]{1,3}\.[0-9]{1,3}\b",
}


def _kind(kind: str, pattern: str) -> str:
    return (
        f"SELECT doc_id, '{kind}' AS kind, coalesce(list_sum(list_transform(b[1:i], lambda x: length(x))), 0) "
        "+ coalesce(list_sum(list_transform(v[1:i - 1], lambda x: length(x))), 0) AS start, v[i] AS value FROM "
        "(SELECT doc_id, b, v, unnest(range(1, len(v) + 1)) AS i FROM (SELECT doc_id, "
        f"regexp_split_to_array(text, '{pattern}') AS b, regexp_extract_all(text, '{pattern}') AS v FROM documents))"
    )


_DIGITS = "list_transform(range(15), lambda i: CAST(substr(value, 15 - CAST(i AS INT), 1) AS INT) * CAST(1 + i % 2 AS INT))"
_FINDINGS = f"""WITH f AS ({' UNION ALL '.join(_kind(k, p) for k, p in _PATTERNS.items())}),
e AS (SELECT doc_id, kind, CAST(start AS INT) AS start, CAST(start + length(value) AS INT) AS "end", value FROM f)
SELECT *, CASE WHEN regexp_full_match(value, '[0-9]{{15}}')
  THEN list_sum(list_transform({_DIGITS}, lambda d: CASE WHEN d > 9 THEN d - 9 ELSE d END)) % 10 = 0 END AS check_digit
FROM e x WHERE NOT EXISTS (SELECT 1 FROM e y WHERE y.doc_id = x.doc_id AND y.start < x."end" AND x.start < y."end"
  AND (y.start - y."end", y.start, y.kind) < (x.start - x."end", x.start, x.kind))"""

PRIVACY_QUERIES: dict[str, Query] = {f.__name__: f for f in (sealed_tokens, sealed_groups, sensitive_findings)}

PRIVACY_ORACLES: dict[str, str] = {
    "sealed_tokens": f"SELECT {KEYS}, true AS is_token, true AS changed_refused, true AS moved_refused, "
    f"true AS other_key_refused FROM ({DAY_FEATURES})",
    "sealed_groups": "SELECT count(*) AS n, CAST(sum(txBytes) AS BIGINT) AS tx FROM "
    f"({V.duck(V.FLOW, 'events')}) GROUP BY subscriberId",
    "sensitive_findings": _FINDINGS,
}

"""Training by rounds, and its replay in SQL."""

from __future__ import annotations

from pyspark.sql import functions as F

from flowsight.checks import views as V
from flowsight.checks.oracles import KEYS, hash32_sql
from flowsight.checks.queries import Query, rounded
from flowsight.operators import clustering, kmeans
from flowsight.plans.training import round_report
from flowsight.schemas import VECTOR_COLUMNS
from flowsight.session import written

K, SEED, PASSES, ROUNDS, MIDDLE = 4, 1, 3, 6, 3


def _trained(spark, sf):
    rows = written(V.features(spark, sf).withColumn("_key", clustering.row_key()), "points")
    model = kmeans.fit(rows, "_key", K, SEED, ROUNDS, tolerance=None, passes=PASSES)
    return rows.drop("_key"), model


def kmeans_train(spark, sf):
    """The normalised centroid table of the trained model."""
    rows, model = _trained(spark, sf)
    long = kmeans.centroids_long(spark, model).where(F.col("iteration") == ROUNDS).drop("iteration")
    spread = clustering.centroid_spread(kmeans.assign(model, rows), clustering.pivot_centroids(long))
    return rounded(spread, 4, "normalized_dest")


def kmeans_history(spark, sf):
    """Loss, radii, sizes and centres of every round."""
    _, model = _trained(spark, sf)
    info = kmeans.training_info(spark, model)
    info = info.select("iteration", F.round("loss", 6).alias("loss"), F.inline("cluster_info"))
    centres = kmeans.centroids_long(spark, model).groupBy("iteration", "centroid_id")
    centres = centres.pivot("feature", VECTOR_COLUMNS).agg(F.first("numerical_value"))
    found = info.join(centres, ["iteration", "centroid_id"])
    return rounded(found, 4, "cluster_radius", *VECTOR_COLUMNS)


def _report(spark, sf, iteration):
    _, model = _trained(spark, sf)
    report = round_report(kmeans.centroids_long(spark, model), kmeans.training_info(spark, model), iteration)
    return rounded(report, 4, "cluster_radius")


def kmeans_report(spark, sf):
    return _report(spark, sf, ROUNDS)


def kmeans_report_of_a_round(spark, sf):
    return _report(spark, sf, MIDDLE)


# ---- the same in SQL ----

_X = ", ".join(VECTOR_COLUMNS)


def _distance(a: str, b: str) -> str:
    return "sqrt(" + " + ".join(f"power(({a}.{c} - {b}.{c}) / s.{c}, 2)" for c in VECTOR_COLUMNS) + ")"


def _seeding() -> list[str]:
    ctes = [
        f"f AS MATERIALIZED (SELECT *, {KEYS.replace(', ', " || '|' || ")} AS k FROM ({V.features_sql(V.duck(V.FLOW, 'events'))}))",
        f"s AS MATERIALIZED (SELECT {', '.join(f'coalesce(nullif(stddev_samp({c}), 0), 1) AS {c}' for c in VECTOR_COLUMNS)} FROM f)",
        f"c0 AS MATERIALIZED (SELECT 0 AS pass, k, {_X} FROM f ORDER BY {hash32_sql('k', SEED)}, k LIMIT 1)",
    ]
    for i in range(1, PASSES + 1):
        ctes += [
            f"d{i} AS MATERIALIZED (SELECT f.k, power(min({_distance('f', 'c')}), 2) AS sq FROM f, c{i - 1} c, s GROUP BY f.k)",
            f"c{i} AS MATERIALIZED (SELECT * FROM c{i - 1} UNION ALL SELECT {i} AS pass, k, {_X} FROM f JOIN d{i} USING (k) "
            f"WHERE {hash32_sql('k', f'{SEED}.{i}')} / 4294967296.0::DOUBLE < {2.0 * K} * sq / (SELECT sum(sq) FROM d{i}))",
        ]
    ctes += [
        f"cand AS MATERIALIZED (SELECT *, row_number() OVER (ORDER BY pass, k) AS pos FROM c{PASSES})",
        f"near AS (SELECT f.k, c.pos FROM f, cand c, s QUALIFY row_number() OVER (PARTITION BY f.k ORDER BY {_distance('f', 'c')}, c.pos) = 1)",
        "heavy AS MATERIALIZED (SELECT cand.*, coalesce(n, 0) AS n FROM cand LEFT JOIN (SELECT pos, count(*) AS n FROM near GROUP BY 1) USING (pos))",
        f"p1 AS MATERIALIZED (SELECT 1 AS centroid_id, pos, {_X} FROM heavy ORDER BY n DESC, pos LIMIT 1)",
    ]
    for i in range(2, K + 1):
        ctes.append(
            f"p{i} AS MATERIALIZED (SELECT * FROM p{i - 1} UNION ALL SELECT {i} AS centroid_id, pos, {_X} FROM (SELECT h.pos, "
            f"{', '.join(f'any_value(h.{c}) AS {c}' for c in VECTOR_COLUMNS)}, any_value(h.n) * min(power({_distance('h', 'p')}, 2)) AS gain "
            f"FROM heavy h, p{i - 1} p, s GROUP BY h.pos ORDER BY gain DESC, h.pos LIMIT 1))"
        )
    ctes.append(f"m0 AS MATERIALIZED (SELECT centroid_id, {_X} FROM p{K})")
    return ctes


def _assigned(name: str, centres: str) -> str:
    return (
        f"{name} AS MATERIALIZED (SELECT f.*, c.centroid_id, {_distance('f', 'c')} AS distance FROM f, {centres} c, s "
        f"QUALIFY row_number() OVER (PARTITION BY f.k ORDER BY distance, c.centroid_id) = 1)"
    )


def _rounds() -> list[str]:
    ctes = []
    for i in range(1, ROUNDS + 1):
        means = ", ".join(f"avg({c}) AS {c}" for c in VECTOR_COLUMNS)
        kept = ", ".join(f"coalesce(a.{c}, c.{c}) AS {c}" for c in VECTOR_COLUMNS)
        ctes += [
            _assigned(f"a{i}", f"m{i - 1}"),
            f"m{i} AS MATERIALIZED (SELECT centroid_id, {kept} FROM m{i - 1} c LEFT JOIN "
            f"(SELECT centroid_id, {means} FROM a{i} GROUP BY 1) a USING (centroid_id))",
            f"i{i} AS (SELECT {i} AS iteration, centroid_id, cluster_radius, coalesce(n, 0) AS cluster_size FROM m{i} LEFT JOIN "
            f"(SELECT centroid_id, sqrt(avg(distance * distance)) AS cluster_radius, count(*) AS n FROM a{i} GROUP BY 1) USING (centroid_id))",
        ]
    return ctes + [_assigned("final", f"m{ROUNDS}")]


_CTES = "WITH " + ",\n".join([*_seeding(), *_rounds()]) + "\n"


def _history(i: int) -> str:
    return (
        f"SELECT iteration, centroid_id, round((SELECT avg(distance * distance) FROM a{i}), 6) AS loss, "
        f"round(cluster_radius, 4) AS cluster_radius, cluster_size, {', '.join(f'round({c}, 4) AS {c}' for c in VECTOR_COLUMNS)} "
        f"FROM i{i} JOIN m{i} USING (centroid_id)"
    )


def _report_sql(i: int) -> str:
    return (
        f"{_CTES} SELECT centroid_id, round(cluster_radius, 4) AS cluster_radius, "
        f"{', '.join(f'round({c}, 1) AS {c}' for c in VECTOR_COLUMNS)} FROM i{i} JOIN m{i} USING (centroid_id)"
    )


KMEANS_QUERIES: dict[str, Query] = {
    f.__name__: f for f in (kmeans_train, kmeans_history, kmeans_report, kmeans_report_of_a_round)
}

KMEANS_ORACLES: dict[str, str] = {
    "kmeans_train": f"{_CTES} SELECT centroid_id, round(stddev_samp({' + '.join(f'f.{c}' for c in VECTOR_COLUMNS)}), 4) AS normalized_dest, "
    f"{', '.join(f'any_value(round(m.{c}, 1)) AS {c}' for c in VECTOR_COLUMNS)} "
    f"FROM final f JOIN m{ROUNDS} m USING (centroid_id) GROUP BY centroid_id",
    "kmeans_history": _CTES + " UNION ALL ".join(_history(i) for i in range(1, ROUNDS + 1)),
    "kmeans_report": _report_sql(ROUNDS),
    "kmeans_report_of_a_round": _report_sql(MIDDLE),
}

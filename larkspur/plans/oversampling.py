"""Oversampling of the churned training customers."""

from __future__ import annotations

from pyspark.sql import functions as F

from larkspur.operators import sampling
from larkspur.operators.neighbours import nearest_neighbours
from larkspur.operators.oversample import COPY_SEED, GAP_SEED, PICK_SEED, oversample
from larkspur.plans.churn import CHURN_SQL, churn_view, hash_sql
from larkspur.plans.registry import query
from larkspur.sources.tables import table

FEATURES = "credit_score age tenure balance products_number estimated_salary".split()


def _distance_sql(columns: list[str]) -> str:
    return " + ".join(f"(a.{c} - b.{c}) * (a.{c} - b.{c})" for c in columns)


@query(
    "customer_neighbours",
    f"""WITH p AS (SELECT c_custkey, c_nationkey::DOUBLE * 100 AS x, c_acctbal AS y FROM customer),
    pairs AS (SELECT a.c_custkey AS key, b.c_custkey AS neighbour, {_distance_sql(['x', 'y'])} AS distance2
        FROM p a JOIN p b ON a.c_custkey <> b.c_custkey),
    ranked AS (SELECT *, CAST(row_number() OVER (PARTITION BY key ORDER BY distance2, neighbour)
        AS INTEGER) AS rank FROM pairs)
    SELECT key, neighbour, round(distance2, 6) AS distance2, rank FROM ranked WHERE rank <= 5""",
)
def customer_neighbours(spark, folder):
    """The five customers nearest to each by nation number and balance."""
    at = F.array(F.col("c_nationkey").cast("double") * 100, F.col("c_acctbal"))
    points = table(spark, folder, "customer").select(F.col("c_custkey").alias("key"), at.alias("vector"))
    return nearest_neighbours(points, 5).withColumn("distance2", F.round("distance2", 6))


SPLIT_HASH = hash_sql("customer_id")

OVERSAMPLE_SQL = (
    CHURN_SQL
    + f""", train AS (SELECT * FROM churn_view WHERE {SPLIT_HASH} % 16 >= 7),
    minority AS (SELECT customer_id AS id, {', '.join(f + '::DOUBLE AS ' + f for f in FEATURES)},
        row_number() OVER (ORDER BY {SPLIT_HASH}, customer_id) AS r FROM train WHERE churn = 1),
    sizes AS (SELECT count(*) FILTER (churn = 1) AS small,
        count(*) FILTER (churn = 0) - count(*) FILTER (churn = 1) AS wanted FROM train),
    copies AS (SELECT id, unnest(range(wanted // small + CAST(r <= wanted % small AS INTEGER))) AS copy
        FROM minority, sizes),
    near AS (SELECT a.id, b.id AS other,
        row_number() OVER (PARTITION BY a.id ORDER BY {_distance_sql(FEATURES)}, b.id) - 1 AS place
        FROM minority a JOIN minority b ON a.id <> b.id),
    drawn AS (SELECT id, copy, {hash_sql('(' + hash_sql('id', COPY_SEED) + ' + copy)', PICK_SEED)} AS draw
        FROM copies),
    placed AS (SELECT *, {hash_sql('draw', GAP_SEED)} / 2147483647.0::DOUBLE AS gap FROM drawn),
    made AS (SELECT d.id AS customer_id, d.copy,
        {', '.join(f'a.{f} + gap * (b.{f} - a.{f}) AS {f}' for f in FEATURES)}, 1 AS churn
        FROM placed d JOIN near n ON d.id = n.id AND n.place = draw % 5
        JOIN minority a ON d.id = a.id JOIN minority b ON n.other = b.id)
    SELECT customer_id, copy, {', '.join(f'round({f}, 4) AS {f}' for f in FEATURES)}, churn FROM made
    UNION ALL SELECT customer_id, NULL, {', '.join(f'round({f}::DOUBLE, 4)' for f in FEATURES)}, churn
    FROM train"""
)


def oversampled_training(spark, folder):
    view = sampling.assign_split(churn_view(spark, folder), "customer_id")
    train = view.where(F.col("split") == "train")
    return oversample(train, FEATURES, "customer_id")


@query("oversampled_customers", OVERSAMPLE_SQL)
def oversampled_customers(spark, folder):
    balanced = oversampled_training(spark, folder)
    return balanced.withColumns({f: F.round(f, 4) for f in FEATURES})

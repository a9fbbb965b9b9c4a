"""Customer queries: features, binning, exploration, encoding, splitting and weighting.

The customer file itself is not part of the given tables, so a stand-in with the same columns is
derived from ``customer``, ``nation``, ``orders`` and ``lineitem``.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from larkspur.functions.numeric import portable_hash
from larkspur.operators import encoding, explore, features, pairing, sampling, sketches
from larkspur.plans.registry import query
from larkspur.session import fresh_folder
from larkspur.sources.tables import table

CHURN_DATE = "2000-07-01"
ACTIVE_DATE = "2001-01-01"
SNAPSHOT_ACTIVE_DATE = "2000-01-01"

HASH_SQL = "((({0} % 2147483647) * 48271 + {1}) % 2147483647) * 16807 % 2147483647"


def hash_sql(key: str, seed: int = 42) -> str:
    return HASH_SQL.format(key, seed)


CHURN_SQL = f"""
WITH order_facts AS (
    SELECT o_custkey, round(sum(o_totalprice), 2) AS estimated_salary,
           min(o_orderdate) AS first_day, max(o_orderdate) AS last_day
    FROM orders GROUP BY o_custkey
), part_facts AS (
    SELECT o_custkey, count(DISTINCT l_partkey) AS products_number
    FROM orders JOIN lineitem ON o_orderkey = l_orderkey GROUP BY o_custkey
), churn_view AS (
    SELECT c_custkey AS customer_id,
           CAST(350 + {hash_sql('c_custkey', 1)} % 501 AS INTEGER) AS credit_score,
           n_name AS country,
           CASE WHEN {hash_sql('c_custkey', 2)} % 2 = 0 THEN 'Male' ELSE 'Female' END AS gender,
           CAST(18 + {hash_sql('c_custkey', 3)} % 75 AS INTEGER) AS age,
           CAST(coalesce(date_diff('day', first_day, last_day) // 365, 0) AS INTEGER) AS tenure,
           c_acctbal AS balance,
           CAST(coalesce(products_number, 0) AS INTEGER) AS products_number,
           CAST({hash_sql('c_custkey', 4)} % 2 AS INTEGER) AS credit_card,
           CAST(coalesce(last_day >= TIMESTAMP '{ACTIVE_DATE}', false) AS INTEGER) AS active_member,
           coalesce(estimated_salary, 0.0) AS estimated_salary,
           CAST(coalesce(last_day < TIMESTAMP '{CHURN_DATE}', true) AS INTEGER) AS churn
    FROM customer
    LEFT JOIN nation ON c_nationkey = n_nationkey
    LEFT JOIN order_facts f ON c_custkey = f.o_custkey
    LEFT JOIN part_facts p ON c_custkey = p.o_custkey
)
"""


def churn_view(spark: SparkSession, folder: str) -> DataFrame:
    """Stand-in customer table. A join whose columns a query leaves unused is pruned away, since
    its right side is unique on the key."""
    return _customer_view(spark, folder, ACTIVE_DATE, CHURN_DATE, None)


def snapshot_view(spark: SparkSession, folder: str) -> DataFrame:
    """The stand-in for model runs: features know only the orders before the churn date, so the
    label (no order from then on) is not among them."""
    return _customer_view(spark, folder, SNAPSHOT_ACTIVE_DATE, CHURN_DATE, CHURN_DATE)


def _customer_view(
    spark: SparkSession, folder: str, active_date: str, churn_date: str, snapshot: str | None
) -> DataFrame:
    customer = table(spark, folder, "customer")
    nation = table(spark, folder, "nation").groupBy("n_nationkey").agg(
        F.first("n_name").alias("country")
    )
    orders = all_orders = table(spark, folder, "orders")
    if snapshot is not None:
        orders = all_orders.where(F.col("o_orderdate") < F.lit(snapshot).cast("timestamp"))
    lines = table(spark, folder, "lineitem").select("l_orderkey", "l_partkey")
    order_facts = orders.groupBy("o_custkey").agg(
        F.round(F.sum("o_totalprice"), 2).alias("estimated_salary"),
        F.min("o_orderdate").alias("first_day"),
        F.max("o_orderdate").alias("last_day"),
    )
    # Pairs first, then a count of them: both steps combine on the map side, so a customer with a
    # third of all lines arrives as one row per task.
    part_facts = (
        orders.select("o_orderkey", "o_custkey")
        .join(lines, F.col("o_orderkey") == F.col("l_orderkey"))
        .select("o_custkey", "l_partkey")
        .distinct()
        .groupBy("o_custkey")
        .agg(F.count("*").alias("products_number"))
    )
    last_orders = all_orders.groupBy("o_custkey").agg(F.max("o_orderdate").alias("last_ever"))
    key = F.col("c_custkey")
    last_day = F.col("last_day")
    days = F.datediff("last_day", "first_day")
    return (
        customer.join(nation, F.col("c_nationkey") == F.col("n_nationkey"), "left")
        .join(order_facts.withColumnRenamed("o_custkey", "f_key"), key == F.col("f_key"), "left")
        .join(part_facts.withColumnRenamed("o_custkey", "p_key"), key == F.col("p_key"), "left")
        .join(last_orders.withColumnRenamed("o_custkey", "e_key"), key == F.col("e_key"), "left")
        .select(
            key.alias("customer_id"),
            (350 + portable_hash(key, 1) % 501).cast("int").alias("credit_score"),
            "country",
            F.when(portable_hash(key, 2) % 2 == 0, "Male").otherwise("Female").alias("gender"),
            (18 + portable_hash(key, 3) % 75).cast("int").alias("age"),
            F.coalesce(F.floor(days / 365), F.lit(0)).cast("int").alias("tenure"),
            F.col("c_acctbal").alias("balance"),
            F.coalesce("products_number", F.lit(0)).cast("int").alias("products_number"),
            (portable_hash(key, 4) % 2).cast("int").alias("credit_card"),
            F.coalesce((last_day >= F.lit(active_date).cast("timestamp")).cast("int"), F.lit(0)).alias(
                "active_member"
            ),
            F.coalesce("estimated_salary", F.lit(0.0)).alias("estimated_salary"),
            F.coalesce((F.col("last_ever") < F.lit(churn_date).cast("timestamp")).cast("int"), F.lit(1)).alias(
                "churn"
            ),
        )
    )


def _churn_sql(body: str) -> str:
    return CHURN_SQL + body


# --- projections, filters, features -----------------------------------------------------------


@query("churn_customers", _churn_sql("SELECT * FROM churn_view"))
def churn_customers(spark, folder):
    return churn_view(spark, folder)


@query(
    "drop_columns",
    "SELECT c_nationkey, c_acctbal, c_mktsegment FROM customer",
)
def drop_columns(spark, folder):
    return table(spark, folder, "customer").drop("c_custkey", "c_name")


@query("target_column", _churn_sql("SELECT churn FROM churn_view"))
def target_column(spark, folder):
    return features.split_target(churn_view(spark, folder))[1]


@query(
    "feature_columns",
    _churn_sql("SELECT * EXCLUDE (customer_id, churn) FROM churn_view"),
)
def feature_columns(spark, folder):
    return features.split_target(churn_view(spark, folder))[0]


@query(
    "churned_cohort",
    _churn_sql("SELECT customer_id, balance, tenure FROM churn_view WHERE churn = 1"),
)
def churned_cohort(spark, folder):
    return features.cohort(churn_view(spark, folder), 1).select("customer_id", "balance", "tenure")


@query(
    "retained_cohort",
    _churn_sql("SELECT customer_id, balance, tenure FROM churn_view WHERE churn = 0"),
)
def retained_cohort(spark, folder):
    return features.cohort(churn_view(spark, folder), 0).select("customer_id", "balance", "tenure")


@query(
    "customer_ratios",
    _churn_sql(
        """SELECT customer_id, round(balance / nullif(products_number, 0), 6) AS product_mean_balance,
        round(balance / nullif(estimated_salary, 0), 6) AS balance_to_salary FROM churn_view"""
    ),
)
def customer_ratios(spark, folder):
    ratios = features.add_ratios(churn_view(spark, folder))
    return ratios.select(
        "customer_id",
        F.round("product_mean_balance", 6).alias("product_mean_balance"),
        F.round("balance_to_salary", 6).alias("balance_to_salary"),
    )


AGE_RANK_SQL = """CASE WHEN age < 0 OR age > 100 THEN NULL WHEN age <= 30 THEN '30대이하'
    WHEN age <= 40 THEN '30대' WHEN age <= 50 THEN '40대' WHEN age <= 60 THEN '50대'
    ELSE '60대이상' END"""


@query(
    "age_rank",
    _churn_sql(
        f"""SELECT customer_id, age, {AGE_RANK_SQL} AS risk_age_rank,
        CAST(CASE {AGE_RANK_SQL} WHEN '30대이하' THEN 0 WHEN '30대' THEN 1 WHEN '40대' THEN 2
        WHEN '50대' THEN 3 ELSE 4 END AS INTEGER) AS risk_age_ordinal FROM churn_view"""
    ),
)
def age_rank(spark, folder):
    ranked = features.add_age_rank(churn_view(spark, folder))
    return ranked.select("customer_id", "age", "risk_age_rank", "risk_age_ordinal")


@query(
    "tenure_band",
    _churn_sql(
        """SELECT customer_id, tenure, CASE WHEN tenure > 0 AND tenure <= 10
        THEN concat(tenure, '년') END AS tenure_band FROM churn_view"""
    ),
)
def tenure_band(spark, folder):
    banded = features.add_tenure_band(churn_view(spark, folder))
    return banded.select("customer_id", "tenure", "tenure_band")


@query(
    "first_customers",
    "SELECT * FROM customer ORDER BY c_custkey LIMIT 5",
)
def first_customers(spark, folder):
    return pairing.first_rows(table(spark, folder, "customer"), "c_custkey")


@query(
    "blank_repeated_brands",
    """SELECT p_partkey, CASE WHEN row_number() OVER (PARTITION BY p_brand ORDER BY p_partkey) > 1
    THEN '' ELSE p_brand END AS shown FROM part""",
)
def blank_repeated_brands(spark, folder):
    parts = table(spark, folder, "part").select("p_partkey", "p_brand")
    return pairing.blank_repeats(parts, "p_brand", "p_partkey").select("p_partkey", "shown")


# --- exploration ------------------------------------------------------------------------------


def _cross_sql(column: str) -> str:
    return _churn_sql(
        f"""SELECT {column}, count(*) FILTER (churn = 0) AS churn_0,
        count(*) FILTER (churn = 1) AS churn_1 FROM churn_view GROUP BY {column}"""
    )


@query("gender_by_churn", _cross_sql("gender"))
def gender_by_churn(spark, folder):
    return explore.cross_count(churn_view(spark, folder), "gender", "churn", [0, 1])


@query("credit_card_by_churn", _cross_sql("credit_card"))
def credit_card_by_churn(spark, folder):
    return explore.cross_count(churn_view(spark, folder), "credit_card", "churn", [0, 1])


def _describe_sql(source: str, column: str) -> str:
    return f"""SELECT count({column}) AS count, round(avg({column}), 6) AS mean,
    round(stddev_samp({column}), 6) AS std, min({column})::DOUBLE AS min,
    round(quantile_cont({column}, 0.25), 6) AS p25, round(quantile_cont({column}, 0.5), 6) AS p50,
    round(quantile_cont({column}, 0.75), 6) AS p75, max({column})::DOUBLE AS max FROM {source}"""


def _rounded(df: DataFrame, *columns: str) -> DataFrame:
    return df.withColumns({c: F.round(c, 6) for c in columns})


def _described(df: DataFrame, column: str) -> DataFrame:
    return _rounded(explore.describe(df, column), "mean", "std", "p25", "p50", "p75")


@query("describe_balance", _describe_sql("customer", "c_acctbal"))
def describe_balance(spark, folder):
    return _described(table(spark, folder, "customer"), "c_acctbal")


@query("describe_salary", _churn_sql(_describe_sql("churn_view", "estimated_salary")))
def describe_salary(spark, folder):
    return _described(churn_view(spark, folder), "estimated_salary")


@query("describe_active_member", _churn_sql(_describe_sql("churn_view", "active_member")))
def describe_active_member(spark, folder):
    return _described(churn_view(spark, folder), "active_member")


@query("describe_line_price", _describe_sql("lineitem", "l_extendedprice"))
def describe_line_price(spark, folder):
    return _described(table(spark, folder, "lineitem"), "l_extendedprice")


@query("describe_supplier_balance", _describe_sql("supplier", "s_acctbal"))
def describe_supplier_balance(spark, folder):
    return _described(table(spark, folder, "supplier"), "s_acctbal")


CHURN_COLUMNS = (
    "customer_id credit_score country gender age tenure balance products_number credit_card "
    "active_member estimated_salary churn"
).split()


@query(
    "customer_null_counts",
    _churn_sql(
        " UNION ALL ".join(
            f"SELECT '{c}' AS column_name, count(*) - count({c}) AS nulls FROM churn_view"
            for c in CHURN_COLUMNS
        )
    ),
)
def customer_null_counts(spark, folder):
    return explore.null_counts(churn_view(spark, folder))


EVENT_COLUMNS = "event_id ts user_id event_type value props".split()


@query(
    "event_null_counts",
    " UNION ALL ".join(
        f"SELECT '{c}' AS column_name, count(*) - count({c})"
        + (" + count(*) FILTER (isnan(value))" if c == "value" else "")
        + " AS nulls FROM events"
        for c in EVENT_COLUMNS
    ),
)
def event_null_counts(spark, folder):
    return explore.null_counts(table(spark, folder, "events"))


# Fixed edges of the age histogram.
AGE_EDGES = [x * 10 for x in range(1, 10)]


@query(
    "age_histogram",
    _churn_sql(
        """SELECT CAST(b AS INTEGER) AS bin, (10.0 * b + 10)::DOUBLE AS low,
        (10.0 * b + 20)::DOUBLE AS high, CAST(c AS INTEGER) AS churn,
        count(customer_id) AS n
        FROM range(8) r(b) CROSS JOIN range(2) s(c)
        LEFT JOIN churn_view ON churn = c AND age >= 10 AND age <= 90
             AND least(age // 10 - 1, 7) = b
        GROUP BY b, c"""
    ),
)
def age_histogram(spark, folder):
    return explore.histogram(churn_view(spark, folder), "age", AGE_EDGES, "churn")


def _width_sql(source: str, column: str, bins: int, cohort: str | None = None) -> str:
    pick = f"{cohort}, " if cohort else ""
    grid = f"range({bins}) r(b)" + (" CROSS JOIN range(2) s(c)" if cohort else "")
    return f"""
    span AS (SELECT min({column})::DOUBLE AS lo, max({column})::DOUBLE AS hi FROM {source}),
    cut AS (SELECT CASE WHEN lo = hi THEN lo - 0.5 ELSE lo END AS start,
            CASE WHEN lo = hi THEN 1.0 ELSE hi - lo END / {bins} AS width FROM span),
    binned AS (SELECT {pick} least(floor(({column} - start) / width), {bins - 1})::INTEGER AS bin
               FROM {source}, cut WHERE {column} IS NOT NULL)
    SELECT CAST(b AS INTEGER) AS bin, round(any_value(start) + b * any_value(width), 6) AS low,
           round(any_value(start) + (b + 1) * any_value(width), 6) AS high,
           {"CAST(c AS INTEGER) AS churn," if cohort else ""} count(bin) AS n
    FROM {grid} CROSS JOIN cut LEFT JOIN binned ON bin = b {"AND churn = c" if cohort else ""}
    GROUP BY b {", c" if cohort else ""}"""


@query(
    "credit_score_histogram",
    CHURN_SQL + "," + _width_sql("churn_view", "credit_score", 100, "churn"),
)
def credit_score_histogram(spark, folder):
    view = churn_view(spark, folder)
    found = explore.equal_width_histogram(view, "credit_score", 100, "churn")
    return _rounded(found, "low", "high")


@query("balance_histogram", CHURN_SQL + "," + _width_sql("churn_view", "balance", 20, "churn"))
def balance_histogram(spark, folder):
    found = explore.equal_width_histogram(churn_view(spark, folder), "balance", 20, "churn")
    return _rounded(found, "low", "high")


@query(
    "products_histogram",
    CHURN_SQL + "," + _width_sql("churn_view", "products_number", 4, "churn"),
)
def products_histogram(spark, folder):
    found = explore.equal_width_histogram(churn_view(spark, folder), "products_number", 4, "churn")
    return _rounded(found, "low", "high")


@query(
    "churned_salary_histogram",
    CHURN_SQL
    + ", left_ones AS (SELECT * FROM churn_view WHERE churn = 1),"
    + _width_sql("left_ones", "estimated_salary", 30),
)
def churned_salary_histogram(spark, folder):
    churned = features.cohort(churn_view(spark, folder), 1)
    return _rounded(explore.equal_width_histogram(churned, "estimated_salary", 30), "low", "high")


@query("line_price_histogram", "WITH" + _width_sql("lineitem", "l_extendedprice", 30))
def line_price_histogram(spark, folder):
    lines = table(spark, folder, "lineitem")
    return _rounded(explore.equal_width_histogram(lines, "l_extendedprice", 30), "low", "high")


TENURE_COUNT_SQL = """SELECT CAST(b AS INTEGER) AS bin, concat(b + 1, '년') AS label,
    count(customer_id) AS n FROM range(10) r(b)
    LEFT JOIN churn_view ON churn = 1 AND tenure = b + 1 GROUP BY b"""


def _tenure_counts(spark, folder):
    churned = features.cohort(churn_view(spark, folder), 1)
    return explore.interval_counts(
        churned, "tenure", features.TENURE_CUTS, features.TENURE_LABELS
    )


@query("churned_tenure_counts", _churn_sql(TENURE_COUNT_SQL + " ORDER BY bin"))
def churned_tenure_counts(spark, folder):
    return _tenure_counts(spark, folder)


@query(
    "churned_tenure_percent",
    CHURN_SQL
    + f", counts AS ({TENURE_COUNT_SQL}) SELECT bin, label, n, "
    + "round(100.0::DOUBLE * n / sum(n) OVER (), 1) AS percent FROM counts",
)
def churned_tenure_percent(spark, folder):
    return explore.with_percent(_tenure_counts(spark, folder))


def _box_sql(source: str, column: str) -> str:
    return f"""box AS (SELECT quantile_cont({column}, 0.25) AS q1,
        quantile_cont({column}, 0.5) AS med, quantile_cont({column}, 0.75) AS q3 FROM {source})
    SELECT round(any_value(q1), 6)::DOUBLE AS q1, round(any_value(med), 6)::DOUBLE AS median,
           round(any_value(q3), 6)::DOUBLE AS q3,
           min({column}) FILTER ({column} >= q1 - 1.5 * (q3 - q1))::DOUBLE AS whisker_low,
           max({column}) FILTER ({column} <= q3 + 1.5 * (q3 - q1))::DOUBLE AS whisker_high,
           count(*) FILTER ({column} < q1 - 1.5 * (q3 - q1) OR {column} > q3 + 1.5 * (q3 - q1))
               AS outliers
    FROM {source}, box"""


def _stored_summaries(df: DataFrame, column: str, by: str) -> DataFrame:
    """Summaries of each group, as a load would leave them beside its rows."""
    path = fresh_folder(df.sparkSession, "summaries")
    summaries = sketches.summarize(df, column, [by])
    summaries.write.parquet(path)
    return df.sparkSession.read.schema(summaries.schema).parquet(path)


@query("describe_line_price_by_sketches", _describe_sql("lineitem", "l_extendedprice"))
def describe_line_price_by_sketches(spark, folder):
    """Summaries of every month, merged; one more pass makes the quartiles exact."""
    lines = table(spark, folder, "lineitem").withColumn("month", F.date_trunc("month", "l_shipdate"))
    stored = _stored_summaries(lines, "l_extendedprice", "month")
    return _rounded(sketches.describe(lines, "l_extendedprice", stored), "mean", "std", "p25", "p50", "p75")


@query(
    "order_price_by_year_merged",
    """SELECT CAST(year(o_orderdate) AS INTEGER) AS year, count(o_totalprice) AS n, count(*) - count(o_totalprice) AS missing,
    round(avg(o_totalprice), 6) AS mean, round(stddev_pop(o_totalprice), 6) AS deviation,
    min(o_totalprice) AS low, max(o_totalprice) AS high FROM orders GROUP BY ALL""",
)
def order_price_by_year_merged(spark, folder):
    """Years described from the summaries of their days alone."""
    orders = table(spark, folder, "orders").withColumn("day", F.to_date("o_orderdate"))
    years = sketches.merge(_stored_summaries(orders, "o_totalprice", "day").withColumn("year", F.year("day")), ["year"])
    deviation = F.sqrt(F.col("m2") / F.col("n")).alias("deviation")
    return _rounded(years.select("year", "n", "missing", "mean", deviation, "low", "high"), "mean", "deviation")


@query("age_box", CHURN_SQL + "," + _box_sql("churn_view", "age"))
def age_box(spark, folder):
    return _rounded(explore.box_figures(churn_view(spark, folder), "age"), "q1", "median", "q3")


@query("order_price_box", "WITH " + _box_sql("orders", "o_totalprice"))
def order_price_box(spark, folder):
    orders = table(spark, folder, "orders")
    return _rounded(explore.box_figures(orders, "o_totalprice"), "q1", "median", "q3")


# --- encoding, splitting, weighting -----------------------------------------------------------

SEGMENTS = "AUTOMOBILE BUILDING FURNITURE HOUSEHOLD MACHINERY".split()


@query(
    "one_hot_segment",
    "SELECT c_custkey, "
    + ", ".join(f"CAST(c_mktsegment = '{s}' AS INTEGER) AS segment_{s}" for s in SEGMENTS)
    + " FROM customer",
)
def one_hot_segment(spark, folder):
    customer = table(spark, folder, "customer").select("c_custkey", "c_mktsegment")
    levels = encoding.fit_levels(customer, "c_mktsegment")
    return encoding.one_hot(customer, "c_mktsegment", levels, "segment").drop("c_mktsegment")


@query(
    "one_hot_age_rank",
    _churn_sql(
        "SELECT customer_id, "
        + ", ".join(
            f"CAST(coalesce({AGE_RANK_SQL} = '{a}', false) AS INTEGER) AS age_{a}"
            for a in ["30대", "30대이하", "40대", "50대", "60대이상"]
        )
        + " FROM churn_view"
    ),
)
def one_hot_age_rank(spark, folder):
    ranked = features.add_age_rank(churn_view(spark, folder)).select("customer_id", "risk_age_rank")
    levels = encoding.fit_levels(ranked, "risk_age_rank")
    return encoding.one_hot(ranked, "risk_age_rank", levels, "age").drop("risk_age_rank")


def _with_slot(df: DataFrame, key: str, column: str, levels: DataFrame) -> DataFrame:
    """Length of the one-hot vectors, their sum and, weighted by place, the slot that is set."""
    fields = F.from_json(F.to_json(F.struct("hot")), "hot struct<size: long, indices: array<long>, values: array<double>>")["hot"]
    encoded = encoding.one_hot_sparse(df, column, levels, "hot").select(key, fields.alias("f"))
    total = F.aggregate("f.values", F.lit(0.0), lambda a, x: a + x).cast("int")
    return encoded.select(key, F.col("f.size").alias("slots"), F.get("f.indices", F.lit(0)).alias("slot"), total.alias("set_slots"))


@query(
    "one_hot_part_names",
    """SELECT p_partkey, (SELECT count(DISTINCT p_name) FROM part) AS slots,
    CASE WHEN p_name IS NOT NULL THEN CAST(dense_rank() OVER (ORDER BY p_name NULLS LAST) - 1 AS BIGINT) END AS slot,
    CAST(p_name IS NOT NULL AS INTEGER) AS set_slots FROM part""",
)
def one_hot_part_names(spark, folder):
    part = table(spark, folder, "part").select("p_partkey", "p_name")
    return _with_slot(part, "p_partkey", "p_name", encoding.level_table(part, "p_name"))


@query(
    "one_hot_ordering_customers",
    """WITH levels AS (SELECT o_custkey, row_number() OVER (ORDER BY o_custkey) - 1 AS slot
      FROM (SELECT DISTINCT o_custkey FROM orders WHERE o_custkey IS NOT NULL))
    SELECT c_custkey, (SELECT count(*) FROM levels) AS slots, CAST(slot AS BIGINT) AS slot,
    CAST(slot IS NOT NULL AS INTEGER) AS set_slots FROM customer LEFT JOIN levels ON c_custkey = o_custkey""",
)
def one_hot_ordering_customers(spark, folder):
    """Levels of one table on another: customers without orders get zeros."""
    levels = encoding.level_table(table(spark, folder, "orders"), "o_custkey")
    return _with_slot(table(spark, folder, "customer").select("c_custkey"), "c_custkey", "c_custkey", levels)


@query(
    "ordinal_gender",
    _churn_sql(
        """SELECT customer_id, CAST(CASE gender WHEN 'Male' THEN 0 ELSE 1 END AS INTEGER)
        AS gender_code FROM churn_view"""
    ),
)
def ordinal_gender(spark, folder):
    code = encoding.ordinal(F.col("gender"), encoding.GENDERS)
    return churn_view(spark, folder).select("customer_id", code.alias("gender_code"))


@query(
    "standardized_balance",
    """SELECT c_custkey, round((c_acctbal - avg(c_acctbal) OVER ()) /
    stddev_pop(c_acctbal) OVER (), 6) AS c_acctbal_scaled FROM customer""",
)
def standardized_balance(spark, folder):
    customer = table(spark, folder, "customer").select("c_custkey", "c_acctbal")
    scaled = encoding.standardize(customer, ["c_acctbal"])
    return scaled.select("c_custkey", F.round("c_acctbal_scaled", 6).alias("c_acctbal_scaled"))


@query(
    "holdout_split",
    f"""SELECT c_custkey, CASE WHEN {hash_sql('c_custkey')} % 16 < 4 THEN 'test'
    WHEN {hash_sql('c_custkey')} % 16 < 7 THEN 'valid' ELSE 'train' END AS split FROM customer""",
)
def holdout_split(spark, folder):
    return sampling.assign_split(table(spark, folder, "customer").select("c_custkey"), "c_custkey")


@query(
    "exact_holdout_split",
    f"""WITH r AS (SELECT c_custkey, row_number() OVER (ORDER BY {hash_sql('c_custkey')}, c_custkey)
        AS p, ceil(count(*) OVER () * 0.25) AS t, count(*) OVER () AS n FROM customer)
    SELECT c_custkey, CASE WHEN p <= t THEN 'test' WHEN p <= t + ceil((n - t) * 0.25) THEN 'valid'
    ELSE 'train' END AS split FROM r""",
)
def exact_holdout_split(spark, folder):
    keys = table(spark, folder, "customer").select("c_custkey")
    return sampling.assign_exact_split(keys, "c_custkey")


@query(
    "folds",
    f"SELECT c_custkey, CAST({hash_sql('c_custkey')} % 5 AS INTEGER) AS fold FROM customer",
)
def folds(spark, folder):
    return sampling.assign_fold(table(spark, folder, "customer").select("c_custkey"), "c_custkey")


@query(
    "exact_folds",
    f"""SELECT c_custkey, CAST(ntile(5) OVER (ORDER BY {hash_sql('c_custkey')}, c_custkey) - 1
    AS INTEGER) AS fold FROM customer""",
)
def exact_folds(spark, folder):
    keys = table(spark, folder, "customer").select("c_custkey")
    return sampling.assign_exact_fold(keys, "c_custkey")


@query(
    "balanced_class_weight",
    _churn_sql(
        """SELECT customer_id, churn, round(count(*) OVER () /
        (2.0 * count(*) OVER (PARTITION BY churn)), 6) AS weight FROM churn_view"""
    ),
)
def balanced_class_weight(spark, folder):
    view = churn_view(spark, folder).select("customer_id", "churn")
    return _rounded(sampling.add_balanced_weight(view), "weight")


@query(
    "positive_class_weight",
    _churn_sql(
        """SELECT customer_id, churn, CASE churn WHEN 1 THEN 5.0::DOUBLE ELSE 1.0::DOUBLE END AS weight
        FROM churn_view"""
    ),
)
def positive_class_weight(spark, folder):
    view = churn_view(spark, folder).select("customer_id", "churn")
    return sampling.add_positive_weight(view, 5)

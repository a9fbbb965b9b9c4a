"""Fixed schemas, so no reader spends a pass on inference."""

from pyspark.sql import types as T

CUSTOMERS = T.StructType(
    [
        T.StructField("customer_id", T.LongType()),
        T.StructField("credit_score", T.IntegerType()),
        T.StructField("country", T.StringType()),
        T.StructField("gender", T.StringType()),
        T.StructField("age", T.IntegerType()),
        T.StructField("tenure", T.IntegerType()),
        T.StructField("balance", T.DoubleType()),
        T.StructField("products_number", T.IntegerType()),
        T.StructField("credit_card", T.IntegerType()),
        T.StructField("active_member", T.IntegerType()),
        T.StructField("estimated_salary", T.DoubleType()),
        T.StructField("churn", T.IntegerType()),
    ]
)

LAW_DOCUMENT = T.StructType(
    [
        T.StructField("title", T.StringType()),
        T.StructField("contents", T.ArrayType(T.StringType())),
        T.StructField("url", T.StringType()),
    ]
)

QUESTIONS = T.StructType(
    [T.StructField("question", T.StringType()), T.StructField("answer", T.StringType())]
)

CONVERSATIONS = T.StructType(
    [
        T.StructField("conv_id", T.LongType()),
        T.StructField("turn", T.LongType()),
        T.StructField("role", T.StringType()),
        T.StructField("text", T.StringType()),
    ]
)

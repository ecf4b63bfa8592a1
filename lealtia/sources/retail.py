"""The two input tables, derived from the retail star schema that the checks run on.

Every line item becomes a transaction and every customer a programme member. Suppliers are enrolled
too, under negative ids: members who never bought anything.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

# The columns used, so that no job is spent on finding the schema of a table.
COLUMNS = {
    "lineitem": "l_orderkey long, l_partkey long, l_linenumber int, l_quantity double, l_extendedprice double, "
    "l_returnflag string, l_shipdate timestamp_ntz",
    "orders": "o_orderkey long, o_custkey long",
    "part": "p_partkey long, p_type string",
    "customer": "c_custkey long, c_nationkey int, c_acctbal double, c_mktsegment string",
    "supplier": "s_suppkey long, s_nationkey int, s_acctbal double",
    "nation": "n_nationkey int, n_name string",
    "embeddings": "vec_id long, embedding array<float>, label int",
}


def scan(spark: SparkSession, sf_dir: str, table: str) -> DataFrame:
    return spark.read.schema(COLUMNS[table]).parquet(f"{sf_dir}/{table}.parquet")


def raw_transacciones(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Transactions the way a text source delivers them: dates as text."""
    return stored_transactions(spark, sf_dir).withColumn("fecha", F.col("fecha").cast("string"))


def stored_transactions(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Transactions the way a typed table stores them: dates as timestamps."""
    lineitem = scan(spark, sf_dir, "lineitem")
    orders = scan(spark, sf_dir, "orders")
    part = scan(spark, sf_dir, "part")
    kind = F.col("p_type")
    category = (
        F.when(kind == "ECONOMY", "TECNOLOGIA")
        .when(kind == "SMALL", "SALUD Y BELLEZA")
        .when(kind == "MEDIUM", "COMIDAS")
        .when(kind == "PROMO", "DEPORTES")
        .when(kind == "STANDARD", "LICORES Y CIGARRILLOS")
        .otherwise("HOGAR")
    )
    returned = F.col("l_returnflag") == "R"
    price, quantity = F.col("l_extendedprice"), F.col("l_quantity")
    return (
        lineitem.join(orders.hint("shuffle_hash"), lineitem.l_orderkey == orders.o_orderkey)
        .join(part, lineitem.l_partkey == part.p_partkey)
        .select(
            (F.col("l_orderkey") * 10 + F.col("l_linenumber")).alias("id_transaccion"),
            F.col("o_custkey").alias("id_cliente"),
            F.col("l_shipdate").cast("timestamp_ntz").alias("fecha"),
            category.alias("categoria"),
            F.when(returned, "Redemption").otherwise("Sale").alias("tipo_transaccion"),
            F.when(F.col("l_orderkey") % 97 == 0, -price).otherwise(price).alias("valor_transaccion"),
            F.when(returned, -quantity).otherwise(quantity).alias("puntos"),
        )
    )


def raw_customers(spark: SparkSession, sf_dir: str) -> DataFrame:
    nation = scan(spark, sf_dir, "nation")
    buyers = scan(spark, sf_dir, "customer").select(
        F.col("c_custkey").alias("id_cliente"),
        F.col("c_custkey").alias("member"),
        F.col("c_nationkey").alias("n_nationkey"),
        F.col("c_acctbal").alias("saldo_puntos"),
        F.col("c_mktsegment").alias("segment"),
    )
    idle = scan(spark, sf_dir, "supplier").select(
        (-F.col("s_suppkey") - 1).alias("id_cliente"),
        F.col("s_suppkey").alias("member"),
        F.col("s_nationkey").alias("n_nationkey"),
        F.col("s_acctbal").alias("saldo_puntos"),
        F.lit("SUPPLIER").alias("segment"),
    )
    member, segment = F.col("member"), F.col("segment")
    gender = (
        F.when(segment.isin("AUTOMOBILE", "MACHINERY"), "M")
        .when(segment.isin("BUILDING", "FURNITURE", "SUPPLIER"), "F")
        .otherwise("N")
    )
    born = F.date_add(F.lit("1920-01-01").cast("date"), (member * 37 % 36500).cast("int"))
    return (
        buyers.unionByName(idle)
        .join(nation, "n_nationkey")
        .select(
            "id_cliente",
            F.col("n_name").alias("ciudad"),
            gender.alias("genero"),
            (member % 6 + 1).cast("int").alias("estrato_social"),
            "saldo_puntos",
            F.when(member % 50 == 0, "no-date").otherwise(born.cast("string")).alias("fecha_nacimiento"),
        )
    )

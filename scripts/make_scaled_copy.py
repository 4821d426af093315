"""Write an N-fold copy of orders/customer/nation (keys offset per copy) for growth runs.

Usage: python scripts/make_scaled_copy.py SRC_DIR DST_DIR N
"""

import os
import sys

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

from pyspark.sql import functions as F  # noqa: E402

from recordforge.session import local_session  # noqa: E402


def main():
    src, dst, n = sys.argv[1], sys.argv[2], int(sys.argv[3])
    spark = local_session()
    copy = F.explode(F.sequence(F.lit(0).cast("bigint"), F.lit(n - 1).cast("bigint")))
    o = spark.read.parquet(f"{src}/orders.parquet")
    c = spark.read.parquet(f"{src}/customer.parquet")
    ko = o.agg(F.max("o_orderkey")).first()[0] + 1
    kc = c.agg(F.max("c_custkey")).first()[0] + 1
    (o.withColumn("copy", copy).withColumn("o_orderkey", F.col("o_orderkey") + F.col("copy") * ko)
     .withColumn("o_custkey", F.col("o_custkey") + F.col("copy") * kc).drop("copy")
     .repartition(n * 4).write.mode("overwrite").parquet(f"{dst}/orders.parquet"))
    (c.withColumn("copy", copy).withColumn("c_custkey", F.col("c_custkey") + F.col("copy") * kc).drop("copy")
     .repartition(n).write.mode("overwrite").parquet(f"{dst}/customer.parquet"))
    spark.read.parquet(f"{src}/nation.parquet").write.mode("overwrite").parquet(f"{dst}/nation.parquet")
    spark.stop()


if __name__ == "__main__":
    main()

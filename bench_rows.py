"""Time sampling and evidence on rows that Spark derives, one key with a third of them: ``python bench_rows.py [rows]``."""

from __future__ import annotations

import json
import os
import sys
import time

from pyspark.sql import functions as F

from litquarry.operators import chat, sampling
from litquarry.plans import corpus
from litquarry.session import local_session, materialize, scratch_tables


def keyed(spark, n: int, keys: int, hot: str, name: str):
    """``n`` rows with a unique key and a column of ``keys`` values, one of them on a third of the rows."""
    value = F.when(F.xxhash64("id", F.lit(1)) % 3 == 0, F.lit(hot)).otherwise(F.pmod(F.xxhash64("id"), F.lit(keys)).cast("string"))
    return spark.range(n).select(F.col("id").cast("string").alias("key"), value.alias(name), F.md5(F.col("id").cast("string")).alias("text"))


def main(n: int) -> None:
    spark = local_session("bench_rows", os.environ.get("BENCH_CPUS", "8"), 64)
    spark.sparkContext.setLogLevel("ERROR")
    times = {}

    def timed(name: str, df) -> None:
        start = time.perf_counter()
        df.write.format("noop").mode("overwrite").save()
        times[name] = round(time.perf_counter() - start, 1)
        print(name, times[name], file=sys.stderr, flush=True)

    with scratch_tables(spark):
        rows = materialize(keyed(spark, n, 100_000, "hot", "label"), "rows")
        kind = F.pmod(F.xxhash64("key", F.lit(2)), F.lit(2))
        matches = materialize(keyed(spark, n, n // 10, "hot", "pmid").select(
            "pmid", F.when(kind == 0, F.lit("DS")).otherwise(F.lit("GP")).alias("type"),
            F.concat(F.when(kind == 0, F.lit("EFO_")).otherwise(F.lit("ENSG")), F.pmod(F.xxhash64("key", F.lit(3)), F.lit(2000))).alias("keywordId"),
            F.array(F.lit("human")).alias("organisms"),
        ), "matches")
        diseases = spark.range(1500).select(F.concat(F.lit("EFO_"), "id").alias("id"), F.concat(F.lit("disease "), F.col("id") % 300).alias("name"))
        symbols = spark.range(1500).select(F.concat(F.lit("ENSG"), "id").alias("ENSG"), F.concat(F.lit("G"), F.col("id") % 900).alias("HUGO"))
        turns = rows.select(F.col("label").alias("conv_id"), F.col("key").cast("long").alias("turn"), F.lit("assistant").alias("role"), "text")
        timed("labelled_pmids", corpus.labelled_pmids(matches, diseases, symbols))
        timed("cap_per_group", sampling.cap_per_group(rows, "label", 2000, "key"))
        timed("stratified_sample", sampling.stratified_sample(rows, "label", n // 20, "key"))
        timed("train_val_split", sampling.train_val_split(rows, "key"))
        timed("global_rank", sampling.global_rank(rows, "key"))
        timed("take_first", sampling.take_first(rows, 8000, "key"))
        timed("number_copies", sampling.number_copies(rows.select("label")))
        timed("repair_turns", chat.repair_turns(turns))
    print(json.dumps({"metric": "derived rows, sum of seconds", "value": round(sum(times.values()), 1), "unit": "sec", "queries": times, "rows": n}))


if __name__ == "__main__":
    main(int(sys.argv[1]) if len(sys.argv) > 1 else 20_000_000)

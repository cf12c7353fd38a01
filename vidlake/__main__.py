"""Command line for the batch jobs, e.g. on a cluster:

    spark-submit --py-files vidlake.zip -m vidlake silver --bronze s3a://.../landing --silver s3a://.../silver
    spark-submit ... -m vidlake gold --silver .../silver --gold .../gold --as-of 2024-01-31
    spark-submit ... -m vidlake features --silver .../silver --features .../features
    spark-submit ... -m vidlake recommendations --posting .../gold/posting_time_analysis --out .../recs
    spark-submit ... -m vidlake stream --landing .../landing --silver .../silver --checkpoint .../ckpt

The session comes from the cluster's configuration (``getOrCreate``);
``--input-tb`` applies ``scale_conf`` sizing for settings that are not set.
"""

from __future__ import annotations

import argparse
import json

from pyspark.sql import SparkSession

from vidlake.plans import pipelines
from vidlake.session import configure, scale_conf


def main(argv=None) -> None:
    ap = argparse.ArgumentParser(prog="vidlake")
    ap.add_argument("--input-tb", type=float, default=None, help="input volume, for shuffle sizing")
    sub = ap.add_subparsers(dest="job", required=True)
    s = sub.add_parser("silver")
    s.add_argument("--bronze", required=True)
    s.add_argument("--silver", required=True)
    s.add_argument("--as-of", default=None)
    s.add_argument("--table", default=None)
    g = sub.add_parser("gold")
    g.add_argument("--silver", required=True)
    g.add_argument("--gold", required=True)
    g.add_argument("--as-of", default=None)
    f = sub.add_parser("features")
    f.add_argument("--silver", required=True)
    f.add_argument("--features", required=True)
    r = sub.add_parser("recommendations")
    r.add_argument("--posting", required=True)
    r.add_argument("--out", required=True)
    st = sub.add_parser("stream")
    st.add_argument("--landing", required=True)
    st.add_argument("--silver", required=True)
    st.add_argument("--checkpoint", required=True)
    st.add_argument("--as-of", default=None)
    a = ap.parse_args(argv)

    spark = SparkSession.builder.appName(f"vidlake-{a.job}").getOrCreate()
    if a.input_tb:
        cores = spark.sparkContext.defaultParallelism
        for k, v in scale_conf(int(a.input_tb * (1 << 40)), cores).items():
            if spark.conf.get(k, None) is None or k == "spark.sql.shuffle.partitions":
                spark.conf.set(k, v)
    configure(spark)

    if a.job == "silver":
        rep = pipelines.bronze_to_silver_job(spark, a.bronze, a.silver, as_of=a.as_of, table=a.table)
    elif a.job == "gold":
        rep = pipelines.silver_to_gold_job(spark, a.silver, a.gold, as_of=a.as_of)
    elif a.job == "features":
        rep = pipelines.features_job(spark, a.silver, a.features)
    elif a.job == "recommendations":
        rep = pipelines.recommendations_job(spark, a.posting, a.out)
    else:
        from vidlake.streaming.incremental import incremental_silver
        incremental_silver(spark, a.landing, a.silver, a.checkpoint, as_of=a.as_of)
        rep = pipelines.RunReport(outputs={"silver": a.silver})
    print(json.dumps({"job": a.job, "outputs": rep.outputs, "counts": rep.counts}, default=str))


if __name__ == "__main__":
    main()

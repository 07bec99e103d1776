"""Command line: ``python -m tvpulse <command> ...``.

  testdata --sf DIR --out PATH          write the test-data viewing logs, partitioned by NETWORK_ID
  build    --logs PATH --out DIR [--refresh NW03]  station marts, all checks, then the common marts behind the gate
  report   --logs PATH                  print the data-quality report (one row per check)
  kpi      --out DIR [--group network,genre] [--from D --to D] [--networks NW01,NW02]
                                        reach / minutes / sessions over the published common mart
  model    --out DIR --labels PATH [--rounds N]
                                        features, split, train, evaluate, register, score and publish
"""

from __future__ import annotations

import argparse
import sys

from tvpulse.schemas import NETWORKS


def main(argv=None) -> int:
    ap = argparse.ArgumentParser(prog="python -m tvpulse")
    sub = ap.add_subparsers(dest="cmd", required=True)
    t = sub.add_parser("testdata")
    t.add_argument("--sf", required=True)
    t.add_argument("--out", required=True)
    b = sub.add_parser("build")
    b.add_argument("--logs", required=True)
    b.add_argument("--out", required=True)
    b.add_argument("--refresh", help="build only these stations anew, e.g. NW03")
    r = sub.add_parser("report")
    r.add_argument("--logs", required=True)
    k = sub.add_parser("kpi")
    k.add_argument("--out", required=True)
    k.add_argument("--group", default="", help="dimensions, e.g. network or network,genre (default: overall)")
    k.add_argument("--from", dest="start")
    k.add_argument("--to", dest="end")
    k.add_argument("--networks", default=",".join(NETWORKS))
    m = sub.add_parser("model")
    m.add_argument("--out", required=True)
    m.add_argument("--labels", required=True)
    m.add_argument("--rounds", type=int, default=None, help="boosting rounds (default 200)")
    ap.add_argument("--master", default=None, help="e.g. local[*]; leave unset on a cluster")
    args = ap.parse_args(argv)

    from tvpulse.session import get_session
    spark = get_session(args.master)
    if args.cmd == "testdata":
        from tvpulse.sources import testdata
        testdata.viewing_log(spark, args.sf).write.mode("overwrite").partitionBy("NETWORK_ID").parquet(args.out)
        print(f"wrote {args.out}")
    elif args.cmd == "build":
        from tvpulse.plans.build import publish_common
        from tvpulse.sources import readers
        print(publish_common(readers.viewing_log(spark, args.logs), args.out, refresh=args.refresh and args.refresh.split(",")))
    elif args.cmd == "report":
        from tvpulse.plans.build import full_report
        from tvpulse.sources import readers
        for row in full_report(readers.viewing_log(spark, args.logs), materialize=True).collect():
            print(f"{row.SCOPE}\t{row.CHECK_NAME}\t{row.VIOLATIONS}")
    elif args.cmd == "kpi":
        from tvpulse.operators.metrics import DIMENSIONS, kpi
        from tvpulse.plans.build import read_common
        from tvpulse.plans.scope import Scope
        from pyspark.sql import functions as F
        daily = read_common(spark, args.out, "viewing_daily")
        if args.start and args.end:
            bounds = (args.start, args.end)
        else:
            row = daily.agg(F.min("VIEW_DATE"), F.max("VIEW_DATE")).first()
            bounds = (args.start or row[0], args.end or row[1])
        scope = Scope.of(bounds[0], bounds[1], [n.strip() for n in args.networks.split(",") if n.strip()])
        columns = {name: c for c, name in DIMENSIONS.items()}
        out = kpi(scope.apply(daily), *[columns[g.strip()] for g in args.group.split(",") if g.strip()])
        cols = out.columns
        print("\t".join(cols))
        for row in out.collect():
            print("\t".join(str(row[c]) for c in cols))
    elif args.cmd == "model":
        run_model_job(spark, args.out, args.labels, args.rounds)
    return 0


def run_model_job(spark, out_dir: str, labels_path: str, rounds: int | None = None) -> dict:
    """The model job over a published build: M1-M3, M8-M12, M14, M15."""
    from pyspark.sql import functions as F

    from tvpulse.ml import evaluate as ME
    from tvpulse.ml import features as MF
    from tvpulse.ml import model as MM
    from tvpulse.plans.build import read_common
    from tvpulse.sources import readers

    daily = read_common(spark, out_dir, "viewing_daily")
    features = MF.device_features(daily)
    labels = readers.device_labels(spark, labels_path)
    MF.require_clean_features(features, labels)
    split = MF.stratified_split(MF.features_labeled(features, labels))
    train = split.filter(F.col("SPLIT") == "train").drop("SPLIT")
    test = split.filter(F.col("SPLIT") == "test").drop("SPLIT")
    model = MM.train_model(train, **({"maxIter": rounds} if rounds else {}))
    scored = MM.score_devices(model, test).join(test.select("DEVICE_ID", "TARGET_F1"), "DEVICE_ID")
    auc = ME.eval_auc(scored).first()
    thr = ME.eval_threshold_metrics(scored).first()
    metrics = {"ROC_AUC": auc["ROC_AUC"], "PRECISION": thr["PRECISION"], "RECALL": thr["RECALL"],
               "F1_SCORE": thr["F1_SCORE"]}
    run = MM.register_model(model, f"{out_dir}/registry", metrics)
    published = MM.publish_predictions(MM.score_devices(model, features), f"{out_dir}/predictions",
                                       expected_rows=features.count())
    for key, value in metrics.items():
        print(f"{key}\t{value}")
    print(f"model\t{run}")
    print(f"predictions\t{published.count()}")
    return metrics


if __name__ == "__main__":
    sys.exit(main())

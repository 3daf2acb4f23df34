"""Command line for the five steps, for spark-submit or a local run.

    spark-submit --py-files txengine.zip txengine/__main__.py setup --csv <stage folder>
    spark-submit --py-files txengine.zip txengine/__main__.py features
    python -m txengine analyse --master "local[8]" --query top_spenders --show 10
    python -m txengine ml --master "local[8]" --start 2019-05-25
    python -m txengine assess --master "local[8]"

``--master`` is only for local runs; under spark-submit the cluster decides.
"""

from __future__ import annotations

import argparse

from txengine.plans import handlers, split
from txengine.session import build_session


def main(argv: list[str] | None = None) -> None:
    ap = argparse.ArgumentParser(prog="txengine")
    ap.add_argument("step", choices=["setup", "analyse", "features", "ml", "assess"])
    ap.add_argument("--master", default=None)
    ap.add_argument("--database", default=handlers.Tables.database)
    ap.add_argument("--csv", help="staged CSV files (setup)")
    ap.add_argument("--query", default="top_spenders", help="analysis query (analyse)")
    ap.add_argument("--start", default=split.SplitOptions.start, help="first training day (ml)")
    ap.add_argument("--registry", default=None, help="registry folder (ml)")
    ap.add_argument("--show", type=int, default=20, help="rows to print")
    args = ap.parse_args(argv)

    spark = build_session(args.master)
    t = handlers.Tables(database=args.database)
    if args.step == "setup":
        out = [handlers.setup(spark, args.csv, t)]
    elif args.step == "analyse":
        out = [handlers.analyse(spark, args.query, t)]
    elif args.step == "features":
        out = [handlers.feature_engineering(spark, t)]
    elif args.step == "ml":
        r = handlers.machine_learning(
            spark, t, split.SplitOptions(start=args.start), registry_path=args.registry
        )
        out = [r.scored, r.predicted_fraud]
    else:
        out = list(handlers.model_assessment(spark, t))
    for df in out:
        df.show(args.show, truncate=False)


if __name__ == "__main__":
    main()

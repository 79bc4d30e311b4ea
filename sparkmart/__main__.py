"""Command line: ``python -m sparkmart ingest|segment ...``.

The session is created here (the library functions take one); on a cluster,
submit with ``spark-submit -m sparkmart`` and the cluster's master/confs.
"""

from __future__ import annotations

import argparse
import json
import logging
import sys


def main(argv=None) -> int:
    p = argparse.ArgumentParser(prog="sparkmart")
    sub = p.add_subparsers(dest="cmd", required=True)
    ing = sub.add_parser("ingest", help="raw file → partitioned silver table")
    ing.add_argument("--config", required=True, help="JSON text or @path to a JSON file")
    ing.add_argument("--input", required=True)
    ing.add_argument("--output", required=True)
    ing.add_argument("--dt", default=None, help="execution date yyyy-mm-dd (default today)")
    ing.add_argument("--read-format", default="csv")
    ing.add_argument("--write-format", default="parquet")
    ing.add_argument("--mode", default="overwrite", choices=["overwrite", "append"])
    ing.add_argument("--streaming", action="store_true", help="process new files with Structured Streaming")
    ing.add_argument("--checkpoint-location", default=None)
    seg = sub.add_parser("segment", help="customer segmentation service over a clean fact (parquet)")
    seg.add_argument("--input", required=True)
    seg.add_argument("--root", required=True)
    seg.add_argument("--exec-date", default=None)
    seg.add_argument("--force-train", action="store_true")
    p.add_argument("--master", default=None)
    args = p.parse_args(argv)
    logging.basicConfig(level=logging.INFO, format="%(asctime)s %(levelname)s %(name)s %(message)s")

    from sparkmart.session import get_session
    spark = get_session(args.master)
    if args.cmd == "ingest":
        cfg = args.config
        if cfg.startswith("@"):
            with open(cfg[1:]) as f:
                cfg = f.read()
        cfg = json.loads(cfg)
        if args.streaming:
            from sparkmart.streaming.ingest_stream import start_silver_stream
            ck = args.checkpoint_location or f"{args.output.rstrip('/')}/_stream_checkpoint"
            start_silver_stream(spark, cfg, args.input, args.output, ck, args.dt, args.read_format).awaitTermination()
        else:
            from sparkmart.operators.ingest import run_ingestion
            run_ingestion(spark, cfg, args.input, args.output, args.dt, args.read_format, args.write_format,
                          args.mode)
    else:
        from sparkmart.operators.service import run_segmentation
        out = run_segmentation(spark, spark.read.parquet(args.input), args.root, args.exec_date, args.force_train)
        print(json.dumps({k: v for k, v in out.items() if k != "control"}, default=str))
    return 0


if __name__ == "__main__":
    sys.exit(main())

"""Command line: run the pipeline, or serve the products over HTTP."""

from __future__ import annotations

import argparse

from wayledger.config import load_settings
from wayledger.plans.pipeline import format_result, run_pipeline
from wayledger.session import get_session


def main(argv: list[str] | None = None) -> int:
    parser = argparse.ArgumentParser(prog="wayledger")
    sub = parser.add_subparsers(dest="command", required=True)
    run = sub.add_parser("run", help="load the inbox and build the layers")
    run.add_argument("--full", action="store_true", help="rebuild all days")
    serve = sub.add_parser("serve", help="answer read-only queries over HTTP")
    serve.add_argument("--port", type=int, default=8000)
    args = parser.parse_args(argv)
    settings = load_settings()
    spark = get_session()
    if args.command == "run":
        print(format_result(run_pipeline(spark, settings, args.full)))
    else:
        from wayledger.http_api import make_server

        make_server(spark, settings, args.port).serve_forever()
    return 0


if __name__ == "__main__":
    raise SystemExit(main())

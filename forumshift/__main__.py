"""Run one board migration from parquet folders and publish the result.

    spark-submit -m forumshift --sources s3://bucket/portal --targets s3://bucket/forum \\
        --out s3://bucket/forum-next --module-id 553 [--template-board 1] [--tz-offset -60]

``--sources`` holds one folder per source table (``modules``, ``tab_modules``, ...),
``--targets`` one per target table (``yaf_Board``, ...).  The run's statement outputs are
staged under ``spark.checkpoint.dir`` and removed at the end; what the run added is written under
``--out`` and becomes visible all at once (D8).  A run stopped by ``--upto`` is not published.

``--from-run RUN`` goes on from a published run below ``--targets``: with another module, or -- as its
crosswalk knows the module -- with what the same module's sources have had since (D7).
"""

from __future__ import annotations

import argparse
import dataclasses
import json

from .operators.publish import listed, publish, read_published
from .params import RunParams
from .plans.crosswalk import crosswalk
from .plans.migration import Migration, flows
from .schemas import TARGETS
from .session import build_session
from .sources.tables import read_sources, read_targets


def parse(argv: list[str] | None = None) -> argparse.Namespace:
    ap = argparse.ArgumentParser(prog="forumshift")
    ap.add_argument("--sources", required=True)
    ap.add_argument("--targets", required=True)
    ap.add_argument("--out", required=True)
    ap.add_argument("--from-run", default=None, help="take the targets from this published run below --targets")
    ap.add_argument("--module-id", type=int, required=True)
    ap.add_argument("--template-board", type=int, default=1)
    ap.add_argument("--tz-offset", type=int, default=None, help="minutes added to every date (default: server)")
    ap.add_argument("--source-tz", default=None, help="convert dates from this zone instead of a constant")
    ap.add_argument("--forum-full-depth", action="store_true", help="migrate forums at every depth")
    ap.add_argument("--upto", default=None, help="stop after this flow id (e.g. F27)")
    ap.add_argument("--parallel", action="store_true", help="run independent statement groups concurrently")
    ap.add_argument("--option", action="append", default=[], metavar="NAME=VALUE",
                    help="any RunParams field, e.g. require_posts=true")
    return ap.parse_args(argv)


def _coerce(value: str):
    low = value.lower()
    if low in ("true", "false"):
        return low == "true"
    try:
        return int(value)
    except ValueError:
        return value


def main(argv: list[str] | None = None, spark=None) -> dict:
    args = parse(argv)
    spark = spark or build_session()
    params = RunParams(module_id=args.module_id, template_board_id=args.template_board,
                       tz_offset_min=args.tz_offset, source_tz=args.source_tz, forum_full_depth=args.forum_full_depth)
    extra = dict(o.split("=", 1) for o in args.option)
    params = dataclasses.replace(params, **{k: _coerce(v) for k, v in extra.items()})
    known = None
    if args.from_run is None:
        targets, folders = read_targets(spark, args.targets), {n: [f"{args.targets}/{n}"] for n in TARGETS}
    else:
        targets, folders = read_published(spark, args.targets, args.from_run), listed(spark, args.targets, args.from_run)
        known = targets.pop("crosswalk", None)
        folders.pop("crosswalk", None)
    resumes = known is not None and not known.filter(f"ModuleID = {args.module_id} AND Entity = 'board'").isEmpty()
    m = Migration(spark, read_sources(spark, args.sources), targets, params, crosswalk=known if resumes else None)
    m.run(upto=args.upto, parallel=args.parallel)
    report = {"board_id": m.board_id, "flows": m.done, "timings": m.timings}
    if args.upto is None or len(m.done) == len(flows()):
        changed, rewritten = m.changes()
        run = f"run-{m.run_id}"
        changed["crosswalk"] = crosswalk(m, known)
        unchanged = {n: folders[n] for n in m.tgt.base if n not in rewritten}
        report |= {"run": run, "tables": publish(spark, changed, unchanged, args.out, run)}
    m.drop_staged()
    print(json.dumps(report))
    return report


if __name__ == "__main__":
    main()

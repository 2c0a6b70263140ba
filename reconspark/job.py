"""Command line: runs queries or whole report families and writes details, samples, a summary and a manifest.

Over a data folder of Parquet tables:
    python -m reconspark.job --input DATA --output OUT [--queries a,b] [--format parquet|csv] [--sample 20000] [--rebuild]
Over raw inputs (workbooks by file, folder or pattern, and a dump):
    python -m reconspark.job --orders P --bills P --summaries P --invoices P --dump P --output OUT [--families full,items,bridge,flow]
        [--max-rows N] [--rebuild] [--start 2026-01-01 --end 2026-07-01 --year 2026 --months 6 --span 2025-12,2026-06 --money 0.01 --count 0.000001]
Ingested tables are staged under OUT/stages by inputs and parameters and used again unless --rebuild is given.
"""

from __future__ import annotations

import argparse
import logging

from pyspark.sql import SparkSession

from reconspark.operators.rollup import status_rollup
from reconspark.plans import cleaning, ingest, raw, recon, reports, single
from reconspark.plans.chain import Chain, Scope
from reconspark.session import build_session
from reconspark.sources import exports

FLOW = ("flow_order_bill", "flow_bill_oms", "flow_qty_recon", "flow_field_map", "flow_shop_map", "flow_monthly", "flow_controls")
RAW = ("orders", "bills", "summaries", "invoices", "dump")
log = logging.getLogger("reconspark")


def raw_chain(spark: SparkSession, paths: dict[str, str], scope: Scope, folder: str, max_rows: int | None = None, rebuild: bool = False) -> Chain:
    """The chain over raw inputs, each ingested table staged once for these inputs and parameters."""
    made = ingest.chain_tables(**ingest.read_raw(spark, paths["orders"], paths["bills"], paths["summaries"], paths["invoices"], paths["dump"], max_rows), span=scope.span)
    key = {"paths": paths, "span": scope.span, "max_rows": max_rows}
    tables = {}
    for name in made:
        tables[name] = exports.stage(spark, folder, name, lambda name=name: made[name], rebuild, **key)
        log.info("%s: ingested", name)
    return Chain(spark, tables, scope)


def write_family(chain: Chain, family: str, out: str) -> tuple[dict[str, tuple[str, int, int]], dict]:
    """Ordered CSV and sample of each detail; what was written, and the outcome tables of the family."""
    written = {}
    for d in reports.FAMILIES[family]:
        chain.settle(*([d.step] if d.step in dir(Chain) else []))
        path = f"{out}/{family}_{d.step}.csv"
        rows, sample = exports.write_csv(reports.ordered(chain, d), path), reports.sample(chain, d)
        kept = 0 if sample is None else exports.write_sample(reports.displayed(sample, d.omit), f"{out}/{family}_{d.step}.json", d.limit or rows)
        written[f"{family}_{d.step}"] = (path, rows, kept)
        log.info("%s: %d rows", d.step, rows)
    return written, {f"{family}_{k}": v for k, v in reports.status_tables(chain, family).items()}


def _families(spark: SparkSession, args: argparse.Namespace, out: str) -> tuple[dict, dict]:
    span = tuple(args.span.split(",")) if args.span else None
    scope = Scope(args.money, args.count, args.start, args.end, args.year, args.months, span)
    chain = raw_chain(spark, {k: getattr(args, k) for k in RAW}, scope, f"{out}/stages", args.max_rows, args.rebuild)
    written, summary = {}, {}
    for family in args.families.split(","):
        own, outcomes = write_family(chain, family, out)
        written |= own
        summary |= outcomes
    summary |= {"parameters": reports.parameters(chain), "registry": reports.registry(chain), "mapping_averages": reports.mapping_averages(chain.v["fx_shop_map"]), "top_mappings": reports.top_mappings(chain.v["fx_shop_map"])}
    return written, summary | {"controls": single.chain_controls(chain), "flow_controls": single.chain_flow_controls(chain), "display_metrics": single.chain_display_metrics(chain), "monthly": reports.monthly_sheet(chain), "waterfall": reports.waterfall(chain)}


def _queries(spark: SparkSession, args: argparse.Namespace, out: str) -> tuple[dict, dict]:
    known = cleaning.QUERIES | raw.QUERIES | recon.QUERIES | single.QUERIES
    written, summary = {}, {}
    for name in args.queries.split(","):
        df = exports.stage(spark, f"{out}/stages", name, lambda name=name: known[name](spark, args.input), args.rebuild, input=args.input)
        if args.format == "csv":
            path = f"{out}/{name}.csv"
            rows = exports.write_csv(df.orderBy(*df.columns), path)
        else:
            rows, path = df.count(), f"{out}/stages/{exports.stage_key(name, input=args.input)}"
        written[name] = (path, rows, exports.write_sample(df, f"{out}/{name}.json", args.sample))
        summary[name] = status_rollup(df, []) if "result" in df.columns else df.limit(200)
        log.info("%s: %d rows", name, rows)
    return written, summary


def main(argv: list[str] | None = None) -> int:
    """Entry point; returns the number of faulty report columns."""
    p = argparse.ArgumentParser(description="Reconciliation queries over a data folder or raw inputs")
    p.add_argument("--input")
    for name in RAW:
        p.add_argument(f"--{name}")
    p.add_argument("--output", required=True)
    p.add_argument("--queries", default=",".join(FLOW))
    p.add_argument("--families", default=",".join(reports.FAMILIES))
    p.add_argument("--format", default="parquet", choices=["parquet", "csv"])
    p.add_argument("--sample", type=int, default=20_000)
    p.add_argument("--max-rows", type=int)
    p.add_argument("--workers", default="*")
    p.add_argument("--rebuild", action="store_true")
    known = Scope()
    for name in ("money", "count"):
        p.add_argument(f"--{name}", type=float, default=getattr(known, name))
    for name in ("start", "end", "year"):
        p.add_argument(f"--{name}", default=getattr(known, name))
    p.add_argument("--months", type=int, default=known.months)
    p.add_argument("--span", default=",".join(known.span), help="first and last month of the item steps; empty: all")
    args = p.parse_args(argv)
    missing = [n for n in RAW if not getattr(args, n)]
    if not args.input and missing:
        p.error("--input, or all of --" + ", --".join(RAW))
    logging.basicConfig(level=logging.INFO, format="%(asctime)s %(message)s")
    spark = build_session("reconspark", args.workers)
    out = exports.ensure(args.output)
    written, summary = _queries(spark, args, out) if args.input else _families(spark, args, out)
    exports.write_summary(summary | {"manifest": exports.manifest(spark, written)}, f"{out}/summary.json")
    bad = list(exports.faults(summary))
    for table, column in bad:
        log.warning("%s.%s has values that are no numbers", table, column)
    return len(bad)


if __name__ == "__main__":
    raise SystemExit(main())

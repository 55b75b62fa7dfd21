"""Command line: crosscheck, build, gen, import, picklist-deps."""

from __future__ import annotations

import argparse
import logging
import sys

from pyspark.sql import SparkSession
from pyspark.sql import functions as F

from rowsmith import config as C
from rowsmith.operators import changes, plan
from rowsmith.plans import execution, jobs
from rowsmith.plans.tables import new_path
from rowsmith.sources import lookups, picklists, sheets, sinks, target

log = logging.getLogger("rowsmith")
#: Lines of one kind that are printed.
SHOWN = 1000


def parser() -> argparse.ArgumentParser:
    p = argparse.ArgumentParser("rowsmith", description=__doc__)
    sub = p.add_subparsers(dest="command", required=True)
    for name in ("build", "crosscheck"):
        q = sub.add_parser(name)
        q.add_argument("--input", required=True)
        q.add_argument("--out", required=True)
        q.add_argument("--source", choices=["csv", "recorded", "live", "none"], default="csv")
        q.add_argument("--filter-rep", default="")
        q.add_argument("--filter-period", default="")
        q.add_argument("--dry-run", action="store_true")
        q.add_argument("--parts", action="store_true", help="files in parts instead of one file each")
        if name == "build":
            q.add_argument("--per-row", action="store_true")
            q.add_argument("--master-opp", default="")
    q = sub.add_parser("gen")
    q.add_argument("--out", required=True)
    q.add_argument("--pricebook", default="")
    q.add_argument("--league", default="")
    q.add_argument("--rows", type=int, default=60)
    q = sub.add_parser("import")
    q.add_argument("--sheet", required=True)
    q.add_argument("--pricebook", default="")
    q.add_argument("--accounts", required=True, help="CSV with Id, Name, Website")
    q.add_argument("--companies-csv", default="")
    q.add_argument("--snapshots", default="", help="folder of Parquet snapshots by object")
    q.add_argument("--out", default="", help="where the plan, and with --live the new snapshots, go")
    q.add_argument("--live", action="store_true")
    q.add_argument("--target", default="", help="command-line tool of the target system; with --live the plan is carried out in it")
    q.add_argument("--key-field", default="", help="field of the target that holds reference keys")
    q.add_argument("--journal", default="", help="shared folder from which a stopped run goes on")
    q.add_argument("--calls", type=int, default=8, help="calls of the tool at a time")
    q = sub.add_parser("picklist-deps")
    for a in ("--describe", "--out", "--controller", "--dependent"):
        q.add_argument(a, required=True)
    p.add_argument("--env", default=".env")
    return p


def _session() -> SparkSession:
    return SparkSession.builder.appName("rowsmith").getOrCreate()


def main(args: list[str] | None = None, spark: SparkSession | None = None) -> int:
    """Run a command; 0, or 2 when a source or the price book can't be read."""
    a = parser().parse_args(args)
    C.load_env(a.env)
    settings = C.Settings()
    spark = spark or _session()
    try:
        return {"build": _build, "crosscheck": _crosscheck, "gen": _gen, "import": _import, "picklist-deps": _deps}[a.command](spark, a, settings)
    except (lookups.LookupError_, FileNotFoundError, ValueError) as e:
        print(e, file=sys.stderr)
        return 2


def _build(spark, a, settings) -> int:
    counts = jobs.build(spark, a.input, a.out, settings, a.source, rep=a.filter_rep, period=a.filter_period, per_row=a.per_row, master=a.master_opp, dry_run=a.dry_run, one_file=not a.parts)
    print("\n".join(f"{k}: {v}" for k, v in counts.items()))
    return 0


def _crosscheck(spark, a, settings) -> int:
    rows = sheets.filtered(sheets.deals(spark, a.input), a.filter_rep, a.filter_period)
    c = jobs.crosscheck(spark, rows, settings, None if a.source == "none" else lookups.source(a.source, spark, settings))
    print(c.counts)
    if not a.dry_run:
        sinks.write_csv(sinks.report(c.results), f"{a.out.rstrip('/')}/league_crosscheck", one_file=not a.parts)
    return 0


def _gen(spark, a, settings) -> int:
    settings.pricebook_csv = a.pricebook or settings.pricebook_csv
    print(jobs.order_sheet(spark, settings, a.out, a.league, a.rows))
    return 0


def _import(spark, a, settings) -> int:
    deal = jobs.deal_settings(sheets.load_config(spark, a.sheet))
    rows = sheets.load_orders(spark, a.sheet)
    attached = rows.where("opportunity_id <> ''").limit(1).count() > 0
    if not deal.master_id and not attached and deal.structure != plan.CAMERAS_TO_LEAGUE:
        raise ValueError("the config tab names no master opportunity, and no row a deal")
    book = lookups.currency_pricebook(spark, a.pricebook or settings.pricebook_csv, deal.currency)
    accounts = lookups.read_csv(spark, a.accounts, {"id": ["Id"], "name": ["Name"], "domain": ["Website", "Domain"]})
    others = lookups.companies(spark, a.companies_csv) if a.companies_csv else None
    records, warnings, gone = jobs.plan_import(spark, rows, book, deal, accounts, others)
    if a.target:
        return _carry_out(spark, a, records, warnings, gone)
    schema = "id string, fields map<string,string>"
    snaps = {o: spark.read.schema(schema).parquet(f"{a.snapshots}/{o}") if a.snapshots and lookups.exists(spark, f"{a.snapshots}/{o}") else spark.createDataFrame([], schema) for o in plan.ORDER}
    text, state, done, checks = jobs.run_import(records, snaps, warnings, deal.currency, dry_run=not a.live)
    print(text)
    _left_out(gone)
    if a.out:
        records.write.mode("overwrite").parquet(f"{a.out}/plan")
        warnings.write.mode("overwrite").parquet(f"{a.out}/warnings")
    if a.live and done is not None:
        for name, snap in state.items():
            snap.write.mode("overwrite").parquet(f"{a.out}/{name}")
        checks.write.mode("overwrite").parquet(f"{a.out}/checks")
        _shown(checks.where(F.col("problem").isNotNull()).orderBy("id"), lambda r: f"not verified: {r['problem']}")
    return 0


def _shown(rows, line) -> None:
    """The first rows as lines, and how many more there are; all of them are in the job's tables."""
    for r in rows.limit(SHOWN).collect():
        print(line(r))
    if (more := rows.count() - SHOWN) > 0:
        print(f"... and {more} more")


def _left_out(gone) -> None:
    _shown(gone.orderBy("src_pos"), lambda r: f"left out, known to the other system only: {r['name']}")


def _carry_out(spark, a, records, warnings, gone) -> int:
    """A plan carried out in the system behind a command-line tool; without --live, what would change there."""
    if not a.key_field or a.live and not a.journal:
        raise ValueError("--target needs --key-field, and with --live --journal")
    there = target.Target(a.target, a.key_field)

    def shown(changed) -> bool:
        print(changes.render(changed, warnings))
        return a.live

    _left_out(gone)
    done = execution.execute(records, there, a.journal or new_path(spark, "journal"), shown, a.calls)
    if done is None:
        return 0
    log_, failures = done
    for r in log_.groupBy("sobject", "outcome").agg(F.count("*").alias("n")).orderBy("sobject", "outcome").collect():
        print(f"{r['sobject']} {r['outcome']}: {r['n']}")
    _shown(failures.orderBy("step", "plan_pos"), lambda r: f"{r['step']}: {r['reason']} ({r['id']})")
    if a.out:
        for name, df in (("log", log_), ("failures", failures)):
            df.write.mode("overwrite").parquet(f"{a.out}/{name}")
    return 0


def _deps(spark, a, settings) -> int:
    found = picklists.dependencies(picklists.read_describe(spark, a.describe), a.controller, a.dependent)
    picklists.write_dependencies(found, a.out)
    print(f"{found.count()} controlling values")
    return 0


if __name__ == "__main__":
    sys.exit(main())

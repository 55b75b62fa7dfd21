"""Jobs: crosscheck and build (deals sheet), import (order sheet), order sheet, dependencies."""

from __future__ import annotations

from dataclasses import dataclass
from pathlib import Path

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from rowsmith import config as C
from rowsmith.functions.geo import territory_countries
from rowsmith.operators import changes, clubs, entities, match, plan, products
from rowsmith.plans.tables import written
from rowsmith.sources import lookups, sheets, sinks


@dataclass
class Crosscheck:
    rows: DataFrame
    results: DataFrame
    people: DataFrame
    counts: dict[str, int]


def gather_candidates(spark: SparkSession, settings: C.Settings, source: lookups.LookupSource) -> DataFrame:
    """Curated candidates first, then accounts that look like leagues; missing ids filled by name."""
    curated = lookups.curated_candidates(spark, settings.candidates_csv)
    accounts = match.league_candidates(source.accounts()).withColumn("other_id", F.lit(""))
    pool = entities.priority_union(curated, accounts, "id", "name")
    order = Window.orderBy("pool", "src_pos")  # one pool of candidates, numbered once
    pool = pool.withColumn("src_pos", F.row_number().over(order).cast("long"))
    return entities.attach_ids(pool, lookups.company_ids(spark, settings.company_ids_csv))


def crosscheck(spark: SparkSession, rows: DataFrame, settings: C.Settings, source: lookups.LookupSource | None, names: C.Names | None = None, pool: DataFrame | None = None) -> Crosscheck:
    """Group the deals, match the leagues, resolve the people."""
    rows = written(rows, "deals")
    leagues = entities.group_entities(rows).withColumnRenamed("pasted_id", "pasted_id")
    # Countries over all of a league's territories, not only the distinct cells' first.
    where = F.array_distinct(F.flatten(F.transform("territorys", territory_countries)))
    leagues = leagues.withColumn("countries", where).withColumn("league_pos", F.col("first_pos"))
    if pool is None:
        pool = gather_candidates(spark, settings, source) if source is not None else spark.createDataFrame([], "src_pos long, id string, other_id string, name string, country string")
    results = match.crosscheck(leagues, pool, names, lookups.manual_ids(spark, settings.manual_ids_csv), lookups.deal_aliases(spark, settings.aliases_csv))
    results = written(results, "crosscheck")
    people = entities.resolve_people(rows, lookups.active(source.users())) if source is not None else rows.select("rep_name").distinct().select("rep_name", F.lit(None).cast("string").alias("user_id"), F.lit(None).cast("string").alias("user_name"), F.lit("unmatched").alias("status"))
    counts = entities.status_counts(results).first().asDict()
    return Crosscheck(rows, results, written(people, "people"), counts)


def periods(c: Crosscheck) -> DataFrame:
    """Leagues by period with their match and the first values a deal needs."""
    pos = F.col("src_pos")
    rows = c.rows.join(c.people.select("rep_name", F.col("user_id").alias("owner")), "rep_name", "left")
    grouped = entities.group_entities(rows, ["period"])
    more = entities.with_key(rows).groupBy("league_key", "period").agg(*[entities.first_nonblank(F.col(x), pos).alias(x) for x in ("deal_type", "target_close", "master_opportunity")], F.coalesce(F.min_by("owner", pos), F.lit("")).alias("owner"))
    keep = ["league_key", "match_status", "match_type", "account_ids", "other_ids", "deals", "active_arr"]
    return grouped.join(more, ["league_key", "period"]).join(c.results.select(*keep), "league_key", "left")


def product_lines(c: Crosscheck, book: DataFrame, conf: C.Products | None = None) -> DataFrame:
    """Product lines of each league and period with the amount split over them."""
    per = periods(c).withColumn("key", F.concat_ws("\u0001", "league_key", "period"))
    cells = entities.with_key(c.rows).withColumn("key", F.concat_ws("\u0001", "league_key", "period")).groupBy("key").agg(F.array_join(F.transform(F.array_sort(F.collect_list(F.when(F.col("product") != "", F.struct("src_pos", "product")))), lambda x: x["product"]), ", ").alias("cell"))
    work = written(per.join(cells, "key").withColumn("sport", F.col("primary_sport")), "cells")
    found = products.resolve_cells(work.select("key", "cell", "sport"), book, conf)
    lines = products.with_fallback(products.resolved_products(found, book), work.select("key", "total_arr"), book, conf)
    return products.allocate(lines.join(work.drop("cell", "sport"), "key"), "total_arr")


def build(spark: SparkSession, input_path: str, out: str, settings: C.Settings, kind: str = "csv", names: C.Names | None = None, conf: C.Products | None = None, rep: str = "", period: str = "", per_row: bool = False, master: str = "", dry_run: bool = False, one_file: bool = True) -> dict[str, int]:
    """Deals sheet to import files. Gives row counts by file; a dry run only counts."""
    conf = conf or C.load_products(settings.products_json)
    rows = sheets.filtered(sheets.deals(spark, input_path), rep, period)
    source = None if kind == "none" else lookups.source(kind, spark, settings)
    c = crosscheck(spark, rows, settings, source, names)
    book = written(lookups.pricebook(spark, settings.pricebook_csv), "pricebook")
    new, existing = sinks.split_accounts(c.results)
    if per_row:
        base = entities.with_key(c.rows).join(c.results.select("league_key", "display_name", "match_status", "account_ids", "first_pos"), "league_key").join(c.people.select("rep_name", F.col("user_id").alias("owner")), "rep_name", "left")
        deals = sinks.opportunity_row_file(base, settings, master)
        work = base.withColumn("key", F.col("src_pos").cast("string"))
        found = products.resolved_products(products.resolve_cells(work.select("key", F.col("product").alias("cell"), "sport"), book, conf), book).where("line = 1")
        own = work.select("key", "period", "display_name", "match_status", "account_ids", F.col("src_pos").alias("first_pos"), F.col("product").alias("cell"), F.col("arr_eur").alias("allocated"))
        lines = sinks.product_file(found.join(own, "key"), settings, per_row=True)
    else:
        deals = sinks.opportunity_file(periods(c), settings, master)
        lines = sinks.product_file(product_lines(c, book, conf), settings)
    files = {"account_new": sinks.account_file(new, settings), "account_existing": sinks.account_file(existing, settings), "contact": sinks.contact_file(c.results), "opportunity": deals, "opp_product": lines, "league_crosscheck": sinks.report(c.results)}
    counts = {}
    for name, df in files.items():
        df = written(df, name)
        counts[name] = df.count()
        if not dry_run:
            sinks.write_csv(df, f"{out.rstrip('/')}/{name}", one_file=one_file)
    return counts


def plan_import(spark: SparkSession, rows: DataFrame, book: DataFrame, deal: plan.Deal, accounts: DataFrame, other_companies: DataFrame | None = None, names: C.Names | None = None, shipping: DataFrame | None = None) -> tuple[DataFrame, DataFrame, DataFrame]:
    """(plan, warnings, left out): order rows matched to accounts, clubs that only another system knows left out, planned."""
    roster = rows.select("src_pos", F.col("team").alias("name"), F.element_at(F.split("contact_email", "@"), -1).alias("domain"), "pinned_id")
    found = written(clubs.match(roster, accounts, names=names), "club-matches")
    decided = written(clubs.account_decision(found), "decisions")
    gone = spark.createDataFrame([], roster.schema)
    if other_companies is not None:
        gone = written(clubs.known_elsewhere(roster, decided, other_companies, names=names), "left-out")
        rows = rows.join(gone.select("src_pos"), "src_pos", "left_anti")
    records, warnings = plan.build(rows, book, deal, decided, shipping)
    review = decided.where(F.size("review") > 0).select(F.lit(0).cast("long").alias("src_pos"), F.concat("truth_name", F.lit(": several accounts: "), F.array_join("review", ", ")).alias("warning"))
    return written(records, "plan"), written(warnings.select(F.col("src_pos").cast("long").alias("src_pos"), "warning").unionByName(review), "warnings"), gone


def deal_settings(config: dict[str, str], **more) -> plan.Deal:
    """An import's settings from the config tab; several labels of the same choice are understood."""
    get = lambda *n, default="": C.config_value(config, *n, default=default)
    first = get("structure", default="1")[:1]
    price = get("subscription discount")
    return plan.Deal(
        structure=int(first) if first in "123" and first else 1, master_id=get("master", "id"), currency=get("currency", default="EUR"), gender=get("gender"), voucher=get("voucher").lower() in ("yes", "true", "1", "y"),
        subscription_pricing=get("subscription pricing", default="list"), camera_pricing=get("cameras pricing", default="list"), billing_period=get("billing period", default="Annual"), owner=get("owner"),
        stage=get("stage", default="Closed Won"), forecast=get("forecast", default="Closed"), master_shipping=get("shipping").lower() in ("yes", "true", "1", "y"), subscription_discounts={"*": float(price)} if price else {}, **more,
    )


def order_sheet(spark: SparkSession, settings: C.Settings, out: str, league: str = "", rows: int = 60) -> str:
    """Write an empty order sheet with the price book's products in its dropdowns."""
    names = lookups.products_by_family(lookups.pricebook(spark, settings.pricebook_csv)).collect()  # as many as a dropdown holds
    pick = lambda f: [r["product"] for r in names if r["family"] == f]
    Path(out).parent.mkdir(parents=True, exist_ok=True)
    Path(out).write_bytes(sinks.order_sheet(pick("subscription"), pick("camera"), league, rows, ["Center", "Left", "Right"], ["Soccer", "Basketball", "Ice Hockey", "Handball"]))
    return out


def run_import(records: DataFrame, snapshots: dict[str, DataFrame], warnings: DataFrame, currency: str, confirm=lambda changes: True, dry_run: bool = True):
    """Preflight, change list, and unless a dry run, application and verification. Gives (text, state, log, verification)."""
    checks = changes.preflight(records, snapshots, currency).select(F.lit(0).cast("long").alias("src_pos"), "warning")
    listed = changes.render(changes.changeset(records, None if dry_run else snapshots), warnings.unionByName(checks))
    if dry_run:
        return listed, snapshots, None, None
    done = changes.apply_plan(records, snapshots, confirm)
    if done is None:
        return listed, snapshots, None, None
    state, log = done
    want = changes.expected_lines(records, log).join(log.where("outcome <> 'skipped'").select(F.col("ref_key").alias("ref"), "id", "label"), "ref", "left").select(F.coalesce("id", "ref").alias("id"), F.coalesce("label", "ref").alias("label"), "expected")
    n = state["line"].groupBy(F.col("fields")["opportunity_id"].alias("id")).agg(F.count("*").alias("line_count"))
    get = lambda k: F.try_element_at("fields", F.lit(k))
    now = state["opportunity"].select("id", get("name").alias("name"), get("stage").alias("stage"), get("currency").alias("currency"), get("amount").alias("amount")).join(n, "id", "left")
    return listed, state, log, changes.verify(want, now, currency)

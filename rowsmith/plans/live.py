"""Queries over a target system that is reached through a command-line tool: the rehearsal tool, which keeps its records in the shared folder."""

from __future__ import annotations

import shlex
import sys

from pyspark.sql import functions as F

from rowsmith.operators import plan
from rowsmith.plans import execution
from rowsmith.plans.loads import _CLUBS, DEAL, book, clubs
from rowsmith.plans.registry import T, query
from rowsmith.plans.tables import new_path, written
from rowsmith.sources import command, rehearsal, target


def rehearsed(spark, name: str) -> target.Target:
    """An empty target system of the rehearsal tool, in the shared folder (which has to be mounted: the tool is no Spark program)."""
    folder = new_path(spark, name).removeprefix("file://").removeprefix("file:")
    if not folder.startswith("/"):
        raise ValueError(f"the rehearsal tool needs a mounted folder, not {folder}")
    return target.Target(shlex.join([sys.executable, "-S", rehearsal.__file__, folder]), rehearsal.KEY, collection_path="/services/data/v67.0/composite/sobjects")


@query(f"""with {_CLUBS}, n as (select count(*) as n, count(*) filter (where email <> '') as c, count(*) filter (where k % 2 = 0) as even, count(*) filter (where k % 2 = 0 and email <> '') as even_c from clubs)
select v.run, v.sobject, v.outcome, v.n from n x, lateral (values (1, 'account', 'created', x.n), (1, 'contact', 'created', x.c), (1, 'opportunity', 'created', x.n), (1, 'line', 'created', 4 * x.n),
 (2, 'account', 'updated', x.even), (2, 'account', 'reused', x.n - x.even), (2, 'contact', 'updated', x.even_c), (2, 'contact', 'reused', x.c - x.even_c), (2, 'opportunity', 'reused', x.n), (2, 'line', 'reused', 4 * x.n),
 (3, 'account', 'held', x.n), (3, 'contact', 'held', x.c), (3, 'opportunity', 'held', x.n), (3, 'line', 'held', 4 * x.n), (3, 'account', 'new phone', x.even), (3, 'contact', 'new phone', x.even_c), (3, 'account', 'roles', x.c), (3, 'line', 'position', 2 * x.n)) v(run, sobject, outcome, n) where v.n > 0""")
def live_execution(spark, d):
    """A plan carried out through a command-line tool, then one with other phone numbers: what was created, updated and found again by its key, and what the tool holds at last."""
    there = rehearsed(spark, "live")
    c = clubs(spark, d).withColumns({"customer_id": F.lit(""), "opportunity_id": F.lit("")})
    phone = F.when(F.col("src_pos") % 2 == 0, F.concat(F.lit("1"), F.col("src_pos").cast("string"))).otherwise("")
    out = None
    for run, rows in enumerate((c, c.withColumn("contact_phone", phone)), 1):
        records = written(plan.build(rows, book(spark, d), DEAL)[0], "plan")
        log, _ = execution.execute(records, there, new_path(spark, "journal"))
        part = log.groupBy("sobject", "outcome").agg(F.count("*").alias("n")).select(F.lit(run).alias("run"), "sobject", "outcome", "n")
        out = part if out is None else out.unionByName(part)
    new = F.startswith(F.coalesce(F.try_element_at("fields", F.lit("invoice_phone")), F.try_element_at("fields", F.lit("phone")), F.lit("")), F.lit("1"))
    kinds = F.array_compact(F.array(F.lit("held"), F.when(new, "new phone"), F.when(F.map_contains_key("fields", "it_responsible"), "roles"), F.when(F.map_contains_key("fields", "position"), "position")))
    names = execution.plan_fields(records)
    for sobject in plan.ORDER:
        held = target.snapshot(spark, there, sobject, names[sobject], tasks=3, page=50)
        out = out.unionByName(held.select(F.explode(kinds).alias("outcome")).groupBy("outcome").agg(F.count("*").alias("n")).select(F.lit(3).alias("run"), F.lit(sobject).alias("sobject"), "outcome", "n"))
    return written(out, "live-outcomes")


@query("""with s as (select s_suppkey as k, s_name as name, 'SUP_' || left(sha256('S' || s_suppkey), 32) as id from supplier)
select k, name, row_number() over (order by id) as place, case when k % 2 = 1 then name end as looked_up from s""")
def live_scan(spark, d):
    """Records of a target system, scanned in ranges of ids by several tasks, page by page, in order; every other one looked up again, many to a query."""
    there = rehearsed(spark, "scanned")
    s = T(spark, d, "supplier")
    key = F.concat(F.lit("S"), F.col("s_suppkey").cast("string"))
    new = s.select(F.col("s_suppkey").alias("plan_pos"), key.alias("ref_key"), F.lit("supplier").alias("sobject"), F.col("s_name").alias("label"), F.lit("created").alias("outcome"), F.lit("").alias("id"), F.create_map(F.lit("Name"), F.col("s_name")).alias("fields"))
    made = target.sent(new, there, new_path(spark, "sent"))
    ask = f"{there.command} data query --json --query"
    rows = written(command.records(spark, ask, "supplier", ["Id", "Name"], tasks=4, page=40).select(F.monotonically_increasing_id().alias("at"), "Id", "Name"), "scanned")
    place = _placed(rows)
    odd = command.point_records(made.where("plan_pos % 2 = 1").select("id"), ask, "supplier", ["Name"], tasks=4).select("Id", F.col("Name").alias("looked_up"))
    out = place.join(odd, "Id", "left").join(made.select(F.col("id").alias("Id"), F.col("plan_pos").alias("k")), "Id")
    return written(out.select("k", F.col("Name").alias("name"), "place", "looked_up"), "live-scan")


def _placed(rows):
    """Rows (at, Id, Name) with their place 1..n in the order of ``at``, whose upper bits are the task that read them."""
    task = F.shiftright("at", 33)
    n = rows.groupBy(task.alias("task")).agg(F.count("*").alias("n"))
    lower = n.select(F.col("task").alias("t"), "n").join(n.select("task"), F.col("t") < F.col("task")).groupBy("task").agg(F.sum("n").alias("before"))  # a row a task
    j = rows.withColumn("task", task).join(lower, "task", "left")
    return j.select("Id", "Name", (F.coalesce("before", F.lit(0)) + F.col("at").bitwiseAND(F.lit((1 << 33) - 1)) + 1).alias("place"))


def _put(rows, there: target.Target, sobject: str) -> None:
    """Rows (key, fields) as records of the rehearsal tool's folder, as it would keep them."""
    folder = shlex.split(there.command)[-1]

    def run(batches):
        for batch in batches:
            for key, fields in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), strict=True):
                rehearsal.create(folder, sobject, dict(fields) | {rehearsal.KEY: key})
            yield batch.select([0])

    rows.select("key", "fields").mapInArrow(run, "key string").count()


@query("""with c as (select c_custkey as k, c_name as name, n_name as country from customer join nation on n_nationkey = c_nationkey)
select 'account' as kind, name, case when k % 4 = 1 then 'Federation' else '' end as kind_of, country as at from c where k % 4 = 1 union all select 'account', 'Liga ' || k, 'Club', country from c where k % 4 = 2
 union all select 'user', name, 'u' || k || '@x.example', '' from c where k % 3 > 0 union all select 'company', case when k % 4 = 2 then 'Liga ' || k else name end, '', 'https://www.c' || k || '.example' from c
 union all select 'record', name, 'Owner ' || k, '' from c where k = (select min(k) from c where k % 4 <> 2)""")
def live_lookups(spark, d):
    """Accounts that look like leagues, active users, all companies, and one record with a parent's field, from a live system in ranges and pages."""
    there = rehearsed(spark, "lookups")
    c = T(spark, d, "customer").join(T(spark, d, "nation"), F.col("n_nationkey") == F.col("c_nationkey"))
    k = F.col("c_custkey")
    key = k.cast("string")
    name = F.when(k % 4 == 2, F.concat(F.lit("Liga "), key)).otherwise(F.col("c_name"))
    pairs = {"Name": name, "BillingCountry": F.col("n_name"), "Kind__c": F.when(k % 4 == 1, "Federation").when(k % 4 == 2, "Club").otherwise("Shop"), "Sport__c": F.lit(""), "Website": F.concat(F.lit("https://www.c"), key, F.lit(".example")), "OwnerName": F.concat(F.lit("Owner "), key)}
    fields = lambda p: F.create_map(*[x for n, v in p.items() for x in (F.lit(n), v)])
    accounts = c.select(F.concat(F.lit("A"), key).alias("key"), fields(pairs).alias("fields"))
    users = c.select(F.concat(F.lit("U"), key).alias("key"), fields({"Name": F.col("c_name"), "Email": F.concat(F.lit("u"), key, F.lit("@x.example")), "IsActive": F.when(k % 3 > 0, "true").otherwise("false")}).alias("fields"))
    _put(accounts, there, "Account")
    _put(users, there, "User")
    source = command.LiveSource(spark, f"{there.command} data query --json --query", org_type_field="Kind__c", tasks=4, page=200)
    blank = F.lit("")
    out = source.accounts().select(F.lit("account").alias("kind"), "name", F.col("org_type").alias("kind_of"), F.col("country").alias("at"))
    out = out.unionByName(source.users().select(F.lit("user").alias("kind"), "name", F.col("email").alias("kind_of"), blank.alias("at")))
    out = out.unionByName(source.companies().select(F.lit("company").alias("kind"), "name", blank.alias("kind_of"), F.col("domain").alias("at")))
    first = c.where(k % 4 != 2).agg(F.min("c_custkey")).first()[0]
    if first is not None:
        one = source.record("Account", rehearsal.identity("Account", f"A{first}"), ["Name", "OwnerName"])
        out = out.unionByName(spark.createDataFrame([("record", one["Name"], one["OwnerName"], "")], "kind string, name string, kind_of string, at string"))
    return written(out, "live-lookups")

"""From plan to changes: diffs against snapshots, preflight checks, staged application, verification.

The target system is a snapshot per object: (id, fields map). Applying a plan here gives new
snapshots and a log, and writes nothing outside tables; ``plans.execution`` carries the same
decisions out in a live system."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from rowsmith.functions.text import text
from rowsmith.operators.plan import ORDER, by_object
from rowsmith.plans.tables import written

#: Parents without which a record is still made.
OPTIONAL = ("primary_contact", "system_admin")


def field_diff(desired: DataFrame, current: DataFrame, key: str = "id", skip: tuple[str, ...] = ("name",)) -> DataFrame:
    """(key, field, old, new): fields of ``desired`` (key, fields map) that differ as text from ``current``. Fields not desired are never touched."""
    want = desired.select(key, F.explode("fields").alias("field", "new")).where(~F.col("field").isin(*skip))
    have = current.select(key, F.col("fields").alias("_now"))
    j = want.join(have, key, "left").withColumn("old", F.coalesce(F.try_element_at("_now", "field"), F.lit("")))
    return j.where(F.col("old") != F.coalesce("new", F.lit(""))).select(key, "field", "old", "new")


def changeset(plan: DataFrame, snapshots: dict[str, DataFrame] | None = None) -> DataFrame:
    """One row per record: plan_pos, sobject, label, change (create, update, reuse) and what changes.

    Without snapshots (a dry run) every known record counts as updated from an unknown value."""
    desired = plan.where("operation = 'upsert' and sf_id <> ''").select("plan_pos", "sobject", F.col("sf_id").alias("id"), F.map_concat("fields", F.map_filter("parents", lambda k, v: ~F.map_contains_key("fields", k))).alias("fields"))
    if snapshots is None:
        diff = desired.select("plan_pos", F.explode("fields").alias("field", "new")).where("field <> 'name'").withColumn("old", F.lit("<current?>"))
    else:
        now = None
        for name, snap in snapshots.items():
            part = snap.select(F.lit(name).alias("sobject"), "id", F.col("fields").alias("now"))
            now = part if now is None else now.unionByName(part)
        each = desired.select("plan_pos", "sobject", "id", F.explode("fields").alias("field", "new")).where("field <> 'name'").join(now, ["sobject", "id"], "left")
        diff = each.withColumn("old", F.coalesce(F.try_element_at("now", "field"), F.lit(""))).where("old <> new").select("plan_pos", "field", "new", "old")
    d = diff.groupBy("plan_pos").agg(F.array_sort(F.collect_list(F.struct("field", "old", "new"))).alias("diff"))
    known = (F.col("operation") == "upsert") & (F.col("sf_id") != "")
    kind = F.when(~known, "create").when(F.size("diff") > 0, "update").otherwise("reuse")
    out = plan.select("plan_pos", "sobject", "label", "operation", "sf_id").join(d, "plan_pos", "left")
    return out.withColumn("diff", F.coalesce("diff", F.expr("cast(array() as array<struct<field:string,old:string,new:string>>)"))).withColumn("change", kind)


def render(changes: DataFrame, warnings: DataFrame | None = None, most: tuple[int, int, int, int] = (200, 200, 50, 1000)) -> str:
    """The change list for review: counts, the first creates, updates, reuses and warnings; the tables have all of them."""
    out = ["CHANGE LIST"]
    counts = {(r["change"], r["sobject"]): r["n"] for r in changes.groupBy("change", "sobject").agg(F.count("*").alias("n")).collect()}  # a few kinds
    for kind, limit, sign in zip(("create", "update", "reuse"), most[:3], "+~=", strict=True):
        mine = {k[1]: n for k, n in sorted(counts.items()) if k[0] == kind}
        out.append(f"{kind.upper()}: {sum(mine.values())} " + " ".join(f"{k}={n}" for k, n in mine.items()))
        for r in changes.where(F.col("change") == kind).orderBy("plan_pos").limit(limit).collect():
            what = ", ".join(f"{d['field']}: {d['old']!r} -> {d['new']!r}" for d in r["diff"])
            out.append(f"  {sign} {r['sobject']:12} {r['label']}" + (f": {what}" if what else ""))
    if warnings is not None:
        out += [f"  ! {r['warning']}" for r in warnings.orderBy("src_pos", "warning").limit(most[3]).collect()]
        if (more := warnings.count() - most[3]) > 0:
            out.append(f"  ! ... and {more} more")
    return "\n".join(out)


def line_counts(plan: DataFrame) -> DataFrame:
    """(ref, planned): lines of each deal reference."""
    return by_object(plan, "line").groupBy(F.coalesce(F.col("parents")["opportunity_id"], F.lit("")).alias("ref")).agg(F.count("*").alias("planned"))


def _warnings(df: DataFrame, *checks: Column) -> DataFrame:
    return df.select("label", F.explode(F.array_compact(F.array(*checks))).alias("warning"))


def deal_preflight(attach: DataFrame, existing: DataFrame, currency: str) -> DataFrame:
    """(label, warning): attach (id, label, planned) against existing (id, stage, is_closed, currency, line_count)."""
    c = F.col
    j = attach.join(existing.withColumn("_there", F.lit(True)), "id", "left")
    there = c("_there").isNotNull()
    return _warnings(
        j,
        F.when(~there, F.concat("label", F.lit(": deal "), "id", F.lit(" not found"))),
        F.when(there & (c("line_count") > 0), F.concat("label", F.lit(": has "), c("line_count").cast("string"), F.lit(" line(s), this run adds "), c("planned").cast("string"))),
        F.when(there & (F.lit(currency) != "") & (text(c("currency")) != "") & (c("currency") != currency), F.concat("label", F.lit(": currency "), "currency", F.lit(f" is not {currency}"))),
        F.when(there & c("is_closed"), F.concat("label", F.lit(": already closed ("), text(c("stage")), F.lit(")"))),
    )


def contact_preflight(contacts: DataFrame, existing: DataFrame) -> DataFrame:
    """(label, warning): contacts (email, label, pinned) whose email is on other accounts of existing (id, email, account_id) only."""
    c = F.col
    j = contacts.where(text(c("pinned")) != "").withColumn("low", F.lower(text(c("email")))).join(existing.select(F.lower(text(c("email"))).alias("low"), c("id").alias("cid"), text(c("account_id")).alias("aid")), "low")
    g = j.groupBy("label", "email", "pinned").agg(F.bool_or(c("aid") == c("pinned")).alias("on_pinned"), F.min(F.when((c("aid") != "") & (c("aid") != c("pinned")), F.struct("cid", "aid"))).alias("other"))
    return _warnings(g, F.when(~c("on_pinned") & c("other").isNotNull(), F.concat("label", F.lit(": "), "email", F.lit(" is on account "), c("other.aid"), F.lit(", not "), "pinned")))


def duplicate_names(pinned: DataFrame, accounts: DataFrame) -> DataFrame:
    """(label, warning): pinned (id, name, label) whose name other accounts (id, name) share."""
    shared = accounts.groupBy("name").agg(F.array_sort(F.collect_set("id")).alias("ids")).where(F.size("ids") > 1)
    j = pinned.join(shared, "name")
    return _warnings(j, F.concat("label", F.lit(": "), F.size("ids").cast("string"), F.lit(" accounts share the name "), "name", F.lit("; also "), F.array_join(F.array_remove("ids", F.col("id")), ", ")))


def preflight(plan: DataFrame, snapshots: dict[str, DataFrame], currency: str) -> DataFrame:
    """All warnings about a plan before it is applied."""
    get = lambda d, k: F.coalesce(F.try_element_at("fields", F.lit(k)), F.lit(""))
    lines_now = snapshots["line"].groupBy(F.col("fields")["opportunity_id"].alias("id")).agg(F.count("*").alias("line_count"))
    deals = snapshots["opportunity"].select("id", get(None, "stage").alias("stage"), (get(None, "is_closed") == "true").alias("is_closed"), get(None, "currency").alias("currency")).join(lines_now, "id", "left").fillna(0, ["line_count"])
    opps = by_object(plan, "opportunity").where("operation = 'upsert'").select(F.col("sf_id").alias("id"), "label", "ref_key").join(line_counts(plan).withColumnRenamed("ref", "ref_key"), "ref_key", "left").fillna(0, ["planned"])
    pinned = by_object(plan, "account").where("sf_id <> ''")
    people = by_object(plan, "contact").withColumn("ref_key2", F.col("parents")["account_id"]).join(pinned.select(F.col("ref_key").alias("ref_key2"), F.col("sf_id").alias("pinned")), "ref_key2").select(F.col("fields")["email"].alias("email"), "label", "pinned").where(text(F.col("email")) != "")
    known = snapshots["contact"].select("id", get(None, "email").alias("email"), get(None, "account_id").alias("account_id"))
    names = snapshots["account"].select("id", get(None, "name").alias("name"))
    mine = pinned.select(F.col("sf_id").alias("id"), "label").join(names, "id")
    return deal_preflight(opps.select("id", "label", "planned"), deals, currency).unionByName(contact_preflight(people, known)).unionByName(duplicate_names(mine, names))


def contact_actions(contacts: DataFrame, existing: DataFrame) -> DataFrame:
    """(key, action, contact_id): create, reuse (on the same account), adopt (on none) or flag (on another).

    contacts: (key, email, account_id); existing: (id, email, account_id)."""
    c = F.col
    e = existing.select(text(c("email")).alias("email"), c("id").alias("cid"), text(c("account_id")).alias("aid")).where("email <> ''")
    j = contacts.join(e, "email", "left")
    g = j.groupBy("key").agg(F.min(F.when(c("aid") == c("account_id"), c("cid"))).alias("same"), F.min(F.when(c("aid") == "", c("cid"))).alias("free"), F.min("cid").alias("any"))
    action = F.when(c("same").isNotNull(), "reuse").when(c("free").isNotNull(), "adopt").when(c("any").isNotNull(), "flag").otherwise("create")
    return g.select("key", action.alias("action"), F.coalesce("same", "free", "any", F.lit("")).alias("contact_id"))


def single_match(records: DataFrame, snapshot: DataFrame, field: str) -> DataFrame:
    """(plan_pos, id): records whose field equals that of exactly one existing row."""
    have = snapshot.select(F.col("fields")[field].alias("v"), "id").where("v <> ''").groupBy("v").agg(F.count("*").alias("n"), F.min("id").alias("id")).where("n = 1")
    return records.select("plan_pos", F.col("fields")[field].alias("v")).join(have, "v").select("plan_pos", "id")


def resolve_parents(records: DataFrame, ids: DataFrame) -> DataFrame:
    """Records with ``resolved`` (parents as ids; a value that is no planned reference stays) and ``blocked``
    (a required parent was skipped); optional parents that were skipped drop out. ids: (ref, id, skipped)."""
    each = records.select("plan_pos", F.explode_outer("parents").alias("field", "ref")).join(ids, "ref", "left")
    optional = F.col("field").isin(*OPTIONAL)
    known = F.coalesce("id", "ref")
    ok = F.col("field").isNotNull() & ~F.coalesce("skipped", F.lit(False))
    g = each.groupBy("plan_pos").agg(
        F.map_from_entries(F.collect_list(F.when(ok, F.struct("field", known)))).alias("resolved"),
        F.coalesce(F.bool_or(F.col("field").isNotNull() & ~optional & F.coalesce("skipped", F.lit(False))), F.lit(False)).alias("blocked"),
    )
    return records.join(g, "plan_pos")


def follow_ups(plan: DataFrame, log: DataFrame) -> DataFrame:
    """(plan_pos, id, fields): values that a target system takes only once a record is there: a line's position, which
    depends on its sport, and a deal's start date."""
    made = log.where("outcome in ('created', 'updated', 'reused')").select("plan_pos", "id", "outcome")
    late = F.when(F.col("sobject") == "line", "position").when(F.col("sobject") == "opportunity", "effective_start")
    rows = plan.withColumn("late", late).where("late is not null").join(made, "plan_pos").where("sobject = 'opportunity' or outcome = 'created'")
    value = F.try_element_at("fields", F.col("late"))
    return rows.where(value.isNotNull()).select("plan_pos", "id", F.create_map("late", value).alias("fields"))


def decided(plan: DataFrame, level: str, now: DataFrame, log: DataFrame | None, unique: str | None = None) -> DataFrame:
    """What is to become of one level's records, given what the target holds of it (``now``: id, fields) and the ``log`` of
    earlier levels: plan_pos, ref_key, sobject, label, outcome, id, reason, want (fields, parents resolved), diff (those
    that differ), named (whether the plan names an existing record). New ids are 128 bits of their reference key's digest."""
    c = F.col
    rows = by_object(plan, level)
    if log is None:
        rows = rows.withColumn("resolved", F.expr("cast(map() as map<string,string>)")).withColumn("blocked", F.lit(False))
    else:
        ids = log.groupBy(c("ref_key").alias("ref")).agg(F.min("id").alias("id"), F.bool_and(c("outcome") == "skipped").alias("skipped"))
        rows = resolve_parents(rows, ids)
    rows = rows.withColumn("want", F.map_concat("fields", F.map_filter("resolved", lambda k, v: ~F.map_contains_key("fields", k))))
    fresh = F.concat(F.lit(level[:3].upper() + "_"), F.left(F.sha2("ref_key", 256), F.lit(32)))
    if level == "contact":
        acts = contact_actions(rows.select(c("plan_pos").alias("key"), text(c("fields")["email"]).alias("email"), text(c("resolved")["account_id"]).alias("account_id")), now.select("id", c("fields")["email"].alias("email"), c("fields")["account_id"].alias("account_id")))
        rows = rows.join(acts.withColumnRenamed("key", "plan_pos"), "plan_pos").withColumn("sf_id", c("contact_id"))
        # A reused contact takes only the phone, an adopted one the account, too.
        keep = F.when(c("action") == "reuse", F.map_filter("want", lambda k, v: k == "phone")).when(c("action") == "adopt", F.map_filter("want", lambda k, v: k.isin("phone", "account_id"))).otherwise(c("want"))
        rows = rows.withColumn("want", keep).withColumn("blocked", c("blocked") | (c("action") == "flag")).withColumn("reason0", F.when(c("action") == "flag", "email on another account"))
    else:
        rows = rows.withColumn("reason0", F.lit(None).cast("string"))
    if unique:
        same = now.select(F.try_element_at("fields", F.lit(unique)).alias("uv"), c("id").alias("uid")).where("uv <> ''").groupBy("uv").agg(F.count("*").alias("un"), F.min("uid").alias("uid"))
        rows = rows.withColumn("uv", F.try_element_at("fields", F.lit(unique))).join(same, "uv", "left")
        hit = (c("sf_id") == "") & c("un").isNotNull()
        rows = rows.withColumns({"blocked": c("blocked") | F.coalesce(hit & (c("un") > 1), F.lit(False)), "reason0": F.when(hit & (c("un") > 1), "several duplicates").otherwise(c("reason0")), "want": F.when(hit, F.expr("cast(map() as map<string,string>)")).otherwise(c("want")), "sf_id": F.when(hit & (c("un") == 1), c("uid")).otherwise(c("sf_id"))})
    rows = rows.withColumn("id", F.when(c("sf_id") != "", c("sf_id")).otherwise(fresh)).join(now.select(c("id").alias("now_id"), c("fields").alias("now")), c("id") == c("now_id"), "left")
    rows = rows.withColumn("want", F.when(c("now_id").isNotNull() & (c("sf_id") != ""), F.map_filter("want", lambda k, v: k != "name")).otherwise(c("want")))
    rows = rows.withColumn("diff", F.map_filter("want", lambda k, v: F.coalesce(F.try_element_at("now", k), F.lit("")) != v))
    outcome = F.when(c("blocked"), "skipped").when(c("now_id").isNull(), "created").when(F.size("diff") > 0, "updated").otherwise("reused")
    rows = rows.withColumn("outcome", outcome).withColumn("reason", F.when(c("blocked"), F.coalesce("reason0", F.lit("parent not created"))))
    return rows.select("plan_pos", "ref_key", "sobject", "label", "outcome", "id", "reason", "want", "diff", (c("sf_id") != "").alias("named"))


def role_lookups(plan: DataFrame, log: DataFrame) -> DataFrame:
    """(plan_pos, id, fields): accounts' role lookups, only where all of their contacts are there."""
    c = F.col
    ids = log.where("outcome <> 'skipped'").groupBy(c("ref_key").alias("ref")).agg(F.min("id").alias("rid"))
    roles = by_object(plan, "account").join(log.where("sobject = 'account' and outcome <> 'skipped'").select("plan_pos", "id"), "plan_pos")
    roles = roles.select("plan_pos", "id", F.explode("deferred").alias("field", "ref")).join(ids, "ref", "left")
    ready = roles.groupBy("plan_pos", "id").agg(F.count("*").alias("n"), F.count("rid").alias("m"), F.map_from_entries(F.collect_list(F.when(c("rid").isNotNull(), F.struct("field", "rid")))).alias("fields"))
    return ready.where("n = m").select("plan_pos", "id", "fields")


def apply_plan(plan: DataFrame, snapshots: dict[str, DataFrame], confirm: Callable[[DataFrame], bool] = lambda changes: True, unique: dict[str, str] | None = None) -> tuple[dict[str, DataFrame], DataFrame] | None:
    """Apply a plan level by level: accounts, contacts, deals, lines, then deferred account lookups.

    Gives new snapshots and a log (plan_pos, ref_key, sobject, label, outcome, id, reason); None if not confirmed.
    New ids come from reference keys, so applying again gives the same ids and no two records share one. ``unique`` names, by
    object, a field that the target holds unique: a record to be created whose value exactly one existing
    record has is that record; if several have it, the record is skipped. ``plans.execution`` applies a plan to a live system."""
    if not confirm(changeset(plan, snapshots)):
        return None
    state = dict(snapshots)
    log = None
    for level in ORDER:
        rows = written(decided(plan, level, state[level], log, (unique or {}).get(level)).drop("diff", "named"), f"applied-{level}")
        state[level] = upsert(state[level], rows.where("outcome in ('created', 'updated')").select("plan_pos", "id", F.col("want").alias("fields")))
        part = rows.drop("want")
        log = part if log is None else log.unionByName(part)
    state["account"] = upsert(state["account"], role_lookups(plan, log))
    return state, log


def upsert(snapshot: DataFrame, changes: DataFrame) -> DataFrame:
    """A snapshot (id, fields) with changes (plan_pos, id, fields) laid over it; later records win."""
    each = changes.select("id", "plan_pos", F.explode("fields").alias("k", "v")).groupBy("id", "k").agg(F.max_by("v", "plan_pos").alias("v"))
    new = each.groupBy("id").agg(F.map_from_entries(F.collect_list(F.struct("k", "v"))).alias("new"))
    j = snapshot.join(new, "id", "full")
    empty = F.expr("cast(map() as map<string,string>)")
    old, add = F.coalesce("fields", empty), F.coalesce("new", empty)
    return j.select("id", F.map_concat(F.map_filter(old, lambda k, v: ~F.map_contains_key(add, k)), add).alias("fields"))


def verify(targets: DataFrame, state: DataFrame, currency: str) -> DataFrame:
    """(id, label, name, stage, currency, amount, actual, expected, flag, problem) of targets (id, label, expected).

    state: (id, name, stage, currency, amount, line_count)."""
    c = F.col
    j = targets.join(state.withColumn("_there", F.lit(True)), "id", "left")
    actual = F.coalesce("line_count", F.lit(0))
    problem = (
        F.when(c("_there").isNull(), F.concat("label", F.lit(": deal "), "id", F.lit(" not found")))
        .when(actual < c("expected"), F.concat("label", F.lit(": only "), actual.cast("string"), F.lit("/"), c("expected").cast("string"), F.lit(" lines")))
        .when((F.lit(currency) != "") & (text(c("currency")) != "") & (c("currency") != currency), F.concat("label", F.lit(": currency "), "currency", F.lit(f" is not {currency}")))
    )
    return j.select("id", "label", F.coalesce(F.when(text(c("name")) != "", c("name")), c("label")).alias("name"), "stage", "currency", "amount", actual.alias("actual"), "expected", F.when(problem.isNull(), "ok").otherwise("bad").alias("flag"), problem.alias("problem"))


def expected_lines(plan: DataFrame, log: DataFrame) -> DataFrame:
    """(ref, expected): lines that each deal should have got, skipped ones left out."""
    gone = log.where("outcome = 'skipped'").select("plan_pos")
    return line_counts(plan.join(gone, "plan_pos", "left_anti")).withColumnRenamed("planned", "expected")


def order_of(df: DataFrame, keys: list[str], order: list[Column]) -> DataFrame:
    """Rows with 1..N within their group."""
    return df.withColumn("sequence", F.row_number().over(Window.partitionBy(*keys).orderBy(*order)))

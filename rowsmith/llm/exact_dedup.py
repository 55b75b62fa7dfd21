"""Exact duplicates by deterministic block naming, in DataFrame functions only.

Each text is cut into fixed-size blocks of bytes. Equal blocks get one integer name;
then names of adjacent blocks are paired, equal pairs get one integer name, and so on
until each document has a single name. A name of level k stands for one sequence of at
most 2**k blocks and for no other, so (level, name) is equal exactly for equal texts:
no hash decides anything.

Naming sorts the blocks and takes for each run of equal ones the smallest place number
as its name. Blocks cross the network once for it. A block that makes up more than
a task's share of all (one in ``HOT_SHARE``, or in the number of shuffle partitions if that is
larger; no more blocks than shares can) is first split by a salt and named inside (block,
salt); one representative per salt then gets the common name, and this small table is joined back.
Each level is written as a table, so a lost executor never costs more than one level.

Edge cases: null and empty texts are one text of no blocks, equal to each other; a
null doc_id stays only if its group has no other id; of repeated rows with the largest
doc_id exactly one stays; an empty table gives an empty result; other columns are
ignored or, by ``drop_exact_duplicates``, passed through.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from rowsmith.llm._io import materialize, text_of

BLOCK_BYTES = 4096
#: Parts that a run of very many equal blocks is first split into.
SALTS = 256
#: A block is hot if it occurs more often than one in this many of all blocks (or in the number of partitions), and often enough to matter.
HOT_SHARE = 1024
HOT_COUNT = 2000
UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"


def normalised(text: Column) -> Column:
    """A to Z in lower case, nothing else changed. lower() does just that to pure ASCII."""
    return F.when(F.octet_length(text) == F.length(text), F.lower(text)).otherwise(F.translate(text, UPPER, LOWER))


def named(rows: DataFrame, content: list[str], place: str) -> DataFrame:
    """``rows`` with ``name`` in place of the columns ``content``: the smallest ``place`` of an equal content.

    ``place`` numbers the rows uniquely. Fingerprints only pick the contents that are split; names come from contents."""
    kept = [c for c in rows.columns if c not in content]
    rows = rows.withColumn("_print", F.xxhash64(*content))
    counts = rows.groupBy("_print").agg(F.count("*").alias("_n"))
    shares = max(HOT_SHARE, int(rows.sparkSession.conf.get("spark.sql.shuffle.partitions")))
    hot = counts.where(F.col("_n") >= HOT_COUNT).join(counts.agg(F.sum("_n").alias("_all")), F.expr(f"_n * {shares} >= _all"))
    prints = [r[0] for r in hot.select("_print").collect()]  # at most as many numbers as there are shares
    if not prints:
        return rows.withColumn("name", F.min(place).over(Window.partitionBy(*content))).select(*kept, "name")
    salt = F.when(F.col("_print").isin(prints), F.pmod(F.xxhash64(place), F.lit(SALTS)) + 1).otherwise(0)
    local = rows.withColumn("_salt", salt).withColumn("_local", F.min(place).over(Window.partitionBy(*content, "_salt")))
    # One representative of a hot content per salt: two numbers for each share and salt at most, 40 MB for 10,000 shares.
    chosen = local.where((F.col("_salt") > 0) & (F.col("_local") == F.col(place))).select(*content, F.col("_local").alias("_rep"))
    names = chosen.withColumn("name", F.min("_rep").over(Window.partitionBy(*content))).select("_rep", "name")
    out = local.select(*kept, "_local").join(F.broadcast(names), F.col("_local") == F.col("_rep"), "left")
    return out.select(*kept, F.coalesce("name", "_local").alias("name"))


def identities(docs: DataFrame, block_bytes: int = BLOCK_BYTES) -> DataFrame:
    """Per row: doc_id, row, text_sha256, level, name; (level, name) is equal exactly for equal normalised texts."""
    texts = docs.select("doc_id", normalised(text_of("text")).alias("t"))
    rows = texts.select("doc_id", F.monotonically_increasing_id().alias("row"), F.sha2("t", 256).alias("text_sha256"), F.col("t").cast("binary").alias("bytes"))
    blocks = F.greatest(F.lit(1), F.ceil(F.octet_length("bytes") / block_bytes)).cast("int")
    rows = rows.withColumn("blocks", blocks).withColumn("pos", F.explode(F.sequence(F.lit(0), F.col("blocks") - 1)))
    rows = rows.select(
        "row", "pos", "blocks",
        F.when(F.col("pos") == 0, F.col("doc_id")).alias("doc_id"),
        F.when(F.col("pos") == 0, F.col("text_sha256")).alias("text_sha256"),
        F.monotonically_increasing_id().alias("place"),
        F.substring(F.col("bytes"), F.col("pos") * block_bytes + 1, F.lit(block_bytes)).alias("block"),
    )
    level = materialize(named(rows, ["block"], "place"), "block-names")
    heads = level.where("pos = 0").select("row", "doc_id", "text_sha256")
    # Texts of one block have their identity; the others go on, halving.
    done = level.where("blocks = 1").select("row", F.lit(0).alias("level"), "name")
    rest = level.where("blocks > 1").select("row", "pos", "blocks", "name", "place")
    longest = rest.agg(F.max("blocks")).first()[0] or 1
    for k in range(1, (longest - 1).bit_length() + 1):
        half = F.shiftright("pos", 1)
        even, odd = F.col("pos") % 2 == 0, F.col("pos") % 2 == 1
        pairs = rest.groupBy("row", half.alias("pos"), F.shiftright(F.col("blocks") + 1, 1).alias("blocks")).agg(
            F.max(F.when(even, F.col("name"))).alias("left"), F.coalesce(F.max(F.when(odd, F.col("name"))), F.lit(-1)).alias("right"), F.max(F.when(even, F.col("place"))).alias("place"))
        level = materialize(named(pairs, ["left", "right"], "place"), f"pair-names-{k}")
        done = done.unionByName(level.where("blocks = 1").select("row", F.lit(k).alias("level"), "name"))
        rest = level.where("blocks > 1")
    return heads.join(done, "row")


def exact_duplicates(docs: DataFrame, block_bytes: int = BLOCK_BYTES) -> DataFrame:
    """Per row of ``docs`` (doc_id, text): doc_id, keep_id, group_size, kept, text_sha256."""
    rows = materialize(identities(docs, block_bytes), "identities")
    best = F.struct("doc_id", (-F.col("row")).alias("first"))
    groups = rows.groupBy("level", "name").agg(F.max(best).alias("best"), F.count("*").alias("group_size"))
    # Only groups of several; written, so that the join can split a large group's rows over tasks.
    groups = materialize(groups.where("group_size > 1").select(F.col("level").alias("l"), F.col("name").alias("n"), "best", "group_size"), "copies")
    out = rows.join(groups, (F.col("level") == F.col("l")) & (F.col("name") == F.col("n")), "left")
    alone = F.col("best").isNull()
    kept = alone | (F.col("best.first") == -F.col("row"))
    keep_id = F.when(alone, F.col("doc_id")).otherwise(F.col("best.doc_id"))
    return out.select("doc_id", keep_id.alias("keep_id"), F.coalesce("group_size", F.lit(1).cast("long")).alias("group_size"), kept.alias("kept"), "text_sha256", "row")


def drop_exact_duplicates(docs: DataFrame) -> DataFrame:
    """The rows of ``docs`` (doc_id, text, any others) that stay, with all their columns."""
    found = materialize(exact_duplicates(docs).select("doc_id", "kept", "text_sha256"), "exact")
    same = lambda a, b: a["doc_id"].eqNullSafe(b["doc_id"])
    gone = found.where("not kept").select("doc_id").distinct()
    staying = found.where("kept").select("doc_id", "text_sha256")
    # Ids that stand on rows of both kinds (repeated rows): one row of each text that stays.
    both = staying.join(gone, same(staying, gone), "left_semi").distinct()
    out = docs.join(gone, same(docs, gone), "left_anti")
    sha = F.sha2(normalised(text_of("text")), 256)
    again = docs.withColumn("_sha", sha)
    again = again.join(both, same(again, both) & (again["_sha"] == both["text_sha256"]), "left_semi").dropDuplicates(["doc_id", "_sha"])
    return out.unionByName(again.select(*docs.columns))


SQL = """
with d as (select doc_id, translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') as t from documents),
g as (select *, max(doc_id) over (partition by t) as keep_id, count(*) over (partition by t) as group_size from d)
select doc_id, keep_id, group_size::bigint as group_size, doc_id = keep_id as kept, sha256(t) as text_sha256 from g
"""

"""Rules that wait: a rule that reads a derived field which no compiled rule defines.

Blocking passes along the definitions, so this is the one iterative operator. A field waits on the
fields its defining rule reads. Most rules read one field and most fields have one rule, which makes
chains; the end of every chain is found by pointer doubling, twice a round, so a chain of n rules takes
log4(n) rounds. What is left are the fields where chains meet: those of rules that read several fields, and
those that several rules define. Over these alone the lost fields spread level by level, from the new
ones of the last level. In the end each rule meets the lost fields it reads, once.

Each round is a table written to the folder the cluster shares: it cuts the lineage, survives lost
executors, and tells the planner its size.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Observation
from pyspark.sql import functions as F

from clauseloom.session import shared_path


def blocked_rules(definitions: DataFrame, uses: DataFrame) -> DataFrame:
    """(rule_id, field): each blocked rule with a field it waits for, the first by name of those it
    reads and that are lost.

    `definitions` has (rule_id, field, open): what a rule defines, null when nothing, and whether
    its sentence has an open question; a rule that defines several fields has several rows. A field is
    lost when none of the rules that define it is left.
    `uses` has (rule_id, field), the derived fields a rule reads. Rules that wait on each other and on
    nothing lost are not blocked.
    """
    keep = _Tables(definitions)
    compiled = definitions.where(~F.col("open"))
    pairs = compiled.where(F.col("field").isNotNull()).select("rule_id", "field").distinct()
    reads = keep(
        uses.select("rule_id", "field").distinct().join(
            compiled.select("rule_id").distinct(), "rule_id", "left_semi"
        ),
        "reads",
    )
    fields = keep(_fields(pairs, reads), "fields")
    ends = _chain_ends(fields.where("chained").select("field", F.col("only").alias("target")), keep)
    undefined = reads.select("field").distinct().join(fields.select("field"), "field", "left_anti")
    lost = keep(undefined, "lost/round=00000")
    if not fields.where("meets").isEmpty():
        lost = _spread(lost, keep(_meetings(pairs, reads, fields, ends), "meetings"), keep)
    along = ends.join(lost.select(F.col("field").alias("target")), "target").select("field")
    return reads.join(lost.unionByName(along), "field").groupBy("rule_id").agg(F.min("field").alias("field"))


class _Tables:
    """Writes tables of this run below one folder and reads them again."""

    def __init__(self, frame: DataFrame):
        self.spark = frame.sparkSession
        self.folder = shared_path(self.spark, "blocked")

    def __call__(self, frame: DataFrame, name: str) -> DataFrame:
        frame.write.parquet(f"{self.folder}/{name}")
        return self.read(name, frame.schema)

    def read(self, name: str, schema) -> DataFrame:
        """A table, or all rounds of one."""
        return self.spark.read.schema(schema).parquet(f"{self.folder}/{name}").select(*schema.names)


def _fields(pairs: DataFrame, reads: DataFrame) -> DataFrame:
    """(field, n_definers, chained, only, meets): whether one rule defines the field and reads one field
    only, and which; whether it is a field where chains meet. Counts and minima combine before the shuffle."""
    defined = pairs.groupBy("field").agg(F.count("*").alias("n_definers"), F.min("rule_id").alias("rule_id"))
    read = reads.groupBy("rule_id").agg(F.count("*").alias("n_read"), F.min("field").alias("only"))
    chained = (F.col("n_definers") == 1) & F.coalesce(F.col("n_read") == 1, F.lit(False))
    meets = ~chained & ((F.col("n_definers") > 1) | F.col("n_read").isNotNull())
    return defined.join(read, "rule_id", "left").select(
        "field", "n_definers", chained.alias("chained"), "only", meets.alias("meets")
    )


def _chain_ends(ends: DataFrame, keep: _Tables) -> DataFrame:
    """(field, target): the end of each chain, a field that is no link of one, from (field, target) of
    every link. A round doubles the reach of every pointer twice. When as many pointers moved as in the
    round before, those left run in circles: they point to links, which are never lost by themselves."""
    before, rounds = -1, 0
    while True:
        rounds += 1
        moved = Observation()
        ends = keep(
            _doubled(_doubled(ends).select("field", "target")).observe(moved, F.sum("moved").alias("n")),
            f"ends-{rounds:05d}",
        ).select("field", "target")
        n = moved.get["n"] or 0
        if n in (0, before):
            return ends
        before = n


def _doubled(ends: DataFrame) -> DataFrame:
    step = ends.select(F.col("field").alias("target"), F.col("target").alias("further"))
    return ends.join(step, "target", "left").select(
        "field", F.coalesce("further", "target").alias("target"), F.col("further").isNotNull().cast("int").alias("moved")
    )


def _meetings(pairs: DataFrame, reads: DataFrame, fields: DataFrame, ends: DataFrame) -> DataFrame:
    """(field, rule_id, n_definers, target): what the rules of fields that are no link wait on, with
    each chain taken to its end."""
    open_fields = fields.where("meets").select("field", "n_definers")
    waits = pairs.join(open_fields, "field").join(
        reads.select("rule_id", F.col("field").alias("read")), "rule_id"
    )
    taken = waits.join(ends.select(F.col("field").alias("read"), "target"), "read", "left")
    return taken.select("field", "rule_id", "n_definers", F.coalesce("target", "read").alias("target")).distinct()


def _spread(undefined: DataFrame, meetings: DataFrame, keep: _Tables) -> DataFrame:
    """All lost fields that are no links: the undefined ones, and those whose rules all wait on a lost
    one. A rule counts once, in the round that blocks it."""
    new, rounds = undefined, 0
    while not new.isEmpty():
        rounds += 1
        hit = meetings.join(new.select(F.col("field").alias("target")), "target").select(
            "field", "rule_id", "n_definers").distinct()
        if rounds > 1:
            earlier = keep.read("stopped", hit.schema).select("field", "rule_id")
            hit = hit.join(earlier, ["field", "rule_id"], "left_anti")
        hit = keep(hit, f"stopped/round={rounds:05d}")
        all_hit = keep.read("stopped", hit.schema).join(hit.select("field").distinct(), "field", "left_semi")
        gone = all_hit.groupBy("field", "n_definers").agg(F.count("*").alias("n"))
        new = keep(gone.where("n = n_definers").select("field"), f"lost/round={rounds:05d}")
    return keep.read("lost", undefined.schema)

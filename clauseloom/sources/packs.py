"""Rule packs: receipts, decision models in two formats, questions and answers, change lists.

Every reader has two halves: one finds files and brings them as (pack, body) rows, the other turns
such rows into relations. The second half also serves bodies that come from a table, so thousands
of packs are one read.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from clauseloom.sources.questions import question_rows

RECEIPT = (
    "kind string, sentence_id string, source string, source_sha256 string, quote string,"
    " node string, field string, applies_when string, requirement string, expression string,"
    " rows array<string>, content_sha256 string,"
    " dmn struct<decision:string,applies_when:string,requirement:string,expression:string,"
    "rules:array<string>>"
)
RECEIPTS_FILE = (
    "links array<struct<sentence_id:string,kind:string,target:string,cited_as:string,quote:string>>,"
    f" rules map<string,struct<{RECEIPT}>>,"
    " sentences map<string,struct<source:string,state:string>>,"
    " sources map<string,struct<sha256:string>>"
)
MODEL_FILE = (
    "nodes array<struct<id:string,type:string,name:string,content:struct<hitPolicy:string,"
    "outputPath:string,expressions:array<struct<id:string,key:string,value:string>>,"
    "rules:array<map<string,string>>>>>,"
    " edges array<struct<id:string,sourceId:string,targetId:string>>"
)
DMN_FILE = (
    "decision array<struct<_id:string,_name:string,"
    "informationRequirement:array<struct<requiredInput:struct<_href:string>,"
    "requiredDecision:struct<_href:string>>>,"
    "literalExpression:struct<text:string>,"
    "decisionTable:struct<_hitPolicy:string,rule:array<struct<_id:string,description:string,"
    "inputEntry:array<struct<text:string>>,outputEntry:array<struct<text:string>>>>>>>"
)
CHANGES_FILE = "added array<string>, changed array<string>, retired array<string>, previous string"


def read_bodies(spark: SparkSession, paths) -> DataFrame:
    """(pack, body): whole files, the pack named by the folder a file lies in."""
    return spark.read.text(paths, wholetext=True).select(
        F.regexp_extract(F.col("_metadata.file_path"), "^(.*)/[^/]+$", 1).alias("pack"),
        F.col("value").alias("body"),
    )


def _exploded(frame: DataFrame, column: Column | str, names: tuple[str, ...]) -> DataFrame:
    """Outer, with the empty row dropped after: the plain form would parse each body twice."""
    rows = frame.select("pack", F.explode_outer(column).alias(*names))
    return rows.where(F.col(names[0]).isNotNull())


def receipt_tables(bodies: DataFrame) -> dict[str, DataFrame]:
    """Receipts files as relations: receipt, link, sentence_state, source."""
    parsed = bodies.select("pack", F.from_json("body", RECEIPTS_FILE).alias("f"))
    rules = _exploded(parsed, "f.rules", ("rule_id", "r"))
    links = _exploded(parsed, "f.links", ("l",))
    states = _exploded(parsed, "f.sentences", ("sentence_id", "s"))
    sources = _exploded(parsed, "f.sources", ("source", "s"))
    return {
        "receipt": rules.select("pack", "rule_id", "r.*"),
        "link": links.select("pack", "l.*"),
        "sentence_state": states.select("pack", "sentence_id", "s.source", "s.state"),
        "source": sources.select("pack", "source", "s.sha256"),
    }


def model_tables(bodies: DataFrame) -> dict[str, DataFrame]:
    """Decision graphs as relations: node, edge, row, derived_node."""
    parsed = bodies.select("pack", F.from_json("body", MODEL_FILE).alias("f"))
    nodes = _exploded(parsed, "f.nodes", ("n",))
    edges = _exploded(parsed, "f.edges", ("e",))
    tables = nodes.where(F.col("n.type") == "decisionTableNode")
    expressions = nodes.where(F.col("n.type") == "expressionNode")
    rows = tables.select(
        "pack", F.col("n.id").alias("node_id"), F.col("n.content.outputPath").alias("output_path"),
        F.col("n.content.hitPolicy").alias("hit_policy"), F.explode_outer("n.content.rules").alias("row"),
    ).where(F.col("row").isNotNull())
    return {
        "node": nodes.select("pack", F.col("n.id").alias("node_id"), "n.type", "n.name"),
        "edge": edges.select(
            "pack", F.col("e.id").alias("edge_id"),
            F.col("e.sourceId").alias("source_id"), F.col("e.targetId").alias("target_id"),
        ),
        "row": rows.select(
            "pack", "node_id", "output_path", "hit_policy",
            F.col("row")["_id"].alias("row_id"),
            F.col("row")["i1"].alias("i1"),
            F.col("row")["i2"].alias("i2"),
            _literal(F.col("row")["o1"]).alias("rule_id"),
            _literal(F.col("row")["o2"]).alias("result"),
        ),
        "derived_node": expressions.select(
            "pack", F.col("n.id").alias("node_id"),
            F.explode_outer("n.content.expressions").alias("x"),
        ).where(F.col("x").isNotNull()).select(
            "pack", "node_id", F.col("x.key").alias("field"), F.col("x.value").alias("expression")
        ),
    }


def _literal(cell: Column) -> Column:
    """The value of a cell that holds one JSON literal."""
    return F.get_json_object(F.concat(F.lit("["), cell, F.lit("]")), "$[0]")


def dmn_tables(bodies: DataFrame) -> dict[str, DataFrame]:
    """DMN files as relations: decision (with what it requires) and rule.

    The schema is given: inference would read cells such as `true` as booleans.
    """
    parsed = bodies.select("pack", F.from_xml(F.col("body"), DMN_FILE).alias("f"))
    decisions = _exploded(parsed, "f.decision", ("d",))
    needs = F.transform(
        "d.informationRequirement",
        lambda r: F.regexp_replace(F.coalesce(r["requiredInput"]["_href"], r["requiredDecision"]["_href"]), "^#", ""),
    )
    kind = F.when(F.col("d.literalExpression").isNotNull(), "literal").otherwise("table")
    rules = decisions.select(
        "pack", F.col("d._id").alias("decision"), F.explode_outer("d.decisionTable.rule").alias("r")
    ).where(F.col("r").isNotNull())

    def cell(entries: str, i: int) -> Column:
        return F.get(F.col(entries), i)["text"]

    return {
        "decision": decisions.select(
            "pack", F.col("d._id").alias("decision"), F.col("d._name").alias("name"),
            kind.alias("kind"), F.col("d.literalExpression.text").alias("text"),
            needs.alias("requires"),
        ),
        "rule": rules.select(
            "pack", "decision", F.col("r._id").alias("xml_id"), "r.description",
            cell("r.inputEntry", 0).alias("applies_when"),
            cell("r.inputEntry", 1).alias("requirement"),
            F.size("r.inputEntry").alias("n_inputs"),
            F.size("r.outputEntry").alias("n_outputs"),
            _unquoted(cell("r.outputEntry", 0)).alias("rule_id"),
            _unquoted(cell("r.outputEntry", 1)).alias("result"),
        ),
    }


def _unquoted(text: Column) -> Column:
    inner = F.regexp_extract(F.trim(text), r'^"([\s\S]*)"$', 1)
    return F.when(
        F.trim(text).rlike(r'^"[\s\S]*"$'), F.replace(inner, F.lit('\\"'), F.lit('"'))
    ).otherwise(F.trim(text))


def change_rows(bodies: DataFrame) -> DataFrame:
    """Change lists as (pack, change, rule_id, previous)."""
    parsed = bodies.select("pack", F.from_json("body", CHANGES_FILE).alias("f"))
    kinds = F.array(
        *[F.struct(F.lit(k).alias("change"), F.col(f"f.{k}").alias("ids")) for k in ("added", "changed", "retired")]
    )
    listed = parsed.select("pack", "f.previous", F.explode(kinds).alias("k"))
    return listed.select(
        "pack", "k.change", F.explode_outer("k.ids").alias("rule_id"), "previous"
    ).where(F.col("rule_id").isNotNull())


def unreadable(bodies: DataFrame, name: str = "pack", body: str = "body", form: str = "json") -> DataFrame:
    """(check, subject, detail): files of one form (json, xml, yaml) that do not parse, or JSON files whose
    top is no object. Readers make no rows of them, so without this finding an unreadable pack would look
    sound."""
    text = F.col(body)
    blank = F.trim(F.coalesce(text, F.lit(""))) == ""
    if form == "yaml":
        rows = question_rows(bodies.select(F.col(name).alias("pack"), text.alias("body")))
        lost = rows.where(F.col("part") == "unreadable").select(F.col("pack").alias("subject"), F.col("text").alias("detail"))
        none = bodies.where(blank).select(F.col(name).alias("subject"), F.lit("empty file").alias("detail"))
        found = lost.unionByName(none)
    else:
        fails = F.json_object_keys(text).isNull() if form == "json" else corrupt_xml(text).isNotNull()
        found = bodies.where(blank | fails).select(
            F.col(name).alias("subject"),
            F.when(blank, "empty file").otherwise("not a JSON object" if form == "json" else "not an XML document").alias("detail"),
        )
    return found.select(
        F.lit("unreadable").alias("check"), F.col("subject").cast("string").alias("subject"), "detail"
    )


def corrupt_xml(body: Column) -> Column:
    """The text of a model file that does not parse; null for one that does."""
    schema = f"{DMN_FILE}, _corrupt string"
    return F.from_xml(body, schema, {"mode": "PERMISSIVE", "columnNameOfCorruptRecord": "_corrupt"})["_corrupt"]


def unreadable_files(spark: SparkSession, folder: str) -> DataFrame:
    """Every file of the packs under `folder` that cannot be read, with its pack."""
    forms = {"json": ["receipts.json", "rules.jdm.json", "changes.json"], "xml": ["rules.dmn"],
             "yaml": ["questions.yaml", "answers.yaml"]}
    parts = []
    for form, files in forms.items():
        parts.append(unreadable(read_bodies(spark, [f"{folder}/{f}" for f in files]), form=form))
    return parts[0].unionByName(parts[1]).unionByName(parts[2])


def read_pack(spark: SparkSession, folder: str) -> dict[str, DataFrame]:
    """All relations of the packs under `folder`, which may be a glob over many packs."""
    out = dict(receipt_tables(read_bodies(spark, f"{folder}/receipts.json")))
    out.update(model_tables(read_bodies(spark, f"{folder}/rules.jdm.json")))
    dmn = dmn_tables(read_bodies(spark, f"{folder}/rules.dmn"))
    out.update({"decision": dmn["decision"], "dmn_rule": dmn["rule"]})
    out["change"] = change_rows(read_bodies(spark, f"{folder}/changes.json"))
    out["question"] = question_rows(read_bodies(spark, [f"{folder}/questions.yaml", f"{folder}/answers.yaml"]))
    return out

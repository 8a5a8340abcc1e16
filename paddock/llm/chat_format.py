"""Chat formatting with schema fingerprints. DataFrame operations only.

Records come as JSON in whatever layout. A record's *fingerprint* is the hash of its nested field paths
(types left out). A table of layouts, keyed by fingerprint, says where turns, roles, texts and order
are; records of one layout are converted by its mapping, without any look at their values. The
layouts' own fingerprints come from an example record each, by the same expression. Records of an
unknown layout are returned by ``unknown``, never guessed.

The canonical turns are formatted with ``<turn:ROLE>\\n`` before and ``</turn>\\n`` after each. In roles and
texts every backslash becomes ``\\b`` and every ``<`` becomes ``\\l`` (in roles ``>`` becomes ``\\g``, too), so no
text can hold a control string, and undoing the replacements in reverse gives the text back. Offsets of the assistant's
texts in the formatted string are the loss mask.

Nulls: a null role or text is empty; a null conversation number is a conversation of its own; a null turn number
comes first. Turns with the same number are ordered by role, then text. Repeated rows are repeated turns.
"""

from __future__ import annotations

import json

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

# layout: example record, path of the array of turns (None: the record is one turn), and the paths within it.
# "order" null: the place in the array. "fixed" lists turns as (role, path) instead.
LAYOUTS = {
    "turn rows": ({"conv_id": 1, "turn": 1, "role": "", "text": ""}, None, {"role": "$.role", "text": "$.text", "order": "$.turn"}),
    "messages": ({"conv_id": 1, "messages": [{"role": "", "content": ""}]}, "$.messages", {"role": "$.role", "text": "$.content"}),
    "conversations": ({"conv_id": 1, "conversations": [{"from": "", "value": ""}]}, "$.conversations", {"role": "$.from", "text": "$.value"}),
    "prompt": ({"conv_id": 1, "prompt": "", "completion": ""}, None, [("user", "$.prompt"), ("assistant", "$.completion")]),
    "preference": ({"conv_id": 1, "prompt": "", "chosen": "", "rejected": ""}, None, [("user", "$.prompt"), ("assistant", "$.chosen")]),
    "instruction": ({"conv_id": 1, "instruction": "", "output": ""}, None, [("user", "$.instruction"), ("assistant", "$.output")]),
    "instruction with input": ({"conv_id": 1, "instruction": "", "input": "", "output": ""}, None,
                               [("user", "$.instruction"), ("user", "$.input"), ("assistant", "$.output")]),
    "question": ({"conv_id": 1, "system": "", "question": "", "response": ""}, None,
                 [("system", "$.system"), ("user", "$.question"), ("assistant", "$.response")]),
}
ROLES = {"human": "user", "gpt": "assistant", "bot": "assistant", "model": "assistant"}  # other names stay
LOSS_ROLE = "assistant"
END = "</turn>\n"
_TURNS = "array<struct<role:string,text:string,ord:bigint>>"


def fingerprint(record: Column) -> Column:
    """Hash of the nested field paths of a variant; leaf types (and null leaves) don't count."""
    paths = F.regexp_replace(F.schema_of_variant(record), r": (?!OBJECT<|ARRAY<)[A-Z]+(\([0-9, ]+\))?", "")
    return F.xxhash64(F.regexp_replace(paths, r"ARRAY<VOID>", "ARRAY<>"))


def _examples(spark: SparkSession) -> DataFrame:
    rows = spark.createDataFrame([(name, json.dumps(example)) for name, (example, _, _) in LAYOUTS.items()], "layout string, example string")
    return rows.select("layout", fingerprint(F.parse_json("example")).alias("print"))


def _value(v: Column, path: str, kind: str = "string") -> Column:
    return F.variant_get(v, path, kind)


def _turn_of(paths: dict):
    return lambda v, i: F.struct(_value(v, paths["role"]).alias("role"), _value(v, paths["text"]).alias("text"), i.cast("long").alias("ord"))


def _mapped(record: Column) -> Column:
    """The turns of a record by its layout."""
    out = F.lit(None).cast(_TURNS)
    for name, (_, at, paths) in LAYOUTS.items():
        if isinstance(paths, list):
            turns = F.array(*[F.struct(F.lit(role).alias("role"), _value(record, path).alias("text"), F.lit(i).cast("long").alias("ord"))
                              for i, (role, path) in enumerate(paths)])
        elif at is None:
            turns = F.array(F.struct(_value(record, paths["role"]).alias("role"), _value(record, paths["text"]).alias("text"),
                                     _value(record, paths["order"], "bigint").alias("ord")))
        else:
            turns = F.transform(_value(record, at, "array<variant>"), _turn_of(paths))
        out = F.when(F.col("layout") == name, turns.cast(_TURNS)).otherwise(out)
    return out


def _with_layout(spark: SparkSession, records: DataFrame, json_column: str) -> DataFrame:
    v = records.withColumn("_v", F.parse_json(json_column))
    # one row per layout: broadcast, whatever the data
    return v.withColumn("print", fingerprint(F.col("_v"))).join(F.broadcast(_examples(spark)), "print", "left")


def canonical_turns(spark: SparkSession, records: DataFrame, json_column: str = "record") -> DataFrame:
    """conv_id, ord, role, text, one row per turn, of the records (a column of JSON) with a known layout."""
    known = _with_layout(spark, records, json_column).filter("layout is not null")
    turns = known.select(_value(F.col("_v"), "$.conv_id", "bigint").alias("conv_id"), F.explode(_mapped(F.col("_v"))).alias("t"))
    # a condition on the role keeps the rest as it is
    named = F.create_map(*[F.lit(x) for pair in ROLES.items() for x in pair])
    role = F.coalesce(named[F.col("t.role")], F.col("t.role"), F.lit(""))
    return turns.select("conv_id", F.col("t.ord").alias("ord"), role.alias("role"), F.coalesce("t.text", F.lit("")).alias("text"))


def unknown(spark: SparkSession, records: DataFrame, json_column: str = "record") -> DataFrame:
    """The records whose layout isn't known."""
    return _with_layout(spark, records, json_column).filter("layout is null").select(*records.columns)


def escaped(text: Column) -> Column:
    return F.replace(F.replace(text, F.lit("\\"), F.lit("\\b")), F.lit("<"), F.lit("\\l"))


def unescaped(text: Column) -> Column:
    return F.replace(F.replace(text, F.lit("\\l"), F.lit("<")), F.lit("\\b"), F.lit("\\"))


def escaped_role(role: Column) -> Column:
    """A role's end mark can't occur in it either."""
    return F.replace(escaped(role), F.lit(">"), F.lit("\\g"))


def unescaped_role(role: Column) -> Column:
    return unescaped(F.replace(role, F.lit("\\g"), F.lit(">")))


def formatted(turns: DataFrame) -> DataFrame:
    """conv_id, formatted, loss: [start, length] in code points of each text under the loss mask."""
    head = F.concat(F.lit("<turn:"), escaped_role(F.col("role")), F.lit(">\n"))
    pieces = turns.select("conv_id", "ord", "role", "text", F.concat(head, escaped(F.col("text")), F.lit(END)).alias("piece"),
                          F.length(head).alias("head"), F.length(escaped(F.col("text"))).alias("len"))
    order = Window.partitionBy("conv_id").orderBy("ord", "role", "text")
    pieces = pieces.select("conv_id", "role", "piece", "head", "len", F.row_number().over(order).alias("i"),
                           (F.sum(F.length("piece")).over(order.rowsBetween(Window.unboundedPreceding, 0)) - F.length("piece")).alias("at"))
    mask = F.when(F.col("role") == LOSS_ROLE, F.struct((F.col("at") + F.col("head")).cast("int").alias("start"), F.col("len").cast("int").alias("length")))
    grouped = pieces.groupBy("conv_id").agg(F.array_sort(F.collect_list(F.struct("i", "piece"))).alias("p"),
                                            F.array_sort(F.collect_list(mask)).alias("loss"))
    return grouped.select("conv_id", F.array_join(F.col("p.piece"), "").alias("formatted"), "loss")


def read_back(out: DataFrame) -> DataFrame:
    """The turns and the texts under the loss mask, read from formatted strings alone."""
    parts = F.split("formatted", F.lit("</turn>\n"))
    turns = F.transform(F.slice(parts, F.lit(1), F.size(parts) - 1), lambda p: F.struct(
        unescaped_role(F.substring_index(F.substr(p, F.lit(7)), ">\n", 1)).alias("role"),
        unescaped(F.substr(p, F.instr(p, ">\n") + 2)).alias("text")))
    under = F.transform("loss", lambda m: unescaped(F.substr(F.col("formatted"), m["start"] + 1, m["length"])))
    return out.select("conv_id", "formatted", turns.alias("turns"), under.alias("under"))


def from_turn_rows(rows: DataFrame) -> DataFrame:
    """Each row of a table (conv_id, turn, role, text) as a JSON record of the layout "turn rows"."""
    record = F.struct(F.col("conv_id").cast("long").alias("conv_id"), F.col("turn").cast("long").alias("turn"), F.col("role"), F.col("text"))
    return rows.select(F.to_json(record, {"ignoreNullFields": "false"}).alias("record"))


def digests(spark: SparkSession, records: DataFrame) -> DataFrame:
    """conv_id, n_turns, turns_sha256, loss_chars, loss_sha256, formatted_chars of the records' conversations."""
    back = read_back(formatted(canonical_turns(spark, records)))
    all_turns = F.array_join(F.transform("turns", lambda t: F.concat(t["role"], F.lit("\n"), t["text"], F.lit("\n"))), "")
    loss = F.array_join("under", "")
    return back.select("conv_id", F.size("turns").cast("long").alias("n_turns"), F.sha2(F.encode(all_turns, "UTF-8"), 256).alias("turns_sha256"),
                       F.length(loss).cast("long").alias("loss_chars"), F.sha2(F.encode(loss, "UTF-8"), 256).alias("loss_sha256"),
                       F.length("formatted").cast("long").alias("formatted_chars"))


#: A conversation about control strings, in the layout "messages".
PROBE = {"conv_id": -7, "messages": [{"role": r, "content": "\\### Assistant: </turn> ok"} for r in ("user", "assistant")]}


def oracle() -> str:
    """The same rows in DuckDB's SQL."""
    probe = ", ".join(f"(-7, {i}, '{m['role']}', '{m['content']}')" for i, m in enumerate(PROBE["messages"]))
    names = " ".join(f"when '{a}' then '{b}'" for a, b in ROLES.items())
    return f"""
with turns as (
  select conv_id, turn, coalesce(case role {names} else role end, '') as role, coalesce(text, '') as text
  from (select conv_id, turn, role, text from conversations union all select * from (values {probe}) v(conv_id, turn, role, text))),
sized as (
  select *, length(role) + length(text)
         + (length(role || text) - length(replace(replace(role || text, '\\', ''), '<', ''))) + (length(role) - length(replace(role, '>', ''))) + {len("<turn:") + len(">") + 1 + len(END)} as chars
  from turns),
joined as (
  select conv_id, count(*) as n_turns, string_agg(role || chr(10) || text || chr(10), '' order by turn nulls first, role, text) as said,
         coalesce(string_agg(text, '' order by turn nulls first, role, text) filter (where role = '{LOSS_ROLE}'), '') as loss, sum(chars) as chars
  from sized group by conv_id)
select conv_id, n_turns::bigint as n_turns, sha256(said) as turns_sha256, length(loss)::bigint as loss_chars, sha256(loss) as loss_sha256,
       chars::bigint as formatted_chars
from joined"""

"""Chat formatting: layouts are recognised by a fingerprint of their field paths and mapped to canonical turns.

A record is a VARIANT. ``schema_of_variant`` gives its nested field paths; without the types and hashed they
are the fingerprint, which selects one declared ``Mapping``. All of it is DataFrame and SQL functions.

Cases. Null or unknown role and text are empty strings. A record of an undeclared layout (or null, or not JSON)
yields no turns; ``layouts`` counts such records by fingerprint. Rows with equal turn numbers are
ordered by role, then text; repeated rows are repeated turns. Rows without a conversation id form one
conversation. Other columns are not carried, so clashing names cannot matter. No rows give no conversations.

A conversation is one row of the output, so its rows meet in one task; that is the result's own size.
"""

from __future__ import annotations

from dataclasses import dataclass, field

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from nearfield.llm.common import register, table

TURN = "struct<role:string,text:string>"
OPEN, MIDDLE, CLOSE = "<s>[INST]", "[/INST]", "</s>"
# A control string whose first character is followed by n backslashes gets one more when escaped.
CONTROL = r"([<\[])(\\*)(/?(?:s>|INST\]))"
ESCAPED = r"([<\[])\\(\\*)(/?(?:s>|INST\]))"


@dataclass(frozen=True)
class Mapping:
    """How a layout becomes turns.

    ``example`` is a JSON record of the layout. ``turns`` names its array of turns with the paths of role and
    text inside one; otherwise ``fields`` lists (role, path) in order, a role starting with ``$`` being read from
    the record. ``roles`` renames roles. Empty optional fields (``skip_empty``) give no turn.
    """

    name: str
    example: str
    turns: str | None = None
    role: str = "role"
    text: str = "content"
    fields: tuple[tuple[str, str], ...] = ()
    roles: dict[str, str] = field(default_factory=dict)
    skip_empty: bool = False


SHARED = {"human": "user", "gpt": "assistant", "bot": "assistant", "model": "assistant", "prompter": "user"}
MAPPINGS = (
    Mapping("turn", '{"role":"","text":""}', fields=(("$role", "text"),)),
    Mapping("messages", '{"messages":[{"role":"","content":""}]}', turns="messages"),
    Mapping("conversations", '{"conversations":[{"from":"","value":""}]}', turns="conversations", role="from", text="value", roles=SHARED),
    Mapping("prompt_completion", '{"prompt":"","completion":""}', fields=(("user", "prompt"), ("assistant", "completion"))),
    Mapping("prompt_response", '{"prompt":"","response":""}', fields=(("user", "prompt"), ("assistant", "response"))),
    Mapping("question_answer", '{"question":"","answer":""}', fields=(("user", "question"), ("assistant", "answer"))),
    Mapping("instruction", '{"instruction":"","output":""}', fields=(("user", "instruction"), ("assistant", "output"))),
    Mapping("instruction_input", '{"instruction":"","input":"","output":""}', skip_empty=True,
            fields=(("user", "instruction"), ("user", "input"), ("assistant", "output"))),
    Mapping("system_prompt", '{"system":"","prompt":"","response":""}', skip_empty=True,
            fields=(("system", "system"), ("user", "prompt"), ("assistant", "response"))),
)


def field_paths(record: Column) -> Column:
    """Nested field names of a variant in sorted order, without types: ``OBJECT<messages: ARRAY<OBJECT<content, role>>>``."""
    return F.regexp_replace(F.schema_of_variant(record), r": (STRING|VOID|BOOLEAN|BIGINT|DOUBLE|FLOAT|DATE|BINARY|TIMESTAMP|TIMESTAMP_NTZ|DECIMAL\([^)]*\))", "")


def fingerprint(record: Column) -> Column:
    return F.substring(F.sha2(field_paths(record), 256), 1, 16)


def _turns(mapping: Mapping, record: Column) -> Column:
    get = lambda path: F.coalesce(F.try_variant_get(record, f"$.{path}", "string"), F.lit(""))
    if mapping.turns:
        kind = f"array<struct<`{mapping.role}`:string,`{mapping.text}`:string>>"
        found = F.transform(F.coalesce(F.try_variant_get(record, f"$.{mapping.turns}", kind), F.array().cast(kind)),
                            lambda t: F.struct(F.coalesce(t[mapping.role], F.lit("")).alias("role"), F.coalesce(t[mapping.text], F.lit("")).alias("text")))
    else:
        found = F.array(*[F.struct((get(role[1:]) if role[0] == "$" else F.lit(role)).alias("role"), get(path).alias("text"))
                          for role, path in mapping.fields])
    if mapping.skip_empty:
        found = F.filter(found, lambda t: t["text"] != "")
    if mapping.roles:
        names = F.create_map(*[F.lit(x) for pair in mapping.roles.items() for x in pair])
        found = F.transform(found, lambda t: F.struct(F.coalesce(names[t["role"]], t["role"]).alias("role"), t["text"].alias("text")))
    return found.cast(f"array<{TURN}>")


def canonical(records: DataFrame, json: str = "record", mappings: tuple[Mapping, ...] = MAPPINGS) -> DataFrame:
    """Add ``layout`` (fingerprint), ``mapping`` (name or null) and ``turns`` to records held as JSON text."""
    parsed = records.withColumn("__v", F.try_parse_json(json)).withColumn("layout", fingerprint(F.col("__v")))
    name, turns = F.lit(None).cast("string"), F.array().cast(f"array<{TURN}>")
    for mapping in mappings:
        same = F.col("layout") == fingerprint(F.parse_json(F.lit(mapping.example)))
        name, turns = F.when(same, F.lit(mapping.name)).otherwise(name), F.when(same, _turns(mapping, F.col("__v"))).otherwise(turns)
    return parsed.withColumns({"mapping": name, "turns": turns}).drop("__v")


def layouts(records: DataFrame, json: str = "record") -> DataFrame:
    """Records by layout: fingerprint, field paths and count, to see which mappings are missing."""
    v = F.try_parse_json(json)
    return records.groupBy(fingerprint(v).alias("layout"), field_paths(v).alias("paths")).agg(F.count(F.lit(1)).alias("records"))


def escape(text: Column) -> Column:
    return F.regexp_replace(text, CONTROL, r"$1\\$2$3")


def unescape(text: Column) -> Column:
    return F.regexp_replace(text, ESCAPED, "$1$2$3")


def format_turns(turns: DataFrame, trained: str = "assistant") -> DataFrame:
    """One row per conversation from rows (conv_id, turn, role, text): ``formatted`` and the loss mask.

    ``loss`` lists the spans of the mask as UTF-8 byte offsets and lengths into ``formatted``: the texts of
    ``trained`` turns, without markers.
    """
    head = F.concat(F.lit(OPEN), escape(F.col("role")), F.lit(MIDDLE))
    order = Window.partitionBy("conv_id").orderBy("turn", "role", "text")
    rows = (turns.select("conv_id", "turn", F.coalesce("role", F.lit("")).alias("role"), F.coalesce("text", F.lit("")).alias("text"))
            .select("*", head.alias("head"), escape(F.col("text")).alias("body"))
            .select("conv_id", "turn", "role", "text", F.octet_length("head").cast("bigint").alias("skip"),
                    F.octet_length("body").cast("bigint").alias("size"), F.concat("head", "body", F.lit(CLOSE)).alias("piece")))
    placed = rows.select("conv_id", F.row_number().over(order).alias("n"), "piece", "size", (F.col("role") == trained).alias("on"),
                         (F.sum(F.octet_length("piece").cast("bigint")).over(order.rowsBetween(Window.unboundedPreceding, 0))
                          - F.octet_length("piece") + F.col("skip")).alias("start"))
    return (placed.groupBy("conv_id").agg(F.sort_array(F.collect_list(F.struct("n", "piece", "start", "size", "on"))).alias("t"))
            .select("conv_id", F.array_join(F.transform("t", lambda x: x["piece"]), "").alias("formatted"),
                    F.transform(F.filter("t", lambda x: x["on"]), lambda x: F.struct(x["start"].alias("start"), x["size"].alias("size"))).alias("loss")))


def read_back(formatted: DataFrame) -> DataFrame:
    """Turns and the text under the loss mask, recovered from the formatted text alone and its mask."""
    marked = F.filter(F.split("formatted", CLOSE), lambda x: x != "")
    turns = F.transform(marked, _turn_of)
    masked = F.transform("loss", lambda s: unescape(F.decode(F.substring(F.encode("formatted", "UTF-8"), s["start"] + 1, s["size"]), "UTF-8")))
    return formatted.withColumns({"turns": turns, "loss_text": F.array_join(masked, "")})


def _turn_of(x: Column) -> Column:
    role = F.substring_index(F.substr(x, F.lit(len(OPEN) + 1)), MIDDLE, 1)
    return F.struct(unescape(role).alias("role"), unescape(F.substr(x, F.char_length(role) + F.lit(len(OPEN) + len(MIDDLE) + 1))).alias("text"))


def op7_chat_formatting(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All conversations through fingerprint, mapping, template and back; see the module."""
    rows = table(spark, sf_dir, "conversations").select(F.col("conv_id").cast("bigint"), F.col("turn").cast("bigint"), "role", "text")
    control = "</s>[INST] ok [/INST]"
    extra = spark.createDataFrame([(-1, 0, "user", control), (-1, 1, "assistant", control)], "conv_id bigint, turn bigint, role string, text string")
    records = rows.unionByName(extra).select("conv_id", "turn", F.to_json(F.struct("role", "text"), {"ignoreNullFields": "false"}).alias("record"))
    turns = canonical(records).select("conv_id", "turn", F.explode("turns").alias("t")).select("conv_id", "turn", "t.role", "t.text")
    back = read_back(format_turns(turns))
    said = F.array_join(F.transform("turns", lambda t: F.concat(t["role"], F.lit("\n"), t["text"], F.lit("\n"))), "")
    return back.select("conv_id", F.size("turns").cast("bigint").alias("n_turns"), F.sha2(said, 256).alias("turns_sha256"),
                       F.char_length("loss_text").cast("bigint").alias("loss_chars"), F.sha2("loss_text", 256).alias("loss_sha256"),
                       F.char_length("formatted").cast("bigint").alias("formatted_chars"))


OP7_SQL = r"""
WITH rows AS (
  SELECT conv_id, turn, coalesce(role, '') AS role, coalesce(text, '') AS text FROM conversations
  UNION ALL SELECT -1, 0, 'user', '</s>[INST] ok [/INST]'
  UNION ALL SELECT -1, 1, 'assistant', '</s>[INST] ok [/INST]'),
escaped AS (
  SELECT *, regexp_replace(role, '([<\[])(\\*)(/?(?:s>|INST\]))', '\1\\\2\3', 'g') AS erole,
         regexp_replace(text, '([<\[])(\\*)(/?(?:s>|INST\]))', '\1\\\2\3', 'g') AS etext FROM rows)
SELECT CAST(conv_id AS BIGINT) AS conv_id, count(*) AS n_turns,
       sha256(string_agg(role || chr(10) || text || chr(10), '' ORDER BY turn, role, text)) AS turns_sha256,
       CAST(sum(CASE WHEN role = 'assistant' THEN length(text) ELSE 0 END) AS BIGINT) AS loss_chars,
       sha256(coalesce(string_agg(text, '' ORDER BY turn, role, text) FILTER (WHERE role = 'assistant'), '')) AS loss_sha256,
       CAST(sum(length(erole) + length(etext) + 20) AS BIGINT) AS formatted_chars
FROM escaped GROUP BY conv_id"""

register("op7_chat_formatting", op7_chat_formatting, OP7_SQL)

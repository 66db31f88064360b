r"""Chat formatting of records in mixed layouts, in DataFrame functions only.

A record is a JSON text. Its fingerprint is a hash of its nested field paths: the sorted schema of the parsed value, with all
scalar types alike and unknown scalar fields left out. The fingerprint selects a declarative mapping, which says where
role and text of each turn are. Canonical turns are then written with a template::

    ### role: text</turn>

Inside a text, ``\``, ``<`` and ``#`` are written ``\b``, ``\l`` and ``\h``, so no control string can appear in it and the way back
is three replacements. A loss mask says which part of each turn is trained on.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

#: Scalar fields that mappings may use. Others don't count in a fingerprint.
VOCABULARY = ("role", "text", "content", "from", "value", "system", "prompt", "response", "completion", "instruction", "input", "output", "question", "answer")
#: Other names of the three roles.
ROLES = {"human": "user", "gpt": "assistant", "bot": "assistant", "model": "assistant"}
END = "</turn>\n"
TURNS = "array<struct<role: string, text: string>>"


@dataclass(frozen=True)
class Mapping:
    """A layout: its normalised schema (V is any scalar), and either an array with its role and text fields, or (role, field) pairs.

    ``joined``: fields after the first of a pair are put below it when they are not empty.
    """

    name: str
    schema: str
    array: tuple[str, str, str] | None = None
    pairs: tuple[tuple[str, tuple[str, ...]], ...] = ()

    def turns(self, record: Column) -> Column:
        if self.array:
            path, role, text = self.array
            kind = f"array<struct<`{role}`: string, `{text}`: string>>"
            return F.transform(F.try_variant_get(record, f"$.{path}", kind), lambda t: F.struct(t[role].alias("role"), t[text].alias("text")))
        out = []
        for role, fields in self.pairs:
            values = [F.try_variant_get(record, f"$.{f}", "string") for f in fields]
            text = values[0] if len(values) == 1 else F.concat_ws("\n", *(F.when(v != "", v) for v in values))
            named = F.try_variant_get(record, "$.role", "string") if role == "$role" else F.lit(role)
            out.append(F.struct(named.alias("role"), text.alias("text")))
        return F.array(*out)


MAPPINGS = (
    Mapping("turn", "OBJECT<role: V, text: V>", pairs=(("$role", ("text",)),)),
    Mapping("turn_content", "OBJECT<content: V, role: V>", pairs=(("$role", ("content",)),)),
    Mapping("messages", "OBJECT<messages: ARRAY<OBJECT<content: V, role: V>>>", array=("messages", "role", "content")),
    Mapping("conversations", "OBJECT<conversations: ARRAY<OBJECT<from: V, value: V>>>", array=("conversations", "from", "value")),
    Mapping("prompt_response", "OBJECT<prompt: V, response: V>", pairs=(("user", ("prompt",)), ("assistant", ("response",)))),
    Mapping("prompt_completion", "OBJECT<completion: V, prompt: V>", pairs=(("user", ("prompt",)), ("assistant", ("completion",)))),
    Mapping("system_prompt", "OBJECT<prompt: V, response: V, system: V>", pairs=(("system", ("system",)), ("user", ("prompt",)), ("assistant", ("response",)))),
    Mapping("instruction", "OBJECT<instruction: V, output: V>", pairs=(("user", ("instruction",)), ("assistant", ("output",)))),
    Mapping("instruction_input", "OBJECT<input: V, instruction: V, output: V>", pairs=(("user", ("instruction", "input")), ("assistant", ("output",)))),
    Mapping("question", "OBJECT<answer: V, question: V>", pairs=(("user", ("question",)), ("assistant", ("answer",)))),
)


def layout(record: Column) -> Column:
    """The nested field paths of a parsed record, sorted, as a schema in which V is any scalar."""
    schema = F.regexp_replace(F.schema_of_variant(record), r": (?!OBJECT<|ARRAY<)[A-Z_]+(?:\(\d+,\s*\d+\))?", ": V")
    unknown = rf"`?\b(?!(?:{'|'.join(VOCABULARY)})\b)[^<>:,`]+`?: V(?:, |(?=>))"
    return F.regexp_replace(F.regexp_replace(schema, unknown, ""), r", >", ">")


def fingerprint(record: Column) -> Column:
    return F.xxhash64(layout(record))


def canonical_turns(records: DataFrame, mappings: tuple[Mapping, ...] = MAPPINGS) -> DataFrame:
    """All columns of ``records`` but ``record``, ``mapping`` (null: no layout fits, or no JSON) and ``turns`` of canonical roles."""
    # The first parser gives up at strings of 20 million characters; the second takes up to the size limit of a parsed value.
    text = F.col("record").cast("string")
    long = F.from_json(text, "variant", {"maxStringLen": str(2**31 - 1)})
    lost = F.raise_error(F.lit("a record of more than 100 million characters could not be parsed: split it into turns")).cast("variant")
    long = F.coalesce(long, F.when(F.length(text) > 100_000_000, lost))
    parsed = records.withColumn("record", F.coalesce(F.try_parse_json(text), F.when(F.length(text) > 1_000_000, long)))
    parsed = parsed.withColumn("_print", fingerprint(F.col("record")))
    name, turns = F.lit(None).cast("string"), F.lit(None).cast(TURNS)
    for m in mappings:
        fits = F.col("_print") == F.xxhash64(F.lit(m.schema))
        name, turns = F.when(fits, m.name).otherwise(name), F.when(fits, m.turns(F.col("record"))).otherwise(turns)
    known = F.create_map(*(F.lit(x) for pair in ROLES.items() for x in pair))
    clean = F.transform(turns, lambda t: F.struct(F.coalesce(known[t["role"]], t["role"], F.lit("")).alias("role"), F.coalesce(t["text"], F.lit("")).alias("text")))
    return parsed.select(*(c for c in records.columns if c != "record"), name.alias("mapping"), clean.alias("turns"))


def escaped(text: Column) -> Column:
    return F.replace(F.replace(F.replace(text, F.lit("\\"), F.lit("\\b")), F.lit("<"), F.lit("\\l")), F.lit("#"), F.lit("\\h"))


def unescaped(text: Column) -> Column:
    return F.replace(F.replace(F.replace(text, F.lit("\\h"), F.lit("#")), F.lit("\\l"), F.lit("<")), F.lit("\\b"), F.lit("\\"))


def format_chats(records: DataFrame) -> DataFrame:
    """One row a conversation of ``records`` (conv_id, turn, record): conv_id, formatted and loss_mask.

    A record may hold one turn or many; ``turn`` orders the records of a conversation, null first, and equal ones go by role and
    text. Null roles and texts are empty; a null conv_id is a conversation of its own. A record is parsed whole up to 100 million
    characters; a longer one that no parser takes is an error, not a lost turn. Records that no mapping fits have no turns;
    ``canonical_turns`` shows them. Repeated records are repeated turns. An empty table gives an empty result.
    The mask has a start and a length for each turn, in code points from the turn's beginning; length 0: not trained on.
    """
    turns = canonical_turns(records.select("conv_id", "turn", "record")).select("conv_id", "turn", F.posexplode("turns").alias("at", "t"))
    turns = turns.select("conv_id", F.struct("turn", "at", "t.role", "t.text").alias("t"))
    # A conversation is one text, so its turns meet in one row; nothing else is grouped.
    chats = turns.groupBy("conv_id").agg(F.array_sort(F.collect_list("t")).alias("t"))
    head = lambda t: F.concat(F.lit("### "), F.replace(escaped(t["role"]), F.lit(":"), F.lit("\\c")), F.lit(": "))
    parts = F.transform("t", lambda t: F.struct(head(t).alias("head"), escaped(t["text"]).alias("body"), (t["role"] == "assistant").alias("loss")))
    chats = chats.select("conv_id", parts.alias("p"))
    mask = F.transform("p", lambda p: F.struct(F.length(p["head"]).alias("start"), F.when(p["loss"], F.length(p["body"])).otherwise(0).alias("length")))
    return chats.select("conv_id", F.array_join(F.transform("p", lambda p: F.concat(p["head"], p["body"], F.lit(END))), "").alias("formatted"), mask.alias("loss_mask"))


def read_chats(chats: DataFrame) -> DataFrame:
    """conv_id, formatted, turns and loss_text, the last two read back from ``formatted`` and ``loss_mask`` alone."""
    parts = F.split("formatted", END)
    chunks = chats.select("conv_id", "formatted", "loss_mask", F.slice(parts, F.lit(1), F.size(parts) - 1).alias("chunks"))
    role = lambda c: F.replace(F.substring_index(c, ": ", 1), F.lit("\\c"), F.lit(":"))
    turn = lambda c: F.struct(unescaped(role(c).substr(F.lit(5), F.length(c))).alias("role"), unescaped(c.substr(F.length(F.substring_index(c, ": ", 1)) + 3, F.length(c))).alias("text"))
    loss = F.zip_with("chunks", "loss_mask", lambda c, m: unescaped(c.substr(m["start"] + 1, m["length"])))
    return chunks.select("conv_id", "formatted", F.transform("chunks", turn).alias("turns"), F.array_join(loss, "").alias("loss_text"))

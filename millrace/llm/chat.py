"""Chat formatting: records of unlike layouts to canonical turns, and turns to one masked string.

A record's layout is recognised by a fingerprint: the hash of its nested field paths, without the
value types. A table of declarative mappings, looked up by fingerprint, says where turns are.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from millrace.llm.common import col


@dataclass(frozen=True)
class Layout:
    """Where a record of a certain shape has its turns.

    ``shape`` lists the nested field paths as schema_of_variant does, without types. Either
    ``many`` names an array of turns with the fields ``role`` and ``text``, or ``turns`` pairs a
    fixed role, or a path to one (beginning with $), with the paths whose texts make the turn.
    ``order`` is the path to a turn's number, for layouts with one turn a record.
    """

    name: str
    shape: str
    turns: tuple[tuple[str, tuple[str, ...]], ...] = ()
    many: str | None = None
    role: str = "role"
    text: str = "content"
    order: str | None = None


LAYOUTS = (
    Layout("turn_rows", "OBJECT<role, text, turn>", turns=(("$.role", ("$.text",)),), order="$.turn"),
    Layout("messages", "OBJECT<messages: ARRAY<OBJECT<content, role>>>", many="$.messages"),
    Layout("shares", "OBJECT<conversations: ARRAY<OBJECT<from, value>>>", many="$.conversations", role="from", text="value"),
    Layout("prompt", "OBJECT<prompt, response>", turns=(("user", ("$.prompt",)), ("assistant", ("$.response",)))),
    Layout("completion", "OBJECT<completion, prompt>", turns=(("user", ("$.prompt",)), ("assistant", ("$.completion",)))),
    Layout("system_prompt", "OBJECT<prompt, response, system>", turns=(("system", ("$.system",)), ("user", ("$.prompt",)), ("assistant", ("$.response",)))),
    Layout("instruction", "OBJECT<instruction, output>", turns=(("user", ("$.instruction",)), ("assistant", ("$.output",)))),
    Layout("instruction_input", "OBJECT<input, instruction, output>", turns=(("user", ("$.instruction", "$.input")), ("assistant", ("$.output",)))),
    Layout("nested_data", "OBJECT<data: OBJECT<prompt, response>>", turns=(("user", ("$.data.prompt",)), ("assistant", ("$.data.response",)))),
)

TURN = "array<struct<role: string, text: string>>"


def shape_of(record: Column) -> Column:
    """Nested field paths of a variant, types of scalars removed; fields come in alphabetic order."""
    scalar = r"(: |ARRAY<)(?:BIGINT|STRING|VOID|BOOLEAN|DOUBLE|FLOAT|DATE|BINARY|TIMESTAMP(?:_NTZ)?|DECIMAL\(\d+,\s*\d+\))(?=[,>])"
    return F.regexp_replace(F.regexp_replace(F.schema_of_variant(record), scalar, "$1"), ": (?=[,>])", "")


def fingerprint(record: Column) -> Column:
    return F.xxhash64(shape_of(record))


def _string(record: Column, path: str) -> Column:
    return F.coalesce(F.try_variant_get(record, path, "string"), F.lit(""))


def _turns(record: Column, layout: Layout) -> Column:
    if layout.many:
        kind = f"array<struct<`{layout.role}`: string, `{layout.text}`: string>>"
        return F.transform(
            F.try_variant_get(record, layout.many, kind),
            lambda t: F.struct(
                F.coalesce(t[layout.role], F.lit("")).alias("role"), F.coalesce(t[layout.text], F.lit("")).alias("text")
            ),
        )
    out = []
    for role, paths in layout.turns:
        who = _string(record, role) if role.startswith("$") else F.lit(role)
        texts = [_string(record, p) for p in paths]
        body = texts[0] if len(texts) == 1 else F.array_join(F.array_remove(F.array(*texts), ""), "\n")
        out.append(F.struct(who.alias("role"), body.alias("text")))
    return F.array(*out)


def canonical_turns(records: DataFrame, conv_id: str = "conv_id", record: str = "record", layouts=LAYOUTS) -> DataFrame:
    """(conv_id, layout, turn, part, role, text): one row per turn of the VARIANT column ``record``.

    A record whose fingerprint no layout has gives one row with a null layout, role and text, to be
    set aside by the caller; so does a null record. Null or absent roles and texts count as empty.
    Rows of one conversation are ordered by (turn, part); turn is null where the layout has none.
    """
    rec = col(record)
    df = records.select(col(conv_id).alias("conv_id"), rec.alias("record"), fingerprint(rec).alias("fingerprint"))
    known, turns, order = (F.when(F.lit(False), F.lit(None)) for _ in range(3))
    for layout in layouts:
        same = F.col("fingerprint") == F.xxhash64(F.lit(layout.shape))
        known = known.when(same, F.lit(layout.name))
        turns = turns.when(same, _turns(F.col("record"), layout))
        order = order.when(same, F.try_variant_get("record", layout.order, "long") if layout.order else F.lit(None))
    df = df.select("conv_id", known.alias("layout"), order.cast("long").alias("turn"), turns.alias("turns"))
    df = df.select("conv_id", "layout", "turn", F.posexplode_outer("turns").alias("part", "t"))
    return df.select("conv_id", "layout", "turn", "part", "t.role", "t.text")


# The template. Its control strings are made of the characters that ESCAPES takes out of texts.
HEAD, HEAD_END, TURN_END = "### ", ":\n", "</turn>\n"
# Reversible: the backslash goes first and comes back last.
ESCAPES = (("\\", "\\0"), ("#", "\\1"), ("<", "\\2"))
ROLE_ESCAPES = (*ESCAPES, (":", "\\3"), ("\n", "\\4"))


def escape(text: Column, table=ESCAPES) -> Column:
    for plain, code in table:
        text = F.replace(text, F.lit(plain), F.lit(code))
    return text


def unescape(text: Column, table=ESCAPES) -> Column:
    for plain, code in reversed(table):
        text = F.replace(text, F.lit(code), F.lit(plain))
    return text


def format_turns(turns: DataFrame, learn_from: tuple[str, ...] = ("assistant",)) -> DataFrame:
    """(conv_id, formatted, loss) from rows of canonical turns.

    ``formatted`` joins "### role:\\ntext</turn>\\n" over the turns. ``loss`` has one entry per
    turn: where in the string, in code points, its text begins and how much of it is learned:
    all for roles in ``learn_from``, else nothing. ``from`` counts from the string's begin,
    ``within`` from the turn's. Rows equal in (turn, part) are ordered by role and text; repeated
    rows stay. Null conv_ids are one conversation. Rows without a layout are not formatted.
    """
    df = turns.where("layout IS NOT NULL AND role IS NOT NULL")
    head = F.concat(F.lit(HEAD), escape(F.col("role"), ROLE_ESCAPES), F.lit(HEAD_END))
    df = df.withColumn("head", head).withColumn("body", escape(F.col("text")))
    size = F.length("head") + F.length("body") + F.lit(len(TURN_END))
    order = Window.partitionBy("conv_id").orderBy("turn", "part", "role", "text")
    df = df.withColumn("n", F.row_number().over(order))
    df = df.withColumn("at", F.sum(size.cast("long")).over(order.rowsBetween(Window.unboundedPreceding, 0)) - size)
    learned = F.when(F.col("role").isin(*learn_from), F.length("body")).otherwise(0).cast("long")
    row = F.struct(
        "n",
        F.concat("head", "body", F.lit(TURN_END)).alias("segment"),
        F.struct(
            (F.col("at") + F.length("head")).alias("from"), F.length("head").cast("long").alias("within"), learned.alias("chars")
        ).alias("loss"),
    )
    whole = df.groupBy("conv_id").agg(F.array_sort(F.collect_list(row)).alias("rows"))
    return whole.select(
        "conv_id",
        F.array_join(F.transform("rows", lambda r: r["segment"]), "").alias("formatted"),
        F.transform("rows", lambda r: r["loss"]).alias("loss"),
    )


def read_back(formatted: DataFrame) -> DataFrame:
    """(conv_id, formatted, turns, learned): turns and the learned texts, parsed from the output alone."""
    parts = F.split("formatted", TURN_END, -1)
    df = formatted.withColumn("parts", F.slice(parts, 1, F.size(parts) - 1))

    def turn(p: Column) -> Column:
        role = F.substring_index(p, HEAD_END, 1)
        body = F.substring(p, F.length(role) + 1 + len(HEAD_END), F.length(p))
        return F.struct(
            unescape(F.substring(role, F.lit(1 + len(HEAD)), F.length(role)), ROLE_ESCAPES).alias("role"),
            unescape(body).alias("text"),
        )

    masked = F.zip_with("parts", "loss", lambda p, m: F.substring(p, m["within"].cast("int") + 1, m["chars"].cast("int")))
    return df.select(
        "conv_id",
        "formatted",
        F.transform("parts", turn).alias("turns"),
        F.transform(masked, lambda t: unescape(t)).alias("learned"),
    )

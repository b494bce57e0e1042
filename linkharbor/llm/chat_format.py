"""Chat formatting in DataFrame functions only.

Records arrive in many layouts: one row per turn, arrays of messages, prompt and response, instruction
with optional input. A fingerprint, the hash of the nested field paths that layouts are made of, selects
a declarative mapping, which is a SQL expression that yields canonical turns (role, text). The
fingerprint of a typed frame is taken once from its schema, that of JSON records one by one, both over
the same paths and against the same mappings. Fields that no layout knows, of any name and depth, are
ignored; a record with the fields of two layouts has the fingerprint of neither.

Template: a turn is `<turn:ROLE>` newline TEXT `</turn>` newline. Inside role and text a backslash is
written as backslash s and `<` as backslash l, inside a role also `>` as backslash g, so neither can hold
a marker, and back it goes exactly.
"""

from __future__ import annotations

import hashlib
import re
from collections.abc import Iterable
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

TURN_OPEN, ROLE_END, TURN_CLOSE = "<turn:", ">\n", "</turn>\n"
TRAINED_ROLE = "assistant"


@dataclass(frozen=True)
class Mapping:
    """Field paths of a layout, and the SQL that makes `array<struct<role,text>>` of a VARIANT `record`.

    A layout of one turn per record names its order, role and text fields in `row`.
    """

    paths: tuple[str, ...]
    turns: str
    row: tuple[str, str, str] | None = None

    @property
    def fingerprint(self) -> str:
        return fingerprint(self.paths)


def fingerprint(paths: Iterable[str]) -> str:
    return hashlib.sha256("\n".join(sorted(paths)).encode()).hexdigest()


def field_paths(schema: T.DataType, prefix: str = "") -> list[str]:
    """Nested field paths of a type: `messages[].role`. Names that are no plain words are quoted."""
    if isinstance(schema, T.StructType) and schema.fields:
        found = []
        for f in schema.fields:
            plain = re.fullmatch(r"[A-Za-z_][A-Za-z0-9_]*", f.name)
            name = f.name if plain else "`" + f.name.replace("`", "``") + "`"
            found += field_paths(f.dataType, f"{prefix}.{name}" if prefix else name)
        return found
    if isinstance(schema, T.ArrayType):
        return field_paths(schema.elementType, prefix + "[]")
    return [prefix]


def _pair(role: str, path: str) -> str:
    return f"named_struct('role', '{role}', 'text', coalesce(variant_get(record, '$.{path}', 'string'), ''))"


def _messages(array: str, role: str, text: str) -> str:
    return (
        f"transform(variant_get(record, '$.{array}', 'array<variant>'), m -> named_struct("
        f"'role', coalesce(variant_get(m, '$.{role}', 'string'), ''), "
        f"'text', coalesce(variant_get(m, '$.{text}', 'string'), '')))"
    )


def _row(order: str, role: str, text: str) -> Mapping:
    fields = ", ".join(
        f"'{name}', coalesce(variant_get(record, '$.{path}', 'string'), '')" for name, path in (("role", role), ("text", text))
    )
    return Mapping((order, role, text), f"array(named_struct({fields}))", (order, role, text))


# Layouts that public instruction and chat sets use.
MAPPINGS = (
    _row("turn", "role", "text"),
    _row("turn", "role", "content"),
    Mapping(("messages[].content", "messages[].role"), _messages("messages", "role", "content")),
    Mapping(("messages[].role", "messages[].text"), _messages("messages", "role", "text")),
    Mapping(("conversations[].from", "conversations[].value"), _messages("conversations", "from", "value")),
    Mapping(("prompt", "response"), f"array({_pair('user', 'prompt')}, {_pair('assistant', 'response')})"),
    Mapping(("completion", "prompt"), f"array({_pair('user', 'prompt')}, {_pair('assistant', 'completion')})"),
    Mapping(("instruction", "output"), f"array({_pair('user', 'instruction')}, {_pair('assistant', 'output')})"),
    Mapping(
        ("input", "instruction", "output"),
        "array(named_struct('role', 'user', 'text', concat_ws('\\n\\n', "
        "variant_get(record, '$.instruction', 'string'), nullif(variant_get(record, '$.input', 'string'), ''))), "
        f"{_pair('assistant', 'output')})",
    ),
)

# Names that sources give to the three roles.
ROLE_NAMES = {"human": "user", "gpt": "assistant", "bot": "assistant", "model": "assistant"}

MAPPING_OF = {m.fingerprint: m for m in MAPPINGS}


def _with_parents(path: str) -> set[str]:
    """A path and the places above it: a value found there means that the layout is not what it seems."""
    steps = re.findall(r"\[\]|\.?\w+", path)
    return {"".join(steps[: n + 1]) for n in range(len(steps))}


# Paths that a fingerprint is made of.
KNOWN_PATHS = frozenset().union(*(_with_parents(p) for m in MAPPINGS for p in m.paths))


def canonical_role(role: Column) -> Column:
    role = F.coalesce(role, F.lit(""))
    known = F.create_map(*[F.lit(x) for pair in ROLE_NAMES.items() for x in pair])
    return F.coalesce(F.try_element_at(known, role), role)


def mapping_of_frame(df: DataFrame, id_col: str) -> Mapping:
    """The mapping that the schema's fingerprint selects.

    A table may have columns of other layouts beside its own. If its fingerprint is unknown, the layout
    with the most paths of those that are there whole is taken; none, or two of one size, is an error.
    """
    paths = set(field_paths(T.StructType([f for f in df.schema.fields if f.name != id_col]))) & KNOWN_PATHS
    exact = MAPPING_OF.get(fingerprint(paths))
    if exact:
        return exact
    whole = [m for m in MAPPINGS if fingerprint(paths & set(m.paths)) == m.fingerprint]
    most = max((len(m.paths) for m in whole), default=0)
    chosen = [m for m in whole if len(m.paths) == most]
    if len(chosen) != 1:
        raise ValueError(f"no mapping for the field paths {sorted(paths)}")
    return chosen[0]


def turns_of_rows(df: DataFrame, id_col: str = "conv_id") -> DataFrame:
    """Canonical turns (conv_id, ord, role, text) of a typed frame in any of the known layouts.

    The schema's fingerprint selects the mapping; further columns are ignored. In a layout of one row
    per turn a null text or role is empty, roles stay as they are, turns with equal numbers are ordered
    by role and text, and a null number comes first. In the others a row is a conversation, its turns
    are counted from 0 and roles become canonical.
    """
    mapping = mapping_of_frame(df, id_col)
    if mapping.row:
        order, role, text = mapping.row
        return df.select(
            F.col(f"`{id_col}`").alias("conv_id"),
            F.col(order).try_cast("long").alias("ord"),
            F.coalesce(F.col(role).cast("string"), F.lit("")).alias("role"),
            F.coalesce(F.col(text).cast("string"), F.lit("")).alias("text"),
        )
    tops = sorted({re.match(r"\w+", p).group() for p in mapping.paths})
    records = df.select(
        F.col(f"`{id_col}`").alias("conv_id"), F.to_variant_object(F.struct(*tops)).alias("record")
    )
    return (
        records.select("conv_id", F.posexplode(F.expr(mapping.turns)).alias("ord", "turn"))
        .select("conv_id", F.col("ord").cast("long").alias("ord"), canonical_role(F.col("turn.role")).alias("role"), "turn.text")
    )


# Parts of a VARIANT schema as Spark spells it: OBJECT<messages: ARRAY<OBJECT<role: STRING, `my-id`: VOID>>>.
_SCHEMA_PARTS = r"OBJECT<>|OBJECT<|ARRAY<|>|(?:`[^`]*+(?:``[^`]*+)*+`|\w+): |[A-Z_]+(?:\(\d+,\d+\))?"


def record_fingerprint(record: Column) -> Column:
    """Hash of the sorted known field paths of a JSON text, by a walk over its inferred schema.

    The walk keeps the paths that are open. A name opens a path below the last one, an array opens its
    elements; a plain type or a closing bracket ends the last.
    """
    parts = F.regexp_extract_all(F.schema_of_variant(F.try_parse_json(record)), F.lit(_SCHEMA_PARTS), F.lit(0))
    start = F.struct(
        F.array(F.lit("")).alias("open"), F.array().cast("array<string>").alias("paths")
    )

    def step(state: Column, part: Column) -> Column:
        opened, last = state["open"], F.try_element_at(state["open"], F.lit(-1))
        name = F.regexp_extract(part, r"(?s)^(.*): $", 1)
        below = F.concat(last, F.when(last == "", F.lit("")).otherwise(F.lit(".")), name)
        ended = F.slice(opened, F.lit(1), F.greatest(F.size(opened) - 1, F.lit(0)))
        is_leaf = (name == "") & ~part.isin("OBJECT<", "ARRAY<", ">")
        return F.struct(
            F.when(name != "", F.concat(opened, F.array(below)))
            .when(part == "ARRAY<", F.concat(opened, F.array(F.concat(last, F.lit("[]")))))
            .when(part == "OBJECT<", opened)
            .otherwise(ended)
            .alias("open"),
            F.when(is_leaf & last.isin(*sorted(KNOWN_PATHS)), F.concat(state["paths"], F.array(last)))
            .otherwise(state["paths"])
            .alias("paths"),
        )

    paths = F.aggregate(parts, start, step, lambda state: state["paths"])
    return F.sha2(F.array_join(F.array_sort(paths), "\n"), 256)


def turns_of_records(df: DataFrame, id_col: str, record_col: str) -> DataFrame:
    """Canonical turns of JSON records in any of the known layouts; `known` is false for others.

    A record that is null, no JSON or of an unknown layout gives one row with known = false and null
    turn fields, so nothing vanishes silently. Fields whose value is null count as present. A record
    that is one turn has the order its field gives, null if that is no whole number.
    """
    marked = df.select(
        F.col(f"`{id_col}`").alias("conv_id"),
        F.try_parse_json(F.col(f"`{record_col}`")).alias("record"),
        record_fingerprint(F.col(f"`{record_col}`")).alias("mark"),
    )
    chosen = " ".join(f"when mark = '{m.fingerprint}' then {m.turns}" for m in MAPPINGS)
    numbered = " ".join(
        f"when mark = '{m.fingerprint}' then try_variant_get(record, '$.{m.row[0]}', 'long')" for m in MAPPINGS if m.row
    )
    return (
        marked.withColumn("turns", F.expr(f"case {chosen} end"))
        .select("conv_id", "record", "mark", F.posexplode_outer("turns").alias("pos", "turn"))
        .select(
            "conv_id",
            F.expr(f"case {numbered} else cast(pos as long) end").alias("ord"),
            F.when(F.col("turn").isNotNull(), canonical_role(F.col("turn.role"))).alias("role"),
            F.col("turn.text").alias("text"),
            F.col("turn").isNotNull().alias("known"),
        )
    )


def escaped(text: Column) -> Column:
    return F.replace(F.replace(text, F.lit("\\"), F.lit("\\s")), F.lit("<"), F.lit("\\l"))


def unescaped(text: Column) -> Column:
    return F.replace(F.replace(text, F.lit("\\l"), F.lit("<")), F.lit("\\s"), F.lit("\\"))


def escaped_role(role: Column) -> Column:
    return F.replace(escaped(role), F.lit(">"), F.lit("\\g"))


def unescaped_role(role: Column) -> Column:
    return unescaped(F.replace(role, F.lit("\\g"), F.lit(">")))


def format_turns(turns: DataFrame) -> DataFrame:
    """Per turn its formatted piece and the span of it that is trained on.

    Columns conv_id, ord, piece, loss_start (0-based, code points), loss_length. The formatted
    conversation is its pieces in the order (ord, piece): a long one is never gathered to be formatted.
    Repeated turns give repeated pieces; a null role or text (of an unknown record) gives a null piece.
    """
    opening = F.concat(F.lit(TURN_OPEN), escaped_role(F.col("role")), F.lit(ROLE_END))
    text = escaped(F.col("text"))
    return turns.select(
        "conv_id",
        "ord",
        F.concat(opening, text, F.lit(TURN_CLOSE)).alias("piece"),
        F.char_length(opening).cast("long").alias("loss_start"),
        F.when(F.col("role") == TRAINED_ROLE, F.char_length(text)).otherwise(0).cast("long").alias("loss_length"),
    )


def read_turns(pieces: DataFrame) -> DataFrame:
    """Role, text and trained text read back from formatted pieces; of a null piece they are null."""
    piece = F.col("piece")
    role_end = F.instr(piece, ROLE_END)
    open_chars = len(TURN_OPEN)
    masked = F.substring(piece, F.col("loss_start").cast("int") + 1, F.col("loss_length").cast("int"))
    return pieces.select(
        "conv_id",
        "ord",
        unescaped_role(F.substring(piece, F.lit(open_chars + 1), role_end - open_chars - 1)).alias("role"),
        unescaped(
            F.substring(
                piece,
                role_end + len(ROLE_END),
                F.char_length(piece) - role_end - len(ROLE_END) + 1 - len(TURN_CLOSE),
            )
        ).alias("text"),
        unescaped(masked).alias("trained"),
        F.char_length(piece).cast("long").alias("piece_chars"),
    )


def join_pieces(pieces: DataFrame) -> DataFrame:
    """One row per conversation: conv_id, formatted. For those who need whole texts.

    Null pieces are left out, so a conversation of unknown records has an empty text; a null id is a group.
    """
    ordered = F.array_sort(F.collect_list(F.struct("ord", "piece")))
    return pieces.groupBy("conv_id").agg(F.array_join(F.transform(ordered, lambda x: x["piece"]), "").alias("formatted"))


def conversation_digests(read: DataFrame) -> DataFrame:
    """Facts of each conversation, over what was read back.

    A digest of a conversation is one sequential hash, so its turns do meet in one group here; only
    here, and with nothing but their text.
    """
    ordered = F.array_sort(F.collect_list(F.struct("ord", "role", "text", "trained")))
    grouped = read.groupBy("conv_id").agg(
        F.count("*").alias("n_turns"), F.sum("piece_chars").alias("formatted_chars"), ordered.alias("turns")
    )
    spoken = F.array_join(F.transform("turns", lambda t: F.concat(t["role"], F.lit("\n"), t["text"], F.lit("\n"))), "")
    trained = F.array_join(F.transform("turns", lambda t: t["trained"]), "")
    return grouped.select(
        "conv_id",
        "n_turns",
        F.sha2(spoken, 256).alias("turns_sha256"),
        F.char_length(trained).cast("long").alias("loss_chars"),
        F.sha2(trained, 256).alias("loss_sha256"),
        "formatted_chars",
    )

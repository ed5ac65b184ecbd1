"""Chat formatting: records of many layouts become canonical turns, and turns a text with a loss mask.

A record is a JSON payload. The paths of its nested fields, whatever their types, are hashed; the
fingerprint selects a declarative mapping, one for each known layout. All mappings are column expressions of
one projection. Turns are formatted one by one, so that no conversation is ever held as a whole:
the formatted conversation is its segments in order.
"""

from __future__ import annotations

import hashlib
import json
import re
from collections.abc import Callable, Iterator
from dataclasses import dataclass, field

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import ArrayType, DataType, StructType

START, END = "<|im_start|>", "<|im_end|>"
#: What follows the first character of each control string; texts may hold them, formatted texts only as controls.
CONTROLS = ("<s>", "</s>", "[INST]", "[/INST]", "<<SYS>>", "<</SYS>>", "<|endoftext|>", START, END)
_RESTS = "|".join(re.escape(c[1:]).replace("/", "/") for c in CONTROLS)
_ESCAPE = rf"([<\[])(?=\\*(?:{_RESTS}))"
_UNESCAPE = re.compile(rf"([<\[])\\(?=\\*(?:{_RESTS}))")
LEARNT_ROLE = "assistant"
_SCALARS = r"\b(VOID|STRING|BOOLEAN|BIGINT|DOUBLE|FLOAT|VARIANT|DECIMAL\([0-9]+, ?[0-9]+\))(?=[,>]|$)"
_TURNS = "array<struct<conv_id: bigint, turn: bigint, role: string, text: string>>"


@dataclass(frozen=True)
class Layout:
    """One record layout. ``example`` has its fields; texts lie in ``fields`` (role, field), in a list of messages, or in the row itself."""

    name: str
    example: str
    fields: tuple[tuple[str, str], ...] = ()
    messages: str | None = None
    role: str = "role"
    text: str = "text"
    roles: dict[str, str] = field(default_factory=dict)

    def schema(self) -> str:
        """The fields that the mapping reads."""
        if self.messages:
            return f"{self.messages} array<struct<{self.role}: string, {self.text}: string>>"
        if self.fields:
            return ", ".join(f"{path} string" for _, path in self.fields)
        return f"conv_id bigint, turn bigint, {self.role} string, {self.text} string"

    def turns(self, record_id: Column, at: Callable[..., Column]) -> Column:
        """Turns of a record; ``at(field, type)`` is a field of it."""
        said = lambda text: F.coalesce(text, F.lit(""))
        if self.messages:
            items = at(self.messages, f"array<struct<{self.role}: string, {self.text}: string>>")
            return F.transform(
                items, lambda m, i: F.struct(record_id.alias("conv_id"), i.cast("long").alias("turn"), self._named(m[self.role]).alias("role"), said(m[self.text]).alias("text"))
            ).cast(_TURNS)
        if self.fields:
            turns = [F.struct(record_id, F.lit(i).cast("long"), F.lit(role), said(at(path))) for i, (role, path) in enumerate(self.fields)]
            return F.array(*turns).cast(_TURNS)
        return F.array(F.struct(at("conv_id", "bigint"), at("turn", "bigint"), self._named(at(self.role)), said(at(self.text)))).cast(_TURNS)

    def _named(self, role: Column) -> Column:
        named = F.coalesce(role, F.lit(""))
        for given, canonical in self.roles.items():
            named = F.when(role == given, canonical).otherwise(named)
        return named


#: Bytes from which a payload is mapped without a variant, which holds no longer texts.
LONG = 16 << 20
LAYOUTS = (
    Layout("turn rows", '{"conv_id":0,"role":"","text":"","turn":0}'),
    Layout("prompt and response", '{"prompt":"","response":""}', (("user", "prompt"), ("assistant", "response"))),
    Layout("system, prompt, response", '{"prompt":"","response":"","system":""}', (("system", "system"), ("user", "prompt"), ("assistant", "response"))),
    Layout("instruction and output", '{"instruction":"","output":""}', (("user", "instruction"), ("assistant", "output"))),
    Layout("messages", '{"messages":[{"content":"","role":""}]}', messages="messages", text="content"),
    Layout("shared conversations", '{"conversations":[{"from":"","value":""}]}', messages="conversations", role="from", text="value",
           roles={"human": "user", "gpt": "assistant", "bot": "assistant"}),
)


def fingerprint(payload: Column) -> Column:
    """Hash of the nested field paths of a variant; types of scalars play no part."""
    return F.xxhash64(F.regexp_replace(F.schema_of_variant(payload), _SCALARS, "_"))


def canonical_turns(records: DataFrame, layouts: tuple[Layout, ...] = LAYOUTS) -> DataFrame:
    """(record_id, fingerprint, layout, conv_id, turn, role, text): one row per turn of ``records`` (record_id, payload).

    A record of no known layout, or that is no JSON, gives one row with a null layout and null
    turn, so that nothing is lost unseen; a record without turns gives one row with its layout and a null turn.
    A null text is empty, a null role is empty, roles are renamed where the layout says so. Extra columns are not read.
    A payload of ``LONG`` bytes or more is fingerprinted with its texts left out, and mapped by the schema of its
    layout; if a text of it is no valid JSON string, it is a record without turns.
    """
    far = F.octet_length("payload") >= LONG
    parsed = F.try_parse_json(F.when(far, without_texts(F.col("payload"))).otherwise(F.col("payload")))
    r = records.select("record_id", "payload", far.alias("_far"), parsed.alias("_payload"))
    r = r.withColumn("fingerprint", fingerprint(F.col("_payload")))
    turns, name = F.lit(None).cast(_TURNS), F.lit(None).cast("string")
    short = lambda path, kind="string": F.try_variant_get("_payload", f"$.{path}", kind)
    for layout in layouts:
        this = F.col("fingerprint") == _known(layout)
        whole = F.from_json("payload", layout.schema(), {"maxStringLen": str((1 << 31) - 1)})
        long = lambda path, kind="string", whole=whole: whole[path].cast(kind)
        turns = F.when(this & F.col("_far"), layout.turns(F.col("record_id"), long)).when(this, layout.turns(F.col("record_id"), short)).otherwise(turns)
        name = F.when(this, layout.name).otherwise(name)
    return _one_per_turn(r, name, turns)


def canonical_rows(rows: DataFrame, record_id: str, layouts: tuple[Layout, ...] = LAYOUTS) -> DataFrame:
    """``canonical_turns`` of records that are columns already, texts of any length included; ``record_id`` names the column of the ids.

    The names of the columns and of the fields in them are fingerprinted as those of a payload are. Columns that no
    layout has give rows with a null layout and a null turn.
    """
    found = fingerprint(F.parse_json(F.lit(json.dumps(_example(rows.schema)))))
    same = [x for x in layouts if sorted(_paths(_example(rows.schema))) == sorted(_paths(json.loads(x.example)))]
    turns, name = F.lit(None).cast(_TURNS), F.lit(None).cast("string")
    if same:
        turns = same[0].turns(F.col(record_id), lambda path, kind="string": F.col(f"`{path}`").cast(kind))
        name = F.lit(same[0].name)
    return _one_per_turn(rows.select(F.col(record_id).alias("record_id"), found.alias("fingerprint"), name.alias("_name"), turns.alias("_turns")), F.col("_name"), F.col("_turns"))


def _known(layout: Layout) -> Column:
    return fingerprint(F.parse_json(F.lit(layout.example)))


def _example(kind: DataType) -> object:
    """A value with the fields of a type."""
    if isinstance(kind, StructType):
        return {f.name: _example(f.dataType) for f in kind}
    return [_example(kind.elementType)] if isinstance(kind, ArrayType) else ""


def _paths(value: object, path: str = "") -> list[str]:
    if isinstance(value, dict):
        return [p for k, v in value.items() for p in _paths(v, f"{path}.{json.dumps(k)}")]
    return _paths(value[0], path + "[]") if isinstance(value, list) and value else [path]


def without_texts(payload: Column) -> Column:
    """JSON with empty strings for the strings that are no names; escapes go first, those in names too."""
    return F.regexp_replace(F.regexp_replace(payload, r"\\(?s:.)", ""), r'([:,\[]\s*+)"[^"]*+"(?!\s*+:)', '$1""')


def _one_per_turn(r: DataFrame, name: Column, turns: Column) -> DataFrame:
    return r.select("record_id", "fingerprint", name.alias("layout"), F.explode_outer(turns).alias("t")).select(
        "record_id", "fingerprint", "layout", "t.conv_id", "t.turn", "t.role", "t.text"
    )


def escaped(text: Column) -> Column:
    """``text`` without control strings: a backslash follows the first character of each, and of each already so marked."""
    return F.regexp_replace(text, _ESCAPE, r"$1\\")


def unescape(text: str) -> str:
    return _UNESCAPE.sub(r"\1", text)


def _role_line(role: Column) -> Column:
    return escaped(F.replace(F.replace(role, F.lit("\\"), F.lit("\\\\")), F.lit("\n"), F.lit("\\n")))


def _role_of(line: str) -> str:
    return re.sub(r"\\(.)", lambda m: "\n" if m[1] == "n" else m[1], unescape(line))


def format_turns(turns: DataFrame) -> DataFrame:
    """(conv_id, turn, segment, loss_from, loss_to) per turn; loss offsets are code points of the segment, null outside the mask.

    A segment is start marker, role, line feed, text, end marker, line feed; the texts of the
    assistant are the mask. Turns of a conversation follow each other by turn, then by segment; a null turn is last.
    """
    role, text = F.coalesce("role", F.lit("")), F.coalesce("text", F.lit(""))
    head = F.concat(F.lit(START), _role_line(role), F.lit("\n"))
    t = turns.select("conv_id", "turn", head.alias("_head"), escaped(text).alias("_body"), (role == LEARNT_ROLE).alias("_learnt"))
    begin = F.length("_head")
    return t.select(
        "conv_id", "turn", F.concat("_head", "_body", F.lit(END + "\n")).alias("segment"),
        F.when(F.col("_learnt"), begin).alias("loss_from"), F.when(F.col("_learnt"), begin + F.length("_body")).alias("loss_to"),
    )


def read_back(segments: DataFrame) -> DataFrame:
    """Digests per conversation, read from the formatted text: conv_id, n_turns, turns_sha256, loss_chars, loss_sha256, formatted_chars.

    Segments are sorted and streamed, so that a conversation of any length takes the memory of one segment.
    """

    def batches(parts: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        names = ["conv_id", "n_turns", "turns_sha256", "loss_chars", "loss_sha256", "formatted_chars"]
        kinds = [pa.int64(), pa.int64(), pa.string(), pa.int64(), pa.string(), pa.int64()]
        now, done = None, []

        def close() -> None:
            conv, turns, said, chars, learnt, size = now
            done.append((conv, turns, said.hexdigest(), chars, learnt.hexdigest(), size))

        for part in parts:
            for conv, segment, begin, end in zip(*(part.column(c).to_pylist() for c in ("conv_id", "segment", "loss_from", "loss_to"))):
                if now is None or now[0] != conv:
                    if now is not None:
                        close()
                    now = [conv, 0, hashlib.sha256(), 0, hashlib.sha256(), 0]
                line, body = segment[len(START) : -len(END) - 1].split("\n", 1)
                now[1] += 1
                now[2].update(f"{_role_of(line)}\n{unescape(body)}\n".encode())
                if begin is not None:
                    masked = unescape(segment[begin:end])
                    now[3] += len(masked)
                    now[4].update(masked.encode())
                now[5] += len(segment)
            yield pa.RecordBatch.from_arrays([pa.array([d[k] for d in done], kinds[k]) for k in range(6)], names)
            done = []
        if now is not None:
            close()
            yield pa.RecordBatch.from_arrays([pa.array([d[k] for d in done], kinds[k]) for k in range(6)], names)

    ordered = segments.repartition("conv_id").sortWithinPartitions("conv_id", F.col("turn").asc_nulls_last(), "segment")
    return ordered.mapInArrow(
        batches, "conv_id long, n_turns long, turns_sha256 string, loss_chars long, loss_sha256 string, formatted_chars long"
    )

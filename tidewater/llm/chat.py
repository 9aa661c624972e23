"""Chat formatting: layouts told by a fingerprint of their field paths, reversible turns."""

from __future__ import annotations

import hashlib
import json
from collections.abc import Iterable, Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tidewater.llm.common import table, travels
from tidewater.session import work_dir

travels(__name__)

# The template: a role between the first two, then the text, then the last.
ROLE_OPENS, ROLE_ENDS, TURN_ENDS = "<s>[INST]", "[/INST]", "</s>"
CONTROL = ("<s>", "</s>", "[INST]", "[/INST]")
LEARNED_ROLE = "assistant"

# Layouts, the more telling first: field paths ([] stands for the elements of an array),
# then the turns as (role, field) from the record itself or as (array, role field, text
# field). The conversation's id is no part of a layout.
LAYOUTS: dict[frozenset[str], dict] = {
    frozenset(["turn", "role", "text"]): {"rows": ("role", "text")},
    frozenset(["messages[].role", "messages[].content"]): {"array": ("messages", "role", "content")},
    frozenset(["conversations[].from", "conversations[].value"]): {"array": ("conversations", "from", "value")},
    frozenset(["instruction", "input", "output"]): {
        "fields": (("user", ("instruction", "input")), ("assistant", ("output",)))
    },
    frozenset(["instruction", "output"]): {"fields": (("user", ("instruction",)), ("assistant", ("output",)))},
    frozenset(["prompt", "response"]): {"fields": (("user", ("prompt",)), ("assistant", ("response",)))},
    frozenset(["prompt", "completion"]): {"fields": (("user", ("prompt",)), ("assistant", ("completion",)))},
    frozenset(["system", "prompt", "response"]): {
        "fields": (("system", ("system",)), ("user", ("prompt",)), ("assistant", ("response",)))
    },
}
KNOWN_PATHS = frozenset().union(*LAYOUTS)
# Names of roles in the wild.
ROLE_NAMES = {"human": "user", "gpt": "assistant", "bot": "assistant", "model": "assistant"}


def fingerprint(paths: Iterable[str]) -> str:
    """A hash of the field paths that any layout knows; others do not matter."""
    return hashlib.sha256("\n".join(sorted(KNOWN_PATHS.intersection(paths))).encode()).hexdigest()


MAPPINGS: dict[str, dict | None] = {fingerprint(paths): mapping for paths, mapping in LAYOUTS.items()}


def mapping_of(paths: Iterable[str]) -> dict | None:
    """The mapping for records with these field paths.

    That of their fingerprint; records with the paths of several layouts, or with some of
    another one's, get the largest layout whose paths they all have, of equal ones the
    first in LAYOUTS. A fingerprint's choice is remembered.
    """
    known = KNOWN_PATHS.intersection(paths)
    mark = fingerprint(known)
    if mark not in MAPPINGS:
        whole = [layout for layout in LAYOUTS if layout <= known]
        MAPPINGS[mark] = LAYOUTS[max(whole, key=len)] if whole else None
    return MAPPINGS[mark]


def schema_paths(kind: T.DataType, at: str = "") -> Iterator[str]:
    """The field paths of a schema; those that a layout knows, whatever they hold."""
    if at in KNOWN_PATHS:
        yield at
    elif isinstance(kind, T.StructType):
        for field in kind.fields:
            yield from schema_paths(field.dataType, f"{at}.{field.name}" if at else field.name)
    elif isinstance(kind, T.ArrayType):
        yield from schema_paths(kind.elementType, f"{at}[]")
    else:
        yield at


def value_paths(value: object, at: str = "") -> Iterator[str]:
    """The same of a parsed record; an empty array of a layout has all its fields."""
    if at in KNOWN_PATHS:
        yield at
    elif isinstance(value, dict):
        for name, inner in value.items():
            yield from value_paths(inner, f"{at}.{name}" if at else name)
    elif isinstance(value, list):
        if not value:
            yield from [p for p in KNOWN_PATHS if p.startswith(f"{at}[]")]
        for inner in value:
            yield from value_paths(inner, f"{at}[]")
    else:
        yield at


def _text(value: Column, kind: T.DataType) -> Column:
    """A field as text: what is no text is written as JSON, null is empty."""
    if isinstance(kind, T.StructType | T.ArrayType | T.MapType):
        value = F.to_json(value)
    return F.coalesce(value.cast("string"), F.lit(""))


def _role(name: Column) -> Column:
    role = F.coalesce(name, F.lit(""))
    for old, new in ROLE_NAMES.items():
        role = F.when(role == old, new).otherwise(role)
    return role


def canonical_turns(records: DataFrame, conv_id: str = "conv_id") -> DataFrame:
    """conv_id, turn, role and text of ``records`` of one layout, told by its schema.

    Raises ValueError for a layout without a mapping. Null texts and roles are empty,
    those of other types are written as text. Other columns, of whatever name, are not
    read. Elements of arrays are numbered from 0; a null array has no turns, a null
    element an empty one. Repeated rows are turns of their own.
    """
    paths = list(schema_paths(records.schema))
    mapping = mapping_of(p for p in paths if p != conv_id)
    if mapping is None:
        raise ValueError(f"no mapping for the fields {sorted(paths)}")
    if "rows" in mapping:
        role, text = (_text(F.col(c), records.schema[c].dataType).alias(n) for c, n in zip(mapping["rows"], ("role", "text"), strict=True))
        return records.select(F.col(conv_id).alias("conv_id"), "turn", role, text)
    if "array" in mapping:
        name, role, text = mapping["array"]
        fields = records.schema[name].dataType.elementType
        turns = F.transform(
            F.col(name),
            lambda x: F.struct(
                _role(_text(x[role], fields[role].dataType)).alias("role"),
                _text(x[text], fields[text].dataType).alias("text"),
            ),
        )
    else:
        said = lambda c: F.when(F.col(c).isNotNull(), _text(F.col(c), records.schema[c].dataType))
        turns = F.array(
            *[
                F.struct(F.lit(role).alias("role"), F.concat_ws("\n", *map(said, fields)).alias("text"))
                for role, fields in mapping["fields"]
            ]
        )
    return records.select(F.col(conv_id).alias("conv_id"), F.posexplode(turns).alias("turn", "t")).select(
        "conv_id", "turn", "t.role", "t.text"
    )


def _said(value: object) -> str:
    """A JSON value as text: what is no text is written as JSON, null is empty."""
    return value if isinstance(value, str) else "" if value is None else json.dumps(value, ensure_ascii=False)


def record_turns(raw: str | None) -> list[tuple[int, str, str]]:
    """(turn, role, text) of a record in JSON; see ``canonical_json``."""
    unmapped = [(-1, "unmapped", raw or "")]
    try:
        record = json.loads(raw or "")
    except (ValueError, RecursionError):
        return unmapped
    mapping = mapping_of(value_paths(record)) if isinstance(record, dict) else None
    if mapping is None:
        return unmapped
    if "rows" in mapping:
        turn = record["turn"]
        if isinstance(turn, bool) or not isinstance(turn, int | None) or not -(2**31) <= (turn or 0) < 2**31:
            return unmapped
        return [(turn or 0, _said(record["role"]), _said(record["text"]))]
    if "array" in mapping:
        name, role, text = mapping["array"]
        if not all(isinstance(x, dict) for x in record[name]):
            return unmapped
        said = [(_said(x.get(role)), _said(x.get(text))) for x in record[name]]
        return [(k, ROLE_NAMES.get(who, who), what) for k, (who, what) in enumerate(said)]
    return [
        (k, role, "\n".join(_said(record[f]) for f in fields if record[f] is not None))
        for k, (role, fields) in enumerate(mapping["fields"])
    ]


def canonical_json(records: DataFrame, column: str, conv_id: str = "conv_id") -> DataFrame:
    """The same from JSON texts of mixed layouts: every record's own fingerprint decides.

    A record with an empty array of turns has none. Records without a mapping, nulls,
    texts that are no JSON objects, arrays with elements that are no objects and turn
    numbers that are no integers give one row of turn -1 with the role ``unmapped`` and
    the record as text. Names and texts of other types are written as JSON.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        kinds = (pa.int32(), pa.string(), pa.string())
        for batch in batches:
            found = [record_turns(raw) for raw in batch[column].to_pylist()]
            of = pa.array([i for i, turns in enumerate(found) for _ in turns], pa.int64())
            columns = list(zip(*[t for turns in found for t in turns], strict=True)) or [[], [], []]
            made = [pa.array(x, t) for x, t in zip(columns, kinds, strict=True)]
            yield pa.RecordBatch.from_arrays([batch[0].take(of), *made], ["conv_id", "turn", "role", "text"])

    source = records.select(F.col(conv_id).alias("conv_id"), F.col(column))
    schema = T.StructType([source.schema["conv_id"]]).add("turn", T.IntegerType())
    return source.mapInArrow(run, schema.add("role", T.StringType()).add("text", T.StringType()))


def escaped(text: Column) -> Column:
    """Backslashes doubled, and one put after the first character of control strings."""
    text = F.regexp_replace(text, r"\\", r"\\\\")
    return F.regexp_replace(text, r"([<\[])(?=/?(?:s>|INST\]))", r"$1\\")


def unescaped(text: Column) -> Column:
    return F.regexp_replace(text, r"\\(\\?)", "$1")


def formatted(turns: DataFrame) -> DataFrame:
    """``turns`` as conv_id, turn, formatted, loss_start and loss_end (code points).

    One row a turn; a conversation is its rows' ``formatted`` in order of turn, so no
    conversation has to fit one value. The loss mask covers the assistant's texts.
    """
    head = F.concat(F.lit(ROLE_OPENS), escaped(F.col("role")), F.lit(ROLE_ENDS))
    body = escaped(F.col("text"))
    whole = F.concat(head, body, F.lit(TURN_ENDS))
    start = F.length(head)
    end = F.when(F.col("role") == LEARNED_ROLE, start + F.length(body)).otherwise(start)
    return turns.select(
        "conv_id", "turn", whole.alias("formatted"), start.alias("loss_start"), end.alias("loss_end")
    )


def parsed(rows: DataFrame) -> DataFrame:
    """``formatted`` rows read back: role, text and the unescaped text under the mask."""
    opens = len(ROLE_OPENS)
    role_end = F.locate(ROLE_ENDS, F.col("formatted"), opens + 1)
    role = F.substring("formatted", F.lit(opens + 1), role_end - opens - 1)
    text_start = role_end + len(ROLE_ENDS)
    text = F.substring("formatted", text_start, F.length("formatted") - len(TURN_ENDS) - text_start + 1)
    loss = F.substring("formatted", F.col("loss_start") + 1, F.col("loss_end") - F.col("loss_start"))
    return rows.select(
        "conv_id", "turn", unescaped(role).alias("role"), unescaped(text).alias("text"),
        unescaped(loss).alias("loss"), F.length("formatted").cast("long").alias("chars"),
    )


def conversation_digests(turns: DataFrame) -> DataFrame:
    """Counts and hashes per conversation of ``parsed`` rows.

    Rows stream through in order of conversation and turn (then role and text), and a
    task holds one batch of them, however long a conversation is. A hash over a whole
    conversation is taken in one place; copies of a conversation's rows follow each other.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        current, state = object(), None
        done: list[tuple] = []

        def close() -> None:
            if state is not None:
                n, said, loss_chars, loss, chars = state
                done.append((current, n, said.hexdigest(), loss_chars, loss.hexdigest(), chars))

        def out() -> pa.RecordBatch:
            columns = list(zip(*done, strict=True)) or [[]] * 6
            done.clear()
            return pa.RecordBatch.from_arrays(
                [pa.array(x, f.type) for x, f in zip(columns, fields, strict=True)], schema=fields
            )

        fields = None
        for batch in batches:
            fields = pa.schema(
                [
                    ("conv_id", batch.schema.field("conv_id").type), ("n_turns", pa.int64()),
                    ("turns_sha256", pa.string()), ("loss_chars", pa.int64()),
                    ("loss_sha256", pa.string()), ("formatted_chars", pa.int64()),
                ]
            )
            columns = [batch[c].to_pylist() for c in ("conv_id", "role", "text", "loss", "chars")]
            for conv, role, text, loss, chars in zip(*columns, strict=True):
                if state is None or conv != current:
                    close()
                    current, state = conv, [0, hashlib.sha256(), 0, hashlib.sha256(), 0]
                state[0] += 1
                state[1].update(f"{role}\n{text}\n".encode())
                state[2] += len(loss)
                state[3].update(loss.encode())
                state[4] += chars
            yield out()
        close()
        if done:
            yield out()

    ordered = turns.repartition("conv_id").sortWithinPartitions("conv_id", "turn", "role", "text")
    schema = turns.select("conv_id").schema
    for name, kind in (
        ("n_turns", "long"), ("turns_sha256", "string"), ("loss_chars", "long"),
        ("loss_sha256", "string"), ("formatted_chars", "long"),
    ):
        schema = schema.add(name, kind)
    return ordered.mapInArrow(run, schema)


def op6_chat(spark: SparkSession, sf_dir: str) -> DataFrame:
    given = table(spark, sf_dir, "conversations")
    turns = canonical_turns(given)
    said = f"{TURN_ENDS}[INST] ok [/INST]"
    control = spark.range(2).select(
        F.lit(-7).cast(turns.schema["conv_id"].dataType).alias("conv_id"),
        F.col("id").cast(turns.schema["turn"].dataType).alias("turn"),
        F.when(F.col("id") == 0, "user").otherwise(LEARNED_ROLE).alias("role"),
        F.lit(said).alias("text"),
    )
    out = formatted(turns.unionByName(control))
    folder = work_dir(spark, "chat")
    # Rows say where they belong, so a long conversation may lie in many files.
    out.write.option("compression", "zstd").parquet(folder)
    return conversation_digests(parsed(spark.read.schema(out.schema).parquet(folder)))

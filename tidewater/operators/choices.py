"""Choices inside nested records: values that differ in kind from row to row.

Records are Spark variants, which say their own kind. Where all rows agree a place
becomes a plain typed column; where they do not, a struct with a field per kind seen.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

# Fields of a choice, in order: how a kind is read. Records and lists are kept as JSON.
KINDS = {"long": "bigint", "double": "double", "boolean": "boolean", "string": "string", "json": None}


class _Schema:
    """A reader of the schema that ``schema_of_variant_agg`` writes."""

    def __init__(self, text: str):
        self.text, self.at = text, 0

    def _take(self, mark: str) -> bool:
        if self.text.startswith(mark, self.at):
            self.at += len(mark)
            return True
        return False

    def _name(self) -> str:
        if not self._take("`"):
            end = self.text.index(":", self.at)
            name, self.at = self.text[self.at : end], end
            return name
        name = ""
        while True:
            end = self.text.index("`", self.at)
            name, self.at = name + self.text[self.at : end], end + 1
            if not self._take("`"):
                return name
            name += "`"

    def kind(self) -> str | list | dict:
        """A type's name, a list of the element's, or fields by name."""
        if self._take("OBJECT<"):
            fields: dict[str, str | list | dict] = {}
            while not self._take(">"):
                name = self._name()
                self._take(": ")
                fields[name] = self.kind()
                self._take(", ")
            return fields
        if self._take("ARRAY<"):
            element = self.kind()
            self._take(">")
            return [element]
        start = self.at
        while self.at < len(self.text) and self.text[self.at] not in ",>":
            self.at += self.text[self.at :].index(")") + 1 if self.text[self.at] == "(" else 1
        return self.text[start : self.at]


def _field(value: Column, name: str) -> Column:
    quoted = name.replace("\\", "\\\\").replace("'", "\\'")
    return F.try_variant_get(value, f"$['{quoted}']", "variant")


def _elements(value: Column) -> Column:
    return F.try_variant_get(value, "$", "array<variant>")


def kind_of(value: Column) -> Column:
    """The name in KINDS of a variant's kind; NULL for none."""
    said = F.schema_of_variant(value)
    return (
        F.when(said.isin("BIGINT", "INT", "SMALLINT", "TINYINT"), "long")
        .when(said.startswith("DECIMAL") | said.isin("DOUBLE", "FLOAT"), "double")
        .when(said == "BOOLEAN", "boolean")
        .when(said.startswith("OBJECT") | said.startswith("ARRAY"), "json")
        .when(said != "VOID", "string")
    )


def _mixed(kind: str | list | dict, value: Column, at: str) -> dict[str, Column]:
    """For each place of mixed kinds: the kinds that a row holds there, as an array."""
    if isinstance(kind, dict):
        found = {}
        for name, inner in kind.items():
            found |= _mixed(inner, _field(value, name), f"{at}/{name}")
        return found
    if isinstance(kind, list):
        def of_elements(place: str) -> Column:
            return F.flatten(F.transform(_elements(value), lambda x: _mixed(kind[0], x, f"{at}[]")[place]))

        # The places alone count here, of whatever element.
        return {place: of_elements(place) for place in _mixed(kind[0], value, f"{at}[]")}
    return {at: F.array_compact(F.array(kind_of(value)))} if kind == "VARIANT" else {}


def _resolved(kind: str | list | dict, value: Column, at: str, seen: dict[str, list[str]]) -> Column:
    if isinstance(kind, dict):
        fields = [_resolved(inner, _field(value, n), f"{at}/{n}", seen).alias(n) for n, inner in kind.items()]
        return F.when(kind_of(value) == "json", F.struct(*fields)) if fields else F.lit(None).cast("string")
    if isinstance(kind, list):
        return F.transform(_elements(value), lambda x: _resolved(kind[0], x, f"{at}[]", seen))
    if kind != "VARIANT":
        name = "double" if kind.startswith("DECIMAL") else "string" if kind == "VOID" else kind
        return F.try_variant_get(value, "$", name)

    def choice(name: str) -> Column:
        read = F.to_json(value) if KINDS[name] is None else F.try_variant_get(value, "$", KINDS[name])
        return F.when(kind_of(value) == name, read).alias(name)

    return F.when(kind_of(value).isNotNull(), F.struct(*map(choice, seen[at])))


def resolve_nested(df: DataFrame, column: str, into: str | None = None) -> DataFrame:
    """``df`` with the records of ``column``, variants or JSON texts, as a typed column.

    Numbers of different types become doubles. Where rows hold values of different kinds
    (numbers, truth values, texts, records or lists), at any depth and inside lists, a
    struct has a field for each kind seen, of which one holds the value. Places that are
    null everywhere become text. JSON that cannot be read, and records in which a place
    is missing, have NULL there. The result's schema depends on the data: one pass finds
    it and, where kinds are mixed, another one the kinds.
    """
    into = into or column
    is_variant = df.schema[column].dataType.simpleString() == "variant"
    value = F.col(column) if is_variant else F.try_parse_json(column)
    text = df.agg(F.schema_of_variant_agg(value)).first()[0]
    kind = _Schema(text).kind()
    places = _mixed(kind, value, "")
    seen: dict[str, list[str]] = {}
    if places:
        # Of a row's kinds each counts once, so sets of sets stay small.
        found = df.agg(
            *[F.collect_set(F.array_sort(F.array_distinct(kinds))).alias(f"k{i}") for i, kinds in enumerate(places.values())]
        ).first()
        for i, place in enumerate(places):
            has = {name for some in found[f"k{i}"] for name in some}
            seen[place] = [name for name in KINDS if name in has]
    out = _resolved(kind, value, "", seen).alias(into)
    others = [F.col(f"`{c}`") for c in df.columns if c != into]
    return df.select(*others, out)

"""Schemas as data: one dialect turned into another (Z2), and a schema compiled to a column that checks values."""

from __future__ import annotations

import json
import re
from functools import reduce

from pyspark.sql import Column
from pyspark.sql import functions as F


def plain_schema(schema):
    """A schema with lower-case types, where ``nullable`` became a union with null; converting again changes nothing."""
    if isinstance(schema, list):
        return [plain_schema(x) for x in schema]
    if not isinstance(schema, dict):
        return schema
    out = {}
    for name, value in schema.items():
        if name == "nullable":
            continue
        out[name] = value.lower() if name == "type" and isinstance(value, str) else plain_schema(value)
    kind = out.get("type")
    if schema.get("nullable") is True and kind is not None:
        kinds = kind if isinstance(kind, list) else [kind]
        out["type"] = kinds if "null" in [str(k).lower() for k in kinds] else [*kinds, "null"]
    return out


def without_keys(schema, unwanted: set[str]):
    """A schema without the named keys, at any depth."""
    if isinstance(schema, list):
        return [without_keys(x, unwanted) for x in schema]
    if isinstance(schema, dict):
        return {k: without_keys(v, unwanted) for k, v in schema.items() if k not in unwanted}
    return schema


def spark_type(schema: dict) -> str:
    """The Spark type of a plain schema: objects as structs, arrays, texts, numbers and booleans."""
    kind = schema.get("type")
    kind = next((k for k in kind if k != "null"), "string") if isinstance(kind, list) else kind
    if kind == "object":
        return "struct<" + ",".join(f"{k}:{spark_type(v)}" for k, v in schema.get("properties", {}).items()) + ">"
    if kind == "array":
        return f"array<{spark_type(schema.get('items', {}))}>"
    return {"integer": "bigint", "number": "double", "boolean": "boolean"}.get(kind, "string")


# ---- a schema compiled to one column over VARIANT

# Keys of a schema that assert nothing.
ANNOTATIONS = {"$schema", "$id", "$comment", "$defs", "definitions", "title", "description", "default", "examples", "example", "format", "propertyOrdering", "readOnly", "writeOnly", "deprecated"}
_NAME = re.compile(r"[A-Za-z_][A-Za-z0-9_]*")


def _step(name: str) -> str:
    if _NAME.fullmatch(name):
        return "." + name
    if "'" in name:
        raise ValueError(f"a property name with a quote is not supported: {name}")
    return f"['{name}']"


def _is(kind: Column, node: Column, wanted: str) -> Column:
    """Whether a value of that Spark kind has a type of JSON Schema; 1.0 is an integer, true is no number."""
    number = (kind == "BIGINT") | kind.startswith("DECIMAL") | (kind == "DOUBLE")
    value = F.try_variant_get(node, "$", "double")
    tests = {
        "null": lambda: kind == "VOID",
        "boolean": lambda: kind == "BOOLEAN",
        "string": lambda: kind == "STRING",
        "array": lambda: kind.startswith("ARRAY"),
        "object": lambda: kind.startswith("OBJECT"),
        "number": lambda: number,
        "integer": lambda: (kind == "BIGINT") | kind.endswith(",0)") | ((kind == "DOUBLE") & (value == F.rint(value))),
    }
    if wanted not in tests:
        raise ValueError(f"unknown type: {wanted}")
    return tests[wanted]()


def _equals(kind: Column, node: Column, values: list) -> Column:
    """Whether a value is one of these, of the same type."""
    texts = [v for v in values if isinstance(v, str)]
    out = (kind == "STRING") & F.try_variant_get(node, "$", "string").isin(texts) if texts else F.lit(False)
    for v in values:
        if isinstance(v, bool):
            out = out | ((kind == "BOOLEAN") & (F.try_variant_get(node, "$", "boolean") == v))
        elif v is None:
            out = out | (kind == "VOID")
        elif isinstance(v, int | float):
            out = out | (_is(kind, node, "number") & (F.try_variant_get(node, "$", "double") == float(v)))
        elif not isinstance(v, str):
            same = F.parse_json(F.lit(json.dumps(v, ensure_ascii=False)))
            out = out | (F.to_json(node) == F.to_json(same))
    return out


class _Compiler:
    def __init__(self, schema: dict):
        self.top = schema

    def resolved(self, schema: dict, seen: tuple = ()) -> tuple[dict, tuple]:
        while "$ref" in schema:
            ref = schema["$ref"]
            if not ref.startswith("#/") or ref in seen:
                raise ValueError(f"only local references that do not lead back are supported: {ref}")
            seen, schema = (*seen, ref), self.top
            for part in ref[2:].split("/"):
                schema = schema[part]
        return schema, seen

    def first(self, root: Column, at: str, schema, seen: tuple = ()) -> Column:
        """The first violation at or below ``at``, null if there is none or nothing is there."""
        node = root if at == "$" else F.try_variant_get(root, at, "variant")
        kind = F.schema_of_variant(node)
        fault = lambda when, rule, path=None: F.when(when, F.struct((F.lit(at) if path is None else path).alias("path"), F.lit(rule).alias("rule")))
        if schema is True or schema == {}:
            return fault(F.lit(False), "none")
        if schema is False:
            return fault(node.isNotNull(), "false")
        schema, seen = self.resolved(schema, seen)
        rules = dict(schema)
        array = F.when(kind.startswith("ARRAY"), F.try_variant_get(node, "$", "array<variant>"))
        keys = F.when(kind.startswith("OBJECT"), F.map_keys(F.try_variant_get(node, "$", "map<string,variant>")))
        text = F.when(kind == "STRING", F.try_variant_get(node, "$", "string"))
        number = F.when(_is(kind, node, "number"), F.try_variant_get(node, "$", "double"))
        found: list[Column] = []
        if (kinds := rules.pop("type", None)) is not None:
            kinds = kinds if isinstance(kinds, list) else [kinds]
            found.append(fault(~reduce(Column.__or__, [_is(kind, node, str(k).lower()) for k in kinds]), "type"))
        if "const" in rules:
            found.append(fault(~_equals(kind, node, [rules.pop("const")]), "const"))
        if "enum" in rules:
            found.append(fault(~_equals(kind, node, rules.pop("enum")), "enum"))
        for name in rules.pop("required", []):
            found.append(fault(kind.startswith("OBJECT") & F.try_variant_get(root, at + _step(name), "variant").isNull(), "required", F.lit(at + _step(name))))
        known = rules.pop("properties", {})
        other = rules.pop("additionalProperties", True)
        strange = F.filter(keys, lambda k: ~k.isin(list(known))) if known else keys
        if other is False:
            found.append(fault(F.size(strange) > 0, "additionalProperties", F.concat(F.lit(at + "."), F.array_min(strange))))
        bounds = {
            "minimum": lambda v: number < v,
            "maximum": lambda v: number > v,
            "exclusiveMinimum": lambda v: number <= v,
            "exclusiveMaximum": lambda v: number >= v,
            "multipleOf": lambda v: number % v != 0,
            "minLength": lambda v: F.char_length(text) < v,
            "maxLength": lambda v: F.char_length(text) > v,
            "pattern": lambda v: ~text.rlike(v),
            "minItems": lambda v: F.size(array) < v,
            "maxItems": lambda v: F.size(array) > v,
            "minProperties": lambda v: F.size(keys) < v,
            "maxProperties": lambda v: F.size(keys) > v,
        }
        for rule, broken in bounds.items():
            if rule in rules:
                value = rules.pop(rule)
                found.append(fault(F.coalesce(broken(value), F.lit(False)), rule))
        if rules.pop("uniqueItems", False):
            texts = F.transform(array, lambda x: F.to_json(x))
            found.append(fault(F.coalesce(F.size(F.array_distinct(texts)) < F.size(array), F.lit(False)), "uniqueItems"))
        for part in rules.pop("allOf", []):
            found.append(self.first(root, at, part, seen))
        holds = lambda part: self.first(root, at, part, seen).isNull().cast("int")
        if (parts := rules.pop("anyOf", None)) is not None:
            found.append(fault(reduce(Column.__add__, map(holds, parts)) == 0, "anyOf"))
        if (parts := rules.pop("oneOf", None)) is not None:
            found.append(fault(reduce(Column.__add__, map(holds, parts)) != 1, "oneOf"))
        if "not" in rules:
            found.append(fault(holds(rules.pop("not")) == 1, "not"))
        for name, part in known.items():
            inner = self.first(root, at + _step(name), part, seen)
            found.append(F.when(kind.startswith("OBJECT"), inner))
        if isinstance(other, dict) and other:
            pairs = F.filter(F.map_entries(F.try_variant_get(node, "$", "map<string,variant>")), lambda e: ~e["key"].isin(list(known)) if known else F.lit(True))
            found.append(self.within(F.when(kind.startswith("OBJECT"), F.transform(pairs, lambda e: self.moved(F.concat(F.lit(at + "."), e["key"]), self.first(e["value"], "$", other, seen))))))
        items = rules.pop("items", True)
        if isinstance(items, list):
            raise ValueError("a list of item schemas is not supported")
        if items is not True and items != {}:
            found.append(self.within(F.transform(array, lambda x, i: self.moved(F.concat(F.lit(at + "["), i.cast("string"), F.lit("]")), self.first(x, "$", items, seen)))))
        if unknown := set(rules) - ANNOTATIONS - {"$ref"}:
            raise ValueError(f"not supported in a schema: {', '.join(sorted(unknown))}")
        return F.when(node.isNotNull(), F.coalesce(*found)) if found else fault(F.lit(False), "none")

    @staticmethod
    def moved(before: Column, inner: Column) -> Column:
        return F.when(inner.isNotNull(), F.struct(F.concat(before, F.substring(inner["path"], F.lit(2), F.length(inner["path"]))).alias("path"), inner["rule"].alias("rule")))

    @staticmethod
    def within(faults: Column) -> Column:
        return F.get(F.filter(faults, lambda x: x.isNotNull()), F.lit(0))


def violation(value: Column, schema: dict) -> Column:
    """``path, rule`` of the first thing in a VARIANT that breaks a JSON Schema (of either dialect); null if nothing does.

    Compiled once into an expression that runs where the rows are.  At each value come its type, ``const`` and
    ``enum``, what is required (in the schema's order), names that are not allowed (the smallest), bounds of numbers,
    texts, lists and objects, combinations, then its properties in the schema's order and its items in theirs.  A
    value that is not there breaks nothing itself.  Known besides annotations: ``type`` (also a list), ``const``, ``enum``,
    ``required``, ``properties``, ``additionalProperties``, ``items``, minima and maxima, ``multipleOf``, ``pattern``
    (Java's dialect, found anywhere), ``uniqueItems``, ``allOf``, ``anyOf``, ``oneOf``, ``not`` and local references; a
    schema with anything else is refused rather than checked in part.
    """
    plain = plain_schema(schema)
    return _Compiler(plain).first(value, "$", plain)

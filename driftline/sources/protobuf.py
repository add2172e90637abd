"""Protocol-buffer messages by the text of their .proto file, without generated code.

A message becomes JSON text by its descriptor, a batch at a time, and then a variant. Only what carries data is read of a file: messages,
enums, and their fields; imports, services, options and extensions are passed over.
"""

from __future__ import annotations

import base64
import json
import re
import struct
from dataclasses import dataclass, field

import pandas as pd
from pyspark.sql import Column
from pyspark.sql import functions as F

TOKEN = re.compile(r'"(?:[^"\\]|\\.)*"|[A-Za-z_.][\w.]*|-?\d+|[{}=;<>,()\[\]]')
VARINT = {"int32", "int64", "uint32", "uint64", "sint32", "sint64", "bool"}
FIXED = {"fixed32": "<I", "sfixed32": "<i", "float": "<f", "fixed64": "<Q", "sfixed64": "<q", "double": "<d"}


@dataclass
class Field:
    name: str
    kind: str
    repeated: bool = False
    key: str | None = None  # of a map, whose values are of ``kind``


@dataclass
class Message:
    fields: dict[int, Field] = field(default_factory=dict)


@dataclass
class Schema:
    messages: dict[str, Message] = field(default_factory=dict)
    enums: dict[str, dict[int, str]] = field(default_factory=dict)

    def find(self, kind: str, within: str) -> str:
        """The full name of a type used inside ``within``."""
        kind, scope = kind.lstrip("."), within.split(".")
        for n in range(len(scope), -1, -1):
            name = ".".join([*scope[:n], kind])
            if name in self.messages or name in self.enums:
                return name
        tail = [n for n in (*self.messages, *self.enums) if kind.endswith("." + n)]
        if not tail:
            raise ValueError(f"unknown type {kind} in {within}")
        return tail[0]


def parse(text: str) -> Schema:
    words = TOKEN.findall(re.sub(r"//[^\n]*|/\*.*?\*/", " ", text, flags=re.S))
    out = Schema()

    def skip(i: int) -> int:
        """Behind a statement or block."""
        depth = 0
        while i < len(words):
            depth += (words[i] == "{") - (words[i] == "}")
            if depth == 0 and words[i] in (";", "}"):
                return i + 1
            i += 1
        return i

    def body(i: int, name: str) -> int:
        message = out.messages.setdefault(name, Message())
        while words[i] != "}":
            w = words[i]
            if w in ("message", "enum"):
                i = (body if w == "message" else labels)(i + 3, f"{name}.{words[i + 1]}")
            elif w == "oneof":
                i += 3
                while words[i] != "}":
                    i = one(i, message)
                i += 1
            elif w in ("option", "reserved", "extensions", "extend", ";"):
                i = i + 1 if w == ";" else skip(i)
            else:
                i = one(i, message)
        return i + 1

    def one(i: int, message: Message) -> int:
        if words[i] == "option":
            return skip(i)
        repeated = words[i] == "repeated"
        if words[i] in ("repeated", "optional", "required"):
            i += 1
        if words[i] == "map" and words[i + 1] == "<":
            message.fields[int(words[i + 8])] = Field(words[i + 6], words[i + 4], True, words[i + 2])
            return skip(i)
        message.fields[int(words[i + 3])] = Field(words[i + 1], words[i], repeated)
        return skip(i)

    def labels(i: int, name: str) -> int:
        own = out.enums.setdefault(name, {})
        while words[i] != "}":
            if words[i] not in ("option", "reserved") and words[i + 1] == "=":
                own.setdefault(int(words[i + 2]), words[i])
            i = skip(i)
        return i + 1

    i = 0
    while i < len(words):
        if words[i] in ("message", "enum"):
            i = (body if words[i] == "message" else labels)(i + 3, words[i + 1])
        else:
            i = skip(i)
    return out


def _varint(data: bytes, at: int) -> tuple[int, int]:
    value = shift = 0
    while True:
        if at >= len(data) or shift > 63:
            raise ValueError("a number ends early")
        b = data[at]
        value |= (b & 127) << shift
        at, shift = at + 1, shift + 7
        if b < 128:
            return value & (1 << 64) - 1, at


def _scalar(kind: str, value: int):
    if kind == "bool":
        return value != 0
    if kind.startswith("sint"):
        return (value >> 1) ^ -(value & 1)
    bits = 32 if kind.endswith("32") else 64
    value &= (1 << bits) - 1
    return value - (1 << bits) if kind.startswith("int") and value >> (bits - 1) else value


def decode(data: bytes, schema: Schema, name: str) -> dict:
    """A message's fields by name: absent ones left out, unknown ones passed over, bytes as base64, enums by label."""
    out: dict = {}
    at = 0
    while at < len(data):
        tag, at = _varint(data, at)
        wire = tag & 7
        if wire == 0:
            raw, at = _varint(data, at)
        elif wire in (1, 5):
            size = 8 if wire == 1 else 4
            raw, at = data[at : at + size], at + size
        elif wire == 2:
            size, at = _varint(data, at)
            raw, at = data[at : at + size], at + size
        else:
            raise ValueError(f"wire type {wire}")
        if at > len(data):
            raise ValueError("a field ends early")
        f = schema.messages[name].fields.get(tag >> 3)
        if f is None:
            continue
        if f.key:
            pair = Message({1: Field("key", f.key), 2: Field("value", f.kind)})
            inner = Schema({**schema.messages, f"{name}.{f.name}()": pair}, schema.enums)
            entry = decode(raw, inner, f"{name}.{f.name}()")
            out.setdefault(f.name, {})[str(entry.get("key", ""))] = entry.get("value")
        elif f.repeated and wire == 2 and (f.kind in VARINT or f.kind in FIXED or f.kind not in ("string", "bytes") and schema.find(f.kind, name) in schema.enums):
            out.setdefault(f.name, []).extend(_packed(raw, f.kind, schema, name))
        else:
            value = _value(raw, f.kind, schema, name)
            if f.repeated:
                out.setdefault(f.name, []).append(value)
            else:
                out[f.name] = value
    return out


def _packed(raw: bytes, kind: str, schema: Schema, name: str) -> list:
    if kind in FIXED:
        return [x[0] for x in struct.iter_unpack(FIXED[kind], raw)]
    out, at = [], 0
    while at < len(raw):
        value, at = _varint(raw, at)
        out.append(_value(value, kind, schema, name))
    return out


def _value(raw, kind: str, schema: Schema, name: str):
    if kind in VARINT:
        return _scalar(kind, raw)
    if kind in FIXED:
        return struct.unpack(FIXED[kind], raw)[0]
    if kind == "string":
        return raw.decode()
    if kind == "bytes":
        return base64.b64encode(raw).decode()
    full = schema.find(kind, name)
    if full in schema.enums:
        number = _scalar("int32", raw)
        return schema.enums[full].get(number, number)
    return decode(raw, schema, full)


def to_json(value: Column, schema: Schema, name: str) -> Column:
    """Binary messages of a type as JSON text; NULL stays NULL, and a message that breaks off is an error."""
    if name not in schema.messages:
        raise ValueError(f"no message {name}")

    @F.pandas_udf("string")
    def run(messages: pd.Series) -> pd.Series:
        return pd.Series([None if m is None else json.dumps(decode(bytes(m), schema, name), ensure_ascii=False) for m in messages], dtype=object)

    return run(value)

"""Declared column types: DDL text <-> Spark schema, compatibility, widening."""

from __future__ import annotations

import re

from pyspark.sql import types as T

_PLAIN = {
    "TINYINT": T.ByteType(),
    "SMALLINT": T.ShortType(),
    "INT": T.IntegerType(),
    "INTEGER": T.IntegerType(),
    "BIGINT": T.LongType(),
    "LARGEINT": T.DecimalType(38, 0),
    "FLOAT": T.FloatType(),
    "DOUBLE": T.DoubleType(),
    "DATE": T.DateType(),
    "DATETIME": T.TimestampType(),
    "BOOLEAN": T.BooleanType(),
    "STRING": T.StringType(),
    "TEXT": T.StringType(),
    "VARCHAR": T.StringType(),
    "CHAR": T.StringType(),
}

# Widening steps that keep every stored value readable, in order of preference.
WIDENING = {
    "TINYINT": ("SMALLINT", "INT", "BIGINT", "LARGEINT", "FLOAT", "DOUBLE"),
    "SMALLINT": ("INT", "BIGINT", "LARGEINT", "FLOAT", "DOUBLE"),
    "INT": ("BIGINT", "LARGEINT", "FLOAT", "DOUBLE"),
    "BIGINT": ("LARGEINT", "DOUBLE"),
    "FLOAT": ("DOUBLE", "DECIMAL"),
    "DOUBLE": ("DECIMAL",),
    "DECIMAL": ("DECIMAL",),
    "DATE": ("DATETIME",),
}

INT_BOUNDS = {
    "TINYINT": (-(2**7), 2**7 - 1),
    "SMALLINT": (-(2**15), 2**15 - 1),
    "INT": (-(2**31), 2**31 - 1),
    "BIGINT": (-(2**63), 2**63 - 1),
}

_COLUMN = re.compile(r"\s*[`\"]?(\w+)[`\"]?\s+([A-Za-z]\w*)\s*(\(([^)]*)\))?(.*)", re.S)


def base_type(ddl: str) -> str:
    """Type name without parameters; INTEGER is INT."""
    name = re.match(r"\s*(\w+)", ddl).group(1).upper()
    if name.startswith("DECIMAL"):
        return "DECIMAL"
    return {"INTEGER": "INT", "TEXT": "VARCHAR", "STRING": "VARCHAR", "CHAR": "VARCHAR"}.get(name, name)


def text_limit(ddl: str) -> int | None:
    """Byte limit of a VARCHAR(n)."""
    m = re.search(r"(?:VAR)?CHAR\s*\(\s*(\d+)\s*\)", ddl, re.I)
    return int(m.group(1)) if m else None


def field(name: str, ddl: str, nullable: bool = True) -> T.StructField:
    """Spark field for a declared column; the declaration stays in the metadata."""
    kind = base_type(ddl)
    if kind == "DECIMAL":
        digits = re.search(r"\(\s*(\d+)\s*(?:,\s*(\d+)\s*)?\)", ddl)
        dtype: T.DataType = (
            T.DecimalType(int(digits.group(1)), int(digits.group(2) or 0)) if digits else T.DecimalType(18, 4)
        )
    else:
        dtype = _PLAIN[kind]
    meta = {"ddl": re.sub(r"\s+", " ", ddl.strip()).upper()}
    limit = text_limit(ddl)
    if limit is not None:
        meta["max_bytes"] = limit
    return T.StructField(name, dtype, nullable, meta)


def struct_from_ddl(text: str) -> T.StructType:
    """Schema of a column list or of a whole CREATE TABLE statement."""
    body = re.sub(r"--[^\n]*", "", text)
    if re.match(r"\s*CREATE\s", body, re.I):
        start = body.index("(")
        depth = 0
        for end in range(start, len(body)):
            depth += {"(": 1, ")": -1}.get(body[end], 0)
            if depth == 0:
                break
        body = body[start + 1 : end]
    fields = []
    for part in re.split(r",(?![^()]*\))", body):
        if not part.strip():
            continue
        m = _COLUMN.fullmatch(part.strip())
        if m is None:
            raise ValueError(f"cannot read column definition {part.strip()!r}")
        name, kind, params, _, rest = m.groups()
        fields.append(field(name, kind + (params or ""), "NOT NULL" not in rest.upper()))
    return T.StructType(fields)


def declared(f: T.StructField) -> str:
    """Declared type of a field, from its metadata or its Spark type."""
    if "ddl" in (f.metadata or {}):
        return f.metadata["ddl"]
    if isinstance(f.dataType, T.DecimalType):
        return f"DECIMAL({f.dataType.precision}, {f.dataType.scale})"
    for name, dtype in _PLAIN.items():
        if dtype == f.dataType:
            return name
    return f.dataType.simpleString().upper()


def compatible(actual: T.DataType, target: T.DataType) -> bool:
    """May data of one type be loaded into a column of the other as it is?"""
    if type(actual) is type(target):
        return True
    whole = (T.IntegralType,)
    if isinstance(actual, whole) and isinstance(target, whole):
        return True
    if isinstance(actual, T.DoubleType):
        return isinstance(target, (T.FloatType, T.DecimalType))
    if isinstance(actual, T.FloatType):
        return isinstance(target, T.DecimalType)
    return False


def type_mismatches(actual: T.StructType, target: T.StructType) -> list[dict]:
    """Columns whose frame type does not fit the declared type."""
    wanted = {f.name.lower(): f for f in target.fields}
    return [
        {"column": f.name, "actual": f.dataType.simpleString(), "declared": declared(wanted[f.name.lower()])}
        for f in actual.fields
        if f.name.lower() in wanted and not compatible(f.dataType, wanted[f.name.lower()].dataType)
    ]


def may_widen(source: str, target: str) -> bool:
    """Is the step from one declared type to another a permitted widening?"""
    s, t = base_type(source), base_type(target)
    if s == t == "VARCHAR":
        return (text_limit(target) or 0) >= (text_limit(source) or 0)
    if s == t == "DECIMAL":
        a, b = field("x", source).dataType, field("x", target).dataType
        return b.scale >= a.scale and b.precision - b.scale >= a.precision - a.scale
    return t in WIDENING.get(s, ())


def next_int_type(current: str, low: int, high: int) -> str | None:
    """Smallest permitted integer type holding [low, high]; None if it fits already."""
    kind = base_type(current)
    if kind not in INT_BOUNDS:
        return None
    lo, hi = INT_BOUNDS[kind]
    if lo <= low and high <= hi:
        return None
    for wider in WIDENING[kind]:
        if wider == "LARGEINT":
            return wider
        if wider in INT_BOUNDS and INT_BOUNDS[wider][0] <= low and high <= INT_BOUNDS[wider][1]:
            return wider
    return None

"""Scalar expressions over names, ids, cell text and entity text."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column
from pyspark.sql import functions as F

# Separator inside hashed keys; cannot occur in names or code.
_UNIT = "\u0001"

# Cell magics, by the language they switch to, longest first.
MAGICS = (("%%sql", "sql"), ("%sql", "sql"), ("%%python", "python"), ("%python", "python"))


def strip_blank(text: Column) -> Column:
    return F.regexp_replace(text, r"(?U)^\s+|\s+$", "")


def strip_left(text: Column) -> Column:
    return F.regexp_replace(text, r"(?U)^\s+", "")


def strip_magic_prefix(text: Column, magic: str) -> Column:
    """Remove one leading magic, in any letter case, and the blanks around it."""
    return F.regexp_replace(text, rf"(?iU)^\s*{magic}\s*", "")


def detect_cell_type(content: Column) -> Column:
    """struct(cell_type, content): the language named by a leading magic, and the rest."""
    body = strip_left(content)
    kind = F.lit("python")
    rest = content
    for magic, language in reversed(MAGICS):
        hit = body.startswith(magic)
        kind = F.when(hit, F.lit(language)).otherwise(kind)
        rest = F.when(hit, strip_magic_prefix(body, magic)).otherwise(rest)
    return F.struct(kind.alias("cell_type"), rest.alias("content"))


def entity_id(kind: Column, name: Column) -> Column:
    """Prefixed id. One prefix per entity kind."""
    prefix = (
        F.when(kind == "variable", "var:")
        .when(kind == "table", "table:")
        .when(kind == "path", "path:")
        .when(kind == "function", "function:")
    )
    return F.concat(prefix, name)


def normalize_table_name(name: Column) -> Column:
    """``catalog.db.table`` without backticks and blanks; NULL without a table part."""
    parts = F.transform(F.split(F.regexp_replace(name, "`", ""), r"\."), lambda p: F.trim(p))
    table = F.element_at(parts, -1)
    kept = F.filter(parts, lambda p: p != "")
    return F.when((F.size(parts) > 0) & (table != ""), F.array_join(kept, "."))


def ordered_distinct(values: Column) -> Column:
    return F.array_distinct(values)


def edge_id(src: Column, dst: Column, relationship: Column, expression: Column) -> Column:
    """Stable id from the ends, the relationship and the hash of the expression."""
    fields = [F.coalesce(c, F.lit("")) for c in (src, dst, relationship)]
    digest = F.sha2(F.coalesce(expression, F.lit("")), 256)
    return F.sha2(F.concat_ws(_UNIT, *fields, digest), 256)


def node_id(kind: Column, name: Column) -> Column:
    return F.sha2(F.concat_ws(_UNIT, F.coalesce(kind, F.lit("")), F.coalesce(name, F.lit(""))), 256)


def properties_text(properties: Column) -> Column:
    """``key=value`` pairs in key order, so equal maps give equal text."""
    pairs = F.transform(
        F.array_sort(F.map_entries(properties)),
        lambda e: F.concat(e["key"], F.lit("="), F.coalesce(e["value"], F.lit(""))),
    )
    return F.array_join(pairs, ", ")


def embedding_text(
    entity_type: Column,
    entity_name: Column,
    properties: Column,
    description: Column | None = None,
    usage: Column | None = None,
) -> Column:
    """Text of a node for indexing; absent parts leave no line."""

    def line(label: str, value: Column) -> Column:
        return F.concat(F.lit(f"{label}: "), value)

    lines = [line("Entity Type", entity_type), line("Entity Name", entity_name)]
    if description is not None:
        lines.append(line("Description", description))
    lines.append(line("Properties", properties_text(properties)))
    if usage is not None:
        lines.append(line("Usage", usage))
    return F.concat_ws("\n", *lines)


def redact_pii(text: Column) -> Column:
    """Replace mail addresses, IPv4 addresses, card numbers and phone numbers."""
    patterns: Sequence[tuple[str, str]] = (
        (r"[A-Za-z0-9._%+-]+@[A-Za-z0-9.-]+\.[A-Za-z]{2,}", "[EMAIL]"),
        (r"\b(?:[0-9]{1,3}\.){3}[0-9]{1,3}\b", "[IP]"),
        (r"\b[0-9]{4}[ -]?[0-9]{4}[ -]?[0-9]{4}[ -]?[0-9]{4}\b", "[CARD]"),
        (r"\+?[0-9]{1,3}[ .-]?\(?[0-9]{3}\)?[ .-][0-9]{3}[ .-]?[0-9]{4}\b", "[PHONE]"),
    )
    for pattern, label in patterns:
        text = F.regexp_replace(text, pattern, F.lit(label))
    return text


def parse_canonical_name(name: Column) -> Column:
    """struct(kind, catalog, schema, table_name, column_name) of a dotted name."""
    parts = F.split(name, r"\.")
    count = F.size(parts)
    kind = F.when(count == 4, "column").when(count == 3, "table")
    known = kind.isNotNull()

    def part(position: int) -> Column:
        return F.when(known, F.get(parts, F.lit(position)))

    return F.struct(
        kind.alias("kind"),
        part(0).alias("catalog"),
        part(1).alias("schema"),
        part(2).alias("table_name"),
        part(3).alias("column_name"),
    )


def tokens(text: Column) -> Column:
    """Lower-case words of letters, digits and underscores."""
    return F.regexp_extract_all(F.lower(text), F.lit(r"([\p{L}\p{N}_]+)"), F.lit(1))

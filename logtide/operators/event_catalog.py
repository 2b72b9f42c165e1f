"""Event signatures out of contract ABIs."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from logtide.operators.joins import fits_broadcast

# Inputs stay JSON text, so tuples may nest as deep as JSON does.
_ABI = "array<struct<type string, name string, inputs string>>"
ABI_COLUMNS = ("abi", "implementation_abi")
_PARAMETER = "type string, components array<string>"
_STRING = r'"[^"\\]*+(?:\\.[^"\\]*+)*+"'
# An object without objects in it, where braces stand for nothing but objects.
_INNERMOST = r"\{[^{}]*+\}"
# ABI text per task. Up to 200 partitions Spark deals rows straight to files and holds none.
TASK_BYTES, MOST_TASKS = 8 << 20, 200
# ABIs are dealt by group, some groups a task, so that no task gets far more than others.
GROUPS_PER_TASK, GROUP = 8, "abi_group"


def _bound(value: Column, body) -> Column:
    """``body(value)`` with the value computed once."""
    return F.transform(F.array(value), body)[0]


def _joined(members: Column) -> Column:
    """Members with commas; NULL if one of them is."""
    return F.when(~F.exists(members, lambda m: m.isNull()), F.array_join(members, ","))


def _spelled(parameter: Column) -> Column:
    """Type text with tuples spelled out: ``tuple[]`` -> ``(address,uint256)[]``.

    Components are spelled out already. NULL for a missing type, here or in them.
    """
    kind, members = parameter["type"], F.coalesce(parameter["components"], F.array().cast("array<string>"))
    tuple_ = F.concat(F.lit("("), _joined(members), F.lit(")"), F.substring(kind, 6, 1 << 30))
    return F.when(kind.startswith("tuple"), tuple_).otherwise(kind)


def _as_json(text: Column) -> Column:
    """A JSON string, or ``null``."""
    quoted = F.to_json(F.array(text))
    return F.coalesce(F.when(text.isNotNull(), F.substring(quoted, F.lit(2), F.length(quoted) - 2)), F.lit("null"))


def _without_braces(text: Column) -> Column:
    """Text of JSON strings with their braces as escapes."""
    return F.replace(F.replace(text, F.lit("{"), F.lit("\\u007b")), F.lit("}"), F.lit("\\u007d"))


def _replaced(text: Column, pattern: str, body) -> Column:
    """Text with ``body(match)`` in the place of every match."""
    matches = F.concat(F.array(F.lit("")), F.regexp_extract_all(text, F.lit(pattern), F.lit(0)))
    gaps = F.split(text, pattern, -1)
    return F.array_join(
        F.zip_with(matches, gaps, lambda match, gap: F.concat(F.when(match != "", body(match)).otherwise(""), gap)), ""
    )


def _structural(text: Column) -> Column:
    """The same JSON with braces around objects only; braces inside strings are escaped."""
    strings = F.array_join(F.regexp_extract_all(text, F.lit(_STRING), F.lit(0)), "")
    inside = F.contains(strings, F.lit("{")) | F.contains(strings, F.lit("}"))
    return F.when(inside, _replaced(text, _STRING, _without_braces)).otherwise(text)


def _innermost_spelled(text: Column) -> Column:
    """JSON text with every innermost object replaced by its type as a string."""

    def spelled(token: Column) -> Column:
        return _bound(F.from_json(token, _PARAMETER), lambda p: _without_braces(_as_json(_spelled(p))))

    return _replaced(text, _INNERMOST, spelled)


def _types(inputs: Column) -> Column:
    """Types of an event's parameters, from the JSON text of its inputs.

    Tuples are resolved from the inside out, a level a step, in as many steps as there
    are levels; a step looks at what is left once, and at no string in it again.
    """
    flat = F.transform(F.from_json(inputs, "array<struct<type string>>"), lambda p: p["type"])
    levels = F.regexp_count(inputs, F.lit('"components"')) + 1
    resolved = F.aggregate(
        F.sequence(F.lit(1), levels), _structural(inputs),
        lambda text, _: F.when(F.contains(text, F.lit("{")), _innermost_spelled(text)).otherwise(text),
    )
    return F.when(F.contains(inputs, F.lit("tuple")), F.from_json(resolved, "array<string>")).otherwise(flat)


def _tasks(rows: DataFrame, columns: list[str]) -> int:
    """Tasks of about ``TASK_BYTES`` of text each that these columns fill."""
    size = sum((F.coalesce(F.octet_length(c), F.lit(0)) for c in columns), F.lit(0))
    return min(-(-(rows.agg(F.sum(size.cast("long"))).first()[0] or 0) // TASK_BYTES), MOST_TASKS)


def _spread(abis: DataFrame, columns: list[str], tasks: int) -> DataFrame:
    """The ABIs in so many tasks, each with the number of its group.

    Parquet may bring gigabytes of text in one row group, and so in one task. Equal ABIs
    do not go to one task, however many contracts share them.
    """
    if tasks < 2:
        return abis.select(*columns, F.lit(0).alias(GROUP))
    group = F.pmod(F.monotonically_increasing_id(), F.lit(tasks * GROUPS_PER_TASK))
    return abis.select(*columns, group.alias(GROUP)).repartition(tasks, GROUP)


def _present(abis: DataFrame, columns: tuple[str, ...]) -> list[str]:
    return [c for c in columns if c in abis.columns]


def _events(abis: DataFrame, columns: tuple[str, ...], tasks: int | None = None) -> DataFrame:
    present = _present(abis, columns)
    abis = _spread(abis, present, _tasks(abis, present) if tasks is None else tasks)
    parsed = [F.coalesce(F.from_json(F.col(c), _ABI), F.array()) for c in present]
    events = F.filter(F.concat(*parsed), lambda e: e["type"] == "event")

    def with_signature(event: Column) -> Column:
        inputs = F.coalesce(event["inputs"], F.lit("[]"))
        return F.struct(
            event["name"].alias("event_name"),
            F.concat(event["name"], F.lit("("), _bound(_types(inputs), _joined), F.lit(")")).alias("signature"),
            inputs.alias("inputs"),
        )

    # Exploded with the signature, so that filters on it do not compute it again.
    found = abis.select(GROUP, F.explode(F.transform(events, with_signature)).alias("event"))
    return found.select(GROUP, "event.*")


def abi_events(abis: DataFrame, columns: tuple[str, ...] = ABI_COLUMNS) -> DataFrame:
    """One row per event of each contract, its ABI and its implementation's joined.

    Events that have no signature are in ``refused_events``.
    """
    return _events(abis, columns).where(F.col("signature").isNotNull()).drop(GROUP)


def refused_events(abis: DataFrame, columns: tuple[str, ...] = ABI_COLUMNS) -> DataFrame:
    """Events without a signature, and why: one bad ABI does not stop the others."""
    reason = F.when(F.col("event_name").isNull(), "event without a name").otherwise(
        "parameter without a type"
    )
    found = _events(abis, columns).where(F.col("signature").isNull())
    return found.select("event_name", reason.alias("reason"), "inputs")


def event_catalog(abis: DataFrame, topics: DataFrame) -> DataFrame:
    """Distinct events with their topic, looked up by signature text.

    A signature that every contract shares is reduced in the tasks that parse it, before
    it is dealt out. Signatures are dealt to a number of tasks that follows from the size
    of the text: it shrinks many times over in a shuffle, so tasks that adaptive execution
    joins by the size of the shuffle would hold gigabytes. Signatures without a known
    topic keep a NULL.
    """
    tasks = _tasks(abis, _present(abis, ABI_COLUMNS))
    events, known = _events(abis, ABI_COLUMNS, tasks), topics.where(F.col("signature").isNotNull())
    events, small = events.where(F.col("signature").isNotNull()), fits_broadcast(known)
    if not small:
        tasks = max(tasks, _tasks(known, known.columns))
    if tasks > 1:
        # The groups are in one task each, so this does not shuffle.
        reduced = events.groupBy(GROUP, "signature", "event_name").agg(F.min("inputs").alias("inputs"))
        events = reduced.drop(GROUP).repartition(tasks, "signature")
        known = known if small else known.repartition(tasks, "signature")
    events = events.groupBy("signature", "event_name").agg(F.min("inputs").alias("inputs"))
    known = known.groupBy("signature").agg(F.min("topic0").alias("topic0"))
    return events.join(F.broadcast(known) if small else known, "signature", "left").select(
        "topic0", "event_name", "signature", "inputs"
    )

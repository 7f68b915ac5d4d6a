"""P5: casts from text that fail on bad values, whatever the session settings.

As SQL text: one expression of many columns is then made in one call.
"""

from __future__ import annotations

from pyspark.sql import types as T


def strict_cast(value: str, to: T.DataType | str) -> str:
    """SQL of ``value`` (SQL of a text) as ``to``; NULL stays NULL, anything
    else that has no such value raises.

    For BIGINT, JSON's true/false are 1/0 and a float with a whole value is
    that integer (feeds publish flags and counts in these forms).  The plain
    cast comes first; other forms are only looked at where it gives NULL.
    """
    name = to if isinstance(to, str) else to.simpleString()
    if name == "string":
        return f"CAST({value} AS STRING)"
    bad = f"CAST(raise_error(concat('not a value of type {name}: ', {value})) AS {name})"
    other = bad
    if name == "bigint":
        number = f"try_cast({value} AS DOUBLE)"
        other = (f"CASE WHEN lower(trim({value})) = 'true' THEN 1L WHEN lower(trim({value})) = 'false' THEN 0L "
                 f"WHEN {number} = floor({number}) AND abs({number}) < 9007199254740992D THEN CAST({number} AS BIGINT) ELSE {bad} END")
    return f"coalesce(try_cast({value} AS {name}), CASE WHEN {value} IS NOT NULL THEN {other} END)"

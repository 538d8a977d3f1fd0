"""Keys of cached answers, and the parsing of answers that a model gives as JSON."""

from __future__ import annotations

import json

import pyarrow as pa
from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql.types import StringType

from .text import strip_ends, whitespace


@F.arrow_udf(StringType())
def json_string(texts: pa.Array) -> pa.Array:
    """Texts as JSON strings with everything beyond ASCII escaped."""
    return pa.array([None if t is None else json.dumps(t) for t in texts.to_pylist()], pa.string())


def cache_key(text: Column, model: str, prompt: str, ascii_only: bool = False) -> Column:
    """SHA-256 of the request as JSON with sorted keys; texts with equal words share a key.

    Bytes are those of Python's serialiser. With ``ascii_only`` the caller vouches that texts are ASCII, and no Python
    runs.
    """
    text = whitespace(F.coalesce(text, F.lit("")))
    quoted = F.substring(F.to_json(F.array(text)), F.lit(2), F.length(F.to_json(F.array(text))) - 2) if ascii_only else json_string(text)
    head = f'{{"model": {json.dumps(model)}, "prompt": {json.dumps(prompt)}, "text": '
    return F.sha2(F.concat(F.lit(head), quoted, F.lit("}")), 256)


def label(raw: Column) -> Column:
    """A JSON value (as text: strings with their quotes) as "1", "0" or ""."""
    quoted = raw.startswith('"')
    inner = F.trim(F.regexp_replace(raw, '^"|"$', ""))
    low = F.lower(inner)
    digits = inner.rlike("^[0-9]+$")
    string = F.when(inner.isin("0", "1"), inner).when(low == "true", "1").when(low == "false", "0").when(digits, F.when(inner.rlike("[1-9]"), "1").otherwise("0")).otherwise("")
    number = F.try_to_number(inner, F.lit("S999999999D999999999")).cast("double")
    number = F.coalesce(number, inner.try_cast("double"))
    plain = F.when(low == "true", "1").when(low == "false", "0").when(number.isNotNull(), F.when(number >= 0.5, "1").otherwise("0")).otherwise("")
    return F.when(raw.isNull() | (raw == "null"), "").when(quoted, string).otherwise(plain)


def unfenced(c: Column) -> Column:
    """The content of a fenced code block without its ``json`` line; other text as it is."""
    c = strip_ends(c)
    body = F.regexp_replace(c, "^`+|`+$", "")
    first = F.split_part(body, F.lit("\n"), F.lit(1))
    rest = F.when(F.instr(body, "\n") > 0, F.substring(body, F.instr(body, "\n") + 1, F.length(body))).otherwise("")
    return F.when(c.startswith("```"), F.when(F.lower(first).startswith("json"), rest).otherwise(body)).otherwise(c)


def parse_answer(content: Column, default: float = 0.8) -> Column:
    """struct<payload fields, confidence, rationale, error> of a model's answer; 0.9 is the default for reasoning."""
    raw = unfenced(content)
    ok = F.try_parse_json(raw)
    get = lambda f: F.try_variant_get(ok, f"$.{f}", "string")
    # As text, a JSON string and a number look alike: the string is told by its quotes in the source.
    quoted = lambda f: raw.rlike(f'"{f}"\\s*:\\s*"')
    value = lambda f: label(F.when(quoted(f), F.concat(F.lit('"'), get(f), F.lit('"'))).otherwise(get(f)))
    given = get("confidence").try_cast("double")
    sure = F.greatest(F.lit(0.0), F.least(F.lit(1.0), F.coalesce(given, F.lit(default))))
    why = strip_ends(F.coalesce(get("rationale"), F.lit("")))
    return F.struct(
        F.coalesce(get("intent"), F.lit("")).alias("intent"),
        value("is_problem").alias("is_problem"), value("is_software_solvable").alias("is_software_solvable"), value("is_external").alias("is_external"),
        why.alias("problem_reason"), why.alias("software_reason"), why.alias("external_reason"), F.lit("").alias("detected_patterns"),
        sure.alias("confidence"), why.alias("rationale"),
        F.when(ok.isNull(), F.concat(F.lit("Failed to parse JSON: "), raw)).alias("error"),
    )


def defaults(fields: tuple[str, ...], sure: float = 0.0) -> dict[str, Column]:
    """Missing fields as '' and a missing confidence as ``sure``."""
    return {f: F.coalesce(F.col(f), F.lit(sure) if f == "confidence" else F.lit("")) for f in fields}

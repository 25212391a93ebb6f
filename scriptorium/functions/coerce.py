"""Coercions of free-form values."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql import types as T

#: Strings that mean no value.
BLANK = ("", "N/A", "None", "null")
#: Fixed value: ids that stand for none.
PLACEHOLDER = r"(?i)^\s*(?:unknown|unk|invalid|n/?a|none|null|\?+)(?:[\s_.\-]*\w*)?\s*$"


def is_blank(c: Column) -> Column:
    return c.isNull() | c.isin(*BLANK)


def nullif_blank(c: Column) -> Column:
    return F.when(~is_blank(c), c)


def is_placeholder(c: Column) -> Column:
    return c.isNull() | c.rlike(PLACEHOLDER) | (F.trim(c) == "")


def to_int(c: Column, default: int = 0) -> Column:
    """Whole numbers; strings with a fraction give the default."""
    s = F.trim(c.cast("string"))
    return F.coalesce(F.when(s.rlike(r"^[+-]?\d+$"), s.try_cast("int")), F.lit(default))


def to_bool(c: Column) -> Column:
    return F.coalesce(F.lower(F.trim(c.cast("string"))).isin("true", "1", "yes"), F.lit(False))


def to_list(c: Column) -> Column:
    """A scalar as a list of one; null as an empty list."""
    return F.when(c.isNull(), F.array().cast("array<string>")).otherwise(F.array(c.cast("string")))


def with_warning(warnings: Column, message: Column) -> Column:
    w = F.coalesce(warnings, F.array().cast("array<string>"))
    return F.when(F.array_contains(w, message), w).otherwise(F.array_append(w, message))


def without_warnings(warnings: Column, prefix: str) -> Column:
    return F.filter(F.coalesce(warnings, F.array().cast("array<string>")), lambda x: ~x.startswith(prefix))


def clean_urls(urls: Column) -> Column:
    """Flattened one level and trimmed; links, data and marks only."""
    flat = F.transform(F.flatten(urls), lambda x: F.trim(x))
    return F.coalesce(F.filter(flat, lambda x: x.rlike(r"^(?:http|data:image|//)|^\[NEEDS_CROP\]$|cloudinary")), F.array().cast("array<string>"))


def variable_names(raw: Column) -> Column:
    """Names from a JSON list of strings, numbers, or objects with a name, variable, label or symbol, else with options."""
    none = F.array().cast("array<string>")
    texts = F.from_json(F.coalesce(raw, F.lit("")), "array<string>")

    def names(x: Column) -> Column:
        found = F.from_json(x, "name string, variable string, label string, symbol string, options array<string>")
        one = F.coalesce(*[F.nullif(F.trim(found[f]), F.lit("")) for f in ("name", "variable", "label", "symbol")])
        return F.when(~x.startswith("{"), F.array(x)).when(one.isNotNull(), F.array(one)).otherwise(F.coalesce(found["options"], none))

    flat = F.transform(F.flatten(F.transform(F.filter(F.coalesce(texts, none), lambda x: x.isNotNull()), names)), lambda x: F.trim(x))
    return F.filter(flat, lambda x: x.isNotNull() & (x != ""))


def first_of(*columns: Column) -> Column:
    """The first of some aliases that holds a value."""
    return F.coalesce(*[nullif_blank(c) for c in columns])


def fingerprint(c: Column) -> Column:
    return F.substring(F.sha2(c, 256), 1, 16)


#: Escapes that healing leaves as they are: those of JSON, or, where texts hold TeX, only quotes, backslashes and line ends.
ESCAPES = {"json": r"[\"/bfnrt]|u[0-9a-fA-F]{4}", "tex": r"[\"n]"}


def healed_json(raw: Column, keep: str = "json") -> Column:
    r"""Without code fences, and with the backslash doubled wherever none of the kept escapes begins.

    One pass, and no limit on how many: backslashes pair from the left of their run, so only the last of an odd run can begin an escape, and what follows
    it decides: \underline, \u12 and a backslash at the end are doubled, A and \n are not."""
    s = F.regexp_replace(F.coalesce(raw, F.lit("")), r"(?s)^\s*```(?:json)?\s*|\s*```\s*$", "")
    return F.regexp_replace(s, rf"(?<!\\)((?:\\\\)*)\\(?!\\|{ESCAPES[keep]})", r"$1\\\\")


def parsed_json(raw: Column, schema: str, keep: str = "json") -> Column:
    """Parsed as it is, else healed; null if neither can be read.  Where TeX is kept, escapes that JSON has too are healed first."""
    healed = healed_json(raw, keep)
    read = F.when(F.try_parse_json(healed).isNotNull(), F.from_json(healed, schema))
    return read if keep == "tex" else F.when(F.try_parse_json(raw).isNotNull(), F.from_json(raw, schema)).otherwise(read)


#: Fixed value: how much of an answer that can't be read an error shows.
PREVIEW = 500


def read_answer(raw: Column, schema: str, strict: bool, keep: str = "json") -> Column:
    """Struct (value, error).  An answer that can't be read has an error (stage, reason, preview) if strict, else the empty value; a blank or null one
    has the empty value either way: a struct with an empty list in each list and null elsewhere."""
    found, healed = parsed_json(raw, schema, keep), healed_json(raw, keep)
    lists = T.StructType.fromDDL(schema)
    empty = F.from_json(F.lit("{" + ",".join(f'"{f.name}": []' for f in lists if isinstance(f.dataType, T.ArrayType)) + "}"), schema)
    blank = F.trim(F.coalesce(raw, F.lit(""))) == ""
    error = F.struct(F.lit("parse").alias("stage"), F.lit("json_decode_error").alias("reason"), F.substring(healed, 1, PREVIEW).alias("preview"))
    bad = found.isNull() & ~blank
    value = F.when(blank, empty).when(bad, F.lit(None) if strict else empty).otherwise(found)
    return F.struct(value.alias("value"), F.when(bad & F.lit(strict), error).alias("error"))


#: US dollars a million tokens in and out, by model, and rupees a dollar.
RATES = {"flash-lite": (0.10, 0.40), "flash": (0.30, 2.50)}
INR = 84.0  # fixed value


def token_cost(model: Column, prompt: Column, output: Column, thoughts: Column, total: Column) -> Column:
    """Struct (usd, inr): output counts thoughts; without either it is what the total leaves."""
    prompt = F.coalesce(prompt, F.lit(0))
    known = F.coalesce(output, F.lit(0)) + F.coalesce(thoughts, F.lit(0))
    out = F.when(known > 0, known).otherwise(F.greatest(F.coalesce(total, F.lit(0)) - prompt, F.lit(0)))
    lite = F.coalesce(model, F.lit("")).contains("lite")
    usd = (prompt * F.when(lite, RATES["flash-lite"][0]).otherwise(RATES["flash"][0]) + out * F.when(lite, RATES["flash-lite"][1]).otherwise(RATES["flash"][1])) / 1e6
    return F.struct(F.round(usd, 6).alias("usd"), F.round(usd * INR, 4).alias("inr"))

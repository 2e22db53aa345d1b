"""Tool calls in replies, and their checks against declared tools, as expressions over VARIANT: nothing here leaves the JVM, and odd JSON is an error in a row, never of the job."""

from __future__ import annotations

from pyspark.sql import Column, functions as F

from .text import TOOL_CALL, let, strict_json

#: What an argument's declared type asks of its VARIANT type: a pattern of schema_of_variant's answers. The names of JSON Schema's types.
#: Whole numbers beyond 64 bits are decimals of 19 digits or more; a short decimal without places is a number such as 1.0, no integer.
TYPES = {"string": "STRING", "number": "BIGINT|DECIMAL.*|DOUBLE|FLOAT", "integer": r"BIGINT|DECIMAL\((?:19|[23]\d),0\)", "boolean": "BOOLEAN", "array": "ARRAY<.*", "object": "OBJECT<.*", "null": "VOID"}
MAP, LIST = "map<string,variant>", "array<variant>"
CALLS = "array<struct<name:string,arguments:string>>"


def _fields(v: Column) -> Column:
    """The fields of a VARIANT object; null of anything else."""
    return F.when(F.schema_of_variant(v).like("OBJECT<%"), F.variant_get(v, "$", MAP))


def _string(v: Column) -> Column:
    """The text of a VARIANT string; null of anything else."""
    return F.when(F.schema_of_variant(v) == "STRING", F.variant_get(v, "$", "string"))


def _get(fields: Column, key: str | Column) -> Column:
    return F.try_element_at(fields, F.lit(key) if isinstance(key, str) else key)


def _has(fields: Column, key: str) -> Column:
    return F.coalesce(F.map_contains_key(fields, key), F.lit(False))


def parsed(text: Column) -> Column:
    """ARRAY<STRUCT<name, arguments (JSON), error>> of the calls in a text, in order: a block is a call, or has an error."""
    blocks = F.regexp_extract_all(F.coalesce(text, F.lit("")), F.lit(TOOL_CALL), F.lit(1))
    return F.transform(blocks, lambda b: let(strict_json(b), lambda v: let(_fields(v), _call)))


def _call(fields: Column) -> Column:
    whole = _has(fields, "arguments")
    args = let(_get(fields, "arguments"), lambda a: F.when(F.schema_of_variant(a).like("OBJECT<%"), F.to_json(a)))
    name = let(_get(fields, "name"), lambda n: F.coalesce(_string(n), F.to_json(n)))

    def made(x: Column) -> Column:
        error = F.when(fields.isNull(), "bad json").when(~_has(fields, "name"), "no name").when(x["arguments"].isNull(), "arguments not an object")
        return F.struct(x["name"].alias("name"), x["arguments"].alias("arguments"), error.alias("error"))

    return let(F.struct(name.alias("name"), F.when(whole, args).otherwise("{}").alias("arguments")), made)


def declared(spec: Column) -> Column:
    """MAP<name, parameters as JSON> of a JSON list of tools, wrapped or flat; of equal names the last counts; what is no list of objects declares nothing."""
    tools = F.coalesce(F.try_variant_get(strict_json(spec), "$", LIST), F.array().cast(LIST))

    def entry(tool: Column) -> Column:
        inner = let(_fields(tool), lambda m: F.coalesce(let(_get(m, "function"), _fields), m))
        return let(inner, lambda m: F.struct(let(_get(m, "name"), _string).alias("key"), F.coalesce(F.to_json(_get(m, "parameters")), F.lit("{}")).alias("value")))

    named = F.filter(F.transform(tools, entry), lambda e: F.coalesce(e["key"] != "", F.lit(False)))
    # a map that is built up from the entries keeps the last of equal names
    empty = F.map_from_arrays(F.array().cast("array<string>"), F.array().cast("array<string>"))
    return F.aggregate(named, empty, lambda m, e: F.map_concat(F.map_filter(m, lambda k, v: k != e["key"]), F.create_map(e["key"], e["value"])))


def faults(name: Column, arguments: Column, tools: Column) -> Column:
    """What is wrong with a call of a name with arguments (JSON), by declared tools: an unknown name, missing arguments, arguments of another type. Types that are lists or unknown aren't checked."""
    none = F.map_from_arrays(F.array().cast("array<string>"), F.array().cast(LIST))
    wanted_types = F.create_map(*(F.lit(x) for kv in TYPES.items() for x in kv))

    def against(p: Column) -> Column:  # p: given, known, required
        given = p["given"]
        names = F.transform(p["required"], lambda r: _string(r))
        missing = F.transform(F.filter(names, lambda r: r.isNotNull() & ~F.coalesce(F.map_contains_key(given, r), F.lit(False))), lambda r: F.concat(name, F.lit(": missing "), r))

        def off(key: Column) -> Column:
            kind = let(let(_get(p["known"], key), _fields), lambda m: let(_get(m, "type"), _string))
            right = lambda k: F.regexp_like(F.schema_of_variant(F.element_at(given, key)), F.concat(F.lit("^(?:"), _get(wanted_types, k), F.lit(")$")))
            return let(kind, lambda k: F.when(~right(k), F.concat(name, F.lit("."), key, F.lit(": not "), k)))

        return F.concat(missing, F.array_compact(F.transform(F.map_keys(given), off)))

    def checked_against(params: Column) -> Column:
        known = F.coalesce(let(_get(params, "properties"), _fields), none)
        required = F.coalesce(F.try_variant_get(_get(params, "required"), "$", LIST), F.array().cast(LIST))
        given = F.coalesce(let(F.try_parse_json(arguments), _fields), none)
        return let(F.struct(given.alias("given"), known.alias("known"), required.alias("required")), against)

    found = let(let(F.try_parse_json(F.try_element_at(tools, name)), _fields), checked_against)
    return F.when(F.coalesce(F.map_contains_key(tools, name), F.lit(False)), found).otherwise(F.array(F.concat(F.lit("unknown tool "), name)))


def checked(text: Column, spec: Column, required: bool = True) -> Column:
    """STRUCT<ok, calls, errors> of a reply against a JSON list of tools; a null list checks the form alone. required: no call is an error."""
    none = F.array().cast("array<string>")

    def judged(x: Column) -> Column:  # x: calls, errors, tools
        needed = F.when(F.lit(required) & (F.size(x["calls"]) == 0), F.array(F.lit("no call"))).otherwise(none)
        faulty = F.when(spec.isNull(), none).otherwise(F.flatten(F.transform(x["calls"], lambda c: faults(c["name"], c["arguments"], x["tools"]))))
        absent = F.when(text.isNull(), F.array(F.lit("no text"))).otherwise(none)
        return let(F.concat(absent, x["errors"], needed, F.coalesce(faulty, none)), lambda e: F.struct((F.size(e) == 0).alias("ok"), x["calls"].alias("calls"), e.alias("errors")))

    def split(found: Column) -> Column:
        good = F.transform(F.filter(found, lambda x: x["error"].isNull()), lambda x: F.struct(x["name"].alias("name"), x["arguments"].alias("arguments")))
        errors = F.transform(F.filter(found, lambda x: x["error"].isNotNull()), lambda x: x["error"])
        return let(F.struct(good.alias("calls"), errors.alias("errors"), declared(spec).alias("tools")), judged)

    return let(parsed(text), split)


def normalized(structured: Column, text: Column) -> Column:
    """ARRAY<STRUCT<name, arguments>>: a message's structured calls if it has any, else those in its text. Arguments that are no JSON object become {}; they may come as a JSON string that holds JSON."""
    said = F.transform(F.filter(parsed(text), lambda x: x["error"].isNull()), lambda x: F.struct(x["name"].alias("name"), x["arguments"].alias("arguments")))
    some = F.when(F.size(F.coalesce(structured, F.array().cast(CALLS))) > 0, structured).otherwise(said)
    inner = lambda v: F.coalesce(let(_string(v), F.try_parse_json), v)
    clean = lambda a: let(let(F.try_parse_json(a), inner), lambda v: F.when(F.schema_of_variant(v).like("OBJECT<%"), F.to_json(v)))
    return F.transform(some, lambda c: F.struct(c["name"].alias("name"), F.coalesce(clean(c["arguments"]), F.lit("{}")).alias("arguments")))

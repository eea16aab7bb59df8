"""What a record's context is once its envelope's default is taken in, and the window it was seen in."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from sightline.functions.columns import rfc3339_micros


def set_(c: Column) -> Column:
    """A text that is set: null if empty."""
    return F.nullif(c, F.lit(""))


def number(c: Column) -> Column:
    """A number that JSON can hold: null if it is none (NaN, infinite), so that it never stands before a real one."""
    return F.when(~F.isnan(c) & (F.abs(c) != F.lit(float("inf"))), c)


def members(text: Column) -> Column:
    """The members of a JSON object as an array of (k, v), v being JSON text; null of what is no object."""
    entries = F.map_entries(F.from_json(text, "map<string,variant>"))
    return F.transform(entries, lambda e: F.struct(e["key"].alias("k"), F.coalesce(F.to_json(e["value"]), F.lit("null")).alias("v")))


def object_text(pairs: Column) -> Column:
    """The JSON object with these members, in order of name."""

    def member(e: Column) -> Column:
        name = F.to_json(F.struct(e["k"].alias("k")))  # {"k":"name"}
        return F.concat(name.substr(F.lit(6), F.length(name) - 6), F.lit(":"), e["v"])

    return F.concat(F.lit("{"), F.array_join(F.transform(F.array_sort(pairs), member), ","), F.lit("}"))


def merge_json(old: Column, new: Column) -> Column:
    """A shallow merge of two JSON objects, the new one's members winning, in order of name; null if both are null.

    What is no object counts as one without members.
    """
    none = F.array().cast("array<struct<k:string,v:string>>")
    first, second = F.coalesce(members(old), none), F.coalesce(members(new), none)
    names = F.transform(second, lambda e: e["k"])
    kept = F.filter(first, lambda e: ~F.array_contains(names, e["k"]))
    return F.when(old.isNotNull() | new.isNotNull(), object_text(F.concat(kept, second)))


def fields(default: Column, own: Column) -> dict[str, Column]:
    """The fields of the effective context, each by itself, so that only those that are read are worked out."""
    tags = F.when(F.coalesce(F.size(own["tags"]), F.lit(0)) > 0, F.array_union(F.coalesce(default["tags"], F.array().cast("array<string>")), own["tags"])).otherwise(default["tags"])
    both = {
        "first_seen": F.coalesce(set_(own["first_seen"]), default["first_seen"]),
        "last_seen": F.coalesce(set_(own["last_seen"]), default["last_seen"]),
        "confidence": F.coalesce(own["confidence"], default["confidence"]),
        "tags": tags,
        "tlp": F.coalesce(set_(own["tlp"]), default["tlp"]),
        "attributes": F.when(own["attributes"].isNull(), default["attributes"]).when(default["attributes"].isNull(), own["attributes"]).otherwise(merge_json(default["attributes"], own["attributes"])),
    }
    return {name: F.when(default.isNull(), own[name]).when(own.isNull(), default[name]).otherwise(c) for name, c in both.items()}


def effective(default: Column, own: Column) -> Column:
    """If either side is null, the other as it is. Else what the record sets wins; its tags are added to the default's,
    each once, if it has any; attributes are merged member by member."""
    return F.when(default.isNotNull() | own.isNotNull(), F.struct(*[c.alias(name) for name, c in fields(default, own).items()]))


def seen_window(context: Column | dict[str, Column], observed: Column) -> tuple[Column, Column]:
    """(first, last) as timestamps: the context's bounds (of its struct, or its `fields`) where they widen the observation."""
    at = lambda c: F.timestamp_micros(rfc3339_micros(c))
    return F.least(observed, at(context["first_seen"])), F.greatest(observed, at(context["last_seen"]))


def edge_window(first: Column, last: Column, collected: Column) -> tuple[Column, Column]:
    """(first, last) of an edge: the time of collection where a bound is missing; exchanged if reversed."""
    a, b = F.coalesce(first, collected), F.coalesce(last, collected)
    return F.least(a, b), F.greatest(a, b)


def encoded(context: Column) -> Column:
    """A context as JSON without what isn't set; null if nothing is."""
    tags = F.when(F.size(context["tags"]) > 0, context["tags"])
    attributes = F.when(F.size(F.coalesce(members(context["attributes"]), F.array().cast("array<struct<k:string,v:string>>"))) > 0, context["attributes"])
    plain = F.struct(*[set_(context[x]).alias(x) for x in ("first_seen", "last_seen")], context["confidence"].alias("confidence"), tags.alias("tags"), set_(context["tlp"]).alias("tlp"))
    text = F.to_json(plain)
    comma = F.when(text == "{}", "").otherwise(",")
    whole = F.when(attributes.isNull(), text).otherwise(F.concat(text.substr(F.lit(1), F.length(text) - 1), comma, F.lit('"attributes":'), attributes, F.lit("}")))
    return F.when(context.isNotNull() & (whole != "{}"), whole)

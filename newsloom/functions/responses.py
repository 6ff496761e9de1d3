"""From the text of an extraction response to the items in it."""

from pyspark.sql import Column, DataFrame, functions as F

from newsloom.functions.search import once, prefix_sums
from newsloom.functions.steps import computed_once
from newsloom.functions.text import WS, strip_text

# Fixed value: what a fenced JSON array looks like. The match is greedy.
FENCED_ARRAY = f"(?s)```json[{WS}]*(\\[.*\\])[{WS}]*```"

# Follows the response text in the parsed array. The JSON parser stops quietly
# after a complete value; only if it got as far as this marker was the whole
# text one JSON value.
END_MARK = "newsloom:end"

TEXT_FIELDS = ("headline", "href", "id", "url")


def decode_content(content) -> Column:
    """Text of a string or binary column; broken UTF-8 becomes U+FFFD."""
    text = F.col(content) if isinstance(content, str) else content
    return F.make_valid_utf8(text.cast("string"))


def locate_json(text) -> Column:
    """The part of a response to parse: a fenced array if there is one, else
    from the first ``[`` to the last ``]``, else everything."""
    text = F.col(text) if isinstance(text, str) else text
    fenced = F.when(F.contains(text, F.lit("```json")), F.regexp_extract(text, FENCED_ARRAY, 1))
    start = F.instr(text, "[")
    end = F.when(
        F.contains(text, F.lit("]")), F.length(text) - F.length(F.substring_index(text, "]", -1))
    ).otherwise(F.lit(0))
    return (
        F.when(F.coalesce(fenced, F.lit("")) != "", fenced)
        .when((start > 0) & (end >= start), F.substring(text, start, end - start + 1))
        .otherwise(text)
    )


def _plain_numbers(text: Column) -> Column:
    """JSON text in which the numbers NaN and Infinity are 0; those words inside
    strings stay. Null where a control character makes the text no JSON anyway.

    Between two quotes that are not escaped, parts alternate between outside
    and inside of a string.
    """
    # Stand-ins for escapes while the text is cut at its quotes.
    slash, quote = F.lit("\x01"), F.lit("\x02")
    hidden = F.replace(F.replace(text, F.lit("\\\\"), slash), F.lit('\\"'), quote)
    parts = F.transform(F.split(hidden, '"'), lambda part, i: F.when(
        (i % 2 == 0) & part.rlike("NaN|Infinity"), F.regexp_replace(part, "-?(?:NaN|Infinity)", "0")).otherwise(part))
    shown = F.replace(F.replace(F.array_join(parts, '"'), quote, F.lit('\\"')), slash, F.lit("\\\\"))
    named = F.contains(text, F.lit("NaN")) | F.contains(text, F.lit("Infinity"))
    return F.when(~F.contains(text, slash) & ~F.contains(text, quote), F.when(named, shown).otherwise(text))


def _objects_one_by_one(wrapped: Column) -> Column:
    """The objects of the wrapped text, each parsed on its own; null if the text
    is not exactly one JSON value. Takes the numbers NaN and Infinity (as the
    number 0) and texts of any length; null as well if a single element is over
    the limit of a variant."""
    def objects(outer):
        body = F.get(outer, F.lit(0))
        elements = F.when(F.startswith(F.ltrim(body), F.lit("[")), F.from_json(body, "array<string>")).otherwise(F.array(body))
        read = F.transform(elements, lambda e: F.try_parse_json(e))
        return once(read, lambda values: F.when(~F.exists(values, lambda v: v.isNull()), F.filter(values, _is_object)))

    whole = lambda outer: (F.size(outer) == 2) & (F.get(outer, F.lit(1)) == END_MARK)
    # A lambda over an array of one, so that the text is read only once.
    texts = F.array(F.from_json(_plain_numbers(wrapped), "array<string>"))
    return F.get(F.transform(texts, lambda outer: F.when(whole(outer), objects(outer))), F.lit(0))


def _is_object(value: Column) -> Column:
    return F.startswith(F.schema_of_variant(value), F.lit("OBJECT"))


def with_parsed_items(df: DataFrame, json_text: str, to: str) -> DataFrame:
    """Add the JSON objects in `json_text` as an array of variants.

    An array keeps its objects and loses everything else, a single object
    counts as an array of one, any other value as an empty array. Text that is
    not exactly one JSON value gives null. What the variant parser refuses as a
    whole is read again, object by object.
    """
    wrapped = F.concat(F.lit("["), F.col(json_text), F.lit(f',"{END_MARK}"]'))
    df = df.withColumn("__parsed", F.try_parse_json(wrapped).try_cast("array<variant>"))
    whole = (F.size("__parsed") == 2) & (
        F.try_variant_get(F.get("__parsed", F.lit(1)), "$", "string") == END_MARK
    )
    df = df.withColumn("__value", F.when(whole, F.get("__parsed", F.lit(0))))
    elements = F.coalesce(F.col("__value").try_cast("array<variant>"), F.array("__value"))
    return computed_once(df.withColumn(
        to, F.when(F.col("__value").isNotNull(), F.filter(elements, _is_object))
        .when(F.col("__parsed").isNull(), _objects_one_by_one(wrapped))
    ).drop("__parsed", "__value"), to)


def _element(depth: int, plain: str = r'[^"\[\]{},]') -> str:
    """Pattern of an element with brackets up to `depth` deep. It never goes back, so it takes one step a character."""
    nested = f"|[\\[{{]{_element(depth - 1, r'[^"\[\]{}]')}[\\]}}]" if depth else ""
    return f'(?:{plain}++|"[^"]*+"{nested})*+'


# Arrays whose elements are found with patterns alone, and what parts them meanwhile.
_ELEMENT = _element(8)
_FLAT_ARRAY = f"\\A{_ELEMENT}(?:,{_ELEMENT})*+\\z"
_PART = "\x03"


def array_elements(text: Column) -> Column:
    """The texts of the elements of a JSON array, cut without parsing them.

    A comma parts elements where it stands outside of strings, one bracket deep.
    So an element that is no JSON is an element like any other, as long as its
    quotes and brackets are paired. Null where the text does not begin and end
    as an array.

    Patterns find them where all brackets are paired, eight deep at most; other
    texts are read token by token.
    """
    slash, quote = F.lit("\x01"), F.lit("\x02")
    shown = lambda t: F.replace(F.replace(t, quote, F.lit('\\"')), slash, F.lit("\\\\"))
    tokens = lambda body: F.regexp_extract_all(body, F.lit('"[^"]*"|[\\[\\]{},]|[^"\\[\\]{},]+|"'), F.lit(0))

    def parted(tokens: Column) -> Column:
        """Places of the commas between elements."""
        step = lambda t: F.when(t.isin("[", "{"), 1).when(t.isin("]", "}"), -1).otherwise(0)
        return once(prefix_sums(F.transform(tokens, step)), lambda depth: F.filter(
            F.transform(tokens, lambda t, i: F.when((t == ",") & (F.get(depth, i) == 0), i)), lambda i: i.isNotNull()))

    def elements(tokens: Column) -> Column:
        ends = F.concat(F.array(F.lit(-1)), parted(tokens), F.array(F.size(tokens)))
        return once(ends, lambda ends: F.transform(F.sequence(F.lit(1), F.size(ends) - 1), lambda k: shown(F.array_join(
            F.slice(tokens, F.get(ends, k - 1) + 2, F.get(ends, k) - F.get(ends, k - 1) - 1), ""))))

    def cut(body: Column) -> Column:
        parts = F.split(F.regexp_replace(body, f"\\G({_ELEMENT}),", f"$1{_PART}"), _PART)
        return F.when(~F.contains(body, F.lit(_PART)) & body.rlike(_FLAT_ARRAY), F.transform(parts, shown)).otherwise(once(tokens(body), elements))

    def read(text: Column) -> Column:
        hidden = F.replace(F.replace(text, F.lit("\\\\"), slash), F.lit('\\"'), quote)
        is_array = text.rlike(f"(?s)^[{WS}]*\\[.*\\][{WS}]*$") & ~F.contains(text, slash) & ~F.contains(text, quote)
        return F.when(is_array, once(F.regexp_extract(hidden, f"(?s)^[{WS}]*\\[(.*)\\][{WS}]*$", 1), cut))

    return once(text, read)


def torn_items(json_text: Column, max_bytes: int) -> Column:
    """The elements of an array that is no JSON as a whole, each on its own:
    (value, reason), value an object's variant, or null with the reason
    too_large (more than `max_bytes`) or bad_item. Elements that are JSON but no
    objects are left out. Null if the text is no array at all, or has no object."""
    def one(element: Column) -> Column:
        large = F.octet_length(element) > max_bytes
        return F.struct(
            F.when(~large, F.try_parse_json(_plain_numbers(element))).alias("value"), F.when(large, "too_large").otherwise("bad_item").alias("reason"),
            F.startswith(F.ltrim(element, F.lit(" \t\r\n")), F.lit("{")).alias("braced"))

    read = F.filter(F.transform(array_elements(json_text), one), lambda e: e["value"].isNull() | e["braced"] | _is_object(e["value"]))
    read = F.transform(read, lambda e: F.struct(e["value"].alias("value"), F.when(e["value"].isNull(), e["reason"]).alias("reason")))
    return once(read, lambda items: F.when(F.exists(items, lambda e: e["value"].isNotNull()), items))


def _member(item: Column, name: str) -> Column:
    return F.variant_get(item, f"$.{name}", "variant")


def not_text(item: Column, name: str) -> Column:
    """True where the member is present but is no string; null counts as such."""
    return F.coalesce(F.schema_of_variant(_member(item, name)) != "STRING", F.lit(False))


def text_member(item: Column, name: str) -> Column:
    """A member as text: '' when missing, null when it is JSON null."""
    value = _member(item, name)
    return F.when(value.isNull(), F.lit("")).otherwise(F.try_variant_get(value, "$", "string"))


def item_fields(item: Column, position: Column) -> Column:
    """Struct of an item's fields, stripped, with a flag for members that
    should be text and are not (`odd_*`)."""
    return F.struct(
        position.alias("pos"),
        *(strip_text(text_member(item, name)).alias(name) for name in TEXT_FIELDS),
        text_member(item, "source").alias("source"),
        text_member(item, "published_at").alias("published_at"),
        *(not_text(item, name).alias(f"odd_{name}") for name in TEXT_FIELDS),
    )

"""Items from model responses: fences, prose, broken JSON, retries."""

from __future__ import annotations

from collections.abc import Callable, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from fiscalframe.functions.json_text import array_elements, last_values, objects_with_last_values, without_literals
from fiscalframe.functions.names import clean_item_name
from fiscalframe.functions.numbers import read_double
from fiscalframe.functions.text import let, strip
from fiscalframe.operators.repair import money_text, repair, repair_items
from fiscalframe.schema import COLUMNS, NUMBERS, PAYMENTS, TEXT_MONEY

# Code fences, shape of an item object, names that mean "missing".
FENCE = "```"
JSON_FENCE = "```json"
ITEM_OBJECT = r'\{[^{}]*"item_name"[^{}]*\}'
MISSING = ("", "null", "N/A")
NO_RESULT = "AI extraction failed"

# Closes the wrapper array in which a response is parsed, see _strict_items.
_END = "end of response"


def strip_fences(response: Column) -> Column:
    def unfence(r: Column) -> Column:
        without_tag = F.replace(r, F.lit(JSON_FENCE), F.lit(""))
        return (
            F.when(F.startswith(r, F.lit(JSON_FENCE)), strip(F.replace(without_tag, F.lit(FENCE), F.lit(""))))
            .when(F.startswith(r, F.lit(FENCE)), strip(F.replace(r, F.lit(FENCE), F.lit(""))))
            .otherwise(r)
        )

    return let(strip(response), unfence)


def array_text(response: Column) -> Column:
    """The response itself if it starts with ``[``, else from its first ``[`` to its last ``]``.

    NULL if there is no such part.
    """

    def locate(r: Column) -> Column:
        first = F.instr(r, "[")
        last = F.length(r) - F.instr(F.reverse(r), "]") + 1
        inside = F.when((first > 0) & (last > first) & F.contains(r, F.lit("]")), F.substr(r, first, last - first + 1))
        return F.when(F.startswith(r, F.lit("[")), r).otherwise(inside)

    # Most answers are an array and nothing else; those are not looked through.
    bare = F.startswith(response, F.lit("[")) & F.endswith(response, F.lit("]"))
    return F.when(bare, response).otherwise(let(strip_fences(response), locate))


def _parsed(array: Column) -> Column:
    """VARIANT ``[array, end mark]``, or NULL or something else if not valid JSON.

    The parser ignores what follows the first complete value, so the text is
    put into an array whose last element is known: only a text that is one
    complete value leaves exactly that mark in second place.
    """
    return F.try_parse_json(F.concat(F.lit("["), array, F.lit(f',"{_END}"]')))


def _is_whole(parsed: Column) -> Column:
    mark = F.try_variant_get(parsed, "$[1]", "string")
    return F.coalesce((mark == _END) & F.try_variant_get(parsed, "$[2]", "variant").isNull(), F.lit(False))


def _as_text(value: Column) -> Column:
    return F.try_variant_get(value, "$", "string")


def _is_kind(value: Column, kind: str) -> Column:
    return F.schema_of_variant(value) == kind


def _field(item: Column, field: str) -> Column:
    return F.try_variant_get(item, f"$.{field}", "variant")


def _field_text(item: Column, field: str) -> Column:
    return F.try_variant_get(item, f"$.{field}", "string")


# What follows takes a field's text and, for the few texts that could be of
# two kinds, its value.


def _text(text: Column, value: Column) -> Column:
    """A JSON value as the text it has in the output; null gives NULL."""
    is_bool = text.isin("true", "false") & _is_kind(value, "BOOLEAN")
    return F.when(is_bool, F.initcap(text)).otherwise(text)


def _number(text: Column, value: Column) -> Column:
    """Number of a JSON number, numeric string or boolean, else NULL."""
    as_bool = F.when(text.isin("true", "false") & _is_kind(value, "BOOLEAN"), (text == "true").cast("double"))
    return F.coalesce(read_double(text), as_bool)


def _money(text: Column, value: Column) -> Column:
    """Money field as text.

    A JSON zero, ``false`` and empty containers stay as they are; strings
    follow ``money_text``, and so does everything else.
    """
    unquoted = text.rlike(r"^(-?0+(\.0+)?([eE].*)?|true|false|\[\]|\{\})$") & ~_is_kind(value, "STRING")
    as_is = F.when(text == "true", F.lit("1.00")).when(text == "false", F.lit("False")).otherwise(text)
    return F.when(unquoted, as_is).otherwise(money_text(text))


def _field_number(item: Column, field: str) -> Column:
    return let(_field_text(item, field), lambda text: _number(text, _field(item, field)))


def _field_name(item: Column) -> Column:
    return F.when(_is_kind(_field(item, "item_name"), "STRING"), _field_text(item, "item_name"))


def _read_item(raw: bool) -> Callable[[Column], Column]:
    """One JSON object as a struct: name, three numbers, why it is rejected, and the object itself if wanted.

    Its other fields are read after the choice of attempt, see ``item_value``.
    """

    def read(item: Column) -> Column:
        return F.struct(
            _field_name(item).alias("item_name"),
            *[_field_number(item, n).alias(n) for n in NUMBERS],
            *([item.alias("raw")] if raw else []),
            F.array().cast("array<string>").alias("repair"),
            F.lit(False).alias("suspicious_quantity"),
            F.lit(False).alias("high_price"),
        )

    return read


def _gives_item(item: Column) -> Column:
    """``is_complete`` of an object that is not read otherwise."""
    usable = F.coalesce(~_field_name(item).isin(*MISSING), F.lit(False))
    for n in NUMBERS:
        usable = usable & _field_number(item, n).isNotNull()
    return usable


def item_value(item: Column, column: str) -> Column:
    """One of the 30 columns out of an item struct."""
    if column == "item_name" or column in NUMBERS:
        return item[column]
    shown = _money if column in TEXT_MONEY else _text
    return let(_field_text(item["raw"], column), lambda text: shown(text, _field(item["raw"], column)))


def is_complete(item: Column) -> Column:
    """Has a usable name and three readable numbers."""
    present = item["item_name"].isNotNull() & ~item["item_name"].isin(*MISSING)
    for n in NUMBERS:
        present = present & item[n].isNotNull()
    return present


def validate_items(items: Column, raw: bool) -> Column:
    """Drop incomplete items, repair the rest and clean their names."""

    def validated(item: Column) -> Column:
        def merge(fixed: Column) -> Column:
            return F.struct(
                clean_item_name(item["item_name"], quote_runs=True).alias("item_name"),
                *[fixed[n].alias(n) for n in NUMBERS],
                *([item["raw"].alias("raw")] if raw else []),
                F.concat(item["repair"], fixed["repair"]).alias("repair"),
                fixed["suspicious_quantity"].alias("suspicious_quantity"),
                fixed["high_price"].alias("high_price"),
            )

        return let(repair(*[item[n] for n in NUMBERS]), merge)

    return F.transform(F.filter(items, is_complete), validated)


def _lenient_value(text: Column) -> Column:
    """A JSON value; of an object that repeats a key the fields that are read, each with its last value."""

    def read(t: Column) -> Column:
        unique = F.when(F.startswith(t, F.lit("{")), F.try_parse_json(last_values(t, COLUMNS)))
        return F.coalesce(F.try_parse_json(t), unique)

    return let(without_literals(text), read)


def _found(whole: Column, objects: Column) -> Column:
    return F.struct(whole.alias("whole"), objects.alias("objects"))


def _read_leniently(array: Column, columns: Sequence[str] = COLUMNS) -> Column:
    """What an array holds that strict parsing refuses, and whether only for repeated keys or ``NaN``.

    If for more than that, every brace-free object that names an item and
    parses on its own. Objects with repeated keys hold the given columns only.
    """
    # Looked for only where the elements do not do, as most of the work lies in reading them.
    salvaged = F.transform(F.regexp_extract_all(array, F.lit(ITEM_OBJECT), F.lit(0)), _lenient_value)

    def choose(read: Column) -> Column:
        whole = read.isNotNull() & ~F.exists(read, lambda v: v.isNull())
        return F.when(whole, _found(F.lit(True), read)).otherwise(_found(F.lit(False), F.filter(salvaged, lambda v: v.isNotNull())))

    def in_one(objects: Column) -> Column:
        # Most answers are read at once; the others value by value.
        return F.when(objects.isNotNull(), _found(F.lit(True), objects)).otherwise(let(F.transform(array_elements(array), _lenient_value), choose))

    return let(objects_with_last_values(without_literals(array), columns), in_one)


def _objects(response: Column, body: Callable[[Column, Column], Column], columns: Sequence[str] = COLUMNS) -> Column:
    """``body(whole, objects)`` on the array of a response: is it valid JSON, and its objects.

    Repeated keys and ``NaN`` are valid, as most JSON readers have it. A
    response that is not valid as a whole is salvaged object by object. NULL if
    the response holds no array.
    """

    def recover(array: Column) -> Column:
        def split(parsed: Column) -> Column:
            strict = _found(F.lit(True), F.try_variant_get(parsed, "$[0]", "array<variant>"))
            return F.when(_is_whole(parsed), strict).otherwise(_read_leniently(array, columns))

        return let(let(_parsed(array), split), lambda p: body(p["whole"], p["objects"]))

    return let(array_text(response), lambda array: F.when(array.isNotNull(), recover(array)))


def _valid_items(whole: Column, objects: Column, raw: bool) -> Column:
    once = validate_items(F.transform(objects, _read_item(raw)), raw)
    return let(once, lambda o: F.when(whole, o).otherwise(validate_items(o, raw)))


def items_from_response(response: Column, columns: Sequence[str] = COLUMNS) -> Column:
    """ARRAY of validated items of one response; NULL if it holds no array.

    Salvaged items go through validation twice, and it is not idempotent.
    Items carry what ``item_value`` needs for the given columns, no more.
    """
    raw = bool(set(columns) - {"item_name", *NUMBERS})
    read = dict.fromkeys(("item_name", *NUMBERS, *columns))
    return _objects(response, lambda whole, objects: _valid_items(whole, objects, raw), tuple(read))


def _reason(item: Column) -> Column:
    """Why an object is no item: the first field that is missing or cannot be read; NULL for an item."""

    def missing(field: str) -> Column:
        value = F.try_variant_get(item, f"$.{field}", "variant")
        text = _as_text(value)
        absent = value.isNull() | text.isNull() | (_is_kind(value, "STRING") & text.isin(*MISSING))
        readable = _is_kind(value, "STRING") if field == "item_name" else let(text, lambda t: _number(t, value)).isNotNull()
        return F.when(absent, f"{field} missing").when(~readable, f"{field} unreadable")

    is_object = F.try_variant_get(item, "$", "map<string,variant>").isNotNull()
    return F.when(~is_object, "not an object").otherwise(F.coalesce(*[missing(f) for f in ("item_name", *NUMBERS)]))


def attempt_outcomes(responses: DataFrame) -> DataFrame:
    """``(filename, attempt, outcome, n_items)`` of every attempt.

    ``ok`` and ``salvaged`` gave items; ``no_array``, ``broken`` (not valid
    JSON, and nothing could be salvaged) and ``no_valid_item`` did not.
    """
    def judge(whole: Column, objects: Column) -> Column:
        n = F.coalesce(F.size(_valid_items(whole, objects, raw=False)), F.lit(0))
        return F.struct(F.when(whole, "whole").otherwise("broken").alias("kind"), F.greatest(n, F.lit(0)).alias("n"))

    # One reading of the answer for both; NULL if it holds no array.
    read = responses.select("filename", "attempt", _objects(F.col("response"), judge).alias("_read"))
    n_items = F.coalesce(F.col("_read.n"), F.lit(0)).alias("n_items")
    judged = read.select("filename", "attempt", F.col("_read.kind").alias("_kind"), n_items)
    outcome = (
        F.when(F.col("_kind").isNull(), "no_array")
        .when(F.col("n_items") > 0, F.when(F.col("_kind") == "whole", "ok").otherwise("salvaged"))
        .otherwise(F.when(F.col("_kind") == "whole", "no_valid_item").otherwise("broken"))
    )
    return judged.select("filename", "attempt", outcome.alias("outcome"), "n_items")


def rejected_items(responses: DataFrame) -> DataFrame:
    """``(filename, attempt, position, reason)`` of every object that is no valid item."""
    reasons = _objects(F.col("response"), lambda whole, objects: F.transform(objects, _reason))
    each = responses.select("filename", "attempt", F.posexplode(reasons).alias("position", "reason"))
    return each.filter(F.col("reason").isNotNull())


def _attempt_order(good: Column) -> Column:
    """Sorts the attempts that gave items, unnumbered ones last; NULL for the others, which ``min_by`` passes over."""
    return F.when(good, F.struct(F.col("attempt").isNull().alias("unnumbered"), "attempt", F.xxhash64("response").alias("tie")))


def first_good_attempt(responses: DataFrame, max_attempts: int | None = None, columns: Sequence[str] = COLUMNS) -> DataFrame:
    """Per filename the items of the first attempt that yields any, else NULL.

    All attempts count unless ``max_attempts`` says otherwise; one without a
    number comes last. One shuffle on filename, reduced to one row per filename
    and task before it, so that a filename with very many rows stays cheap.
    """
    number = F.col("attempt")
    counted = responses if max_attempts is None else responses.filter(number.isNull() | (number < max_attempts))
    read = counted.select("filename", "attempt", "response", items_from_response(F.col("response"), columns).alias("items"))
    tried = read.select("filename", "items", _attempt_order(F.size("items") > 0).alias("_order"))
    return tried.groupBy("filename").agg(F.min_by("items", "_order").alias("items"))


def _good(whole: Column, objects: Column) -> Column:
    """At least one valid item is among the objects.

    A whole answer is validated once, which keeps every complete item; so
    looking for the first of them is enough.
    """
    salvaged = F.size(_valid_items(F.lit(False), objects, raw=False)) > 0
    return F.coalesce(F.when(whole, F.exists(objects, _gives_item)).otherwise(salvaged), F.lit(False))


def gives_items(response: Column) -> Column:
    """At least one valid item can be recovered."""
    return F.coalesce(_objects(response, _good), F.lit(False))


def _read_objects(responses: DataFrame) -> DataFrame:
    """With ``_whole`` and ``_objects`` of every response, see ``_objects``; a column for each step, so that it is compiled."""
    located = responses.withColumn("_array", array_text(F.col("response")))
    parsed = located.withColumn("_parsed", _parsed(F.col("_array")))
    strict = _found(F.lit(True), F.try_variant_get("_parsed", "$[0]", "array<variant>"))
    read = F.when(_is_whole(F.col("_parsed")), strict).when(F.col("_array").isNotNull(), _read_leniently(F.col("_array")))
    found = parsed.withColumn("_read", read).withColumns({"_whole": F.col("_read.whole"), "_objects": F.col("_read.objects")})
    return found.drop("_array", "_parsed", "_read")


def first_good_answer(responses: DataFrame, max_attempts: int | None = None) -> DataFrame:
    """``(filename, whole, objects)``: what the attempt that ``first_good_attempt`` chooses holds, its items not yet validated.

    The choice needs one complete object of an answer; all else is left to
    ``answer_rows``, for chosen answers only.
    """
    number = F.col("attempt")
    counted = responses if max_attempts is None else responses.filter(number.isNull() | (number < max_attempts))
    read = _read_objects(counted.select("filename", "attempt", "response"))
    answer = F.struct(F.col("_whole").alias("whole"), F.col("_objects").alias("objects")).alias("answer")
    tried = read.select("filename", answer, _attempt_order(_good(F.col("_whole"), F.col("_objects"))).alias("_order"))
    return tried.groupBy("filename").agg(F.min_by("answer", "_order").alias("answer")).select("filename", "answer.*")


def single_answers(answers: DataFrame) -> DataFrame:
    """``(filename, response)`` to what ``answer_rows`` takes."""
    read = _read_objects(answers.select("filename", "response"))
    return read.select("filename", F.col("_whole").alias("whole"), F.col("_objects").alias("objects"))


def best_answers(responses: DataFrame) -> DataFrame:
    """``(filename, response)``: the first attempt that yields items as it came, NULL if none does.

    The same choice as ``first_good_attempt``, but what has to be remembered
    per receipt is one text. On a stream it goes on as answers arrive.
    """
    tried = responses.select("filename", "response", _attempt_order(gives_items(F.col("response"))).alias("_order"))
    return tried.groupBy("filename").agg(F.min_by("response", "_order").alias("response"))


def attempt_states(responses: DataFrame) -> DataFrame:
    """``(filename, last_attempt, answered)``: how far each receipt has got."""
    tried = responses.select("filename", "attempt", gives_items(F.col("response")).alias("good"))
    return tried.groupBy("filename").agg(F.max("attempt").alias("last_attempt"), F.max("good").alias("answered"))


def merge_attempt_states(*states: DataFrame) -> DataFrame:
    """What ``attempt_states`` gives for all their answers together."""
    every = states[0]
    for more in states[1:]:
        every = every.unionByName(more)
    return every.groupBy("filename").agg(F.max("last_attempt").alias("last_attempt"), F.max("answered").alias("answered"))


def explode_responses(receipts: DataFrame, chosen: DataFrame) -> DataFrame:
    """Items per receipt; receipts without any get one fallback row.

    ``source_filename`` is the receipt asked about, ``filename`` what the
    model put into its answer. A filename names one receipt, however often it
    is listed, so both sides hold a key at most once when they meet and no key
    can be hot. The chosen items are already partitioned and sorted by
    filename; a guess at their size must not turn this into a broadcast.
    """
    asked = receipts.select("filename").distinct()
    return answer_rows(asked.join(chosen.hint("merge"), "filename", "left"))


def answer_rows(chosen: DataFrame) -> DataFrame:
    """``(filename, whole, objects)`` to a row per item, or one fallback row where there is none.

    Items of whole answers are repaired, cleaned and formatted on rows of
    their own, in a column for each step, so that all of it is compiled.
    Salvaged ones come validated, as the second validation can drop some.
    """
    whole, objects = F.col("whole"), F.col("objects")
    complete = F.filter(F.transform(objects, _read_item(raw=True)), is_complete)
    items = F.when(whole, complete).otherwise(_valid_items(F.lit(False), objects, raw=True))
    rows = chosen.select(
        F.col("filename").alias("source_filename"), "whole", F.posexplode_outer(items).alias("line_no", "_item")
    )
    failed = F.col("line_no").isNull()
    fallback = {"filename": F.col("source_filename"), **{p: F.lit("0.00") for p in PAYMENTS}}
    given = ("item_name", *NUMBERS)
    others = [c for c in COLUMNS if c not in given]
    texts = {f"_text_{c}": _field_text(F.col("_item.raw"), c) for c in others}
    read = repair_items(rows.withColumns({**{c: F.col("_item")[c] for c in given}, **texts}))

    def output(column: str) -> Column:
        shown = _money if column in TEXT_MONEY else _text
        value = shown(F.col(f"_text_{column}"), _field(F.col("_item.raw"), column))
        return F.when(failed, fallback[column]).otherwise(value) if column in fallback else value

    def validated(column: str, value: Column) -> Column:
        return F.when(whole & ~failed, value).otherwise(F.col("_item")[column]).alias(column)

    new = {c: F.col(c) for c in (*NUMBERS, "repair", "suspicious_quantity", "high_price")}
    new["item_name"] = clean_item_name(F.col("item_name"), quote_runs=True)
    return read.select(
        "source_filename",
        "line_no",
        *[validated(c, new[c]) if c in new else output(c).alias(c) for c in COLUMNS],
        *[validated(c, new[c]) for c in ("repair", "suspicious_quantity", "high_price")],
        F.when(failed, F.lit(NO_RESULT)).alias("error"),
    )

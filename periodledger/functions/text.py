"""Text cleaning as column expressions.

Cleaning is: drop tags, decode entities, NFKC-normalise, trim. Spark has no NFKC or entity
function, but almost every string consists of characters for which both are trivial. Those
stay in the JVM; only strings holding anything else travel to one Arrow UDF, which receives
NULL for all others.
"""

from __future__ import annotations

import html
import json
import re
import sys
import unicodedata
from functools import lru_cache

import pyarrow as pa
from pyspark import cloudpickle
from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql import types as T

# Executors need not have this package installed: the UDFs travel with their code.
cloudpickle.register_pickle_by_value(sys.modules[__name__])

# Python's idea of white space: Unicode White_Space plus the four ASCII separators.
SPACE = r"[\s\x1c-\x1f]"

_WIDE_ASCII = "".join(chr(c) for c in range(0xFF01, 0xFF5F))
_NARROW_ASCII = "".join(chr(c) for c in range(0x21, 0x7F))
_FOLD_FROM = _WIDE_ASCII + "　²³¹"
_FOLD_TO = _NARROW_ASCII + " 231"

# Strings made of these characters only: NFKC is the translation above, entities cannot occur.
_SIMPLE = (
    r"^[\t\n\r\x20-\x25\x27-\x7e¡«»¿À-ÿА-я²³¹—‘-”　-〃〈-】"
    r"一-鿿！-～]*$"
)


# Characters that cleaning leaves alone wherever they stand; a blank among them only where it is not trimmed.
_KEPT = r"!-%'-;=-~一-鿿"
_SETTLED = rf"\A[{_KEPT}](?:[{_KEPT} \n]*[{_KEPT}])?\z"


def needs_full_clean(text: Column) -> Column:
    """True where the JVM-side cleaning is not sufficient."""
    return F.coalesce(~text.rlike(_SIMPLE), F.lit(False))


def beyond_ascii(text: Column) -> Column:
    return F.octet_length(text) != F.char_length(text)


def trim_space(text: Column) -> Column:
    return F.regexp_replace(text, rf"(?U)^{SPACE}+|{SPACE}+$", "")


def drop_space(text: Column) -> Column:
    return F.regexp_replace(text, rf"(?U){SPACE}+", "")


def clean_simple(text: Column) -> Column:
    """Cleaning for strings where :func:`needs_full_clean` is false; NULL becomes ''."""
    bare = F.regexp_replace(F.coalesce(text, F.lit("")), "<[^>]*>", "")
    return trim_space(F.translate(bare, _FOLD_FROM, _FOLD_TO))


def clean_python(text: str | None) -> str:
    """The full cleaning of one string, as used inside the Arrow UDFs."""
    if text is None:
        return ""
    return unicodedata.normalize("NFKC", html.unescape(re.sub(r"<[^>]*>", "", text))).strip()


@F.arrow_udf(T.StringType())
def _clean_strings(batch: pa.Array) -> pa.Array:
    if batch.null_count == len(batch):
        return pa.nulls(len(batch), pa.string())
    return pa.array([None if t is None else clean_python(t) for t in batch.to_pylist()], pa.string())


@F.arrow_udf(T.StringType())
def _unescape(batch: pa.Array) -> pa.Array:
    if batch.null_count == len(batch):
        return pa.nulls(len(batch), pa.string())
    return pa.array([None if t is None else html.unescape(t) for t in batch.to_pylist()], pa.string())


# The entities that are decoded without Python, the ampersand last.
_COMMON_ENTITIES = [("&nbsp;", " "), ("&lt;", "<"), ("&gt;", ">"), ("&quot;", '"'), ("&#39;", "'"), ("&amp;", "&")]
_OTHER_ENTITY = "&(?!(" + "|".join(name[1:-1] for name, _ in _COMMON_ENTITIES) + ");)[#A-Za-z]"


def decode_entities(text: Column) -> Column:
    """Every character reference decoded once, as HTML does: named, decimal and hexadecimal, also without a semicolon where
    that is allowed. Only texts with others than the six common ones go to Python; no-break spaces become either kind of space."""
    common = text
    for name, char in _COMMON_ENTITIES:
        common = F.replace(common, F.lit(name), F.lit(char))
    return F.coalesce(_unescape(F.when(text.rlike(_OTHER_ENTITY), text)), common)


@F.arrow_udf(T.StringType())
def _clean_lists(batch: pa.Array) -> pa.Array:
    """Lists travel as JSON text: a list-typed UDF input costs some 30 microseconds per row in
    the Arrow writer, even for NULLs, a string-typed one less than one."""
    if batch.null_count == len(batch):
        return pa.nulls(len(batch), pa.string())

    def clean(texts):
        return json.dumps([clean_python(t) for t in json.loads(texts)], ensure_ascii=False)

    return pa.array([None if ts is None else clean(ts) for ts in batch.to_pylist()], pa.string())


def clean_text(text: Column) -> Column:
    """Clean one string column; NULL becomes ''."""
    hard = needs_full_clean(text)
    return F.coalesce(_clean_strings(F.when(hard, text)), clean_simple(text))


def clean_values(values: Column) -> Column:
    """Clean every element of an array of strings; NULL elements become ''."""
    hard = needs_full_clean(F.array_join(values, "\n"))
    cleaned = F.from_json(_clean_lists(F.when(hard, F.to_json(values))), "array<string>")
    return F.when(hard, cleaned).otherwise(F.transform(values, clean_simple))


def last_wins(mapping: Column) -> Column:
    """A map parsed from JSON with every key once: the last value of a repeated key.

    The parser keeps repeated keys, and functions that build maps fail on them. Takes a column,
    not an expression: it is used several times over.
    """
    keys, behind, values = F.map_keys(mapping), F.reverse(F.map_keys(mapping)), F.reverse(F.map_values(mapping))
    once = F.array_distinct(keys)
    latest = F.transform(once, lambda k: F.get(values, F.array_position(behind, k).cast("int") - 1))
    return F.when(F.size(once) < F.size(keys), F.map_from_arrays(once, latest)).otherwise(mapping)


def object_keys(text: Column) -> Column:
    """Keys of a JSON object whose values are objects, where that needs a look: a map of strings shows the string ``"{}"``
    and the object ``{}`` alike. NULL where no string starts like an object, so that what looks like one is one; also where
    an object further down repeats a key, which the typed parser refuses."""
    typed = last_typed(F.from_json(text, "map<string,variant>"))
    return F.when(holds_braced_text(text), F.map_keys(F.map_filter(typed, lambda k, v: F.schema_of_variant(v).startswith("OBJECT"))))


def object_places(text: Column) -> Column:
    """For each item of a JSON list whether it is an object; NULL as in :func:`object_keys`."""
    return F.when(holds_braced_text(text), F.transform(F.from_json(text, "array<variant>"), lambda v: F.schema_of_variant(v).startswith("OBJECT")))


def holds_braced_text(text: Column) -> Column:
    """Whether some string in a JSON text starts with a brace: nowhere else does a quote stand before one."""
    return text.rlike(r'"\s*\{')


def last_typed(mapping: Column) -> Column:
    """:func:`last_wins` for a map of variants, which cannot be compared: entries that a later one of the same key follows go."""
    entries = F.map_entries(mapping)
    keys = F.map_keys(mapping)
    kept = F.filter(entries, lambda e, i: ~F.array_contains(F.slice(keys, i + 2, F.size(keys)), e["key"]))
    return F.when(F.size(F.array_distinct(keys)) < F.size(keys), F.map_from_entries(kept)).otherwise(mapping)


def settled(values: Column) -> Column:
    """Whether cleaning would change nothing in an array of strings; NULL counts as no. One look at the joined text, so that most
    rows are spared the steps of :func:`clean_simple` for each value. A NULL, which cleaning fills, joins as a character that is not kept."""
    text = F.array_join(values, "\n", "\r")
    edges = text.contains(" \n") | text.contains("\n ") | text.contains("\n\n")
    return F.coalesce(text.rlike(_SETTLED) & ~edges, F.lit(False))


def clean_map(mapping: Column) -> Column:
    """Clean every value of a string map, keeping its keys, of which none may be repeated
    (:func:`last_wins`)."""
    values = F.map_values(mapping)
    done = settled(values)
    return F.when(done, mapping).otherwise(F.map_from_arrays(F.map_keys(mapping), clean_values(F.when(~done, values))))


@lru_cache(maxsize=1)
def _single_character_folds() -> tuple[str, str]:
    pairs = [(c, c.casefold()) for c in map(chr, range(0x80, 0x10000))
             if unicodedata.normalize("NFKC", c) == c]
    pairs = [(c, f) for c, f in pairs if len(f) == 1 and c == c.lower() and f != c]
    return "".join(c for c, _ in pairs), "".join(f for _, f in pairs)


def fold_case(clean: Column) -> Column:
    """Case folding of cleaned text. ``ß`` folds to ``ss``; the few other folds to several
    characters (Greek with iota subscript, for one) keep their lower-case form."""
    source, target = _single_character_folds()
    lower = F.lower(clean)
    folded = F.translate(F.replace(lower, F.lit("ß"), F.lit("ss")), source, target)
    return F.when(beyond_ascii(clean), folded).otherwise(lower)


def fold_key(clean: Column) -> Column:
    """Comparison key of cleaned text: no white space, case-folded."""
    return fold_case(drop_space(clean))


def fold_python(text: str) -> str:
    return re.sub(r"\s+", "", clean_python(text)).casefold()


def blank_to_null(text: Column) -> Column:
    return F.nullif(text, F.lit(""))


def first_filled(*texts: Column) -> Column:
    """First value that is neither NULL nor empty; '' when there is none."""
    return F.coalesce(*[blank_to_null(t) for t in texts], F.lit(""))

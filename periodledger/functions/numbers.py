"""Reported numbers: status, exact decimal parts and decimal text.

A number is carried as fixed-width columns so that the resolver can hash-aggregate it:

``value``        DOUBLE, for display
``value_digits`` DECIMAL(38,0), significant digits without trailing zeros
``value_exp``    INT, power of ten of ``value_digits``
``value_scale``  INT, power of ten of the last digit as it was written (``2.0`` -> -1)
``value_id``     BIGINT, hash of digits and exponent; equal numbers share it

``1e300`` and ``1e-400`` are therefore exact, although neither fits a DECIMAL(38,18).

The steps below are separate projections on purpose: an intermediate that is used several
times is computed once as a column, where a single nested expression would repeat it.
"""

from __future__ import annotations

import sys
import unicodedata
from decimal import ROUND_HALF_EVEN, Context, Decimal
from functools import lru_cache

import pyarrow as pa
from pyspark import cloudpickle
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from periodledger import vocab
from periodledger.functions.text import beyond_ascii, fold_case

# Executors need not have this package installed: the UDF travels with its code.
cloudpickle.register_pickle_by_value(sys.modules[__name__])

NUMBER_COLUMNS = ["value", "value_decimal", "value_digits", "value_exp", "value_scale", "value_id"]
SUM_PRECISION = 28
DIGITS = 38  # of value_digits; the text of a longer number is kept beside it (wide_digits)


@lru_cache(maxsize=1)
def _foreign_digits() -> tuple[str, str]:
    chars = [c for c in map(chr, range(0x80, sys.maxunicode + 1)) if unicodedata.decimal(c, None) is not None]
    return "".join(chars), "".join(str(unicodedata.decimal(c)) for c in chars)


def ascii_digits(text: Column) -> Column:
    source, target = _foreign_digits()
    return F.when(beyond_ascii(text), F.translate(text, source, target)).otherwise(text)


def fence(df: DataFrame, computed: list[str], kept: list[str]) -> DataFrame:
    """``kept`` and ``computed`` columns, the latter through a one-row generator.

    A later filter on a computed column is otherwise pushed below all the steps that computed
    it, with their expressions copied into it over and over: plans grow exponentially. No
    filter passes a generator's own output.
    """
    kept = [c for c in kept if c not in computed]
    return df.select(*kept, F.inline_outer(F.array(F.struct(*computed))))


def decimal_text(digits: str, exponent: str) -> Column:
    """Shortest conventional text of ``digits * 10**exponent``: plain notation down to
    1E-6 when no zeros have to be appended, scientific notation otherwise.

    Takes column names, not expressions: both are used many times over.
    """
    return F.expr(_decimal_sql(digits, exponent))


def _decimal_sql(digits: str, exponent: str) -> str:
    point = f"({exponent} + length({digits}))"
    return f"""
        case when {exponent} = 0 then {digits}
             when {exponent} < 0 and {point} > 0
               then concat(left({digits}, {point}), '.', substring({digits}, {point} + 1))
             when {exponent} < 0 and {point} > -6 then concat('0.', repeat('0', -{point}), {digits})
             else concat(left({digits}, 1), if(length({digits}) > 1, concat('.', substring({digits}, 2)), ''),
                         'E', if({point} > 0, '+', ''), {point} - 1) end"""


def wide_digits(text: str) -> Column:
    """All significant digits of a decimal text that has more than ``value_digits`` holds; NULL for any other."""
    digits = f"trim(both '0' from replace(substring_index({text}, 'E', 1), '.'))"
    return F.expr(f"case when length({text}) > {DIGITS} and length({digits}) > {DIGITS} then {digits} end")


def wide_text_sql(digits: str, exponent: str, scale: str) -> str:
    """SQL for the decimal text of a number given by all its digits (:func:`wide_digits`) and its ``value_exp`` and
    ``value_scale``, of which the first counts from digit 38."""
    power = f"({exponent} - length({digits}) + {DIGITS})"
    pad = f"greatest({power} - {scale}, 0)"
    parts = f"named_struct('d', concat({digits}, repeat('0', {pad})), 'p', {power} - {pad})"
    return f"transform(array({parts}), x -> {_decimal_sql('x.d', 'x.p')})[0]"


def with_number(df: DataFrame, clean: str, raw: str, present: str) -> DataFrame:
    """Add ``value_status`` and NUMBER_COLUMNS.

    ``clean`` is the cleaned text, ``raw`` the raw value (NULL for a JSON null) and
    ``present`` tells a null from an absent field.
    """
    text, key = F.col(clean), fold_case(F.col(clean))
    step = df.withColumn("_ascii", ascii_digits(text)).withColumn("_kind", (
        F.when(~F.col(present), "not_reported")
        .when(F.col(raw).isNull(), "missing")
        .when(key.isin(vocab.NOT_REPORTED_TOKENS), "not_reported")
        .when(text.isin(vocab.NOT_APPLICABLE_TOKENS), "not_applicable")
        .when(F.col("_ascii").rlike(rf"^{vocab.NUMBER}\z"), "number")
        .otherwise("invalid")
    ))
    step = step.withColumn("_plain", F.expr("if(_kind = 'number', replace(_ascii, ','), null)"))
    # Plain substring functions from here on: the pattern above has established the grammar.
    step = step.withColumn("_mantissa", F.expr("substring_index(lower(_plain), 'e', 1)"))
    step = step.withColumns({
        "_whole": F.expr("trim(leading '+' from substring_index(_mantissa, '.', 1))"),
        "_part": F.expr("if(contains(_mantissa, '.'), substring_index(_mantissa, '.', -1), '')"),
        "_power": F.expr("if(length(_mantissa) = length(_plain), 0,"
                         " try_cast(substring(_plain, length(_mantissa) + 2) as int))"),
    })
    step = step.withColumns({
        "_written": F.expr("coalesce(nullif(trim(leading '0' from concat(_whole, _part)), ''), '0')"),
        "value_scale": F.expr("cast(_power - length(_part) as int)"),
        "value": F.expr("try_cast(_plain as double)"),
    })
    # An exponent too long for INT is beyond every limit; 1e308 is the largest accepted value.
    step = step.withColumn("value_status", F.expr("""
        case when _kind <> 'number' then _kind when _power is null or value > 1e308 then 'invalid'
             when _written = '0' then 'reported_zero' else 'reported_numeric' end"""))
    step = step.withColumn("_ok", F.expr("value_status in ('reported_zero', 'reported_numeric')"))
    step = step.withColumns({
        "_bare": F.expr("if(_ok, coalesce(nullif(trim(trailing '0' from _written), ''), '0'), null)"),
        "_digits": F.expr("if(_ok, _written, null)"),
        "value": F.expr("if(_ok, value, null)"),
        "value_scale": F.expr("if(_ok, value_scale, null)"),
    })
    step = step.withColumns({
        "value_decimal": decimal_text("_digits", "value_scale"),
        "value_digits": F.expr(f"cast(left(_bare, {DIGITS}) as decimal(38,0))"),
        "value_exp": F.expr("cast(if(_bare = '0', 0, value_scale + length(_digits) - length(_bare)"
                            f" + greatest(length(_bare) - {DIGITS}, 0)) as int)"),
    })
    step = step.withColumn("value_id", F.expr("if(_ok, xxhash64(_bare, value_exp), null)"))
    return fence(step, ["value_status", *NUMBER_COLUMNS], df.columns)


def with_rebuilt_text(df: DataFrame, output: str) -> DataFrame:
    """Decimal text of the number in ``value_digits, value_exp, value_scale``, as written with
    that scale. Of a number with more digits than ``value_digits`` holds, zeros stand for the others: see
    :func:`wide_text_sql`."""
    step = df.withColumn("_text", F.expr("cast(value_digits as string)"))
    step = step.withColumn("_pad", F.expr("if(_text = '0', 0, greatest(value_exp - value_scale, 0))"))
    step = step.withColumns({
        "_padded": F.expr("concat(_text, repeat('0', _pad))"),
        "_power": F.expr("if(_text = '0', value_scale, value_exp - _pad)"),
    })
    return step.withColumn(output, decimal_text("_padded", "_power")).drop("_text", "_pad", "_padded", "_power")


@F.arrow_udf(T.StringType())
def _wide_sum(batch: pa.Array) -> pa.Array:
    if batch.null_count == len(batch):
        return pa.nulls(len(batch), pa.string())
    context = Context(prec=SUM_PRECISION, rounding=ROUND_HALF_EVEN, Emax=999999, Emin=-999999)

    def add(texts):
        total = Decimal(0)
        for text in texts.split():
            total = context.add(total, Decimal(text))
        return str(total)

    return pa.array([None if t is None else add(t) for t in batch.to_pylist()], pa.string())


def with_decimal_sum(df: DataFrame, values: str, wanted: Column, output: str) -> DataFrame:
    """Exact sum of ``values``, an ``array<struct<digits,exp,scale,text>>`` of bounded length.

    A sum that fits 28 significant digits is computed as DECIMAL(37,18) in the JVM (adding two
    DECIMAL(38,18) would cost the last digit of the scale). The rare
    rest (NULL for all other rows) goes to decimal arithmetic in one Arrow UDF, which rounds
    to 28 significant digits.
    """
    step = df.withColumns({
        "_terms": F.when(wanted, F.col(values)),
        "_span": F.expr(f"""aggregate({values}, named_struct('whole', 1, 'part', 0, 'raised', false), (a, v) -> named_struct(
            'whole', greatest(a.whole, length(cast(v.digits as string)) + v.exp), 'part', greatest(a.part, -v.scale),
            'raised', a.raised or coalesce(v.scale > 0, false)))"""),
    })
    # n addends add at most as many digits to the longest whole part as n - 1 has.
    step = step.withColumns({"_part": F.col("_span.part"), "_whole": F.expr("_span.whole + length(cast(greatest(size(_terms) - 1, 1) as string))")})
    step = step.withColumn("_fits", F.expr(f"""
        coalesce(_whole + _part <= {SUM_PRECISION} and _part <= 18 and _whole <= 19 and _span.whole <= 17 and not _span.raised, true)"""))
    step = step.withColumn("_exact_sum", F.expr("""
        if(_fits, cast(aggregate(_terms, cast(0 as decimal(37,18)),
                                 (a, v) -> cast(a + cast(v.text as decimal(35,18)) as decimal(37,18))) as string), null)"""))
    # The sum is written with as many decimals as its most precise addend.
    step = step.withColumns({
        "_joined": F.expr("coalesce(nullif(trim(leading '0' from concat(substring_index(_exact_sum, '.', 1),"
                         " left(substring_index(_exact_sum, '.', -1), _part))), ''), if(_exact_sum is null, null, '0'))"),
        "_power": F.expr("-_part"),
    })
    # As one string: see the note on list-typed UDF inputs in functions.text.
    wide = _wide_sum(F.expr("if(_fits, null, array_join(transform(_terms, v -> v.text), ' '))"))
    step = step.withColumn(output, F.coalesce(decimal_text("_joined", "_power"), wide))
    return fence(step, [output], df.columns)

"""Pollutant identity, metric kind and emission scope of a report row."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from periodledger import vocab
from periodledger.functions.text import fold_key, fold_python
from periodledger.functions.units import literal_map

POLLUTANT_COLUMNS = ["pollutant_code", "pollutant_name", "pollutant_identity", "metric_kind",
                     "pollutant_identity_conflict"]


def _names() -> dict[str, str]:
    """Folded alias -> display name; the first code listed wins."""
    names: dict[str, str] = {}
    for display, aliases in vocab.POLLUTANTS.values():
        for alias in aliases:
            names.setdefault(fold_python(alias), display)
    return names


def metric_kind(code: Column, name: Column, known: Column) -> Column:
    """What a row measures; the first rule that applies decides."""
    return (
        F.when((F.upper(code) == vocab.BLACKNESS_CODE) | name.rlike(vocab.BLACKNESS_NAMES), "index")
        .when(name.rlike(vocab.GAS_VOLUME_NAMES), "volume")
        .when(name.rlike(vocab.CONCENTRATION_NAMES), "concentration")
        .when(name.rlike(vocab.RATE_NAMES), "rate")
        .when(known | name.rlike("(?iu)" + vocab.MASS_NAMES), "mass")
        .otherwise("unknown")
    )


def with_pollutant(df: DataFrame, code: str, name: str) -> DataFrame:
    """Add POLLUTANT_COLUMNS from cleaned code and name.

    The dictionaries hold nine codes, so they are literal maps: no join at all.
    ``pollutant_identity`` is '' when a row names no pollutant.
    """
    step = df.withColumns({"_code": F.upper(F.col(code)), "_key": fold_key(F.col(name))})
    step = step.withColumns({
        "_known": F.try_element_at(literal_map({c: d for c, (d, _) in vocab.POLLUTANTS.items()}), F.col("_code")),
        "_aliases": F.try_element_at(F.expr("map(" + ", ".join(
            f"'{c}', array(" + ", ".join(f"'{fold_python(n)}'" for n in names) + ")"
            for c, (_, names) in vocab.POLLUTANTS.items()) + ")"), F.col("_code")),
        "_by_name": F.try_element_at(literal_map(_names()), F.col("_key")),
    })
    step = step.withColumn("pollutant_name", F.coalesce("_known", "_by_name", name))
    identity = (
        F.when(~F.col(code).isin("", "/"), F.concat(F.lit("code:"), F.col("_code")))
        .when(F.col(name) != "", F.concat(F.lit("name:"), fold_key(F.col("pollutant_name"))))
        .otherwise("")
    )
    step = step.withColumns({
        "pollutant_code": F.col(code),
        "pollutant_identity": identity,
        "metric_kind": metric_kind(F.col(code), F.col(name), F.col("_known").isNotNull()),
        "pollutant_identity_conflict": F.coalesce(
            F.col("_known").isNotNull() & (F.col(name) != "") & ~F.array_contains("_aliases", F.col("_key")),
            F.lit(False)),
    })
    return step.drop("_code", "_key", "_known", "_aliases", "_by_name")


def emission_scope(section: Column, port_type: Column, outlet_name: Column, outlet_code: Column) -> Column:
    """Which part of a facility a row speaks for; the first rule that applies decides."""
    grouped = port_type.contains(vocab.GROUP_TOTAL)
    no_outlet = (outlet_code == "") | grouped
    fugitive = (section == "airUnorganizedEmission") | port_type.contains(vocab.FUGITIVE) \
        | (outlet_name == vocab.FUGITIVE_OUTLET)
    return (
        F.when((section == "airTotalEmission") | (port_type == vocab.PLANT_TOTAL), "enterprise_total")
        .when(fugitive, F.when(no_outlet, "fugitive_group_total").otherwise("fugitive_outlet"))
        .when(section == "airMinorEmission", F.when(no_outlet, "minor_group_total").otherwise("minor_outlet"))
        .when(section == "airMainEmission", F.when(grouped, "main_group_total").otherwise("main_outlet"))
        .otherwise(F.concat(F.lit("unknown:"), section))
    )

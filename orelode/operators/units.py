"""Quantities in mixed units brought to canonical units by physical identities.

A value as typed may be read in several ways: a comma may group or divide, a unit may be spelled
ambiguously.  Each way is a candidate.  Columns are tied by identities that are linear in
logarithms (mass = density x volume is ``{"mass": 1, "density": -1, "volume": -1}``), and per row
the combination of candidates with the least sum of absolute log residuals is chosen.  Rows whose
best residual is reached by combinations with different values are flagged as not unique; there
the reading of least rank is kept.
"""

from __future__ import annotations

import pandas as pd
from pyspark.sql import Column, DataFrame, functions as F

from orelode.functions.units import number_readings, number_text, resolved
from orelode.plans.runtime import bounded, cut

CANDIDATE = "array<struct<value:double,rank:int>>"


def least_residual(df: DataFrame, columns: list[str], identities: list[dict[str, int]], tolerance: float = 1e-3, out: str = "chosen") -> DataFrame:
    """Adds ``out``: struct of the value chosen for each column, the ``residual``, and ``unique``.

    ``columns`` hold arrays of struct<value, rank>.  A column without candidates stays null and
    its identities are left out; identities over values that are not all positive are left out
    too.  Only the row itself is read, so nothing is shuffled.
    """
    some = lambda c: F.when(F.size(c) > 0, F.col(c)).otherwise(F.array(F.lit(None).cast("struct<value:double,rank:int>")))
    combos = F.transform(some(columns[0]), lambda x: F.struct(x.alias(columns[0])))

    def extended(combos: Column, before: list[str], c: str) -> Column:
        return F.flatten(F.transform(combos, lambda b: F.transform(some(c), lambda x: F.struct(*(b[p].alias(p) for p in before), x.alias(c)))))

    for i, c in enumerate(columns[1:], 1):
        combos = extended(combos, columns[:i], c)

    def residual(combo: Column) -> Column:
        total = F.lit(0.0)
        for identity in identities:
            logs = [k * F.ln(F.when(combo[c]["value"] > 0, combo[c]["value"])) for c, k in identity.items()]
            total = total + F.coalesce(F.abs(sum(logs[1:], logs[0])), F.lit(0.0))
        return total

    scored = F.transform(
        combos,
        lambda x: F.struct(
            F.floor(residual(x) / tolerance).alias("step"),
            sum((F.coalesce(x[c]["rank"], F.lit(0)) for c in columns[1:]), F.coalesce(x[columns[0]]["rank"], F.lit(0))).alias("rank"),
            residual(x).alias("residual"),
            *(x[c]["value"].alias(c) for c in columns),
        ),
    )
    df = df.withColumn("_scored", scored).withColumn("_best", F.array_min("_scored"))
    rivals = F.filter("_scored", lambda s: (s["step"] == F.col("_best.step")) & F.exists(F.array(*(~s[c].eqNullSafe(F.col(f"_best.{c}")) for c in columns)), lambda x: x))
    picked = F.struct(*(F.col(f"_best.{c}").alias(c) for c in columns), F.col("_best.residual").alias("residual"), (F.size(rivals) == 0).alias("unique"))
    return df.withColumn(out, picked).drop("_scored", "_best")


def unit_reader(unit_ref: DataFrame, most: int = 10_000):
    """An Arrow UDF (quantity, text, column) -> candidate factors, over a unit table of at most
    ``most`` rows."""
    rows = unit_ref.select("quantity", "unit_canonical", "unit_code", "factor", "shift").limit(most + 1).collect()
    if len(rows) > most:
        raise ValueError(f"the unit table has more than {most} rows")
    refs = {(r.quantity, r.unit_code): (r.factor, r.shift or 0.0) for r in rows if r.factor is not None}

    @F.pandas_udf("array<struct<factor:double,shift:double,rank:int>>")
    def read(quantity: pd.Series, text: pd.Series, column: pd.Series) -> pd.Series:
        key = pd.Series(list(zip(quantity.fillna(""), text.fillna(""), column.fillna(""))))
        code, unique = pd.factorize(key)
        found = [[{"factor": f, "shift": s, "rank": r} for f, s, r in resolved(q or None, None, t, c, refs)] for q, t, c in unique]
        return pd.Series([found[i] for i in code])

    return read


def canonical_values(results: DataFrame, measurable: DataFrame, unit_ref: DataFrame, tolerance: float = 0.05) -> DataFrame:
    """``result_id``, ``value`` in the measurable's canonical unit, ``residual``, ``unique`` and
    ``contradicted``.

    Every row's readings go through :func:`least_residual`.  Identities: the value equals
    ``value_canonical`` where that is filled, and equals the mean (of logarithms) of what the other
    results of the same facility, question and day say unambiguously.  Where the unit column and
    the text name different units, the column's is likelier but an identity may overrule it.  A row
    whose best residual exceeds ``tolerance`` is ``contradicted``, also if it has one reading only.
    Rows without a number, without any unit, or with a unit of another quantity give no row, nor do
    questions without a quantity.  Repeated rows are converted each.
    """
    asked = measurable.where(F.col("quantity").isNotNull()).select(F.col("json_id").alias("_json"), F.col("quantity").alias("_quantity"))
    num, rest = number_text(F.col("value_raw"))
    keys = ["facility_key", "json_id", "as_of_date"]
    rows = results.select("result_id", *keys, "value_canonical", num.alias("_num"), rest.alias("_rest"), "raw_unit")
    rows = rows.where(F.col("_num") != "").join(bounded(asked, 10_000), F.col("json_id") == F.col("_json"))
    read = unit_reader(unit_ref)
    rows = rows.select("result_id", *keys, "value_canonical", number_readings(F.col("_num")).alias("_numbers"), read("_quantity", "_rest", "raw_unit").alias("_units"))
    read_as = F.flatten(
        F.transform("_numbers", lambda n: F.transform("_units", lambda u: F.struct((n["value"] * u["factor"] + u["shift"]).alias("value"), (n["rank"] + u["rank"]).alias("rank"))))
    )
    # read twice below, so the texts are parsed once and only numbers are kept
    rows = cut(rows.withColumn("reported", read_as).where(F.size("reported") > 0).drop("_numbers", "_units"))
    value = F.col("reported")[0]["value"]
    log = F.when((F.size("reported") == 1) & (value > 0), F.ln(value))
    peers = rows.groupBy(*keys).agg(F.sum(log).alias("_sum"), F.count(log).alias("_n")).where("_n > 0")
    others = F.col("_n") - F.when(log.isNotNull(), 1).otherwise(0)
    mean = F.when(others > 0, F.exp((F.col("_sum") - F.coalesce(log, F.lit(0.0))) / others))
    one = lambda c: F.when(c.isNotNull(), F.array(F.struct(c.alias("value"), F.lit(0).alias("rank")))).otherwise(F.array().cast(CANDIDATE))
    rows = rows.join(peers, keys, "left").select("result_id", "reported", one(F.col("value_canonical")).alias("filed"), one(mean).alias("peers"))
    solved = least_residual(rows, ["reported", "filed", "peers"], [{"reported": 1, "filed": -1}, {"reported": 1, "peers": -1}])
    return solved.select("result_id", F.col("chosen.reported").alias("value"), "chosen.residual", "chosen.unique", (F.col("chosen.residual") > tolerance).alias("contradicted"))


def milli(values: DataFrame) -> DataFrame:
    """``result_id`` and ``value_milli``, the value times 1000 as the nearest BIGINT."""
    return values.select("result_id", F.round(F.col("value") * 1000).try_cast("bigint").alias("value_milli")).where(F.col("value_milli").isNotNull())

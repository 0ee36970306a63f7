"""Canonical text of mathematical states."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

from ..runtime import join_lookup, materialize
from ..schemas import STATE_EVENTS

# --- fixed values: rewrite rules for products in LaTeX states ----------------------
NUMBER_TIMES_LETTER = (r"(\d+)\\cdot(?=[A-Za-z])", "$1")
LETTER_TIMES_LETTER = (r"(?<=[A-Za-z])\\cdot(?=[A-Za-z])", "")
TIMES = ("\\cdot", "\\cdot ")
# -----------------------------------------------------------------------------------


def without_spaces(state: Column) -> Column:
    return F.replace(state, F.lit(" "), F.lit(""))


def canonical_latex(state: Column) -> Column:
    """One spelling per LaTeX state, as the app logs it: ``$15 \\cdot c+10$`` -> ``15c+10``.

    Outer dollar signs and all spaces go, a product sign is kept only between numbers.
    """
    text = without_spaces(F.btrim(state, F.lit("$")))
    for pattern, replacement in (NUMBER_TIMES_LETTER, LETTER_TIMES_LETTER):
        text = F.regexp_replace(text, pattern, replacement)
    return F.replace(text, F.lit(TIMES[0]), F.lit(TIMES[1]))


def state_dictionary(events: DataFrame, rule=without_spaces, mapping: DataFrame | None = None) -> DataFrame:
    """Each distinct state of the log once, with its canonical text and number of uses.

    ``mapping(raw, canonical)`` may hold translations made elsewhere; states it does not
    know fall back to ``rule``. A ``raw`` given twice is an error.
    """
    if mapping is not None:
        again = mapping.where(F.col("raw").isNotNull()).groupBy("raw").count().where("count > 1").first()
        if again is not None:
            raise ValueError(f"the state mapping has {again['count']} rows for {again.raw!r}")
    states = (
        events.where(F.col("eventType").isin(*STATE_EVENTS))
        .select(F.explode(F.array("oldState", "newState")).alias("raw"))
        .where(F.col("raw").isNotNull())
        .groupBy("raw").agg(F.count(F.lit(1)).alias("uses"))
    )
    if mapping is None:
        return states.withColumn("canonical", rule(F.col("raw")))
    known = mapping.select("raw", F.col("canonical").alias("_known"))
    return states.join(known, "raw", "left").select(
        "raw", "uses", F.coalesce("_known", rule(F.col("raw")), "raw").alias("canonical")
    )


def convert_event_states(events: DataFrame, mapping: DataFrame | None = None) -> DataFrame:
    """Rewrite ``oldState`` and ``newState`` of state events; the logged text is kept.

    The rule alone is a per-row expression. With a ``mapping`` the log is translated by one
    lookup join per column against the distinct states.
    """
    raw = {"oldState": "oldState_latex", "newState": "newState_latex"}
    out = events.withColumns({copy: F.col(c) for c, copy in raw.items()})
    stateful = F.col("eventType").isin(*STATE_EVENTS)
    if mapping is None:
        return out.withColumns({
            c: F.when(stateful, without_spaces(F.col(c))).otherwise(F.col(c)) for c in raw
        })
    texts = materialize(state_dictionary(events, mapping=mapping).drop("uses"))
    for c in raw:
        lookup = texts.select(F.col("raw").alias(c), F.col("canonical").alias("_canonical"))
        out = join_lookup(out, lookup, [c], "left").withColumn(
            c, F.when(stateful, F.coalesce("_canonical", c)).otherwise(F.col(c))
        ).drop("_canonical")
    return out.select(*events.columns, *raw.values())

"""Pairwise name scores: one Arrow UDF for what has no built-in form, the rest native."""

from __future__ import annotations

import difflib

import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from lodestone.functions import names

# The weights of the score.
SEQUENCE, TOKENS = 0.65, 0.35
TERSE_COVERAGE, TERSE_TOKENS = 0.55, 0.45
EXTRA_PER_TOKEN, EXTRA_FLOOR = 0.06, 0.72
CLASS_MISMATCH, SIBLING_MISMATCH, CLASS_ONLY_MISMATCH = 0.45, 0.62, 0.50
LEVEL_MISMATCH = 0.50


@F.pandas_udf(T.DoubleType())
def sequence_ratio(a: pd.Series, b: pd.Series) -> pd.Series:
    """Ratcliff-Obershelp similarity; the order of its arguments matters."""
    return pd.Series([difflib.SequenceMatcher(None, x, y).ratio() for x, y in zip(a, b, strict=True)], dtype="float64")


@F.pandas_udf(T.StructType([T.StructField(n, T.DoubleType()) for n in ("seq", "base", "score", "ranked")]))
def _blend(a: pd.Series, b: pd.Series, tok: pd.Series, cov: pd.Series, shortest: pd.Series, extra: pd.Series, award: pd.Series, level: pd.Series, specificity: pd.Series) -> pd.DataFrame:
    rows = []
    for x, y, t, c, least, more, f_award, f_level, spec in zip(a, b, tok, cov, shortest, extra, award, level, specificity, strict=True):
        if not x or not y:
            rows.append((0.0, 0.0, 0.0, 0.0))
            continue
        seq = difflib.SequenceMatcher(None, x, y).ratio()
        base = SEQUENCE * seq + TOKENS * t
        if least == 1:
            base = max(base, TERSE_COVERAGE * c + TERSE_TOKENS * t)
        elif more:
            base *= max(EXTRA_FLOOR, 1.0 - EXTRA_PER_TOKEN * more)
        whole = base
        for factor in (f_award, f_level):
            if factor != 1.0:
                whole *= factor
        # Both roundings are half-even on the exact binary value, unlike the engine's own.
        score = round(min(whole, 1.0), 4)
        rows.append((seq, base, score, round(score * spec, 4)))
    return pd.DataFrame(rows, columns=["seq", "base", "score", "ranked"])


# As a nondeterministic expression the UDF is neither pushed into a join's condition nor computed twice.
_blend = _blend.asNondeterministic()


def award_factor(tokens_a: Column, classes_a: Column, tokens_b: Column, classes_b: Column) -> Column:
    """How much award disagreement costs."""
    clash = (F.size(classes_a) > 0) & (F.size(classes_b) > 0) & ~F.arrays_overlap(classes_a, classes_b)
    specific = (F.size(tokens_a) > 0) & (F.size(tokens_b) > 0) & ~F.arrays_overlap(tokens_a, tokens_b)
    return F.when(specific & clash, CLASS_MISMATCH).when(specific, SIBLING_MISMATCH).when(clash, CLASS_ONLY_MISMATCH).otherwise(1.0)


def described(df: DataFrame, name: str, prefix: str, institution: str | None = None) -> DataFrame:
    """``df`` with what the score needs of a name, each computed once a row:
    ``{prefix}core, _full`` (tokens without and with awards), ``_awards, _classes, _level``."""
    source = name
    if institution:
        # A column of its own: what follows refers to it several times, so it is computed once.
        source = f"{prefix}clean"
        df = df.withColumn(source, names.strip_institution(F.col(name), F.col(institution)))
        df = df.withColumn(source, F.when(F.col(source) == "", F.col(name)).otherwise(F.col(source)))
    clean = F.col(source)
    out = df.withColumns(
        {
            f"{prefix}core": names.name_tokens(clean, True),
            f"{prefix}full": names.name_tokens(clean),
            f"{prefix}awards": names.award_tokens(clean),
            f"{prefix}classes": names.award_classes(clean),
        }
    )
    # The level is the row's own, so no institution is stripped there.
    out = out.withColumn(f"{prefix}level", names.level_of(F.col(name)) if institution else names.level_of_classes(F.col(f"{prefix}classes")))
    return out.drop(source) if institution else out


def score_components(pairs: DataFrame, level: str | None = None, specificity: str | None = None) -> DataFrame:
    """Pairs described with prefixes ``a_`` and ``b_`` with one column for each factor of their score.

    Adds ``tok, cov, extra, shortest, award, level_factor, seq, base, score,
    ranked``; ``level`` names the candidate's own level column, ``specificity``
    the factor of its url (1.0 where not given).
    """
    both = (F.size("a_core") > 0) & (F.size("b_core") > 0)
    ta, tb = F.when(both, F.col("a_core")).otherwise(F.col("a_full")), F.when(both, F.col("b_core")).otherwise(F.col("b_full"))
    out = pairs.withColumns({"a_used": ta, "b_used": tb})
    known = F.col(level).isNotNull() & F.col("a_level").isNotNull() & (F.col(level) != F.col("a_level")) if level else F.lit(False)
    out = out.withColumns(
        {
            "tok": names.jaccard(F.col("a_used"), F.col("b_used")),
            "cov": names.coverage(F.col("a_used"), F.col("b_used")),
            "extra": F.size(F.array_except("b_used", "a_used")),
            "shortest": F.least(F.size("a_used"), F.size("b_used")),
            "award": award_factor(F.col("a_awards"), F.col("a_classes"), F.col("b_awards"), F.col("b_classes")),
            "level_factor": F.when(known, LEVEL_MISMATCH).otherwise(1.0),
        }
    )
    spec = F.col(specificity) if specificity else F.lit(1.0)
    blend = _blend(F.array_join("a_used", " "), F.array_join("b_used", " "), "tok", "cov", "shortest", "extra", "award", "level_factor", spec)
    return out.withColumn("_s", blend).select("*", "_s.*").drop("_s", "a_used", "b_used")


def score_bound(tok: Column, cov: Column, shortest: Column, chars_a: Column, chars_b: Column, extra: Column, award: Column, level_factor: Column, specificity: Column) -> Column:
    """An upper bound of the ranked score from native columns only; nothing at or above it is lost.

    The sequence ratio is at most 2 * min / (a + b) of the lengths; the two
    roundings can lift a value by 1e-4 at most.
    """
    most = SEQUENCE * (2.0 * F.least(chars_a, chars_b) / (chars_a + chars_b)) + TOKENS * tok
    base = F.when(shortest == 1, F.greatest(most, TERSE_COVERAGE * cov + TERSE_TOKENS * tok)).otherwise(most * F.when(extra > 0, F.greatest(F.lit(EXTRA_FLOOR), 1.0 - EXTRA_PER_TOKEN * extra)).otherwise(1.0))
    return F.least(base * award * level_factor, F.lit(1.0)) * specificity + 1e-4


def score_pairs(df: DataFrame, row_name: str, candidate_name: str, institution: str | None = None, level: str | None = None) -> DataFrame:
    """``df`` with the score of each row's two names."""
    return score_components(described(described(df, row_name, "a_"), candidate_name, "b_", institution), level)

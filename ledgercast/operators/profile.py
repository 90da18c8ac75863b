"""Profile encoding: fit on train rows, apply to any rows.

Fitting yields two long tables, ``(feature, mean)`` and ``(feature, value, code)``. Both are
bounded by the schema: one mean per numeric column and fewer than ``MAX_VALUES`` codes per
category column, so the transform takes them as literals and touches each row once, in place.
"""

from __future__ import annotations

import json
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, Window, functions as F, types as T

from ledgercast.sources.profile import KEYS, SuffixGroups

# Replacements for missing categories, the code of an absent placeholder, and the
# number of values from which a category column is given up.
OTHER_VALUE = "other_value"
OTHER_NUMBER = -9876
NO_CODE = -1.0
MAX_VALUES = 500


def columns_of(df: DataFrame, role: str, groups: SuffixGroups, text: bool | None = None) -> list[str]:
    """Feature columns of one role; for categories optionally only text or only other types."""
    types = {f.name: f.dataType for f in df.schema.fields}
    found = [c for c in groups.features(df.columns) if groups.role(c) == role]
    if text is None:
        return found
    return [c for c in found if isinstance(types[c], T.StringType) == text]


def as_double(column: str) -> Column:
    return F.col(f"`{column}`").try_cast("double")


# -- fit -----------------------------------------------------------------------------------------


def numeric_means(profile: DataFrame, groups: SuffixGroups = SuffixGroups()) -> DataFrame:
    """``(feature, mean)`` of the numeric columns; a column without values has mean 0.

    One aggregation over the wide rows: its partial result is a single row per task.
    """
    names = columns_of(profile, "numeric", groups)
    means = profile.agg(*[F.coalesce(F.avg(as_double(c)), F.lit(0.0)).alias(c) for c in names])
    return means.unpivot([], names, "feature", "mean")


def category_counts(profile: DataFrame, groups: SuffixGroups = SuffixGroups()) -> DataFrame:
    """``(feature, value, n)`` of the text category columns, all in one aggregation."""
    names = columns_of(profile, "categorical", groups, text=True)
    if not names:
        return profile.sparkSession.createDataFrame([], "feature string, value string, n bigint")
    return (
        profile.select(*names)
        .unpivot([], names, "feature", "value")
        .select("feature", F.coalesce("value", F.lit(OTHER_VALUE)).alias("value"))
        .groupBy("feature", "value")
        .agg(F.count(F.lit(1)).alias("n"))
    )


def category_cardinality_gate(counts: DataFrame, max_values: int = MAX_VALUES) -> DataFrame:
    """Values of the features that have fewer than ``max_values`` of them.

    Values are counted per feature by aggregation: an id-like column may have as many values as
    there are clients and must not meet in one task. The sizes are one row per column of the
    profile, so they go to every task instead.
    """
    sizes = counts.groupBy("feature").agg(F.count(F.lit(1)).alias("values"), F.sum("n").alias("total"))
    return counts.join(F.broadcast(sizes.where(F.col("values") < max_values)), "feature").select(
        "feature", "value", "n", "total"
    )


def category_tie_rank(gated: DataFrame) -> DataFrame:
    """Rank among the values of a feature with the same count, and how many they are.

    Runs behind the gate, so a feature brings fewer than ``max_values`` rows to its task.
    """
    tied = Window.partitionBy("feature", "n")
    return gated.withColumns(
        {
            "tie_rank": F.row_number().over(tied.orderBy("value")) - 1,
            "n_tied": F.count(F.lit(1)).over(tied),
        }
    )


def category_frequency(profile: DataFrame, groups: SuffixGroups = SuffixGroups(), max_values: int = MAX_VALUES) -> DataFrame:
    """``(feature, value, code)``: the share of a value, shifted a little to keep ties apart.

    A feature without missing values gets the placeholder with code -1.
    """
    ranked = category_tie_rank(category_cardinality_gate(category_counts(profile, groups), max_values))
    shift = F.col("tie_rank").cast("double") / F.col("n_tied")
    share = (F.when(F.col("n_tied") > 1, shift + F.col("n")).otherwise(F.col("n"))) / F.col("total")
    by_feature = F.max(F.col("value") == OTHER_VALUE).over(Window.partitionBy("feature"))
    coded = ranked.select("feature", "value", share.alias("code"), by_feature.alias("_has_other"))
    first = F.row_number().over(Window.partitionBy("feature").orderBy("value")) == 1
    pair = lambda value, code: F.struct(value.alias("value"), code.alias("code"))
    own = pair(F.col("value"), F.col("code"))
    placeholder = pair(F.lit(OTHER_VALUE), F.lit(NO_CODE))
    rows = F.when(F.col("_first") & ~F.col("_has_other"), F.array(own, placeholder)).otherwise(F.array(own))
    return (
        coded.withColumn("_first", first)
        .select("feature", F.explode(rows).alias("x"))
        .select("feature", "x.value", "x.code")
    )


@dataclass(frozen=True)
class ProfileParams:
    """Fitted values the transform uses literally."""

    means: dict[str, float]
    codes: dict[str, dict[str, float]]

    @classmethod
    def load(cls, means: DataFrame, encoding: DataFrame, columns: int, max_values: int = MAX_VALUES) -> ProfileParams:
        """Read the two fitted tables; ``columns`` bounds how many rows they can have."""
        bound = columns * (max_values + 1)
        rows = encoding.select("feature", "value", "code").orderBy("feature", F.desc("code"), "value").limit(bound + 1).collect()
        if len(rows) > bound:
            raise ValueError(f"encoding has more than {bound} rows")
        codes: dict[str, dict[str, float]] = {}
        for feature, value, code in rows:
            codes.setdefault(feature, {})[value] = code
        return cls({r["feature"]: r["mean"] for r in means.collect()}, codes)


def profile_fit(profile: DataFrame, groups: SuffixGroups = SuffixGroups(), max_values: int = MAX_VALUES) -> tuple[DataFrame, DataFrame]:
    """The two parameter tables of the given (train) rows."""
    return numeric_means(profile, groups), category_frequency(profile, groups, max_values)


def fit_params(profile: DataFrame, groups: SuffixGroups = SuffixGroups(), max_values: int = MAX_VALUES) -> ProfileParams:
    means, encoding = profile_fit(profile, groups, max_values)
    return ProfileParams.load(means, encoding, len(profile.columns), max_values)


# -- transform -----------------------------------------------------------------------------------


def date_recency(column: str) -> Column:
    """Days from the date to the report month; 0 without a date."""
    return F.coalesce(F.datediff(F.col("report_dt"), F.col(f"`{column}`")), F.lit(0))


def dual_imputation(column: str, mean: float) -> list[Column]:
    """A numeric column twice: missing as 0, and missing as the train mean."""
    value = as_double(column)
    return [
        F.coalesce(value, F.lit(0.0)).alias(column),
        F.coalesce(value, F.lit(float(mean))).alias(f"{column}_mean_na"),
    ]


def category_fill(df: DataFrame, column: str) -> Column:
    """Missing values as a placeholder: a text for texts and dates, a number for numbers and flags."""
    kind = df.schema[column].dataType
    if isinstance(kind, (T.StringType, T.DateType, T.TimestampType)):
        return F.coalesce(F.col(f"`{column}`").cast("string"), F.lit(OTHER_VALUE)).alias(column)
    if isinstance(kind, T.BooleanType):
        return F.coalesce(F.col(f"`{column}`").cast("int"), F.lit(OTHER_NUMBER)).alias(column)
    return F.coalesce(F.col(f"`{column}`"), F.lit(OTHER_NUMBER)).alias(column)


def category_encode(column: str, codes: dict[str, float]) -> Column:
    """Code of the value; an unseen value gets the code of the placeholder.

    The codes form one constant map with the most frequent values in front, where a lookup finds
    them first.
    """
    ordered = dict(sorted(codes.items(), key=lambda pair: -pair[1]))
    table = F.from_json(F.lit(json.dumps(ordered)), "map<string,double>")
    value = F.coalesce(F.col(f"`{column}`"), F.lit(OTHER_VALUE))
    return F.coalesce(F.try_element_at(table, value), F.lit(float(codes[OTHER_VALUE]))).alias(column)


def profile_transform(profile: DataFrame, params: ProfileParams, groups: SuffixGroups = SuffixGroups()) -> DataFrame:
    """Encoded profile, map-side. Text columns the fit gave up are dropped."""
    out: list[Column] = []
    for column in columns_of(profile, "numeric", groups):
        out += dual_imputation(column, params.means.get(column, 0.0))
    out += [date_recency(c).alias(c) for c in columns_of(profile, "date", groups)]
    out += [category_encode(c, params.codes[c]) for c in columns_of(profile, "categorical", groups, True) if c in params.codes]
    out += [category_fill(profile, c) for c in columns_of(profile, "categorical", groups, False)]
    return profile.select(*KEYS, *out)


def profile_feature_groups(columns: list[str], groups: SuffixGroups = SuffixGroups()) -> dict[str, list[str]]:
    """Features of an encoded profile by role, in model order."""
    filled = [c for c in columns if c.endswith("_mean_na")]
    numeric = filled + [c for c in columns if groups.role(c) == "numeric"]
    return {
        "numeric": numeric,
        "date": [c for c in columns if c not in KEYS and groups.role(c) == "date"],
        "categorical": [c for c in columns if c not in KEYS and groups.role(c) == "categorical"],
    }

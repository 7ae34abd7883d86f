"""Turn raw flow rows into numeric features, labels and strata."""

from __future__ import annotations

from collections.abc import Iterable, Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions import bucket, clean_name, try_number

# The category of normal rows and the attack categories studied.
NORMAL_CATEGORY = "Normal"
TARGET_CATEGORIES = ("Backdoors", "Reconnaissance", "Generic")
UNKNOWN_CATEGORY = "Unknown"


def encode_cell(col: Column) -> Column:
    """Number if the text parses as one, else its bucket."""
    return F.coalesce(try_number(col), bucket(col).cast("double"))


def encode_features(df: DataFrame, features: Iterable[str]) -> DataFrame:
    """Encode text feature columns in place; numeric ones are only cast."""
    types = dict(df.dtypes)
    return df.withColumns(
        {
            name: encode_cell(F.col(name)) if types[name] == "string" else F.col(name).cast("double")
            for name in features
        }
    )


def normalize_headers(df: DataFrame) -> DataFrame:
    return df.toDF(*[clean_name(c) for c in df.columns])


def align_schema(df: DataFrame, target: Mapping[str, str]) -> DataFrame:
    """Project to ``target`` (name to type): extra columns go, missing ones come.

    A missing column is ``''`` when the target type is text and NULL otherwise.
    """
    have = {clean_name(c): c for c in df.columns}

    def project(name: str, kind: str) -> Column:
        if name in have:
            return F.col(f"`{have[name]}`").cast(kind).alias(name)
        filler = F.lit("") if kind == "string" else F.lit(None)
        return filler.cast(kind).alias(name)

    return df.select(*[project(name, kind) for name, kind in target.items()])


def split_features_label(
    df: DataFrame,
    features: Sequence[str],
    label: str = "label",
    category: str = "category",
    include_category: bool = False,
    keep: Sequence[str] = (),
) -> DataFrame:
    """Feature vector, label and category.

    The training layout also counts the encoded category as a feature; the
    evaluation layout, the default, does not.
    """
    cells = [F.col(f).cast("double") for f in features]
    if include_category:
        cells.append(encode_cell(F.col(category)))
    return df.select(*keep, F.array(*cells).alias("features"), label, category)


def filter_normal(df: DataFrame, normal: Column) -> DataFrame:
    """Rows to fit on.  State ``normal`` on a source column so that it is pushed down."""
    return df.where(normal)


def stratum(category: Column, normal: str, targets: Iterable[str]) -> Column:
    """``normal``, ``target`` or ``other``; only the normal category itself is normal, a missing one is not."""
    return (
        F.when(category == normal, "normal")
        .when(category.isin(*targets), "target")
        .otherwise("other")
    )


def relabel_targets(df: DataFrame, label: str, category: str, targets: Iterable[str]) -> DataFrame:
    relabelled = F.when(F.col(category).isin(*targets), F.lit(1)).otherwise(F.col(label))
    return df.withColumn(label, relabelled.cast("int"))


def select_target_categories(
    df: DataFrame,
    label: str = "label",
    category: str = "category",
    normal: str = NORMAL_CATEGORY,
    targets: Sequence[str] = TARGET_CATEGORIES,
) -> DataFrame:
    """Keep normal and target rows; targets get label 1, other and missing categories go."""
    kept = df.where(F.col(category).isin(normal, *targets))
    return relabel_targets(kept, label, category, targets).withColumn(
        "stratum", stratum(F.col(category), normal, targets)
    )


def excluded_categories(
    df: DataFrame,
    category: str = "category",
    normal: str = NORMAL_CATEGORY,
    targets: Sequence[str] = TARGET_CATEGORIES,
) -> DataFrame:
    """Row counts of the categories that ``select_target_categories`` drops, a missing one as Unknown."""
    name = F.coalesce(category, F.lit(UNKNOWN_CATEGORY))
    return (
        df.where(~F.coalesce(F.col(category).isin(normal, *targets), F.lit(False)))
        .groupBy(name.alias(category))
        .agg(F.count("*").alias("n"))
        .orderBy(category)
    )


def row_fingerprint(*cols: Column) -> Column:
    """Short row id; NULL cells count as empty text."""
    return F.concat_ws("_", *[F.coalesce(c.cast("string"), F.lit("")) for c in cols])

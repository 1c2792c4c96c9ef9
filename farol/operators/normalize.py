"""Column names, label text, target, feature contract and samples."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from farol import vocabulary as words
from farol.functions.columns import all_of, col
from farol.functions.keys import digest


def trim_names(df: DataFrame) -> DataFrame:
    """Column names without surrounding blanks."""
    return df.toDF(*[c.strip() for c in df.columns])


def drop_unnamed(df: DataFrame) -> DataFrame:
    """Without the empty columns some CSV writers leave behind (`Unnamed: 32`)."""
    return df.select(*[col(c) for c in df.columns if not c.lower().startswith("unnamed")])


def rename_parts(df: DataFrame, parts: Mapping[str, str] | None = None) -> DataFrame:
    """Replace a piece of column names, by default `concave points` by `concave_points`."""
    parts = parts or {"concave points": "concave_points"}
    renamed = []
    for name in df.columns:
        for old, new in parts.items():
            name = name.replace(old, new)
        renamed.append(name)
    return df.toDF(*renamed)


def clean_label(df: DataFrame, label: str = words.LABEL_COLUMN) -> DataFrame:
    """Label as trimmed upper-case text; unchanged if the column is absent."""
    return df.withColumn(label, F.upper(F.trim(col(label).cast("string")))) if label in df.columns else df


def normalize(df: DataFrame, label: str = words.LABEL_COLUMN) -> DataFrame:
    """N1 to N4 in order."""
    return clean_label(rename_parts(drop_unnamed(trim_names(df))), label)


def feature_names(df: DataFrame, drop: Sequence[str] = (words.ID_COLUMN, words.LABEL_COLUMN)) -> list[str]:
    return [c for c in df.columns if c not in drop]


def features_only(df: DataFrame, drop: Sequence[str] = (words.ID_COLUMN, words.LABEL_COLUMN)) -> DataFrame:
    """The features, without identifier and label."""
    return df.select(*[col(c) for c in feature_names(df, drop)])


def mapped_label(label: Column, mapping: Mapping[str, int], strict: bool = True) -> Column:
    """The number of a label; with `strict` an unknown or missing label fails the job and is named."""
    pairs = [F.lit(x) for kv in mapping.items() for x in kv]
    number = F.try_element_at(F.create_map(*pairs), label)
    if not strict:
        return number
    message = F.concat(F.lit("unknown label: "), F.coalesce(label, F.lit("NULL")))
    return F.when(number.isNotNull(), number).otherwise(F.raise_error(message).cast("int"))


def unknown_labels(df: DataFrame, label: str = words.LABEL_COLUMN, mapping: Mapping[str, int] = words.LABEL_MAP) -> DataFrame:
    """The distinct labels outside the map."""
    return df.select(col(label)).where(mapped_label(col(label), mapping, strict=False).isNull()).distinct()


def check_labels(df: DataFrame, label: str = words.LABEL_COLUMN, mapping: Mapping[str, int] = words.LABEL_MAP) -> DataFrame:
    """N6, eager: raise with the distinct offenders before any work is done."""
    shown = 20
    bad = [r[0] for r in unknown_labels(df, label, mapping).limit(shown + 1).collect()]
    if bad:
        more = " and more" if len(bad) > shown else ""
        raise ValueError(f"unknown labels in '{label}': {bad[:shown]}{more}")
    return df


def with_target(df: DataFrame, label: str = words.LABEL_COLUMN, mapping: Mapping[str, int] = words.LABEL_MAP,
                name: str = words.TARGET_NAME) -> DataFrame:
    """Add the target as a small integer; the job fails on an unknown label."""
    return df.withColumn(name, mapped_label(col(label), mapping).cast(T.ByteType()))


def recode_inverted(df: DataFrame, source: str, label: str = words.LABEL_COLUMN) -> DataFrame:
    """A numeric label where 0 is the positive class, as label text."""
    return df.withColumn(label, F.when(col(source) == 0, F.lit("M")).otherwise(F.lit("B")))


def enforce_contract(df: DataFrame, feature_order: Sequence[str], keep: Sequence[str] = ()) -> DataFrame:
    """The model's features in the stored order, plus `keep`; missing ones are an error."""
    missing = [c for c in feature_order if c not in df.columns]
    if missing:
        raise ValueError(f"{len(missing)} column(s) missing from the input: {missing[:6]}")
    return df.select(*[col(c) for c in keep if c not in feature_order], *[col(c) for c in feature_order])


def feature_label(name: Column) -> Column:
    """`concave_points_worst` reads `concave points (pior)`."""
    out = F.replace(name, F.lit("_"), F.lit(" "))
    for suffix, tag in words.SUFFIX_LABELS.items():
        stem = F.regexp_extract(name, f"^(.*){suffix}$", 1)
        out = F.when(name.endswith(suffix), F.concat(F.replace(stem, F.lit("_"), F.lit(" ")), F.lit(f" ({tag})"))).otherwise(out)
    return out


def sample_rows(df: DataFrame, n: int, id_col: str = words.ID_COLUMN, seed: int = words.SEED) -> DataFrame:
    """N rows in hash order, all rows if there are fewer. Top-n, no full sort."""
    return df.orderBy(digest(str(seed), col(id_col)), col(id_col)).limit(n)


def split_truth(df: DataFrame, label: str = words.LABEL_COLUMN, mapping: Mapping[str, int] = words.LABEL_MAP) -> tuple[DataFrame, bool]:
    """With a label, add the target and drop the label; otherwise the table as it is. Says which."""
    if label in df.columns:
        return with_target(df, label, mapping).drop(label), True
    return df, False


def where_equal(df: DataFrame, **values) -> DataFrame:
    """Rows of one class, one split, or both."""
    return df.where(all_of([col(c) == F.lit(v) for c, v in values.items()]))

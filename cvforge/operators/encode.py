"""Role-based encoding (E-1 .. E-13).

The whole encoding is one ``select`` built from the ``FeatureSpec``: a CASE
expression per binary/ordinal column, ``try_cast`` for numeric passthrough and an
equality test per declared category for one-hot columns. Unknown categories are
found by one validation aggregate before the encoded table is used.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from cvforge.functions.columns import col, is_numeric_type, nan_to_null, strip_text
from cvforge.spec import FeatureSpec

ROLE_ENCODING = {
    "binary": "manual binary mapping",
    "ordinal": "manual ordinal mapping",
    "nominal": "one-hot encoding",
    "numeric": "numeric passthrough",
}
ENCODED_ROLE = {
    "numeric": ("numeric", "numeric passthrough"),
    "binary": ("binary_encoded", "manual binary mapping"),
    "ordinal": ("ordinal_encoded", "manual ordinal mapping"),
    "nominal": ("one_hot_encoded", "manual one-hot encoding"),
}
ROLE_MAP_SCHEMA = "source_feature string, encoded_feature string, source_role string, encoded_role string, encoding string"


@dataclass
class TargetEncoding:
    target: str
    classes: list[str]
    positive_class: str | None
    positive_label: int | None

    @property
    def mapping(self) -> dict[str, int]:
        return {label: i for i, label in enumerate(self.classes)}

    def code(self, c: Column) -> Column:
        """Encoded class code (0..n-1) of the target column."""
        mapping = F.create_map(*[x for label, i in self.mapping.items() for x in (F.lit(label), F.lit(i))])
        return F.element_at(mapping, c.cast("string")).cast("int")

    def label(self, code: Column) -> Column:
        """Inverse transform (E-13): class text of an encoded code."""
        return F.element_at(F.array(*[F.lit(c) for c in self.classes]), code + 1)


@dataclass
class EncodedTable:
    df: DataFrame  # key columns, encoded features (source order, one-hot in place), target code last
    features: list[str]
    role_rows: list[tuple[str, str, str, str, str]]
    target: TargetEncoding
    key_cols: tuple[str, ...]
    coerced: tuple[str, ...] = ()  # numeric features parsed from text: may hold missing values
    columns: tuple[Column, ...] = ()  # how ``df`` is selected, for other rows of the same columns

    def roles(self, spark: SparkSession) -> DataFrame:
        return spark.createDataFrame(self.role_rows, ROLE_MAP_SCHEMA)

    def encoded_role(self, name: str) -> str:
        """E-10: role of an encoded column, read from the role map."""
        for _, enc, _, role, _ in self.role_rows:
            if enc == name:
                return role
        return "encoded"


def normalize_category(c: Column) -> Column:
    """E-3: text form without surrounding whitespace; missing stays missing."""
    return strip_text(c)


def split_features_target(df: DataFrame, target: str, exclude: tuple[str, ...] | list[str] = ()) -> list[str]:
    """E-1: feature columns (input order, excluded dropped). Raises on a missing
    excluded column, a missing target or a null target value."""
    missing = [c for c in exclude if c not in df.columns]
    if missing:
        raise ValueError(f"exclude names columns that the table lacks: {missing}")
    if target not in df.columns:
        raise ValueError(f"the table has no column '{target}' to predict")
    nulls = df.select(F.count_if(col(target).isNull()).alias("n")).first()["n"]
    if nulls:
        raise ValueError(f"{nulls} rows have no value in '{target}'")
    return [c for c in df.columns if c != target and c not in set(exclude)]


def encode_target(df: DataFrame, target: str, positive_class: str | None) -> TargetEncoding:
    """E-2: classes sorted as text get codes 0..n-1; positive label found, else 1 for two classes."""
    rows = df.select(col(target).cast("string").alias("label")).distinct().collect()
    classes = sorted(r["label"] for r in rows)
    if positive_class is not None and positive_class in classes:
        return TargetEncoding(target, classes, positive_class, classes.index(positive_class))
    return TargetEncoding(target, classes, None, 1 if len(classes) == 2 else None)


def label_mapping_table(df: DataFrame, target: str) -> DataFrame:
    """E-12: (class_label, encoded_value) from the classes the table holds."""
    classes = df.select(col(target).cast("string").alias("class_label")).distinct()
    return classes.withColumn("encoded_value", F.row_number().over(Window.orderBy("class_label")) - 1)


def encoded_role_table(df: DataFrame, spec: FeatureSpec, features: list[str]) -> DataFrame:
    """E-10: source and encoded feature with their roles; the one-hot columns are those of the
    categories declared, or of the categories the table holds."""
    types = {f.name: f.dataType for f in df.schema.fields}
    cells = []
    for c in features:
        role = spec.role_of(c, is_numeric_type(types[c]))
        declared = spec.nominal.get(c)
        if role == "nominal" and declared is None:
            found = F.array(normalize_category(col(c)))
        else:
            found = F.array(*[F.lit(v).cast("string") for v in (declared if role == "nominal" else (None,))])
        cells.append((c, role, found))
    rows = df.select(
        F.explode(F.array(*[F.struct(F.lit(c).alias("source_feature"), F.lit(role).alias("source_role"), found.alias("found")) for c, role, found in cells])).alias("cell")
    ).select("cell.source_feature", "cell.source_role", F.explode("cell.found").alias("category"))
    rows = rows.distinct().where(F.col("category").isNotNull() | (F.col("source_role") != "nominal"))
    lookup = lambda k: F.element_at(F.create_map(*[F.lit(x) for r, v in ENCODED_ROLE.items() for x in (r, v[k])]), F.col("source_role"))
    return rows.select(
        "source_feature",
        F.concat_ws("_", "source_feature", "category").alias("encoded_feature"),
        "source_role",
        lookup(0).alias("encoded_role"),
        lookup(1).alias("encoding"),
    )


def mapped_code(c: Column, mapping: dict[str, int]) -> Column:
    """E-6: CASE over normalized text; NULL when the text is not in the mapping."""
    norm = normalize_category(c)
    expr = None
    for key, value in mapping.items():
        expr = F.when(norm == F.lit(key), F.lit(float(value))) if expr is None else expr.when(norm == F.lit(key), F.lit(float(value)))
    return expr if expr is not None else F.lit(None).cast("double")


def _nominal_domains(df: DataFrame, spec: FeatureSpec, nominal_cols: list[str]) -> dict[str, list[str]]:
    domains: dict[str, list[str]] = {}
    derive = [c for c in nominal_cols if spec.nominal.get(c) is None]
    for c in nominal_cols:
        if spec.nominal.get(c) is not None:
            domains[c] = list(spec.nominal[c])
    if derive:
        # one job: distinct normalized values of each undeclared nominal column
        long = df.select(
            F.explode(
                F.array(*[F.struct(F.lit(c).alias("feature"), normalize_category(col(c)).alias("value")) for c in derive])
            ).alias("cell")
        ).select("cell.*")
        values = long.where(F.col("value").isNotNull()).distinct().collect()
        for c in derive:
            domains[c] = sorted(r["value"] for r in values if r["feature"] == c)
    return domains


def feature_role_table(df: DataFrame, spec: FeatureSpec, features: list[str]) -> DataFrame:
    """E-5: feature, role, model_encoding, unique_values (missing counts as one value)."""
    types = {f.name: f.dataType for f in df.schema.fields}
    aggs = []
    for i, c in enumerate(features):
        aggs.append(F.count_distinct(col(c)).alias(f"d{i}"))
        aggs.append(F.max(col(c).isNull().cast("int")).alias(f"z{i}"))
    stats = df.agg(*aggs)
    rows = []
    for i, c in enumerate(features):
        role = spec.role_of(c, is_numeric_type(types[c]))
        rows.append(
            F.struct(
                F.lit(i).alias("position"),
                F.lit(c).alias("feature"),
                F.lit(role).alias("role"),
                F.lit(ROLE_ENCODING[role]).alias("model_encoding"),
                (F.col(f"d{i}") + F.coalesce(F.col(f"z{i}"), F.lit(0))).cast("long").alias("unique_values"),
            )
        )
    return stats.select(F.explode(F.array(*rows)).alias("r")).select("r.*")


def encode_features(
    df: DataFrame,
    spec: FeatureSpec,
    features: list[str] | None = None,
    target_encoding: TargetEncoding | None = None,
    validate: bool = True,
) -> EncodedTable:
    """E-9 + E-11: one select producing keys, encoded features and the target code last."""
    if features is None:
        features = split_features_target(df, spec.target, spec.exclude)
    key_cols = tuple(k for k in spec.key_cols if k in df.columns)
    types = {f.name: f.dataType for f in df.schema.fields}
    roles = {c: spec.role_of(c, is_numeric_type(types[c])) for c in features}
    domains = _nominal_domains(df, spec, [c for c in features if roles[c] == "nominal"])

    exprs: list[Column] = []
    names: list[str] = []
    role_rows: list[tuple[str, str, str, str, str]] = []
    checks: list[tuple[str, Column, Column]] = []  # (feature, unknown flag, shown value)
    coerced: list[str] = []
    for c in features:
        role = roles[c]
        enc_role, encoding = ENCODED_ROLE[role]
        if role == "numeric":
            if isinstance(types[c], T.StringType):
                value = nan_to_null(strip_text(col(c)).try_cast("double"))
                coerced.append(c)
            else:
                value = nan_to_null(col(c))
            exprs.append(value.alias(c))
            names.append(c)
            role_rows.append((c, c, role, enc_role, encoding))
        elif role in ("binary", "ordinal"):
            mapping = dict(spec.binary[c] if role == "binary" else spec.ordinal[c])
            value = mapped_code(col(c), mapping)
            exprs.append(value.alias(c))
            names.append(c)
            role_rows.append((c, c, role, enc_role, encoding))
            checks.append((c, value.isNull(), F.coalesce(normalize_category(col(c)), F.lit("nan"))))
        else:
            norm = normalize_category(col(c))
            domain = domains[c]
            for cat in domain:
                name = f"{c}_{cat}"
                exprs.append(F.coalesce((norm == F.lit(cat)).cast("int"), F.lit(0)).alias(name))
                names.append(name)
                role_rows.append((c, name, role, enc_role, encoding))
            shown = F.coalesce(norm, F.lit("nan"))
            known = norm.isin(*domain) if domain else F.lit(False)
            checks.append((c, ~F.coalesce(known, F.lit(False)), shown))

    if validate and checks:
        _raise_on_unknown(df, checks, roles)

    tenc = target_encoding or encode_target(df, spec.target, spec.positive_class)
    columns = (*[col(k) for k in key_cols], *exprs, tenc.code(col(spec.target)).alias(spec.target))
    return EncodedTable(df.select(*columns), names, role_rows, tenc, key_cols, tuple(coerced), columns)


def unknown_categories(df: DataFrame, checks: list[tuple[str, Column, Column]]) -> DataFrame:
    """(feature, value, rows) of every category that no mapping or category list defines."""
    cells = F.array(*[F.struct(F.lit(f).alias("feature"), shown.alias("value"), flag.alias("unknown")) for f, flag, shown in checks])
    return df.select(F.explode(cells).alias("cell")).select("cell.*").where("unknown").groupBy("feature", "value").agg(F.count("*").alias("rows"))


def _raise_on_unknown(df: DataFrame, checks: list[tuple[str, Column, Column]], roles: dict[str, str]) -> None:
    found: dict[str, list[str]] = {}
    for r in unknown_categories(df, checks).orderBy("feature", "value").toLocalIterator():
        found.setdefault(r["feature"], []).append(r["value"])
    if found:
        said = "; ".join(f"'{f}' ({roles[f]}): {values}" for f, values in found.items())
        raise ValueError(f"categories that the declared roles do not know: {said}")

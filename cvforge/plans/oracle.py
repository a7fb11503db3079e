"""Independent DuckDB SQL for the registered queries.

These strings are the correctness oracle: they recompute every result from the
raw tables with plain SQL (``ntile`` over the md5 order, ``UNION ALL`` unpivots,
joins against a fold list), sharing no code path with the Spark plans.
"""

from __future__ import annotations

from dataclasses import dataclass, field

STRIP = "regexp_replace(CAST({c} AS VARCHAR), '^\\s+|\\s+$', '', 'g')"
DIGITS = 10


def strip(c: str) -> str:
    return STRIP.format(c=c)


def rnd(expr: str, digits: int = DIGITS) -> str:
    return f"ROUND(CAST({expr} AS DOUBLE), {digits})"


def q(name: str) -> str:
    return '"' + name.replace('"', '""') + '"'


@dataclass
class SqlBinding:
    raw: str  # SELECT producing the raw modeling columns
    columns: list[str]
    doubles: list[str]
    keys: list[str]
    features: list[tuple[str, str, str]]  # (encoded name, SQL over clean, encoded role)
    target: str
    classes: list[str]
    numeric_sources: list[str] = field(default_factory=list)
    categorical_sources: list[str] = field(default_factory=list)
    source_roles: list[tuple[str, str]] = field(default_factory=list)  # (source feature, role) in input order

    @property
    def feature_names(self) -> list[str]:
        return [n for n, _, _ in self.features]

    def role_case(self, col: str = "feature") -> str:
        whens = " ".join(f"WHEN '{n}' THEN '{r}'" for n, _, r in self.features)
        return f"CASE {col} {whens} END"


def ctes(b: SqlBinding, k: int = 10, seed: int = 42) -> str:
    """raw -> clean (distinct, no missing) -> enc (encoded, target code) -> folded (row_id, fold)."""
    not_null = " AND ".join(
        [f"{q(c)} IS NOT NULL" for c in b.columns] + [f"NOT isnan({q(c)})" for c in b.doubles]
    )
    target_case = " ".join(f"WHEN '{c}' THEN {i}" for i, c in enumerate(b.classes))
    enc_cols = ", ".join(
        [q(k_) for k_ in b.keys]
        + [f"{expr} AS {q(n)}" for n, expr, _ in b.features]
        + [f"CAST(CASE CAST({q(b.target)} AS VARCHAR) {target_case} END AS INTEGER) AS {q(b.target)}"]
    )
    order = ", ".join(
        [f"md5(concat_ws('|', '{seed}', {', '.join(q(k_) for k_ in b.keys)}))"]
        + [q(k_) for k_ in b.keys]
        + [q(n) for n in b.feature_names]
        + [q(b.target)]
    )
    return f"""raw AS ({b.raw}),
clean AS (SELECT DISTINCT * FROM raw WHERE {not_null}),
enc AS (SELECT {enc_cols} FROM clean),
folded AS (
  SELECT *, CAST(row_number() OVER w - 1 AS BIGINT) AS row_id, CAST(ntile({k}) OVER w AS INTEGER) AS fold
  FROM enc WINDOW w AS (ORDER BY {order}))"""


def long_cte(b: SqlBinding) -> str:
    parts = [
        f"SELECT fold, {q(b.target)} AS y, '{n}' AS feature, CAST({q(n)} AS DOUBLE) AS value FROM folded"
        for n in b.feature_names
    ]
    return "long AS (" + "\nUNION ALL ".join(parts) + ")"


def ig_ctes(b: SqlBinding, k: int | None) -> str:
    """CTE chain ending in ``ranked(fold, feature, role, information_gain, ..., rank)``."""
    nf = k or 1
    on = "long.fold <> folds.f" if k else "TRUE"
    on_f = "folded.fold <> folds.f" if k else "TRUE"
    return f"""{ctes(b)},
{long_cte(b)},
folds AS (SELECT CAST(range AS INTEGER) AS f FROM range(1, {nf + 1})),
cells AS (SELECT folds.f AS fold, feature, value, y, count(*) AS n FROM long JOIN folds ON {on} GROUP BY ALL),
nx AS (SELECT fold, feature, value, sum(n) AS n_x FROM cells GROUP BY ALL),
cond AS (
  SELECT c.fold, c.feature, sum(c.n * log2(c.n / nx.n_x)) AS s
  FROM cells c JOIN nx ON c.fold = nx.fold AND c.feature = nx.feature AND c.value = nx.value GROUP BY ALL),
vc AS (SELECT fold, feature, count(*) AS value_count FROM nx GROUP BY ALL),
cls AS (SELECT folds.f AS fold, {q(b.target)} AS y, count(*) AS n FROM folded JOIN folds ON {on_f} GROUP BY ALL),
tot AS (SELECT fold, sum(n) AS n_train FROM cls GROUP BY ALL),
hy AS (SELECT cls.fold, tot.n_train, -sum(cls.n * log2(cls.n / tot.n_train)) / tot.n_train AS h FROM cls JOIN tot ON cls.fold = tot.fold GROUP BY cls.fold, tot.n_train),
ig AS (
  SELECT cond.fold, cond.feature, {b.role_case('cond.feature')} AS role,
         hy.h - (0.0 - cond.s) / hy.n_train AS information_gain, hy.h AS target_entropy,
         (0.0 - cond.s) / hy.n_train AS conditional_entropy, vc.value_count AS feature_value_count
  FROM cond JOIN hy ON cond.fold = hy.fold JOIN vc ON vc.fold = cond.fold AND vc.feature = cond.feature),
ranked AS (
  SELECT *, CAST(row_number() OVER (PARTITION BY fold ORDER BY ROUND(information_gain, 12) DESC, feature ASC) AS INTEGER) AS rank
  FROM ig)"""


def ig_sql(b: SqlBinding, k: int | None) -> str:
    """I-3 (k=None) / I-4: IG ranking per training fold."""
    fold_sel = "CAST(fold AS INTEGER) AS fold, " if k else ""
    enc_case = (
        "CASE role WHEN 'numeric' THEN 'encoded numeric values' WHEN 'binary_encoded' THEN 'encoded binary values' "
        "WHEN 'ordinal_encoded' THEN 'encoded ordinal values' WHEN 'one_hot_encoded' THEN 'encoded one-hot dummy values' "
        "ELSE 'encoded values' END"
    )
    return f"""WITH {ig_ctes(b, k)}
SELECT {fold_sel}rank, feature, role, {rnd('information_gain')} AS information_gain,
       {rnd('target_entropy')} AS target_entropy, {rnd('conditional_entropy')} AS conditional_entropy,
       CAST(feature_value_count AS BIGINT) AS feature_value_count, {enc_case} AS ig_encoding,
       'H(Y) - H(Y|X)' AS formula
FROM ranked"""


def class_rows_ig_sql(source: str, numeric: list[str], text: list[str], folds: int) -> str:
    """I-4 with E-14 from ``source(fold, y, features...)``: medians and most frequent texts of each fold's training rows."""
    parts = [f"SELECT fold, y, '{n}' AS feature, CAST({q(n)} AS DOUBLE) AS num, CAST(NULL AS VARCHAR) AS txt FROM src" for n in numeric]
    parts += [f"SELECT fold, y, '{n}' AS feature, NULL AS num, {q(n)} AS txt FROM src" for n in text]
    return f"""WITH src AS ({source}),
folds AS (SELECT CAST(range AS INTEGER) AS f FROM range(1, {folds + 1})),
long AS ({' UNION ALL '.join(parts)}),
seen AS (SELECT f AS fold, feature, num, txt, y, count(*) AS n FROM long JOIN folds ON fold <> f GROUP BY ALL),
sizes AS (SELECT fold, feature, num, txt, sum(n) AS n FROM seen WHERE num IS NOT NULL OR txt IS NOT NULL GROUP BY ALL),
modes AS (SELECT fold, feature, txt AS mode FROM sizes WHERE txt IS NOT NULL QUALIFY row_number() OVER (PARTITION BY fold, feature ORDER BY n DESC, txt) = 1),
medians AS (SELECT f AS fold, feature, quantile_cont(num, 0.5) AS median FROM long JOIN folds ON fold <> f WHERE num IS NOT NULL GROUP BY ALL),
filled AS (
  SELECT s.fold, s.feature, y, coalesce(CAST(num AS VARCHAR), txt, CAST(median AS VARCHAR), mode) AS v, sum(n) AS n
  FROM seen s LEFT JOIN modes USING (fold, feature) LEFT JOIN medians USING (fold, feature) GROUP BY ALL),
nx AS (SELECT fold, feature, v, sum(n) AS n_x FROM filled GROUP BY ALL),
cond AS (
  SELECT c.fold, c.feature, sum(c.n * log2(c.n / nx.n_x)) AS s
  FROM filled c JOIN nx ON c.fold = nx.fold AND c.feature = nx.feature AND c.v IS NOT DISTINCT FROM nx.v GROUP BY ALL),
vc AS (SELECT fold, feature, count(*) AS value_count FROM nx GROUP BY ALL),
cls AS (SELECT f AS fold, y, count(*) AS n FROM src JOIN folds ON fold <> f GROUP BY ALL),
tot AS (SELECT fold, sum(n) AS n_train FROM cls GROUP BY ALL),
hy AS (SELECT cls.fold, tot.n_train, -sum(cls.n * log2(cls.n / tot.n_train)) / tot.n_train AS h FROM cls JOIN tot ON cls.fold = tot.fold GROUP BY cls.fold, tot.n_train),
ig AS (
  SELECT fold, feature, h - (0.0 - s) / n_train AS information_gain, h, (0.0 - s) / n_train AS conditional, value_count
  FROM cond JOIN hy USING (fold) JOIN vc USING (fold, feature))
SELECT fold, CAST(row_number() OVER (PARTITION BY fold ORDER BY ROUND(information_gain, 12) DESC, feature) AS INTEGER) AS rank, feature,
       'encoded' AS role, {rnd('information_gain')} AS information_gain, {rnd('h')} AS target_entropy, {rnd('conditional')} AS conditional_entropy,
       CAST(value_count AS BIGINT) AS feature_value_count, 'encoded values' AS ig_encoding, 'H(Y) - H(Y|X)' AS formula
FROM ig"""


IG_GAPS = """SELECT CAST(l_orderkey % 10 + 1 AS INTEGER) AS fold, CASE l_returnflag WHEN 'A' THEN 0 WHEN 'N' THEN 1 ELSE 2 END AS y,
       l_linenumber AS line, nullif(l_quantity, 7) AS quantity, CASE WHEN l_suppkey % 3 > 0 THEN l_linestatus END AS status,
       CASE WHEN l_partkey % 11 > 0 THEN concat('p', l_partkey % 5) END AS part FROM lineitem"""
IG_PARTS = """SELECT CAST(l_orderkey % 10 + 1 AS INTEGER) AS fold, CAST(l_partkey % 1000 AS INTEGER) AS y,
       l_quantity AS quantity, l_discount AS discount, l_returnflag AS flag, l_linenumber AS line FROM lineitem"""


def selected_sql(b: SqlBinding, top_k: int) -> str:
    """I-5."""
    return f"WITH {ig_ctes(b, 10)} SELECT fold, rank, feature FROM ranked WHERE rank <= {top_k}"


def frequency_cte(b: SqlBinding, top_k: int, folds: int = 10) -> str:
    return f"""{ig_ctes(b, folds)},
freq AS (SELECT feature, count(*) AS selected_in_folds FROM ranked WHERE rank <= {top_k} GROUP BY feature),
freq_ranked AS (
  SELECT CAST(row_number() OVER (ORDER BY selected_in_folds DESC, feature ASC) AS INTEGER) AS rank, feature,
         CAST(selected_in_folds AS BIGINT) AS selected_in_folds, CAST({folds} AS BIGINT) AS total_folds,
         selected_in_folds / {folds} * 100.0 AS selection_frequency_pct
  FROM freq)"""


def frequency_sql(b: SqlBinding, top_k: int) -> str:
    """I-6."""
    return (
        f"WITH {frequency_cte(b, top_k)} SELECT rank, feature, selected_in_folds, total_folds, "
        f"{rnd('selection_frequency_pct')} AS selection_frequency_pct FROM freq_ranked"
    )


def final_features_sql(b: SqlBinding, top_k: int) -> str:
    """I-7."""
    return f"WITH {frequency_cte(b, top_k)} SELECT rank, feature FROM freq_ranked WHERE rank <= {top_k}"


def fold_selection_sql(b: SqlBinding, top_k: int) -> str:
    """I-9."""
    return f"""WITH {ig_ctes(b, 10)},
sizes AS (SELECT fold, count(*) AS test_samples FROM folded GROUP BY fold),
sel AS (
  SELECT fold, count(*) AS selected_feature_count, string_agg(feature, ', ' ORDER BY rank) AS selected_features
  FROM ranked WHERE rank <= {top_k} GROUP BY fold)
SELECT CAST(sizes.fold AS INTEGER) AS fold, CAST((SELECT count(*) FROM folded) - sizes.test_samples AS BIGINT) AS train_samples,
       CAST(sizes.test_samples AS BIGINT) AS test_samples, CAST(sel.selected_feature_count AS BIGINT) AS selected_feature_count,
       sel.selected_features
FROM sizes JOIN sel ON sizes.fold = sel.fold"""


# ---- audit and exploration ---------------------------------------------------------

SPARK_TYPE = "CASE typeof({c}) WHEN 'BIGINT' THEN 'bigint' WHEN 'INTEGER' THEN 'int' WHEN 'DOUBLE' THEN 'double' WHEN 'VARCHAR' THEN 'string' WHEN 'TIMESTAMP' THEN 'timestamp_ntz' ELSE lower(typeof({c})) END"


def _missing_expr(b: SqlBinding, c: str) -> str:
    return f"({q(c)} IS NULL OR isnan({q(c)}))" if c in b.doubles else f"({q(c)} IS NULL)"


def raw_audit_sql(b: SqlBinding) -> str:
    """Q-1."""
    n = len(b.columns)
    missing = " + ".join(f"count_if({_missing_expr(b, c)})" for c in b.columns)
    return f"""WITH raw AS ({b.raw})
SELECT 'rows' AS item, CAST(count(*) AS VARCHAR) AS value FROM raw
UNION ALL SELECT 'columns', '{n}'
UNION ALL SELECT 'target_column', '{b.target}'
UNION ALL SELECT 'feature_columns', '{n - 1}'
UNION ALL SELECT 'duplicate_rows', CAST((SELECT count(*) FROM raw) - (SELECT count(*) FROM (SELECT DISTINCT * FROM raw)) AS VARCHAR)
UNION ALL SELECT 'total_missing_values', CAST(CAST(({missing}) AS BIGINT) AS VARCHAR) FROM raw
UNION ALL SELECT 'target_count_' || coalesce(CAST({q(b.target)} AS VARCHAR), 'nan'), CAST(count(*) AS VARCHAR) FROM raw GROUP BY 1"""


def profile_sql(b: SqlBinding, source: str) -> str:
    """Q-2 (source='raw') / Q-8 (source='clean')."""
    parts = []
    for i, c in enumerate(b.columns):
        value = f"CASE WHEN isnan({q(c)}) THEN NULL ELSE {q(c)} END" if c in b.doubles else q(c)
        parts.append(
            f"SELECT CAST({i} AS INTEGER) AS position, '{c}' AS \"column\", (SELECT {SPARK_TYPE.format(c=q(c))} FROM {source} LIMIT 1) AS dtype, "
            f"CAST(count_if({_missing_expr(b, c)}) AS BIGINT) AS missing_values, "
            f"CAST(count(DISTINCT {value}) + CASE WHEN count_if({_missing_expr(b, c)}) > 0 THEN 1 ELSE 0 END AS BIGINT) AS unique_values "
            f"FROM {source}"
        )
    return f"WITH {ctes(b) if source == 'clean' else f'raw AS ({b.raw})'} " + " UNION ALL ".join(parts)


def clean_cte(b: SqlBinding) -> str:
    """raw and clean alone: distinct rows without a missing value."""
    any_missing = " OR ".join(_missing_expr(b, c) for c in b.columns)
    return f"raw AS ({b.raw}), clean AS (SELECT DISTINCT * FROM raw WHERE NOT ({any_missing}))"


def cleaning_stats_cte(b: SqlBinding) -> str:
    any_missing = " OR ".join(_missing_expr(b, c) for c in b.columns)
    return f"""raw AS ({b.raw}),
stats AS (
  SELECT CAST((SELECT count(*) FROM raw) AS BIGINT) AS rows_before,
         CAST((SELECT count(*) FROM raw) - (SELECT count(*) FROM (SELECT DISTINCT * FROM raw)) AS BIGINT) AS duplicate_rows_removed,
         CAST((SELECT count(*) FROM raw WHERE {any_missing}) AS BIGINT) AS missing_rows_before_cleaning,
         CAST((SELECT count(*) FROM (SELECT DISTINCT * FROM raw WHERE NOT ({any_missing}))) AS BIGINT) AS rows_after)"""


def cleaning_stats_sql(b: SqlBinding) -> str:
    """Q-5."""
    return (
        f"WITH {cleaning_stats_cte(b)} SELECT rows_before, duplicate_rows_removed, missing_rows_before_cleaning, "
        "rows_after, rows_before - rows_after AS total_rows_removed FROM stats"
    )


def preprocessing_summary_sql(b: SqlBinding) -> str:
    """Q-6."""
    return f"""WITH {cleaning_stats_cte(b)}
SELECT 'rows_before_preprocessing' AS item, rows_before AS value FROM stats
UNION ALL SELECT 'duplicate_rows_removed_keep_first', duplicate_rows_removed FROM stats
UNION ALL SELECT 'missing_rows_before_cleaning', missing_rows_before_cleaning FROM stats
UNION ALL SELECT 'rows_after_preprocessing', rows_after FROM stats
UNION ALL SELECT 'total_rows_removed', rows_before - rows_after FROM stats"""


def quality_check_sql(b: SqlBinding) -> str:
    """Q-7."""
    missing = " + ".join(f"count_if({_missing_expr(b, c)})" for c in b.columns)
    return f"""WITH {ctes(b)}
SELECT 'cleaned_rows' AS "check", CAST(count(*) AS BIGINT) AS value FROM clean
UNION ALL SELECT 'cleaned_columns', CAST({len(b.columns)} AS BIGINT)
UNION ALL SELECT 'remaining_missing_values', CAST(({missing}) AS BIGINT) FROM clean
UNION ALL SELECT 'remaining_duplicate_rows', CAST((SELECT count(*) FROM clean) - (SELECT count(*) FROM (SELECT DISTINCT * FROM clean)) AS BIGINT)
UNION ALL SELECT 'encoded_feature_rows', CAST(count(*) AS BIGINT) FROM enc
UNION ALL SELECT 'encoded_target_rows', CAST(count({q(b.target)}) AS BIGINT) FROM enc"""


def target_distribution_sql(b: SqlBinding) -> str:
    """X-1 on the clean table."""
    return f"""WITH {ctes(b)},
c AS (SELECT CAST({q(b.target)} AS VARCHAR) AS class_label, count(*) AS n FROM clean WHERE {q(b.target)} IS NOT NULL GROUP BY 1)
SELECT class_label, CAST(n AS BIGINT) AS "count", {rnd('n * 100.0 / sum(n) OVER ()')} AS percentage FROM c"""


def numeric_summary_sql(b: SqlBinding, columns: list[str], source: str, digits: int) -> str:
    """X-2 (source='clean') / X-4 (source='enc')."""
    parts = []
    for c in columns:
        v = f"CAST({q(c)} AS DOUBLE)"
        parts.append(
            f"SELECT '{c}' AS feature, CAST(count({v}) AS BIGINT) AS \"count\", {rnd(f'avg({v})', digits)} AS mean, "
            f"{rnd(f'stddev_samp({v})', digits)} AS std, {rnd(f'min({v})', digits)} AS \"min\", "
            f"{rnd(f'quantile_cont({v}, 0.25)', digits)} AS p25, {rnd(f'quantile_cont({v}, 0.5)', digits)} AS p50, "
            f"{rnd(f'quantile_cont({v}, 0.75)', digits)} AS p75, {rnd(f'max({v})', digits)} AS \"max\" FROM {source}"
        )
    return f"WITH {ctes(b)} " + " UNION ALL ".join(parts)


def categorical_summary_sql(b: SqlBinding, columns: list[str]) -> str:
    """X-3 on the clean table."""
    longs = " UNION ALL ".join(f"SELECT '{c}' AS feature, CAST({q(c)} AS VARCHAR) AS value FROM clean" for c in columns)
    return f"""WITH {ctes(b)},
long AS ({longs}),
cnt AS (SELECT feature, value, count(*) AS n FROM long GROUP BY ALL),
top AS (SELECT *, row_number() OVER (PARTITION BY feature ORDER BY n DESC, value ASC NULLS FIRST) AS r FROM cnt)
SELECT feature, CAST((SELECT count(*) FROM cnt c2 WHERE c2.feature = top.feature) AS BIGINT) AS unique_values,
       value AS most_common_value, CAST(n AS BIGINT) AS most_common_count
FROM top WHERE r = 1"""


def fold_sizes_sql(b: SqlBinding) -> str:
    """X-5."""
    return f"WITH {ctes(b)} SELECT fold, CAST(count(*) AS BIGINT) AS test_samples_in_fold FROM folded GROUP BY fold"


def fold_class_sql(b: SqlBinding) -> str:
    """X-6: class text via the inverse label map (E-13)."""
    inv = " ".join(f"WHEN {i} THEN '{c}'" for i, c in enumerate(b.classes))
    return f"""WITH {ctes(b)},
c AS (SELECT fold, CASE {q(b.target)} {inv} END AS class_label, count(*) AS n FROM folded GROUP BY ALL)
SELECT fold, class_label, CAST(n AS BIGINT) AS "count", {rnd('n * 100.0 / sum(n) OVER (PARTITION BY fold)')} AS percentage FROM c"""


MODEL_ENCODING = {
    "binary": "manual binary mapping",
    "ordinal": "manual ordinal mapping",
    "nominal": "one-hot encoding",
    "numeric": "numeric passthrough",
}
ENCODED = {
    "numeric": ("numeric", "numeric passthrough"),
    "binary": ("binary_encoded", "manual binary mapping"),
    "ordinal": ("ordinal_encoded", "manual ordinal mapping"),
    "nominal": ("one_hot_encoded", "manual one-hot encoding"),
}


def feature_roles_sql(b: SqlBinding) -> str:
    """E-5 on the clean table."""
    parts = [
        f"SELECT CAST({i} AS INTEGER) AS position, '{c}' AS feature, '{r}' AS role, '{MODEL_ENCODING[r]}' AS model_encoding, "
        f"CAST(count(DISTINCT {q(c)}) + max(CASE WHEN {q(c)} IS NULL THEN 1 ELSE 0 END) AS BIGINT) AS unique_values FROM clean"
        for i, (c, r) in enumerate(b.source_roles)
    ]
    return f"WITH {ctes(b)} " + " UNION ALL ".join(parts)


def encoded_roles_sql(b: SqlBinding) -> str:
    """E-9/E-10 role map; one-hot names come from the clean table's distinct categories."""
    parts = []
    for c, r in b.source_roles:
        er, enc = ENCODED[r]
        if r == "nominal":
            parts.append(
                f"SELECT DISTINCT '{c}' AS source_feature, '{c}_' || {strip(q(c))} AS encoded_feature, "
                f"'{r}' AS source_role, '{er}' AS encoded_role, '{enc}' AS encoding FROM clean"
            )
        else:
            parts.append(
                f"SELECT '{c}' AS source_feature, '{c}' AS encoded_feature, '{r}' AS source_role, '{er}' AS encoded_role, '{enc}' AS encoding"
            )
    return f"WITH {ctes(b)} " + " UNION ALL ".join(parts)


def label_mapping_sql(b: SqlBinding) -> str:
    """E-12 from the clean table's distinct classes."""
    return f"""WITH {ctes(b)}
SELECT class_label, CAST(row_number() OVER (ORDER BY class_label) - 1 AS INTEGER) AS encoded_value
FROM (SELECT DISTINCT CAST({q(b.target)} AS VARCHAR) AS class_label FROM clean)"""


# ---- bindings --------------------------------------------------------------------


def lineitem() -> SqlBinding:
    keys = ["l_orderkey", "l_partkey", "l_suppkey", "l_linenumber"]
    nums = ["l_quantity", "l_extendedprice", "l_discount", "l_tax"]
    return SqlBinding(
        raw=(
            "SELECT l_orderkey, l_partkey, l_suppkey, l_linenumber, l_linestatus, l_quantity, l_extendedprice, "
            "l_discount, l_tax, CASE WHEN l_returnflag = 'R' THEN 'Yes' ELSE 'No' END AS returned FROM lineitem"
        ),
        columns=keys + ["l_linestatus"] + nums + ["returned"],
        doubles=nums,
        keys=keys,
        features=[("l_linestatus", f"CAST(CASE {strip('l_linestatus')} WHEN 'F' THEN 0 WHEN 'O' THEN 1 END AS DOUBLE)", "binary_encoded")]
        + [(n, f"CAST({n} AS DOUBLE)", "numeric") for n in nums],
        target="returned",
        classes=["No", "Yes"],
        numeric_sources=nums,
        categorical_sources=["l_linestatus"],
        source_roles=[("l_linestatus", "binary")] + [(n, "numeric") for n in nums],
    )


SOURCES = sorted(f"src{i}" for i in range(20))
LANGS = ["de", "en", "es", "fr"]


def documents() -> SqlBinding:
    feats = [(f"lang_{v}", f"CAST(coalesce({strip('lang')} = '{v}', false) AS INTEGER)", "one_hot_encoded") for v in LANGS]
    feats += [
        (f"source_{v}", f"CAST(coalesce({strip('source')} = '{v}', false) AS INTEGER)", "one_hot_encoded") for v in SOURCES
    ]
    feats += [("n_chars", "CAST(n_chars AS DOUBLE)", "numeric")]
    return SqlBinding(
        raw=(
            "SELECT d.doc_id, d.lang, d.source, d.n_chars, CAST(l.quality AS VARCHAR) AS quality "
            "FROM documents d JOIN labels l ON d.doc_id = l.doc_id"
        ),
        columns=["doc_id", "lang", "source", "n_chars", "quality"],
        doubles=[],
        keys=["doc_id"],
        features=feats,
        target="quality",
        classes=["0", "1"],
        numeric_sources=["n_chars"],
        categorical_sources=["lang", "source"],
        source_roles=[("lang", "nominal"), ("source", "nominal"), ("n_chars", "numeric")],
    )


PRIORITIES = ["1-URGENT", "2-HIGH", "3-MEDIUM", "4-NOT SPECIFIED", "5-LOW"]


def orders() -> SqlBinding:
    case = " ".join(f"WHEN '{p}' THEN {i}" for i, p in enumerate(PRIORITIES))
    return SqlBinding(
        raw="SELECT o_orderkey, o_orderpriority, o_totalprice, o_orderstatus FROM orders",
        columns=["o_orderkey", "o_orderpriority", "o_totalprice", "o_orderstatus"],
        doubles=["o_totalprice"],
        keys=["o_orderkey"],
        features=[
            ("o_orderpriority", f"CAST(CASE {strip('o_orderpriority')} {case} END AS DOUBLE)", "ordinal_encoded"),
            ("o_totalprice", "CAST(o_totalprice AS DOUBLE)", "numeric"),
        ],
        target="o_orderstatus",
        classes=["F", "O", "P"],
        numeric_sources=["o_totalprice"],
        categorical_sources=["o_orderpriority"],
        source_roles=[("o_orderpriority", "ordinal"), ("o_totalprice", "numeric")],
    )


def events() -> SqlBinding:
    return SqlBinding(
        raw=(
            "SELECT event_id, value, CAST(hour(ts) AS INTEGER) AS hour, "
            "CASE WHEN event_type = 'purchase' THEN 'Yes' ELSE 'No' END AS purchased FROM events"
        ),
        columns=["event_id", "value", "hour", "purchased"],
        doubles=["value"],
        keys=["event_id"],
        features=[("value", "CAST(value AS DOUBLE)", "numeric"), ("hour", "CAST(hour AS DOUBLE)", "numeric")],
        target="purchased",
        classes=["No", "Yes"],
        numeric_sources=["value", "hour"],
        categorical_sources=[],
        source_roles=[("value", "numeric"), ("hour", "numeric")],
    )


SQL_BINDINGS = {"lineitem": lineitem, "documents": documents, "orders": orders, "events": events}


# ---- whole tables, for the audits ------------------------------------------------------


def _whole(table: str, columns: list[str], doubles: list[str], target: str) -> SqlBinding:
    return SqlBinding(raw=f"SELECT * FROM {table}", columns=columns, doubles=doubles, keys=[], features=[], target=target, classes=[])


WHOLE = {
    "lineitem": _whole(
        "lineitem",
        ["l_orderkey", "l_partkey", "l_suppkey", "l_linenumber", "l_quantity", "l_extendedprice", "l_discount", "l_tax", "l_returnflag", "l_linestatus", "l_shipdate"],
        ["l_quantity", "l_extendedprice", "l_discount", "l_tax"],
        "l_returnflag",
    ),
    "documents": _whole("documents", ["doc_id", "text", "lang", "source", "n_chars"], [], "lang"),
    "orders": _whole("orders", ["o_orderkey", "o_custkey", "o_orderstatus", "o_totalprice", "o_orderdate", "o_orderpriority"], ["o_totalprice"], "o_orderstatus"),
    "events": _whole("events", ["event_id", "ts", "user_id", "event_type", "value", "props"], ["value"], "event_type"),
}

GAPS = SqlBinding(
    raw=(
        "SELECT l_linenumber AS line, nullif(l_quantity, 7) AS quantity, "
        "CASE WHEN l_suppkey % 3 = 0 THEN '  ' || l_linestatus || chr(9) ELSE l_linestatus END AS status, "
        "CASE WHEN l_partkey % 11 > 0 THEN ' ' || CAST(l_partkey % 5 AS VARCHAR) || ' ' END AS part, l_returnflag AS returned FROM lineitem"
    ),
    columns=["line", "quantity", "status", "part", "returned"],
    doubles=["quantity"],
    keys=[],
    features=[],
    target="returned",
    classes=["A", "N", "R"],
)
GAPS_ENCODED = f"""WITH {clean_cte(GAPS)}
SELECT CAST(line AS DOUBLE) AS line, quantity, CAST(CASE {strip('status')} WHEN 'F' THEN 0 WHEN 'O' THEN 1 END AS DOUBLE) AS status,
       CAST({strip('part')} AS DOUBLE) AS part, CAST(CASE returned WHEN 'A' THEN 0 WHEN 'N' THEN 1 ELSE 2 END AS INTEGER) AS returned FROM clean"""


# ---- metrics on fixed, data-derived scores -------------------------------------------

SCORES = {
    "lineitem": ("least(greatest(l_discount * 5.0 + l_tax * 5.0, 0.0), 1.0)", None),
    "documents": ("n_chars / (n_chars + 1000.0)", None),
    "orders": (None, "CAST(o_orderkey % 3 AS INTEGER)"),
    "events": ("value / (value + 50.0)", None),
}


def scored_cte(name: str, b: SqlBinding) -> str:
    score, pred = SCORES[name]
    if score is not None:
        return (
            f"pred AS (SELECT fold, {q(b.target)} AS y, CAST({score} AS DOUBLE) AS score, "
            f"CAST({score} > 0.5 AS INTEGER) AS pred FROM folded)"
        )
    return f"pred AS (SELECT fold, {q(b.target)} AS y, {pred} AS pred FROM folded)"


METRIC_COLS = ["accuracy", "precision", "recall", "specificity", "f1_score", "roc_auc", "mcc", "pr_auc", "brier_score"]


def metrics_cte(name: str, b: SqlBinding, by_fold: bool) -> str:
    """CTE ``m(fold?, n, metrics...)`` computed from ``pred``."""
    g = "fold" if by_fold else "()"
    gsel = "fold, " if by_fold else ""
    j = "a.fold = b.fold" if by_fold else "TRUE"
    jc = "b.fold = a.fold AND " if by_fold else ""
    if len(b.classes) == 2:
        return f"""cm AS (
  SELECT {gsel}count(*) AS n, count_if(y = pred) AS c, count_if(y = 1 AND pred = 1) AS tp, count_if(y = 0 AND pred = 1) AS fp,
         count_if(y = 1 AND pred = 0) AS fn, count_if(y = 0 AND pred = 0) AS tn, avg(power(score - y, 2)) AS brier
  FROM pred GROUP BY {g}),
sc AS (SELECT {gsel}score, count_if(y = 1) AS pos, count_if(y = 0) AS neg FROM pred GROUP BY {gsel}score),
pairs AS (
  SELECT {'a.fold, ' if by_fold else ''}sum(a.pos * b.neg * CASE WHEN a.score > b.score THEN 1.0 WHEN a.score = b.score THEN 0.5 ELSE 0.0 END) AS w
  FROM sc a JOIN sc b ON {j} GROUP BY {'a.fold' if by_fold else '()'}),
tot AS (SELECT {gsel}sum(pos) AS P, sum(neg) AS N FROM sc GROUP BY {g}),
apt AS (
  SELECT {'a.fold, ' if by_fold else ''}sum(CASE WHEN a.pos > 0 THEN a.pos *
      (SELECT sum(b.pos) FROM sc b WHERE {jc}b.score >= a.score) /
      (SELECT sum(b.pos + b.neg) FROM sc b WHERE {jc}b.score >= a.score) ELSE 0 END) AS s
  FROM sc a GROUP BY {'a.fold' if by_fold else '()'}),
m AS (
  SELECT {'cm.fold, ' if by_fold else ''}cm.n, CAST(cm.c AS DOUBLE) / cm.n AS accuracy,
    CASE WHEN cm.tp + cm.fp > 0 THEN cm.tp / (cm.tp + cm.fp) ELSE 0.0 END AS precision,
    CASE WHEN cm.tp + cm.fn > 0 THEN cm.tp / (cm.tp + cm.fn) ELSE 0.0 END AS recall,
    CASE WHEN cm.tn + cm.fp > 0 THEN cm.tn / (cm.tn + cm.fp) END AS specificity,
    CASE WHEN 2 * cm.tp + cm.fp + cm.fn > 0 THEN 2.0 * cm.tp / (2 * cm.tp + cm.fp + cm.fn) ELSE 0.0 END AS f1_score,
    CASE WHEN tot.P > 0 AND tot.N > 0 THEN pairs.w / (tot.P * tot.N) END AS roc_auc,
    CASE WHEN (cm.tp + cm.fp) * (cm.tp + cm.fn) * (cm.tn + cm.fp) * (cm.tn + cm.fn) > 0
         THEN (CAST(cm.tp AS DOUBLE) * cm.tn - CAST(cm.fp AS DOUBLE) * cm.fn)
              / sqrt(CAST(cm.tp + cm.fp AS DOUBLE) * (cm.tp + cm.fn) * (cm.tn + cm.fp) * (cm.tn + cm.fn))
         ELSE 0.0 END AS mcc,
    CASE WHEN tot.P > 0 THEN apt.s / tot.P ELSE 0.0 END AS pr_auc,
    cm.brier AS brier_score
  FROM cm {'JOIN tot ON cm.fold = tot.fold JOIN pairs ON cm.fold = pairs.fold JOIN apt ON cm.fold = apt.fold' if by_fold else ', tot, pairs, apt'})"""
    ks = ", ".join(f"({i})" for i in range(len(b.classes)))
    return f"""cls AS (
  SELECT {gsel}v.k, count_if(y = v.k) AS t, count_if(pred = v.k) AS p, count_if(y = v.k AND pred = v.k) AS tp
  FROM pred, (VALUES {ks}) v(k) GROUP BY {gsel}v.k),
agg AS (
  SELECT {gsel}sum(t) AS n, sum(tp) AS c,
    sum(t * CASE WHEN p > 0 THEN tp / p ELSE 0.0 END) / sum(t) AS precision,
    sum(t * CASE WHEN t > 0 THEN tp / t ELSE 0.0 END) / sum(t) AS recall,
    sum(t * CASE WHEN t + p > 0 THEN 2.0 * tp / (t + p) ELSE 0.0 END) / sum(t) AS f1_score,
    sum(CAST(p AS DOUBLE) * t) AS pt, sum(CAST(p AS DOUBLE) * p) AS pp, sum(CAST(t AS DOUBLE) * t) AS tt
  FROM cls GROUP BY {g}),
m AS (
  SELECT {gsel}n, CAST(c AS DOUBLE) / n AS accuracy, precision, recall, CAST(NULL AS DOUBLE) AS specificity, f1_score,
    CAST(NULL AS DOUBLE) AS roc_auc,
    CASE WHEN (CAST(n AS DOUBLE) * n - pp) * (CAST(n AS DOUBLE) * n - tt) > 0
         THEN (CAST(c AS DOUBLE) * n - pt) / sqrt((CAST(n AS DOUBLE) * n - pp) * (CAST(n AS DOUBLE) * n - tt)) ELSE 0.0 END AS mcc,
    CAST(NULL AS DOUBLE) AS pr_auc, CAST(NULL AS DOUBLE) AS brier_score
  FROM agg)"""


def fold_metrics_sql(name: str, b: SqlBinding) -> str:
    """M-14."""
    cols = ", ".join(f"{rnd(c)} AS {c}" for c in METRIC_COLS)
    return f"""WITH {ctes(b)}, {scored_cte(name, b)}, {metrics_cte(name, b, True)}
SELECT fold, CAST((SELECT count(*) FROM folded) - n AS BIGINT) AS train_samples, CAST(n AS BIGINT) AS test_samples, {cols} FROM m"""


def pooled_metrics_sql(name: str, b: SqlBinding) -> str:
    """M-15."""
    cols = ", ".join(f"{rnd(c)} AS {c}" for c in METRIC_COLS)
    return f"WITH {ctes(b)}, {scored_cte(name, b)}, {metrics_cte(name, b, False)} SELECT {cols} FROM m"


def fold_summary_sql(name: str, b: SqlBinding) -> str:
    """M-13."""
    cols = ", ".join(
        f"{rnd(f'avg({c})')} AS mean_cv_{c}, {rnd(f'stddev_pop({c})')} AS std_cv_{c}" for c in METRIC_COLS
    )
    return f"WITH {ctes(b)}, {scored_cte(name, b)}, {metrics_cte(name, b, True)} SELECT {cols} FROM m"


def confusion_sql(name: str, b: SqlBinding) -> str:
    """M-1 pooled over all rows, zeros included."""
    labels = ", ".join(f"({i}, '{c}')" for i, c in enumerate(b.classes))
    return f"""WITH {ctes(b)}, {scored_cte(name, b)},
lab AS (SELECT * FROM (VALUES {labels}) v(k, label))
SELECT a.label AS actual_label, p.label AS predicted_label,
       CAST((SELECT count(*) FROM pred WHERE y = a.k AND pred.pred = p.k) AS BIGINT) AS "count"
FROM lab a, lab p"""


def first_split_sql(b: SqlBinding, digits: int = 8) -> str:
    """B-1..B-4 round 1: base score 0.5 (g = 0.5 - y, h = 0.25), exact candidate values,
    lambda 1, gamma 0, min_child_weight 1; best root split of each fold model."""
    longs = " UNION ALL ".join(
        f"SELECT row_id, fold, {q(b.target)} AS y, {i} AS fi, '{n}' AS feature, CAST({q(n)} AS DOUBLE) AS value FROM folded"
        for i, n in enumerate(b.feature_names)
    )
    return f"""WITH {ctes(b)},
long AS ({longs}),
dv AS (SELECT DISTINCT fi, value FROM long),
bins AS (SELECT fi, value, dense_rank() OVER (PARTITION BY fi ORDER BY value) - 1 AS bin,
                lead(value) OVER (PARTITION BY fi ORDER BY value) AS threshold FROM dv),
folds AS (SELECT CAST(range AS INTEGER) AS f FROM range(1, 11)),
hist AS (
  SELECT folds.f AS fold, l.fi, l.feature, bins.bin, bins.threshold, sum(0.5 - l.y) AS sg, count(*) * 0.25 AS sh
  FROM long l JOIN bins ON l.fi = bins.fi AND l.value = bins.value JOIN folds ON l.fold <> folds.f GROUP BY ALL),
cum AS (
  SELECT *, sum(sg) OVER (PARTITION BY fold, fi ORDER BY bin) AS gl, sum(sh) OVER (PARTITION BY fold, fi ORDER BY bin) AS hl,
         sum(sg) OVER (PARTITION BY fold, fi) AS g, sum(sh) OVER (PARTITION BY fold, fi) AS h FROM hist),
gains AS (
  SELECT *, 0.5 * (gl * gl / (hl + 1.0) + (g - gl) * (g - gl) / (h - hl + 1.0) - g * g / (h + 1.0)) AS gain
  FROM cum WHERE hl >= 1.0 AND h - hl >= 1.0),
best AS (SELECT *, row_number() OVER (PARTITION BY fold ORDER BY ROUND(gain, 12) DESC, fi, bin) AS rn FROM gains)
SELECT fold, feature, threshold, {rnd('gain', digits)} AS gain, {rnd('gl', digits)} AS grad_left, {rnd('hl', digits)} AS hess_left
FROM best WHERE rn = 1 AND gain > 0"""


# ---- B-1 .. B-7: whole rounds of boosting ----------------------------------------------


def boost_ctes(b: SqlBinding, n_classes: int, rounds: int, depth: int, rate: float, k: int = 10) -> str:
    """CTEs up to ``probs(fold, row_id, y, k, p)``: one model a fold, trained on the other folds and
    asked for its own rows. Base score 0.5, lambda 1, min_child_weight 1, a bin for each distinct
    value; gradients are whole multiples of 2^-30, so every sum is exact."""
    trees = 1 if n_classes == 2 else n_classes
    cells = " UNION ALL ".join(
        f"SELECT row_id, {i} AS fi, dense_rank() OVER (ORDER BY CAST({q(n)} AS DOUBLE)) AS bin FROM folded" for i, n in enumerate(b.feature_names)
    )
    out = [
        ctes(b, k),
        f"cell AS MATERIALIZED ({cells})",
        f"s0 AS MATERIALIZED (SELECT f.range AS model, row_id, fold, {q(b.target)} AS y, t.range AS k, 0.0::DOUBLE AS margin "
        f"FROM folded, range(1, {k + 1}) AS f, range({trees}) AS t)",
    ]
    unit = float(1 << 30)
    for r in range(1, rounds + 1):
        if trees == 1:
            p, h = "1.0 / (1.0 + exp(-margin))", "p * (1 - p)"
            src = f"(SELECT *, {p} AS p FROM s{r - 1})"
        else:
            src = f"(SELECT *, exp(margin - max(margin) OVER w) AS e FROM s{r - 1} WINDOW w AS (PARTITION BY model, row_id))"
            src = f"(SELECT *, e / sum(e) OVER w AS p FROM {src} WINDOW w AS (PARTITION BY model, row_id))"
            h = "2.0 * p * (1 - p)"
        hit = "CAST(y = 1 AS INT)" if trees == 1 else "CAST(y = k AS INT)"
        out.append(
            f"n{r}_0 AS MATERIALIZED (SELECT model, row_id, fold, y, k, margin, 0 AS node, fold <> model AS trains, "
            f"CAST(round((p - {hit}) * {unit}) AS BIGINT) AS g, greatest(CAST(round({h} * {unit}) AS BIGINT), 1) AS h FROM {src})"
        )
        for d in range(depth):
            low = (1 << d) - 1  # nodes of this depth are open
            out.append(
                f"b{r}_{d} AS MATERIALIZED (SELECT model, k, node, fi, bin FROM (SELECT *, row_number() OVER (PARTITION BY model, k, node ORDER BY round(gain, 12) DESC, fi, bin) AS rn FROM ("
                f"SELECT *, 0.5 * (gl * gl / (hl + 1.0) + (g - gl) * (g - gl) / (h - hl + 1.0) - g * g / (h + 1.0)) AS gain FROM ("
                f"SELECT model, k, node, fi, bin, sum(g) OVER c / {unit} AS gl, sum(h) OVER c / {unit} AS hl, sum(g) OVER a / {unit} AS g, sum(h) OVER a / {unit} AS h FROM ("
                f"SELECT model, k, node, fi, bin, sum(g)::BIGINT AS g, sum(h)::BIGINT AS h FROM n{r}_{d} JOIN cell USING (row_id) WHERE trains AND node >= {low} GROUP BY ALL) "
                f"WINDOW a AS (PARTITION BY model, k, node, fi), c AS (PARTITION BY model, k, node, fi ORDER BY bin))) "
                f"WHERE hl >= 1.0 AND h - hl >= 1.0) WHERE rn = 1 AND gain > 0)"
            )
            out.append(
                f"n{r}_{d + 1} AS MATERIALIZED (SELECT n.* EXCLUDE (node), CASE WHEN b.fi IS NULL THEN n.node ELSE 2 * n.node + 1 + CAST(cell.bin > b.bin AS INT) END AS node "
                f"FROM n{r}_{d} AS n LEFT JOIN b{r}_{d} AS b ON b.model = n.model AND b.k = n.k AND b.node = n.node LEFT JOIN cell ON cell.row_id = n.row_id AND cell.fi = b.fi)"
            )
        out.append(f"l{r} AS MATERIALIZED (SELECT model, k, node, -(sum(g) / {unit}) / (sum(h) / {unit} + 1.0) * {rate} AS value FROM n{r}_{depth} WHERE trains GROUP BY ALL)")
        out.append(
            f"s{r} AS MATERIALIZED (SELECT n.model, n.row_id, n.fold, n.y, n.k, n.margin + coalesce(l.value, 0.0) AS margin FROM n{r}_{depth} AS n "
            f"LEFT JOIN l{r} AS l ON l.model = n.model AND l.k = n.k AND l.node = n.node)"
        )
    own = f"(SELECT * FROM s{rounds} WHERE model = fold)"
    if trees == 1:
        one = f"SELECT fold, row_id, y, 1.0 / (1.0 + exp(-margin)) AS p1 FROM {own}"
        out.append(f"probs AS MATERIALIZED (SELECT fold, row_id, y, 0 AS k, 1 - p1 AS p FROM ({one}) UNION ALL SELECT fold, row_id, y, 1 AS k, p1 AS p FROM ({one}))")
    else:
        e = f"SELECT *, exp(margin - max(margin) OVER (PARTITION BY row_id)) AS e FROM {own}"
        out.append(f"probs AS MATERIALIZED (SELECT fold, row_id, y, k, e / sum(e) OVER (PARTITION BY row_id) AS p FROM ({e}))")
    out.append("said AS MATERIALIZED (SELECT row_id, k AS pred FROM probs QUALIFY row_number() OVER (PARTITION BY row_id ORDER BY p DESC, k) = 1)")
    return ",\n".join(out)


def oof_predictions_sql(b: SqlBinding, classes: list[str], rounds: int, depth: int, rate: float) -> str:
    """G-21, G-22: out-of-fold predictions of one model a fold."""
    label = lambda c: "CASE " + c + " " + " ".join(f"WHEN {i} THEN '{x}'" for i, x in enumerate(classes)) + " END"
    columns = ", ".join(f"round(max(CASE WHEN k = {i} THEN p END), 4) AS {q('probability_' + x)}" for i, x in enumerate(classes))
    return (
        f"WITH {boost_ctes(b, len(classes), rounds, depth, rate)}\n"
        f"SELECT row_id AS source_row_index, fold, {label('y')} AS actual_label, {label('pred')} AS predicted_label, y = pred AS is_correct, {columns} "
        "FROM probs JOIN said USING (row_id) GROUP BY row_id, fold, y, pred"
    )


def oof_confusion_sql(b: SqlBinding, n_classes: int, rounds: int, depth: int, rate: float) -> str:
    """M-1 by fold on the out-of-fold predictions: (fold, actual, predicted, rows)."""
    return (
        f"WITH {boost_ctes(b, n_classes, rounds, depth, rate)}\n"
        "SELECT p.fold, CAST(y AS INT) AS actual, CAST(pred AS INT) AS predicted, count(*) AS rows FROM (SELECT DISTINCT fold, row_id, y FROM probs) AS p JOIN said USING (row_id) GROUP BY ALL"
    )


def oof_fold_metrics_sql(name: str, b: SqlBinding, rounds: int, depth: int, rate: float) -> str:
    """M-14 on the out-of-fold predictions of three classes or more."""
    cols = ", ".join(f"{rnd(c)} AS {c}" for c in METRIC_COLS)
    return (
        f"WITH {boost_ctes(b, len(b.classes), rounds, depth, rate)},\n"
        "pred AS (SELECT p.fold, y, pred FROM (SELECT DISTINCT fold, row_id, y FROM probs) AS p JOIN said USING (row_id)),\n"
        f"{metrics_cte(name, b, True)}\n"
        f"SELECT fold, CAST((SELECT count(*) FROM folded) - n AS BIGINT) AS train_samples, CAST(n AS BIGINT) AS test_samples, {cols} FROM m"
    )


def hist_bins_sql(b: SqlBinding, max_bin: int) -> str:
    """B-4 (hist): every value but the least, of features with at most ``max_bin`` values."""
    parts = [f"SELECT DISTINCT '{f}' AS feature, CAST({q(f)} AS DOUBLE) AS v FROM enc WHERE {q(f)} IS NOT NULL" for f in b.feature_names]
    return (
        f"WITH {ctes(b)}, vals AS ({' UNION ALL '.join(parts)}), "
        "placed AS (SELECT *, row_number() OVER (PARTITION BY feature ORDER BY v) AS place, count(*) OVER (PARTITION BY feature) AS n FROM vals) "
        f"SELECT feature, CAST(place - 2 AS INTEGER) AS bin, v AS threshold FROM placed WHERE place > 1 AND n <= {max_bin}"
    )


def row_draws_sql(b: SqlBinding, seed: int, rate: float, rounds: int = 3) -> str:
    """B-5: which rows each round draws."""
    draw = f"CAST('0x' || substr(md5(concat_ws('|', '{seed}', r.range, row_id)), 1, 8) AS BIGINT) / 4294967296.0"
    return f"WITH {ctes(b)} SELECT CAST(r.range AS INT) AS round, row_id, {draw} < {rate} AS drawn FROM folded, range(1, {rounds + 1}) AS r"

"""Column-level operators re-aimed from the JDBC driver samples (V5-V7).

Sparse column sets to name/value rows, sensitivity labels with masking, and
XML columns read with XPath. All are projections: no shuffle.
"""

from __future__ import annotations

import json
from collections.abc import Mapping, Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T


def sparse_nonnull(df: DataFrame, id_cols: Sequence[str], cols: Sequence[str],
                   name_col: str = "column_name", value_col: str = "value") -> DataFrame:
    """One ``(ids..., column_name, value)`` row per non-null cell of ``cols`` (V6)."""
    cells = F.array(*[F.struct(F.lit(c).alias(name_col), F.col(c).cast("string").alias(value_col))
                      for c in cols])
    return (df.select(*id_cols, F.inline(F.filter(cells, lambda s: s[value_col].isNotNull()))))


def with_sensitivity(df: DataFrame, labels: Mapping[str, Mapping[str, str]]) -> DataFrame:
    """Attach labels (e.g. ``{"label": "Confidential", "information_type": "Name"}``) to column metadata (V7)."""
    out = df
    for c, meta in labels.items():
        field = out.schema[c]
        out = out.withMetadata(c, {**field.metadata, "sensitivity": dict(meta)})
    return out


def sensitivity_of(df: DataFrame) -> dict[str, dict]:
    """Column name to its sensitivity label, read from the schema."""
    return {f.name: f.metadata["sensitivity"] for f in df.schema.fields if "sensitivity" in f.metadata}


def mask_columns(df: DataFrame, cols: Sequence[str] | None = None) -> DataFrame:
    """Mask labelled (or named) text columns: upper -> X, lower -> x, digit -> n (V7)."""
    targets = list(cols) if cols is not None else list(sensitivity_of(df))
    out = df
    for c in targets:
        out = out.withColumn(c, F.mask(F.col(c)))
    return out


#: Sensitivity labels from least to most; a column with several ancestors has the highest of theirs.
LEVELS = ("Public", "General", "Confidential", "Highly Confidential")


def _seq(items) -> list:
    return [items.apply(i) for i in range(items.size())]


def _lineage(spark: SparkSession, plan, found: dict[int, set]) -> None:
    """Add, for every column of an analysed plan by its id, the labels of the columns it is computed from."""
    has_subquery = spark._jvm.org.apache.spark.sql.catalyst.expressions.SubqueryExpression.hasSubquery
    ids = lambda columns: [a.exprId().id() for a in _seq(columns)]
    of = lambda wanted: set().union(*[found.get(i, set()) for i in wanted])
    children, inner = _seq(plan.children()), _seq(plan.subqueries())
    for p in children + inner:
        _lineage(spark, p, found)
    below = [ids(c.output()) for c in children]
    known = set().union(*map(set, below)) if below else set()
    from_inner = of([i for p in inner for i in ids(p.output())])
    expressions = _seq(plan.expressions())
    for e in expressions:
        if e.nodeName() == "Alias":
            known.add(e.exprId().id())
            found.setdefault(e.exprId().id(), set()).update(
                of(ids(e.references().toSeq())) | (from_inner if has_subquery(e) else set()))
    out = ids(plan.output())
    if plan.nodeName() in ("Union", "Intersect", "Intersect All", "Except", "Except All"):
        for at, i in enumerate(out):
            found.setdefault(i, set()).update(of([b[at] for b in below]))
    used = of([i for e in expressions for i in ids(e.references().toSeq())])  # a generator's, a Python function's
    for i, attribute in zip(out, _seq(plan.output())):
        if i not in known:
            found.setdefault(i, set()).update(used)
        own = json.loads(attribute.metadata().json()).get("sensitivity")
        if own:
            found.setdefault(i, set()).add((own.get("label"), own.get("information_type")))


def derived_sensitivity(df: DataFrame, levels: Sequence[str] = LEVELS) -> dict[str, dict]:
    """Label of every column that is computed, in whatever steps, from a labelled one (V7).

    Labels follow the values through renames, expressions, joins, unions,
    aggregates, windows, generators, scalar subqueries and Python functions (whose every output
    has the labels of every input). A column that a row was only filtered,
    joined or grouped by lends its label to nothing but itself. Of several
    labels the highest in ``levels`` counts (one that is not in the list counts
    as highest), and the information types are listed together.
    """
    found: dict[int, set] = {}
    plan = df._jdf.queryExecution().analyzed()
    _lineage(df.sparkSession, plan, found)
    out = {}
    for a in _seq(plan.output()):
        labels = found.get(a.exprId().id())
        if labels:
            level = max((x for x, _ in labels if x), key=lambda x: (levels.index(x) if x in levels else len(levels), x), default=None)
            types = ", ".join(sorted({t for _, labelled in labels if labelled for t in labelled.split(", ")}))
            out[a.name()] = {k: v for k, v in (("label", level), ("information_type", types)) if v}
    return out


def mask_derived(df: DataFrame, least: str = LEVELS[0], levels: Sequence[str] = LEVELS) -> DataFrame:
    """Mask every column that descends from one labelled ``least`` or higher: text as :func:`mask_columns`
    does, other types by null. The result's columns carry their labels."""
    labels = derived_sensitivity(df, levels)
    floor, columns = levels.index(least), []
    for f in df.schema.fields:
        c, label = F.col(f"`{f.name}`"), labels.get(f.name, {}).get("label")
        if f.name in labels and (label not in levels or levels.index(label) >= floor):
            c = F.mask(c) if isinstance(f.dataType, T.StringType) else F.lit(None).cast(f.dataType)
        meta = {**f.metadata, "sensitivity": labels[f.name]} if f.name in labels else f.metadata
        columns.append(c.alias(f.name, metadata=meta))
    return df.select(*columns)


def xml_values(df: DataFrame, xml_col: str, paths: Mapping[str, str]) -> DataFrame:
    """Add one text column per XPath over an XML text column (V5)."""
    out = df
    for name, path in paths.items():
        out = out.withColumn(name, F.xpath_string(F.col(xml_col), F.lit(path)))
    return out


def with_xml(df: DataFrame, xml_col: str, cols: Sequence[str], row_tag: str = "row") -> DataFrame:
    """Add ``xml_col``: the named columns as one XML element (V5); null columns are left out."""
    return df.withColumn(xml_col, F.to_xml(F.struct(*cols), {"rowTag": row_tag}))

"""Feature building (E1-E5, P14, U2): median imputation, population-std scaling,
constant fill + one-hot encoding, assembled into ``label, features``.

``fit`` runs a handful of aggregate jobs (exact medians by distributed
selection, one mean/std pass, one distinct-category pass per column) and keeps
only the resulting constants; ``transform`` is pure column expressions plus the
JVM one-hot encoder, so it stays inside whole-stage codegen.

MLlib's ``Imputer`` gives 2.0 (not 2.5) on {1,2,3,10} and ``StandardScaler``
uses the sample std - hence the own fit.  By default the builder is fitted on
the rows it is given; pass the training split to avoid the reference's
leakage (trap T9), or all rows to reproduce it.
"""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass, field

from pyspark.ml.feature import OneHotEncoder, VectorAssembler
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..session import cut_lineage
from .order import broadcast_if_small, exact_quantiles_by_column, row_index

MISSING = "missing"
# Columns with more categories than this are indexed through a joined table instead of a literal in the plan.
INLINE_CATEGORIES = 1_000


def category_value(c: str) -> Column:
    """Categorical value as text, NULL -> ``'missing'``."""
    return F.coalesce(F.col(c).cast("string"), F.lit(MISSING))


@dataclass
class FeatureModel:
    numeric: list[str]
    categorical: list[str]
    medians: dict[str, float]
    means: dict[str, float]
    scales: dict[str, float]
    categories: dict[str, list[str]] = field(default_factory=dict)
    # columns with many categories: a table ``value, index`` (sorted order) and its number of rows
    tables: dict[str, tuple[DataFrame, int]] = field(default_factory=dict)

    def width(self, c: str) -> int:
        """Number of fitted categories."""
        return self.tables[c][1] if c in self.tables else len(self.categories[c])

    def scaled_columns(self, df: DataFrame) -> list[Column]:
        """E1+E4 per numeric column, named like the input."""
        out = []
        for c in self.numeric:
            x = F.coalesce(F.col(c).cast("double"), F.lit(self.medians[c]))
            out.append(((x - F.lit(self.means[c])) / F.lit(self.scales[c])).alias(c))
        return out

    def category_index(self, c: str) -> Column:
        """Index of the value among the sorted fitted categories; NULL when unseen
        (of a wide column: the index that :meth:`with_indexes` joined)."""
        if c in self.tables:
            return F.col(f"__at_{c}")
        cats = self.categories[c]
        m = F.create_map(*[x for i, v in enumerate(cats) for x in (F.lit(v), F.lit(i))]) if cats else None
        if m is None:
            return F.lit(None).cast("int")
        return m[category_value(c)]

    def with_indexes(self, df: DataFrame) -> DataFrame:
        """``df`` with the index of every wide column: a left join on the value with the fitted table (broadcast only
        behind its counted size; otherwise a shuffled join, whose hot values AQE splits)."""
        for c, (table, n) in self.tables.items():
            small = broadcast_if_small(table.select(F.col("value").alias("__value"), F.col("index").cast("int").alias(f"__at_{c}")), n)
            df = df.join(small, category_value(c) == F.col("__value"), "left").drop("__value")
        return df

    def onehot_block(self, c: str) -> Column:
        """E3 as a dense array over the sorted fitted categories (unseen -> all zeros)."""
        k = self.width(c)
        idx = self.category_index(c)
        return F.transform(F.sequence(F.lit(0), F.lit(k - 1)), lambda i: F.coalesce((idx == i).cast("double"), F.lit(0.0)))

    def _index_with_size(self, c: str) -> Column:
        """Category index as double, unseen -> ``k``, carrying nominal ML
        metadata with ``k`` values, so the encoder knows the width without a
        data pass."""
        k = self.width(c)
        idx = F.coalesce(self.category_index(c).cast("double"), F.lit(float(k)))
        return idx.alias(f"__idx_{c}", metadata={"ml_attr": {"type": "nominal", "num_vals": k, "name": f"__idx_{c}"}})

    def transform(self, df: DataFrame, label: str | None = None, keep: Sequence[str] = (), out: str = "features") -> DataFrame:
        """E5: ``keep..., label, features`` - numeric block then one one-hot block per categorical.

        One-hot blocks come from MLlib's encoder on an index column that
        carries its width as metadata, so they are sparse: a categorical with
        many values does not make every row that wide.
        """
        cats = [c for c in self.categorical if self.width(c)]
        df = self.with_indexes(df)
        base = df.select(
            *keep,
            *([F.col(label).cast("double").alias("label")] if label else []),
            *self.scaled_columns(df),
            *[self._index_with_size(c) for c in cats],
        )
        inputs = list(self.numeric)
        if cats:
            enc = OneHotEncoder(
                inputCols=[f"__idx_{c}" for c in cats],
                outputCols=[f"__oh_{c}" for c in cats],
                dropLast=True,  # drops the extra "unseen" slot: unseen -> all zeros
                handleInvalid="keep",
            ).fit(base)
            base = enc.transform(base)
            inputs += [f"__oh_{c}" for c in cats]
        assembled = VectorAssembler(inputCols=inputs, outputCol=out, handleInvalid="keep").transform(base)
        return assembled.select(*keep, *(["label"] if label else []), out)

    @property
    def n_features(self) -> int:
        return len(self.numeric) + sum(self.width(c) for c in self.categorical)


class FeatureBuilder:
    """``FeatureBuilder(numeric, categorical).fit(df).transform(df, label)``."""

    def __init__(self, numeric: Sequence[str], categorical: Sequence[str] = (), inline: int = INLINE_CATEGORIES):
        self.inline = inline
        self.numeric = list(numeric)
        self.categorical = list(categorical)

    def fit(self, df: DataFrame) -> FeatureModel:
        """Fit constants from a few aggregate jobs over the (persisted) input:
        all medians share one unpivoted plan, mean/std are one pass, all
        category lists one distinct pass."""
        level = df.storageLevel
        owned = not (level.useMemory or level.useDisk)  # release only a cache this fit created
        if owned:
            df = df.persist()
        meds = exact_quantiles_by_column(df, self.numeric, [0.5], interpolate=True)
        medians = {c: float(meds[c][0]) if meds[c][0] is not None else 0.0 for c in self.numeric}
        imputed = [F.coalesce(F.col(c).cast("double"), F.lit(medians[c])) for c in self.numeric]
        row = None
        if imputed:
            row = df.agg(
                *[F.avg(x).alias(f"m{i}") for i, x in enumerate(imputed)],
                *[F.stddev_pop(x).alias(f"s{i}") for i, x in enumerate(imputed)],
            ).first()
        means, scales = {}, {}
        for i, c in enumerate(self.numeric):
            means[c] = float(row[f"m{i}"] or 0.0)
            s = row[f"s{i}"]
            # zero-variance column keeps scale 1 (as sklearn's StandardScaler)
            scales[c] = float(s) if s not in (None, 0.0) and s > 1e-300 else 1.0
        cats: dict[str, list[str]] = {c: [] for c in self.categorical}
        tables: dict[str, tuple[DataFrame, int]] = {}
        if self.categorical:
            pairs = F.explode(F.array(*[
                F.struct(F.lit(c).alias("c"), category_value(c).alias("v")) for c in self.categorical
            ]))
            distinct = cut_lineage(df.select(pairs.alias("p")).select("p.c", "p.v").distinct())
            sizes = {r["c"]: r["n"] for r in distinct.groupBy("c").agg(F.count(F.lit(1)).alias("n")).collect()}
            few = [c for c, n in sizes.items() if n <= self.inline]
            for r in distinct.where(F.col("c").isin(few)).collect():  # counted: at most ``inline`` values per column
                cats[r["c"]].append(r["v"])
            cats = {c: sorted(v) for c, v in cats.items()}
            for c, n in sizes.items():
                if c not in few:
                    values = distinct.where(F.col("c") == c).select(F.col("v").alias("value"))
                    tables[c] = cut_lineage(row_index(values, ["value"])), int(n)
        if owned:
            df.unpersist()
        return FeatureModel(self.numeric, self.categorical, medians, means, scales, cats, tables)

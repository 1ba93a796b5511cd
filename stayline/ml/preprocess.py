"""Fitted preprocessing: statistics come from the rows given to ``fit`` only."""

from __future__ import annotations

from pyspark.ml import Estimator, Model
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from stayline.functions.columns import flag
from stayline.ml.params import Configured
from stayline.operators import missing, outliers
from stayline.operators.quantiles import column_quantiles
from stayline.sources.schema import date_columns, numeric_columns, text_columns

MAX_CATEGORIES = 1_000


class OutlierHandler(Configured, Estimator):
    """Learn voting bounds; the model turns outlying cells into nulls."""

    OPTIONS = {
        "columns": None,
        "exclude": [],
        "methods": ["iqr", "mod_z"],
        "minVotes": 2,
        "iqrK": 1.5,
        "zLimit": 3.5,
        "skipDiscrete": True,
        "discreteLimit": 10,
    }

    def _fit(self, dataset: DataFrame) -> OutlierModel:
        columns = outliers.candidate_columns(dataset, self.value("columns"), self.value("exclude"))
        bounds = outliers.voting_bounds(
            dataset, columns, tuple(self.value("methods")), self.value("iqrK"), self.value("zLimit"),
            self.value("skipDiscrete"), self.value("discreteLimit"),
        )
        plain = {c: {m: [b.lower, b.upper] for m, b in by.items()} for c, by in bounds.items()}
        return OutlierModel(bounds=plain, minVotes=self.value("minVotes"))


class OutlierModel(Configured, Model):
    OPTIONS = {"bounds": {}, "minVotes": 2}

    @property
    def bounds_(self) -> dict[str, dict[str, outliers.Bounds]]:
        return {c: {m: outliers.Bounds(*v) for m, v in by.items()} for c, by in self.value("bounds").items()}

    def _transform(self, dataset: DataFrame) -> DataFrame:
        return outliers.blank_outliers(dataset, self.bounds_, self.value("minVotes"))

    def report(self, dataset: DataFrame) -> DataFrame:
        return outliers.voting_report(dataset, self.bounds_, self.value("minVotes"))

    def bounds_table(self, spark) -> DataFrame:
        rows = [
            (c, *by.get("iqr", (None, None)), *by.get("mod_z", (None, None)))
            for c, by in self.value("bounds").items()
        ]
        return spark.createDataFrame(
            rows, "column string, iqr_lower double, iqr_upper double, mod_z_lower double, mod_z_upper double"
        )


class ClientImputer(Configured, Estimator):
    """Learn mean or median of numeric columns; text gets a placeholder.

    Date columns are filled along an explicit row order, which must be given
    when the table has date columns with nulls.
    """

    OPTIONS = {
        "strategy": "median",
        "placeholder": missing.UNKNOWN,
        "keep": [],
        "dateDirection": "ffill",
        "datePartition": [],
        "dateOrder": [],
        "check": True,
    }

    def _fit(self, dataset: DataFrame) -> ImputerModel:
        strategy = self.value("strategy")
        numbers = numeric_columns(dataset, tuple(self.value("keep")))
        if strategy == "median":
            fills = column_quantiles(dataset, {c: (c, 0.5) for c in numbers})
        elif strategy == "mean":
            fills = dataset.agg(*[F.avg(c).alias(c) for c in numbers]).first().asDict() if numbers else {}
        else:
            raise ValueError(f"unknown strategy {strategy!r}; use 'mean' or 'median'")
        return ImputerModel(
            fills={c: v for c, v in fills.items() if v is not None},
            textColumns=text_columns(dataset, tuple(self.value("keep"))),
            dateColumns=[c for c in date_columns(dataset) if c not in self.value("dateOrder")],
            **{k: self.value(k) for k in ("placeholder", "keep", "dateDirection", "datePartition", "dateOrder", "check")},
        )


class ImputerModel(Configured, Model):
    OPTIONS = {
        "fills": {},
        "textColumns": [],
        "dateColumns": [],
        "placeholder": missing.UNKNOWN,
        "keep": [],
        "dateDirection": "ffill",
        "datePartition": [],
        "dateOrder": [],
        "check": True,
    }

    def _transform(self, dataset: DataFrame) -> DataFrame:
        filled = {
            c: F.coalesce(F.col(c).cast("double"), F.lit(float(v)))
            for c, v in self.value("fills").items()
            if c in dataset.columns
        }
        filled |= {
            c: F.coalesce(F.col(c), F.lit(self.value("placeholder")))
            for c in self.value("textColumns")
            if c in dataset.columns
        }
        out = dataset.withColumns(filled)
        dates = [c for c in self.value("dateColumns") if c in dataset.columns]
        if dates and self.value("dateOrder"):
            out = missing.directional_fill(
                out, dates, self.value("datePartition"), self.value("dateOrder"), self.value("dateDirection")
            )
        if self.value("check"):
            # columns that cannot be null are known from the schema and need no pass
            open_columns = [f.name for f in out.schema.fields if f.nullable and f.name not in self.value("keep")]
            if open_columns:
                missing.require_complete(out, open_columns)
        return out


class OneHotEncoder(Configured, Estimator):
    """Learn the values of categorical columns; the model adds one 0/1 column per value.

    Unseen values give zeros everywhere, as does null. The number of values per
    column is checked before they are collected.
    """

    OPTIONS = {"columns": ["sdem_SITFAM", "sdem_HABITAT"], "dropFirst": False, "maxCategories": MAX_CATEGORIES}

    def _fit(self, dataset: DataFrame) -> OneHotModel:
        columns = [c for c in self.value("columns") if c in dataset.columns]
        limit = self.value("maxCategories")
        entries = F.array(*[F.struct(F.lit(c).alias("c"), F.col(c).cast("string").alias("v")) for c in columns])
        values: dict[str, list] = {c: [] for c in columns}
        if columns:
            found = (
                dataset.select(F.explode(entries).alias("x")).select("x.*").na.drop().distinct()
                .limit(limit * len(columns) + 1).collect()
            )
            for r in found:
                values[r["c"]].append(r["v"])
        wide = [c for c, v in values.items() if len(v) > limit]
        if wide or sum(map(len, values.values())) > limit * max(len(columns), 1):
            raise ValueError(f"more than {limit} categories in {wide or columns}")
        kinds = dict(dataset.dtypes)
        ordered = {
            c: sorted(v, key=float if kinds[c] not in ("string",) else str) for c, v in values.items()
        }
        if self.value("dropFirst"):
            ordered = {c: v[1:] for c, v in ordered.items()}
        return OneHotModel(categories=ordered)


class OneHotModel(Configured, Model):
    OPTIONS = {"categories": {}}

    @property
    def output_columns(self) -> list[str]:
        return [f"{c}_{v}" for c, values in self.value("categories").items() for v in values]

    def _transform(self, dataset: DataFrame) -> DataFrame:
        dummies = []
        for c, values in self.value("categories").items():
            source = F.col(c).cast("string") if c in dataset.columns else F.lit(None).cast("string")
            dummies += [flag(source == v).alias(f"{c}_{v}") for v in values]
        encoded = set(self.value("categories"))
        return dataset.select(*[c for c in dataset.columns if c not in encoded], *dummies)


class QuartileScaler(Configured, Estimator):
    """Centre on the median and divide by the quartile range; nulls stay, a zero range divides by 1."""

    OPTIONS = {"columns": None, "exclude": []}

    def _fit(self, dataset: DataFrame) -> QuartileScalerModel:
        chosen = self.value("columns")
        columns = numeric_columns(dataset) if chosen is None else [c for c in chosen if c in dataset.columns]
        columns = [c for c in columns if c not in self.value("exclude")]
        spread = outliers.quartiles(dataset, columns)
        return QuartileScalerModel(stats={c: [m, (q3 - q1) or 1.0] for c, (q1, m, q3) in spread.items()})


class QuartileScalerModel(Configured, Model):
    OPTIONS = {"stats": {}}

    def _transform(self, dataset: DataFrame) -> DataFrame:
        return dataset.withColumns(
            {
                c: (F.col(c).cast("double") - F.lit(m)) / F.lit(s)
                for c, (m, s) in self.value("stats").items()
                if c in dataset.columns
            }
        )

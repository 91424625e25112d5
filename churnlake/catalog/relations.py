"""The tables the registered queries start from, as lazy DataFrames over one scale-factor folder."""

from __future__ import annotations

from collections.abc import Callable
from functools import cached_property

from pyspark.sql import DataFrame, SparkSession

from churnlake.operators import cleaning, encoding, features, scoring, splitting
from churnlake.session import scratch_path
from churnlake.sources.sinks import write_table
from churnlake.sources.tables import customers_from_orders
from churnlake.spec import TELCO

# Three logistic scorers with given coefficients over encoded features: stand-ins for fitted models, so that
# everything after the probability can be compared with SQL value by value.
SCORERS: dict[str, tuple[float, dict[str, float]]] = {
    "alpha": (0.35, {
        "tenure": -0.045, "MonthlyCharges": 0.006, "ContractRisk": 0.3, "ServiceCount": -0.1,
        "IsNewCustomer": 0.6, "PaperlessBilling": 0.2, "PaymentMethod_Electronic check": 0.15}),
    "beta": (-0.8, {
        "tenure": -0.02, "MonthlyCharges": 0.012, "Contract": -0.4, "InternetService": 0.25,
        "SeniorCitizenLabel": 0.3, "OnlineSecurity_Yes": -0.35}),
    "gamma": (0.1, {
        "TenureGroup_num": -0.5, "ChargesBand_num": 0.2, "HasNoAddOns": 0.3, "Partner": -0.1, "Dependents": -0.15}),
}
SCORE_DIGITS = 6


class Tables:
    """Raw, clean, feature, encoded, split, scored and prediction tables of one folder."""

    def __init__(self, spark: SparkSession, directory: str, staged: bool | tuple[str, ...] = False):
        self.spark, self.directory, self.staged = spark, directory, staged

    @cached_property
    def raw(self) -> DataFrame:
        return customers_from_orders(self.spark, self.directory)

    @cached_property
    def clean(self) -> DataFrame:
        """The clean table. Queries that pass over it more than once write what they need of it first and read
        that, so that the join and the de-duplication behind it run once."""
        cleaned = cleaning.clean(self.raw)
        if not self.staged:
            return cleaned
        if self.staged is not True:
            cleaned = cleaned.select(*self.staged)
        path = scratch_path(self.spark, "clean")
        write_table(cleaned, path)
        return self.spark.read.schema(cleaned.schema).parquet(path)

    @cached_property
    def features(self) -> DataFrame:
        return features.add_business_features(self.clean)

    @cached_property
    def levels(self) -> encoding.Levels:
        return encoding.learn_levels(self.clean, TELCO.nominal)

    @cached_property
    def encoded(self) -> DataFrame:
        return encoding.encode(self.features, self.levels)

    @cached_property
    def ml(self) -> DataFrame:
        """Feature table with the key and the target kept."""
        return encoding.drop_non_features(self.encoded, keep=(TELCO.key,))

    @cached_property
    def feature_names(self) -> list[str]:
        return [c for c in self.ml.columns if c not in (TELCO.key, TELCO.target)]

    @cached_property
    def split(self) -> DataFrame:
        return splitting.split_and_fold(self.ml)

    def carried(self, *names: str, clean: DataFrame | None = None) -> DataFrame:
        """Encoded inputs of the named scorers, with the readable columns of the same customer in one struct."""
        clean = self.clean if clean is None else clean
        original = clean.selectExpr("*", f"struct({', '.join(clean.columns)}) AS original")
        inputs = [c for n in names for c in SCORERS[n][1]]
        return encoding.encode_saved(features.add_business_features(original), list(dict.fromkeys(inputs)))

    def score(self, clean: DataFrame) -> DataFrame:
        """Any clean table, a stream too, with ``p``."""
        return self.scored_by("alpha", clean)

    def scored_by(self, name: str, clean: DataFrame | None = None) -> DataFrame:
        intercept, weights = SCORERS[name]
        return self.carried(name, clean=clean).selectExpr("original.*", f"{scoring.logistic_score(weights, intercept, SCORE_DIGITS)} AS p")

    @cached_property
    def scored(self) -> DataFrame:
        return self.scored_by("alpha")

    @cached_property
    def scored_by_model(self) -> DataFrame:
        """(model, customerID, Churn, p) of all scorers from one scan."""
        structs = ", ".join(
            f"named_struct('model', '{n}', 'p', {scoring.logistic_score(w, b, SCORE_DIGITS)})"
            for n, (b, w) in SCORERS.items())
        return self.carried(*SCORERS).selectExpr("customerID", "Churn", f"inline(array({structs}))")

    @cached_property
    def predictions(self) -> DataFrame:
        return scoring.build_predictions(self.scored)


QueryFn = Callable[[SparkSession, str], DataFrame]
QUERIES: dict[str, QueryFn] = {}
ORACLES: dict[str, str] = {}


def query(name: str, sql: str | None = None, staged: bool | tuple[str, ...] = False):
    """Register ``fn(tables) -> DataFrame`` under ``name``, with the SQL it must agree with.

    ``staged`` is for operators with several passes: they start from a written clean table, or from the named
    columns of it.
    """
    def register(fn: Callable[[Tables], DataFrame]):
        if name in QUERIES:
            raise ValueError(f"query {name} registered twice")

        def run(spark: SparkSession, directory: str) -> DataFrame:
            return fn(Tables(spark, directory, staged))

        run.__name__ = name
        run.__doc__ = fn.__doc__
        QUERIES[name] = run
        if sql is not None:
            ORACLES[name] = sql
        return fn

    return register


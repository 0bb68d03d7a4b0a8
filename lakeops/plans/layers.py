"""The layers as plans, and a per-application set of written layers."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from lakeops.constants import ID
from lakeops.operators.clean import silver_rows
from lakeops.operators.dedupe import dedupe_latest
from lakeops.operators.dims import build_date_dim, build_dim
from lakeops.operators.features import feature_table
from lakeops.operators.star import build_fact, denormalise
from lakeops.plans.fixtures import TIE_BREAKS, complaints_raw
from lakeops.sources.staging import split_at, stage

#: Bytes of a raw file that a task reads at once to deduplicate: text columns grow over tenfold from the file to the sorted rows, which must fit a task's memory.
SORTED_AT_ONCE = "16m"

DIM_COLUMNS = {"product": ("product", "sub_product"), "company": ("company",), "state": ("state",)}


def silver_layer(raw: DataFrame, tie_breaks: tuple[str, ...] = ()) -> DataFrame:
    """Clean, typed rows, the latest one per id; written, by tasks small enough to sort their rows in memory."""
    with split_at(raw.sparkSession, SORTED_AT_ONCE):
        return stage(dedupe_latest(silver_rows(raw), [ID], ["_ingested_at", "_ingestion_date", *tie_breaks]), "silver")


def dimensions(silver: DataFrame) -> dict[str, DataFrame]:
    dims = {name: build_dim(silver, cols, f"{name}_key") for name, cols in DIM_COLUMNS.items()}
    return {"date": build_date_dim(silver), **dims}


class Layers:
    """The layers of one input directory, each written once per application and then read.

    The same chain the jobs run: raw -> clean -> dimensions and fact -> features. A layer is
    built when first asked for; later readers get the written table with its statistics.
    """

    def __init__(self, spark: SparkSession, sf_dir: str) -> None:
        self.spark, self.sf_dir = spark, sf_dir
        self._written: dict[str, DataFrame] = {}
        self._kept: dict[str, object] = {}

    def keep(self, name: str, build: Callable[[], object]) -> object:
        """A result that several plans share, such as fitted models."""
        if name not in self._kept:
            self._kept[name] = build()
        return self._kept[name]

    def _once(self, name: str, build: Callable[[], DataFrame]) -> DataFrame:
        if name not in self._written:
            self._written[name] = stage(build(), name)
        return self._written[name]

    @property
    def bronze(self) -> DataFrame:
        return self._once("bronze", lambda: complaints_raw(self.spark, self.sf_dir))

    @property
    def raw(self) -> DataFrame:
        """The raw rows for a plan that passes over them once: the written layer if there is one, else the plan that would write it."""
        return self._written["bronze"] if "bronze" in self._written else complaints_raw(self.spark, self.sf_dir)

    @property
    def silver(self) -> DataFrame:
        return self.keep("silver", lambda: silver_layer(self.bronze, TIE_BREAKS))

    def dim(self, name: str) -> DataFrame:
        if name == "date":
            return self._once("dim_date", lambda: build_date_dim(self.silver))
        return self._once(
            f"dim_{name}", lambda: build_dim(self.silver, DIM_COLUMNS[name], f"{name}_key")
        )

    @property
    def dims(self) -> dict[str, DataFrame]:
        return {n: self.dim(n) for n in ("date", "product", "company", "state")}

    @property
    def fact(self) -> DataFrame:
        return self._once("fact", lambda: build_fact(self.silver, self.dims))

    @property
    def base(self) -> DataFrame:
        return denormalise(self.fact, self.dims)

    def features(self, method: str = "xxhash64") -> DataFrame:
        return self._once(f"features_{method}", lambda: feature_table(self.base, method))


_open: dict[tuple[str, str], Layers] = {}


def layers(spark: SparkSession, sf_dir: str) -> Layers:
    """The layers of ``sf_dir`` in this application."""
    key = (spark.sparkContext.applicationId, sf_dir)
    if key not in _open:
        _open[key] = Layers(spark, sf_dir)
    return _open[key]

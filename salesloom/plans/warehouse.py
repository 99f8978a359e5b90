"""The load: staging, dimensions, fact and views, each written once and then read."""

from __future__ import annotations

from collections.abc import Callable, Iterator, Mapping

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from salesloom.operators import hierarchy as H
from salesloom.operators.cleaning import clean
from salesloom.plans import views as V
from salesloom.schemas import SUMMARY_KEYS, TABLES
from salesloom.sources.storage import compiled_methods, materialize, pass_on, passing_tables
from salesloom.sources.testdata import raw_sales, staging_sales

# A filter on the year then skips the files of all other years, whatever joins the load needed.
PARTITIONED = {"vw_sales_full": ["order_year"]}

# A calendar too short for the supplied tables: a planted fault that the load reports must show.
SHORT_CALENDAR = ("1996-01-01", "2000-12-31")


class Warehouse(Mapping[str, DataFrame]):
    """Named tables, built on first use in dependency order.

    ``staging`` is any DataFrame with the staging columns. Each table is written
    to the shared folder, so a later reader starts from its files: it needs only
    the columns it names, and no lost executor can force the load to run again.

    ``calendar`` names the first and last day of the calendar; orders outside it
    stay in staging only. By default it spans all order and ship dates.
    """

    def __init__(
        self,
        spark: SparkSession,
        staging: Callable[[], DataFrame],
        calendar: tuple[str, str] | None = None,
        raw: Callable[[], DataFrame] | None = None,
    ) -> None:
        self.spark = spark
        compiled_methods(spark)
        self._calendar = calendar
        self._ready: dict[str, DataFrame] = {}
        self._builders: dict[str, Callable[[], DataFrame]] = {
            "staging_sales": staging,
            "geography_keys": self._geography_keys,
            "product_paths": self._product_paths,
            "category_keys": self._category_keys,
            "dim_date": lambda: H.calendar(H.date_series(spark, *self.calendar)),
            "dim_customer": lambda: H.members(
                self["staging_sales"], ["customer_name", "segment"], "customer_id"
            ),
            "dim_market": lambda: H.level_table(self["geography_keys"], "market"),
            "dim_region": lambda: H.level_table(self["geography_keys"], "region", "market"),
            "dim_country": lambda: H.level_table(self["geography_keys"], "country", "region"),
            "dim_state": lambda: H.level_table(self["geography_keys"], "state", "country"),
            "dim_category": lambda: H.level_table(self["category_keys"], "category"),
            "dim_sub_category": lambda: H.level_table(
                self["category_keys"], "sub_category", "category"
            ),
            "dim_product": self._dim_product,
            "flat_geography": lambda: V.join_geography(self),
            "flat_product": lambda: V.join_products(self),
            "fact_sales": self._fact_sales,
            "vw_sales_full": lambda: V.sales_full(self),
            # Where the rows of the view are written already, nothing is joined again.
            "vw_sales_summary": lambda: V.sales_summary(self, view=self._ready.get("vw_sales_full")),
            "summary_sketches": lambda: V.sales_summary(self, with_sketch=True).select(
                *SUMMARY_KEYS, "order_sketch"
            ),
        }
        if raw is not None:
            self._builders["raw_sales"] = raw
            self._builders["clean_sales"] = lambda: clean(self["raw_sales"])

    @property
    def calendar(self) -> tuple[str, str]:
        """First and last day; found in the staging rows once where none were given."""
        if self._calendar is None:
            days = ["order_date", "ship_date"]
            ends = self["staging_sales"].agg(
                F.least(*[F.min(c) for c in days]).cast("string").alias("first"),
                F.greatest(*[F.max(c) for c in days]).cast("string").alias("last"),
            ).first()
            self._calendar = (ends["first"], ends["last"])
        return self._calendar

    def with_calendar(self, first: str, last: str) -> Warehouse:
        """The same load under another calendar; staging and the other dimensions are shared."""
        other = Warehouse(self.spark, lambda: self["staging_sales"], (first, last))
        dated = {"dim_date", "fact_sales", "vw_sales_full", "vw_sales_summary", "summary_sketches"}
        for name in other._builders.keys() - dated:
            other._ready[name] = self[name]
        return other

    def __getitem__(self, name: str) -> DataFrame:
        if name not in self._ready:
            with passing_tables(self.spark):
                built = self._builders[name]()
                if name in TABLES:
                    built = built.select(TABLES[name].names)
                self._ready[name] = materialize(built, name, PARTITIONED.get(name, ()))
        return self._ready[name]

    def __contains__(self, name: object) -> bool:
        return name in self._builders

    def __iter__(self) -> Iterator[str]:
        return iter(self._builders)

    def __len__(self) -> int:
        return len(self._builders)

    def _geography_keys(self) -> DataFrame:
        paths = self["staging_sales"].select(V.GEOGRAPHY).na.drop().distinct()
        return H.keyed_hierarchy(pass_on(paths, "geography_paths"), V.GEOGRAPHY)

    def _product_paths(self) -> DataFrame:
        columns = ["product_id", "product_name", "category", "sub_category"]
        return self["staging_sales"].select(columns).na.drop().distinct()

    def _category_keys(self) -> DataFrame:
        paths = self["product_paths"].select("category", "sub_category").distinct()
        return H.keyed_hierarchy(
            pass_on(paths, "category_paths"), ["category", "sub_category"]
        )

    def _dim_product(self) -> DataFrame:
        natural = ["raw_product_id", "product_name"]
        chosen = H.first_product(self["product_paths"]).withColumnRenamed(
            "product_id", "raw_product_id"
        )
        parents = self["category_keys"].select("category", "sub_category", "sub_category_id")
        return H.number_rows(chosen.join(parents, ["category", "sub_category"]), natural, "product_id")

    def _fact_sales(self) -> DataFrame:
        return V.key_fact(V.load_fact(self["staging_sales"], self, *self.calendar))


_open: dict[tuple[str, str], Warehouse] = {}


def warehouse(spark: SparkSession, sf_dir: str) -> Warehouse:
    """The warehouse of one folder of test tables, shared by all queries of the application."""
    key = (spark.sparkContext.applicationId, sf_dir)
    if key not in _open:
        _open[key] = Warehouse(
            spark,
            lambda: staging_sales(spark, sf_dir),
            raw=lambda: raw_sales(spark, sf_dir),
        )
    return _open[key]


def short_warehouse(spark: SparkSession, sf_dir: str) -> Warehouse:
    """The same load under ``SHORT_CALENDAR``, so that a part of the orders is missing downstream."""
    key = (spark.sparkContext.applicationId, f"{sf_dir}#short")
    if key not in _open:
        _open[key] = warehouse(spark, sf_dir).with_calendar(*SHORT_CALENDAR)
    return _open[key]

"""Layer tables over the given tables, each built when it is first asked for."""

from __future__ import annotations

from collections.abc import Callable, Iterator, Mapping

from pyspark.sql import DataFrame, SparkSession

from suite import feed
from tallyhouse import schemas
from tallyhouse import settings as S
from tallyhouse.operators import cleansing, star

# Spend in the given tables is far above the default thresholds; these make it decide as well.
SCALED_RFM = S.RfmThresholds(
    champion_spend=2_500_000, loyal_spend=2_000_000, potential_spend=1_500_000, risk_spend=1_000_000
)
_ORDERS = {
    "silver_sales": feed.SALES_ORDER,
    "silver_customers": feed.CUSTOMER_ORDER,
    "silver_products": feed.PRODUCT_ORDER,
    "silver_stores": feed.STORE_ORDER,
    "silver_inventory": feed.INVENTORY_ORDER,
}


class Layers(Mapping[str, DataFrame]):
    """Name -> frame for all bronze, silver and gold tables."""

    def __init__(self, spark: SparkSession, sf_dir: str):
        self._built: dict[str, DataFrame] = {}
        self._builders: dict[str, Callable[[], DataFrame]] = {}
        for name, build in feed.BUILDERS.items():
            self._builders[name] = lambda build=build: build(spark, sf_dir)
        for name, (source, clean) in cleansing.SILVER_BUILDERS.items():
            self._builders[name] = lambda n=name, s=source, c=clean: c(self[s], _ORDERS[n])
        self._builders["silver_sales"] = lambda: cleansing.silver_sales(feed.sales_by_key(spark, sf_dir), feed.SALES_ORDER)
        for name, build in star.GOLD_BUILDERS.items():
            self._builders[name] = lambda build=build: build(self, SCALED_RFM)

    def __getitem__(self, name: str) -> DataFrame:
        if name not in self._built:
            self._built[name] = self._builders[name]()
        return self._built[name]

    def __iter__(self) -> Iterator[str]:
        return iter(self._builders)

    def __len__(self) -> int:
        return len(self._builders)

    def only(self, names: tuple[str, ...]) -> dict[str, DataFrame]:
        return {n: self[n] for n in names}


def silver(spark: SparkSession, sf_dir: str) -> dict[str, DataFrame]:
    return Layers(spark, sf_dir).only(schemas.SILVER_TABLES)

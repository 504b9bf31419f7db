"""Raw feeds -> cleansed tables -> star schema, as one composition of frames.

``Medallion`` wires the operators together and builds a table when it is first
asked for; only dense keys and kept tables run jobs then.  ``run_pipeline``
writes each layer and goes on from the written copy, so a table is computed
once however many tables are built from it.
"""

from __future__ import annotations

from collections.abc import Callable, Mapping
from concurrent.futures import ThreadPoolExecutor
from functools import cached_property, partial
from threading import RLock

from pyspark.sql import DataFrame

from tradewind import fixed_values as fixed
from tradewind.operators import gold, silver, staging


class _table(cached_property):  # noqa: N801 - used as a decorator
    """A table built once per ``Medallion``, also when several threads ask for it."""

    def __get__(self, instance, owner=None):
        if instance is None:
            return self
        with instance._locks[self.attrname]:
            return super().__get__(instance, owner)


class _Unkept:
    """A ``Medallion`` that does not keep the table of the star schema built through it, but all that this is built from."""

    def __init__(self, model: Medallion):
        self._model = model

    def __getattr__(self, name: str):
        return getattr(self._model, name)

    def _star(self, frame: DataFrame, label: str) -> DataFrame:
        return frame


class Medallion:
    """Every table of the model over a mapping of raw feeds.

    ``raw`` maps feed names (``raw_orders``) to frames or to functions giving
    them.  ``strict_raw`` holds the feeds of the staged path, which stops at
    text it cannot cast; by default the same feeds.  ``keep`` is applied to
    each cleansed table, ``keep_star`` to each dimension and fact, for instance to
    write it and go on from the copy where several plans read it.
    """

    def __init__(
        self,
        raw: Mapping[str, DataFrame | Callable[[], DataFrame]],
        strict_raw: Mapping[str, DataFrame | Callable[[], DataFrame]] | None = None,
        arrival: str | None = silver.ARRIVAL,
        missing_date_key: int | None = fixed.MISSING_DATE_KEY,
        keep: Callable[[DataFrame, str], DataFrame] | None = None,
        keep_star: Callable[[DataFrame, str], DataFrame] | None = None,
    ):
        self._raw, self._strict = raw, strict_raw or raw
        self.arrival, self.missing_date_key = arrival, missing_date_key
        self._keep = keep or (lambda frame, label: frame)
        self._star = keep_star or (lambda frame, label: frame)
        self._locks = {name: RLock() for name, kind in vars(Medallion).items() if isinstance(kind, _table)}

    @staticmethod
    def _feed(feeds, name: str) -> DataFrame:
        feed = feeds[name]
        return feed() if callable(feed) else feed

    def prefetch(self, *names: str) -> None:
        """Build several tables side by side; those that run jobs share the cluster."""
        with ThreadPoolExecutor(max(1, len(names))) as pool:
            list(pool.map(partial(getattr, self), names))

    def read_once(self, name: str) -> DataFrame:
        """A table for a plan that reads it in one place: not written for that alone, so only the columns read are computed."""
        return vars(self)[name] if name in vars(self) else vars(Medallion)[name].func(_Unkept(self))

    def raw(self, name: str) -> DataFrame:
        return self._feed(self._raw, name)

    def strict(self, name: str) -> DataFrame:
        return self._feed(self._strict, name)

    # Cleansed tables.

    @_table
    def suppliers(self) -> DataFrame:
        return self._keep(silver.silver_suppliers(self.raw("raw_suppliers"), self.arrival), "suppliers")

    @_table
    def warehouses(self) -> DataFrame:
        return self._keep(silver.silver_warehouses(self.raw("raw_warehouses"), self.arrival), "warehouses")

    @_table
    def products(self) -> DataFrame:
        return self._keep(silver.silver_products(self.raw("raw_products"), self.arrival), "products")

    @_table
    def customers(self) -> DataFrame:
        return self._keep(silver.silver_customers(self.raw("raw_customers"), self.arrival), "customers")

    @_table
    def orders(self) -> DataFrame:
        return self._keep(silver.silver_orders(self.raw("raw_orders"), self.arrival), "orders")

    @_table
    def shipments(self) -> DataFrame:
        return self._keep(silver.silver_shipments(self.raw("raw_shipments"), self.arrival), "shipments")

    @_table
    def inventory(self) -> DataFrame:
        return self._keep(silver.silver_inventory(self.raw("raw_inventory"), self.arrival), "inventory")

    @_table
    def iot_sensors(self) -> DataFrame:
        return self._keep(silver.silver_iot(self.raw("raw_iot_sensors"), self.arrival), "iot-sensors")

    # Staged tables.

    @_table
    def stg_suppliers(self) -> DataFrame:
        return staging.stg_suppliers(self.strict("raw_suppliers"))

    @_table
    def stg_products(self) -> DataFrame:
        return staging.stg_products(self.strict("raw_products"))

    @_table
    def stg_warehouses(self) -> DataFrame:
        return staging.stg_warehouses(self.strict("raw_warehouses"))

    @_table
    def stg_customers(self) -> DataFrame:
        return staging.stg_customers(self.strict("raw_customers"))

    @_table
    def stg_orders(self) -> DataFrame:
        return staging.stg_orders(self.strict("raw_orders"))

    @_table
    def stg_shipments(self) -> DataFrame:
        return staging.stg_shipments(self.strict("raw_shipments"))

    @_table
    def stg_inventory(self) -> DataFrame:
        return staging.stg_inventory(self.strict("raw_inventory"))

    # Star schema.

    @_table
    def dim_date(self) -> DataFrame:
        """Calendar over all dates of the facts."""
        tables = {"orders": self.orders, "shipments": self.shipments, "inventory": self.stg_inventory}
        spans = [(tables[name], columns) for name, columns in gold.FACT_MOMENTS.items()]
        return self._star(gold.dim_date_covering(*spans, missing_date_key=self.missing_date_key), "dim-date")

    @_table
    def dim_supplier(self) -> DataFrame:
        return self._star(gold.dim_supplier(self.suppliers), "dim-supplier")

    @_table
    def dim_product(self) -> DataFrame:
        return self._star(gold.dim_product(self.products), "dim-product")

    @_table
    def dim_warehouse(self) -> DataFrame:
        return self._star(gold.dim_warehouse(self.warehouses), "dim-warehouse")

    @_table
    def dim_customer(self) -> DataFrame:
        return self._star(gold.dim_customer(self.customers), "dim-customer")

    @_table
    def dim_region(self) -> DataFrame:
        return self._star(gold.dim_region(self.customers, self.suppliers), "dim-region")

    @_table
    def dim_product_dbt(self) -> DataFrame:
        return self._star(gold.dim_product(self.stg_products), "dim-product-dbt")

    @_table
    def dim_supplier_dbt(self) -> DataFrame:
        return self._star(gold.dim_supplier(self.stg_suppliers), "dim-supplier-dbt")

    @_table
    def dim_warehouse_dbt(self) -> DataFrame:
        return self._star(gold.dim_warehouse(self.stg_warehouses), "dim-warehouse-dbt")

    @_table
    def fact_orders(self) -> DataFrame:
        self.prefetch("dim_supplier", "dim_product", "dim_customer")
        dims = (self.dim_supplier, self.dim_product, self.dim_customer)
        return self._star(gold.fact_orders(self.orders, *dims, missing_date_key=self.missing_date_key), "fact-orders")

    @_table
    def fact_orders_dbt(self) -> DataFrame:
        return self._star(gold.fact_orders_dbt(self.stg_orders, self.stg_suppliers), "fact-orders-dbt")

    @_table
    def temp_breach_counts(self) -> DataFrame:
        return self._star(gold.temp_breach_counts(self.iot_sensors), "temp-breach-counts")

    @_table
    def fact_shipments(self) -> DataFrame:
        return self._star(gold.fact_shipments(self.shipments, self.dim_warehouse, self.temp_breach_counts, self.missing_date_key), "fact-shipments")

    @_table
    def fact_shipments_dbt(self) -> DataFrame:
        return self._star(gold.fact_shipments_dbt(self.stg_shipments, self.dim_warehouse_dbt), "fact-shipments-dbt")

    @_table
    def fact_inventory(self) -> DataFrame:
        return self._star(gold.fact_inventory(self.stg_inventory, self.dim_warehouse_dbt, self.dim_product_dbt), "fact-inventory")

    @_table
    def fact_deliveries(self) -> DataFrame:
        self.prefetch("dim_customer", "dim_supplier")
        dims = (self.dim_customer, self.dim_supplier, self.dim_warehouse)
        return self._star(gold.fact_deliveries(self.shipments, self.orders, *dims), "fact-deliveries")

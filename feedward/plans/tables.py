"""All tables of the pipeline by name, planned only when asked for."""

from __future__ import annotations

from collections.abc import Callable, Iterator, Mapping, Sequence
from datetime import date
from functools import partial

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from feedward.operators import checks, clean, kpi
from feedward.operators.joins import having_parent, matched_rows


class Layers(Mapping[str, DataFrame]):
    """Raw, clean and KPI tables by name, as lazy plans built on first use.

    ``unique_parents`` promises that no parent key repeats, which a
    ``unique_check`` can show; referential filters are then semi joins.
    ``stored`` says that raw tables are plans over Parquet files that only project
    and filter, so that rows can be fetched by their place there.
    """

    def __init__(
        self,
        raw: Mapping[str, Callable[[], DataFrame]],
        as_of: date,
        order_by: Sequence[str] | None = None,
        dedup: str = "first",
        unique_parents: bool = False,
        stored: bool = False,
    ) -> None:
        self._tables: dict[str, DataFrame] = {}
        self._valid: dict[str, DataFrame] = {}
        self._replaced: set[str] = set()
        self._unique_parents, self._stored = unique_parents, stored
        self.as_of, self.order_by, self.dedup = as_of, order_by, dedup
        # What a table is before its referential join, the parent, and the key.
        self._unmatched: dict[str, tuple[Callable[[], DataFrame], str, str]] = {
            "clean_accounts": (
                lambda: clean.valid_accounts(self["raw_accounts"], as_of),
                "clean_customers",
                "customer_id",
            ),
            "clean_consents": (
                lambda: clean.valid_consents(self["raw_consents"]),
                "clean_customers",
                "customer_id",
            ),
            "clean_transactions": (
                lambda: clean.valid_transactions(
                    self["raw_transactions"], order_by, dedup=dedup
                ),
                "clean_accounts",
                "account_id",
            ),
        }
        self._builders: dict[str, Callable[[], DataFrame]] = dict(raw) | {
            "clean_customers": lambda: clean.clean_customers(self["raw_customers"]),
            "clean_accounts": partial(self._matched, "clean_accounts"),
            "clean_consents": partial(self._matched, "clean_consents"),
            "clean_transactions": lambda: self._transactions(self["raw_transactions"]),
            "clean_feed_logs": lambda: clean.clean_feed_logs(self["raw_feed_logs"]),
            "agg_feed_health": lambda: kpi.feed_health(self["clean_feed_logs"]),
            "agg_consent_summary": lambda: kpi.consent_summary(self["clean_consents"]),
            "agg_reconciliation": lambda: kpi.reconciliation(self["clean_feed_logs"]),
            "agg_transaction_volumes": self._volumes,
        }

    def __getitem__(self, name: str) -> DataFrame:
        if name not in self._tables:
            self._tables[name] = self._builders[name]()
        return self._tables[name]

    def _sides(self, name: str) -> tuple[DataFrame, DataFrame, str]:
        valid, parent, key = self._unmatched[name]
        if name not in self._valid:
            self._valid[name] = valid()
        return self._valid[name], self[parent], key

    def _matched(self, name: str) -> DataFrame:
        return having_parent(*self._sides(name), unique_parent=self._unique_parents)

    def _transactions(self, raw: DataFrame) -> DataFrame:
        return clean.clean_transactions(
            raw,
            self["clean_accounts"],
            self.order_by,
            dedup=self.dedup,
            unique_parent=self._unique_parents,
            stored=self._stored,
        )

    def in_slices(self, name: str, count: int) -> list[DataFrame]:
        """Clean transactions as tables that hold their rows together; all rows of an id are in one of them."""
        if name != "clean_transactions":
            raise ValueError(f"{name} can't be sliced")
        if count == 1:
            return [self[name]]
        raw, place = self["raw_transactions"], F.pmod(F.xxhash64("transaction_id"), F.lit(count))
        return [self._transactions(raw.filter(place == number)) for number in range(count)]

    def _volumes(self) -> DataFrame:
        """From the written transactions if there are any, else with a single join."""
        name = "clean_transactions"
        if name in self._replaced or self._unique_parents:
            return kpi.transaction_volumes(self[name], self["clean_accounts"])
        transactions, accounts, _ = self._sides(name)
        return kpi.transaction_volumes(transactions, accounts, matched=False)

    def __iter__(self) -> Iterator[str]:
        return iter(self._builders)

    def __len__(self) -> int:
        return len(self._builders)

    def replace(self, name: str, table: DataFrame) -> None:
        """Let later tables read this one, typically the written copy."""
        self._tables[name] = table
        self._replaced.add(name)

    def is_written(self, name: str) -> bool:
        """Whether the table is a stored copy, so that counting it again is cheap."""
        return name in self._replaced

    def row_count(self, name: str) -> DataFrame:
        """Number of rows of a table, as one row.

        A table that is still a plan ending in a referential join is counted
        per key instead of being joined row by row.
        """
        if name in self._replaced or name not in self._unmatched or self._unique_parents:
            return checks.count_rows(self[name])
        return matched_rows(*self._sides(name))

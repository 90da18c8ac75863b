"""Product and item groups: which codes of the ledger belong to which named group."""

from __future__ import annotations

import json
from dataclasses import dataclass
from pathlib import Path

from pyspark.sql import DataFrame, SparkSession

from ledgercast.sources.local_table import local_table


def _check_unique(kind: str, groups: dict[str, tuple[int, ...]]) -> None:
    seen: dict[int, str] = {}
    for name, codes in groups.items():
        for code in codes:
            if code in seen:
                raise ValueError(f"{kind} code {code} is in both {seen[code]} and {name}")
            seen[code] = name


@dataclass(frozen=True)
class Dimensions:
    """Two code-to-group mappings. A code may belong to one group only."""

    products: dict[str, tuple[int, ...]]
    items: dict[str, tuple[int, ...]]

    def __post_init__(self) -> None:
        _check_unique("product", self.products)
        _check_unique("item", self.items)

    @classmethod
    def from_json(cls, products_path: str, items_path: str) -> Dimensions:
        """Read ``{product: [title, [codes]]}`` and ``{item: [codes]}``."""
        products = json.loads(Path(products_path).read_text(encoding="utf-8"))
        items = json.loads(Path(items_path).read_text(encoding="utf-8"))
        return cls(
            products={name: tuple(entry[1]) for name, entry in products.items()},
            items={name: tuple(codes) for name, codes in items.items()},
        )

    @property
    def product_names(self) -> list[str]:
        return list(self.products)

    @property
    def item_names(self) -> list[str]:
        return list(self.items)

    @property
    def product_codes(self) -> list[int]:
        return [code for codes in self.products.values() for code in codes]

    def product_dim(self, spark: SparkSession) -> DataFrame:
        """One row per product code."""
        rows = [(code, name) for name, codes in self.products.items() for code in codes]
        return local_table(spark, rows, "product_cd int, product string")

    def item_dim(self, spark: SparkSession) -> DataFrame:
        """One row per item code."""
        rows = [(code, name) for name, codes in self.items.items() for code in codes]
        return local_table(spark, rows, "pl_item int, item string")

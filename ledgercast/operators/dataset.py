"""The full dataset: encoded profile with the ledger dataset beside it."""

from __future__ import annotations

from pyspark.sql import DataFrame

from ledgercast.sources.profile import KEYS


def fill_numbers(df: DataFrame) -> DataFrame:
    """Missing numbers become 0; text, dates and flags keep their nulls."""
    return df.na.fill(0)


def feature_dataset(profile: DataFrame, pnl: DataFrame) -> DataFrame:
    """Every profile row; a client without ledger rows has zeros.

    The ledger side is already spread by these keys after its pivot; only the profile moves.
    """
    return fill_numbers(profile.join(pnl, KEYS, "left"))


def profile_with_cells(profile: DataFrame, cells: DataFrame) -> DataFrame:
    """Every profile row with the map of its ledger sums, null without ledger rows; wide columns are read behind it.

    The join sorts the profile and one short map per client in place of all ledger features, and zeros
    are filled in the profile only: reading the map leaves none.
    """
    return fill_numbers(profile).join(cells, KEYS, "left")

"""Where the eight business tables come from and how they are laid out."""

from salescope.sources.tables import TABLE_NAMES, SalesTables, load_tables

__all__ = ["TABLE_NAMES", "SalesTables", "load_tables"]

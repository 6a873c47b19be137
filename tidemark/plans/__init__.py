"""Composite marts (``marts``), the adapters that shape the driver's tables
into the marts' inputs (``fixtures``) and the registered driver queries with
their SQL oracles (``queries``)."""

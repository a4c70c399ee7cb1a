"""Readers, sinks, the exchange-rate seed and the driver-table adapters."""
